"""Training-data operators on ``documents``, ``pages``, ``benchmark`` and ``labels``.

Nothing else in the package imports this subpackage. Each module holds one
operator; ``queries`` registers the contract query of each.
"""
