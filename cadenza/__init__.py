"""cadenza: recommendation analytics on implicit feedback, written as Spark jobs.

Every public operator is a function ``DataFrame(s) -> DataFrame``; nothing is
collected to the driver except bounded results (a top-k list, one metrics row).
"""

__version__ = "0.1.0"
