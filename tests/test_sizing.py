from cadenza.operators.retrieve import block_counts
from cadenza.session import sizing_conf


def test_block_counts_balance_and_caps():
    qb, ib = block_counts(1_000_000, 386_000, 8000)
    assert qb * ib >= 16000
    assert 1_000_000 / qb <= 16384 and 386_000 / ib <= 16384
    qb, ib = block_counts(500, 500, 8)
    assert qb * ib >= 16
    assert block_counts(20000, 20000, 8, k=500, dim=64)[1] <= 2  # large k: few item blocks, fewer partial lists
    qb, ib = block_counts(10**9, 10**6, 4, max_query_block=4096, max_item_block=4096)
    assert 10**9 / qb <= 4096 and 10**6 / ib <= 4096


def test_sizing_conf():
    c = sizing_conf(100 * 2**40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert sizing_conf(10, 8)["spark.sql.shuffle.partitions"] == "16"


def test_no_more_query_blocks_than_groups_are_wanted():
    # A low rank and long lists: each further query block would only send all items once more.
    assert block_counts(89_607, 120_000, 8, max_query_block=16_644, max_item_block=120_000, k=500, dim=10) == (16, 1)
    assert block_counts(10**6, 120_000, 8, max_query_block=16_644, max_item_block=120_000, k=500, dim=10) == (61, 1)  # memory
