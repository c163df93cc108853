"""SimHash near-dedup by a binary trie self-join.

Fingerprint. Words (A-Z lower-cased, runs of ``[^\\x20\\x09-\\x0D]``), 4-word shingles with repeats, joined by a
space (fewer words: the whole sequence); h is a shingle's XXH64 (UTF-8, seed 42). Bit i is 1 if it is set in
over half the h. Texts without words have fingerprint zero and link like any other.

Join. The distinct fingerprints are the leaves of a binary trie; pairs of nodes are traversed together from
the root, a differing bit costs one error, and a pair is left when its errors exceed the budget. To deal the
trie over tasks it is built in 16 rotations of the 64 bits by 4: if two fingerprints differ in at most 4 of 64
bits, one rotation exists whose first 4*i bits hold at most i/4 of the differences for every i (a cyclic
sequence with sum <= 0 has a start from which no partial sum is positive). So the budget grows with the depth:
no error in the first 12 bits, one in 28, two in 44, three in 60. All pairs of a rotation therefore lie below
one node of depth 12, the unit of work. A unit with more than ``LEAVES`` leaves is replaced by the pairs of its
descendants four bits further down, again and again, so no task holds a larger one, however the fingerprints
cluster; leaves are distinct, so this ends at depth 64.

A task gives only links that join what it has not joined yet, and leaves pairs of nodes whose leaves are all
in one of its components already, so a dense cluster costs no square. The links give components.

Nulls and repeats. A null text has no words. Rows that share an id are one document (all their fingerprints
are linked). A row with a null id links with nothing and keeps a null component. Every row gives one row; equal
rows give equal rows; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import frees, materialise, small_batches, tidy
from cadenza.llm.minhash import components

WIDTH = 4
SEED = 42
BUDGET = 4
STEP = 4                        # bits of a block; as many rotations as blocks
ROTATIONS = 64 // STEP
HEAD = 12                       # bits that hold no error
LEAVES = 1 << 16
FRONTIER = 1 << 19              # node pairs that are expanded at once
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def fingerprint(text: str | None) -> int:
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= WIDTH:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - WIDTH + 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):  # a long text takes a few MB at a time
        cut = zip(starts[at:min(n, at + (1 << 15))].tolist(), ends[at + WIDTH - 1:min(n, at + (1 << 15)) + WIDTH - 1].tolist(), strict=True)
        h = np.array([digest(line[s:e], SEED) for s, e in cut], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a long)."""
    small_batches(docs.sparkSession)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp = np.array([fingerprint(t if isinstance(t, str) else None) for t in pdf["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "fp": fp})

    return docs.select("doc_id", "text").mapInPandas(frees(scan), "doc_id bigint, fp bigint")


def budget(depth: int) -> int:
    """Errors that the first ``depth`` bits of the right rotation may hold."""
    return -(-depth // STEP) * BUDGET // ROTATIONS


class Forest:
    """Components of the leaves met so far."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self._steps()

    def _steps(self):
        # Leaves lo..hi are in one component if the label does not change between them.
        self.changes = np.concatenate([[0], np.cumsum(self.label[1:] != self.label[:-1])])

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        if not len(a):
            return
        while True:
            la, lb = self.label[a], self.label[b]
            open_ = la != lb
            if not open_.any():
                break
            a, b = a[open_], b[open_]
            np.minimum.at(self.label, np.maximum(la, lb)[open_], np.minimum(la, lb)[open_])
            while not np.array_equal(up := self.label[self.label], self.label):
                self.label = up
        self._steps()

    def joined(self, alo, ahi, blo, bhi) -> np.ndarray:
        c = self.changes
        return (c[ahi - 1] == c[alo]) & (c[bhi - 1] == c[blo]) & (self.label[alo] == self.label[blo])


def _expand(pairs: np.ndarray, zeros: np.ndarray, allowed: int) -> np.ndarray:
    """The pairs of children (rows alo, ahi, blo, bhi, errors) one bit further down."""
    alo, ahi, blo, bhi, d = pairs
    am, bm = alo + zeros[ahi] - zeros[alo], blo + zeros[bhi] - zeros[blo]
    cross = alo != blo
    more = d < allowed
    parts = [np.stack([alo, am, blo, bm, d]), np.stack([am, ahi, bm, bhi, d]),
             np.stack([alo, am, bm, bhi, d + 1])[:, more], np.stack([am, ahi, blo, bm, d + 1])[:, more & cross]]
    out = np.concatenate(parts, axis=1)
    alo, ahi, blo, bhi, d = out
    # Both nodes hold leaves; a node by itself holds two or more.
    return out[:, (ahi > alo) & (bhi > blo) & (d <= allowed) & ((alo != blo) | (ahi - alo > 1))]


def self_join(code: np.ndarray, roots: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Component label of every leaf (an index into ``code``, which is sorted inside each node), where leaves of a
    root pair with at most ``BUDGET`` differing bits are linked. ``roots``: (depth, pairs of nodes)."""
    forest = Forest(len(code))
    zeros: dict[int, np.ndarray] = {}
    todo = [(depth, p) for depth, p in roots if p.shape[1]]
    while todo:
        depth, pairs = todo.pop()
        if pairs.shape[1] > FRONTIER:
            half = pairs.shape[1] // 2
            todo += [(depth, pairs[:, half:]), (depth, pairs[:, :half])]
            continue
        pairs = pairs[:, ~forest.joined(*pairs[:4])]
        single = (pairs[1] - pairs[0] == 1) & (pairs[3] - pairs[2] == 1)
        a, b = pairs[0, single], pairs[2, single]
        near = np.bitwise_count(code[a] ^ code[b]) <= BUDGET
        forest.link(a[near], b[near])
        pairs = pairs[:, ~single]
        if not pairs.shape[1] or depth == 64:
            continue
        if depth not in zeros:
            bit = (code >> np.uint64(63 - depth)) & np.uint64(1)
            zeros[depth] = np.concatenate([[0], np.cumsum(bit == 0)])
        below = _expand(pairs, zeros[depth], budget(depth + 1))
        todo.append((depth + 1, below[:, np.argsort(-below[4], kind="stable")[::-1]] if below.shape[1] > FRONTIER else below))
    return forest.label


def _unit_links(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(a, b) document ids to link, from whole units that lie one after another: columns depth, r, u, v, d, side,
    code, id, sorted by all but the last."""
    code = rows["code"].view(np.uint64)
    n = len(code)
    unit = np.zeros(n, bool)
    unit[0] = True
    for c in ("depth", "r", "u", "v", "d"):
        unit[1:] |= rows[c][1:] != rows[c][:-1]
    lo = np.flatnonzero(unit)
    hi = np.append(lo[1:], n)
    ones = np.concatenate([[0], np.cumsum(rows["side"] == 1)])
    mid = hi - (ones[hi] - ones[lo])
    same = rows["u"][lo] == rows["v"][lo]
    whole = np.stack([lo, hi, lo, hi, rows["d"][lo]])[:, same & (hi - lo > 1)]
    cross = np.stack([lo, mid, mid, hi, rows["d"][lo]])[:, ~same & (mid > lo) & (hi > mid)]
    roots = []
    for p in (whole, cross):
        at = rows["depth"][p[0]]
        roots += [(int(k), p[:, at == k]) for k in np.unique(at)]
    label = self_join(code, roots)
    a = np.flatnonzero(label != np.arange(n))
    return rows["id"][a], rows["id"][label[a]]


def _links(work: DataFrame) -> DataFrame:
    cols = ["depth", "r", "u", "v", "d", "side", "code", "id"]
    dealt = work.select(*cols).repartition("depth", "r", "u", "v").sortWithinPartitions(*cols[:7])

    def frame(rows: dict[str, np.ndarray]) -> pd.DataFrame:
        a, b = _unit_links(rows)
        return pd.DataFrame({"a": a, "b": b}).query("a != b").drop_duplicates()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[dict[str, np.ndarray]] = []
        size = 0
        for pdf in batches:
            now = {c: pdf[c].to_numpy() for c in cols}
            held.append(now)
            size += len(pdf)
            if size < LEAVES:
                continue
            rows = {c: np.concatenate([h[c] for h in held]) for c in cols}
            last = [rows[c] == rows[c][-1] for c in cols[:5]]
            cut = int(np.flatnonzero(~np.logical_and.reduce(last)).max(initial=-1)) + 1  # the last unit may go on
            if cut:
                yield frame({c: x[:cut] for c, x in rows.items()})
            held, size = [{c: x[cut:] for c, x in rows.items()}], len(rows["id"]) - cut
        if size:
            yield frame({c: np.concatenate([h[c] for h in held]) for c in cols})

    return dealt.mapInPandas(frees(scan), "a bigint, b bigint").distinct()


def _descend(work: DataFrame) -> DataFrame:
    """The pairs of nodes ``STEP`` bits below the pairs of ``work``."""
    at = F.col("depth") + STEP
    spare = (F.ceil(at / STEP) * BUDGET / ROTATIONS).cast("int") - F.col("d")
    own = F.expr(f"cast(shiftrightunsigned(code, 64 - depth - {STEP}) & {(1 << STEP) - 1} as int)")
    w = work.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit((1 << STEP) - 1))))
    errors = F.bit_count(F.col("own").bitwiseXOR(F.col("other")))
    w = w.withColumn("e", errors).where(F.col("e") <= spare)
    alone = F.col("u") == F.col("v")
    first = F.when(alone, F.least("own", "other")).when(F.col("side") == 0, F.col("own")).otherwise(F.col("other"))
    second = F.when(alone, F.greatest("own", "other")).when(F.col("side") == 0, F.col("other")).otherwise(F.col("own"))
    side = F.when(alone, (F.col("own") > F.col("other")).cast("int")).otherwise(F.col("side"))
    return w.select(at.cast("int").alias("depth"), "r", (F.shiftleft("u", STEP) + first).alias("u"),
                    (F.shiftleft("v", STEP) + second).alias("v"), (F.col("d") + F.col("e")).cast("int").alias("d"),
                    side.cast("int").alias("side"), "code", "id")


def near_pairs(leaves: DataFrame) -> DataFrame:
    """Links (a, b) between the ids of ``leaves`` (id, fp; distinct fp) that connect all pairs of fingerprints with at
    most ``BUDGET`` differing bits."""
    # Java's shifts count modulo 64, so rotation 0 is the fingerprint itself.
    work = leaves.select("id", "fp", F.explode(F.sequence(F.lit(0), F.lit(ROTATIONS - 1))).alias("r"))
    work = work.withColumn("code", F.expr(f"shiftleft(fp, {STEP} * r) | shiftrightunsigned(fp, (64 - {STEP} * r) % 64)"))
    head = F.expr(f"shiftrightunsigned(code, {64 - HEAD})")
    work = work.select(F.lit(HEAD).alias("depth"), "r", head.alias("u"), head.alias("v"), F.lit(0).alias("d"), F.lit(0).alias("side"),
                       "code", "id")
    unit = ["depth", "r", "u", "v", "d"]
    ready = None
    while True:
        sizes = materialise(work.groupBy(*unit).agg(F.count("*").alias("n"), F.min("side").alias("lo"), F.max("side").alias("hi"))
                            .where(F.col("n") > LEAVES).select(*unit, "n"), "large_units")
        if sizes.isEmpty():
            return _links(work if ready is None else ready.unionByName(work))
        # Few units are large: at most (leaves x rotations) / LEAVES.
        light = work.join(sizes.select(*unit), unit, "left_anti").select(*work.columns)
        ready = light if ready is None else ready.unionByName(light)
        work = materialise(_descend(work.join(sizes.select(*unit), unit, "left_semi").select(*work.columns)), "node_pairs")


@tidy
def simhash_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id."""
    s = materialise(fingerprints(docs), "fingerprints")
    known = s.where("doc_id is not null")
    classes = materialise(known.groupBy("fp").agg(F.min("doc_id").alias("id")), "leaves")
    links = near_pairs(classes)
    # A document with several fingerprints links their classes.
    ids = known.distinct().join(classes, "fp").select("doc_id", "id")
    several = ids.groupBy("doc_id").agg(F.min("id").alias("b"), F.max("id").alias("top")).where("b != top").select("doc_id", "b")
    extra = ids.join(several, "doc_id").select(F.col("id").alias("a"), "b").where("a != b")
    comps = components(links.unionByName(extra))
    final = classes.join(comps, "id", "left").select("fp", F.coalesce("comp", "id").alias("comp"))
    out = s.join(final, "fp", "left")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      F.when(F.col("doc_id").isNotNull(), F.col("comp")).alias("component_id"))
