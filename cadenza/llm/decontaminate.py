"""Benchmark decontamination with suffix arrays over shards of the training text.

Each task turns runs of documents (a shard: a few million characters) into word numbers of the
benchmark's vocabulary and sorts the shard's word suffixes that begin with at least as many benchmark
words as the shortest window has (no other suffix can match). Every benchmark suffix is then
binary-searched in that array; the interval it hits holds all places of its window. Runs of hits on one
diagonal give the longest verbatim match and where it lies. Documents with a hit are contaminated.

Words: A-Z lower-cased, runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``. A window is ``n`` consecutive words
of an item; an item with fewer, but some, is one window. Null and empty texts have no words, so they
hit nothing; null item ids are left out; rows that share an item id are one item. Every document row
gives one row. An empty benchmark contaminates nothing.

The benchmark is broadcast in blocks of at most ``block_chars`` characters of text (measured before);
more than one block means one pass over the documents per block, joined by a stored row number.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import free_name, materialise, release, small_batches

WINDOW = 10
BLOCK_CHARS = 16 << 20
SHARD_BYTES = 4 << 20
_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


class TestSuffixes:
    """The sorted benchmark side: vocabulary, all windows, and the items that hold each."""

    def __init__(self, items: list[tuple[int, str | None]], n: int = WINDOW):
        texts: dict[tuple, set] = {}
        for item, text in items:
            w = tuple(words_of(text))
            if w and item is not None:
                texts.setdefault(w, set()).add(item)
        self.n = n
        self.vocab: dict[bytes, int] = {}
        self.owners = [sorted(v) for v in texts.values()]
        numbered = [[self.vocab.setdefault(w, len(self.vocab) + 1) for w in ws] for ws in texts]
        self.bits = max(1, (len(self.vocab) + 1).bit_length())
        self.shortest = min((min(len(w), n) for w in numbered), default=0)
        owner, offset, length, rows = [], [], [], []
        for k, w in enumerate(numbered):
            m = min(len(w), n)
            for i in range(len(w) - m + 1):
                owner.append(k)
                offset.append(i)
                length.append(m)
                rows.append(w[i:i + m] + [0] * (n - m))
        self.owner, self.offset = np.array(owner, np.int64), np.array(offset, np.int64)
        self.length = np.array(length, np.int64)
        low = np.array(rows, np.int64).reshape(-1, n)
        high = np.where(np.arange(n) < self.length[:, None], low, (1 << self.bits) - 1) if len(rows) else low
        self.low, self.high = self.keys(low), self.keys(high)

    def pack(self, columns: Iterator[np.ndarray], size: int) -> list[np.ndarray]:
        """Word numbers packed into as few 64-bit integers as hold ``n`` of them."""
        per = 63 // self.bits
        out = []
        for k, c in enumerate(columns):
            if k % per == 0:
                out.append(np.zeros(size, np.uint64))
            out[-1] = (out[-1] << np.uint64(self.bits)) | c.astype(np.uint64)
        pad = -self.n % per
        if pad:
            out[-1] = out[-1] << np.uint64(self.bits * pad)
        return out

    def keys(self, rows: np.ndarray) -> np.ndarray:
        return self.as_bytes(self.pack((rows[:, k] for k in range(self.n)), len(rows)))

    @staticmethod
    def as_bytes(packed: list[np.ndarray]) -> np.ndarray:
        """Big-endian byte strings, whose order is that of the word numbers."""
        wide = np.stack(packed, axis=1).astype(">u8") if packed else np.zeros((0, 1), ">u8")
        return np.ascontiguousarray(wide).view(f"S{8 * wide.shape[1]}").ravel()

    def suffix_array(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the shard's suffixes that start with ``shortest`` benchmark words, in
        lexicographic order of their first ``n`` words, and those words as keys."""
        inside = x > 0
        ends = np.flatnonzero(~inside)
        stop = np.append(ends, len(x))[np.searchsorted(ends, np.arange(len(x)))]
        at = np.flatnonzero(inside & (stop - np.arange(len(x)) >= self.shortest))
        padded = np.concatenate([x, np.zeros(self.n, x.dtype)])
        packed = self.pack((padded[at + k] for k in range(self.n)), len(at))
        order = np.lexsort(packed[::-1]) if len(at) else np.zeros(0, np.int64)
        return at[order], self.as_bytes([p[order] for p in packed])

    def search(self, shard: list[list[bytes]]) -> list[tuple]:
        """Per document: (words, hit words, items, longest match, its item, its place, hit runs)."""
        lens = np.fromiter(map(len, shard), np.int64, len(shard))
        plain = [(int(n), 0, [], 0, None, None, []) for n in lens]
        if not len(self.low) or not lens.sum():
            return plain
        starts = np.cumsum(lens + 1) - lens - 1  # one separator after each document
        x = np.zeros(int(lens.sum()) + len(shard), np.int32)
        get = self.vocab.get
        for s, words in zip(starts, shard, strict=True):
            x[s:s + len(words)] = np.fromiter(map(get, words, repeat(0)), np.int32, len(words))
        sa, keys = self.suffix_array(x)
        lo = np.searchsorted(keys, self.low, "left")
        hi = np.searchsorted(keys, self.high, "right")
        found = np.flatnonzero(hi > lo)
        if not len(found):
            return plain
        count = (hi - lo)[found]
        test = np.repeat(found, count)
        at = sa[np.repeat(lo[found], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
        diff = np.zeros(len(x) + 1, np.int64)
        np.add.at(diff, at, 1)
        np.add.at(diff, at + self.length[test], -1)
        hit = np.cumsum(diff[:-1]) > 0
        doc = np.searchsorted(starts, at, "right") - 1
        # Longest verbatim match: consecutive places on one diagonal of one item.
        order = np.lexsort((at, at - self.offset[test], self.owner[test]))
        a, t, d = at[order], test[order], doc[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1] + 1) | (self.owner[t[1:]] != self.owner[t[:-1]]) | \
            (self.offset[t[1:]] != self.offset[t[:-1]] + 1) | (d[1:] != d[:-1])
        head = np.flatnonzero(new)
        run = np.diff(np.append(head, len(a))) - 1 + self.length[t[head]]
        out = plain
        edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
        span_doc = np.searchsorted(starts, edge[::2], "right") - 1
        by_doc = np.argsort(doc, kind="stable")
        by_run = np.lexsort((a[head], -run, d[head]))  # per document, the longest and then first run leads
        hits, runs = doc[by_doc], d[head][by_run]
        for k in np.unique(doc):
            (s0, s1), (h0, h1) = np.searchsorted(span_doc, [k, k + 1]), np.searchsorted(hits, [k, k + 1])
            spans = np.stack([edge[::2][s0:s1], edge[1::2][s0:s1]], axis=1) - starts[k]
            items = sorted({i for o in np.unique(self.owner[test[by_doc[h0:h1]]]) for i in self.owners[o]})
            b = by_run[np.searchsorted(runs, k)]
            out[k] = (int(lens[k]), int((spans[:, 1] - spans[:, 0]).sum()), items, int(run[b]),
                      self.owners[self.owner[t[head[b]]]][0], int(a[head[b]] - starts[k]), spans.ravel().tolist())
        return out


FIELDS = ("n_words long, n_hit long, items array<bigint>, longest_words long, longest_item long, longest_at long, "
          "hit_runs array<bigint>")


def _scanner(shared):
    names = [f.split()[0] for f in FIELDS.split(", ")]

    @F.pandas_udf(FIELDS)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tests = shared.value
        for s in batches:
            rows, shard, size = [], [], 0
            for t in s:
                words = words_of(t if isinstance(t, str) else None)
                shard.append(words)
                size += len(t) if isinstance(t, str) else 0
                if size >= SHARD_BYTES:
                    rows += tests.search(shard)
                    shard, size = [], 0
            out = pd.DataFrame(rows + tests.search(shard), columns=names)
            out["longest_item"] = out["longest_item"].astype("Int64")
            out["longest_at"] = out["longest_at"].astype("Int64")
            yield out
        release()

    return scan.asNondeterministic()  # one call, whatever is read of its result


def _merge_runs(runs: list) -> int:
    """Words covered by several lists of [start, end) pairs."""
    pairs = sorted((r[i], r[i + 1]) for r in runs for i in range(0, len(r), 2))
    total, end = 0, 0
    for a, b in pairs:
        total += max(0, b - max(a, end))
        end = max(end, b)
    return total


def find(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, block_chars: int = BLOCK_CHARS) -> tuple[DataFrame, str]:
    """``docs`` plus one struct column of ``FIELDS`` under a free name; returns the frame and that name."""
    spark = docs.sparkSession
    small_batches(spark)
    bench = benchmark.select("item_id", "text")
    chars = bench.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // block_chars))
    name = free_name(docs, "found")

    def tests(k: int):
        part = bench.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k) if blocks > 1 else bench
        return spark.sparkContext.broadcast(TestSuffixes([(r[0], r[1]) for r in part.collect()], n))

    if blocks == 1:
        return docs.withColumn(name, _scanner(tests(0))("text")), name
    rid = free_name(docs, "row_no")
    docs = materialise(docs.withColumn(rid, F.monotonically_increasing_id()), "documents")
    hits = None
    for k in range(blocks):
        one = docs.select(rid, _scanner(tests(k))("text").alias("f")).select(rid, "f.*")
        one = materialise(one.where("n_hit > 0"), "hits")
        hits = one if hits is None else hits.unionByName(one)

    @F.pandas_udf("long")
    def covered(s: pd.Series) -> pd.Series:
        return pd.Series([_merge_runs(list(map(list, r))) for r in s])

    merged = hits.groupBy(rid).agg(  # one row per block at most
        F.max("n_words").alias("n_words"), F.collect_list("hit_runs").alias("runs"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.max(F.struct("longest_words", "longest_item", "longest_at")).alias("best"))
    merged = merged.select(rid, F.struct("n_words", covered("runs").alias("n_hit"), "items", "best.*").alias(name))
    none = F.struct(_count_words(F.col("text")).alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                    F.array().cast("array<bigint>").alias("items"), F.lit(0).cast("long").alias("longest_words"),
                    F.lit(None).cast("long").alias("longest_item"), F.lit(None).cast("long").alias("longest_at"))
    return docs.join(merged, rid, "left").withColumn(name, F.coalesce(name, none)).drop(rid), name


def _count_words(text):
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")), F.lit(0)).cast("long")


def contamination_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document; ``items_sha256`` hashes the item ids sorted as strings and comma-joined."""
    out, f = find(docs.select("doc_id", "text"), benchmark, **options)
    ids = F.array_sort(F.transform(f"{f}.items", lambda i: i.cast("string")))
    return out.select(
        "doc_id", f"{f}.n_words", f"{f}.n_hit", F.size(f"{f}.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.col(f"{f}.n_hit") > 0).alias("contaminated"),
        f"{f}.longest_words", f"{f}.longest_item", f"{f}.longest_at")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any hit; same columns as ``docs``."""
    out, f = find(docs, benchmark, **options)
    return out.where(F.col(f"{f}.n_hit") == 0).select(*docs.columns)
