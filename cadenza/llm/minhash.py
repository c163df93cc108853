"""MinHash near-dedup with b-bit signatures.

A document's set holds the hashes of its distinct 5-word shingles (fewer words: the whole sequence as
one). Of 128 minima the low 4 bits are kept, packed by bit plane into 8 longs; bands of 3 full minima
give the candidates. Two signatures agree in a place if no plane differs there, so agreement is a bit
count, and similarity is estimated as (agreement - 2^-b) / (1 - 2^-b). Pairs whose estimate lies more than
``MARGIN`` under the threshold (about five standard errors) are left; all others are confirmed on the
full sets. Two documents of similarity 0.75 share no band with a chance of 0.578^24 = 2e-6.

Groups. Equal sets are one class, which its smallest id stands for, so copies never meet again. First
every class is confirmed against the smallest id of its bucket, and the links give components. Buckets
that still hold several components are then searched whole, in squares of bounded size: all pairs
between components whose estimate passes are confirmed, best first, in the square of the first band
where they meet, and a square gives only the links that join its components. Links inside a component
change nothing.

Words: A-Z lower-cased, runs of ``[^\\x20\\x09-\\x0D]``. Null, empty and wordless texts have an empty set and
link with nothing. Rows that share an id are one document (their sets may all link); a row with a null
id links with nothing, keeps a null component and is kept. Every row gives one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import ascii_lower, free_name, frees, hash_words, materialise, mix64, small_batches, tidy

SHINGLE = 5
MINIMA = 128
BITS = 4
ROWS, BANDS = 3, 24
MARGIN = 0.2
BLOCK = 1024
_rng = np.random.default_rng(20240817)
_A = _rng.integers(1, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32)
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_C = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    w = hash_words(words)
    k = min(width, len(w))
    h = np.full(len(w) - k + 1, np.uint64(k))
    for i in range(k):
        h = h * _C + w[i:len(w) - k + 1 + i]
    return np.unique(mix64(h))


def minima(s: np.ndarray) -> np.ndarray:
    low = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(MINIMA, np.uint32(0xFFFFFFFF))
    for i in range(0, len(low), 1024):
        out = np.minimum(out, (low[i:i + 1024, None] * _A + _B).min(axis=0))
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    g = m[:ROWS * BANDS].reshape(BANDS, ROWS).astype(np.uint64)
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        h = mix64(h * _C + g[:, i])
    return h.view(np.int64)


def packed(m: np.ndarray) -> np.ndarray:
    """Bit planes of the low BITS bits, as longs."""
    planes = [np.packbits(((m >> np.uint32(b)) & np.uint32(1)).astype(np.uint8)) for b in range(BITS)]
    return np.concatenate(planes).view(np.int64)


_WORDS = MINIMA // 64


def estimate(a: Column, b: Column) -> Column:
    """Collision-corrected similarity of two packed signatures."""
    differ = F.lit(0)
    for w in range(_WORDS):
        x = None
        for p in range(BITS):
            y = a[p * _WORDS + w].bitwiseXOR(b[p * _WORDS + w])
            x = y if x is None else x.bitwiseOR(y)
        differ = differ + F.bit_count(x)
    return ((MINIMA - differ) / MINIMA - 2.0 ** -BITS) / (1 - 2.0 ** -BITS)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, k1 and k2 (the set's digest, null if empty), sig, bands."""
    small_batches(docs.sparkSession)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for pdf in batches:
            n, k1, k2, sig, bands = [], [], [], [], []
            for t in pdf["text"]:
                s = shingles(t if isinstance(t, str) else None)
                n.append(len(s))
                if not len(s):
                    k1.append(None), k2.append(None), sig.append(None), bands.append(None)
                    continue
                d = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                m = minima(s)
                k1.append(int(d[0])), k2.append(int(d[1])), sig.append(packed(m)), bands.append(band_keys(m))
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "n_shingles": n, "k1": pd.array(k1, "Int64"),
                                "k2": pd.array(k2, "Int64"), "sig": sig, "bands": bands})

    return docs.select("doc_id", "text").mapInPandas(
        frees(scan), "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, sig array<bigint>, bands array<bigint>")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if not len(a) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    inter = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * inter >= percent * (len(a) + len(b) - inter)


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose full sets are similar enough. Pairs are dealt by ``b`` and a salt (a part per
    64 partners), so a frequent partner's text is sent once per part and no task holds one group."""
    parts = pairs.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(1 << 20)))
    many = pairs.groupBy("b").agg(F.ceil(F.count("*") / 64).alias("parts"))
    parts = parts.join(many, "b").withColumn("salt", F.pmod("salt", "parts").cast("int"))
    sides = (parts.select("b", "salt", F.col("a").alias("id"), F.lit(1).alias("side"))
             .unionByName(parts.select("b", "salt", F.col("b").alias("id"), F.lit(0).alias("side")).distinct()))
    rows = sides.join(texts, "id").select("b", "salt", "side", "id", "text")
    dealt = rows.repartition("b", "salt").sortWithinPartitions("b", "salt", "side")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, base = None, []
        for pdf in batches:
            a, b = [], []
            for hub, salt, side, i, t in zip(pdf["b"], pdf["salt"], pdf["side"], pdf["id"], pdf["text"], strict=True):
                if (hub, salt) != at:
                    at, base = (hub, salt), []
                s = shingles(t)
                if side == 0:
                    base.append(s)
                elif any(similar(s, x, percent) for x in base):
                    a.append(i)
                    b.append(hub)
            yield pd.DataFrame({"a": pd.Series(a, dtype="int64"), "b": pd.Series(b, dtype="int64")})

    return dealt.mapInPandas(frees(check), "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, comp): the smallest id reachable from each id of ``edges`` (a, b).

    Large-star and small-star steps in turn: every step links neighbours to the smallest id near them, and
    the edges end as stars around the smallest id of each component. Each step cuts lineage."""
    e = materialise(edges.select("a", "b").where("a != b").distinct(), "edges")
    state = None
    while True:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        near = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(near, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .unionByName(near.select(F.col("u").alias("a"), F.col("m").alias("b")))
                 .where("a != b").distinct())
        e = materialise(small, "edges")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    return e.select(F.col("a").alias("id"), F.col("b").alias("comp")).unionByName(
        e.select(F.col("b").alias("id"), F.col("b").alias("comp"))).distinct()


def _bit_counts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of every signature of ``a`` with every one of ``b``."""
    differ = np.zeros((len(a), len(b)), np.int64)
    for w in range(_WORDS):
        x = np.zeros((len(a), len(b)), np.uint64)
        for p in range(BITS):
            k = p * _WORDS + w
            x |= a[:, None, k] ^ b[None, :, k]
        differ += np.bitwise_count(x)
    return ((MINIMA - differ) / MINIMA - 2.0 ** -BITS) / (1 - 2.0 ** -BITS)


def _link_square(rows: list[tuple], sets, cut: float, percent: int, band: int) -> list[tuple[int, int]]:
    """Links between the components of one square (block, id, comp, sig, bands, text): pairs that meet in
    this band first and whose estimate passes, best first, confirmed on their full sets unless earlier links
    have joined their components. At most one link less than there are members."""
    block = np.array([r[0] for r in rows])
    ids = np.array([r[1] for r in rows], np.int64)
    comp = np.array([r[2] for r in rows], np.int64)
    first = block == block.min()
    whole = bool(first.all())
    x, y = np.flatnonzero(first), np.arange(len(rows)) if whole else np.flatnonzero(~first)
    ok = comp[x][:, None] != comp[y][None, :]
    if whole:
        ok &= ids[x][:, None] > ids[y][None, :]
    if not ok.any():
        return []
    bands = np.array([r[4] for r in rows], np.int64)
    for k in range(band):
        ok &= bands[x, k][:, None] != bands[y, k][None, :]
    sig = np.array([r[3] for r in rows], np.int64).view(np.uint64)
    est = np.where(ok, _bit_counts(sig[x], sig[y]), -1.0)
    p, q = np.nonzero(est >= cut)
    order = np.argsort(-est[p, q], kind="stable")
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    out = []
    for u, v in zip(x[p[order]].tolist(), y[q[order]].tolist(), strict=True):
        ru, rv = root(int(comp[u])), root(int(comp[v]))
        if ru != rv and similar(sets(rows[u]), sets(rows[v]), percent):
            parent[max(ru, rv)] = min(ru, rv)
            out.append((int(max(ids[u], ids[v])), int(min(ids[u], ids[v]))))
    return out


def _square_links(members: DataFrame, texts: DataFrame, cut: float, percent: int) -> DataFrame:
    """Confirmed links (a, b) between components inside buckets (key, band, id, comp, sig, bands). A bucket
    comes as squares of two blocks of about BLOCK members, so no task holds a whole bucket."""
    size = members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    m = members.join(size, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # Each member goes to the squares of its block: (block, j) for j >= block, and (i, block) for i < block.
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    m = m.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "band", "block",
                 "id", "comp", "sig", "bands").join(texts, "id")
    dealt = m.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "id")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[str, np.ndarray] = {}  # by text: rows of one id may hold several
        size = 0

        def sets(row: tuple) -> np.ndarray:
            nonlocal size
            s = kept.get(row[5])
            if s is None:
                if size > 4 << 20:  # shingles
                    kept.clear()
                    size = 0
                s = kept[row[5]] = shingles(row[5])
                size += len(s)
            return s

        at, rows = None, []
        for pdf in batches:
            out = []
            for key, i, j, band, *row in pdf.itertuples(index=False, name=None):
                if (key, i, j) != at:
                    if len(rows) > 1:
                        out += _link_square(rows, sets, cut, percent, at_band)
                    at, at_band, rows = (key, i, j), band, []
                rows.append(tuple(row))
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")
        if len(rows) > 1:
            yield pd.DataFrame(_link_square(rows, sets, cut, percent, at_band), columns=["a", "b"], dtype="int64")

    cols = ["key", "i", "j", "band", "block", "id", "comp", "sig", "bands", "text"]
    return dealt.select(*cols).mapInPandas(frees(scan), "a bigint, b bigint").distinct()


@tidy
def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    cut = percent / 100 - MARGIN
    s = materialise(signatures(docs), "signatures")
    known = s.where("doc_id is not null and k1 is not null")
    classes = materialise(known.groupBy("k1", "k2").agg(
        F.min("doc_id").alias("id"), F.first("sig").alias("sig"), F.first("bands").alias("bands")), "classes")
    rows = classes.select("id", F.posexplode("bands").alias("band", "key"))
    hubs = rows.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("top")).where("hub != top").select("key", "hub")
    shared = materialise(rows.join(hubs, "key"), "buckets")  # members of buckets with two or more
    sigs = classes.select("id", "sig")
    star = shared.where("id != hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    near = materialise(_estimated(star, sigs, cut), "star_pairs")
    members = shared.select("id").distinct()
    texts = materialise(docs.select(F.col("doc_id").alias("id"), "text").where("id is not null and text is not null")
                        .join(members, "id").dropDuplicates(), "texts")
    links = materialise(confirm(near, texts, percent), "links")
    # A document with several sets stands for them all.
    named = known.select("doc_id", "k1", "k2").join(classes.select("k1", "k2", "id"), ["k1", "k2"])
    several = (named.groupBy("doc_id").agg(F.min("id").alias("b"), F.max("id").alias("top")).where("b != top"))
    extra = named.join(several.select("doc_id", "b"), "doc_id").select(F.col("id").alias("a"), "b").where("a != b")
    links = links.unionByName(extra)
    comps = components(links)
    found = shared.join(comps, "id", "left").select("key", "band", "id", F.coalesce("comp", "id").alias("comp"))
    mixed = found.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("key")
    open_ = found.join(mixed, "key", "left_semi").join(classes.select("id", "sig", "bands"), "id")
    more = materialise(_square_links(open_, texts, cut, percent), "links")
    if not more.isEmpty():
        comps = components(links.unionByName(more))
    final = classes.select("k1", "k2", "id").join(comps, "id", "left").select("k1", "k2", F.coalesce("comp", "id").alias("comp"))
    out = s.select("doc_id", "n_shingles", "k1", "k2").join(final, ["k1", "k2"], "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id")).alias("component_id")) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _estimated(pairs: DataFrame, sigs: DataFrame, cut: float) -> DataFrame:
    a = sigs.select(F.col("id").alias("a"), F.col("sig").alias("sa"))
    b = sigs.select(F.col("id").alias("b"), F.col("sig").alias("sb"))
    return pairs.join(a, "a").join(b, "b").where(estimate(F.col("sa"), F.col("sb")) >= cut).select("a", "b").distinct()


def _normal_form(text: Column) -> Column:
    """Digest of the words in order; null without words."""
    words = F.regexp_extract_all(ascii_lower(text), F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    return F.when(F.size(words) > 0, F.sha2(F.array_join(words, " "), 256))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of each group; same columns as ``docs``. Of rows that share the kept id one stays (the smallest text
    hash). A row with a null id is in the group of the rows with its words: it goes if such a row has an id, and of
    several without an id one stays; without words it stays."""
    verdict = near_duplicates(docs, **options)
    d, rank, form = (free_name(docs, n) for n in ("kept_id", "kept_rank", "kept_form"))
    kept = verdict.where("kept and doc_id is not null").select(F.col("doc_id").alias(d)).distinct()
    named = docs.join(kept, F.col("doc_id") == F.col(d), "left_semi")
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64(F.col("text")))
    out = named.withColumn(rank, F.row_number().over(one)).where(F.col(rank) <= 1).select(*docs.columns)
    nameless = docs.where(F.col("doc_id").isNull())
    if nameless.isEmpty():
        return out
    nameless = nameless.withColumn(form, _normal_form(F.col("text")))
    known = docs.where(F.col("doc_id").isNotNull()).select(_normal_form(F.col("text")).alias(form)).where(F.col(form).isNotNull())
    first = Window.partitionBy(form).orderBy(F.xxhash64(F.col("text")))
    alone = (nameless.where(F.col(form).isNotNull()).join(known, form, "left_anti")
             .withColumn(rank, F.row_number().over(first)).where(F.col(rank) <= 1).select(*docs.columns))
    return out.unionByName(alone).unionByName(nameless.where(F.col(form).isNull()).select(*docs.columns))
