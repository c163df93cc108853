"""Mixing sources to target weights, in DataFrame functions only.

The words of each source form one stream, cut into blocks of ``block_words`` words. A source's quota is
its target in blocks. Output slots are dealt to shards; the source counts of a shard are a multinomial
draw without replacement from the quotas (a pseudorandom permutation of all slots), so that every
source meets its target. The j-th slot of a source reads block ``perm(j mod n)`` of pass ``j div n``,
with another keyed permutation for each pass: no block is taken twice before all are taken once. The
picked blocks are counted per index and joined to the blocks of each document.

Targets: sources in code-point order, null last, weigh 1, 2, 3, repeating, and share the size of all;
a target stops at ``cap`` times its source's size and the excess goes to the others by weight.

Size is the number of ``[^\\x20\\x09-\\x0D]+`` (null: 0). Documents of size 0 take 0; a null source is a
source; null ids are ordinary ids; repeated rows are laid out one after the other and each gives a row.
An empty table gives no rows. Everything follows from hashes, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import free_name, materialise

BLOCK_WORDS = 64
SHARD_SLOTS = 4096
BUCKET_ROWS = 4_000
SUM_ROWS = 4_096
SLOTS_PER_TASK = 500_000
BROADCAST_ROWS, BROADCAST_CHARS = 50_000, 4 << 20
_CHUNK = 1 << 14
_WALK = 24


def permuted(x: Column, n: Column, key: Column) -> Column:
    """Keyed pseudorandom permutation of 0 .. n-1: four Feistel rounds on a square of side
    ceil(sqrt(n)), walked on while it leaves the range (the square has at most 2 sqrt(n) + 1 places more,
    so 24 steps always do for n < 140, and beyond that fail with a chance under 1e-18)."""
    side = F.greatest(F.ceil(F.sqrt(n.cast("double"))), F.lit(1)).cast("long")

    def rounds(v: Column) -> Column:
        left, right = F.floor(v / side).cast("long"), v % side
        for i in range(4):
            left, right = right, (left + F.pmod(F.xxhash64(right, key, F.lit(i)), side)) % side
        return left * side + right

    once = rounds(x)
    return F.when(once < n, once).otherwise(F.aggregate(
        F.sequence(F.lit(1), F.lit(_WALK)), once, lambda acc, _: F.when(acc < n, acc).otherwise(rounds(acc))))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _before(df: DataFrame, key: str, pos: str, value: str, out: str, width: int = SUM_ROWS) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over the rows of ``key`` at smaller ``pos`` (one row per key and pos).
    In two levels, sums of ``width`` places and sums inside them, so that no task sorts all rows of a key."""
    part = df.withColumn("_part", F.floor(F.col(pos) / width).cast("long"))
    sums = part.groupBy(key, "_part").agg(F.sum(value).alias("_sum"))
    sums = sums.select(key, "_part", (F.sum("_sum").over(Window.partitionBy(key).orderBy("_part")) - F.col("_sum")).alias("_start"))
    inside = F.sum(value).over(Window.partitionBy(key, "_part").orderBy(pos)) - F.col(value)
    return (part.withColumn("_inside", inside).join(sums, [key, "_part"])
            .withColumn(out, F.col("_start") + F.col("_inside")).drop("_part", "_start", "_inside"))


def targets(units: DataFrame, cap: int = 3, weights: tuple = (1, 2, 3)) -> DataFrame:
    """(source, sid, source_size, target): one row per source."""
    s = units.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    s = s.withColumn("sid", F.row_number().over(by_name).cast("long"))
    s = s.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), ((F.col("sid") - 1) % len(weights) + 1).cast("int")))
    # Water filling: with sources by cap / weight, the level is the largest share that is left per weight.
    full = F.col("source_size") * cap
    by_room = Window.orderBy(full / F.col("w"), "sid")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum(full).over(before), F.lit(0))
    weight = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0))
    s = s.withColumn("share", left / weight).withColumn("level", F.max("share").over(every))
    return s.select("source", "sid", "source_size",
                    F.least(full.cast("double"), F.col("level") * F.col("w")).cast("double").alias("target"))


def _measure(src: DataFrame, block_words: int) -> tuple[bool, int]:
    """Whether the source table may be broadcast, and partitions for its slots (rows there are short, but
    each becomes many: their number, not their bytes, sets the partitions)."""
    n, chars, words = src.agg(F.count("*"), F.coalesce(F.sum(F.length("source")), F.lit(0)),
                              F.coalesce(F.sum("source_size"), F.lit(0))).first()
    parts = max(int(src.sparkSession.conf.get("spark.sql.shuffle.partitions")), words // block_words // SLOTS_PER_TASK)
    return n <= BROADCAST_ROWS and chars <= BROADCAST_CHARS, parts


def picked_blocks(src: DataFrame, block_words: int, shard_slots: int, seed: int, small: bool, parts: int) -> DataFrame:
    """(sid, block, times) of the mix."""
    s = (src.where("source_size > 0")
         .withColumn("n", F.ceil(F.col("source_size") / block_words).cast("long"))
         .withColumn("quota", F.round(F.col("target") * F.col("n") / F.col("source_size")).cast("long")))
    s = (s.withColumn("first", F.sum("quota").over(Window.orderBy("sid")) - F.col("quota"))
         .withColumn("all", F.sum("quota").over(Window.partitionBy())).where("quota > 0"))
    keep = ["sid", "n", "quota", "first", "all"]
    # Slots in two steps, so that a huge source is dealt over many tasks.
    chunk = s.select(*keep, F.explode(F.sequence(F.lit(0).cast("long"), F.col("quota") - 1, F.lit(_CHUNK).cast("long"))).alias("lo"))
    slots = (chunk.repartition(parts, "sid", "lo")
             .select("sid", "first", "all", F.explode(F.sequence(F.col("lo"), F.least(F.col("lo") + _CHUNK, F.col("quota")) - 1)).alias("j")))
    place = permuted(F.col("first") + F.col("j"), F.col("all"), F.lit(seed).cast("long"))
    counts = (slots.withColumn("shard", F.floor(place / shard_slots).cast("long"))
              .groupBy("sid", "shard").agg(F.count("*").alias("k")))
    counts = _before(counts, "sid", "shard", "k", "base")
    mapped = (counts.repartition(parts, "sid", "shard")
              .join(F.broadcast(s.select("sid", "n")) if small else s.select("sid", "n"), "sid"))
    j = mapped.select("sid", "shard", "n", F.explode(F.sequence(F.col("base"), F.col("base") + F.col("k") - 1)).alias("j"))
    pass_no, inside = F.floor(F.col("j") / F.col("n")).cast("long"), F.col("j") % F.col("n")
    key = F.xxhash64(F.col("sid"), pass_no, F.lit(seed + 1).cast("long"))
    return (j.select("sid", permuted(inside, F.col("n"), key).alias("block"))
            .groupBy("sid", "block").agg(F.count("*").alias("times")))


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, cap: int = 3,
        seed: int = 17) -> DataFrame:
    """One row per document: doc_id, source, size, copy (number among equal rows), source_size, target, taken."""
    units = materialise(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
        .groupBy("source", "doc_id", "size").agg(F.count("*").alias("copies")), "units")
    src = materialise(targets(units, cap), "sources")
    small, parts = _measure(src, block_words)
    picks = picked_blocks(src, block_words, shard_slots, seed, small, parts)
    side = F.broadcast(src) if small else src
    units = units.join(side.select("source", "sid").withColumnRenamed("source", "s"),
                       F.col("source").eqNullSafe(F.col("s"))).drop("s")
    buckets = max(1, -(-units.count() // BUCKET_ROWS))
    units = units.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
    length = F.col("size") * F.col("copies")
    in_bucket = Window.partitionBy("sid", "bucket").orderBy("doc_id", "size")
    heads = _before(units.groupBy("sid", "bucket").agg(F.sum(length).alias("t")), "sid", "bucket", "t", "base")
    placed = (units.withColumn("inside", F.sum(length).over(in_bucket) - length)
              .join(heads.select("sid", "bucket", "base"), ["sid", "bucket"])
              .select("sid", "source", "doc_id", "size", (F.col("base") + F.col("inside")).alias("at"),
                      F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
              .withColumn("at", F.col("at") + (F.col("copy") - 1) * F.col("size")))
    first = F.floor(F.col("at") / block_words).cast("long")
    last = F.floor((F.col("at") + F.col("size") - 1) / block_words).cast("long")
    pieces = placed.select("sid", "source", "doc_id", "size", "copy", "at", F.explode_outer(
        F.when(F.col("size") > 0, F.sequence(first, last))).alias("block"))
    overlap = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block_words) - \
        F.greatest(F.col("at"), F.col("block") * block_words)
    taken = (pieces.join(picks, ["sid", "block"], "left")
             .groupBy("sid", "source", "doc_id", "size", "copy")
             .agg(F.coalesce(F.sum(F.col("times") * overlap), F.lit(0)).cast("long").alias("taken")))
    return (taken.join(side.select("sid", "source_size", "target"), "sid")
            .select("doc_id", "source", "size", "copy", "source_size", "target", "taken"))


def mix_report(docs: DataFrame, **options) -> DataFrame:
    return mix(docs, **options).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, seed: int = 17, **options) -> DataFrame:
    """The mix as whole documents, same columns as ``docs``: a document of which the mix takes ``x`` times
    its words comes floor(x) times, and once more for a systematic draw of the fractions (in size order
    within groups of a source, so that the words of a source stay near its target)."""
    size, copy, n = (free_name(docs, c) for c in ("mix_size", "mix_copy", "mix_n"))
    m = materialise(mix(docs, seed=seed, **options).where("size > 0"), "mix")
    buckets = max(1, -(-m.count() // BUCKET_ROWS))
    m = m.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "copy"), F.lit(buckets)))
    whole = F.floor(F.col("taken") / F.col("size")).cast("long")
    part = F.col("taken") / F.col("size") - whole
    w = Window.partitionBy("source", "bucket").orderBy("size", "doc_id", "copy")
    offset = F.pmod(F.xxhash64("source", "bucket", F.lit(seed)), F.lit(1000)) / 1000.0
    upto = F.sum(part).over(w) + offset
    m = m.withColumn("times", whole + (F.floor(upto) - F.floor(upto - part)).cast("long")).where("times > 0")
    m = m.select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_z"),
                 F.col("copy").alias("_c"), F.col("times").alias("_t"))
    same = Window.partitionBy("source", "doc_id", size).orderBy("text")
    named = (docs.withColumn(size, word_count(F.col("text"))).withColumn(copy, F.row_number().over(same).cast("long")))
    out = named.join(m, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s"))
                     & (F.col(size) == F.col("_z")) & (F.col(copy) == F.col("_c")))
    return out.withColumn(n, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_t")))).select(*docs.columns)
