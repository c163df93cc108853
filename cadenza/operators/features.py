"""Item-feature tables and exploration summaries."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.functions import genre_label, quoted_id


# ---------------------------------------------------------------- P3 / P4 / P13
def keep_not_equal(df: DataFrame, col: str, value) -> DataFrame:
    """``col != value``; SQL semantics, so NULL rows are dropped as well."""
    return df.where(F.col(col) != F.lit(value))


def sentinels_to_null(df: DataFrame, sentinels: dict) -> DataFrame:
    """Replace per-column sentinel values (year 0, 0.0, -1, '') with NULL; NaN too for doubles."""
    out = df
    for c, v in sentinels.items():
        x = F.nullif(F.col(c), F.lit(v))
        if dict(df.dtypes)[c] in ("double", "float"):
            x = F.when(F.isnan(F.col(c)), F.lit(None)).otherwise(x)
        out = out.withColumn(c, x)
    return out


def default_text(df: DataFrame, cols, default: str = "") -> DataFrame:
    """Absent text fields become ``''``."""
    for c in cols:
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit(default)))
    return df


# ---------------------------------------------------------------------- P7 / A2
def first_element(col: str):
    """First list element, NULL for a NULL or empty list."""
    return F.try_element_at(F.col(col), F.lit(1))


def list_per_key(df: DataFrame, key: str, value: str, order_by: str, out_col: str | None = None, first: int | None = None) -> DataFrame:
    """A2: all values per key, repeats kept, as a list in the input order given by ``order_by``.

    The list is the output, so it is as long as the key has rows; partial lists are built
    on the map side and the rows of a key are sorted by (order, value) within its list. Where only its beginning is
    wanted, ``first`` says how many values: the others are left out before and after the shuffle.
    """
    out_col = out_col or value
    if first is not None:
        w = Window.partitionBy(key).orderBy(order_by, value)
        df = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= first)
    return (df.groupBy(key)
            .agg(F.array_sort(F.collect_list(F.struct(F.col(order_by).alias("_o"), F.col(value).alias("_v"))))
                 .alias("_l"))
            .select(key, F.col("_l._v").alias(out_col)))


# -------------------------------------------------------------------- A3 - A6
def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A3: rows per value, most frequent first (ties by value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col(col))


def order_statistics(df: DataFrame, targets: dict, bins: int = 1024) -> dict:
    """Exact values at given ranks: ``{name: (column, rank from 0)}`` -> ``{name: value}``, nulls and NaN left out.

    Rank selection: a pass counts the values of each open interval in ``bins`` bins of equal width; the bin that
    holds the rank, cut to the values in it, is the next interval, until it holds one value. A pass reads
    only the columns, sends at most ``bins`` rows per target and task, and a few passes are enough for doubles.
    """
    if not targets:
        return {}
    names = list(targets)
    value = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c, _ in targets.values()}
    span = df.agg(*[f(v).alias(f"{n}{i}") for i, v in enumerate(value.values()) for n, f in (("a", F.min), ("b", F.max))]).first()
    ends = {c: (span[f"a{i}"], span[f"b{i}"]) for i, c in enumerate(value)}
    open_ = {n: [*ends[targets[n][0]], 0] for n in names if ends[targets[n][0]][0] is not None}
    found = {}
    while open_:
        for n in [n for n, (lo, hi, _) in open_.items() if lo == hi]:
            found[n] = open_.pop(n)[0]
        if not open_:
            break
        parts = []
        for n, (lo, hi, _) in open_.items():
            v = value[targets[n][0]]
            at = F.least(F.floor((v - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
            parts.append(F.when((v >= lo) & (v <= hi), F.struct(F.lit(names.index(n)).alias("t"), at.alias("bin"), v.alias("v"))))
        rows = df.select(F.explode(F.array(*parts)).alias("r")).where("r is not null").groupBy("r.t", "r.bin").agg(
            F.count("*").alias("n"), F.min("r.v").alias("lo"), F.max("r.v").alias("hi")).collect()
        for n, state in open_.items():
            before = state[2]
            for r in sorted((r for r in rows if r["t"] == names.index(n)), key=lambda r: r["bin"]):
                if before + r["n"] > targets[n][1]:
                    state[:] = [r["lo"], r["hi"], before]
                    break
                before += r["n"]
    return found


def quartiles(df: DataFrame, cols, probabilities=(0.25, 0.5, 0.75)) -> dict:
    """Exact interpolated quantiles per column, by rank selection: ``{column: [value]}`` (None without values). NaN
    counts as a value above all others, as in Spark's order."""
    sizes = df.agg(*[a for i, c in enumerate(cols) for a in (F.count(c).alias(f"n{i}"), F.count(F.when(~F.isnan(F.col(c).cast("double")), 1)).alias(f"m{i}"))]).first()
    targets, got = {}, {}
    for i, c in enumerate(cols):
        for p in probabilities if sizes[f"n{i}"] else ():
            h = (sizes[f"n{i}"] - 1) * p
            for side, rank in enumerate((math.floor(h), math.ceil(h))):
                if rank < sizes[f"m{i}"]:
                    targets[c, p, side] = (c, rank)
                else:
                    got[c, p, side] = math.nan
    got |= order_statistics(df, targets)
    out = {}
    for i, c in enumerate(cols):
        part = [((sizes[f"n{i}"] - 1) * p) % 1 for p in probabilities]
        out[c] = [got[c, p, 0] + w * (got[c, p, 1] - got[c, p, 0]) if (c, p, 0) in got else None for p, w in zip(probabilities, part, strict=True)]
    return out


def describe_numeric(df: DataFrame, cols) -> DataFrame:
    """A4, numeric: count, mean, sample std, min, exact interpolated quartiles, max per column.

    One scan computes the sums of every column; the quartiles are found by rank selection, so nothing holds the
    distinct values. The one-row result is unpivoted to one row per column.
    """
    aggs, marks = [], quartiles(df, cols)
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"),
                 F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]
    wide = df.agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        fields = [F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"mean{i}").alias("mean"),
                  F.col(f"std{i}").alias("std"), F.col(f"min{i}").alias("min"), F.col(f"max{i}").alias("max")]
        fields += [F.lit(v).cast("double").alias(n) for v, n in zip(marks[c], ("q25", "q50", "q75"), strict=True)]
        rows.append(F.struct(*fields))
    return wide.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def describe_text(df: DataFrame, col: str) -> DataFrame:
    """A4, text: count, unique, top (most frequent, ties by value), freq."""
    vc = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return vc.agg(F.lit(col).alias("column"),
                  F.sum("n").alias("count"),
                  F.count(F.lit(1)).alias("unique"),
                  F.min_by(F.col(col), F.struct(-F.col("n"), F.col(col))).alias("top"),
                  F.max("n").alias("freq"))


def null_count(df: DataFrame, col: str) -> DataFrame:
    """A5: missing values (NULL, and NaN for floating columns)."""
    x = F.col(col)
    missing = x.isNull()
    if dict(df.dtypes)[col] in ("double", "float"):
        missing = missing | F.isnan(x)
    return df.agg(F.lit(col).alias("column"), F.count_if(missing).alias("n_missing"))


def distinct_counts(df: DataFrame, cols, approx: bool = False) -> DataFrame:
    """Distinct values per column, exact or HyperLogLog++."""
    f = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    return df.agg(*[f(c).alias(f"n_distinct_{c}") for c in cols])


def distinct_sketches(df: DataFrame, by, cols, lg_k: int = 12) -> DataFrame:
    """A6, mergeable: one HyperLogLog sketch per group and column (``by``, column, sketch), a few KB each, to be stored."""
    wide = df.groupBy(*by).agg(*[F.hll_sketch_agg(c, F.lit(lg_k)).alias(c) for c in cols])
    return wide.select(*by, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("sketch")) for c in cols])).alias("s")) \
        .select(*by, "s.column", "s.sketch")


def distinct_from_sketches(sketches: DataFrame, by=()) -> DataFrame:
    """Distinct values per column (and ``by``) from stored sketches, merged without reading the rows again."""
    return sketches.groupBy(*by, "column").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))


# ----------------------------------------------------------------- C1 / J2 / J3
def clean_extras(extras: DataFrame, id_col: str = "track_id") -> DataFrame:
    """``b'TR...'`` text ids -> the bare id."""
    return extras.withColumn(id_col, quoted_id(id_col))


MOST_KEYS, MOST_SLOTS = 256, 2048  # keys that have tasks of their own in a join, and such tasks


def _slots(spark: SparkSession, n: int) -> list[int]:
    """One int per partition of a table that is dealt over ``n`` partitions by an int column: the smallest that falls there."""
    rows = (spark.range(40 * n).select(F.col("id").cast("int").alias("slot"))
            .groupBy(F.pmod(F.hash("slot"), F.lit(n)).alias("p")).agg(F.min("slot").alias("slot")).collect())  # n rows
    found = {r["p"]: r["slot"] for r in rows}
    return [found.get(p, 40 * n + p) for p in range(n)]


def join_per_key(rows: DataFrame, table: DataFrame, key: str, spread_by: str) -> DataFrame:
    """``rows`` LEFT ``table``, which has at most one, perhaps long row per ``key`` (J2). Rows of a key are dealt over
    several tasks by a hash of ``spread_by``, each with its copy of the key's row, so that few keys keep all cores busy.
    A file's size tells little of how long the lists made from it are, so the table is never broadcast.

    Up to ``MOST_KEYS`` keys have tasks of their own. What a task writes then holds one long value, which a columnar file
    keeps once; a second one can be too much for the dictionary of a column, and all rows of the page are written out in full.
    """
    spark = rows.sparkSession
    table = table.where(F.col(key).isNotNull())
    keys = [r[0] for r in table.select(key).limit(MOST_KEYS + 1).collect()]
    if not 0 < len(keys) <= MOST_KEYS:
        spread = 16
        copies = table.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
        dealt = rows.withColumn("_part", F.pmod(F.xxhash64(spread_by), F.lit(spread)).cast("int"))
        return dealt.join(copies.hint("merge"), [key, "_part"], "left").drop("_part")
    spread = max(1, min(MOST_SLOTS // len(keys), -(-16 * spark.sparkContext.defaultParallelism // len(keys))))
    n = max(len(keys) * spread, int(spark.conf.get("spark.sql.shuffle.partitions")))  # with fewer, the join would deal anew
    slots = F.array(*map(F.lit, _slots(spark, n)))
    number = F.try_element_at(F.create_map(*[F.lit(x) for i, k in enumerate(keys) for x in (k, i)]), F.col(key))
    slot = F.try_element_at(slots, (number * spread + F.col("_part") + 1).cast("int"))
    other = -1 - F.pmod(F.xxhash64(spread_by), F.lit(n)).cast("int")  # rows whose key is not in the table
    at = f"{key}_part"
    dealt = (rows.withColumn("_part", F.pmod(F.xxhash64(spread_by), F.lit(spread)).cast("int"))
             .withColumn(at, F.coalesce(slot, other)).drop("_part").repartition(n, at))
    copies = table.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))).withColumn(at, slot).drop("_part", key)
    return dealt.join(copies.hint("merge"), at, "left").drop(at)


def catalogue_features(tracks: DataFrame, artist_terms: DataFrame, artist_location: DataFrame,
                       extras: DataFrame | None = None, of_terms=None) -> DataFrame:
    """Terms list per artist FULL OUTER location, tracks LEFT that, LEFT acoustic extras.

    The artist tables are one row per artist; AQE broadcasts them when their runtime size is under the threshold and
    falls back to a shuffle join otherwise. They are joined last: an artist's list is as long as the artist has rows, so
    no track's row is shuffled once it has its list. ``of_terms`` turns the list into what is wanted of it (a text, its
    size) once per artist, before it is copied to the tracks.
    """
    terms = list_per_key(artist_terms, "artist_id", "term", "pos")
    if of_terms:
        terms = terms.withColumn("term", of_terms("term"))
    loc = artist_location.drop("artist_name")
    artists = terms.join(loc, "artist_id", "full_outer")           # J3 (USING: key coalesced)
    out = tracks
    if extras is not None:
        out = out.join(extras, "track_id", "left")                  # J2
    own = [c for c in tracks.columns if c not in ("track_id", "artist_id")]
    added = [c for c in (extras.columns if extras is not None else []) if c != "track_id"]
    return join_per_key(out, artists, "artist_id", "track_id").select(
        "track_id", "artist_id", *own, "term", *[c for c in loc.columns if c != "artist_id"], *added)


# ---------------------------------------------------------------- C2 / J4 / P15
def expand_array(df: DataFrame, array_col: str, n: int, prefix: str = "feature_", cast: str = "double") -> DataFrame:
    """``features[k]`` -> columns ``feature_0 .. feature_{n-1}``."""
    keep = [c for c in df.columns if c != array_col]
    return df.select(*keep, *[F.col(array_col)[k].cast(cast).alias(f"{prefix}{k}") for k in range(n)])


def dedup_rows(df: DataFrame, id_col: str) -> DataFrame:
    """Drop rows equal on every column except the id; keep the lowest id.

    A grouped min (partial + final aggregate), not a sort of the whole table.
    """
    rest = [c for c in df.columns if c != id_col]
    return df.groupBy(*rest).agg(F.min(id_col).alias(id_col)).select(id_col, *rest)


def align_features(id_map: DataFrame, features: DataFrame, factors: DataFrame, keep_cols,
                   id_col: str = "mapped_id", key_col: str = "track_id", rank: int | None = None,
                   factor_id: str = "id", factor_col: str = "features", per_key: tuple[DataFrame, str] | None = None) -> DataFrame:
    """Id map JOIN features JOIN factors (J4), keep the model columns (P1), expand (P15), dedup.

    ``per_key``: a table with one row per value of a kept column, and that column; its columns may be long. Rows equal in
    the key are equal in them, so they are joined after the dedup and neither shuffled nor compared by row.
    """
    table, key = per_key or (None, None)
    late = [c for c in table.columns if c != key] if per_key else []
    f = id_map.join(features, key_col, "inner").select(id_col, *[c for c in keep_cols if c not in late])
    fac = factors.select(F.col(factor_id).alias(id_col), factor_col)
    out = f.join(fac, id_col, "inner")
    if rank is not None:
        out = expand_array(out, factor_col, rank)
    out = dedup_rows(out, id_col)
    if per_key:
        rest = [c for c in out.columns if c not in (id_col, *keep_cols)]
        out = join_per_key(out, table, key, id_col).select(id_col, *keep_cols, *rest)
    return out


# ---------------------------------------------------------------------- E1 / E2
def project_2d(df: DataFrame, vec_col: str = "features", k: int = 2) -> DataFrame:
    """PCA to ``k`` coordinates over the whole item set (covariance by tree aggregation)."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array
    v = df.withColumn("_v", array_to_vector(vec_col))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(v)
    out = model.transform(v).withColumn("_pa", vector_to_array("_p"))
    keep = [c for c in df.columns if c != vec_col]
    return out.select(*keep, *[F.col("_pa")[i].alias(f"x{i}") for i in range(k)])


def captured_variance(coords: DataFrame, k: int = 2) -> DataFrame:
    """Per coordinate of :func:`project_2d` its sample variance, and its covariance with the next one (0 for
    principal components; the last has the first as next)."""
    pairs = [(i, (i + 1) % k) for i in range(k)]
    one = coords.agg(*[F.var_samp(f"x{i}").alias(f"v{i}") for i in range(k)],
                     *[F.covar_samp(f"x{i}", f"x{j}").alias(f"c{i}") for i, j in pairs])
    rows = ", ".join(f"{i}, v{i}, c{i}" for i in range(k))
    return one.selectExpr(f"stack({k}, {rows}) AS (component, variance, covariance)")


def genre_table(items: DataFrame, item_terms: DataFrame, id_col: str = "id", terms_col: str = "term",
                spelling: str = "raggae", drop_other: bool = True) -> DataFrame:
    """Items LEFT first term (P7) -> recode (P6) -> allowlist (P5) -> drop 'other' (P3)."""
    j = items.join(item_terms.select(id_col, terms_col), id_col, "left")
    out = j.withColumn("genre", genre_label(first_element(terms_col), spelling)).drop(terms_col)
    return keep_not_equal(out, "genre", "other") if drop_other else out
