"""Song-catalogue maintenance as set operations.

The source workload runs these one song at a time (a query per song, a loop per
file). Here each is a join / aggregate over whole tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from cadenza.functions import year_of_date
from cadenza.operators.interactions import random_neighbours
from cadenza.operators.ordering import offsets_within
from cadenza.session import reliable_checkpoint

NO_DATE = "0000-00-00"


# ------------------------------------------------------------------------ J6 / U2
def skip_known(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not already stored (left anti join)."""
    return df.join(known.select(key), key, "left_anti")


def union_distinct(dfs) -> DataFrame:
    """Union by name, each row once."""
    return reduce(lambda a, b: a.unionByName(b), dfs).distinct()


# ---------------------------------------------------------------------------- J8
def resolve_release_year(songs: DataFrame, artist: DataFrame, track: DataFrame, albumjoin: DataFrame,
                         album: DataFrame, release: DataFrame) -> DataFrame:
    """Earliest release year per song, or 0.

    ``songs(song_id, artist_gid, artist_name, title, release)``; relations
    ``artist(id, gid, name)``, ``track(id, name, artist)``, ``albumjoin(track, album)``,
    ``album(id, name, artist)``, ``release(album, releasedate)``.

    A song whose gid is known is matched to that artist only (no fall-back to the
    name even when nothing matches); otherwise to every artist with the same
    lower-cased name. Step 1: tracks of the artist with the same lower-cased
    title, through albumjoin -> album -> release. Step 2 (only when step 1 finds
    nothing): albums of the artist with the same lower-cased name as the
    song's release. Sentinel dates are ignored; the minimum date string wins.
    The per-song lookups of the source become four equi-joins over all songs. Songs without a gid (NULL or '',
    often a large share) never enter the gid join, and the matched artists are stored once for both steps.
    """
    s = songs.select("song_id", "artist_gid", "artist_name", "title", "release")
    has_gid = F.coalesce(F.col("artist_gid"), F.lit("")) != ""
    by_gid = (s.where(has_gid).join(artist.select(F.col("gid").alias("artist_gid"), F.col("id").alias("artist_ref")),
                     "artist_gid", "left"))
    known = by_gid.where(F.col("artist_ref").isNotNull())
    unknown = by_gid.where(F.col("artist_ref").isNull()).drop("artist_ref").unionByName(s.where(~has_gid))
    by_name = unknown.join(artist.select(F.lower("name").alias("_an"), F.col("id").alias("artist_ref")),
                           F.lower(unknown.artist_name) == F.col("_an"), "inner").drop("_an")
    song_artist = known.unionByName(by_name).select(
        "song_id", "artist_ref", F.lower("title").alias("_title"), F.lower("release").alias("_release")).transform(
        reliable_checkpoint)

    dated = release.where(F.col("releasedate") != F.lit(NO_DATE)).select(
        F.col("album").alias("_album"), "releasedate")
    t = track.select(F.col("id").alias("_track"), F.lower("name").alias("_title"), F.col("artist").alias("artist_ref"))
    step1 = (song_artist.join(t, ["artist_ref", "_title"])
             .join(albumjoin.select(F.col("track").alias("_track"), F.col("album").alias("_album")), "_track")
             .join(album.select(F.col("id").alias("_album")), "_album")
             .join(dated, "_album")
             .groupBy("song_id").agg(F.min("releasedate").alias("d1"))).transform(reliable_checkpoint)
    al = album.select(F.col("id").alias("_album"), F.lower("name").alias("_release"), F.col("artist").alias("artist_ref"))
    step2 = (song_artist.join(step1, "song_id", "left_anti").join(al, ["artist_ref", "_release"])
             .join(dated, "_album")
             .groupBy("song_id").agg(F.min("releasedate").alias("d2")))
    return (s.select("song_id")
            .join(step1, "song_id", "left")
            .join(step2, "song_id", "left")
            .select("song_id", F.coalesce(year_of_date("d1"), year_of_date("d2"), F.lit(0)).alias("year")))


# ----------------------------------------------------------------------- J9 / W1
def artist_tags(artist: DataFrame, artist_tag: DataFrame, tag: DataFrame, max_tags: int = 20) -> DataFrame:
    """J9 + W1: at most ``max_tags`` tags per artist gid by count desc (ties by name, id).

    Output ``(gid, tags array<string>, tag_counts array<int>)``, two aligned lists.
    ``row_number() <= n`` is planned as a window group limit (top-n per artist
    before and after the shuffle), so the final lists are bounded by n.
    """
    j = (artist.select(F.col("id").alias("artist"), "gid")
         .join(artist_tag.select("artist", "tag", "count"), "artist")
         .join(tag.select(F.col("id").alias("tag"), F.col("name").alias("tag_name")), "tag"))
    w = Window.partitionBy("gid").orderBy(F.col("count").desc(), F.col("tag_name"), F.col("tag"))
    top = j.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= max_tags)
    agg = top.groupBy("gid").agg(F.array_sort(F.collect_list(F.struct("_rn", "tag_name", "count"))).alias("_l"))
    return agg.select("gid", F.col("_l.tag_name").alias("tags"), F.col("_l.count").alias("tag_counts"))


def cap_per_group(df: DataFrame, key: str, order_cols, n: int) -> DataFrame:
    """At most ``n`` rows per key in the given order (window group limit)."""
    w = Window.partitionBy(key).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


# ------------------------------------------------------------------ A17 / J10 / W3
def pack_arrays(songs: DataFrame, file_col: str, order_col: str, array_col: str):
    """Per file, song rows get ``songidx`` and start offset ``idx`` into one flat child table.

    Returns ``(songs_with_offsets, children(file, pos, value))``. Offsets are a
    running ``sum(size(array))`` per file computed without a per-file window
    (see :mod:`cadenza.operators.ordering`), so one huge file is not one task.
    """
    base = songs.withColumn("_n", F.coalesce(F.size(array_col), F.lit(0)))
    with_idx = offsets_within(base, [file_col], [order_col], {"idx": "_n", "songidx": F.lit(1)})
    children = with_idx.select(file_col, "idx", F.posexplode(array_col).alias("_k", "value")).select(
        file_col, (F.col("idx") + F.col("_k")).alias("pos"), "value")
    return with_idx.drop("_n", array_col), children


def pack_rows(songs: DataFrame, children: DataFrame, file_col: str, song_key: str, child_order, value_col: str):
    """A17 from long-form child rows (no per-song arrays are ever built).

    ``songs(file, song_key, ...)``, ``children(song_key, <child_order...>, value)``.
    Returns ``(songs + idx + songidx, children(file, pos, value))`` where ``pos``
    is the child's position in its file (songs in key order, children in
    ``child_order``) and ``idx`` the first position of each song. Both come from
    distributed prefix sums, so neither a huge file nor a huge song is one task.
    """
    sizes = children.groupBy(song_key).agg(F.count(F.lit(1)).alias("_n"))
    s = songs.join(sizes, song_key, "left").withColumn("_n", F.coalesce(F.col("_n"), F.lit(0)))
    s = offsets_within(s, [file_col], [song_key], {"idx": "_n", "songidx": F.lit(1)}).drop("_n")
    kids = children.join(songs.select(song_key, file_col), song_key)
    kids = offsets_within(kids, [file_col], [song_key] + list(child_order), F.lit(1), "pos")
    return s, kids.select(file_col, "pos", value_col)


def ragged_slices(songs: DataFrame, children: DataFrame, file_col: str = "file", idx_col: str = "idx",
                  songidx_col: str = "songidx", pos_col: str = "pos", value_col: str = "value",
                  out_col: str = "values", bucket: int = 1024) -> DataFrame:
    """J10 + W3: song i of a file gets the child values at ``[idx_i, idx_{i+1})``; the last runs to the end.

    W3, the next row's offset, is ``lead(idx)`` in file order; it is computed as
    an equi join on ``(file, songidx + 1)`` so that a file holding a third of all
    songs is not one window task. The range join is made an equi join too:
    positions are bucketed by ``pos div bucket`` and each song's range is
    exploded over the buckets it covers, so a file with millions of songs never
    forms one group of all pairs. Songs with an empty range get ``[]``.
    """
    end = children.groupBy(file_col).agg((F.max(pos_col) + 1).alias("_end"))
    nxt = songs.select(file_col, (F.col(songidx_col) - 1).alias(songidx_col), F.col(idx_col).alias("_hi"))
    s = (songs.join(nxt, [file_col, songidx_col], "left")
         .join(end, file_col, "left")
         .withColumn("_hi", F.coalesce(F.col("_hi"), F.col("_end"), F.col(idx_col)))
         .drop("_end"))
    b = F.lit(bucket)
    ranges = s.select(file_col, songidx_col, F.col(idx_col).alias("_lo"), "_hi").withColumn(
        "_b", F.explode(F.when(F.col("_hi") > F.col("_lo"),
                               F.sequence((F.col("_lo") / b).cast("long"), ((F.col("_hi") - 1) / b).cast("long")))
                        .otherwise(F.array().cast("array<long>"))))
    c = children.withColumn("_b", (F.col(pos_col) / b).cast("long"))
    hits = (ranges.join(c, [file_col, "_b"])
            .where((F.col(pos_col) >= F.col("_lo")) & (F.col(pos_col) < F.col("_hi")))
            .groupBy(file_col, songidx_col)
            .agg(F.array_sort(F.collect_list(F.struct(pos_col, value_col))).alias("_v")))
    vtype = children.schema[value_col].dataType.simpleString()
    out = s.join(hits, [file_col, songidx_col], "left")
    return out.withColumn(out_col, F.coalesce(F.col(f"_v.{value_col}"), F.array().cast(f"array<{vtype}>"))
                          ).drop("_v", "_hi")


# ---------------------------------------------------------------------------- J11
def lookup_name_pairs(pairs: DataFrame, songs: DataFrame, artist_col: str = "artist_name",
                      title_col: str = "title", id_col: str = "song_id") -> DataFrame:
    """Each (artist, title) pair -> one song with the same trimmed, lower-cased names (lowest id)."""
    key = [F.lower(F.trim(F.col(artist_col))).alias("_a"), F.lower(F.trim(F.col(title_col))).alias("_t")]
    p = pairs.select("*", *key)
    s = songs.select(F.col(id_col), *key)
    m = s.groupBy("_a", "_t").agg(F.min(id_col).alias(id_col))
    return p.join(m, ["_a", "_t"], "left").drop("_a", "_t")


# ------------------------------------------------------------------ A14 / T3 / T4
def leaf_occupancy(files: DataFrame, path_col: str = "path"):
    """Files per leaf directory -> ``(stats, extremes)``.

    ``stats`` is one row (min / max / average / total files per leaf, leaf
    count); ``extremes`` lists the emptiest and fullest leaves as rows
    ``(leaf, n, kind)``, found by equi-joining the counts with the one-row
    stats (broadcast), so no set is collected into one value.
    """
    leaves = files.withColumn("leaf", F.regexp_extract(F.col(path_col), r"^(.*)/[^/]*$", 1)).groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n"))
    stats = leaves.agg(F.min("n").alias("min_files"), F.max("n").alias("max_files"),
                       F.avg("n").alias("avg_files"), F.sum("n").alias("total_files"),
                       F.count(F.lit(1)).alias("n_leaves"))
    low = leaves.join(F.broadcast(stats.select(F.col("min_files").alias("n"))), "n").withColumn("kind", F.lit("emptiest"))
    high = leaves.join(F.broadcast(stats.select(F.col("max_files").alias("n"))), "n").withColumn("kind", F.lit("fullest"))
    return stats, low.unionByName(high).select("leaf", "n", "kind")


def most_recent(files: DataFrame, n: int = 5, time_col: str = "modificationTime", id_col: str = "path") -> DataFrame:
    """The ``n`` newest rows (per-task top-n, one bounded merge), with the time as display text."""
    return (files.orderBy(F.col(time_col).desc(), F.col(id_col)).limit(n)
            .withColumn("modified", F.date_format(F.col(time_col), "yyyy-MM-dd HH:mm:ss")))


def overflow(files: DataFrame, limit: int, time_col: str = "modificationTime", id_col: str = "path") -> DataFrame:
    """T4: the newest ``count - limit`` rows: what a trim would remove (listed, never deleted).

    The excess can be any size, so instead of one ``limit(excess)`` merge task the
    rows get their rank from a distributed prefix sum and are filtered by it.
    """
    from cadenza.operators.ordering import exclusive_prefix_sum
    excess = max(0, files.count() - limit)
    ranked = exclusive_prefix_sum(files, [F.col(time_col).desc(), F.col(id_col)], F.lit(1), "_rank")
    return ranked.where(F.col("_rank") < excess).drop("_rank")


# ---------------------------------------------------------------------------- A15
def enrichment_coverage(songs: DataFrame, checks: dict) -> DataFrame:
    """How many records got each enrichment (``name -> boolean column``), one row."""
    return songs.agg(F.count(F.lit(1)).alias("n_records"),
                     *[F.count_if(c).alias(f"n_{name}") for name, c in checks.items()])


# ---------------------------------------------------------------------------- A19
def health_check(df: DataFrame, rules: dict, expected_rows: int | None = None):
    """One pass counting rule violations per rule, plus the row-count assertion.

    Returns ``(report, quarantine)``: ``report`` is one row; ``quarantine`` holds
    the offending rows with the list of failed rules (lazy, written by the caller).
    """
    bad = {name: ~F.coalesce(cond, F.lit(False)) for name, cond in rules.items()}
    aggs = [F.count(F.lit(1)).alias("n_rows")] + [F.count_if(b).alias(f"bad_{n}") for n, b in bad.items()]
    report = df.agg(*aggs)
    if expected_rows is not None:
        report = report.withColumn("expected_rows", F.lit(expected_rows).cast("long"))
        ok = F.col("n_rows") == F.col("expected_rows")
    else:
        ok = F.lit(True)
    for n in bad:
        ok = ok & (F.col(f"bad_{n}") == 0)
    report = report.withColumn("ok", ok)
    failed = F.filter(F.array(*[F.when(b, F.lit(n)) for n, b in bad.items()]), lambda x: x.isNotNull())
    quarantine = df.withColumn("failed_rules", failed).where(F.size("failed_rules") > 0)
    return report, quarantine


def quarantine(df: DataFrame, rules: dict, path: str) -> tuple[dict, DataFrame]:
    """A19 in one pass: write the offending rows with the rules that they fail, and count rows and violations on the way.

    Returns the observed counts (``n_rows``, ``bad_<rule>``, ``n_quarantined``) and the written rows."""
    bad = {name: ~F.coalesce(cond, F.lit(False)) for name, cond in rules.items()}
    failed = F.filter(F.array(*[F.when(b, F.lit(n)) for n, b in bad.items()]), lambda x: x.isNotNull())
    seen = Observation()
    rows = df.withColumn("failed_rules", failed).observe(
        seen, F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.array_contains("failed_rules", n)).alias(f"bad_{n}") for n in bad],
        F.count_if(F.size("failed_rules") > 0).alias("n_quarantined"))
    kept = rows.where(F.size("failed_rules") > 0)
    kept.write.parquet(path)
    return seen.get, df.sparkSession.read.schema(kept.schema).parquet(path)


# ---------------------------------------------------------------------------- T5
def multi_key_top_k(df: DataFrame, id_col: str, attrs, n: int = 100, slices: int = 64) -> DataFrame:
    """T5: the ``n`` best rows for every attribute, ascending and descending; union, dedup.

    One scan: the attributes are unpivoted with ``stack``; a first ``row_number() <= n`` per
    (attribute, slice of the ids) leaves at most n rows per slice, so that the second, per attribute, meets
    slices x n rows whatever the table's size. NULL attribute values are not ranked.
    """
    stack = "stack({}, {})".format(len(attrs), ", ".join(f"'{a}', cast(`{a}` as double)" for a in attrs))
    long = df.select(id_col, F.expr(stack).alias("attr", "value")).where(F.col("value").isNotNull())
    long = long.withColumn("_slice", F.pmod(F.xxhash64(id_col), F.lit(slices)))

    def best(value):
        out = long
        for keys in (("attr", "_slice"), ("attr",)):
            w = Window.partitionBy(*keys).orderBy(value, F.col(id_col))
            out = out.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
        return out.select(id_col)

    return best(F.col("value").asc()).union(best(F.col("value").desc())).distinct()


# ----------------------------------------------------------------------------- G1
def expand_graph(edges: DataFrame, seeds: DataFrame, n_neighbours: int = 10, budget: int | None = None,
                 seed: int = 0, node_col: str = "node", src: str = "src", dst: str = "dst") -> DataFrame:
    """G1: breadth-first expansion from ``seeds`` over ``edges``, level by level.

    Each round: frontier JOIN edges, keep ``n_neighbours`` sampled neighbours per
    node (R7, sampled before the visited filter as in the source), anti join the
    visited set, union. A node is visited when queued. Nodes without neighbours
    end their branch. The loop ends when the frontier is empty, or once the
    caller's ``budget`` of nodes is visited (the last round is kept whole).
    Only the new frontier is checkpointed in a round; the visited set is the union of
    the frontiers, merged into one checkpoint every ten rounds. Output ``(node, round)``.
    """
    # Every round joins the same sampled neighbour lists: materialise them once (at most n per node).
    sampled = random_neighbours(edges.select(src, dst).distinct(), n_neighbours, seed, src, dst).transform(
        reliable_checkpoint)
    visited = seeds.select(F.col(node_col)).distinct().withColumn("round", F.lit(0)).transform(reliable_checkpoint)
    frontier, total, r = visited, visited.count() if budget is not None else 0, 0
    while budget is None or total < budget:
        r += 1
        nxt = (frontier.join(sampled, frontier[node_col] == sampled[src])
               .select(F.col(dst).alias(node_col)).distinct())
        frontier = (nxt.join(visited.select(node_col), node_col, "left_anti").withColumn("round", F.lit(r))
                    .transform(reliable_checkpoint))
        added = frontier.count() if budget is not None else int(not frontier.isEmpty())
        if not added:
            break
        total += added
        visited = visited.unionByName(frontier)
        if r % 10 == 0:
            visited = visited.transform(reliable_checkpoint)
    return visited


# ------------------------------------------------------------------ P14 / A17
def song_fields(songs: DataFrame, names) -> DataFrame:
    """Project record fields by name, from flat columns or from structs of fields (``metadata``, ``analysis``,
    ...); parquet then reads only those columns or subfields. A name in no place or in several is an error."""
    paths: dict = {}
    for f in songs.schema.fields:
        found = [(n, f"`{f.name}`.`{n}`") for n in f.dataType.names] if f.dataType.typeName() == "struct" else []
        for name, path in [(f.name, f"`{f.name}`"), *found]:
            paths.setdefault(name, []).append(path)
    unknown = [n for n in names if n not in paths]
    if unknown:
        raise KeyError(f"unknown song fields: {unknown}")
    several = [n for n in names if len(paths[n]) > 1]
    if several:
        raise KeyError(f"song fields in several groups: {several}")
    return songs.select(*[F.col(paths[n][0]).alias(n) for n in names])


def _without_arrays(f):
    """The field as a column without arrays: None for an array, a struct of the rest for a struct."""
    kind = f.dataType.typeName()
    if kind == "array":
        return None
    if kind != "struct":
        return F.col(f"`{f.name}`")
    inner = [g.name for g in f.dataType.fields if g.dataType.typeName() != "array"]
    kept = F.struct(*[F.col(f"`{f.name}`.`{n}`").alias(n) for n in inner]) if inner else None
    return kept if kept is None else F.when(F.col(f"`{f.name}`").isNotNull(), kept).alias(f.name)


def pack_songs(tables, keep_arrays: bool = True) -> DataFrame:
    """Many song tables -> one (``aggregate``: arrays kept; ``summary``: array columns and the arrays of the
    record's structs dropped). Fields that a table lacks are null."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    if not keep_arrays:
        out = out.select(*[c for c in map(_without_arrays, out.schema.fields) if c is not None])
    return out
