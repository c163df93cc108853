"""Stand-ins for the music-database relations and the song records that are looked up in them.

``artist`` <- supplier, ``track`` <- lineitem x part, ``albumjoin`` <- lineitem,
``album`` <- orders (artist = lowest supplier of the order), ``release`` <- orders
(pending orders carry the ``'0000-00-00'`` sentinel), ``artist_tag`` <- lines per
(supplier, part), ``tag`` <- part. Song records come from ``part``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _track_id():
    return (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long")


def artist(supplier: DataFrame) -> DataFrame:
    return supplier.select(F.col("s_suppkey").alias("id"), F.concat(F.lit("gid-"), F.col("s_suppkey").cast("string")).alias("gid"),
                           F.col("s_name").alias("name"))


def track(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return li.join(part.select("p_partkey", "p_name"), li.l_partkey == part.p_partkey).select(
        _track_id().alias("id"), F.col("p_name").alias("name"), F.col("l_suppkey").alias("artist"))


def albumjoin(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(_track_id().alias("track"), F.col("l_orderkey").alias("album"))


def album(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    first = lineitem.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("artist"))
    return orders.select("o_orderkey", "o_orderpriority").join(first, orders.o_orderkey == first.l_orderkey).select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"), "artist")


def release(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("o_orderkey").alias("album"),
                         F.when(F.col("o_orderstatus") == "P", F.lit("0000-00-00"))
                         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("releasedate"))


def artist_tag(lineitem: DataFrame) -> DataFrame:
    return lineitem.groupBy(F.col("l_suppkey").alias("artist"), F.col("l_partkey").alias("tag")).agg(
        F.count(F.lit(1)).cast("int").alias("count"))


def tag(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))


def song_records(part: DataFrame, lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """``songs(song_id, artist_gid, artist_name, title, release)`` with known, unknown, empty and
    known-but-wrong artist ids, upper-cased names (matching is case-insensitive)."""
    sup = lineitem.groupBy("l_partkey").agg(F.min("l_suppkey").alias("sup"))
    p = part.join(sup, part.p_partkey == sup.l_partkey, "left")
    gid = (F.when(F.col("sup").isNull(), F.lit(""))
           .when(F.col("p_size") >= 40, F.concat(F.lit("gid-"), (F.col("sup") + 1).cast("string")))
           .when(F.col("p_size") >= 20, F.concat(F.lit("gid-"), F.col("sup").cast("string")))
           .when(F.col("p_size") >= 10, F.concat(F.lit("gid-unknown-"), F.col("sup").cast("string")))
           .otherwise(F.lit("")))
    rel = F.when(F.col("p_size") % 2 == 0, F.lit("1-urgent")).otherwise(F.lower("p_type"))
    s = supplier.select("s_suppkey", "s_name")
    return (p.join(s, p.sup == s.s_suppkey, "left")
            .select(F.col("p_partkey").alias("song_id"), gid.alias("artist_gid"),
                    F.upper("s_name").alias("artist_name"), F.upper("p_name").alias("title"), rel.alias("release")))


def song_table(part: DataFrame, lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """Song records with scalar fields and two array fields of bounded length (``p_size`` entries)."""
    lines = lineitem.groupBy("l_partkey").agg(
        F.avg("l_quantity").alias("tempo"),
        (F.round(F.sum("l_discount"), 2) / F.count("l_discount")).alias("song_hotttnesss"))
    recs = song_records(part, lineitem, supplier)
    p = part.select(F.col("p_partkey").alias("song_id"), F.col("p_size").cast("double").alias("duration"),
                    F.col("p_retailprice").alias("loudness"), F.col("p_brand").alias("artist_id"),
                    F.col("p_size").alias("_n"))
    seg = F.sequence(F.lit(0), F.col("_n") - 1).cast("array<double>")
    return (recs.join(p, "song_id")
            .join(lines, recs.song_id == lines.l_partkey, "left")
            .select("song_id", F.concat(F.lit("TR"), F.col("song_id").cast("string")).alias("track_id"),
                    "artist_id", "artist_name", "title", "release", "duration", "loudness", "tempo",
                    "song_hotttnesss", seg.alias("segments_start"),
                    F.transform(seg, lambda x: x / F.col("duration")).alias("segments_confidence")))


# The names of the song record's fields, by group.
RECORD_FIELDS = {
    "metadata": (
        "artist_familiarity", "artist_hotttnesss", "artist_id", "artist_mbid", "artist_playmeid", "artist_7digitalid",
        "artist_latitude", "artist_longitude", "artist_location", "artist_name", "release", "release_7digitalid",
        "song_id", "song_hotttnesss", "title", "track_7digitalid",
        "similar_artists", "artist_terms", "artist_terms_freq", "artist_terms_weight"),
    "analysis": (
        "analysis_sample_rate", "audio_md5", "danceability", "duration", "end_of_fade_in", "energy", "key",
        "key_confidence", "loudness", "mode", "mode_confidence", "start_of_fade_out", "tempo", "time_signature",
        "time_signature_confidence", "track_id",
        "segments_start", "segments_confidence", "segments_pitches", "segments_timbre", "segments_loudness_max",
        "segments_loudness_max_time", "segments_loudness_start", "sections_start", "sections_confidence",
        "beats_start", "beats_confidence", "bars_start", "bars_confidence", "tatums_start", "tatums_confidence"),
    "musicbrainz": ("year", "artist_mbtags", "artist_mbtags_count"),
}


def nested_records(part: DataFrame, lineitem: DataFrame, supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """The whole song record, one row per part: a struct per group of :data:`RECORD_FIELDS`.

    Arrays are as long as the part's size says (at most 50); pitches and timbre are arrays of 12 values. Songs
    without a sale have no tempo, hotness or place; absent texts are ``''``, absent ids -1, an absent year 0.
    """
    lines = lineitem.groupBy("l_partkey").agg(
        F.min("l_suppkey").alias("sup"), F.avg("l_quantity").alias("tempo"),
        (F.round(F.sum("l_discount"), 2) / F.count("l_discount")).alias("hot"), F.year(F.min("l_shipdate")).alias("year"))
    place = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey).select("s_suppkey", "n_nationkey", "n_regionkey", "r_name")
    names = song_records(part, lineitem, supplier)
    songs = part.join(lines, part.p_partkey == lines.l_partkey, "left").join(names, part.p_partkey == names.song_id).join(
        place, F.col("sup") == F.col("s_suppkey"), "left")
    size, key = F.col("p_size"), F.col("p_partkey")

    def ramp(n, step):
        """n values 0, step, 2 step, ..."""
        return F.transform(F.slice(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), 1, n), lambda i: i * F.lit(float(step)))

    def rows(n, sign):
        twelve = F.sequence(F.lit(0), F.lit(11))
        return F.transform(ramp(n, 1), lambda i: F.transform(twelve, lambda j: i + F.lit(sign / 16) * j))

    def whole(c):
        return F.floor(c).cast("int")

    terms = F.array(F.lower("p_type"), F.lower("p_brand"))
    similar = F.transform(ramp(size % 6, 1), lambda i: F.concat(F.lit("Brand#"), (i + 1).cast("int").cast("string")))
    values = {
        "artist_familiarity": size / 64.0, "artist_hotttnesss": size / 128.0, "artist_id": F.col("p_brand"),
        "artist_mbid": F.col("artist_gid"), "artist_playmeid": F.coalesce("sup", F.lit(-1)).cast("int"),
        "artist_7digitalid": (key % 1000).cast("int"), "artist_latitude": F.col("n_nationkey").cast("double"),
        "artist_longitude": F.col("n_regionkey").cast("double"), "artist_location": F.coalesce("r_name", F.lit("")),
        "artist_name": F.coalesce("artist_name", F.lit("")), "release": F.coalesce("release", F.lit("")),
        "release_7digitalid": (key % 97).cast("int"), "song_id": F.concat(F.lit("SO"), key.cast("string")),
        "song_hotttnesss": F.col("hot"), "title": F.coalesce("title", F.lit("")), "track_7digitalid": (key % 89).cast("int"),
        "similar_artists": similar, "artist_terms": terms, "artist_terms_freq": F.array(F.lit(1.0), size / 64.0),
        "artist_terms_weight": F.array(F.lit(0.5), size / 128.0),
        "analysis_sample_rate": F.lit(22050), "audio_md5": F.md5("p_name"), "danceability": size / 32.0,
        "duration": size.cast("double"), "end_of_fade_in": size / 16.0, "energy": size / 8.0, "key": size % 12,
        "key_confidence": (size % 4) / 4.0, "loudness": F.col("p_retailprice"), "mode": size % 2,
        "mode_confidence": (size % 8) / 8.0, "start_of_fade_out": size * 0.75, "tempo": F.col("tempo"),
        "time_signature": size % 3 + 3, "time_signature_confidence": (size % 2) / 2.0,
        "track_id": F.concat(F.lit("TR"), key.cast("string")),
        "segments_start": ramp(size, 1), "segments_confidence": ramp(size, 0.25), "segments_pitches": rows(size, 1),
        "segments_timbre": rows(size, -1), "segments_loudness_max": ramp(size, 0.5),
        "segments_loudness_max_time": ramp(size, 0.125), "segments_loudness_start": ramp(size, 2),
        "sections_start": ramp(whole(size / 8), 8), "sections_confidence": ramp(whole(size / 8), 0.5),
        "beats_start": ramp(whole(size / 2), 2), "beats_confidence": ramp(whole(size / 2), 0.25),
        "bars_start": ramp(whole(size / 4), 4), "bars_confidence": ramp(whole(size / 4), 0.125),
        "tatums_start": ramp(size, 0.5), "tatums_confidence": ramp(size, 0.125),
        "year": F.coalesce("year", F.lit(0)), "artist_mbtags": F.slice(terms, 1, 1),
        "artist_mbtags_count": F.array(size % 5),
    }
    return songs.select(*[F.struct(*[values[f].alias(f) for f in fields]).alias(group) for group, fields in RECORD_FIELDS.items()])
