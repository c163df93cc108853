"""Parquet scans of the input tables (S1) and the stand-in views over them.

Every view is a lazy DataFrame: projections and filters applied by callers reach
the parquet scan (``PushedFilters`` / pruned ``ReadSchema``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table by name."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


class Tables:
    """Lazy accessor ``t.orders``, ``t.lineitem`` ... for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)


# ----------------------------------------------------------------- stand-ins
def plays(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """``plays(user_id, track_id, count)``: purchases of a part by a customer.

    One shuffle join on the order key, then a partial+final aggregate on the
    (customer, part) pair, so a hot customer is split across map-side combiners.
    """
    o = orders.select("o_orderkey", "o_custkey")
    li = lineitem.select("l_orderkey", "l_partkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .groupBy("o_custkey", "l_partkey")
            .agg(F.count(F.lit(1)).cast("int").alias("count"))
            .select(F.col("o_custkey").cast("string").alias("user_id"),
                    F.col("l_partkey").cast("string").alias("track_id"),
                    "count"))


def played_tracks(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """The distinct ``track_id`` of :func:`plays`: lines that have an order, without counting them per user."""
    return (lineitem.select("l_orderkey", "l_partkey")
            .join(orders.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
            .select("l_partkey").distinct()
            .select(F.col("l_partkey").cast("string").alias("track_id")))


def catalog(part: DataFrame) -> DataFrame:
    """Track metadata: one row per part."""
    return part.select(
        F.col("p_partkey").cast("string").alias("track_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("artist_id"),
        F.col("p_type").alias("release"),
        F.col("p_size").cast("double").alias("duration"),
    )


# Stand-in term texts, chosen by the part key; with the part's type behind two thirds of them.
TERM_WORDS = (
    "pop rock", "hip hop", "classic rock", "pop", "country", "soul", "jazz", "blues", "electro", "heavy metal", "folk",
    "raggae", "trip hop", "rap", "reggae", "disco", "house", "dance", "ccm", "ambient", "new wave", "spoken word",
)


def artist_term(part: DataFrame) -> DataFrame:
    """``artist_term(artist_id, term, pos)``: one row per tag, repeats kept; ``pos`` is the input order."""
    word = F.element_at(F.array(*map(F.lit, TERM_WORDS)), (F.col("p_partkey") % len(TERM_WORDS) + 1).cast("int"))
    term = F.when(F.col("p_partkey") % 3 == 0, word).otherwise(F.concat_ws(" ", word, F.lower("p_type")))
    return part.select(F.col("p_brand").alias("artist_id"), term.alias("term"), F.col("p_partkey").alias("pos"))


def artist_location(nation: DataFrame, region: DataFrame) -> DataFrame:
    """``artist_location(artist_id, latitude, longitude, artist_name, location)``, one row per artist."""
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
            .select(F.concat(F.lit("Brand#"), F.col("n_nationkey").cast("string")).alias("artist_id"),
                    F.col("n_nationkey").cast("double").alias("latitude"),
                    F.col("n_regionkey").cast("double").alias("longitude"),
                    F.col("n_name").alias("artist_name"),
                    F.col("r_name").alias("location")))


def item_factors(embeddings: DataFrame) -> DataFrame:
    """``item_factors(id, features, label)`` from the embedding table (unit-norm rows)."""
    return embeddings.select(F.col("vec_id").cast("int").alias("id"),
                             F.col("embedding").alias("features"),
                             F.col("label"))


def scaled_factors(embeddings: DataFrame) -> DataFrame:
    """Factors scaled by ``1 + id % 7`` so that dot-product and cosine rankings differ."""
    return embeddings.select(
        F.col("vec_id").cast("int").alias("id"),
        F.transform("embedding", lambda x: (x * (F.lit(1) + F.col("vec_id") % 7)).cast("float")).alias("features"),
        F.col("label"))


def releases(lineitem: DataFrame) -> DataFrame:
    """``releases(track_id, releasedate)``: ship dates per part as ``YYYY-MM-DD`` text."""
    return lineitem.select(F.col("l_partkey").cast("string").alias("track_id"),
                           F.date_format("l_shipdate", "yyyy-MM-dd").alias("releasedate"))


def acoustic_extras(lineitem: DataFrame) -> DataFrame:
    """``additional_features(track_id, loudness, song_hotttnesss, tempo)``, ids as ``b'...'`` text.

    Per-part averages of line values (one partial + final aggregate). Sums of
    cent amounts are rounded back to cents before dividing, so the result does
    not depend on the order in which partial sums were combined.
    """
    def cents_avg(c):
        return F.round(F.sum(c), 2) / F.count(c)
    return (lineitem.groupBy("l_partkey")
            .agg(cents_avg("l_extendedprice").alias("loudness"),
                 cents_avg("l_discount").alias("song_hotttnesss"),
                 F.avg("l_quantity").alias("tempo"))
            .select(F.concat(F.lit("b'"), F.col("l_partkey").cast("string"), F.lit("'")).alias("track_id"),
                    "loudness", "song_hotttnesss", "tempo"))


def dated_releases(lineitem: DataFrame) -> DataFrame:
    """``releases(track_id, releasedate)`` with the ``'0000-00-00'`` sentinel on open lines."""
    return lineitem.select(
        F.col("l_partkey").cast("string").alias("track_id"),
        F.when(F.col("l_linestatus") == "O", F.lit("0000-00-00"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("releasedate"))


def event_plays(events: DataFrame, event_types=("view", "click", "purchase")) -> DataFrame:
    """A second ``plays(user_id, track_id, count)`` source: events whose JSON ``props`` name an item.

    The item id is the ``k`` field of the JSON payload (``get_json_object``,
    no Python parsing); counts are a partial + final aggregate per pair.
    """
    item = F.get_json_object(F.col("props"), "$.k")
    return (events.where(F.col("event_type").isin(*event_types) & item.isNotNull())
            .groupBy(F.col("user_id").cast("string").alias("user_id"), item.alias("track_id"))
            .agg(F.count(F.lit(1)).cast("int").alias("count")))
