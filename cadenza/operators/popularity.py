"""Popularity rankings: A18 (most familiar n), T6 (top terms) and the baseline recommender."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n_by(df: DataFrame, key_col: str, score, n: int, score_name: str = "score",
             pos_col: str = "pos") -> DataFrame:
    """Aggregate ``score`` per key, keep the best ``n`` (score desc, key asc), number them 0..n-1.

    The aggregate is partial + final (a hot key is pre-combined on the map side);
    ``orderBy().limit(n)`` plans as a per-task top-n and one merge of bounded size.
    """
    agg = df.groupBy(key_col).agg(score.alias(score_name))
    top = agg.orderBy(F.col(score_name).desc(), F.col(key_col).asc()).limit(n)
    # At most n rows remain, so the unpartitioned window below is bounded.
    w = Window.orderBy(F.col(score_name).desc(), F.col(key_col).asc())
    return top.withColumn(pos_col, (F.row_number().over(w) - 1).cast("int"))


def popularity_ranking(interactions: DataFrame, item_col: str, count_col: str, k: int) -> DataFrame:
    """The ``k`` most played items: ``(pos, item, score)`` with score = total plays."""
    return top_n_by(interactions, item_col, F.sum(count_col).cast("double"), k)


def top_terms(artist_terms: DataFrame, term_col: str, n: int, among: int | None = None) -> DataFrame:
    """The ``n`` most used terms (optionally taken from the ``among`` most used).

    With ``among`` the source picks the first n of the top ``among`` by use count,
    which for a strict ranking is the same as the top n.
    """
    k = min(n, among) if among else n
    return top_n_by(artist_terms, term_col, F.count(F.lit(1)), k, score_name="n_uses")
