"""Column expressions: every helper returns a :class:`pyspark.sql.Column` built from
built-in functions, so it stays inside whole-stage codegen (no Python UDF)."""

from cadenza.functions.expressions import (  # noqa: F401
    ALLOWED_GENRES,
    GENRE_RULES,
    array_dot,
    array_norm,
    foreign_id,
    genre_label,
    hash_bucket,
    log_count,
    quoted_id,
    recode_genre,
    sample_suffix,
    shard_path,
    year_of_date,
)
