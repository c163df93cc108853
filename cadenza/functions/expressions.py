"""Scalar column expressions.

All helpers are compositions of ``pyspark.sql.functions``; none needs Python at
execution time. ANSI mode is on in Spark 4, so every index, cast and division
that can fail uses the ``try_`` form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------- P9
def log_count(c, eps: float = 1e-8) -> Column:
    """Log-scaled play count ``log10(1 + count / eps)`` computed in double, stored as float."""
    return F.log10(F.lit(1.0) + _c(c).cast("double") / F.lit(eps)).cast("float")


# --------------------------------------------------------------------- R3 / R4
def hash_bucket(key, n: int = 10) -> Column:
    """Deterministic bucket 0..n-1 from the first 32 bits of ``md5(key)``.

    DuckDB twin: ``('0x' || substr(md5(key), 1, 8))::UBIGINT % n``.
    """
    hex8 = F.substring(F.md5(_c(key).cast("string")), 1, 8)
    return (F.conv(hex8, 16, 10).cast("bigint") % F.lit(n)).cast("int")


def sample_suffix(fraction: float) -> str:
    """File-name suffix for a sample fraction; two decimals so 1.0 and 0.0 differ (R2)."""
    return f"{fraction:.2f}".replace(".", "")


# ---------------------------------------------------------------------- P5 / P6
# The genre recode rules and the allowlist must equal the source
# workload's, in this order (first matching substring wins, case-sensitive).
GENRE_RULES = [
    ("pop rock", "pop rock"),
    ("hip hop", "hip hop"),
    ("rock", "rock"),
    ("pop", "pop music"),
    ("country", "country music"),
    ("soul", "soul"),
    ("jazz", "jazz"),
    ("blues", "blues"),
    ("electr", "electronic"),
    ("metal", "metal"),
    ("folk", "folk"),
    ("raggae", "raggae"),
    ("hop", "hip hop"),
    ("rap", "rap"),
    ("reggae", "raggae"),
    ("disco", "disco"),
    ("house", "house"),
    ("dance", "dance"),
]

ALLOWED_GENRES = [
    "rock", "pop music", "metal", "jazz", "hip hop", "pop rock", "house", "soul",
    "rap", "dance", "raggae", "ccm", "post-grunge", "disco", "electronic", "ballad",
    "country music", "blues", "folk", "chill-out", "new wave", "chanson",
]


def recode_genre(term, spelling: str = "raggae") -> Column:
    """Ordered substring recode of a free-text term (one CASE chain, first hit wins).

    Terms that match no rule keep their text; NULL stays NULL here and becomes
    ``'other'`` in :func:`genre_label`.
    """
    t = _c(term)
    out = None
    for needle, label in GENRE_RULES:
        if label == "raggae":
            label = spelling
        cond = t.contains(needle)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(t)


def genre_label(term, spelling: str = "raggae") -> Column:
    """Recode, then keep only allowlisted genres; anything else (NULL included) is 'other'."""
    allowed = [spelling if g == "raggae" else g for g in ALLOWED_GENRES]
    r = recode_genre(term, spelling)
    return F.when(r.isin(allowed), r).otherwise(F.lit("other"))


# ------------------------------------------------------------------------- P10
def foreign_id(c, prefix: str | None = None, default=-1, as_int: bool = True) -> Column:
    """Third ``:``-separated field of a foreign id such as ``7digital:track:42``.

    With ``prefix`` the id counts only when the first field equals it. Missing,
    empty or malformed ids give ``default``.
    """
    x = _c(c)
    parts = F.split(x, ":")
    third = F.try_element_at(parts, F.lit(3))
    if prefix is not None:
        third = F.when(F.try_element_at(parts, F.lit(1)) == F.lit(prefix), third)
    third = F.when((x.isNotNull()) & (x != F.lit("")), third)
    if as_int:
        return F.coalesce(third.try_cast("int"), F.lit(default).cast("int"))
    return F.coalesce(third, F.lit(default))


# ------------------------------------------------------------------------- P11
def shard_path(track_id, ext: str = ".h5") -> Column:
    """``A/B/C/<id>.h5`` from characters 2, 3, 4 (0-based) of the id."""
    t = _c(track_id)
    return F.concat_ws("/", F.substring(t, 3, 1), F.substring(t, 4, 1), F.substring(t, 5, 1),
                       F.concat(t, F.lit(ext)))


# ------------------------------------------------------------------------- P12
def quoted_id(c) -> Column:
    """Text between the first pair of single quotes, e.g. ``b'TRAAA'`` -> ``TRAAA``."""
    return F.try_element_at(F.split(_c(c), "'"), F.lit(2))


# ------------------------------------------------------------------------- A13
def year_of_date(c) -> Column:
    """Year of a ``YYYY-MM-DD`` text date; partial dates such as ``1999-00-00`` keep their year."""
    return F.try_element_at(F.split(_c(c), "-"), F.lit(1)).try_cast("int")


# ------------------------------------------------------------------ vector math
def array_dot(a, b) -> Column:
    """Inner product of two numeric arrays (higher-order functions, JVM side)."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0).cast("double"), lambda s, x: s + x)


def array_norm(a) -> Column:
    return F.sqrt(array_dot(a, a))
