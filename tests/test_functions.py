import duckdb
import pytest
from pyspark.sql import functions as F

from cadenza.functions import (foreign_id, genre_label, hash_bucket, log_count, quoted_id, recode_genre,
                               sample_suffix, shard_path, year_of_date)


def test_log_count(spark):
    df = spark.createDataFrame([(c,) for c in [0, 1, 2, 5, 17, 1000]], "c int")
    got = [r[0] for r in df.select(log_count("c")).collect()]
    assert got == pytest.approx([0, 8, 8.30103, 8.69897, 9.230449, 11], abs=1e-5)
    assert df.select(log_count("c")).schema[0].dataType.simpleString() == "float"


def test_genres(spark):
    terms = ["pop rock", "indie rock", "dance pop", "hip hop", "trip hop", "gangster rap", "reggae",
             "electro house", "deep house", "dancehall", "chill-out", "polka", None]
    want = ["pop rock", "rock", "pop music", "hip hop", "hip hop", "rap", "raggae", "electronic", "house",
            "dance", "chill-out", "other", "other"]
    df = spark.createDataFrame([(t,) for t in terms], "t string")
    got = [r[0] for r in df.select(genre_label("t")).collect()]
    assert got == want
    assert df.where(F.col("t") == "reggae").select(genre_label("t", spelling="reggae")).first()[0] == "reggae"
    assert spark.createDataFrame([("trap",)], "t string").select(recode_genre("t")).first()[0] == "rap"


def test_foreign_id(spark):
    df = spark.createDataFrame([("7digital:track:42",), ("other:track:42",), ("",), (None,)], "f string")
    assert [r[0] for r in df.select(foreign_id("f", prefix="7digital")).collect()] == [42, -1, -1, -1]
    assert [r[0] for r in df.select(foreign_id("f", default="", as_int=False)).collect()] == ["42", "42", "", ""]


def test_shard_path_quoted_year(spark):
    df = spark.createDataFrame([("TRABC1839DQL4H", "b'TRAAA'", "1999-00-00")], "i string, q string, d string")
    r = df.select(shard_path("i"), quoted_id("q"), year_of_date("d")).first()
    assert tuple(r) == ("A/B/C/TRABC1839DQL4H.h5", "TRAAA", 1999)


def test_hash_bucket_matches_duckdb(spark):
    keys = [f"u{i}|t{i * 7}" for i in range(50)]
    got = [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k string").select(hash_bucket("k")).collect()]
    con = duckdb.connect()
    want = [con.execute("SELECT CAST((('0x' || substr(md5(?), 1, 8))::UBIGINT % 10) AS INTEGER)", [k]).fetchone()[0]
            for k in keys]
    assert got == want


def test_sample_suffix():
    assert (sample_suffix(0.1), sample_suffix(0.01), sample_suffix(1.0)) == ("010", "001", "100")


def test_event_plays_reads_item_from_json(spark):
    from cadenza.sources.tables import event_plays
    ev = spark.createDataFrame([(1, "view", '{"k": 7}'), (1, "click", '{"k": 7}'), (2, "signup", '{"k": 7}'),
                                (3, "view", '{"other": 1}'), (3, "purchase", '{"k": 9}')],
                               "user_id long, event_type string, props string")
    got = sorted(map(tuple, event_plays(ev).collect()))
    assert got == [("1", "7", 2), ("3", "9", 1)]
