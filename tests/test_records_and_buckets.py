"""The nested song record (pruned reads, summaries) and tables bucketed by a key."""

import io
from contextlib import redirect_stdout

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from cadenza.operators import catalog as CA
from cadenza.sources import files as FI
from cadenza.sources import musicdb as MB
from tests.conftest import SF
from tools.oracle_check import TABLES, digest


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", ["p14_record_fields", "p14_feature_fields", "a17_record_summary", "s8_r6_bucketed_by_user"])
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    s = digest(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    d = digest([x[0] for x in res.description], res.fetchall())
    assert s[1] > 0 and s[:3] == d[:3]


def test_record_has_54_fields():
    fields = [f for group in MB.RECORD_FIELDS.values() for f in group]
    assert len(fields) == len(set(fields)) == 54


def test_scan_reads_only_the_named_subfields(spark):
    df = E.queries()["p14_feature_fields"](spark, SF)
    schema = [line for line in plan(df).splitlines() if "ReadSchema" in line]
    assert schema == ["ReadSchema: struct<metadata:struct<song_hotttnesss:double>,"
                      "analysis:struct<loudness:double,tempo:double,track_id:string>>"]


def test_song_fields_by_name(spark):
    df = spark.sql("SELECT 7 AS plain, named_struct('a', 1, 'b', array(1, 2)) AS g, named_struct('b', 3, 'odd name', 4) AS h")
    assert CA.song_fields(df, ["a", "odd name", "plain"]).collect() == [(1, 4, 7)]
    with pytest.raises(KeyError, match="several groups"):
        CA.song_fields(df, ["b"])
    with pytest.raises(KeyError, match="unknown"):
        CA.song_fields(df, ["c"])


def test_summary_of_nested_records(spark):
    one = spark.sql("SELECT named_struct('x', 1, 'l', array(1, 2)) AS g, array(1) AS l, named_struct('l', array(1)) AS only, 5 AS p")
    two = spark.sql("SELECT named_struct('x', 2, 'y', 'new') AS g")
    none = spark.sql("SELECT CAST(NULL AS struct<x: int, l: array<int>>) AS g, 6 AS p")
    out = CA.pack_songs([one, two, none], keep_arrays=False)
    assert out.columns == ["g", "p"] and out.schema["g"].dataType.names == ["x", "y"]
    rows = sorted(((r.g and tuple(r.g), r.p) for r in out.collect()), key=str)
    assert rows == sorted([((1, None), 5), ((2, "new"), None), (None, 6)], key=str)
    kept = CA.pack_songs([one, two, none])
    assert kept.schema["g"].dataType.names == ["x", "l", "y"] and kept.count() == 3


def bucketed(spark, df, name, **options):
    return FI.write_bucketed(df, f"t_{name}_{FI.scratch_dir(spark, name)[-8:]}", "k", FI.scratch_dir(spark, name), **options)


def test_bucketed_tables_join_and_group_without_exchange(spark):
    left = spark.range(1000).select((F.col("id") % 37).alias("k"), F.col("id").alias("v"))
    right = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    a, b = bucketed(spark, left, "a", buckets=4), bucketed(spark, right, "b", buckets=4)
    out = a.groupBy("k").agg(F.sum("v").alias("v")).join(b.hint("merge"), "k")
    assert "Exchange" not in plan(out)
    want = left.groupBy("k").agg(F.sum("v").alias("v")).join(right, "k")
    assert sorted(out.collect()) == sorted(want.collect()) and out.count() == 37
    assert "Exchange" in plan(want.hint("merge")) or "Broadcast" in plan(want)


def test_query_over_buckets_shuffles_nothing_after_the_write(spark):
    text = plan(E.queries()["s8_r6_bucketed_by_user"](spark, SF))
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_bucketed_table_with_a_hot_key_nulls_and_no_rows(spark):
    hot = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.lit(1)).when(F.col("id") % 7 > 0, F.col("id")).alias("k"),
                                   F.col("id").alias("v"))
    t = bucketed(spark, hot, "hot", buckets=3, spread=4)
    assert sorted(t.collect(), key=str) == sorted(hot.collect(), key=str)
    files = [r.f for r in t.where("k = 1").select(F.input_file_name().alias("f")).distinct().collect()]
    assert 1 < len(files) <= 4  # the hot key's bucket was written by several tasks
    counts = t.groupBy("k").count()
    assert "Exchange" not in plan(counts)
    assert sorted(counts.collect(), key=str) == sorted(hot.groupBy("k").count().collect(), key=str)
    assert bucketed(spark, hot.where("v < 0"), "none", buckets=3).count() == 0
