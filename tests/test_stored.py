"""Tables stored for repeated use: bucketed joins, station files, distinct bitmaps."""
import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from pluvio.operators import compare as cmp
from pluvio.operators import distincts as dst
from pluvio.session import bucketed_table
from pluvio.sources import sinks as snk


def _plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_bucketed_versions_join_without_a_shuffle(spark):
    a = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 30).alias("d"), F.lit(1).alias("v"))
    b = a.where("k % 3 = 0").withColumn("v", F.when(F.col("k") % 2 == 0, 2).otherwise(F.col("v")))
    ta, tb = bucketed_table(a, "a", ["k", "d"], 4), bucketed_table(b, "b", ["k", "d"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = cmp.version_join(ta, tb, ["k", "d"], ["v"])
        assert "SortMergeJoin" in _plan(joined) and "Exchange" not in _plan(joined)
        assert "Exchange" in _plan(cmp.version_join(a, b, ["k", "d"], ["v"]))
        assert cmp.changed_values(ta, tb, ["k", "d"], ["v"]).first().n_diferentes == 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_station_is_in_few_row_groups(spark, tmp_path):
    df = spark.range(200_000).select((F.col("id") % 400).alias("st"), F.rand(1).alias("v"))
    path = snk.per_station_parquet(df, str(tmp_path / "st"), "st", folders=2, row_group_bytes=64 << 10)
    holding = every = 0
    for f in glob.glob(f"{path}/*/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            c = meta.row_group(g).column(0)
            assert c.path_in_schema == "st" and c.has_column_index and c.has_offset_index
            every += 1
            holding += c.statistics.min <= 7 <= c.statistics.max
    assert every >= 10 and 1 <= holding <= 2
    one = snk.read_station(spark, path, df.schema, "st", 7, folders=2)
    assert "EqualTo(st,7)" in _plan(one) and one.count() == 500


def test_bitmaps_of_parts_add_up(spark):
    values = [(i % 3, v) for i, v in enumerate([1, 1, 2, 32768, 32769, 32768, 0, -1, -1, -40000, None, 10**12] * 3)]
    df = spark.createDataFrame([*values, (9, None)], "p int, v long")
    maps = dst.distinct_bitmaps(df, "v", "p")
    got = {r.p: r.n for r in dst.distinct_counts(maps, "p").collect()}
    want = {p: len({v for q, v in values if q == p and v is not None}) for p in range(3)}
    assert got == want  # the part without a value has no row
    files = dst.distinct_bitmaps(df.where("p = 0"), "v", "p").unionByName(dst.distinct_bitmaps(df.where("p > 0"), "v", "p"))
    total = dst.distinct_counts(dst.merge_bitmaps(files, F.lit("all"), "q"), "q").collect()
    assert [r.n for r in total] == [len({v for _, v in values if v is not None})]
    assert dst.distinct_counts(dst.distinct_bitmaps(df.limit(0), "v", "p"), "p").count() == 0
