"""Plan shape: pushdown, pruning and join strategy of registered queries."""
import __spark_entry__ as E
from pluvio.plans.catalog import QUERIES
from small_tables import SF_SMALL


def _plan(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    df.createOrReplaceTempView(f"plan_{name}")
    return spark.sql(f"EXPLAIN FORMATTED SELECT * FROM plan_{name}").first()[0]


def test_register_year_range_reaches_scan(spark):
    p = _plan(spark, "register_labels")
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in p
    assert "LessThan(o_orderdate,2001-01-01" in p


def test_label_x_reads_all_events_and_its_columns_only(spark):
    p = _plan(spark, "label_join")
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in p


def test_no_cartesian_products(spark):
    for name in QUERIES:
        p = _plan(spark, name)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def _counts(spark, name, sf=SF_SMALL):
    """Scans, joins and sort aggregates of a query's physical plan."""
    p = spark.sql(f"EXPLAIN SELECT * FROM plan_{name}").first()[0] if _plan(spark, name) else ""
    p = p.split("== Initial Plan ==")[0]
    return (p.count("FileScan"), p.count("SortMergeJoin") + p.count("BroadcastHashJoin") + p.count("ShuffledHashJoin"),
            p.count("SortAggregate"))


def test_one_join_feeds_all_compared_columns(spark):
    assert _counts(spark, "change_direction")[1] == _counts(spark, "changed_values")[1]


def test_mosaic_is_a_hash_aggregate(spark):
    assert _counts(spark, "mosaic_cells")[2] == 0


def test_reports_do_not_make_the_hours(spark):
    for name in ("imputation_report", "metadata_join", "station_quality_stats"):
        assert "Generate" not in _plan(spark, name), name


def test_conservation_scans_each_side_twice_at_most(spark):
    scans, joins, _ = _counts(spark, "row_conservation_check")
    assert scans <= 4 and joins == 0  # source once; consolidated for the counts and for the distinct rows
