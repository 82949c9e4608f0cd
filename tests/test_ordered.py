"""Running sums over ranges against a plain loop."""
import random
from collections import defaultdict

import pytest

from pluvio.operators import stats
from pluvio.operators.ordered import ranged, sums_before

SCHEMA = "g string, k long, v long"


def _rows():
    rnd = random.Random(4)
    rows = [("hot", i, rnd.randrange(5)) for i in range(400)]
    rows += [(rnd.choice(["a", "b", None]), 1000 + i, rnd.randrange(5)) for i in range(200)]
    rnd.shuffle(rows)
    return rows


def _want(rows):
    seen, out = defaultdict(int), {}
    for g, k, v in sorted(rows, key=lambda r: r[1]):
        out[g, k] = seen[g]
        seen[g] += v
    return out, seen


@pytest.mark.parametrize("ranges", [1, 3, 64])
def test_sums_before_any_number_of_ranges(spark, ranges):
    rows = _rows()
    want, total = _want(rows)
    got = sums_before(spark.createDataFrame(rows, SCHEMA).repartition(5), ["g"], ["k"], {"s": "v"}, True, ranges).collect()
    assert {(r.g, r.k): r.s for r in got} == want
    assert all(r.total_s == total[r.g] for r in got)


def test_a_hot_group_lies_in_many_ranges(spark):
    parts = ranged(spark.createDataFrame(_rows(), SCHEMA), ["g"], ["k"], 16).where("g = 'hot'")
    assert parts.select("__part").distinct().count() > 6


def test_sums_before_without_groups_and_of_nothing(spark):
    df = spark.createDataFrame([("x", i, 1) for i in range(50)], SCHEMA)
    assert sorted((r.k, r.s) for r in sums_before(df, [], ["k"], {"s": "v"}, ranges=7).collect()) == [(i, i) for i in range(50)]
    assert sums_before(df.where("k < 0"), ["g"], ["k"], {"s": "v"}, True).collect() == []


def test_no_cut_points_travel_with_the_rows(spark):
    hist = spark.createDataFrame([("x", float(i), 1) for i in range(50)], "g string, value double, c long")
    plan = stats.cumulative_below(hist, ["g"], "value", ["c"])._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile_approx" not in plan and "filter(" not in plan
