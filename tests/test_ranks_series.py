import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallycast.operators import ranks
from tallycast.operators.series import fill_from_next, interpolate_linear, with_position, with_previous


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows, with many repeated values."""
    rng = random.Random(3)
    rows = [("hot", float(rng.randint(0, 400))) for _ in range(6000)] + [("small", float(i)) for i in range(7)]
    rows += [(None, 1.0), (None, 2.0), ("hot", None)]
    return spark.createDataFrame(rows, "k string, v double").cache(), rows


def expected(rows, q):
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    return {k: float(np.quantile(v, q)) for k, v in groups.items()}


def test_exact_quantiles(skewed):
    df, rows = skewed
    got = ranks.exact_quantiles(df, ["k"], "v", {"lo": 0.025, "mid": 0.5, "hi": 0.975})
    got = {r["k"]: r for r in got.collect()}
    for name, q in (("lo", 0.025), ("mid", 0.5), ("hi", 0.975)):
        assert {k: got[k][name] for k in got} == pytest.approx(expected(rows, q))


def test_value_ranks_count_what_lies_below(skewed):
    df, rows = skewed
    hot = sorted(v for k, v in rows if k == "hot" and v is not None)
    for r in ranks.value_ranks(df, ["k"], "v").where("k = 'hot'").collect():
        assert r["_before"] == np.searchsorted(hot, r["_v"], "left")
        assert r["_before"] + r["_n"] == np.searchsorted(hot, r["_v"], "right")
        assert r["_m"] == len(hot)


def test_a_group_with_most_rows_is_ranked_in_many_ranges(spark, skewed, monkeypatch):
    df, _ = skewed
    stored = []
    cut = ranks.cut_lineage
    monkeypatch.setattr(ranks, "cut_lineage", lambda d, purpose: stored.append(cut(d, purpose)) or stored[-1])
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranks.value_ranks(df, ["k"], "v").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    sizes = [r["count"] for r in stored[0].where("k = 'hot'").groupBy("_block").count().collect()]
    assert len(sizes) >= 3 and max(sizes) < 0.6 * sum(sizes)


def test_ranks_across_sorted_runs(spark, skewed, monkeypatch):
    monkeypatch.setattr(ranks, "RUN_SAMPLES", 8)
    df, rows = skewed
    numbered = df.where("v IS NOT NULL").withColumn("number", F.monotonically_increasing_id().cast("string"))
    runs = numbered.groupBy("k", ranks.member_run(F.col("number"), 6).alias("_run")).agg(F.array_sort(F.collect_list("v")).alias("_x"))
    got = ranks.run_ranks(runs, ["k"])
    for k in ("hot", "small", None):
        values = sorted(v for key, v in rows if key == k and v is not None)
        mine = got.where(F.col("k").eqNullSafe(F.lit(k))).collect()
        assert sorted(r["_v"] for r in mine) == sorted(set(values))
        for r in mine:
            assert r["_before"] == np.searchsorted(values, r["_v"], "left")
            assert r["_before"] + r["_n"] == np.searchsorted(values, r["_v"], "right")
            assert r["_m"] == len(values)


def test_members_without_a_number_have_runs_of_their_own(spark):
    df = spark.createDataFrame([("1",), ("65535",), ("65536",), ("a",), ("b",), (None,)], "n string")
    runs = [r[0] for r in df.select(ranks.member_run(F.col("n"))).collect()]
    assert runs[:3] == [0, 0, 1] and len(set(runs[:5])) == 4
    assert runs[5] == 0  # without a name


def test_keep_extreme_breaks_ties_by_the_row(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 1.0), ("a", 2, 3.0), ("b", None, 9.0)], "k string, o int, v double")
    rows = {r["k"]: (r["o"], r["v"]) for r in ranks.keep_extreme(df, ["k"], [F.col("o")]).collect()}
    assert rows == {"a": (2, 3.0), "b": (None, 9.0)}


def series(spark, values, key="s"):
    first = dt.datetime(2024, 1, 1)
    rows = [(key, first + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, t timestamp_ntz, v double")


def read(df):
    return [r["v"] for r in df.orderBy("t").collect()]


@pytest.mark.parametrize("width", [1, 3, 7, 1000])
def test_interpolation_does_not_depend_on_the_blocks(spark, width):
    values = [None, None, 2.0, None, None, 8.0, 8.5, None, None, None, None, 1.0, None]
    block = F.floor(F.datediff("t", F.lit("2024-01-01")) / width)
    got = read(interpolate_linear(series(spark, values), ["k"], "t", "v", block))
    known = [i for i, v in enumerate(values) if v is not None]
    want = np.interp(range(len(values)), known, [values[i] for i in known])
    assert got == pytest.approx(list(want))
    nexts = read(fill_from_next(series(spark, values), ["k"], "t", "v", block))
    assert nexts == [2.0] * 3 + [8.0] * 3 + [8.5] + [1.0] * 5 + [None]


def test_interpolation_of_one_or_no_known_value(spark):
    assert read(interpolate_linear(series(spark, [None, 3.0, None]), ["k"], "t", "v")) == [3.0, 3.0, 3.0]
    assert read(interpolate_linear(series(spark, [None, None]), ["k"], "t", "v")) == [None, None]


@pytest.mark.parametrize("width", [1, 4, 1000])
def test_position_and_previous_cross_blocks(spark, width):
    df = series(spark, [float(i * i) for i in range(11)])
    block = F.floor(F.datediff("t", F.lit("2024-01-01")) / width)
    assert [r["_pos"] for r in with_position(df, ["k"], "t", block).orderBy("t").collect()] == list(range(1, 12))
    rows = with_previous(df, ["k"], "t", "v", block).orderBy("t").collect()
    assert [r["_prev"] for r in rows] == [None] + [float(i * i) for i in range(10)]
    assert [r["_opens"] for r in rows] == [True] + [False] * 10
