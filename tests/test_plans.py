"""Joins whose sides Spark takes for small, although rows were multiplied: they must not reach the driver."""

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallycast.functions import draws
from tallycast.operators import baselines
from tallycast.plans import catalogue, inputs
from tallycast.schema import SCORE_GROUP

FOLDER = Path("/root/testdata/sf0.001")


def multiplied_broadcasts(df) -> list[str]:
    """Broadcasts of rows that were generated after the last shuffle, so that no count of them was known."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("\n")
    depth = [len(re.match(r"[\s:|+\-]*", line).group()) for line in plan]
    found = []
    for i, line in enumerate(plan):
        if "BroadcastExchange" not in line:
            continue
        hidden = None
        for j in range(i + 1, len(plan)):
            if depth[j] <= depth[i]:
                break
            if hidden is not None and depth[j] > hidden:
                continue
            hidden = None
            if re.match(r"[\s:|+\-]*(\*\(\d+\) )?(Exchange|ShuffleQueryStage)", plan[j]):
                hidden = depth[j]
            elif "Generate " in plan[j]:
                found.append(line.strip())
    return found


def checked(spark, name, run: bool = False) -> None:
    if not FOLDER.exists():
        pytest.skip("test tables are not here")
    df = catalogue.QUERIES[name](spark, str(FOLDER))
    if run:
        df.collect()
    assert not multiplied_broadcasts(df)


@pytest.mark.parametrize("name", ["missing_partitions", "incomplete_dates"])
def test_stored_partitions_are_distinct_first(spark, name):
    checked(spark, name)


@pytest.mark.parametrize("name", ["states_hourly", "fluxes_hourly", "shortwave_downscale", "stage2", "stage3_backfill"])
def test_weather_values_are_not_broadcast(spark, name):
    checked(spark, name)


@pytest.mark.parametrize("name", ["score_candidates", "stale_scores"])
def test_forecasts_and_scores_are_not_broadcast(spark, name):
    checked(spark, name)


def test_new_scores_are_not_broadcast(spark):
    checked(spark, "score_upsert")


@pytest.mark.parametrize("name", ["mean_forecast", "persistence_rw", "diurnal_resample", "local_level_forecast"])
def test_draws_are_neither_shuffled_nor_broadcast(spark, name):
    """Once members are multiplied, only a partial aggregate follows, in the same tasks."""
    if not FOLDER.exists():
        pytest.skip("test tables are not here")
    df = catalogue.QUERIES[name](spark, str(FOLDER))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("\n")
    # from the result down to what multiplies rows
    above = plan[: next(i for i, line in enumerate(plan) if "Generate " in line)]
    assert not [line for line in above if re.search(r"Join|Window|Sort", line)]
    # sums of the partial aggregate may be shuffled
    assert sum("Exchange " in line for line in above) <= 1


def test_seed_rows_are_dealt_out_by_the_size_of_their_tables(spark, tmp_path):
    if not FOLDER.exists():
        pytest.skip("test tables are not here")
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    row = events.limit(1).drop("props")
    # incompressible, so that its size in the store is known to grow with its rows
    filler = spark.range(12_000).select(F.concat(*[F.sha2((F.col("id") * 16 + i).cast("string"), 512) for i in range(16)]).alias("props"))
    rows = row.crossJoin(filler).select(*events.columns)
    dealt = []
    for n in (1, 12_000):
        rows.limit(n).coalesce(1).write.parquet(f"{tmp_path}/{n}/events.parquet")
        plan = inputs.Inputs(spark, f"{tmp_path}/{n}").forecasts._jdf.queryExecution().executedPlan().toString()
        dealt.append(int(re.search(r"RoundRobinPartitioning\((\d+)\)", plan).group(1)))
    size = sum(f.stat().st_size for f in (tmp_path / "12000" / "events.parquet").iterdir())
    assert dealt[0] == inputs.SPREAD < dealt[1] and abs(dealt[1] - size // inputs.SPREAD_BYTES) <= 1


def shuffled_once_multiplied(df) -> list[str]:
    """Shuffles between the result and the last step that multiplies rows, on the plan's first branch."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("\n")
    above = plan[: next(i for i, line in enumerate(plan) if "Generate " in line)]
    return [line.strip() for line in above if "Exchange " in line]


@pytest.mark.parametrize("name", ["dedupe_mean", "bundle_forecasts", "score_union"])
def test_rows_made_of_a_target_are_not_shuffled(spark, name):
    if not FOLDER.exists():
        pytest.skip("test tables are not here")
    assert not shuffled_once_multiplied(catalogue.QUERIES[name](spark, str(FOLDER)))


def test_members_are_not_broadcast_to_their_observations(spark):
    if not FOLDER.exists():
        pytest.skip("test tables are not here")
    joined = inputs.Inputs(spark, str(FOLDER)).joined
    for run in (False, True):
        if run:
            joined.write.format("noop").mode("overwrite").save()
        assert "BroadcastExchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_members_meet_their_observation_where_they_are_made(spark):
    """Joined and grouped by the target's key: neither the join nor the aggregate after it shuffles members."""
    if not FOLDER.exists():
        pytest.skip("test tables are not here")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = inputs.Inputs(spark, str(FOLDER)).joined
        assert not shuffled_once_multiplied(joined.groupBy(*SCORE_GROUP, "observation").count())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def _series(spark, n, step):
    start = dt.datetime(2024, 1, 1)
    rows = [("demo", "S1", start + step * i, "P1D", "v", float((i * 37) % 101)) for i in range(n)]
    columns = "project_id string, site_id string, datetime timestamp_ntz, duration string, variable string, observation double"
    return spark.createDataFrame(rows, columns)


def test_chunks_do_not_change_the_draws(spark):
    daily = _series(spark, 40, dt.timedelta(days=1))
    by = ["parameter", "datetime"]
    rows = [baselines.mean_forecast(daily, "2024-02-10", 5, 4, chunk_bits=b).orderBy(*by).collect() for b in (2, 16)]
    assert len(rows[0]) == 20 and rows[0] == rows[1]
    half = _series(spark, 900, dt.timedelta(minutes=30))
    rows = [baselines.diurnal_resample(half, "2024-01-20", 3, 2, chunk_bits=b).orderBy(*by).collect() for b in (3, 16)]
    assert len(rows[0]) == (2 * 48 + 1) * 3 and rows[0] == rows[1]


def test_keys_written_out_once_give_the_same_draws(spark):
    rows = spark.createDataFrame([("S1", None, 7, i) for i in range(1, 60)], "site string, variable string, path int, step int")
    known, size = draws.key(3, "site", "variable", "path"), F.lit(1000)
    pairs = rows.select(
        draws.index(3, size, "site", "variable", "path", "step").alias("a"),
        draws.index_of(known, size, F.col("step")).alias("b"),
        draws.normal(3, "site", "variable", "path", "step").alias("c"),
        draws.normal_of(known, F.col("step")).alias("d"),
    ).collect()
    assert all(r["a"] == r["b"] and r["c"] == r["d"] for r in pairs) and len({r["a"] for r in pairs}) > 40


def dealt_out(spark, name) -> str:
    """The plan of a query in a session of three shuffle partitions."""
    if not FOLDER.exists():
        pytest.skip("test tables are not here")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        return catalogue.QUERIES[name](spark, str(FOLDER))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_pairs_are_counted_in_as_many_tasks_as_the_input_asks_for(spark):
    plan = dealt_out(spark, "submission_counts")
    # neither pairs nor submissions are shuffled by the session's few partitions
    assert re.search(rf"hashpartitioning\(site_id#\d+, variable#\d+, model_id#\d+, {inputs.SPREAD}\)", plan)
    assert not re.search(r"hashpartitioning\([^()]*reference_datetime", plan)


def test_windows_of_a_series_are_found_in_its_row(spark):
    plan = dealt_out(spark, "diurnal_windows")
    above = plan[: plan.index("Generate ")]
    assert "Window " not in above and "Join" not in above and "Exchange " not in above
    assert re.search(rf"hashpartitioning\(site_id#\d+, {inputs.SPREAD}\)", plan)
