import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallycast.sources import tables
from tallycast.streaming import jobs

DAY = dt.datetime(2024, 1, 10)


def parts(spark, rows):
    return spark.createDataFrame(rows, "v long, p string, q long").select("v", "p", "q")


def content(spark, folder, schema):
    return sorted((r["v"], r["p"], r["q"]) for r in spark.read.schema(schema).parquet(folder).collect())


def added(new, old):
    return old.unionByName(new)


def broken_off(monkeypatch, at):
    """From the ``at``-th partition on, nothing is moved into place."""
    files, moved = tables._files, []

    def refusing(spark, path):
        if "/p=" in path and ".staged" not in path:
            moved.append(path)
            if len(moved) >= at:
                raise OSError("broken off")
        return files(spark, path)

    monkeypatch.setattr(tables, "_files", refusing)


@pytest.mark.parametrize("at", [1, 2, 3])
def test_a_swap_that_broke_off_is_finished(spark, tmp_path, monkeypatch, at):
    folder = str(tmp_path / "set")
    first = parts(spark, [(1, "a", 1), (2, "b b", 1), (3, "c/d", 2), (4, "e", 9)])
    tables.write_partitioned(first, folder, ["p", "q"])
    new = parts(spark, [(11, "a", 1), (12, "b b", 1), (13, "c/d", 2), (14, "new", 3)])
    with monkeypatch.context() as m:
        broken_off(m, at)
        with pytest.raises(OSError, match="broken off"):
            tables.merge_partitions(new, folder, ["p", "q"], added, delivery="one")
    tables.recover(spark, folder)
    whole = sorted([*map(tuple, first.collect()), *map(tuple, new.collect())])
    assert content(spark, folder, first.schema) == whole
    # the same delivery again, and one more
    tables.merge_partitions(new, folder, ["p", "q"], added, delivery="one")
    assert content(spark, folder, first.schema) == whole
    tables.merge_partitions(parts(spark, [(21, "a", 1)]), folder, ["p", "q"], added, delivery="two")
    assert content(spark, folder, first.schema) == sorted([*whole, (21, "a", 1)])
    assert not tables.folder_exists(spark, f"{folder}.staged") and not tables.folder_exists(spark, f"{folder}.journal")


def test_a_merge_that_broke_off_while_staging_changed_nothing(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "set")
    first = parts(spark, [(1, "a", 1)])
    tables.merge_partitions(first, folder, ["p", "q"], added, delivery="one")
    with monkeypatch.context() as m:
        m.setattr(tables, "_write_note", lambda *a: (_ for _ in ()).throw(OSError("broken off")))
        with pytest.raises(OSError):
            tables.merge_partitions(parts(spark, [(2, "a", 1)]), folder, ["p", "q"], added, delivery="two")
    assert content(spark, folder, first.schema) == [(1, "a", 1)]
    tables.merge_partitions(parts(spark, [(2, "a", 1)]), folder, ["p", "q"], added, delivery="two")
    assert content(spark, folder, first.schema) == [(1, "a", 1), (2, "a", 1)]


def test_stored_rows_are_not_shuffled_to_find_touched_partitions(spark, tmp_path):
    folder = str(tmp_path / "set")
    first = parts(spark, [(k, str(k % 3), k % 2) for k in range(12)] + [(12, None, 1)])
    tables.write_partitioned(first, folder, ["p", "q"])
    seen = []
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        look = lambda new, old: seen.append(old._jdf.queryExecution().executedPlan().toString()) or added(new, old)
        tables.merge_partitions(parts(spark, [(20, "1", 1), (21, None, 1), (22, "9", 0)]), folder, ["p", "q"], look)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "LeftSemi" in seen[0] and "Exchange hashpartitioning" not in seen[0] and "SortMergeJoin" not in seen[0]
    assert set(content(spark, folder, first.schema)) == {*map(tuple, first.collect()), (20, "1", 1), (21, None, 1), (22, "9", 0)}


def test_partitions_beyond_the_names_are_merged_too(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "PRUNED_BY_NAME", 1)
    folder = str(tmp_path / "set")
    first = parts(spark, [(k, str(k), k) for k in range(5)])
    tables.merge_partitions(first, folder, ["p", "q"], added)
    tables.merge_partitions(parts(spark, [(7, "1", 1), (8, None, 4)]), folder, ["p", "q"], added)
    assert set(content(spark, folder, first.schema)) == {*map(tuple, first.collect()), (7, "1", 1), (8, None, 4)}


# --- streams ------------------------------------------------------------------------------------------------


def sample(day, hour, chl, platform=1, lon=-70.0):
    return (dt.datetime(2024, 1, day, hour), platform, 40.0, lon, chl)


SAMPLES = "time timestamp_ntz, platform long, latitude double, longitude double, chl double"


def test_late_samples_correct_their_day(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = spark.readStream.schema(SAMPLES).parquet(str(tmp_path / "in"))

    def deliver(*samples):
        spark.createDataFrame(list(samples), SAMPLES).write.mode("append").parquet(str(tmp_path / "in"))
        jobs.run_daily_sums(rows, ["chl"], ["platform"], str(tmp_path / "sums"), str(tmp_path / "position"))
        means = jobs.daily_means(spark.read.parquet(str(tmp_path / "sums")), ["chl"], ["platform"], "6 HOURS")
        return {r["date"].day: (r["chl"], r["n_obs"]) for r in means.collect()}

    assert deliver(sample(1, 3, 2.0), sample(1, 9, 4.0), sample(2, 5, 7.0), sample(1, 4, 9.0, lon=1e20)) == {}
    # the second day goes on past the delay, so the first is closed
    assert deliver(sample(2, 7, None)) == {1: (3.0, 2)}
    # later than any watermark would allow
    assert deliver(sample(9, 0, 1.0), sample(1, 1, 9.0)) == {1: (5.0, 3), 2: (7.0, 2)}
    assert deliver(sample(1, 2, 1.0)) == {1: (4.0, 4), 2: (7.0, 2)}


def test_a_batch_that_runs_again_is_not_added_twice(spark, tmp_path):
    sums = jobs.daily_sums(spark.createDataFrame([sample(1, 3, 2.0)], SAMPLES), ["chl"], ["platform"])
    for delivery in ("batch-0", "batch-0", "batch-1"):
        tables.merge_partitions(sums, str(tmp_path / "s"), jobs.SUMS, lambda new, old: jobs.merged_sums(new, old, ["platform"]), delivery=delivery)
    assert [(r["sum_chl"], r["n_obs"]) for r in spark.read.parquet(str(tmp_path / "s")).collect()] == [(4.0, 2)]


FORECASTS = "project_id string, model_id string, site_id string, datetime timestamp_ntz, reference_datetime timestamp_ntz, duration string, variable string, family string, parameter string, prediction double, pub_datetime timestamp_ntz"
TARGETS = "project_id string, site_id string, datetime timestamp_ntz, duration string, variable string, observation double"


def forecast(day, lead=1, model="m", shift=0.0):
    at = DAY + dt.timedelta(days=day)
    issued = at - dt.timedelta(days=lead)
    return [("p", model, "s", at, issued, "P1D", "x", "sample", str(k), 1.0 + k + shift, issued) for k in range(3)]


def observed(day, value):
    return ("p", "s", DAY + dt.timedelta(days=day), "P1D", "x", value)


def test_forecasts_and_observations_wait_for_each_other(spark, tmp_path):
    for kind in "fo":
        (tmp_path / kind).mkdir()
    forecasts = spark.readStream.schema(FORECASTS).parquet(str(tmp_path / "f"))
    observations = spark.readStream.schema(TARGETS).parquet(str(tmp_path / "o"))
    held = []

    def deliver(f=(), o=()):
        for rows, kind, schema in ((f, "f", FORECASTS), (o, "o", TARGETS)):
            if rows:
                spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(str(tmp_path / kind))
        query = jobs.run_scoring(forecasts, observations, str(tmp_path / "log"), str(tmp_path / "position"), "10 days")
        done = [p for p in query.recentProgress if p["stateOperators"]]
        held.append(done[-1]["stateOperators"][0]["numRowsTotal"])
        log = spark.read.parquet(str(tmp_path / "log")) if tables.folder_exists(spark, str(tmp_path / "log")) else None
        return {} if log is None or not log.columns else {(r["model_id"], (r["datetime"] - DAY).days): r["observation"] for r in jobs.current_scores(log).collect()}

    too_far = forecast(0, lead=36, model="far")
    assert deliver(f=[*forecast(0), *forecast(1), *too_far], o=[observed(0, 2.0), observed(0, None)]) == {("m", 0): 2.0}
    # an observation for a waiting forecast, a revision, and a forecast that comes after its observation
    assert deliver(o=[observed(1, 5.0), observed(0, 3.0)]) == {("m", 0): 3.0, ("m", 1): 5.0}
    assert deliver(f=forecast(0, model="late", shift=1.0)) == {("m", 0): 3.0, ("late", 0): 3.0, ("m", 1): 5.0}
    # nothing of the first days is held once both sides have gone on for longer than the delay
    deliver(f=forecast(40), o=[observed(40, 1.0)])
    deliver(f=forecast(41), o=[observed(41, 1.0)])
    assert held[-1] <= 8 < held[2]


def test_packed_forecasts_are_held_as_one_row_and_score_alike(spark, tmp_path):
    found, held = [], []
    for pack in (False, True):
        top = tmp_path / str(pack)
        for kind in "fo":
            (top / kind).mkdir(parents=True)
        shape = jobs.packed_members if pack else lambda df: df
        given = lambda rows: shape(spark.createDataFrame(rows, FORECASTS))
        forecasts = spark.readStream.schema(given(forecast(0)).schema).parquet(str(top / "f"))
        observations = spark.readStream.schema(TARGETS).parquet(str(top / "o"))
        deliveries = [(forecast(0) + forecast(1), [observed(0, 2.0)]), (forecast(0, model="late", shift=1.0), [observed(1, 5.0), observed(0, 3.0)])]
        for f, o in deliveries:
            given(f).write.mode("append").parquet(str(top / "f"))
            spark.createDataFrame(o, TARGETS).write.mode("append").parquet(str(top / "o"))
            query = jobs.run_scoring(forecasts, observations, str(top / "log"), str(top / "position"), "10 days")
        held.append([p for p in query.recentProgress if p["stateOperators"]][-1]["stateOperators"][0]["numRowsTotal"])
        scores = jobs.current_scores(spark.read.parquet(str(top / "log")))
        found.append(sorted((r["model_id"], r["datetime"], r["observation"], r["crps"], r["mean"]) for r in scores.collect()))
    assert len(found[0]) == 3 and found[0] == found[1]
    # three forecasts and three observations, against nine members
    assert held == [12, 6]


@pytest.mark.parametrize("pack", [False, True])
def test_what_comes_after_the_delay_is_scored_too(spark, tmp_path, pack):
    for kind in "fo":
        (tmp_path / kind).mkdir()
    shape = jobs.packed_members if pack else lambda df: df
    given = lambda rows: shape(spark.createDataFrame(list(rows), FORECASTS)).coalesce(1)
    forecasts = spark.readStream.schema(given(forecast(0)).schema).parquet(str(tmp_path / "f"))
    observations = spark.readStream.schema(TARGETS).parquet(str(tmp_path / "o"))

    def deliver(f=(), o=()):
        if f:
            given(f).write.mode("append").parquet(str(tmp_path / "f"))
        if o:
            spark.createDataFrame(list(o), TARGETS).coalesce(1).write.mode("append").parquet(str(tmp_path / "o"))
        jobs.run_scoring(forecasts, observations, str(tmp_path / "log"), str(tmp_path / "position"), "10 days")
        scores = jobs.current_scores(spark.read.parquet(str(tmp_path / "log"))).collect()
        return {(r["model_id"], (r["datetime"] - DAY).days): (r["observation"], round(r["crps"], 6)) for r in scores}

    def deliver_observed(f=(), o=()):
        return {k: v[0] for k, v in deliver(f, o).items()}

    first = deliver_observed([*forecast(0), *forecast(1), *forecast(40), *forecast(41)], [observed(0, 2.0), observed(40, 1.0), observed(41, 1.0)])
    assert first == {("m", 0): 2.0, ("m", 40): 1.0, ("m", 41): 1.0}
    # forty days late: a forecast whose observation was there, a first observation, and neither before
    whole = first | {("late", 0): 2.0}
    assert deliver_observed(f=[*forecast(0, model="late", shift=1.0), *forecast(0, lead=36, model="far")]) == whole
    whole |= {("m", 1): 5.0}
    assert deliver_observed(o=[observed(1, 5.0)]) == whole
    whole |= {("late", 2): 4.0}
    assert deliver_observed(forecast(2, model="late"), [observed(2, 4.0), observed(2, None)]) == whole
    # a revision that late scores what was scored before, early or late
    whole |= {("m", 0): 9.0, ("late", 0): 9.0}
    assert deliver_observed(o=[observed(0, 9.0)]) == whole
    # as early ones, with all their members; nothing late is scored twice
    assert deliver()["late", 0] == (9.0, pytest.approx(9 - 3 - 4 / 9, abs=1e-6))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.where("model_id = 'late'").groupBy("datetime").count().agg(F.sum("count")).first()[0] == 3


def test_a_score_run_that_broke_off_leaves_nothing_out(spark, tmp_path, monkeypatch):
    for kind in "fo":
        (tmp_path / kind).mkdir()
    forecasts = spark.readStream.schema(FORECASTS).parquet(str(tmp_path / "f"))
    observations = spark.readStream.schema(TARGETS).parquet(str(tmp_path / "o"))
    run = lambda: jobs.run_scoring(forecasts, observations, str(tmp_path / "log"), str(tmp_path / "position"), "10 days")
    spark.createDataFrame(forecast(0) + forecast(40), FORECASTS).write.mode("append").parquet(str(tmp_path / "f"))
    spark.createDataFrame([observed(40, 1.0)], TARGETS).write.mode("append").parquet(str(tmp_path / "o"))
    run()
    spark.createDataFrame([observed(0, 2.0)], TARGETS).write.mode("append").parquet(str(tmp_path / "o"))
    with monkeypatch.context() as m:
        m.setattr(jobs, "scored_late", lambda *a: (_ for _ in ()).throw(OSError("broken off")))
        with pytest.raises(OSError, match="broken off"):
            run()
    run()
    scores = jobs.current_scores(spark.read.parquet(str(tmp_path / "log")))
    assert sorted(r["observation"] for r in scores.collect()) == [1.0, 2.0]


def test_an_hourly_forecast_is_scored_however_far_ahead(spark, tmp_path):
    for kind in "fo":
        (tmp_path / kind).mkdir()
    hourly = lambda rows, schema: spark.createDataFrame(rows, schema).withColumn("duration", F.lit("PT1H"))
    hourly(forecast(0, lead=500), FORECASTS).write.mode("append").parquet(str(tmp_path / "f"))
    hourly([observed(0, 2.0)], TARGETS).write.mode("append").parquet(str(tmp_path / "o"))
    forecasts = spark.readStream.schema(FORECASTS).parquet(str(tmp_path / "f"))
    observations = spark.readStream.schema(TARGETS).parquet(str(tmp_path / "o"))
    jobs.run_scoring(forecasts, observations, str(tmp_path / "log"), str(tmp_path / "position"))
    assert jobs.current_scores(spark.read.parquet(str(tmp_path / "log"))).count() == 1
