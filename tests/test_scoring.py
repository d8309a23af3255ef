import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallycast.functions.timing import ntz
from tallycast.operators import boards, ranks, scoring
from tallycast.schema import FORECASTS, SCORE_GROUP, SCORE_VALUES, TARGETS

DAY = dt.datetime(2024, 1, 10)


def forecast(parameter, prediction, model="m", lead=1.0, family="sample", pub=None, duration="P1D", site="a"):
    issued = DAY - dt.timedelta(days=lead)
    return ("p", model, site, DAY, issued, duration, "x", family, parameter, prediction, pub or issued)


def target(value, site="a", day=DAY):
    return ("p", site, day, "P1D", "x", value)


def frame(spark, rows):
    return spark.createDataFrame(rows, FORECASTS)


def targets(spark, rows):
    return spark.createDataFrame(rows, TARGETS)


def eligible(spark, rows, observed=5.0):
    return scoring.eligible_forecasts(
        frame(spark, rows), targets(spark, [target(observed)]), "p", ntz(F.lit("2024-01-01 00:00:00"))
    )


def test_horizon_limits_and_incomplete_rows(spark):
    rows = [forecast("1", 1.0, model=f"m{lead}", lead=lead) for lead in (0.0, 35.0, 35.5, 36.0)]
    rows += [forecast("1", 1.0, model="weekly", lead=60.0, duration="P1W")]
    rows += [forecast(None, 1.0, model="a"), forecast("1", None, model="b"), forecast("1", 1.0, model=None)]
    kept = {r["model_id"] for r in eligible(spark, rows).collect()}
    # 35.5 days crosses 36 midnights
    assert kept == {"m0.0", "m35.0", "weekly"}


def test_ensemble_and_sample_are_one_family(spark):
    rows = [forecast(str(i), float(i), family=f) for i, f in enumerate(["ensemble", "sample", "ensemble"])]
    joined = eligible(spark, rows).join(targets(spark, [target(1.0)]), ["project_id", "site_id", "datetime", "duration", "variable"])
    assert scoring.score_joined(joined).count() == 1


def test_resubmission_is_its_own_row(spark):
    late = DAY + dt.timedelta(hours=5)
    rows = [forecast("1", 1.0), forecast("2", 3.0), forecast("1", 4.0, pub=late), forecast("2", 6.0, pub=late)]
    scores = scoring.score_joined(frame(spark, rows).withColumn("observation", F.lit(2.0))).orderBy("mean").collect()
    assert [s["mean"] for s in scores] == [2.0, 5.0]
    assert scores[0]["crps"] == pytest.approx(1.0 - 0.5)


def test_unscored_and_observed_only(spark):
    rows = [forecast("1", 1.0, site=s) for s in ("scored", "new", "unobserved")]
    observed = targets(spark, [target(1.0, s) for s in ("scored", "new")] + [target(None, "unobserved")])
    done = frame(spark, rows).where("site_id = 'scored'").withColumn("observation", F.lit(1.0))
    # stored before its observation came: still to be scored
    done = done.unionByName(frame(spark, rows).where("site_id = 'new'").withColumn("observation", F.lit(None).cast("double")))
    left = scoring.score_candidates(frame(spark, rows), done, observed).collect()
    assert [r["site_id"] for r in left] == ["new"]


@pytest.mark.parametrize(("stored", "now", "fresh"), [(10.0, 10.05, True), (10.0, 10.5, False), (-10.0, -12.0, False), (0.0, 0.0, True), (0.0, 1.0, False)])
def test_revised_observations_are_scored_again(spark, stored, now, fresh):
    scores = targets(spark, [target(stored)])
    assert (scoring.fresh_scores(scores, targets(spark, [target(now)])).count() == 1) is fresh


def test_forecasts_of_several_runs_score_as_ordinary_ones(spark, monkeypatch):
    monkeypatch.setattr(ranks, "RUN_SAMPLES", 4)
    # one forecast has most rows
    rows = [forecast(str(i), float((i * 37) % 101) + 0.25 * (i % 3), model=m) for m, n in (("a", 1500), ("b", 40)) for i in range(n)]
    rows += [forecast(f"member {i}", float(i % 7), model="named") for i in range(20)]
    rows += [forecast("1", 2.0, model="single"), forecast("1", 2.0, model="flat"), forecast("2", 2.0, model="flat")]
    joined = frame(spark, rows).withColumn("observation", F.lit(42.5))
    whole = {r["model_id"]: r for r in scoring.score_joined(joined).collect()}
    for bits in (5, 0):
        other = {r["model_id"]: r for r in scoring.score_joined(joined, run_bits=bits).collect()}
        assert other.keys() == whole.keys()
        for model, row in whole.items():
            for name in SCORE_VALUES:
                assert other[model][name] == (None if row[name] is None else pytest.approx(row[name], abs=1e-9)), name
    assert whole["flat"]["logs"] is None and whole["single"]["sd"] is None
    assert whole["single"]["crps"] == pytest.approx(40.5)
    members = np.sort([r[-2] for r in rows if r[1] == "a"])
    assert whole["a"]["median"] == pytest.approx(np.quantile(members, 0.5)) and whole["a"]["sd"] == pytest.approx(members.std(ddof=1))


def test_input_of_scores_is_read_once(spark, tmp_path):
    rows = [forecast(str(i), float(i), model=m) for i in range(6) for m in "abc"]
    frame(spark, rows).withColumn("observation", F.lit(2.0)).write.parquet(str(tmp_path / "joined"))
    read = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda v: (read.add(1), v)[1], "double")
    joined = spark.read.parquet(str(tmp_path / "joined")).withColumn("prediction", seen.asNondeterministic()("prediction"))
    assert scoring.score_joined(joined).count() == 3
    assert read.value == len(rows)


def test_size_of_parametric_groups_does_not_matter(spark):
    rows = [forecast("mu", 1.0, family="normal"), forecast("sigma", 2.0, family="normal"), forecast("1", 3.0), forecast("2", 4.0)]
    joined = frame(spark, rows).withColumn("observation", F.lit(1.0))
    whole, ranked = ({r["family"]: r["crps"] for r in scoring.score_joined(joined, run_bits=k).collect()} for k in (16, 0))
    assert whole == pytest.approx(ranked) and set(whole) == {"normal", "sample"}


def test_parametric_rows_never_read_parameter_as_a_number(spark):
    rows = [forecast("mu", 1.0, family="normal"), forecast("sigma", 2.0, family="normal")]
    rows += [forecast("prob", 0.25, family="bernoulli"), forecast("q", 0.25, family="unheard_of")]
    scores = scoring.score_joined(frame(spark, rows).withColumn("observation", F.lit(1.0))).collect()
    assert {s["family"] for s in scores} == {"normal", "bernoulli"}
    assert {s["family"]: s["mean"] for s in scores} == {"normal": 1.0, "bernoulli": 0.25}


def test_upsert_replaces_and_is_idempotent(spark):
    rows = [forecast(str(i), float(i), model=m) for i in range(3) for m in ("a", "b")]
    old = scoring.score_joined(frame(spark, rows).withColumn("observation", F.lit(1.0))).select(*SCORE_GROUP, *SCORE_VALUES)
    new = scoring.score_joined(frame(spark, rows).where("model_id = 'a'").withColumn("observation", F.lit(9.0)))
    once = scoring.score_upsert(old, new)
    twice = scoring.score_upsert(once, new)
    read = lambda df: sorted((r["model_id"], r["observation"]) for r in df.collect())
    assert read(once) == read(twice) == [("a", 9.0), ("b", 1.0)]


def test_board_bounds(spark):
    rows = [forecast("1", 1.0, lead=lead, model=f"m{lead}") for lead in (0.0, 0.5, 35.0, 35.5)]
    scores = frame(spark, rows).withColumn("crps", F.lit(1.0))
    names = lambda df: {r["model_id"] for r in df.collect()}
    assert names(boards.leaderboard_by_model(scores)) == {"m0.5"}
    assert names(boards.leaderboard_by_reference(scores)) == {"m0.5", "m35.0"}
    assert names(boards.horizon_filter(scores, 35)) == {"m0.5", "m35.0"}


def test_guard_refuses_a_model_without_scores(spark):
    scores = spark.createDataFrame([("a", 1.0), ("b", None)], "model_id string, crps double")
    assert boards.missing_score_guard(scores.where("model_id = 'a'")).count() == 1
    with pytest.raises(Exception, match="only missing scores"):
        boards.missing_score_guard(scores).collect()
