import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallycast.functions.timing import day
from tallycast.operators import baselines, drivers
from tallycast.operators import targets as ops
from tallycast.schema import TARGETS

START = dt.datetime(2024, 1, 25)


def observations(spark, values, site="a", variable="x"):
    rows = [("p", site, START + dt.timedelta(days=i), "P1D", variable, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, TARGETS)


def test_quality_check_in_both_modes(spark):
    # steady rise, jump, flat, gap, value after the gap, out of range
    values = [10.0, 11.0, 17.5, 17.5, None, 18.0, 19.0, 45.0]
    rows = observations(spark, values)
    got = [r["observation"] for r in ops.qc_series(rows, -5, 40, 5).orderBy("datetime").collect()]
    assert got == [10.0, 11.0, None, None, None, None, 19.0, None]
    deep = rows.withColumn("depth", F.lit(0.5))
    got = [r["observation"] for r in ops.qc_series(deep, -5, 40, 5, by_depth=True).orderBy("datetime").collect()]
    assert got == [10.0, 11.0, None, None, None, 18.0, 19.0, None]


def test_experts_meet_individuals_before_sorted_rows_do(spark):
    names = "taxonRank string, scientificName string, taxonID string, morphospeciesID string"
    states = "nativeStatusCode string, sampleCondition string"
    sorting = spark.createDataFrame(
        [(k, "carabid", "species", f"Genus{k} sp", "T", None, "N", None) for k in ("a", "b", "c", "d")],
        f"subsampleID string, sampleType string, {names}, {states}",
    )
    para = spark.createDataFrame(
        [("a", "i1", None, None, None, None), ("b", "i2", None, None, None, None)],
        f"subsampleID string, individualID string, {names}",
    )
    expert = spark.createDataFrame(
        [("i1", "species", "Expertus verus", "E", None, "Carabidae", None, None), ("i2", None, None, None, None, "Silphidae", None, None)],
        f"individualID string, {names}, family string, {states}",
    )
    best = ops.resolve_taxonomy(sorting, para, expert)
    got = sorted((r["subsampleID"], r["individualID"], r["scientificName"]) for r in best.collect())
    assert got == [("a", "i1", "Expertus verus"), ("c", None, "Genusc sp"), ("d", None, "Genusd sp")]
    # the join that all sorted rows go through is by their own key, which none lacks
    joins = [line for line in best._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join LeftOuter" in line]
    assert len(joins) == 2 and "subsampleID" in joins[0] and "individualID" in joins[1]


def test_upsert_new_wins_and_repeats_nothing(spark):
    old, new = observations(spark, [1.0, 2.0]), observations(spark, [9.12345678])
    once = ops.target_upsert(old, new)
    twice = ops.target_upsert(once, new)
    read = lambda df: sorted(r["observation"] for r in df.collect())
    assert read(once) == read(twice) == [2.0, 9.123457]


def test_densify_has_every_combination(spark):
    rows = observations(spark, [1.0, None, 3.0], "a").unionByName(observations(spark, [5.0], "b", "y"))
    dense = ops.calendar_densify(rows, ["x", "y"])
    assert dense.count() == 2 * 2 * 3
    assert dense.where("observation IS NOT NULL").count() == 3


def test_bootstrap_is_reproducible(spark):
    images = spark.range(500).select((F.col("id") % 2).alias("date"), "id", F.sqrt("id").alias("v"))
    one = sorted(map(tuple, ops.bootstrap_quantile_sd(images.repartition(1), ["date"], "v").collect()))
    two = sorted(map(tuple, ops.bootstrap_quantile_sd(images.repartition(7), ["date"], "v").collect()))
    assert [o[0] for o in one] == [t[0] for t in two]
    assert [o[1] for o in one] == pytest.approx([t[1] for t in two])
    # the spread of resampling in full
    rng = np.random.default_rng(4)
    for date, sd in one:
        values = np.sqrt(np.arange(date, 500, 2))
        spread = np.std([np.quantile(rng.choice(values, len(values)), 0.9) for _ in range(2000)])
        assert 0.6 * spread < sd < 1.5 * spread


def test_bootstrap_of_few_values(spark):
    images = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 3.0), (None, 2.0), ("c", None)], "date string, v double")
    got = {r["date"]: r["sd"] for r in ops.bootstrap_quantile_sd(images, ["date"], "v").collect()}
    assert got["a"] == 0 and got[None] == 0 and 0 < got["b"] < 1.5 and len(got) == 3


def test_random_walk_paths(spark):
    rng = np.random.default_rng(1)
    series = observations(spark, [float(v) for v in 50 + np.cumsum(rng.normal(0, 1, 200))])
    today = (START + dt.timedelta(days=201)).date().isoformat()
    paths = baselines.persistence_rw(series, today, n_paths=300)
    rows = paths.groupBy("datetime").agg(F.avg("prediction").alias("m"), F.stddev("prediction").alias("s"), F.count("*").alias("n"))
    rows = rows.orderBy("datetime").collect()
    assert len(rows) == 34 and all(r["n"] == 300 for r in rows)
    last = series.orderBy(F.desc("datetime")).first()["observation"]
    assert abs(rows[-1]["m"] - last) < 2 and 4 < rows[-1]["s"] < 8
    again = baselines.persistence_rw(series.repartition(5), today, n_paths=300)
    key = ["datetime", "parameter"]
    gap = paths.alias("a").join(again.alias("b"), key).select(F.max(F.abs(F.col("a.prediction") - F.col("b.prediction"))))
    assert gap.first()[0] < 1e-9


def test_local_level_finds_the_level(spark):
    rng = np.random.default_rng(2)
    level = 30 + np.cumsum(rng.normal(0, 0.5, 300))
    values = [None if i % 17 == 3 else float(v) for i, v in enumerate(level + rng.normal(0, 1.0, 300))]
    fit = baselines.local_level_fit(observations(spark, values), sd_obs=1.0).first()
    assert abs(fit["level"] - level[-1]) < 2.5 and 0.2 < fit["process_sd"] < 1.2


def test_lognormal_members_match_the_moments(spark):
    weekly = spark.createDataFrame([("a", 20, 4.0, 1.5)], "site_id string, iso_week int, mean double, sd double")
    row = baselines.lognormal_ensemble(weekly, 20_000).agg(F.avg("prediction"), F.stddev("prediction")).first()
    assert row[0] == pytest.approx(5.0, abs=0.05) and row[1] == pytest.approx(1.5, abs=0.05)


def test_diurnal_draws_come_from_the_window(spark):
    rows = [("a", START + dt.timedelta(days=d, hours=h), "x", float(100 * h + d)) for d in range(5) for h in (0, 6, 12)]
    history = spark.createDataFrame(rows, "site_id string, datetime timestamp_ntz, variable string, observation double")
    windows = {r["slot"]: r for r in baselines.diurnal_windows(history).collect()}
    assert len(windows) == 48
    # five values at noon are not enough: the window grows until it reaches six o'clock
    assert windows[12.0]["window"] == 6.25 and windows[12.0]["_size"] == 10
    drawn = baselines.diurnal_resample(history, "2024-01-31", n_members=20)
    noon = drawn.where(F.hour("datetime") == 12).where(F.minute("datetime") == 0)
    assert {r[0] // 100 for r in noon.select("prediction").distinct().collect()} == {6, 12}
    assert drawn.count() == (10 * 48 + 1) * 20


def test_shortwave_keeps_the_daily_mean(spark):
    rows = [
        ("s", "ensemble", "gep01", dt.datetime(2024, 6, 1), dt.datetime(2024, 6, 1) + dt.timedelta(hours=h), "DSWRF", 100.0 + h)
        for h in range(48)
    ]
    schema = "site_id string, family string, ensemble string, reference_datetime timestamp_ntz, datetime timestamp_ntz, variable string, prediction double"
    fluxes = spark.createDataFrame(rows, schema)
    sites = spark.createDataFrame([("s", 40.0, -75.0)], "field_site_id string, latitude double, longitude double")
    out = drivers.shortwave_downscale(fluxes, sites, ["reference_datetime"])
    by_day = lambda df: sorted(r[1] for r in df.groupBy(F.to_date("datetime")).avg("prediction").collect())
    assert by_day(out) == pytest.approx(by_day(fluxes))
    night = out.where("prediction = 0").count()
    assert 10 < night < 30


def test_missing_dates_start_after_the_last_stored_day(spark):
    rows = observations(spark, [1.0, 2.0, 3.0])
    got = [r["date"].isoformat() for r in ops.missing_dates(rows, "x", day("2024-01-01"), day("2024-01-30")).orderBy("date").collect()]
    assert got == ["2024-01-28", "2024-01-29"]
    none = [r["date"].isoformat() for r in ops.missing_dates(rows, "z", day("2024-01-28"), day("2024-01-30")).orderBy("date").collect()]
    assert none == ["2024-01-28", "2024-01-29"]
