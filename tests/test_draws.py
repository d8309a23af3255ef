import datetime as dt
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallycast.functions import draws
from tallycast.operators import baselines
from tallycast.schema import TARGETS

START = dt.datetime(2024, 1, 25)


@pytest.mark.parametrize("beginning", ["", "1|a", "1|S000123|click", "12|S000123|nee", "1|ü|x", "1|" + "long" * 11, "1|" + "longer" * 20])
def test_draws_made_together_are_those_of_their_keys(monkeypatch, beginning):
    monkeypatch.setattr(draws, "AT_A_TIME", 64)
    ends = [f"|{p}|{s}" for p in (1, 9, 10, 200) for s in range(1, 40)]
    want = [int(hashlib.md5((beginning + e).encode()).hexdigest()[: draws.DIGITS], 16) for e in ends]
    counters = draws.Counters(ends)
    assert draws.wholes(beginning, counters).tolist() == want
    assert draws.wholes(beginning, counters, 70).tolist() == want[:70]


def test_draws_made_together_are_those_of_a_column(spark):
    ends = draws.counted(40, 30)
    rows = spark.range(40).select((F.col("id") + 1).alias("s")).withColumn("p", F.explode(F.sequence(F.lit(1), F.lit(30)))).orderBy("s", "p")
    got = rows.select(draws.normal(3, F.lit("a"), "p", "s"), draws.index(3, F.lit(17), F.lit("a"), "p", "s")).collect()
    assert draws.normals("3|a", ends) == pytest.approx([r[0] for r in got], rel=1e-12)
    assert (draws.indices("3|a", ends, 17) + 1).tolist() == [r[1] for r in got]
    assert draws.text_of(3, None, "a") == spark.range(1).select(draws.key(3, F.lit(None).cast("string"), F.lit("a"))).first()[0]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def observations(spark, values, sites="ab"):
    rows = [("p", s, START + dt.timedelta(days=i), "P1D", "x", v + k) for k, s in enumerate(sites) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, TARGETS)


def test_walks_are_drawn_together(spark):
    values = [float(v) for v in 50 + np.cumsum(np.random.default_rng(1).normal(0, 1, 9))]
    today = (START + dt.timedelta(days=12)).date().isoformat()
    paths = baselines.persistence_rw(observations(spark, values), today, n_paths=5)
    # no digest for each draw of a row's own
    assert "md5" not in plan_of(paths)
    changes = np.diff(values)
    for site, k in (("a", 0), ("b", 1)):
        got = {(r["datetime"], r["parameter"]): r["prediction"] for r in paths.where(F.col("site_id") == site).collect()}
        assert len(got) == 34 * 5
        for p in range(1, 6):
            level, centre = values[-1] + k, changes.mean()
            for step in range(1, 39):
                digest = hashlib.md5(f"1|{site}|x|{p}|{step}".encode()).hexdigest()[:13]
                level += changes[int((int(digest, 16) + 0.5) / 16**13 * len(changes))] - centre
                at = START + dt.timedelta(days=8 + step)
                if at > START + dt.timedelta(days=12):
                    assert got[at, p] == pytest.approx(level, abs=1e-9)


def test_mean_forecasts_are_drawn_together_whatever_the_chunks(spark):
    rows = observations(spark, [float(v * v % 17) for v in range(40)])
    whole = baselines.mean_forecast(rows, "2024-03-01", n_paths=30, weeks=4)
    parts = baselines.mean_forecast(rows, "2024-03-01", n_paths=30, weeks=4, chunk_bits=3)
    assert "md5" not in plan_of(whole)
    read = lambda df: sorted((r["site_id"], r["datetime"], r["parameter"], round(r["prediction"], 9)) for r in df.collect())
    assert len(read(whole)) == 2 * 30 * 4 and read(whole) == read(parts)


def test_half_hours_are_drawn_together_whatever_the_chunks(spark):
    rows = [("a", START + dt.timedelta(days=d, hours=h), "x", float(100 * h + d)) for d in range(5) for h in (0, 6, 12, 18)]
    history = spark.createDataFrame(rows, "site_id string, datetime timestamp_ntz, variable string, observation double")
    whole = baselines.diurnal_resample(history, "2024-01-31", n_members=7, days=2)
    parts = baselines.diurnal_resample(history, "2024-01-31", n_members=7, days=2, chunk_bits=2)
    assert "md5" not in plan_of(whole)
    read = lambda df: sorted((r["datetime"], r["parameter"], r["prediction"]) for r in df.collect())
    assert len(read(whole)) == (2 * 48 + 1) * 7 and read(whole) == read(parts)


def test_levels_are_fitted_and_drawn_together(spark):
    values = [10.0, 12.0, 11.0, 13.0]
    today = (START + dt.timedelta(days=4)).date().isoformat()
    rows = observations(spark, values)
    paths = baselines.local_level_forecast(rows, today, sd_obs=1.0, n_members=400)
    plan = plan_of(paths)
    assert "md5" not in plan and "FlatMapGroups" not in plan
    fit = {r["site_id"]: r for r in baselines.local_level_fit(rows, 1.0).collect()}
    assert fit["b"]["level"] == pytest.approx(fit["a"]["level"] + 1) and fit["a"]["last_day"] == (START + dt.timedelta(days=3)).date()
    got = paths.where("site_id = 'a'").groupBy("datetime").agg(F.avg("prediction").alias("m"), F.var_samp("prediction").alias("v"), F.count("*").alias("n"))
    got = got.orderBy("datetime").collect()
    assert len(got) == 35 and all(r["n"] == 400 for r in got)
    f = fit["a"]
    assert all(abs(r["m"] - f["level"]) < 5 * (r["v"] / 400) ** 0.5 for r in got)
    assert got[0]["v"] == pytest.approx(f["variance"] + 2 * f["process_sd"] ** 2 + 1, rel=0.4)
