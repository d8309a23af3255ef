import datetime as dt

from pyspark.sql import functions as F

from tallycast.operators import drivers, scoring
from tallycast.schema import FORECASTS

DAY = dt.datetime(2024, 1, 10)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_ranks_across_runs_are_no_part_of_the_last_plan(spark):
    rows = [("p", m, "s", DAY, DAY, "P1D", "x", "sample", str(k), float(k * k % 7), DAY) for m in "ab" for k in range(9)]
    joined = spark.createDataFrame(rows, FORECASTS).withColumn("observation", F.lit(3.0))
    ranked, whole = scoring.score_joined(joined, run_bits=1), scoring.score_joined(joined)
    # what is left tells forecasts of one run from others
    assert plan_of(ranked).count("Join ") == 1 and "Window" not in plan_of(ranked)
    read = lambda df: [[round(v, 9) if isinstance(v, float) else v for v in r] for r in df.orderBy("model_id").collect()]
    assert len(read(ranked)) == 2 and read(ranked) == read(whole)


def test_weather_values_are_packed_before_they_are_shuffled(spark):
    rows = [
        (s, "ensemble", g, DAY, DAY + dt.timedelta(hours=3 * k), float(3 * k), v, None if k == 1 else float(k))
        for s in ("a", "b", "c") for g in ("gep01", "gep02") for v in ("TMP", "DSWRF", "PRES") for k in range(5)
    ]
    raw = spark.createDataFrame(
        rows,
        "site_id string, family string, ensemble string, reference_datetime timestamp_ntz, datetime timestamp_ntz, horizon double, variable string, prediction double",
    )
    sites = spark.createDataFrame([("a", 40.0, -75.0), ("b", 30.0, -80.0)], "field_site_id string, latitude double, longitude double")
    out = drivers.stage2(raw, sites)
    got = out.groupBy("site_id", "variable").agg(F.count("*").alias("n"), F.count("prediction").alias("k")).collect()
    assert {(r["site_id"], r["variable"]): r["n"] for r in got} == {(s, n): 2 * 13 for s in "ab" for v, n in {**drivers.NAMES, "APCP": "precipitation_flux"}.items() if v != "PRATE"}
    assert all(r["k"] == (26 if r["variable"] in ("air_temperature", "air_pressure", "surface_downwelling_shortwave_flux_in_air") else 0) for r in got)
    # a series' values are one row when they are sent, and rows of other sites are not sorted out one by one
    plan = plan_of(out)
    semi = [p for p in plan.split("Join LeftSemi")[1:]]
    assert plan.count("collect_list") >= 1 and all("Aggregate" in p.split("Join ")[0][:400] for p in semi)
