import gzip

import pytest
from pyspark.sql import functions as F

from tallycast.operators import submissions as ops
from tallycast.schema import SUBMISSION_COLUMNS
from tallycast.sources.tables import read_submissions
from tallycast.streaming import jobs

GOOD = {
    "project_id": "p",
    "model_id": "mine",
    "datetime": "2024-01-03 00:00:00",
    "reference_datetime": "2024-01-01 00:00:00",
    "duration": "P1D",
    "site_id": "s",
    "family": "ensemble",
    "parameter": "1",
    "variable": "x",
    "prediction": "1.5",
}
NAME = "theme-2024-01-01-mine.csv"


@pytest.fixture(scope="module")
def allowed(spark):
    groups = {"g": {"variable": ["x", "y"], "duration": ["P1D", "PT1H"], "max_horizon": [35, 10]}}
    return ops.allowed_combinations(spark, groups)


def report(spark, allowed, rows, name=NAME, drop=(), strict=False):
    columns = ["file", *SUBMISSION_COLUMNS]
    data = [[name, *[{**GOOD, **r}[c] for c in SUBMISSION_COLUMNS]] for r in rows]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns)).drop(*drop)
    found = ops.validate_submissions(df, allowed, strict).collect()
    return {r["rule"] for r in found if not r["passed"]}, found[0]["valid"]


@pytest.mark.parametrize(
    ("rows", "options", "rule", "valid"),
    [
        ([{}], {}, None, True),
        ([{}, {"model_id": "other"}], {}, "single_model", False),
        ([{}, {"model_id": None}], {}, "single_model", False),
        ([{}, {"duration": "PT1H"}], {}, "combination_allowed", True),
        ([{}, {"duration": "PT1H"}], {"strict": True}, "combination_allowed", False),
        ([{"variable": "z"}], {}, "combination_allowed", True),
        ([{}, {"family": "normal"}], {}, "single_family", False),
        ([{"parameter": str(i)} for i in range(501)], {}, "member_limit", False),
        ([{"parameter": str(i)} for i in range(500)], {}, None, True),
        ([{"datetime": "20240103"}], {}, "datetime_readable", False),
        ([{"datetime": "2024-02-05"}], {}, None, True),
        ([{"datetime": "2024-02-06"}], {}, "horizon_allowed", False),
        ([{}], {"name": "theme-2024-01-01-mine.txt"}, "extension", False),
        ([{}], {"drop": ["site_id"]}, "has_site", True),
        ([{}], {"drop": ["parameter"]}, "has_family_parameter", False),
        ([{}], {"drop": ["reference_datetime"]}, "has_reference", False),
    ],
)
def test_each_rule_alone(spark, allowed, rows, options, rule, valid):
    failed, ok = report(spark, allowed, rows, **options)
    assert failed == ({rule} if rule else set())
    assert ok is valid


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("a/b/aquatics-2024-01-31-net.csv", ("aquatics", "net", "csv", True)),
        ("aquatics-2024-01-31-net.csv.gz", ("aquatics", "net", "csv.gz", True)),
        ("aquatics-2024-01-31-net-two.csv", ("aquatics", "net", "csv", True)),
        ("aquatics-2024-13-31-net.csv", ("aquatics", "net", "csv", False)),
        ("aquatics-2024-01-31-net.zip", ("aquatics", "net", "zip", False)),
        ("foreign-2024-01-31-net.csv", ("foreign", "net", "csv", False)),
        ("nonsense.csv", ("nonsense.csv", None, "csv", False)),
    ],
)
def test_file_names(spark, name, want):
    df = spark.createDataFrame([(name,)], "file string")
    row = ops.parse_submission_name(df, foreign=["foreign"]).first()
    assert (row["theme"], row["file_model"], row["extension"], row["accepted"]) == want


def test_standardize_fills_blanks_and_drops_bad_leads(spark):
    rows = [{"model_id": "null"}, {"duration": None}, {"datetime": "2024-02-05 12:00:00"}, {"datetime": "2023-12-31"}]
    data = [[NAME, *[{**GOOD, **r}[c] for c in SUBMISSION_COLUMNS]] for r in rows + [{"duration": "PT30", "prediction": "bad"}]]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in ["file", *SUBMISSION_COLUMNS]))
    got = ops.standardize_forecast(df, "p", F.lit("2024-01-02 00:00:00")).collect()
    assert len(got) == 3
    assert {r["duration"] for r in got} == {"P1D", "PT1H", "PT30M"}
    assert {r["model_id"] for r in got} == {"mine"} and {r["family"] for r in got} == {"sample"}
    assert [r["prediction"] for r in got if r["duration"] == "PT30M"] == [None]


def write_files(folder, numbers):
    folder.mkdir(exist_ok=True)
    header = ",".join(SUBMISSION_COLUMNS)
    for i in numbers:
        model = f"m{i}"
        lines = [
            ",".join({**GOOD, "model_id": model, "parameter": str(k), "prediction": str(float(k + i))}[c] for c in SUBMISSION_COLUMNS)
            for k in range(4)
        ]
        if i == 3:  # two models in one file: not valid
            lines[0] = lines[0].replace("m3", "other")
        path = folder / f"theme-2024-01-01-{model}.csv.gz"
        with gzip.open(path, "wt") as f:
            f.write("\n".join([header, *lines]) + "\n")


def test_every_file_is_read_by_its_own_header(spark, allowed, tmp_path):
    drop = tmp_path / "drop"
    write_files(drop, [1])
    turned = SUBMISSION_COLUMNS[::-1]
    layouts = {
        "turned": turned,
        "more": [*SUBMISSION_COLUMNS[:4], "ensemble", *SUBMISSION_COLUMNS[4:]],
        "fewer": [c for c in SUBMISSION_COLUMNS if c not in ("site_id", "project_id")],
        "bare": [c for c in SUBMISSION_COLUMNS if c != "prediction"],
    }
    for model, names in layouts.items():
        row = {**GOOD, "model_id": model, "ensemble": "7", "variable": "x"}
        quoted = [f'"{row[c]}"' if c == "datetime" else row[c] for c in names]
        (drop / f"theme-2024-01-01-{model}.csv").write_text(",".join(names) + "\r\n" + ",".join(quoted) + "\r\n\r\n")
    rows = read_submissions(spark, [str(drop)])
    assert rows.columns == ["path", "file", "columns", *SUBMISSION_COLUMNS]
    got = {r["model_id"]: r for r in rows.where("file LIKE '%.csv'").collect()}
    assert rows.count() == 4 + len(layouts) and set(got) == set(layouts)
    for model, names in layouts.items():
        assert got[model]["columns"] == names
        assert all(got[model][c] == (({**GOOD, "model_id": model})[c] if c in names else None) for c in SUBMISSION_COLUMNS)
    report = ops.validate_submissions(rows, allowed).collect()
    failed = {(r["file"].split("-")[-1].split(".")[0], r["rule"]) for r in report if not r["passed"]}
    assert failed == {("more", "no_ensemble_column"), ("fewer", "has_site"), ("fewer", "has_project"), ("bare", "has_variable_prediction")}
    valid = {r["file"].split("-")[-1].split(".")[0] for r in report if r["valid"]}
    assert valid == {"m1", "turned", "fewer"}


def test_forecasts_are_stored_as_published_and_listed(spark, tmp_path, monkeypatch):
    from tallycast.plans import catalogue
    from tallycast.schema import FORECAST_PARTITIONS
    from tallycast.sources import tables

    rows = spark.createDataFrame([("p", "P1D", "a:b+c", "m 1", "2024-01-01", 1.5), ("p", "P1D", "x", "m 2", "2024-01-02", 2.5)], [*FORECAST_PARTITIONS, "prediction"])
    tables.write_forecasts(rows, str(tmp_path / "store"))
    listed = sorted(r["path"].split("/store/")[1].rsplit("/", 1)[0] for r in tables.list_files(spark, str(tmp_path / "store")).collect())
    assert listed == [f"project_id=p/duration=P1D/variable={v}/model_id={m}/reference_date={d}" for v, m, d in (("a:b+c", "m 1", "2024-01-01"), ("x", "m 2", "2024-01-02"))]
    layouts = []
    real = tables.write_partitioned
    monkeypatch.setattr(tables, "write_partitioned", lambda df, path, columns: layouts.append(columns) or real(df, path, columns))
    for name in ("write_forecasts", "archive_inventory"):
        catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert layouts == [FORECAST_PARTITIONS] * 3


def test_columns_of_a_wide_file(spark, tmp_path):
    extra = [f"x{k}" for k in range(60)]
    (tmp_path / "wide.csv").write_text(",".join([*extra, "prediction", "ensemble"]) + "\n" + ",".join([*"7" * 60, "2.5", "1"]) + "\n")
    (tmp_path / "narrow.csv").write_text('prediction,variable\n1.5,"a, b"\n2.5,NA,9\n')
    rows = read_submissions(spark, [str(tmp_path)]).orderBy("file", "prediction").collect()
    assert [(r["file"], r["prediction"], r["variable"]) for r in rows] == [("narrow.csv", "1.5", "a, b"), ("narrow.csv", "2.5", None), ("wide.csv", "2.5", None)]
    assert rows[2]["columns"] == [*extra, "prediction", "ensemble"] and rows[0]["columns"] == ["prediction", "variable"]
    assert read_submissions(spark, [str(tmp_path / "wide.csv")]).where("false").count() == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2024-01-03", "2024-01-03 00:00:00"),
        ("2024-01-03 06:30", "2024-01-03 06:30:00"),
        ("2024-01-03T06:30:15", "2024-01-03 06:30:15"),
        ("2024-01-03T06:30:15.000Z", "2024-01-03 06:30:15"),
        ("2024-01-03T06:30:15+02:00", "2024-01-03 04:30:15"),
        ("2024-13-03", None),
        ("20240103", None),
        ("2024", None),
    ],
)
def test_times(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(ops._time("t").cast("string").alias("t")).first()["t"]
    assert got == want


@pytest.mark.parametrize(("duration", "day", "ok"), [("PT1H", "2024-01-11", True), ("PT1H", "2024-01-12", False), ("P1D", "2024-02-05", True), ("P9D", "2024-02-05", True)])
def test_horizon_depends_on_duration(spark, duration, day, ok):
    groups = {"g": {"variable": ["x", "x"], "duration": ["P1D", "PT1H"], "max_horizon": [35, 10]}}
    failed, _ = report(spark, ops.allowed_combinations(spark, groups), [{"duration": duration, "datetime": day}])
    assert ("horizon_allowed" not in failed) is ok


def test_ingest_stream_resumes_and_rejects(spark, allowed, tmp_path):
    drop = tmp_path / "drop"
    for delivery in ([1, 2, 3], [4]):
        write_files(drop, delivery)
        rows = jobs.submission_files(spark, str(drop), files_per_batch=2)
        jobs.run_ingest(rows, allowed, "p", F.lit("2024-01-02 00:00:00"), str(tmp_path / "store"), str(tmp_path / "position"))
    stored = spark.read.parquet(str(tmp_path / "store" / "summaries"))
    got = {r["model_id"]: r["mean"] for r in stored.collect()}
    assert got == {"m1": 2.5, "m2": 3.5, "m4": 5.5}
    forecasts = spark.read.parquet(str(tmp_path / "store" / "forecasts"))
    assert forecasts.count() == 12


def test_bundling_twice_is_bundling_once(spark):
    df = spark.createDataFrame([("a", "1", 1.0), ("a", "2", None), (None, "1", 1.0)], "model_id string, parameter string, prediction double")
    bundle = spark.createDataFrame([("a", "1", 1.0), ("b", "1", 2.0)], df.schema)
    once = ops.bundle_forecasts(df, bundle)
    assert once.count() == 2 and ops.bundle_forecasts(df, once).count() == 2
