"""Observation tables from raw samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycast.functions import draws, special
from tallycast.functions.timing import floor_to, midnight, ntz
from tallycast.operators.ranks import exact_quantiles, keep_extreme, null_safe_join, value_ranks
from tallycast.operators.series import month_block, with_previous
from tallycast.schema import OBS_KEY

# Names of pollutants and sample lengths in raw air data, and the pollutants measured at two lengths.
POLLUTANTS = {
    "PM2.5 - Local Conditions": "PM2.5",
    "PM10 Total 0-10um STP": "PM10",
    "Ozone": "O3",
    "Nitrogen dioxide (NO2)": "NO2",
}
SAMPLE_LENGTHS = {"1 HOUR": "PT1H", "24 HOUR": "P1D"}
TWO_LENGTHS = ["PM2.5", "PM10", "NO2"]
ACTIVE_DAYS = 180


def _recode(name: str, values: dict[str, str]) -> Column:
    column = F.col(name)
    result = column
    for old, new in values.items():
        result = F.when(column == old, F.lit(new)).otherwise(result)
    return result


def normalize_air_samples(raw: DataFrame) -> DataFrame:
    """Raw air samples with one time, one site id and one variable name per row."""
    coded = raw.withColumns(
        {
            "duration": _recode("sample_duration", SAMPLE_LENGTHS),
            "pollutant": _recode("parameter", POLLUTANTS),
            "site_id": F.concat_ws("-", "state_code", "county_code", "site_number"),
            "datetime": F.to_timestamp_ntz(F.concat_ws(" ", "date_gmt", "time_gmt"), F.lit("yyyy-MM-dd HH:mm")),
            "changed": ntz(F.to_date("date_of_last_change")),
        }
    )
    suffix = F.when(~F.col("pollutant").isin(TWO_LENGTHS), F.lit("")).when(F.col("duration") == "PT1H", F.lit("_P1H"))
    return coded.select(
        "site_id",
        "datetime",
        "duration",
        F.concat("pollutant", suffix.otherwise(F.lit("_P1D"))).alias("variable"),
        "poc",
        F.col("sample_measurement").alias("observation"),
        "changed",
        F.to_date("date_local").alias("date_local"),
        "units_of_measure",
        "latitude",
        "longitude",
    )


def latest_revision(samples: DataFrame) -> DataFrame:
    """Of several versions of a sample the one changed last; the larger value if that does not decide."""
    known = samples.where(F.col("observation").isNotNull())
    keys = ["datetime", "variable", "site_id", "duration", "poc"]
    return keep_extreme(known, keys, [F.col("changed"), F.col("observation")])


def longest_sensor(samples: DataFrame) -> DataFrame:
    """Where several sensors report, the one that has run longest (then the lower number).

    Spans are per sensor, so they are a small aggregate joined back; a window over a sensor's whole record would put
    it into one task.
    """
    sensor = ["site_id", "variable", "poc"]
    spans = samples.groupBy(*sensor).agg(F.max("datetime").alias("_b"), F.min("datetime").alias("_a"))
    spans = spans.select(*sensor, F.date_diff("_b", "_a").alias("sensor_days"))
    keys = ["datetime", "variable", "site_id", "duration"]
    return keep_extreme(samples.join(spans, sensor), keys, [F.col("sensor_days"), -F.col("poc")])


def air_targets(raw: DataFrame, project: str) -> DataFrame:
    best = longest_sensor(latest_revision(normalize_air_samples(raw)))
    return best.select(F.lit(project).alias("project_id"), *OBS_KEY[1:], "observation")


def target_upsert(old: DataFrame, new: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """New observations replace old ones; rounded to six digits, one row per key.

    One aggregate over both sides: a version tag decides, and rows are reduced before the shuffle.
    """
    keys = keys or OBS_KEY
    rounded = F.round("observation", 6)
    both = old.withColumn("_version", F.lit(0)).unionByName(new.withColumn("_version", F.lit(1)))
    both = both.withColumn("observation", rounded).select(*keys, "observation", "_version")
    return keep_extreme(both, keys, [F.col("_version"), F.col("observation")]).drop("_version")


def site_coverage(samples: DataFrame, today: Column) -> DataFrame:
    """First and last day of each variable at each site, and whether it still reports."""
    spans = samples.groupBy("site_id", "variable").agg(
        F.min("date_local").alias("start_date"), F.max("date_local").alias("end_date")
    )
    return spans.withColumn("active", F.col("end_date") >= F.date_sub(today, ACTIVE_DAYS))


def site_places(samples: DataFrame) -> DataFrame:
    """The coordinates a site has been reported with, as comma lists."""

    def listed(name: str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_set(name)), lambda v: v.cast("string")), ", ").alias(name)

    return samples.groupBy("site_id").agg(listed("latitude"), listed("longitude"))


def coverage_wide(coverage: DataFrame, variables: list[str]) -> DataFrame:
    """One row per site with start, end and active columns per variable."""
    picks = []
    for v in variables:
        here = F.col("variable") == v
        picks += [
            F.max(F.when(here, F.col("start_date"))).alias(f"{v}_StartDate"),
            F.max(F.when(here, F.col("end_date"))).alias(f"{v}_EndDate"),
            F.coalesce(F.max(F.when(here, F.col("active"))), F.lit(False)).alias(f"{v}_Active"),
        ]
    return coverage.groupBy("site_id").agg(*picks)


def merge_coverage(old: DataFrame, new: DataFrame) -> DataFrame:
    """Keep the first known start, take the newest end and state."""
    o, n = old.alias("o"), new.alias("n")
    joined = o.join(n, ["site_id", "variable"], "full")
    return joined.select(
        "site_id",
        "variable",
        F.coalesce("o.start_date", "n.start_date").alias("start_date"),
        F.coalesce("n.end_date", "o.end_date").alias("end_date"),
        F.coalesce("n.active", "o.active").alias("active"),
    )


def units_by_variable(samples: DataFrame) -> DataFrame:
    """First year and the list of units of each variable."""
    return samples.groupBy("variable").agg(
        F.min(F.year("datetime")).alias("start_year"),
        F.array_join(F.array_sort(F.collect_set("units_of_measure")), ", ").alias("units_of_measure"),
    )


def merge_units(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old units first, then new ones not listed yet."""

    def listed(name: str) -> Column:
        return F.transform(F.split(name, ","), lambda u: F.trim(u))

    joined = old.alias("o").join(new.alias("n"), "variable", "full")
    none = F.array().cast("array<string>")
    union = F.array_union(F.coalesce(listed("o.units_of_measure"), none), F.coalesce(listed("n.units_of_measure"), none))
    unknown = F.col("o.units_of_measure").isNull() & F.col("n.units_of_measure").isNull()
    return joined.select(
        "variable",
        F.col("o.start_year").alias("start_year"),
        F.when(~unknown, F.array_join(union, ", ")).alias("units_of_measure"),
    )


def availability_ranges(samples: DataFrame) -> DataFrame:
    return samples.groupBy("variable", "site_id").agg(F.min("datetime").alias("start"), F.max("datetime").alias("end"))


def overlapping_sensors(samples: DataFrame) -> DataFrame:
    """Sensors of sites that have more than one for a variable, with their spans."""
    sensors = samples.groupBy("site_id", "variable", "poc").agg(
        F.min("datetime").alias("start"), F.max("datetime").alias("end")
    )
    # one row per sensor is left, the window sees a handful per site
    several = F.count(F.lit(1)).over(Window.partitionBy("site_id", "variable")) > 1
    rows = sensors.withColumn("_several", several).where("_several").drop("_several")
    return rows.withColumn("span_days", F.date_diff("end", "start"))


def sensor_daily_mean(samples: DataFrame, measures: list[str], keys: list[str] | None = None) -> DataFrame:
    """Daily means of the measures over samples with a possible position, and their number."""
    possible = (
        (F.col("longitude") > -180) & (F.col("longitude") < 180) & (F.col("latitude") > -90) & (F.col("latitude") < 90)
    )
    return (
        samples.where(possible)
        .groupBy(*(keys or []), midnight("time").alias("date"))
        .agg(*[F.avg(m).alias(m) for m in measures], F.count(F.lit(1)).alias("n_obs"))
    )


def grid_window_stats(grid: DataFrame, latitude: float, longitude: float, half: int = 2) -> DataFrame:
    """Per day, mean, spread and number of the known cells around the pixel nearest to a point.

    The wanted axis values are found on the distinct coordinates (two short columns), so the grid itself is only
    filtered: no join and no window over its cells.
    """

    def bounds(axis: str, centre: float) -> tuple[Column, Column]:
        # distinct first: what is ordered is one row per grid line, a few thousand at most
        lines = grid.select(axis).distinct().withColumn("_i", F.row_number().over(Window.orderBy(axis)))
        square = (F.col(axis) - F.lit(centre)) * (F.col(axis) - F.lit(centre))
        nearest = lines.agg(F.min(F.struct(square.alias("d"), F.col("_i").alias("i")))["i"]).scalar()
        near = lines.where(F.abs(F.col("_i") - nearest) <= half)
        return near.agg(F.min(axis)).scalar(), near.agg(F.max(axis)).scalar()

    inside = F.col("lat").between(*bounds("lat", latitude)) & F.col("lon").between(*bounds("lon", longitude))
    finite = F.when(~F.isnan("value") & (F.abs("value") != float("inf")), F.col("value"))
    return (
        grid.where(inside)
        .groupBy("date")
        .agg(F.avg(finite).alias("mean"), F.stddev_samp(finite).alias("sd"), F.count(finite).alias("n"))
    )


def to_target_long(
    values: DataFrame, project: str, site: Column, variable: str, duration: str, above: float | None = None
) -> DataFrame:
    """A (date, value) table in target form; missing values, and values not above the threshold, are left out."""
    rows = values.where(F.col("value").isNotNull())
    if above is not None:
        rows = rows.where(F.col("value") > above)
    return rows.select(
        F.lit(project).alias("project_id"),
        site.alias("site_id"),
        ntz("date").alias("datetime"),
        F.lit(duration).alias("duration"),
        F.lit(variable).alias("variable"),
        F.col("value").alias("observation"),
    )


def missing_dates(targets: DataFrame, variable: str, first: Column, today: Column) -> DataFrame:
    """Days from the day after the last stored one (or ``first``) to yesterday that are not stored."""
    stored = targets.where(F.col("variable") == variable).select(F.to_date("datetime").alias("date"))
    start = F.coalesce(F.date_add(F.col("last"), 1), first)
    return _days_between(stored.agg(F.max("date").alias("last")), start, F.date_sub(today, 1)).join(
        stored, "date", "left_anti"
    )


def unstored_dates(targets: DataFrame, variable: str, first: Column, today: Column) -> DataFrame:
    """All days from ``first`` to yesterday that are not stored, gaps included."""
    stored = targets.where(F.col("variable") == variable).select(F.to_date("datetime").alias("date"))
    return _days_between(stored.agg(F.max("date").alias("last")), first, F.date_sub(today, 1)).join(
        stored, "date", "left_anti"
    )


def _days_between(one_row: DataFrame, start: Column, end: Column) -> DataFrame:
    days = F.when(start <= end, F.sequence(start, end))
    return one_row.select(F.explode(days).alias("date"))


# --- correcting a probe against a reference series ----------------------------------------------------------


def paired_ratios(targets: DataFrame, probe: str, reference: str, keys: list[str] | None = None) -> DataFrame:
    """Days on which both methods report a positive value, with their ratio."""
    by = [*(keys or []), "datetime"]
    means = {
        name: F.avg(F.when(F.col("variable") == v, F.col("observation"))).alias(name)
        for name, v in (("probe", probe), ("reference", reference))
    }
    wide = targets.where(F.col("variable").isin(probe, reference)).groupBy(*by).agg(*means.values())
    return wide.where((F.col("probe") > 0) & (F.col("reference") > 0)).select(
        *by,
        "probe",
        "reference",
        (F.col("probe") / F.col("reference")).alias("ratio"),
        F.month("datetime").alias("month"),
    )


def ratio_outlier_dates(pairs: DataFrame, factor: float = 5.0, floor: float = 0.001) -> DataFrame:
    """Days whose ratio is out of range or whose reference is practically zero."""
    out = (F.col("ratio") > factor) | (F.col("ratio") < 1 / factor) | (F.col("reference") <= floor)
    return pairs.where(out).drop("probe", "reference", "ratio", "month").distinct()


def monthly_correction(pairs: DataFrame, outliers: DataFrame) -> DataFrame:
    """Median ratio per calendar month over the other days (exact, and spread over tasks)."""
    by = outliers.columns
    return exact_quantiles(pairs.join(outliers, by, "left_anti"), ["month"], "ratio", {"median_ratio": 0.5})


def apply_correction(
    targets: DataFrame, outliers: DataFrame, correction: DataFrame, probe: str, reference: str, renamed: str
) -> DataFrame:
    """The probe's series without outlier days and divided by its month's factor, beside the reference series."""
    rows = targets.where(F.col("variable") == probe).join(outliers, outliers.columns, "left_anti")
    rows = rows.withColumn("month", F.month("datetime")).join(correction, "month", "left")
    factor = F.col("median_ratio")
    value = F.when(factor > 0, F.try_divide(F.col("observation"), factor)).otherwise(F.col("observation"))
    fixed = rows.withColumns({"observation": value, "variable": F.lit(renamed)}).select(*targets.columns)
    return fixed.unionByName(targets.where(F.col("variable") == reference))


# --- other sources --------------------------------------------------------------------------------------------


def monthly_case_counts(cases: DataFrame, project: str, variable: str, first_year: int = 2007) -> DataFrame:
    """Cases per place and month of onset; an impossible onset date gives way to the notification date."""
    plausible = (F.year("onset_date") >= first_year) & (F.year("onset_date") >= F.col("birth_year"))
    onset = F.when(plausible, F.col("onset_date")).otherwise(F.col("notified_date"))
    counts = (
        cases.withColumn("datetime", floor_to("month", onset))
        .where(F.col("datetime").isNotNull() & F.col("place").isNotNull())
        .groupBy("place", "datetime")
        .agg(F.count(F.lit(1)).cast("double").alias("observation"))
    )
    return counts.select(
        F.lit(project).alias("project_id"),
        F.col("place").alias("site_id"),
        "datetime",
        F.lit("P1M").alias("duration"),
        F.lit(variable).alias("variable"),
        "observation",
    )


def wide_to_long(df: DataFrame, ids: list[str], measures: list[str]) -> DataFrame:
    return df.unpivot(ids, measures, "variable", "observation")


def calendar_densify(targets: DataFrame, variables: list[str], step: str = "1 day") -> DataFrame:
    """Every site, every listed variable and every day of the table's span, so that gaps become explicit nulls.

    The calendar is generated from the sites: nothing is crossed, and each row is made where it is used.
    """
    span = targets.agg(F.min("datetime").alias("a"), F.max("datetime").alias("b"))
    days = F.sequence(span.select("a").scalar(), span.select("b").scalar(), F.expr(f"INTERVAL {step}"))
    frame = (
        targets.select("site_id")
        .distinct()
        .withColumn("variable", F.explode(F.array(*[F.lit(v) for v in variables])))
        .withColumn("datetime", F.explode(days))
    )
    return frame.join(targets.select("site_id", "variable", "datetime", "observation"), frame.columns, "left")


def fill_gaps(targets: DataFrame, keys: list[str], end: Column | None = None, step: str = "1 day") -> DataFrame:
    """Each series made regular between its own first time and ``end`` (or its last time)."""
    spans = targets.groupBy(*keys).agg(F.min("datetime").alias("_a"), F.max("datetime").alias("_b"))
    last = F.col("_b") if end is None else F.greatest(F.col("_b"), ntz(end))
    frame = spans.select(*keys, F.explode(F.sequence("_a", last, F.expr(f"INTERVAL {step}"))).alias("datetime"))
    return frame.join(targets.select(*keys, "datetime", "observation"), frame.columns, "left")


def bootstrap_quantile_sd(
    images: DataFrame, keys: list[str], value: str, n_boot: int = 50, q: float = 0.9, seed: int = 1
) -> DataFrame:
    """Spread of a bootstrapped quantile per group.

    No resample is made. Of as many draws as a group of n has values, the k-th lies at the k-th of n uniform numbers,
    which has a beta distribution, and the next one at the least of the n - k that remain above it. Both are drawn
    directly, and the values at these two places of the sorted group are the ones the quantile lies between.
    """
    known = images.where(F.col(value).isNotNull())
    ranks = value_ranks(known, keys, value)
    sorted_values = ranks.select(*keys, "_v", F.explode(F.sequence(F.col("_before") + 1, F.col("_before") + F.col("_n"))).alias("_pos"))
    plan = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    plan = plan.withColumn("_b", F.explode(F.sequence(F.lit(1), F.lit(n_boot))))
    n = F.col("_size")
    at = (n - 1) * F.lit(q)
    k = F.floor(at) + 1
    low = special.beta_quantile(k.cast("double"), (n - k + 1).cast("double"), draws.uniform(seed, *keys, "_b", F.lit("low")))
    plan = plan.select(*keys, "_b", n.alias("_size"), k.alias("_k"), (at - F.floor(at)).alias("_part"), low.alias("_low"))
    left = F.col("_size") - F.col("_k")
    gap = F.pow(draws.uniform(seed, *keys, "_b", F.lit("high")), F.try_divide(F.lit(1.0), left.cast("double")))
    high = F.when(left > 0, 1 - (1 - F.col("_low")) * gap).otherwise(F.col("_low"))

    def place(u: Column) -> Column:
        return F.greatest(F.least(F.ceil(u * F.col("_size")), F.col("_size")), F.lit(1)).cast("long")

    ends = F.array(
        F.struct(place(F.col("_low")).alias("_pos"), (1 - F.col("_part")).alias("_weight")),
        F.struct(place(high).alias("_pos"), F.col("_part").alias("_weight")),
    )
    wanted = plan.select(*keys, "_b", F.explode(ends).alias("_end")).select(*keys, "_b", "_end._pos", "_end._weight")
    drawn = null_safe_join(wanted, sorted_values, [*keys, "_pos"])
    quantiles = drawn.groupBy(*keys, "_b").agg(F.sum(F.col("_v") * F.col("_weight")).alias("q"))
    return quantiles.groupBy(*keys).agg(F.stddev_samp("q").alias("sd"))


def qc_series(
    df: DataFrame, low: float, high: float, spike: float, by_depth: bool = False, time: str = "datetime"
) -> DataFrame:
    """Null out observations that are out of range, jump by more than ``spike`` or do not move at all.

    A row whose change is unknown (the one after a gap) is dropped to NULL when series are taken per site, and kept
    when they are taken per depth.
    """
    keys = ["site_id", "depth"] if by_depth else ["site_id"]
    rows = with_previous(df, keys, time, "observation", month_block(time))
    value = F.col("observation")
    change = value - F.col("_prev")
    later = ~F.col("_opens")
    out_of_range = ~value.between(low, high)
    # in three-valued logic: NULL and false is false, so the first row of a series is never a spike
    flag = ((F.abs(change) > spike) & later) | out_of_range | ((change == 0) & later)
    keep = ~flag if not by_depth else F.coalesce(~flag, F.lit(True))
    return rows.withColumn("observation", F.when(keep, value)).select(*df.columns)


def standard_error(value: str) -> Column:
    """Standard error of the mean over the known values (an aggregate)."""
    return F.stddev_samp(value) / F.sqrt(F.count(value))


COARSE_RANKS = ["subgenus", "genus", "family", "order"]


def resolve_taxonomy(sorting: DataFrame, para: DataFrame, expert: DataFrame) -> DataFrame:
    """The best identification of each specimen: sorter, then parataxonomist for mixed samples, then expert."""
    names = ["taxonRank", "scientificName", "taxonID", "morphospeciesID"]
    states = ["nativeStatusCode", "sampleCondition"]
    s = sorting.withColumnsRenamed({c: f"s_{c}" for c in names + states})
    p = para.withColumnsRenamed({c: f"p_{c}" for c in names})
    # experts' rows go to individuals first: most sorted rows have none, and would meet in one task by that empty key
    joined = s.join(p.join(expert, "individualID", "left"), "subsampleID", "left")
    mixed = F.col("sampleType") == "other carabid"
    best = {n: F.coalesce(F.col(n), F.when(mixed, F.col(f"p_{n}")), F.col(f"s_{n}")) for n in names}
    best |= {n: F.coalesce(F.col(n), F.col(f"s_{n}")) for n in states}
    rows = joined.select(
        "subsampleID", "individualID", "sampleType", "family", *[c.alias(n) for n, c in best.items()]
    ).where(F.col("sampleType").contains("carabid") & (F.col("family").isNull() | (F.col("family") == "Carabidae")))
    words = F.regexp_extract_all(F.split("scientificName", "/")[0], F.lit(r"[\p{L}\p{N}_']+"), 0)
    binomial = F.array_join(F.slice(words, 1, 2), " ")
    coarse = F.col("taxonRank").isin(COARSE_RANKS) & F.col("morphospeciesID").isNotNull()
    morph = F.when(F.coalesce(coarse, F.lit(False)), F.col("morphospeciesID")).otherwise(binomial)
    return rows.withColumn("morphospecies", morph).distinct()


# --- sensor events in entity-attribute-value form ----------------------------------------------------------------

#: Upstream, buoy and lake positions; the downstream position of a stream is left out.
POSITIONS = ["101", "111", "103"]


def sensor_wide(
    events: DataFrame, terms: list[str], flags: list[str], flag_rule: str = "any_ok", keys: list[str] | None = None
) -> DataFrame:
    """One row per reading with its terms as columns, kept if its quality flags allow.

    ``any_ok`` keeps a reading with at least one flag that is not raised; ``all_ok`` needs all of them unraised.
    """
    by = ["siteName", "startDate", *(keys or [])]
    rows = events.where(F.col("termName").isin(terms) & F.col("horizontalIndex").isin(POSITIONS))
    value = F.coalesce("doubleValue", F.col("intValue").cast("double"))
    wide = rows.groupBy(*by).agg(
        *[F.max(F.when(F.col("termName") == t, value)).alias(t) for t in terms],
    )
    unraised = [F.coalesce(F.col(f) != 1, F.lit(False)) for f in flags]
    join = (lambda a, b: a | b) if flag_rule == "any_ok" else (lambda a, b: a & b)
    return wide.where(reduce(join, unraised)) if flags else wide


def wq_daily(
    events: DataFrame, profiling_sites: list[str], stream_sites: list[str], flag_rule: str = "any_ok"
) -> DataFrame:
    """Daily oxygen and chlorophyll near the surface; streams report oxygen only."""
    terms = ["dissolvedOxygen", "chlorophyll", "sensorDepth", "oxygenQF", "chlorophyllQF"]
    wide = sensor_wide(events, terms, ["oxygenQF", "chlorophyllQF"], flag_rule)
    depth = F.when(F.col("siteName").isin(profiling_sites), F.col("sensorDepth")).otherwise(F.lit(0.5))
    daily = (
        wide.where((depth > 0) & (depth < 1))
        .groupBy(F.col("siteName").alias("site_id"), midnight("startDate").alias("datetime"))
        .agg(F.avg("dissolvedOxygen").alias("oxygen"), F.avg("chlorophyll").alias("chla"))
    )
    long = wide_to_long(daily, ["site_id", "datetime"], ["oxygen", "chla"])
    return long.where(~F.col("site_id").isin(stream_sites) | (F.col("variable") == "oxygen"))


def _thirty_minute(events: DataFrame) -> DataFrame:
    return events.where(F.col("temporalIndex") == "030")


def _temperature(events: DataFrame, depths: DataFrame | None, flag_rule: str) -> DataFrame:
    rows = _thirty_minute(events)
    keys = ["verticalIndex"]
    if depths is not None:
        rows = rows.join(depths, ["siteName", "verticalIndex"])
        keys = ["verticalIndex", "thermistorDepth"]
    return sensor_wide(rows, ["waterTemp", "tempQF"], ["tempQF"], flag_rule, keys)


def _daily_temperature(wide: DataFrame) -> DataFrame:
    daily = wide.groupBy(F.col("siteName").alias("site_id"), midnight("startDate").alias("datetime")).agg(
        F.avg("waterTemp").alias("observation")
    )
    rows = daily.select("site_id", "datetime", F.lit("temperature").alias("variable"), "observation")
    return qc_series(rows, -5, 40, 5)


def temperature_daily(
    events: DataFrame, depths: DataFrame, max_depth: float = 1.0, flag_rule: str = "any_ok"
) -> DataFrame:
    """Daily temperature of the upper metre, quality checked."""
    near = depths.where(F.col("thermistorDepth") <= max_depth)
    return _daily_temperature(_temperature(events, near, flag_rule))


def surface_temperature_daily(events: DataFrame, flag_rule: str = "any_ok") -> DataFrame:
    """Daily temperature from sensors that have only one depth."""
    return _daily_temperature(_temperature(events, None, flag_rule))


def temperature_hourly_profile(
    events: DataFrame, depths: DataFrame, source: str, flag_rule: str = "any_ok"
) -> DataFrame:
    """Hourly temperature per depth, quality checked per depth."""
    wide = _temperature(events, depths, flag_rule)
    hourly = wide.groupBy(
        F.col("siteName").alias("site_id"),
        F.col("thermistorDepth").alias("depth"),
        floor_to("hour", "startDate").alias("datetime"),
    ).agg(F.avg("waterTemp").alias("observation"))
    rows = hourly.select(
        "site_id", "depth", "datetime", F.lit("temperature").alias("variable"), "observation", F.lit(source).alias("source")
    )
    return qc_series(rows, -5, 40, 5, by_depth=True)


def drop_superseded(raw: DataFrame, published: DataFrame) -> DataFrame:
    """Raw rows newer than what has been published for their site; sites without anything published keep all."""
    newest = published.groupBy("site_id").agg(F.max("datetime").alias("_until"))
    rows = raw.join(newest, "site_id", "left")
    return rows.where(F.col("_until").isNull() | (F.col("datetime") > F.col("_until"))).drop("_until")
