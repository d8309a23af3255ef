"""The registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.plans.inputs import DUCK, Inputs, with_clause

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _finish(df: DataFrame, floats: list[str]) -> DataFrame:
    """Round the listed columns for comparison and give dates and times one type."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if field.name in floats:
            c = F.round(c, 6) + F.lit(0.0)
        elif field.dataType.typeName() in ("date", "timestamp"):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(field.name))
    return df.select(*out)


def query(name: str, reads: str = "", sql: str | None = None, floats: str = ""):
    """Register a query over the inputs named in ``reads``.

    ``sql`` is the same result in plain SQL over the same inputs; without it only the row count is checked.
    ``floats`` are the columns compared after rounding to six digits.
    """
    rounded = floats.split()

    def register(build: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _finish(build(Inputs(spark, sf_dir)), rounded)

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            parts = [*with_clause(reads.split(), DUCK), f"answer AS ({sql.strip()})"]
            replace = ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in rounded)
            tail = f" REPLACE ({replace})" if replace else ""
            ORACLES[name] = f"WITH {', '.join(parts)} SELECT *{tail} FROM answer"
        return build

    return register
