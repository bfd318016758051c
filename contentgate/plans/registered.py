"""Registration of queries together with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentgate.session import configure

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A test table; local timestamps become instants in the session's zone (UTC)."""
    df = configure(spark).read.parquet(f"{sf_dir}/{table}.parquet")
    if spread := spark.conf.get("spark.contentgate.spread", None):
        # set by the benchmark alone: its files have one row group, which one task would read
        df = df.repartition(int(spread))
    zoned = [F.col(name).cast("timestamp").alias(name) if kind == "timestamp_ntz" else F.col(name)
             for name, kind in df.dtypes]
    return df.select(*zoned)


def sql_text(value: str) -> str:
    """A string literal for the oracle."""
    return "'" + value.replace("'", "''") + "'"


def values_rows(rows) -> str:
    """Rows of a VALUES list for the oracle."""
    def one(v):
        if v is None:
            return "NULL"
        return sql_text(v) if isinstance(v, str) else repr(v)
    return ", ".join("(" + ", ".join(one(v) for v in row) + ")" for row in rows)
