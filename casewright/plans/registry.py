"""Query registry: each entry is a Spark plan over the lens and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from casewright.sources.lens import LENS_SQL, Lens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def render(df: DataFrame, decimals: int = 6) -> DataFrame:
    """Comparable output: dates as text, booleans as 0/1, doubles rounded."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # adding zero folds -0.0 into 0.0
            c = F.round(c, decimals) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, decimals: int = 6):
    """Register ``fn(lens) -> DataFrame``; ``sql`` may refer to the lens views by name."""

    def register(fn: Callable[[Lens], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return render(fn(Lens(spark, folder)), decimals)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = f"WITH RECURSIVE {LENS_SQL.strip()}\n{sql.strip()}" if not sql.lstrip().startswith("WITH") else sql
        return fn

    return register
