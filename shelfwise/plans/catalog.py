"""Registry of named queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each registered query reads the driver's tables (through the views in
``shelfwise.sources.views``) and runs one operator over the whole tables.
``finalize`` fixes the output representation shared with the oracle SQL:
DECIMAL money becomes DOUBLE only here, doubles are rounded to 6 places,
dates are rendered ``yyyy-MM-dd``.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        return fn
    return deco


def finalize(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DecimalType):
            out.append(F.round(c.cast("double"), 6).alias(f.name))
        elif isinstance(t, (T.DoubleType, T.FloatType)):
            out.append(F.round(c.cast("double"), 6).alias(f.name))
        elif isinstance(t, T.DateType):
            out.append(F.date_format(c, "yyyy-MM-dd").alias(f.name))
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            out.append(c.cast("long").alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    # importing the query modules fills QUERIES
    from . import queries  # noqa: F401
    return dict(QUERIES)
