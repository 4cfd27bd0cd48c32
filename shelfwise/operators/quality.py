"""Declarative data-quality expectations (M1-M7) and dataset profiles.

All counting expectations of one table run in a single aggregation pass; each
uniqueness expectation is one grouped count (partial aggregation keeps a hot
key cheap).  Results are rows, so a gate is just another aggregation.
"""
from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

RESULT_SCHEMA = "table string, expectation string, column string, failed_rows long, success boolean"


@dataclass(frozen=True)
class Expect:
    kind: str            # exists | between | not_null | unique
    column: str
    lo: float | None = None
    hi: float | None = None


def exists(c):
    return Expect("exists", c)


def between(c, lo, hi):
    return Expect("between", c, lo, hi)


def not_null(c):
    return Expect("not_null", c)


def unique(c):
    return Expect("unique", c)


# The four expectation suites of the reference's quality gate.
SUITES = {
    "customers": [exists("customer_id"), exists("age"), exists("region"), between("age", 18, 100),
                  not_null("customer_id"), unique("customer_id")],
    "products": [exists("sku_id"), exists("category"), exists("cost_price"), exists("base_price"),
                 not_null("sku_id"), unique("sku_id")],
    "transactions": [exists("transaction_id"), exists("customer_id"), exists("sku_id"), exists("quantity"),
                     exists("total_amount"), not_null("transaction_id"), unique("transaction_id"),
                     between("quantity", 1, 100)],
    "inventory": [exists("sku_id"), exists("current_stock"), not_null("sku_id"),
                  between("current_stock", 0, 10000)],
}


def missing_columns(df: DataFrame, expected: list[str]) -> list[str]:
    """G2/A7 helper: expected columns absent from ``df`` (declared order)."""
    have = set(df.columns)
    return [c for c in expected if c not in have]


def validate_schema(df: DataFrame, expected: list[str], table: str) -> DataFrame:
    """Raise ValueError listing every missing required column."""
    miss = missing_columns(df, expected)
    if miss:
        raise ValueError(f"{table}: missing required columns {miss}")
    return df


def run_suite(df: DataFrame, table: str, expectations: list[Expect]) -> DataFrame:
    """M5: evaluate a suite -> rows (table, expectation, column, failed_rows, success).
    Nulls are ignored by ``between`` and ``unique``; for ``unique`` the failed
    rows are the rows whose value occurs more than once."""
    spark = df.sparkSession
    cols = set(df.columns)
    counters, uniques, static = [], [], []
    for i, e in enumerate(expectations):
        if e.kind == "exists" or e.column not in cols:
            ok = e.column in cols
            static.append((i, e, None if e.kind == "exists" else None, ok))
            continue
        c = F.col(e.column)
        if e.kind == "between":
            counters.append((i, e, F.count_if((c < F.lit(e.lo)) | (c > F.lit(e.hi)))))
        elif e.kind == "not_null":
            counters.append((i, e, F.count_if(c.isNull())))
        elif e.kind == "unique":
            uniques.append((i, e))
        else:
            raise ValueError(f"unknown expectation {e.kind}")

    parts = []
    if static:
        rows = [(table, e.kind, e.column, None, ok) for _, e, _, ok in static]
        parts.append(spark.createDataFrame(rows, RESULT_SCHEMA))
    if counters:
        one = df.agg(*[agg.alias(f"c{i}") for i, _, agg in counters])
        stack = ", ".join(f"'{e.kind}', '{e.column}', c{i}" for i, e, _ in counters)
        parts.append(one.selectExpr(f"stack({len(counters)}, {stack}) AS (expectation, column, failed_rows)")
                        .select(F.lit(table).alias("table"), "expectation", "column",
                                F.col("failed_rows").cast("long"),
                                (F.col("failed_rows") == 0).alias("success")))
    for _, e in uniques:
        dup = (df.where(F.col(e.column).isNotNull()).groupBy(e.column)
                 .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))
        parts.append(dup.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("failed_rows"))
                        .select(F.lit(table).alias("table"), F.lit(e.kind).alias("expectation"),
                                F.lit(e.column).alias("column"), "failed_rows",
                                (F.col("failed_rows") == 0).alias("success")))
    return reduce(DataFrame.unionByName, parts)


def run_suites(tables: dict[str, DataFrame], suites: dict = SUITES) -> DataFrame:
    """M6: all suites -> one result frame."""
    return reduce(DataFrame.unionByName, [run_suite(tables[t], t, s) for t, s in suites.items()])


def table_summary(results: DataFrame) -> DataFrame:
    """Per table: evaluated, successful, passed (all expectations succeed)."""
    return (results.groupBy("table")
                   .agg(F.count(F.lit(1)).alias("evaluated"),
                        F.count_if("success").alias("successful"))
                   .withColumn("passed", F.col("evaluated") == F.col("successful")))


def gate(results: DataFrame) -> DataFrame:
    """M7: dq_score = passed / total expectations * 100; gate passes only when
    every table passes."""
    return results.agg(F.count(F.lit(1)).alias("total"), F.count_if("success").alias("passed"),
                       F.min(F.col("success").cast("int")).alias("_all")).select(
        "total", "passed", (F.col("passed") * F.lit(100.0) / F.col("total")).alias("dq_score"),
        (F.col("_all") == 1).alias("gate_passed"))


def schema_fields(df: DataFrame) -> list[dict]:
    return [{"name": f.name, "type": f.dataType.simpleString()} for f in df.schema.fields]


def schema_hash(df: DataFrame) -> str:
    """First 12 hex digits of SHA-256 over the canonical JSON of the
    schema's (name, type) list.  Schema metadata only -- no data is read."""
    canon = json.dumps(schema_fields(df), sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(canon.encode()).hexdigest()[:12]


def dataset_profile(df: DataFrame, name: str) -> DataFrame:
    """One row per dataset: name, row count, field count, field list JSON
    and schema hash (for change detection between runs)."""
    fields = json.dumps(schema_fields(df), separators=(",", ":"))
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("dataset"), "row_count", F.lit(len(df.columns)).alias("field_count"),
        F.lit(fields).alias("fields"), F.lit(schema_hash(df)).alias("schema_hash"))
