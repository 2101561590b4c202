"""Query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# SQL macros shared by the oracles (defined inline, so each query stays one statement).
FOLD = "regexp_replace(strip_accents({0}), '[^\\x00-\\x7F]+', '', 'g')"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_fold(expr: str) -> str:
    return FOLD.format(expr)


def sql_slug(expr: str, n: int) -> str:
    dashed = f"lower(trim(regexp_replace({sql_fold(expr)}, '[^a-zA-Z0-9]+', '-', 'g'), '-'))"
    cut = f"left({dashed}, {n})"
    return f"coalesce(trim(CASE WHEN {cut} = '' THEN 'sem-titulo' ELSE {cut} END, '-'), 'sem-titulo')"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"
