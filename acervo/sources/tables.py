"""Control tables, tabular and JSON sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def replace_table(df: DataFrame, path: str) -> int:
    """Publish a new version of a table.

    The data goes to its own folder first, a one-row record names it after the
    write has committed; readers never see a half-written version.
    """
    spark = df.sparkSession
    version = current_version(spark, path) + 1
    df.write.mode("overwrite").parquet(f"{path}/data/version={version}")
    spark.range(1).select(F.lit(version).alias("version")).write.mode("append").parquet(f"{path}/versions")
    return version


def current_version(spark: SparkSession, path: str) -> int:
    try:
        return spark.read.schema("version int").parquet(f"{path}/versions").agg(F.max("version")).first()[0] or 0
    except AnalysisException:
        return 0


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/data/version={current_version(spark, path)}")


def refuse_existing(spark: SparkSession, names: list[str]) -> None:
    found = [n for n in names if spark.catalog.tableExists(n)]
    if found:
        raise ValueError(f"already there: {', '.join(found)}")


def create_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """Catalog tables with their data below `folder`; none is written if any of the names is taken."""
    for df in tables.values():
        refuse_existing(df.sparkSession, list(tables))
    for name, df in tables.items():
        df.write.option("path", f"{folder.rstrip('/')}/{name}").saveAsTable(name)


def migrate_tab(tab: DataFrame, renames: dict[str, str], types: dict[str, str], key: str | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """Spreadsheet tab to control table: renamed, cast where asked, null keys set aside."""
    table = tab.select(*[
        F.col(f"`{old}`").cast(types.get(new, "string")).alias(new) for old, new in renames.items()
    ])
    if key is None:
        return table, table.limit(0)
    return table.filter(F.col(key).isNotNull()), table.filter(F.col(key).isNull())


def write_csv_with_summary(rows: DataFrame, path: str, filters: dict[str, str]) -> None:
    """New rows as CSV, and a one-row summary with their number and the filters applied."""
    rows.write.mode("overwrite").option("header", True).csv(f"{path}/rows")
    applied = F.create_map(*[F.lit(x) for pair in filters.items() for x in pair]) if filters else F.create_map()
    rows.agg(F.count("*").alias("n_rows")).withColumn("filters", F.to_json(applied)).coalesce(1).write.mode(
        "overwrite").json(f"{path}/summary")


def write_json_records(records: DataFrame, path: str, day: Column) -> None:
    records.withColumn("day", day).write.mode("append").partitionBy("day").json(path)


def write_current_and_history(report: DataFrame, path: str, day: str) -> None:
    """The same content under a fixed name and under its date."""
    report.write.mode("overwrite").parquet(f"{path}/history/date={day}")
    report.write.mode("overwrite").parquet(f"{path}/current")
