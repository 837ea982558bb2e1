"""Day-partitioned catalog tables bucketed by key.

Their scans are already spread by the key, so a daily merge shuffles the day's
rows only and never the stored ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def create_bucketed(
    spark: SparkSession,
    table: str,
    fields: dict[str, str],
    day: str,
    key: str,
    buckets: int,
    path: str | None = None,
) -> None:
    """Create the table if it is not there; give a path to keep it outside the warehouse."""
    columns = ", ".join(f"`{c}` {t}" for c, t in {**fields, day: "DATE"}.items())
    location = f"LOCATION '{path}'" if path else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"PARTITIONED BY ({day}) CLUSTERED BY ({key}) INTO {buckets} BUCKETS {location}"
    )


def bucket_count(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Num Buckets")
    return int(rows.first()["data_type"])


def replace_table_days(df: DataFrame, table: str) -> None:
    """Overwrite the days that ``df`` has rows for; it may read the same table."""
    spark = df.sparkSession
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)
