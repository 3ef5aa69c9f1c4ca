"""Tables laid out by patient, so that joins on the patient move nothing.

Rows are dealt to a fixed number of buckets by a hash of the key and sorted within them
when written. Two tables with as many buckets are then joined bucket by bucket where they
lie; an aggregate by the key needs no exchange either. Runs are added to one table, a
partition each, so that a query on one run reads no other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

KEY = "patient_id"
#: Of a table of some TB, with 200 MB a bucket. All tables that meet have as many.
BUCKETS = 4096


def store(df: DataFrame, table: str, buckets: int = BUCKETS, key: str = KEY) -> None:
    """Write a table by key, replacing it. The exchange is paid here, once."""
    dealt = df.repartition(buckets, key).sortWithinPartitions(key)
    dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def store_run(df: DataFrame, table: str, run_id: str, buckets: int = BUCKETS, key: str = KEY) -> None:
    """Add a run to a table by key, or replace it there. Other runs stay as they are."""
    spark = df.sparkSession
    dealt = df.withColumn("run_id", F.lit(run_id)).repartition(buckets, key).sortWithinPartitions(key)
    if spark.catalog.tableExists(table):
        quoted = run_id.replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (run_id = '{quoted}') PURGE")
        dealt.select(spark.table(table).columns).write.mode("append").format("parquet").partitionBy("run_id").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    else:
        dealt.write.format("parquet").partitionBy("run_id").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
