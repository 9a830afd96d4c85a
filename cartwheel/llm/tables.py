"""Intermediate tables of the operators in the shared folder of the session."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from cartwheel.session import materialise, scratch_dir

__all__ = ["bucketed", "materialise", "scratch_dir"]


def bucketed(df: DataFrame, label: str, by: str, buckets: int) -> DataFrame:
    """Write ``df`` bucketed by a column: later joins on that column read it without a shuffle.

    The name in the catalogue goes at once: the frame knows files and buckets, and the files go with the application.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    (df.write.bucketBy(buckets, by).option("path", scratch_dir(spark, label)).option("compression", "zstd")
     .format("parquet").saveAsTable(name))
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored
