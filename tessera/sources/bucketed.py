"""Tables stored in buckets of a key, for joins that move nothing.

Facts and labels of the same key that are joined again and again are written
once, hashed into the same number of buckets and sorted inside them. A join on
the key then reads bucket by bucket: there is no exchange between the scans and
the first aggregate, and no text crosses the network.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.session import scratch_path


def write_bucketed(df: DataFrame, key: str, buckets: int, name: str | None = None, path: str | None = None) -> DataFrame:
    """Store ``df`` in ``buckets`` buckets of ``key``, one file each, as a table
    of the session's catalog, and return it as it is read back. The files lie in
    ``path`` (default: the shared scratch folder).

    Pick the number of buckets so that one fits a task: it is the width of
    every join on the table. A key that holds more rows than a bucket should
    is a hot key; see :mod:`tessera.operators.skew`.
    """
    spark: SparkSession = df.sparkSession
    name = name or f"bucketed_{uuid.uuid4().hex[:12]}"
    path = path or scratch_path(spark, name)
    # The writer hashes like the exchange, so each task writes one bucket.
    rows = df.repartition(buckets, key)
    rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).mode("overwrite").saveAsTable(name)
    return spark.table(name)


def drop_bucketed(spark: SparkSession, name: str) -> None:
    """Forget a table; its files stay, as those of any table with a path."""
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
