"""Running totals per key as a table that is merged, not rewritten.

The stream counts in update mode, so a trigger brings the new totals of the
keys that it touched and of no others. They are written as deltas, cut into
buckets by a hash of the key and numbered by batch; a reader takes the newest
number of each key. A bucket whose deltas outgrow its base is merged into a new
base, alone: what a trigger writes follows the keys it changes, and each row is
rewritten a bounded number of times per doubling of its bucket. All changes go
through a :class:`~tessera.streaming.commits.CommitLog`, so a replayed batch is
not added twice and readers never see half of a merge.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.streaming.commits import CommitLog, run_batches

BUCKETS = 32
#: Deltas of a bucket are merged when they hold as many rows as its base, and
#: at least so many folders.
MERGE_FOLDERS = 8
_BUCKET, _VERSION = "__t_bucket", "__t_version"


class TotalsTable:
    """(key columns, total) with the newest total of every key."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = BUCKETS, merge_folders: int = MERGE_FOLDERS):
        self.spark, self.path, self.keys, self.buckets, self.merge_folders = spark, path.rstrip("/"), list(keys), buckets, merge_folders
        self.log = CommitLog(spark, path)

    def _write(self, rows: DataFrame, kind: str) -> list[dict]:
        """Write rows that have a bucket and a version; an entry a bucket."""
        folder = f"data/{uuid.uuid4().hex}"
        # One task a bucket: a bucket is a bounded share of the keys, and of a merge.
        rows.repartition(self.buckets, _BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")
        schema = T.StructType([f for f in rows.schema.fields if f.name != _BUCKET])
        written = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(_BUCKET, T.LongType())])).parquet(f"{self.path}/{folder}")
        sizes = written.groupBy(_BUCKET).count().collect()  # at most `buckets` rows
        return [{"folder": f"{folder}/{_BUCKET}={b}", "bucket": b, "kind": kind, "rows": n} for b, n in sorted(sizes)]

    def _load(self, entries: list[dict], state: dict) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(state["schema"]))
        if not entries:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{e['folder']}" for e in entries])

    def _newest(self, rows: DataFrame) -> DataFrame:
        values = F.max_by(F.struct("total", _VERSION), F.col(_VERSION)).alias("v")
        return rows.groupBy(*self.keys).agg(values).select(*self.keys, "v.total", f"v.{_VERSION}")

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(_BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)))

    def apply(self, changed: DataFrame, batch_id: int, writer: str = "stream") -> bool:
        """Add the new totals (keys, total) of the keys that a batch changed."""
        if self.log.committed(writer, batch_id):
            return False
        rows = changed.select(*self.keys, "total").withColumn(_VERSION, F.lit(batch_id).cast("long"))
        if not self.log.add(self._write(self._bucketed(rows), "delta"), writer, batch_id, rows.schema.json()):
            return False
        self.compact()
        return True

    def _due(self, state: dict) -> list[dict]:
        """Entries of the buckets whose deltas have outgrown their base."""
        of: dict[int, list[dict]] = {}
        for e in state["live"]:
            of.setdefault(e["bucket"], []).append(e)
        out = []
        for entries in of.values():
            base = sum(e["rows"] for e in entries if e["kind"] == "base")
            deltas = [e["rows"] for e in entries if e["kind"] == "delta"]
            if len(deltas) >= self.merge_folders and sum(deltas) >= base:
                out += entries
        return out

    def compact(self, everything: bool = False) -> list[int]:
        """Merge the buckets that are due (or all); returns their numbers."""
        state = self.log.state()
        due = state["live"] if everything else self._due(state)
        if due:
            merged = self._newest(self._load(due, state))
            self.log.replace(due, self._write(self._bucketed(merged), "base"))
        return sorted({e["bucket"] for e in due})

    def read(self, version: int | None = None) -> DataFrame:
        state = self.log.state(version)
        if state["schema"] is None:
            raise ValueError(f"nothing has been committed to {self.path}")
        return self._newest(self._load(state["live"], state)).select(*self.keys, "total")


def stream_totals(stream: DataFrame, table: TotalsTable, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Keep the number of records of every key of ``stream`` in ``table``."""
    counts = stream.groupBy(*table.keys).agg(F.count(F.lit(1)).alias("total"))
    return run_batches(counts, table.apply, checkpoint, "update", trigger)
