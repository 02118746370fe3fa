"""An append-only table that a stream writes and compacts as it goes.

The reference appends a few rows at a time to one CSV file. Here every
micro-batch is a folder of its own, committed once through a
:class:`~tessera.streaming.commits.CommitLog`; small folders are merged in
levels (``fan`` folders of one level become one of the next), so a row is
rewritten as often as the table has levels and the number of live folders stays
logarithmic. Merging reads and writes without a shuffle and is committed
atomically: a reader sees every row once, before, during and after it. A table
of partial results may name a ``combine`` that folds rows together on the way.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.streaming.commits import CommitLog, run_batches

FAN = 16
FILE_BYTES = 256 << 20

#: The results file of the pipeline: a header in every part, quotes doubled.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}


class AppendTable:
    """Rows of the folders that the newest state of ``path`` names."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        fmt: str = "parquet",
        options: dict[str, str] | None = None,
        fan: int = FAN,
        file_bytes: int = FILE_BYTES,
        combine: Callable[[DataFrame], DataFrame] | None = None,
    ):
        if fan < 2:
            raise ValueError("at least two folders must be merged into one")
        self.spark, self.path, self.fmt, self.fan, self.file_bytes, self.combine = spark, path.rstrip("/"), fmt, fan, file_bytes, combine
        self.options = options if options is not None else (CSV_OPTIONS if fmt == "csv" else {})
        self.log = CommitLog(spark, path)

    def _write(self, rows: DataFrame, level: int) -> dict:
        folder = f"data/{uuid.uuid4().hex}"
        seen = Observation()
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
        rows.write.format(self.fmt).options(**self.options).save(f"{self.path}/{folder}")
        fs, where = self.log._fs(f"{self.path}/{folder}")
        return {"folder": folder, "level": level, "rows": seen.get["rows"], "bytes": fs.getContentSummary(where).getLength()}

    def append(self, batch: DataFrame, batch_id: int, writer: str = "stream") -> bool:
        """Add the rows of a batch, unless it has been added before."""
        if self.log.committed(writer, batch_id):
            return False
        entry = self._write(batch, 0)
        if not self.log.add([entry] if entry["rows"] else [], writer, batch_id, batch.schema.json()):
            return False
        self.compact()
        return True

    def _load(self, entries: list[dict], state: dict) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(state["schema"]))
        paths = [f"{self.path}/{e['folder']}" for e in entries]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.format(self.fmt).options(**self.options).schema(schema).load(paths)

    def _merge(self, entries: list[dict], level: int, state: dict) -> None:
        files = max(1, -(-sum(e["bytes"] for e in entries) // self.file_bytes))
        rows = self._load(entries, state)
        rows = self.combine(rows) if self.combine else rows.coalesce(files)
        self.log.replace(entries, [self._write(rows, level)])

    def compact(self) -> None:
        """Merge every level that is full."""
        level = 0
        while True:
            state = self.log.state()
            levels = [e["level"] for e in state["live"]]
            if level > max(levels, default=-1):
                return
            due = [e for e in state["live"] if e["level"] == level]
            if len(due) >= self.fan:
                self._merge(due, level + 1, state)
            level += 1

    def optimize(self) -> None:
        """Merge everything into files of ``file_bytes``."""
        state = self.log.state()
        if len(state["live"]) > 1:
            self._merge(state["live"], max(e["level"] for e in state["live"]), state)

    def read(self, version: int | None = None) -> DataFrame:
        """All rows, each once."""
        state = self.log.state(version)
        if state["schema"] is None:
            raise ValueError(f"nothing has been committed to {self.path}")
        return self._load(state["live"], state)

    def rows(self) -> int:
        return sum(e["rows"] for e in self.log.state()["live"])


def stream_to_table(
    stream: DataFrame, table: AppendTable, checkpoint: str, trigger: str | None = None, reduce: Callable[[DataFrame], DataFrame] | None = None
) -> StreamingQuery:
    """Append every micro-batch of ``stream`` to ``table``, once; with
    ``reduce``, what it makes of the batch (partial aggregates, say)."""
    put = (lambda batch, i: table.append(reduce(batch), i)) if reduce else table.append
    return run_batches(stream, put, checkpoint, "append", trigger)
