"""Tables that streams write: commit log, compaction, merged totals and the
quarantine of broken JSON lines, over restarts and replays."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import detections as DET
from tessera.plans import bindings as B
from tessera.sources.sinks import RESULTS_SCHEMA
from tessera.streaming import detections as SD
from tessera.streaming import records as REC
from tessera.streaming.append_table import AppendTable, stream_to_table
from tessera.streaming.commits import CommitLog
from tessera.streaming.totals import TotalsTable, stream_totals
from tests.conftest import SF_SMALL, rows


def numbers(spark, a, b):
    return spark.range(a, b, numPartitions=1).withColumn("v", F.concat(F.lit("v"), "id"))


def data_folders(path):
    return sorted(os.listdir(f"{path}/data"))


def forget_commit(checkpoint, batch):
    """As if the driver had gone after the sink and before the stream's commit."""
    for name in (f"{batch}", f".{batch}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{name}"):
            os.remove(f"{checkpoint}/commits/{name}")


# --- the log


def test_a_batch_is_committed_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"))
    assert log.state()["version"] == -1 and not log.committed("a", 0)
    assert log.add([{"folder": "x"}], "a", 0)["version"] == 0
    assert log.add([{"folder": "y"}], "a", 0) is None
    assert log.add([{"folder": "z"}], "b", 0)["version"] == 1  # another writer counts for itself
    assert [e["folder"] for e in log.state()["live"]] == ["x", "z"]
    assert log.replace([{"folder": "y"}], [{"folder": "n"}]) is None  # not there any more
    assert log.replace([{"folder": "x"}], [{"folder": "n"}])["live"] == [{"folder": "z"}, {"folder": "n"}]
    assert [e["folder"] for e in log.state(1)["live"]] == ["x", "z"]  # a reader of that state goes on


def test_two_writers_collide_and_none_is_lost(spark, tmp_path):
    one, two = CommitLog(spark, str(tmp_path / "t")), CommitLog(spark, str(tmp_path / "t"))
    seen = []

    def slow(state):
        if not seen:  # the other writer is first with this number
            seen.append(two.add([{"folder": "two"}], "b", 0))
        state["live"].append({"folder": "one"})
        return state

    assert one.change(slow)["version"] == 1
    assert [e["folder"] for e in one.state()["live"]] == ["two", "one"]


# --- append and compact


def test_many_batches_become_few_folders(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "t"), fan=3)
    for i in range(20):
        assert table.append(numbers(spark, 10 * i, 10 * i + 10), i)
        assert table.rows() == 10 * (i + 1)
    live = table.log.state()["live"]
    assert sorted((e["level"], e["rows"]) for e in live) == [(0, 10), (0, 10), (2, 90), (2, 90)]  # 20 = 202 to the base 3
    assert rows(table.read(), "id") == [(i,) for i in range(200)]
    assert not table.append(numbers(spark, 0, 10), 3)  # an old batch once more
    table.optimize()
    live = table.log.state()["live"]
    assert len(live) == 1 and live[0]["rows"] == 200
    assert len([f for f in os.listdir(f"{table.path}/{live[0]['folder']}") if f.endswith(".parquet")]) == 1
    assert rows(table.read(), "id", "v") == [(i, f"v{i}") for i in range(200)]


def test_readers_of_an_older_state_finish(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "t"), fan=2)
    table.append(numbers(spark, 0, 5), 0)
    before = table.read()  # planned before the merge
    table.append(numbers(spark, 5, 9), 1)
    assert len(table.log.state()["live"]) == 1
    assert before.count() == 5 and table.read().count() == 9
    replaced = len(data_folders(table.path))
    assert table.log.vacuum(keep=5) == 0
    table.append(numbers(spark, 9, 10), 2)
    assert table.log.vacuum(keep=1) == 2 and len(data_folders(table.path)) == replaced - 2 + 1
    assert table.read().count() == 10


def test_leftovers_of_a_failed_attempt_are_not_read(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "t"))
    table.append(numbers(spark, 0, 5), 0)
    table._write(numbers(spark, 5, 9), 0)  # written, never committed
    assert len(data_folders(table.path)) == 2 and table.read().count() == 5
    assert table.append(numbers(spark, 5, 9), 1) and table.read().count() == 9


def test_empty_batches_and_an_empty_table(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        table.read()
    table.append(numbers(spark, 0, 0), 0)
    assert table.read().schema.names == ["id", "v"] and table.read().count() == 0
    table.append(numbers(spark, 0, 2), 1)
    assert table.read().count() == 2


def staged(df, path, files):
    df.repartitionByRange(files, "event_id").sortWithinPartitions("event_id").write.parquet(path)


def test_results_csv_over_restarts_and_a_replay(spark, tmp_path):
    ev = B.table(spark, SF_SMALL, "events")
    src, ckpt = str(tmp_path / "in"), str(tmp_path / "ckpt")
    half = ev.count() // 2
    table = AppendTable(spark, str(tmp_path / "t"), "csv", fan=3)

    def run_once():
        stream = SD.read_stream(spark, src, ev.schema)
        results = DET.results_table(DET.detection_records(B.detections_from_events(stream)), "+07:00")
        SD.run_to_end(stream_to_table(results, table, ckpt))

    for i, part in enumerate((ev.filter(F.col("event_id") < half), ev.filter(F.col("event_id") >= half))):
        staged(part, f"{src}{i}", 4)
        os.makedirs(src, exist_ok=True)
        for name in os.listdir(f"{src}{i}"):
            if name.endswith(".parquet"):
                os.rename(f"{src}{i}/{name}", f"{src}/{i}-{name}")
        run_once()
    want = rows(DET.results_table(DET.detection_records(B.detections_from_events(ev)), "+07:00"))
    assert table.log.state()["last"] == {"stream": 7} and len(table.log.state()["live"]) < 8
    assert rows(table.read().select(*RESULTS_SCHEMA.fieldNames())) == want
    forget_commit(ckpt, 7)
    run_once()
    assert rows(table.read().select(*RESULTS_SCHEMA.fieldNames())) == want


# --- totals


def test_totals_rewrite_what_changed_only(spark, tmp_path):
    table = TotalsTable(spark, str(tmp_path / "t"), ["source"], buckets=8, merge_folders=3)
    keys = spark.range(4000).select(F.concat(F.lit("s"), "id").alias("source"), F.lit(1).cast("long").alias("total"))
    table.apply(keys, 0)
    table.compact(everything=True)
    base = table.log.state()
    assert {e["kind"] for e in base["live"]} == {"base"} and len(base["live"]) == 8
    few = keys.filter(F.substring("source", 2, 9).cast("long") < 40).withColumn("total", F.lit(2).cast("long"))
    table.apply(few, 1)
    new = [e for e in table.log.state()["live"] if e not in base["live"]]
    assert sum(e["rows"] for e in new) == 40 and {e["kind"] for e in new} == {"delta"}  # 1 % of the sources
    assert rows(table.read().groupBy("total").count()) == [(1, 3960), (2, 40)]


def test_outgrown_buckets_are_merged_alone(spark, tmp_path):
    table = TotalsTable(spark, str(tmp_path / "t"), ["source"], buckets=4, merge_folders=2)
    keys = spark.range(400).select(F.col("id").alias("source"))
    bucket = {r.source: r["__t_bucket"] for r in table._bucketed(keys).collect()}
    table.apply(keys.withColumn("total", F.lit(1).cast("long")), 0)
    table.compact(everything=True)
    hot = [k for k, b in bucket.items() if b == 2]
    for i in range(1, 5):
        changed = spark.createDataFrame([(k, 10 * i) for k in hot], "source long, total long")
        table.apply(changed, i)
    live = table.log.state()["live"]
    assert {(e["bucket"], e["kind"]) for e in live} == {(b, "base") for b in range(4)}
    assert sum(e["rows"] for e in live) == 400  # old totals are gone
    assert dict(rows(table.read())) == {k: 40 if k in hot else 1 for k in bucket}


def test_stream_totals_with_null_keys_over_a_replay(spark, tmp_path):
    src, ckpt = str(tmp_path / "in"), str(tmp_path / "ckpt")
    table = TotalsTable(spark, str(tmp_path / "t"), ["source", "kind"], buckets=4, merge_folders=2)
    data = [(["a", "b", None, "c"][i * i % 4 if i % 3 else 2], i % 2) for i in range(300)]
    schema = "source string, kind int"

    def run_once():
        stream = SD.read_stream(spark, src, T.StructType.fromDDL(schema))
        SD.run_to_end(stream_totals(stream, table, ckpt))
        return rows(table.read())

    for i in range(3):
        spark.createDataFrame(data[100 * i : 100 * i + 100], schema).coalesce(1).write.mode("append").parquet(src)
        got = run_once()
        seen = spark.createDataFrame(data[: 100 * i + 100], schema)
        assert got == rows(seen.groupBy("source", "kind").count())
    forget_commit(ckpt, 2)
    assert run_once() == got


# --- quarantine

GOOD = {"frame_id": 1, "timestamp": 2.5, "person_count": 1, "process_ms": 4.25, "boxes": [{"x1": 1, "y1": 2, "x2": 3, "y2": 4, "confidence": 0.5}]}
BROKEN = [
    ("", REC.EMPTY),
    (" \t", REC.EMPTY),
    (json.dumps(GOOD)[:30], REC.NOT_JSON),
    (json.dumps(GOOD) + " tail", REC.NOT_JSON),
    (json.dumps(GOOD) + json.dumps(GOOD), REC.NOT_JSON),
    (json.dumps(GOOD) + "," + json.dumps(GOOD), REC.NOT_JSON),
    (json.dumps(GOOD) + ', "x": 1', REC.NOT_JSON),
    (json.dumps(GOOD) + "]", REC.NOT_JSON),
    ("[1, 2]", REC.NOT_OBJECT),
    ("null", REC.NOT_OBJECT),
    (json.dumps(GOOD | {"frame_id": "seven"}), REC.BAD_VALUE),
    (json.dumps(GOOD | {"person_count": 1.5}), REC.BAD_VALUE),
    (json.dumps({k: v for k, v in GOOD.items() if k != "timestamp"}), REC.MISSING + "timestamp"),
    (json.dumps(GOOD | {"frame_id": None}), REC.MISSING + "frame_id"),
]


def test_every_line_is_a_record_or_has_a_reason(spark):
    fine = [GOOD, {k: v for k, v in GOOD.items() if k not in ("boxes", "process_ms")}, GOOD | {"other": {"a": [1]}}]
    lines = [json.dumps(g) for g in fine] + ["  " + json.dumps(GOOD) + " "] + [b for b, _ in BROKEN] + [None]
    parsed = REC.parse_records(spark.createDataFrame([(x,) for x in lines], "value string"), REC.DETECTION_RECORD, REC.DETECTION_REQUIRED).collect()
    assert [r.reason for r in parsed] == [None] * 4 + [why for _, why in BROKEN] + [REC.EMPTY]
    assert all((r.record is None) == (r.reason is not None) for r in parsed)
    assert parsed[0].record.boxes[0].confidence == 0.5 and parsed[1].record.boxes is None and parsed[2].record.frame_id == 1


def test_quarantine_adds_up_over_restarts_and_replays(spark, tmp_path):
    src, ckpt = tmp_path / "in", str(tmp_path / "ckpt")
    src.mkdir()
    good, bad = (AppendTable(spark, str(tmp_path / n), fan=2) for n in ("good", "bad"))
    lines = [BROKEN[i % len(BROKEN)][0] if i % 5 == 2 else json.dumps(GOOD | {"frame_id": i}) for i in range(120)]

    def run_once():
        stream = REC.read_line_stream(spark, str(src))
        SD.run_to_end(REC.stream_records(stream, REC.DETECTION_RECORD, good, bad, ckpt, REC.DETECTION_REQUIRED))

    for i in range(3):
        (src / f"{i}.json").write_text("\n".join(lines[40 * i : 40 * i + 40]) + "\n")
        run_once()
        assert good.rows() + bad.rows() == 40 * (i + 1)
    # The driver went between the two commits of a batch: the first is kept, the second is done.
    state = bad.log.state()
    bad.log.change(lambda s: s | {"live": [], "last": {"stream": 1}})
    assert bad.log.state()["last"] != state["last"]
    forget_commit(ckpt, 2)
    run_once()
    assert good.rows() == 96 and rows(good.read(), "frame_id") == [(i,) for i in range(120) if i % 5 != 2]
    last = [r for r in bad.read().collect()]
    assert len(last) == len([i for i in range(80, 120) if i % 5 == 2]) and {os.path.basename(r.file) for r in last} == {"2.json"}
    assert {r.reason for r in last} <= {why for _, why in BROKEN}


def test_frames_whose_image_cannot_be_decoded(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    frame = lambda i, image: json.dumps({"frame_id": i, "timestamp": 1.0, "image_b64": image})
    (src / "a.json").write_text("\n".join([frame(1, "YWJj"), frame(2, "%%%"), frame(3, ""), '{"frame_id": 4}']) + "\n")
    good, bad = (AppendTable(spark, str(tmp_path / n)) for n in ("good", "bad"))
    stream = REC.read_line_stream(spark, str(src))
    SD.run_to_end(REC.stream_records(stream, REC.FRAME_RECORD, good, bad, str(tmp_path / "c"), ["frame_id", "timestamp", "image_b64"], REC.undecodable()))
    assert rows(good.read(), "frame_id") == [(1,), (3,)]
    assert sorted(r.reason for r in bad.read().collect()) == ["bad image_b64", "missing timestamp"]
