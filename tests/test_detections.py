"""Detections: filters, JSON/CSV formats (H8), time zones (F18), the flush
rule (T3) and the distributed row numbering behind it."""

import datetime as dt
import json
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions.scalars import boxes_json, local_datetime
from tessera.operators import detections as DET
from tessera.operators.sequence import rank_in_groups
from tessera.sources.sinks import read_results_csv, report_lines, write_results_csv
from tests.conftest import rows

RAW = ("frame_id long, ts timestamp, source long, process_ms double, "
       "raw_boxes array<struct<x1:int,y1:int,x2:int,y2:int,confidence:double,cls:int>>")


@pytest.fixture()
def det(spark):
    t = dt.datetime(2026, 6, 17, 5, 14, 29)
    return spark.createDataFrame(
        [
            (1, t, 7, 212.19, [(61, 54, 560, 479, 0.8348, 0), (1, 1, 2, 2, 0.39, 0), (3, 3, 4, 4, 0.9, 1)]),
            (2, t + dt.timedelta(seconds=1), 7, 53.08, [(25, 54, 567, 479, 0.4, 0)]),
            (3, t + dt.timedelta(seconds=2), 8, 43.0, []),
        ],
        RAW,
    )


def test_person_rule_class_and_threshold(spark, det):
    got = rows(DET.person_boxes(det), "frame_id", "box_index", "confidence")
    # confidence exactly 0.40 is kept; 0.39 and class 1 are not.
    assert got == [(1, 0, 0.8348), (2, 0, 0.4)]
    assert rows(DET.person_count(det)) == [(1, 1), (2, 1), (3, 0)]


def test_boxes_json_matches_python_json_dumps(spark, det):
    rec = DET.detection_records(det)
    got = dict(rows(rec.select("frame_id", boxes_json("boxes"))))
    assert got[1] == json.dumps([{"x1": 61, "y1": 54, "x2": 560, "y2": 479, "confidence": 0.8348}])
    assert got[3] == json.dumps([])


def test_local_datetime_fixed_offset_and_truncation(spark):
    # The shipped result row: epoch 1781673269.0970316 is 12:14:29 at UTC+7.
    df = spark.createDataFrame([(1781673269.0970316,), (1781673269.9999,)], "e double")
    got = [r[0] for r in df.select(local_datetime("e", "+07:00")).collect()]
    assert got == ["2026-06-17 12:14:29", "2026-06-17 12:14:29"]
    got_region = df.select(local_datetime("e", "Asia/Ho_Chi_Minh")).first()[0]
    assert got_region == "2026-06-17 12:14:29"


def test_results_csv_roundtrip_with_quotes(spark, det, tmp_path):
    # H8: the JSON column holds quotes; escape='"' both ways.
    table = DET.results_table(DET.detection_records(det), "+07:00")
    write_results_csv(table, str(tmp_path / "out"), mode="overwrite")
    back = read_results_csv(spark, str(tmp_path / "out"))
    assert back.count() == 3
    got = {r["frame_id"]: (r["boxes_json"], r["person_count"], len(r["boxes"])) for r in back.collect()}
    assert got[1][1] == got[1][2] == 1 and got[3] == ("[]", 0, 0)
    assert rows(back.select(*table.columns)) == rows(table)


def test_reads_reference_style_csv(spark, tmp_path):
    p = tmp_path / "results_local.csv"
    p.write_text(
        "frame_id,timestamp,datetime_str,person_count,process_ms,boxes_json\n"
        '1,1781673269.0970316,2026-06-17 12:14:29,1,212.19,"[{""x1"": 61, ""y1"": 54, ""x2"": 560, '
        '""y2"": 479, ""confidence"": 0.8348}]"\n'
        "2,1781673269.444997,2026-06-17 12:14:29,0,53.08,[]\n",
        encoding="utf-8",
    )
    back = read_results_csv(spark, str(p)).orderBy("frame_id").collect()
    assert back[0]["boxes"][0]["confidence"] == 0.8348 and back[1]["boxes"] == []


def test_frame_stats(spark, det):
    r = DET.frame_stats(DET.detection_records(det)).first()
    assert (r["n_frames"], r["avg_person_count"], r["max_person_count"]) == (3, 2 / 3, 1)


def test_flush_rule_closed_form(spark):
    # 12 rows in one 10 s tick, 3 in the next, one of them exactly on the tick.
    t0 = dt.datetime(2024, 1, 1)
    times = [t0 + dt.timedelta(seconds=0.5 * i) for i in range(12)] + [
        t0 + dt.timedelta(seconds=10), t0 + dt.timedelta(seconds=12), t0 + dt.timedelta(seconds=19.9)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "frame_id long, ts timestamp")
    got = rows(DET.flush_batches(df, F.lit(t0), interval_seconds=10, max_rows=5))
    expect = [(i, 0, i // 5, i % 5) for i in range(12)] + [(12, 1, 0, 0), (13, 1, 0, 1), (14, 1, 0, 2)]
    assert got == expect


def test_flush_rule_matches_reference_buffer_model(spark):
    # Simulate the buffer: append, flush at 5 rows, flush on every tick.
    random.seed(7)
    arrivals = sorted(random.uniform(0, 95) for _ in range(120))
    batches, buf, tick_end, bid = {}, [], 10.0, 0
    for i, t in enumerate(arrivals):
        while t >= tick_end:
            if buf:
                for j in buf:
                    batches[j] = bid
                bid += 1
                buf = []
            tick_end += 10
        buf.append(i)
        if len(buf) >= 5:
            for j in buf:
                batches[j] = bid
            bid += 1
            buf = []
    for j in buf:
        batches[j] = bid
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [(i, t0 + dt.timedelta(microseconds=round(t * 1e6))) for i, t in enumerate(arrivals)],
        "frame_id long, ts timestamp")
    got = DET.flush_batches(df, F.lit(t0), interval_seconds=10, max_rows=5).collect()
    ours = {r["frame_id"]: (r["tick"], r["batch"]) for r in got}
    # Same grouping of rows into write batches.
    groups_ref = {}
    for j, b in batches.items():
        groups_ref.setdefault(b, set()).add(j)
    groups_ours = {}
    for j, k in ours.items():
        groups_ours.setdefault(k, set()).add(j)
    assert sorted(map(sorted, groups_ref.values())) == sorted(map(sorted, groups_ours.values()))


@pytest.mark.parametrize("width", [1, 7, 100])
def test_rank_equals_window_on_skewed_groups(spark, width):
    random.seed(width)
    data = [(("hot" if random.random() < 0.6 else f"g{random.randint(0, 9)}"), random.randint(0, 50), i)
            for i in range(2000)]
    df = spark.createDataFrame(data, "g string, v int, id long").withColumn("part", F.floor(F.col("v") / width))
    ours = rank_in_groups(df, ["g"], "part", ["v", "id"], "rank")
    w = Window.partitionBy("g").orderBy("v", "id")
    ref = df.withColumn("rank", F.row_number().over(w) - 1)
    assert rows(ours.select("g", "v", "id", "rank")) == rows(ref.select("g", "v", "id", "rank"))


def test_rank_without_groups_and_with_a_null_group(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2)], "g string, v int").withColumn("part", F.col("v") % 1)
    assert rows(rank_in_groups(df, ["g"], "part", ["v"], "r"), "g", "v", "r") == [(None, 1, 0), (None, 3, 1), ("a", 2, 0)]
    assert rows(rank_in_groups(df, [], "part", ["v"], "r"), "v", "r") == [(1, 0), (2, 1), (3, 2)]


def test_latency_stats_against_brute_force(spark):
    random.seed(3)
    data = [(i, random.choice([1, 1, 1, 2, 3]), round(random.uniform(40, 60), 2)) for i in range(500)]
    df = spark.createDataFrame(data, "frame_id long, source long, process_ms double")
    got = {r["source"]: r for r in DET.latency_stats(df, ["source"], (0.5, 0.95)).collect()}
    for s in {d[1] for d in data}:
        vals = sorted(d[2] for d in data if d[1] == s)
        n = len(vals)
        r = got[s]
        assert r["n_frames"] == n and r["min_ms"] == vals[0] and r["max_ms"] == vals[-1]
        assert r["p50_ms"] == vals[max(1, math.ceil(0.5 * n)) - 1]
        assert r["p95_ms"] == vals[max(1, math.ceil(0.95 * n)) - 1]
        assert abs(r["avg_ms"] - sum(vals) / n) < 1e-9


def test_score_frames_with_stand_in_model(spark):
    frames = spark.createDataFrame([(1, b"abcdefg"), (2, b""), (3, b"abcd")], "frame_id long, image binary")
    got = DET.score_frames(frames, DET.byte_length_scorer).collect()
    by = {r["frame_id"]: r for r in got}
    assert by[1]["person_count"] == 2 and len(by[1]["boxes"]) == 2
    assert by[2]["person_count"] == 0 and by[3]["person_count"] == 4
    assert all(r["process_ms"] >= 0 for r in got)


def test_scores_are_written_like_the_producers(spark):
    frames = spark.createDataFrame([(1, b"x")], "frame_id long, image binary")

    def factory():
        return lambda images: [[{"x1": 1.9, "y1": -1.9, "x2": 10, "y2": 3.2, "confidence": 0.123456}] for _ in images]

    got = DET.score_frames(frames, factory).first()
    assert tuple(got["boxes"][0]) == (1, -1, 10, 3, 0.1235)
    raw = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 1, 7.12345, [(1, 2, 3, 4, 0.98766, 0)])], RAW)
    rec = DET.detection_records(raw).first()
    assert rec["boxes"][0]["confidence"] == 0.9877 and rec["process_ms"] == 7.12


def test_a_worker_builds_its_model_once(spark, tmp_path):
    folder = str(tmp_path)

    def factory():
        import os
        import tempfile

        tempfile.mkstemp(prefix=f"load-{os.getpid()}-", dir=folder)
        return lambda images: [[] for _ in images]

    frames = spark.range(64).select(F.col("id").alias("frame_id"), F.lit(b"x").alias("image")).repartition(16)
    for _ in range(2):
        assert DET.score_frames(frames, factory, batch_size=3, model_key="counted").count() == 64
    DET.score_frames(frames, factory, model_key="counted").collect()
    loads = [p.name.split("-")[1] for p in tmp_path.iterdir()]
    assert loads and len(loads) == len(set(loads))
    # Another call has a model of its own, whatever its factory is.
    DET.score_frames(frames, factory).collect()
    assert len(list(tmp_path.iterdir())) > len(loads)


def test_report_lines_hand_written(spark):
    # H5: %.2f is HALF_UP here (4.125 -> 4.13); titles over 38 chars are cut.
    df = spark.createDataFrame(
        [(1, "A" * 39, "Nam (M)", 4.125), (2, "Short", "Nu (F)", 2.675), (3, "Mid", "F", None)],
        "movie_id long, title string, gender_label string, avg_rating double",
    )
    got = [r[0] for r in report_lines(df, [("title", 40), ("gender_label", 10)], "avg_rating",
                                      [F.col("movie_id")], title_col="title").collect()]
    assert got[0] == "A" * 35 + "..." + "  " + " | Nam (M)    | 4.13"
    assert got[1] == "Short" + " " * 35 + " | Nu (F)     | 2.68"
    assert got[2] == "Mid" + " " * 37 + " | F          | N/A"


def test_hot_tick_is_spread_over_many_tasks(spark):
    # A tick holding 40% of all rows: the numbering is still exact, and the
    # hot tick's rows are cut over several range partitions (tasks) instead
    # of sitting in one window partition.
    t0 = dt.datetime(2024, 1, 1)
    hot = [(i, t0 + dt.timedelta(seconds=1 + (i % 900) / 1000)) for i in range(4000)]
    cold = [(4000 + i, t0 + dt.timedelta(seconds=10 * (1 + i // 7))) for i in range(6000)]
    df = spark.createDataFrame(hot + cold, "frame_id long, ts timestamp")
    got = DET.flush_batches(df, F.lit(t0), interval_seconds=10, max_rows=5)
    hot_rows = got.filter("tick = 0")
    assert hot_rows.count() == 4000
    # ranks 1..4000 inside the hot tick, in (ts, frame_id) order
    w = Window.partitionBy("tick").orderBy("ts", "frame_id")
    ref = (df.withColumn("tick", F.floor((F.unix_seconds(F.to_timestamp("ts")) - 1704067200) / 10).cast("long"))
             .withColumn("rn", F.row_number().over(w)))
    expect = ref.select("frame_id", "tick", F.floor((F.col("rn") - 1) / 5).cast("long").alias("batch"),
                        ((F.col("rn") - 1) % 5).cast("int").alias("row_in_batch"))
    assert rows(got) == rows(expect)


def test_report_cells_occupation_layout(spark):
    # "%-25s | %-12.2f | %d": name, padded mean, count.
    from tessera.sources.sinks import report_cells

    df = spark.createDataFrame([("Student", 3.5, 2), ("Unknown (7)", 2.125, 1)],
                               "occupation string, avg_rating double, n_ratings long")
    got = [r[0] for r in report_cells(df, [("occupation", "s", 25), ("avg_rating", "f2", 12), ("n_ratings", "d", None)],
                                      [F.col("occupation")]).collect()]
    assert got == ["Student" + " " * 18 + " | 3.50         | 2",
                   "Unknown (7)" + " " * 14 + " | 2.13         | 1"]
