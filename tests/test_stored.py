"""Headers, line numbers, inferred types, bucketed tables, joins of hot keys and
stored partial aggregates."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.operators import ratings as R
from tessera.operators import skew
from tessera.operators import text as TX
from tessera.sources import delimited as SRC
from tessera.sources import infer
from tessera.sources.bucketed import drop_bucketed, write_bucketed
from tessera.sources.sinks import write_tsv
from tessera.streaming.append_table import AppendTable
from tests.conftest import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    """Set session values for one test."""
    before = {}

    def put(**values):
        for k, v in values.items():
            k = k.replace("__", ".")
            before.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)

    yield put
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# --- headers and line numbers


def write_files(tmp_path, files):
    for name, lines in files.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("".join(line + "\n" for line in lines))


BIG = [f"{i},{i % 7}" for i in range(5000)]
FILES = {
    "d/a.txt": ["id,n", "1,2", "id,n", "3,4"],  # the second is data
    "d/b.txt": ["key,value", *BIG[:2500], "key,value", *BIG[2500:]],
    "d/c.txt": ["5,6", "id,n"],  # no header
    "d/e.txt": [],
    "d/f.txt": ["id,n"],
}


@pytest.mark.parametrize("split", ["128m", "4096"])
def test_first_lines_go_and_their_copies_stay(spark, tmp_path, conf, split):
    conf(spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="1")
    write_files(tmp_path, FILES)
    lines = SRC.read_lines(spark, str(tmp_path / "d"), numbered=True)
    kept = SRC.drop_file_headers(lines, SRC.unlike_types(["id", "n"], {"n": "int"}))
    assert rows(kept, "value") == sorted((x,) for x in ["1,2", "id,n", "3,4", *BIG, "key,value", "5,6", "id,n"])
    every = SRC.drop_file_headers(lines)
    assert rows(every, "value") == sorted((x,) for f in FILES.values() for x in f[1:])


def test_many_files_meet_by_shuffle(spark, tmp_path, conf, monkeypatch):
    monkeypatch.setattr(SRC, "BROADCAST_FILES", 2)
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    write_files(tmp_path, FILES)
    every = SRC.drop_file_headers(SRC.read_lines(spark, str(tmp_path / "d"), numbered=True))
    assert "BroadcastHashJoin" not in plan(every)
    assert rows(every, "value") == sorted((x,) for f in FILES.values() for x in f[1:])


@pytest.mark.parametrize("split", ["128m", "4096"])
def test_lines_are_numbered_over_files_and_blocks(spark, tmp_path, conf, split):
    conf(spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="1")
    write_files(tmp_path, FILES)
    got = SRC.number_lines(SRC.read_lines(spark, str(tmp_path / "d"), numbered=True))
    want = [x for name in sorted(FILES) for x in FILES[name]]
    assert [r.value for r in sorted(got.select("position", "value").collect())] == want
    assert rows(got, "position") == [(i,) for i in range(len(want))]


def test_key_order_is_that_of_the_files(spark, tmp_path):
    rng = random.Random(3)
    data = [("".join(rng.choice("aZ é_0") for _ in range(rng.randint(0, 4))), i) for i in range(800)]
    write_tsv(spark.createDataFrame(data, "k string, v long"), str(tmp_path / "t"), sort_by=["k", "v"])
    got = SRC.number_lines(SRC.read_lines(spark, str(tmp_path / "t"), numbered=True)).collect()
    want = [f"{k}\t{v}" for k, v in sorted(data, key=lambda x: (x[0].encode(), x[1]))]
    assert [r.value for r in sorted(got, key=lambda r: r.position)] == want


def test_rows_and_rejects_are_all_lines(spark):
    lines = ["1,2,3.5,9", "1,2", "1,2,,", "", "1,2,x,9", "1,2,3,y", "1,2,3", "1,2,,9", None]
    df = spark.createDataFrame([(x, i) for i, x in enumerate(lines)], "value string, no int")
    args = dict(columns=["u", "m", "r", "t"], min_fields=3, types={"r": "double", "t": "long"}, keep=["no"])
    bad = {r.no: (r.n_fields, r.reason) for r in SRC.rejected_lines(df, **args).collect()}
    assert bad == {1: (2, "few fields"), 2: (2, "few fields"), 3: (1, "few fields"), 4: (4, "bad r"), 5: (4, "bad t"), 7: (4, "bad r")}
    good = SRC.parse_delimited(df.filter(~df.no.isin(*bad)), **args).collect()
    assert {r.no for r in good} | set(bad) == set(range(8))  # a null is no line


# --- inferred types


def test_every_value_counts(spark):
    columns = {
        "small": ["1", " -2 ", "+3", ""],
        "large": ["1", "3000000000", None, "4"],
        "whole": ["1", "9" * 30, "2", "3"],
        "too_whole": ["1", "9" * 39, "2", "3"],
        "real": ["1", "2.5", "-1e3", "NaN"],
        "when": ["2024-01-02", "2024-01-02 03:04:05", "2024-1-2", ""],
        "truth": ["true", "FALSE", "", None],
        "nothing": ["", None, "", " "],
        "words": ["1", "2", "3", "x"],
        "number or date": ["1", "2024-01-02", "", ""],
    }
    raw = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"`{c}` string" for c in columns))
    report = {r["column"]: r for r in infer.type_report(raw).collect()}
    kinds = {c: r["type"] for c, r in report.items()}
    assert kinds == {
        "small": "int", "large": "bigint", "whole": "decimal(38,0)", "too_whole": "double", "real": "double", "when": "timestamp",
        "truth": "boolean", "nothing": "string", "words": "string", "number or date": "string",
    }
    assert (report["words"]["values"], report["words"]["breaks"]["int"], report["words"]["breaks"]["boolean"]) == (4, 1, 4)
    assert (report["nothing"]["values"], report["nothing"]["nulls"]) == (0, 4)
    assert (report["large"]["breaks"]["int"], report["large"]["breaks"]["bigint"], report["large"]["nulls"]) == (1, 0, 1)
    typed = infer.typed(raw, infer.inferred_schema(raw)).collect()
    assert [r.small for r in typed] == [1, -2, 3, None] and typed[1].large == 3_000_000_000 and typed[2].real == -1000.0
    assert typed[0].when == dt.datetime(2024, 1, 2) and typed[1].truth is False and typed[3].nothing == " "


def test_inference_is_one_aggregate(spark):
    raw = spark.createDataFrame([("1", "x")], "a string, b string")
    assert plan(infer.type_report(raw)).count("Exchange SinglePartition") == 1


def test_nothing_to_infer_from(spark):
    raw = spark.createDataFrame([], "a string")
    assert [(r["type"], r["values"]) for r in infer.type_report(raw).collect()] == [("string", 0)]


# --- buckets


def test_labelled_words_are_counted_without_an_exchange_of_texts(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    reviews = [(i, "good room. good bed, the view" if i % 2 else "bad bath the noise noise", "x", "hotel") for i in range(60)]
    reviews = spark.createDataFrame([*reviews, (None, "no id", "x", "hotel")], "id long, comment string, aspect string, category string")
    labels = spark.createDataFrame([(i, "positive" if i % 2 else "Negative") for i in range(0, 60, 3)], "id long, sentiment string")
    a, b = (write_bucketed(df, "id", 4) for df in (reviews, labels))
    got = TX.category_sentiment_top_words(a, ["the"], sentiments=b, broadcast_labels=0)
    assert rows(got) == rows(TX.category_sentiment_top_words(reviews, ["the"], sentiments=labels))
    assert rows(got) == [("hotel", "negative", "noise(20) bad(10) bath(10)"), ("hotel", "positive", "good(20) bed(10) room(10) view(10)")]
    below = plan(got).split("functions=[partial_count(1)")[1]
    below = below[: below.rindex("FileScan")]  # the two scans, their join and the words
    assert below.count("FileScan") == 1 and "SortMergeJoin" in below and "Generate" in below and "Exchange" not in below


def test_a_bucketed_table_keeps_its_name_until_it_is_dropped(spark):
    write_bucketed(spark.range(10), "id", 2, name="ten_ids")
    assert spark.table("ten_ids").count() == 10
    drop_bucketed(spark, "ten_ids")
    assert not spark.catalog.tableExists("ten_ids")


def test_only_labelled_reviews_are_tokenized(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    reviews = spark.createDataFrame([(1, "a b", "x", "c")], "id long, comment string, aspect string, category string")
    labels = spark.createDataFrame([(1, "positive")], "id long, sentiment string")
    for bound, join in ((0, "SortMergeJoin"), (1, "BroadcastHashJoin")):
        got = TX.category_sentiment_top_words(reviews, [], sentiments=labels, broadcast_labels=bound)
        assert re.search(rf"Generate.*{join}", plan(got), re.S)  # words are made above the join
        assert rows(got) == []  # of one letter each


# --- hot keys


@pytest.fixture
def hot(spark):
    """A third of 6000 ratings by one user, some by unknown or no users."""
    rated = spark.range(6000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(1000 + F.col("id") % 900).alias("user_id"),
        (F.col("id") % 50).alias("movie_id"),
        (F.col("id") % 9 / 2).alias("rating"),
    )
    users = spark.createDataFrame([(7, "M")] + [(1000 + i, "MF"[i % 2]) for i in range(850)], "user_id long, gender string")
    return rated, users


def test_hot_keys_are_exact_and_few(spark, hot):
    rated, _ = hot
    assert rows(skew.hot_keys(rated, "user_id", 8)) == [(7, 2000)]
    even = spark.range(64).withColumnRenamed("id", "k")
    assert skew.hot_keys(even, "k", 8).count() == 0
    assert skew.hot_keys(even.filter("false"), "k", 8).count() == 0


@pytest.mark.parametrize("tasks", [2, 8, 5000])
def test_spread_join_is_the_join(spark, hot, tasks):
    rated, users = hot
    assert rows(skew.join_spread(rated, users, "user_id", tasks)) == rows(rated.join(users, "user_id").select("user_id", "movie_id", "rating", "gender"))


def test_a_hot_user_is_in_no_single_task(spark, hot, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="8")
    rated, users = hot
    joined = skew.join_spread(rated, users, "user_id")
    assert "SortMergeJoin" in plan(joined) and "BroadcastHashJoin" in plan(joined)
    sizes = [n for (n,) in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8
    plain = [n for (n,) in rated.join(users, "user_id").groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(plain) > 2 * sum(plain) / 8  # what it is for


def test_spread_reports_are_the_reports(spark, hot):
    rated, users = hot
    users = users.withColumns({"age": F.col("user_id").cast("int") % 70, "occupation_id": F.col("user_id") % 5})
    movies = spark.createDataFrame([(1, "one", "x")], "movie_id long, title string, genres string")
    for report in (R.gender_avg_pivot, R.gender_avg_long, R.age_avg_pivot, R.age_avg_long):
        assert rows(report(rated, users, movies, spread=True)) == rows(report(rated, users, movies))
    jobs = spark.createDataFrame([(1, "clerk")], "occupation_id long, name string")
    assert rows(R.occupation_stats(rated, users, jobs, spread=True)) == rows(R.occupation_stats(rated, users, jobs))


# --- partial aggregates


def test_loads_add_up_to_one(spark, tmp_path, hot):
    rated, _ = hot
    rated = rated.unionByName(spark.createDataFrame([(1, 99, None)], "user_id long, movie_id long, rating double"))
    table = AppendTable(spark, str(tmp_path / "t"), fan=2, combine=R.merge_partials)
    for i in range(5):
        part = rated.filter(F.pmod(F.xxhash64("user_id", "movie_id", "rating"), F.lit(5)) == i)
        table.append(R.rating_partials(part), i)
    assert rows(R.stats_of_partials(table.read())) == rows(R.movie_stats(rated))
    live = table.log.state()["live"]
    assert len(live) == 2 and max(e["rows"] for e in live) == 51  # merged parts hold one row a movie
