"""Top-k search, WARC archives, URL rules and chat rotation against brute
force, with messy input; and the contract of the registered queries."""

import hashlib
import io
import math
import random
import re
import struct
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.llm import chat, common, topk_search, url_rules, warc
from tessera.llm.queries import ORACLE, QUERIES, RULES
from tessera.session import scratch_path

SF = "/root/testdata/sf0.001"


# --- top-k search


def brute_top(vectors, queries, k):
    out = {}
    for q, v in queries:
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), c) for c, w in vectors if c != q)
        out[q] = Counter((c, -s) for s, c in scored[:k])
    return out


@pytest.mark.parametrize("block,query_block", [(37, 5), (8192, 512)])
def test_top_k(spark, block, query_block):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(40)]) for i in range(400)]
    rows += [(400 + i, rows[20][1]) for i in range(60)]  # many equal scores
    rows += [(900, None), (901, [None] + [0.1] * 39), (902, [math.nan] * 40), (903, [math.inf] * 40), (None, [0.1] * 40)]
    rows += [(920, []), (921, [0.5] * 3), (922, [0.0] * 40)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, rank int, score int")
    vectors = topk_search.integer_vectors(df)
    whole = [(r.vec_id, [int(x) for x in r.v]) for r in vectors.collect()]
    assert {i for i, _ in whole} == set(range(460)) | {920, 921, 922}
    assert dict(whole)[3] == [math.floor(64 * float(np.float32(x))) for x in rows[3][1]]
    got = defaultdict(list)
    for r in topk_search.top_k(vectors.filter(topk_search.is_query(F.col("vec_id"))), vectors, 20, query_block, block).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    want = brute_top(whole, [(i, v) for i, v in whole if i % 20 == 0], 20)
    assert got.keys() == want.keys()
    for q, found in got.items():
        assert [r for r, _, _ in sorted(found)] == list(range(1, 21))
        assert Counter((c, s) for _, c, s in found) == want[q]
        assert [(-s, c) for _, c, s in sorted(found)] == sorted((-s, c) for _, c, s in found)


def test_top_k_repeats_and_wide_scores(spark):
    rows = [(0, [2.0**40, 1.0]), (1, [2.0**41, -1.0]), (1, [2.0**41, -1.0]), (2, [3.0, 2.0**30]), (0, [1.0, 1.0])]
    vectors = topk_search.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), scale=1)
    found = topk_search.top_k(vectors.filter("vec_id = 2"), vectors).collect()
    assert Counter((r.vec_id, r.score) for r in found) == Counter(
        [(0, 3 * 2**40 + 2**30), (1, 3 * 2**41 - 2**30), (1, 3 * 2**41 - 2**30), (0, 3 + 2**30)]
    )
    exact = topk_search.search_block(np.array([9]), np.array([[2.0**29]]), np.array([1]), np.array([[2.0**29 + 1]]))
    assert exact == [(9, 1, 2**58 + 2**29)]


@pytest.mark.parametrize("big", [1e9, 1e30, 1.7e308])
def test_top_k_of_any_finite_component(spark, big):
    rows = [(0, [big, 1.0]), (1, [big, 2.0]), (2, [-big, 3.0]), (3, [0.25, -1.5])]
    vectors = topk_search.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    whole = {r.vec_id: [int(x) for x in r.v] for r in vectors.collect()}
    scale = lambda x: math.floor(64 * x) if abs(64 * x) < 2**53 else int(max(-topk_search.LARGEST, min(topk_search.LARGEST, 64 * x)))
    assert whole == {i: [scale(x) for x in v] for i, v in rows}
    clamp = lambda x: max(-(2**63), min(2**63 - 1, x))
    got = Counter((r.query_id, r.vec_id, r.score) for r in topk_search.top_k(vectors, vectors).collect())
    assert got == Counter((q, c, clamp(sum(a * b for a, b in zip(v, w, strict=True)))) for q, v in whole.items() for c, w in whole.items() if c != q)


def test_lanes_are_dealt_round_robin(spark):
    for lanes in (1, 5, 24):
        labels = topk_search.lane_labels(spark, lanes)
        dealt = spark.createDataFrame([(x,) for x in labels], "lane long").repartition(lanes, "lane")
        assert dealt.select(F.spark_partition_id()).distinct().count() == lanes


def test_bounds_are_carried_and_lose_nothing():
    rng = np.random.default_rng(5)
    c = np.floor(64 * rng.normal(size=(32, 600)))
    q, qids, cids = c[:, :12].copy(), np.arange(12), np.arange(600)
    whole = topk_search.search_block(qids, q, cids, c, 20, 8)
    leaders = topk_search.Leaders(qids, 20)
    for at in range(0, 600, 100):
        part = topk_search.search_block(qids, q, cids[at : at + 100], c[:, at : at + 100], 20, 8, leaders.floors())
        leaders.add(part)
    assert leaders.rows() == whole
    assert len(part) < 12 * 20  # the last block brings fewer than k a query


@pytest.mark.parametrize("compact, sparse", [(0.0, 0.0), (1.1, 0.0), (1.1, 1.1), (0.75, 0.2)])
@pytest.mark.parametrize("spread", [1.0, 30.0])
def test_every_way_of_pruning_gives_the_best(monkeypatch, compact, sparse, spread):
    monkeypatch.setattr(topk_search, "COMPACT", compact)
    monkeypatch.setattr(topk_search, "SPARSE", sparse)
    rng = np.random.default_rng(6)
    c = np.floor(rng.normal(size=(24, 500)) * np.exp(rng.normal(size=500)) * spread)
    c[:, 100:160] = c[:, :1]  # many equal scores
    cids = rng.permutation(500)
    some = np.flatnonzero(cids % 20 == 0)
    want = [r for i in some for r in [(int(cids[i]), int(d), int(x)) for x, d in sorted(((c[:, i] @ c[:, o], cids[o]) for o in range(500) if o != i), key=lambda p: (-p[0], p[1]))[:20]]]
    assert topk_search.search_block(cids[some], c[:, some], cids, c, 20, 5) == want


def test_top_k_of_fewer_and_none(spark):
    few = topk_search.integer_vectors(spark.createDataFrame([(0, [1.0]), (5, [2.0])], "vec_id long, embedding array<double>"))
    assert [(r.query_id, r.vec_id) for r in topk_search.top_k(few, few).collect()] in ([(0, 5), (5, 0)], [(5, 0), (0, 5)])
    none = few.filter("false")
    assert topk_search.top_k(none, few).collect() == [] and topk_search.top_k(few, none).collect() == []


# --- WARC

PAGES = "page_id long, url string, html string, digest string, n int, first long"


def messy_pages():
    big = "<p>" + "same payload " * 20 + "</p>"
    rows = [(i, f"http://h{i}.example.com/x y\r\nX-Evil: 1", f"<html><p>page {i % 7} é</p></html>" * (i % 5)) for i in range(60)]
    rows += [(100 + i, "http://a/", big) for i in range(30)]
    rows += [(None, "http://b/", big), (100, "http://c/", big), (200, None, None), (201, "", ""), (202, "u", "x" * 99), (203, "u", "x" * 99)]
    rows += [(204, "u", "é" * 50), (205, "u", "é" * 50), (206, "u", "z" * 300_000), (None, "u", "only null ids " * 30), (None, "u", "only null ids " * 30)]
    return rows


def test_archives_round_trip(spark):
    pages = spark.createDataFrame([(*r, "d", 1, 7) for r in messy_pages()], PAGES)
    folder = scratch_path(spark, "warc-test")
    listed = warc.write_archives(warc.plan_records(pages).repartition(3), folder, roll_bytes=20_000)
    assert listed.count() > 3 and listed.agg(F.sum("records")).first()[0] == len(messy_pages())
    first = defaultdict(list)
    for p, _, html in messy_pages():
        if p is not None and len((html or "").encode()) >= 100:
            first[html].append(p)
    want = Counter()
    for p, _, html in messy_pages():
        data = (html or "").encode()
        keep = min(first[html]) if first.get(html) and sum(h == html for _, _, h in messy_pages()) > 1 else None
        revisit = keep is not None and p != keep
        want[p, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", keep if revisit else None, None if revisit else data] += 1
    typed = warc.read_archives(listed, folder).withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in typed.collect())
    assert got == want


def test_short_payloads_are_not_looked_up(spark):
    """A third of the pages with one short payload stay where they are read."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        html = F.when(F.col("id") % 3 == 0, None).otherwise(F.concat(F.lit("x" * 120), F.col("id") % 400))
        pages = spark.range(1200, numPartitions=8).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), html.alias("html"))
        planned = warc.plan_records(pages)
        sizes = [n for (n,) in planned.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert sum(sizes) == 1200 and max(sizes) < 2.5 * 1200 / len(sizes)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_keys_are_spread_without_aqe(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(6000, numPartitions=8).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 2000).alias("k"), "id")
        table = common.materialize(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top")), "table")
        found = common.skew_lookup(rows, table, ["k"], "n", ["top"])
        sizes = [n for (n,) in found.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert sum(sizes) == 6000 and len(sizes) == 8 and max(sizes) < 1.5 * 6000 / 8
        assert found.filter("k = -1 and top <> 5997").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_archive_layout():
    records = [warc.make_record(str(i), f"http://a/{i}", b"<p>hello dictionary %d</p>" % i * 30, "0" * 64, None, False) for i in range(400)]
    out = io.BytesIO()
    warc.write_archive(out, records)
    data = out.getvalue()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    rest, frames = data[8 + size :], []
    while rest:  # every record is a frame of its own
        one = unpack.decompressobj()
        frames.append(one.decompress(rest))
        rest = one.unused_data
    assert frames == records
    assert sum(map(len, records)) > 4 * len(data)
    out.seek(0)
    fields = [f for f, _ in warc.read_archive(out)]
    assert [f["warc-target-uri"] for f in fields] == [f"http://a/{i}" for i in range(400)]


def test_damaged_payload_is_an_error(spark):
    pages = spark.createDataFrame([(1, "u", "payload " * 20)], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test")
    bad = warc.plan_records(pages).withColumn("digest", F.lit("0" * 64))
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archives(warc.write_archives(bad, folder), folder).collect()


def test_no_pages(spark):
    assert warc.archive_pages(spark.createDataFrame([], PAGES)).collect() == []


# --- URL rules

URLS = [
    "http://www.example.com/en/1", "http://example.com/en/", "https://EXAMPLE.com/en", "http://badexample.com/en/x", "http://a.net/es/x?y#z",
    "http://net/fr/", "ftp://x.org/fr/", "no scheme", None, "", "http://", "http:///en/", "http://example.com?x=/en/", "http://a.example.com/EN/",
    "http://x.com\n/en/", "http://u:p@m.example.com:80/en/q", "x://y://example.com/en/", "http://a.b*c.net/es/", "http://example.com/en/fr/#http://net/fr/",
]


def brute_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1]) or not r[1]) and path.startswith(r[2])]
    best = max(fits, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[1] + r[2], r[0]), default=None)
    return host, path, best and best[1] + best[2], best[0] if best else "allow"


ODD_RULES = [("block", "", "/en/"), ("block", "b*c.net", ""), ("allow", "a.b*c.net", "/e"), ("block", "c.net", "/es/"), ("allow", "c.net", "/es/"), ("block", r"\E.net", "/")]


@pytest.mark.parametrize("bound", [0, 100])
@pytest.mark.parametrize("rules", [RULES, ODD_RULES, []])
def test_url_rules(spark, rules, bound, monkeypatch):
    monkeypatch.setattr(url_rules, "BROADCAST_RULES", bound)
    pages = spark.createDataFrame([(i, u, "h", "p", "t") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string, path string, token string")
    table = spark.createDataFrame(rules, "action string, host string, path string")
    got = {r.page_id: tuple(r)[1:] for r in url_rules.judge_urls(pages, table).collect()}
    assert got == {i: brute_verdict(u, rules) for i, u in enumerate(URLS * 2)}


def test_repeated_and_missing_pages(spark):
    pages = spark.createDataFrame([(None, "http://net/es/"), (1, "http://net/es/"), (1, "http://net/es/")], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "action string, host string, path string")
    got = [tuple(r) for r in url_rules.judge_urls(pages, rules).collect()]
    assert Counter(g[0] for g in got) == {None: 1, 1: 2} and {g[1:] for g in got} == {("net", "/es/", "net/es/", "block")}
    assert url_rules.judge_urls(pages.filter("false"), rules).collect() == []


# --- chat

TURNS = "conv_id long, turn long, role string, text string, block int, mask int"


def brute_dialogues(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn is not None, turn or 0, role is not None, role or "", text or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        for me in {t[3] for t in turns if t[2] and t[3] != "system"}:
            whole, learned = "", ""
            for *_, named, role, text in turns:
                name = "assistant" if named and role == me else "system" if named and role == "system" else f"user name={role if named else 'unknown'}"
                whole += f"<|im_start|>{name}\n{text}<|im_end|>\n"
                learned += f"{text}<|im_end|>" if name == "assistant" else ""
            out[c, me] = whole, learned
    return out


@pytest.mark.parametrize("block", [3, 256])
def test_rotation(spark, block):
    rows = [(1, i, ["user", "assistant", "bob", "system"][i % 4], f"turn {i}") for i in range(11)]
    rows += [(2, 0, None, "nobody"), (2, 1, "ann", None), (2, 1, "ann", None), (2, 1, "abe", "tie"), (2, None, "ann", "no number"), (3, 0, "system", "alone")]
    rows += [(None, 5, "user", "no conversation id"), (4, 0, "user", "x" * 50_000), (5, -3, "user", "early"), (5, 5000, "user", "late 🙂")]
    rows += [(6, -3, "ann", "negative"), (6, None, "bob", "null comes first"), (6, -2000, "bob", "far below"), (6, None, None, "null, too"), (6, 0, "ann", "zero")]
    rows += [(7, None, f"p{i % 3}", f"no number {i % 11}") for i in range(60)]  # one number, many turns
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], TURNS).repartition(4)
    parts = defaultdict(list)
    for r in chat.rotate_perspectives(df, block).collect():
        parts[r.conv_id, r.perspective].append(r)
    want = brute_dialogues(rows)
    assert parts.keys() == want.keys()
    for key, blocks in parts.items():
        blocks.sort(key=lambda r: r.block)
        whole = "".join(r.text for r in blocks)
        assert all(r.n_turns <= block and whole[r.offset : r.offset + len(r.text)] == r.text for r in blocks)
        assert (whole, "".join(whole[a:b] for r in blocks for a, b in r["mask"])) == want[key]


def test_sql_orders_turns_alike(spark, tmp_path):
    rows = [(1, t, r, f"{t} {r}") for t in (None, -3, -2000, 0, 5) for r in (None, "ann", "bob")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    cur = con.execute(ORACLE["op7_perspective_rotation"])
    names = [d[0] for d in cur.description]
    df = QUERIES["op7_perspective_rotation"](spark, str(tmp_path))
    assert Counter(map(tuple, df.select(*names).collect())) == Counter(cur.fetchall())


def test_a_hot_conversation_is_in_no_single_task(spark):
    """Two thirds of all turns in one conversation, half of them without a number."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        turns = spark.range(9000, numPartitions=8).select(
            F.when(F.col("id") % 3 > 0, -1).otherwise(F.col("id")).alias("conv_id"), F.when(F.col("id") % 2 > 0, F.col("id")).alias("turn"),
            F.concat(F.lit("p"), F.col("id") % 2).alias("role"), F.lit("same words").alias("text"),
        )
        placed = common.place_in_order(turns, ["conv_id"], [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")], "t")
        sizes = [n for (n,) in placed.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert max(sizes) < 3 * 9000 / len(sizes) and placed.filter("conv_id = -1").select("__t_pos").distinct().count() == 6000
        out = chat.rotate_perspectives(turns, 64)
        text = out._jdf.queryExecution().executedPlan().toString()
        assert text.count("<|im_start|>") <= 2 * text.count("<|im_start|>assistant") + 2  # rendered once
        blocks = [n for (n,) in out.filter("conv_id = -1").groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert sum(blocks) == 2 * -(-6000 // 64) and len(blocks) == 8 and max(blocks) < 2 * sum(blocks) / 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_turns(spark):
    assert chat.rotate_perspectives(spark.createDataFrame([], TURNS)).collect() == []


# --- the registered queries


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(ORACLE[key])
    names = [d[0] for d in cur.description]
    df = QUERIES[key](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert Counter(tuple(r) for r in df.select(*names).collect()) == Counter(cur.fetchall())


def test_query_schemas(spark):
    want = {
        "op1_best_fit_packing": "doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint,sequence_id:bigint,offset:bigint",
        "op5_hypergeometric_shards": "doc_id:bigint,size:bigint,text_crc32:bigint,law:string,shard:int,slot:bigint,grown_shard:int",
        "op9_simhash_anchors": "doc_id:bigint,fingerprint:string,component_id:bigint",
    }
    for key, fields in want.items():
        df = QUERIES[key](spark, SF)
        assert ",".join(f"{n}:{t}" for n, t in df.dtypes) == fields
        assert df.count() >= 200
