"""Packing, sharding, mixing, language ID, SimHash and exact dedup against
brute force, with messy input."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import components, exact_dedup, langid, mixing, packing, sharding, simhash
from tessera.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use or return themselves.
CLASHING = ["name", "pos", "info", "n", "rate", "copy", "fp", "kept", "shard", "slot", "length", "a.b", "node", "block"]


def make_docs(spark, rows):
    """(doc_id, text[, lang, source]) rows as documents with clashing columns."""
    rows = [(*r, *(("en", "s0")[len(r) - 2 :]), len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({f"{c}": F.lit("x") for c in CLASHING})


def messy(copies=40):
    rng = random.Random(4)
    words = ["alpha", "Beta", "gamma", "delta,", "été", "über", "niño", "x"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, text(rng.randint(1, 60))) for i in range(120)]
    rows += [(1000 + i, "the same text for many rows") for i in range(copies)]
    rows += [(2000 + i, "the  same\ttext for\nmany rows") for i in range(3)]
    rows += [(3000, None), (3001, ""), (3002, " \t\n"), (3003, "!!! 123 ² Ⅷ"), (None, "no id here"), (None, "no id here"), (5, rows[5][1])]
    rows += [(4000, text(30_000)), (4001, "y" * 50_000), (4002, "a<|endoftext|>b c")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return make_docs(spark, messy()).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return make_docs(spark, messy()).filter("false")


# --- packing

TOK = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_chunked_ids_are_the_tokenizers(spark):
    fast = packing.ChunkTokenizer(tokenizer_path())
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for got, want in zip(fast.encode(texts), TOK.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == want.ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab zé.,;'\n\t \x1c\x85 1²Ⅷ中🙂")) | st.characters(codec="utf-8"), max_size=30), max_size=5))
def test_chunked_ids_on_any_text(texts):
    if not hasattr(test_chunked_ids_on_any_text, "tok"):
        test_chunked_ids_on_any_text.tok = packing.ChunkTokenizer(tokenizer_path())
    texts = [*texts, "a, b <|endoftext|> c.", "it's 'tis"]
    for t, got in zip(texts, test_chunked_ids_on_any_text.tok.encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == TOK.encode(t, add_special_tokens=False).ids


def check_runs(counts, capacity):
    used, ranks, large = Counter(), defaultdict(list), Counter()
    for length, a, b, first, each, offset in packing.plan_sequences(counts, capacity):
        ranks[length] += list(range(a, b))
        for r in range(a, b):
            seq, at = first + (r - a) // each, offset + (r - a) % each * length
            assert at == used[seq]  # gapless, in the order of the runs
            used[seq] += length
            large[seq] += 3 * length > capacity
            assert used[seq] <= capacity and large[seq] <= 2
    assert all(sorted(ranks[n]) == list(range(c)) for n, c in counts.items())
    return len(used)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(0, 30), max_size=25))
def test_plan_places_every_piece(counts):
    made = check_runs(counts, 60)
    # No two sequences would fit into one, so at most one is half empty.
    assert made <= 2 * sum(n * c for n, c in counts.items()) / 60 + 1


def test_plan_pairs_large_pieces():
    assert check_runs({60: 3, 40: 5, 20: 5, 31: 4, 29: 4}, 60) == 3 + 5 + 4


def test_packing(spark, docs):
    packed = packing.pack_documents(docs, tokenizer_path())
    rows = packed.collect()
    want = Counter()
    for doc_id, text in messy():
        ids = [*TOK.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 if len(ids) > 1024 else len(ids)
        cuts = [0, *range(first, len(ids) + 1, 1024)] if first else list(range(0, len(ids) + 1, 1024))
        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[doc_id, i, a, tuple(ids[a:b])] += 1
    numbers = lambda ids: np.frombuffer(ids, "<u4").tolist()
    assert Counter((r.doc_id, r.piece, r.start, tuple(numbers(r.ids))) for r in rows) == want
    used = defaultdict(list)
    for r in rows:
        assert 4 * r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(r.ids)
        used[r.sequence_id].append((r.offset, r.length, r.ids))
    for parts in used.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(used) <= -(-sum(r.length for r in rows) // 1024) + 1
    made = {r.sequence_id: numbers(r.ids) for r in packing.assemble_sequences(packed).collect()}
    assert all(made[k] == [i for _, _, ids in sorted(parts) for i in numbers(ids)] for k, parts in used.items())
    assert {len(v) for v in made.values()} <= set(range(1, 1025)) and len(made) == len(used)


def test_packing_nothing(none):
    assert packing.pack_documents(none, tokenizer_path(), with_ids=False).collect() == []


# --- sharding


def test_hypergeometric_has_its_distribution(spark):
    n = 20_000
    draw = sharding.hypergeometric(sharding.unit(3, F.col("id")), F.lit(1000), F.lit(60), F.lit(300))
    got = np.array([r[0] for r in spark.range(n).select(draw).collect()])
    assert abs(got.mean() - 18) < 0.1 and abs(got.var() - 300 * 0.06 * 0.94 * 700 / 999) < 0.5
    edge = [(0, 0, 0), (5, 5, 3), (5, 0, 3), (7, 3, 7), (1, 1, 0)]
    df = spark.createDataFrame(edge, "t long, g long, n long").select("*", sharding.hypergeometric(F.lit(0.999), F.col("t"), F.col("g"), F.col("n")).alias("x"))
    assert {tuple(r) for r in df.collect()} == {(0, 0, 0, 0), (5, 5, 3, 3), (5, 0, 3, 0), (7, 3, 7, 3), (1, 1, 0, 0)}


def test_sharding(spark, docs):
    out = sharding.shard_rows(docs, shards=7).collect()
    assert Counter(r.text for r in out) == Counter(t for _, t in messy())
    sizes = Counter(r.shard for r in out)
    assert sum(sizes.values()) == len(messy()) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in out if r.shard == s) == list(range(n))


def test_matrix_has_its_sums(spark):
    sizes = [(p, n) for p, n in enumerate([0, 700, 3, 1200, 55, 1, 0, 410]) if n]
    total = sum(n for _, n in sizes)
    quotas = [total // 5 + (j < total % 5) for j in range(5)]
    rows = sharding.communication_matrix(spark.createDataFrame(sizes, "part int, n long"), quotas, 8, seed=9).collect()
    assert {r.part: sum(r.counts) for r in rows} == dict.fromkeys(range(8), 0) | dict(sizes)
    assert [sum(r.counts[j] for r in rows) for j in range(5)] == quotas


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_permutations_are_one_to_one(spark, n):
    place = sharding.permuted(F.col("id"), F.lit(n).cast("long"), 4, F.col("s"))
    rows = spark.range(n).crossJoin(spark.range(3).withColumnRenamed("id", "s")).select("s", "id", place.alias("to")).collect()
    made = {s: [r.to for r in sorted(rows) if r.s == s] for s in range(3)}
    assert all(sorted(x) == list(range(n)) for x in made.values())
    if n == 1000:
        assert made[0] != made[1] != made[2]
        assert abs(np.corrcoef(made[0], range(n))[0, 1]) < 0.1
        assert sum(abs(a - b) == 1 for a, b in zip(made[0], made[0][1:], strict=False)) < 15  # neighbours part


def test_rows_move_to_their_shards(spark, docs, tmp_path):
    out = sharding.shard_rows(docs, shards=3)
    found = out.select(F.spark_partition_id().alias("p"), "shard", "slot").collect()
    where = defaultdict(list)
    for r in found:
        where[r.p].append((r.shard, r.slot))
    for rows in where.values():
        assert len({s for s, _ in rows}) == 1 and rows == [(rows[0][0], i) for i in range(rows[0][1], rows[0][1] + len(rows))]
    assert len(where) == 9  # 8 tasks: three for each shard
    sharding.write_shards(out.drop("a.b"), str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert Counter((r.doc_id, r.text, r.shard, r.slot) for r in back.collect()) == Counter((r.doc_id, r.text, r.shard, r.slot) for r in out.collect())


def test_sharding_is_uniform(spark):
    rows = spark.range(8000).withColumnRenamed("id", "doc_id")
    out = sharding.shard_rows(rows, shards=4, parts=9).collect()
    x = np.array(sorted((r.doc_id, r.shard, r.slot) for r in out))
    for low in range(0, 8000, 1000):  # neighbours spread over shards and places
        part = x[low : low + 1000]
        assert (abs(np.bincount(part[:, 1], minlength=4) - 250) < 75).all()
        assert abs(part[:, 2].mean() - 999.5) < 120
    assert abs(np.corrcoef(x[:, 0], x[:, 2])[0, 1]) < 0.06


def test_sharding_nothing(none):
    assert sharding.shard_rows(none).collect() == []


# --- mixing


def test_poisson_counts_follow_the_rate(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") < 3000, "a").otherwise(None).alias("source"))
    mixed = mixing.poisson_mix(df, weights={"a": 1.0, None: 20.0}, size=63_000)
    counts = Counter(r.doc_id for r in mixed.collect())
    a = np.array([counts[i] for i in range(3000)])
    b = np.array([counts[i] for i in range(3000, 6000)])
    assert abs(a.mean() - 1) < 0.06 and abs(a.var() - 1) < 0.12
    assert abs(b.mean() - 20) < 0.3 and abs(b.var() - 20) < 2.0  # a mean that is split in parts
    again = Counter(r.doc_id for r in mixing.poisson_mix(df.repartition(3), weights={"a": 1.0, None: 20.0}, size=63_000).collect())
    assert again == counts


def test_mixing_keeps_columns_and_sources(spark, docs):
    kept = mixing.poisson_mix(docs, details=False)
    assert kept.columns == docs.columns
    detailed = mixing.poisson_mix(docs).collect()
    by_row = defaultdict(list)
    for r in detailed:
        by_row[r.doc_id, r.text].append((r["copy"], r.copies))
    for (doc_id, text), got in by_row.items():
        times = Counter(messy())[doc_id, text]
        firsts = [copies for c, copies in got if c == 1]  # repeated rows draw one by one
        assert len(firsts) <= times and Counter(c for c, _ in got) == Counter(c for n in firsts for c in range(1, n + 1))
    assert mixing.poisson_mix(docs, weights={"other": 1.0}).collect() == []


def test_equal_rows_draw_one_by_one(spark):
    """1000 and 2000 equal rows: their sources meet the weights all the same."""
    rows = spark.range(3000, numPartitions=6).select(
        F.when(F.col("id") < 1000, "a").otherwise("b").alias("source"), F.when(F.col("id") < 1000, 1).otherwise(2).cast("long").alias("doc_id"),
        F.lit("same text").alias("text"),
    )
    rows = rows.unionByName(spark.createDataFrame([("c", None, None)] * 200, "source string, doc_id long, text string"))
    mixed = mixing.poisson_mix(rows).collect()
    rate = {r.source: r.rate for r in mixed}
    for source, n in (("a", 1000), ("b", 2000), ("c", 200)):
        got = [r for r in mixed if r.source == source]
        mean = rate[source] * n
        assert abs(len(got) - mean) < 4 * mean**0.5
        assert len({r.copies for r in got}) > 1 and {r["copy"] for r in got} == set(range(1, max(r.copies for r in got) + 1))
    again = mixing.poisson_mix(rows.repartition(3)).collect()
    assert Counter((r.source, r["copy"], r.copies) for r in again) == Counter((r.source, r["copy"], r.copies) for r in mixed)


def test_many_sources_take_the_shuffle_join(spark, docs, monkeypatch):
    want = sorted(map(str, mixing.poisson_mix(docs, details=False).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(str, mixing.poisson_mix(docs, details=False).collect())) == want


def test_mixing_nothing(none):
    assert mixing.poisson_mix(none).collect() == []


def test_digests_come_from_what_was_placed(spark, monkeypatch):
    plain = {(r.doc_id, r.piece): r for r in QUERIES["op1_best_fit_packing"](spark, SF).collect()}
    pack, shard = packing.pack_pieces, sharding.shard_rows
    monkeypatch.setattr(packing, "pack_pieces", lambda *a: pack(*a).withColumn("ids", F.concat("ids", "ids")))
    monkeypatch.setattr(sharding, "shard_rows", lambda rows: shard(rows).withColumn("text", F.concat("text", F.lit("!"))))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op1_best_fit_packing"](spark, SF).collect():
        ids = (TOK.encode(texts[r.doc_id], add_special_tokens=False).ids + [packing.END_ID])[r.start : r.start + r.length]
        assert plain[r.doc_id, r.piece].ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert r.ids_crc32 == zlib.crc32(2 * np.array(ids, dtype="<u4").tobytes())
    for r in QUERIES["op5_hypergeometric_shards"](spark, SF).collect():
        text = (texts[r.doc_id] + "!").encode()
        assert (r.size, r.text_crc32) == (len(text) + 1, zlib.crc32(text))


# --- language ID


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op8_language_id"](spark, "/root/testdata/sf0.01").collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert got.keys() == truth.keys()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    test = [i for i, r in got.items() if r.held_out]
    assert np.mean([got[i].lang_pred == truth[i] for i in test]) > 0.97
    assert np.mean([got[i].rejected for i in test]) < 0.02
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_id_of_messy_texts(spark, docs):
    got = langid.identify(docs).collect()
    assert len(got) == len(messy())
    for r in got:
        text = dict(messy()).get(r.doc_id)
        assert (r.lang_pred == "und" and r.score == 0 and r.rejected) == (r.doc_id is not None and not any(c.isalpha() for c in text or ""))
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == sum(not r.rejected for r in got)


def test_language_id_sample_is_bounded():
    assert langid.sample_bounds(4) == (langid.SAMPLE_PER_LANGUAGE, langid.SAMPLE_CHARS)
    for n in (1, 7, 8, 30, 64, 65, langid.LANGUAGES):
        rows, chars = langid.sample_bounds(n)
        assert n * rows * chars <= langid.SAMPLE_TOTAL and rows >= langid.LEAST_PER_LANGUAGE and chars > 1000


def test_language_id_learns_a_language_of_long_texts(spark, monkeypatch):
    """Rows that are all longer than the bound are learned from a stretch of each."""
    rng = random.Random(2)
    voices = {"aa": ["kalo", "mira", "tuno", "sela"], "bb": ["wexy", "qort", "zjub", "vygh"]}
    rows = [(i, " ".join(rng.choice(voices[lang]) for _ in range(400 if lang == "bb" else 30)), lang) for i in range(160) for lang in [["aa", "bb"][i % 2]]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, chars=500)
    assert model.languages == ["aa", "bb"]
    got = langid.identify(df, model).collect()
    assert all(r.lang_pred == ["aa", "bb"][r.doc_id % 2] for r in got)


def test_language_id_without_labels(spark, docs, none):
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in langid.identify(unlabelled).collect()} == {("und", 0.0)}
    assert langid.identify(none).collect() == []


@pytest.mark.parametrize("sizes", [[40] * 5, [40] * 10, [40, 40, 1, 1, 1], [7, 1, 300], [2, 3, 1]])
def test_language_id_holds_back_rows_of_each_language(sizes):
    target = np.array([g for n in range(max(sizes)) for g, size in enumerate(sizes) if n < size])
    kept = langid.held_back(target)
    for g, size in enumerate(sizes):
        assert kept[target == g].sum() == (size // 5 if max(sizes) >= 5 else size > 1)


def test_language_id_calibrates_on_rows_it_has_not_learned(monkeypatch):
    rng = random.Random(3)
    word = {g: ["".join(rng.choice(abc) for _ in range(5)) for _ in range(50)] for g, abc in enumerate(["abcde", "efghi", "ijklm", "mnopq", "qrstu"])}
    rows = [(" ".join(rng.choice(word[g]) for _ in range(20)), str(g)) for _ in range(50) for g in word]
    learned = []

    class Generator:
        def __init__(self, seed, real=np.random.default_rng):
            self.real = real(seed)

        def uniform(self, *a):
            return self.real.uniform(*a)

        def permutation(self, chosen):
            learned.extend(chosen.tolist())
            return self.real.permutation(chosen)

    monkeypatch.setattr(langid.np.random, "default_rng", Generator)
    langid.train(rows)
    # Ten of the fifty rows of each language are held back.
    assert Counter(rows[i][1] for i in set(learned)) == {str(g): 40 for g in word}


@pytest.mark.parametrize("known", [["en"], ["de", "en"]])
def test_language_id_rejects_unlearned_languages(spark, known):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labelled = docs.withColumn("lang", F.when(F.col("lang").isin(known), F.col("lang")))
    kept = langid.keep_identified(labelled, langid.fit(labelled)).select("doc_id")
    share = {r.lang: r.share for r in docs.join(kept.withColumn("kept", F.lit(1)), "doc_id", "left").groupBy("lang").agg(F.mean(F.coalesce("kept", F.lit(0))).alias("share")).collect()}
    assert all((share[g] > 0.95) if g in known else (share[g] < 0.05) for g in share), share


# --- SimHash


def brute_fingerprint(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, max_bits=2):
    """{fingerprint: component} by comparing all pairs."""
    prints, root = sorted(set(prints)), {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[i:]:
            if (a ^ b).bit_count() <= max_bits and top(a) != top(b):
                root[max(top(a), top(b))] = min(top(a), top(b))
    return {p: top(p) for p in prints}


def test_fingerprints(monkeypatch):
    monkeypatch.setattr(simhash, "_STEP", 50)  # long texts are read in stretches
    for _, text in messy():
        h = simhash.shingle_hashes(text)
        assert int(simhash.majority(np.array(h, dtype="<u8"), [len(h)])[0]) % (1 << 64) == brute_fingerprint(text)


def test_simhash_groups(spark, docs):
    got = simhash.simhash_groups(docs).collect()
    prints = {i: brute_fingerprint(t) for i, t in messy()}
    comp = brute_components(prints.values())
    smallest = defaultdict(lambda: 1 << 60)
    for i, p in prints.items():
        if i is not None:
            smallest[comp[p]] = min(smallest[comp[p]], i)
    assert len(got) == len(messy())
    for r in got:
        p = prints[r.doc_id]
        assert r.fp % (1 << 64) == p and r.component_id == (smallest[comp[p]] if comp[p] in smallest else None)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(comp.values()))


def near_fingerprints(n, seed):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):  # chains of neighbours
            out.add(x)
            for b in rng.sample(range(64), rng.randint(1, 3)):
                x ^= 1 << b
    return sorted(out)


@pytest.mark.parametrize("crowd", [4096, 1])
@pytest.mark.parametrize("max_bits", [1, 2, 3])
def test_links_find_all_neighbours(spark, max_bits, crowd):
    prints = near_fingerprints(400, max_bits)
    base = random.Random(9).getrandbits(64)
    prints += [base ^ (1 << a) ^ (1 << b) for a in range(14) for b in range(a, 14)]  # a dense ball
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in sorted(set(prints))], "fp long")
    links = [(r.u % (1 << 64), r.v % (1 << 64)) for r in simhash.link_fingerprints(df, max_bits, crowd).collect()]
    assert all((u ^ v).bit_count() <= 12 * max_bits for u, v in links)  # forests may join ends of chains
    got = components.connected_components(simhash.link_fingerprints(df, max_bits, crowd))
    label = {r.node % (1 << 64): r.component for r in got.collect()}
    want = brute_components(prints, max_bits)
    groups = lambda m: {frozenset(k for k in m if m[k] == c) for c in set(m.values())}
    assert groups({p: label.get(p, p) for p in set(prints)}) == groups(want)


def test_golay_blocks_have_one_code_word_within_three():
    nearest = simhash._anchor_finder()
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 23, 20_000).astype("u4")
    near = nearest(x)
    assert (np.bitwise_count(near ^ x) <= 3).all() and (nearest(near) == near).all()
    assert len(set(nearest(np.arange(1 << 16, dtype="u4")).tolist())) <= 4096


@pytest.mark.parametrize("shape", ["path", "star", "mixed", "none"])
def test_components(spark, shape):
    rng = random.Random(2)
    edges = {
        "path": [(i, i + 1) for i in range(300)],
        "star": [(0, i) for i in range(1, 300)] + [(500, 501)],
        "mixed": [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(7, 7)],
        "none": [],
    }[shape]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u != v:
            parent[max(top(u), top(v))] = min(top(u), top(v))
    assert got.keys() == parent.keys()
    groups = lambda m: {frozenset(k for k in m if m[k] == c) for c in set(m.values())}
    assert groups(got) == groups({x: top(x) for x in parent})


def test_simhash_nothing(none):
    assert simhash.simhash_groups(none).collect() == []


# --- exact dedup


def brute_exact(rows):
    groups = defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, i))
    out = []
    for norm, members in groups.items():
        keep = min(members)[3]
        for *_, i in members:
            out.append((rows[i][0], rows[keep][0], len(members), hashlib.sha256(norm.encode()).hexdigest()))
    return Counter(out), len(groups)


@pytest.mark.parametrize("block", [7, 4096])
def test_exact_dedup(spark, block, monkeypatch):
    # Parts hold few rows here, so a larger share is hot, as it would be in a large table.
    rows = messy() + [(6000 + i, "shared head. " * 5 + str(i)) for i in range(30)]
    docs = make_docs(spark, [r for r in rows if r[0] not in (4000,) or block > 7])
    rows = [r for r in rows if r[0] not in (4000,) or block > 7]
    got = exact_dedup.exact_dedup(docs, block).collect()
    want, n = brute_exact(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == n and all(r.doc_id == r.keep_id for r in got if r.kept)
    kept = exact_dedup.drop_exact_duplicates(docs, block)
    assert kept.columns == docs.columns and kept.count() == n


def test_names_need_no_hash(spark, monkeypatch):
    """Documents whose every block hash collides still get their own names."""
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    docs = make_docs(spark, [(1, "aaaabbbb"), (2, "aaaacccc"), (3, "bbbbaaaa"), (4, "aaaa bbbb")])
    named = exact_dedup.name_documents(docs, 4).collect()
    by = {r.info.doc_id: (r.levels, r.name) for r in named}
    assert by[1] == by[4] and len({by[1], by[2], by[3]}) == 3


def test_exact_dedup_nothing(none):
    assert exact_dedup.exact_dedup(none).collect() == []


# --- the pipeline


def test_pipeline_against_plain_python(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(10**9).cache()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "poisson_mix", "best_fit_packing"]
    base, columns, seen = docs, docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        seen[name] = docs.collect()
        if name != "best_fit_packing":
            assert docs.columns == columns
    model = langid.fit(base)
    scored = {r.doc_id: p for r, p in zip(base.collect(), model.scorer().predict([r.text for r in base.collect()]), strict=True)}
    one = [r for r in base.collect() if not scored[r.doc_id][2]]
    assert {r.doc_id for r in seen["language_id"]} == {r.doc_id for r in one}
    best = {}
    for r in sorted(one, key=lambda r: (-len(r.text), r.doc_id)):
        best.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text), r)
    assert {r.doc_id for r in seen["exact_dedup"]} == {r.doc_id for r in best.values()}
    prints = {r.doc_id: brute_fingerprint(r.text) for r in best.values()}
    comp = brute_components(prints.values())
    first = {}
    for i in sorted(prints):
        first.setdefault(comp[prints[i]], i)
    assert {r.doc_id for r in seen["simhash_near_dedup"]} == set(first.values())
    assert {r.doc_id for r in seen["poisson_mix"]} <= set(first.values())
    lengths = Counter()
    for r in seen["poisson_mix"]:
        lengths[r.doc_id] += len(TOK.encode(r.text, add_special_tokens=False).ids) + 1
    packed = Counter()
    for r in seen["best_fit_packing"]:
        packed[r.doc_id] += r.length
    assert packed == lengths
