"""Concatenate-and-cut packing, Merkle manifests and fill-in-the-middle
against brute force, with messy input."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import common, concat_packing, fim, merkle
from tessera.llm.queries import QUERIES, WORD_TOKENIZER_FILE, tokenizer_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use or return themselves.
CLASHING = ["part", "before", "ids", "start", "offset", "n", "form", "output", "leaf", "path", "root", "g", "item", "pos", "total", "a.b"]
PATH = tokenizer_path(WORD_TOKENIZER_FILE)
TOK = Tokenizer.from_file(PATH)


def messy():
    words = "alpha Beta gamma, delta. été ÜBER niño x it's 42 a-b ΣΑΣ İx ﬁ é <|endoftext|> 中文".split(" ")
    text = lambda i, n: " ".join(words[(7 * i + j * j) % len(words)] for j in range(n))
    rows = [(i, text(i, i % 50 + 1), ("en", "de", None, "fr")[i * i % 4], f"s{i % 3}") for i in range(150)]
    rows += [(7, "repeated row", "en", "s0")] * 40 + [(7, "other text, same id", "en", None)]
    rows += [(1000, None, "en", "s"), (1001, "", None, None), (1002, " \t\n ", "de", "s"), (None, "no id", "en", "s"), (None, "no id", "en", "s")]
    rows += [(2000, text(3, 20_000), "en", "s"), (2001, "y" * 70_000, "de", "s"), (2002, "<P>mark", "en", "s"), (2003, "a <S", "en", "s")]
    rows += [(3000, "lone", "zz", "s"), (3001, "emoji 🙂🙂 end ", "ä", "s"), (3002, "\x1c\x85 odd\xa0space here　", "", "s")]
    return [(*r, len(r[1] or "")) for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(messy(), DOCS).withColumns({c: F.lit("x") for c in CLASHING}).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame(messy(), DOCS).filter("false")


# --- concatenate and cut


def want_ids(text):
    return [*TOK.encode(text or "", add_special_tokens=False).ids, 1]


def test_word_ids_are_the_tokenizers(spark):
    fast = concat_packing.WordTokenizer(PATH, memory=500)  # generations change all the time
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + [r[1] or "" for r in messy()]
    for at in range(0, len(texts), 20):
        for got, text in zip(fast.encode(texts[at : at + 20]), texts[at : at + 20], strict=True):
            assert np.frombuffer(got, "<u4").tolist() == want_ids(text)[:-1]


ODD = "ab zéÉßΣİ.,;:!?'\n\t \x1c\x85\xa0 ́ 1²Ⅷ中🙂ﬁÅ"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(ODD) | st.characters(codec="utf-8"), max_size=30), max_size=5))
def test_word_ids_on_any_text(texts):
    tok = concat_packing.tokenizer(PATH)
    texts = [*texts, "A, b <|endoftext|> c.", "it's 'tis we'll. Ç"]
    for t, got in zip(texts, tok.encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == want_ids(t)[:-1]


def check_pieces(rows, docs, capacity):
    """Every id in one piece, sequences gapless and full but for the last."""
    made, used = defaultdict(list), defaultdict(list)
    for r in rows:
        made[r.doc_id, r.doc_tokens].append((r.start, bytes(r.ids)))
        used[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length > 0 and r.boundary == (r.start > 0)
    want = Counter()
    for doc_id, text in docs:
        ids = np.asarray(want_ids(text), "<u4").tobytes()
        want[doc_id, len(ids) // 4, ids] += 1
    got = Counter()
    for (doc_id, n), pieces in made.items():
        for start in sorted({s for s, _ in pieces}):  # repeated rows are cut at places of their own
            assert start < n
        copies = sum(s == 0 for s, _ in pieces)
        if copies == 1:
            at = 0
            for start, ids in sorted(pieces):
                assert start == at
                at += len(ids) // 4
            got[doc_id, n, b"".join(ids for _, ids in sorted(pieces))] += 1
        else:  # rows with the same id and length: together they hold all their ids
            same = [k for k in want if k[:2] == (doc_id, n)]
            assert copies == sum(want[k] for k in same)
            assert sum(len(ids) for _, ids in pieces) == 4 * n * copies
            for k in same:
                got[k] = want[k]
            assert all(any(ids == k[2][4 * s : 4 * s + len(ids)] for k in same) for s, ids in pieces)
    assert got == want
    ends = []
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        ends.append(at)
    assert sorted(ends)[1:] == [capacity] * (len(ends) - 1) and sorted(used) == list(range(len(used)))


@pytest.mark.parametrize("capacity", [2048, 7, 1])
def test_concat_and_cut(docs, capacity):
    few = docs.filter("doc_id < 100 or doc_id is null or doc_id >= 3000") if capacity == 1 else docs
    rows = concat_packing.concat_and_cut(few, PATH, capacity).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in few.select("doc_id", "text").collect()], capacity)


def test_sequences_and_their_order(docs):
    pieces = concat_packing.concat_and_cut(docs, PATH).cache()
    made = concat_packing.assemble_sequences(pieces).collect()
    assert all(4 * sum(r.lengths) == len(r.ids) for r in made)
    stream = b"".join(bytes(r.ids) for r in sorted(made))
    assert stream == b"".join(bytes(r.ids) for r in pieces.orderBy("sequence_id", "offset").collect())


def test_concat_query(spark):
    got = QUERIES["op11_concatenate_and_cut"](spark, SF).collect()
    texts = {r.doc_id: np.asarray(want_ids(r.text), "<u4").tobytes() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    seen = Counter()
    for r in got:
        assert r.doc_tokens == len(texts[r.doc_id]) // 4
        assert r.ids_crc32 == zlib.crc32(texts[r.doc_id][4 * r.start : 4 * (r.start + r.length)])
        seen[r.doc_id] += r.length
    assert seen == {k: len(v) // 4 for k, v in texts.items()}
    assert len({r.sequence_id for r in got}) == -(-sum(len(v) // 4 for v in texts.values()) // 2048)


def test_nothing_to_concatenate(none):
    assert concat_packing.concat_and_cut(none, PATH).collect() == []


def test_no_ids_are_shuffled(docs, spark):
    plan = concat_packing.concat_and_cut(docs, PATH)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
    assert all("ids" not in line for line in exchanges)


# --- Merkle manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute_tree(level, fan):
    """Levels from the leaves to the root."""
    levels = [level]
    while len(level) > 1:
        level = [H(*level[i : i + fan]) for i in range(0, len(level), fan)]
        levels.append(level)
    return levels


def brute(rows, fan=8):
    """Multiset of the query's rows."""
    lower = str.maketrans(merkle.UPPER, merkle.UPPER.lower())
    groups = defaultdict(list)
    for doc_id, text, lang, source, n in rows:
        leaf = lambda t: H(*map(field, (doc_id, source, lang, n, t)))  # noqa: E731, B023
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        groups[lang].append((doc_id is not None, doc_id or 0, leaf(text), leaf(text.translate(lower) if text is not None and hit else text)))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: brute_tree([x[2] for x in sorted(groups[g])], fan) for g in langs}
    top = brute_tree([trees[g][-1][0] for g in langs], fan)
    out = Counter()
    for at, g in enumerate(langs):
        for i, (known, doc_id, leaf, changed) in enumerate(sorted(groups[g])):
            h, siblings = changed, []
            for levels, pos in ((trees[g], i), (top, at)):
                for level in levels[:-1]:
                    run = pos // fan * fan
                    left, right = level[run:pos], level[pos + 1 : run + fan]
                    h, siblings = H(*left, h, *right), siblings + left + right
                    pos //= fan
            root = top[-1][0]
            out[doc_id if known else None, leaf, trees[g][-1][0], root, H(*siblings), h, h == root] += 1
    return out


def manifest(docs, **kw):
    leaves = docs.select("doc_id", "lang", merkle.leaf_hash(*merkle.FIELDS).alias("leaf"), F.lit("kept").alias("more"))
    return merkle.prove(leaves, **kw)


def test_manifest_query(spark, docs, tmp_path):
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_merkle_manifest"](spark, str(tmp_path))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, got.select(*names).collect())) == brute(messy())


@pytest.mark.parametrize("fan, height", [(2, 2), (8, 1), (8, 4)])
def test_proofs_of_any_shape(docs, fan, height):
    got = manifest(docs, fan=fan, height=height).select("doc_id", "leaf", "subroot", "root", merkle.path_hash().alias("p"), merkle.fold("leaf").alias("f"), "more")
    rows = got.collect()
    want = Counter()
    for k, n in brute(messy(), fan).items():
        want[k[:5]] += n
    assert Counter(tuple(r)[:5] for r in rows) == want
    assert all(r.f == r.root and r.more == "kept" for r in rows)


def test_any_change_is_found(docs):
    rows = manifest(docs).withColumn("other", merkle.fold(F.sha2(F.col("leaf"), 256))).collect()
    assert len(rows) == len(messy()) and all(r.other != r.root for r in rows)


def test_order_is_global(spark):
    """Many partitions, one group with most rows, one key with a third of them."""
    rows = spark.range(3000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("lang"), F.sha2(F.col("id").cast("string"), 256).alias("leaf")
    )
    placed = common.place_in_order(rows, ["lang"], [F.col("doc_id"), F.col("leaf")], "x").collect()
    for g in "ab":
        own = sorted((r["__t_pos"], r["doc_id"], r["leaf"]) for r in placed if r["lang"] == g)
        assert [x[0] for x in own] == list(range(len(own))) and [x[1:] for x in own] == sorted(x[1:] for x in own)
        assert {r["__t_total"] for r in placed if r["lang"] == g} == {len(own)}


def test_nothing_to_prove(none):
    assert manifest(none).collect() == []


# --- fill in the middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute_fim(doc_id, text, units=UNIT.findall, rate=50, spm=80, seed=42):
    text = text or ""
    tokens = units(text)
    assert "".join(tokens) == text
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(tokens)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < spm:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("units, rate, spm", [("words", 50, 80), ("words", 100, 0), ("words", 100, 100), ("chars", 100, 50)])
def test_fill_in_middle(docs, units, rate, spm):
    got = fim.fill_in_middle(docs, units, rate, spm).withColumn("back", fim.restored())
    rows = got.collect()
    cut = UNIT.findall if units == "words" else list
    assert Counter(tuple(r)[:6] for r in rows) == Counter(brute_fim(r[0], r[1], cut, rate, spm) for r in messy())
    assert Counter((r.doc_id, r.back) for r in rows) == Counter((r[0], r[1] or "") for r in messy())
    if rate == 100:
        assert {r.form for r in rows} >= ({"plain", "psm"} if spm == 0 else {"plain", "spm"})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab <PSM>\t\n\x0b\x1c\x85\xa0é🙂") | st.characters(codec="utf-8"), max_size=60), st.integers(0, 10**6))
def test_cuts_of_any_text(text, doc_id):
    assert (doc_id, *fim.transform(doc_id, text, rate=100)) == brute_fim(doc_id, text, rate=100)


@pytest.mark.parametrize("kind", ["array", "bitmap", "run", "mixed"])
def test_boundary_containers(kind):
    rng = np.random.default_rng(1)
    made = {
        "array": np.unique(rng.integers(0, 1 << 18, 500)),
        "bitmap": np.unique(rng.integers(0, 1 << 17, 60_000)),
        "run": np.concatenate([np.arange(10, 60_000), np.arange(70_000, 150_000), [200_000]]),
    }
    made["mixed"] = np.unique(np.concatenate([made["array"], made["bitmap"] + (1 << 18), made["run"] + (1 << 20)]))
    offsets = made[kind]
    edges = fim.Boundaries(offsets)
    assert len(edges) == len(offsets)
    assert [edges.select(k) for k in range(0, len(offsets), 7)] == offsets[::7].tolist()
    kinds = {type(c) for c in edges.containers}
    want = {"array": {fim.ArrayContainer}, "bitmap": {fim.BitmapContainer}, "run": {fim.RunContainer, fim.ArrayContainer}, "mixed": set(fim.CONTAINERS)}
    assert kinds <= want[kind] and (kind != "mixed" or kinds == want[kind])


def test_fim_query(spark, docs, tmp_path):
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    rows = QUERIES["op13_boundary_set_fim"](spark, str(tmp_path)).collect()
    assert Counter(map(tuple, rows)) == Counter((*(b := brute_fim(r[0], r[1]))[:5], digest(b[5]), digest(r[1] or "")) for r in messy())


def test_nothing_to_fill(none):
    assert fim.fill_in_middle(none).collect() == []
    with pytest.raises(ValueError):
        fim.fill_in_middle(none, "pages")
