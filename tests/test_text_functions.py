"""Java text semantics (H1-H4, H15, H18) and the tokenizer."""

from pyspark.sql import functions as F

from tessera.functions.text import clean_text, java_split, java_trim, normalise_stopwords, tokens


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr.alias("x")).first()["x"]


def test_java_split_drops_trailing_empty_fields(spark):
    # H1: "a;b;c;;".split(";") has 3 fields in Java, 5 with Spark's split.
    assert one(spark, F.size(java_split("v", ";")), "a;b;c;;") == 3
    assert one(spark, F.size(java_split("v", ";")), "a;b;c;d;e") == 5
    assert one(spark, F.size(java_split("v", ";")), ";;;;") == 0
    assert one(spark, F.size(java_split("v", ";")), "") == 1
    assert one(spark, java_split("v", ";"), "a;;b") == ["a", "", "b"]


def test_java_split_with_limit_keeps_rest_and_trailing(spark):
    # split(",", 3) keeps further commas in the last field.
    assert one(spark, java_split("v", ",", 3), "1,Movie, The (1999),Drama|War") == [
        "1", "Movie", " The (1999),Drama|War"]
    assert one(spark, java_split("v", ",", 3), "1,a,") == ["1", "a", ""]


def test_java_trim_strips_control_characters(spark):
    # H2: Spark's trim() only strips spaces.
    assert one(spark, java_trim("v"), "\t\x01 ab c\x1f\n") == "ab c"
    assert one(spark, F.length(F.trim("v")), "\tabc\t") == 5


def test_tokens_ascii_punctuation_only(spark):
    # Curly quotes and ellipsis stay inside tokens; `_` splits;
    # digits are words.
    got = one(spark, tokens("v"), "The “quote”… a_b 42, 42! DON'T")
    assert got == ["the", "“quote”…", "a", "b", "42", "42", "don", "t"]


def test_tokens_trim_control_chars_at_token_edges(spark):
    got = one(spark, tokens("v"), "ab\x01 \x02cd\x03 e\x01f")
    assert got == ["ab", "cd", "e\x01f"]


def test_token_length_counts_code_points(spark):
    # H3: an emoji is one character for us (two UTF-16 units in Java).
    assert one(spark, F.length("v"), "\U0001F600") == 1


def test_stopwords_normalised_and_phrases_never_match(spark):
    stop = normalise_stopwords(["  The ", "", "OF", "bởi vì", "of"])
    assert stop == ["bởi vì", "of", "the"]
    # The phrase "bởi vì" is a stop entry, but its words stay.
    assert one(spark, clean_text("v", stop), "The cat, bởi vì OF course") == "cat bởi vì course"


def test_clean_text_keeps_order_and_repeats(spark):
    assert one(spark, clean_text("v", ["a"]), "B a b. A c b") == "b b c b"
    assert one(spark, clean_text("v", ["a"]), "a A, a!") == ""


def _java_tokens(text):
    """Reference model: lower, split on ASCII whitespace/punctuation runs,
    trim chars <= U+0020 from each piece, drop empty pieces."""
    import re
    import string

    seps = re.escape(" \t\n\x0b\f\r" + string.punctuation)
    pieces = re.split(f"[{seps}]+", text.lower())
    out = []
    for p in pieces:
        p = p.strip("".join(chr(i) for i in range(0x21)))
        if p:
            out.append(p)
    return out


def test_tokens_match_java_model_on_random_texts(spark):
    import random

    random.seed(11)
    alphabet = ["a", "B", "é", "1", " ", "\t", "\n", "\x0b", "\x01", "\x08", "\x0e", "\x1f", ".", "_", ",", "“"]
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 12))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, v string")
    got = {r["id"]: list(r["t"]) for r in df.select("id", tokens("v").alias("t")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == _java_tokens(t), repr(t)
