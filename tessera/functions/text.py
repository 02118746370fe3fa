"""Column expressions for text: Java-compatible trim/split and tokens.

All of these are built-in Spark expressions, so they stay inside
whole-stage code generation; none is a Python UDF.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token separators of the reference's tokenizer: Java's ASCII whitespace
# class plus ASCII punctuation (so `_` splits and digits stay words; curly
# quotes and ellipses are not separators). Spark regexes are Java regexes,
# so the pattern means exactly the same here.
TOKEN_SEPARATORS = r"[\s\p{Punct}]+"

# Java String.trim() strips every char <= U+0020, not only spaces.
_JAVA_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c: str | Column) -> Column:
    """Trim like ``String.trim()``: strips control characters too."""
    return F.regexp_replace(_col(c), _JAVA_TRIM, "")


def strip_trailing(c: str | Column, sep: str) -> Column:
    """Remove trailing separators, so ``split`` drops trailing empty fields
    the way Java's ``String.split(regex)`` does (``a;b;;`` has 2 fields)."""
    return F.regexp_replace(_col(c), re.escape(sep) + "+$", "")


def java_split(c: str | Column, sep: str, limit: int = -1) -> Column:
    """``String.split(sep)`` / ``String.split(sep, limit)`` as an array column.

    Without a limit Java drops trailing empty strings; with a positive
    limit it keeps them and the last field holds the rest of the line.
    """
    pattern = re.escape(sep)
    if limit > 0:
        return F.split(_col(c), pattern, limit)
    stripped = strip_trailing(c, sep)
    # A line made only of separators has no field at all in Java; the empty
    # line itself has one (empty) field.
    only_seps = (_col(c) != F.lit("")) & (stripped == F.lit(""))
    return F.when(only_seps, F.array().cast("array<string>")).otherwise(F.split(stripped, pattern))


def split_multi_value(c: str | Column, sep: str = "|") -> Column:
    """Split a ``a|b|c`` field into its values: trailing empty ones are
    dropped, others are values like any other, as ``String.split`` has it."""
    return java_split(c, sep)


# After splitting on TOKEN_SEPARATORS a token can only start or end with a
# char that Java's trim() strips but \s does not match: the control chars
# below. Removing every run of them that touches a separator or an end of
# the text -- once, on the whole text -- leaves exactly the trimmed tokens
# (runs inside a token stay, as trim() keeps them).
_TRIM_ONLY = r"[\x00-\x08\x0E-\x1F]"
_EDGE_RUNS = (
    r"(?<=^|[\s\p{Punct}])" + _TRIM_ONLY + r"+"
    + r"|" + _TRIM_ONLY + r"+(?=[\s\p{Punct}]|$)"
)


def tokens(c: str | Column) -> Column:
    """Lower-case, split on whitespace/punctuation, trim, drop empty.

    Order and repeats are kept; this is the tokenizer every text operator
    shares. Built only from codegen-able functions (no lambda), so it runs
    inside whole-stage code generation.
    """
    low = F.lower(_col(c))
    # Texts without any such control char (nearly all) skip the rewrite.
    text = F.when(low.rlike(_TRIM_ONLY), F.regexp_replace(low, _EDGE_RUNS, "")).otherwise(low)
    return F.array_remove(F.split(text, TOKEN_SEPARATORS), "")


def without_stopwords(tok: Column, stopwords: Iterable[str], min_length: int = 1) -> Column:
    """Filter a token array: drop stop words and tokens shorter than
    ``min_length`` characters.

    The words become literals of the plan, so the check runs inside the task
    with no join and no shuffle. For a list that is a table, see
    :func:`tessera.operators.text.clean_text`.
    """
    stop = normalise_stopwords(stopwords)

    def keep(t: Column) -> Column:
        # isin over literals becomes a hash-set probe (InSet) past a few
        # entries, so a long list costs the same per token as a short one.
        ok = ~t.isin(*stop) if stop else F.lit(True)
        if min_length > 1:
            ok = ok & (F.length(t) >= F.lit(min_length))
        return ok

    return F.filter(tok, keep)


def normalise_stopwords(stopwords: Iterable[str]) -> list[str]:
    """Trim (Java rules) and lower-case each entry, drop blanks, de-duplicate.

    Multi-word entries are kept as they are; they never equal a single
    token, exactly as in the reference.
    """
    out: set[str] = set()
    for w in stopwords:
        w = w.strip("".join(chr(i) for i in range(0x21))).lower()
        if w:
            out.add(w)
    return sorted(out)


def clean_text(c: str | Column, stopwords: Iterable[str]) -> Column:
    """Surviving tokens joined by one space (empty string when none)."""
    return F.array_join(without_stopwords(tokens(c), stopwords), " ")
