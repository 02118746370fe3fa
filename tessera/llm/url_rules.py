"""URL verdicts by pattern rules, indexed by their rarest literal token.

A rule (action, host, path) fits the host and its subdomains if the url's path
starts with the rule's. It is a regular expression over host and path. Its
literal tokens are those that every url it fits must have whole: the labels of
its host and the closed segments of its path. The rule is filed under the one
of them that is rarest in the urls at hand; the tokens of a url fetch the
rules filed under them, and only these candidates run their expressions. A
rule without a token is filed under the empty token, which every url has.

Rules up to ``BROADCAST_RULES`` are broadcast; more are joined by a shuffle in
which common tokens are spread over ``SALTS``. The fitting rule with the
longest text wins; a tie goes to the longer host, then to the greater text,
then to ``block``.

Defined cases: a null url or one without ``://`` has empty host and path and
no token but the empty one; a url that no rule fits gets the default verdict;
repeated rows are judged as rows of their own; an empty table gives an empty
result; null parts of a rule are empty; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ROW, freeze, materialize

DEFAULT = "allow"
BROADCAST_RULES = 100_000
SALTS = 32
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Lower-cased host, and path, of a url; both empty if there is no ``://``."""
    u = F.col(url)
    found = F.coalesce(F.regexp_extract(u, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(u, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2), F.lit(""))
    return F.translate(found, _UPPER, _LOWER), path


def _tokens(host: Column, segments: Column) -> Column:
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("."), x))
    parts = F.transform(segments, lambda x: F.concat(F.lit("/"), x))
    return F.array_distinct(F.filter(F.concat(labels, parts), lambda x: F.length(x) > 1))


def _literal(text: Column) -> Column:
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def compile_rules(rules: DataFrame) -> DataFrame:
    """action, rule (its text), host_length, pattern and tokens of each rule."""
    host = F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER)
    rows = rules.select("action", host.alias("host"), F.coalesce("path", F.lit("")).alias("path")).distinct()
    subdomains = F.when(F.col("host") == "", F.lit("^[^/]*")).otherwise(F.concat(F.lit(r"^(?:[^/]*\.)?"), _literal(F.col("host"))))
    rest = F.when(F.col("path") == "", F.lit(r"(?:/|\z)")).otherwise(_literal(F.col("path")))
    segments = F.split("path", "/")
    closed = F.slice(segments, F.lit(1), F.size(segments) - 1)  # the last may go on in a url
    return rows.select(
        "action",
        F.concat("host", "path").alias("rule"),
        F.length("host").alias("host_length"),
        F.concat(subdomains, rest).alias("pattern"),
        _tokens(F.col("host"), closed).alias("tokens"),
    )


def _index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """The rules with ``token``, the rarest of theirs in the urls."""
    own = rules.select(F.explode("tokens").alias("token")).distinct()
    seen = urls.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    common = own.join(seen, "token", "left").select("token", F.coalesce("n", F.lit(0)).alias("n"))
    each = rules.select("rule", "action", F.explode("tokens").alias("token")).join(common, "token")
    rarest = each.groupBy("rule", "action").agg(F.min(F.struct("n", "token")).alias("rarest"))
    filed = rules.join(rarest, ["rule", "action"], "left")
    return filed.select("rule", "action", "host_length", "pattern", F.coalesce("rarest.token", F.lit("")).alias("token"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule (null if none fits) and verdict of every page."""
    host, path = host_and_path()
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = freeze(urls.withColumn("tokens", _tokens(F.col("host"), F.split("path", "/"))), "urls")
    filed = materialize(_index(materialize(compile_rules(rules), "rules"), urls), "rule-index")
    filed = filed.withColumnRenamed("token", "__t_token")
    every = F.concat(F.array(F.lit("")), F.col("tokens"))
    asked = urls.select(ROW, "page_id", "host", "path", F.explode(every).alias("token"))
    if filed.count() <= BROADCAST_RULES:
        found = asked.join(F.broadcast(filed), F.col("token") == F.col("__t_token"), "left")
    else:
        salt = lambda c: F.pmod(F.xxhash64(c), F.lit(SALTS))
        copies = filed.withColumn("__t_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        on = (F.col("token") == F.col("__t_token")) & (salt(ROW) == F.col("__t_salt"))
        found = asked.join(copies, on, "left")
    fits = F.expr("concat(host, path) rlike pattern")
    best = F.struct(F.length("rule").alias("n"), "host_length", "rule", "action")
    judged = found.groupBy(ROW, "page_id", "host", "path").agg(F.max(F.when(fits, best)).alias("best"))
    return judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))
