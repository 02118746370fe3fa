"""Registered queries that go through files, stored tables and streams of
several micro-batches. Importing this module adds them to the registry of
:mod:`tessera.plans.catalog`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalars import ellipsis
from tessera.operators import detections as D
from tessera.operators import ratings as R
from tessera.operators import text as TX
from tessera.plans import bindings as B
from tessera.plans import oracle as O
from tessera.plans.catalog import _JTRIM, _RESULTS_SQL, ORACLE, QUERIES, RESULTS_ZONE, _line, register
from tessera.session import scratch_path
from tessera.sources import datasets as DS
from tessera.sources import delimited as SRC
from tessera.sources import infer
from tessera.sources.bucketed import write_bucketed
from tessera.sources.sinks import RESULTS_SCHEMA, write_tsv
from tessera.streaming import detections as SD
from tessera.streaming import records as REC
from tessera.streaming.append_table import AppendTable, stream_to_table
from tessera.streaming.totals import TotalsTable, stream_totals

__all__ = ["ORACLE", "QUERIES"]

#: Files that an input is staged as, and triggers that read them.
FILES, TRIGGERS = 8, 4


def _per_trigger(spark: SparkSession, path: str, fmt: str = "parquet") -> int:
    files = len(spark.read.format(fmt).load(path).inputFiles())
    return max(1, -(-files // TRIGGERS))


def _staged_events(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as events, staged in the order of their ids, as a stream."""
    path = scratch_path(spark, "document-events")
    events = B.document_events(B.table(spark, sf, "documents"))
    events.repartitionByRange(FILES, "event_id").write.parquet(path)
    return SD.read_stream(spark, path, events.schema, files_per_trigger=_per_trigger(spark, path))


# ============================================================ streaming =====

_BASE_LINE = """'{"frame_id": ' || doc_id || ', "timestamp": ' || (1700000000 + doc_id) || '.5, "person_count": ' || (n_chars % 5)
    || ', "process_ms": ' || n_chars || '.25, "boxes": []}'"""
_RECORD_LINE = f"""CASE doc_id % 13
    WHEN 1 THEN '' WHEN 3 THEN substr({_BASE_LINE}, 1, 25)
    WHEN 5 THEN '{{"frame_id": ' || doc_id || ', "person_count": 1}}'
    WHEN 7 THEN '{{"frame_id": "f' || doc_id || '", "timestamp": 1.5, "person_count": 0}}'
    WHEN 9 THEN '[' || {_BASE_LINE} || ']' WHEN 11 THEN {_BASE_LINE} || {_BASE_LINE} ELSE {_BASE_LINE} END"""


@register("stream_quarantine", f"""
WITH l AS (SELECT doc_id, n_chars, {_RECORD_LINE} AS line,
    CASE doc_id % 13 WHEN 1 THEN 'empty line' WHEN 3 THEN 'not JSON' WHEN 5 THEN 'missing timestamp' WHEN 7 THEN 'bad value'
      WHEN 9 THEN 'not an object' WHEN 11 THEN 'not JSON' END AS reason FROM documents)
SELECT CASE WHEN reason IS NULL THEN doc_id END AS frame_id, CASE WHEN reason IS NULL THEN 1700000000.5::DOUBLE + doc_id END AS timestamp,
  CASE WHEN reason IS NULL THEN (n_chars % 5)::INT END AS person_count, CASE WHEN reason IS NULL THEN n_chars + 0.25::DOUBLE END AS process_ms,
  CASE WHEN reason IS NOT NULL THEN line END AS line, reason FROM l""")
def q_stream_quarantine(spark, sf):
    """JSON lines, some broken, as a stream: records and quarantined lines."""
    path = scratch_path(spark, "record-lines")
    lines = B.table(spark, sf, "documents").repartitionByRange(FILES, "doc_id").select(F.expr(_RECORD_LINE))
    lines.write.text(path)
    base, ckpt = SD.new_paths(spark, "stream-quarantine")
    good, bad = AppendTable(spark, f"{base}/records", fan=2), AppendTable(spark, f"{base}/broken", fan=2)
    stream = REC.read_line_stream(spark, path, files_per_trigger=_per_trigger(spark, path, "text"))
    SD.run_to_end(REC.stream_records(stream, REC.DETECTION_RECORD, good, bad, ckpt, REC.DETECTION_REQUIRED))
    records = good.read().select("frame_id", "timestamp", "person_count", "process_ms")
    return records.unionByName(bad.read().select(F.col("value").alias("line"), "reason"), allowMissingColumns=True)


@register("stream_results_table", _RESULTS_SQL.replace("WITH ", "WITH " + O.B_DOCUMENT_EVENTS + ",\n", 1))
def q_stream_results_table(spark, sf):
    """The results file as a table of compacted micro-batches, by its log."""
    base, ckpt = SD.new_paths(spark, "stream-results-table")
    table = AppendTable(spark, f"{base}/results", "csv", fan=2)
    records = D.detection_records(B.detections_from_events(_staged_events(spark, sf)))
    SD.run_to_end(stream_to_table(D.results_table(records, RESULTS_ZONE), table, ckpt))
    return table.read().select(*RESULTS_SCHEMA.fieldNames())


@register("stream_camera_totals", "WITH " + O.B_DOCUMENT_EVENTS + """
SELECT user_id AS source, count(*) AS total FROM events GROUP BY user_id""")
def q_stream_camera_totals(spark, sf):
    """Running totals of many sources, merged from what each trigger changed."""
    base, ckpt = SD.new_paths(spark, "stream-camera-totals")
    table = TotalsTable(spark, f"{base}/totals", ["source"], buckets=8, merge_folders=2)
    SD.run_to_end(stream_totals(_staged_events(spark, sf).withColumnRenamed("user_id", "source"), table, ckpt))
    return table.read()


@register("stream_rating_files", O.with_(O.B_DOCUMENT_RATINGS) + """
SELECT CAST(movie_id AS VARCHAR) AS movie_id, sum(CAST(rating AS DECIMAL(18,6)))::DOUBLE / count(*) AS avg_rating, count(*) AS n_ratings
FROM b_document_ratings GROUP BY movie_id""")
def q_stream_rating_files(spark, sf):
    """Rating files that arrive in two loads: each load aggregates its own files
    and merges the partial sums into those of the loads before."""
    ratings = B.document_ratings(B.table(spark, sf, "documents"))
    path = scratch_path(spark, "rating-files")
    base, ckpt = SD.new_paths(spark, "stream-rating-files")
    table = AppendTable(spark, f"{base}/partials", fan=2, combine=R.merge_partials)
    for load in (0, 1):
        part = ratings.filter(F.col("ts") % 2 == load)
        part.select(_line(",", "user_id", "movie_id", "rating", "ts")).write.mode("append").text(path)
        lines = spark.readStream.text(path)
        SD.run_to_end(stream_to_table(DS.parse_ratings(lines), table, ckpt, reduce=R.rating_partials))
    return R.stats_of_partials(table.read())


# ============================================================== skew, buckets =

@register("hot_user_gender_pivot", O.with_(O.B_DOCUMENT_RATINGS, O.B_LABEL_USERS) + """
SELECT r.movie_id, coalesce(d.lang || ' ' || d.source, 'Movie_' || r.movie_id) AS title,
       avg(CASE WHEN upper(u.gender) = 'M' THEN r.rating END) AS male_avg,
       avg(CASE WHEN upper(u.gender) = 'M' THEN NULL ELSE r.rating END) AS female_avg
FROM b_document_ratings r JOIN b_label_users u ON r.user_id = u.user_id
LEFT JOIN documents d ON r.movie_id = d.doc_id AND d.doc_id % 2 = 0
GROUP BY r.movie_id, d.lang, d.source""")
def q_hot_user_gender_pivot(spark, sf):
    """Means by gender where one user gave a third of all ratings."""
    docs = B.table(spark, sf, "documents")
    movies = docs.filter("doc_id % 2 = 0").select(F.col("doc_id").alias("movie_id"), F.concat("lang", F.lit(" "), "source").alias("title"))
    return R.gender_avg_pivot(B.document_ratings(docs), B.label_users(spark, sf), movies, spread=True)


@register("bucketed_top_words", ORACLE["category_sentiment_top_words"])
def q_bucketed_top_words(spark, sf):
    """Top words of the labelled reviews, reviews and labels stored in the same
    buckets of the id."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    reviews = write_bucketed(B.reviews(spark, sf, with_sentiment=False), "id", buckets)
    labels = write_bucketed(B.sentiments(spark, sf), "id", buckets)
    return TX.category_sentiment_top_words(reviews, B.stopwords(spark), sentiments=labels, broadcast_labels=0)


# ================================================================ files =====

@register("key_order_positions", """
SELECT coalesce(url, '') || chr(9) || page_id AS line, row_number() OVER (ORDER BY coalesce(url, ''), page_id) - 1 AS position FROM pages""")
def q_key_order_positions(spark, sf):
    """Key and value lines in key order over many files, with the place at
    which each line is found in them."""
    path = scratch_path(spark, "ordered-lines")
    pages = B.table(spark, sf, "pages").select(F.coalesce("url", F.lit("")).alias("key"), F.col("page_id").alias("value"))
    write_tsv(pages, path, sort_by=["key", "value"])
    return SRC.number_lines(SRC.read_lines(spark, path, numbered=True)).select(F.col("value").alias("line"), "position")


@register("file_headers", """
SELECT CASE WHEN doc_id % 99 = 0 THEN 'doc_id' ELSE doc_id::VARCHAR END AS key,
       CASE WHEN doc_id % 99 = 0 THEN 'n_chars' ELSE n_chars::VARCHAR END AS n FROM documents""")
def q_file_headers(spark, sf):
    """Files with two kinds of headers and without one, each cut into parts;
    some data lines are equal to a header."""
    docs = B.table(spark, sf, "documents")
    copy = F.col("doc_id") % 99 == 0  # in the first kind of files
    text = lambda c: F.when(copy, F.lit(c)).otherwise(F.col(c).cast("string"))
    paths = []
    for kind, names in enumerate((("doc_id", "n_chars"), ("id", "length"), None)):
        part = docs.filter(F.col("doc_id") % 3 == kind).repartition(3, "doc_id").select(text("doc_id").alias("a"), text("n_chars").alias("b"))
        paths.append(scratch_path(spark, f"headers-{kind}"))
        part.toDF(*(names or ("a", "b"))).write.option("header", names is not None).csv(paths[-1])
    columns = ["key", "n"]
    lines = SRC.drop_file_headers(SRC.read_lines(spark, paths, numbered=True), SRC.unlike_types(columns, {"n": "bigint"}))
    return SRC.parse_delimited(lines, columns)


@register("rejected_rating_lines", """
WITH l AS (SELECT doc_id, CASE doc_id % 11 WHEN 1 THEN doc_id || ',7' WHEN 4 THEN doc_id || ',7,,' WHEN 6 THEN doc_id || ',7,five,0'
    WHEN 9 THEN doc_id || ',7,5.0,noon' ELSE doc_id || ',7,' || (n_chars % 9) || '.5,0' END AS value FROM documents)
SELECT value, CASE WHEN doc_id % 11 IN (1, 4) THEN 2 ELSE 4 END AS n_fields,
  CASE doc_id % 11 WHEN 6 THEN 'bad rating' WHEN 9 THEN 'bad ts' ELSE 'few fields' END AS reason FROM l WHERE doc_id % 11 IN (1, 4, 6, 9)""")
def q_rejected_rating_lines(spark, sf):
    """Rating lines that are skipped or cannot be read, with the reason."""
    k = F.col("doc_id")
    rest = (
        F.when(k % 11 == 1, ",7").when(k % 11 == 4, ",7,,").when(k % 11 == 6, ",7,five,0").when(k % 11 == 9, ",7,5.0,noon")
        .otherwise(F.concat(F.lit(",7,"), (F.col("n_chars") % 9).cast("string"), F.lit(".5,0")))
    )
    path = scratch_path(spark, "rating-lines")
    B.table(spark, sf, "documents").select(F.concat(k.cast("string"), rest)).write.text(path)
    types = {"rating": "double", "ts": "bigint"}
    return SRC.rejected_lines(SRC.read_lines(spark, path), ["user_id", "movie_id", "rating", "ts"], min_fields=3, types=types)


#: Columns of the inferred file: (name, SQL text of a value, SQL of the typed value, type).
_INFERRED = [
    ("c_int", "n_chars", "n_chars::INT", "int"),
    ("c_signed", "0 - n_chars", "(0 - n_chars)::INT", "int"),
    ("c_bigint", "doc_id * 3000000000", "doc_id * 3000000000", "bigint"),
    ("c_late_bigint", "CASE WHEN late THEN 3000000000 ELSE n_chars END", "CASE WHEN late THEN 3000000000 ELSE n_chars END", "bigint"),
    ("c_decimal", "(doc_id + 1) || '00000000000000000000'", "(doc_id + 1) || '00000000000000000000'", "decimal(38,0)"),
    ("c_double", "n_chars || '.25'", "n_chars + 0.25::DOUBLE", "double"),
    ("c_late_double", "CASE WHEN late THEN '1.5' ELSE n_chars || '' END", "CASE WHEN late THEN 1.5::DOUBLE ELSE n_chars END", "double"),
    ("c_exponent", "n_chars || 'e2'", "n_chars * 100.0::DOUBLE", "double"),
    ("c_timestamp", "'2024-01-02 03:04:' || (10 + doc_id % 50)", "make_timestamp(2024, 1, 2, 3, 4, (10 + doc_id % 50)::DOUBLE)", "timestamp"),
    ("c_boolean", "CASE WHEN doc_id % 2 = 0 THEN 'true' ELSE 'FALSE' END", "doc_id % 2 = 0", "boolean"),
    ("c_text", "lang", "lang", "string"),
    ("c_quoted", "lang || ';\"' || doc_id", "lang || ';\"' || doc_id", "string"),
    ("c_late_text", "CASE WHEN late THEN 'none' ELSE n_chars || '' END", "CASE WHEN late THEN 'none' ELSE n_chars || '' END", "string"),
    ("c_late_date", "CASE WHEN late THEN '0' ELSE '2024-01-02' END", "CASE WHEN late THEN '0' ELSE '2024-01-02' END", "string"),
    ("c_int_null", "CASE WHEN doc_id % 7 <> 0 THEN n_chars END", "CASE WHEN doc_id % 7 <> 0 THEN n_chars::INT END", "int"),
    ("c_double_null", "CASE WHEN doc_id % 7 = 0 THEN n_chars || '.5' END", "CASE WHEN doc_id % 7 = 0 THEN n_chars + 0.5::DOUBLE END", "double"),
    ("c_timestamp_null", "CASE WHEN doc_id % 3 = 0 THEN '2024-01-02 00:00:00' END", "CASE WHEN doc_id % 3 = 0 THEN make_timestamp(2024, 1, 2, 0, 0, 0.0) END", "timestamp"),
    ("c_padded", "' ' || n_chars || ' '", "n_chars::INT", "int"),
    ("c_mixed", "CASE doc_id % 2 WHEN 0 THEN 'true' ELSE '7' END", "CASE doc_id % 2 WHEN 0 THEN 'true' ELSE '7' END", "string"),
    ("c_nothing", "CASE WHEN false THEN 'x' END", "CASE WHEN false THEN 'x' END", "string"),
]
_INFERRED_TYPES = ", ".join(f"{n} {t}" for n, _, _, t in _INFERRED)
_LATE = "(SELECT *, doc_id = (SELECT max(doc_id) FROM documents) AS late FROM documents)"


@register("inferred_csv", f"""
SELECT {", ".join(f"{v} AS {n}" for n, _, v, _ in _INFERRED)}, '{_INFERRED_TYPES}' AS types FROM {_LATE} d""")
def q_inferred_csv(spark, sf):
    """A file of 20 columns read back with the types that its values have; some
    columns are widened by a single value."""
    docs = B.table(spark, sf, "documents")
    last = docs.agg(F.max("doc_id").alias("last"))
    docs = docs.join(F.broadcast(last)).withColumn("late", F.col("doc_id") == F.col("last"))  # one row
    path = scratch_path(spark, "untyped-csv")
    cells = [F.expr(text).cast("string").alias(n) for n, text, _, _ in _INFERRED]
    plain = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}  # keep the padding
    docs.select(*cells).write.options(sep=";", header="true", escape='"', **plain).csv(path)
    rows = infer.read_inferred_csv(spark, path)
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.withColumns({"c_decimal": F.col("c_decimal").cast("string"), "types": F.lit(types)})


@register("movie_catalog_files", """
WITH t AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'New ' ELSE 'Old ' END || source || ' ' || repeat(lang, (n_chars % 20)::INT) || '!' AS title,
             CASE WHEN doc_id % 2 = 0 THEN lang || ',' || source || '|' || doc_id ELSE lang || '|x,y' END AS genres FROM documents)
SELECT doc_id::VARCHAR AS movie_id, CASE WHEN length(title) > 38 THEN substr(title, 1, 35) || '...' ELSE title END AS title, genres FROM t""")
def q_movie_catalog_files(spark, sf):
    """Two files of movies, the second with new lines for some of the first
    one's; long titles, commas in the genres."""
    docs = B.table(spark, sf, "documents")
    title = lambda word: F.concat(F.lit(word), F.col("source"), F.lit(" "), F.expr("repeat(lang, int(n_chars % 20))"), F.lit("!"))
    base = scratch_path(spark, "movie-catalog")
    docs.select(_line(",", "doc_id", title("Old "), F.concat("lang", F.lit("|x,y")))).write.text(f"{base}/a")
    new = docs.filter("doc_id % 2 = 0")
    new.select(_line(",", "doc_id", title("New "), F.concat("lang", F.lit(","), "source", F.lit("|"), F.col("doc_id").cast("string")))).write.text(f"{base}/b")
    movies = DS.read_movies(spark, [f"{base}/a", f"{base}/b"])
    return movies.withColumn("title", ellipsis("title"))


_WORDS_SQL = f"""list_filter(list_transform(regexp_split_to_array(lower(comment), '[ \\t\\n\\x0B\\f\\r[:punct:]]+'),
    lambda t: {_JTRIM.format(c='t')}), lambda t: t <> '' AND t NOT IN {O.STOPWORDS_SQL})"""


@register("clean_text_files", f"""
WITH r AS (SELECT doc_id AS id, CASE WHEN doc_id % 7 = 0 THEN ' The OF, de (and) TO!' ELSE text END AS comment FROM documents),
c AS (SELECT id, array_to_string({_WORDS_SQL}, ' ') AS clean FROM r)
SELECT id, clean FROM c WHERE length(clean) > 0""")
def q_clean_text_files(spark, sf):
    """Reviews cleaned with a stop-word file; some have stop words only."""
    path = scratch_path(spark, "stopwords")
    words = [w for k, w in enumerate(B.TEST_STOPWORDS) for w in ((w.upper(), f"\t{w} ", "") if k % 2 else (w, w))]
    spark.createDataFrame([(w,) for w in words], "value string").write.text(path)
    stop = [r.word for r in SRC.read_stopwords(spark, path).collect()]  # a list of the caller's own
    comment = F.when(F.col("doc_id") % 7 == 0, " The OF, de (and) TO!").otherwise(F.col("text"))
    reviews = B.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), comment.alias("comment"))
    return TX.clean_text(reviews, stop)


@register("detection_rounding", """
WITH f AS (SELECT doc_id AS frame_id, n_chars, unnest(CASE WHEN n_chars % 3 = 0 THEN [NULL] ELSE range(0, n_chars % 3) END) AS i FROM documents),
b AS (SELECT *, 0.3::DOUBLE + ((n_chars + 37 * i) % 700) / 1000.07::DOUBLE AS confidence FROM f),
k AS (SELECT *, coalesce(confidence >= 0.4, false) AS kept FROM b)
SELECT f.frame_id, round_even(f.n_chars / 8.0::DOUBLE, 2) AS process_ms, k.box::INT AS box, k.x1, k.y1, k.x2, k.y2, k.confidence
FROM (SELECT doc_id AS frame_id, n_chars FROM documents) f LEFT JOIN (
  SELECT frame_id, row_number() OVER (PARTITION BY frame_id ORDER BY i) - 1 AS box, trunc(n_chars / 7.0::DOUBLE + i)::INT AS x1,
    trunc(0 - n_chars / 9.0::DOUBLE)::INT AS y1, trunc(n_chars / 7.0::DOUBLE + 10.75)::INT AS x2, trunc(n_chars / 9.0::DOUBLE)::INT AS y2,
    round_even(confidence, 4) AS confidence FROM k WHERE kept) k ON f.frame_id = k.frame_id""")
def q_detection_rounding(spark, sf):
    """What is written of fractional boxes (of both signs), confidences and
    times, among them times half-way between two hundredths."""
    n, real = F.col("n_chars"), T.DoubleType()

    def box(i):
        return F.struct(
            (n / F.lit(7.0) + i).alias("x1"), (-(n / F.lit(9.0))).alias("y1"), (n / F.lit(7.0) + 10.75).alias("x2"), (n / F.lit(9.0)).alias("y2"),
            (F.lit(0.3) + (n + i * 37) % 700 / F.lit(1000.07)).alias("confidence"), F.lit(D.PERSON_CLASS).alias("cls"),
        )

    some = F.when(n % 3 > 0, F.sequence(F.lit(0).cast("long"), n % 3 - 1)).otherwise(F.expr("cast(array() as array<bigint>)"))
    frames = B.table(spark, sf, "documents").select(
        F.col("doc_id").alias("frame_id"), F.timestamp_seconds(F.col("doc_id")).alias("ts"), F.lit(0).alias("source"),
        (n.cast(real) / 8).alias("process_ms"), F.transform(some, box).alias("raw_boxes"),
    )
    records = D.detection_records(frames)
    return records.select("frame_id", "process_ms", F.posexplode_outer("boxes").alias("box", "b")).select("frame_id", "process_ms", "box", "b.*")
