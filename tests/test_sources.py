"""Delimited sources: arity guard, header drop, casts."""

import pytest
from pyspark.errors import PySparkException

from tessera.sources.delimited import drop_header_lines, parse_delimited, read_semicolon_csv, read_stopwords
from tessera.sources.sinks import read_tsv, write_tsv
from tests.conftest import rows


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_arity_guard_counts_fields_the_java_way(spark):
    df = lines(spark, ["a;b;c;d;e", "a;b;c;;", "a;b", "", ";;;;", "w; x ;y;z"])
    got = rows(parse_delimited(df, ["c0", "c1", "c2", "c3"], sep=";"))
    # "a;b;c;;" has 3 Java fields -> skipped; "a;b", "" and ";;;;" too.
    assert got == [("a", "b", "c", "d"), ("w", "x", "y", "z")]


def test_min_fields_below_column_count(spark):
    df = lines(spark, ["1;x", "2;y;extra", "3"])
    got = rows(parse_delimited(df, ["id", "name"], sep=";", min_fields=2))
    assert got == [("1", "x"), ("2", "y")]


def test_limit_split_keeps_commas_in_title(spark):
    # Limit 3 keeps the title with its comma; no-limit shifts genres.
    df = lines(spark, ['7,Good, Bad and Ugly (1966),Western'])
    limited = parse_delimited(df, ["id", "title", "rest"], sep=",", limit=3).first()
    assert limited["title"] == "Good"
    assert limited["rest"] == "Bad and Ugly (1966),Western"
    unlimited = parse_delimited(df, ["id", "title", "genres"], sep=",").first()
    assert unlimited["genres"] == "Bad and Ugly (1966)"


def test_header_drop_removes_every_copy(spark):
    # The first-line filter removes all equal lines.
    df = lines(spark, ["id,name", "1,a", "id,name", "2,b"])
    got = rows(drop_header_lines(df, "id,name"))
    assert got == [("1,a",), ("2,b",)]
    # Without a header nothing is eaten (the header is a parameter).
    assert rows(drop_header_lines(lines(spark, ["1,a", "2,b"]), "id,name")) == [("1,a",), ("2,b",)]


def test_strict_cast_fails_tolerant_gives_null(spark):
    # H9
    df = lines(spark, ["1,abc", "2,4.5"])
    tolerant = parse_delimited(df, ["id", "rating"], types={"id": "int", "rating": "double"}, strict=False)
    assert rows(tolerant) == [(1, None), (2, 4.5)]
    strict = parse_delimited(df, ["id", "rating"], types={"id": "int", "rating": "double"})
    with pytest.raises((PySparkException, Exception)):
        strict.collect()


def test_read_stopwords(spark, tmp_path):
    p = tmp_path / "stop.txt"
    p.write_text("Và\n  của \n\nvà\nbởi vì\n", encoding="utf-8")
    sw = read_stopwords(spark, str(p))
    assert rows(sw) == [("bởi vì",), ("của",), ("và",)]


def test_multi_path_scan_is_one_table(spark, tmp_path):
    # S3: textFile("a,b") reads both inputs as one table.
    from tessera.sources.delimited import read_lines

    (tmp_path / "a.txt").write_text("1,x\n2,y\n")
    (tmp_path / "b.txt").write_text("3,z\n")
    df = read_lines(spark, [str(tmp_path / "a.txt"), str(tmp_path / "b.txt")])
    assert rows(parse_delimited(df, ["id", "v"], types={"id": "int"})) == [(1, "x"), (2, "y"), (3, "z")]


def test_semicolon_csv_with_header_and_schema(spark, tmp_path):
    from tessera.sources.delimited import read_semicolon_csv

    p = tmp_path / "orders.csv"
    p.write_text("Order_ID;Customer_Trx_ID;Order_Purchase_Timestamp\n"
                 "o1;c1;2024-03-01 10:00:00\no2;c2;\n")
    df = read_semicolon_csv(spark, str(p), "order_id string, customer_trx_id string, order_purchase_timestamp timestamp")
    got = rows(df)
    assert got[0][:2] == ("o1", "c1") and got[1] == ("o2", "c2", None)


def test_tsv_sink_key_tab_value(spark, tmp_path):
    from tessera.sources.sinks import write_tsv

    df = spark.createDataFrame([("Toy Story (1995)", "AverageRating: 4.25 (TotalRatings: 2)")], "k string, v string")
    write_tsv(df.coalesce(1), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert text == "Toy Story (1995)\tAverageRating: 4.25 (TotalRatings: 2)\n"


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text('note;PRICE;Id\n"x;y";10.5;007\n;;8\n')
    got = rows(read_semicolon_csv(spark, str(tmp_path / "a.csv"), "id string, price double"))
    assert got == [("007", 10.5), ("8", None)]
    with pytest.raises(ValueError, match="no column country"):
        read_semicolon_csv(spark, str(tmp_path / "a.csv"), "id string, country string")


def test_tsv_is_written_as_it_is(spark, tmp_path):
    data = [("# key", "  blanks  "), ("b", ""), ("c", 'a\t"b"'), (" d", "#x"), ("e", None)]
    write_tsv(spark.createDataFrame(data, "key string, value string"), str(tmp_path / "out"), sort_by=["key"])
    assert rows(read_tsv(spark, str(tmp_path / "out"))) == sorted((k, v or "") for k, v in data)
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert text == "".join(f"{k}\t{v or ''}\n" for k, v in sorted(data))
