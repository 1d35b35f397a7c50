import html

import pytest
from pyspark.sql import functions as F

from foliant.functions import isbn as i, jsons as j, text as t

BLANKED = "　\x1c a\tb \n"


def values(spark, rows, expr, kind="string"):
    df = spark.createDataFrame([(n, r) for n, r in enumerate(rows)], f"n int, c {kind}")
    return [r[0] for r in df.orderBy("n").select(expr).collect()]


def test_whitespace_is_what_str_strip_removes():
    assert set(t.WHITESPACE) == {chr(n) for n in range(0x110000) if chr(n).isspace()}


def test_strip_and_title_key(spark):
    rows = [BLANKED, "", "  ", None, "Éa "]
    assert values(spark, rows, t.strip("c")) == [r if r is None else r.strip() for r in rows]
    assert values(spark, rows, t.title_key("c")) == ["a\tb", None, None, None, "éa"]


def test_clean_html_agrees_with_the_stdlib(spark):
    import re

    rows = [
        "<p>a &amp;lt; b</p>\n", "AT&T <b\n>x</b>", "&copy &notit; &#x41;&#65", "plain", "", "<i>&quot;q&#39;</i>",
        "&amp;amp;", "  &nbsp;x<br/>\r",
    ]
    want = [html.unescape(re.sub("<.*?>", "", r)).strip() for r in rows]
    assert values(spark, rows + [None], t.clean_html("c")) == want + [""]
    assert values(spark, rows, t.html_unescape("c")) == [html.unescape(r) for r in rows]
    lists = [rows, [], None, ["x", None]]
    got = values(spark, lists, t.html_unescape_all("c"), "array<string>")
    assert got == [None if x is None else [y and html.unescape(y) for y in x] for x in lists]


@pytest.mark.parametrize("kind", ["float", "int"])
def test_number_parsing_agrees_with_python(spark, kind):
    rows = ["1", " 2 ", "+3", "-4.5", "1e3", "1_000", "1__0", "_1", "x", "", "3.0", "1d", "2f", "0x10", "inf",
            "-Infinity", ".5", "5.", "1 2", "12abc", None]
    parse = {"float": float, "int": int}[kind]

    def python(text):
        try:
            return parse(text)
        except (ValueError, TypeError):
            return None

    fn = {"float": t.try_float, "int": t.try_int}[kind]
    assert values(spark, rows, fn("c")) == [python(r) for r in rows]


def test_nan(spark):
    assert values(spark, ["nan", "NaN", "1"], t.nan_to_null(t.try_float("c"))) == [None, None, 1.0]


def test_dates_of_five_digit_years_have_no_sign(spark):
    last = 2_932_896 * 86_400_000
    assert values(spark, [last, last + 86_400_000], t.epoch_ms_to_date("c"), "bigint") == ["9999-12-31", "10000-01-01"]


def test_counts_dates_and_labels(spark):
    assert values(spark, ["1,234 ratings", "none", "", None], t.parse_count("c")) == [1234, 0, 0, 0]
    days = values(spark, [0, None, 86_400_000, 1_500_000_000_123], t.epoch_ms_to_date("c"), "bigint")
    assert days == [None, None, "1970-01-02", "2017-07-14"]
    assert values(spark, ["abcd\ne  ", "abc", ""], t.excerpt("c", 4)) == ["abcd...", "abc", ""]
    assert values(spark, [1234567, 0], t.thousands("c"), "bigint") == ["1,234,567", "0"]
    rows = [("2001", "5", "6"), ("2001", "", None), ("2001", "5", ""), ("", "", ""), ("2001", "", "6")]
    df = spark.createDataFrame(rows, "y string, m string, d string")
    got = [r[0] for r in df.select(t.pub_date_label(F.col("y"), F.col("m"), F.col("d"))).collect()]
    assert got == ["2001-5-6", "2001", "2001-5", "N/A", "2001-6"]


def test_falsy_coalesce(spark):
    df = spark.createDataFrame([("", "b"), (None, None), ("a", "b")], "a string, b string")
    assert [r[0] for r in df.select(t.falsy_coalesce("a", "b", default="z")).collect()] == ["b", "z", "a"]


def test_english_isbn(spark):
    rows = ["9780123456789", "9781123456789", "9798123456789", "9791123456789", "0306406152", "030640615X",
            "978-0-306-40615-7", "", "2306406152", None]
    want = [True, True, True, False, True, False, True, False, False, False]
    assert values(spark, rows, i.is_english_isbn("c")) == want


def test_preferred_isbn_and_identifier(spark):
    rows = [(["9780 "], ["1"]), ([], [" 0123 "]), (None, None), ([], [])]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    assert [r[0] for r in df.select(i.preferred_isbn("a", "b")).collect()] == ["9780", "0123", None, None]
    df = spark.createDataFrame([("", "", "A"), ("", None, "")], "a string, b string, c string")
    assert [r[0] for r in df.select(i.best_identifier("a", "b", "c")).collect()] == ["A", "N/A"]


def test_json_defaults_tell_null_from_missing(spark):
    rows = ['{"a":null}', "{}", '{"a":3}']
    got = values(spark, rows, j.json_path_or(F.parse_json("c"), "$.a", "int", 7))
    assert got == [None, 7, 3]


def test_dates_do_not_depend_on_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert values(spark, [86_400_000, -1, 1_500_000_000_123], t.epoch_ms_to_date("c"), "bigint") == [
            "1970-01-02", "1969-12-31", "2017-07-14"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
