"""Missing-value rules, scalar functions, the term calendar, and tail probabilities."""

import datetime

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import missing, scalars, tails, terms


def values(spark, column, rows, ddl):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(column).collect()]


def test_blank_rules(spark):
    rows = [("a",), ("  ",), ("",), (None,)]
    assert values(spark, missing.blank_to_null("x"), rows, "x string") == ["a", None, None, None]
    assert values(spark, missing.present("x"), rows, "x string") == [True, False, False, False]
    assert values(spark, missing.not_equal("x", "a"), rows, "x string") == [False, True, True, True]
    assert values(spark, missing.placeholder_key("x", "NONE"), rows, "x string") == ["a", "NONE", "NONE", "NONE"]


def test_null_sum_and_max(spark):
    rows = [(1.0, 2.0), (None, 2.0), (1.0, None), (None, None)]
    assert values(spark, missing.null_sum("a", "b"), rows, "a double, b double") == [3.0, 2.0, 1.0, None]
    assert values(spark, missing.null_max("a", "b"), rows, "a double, b double") == [2.0, 2.0, 1.0, None]
    assert values(spark, F.col("a") - F.col("b"), rows, "a double, b double") == [-1.0, None, None, None]


def test_codes(spark):
    assert values(spark, scalars.char_from_end("x"), [("11CHEMBS",), ("B",), (None,), ("XB  ",)], "x string") == ["B", None, None, "X"]
    assert values(spark, scalars.code_normalise("x"), [("14.0901",), (None,), ("14",)], "x string") == ["140901", "", "14"]
    assert values(spark, scalars.label_concat("Tier", "x"), [(1,), (None,)], "x int") == ["Tier 1", "Missing"]
    assert values(spark, scalars.zero_pad("x", 6), [(12,), (12345678,)], "x int") == ["000012", "12345678"]
    assert values(spark, scalars.picture_percent("x"), [(12.345678,), (0.0,), (100.0,)], "x double") == ["12.35%", "0.00%", "100.00%"]
    assert values(spark, scalars.binary_recode("x"), [(0,), (4,), (None,)], "x int") == [0, 1, None]


def test_decode(spark):
    table = {"1": "one", "2": "two"}
    rows = [("1",), ("9",), (None,)]
    assert values(spark, scalars.decode("x", table), rows, "x string") == ["one", None, None]
    assert values(spark, scalars.decode("x", table, "other"), rows, "x string") == ["one", "other", "other"]


def test_json_path_tells_null_from_absent(spark):
    rows = [('{"a":{"b":5}}',), ('{"a":{"b":null}}',), ('{"a":1}',), ("not json",), (None,)]
    assert values(spark, scalars.json_path_default("x", "$.a.b", "d"), rows, "x string") == ["5", None, "d", "d", "d"]


def test_size_step_up(spark):
    rows = [(1,), (200,), (201,), (1600,), (3200,), (9999,)]
    assert values(spark, scalars.size_step_up("x"), rows, "x int") == [200, 200, 400, 1600, 3200, 3200]


@pytest.mark.parametrize(
    "career,expected",
    [
        ("GRAD", {0.5: None, 1: "L", 4: "L", 4.2: None, 4.5: "H", 6.5: "H", 6.75: None, 7: "Q", 8.5: "Q", 8.7: None, 9: "F", 20: "F"}),
        ("AGI", {0.5: None, 1: "L", 5: "L", 5.5: None, 6: "H", 8: "H", 8.5: None, 9: "Q", 11: "Q", 11.5: None, 12: "F"}),
        ("OTHER", {0.5: None, 5: None, 12: None}),
    ],
)
def test_band_ladder_edges(spark, career, expected):
    rows = [(float(h), career, "F") for h in expected]
    got = values(spark, scalars.band_ladder("h", "c", "l"), rows, "h double, c string, l string")
    assert got == list(expected.values())


def test_band_ladder_withdrawn_and_missing(spark):
    rows = [(None, "UGRD", "W"), (0.0, "OTHER", "W"), (0.0, "UGRD", "F"), (3.0, "UGRD", "W"), (None, None, None)]
    got = values(spark, scalars.band_ladder("h", "c", "l"), rows, "h double, c string, l string")
    assert got == ["W", "W", None, "L", None]


def test_review_rule(spark):
    rows = [(None, None), (None, 0.0), (None, 3.0), ("F", None)]
    assert values(spark, scalars.needs_review("s", "a"), rows, "s string, a double") == [True, True, False, False]


@pytest.mark.parametrize(
    "day,expected",
    [
        ("2018-01-15", [("Fall", ["2186", "2187", "2188"], "2188", "2178"), ("Spring", ["2181"], "2181", "2171")]),
        ("2018-02-01", [("Fall", ["2186", "2187", "2188"], "2188", "2178")]),
        ("2018-08-31", [("Fall", ["2186", "2187", "2188"], "2188", "2178")]),
        ("2018-09-01", [("Spring", ["2191"], "2191", "2181")]),
        ("2018-11-01", [("Fall", ["2196", "2197", "2198"], "2198", "2188"), ("Spring", ["2191"], "2191", "2181")]),
        ("2009-10-01", [("Spring", ["2101"], "2101", "2091")]),
    ],
)
def test_term_calendar(spark, day, expected):
    row = values(spark, terms.term_calendar(F.to_date("d")), [(day,)], "d string")[0]
    assert [(c.season, c.terms, c.semester, c.history_semester) for c in row] == expected


def test_same_day_last_year(spark):
    rows = [(datetime.date(2020, 2, 29),), (datetime.date(2021, 2, 28),)]
    assert values(spark, scalars.same_day_last_year("d"), rows, "d date") == [datetime.date(2019, 2, 28), datetime.date(2020, 2, 28)]


def test_media_label(spark):
    def label(caption):
        column = scalars.media_label(F.lit("CAROUSEL_ALBUM"), F.lit("2024-01-03").cast("timestamp_ntz"), F.col("c"))
        return values(spark, column, [(caption,)], "c string")[0]

    head = "carousel album shared on Wed Jan 03 2024 | "
    assert label("hello") == head + "hello"
    assert label("x" * 200) == (head + "x" * 200)[:122] + "..."
    assert label("x" * (121 - len(head)) + " tail") == head + "x" * (121 - len(head)) + " "


def test_media_fields(spark):
    c = F.col
    rows = [("VIDEO", "m", "t", "cap", "ttl"), ("IMAGE", "m", "t", "", None), ("IMAGE", "m", "t", None, "ttl")]
    ddl = "kind string, url string, thumb string, cap string, ttl string"
    assert values(spark, scalars.media_source(c("kind"), c("url"), c("thumb")), rows, ddl) == ["t", "m", "m"]
    assert values(spark, scalars.media_alt(c("cap"), F.lit("label"), c("ttl")), rows, ddl) == ["label", None, "ttl"]
    assert values(spark, scalars.media_title(c("ttl"), c("cap")), rows, ddl) == ["ttl", "", "ttl"]


def test_tails_against_published_tables():
    assert tails.t_critical(10) == pytest.approx(2.2281, abs=1e-4)
    assert tails.t_two_sided(2.0, 60) == pytest.approx(0.0500, abs=1e-4)
    assert tails.f_upper(4.9646, 1, 10) == pytest.approx(0.05, abs=1e-5)
    assert tails.f_upper(2.8661, 4, 20) == pytest.approx(0.05, abs=1e-5)
    assert tails.chi2_upper(5.9915, 2) == pytest.approx(0.05, abs=1e-5)
    assert tails.tukey_critical(3, 10) == pytest.approx(3.877, abs=1e-3)
    assert tails.tukey_critical(5, 60) == pytest.approx(3.977, abs=1e-3)
    assert tails.tukey_critical(3, 5) == pytest.approx(4.602, abs=1e-3)
