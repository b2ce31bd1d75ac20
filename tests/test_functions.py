"""Column functions on edge values."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from courtlake.functions import dates, durations, numbers, text
from courtlake.operators.store import typed_store
from courtlake.schemas import GoldTable
from harness.raw import filled

NAN, INF = math.nan, math.inf
# Written out: duration, minutes with two decimals, seconds of a period clock.
DURATIONS = [
    ("12:34", 12.57, None), ("PT12M34.00S", 12.57, 754.0), ("PT12M34.50S", 12.57, 754.5),
    ("PT-1M30.0S", -0.5, -30.0), ("PT12M34.00SS", 12.57, 754.0), ("PTinfM2S", INF, INF),
    ("PT12M", None, None), ("PT34.00S", None, None), ("PT1H2M3S", None, None), ("PT12:34", None, None),
    ("PT05MS", None, None), ("PT1fM2S", None, None), ("PT", None, None), ("PTMS", None, None),
    (" PT1M2S", None, None), ("12:34PT", None, None), ("1:2:3", 1.03, None), ("-1:30", -0.5, None),
    ("0:00", 0.0, None), ("12:", None, None), (":30", None, None), ("5:1f", None, None),
    ("12.5", 12.5, None), (" 7 ", 7.0, None), ("36", 36.0, None), ("1e1", 10.0, None), ("NaN", NAN, None),
    ("inf", INF, None), ("x", None, None), ("1d", None, None), ("", None, None), (None, None, None),
]


def values(spark, rows, kind, **columns):
    """Rows of (value, one result per named column)."""
    df = spark.createDataFrame([(v,) for v in rows], f"v {kind}")
    return df.select("v", *[c.alias(n) for n, c in columns.items()]).collect()


def same(a, b):
    return a == b or (None not in (a, b) and math.isnan(a) and math.isnan(b))


def test_durations(spark):
    expected = {text: (minutes, seconds) for text, minutes, seconds in DURATIONS}
    for row in values(spark, list(expected), "string", m=durations.decimal_minutes("v"),
                      s=durations.clock_seconds("v")):
        minutes, seconds = expected[row.v]
        assert same(row.m, minutes) and same(row.s, seconds), row


def test_rounding_is_that_of_the_binary_value(spark):
    rng = random.Random(1)
    sample = [rng.uniform(-60, 60) for _ in range(2000)]
    sample += [round(rng.uniform(0, 60), 3) for _ in range(2000)]
    sample += [12.575, 2.675, 0.125, 0.375, -0.125, -2.675, 1e300, math.inf, 0.0, 12 + 34.5 / 60]
    for row in values(spark, sample, "double", r=numbers.round_half_even("v")):
        assert row.r == round(row.v, 2), row


@pytest.mark.parametrize("written, double, long, unsafe", [
    ("1", 1.0, 1, False), ("1.5", 1.5, None, True), ("1.0", 1.0, 1, False),
    ("1e2", 100.0, 100, False), ("inf", math.inf, None, True), ("x", None, None, False),
    ("", None, None, False), (None, None, None, False), ("true", 1.0, 1, False),
    ("false", 0.0, 0, False), ("9007199254740993", 9007199254740992.0, 9007199254740993, False),
    ("1e30", 1e30, None, True), (" 3 ", 3.0, 3, False), ("1_0", None, None, False),
    ("0x10", None, None, False), ("1d", None, None, False), ("0x1p3", None, None, False),
    ("-2", -2.0, -2, False), ("9223372036854775808", 9223372036854775808.0, None, True),
])
def test_coercion(spark, written, double, long, unsafe):
    row, = values(spark, [written], "string", d=numbers.coerce_double("v"),
                  n=numbers.coerce_long("v"), u=numbers.is_unsafe_long("v"))
    assert (row.d, row.n, row.u) == (double, long, unsafe)


def test_strict_casts_raise(spark):
    for column, bad in [
        (numbers.coerce_long_strict("v"), "1.5"), (numbers.cast_int_strict("v"), None),
        (numbers.cast_int_strict("v"), "x"), (numbers.store_char("v", 3), "long"),
        (numbers.store_decimal("v", 8, 2), "1000000"),
    ]:
        with pytest.raises(Exception):
            values(spark, [bad], "string", c=column)
    row, = values(spark, ["12"], "string", a=numbers.coerce_long_strict("v"),
                  b=numbers.cast_int_strict("v"), c=numbers.store_char("v", 3))
    assert (row.a, row.b, row.c) == (12, 12, "12")


def test_truth(spark):
    rows = values(spark, [0.0, 2.0, None, math.nan], "double", t=numbers.truthy_number("v"))
    assert [r.t for r in rows] == [False, True, True, True]
    rows = values(spark, ["", "0", None], "string", t=numbers.truthy_text("v"))
    assert [r.t for r in rows] == [False, True, False]
    rows = values(spark, [True, False, None], "boolean", t=numbers.truthy_bool("v"))
    assert [r.t for r in rows] == [True, False, False]


def test_stored_types(spark):
    layout = GoldTable({"i": "int", "d": "decimal(8,2)", "c": "char(3)"}, ("i",))
    raw = spark.createDataFrame(
        [(2.5, 0.125, "G  "), (3.5, -0.125, None), (math.nan, math.nan, "")],
        "i double, d double, c string",
    )
    rows = typed_store(raw, layout).collect()
    assert [r.i for r in rows] == [2, 4, None]
    assert [None if r.d is None else str(r.d) for r in rows] == ["0.13", "-0.13", None]
    assert [r.c for r in rows] == ["G  ", None, ""]


def test_dates(spark):
    rows = values(spark, ["2023-10-01", "2024-09-30", "2024-01-01"], "string",
                  s=dates.season_of_date("v"))
    assert [r.s for r in rows] == [2023, 2023, 2023]
    assert values(spark, ["22023"], "string", s=dates.season_of_id("v"))[0].s == 2023
    rows = values(spark, ["20240131", "20240231", "2024-01-31", ""], "string",
                  d=dates.parse_date("v"), e=dates.parse_date_lenient("v"))
    assert [str(r.d) for r in rows] == ["2024-01-31", "None", "None", "None"]
    assert [str(r.e) for r in rows] == ["2024-01-31", "None", "2024-01-31", "None"]
    assert dates.date_range(spark, "2024-02-27", "2024-03-01").count() == 4
    assert dates.date_range(spark, "2024-03-01", "2024-02-27").count() == 0


def test_text(spark):
    row, = values(spark, ["\t　a b \n"], "string", t=text.strip_text("v"))
    assert row.t == "a b"
    row, = values(spark, [None], "string", t=text.strip_text("v"), n=text.strip_text("v", "None"))
    assert (row.t, row.n) == (None, "None")
    row, = values(spark, ["file:/x/y/0010500001.json"], "string", k=text.key_from_path("v"))
    assert row.k == "0010500001"
    row, = values(spark, ["x/a.json.b.json"], "string", k=text.key_from_path("v"))
    assert row.k == "a.json.b"
    doc = F.from_json("v", "map<string,string>")
    rows = values(spark, ['{"a":"x"}', '{"a":null}', "{}"], "string",
                  a=text.get_or_default(doc, "a"), e=F.size(text.extras(doc, ["b"])))
    assert [r.a for r in rows] == ["x", None, ""]
    assert [r.e for r in rows] == [1, 1, 0]


# Forms that a cast reads, or nearly: blanks and control characters, signs, digits of other scripts, Java's forms.
ODD_NUMBERS = [
    None, "", " ", "\t", "n/a", "N/A", "x", "-", "+", ".", "e", "E5", "1e", "1e2", "1E2", "-1e-2", "1.", ".5", "-.5", "+.5",
    "12", "+12", "-12", " 12 ", "\n12\n", "\x0012\x1f", "12\x7f", "1 2", "12.0", "12.50", "007", "0x10", "0x1p3", "1d", "2f",
    "1_000", "1,000", "١٢", "١.5", "１", " 12", "inf", "+inf", "-Inf", "Infinity", "-INFINITY",
    "+NaN", "nan", " NaN ", "-nan", "info", "banana", "a\nnan", "a\n5", "5\na", "9223372036854775807",
    "9223372036854775808", "-9223372036854775808", "1e30", "99999999999999999999.0", "true", "false", "True", "\U0001d7cf",
]


def test_text_told_apart_before_a_cast_is_no_number(spark):
    """What the looks before the casts leave out, the casts alone read as null."""
    v = F.col("v")
    exact = v.try_cast("decimal(38,18)")
    long = F.coalesce(v.try_cast("bigint"), F.when(exact == F.floor(exact), exact.try_cast("bigint")),
                      F.when(v == "true", 1).when(v == "false", 0).cast("bigint"))
    double = F.when(~v.rlike("[dDxX]|(^|[^nN])[fF]"), v.try_cast("double"))
    for row in values(spark, ODD_NUMBERS, "string", l=numbers.coerce_long("v"), d=numbers.parse_double("v"),
                      long=long, double=double):
        assert row.l == row.long and same(row.d, row.double), row


def test_text_that_is_no_number_or_date_meets_no_cast(spark):
    """A cast that fails costs an exception: every cast of text comes behind a look that such text doesn't pass."""
    df = spark.createDataFrame([(t,) for t in ("", "n/a", "bad date", "x")], "v string")
    v = F.col("v")
    tried = df.select(numbers.coerce_long(v), numbers.coerce_double(v), dates.parse_date(v))
    plan = tried._jdf.queryExecution().analyzed().toString()
    assert all(before.endswith("THEN ") for before in plan.split("try_cast(")[:-1]), plan
    assert "try_to_timestamp(CASE WHEN" in plan, plan
    for row in df.select("v", v.rlike(numbers._LIKE_LONG), v.rlike(numbers._ANY_DIGIT),
                         ~v.rlike(f"{numbers._JAVA_ONLY_NUMBER}|{numbers._NO_NUMBER}"), v.rlike("[0-9]")).collect():
        assert not any(row[1:]), row


def test_filled_templates_are_formatted_texts(spark):
    df = spark.createDataFrame([(7, "a"), (-1, "%d"), (None, None)], "n bigint, t string")
    n, t = F.col("n"), F.col("t")
    for template, given in (("x%d:%s", (n, t)), ("%s%s", (t, t)), ("%d", (n,)), ("plain %d end", (n,))):
        for row in df.select(filled(template, *given).alias("a"), F.format_string(template, *given).alias("b")).collect():
            assert row.a == row.b
