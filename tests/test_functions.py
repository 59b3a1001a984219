from __future__ import annotations

from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.functions import calendar as cal
from ledgerline.functions import scalars as S
from ledgerline.functions import text as X


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "given,want",
    [("00:30:00", "00:00:00"), ("01:30:00", "02:00:00"), ("02:30:00", "02:00:00"), ("01:29:59.999", "01:00:00"), ("01:30:00.000001", "02:00:00"), ("22:45:00", "23:00:00")],
)
def test_round_hour_is_half_to_even(spark, given, want):
    ts = F.to_timestamp_ntz(F.lit(f"2024-01-01 {given}"))
    assert one(spark, S.round_hour(ts)) == pd.Timestamp(f"2024-01-01 {want}")


def test_round_hour_equals_pandas(spark):
    pdf = pd.DataFrame({"ts": pd.date_range("2024-01-01", periods=500, freq="15min")})
    got = spark.createDataFrame(pdf).select(S.round_hour(F.col("ts")).alias("h"), "ts").orderBy("ts").toPandas()["h"]
    assert (got == pdf["ts"].dt.round("h")).all()


def test_right_closed_bins(spark):
    col = S.right_closed(F.col("x"), [0, 30, 40, 100], ["lt30", "30-40", "gt40"])
    rows = spark.createDataFrame([(0,), (1,), (30,), (31,), (40,), (41,), (101,)], "x int").select(col).collect()
    assert [r[0] for r in rows] == [None, "lt30", "lt30", "30-40", "30-40", "gt40", None]


def test_parsers_give_null_for_nonsense(spark):
    assert one(spark, S.parse_money(F.lit("$1,234.50"))) == 1234.5
    assert one(spark, S.parse_money(F.lit("n/a"))) is None
    formats = ["dd/MM/yyyy", "dd.MM.yyyy HH:mm"]
    assert one(spark, S.parse_timestamp(F.lit("31.12.2019 23:05"), formats)) == pd.Timestamp("2019-12-31 23:05")
    assert one(spark, S.parse_timestamp(F.lit("soon"), formats)) is None


def test_ratios_and_means(spark):
    assert one(spark, S.safe_ratio(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, S.ratio_or_same(F.lit(3.0), F.lit(0.0))) == 3.0
    assert one(spark, S.row_mean(F.lit(1.0), F.lit(None).cast("double"), F.lit(3.0))) == 2.0
    assert one(spark, S.flag(F.lit(None).cast("boolean"))) == 0
    assert one(spark, S.recode(F.lit("z"), {"a": 1}, 9)) == 9 and one(spark, S.recode(F.lit("z"), {"a": 1})) is None


# The federal calendar as published, observed days included.
KNOWN = {
    2019: "01-01 01-21 02-18 05-27 07-04 09-02 10-14 11-11 11-28 12-25",
    2021: "01-01 01-18 02-15 05-31 06-18 06-19 07-04 07-05 09-06 10-11 11-11 11-25 12-24 12-25 12-31",
    2024: "01-01 01-15 02-19 05-27 06-19 07-04 09-02 10-14 11-11 11-28 12-25",
}


@pytest.mark.parametrize("year", KNOWN)
def test_holidays(spark, year):
    days = spark.sql(f"select explode(sequence(date'{year}-01-01', date'{year}-12-31', interval 1 day)) as d")
    rows = days.select("d", cal.is_holiday(F.col("d")).alias("h"), cal.holiday_name(F.col("d")).alias("n"), cal.near_holiday(F.col("d")).alias("near")).collect()
    want = {date.fromisoformat(f"{year}-{x}") for x in KNOWN[year].split()}
    assert {r["d"] for r in rows if r["h"]} == want
    assert {r["d"] for r in rows if r["n"]} == want
    assert all(r["near"] == 1 for r in rows if r["h"])


@pytest.mark.parametrize(
    ("text", "joined"),
    [("not good", "not_good"), ("not no good", "not_no good"), ("no", "no"), ("a not", "a not"), ("knot good nor bad", "knot good nor_bad"), ("no no no no", "no_no no_no")],
)
def test_negations_join_greedily(spark, text, joined):
    assert one(spark, X.join_negations(F.lit(text))) == joined


def test_normalize(spark):
    assert one(spark, X.normalize_text(F.lit(None).cast("string"))) == "noreview"
    assert one(spark, X.one_spaced(X.normalize_text(F.lit("See http://x.y/z NOW \U0001F600 Café 42!")))) == "see now caf"
    assert one(spark, X.expand_contractions(F.lit("It's what they've said; I can't, we won't, DON'T"))) == "it is what they have said; I cannot, we will not, DO not"


def test_parse_summary_with_continuation_lines(spark):
    text = "Main Idea: one two\nKey Points:\n- a\n  more\n\n- b\nConclusion: end\n of it\n"
    row = spark.range(1).select(X.parse_summary(F.lit(text)).alias("s")).select("s.*").first()
    assert (row["main_idea"], row["key_points"], row["conclusion"]) == ("one two", ["a", "more", "b"], "end of it")


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 18, 19, 100])
def test_chunks_cover_the_whole_text(spark, n):
    text = "".join(chr(97 + i % 26) for i in range(n))
    rows = X.chunks(spark.createDataFrame([(1, text)], "k int, t string"), ["k"], "t", 10, 2).orderBy("chunk").collect()
    joined = rows[0]["body"] + "".join(r["body"][2:] for r in rows[1:])
    assert joined == text and all(len(r["body"]) <= 10 for r in rows)


def test_tails_of_test_statistics():
    from ledgerline.operators.evaluation import chi_square_tail, student_tail

    for x, dof in ((3.841458820694124, 1), (5.991464547107979, 2), (18.307038053275146, 10)):
        assert abs(chi_square_tail(x, dof) - 0.05) < 1e-9
    assert 0.49 < chi_square_tail(2000, 2000) < 0.5 and 0.49 < chi_square_tail(1500, 1500) < 0.5
    for t, dof in ((12.706204736432095, 1), (2.2281388519649385, 10)):
        assert abs(student_tail(t, dof) - 0.05) < 1e-9
    assert abs(student_tail(8, 5000) / student_tail(8, 5001) - 1) < 1e-3 and student_tail(0, 3) == 1.0
