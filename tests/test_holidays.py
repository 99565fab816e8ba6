"""The calendar of holidays: years of every law, days in lieu and between, joined to dates."""

import datetime

import pytest
from pyspark.sql import functions as F

from kotonoha.functions import holidays
from kotonoha.functions import strings as st

#: All holidays of some years, by kind.
YEARS = {
    1949: ("0101 0115 0321 0429 0503 0505 0923 1103 1123", "", ""),
    1959: ("0101 0115 0321 0410 0429 0503 0505 0924 1103 1123", "", ""),
    1973: ("0101 0115 0211 0321 0429 0503 0505 0915 0923 1010 1103 1123", "0430 0924", ""),
    1988: ("0101 0115 0211 0320 0429 0503 0505 0915 0923 1010 1103 1123", "0321", "0504"),
    1992: ("0101 0115 0211 0320 0429 0503 0505 0915 0923 1010 1103 1123 1223", "0504", ""),
    2001: ("0101 0108 0211 0320 0429 0503 0505 0720 0915 0923 1008 1103 1123 1223", "0212 0430 0924 1224", "0504"),
    2008: ("0101 0114 0211 0320 0429 0503 0504 0505 0721 0915 0923 1013 1103 1123 1223", "0506 1124", ""),
    2009: ("0101 0112 0211 0320 0429 0503 0504 0505 0720 0921 0923 1012 1103 1123 1223", "0506", "0922"),
    2019: ("0101 0114 0211 0321 0429 0501 0503 0504 0505 0715 0811 0916 0923 1014 1022 1103 1123", "0506 0812 1104", "0430 0502"),
    2020: ("0101 0113 0211 0223 0320 0429 0503 0504 0505 0723 0724 0810 0921 0922 1103 1123", "0224 0506", ""),
    2024: ("0101 0108 0211 0223 0320 0429 0503 0504 0505 0715 0811 0916 0922 1014 1103 1123", "0212 0506 0812 0923 1104", ""),
}


@pytest.fixture(scope="module")
def days(spark):
    return [(r["date"], r["name"], r["kind"]) for r in holidays.calendar(spark, 1948, 2030).collect()]


@pytest.mark.parametrize("year", sorted(YEARS))
def test_years(days, year):
    got = tuple(" ".join(sorted(f"{d:%m%d}" for d, _, k in days if d.year == year and k == kind)) for kind in ("named", "lieu", "between"))
    assert got == YEARS[year]


def test_calendar_begins_with_the_law_and_has_a_day_once(days):
    assert min(d for d, *_ in days) == datetime.date(1948, 9, 23) and len({d for d, *_ in days}) == len(days)
    assert {n for d, n, _ in days if d == datetime.date(1989, 4, 29)} == {"みどりの日"} and {n for d, n, _ in days if d == datetime.date(1988, 4, 29)} == {"天皇誕生日"}


def test_agrees_with_the_column_form(spark, days):
    got = {r["d"] for r in spark.sql("SELECT explode(sequence(date'2021-01-01', date'2030-12-31')) AS d").where("year(d) > 2021").where(st.is_japanese_holiday(F.col("d"))).collect()}
    assert got == {d for d, *_ in days if 2022 <= d.year <= 2030}


def test_joined_to_times(spark):
    table = spark.createDataFrame([(1, "2001-05-04 10:00:00"), (2, "2001-05-07 00:00:00"), (3, None), (4, "1930-01-01 00:00:00")], "i int, t string").selectExpr("i", "CAST(t AS timestamp) AS t")
    assert {tuple(r) for r in holidays.with_holidays(table, "t").select("i", "holiday", "holiday_kind").collect()} == {(1, "国民の休日", "between"), (2, None, None), (3, None, None), (4, None, None)}
    assert holidays.with_holidays(table.limit(0), "t").count() == 0 and holidays.with_holidays(table.where("t is null"), "t").count() == 1
