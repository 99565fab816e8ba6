"""Public holidays of Japan as a calendar: rows of law, spread over years, joined to dates.

Each row of law says from when to when a holiday falls on a day, a Monday, an equinox or one date only. The calendar of
some years is a table of about twenty rows a year, with the days that follow from the law as well: the day in lieu of a holiday on
a Sunday (since 1973; since 2007 the next day that is no holiday), and the day between two holidays (since 1985).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Name, first and last day in force, month, kind, day (of a Monday: which one).
LAW = (
    ("元旦", "1948-07-20", "2150-12-31", 1, "day", 1), ("成人の日", "1948-07-20", "1999-12-31", 1, "day", 15), ("成人の日", "2000-01-01", "2150-12-31", 1, "monday", 2),
    ("建国記念の日", "1967-01-01", "2150-12-31", 2, "day", 11), ("天皇誕生日", "2020-01-01", "2150-12-31", 2, "day", 23), ("昭和天皇の大喪の礼", "1989-01-01", "1989-12-31", 2, "day", 24),
    ("春分の日", "1948-07-20", "2150-12-31", 3, "spring", 0), ("皇太子明仁親王の結婚の儀", "1959-01-01", "1959-12-31", 4, "day", 10), ("天皇誕生日", "1948-07-20", "1988-12-31", 4, "day", 29),
    ("みどりの日", "1989-01-01", "2006-12-31", 4, "day", 29), ("昭和の日", "2007-01-01", "2150-12-31", 4, "day", 29), ("天皇の即位の日", "2019-01-01", "2019-12-31", 5, "day", 1),
    ("憲法記念日", "1948-07-20", "2150-12-31", 5, "day", 3), ("みどりの日", "2007-01-01", "2150-12-31", 5, "day", 4), ("こどもの日", "1948-07-20", "2150-12-31", 5, "day", 5),
    ("皇太子徳仁親王の結婚の儀", "1993-01-01", "1993-12-31", 6, "day", 9), ("海の日", "1996-01-01", "2002-12-31", 7, "day", 20), ("海の日", "2003-01-01", "2019-12-31", 7, "monday", 3),
    ("海の日", "2020-01-01", "2020-12-31", 7, "day", 23), ("スポーツの日", "2020-01-01", "2020-12-31", 7, "day", 24), ("海の日", "2021-01-01", "2021-12-31", 7, "day", 22),
    ("スポーツの日", "2021-01-01", "2021-12-31", 7, "day", 23), ("海の日", "2022-01-01", "2150-12-31", 7, "monday", 3), ("山の日", "2016-01-01", "2019-12-31", 8, "day", 11),
    ("山の日", "2020-01-01", "2020-12-31", 8, "day", 10), ("山の日", "2021-01-01", "2021-12-31", 8, "day", 8), ("山の日", "2022-01-01", "2150-12-31", 8, "day", 11),
    ("敬老の日", "1966-01-01", "2002-12-31", 9, "day", 15), ("敬老の日", "2003-01-01", "2150-12-31", 9, "monday", 3), ("秋分の日", "1948-07-20", "2150-12-31", 9, "autumn", 0),
    ("体育の日", "1966-01-01", "1999-12-31", 10, "day", 10), ("体育の日", "2000-01-01", "2019-12-31", 10, "monday", 2), ("スポーツの日", "2022-01-01", "2150-12-31", 10, "monday", 2),
    ("即位礼正殿の儀", "2019-01-01", "2019-12-31", 10, "day", 22), ("文化の日", "1948-07-20", "2150-12-31", 11, "day", 3), ("即位礼正殿の儀", "1990-01-01", "1990-12-31", 11, "day", 12),
    ("勤労感謝の日", "1948-07-20", "2150-12-31", 11, "day", 23), ("天皇誕生日", "1989-01-01", "2018-12-31", 12, "day", 23),
)
#: Day of the equinox: for years from the first on, the mean day in 1980 and the year from which leap days count.
EQUINOXES = {"spring": ((1948, 20.8357, 1983), (1980, 20.8431, 1980), (2100, 21.8510, 1980)), "autumn": ((1948, 23.2588, 1983), (1980, 23.2488, 1980), (2100, 24.2488, 1980))}
IN_LIEU, BETWEEN, CARRIED = "1973-04-12", "1985-12-27", "2007-01-01"


def _equinox(year: Column, kind: str) -> Column:
    day = None
    for first, mean, leap in EQUINOXES[kind]:
        # Leap years are counted with truncation towards zero.
        counted = (year - leap) / 4
        value = F.floor(mean + 0.242194 * (year - 1980) - F.when(counted < 0, F.ceil(counted)).otherwise(F.floor(counted)))
        day = value if day is None else F.when(year >= first, value).otherwise(day)
    return day


def calendar(spark: SparkSession, first: int, last: int) -> DataFrame:
    """(date, name, kind) of the holidays of some years; kind is ``named``, ``lieu`` or ``between``."""
    law = spark.createDataFrame(LAW, "name string, since string, until string, month int, kind string, day int")
    since, until = F.to_date("since"), F.to_date("until")
    years = law.withColumn("year", F.explode(F.filter(F.sequence(F.lit(first), F.lit(last)), lambda y: (y >= F.year(since)) & (y <= F.year(until)))))
    begin = F.make_date("year", "month", F.lit(1))
    date = (
        F.when(F.col("kind") == "day", F.make_date("year", "month", "day")).when(F.col("kind") == "monday", F.date_add(F.next_day(F.date_sub(begin, 1), "MON"), 7 * (F.col("day") - 1)))
        .when(F.col("kind") == "spring", F.date_add(begin, (_equinox(F.col("year"), "spring") - 1).cast("int"))).otherwise(F.date_add(begin, (_equinox(F.col("year"), "autumn") - 1).cast("int")))
    )
    named = years.select("year", date.alias("date"), "name", since.alias("since")).where("date >= since").drop("since")
    # A run of holidays without a gap: the first Sunday in it is made up for behind its end.
    in_year = Window.partitionBy("year").orderBy("date")
    runs = named.withColumn("run", F.date_sub("date", F.row_number().over(in_year))).withColumn("after", F.lead("date").over(in_year))
    ends = runs.groupBy("year", "run").agg(F.max("date").alias("end"), F.max(F.when(F.dayofweek("date") == 1, F.col("date"))).alias("sunday"))
    carried = F.col("end") >= CARRIED
    lieu = ends.where((F.col("sunday") >= IN_LIEU) & (carried | (F.col("sunday") == F.col("end")))).select(F.date_add("end", 1).alias("date"), F.lit("振替休日").alias("name"), F.lit("lieu").alias("kind"))
    middle = F.date_add("date", 1)
    between = runs.where((F.datediff("after", "date") == 2) & (middle >= BETWEEN) & (F.dayofweek(middle) != 1)).select(middle.alias("date"), F.lit("国民の休日").alias("name"), F.lit("between").alias("kind"))
    between = between.join(lieu, "date", "left_anti")
    return named.select("date", "name", F.lit("named").alias("kind")).unionByName(lieu).unionByName(between)


def with_holidays(table: DataFrame, column: str) -> DataFrame:
    """The table with ``holiday`` and ``holiday_kind`` of a date or time, null on other days. Years come from the table."""
    spark = table.sparkSession
    span = table.agg(F.min(F.year(column)).alias("first"), F.max(F.year(column)).alias("last")).first()
    if span["first"] is None:
        return table.withColumns({"holiday": F.lit(None).cast("string"), "holiday_kind": F.lit(None).cast("string")})
    days = calendar(spark, max(1948, span["first"]), min(2150, max(1948, span["last"])))  # at most some thousand rows
    days = days.select(F.col("date").alias("_date"), F.col("name").alias("holiday"), F.col("kind").alias("holiday_kind"))
    return table.join(F.broadcast(days), F.to_date(column) == F.col("_date"), "left").drop("_date")


