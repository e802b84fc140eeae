"""Business days: a table of days with a running number of working days, joined twice in place of counting day by day."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# National holidays by public law (month, day, first year), those of the city, and days from Easter of movable ones.
NATIONAL = [(1, 1, 0), (4, 21, 0), (5, 1, 0), (9, 7, 0), (10, 12, 0), (11, 2, 0), (11, 15, 0), (12, 25, 0)]
CITY = [(1, 25, 0), (11, 20, 0)]
FROM_EASTER = {"carnival monday": -48, "carnival tuesday": -47, "good friday": -2, "corpus christi": 60}


def easter(year: int) -> date:
    """Easter Sunday, by the anonymous Gregorian algorithm."""
    a, (b, c) = year % 19, divmod(year, 100)
    h = (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30
    ell = (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7
    m = (a + 11 * h + 22 * ell) // 451
    month, day = divmod(h + ell - 7 * m + 114, 31)
    return date(year, month, day + 1)


def holidays(first: int, last: int) -> list[date]:
    """All holidays of the years from first to last."""
    out = {date(y, m, d) for y in range(first, last + 1) for m, d, since in NATIONAL + CITY if y >= since}
    return sorted(out | {easter(y) + timedelta(days=n) for y in range(first, last + 1) for n in FROM_EASTER.values()})


def is_working(day: date) -> bool:
    return day.weekday() < 5 and day not in holidays(day.year, day.year)


def calendar(spark: SparkSession, first: int = 1990, last: int = 2040) -> DataFrame:
    """(day, working, ordinal) of some 20000 days at most, by which it is bounded: ordinal counts the working days up to the day."""
    off, rows, n, day = set(holidays(first, last)), [], 0, date(first, 1, 1)
    while day.year <= last:
        working = day.weekday() < 5 and day not in off
        n += working
        rows.append((day, working, n))
        day += timedelta(days=1)
    return spark.createDataFrame(rows, "day date, working boolean, ordinal int")


def with_working_days(df: DataFrame, start: str, end: str, name: str = "dias_uteis") -> DataFrame:
    """Adds the working days in (start, end]; 0 if end isn't after start, null if either is null or out of the calendar."""
    days = calendar(df.sparkSession)
    a = F.broadcast(days.select(F.col("day").alias("_a"), F.col("ordinal").alias("_x")))
    b = F.broadcast(days.select(F.col("day").alias("_b"), F.col("ordinal").alias("_y")))
    out = df.join(a, df[start] == F.col("_a"), "left").join(b, df[end] == F.col("_b"), "left")
    return out.withColumn(name, F.greatest(F.lit(0), F.col("_y") - F.col("_x")) + F.when(F.col("_x").isNull() | F.col("_y").isNull(), F.lit(None)).otherwise(0)).drop("_a", "_b", "_x", "_y")
