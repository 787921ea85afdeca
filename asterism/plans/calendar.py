"""The date dimension: generated, or typed from its text form."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casting import read_as
from ..schemas import WAREHOUSE, struct

# The span of the calendar and the names of the quarters.
FIRST_DAY = datetime.date(1998, 1, 1)
LAST_DAY = datetime.date(2077, 12, 31)
QUARTERS = ("First", "Second", "Third", "Fourth")

def _suffix(day: Column) -> Column:
    """``1st``, ``2nd``, ``3rd``, ``4th`` … ``11th``, ``12th``, ``13th`` …"""
    ending = (
        F.when(day.between(11, 13), "th")
        .when(day % 10 == 1, "st")
        .when(day % 10 == 2, "nd")
        .when(day % 10 == 3, "rd")
        .otherwise("th")
    )
    return F.concat(day.cast("string"), ending)


def calendar(
    spark: SparkSession, start: datetime.date = FIRST_DAY, end: datetime.date = LAST_DAY
) -> DataFrame:
    """One row per day, with ISO weeks, which start on Monday; week of month is ceil(day / 7)."""
    d = F.col("date_actual")
    day, month, quarter = F.dayofmonth(d), F.month(d), F.quarter(d)
    monday = F.trunc(d, "week")
    quarter_start, year_start = F.trunc(d, "quarter"), F.trunc(d, "year")
    iso_week = F.weekofyear(d)
    columns = {
        "date_id": F.date_format(d, "yyyyMMdd").cast("int"),
        "date_actual": d,
        "day_suffix": _suffix(day),
        "day_name": F.date_format(d, "EEEE"),
        "day_of_year": F.dayofyear(d),
        "week_of_month": F.ceil(day / 7).cast("int"),
        "week_of_year": iso_week,
        "week_of_year_iso": F.format_string("%04d-W%02d", F.expr("extract(YEAROFWEEK FROM date_actual)"), iso_week),
        "month_actual": month,
        "month_name": F.date_format(d, "MMMM"),
        "month_name_abbreviated": F.date_format(d, "MMM"),
        "quarter_actual": quarter,
        "quarter_name": F.element_at(F.array(*map(F.lit, QUARTERS)), quarter),
        "year_actual": F.year(d),
        "first_day_of_week": monday,
        "last_day_of_week": F.date_add(monday, 6),
        "first_day_of_month": F.trunc(d, "month"),
        "last_day_of_month": F.last_day(d),
        "first_day_of_quarter": quarter_start,
        "last_day_of_quarter": F.last_day(F.add_months(quarter_start, 2)),
        "first_day_of_year": year_start,
        "last_day_of_year": F.last_day(F.add_months(year_start, 11)),
        "mmyyyy": F.date_format(d, "MMyyyy"),
        "mmddyyyy": F.date_format(d, "MMddyyyy"),
        "weekend_indr": F.when(F.weekday(d) >= 5, "weekend").otherwise("weekday"),
    }
    days = spark.range((end - start).days + 1).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_actual"))
    return days.select([column.alias(name) for name, column in columns.items()])


def dim_date(text: DataFrame) -> DataFrame:
    """The date dimension from its text form, such as a CSV with the same columns."""
    fields = struct(WAREHOUSE["dim_date"]).fields
    return text.select([read_as(f.name, f.dataType.simpleString()).alias(f.name) for f in fields])
