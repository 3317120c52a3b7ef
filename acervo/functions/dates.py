"""Portuguese dates, date keys and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo import fixed_values as fixed


def month_map(spark: SparkSession) -> DataFrame:
    """The twelve Portuguese month abbreviations with their numbers."""
    rows = ", ".join(f"('{pt}', '{num}')" for pt, num in fixed.MONTHS_PT)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS month_map(month_pt, month_num)")


def day_part(c: Column) -> Column:
    """Day digits of ``d-Mon-yyyy``, ``1`` for ``Mon-yyyy``, else NULL."""
    return F.when(c.rlike(fixed.DAY_MONTH_YEAR), F.regexp_extract(c, fixed.DAY_MONTH_YEAR, 1)).when(
        c.rlike(fixed.MONTH_YEAR), F.lit("1")
    )


def month_part(c: Column) -> Column:
    """Month abbreviation of either accepted form, else NULL."""
    return F.when(c.rlike(fixed.DAY_MONTH_YEAR), F.regexp_extract(c, fixed.DAY_MONTH_YEAR, 2)).when(
        c.rlike(fixed.MONTH_YEAR), F.regexp_extract(c, fixed.MONTH_YEAR, 1)
    )


def year_part(c: Column) -> Column:
    """Last four digits, '' where there are none."""
    return F.regexp_extract(c, fixed.YEAR_AT_END, 1)


def with_pt_date(df: DataFrame, source: str, target: str) -> DataFrame:
    """Add ``target``, the date written in Portuguese in column ``source``; NULL where unreadable.

    The month table has twelve rows by construction, so broadcasting it is safe at any scale.
    """
    text = F.col(f"`{source}`")
    parsed = df.withColumns(
        {"__day": day_part(text), "__month_pt": month_part(text), "__year": year_part(text)}
    )
    months = F.broadcast(month_map(df.sparkSession).withColumnRenamed("month_pt", "__month_pt"))
    iso = F.concat(F.col("__year"), F.lit("-"), F.col("month_num"), F.lit("-"), F.lpad("__day", 2, "0"))
    return (
        parsed.join(months, "__month_pt", "left")
        .withColumn(target, F.try_to_date(iso, "yyyy-MM-dd"))
        .drop("__day", "__month_pt", "__year", "month_num")
    )


def date_key(c: Column) -> Column:
    """yyyymmdd as an integer; NULL stays NULL."""
    return F.date_format(c, "yyyyMMdd").cast("int")


def calendar_attributes(day: Column) -> dict[str, Column]:
    """The 19 attributes of one day, in output order."""
    year_start = F.date_trunc("YEAR", day)
    return {
        "date_id": date_key(day),
        "date": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "month_short_name": F.date_format(day, "MMM"),
        "week_of_year": F.weekofyear(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_year": F.dayofyear(day),
        "day_short_name": F.date_format(day, "E"),
        "day_name": F.date_format(day, "EEEE"),
        "is_weekend": F.when(F.dayofweek(day).isin(1, 7), 1).otherwise(0),
        "month_start_date": F.date_trunc("MONTH", day),
        "month_end_date": F.last_day(day),
        "year_start_date": year_start,
        "year_end_date": F.date_sub(F.add_months(year_start, 12), 1),
        "year_month": F.concat(F.year(day), F.lit("-"), F.lpad(F.month(day).cast("string"), 2, "0")),
        "year_quarter": F.concat(F.year(day), F.lit("-Q"), F.quarter(day)),
    }
