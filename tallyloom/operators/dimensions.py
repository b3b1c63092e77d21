"""Dimension tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import surrogate_key

# name -> descriptive columns, in output order (the id column comes first)
DIMENSIONS = {
    "product": ["product_id", "category", "brand", "product_name", "variant",
                "pack_size", "unit_price", "unit_cogs"],
    "distributor": ["distributor_id", "distributor_name", "distributor_type", "city",
                    "province", "region", "start_year"],
    "salesperson": ["salesperson_id", "salesperson_name", "supervisor",
                    "distributor_id", "territory", "join_year"],
    "outlet": ["outlet_id", "outlet_name", "channel", "outlet_tier", "distributor_id",
               "salesperson_id", "city", "province", "region", "open_year"],
}


def dimension(staged: DataFrame, name: str) -> DataFrame:
    """Staged master data plus its surrogate key."""
    columns = DIMENSIONS[name]
    key = surrogate_key(name, F.col(columns[0])).alias(f"{name}_key")
    return staged.select(key, *columns)


def dim_date(bounds: list[tuple[DataFrame, str]]) -> DataFrame:
    """One row per day between the smallest and largest date of the given columns.

    Only two dates per input are shuffled. The calendar itself is one row exploded:
    its length is bounded by the date range, not by the data.
    """
    def span(df: DataFrame, column: str) -> DataFrame:
        return df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))

    spans = reduce(DataFrame.unionByName, [span(df, c) for df, c in bounds])
    day = F.col("date_day")
    days = (
        spans.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .select(F.explode(F.expr("sequence(lo, hi, interval 1 day)")).alias("date_day"))
    )
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        "date_day",
        F.dayofmonth(day).alias("day_of_month"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter_number"),
        F.year(day).alias("year"),
        F.trunc(day, "MM").alias("month_start"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        (F.weekday(day) + 1).alias("day_of_week_number"),  # Monday 1 … Sunday 7
        F.date_format(day, "EEEE").alias("day_name"),
        (day == F.trunc(day, "MM")).alias("is_month_start"),
    )
