"""Fact tables: a staged fact with dimension keys looked up by left join.

The key of a dimension is made from its id, so a fact makes it as well, from its own column.
Only the odd ids of the facts are looked up: those that a dimension lacks, has several times or
with another key. They are found over distinct ids and written before the facts are joined, so
that facts stay where they are unless odd ids are many. Then the adaptive skew join splits keys
that hold too many rows. A fact without a match keeps a NULL key; a duplicate in a dimension
multiplies its facts (the unique tests report it).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import surrogate_key
from ..session import work_dir

# The columns of the facts, here and in the selects below.
_LINEAGE = ["raw_record_id", "source_file", "source_sheet", "source_row_number",
            "pipeline_run_id", "ingested_at"]


def lookup(fact: DataFrame, dim: DataFrame, fact_column: str, dim_column: str,
           key: str) -> DataFrame:
    """Add one dimension key. Only the id and the key of the dimension travel."""
    side = dim.select(F.col(dim_column).alias("_id"), F.col(key))
    return fact.join(side, F.col(fact_column) == F.col("_id"), "left").drop("_id")


def odd_ids(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """(dim, id, key): what the dimensions have for those ids of the facts that are not there
    just once, with the key made from the id. Without any row in the dimension the key is NULL."""
    used = F.array(*[F.struct(F.lit(n).alias("dim"), F.col(f"{n}_id").cast("string").alias("id"))
                     for n in dims])
    ids = fact.select(F.inline(used)).where("id is not null").distinct()
    known = reduce(DataFrame.unionByName, [dim.select(
        F.lit(n).alias("dim"), F.col(f"{n}_id").cast("string").alias("id"),
        F.col(f"{n}_key").alias("key"),
        F.coalesce(F.col(f"{n}_key") == surrogate_key(n, F.col(f"{n}_id")), F.lit(False))
        .alias("usual")) for n, dim in dims.items()])
    usual = known.groupBy("dim", "id").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and("usual").alias("usual")).where("n = 1 and usual")
    odd = ids.join(usual.select("dim", "id"), ["dim", "id"], "left_anti")
    return odd.join(known.select("dim", "id", "key"), ["dim", "id"], "left")


def _lookups(fact: DataFrame, date: DataFrame, day: str,
             dims: dict[str, DataFrame]) -> DataFrame:
    out = lookup(fact, date, day, "date_day", "date_key")
    spark, folder = fact.sparkSession, work_dir(fact.sparkSession, "odd-ids")
    odd_ids(fact, dims).write.parquet(folder)  # so its size is known before the join
    odd = spark.read.schema("dim string, id string, key string").parquet(folder)
    for name in dims:
        side = odd.where(F.col("dim") == name).select(
            F.col("id").alias("_id"), F.col("key").alias("_key"), F.lit(True).alias("_odd"))
        own = F.col(f"{name}_id")
        out = out.join(side, own.cast("string") == F.col("_id"), "left").withColumn(
            f"{name}_key", F.when(F.col("_odd"), F.col("_key")).otherwise(
                surrogate_key(name, own))).drop("_id", "_key", "_odd")
    return out


def gross_margin(exact: bool = True) -> Column:
    """(net - cogs) / net, NULL for zero sales; exact=False divides as double."""
    net, cogs = F.col("net_sales"), F.col("total_cogs")
    profit = net - cogs
    ratio = profit / net if exact else profit.cast("double") / net.cast("double")
    return F.when(net != 0, ratio)


def fact_sales(unified: DataFrame, date: DataFrame, dims: dict[str, DataFrame],
               exact_margin: bool = True) -> DataFrame:
    """dims: product, distributor, salesperson, outlet."""
    return _lookups(unified, date, "sales_date", dims).select(
        surrogate_key("sales", F.col("invoice_id"), F.col("product_id")).alias("sales_key"),
        "date_key", "product_key", "distributor_key", "salesperson_key", "outlet_key",
        "invoice_id", "product_id", "distributor_id", "salesperson_id", "outlet_id",
        "sales_date",
        "quantity", "unit_price", "discount_pct", "discount_amount", "gross_sales",
        "net_sales", "unit_cogs", "total_cogs",
        (F.col("net_sales") - F.col("total_cogs")).alias("gross_profit"),
        gross_margin(exact_margin).alias("gross_margin_pct"),
        "record_source", "source_record_id", "source_file", "source_event_timestamp",
        "ingested_at",
    )


def fact_inventory(staged: DataFrame, date: DataFrame,
                   dims: dict[str, DataFrame]) -> DataFrame:
    """dims: distributor, product."""
    balance = F.col("opening_stock") + F.col("stock_received") - F.col("units_sold")
    key = surrogate_key("inventory", F.col("month_start"), F.col("distributor_id"),
                        F.col("product_id"))
    return _lookups(staged, date, "month_start", dims).select(
        key.alias("inventory_key"),
        "date_key", "distributor_key", "product_key",
        "month_start", "distributor_id", "product_id",
        "opening_stock", "stock_received", "units_sold", "closing_stock", "stock_value",
        balance.alias("calculated_closing_stock"),
        *_LINEAGE,
    )


def fact_sales_target(staged: DataFrame, date: DataFrame,
                      dims: dict[str, DataFrame]) -> DataFrame:
    """dims: salesperson."""
    key = surrogate_key("sales_target", F.col("month_start"), F.col("salesperson_id"))
    return _lookups(staged, date, "month_start", dims).select(
        key.alias("sales_target_key"),
        "date_key", "salesperson_key",
        "month_start", "salesperson_id",
        "target_sales", "target_active_outlets",
        *_LINEAGE,
    )
