"""Declared data tests, run in few passes instead of one query per test.

Per model one aggregate counts NULLs of all tested columns, and one grouping of
(column, value) pairs answers all unique and relationship tests together. Values are counted
before anything is joined, so a value that fills a third of a table costs one row. Row counts
that were taken while models were written are not taken again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Which columns are tested, and against which parent.
UNIQUE = {
    "stg_sales": ["raw_record_id"],
    "stg_product": ["product_id"],
    "stg_distributor": ["distributor_id"],
    "stg_salesperson": ["salesperson_id"],
    "stg_outlet": ["outlet_id"],
    "stg_sales_streaming": ["event_id"],
    "dim_product": ["product_key", "product_id"],
    "dim_distributor": ["distributor_key", "distributor_id"],
    "dim_salesperson": ["salesperson_key", "salesperson_id"],
    "dim_outlet": ["outlet_key", "outlet_id"],
    "dim_date": ["date_key", "date_day"],
    "fact_sales": ["sales_key"],
}

NOT_NULL = {
    "stg_sales": ["raw_record_id", "sales_date", "invoice_id", "product_id",
                  "distributor_id", "salesperson_id", "outlet_id", "quantity", "net_sales"],
    "stg_product": ["product_id", "product_name"],
    "stg_distributor": ["distributor_id", "distributor_name"],
    "stg_salesperson": ["salesperson_id", "salesperson_name", "distributor_id"],
    "stg_outlet": ["outlet_id", "outlet_name", "distributor_id", "salesperson_id"],
    "stg_target": ["month_start", "salesperson_id", "target_sales"],
    "stg_inventory": ["month_start", "distributor_id", "product_id", "closing_stock"],
    "stg_sales_streaming": ["event_id", "invoice_id", "product_id", "sales_date",
                            "kafka_topic", "kafka_partition", "kafka_offset"],
    "stg_sales_unified": ["invoice_id", "product_id", "sales_date", "record_source"],
    "dim_product": ["product_key", "product_id"],
    "dim_distributor": ["distributor_key", "distributor_id"],
    "dim_salesperson": ["salesperson_key", "salesperson_id"],
    "dim_outlet": ["outlet_key", "outlet_id"],
    "dim_date": ["date_key", "date_day"],
    "fact_sales": ["sales_key", "date_key", "product_key", "distributor_key",
                   "salesperson_key", "outlet_key", "invoice_id", "quantity", "net_sales"],
}

# child -> {column: (parent, parent column)}
RELATIONSHIPS = {
    "stg_sales": {"product_id": ("stg_product", "product_id"),
                  "distributor_id": ("stg_distributor", "distributor_id"),
                  "salesperson_id": ("stg_salesperson", "salesperson_id"),
                  "outlet_id": ("stg_outlet", "outlet_id")},
    "stg_salesperson": {"distributor_id": ("stg_distributor", "distributor_id")},
    "stg_outlet": {"distributor_id": ("stg_distributor", "distributor_id"),
                   "salesperson_id": ("stg_salesperson", "salesperson_id")},
    "stg_target": {"salesperson_id": ("stg_salesperson", "salesperson_id")},
    "stg_inventory": {"distributor_id": ("stg_distributor", "distributor_id"),
                      "product_id": ("stg_product", "product_id")},
    "fact_sales": {"date_key": ("dim_date", "date_key"),
                   "product_key": ("dim_product", "product_key"),
                   "distributor_key": ("dim_distributor", "distributor_key"),
                   "salesperson_key": ("dim_salesperson", "salesperson_key"),
                   "outlet_key": ("dim_outlet", "outlet_key")},
}

GRAINS = {
    "stg_sales": ["invoice_id", "product_id"],
    "stg_sales_unified": ["invoice_id", "product_id"],
    "stg_inventory": ["month_start", "distributor_id", "product_id"],
}

SAME_COUNT = [("stg_sales_unified", "fact_sales"), ("stg_inventory", "fact_inventory"),
              ("stg_target", "fact_sales_target")]


def _unpivot(df: DataFrame, columns: list[str]) -> DataFrame:
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in columns])
    return df.select(F.inline(pairs))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) for non-NULL values, counted before the shuffle."""
    return (_unpivot(df, columns).filter(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))


def _all_columns(df: DataFrame, columns: list[str], test: str) -> DataFrame:
    """One row per listed column, also for those without findings."""
    names = F.explode(F.array(*[F.lit(c) for c in columns])).alias("column")
    listed = df.sparkSession.range(1).select(names)
    return (listed.join(df, "column", "left")
            .select(F.lit(test).alias("test"), "column",
                    F.coalesce("failures", F.lit(0).cast("bigint")).alias("failures")))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(test, column, failures): NULLs per column, one pass, no shuffle of rows."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("failures"))
                      for c in columns])
    return counted.select(F.inline(pairs)).select(
        F.lit("not_null").alias("test"), "column", "failures")


def unique_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(test, column, failures): how many values occur more than once."""
    repeated = value_counts(df, columns).filter("n > 1")
    found = repeated.groupBy("column").agg(F.count(F.lit(1)).alias("failures"))
    return _all_columns(found, columns, "unique")


def orphans(df: DataFrame, parents: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(test, column, failures): rows whose value has no parent row."""
    known = reduce(DataFrame.unionByName, [
        parent.select(F.lit(column).alias("column"),
                      F.col(parent_column).cast("string").alias("value"))
        for column, (parent, parent_column) in parents.items()])
    lost = value_counts(df, list(parents)).join(known, ["column", "value"], "left_anti")
    found = lost.groupBy("column").agg(F.sum("n").alias("failures"))
    return _all_columns(found, list(parents), "relationships")


def key_tests(df: DataFrame, unique: list[str],
              parents: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(test, column, failures) of unique_violations and orphans out of one grouping."""
    columns = list(dict.fromkeys([*unique, *parents]))
    counted = value_counts(df, columns)
    if parents:
        known = reduce(DataFrame.unionByName, [
            parent.select(F.lit(column).alias("column"),
                          F.col(parent_column).cast("string").alias("value"))
            for column, (parent, parent_column) in parents.items()]).distinct()
        counted = counted.join(known.withColumn("found", F.lit(True)), ["column", "value"], "left")
    else:
        counted = counted.withColumn("found", F.lit(None).cast("boolean"))
    found = counted.groupBy("column").agg(
        F.count_if(F.col("n") > 1).alias("unique"),
        F.sum(F.when(F.col("found").isNull(), F.col("n")).otherwise(0)).alias("relationships"))
    wanted = [("unique", c) for c in unique] + [("relationships", c) for c in parents]
    listed = df.sparkSession.createDataFrame(wanted, "test string, column string")
    failures = F.when(F.col("test") == "unique", F.col("unique")).otherwise(F.col("relationships"))
    return listed.join(found, "column", "left").select(
        "test", "column", F.coalesce(failures, F.lit(0)).alias("failures"))


def grain_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key groups with more than one row."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .filter("row_count > 1"))


def inventory_imbalance(fact_inventory: DataFrame) -> DataFrame:
    """Rows whose closing stock differs from the calculated one; unknown is no failure."""
    return fact_inventory.filter(
        F.col("closing_stock") != F.col("calculated_closing_stock")
    ).select("inventory_key", "opening_stock", "stock_received", "units_sold",
             "closing_stock", "calculated_closing_stock")


def count_mismatch(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row with both counts if they differ, none if they agree."""
    other = right.agg(F.count(F.lit(1))).scalar()
    counts = left.agg(F.count(F.lit(1)).alias("staging_rows"))
    return (counts.withColumn("warehouse_rows", other)
            .filter("staging_rows != warehouse_rows"))


def _failures(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("failures"))


def run_tests(ref, only: list[str] | None = None, rows: dict[str, int] | None = None,
              apart: bool = False) -> DataFrame:
    """Every declared test of the chosen models: (model, test, column, failures, status).

    `ref` looks a model up by name; `rows` holds row counts that are known. A test passes with
    zero failures. `apart` runs each group of tests at once, as a query of its own: what one
    shuffles is gone before the next one begins, and the driver holds a row per test.
    """
    rows = rows or {}

    def wanted(model: str) -> bool:
        return only is None or model in only

    def tagged(model: str, result: DataFrame) -> DataFrame:
        return result.select(F.lit(model).alias("model"), "test", "column", "failures")

    def single(model: str, test: str, failing: DataFrame) -> DataFrame:
        return tagged(model, _failures(failing).select(
            F.lit(test).alias("test"), F.lit(None).cast("string").alias("column"), "failures"))

    results = []
    for model, columns in NOT_NULL.items():
        if wanted(model):
            results.append(tagged(model, null_counts(ref(model), columns)))
    for model in dict.fromkeys([*UNIQUE, *RELATIONSHIPS]):
        if wanted(model):
            parents = {c: (ref(p), pc) for c, (p, pc) in RELATIONSHIPS.get(model, {}).items()}
            results.append(tagged(model, key_tests(ref(model), UNIQUE.get(model, []), parents)))
    for model, keys in GRAINS.items():
        if wanted(model):
            results.append(single(model, "grain", grain_violations(ref(model), keys)))
    for staged, fact in SAME_COUNT:
        if wanted(fact) and staged in rows and fact in rows:
            known = ref(fact).sparkSession.range(int(rows[staged] != rows[fact]))
            results.append(single(fact, "row_count", known))
        elif wanted(fact):
            results.append(single(fact, "row_count", count_mismatch(ref(staged), ref(fact))))
    if wanted("fact_inventory"):
        results.append(single("fact_inventory", "balance",
                              inventory_imbalance(ref("fact_inventory"))))
    status = F.when(F.col("failures") == 0, "pass").otherwise("fail")
    if apart and results:
        found = [row for result in results for row in result.collect()]
        return results[0].sparkSession.createDataFrame(
            found, "model string, test string, column string, failures bigint").withColumn(
            "status", status)
    return reduce(DataFrame.unionByName, results).withColumn("status", status)
