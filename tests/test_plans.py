"""The physical plans the mart relies on at scale."""

from conftest import SF
from tallyloom import bindings as b
from tallyloom.operators.facts import lookup
from tallyloom.operators.versioning import current_raw
from tallyloom.queries import all_queries, models


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df)


def test_registered_queries_have_no_cross_joins(spark):
    for name in ("fact_sales", "fact_inventory", "latest_versions", "orphans", "run_tests"):
        text = plan(all_queries()[name](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_unified_sales_ranks_before_the_shuffle(spark):
    text = plan(models(spark, SF).ref("stg_sales_unified"))
    partial = text.index("WindowGroupLimit [invoice_id")
    assert "Partial" in text[partial:partial + 400] or "Partial" in text
    assert text.count("WindowGroupLimit") >= 2


def test_scans_read_only_what_is_needed(spark):
    text = plan(models(spark, SF).ref("stg_product").select("product_id"))
    assert "ReadSchema: struct<p_partkey:bigint>" in text
    text = plan(models(spark, SF).ref("stg_sales").select("invoice_id"))
    assert text.count("FileScan") == 1 or "l_extendedprice" not in text


def test_only_active_versions_are_read(spark, lake):
    rows = spark.range(30).selectExpr("id", "id % 3 AS pipeline_run_id")
    lake.write_partitions(rows, "raw", "t", "pipeline_run_id")
    spark.sql("SELECT 'p' pipeline_name, 's' source_name, 2L active_run_id").write.parquet(
        lake.path("metadata", "state"))
    state = spark.read.parquet(lake.path("metadata", "state"))
    current = current_raw(lake.read("raw", "t"), state, "p")
    assert "dynamicpruning" in plan(current)
    assert {r["pipeline_run_id"] for r in current.collect()} == {2}


def test_a_hot_dimension_key_is_split(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.shuffle.partitions", "8")
    fact = spark.range(0, 60000, 1, 8).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 5000) END AS outlet_id")
    dim = spark.range(5000).selectExpr("concat('k', id) AS outlet_id", "md5('' || id) AS outlet_key")
    joined = lookup(fact, dim, "outlet_id", "outlet_id", "outlet_key")
    text = final_plan(joined)
    assert "isSkew" in text or "skewed" in text
    assert joined.count() == 60000


def test_positions_of_messages_are_unique(spark):
    """At the size that the bench runs on: an exact number for each line and copy."""
    t = b.Tables(spark, SF.replace("0.001", "0.1"))
    for messages in (b.correction_messages(t), b.defective_messages(t)):
        positions = messages.select("topic", "partition", "offset")
        assert positions.count() == positions.distinct().count()
    lines = t.lineitem.groupBy("l_orderkey").count().agg({"count": "max"}).first()[0]
    assert lines < 1000
    records = b.inventory(t).select("raw_record_id")
    assert records.count() == records.distinct().count()
