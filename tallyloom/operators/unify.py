"""One sales row per invoice and product out of batch and stream records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schemas import FEEDS

_FEED = FEEDS["sales"]
BUSINESS = [_FEED.renamed.get(c, c) for c in _FEED.raw_columns]
UNIFIED = BUSINESS + ["record_source", "source_record_id", "source_file",
                      "source_event_timestamp", "ingested_at"]
KEY = ["invoice_id", "product_id"]


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key group.

    Spark ranks inside every input partition before it shuffles (WindowGroupLimit), so
    at most one row per key leaves a task: a key that holds most of the rows stays cheap.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def _of_batch(batch: DataFrame) -> DataFrame:
    return batch.select(
        *BUSINESS,
        F.lit("batch").alias("record_source"),
        F.col("raw_record_id").cast("string").alias("source_record_id"),
        "source_file",
        F.lit(None).cast("timestamp").alias("source_event_timestamp"),
        "ingested_at",
    )


def of_events(streaming: DataFrame) -> DataFrame:
    """Staged events in the layout of unified sales, not ranked yet."""
    return streaming.select(
        *BUSINESS,
        F.lit("streaming").alias("record_source"),
        F.col("event_id").alias("source_record_id"),
        "source_file",
        F.col("event_timestamp").alias("source_event_timestamp"),
        "ingested_at",
    )


def newest(rows: DataFrame) -> DataFrame:
    """The row of each business key that wins over all others.

    Streaming beats batch; then the newest event, then the newest arrival. The record id
    closes ties so that reruns agree. NULL keys form one group. Winners of parts of the rows
    can be ranked again with the rest: the outcome is the same.
    """
    priority = F.when(F.col("record_source") == "streaming", 2).otherwise(1)
    order = [
        priority.desc(),
        F.col("source_event_timestamp").desc_nulls_last(),
        F.col("ingested_at").desc(),
        F.col("source_record_id").desc(),
    ]
    return first_by(rows, KEY, order).select(*UNIFIED)


def unify_sales(batch: DataFrame, streaming: DataFrame | None = None) -> DataFrame:
    """One row per invoice and product out of staged batch rows and staged events."""
    rows = _of_batch(batch)
    if streaming is not None:
        rows = rows.unionByName(of_events(streaming))
    return newest(rows)


def merge_events(unified: DataFrame, streaming: DataFrame) -> DataFrame:
    """Unified sales after more events: only their keys can have another winner."""
    return newest(unified.select(*UNIFIED).unionByName(of_events(streaming)))
