"""Profiles of the source files and entities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile_files(fingerprints: DataFrame, counts: DataFrame) -> DataFrame:
    """Per file: rows, size in MB, columns, and whether the header equals the first file's.

    `fingerprints` comes from sources.files.fingerprint, `counts` has (source_name, rows).
    The header of the first file is compared in order.
    """
    first_header = fingerprints.agg(F.min_by("header", "source_name")).scalar()
    return fingerprints.join(counts, "source_name", "left").select(
        "source_name",
        F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"),
        F.round(F.col("size_bytes") / (1024 * 1024), 2).alias("size_mb"),
        F.size("header").alias("column_count"),
        (F.col("header") == first_header).alias("same_schema"),
        "header",
    )


# Fixed value: sheets that describe the others.
DOCUMENTATION = {"README"}


def profile_entities(tables: dict[str, DataFrame]) -> DataFrame:
    """The profiles of all entities by sheet name; documentation sheets are left out."""
    chosen = {n: df for n, df in tables.items() if n.strip().upper() not in DOCUMENTATION}
    return reduce(DataFrame.unionByName, [profile_entity(df, n) for n, df in chosen.items()])


def profile_entity(df: DataFrame, name: str) -> DataFrame:
    """Rows, columns and field names of an entity without its empty rows and columns."""
    filled = df.na.drop(how="all")
    counted = filled.agg(F.count(F.lit(1)).alias("rows"),
                         *[F.count(F.col(f"`{c}`")).alias(f"n{i}")
                           for i, c in enumerate(df.columns)])
    fields = F.array_compact(F.array(*[
        F.when(F.col(f"n{i}") > 0, F.lit(c)) for i, c in enumerate(df.columns)]))
    return counted.select(
        F.lit(name).alias("entity"), "rows",
        F.size(fields).alias("column_count"),
        F.array_join(fields, ", ").alias("fields"))
