"""Column helpers shared by the staging and mart models. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean(c: Column) -> Column:
    """Trim spaces (not tabs); blank becomes NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def to_type(c: Column, kind: str, tolerant: bool = False) -> Column:
    """Text to the declared kind. Strict casts fail the query; tolerant ones give NULL."""

    def cast(col: Column, dtype: str) -> Column:
        return col.try_cast(dtype) if tolerant else col.cast(dtype)

    if kind == "text":
        return c
    if kind == "int":  # whole numbers only, '2.7' is an error
        return cast(c, "int")
    if kind == "count":  # any number, rounded half away from zero
        return cast(F.round(cast(c, "decimal(38,10)"), 0), "int")
    if kind == "money":
        return cast(c, "decimal(18,2)")
    if kind == "rate":
        return cast(c, "decimal(10,6)")
    if kind == "date":
        return cast(c, "date")
    if kind == "month":  # accepts a time part, drops it
        return cast(cast(c, "timestamp_ntz"), "date")
    raise ValueError(f"unknown kind: {kind}")


def surrogate_key(prefix: str, *parts: Column) -> Column:
    """md5 over prefix|part|part…; NULL when any part is NULL."""
    pieces = [F.lit(prefix)]
    for part in parts:
        pieces += [F.lit("|"), part.cast("string")]
    return F.md5(F.concat(*pieces))


def iso_text(c: Column) -> Column:
    """Timestamp as ISO text, with a fraction only where there is one."""
    return F.regexp_replace(
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.000000$", ""
    )


def as_uuid(hex32: Column) -> Column:
    """32 hex digits in the 8-4-4-4-12 layout."""
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(hex32, at, n) for at, n in cuts])


def utf8_text(c: Column) -> Column:
    """Bytes to text; broken sequences become U+FFFD, NULL stays NULL."""
    return F.make_valid_utf8(c.cast("string"))


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns that later filters and columns use many times.

    A plain projection would be copied into every expression and pushed-down filter that
    refers to it; the one-row inline() keeps it a single evaluation per row.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(row)))
