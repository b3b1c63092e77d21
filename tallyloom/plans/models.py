"""The model graph: which table is built from which, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators.dimensions import dim_date, dimension
from ..operators.facts import fact_inventory, fact_sales, fact_sales_target
from ..operators.staging import stage, stage_events
from ..operators.unify import unify_sales

STAGING = ["stg_sales", "stg_product", "stg_distributor", "stg_salesperson",
           "stg_outlet", "stg_target", "stg_inventory", "stg_sales_streaming",
           "stg_sales_unified"]
MARTS = ["dim_date", "dim_product", "dim_distributor", "dim_salesperson", "dim_outlet",
         "fact_sales", "fact_inventory", "fact_sales_target"]


#: What each model reads besides RAW tables.
NEEDS = {
    "stg_sales_unified": ["stg_sales", "stg_sales_streaming"],
    "dim_date": ["stg_sales", "stg_target", "stg_inventory"],
    **{f"dim_{n}": [f"stg_{n}"] for n in ("product", "distributor", "salesperson", "outlet")},
    "fact_sales": ["stg_sales_unified", "dim_date", "dim_product", "dim_distributor",
                   "dim_salesperson", "dim_outlet"],
    "fact_inventory": ["stg_inventory", "dim_date", "dim_distributor", "dim_product"],
    "fact_sales_target": ["stg_target", "dim_date", "dim_salesperson"],
}

#: The RAW table of each staged one.
RAW = {"stg_sales_streaming": "sales_events", **{f"stg_{t}": t for t in (
    "sales", "product", "distributor", "salesperson", "outlet", "target", "inventory")}}

#: Models that lie in hash buckets of their key, so that a sync can replace single ones.
BUCKETED = {"stg_sales_unified": ["invoice_id", "product_id"],
            "fact_sales": ["invoice_id", "product_id"]}


#: Staged facts: wide, and read by several models.
KEPT = ["stg_sales", "stg_sales_streaming", "stg_sales_unified", "stg_inventory", "stg_target"]

#: These take longest and others wait for them, so they begin first.
LONG = ["stg_sales_streaming", "stg_sales", "stg_inventory", "stg_target"]


def ready(left: list[str], done: set[str],
          bounds: list[tuple[str, str]] | None = None) -> list[str]:
    """Which of the models that are left can be built, long ones first."""
    needs = {**NEEDS, "dim_date": NEEDS["dim_date"] + [m for m, _ in bounds or []]}
    able = [m for m in left if done.issuperset(needs.get(m, []))]
    return sorted(able, key=lambda m: LONG.index(m) if m in LONG else len(LONG))


class Models:
    """Named lookup of RAW tables (`source`) and models (`ref`), built on first use.

    `sources` maps a RAW name to a DataFrame, or to a function that makes it. `given` holds
    models that exist already (marts read back from disk), so that a subset can be built on
    top of them.
    `bounds` are extra (model, column) pairs for the calendar; by default it spans
    batch sales, targets and inventory only, and stream dates outside get a NULL key.
    `keep` writes a staged model of facts that other models read and returns what it has written,
    so that they do not compute it again and its shuffles are gone before they begin.
    """

    def __init__(self, sources: dict[str, DataFrame | Callable[[], DataFrame]],
                 given: dict[str, DataFrame] | None = None,
                 bounds: list[tuple[str, str]] | None = None,
                 exact_margin: bool = True, rows: dict[str, int] | None = None,
                 keep: Callable[[DataFrame, str], DataFrame] | None = None):
        #: rows of RAW tables and models, where they were counted while writing
        self.rows = dict(rows or {})
        self._sources = dict(sources)
        self._built = dict(given or {})
        self._bounds = [("stg_sales", "sales_date"), ("stg_target", "month_start"),
                        ("stg_inventory", "month_start"), *(bounds or [])]
        self._exact_margin = exact_margin
        self._keep = keep

    def source(self, name: str) -> DataFrame:
        table = self._sources[name]
        if not isinstance(table, DataFrame):
            table = self._sources[name] = table()
        return table

    def ref(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders()[name]()
        return self._built[name]

    def _input(self, name: str) -> DataFrame:
        """A model that another one reads."""
        if self._keep and name in KEPT and name not in self._built:
            self._built[name] = self._keep(self.ref(name), name)
        return self.ref(name)

    def _dims(self, *names: str) -> dict[str, DataFrame]:
        return {n: self.ref(f"dim_{n}") for n in names}

    def _builders(self) -> dict[str, Callable[[], DataFrame]]:
        def staged(table: str):
            return lambda: stage(self.source(table), table)

        def dim(name: str):
            return lambda: dimension(self.ref(f"stg_{name}"), name)

        return {
            **{f"stg_{t}": staged(t) for t in (
                "sales", "product", "distributor", "salesperson", "outlet", "target",
                "inventory")},
            "stg_sales_streaming": lambda: stage_events(self.source("sales_events")),
            "stg_sales_unified": lambda: unify_sales(
                self._input("stg_sales"), self._input("stg_sales_streaming")),
            "dim_date": lambda: dim_date([(self._input(m), c) for m, c in self._bounds]),
            **{f"dim_{n}": dim(n) for n in (
                "product", "distributor", "salesperson", "outlet")},
            "fact_sales": lambda: fact_sales(
                self._input("stg_sales_unified"), self.ref("dim_date"),
                self._dims("product", "distributor", "salesperson", "outlet"),
                self._exact_margin),
            "fact_inventory": lambda: fact_inventory(
                self._input("stg_inventory"), self.ref("dim_date"),
                self._dims("distributor", "product")),
            "fact_sales_target": lambda: fact_sales_target(
                self._input("stg_target"), self.ref("dim_date"), self._dims("salesperson")),
        }
