"""Declared layouts. Nothing is inferred from data.

Fixed values: the column names, entity names and file patterns below are the data
contract of the sources and must stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# (source column, RAW column, kind after staging)
# kinds: text | date | month | int (strict) | count (rounded int) | money | rate
SALES = [
    ("Date", "date", "date"),
    ("DistributorID", "distributor_id", "text"),
    ("SalespersonID", "salesperson_id", "text"),
    ("OutletID", "outlet_id", "text"),
    ("ProductID", "product_id", "text"),
    ("InvoiceID", "invoice_id", "text"),
    ("Quantity", "quantity", "int"),
    ("UnitPrice", "unit_price", "money"),
    ("DiscountPct", "discount_pct", "rate"),
    ("DiscountAmount", "discount_amount", "money"),
    ("GrossSales", "gross_sales", "money"),
    ("NetSales", "net_sales", "money"),
    ("UnitCOGS", "unit_cogs", "money"),
    ("TotalCOGS", "total_cogs", "money"),
]

PRODUCT = [
    ("ProductID", "product_id", "text"),
    ("Category", "category", "text"),
    ("Brand", "brand", "text"),
    ("ProductName", "product_name", "text"),
    ("Variant", "variant", "text"),
    ("PackSize", "pack_size", "text"),
    ("UnitPrice", "unit_price", "money"),
    ("UnitCOGS", "unit_cogs", "money"),
]

DISTRIBUTOR = [
    ("DistributorID", "distributor_id", "text"),
    ("DistributorName", "distributor_name", "text"),
    ("Region", "region", "text"),
    ("Province", "province", "text"),
    ("City", "city", "text"),
    ("DistributorType", "distributor_type", "text"),
    ("StartYear", "start_year", "count"),
]

SALESPERSON = [
    ("SalespersonID", "salesperson_id", "text"),
    ("SalespersonName", "salesperson_name", "text"),
    ("Supervisor", "supervisor", "text"),
    ("DistributorID", "distributor_id", "text"),
    ("Territory", "territory", "text"),
    ("JoinYear", "join_year", "count"),
]

OUTLET = [
    ("OutletID", "outlet_id", "text"),
    ("OutletName", "outlet_name", "text"),
    ("Channel", "channel", "text"),
    ("OutletTier", "outlet_tier", "text"),
    ("DistributorID", "distributor_id", "text"),
    ("SalespersonID", "salesperson_id", "text"),
    ("City", "city", "text"),
    ("Province", "province", "text"),
    ("Region", "region", "text"),
    ("OpenYear", "open_year", "count"),
]

TARGET = [
    ("MonthStart", "month_start", "month"),
    ("SalespersonID", "salesperson_id", "text"),
    ("TargetSales", "target_sales", "money"),
    ("TargetActiveOutlets", "target_active_outlets", "count"),
]

INVENTORY = [
    ("MonthStart", "month_start", "month"),
    ("DistributorID", "distributor_id", "text"),
    ("ProductID", "product_id", "text"),
    ("OpeningStock", "opening_stock", "count"),
    ("StockReceived", "stock_received", "count"),
    ("UnitsSold", "units_sold", "count"),
    ("ClosingStock", "closing_stock", "count"),
    ("StockValue", "stock_value", "money"),
]


@dataclass(frozen=True)
class Feed:
    """One RAW table: where its rows come from and what its columns mean."""

    table: str
    columns: list[tuple[str, str, str]]
    sheet: str | None = None  # entity name for master data, None for sales files
    renamed: dict[str, str] = field(default_factory=dict)  # staging name differs from RAW

    @property
    def source_columns(self) -> list[str]:
        return [c[0] for c in self.columns]

    @property
    def raw_columns(self) -> list[str]:
        return [c[1] for c in self.columns]

    @property
    def lineage(self) -> list[str]:
        sheet = ["source_sheet"] if self.sheet else []
        return ["raw_record_id", "source_file", *sheet,
                "source_row_number", "pipeline_run_id", "ingested_at"]


FEEDS = {
    "sales": Feed("sales", SALES, renamed={"date": "sales_date"}),
    "product": Feed("product", PRODUCT, "DimProduct"),
    "distributor": Feed("distributor", DISTRIBUTOR, "DimDistributor"),
    "salesperson": Feed("salesperson", SALESPERSON, "DimSalesperson"),
    "outlet": Feed("outlet", OUTLET, "DimOutlet"),
    "target": Feed("target", TARGET, "FactTarget"),
    "inventory": Feed("inventory", INVENTORY, "FactInventory"),
}

ENTITIES = {f.sheet: f for f in FEEDS.values() if f.sheet}

SALES_FILE_PATTERN = "FactSales_*.csv"
SALES_PIPELINE = "fact_sales_ingestion"
MASTER_PIPELINE = "master_data_ingestion"

# Event contract (fixed values)
EVENT_TYPE = "sales_transaction"
EVENT_FIELDS = ["event_id", "event_type", "event_timestamp", "transaction"]
TRANSACTION_FIELDS = [c[1] for c in SALES]
NUMERIC_FIELDS = [c[1] for c in SALES if c[2] in ("int", "money", "rate")]
NON_NEGATIVE_FIELDS = ["gross_sales", "net_sales", "total_cogs"]

# Longest text each event column may hold
EVENT_LENGTHS = {"event_id": 36, "source": 100, "source_file": 255}

# What a message source delivers, whatever its kind
MESSAGE_SCHEMA = (
    "key binary, value binary, topic string, partition int, "
    "offset bigint, timestamp timestamp"
)

RUN_LOG_SCHEMA = (
    "run_id bigint, pipeline_name string, source_name string, source_hash string, "
    "source_size_bytes bigint, source_modified_at timestamp, started_at timestamp, "
    "finished_at timestamp, records_received bigint, records_inserted bigint, "
    "records_rejected bigint, status string, error_message string, "
    "step int, logged_at timestamp"
)

STATE_LOG_SCHEMA = (
    "pipeline_name string, source_name string, active_run_id bigint, "
    "active_source_hash string, last_observed_at timestamp, seq bigint"
)
