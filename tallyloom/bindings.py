"""The given test tables in the shape of the mart's inputs.

Every binding is a lazy DataFrame over the whole given tables; nothing is invented that
does not derive from their rows. Returned lines (l_returnflag = 'R') play the part of
sales that a stream event corrects later.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .functions.columns import iso_text
from .schemas import EVENT_TYPE, MASTER_PIPELINE, SALES_PIPELINE, TRANSACTION_FIELDS
from .session import work_dir
from .streaming.contract import POSITION, split, to_raw_events, validate, without_message
from .streaming.sink import ROW, first_arrivals

TOPIC = "sales.events"
BOOK = "MasterData"


class Tables:
    """The parquet tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _id(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), _text(column))


def _money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def _line() -> Column:
    """An exact number of each line: lines of an order are counted, 1000 at most."""
    per_order = W.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return F.col("l_orderkey") * 1000 + F.row_number().over(per_order)


def _lineage(record_id: Column, file: Column | str, row: Column, run: Column | int,
             at: Column, sheet: str | None = None) -> list[Column]:
    lit = lambda v: F.lit(v) if not isinstance(v, Column) else v
    return [
        record_id.cast("bigint").alias("raw_record_id"),
        lit(file).alias("source_file"),
        *([F.lit(sheet).alias("source_sheet")] if sheet else []),
        row.cast("bigint").alias("source_row_number"),
        lit(run).cast("bigint").alias("pipeline_run_id"),
        at.cast("timestamp").alias("ingested_at"),
    ]


_MASTER_TIME = "2024-01-01 00:00:00"


def _master_lineage(sheet: str, run: int, record_id: Column, row: Column) -> list[Column]:
    return _lineage(record_id, f"{BOOK}.csv", row, run, F.lit(_MASTER_TIME), sheet)


def _buyers(t: Tables) -> DataFrame:
    """Orders with their customer."""
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")


def _sales_lines(t: Tables, parts: int | None = None) -> DataFrame:
    """Line items with their order, customer and product; amounts still typed. Orders meet
    their customers first, so that lines travel once by order and once by product. With `parts`
    they are dealt to so many partitions, before texts are made of them."""
    gross, price = _money("l_extendedprice"), _money("p_retailprice")
    pct = F.col("l_discount").cast("decimal(10,6)")
    lines = (
        t.lineitem.withColumn("line", _line())
        .join(_buyers(t), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left")
    )
    if parts:
        lines = lines.repartition(parts, F.col("line") * 2)
    lines = (
        lines.withColumn("quantity", F.col("l_quantity").cast("int"))
        .withColumn("unit_price", price)
        .withColumn("discount_pct", pct)
        .withColumn("gross_sales", gross)
        .withColumn("discount_amount", (gross * pct).cast("decimal(18,2)"))
        .withColumn("unit_cogs", _money(price * F.lit(0.6).cast("decimal(2,1)")))
    )
    return (
        lines.withColumn("net_sales", _money(F.col("gross_sales") - F.col("discount_amount")))
        .withColumn("total_cogs", _money(F.col("quantity") * F.col("unit_cogs")))
        .withColumn("date", _text(F.col("o_orderdate").cast("date")))
        .withColumn("distributor_id", _id("DST", "l_suppkey"))
        .withColumn("salesperson_id", _id("SP", "c_nationkey"))
        .withColumn("outlet_id", _id("OUT", "o_custkey"))
        .withColumn("product_id", _id("P", "l_partkey"))
        .withColumn("invoice_id", _id("INV", "l_orderkey"))
    )


def sales(t: Tables) -> DataFrame:
    """RAW sales: one text row per line item, filed by quarter of the order."""
    year, quarter = F.year("o_orderdate"), F.quarter("o_orderdate")
    file = F.concat(F.lit("FactSales_"), _text(year), F.lit("_Q"), _text(quarter), F.lit(".csv"))
    return _sales_lines(t).select(
        *[_text(c).alias(c) for c in TRANSACTION_FIELDS],
        *_lineage(F.col("line"), file, F.col("l_linenumber") + 1, year * 10 + quarter,
                  F.col("l_shipdate")),
    )


def product(t: Tables) -> DataFrame:
    price = _money("p_retailprice")
    return t.part.select(
        _id("P", "p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.concat(F.lit("  "), "p_name").alias("product_name"),
        F.lit(" ").alias("variant"),
        F.concat(_text("p_size"), F.lit(" PCS")).alias("pack_size"),
        _text(price).alias("unit_price"),
        _text(_money(price * F.lit(0.6).cast("decimal(2,1)"))).alias("unit_cogs"),
        *_master_lineage("DimProduct", 1, F.col("p_partkey"), F.col("p_partkey") + 2),
    )


def _places(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")


def distributor(t: Tables) -> DataFrame:
    rows = t.supplier.join(_places(t), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return rows.select(
        _id("DST", "s_suppkey").alias("distributor_id"),
        F.col("s_name").alias("distributor_name"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("province"),
        _id("City ", "s_nationkey").alias("city"),
        F.when(F.col("s_acctbal") < 0, " ").otherwise(" Main ").alias("distributor_type"),
        F.concat(_text(F.lit(1990) + F.col("s_nationkey")), F.lit(".5")).alias("start_year"),
        *_master_lineage("DimDistributor", 2, F.col("s_suppkey"), F.col("s_suppkey") + 2),
    )


def salesperson(t: Tables) -> DataFrame:
    return _places(t).select(
        _id("SP", "n_nationkey").alias("salesperson_id"),
        F.concat(F.lit(" "), "n_name", F.lit(" ")).alias("salesperson_name"),
        F.col("r_name").alias("supervisor"),
        _id("DST", "n_nationkey").alias("distributor_id"),
        F.col("n_name").alias("territory"),
        F.concat(_text(F.lit(2000) + F.col("n_nationkey")), F.lit(".0")).alias("join_year"),
        *_master_lineage("DimSalesperson", 3, F.col("n_nationkey"), F.col("n_nationkey") + 2),
    )


def outlet(t: Tables) -> DataFrame:
    rows = t.customer.join(_places(t), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.select(
        _id("OUT", "c_custkey").alias("outlet_id"),
        F.col("c_name").alias("outlet_name"),
        F.col("c_mktsegment").alias("channel"),
        F.when(F.col("c_acctbal") > 5000, "A").otherwise("B").alias("outlet_tier"),
        _id("DST", "c_nationkey").alias("distributor_id"),
        _id("SP", "c_nationkey").alias("salesperson_id"),
        _id("City ", "c_nationkey").alias("city"),
        F.col("n_name").alias("province"),
        F.col("r_name").alias("region"),
        F.concat(_text(F.lit(2000) + F.col("c_nationkey")), F.lit(".4")).alias("open_year"),
        *_master_lineage("DimOutlet", 4, F.col("c_custkey"), F.col("c_custkey") + 2),
    )


def _month_text(day: str) -> Column:
    return F.date_format(F.trunc(F.col(day), "MM"), "yyyy-MM-dd'T'00:00:00")


def target(t: Tables) -> DataFrame:
    """RAW targets: month of order x salesperson."""
    lines = (
        t.lineitem.select("l_orderkey", "l_extendedprice")
        .join(_buyers(t), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    )
    rows = lines.groupBy(
        F.trunc("o_orderdate", "MM").alias("month"), "c_nationkey"
    ).agg(
        F.sum(_money("l_extendedprice")).cast("decimal(18,2)").alias("amount"),
        F.countDistinct("o_custkey").alias("outlets"),
    )
    record = F.year("month") * 10000 + F.month("month") * 100 + F.col("c_nationkey")
    return rows.select(
        _month_text("month").alias("month_start"),
        _id("SP", "c_nationkey").alias("salesperson_id"),
        _text("amount").alias("target_sales"),
        F.concat(_text("outlets"), F.lit(".0")).alias("target_active_outlets"),
        *_master_lineage("FactTarget", 5, record, record + 2),
    )


def inventory(t: Tables) -> DataFrame:
    """RAW stock: month of shipping x supplier x part. The closing stock leaves returned
    lines out, so months with returns do not balance."""
    rows = t.lineitem.groupBy(
        F.trunc("l_shipdate", "MM").alias("month"), "l_suppkey", "l_partkey"
    ).agg(
        F.sum(F.col("l_quantity").cast("int")).alias("sold"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("int"))
              .otherwise(0)).alias("returned"),
    )
    opening = F.lit(100) + (F.col("l_suppkey") * 7 + F.col("l_partkey")) % 50
    received = F.lit(20) + (F.col("l_suppkey") + F.col("l_partkey") * 3) % 40
    closing = opening + received - F.col("sold") + F.col("returned")
    months = (F.year("month") * 12 + F.month("month")).cast("bigint")
    # exact up to ten million suppliers and parts
    record = (months * 10_000_000 + F.col("l_suppkey")) * 10_000_000 + F.col("l_partkey")

    def stock(c: Column) -> Column:
        return F.concat(_text(c), F.lit(".0"))

    return rows.select(
        _month_text("month").alias("month_start"),
        _id("DST", "l_suppkey").alias("distributor_id"),
        _id("P", "l_partkey").alias("product_id"),
        stock(opening).alias("opening_stock"),
        stock(received).alias("stock_received"),
        stock(F.col("sold")).alias("units_sold"),
        stock(closing).alias("closing_stock"),
        _text((closing * F.lit(12.5).cast("decimal(3,1)")).cast("decimal(18,2)"))
        .alias("stock_value"),
        *_master_lineage("FactInventory", 6, record, F.lit(2)),
    )


def _message(event: Column, at: Column, copy: Column | int = 0, places: int = 2) -> list[Column]:
    """A message's position is exact: some places for each line, those behind for copies."""
    copy = copy if isinstance(copy, Column) else F.lit(copy)
    return [
        F.col("invoice_id").cast("binary").alias("key"),
        event.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("l_orderkey") % 8).cast("int").alias("partition"),
        (F.col("line") * places + copy).alias("offset"),
        at.cast("timestamp").alias("timestamp"),
    ]


def _event_json(fields: dict[str, Column], event_type: Column, transaction: Column) -> Column:
    return F.to_json(F.struct(
        F.concat(F.lit("E"), _text("l_orderkey"), F.lit("-"), _text("l_partkey"))
        .alias("event_id"),
        event_type.alias("event_type"),
        F.concat(iso_text(F.col("l_shipdate")), F.lit("+00:00")).alias("event_timestamp"),
        F.lit("till").alias("source"),
        F.lit("corrections.csv").alias("source_file"),
        transaction.alias("transaction"),
    ))


def correction_messages(t: Tables, finished: bool | None = None) -> DataFrame:
    """One message per returned line: the sale again, with one unit more. Every second line
    number is sent twice, the copy behind with yet another unit: a third of all messages are
    copies that differ. `finished` takes only those of lines that are (not) open, so that they
    can arrive one after the other."""
    lines = _sales_lines(t).filter("l_returnflag = 'R'")
    if finished is not None:
        is_open = F.coalesce(F.col("l_linestatus") == "O", F.lit(False))
        lines = lines.filter(~is_open if finished else is_open)
    copies = F.when(F.col("l_linenumber") % 2 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))
    lines = lines.withColumn("copy", F.explode(copies))
    fields = {c: _text(c) for c in TRANSACTION_FIELDS}
    fields["quantity"] = _text(F.col("quantity") + 1 + F.col("copy"))
    transaction = F.struct(*[v.alias(k) for k, v in fields.items()])
    event = _event_json(fields, F.lit(EVENT_TYPE), transaction)
    return lines.select(*_message(event, F.col("l_shipdate"), F.col("copy")))


#: Days of five batches; copies may come within one day of their first event.
HORIZON, HORIZON_DAYS = "1 day", [0, 0, 10, 20, 30]


def horizon_messages(t: Tables, batch: int) -> DataFrame:
    """All lines; returned ones again within the horizon; two batches of other lines that move
    time on; returned ones once more, beyond the horizon."""
    flag = [None, "R", "A", "N", "R"][batch]
    lines = _sales_lines(t)
    if flag:
        lines = lines.filter(F.col("l_returnflag") == flag)
    at = F.timestamp_seconds(F.lit(1_704_067_200 + HORIZON_DAYS[batch] * 86_400 + 60 * batch))
    transaction = F.struct(*[_text(c).alias(c) for c in TRANSACTION_FIELDS])
    event = F.to_json(F.struct(
        F.concat_ws("-", F.lit("M" if batch in (2, 3) else "L"), _text("line")).alias("event_id"),
        F.lit(EVENT_TYPE).alias("event_type"),
        F.concat(iso_text(at), F.lit("+00:00")).alias("event_timestamp"),
        F.lit("till").alias("source"), transaction.alias("transaction")))
    return lines.select(*_message(event, at, batch, len(HORIZON_DAYS)))


REVISIONS = 3


def revision_messages(t: Tables, revision: int) -> DataFrame:
    """Every line again, changed once more in each revision (the last one has returned lines
    only). Of a line's revisions any may be the newest: its time goes by line number, so that
    many arrive late."""
    lines = _sales_lines(t)
    if revision == REVISIONS - 1:
        lines = lines.filter("l_returnflag = 'R'")
    days = ((F.col("l_linenumber") + 2 * revision) % REVISIONS).cast("int")
    at = F.date_add(F.col("l_shipdate").cast("date"), days).cast("timestamp")
    fields = {c: _text(c) for c in TRANSACTION_FIELDS}
    fields["quantity"] = _text(F.col("quantity") + 1 + revision)
    event = F.to_json(F.struct(
        F.concat_ws("-", F.lit("V"), _text("line"), F.lit(str(revision))).alias("event_id"),
        F.lit(EVENT_TYPE).alias("event_type"),
        F.concat(iso_text(at), F.lit("+00:00")).alias("event_timestamp"),
        F.lit("till").alias("source"),
        F.lit("revisions.csv").alias("source_file"),
        F.struct(*[v.alias(k) for k, v in fields.items()]).alias("transaction"),
    ))
    return lines.select(*_message(event, at, revision, REVISIONS))


def defective_messages(t: Tables, parts: int | None = None) -> DataFrame:
    """One message per line; its line number and return flag decide what is wrong with it. With
    `parts` they lie in so many partitions, by their offset."""
    lines = _sales_lines(t, parts).withColumn(
        "defect", F.concat(_text("l_linenumber"), F.col("l_returnflag")))

    def when(defect: str, bad, good: Column) -> Column:
        return F.when(F.col("defect") == defect, bad).otherwise(good)

    fields = {c: _text(c) for c in TRANSACTION_FIELDS}
    fields["quantity"] = (
        F.when(F.col("defect") == "3R", "ABC").when(F.col("defect") == "3A", "0")
        .when(F.col("defect") == "5A", "0.5").when(F.col("defect") == "5N", "2.5")
        .when(F.col("defect") == "7A", "NaN").otherwise(fields["quantity"]))
    fields["net_sales"] = when("3N", F.lit("-100"), fields["net_sales"])
    fields["unit_price"] = when("7N", F.lit("1e3"), fields["unit_price"])
    fields["discount_pct"] = when("2A", F.lit("1d"), fields["discount_pct"])
    fields["invoice_id"] = when("4R", F.lit(None), fields["invoice_id"])
    fields["outlet_id"] = when("4R", F.lit(""), fields["outlet_id"])
    fields["product_id"] = when("7R", F.lit(" "), fields["product_id"])  # passes
    tx = F.struct(*[v.alias(k) for k, v in fields.items()])
    kind = when("5R", F.lit("inventory_transaction"), F.lit(EVENT_TYPE))
    as_object = _event_json(fields, kind, tx)
    as_text = _event_json(fields, kind, F.lit("invalid"))
    absent = _event_json(fields, kind, F.lit(None).cast("string"))
    event = (
        F.when(F.col("defect") == "4A", as_text)
        .when(F.col("defect") == "4N", absent)
        .when(F.col("defect") == "6R", F.lit("{bad"))
        .when(F.col("defect") == "6A", F.lit("[]"))
        .when(F.col("defect") == "6N", F.lit(None).cast("string"))
        .otherwise(as_object))
    return lines.select(*_message(event, F.col("l_shipdate")))


def envelope_messages(t: Tables) -> DataFrame:
    """The events table as messages: purchases are sales, other types are not supported."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.when(F.col("event_type") == "purchase", EVENT_TYPE).otherwise(F.col("event_type"))
    amount = F.col("value").cast("decimal(18,2)")
    tx = F.struct(
        _text(F.col("ts").cast("date")).alias("date"),
        _id("DST", "user_id").alias("distributor_id"),
        _id("SP", "user_id").alias("salesperson_id"),
        _id("OUT", "user_id").alias("outlet_id"),
        _id("P", "event_id").alias("product_id"),
        _id("INV", "event_id").alias("invoice_id"),
        k.alias("quantity"),
        amount.alias("unit_price"),
        F.lit(0).alias("discount_pct"),
        F.lit(0).alias("discount_amount"),
        amount.alias("gross_sales"),
        (amount - 5).alias("net_sales"),
        amount.alias("unit_cogs"),
        amount.alias("total_cogs"),
    )
    event = F.to_json(F.struct(
        _id("EV", "event_id").alias("event_id"), kind.alias("event_type"),
        F.concat(iso_text(F.col("ts")), F.lit("+00:00")).alias("event_timestamp"),
        F.lit("web").alias("source"), tx.alias("transaction")))
    return t.events.select(
        _text("user_id").cast("binary").alias("key"),
        event.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def sales_events(t: Tables) -> DataFrame:
    """RAW events: the corrections after contract and duplicate removal. As in the sink, checked
    events are written once, ids and positions alone are ranked, and whole events move once."""
    valid, _ = split(validate(correction_messages(t)))
    folder = work_dir(t.spark, "checked-events")
    checked = without_message(valid).withColumn(ROW, F.monotonically_increasing_id())
    checked.write.parquet(folder)
    checked = t.spark.read.schema(checked.schema).parquet(folder)
    won = first_arrivals(checked.select(ROW, "event_id", *POSITION))
    stored = to_raw_events(checked.join(won.select(ROW), ROW, "left_semi"))
    return stored.withColumn("ingested_at", F.col("event_timestamp"))


def sources(t: Tables) -> dict[str, Callable[[], DataFrame]]:
    """Every RAW input of the model graph, built when it is asked for."""
    inputs = (sales, product, distributor, salesperson, outlet, target, inventory,
              sales_events)
    return {bind.__name__: partial(bind, t) for bind in inputs}


# ---------------------------------------------------------------- ledger bindings

def run_log(t: Tables) -> DataFrame:
    """Each order is a load run of its customer's file: F finished, P failed, O running."""
    o = t.orders
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    ended = F.col("o_orderstatus") != "O"
    base = dict(
        run_id=F.col("o_orderkey"),
        pipeline_name=F.when(urgent, MASTER_PIPELINE).otherwise(SALES_PIPELINE),
        source_name=F.concat(F.lit("FactSales_"), _text("o_custkey"), F.lit(".csv")),
    )
    unhashed = F.col("o_orderpriority") == "4-NOT SPECIFIED"
    started = {
        **base,
        "source_hash": F.when(~unhashed, F.md5(F.concat_ws(
            "|", _text("o_custkey"), _text(F.year("o_orderdate"))))),
        "source_size_bytes": F.when(~unhashed, F.col("o_custkey") + 1000),
        "source_modified_at": F.when(~unhashed, F.col("o_orderdate").cast("timestamp")),
        "started_at": F.col("o_orderdate").cast("timestamp"),
        "finished_at": F.lit(None).cast("timestamp"),
        "records_received": F.lit(0).cast("bigint"),
        "records_inserted": F.lit(0).cast("bigint"),
        "records_rejected": F.lit(0).cast("bigint"),
        "status": F.lit("RUNNING"),
        "error_message": F.lit(None).cast("string"),
        "step": F.lit(0),
        "logged_at": F.col("o_orderdate").cast("timestamp"),
    }
    rows = F.floor("o_totalprice").cast("bigint")
    done = F.col("o_orderstatus") == "F"
    no_time = F.col("o_orderpriority") == "5-LOW"
    later = (F.col("o_orderdate") + F.expr("interval 1 hour")).cast("timestamp")
    finished = {
        **{k: F.lit(None).cast(c) for k, c in (
            ("pipeline_name", "string"), ("source_name", "string"),
            ("source_hash", "string"), ("source_size_bytes", "bigint"),
            ("source_modified_at", "timestamp"), ("started_at", "timestamp"))},
        "run_id": F.col("o_orderkey"),
        "finished_at": F.when(~no_time, later),
        "records_received": F.when(done, rows),
        "records_inserted": F.when(done, rows),
        "records_rejected": F.when(done, F.lit(0).cast("bigint")),
        "status": F.when(done, "SUCCESS").otherwise("FAILED"),
        "error_message": F.when(~done, F.concat(F.lit("order "), _text("o_orderkey"))),
        "step": F.lit(1),
        "logged_at": later,
    }
    return o.select(*[c.alias(n) for n, c in started.items()]).unionByName(
        o.filter(ended).select(*[c.alias(n) for n, c in finished.items()]))


def state_log(t: Tables) -> DataFrame:
    """Every finished, hashed run became the active one of its source at the time."""
    o = t.orders.filter("o_orderstatus = 'F' and o_orderpriority != '4-NOT SPECIFIED'")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return o.select(
        F.when(urgent, MASTER_PIPELINE).otherwise(SALES_PIPELINE).alias("pipeline_name"),
        F.concat(F.lit("FactSales_"), _text("o_custkey"), F.lit(".csv")).alias("source_name"),
        F.col("o_orderkey").alias("active_run_id"),
        F.md5(F.concat_ws("|", _text("o_custkey"), _text(F.year("o_orderdate"))))
        .alias("active_source_hash"),
        F.col("o_orderdate").cast("timestamp").alias("last_observed_at"),
        F.col("o_orderkey").alias("seq"),
    )


def observed_files(t: Tables) -> DataFrame:
    """Each customer's file as found now; customers of one segment have lost theirs."""
    return t.customer.filter("c_mktsegment != 'BUILDING'").select(
        F.lit(SALES_PIPELINE).alias("pipeline_name"),
        F.concat(F.lit("FactSales_"), _text("c_custkey"), F.lit(".csv")).alias("source_name"),
        F.md5(F.concat_ws("|", _text("c_custkey"), F.lit("1998"))).alias("sha256"),
        (F.col("c_custkey") + 2000).alias("size_bytes"),
        F.lit("2024-01-01").cast("timestamp").alias("modified_at"),
    )


def run_sales(t: Tables) -> DataFrame:
    """RAW sales where every order was a load run of its own."""
    return _sales_lines(t).select(
        "invoice_id", "product_id", _text("gross_sales").alias("gross_sales"),
        F.col("l_linenumber").cast("bigint").alias("source_row_number"),
        F.col("l_orderkey").alias("pipeline_run_id"),
    )
