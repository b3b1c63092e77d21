"""A one-row-per-table data set, written as source files."""

import csv

SALES_HEADER = ["Date", "InvoiceID", "DistributorID", "SalespersonID", "OutletID",
                "ProductID", "Quantity", "UnitPrice", "DiscountPct", "DiscountAmount",
                "GrossSales", "NetSales", "UnitCOGS", "TotalCOGS"]

# Three jars of honey at 4.50 each, a fifth off, sold on the first of a month.
SALE = dict(Date="2025-03-01", DistributorID="D-NORTH", SalespersonID="S-17",
            OutletID="O-4411", ProductID="HONEY-9", InvoiceID="R-25-31", Quantity="3",
            UnitPrice="4.50", DiscountPct="0.20", DiscountAmount="2.70",
            GrossSales="13.50", NetSales="10.80", UnitCOGS="2.40", TotalCOGS="7.20")

MASTER = {
    "DimProduct": [dict(ProductID="HONEY-9", Category="Pantry", Brand="Meadow",
                        ProductName="Clover honey", Variant="Clear", PackSize="500 G",
                        UnitPrice="4.50", UnitCOGS="2.40")],
    "DimDistributor": [dict(DistributorID="D-NORTH", DistributorName="Northern Goods",
                            Region="Highlands", Province="Moray", City="Elgin",
                            DistributorType="Wholesale", StartYear="1987")],
    "DimSalesperson": [dict(SalespersonID="S-17", SalespersonName="Mairi",
                            Supervisor="Callum", DistributorID="D-NORTH",
                            Territory="Speyside", JoinYear="2011")],
    "DimOutlet": [dict(OutletID="O-4411", OutletName="The Corner Larder", Channel="Deli",
                       OutletTier="C", DistributorID="D-NORTH", SalespersonID="S-17",
                       City="Keith", Province="Moray", Region="Highlands",
                       OpenYear="1999")],
    "FactTarget": [dict(MonthStart="2025-03-01", SalespersonID="S-17",
                        TargetSales="640", TargetActiveOutlets="4")],
    "FactInventory": [dict(MonthStart="2025-03-01", DistributorID="D-NORTH",
                           ProductID="HONEY-9", OpeningStock="70", StockReceived="24",
                           UnitsSold="31", ClosingStock="63", StockValue="151.20")],
}


def write_csv(path, rows, header=None):
    header = header or list(rows[0])
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.DictWriter(file, header)
        writer.writeheader()
        writer.writerows(rows)


def write_sales(folder, name="FactSales_shop.csv", rows=None, header=None):
    folder.mkdir(exist_ok=True)
    write_csv(folder / name, rows or [SALE], header or SALES_HEADER)


def write_master(folder, **changes):
    folder.mkdir(exist_ok=True)
    for entity, rows in {**MASTER, **changes}.items():
        write_csv(folder / f"{entity}.csv", rows)
