"""Logical inputs of the marts, derived from the test tables.

Each role covers its whole tables. Where a role must lack rows, so that joins and
lookups have misses, rows are left out by an attribute such as order status. The
comparison SQL repeats the same rules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions.columns import key_of
from forecourt.operators.joins import DimSpec, attach
from forecourt.operators.lookups import recode_from
from forecourt.operators.schema import TableSpec, conform, union_all
from forecourt.plans.vehicle_sales import vehicle_rollup

BRANDS = tuple(f"Brand#{i}" for i in range(1, 26))
EXEMPT = "NATION_7"
HEADINGS = {"Heading A": "Dealer bonus", "Heading N": "Client bonus"}
NETWORK_HEADINGS = ("Dealer bonus",)
TIEBREAK = ("line_no", "part_key", "supp_key", "price")
MEASURES = ("price", "volume", "promo_cost", "storage_cost")


class Tables:
    """The test tables of one scale, read on demand."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)  # the footer is read once
        return table


def printed(c: str) -> Column:
    """An amount with its two decimals, as text."""
    return text(F.col(c).cast("decimal(12,2)"))


def money(c: str) -> Column:
    """An amount as the decimal it is in the source system."""
    return F.col(c).cast("decimal(18,2)")


def amounts() -> list[Column]:
    """The measures of a line item; products of two amounts have four decimals."""
    price = money("l_extendedprice")
    return [
        price.alias("price"),
        money("l_quantity").alias("volume"),
        (price * money("l_discount")).alias("promo_cost"),
        (price * money("l_tax")).alias("storage_cost"),
    ]


def day(c: str) -> Column:
    return F.col(c).cast("date")


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def two_digits(c: str | Column) -> Column:
    return F.lpad(text(c), 2, "0")


def vehicle_id(c: str) -> Column:
    return F.concat(F.lit("V"), F.lpad(text(c), 16, "0"))


def lines(t: Tables) -> DataFrame:
    """Line items under the names of the sales fact, without any join."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supp_key"),
        F.col("l_linenumber").alias("line_no"),
        day("l_shipdate").alias("sale_date"),
        F.col("l_returnflag").alias("flag"),
        F.concat("l_returnflag", "l_linestatus").alias("operation"),
        *amounts(),
    )


def order_country(t: Tables) -> DataFrame:
    """Orders with the country and segment of their customer."""
    customers = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    return attach(
        t.orders,
        [
            DimSpec(customers, {"c_custkey": "o_custkey"}),
            DimSpec(t.nation, {"n_nationkey": "c_nationkey"}, columns=["n_name"]),
        ],
    ).withColumnRenamed("n_name", "country")


def sale_lines(t: Tables, *extra: str) -> DataFrame:
    """Sales fact: every line with the country of its order and the brand of its part."""
    orders = order_country(t).withColumn("order_date", day("o_orderdate"))
    sold = attach(
        lines(t),
        [
            DimSpec(orders, {"o_orderkey": "order_key"}, columns=["country", "c_mktsegment", "order_date"]),
            DimSpec(t.part, {"p_partkey": "part_key"}, columns=["p_brand", "p_type", "p_size"]),
        ],
    )
    return sold.withColumnRenamed("p_brand", "brand").withColumn("vehicle", vehicle_id("order_key"))


def margins(t: Tables) -> DataFrame:
    """Agreed margins as text, for even brands only, per year and country."""
    combos = t.nation.select(
        "n_name", "n_nationkey", F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("y")
    ).select("*", F.explode(F.sequence(F.lit(2), F.lit(24), F.lit(2))).alias("b"))
    percent = F.col("b") + F.col("n_nationkey") % 7
    return combos.select(
        F.concat(text("y"), F.lit(" "), F.col("n_name"), F.lit(" Brand#"), text("b")).alias("key"),
        F.concat(F.lit("0,"), two_digits(percent)).alias("margin"),
    )


def margin_key(date_column: str = "sale_date") -> Column:
    return key_of(F.year(date_column), "country", "brand")


def rolled_vehicles(t: Tables) -> DataFrame:
    """Vehicle roll-up.

    A vehicle is one order and so has one country: lines are rolled up by order
    first, and only the rolled-up rows meet orders, customers and parts.
    """
    rolled = vehicle_rollup(
        lines(t), MEASURES, ["sale_date", "line_no", "part_key"], keys=["order_key"], tiebreak=TIEBREAK
    )
    named = attach(
        rolled,
        [
            DimSpec(order_country(t), {"o_orderkey": "order_key"}, columns=["country"]),
            DimSpec(t.part, {"p_partkey": "part_key"}, columns=["p_brand"]),
        ],
    )
    return named.withColumnRenamed("p_brand", "brand").select(
        vehicle_id("order_key").alias("vehicle"), "country", "brand", "sale_date", "line_no", "part_key", *MEASURES
    )


def tax(t: Tables) -> DataFrame:
    """Tax rate per country as text; one country has none."""
    return t.nation.filter("n_nationkey <> 24").select(
        F.col("n_name").alias("country"), F.concat(F.lit("0,"), two_digits("n_nationkey")).alias("tax_rate")
    )


def registrations(t: Tables) -> DataFrame:
    """Registrations of all but pending orders, countries spelled the other system's way.

    Some vehicles have the same line twice, and some a second line with another day of production.
    """
    key = F.col("o_orderkey")
    none = F.array().cast("array<int>")
    again = F.when(key % 7 == 0, F.array(F.lit(0))).otherwise(none)
    another = F.when(key % 5 == 0, F.array(F.lit(1))).otherwise(none)
    earlier = F.explode(F.concat(F.array(F.lit(0)), again, another)).alias("earlier")
    labelled = t.nation.select(F.concat(F.lit("Pays "), F.col("n_name")).alias("label"), "n_name")
    registered = order_country(t).filter("o_orderstatus <> 'P'").select("*", earlier).select(
        vehicle_id("o_orderkey").alias("vehicle"),
        F.concat(F.lit("Pays "), F.col("country")).alias("country"),
        F.when(key % 10 != 0, F.date_add(day("o_orderdate"), 20)).alias("sale_date"),
        F.when(key % 6 != 0, day("o_orderdate")).alias("order_date"),
        F.col("o_orderpriority").alias("usage"),
        F.date_sub(day("o_orderdate"), (key % 400 - 50).cast("int") + F.col("earlier")).alias("production_date"),
    )
    return recode_from(registered, "country", labelled, "label", "n_name")


OFFER_AMOUNTS = (
    "final_price", "tariff", "tariff_before_tax", "options", "options_before_tax", "conversion_bonus",
    "trade_in_aid", "trade_in_valuation", "total_discount", "discount_before_tax", "repurchase_before_tax",
)
OFFER_ORDER = ("vehicle", "country", "order_date", *OFFER_AMOUNTS)


def comma(c: Column) -> Column:
    """A number the way the extracts print it."""
    return F.concat(F.translate(text(c), ".", ","), F.lit(" EUR"))


def offer_texts(t: Tables, reduced: bool = False, again: bool = False) -> DataFrame:
    """Offers of all orders; amounts and dates are text.

    ``reduced`` leaves out the orders without a priority; ``again`` adds an earlier offer, with another
    discount, to every second vehicle.
    """
    key, placed = F.col("o_orderkey"), day("o_orderdate")
    orders = order_country(t).filter("o_orderpriority <> '4-NOT SPECIFIED'") if reduced else order_country(t)
    orders = orders.withColumn("discount", -(key % 1000))
    if again:
        earlier = {"o_orderdate": F.date_sub(placed, 7), "discount": F.lit(-1).cast("long")}
        orders = orders.withColumn("o_orderdate", placed).unionByName(orders.filter(key % 2 == 0).withColumns(earlier))
    dates = (
        F.when(key % 4 == 0, F.date_format(placed, "yyyy-MM-dd"))
        .when(key % 4 == 1, F.date_format(placed, "yyyy MM dd"))
        .when(key % 4 == 2, F.date_format(placed, "dd/MM/yyyy"))
        .otherwise("n/a")
    )
    price = F.col("o_totalprice").cast("decimal(12,2)")
    return orders.select(
        "o_orderstatus",
        vehicle_id("o_orderkey").alias("vehicle"),
        "country",
        dates.alias("order_date"),
        F.when(key % 7 == 0, "0").otherwise(comma(price)).alias("final_price"),
        comma(price + 1000).alias("tariff"),
        comma(price + 500).alias("tariff_before_tax"),
        comma(key % 100).alias("options"),
        F.when(key % 9 != 0, comma(key % 90)).alias("options_before_tax"),
        F.when(key % 5 == 0, "0").otherwise(comma(key % 500)).alias("conversion_bonus"),
        F.when(key % 2 == 0, "0").otherwise(comma(key % 300)).alias("trade_in_aid"),
        F.when(key % 8 != 0, comma(key % 40)).alias("trade_in_valuation"),
        comma(F.col("discount")).alias("total_discount"),
        comma(-(key % 900)).alias("discount_before_tax"),
        F.when(key % 2 == 1, comma(key % 700)).otherwise("abc").alias("repurchase_before_tax"),
    )


# Two departments deliver the same offers under different headers; the second one
# knows no trade-in valuation.
LAYOUT_A = TableSpec({f"{c} (A)": c for c in OFFER_ORDER}, order=OFFER_ORDER)
LAYOUT_B = TableSpec(
    {c.upper(): c for c in OFFER_ORDER if c != "trade_in_valuation"},
    {"trade_in_valuation": "string"},
    OFFER_ORDER,
)


def offer_extracts(t: Tables, **options: bool) -> Sequence[DataFrame]:
    """The two layouts as delivered."""
    offers = offer_texts(t, **options)
    done, open_ = offers.filter("o_orderstatus = 'F'"), offers.filter("o_orderstatus <> 'F'")
    return (
        done.select(*(F.col(c).alias(f"{c} (A)") for c in OFFER_ORDER), F.lit("x").alias("unused")),
        open_.select(*(F.col(c).alias(c.upper()) for c in reversed(OFFER_ORDER) if c != "trade_in_valuation")),
    )


def offer_union(t: Tables, **options: bool) -> DataFrame:
    a, b = offer_extracts(t, **options)
    return union_all([conform(a, LAYOUT_A), conform(b, LAYOUT_B)])


def cost_inputs(t: Tables) -> DataFrame:
    """Sales with the operation and heading columns of the cost mart."""
    return sale_lines(t).withColumns(
        {
            "operation_code": F.nullif(F.col("operation"), F.lit("NF")),
            "operation_label": F.when(F.col("operation") != "NF", F.concat(F.lit("Operation "), F.col("operation"))),
            "heading_code": F.col("flag"),
            "heading_label": F.when(F.col("flag") != "R", F.concat(F.lit("Heading "), F.col("flag"))),
        }
    )


def promos(t: Tables) -> DataFrame:
    """Operations the departments have categorised; one kind is missing."""
    sold = sale_lines(t).filter("operation <> 'RO'")
    return sold.select(
        F.concat(F.lit("Operation "), F.col("operation")).alias("operation_label"),
        F.concat(F.lit("Category "), F.col("flag")).alias("category"),
        "country",
        "brand",
    ).distinct()


def classes(t: Tables) -> DataFrame:
    """Class of each category; one category is in neither class."""
    key = F.col("r_regionkey")
    return t.region.filter("r_regionkey < 3").select(
        F.concat(F.lit("Category "), F.substring(F.lit("ANR"), key + 1, F.lit(1))).alias("category"),
        F.when(key == 0, "Client Promotions").when(key == 1, "Network Remuneration").otherwise("Out").alias("class"),
    )
