"""The sales mart with its own dimensions, ten of which have ids that are unique within a zone only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt.plans.sales import SalesModel, sales
from workload import roles
from workload.marts import SHOWN_DATES, WINDOW, dimension
from workload.registry import iso, query
from workload.roles import Tables, day, text

MODEL = SalesModel(attributes=("sale_date", "order_date", "promo"), measures=roles.MEASURES)
ZONES = ", ".join(f"'{z}'" for z in fixed.SALES_ZONES)
COUNTRIES = ", ".join(f"('{code}', '{name}')" for code, name in fixed.COUNTRY_CODES.items())


def zone_tables(t: Tables) -> dict[str, DataFrame]:
    """Fact and dimensions; most ids are small numbers that mean something else in every zone."""
    sold = t.lineitem.join(roles.order_country(t), F.col("l_orderkey") == F.col("o_orderkey"))
    zone = F.col("c_nationkey") * 2 + F.col("o_custkey") % 2
    part, customer, line = F.col("l_partkey"), F.col("o_custkey"), F.col("l_linenumber")
    facts = sold.select(
        F.when(F.col("l_returnflag") == "R", 2).otherwise(0).alias("base_id"),
        zone.alias("zone_id"),
        (customer % 3).alias("group_id"),
        (F.col("l_suppkey") % 5).alias("company_id"),
        (customer % 5).alias("minor_client_type_id"),
        (part % 7).alias("family_id"),
        (part % 6).alias("subfamily_id"),
        (part % 9).alias("version_id"),
        (part % 8).alias("segment_id"),
        line.alias("heading_id"),
        (F.col("l_suppkey") % 11).alias("operation_id"),
        (line % 5).alias("channel_id"),
        (line % 3).alias("major_client_type_id"),
        customer.alias("client_id"),
        F.when(line != 4, customer).alias("delivered_id"),
        F.col("l_orderkey").alias("vehicle_id"),
        F.col("l_returnflag").alias("promo"),
        day("l_shipdate").alias("sale_date"),
        day("o_orderdate").alias("order_date"),
        *roles.amounts(),
    )
    nation, region, number = F.col("n_nationkey"), F.col("r_regionkey"), F.substring("p_brand", 7, 2).cast("int")
    halves = t.nation.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("parity"))
    zones = halves.withColumn("zone_id", nation * 2 + F.col("parity"))
    zone_code = F.coalesce(
        F.try_element_at(F.array(*(F.lit(z) for z in fixed.SALES_ZONES)), (F.col("zone_id") + 1).cast("int")),
        F.concat(F.lit("EX"), text("zone_id")),
    )

    def ids(c: str, first: int, last: int) -> Column:
        return F.explode(F.sequence(F.lit(first), F.lit(last))).alias(c)

    def in_each_zone(head: str, last: int, kept: Column | None = None, *more: Column) -> DataFrame:
        own = zones.select("zone_id", "n_name", ids("own", 0, last))
        if kept is not None:
            own = own.filter(kept)
        code = F.concat(F.lit(head), text("zone_id"), F.lit("-"), text("own"))
        return dimension(own, "own", code, F.concat(F.lit(head), "n_name"), F.col("zone_id"), *more)

    client = t.customer.withColumn("zone_id", F.col("c_nationkey") * 2 + F.col("c_custkey") % 2)
    vehicle = roles.order_country(t).withColumn("zone_id", zone)
    channels = t.nation.filter(nation < 10).select((nation * 2 + 1).cast("int").alias("at"), ids("b", 1, 8))
    for c, last in (("channel", 4), ("major", 2), ("minor", 4)):
        channels = channels.select("*", ids(c, 0, last))
    code = F.element_at(F.array(*(F.lit(z[2:]) for z in fixed.SALES_ZONES)), F.col("at"))
    key = F.concat(
        code, F.lit(" Brand#"), text("b"), F.lit(" K"), text("channel"), F.lit(" M"), text("major"), F.lit(" m"), text("minor")
    )
    kind = F.when(F.col("channel") == 3, "Other").when(F.col("minor") == 2, "Indirect").otherwise("Direct")
    return {
        "facts": facts,
        "base": dimension(t.region, region, F.when(region < 2, fixed.SALES_BASE).otherwise("EA")),
        "zone": dimension(zones, "zone_id", zone_code, "n_name"),
        "company": in_each_zone("Y", 4),
        "minor_client_type": dimension(
            zones.select("zone_id", "n_name", ids("own", 0, 4)), "own", F.concat(F.lit("m"), text("own")), "n_name", F.col("zone_id")
        ),
        "family": in_each_zone("F", 6, None, (F.col("own") + 1 + F.col("zone_id") % 2).alias("brand_id")),
        "brand": dimension(t.part.select("p_brand").distinct(), number, "p_brand"),
        "subfamily": in_each_zone("s", 5),
        "version": in_each_zone("v", 8),
        "segment": in_each_zone("g", 7, (F.col("own") + F.col("zone_id")) % 2 == 0),
        "heading": dimension(t.region, region, F.concat(F.lit("R"), text(region)), "r_name"),
        "operation": in_each_zone("O", 10, F.col("own") != F.col("zone_id") % 11),
        "channel": dimension(t.region, region, F.concat(F.lit("K"), text(region)), "r_name"),
        "major_client_type": dimension(t.region, region, F.concat(F.lit("M"), text(region)), "r_name"),
        "client": dimension(
            client, "c_custkey", "c_name", "c_mktsegment", F.col("zone_id"), (F.col("c_custkey") % 3).alias("group_id")
        ),
        "vehicle": dimension(vehicle, "o_orderkey", roles.vehicle_id("o_orderkey"), None, F.col("zone_id")),
        "channel_types": channels.filter("b <> 4").select(key.alias("key"), kind.alias("channel_type")),
    }


@query(
    "q_sales_zone_keys",
    f""", f as (
      select cast(l_shipdate as date) as sale_date, cast(o_orderdate as date) as order_date, l_returnflag as promo,
        c_nationkey * 2 + o_custkey % 2 as z, l_partkey % 7 + 1 + o_custkey % 2 as b, country as zone_label,
        ([{ZONES}])[c_nationkey * 2 + o_custkey % 2 + 1] as zone_code,
        'Y' || z || '-' || l_suppkey % 5 as company_code, 'Y' || country as company_label,
        'm' || o_custkey % 5 as minor_client_type_code, country as minor_client_type_label,
        'F' || z || '-' || l_partkey % 7 as family_code, 'F' || country as family_label, 'Brand#' || b as brand,
        's' || z || '-' || l_partkey % 6 as subfamily_code, 's' || country as subfamily_label,
        'v' || z || '-' || l_partkey % 9 as version_code, 'v' || country as version_label,
        case when (l_partkey % 8 + z) % 2 = 0 then 'g' || z || '-' || l_partkey % 8 end as segment_code,
        case when (l_partkey % 8 + z) % 2 = 0 then 'g' || country end as segment_label,
        'R' || h.r_regionkey as heading_code, h.r_name as heading_label,
        case when l_suppkey % 11 <> z % 11 then 'O' || z || '-' || l_suppkey % 11 end as operation_code,
        case when l_suppkey % 11 <> z % 11 then 'O' || country end as operation_label,
        'K' || k.r_regionkey as channel_code, k.r_name as channel_label,
        'M' || j.r_regionkey as major_client_type_code, j.r_name as major_client_type_label,
        cust.c_name as client_code, cust.c_mktsegment as client_label, cust.c_name as delivered_code,
        'V' || lpad(cast(l_orderkey as varchar), 16, '0') as vehicle,
        cast(l_extendedprice as decimal(18,2)) as price, cast(l_quantity as decimal(18,2)) as volume,
        cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(18,2)) as promo_cost,
        cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(18,2)) as storage_cost
      from lineitem join order_country c on o_orderkey = l_orderkey
      join (select c_custkey, c_name, c_mktsegment from customer) cust on cust.c_custkey = o_custkey
      left join region h on h.r_regionkey = l_linenumber join region k on k.r_regionkey = l_linenumber % 5
      join region j on j.r_regionkey = l_linenumber % 3
      where l_returnflag <> 'R' and c_nationkey < 10 and l_linenumber <> 4
        and cast(l_shipdate as date) between date '{WINDOW[0]}' and date '{WINDOW[1]}'),
    g as (
      select * exclude (price, volume, promo_cost, storage_cost), cast(sum(price) as double) as price,
        cast(sum(volume) as double) as volume, cast(sum(promo_cost) as double) as promo_cost,
        cast(sum(storage_cost) as double) as storage_cost
      from f where brand <> 'Brand#4' and brand in (select p_brand from part) group by all),
    names(code, name) as (values {COUNTRIES})
    select * exclude (sale_date, order_date, z, b, code, name), {SHOWN_DATES}, name as country,
      cast(year(sale_date) as integer) as year, cast(month(sale_date) as integer) as month,
      cast(day(sale_date) as integer) as day, year(sale_date) || ' ' || code || ' ' || version_code as margin_key,
      case minor_client_type_code when 'm2' then 'Indirect' else 'Direct' end as channel_type
    from g join names on code = zone_code[3:4] where channel_code <> 'K3'""",
    ("order_country",),
)
def zone_keyed_sales(t: Tables) -> DataFrame:
    """Direct sales over the default dimensions: by zone, by zone and client group, and global ones."""
    mart = sales(zone_tables(t), WINDOW, model=MODEL)
    return mart.withColumns({c: iso(c) for c in ("sale_date", "order_date")})
