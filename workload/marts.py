"""The marts over the test tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.columns import ColumnLike, as_column
from forecourt.operators.schema import TableSpec, conform
from forecourt.plans.budget import budget, budget_lines
from forecourt.plans.cost_rows import cost_rows
from forecourt.plans.dealers import dealers
from forecourt.plans.engines import engine_lines, engines
from forecourt.plans.forecast import forecast
from forecourt.plans.offers import offers
from forecourt.plans.promo_reference import classify_category, promo_reference, unflagged_operations
from forecourt.plans.references import channels, families, tax_rates
from forecourt.plans.registrations import registrations
from forecourt.plans.sales import Dimension, SalesModel, in_zone, sales, sales_wide
from forecourt.plans.vehicle_cost import vehicle_cost
from forecourt.plans.vehicle_sales import price_list, vehicle_sales
from workload import roles
from workload.registry import iso, query
from workload.roles import Tables, day, text, two_digits

# --- flagship ---------------------------------------------------------------------

COST_COLUMNS = (
    "vehicle", "country", "brand", "line_no", "part_key", *roles.MEASURES, "usage", "sale_date", "order_date",
    "production_date", "advantage_after_tax", "advantage_before_tax", "trade_in_aid_before_tax", "discount_only",
    "major_client_type_label", "family_label", "segment_label", "fixed_margin", "list_price",
    "discount_with_trade_in", "usable", "vehicle_age", "stock_age", "age_bucket", "delivery_days",
)


@query(
    "q_vehicle_cost",
    """, w as (
      select v.vehicle, v.country, v.brand, v.line_no, v.part_key, v.price, v.volume, v.promo_cost, v.storage_cost,
        v.fixed_margin, v.list_price, cast(v.p_size as varchar) as segment_label,
        case v.c_mktsegment when 'MACHINERY' then 'B2B' when 'HOUSEHOLD' then 'B2C' else v.c_mktsegment end
          as major_client_type_label,
        case v.p_type when 'ECONOMY' then 'Family 0' when 'LARGE' then 'Family 1' else v.p_type end as family_label,
        r.usage, coalesce(r.sale_date, v.sale_date) as sale_date, coalesce(r.order_date, o.order_date) as order_date,
        r.production_date, o.trade_in_aid as aid, o.trade_in_valuation as valuation,
        o.discount_before_tax as discount, o.repurchase_before_tax as repurchase, t.tax_rate,
        abs(coalesce(o.total_discount, 0)) + coalesce(o.trade_in_aid, 0) as advantage,
        case when v.country = 'NATION_7' then 0
          when coalesce(o.trade_in_aid > 0, false) or coalesce(o.trade_in_valuation > 0, false) then 0
          when coalesce(abs(o.discount_before_tax) > 0, false) then 1 else 0 end as discount_only,
        case when v.country = 'NATION_7' then 0
          when coalesce(abs(o.discount_before_tax) > 0 and o.trade_in_aid > 0 and o.repurchase_before_tax > 0, false)
          then 1 else 0 end as discount_with_trade_in
      from priced v left join registered r on r.vehicle = v.vehicle and r.country = v.country
      left join offered o on o.vehicle = v.vehicle and o.country = v.country and o.priority <> '4-NOT SPECIFIED'
      left join tax t on t.country = v.country),
    a as (select *, order_date - production_date as age from w)
    select distinct vehicle, country, brand, line_no, part_key, cast(price as double) as price, cast(volume as double) as volume,
      cast(promo_cost as double) as promo_cost, cast(storage_cost as double) as storage_cost, usage,
      major_client_type_label, family_label, segment_label, fixed_margin, list_price,
      strftime(sale_date, '%Y-%m-%d') as sale_date, strftime(order_date, '%Y-%m-%d') as order_date,
      strftime(production_date, '%Y-%m-%d') as production_date,
      nullif(advantage, 0) as advantage_after_tax, nullif(advantage / (1 + tax_rate), 0) as advantage_before_tax,
      nullif(coalesce(aid, 0) / (1 + tax_rate), 0) as trade_in_aid_before_tax, discount_only, discount_with_trade_in,
      case when country = 'NATION_7' then 1 else discount_only + discount_with_trade_in end as usable,
      cast(age as integer) as vehicle_age, cast(case when age > 0 then age end as integer) as stock_age,
      case when age < 0 then '< 0' when age < 30 then '[0;30[' when age < 90 then '[30;90['
        when age <= 180 then '[90;180[' when age > 180 then '>= 180' end as age_bucket,
      cast(sale_date - order_date as integer) as delivery_days
    from a""",
    ("priced", "registered", "offered", "tax"),
)
def vehicle_costs(t: Tables) -> DataFrame:
    """Flagship: every sold vehicle with registration, latest offer, taxes and flags."""
    tax = tax_rates(roles.tax(t))
    bids = offers(roles.offer_union(t, reduced=True), tax, roles.OFFER_AMOUNTS)
    mart = vehicle_cost(vehicle_mart(t, roles.MEASURES), roles.registrations(t), bids, tax, roles.EXEMPT)
    dates = {c: iso(c) for c in ("sale_date", "order_date", "production_date")}
    return mart.withColumns(dates).select(*COST_COLUMNS)


# --- offers, sales of vehicles, costs, promotions -----------------------------------

OFFER_COLUMNS = (
    *roles.OFFER_AMOUNTS, "tariff_and_options_before_tax", "tariff_and_options", "final_price_before_tax",
    "conversion_bonus_before_tax", "trade_in_aid_before_tax", "dealer_margin",
)


@query(
    "q_offers",
    """select vehicle, country, strftime(order_date, '%Y-%m-%d') as order_date, final_price, tariff, tariff_before_tax,
      options, options_before_tax, conversion_bonus, trade_in_aid, trade_in_valuation,
      abs(total_discount) as total_discount, abs(discount_before_tax) as discount_before_tax, repurchase_before_tax,
      tariff_before_tax + options_before_tax as tariff_and_options_before_tax, tariff + options as tariff_and_options,
      final_price / (1 + tax_rate) as final_price_before_tax,
      conversion_bonus / (1 + tax_rate) as conversion_bonus_before_tax,
      trade_in_aid / (1 + tax_rate) as trade_in_aid_before_tax,
      abs(discount_before_tax) + (trade_in_aid + conversion_bonus) / (1 + tax_rate) as dealer_margin
    from (
      select *, row_number() over (partition by vehicle order by order_date desc nulls last) as rn from (
        select * from offered
        union all select * replace (order_date - 7 as order_date, -1.0 as total_discount) from offered where k % 2 = 0))
    left join tax using (country) where rn = 1""",
    ("offered", "tax"),
)
def latest_offers(t: Tables) -> DataFrame:
    """Offer mart from two layouts; every second vehicle has two offers."""
    mart = offers(roles.offer_union(t, again=True), tax_rates(roles.tax(t)), roles.OFFER_AMOUNTS)
    return mart.select("vehicle", "country", iso("order_date").alias("order_date"), *OFFER_COLUMNS)


@query(
    "q_vehicle_sales",
    """, m as (select 'MACHINERY' as k, 'B2B' as v union all select 'HOUSEHOLD', 'B2C')
    select vehicle, s.country, brand, strftime(sale_date, '%Y-%m-%d') as sale_date, line_no,
      coalesce(m.v, c_mktsegment) as major_client_type_label,
      case p_type when 'ECONOMY' then 'Family 0' when 'LARGE' then 'Family 1' else p_type end as family_label,
      cast(p_size as varchar) as segment_label, cast(s.price as double) as price, cast(s.volume as double) as volume,
      cast(s.storage_cost as double) as storage_cost, cast(replace(g.margin, ',', '.') as double) as fixed_margin,
      cast(s.price as double) * (1 + cast(replace(g.margin, ',', '.') as double)) as list_price
    from (select f.*, f.country as c from firsts f) f
    join (select vehicle, country, nullif(price, 0) as price, nullif(volume, 0) as volume,
      storage_cost from sums) s using (vehicle)
    left join m on m.k = c_mktsegment left join margins g on g.key = year(sale_date) || ' ' || f.c || ' ' || brand""",
    ("firsts", "sums", "margins"),
)
def sold_vehicles(t: Tables) -> DataFrame:
    """Vehicle sales with channel and family names, segment and list price."""
    mart = vehicle_mart(t, ("price", "volume", "storage_cost"))
    return mart.withColumn("sale_date", iso("sale_date")).drop("part_key", "supp_key")


def vehicle_mart(t: Tables, measures: Sequence[str]) -> DataFrame:
    """Vehicle sales over all lines."""
    sold = roles.sale_lines(t).select(
        "vehicle",
        "country",
        "brand",
        "sale_date",
        "line_no",
        "part_key",
        "supp_key",
        F.col("c_mktsegment").alias("major_client_type_label"),
        F.col("p_type").alias("family_label"),
        F.concat(F.lit("SEGMENT "), text("p_size")).alias("segment_label"),
        roles.margin_key().alias("margin_key"),
        *measures,
    )
    names = t.customer.select(F.col("c_mktsegment").alias("sales_name")).distinct()
    known = F.when(F.col("sales_name") == "MACHINERY", "B2B").when(F.col("sales_name") == "HOUSEHOLD", "B2C")
    kinds = t.part.select(F.col("p_type").alias("family_to_map")).distinct()
    family = F.when(F.col("family_to_map") == "ECONOMY", "Family 0").when(F.col("family_to_map") == "LARGE", "Family 1")
    return vehicle_sales(
        sold,
        names.withColumn("channel", known),
        kinds.withColumn("family", family),
        roles.margins(t),
        measures=measures,
        tiebreak=["line_no", "part_key", "supp_key"],
    )


def vehicle_prices(t: Tables) -> DataFrame:
    """Vehicle roll-up with margin and list price, as the cost mart needs it."""
    vehicles = roles.rolled_vehicles(t).withColumn("margin_key", roles.margin_key())
    return price_list(vehicles, roles.margins(t))


def costs(t: Tables) -> DataFrame:
    return cost_rows(roles.cost_inputs(t), vehicle_prices(t), roles.HEADINGS, roles.NETWORK_HEADINGS)


@query("q_cost_rows", "select * from costs", ("costs",))
def all_costs(t: Tables) -> DataFrame:
    """Promotion, storage and margin costs of every vehicle."""
    return costs(t)


@query(
    "q_promo_reference",
    "select distinct * from (select * from reference union all select * from unflagged)",
    ("reference", "unflagged"),
)
def promotions(t: Tables) -> DataFrame:
    """Operations with categories, added rows and gaps."""
    countries = t.nation.select(F.col("n_name").alias("country"))
    return promo_reference(
        roles.promos(t), roles.classes(t), costs(t), countries, roles.BRANDS, roles.NETWORK_HEADINGS
    )


@query(
    "q_unflagged_ops",
    """select distinct operation_label,
      case when heading_label is null then 'To be flagged'
        when heading_label = 'Dealer bonus' then 'To be flagged - Network Remuneration'
        else 'To be flagged - Client Promotions' end as category, country, brand
    from costs c where not exists (select 1 from classed r
      where r.operation_label = c.operation_label and r.country = c.country)""",
    ("costs", "classed"),
)
def unflagged(t: Tables) -> DataFrame:
    """Operations with costs that no department has categorised."""
    known = classify_category(roles.promos(t), roles.classes(t))
    return unflagged_operations(costs(t), known, roles.NETWORK_HEADINGS)


# --- registrations ------------------------------------------------------------------

OPERATION_SQL = """
    case o_orderkey % 3 when 0 then 'C' when 1 then 'D' else 'X' end || left(o_orderpriority, {n}) || '-{n}X'"""
WINDOW = (date(1996, 1, 1), date(1999, 12, 31))


def registration_tables(t: Tables) -> dict[str, DataFrame]:
    """The twelve tables of the registration system."""
    key, order = F.col("o_orderkey"), roles.order_country(t)
    number = F.substring("p_brand", 7, 2).cast("int")
    head = F.when(key % 3 == 0, "C").when(key % 3 == 1, "D").otherwise("X")

    def operation(n: int) -> Column:
        return F.concat(head, F.left("o_orderpriority", F.lit(n)), F.lit(f"-{n}X")).alias(f"operation_{n}")

    sold = t.lineitem.join(order, F.col("l_orderkey") == key).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    lines = sold.select(
        roles.vehicle_id("o_orderkey").alias("vehicle"),
        F.col("c_nationkey").alias("affiliate"),
        key.alias("order_no"),
        day("l_shipdate").alias("sale_date"),
        day("o_orderdate").alias("order_date"),
        F.col("o_orderpriority").alias("usage"),
        F.col("l_returnflag").alias("trim_colour"),
        F.col("l_linestatus").alias("trim_material"),
        F.col("p_type").alias("engine"),
        F.col("c_mktsegment").alias("profession"),
        F.when(F.col("l_returnflag") == "A", "VU").otherwise("VP").alias("vehicle_type"),
        F.concat(F.lpad(text(number), 4, "0"), F.lit("-"), F.col("p_name")).alias("version_code"),
        F.col("l_suppkey").alias("pack"),
        F.col("l_linenumber").alias("pack_version"),
        key.alias("file_no"),
        F.col("l_quantity").alias("co2"),
    )
    types = F.explode(F.array(F.lit("VP"), F.lit("VU"))).alias("vehicle_type")
    return {
        "lines": lines,
        "countries": t.nation.select(
            F.col("n_nationkey").alias("affiliate"), F.concat(F.lit("Pays "), "n_name").alias("country_label")
        ),
        "affiliates": t.nation.select(F.col("n_nationkey").alias("affiliate")),
        "families": t.part.select("p_brand").distinct().select(
            F.concat(F.lit("8"), text(number % 3 + 3)).alias("affiliate"),
            types,
            F.lpad(text(number), 4, "0").alias("family"),
            F.concat(F.lit("Family "), text(number)).alias("family_label"),
            F.col("p_brand").alias("brand"),
        ),
        "orders": order.filter("o_orderpriority <> '1-URGENT'").select(
            F.col("c_nationkey").alias("affiliate"),
            key.alias("order_no"),
            *(operation(n) for n in range(1, 6)),
            text(key % 2).alias("promo"),
            text(key % 3).alias("promo_2"),
            text(key % 4).alias("discount_percent"),
        ),
        "engines": t.nation.select(
            F.col("n_nationkey").alias("affiliate"), F.explode(F.array(F.lit("LARGE"), F.lit("SMALL"), F.lit("LARGE"))).alias("engine")
        ),
        "vehicles": order.filter("o_orderpriority <> '2-HIGH'").select(
            F.col("c_nationkey").alias("affiliate"),
            roles.vehicle_id("o_orderkey").alias("vehicle"),
            F.when(key % 7 == 0, "D").alias("demo"),
            F.date_add(day("o_orderdate"), 30).alias("registered_on"),
            F.date_add(day("o_orderdate"), 10).alias("available_on"),
            F.date_add(day("o_orderdate"), 5).alias("shipped_on"),
            F.date_add(day("o_orderdate"), 8).alias("arrived_on"),
            F.date_add(day("o_orderdate"), -50).alias("production_date"),
        ),
        "usages": t.nation.select(F.col("n_nationkey").alias("affiliate"), F.explode(F.array_repeat(F.lit("1-URGENT"), 3)).alias("usage")),
        "packs": t.supplier.select(
            F.col("s_nationkey").alias("affiliate"),
            F.col("s_suppkey").alias("pack"),
            F.explode(F.array(F.lit(1), F.lit(2))).alias("version"),
            F.col("s_name").alias("pack_label"),
        ),
        "financing": order.filter("o_orderpriority = '5-LOW'").select(
            F.col("c_nationkey").alias("affiliate"), key.alias("file_no"), day("o_orderdate").alias("reserved_on")
        ),
        "movements": order.filter("o_orderpriority <> '3-MEDIUM'").select(
            F.col("c_nationkey").alias("affiliate"),
            roles.vehicle_id("o_orderkey").alias("vehicle"),
            F.date_add(day("o_orderdate"), 40).alias("in_service_on"),
            F.when(key % 7 == 0, F.date_add(day("o_orderdate"), 90)).alias("demo_end"),
            F.date_add(day("o_orderdate"), 41).alias("registered_on"),
        ),
        "professions": t.customer.filter("c_mktsegment <> 'FURNITURE'").select(
            F.col("c_mktsegment").alias("code"), F.concat(F.lit("Profession "), two_digits("c_nationkey")).alias("label")
        ),
    }


REGISTRATION_DATES = (
    "order_date", "sale_date", "registered_on", "available_on", "shipped_on", "arrived_on", "production_date",
    "in_service_on", "demo_end", "reserved_on",
)
OPERATION_COLUMNS_SQL = ", ".join(f"{OPERATION_SQL.format(n=n)} as operation_{n}" for n in range(1, 6))
LABELS_SQL = ", ".join(
    f"""case when operation_{n} is null then null when left(operation_{n}, 1) in ('C', 'D') then
          case when length(operation_{n}) > 5 then substr(operation_{n}, 4, length(operation_{n}) - 5) else '' end
        when length(operation_{n}) > 4 then substr(operation_{n}, 3, length(operation_{n}) - 4) else '' end
        as operation_{n}_label"""
    for n in range(1, 6)
)
REGISTRATION_SQL = f""", b as (
      select *, cast(o_orderdate as date) as placed, cast(l_shipdate as date) as shipped,
        cast(substr(p_brand, 7) as integer) as number
      from lineitem join order_country on o_orderkey = l_orderkey join part on p_partkey = l_partkey
      where cast(l_shipdate as date) between date '1996-01-01' and date '1999-12-31'),
    prof as (
      select c_mktsegment as code, max('Profession ' || lpad(cast(c_nationkey as varchar), 2, '0')) as label
      from customer where c_mktsegment <> 'FURNITURE' group by 1),
    w as (
      select 'V' || lpad(cast(b.o_orderkey as varchar), 16, '0') as vehicle, placed as order_date,
        b.o_orderpriority as usage, l_returnflag as trim_colour, l_linestatus as trim_material, p_type as engine,
        shipped as sale_date, b.c_mktsegment as profession,
        case when l_returnflag = 'A' then 'CV' else 'PC' end as vehicle_type,
        lpad(cast(number as varchar), 4, '0') as family, 'Family ' || number as family_label, p_brand as brand,
        b.country, c.* exclude (k), 
        case when b.o_orderpriority <> '2-HIGH' and b.o_orderkey % 7 = 0 then 'D' end as demo,
        case when b.c_nationkey in (1, 63) then case when b.o_orderpriority <> '3-MEDIUM' then placed + 41 end
          when b.o_orderpriority <> '2-HIGH' then placed + 30 end as registered_on,
        case when b.o_orderpriority <> '2-HIGH' then placed + 10 end as available_on,
        case when b.o_orderpriority <> '2-HIGH' then placed + 5 end as shipped_on,
        case when b.o_orderpriority <> '2-HIGH' then placed + 8 end as arrived_on,
        case when b.o_orderpriority <> '2-HIGH' then placed - 50 end as production_date,
        case when b.o_orderpriority <> '3-MEDIUM' then placed + 40 end as in_service_on,
        case when b.o_orderpriority <> '3-MEDIUM' and b.o_orderkey % 7 = 0 then placed + 90 end as demo_end,
        s_name as pack_label, case when b.o_orderpriority = '5-LOW' then placed end as reserved_on,
        prof.label as profession_label, cast(l_quantity as decimal(18,2)) * case p_type when 'LARGE' then 2 else 1 end
          * case b.o_orderpriority when '1-URGENT' then 3 else 1 end as emission
      from b
      left join (select o_orderkey as k, {OPERATION_COLUMNS_SQL}, nullif(cast(o_orderkey % 2 as varchar), '0') as promo,
          cast(o_orderkey % 3 as varchar) as promo_2,
          nullif(cast(o_orderkey % 4 as varchar), '0') as discount_percent
        from orders where o_orderpriority <> '1-URGENT') c on c.k = b.o_orderkey
      left join supplier on s_suppkey = l_suppkey and s_nationkey = b.c_nationkey and l_linenumber in (1, 2)
      left join prof on prof.code = b.c_mktsegment
      where number % 3 in (0, 1) and country <> 'NATION_3' and p_brand <> 'Brand#4'),
    g as (select * exclude (emission), sum(emission) as co2 from w group by all)
    select vehicle, usage, trim_colour, trim_material, engine, profession, vehicle_type, family, family_label, brand,
      country, operation_1, operation_2, operation_3, operation_4, operation_5, promo, promo_2, discount_percent, demo,
      pack_label, profession_label, cast(co2 as double) as co2, {LABELS_SQL},
      {", ".join(f"strftime({c}, '%Y-%m-%d') as {c}" for c in REGISTRATION_DATES)},
      cast(year(sale_date) as integer) as year, cast(month(sale_date) as integer) as month,
      cast(day(sale_date) as integer) as day
    from g"""


def registered(t: Tables, **restriction: str) -> DataFrame:
    names = {f"Pays NATION_{i}": f"NATION_{i}" for i in range(25)}
    mart = registrations(
        registration_tables(t),
        WINDOW,
        country_names=names,
        countries=[n for n in names.values() if n != "NATION_3"],
        brands=[b for b in roles.BRANDS if b != "Brand#4"],
        **restriction,
    )
    return mart.withColumns({c: iso(c) for c in REGISTRATION_DATES})


@query("q_registration", REGISTRATION_SQL, ("order_country",))
def all_registrations(t: Tables) -> DataFrame:
    """Registrations from twelve tables."""
    return registered(t)


@query(
    "q_registration_country",
    f"{REGISTRATION_SQL} where country = 'NATION_5' and brand = 'Brand#6'",
    ("order_country",),
)
def country_registrations(t: Tables) -> DataFrame:
    """Registrations of one brand in one country."""
    return registered(t, country="NATION_5", brand="Brand#6")


# --- sales --------------------------------------------------------------------------

SALES_MODEL = SalesModel(
    dimensions=(
        Dimension("base", {"id": "base_id"}, labelled=False, only=("LA",), reported=False),
        Dimension("zone", {"id": "zone_id"}, only=tuple(f"{h}{n:02d}" for h in ("CP", "PP") for n in range(20))),
        Dimension("version", {"id": "version_id"}),
        Dimension("family", {"id": "version_id"}, carry=("brand_id",)),
        Dimension("brand", {"id": "brand_id"}, labelled=False),
        Dimension("segment", {"id": "version_id"}, "left"),
        Dimension("heading", {"id": "heading_id"}, "left", fallback=False),
        Dimension("operation", {"id": "operation_id"}, "left", fallback=False),
        Dimension("channel", {"id": "channel_id"}),
        Dimension("client", {"zone_id": "zone_id", "id": "client_id"}),
        Dimension("delivered", {"id": "delivered_id"}, table="delivered_client", labelled=False),
        Dimension("vehicle", {"id": "vehicle_id"}, labelled=False),
        in_zone("company"),
        in_zone("minor_client_type"),
        in_zone("subfamily"),
        Dimension("major_client_type", {"id": "major_client_type_id"}),
    ),
    first=("vehicle", "delivered", "client", "version", "family", "segment"),
    attributes=("sale_date", "order_date", "promo"),
    measures=roles.MEASURES,
    channel_key=("country", "brand", "channel_code"),
    margin_key=("year", "country", "version_code"),
    country_names={f"{n:02d}": f"Country {n}" for n in range(0, 25, 2)},
)


def sales_tables(t: Tables) -> dict[str, DataFrame]:
    """Fact and dimensions of the sales system."""
    order = roles.order_country(t)
    sold = t.lineitem.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
    zone = F.col("c_nationkey") * 2 + F.col("o_custkey") % 2
    facts = sold.select(
        F.when(F.col("l_returnflag") == "R", 2).otherwise(0).alias("base_id"),
        zone.alias("zone_id"),
        F.col("l_partkey").alias("version_id"),
        F.col("l_linenumber").alias("heading_id"),
        (F.col("l_suppkey") % 30).alias("operation_id"),
        (F.col("l_linenumber") % 5).alias("channel_id"),
        F.col("o_custkey").alias("client_id"),
        F.col("l_suppkey").alias("delivered_id"),
        F.col("l_orderkey").alias("vehicle_id"),
        (F.col("l_suppkey") % 5).alias("company_id"),
        (F.col("o_custkey") % 5).alias("minor_client_type_id"),
        (F.col("l_partkey") % 5).alias("subfamily_id"),
        (F.col("l_linenumber") % 3).alias("major_client_type_id"),
        F.col("l_returnflag").alias("promo"),
        day("l_shipdate").alias("sale_date"),
        day("o_orderdate").alias("order_date"),
        *roles.amounts(),
    )
    region, nation, number = F.col("r_regionkey"), F.col("n_nationkey"), F.substring("p_brand", 7, 2).cast("int")
    halves = t.nation.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("parity"))
    zone_head = F.when(F.col("parity") == 0, "CP").otherwise("PP")
    client_zone = F.col("c_nationkey") * 2 + F.col("c_custkey") % 2
    mapped = F.array(*(F.lit(b) for b in roles.BRANDS if b != "Brand#9"))
    codes = F.explode(F.sequence(F.lit(0), F.lit(4))).alias("channel")
    zoned = halves.select((nation * 2 + F.col("parity")).alias("zone_id"), "n_name", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("own"))

    def in_each_zone(head: str) -> DataFrame:
        code = F.concat(F.lit(head), text("zone_id"), F.lit("-"), text("own"))
        return dimension(zoned, "own", code, F.concat(F.lit(head), "n_name"), F.col("zone_id"))

    kind = F.when(F.col("channel") == 3, "Other").when(F.col("channel") == 2, "Indirect").otherwise("Direct")
    return {
        "facts": facts,
        "base": dimension(t.region, region, F.when(region < 2, "LA").otherwise("EA")),
        "zone": dimension(halves, nation * 2 + F.col("parity"), F.concat(zone_head, two_digits(nation)), "n_name"),
        "version": dimension(t.part, "p_partkey", F.concat_ws("-", "p_brand", text("p_size")), "p_name"),
        "family": dimension(t.part, "p_partkey", "p_type", F.lower("p_type"), number.alias("brand_id")),
        "brand": dimension(t.part.select("p_brand").distinct(), number, "p_brand"),
        "segment": dimension(
            t.part.filter("p_type <> 'MEDIUM'"),
            "p_partkey",
            text("p_size"),
            F.concat(F.lit("SEGMENT "), text("p_size")),
        ),
        "heading": dimension(t.region, region, F.concat(F.lit("R"), text(region)), "r_name"),
        "operation": dimension(t.nation, nation, F.concat(F.lit("O"), text(nation)), "n_name"),
        "channel": dimension(t.region, region, F.concat(F.lit("K"), text(region)), "r_name"),
        "client": dimension(t.customer, "c_custkey", "c_name", "c_mktsegment", client_zone.alias("zone_id")),
        "delivered_client": dimension(t.supplier, "s_suppkey", "s_name"),
        "vehicle": dimension(t.orders, "o_orderkey", roles.vehicle_id("o_orderkey")),
        "company": in_each_zone("Y"),
        "minor_client_type": in_each_zone("m"),
        "subfamily": in_each_zone("s"),
        "major_client_type": dimension(t.region, region, F.concat(F.lit("M"), text(region)), "r_name"),
        "channel_types": t.nation.select("n_nationkey", F.explode(mapped).alias("brand"))
        .select("*", codes)
        .select(
            F.concat(two_digits(nation), F.lit(" "), "brand", F.lit(" K"), text("channel")).alias("key"),
            kind.alias("channel_type"),
        ),
    }


def dimension(
    df: DataFrame, key: ColumnLike, code: ColumnLike, label: ColumnLike | None = None, *more: Column
) -> DataFrame:
    """A dimension table of the sales system."""
    shown = [] if label is None else [as_column(label).alias("label_fr")]
    return df.select(as_column(key).alias("id"), as_column(code).alias("code"), *shown, *more)


WIDE_SQL = """, f as (
      select cast(l_shipdate as date) as sale_date, cast(o_orderdate as date) as order_date, l_returnflag as promo,
        case when o_custkey % 2 = 0 then 'CP' else 'PP' end || lpad(cast(c_nationkey as varchar), 2, '0') as zone_code,
        country as zone_label, p_brand || '-' || p_size as version_code, p_name as version_label,
        p_type as family_code, lower(p_type) as family_label, p_brand as brand_code,
        case when p_type <> 'MEDIUM' then cast(p_size as varchar) end as segment_code,
        case when p_type <> 'MEDIUM' then 'SEGMENT ' || p_size end as segment_label,
        'R' || h.r_regionkey as heading_code, h.r_name as heading_label, 'O' || q.n_nationkey as operation_code,
        q.n_name as operation_label, 'K' || k.r_regionkey as channel_code, k.r_name as channel_label,
        c_name as client_code, c.c_mktsegment as client_label, s_name as delivered_code,
        'Y' || (c_nationkey * 2 + o_custkey % 2) || '-' || (l_suppkey % 5) as company_code, 'Y' || country as company_label,
        'm' || (c_nationkey * 2 + o_custkey % 2) || '-' || (o_custkey % 5) as minor_client_type_code,
        'm' || country as minor_client_type_label,
        's' || (c_nationkey * 2 + o_custkey % 2) || '-' || (l_partkey % 5) as subfamily_code, 's' || country as subfamily_label,
        'M' || j.r_regionkey as major_client_type_code, j.r_name as major_client_type_label,
        'V' || lpad(cast(l_orderkey as varchar), 16, '0') as vehicle_code, c_nationkey as nk,
        cast(l_extendedprice as decimal(18,2)) as price, cast(l_quantity as decimal(18,2)) as volume,
        cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(18,2)) as promo_cost,
        cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(18,2)) as storage_cost
      from lineitem join order_country c on o_orderkey = l_orderkey join part on p_partkey = l_partkey
      join (select c_custkey as ck, c_name from customer) on ck = o_custkey
      join supplier on s_suppkey = l_suppkey
      left join region h on h.r_regionkey = l_linenumber join region k on k.r_regionkey = l_linenumber % 5
      join region j on j.r_regionkey = l_linenumber % 3
      left join nation q on q.n_nationkey = l_suppkey % 30
      where l_returnflag <> 'R' and c_nationkey < 20
        and cast(l_shipdate as date) between date '1996-01-01' and date '1999-12-31'),
    g as (
      select * exclude (price, volume, promo_cost, storage_cost), cast(sum(price) as double) as price,
        cast(sum(volume) as double) as volume, cast(sum(promo_cost) as double) as promo_cost,
        cast(sum(storage_cost) as double) as storage_cost from f group by all)"""
SHOWN_DATES = "strftime(sale_date, '%Y-%m-%d') as sale_date, strftime(order_date, '%Y-%m-%d') as order_date"


@query(
    "q_sales_wide",
    f"{WIDE_SQL} select * exclude (sale_date, order_date, nk), {SHOWN_DATES} from g",
    ("order_country",),
)
def wide_sales(t: Tables) -> DataFrame:
    """Sales fact with all dimensions, summed over everything it reports."""
    wide = sales_wide(sales_tables(t), WINDOW, SALES_MODEL)
    return wide.withColumns({c: iso(c) for c in ("sale_date", "order_date")})


@query(
    "q_sales",
    f"""{WIDE_SQL}, n as (
      select * exclude (sale_date, order_date, nk, brand_code, vehicle_code), brand_code as brand,
        vehicle_code as vehicle, {SHOWN_DATES},
        cast(year(sale_date) as integer) as year, cast(month(sale_date) as integer) as month,
        cast(day(sale_date) as integer) as day,
        case when nk % 2 = 0 then 'Country ' || nk else lpad(cast(nk as varchar), 2, '0') end as country,
        year(sale_date) || ' ' || lpad(cast(nk as varchar), 2, '0') || ' ' || version_code as margin_key,
        case channel_code when 'K2' then 'Indirect' when 'K3' then 'Other' else 'Direct' end as channel_type
      from g where brand_code <> 'Brand#9')
    select * from n where channel_type <> 'Other'""",
    ("order_country",),
)
def direct_sales(t: Tables) -> DataFrame:
    """Direct sales with channel type and margin key."""
    mart = sales(sales_tables(t), WINDOW, model=SALES_MODEL)
    return mart.withColumns({c: iso(c) for c in ("sale_date", "order_date")})


# --- planning and reference marts ----------------------------------------------------


@query(
    "q_forecast_totals",
    """with f as (
      select distinct 'B' || l_returnflag || ' ' || year(l_shipdate) as cycle, cast(month(l_shipdate) as varchar) as month,
        o_orderpriority as client_type, l_linestatus as status, l_linenumber % 3 as c,
        l_quantity as volume, l_discount as rm035, l_tax as rm036, l_extendedprice as price, p_brand as brand
      from lineitem join orders on o_orderkey = l_orderkey join part on p_partkey = l_partkey)
    select cycle, month, case client_type when '1-URGENT' then 'Fleet' when '5-LOW' then 'Private' else client_type end
        as client_type, status, volume, rm035, rm036, price, brand, cast(right(cycle, 4) as integer) as year,
      right(cycle, 4) || '-' || lpad(month, 2, '0') || '-01' as date, rm035 * volume as rm035_total,
      rm036 * volume as rm036_total
    from f where c <> 2""",
)
def forecast_totals(t: Tables) -> DataFrame:
    """Forecast units turned into totals, two sales channels only."""
    sold = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    sold = sold.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    channel = F.element_at(F.array(F.lit(" B2C"), F.lit("B 2B "), F.lit("B2G")), F.col("l_linenumber") % 3 + 1)
    extract = sold.select(
        F.concat(F.lit("B"), "l_returnflag", F.lit(" "), text(F.year("l_shipdate"))).alias("cycle"),
        text(F.month("l_shipdate")).alias("month"),
        F.col("o_orderpriority").alias("client_type"),
        F.col("l_linestatus").alias("status"),
        channel.alias("channel"),
        text("l_quantity").alias("volume"),
        text("l_discount").alias("rm035"),
        text("l_tax").alias("rm036"),
        text("l_extendedprice").alias("price"),
        F.col("p_brand").alias("brand"),
    )
    priority = t.orders.select(F.col("o_orderpriority").alias("forecast_name")).distinct()
    name = F.when(F.col("forecast_name") == "1-URGENT", "Fleet").when(F.col("forecast_name") == "5-LOW", "Private")
    ref = priority.withColumn("channel", name)
    mart = forecast(extract, ref, ["rm035", "rm036"], ["price"])
    return mart.withColumn("date", iso("date"))


BRAND_NAMES = {f"MARQUE {i}": f"M{i}" for i in range(4)}


@query(
    "q_budget",
    """with b as (
      select case when o_custkey % 5 < 4 then 'M' || o_custkey % 5 else 'MARQUE 4' end as brand,
        case c_nationkey % 3 when 0 then 'France' when 1 then 'Belgium' else 'ANDORRA' end as country,
        case o_orderstatus when 'F' then 'PC' else 'CV' end as vehicle_type,
        case when c_mktsegment = 'BUILDING' then 'Family B' else c_mktsegment end as family,
        case when o_orderkey % 4 = 0 then '' else 'E' || o_orderkey % 4 end as energy,
        case o_orderpriority when '2-HIGH' then 'B2B' when '5-LOW' then 'B2C' else o_orderpriority end as channel,
        case when o_orderkey % 7 <> 0 then o_totalprice end as price, cast(o_orderkey % 50 as double) as v,
        cast(o_orderdate as date) + interval 20 year as d
      from orders join customer on c_custkey = o_custkey where o_orderstatus <> 'P')
    select distinct brand, country, vehicle_type, family, energy, channel, price, nullif(v, 0) as volume,
      strftime(d, '%Y-%m-%d') as date, cast(year(d) as integer) as year
    from b""",
)
def yearly_budget(t: Tables) -> DataFrame:
    """Budget from two extracts."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    priced = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    shifted = F.add_months(day("o_orderdate"), 240)
    brand = F.concat(F.lit("MARQUE "), text(F.col("o_custkey") % 5))
    countries = F.array(F.lit("FRANCE"), F.lit("BELGIQUE"), F.lit("ANDORRA"))
    extract = priced.select(
        F.year("o_orderdate").alias("placed"),
        brand.alias("Marque"),
        F.element_at(countries, F.col("c_nationkey") % 3 + 1).alias("LIB PAYS"),
        F.when(status == "F", "VP").when(status == "O", "VU").otherwise("AJUST").alias("TYPE"),
        F.col("c_mktsegment").alias("family"),
        F.when(key % 4 == 0, "(vide)").otherwise(F.concat(F.lit("E"), text(key % 4))).alias("energy"),
        F.col("o_orderpriority").alias("channel"),
        F.when(key % 7 == 0, "0").otherwise(roles.comma(roles.printed("o_totalprice"))).alias("price"),
        text(key % 50).alias("volume"),
        F.date_format(shifted, "dd/MM/yy").alias("date"),
        text(F.year(shifted)).alias("year"),
    )
    spec = TableSpec(
        {"Marque": "brand", "LIB PAYS": "country", "TYPE": "vehicle_type"}
        | {c: c for c in ("family", "energy", "channel", "price", "volume", "date", "year")}
    )
    sheets = [conform(extract.filter("placed < 1998"), spec), conform(extract.filter("placed >= 1998"), spec)]
    segments = t.customer.select(F.col("c_mktsegment").alias("family_to_map")).distinct()
    family = F.when(F.col("family_to_map") == "BUILDING", "Family B")
    priorities = t.orders.select(F.col("o_orderpriority").alias("budget_name")).distinct()
    channel = F.when(F.col("budget_name") == "2-HIGH", "B2B").when(F.col("budget_name") == "5-LOW", "B2C")
    mart = budget(
        budget_lines(sheets, BRAND_NAMES),
        segments.withColumn("family", family),
        priorities.withColumn("channel", channel),
        ["price", "volume"],
    )
    return mart.withColumn("date", iso("date"))


@query(
    "q_dealer",
    """select distinct 'P' as rank, 'S' || s_suppkey % 7 as sector_code, n_name as country
    from supplier join nation on n_nationkey = s_nationkey where s_acctbal >= 5000""",
)
def primary_dealers(t: Tables) -> DataFrame:
    """Primary dealers per country and sector."""
    located = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    sector = F.rpad(F.concat(F.lit("  S"), text(F.col("s_suppkey") % 7)), 10, " ")
    return dealers(
        located.select(
            F.when(F.col("s_acctbal") >= 5000, "P").otherwise("S").alias("rank"),
            sector.alias("sector_code"),
            F.col("n_name").alias("country"),
        )
    )


@query(
    "q_engine_energy",
    """with e as (
      select distinct p_brand || '-' || p_size as engine, 'NATION_' || p_partkey % 2 as country,
        case p_type when 'MEDIUM' then '' when 'ECONOMY' then 'Electric' when 'STANDARD' then 'Diesel'
          when 'PROMO' then 'Diesel' when 'LARGE' then 'Petrol' when 'SMALL' then
            case when p_size > 40 then null else 'Hybrid' end end as energy
      from part),
    f as (select *, count(*) over (partition by engine, country) as n from e),
    g as (select *, count(*) over (partition by engine, country) as m from f where not (coalesce(energy, '-') = '' and n > 1))
    select distinct engine, country, case when m > 1 then 'Unknown' else energy end as energy from g""",
)
def engine_energies(t: Tables) -> DataFrame:
    """One energy per engine and country."""
    printed = {"ECONOMY": "ELECTRICO", "STANDARD": "DIESEL", "PROMO": "Diesel", "LARGE": "GASOLINA", "MEDIUM": ""}
    energy = F.when((F.col("p_type") == "SMALL") & (F.col("p_size") <= 40), "Hybrid?")
    for kind, name in printed.items():
        energy = energy.when(F.col("p_type") == kind, name)
    models = t.part.select(
        F.concat_ws("-", "p_brand", text("p_size")).alias("engine"),
        (F.col("p_partkey") % 2).alias("affiliate"),
        energy.alias("energy"),
    )
    label = F.concat(F.lit("Pays "), "n_name").alias("country_label")
    nations = t.nation.select(F.col("n_nationkey").alias("affiliate"), label)
    names = {f"Pays NATION_{i}": f"NATION_{i}" for i in range(2)}
    return engines(engine_lines(models, nations, country_names=names, perimeter=names.values()))


@query(
    "q_references",
    """select distinct 'family' as kind, lower(p_type) as name, p_brand as brand from part
    union all select 'channel', c_mktsegment, null from (select distinct c_mktsegment from customer)""",
)
def reference_tables(t: Tables) -> DataFrame:
    """Families and channels without their mapping columns."""
    extract = t.part.select(
        F.lower("p_type").alias("family"), F.col("p_brand").alias("brand"), F.col("p_name").alias("family_to_map")
    )
    models = families(extract).select(
        F.lit("family").alias("kind"), F.col("family").alias("name"), "brand"
    )
    kinds = channels(t.customer.select(F.col("c_mktsegment").alias("channel"), "c_name")).distinct()
    named = kinds.select(F.lit("channel").alias("kind"), F.col("channel").alias("name"))
    return models.unionByName(named, allowMissingColumns=True)
