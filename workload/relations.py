"""Lookups, joins, duplicates, totals and extracts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.functions.columns import key_of
from forecourt.operators.aggregates import count_by, reconcile, summarise, totals, varchar_widths
from forecourt.operators.duplicates import keep_first, keep_latest, with_group_count
from forecourt.operators.extract import extract
from forecourt.operators.filters import drop_blank, perimeter
from forecourt.operators.joins import DimSpec, attach, join_all, merge_sources
from forecourt.operators.lookups import ambiguous_keys, keep_mapped, lookup, recode_from
from forecourt.operators.schema import union_all
from forecourt.plans.references import category_order, ordered_categories
from forecourt.plans.vehicle_sales import vehicle_rollup
from workload import roles
from workload.registry import iso, query
from workload.roles import Tables, day

SEGMENT_REF_SQL = """
    select distinct c_mktsegment as key, prefix || lower(c_mktsegment) as value
    from customer, (values ('x '), ('y ')) p(prefix) where c_mktsegment <> 'FURNITURE'"""


def segment_ref(t: Tables) -> DataFrame:
    """Two names per segment, one segment left out."""
    prefixes = F.explode(F.array(F.lit("x "), F.lit("y "))).alias("prefix")
    pairs = t.customer.filter("c_mktsegment <> 'FURNITURE'").select("c_mktsegment", prefixes).distinct()
    return pairs.select(
        F.col("c_mktsegment").alias("key"), F.concat("prefix", F.lower("c_mktsegment")).alias("value")
    )


@query(
    "q_lookup_map",
    f"""with r as (select key, max(value) as value from ({SEGMENT_REF_SQL}) group by key)
    select c_custkey, coalesce(value, c_mktsegment) as segment, value as found
    from customer left join r on r.key = c_mktsegment""",
)
def lookup_map(t: Tables) -> DataFrame:
    """Recode that keeps misses next to a lookup that shows them as NULL."""
    ref = segment_ref(t)
    found = lookup(t.customer, "c_mktsegment", ref, "key", "value", "found")
    named = recode_from(found, "c_mktsegment", ref, "key", "value")
    return named.select("c_custkey", F.col("c_mktsegment").alias("segment"), "found")


@query(
    "q_ambiguous_keys",
    """select p_name, min(p_brand) as lowest, max(p_brand) as highest from part
    group by p_name having count(distinct p_brand) > 1""",
)
def ambiguous_parts(t: Tables) -> DataFrame:
    """Keys a reference maps to several values."""
    return ambiguous_keys(t.part, "p_name", "p_brand")


@query(
    "q_channel_filter",
    """, m as (
      select b || ' ' || s as key, case when cast(substr(b, 7) as integer) % 3 = 0 then 'Other'
        when s = 'BUILDING' then 'Indirect' else 'Direct' end as channel_type
      from (select distinct p_brand as b from part),
        (values ('AUTOMOBILE'), ('BUILDING'), ('HOUSEHOLD'), ('MACHINERY')) v(s))
    select vehicle, line_no, part_key, supp_key, m.channel_type
    from sold join m on m.key = brand || ' ' || c_mktsegment and m.channel_type <> 'Other'""",
    ("sold",),
)
def channel_filter(t: Tables) -> DataFrame:
    """Sales of mapped channel types other than the excluded one."""
    segments = F.array(*(F.lit(s) for s in ("AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY")))
    pairs = t.part.select("p_brand").distinct().select("p_brand", F.explode(segments).alias("segment"))
    excluded = F.substring("p_brand", 7, 2).cast("int") % 3 == 0
    kind = F.when(excluded, "Other").when(F.col("segment") == "BUILDING", "Indirect").otherwise("Direct")
    ref = pairs.select(key_of("p_brand", "segment").alias("key"), kind.alias("channel_type"))
    kept = keep_mapped(
        roles.sale_lines(t), key_of("brand", "c_mktsegment"), ref, "key", "channel_type", "channel_type"
    )
    return kept.select("vehicle", "line_no", "part_key", "supp_key", "channel_type")


@query(
    "q_role_playing",
    """select o.n_name as ordering_name, d.n_name as delivered_name, count(*) as n,
      cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as price
    from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey
    join supplier on s_suppkey = l_suppkey join nation o on o.n_nationkey = c_nationkey
    join nation d on d.n_nationkey = s_nationkey group by 1, 2""",
)
def role_playing(t: Tables) -> DataFrame:
    """One dimension under two keys."""
    names = t.nation.select("n_nationkey", F.col("n_name").alias("name"))
    customers, suppliers = t.customer.select("c_custkey", "c_nationkey"), t.supplier.select("s_suppkey", "s_nationkey")
    wide = attach(
        t.lineitem.select("l_orderkey", "l_suppkey", roles.money("l_extendedprice").alias("price")),
        [
            DimSpec(suppliers, {"s_suppkey": "l_suppkey"}),
            DimSpec(t.orders.select("o_orderkey", "o_custkey"), {"o_orderkey": "l_orderkey"}),
            DimSpec(customers, {"c_custkey": "o_custkey"}),
            DimSpec(names, {"n_nationkey": "c_nationkey"}, role="ordering"),
            DimSpec(names, {"n_nationkey": "s_nationkey"}, role="delivered"),
        ],
    )
    measures = {"n": F.count("*")} | totals(wide, ["price"])
    return summarise(wide, ["ordering_name", "delivered_name"], measures)


@query(
    "q_hot_lines",
    """select k, status, flag from (select o_orderkey as k, o_orderstatus as status from orders
        union all select r_regionkey, 'H' from region)
      left join (select case when l_orderkey % 3 = 0 then 0 else l_orderkey end as k, l_returnflag as flag from lineitem)
      using (k)""",
)
def hot_lines(t: Tables) -> DataFrame:
    """A dimension with several lines per key, a third of them for one key and many of them equal."""
    key = F.col("l_orderkey")
    lines = t.lineitem.select(F.when(key % 3 == 0, 0).otherwise(key).alias("k"), F.col("l_returnflag").alias("flag"))
    more = t.region.select(F.col("r_regionkey").cast("long").alias("k"), F.lit("H").alias("status"))
    vehicles = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status")).union(more)
    return attach(vehicles, [DimSpec(lines, ["k"], "left", many=True)])


@query(
    "q_full_outer",
    """with a as (
      select o_orderkey as k, case when o_orderkey % 5 <> 0 then cast(o_orderdate as date) end as sale_date,
        o_orderstatus as usage, o_orderpriority from orders where o_orderstatus <> 'P'),
    b as (
      select l_orderkey as k, min(cast(l_shipdate as date)) as sale_date, max(l_returnflag) as usage,
        sum(cast(l_quantity as decimal(18,2))) as volume from lineitem group by 1)
    select 'V' || lpad(cast(coalesce(a.k, b.k) as varchar), 16, '0') as vehicle, o_orderpriority,
      cast(volume as double) as volume,
      strftime(coalesce(a.sale_date, b.sale_date), '%Y-%m-%d') as sale_date, coalesce(a.usage, b.usage) as usage
    from a full join b on a.k = b.k""",
)
def full_outer(t: Tables) -> DataFrame:
    """Everything two systems know about a vehicle.

    Lines are reduced to one row per vehicle before the systems meet.
    """
    key = F.col("o_orderkey")
    registered = t.orders.filter("o_orderstatus <> 'P'").select(
        key.alias("k"),
        F.when(key % 5 != 0, day("o_orderdate")).alias("registered_date"),
        F.col("o_orderstatus").alias("registered_usage"),
        "o_orderpriority",
    )
    lines = t.lineitem.withColumnRenamed("l_orderkey", "k").withColumn("volume", roles.money("l_quantity"))
    extremes = {"sold_date": F.min(day("l_shipdate")), "sold_usage": F.max("l_returnflag")}
    sold = summarise(lines, ["k"], extremes | totals(lines, ["volume"]))
    both = merge_sources(
        registered,
        sold,
        ["k"],
        {"sale_date": ("registered_date", "sold_date"), "usage": ("registered_usage", "sold_usage")},
    )
    return both.select(
        roles.vehicle_id("k").alias("vehicle"), "o_orderpriority", "volume", iso("sale_date").alias("sale_date"), "usage"
    )


@query(
    "q_join_all",
    """select o_orderkey, n_lines, n_flags, first_ship from
      (select o_orderkey from orders)
      join (select l_orderkey as o_orderkey, count(*) as n_lines from lineitem group by 1) using (o_orderkey)
      join (select l_orderkey as o_orderkey, count(distinct l_returnflag) as n_flags from lineitem group by 1)
        using (o_orderkey)
      join (select l_orderkey as o_orderkey, strftime(min(l_shipdate), '%Y-%m-%d') as first_ship
        from lineitem group by 1) using (o_orderkey)""",
)
def joined_all(t: Tables) -> DataFrame:
    """A list of frames joined on one key."""
    keyed = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    parts = [
        {"n_lines": F.count("*")},
        {"n_flags": F.count_distinct("l_returnflag")},
        {"first_ship": iso(F.min("l_shipdate"))},
    ]
    frames = [summarise(keyed, ["o_orderkey"], part) for part in parts]
    return join_all([t.orders.select("o_orderkey"), *frames], ["o_orderkey"])


@query(
    "q_latest_offer",
    """select code, event_id, event_type, value, strftime(ts, '%Y-%m-%d') as day from (
      select *, 'U' || user_id as code, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
      from events where event_type <> 'error') where rn = 1""",
)
def latest_event(t: Tables) -> DataFrame:
    """Latest record per identifier, blank identifiers dropped."""
    code = F.when(F.col("event_type") == "error", F.lit(" " * 17)).otherwise(F.concat(F.lit("U"), roles.text("user_id")))
    coded = t.events.select(code.alias("code"), "ts", "event_id", "event_type", "value")
    latest = keep_latest(drop_blank(coded, "code"), ["code"], ["ts"], ["event_id"])
    return latest.withColumn("day", iso("ts")).drop("ts")


@query(
    "q_first_per_op",
    """select order_key, operation, line_no, part_key, supp_key, cast(price as double) as price from (
      select *, row_number() over (partition by order_key, operation order by line_no, part_key, supp_key, price) as rn
      from lines) where rn = 1""",
    ("lines",),
)
def first_per_operation(t: Tables) -> DataFrame:
    """First row per vehicle and operation."""
    rows = roles.lines(t).select("order_key", "operation", "line_no", "part_key", "supp_key", "price")
    first = keep_first(rows, ["order_key", "operation"], tiebreak=roles.TIEBREAK)
    return first.withColumn("price", F.col("price").cast("double"))


@query(
    "q_vehicle_rollup",
    """select vehicle, country, brand, strftime(sale_date, '%Y-%m-%d') as sale_date, line_no, part_key,
      cast(price as double) as price, cast(volume as double) as volume, cast(promo_cost as double) as promo_cost,
      cast(storage_cost as double) as storage_cost from vehicles""",
    ("vehicles",),
)
def rollup(t: Tables) -> DataFrame:
    """Sums per vehicle next to its earliest sale."""
    return roles.rolled_vehicles(t).withColumn("sale_date", iso("sale_date"))


@query(
    "q_brand_rollup",
    """select f.brand, f.country, f.vehicle, strftime(f.sale_date, '%Y-%m-%d') as sale_date, s.price, s.volume from (
      select *, row_number() over (partition by brand, country
        order by sale_date, vehicle, line_no, part_key, supp_key, price) as rn from sold) f
    join (select brand, country, cast(nullif(sum(price), 0) as double) as price,
        cast(nullif(sum(volume), 0) as double) as volume from sold group by 1, 2) s
      on s.brand = f.brand and s.country = f.country
    where rn = 1""",
    ("sold",),
)
def brand_rollup(t: Tables) -> DataFrame:
    """The same roll-up over few, very large groups."""
    rolled = vehicle_rollup(
        roles.sale_lines(t),
        ["price", "volume"],
        ["vehicle", "sale_date"],
        ["brand", "country"],
        tiebreak=["vehicle", *roles.TIEBREAK],
    )
    return rolled.withColumn("sale_date", iso("sale_date"))


@query(
    "q_group_count",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
      count(*) over (partition by l_orderkey, l_linenumber) as n from lineitem""",
)
def group_count(t: Tables) -> DataFrame:
    """Size of its group next to each row."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return with_group_count(rows, ["l_orderkey", "l_linenumber"])


@query(
    "q_reconcile",
    """select 'lineitem' as side, count(*) as n_rows, count(distinct (l_orderkey, l_linenumber)) as n_keys from lineitem
    union all select 'orders', count(*), count(distinct o_orderkey) from orders
    union all select 'sale countries', count(*), count(distinct (country, brand)) from sold""",
    ("sold",),
)
def reconciled(t: Tables) -> DataFrame:
    """Rows and different keys of the sides of a join."""
    sides = {
        "lineitem": reconcile(t.lineitem, ["l_orderkey", "l_linenumber"]),
        "orders": reconcile(t.orders, ["o_orderkey"]),
        "sale countries": reconcile(roles.sale_lines(t), ["country", "brand"]),
    }
    return union_all([counts.select(F.lit(name).alias("side"), "*") for name, counts in sides.items()])


@query(
    "q_perimeter_count",
    """select o_orderstatus as site, count(*) as n from orders where o_orderstatus in ('F', 'O')
      and o_orderdate >= date '1996-01-01' and o_orderdate < date '1997-01-01' and o_orderpriority = '1-URGENT'
    group by 1""",
)
def perimeter_count(t: Tables) -> DataFrame:
    """Passages per site within a perimeter."""
    passages = t.orders.withColumnsRenamed(
        {"o_orderstatus": "site", "o_orderdate": "pass_date", "o_orderpriority": "door"}
    )
    return count_by(perimeter(passages, ["F", "O"], date(1996, 1, 1), date(1997, 1, 1), "1-URGENT"), "site")


@query(
    "q_extract",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, o_custkey, o_orderpriority, c_mktsegment
    from lineitem left join (select * from orders where o_orderstatus <> 'P') on o_orderkey = l_orderkey
    left join (select * from customer where c_mktsegment <> 'FURNITURE') on c_custkey = o_custkey
    where l_returnflag not in ('A') and l_linestatus not in ('F') and l_shipdate >= date '1999-12-22'""",
)
def extracted(t: Tables) -> DataFrame:
    """Base table, chain of left joins, conditions and look-back."""
    orders = t.orders.filter("o_orderstatus <> 'P'").withColumnRenamed("o_orderkey", "l_orderkey")
    customers = t.customer.filter("c_mktsegment <> 'FURNITURE'").withColumnRenamed("c_custkey", "o_custkey")
    return extract(
        t.lineitem,
        [(orders, "l_orderkey"), (customers, "o_custkey")],
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "o_custkey", "o_orderpriority", "c_mktsegment"],
        {"l_returnflag": ["A"], "l_linestatus": ["F"]},
        negate=True,
        date_col="l_shipdate",
        since=date(2000, 1, 1),
        nb_days=10,
    )


@query(
    "q_varchar_widths",
    " union all ".join(
        f"select '{table}' as source, '{c}' as \"column\", cast(greatest(coalesce(max(length({c})), 0), 1) as integer)"
        f" as width from {table}"
        for table, columns in {
            "part": ("p_name", "p_brand", "p_type"),
            "customer": ("c_name", "c_mktsegment"),
            "pages": ("url", "html"),
        }.items()
        for c in columns
    ),
)
def widths(t: Tables) -> DataFrame:
    """Longest text per column."""
    tables = {"part": t.part, "customer": t.customer, "pages": t.pages}
    return union_all([varchar_widths(df).select(F.lit(n).alias("source"), "*") for n, df in tables.items()])


@query(
    "q_category_order",
    """with c as (select 'Category ' || l_returnflag || l_linestatus as category, count(*) as n from lineitem group by 1),
    p as (
      select 'Category ' || substr('ANR', r_regionkey + 1, 1) || s as category, 10 - r_regionkey as position
      from region, (values ('O'), ('F')) v(s) where r_regionkey < 2)
    select category, n, cast(position as integer) as position from c left join p using (category)""",
)
def categories(t: Tables) -> DataFrame:
    """Category report in its agreed order."""
    key = F.col("r_regionkey")
    marks = F.explode(F.array(F.lit("O"), F.lit("F"))).alias("mark")
    ref = t.region.filter("r_regionkey < 2").select(
        F.substring(F.lit("ANR"), key + 1, F.lit(1)).alias("flag"), roles.text(10 - key).alias("position"), marks
    )
    ref = ref.select(F.concat(F.lit("Category "), "flag", "mark").alias("category"), "position")
    kind = F.concat(F.lit("Category "), "l_returnflag", "l_linestatus").alias("category")
    return ordered_categories(count_by(t.lineitem.select(kind), "category"), category_order(ref))
