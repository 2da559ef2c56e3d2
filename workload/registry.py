"""Register of the queries and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.session import tune
from workload.roles import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Roles of ``workload.roles`` as SQL; each may use those above it.
CTES = {
    "order_country": """
        select o.*, c.c_mktsegment, c.c_nationkey, n.n_name as country
        from orders o join customer c on c.c_custkey = o.o_custkey
        join nation n on n.n_nationkey = c.c_nationkey""",
    "lines": """
        select l_orderkey as order_key, l_partkey as part_key, l_suppkey as supp_key, l_linenumber as line_no,
          cast(l_shipdate as date) as sale_date, l_returnflag as flag, l_returnflag || l_linestatus as operation,
          cast(l_extendedprice as decimal(18,2)) as price, cast(l_quantity as decimal(18,2)) as volume,
          cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(18,2)) as promo_cost,
          cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(18,2)) as storage_cost
        from lineitem""",
    "sold": """
        select l.*, 'V' || lpad(cast(l.order_key as varchar), 16, '0') as vehicle, o.country, o.c_mktsegment,
          cast(o.o_orderdate as date) as order_date, p.p_brand as brand, p.p_type, p.p_size
        from lines l join order_country o on o.o_orderkey = l.order_key join part p on p.p_partkey = l.part_key""",
    "margins": """
        select y || ' ' || n_name || ' Brand#' || b as key,
          '0,' || lpad(cast(b + n_nationkey % 7 as varchar), 2, '0') as margin
        from nation, range(1995, 2002) years(y), range(2, 25, 2) brands(b)""",
    "firsts": """
        select * from (select *, row_number() over (partition by vehicle, country
          order by sale_date, line_no, part_key, supp_key, price) as rn from sold) where rn = 1""",
    "sums": """
        select vehicle, country, sum(price) as price, sum(volume) as volume, sum(promo_cost) as promo_cost,
          sum(storage_cost) as storage_cost from sold group by vehicle, country""",
    "vehicles": """
        select f.vehicle, f.country, f.brand, f.sale_date, f.line_no, f.part_key, f.c_mktsegment, f.p_type, f.p_size,
          nullif(s.price, 0) as price,
          nullif(s.volume, 0) as volume, nullif(s.promo_cost, 0) as promo_cost,
          s.storage_cost
        from firsts f join sums s on s.vehicle = f.vehicle and s.country = f.country""",
    "tax": """
        select n_name as country, cast('0.' || lpad(cast(n_nationkey as varchar), 2, '0') as double) as tax_rate
        from nation where n_nationkey <> 24""",
    "registered": """
        select 'V' || lpad(cast(o_orderkey as varchar), 16, '0') as vehicle, country,
          case when o_orderkey % 10 <> 0 then cast(o_orderdate as date) + 20 end as sale_date,
          case when o_orderkey % 6 <> 0 then cast(o_orderdate as date) end as order_date,
          o_orderpriority as usage,
          cast(o_orderdate as date) - cast(o_orderkey % 400 - 50 as integer) - earlier as production_date
        from order_country join (values (0, 1), (0, 7), (1, 5)) again(earlier, every) on o_orderkey % every = 0
        where o_orderstatus <> 'P'""",
    "offered": """
        select 'V' || lpad(cast(o_orderkey as varchar), 16, '0') as vehicle, country, o_orderkey as k,
          case when o_orderkey % 4 <> 3 then cast(o_orderdate as date) end as order_date,
          case when o_orderkey % 7 <> 0 then o_totalprice end as final_price,
          cast(cast(o_totalprice as decimal(18,2)) + 1000 as double) as tariff,
          cast(cast(o_totalprice as decimal(18,2)) + 500 as double) as tariff_before_tax,
          cast(o_orderkey % 100 as double) as options,
          case when o_orderkey % 9 <> 0 then cast(o_orderkey % 90 as double) end as options_before_tax,
          case when o_orderkey % 5 <> 0 then cast(o_orderkey % 500 as double) end as conversion_bonus,
          case when o_orderkey % 2 <> 0 then cast(o_orderkey % 300 as double) end as trade_in_aid,
          case when o_orderkey % 8 <> 0 and o_orderstatus = 'F'
            then cast(o_orderkey % 40 as double) end as trade_in_valuation,
          cast(-(o_orderkey % 1000) as double) as total_discount,
          cast(-(o_orderkey % 900) as double) as discount_before_tax,
          case when o_orderkey % 2 = 1 then cast(o_orderkey % 700 as double) end as repurchase_before_tax,
          o_orderpriority as priority
        from order_country""",
    "priced": """
        select v.*, cast(replace(m.margin, ',', '.') as double) as fixed_margin,
          cast(v.price as double) * (1 + cast(replace(m.margin, ',', '.') as double)) as list_price
        from vehicles v left join margins m on m.key = year(v.sale_date) || ' ' || v.country || ' ' || v.brand""",
    "costs": """
        select vehicle, country, brand, coalesce(operation_label, 'Unknown') || ' - ' ||
            case when heading_label = 'Dealer bonus' then 'Network Remuneration' else 'Client Promotions' end
            as operation_label,
          heading_code, heading_label, coalesce(operation_code, 'Unknown') as operation_code, promo_cost
        from (
          select distinct vehicle, country, brand,
            case when operation <> 'NF' then 'Operation ' || operation end as operation_label, flag as heading_code,
            case flag when 'A' then 'Dealer bonus' when 'N' then 'Client bonus' end as heading_label,
            nullif(operation, 'NF') as operation_code, cast(promo_cost as double) as promo_cost
          from sold where promo_cost <> 0)
        union all
        select vehicle, country, brand, 'Financing Costs - Client Promotions', 'Financing Costs', 'Financing Costs',
          'Financing Costs', cast(storage_cost as double) from priced
        union all
        select vehicle, country, brand, 'Fixed Margin - Client Promotions', 'Fixed Margin', 'Fixed Margin',
          'Fixed Margin', list_price * fixed_margin from priced""",
    "classed": """
        select distinct 'Operation ' || operation || ' - ' || case flag when 'A' then 'Client Promotions'
            when 'N' then 'Network Remuneration' else 'Operation ' || operation end as operation_label,
          'Category ' || flag as category, country, brand
        from sold where operation <> 'RO'""",
    "reference": """
        select * from classed
        union all
        select r.label, r.category, n_name, 'Brand#' || b
        from nation, range(1, 26) brands(b), (values
          ('Financing Costs - Financing Costs', 'FINANCING COSTS'),
          ('Fixed Margin - Fixed Margin', 'FIXED MARGIN'),
          ('Unknown - Client Promotions', 'Unknown - Client Promotions'),
          ('Unknown - Network Remuneration', 'Unknown - Network Remuneration')) r(label, category)""",
    "unflagged": """
        select distinct operation_label,
          case when heading_label is null then 'To be flagged'
            when heading_label = 'Dealer bonus' then 'To be flagged - Network Remuneration'
            else 'To be flagged - Client Promotions' end as category, country, brand
        from costs c
        where not exists (select 1 from reference r
          where r.operation_label = c.operation_label and r.country = c.country)""",
}

NEEDS = {
    "sold": ("order_country", "lines"),
    "firsts": ("sold",),
    "sums": ("sold",),
    "vehicles": ("firsts", "sums"),
    "registered": ("order_country",),
    "offered": ("order_country",),
    "priced": ("vehicles", "margins"),
    "costs": ("sold", "priced"),
    "classed": ("sold",),
    "reference": ("classed",),
    "unflagged": ("costs", "reference"),
}


def with_roles(*names: str) -> str:
    """The ``with`` clause that defines some roles and what they build on."""
    wanted: set[str] = set()
    todo = list(names)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo.extend(NEEDS.get(name, ()))
    return "with " + ", ".join(f"{n} as ({sql})" for n, sql in CTES.items() if n in wanted)


def query(name: str, sql: str | None = None, roles: tuple[str, ...] = ()):
    """Register a query and, where SQL can express it, its comparison."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(tune(spark), sf_dir))

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = f"{with_roles(*roles)} {sql}" if roles else sql
        return build

    return register


def iso(c: str | Column) -> Column:
    """A date as text, which every engine renders the same."""
    return (c if isinstance(c, Column) else F.col(c)).cast("date").cast("string")
