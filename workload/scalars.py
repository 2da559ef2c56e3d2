"""Column rules: parsing, labels, measures, flags."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.fixed_values import COUNTRY_CODES
from forecourt.functions import dates, text
from forecourt.functions.amounts import amount
from forecourt.functions.columns import key_of
from forecourt.functions.measures import discount_flags
from forecourt.operators.calendar import calendar_of
from forecourt.operators.history import reduce_fact
from forecourt.operators.joins import DimSpec, attach
from forecourt.operators.lookups import recode
from forecourt.operators.schema import clean_headers, conform, stringify, union_all
from forecourt.plans.offers import with_net_amounts
from forecourt.plans.publication import pseudonymise
from forecourt.plans.references import tax_rates
from forecourt.plans.vehicle_sales import price_list
from workload import roles
from workload.registry import iso, query
from workload.roles import Tables, day, text as as_text

LINE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
LINE_KEYS_SQL = ", ".join(LINE_KEYS)


@query(
    "q_date_window",
    f"""select {LINE_KEYS_SQL}, strftime(l_shipdate, '%Y-%m-%d') as ship_date,
      cast(year(l_shipdate) as integer) as year, cast(month(l_shipdate) as integer) as month,
      cast(day(l_shipdate) as integer) as day
    from lineitem where cast(l_shipdate as date) between date '1996-01-15' and date '1997-02-20'""",
)
def date_window(t: Tables) -> DataFrame:
    """Fact reduced to a window with both ends included."""
    window = reduce_fact(t.lineitem, "l_shipdate", date(1996, 1, 15), date(1997, 2, 20))
    return window.select(*LINE_KEYS, iso("l_shipdate").alias("ship_date"), "year", "month", "day")


@query(
    "q_localised_label",
    """with n as (
      select n_nationkey, n_name as label_fr, case when r_name <> 'ASIA' then 'EN ' || n_name end as label_en, r_name
      from nation join region on r_regionkey = n_regionkey)
    select c_custkey, label_fr as french, coalesce(label_en, label_fr) as english, label_en as english_only,
      r_name as region
    from customer join n on n_nationkey = c_nationkey""",
)
def localised_label(t: Tables) -> DataFrame:
    """Country of each customer, with and without fallback to the default locale."""
    regions = attach(t.nation, [DimSpec(t.region, {"r_regionkey": "n_regionkey"})])
    labels = regions.select(
        "n_nationkey",
        F.col("n_name").alias("label_fr"),
        F.when(F.col("r_name") != "ASIA", F.concat(F.lit("EN "), "n_name")).alias("label_en"),
        "r_name",
    )
    named = attach(t.customer.select("c_custkey", "c_nationkey"), [DimSpec(labels, {"n_nationkey": "c_nationkey"})])
    return named.select(
        "c_custkey",
        text.label("label").alias("french"),
        text.label("label", "en").alias("english"),
        text.label("label", "en", fallback=False).alias("english_only"),
        F.col("r_name").alias("region"),
    )


@query(
    "q_recode",
    """with z as (
      select c_custkey, c_mktsegment, case when c_nationkey % 2 = 0 then 'CP' else 'PP' end ||
        case c_nationkey % 5 when 0 then 'FR' when 1 then 'ES' when 2 then 'SP' when 3 then 'XX' end as zone
      from customer)
    select c_custkey, zone, case substr(zone, 3, 2) when 'FR' then 'France' when 'ES' then 'Spain'
        when 'SP' then 'Spain' else substr(zone, 3, 2) end as country,
      case c_mktsegment when 'MACHINERY' then 'B2B' when 'HOUSEHOLD' then 'B2C' when 'BUILDING' then null
        else c_mktsegment end as segment
    from z""",
)
def recoded(t: Tables) -> DataFrame:
    """Recodes that keep unknown values and NULL."""
    nation = F.col("c_nationkey")
    codes = F.when(nation % 5 == 0, "FR").when(nation % 5 == 1, "ES").when(nation % 5 == 2, "SP")
    zone = F.concat(F.when(nation % 2 == 0, "CP").otherwise("PP"), codes.when(nation % 5 == 3, "XX"))
    zoned = t.customer.select(
        "c_custkey", zone.alias("zone"), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment")
    ).withColumn("country", text.zone_country("zone"))
    named = recode(zoned, "country", COUNTRY_CODES)
    return recode(named, "segment", {"MACHINERY": "B2B", "HOUSEHOLD": "B2C"})


@query(
    "q_amount_parse",
    """select o_orderkey, case when o_orderkey % 11 = 0 then null when o_orderkey % 7 = 0 then null
        when o_orderkey % 5 = 0 then -o_totalprice else o_totalprice end as price
    from orders""",
)
def amount_parse(t: Tables) -> DataFrame:
    """Amounts printed with comma, currency, leading blanks; zero and junk."""
    key = F.col("o_orderkey")
    printed = roles.comma(roles.printed("o_totalprice"))
    shown = (
        F.when(key % 11 == 0, "n/a")
        .when(key % 7 == 0, "0")
        .when(key % 5 == 0, F.concat(F.lit("- "), printed))
        .otherwise(F.concat(F.lit(" "), printed))
    )
    return t.orders.select("o_orderkey", amount(shown).alias("price"))


@query(
    "q_multi_date",
    """select o_orderkey, case when o_orderkey % 4 <> 3 then strftime(o_orderdate, '%Y-%m-%d') end as parsed
    from orders""",
)
def multi_date(t: Tables) -> DataFrame:
    """Dates in three layouts; anything else is NULL."""
    key, placed = F.col("o_orderkey"), day("o_orderdate")
    shown = (
        F.when(key % 4 == 0, F.date_format(placed, "yyyy-MM-dd"))
        .when(key % 4 == 1, F.date_format(placed, "yyyy MM dd"))
        .when(key % 4 == 2, F.date_format(placed, "dd/MM/yyyy"))
        .otherwise(F.date_format(placed, "MMM yyyy"))
    )
    return t.orders.select("o_orderkey", iso(dates.parse_date(shown)).alias("parsed"))


PROMO_CODE_SQL = """
    left(case l_returnflag when 'A' then 'C' when 'N' then 'D' else 'X' end || l_linestatus ||
      lpad(cast(l_partkey as varchar), 6, '0') || 'ZZ', cast(l_linenumber + l_quantity % 4 - 1 as integer))"""


@query(
    "q_promo_label",
    f"""with c as (select {LINE_KEYS_SQL}, nullif({PROMO_CODE_SQL}, 'XO') as code from lineitem)
    select {LINE_KEYS_SQL}, code, case when code is null then null
        when left(code, 1) in ('C', 'D') then
          case when length(code) > 5 then substr(code, 4, length(code) - 5) else '' end
        when length(code) > 4 then substr(code, 3, length(code) - 4) else '' end as label
    from c""",
)
def promo_label(t: Tables) -> DataFrame:
    """Labels inside operation codes of any length."""
    head = F.when(F.col("l_returnflag") == "A", "C").when(F.col("l_returnflag") == "N", "D").otherwise("X")
    full = F.concat(head, F.col("l_linestatus"), F.lpad(as_text("l_partkey"), 6, "0"), F.lit("ZZ"))
    length = (F.col("l_linenumber") + F.col("l_quantity") % 4 - 1).cast("int")
    coded = t.lineitem.select(*LINE_KEYS, F.nullif(F.left(full, length), F.lit("XO")).alias("code"))
    return coded.withColumn("label", text.promo_label("code"))


@query(
    "q_text_clean",
    """select p_partkey, p_type as segment, replace('a?' || p_name || '?', '?', '') as marked,
      upper(left(split_part(p_name, ' ', 2), 1)) || lower(substr(split_part(p_name, ' ', 2), 2)) as second_word,
      p_brand || '_' || nullif(p_type, 'PROMO') as row_key
    from part""",
)
def text_clean(t: Tables) -> DataFrame:
    """Prefixes and marks removed, words picked, keys composed."""
    marked = F.concat(F.lit("a?"), F.col("p_name"), F.lit("?"))
    return t.part.select(
        "p_partkey",
        text.strip_pattern(F.concat(F.lit("SEGMENT "), F.col("p_type")), "SEGMENT ").alias("segment"),
        text.strip_pattern(marked, r"\?").alias("marked"),
        text.country_from_label("p_name").alias("second_word"),
        key_of("p_brand", F.nullif(F.col("p_type"), F.lit("PROMO")), sep="_").alias("row_key"),
    )


@query(
    "q_text_strip",
    r"""select doc_id, sha256(regexp_replace(text, '[ \t\n\x0B\f\r]', '', 'g')) as stripped from documents""",
)
def text_strip(t: Tables) -> DataFrame:
    """All white space removed from whole texts."""
    return t.documents.select("doc_id", F.sha2(text.strip_pattern("text", r"\s"), 256).alias("stripped"))


@query(
    "q_stringify",
    """select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey, o_orderstatus,
      o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') as o_orderdate,
      cast(cast(o_totalprice as decimal(18,2)) as varchar) as o_totalprice
    from orders""",
)
def stringified(t: Tables) -> DataFrame:
    """Every column as text."""
    return stringify(
        t.orders.withColumns({"o_orderdate": day("o_orderdate"), "o_totalprice": roles.printed("o_totalprice")})
    )


@query(
    "q_clean_headers",
    """select p_partkey as Part_Key, p_name as Name__long_, p_brand as brandname, p_type as l_type, p_size as Size_mm,
      p_retailprice as price__EUR from part""",
)
def cleaned_headers(t: Tables) -> DataFrame:
    """Headers as departments type them."""
    dirty = t.part.toDF("Part Key ", "Name (long)", "brand-name", "l'type", " Size\r.mm", "price;=EUR")
    return clean_headers(dirty)


@query(
    "q_conform_union",
    """select vehicle, country, order_date, final_price, trade_in_valuation from (
      select 'V' || lpad(cast(o_orderkey as varchar), 16, '0') as vehicle, n_name as country,
        case o_orderkey % 4 when 0 then strftime(o_orderdate, '%Y-%m-%d') when 1 then strftime(o_orderdate, '%Y %m %d')
          when 2 then strftime(o_orderdate, '%d/%m/%Y') else 'n/a' end as order_date,
        case when o_orderkey % 7 = 0 then '0' else
          replace(cast(cast(o_totalprice as decimal(18,2)) as varchar), '.', ',') || ' EUR' end as final_price,
        case when o_orderkey % 8 <> 0 and o_orderstatus = 'F'
          then cast(o_orderkey % 40 as varchar) || ' EUR' end as trade_in_valuation
      from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey)""",
)
def conform_union(t: Tables) -> DataFrame:
    """Two layouts brought to one schema and united."""
    a, b = roles.offer_extracts(t)
    united = union_all([conform(a, roles.LAYOUT_A), conform(b, roles.LAYOUT_B)])
    return united.select("vehicle", "country", "order_date", "final_price", "trade_in_valuation")


NET_SQL = """
    vehicle, abs(total_discount) as total_discount, tariff + options as tariff_and_options,
    tariff_before_tax + options_before_tax as tariff_and_options_before_tax,
    final_price / (1 + tax_rate) as final_price_before_tax,
    conversion_bonus / (1 + tax_rate) as conversion_bonus_before_tax,
    trade_in_aid / (1 + tax_rate) as trade_in_aid_before_tax,
    abs(discount_before_tax) + (trade_in_aid + conversion_bonus) / (1 + tax_rate) as dealer_margin"""
NET_COLUMNS = (
    "vehicle", "total_discount", "tariff_and_options", "tariff_and_options_before_tax", "final_price_before_tax",
    "conversion_bonus_before_tax", "trade_in_aid_before_tax", "dealer_margin",
)


@query(
    "q_net_of_tax",
    f"select {NET_SQL} from offered left join tax using (country)",
    ("offered", "tax"),
)
def net_amounts(t: Tables) -> DataFrame:
    """Amounts before tax; NULL where rate or amount is missing."""
    parsed = roles.offer_union(t).withColumns({a: amount(a) for a in roles.OFFER_AMOUNTS})
    return with_net_amounts(parsed, tax_rates(roles.tax(t))).select(*NET_COLUMNS)


@query(
    "q_discount_flags",
    f"""with f as (
      select {LINE_KEYS_SQL}, n_name as country,
        case when l_linenumber <> 1 then -l_discount end as discount,
        case l_linenumber % 3 when 1 then 0 when 2 then l_tax end as aid,
        case cast(l_quantity as integer) % 4 when 1 then 5 when 2 then 0 when 3 then 0 end as valuation,
        case when l_quantity <> 25 then l_quantity - 25 end as repurchase
      from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey
      join nation on n_nationkey = c_nationkey),
    g as (
      select *, case when country = 'NATION_7' then 0 when coalesce(aid > 0, false) or coalesce(valuation > 0, false)
          then 0 when coalesce(abs(discount) > 0, false) then 1 else 0 end as discount_only,
        case when country = 'NATION_7' then 0 when coalesce(abs(discount) > 0 and aid > 0 and repurchase > 0, false)
          then 1 else 0 end as discount_with_trade_in from f)
    select {LINE_KEYS_SQL}, country, discount_only, discount_with_trade_in,
      case when country = 'NATION_7' then 1 else discount_only + discount_with_trade_in end as usable
    from g""",
)
def flagged_discounts(t: Tables) -> DataFrame:
    """Discount flags with missing, zero and negative amounts."""
    line, quantity = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    located = attach(
        t.lineitem, [DimSpec(roles.order_country(t), {"o_orderkey": "l_orderkey"}, columns=["country"])]
    )
    booked = located.select(
        *LINE_KEYS,
        "country",
        F.when(line != 1, -F.col("l_discount")).alias("discount_before_tax"),
        F.when(line % 3 == 1, 0.0).when(line % 3 == 2, F.col("l_tax")).alias("trade_in_aid"),
        F.when(quantity % 4 == 1, 5).when(quantity % 4 > 1, 0).alias("trade_in_valuation"),
        F.when(quantity != 25, quantity - 25).alias("repurchase_before_tax"),
    )
    flags = discount_flags(booked, roles.EXEMPT)
    return flags.select(*LINE_KEYS, "country", "discount_only", "discount_with_trade_in", "usable")


@query(
    "q_age_bucket",
    f"""with a as (
      select {LINE_KEYS_SQL}, case when l_linenumber <> 7
        then cast(l_shipdate as date) - cast(o_orderdate as date) end as age,
        cast(l_shipdate as date) - cast(o_orderdate as date) as days
      from lineitem join orders on o_orderkey = l_orderkey)
    select {LINE_KEYS_SQL}, cast(age as integer) as age, cast(case when age > 0 then age end as integer) as stock_age,
      case when age is null then null when age < 0 then '< 0' when age <= 29 then '[0;30['
        when age <= 89 then '[30;90[' when age <= 180 then '[90;180[' else '>= 180' end as bucket,
      cast(-days as integer) as delivery_days
    from a""",
)
def age_buckets(t: Tables) -> DataFrame:
    """Ages, their classes and delivery times, on both sides of every bound."""
    built = t.orders.select("o_orderkey", day("o_orderdate").alias("built_on"))
    dated = attach(t.lineitem, [DimSpec(built, {"o_orderkey": "l_orderkey"})])
    known = F.when(F.col("l_linenumber") != 7, day("l_shipdate"))
    aged = dated.withColumn("age", dates.vehicle_age(known, "built_on"))
    return aged.select(
        *LINE_KEYS,
        "age",
        dates.stock_age("age").alias("stock_age"),
        dates.age_bucket("age").alias("bucket"),
        dates.delivery_days(day("l_shipdate"), "built_on").alias("delivery_days"),
    )


@query(
    "q_list_price",
    """select vehicle, line_no, part_key, supp_key, cast(price as double) as price,
      cast(replace(m.margin, ',', '.') as double) as fixed_margin,
      cast(price as double) * (1 + cast(replace(m.margin, ',', '.') as double)) as list_price
    from sold left join margins m on m.key = year(sale_date) || ' ' || country || ' ' || brand""",
    ("sold", "margins"),
)
def list_prices(t: Tables) -> DataFrame:
    """Price plus agreed margin; NULL where none is agreed."""
    sold = roles.sale_lines(t).withColumn("margin_key", roles.margin_key())
    priced = price_list(sold, roles.margins(t))
    priced = priced.withColumn("price", F.col("price").cast("double"))
    return priced.select("vehicle", "line_no", "part_key", "supp_key", "price", "fixed_margin", "list_price")


@query("q_pseudonymise", "select c_custkey, sha256(c_name || '-VME') as c_name from customer")
def pseudonymised(t: Tables) -> DataFrame:
    """Identifiers replaced by salted hashes."""
    return pseudonymise(t.customer.select("c_custkey", "c_name"), ["c_name"])


@query(
    "q_calendar",
    """with days as (
      select unnest(generate_series(min(l_shipdate), max(l_shipdate), interval 1 day)) as d from lineitem),
    n as (select cast(l_shipdate as date) as d, count(*) as n from lineitem group by 1)
    select strftime(days.d, '%Y-%m-%d') as date, strftime(days.d, '%d') as day, cast(month(days.d) as integer) as month,
      cast(year(days.d) as integer) as year, month(days.d) || '/' || strftime(days.d, '%y') as month_year_number,
      strftime(days.d, '%b') as month_name_short, strftime(days.d, '%B') as month_name_long,
      strftime(days.d, '%b-%Y') as month_year_short, strftime(days.d, '%B %Y') as month_year_long,
      'Q' || quarter(days.d) as quarter, year(days.d) || ' Q' || quarter(days.d) as year_quarter,
      cast(strftime(days.d, '%Y%m%d') as integer) as date_as_integer,
      cast(strftime(days.d, '%Y%m') as integer) as month_as_integer, coalesce(n, 0) as n_sales
    from days left join n on n.d = cast(days.d as date)""",
)
def sale_calendar(t: Tables) -> DataFrame:
    """Calendar from the first to the last sale, with the sales of each day."""
    sold = t.lineitem.select(day("l_shipdate").alias("date"))
    daily = sold.groupBy("date").agg(F.count("*").alias("n"))
    days = attach(calendar_of(sold, "date"), [DimSpec(daily, ["date"], "left")])
    return days.withColumns({"date": iso("date"), "n_sales": F.coalesce("n", F.lit(0))}).drop("n")
