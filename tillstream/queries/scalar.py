"""Keys, casts, text and time rules."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tillstream.functions import casts, keys, text
from tillstream.operators import staging
from tillstream.operators.cancel import line_key
from tillstream.plans.fixtures import duck_sql, from_sql
from tillstream.queries.catalog import ctes, register

ID = ["doc_id", "transactionsequencenumber"]


@register("p2_txn_key", f"{ctes('transactions')} select transactionsequencenumber, txn_key, txn5 from transactions")
def p2(t):
    return t.transactions.select("transactionsequencenumber", "txn_key", "txn5")


@register(
    "p3_line_item_key",
    f"""{ctes('items', 'item_ext')}
select i.transactionsequencenumber, i.retailsequencenumber, e.fieldname, e.fieldvalue, count(*) as pairs
from items i join item_ext e on
  i.doc_id = e.doc_id and
  i.retailstoreid is not distinct from e.retailstoreid and
  i.businessdaydate is not distinct from e.businessdaydate and
  i.transactiontypecode is not distinct from e.transactiontypecode and
  i.workstationid is not distinct from e.workstationid and
  i.transactionsequencenumber is not distinct from e.transactionsequencenumber and
  i.retailsequencenumber is not distinct from e.retailsequencenumber
group by all""",
)
def p3(t):
    """Lines and their extensions meet on the six key columns."""
    left = t.items.select(
        "transactionsequencenumber", "retailsequencenumber", line_key().alias("line_key")
    )
    right = t.item_ext.select("fieldname", "fieldvalue", line_key().alias("line_key"))
    return (
        left.join(right, "line_key")
        .groupBy("transactionsequencenumber", "retailsequencenumber", "fieldname", "fieldvalue")
        .agg(F.count(F.lit(1)).alias("pairs"))
    )


_FACTS = """select retailstoreid, businessdaydate, workstationid, transactionsequencenumber,
  retailsequencenumber, '1' as financialsequencenumber, '1' as discountsequencenumber,
  cast(null as varchar) as taxsequencenumber, '1' as tendersequencenumber from items"""


def _joined_sql(parts: list[str]) -> str:
    return " || '|' || ".join(f"coalesce({p}, '')" for p in parts)


@register(
    "p4_surrogate_keys",
    f"{ctes('items')}, f as ({_FACTS}) select transactionsequencenumber, "
    + ", ".join(f"count(distinct {_joined_sql(v)}) as {k}" for k, v in keys.SURROGATE_KEYS.items())
    + " from f group by all",
)
def p4(t):
    """Distinct values of all seven hashed keys: as many as distinct texts under them."""
    facts = t.items.select(*keys.TXN_PARTS, "retailsequencenumber").withColumns(
        {
            "financialsequencenumber": F.lit("1"),
            "discountsequencenumber": F.lit("1"),
            "taxsequencenumber": F.lit(None).cast("string"),
            "tendersequencenumber": F.lit("1"),
        }
    )
    hashed = keys.with_surrogate_keys(facts, list(keys.SURROGATE_KEYS))
    return hashed.groupBy("transactionsequencenumber").agg(
        *[F.size(F.collect_set(k)).cast("bigint").alias(k) for k in keys.SURROGATE_KEYS]
    )


@register(
    "p5_sql_surrogate_keys",
    f"""{ctes('txn_ext')},
j as (select *, concat_ws('|', retailstoreid, businessdaydate, workstationid,
    transactionsequencenumber, transactiontypecode) as skipping,
  {_joined_sql([*keys.TXN_PARTS, 'transactiontypecode'])} as keeping from txn_ext)
select transactionsequencenumber, pos, skipping = keeping as same,
  count(distinct skipping) over (partition by transactionsequencenumber) as skipping_keys
from j""",
)
def p5(t):
    """Null-skipping keys differ from null-as-empty ones exactly where a part is null."""
    d = t.txn_ext.select("pos", "transactiontypecode", *keys.TXN_PARTS)
    parts = [*keys.TXN_PARTS, "transactiontypecode"]
    skipping = keys.surrogate_key(parts, "skip")
    own = Window.partitionBy("transactionsequencenumber")
    return d.withColumn("skipping", skipping).select(
        "transactionsequencenumber",
        "pos",
        (F.col("skipping") == keys.surrogate_key(parts)).alias("same"),
        F.size(F.collect_set("skipping").over(own)).cast("bigint").alias("skipping_keys"),
    )


# Date texts of several qualities, derived from each order.
_DATES = """
select o_orderkey, case o_orderkey % 8
  when 0 then [day]
  when 1 then [null_string]
  when 2 then ''
  when 3 then substr([day], 1, 6)
  when 4 then substr([day], 1, 4) || '1345'
  when 5 then substr([day], 1, 4) || 'ab' || substr([day], 7, 2)
  when 6 then [day] || '236'
  else 'n/a' end as stamp,
  case o_orderkey % 6
  when 0 then [day] || '235958'
  when 1 then [day] || '250000'
  when 2 then [day] || '12'
  when 3 then [null_string]
  when 4 then '  '
  else [day] end as moment
from {orders}"""


def _part(c: str, first: int, size: int, default: int) -> str:
    return (
        f"case when length({c}) >= {first + size - 1} and "
        f"regexp_full_match(substr({c}, {first}, {size}), '[+-]?[0-9]+') "
        f"then cast(substr({c}, {first}, {size}) as int) else {default} end"
    )


_Y, _M, _D = (_part("stamp", *a) for a in ((1, 4, 1970), (5, 2, 1), (7, 2, 1)))
_PARSED = f"try_cast(printf('%04d-%02d-%02d', {_Y}, {_M}, {_D}) as date)"


@register(
    "p6_dates",
    f"""with d as ({duck_sql(_DATES)})
select o_orderkey,
  cast(case when trim(stamp) = '' or stamp is null then null
    else coalesce({_PARSED}, date '1970-01-01') end as varchar) as raw_day,
  cast(case when length(stamp) > 0 then {_PARSED} end as varchar) as staged_day
from d""",
)
def p6(t):
    c = F.col("stamp")
    return from_sql(t.spark, t.sf_dir, _DATES).select(
        "o_orderkey",
        casts.raw_date(c).cast("string").alias("raw_day"),
        casts.staged_date(c).cast("string").alias("staged_day"),
    )


_PARTS6 = [
    _part("moment", *a)
    for a in ((1, 4, 1970), (5, 2, 1), (7, 2, 1), (9, 2, 0), (11, 2, 0), (13, 2, 0))
]
_TEXT6 = f"printf('%04d-%02d-%02d %02d:%02d:%02d', {', '.join(_PARTS6)})"


@register(
    "p7_timestamps",
    f"""with d as ({duck_sql(_DATES)})
select o_orderkey,
  strftime(case when trim(moment) <> '' then try_cast({_TEXT6} as timestamp) end,
    '%Y-%m-%d %H:%M:%S') as moment_ts,
  case when trim(moment) <> '' then {_TEXT6} end as moment_text,
  coalesce(trim(moment) <> '' and try_cast({_TEXT6} as timestamp) is null, false) as broken
from d""",
)
def p7(t):
    c = F.col("moment")
    return from_sql(t.spark, t.sf_dir, _DATES).select(
        "o_orderkey",
        F.date_format(casts.lenient_timestamp(c), "yyyy-MM-dd HH:mm:ss").alias("moment_ts"),
        casts.datetime_text(c).alias("moment_text"),
        F.coalesce(casts.timestamp_is_broken(c), F.lit(False)).alias("broken"),
    )


# Number texts of several qualities, derived from each line.
_NUMBERS = """
select l_orderkey, l_linenumber, l_partkey, case l_partkey % 6
  when 0 then cast(cast(l_extendedprice as decimal(32,2)) as [string]) || '7'
  when 1 then 'n/a' when 2 then '' when 3 then [null_string]
  when 4 then '-' || cast(l_quantity as [string])
  else cast(cast(l_extendedprice as decimal(32,2)) as [string]) end as number,
  case l_partkey % 5 when 0 then cast(l_suppkey as [string]) when 1 then '1.5'
  when 2 then 'x' when 3 then '99999999999' else '-3' end as whole,
  case l_partkey % 5 when 0 then 'TRUE' when 1 then 'null' when 2 then 'NULL'
  when 3 then 'yes' else [null_string] end as truth
from {lineitem}"""


@register(
    "p8_decimals",
    f"""with d as ({duck_sql(_NUMBERS)})
select l_orderkey, l_linenumber, l_partkey,
  try_cast(nullif(number, '') as decimal(32,2)) as money,
  try_cast(nullif(number, '') as decimal(32,3)) as quantity,
  cast(try_cast(nullif(number, '') as decimal(32,2)) as decimal(38,2)) as widened
from d""",
)
def p8(t):
    c = F.col("number")
    return from_sql(t.spark, t.sf_dir, _NUMBERS).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        casts.lenient_decimal(c).alias("money"),
        casts.lenient_decimal(c, 32, 3).alias("quantity"),
        casts.widen_amount(casts.exact_amount(c)).alias("widened"),
    )


@register(
    "p9_int_bool",
    f"""with d as ({duck_sql(_NUMBERS)})
select l_orderkey, l_linenumber, l_partkey,
  case when regexp_full_match(whole, '[+-]?[0-9]+') then try_cast(whole as int) end as whole_int,
  case when lower(truth) <> 'null' then lower(truth) = 'true' end as truth_bool
from d""",
)
def p9(t):
    return from_sql(t.spark, t.sf_dir, _NUMBERS).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        casts.lenient_int(F.col("whole")).alias("whole_int"),
        casts.lenient_bool(F.col("truth")).alias("truth_bool"),
    )


@register(
    "p10_load_columns",
    """select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as load_ts,
  strftime(ts, '%Y-%m-%d') as load_date,
  strftime(ts - interval 1 hour, '%Y-%m-%d %H:%M:%S') as load_ts_xml,
  strftime(ts - interval 1 hour, '%Y-%m-%d') as load_date_xml from events""",
)
def p10(t):
    earlier = F.col("ts") - F.expr("interval 1 hour")
    load = staging.load_columns(F.col("ts"), earlier)
    shown = {
        n: c.cast("string") if "date" in n else F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        for n, c in load.items()
    }
    return t.table("events").select("event_id", *[c.alias(n) for n, c in shown.items()])


@register(
    "p11_truncation",
    f"""{ctes('txn_ext', 'tender_ext')}
select 'txn' as kind, transactionsequencenumber, pos, substr(fieldgroup, 1, 5) as fieldgroup,
  case when fieldname like '%ReceiptNum%' then substr(fieldvalue, 1, 10)
    else substr(fieldvalue, 1, 40) end as fieldvalue
from txn_ext where transactiontypecode is not null
union all
select 'tender', transactionsequencenumber, pos, substr(fieldgroup, 1, 5), substr(fieldname, 1, 10)
from tender_ext""",
)
def p11(t):
    txn = staging.prepare_txn_extensions(t.txn_ext).select(
        F.lit("txn").alias("kind"), "transactionsequencenumber", "pos", "fieldgroup", "fieldvalue"
    )
    tender = staging.cut_extension_fields(t.tender_ext).select(
        F.lit("tender"), "transactionsequencenumber", "pos", "fieldgroup", "fieldname"
    )
    return txn.union(tender)


@register(
    "p12_extension_rename",
    f"""{ctes('txn_ext')}
select transactionsequencenumber, pos,
  case when fieldname like '%DOCNUMBER%' then 'NOTE'
    when fieldname like '%ReceiptNum%' then 'DOCNUMBER'
    else substr(fieldname, 1, 10) end as fieldname
from txn_ext where transactiontypecode is not null""",
)
def p12(t):
    return staging.prepare_txn_extensions(t.txn_ext).select(
        "transactionsequencenumber", "pos", "fieldname"
    )


@register(
    "p13_head_bonid",
    f"""{ctes('txn_ext')}
select transactionsequencenumber, pos,
  case when contains(fieldgroup, 'HEAD') and contains(fieldname, 'BONID') then '1' else '0' end
    as is_head_bonid
from txn_ext where transactiontypecode is not null""",
)
def p13(t):
    return staging.prepare_txn_extensions(t.txn_ext).select(
        "transactionsequencenumber", "pos", "is_head_bonid"
    )


@register(
    "p14_masking",
    f"""{ctes('txn_ext')}
select transactionsequencenumber, pos, fieldname,
  case when contains(fieldname, 'MobileNum') or contains(fieldname, 'MailClient') then null
    else fieldvalue end as masked_value, fieldvalue as open_value
from txn_ext""",
)
def p14(t):
    name, value = F.col("fieldname"), F.col("fieldvalue")
    return t.txn_ext.select(
        "transactionsequencenumber",
        "pos",
        "fieldname",
        text.masked(name, value).alias("masked_value"),
        text.masked(name, value, mask=False).alias("open_value"),
    )


@register(
    "p15_cert_price",
    f"""{ctes('tender_ext')}
select transactionsequencenumber, pos,
  case when contains(fieldname, 'CERT_PRICE') and regexp_matches(fieldvalue, '[.].*[^.]')
    then split_part(fieldvalue, '.', 2) else fieldvalue end as fraction,
  case when contains(fieldname, 'CERT_PRICE') and fieldvalue like '%.0'
    then split_part(fieldvalue, '.', 1) else fieldvalue end as whole
from tender_ext""",
)
def p15(t):
    name, value = F.col("fieldname"), F.col("fieldvalue")
    return t.tender_ext.select(
        "transactionsequencenumber",
        "pos",
        text.cert_price(name, value, "fraction").alias("fraction"),
        text.cert_price(name, value, "whole").alias("whole"),
    )


@register(
    "p16_discount_code",
    f"""{ctes('txn_discounts')}
select transactionsequencenumber, discountsequencenumber,
  cast(cast(discounttypecode as int) + 100 as varchar) as discounttypecode from txn_discounts""",
)
def p16(t):
    return staging.stage_txn_discounts(t.txn_discounts).select(
        "transactionsequencenumber", "discountsequencenumber", "discounttypecode"
    )


@register(
    "p17_unstaged_lines",
    f"""{ctes('items')}
select transactionsequencenumber, pos, retailtypecode from items where retailtypecode <> '2020'""",
)
def p17(t):
    off = F.lit(False)
    items = t.items.withColumns(
        {
            "has_ean": F.lit(None).cast("boolean"),
            "ean11": F.lit(None).cast("string"),
            "meinh": F.lit(None).cast("string"),
        }
    )
    return staging.stage_items(items, t.item_ext, off, off, off).select(
        "transactionsequencenumber", "pos", "retailtypecode"
    )


@register(
    "p18_untyped_extensions",
    f"""{ctes('txn_ext')}
select transactionsequencenumber, pos, transactiontypecode from txn_ext
where transactiontypecode is not null""",
)
def p18(t):
    return staging.prepare_txn_extensions(t.txn_ext).select(
        "transactionsequencenumber", "pos", "transactiontypecode"
    )


_PERIOD = """
p as (select *, try_strptime(begindatetimestamp, '%Y%m%d%H%M%S') as b,
  try_strptime(enddatetimestamp, '%Y%m%d%H%M%S') as e from transactions),
r as (select *, coalesce(b, e) as b2, case when e is null or b > e then b else e end as e2 from p)"""


@register(
    "p19_period_repair",
    f"""{ctes('transactions')}, {_PERIOD}
select transactionsequencenumber, strftime(b2, '%Y-%m-%d %H:%M:%S') as begin_ts,
  strftime(e2, '%Y-%m-%d %H:%M:%S') as end_ts from r""",
)
def p19(t):
    fmt = "yyyy-MM-dd HH:mm:ss"
    return staging.stage_transactions(t.transactions).select(
        "transactionsequencenumber",
        F.date_format("begindatetimestamp", fmt).alias("begin_ts"),
        F.date_format("enddatetimestamp", fmt).alias("end_ts"),
    )


@register(
    "p20_control_day",
    f"""{ctes('transactions')}, {_PERIOD}
select transactionsequencenumber, transactiontypecode,
  case when transactiontypecode like '11%' and e2 is not null then strftime(e2, '%Y-%m-%d')
    else strftime(strptime(businessdaydate, '%Y%m%d'), '%Y-%m-%d') end as business_day from r""",
)
def p20(t):
    return staging.stage_transactions(t.transactions).select(
        "transactionsequencenumber",
        "transactiontypecode",
        F.col("businessdaydate").cast("string").alias("business_day"),
    )


@register(
    "f4_padded_material",
    """select p_partkey, case when length(cast(p_partkey as varchar)) < 18
  then lpad(cast(p_partkey as varchar), 18, '0') else cast(p_partkey as varchar) end as matnr,
  lpad(p_name, cast(greatest(18, length(p_name)) as int), '0') as long_name from
  (select p_partkey, replace(p_name || '-' || p_name, ' ', '0') as p_name from part)""",
)
def f4(t):
    name = F.concat_ws("-", "p_name", "p_name")
    return t.table("part").select(
        "p_partkey",
        text.padded_material(F.col("p_partkey").cast("string")).alias("matnr"),
        text.padded_material(name).alias("long_name"),
    )


@register(
    "f1_f3_text_parts",
    f"""{ctes('txn_ext')}
select transactionsequencenumber, pos, split_part(fieldvalue, '2', 1) as before_two,
  starts_with(fieldname, 'DOC') as is_doc, contains(fieldvalue, '99') as has_nines,
  substr(fieldvalue, 2, 1) = '2' as reversed,
  substr(fieldvalue, 1, 1) || '1' || substr(fieldvalue, 3) as reference,
  coalesce(trim(fieldvalue) = '', true) as blank
from txn_ext""",
)
def f1_f3(t):
    value = F.col("fieldvalue")
    return t.txn_ext.select(
        "transactionsequencenumber",
        "pos",
        F.get(F.split(value, "2", 2), F.lit(0)).alias("before_two"),
        F.col("fieldname").startswith("DOC").alias("is_doc"),
        value.contains("99").alias("has_nines"),
        text.reversed_note(value).alias("reversed"),
        text.reversal_reference(value).alias("reference"),
        casts.is_blank(value).alias("blank"),
    )


@register(
    "f5_joined_parts",
    f"""{ctes('transactions')}
select transactionsequencenumber,
  coalesce(begindatetimestamp, '') || '|' || coalesce(enddatetimestamp, '') as keeping,
  concat_ws('|', begindatetimestamp, enddatetimestamp) as skipping from transactions""",
)
def f5(t):
    parts = ["begindatetimestamp", "enddatetimestamp"]
    return t.transactions.select(
        "transactionsequencenumber",
        keys.joined(parts).alias("keeping"),
        keys.joined(parts, "skip").alias("skipping"),
    )


@register(
    "f7_f8_amounts_and_dates",
    f"""{ctes('items')}
select transactionsequencenumber, pos, cast(-salesamount as decimal(32,2)) as negated,
  cast(abs(salesamount) as decimal(32,2)) as size,
  salesamount = cast(salesamount as decimal(32,3)) as same_at_any_scale,
  strftime(strptime(businessdaydate, '%Y%m%d') - interval 3 day, '%Y-%m-%d') as three_days_before
from items""",
)
def f7_f8(t):
    amount = F.col("salesamount")
    return t.items.select(
        "transactionsequencenumber",
        "pos",
        (-amount).cast("decimal(32,2)").alias("negated"),
        F.abs(amount).cast("decimal(32,2)").alias("size"),
        (amount == amount.cast("decimal(32,3)")).alias("same_at_any_scale"),
        F.date_sub(casts.staged_date(F.col("businessdaydate")), 3)
        .cast("string")
        .alias("three_days_before"),
    )
