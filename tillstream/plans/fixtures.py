"""Point-of-sale segments derived from the star-schema tables.

Each fixture is one SELECT that both Spark and the checking database run, so a
query and its oracle start from the same rows.  ``SPARK`` and ``DUCK`` hold the
few places where the two spell a function differently.  All rules are row-local
or one join on the order key: work grows with the tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SPARK = {
    "day": "date_format(o_orderdate, 'yyyyMMdd')",
    "next_day": "date_format(date_add(cast(o_orderdate as date), 1), 'yyyyMMdd')",
    "ship_day": "date_format(l_shipdate, 'yyyyMMdd')",
    "ship_no": "datediff(cast(l_shipdate as date), date'1970-01-01')",
    "string": "string",
    "null_string": "cast(null as string)",
    # Rows 0 and, where a condition holds, 1.
    "copies": "explode(case when {} then array(0, 1) else array(0) end)",
}
DUCK = {
    "day": "strftime(o_orderdate, '%Y%m%d')",
    "next_day": "strftime(o_orderdate + interval 1 day, '%Y%m%d')",
    "ship_day": "strftime(l_shipdate, '%Y%m%d')",
    "ship_no": "datediff('day', date '1970-01-01', cast(l_shipdate as date))",
    "string": "varchar",
    "null_string": "cast(null as varchar)",
    "copies": "unnest(case when {} then [0, 1] else [0] end)",
}

_SECOND = "(o_orderkey * 37 % 86400)"


def _clock(seconds: str) -> str:
    def two(x: str) -> str:
        return f"lpad(cast(cast(floor({x}) as bigint) as [string]), 2, '0')"

    return (
        f"{two(f'({seconds}) / 3600')} || {two(f'({seconds}) % 3600 / 60')} || "
        f"{two(f'({seconds}) % 60')}"
    )


# The header columns every segment of an order carries.
_BASE = """
  cast(floor(o_orderkey / 5) as bigint) as doc_id,
  lpad(cast(o_custkey % 50 as [string]), 4, '0') as retailstoreid,
  [day] as businessdaydate,
  case o_orderkey % 10 when 0 then '1001' when 1 then '1002' when 2 then '1003'
    when 3 then '1014' when 4 then '1015' when 5 then '1016' when 6 then '1017'
    when 7 then '1101' when 8 then '1301' else '1601' end as transactiontypecode,
  case when o_orderkey % 20 = 9 then '0000000000'
    else lpad(cast(1000 + cast(floor(o_orderkey / 10) as bigint) % 5 as [string]), 10, '0')
    end as workstationid,
  cast(o_orderkey as [string]) as transactionsequencenumber"""

_TEXT = {
    "transactions": f"""
select {_BASE},
  o_orderkey as pos,
  case when o_orderkey % 11 in (0, 3) then [null_string]
    else [day] || {_clock(_SECOND)} end as begindatetimestamp,
  case when o_orderkey % 11 in (1, 3) then [null_string]
    when o_orderkey % 11 = 2 then [day] || {_clock(f"greatest({_SECOND} - 300, 0)")}
    when o_orderkey % 11 = 4 then [next_day] || {_clock(_SECOND)}
    else [day] || {_clock(f"least({_SECOND} + o_orderkey % 600, 86399)")}
    end as enddatetimestamp,
  o_orderpriority as department,
  '1' as operatorqualifier,
  case when o_orderkey % 6 = 5 then [null_string]
    else lpad(cast(o_custkey % 1000 as [string]), 8, '0') end as operatorid,
  'EUR' as transactioncurrency,
  'EUR' as transactioncurrency_iso,
  [null_string] as partnerqualifier,
  cast(o_custkey as [string]) as partnerid
from {{orders}}""",
    # Originals, negated copies of the cancelled ones (type 2901), and one small
    # rounding line on a third of the returns.
    "items": f"""
with lines as (
  select {_BASE}, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag,
    l_linestatus, [ship_no] as ship_no, [ship_day] as ship_day,
    [copies:l_returnflag = 'R' and l_linestatus = 'O'] as copy
  from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey)
select doc_id, retailstoreid, businessdaydate, transactiontypecode, workstationid,
  transactionsequencenumber,
  (l_linenumber + 100 * copy) * 1000000000000 + l_partkey * 100 + ship_no % 100 as pos,
  cast(l_linenumber + 100 * copy as [string]) as retailsequencenumber,
  case when copy = 1 then '2901'
    when l_returnflag = 'R' and l_linestatus = 'F' then '2901'
    when l_returnflag = 'A' and l_linestatus = 'F' then '2006'
    when l_returnflag = 'A' and l_linenumber % 2 = 0 then '2020'
    when l_returnflag = 'N' and l_linestatus = 'F' and l_linenumber % 2 = 1 then '2010'
    when l_returnflag = 'N' and l_linestatus = 'F' then '2804'
    else '2001' end as retailtypecode,
  '2' as itemidqualifier,
  case when l_suppkey % 25 = 0 then [null_string]
    when l_suppkey % 25 = 1 then 'S003147'
    when l_partkey % 10 = 0
      then cast(l_partkey as [string]) || 'UP' || cast(l_partkey % 7 + 1 as [string])
    else cast(l_partkey as [string]) end as itemid,
  cast(l_quantity * (1 - 2 * copy) as decimal(32,3)) as retailquantity,
  'PC' as salesunitofmeasure,
  case when l_suppkey % 97 = 96 then cast(null as decimal(32,2))
    else cast(l_extendedprice * (1 - 2 * copy) as decimal(32,2)) end as salesamount,
  cast(cast(l_extendedprice * (1 - 2 * copy) as decimal(32,2)) as [string]) as normalsalesamount,
  ship_day as batchid,
  cast(l_suppkey as [string]) as serialnumber
from lines
union all
select {_BASE},
  900 * 1000000000000 as pos, '900' as retailsequencenumber,
  '2006' as retailtypecode, '2' as itemidqualifier, 'S000004' as itemid,
  cast(1 as decimal(32,3)) as retailquantity, 'ST' as salesunitofmeasure,
  cast(0.30 as decimal(32,2)) as salesamount, '0.30' as normalsalesamount,
  [day] as batchid, [null_string] as serialnumber
from {{orders}} where o_orderkey % 10 = 0 and o_orderkey % 3 = 0""",
    # Amounts near the sum of the sold lines: balanced, off by cents, or off by more.
    "tenders": f"""
with sold as (
  select l_orderkey,
    sum(case when l_suppkey % 97 = 96
        or (l_returnflag = 'R' and l_linestatus = 'O') then cast(0 as decimal(32,2))
      else cast(l_extendedprice as decimal(32,2)) end) as total
  from {{lineitem}} group by l_orderkey),
pay as (
  select {_BASE}, o_orderkey, o_orderpriority,
    cast(case when o_orderkey % 10 = 4 and o_orderkey % 4 = 0 then 0
      when o_orderkey % 30 = 10 then -50
      else coalesce(total, cast(0 as decimal(32,2)))
        + cast((o_orderkey % 7 - 3) * 0.25 as decimal(32,2))
        + case when o_orderkey % 13 = 0 then 5 else 0 end
      end as decimal(32,2)) as total
  from {{orders}} left join sold on l_orderkey = o_orderkey
  where o_orderpriority <> '5-LOW')
select doc_id, retailstoreid, businessdaydate, transactiontypecode, workstationid,
  transactionsequencenumber, cast(1 as bigint) as pos, '1' as tendersequencenumber,
  case when o_orderpriority = '1-URGENT' then '3108'
    when o_orderpriority = '2-HIGH' then 'OPT'
    when o_orderpriority = '3-MEDIUM' and o_orderkey % 3 = 0 then 'RET'
    else '3101' end as tendertypecode,
  cast(case when o_orderkey % 9 = 0 then total - 1 else total end as decimal(32,2))
    as tenderamount,
  'EUR' as tendercurrency, cast(o_orderkey % 97 as [string]) as tenderid
from pay
union all
select doc_id, retailstoreid, businessdaydate, transactiontypecode, workstationid,
  transactionsequencenumber, cast(2 as bigint) as pos, '2' as tendersequencenumber,
  case when o_orderpriority = '1-URGENT' and o_orderkey % 4 = 1 then '3108'
    when o_orderkey % 2 = 0 then 'RET' else '3110' end as tendertypecode,
  cast(1 as decimal(32,2)) as tenderamount, 'EUR' as tendercurrency,
  [null_string] as tenderid
from pay where o_orderkey % 9 = 0""",
    "tender_ext": f"""
select {_BASE}, cast(1 as bigint) as pos, '1' as tendersequencenumber,
  'CERTIFICATE' as fieldgroup, 'CERT_PARTY' as fieldname,
  case o_orderkey % 3 when 0 then case when o_orderkey % 5 = 0 then 'ru02' else 'RU02' end
    when 1 then 'RU06' else 'XX' end || cast(o_custkey as [string]) as fieldvalue
from {{orders}} where o_orderpriority in ('1-URGENT', '2-HIGH')
union all
select {_BASE}, cast(3 as bigint) as pos, '2' as tendersequencenumber,
  'CERTIFICATE' as fieldgroup, 'CERT_PARTY' as fieldname,
  'RU02' || cast(o_custkey as [string]) as fieldvalue
from {{orders}} where o_orderpriority = '1-URGENT' and o_orderkey % 9 = 0
union all
select {_BASE}, cast(2 as bigint) as pos, '1' as tendersequencenumber,
  'CERTIFICATE' as fieldgroup, 'CERT_PRICE_LONG' as fieldname,
  case o_orderkey % 4 when 0 then cast(o_custkey as [string]) || '.0'
    when 1 then cast(o_custkey as [string]) || '.25'
    when 2 then cast(o_custkey as [string]) || '.'
    else cast(o_custkey as [string]) end as fieldvalue
from {{orders}} where o_orderpriority in ('1-URGENT', '2-HIGH')""",
    # Up to three name/value rows per order that has an event of the same number.
    "txn_ext": f"""
with base as (
  select {_BASE}, event_id, event_type, user_id, value
  from {{events}} join {{orders}} on event_id = o_orderkey)
select doc_id, retailstoreid, businessdaydate,
  case when event_id % 50 = 7 then [null_string] else transactiontypecode end
    as transactiontypecode,
  workstationid, transactionsequencenumber, cast(1 as bigint) as pos,
  case event_type when 'error' then 'CONTACT' else 'POS' end as fieldgroup,
  case event_type when 'view' then 'DOCNUMBER' when 'click' then 'ReceiptNumber'
    when 'purchase' then 'SOURCE' when 'error' then 'MobileNum' else 'CH_SOURCE' end as fieldname,
  case event_type
    when 'view' then 'D' || case when event_id % 2 = 0 then '2' else '1' end
      || lpad(cast(event_id as [string]), 8, '0')
    when 'click' then 'R' || lpad(cast(event_id as [string]), 14, '0')
    when 'purchase' then case when event_id % 4 = 0 then 'web.store' else 'till' end
    when 'error' then '+7' || lpad(cast(user_id as [string]), 10, '9')
    else case when event_id % 8 = 0 then 'n/a'
      when event_id % 8 = 1 then ' ' || cast(user_id % 12 as [string]) || ' '
      else cast(user_id % 12 as [string]) end end as fieldvalue
from base
union all
select doc_id, retailstoreid, businessdaydate, transactiontypecode, workstationid,
  transactionsequencenumber, cast(2 as bigint) as pos, 'POS' as fieldgroup,
  'DOCNUMBER' as fieldname,
  'N' || case when event_id % 4 = 0 then '2' else '1' end
    || lpad(cast(event_id * 7 % 100000 as [string]), 8, '0') as fieldvalue
from base where event_id % 2 = 0
union all
select doc_id, retailstoreid, businessdaydate, transactiontypecode, workstationid,
  transactionsequencenumber, cast(3 as bigint) as pos, 'HEADER' as fieldgroup,
  'BONIDENTIFIER' as fieldname,
  lpad(cast(event_id as [string]), 60, '7') as fieldvalue
from base where event_id % 5 = 0""",
    "item_ext": f"""
with base as (
  select {_BASE}, l_linenumber, l_partkey, l_suppkey
  from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey)
select doc_id, retailstoreid, businessdaydate, transactiontypecode, workstationid,
  transactionsequencenumber, l_partkey * 10 + 1 as pos,
  cast(l_linenumber as [string]) as retailsequencenumber,
  'TAX' as fieldgroup, 'ALCMARK' as fieldname,
  'T' || cast(l_partkey % 3 as [string]) as fieldvalue
from base where l_suppkey % 4 = 0
union all
select doc_id, retailstoreid, businessdaydate, transactiontypecode, workstationid,
  transactionsequencenumber, l_partkey * 10 + 2 as pos,
  cast(l_linenumber as [string]) as retailsequencenumber,
  'EXT' as fieldgroup, 'DATAMATRIX' as fieldname,
  'M' || cast(l_partkey % 5 as [string]) as fieldvalue
from base where l_suppkey % 4 = 1
union all
select doc_id, retailstoreid, businessdaydate, transactiontypecode, workstationid,
  transactionsequencenumber, l_partkey * 10 + 3 as pos,
  cast(l_linenumber as [string]) as retailsequencenumber,
  'POS' as fieldgroup, 'AUTO_MD' as fieldname,
  case when l_partkey % 2 = 0 then 'Y' else 'N' end as fieldvalue
from base where l_suppkey % 7 = 3""",
    "item_discounts": f"""
select {_BASE}, l_linenumber * 1000000000000 + l_partkey * 100 + [ship_no] % 100 as pos,
  cast(l_linenumber as [string]) as retailsequencenumber,
  cast(l_suppkey % 3 + 1 as [string]) as discountsequencenumber,
  cast(l_suppkey % 90 as [string]) as discounttypecode,
  cast(cast(cast(l_extendedprice as decimal(32,2)) * cast(l_discount as decimal(32,2))
    as decimal(32,2)) as [string]) as reductionamount
from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey""",
    "txn_discounts": f"""
select {_BASE}, o_orderkey as pos,
  cast(o_orderkey % 3 + 1 as [string]) as discountsequencenumber,
  case when o_orderkey % 12 = 0 then [null_string]
    else cast(o_orderkey % 90 as [string]) end as discounttypecode,
  cast(cast(cast(o_totalprice as decimal(32,2)) * cast(0.01 as decimal(3,2))
    as decimal(32,2)) as [string]) as reductionamount,
  cast(o_custkey as [string]) as bonusbuyid
from {{orders}}""",
    "movements": f"""
select {_BASE}, o_orderkey as pos,
  cast(o_orderkey % 3 + 1 as [string]) as financialsequencenumber,
  case o_orderkey % 7 when 0 then '3100' when 1 then '3200' when 2 then '3169'
    when 3 then '3170' when 4 then [null_string] else '3101' end as financialtypecode,
  cast(o_custkey as [string]) as accountid,
  case when o_orderkey % 17 = 0 then 'n/a'
    else cast(cast(o_totalprice as decimal(32,2)) as [string]) end as amount,
  'EUR' as financialcurrency, 'EUR' as financialcurrency_iso,
  cast(o_orderkey as [string]) as refererenceid
from {{orders}}""",
    "movement_ext": f"""
select {_BASE}, event_id as pos,
  cast(o_orderkey % 3 + 1 as [string]) as financialsequencenumber,
  'MOVEMENT' as fieldgroup, 'FIELD_' || event_type || '_NAME' as fieldname,
  props as fieldvalue
from {{events}} join {{orders}} on event_id = o_orderkey""",
    # Pack dictionaries.  Some packs have no EAN, some have several.
    "marm": """
select lpad(cast(p_partkey as [string]), 18, '0') as matnr, 'PAK' as meinh,
  cast(p_partkey % 7 + 1 as [string]) as umrez from {part}
union all
select lpad(cast(p_partkey as [string]), 18, '0') as matnr, 'KAR' as meinh,
  cast(p_size + 10 as [string]) as umrez from {part}""",
    "mean": """
select lpad(cast(p_partkey as [string]), 18, '0') as matnr, 'PAK' as meinh, '00001' as lfnum,
  case when p_partkey % 50 = 0 then '' else '46' || lpad(cast(p_partkey as [string]), 11, '0') end
    as ean11 from {part} where p_partkey % 90 <> 0
union all
select lpad(cast(p_partkey as [string]), 18, '0') as matnr, 'PAK' as meinh, '00002' as lfnum,
  '47' || lpad(cast(p_partkey as [string]), 11, '0') as ean11 from {part}""",
    "mara": """
select lpad(cast(p_partkey as [string]), 18, '0') as matnr,
  case when p_partkey % 30 = 0 then '' else 'ST' end as meins from {part}""",
}

# Fixed small dictionaries: rule switches and reason-code descriptions.
FLAGS = ("2125781", "2525942", "2525942_2", "INTEG-5441", "INTEG-8929")
REASONS = {0: "web", 1: "kiosk", 2: "phone", 3: "counter", 5: "partner", 8: "other"}


def _flag_rows(prefix: str) -> str:
    rows = [f"select 'CHK_FIXES' as name, 'S' as type, '{f}' as low" for f in FLAGS]
    rows += [
        "select 'CHK_FIXES', 'P', 'IGNORED'",
        "select 'GK_VIRT_HOURS', 'P', '060000'",
        "select 'VH_EXTYPES', 'S', '1016'",
    ]
    return prefix + " union all ".join(rows)


_TEXT["tvarvc"] = _flag_rows("")
_TEXT["export"] = " union all ".join(
    f"select {code} as reasoncode, '{text}' as description" for code, text in REASONS.items()
)

TABLES = ("orders", "lineitem", "events", "part", "supplier", "customer", "nation", "region")


def _render(text: str, words: dict[str, str]) -> str:
    for key, value in words.items():
        text = text.replace(f"[{key}]", value)
    return re.sub(r"\[copies:(.*?)\]", lambda m: words["copies"].format(m[1]), text)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, partitioned as its files are."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def from_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    used = {t: read_table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(_render(text, SPARK), **used)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived segment or dictionary table."""
    return from_sql(spark, sf_dir, _TEXT[name])


def duck_sql(text: str) -> str:
    """A fixture text as the checking database spells it."""
    text = _render(text, DUCK)
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text


def fixture_sql(name: str) -> str:
    """The same SELECT for the checking database."""
    return duck_sql(_TEXT[name])
