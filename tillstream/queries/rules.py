"""Corrections, sums, item and tender rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream.functions.keys import TXN, with_txn_key
from tillstream.operators import cancel, corrections, dictionaries, erp, staging, synthetic
from tillstream.operators.history import rededup
from tillstream.queries.catalog import Tables, ctes, register
from tillstream.sources import tables

ONLINE = "web.store"
LINE = ["transactionsequencenumber", "pos"]

# --- sums and flags -----------------------------------------------------------

_SUMS = """
s as (select doc_id, txn5, sum(salesamount) as sale, count(salesamount) as n
  from items group by all),
p as (select doc_id, txn5, sum(tenderamount) as paid from tenders group by all)"""


@register(
    "a1_txn_sums",
    f"""{ctes('items', 'tenders')},
s as (select doc_id, txn5, transactiontypecode, sum(salesamount) as sales_sum,
  count(salesamount) as item_count from items
  where salesamount is not null and transactiontypecode in ('1001', '1002', '1003') group by all),
p as (select doc_id, txn5, transactiontypecode, sum(tenderamount) as tender_sum from tenders
  where transactiontypecode in ('1001', '1002', '1003') group by all)
select doc_id, txn5, transactiontypecode, tender_sum, sales_sum,
  coalesce(item_count, 0) as item_count
from s full join p using (doc_id, txn5, transactiontypecode)""",
)
def a1(t):
    return corrections.txn_sums(t.items, t.tenders)


@register(
    "a2_rounding_added",
    f"""{ctes('items', 'tenders')}, {_SUMS}
select i.doc_id, i.transactionsequencenumber, cast(n + 1 as varchar) as retailsequencenumber,
  'S000004' as itemid, '2805' as retailtypecode, '2' as itemidqualifier,
  cast(1 as decimal(32,3)) as retailquantity, 'ST' as salesunitofmeasure,
  cast(paid - sale as decimal(32,2)) as salesamount
from s join p using (doc_id, txn5)
join (select distinct doc_id, txn5, transactionsequencenumber, transactiontypecode from items) i
  using (doc_id, txn5)
where i.transactiontypecode in ('1002', '1003') and paid <> sale and abs(paid - sale) < 1""",
)
def a2(t):
    items = t.items
    sums = corrections.txn_sums(items, t.tenders)
    return corrections.rounding_items(items, sums).select(
        "doc_id",
        "transactionsequencenumber",
        "retailsequencenumber",
        "itemid",
        "retailtypecode",
        "itemidqualifier",
        "retailquantity",
        "salesunitofmeasure",
        "salesamount",
    )


@register(
    "a3_rounding_removed",
    f"""{ctes('items', 'tenders')}, {_SUMS}
select i.transactionsequencenumber, i.pos, i.retailtypecode, i.salesamount
from items i left join s using (doc_id, txn5) left join p using (doc_id, txn5)
where not coalesce(i.transactiontypecode = '1001' and i.retailtypecode = '2006'
  and paid <> sale and abs(paid - sale) < 1 and i.salesamount = sale - paid, false)""",
)
def a3(t):
    items = t.items
    sums = corrections.txn_sums(items, t.tenders)
    return corrections.drop_rounding_items(items, sums).select(
        *LINE, "retailtypecode", "salesamount"
    )


@register(
    "a3_rounding_removed_first",
    f"""{ctes('items', 'tenders')}, {_SUMS},
f as (select doc_id, txn5, min(pos) as pos from items where retailtypecode = '2006' group by all)
select i.transactionsequencenumber, i.pos
from items i left join s using (doc_id, txn5) left join p using (doc_id, txn5)
left join f using (doc_id, txn5, pos)
where not coalesce(i.transactiontypecode = '1001' and i.retailtypecode = '2006'
  and f.pos is not null
  and paid <> sale and abs(paid - sale) < 1 and i.salesamount = sale - paid, false)""",
)
def a3_first(t):
    items = t.items
    sums = corrections.txn_sums(items, t.tenders)
    return corrections.drop_rounding_items(items, sums, which="first").select(*LINE)


@register(
    "a4_align_flag",
    f"""{ctes('transactions', 'items', 'tenders')}, {_SUMS}
select t.doc_id, t.transactionsequencenumber, t.transactiontypecode,
  case when t.transactiontypecode like '10%' then coalesce(paid, 0) = coalesce(sale, 0) end
    as is_aligned_tran
from transactions t left join s using (doc_id, txn5) left join p using (doc_id, txn5)""",
)
def a4(t):
    return corrections.align_flag(t.transactions, t.items, t.tenders).select(
        "doc_id", "transactionsequencenumber", "transactiontypecode", "is_aligned_tran"
    )


@register(
    "a5_align_flag_strict",
    f"""{ctes('transactions', 'items', 'tenders')}, {_SUMS}
select t.doc_id, t.transactionsequencenumber, t.transactiontypecode,
  case when t.transactiontypecode like '10%' then paid = sale end as is_aligned_tran
from transactions t left join s using (doc_id, txn5) left join p using (doc_id, txn5)""",
)
def a5(t):
    return corrections.align_flag(t.transactions, t.items, t.tenders, "strict").select(
        "doc_id", "transactionsequencenumber", "transactiontypecode", "is_aligned_tran"
    )


# --- item codes ---------------------------------------------------------------


@register(
    "p21_item_normalise",
    f"""{ctes('items')}
select transactionsequencenumber, pos,
  case when retailtypecode = '2901' and not coalesce(retailquantity < 0, false) then '2001'
    else retailtypecode end as retailtypecode,
  case when retailtypecode = '2010' then null else itemidqualifier end as itemidqualifier
from items""",
)
def p21(t):
    return corrections.recode_items(t.items).select(*LINE, "retailtypecode", "itemidqualifier")


def _on(t: Tables, *names: str):
    return dictionaries.enabled(t.tvarvc, *names)


_RECODED = """
auto as (select distinct doc_id, txn5, retailsequencenumber, true as auto from item_ext
  where fieldgroup = 'POS' and fieldname = 'AUTO_MD' and fieldvalue = 'Y'),
coded as (select i.*, case
    when workstationid = '0000001000' and itemid = 'S003147' and transactiontypecode = '1016'
      then '2044'
    when workstationid = '0000001000' and itemid = 'S003147' and transactiontypecode = '1017'
      then '2831'
    when auto then '2043'
    when workstationid = '0000001000' and retailtypecode = '2804' then '2826'
    else retailtypecode end as new_code
  from items i left join auto using (doc_id, txn5, retailsequencenumber))"""


@register(
    "p22_item_recodes",
    f"""{ctes('items', 'item_ext')}, {_RECODED}
select transactionsequencenumber, pos, new_code as retailtypecode from coded
where retailtypecode <> '2020'""",
)
def p22(t):
    items = t.items.withColumns(
        {
            "has_ean": F.lit(None).cast("boolean"),
            "ean11": F.lit(None).cast("string"),
            "meinh": F.lit(None).cast("string"),
        }
    )
    staged = staging.stage_items(
        items, t.item_ext, _on(t, "2125781"), _on(t, "2525942"), _on(t, "2525942_2")
    )
    return staged.select(*LINE, "retailtypecode")


# Pack lookup in the checking database: one row per (material, units).
_PACKS = """
packs as (select matnr, umrez, min(struct_pack(miss := ean11 is null, ean := ean11, unit := meinh)) as best
  from marm join (select matnr, meinh, min(nullif(ean11, '')) as ean11 from mean
    where lfnum = '00001' group by all) using (matnr, meinh) group by all),
split as (select i.*, case when contains(itemid, 'UP')
    then lpad(split_part(itemid, 'UP', 1), 18, '0') end as matnr,
  case when contains(itemid, 'UP') then split_part(itemid, 'UP', 2) end as umrez from items i),
solved as (select s.*, packs.matnr is not null as mapped, best.ean as ean11, best.unit as meinh,
    nullif(mara.meins, '') as meins
  from split s left join packs using (matnr, umrez) left join mara on mara.matnr = s.matnr)"""


@register(
    "j1_pack_resolution",
    f"""{ctes('items', 'marm', 'mean', 'mara')}, {_PACKS}
select transactionsequencenumber, pos, coalesce(ean11, itemid) as itemid,
  case when ean11 is not null then '1' else itemidqualifier end as itemidqualifier,
  case when ean11 is not null then coalesce(meins, salesunitofmeasure)
    else salesunitofmeasure end as salesunitofmeasure,
  case when mapped then ean11 is not null end as has_ean,
  matnr is not null and ean11 is null as unresolved
from solved""",
)
def j1(t):
    return dictionaries.resolve_packs(t.items, t.marm, t.mean, t.mara).select(
        *LINE, "itemid", "itemidqualifier", "salesunitofmeasure", "has_ean", "unresolved"
    )


@register(
    "j2_dictionary_eans",
    f"""{ctes('items', 'marm', 'mean')},
w as (select distinct lpad(split_part(itemid, 'UP', 1), 18, '0') as matnr,
  split_part(itemid, 'UP', 2) as umrez from items where contains(itemid, 'UP'))
select matnr, meinh, umrez, ean11 from w join marm using (matnr, umrez)
join mean using (matnr, meinh) where ean11 <> ''""",
)
def j2(t):
    return dictionaries.dictionary_eans(t.items, t.marm, t.mean)


@register(
    "j3_unresolved_transactions",
    f"""{ctes('transactions', 'items', 'marm', 'mean', 'mara')}, {_PACKS}
select doc_id, transactionsequencenumber from transactions where (doc_id, txn_key) not in
  (select doc_id, txn_key from solved where matnr is not null and ean11 is null)""",
)
def j3(t):
    resolved = dictionaries.resolve_packs(t.items, t.marm, t.mean, t.mara)
    return dictionaries.drop_unresolved(t.transactions, resolved).select(
        "doc_id", "transactionsequencenumber"
    )


@register(
    "j4_empty_ean_children",
    f"""{ctes('items', 'item_discounts', 'marm', 'mean', 'mara')}, {_PACKS}
select transactionsequencenumber, pos, discountsequencenumber from item_discounts
where (doc_id, txn5, retailsequencenumber) not in
  (select doc_id, txn5, retailsequencenumber from solved where mapped and ean11 is null)""",
)
def j4(t):
    resolved = dictionaries.resolve_packs(t.items, t.marm, t.mean, t.mara)
    return dictionaries.drop_empty_ean_children(t.item_discounts, resolved).select(
        *LINE, "discountsequencenumber"
    )


@register(
    "j5_auto_markdown",
    f"""{ctes('items', 'item_ext')}
select transactionsequencenumber, pos from items where (doc_id, txn5, retailsequencenumber) in
  (select doc_id, txn5, retailsequencenumber from item_ext
   where fieldgroup = 'POS' and fieldname = 'AUTO_MD' and fieldvalue = 'Y')""",
)
def j5(t):
    lines = t.items.withColumn("line_key", cancel.line_key())
    return lines.join(staging.auto_md_items(t.item_ext), "line_key", "left_semi").select(*LINE)


@register(
    "p23_staged_items",
    f"""{ctes('items', 'item_ext', 'marm', 'mean', 'mara')}, {_PACKS}
select transactionsequencenumber, pos,
  case when transactiontypecode = '1014' and coalesce(ean11, itemid) is null then '0'
    else coalesce(ean11, itemid) end as itemid,
  case when transactiontypecode = '1014' and coalesce(ean11, itemid) is null then ''
    when ean11 is not null then '1' else itemidqualifier end as itemidqualifier,
  case when ean11 is not null then meinh else salesunitofmeasure end as salesunitofmeasure
from solved where retailtypecode <> '2020' and not (mapped and ean11 is null)""",
)
def p23(t):
    resolved = dictionaries.resolve_packs(t.items, t.marm, t.mean, t.mara)
    off = F.lit(False)
    return staging.stage_items(resolved, t.item_ext, off, off, off).select(
        *LINE, "itemid", "itemidqualifier", "salesunitofmeasure"
    )


# --- cancellations ------------------------------------------------------------


@register(
    "j13_cancelled_lines",
    f"""{ctes('items', 'item_ext')},
n as (select *, case when retailtypecode = '2901' and not coalesce(retailquantity < 0, false)
    then '2001' else retailtypecode end as code from items),
c as (select doc_id, txn5, itemid, -retailquantity as q, -salesamount as a, count(*) as k
  from n where code = '2901' and retailquantity < 0 and salesamount is not null group by all),
r as (select doc_id, txn5, pos, itemid, retailquantity as q, salesamount as a,
    row_number() over (partition by doc_id, txn5, itemid, retailquantity, salesamount order by pos) as rn
  from n where code <> '2902' and not (code = '2901' and retailquantity < 0)
    and salesamount is not null),
hit as (select r.doc_id, r.txn5, r.pos from r join c on r.doc_id = c.doc_id and r.txn5 = c.txn5
  and r.itemid is not distinct from c.itemid and r.q = c.q and r.a = c.a and rn <= k)
select transactionsequencenumber, n.pos, case when hit.pos is null then code else '2902' end
  as retailtypecode
from n left join hit using (doc_id, txn5, pos)""",
)
def j13(t):
    """Cancelling lines of this data have no marks of their own, so ranks decide."""
    items = corrections.recode_items(t.items)
    return cancel.cancel_items(items, t.item_ext).select(*LINE, "retailtypecode")


# Crowded variant: two articles, one price, marks on both sides of a cancellation.
_CROWD = """
crowd as (select doc_id, txn5, txn_key, retailstoreid, businessdaydate, transactiontypecode, workstationid,
    transactionsequencenumber, pos, retailsequencenumber, cast(pos % 2 as varchar) as itemid,
    case when retailsequencenumber % 2 = 0 then '2901' else '2001' end as retailtypecode,
    cast(case when retailsequencenumber % 2 = 0 then -1 else 1 end as decimal(32,3)) as retailquantity,
    cast(case when retailsequencenumber % 2 = 0 then -5 else 5 end as decimal(32,2)) as salesamount
  from items)"""


def _crowd(items):
    even = F.col("retailsequencenumber").cast("int") % 2 == 0
    return items.withColumns(
        {
            "itemid": (F.col("pos") % 2).cast("string"),
            "retailtypecode": F.when(even, "2901").otherwise("2001"),
            "retailquantity": F.when(even, -1).otherwise(1).cast("decimal(32,3)"),
            "salesamount": F.when(even, -5).otherwise(5).cast("decimal(32,2)"),
        }
    )


_MARKS = """
marks as (select doc_id, txn5, retailsequencenumber,
    string_agg(case when fieldgroup = 'TAX' then fieldvalue end, '' order by pos, fieldvalue) as tax,
    max_by(case when fieldname = 'DATAMATRIX' then fieldvalue end,
      case when fieldname = 'DATAMATRIX' then struct_pack(pos := pos, v := fieldvalue) end) as code
  from item_ext where fieldgroup = 'TAX' or fieldname = 'DATAMATRIX' group by all)"""


@register(
    "j13_cancelled_marked_lines",
    f"""{ctes('items', 'item_ext', recursive=True)},
{_CROWD.replace('retailsequencenumber % 2', 'cast(retailsequencenumber as int) % 2')}, {_MARKS},
m as (select crowd.*, coalesce(tax, '') as tax, coalesce(code, '') as code
  from crowd left join marks using (doc_id, txn5, retailsequencenumber)),
grp as (select doc_id, txn5, itemid,
    list(struct_pack(pos := pos, tax := tax, code := code) order by pos)
      filter (retailtypecode = '2901') as asks,
    list(struct_pack(pos := pos, tax := tax, code := code) order by pos)
      filter (retailtypecode = '2001') as sold
  from m group by all having asks is not null and sold is not null),
step as (
  select doc_id, txn5, itemid, asks, sold as free, cast([] as bigint[]) as taken, 1 as k from grp
  union all
  select doc_id, txn5, itemid, asks, list_filter(free, lambda x: x.pos <> pick),
    list_append(taken, pick), k + 1
  from (select *, coalesce(
      list_filter(free, lambda x: asks[k].tax <> '' and x.tax = asks[k].tax)[1].pos,
      list_filter(free, lambda x: asks[k].code <> '' and x.code = asks[k].code)[1].pos,
      free[1].pos) as pick from step where k <= len(asks)) where pick is not null),
hit as (select doc_id, txn5, unnest(taken) as pos from step
  qualify row_number() over (partition by doc_id, txn5, itemid order by k desc) = 1)
select transactionsequencenumber, crowd.pos,
  case when hit.pos is null then retailtypecode else '2902' end as retailtypecode
from crowd left join hit using (doc_id, txn5, pos)""",
)
def j13_marked(t):
    """Crowded groups with marks, where the order of the claims matters."""
    return cancel.cancel_items(_crowd(t.items), t.item_ext).select(*LINE, "retailtypecode")


@register(
    "j13_cancelled_enterprise",
    f"""{ctes('items', 'item_ext', recursive=True)},
{_CROWD.replace('retailsequencenumber % 2', 'cast(retailsequencenumber as int) % 2')},
marks as (select doc_id, txn5, retailsequencenumber,
    string_agg(case when fieldgroup = 'TAX' then fieldvalue end, '' order by pos, fieldvalue) as tax,
    max_by(fieldvalue, struct_pack(pos := pos, v := fieldvalue)) filter (fieldname = 'DATAMATRIX') as last_code,
    min_by(fieldvalue, struct_pack(pos := pos, v := fieldvalue)) filter (fieldname = 'DATAMATRIX') as first_code
  from item_ext where fieldgroup = 'TAX' or fieldname = 'DATAMATRIX' group by all),
m as (select crowd.*, coalesce(tax, '') as tax,
    coalesce(case when retailtypecode = '2901' then last_code else first_code end, '') as code
  from crowd left join marks using (doc_id, txn5, retailsequencenumber)),
grp as (select doc_id, txn5, itemid,
    list(struct_pack(pos := pos, tax := tax, code := code) order by pos)
      filter (retailtypecode = '2901') as asks,
    list(struct_pack(pos := pos, tax := tax, code := code) order by pos)
      filter (retailtypecode = '2001') as sold
  from m group by all having asks is not null and sold is not null),
step as (
  select doc_id, txn5, itemid, asks, sold as free, cast([] as bigint[]) as taken, 1 as k from grp
  union all
  select doc_id, txn5, itemid, asks,
    list_filter(free, lambda x: x.pos is distinct from one and x.pos is distinct from two),
    list_concat(taken, list_filter([one, two], lambda y: y is not null)), k + 1
  from (select *, case when one_tax is null and two_code is null then free[1].pos else one_tax end as one,
      two_code as two
    from (select *, list_filter(free, lambda x: asks[k].code <> '' and x.code = asks[k].code
        and x.pos is distinct from one_tax)[1].pos as two_code
      from (select *, list_filter(free, lambda x: asks[k].tax <> '' and x.tax = asks[k].tax)[1].pos as one_tax
        from step where k <= len(asks))))),
hit as (select doc_id, txn5, unnest(taken) as pos from step
  qualify row_number() over (partition by doc_id, txn5, itemid order by k desc) = 1)
select transactionsequencenumber, crowd.pos,
  case when hit.pos is null then retailtypecode else '2902' end as retailtypecode
from crowd left join hit using (doc_id, txn5, pos)""",
)
def j13_enterprise(t):
    """Both marks may claim, and a sold line is known by its first code."""
    return cancel.cancel_items(_crowd(t.items), t.item_ext, "enterprise").select(*LINE, "retailtypecode")


@register(
    "a9_line_marks",
    f"""{ctes('item_ext')}, {_MARKS}
select doc_id, txn5, retailsequencenumber, coalesce(tax, '') as tax_mark, code as code_mark
from marks""",
)
def a9(t):
    return with_txn_key(cancel.line_marks(t.item_ext)).select(
        "doc_id",
        "txn5",
        "retailsequencenumber",
        "tax_mark",
        "code_mark",
    )


# --- overrides ----------------------------------------------------------------


@register(
    "j12_online_workstation",
    f"""{ctes('items', 'txn_ext')},
o as (select distinct doc_id, txn5 from txn_ext
  where fieldname = 'SOURCE' and fieldvalue = '{ONLINE}')
select transactionsequencenumber, pos,
  case when o.doc_id is null then workstationid else '0000001002' end as workstationid
from items left join o using (doc_id, txn5)""",
)
def j12(t):
    return corrections.override_workstation(t.items, t.txn_ext, ONLINE).select(
        *LINE, "workstationid"
    )


# --- balancing tenders ----------------------------------------------------------

_WEB = f"""
w as (select distinct doc_id, txn_key from txn_ext
  where contains(fieldname, 'SOURCE') and contains(fieldvalue, '{ONLINE}'))"""


@register(
    "a6_synthetic_tenders",
    f"""{ctes('transactions', 'items', 'tenders', 'txn_ext')}, {_WEB},
s as (select doc_id, txn_key, sum(salesamount) as sale from items
  where retailtypecode <> '2020' group by all),
p as (select doc_id, txn_key, sum(tenderamount) as paid from tenders group by all)
select t.transactionsequencenumber, '3101' as tendertypecode,
  case when w.doc_id is null then t.workstationid else '0000001002' end as workstationid,
  case when p.doc_id is not null then '9' else '8' end as tendersequencenumber,
  cast(coalesce(sale, 0) - coalesce(paid, 0) as decimal(38,2)) as tenderamount
from transactions t left join s using (doc_id, txn_key) left join p using (doc_id, txn_key)
left join w using (doc_id, txn_key)
where transactiontypecode = '1014' and (
  (p.doc_id is not null and abs(coalesce(sale, 0) - coalesce(paid, 0)) >= 1)
  or (p.doc_id is null and s.doc_id is not null))""",
)
def a6(t):
    return _synthetic(t, "newest")


@register(
    "a7_synthetic_tenders_older",
    f"""{ctes('transactions', 'items', 'tenders', 'txn_ext')}, {_WEB},
s as (select doc_id, txn_key, sum(salesamount) as sale from items group by all),
p as (select doc_id, txn_key, sum(tenderamount) as paid from tenders group by all)
select t.transactionsequencenumber, '3101' as tendertypecode,
  case when w.doc_id is null then t.workstationid else '0000001002' end as workstationid,
  t.transactionsequencenumber as tendersequencenumber,
  cast(coalesce(sale, 0) - coalesce(paid, 0) as decimal(38,2)) as tenderamount
from transactions t left join s using (doc_id, txn_key) left join p using (doc_id, txn_key)
left join w using (doc_id, txn_key)
where transactiontypecode = '1014' and (
  (p.doc_id is not null and abs(coalesce(sale, 0) - coalesce(paid, 0)) >= 1)
  or (p.doc_id is null and coalesce(sale, 0) <> 0))""",
)
def a7(t):
    return _synthetic(t, "older")


def _synthetic(t: Tables, mode: str):
    rows = synthetic.synthetic_tenders(
        t.transactions, t.items, t.tenders, t.txn_ext, ONLINE, mode=mode
    )
    return rows.select(
        "transactionsequencenumber",
        "tendertypecode",
        "workstationid",
        "tendersequencenumber",
        F.col("tenderamount").cast("decimal(38,2)").alias("tenderamount"),
    )


@register(
    "a8_synthetic_tender_uniqueness",
    f"""{ctes('transactions', 'items', 'tenders', 'txn_ext')}, {_WEB},
s as (select doc_id, txn_key, sum(salesamount) as sale from items
  where retailtypecode <> '2020' group by all),
p as (select doc_id, txn_key, sum(tenderamount) as paid from tenders group by all)
select distinct t.doc_id, t.txn_key,
  cast(coalesce(sale, 0) - coalesce(paid, 0) as decimal(38,2)) as tenderamount
from transactions t left join s using (doc_id, txn_key) left join p using (doc_id, txn_key)
where transactiontypecode = '1014' and (
  (p.doc_id is not null and abs(coalesce(sale, 0) - coalesce(paid, 0)) >= 1)
  or (p.doc_id is null and s.doc_id is not null))""",
)
def a8(t):
    """Headers repeated in a document yield one balancing tender."""
    twice = synthetic.union_all(t.transactions, t.transactions)
    rows = synthetic.synthetic_tenders(twice, t.items, t.tenders, t.txn_ext, ONLINE)
    return rows.select("doc_id", "txn_key", "tenderamount")


@register(
    "u3_staged_tenders_with_synthetic",
    f"""{ctes('transactions', 'items', 'tenders', 'tender_ext', 'txn_ext')},
s as (select doc_id, txn_key, sum(salesamount) as sale from items
  where retailtypecode <> '2020' group by all),
p as (select doc_id, txn_key, sum(tenderamount) as paid from tenders group by all),
cert as (select distinct doc_id, txn_key from tender_ext
  where contains(fieldname, 'CERT_PARTY') and contains(fieldvalue, 'RU02'))
select transactionsequencenumber, tendersequencenumber,
  case when cert.doc_id is not null and tendertypecode = '3108' then '3123' else tendertypecode end
    as tendertypecode,
  cast(tenderamount as decimal(38,2)) as tenderamount
from tenders left join cert using (doc_id, txn_key)
union all
select t.transactionsequencenumber, case when p.doc_id is not null then '9' else '8' end, '3101',
  cast(coalesce(sale, 0) - coalesce(paid, 0) as decimal(38,2))
from transactions t left join s using (doc_id, txn_key) left join p using (doc_id, txn_key)
where transactiontypecode = '1014' and (
  (p.doc_id is not null and abs(coalesce(sale, 0) - coalesce(paid, 0)) >= 1)
  or (p.doc_id is null and s.doc_id is not null))""",
)
def u3(t):
    tenders = t.tenders
    staged = staging.stage_tenders(tenders, t.tender_ext)
    extra = synthetic.synthetic_tenders(t.transactions, t.items, tenders, t.txn_ext, ONLINE)
    return synthetic.union_all(staged, extra).select(
        "transactionsequencenumber",
        "tendersequencenumber",
        "tendertypecode",
        F.col("tenderamount").cast("decimal(38,2)").alias("tenderamount"),
    )


# --- certificates and operators -----------------------------------------------------


def _cert_sql(keys: str, test: str) -> str:
    return f"""{ctes('tenders', 'tender_ext')},
c as (select distinct {keys} from tender_ext where contains(fieldname, 'CERT_PARTY') and {test})
select transactionsequencenumber, tendersequencenumber,
  case when tendertypecode = '3108' and ({keys}) in (select ({keys}) from c) then '3123'
    else tendertypecode end as tendertypecode
from tenders"""


def _cert(t: Tables, scope: str):
    return staging.apply_cert_party(t.tenders, t.tender_ext, scope).select(
        "transactionsequencenumber", "tendersequencenumber", "tendertypecode"
    )


@register("j6_cert_party", _cert_sql("doc_id, txn_key", "contains(fieldvalue, 'RU02')"))
def j6(t):
    return _cert(t, "txn")


@register("j6_cert_party_document", _cert_sql("doc_id", "contains(fieldvalue, 'RU02')"))
def j6_document(t):
    return _cert(t, "document")


@register(
    "j6_cert_party_tender",
    f"""{ctes('tenders', 'tender_ext')},
p as (select doc_id, txn_key, tendersequencenumber, min_by(fieldvalue, pos) as party
  from tender_ext where fieldname = 'CERT_PARTY' group by all),
f as (select doc_id, txn_key, min(pos) as pos from tenders where tendertypecode = '3108' group by all)
select transactionsequencenumber, tendersequencenumber,
  case when tendertypecode = '3108' and starts_with(upper(p.party), 'RU02') and f.pos is not null
    then '3123' else tendertypecode end as tendertypecode
from tenders left join p using (doc_id, txn_key, tendersequencenumber)
left join f using (doc_id, txn_key, pos)""",
)
def j6_tender(t):
    return _cert(t, "tender")


@register(
    "j8_operator_copy",
    f"""{ctes('txn_discounts', 'transactions')}
select d.transactionsequencenumber, d.discountsequencenumber, t.operatorid
from txn_discounts d left join transactions t using (doc_id, txn_key)""",
)
def j8(t):
    return staging.copy_operator(t.txn_discounts, t.transactions).select(
        "transactionsequencenumber", "discountsequencenumber", "operatorid"
    )


@register(
    "j9_source_descriptions",
    f"""{ctes('txn_ext', 'export')}
select transactionsequencenumber, pos, coalesce(description, fieldvalue) as fieldvalue
from txn_ext left join export on contains(fieldname, 'CH_SOURCE')
  and try_cast(trim(fieldvalue) as int) = reasoncode""",
)
def j9(t):
    return dictionaries.describe_source(t.txn_ext, t.export).select(*LINE, "fieldvalue")


_SWITCHED = f"""{ctes('transactions', 'items', 'tenders', 'txn_ext', 'tender_ext')},
u as (select distinct doc_id, txn_key from items left join
  (select doc_id, txn_key, sum(tenderamount) as paid from tenders group by all)
  using (doc_id, txn_key) where coalesce(paid, 0) = 0),
o as (select distinct doc_id, txn5 from txn_ext where fieldname = 'SOURCE' and fieldvalue = 'web.store'),
p as (select doc_id, txn_key, tendersequencenumber, min_by(fieldvalue, pos) as party
  from tender_ext where fieldname = 'CERT_PARTY' group by all),
f as (select doc_id, txn_key, min(pos) as pos, true as first from tenders
  where tendertypecode = '3108' group by all),
c as (select t.* replace (case when tendertypecode = '3108' and starts_with(upper(party), 'RU02')
    and first then '3123' else tendertypecode end as tendertypecode), party
  from tenders t left join p using (doc_id, txn_key, tendersequencenumber)
  left join f using (doc_id, txn_key, pos)),
k as (select doc_id, txn_key, bool_or(tendertypecode = 'OPT') as opt,
  min(pos) filter (tendertypecode = 'RET') as first_ret from c group by all)
select 'off' as state, 'transaction' as kind, transactionsequencenumber, cast(0 as bigint) as pos,
  transactiontypecode as value, workstationid as other from transactions
union all select 'on', 'transaction', transactionsequencenumber, 0,
  case when transactiontypecode = '1015' and u.doc_id is not null then '1014' else transactiontypecode end,
  case when o.doc_id is not null then '0000001002' else workstationid end
from transactions left join u using (doc_id, txn_key) left join o using (doc_id, txn5)
union all select 'off', 'item', transactionsequencenumber, pos, itemid, null from items
union all select 'on', 'item', transactionsequencenumber, pos,
  case when transactiontypecode = '1015' and coalesce(itemid, '') = '' then 'S001332' else itemid end, null
from items
union all select 'off', 'tender', transactionsequencenumber, pos, tendertypecode, null from tenders
union all select 'on', 'tender', transactionsequencenumber, pos, case
  when transactiontypecode <> '1001' then tendertypecode
  when tendertypecode = 'OPT' and upper(party) like 'RU02%' then '3123'
  when tendertypecode = 'OPT' and upper(party) like 'RU06%' then '3108'
  when not coalesce(opt, false) and tendertypecode = 'RET' and pos = first_ret then '3110'
  else tendertypecode end, null
from c left join k using (doc_id, txn_key)"""


@register("j10_switched_rules", _SWITCHED)
def j10(t):
    """The enterprise rules over all rows, once with their switches off and once on."""
    rules = (erp.CASHOUT, erp.ONLINE, erp.CERTIFICATE, erp.EMPTY_LINE, erp.TENDER_CODES)
    more = t.tvarvc.limit(1).select(
        F.lit("CHK_FIXES").alias("name"),
        F.lit("S").alias("type"),
        F.explode(F.array(*[F.lit(r) for r in rules])).alias("low"),
    )
    out = None
    for state, flags in (("off", t.tvarvc), ("on", t.tvarvc.unionByName(more))):
        txns = erp.switched_transactions(
            t.transactions, t.items, t.tenders, t.txn_ext, flags, "web.store"
        )
        rows = [
            ("transaction", txns.withColumn("pos", F.lit(0).cast("bigint")), "transactiontypecode", "workstationid"),
            ("item", erp.switched_items(t.items, flags), "itemid", None),
            ("tender", erp.switched_tenders(t.tenders, t.items, t.tender_ext, flags), "tendertypecode", None),
        ]
        for kind, df, value, other in rows:
            shown = df.select(
                F.lit(state).alias("state"),
                F.lit(kind).alias("kind"),
                "transactionsequencenumber",
                "pos",
                F.col(value).alias("value"),
                (F.col(other) if other else F.lit(None).cast("string")).alias("other"),
            )
            out = shown if out is None else out.unionByName(shown)
    return out


# --- movements ---------------------------------------------------------------------

_NOTES = """
notes as (select doc_id, txn_key, max_by(fieldvalue, pos) as note from txn_ext
  where contains(fieldname, 'DOCNUMBER') group by all)"""


@register(
    "j7_last_notes",
    f"""{ctes('movements', 'txn_ext')}, {_NOTES}
select transactionsequencenumber, financialsequencenumber, note
from movements left join notes using (doc_id, txn_key)""",
)
def j7(t):
    return t.movements.join(staging.last_notes(t.txn_ext), TXN, "left").select(
        "transactionsequencenumber", "financialsequencenumber", "note"
    )


@register(
    "p24_movement_reversal",
    f"""{ctes('movements', 'txn_ext')}, {_NOTES},
r as (select *, coalesce(substr(note, 2, 1) = '2'
    and financialtypecode not in ('3169', '3170'), false) as rev
  from movements left join notes using (doc_id, txn_key))
select transactionsequencenumber, financialsequencenumber,
  case when rev then -try_cast(amount as decimal(32,2)) else try_cast(amount as decimal(32,2)) end
    as amount,
  case when rev then substr(note, 1, 1) || '1' || substr(note, 3) end as refererenceid
from r""",
)
def p24(t):
    return staging.stage_movements(t.movements, staging.last_notes(t.txn_ext)).select(
        "transactionsequencenumber", "financialsequencenumber", "amount", "refererenceid"
    )


@register(
    "a10_storno_extensions",
    f"""{ctes('movements', 'txn_ext')}, {_NOTES}
select transactionsequencenumber, transactiontypecode, 'STORNO' as fieldname,
  substr(note, 1, 1) || '1' || substr(note, 3) as fieldvalue
from movements join notes using (doc_id, txn_key)
where substr(note, 2, 1) = '2' and financialtypecode not in ('3169', '3170')""",
)
def a10(t):
    return synthetic.storno_extensions(t.movements, staging.last_notes(t.txn_ext)).select(
        "transactionsequencenumber", "transactiontypecode", "fieldname", "fieldvalue"
    )


# --- enterprise rules ----------------------------------------------------------------


@register(
    "p27_cashout_recode",
    f"""{ctes('transactions', 'items', 'tenders')},
u as (select doc_id, txn_key from items left join
  (select doc_id, txn_key, sum(tenderamount) as paid from tenders group by all)
  using (doc_id, txn_key) where coalesce(paid, 0) = 0)
select transactionsequencenumber, case when transactiontypecode = '1015'
  and (doc_id, txn_key) in (select (doc_id, txn_key) from u) then '1014'
  else transactiontypecode end as transactiontypecode from transactions""",
)
def p27(t):
    return erp.recode_cashout(t.transactions, t.items, t.tenders).select(
        "transactionsequencenumber", "transactiontypecode"
    )


@register(
    "p28_empty_item",
    f"""{ctes('items')},
e as (select *, transactiontypecode = '1015' and coalesce(itemid, '') = '' as empty from items)
select transactionsequencenumber, pos, case when empty then 'S001332' else itemid end as itemid,
  case when empty then 'S001332' end as materialnumber,
  case when empty then 'SERV106' end as merchandisecat, case when empty then 'ST' end as baseuom
from e""",
)
def p28(t):
    return erp.fill_empty_item(t.items).select(
        *LINE, "itemid", "materialnumber", "merchandisecat", "baseuom"
    )


@register(
    "p29_tender_recodes",
    f"""{ctes('tenders', 'tender_ext')},
k as (select doc_id, txn_key, bool_or(tendertypecode = 'OPT') as opt,
  min(pos) filter (tendertypecode = 'RET') as first_ret from tenders group by all),
c as (select doc_id, txn_key, tendersequencenumber, min_by(fieldvalue, pos) as party
  from tender_ext where fieldname = 'CERT_PARTY' group by all)
select transactionsequencenumber, tendersequencenumber, case
  when transactiontypecode <> '1001' then tendertypecode
  when tendertypecode = 'OPT' and upper(party) like 'RU02%' then '3123'
  when tendertypecode = 'OPT' and upper(party) like 'RU06%' then '3108'
  when not opt and tendertypecode = 'RET' and pos = first_ret then '3110'
  else tendertypecode end as tendertypecode
from tenders left join k using (doc_id, txn_key)
left join c using (doc_id, txn_key, tendersequencenumber)""",
)
def p29(t):
    return erp.recode_tenders(t.tenders, t.tender_ext).select(
        "transactionsequencenumber", "tendersequencenumber", "tendertypecode"
    )


@register(
    "p30_single_tender",
    f"""{ctes('tenders', 'items')},
s as (select doc_id, txn_key, coalesce(sum(salesamount), 0) as sale from items group by all),
p as (select doc_id, txn_key, sum(tenderamount) as paid, count(*) as n from tenders group by all)
select transactionsequencenumber, tendersequencenumber,
  cast(case when transactiontypecode = '1001' and n = 1 and paid < 0 and sale > 0 then sale
    else tenderamount end as decimal(38,2)) as tenderamount
from tenders left join s using (doc_id, txn_key) left join p using (doc_id, txn_key)""",
)
def p30(t):
    return erp.fix_single_tender(t.tenders, t.items).select(
        "transactionsequencenumber", "tendersequencenumber", "tenderamount"
    )


_FAKED = """select case when o_orderkey % 50 = 3 then -o_orderkey else floor(o_orderkey / 5) end
  as doc, o_orderkey, case when o_orderkey % 50 in (3, 4) then 'FAKE' else 'REAL' end as kind
from orders"""


@register(
    "p31_fake_documents",
    f"""with f as ({_FAKED})
select cast(doc as bigint) as doc_id, o_orderkey, kind as transactiontypecode from f
where doc not in (select doc from f group by doc having count(*) = 1 and max(kind) = 'FAKE')""",
)
def p31(t):
    k = F.col("o_orderkey")
    faked = t.table("orders").select(
        F.when(k % 50 == 3, -k).otherwise(F.floor(k / 5)).cast("bigint").alias("doc_id"),
        "o_orderkey",
        F.when((k % 50).isin(3, 4), "FAKE").otherwise("REAL").alias("transactiontypecode"),
    )
    return erp.drop_fake_documents(faked)


_CLOSINGS = """
closings as (select retailstoreid, businessdaydate, max(begindatetimestamp) as closedate
  from transactions where transactiontypecode = '1601' and begindatetimestamp is not null group by all)"""

# A load unit is one store and business day; orders give the order within it.
_UNIT = "dense_rank() over (order by retailstoreid, businessdaydate)"


@register(
    "j14_virtual_day",
    f"""{ctes('transactions')}, {_CLOSINGS},
u as (select t.*, strftime(strptime(businessdaydate, '%Y%m%d') - interval 1 day, '%Y%m%d') as yday
  from transactions t),
d as (select u.*, case when
    (substr(closedate, 1, 8) = yday and substr(closedate, 9, 6) > '060000') or
    (substr(closedate, 1, 8) = u.businessdaydate and substr(closedate, 9, 6) < '060000')
    then closedate else u.businessdaydate || '060000' end as deadline,
  coalesce(substr(begindatetimestamp, 9, 6) < '060000'
    and substr(begindatetimestamp, 1, 8) = u.businessdaydate
    and u.retailstoreid <> '0007', false) as early
  from u left join closings c on c.retailstoreid = u.retailstoreid and c.businessdaydate = yday),
m as (select d.*,
  min(case when early and transactiontypecode = '1601' and workstationid = '0000000000'
    then begindatetimestamp end) over (partition by retailstoreid, businessdaydate order by pos
    rows between unbounded preceding and 1 preceding) as before_min,
  min(case when early and transactiontypecode = '1601' and workstationid = '0000000000'
    then begindatetimestamp end) over (partition by retailstoreid, businessdaydate) as all_min
  from d)
select transactionsequencenumber, transactiontypecode, coalesce(early and case
    when transactiontypecode = '1601' then begindatetimestamp <= least(deadline, before_min)
    when transactiontypecode in ('1301', '1302', '1305')
      or (transactiontypecode like '10%' and transactiontypecode <> '1016')
      then begindatetimestamp <= least(deadline, all_min)
    else false end, false) as moved
from m""",
)
def j14(t):
    """Load units are store and business day; yesterday's closings come from the data."""
    txns = t.transactions
    unit = txns.withColumns({"store": F.col("retailstoreid"), "day": F.col("businessdaydate")})
    closed = (
        txns.where("transactiontypecode = '1601' and begindatetimestamp is not null")
        .groupBy("retailstoreid", "businessdaydate")
        .agg(F.max("begindatetimestamp").alias("closedate"))
    )
    return erp.shift_virtual_day(
        unit, closed, "060000", ("1016",), ("0007",), doc=["store", "day"]
    ).select("transactionsequencenumber", "transactiontypecode", "moved")


@register(
    "j15_rededup",
    f"""{ctes('transactions', 'txn_ext')},
o as (select distinct doc_id, txn5 from txn_ext
  where fieldname = 'SOURCE' and fieldvalue = '{ONLINE}'),
r as (select pos, retailstoreid || '|' || businessdaydate || '|' ||
    case when o.doc_id is null then workstationid else '0000001002' end as key
  from transactions left join o using (doc_id, txn5)),
h as (select distinct retailstoreid || '|' || businessdaydate || '|' || workstationid as key
  from transactions where businessdaydate >= '20010601')
select min(pos) as pos, key from r where key not in (select key from h) group by key""",
)
def j15(t):
    """Store, day and the rewritten workstation are the key; the last days are stored."""
    key = F.concat_ws("|", "retailstoreid", "businessdaydate", "workstationid")
    txns = t.transactions
    moved = corrections.override_workstation(txns, t.txn_ext, ONLINE).select(
        "pos", key.alias("key")
    )
    stored = txns.where("businessdaydate >= '20010601'").select(key.alias("key")).distinct()
    return rededup(moved, stored, order=["pos"], key="key")


_NUMBERS = f"""{ctes('movements', 'txn_ext')},
f as (select doc_id, txn_key, min_by(retailstoreid, pos) as plant,
  min_by(coalesce(financialtypecode, ''), pos) as kind from movements group by all),
n as (select doc_id, txn_key, min_by(fieldvalue, pos) as note from txn_ext
  where transactiontypecode is not null and contains(fieldname, 'DOCNUMBER') group by all),
h as (select plant, substr(kind, 1, 2) as doctype, max(substr(note, 3)) as candidate
  from f join n using (doc_id, txn_key) where kind in ('3100', '3200') group by all),
c as (select distinct retailstoreid as plant, unnest(['31', '32', '33']) as doctype,
  '00050000' as maxnumber from movements)
select plant, doctype, greatest(maxnumber, candidate) as maxnumber
from c left join h using (plant, doctype)"""


def _first_numbers(movements):
    return movements.select(F.col("retailstoreid").alias("plant")).distinct().select(
        "plant",
        F.explode(F.array(F.lit("31"), F.lit("32"), F.lit("33"))).alias("doctype"),
        F.lit("00050000").alias("maxnumber"),
    )


@register("a13_document_numbers", _NUMBERS)
def a13(t):
    movements = t.movements
    notes = staging.prepare_txn_extensions(t.txn_ext)
    return erp.max_document_numbers(movements, notes, _first_numbers(movements))


@register("a13_stored_numbers", _NUMBERS)
def a13_stored(t):
    """Two loads raise a stored table, the first is then repeated and raises nothing."""
    movements, notes = t.movements, staging.prepare_txn_extensions(t.txn_ext)
    path = tables.shared_dir(t.spark, "numbers")
    erp.store_document_numbers(_first_numbers(movements), path)
    for part in (0, 1, 0):
        mine = (F.col("doc_id") % 2) == part
        erp.raise_document_numbers(movements.where(mine), notes.where(mine), path)
    return erp.stored_document_numbers(t.spark, path).select("plant", "doctype", "maxnumber")
