"""Scans, targets, history, reports, documents."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F, types as T

from tillstream.operators import audit, dictionaries, history, outbound, staging, synthetic
from tillstream.plans import schemas
from tillstream.queries.catalog import KEY, Tables, ctes, register
from tillstream.sources import documents, messages, tables

LOAD = datetime(2024, 5, 6, 7, 8, 9)
LINE = ["transactionsequencenumber", "pos"]

# --- routing and projection ---------------------------------------------------------

# Segments of the fixtures, tagged with their names.
_TAGGED = """
flat as (
  select 'E1BPTRANSACTION' as segment_name, txn_key from transactions
  union all select 'E1BPTENDER', txn_key from tenders
  union all select 'E1BPTRANSACTEXTENSIO', txn_key from txn_ext
  union all select 'E1BPTRANSACTIONDISCO', txn_key from txn_discounts
  union all select 'E1BPFINANCIALMOVEMEN', txn_key from movements
  union all select 'E1UNKNOWN', txn_key from movement_ext)"""
_NAMES = {
    "transactions": "E1BPTRANSACTION",
    "tenders": "E1BPTENDER",
    "txn_ext": "E1BPTRANSACTEXTENSIO",
    "txn_discounts": "E1BPTRANSACTIONDISCO",
    "movements": "E1BPFINANCIALMOVEMEN",
    "movement_ext": "E1UNKNOWN",
}


def _flat(t: Tables):
    return synthetic.union_all(
        *[
            getattr(t, f).select(F.lit(n).alias("segment_name"), "txn_key")
            for f, n in _NAMES.items()
        ]
    )


@register(
    "p1_routing",
    f"""{ctes(*_NAMES)}, {_TAGGED}
select case when segment_name = 'E1UNKNOWN' then 'quarantine'
  else 'raw_' || lower(substr(segment_name, 3)) end as target, txn_key, count(*) as rows_routed
from flat group by all""",
)
def p1(t):
    """Every row takes its segment's route; unknown names go to the quarantine."""
    flat = _flat(t)
    routed = [
        staging.route(flat, s).select(F.lit(table).alias("target"), "txn_key")
        for s, table in schemas.RAW_TABLES.items()
        if s in _NAMES.values()
    ]
    unknown = staging.unknown_segments(flat).select(F.lit("quarantine").alias("target"), "txn_key")
    return (
        synthetic.union_all(*routed, unknown)
        .groupBy("target", "txn_key")
        .agg(F.count(F.lit(1)).alias("rows_routed"))
    )


_TXN_TARGET = T.StructType(
    [
        T.StructField("transactionsequencenumber", T.IntegerType()),
        T.StructField("businessdaydate", T.DateType()),
        T.StructField("begindatetimestamp", T.TimestampNTZType()),
        T.StructField("enddatetimestamp", T.StringType()),
        T.StructField("operatorid", T.IntegerType()),
        T.StructField("partnerid", T.DecimalType(32, 2)),
        T.StructField("units", T.DecimalType(32, 3)),
        T.StructField("load_ts", T.TimestampNTZType()),
        T.StructField("load_date_xml", T.DateType()),
    ]
)


@register(
    "s6_project_to_target",
    f"""{ctes('transactions')}
select cast(transactionsequencenumber as int) as transactionsequencenumber,
  strftime(strptime(businessdaydate, '%Y%m%d'), '%Y-%m-%d') as businessdaydate,
  strftime(strptime(begindatetimestamp, '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S') as begindatetimestamp,
  strftime(strptime(enddatetimestamp, '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S') as enddatetimestamp,
  cast(operatorid as int) as operatorid, cast(partnerid as decimal(32,2)) as partnerid,
  cast(null as decimal(32,3)) as units, '2024-05-06 07:08:09' as load_ts,
  '2024-05-06' as load_date_xml
from transactions""",
)
def s6(t):
    """One target schema decides all conversions; absent columns stay null."""
    out = staging.project_to(t.transactions, _TXN_TARGET, LOAD)
    return out.withColumns(
        {
            "businessdaydate": F.col("businessdaydate").cast("string"),
            "begindatetimestamp": F.date_format("begindatetimestamp", "yyyy-MM-dd HH:mm:ss"),
            "load_ts": F.date_format("load_ts", "yyyy-MM-dd HH:mm:ss"),
            "load_date_xml": F.col("load_date_xml").cast("string"),
        }
    )


def _staged(t: Tables, segment: str, df):
    """Staged rows without their hashes, days as text, for comparison."""
    schema = schemas.staged_schema(segment)
    plain = T.StructType([f for f in schema if not f.name.endswith("_rk")])
    out = staging.project_to(df, plain, LOAD, keep=["doc_id"])
    days = [f.name for f in plain if isinstance(f.dataType, (T.DateType, T.TimestampNTZType))]
    return out.withColumns({d: F.col(d).cast("string") for d in days})


_LOADED = (
    "'2024-05-06 07:08:09' as load_ts, '2024-05-06' as load_date_xml, "
    "'2024-05-06 07:08:09' as load_ts_xml"
)
_HEAD = """retailstoreid, transactionsequencenumber, transactiontypecode, workstationid,
  strftime(strptime(businessdaydate, '%Y%m%d'), '%Y-%m-%d') as businessdaydate"""


@register(
    "p25_staged_tenders",
    f"""{ctes('tenders', 'tender_ext')},
c as (select distinct doc_id, txn_key from tender_ext
  where contains(fieldname, 'CERT_PARTY') and contains(fieldvalue, 'RU02'))
select tenders.doc_id, {_HEAD}, tendersequencenumber, tendercurrency,
  cast(null as varchar) as tendercurrency_iso, tenderid, cast(null as varchar) as accountnumber,
  cast(null as varchar) as refererenceid, cast(null as boolean) as is_aligned_tran,
  case when c.doc_id is not null and tendertypecode = '3108' then '3123' else tendertypecode end
    as tendertypecode,
  cast(tenderamount as decimal(38,2)) as tenderamount, {_LOADED}
from tenders left join c using (doc_id, txn_key)""",
)
def p25_tenders(t):
    return _staged(t, "E1BPTENDER", staging.stage_tenders(t.tenders, t.tender_ext))


@register(
    "p25_staged_movement_extensions",
    f"""{ctes('movement_ext')}
select doc_id, {_HEAD}, substr(fieldgroup, 1, 5) as fieldgroup,
  substr(fieldname, 1, 10) as fieldname, fieldvalue, {_LOADED} from movement_ext""",
)
def p25_movement_ext(t):
    return _staged(t, "E1BPFINACIALMOVEMENT", staging.stage_movement_extensions(t.movement_ext))


@register(
    "p25_staged_transaction_extensions",
    f"""{ctes('txn_ext')}
select doc_id, {_HEAD}, substr(fieldgroup, 1, 5) as fieldgroup,
  case when contains(fieldname, 'DOCNUMBER') then 'NOTE'
    when contains(fieldname, 'ReceiptNum') then 'DOCNUMBER'
    else substr(fieldname, 1, 10) end as fieldname,
  case when contains(fieldname, 'MobileNum') then null
    when contains(fieldname, 'ReceiptNum') then substr(fieldvalue, 1, 10)
    else substr(fieldvalue, 1, 40) end as fieldvalue,
  cast(null as boolean) as is_aligned_tran, {_LOADED}
from txn_ext where transactiontypecode is not null""",
)
def p25_txn_ext(t):
    return _staged(t, "E1BPTRANSACTEXTENSIO", staging.stage_txn_extensions(t.txn_ext))


@register(
    "p25_copied_columns",
    f"""{ctes('transactions')}
select operatorid, transactioncurrency, retailstoreid, transactionsequencenumber,
  transactiontypecode, workstationid from transactions""",
)
def p25_copied(t):
    return staging.select_staged(t.transactions, "pst_bptransaction")


@register(
    "p26_passthrough",
    f"""{ctes('item_ext', 'item_discounts')}
select 'ext' as kind, transactionsequencenumber, retailsequencenumber, pos,
  substr(fieldname, 1, 10) as a, fieldvalue as b from item_ext
union all
select 'discount', transactionsequencenumber, retailsequencenumber, pos, discounttypecode,
  reductionamount from item_discounts""",
)
def p26(t):
    def rows(kind, segment, df, a, b):
        prepared = staging.prepare(df, segment)
        return prepared.select(
            F.lit(kind).alias("kind"),
            "transactionsequencenumber",
            "retailsequencenumber",
            "pos",
            F.col(a).alias("a"),
            F.col(b).alias("b"),
        )

    return rows(
        "ext", "E1BPLINEITEMEXTENSIO", t.item_ext, "fieldname", "fieldvalue"
    ).unionByName(
        rows(
            "discount",
            "E1BPLINEITEMDISCOUNT",
            t.item_discounts,
            "discounttypecode",
            "reductionamount",
        )
    )


# --- scans and history ------------------------------------------------------------


@register(
    "s7_history_scan",
    f"""{ctes('transactions')}
select distinct txn_key from transactions
where strptime(businessdaydate, '%Y%m%d') >= (select max(strptime(businessdaydate, '%Y%m%d'))
  - interval 90 day from transactions)""",
)
def s7(t):
    """The window of a laid-out history; these days span years, so folders are months."""
    stored = t.transactions.withColumn(
        "businessdaydate", F.to_date("businessdaydate", "yyyyMMdd")
    )
    path = tables.shared_dir(t.spark, "history")
    history.lay_out(stored, path, "month", HISTORY_BUCKETS)
    newest = stored.agg(F.max("businessdaydate")).first()[0]
    return history.laid_out_keys(t.spark, path, newest - timedelta(90), "month", HISTORY_BUCKETS).distinct()


HISTORY_BUCKETS = 8


def history_of(t: Tables):
    """What the history queries take as stored before."""
    day = F.to_date("businessdaydate", "yyyyMMdd")
    return t.transactions.where("transactiontypecode <> '1001'").withColumn("businessdaydate", day)


@register(
    "j11_stored_history",
    f"""{ctes('transactions')},
h as (select distinct txn_key from transactions where businessdaydate >= '19980101'
  and transactiontypecode <> '1001')
select transactionsequencenumber from transactions where txn_key not in (select txn_key from h)""",
)
def j11_stored(t):
    """The same against a laid-out history, which two loads have filled."""
    path = tables.shared_dir(t.spark, "history")
    for part in (0, 1):
        mine = history_of(t).where((F.col("doc_id") % 2) == part)
        history.lay_out(mine, path, "month", HISTORY_BUCKETS)
    seen = history.laid_out_keys(t.spark, path, date(1998, 1, 1), "month", HISTORY_BUCKETS)
    return history.drop_seen(t.transactions, seen).select("transactionsequencenumber")


@register(
    "j11_history_dedup",
    f"""{ctes('transactions')},
h as (select distinct txn_key from transactions where businessdaydate >= '19980101'
  and transactiontypecode <> '1001')
select transactionsequencenumber from transactions where txn_key not in (select txn_key from h)""",
)
def j11(t):
    txns = t.transactions
    stored = txns.where("transactiontypecode <> '1001'").withColumn(
        "businessdaydate", F.to_date("businessdaydate", "yyyyMMdd")
    )
    recent = history.history_rows(stored, 0, F.lit("1998-01-01").cast("date"))
    return history.drop_seen(txns, history.keys_of(recent)).select("transactionsequencenumber")


# A raw discount-extension table whose load time is the event time.
_RAW_EXT = """
raw as (select event_id, lpad(cast(user_id as varchar), 4, '0') as retailstoreid,
  cast(ts as date) as businessdaydate, 'LONGGROUP' as fieldgroup,
  'A_RATHER_LONG_' || event_type as fieldname, props as fieldvalue,
  case when event_id % 9 = 0 then 'x' else cast(event_id % 5 as varchar) end
    as discountsequencenumber, ts as load_ts_xml, cast(ts as date) as load_date_xml
  from events)"""


def _raw_ext(t: Tables):
    e = t.table("events")
    return e.select(
        "event_id",
        F.lpad(F.col("user_id").cast("string"), 4, "0").alias("retailstoreid"),
        F.col("ts").cast("date").alias("businessdaydate"),
        F.lit("LONGGROUP").alias("fieldgroup"),
        F.concat(F.lit("A_RATHER_LONG_"), "event_type").alias("fieldname"),
        F.col("props").alias("fieldvalue"),
        F.lit("W").alias("workstationid"),
        F.col("event_id").cast("string").alias("transactionsequencenumber"),
        F.when(F.col("event_id") % 9 == 0, "x")
        .otherwise((F.col("event_id") % 5).cast("string"))
        .alias("discountsequencenumber"),
        F.lit("1001").alias("transactiontypecode"),
        F.col("ts").alias("load_ts"),
        F.col("ts").alias("load_ts_xml"),
        F.col("ts").cast("date").alias("load_date_xml"),
    )


@register(
    "s11_incremental_append",
    f"""with {_RAW_EXT}, target as (select * from raw where load_ts_xml < timestamp '2024-01-16')
select cast(event_id as varchar) as transactionsequencenumber,
  substr(fieldgroup, 1, 5) as fieldgroup, substr(fieldname, 1, 15) as fieldname, fieldvalue,
  try_cast(discountsequencenumber as int) as discountsequencenumber
from raw where load_ts_xml > (select max(load_ts_xml) from target)
  and load_date_xml >= (select max(load_date_xml) from target)""",
)
def s11(t):
    raw = history.discount_ext_model(_raw_ext(t))
    target = raw.where("load_ts_xml < timestamp_ntz'2024-01-16'")
    return history.incremental_new_rows(raw, target).select(
        "transactionsequencenumber",
        "fieldgroup",
        "fieldname",
        "fieldvalue",
        "discountsequencenumber",
    )


@register(
    "s11_appended",
    f"""with {_RAW_EXT}
select cast(event_id as varchar) as transactionsequencenumber, fieldvalue,
  strftime(load_date_xml, '%Y-%m-%d') as load_date_xml from raw""",
)
def s11_appended(t):
    """A growing source appended again and again; each time only what is newer is added."""
    raw = history.discount_ext_model(_raw_ext(t))
    path = tables.shared_dir(t.spark, "appended")
    for day in (8, 16, 16, 24, 40):
        until = datetime(2024, 1, 1) + timedelta(day - 1)
        history.append_incremental(t.spark, raw.where(F.col("load_ts_xml") < F.lit(until)), path)
    history.append_incremental(t.spark, raw, path)
    stored = t.spark.read.schema(raw.schema).parquet(path)
    return stored.select(
        "transactionsequencenumber", "fieldvalue", F.col("load_date_xml").cast("string").alias("load_date_xml")
    )


@register(
    "s12_discount_model",
    f"""{ctes('txn_discounts')}
select strftime(strptime(businessdaydate, '%Y%m%d'), '%Y-%m-%d') as businessdaydate,
  discountsequencenumber, discounttypecode, reductionamount, retailstoreid,
  transactionsequencenumber, transactiontypecode, workstationid, '2024-05-06' as load_date
from txn_discounts""",
)
def s12(t):
    """The model over the wide table; other segments are filtered out first."""
    iso = F.date_format(F.to_date("businessdaydate", "yyyyMMdd"), "yyyy-MM-dd")
    wide = synthetic.union_all(
        t.txn_discounts.withColumn("segment_name", F.lit("E1BPTRANSACTIONDISCO")),
        t.txn_ext.withColumn("segment_name", F.lit("E1BPTRANSACTEXTENSIO")),
    ).withColumns({"businessdaydate": iso, "load_ts": F.lit(LOAD).cast("timestamp_ntz")})
    model = history.discount_model(wide)
    days = {d: F.col(d).cast("string") for d in ("businessdaydate", "load_date")}
    return model.withColumns(days).drop("rtl_txn_rk", "rtl_txn_disc_rk", "load_ts")


@register(
    "s13_dictionary_refresh",
    f"""{ctes('items', 'marm', 'mean', 'mara')},
k as (select distinct lpad(split_part(itemid, 'UP', 1), 18, '0') as matnr from items
  where contains(itemid, 'UP'))
select matnr, count(*) as units, (select count(*) from mean) as eans
from k join marm using (matnr) group by all""",
)
def s13(t):
    """Dictionaries stored as tables, read through the refreshing cache."""
    paths = {}
    for name in ("marm", "mean"):
        paths[name] = tables.shared_dir(t.spark, name)
        getattr(t, name).write.parquet(paths[name])
    cache = tables.Dictionaries(t.spark, paths)
    packs = dictionaries.split_pack(t.items).where("pack_matnr is not null")
    wanted = packs.select(F.col("pack_matnr").alias("matnr")).distinct()
    eans = cache.get("mean").agg(F.count(F.lit(1))).scalar()
    return (
        wanted.join(cache.get("marm"), "matnr")
        .groupBy("matnr")
        .agg(F.count(F.lit(1)).alias("units"))
        .withColumn("eans", eans)
    )


@register(
    "s14_added_column",
    f"""{ctes('transactions')}
select transactionsequencenumber, false as is_aligned_tran,
  coalesce(operatorid, 'nobody') as operatorid from transactions""",
)
def s14(t):
    grown = history.add_column(t.transactions, "is_aligned_tran", False)
    grown = history.add_column(grown, "operatorid", "nobody", "string")
    return grown.select("transactionsequencenumber", "is_aligned_tran", "operatorid")


_GROWN = {
    "raw_bptransaction": "transactions",
    "raw_bpretaillineitem": "items",
    "raw_bptender": "tenders",
    "raw_bptenderextensions": "tender_ext",
    "raw_bptransactextensio": "txn_ext",
    "raw_bplineitemextensio": "item_ext",
    "raw_bptransactiondisco": "txn_discounts",
    "raw_bplineitemdiscount": "item_discounts",
    "raw_bpfinancialmovemen": "movements",
    "raw_bpfinacialmovement": "movement_ext",
}


@register(
    "s14_stored_column",
    f"""{ctes(*_GROWN.values())}, """
    + "r as ("
    + " union all ".join(f"select '{n}' as target, doc_id, txn_key from {t}" for n, t in _GROWN.items())
    + """)
select target, case when doc_id % 2 = 0 then 'before' else 'after' end as load_id, txn_key,
  case when doc_id % 2 = 0 then false when doc_id % 3 = 0 then true end as is_aligned_tran, count(*) as rows_stored
from r group by all""",
)
def s14_stored(t):
    """Targets gain a column between two loads; nulls that the second brings stay null."""
    base = tables.shared_dir(t.spark, "grown")
    even = (F.col("doc_id") % 2) == 0
    rows = {name: getattr(t, table).select("doc_id", "txn_key") for name, table in _GROWN.items()}
    tables.write_targets({n: df.where(even) for n, df in rows.items()}, "before", base)
    for name in rows:
        tables.add_column(t.spark, base, name, "is_aligned_tran", "boolean", "false")
    flag = F.when(F.col("doc_id") % 3 == 0, True)
    later = {n: df.where(~even).withColumn("is_aligned_tran", flag) for n, df in rows.items()}
    tables.write_targets(later, "after", base)
    stored = [tables.read_target(t.spark, base, n).withColumn("target", F.lit(n)) for n in rows]
    grouped = synthetic.union_all(*stored).groupBy("target", "load_id", "txn_key", "is_aligned_tran")
    return grouped.agg(F.count(F.lit(1)).alias("rows_stored"))


@register(
    "s9_targets",
    f"""{ctes(*_NAMES)}, {_TAGGED}
select 'raw_' || lower(substr(segment_name, 3)) as target, l.load_id,
  txn_key, count(*) as rows_stored
from flat cross join (values ('seven'), ('eight')) l(load_id)
where segment_name <> 'E1UNKNOWN' group by all""",
)
def s9(t):
    """One load written to every target twice, as after a retry, and one of another id."""
    flat = _flat(t)
    base = tables.shared_dir(t.spark, "targets")
    routes = {
        table: staging.route(flat, s)
        for s, table in schemas.RAW_TABLES.items()
        if s in _NAMES.values()
    }
    for load_id in ("seven", "seven", "eight"):
        tables.write_targets(routes, load_id, base)
    stored = [
        tables.read_target(t.spark, base, table).select(
            F.lit(table).alias("target"), "load_id", "txn_key"
        )
        for table in routes
    ]
    return (
        synthetic.union_all(*stored)
        .groupBy("target", "load_id", "txn_key")
        .agg(F.count(F.lit(1)).alias("rows_stored"))
    )


# --- reports ----------------------------------------------------------------------


@register(
    "a12_duplicate_keys",
    f"""{ctes('items')}
select txn_key, retailsequencenumber, count(*) as qnty from items group by all having count(*) > 1""",
)
def a12(t):
    return history.duplicate_keys(t.items, ["txn_key", "retailsequencenumber"])


@register(
    "o1_load_history",
    """select strftime(date_trunc('day', ts), '%Y-%m-%d') as committed_at, 'append' as operation,
  count(*) as rows_added from events group by all order by 1""",
)
def o1(t):
    loads = t.table("events").select(F.date_trunc("day", "ts").alias("load_ts"))
    return history.load_history(loads).withColumn(
        "committed_at", F.date_format("committed_at", "yyyy-MM-dd")
    )


@register(
    "o1_committed_loads",
    f"""select event_type as load_id, timestamp '2024-03-01 00:00:00' + interval 1 hour * (
    dense_rank() over (order by event_type)) as committed_at, 'append' as operation,
  unnest(['all', 'first']) as target, unnest([count(*), count(*) filter (where event_id % 2 = 0)]) as rows_added
from events group by event_type""",
)
def o1_committed(t):
    """Loads of several targets, one sent twice, told by their commit records."""
    base, events = tables.shared_dir(t.spark, "committed"), t.table("events")
    kinds = sorted(r[0] for r in events.select("event_type").distinct().collect())
    for at, kind in [*enumerate(kinds, 1), (1, kinds[0])]:
        mine = events.where(F.col("event_type") == kind)
        routes = {"all": mine, "first": mine.where("event_id % 2 = 0")}
        tables.write_targets(routes, kind, base, datetime(2024, 3, 1, at))
    return history.committed_loads(t.spark, base).drop("files_added")


@register(
    "u1_live_and_stored_union",
    f"""{ctes('transactions')},
live as (select txn_key, 'live' as origin from transactions where transactiontypecode like '10%'),
kept as (select distinct txn_key, 'history' as origin from transactions
  where businessdaydate >= '20010101')
select * from live union all select * from kept""",
)
def u1(t):
    txns = t.transactions
    live = txns.where("transactiontypecode like '10%'").select(
        "txn_key", F.lit("live").alias("origin")
    )
    stored = txns.withColumn("businessdaydate", F.to_date("businessdaydate", "yyyyMMdd"))
    kept = history.keys_of(history.history_rows(stored, 0, F.lit("2001-01-01").cast("date")))
    return synthetic.union_all(live, kept.withColumn("origin", F.lit("history")))


@register(
    "u2_amount_reconciliation",
    f"""{ctes('items', 'tenders')}
select 'tender' as src, transactionsequencenumber, retailstoreid, businessdaydate, workstationid,
  tenderamount as amount from tenders
union all
select 'lineitem', transactionsequencenumber, retailstoreid, businessdaydate, workstationid,
  salesamount from items""",
)
def u2(t):
    return history.reconcile_amounts(t.items, t.tenders)


@register(
    "u4_distinct_survivors",
    f"""{ctes('items')},
p as (select lpad(split_part(itemid, 'UP', 1), 18, '0') as matnr,
  split_part(itemid, 'UP', 2) as units, pos, transactionsequencenumber as seq
  from items where contains(itemid, 'UP'))
select matnr, units, min(struct_pack(p := pos, s := seq)).p as pos,
  min(struct_pack(p := pos, s := seq)).s as seq from p group by matnr, units""",
)
def u4(t):
    packs = dictionaries.split_pack(t.items).where("pack_matnr is not null").select(
        F.col("pack_matnr").alias("matnr"),
        F.col("pack_units").alias("units"),
        "pos",
        F.col("transactionsequencenumber").alias("seq"),
    )
    return history.first_rows(packs, ["matnr", "units"], ["pos", "seq"])


@register(
    "a15_stage_counts",
    f"""{ctes('transactions')},
h as (select distinct txn_key from transactions where businessdaydate >= '19990101'
  and transactiontypecode <> '1001')
select 'rows_in' as stage, count(*) as row_count from transactions
union all select 'preloaded_drops', count(*) from transactions
  where txn_key in (select txn_key from h)
union all select 'passed', count(*) from transactions where txn_key not in (select txn_key from h)""",
)
def a15(t):
    txns = t.transactions
    seen = txns.where("businessdaydate >= '19990101' and transactiontypecode <> '1001'")
    passed = history.drop_seen(txns, seen)
    dropped = txns.join(seen.select("txn_key").distinct(), "txn_key", "left_semi")
    return audit.stage_counts(rows_in=txns, preloaded_drops=dropped, passed=passed)


@register(
    "a16_store_closings",
    f"""{ctes('transactions')}
select retailstoreid, businessdaydate, max(begindatetimestamp) as closedate from transactions
where transactiontypecode = '1601' and workstationid = '0000000000' group by all""",
)
def a16(t):
    return audit.store_closings(t.transactions)


# --- messages and documents -------------------------------------------------------------

_ENVELOPES = """
select event_id, case event_id % 4 when 0 then '/posdw/postr_createmultiple02'
  when 1 then '/POSDW/POSTR_CREATEMULTIPLE02' when 2 then 'OTHER' end as kind, props from events"""


@register(
    "s2_envelope_split",
    f"""with e as ({_ENVELOPES})
select event_id, kind as message_type, case when kind is not null then 'split' || props end
    as payload,
  coalesce(lower(kind) = '/posdw/postr_createmultiple02', false) as accepted from e""",
)
def s2(t):
    """Messages with a header, two lines each; the payload holds the separator word too."""
    e = t.table("events")
    kind = F.expr(
        "case event_id % 4 when 0 then '/posdw/postr_createmultiple02' "
        "when 1 then '/POSDW/POSTR_CREATEMULTIPLE02' when 2 then 'OTHER' end"
    )
    text = messages.envelope(kind, F.concat(F.lit("split"), F.col("props")))
    raw = e.select(
        "event_id",
        F.coalesce(F.concat(F.lit("HEADER\n"), text), F.col("props")).alias("value"),
    )
    good, bad = messages.split_envelope(raw)
    both = good.withColumn("accepted", F.lit(True)).unionByName(
        bad.withColumn("accepted", F.lit(False))
    )
    return both.drop("value")


@register(
    "s3_payload_codec",
    "select doc_id, text, case when doc_id % 7 = 0 then null else text end as decoded from documents",
)
def s3(t):
    """Whole texts, encoded and decoded again; damaged payloads decode to null."""
    d = t.table("documents")
    wire = F.when(F.col("doc_id") % 7 == 0, "broken!").otherwise(
        messages.encode_payload(F.col("text"))
    )
    return d.select("doc_id", "text", wire.alias("wire")).select(
        "doc_id", "text", messages.decode_payload(F.col("wire")).alias("decoded")
    )


def _documents(t: Tables):
    """XML documents of the transactions, their tenders and extensions."""
    source = t.transactions.select("doc_id").distinct().select(
        "doc_id",
        F.col("doc_id").cast("string").alias("key"),
        F.lit("IDOC").alias("type"),
        F.lit("TILL").alias("logicalsystem"),
    )
    segments = {
        "E1BPTRANSACTION": t.transactions,
        "E1BPTENDER": t.tenders,
        "E1BPTRANSACTEXTENSIO": t.txn_ext,
    }
    return documents.build_xml(segments, source=source)


def _parsed(t: Tables):
    return documents.parse_documents(_documents(t))[0]


@register(
    "s4_document_parse",
    f"""{ctes('transactions', 'tenders')}
select doc_id, cast(doc_id as varchar) as docnum, count(*) as transactions,
  coalesce(any_value(n), 0) as tenders
from transactions left join (select doc_id, count(*) as n from tenders group by all)
  using (doc_id) group by doc_id""",
)
def s4(t):
    """Documents written as XML and parsed again."""
    body = F.col("doc.IDOC").getField(documents.BODY)

    def size(segment: str):
        return F.coalesce(
            F.size(body.getField(documents.PREFIX + segment)), F.lit(0)
        ).cast("bigint")

    return _parsed(t).select(
        "doc_id",
        F.col("doc.IDOC.EDI_DC40.DOCNUM").alias("docnum"),
        size("E1BPTRANSACTION").alias("transactions"),
        size("E1BPTENDER").alias("tenders"),
    )


@register(
    "s5_flattened_segments",
    f"""{ctes('transactions', 'tenders', 'txn_ext')}
select doc_id, 'E1BPTRANSACTION' as segment_name, txn_key, txn5, operatorid as a, partnerid as b,
  0 as place from transactions
union all select doc_id, 'E1BPTENDER', txn_key, txn5, tendersequencenumber,
  cast(tenderamount as varchar), 0 from tenders
union all select doc_id, 'E1BPTRANSACTEXTENSIO', txn_key, txn5, fieldname, fieldvalue, 0
  from txn_ext""",
)
def s5(t):
    """Every segment of every parsed document, with leading zeros and spaces kept."""
    flat = documents.flatten_segments(_parsed(t))
    return flat.select(
        "doc_id",
        "segment_name",
        "txn_key",
        "txn5",
        F.coalesce("operatorid", "tendersequencenumber", "fieldname").alias("a"),
        F.coalesce("partnerid", "tenderamount", "fieldvalue").alias("b"),
        F.lit(0).alias("place"),
    )


@register(
    "s10_source_documents",
    f"""{ctes('transactions')}
select distinct doc_id, cast(doc_id as varchar) as key, 'IDOC' as type, 'TILL' as logicalsystem
from transactions""",
)
def s10(t):
    return documents.source_documents(_parsed(t))


@register(
    "s15_quarantine",
    f"""{ctes('transactions')},
d as (select doc_id, count(*) as n from transactions group by all)
select doc_id, case when doc_id % 5 = 0 then 'unreadable document' end as error,
  case when doc_id % 5 = 0 then 0 else n end as transactions from d""",
)
def s15(t):
    """Damaged documents are set aside, the others go on."""
    cut = F.when(F.col("doc_id") % 5 == 0, F.expr("substr(value, 1, length(value) - 9)"))
    raw = _documents(t).withColumn("value", F.coalesce(cut, "value"))
    good, bad = documents.parse_documents(raw, settle=tables.cut_lineage)
    body = F.col("doc.IDOC").getField(documents.BODY)
    counts = good.select(
        "doc_id",
        F.lit(None).cast("string").alias("error"),
        F.size(body.getField(documents.PREFIX + "E1BPTRANSACTION"))
        .cast("bigint")
        .alias("transactions"),
    )
    return counts.unionByName(
        bad.select("doc_id", "error", F.lit(0).cast("bigint").alias("transactions"))
    )


@register(
    "s15_broken_segments",
    f"""{ctes('transactions')},
b as (select *, case when cast(transactionsequencenumber as bigint) % 13 = 0
  then businessdaydate || '996161' else begindatetimestamp end as stamp from transactions)
select transactionsequencenumber, 'impossible timestamp' as error from b
where stamp is not null and substr(stamp, 9, 2) = '99'""",
)
def s15_segments(t):
    odd = F.col("transactionsequencenumber").cast("bigint") % 13 == 0
    damaged = t.transactions.withColumn(
        "begindatetimestamp",
        F.when(odd, F.concat("businessdaydate", F.lit("996161"))).otherwise(
            F.col("begindatetimestamp")
        ),
    )
    return staging.broken_rows(damaged).select("transactionsequencenumber", "error")


@register(
    "a11_bundles",
    f"""{ctes('transactions', 'tenders', 'txn_ext')},
f as (select doc_id, {KEY} as txn_key from transactions
  union all select doc_id, txn_key from tenders union all select doc_id, txn_key from txn_ext)
select doc_id, txn_key, count(*) as segments from f group by all""",
)
def a11(t):
    """Bundles made inside each document's row, packed, unpacked and counted."""
    bundles = tables.cut_lineage(documents.document_bundles(_parsed(t)))
    rows = documents.unpack_bundles(bundles)
    return rows.groupBy("doc_id", "txn_key").agg(F.count(F.lit(1)).alias("segments"))


# Outbound input: movements with their extensions, one row each.
_OUT = """
o as (select 'k' || m.transactionsequencenumber as rtl_txn_fin_rk, m.retailstoreid,
  m.businessdaydate, m.transactionsequencenumber, m.financialtypecode, m.financialsequencenumber,
  m.refererenceid, m.amount, m.financialcurrency, e.fieldgroup, e.fieldname, e.fieldvalue,
  coalesce(e.pos, 0) as pos
  from movements m left join (select doc_id, txn_key, pos, fieldgroup, fieldname, fieldvalue
    from movement_ext union all select doc_id, txn_key, -pos, fieldgroup, fieldname, fieldvalue
    from txn_ext) e using (doc_id, txn_key))"""


def outbound_rows(t: Tables):
    ext = ["doc_id", "txn_key", "pos", "fieldgroup", "fieldname", "fieldvalue"]
    extensions = t.movement_ext.select(*ext).unionByName(
        t.txn_ext.withColumn("pos", -F.col("pos")).select(*ext)
    )
    movements = t.movements.drop("pos").select(
        F.concat(F.lit("k"), "transactionsequencenumber").alias("rtl_txn_fin_rk"), "*"
    )
    return movements.join(extensions, ["doc_id", "txn_key"], "left").select(
        "rtl_txn_fin_rk",
        *outbound.HEADER,
        *outbound.ITEM,
        "fieldgroup",
        "fieldname",
        "fieldvalue",
        F.coalesce("pos", F.lit(0)).alias("pos"),
    )


@register(
    "a14_outbound_documents",
    f"""{ctes('movements', 'movement_ext', 'txn_ext')}, {_OUT}
select rtl_txn_fin_rk, any_value(retailstoreid) as retailstoreid,
  any_value(businessdaydate) as businessdaydate, any_value(financialtypecode) as financialtypecode,
  any_value(amount) as amount, any_value(refererenceid) as refererenceid,
  count(fieldname) as extension_count,
  coalesce(string_agg(fieldname || '=' || fieldvalue, ';' order by pos, fieldgroup, fieldname, fieldvalue)
    filter (fieldname is not null and fieldvalue is not null), '') as extensions
from o group by rtl_txn_fin_rk""",
)
def a14(t):
    shown = F.transform(
        F.coalesce("extensions", F.array().cast("array<struct<fieldgroup:string,fieldname:string,fieldvalue:string>>")),
        lambda x: F.concat(x["fieldname"], F.lit("="), x["fieldvalue"]),
    )
    return outbound.build_documents(outbound_rows(t)).select(
        "rtl_txn_fin_rk",
        "retailstoreid",
        "businessdaydate",
        "financialtypecode",
        "amount",
        "refererenceid",
        "extension_count",
        F.array_join(shown, ";").alias("extensions"),
    )


def _tag(depth: int, name: str, value: str) -> str:
    """SQL for a line of XML; none for null."""
    safe = f"replace(replace(replace({value}::varchar, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    return f"coalesce('{'    ' * depth}<{name}>' || {safe} || '</{name}>' || chr(10), '')"


def _block(depth: int, name: str, inner: list[str], attributes: str = "") -> str:
    """SQL for lines of XML in a tag of their own."""
    indent = "    " * depth
    return " || ".join([f"'{indent}<{name}{attributes}>' || chr(10)", *inner, f"'{indent}</{name}>' || chr(10)"])


_XML_ITEM = _block(
    3,
    "E1WPF02",
    [
        _tag(4, "SEQNUM", "financialsequencenumber"),
        _tag(4, "REFID", "refererenceid"),
        _tag(4, "AMOUNT", "amount"),
        _tag(4, "CURRENCY", "financialcurrency"),
        "extensions",
    ],
)
_XML = _block(
    0,
    "WPUFIB01",
    [
        _block(
            1,
            "IDOC",
            [
                _block(
                    2,
                    "EDI_DC40",
                    [_tag(3, k, f"'{v}'") for k, v in outbound.CONTROL.items()]
                    + [_tag(3, "SNDPRN", f"coalesce(retailstoreid, '{outbound.UNKNOWN_STORE}')")],
                ),
                _block(
                    2,
                    "E1WPF01",
                    [
                        _tag(3, "VORGDATUM", "businessdaydate"),
                        _tag(3, "BONNUMMER", "transactionsequencenumber"),
                        _tag(3, "VORGANGART", "financialtypecode"),
                        f"case when financialsequencenumber is not null then {_XML_ITEM} else '' end",
                    ],
                ),
            ],
            ' BEGIN="1"',
        )
    ],
)
_XML_EXTENSION = _block(
    4,
    "E1WXX01",
    [_tag(5, "FLDGRP", "fieldgroup"), _tag(5, "FLDNAME", "fieldname"), _tag(5, "FLDVAL", "fieldvalue")],
)


@register(
    "a14_outbound_xml",
    f"""{ctes('movements', 'movement_ext', 'txn_ext')}, {_OUT},
d as (select rtl_txn_fin_rk, {', '.join(f'any_value({c}) as {c}' for c in outbound.HEADER + outbound.ITEM)},
  coalesce(string_agg({_XML_EXTENSION}, '' order by pos, fieldgroup, fieldname, fieldvalue)
    filter (fieldname is not null and fieldvalue is not null), '') as extensions
from o group by rtl_txn_fin_rk)
select rtl_txn_fin_rk, rtrim({_XML}, chr(10)) as xml from d""",
)
def a14_xml(t):
    """The same documents as XML text."""
    docs = outbound.document_xml(outbound.build_documents(outbound_rows(t)))
    return docs.select("rtl_txn_fin_rk", "xml")
