"""Streams over the tables, drained to a table and compared with the batch answer."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from tillstream.operators import audit, erp
from tillstream.plans import enterprise, ingest
from tillstream.queries.catalog import Tables, ctes, register
from tillstream.queries.rules import ONLINE
from tillstream.queries.stores import LOAD, outbound_rows
from tillstream.sources import documents, messages, tables
from tillstream.streaming import collect, counters, dedup, run

# The live stream: events as files; user and type are the key, the id gives the order.
_LIVE = "cast(user_id as varchar) || '|' || event_type as txn_key"


def _events(t: Tables):
    return t.table("events")


PARTS = 3
#: Files of a part; each has rows of all its part.
FILES = 4


def _write_live(t: Tables, path: str, which: range, parts: int = PARTS) -> None:
    """Events of ascending ranges of ids, one part after the other."""
    events = _events(t)
    step = (events.agg(F.max("event_id")).first()[0] or 0) // parts + 1
    for part in which:
        rows = events.where(F.floor(F.col("event_id") / step) == part)
        rows.repartition(FILES, "event_id").write.mode("append").parquet(path)


def _live(t: Tables, parts: int = PARTS):
    """Events as a stream of bundles with a transaction key, a micro-batch for each part."""
    path = tables.shared_dir(t.spark, "live")
    _write_live(t, path, range(parts), parts)
    return _keyed(tables.stream_table(t.spark, path, _events(t).schema, max_files=FILES))


def _keyed(df):
    return df.select(
        F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("txn_key"),
        "event_id",
        "ts",
        "props",
    )


@register(
    "s1_message_stream",
    """select kind, count(*) as messages from (select case event_id % 3
  when 0 then '/POSDW/POSTR_CREATEMULTIPLE02' when 1 then '/posdw/postr_createmultiple02'
  else 'OTHER' end as kind from events) group by all""",
)
def s1(t):
    """Messages stored as a table, streamed, and split by type."""
    kind = F.expr(
        "case event_id % 3 when 0 then '/POSDW/POSTR_CREATEMULTIPLE02' "
        "when 1 then '/posdw/postr_createmultiple02' else 'OTHER' end"
    )
    stored = tables.cut_lineage(
        _events(t).select(messages.envelope(kind, F.col("props")).alias("value"))
    )
    path = tables.shared_dir(t.spark, "messages")
    stored.write.parquet(path)
    stream = tables.stream_table(t.spark, path, stored.schema)
    good, bad = messages.split_envelope(stream)
    both = good.select("message_type").unionByName(bad.select("message_type"))
    return (
        run.to_table(both)
        .groupBy(F.col("message_type").alias("kind"))
        .agg(F.count(F.lit(1)).alias("messages"))
    )


@register("s8_table_stream", f"select {_LIVE}, event_id, props from events")
def s8(t):
    return run.to_table(_live(t).select("txn_key", "event_id", "props"))


@register(
    "t1_dedup_stream",
    f"select txn_key, min(event_id) as event_id from (select {_LIVE}, event_id from events) group by all",
)
def t1(t):
    """The first bundle of each key; the run is shorter than the lifetime."""
    kept = run.to_table(dedup.dedup_stream(_live(t), "event_id"))
    return kept.select("txn_key", "event_id")


@register(
    "t1_dedup_batch",
    f"""with recursive e as (select {_LIVE}, ts, event_id from events),
k as (select txn_key, min(ts) as ts from e group by all
  union all
  select k.txn_key, (select min(e.ts) from e where e.txn_key = k.txn_key
    and e.ts >= k.ts + interval 72 hour) as ts from k where k.ts is not null)
select txn_key, e.event_id from k join e using (txn_key, ts)""",
)
def t1_batch(t):
    """What the stream keeps if events arrive at their own times, lifetimes included."""
    kept = dedup.dedup_batch(_keyed(_events(t)), ["txn_key"], "ts", ["event_id"])
    return kept.select("txn_key", "event_id")


@register("t1_dedup_event_time", f"select distinct {_LIVE} from events")
def t1_event_time(t):
    # One micro-batch: how soon a watermark forgets a key depends on their number.
    return run.to_table(dedup.dedup_event_time(_live(t, 1), "ts").select("txn_key"))


_SEEN = f"""with e as (select {_LIVE}, ts, event_id from events),
seen as (select distinct txn_key from e where ts < timestamp '2024-01-03')
select txn_key, min(event_id) as event_id from e
where txn_key not in (select txn_key from seen) group by all"""


def _seen(t: Tables):
    return _keyed(_events(t)).where("ts < timestamp_ntz'2024-01-03'").select("txn_key")


@register("t2_dedup_seeded", _SEEN)
def t2(t):
    """Keys of the stored days count as seen before the first live bundle."""
    stream = dedup.dedup_stream(_live(t), "event_id", initial=_seen(t))
    return run.to_table(stream).select("txn_key", "event_id")


@register(
    "t3_dedup_preloaded",
    f"""with e as (select {_LIVE}, ts, event_id,
  event_id // (select max(event_id) // {PARTS} + 1 from events) as part from events),
seen as (select distinct txn_key from e where ts < timestamp '2024-01-03'),
first as (select txn_key, min(part) as part from e where txn_key in (select txn_key from seen) group by all)
select txn_key, min(event_id) as event_id from e
where (txn_key, part) not in (select txn_key, part from first) group by txn_key, part""",
)
def t3(t):
    """A preloaded key has no lifetime until it is dropped, once, by its first bundle.

    The lifetime is shorter than a micro-batch here, so each one starts anew: stored keys
    lose their first micro-batch, and every other one gives its first bundle.
    """
    stream = dedup.dedup_stream(_live(t), "event_id", 1, initial=_seen(t), preloaded=True)
    return run.to_table(stream).select("txn_key", "event_id")


@register(
    "t4_collected_documents",
    f"""{ctes('movements', 'movement_ext', 'txn_ext')},
e as (select doc_id, txn_key, fieldname, fieldvalue from movement_ext
  union all select doc_id, txn_key, fieldname, fieldvalue from txn_ext)
select 'k' || m.transactionsequencenumber as rtl_txn_fin_rk, any_value(m.retailstoreid) as retailstoreid,
  any_value(m.amount) as amount, count(e.fieldname) as extension_count
from movements m left join e using (doc_id, txn_key) group by all""",
)
def t4(t):
    """Rows of a movement wait for the delay, then leave as one document."""
    rows = tables.cut_lineage(outbound_rows(t).drop("pos"))
    path = tables.shared_dir(t.spark, "outbound")
    rows.write.parquet(path)
    expected = rows.select("rtl_txn_fin_rk").distinct().count()
    stream = tables.stream_table(t.spark, path, rows.schema)
    done = run.to_table(
        collect.collect_documents(stream, delay_ms=1000),
        lambda out: out.count() >= expected,
    )
    size = F.coalesce(F.size("extensions"), F.lit(0)).cast("bigint")
    return done.select(
        "rtl_txn_fin_rk", "retailstoreid", "amount", size.alias("extension_count")
    )


@register(
    "t5_fan_out",
    "select 'raw_' || event_type as target, event_id from events",
)
def t5(t):
    """One stream, one target per type, all written in the same micro-batch."""
    base = tables.shared_dir(t.spark, "fan")
    kinds = ["view", "click", "purchase", "error", "signup"]
    path = f"{t.sf_dir.rstrip('/')}/events.parquet"
    stream = tables.stream_table(t.spark, path, _events(t).schema)

    def write(batch, batch_id):
        batch = batch.persist()
        routes = {f"raw_{k}": batch.where(F.col("event_type") == k) for k in kinds}
        tables.write_targets(routes, f"fan-{batch_id}", base)
        batch.unpersist()

    run.drain(stream.writeStream.foreachBatch(write), t.spark)
    parts = [
        tables.read_target(t.spark, base, f"raw_{k}").select(F.lit(f"raw_{k}").alias("target"), "event_id")
        for k in kinds
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register(
    "t6_replay",
    "select event_id, props from events where ts >= timestamp '2024-01-20 12:00:00'",
)
def t6(t):
    start = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    replayed = messages.replay_from(_live(t), "ts", start)
    return run.to_table(replayed.select("event_id", "props"))


@register(
    "a15_stream_counts",
    f"""with e as (select {_LIVE}, ts, event_id from events),
seen as (select distinct txn_key from e where ts < timestamp '2024-01-03'),
k as (select count(*) as n, count(distinct txn_key) filter (txn_key not in (select txn_key from seen)) as kept,
  count(*) filter (txn_key in (select txn_key from seen)) as preloaded from e)
select unnest(['rows_in', 'preloaded_drops', 'duplicates', 'passed', 'batches']) as stage,
  unnest([n, preloaded, n - preloaded - kept, kept, {PARTS}]) as row_count from k""",
)
def a15_stream(t):
    """Counters of three micro-batches, with a restart of the stream after the first."""
    spark, seen = t.spark, tables.cut_lineage(_seen(t).distinct())
    path, out, at, checkpoint = (tables.shared_dir(spark, n) for n in ("live", "out", "counts", "checkpoint"))
    _write_live(t, path, range(1))
    flagged = seen.withColumn("preloaded", F.lit(True))
    with counters.counting(spark, at):
        for more in (range(0), range(1, PARTS)):
            _write_live(t, path, more)
            live = _keyed(tables.stream_table(spark, path, _events(t).schema, max_files=FILES))
            told = audit.tap(
                live.join(flagged, "txn_key", "left"), "rows_in", preloaded_drops=F.count("preloaded")
            ).drop("preloaded")
            kept = audit.tap(dedup.dedup_stream(told, "event_id", initial=seen), "passed")
            run.drain(kept.writeStream.format("parquet").option("path", out), spark, checkpoint=checkpoint)
    counts = counters.batches(spark, at)
    stages = {r["stage"]: r["row_count"] for r in counters.totals(spark, at).collect()}
    stages["batches"] = counts.where("stage = 'rows_in' and row_count > 0").select("batch").distinct().count()
    stages["duplicates"] = stages["rows_in"] - stages["preloaded_drops"] - stages["passed"]
    return spark.createDataFrame(sorted(stages.items()), "stage string, row_count long")


# --- whole loads -------------------------------------------------------------------

SETTINGS = ingest.Settings(online_source=ONLINE)


def _write_messages(t: Tables, path: str, **changed) -> None:
    """Encoded messages of the transactions with their lines, tenders, extensions, movements.

    Segments given by name replace the derived ones.
    """
    segments = {
        "E1BPTRANSACTION": t.transactions,
        "E1BPRETAILLINEITEM": t.items,
        "E1BPTENDER": t.tenders,
        "E1BPTENDEREXTENSIONS": t.tender_ext,
        "E1BPTRANSACTEXTENSIO": t.txn_ext,
        "E1BPFINANCIALMOVEMEN": t.movements,
    }
    xml = documents.build_xml(segments | changed)
    payload = messages.encode_payload(F.col("value"))
    with messages.few_at_a_time(t.spark), tables.lean(t.spark):
        xml.select(
            F.col("doc_id").alias("document"),
            messages.envelope(F.lit(messages.MESSAGE_TYPE), payload).alias("value"),
        ).write.parquet(path)


_MESSAGE = T.StructType([T.StructField("document", T.LongType()), T.StructField("value", T.StringType())])


def _message_table(t: Tables, **changed):
    path = tables.shared_dir(t.spark, "messages")
    _write_messages(t, path, **changed)
    return t.spark.read.schema(_MESSAGE).parquet(path)


def _dictionaries(t: Tables):
    return {n: tables.cut_lineage(getattr(t, n)) for n in ("marm", "mean", "mara", "tvarvc", "export")}


# Staged tenders after all rules: key overrides, dropped packs, certificates, balancing rows.
_LOADED_TENDERS = f"""{ctes('transactions', 'items', 'tenders', 'tender_ext', 'txn_ext', 'marm', 'mean')},
o as (select distinct doc_id, txn5 from txn_ext
  where fieldname = 'SOURCE' and fieldvalue = '{ONLINE}'),
eans as (select distinct matnr, umrez from marm join mean using (matnr, meinh)
  where lfnum = '00001' and ean11 <> ''),
bad as (select distinct doc_id, txn5 from items left join eans
  on matnr = lpad(split_part(itemid, 'UP', 1), 18, '0') and umrez = split_part(itemid, 'UP', 2)
  where contains(itemid, 'UP') and eans.matnr is null),
cert as (select distinct doc_id, txn_key from tender_ext
  where contains(fieldname, 'CERT_PARTY') and contains(fieldvalue, 'RU02')),
s as (select doc_id, txn_key, sum(salesamount) as sale from items
  where retailtypecode <> '2020' group by all),
p as (select doc_id, txn_key, sum(tenderamount) as paid from tenders group by all),
staged as (
  select doc_id, txn5, workstationid, transactionsequencenumber, tendersequencenumber,
    case when cert.doc_id is not null and tendertypecode = '3108' then '3123' else tendertypecode
      end as tendertypecode, cast(tenderamount as decimal(38,2)) as tenderamount
  from tenders left join cert using (doc_id, txn_key)
  union all
  select t.doc_id, t.txn5, t.workstationid, t.transactionsequencenumber,
    case when p.doc_id is not null then '9' else '8' end, '3101',
    cast(coalesce(sale, 0) - coalesce(paid, 0) as decimal(38,2))
  from transactions t left join s using (doc_id, txn_key) left join p using (doc_id, txn_key)
  where transactiontypecode = '1014' and (
    (p.doc_id is not null and abs(coalesce(sale, 0) - coalesce(paid, 0)) >= 1)
    or (p.doc_id is null and s.doc_id is not null)))
select case when o.doc_id is null then workstationid else '0000001002' end as workstationid,
  transactionsequencenumber, tendersequencenumber, tendertypecode, tenderamount
from staged left join o using (doc_id, txn5)
where (doc_id, txn5) not in (select doc_id, txn5 from bad)"""
_TENDER_COLUMNS = [
    "workstationid",
    "transactionsequencenumber",
    "tendersequencenumber",
    "tendertypecode",
    "tenderamount",
]


@register("ingest_batch_tenders", _LOADED_TENDERS)
def ingest_batch(t):
    """A whole load from encoded messages; shown are its staged tenders."""
    raw = _message_table(t).drop("document")
    base = tables.shared_dir(t.spark, "load")
    # The same messages twice: the repeats add nothing.
    ingest.ingest_batch(raw.unionAll(raw), _dictionaries(t), SETTINGS, base, LOAD, "one")
    return tables.read_target(t.spark, base, "pst_bptender").select(*_TENDER_COLUMNS)


@register(
    "ingest_two_loads",
    f"""{ctes('transactions', 'items', 'marm', 'mean')},
eans as (select distinct matnr, umrez from marm join mean using (matnr, meinh)
  where lfnum = '00001' and ean11 <> ''),
bad as (select distinct doc_id, txn_key from items left join eans
  on matnr = lpad(split_part(itemid, 'UP', 1), 18, '0') and umrez = split_part(itemid, 'UP', 2)
  where contains(itemid, 'UP') and eans.matnr is null)
select case doc_id % 2 when 0 then 'even' else 'odd' end as load_id, transactionsequencenumber
from transactions where (doc_id, txn_key) not in (select doc_id, txn_key from bad)""",
)
def ingest_two_loads(t):
    """Loads of different rows stay beside each other; one repeated leaves the same rows."""
    raw = _message_table(t)
    base = tables.shared_dir(t.spark, "load")
    even, odd, dicts = raw.where("document % 2 = 0"), raw.where("document % 2 <> 0"), _dictionaries(t)
    for load_id, part in (("even", even), ("odd", odd), ("odd", odd)):
        ingest.ingest_batch(part.drop("document"), dicts, SETTINGS, base, LOAD, load_id)
    return tables.read_target(t.spark, base, "raw_bptransaction").select(
        "load_id", "transactionsequencenumber"
    )


_RESENT = f"""{ctes('transactions', 'items', 'txn_discounts', 'marm', 'mean')},
eans as (select distinct matnr, umrez from marm join mean using (matnr, meinh)
  where lfnum = '00001' and ean11 <> ''),
packs as (select doc_id, txn_key, transactionsequencenumber, pos,
    lpad(split_part(itemid, 'UP', 1), 18, '0') as matnr, split_part(itemid, 'UP', 2) as umrez
  from items where contains(itemid, 'UP')),
bad as (select distinct doc_id, txn_key from packs left join eans using (matnr, umrez)
  where eans.matnr is null),
d as (select *, doc_id % 5 = 0 and discounttypecode is not null as damaged from txn_discounts)
select 'transaction' as kind, transactionsequencenumber, count(*) as found, null as matnr, null as umrez
from transactions group by all
union all select 'damaged', transactionsequencenumber, 2 * count(*), null, null from d where damaged group by all
union all select 'discount', transactionsequencenumber, count(*), null, null from d where not damaged group by all
union all select 'pack', transactionsequencenumber, count(*), matnr, umrez
from packs where (doc_id, txn_key) not in (select doc_id, txn_key from bad) group by all"""


@register("ingest_resent", _RESENT)
def ingest_resent(t):
    """Everything is sent twice, the second time without packs, and with some damaged codes.

    Transactions dropped for an unresolved pack come from the second sending; damaged
    discounts of both go to the quarantine and nothing else of their transactions does.
    """
    code = F.col("discounttypecode")
    damaged = t.txn_discounts.withColumn(
        "discounttypecode", F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("x"), code)).otherwise(code)
    )
    plain = t.items.withColumn("itemid", F.replace("itemid", F.lit("UP"), F.lit("-")))
    first = _message_table(t, E1BPTRANSACTIONDISCO=damaged)
    second = _message_table(t, E1BPTRANSACTIONDISCO=damaged, E1BPRETAILLINEITEM=plain)
    base = tables.shared_dir(t.spark, "load")
    raw = first.unionAll(second).drop("document")
    ingest.ingest_batch(raw, _dictionaries(t), SETTINGS, base, LOAD, "one")

    def stored(name, kind, *more):
        none = F.lit(None).cast("string")
        columns = [F.col(m) for m in more] or [none, none]
        df = tables.read_target(t.spark, base, name)
        if name == "quarantine_segments":
            key = F.get_json_object("fields", "$.transactionsequencenumber")
            df = df.withColumn("transactionsequencenumber", key)
        return df.select(
            F.lit(kind).alias("kind"),
            "transactionsequencenumber",
            columns[0].alias("matnr"),
            columns[1].alias("umrez"),
        )

    lines = stored("raw_bpretaillineitem", "pack", "matnr_padded", "umrez_val")
    rows = (
        stored("raw_bptransaction", "transaction")
        .unionByName(stored("quarantine_segments", "damaged"))
        .unionByName(stored("raw_bptransactiondisco", "discount"))
        .unionByName(lines.where("matnr is not null"))
    )
    return rows.groupBy("kind", "transactionsequencenumber", "matnr", "umrez").agg(
        F.count(F.lit(1)).alias("found")
    )


@register("ingest_stream_tenders", _LOADED_TENDERS)
def ingest_stream(t):
    """The same load as a stream through the stateful dedup."""
    path = tables.shared_dir(t.spark, "messages")
    _write_messages(t, path)
    paths = {}
    for name in ("marm", "mean", "mara", "tvarvc", "export"):
        paths[name] = tables.shared_dir(t.spark, name)
        getattr(t, name).write.parquet(paths[name])
    base = tables.shared_dir(t.spark, "load")
    # The same messages twice.
    one, two = (tables.stream_table(t.spark, path, _MESSAGE).select("value") for _ in range(2))
    writer = ingest.stream_writer(one.unionAll(two), tables.Dictionaries(t.spark, paths), SETTINGS, base, "live")
    run.drain(writer, t.spark)
    return tables.read_target(t.spark, base, "pst_bptender").select(*_TENDER_COLUMNS)


# Days with an even number are loaded first, so every later day finds the closings of the
# day before; the type 1015 and the workstation change before, repeats go after.
_ENTERPRISE = f"""{ctes('transactions', 'items', 'tenders', 'txn_ext', 'item_ext', 'marm', 'mean', 'tvarvc')},
flags as (select low from tvarvc where name = 'CHK_FIXES' and type = 'S'),
u as (select distinct doc_id, txn_key from items left join
  (select doc_id, txn_key, sum(tenderamount) as paid from tenders group by all)
  using (doc_id, txn_key) where coalesce(paid, 0) = 0),
o as (select distinct doc_id, txn5 from txn_ext where fieldname = 'SOURCE' and fieldvalue = '{ONLINE}'),
eans as (select distinct matnr, umrez from marm join mean using (matnr, meinh)
  where lfnum = '00001' and ean11 <> ''),
bad as (select distinct doc_id, txn_key from items left join eans
  on matnr = lpad(split_part(itemid, 'UP', 1), 18, '0') and umrez = split_part(itemid, 'UP', 2)
  where contains(itemid, 'UP') and eans.matnr is null),
h as (select t.pos, t.retailstoreid, t.businessdaydate, t.begindatetimestamp, t.transactionsequencenumber,
    case when transactiontypecode = '1015' and (doc_id, txn_key) in (select (doc_id, txn_key) from u)
      then '1014' else transactiontypecode end as transactiontypecode,
    case when o.doc_id is null then workstationid else '0000001002' end as workstationid,
    strptime(businessdaydate, '%Y%m%d') as day, date_diff('day', date '1992-01-01', strptime(businessdaydate, '%Y%m%d')) % 2 as load
  from transactions t left join o using (doc_id, txn5)
  where (doc_id, txn_key) not in (select doc_id, txn_key from bad)),
e as (select *, coalesce(substr(begindatetimestamp, 9, 6) < '060000'
    and substr(begindatetimestamp, 1, 8) = businessdaydate, false) as early from h),
m as (select e.*, min(case when early and transactiontypecode = '1601' and workstationid = '0000000000'
      then begindatetimestamp end) over (partition by retailstoreid, businessdaydate order by pos
      rows between unbounded preceding and 1 preceding) as before_min,
    min(case when early and transactiontypecode = '1601' and workstationid = '0000000000'
      then begindatetimestamp end) over (partition by retailstoreid, businessdaydate) as all_min from e),
first_load as (select *, coalesce(early and begindatetimestamp <= least(businessdaydate || '060000',
    case when transactiontypecode = '1601' then before_min else all_min end)
    and (transactiontypecode in ('1601', '1301', '1302', '1305') or transactiontypecode like '10%'), false) as moved
  from m where load = 0),
closings as (select retailstoreid, max(begindatetimestamp) as closedate,
    strftime(day - to_days(case when moved then 1 else 0 end), '%Y%m%d') as closed_day
  from first_load where transactiontypecode = '1601' and workstationid = '0000000000'
    and begindatetimestamp is not null group by all),
d as (select m.*, case when (substr(closedate, 1, 8) = closed_day and substr(closedate, 9, 6) > '060000')
    or (substr(closedate, 1, 8) = businessdaydate and substr(closedate, 9, 6) < '060000')
    then closedate else businessdaydate || '060000' end as deadline
  from m left join closings c on c.retailstoreid = m.retailstoreid
    and c.closed_day = strftime(m.day - interval 1 day, '%Y%m%d') where load = 1),
second_load as (select * exclude (deadline), coalesce(early and begindatetimestamp <= least(deadline,
    case when transactiontypecode = '1601' then before_min else all_min end)
    and (transactiontypecode in ('1601', '1301', '1302', '1305') or transactiontypecode like '10%'), false) as moved from d)
select case load when 0 then 'first' else 'second' end as load_id, transactionsequencenumber, transactiontypecode,
  workstationid, strftime(day - to_days(case when moved then 1 else 0 end), '%Y%m%d') as businessdaydate, moved
from (select * from first_load union all select * from second_load)"""


@register("ingest_enterprise", _ENTERPRISE)
def ingest_enterprise(t):
    """Two loads under the enterprise rules; the second also brings all of the first again."""
    flags = t.tvarvc.unionByName(
        t.spark.range(1).select(
            F.lit("CHK_FIXES").alias("name"),
            F.lit("S").alias("type"),
            F.explode(F.array(F.lit(erp.CASHOUT), F.lit(erp.ONLINE))).alias("low"),
        )
    )
    dicts = {n: getattr(t, n) for n in ("marm", "mean", "mara")} | {"tvarvc": tables.cut_lineage(flags)}
    names = {
        enterprise.TXNS: "transactions",
        enterprise.ITEMS: "items",
        enterprise.TENDERS: "tenders",
        enterprise.ITEM_EXT: "item_ext",
        enterprise.TENDER_EXT: "tender_ext",
        enterprise.TXN_EXT: "txn_ext",
    }
    # A store's day is one message here.
    day = F.to_date("businessdaydate", "yyyyMMdd")
    odd = F.date_diff(day, F.lit("1992-01-01").cast("date")) % 2
    seg = {name: tables.cut_lineage(getattr(t, table)) for name, table in names.items()}
    seg[enterprise.TXNS] = seg[enterprise.TXNS].withColumns(
        {"store": F.col("retailstoreid"), "day": F.col("businessdaydate")}
    )
    settings = enterprise.Settings(ONLINE, "060000", document=("store", "day"))
    base = tables.shared_dir(t.spark, "enterprise")
    enterprise.load({n: df.where(odd == 0) for n, df in seg.items()}, dicts, settings, base, "first", LOAD)
    enterprise.load(seg, dicts, settings, base, "second", LOAD)
    return tables.read_target(t.spark, base, enterprise.target(enterprise.TXNS)).select(
        "load_id", "transactionsequencenumber", "transactiontypecode", "workstationid", "businessdaydate", "moved"
    )
