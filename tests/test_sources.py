import glob
import os
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillstream.operators import erp, history
from tillstream.plans import ingest, schemas
from tillstream.sources import documents, messages, seen, tables

LOAD = datetime(2024, 5, 6, 7, 8, 9)
SHOP = "my.shop"


def test_envelope_rejects_other_types_and_keeps_the_separator_in_payloads(spark):
    df = spark.createDataFrame(
        [("H\nMSGTYPEsplit/posdw/POSTR_CREATEMULTIPLE02\nDATAsplitasplitb",), ("MSGTYPEsplitX\nDATAsplitq",),
         ("DATAsplitq",), ("",)], "value string")
    good, bad = messages.split_envelope(df)
    assert [r.payload for r in good.collect()] == ["asplitb"]
    assert bad.count() == 3


def test_codec_round_trip_and_damage(spark):
    df = spark.createDataFrame([("Überzug & <xml/>",), ("",)], "t string")
    wire = messages.encode_payload(F.col("t"))
    assert [r[0] for r in df.select(messages.decode_payload(wire)).collect()] == ["Überzug & <xml/>", ""]
    bad = spark.createDataFrame([("@@",), ("QUJD",), (None,)], "t string")
    assert [r[0] for r in bad.select(messages.decode_payload(F.col("t"))).collect()] == [None] * 3


def test_loads_hand_few_documents_at_a_time_to_python(spark, tmp_path, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, real = spark.conf.get(name), [], ingest.read_documents
    assert int(before) > messages.MESSAGES

    def read(*args):
        seen.append(spark.conf.get(name))
        return real(*args)

    monkeypatch.setattr(ingest, "read_documents", read)
    with pytest.raises(Exception, match="marm"):
        raw = spark.createDataFrame([("x",)], "value string")
        ingest.ingest_batch(raw, {}, ingest.Settings(SHOP), str(tmp_path), LOAD, "one")
    assert seen == [str(messages.MESSAGES)] and spark.conf.get(name) == before


def test_start_options():
    assert messages.start_options(None) == {"startingOffsets": "earliest"}
    assert messages.start_options(5)["startingTimestamp"] == "5"


def test_flatten_keeps_order_spaces_and_zeros(spark, segment):
    ext = segment([{"fieldname": n, "fieldvalue": v} for n, v in (("B", " 1 "), ("A", "007"), ("B", None))])
    xml = documents.build_xml({"E1BPTRANSACTEXTENSIO": ext, "E1BPTRANSACTION": segment([{"operatorid": "01"}])})
    good, bad = documents.parse_documents(xml)
    assert bad.isEmpty()
    flat = documents.flatten_segments(good).orderBy("pos")
    got = [(r.segment_name, r.fieldname, r.fieldvalue, r.operatorid) for r in flat.collect()]
    assert got == [("E1BPTRANSACTION", None, None, "01"), ("E1BPTRANSACTEXTENSIO", "B", " 1 ", None),
                   ("E1BPTRANSACTEXTENSIO", "A", "007", None), ("E1BPTRANSACTEXTENSIO", "B", None, None)]


def test_unreadable_documents_are_quarantined_alone(spark, segment):
    xml = documents.build_xml({"E1BPTRANSACTION": segment([{}, {"doc_id": 2}])})
    cut = xml.withColumn("value", F.when(F.col("doc_id") == 2, "<a><b>").otherwise(F.col("value")))
    good, bad = documents.parse_documents(cut)
    assert [r.doc_id for r in good.collect()] == [1] and [r.doc_id for r in bad.collect()] == [2]


def test_both_halves_of_a_parse_read_the_settled_messages(spark, segment):
    xml = documents.build_xml({"E1BPTRANSACTION": segment([{}, {"doc_id": 2}])})
    cut = xml.withColumn("value", F.when(F.col("doc_id") == 2, "<broken").otherwise(F.col("value")))
    seen = []

    def settle(df):
        seen.append(df)
        return spark.createDataFrame(df.collect(), df.schema)

    good, bad = documents.parse_documents(cut, settle=settle)
    assert len(seen) == 1
    for half in (good, bad):
        assert "from_xml" not in half._jdf.queryExecution().optimizedPlan().toString().lower()
    assert [r.doc_id for r in good.collect()] == [1]
    assert [(r.doc_id, r.value, r.error) for r in bad.collect()] == [(2, "<broken", "unreadable document")]


def test_documents_hold_no_blanks_between_tags_and_keep_the_order(segment):
    rows = [{"pos": p, "operatorid": f" {p} "} for p in (3, 1, 2)]
    text = documents.build_xml({"E1BPTRANSACTION": segment(rows)}).first().value
    assert "> " not in text.replace("<OPERATORID> ", "") and "\n" not in text.strip()
    assert [text.index(f"<OPERATORID> {p} <") for p in (1, 2, 3)] == sorted(text.index(f"<OPERATORID> {p} <") for p in (1, 2, 3))


def test_bundles_unpack_to_the_flattened_rows(spark, segment):
    ext = segment([{"fieldname": "SOURCE", "fieldvalue": SHOP}, {"fieldname": "X", "fieldvalue": "y"}])
    txns = segment([{}, {"transactionsequencenumber": "8"}])
    xml = documents.build_xml({"E1BPTRANSACTEXTENSIO": ext, "E1BPTRANSACTION": txns})
    docs, _ = documents.parse_documents(xml)
    flat = documents.flatten_segments(docs, online_source=SHOP)
    again = documents.unpack_bundles(documents.document_bundles(docs, online_source=SHOP))
    assert flat.exceptAll(again).isEmpty() and again.exceptAll(flat).isEmpty()
    moved = {r.txn_key: r.txn5_orig for r in flat.collect()}
    assert moved["0001|20240102|0000001002|7"] == "0001|20240102|1001|0000001001|7"
    assert "0001|20240102|0000001001|8" in moved


def test_listed_segments_hold_their_own_values_only_and_widen_to_the_flattened_rows(spark, segment):
    ext = segment([{"fieldname": "SOURCE", "fieldvalue": SHOP}, {"fieldname": "X", "fieldvalue": None}])
    txns = segment([{"operatorid": "01"}, {"transactionsequencenumber": "8"}])
    totals = segment([{}])
    xml = documents.build_xml({"E1BPTRANSACTEXTENSIO": ext, "E1BPTRANSACTION": txns, "E1BPRETAILTOTALS": totals})
    docs, _ = documents.parse_documents(xml)
    flat = documents.flatten_segments(docs, online_source=SHOP)
    listed = documents.segment_values(docs, online_source=SHOP)
    sizes = {(r.segment_name, len(r.segment_values)) for r in listed.collect()}
    assert sizes == {(s, len(schemas.SEGMENTS[s])) for s in ("E1BPTRANSACTEXTENSIO", "E1BPTRANSACTION", "E1BPRETAILTOTALS")}
    wide = documents.widened(listed)
    assert wide.columns == flat.columns
    assert flat.exceptAll(wide).isEmpty() and wide.exceptAll(flat).isEmpty()
    for name in ("E1BPTRANSACTEXTENSIO", "E1BPTRANSACTION", "E1BPRETAILTOTALS"):
        one, other = documents.pick_segment(flat, name), documents.pick_segment(listed, name)
        assert one.columns == other.columns
        assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


TENDER = documents.PREFIX + "E1BPTENDER"
ONE = f"<{TENDER}><RETAILSTOREID>1</RETAILSTOREID><TENDERTYPECODE>1</TENDERTYPECODE></{TENDER}>"
SHOP_NOTE = f"<{documents.PREFIX}E1BPTRANSACTEXTENSIO><RETAILSTOREID>1</RETAILSTOREID><FIELDNAME>SOURCE</FIELDNAME><FIELDVALUE>{SHOP}</FIELDVALUE></{documents.PREFIX}E1BPTRANSACTEXTENSIO>"
RECORD = f"<{documents.SOURCE_TAG}><KEY>k</KEY><TYPE></TYPE></{documents.SOURCE_TAG}>"


def _document(inner, head="<EDI_DC40><TABNAM>T</TABNAM></EDI_DC40>", root="r", idoc="IDOC"):
    body = f"<{documents.BODY}>{inner}</{documents.BODY}>"
    return f"<{root}><{idoc}>{head}{body}</{idoc}></{root}>"


def _tender(fields):
    return _document(f"<{TENDER}>{fields}</{TENDER}>")


PLAIN = [
    _document(ONE + ONE),
    _document(ONE + SHOP_NOTE + ONE),
    _document(ONE + RECORD),
    _document(f"<{documents.SOURCE_TAG}/>"),
    _document(""),
    _document("\n  " + ONE + " ", head=""),
    _document(f"<{TENDER}/>" + ONE),
    "\n" + _document(ONE) + " ",
    _document("zz" + ONE + "yy", head="ww"),
    _tender("<TENDERID>a>b</TENDERID>"),
    _document(ONE, head="<EDI_DC40/>"),
    _document(ONE, head="<EDI_DC40><TABNAM>a</TABNAM><Y><Z>1</Z></Y></EDI_DC40>"),
    '<?xml version="1.0" encoding="utf-8"?>\n' + _document(ONE),
    _tender("<RETAILSTOREID></RETAILSTOREID><TENDERTYPECODE/><TENDERID>  </TENDERID>"),
    _tender("<TENDERID> a\n b\r\nc\td </TENDERID><TENDERTYPECODE>null</TENDERTYPECODE>"),
    _tender("<TENDERID>a&amp;b &lt;c&gt; &#65;&#x20;&quot;</TENDERID><TENDERTYPECODE>&#32;</TENDERTYPECODE>"),
    _tender("<TENDERID>é漢😀\u0085\u200b</TENDERID>"),
    _tender("<TENDERID>1</TENDERID><TENDERID>2</TENDERID><XX>3</XX>"),
    _tender('zz<TENDERID a="1">1</TENDERID>yy').replace(TENDER, TENDER + ' SEGMENT="1"', 1),
]
ODD = [
    _tender("<tenderid>1</tenderid>"),
    _tender("<TENDERID><X>1</X></TENDERID>"),
    _tender("<TENDERID>a<!-- x -->b</TENDERID>"),
    _tender("<TENDERID><![CDATA[a<b]]></TENDERID>"),
    _tender("<TENDERID>a<?x y?>b</TENDERID>"),
    _document("<X><A>1</A></X>" + ONE),
    _document(RECORD + RECORD),
    _document(ONE, head="<X/>"),
    _document(ONE, idoc="idoc"),
    _document(ONE) + "<x>",
    _document(ONE) + "abc",
    _document(ONE).replace("</r>", ""),
    _tender("<TENDERID<1>/TENDERID>"),
    _tender("<TENDERID>1</TENDERTYPECODE>"),
    _tender("<TENDERID>\x01</TENDERID>"),
    _tender("<TENDERID>\ufffe</TENDERID>"),
    "<r xmlns='u'>" + _document(ONE)[3:],
    "<r><IDOC/></r>",
    "<r><X/></r>",
    "plain text",
    "",
    None,
]


@pytest.mark.parametrize("online", [None, SHOP])
def test_plain_documents_are_read_as_sparks_parser_reads_them(spark, online):
    texts = spark.createDataFrame(list(enumerate(PLAIN + ODD)), "doc_id long, value string")
    known = documents.segment_values(documents.parse(texts).where("error is null"), online_source=online)
    read = documents.plain_segments(texts, F.col("value"), lambda text: text, ["doc_id"], online_source=online)
    rows = lambda df: sorted(df.collect(), key=lambda r: (r.doc_id, r.pos))
    plain = F.col("doc_id") < len(PLAIN)
    assert rows(read.where(plain & ~F.col("segment_name").isin(*documents.NO_SEGMENTS))) == rows(known.where(plain))
    records = documents.source_documents(documents.parse(texts).where("error is null"))
    listed = documents.listed_rows(read, documents.SOURCE_ROW, schemas.SOURCE_DOCUMENT_COLUMNS)
    assert rows_by_id(listed) == rows_by_id(records.where(plain))
    # All others are left to the parser, with their text.
    left = documents.listed_rows(read, documents.UNREAD_ROW, ["id", "value"])
    assert rows_by_id(left) == [(i, str(i), x) for i, x in enumerate(PLAIN + ODD) if i >= len(PLAIN)]


def rows_by_id(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_load_reads_plain_and_other_documents_alike(spark):
    payload = messages.encode_payload(F.col("value"))
    texts = spark.createDataFrame(list(enumerate(PLAIN + ODD)), "doc_id long, value string")
    raw = texts.select("doc_id", messages.envelope(F.lit(messages.MESSAGE_TYPE), F.coalesce(payload, F.lit("@"))).alias("value"))
    with tables.temporary(spark):
        flat, sources, bad = ingest.read_documents(raw, ingest.Settings(online_source=SHOP), tables.cut_buckets)
        good, broken = documents.parse_documents(texts)
        known = documents.segment_values(good, online_source=SHOP)
        order = lambda df: sorted(df.select(known.columns).collect(), key=lambda r: (r.doc_id, r.pos))
        assert order(flat) == order(known)
        assert rows_by_id(sources.na.fill("")) == rows_by_id(documents.source_documents(good).na.fill(""))
        assert bad.count() == broken.count() > 0
        assert {(r.error, r.message_type) for r in bad.collect()} == {("unreadable document", messages.MESSAGE_TYPE)}


def test_shuffle_files_go_when_a_query_of_a_load_ends(spark):
    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager()

    def blocks():
        return sum(1 for b in _all_blocks(store) if b.startswith("shuffle_"))

    before = blocks()
    with tables.temporary(spark):
        spark.range(1000).repartition(7).write.format("noop").mode("overwrite").save()
        for _ in range(50):
            if blocks() <= before:
                break
            time.sleep(0.1)
        assert blocks() <= before


def test_lines_of_a_load_are_not_moved_but_packs(spark, segment, dicts):
    """Lines, their marks and tenders lie in buckets of the document."""
    lines = [{"retailtypecode": "2001", "itemid": i, "retailquantity": "1", "salesamount": "5", "retailsequencenumber": "1",
              "doc_id": d, "transactiontypecode": "1002"} for d in range(9) for i in ("A", "9UP9", None)]
    paid = [{"tenderamount": "15.5", "doc_id": d, "transactiontypecode": "1002"} for d in range(9)]
    xml = documents.build_xml({"E1BPRETAILLINEITEM": segment(lines), "E1BPTENDER": segment(paid)})
    raw = xml.select("doc_id", messages.envelope(F.lit(messages.MESSAGE_TYPE), messages.encode_payload(F.col("value"))).alias("value"))
    plans = []

    def settle(df, *args, **more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return tables.cut_buckets(df, *args, **more)

    with tables.temporary(spark), tables.meeting_in_buckets(spark):
        flat, _, _ = ingest.read_documents(raw, ingest.Settings(online_source=SHOP), tables.cut_buckets)
        items = ingest.corrected(flat, dicts, settle)["E1BPRETAILLINEITEM"]
        claims, _ = plans
        assert "Exchange hashpartitioning" not in claims
        assert sorted((r.itemid or "", r.unresolved) for r in items.where("doc_id = 3").collect()) == [
            ("", False), ("9UP9", True), ("A", False), ("S000004", False)]
        # Whole documents lie in one bucket each.
        at = items.select("doc_id", F.regexp_extract(F.input_file_name(), "_(\\d+)\\.c000", 1).alias("bucket")).distinct()
        assert at.where("bucket <> ''").count() == 9


def _all_blocks(store):
    found = store.diskBlockManager().getAllBlocks()
    return [found.apply(i).name() for i in range(found.size())]


def test_write_targets_is_idempotent_per_load(spark, tmp_path):
    df = spark.range(10)
    for _ in range(2):
        tables.write_targets({"a": df, "b": df.where("id < 3")}, "one", str(tmp_path))
    tables.write_targets({"a": df}, "two", str(tmp_path))
    assert tables.read_target(spark, str(tmp_path), "a").groupBy("load_id").count().count() == 2
    assert tables.read_target(spark, str(tmp_path), "a").count() == 20
    assert tables.read_target(spark, str(tmp_path), "b").count() == 3
    # What a repeated load replaced is gone, not only hidden.
    assert spark.read.parquet(f"{tmp_path}/b").count() == 3


def test_a_failed_load_shows_nothing(spark, tmp_path):
    base, df = str(tmp_path), spark.range(10)
    tables.write_targets({"a": df, "b": df}, "one", base)
    broken = df.select(F.raise_error(F.lit("no space left")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no space left"):
        tables.write_targets({"a": df, "b": broken, "c": df}, "two", base)
    assert [tables.read_target(spark, base, n).count() for n in "ab"] == [10, 10]
    assert tables.commits(spark, base).select("load_id").distinct().count() == 1
    # A load whose process dies before its commit leaves files that nobody reads.
    df.write.parquet(f"{base}/a/load_id=three/attempt=a-dead")
    assert tables.read_target(spark, base, "a").count() == 10
    # Sent again, it appears; a repeat that fails keeps what the first attempt committed.
    tables.write_targets({"a": df, "b": df}, "two", base)
    with pytest.raises(Exception, match="no space left"):
        tables.write_targets({"a": df, "b": broken}, "two", base)
    assert [tables.read_target(spark, base, n).count() for n in "ab"] == [20, 20]


def test_commit_records_tell_rows_and_files(spark, tmp_path):
    df = spark.range(100).repartition(7)
    at = datetime(2024, 5, 1, 10)
    tables.write_targets({"a": df, "none": df.where("id < 0")}, "1", str(tmp_path), at)
    rows = {r.target: r for r in tables.commits(spark, str(tmp_path)).collect()}
    assert rows["a"].rows_added == 100 and rows["none"].rows_added == 0
    assert rows["a"].files_added == len([f for f in glob.glob(f"{tmp_path}/a/*/*/part-*")]) == 1
    assert rows["a"].committed_at == at and rows["a"].load_id == "1"
    assert tables.read_target(spark, str(tmp_path), "none").columns == ["id", "load_id"]


def test_target_files_are_sized(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "TARGET_BYTES", 200_000)
    df = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("x"))
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name, None)
    tables.write_targets({"a": df}, "one", str(tmp_path))
    assert tables.commits(spark, str(tmp_path)).first().files_added > 4
    assert spark.conf.get(name, None) == before


def test_rows_of_a_transaction_are_written_side_by_side(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "TARGET_BYTES", 2_000_000)
    text = F.sha2(F.col("id").cast("string"), 256).alias("x")
    key = F.when(F.col("id") % 400 != 0, (F.col("id") % 400).cast("string")).alias("txn_key")
    df = spark.range(90_000).repartition(3).select(text, key)
    tables.write_targets({"a": df}, "one", str(tmp_path))
    assert tables.read_target(spark, str(tmp_path), "a").drop("load_id").exceptAll(df).isEmpty()
    stored = spark.read.parquet(f"{tmp_path}/a").withColumn("file", F.input_file_name())
    assert stored.select("file").distinct().count() > 1 and stored.count() == 90_000
    assert stored.groupBy("txn_key").agg(F.countDistinct("file").alias("n")).where("n > 1").isEmpty()


def test_seen_keys_do_not_grow_with_loads(spark, tmp_path):
    path, day = str(tmp_path / "seen"), datetime(2024, 3, 1)
    ttl = int(timedelta(hours=72).total_seconds() * 1000)
    folders, files = [], []
    for batch in range(50):
        now = day + timedelta(hours=5 * batch)
        seen.expire(spark, path, now, ttl)
        seen.compact(spark, path, 3)
        keys = spark.createDataFrame([(f"k{batch}",), ("again",)], "txn_key string")
        seen.add(keys, path, f"live-{batch}", now)
        folders.append(len(seen.days(spark, path)))
        files.append(len(glob.glob(f"{path}/*/*/part-*")))
    # Ten days in batches of five hours: three days and the part of a fourth are kept.
    assert max(folders) <= 4 and max(files[25:]) <= max(files[:25]) and max(files) <= 20
    got = {r.txn_key for r in seen.known(spark, path, now, ttl, "other").collect()}
    assert got == {"again"} | {f"k{b}" for b in range(50) if day + timedelta(hours=5 * b) > now - timedelta(hours=72)}
    own = {r.txn_key for r in seen.known(spark, path, now, ttl, "live-49").collect()}
    assert "k49" not in own and "again" in own
    plan = seen.known(spark, path, now, ttl, "x")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(seen_day" in plan


def test_a_laid_out_history_is_pruned_and_not_moved(spark, tmp_path):
    path = f"file://{tmp_path}/history"
    rows = spark.range(4000).selectExpr(
        "lpad(id % 7, 4, '0') as retailstoreid", "date_add(date'2024-01-01', cast(id % 20 as int)) as businessdaydate",
        "'0000001001' as workstationid", "cast(id as string) as transactionsequencenumber",
    )
    history.lay_out(rows.where("transactionsequencenumber % 2 = 0"), path, "day", 8)
    history.lay_out(rows.where("transactionsequencenumber % 2 = 1"), path, "day", 8)
    stored = history.laid_out_keys(spark, path, date(2024, 1, 18), "day", 8)
    assert sorted(r[0] for r in stored.collect()) == sorted(
        r[0] for r in history.keys_of(rows.where("businessdaydate >= date'2024-01-18'")).collect()
    )
    live = history.keys_of(rows).withColumn("x", F.lit(1))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = history.drop_seen(live, stored)
        assert left.count() == 4000 - 600
        plan = left._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scan = next(part for part in plan.split("FileScan")[1:] if "history_" in part)
    assert "PartitionFilters: [isnotnull(period" in scan and "Bucketed: true" in scan
    # Distinct live keys are exchanged; only a sort may stand between the join and the history's files.
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "history_" in line and "FileScan" in line)
    above = []
    for line in reversed(lines[:at]):
        if "Join" in line or line.lstrip("AE ").startswith(":"):  # the other side
            break
        above.append(line)
    assert not any("Exchange" in line for line in above), plan


def test_document_numbers_rewrite_only_plants_that_grow(spark, tmp_path):
    path = f"{tmp_path}/numbers"
    numbers = [("0001", "31", "0005"), ("0001", "32", "0005"), ("0002", "31", "0009"), ("0003", "31", "0001")]
    erp.store_document_numbers(spark.createDataFrame(numbers, "plant string, doctype string, maxnumber string"), path)
    movements = spark.createDataFrame(
        [(1, "a", 0, "0001", "3100"), (2, "b", 0, "0002", "3100"), (3, "c", 0, "0007", "3100")],
        "doc_id long, txn_key string, pos long, retailstoreid string, financialtypecode string",
    )
    notes = spark.createDataFrame(
        [(1, "a", 0, "NOTE", "XX0007"), (2, "b", 0, "NOTE", "XX0004"), (3, "c", 0, "NOTE", "XX0004")],
        "doc_id long, txn_key string, pos long, fieldname string, fieldvalue string",
    )
    files = lambda p: sorted(glob.glob(f"{path}/plant={p}/part-*"))
    before = {p: files(p) for p in ("0001", "0002", "0003")}
    erp.raise_document_numbers(movements, notes, path)
    assert files("0001") != before["0001"] and all(files(p) == before[p] for p in ("0002", "0003"))
    want = {("0001", "31", "0007"), ("0001", "32", "0005"), ("0002", "31", "0009"), ("0003", "31", "0001")}
    stored = lambda: {(r.plant, r.doctype, r.maxnumber) for r in erp.stored_document_numbers(spark, path).collect()}
    assert stored() == want
    after = files("0001")
    erp.raise_document_numbers(movements, notes, path)
    assert stored() == want and files("0001") == after


def test_dictionaries_reload_only_when_due(spark, tmp_path):
    paths = {n: f"{tmp_path}/{n}" for n in ("marm", "tvarvc", "export")}
    for p in paths.values():
        spark.range(1).write.parquet(p)
    now = [0.0]
    cache = tables.Dictionaries(spark, paths, flag_interval_s=600, clock=lambda: now[0])
    for n in paths:
        cache.get(n), cache.get(n)
    assert set(cache.reloads.values()) == {1}
    for p in paths.values():
        spark.range(5).write.mode("overwrite").parquet(p)
    assert cache.get("marm").count() == 5
    for n in paths:
        cache.get(n)
    assert cache.reloads == {"marm": 2, "tvarvc": 1, "export": 1}
    now[0] = 601
    assert cache.get("tvarvc").count() == 5


@pytest.fixture(scope="module")
def dicts(spark):
    flags = [("CHK_FIXES", "S", f) for f in ("2125781", "2525942")]
    return {
        "marm": spark.createDataFrame([], schemas.MARM),
        "mean": spark.createDataFrame([], schemas.MEAN),
        "mara": spark.createDataFrame([], schemas.MARA),
        "tvarvc": spark.createDataFrame(flags, schemas.TVARVC),
        "export": spark.createDataFrame([(3, "kiosk")], schemas.EXPORT),
    }


def stage_folders(spark):
    """Intermediate tables there are; a load must leave none."""
    return {p for p in os.listdir(spark.conf.get("spark.checkpoint.dir")) if p.startswith("stage-")}


def test_a_load_writes_every_table(spark, segment, dicts, tmp_path):
    """Two transactions merge under the online workstation; corrections still see two."""
    shop = {"fieldname": "SOURCE", "fieldvalue": SHOP}
    other = {"workstationid": "0000001002"}
    segments = {
        "E1BPTRANSACTION": segment([{"operatorid": "9"}, other, {"transactionsequencenumber": "8"}]),
        "E1BPTRANSACTEXTENSIO": segment([shop, {**other, "fieldname": "CH_SOURCE", "fieldvalue": " 3 "},
                                         {"fieldname": "MobileNum", "fieldvalue": "5", "transactionsequencenumber": "8"}]),
        "E1BPRETAILLINEITEM": segment([
            {"retailtypecode": "2001", "itemid": "A", "retailquantity": "1", "salesamount": "5", "retailsequencenumber": "1"},
            {**other, "retailtypecode": "2901", "itemid": "A", "retailquantity": "-1", "salesamount": "-5", "retailsequencenumber": "2"},
            {"retailtypecode": "2001", "itemid": "9UP9", "retailquantity": "1", "salesamount": "5",
             "transactionsequencenumber": "8", "retailsequencenumber": "1"}]),
        "E1BPLINEITEMEXTENSIO": segment([{"fieldgroup": "POS", "fieldname": "AUTO_MD", "fieldvalue": "Y", "retailsequencenumber": "1"}]),
        "E1BPTRANSACTIONDISCO": segment([{"discounttypecode": "5", "discountsequencenumber": "1"}]),
    }
    xml = documents.build_xml(segments)
    raw = xml.select(messages.envelope(F.lit(messages.MESSAGE_TYPE), messages.encode_payload(F.col("value"))).alias("value"))
    raw = raw.unionAll(raw).unionAll(spark.createDataFrame([("MSGTYPEsplitX\nDATAsplitq",)], "value string"))
    before = stage_folders(spark)
    counts = ingest.ingest_batch(raw, dicts, ingest.Settings(online_source=SHOP), str(tmp_path), LOAD, "one")
    # Both sendings are read; of the three transactions two are loaded, merged under one key.
    assert counts == {"segments": 22, "transactions": 1}
    assert stage_folders(spark) == before
    read = lambda n: tables.read_target(spark, str(tmp_path), n)
    # The unresolved pack drops transaction 8 everywhere, the repeated message adds nothing.
    assert read("raw_bptransaction").count() == 2
    assert {r.workstationid for r in read("pst_bptransaction").collect()} == {"0000001002"}
    # A cancellation of another original transaction claims nothing.
    items = read("pst_bpretaillineitem").orderBy("retailsequencenumber").collect()
    assert [r.retailtypecode for r in items] == ["2043", "2901"]
    # Merged, the sums are equal (zero), so the flag is true.
    assert {r.is_aligned_tran for r in read("raw_bptransaction").collect()} == {True}
    assert [r.fieldvalue for r in read("raw_bptransactextensio").where("fieldname = 'CH_SOURCE'").collect()] == ["kiosk"]
    assert [(r.discounttypecode, r.operatorid) for r in read("raw_bptransactiondisco").collect()] == [("105", "9")]
    assert [r.error for r in read("quarantine").collect()] == ["wrong message type"]
    key = read("raw_bptransaction").first()
    assert len(key.rtl_txn_rk) == 8 and key.load_ts == LOAD


def test_a_damaged_code_and_a_resend_after_an_unresolved_pack(spark, segment, dicts, tmp_path):
    def message(item, code):
        segments = {
            "E1BPTRANSACTION": segment([{"operatorid": "9"}]),
            "E1BPRETAILLINEITEM": segment([{"retailtypecode": "2001", "itemid": item, "retailquantity": "1",
                                            "salesamount": "5", "retailsequencenumber": "1"}]),
            "E1BPTRANSACTIONDISCO": segment([{"discounttypecode": code, "discountsequencenumber": "1"},
                                             {"discounttypecode": "7", "discountsequencenumber": "2"}]),
        }
        xml = documents.build_xml(segments)
        payload = messages.encode_payload(F.col("value"))
        return xml.select(messages.envelope(F.lit(messages.MESSAGE_TYPE), payload).alias("value"))

    settings, base = ingest.Settings(online_source=SHOP), str(tmp_path / "load")
    path = str(tmp_path / "in")
    spark.createDataFrame([], "value string").write.parquet(path)
    paths = {}
    for name, df in dicts.items():
        paths[name] = str(tmp_path / name)
        df.write.parquet(paths[name])
    stream = tables.stream_table(spark, path, message("A", "5").schema)
    checkpoint = str(tmp_path / "checkpoint")

    def arrive(*sent):
        for raw in sent:
            raw.write.mode("append").parquet(path)
        writer = ingest.stream_writer(stream, tables.Dictionaries(spark, paths), settings, base, "live")
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()

    def stored(name):
        return tables.read_target(spark, base, name)

    before = stage_folders(spark)
    arrive(message("9UP9", "x1"))  # no such pack: dropped, and not seen
    assert stored("raw_bptransaction").count() == 0
    arrive(message("A", "x1"))  # sent again with a good item, still with a damaged code
    assert stored("raw_bptransaction").count() == 1
    arrive(message("A", "5"))  # a repeat of a loaded key adds nothing
    assert stored("raw_bptransaction").count() == 1
    assert [r.discounttypecode for r in stored("raw_bptransactiondisco").collect()] == ["107"]
    assert {r.error for r in stored("quarantine_segments").collect()} == {"discount code is no number"}
    assert stage_folders(spark) == before
