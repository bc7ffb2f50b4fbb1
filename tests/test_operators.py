import random

import pytest
from pyspark.sql import Window, functions as F

from tillstream.operators import cancel, corrections, dictionaries, erp, history, ordered
from tillstream.operators import outbound, staging, synthetic

AMOUNTS = {"retailquantity": "decimal(32,3)", "salesamount": "decimal(32,2)"}


def dec(x):
    from decimal import Decimal

    return None if x is None else Decimal(str(x))


@pytest.fixture
def lines(segment):
    def build(*rows):
        return segment(
            [
                {
                    "retailsequencenumber": str(n),
                    "retailtypecode": code,
                    "itemid": item,
                    "retailquantity": dec(qty),
                    "salesamount": dec(amount),
                    "itemidqualifier": "2",
                    "salesunitofmeasure": "PC",
                }
                for n, (code, item, qty, amount) in enumerate(rows)
            ],
            **AMOUNTS,
        )

    return build


@pytest.fixture
def marks(segment):
    def build(*rows):
        return segment(
            [
                {
                    "retailsequencenumber": str(n),
                    "fieldgroup": "TAX" if kind == "TAX" else "EXT",
                    "fieldname": kind,
                    "fieldvalue": value,
                }
                for n, kind, value in rows
            ]
            or [{"retailsequencenumber": None, "fieldgroup": "", "fieldname": "", "fieldvalue": ""}]
        )

    return build


def codes(df):
    return [r[0] for r in df.orderBy("pos").select("retailtypecode").collect()]


def test_cancel_claims_the_first_line_once(lines, marks):
    items = lines(
        ("2001", "A", 1, 5), ("2001", "A", 1, 5), ("2001", "B", 1, 5),
        ("2901", "A", -1, -5), ("2901", "B", -2, -5),
    )
    assert codes(cancel.cancel_items(items, marks())) == ["2902", "2001", "2001", "2901", "2901"]


def test_cancel_matches_items_without_id_and_skips_claimed_codes(lines, marks):
    items = lines(("2902", None, 1, 5), ("2001", None, 1, 5), ("2901", None, -1, -5))
    assert codes(cancel.cancel_items(items, marks())) == ["2902", "2902", "2901"]


def test_tax_mark_wins_then_code_then_first(lines, marks):
    items = lines(*[("2001", "A", 1, 5)] * 4, *[("2901", "A", -1, -5)] * 3)
    ext = marks((2, "TAX", "x"), (2, "TAX", "y"), (4, "TAX", "x"), (4, "TAX", "y"),
                (3, "DATAMATRIX", "q"), (5, "TAX", "none"), (5, "DATAMATRIX", "q"))
    assert codes(cancel.cancel_items(items, ext))[:4] == ["2902", "2001", "2902", "2902"]


def test_both_marks_mode_may_claim_two(lines, marks):
    items = lines(*[("2001", "A", 1, 5)] * 3, ("2901", "A", -1, -5))
    ext = marks((1, "TAX", "x"), (2, "DATAMATRIX", "q"), (3, "TAX", "x"), (3, "DATAMATRIX", "q"))
    assert codes(cancel.cancel_items(items, ext))[:3] == ["2001", "2902", "2001"]
    assert codes(cancel.cancel_items(items, ext, mode="both"))[:3] == ["2001", "2902", "2902"]


def test_null_tax_value_is_skipped(lines, marks):
    items = lines(("2001", "A", 1, 5), ("2001", "A", 1, 5), ("2901", "A", -1, -5))
    ext = marks((1, "TAX", "x"), (1, "TAX", None), (2, "TAX", "x"))
    assert codes(cancel.cancel_items(items, ext))[:2] == ["2001", "2902"]


def brute_force(rows, ext, both):
    tax, code = {}, {}
    for n, kind, value in ext:
        if kind == "TAX":
            tax[n] = tax.get(n, "") + value
        else:
            code[n] = value
    state = [r[0] for r in rows]
    for c, (kind, item, qty, amount) in enumerate(rows):
        if kind != "2901":
            continue

        def claim(test):
            for i, (k, it, q, a) in enumerate(rows):
                if state[i] != "2902" and k == "2001" and (it, q, a) == (item, -qty, -amount):
                    if test(i):
                        state[i] = "2902"
                        return True
            return False

        done = bool(tax.get(c)) and claim(lambda i: tax.get(i) == tax[c])
        if (not done or both) and code.get(c):
            done = claim(lambda i: code.get(i) == code[c]) or done
        if not done:
            claim(lambda i: True)
    return state


@pytest.mark.parametrize("seed,both", [(1, False), (2, False), (3, True)])
def test_cancel_equals_brute_force(lines, marks, seed, both):
    rng = random.Random(seed)
    rows = [
        (("2001", i, 1, 5) if rng.random() < 0.6 else ("2901", i, -1, -5))
        for i in rng.choices("AB", k=60)
    ]
    ext = [
        (n, rng.choice(["TAX", "DATAMATRIX"]), rng.choice("xyz"))
        for n in range(60)
        for _ in range(rng.randrange(3))
    ]
    got = codes(cancel.cancel_items(lines(*rows), marks(*ext), "both" if both else "newest"))
    assert got == brute_force(rows, ext, both)


def test_lines_and_marks_cross_the_network_once_for_all_groups(lines, marks):
    items = lines(("2001", "A", 1, 5), ("2901", "A", -1, -5))
    plan = cancel.claimed_items(items, marks((0, "TAX", "x")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_settled_claims_are_made_once_and_alike(lines, marks):
    items = lines(("2001", "A", 1, 5), ("2001", "A", 1, 5), ("2901", "A", -1, -5))
    written = []

    def settle(df):
        written.append(df.columns)
        return df.localCheckpoint()

    for dealt in (False, True):
        out = cancel.cancel_items(items, marks((1, "TAX", "x"), (2, "TAX", "x")), settle=settle, dealt=dealt)
        assert codes(out) == ["2001", "2902", "2901"]
        assert "collect_list" not in out._jdf.queryExecution().executedPlan().toString()
    assert written == [["doc_id", "txn5", "pos"]] * 2


def test_cancel_keeps_lines_without_document(lines, marks):
    items = lines(("2001", "A", 1, 5), ("2901", "A", -1, -5)).withColumn("doc_id", F.lit(None).cast("long"))
    assert codes(cancel.cancel_items(items, marks())) == ["2001", "2901"]


def test_blocked_rank_and_running_min_equal_the_plain_window(spark):
    rng = random.Random(5)
    rows = [(g, p, rng.randrange(100)) for g in "ab" for p in rng.sample(range(1000), 200)]
    df = spark.createDataFrame(rows, "g string, pos long, v int")
    block = F.floor(F.col("pos") / 50)
    w = Window.partitionBy("g").orderBy("pos")
    ranked = ordered.rank_in_group(df, ["g"], ["pos"], block)
    plain = df.withColumn("_rank", F.row_number().over(w))
    assert ranked.exceptAll(plain).isEmpty() and plain.count() == ranked.count()
    low = ordered.running_min_before(df, ["g"], ["pos"], F.col("v"), "m", block)
    want = df.withColumn("m", F.min("v").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    assert low.exceptAll(want).isEmpty() and want.count() == low.count()


def test_recode_and_qualifier(lines, values):
    items = corrections.recode_items(
        lines(("2901", "A", 0, 1), ("2901", "A", None, 1), ("2901", "A", -1, 1), ("2010", "A", 1, 1))
    )
    assert codes(items) == ["2001", "2001", "2901", "2010"]
    assert [r[0] for r in items.orderBy("pos").select("itemidqualifier").collect()] == [
        "2", "2", "2", None,
    ]


@pytest.fixture
def paid(segment):
    def build(*amounts, **header):
        return segment(
            [
                {"tendersequencenumber": str(n), "tendertypecode": code, "tenderamount": dec(a), **header}
                for n, (code, a) in enumerate(amounts)
            ],
            tenderamount="decimal(32,2)",
        )

    return build


def test_surplus_rounding_line_goes_and_an_emptied_receipt_is_fine(lines, paid):
    items = lines(("2006", "S", 1, "0.30"))
    sums = corrections.txn_sums(items, paid(("3101", 0)))
    assert corrections.drop_rounding_items(items, sums).count() == 0


def test_rounding_line_is_added_below_one_only(segment, paid):
    def run(total):
        items = segment([{"retailtypecode": "2001", "salesamount": dec(10), "transactiontypecode": "1002"}],
                        salesamount="decimal(32,2)")
        sums = corrections.txn_sums(items, paid(("3101", total), transactiontypecode="1002"))
        return [tuple(r) for r in corrections.rounding_items(items, sums).select(
            "salesamount", "retailsequencenumber", "itemid").collect()]

    assert run("10.99") == [(dec("0.99"), "2", "S000004")]
    assert run("11") == [] and run("10") == []


def test_align_flag_modes(lines, paid, segment):
    txns = segment([{}, {"transactiontypecode": "1101"}])
    none = paid(("3101", None))
    items = lines(("2001", "A", 1, None))
    newest = corrections.align_flag(txns, items, none)
    strict = corrections.align_flag(txns, items, none, "strict")
    flag = lambda df: [r[0] for r in df.orderBy("pos").select("is_aligned_tran").collect()]
    assert flag(newest) == [True, None] and flag(strict) == [None, None]


def test_packs(spark, segment, values):
    items = segment([{"itemid": i, "itemidqualifier": "2", "salesunitofmeasure": "PC"}
                     for i in ("5UP4", "6UP4", "7UP4", "5", None)])
    marm = spark.createDataFrame([(f"{m:018d}", "PAK", "4") for m in (5, 6)], "matnr string, meinh string, umrez string")
    mean = spark.createDataFrame(
        [(f"{5:018d}", "PAK", "00001", e) for e in ("222", "111", "")] + [(f"{6:018d}", "PAK", "00001", "")],
        "matnr string, meinh string, lfnum string, ean11 string")
    mara = spark.createDataFrame([(f"{5:018d}", "ST")], "matnr string, meins string")
    out = dictionaries.resolve_packs(items, marm, mean, mara)
    got = [tuple(r) for r in out.orderBy("pos").select(
        "itemid", "itemidqualifier", "salesunitofmeasure", "has_ean", "unresolved").collect()]
    # The smallest non-empty EAN wins, with the base unit; a mapping without EAN stays unresolved.
    assert got == [("111", "1", "ST", True, False), ("6UP4", "2", "PC", False, True),
                   ("7UP4", "2", "PC", None, True), ("5", "2", "PC", None, False),
                   (None, "2", "PC", None, False)]
    assert dictionaries.drop_unresolved(items, out).count() == 0


def test_note_lookup_tests_the_incoming_name(segment, values):
    ext = segment([{"fieldname": "DOCNUMBER", "fieldvalue": "D1"}, {"fieldname": "DOCNUMBER", "fieldvalue": "D2x"},
                   {"fieldname": "NOTE", "fieldvalue": "other"}])
    assert values(staging.last_notes(ext), "note") == [("D2x",)]
    moves = segment([{"financialtypecode": c, "amount": "5.00"} for c in ("3100", "3169", None)])
    out = staging.stage_movements(moves, staging.last_notes(ext))
    assert [tuple(map(str, r)) for r in out.orderBy("pos").select("amount", "refererenceid").collect()] == [
        ("-5.00", "D1x"), ("5.00", "None"), ("5.00", "None")]
    assert values(synthetic.storno_extensions(moves, staging.last_notes(ext)), "fieldvalue") == [("D1x",)]


def test_synthetic_tender_rules(segment, lines, paid, values):
    kind = {"transactiontypecode": "1014"}
    txns = segment([kind])
    items = segment([{**kind, "retailtypecode": "2001", "salesamount": dec(0)},
                     {**kind, "retailtypecode": "2020", "salesamount": dec(9)}], salesamount="decimal(32,2)")
    ext = segment([{**kind, "fieldname": "CH_SOURCE", "fieldvalue": "my.shop.x"}])
    none = paid(("3101", 1), transactiontypecode="1014").where("false")
    cols = ["tendersequencenumber", "tenderamount", "workstationid"]
    run = lambda tenders, **kw: [tuple(map(str, r)) for r in synthetic.synthetic_tenders(
        txns, items, tenders, ext, "my.shop", **kw).select(*cols).collect()]
    # Zero sales still pay; CH_SOURCE contains SOURCE, so the workstation is the online one.
    assert run(none) == [("8", "0.00", "0000001002")]
    assert run(none, mode="older") == [("7", "9.00", "0000001002")]
    assert run(paid(("3101", "0.5"), **kind)) == []
    assert run(paid(("3101", "0.5"), **kind), threshold="0.01") == [("9", "-0.50", "0000001002")]


def test_first_rows_and_rededup(spark, values):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z"), (None, 1, "n")],
                               "txn_key string, pos int, v string")
    assert values(history.first_rows(df, ["txn_key"], ["pos"]), "txn_key", "v") == [
        ("a", "y"), ("b", "z"), (None, "n")]
    seen = spark.createDataFrame([("b",)], "txn_key string")
    assert values(history.rededup(df, seen, ["pos"]), "v") == [("n",), ("y",)]


def test_history_days_are_normalised(spark, segment):
    from datetime import date

    stored = spark.createDataFrame([("0001", date(2024, 1, 2), "0000001001", "7")],
                                   "retailstoreid string, businessdaydate date, workstationid string, transactionsequencenumber string")
    keys = history.keys_of(history.history_rows(stored, 3, date(2024, 1, 5)))
    assert history.drop_seen(segment([{}]), keys).isEmpty()
    late = history.keys_of(history.history_rows(stored, 3, date(2024, 1, 6)))
    assert history.drop_seen(segment([{}]), late).count() == 1


def test_virtual_day_follows_the_running_store_close(spark, segment):
    rows = [("1601", "0000000000", "030000"), ("1601", "0000001001", "040000"), ("1601", "0000000000", "020000"),
            ("1601", "0000000000", "025000"), ("1301", "0000001001", "020000"), ("1001", "0000001001", "020001"),
            ("1601", "0000001001", "070000"), ("1101", "0000001001", "010000")]
    txns = segment([{"transactiontypecode": k, "workstationid": w, "begindatetimestamp": "20240102" + t}
                    for k, w, t in rows])
    none = spark.createDataFrame([], "retailstoreid string, businessdaydate string, closedate string")
    out = erp.shift_virtual_day(txns, none, "060000").orderBy("pos")
    assert [r.moved for r in out.collect()] == [True, False, True, False, True, False, False, False]
    assert out.first().businessdaydate == "20240101"


def test_document_numbers_only_grow(spark, segment, values):
    moves = segment([{"financialtypecode": "3100", "refererenceid": ""}])
    notes = segment([{"fieldname": "NOTE", "fieldvalue": "D10042"}])
    current = spark.createDataFrame([("0001", "31", "0041"), ("0001", "32", "0041"), ("0002", "31", "0050")],
                                    "plant string, doctype string, maxnumber string")
    got = values(erp.max_document_numbers(moves, notes, current), "plant", "doctype", "maxnumber")
    assert got == [("0001", "31", "0042"), ("0001", "32", "0041"), ("0002", "31", "0050")]


def test_a_movement_is_one_document_in_order(spark):
    cols = [*outbound.HEADER, *outbound.ITEM]
    rows = [("k", *[None if c == "retailstoreid" else c for c in cols], "G", f"N{i}", "v", i) for i in range(25)]
    rows += [("m", *cols, "G", None, "v", 0)]
    schema = ", ".join(["key string", *[f"{c} string" for c in cols], "fieldgroup string", "fieldname string", "fieldvalue string", "pos int"])
    docs = outbound.build_documents(spark.createDataFrame(rows, schema), key="key")
    got = docs.orderBy("key").collect()
    assert [(r.key, r.retailstoreid, r.extension_count) for r in got] == [("k", "UNKNOWN", 25), ("m", "retailstoreid", 0)]
    assert [x.fieldname for x in got[0].extensions] == [f"N{i}" for i in range(25)]
    assert got[1].extensions is None
    xml = outbound.document_xml(docs).where("key = 'm'").first().xml
    assert "<WPUFIB01>" in xml and 'BEGIN="1"' in xml
