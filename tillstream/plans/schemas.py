"""Segment columns and target table schemas.

The source publishes no table definitions; these follow the element lists of the
documents.  Segments are text; a target schema decides what becomes typed.
"""

from __future__ import annotations

from pyspark.sql import types as T

from tillstream.functions.keys import BASE

# Segment name -> columns after the five header columns.
SEGMENTS = {
    "E1BPTRANSACTION": [
        "begindatetimestamp", "enddatetimestamp", "department", "operatorqualifier",
        "operatorid", "transactioncurrency", "transactioncurrency_iso", "partnerqualifier",
        "partnerid",
    ],
    "E1BPRETAILLINEITEM": [
        "retailsequencenumber", "retailtypecode", "retailreasoncode", "itemidqualifier",
        "itemid", "retailquantity", "salesunitofmeasure", "salesunitofmeasure_iso",
        "salesamount", "normalsalesamount", "cost", "batchid", "serialnumber", "promotionid",
        "itemidentrymethodcode", "actualunitprice", "units", "nonexistentarticleid",
        "regularsalesamount", "scantime",
    ],
    "E1BPTENDER": [
        "tendersequencenumber", "tendertypecode", "tenderamount", "tendercurrency",
        "tendercurrency_iso", "tenderid", "accountnumber", "refererenceid",
    ],
    "E1BPTENDEREXTENSIONS": ["tendersequencenumber", "fieldgroup", "fieldname", "fieldvalue"],
    "E1BPTRANSACTEXTENSIO": ["fieldgroup", "fieldname", "fieldvalue"],
    "E1BPLINEITEMEXTENSIO": ["retailsequencenumber", "fieldgroup", "fieldname", "fieldvalue"],
    "E1BPLINEITEMDISCOUNT": [
        "retailsequencenumber", "discountsequencenumber", "discounttypecode", "reductionamount",
    ],
    "E1BPLINEITEMDISCEXT": [
        "retailsequencenumber", "discountsequencenumber", "fieldgroup", "fieldname", "fieldvalue",
    ],
    "E1BPTRANSACTDISCEXT": ["discountsequencenumber", "fieldgroup", "fieldname", "fieldvalue"],
    "E1BPFINANCIALMOVEMEN": [
        "financialsequencenumber", "financialtypecode", "accountid", "accountassignmentobject",
        "amount", "financialcurrency", "financialcurrency_iso", "refererenceid",
    ],
    "E1BPFINACIALMOVEMENT": [
        "financialsequencenumber", "fieldgroup", "fieldname", "fieldvalue",
    ],
    "E1BPTRANSACTIONDISCO": [
        "discountsequencenumber", "discounttypecode", "discountreasoncode", "reductionamount",
        "storefinancialledgeraccountid", "discountid", "discountidqualifier", "bonusbuyid",
        "offerid",
    ],
    "E1BPTENDERTOTALS": [
        "tendertypecode", "tenderamount", "tendercount", "actualamount", "shortamount",
        "overamount", "removalamount", "removalcount", "bankamount",
    ],
    "E1BPLINEITEMTAX": ["retailsequencenumber", "taxsequencenumber"],
    "E1BPRETAILTOTALS": [],
    "E1BPLINEITEMVOID": [],
    "E1BPPOSTVOIDDETAILS": [],
}

# The order in which a document's segment lists are concatenated.
FLATTEN_ORDER = [
    "E1BPFINANCIALMOVEMEN", "E1BPFINACIALMOVEMENT", "E1BPLINEITEMDISCEXT",
    "E1BPLINEITEMDISCOUNT", "E1BPLINEITEMEXTENSIO", "E1BPLINEITEMTAX", "E1BPRETAILLINEITEM",
    "E1BPRETAILTOTALS", "E1BPTENDER", "E1BPTENDEREXTENSIONS", "E1BPTENDERTOTALS",
    "E1BPTRANSACTDISCEXT", "E1BPTRANSACTION", "E1BPTRANSACTIONDISCO", "E1BPTRANSACTEXTENSIO",
    "E1BPLINEITEMVOID", "E1BPPOSTVOIDDETAILS",
]

SOURCE_DOCUMENT = "E1BPSOURCEDOCUMENTLI"
SOURCE_DOCUMENT_COLUMNS = ["key", "type", "logicalsystem"]

CONTROL_RECORD = [
    "tabnam", "docnum", "direct", "idoctyp", "mestyp", "sndpor", "sndprt", "sndprn", "rcvpor",
    "rcvprt", "rcvprn",
]

# Every segment has a raw table; void segments have a name but no table.
RAW_TABLES = {
    s: "raw_" + s[2:].lower()
    for s in [*SEGMENTS, SOURCE_DOCUMENT]
    if s not in ("E1BPLINEITEMVOID", "E1BPPOSTVOIDDETAILS")
}

# Staged table of each segment that has one.
STAGED_TABLES = {
    "E1BPTRANSACTION": "pst_bptransaction",
    "E1BPRETAILLINEITEM": "pst_bpretaillineitem",
    "E1BPTENDER": "pst_bptender",
    "E1BPTENDEREXTENSIONS": "pst_bptenderextensions",
    "E1BPTRANSACTEXTENSIO": "pst_bptransactextensio",
    "E1BPLINEITEMEXTENSIO": "pst_bplineitemextensio",
    "E1BPLINEITEMDISCOUNT": "pst_bplineitemdiscount",
    "E1BPLINEITEMDISCEXT": "pst_bplineitemdiscountext",
    "E1BPTRANSACTDISCEXT": "pst_bptransactdiscoext",
    "E1BPFINANCIALMOVEMEN": "pst_bpfinancialmovemen",
    "E1BPFINACIALMOVEMENT": "pst_bpfinancialmovementextensio",
}

_KEYS_OF = {
    "E1BPRETAILLINEITEM": ["rtl_txn_item_rk"],
    "E1BPTENDER": ["rtl_txn_tender_rk"],
    "E1BPTENDEREXTENSIONS": ["rtl_txn_tender_rk"],
    "E1BPLINEITEMEXTENSIO": ["rtl_txn_item_rk"],
    "E1BPLINEITEMDISCOUNT": ["rtl_txn_item_rk", "rtl_txn_item_disc_rk"],
    "E1BPLINEITEMDISCEXT": ["rtl_txn_item_rk", "rtl_txn_item_disc_rk"],
    "E1BPTRANSACTDISCEXT": ["rtl_txn_disc_rk"],
    "E1BPFINANCIALMOVEMEN": ["rtl_txn_fin_rk"],
    "E1BPFINACIALMOVEMENT": ["rtl_txn_fin_rk"],
    "E1BPTRANSACTIONDISCO": ["rtl_txn_disc_rk"],
    "E1BPLINEITEMTAX": ["rtl_txn_item_tax_rk"],
}

_TYPES = {
    "businessdaydate": T.DateType(),
    "begindatetimestamp": T.TimestampNTZType(),
    "enddatetimestamp": T.TimestampNTZType(),
    "retailquantity": T.DecimalType(32, 3),
    "units": T.DecimalType(32, 3),
    "salesamount": T.DecimalType(32, 2),
    "tenderamount": T.DecimalType(32, 2),
    "tendercount": T.IntegerType(),
    "is_aligned_tran": T.BooleanType(),
}

LOAD_COLUMNS = {
    "load_ts": T.TimestampNTZType(),
    "load_date": T.DateType(),
    "load_ts_xml": T.TimestampNTZType(),
    "load_date_xml": T.DateType(),
}


def _extra(segment: str) -> list[str]:
    if segment == "E1BPTRANSACTEXTENSIO":
        return ["is_head_bonid"]
    if segment == "E1BPTRANSACTIONDISCO":
        return ["operatorid"]
    if segment == "E1BPRETAILLINEITEM":
        return ["matnr_padded", "umrez_val", "lfnum", "ean11"]
    return []


def raw_schema(segment: str) -> T.StructType:
    """Target schema of a segment's raw table."""
    fields = [T.StructField(k, T.BinaryType()) for k in ["rtl_txn_rk", *_KEYS_OF.get(segment, [])]]
    names = [*BASE, *SEGMENTS[segment], *_extra(segment), "is_aligned_tran"]
    fields += [T.StructField(n, _TYPES.get(n, T.StringType())) for n in names]
    fields += [T.StructField(n, t) for n, t in LOAD_COLUMNS.items()]
    return T.StructType(fields)


_HEAD = ["retailstoreid", "transactionsequencenumber", "transactiontypecode", "workstationid"]
_TAIL = ["load_ts", "load_date_xml", "load_ts_xml"]

# Columns each staged table copies; businessdaydate and computed ones are added by rule.
STAGED_COLUMNS = {
    "pst_bptransaction": [
        "rtl_txn_rk", "operatorid", "transactioncurrency", *_HEAD, *_TAIL, "is_aligned_tran",
    ],
    "pst_bptransactextensio": [
        "rtl_txn_rk", "fieldgroup", "fieldname", *_HEAD, *_TAIL, "is_aligned_tran",
    ],
    "pst_bpfinancialmovemen": [
        "rtl_txn_rk", "rtl_txn_fin_rk", "financialcurrency", "financialcurrency_iso",
        "financialsequencenumber", "financialtypecode", *_HEAD, *_TAIL,
    ],
    "pst_bpfinancialmovementextensio": [
        "rtl_txn_rk", "rtl_txn_fin_rk", "fieldvalue", *_HEAD, *_TAIL,
    ],
    "pst_bptenderextensions": [
        "rtl_txn_rk", "rtl_txn_tender_rk", "tendersequencenumber", "fieldgroup", "fieldname",
        *_HEAD, *_TAIL, "is_aligned_tran",
    ],
    "pst_bptender": [
        "rtl_txn_rk", "rtl_txn_tender_rk", "tendersequencenumber", "tendercurrency",
        "tendercurrency_iso", "tenderid", "accountnumber", "refererenceid", *_HEAD, *_TAIL,
        "is_aligned_tran",
    ],
}

# Columns the staging rules add to the copied ones.
_RULE_COLUMNS = {
    "pst_bptransaction": {
        "begindatetimestamp": T.TimestampNTZType(), "enddatetimestamp": T.TimestampNTZType(),
    },
    "pst_bptransactextensio": {"fieldvalue": T.StringType()},
    "pst_bpfinancialmovemen": {
        "amount": T.DecimalType(32, 2), "refererenceid": T.StringType(),
    },
    "pst_bpfinancialmovementextensio": {
        "fieldgroup": T.StringType(), "fieldname": T.StringType(),
    },
    "pst_bptenderextensions": {"fieldvalue": T.StringType()},
    "pst_bptender": {"tendertypecode": T.StringType(), "tenderamount": T.DecimalType(38, 2)},
}


def staged_schema(segment: str) -> T.StructType:
    """Target schema of a segment's staged table; without an own list, that of the raw table."""
    table = STAGED_TABLES[segment]
    raw = raw_schema(segment)
    if table not in STAGED_COLUMNS:
        return raw
    rules = {"businessdaydate": T.DateType(), **_RULE_COLUMNS[table]}
    types = {f.name: f.dataType for f in raw} | rules
    names = [*STAGED_COLUMNS[table], *rules]
    return T.StructType([T.StructField(n, types[n]) for n in names])


def text_struct(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Dictionary tables.
MEAN = text_struct(["matnr", "meinh", "lfnum", "ean11"])
MARM = text_struct(["matnr", "meinh", "umrez"])
MARA = text_struct(["matnr", "meins"])
TVARVC = text_struct(["name", "type", "low"])
EXPORT = T.StructType(
    [T.StructField("reasoncode", T.IntegerType()), T.StructField("description", T.StringType())]
)
