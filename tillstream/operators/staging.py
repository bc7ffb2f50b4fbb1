"""Raw and staged rows of each segment.

All rules here are row-local expressions except the flag joins, which bring one
row per transaction or line back to the rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillstream.functions import casts, text
from tillstream.functions.keys import SURROGATE_KEYS, TXN, surrogate_key
from tillstream.operators.cancel import line_key
from tillstream.plans.schemas import LOAD_COLUMNS, RAW_TABLES, STAGED_COLUMNS, raw_schema

# Fixed values of the item rules.
AUTO_MARKDOWN_CODE = "2043"
BRIDGE_WORKSTATION = "0000001000"
BRIDGE_ITEM = "S003147"
NO_REVERSAL_TYPES = ("3169", "3170")


# --- routing and projection -------------------------------------------------


def route(df: DataFrame, segment: str) -> DataFrame:
    """Rows of one segment of the flattened stream."""
    return df.where(F.col("segment_name") == segment)


def unknown_segments(df: DataFrame) -> DataFrame:
    """Rows no route takes, for the quarantine."""
    known = F.col("segment_name").isin(*RAW_TABLES)
    return df.where(~F.coalesce(known, F.lit(False)))


def load_columns(load_ts: datetime | Column, load_ts_xml: datetime | Column) -> dict[str, Column]:
    """Load time of the row and of its document, as timestamp and date."""
    ts = load_ts if isinstance(load_ts, Column) else F.lit(load_ts)
    xml = load_ts_xml if isinstance(load_ts_xml, Column) else F.lit(load_ts_xml)
    return {
        "load_ts": ts.cast("timestamp_ntz"),
        "load_date": ts.cast("date"),
        "load_ts_xml": xml.cast("timestamp_ntz"),
        "load_date_xml": xml.cast("date"),
    }


def project_to(
    df: DataFrame,
    target: T.StructType,
    load_ts: datetime | Column,
    load_ts_xml: datetime | Column | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Fill a target table from text columns.

    Each target column is converted by its type from the column of the same name;
    surrogate keys and load columns are computed, unknown ones stay null, and source
    columns the target lacks are ignored.
    """
    load = load_columns(load_ts, load_ts if load_ts_xml is None else load_ts_xml)
    have = set(df.columns)
    out = [F.col(c) for c in keep or []]
    for field in target:
        if field.name in SURROGATE_KEYS:
            parts = [c if c in have else F.lit(None) for c in SURROGATE_KEYS[field.name]]
            value = surrogate_key(parts)
        elif field.name in LOAD_COLUMNS:
            value = load[field.name].cast(field.dataType)
        elif field.name not in have:
            value = F.lit(None).cast(field.dataType)
        elif df.schema[field.name].dataType == T.StringType():
            value = casts.cast_to(field.name, F.col(field.name), field.dataType)
        else:
            value = F.col(field.name).cast(field.dataType)
        out.append(value.alias(field.name))
    return df.select(*out)


def raw_rows(
    df: DataFrame,
    segment: str,
    load_ts: datetime | Column,
    load_ts_xml: datetime | Column | None = None,
) -> DataFrame:
    """Rows of a segment's raw table, with that segment's field rules applied."""
    return project_to(prepare(df, segment), raw_schema(segment), load_ts, load_ts_xml)


def prepare(df: DataFrame, segment: str) -> DataFrame:
    """Field rules that come before conversion, still as text."""
    rules = {
        "E1BPTRANSACTEXTENSIO": prepare_txn_extensions,
        "E1BPTENDEREXTENSIONS": cut_extension_fields,
        "E1BPLINEITEMEXTENSIO": cut_extension_fields,
        "E1BPTRANSACTIONDISCO": stage_txn_discounts,
    }
    return rules.get(segment, lambda x: x)(df)


def fault(df: DataFrame) -> Column:
    """Why a segment cannot be converted, null if it can."""
    error = F.lit(None).cast("string")
    if "discounttypecode" in df.columns and "discountreasoncode" in df.columns:
        code = F.col("discounttypecode")
        bad = code.isNotNull() & code.try_cast("int").isNull()
        error = F.when(bad, "discount code is no number").otherwise(error)
    for c in ("begindatetimestamp", "enddatetimestamp"):
        if c in df.columns:
            bad = F.coalesce(casts.timestamp_is_broken(F.col(c)), F.lit(False))
            error = F.when(bad, "impossible timestamp").otherwise(error)
    return error


def broken_rows(df: DataFrame) -> DataFrame:
    """Segments that cannot be converted, with the reason; the others are loaded."""
    return df.withColumn("error", fault(df)).where("error is not null")


def sound_rows(df: DataFrame) -> DataFrame:
    return df.where(fault(df).isNull())


def select_staged(raw: DataFrame, table: str) -> DataFrame:
    """Copy a staged table's fixed column list, where the raw rows have them."""
    have = set(raw.columns)
    return raw.select(*[c for c in STAGED_COLUMNS[table] if c in have])


# --- transactions -------------------------------------------------------------


def repaired_period(begin: Column, end: Column) -> tuple[Column, Column]:
    """Missing begin takes end; missing end, or an end before begin, takes begin."""
    broken_end = end.isNull() | F.coalesce(begin > end, F.lit(False))
    return F.coalesce(begin, end), F.when(broken_end, begin).otherwise(end)


def stage_transactions(df: DataFrame) -> DataFrame:
    """Typed begin and end, repaired; control transactions move to the day they ended."""
    begin, end = repaired_period(
        casts.lenient_timestamp(F.col("begindatetimestamp")),
        casts.lenient_timestamp(F.col("enddatetimestamp")),
    )
    out = df.withColumns(
        {
            "begindatetimestamp": begin,
            "enddatetimestamp": end,
            "businessdaydate": casts.raw_date(F.col("businessdaydate")),
        }
    )
    control = F.col("transactiontypecode").startswith("11")
    moved = control & F.col("enddatetimestamp").isNotNull() & F.col("businessdaydate").isNotNull()
    return out.withColumn(
        "businessdaydate",
        F.when(moved, F.col("enddatetimestamp").cast("date")).otherwise(
            F.col("businessdaydate")
        ),
    )


# --- name/value extensions -------------------------------------------------------


def prepare_txn_extensions(df: DataFrame) -> DataFrame:
    """Renamed and cut transaction extensions; rows without a type are dropped."""
    group, name, value = F.col("fieldgroup"), F.col("fieldname"), F.col("fieldvalue")
    return df.where(F.col("transactiontypecode").isNotNull()).withColumns(
        {
            "fieldgroup": text.truncated(group, text.GROUP_LIMIT),
            "fieldname": text.extension_name(name),
            "fieldvalue": text.extension_value(name, value),
            "is_head_bonid": text.head_bonid(group, name),
        }
    )


def stage_txn_extensions(df: DataFrame, mask: bool = True) -> DataFrame:
    """Staged form: as prepared, with personal-data values removed.

    The mask tests the name as it came in, before it is renamed or cut.
    """
    hidden = df.withColumn(
        "fieldvalue", text.masked(F.col("fieldname"), F.col("fieldvalue"), mask)
    )
    return prepare_txn_extensions(hidden)


def cut_extension_fields(df: DataFrame, name_limit: int = text.NAME_LIMIT) -> DataFrame:
    return df.withColumns(
        {
            "fieldgroup": text.truncated(F.col("fieldgroup"), text.GROUP_LIMIT),
            "fieldname": text.truncated(F.col("fieldname"), name_limit),
        }
    )


def stage_tender_extensions(df: DataFrame, part: str = "fraction") -> DataFrame:
    """Cut fields and reduce certificate prices to one part of the number."""
    cut = cut_extension_fields(df)
    return cut.withColumn(
        "fieldvalue", text.cert_price(F.col("fieldname"), F.col("fieldvalue"), part)
    )


def stage_movement_extensions(df: DataFrame) -> DataFrame:
    return cut_extension_fields(df)


def stage_txn_discounts(df: DataFrame) -> DataFrame:
    """Discount type codes are stored 100 higher."""
    code = F.col("discounttypecode")
    return df.withColumn("discounttypecode", (code.try_cast("int") + 100).cast("string"))


def copy_operator(discounts: DataFrame, txns: DataFrame, keys: list[str] = TXN) -> DataFrame:
    """Operator of the first header of the transaction, copied to its discounts."""
    first = txns.groupBy(*keys).agg(F.min_by("operatorid", "pos").alias("operatorid"))
    return discounts.drop("operatorid").join(first, keys, "left")


# --- line items ---------------------------------------------------------------


def auto_md_items(extensions: DataFrame) -> DataFrame:
    """Lines marked as automatic markdown."""
    hit = (
        (F.col("fieldgroup") == "POS")
        & (F.col("fieldname") == "AUTO_MD")
        & (F.col("fieldvalue") == "Y")
    )
    return extensions.where(hit).select(line_key().alias("line_key")).distinct()


def recode_item_types(
    items: DataFrame, markdown: Column, bridge: Column, bridge_item: Column
) -> DataFrame:
    """Type codes of markdown lines and of lines at the bridge workstation."""
    at_bridge = bridge & F.coalesce(F.col("workstationid") == BRIDGE_WORKSTATION, F.lit(False))
    special = (
        at_bridge & bridge_item & F.coalesce(F.col("itemid") == BRIDGE_ITEM, F.lit(False))
    )
    kind, code = F.col("transactiontypecode"), F.col("retailtypecode")
    return items.withColumn(
        "retailtypecode",
        F.when(special & (kind == "1016"), "2044")
        .when(special & (kind == "1017"), "2831")
        .when(markdown, AUTO_MARKDOWN_CODE)
        .when(at_bridge & (code == "2804"), "2826")
        .otherwise(code),
    )


def staged_item_id(items: DataFrame) -> DataFrame:
    """EAN and its unit if there is one; a voided receipt's missing id becomes 0."""
    ean = F.coalesce(F.col("has_ean"), F.lit(False))
    final = F.coalesce(F.when(ean, F.col("ean11")), F.col("itemid"))
    empty = (F.col("transactiontypecode") == "1014") & final.isNull()
    return items.withColumns(
        {
            "itemid": F.when(empty, "0").otherwise(final),
            "itemidqualifier": F.when(empty, "")
            .when(ean, "1")
            .otherwise(F.col("itemidqualifier")),
            "salesunitofmeasure": F.when(
                ean & F.col("meinh").isNotNull(), F.col("meinh")
            ).otherwise(F.col("salesunitofmeasure")),
        }
    )


def stage_items(
    items: DataFrame, extensions: DataFrame, markdown: Column, bridge: Column, bridge_item: Column
) -> DataFrame:
    """Staged lines: no 2020, no line whose mapping has no EAN, codes and ids rewritten.

    ``markdown``, ``bridge`` and ``bridge_item`` are the rule switches.
    """
    kept = items.where(F.coalesce(F.col("retailtypecode") != "2020", F.lit(True))).where(
        F.coalesce(F.col("has_ean"), F.lit(True))
    )
    auto = auto_md_items(extensions).withColumn("_auto", F.lit(True))
    flagged = kept.withColumn("line_key", line_key()).join(auto, "line_key", "left")
    coded = recode_item_types(
        flagged, markdown & F.coalesce(F.col("_auto"), F.lit(False)), bridge, bridge_item
    )
    return staged_item_id(coded).drop("line_key", "_auto")


# --- tenders and movements -------------------------------------------------------


def apply_cert_party(tenders: DataFrame, extensions: DataFrame, scope: str = "txn") -> DataFrame:
    """3108 becomes 3123 where a CERT_PARTY extension names RU02.

    ``scope`` is the transaction, the whole document, or (``tender``) the tender's
    own extensions.  With ``tender`` the first extension named exactly CERT_PARTY must
    start with RU02 in any case, and only the first 3108 of a transaction changes.
    """
    keys = {
        "txn": TXN,
        "document": ["doc_id"],
        "tender": [*TXN, "tendersequencenumber"],
    }[scope]
    party, name = F.col("fieldvalue"), F.col("fieldname")
    if scope == "tender":
        first_party = F.min_by(F.struct(party), "pos")["fieldvalue"].alias("fieldvalue")
        found = extensions.where(name == "CERT_PARTY").groupBy(*keys).agg(first_party)
        found = found.where(F.upper(party).startswith("RU02"))
    else:
        found = extensions.where(name.contains("CERT_PARTY") & party.contains("RU02"))
    hits = found.select(*keys).distinct().withColumn("_party", F.lit(True))
    code = F.col("tendertypecode")
    first = F.lit(True)
    if scope == "tender":
        firsts = tenders.where(code == "3108").groupBy(*TXN).agg(F.min("pos").alias("_first"))
        tenders = tenders.join(firsts, TXN, "left")
        first = F.col("pos") == F.col("_first")
    return (
        tenders.join(hits, keys, "left")
        .withColumn(
            "tendertypecode",
            F.when(F.col("_party") & (code == "3108") & first, "3123").otherwise(code),
        )
        .drop("_party", "_first")
    )


def stage_tenders(df: DataFrame, extensions: DataFrame, scope: str = "txn") -> DataFrame:
    coded = apply_cert_party(df, extensions, scope)
    return coded.withColumn("tenderamount", casts.widen_amount(F.col("tenderamount")))


def last_notes(extensions: DataFrame, keys: list[str] = TXN) -> DataFrame:
    """The last DOCNUMBER value of each transaction; the incoming name is tested."""
    return (
        extensions.where(F.col("fieldname").contains("DOCNUMBER"))
        .groupBy(*keys)
        .agg(F.max_by(F.struct("fieldvalue"), "pos")["fieldvalue"].alias("note"))
    )


def is_reversal(note: Column, type_code: Column) -> Column:
    return text.reversed_note(note) & type_code.isNotNull() & ~type_code.isin(*NO_REVERSAL_TYPES)


def stage_movements(movements: DataFrame, notes: DataFrame, keys: list[str] = TXN) -> DataFrame:
    """Exact amounts; a reversal flips the sign and refers to the original document."""
    reversal = F.coalesce(is_reversal(F.col("note"), F.col("financialtypecode")), F.lit(False))
    amount = casts.exact_amount(F.col("amount"))
    return (
        movements.join(notes, keys, "left")
        .withColumns(
            {
                "amount": F.when(reversal, -amount).otherwise(amount).cast("decimal(32,2)"),
                "refererenceid": F.when(reversal, text.reversal_reference(F.col("note"))),
            }
        )
        .drop("note")
    )
