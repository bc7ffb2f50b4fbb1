"""Field rules for name/value extension rows and material numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillstream.functions.casts import is_blank

# Text limits of the receiving tables.
GROUP_LIMIT = 5
NAME_LIMIT = 10
DISCOUNT_EXT_NAME_LIMIT = 15
VALUE_LIMIT = 40
RECEIPT_LIMIT = 10
MATERIAL_WIDTH = 18


def truncated(c: Column, size: int) -> Column:
    return F.substring(c, 1, size)


def extension_name(name: Column) -> Column:
    """DOCNUMBER is stored as NOTE, ReceiptNum as DOCNUMBER, the rest cut to size."""
    return (
        F.when(name.contains("DOCNUMBER"), "NOTE")
        .when(name.contains("ReceiptNum"), "DOCNUMBER")
        .otherwise(truncated(name, NAME_LIMIT))
    )


def extension_value(name: Column, value: Column) -> Column:
    return F.when(name.contains("ReceiptNum"), truncated(value, RECEIPT_LIMIT)).otherwise(
        truncated(value, VALUE_LIMIT)
    )


def head_bonid(group: Column, name: Column) -> Column:
    """``1`` for a header-level bonus id, else ``0``."""
    hit = ~is_blank(group) & ~is_blank(name) & group.contains("HEAD") & name.contains("BONID")
    return F.when(hit, "1").otherwise("0")


def masked(name: Column, value: Column, mask: bool = True) -> Column:
    """Drop the value of personal-data fields."""
    if not mask:
        return value
    personal = name.contains("MobileNum") | name.contains("MailClient")
    return F.when(~F.coalesce(personal, F.lit(False)), value)


def cert_price(name: Column, value: Column, part: str = "fraction") -> Column:
    """Certificate price: digits after the dot, or (``part='whole'``) before ``.0``."""
    price = name.contains("CERT_PRICE")
    pieces = F.split(value, r"\.")
    if part == "fraction":
        # Trailing empty pieces do not count: "12." stays as it is.
        has_more = F.length(F.regexp_replace(value, r"\.+$", "")) > F.length(
            F.element_at(pieces, 1)
        )
        return F.when(price & value.contains(".") & has_more, F.get(pieces, F.lit(1))).otherwise(
            value
        )
    if part == "whole":
        return F.when(price & value.like("%.0"), F.element_at(pieces, 1)).otherwise(value)
    raise ValueError(f"unknown part: {part}")


def padded_material(c: Column) -> Column:
    """Blank-free left zero padding that never truncates."""
    text = F.replace(c, F.lit(" "), F.lit("0"))
    return F.when(F.length(c) < MATERIAL_WIDTH, F.lpad(text, MATERIAL_WIDTH, "0")).otherwise(text)


def reversed_note(note: Column) -> Column:
    """A note whose second character is 2 marks a reversal."""
    return F.coalesce(F.substring(note, 2, 1) == "2", F.lit(False))


def reversal_reference(note: Column) -> Column:
    """The note with its second character set to 1."""
    return F.overlay(note, F.lit("1"), 2, 1)
