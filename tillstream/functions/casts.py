"""Lenient text conversions, as column expressions.

Point-of-sale documents arrive as text.  The target column type decides the
conversion; bad input never fails a job.  Everything here is a built-in
expression, so projections stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

EPOCH_DAY = "1970-01-01"

# Decimal scale by target column name; every other decimal has 2.
THREE_DIGIT_COLUMNS = ("retailquantity", "units")


def is_blank(c: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return c.isNull() | (F.trim(c) == "")


def blank_to_null(c: Column) -> Column:
    return F.when(~is_blank(c), c)


def _part(c: Column, first: int, size: int, default: int) -> Column:
    """Integer at a fixed position; short or non-numeric text takes the default."""
    text = F.substring(c, first, size)
    usable = (F.length(c) >= first + size - 1) & text.rlike("^[+-]?[0-9]+$")
    return F.coalesce(F.when(usable, text.try_cast("int")), F.lit(default))


def _date_parts(c: Column) -> list[Column]:
    return [_part(c, 1, 4, 1970), _part(c, 5, 2, 1), _part(c, 7, 2, 1)]


def _time_parts(c: Column) -> list[Column]:
    return [_part(c, 9, 2, 0), _part(c, 11, 2, 0), _part(c, 13, 2, 0)]


def staged_date(c: Column) -> Column:
    """yyyyMMdd to date; missing parts default to 1970/1/1, impossible dates are null."""
    y, m, d = _date_parts(c)
    zero = F.lit(0)
    parsed = F.try_make_timestamp_ntz(y, m, d, zero, zero, zero).cast("date")
    return F.when(F.length(c) > 0, parsed)


def raw_date(c: Column) -> Column:
    """Like :func:`staged_date`, but blank is null and impossible is 1970-01-01."""
    return F.when(
        ~is_blank(c), F.coalesce(staged_date(c), F.lit(EPOCH_DAY).cast("date"))
    )


def lenient_timestamp(c: Column) -> Column:
    """yyyyMMddHHmmss by position; an impossible part gives null."""
    return F.when(
        ~is_blank(c), F.try_make_timestamp_ntz(*_date_parts(c), *_time_parts(c))
    )


def timestamp_is_broken(c: Column) -> Column:
    """Text present but not a possible timestamp: the segment is quarantined."""
    return ~is_blank(c) & lenient_timestamp(c).isNull()


def datetime_text(c: Column) -> Column:
    """Date-like text rewritten to ``yyyy-MM-dd HH:mm:ss`` without validation."""
    parts = _date_parts(c) + _time_parts(c)
    return F.when(~is_blank(c), F.format_string("%04d-%02d-%02d %02d:%02d:%02d", *parts))


def lenient_decimal(c: Column, precision: int = 32, scale: int = 2) -> Column:
    """Text straight to decimal (no detour through double); unparsable is null."""
    return blank_to_null(c).try_cast(f"decimal({precision},{scale})")


def exact_amount(c: Column) -> Column:
    """Movement amounts: exact decimal(32,2)."""
    return lenient_decimal(c, 32, 2)


def widen_amount(c: Column) -> Column:
    """Raw decimal(32,2) to staged decimal(38,2)."""
    return c.cast("decimal(38,2)")


def lenient_int(c: Column) -> Column:
    """Whole numbers only: no blanks around, no fraction."""
    return F.when(c.rlike("^[+-]?[0-9]+$"), c.try_cast("int"))


def lenient_bool(c: Column) -> Column:
    """``null`` text is null; otherwise only ``true`` (any case) is true."""
    return F.when(~is_blank(c) & (F.lower(c) != "null"), F.lower(c) == "true")


def cast_to(name: str, c: Column, target: T.DataType) -> Column:
    """Convert one text column to the type its target table asks for."""
    if isinstance(target, T.DateType):
        return raw_date(c)
    if isinstance(target, T.DecimalType):
        scale = 3 if name in THREE_DIGIT_COLUMNS else 2
        return lenient_decimal(c, 32, scale).cast(target)
    if isinstance(target, T.IntegerType):
        return lenient_int(c)
    if isinstance(target, (T.TimestampType, T.TimestampNTZType)):
        return lenient_timestamp(c).cast(target)
    if isinstance(target, T.BooleanType):
        return lenient_bool(c)
    if "date" in name or "timestamp" in name:
        return datetime_text(c)
    return blank_to_null(c)
