from datetime import date, datetime

import pytest
import xxhash
from pyspark.sql import functions as F

from tillstream.functions import casts, keys, text


def column(spark, expr, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("c"))).collect()]


def test_null_blank_short_and_impossible_dates_differ(spark):
    texts = [None, "", "  ", "2024", "20241345", "20240229", "2024ab05"]
    epoch = date(1970, 1, 1)
    raw = [None, None, None, date(2024, 1, 1), epoch, date(2024, 2, 29), date(2024, 1, 5)]
    assert column(spark, casts.raw_date, *texts) == raw
    staged = [None, None, epoch, date(2024, 1, 1), None, date(2024, 2, 29), date(2024, 1, 5)]
    assert column(spark, casts.staged_date, *texts) == staged


def test_timestamps_default_missing_parts_and_reject_impossible_ones(spark):
    texts = ["20240102030405", "20240102", "20240102250000", None]
    want = [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2), None, None]
    assert column(spark, casts.lenient_timestamp, *texts) == want
    broken = column(spark, lambda c: F.coalesce(casts.timestamp_is_broken(c), F.lit(False)), *texts)
    assert broken == [False, False, True, False]
    assert column(spark, casts.datetime_text, "20249999") == ["2024-99-99 00:00:00"]


def test_numbers_and_booleans(spark):
    assert [str(v) for v in column(spark, casts.lenient_decimal, "1.005", "x", "")] == [
        "1.01", "None", "None",
    ]
    # Straight from text: no digits are lost beyond the fifteenth.
    assert str(column(spark, casts.lenient_decimal, "12345678901234567890.12")[0]) == (
        "12345678901234567890.12"
    )
    assert column(spark, casts.lenient_int, "7", " 7", "1.5", "99999999999") == [7, None, None, None]
    assert column(spark, casts.lenient_bool, "TRUE", "null", "x", None) == [True, None, False, None]


@pytest.mark.parametrize("parts", [("1", "2", "3", "4"), ("1", None, "", "x" * 50)])
def test_surrogate_keys_are_seed_zero_big_endian(spark, parts):
    df = spark.createDataFrame([parts], "a string, b string, c string, d string")
    got = bytes(df.select(keys.surrogate_key(["a", "b", "c", "d"])).first()[0])
    joined = "|".join(p or "" for p in parts)
    assert got == xxhash.xxh64(joined.encode(), seed=0).intdigest().to_bytes(8, "big")


def test_known_hash_of_the_empty_text(spark):
    got = spark.range(1).select(keys.surrogate_key([F.lit("")])).first()[0]
    assert bytes(got).hex() == "ef46db3751d8e999"


def test_null_skipping_keys_differ(spark):
    df = spark.createDataFrame([("1", None, "3")], "a string, b string, c string")
    row = df.select(keys.joined(["a", "b", "c"]), keys.joined(["a", "b", "c"], "skip")).first()
    assert tuple(row) == ("1||3", "1|3")


def test_extension_rules(spark):
    name = lambda c: text.extension_name(c)
    assert column(spark, name, "XDOCNUMBER", "ReceiptNumber", "VERYLONGNAMEX", None) == [
        "NOTE", "DOCNUMBER", "VERYLONGNA", None,
    ]
    value = lambda c: text.extension_value(F.lit("ReceiptNum"), c)
    assert column(spark, value, "123456789012") == ["1234567890"]
    other = lambda c: text.extension_value(F.lit("X"), c)
    assert column(spark, other, "9" * 41) == ["9" * 40]
    bon = lambda c: text.head_bonid(c, F.lit("BONID"))
    assert column(spark, bon, "HEADER", "POS", None) == ["1", "0", "0"]


def test_certificate_price(spark):
    texts = ["12.50", "12.", "12", ".5", "1.2.3", "12.0"]
    fraction = lambda c: text.cert_price(F.lit("CERT_PRICE"), c)
    assert column(spark, fraction, *texts) == ["50", "12.", "12", "5", "2", "0"]
    whole = lambda c: text.cert_price(F.lit("CERT_PRICE"), c, "whole")
    assert column(spark, whole, *texts) == ["12.50", "12.", "12", ".5", "1.2.3", "12"]


def test_material_padding_never_truncates(spark):
    assert column(spark, text.padded_material, "12", "1" * 20) == ["0" * 16 + "12", "1" * 20]


def test_reversal(spark):
    assert column(spark, text.reversed_note, "D2345", "D1", "D", None) == [True, False, False, False]
    assert column(spark, text.reversal_reference, "D2345") == ["D1345"]
