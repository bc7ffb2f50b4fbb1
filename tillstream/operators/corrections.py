"""Document-level corrections: item codes, sums, rounding lines, balance flag.

Every sum is a ``groupBy`` on the transaction (partial aggregation before the
shuffle, so a hot key sends one row per task), then a join of one row per
transaction back to the rows.  Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.functions.keys import BASE, TXN5

# Fixed values of the rounding line.
ROUNDING_LINE = {
    "retailtypecode": "2805",
    "itemidqualifier": "2",
    "itemid": "S000004",
    "salesunitofmeasure": "ST",
}
ROUNDING_ADD_TYPES = ("1002", "1003")
ROUNDING_DROP_TYPES = ("1001",)
AMOUNT = "decimal(38,2)"


def is_receipt(type_code: Column) -> Column:
    return F.coalesce(type_code.startswith("10"), F.lit(False))


def recode_items(items: DataFrame) -> DataFrame:
    """2901 that is not negative becomes 2001; 2010 loses its item qualifier."""
    code = F.col("retailtypecode")
    negative = F.coalesce(F.col("retailquantity") < 0, F.lit(False))
    return items.withColumns(
        {
            "retailtypecode": F.when((code == "2901") & ~negative, "2001").otherwise(code),
            "itemidqualifier": F.when(
                ~F.coalesce(code == "2010", F.lit(False)), F.col("itemidqualifier")
            ),
        }
    )


def _sum_per_txn(df: DataFrame, amount: str, out: str, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(amount).cast(AMOUNT).alias(out))


def txn_sums(
    items: DataFrame,
    tenders: DataFrame,
    types: tuple[str, ...] = ROUNDING_ADD_TYPES + ROUNDING_DROP_TYPES,
    keys: list[str] = TXN5,
) -> DataFrame:
    """Tender sum, sales sum and count of priced items per transaction of some types.

    Transactions with only one of the two sums keep a null in the other.
    """
    in_types = F.col("transactiontypecode").isin(*types)
    both = items.where(in_types & F.col("salesamount").isNotNull()).select(
        *keys,
        "transactiontypecode",
        F.col("salesamount").cast(AMOUNT).alias("sale"),
        F.lit(None).cast(AMOUNT).alias("paid"),
    ).unionByName(
        tenders.where(in_types & F.col("tenderamount").isNotNull()).select(
            *keys,
            "transactiontypecode",
            F.lit(None).cast(AMOUNT).alias("sale"),
            F.col("tenderamount").cast(AMOUNT).alias("paid"),
        )
    )
    # One exchange for both sums: rows of the two sides are aggregated together.
    return both.groupBy(*keys, "transactiontypecode").agg(
        F.sum("paid").cast(AMOUNT).alias("tender_sum"),
        F.sum("sale").cast(AMOUNT).alias("sales_sum"),
        F.count("sale").alias("item_count"),
    )


def _small_gap(sums: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """Transactions whose tender and sales sums differ by less than one unit."""
    gap = (F.col("tender_sum") - F.col("sales_sum")).cast(AMOUNT)
    return (
        sums.where(F.col("transactiontypecode").isin(*types))
        .withColumn("gap", gap)
        .where((F.col("gap") != 0) & (F.abs(F.col("gap")) < 1))
    )


def rounding_items(items: DataFrame, sums: DataFrame, keys: list[str] = TXN5) -> DataFrame:
    """The rounding lines to add, one per transaction with a small gap."""
    header = [c for c in BASE if c not in keys and c != "transactiontypecode"]
    # Headers are equal within a transaction, so any row's will do.
    in_types = items.where(F.col("transactiontypecode").isin(*ROUNDING_ADD_TYPES))
    heads = in_types.groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in header], F.max("pos").alias("last_pos")
    )
    line = {k: F.lit(v) for k, v in ROUNDING_LINE.items()}
    return (
        _small_gap(sums, ROUNDING_ADD_TYPES)
        .join(heads, keys)
        .withColumns(line)
        .withColumns(
            {
                "retailquantity": F.lit("1.000").cast("decimal(32,3)"),
                "retailsequencenumber": (F.col("item_count") + 1).cast("string"),
                "salesamount": F.col("gap").cast("decimal(32,2)"),
                "pos": F.col("last_pos") + 1,
            }
        )
        .drop("gap", "tender_sum", "sales_sum", "item_count", "last_pos")
    )


def add_rounding_items(items: DataFrame, sums: DataFrame, keys: list[str] = TXN5) -> DataFrame:
    return items.unionByName(rounding_items(items, sums, keys), allowMissingColumns=True)


def drop_rounding_items(
    items: DataFrame, sums: DataFrame, keys: list[str] = TXN5, which: str = "all"
) -> DataFrame:
    """Remove the surplus 2006 lines whose amount is the negated gap of a return.

    ``which='first'`` looks at the first 2006 line only.
    """
    gaps = _small_gap(sums, ROUNDING_DROP_TYPES).select(
        *keys, (-F.col("gap")).cast(AMOUNT).alias("surplus")
    )
    candidate = F.col("retailtypecode") == "2006"
    if which == "all":
        hit = candidate & (F.col("salesamount") == F.col("surplus"))
    elif which == "first":
        firsts = items.where(candidate).groupBy(*keys).agg(F.min("pos").alias("first_pos"))
        gaps = gaps.join(firsts, keys)
        hit = (
            candidate
            & (F.col("pos") == F.col("first_pos"))
            & (F.col("salesamount") == F.col("surplus"))
        )
    else:
        raise ValueError(f"unknown choice: {which}")
    joined = items.join(gaps, keys, "left")
    return joined.where(~F.coalesce(hit, F.lit(False))).select(*items.columns)


def align_flag(
    segments: DataFrame,
    items: DataFrame,
    tenders: DataFrame,
    mode: str = "newest",
    keys: list[str] = TXN5,
) -> DataFrame:
    """Add ``is_aligned_tran``: the tender sum of a receipt equals its sales sum.

    ``newest`` counts a missing sum as zero; ``strict`` leaves the flag null unless
    both sums exist.  Types other than receipts have no flag.
    """
    if mode not in ("newest", "strict"):
        raise ValueError(f"unknown mode: {mode}")
    receipt = is_receipt(F.col("transactiontypecode"))
    amounts = items.where(receipt).select(
        *keys, F.col("salesamount").cast(AMOUNT).alias("sale"), F.lit(None).cast(AMOUNT).alias("paid")
    ).unionByName(
        tenders.where(receipt).select(
            *keys,
            F.lit(None).cast(AMOUNT).alias("sale"),
            F.col("tenderamount").cast(AMOUNT).alias("paid"),
        )
    )
    sums = amounts.groupBy(*keys).agg(F.sum("sale").alias("sale"), F.sum("paid").alias("paid"))
    sale, paid = F.col("sale"), F.col("paid")
    if mode == "newest":
        zero = F.lit(0).cast(AMOUNT)
        sale, paid = F.coalesce(sale, zero), F.coalesce(paid, zero)
    return (
        segments.drop("is_aligned_tran")
        .join(sums, keys, "left")
        .withColumn("is_aligned_tran", F.when(receipt, paid == sale))
        .drop("sale", "paid")
    )


def flagged_txns(extensions: DataFrame, source: str, keys: list[str] = TXN5) -> DataFrame:
    """Transactions sold through the given channel (extension SOURCE equals it)."""
    return (
        extensions.where((F.col("fieldname") == "SOURCE") & (F.col("fieldvalue") == source))
        .select(*keys)
        .distinct()
    )


def override_workstation(
    segments: DataFrame,
    extensions: DataFrame,
    source: str,
    workstation: str = "0000001002",
    keys: list[str] = TXN5,
) -> DataFrame:
    """Give every segment of an online-store transaction another workstation.

    The transaction key changes with it, so rebuild keys afterwards.
    """
    marked = flagged_txns(extensions, source, keys).withColumn("online", F.lit(True))
    return (
        segments.join(marked, keys, "left")
        .withColumn(
            "workstationid",
            F.when(F.col("online"), F.lit(workstation)).otherwise(F.col("workstationid")),
        )
        .drop("online")
    )
