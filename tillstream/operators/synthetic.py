"""Rows the source documents lack: balancing tenders and STORNO extensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tillstream.functions import text
from tillstream.functions.keys import BASE, TXN
from tillstream.operators.staging import is_reversal

# Fixed values of the balancing tender.
CASH = "3101"
VOIDED = "1014"
NUMBER_WITH_TENDERS = "9"
NUMBER_WITHOUT_TENDERS = "8"
ONLINE_WORKSTATION = "0000001002"
AMOUNT = "decimal(38,2)"


def union_all(*dfs: DataFrame) -> DataFrame:
    """Append rows by column name; columns one side lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def synthetic_tenders(
    txns: DataFrame,
    items: DataFrame,
    tenders: DataFrame,
    extensions: DataFrame,
    source: str,
    threshold: str = "1",
    mode: str = "newest",
    keys: list[str] = TXN,
) -> DataFrame:
    """Cash tenders that balance voided receipts, unique by key and amount.

    ``newest``: sums leave out 2020 lines; with tenders the difference is paid when
    it reaches ``threshold``; without tenders but with lines the sales sum is paid,
    even if zero.  ``older``: all lines count, a zero sales sum pays nothing and the
    tender is numbered like the transaction.
    """
    if mode not in ("newest", "older"):
        raise ValueError(f"unknown mode: {mode}")
    newest = mode == "newest"
    voided = txns.where(F.col("transactiontypecode") == VOIDED)
    lines = items
    if newest:
        lines = lines.where(F.coalesce(F.col("retailtypecode") != "2020", F.lit(True)))
    web = F.col("fieldname").contains("SOURCE") & F.col("fieldvalue").contains(source)
    # One exchange for the three inputs: each contributes its own columns.
    facts = union_all(
        lines.select(
            *keys, F.col("salesamount").cast(AMOUNT).alias("sale"), F.lit(1).alias("line")
        ),
        tenders.select(
            *keys, F.col("tenderamount").cast(AMOUNT).alias("paid"), F.lit(1).alias("tender")
        ),
        extensions.where(web).select(*keys, F.lit(1).alias("web")),
    )
    sums = facts.groupBy(*keys).agg(
        F.coalesce(F.sum("sale").cast(AMOUNT), F.lit(0).cast(AMOUNT)).alias("sale"),
        F.coalesce(F.sum("paid").cast(AMOUNT), F.lit(0).cast(AMOUNT)).alias("paid"),
        F.max("line").isNotNull().alias("has_lines"),
        F.max("tender").isNotNull().alias("has_tenders"),
        F.max("web").isNotNull().alias("web"),
    )
    gap = (F.col("sale") - F.col("paid")).cast(AMOUNT)
    pays_rest = F.col("has_tenders") & (F.abs(gap) >= F.lit(threshold).cast(AMOUNT))
    if newest:
        pays_all = ~F.col("has_tenders") & F.col("has_lines")
    else:
        pays_all = ~F.col("has_tenders") & (F.col("sale") != 0)
    number = (
        F.when(F.col("has_tenders"), NUMBER_WITH_TENDERS).otherwise(NUMBER_WITHOUT_TENDERS)
        if newest
        else F.col("transactionsequencenumber")
    )
    flag = [c for c in ("is_aligned_tran",) if c in txns.columns]
    return (
        voided.join(sums, keys)
        .where(pays_rest | pays_all)
        .select(
            *keys,
            *[c for c in BASE if c != "workstationid" and c not in keys],
            F.when(F.col("web"), ONLINE_WORKSTATION)
            .otherwise(F.col("workstationid"))
            .alias("workstationid"),
            number.alias("tendersequencenumber"),
            F.lit(CASH).alias("tendertypecode"),
            F.when(F.col("has_tenders"), gap).otherwise(F.col("sale")).alias("tenderamount"),
            *flag,
        )
        .dropDuplicates([*keys, "workstationid", "tenderamount"])
    )


def storno_extensions(
    movements: DataFrame, notes: DataFrame, keys: list[str] = TXN
) -> DataFrame:
    """One STORNO extension per reversed movement, holding the original's number."""
    return (
        movements.where("transactiontypecode is not null")
        .join(notes, keys)
        .where(is_reversal(F.col("note"), F.col("financialtypecode")))
        .select(
            *keys,
            *[c for c in BASE if c not in keys],
            F.lit(None).cast("string").alias("fieldgroup"),
            F.lit("STORNO").alias("fieldname"),
            text.reversal_reference(F.col("note")).alias("fieldvalue"),
        )
    )
