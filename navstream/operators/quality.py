"""Data contract for navigation edges: flag, reason, clean/quarantine split, summary.

The contract is column-only (no UDFs, no actions). Flags are total, so
``count(clean) + count(quarantine) == count(raw)`` always holds.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navstream.functions import contract
from navstream.settings import MONTH_PATTERN, REASON_CODES

FLAG_COLUMNS = {code: f"_viol_{code}" for code in REASON_CODES}
ANY_VIOLATION = "_any_violation"
REASON = "_reason"
#: The month as delivered, next to the partition key.
RAW_MONTH = "raw_month"


class ContractSplit(NamedTuple):
    flagged: DataFrame
    clean: DataFrame
    quarantine: DataFrame


def month_key(col: str = "month") -> F.Column:
    """The month if it looks like one, else ''. Partition folders and month sets are bounded by this."""
    return F.when(F.col(col).rlike(MONTH_PATTERN), F.col(col)).otherwise(F.lit(""))


def with_contract_flags(df: DataFrame) -> DataFrame:
    """Adds one flag per rule, ``_any_violation`` and the pipe-joined ``_reason``."""
    rules = contract.rule_columns()
    flags = {code: F.col(FLAG_COLUMNS[code]) for code in rules}
    return df.withColumns({FLAG_COLUMNS[code]: rule for code, rule in rules.items()}).withColumns(
        {ANY_VIOLATION: contract.any_violation(flags), REASON: contract.reason(flags)}
    )


def split_by_contract(df: DataFrame) -> ContractSplit:
    """Clean rows (original columns) and quarantine rows (original columns + ``_reason``)."""
    columns = df.columns
    flagged = with_contract_flags(df)
    clean = flagged.filter(~F.col(ANY_VIOLATION)).select(*columns)
    quarantine = flagged.filter(F.col(ANY_VIOLATION)).select(*columns, REASON)
    return ContractSplit(flagged, clean, quarantine)


def clean_rows(df: DataFrame) -> DataFrame:
    return split_by_contract(df).clean


def quarantine_rows(df: DataFrame) -> DataFrame:
    return split_by_contract(df).quarantine


def reason_counts(quarantine: DataFrame) -> DataFrame:
    """Quarantined rows per (month, reason)."""
    return quarantine.groupBy("month", REASON).agg(F.count(F.lit(1)).alias("count"))


def quarantine_summary(quarantine: DataFrame, month: str | None = None) -> DataFrame:
    """Reason breakdown of every month (month ascending, count descending, reason ascending)."""
    if month:
        quarantine = quarantine.filter(F.col("month") == month)
    return reason_counts(quarantine).orderBy(F.asc_nulls_first("month"), F.desc("count"), F.asc(REASON))
