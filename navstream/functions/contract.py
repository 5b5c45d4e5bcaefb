"""Data-contract rules for navigation edges as total boolean Column expressions.

Each rule is wrapped in ``coalesce(rule, true)``: under SQL three-valued logic a NULL ``type`` or
NULL ``n`` would make the rule NULL, and a row whose flags are NULL lands in neither the clean nor
the quarantine side of a split. Treating "unknown" as a violation keeps ``clean + bad == raw``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from navstream.settings import MONTH_PATTERN, REASON_CODES, REASON_SEPARATOR, VALID_LINK_TYPES


def _total(rule: Column) -> Column:
    return F.coalesce(rule, F.lit(True))


def _blank(col: str) -> Column:
    return F.col(col).isNull() | (F.trim(F.col(col)) == "")


def null_prev() -> Column:
    """Referrer missing or blank."""
    return _total(_blank("prev"))


def null_curr() -> Column:
    """Target missing or blank."""
    return _total(_blank("curr"))


def bad_type(valid_types: tuple[str, ...] = VALID_LINK_TYPES) -> Column:
    """Link type missing or outside the allowed set."""
    return _total(~F.col("type").isin(*valid_types))


def neg_n() -> Column:
    """Click count missing, unparsable or not positive."""
    return _total(F.col("n") <= 0)


def bad_month(pattern: str = MONTH_PATTERN) -> Column:
    """Month key missing or not shaped ``YYYY-MM``."""
    return _total(F.col("month").isNull() | ~F.col("month").rlike(pattern))


def rule_columns() -> dict[str, Column]:
    """Rule code -> violation flag, in reason order."""
    rules = {
        "null_prev": null_prev(),
        "null_curr": null_curr(),
        "bad_type": bad_type(),
        "neg_n": neg_n(),
        "bad_month": bad_month(),
    }
    return {code: rules[code] for code in REASON_CODES}


def any_violation(flags: dict[str, Column] | None = None) -> Column:
    flags = flags or rule_columns()
    out = None
    for flag in flags.values():
        out = flag if out is None else (out | flag)
    return out


def reason(flags: dict[str, Column] | None = None) -> Column:
    """Pipe-joined codes of the violated rules in fixed order; '' for a clean row."""
    flags = flags or rule_columns()
    return F.concat_ws(
        REASON_SEPARATOR, *[F.when(flag, F.lit(code)) for code, flag in flags.items()]
    )
