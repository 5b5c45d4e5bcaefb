"""Fill-in-middle transformation with counted quantifiers.

A text of ``n`` code points (``regexp_count`` of blocks of units, then of the units left) splits behind ``a`` and ``b`` of them.
Every row carries its own pattern, the start anchor, possessive groups ``unit{a}`` and ``unit{b - a}`` and a possessive
rest, so one match captures prefix, middle and suffix, and the row's own replacement puts them in the order of its form.
Possessive groups never give back what they took: the match is one pass over the text, in constant stack.

The cut points and the form are drawn from a digest of the seed and the decimal id, so reruns and other
partitionings agree. Texts that hold a sentinel stay plain; in all others the first occurrence of each sentinel
is the one put there (no sentinel overlaps itself), so :func:`restored` gives the exact text back.

Everything is DataFrame expressions: no shuffle, one row in, one row out.

Defined cases: a NULL text is empty, and an empty text is plain; a NULL id draws as the empty string; rows with
equal ids draw alike; further columns are ignored unless kept; an empty input gives an empty result. Texts are cut whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One unit: a code point, line breaks included.
UNIT = "(?s)."
#: Units counted at a time: Spark lists the matches it counts, so a long text is counted in few, long matches.
BLOCK = 4096
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class MiddlePolicy:
    """Seed of the draws, percent of texts that are transformed, and percent of those in suffix-first order."""

    seed: str = "1"
    transformed: int = 90
    suffix_first: int = 20


def _draw(id_col: str, seed: str, k: int) -> Column:
    """The k-th 32-bit number of the id's digest."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def unit_count(text: str) -> Column:
    blocks = F.regexp_count(text, F.lit(f"{UNIT}{{{BLOCK}}}+"))
    return (blocks * BLOCK + F.regexp_count(F.substring(F.col(text), blocks * BLOCK + 1, F.lit(BLOCK)), F.lit(UNIT))).cast("long")


def _pattern(a: Column, b: Column) -> Column:
    """Prefix, middle and rest as possessive groups of counted units."""
    return F.concat(F.lit(r"(?s)\A(.{"), a.cast("string"), F.lit("}+)(.{"), (b - a).cast("string"), F.lit(r"}+)(.*+)\z"))


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", policy: MiddlePolicy = MiddlePolicy(), keep: list[str] | None = None
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output, rest): one row per input row; ``rest`` is a struct of the
    ``keep`` columns, prefix_chars and middle_chars are NULL where the form is plain."""
    rest = F.struct(*[F.col(c) for c in keep]) if keep else F.lit(0)
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), rest.alias("rest"))
    h1, h2, h3, h4 = (_draw("id", policy.seed, k) for k in range(4))
    units = F.col("n") + 1
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    form = (
        F.when((F.col("n") == 0) | marked | (h3 % 100 >= policy.transformed), PLAIN)
        .when(h4 % 100 < policy.suffix_first, SPM)
        .otherwise(PSM)
    )
    drawn = source.withColumn("n", unit_count("text")).withColumns(
        {"a": F.least(h1 % units, h2 % units), "b": F.greatest(h1 % units, h2 % units), "form": form}
    )
    order = F.when(F.col("form") == SPM, f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    output = F.when(F.col("form") == PLAIN, F.col("text")).otherwise(
        F.regexp_replace(F.col("text"), _pattern(F.col("a"), F.col("b")), order)
    )
    cut = F.col("form") != PLAIN
    return drawn.select(
        "id", "n", "form",
        F.when(cut, F.col("a")).alias("prefix_chars"), F.when(cut, F.col("b") - F.col("a")).alias("middle_chars"),
        output.alias("output"), "rest",
    )


def restored(output: str = "output", form: str = "form") -> Column:
    """The original text from the output and its form alone: each part ends at its first sentinel."""
    psm = rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*+)\z"
    spm = rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*+)\z"
    return (
        F.when(F.col(form) == PSM, F.regexp_replace(output, psm, "$1$3$2"))
        .when(F.col(form) == SPM, F.regexp_replace(output, spm, "$2$3$1"))
        .otherwise(F.col(output))
    )
