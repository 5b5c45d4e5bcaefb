"""Mixing sources to target token weights by entropy balancing.

Sources in code point order (NULL last) get the repeating weights; their targets share the whole
token total, and a target above ``max_copies`` times its source's tokens stops there, the excess
going to the others by weight. Within a source the document rates stay as close to 1 as the token
constraint allows in relative entropy: the dual of that program has one multiplier per source, and
its solution tilts exponentially in document size, ``rate = min(max_copies, exp(lambda * x))`` with x the
size over the source's mean size. Safeguarded Newton steps solve all duals at once over the
(source, size) histogram, and rates become whole copies by systematic rounding along that histogram.

Everything is DataFrame expressions. Per-document tables carry ids and sizes only; per-source tables
hold one row per source.

Defined cases: a NULL text has size 0; size-0 documents take nothing; a NULL source is a source of
its own, last in order; equal or NULL ids are separate documents (equal rows are dealt in an
arbitrary but value-equal order); a source without words has target 0; an empty input gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navstream.llm.common import WORD, cut, discard

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
#: Newton stops when every source is within this share of its target.
TOLERANCE = 1e-9
MAX_STEPS = 60
#: Rounding offsets tried per source; the one nearest the target wins.
PHASES = 16
#: Rows of one (source, size) cell ranked together at most, on average.
CELL_ROWS = 20_000


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(cells: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(src_null, src, source_size, mean_size, target), one row per source, from the histogram.

    A target is min(max_copies * size, level * weight) for the one level at which targets sum to the total.
    Ordered by size per weight, the stopped sources are a prefix, so the level follows from running
    sums: source k is stopped when the level with sources before k stopped still reaches its limit.
    """
    sources = cells.groupBy("src_null", "src").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs")
    )
    ordered = Window.orderBy("src_null", "src")
    rank = (F.row_number().over(ordered) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), rank + 1)
    limit = F.lit(float(max_copies)) * F.col("source_size")
    every = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), "src_null", "src")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    return (
        sources.withColumn("weight", weight)
        .withColumn("limit", limit)
        .withColumn("total", F.sum(F.col("source_size").cast("double")).over(every))
        .withColumn("level", level)
        .withColumn("stopped", F.col("level") * F.col("weight") >= F.col("limit"))
        # the final level is the one of the first source that is not stopped
        .withColumn("final", F.min(F.when(~F.col("stopped"), F.struct(F.col("limit") / F.col("weight"), "level"))).over(every)["level"])
        .select(
            "src_null",
            "src",
            "source_size",
            (F.col("source_size") / F.col("docs")).alias("mean_size"),
            F.when(F.col("stopped"), F.col("limit")).otherwise(F.col("final") * F.col("weight")).alias("target"),
        )
    )


def _rate(lam: Column, x: Column, max_copies: int) -> Column:
    """exp(lambda x), stopped at max_copies before it can overflow."""
    return F.exp(F.least(lam * x, F.lit(math.log(max_copies))))


def _exact_sum(value: Column) -> Column:
    """A sum on a fixed grid: decimals add up alike in any order, so reruns agree to the last bit."""
    return F.sum(value.cast("decimal(38, 12)")).cast("double")


def solve_rates(cells: DataFrame, targets: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """(src_null, src, lam) with sum(size * rate) = target in every source.

    Each step is one aggregation of the histogram (value and slope of the dual's gradient per source)
    and an update of the per-source state; a step leaving the bracket becomes a bisection. Only the
    largest relative residual reaches the driver.
    """
    log_cap = math.log(max_copies)
    smallest = cells.where("size > 0").groupBy("src_null", "src").agg(F.min("size").alias("min_size"))
    ratio = F.col("target") / F.col("source_size")
    min_x = F.col("min_size") / F.col("mean_size")
    keys = ["src_null", "src"]
    up = ratio >= 1
    state = cut(
        targets.join(smallest, keys).select(
            *keys, "target", "mean_size",
            # at max_copies the multiplier is the one that stops every document there
            F.when(ratio >= max_copies, F.lit(log_cap) / min_x).otherwise(F.lit(0.0)).alias("lam"),
            F.when(up, F.lit(0.0)).otherwise(F.log(F.greatest(ratio, F.lit(1e-300))) / min_x).alias("lo"),
            F.when(up, F.lit(log_cap) / min_x).otherwise(F.lit(0.0)).alias("hi"),
            F.lit(1.0).alias("residual"),
        ),
        "mix-state",
    )
    for _ in range(MAX_STEPS):
        x = F.col("size") / F.col("mean_size")
        rate = _rate(F.col("lam"), x, max_copies)
        mass = F.col("size") * F.col("n") * rate
        free = F.col("lam") * x < log_cap
        sums = (
            cells.join(state, keys)
            .groupBy(*keys)
            .agg(_exact_sum(mass).alias("g"), _exact_sum(F.when(free, mass * x).otherwise(0.0)).alias("slope"))
        )
        over = F.col("g") > F.col("target")
        lo = F.when(over, F.col("lo")).otherwise(F.greatest("lo", "lam"))
        hi = F.when(over, F.least("hi", "lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - (F.col("g") - F.col("target")) / F.when(F.col("slope") > 0, F.col("slope"))
        residual = F.abs(F.col("g") - F.col("target")) / F.col("target")
        before = state
        state = cut(
            state.join(sums, keys)
            .withColumns({"lo": lo, "hi": hi, "newton": newton, "residual": residual})
            .select(
                *keys, "target", "mean_size",
                F.when(F.col("residual") <= TOLERANCE, F.col("lam"))
                .when((F.col("newton") > F.col("lo")) & (F.col("newton") < F.col("hi")), F.col("newton"))
                .otherwise((F.col("lo") + F.col("hi")) / 2)
                .alias("lam"),
                "lo", "hi", "residual",
            ),
            "mix-state",
        )
        discard(before)
        worst = state.agg(F.max("residual")).first()[0]
        if worst is None or worst <= TOLERANCE:
            return state.select(*keys, "lam")
    raise RuntimeError(f"the mix did not settle in {MAX_STEPS} steps: largest relative residual {worst:.3g}")


def extra_copies(cells: DataFrame) -> DataFrame:
    """(src_null, src, size, whole, extra): copies every document of a cell gets, and how many of its
    documents get one more.

    Systematic rounding: cells lie in size order, and a cell's extra copies are the integers that the
    running sum of fractional copies passes in it. Counts then never drift by more than one along the
    sizes, which keeps the tokens within one document of the target; the offset is the best of PHASES.
    """
    keys = ["src_null", "src"]
    along = Window.partitionBy(*keys, "phase").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    whole = F.floor(F.col("rate") + 1e-9)
    phases = F.explode(F.sequence(F.lit(0), F.lit(PHASES - 1))).alias("phase")
    tried = (
        cells.select(*keys, "size", "n", "target", whole.alias("whole"), F.greatest(F.col("rate") - whole, F.lit(0.0)).alias("part"), phases)
        .withColumn("end", F.sum(F.col("part") * F.col("n")).over(along))
        .withColumn("shift", (F.col("phase") + 0.5) / PHASES)
        .withColumn(
            "extra",
            (F.floor(F.col("end") + F.col("shift")) - F.floor(F.greatest(F.col("end") - F.col("part") * F.col("n"), F.lit(0.0)) + F.col("shift"))).cast("long"),
        )
        .withColumn("extra", F.least("extra", "n"))
    )
    best = (
        tried.groupBy(*keys, "phase")
        .agg(F.abs(F.sum(F.col("size") * (F.col("whole") * F.col("n") + F.col("extra"))) - F.first("target")).alias("off"))
        .groupBy(*keys)
        .agg(F.min(F.struct("off", "phase"))["phase"].alias("phase"))
    )
    return tried.join(best, [*keys, "phase"]).select(*keys, "size", "n", "whole", "extra")


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    max_copies: int = MAX_COPIES,
) -> DataFrame:
    """(id, source, size, source_size, target, rate, copies, taken), one row per input row."""
    sized = cut(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).cast("string").isNull().alias("src_null"),
            F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("src"),
            word_count(text_col).alias("size"),
        ),
        "mix-sizes",
    )
    keys = ["src_null", "src"]
    cells = cut(sized.groupBy(*keys, "size").agg(F.count(F.lit(1)).alias("n")), "mix-cells")
    targets = cut(source_targets(cells, weights, max_copies), "mix-targets")
    lam = solve_rates(cells.where("size > 0"), targets.where("source_size > 0"), max_copies)
    rated = cells.join(targets, keys).join(lam, keys, "left").withColumn(
        "rate",
        F.when(F.col("size") == 0, F.lit(0.0)).otherwise(
            _rate(F.col("lam"), F.col("size") / F.col("mean_size"), max_copies)
        ),
    )
    quotas = cut(extra_copies(rated).join(rated.select(*keys, "size", "source_size", "target", "rate"), [*keys, "size"]), "mix-quotas")

    # Large cells are dealt in parts of about CELL_ROWS documents, each with its share of the extras.
    mixed_hash = F.xxhash64(F.col("id"), F.lit(17))
    parts = F.greatest(F.ceil(F.col("n") / CELL_ROWS), F.lit(1))
    dealt = sized.join(quotas, [*keys, "size"]).select(
        "id", *keys, "size", "source_size", "target", "rate", "whole", "extra", "n",
        mixed_hash.alias("h"), F.pmod(F.xxhash64(F.col("id"), F.lit(5)), parts).alias("part"),
    )
    split = dealt.where("n > %d AND extra > 0 AND extra < n" % CELL_ROWS)
    plain = dealt.where("NOT (n > %d AND extra > 0 AND extra < n)" % CELL_ROWS)
    cell = [*keys, "size"]
    shares = split.groupBy(*cell, "part").agg(F.count(F.lit(1)).alias("here"), F.first("extra").alias("all"), F.first("n").alias("of"))
    upto = Window.partitionBy(*cell).orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    seen = F.sum("here").over(upto)
    share = F.floor(seen * F.col("all") / F.col("of")) - F.floor((seen - F.col("here")) * F.col("all") / F.col("of"))
    shares = shares.select(*cell, "part", share.cast("long").alias("part_extra"))
    split = split.join(shares, [*cell, "part"]).drop("extra").withColumnRenamed("part_extra", "extra")
    ranked = plain.unionByName(split).withColumn(
        "copies",
        F.when(F.col("extra") <= 0, F.col("whole"))
        .otherwise(
            F.col("whole")
            + F.when(
                F.row_number().over(Window.partitionBy(*cell, "part").orderBy("h", F.col("id"))) <= F.col("extra"), 1
            ).otherwise(0)
        )
        .cast("long"),
    )
    return ranked.select(
        "id",
        F.when(~F.col("src_null"), F.col("src")).alias("source"),
        "size",
        F.col("source_size").cast("long").alias("source_size"),
        F.col("target").cast("double").alias("target"),
        F.coalesce(F.col("rate"), F.lit(0.0)).alias("rate"),
        F.coalesce(F.col("copies"), F.lit(0)).cast("long").alias("copies"),
        (F.col("size") * F.coalesce(F.col("copies"), F.lit(0))).cast("long").alias("taken"),
    )
