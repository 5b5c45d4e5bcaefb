"""Conversation prefix trie by time-forward processing.

Every conversation is rebuilt: it takes its opening from the first conversation of its family, then goes on with its own turns.
Each distinct sequence of first turns is a node; nodes carry their members, children, leaves, the tokens that sharing a prefix
saves in their subtree, and a digest of the conversations that end in them.

1. Names. A turn has a 120-bit digest; a prefix is named by the running XOR of hashes of (position, turn), which groups nodes
   without their texts. Ranks and running XORs are taken in stretches first (range partitions, SPAN turns), then carried over, so
   one conversation may hold a third of all rows.
2. Runs. A node is (smallest member, depth). Along one smallest member, nodes of equal member counts have the very
   same members: such a run has no branch inside and no end but at its bottom, and becomes one node of a smaller trie. Long
   shared or private chains cost one row each.
3. Shards. A subtree whose top has at most ``limit`` members holds fewer than twice as many runs: these subtrees are the shards.
   The runs above them have more members than ``limit`` each, so they are no more than rows / limit. With limit
   about the root of the number of rows both stay small, whatever the skew.
4. Time-forward processing. Within a shard Spark sorts runs by reverse level order (externally), and a task reads them in that order: a
   run takes what its children sent from a priority queue that spills, and sends its totals to its parent, which is
   met later. What the shards' tops send is summed by receiver and passes on across the runs above, in the same way.
5. Back at the nodes, saved tokens are a suffix sum along the run.

The digest of a node's ends is a running SHA-256 over its sorted members, which no engine can split: one task streams the
ids of conversations that are equal as a whole, and holds none of them.

Defined cases: a NULL role or text is empty; NULL turns come first; turns of equal number follow the order of the SHA-256 of
``<role's length>:<role><text>`` (equal rows are interchangeable, and each counts as a turn); a row without a conversation id
belongs to no conversation; a conversation left without turns is a member, and an end, of the root; further columns
are ignored; an empty input has no root. Texts are read whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navstream.llm.common import WORD, cut
from navstream.llm.spill_queue import MessageQueue

FAMILY, OPENINGS = 20, 4
#: Turns of a conversation, or nodes of a run, that one window sorts together.
SPAN = 4096
#: A shard's top has at most so many members, or the root of the number of rows if that is more.
LIMIT = 50_000
EMPTY = hashlib.sha256(b"").hexdigest()


def opening(conv: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return F.crc32(conv.cast("string").cast("binary")) % OPENINGS


def _stretch(at: str) -> Column:
    return F.floor((F.col(at) - 1) / SPAN).cast("long")


def ranked_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(c, r, t1, t2, words): every turn's rank in its conversation, digest and word count; texts stay where they are."""
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256)
    number = lambda k: F.conv(F.substring("digest", k, 15), 16, 10).cast("long")
    named = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("c"), F.col(turn).alias("turn"), digest.alias("digest"),
        F.coalesce(F.regexp_count(said, F.lit(WORD)), F.lit(0)).cast("long").alias("words"),
    ).select("c", "turn", number(1).alias("t1"), number(16).alias("t2"), "words")
    order = [F.asc_nulls_first("turn"), F.asc("t1"), F.asc("t2")]
    # a range partition holds a stretch of each conversation in it; its number orders the stretches
    placed = cut(named.repartitionByRange(F.asc("c"), *order).withColumn("part", F.spark_partition_id()), "trie-turns")
    here = placed.groupBy("c", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("c").orderBy("part")) - F.col("n")
    offsets = cut(here.withColumn("before", before).where("before > 0").select("c", "part", "before"), "trie-offsets")
    rank = F.row_number().over(Window.partitionBy("c", "part").orderBy(*order))
    joined = placed.withColumn("r", rank).join(offsets, ["c", "part"], "left")
    return cut(joined.select("c", (F.col("r") + F.coalesce("before", F.lit(0))).alias("r"), "t1", "t2", "words"), "trie-ranked")


def rebuilt(ranked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, d, t1, t2, words) of every rebuilt turn, and (c, h, lead, length) of every conversation."""
    sizes = ranked.groupBy("c").agg(F.count(F.lit(1)).alias("own"))
    convs = sizes.select("c", (F.col("c") - F.col("c") % FAMILY).alias("base"), opening(F.col("c")).alias("h"), "own")
    first = convs.select(F.col("c").alias("b"), F.col("own").alias("there"))
    lead = F.least(F.col("h"), F.coalesce("there", F.lit(0)))
    known = cut(
        convs.join(first, F.col("base") == F.col("b"), "left")
        .select("c", "base", "h", lead.alias("lead"), (lead + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")),
        "trie-convs",
    )
    # a family has at most 2 * FAMILY - 1 members and an opening fewer than OPENINGS turns
    heads = ranked.where(F.col("r") < OPENINGS).withColumnRenamed("c", "b")
    opened = known.join(heads, (F.col("base") == F.col("b")) & (F.col("r") <= F.col("h"))).select("c", F.col("r").alias("d"), "t1", "t2", "words")
    short = known.where("lead < h").select(F.col("c").alias("s"), (F.col("h") - F.col("lead")).alias("less"))
    own = ranked.where(F.col("r") > opening(F.col("c"))).join(short, F.col("c") == F.col("s"), "left")
    own = own.select("c", (F.col("r") - F.coalesce("less", F.lit(0))).alias("d"), "t1", "t2", "words")
    return opened.unionByName(own), known


def named_prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(c, d, p1, p2, q1, q2, words): the name of the prefix that every rebuilt turn ends, and of the one before it."""
    hashed = turns.withColumns({f"x{k}": F.xxhash64(F.lit(k), "d", "t1", "t2") for k in (1, 2)}).withColumn("s", _stretch("d"))
    along = Window.partitionBy("c", "s").orderBy("d")
    running = hashed.withColumns({f"p{k}": F.bit_xor(f"x{k}").over(along) for k in (1, 2)})
    # conversations of more than one stretch: what the stretches before this one come to
    long = convs.where(F.col("length") > SPAN).select("c")
    totals = hashed.join(long, "c", "left_semi").groupBy("c", "s").agg(*[F.bit_xor(f"x{k}").alias(f"x{k}") for k in (1, 2)])
    earlier = Window.partitionBy("c").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    carried = cut(totals.select("c", "s", *[F.bit_xor(f"x{k}").over(earlier).alias(f"y{k}") for k in (1, 2)]).where("y1 IS NOT NULL"), "trie-carried")
    whole = running.join(carried, ["c", "s"], "left")
    name = {f"p{k}": F.col(f"p{k}").bitwiseXOR(F.coalesce(f"y{k}", F.lit(0).cast("long"))) for k in (1, 2)}
    past = {f"q{k}": F.col(f"p{k}").bitwiseXOR(F.col(f"x{k}")) for k in (1, 2)}
    return cut(whole.withColumns(name).withColumns(past).select("c", F.col("d").cast("long").alias("d"), "p1", "p2", "q1", "q2", "words"), "trie-prefixes")


def runs_of(nodes: DataFrame, root: int) -> DataFrame:
    """(m, n, top, bottom, own, b1, b2, pm): the runs of nodes (m, d, n, ...) and the smallest member of their parent."""
    runs = nodes.groupBy("m", "n").agg(
        F.min("d").alias("top"), F.max("d").alias("bottom"), F.sum((F.col("n") - 1) * F.col("words")).alias("own"),
        F.min_by(F.struct("q1", "q2"), "d").alias("above"), F.max_by(F.struct("p1", "p2"), "d").alias("name"),
    ).select("m", "n", "top", "bottom", "own", "above.q1", "above.q2", F.col("name.p1").alias("b1"), F.col("name.p2").alias("b2"))
    runs = cut(runs, "trie-runs")
    above = runs.select((F.col("bottom") + 1).alias("top"), F.col("b1").alias("q1"), F.col("b2").alias("q2"), F.col("m").alias("above"))
    parent = F.when(F.col("top") == 1, F.lit(root)).otherwise(F.col("above"))
    return runs.join(above.where("top > 1"), ["top", "q1", "q2"], "left").select("m", "n", "top", "bottom", "own", "b1", "b2", parent.alias("pm"))


def end_digests(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """(b1, b2, bottom, ends): SHA-256 of the ascending ids that end in a prefix; streamed, nothing is held."""
    last = prefixes.groupBy("c").agg(F.max(F.struct("d", "p1", "p2")).alias("end")).select("end.d", "end.p1", "end.p2", "c")
    zero = F.lit(0).cast("long")
    turnless = convs.where("length = 0").select(zero.alias("d"), zero.alias("p1"), zero.alias("p2"), "c")
    keys = ["p1", "p2", "d"]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in rows:
            done = []
            for *key, conv in zip(*(batch.column(k).to_pylist() for k in (*keys, "c")), strict=True):
                if key != now:
                    if now is not None:
                        done.append((*now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(b",%d" % conv)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names=["b1", "b2", "bottom", "ends"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, digest.hexdigest())], names=["b1", "b2", "bottom", "ends"])

    sorted_ends = last.unionByName(turnless).repartition(*keys).sortWithinPartitions(*keys, "c")
    return cut(sorted_ends.mapInArrow(run, "b1 long, b2 long, bottom long, ends string"), "trie-ends")


def passed_totals(runs: DataFrame, held: int = 200_000) -> DataFrame:
    """(m, n, bottom, children, leaves, below, outer, pm, top, own): subtree totals of sorted runs. Per shard the rows come by
    reverse level order; an ``outer`` run sends nothing, its parent lies elsewhere. ``below`` leaves the run's own tokens out."""
    names = ["m", "n", "bottom", "children", "leaves", "below", "outer", "pm", "top", "own"]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, queue = None, MessageQueue(held)
        for batch in rows:
            x, out = {k: batch.column(k).to_pylist() for k in batch.schema.names}, []
            for s, m, top, bottom, own, pm, outer, c, l, b in zip(
                *(x[k] for k in ("shard", "m", "top", "bottom", "own", "pm", "outer", "children", "leaves", "below")), strict=True
            ):
                if s != shard:
                    if len(queue):
                        raise RuntimeError("messages to runs that the shard does not hold")
                    shard = s
                children, leaves, below = queue.take((-bottom, m))
                children, leaves, below = children + c, leaves + l, below + b
                leaves = leaves or 1
                out.append((children, leaves, below))
                if not outer:
                    queue.push((1 - top, pm, 1, leaves, below + own))
            totals = [pa.array(v, pa.int64()) for v in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column("m"), batch.column("n"), batch.column("bottom"), *totals, *(batch.column(k) for k in ("outer", "pm", "top", "own"))], names=names
            )

    return runs.sortWithinPartitions("shard", F.desc("bottom"), "m").mapInArrow(
        run, "m long, n long, bottom long, children long, leaves long, below long, outer boolean, pm long, top long, own long"
    )


def subtree_totals(runs: DataFrame, prefixes: DataFrame, nodes: DataFrame, root: int, members: int, limit: int) -> DataFrame:
    """(m, n, bottom, children, leaves, below, pm) of every run and of the root (bottom 0)."""
    heavy = nodes.where(F.col("n") > limit).select("d", "p1", "p2")
    last = cut(prefixes.join(heavy, ["d", "p1", "p2"], "left_semi").groupBy("c").agg((F.max("d") + 1).alias("at")), "trie-heavy")
    starts = prefixes.join(last, "c", "left").where(F.col("d") == F.coalesce("at", F.lit(1)))
    starts = starts.select(F.col("c").alias("m"), F.xxhash64("d", "p1", "p2").alias("shard"), F.col("d").alias("start"))
    zero = F.lit(0).cast("long")
    nothing = {"children": zero, "leaves": zero, "below": zero}
    light = runs.where(F.col("n") <= limit).join(starts, "m").withColumns({"outer": F.col("top") == F.col("start"), **nothing})
    within = cut(passed_totals(light.repartition("shard")), "trie-within")
    sent = (
        within.where("outer").groupBy("pm", F.col("top").alias("level"))
        .agg(F.count(F.lit(1)).alias("children"), F.sum("leaves").alias("leaves"), F.sum(F.col("below") + F.col("own")).alias("below"))
        .select(F.col("pm").alias("to"), F.col("level") - 1, "children", "leaves", "below").toDF("to", "level", "children", "leaves", "below")
    )
    top = runs.sparkSession.range(1).select(
        F.lit(root).cast("long").alias("m"), F.lit(members).cast("long").alias("n"), zero.alias("top"), zero.alias("bottom"), zero.alias("own"),
        F.lit(None).cast("long").alias("pm"), F.lit(True).alias("outer"),
    )
    above = runs.where(F.col("n") > limit).select("m", "n", "top", "bottom", "own", "pm", F.lit(False).alias("outer")).unionByName(top)
    received = above.join(sent, (F.col("m") == F.col("to")) & (F.col("bottom") == F.col("level")), "left").select(
        *above.columns, F.lit(0).cast("long").alias("shard"), *[F.coalesce(k, zero).alias(k) for k in nothing]
    )
    # rows / limit runs at most
    across = passed_totals(received.repartition(1))
    return within.unionByName(across).select("m", "n", "bottom", "children", "leaves", "below", "pm", "top")


def prefix_trie(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", limit: int | None = None
) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one row per node."""
    ranked = ranked_turns(turns, conv_col, turn_col, role_col, text_col)
    rows, convs = rebuilt(ranked)
    prefixes = named_prefixes(rows, convs)
    root, members, length = convs.agg(F.min("c"), F.count(F.lit(1)), F.sum("length")).first()
    limit = limit or max(LIMIT, math.isqrt(length or 0))
    nodes = cut(
        prefixes.groupBy("d", "p1", "p2")
        .agg(F.min("c").alias("m"), F.count(F.lit(1)).alias("n"), *[F.max(k).alias(k) for k in ("words", "q1", "q2")]),
        "trie-nodes",
    )
    runs = cut(runs_of(nodes, root or 0), "trie-linked")
    ends = end_digests(prefixes, convs)
    totals = subtree_totals(runs, prefixes, nodes, root or 0, members, limit)
    zero = F.lit(0).cast("long")
    names = runs.select("m", "bottom", "b1", "b2").unionByName(
        runs.sparkSession.range(1).select(F.lit(root).cast("long").alias("m"), zero.alias("bottom"), zero.alias("b1"), zero.alias("b2"))
    )
    full = cut(totals.join(names, ["m", "bottom"]).join(ends, ["b1", "b2", "bottom"], "left").drop("b1", "b2"), "trie-totals")
    return node_rows(nodes, full)


def node_rows(nodes: DataFrame, totals: DataFrame) -> DataFrame:
    """Nodes with their run's totals: a suffix sum along the run, children and ends at its bottom."""
    along = Window.partitionBy("m", "n", "s").orderBy(F.desc("d"))
    own = F.sum((F.col("n") - 1) * F.col("words")).over(along)
    summed = nodes.select("m", "n", "d", "words").withColumn("s", _stretch("d")).withColumn("own", own)
    long = totals.where((_stretch("top") < _stretch("bottom")) & (F.col("n") > 1)).select("m", "n")
    parts = summed.join(long, ["m", "n"], "left_semi").groupBy("m", "n", "s").agg(F.max("own").alias("part"))
    behind = Window.partitionBy("m", "n").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, -1)
    carried = cut(parts.select("m", "n", "s", F.sum("part").over(behind).alias("behind")).where("behind IS NOT NULL"), "trie-behind")
    known = summed.join(carried, ["m", "n", "s"], "left").join(totals.where("bottom > 0"), ["m", "n"])
    below = known.select(
        F.col("m").alias("conv_id"), F.col("d").alias("depth"),
        F.when(F.col("d") == F.col("top"), F.col("pm")).otherwise(F.col("m")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(F.col("d") < F.col("bottom"), F.lit(1).cast("long")).otherwise(F.col("children")).alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("own") + F.coalesce("behind", F.lit(0)) + F.col("below")).cast("long").alias("saved_tokens"),
        F.when((F.col("d") == F.col("bottom")) & F.col("ends").isNotNull(), F.col("ends")).otherwise(EMPTY).alias("ends_sha256"),
    )
    root = totals.where("bottom = 0 AND n > 0").select(
        F.col("m").alias("conv_id"), F.col("bottom").alias("depth"), F.col("pm").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("below").alias("saved_tokens"),
        F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"),
    )
    return below.unionByName(root)
