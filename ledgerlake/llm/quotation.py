"""Chat formatting (operator 9): messages linked to the messages that they quote.

1. A message is parsed into its own text and quoted passages: consecutive lines
   with the same number of leading ``>`` form a passage of that level. Blanks
   are collapsed and letters lower-cased before hashing. A message is indexed
   by its own lines and paragraphs, a quote looks for its lines and its whole
   passage, so a quote may hold a part of a message or a re-wrapped paragraph.
2. Within a conversation, each quoted hash is joined to the first message that
   holds it as its own text. Originals are pre-aggregated to one row per hash
   and kept only if quoted; the join is salted, so a passage that very many
   messages quote spreads over many tasks.
3. A message answers the earlier message that most of the quoted characters of
   its lowest linked level come from (ties: the later one). Pointer jumping
   finds each message's thread (the first message of its reply chain) and its
   depth in about log(depth) joins.

4. The place of a message in its conversation is one more than what stands
   before it: the earlier threads, and on its way up to the thread's first message
   each ancestor and the earlier answers to it with all below them. Pointer jumping
   counts the replies below each message, prefix sums over ranges add up earlier
   answers, and a second pointer jumping adds these up along the way.

Rows ordered by conversation and position are the conversations in reply
order, without quotes (:func:`ordered`).

Defined results: null and empty texts have no passages; a message without a
linked quote begins a thread of its own; a quote never links to the message
itself or a later one; rows with a null conversation or turn are kept, without
links and position; an empty table gives no rows; texts of any length are parsed
whole, and other columns of any name are ignored; of several rows with the same conversation and turn each is parsed by
itself, and all share one place and position (that of the latest message they
answer).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import salted_join, written

_QUOTE = re.compile(r"[ \t]*((?:>[ \t]?)+)(.*)", re.S)
#: A line that introduces a quote and isn't part of the message.
_INTRODUCES = re.compile(r"(?:wrote|writes|said|schrieb|écrit|a écrit|escribió)\s*:\s*$")
_BLANKS = re.compile(r"\s+")


def normal(text: str) -> str:
    return _BLANKS.sub(" ", text).strip().lower()


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - 2**63


def _passages(lines: list[tuple[int, str]]) -> Iterator[tuple[int, list[str]]]:
    """Runs of consecutive lines of the same level that aren't blank."""
    run: list[str] = []
    level = None
    for at, line in [*lines, (-1, "")]:
        if run and (at != level or not line):
            yield level, run
            run = []
        level = at
        if line:
            run.append(line)


def parse(text: str) -> tuple[str, list[int], list[tuple[int, int, int]], int, int]:
    """The text without quotes; hashes of its lines and paragraphs; of each quoted line or
    passage the level, hash and number of characters; the deepest level; the quoted lines."""
    own, lines = [], []
    for raw in text.split("\n"):
        m = _QUOTE.fullmatch(raw)
        if m:
            if own and lines and lines[-1][0] == 0 and _INTRODUCES.search(own[-1]):
                own.pop()
                lines.pop()
            lines.append((m.group(1).count(">"), normal(m.group(2))))
        else:
            own.append(raw)
            lines.append((0, normal(raw)))
    hashes: dict[int, None] = {}
    quoted: dict[tuple[int, int], int] = {}
    for level, run in _passages(lines):
        for part in dict.fromkeys([*run, " ".join(run)]):
            if level == 0:
                hashes[_hash(part)] = None
            else:
                quoted[level, _hash(part)] = len(part)
    levels = [n for n, _ in lines if n]
    clean = "\n".join(own).strip() if levels else text
    return (clean, list(hashes), [(n, h, size) for (n, h), size in quoted.items()],
            max(levels, default=0), len(levels))


def parsed(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role and the parts of each message (see :func:`parse`)."""
    quote = pa.struct([("level", pa.int32()), ("hash", pa.int64()), ("size", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [parse(t or "") for t in batch.column(3).to_pylist()]
            clean, own, quotes, level, lines = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(list(clean), pa.string()),
                 pa.array(list(own), pa.list_(pa.int64())),
                 pa.array([[dict(level=a, hash=b, size=c) for a, b, c in q] for q in quotes],
                          pa.list_(quote)),
                 pa.array(list(level), pa.int32()), pa.array(list(lines), pa.int64())],
                ["conv_id", "turn", "role", "text", "own", "quotes", "quote_level",
                 "n_quoted_lines"])

    return messages.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").mapInArrow(
        run, "conv_id long, turn long, role string, text string, own array<long>, "
             "quotes array<struct<level:int,hash:long,size:long>>, quote_level int, "
             "n_quoted_lines long")


def links(parts: DataFrame) -> DataFrame:
    """conv_id, turn, reply_to and n_linked (passages and lines) of messages with a linked quote."""
    quotes = parts.where("conv_id is not null and turn is not null").select(
        "conv_id", "turn", F.explode("quotes").alias("q")).select("conv_id", "turn", "q.*")
    wanted = quotes.select("conv_id", "hash").distinct()
    first = (parts.select("conv_id", "turn", F.explode("own").alias("hash"))
             .groupBy("conv_id", "hash").agg(F.min("turn").alias("first"))
             .join(wanted, ["conv_id", "hash"]))
    found = salted_join(quotes, first, ["conv_id", "hash"], "turn").where("first < turn")
    by_target = found.groupBy("conv_id", "turn", "level", "first").agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    return by_target.groupBy("conv_id", "turn").agg(
        F.max(F.struct(-F.col("level"), "size", "first")).alias("best"),
        F.sum("n").alias("n_linked")).select(
        "conv_id", "turn", F.col("best.first").alias("reply_to"), "n_linked")


def threads(replies: DataFrame, steps: str | None = None, most_rounds: int = 64) -> DataFrame:
    """conv_id, turn, root_turn, reply_depth and size of each reply, by pointer jumping.

    ``size`` counts the message and all replies below it: a round adds the
    counts of those that it moves up from a message to that message. With a
    column ``steps``, its sum along the way to the root is returned instead of
    depth and size.
    """
    state = written(replies.select(
        "conv_id", "turn", F.col("reply_to").alias("root_turn"),
        (F.col(steps) if steps else F.lit(1)).cast("long").alias("way"), F.lit(1).cast("long").alias("size")),
        "threads")
    for _ in range(most_rounds):
        # only targets that are replies themselves move on
        above = state.select("conv_id", F.col("turn").alias("root_turn"),
                             F.col("root_turn").alias("up"), F.col("way").alias("more"))
        above = above.join(state.select("conv_id", "root_turn").distinct(),
                           ["conv_id", "root_turn"], "left_semi")
        joined = salted_join(state, above, ["conv_id", "root_turn"], "turn", "left")
        moved = written(joined.select(
            "conv_id", "turn", F.coalesce("up", "root_turn").alias("root_turn"),
            (F.col("way") + F.coalesce("more", F.lit(0))).alias("way"), "size",
            F.when(F.col("up").isNotNull(), F.col("root_turn")).alias("_passed")), "threads")
        state = moved.drop("_passed")
        last = moved.where("_passed is not null").limit(1).count() == 0
        if steps is None and not last:
            below = moved.where("_passed is not null").groupBy(
                "conv_id", F.col("_passed").alias("turn")).agg(F.sum("size").alias("more"))
            state = written(state.join(below, ["conv_id", "turn"], "left").select(
                "conv_id", "turn", "root_turn", "way",
                (F.col("size") + F.coalesce("more", F.lit(0))).alias("size")), "threads")
        if last:
            return (state.withColumnRenamed("way", "reply_depth") if steps is None
                    else state.withColumnRenamed("way", steps).drop("size"))
    raise RuntimeError(f"reply chains longer than 2**{most_rounds}")


def earlier_sums(rows: DataFrame, group: list[str], order: str, value: str, out: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over the rows before each in its group.

    Rows are dealt into ranges of (group, order), so a group of any size is
    summed by many tasks; a range takes over the sums of the ranges before it
    (one small row per range and group).
    """
    ranged = written(rows.repartitionByRange(*group, order).withColumn(
        "_range", F.spark_partition_id()), "ranges")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*group, "_range").agg(F.sum(value).alias("_sum"))
    carried = sums.select(*group, "_range", F.sum("_sum").over(
        before.partitionBy(*group).orderBy("_range")).alias("_carried"))
    within = ranged.withColumn("_within", F.sum(value).over(
        before.partitionBy("_range", *group).orderBy(order)))
    return within.join(carried, [*group, "_range"]).withColumn(
        out, F.coalesce("_carried", F.lit(0)) + F.coalesce("_within", F.lit(0))).drop(
        "_range", "_carried", "_within")


def positions(parts: DataFrame, placed: DataFrame) -> DataFrame:
    """conv_id, turn and position (from 1) of each message in its conversation's reply order:
    threads by their first turn, each answer after what it answers, with all answers to it
    before the next answer to the same message."""
    nodes = parts.where("conv_id is not null and turn is not null").select(
        "conv_id", "turn").distinct()
    trees = nodes.join(placed.select("conv_id", "turn"), ["conv_id", "turn"], "left_anti").join(
        placed.groupBy("conv_id", F.col("root_turn").alias("turn")).agg(
            F.count(F.lit(1)).alias("n")), ["conv_id", "turn"], "left")
    first = written(earlier_sums(
        trees.withColumn("size", F.coalesce("n", F.lit(0)) + 1), ["conv_id"], "turn", "size",
        "position").select("conv_id", "turn", (F.col("position") + 1).alias("position"), "n"), "trees")
    siblings = earlier_sums(placed.select("conv_id", "turn", "reply_to", "size"),
                            ["conv_id", "reply_to"], "turn", "size", "steps")
    inner = threads(siblings.withColumn("steps", F.col("steps") + 1), "steps")
    roots = first.where("n > 0").select("conv_id", F.col("turn").alias("root_turn"), "position")
    below = salted_join(inner, roots, ["conv_id", "root_turn"], "turn").select(
        "conv_id", "turn", (F.col("position") + F.col("steps")).alias("position"))
    return first.select("conv_id", "turn", "position").unionByName(below)


def link_quotations(messages: DataFrame) -> DataFrame:
    """Every message without its quotes, the message it answers, its thread, depth and position."""
    parts = written(parsed(messages), "messages")
    found = written(links(parts), "replies")
    placed = written(threads(found).join(found, ["conv_id", "turn"]), "placed")
    places = positions(parts, placed).join(placed.drop("size"), ["conv_id", "turn"], "left")
    body = parts.select("conv_id", "turn", "role", "text", "quote_level", "n_quoted_lines")
    # rows that repeat a turn are few or, if many, a skewed partition that Spark splits
    return body.join(places, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "text", "quote_level", "n_quoted_lines",
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "reply_to",
        F.coalesce("root_turn", "turn").alias("root_turn"),
        F.coalesce("reply_depth", F.lit(0)).cast("long").alias("reply_depth"), "position")


def ordered(linked: DataFrame) -> DataFrame:
    """The conversations in reply order, without quotes."""
    return linked.orderBy("conv_id", "position", "turn")
