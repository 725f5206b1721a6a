"""Operator 11: chat formatting over a prefix tree.

Conversations that begin with the same turns share them.  A tree holds the
conversations with one first turn; its turns are emitted once, depth first, and lie one
after the other in the tree's sequence.  Three tables come out:

* ``nodes``: a row per distinct prefix, with the formatted turn ``chunk``, ``start``, its
  place in the tree's sequence, ``position``, the position id of its first token (what
  the conversation has before it), and the part under the loss mask, ``loss_from`` to
  ``loss_to`` inside the chunk;
* ``attention``: for every segment the intervals of its ancestors in the sequence.  A
  *segment* is the run of turns that one conversation is the smallest to have; a node sees
  its segment's intervals and its own segment up to itself;
* ``members``: the segment (that is the smallest equal conversation) of every ``conv_id``.

Tokens are code points unless ``measure`` gives another length of a formatted turn.

Template: ``<|im_start|>role``, a line end, the text, ``<|im_end|>`` and a line end.  In a
text, ``<``, any backslashes and ``|`` get one backslash more, so no control string is
left and taking one away restores it; in a role, backslash, line end and bar are written
``\\\\``, ``\\n`` and ``\\p``.  The loss mask covers the texts of the role ``assistant``.

Depth-first order without a walk: below a segment come the segments that leave it, the
deepest first, then by id.  So a segment's start is the sum, over the segments of its
path, of their lengths and of the whole subtrees that come before them under their
parents; the sums are aggregations over (segment, ancestor) rows, at most as many as
turns, and a two-level running sum that deals one parent's many children to many tasks.
Texts move twice, to their node and to their reader; sizes and hashes do the rest.

:func:`read_back` reads conversations from the written nodes by their attention
intervals, undoes the escapes and hashes them as a stream, so a conversation of any
length is read in bounded memory.

Defined results: null roles and texts are empty; turns with one number, repeated rows
included, are taken in the order of a hash of role and text; rows with a null
``conv_id`` are one conversation, whose id is null again in ``members`` and the digest
(the least long stands for it inside); an empty table gives empty tables; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caseflow.llm.turns import each_depth, ordered_turns, prefix_keys, running, text_of, turn_hashes
from caseflow.session import stage

START, END, LOSS_ROLE = "<|im_start|>", "<|im_end|>", "assistant"
NO_ID = -(2**63)
ROLE_MARKS = {"\\": "\\", "n": "\n", "p": "|"}


def escaped_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escaped_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("|"), F.lit("\\p"))


def plain_text(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def plain_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: ROLE_MARKS[m[1]], role)


def formatted(conversations: DataFrame, measure: Callable[[Column], Column]) -> DataFrame:
    """``(conv_id, at, a, b, chunk, size, loss_from, loss_to)`` of every turn."""
    role, text = text_of("role"), text_of("text")
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv_id"), F.col("turn").cast("long"),
        *turn_hashes(role, text), F.concat(F.lit(START), escaped_role(role), F.lit("\n")).alias("head"), escaped_text(text).alias("body"), (role == LOSS_ROLE).alias("loss"),
    )
    placed = ordered_turns(rows)
    chunk = F.concat("head", "body", F.lit(END + "\n"))
    loss = lambda c: F.when(F.col("loss"), c).cast("long")
    done = placed.select("conv_id", "at", "a", "b", chunk.alias("chunk"), loss(F.length("head")).alias("loss_from"), loss(F.length("head") + F.length("body")).alias("loss_to"))
    return done.withColumn("size", measure(F.col("chunk")).cast("long"))


def segments_of(paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Segments ``(segment, tree, above, length, start, positions)`` and the pieces of each one's path.

    ``paths(m, d, key, size, sum_size)``: prefixes of the distinct conversations m.
    ``pieces(segment, owner, first, last, start, end)`` has the path's parts, own part included.
    """
    owners = stage(paths.groupBy("key").agg(F.min("m").alias("owner")))
    pieces = paths.join(owners, "key").groupBy(F.col("m").alias("segment"), "owner").agg(
        F.min("d").alias("first"), F.max("d").alias("last"), F.min(F.col("sum_size") - F.col("size")).alias("from"), F.max("sum_size").alias("to")
    )
    pieces = stage(pieces)
    # a conversation that is a prefix of a smaller one owns nothing and has no segment of its own
    own = pieces.where("segment = owner").select("segment", (F.col("first") - 1).alias("above"), (F.col("to") - F.col("from")).alias("length"), F.col("from").alias("positions"))
    whole = pieces.join(own.select("segment", "length"), "segment").groupBy("owner").agg(F.sum("length").alias("whole"))
    parent = pieces.where("segment <> owner").groupBy("segment").agg(F.max(F.struct("last", "owner")).alias("p")).select("segment", F.col("p.owner").alias("parent"))
    placed = stage(own.join(whole.withColumnRenamed("owner", "segment"), "segment").join(parent, "segment", "left"))
    # what comes before a segment under its parent: deeper leaves, then smaller ids at the same depth
    children = placed.where("parent is not null").select("parent", "above", "segment", F.col("whole").alias("upto"), "whole")
    at_depth = children.groupBy("parent", "above").agg(F.sum("whole").alias("sum"))
    deeper = Window.partitionBy("parent").orderBy(F.desc("above")).rowsBetween(Window.unboundedPreceding, -1)
    deep = at_depth.select("parent", "above", F.coalesce(F.sum("sum").over(deeper), F.lit(0)).alias("deeper"))
    before = running(children, ["parent", "above"], "segment", ["upto"]).join(deep, ["parent", "above"])
    before = before.select("segment", (F.col("upto") - F.col("whole") + F.col("deeper")).alias("before"))
    shift = placed.select(F.col("segment").alias("owner"), "length").join(before.withColumnRenamed("segment", "owner"), "owner", "left")
    shift = stage(shift.withColumn("before", F.coalesce("before", F.lit(0))))
    moved = F.col("before") + F.when(F.col("segment") != F.col("owner"), F.col("length")).otherwise(0)
    starts = pieces.join(shift, "owner").groupBy("segment").agg(F.sum(moved).alias("start"), F.max(F.when(F.col("first") == 1, F.col("owner"))).alias("tree"))
    segments = stage(placed.join(starts, "segment").select("segment", "tree", "above", "length", "start", "positions"))
    begin = segments.select(F.col("segment").alias("owner"), F.col("start").alias("owner_start"), "tree")
    spans = pieces.join(begin, "owner").select(
        "segment", "tree", "owner", "first", "last", F.col("owner_start").alias("start"), (F.col("owner_start") + F.col("to") - F.col("from")).alias("end")
    )
    return segments, spans


def chat_tree(conversations: DataFrame, measure: Callable[[Column], Column] = F.length) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``nodes``, ``attention`` and ``members`` of ``conversations(conv_id, turn, role, text)``."""
    turns = stage(formatted(conversations, measure))
    prefixes = stage(prefix_keys(turns.select("conv_id", "at", "a", "b", "size"), ["size"]).drop("parent_key"))
    ends = prefixes.groupBy("conv_id").agg(F.max(F.struct("d", "key")).alias("e")).select("conv_id", "e.key")
    ends = stage(ends)
    strings = ends.groupBy("key").agg(F.min("conv_id").alias("segment"))
    members = ends.join(strings, "key").select(F.when(F.col("conv_id") != NO_ID, F.col("conv_id")).alias("conv_id"), "segment")
    paths = stage(prefixes.join(strings.select(F.col("segment").alias("conv_id")), "conv_id", "left_semi").withColumnRenamed("conv_id", "m"))
    segments, spans = segments_of(paths)
    owned = paths.withColumnRenamed("m", "segment").join(segments, "segment").where("d > above").select(
        "segment", "tree", "d", (F.col("start") + F.col("sum_size") - F.col("size") - F.col("positions")).alias("start"), (F.col("sum_size") - F.col("size")).alias("position")
    )
    texts = turns.select(F.col("conv_id").alias("segment"), (F.col("at") + 1).alias("d"), "chunk", "size", "loss_from", "loss_to")
    nodes = owned.join(texts, ["segment", "d"]).select("tree", "segment", F.col("d").alias("depth"), "start", "size", "position", "chunk", "loss_from", "loss_to")
    return nodes, spans, members


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation of chunks that come in its order."""
    done: list[tuple] = []
    current, turns, loss, sums = None, hashlib.sha256(), hashlib.sha256(), [0, 0, 0]

    def flush() -> pa.RecordBatch:
        columns = zip(*done, strict=True) if done else [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ("segment", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names))
        done.clear()
        return batch

    def close() -> None:
        if current is not None:
            done.append((current, sums[0], turns.hexdigest(), sums[1], loss.hexdigest(), sums[2]))

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("segment", "chunk", "loss_from", "loss_to")), strict=True)
        for segment, chunk, loss_from, loss_to in rows:
            if segment != current:
                close()
                current, turns, loss, sums = segment, hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
            head = chunk.index("\n")
            role, text = plain_role(chunk[len(START) : head]), plain_text(chunk[head + 1 : -len(END) - 1])
            turns.update(f"{role}\n{text}\n".encode())
            sums[0] += 1
            sums[2] += len(chunk)
            if loss_from is not None:
                masked = plain_text(chunk[loss_from:loss_to])
                loss.update(masked.encode())
                sums[1] += len(masked)
        yield flush()
    close()
    yield flush()


def read_back(nodes: DataFrame, attention: DataFrame, members: DataFrame) -> DataFrame:
    """Every conversation read from the tree: counts and digests of its turns and of the text under the loss mask.

    ``nodes`` is read twice and should be a written table.
    """
    path = ["chunk", "loss_from", "loss_to"]
    shared = each_depth(attention.where("segment <> owner").select("segment", "owner", "first", "last"), "first", "last")
    far = shared.select("segment", "owner", F.col("d").alias("depth")).join(nodes.select(F.col("segment").alias("owner"), "depth", *path), ["owner", "depth"])
    rows = nodes.select("segment", "depth", *path).unionByName(far.select("segment", "depth", *path))
    ordered = rows.repartition("segment").sortWithinPartitions("segment", "depth").select("segment", *path)
    read = ordered.mapInArrow(_digests, "segment long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return members.join(read, "segment").drop("segment")


def chat_digest(conversations: DataFrame) -> DataFrame:
    """The digest of every conversation, read back from the written tree."""
    nodes, attention, members = chat_tree(conversations)
    return read_back(stage(nodes), stage(attention), members)
