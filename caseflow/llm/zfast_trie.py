"""Operator 13: the prefix trie of conversations, kept as a z-fast trie.

The trie's symbols are turns.  A compacted node stands for the edge that ends at its
*extent* (a fork or an end of a conversation) of depth ``x`` and begins below its
parent's extent of depth ``p``.  Its *handle* is the prefix of the 2-fattest depth in
``(p, x]``: the multiple of the highest power of two there.  The node table is keyed by
the handle's hash, so a conversation finds its exit node by fat binary search: each
round probes the prefix of the 2-fattest depth of its open interval, a hit moves the
lower end to the node's extent, a miss the upper end below the probe, and log2(depth)
rounds are enough.  A last look at the child's first turn and a comparison along that
one edge give the depth at which the conversation leaves the trie.

:func:`build` inserts the distinct conversations in batches: a batch searches the trie
of all earlier ones, exits inside an edge split it, what lies below the exits is
grouped by prefix key into new forks and ends, and only new and split nodes get a new
handle.  :func:`expand` turns edges back into one row per depth.

Every step is a join or an aggregation that pre-aggregates; prefix keys take two-level
sums (:mod:`caseflow.llm.turns`).  Equal conversations are one string of the trie, with
a count, before anything is joined.  Probes of one hot handle are the large side of a
left join with a unique right side, which adaptive execution splits.  Subtree sums need
no walk: a subtree's rows are its members, and each member owns the end of its path that
no smaller id shares.  A fork's digest reads the ids of its ends in blocks of ``CHUNK``
id values; only the hashing of one node's many blocks is one stream, in bounded memory.
Tables are staged in the shared folder, so a lost executor costs a step.

Defined results: null roles and texts are empty; turns with one number are taken in the
order of a hash of their role and text, repeated rows included; a conversation without turns
ends at the root; rows with a null ``conv_id`` belong to no conversation and are left
out; an empty table gives no node; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caseflow.llm.turns import each_depth, ordered_turns, prefix_keys, root_key, text_of, turn_hashes, word_count
from caseflow.session import stage

#: Share of the distinct conversations that the batches up to and with each have inserted.
BATCHES = (0.125, 1.0)
HASH_SPACE = 1 << 20
CHUNK = 512
SHARED_WITH, MAX_SHARED = 20, 4


def two_fattest(low: str, high: str) -> Column:
    """The number in ``(low, high]`` that the largest power of two divides."""
    return F.expr(f"{high} - {high} % shiftleft(1L, length(bin({low} ^ {high})) - 1)")


def rebuild(turns: DataFrame) -> DataFrame:
    """Rebuilt conversations: the first turns of the group's first one, then the own ones.

    ``turns(conv_id, at, ...)`` -> the same columns.  Conversation c takes the first h
    turns of the group of 20 ids that c lies in (h = crc32(c) % 4) and its own turns after its first h.
    """
    value = [c for c in turns.columns if c not in ("conv_id", "at")]
    head = F.col("conv_id") - F.pmod("conv_id", F.lit(SHARED_WITH))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MAX_SHARED).cast("long")
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    heads = sizes.select(F.col("conv_id").alias("head"), F.col("n").alias("head_n"))
    plan = sizes.select("conv_id", head.alias("head"), taken.alias("h")).join(heads, "head", "left")
    plan = plan.withColumn("got", F.least("h", F.coalesce("head_n", F.lit(0))))
    first = turns.where(F.col("at") < MAX_SHARED).withColumnRenamed("conv_id", "head")
    shared = plan.select("conv_id", "head", "h").join(first, "head").where("at < h").select("conv_id", "at", *value)
    own = turns.join(plan.select("conv_id", "h", "got"), "conv_id").where("at >= h")
    return shared.unionByName(own.withColumn("at", F.col("at") - F.col("h") + F.col("got")).select("conv_id", "at", *value))


def distinct_strings(ids: DataFrame, prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Strings ``(m, n, key, copies)``, m their smallest conversation, and all conversations' ``(conv_id, key)``."""
    last = prefixes.groupBy("conv_id").agg(F.max(F.struct("d", "key")).alias("e"))
    whole = ids.join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("e.d", F.lit(0).cast("long")).alias("n"), F.coalesce("e.key", root_key()).alias("key")
    )
    ends = stage(whole)
    return ends.groupBy("n", "key").agg(F.min("conv_id").alias("m"), F.count(F.lit(1)).alias("copies")), ends.select("conv_id", "key")


def with_handles(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes ``(x, key, p, rep)`` with ``f`` and ``handle``, the 2-fattest depth and its key, and ``first``, the key of the edge's first turn."""
    looked = nodes.withColumn("f", two_fattest("p", "x")).withColumn("d", F.explode(F.array_distinct(F.array("f", F.col("p") + 1))))
    found = looked.join(paths.select(F.col("m").alias("rep"), "d", F.col("key").alias("at_d")), ["rep", "d"])
    return found.groupBy("x", "key", "p", "rep", "f").agg(
        F.max(F.when(F.col("d") == F.col("f"), F.col("at_d"))).alias("handle"), F.max(F.when(F.col("d") == F.col("p") + 1, F.col("at_d"))).alias("first")
    )


def locate(strings: DataFrame, nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Where ``strings(m, n)`` leave the trie: ``m, n, e, key, edge``.

    ``e`` is the number of turns that the trie has of m, ``key`` their prefix; ``edge`` is
    the extent key of the edge left inside, null where m leaves at an extent.
    ``paths(m, d, key)`` are the prefixes of the strings in the trie and of those sought.
    """
    probes = nodes.select(F.col("handle").alias("_key"), F.col("x").alias("_x"), F.col("key").alias("_extent"), F.col("f").alias("_f"), F.col("rep").alias("_rep"))
    zero = F.lit(0).cast("long")
    state = strings.select("m", "n", zero.alias("l"), F.col("n").alias("r"), zero.alias("x"), root_key().alias("extent"), zero.alias("f"), zero.alias("rep"))
    done = []
    while True:
        state = stage(state)
        done.append(state.where("l >= r"))
        open_ = state.where("l < r")
        if open_.isEmpty():
            break
        asked = open_.withColumn("d", two_fattest("l", "r")).join(paths.select("m", "d", F.col("key").alias("_key")), ["m", "d"])
        hit = asked.join(probes, "_key", "left")
        found = F.col("_x").isNotNull()
        state = hit.select(
            "m", "n", F.when(found, F.col("_x")).otherwise(F.col("l")).alias("l"), F.when(found, F.col("r")).otherwise(F.col("d") - 1).alias("r"),
            *[F.when(found, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in ("x", "extent", "f", "rep")],
        )
    last = done[0]
    for part in done[1:]:
        last = last.unionByName(part)

    # whole edge matched, and if so, which child begins with the next turn?
    here = paths.select("m", F.col("d").alias("x"), F.col("key").alias("_here"))
    after = paths.select("m", (F.col("d") - 1).alias("x"), F.col("key").alias("_first"))
    children = nodes.where("x > 0").select(F.col("first").alias("_first"), F.col("x").alias("_x"), F.col("key").alias("_edge"), F.col("rep").alias("_rep"))
    seen = last.join(here, ["m", "x"], "left").join(after, ["m", "x"], "left").join(children, "_first", "left")
    whole = (F.col("x") == 0) | F.coalesce(F.col("_here") == F.col("extent"), F.lit(False))
    inside = seen.select(
        "m", "n",
        F.when(~whole, F.col("extent")).otherwise(F.col("_edge")).alias("edge"),
        F.when(~whole, F.col("f")).when(F.col("_edge").isNull(), F.col("x")).otherwise(F.col("x") + 1).alias("low"),
        F.when(~whole, F.col("x")).when(F.col("_edge").isNull(), F.col("x")).otherwise(F.col("_x")).alias("high"),
        F.when(~whole, F.col("rep")).otherwise(F.col("_rep")).alias("rep"),
    )
    inside = stage(inside)
    # comparison along the one edge, from the depth that is known to match
    along = each_depth(inside.where("edge is not null").select("m", "rep", (F.col("low") + 1).alias("low"), F.least("high", "n").alias("high")), "low", "high")
    mine = along.join(paths.select("m", "d", "key"), ["m", "d"])
    same = mine.join(paths.select(F.col("m").alias("rep"), "d", F.col("key").alias("_its")), ["rep", "d"]).where("key = _its")
    reached = same.groupBy("m").agg(F.max("d").alias("deep"))
    exits = inside.join(reached, "m", "left").select("m", "n", F.greatest("low", F.coalesce("deep", F.col("low"))).alias("e"), "edge")
    keyed = exits.join(paths.select("m", F.col("d").alias("e"), "key"), ["m", "e"], "left")
    return stage(keyed.select("m", "n", "e", F.coalesce("key", root_key()).alias("key"), "edge"))


def insert(nodes: DataFrame, batch: DataFrame, paths: DataFrame) -> DataFrame:
    """The trie with the strings ``batch(m, n, key)``; ``nodes(x, key, p, rep, f, handle, first)``."""
    exits = locate(batch.select("m", "n"), nodes, paths)
    new = stage(paths.join(exits.select("m", "e"), "m").where("d > e").select("m", "d", "key", "parent_key"))
    # below the exits: ends, and prefixes with two continuations
    ends = batch.join(exits.where("n > e").select("m"), "m", "left_semi").select("key")
    forks = new.select("key", "parent_key").distinct().groupBy("parent_key").count().where("count > 1").select(F.col("parent_key").alias("key"))
    marks = ends.union(forks).distinct()
    points = exits.select("m", F.col("e").alias("x"), "key", F.lit(False).alias("below"))
    below = new.join(marks, "key").select("m", F.col("d").alias("x"), "key", F.lit(True).alias("below"))
    lag = F.lag("x").over(Window.partitionBy("m").orderBy("x"))
    made = points.unionByName(below).withColumn("p", lag).where("below").groupBy("x", "key").agg(F.min("p").alias("p"), F.min("m").alias("rep"))
    # splits: the exits inside an edge cut it into pieces, the last of which keeps the extent
    cuts = exits.where("edge is not null").select("edge", F.col("e").alias("x"), "key").distinct()
    split = nodes.join(cuts.select(F.col("edge").alias("key")).distinct(), "key", "left_semi")
    held = cuts.join(split.select(F.col("key").alias("edge"), "p", "rep"), "edge")
    pieces = held.unionByName(split.select(F.col("key").alias("edge"), "x", "key", "p", "rep"))
    above = F.lag("x").over(Window.partitionBy("edge").orderBy("x"))
    pieces = pieces.withColumn("p", F.coalesce(above, F.col("p"))).select("x", "key", "p", "rep")
    changed = with_handles(made.select("x", "key", "p", "rep").unionByName(pieces), paths)
    kept = nodes.join(pieces.select("key"), "key", "left_anti")
    return stage(kept.unionByName(changed))


def build(strings: DataFrame, paths: DataFrame, batches: tuple[float, ...] = BATCHES) -> DataFrame:
    """The z-fast trie of ``strings(m, n, key)`` over ``paths(m, d, key, parent_key)``; the root's row has depth 0."""
    null = F.lit(None).cast("binary")
    zero = F.lit(0).cast("long")
    nodes = strings.limit(1).select(
        zero.alias("x"), root_key().alias("key"), zero.alias("p"), F.lit(None).cast("long").alias("rep"), zero.alias("f"), null.alias("handle"), null.alias("first")
    )
    nodes = stage(nodes)
    place = F.pmod(F.xxhash64("m"), F.lit(HASH_SPACE)) / HASH_SPACE
    since = 0.0
    for until in batches:
        last = until >= batches[-1]
        part = strings.where((place >= since) & (F.lit(True) if last else place < until))
        nodes = insert(nodes, part, paths)
        since = until
    return nodes


def statistics(nodes: DataFrame, strings: DataFrame, paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per extent ``key``: its smallest member ``owner``, ``n_convs``, ``n_children``, ``n_leaves``, ``base``; and ``(key, parent)``.

    A node at depth d of the edge saves ``base - (n_convs - 1) * (words above d)``: with W
    the words of a member's whole path and S those of the part it shares with a smaller
    member, base is the sum of ``(copies - 1) * W + S`` over the members but for the owner's S.
    """
    above = paths.select(F.col("m").alias("rep"), F.col("d").alias("p"), F.col("key").alias("_parent"))
    tree = nodes.where("x > 0").join(above, ["rep", "p"], "left").select("key", F.coalesce("_parent", root_key()).alias("parent"))
    tree = stage(tree)
    children = tree.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    on_path = paths.join(nodes.where("x > 0").select("key"), "key").select("m", "key", F.col("d").alias("x"), F.col("sum_words").alias("words"))
    root = strings.select("m", root_key().alias("key"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("words"))
    on_path = stage(on_path.unionByName(root))
    per_string = strings.join(children, "key", "left").select("m", "copies", F.col("n_children").isNull().cast("long").alias("leaf"))
    totals = on_path.groupBy("m").agg(F.max("words").alias("all_words")).join(per_string, "m")
    counted = on_path.join(totals, "m").groupBy("key").agg(
        F.min("m").alias("owner"), F.sum("copies").alias("n_convs"), F.sum("leaf").alias("n_leaves"), F.sum((F.col("copies") - 1) * F.col("all_words")).alias("repeats")
    )
    counted = stage(counted)
    # words of the part of a member's path whose nodes smaller ids own
    shared = on_path.join(counted.select("key", "owner"), "key").groupBy("m").agg(F.max(F.when(F.col("owner") != F.col("m"), F.col("words")).otherwise(0)).alias("shared"))
    shared = stage(shared)
    tails = on_path.join(shared, "m").groupBy("key").agg(F.sum("shared").alias("shared"))
    own = shared.select(F.col("m").alias("owner"), F.col("shared").alias("own"))
    base = F.col("repeats") + F.col("shared") - F.col("own")
    out = counted.join(tails, "key").join(own, "owner").join(children, "key", "left")
    return out.select("key", "owner", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", base.alias("base")), tree


def expand(nodes: DataFrame, stats: DataFrame, tree: DataFrame, paths: DataFrame) -> DataFrame:
    """One row per depth of every edge, and the root: the node columns with ``key``, the extent's key where the row is the extent."""
    owners = stats.select(F.col("key").alias("parent"), F.col("owner").alias("parent_owner"))
    edges = nodes.select("key", "x", "p").join(stats, "key").join(tree.join(owners, "parent").drop("parent"), "key", "left")
    rows = each_depth(edges.where("x > 0").withColumn("top", F.col("p") + 1), "top", "x")
    above = paths.select(F.col("m").alias("owner"), "d", (F.col("sum_words") - F.col("words")).alias("words_above"))
    deep = rows.join(above, ["owner", "d"])
    root = edges.where("x = 0").withColumns({"d": F.col("x"), "top": F.col("x"), "words_above": F.lit(0).cast("long")})
    extent = F.col("d") == F.col("x")
    return deep.unionByName(root.select(*deep.columns)).select(
        F.col("owner").alias("conv_id"), F.col("d").alias("depth"),
        F.when(F.col("d") == 0, F.lit(None).cast("long")).when(F.col("d") == F.col("top"), F.col("parent_owner")).otherwise(F.col("owner")).alias("parent_conv_id"),
        "n_convs", F.when(extent, F.col("n_children")).otherwise(1).cast("long").alias("n_children"), "n_leaves",
        (F.col("base") - (F.col("n_convs") - 1) * F.col("words_above")).cast("long").alias("saved_tokens"), F.when(extent, F.col("key")).alias("key"),
    )


def _hash_blocks(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of one node's blocks of ids, comma-joined, in their order."""
    digest, first = hashlib.sha256(), True
    for batch in batches:
        for ids in batch.column("ids").to_pylist():
            digest.update((ids if first else "," + ids).encode())
            first = False
    yield pa.RecordBatch.from_pydict({"key": pa.array([key[0].as_py()], pa.binary()), "ends_sha256": pa.array([digest.hexdigest()], pa.string())})


def end_digests(ends: DataFrame) -> DataFrame:
    """``(key, ends_sha256)`` of ``ends(conv_id, key)``: the ids of a node, ascending and comma-joined."""
    block = ends.withColumn("block", F.expr(f"conv_id div {CHUNK}")).groupBy("key", "block")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    blocks = stage(block.agg(ids.alias("ids")))
    several = blocks.groupBy("key").count().where("count > 1").select("key")
    one = blocks.join(several, "key", "left_anti").select("key", F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256"))
    # the local order of (key, block) satisfies the grouping, so that a node's blocks arrive in order
    ordered = blocks.join(several, "key", "left_semi").repartition("key").sortWithinPartitions("key", "block")
    return one.unionByName(ordered.groupBy("key").applyInArrow(_hash_blocks, "key binary, ends_sha256 string"))


def conversation_trie(turns: DataFrame, ids: DataFrame, batches: tuple[float, ...] = BATCHES) -> tuple[DataFrame, DataFrame]:
    """Nodes of the trie of ``turns(conv_id, at, a, b, words)`` and the z-fast trie itself; ``ids(conv_id)`` names all conversations.

    A node's own turn is the one at ``depth - 1`` of ``conv_id``.
    """
    prefixes = stage(prefix_keys(turns, ["words"]))
    strings, ends = distinct_strings(ids, prefixes)
    strings = stage(strings)
    paths = stage(prefixes.join(strings.select(F.col("m").alias("conv_id")), "conv_id", "left_semi").withColumnRenamed("conv_id", "m"))
    nodes = build(strings, paths, batches)
    stats, tree = statistics(nodes, strings, paths)
    empty = hashlib.sha256().hexdigest()
    rows = expand(nodes, stage(stats), tree, paths).join(end_digests(ends), "key", "left")
    return rows.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(empty))).drop("key"), nodes


def lean_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, at, a, b, words)`` of the rows with an id: places, hashes and word counts instead of texts."""
    role, text = text_of("role"), text_of("text")
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), *turn_hashes(role, text), word_count(text).alias("words"))
    return ordered_turns(rows)


def trie_digest(conversations: DataFrame, batches: tuple[float, ...] = BATCHES) -> DataFrame:
    """The trie of all rebuilt conversations, a row per node."""
    turns = stage(lean_turns(conversations))
    ids = turns.select("conv_id").distinct()
    return conversation_trie(rebuild(turns), ids, batches)[0]
