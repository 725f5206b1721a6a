"""Operator 8: near-duplicates by SetSketch registers.

A document's set holds its distinct 5-word shingles (a text with fewer words is
one shingle).  Each of ``REGISTERS`` registers keeps the smallest of the
exponentially distributed values that its hash gives the shingles, on the
exponentially spaced scale ``K = clip(floor(1 - log_b x), 0, q + 1)``.  Sketches
merge by the larger register (:func:`merge_registers`) and equal registers are as
likely as the sets are similar.

1. One Arrow pass makes a lean row per document: set size, a 128-bit fingerprint
   of the set, the registers.  Documents with equal fingerprints have equal sets;
   they collapse into one class, so exact copies never meet pairwise.
2. Bands of :func:`band_rows` registers each put classes into buckets, so that a pair
   at the limit (0.85 unless given) shares no bucket with a probability of at most
   ``MISS``.
3. First round: each member of a bucket against one pivot of the bucket, a number
   of pairs linear in the bucket.  A pair is first judged by the likelihood of
   its similarity given the registers and the two set sizes; if the limit is
   ``LLR_LIMIT`` below the best similarity the pair is dropped (five standard
   deviations); otherwise its full sets are compared.
4. Second round, for the links that the pivots cannot show: buckets of three or
   more classes that still span several components.  Buckets are cut into blocks,
   and pairs of blocks are compared inside tasks by their registers, then by
   their full sets, skipping pairs that are connected already.  A task returns a
   spanning forest of its links, so no group emits its pairs, and none is lost.
5. Connected components over the links; the smallest id is the component's.

Full sets are made again from the texts of the classes that share a bucket only.

Defined results: null, empty and blank texts have an empty set, size 0, and are
linked with nothing; repeated rows share their component, and both are kept if
their id is the smallest; a null id has a null component id unless its component
has another member, and ``kept`` is true only where id and component id are
equal or both null.  Ties need no rule (the smallest id decides).  Extra columns
are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import utf8, words_of
from caseflow.llm.components import components
from caseflow.session import stage

SHINGLE_WORDS = 5
REGISTERS = 144
MISS = 2e-5  # of pairs at the limit
BASE, RATE, LIMIT_Q = 1.001, 20.0, 65_534  # b, a and q of the sketch
SIMILAR_NUM, SIMILAR_DEN = 85, 100  # linked if 100 * intersection >= 85 * union, unless another number is given
LLR_LIMIT = 12.5
BLOCK = 1024  # classes of a bucket that one task side holds
CHUNK_SHINGLES = 1 << 15

_ODD = np.random.default_rng(20_260_101).integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MASK = np.random.default_rng(20_260_102).integers(0, 2**63, REGISTERS, dtype=np.uint64)
_PLACE = np.random.default_rng(20_260_103).integers(0, 2**63, SHINGLE_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_rows(num: int) -> int:
    """The most registers a band may have so that pairs at the limit are missed with ``MISS`` at most."""
    limit = num / SIMILAR_DEN
    return max((n for n in range(1, REGISTERS + 1) if (1 - limit**n) ** (REGISTERS // n) <= MISS), default=1)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingles(data: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = words_of(data)
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SHINGLE_WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    h = np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)
    n = len(h) - SHINGLE_WORDS + 1
    total = np.zeros(n, np.uint64)
    for i in range(SHINGLE_WORDS):
        total = mix(total + h[i : i + n] * _PLACE[i])
    return np.unique(total)


def minima(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Smallest value per register (columns) and per run of hashes (rows)."""
    out = np.empty((len(starts), REGISTERS), np.uint64)
    for j in range(REGISTERS):
        out[:, j] = np.minimum.reduceat((hashes ^ _MASK[j]) * _ODD[j], starts)
    return out


def registers_of(least: np.ndarray) -> np.ndarray:
    """SetSketch registers from the smallest hash values."""
    u = (least.astype(np.float64) + 1.0) / 2.0**64
    x = -np.log1p(-np.minimum(u, 1 - 2.0**-53)) / RATE
    k = np.floor(1.0 - np.log(x) / np.log(BASE))
    return np.clip(k, 0, LIMIT_Q + 1).astype(np.uint16)


def sketch_many(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of several nonempty sets, a bounded number of shingles at a time."""
    out = np.full((len(sets), REGISTERS), np.iinfo(np.uint64).max, np.uint64)
    run: list[tuple[int, np.ndarray]] = []
    size = 0

    def flush() -> None:
        if run:
            starts = np.cumsum([0, *(len(p) for _, p in run[:-1])])
            found = minima(np.concatenate([p for _, p in run]), starts)
            for (i, _), row in zip(run, found, strict=True):
                np.minimum(out[i], row, out=out[i])
            run.clear()

    for i, s in enumerate(sets):
        for a in range(0, len(s), CHUNK_SHINGLES):
            piece = s[a : a + CHUNK_SHINGLES]
            run.append((i, piece))
            size += len(piece)
            if size >= CHUNK_SHINGLES:
                flush()
                size = 0
    flush()
    return registers_of(out)


def merge_registers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log(np.clip(1.0 - x * (BASE - 1.0) / BASE, 1e-300, 1.0)) / np.log(BASE)


def plausible(larger: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, num: int = SIMILAR_NUM) -> np.ndarray:
    """Whether a similarity of ``num`` percent or more fits the registers.

    ``larger``/``smaller``: how many registers of the first set are larger or
    smaller.  Compares the log-likelihood at its best similarity with the best
    one from the limit up.
    """
    n_a, n_b = n_a.astype(float), n_b.astype(float)
    u = (n_a / (n_a + n_b))[:, None]
    v = 1.0 - u
    grid = np.linspace(0.0, 1.0, 101)[None, :] * np.minimum(u / v, v / u)
    up, down = _p(u - v * grid), _p(v - u * grid)
    same = np.clip(1.0 - up - down, 1e-12, 1.0)
    equal = (REGISTERS - larger - smaller)[:, None]
    ll = larger[:, None] * np.log(np.clip(up, 1e-12, 1.0)) + smaller[:, None] * np.log(np.clip(down, 1e-12, 1.0)) + equal * np.log(same)
    limit = num / SIMILAR_DEN
    above = np.where(grid >= limit - 0.01, ll, -np.inf).max(axis=1)
    return np.isfinite(above) & (ll.max(axis=1) - above <= LLR_LIMIT)


def similar(a: np.ndarray, b: np.ndarray, num: int = SIMILAR_NUM) -> bool:
    """The exact rule on two sorted distinct arrays."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if SIMILAR_DEN * len(small) < num * len(large):
        return False
    at = np.searchsorted(large, small)
    common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return SIMILAR_DEN * common >= num * (len(a) + len(b) - common)


def sketch_documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(_row, _key, doc_id, n_shingles, fp, regs)`` for every row; fp and regs are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, fps, regs = [], [], []
            todo: list[np.ndarray] = []
            where: list[int] = []
            size = 0

            def flush() -> None:
                if todo:
                    for i, row in zip(where, sketch_many(todo), strict=True):
                        regs[i] = row.astype(">u2").tobytes()
                    todo.clear()
                    where.clear()

            for value in batch.column(3):
                s = shingles(value.as_py())
                n.append(len(s))
                regs.append(None)
                fps.append(xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None)
                if len(s):
                    todo.append(s)
                    where.append(len(regs) - 1)
                    size += len(s)
                if size >= 8 * CHUNK_SHINGLES:
                    flush()
                    size = 0
            flush()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array(n, pa.int64()), pa.array(fps, pa.string()), pa.array(regs, pa.binary())],
                names=["_row", "_key", "doc_id", "n_shingles", "fp", "regs"],
            )

    rows = df.select(F.monotonically_increasing_id().alias("_row"), F.xxhash64(text_col).alias("_key"), F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("_text"))
    return rows.mapInArrow(run, "_row long, _key long, doc_id long, n_shingles long, fp string, regs binary")


def bucket_members(classes: DataFrame, num: int = SIMILAR_NUM) -> DataFrame:
    """``(key, node, size, pivot)`` for the buckets that hold two or more classes."""
    rows = band_rows(num)
    bands = F.sequence(F.lit(0), F.lit(REGISTERS // rows - 1))
    part = lambda b: F.substring(F.col("regs"), b * 2 * rows + 1, F.lit(2 * rows))
    keys = F.transform(bands, lambda b: F.xxhash64(b, part(b)))
    members = classes.select("node", F.explode(keys).alias("key"))
    # the pivot is the smallest node in an order that differs from bucket to bucket
    turned = F.col("node").bitwiseXOR(F.col("key").bitwiseAND(F.lit(2**62 - 1)))
    buckets = members.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min(turned).alias("m")).where("size > 1")
    return members.join(buckets, "key").select("key", "node", "size", F.col("m").bitwiseXOR(F.col("key").bitwiseAND(F.lit(2**62 - 1))).alias("pivot"))


def full_sets(df: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(node, regs, set)`` with the full shingle set of the wanted classes ``(node, doc_id, fp, regs)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, regs, sets = [], [], []
            for node, fp, reg, text in zip(*(batch.column(i) for i in range(4)), strict=True):
                s = shingles(text.as_py())
                if len(s) and xxhash.xxh3_128_hexdigest(s.tobytes()) == fp.as_py():  # else another text with the same id
                    nodes.append(node.as_py())
                    regs.append(reg.as_py())
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(regs, pa.binary()), pa.array(sets, pa.binary())], names=["node", "regs", "set"])

    texts = df.select(F.col(id_col).cast("long").alias("_id"), utf8(text_col).alias("_text"))
    found = texts.join(wanted, F.col("_id").eqNullSafe(F.col("doc_id"))).select("node", "fp", "regs", "_text")
    return found.mapInArrow(run, "node long, regs binary, set binary").dropDuplicates(["node"])


def _registers(values) -> np.ndarray:
    return np.frombuffer(b"".join(values), ">u2").reshape(-1, REGISTERS).astype(np.uint16)


def verified(pairs: DataFrame, num: int = SIMILAR_NUM) -> DataFrame:
    """Of ``(a, b, regs_a, set_a, regs_b, set_b)``, the linked ``(a, b)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                a, b, ra, sa, rb, sb = (part.column(i).to_pylist() for i in range(6))
                x, y = _registers(ra), _registers(rb)
                na, nb = (np.array([len(s) // 8 for s in side]) for side in (sa, sb))
                fits = plausible((x > y).sum(axis=1), (x < y).sum(axis=1), na, nb, num)
                ok = [i for i in np.flatnonzero(fits) if similar(np.frombuffer(sa[i], np.uint64), np.frombuffer(sb[i], np.uint64), num)]
                yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in ok], pa.int64()), pa.array([b[i] for i in ok], pa.int64())], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


class Forest:
    """Union-find over the nodes of one task."""

    def __init__(self):
        self.up: dict = {}

    def root(self, x):
        while (p := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(p, p)
        return x

    def join(self, x, y) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[x] = y
        return x != y


def block_links(nodes: list[int], labels: list[int], sides: list[int], regs: list[bytes], sets: list[bytes], num: int = SIMILAR_NUM) -> list[tuple[int, int]]:
    """A spanning forest of the links between the two sides of a block pair.

    Side 0 and side 1 are compared with each other; a single block (all sides 0)
    with itself.  ``labels`` are components known so far.
    """
    left = [i for i, s in enumerate(sides) if s == 0]
    right = [i for i, s in enumerate(sides) if s == 1] or left
    if not left:
        return []
    r = _registers(regs)
    n = np.array([len(s) // 8 for s in sets])
    lab = np.array(labels)
    arrays = [np.frombuffer(s, np.uint64) for s in sets]
    forest, out = Forest(), []
    rr, rn, rl = r[right], n[right], lab[right]
    limit = num / SIMILAR_DEN
    least_equal = int(REGISTERS * limit - 5 * np.sqrt(REGISTERS * limit * (1 - limit))) - 1
    for i in left:
        differ = rl != lab[i]
        if right is left:
            differ &= np.array(right) > i
        candidates = np.flatnonzero(differ & (SIMILAR_DEN * np.minimum(rn, n[i]) >= num * np.maximum(rn, n[i])))
        if not len(candidates):
            continue
        equal = (rr[candidates] == r[i]).sum(axis=1)
        candidates, equal = candidates[equal >= least_equal], equal[equal >= least_equal]
        if not len(candidates):
            continue
        side = rr[candidates]
        fits = plausible((r[i] > side).sum(axis=1), (r[i] < side).sum(axis=1), np.full(len(candidates), n[i]), rn[candidates], num)
        for j in candidates[fits][np.argsort(-equal[fits], kind="stable")]:
            k = right[j]
            if forest.root(labels[i]) != forest.root(labels[k]) and similar(arrays[i], arrays[k], num):
                forest.join(labels[i], labels[k])
                out.append((nodes[i], nodes[k]))
    return out


def linked_in_blocks(members: DataFrame, num: int = SIMILAR_NUM) -> DataFrame:
    """Links inside buckets; rows ``(key, blocks, block, node, label, regs, set)``."""
    # a block meets itself (i, i) and every other block once (i < j)
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    rows = members.select("*", F.explode(others).alias("o")).select(
        "key", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"),
        F.when(F.col("block") > F.col("o"), 1).otherwise(0).alias("side"), "node", "label", "regs", "set",
    )
    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []

        def links() -> pa.RecordBatch:
            _, _, _, side, node, label, regs, sets = zip(*held, strict=True)
            found = block_links(list(node), list(label), list(side), list(regs), list(sets), num) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

        for batch in batches:
            for row in zip(*(batch.column(k) for k in range(8)), strict=True):
                row = tuple(x.as_py() for x in row)
                if row[:3] != group and held:
                    yield links()
                    held = []
                group = row[:3]
                held.append(row)
        if held:
            yield links()

    return dealt.mapInArrow(run, "a long, b long")


def links_between_classes(df: DataFrame, classes: DataFrame, id_col: str, text_col: str, num: int = SIMILAR_NUM) -> DataFrame:
    """Links that connect the classes ``(node, doc_id, fp, regs)``, one spanning set of them."""
    members = stage(bucket_members(classes, num))
    wanted = classes.join(members.select("node").distinct(), "node").select("node", "doc_id", "fp", "regs")
    sets = stage(full_sets(df, wanted, id_col, text_col))

    pairs = members.where("node <> pivot").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    side = lambda x: sets.select(F.col("node").alias(x), F.col("regs").alias(f"regs_{x}"), F.col("set").alias(f"set_{x}"))
    with_sets = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "regs_a", "set_a", "regs_b", "set_b")
    first = stage(verified(with_sets, num))

    labels = stage(components(first))
    left = members.where("size > 2").join(labels, "node", "left").select("key", "node", "size", F.coalesce("component", "node").alias("label"))
    open_keys = left.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
    todo = left.join(open_keys, "key").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    todo = todo.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    second = linked_in_blocks(todo.join(sets, "node").select("key", "blocks", "block", "node", "label", "regs", "set"), num)
    return first.union(second)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = SIMILAR_NUM) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept, _row, _key)`` for every row of ``df``; ``_key`` is a hash of its text.

    Documents are linked from a similarity of ``num`` percent up.
    """
    rows = stage(sketch_documents(df, id_col, text_col))
    by_set = rows.where("fp is not null").groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.first("regs").alias("regs"))
    classes = stage(by_set.select(F.monotonically_increasing_id().alias("node"), "*"))
    reached = components(links_between_classes(df, classes, id_col, text_col, num))
    named = classes.select("fp", "node", "doc_id").join(reached, "node", "left").withColumn("c", F.coalesce("component", "node"))
    least = named.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    by_fp = named.join(least, "c").select("fp", "component_id")
    out = rows.drop("regs").join(by_fp, "fp", "left")
    component = F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "_row", "_key")
