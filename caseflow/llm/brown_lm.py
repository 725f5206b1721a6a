"""Operator 2: language-model scores from Brown classes.

The model is a class bigram: ``P(w | history) = P(class(w) | class before) *
P(w | class(w))``.  Classes come from exchange clustering, which moves one unit at a
time to the class that gives the training text the largest likelihood.  Units are
the ``TOP_WORDS`` most frequent words and ``SUFFIXES`` groups of all other words by
their last three bytes, so the bigram
table that is clustered has a fixed bound, ``(TOP_WORDS + SUFFIXES + 1) ** 2``.
Every other word of the broadcast tier, at most ``TIER_WORDS``, then gets a class of its own
contexts: Spark counts the classes before and after it, and it goes where the likelihood
of its bigrams and of itself in the class is largest.  Only words outside the tier, the rarest
and unseen ones, keep the class of their suffix group.
Emission is per word, from counts of all training words:
``(c + 0.5) / (N_class + 0.5 * (V_class + 1))``; the last 1 is the class's unknown
word.  Transitions are counted over the final classes and smoothed towards the class frequencies.

Plan: (A) words of the training rows are counted in the tasks and summed by Spark
(this table grows with the corpus and stays distributed); all texts are looked up in the
tier once and staged as codes, which the later steps read; (B) unit bigrams are
counted in fixed arrays; (C) tier words meet their neighbours' classes, in rows that Spark
sums by word; (D) class bigrams are counted in fixed arrays; (E) all rows are scored.  A word's count is looked up in two
tiers: words that occur often, at most ``TIER_WORDS`` short ones, are broadcast; the
others leave the task as (row, word, number) and meet the word table in a join.
The base score needs the same sums, so it costs nothing more.

Defined results: null and empty texts are one end token; rows with a null id are
split as if their id were the empty text; repeated rows get equal scores; ties
in clustering go to the lower class; an empty table gives no rows, and without any
training row all words are unknown and scores stay finite.  Only id and text are read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import utf8, words_of
from caseflow.session import stage

TOP_WORDS, SUFFIXES, CLASSES = 1024, 1024, 64
UNITS = TOP_WORDS + SUFFIXES
EDGE = UNITS  # the unit before the first and after the last word
TIER_WORDS, TIER_BYTES = 200_000, 64
SWEEPS = 12
ALPHA = 8.0  # weight of the class frequencies in a transition
FLUSH_WORDS, FLUSH_BYTES = 400_000, 16_000_000
FLUSH_PAIRS = 2_000_000
CODED_ROWS = 1000


def is_held_out(id_col: str) -> F.Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1


def count_words(train: DataFrame) -> DataFrame:
    """``(word binary, n long)`` of the training rows ``(_text binary)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        size = 0

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for value in batch.column(0):
                data = value.as_py()
                held.update(words_of(data))
                size += len(data)
                if len(held) >= FLUSH_WORDS or (size >= FLUSH_BYTES and len(held) >= FLUSH_WORDS // 2):
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return train.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(words: DataFrame) -> list[tuple[bytes, int]]:
    """At most ``TIER_WORDS`` short words, the most frequent: all words above a count that is found from a histogram."""
    short = words.where(F.octet_length("word") <= TIER_BYTES)
    bins = short.groupBy(F.floor(F.log2("n") * 16).cast("int").alias("b")).agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("lo")).collect()
    least, total = None, 0
    for r in sorted(bins, key=lambda r: -r["b"]):
        total += r["k"]
        if total > TIER_WORDS:
            break
        least = r["lo"]
    if least is None:
        return []
    found = short.where(F.col("n") >= least).select("word", "n").toArrow()
    pairs = zip(found.column(0).to_pylist(), found.column(1).to_pylist(), strict=True)
    return sorted(pairs, key=lambda p: (-p[1], p[0]))


def suffix_unit(word: bytes) -> int:
    return TOP_WORDS + zlib.crc32(word[-3:]) % SUFFIXES


def units_of(frequent: list[tuple[bytes, int]]) -> np.ndarray:
    """The unit of every word of the tier."""
    return np.array([i if i < TOP_WORDS else suffix_unit(w) for i, (w, _) in enumerate(frequent)], np.int32)


class Coder:
    """Words as codes: the index in the broadcast tier, or ``-1 - s`` for a word of suffix group s outside it."""

    def __init__(self, frequent: list[tuple[bytes, int]]):
        self.index = {w: i for i, (w, _) in enumerate(frequent)}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        get = self.index.get
        at = np.fromiter((get(w, -1) for w in words), np.int32, len(words))
        for i in np.flatnonzero(at < 0):
            at[i] = TOP_WORDS - 1 - suffix_unit(words[i])
        return at


def by_code(of_tier: np.ndarray, of_units: np.ndarray) -> np.ndarray:
    """Table that holds at ``code + SUFFIXES`` the unit or class of a coded word."""
    return np.concatenate([of_units[TOP_WORDS:UNITS][::-1], of_tier]).astype(np.int32)


def code_rows(rows: DataFrame, frequent) -> DataFrame:
    """Every text as codes, with the words outside the tier and their numbers in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(frequent.value)
        for batch in (whole.slice(lo, CODED_ROWS) for whole in batches for lo in range(0, whole.num_rows, CODED_ROWS)):
            n_tokens, codes, ends, outside, numbers = [], [], [0], [], []
            for value in batch.column(3):
                words = words_of(value.as_py())
                at = coder(words)
                misses = Counter(words[i] for i in np.flatnonzero(at < 0))
                n_tokens.append(len(words) + 1)
                codes.append(at.tobytes())
                outside += misses
                numbers += misses.values()
                ends.append(len(outside))
            pairs = pa.StructArray.from_arrays([pa.array(outside, pa.binary()), pa.array(numbers, pa.int32())], names=["word", "k"])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array(n_tokens, pa.int64()), pa.array(codes, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)],
                names=["_row", "doc_id", "held_out", "n_tokens", "_codes", "_missing"],
            )

    return rows.mapInArrow(run, "_row long, doc_id long, held_out boolean, n_tokens long, _codes binary, _missing array<struct<word binary, k int>>")


def codes_in(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_py(), np.int32)


def path_of(codes: np.ndarray, table: np.ndarray, edge: int) -> np.ndarray:
    """Units or classes of a coded text between two edges."""
    path = np.full(len(codes) + 2, edge, np.int64)
    path[1:-1] = table[codes + SUFFIXES]
    return path


def count_pairs(train: DataFrame, shared) -> DataFrame:
    """``(pair int, n long)``: unit bigrams of the training rows ``(_codes)``, pair = before * (UNITS + 1) + unit."""
    size = (UNITS + 1) ** 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, n = np.zeros(size, np.int64), [], 0
        for batch in batches:
            for value in batch.column(0):
                path = path_of(codes_in(value), shared.value, EDGE)
                held.append(path[:-1] * (UNITS + 1) + path[1:])
                n += len(path) - 1
                if n >= FLUSH_PAIRS:
                    total += np.bincount(np.concatenate(held), minlength=size)
                    held, n = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["pair", "n"])

    return train.mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _phi(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of every unit (the edge has class ``classes``), by exchange clustering.

    ``pairs``: counts of unit after unit.  A sweep takes the units by falling
    frequency out of their class and puts each where the class bigram likelihood
    ``sum phi(N(c, c')) - sum phi(N(c, .)) - sum phi(N(., c))`` is largest.
    """
    n_units = len(pairs) - 1
    freq = pairs.sum(axis=0)
    order = np.argsort(-freq[:n_units], kind="stable")
    of = np.full(n_units + 1, classes)
    of[order] = np.arange(n_units) % classes
    member = np.zeros((n_units + 1, classes + 1))
    member[np.arange(n_units + 1), of] = 1.0
    after, before = pairs @ member, pairs.T @ member  # unit -> class after it / before it
    table = member.T @ after
    k = np.arange(classes)
    for _ in range(sweeps):
        moved = 0
        for w in order:
            if freq[w] == 0:
                break
            a, c0, own = after[w].copy(), of[w], pairs[w, w]
            b = before[w].copy()
            a[c0] -= own
            b[c0] -= own
            table[c0] -= a
            table[:, c0] -= b
            table[c0, c0] -= own
            out, into = table.sum(axis=1) + b, table.sum(axis=0) + a  # as they are wherever w goes
            n_out, n_in = a.sum() + own, b.sum() + own
            row = (_phi(table + a) - _phi(table)).sum(axis=1)[:classes]
            col = (_phi(table + b[:, None]) - _phi(table)).sum(axis=0)[:classes]
            d = table[k, k]
            corner = _phi(d + a[:classes] + b[:classes] + own) - _phi(d) - (_phi(d + a[:classes]) - _phi(d)) - (_phi(d + b[:classes]) - _phi(d))
            gain = row + col + corner - (_phi(out + n_out) - _phi(out))[:classes] - (_phi(into + n_in) - _phi(into))[:classes]
            c1 = c0 if gain[c0] >= gain.max() - 1e-9 else int(gain.argmax())
            table[c1] += a
            table[:, c1] += b
            table[c1, c1] += own
            if c1 != c0:
                moved += 1
                of[w] = c1
                after[:, c0] -= pairs[:, w]
                after[:, c1] += pairs[:, w]
                before[:, c0] -= pairs[w]
                before[:, c1] += pairs[w]
        if moved <= n_units // 200:
            break
    return of


def count_neighbours(train: DataFrame, shared) -> DataFrame:
    """``(word int, side int, n long)``: how often a tier word outside the top has each class before it (side 0 to ``CLASSES``) and after it (from ``CLASSES + 1``)."""
    sides = 2 * (CLASSES + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            codes, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(codes // sides, pa.int32()), pa.array(codes % sides, pa.int32()), pa.array(counts, pa.int64())], names=["word", "side", "n"])

        for batch in batches:
            for value in batch.column(0):
                at = codes_in(value)
                path = path_of(at, shared.value, CLASSES)
                rare = np.flatnonzero(at >= TOP_WORDS)
                word = at[rare].astype(np.int64) * sides
                held += [word + path[rare], word + path[rare + 2] + CLASSES + 1]
                n += 2 * len(rare)
                if n >= FLUSH_PAIRS:
                    yield flush()
                    n = 0
        if held:
            yield flush()

    return train.mapInArrow(run, "word int, side int, n long").groupBy("word", "side").agg(F.sum("n").alias("n"))


def classes_of_words(neighbours: DataFrame, step: np.ndarray, tokens: np.ndarray) -> DataFrame:
    """``(word int, class int)``: the class with the largest log-likelihood of the word's bigrams and emissions; ties to the lower one."""
    to, size = step[:, :CLASSES], np.log10(np.maximum(tokens[:CLASSES], 1.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides, n = (batch.column(c) for c in ("sides", "ns"))
            rows = np.repeat(np.arange(batch.num_rows), np.diff(sides.offsets.to_numpy()))
            table = np.zeros((batch.num_rows, 2 * (CLASSES + 1)))
            table[rows, sides.flatten().to_numpy()] = n.flatten().to_numpy()
            before, after = table[:, : CLASSES + 1], table[:, CLASSES + 1 :]
            gain = before @ to + after @ step[:CLASSES].T - before.sum(axis=1, keepdims=True) * size
            best = (gain >= gain.max(axis=1, keepdims=True) - 1e-9).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(best, pa.int32())], names=["word", "class"])

    lists = neighbours.groupBy("word").agg(F.collect_list(F.struct("side", "n")).alias("l"))  # at most one entry a side
    return lists.select("word", F.col("l.side").alias("sides"), F.col("l.n").alias("ns")).mapInArrow(run, "word int, class int")


def count_class_pairs(train: DataFrame, shared) -> np.ndarray:
    """Counts of class after class over the training rows; the edge is the last class."""
    size = (CLASSES + 1) ** 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for value in batch.column(0):
                path = path_of(codes_in(value), shared.value, CLASSES)
                total += np.bincount(path[:-1] * (CLASSES + 1) + path[1:], minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total)], names=["pair", "n"])

    table = np.zeros(size)
    for r in train.mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        table[r["pair"]] = r["n"]
    return table.reshape(CLASSES + 1, CLASSES + 1)


def class_sizes(words: DataFrame, frequent, shared) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and distinct words of each class, over the whole word table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(frequent.value)
        n, v = np.zeros(CLASSES + 1, np.int64), np.zeros(CLASSES + 1, np.int64)
        for batch in batches:
            c = shared.value[coder(batch.column(0).to_pylist()) + SUFFIXES]
            np.add.at(n, c, batch.column(1).to_numpy())
            np.add.at(v, c, 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES + 1), pa.int32()), pa.array(n), pa.array(v)], names=["c", "n", "v"])

    sums = words.select("word", "n").mapInArrow(run, "c int, n long, v long").groupBy("c").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    tokens, kinds = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    for r in sums:
        tokens[r["c"]], kinds[r["c"]] = r["n"], r["v"]
    return tokens, kinds


def class_table(pairs: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Counts of class after class from those of unit after unit."""
    member = np.zeros((len(of), CLASSES + 1))
    member[np.arange(len(of)), of] = 1.0
    return member.T @ pairs @ member


def transitions(table: np.ndarray) -> np.ndarray:
    """log10 P(class | class before), smoothed towards the class frequencies."""
    share = (table.sum(axis=0) + 1.0) / (table.sum() + CLASSES + 1)
    return np.log10((table + ALPHA * share) / (table.sum(axis=1, keepdims=True) + ALPHA))


def score_rows(coded: DataFrame, shared) -> DataFrame:
    """Local parts of the scores: what the tier and the classes say."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, counts, step, emit, n_train = shared.value
        log_count = np.log10(counts + 0.5)
        for batch in batches:
            n_known, known_log, class_log = [], [], []
            for value in batch.column(4):
                codes = codes_in(value)
                path = path_of(codes, classes, CLASSES)
                hits = codes[codes >= 0]
                n_known.append(len(hits) + (n_train > 0))
                known_log.append(float(log_count[hits].sum()))
                class_log.append(float(step[path[:-1], path[1:]].sum() - emit[path[1:-1]].sum()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(4)), pa.array(n_known, pa.int64()), pa.array(known_log, pa.float64()), pa.array(class_log, pa.float64())],
                names=["_row", "doc_id", "held_out", "n_tokens", "_known", "_log", "_class"],
            )

    rows = coded.select("_row", "doc_id", "held_out", "n_tokens", "_codes")
    return rows.mapInArrow(run, "_row long, doc_id long, held_out boolean, n_tokens long, _known long, _log double, _class double")


def lm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row."""
    spark = df.sparkSession
    rows = df.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("doc_id"), is_held_out(id_col).alias("held_out"), utf8(text_col).alias("_text"))
    train = rows.where(~F.col("held_out")).select("_text")
    words = stage(count_words(train))
    n_train = df.where(~is_held_out(id_col)).select(id_col).count()
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_all, n_kinds = total["n"] + n_train, total["v"] + (n_train > 0)

    tier = frequent_words(words)
    frequent = spark.sparkContext.broadcast(tier)
    coded = stage(code_rows(rows, frequent))
    train = coded.where(~F.col("held_out")).select("_codes")
    unit, share = units_of(tier), spark.sparkContext.broadcast
    found = count_pairs(train, share(by_code(unit, np.arange(UNITS + 1)))).toArrow()
    pairs = np.zeros((UNITS + 1) ** 2)
    for batch in found.to_batches():
        pairs[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    del found
    pairs = pairs.reshape(UNITS + 1, UNITS + 1)
    of = exchange(pairs)
    table = class_table(pairs, of)
    # classes of the tier's other words, from their own contexts
    own = of[unit]
    first = share(by_code(own, of))
    for r in classes_of_words(count_neighbours(train, first), transitions(table), table.sum(axis=0)).toLocalIterator():
        own[r["word"]] = r["class"]
    classed = share(by_code(own, of))
    tokens, kinds = class_sizes(words, frequent, classed)
    counts = np.array([n for _, n in tier] or [0], np.int64)
    scored = score_rows(coded, share((classed.value, counts, transitions(count_class_pairs(train, classed)), np.log10(tokens + 0.5 * (kinds + 1)), n_train)))

    missing = coded.select("_row", F.inline("_missing"))
    looked_up = missing.join(words, "word", "left").groupBy("_row").agg(
        F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("_log2"), F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("_known2")
    )
    joined = scored.join(looked_up, "_row", "left")
    words_log = F.col("_log") + F.coalesce("_log2", F.lit(0.0))
    per_token = math.log10(n_all + 0.5 * (n_kinds + 1))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("_known") + F.coalesce("_known2", F.lit(0))).cast("long").alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"),
        (words_log + math.log10(n_train + 0.5) - F.col("n_tokens") * per_token).alias("base_score"), (words_log + F.col("_class")).alias("score"),
    )
