"""Operator 12: spelling variants by composing a vocabulary acceptor with a one-edit transducer.

The machine is ``A o E o A``: A is the minimised acceptor of the vocabulary, E copies
its input but for one inserted, deleted or replaced code point.  An accepted pair
leaves the common path exactly where its words first differ, so E edits only there and
every pair is found once.

The composition is cut by *initial states* of A.  A state is named by the prefix that
leads to it and holds the words below it; it begins as the start state with all words.
A state with more than ``STATE_CHARS`` code points does the edit arcs of its first fork
as a grouping (words equal without the code point at the fork: at most one per letter,
and the word that lacks it), then hands its words to the states one code point
further.  All others are enumerated in one task each: the words' minimised acceptor is
built from the sorted words, and a pair of states after the edit is followed only as far
as both accept the same rest, which is remembered per pair of states.  So no task holds
more than ``STATE_CHARS`` code points of vocabulary however skewed its prefixes are, and
no pair of words is compared.

Words longer than ``LONG`` take the same edits by hashes: each of their code points left
out once gives a 122-bit polynomial hash, rows that Spark groups.  Pairs of words of
which one is longer come from there only.

Words are counted whole: each task adds up its batches and Spark pre-aggregates before
the shuffle by word.  Forms are one aggregation over the pairs' both directions; roots
are pointer doubling, at most five rounds since each step multiplies n by ``RATIO``.

Defined results: a null text has no words; a null ``doc_id`` is hashed as an empty
string; repeated rows count each; texts and words of any length are taken whole; ties of
n go to the smaller word in code-point order; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.session import stage

MIN_LENGTH, MIN_COUNT = 7, 2
RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % MIN_LENGTH)  # a maximal run of fewer code points gives no word
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
DROP_EVERY = 31
STATE_CHARS, LONG = 100_000, 256
HELD_WORDS = 200_000
RATIO = 10
PRIMES, BASES = (2**61 - 1, 2**61 - 1), (1_000_003, 998_244_353)
PAIR = "a string, a_n long, b string, b_n long"


def words_of(doc_id: int | None, text: str) -> Counter:
    """Words of one text with their counts, after the rule that drops a code point of some runs."""
    lowered: Counter = Counter()
    for run, n in Counter(map(itemgetter(0), RUN.finditer(text))).items():
        lowered[run.lower() if run.isascii() else run.translate(LOWER)] += n
    out: Counter = Counter()
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in lowered.items():
        h = zlib.crc32(run.encode(), start)
        if h % DROP_EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < MIN_LENGTH:
                continue
        out[run] += n
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})
        held.clear()
        return batch

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if text.is_valid:
                held.update(words_of(doc_id, text.as_py()))
            if len(held) > HELD_WORDS:
                yield flush()
    yield flush()


def vocabulary(docs: DataFrame) -> DataFrame:
    """``(word, n)``: the words of at least ``MIN_LENGTH`` code points that occur ``MIN_COUNT`` times or more."""
    counted = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(_count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


class Acceptor:
    """Minimal acyclic acceptor of sorted distinct words: ``arcs[state]`` and ``final[state]``; 0 is the start."""

    def __init__(self, words: list[str]) -> None:
        self.arcs: list[dict[str, int]] = [{}]
        self.final = [False]
        self.rests: dict[tuple[int, int], list[str]] = {}
        known: dict[tuple, int] = {}
        path, last = [0], ""

        def freeze(depth: int) -> None:
            """Replace the states of the last word below ``depth`` by known ones with the same arcs."""
            while len(path) - 1 > depth:
                state = path.pop()
                same = known.setdefault((self.final[state], *self.arcs[state].items()), state)
                self.arcs[path[-1]][last[len(path) - 1]] = same

        for word in words:
            shared = next((i for i, (x, y) in enumerate(zip(last, word, strict=False)) if x != y), min(len(last), len(word)))
            freeze(shared)
            for c in word[shared:]:
                self.arcs.append({})
                self.final.append(False)
                self.arcs[path[-1]][c] = len(self.arcs) - 1
                path.append(len(self.arcs) - 1)
            self.final[path[-1]] = True
            last = word
        freeze(0)

    def common(self, s: int, t: int) -> list[str]:
        """Rests that both states accept; words are no longer than ``LONG``, so the recursion is shallow."""
        key = (s, t) if s < t else (t, s)
        found = self.rests.get(key)
        if found is None:
            found = [""] if self.final[s] and self.final[t] else []
            other = self.arcs[t]
            for c, x in self.arcs[s].items():
                y = other.get(c)
                if y is not None:
                    found += [c + rest for rest in self.common(x, y)]
            self.rests[key] = found
        return found

    def one_edit_pairs(self) -> Iterator[tuple[str, str]]:
        """Every unordered pair of accepted words at one edit, once: the first is the longer one, or the smaller one."""
        stack = [(0, "")]
        while stack:
            state, prefix = stack.pop()
            arcs = list(self.arcs[state].items())
            for i, (a, s) in enumerate(arcs):
                stack.append((s, prefix + a))
                if self.final[state] and self.final[s]:  # a is left out and nothing follows
                    yield prefix + a, prefix
                after = self.arcs[s]
                for j, (b, t) in enumerate(arcs):
                    if j > i:  # a is replaced by b
                        for rest in self.common(s, t):
                            yield prefix + a + rest, prefix + b + rest
                    if j != i and b in after:  # a is left out before b
                        for rest in self.common(after[b], t):
                            yield prefix + a + b + rest, prefix + b + rest


def _compose(table: pa.Table) -> pa.Table:
    n = dict(zip(table.column("word").to_pylist(), table.column("n").to_pylist(), strict=True))
    pairs = list(Acceptor(sorted(n)).one_edit_pairs()) if len(n) > 1 else []
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    values = {"a": pa.array(a, pa.string()), "a_n": pa.array([n[w] for w in a], pa.int64()), "b": pa.array(b, pa.string()), "b_n": pa.array([n[w] for w in b], pa.int64())}
    return pa.table(values)


def edits_at_fork(words: DataFrame) -> DataFrame:
    """Pairs of ``words(state, word, n, at)`` that share their state and first differ at index ``at``."""
    symbol = F.substring(F.col("word"), F.col("at") + 1, F.lit(1))
    without = F.concat(F.substring(F.col("word"), F.lit(1), F.col("at")), F.substring(F.col("word"), F.col("at") + 2, F.length("word")))
    row = F.struct("word", "n", symbol.alias("symbol")).alias("row")
    ways = [F.struct(key.alias("key"), F.lit(cut).alias("cut"), row) for key, cut in ((F.col("word"), False), (without, True))]
    both = words.select("state", F.explode(F.array(*ways)).alias("r"))
    rows = both.select("state", "r.key", "r.cut", "r.row").where("not cut or row.symbol <> ''")
    # at most one row a letter and the word itself
    groups = rows.groupBy("state", "key").agg(F.collect_list(F.struct("cut", "row")).alias("all")).where("size(all) > 1")
    pairs = groups.select("all", F.explode("all").alias("x")).where("x.cut").select(
        "x.row", F.explode(F.filter("all", lambda y: F.when(y["cut"], F.col("x.row.word") < y["row"]["word"]).otherwise(F.col("x.row.symbol") != y["row"]["symbol"]))).alias("y")
    )
    return pairs.select(F.col("row.word").alias("a"), F.col("row.n").alias("a_n"), F.col("y.row.word").alias("b"), F.col("y.row.n").alias("b_n"))


def short_pairs(vocab: DataFrame, state_chars: int) -> DataFrame:
    """One-edit pairs among words of at most ``LONG`` code points."""
    words, found = stage(vocab.select("word", "n", F.lit("").alias("state"))), []
    while True:
        sizes = words.groupBy("state").agg(F.sum(F.length("word")).alias("chars"), F.count(F.lit(1)).alias("k"), F.min("word").alias("lo"), F.max("word").alias("hi"))
        fork = F.length(F.regexp_extract(F.concat("lo", F.lit("\0"), "hi"), "^(.*).*\0\\1", 1))
        hot = stage(sizes.where((F.col("chars") > state_chars) & (F.col("k") > 1)).select("state", fork.alias("at")))
        if hot.isEmpty():
            break
        forked = words.join(hot, "state")
        found.append(stage(edits_at_fork(forked)))
        deeper = forked.where(F.length("word") > F.col("at")).select("word", "n", F.substring(F.col("word"), F.lit(1), F.col("at") + 1).alias("state"))
        words = stage(words.join(hot, "state", "left_anti").unionByName(deeper))
    pairs = words.groupBy("state").applyInArrow(_compose, PAIR)
    for part in found:
        pairs = pairs.unionByName(part)
    return pairs


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, at, x, y): the hash pair of each word whole (at = -1) and without each of its code points."""
    for batch in batches:
        for key, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist(), strict=True):
            columns = []
            for prime, base in zip(PRIMES, BASES, strict=True):
                before, after, power = [0], [0], [1]
                for c in word:
                    before.append((before[-1] * base + ord(c)) % prime)
                    power.append(power[-1] * base % prime)
                for i, c in enumerate(reversed(word)):
                    after.append((after[-1] + ord(c) * power[i]) % prime)
                size = len(word)
                columns.append([before[size], *((before[i] * power[size - 1 - i] + after[size - 1 - i]) % prime for i in range(size))])
            n = len(word) + 1
            for lo in range(0, n, 65_536):
                hi = min(n, lo + 65_536)
                yield pa.RecordBatch.from_pydict({"id": pa.array([key] * (hi - lo), pa.binary()), "at": pa.array(range(lo - 1, hi - 1), pa.int64()), "x": pa.array(columns[0][lo:hi], pa.int64()), "y": pa.array(columns[1][lo:hi], pa.int64())})


def long_pairs(vocab: DataFrame) -> DataFrame:
    """One-edit pairs of which at least one word has more than ``LONG`` code points."""
    words = stage(vocab.where(F.length("word") >= LONG).select("word", "n", F.unhex(F.md5(F.col("word").cast("binary"))).alias("id")))
    signs = words.select("id", "word").mapInArrow(_signatures, "id binary, at long, x long, y long")
    signs = stage(signs)
    cut, whole = signs.where("at >= 0"), signs.where("at < 0")
    replaced = cut.join(cut.withColumnRenamed("id", "other"), ["at", "x", "y"]).where("id < other").select("id", "other")
    left_out = cut.join(whole.select(F.col("id").alias("other"), "x", "y"), ["x", "y"]).select("id", "other")
    ids = replaced.union(left_out).distinct()
    a = words.select("id", F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = words.select(F.col("id").alias("other"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    pairs = ids.join(a, "id").join(b, "other").where((F.length("a") > LONG) | (F.length("b") > LONG))
    return pairs.select("a", "a_n", "b", "b_n")


def near_pairs(vocab: DataFrame, state_chars: int = STATE_CHARS) -> DataFrame:
    """Every unordered pair of ``vocab(word, n)`` at exactly one edit, once: ``a, a_n, b, b_n``."""
    return short_pairs(vocab.where(F.length("word") <= LONG), state_chars).unionByName(long_pairs(vocab))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for ``forms(word, form)``: the last word reached by following forms."""
    current = stage(forms.select("word", F.col("form").alias("root")))
    while True:
        step = current.join(current.select(F.col("word").alias("root"), F.col("root").alias("_next")), "root", "left")
        moved = stage(step.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")))
        current = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return current


def spelling_variants(vocab: DataFrame, state_chars: int = STATE_CHARS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for ``vocab(word, n)``."""
    vocab = stage(vocab)
    pairs = near_pairs(vocab, state_chars)
    ways = [F.struct(F.col(x).alias("word"), F.col(y).alias("near"), F.col(f"{y}_n").alias("near_n")) for x, y in ("ab", "ba")]
    near = pairs.select(F.explode(F.array(*ways)).alias("w")).select("w.*").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best")
    )
    joined = vocab.join(near, "word", "left").withColumn("best_n", -F.col("best.minus"))
    has = F.col("best_n") >= RATIO * F.col("n")
    judged = stage(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best.near")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")))
    ends = roots(judged.where("form is not null"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variant_digest(docs: DataFrame) -> DataFrame:
    """Spelling variants of all words of ``docs(doc_id, text)``."""
    return spelling_variants(vocabulary(docs))
