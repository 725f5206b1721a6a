"""Operator 10: benchmark decontamination by latent semantic retrieval.

1. Items are cut into passages of at most ``WINDOW`` words, one every ``WINDOW / 2`` words,
   so that a long item is sought by passages as long as the windows of the texts.
2. Terms are the words of the benchmark items, so the term space is bounded by
   the benchmark.  One reading of all documents counts their document frequencies and
   stages each document's words as numbers of terms; all later steps read those.
3. A randomised SVD of TF-IDF passages (all items' and all windows of all documents)
   gives a latent space of at most ``RANK`` dimensions.  One reading of the numbers sums
   ``A' A`` over the windows, ``HELD_CELLS`` of it at a time in a task, one task per core, so
   what is shuffled grows with the benchmark and not with the documents.  Spark multiplies
   the staged sums for each power iteration, the driver only orthonormalises a (terms x
   rank) matrix.  The windows of a large corpus have the joint weight of ``FIT_WINDOWS``,
   so that the space holds the items whatever the size of the corpus.
4. Every document is cut into windows of ``WINDOW`` words, every ``WINDOW / 2`` words,
   and each window's latent vector is compared with those of all passages; cosines
   from ``MIN_COSINE`` up are candidates, and so are windows that hold ``MIN_PART`` of a
   passage, whatever else they hold: there the cosine is taken relative to the passage's
   length and not to the window's.  There is no cap on candidates.
5. A candidate is checked where the whole item would lie around it: the
   longest common subsequence of words covers at least ``COPY_SHARE`` of the item (a
   copy), or the one of its rarer words covers ``PARAPHRASE_SHARE`` of them and the
   item's answer, its last sentence, is there too (a paraphrase).

Blocks of items have ``BLOCK_PARTS`` passages, fewer than the latent dimensions, so
that each is well represented whatever the size of the benchmark; ``GROUP_BLOCKS`` blocks
are searched side by side, so the documents are read once for some 5,000 passages.  The
driver holds one group of items at a time, and the disk one group's numbers of the documents.
The documents are never shuffled.  An item of more than ``LONGEST`` words is sought as
consecutive items of that size.

Defined results: null, empty and blank documents and items match nothing; equal
items are reported each; repeated documents are reported each; equal cosines need
no rule, as the check decides; empty tables give no rows.  Words are split at
ASCII blanks and punctuation after lower-casing A-Z.  Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import utf8
from caseflow.session import drop_stage, stage

WINDOW = 64
HALF = WINDOW // 2
RANK = 288
BLOCK_PARTS, GROUP_BLOCKS = 256, 20
LONGEST = 8192
FIT_WINDOWS = 32_768  # as many weigh in the fit as all windows of a larger corpus
HELD_CELLS = 1 << 24  # of the fit's sums that a task holds
PAIRS_AT_ONCE = 1 << 20
WORD_BYTES = 6.5  # with its blank, to estimate the number of windows
POWER_STEPS = 2
COMMON_SHARE = 0.10  # terms in more documents than this are common words
MIN_COSINE = 0.6
MIN_PART = 0.3  # of an item that the window's latent vector holds
COPY_SHARE, PARAPHRASE_SHARE, ANSWER_SHARE = 0.6, 0.45, 0.5
MIN_RARE = 4  # rarer words that a paraphrase must share
TOKENS_AT_ONCE = 8192
PIECE_BYTES = 1 << 20
SUM_BYTES = 1 << 17  # of a part of a sum on its way to the driver, well below what its heap keeps apart as large

_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_BLANKS = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))


def plain_words(data: bytes) -> list[bytes]:
    return data.lower().translate(_BLANKS).split()


def answer_of(text: str) -> list[bytes]:
    """The words of the last sentence."""
    parts = [p for p in text.replace("\n", ". ").replace("? ", ". ").replace("! ", ". ").split(". ") if plain_words(p.encode())]
    return plain_words(parts[-1].encode()) if parts else []


def lcs(a: list, b: list) -> int:
    """Length of the longest common subsequence, by bit-parallel steps."""
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        hit = where.get(y)
        if hit is not None:
            u = row & hit
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


class Item:
    """A benchmark item or, of a very long one, a stretch."""

    def __init__(self, number: int | None, words: list[bytes], answer: list[bytes]):
        self.id, self.words, self.answer = number, words, answer
        last = max(len(words) - WINDOW, 0)
        self.starts = [*range(0, last, HALF), last]
        # numbers of its words, its rarer ones and its answer's
        self.codes: list[int] = []
        self.rare: list[int] = []
        self.answer_codes: list[int] = []

    def number_words(self, index: dict[bytes, int], common: set[int]) -> None:
        self.codes = [index[w] for w in self.words]
        self.rare = [c for c in self.codes if c not in common]
        self.answer_codes = [index.get(w, -1) for w in self.answer]


def items_of(rows: Iterator[tuple]) -> Iterator[Item]:
    for number, text in rows:
        words = plain_words((text or "").encode())
        for a in range(0, len(words), LONGEST):
            stretch = words[a : a + LONGEST]
            yield Item(number, stretch, answer_of(text) if len(words) <= LONGEST else stretch[-HALF:])


def groups_of(items: Iterator[Item]) -> Iterator[list[list[Item]]]:
    """Groups of blocks of items."""
    group: list[list[Item]] = [[]]
    held = 0
    for item in items:
        if group[-1] and held + len(item.starts) > BLOCK_PARTS:
            if len(group) == GROUP_BLOCKS:
                yield group
                group = []
            group.append([])
            held = 0
        group[-1].append(item)
        held += len(item.starts)
    if group[-1]:
        yield group


def code_type(n_terms: int) -> type:
    """Of the numbers of the terms and one more, which stands for any other word."""
    return np.uint16 if n_terms < 1 << 16 else np.uint32


def survey(rows: DataFrame, terms) -> DataFrame:
    """In how many of the rows ``(doc_id, _text)`` each term occurs, as ``(term, n)``, and of each row with a term its bytes and the numbers of its words, as ``(doc_id, size, codes)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = terms.value
        other, kind = len(index), code_type(len(index))
        n = np.zeros(other + 1, np.int64)
        for batch in batches:
            found = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = value.as_py()
                words = plain_words(text)
                codes = np.fromiter((index.get(w, other) for w in words), kind, len(words))
                held = np.unique(codes)
                n[held] += 1
                if len(held) and held[0] < other:
                    found.append((doc, len(text), codes.tobytes()))
            if found:
                yield _surveyed([], [], found)
        seen = np.flatnonzero(n[:-1])
        yield _surveyed(seen, n[seen], [])

    return rows.mapInArrow(run, "term int, n long, doc_id long, size long, codes binary")


def _surveyed(terms, n, found: list[tuple]) -> pa.RecordBatch:
    gap, none = [None] * len(found), [None] * len(terms)
    columns = [pa.array([*terms, *gap], pa.int32()), pa.array([*n, *gap], pa.int64())]
    columns += [pa.array([*none, *(f[i] for f in found)], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))]
    return pa.RecordBatch.from_arrays(columns, names=["term", "n", "doc_id", "size", "codes"])


class Space:
    """A block's items, terms and weights and, once fitted, its latent vectors.

    ``index`` numbers the terms of the whole group; ``local`` turns those numbers into
    this block's, -1 where the block does not have the term.
    """

    def __init__(self, items: list[Item], index: dict[bytes, int], df: np.ndarray, common: set[int], n_docs: int):
        self.items = items
        self.parts = [(i, a) for i, item in enumerate(items) for a in item.starts]
        self.common = common
        # an item of common words only keeps them as its terms
        terms = sorted({t for item in items for t in (item.rare or item.codes)})
        self.local = np.full(len(index) + 1, -1, np.int32)
        self.local[terms] = np.arange(len(terms))
        self.idf = (np.log((1 + n_docs) / (1 + df[terms])) + 1.0).astype(np.float32)
        self.part_codes = [self.local[items[i].codes[a : a + WINDOW]] for i, a in self.parts]
        self.latent: np.ndarray | None = None
        self.vectors: np.ndarray | None = None
        self.lengths: np.ndarray | None = None

    def row(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A normalised sparse TF-IDF row."""
        terms, n = np.unique(codes[codes >= 0], return_counts=True)
        w = n * self.idf[terms]
        return terms.astype(np.int32), (w / max(np.sqrt((w * w).sum()), 1e-9)).astype(np.float32)

    def set_latent(self, latent: np.ndarray) -> None:
        self.latent = np.ascontiguousarray(latent * self.idf[:, None], np.float32)
        v = np.array([self.latent[c[c >= 0]].sum(axis=0) for c in self.part_codes], np.float32)
        self.lengths = np.maximum(np.linalg.norm(v, axis=1), 1e-9)
        self.vectors = np.ascontiguousarray((v / self.lengths[:, None]).T)


def window_rows(texts: list[np.ndarray], local: np.ndarray, idf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Normalised TF-IDF rows of all windows of some texts, those with equally many terms together: ``terms`` and ``weights (windows, terms)``."""
    sizes = np.array([len(t) for t in texts])
    terms = local[np.concatenate(texts)]
    at = np.flatnonzero(terms >= 0)
    ends, n_half = np.cumsum(sizes), -(-sizes // HALF)
    doc = np.searchsorted(ends, at, "right")
    half = (at - (ends - sizes)[doc]) // HALF
    # a half text lies in the window that it begins and in the one before, if the text has these
    window, last = (np.cumsum(n_half) - n_half)[doc] + half, np.maximum(n_half - 2, 0)[doc]
    keys = window * len(idf) + terms[at]
    keys, n = np.unique(np.concatenate([keys[half <= last], keys[half >= 1] - len(idf)]), return_counts=True)
    if not len(keys):
        return
    window, terms = np.divmod(keys, len(idf))
    starts = np.flatnonzero(np.r_[True, window[1:] != window[:-1]])
    lengths = np.diff(np.r_[starts, len(keys)])
    w = n * idf[terms].astype(np.float64)
    w /= np.repeat(np.sqrt(np.add.reduceat(w * w, starts)), lengths)
    for length in np.unique(lengths):
        own = starts[lengths == length]
        step = max(1, PAIRS_AT_ONCE // int(length) ** 2)
        for a in range(0, len(own), step):
            places = own[a : a + step, None] + np.arange(length)
            yield terms[places], w[places]


def _sum_rows(width: int) -> int:
    """Rows of a (terms x ``width``) sum that travel as one part."""
    return max(1, SUM_BYTES // (8 * width))


def window_sums(coded: DataFrame, space: Space, weight: float) -> DataFrame:
    """``A' A`` over all windows of the documents ``(codes)``, staged as parts ``(b, part)`` of rows; ``weight`` of a window."""
    sc = coded.sparkSession.sparkContext
    shared = sc.broadcast((space.local, space.idf))
    n, kind = len(space.idf), code_type(len(space.local) - 1)
    block = _sum_rows(min(RANK, n))
    strip = max(1, HELD_CELLS // n // block) * block

    def summer(low: int, high: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            local, idf = shared.value
            sums, any_row = np.zeros((high - low) * n), False
            for batch in batches:
                if not batch.num_rows:
                    continue
                for terms, weights in window_rows([np.frombuffer(c.as_buffer(), kind) for c in batch.column(0)], local, idf):
                    row, column = np.nonzero((terms >= low) & (terms < high))
                    cells = (terms[row, column] - low)[:, None] * n + terms[row]
                    np.add.at(sums, cells.ravel(), (weights[row, column][:, None] * weights[row]).ravel())
                    any_row = True
            if any_row:
                sums *= weight**2
                for a in range(0, high - low, block):
                    part = sums[a * n : (a + block) * n].tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([(low + a) // block], pa.int32()), pa.array([part], pa.binary())], names=["b", "part"])

        return run

    # a task per core, since each sends its sums
    dealt = coded.where("codes is not null").select("codes").coalesce(sc.defaultParallelism)
    out = None
    for low in range(0, n, strip):
        sums = dealt.mapInArrow(summer(low, min(low + strip, n)), "b int, part binary").groupBy("b").applyInArrow(_add_parts, "b int, part binary")
        out = sums if out is None else out.unionByName(sums)
    out = stage(out)
    shared.destroy()
    return out


def _add_parts(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tasks' sums of one part, added one by one."""
    total = None
    for batch in batches:
        for part in batch.column("part"):
            values = np.frombuffer(part.as_buffer())
            total = values.copy() if total is None else total + values
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["b", "part"])


def sums_times(sums: DataFrame, q: np.ndarray) -> np.ndarray:
    """``S q`` for the staged sums ``S``, in the same parts."""
    shared = sums.sparkSession.sparkContext.broadcast(q)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis = shared.value
        for batch in batches:
            parts = [(np.frombuffer(p.as_buffer()).reshape(-1, len(basis)) @ basis).tobytes() for p in batch.column("part")]
            yield pa.RecordBatch.from_arrays([batch.column("b"), pa.array(parts, pa.binary())], names=["b", "part"])

    found = sums.mapInArrow(run, "b int, part binary").toArrow()
    shared.destroy()
    return _joined(found, q.shape, _sum_rows(q.shape[1]))


def _joined(parts: pa.Table, shape: tuple[int, int], block: int) -> np.ndarray:
    out = np.zeros(shape)
    for b, value in zip(parts["b"].to_pylist(), parts["part"], strict=True):
        part = np.frombuffer(value.as_buffer(), np.float64).reshape(-1, shape[1])
        out[b * block : b * block + len(part)] = part
    return out


def _rows(found: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array([f[i] for f in found], pa.list_(kind)) for i, kind in enumerate((pa.int32(), pa.float32()))]
    return pa.RecordBatch.from_arrays(columns, names=["terms", "weights"])


def gram_times(rows: DataFrame, q: np.ndarray) -> np.ndarray:
    """``A' (A q)``: partial products per task, summed by Spark in blocks of terms.

    The sums reach Python as Arrow batches, so the driver's JVM only passes small parts on.
    """
    shared = rows.sparkSession.sparkContext.broadcast(q)
    shape = q.shape
    block = _sum_rows(shape[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis = shared.value
        out, any_row = np.zeros(shape), False
        for batch in batches:
            for t, w in zip(batch.column(0), batch.column(1), strict=True):
                terms, weights = t.values.to_numpy(), w.values.to_numpy()
                out[terms] += weights[:, None] * (weights @ basis[terms])
                any_row = True
        if any_row:
            parts = [out[a : a + block].tobytes() for a in range(0, len(out), block)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], names=["b", "part"])

    sums = rows.mapInArrow(run, "b int, part binary").groupBy("b").applyInArrow(_add_parts, "b int, part binary").toArrow()
    shared.destroy()
    return _joined(sums, shape, block)


def randomised_svd(product: Callable[[np.ndarray], np.ndarray], n_terms: int, rank: int = RANK, steps: int = POWER_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (terms x rank) and singular values of ``A``, of which ``product(q)`` gives ``A' (A q)``."""
    q = np.linalg.qr(np.random.default_rng(20_260_110).standard_normal((n_terms, min(rank, n_terms))))[0]
    for _ in range(steps):
        q = np.linalg.qr(product(q))[0]
    values, turn = np.linalg.eigh(q.T @ product(q))
    order = np.argsort(-values)
    values = np.sqrt(np.maximum(values[order], 0))
    keep = values > 1e-6 * max(values[0], 1e-12)
    return (q @ turn[:, order])[:, keep], values[keep]


def pieces(codes: np.ndarray, size: int, longest: int) -> Iterator[np.ndarray]:
    """A text of ``size`` bytes in pieces that overlap by more than a checked region; ``longest``: words of an item."""
    if size <= PIECE_BYTES:
        yield codes
        return
    per, overlap = max(PIECE_BYTES // 8, 8 * WINDOW), 4 * WINDOW + 2 * longest
    for a in range(0, len(codes), per):
        yield codes[max(a - overlap, 0) : a + per]


def candidates(space: Space, codes: np.ndarray) -> list[tuple[int, int, float]]:
    """(first word, passage, cosine) of the windows of one text that are near a passage; ``codes`` are the block's."""
    at = np.flatnonzero(codes >= 0)
    if not len(at):
        return []
    n_half = -(-len(codes) // HALF)
    halves = np.zeros((n_half + 1, space.latent.shape[1]), np.float32)
    for a in range(0, len(at), TOKENS_AT_ONCE):
        part = at[a : a + TOKENS_AT_ONCE]
        where = part // HALF
        starts = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
        halves[where[starts]] += np.add.reduceat(space.latent[codes[part]], starts, axis=0)
    windows = halves[:-1] + halves[1:]
    found = []
    for a in range(0, n_half, 4096):
        block = windows[a : a + 4096]
        along = block @ space.vectors
        cosine = along / np.maximum(np.linalg.norm(block, axis=1), 1e-9)[:, None]
        for i, j in zip(*np.nonzero((cosine >= MIN_COSINE) | (along >= MIN_PART * space.lengths)), strict=True):
            found.append(((a + int(i)) * HALF, int(j), float(cosine[i, j])))
    return found


def check(space: Space, item: Item, region: list[int]) -> tuple[float, float, float]:
    """Shares of the item's words, rarer words and answer in common subsequences with the region."""
    share = lcs(item.codes, region) / len(item.codes)
    rare_common = lcs(item.rare, [c for c in region if c not in space.common]) if item.rare else 0
    rare_share = rare_common / len(item.rare) if rare_common >= MIN_RARE else 0.0
    return share, rare_share, lcs(item.answer_codes, region) / len(item.answer_codes) if item.answer_codes else 0.0


def matches(spaces: list[Space], codes: np.ndarray, size: int) -> dict[int | None, tuple]:
    """item id -> (cosine, share, rare share, answer share, first word) of the best checked window."""
    best: dict[int | None, tuple] = {}
    for piece in pieces(codes, size, max(len(item.words) for s in spaces for item in s.items)):
        for space in spaces:
            near: dict[tuple[int, int], tuple[float, int]] = {}
            for first, part, cosine in candidates(space, space.local[piece]):
                i, offset = space.parts[part]
                # windows of one copy put the item's begin within a window of each other
                key = (i, (first - offset) // HALF)
                near[key] = max(near.get(key, (0.0, 0)), (cosine, first))
            for (i, begin), (cosine, first) in near.items():
                item, reach = space.items[i], max(WINDOW, len(space.items[i].words) // 4)
                region = piece[max(begin * HALF - reach, 0) : (begin + 1) * HALF + len(item.words) + reach].tolist()
                share, rare, answer = check(space, item, region)
                if share >= COPY_SHARE or (rare >= PARAPHRASE_SHARE and answer >= ANSWER_SHARE):
                    best[item.id] = max(best.get(item.id, (0.0,) * 5), (cosine, share, rare, answer, first), key=lambda m: (m[1], m[2], m[0]))
    return best


SCHEMA = "doc_id long, item_id long, cosine double, lcs_share double, rare_share double, answer_share double, first_word long"


def search(coded: DataFrame, group) -> DataFrame:
    """Checked matches of the documents ``(doc_id, size, codes)`` with the items of one group of blocks."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaces, kind = group.value
        for batch in batches:
            out: list[tuple] = []
            for doc, size, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                found = matches(spaces, np.frombuffer(value.as_buffer(), kind), size)
                out.extend((doc, item, c, share, rare, answer, first) for item, (c, share, rare, answer, first) in found.items())
            types = [pa.int64(), pa.int64(), *[pa.float64()] * 4, pa.int64()]
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return coded.where("codes is not null").select("doc_id", "size", "codes").mapInArrow(run, SCHEMA)


def fitted_spaces(coded: DataFrame, group: list[list[Item]], index: dict[bytes, int], n_docs: int, n_windows: float) -> list[Space]:
    """The blocks of a group with their latent spaces, from the documents' words as numbers."""
    spark = coded.sparkSession
    df = np.zeros(len(index))
    for r in coded.where("term is not null").groupBy("term").agg(F.sum("n").alias("n")).collect():
        df[r["term"]] = r["n"]
    common = set(np.flatnonzero(df > COMMON_SHARE * n_docs).tolist())
    # the items weigh more than the windows, so that the latent space holds them
    weight = 0.05 * min(1.0, FIT_WINDOWS / n_windows) ** 0.5
    spaces = []
    for items in group:
        for item in items:
            item.number_words(index, common)
        space = Space(items, index, df, common, n_docs)
        own = spark.createDataFrame(pa.Table.from_batches([_rows([space.row(c) for c in space.part_codes])]))
        sums = window_sums(coded, space, weight)
        space.set_latent(randomised_svd(lambda q: gram_times(own, q) + sums_times(sums, q), len(space.idf))[0])  # noqa: B023
        drop_stage(sums)
        spaces.append(space)
    return spaces


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """One row per document and benchmark item that it holds, copied or paraphrased."""
    spark = docs.sparkSession
    listed = benchmark.select(F.col(item_col).cast("long"), F.col("text").cast("string")).orderBy(item_col, "text").toLocalIterator()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("_text"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("_text")).alias("bytes")).first()
    out = spark.createDataFrame([], SCHEMA)
    if not size["n"]:
        return out
    for group in groups_of(items_of((r[0], r[1]) for r in listed)):
        index = {t: i for i, t in enumerate(sorted({w for items in group for item in items for w in item.words}))}
        terms = spark.sparkContext.broadcast(index)
        coded = stage(survey(rows, terms))
        terms.destroy()
        spaces = fitted_spaces(coded, group, index, size["n"], size["n"] + size["bytes"] / WORD_BYTES / HALF)
        shared = spark.sparkContext.broadcast((spaces, code_type(len(index))))
        out = out.unionByName(stage(search(coded, shared)))
        shared.destroy()
        drop_stage(coded)
    return out
