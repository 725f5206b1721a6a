"""Operator 9: quality rules and modified Kneser-Ney perplexity bands.

Model.  Character 4-grams over 32 symbols, one model per language.  Every language
has its own alphabet, counted over all its documents: its ``LETTERS`` most frequent letters
in either case are symbols, its later letters share one symbol and are told apart by their
frequency under it, letters beyond ``MAX_LETTERS`` and outside the basic plane are uniform under
another; blanks, digits and two classes of marks are the rest.  So perplexity means the
same in every script.  32 symbols give a model a proven bound of ``32**4`` n-grams, whatever
the corpus, so it may be broadcast; words would have none.  Tasks count into bounded arrays
and Spark sums the counts of every document.  From these, :func:`fit` makes, in one task per
language, an interpolated modified Kneser-Ney model (three discounts per order from the
counts of counts, continuation counts below the highest order).  It is stored as sorted
arrays of packed n-grams with their probabilities, and sorted contexts with their back-off
weights; a worker expands the arrays of the languages it meets and keeps ``OPEN_MODELS`` of them.
The models of the ``MAX_LANGUAGES`` most frequent languages are broadcast.  Those of all others
stay in Spark: their documents, and the windows of any document that speak for them, are
shuffled by language to where the model lies (:func:`beside`), and the sums come back by row.

Rules.  Base: fewer than ``MIN_WORDS`` words, or more than half of the words in
repeated 3-word windows.  Method: per language, the quartiles over the documents
that pass the base rules give a lower and an upper band, ``LOWER_IQRS`` and
``UPPER_IQRS`` interquartile ranges beyond them; documents outside are rejected.
Below, they are generated or repeated: the lower band is one of the log-perplexity
of the whole text.  Above, they are not text: the upper band is one of
``window_ppl``, the mean over windows of ``WINDOW`` characters, each under the better of
two models, its document's and the one of the language that most of its 3-grams are
most frequent in, with the highest ``1 - TRUSTED`` of a document's windows cut down
to the one below them.  So quoted passages of another language and keys do not
reach the band, it is as tight as the lower one, and the work does not grow with
the number of languages.  Quartiles are exact, over perplexities in steps of 1 / ``STEPS``.

Defined results: null and empty texts have zero counts, no perplexity, and fail
the base rules; null languages are a language; every language has a model and bands
of its own, however many there are; repeated rows get equal results; equal
perplexities fall on the same side of a band (bands are inclusive).  Only the id,
text and language columns are read.
"""

from __future__ import annotations

import pickle
import unicodedata
from collections import Counter, OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caseflow.llm.common import utf8
from caseflow.session import stage

ORDER, SYMBOLS = 4, 32
NGRAMS = SYMBOLS**ORDER
TRIGRAMS = SYMBOLS ** (ORDER - 1)
MAX_LANGUAGES = 256  # whose models are broadcast; the others' are shuffled
OPEN_MODELS = 24
LETTERS, MAX_LETTERS = 26, 4096
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
LOWER_IQRS, UPPER_IQRS = 5.0, 5.0
WINDOW, TRUSTED = 32, 0.9
MIN_IQR = 0.02  # of the log-perplexity, so that a language of alike texts has a band
STEPS = 4096
WAITING_CODES = 4_000_000  # characters that a task gathers before it counts them
VOTED_WINDOWS = 4096  # windows whose votes are counted at once, and that travel in one row
VOTE_TABLE = 256  # languages up to which votes are counted in a table
DEAL_BYTES = 16_000_000  # that meet one copy of a shuffled model
NULL = "\0null"

SYMBOL_BYTES = np.frombuffer(b"#*$%&|<>", np.uint8)
SPACE_BYTES = np.frombuffer(b" \t\n\v\f\r", np.uint8)
BLANK, DIGIT, STOP, MARK, LATER, RARE = range(26, 32)
PLANE = 1 << 16


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Per code point of the basic plane: its class, ``RARE`` for letters, and its lower-case letter."""
    classes, lower = np.full(PLANE, RARE, np.uint8), np.arange(PLANE, dtype=np.uint16)
    for cp in range(PLANE):
        c = chr(cp)
        kind = unicodedata.category(c)
        if c.isspace():
            classes[cp] = BLANK
        elif kind[0] == "N":
            classes[cp] = DIGIT
        elif c in ".,;:!?'\"-()" or (kind[0] == "P" and cp > 127):
            classes[cp] = STOP
        elif kind[0] not in "LM" and kind not in ("Cn", "Cs", "Co"):
            classes[cp] = MARK
        elif len(c.lower()) == 1:
            lower[cp] = ord(c.lower())
    return classes, lower


CLASSES, LOWER = _classes()


class Alphabet:
    """Symbols of the code points in one language, and the log-probability of each under its symbol."""

    def __init__(self, letters: list[tuple[int, int]]):
        """``letters``: the ``(code point, count)`` of the most frequent lower-case letters."""
        letters = sorted(letters, key=lambda x: (-x[1], x[0]))[: LETTERS + MAX_LETTERS]
        symbols, under = CLASSES.copy(), np.zeros(PLANE, np.float32)
        under[CLASSES == RARE] = -np.log(PLANE)
        later = sum(n for _, n in letters[LETTERS:])
        for i, (cp, n) in enumerate(letters):
            symbols[cp], under[cp] = (i, 0.0) if i < LETTERS else (LATER, np.log(n / later))
        self.symbols = np.where(CLASSES == RARE, symbols[LOWER], symbols)
        self.under = np.where(CLASSES == RARE, under[LOWER], under)

    def codes(self, points: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Packed n-grams, one per character from the third on: ``points`` starts with ``ORDER - 1`` blanks."""
        s = self.symbols[points].astype(np.uint32)
        n = len(points) - ORDER + 1
        code = s[ORDER - order : ORDER - order + n].copy()
        for i in range(ORDER - order + 1, ORDER):
            code = (code << np.uint32(5)) | s[i : i + n]
        return code


PLAIN = Alphabet([(cp, 1) for cp in range(ord("a"), ord("z") + 1)])


def points_of(data: bytes) -> np.ndarray:
    """Code points after ``ORDER - 1`` blanks; those beyond the basic plane are its last one."""
    data = b" " * (ORDER - 1) + data
    if data.isascii():
        return np.frombuffer(data, np.uint8)
    return np.minimum(np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le"), np.uint32), PLANE - 1).astype(np.uint16)


def ngram_codes(data: bytes, alphabet: Alphabet = PLAIN) -> np.ndarray:
    """Packed 4-grams of a text, one per character; blanks stand before its start."""
    return alphabet.codes(points_of(data))


def counted(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values below ``size`` and their counts."""
    if len(values) < size // 8:
        return np.unique(values, return_counts=True)
    held = np.bincount(values, minlength=size)
    seen = np.flatnonzero(held)
    return seen, held[seen]


def counted_batches(found: Iterator[tuple[str, list]]) -> Iterator[pa.RecordBatch]:
    """Batches ``(lang, kind, code, n)`` from a language and its ``(kind, size, array)`` per text."""
    waiting: dict[tuple, list[np.ndarray]] = {}
    held = 0

    def counts() -> Iterator[pa.RecordBatch]:
        for (name, kind, size), arrays in waiting.items():
            seen, n = counted(np.concatenate(arrays), size)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(seen), pa.string()), pa.array([kind] * len(seen), pa.int32()), pa.array(seen, pa.int32()), pa.array(n, pa.int64())], names=["lang", "kind", "code", "n"]
            )
        waiting.clear()

    for name, values in found:
        for kind, size, array in values:
            waiting.setdefault((name, kind, size), []).append(array)
        held += max(len(v[2]) for v in values)
        if held >= WAITING_CODES:
            yield from counts()
            held = 0
    yield from counts()


COUNTS = "lang string, kind int, code int, n long"


def summed(partial: DataFrame) -> DataFrame:
    return partial.groupBy("lang", "kind", "code").agg(F.sum("n").alias("n"))


def count_by_language(df: DataFrame, text_col: str, lang: F.Column, values) -> DataFrame:
    """``(lang, kind, code, n)``: how often each value occurs in a language; ``values(lang, points)`` gives ``(kind, size, array)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = ((language.as_py(), value.as_py()) for batch in batches for language, value in zip(batch.column(0), batch.column(1), strict=True))
        return counted_batches((name, values(name, points_of(data))) for name, data in texts)

    return summed(df.select(lang.alias("lang"), utf8(text_col).alias("text")).mapInArrow(run, COUNTS))


def beside(rows: DataFrame, models: DataFrame, run, schema: str, size: str) -> DataFrame:
    """``run`` over both tables, dealt by ``lang``: the row of ``models`` comes before its language's ``rows``.

    Languages with more than ``DEAL_BYTES`` in the column ``size`` are dealt to several
    tasks, each with a copy of the model.  Columns: lang, those of ``models``, then of ``rows``.
    """
    heavy = rows.groupBy("lang").agg(F.sum(F.octet_length(size)).alias("_bytes")).where(F.col("_bytes") > DEAL_BYTES)
    heavy = F.broadcast(heavy.select("lang", F.ceil(F.col("_bytes") / DEAL_BYTES).alias("_deals")))
    deals = F.coalesce(F.col("_deals"), F.lit(1).cast("long"))
    dealt = rows.join(heavy, "lang", "left").withColumn("_deal", F.pmod(F.monotonically_increasing_id(), deals)).withColumn("_is_row", F.lit(1))
    copies = models.join(heavy, "lang", "left").withColumn("_deal", F.explode(F.sequence(F.lit(0).cast("long"), deals - 1))).withColumn("_is_row", F.lit(0))
    both = copies.drop("_deals").unionByName(dealt.drop("_deals"), allowMissingColumns=True)
    both = both.repartition("lang", "_deal").sortWithinPartitions("lang", "_deal", "_is_row")
    names = ["lang", *(c for c in models.columns if c != "lang"), *(c for c in rows.columns if c != "lang")]
    return both.select("_is_row", *names).mapInArrow(run, schema)


def count_letters(df: DataFrame, text_col: str, lang: F.Column) -> DataFrame:
    """``(lang, code, n)``: the most frequent lower-case letters of every language, ``LETTERS + MAX_LETTERS`` at most."""

    def values(_: str, points: np.ndarray):
        low = LOWER[points[ORDER - 1 :]]
        return [(0, PLANE, low[(CLASSES[low] == RARE) & (low < PLANE - 1)])]

    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    return count_by_language(df, text_col, lang, values).withColumn("_i", first).where(F.col("_i") <= LETTERS + MAX_LETTERS).select("lang", "code", "n")


def pack_letters(rows: pd.DataFrame) -> pd.DataFrame:
    """One row ``(lang, letters)`` from the letters of a language."""
    return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "letters": [pickle.dumps(list(zip(rows["code"].tolist(), rows["n"].tolist(), strict=True)))]})


def discounts(counts: np.ndarray) -> np.ndarray:
    """D(0), D(1), D(2), D(3+) from the counts of counts."""
    n1, n2, n3, n4 = (float((counts == k).sum()) for k in (1, 2, 3, 4))
    if min(n1, n2, n3, n4) == 0:  # too few n-grams to estimate
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0, *(min(max(x, 0.05), k - 0.05) for k, x in enumerate(d, 1))])


def fit(keys: np.ndarray, counts: np.ndarray) -> list[dict[str, np.ndarray]]:
    """The model of one language as sorted arrays per order, lowest order first."""
    by_order = []
    full = np.zeros(NGRAMS, np.int64)
    full[keys] = counts
    for order in range(ORDER, 0, -1):
        by_order.insert(0, full)
        full = (full.reshape(SYMBOLS, -1) > 0).sum(axis=0)  # distinct symbols before: continuation counts
    model, lower = [], np.full(1, 1.0 / SYMBOLS)
    for order, c in enumerate(by_order, 1):
        d = discounts(c)
        table = c.reshape(-1, SYMBOLS)
        total = table.sum(axis=1)
        taken = d[np.minimum(table, 3)]
        weight = np.where(total > 0, taken.sum(axis=1) / np.maximum(total, 1), 1.0)
        below = np.resize(lower, NGRAMS if order == ORDER else SYMBOLS**order).reshape(-1, SYMBOLS) if order > 1 else np.full((1, SYMBOLS), 1.0 / SYMBOLS)
        p = (np.maximum(table - taken, 0) / np.maximum(total, 1)[:, None] + weight[:, None] * below).ravel()
        seen, contexts = np.flatnonzero(c), np.flatnonzero(total)
        model.append({"keys": seen.astype(np.uint32), "p": p[seen], "contexts": contexts.astype(np.uint32), "weight": weight[contexts]})
        lower = p
    return model


def expand(model: list[dict[str, np.ndarray]]) -> np.ndarray:
    """Natural log-probabilities of all packed 4-grams, from the sorted arrays."""
    lower = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for order, m in enumerate(model, 1):
        size = SYMBOLS**order
        weight = np.ones(size // SYMBOLS)
        weight[m["contexts"]] = m["weight"]
        below = np.resize(lower, size) if order > 1 else lower
        lower = np.repeat(weight, SYMBOLS) * below
        lower[m["keys"]] = m["p"]
    return np.log(lower).astype(np.float32)


def fit_language(rows: pd.DataFrame) -> pd.DataFrame:
    """One row ``(lang, model)`` from the at most ``32**4`` 4-grams of a language."""
    rows = rows.sort_values("code")
    model = [{k: v.astype(np.float32) if v.dtype == np.float64 else v for k, v in m.items()} for m in fit(rows["code"].to_numpy(), rows["n"].to_numpy())]
    return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "model": [pickle.dumps(model)]})


class Models:
    """What workers score with: letters and packed models of the broadcast languages, the common letters, and the language each 3-gram speaks for.

    ``names``: the languages that any 3-gram speaks for, sorted, at most ``TRIGRAMS``; ``speaks`` holds places in it.
    """

    def __init__(self, letters: dict[str, list], packed: dict[str, bytes], common: list, names: list[str], speaks: np.ndarray):
        self.letters, self.packed, self.common_letters, self.names, self.speaks = letters, packed, common, names, speaks

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("opened", "shared", "places")}

    def open(self, name: str) -> tuple[Alphabet, np.ndarray]:
        """Alphabet and table of a language; the ``OPEN_MODELS`` last used are kept."""
        opened = self.__dict__.setdefault("opened", OrderedDict())
        if name not in opened:
            opened[name] = Alphabet(self.letters.get(name, [])), expand(pickle.loads(self.packed[name]))
            if len(opened) > OPEN_MODELS:
                opened.popitem(last=False)
        opened.move_to_end(name)
        return opened[name]

    def common(self) -> Alphabet:
        if "shared" not in self.__dict__:
            self.shared = Alphabet(self.common_letters)
        return self.shared

    def place(self, name: str) -> int:
        """Place of a language in ``names``; -1 if no 3-gram speaks for it."""
        if "places" not in self.__dict__:
            self.places = {x: i for i, x in enumerate(self.names)}
        return self.places.get(name, -1)


def train(df: DataFrame, text_col: str, lang: F.Column, top: list[str], rest: bool) -> tuple[Models, DataFrame | None]:
    """The models of the languages ``top`` and, if there is a ``rest``, the table ``(lang, letters, model)`` of all others.

    To the driver come at most 4,122 letters and one packed model of each language in ``top``,
    4,122 common letters and one language for each 3-gram.
    """
    found = stage(count_letters(df, text_col, lang))
    letters: dict[str, list[tuple[int, int]]] = {}
    for r in found.where(F.col("lang").isin(top)).collect():
        letters.setdefault(r["lang"], []).append((r["code"], r["n"]))
    common = found.groupBy("code").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "code").limit(LETTERS + MAX_LETTERS).collect()
    common = [(r["code"], r["n"]) for r in common]
    shared = df.sparkSession.sparkContext.broadcast((letters, common))
    alphabets: dict[str | None, Alphabet] = {}

    def values_under(alphabet: Alphabet, points: np.ndarray) -> list:
        if None not in alphabets:
            alphabets[None] = Alphabet(shared.value[1])
        return [(ORDER, NGRAMS, alphabet.codes(points)), (ORDER - 1, TRIGRAMS, alphabets[None].codes(points, ORDER - 1))]

    def values(name: str, points: np.ndarray) -> list:
        if name not in alphabets:
            alphabets[name] = Alphabet(shared.value[0].get(name, []))
        return values_under(alphabets[name], points)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def texts():
            held, alphabet = None, None
            for batch in batches:
                for is_text, language, packed, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if held != language:  # a language without letters has no row of them
                        held, alphabet = language, Alphabet(pickle.loads(packed) if packed else [])
                    if is_text:
                        yield language, values_under(alphabet, points_of(text))

        return counted_batches(texts())

    packed_letters = None
    if rest:
        packed_letters = found.where(~F.col("lang").isin(top)).groupBy("lang").applyInPandas(pack_letters, "lang string, letters binary")
        texts = df.where(~lang.isin(top)).select(lang.alias("lang"), utf8(text_col).alias("text"))
        others = summed(beside(texts, packed_letters, run, COUNTS, "text"))
        counts = stage(count_by_language(df.where(lang.isin(top)), text_col, lang, values).unionByName(others))
    else:
        counts = stage(count_by_language(df, text_col, lang, values))
    fitted = lambda own: counts.where((F.col("kind") == ORDER) & own).groupBy("lang").applyInPandas(fit_language, "lang string, model binary")
    packed = {r["lang"]: bytes(r["model"]) for r in fitted(F.col("lang").isin(top)).collect()}
    threes = counts.where(F.col("kind") == ORDER - 1)
    share = threes.join(threes.groupBy("lang").agg(F.sum("n").alias("total")), "lang").withColumn("share", F.col("n") / F.col("total"))
    spoken = share.groupBy("code").agg(F.max_by("lang", F.struct("share", "lang")).alias("lang")).collect()
    names = sorted({r["lang"] for r in spoken})
    index = {name: i for i, name in enumerate(names)}
    speaks = np.full(TRIGRAMS, len(index), np.int64)
    for r in spoken:
        speaks[r["code"]] = index[r["lang"]]
    models = packed_letters.join(fitted(~F.col("lang").isin(top)), "lang", "right").select("lang", "letters", "model") if rest else None
    return Models(letters, packed, common, names, speaks), models


def repeated_window_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    inside = np.zeros(len(words) + 3, bool)
    at = np.flatnonzero(np.fromiter((seen[w] > 1 for w in windows), bool, len(windows)))
    for i in range(3):
        inside[at + i] = True
    return int(inside.sum())


def text_features(data: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = data.split()
    per_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    chars = len(data) - int(per_byte[0x80:0xC0].sum()) - int(per_byte[SPACE_BYTES].sum())
    lines = [x for x in data.split(b"\n") if x.strip()]
    return len(words), chars, int(per_byte[SYMBOL_BYTES].sum()), len(lines) - len(set(lines)), repeated_window_words(words)


def window_languages(votes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, languages: int) -> np.ndarray:
    """Per window the language with most votes, the first of equals; -1 without a vote."""
    out = np.empty(len(starts), np.int64)
    for lo in range(0, len(starts), VOTED_WINDOWS):
        hi = min(lo + VOTED_WINDOWS, len(starts))
        window = np.repeat(np.arange(hi - lo), sizes[lo:hi])
        inside = votes[starts[lo] : starts[lo] + len(window)]
        if languages > VOTE_TABLE:
            out[lo:hi] = -1
            cast, n = np.unique((window * (languages + 1) + inside)[inside < languages], return_counts=True)
            at, voted = np.divmod(cast, languages + 1)
            order = np.lexsort((voted, -n, at))
            at, first = np.unique(at[order], return_index=True)
            out[lo + at] = voted[order][first]
            continue
        table = np.bincount(window * (languages + 1) + inside, minlength=(hi - lo) * (languages + 1)).reshape(hi - lo, -1)[:, :languages]
        out[lo:hi] = np.where(table.max(axis=1) > 0, table.argmax(axis=1), -1)
    return out


def window_sums(points: np.ndarray, starts: np.ndarray, sizes: np.ndarray, alphabet: Alphabet, table: np.ndarray) -> np.ndarray:
    """Log-probability of each window; its first character lies ``ORDER - 1`` places after its start in ``points``."""
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
    code = alphabet.symbols[points[at]].astype(np.uint32)
    for k in range(1, ORDER):
        code = (code << np.uint32(5)) | alphabet.symbols[points[at + k]]
    return np.add.reduceat(table[code] + alphabet.under[points[at + ORDER - 1]], ends - sizes)


def window_bounds(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the windows of a text."""
    n = max(length // WINDOW, 1)
    starts = np.arange(n) * length // n
    return starts, np.diff(np.r_[starts, length])


def window_mean(best: np.ndarray, sizes: np.ndarray) -> float:
    """The mean log-perplexity over windows; the highest windows count as the one below them."""
    ppl = -best.astype(np.float64) / sizes
    at = int(TRUSTED * (len(sizes) - 1))
    return float((np.minimum(ppl, np.partition(ppl, at)[at]) * sizes).sum() / sizes.sum())


class Texts:
    """Texts that are scored together, so that every model is opened once for the windows that speak for it."""

    def __init__(self, models: Models):
        self.models, self.held = models, 0
        self.of: list = []  # what the caller knows a text by
        self.names: list[str] = []
        self.rows: list[int] = []
        self.log_ppl: list[float | None] = []
        self.points, self.starts, self.sizes, self.best, self.voted = [], [], [], [], []

    def add(self, of, row: int, name: str, points: np.ndarray) -> None:
        models, length = self.models, len(points) - ORDER + 1
        starts, sizes = window_bounds(length)
        voted = window_languages(models.speaks[models.common().codes(points, ORDER - 1)], starts, sizes, len(models.names))
        voted[voted == models.place(name)] = -1
        if name in models.packed:
            alphabet, table = models.open(name)
            logs = table[alphabet.codes(points)] + alphabet.under[points[ORDER - 1 :]]
            self.log_ppl.append(-float(logs.sum(dtype=np.float64)) / length)
            self.best.append(np.add.reduceat(logs, starts))
        else:
            self.log_ppl.append(None)
            self.best.append(np.full(len(starts), -np.inf, np.float32))
        for to, x in ((self.of, of), (self.rows, row), (self.names, name), (self.starts, starts + self.held), (self.sizes, sizes), (self.voted, voted), (self.points, points.astype(np.uint16))):
            to.append(x)
        self.held += len(points)

    def settle(self) -> tuple[list[tuple], list[tuple]]:
        """Per text ``(of, log_ppl, window_ppl, best)``, the last two null in turn; and rows of windows for models that lie elsewhere.

        A window counts under the better of its document's model and that of its own language.
        """
        if not self.of:
            return [], []
        models, counts = self.models, [len(x) for x in self.starts]
        text = np.repeat(np.arange(len(counts)), counts)
        points, starts, sizes, best, voted = (np.concatenate(x) for x in (self.points, self.starts, self.sizes, self.best, self.voted))
        first = np.cumsum(counts) - counts
        is_open, sent = np.zeros(len(counts), bool), []

        def send(name: str, own: bool, windows: np.ndarray) -> None:
            is_open[text[windows]] = True
            for lo in range(0, len(windows), VOTED_WINDOWS):
                its = windows[lo : lo + VOTED_WINDOWS]
                long = sizes[its] + ORDER - 1
                at = np.arange(long.sum()) + np.repeat(starts[its] - (np.cumsum(long) - long), long)
                rows = np.array(self.rows, np.int64)[text[its]]
                sent.append((name, own, *(x.tobytes() for x in (rows, (its - first[text[its]]).astype(np.int32), sizes[its].astype(np.int32), points[at]))))

        by_vote = np.argsort(voted, kind="stable")
        seen, begin = np.unique(voted[by_vote], return_index=True)
        for i, its in zip(seen, np.split(by_vote, begin[1:]), strict=True):
            if i < 0:
                continue
            if models.names[i] in models.packed:
                best[its] = np.maximum(best[its], window_sums(points, starts[its], sizes[its], *models.open(models.names[i])))
            else:
                send(models.names[i], False, its)
        elsewhere: dict[str, list[np.ndarray]] = {}
        for k, name in enumerate(self.names):
            if name not in models.packed:
                elsewhere.setdefault(name, []).append(np.arange(first[k], first[k] + counts[k]))
        for name, its in elsewhere.items():
            send(name, True, np.concatenate(its))
        found = []
        for k, (lo, n) in enumerate(zip(first, counts, strict=True)):
            mine = best[lo : lo + n]
            found.append((self.of[k], self.log_ppl[k], *((None, mine.tobytes()) if is_open[k] else (window_mean(mine, self.sizes[k]), None))))
        return found, sent


FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
OPEN = {"_row": "long", "_length": "long", "_best": "binary", "_own": "boolean", "_rows": "binary", "_at": "binary", "_sizes": "binary", "_points": "binary"}


def score(df: DataFrame, models: Models, id_col: str, text_col: str, lang: F.Column) -> DataFrame:
    """Features and log-perplexities of every row; ``_key`` tells texts of one id apart.

    Rows with ``_best`` are finished by :func:`finish`; rows with ``_points`` are no documents
    but windows for the model of ``lang``.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(models)
    names = [id_col, "_key", "lang", *FEATURES, "log_ppl", "window_ppl", *OPEN]
    types = [pa.int64()] * 5 + [pa.float64()] * 2 + [pa.int64()] * 2 + [pa.binary(), pa.bool_()] + [pa.binary()] * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, rows, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4)
            found: list = [None] * len(languages)
            waiting, sent = Texts(shared.value), []

            def settle(held: Texts, found: list = found, sent: list = sent) -> None:
                scored, windows = held.settle()
                for (i, length), log_ppl, window_ppl, best in scored:
                    found[i] = (*found[i][:5], log_ppl, window_ppl, found[i][7], length, best)
                sent += windows

            for i in sorted(range(len(languages)), key=languages.__getitem__):  # a language's model is opened once a batch
                data = texts[i].as_py()
                found[i] = (*text_features(data), None, None, rows[i], 0, None)
                if data:
                    points = points_of(data)
                    waiting.add((i, len(points) - ORDER + 1), rows[i], languages[i], points)
                    if waiting.held >= WAITING_CODES:
                        settle(waiting)
                        waiting = Texts(shared.value)
            settle(waiting)
            columns = [*zip(*found, strict=True)] if found else [[]] * 10
            columns += [[None] * len(found)] * 5
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=names)
            if sent:
                nothing = [pa.nulls(len(sent), t) for t in (batch.column(0).type, pa.int64())]
                name, *windows = zip(*sent, strict=True)
                nulls = [pa.nulls(len(sent), t) for t in types[:10]]
                yield pa.RecordBatch.from_arrays([*nothing, pa.array(name, pa.string()), *nulls, *(pa.array(c, t) for c, t in zip(windows, types[10:], strict=True))], names=names)

    rows = df.select(F.col(id_col), F.xxhash64(text_col).alias("_key"), lang.alias("lang"), F.monotonically_increasing_id().alias("_row"), utf8(text_col).alias("_text"))
    schema = [f"`{id_col}` {id_type}, _key long, lang string", *(f"{c} long" for c in FEATURES), "log_ppl double, window_ppl double", *(f"{c} {t}" for c, t in OPEN.items())]
    return rows.mapInArrow(run, ", ".join(schema))


def score_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(_row, own, at, log_p)`` of windows that come after the model of their language."""
    alphabet, table = PLAIN, None
    for batch in batches:
        for is_window, _, letters, model, own, *windows in zip(*batch.columns, strict=True):
            if not is_window.as_py():
                alphabet, table = Alphabet(pickle.loads(letters.as_py()) if letters.is_valid else []), expand(pickle.loads(model.as_py()))
                continue
            rows, at, sizes, points = (np.frombuffer(x.as_py(), t) for x, t in zip(windows, (np.int64, np.int32, np.int32, np.uint16), strict=True))
            long = sizes.astype(np.int64) + ORDER - 1
            sums = window_sums(points, np.cumsum(long) - long, sizes.astype(np.int64), alphabet, table)
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array([own.as_py()] * len(rows)), pa.array(at), pa.array(sums.astype(np.float64))], names=["_row", "own", "at", "log_p"])


def gather_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(_row, _log_ppl, _window_ppl)`` of documents from what they knew and the sums of their other windows."""
    for batch in batches:
        rows, lengths, bests, sums = batch.columns
        flat, bounds = sums.flatten(), sums.offsets.to_numpy()
        bounds = bounds - bounds[0]
        own, at, log_p = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("own", "at", "log_p"))
        found = []
        for k in range(len(rows)):
            _, sizes = window_bounds(lengths[k].as_py())
            best, its = np.frombuffer(bests[k].as_py(), np.float32).copy(), slice(bounds[k], bounds[k + 1])
            np.maximum.at(best, at[its], log_p[its].astype(np.float32))
            mine = np.flatnonzero(own[its])
            mine = mine[np.argsort(at[its][mine])]
            found.append((-float(log_p[its][mine].sum()) / int(sizes.sum()) if len(mine) else None, window_mean(best, sizes)))
        columns = zip(*found, strict=True) if found else ([], [])
        yield pa.RecordBatch.from_arrays([rows, *(pa.array(c, pa.float64()) for c in columns)], names=["_row", "_log_ppl", "_window_ppl"])


def finish(scored: DataFrame, models: DataFrame) -> DataFrame:
    """``scored`` with the perplexities of documents that needed ``models``, which are not broadcast."""
    windows = scored.where(F.col("_points").isNotNull()).select("lang", "_own", "_rows", "_at", "_sizes", "_points")
    sums = beside(windows, models, score_windows, "_row long, own boolean, at int, log_p double", "_points")
    sums = sums.groupBy("_row").agg(F.collect_list(F.struct("own", "at", "log_p")).alias("sums"))
    documents = scored.where(F.col("_points").isNull())
    waiting = documents.where(F.col("_best").isNotNull()).select("_row", "_length", "_best")
    found = stage(waiting.join(sums, "_row").select("_row", "_length", "_best", "sums").mapInArrow(gather_windows, "_row long, _log_ppl double, _window_ppl double"))
    whole = documents.join(found, "_row", "left")
    return whole.withColumns({c: F.coalesce(c, f"_{c}") for c in ("log_ppl", "window_ppl")}).select(scored.columns)


def bands_of(scored: DataFrame, lower_iqrs: float, upper_iqrs: float) -> DataFrame:
    """``(lang, band_low, band_high)`` from exact quartiles; steps are counted before they meet."""
    passed = scored.where(~F.col("base_failed") & F.col("log_ppl").isNotNull())
    steps = passed.select("lang", F.explode(F.array(*[F.struct(F.lit(c).alias("of"), F.round(F.col(c) * STEPS).cast("int").alias("step")) for c in ("log_ppl", "window_ppl")])).alias("v"))
    counts = steps.groupBy("lang", "v.of", "v.step").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("lang", "of")
    ranked = counts.withColumn("upto", F.sum("n").over(whole.orderBy("step"))).withColumn("total", F.sum("n").over(whole))
    quartile = lambda q: F.min(F.when(4 * F.col("upto") >= q * F.col("total"), F.col("step"))) / STEPS
    found = ranked.groupBy("lang", "of").agg(quartile(1).alias("q1"), quartile(3).alias("q3"))
    spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(MIN_IQR))
    low, high = F.col("q1") - lower_iqrs * spread, F.col("q3") + upper_iqrs * spread
    return found.groupBy("lang").agg(F.max(F.when(F.col("of") == "log_ppl", low)).alias("band_low"), F.max(F.when(F.col("of") == "window_ppl", high)).alias("band_high"))


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", lower_iqrs: float = LOWER_IQRS, upper_iqrs: float = UPPER_IQRS) -> DataFrame:
    """One row per row of ``df``: the features, ``log_ppl``, ``window_ppl``, the bands, ``base_failed``, ``kept`` and ``_key``."""
    own = F.coalesce(F.col(lang_col).cast("string"), F.lit(NULL))
    sizes = df.groupBy(own.alias("l")).agg(F.count(F.lit(1)).alias("n"))
    top = [r["l"] for r in sizes.orderBy(F.desc("n"), "l").limit(MAX_LANGUAGES + 1).collect()]
    models, others = train(df, text_col, own, top[:MAX_LANGUAGES], len(top) > MAX_LANGUAGES)
    scored = stage(score(df, models, id_col, text_col, own))
    if others is not None:
        scored = finish(scored, others)
    scored = scored.drop(*OPEN)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    scored = scored.withColumn("base_failed", failed)
    bands = bands_of(scored, lower_iqrs, upper_iqrs)
    inside = F.coalesce((F.col("log_ppl") >= F.col("band_low")) & (F.col("window_ppl") <= F.col("band_high")), F.lit(False))
    return scored.join(bands, "lang", "left").withColumn("kept", ~F.col("base_failed") & inside)
