"""Operator 5: token counts by a map-side two-tier lookup.

A token count is the sum of the lengths of a text's pre-tokens, because the
merges never cross a pre-token.  Tier one is a compact table of frequent
pre-tokens and their lengths, broadcast to the workers.  Tier two is a cache in
each Python worker: what is not in the table is encoded once, in batches, by the
tokenizer library and remembered.  No pre-token is ever shuffled, and the only
shuffle-free pass over the texts is the scan itself.

The table is fitted on a bounded sample (``SAMPLE_ROWS`` rows, texts up to
``SAMPLE_BYTES`` each); it decides only the speed, never a count.

Exactness.  The fast path splits with the tokenizer's own pattern and is taken
only for texts made of characters on which Unicode versions of the two regular
expression engines agree and which normalisation leaves alone (``SAFE``).  A
text with any other character, or with the text of a special token in it, is
encoded whole by the library.

Defined results: null or empty text counts 0 tokens and 0 bytes; repeated rows
and null ids are kept as they are, one result per input row; a pre-token longer
than ``CACHE_CHARS`` is encoded but not remembered, so memory stays bounded for
very long texts.  Only the id and text columns are read, so extra columns can
have any name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import bounded_sample

SAMPLE_ROWS = 2_000
SAMPLE_BYTES = 16_384
TABLE_ENTRIES = 65_536  # frequent pre-tokens in the broadcast table
CACHE_ENTRIES = 400_000  # pre-tokens that a worker remembers, the table included
CACHE_CHARS = 64
CHUNK_CHARS = 2_000_000  # characters split at a time

# The pre-token pattern of word_bpe_49k.json.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SAFE = re.compile(r"[\t\n\r\x20-\x7e\xa1-įı-ʯ‐-‧€]*")

_tokenizers: dict[str, object] = {}
_caches: dict[str, dict[str, int]] = {}


def tokenizer_at(path: str):
    """The library's tokenizer, loaded once per process."""
    if path not in _tokenizers:
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def pre_tokens(text: str) -> list[str] | None:
    """The pre-tokens of a text, or None when only the library may split it."""
    if SAFE.fullmatch(text) is None or "<|" in text:
        return None
    return PRE_TOKEN.findall(text.lower())


def library_lengths(tok, texts: list[str]) -> list[int]:
    return [len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]


class Counts:
    """Counts tokens of texts with a known-lengths table that grows in the worker."""

    def __init__(self, path: str, frequent: dict[str, int]):
        self.tok = tokenizer_at(path)
        self.frequent = frequent
        self.known = _caches.setdefault(path, {})
        if len(self.known) < len(frequent):
            self.known.update(frequent)

    def learn(self, unknown: set[str]) -> dict[str, int]:
        """Lengths of unknown pre-tokens; the short ones are remembered."""
        todo = list(unknown)
        found = dict(zip(todo, library_lengths(self.tok, todo), strict=True))
        if len(self.known) + len(found) > CACHE_ENTRIES:
            self.known.clear()
            self.known.update(self.frequent)
        self.known.update((k, v) for k, v in found.items() if len(k) <= CACHE_CHARS)
        return found

    def __call__(self, texts: list[str]) -> list[int]:
        out, split = [0] * len(texts), []
        for i, text in enumerate(texts):
            parts = pre_tokens(text)
            if parts is None:
                out[i] = library_lengths(self.tok, [text])[0]
            else:
                split.append((i, parts))
        needed = set().union(*(parts for _, parts in split)) if split else set()
        lengths = {p: self.known[p] for p in needed if p in self.known}
        if missing := needed.difference(lengths):
            lengths.update(self.learn(missing))
        for i, parts in split:
            out[i] = sum(map(lengths.__getitem__, parts))
        return out


def chunks(values, limit: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """Runs of texts of about ``limit`` characters; one long text is a run of its own."""
    run, size = [], 0
    for v in values:
        text = v.as_py() or ""
        if run and size + len(text) > limit:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def frequent_lengths(df: DataFrame, text_col: str, path: str, sample_rows: int = SAMPLE_ROWS) -> dict[str, int]:
    """Lengths of the pre-tokens that are frequent in a bounded sample of rows."""
    seen: Counter = Counter()
    for text in bounded_sample(df, text_col, sample_rows, SAMPLE_BYTES):
        seen.update(p for p in pre_tokens(text) or () if len(p) <= CACHE_CHARS)
    top = [p for p, _ in seen.most_common(TABLE_ENTRIES)]
    return dict(zip(top, library_lengths(tokenizer_at(path), top), strict=True)) if top else {}


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(id, n_bytes long, n_tokens long)`` for every row; ``path``: the tokenizer file."""
    frequent = df.sparkSession.sparkContext.broadcast(frequent_lengths(df, text_col, path, sample_rows))
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counts(path, frequent.value)
        for batch in batches:
            n: list[int] = []
            for texts in chunks(batch.column(2)):
                n.extend(count(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], names=[id_col, "n_bytes", "n_tokens"])

    rows = df.select(
        F.col(id_col),
        F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text_col).alias("_text"),
    )
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, n_bytes long, n_tokens long")


