"""Complaint themes (M1-M8): TF-IDF over 1-2-grams, K-Means, per-theme summaries.

* tokens: lower-case, maximal runs of >= 2 word characters (letters, digits,
  underscore), stop words removed, then bigrams of the remaining tokens.  A text is
  tokenised once and its tokens staged; vocabulary and vectors read those;
* vocabulary: terms in >= ``min_df`` documents, the ``max_features`` most
  frequent (ties by term).  Counts per hash bucket bound the count of each of their
  terms from above, so only terms of heavy buckets are counted by name;
* weights: raw counts x smooth idf ``ln((1+n)/(1+df)) + 1``, L2-normalised;
* K-Means (:mod:`caseflow.operators.kmeans`): ``n_init`` starts, the lowest cost wins.

The vocabulary is capped by ``max_features``, so it is the only thing brought
to the driver (to build the vectors); documents never are.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, NGram, Normalizer, StopWordsRemover
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from caseflow.fixed import ENGLISH_STOP_WORDS, MISSING_ID, THEME_LABEL_SEP, THEME_OTHER
from caseflow.functions.columns import strip_ws
from caseflow.operators.kmeans import SCALE, assign, best_start
from caseflow.session import stage

TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
#: Buckets of the vocabulary's counts, and how many heavy ones are looked into first, for each term wanted.
BUCKETS, HEAVY_PER_TERM = 2**18, 4
#: Tokens of one block of texts while vectors are built.
BLOCK_TOKENS = 500_000
#: Steps of the weights that are summed per cluster, and clusters that a task holds sums of.
MEAN_SCALE, HELD_CLUSTERS = 2**36, 256

THEME_SCHEMA = T.StructType(
    [
        T.StructField("theme_id", T.LongType()),
        T.StructField("category", T.StringType()),
        T.StructField("theme_label", T.StringType()),
        T.StructField("ticket_count", T.LongType()),
        T.StructField("top_terms", T.StringType()),
        T.StructField("avg_csat", T.DoubleType()),
        T.StructField("sla_breach_rate", T.DoubleType()),
        T.StructField("transfer_rate", T.DoubleType()),
        T.StructField("sample_ticket_ids", T.StringType()),
    ]
)


def theme_text(df: DataFrame, min_chars: int = 15) -> DataFrame:
    """P29 + F6: ``strip(message + ' ' + notes)`` and its usability flag."""
    text = strip_ws(F.concat(F.coalesce(F.col("customer_message"), F.lit("")), F.lit(" "), F.coalesce(F.col("agent_notes"), F.lit(""))))
    return df.withColumn("theme_text", text).withColumn("usable", F.length("theme_text") >= min_chars)


def usable_texts(df: DataFrame, min_chars: int = 15) -> DataFrame:
    return theme_text(df, min_chars).filter("usable").drop("usable")


def _usable(df: DataFrame) -> Column:
    return F.col("usable") if "usable" in df.columns else F.lit(True)


def add_tokens(df: DataFrame, stop_words: list[str] = ENGLISH_STOP_WORDS) -> DataFrame:
    """M2, M3: ``tokens``, the words of a text but for the stop words.

    With a ``usable`` column (from :func:`theme_text`), rows that are not usable
    get no tokens and keep the flag.  Gating the tokeniser this way, instead of
    filtering first, keeps Catalyst from pushing ``length(clean(text))`` below
    the projection, where the text clean would run twice per row.
    """
    words = F.regexp_extract_all(F.lower(F.col("theme_text")), F.lit(TOKEN_PATTERN), 0)
    gated = df.withColumn("_tokens", F.when(_usable(df), words).otherwise(F.array().cast("array<string>")))
    return StopWordsRemover(inputCol="_tokens", outputCol="tokens", stopWords=list(stop_words), caseSensitive=True).transform(gated).drop("_tokens")


def with_bigrams(tokens: DataFrame) -> DataFrame:
    """M4: ``terms``, the tokens followed by their bigrams, in place of ``tokens``."""
    grams = NGram(n=2, inputCol="tokens", outputCol="_bigrams").transform(tokens)
    return grams.withColumn("terms", F.concat("tokens", "_bigrams")).drop("tokens", "_bigrams")


def add_terms(df: DataFrame, stop_words: list[str] = ENGLISH_STOP_WORDS) -> DataFrame:
    """M2-M4: ``terms`` = unigrams (stop words removed) followed by their bigrams."""
    return with_bigrams(add_tokens(df, stop_words))


def staged_tokens(df: DataFrame, columns: list[str], min_chars: int = 15, reuse: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``columns`` and the tokens of the usable texts, tokenised once and staged."""
    texts = theme_text(df.select(*dict.fromkeys([*columns, "customer_message", "agent_notes"])), min_chars)
    # the filter comes after the staged table, a plan barrier, so the text clean is not run again inside it
    return (reuse or stage)(add_tokens(texts).select(*columns, "tokens", "usable")).where("usable").drop("usable")


def term_statistics(terms: DataFrame) -> DataFrame:
    """``term, document_frequency, corpus_frequency, n_docs`` in one pass.

    One generator per document yields every term occurrence (corpus frequency),
    the document's distinct terms (document frequency) and, for a usable
    document, one NULL-term marker; the NULL-term row's ``n_docs`` is the number
    of documents.  Everything is pre-aggregated by term before the one shuffle,
    so each text is tokenised once and no per-document data reaches a single task.
    """

    def tagged(arr: Column, all_: int, doc: int) -> Column:
        return F.transform(arr, lambda t: F.struct(t.alias("term"), F.lit(all_).alias("_all"), F.lit(doc).alias("_doc")))

    marker = F.array(F.lit(None).cast("string"))
    usable = _usable(terms)
    both = F.concat(
        tagged(F.col("terms"), 1, 0),
        tagged(F.array_distinct("terms"), 0, 1),
        tagged(F.filter(marker, lambda _: usable), 0, 1),
    )
    # explode_outer: plain explode makes Spark infer a ``size(...) > 0`` filter,
    # which evaluates the tokeniser a second time.
    rows = terms.select(F.explode_outer(both).alias("_t")).select("_t.term", "_t._all", "_t._doc")
    is_term = F.col("term").isNotNull()
    return rows.groupBy("term").agg(
        F.sum(F.when(is_term, F.col("_doc"))).cast("long").alias("document_frequency"),
        F.sum(F.when(is_term, F.col("_all"))).cast("long").alias("corpus_frequency"),
        F.sum(F.when(~is_term, F.col("_doc"))).cast("long").alias("n_docs"),
    )


def _top_terms(stats: DataFrame, min_df: int, max_features: int, keep_marker: bool) -> DataFrame:
    keep = F.col("document_frequency") >= min_df
    if keep_marker:
        # The marker row sorts first; the condition mixes an aggregate output in,
        # so no part of it is pushed below the aggregation.
        keep = keep | F.col("term").isNull()
    return stats.filter(keep).orderBy(F.col("term").isNull().desc(), F.desc("corpus_frequency"), "term").limit(
        max_features + (1 if keep_marker else 0)
    )


def vocabulary(terms: DataFrame, min_df: int = 2, max_features: int = 5000) -> DataFrame:
    """M5: ``term, document_frequency, corpus_frequency`` of the kept vocabulary:
    terms in >= ``min_df`` documents, the ``max_features`` most frequent (ties by term)."""
    top = _top_terms(term_statistics(terms), min_df, max_features, keep_marker=False)
    return top.select("term", "document_frequency", "corpus_frequency")


def with_idf(vocab: DataFrame, n_docs: DataFrame) -> DataFrame:
    """Smooth idf ``ln((1+n)/(1+df)) + 1`` per vocabulary term."""
    return vocab.crossJoin(n_docs).withColumn(
        "idf", F.log((F.col("n_docs") + 1.0) / (F.col("document_frequency") + 1.0)) + 1.0
    ).drop("n_docs")


def _vocabulary_idf_counted(terms: DataFrame, min_df: int, max_features: int) -> DataFrame:
    top = _top_terms(term_statistics(terms), min_df, max_features, keep_marker=True)
    # The document count travels as the marker row of the (at most
    # ``max_features + 1`` rows) top list; a window over that bounded list spreads it.
    n = F.coalesce(F.max("n_docs").over(Window.partitionBy()), F.lit(0))
    return (
        top.withColumn("n_docs", n)
        .filter(F.col("term").isNotNull())
        .select(
            "term",
            "document_frequency",
            "corpus_frequency",
            (F.log((F.col("n_docs") + 1.0) / (F.col("document_frequency") + 1.0)) + 1.0).alias("idf"),
            "n_docs",
        )
    )


def vocabulary_idf(terms: DataFrame, min_df: int = 2, max_features: int = 5000) -> DataFrame:
    """M5 + idf from a single pass over ``terms``: ``term, document_frequency,
    corpus_frequency, idf``."""
    return _vocabulary_idf_counted(terms, min_df, max_features).drop("n_docs")


#: Factors of the hashes of a term's first and second word.
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _word_hashes(terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first words of ``terms`` and of the second ones, 0 where there is none."""
    words = [t.partition(" ") for t in terms.to_pylist()]
    return tuple(np.fromiter((zlib.crc32(w[i].encode()) for w in words), np.uint64, len(words)) for i in (0, 2))


def _bucket(first: np.ndarray, second: np.ndarray, n: int) -> np.ndarray:
    return ((first * _FIRST + second * _SECOND) >> np.uint64(24)) % np.uint64(n)


def _terms_of(lists: pa.ListArray, sizes: np.ndarray, paired: bool, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Every term of some texts: its text, its number, its bucket of ``n``, and the words of the numbers.

    Numbers from the number of words on are bigrams (``paired``: of neighbours in one text).
    """
    flat = lists.flatten().dictionary_encode()
    words, codes = flat.dictionary, flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    first, second = _word_hashes(words)
    bucket = _bucket(first, second, n)[codes]
    if not paired:
        return doc, codes, bucket, words
    joined = np.flatnonzero(doc[:-1] == doc[1:])
    a, b = codes[joined], codes[joined + 1]
    numbers, buckets = len(words) * (1 + a) + b, _bucket(first[a], first[b], n)
    return np.concatenate([doc, doc[joined]]), np.concatenate([codes, numbers]), np.concatenate([bucket, buckets]), words


def _names(numbers: np.ndarray, words: pa.Array) -> pa.Array:
    """The terms of the numbers that :func:`_terms_of` gave."""
    single, (a, b) = numbers < len(words), np.divmod(numbers - len(words), max(len(words), 1))
    ones = words.take(pa.array(np.where(single, numbers, a)))
    twos = pc.binary_join_element_wise(ones, words.take(pa.array(np.where(single, 0, b))), " ")
    return pc.if_else(pa.array(single), ones, twos)


def _term_column(terms: DataFrame) -> str:
    """``terms`` holds lists of terms, ``tokens`` the words that are terms with their bigrams."""
    return "tokens" if "tokens" in terms.columns else "terms"


def bucket_totals(terms: DataFrame, joint: DataFrame | None = None) -> tuple[np.ndarray, int]:
    """Occurrences of the terms of each of the ``BUCKETS`` hash buckets, and the number of rows of ``terms``.

    A task counts in one array, so neither terms nor their occurrences leave it.
    """
    n, column = BUCKETS, _term_column(terms)

    def sent(totals: np.ndarray) -> pa.RecordBatch:
        seen = np.flatnonzero(totals)
        return pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(totals[seen], pa.int64())], names=["bucket", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(n + 1, dtype=np.int64)
        for part, sizes in _text_parts(batches, column):
            totals[:-1] += np.bincount(_terms_of(part.column(column), sizes, column == "tokens", n)[2].astype(np.int64), minlength=n)
            totals[-1] += part.num_rows
        yield sent(totals)

    def run_joint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(n + 1, dtype=np.int64)
        for batch in batches:
            np.add.at(totals, _bucket(*_word_hashes(batch.column("term")), n).astype(np.int64), batch.column("tf").to_numpy(zero_copy_only=False))
        yield sent(totals)

    rows = terms.select(column).mapInArrow(run, "bucket long, n long")
    if joint is not None:
        rows = rows.unionByName(joint.select("term", "tf").mapInArrow(run_joint, "bucket long, n long"))
    counted = rows.groupBy("bucket").agg(F.sum("n").alias("total")).toArrow()
    totals = np.zeros(n + 1, dtype=np.int64)
    totals[counted.column("bucket").to_numpy()] = counted.column("total").to_numpy()
    return totals[:-1], int(totals[-1])


def count_terms(terms: DataFrame, buckets: np.ndarray, joint: DataFrame | None = None) -> DataFrame:
    """``term, document_frequency, corpus_frequency`` of the terms whose bucket is in ``buckets``.

    Only these terms become strings and leave the task, one row for each and some texts.
    """
    n, column = BUCKETS, _term_column(terms)
    wanted = np.zeros(n, dtype=bool)
    wanted[buckets] = True
    schema = "term string, doc long, all long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sizes in _text_parts(batches, column):
            doc, numbers, bucket, words = _terms_of(part.column(column), sizes, column == "tokens", n)
            heavy = wanted[bucket]
            kept, own = np.unique(numbers[heavy], return_inverse=True)
            by_text = np.unique(doc[heavy] * max(len(kept), 1) + own) % max(len(kept), 1)
            counts = (np.bincount(x, minlength=len(kept)) for x in (by_text, own))
            yield pa.RecordBatch.from_arrays([_names(kept, words), *(pa.array(c, pa.int64()) for c in counts)], names=["term", "doc", "all"])

    def run_joint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heavy = pa.array(wanted[_bucket(*_word_hashes(batch.column("term")), n)])
            kept = batch.filter(heavy)
            yield pa.RecordBatch.from_arrays([kept.column("term"), pa.array(np.ones(kept.num_rows), pa.int64()), kept.column("tf")], names=["term", "doc", "all"])

    rows = terms.select(column).mapInArrow(run, schema)
    if joint is not None:
        rows = rows.unionByName(joint.select("term", "tf").mapInArrow(run_joint, schema))
    return rows.groupBy("term").agg(F.sum("doc").alias("document_frequency"), F.sum("all").alias("corpus_frequency"))


def heavy_vocabulary(terms: DataFrame, min_df: int = 2, max_features: int = 5000, joint: DataFrame | None = None, n_joint: int = 0) -> tuple[list, int]:
    """M5 on the driver: the kept terms as rows ``(term, document_frequency, corpus_frequency, idf)`` by term, and the number of documents.

    A bucket's total is at least the count of each of its terms.  The terms of the
    heaviest buckets are counted by name; their ``max_features``-th count is a lower
    bound of the vocabulary's last one, so a term outside can only enter from a bucket
    whose total reaches it.  If there are such buckets, they are counted too.  The
    shuffles carry bucket totals and the terms of heavy buckets, not every term.
    ``terms``: lists of ``terms``, or of ``tokens``, whose bigrams are terms too.  ``joint``: counts
    ``(term, tf)`` of ``n_joint`` further documents, one row per document and term.
    """
    totals, n_docs = bucket_totals(terms, joint)
    n_docs += n_joint
    by_weight = np.argsort(-totals, kind="stable")
    by_weight = by_weight[totals[by_weight] > 0]
    taken, others = np.split(by_weight, [HEAVY_PER_TERM * max_features])

    def top(buckets: np.ndarray) -> list:
        kept = count_terms(terms, buckets, joint).where(F.col("document_frequency") >= min_df)
        return kept.orderBy(F.desc("corpus_frequency"), "term").limit(max_features).collect()

    rows = top(taken)
    floor = rows[-1]["corpus_frequency"] if len(rows) == max_features else 0
    missed = others[totals[others] >= floor]
    if len(missed):
        rows = sorted(rows + top(missed), key=lambda r: (-r["corpus_frequency"], r["term"].encode()))[:max_features]
    idf = lambda df: float(np.log((n_docs + 1.0) / (df + 1.0)) + 1.0)
    return sorted((r["term"], r["document_frequency"], r["corpus_frequency"], idf(r["document_frequency"])) for r in rows), n_docs


def _text_parts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Some texts at a time, and how many words of ``column`` each has."""
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, low = np.cumsum(sizes), 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(ends, ends[low] - sizes[low] + BLOCK_TOKENS, "right")))
            yield batch.slice(low, high - low), sizes[low:high]
            low = high


def _vector_parts(batches: Iterator[pa.RecordBatch], vocab: list) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Some texts at a time: their rows, and the :func:`_vectors` of their tokens."""
    known, weight = pa.array([r[0] for r in vocab], pa.string()), np.array([r[-1] for r in vocab])
    for part, sizes in _text_parts(batches, "tokens"):
        yield part, *_vectors(part.column("tokens"), sizes, known, weight)


def _vectoriser(vocab: list, carry: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, idx, w, starts in _vector_parts(batches, vocab):
            w = np.rint(w * SCALE).astype(np.int64)
            lists = [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(x, pa.int32())) for x in (idx, w)]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carry), *lists], names=[*carry, "idx", "w"])

    return run


def _vectors(tokens: pa.ListArray, sizes: np.ndarray, known: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term numbers and L2-normalised weights of some texts, flat, and where each text starts."""
    flat = tokens.flatten()
    doc = np.repeat(np.arange(len(sizes)), sizes)
    pairs = pc.binary_join_element_wise(flat[:-1], flat[1:], " ") if len(flat) > 1 else flat[:0]
    number = lambda a: pc.fill_null(pc.index_in(a, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    one, two = number(flat), number(pairs)
    keep_one, keep_two = one >= 0, (two >= 0) & (doc[:-1] == doc[1:])[: len(two)]
    keys = np.concatenate([doc[keep_one] * len(idf) + one[keep_one], doc[: len(two)][keep_two] * len(idf) + two[keep_two]])
    keys, tf = np.unique(keys, return_counts=True)
    doc, idx = np.divmod(keys, len(idf))
    w = tf * idf[idx]
    norm = np.sqrt(np.bincount(doc, weights=w * w, minlength=len(sizes)))
    starts = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(sizes)))])
    return idx, w / norm[doc], starts


def theme_points(tokens: DataFrame, vocab: list) -> DataFrame:
    """M6 for the K-Means: ``idx array<int>``, the numbers of a text's terms in ``vocab`` (term, ..., idf), and ``w array<int>``, its L2-normalised weights times ``SCALE``."""
    carry = [c for c in tokens.columns if c != "tokens"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema.fields if f.name != "tokens")
    return tokens.mapInArrow(_vectoriser(vocab, carry), f"{schema}, idx array<int>, w array<int>")


def tfidf_features(terms: DataFrame, vocab_rows: list) -> DataFrame:
    """M6: L2-normalised TF-IDF sparse vectors in column ``features``.

    ``vocab_rows`` are (term, idf) pairs, at most ``max_features`` of them, in
    alphabetical order (the feature index order).
    """
    words = [r["term"] for r in vocab_rows]
    idf = Vectors.dense([float(r["idf"]) for r in vocab_rows])
    tf = CountVectorizerModel.from_vocabulary(words, inputCol="terms", outputCol="_tf").transform(terms)
    weighted = ElementwiseProduct(scalingVec=idf, inputCol="_tf", outputCol="_tfidf").transform(tf)
    return Normalizer(p=2.0, inputCol="_tfidf", outputCol="features").transform(weighted).drop("_tf", "_tfidf")


def cluster_means(tokens: DataFrame, vocab: list) -> DataFrame:
    """A20 from the tokens of texts ``(cluster int, tokens)``: ``cluster, idx, weight``, sums that rank a cluster's terms as their means do.

    A task adds up its texts' TF-IDF weights as whole numbers of 1 / ``MEAN_SCALE`` and sends
    one row per cluster and term, so equal means stay equal in any order of texts.
    """
    schema = "cluster int, idx int, weight long"

    def rows(held: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for cluster, sums in held.items():
            seen = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array([cluster] * len(seen), pa.int32()), pa.array(seen, pa.int32()), pa.array(sums[seen], pa.int64())], names=["cluster", "idx", "weight"])
        held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for part, idx, w, starts in _vector_parts(batches, vocab):
            own = np.repeat(part.column("cluster").to_numpy(zero_copy_only=False), np.diff(starts))
            w = np.rint(w * MEAN_SCALE).astype(np.int64)
            for cluster in np.unique(own):
                mine = own == cluster
                np.add.at(held.setdefault(int(cluster), np.zeros(len(vocab), dtype=np.int64)), idx[mine], w[mine])
                if len(held) >= HELD_CLUSTERS:
                    yield from rows(held)
        yield from rows(held)

    parts = tokens.select("cluster", "tokens").mapInArrow(run, schema)
    return parts.groupBy("cluster", "idx").agg(F.sum(F.col("weight").cast("decimal(20,0)")).alias("weight"))


def cluster_sums(assigned: DataFrame) -> DataFrame:
    """A20 from whole-number weights, as sums, which rank a cluster's terms alike."""
    pairs = assigned.select("cluster", F.explode(F.arrays_zip("idx", "w")).alias("t"))
    return pairs.groupBy("cluster", F.col("t.idx").alias("idx")).agg(F.sum(F.col("t.w").cast("long")).alias("weight"))


def summarize_clusters(assigned: DataFrame, weights: DataFrame, vocab_index: DataFrame, top_n: int = 8, sample_n: int = 8) -> DataFrame:
    """M8 (A18-A20, W7, W8, P30) on ``assigned`` rows (cluster, ...) and the term ``weights`` of each cluster."""
    stats = assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).cast("long").alias("ticket_count"),
        F.avg("csat_score").alias("avg_csat"),
        F.avg(F.coalesce(F.col("sla_breach"), F.lit(False)).cast("double")).alias("sla_breach_rate"),
        F.avg((F.coalesce(F.col("transfers"), F.lit(0.0)) > 0).cast("double")).alias("transfer_rate"),
    )
    # The k statistic rows ride along the ranking; a term that no text of the cluster has weighs 0
    stat_cols = ["cluster", "ticket_count", "avg_csat", "sla_breach_rate", "transfer_rate"]
    weighed = stats.crossJoin(F.broadcast(vocab_index)).join(weights, ["cluster", "idx"], "left")
    ranked_terms = weighed.withColumn(
        "_r", F.row_number().over(Window.partitionBy("cluster").orderBy(F.coalesce("weight", F.lit(0)).desc(), F.desc("term")))
    ).filter(F.col("_r") <= top_n)
    themes = ranked_terms.groupBy(*stat_cols).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_r", "term"))), lambda s: s["term"]).alias("_terms")
    )

    # The first ticket ids of each cluster in id order.
    samples = (
        assigned.select("cluster", "ticket_id")
        .withColumn("_r", F.row_number().over(Window.partitionBy("cluster").orderBy(F.asc_nulls_last("ticket_id"))))
        .filter(F.col("_r") <= sample_n)
        .groupBy("cluster")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "ticket_id"))), lambda s: F.coalesce(s["ticket_id"], F.lit(MISSING_ID))), ", ").alias("sample_ticket_ids"))
    )

    # Most frequent non-null category, ties to the one seen first (lowest ticket id).
    cats = (
        assigned.filter(F.col("category").isNotNull())
        .groupBy("cluster", "category")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("ticket_id").alias("_first"))
        .withColumn("_r", F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("_n"), F.asc_nulls_last("_first"), "category")))
        .filter(F.col("_r") == 1)
        .select("cluster", F.col("category").alias("_dominant"))
    )

    out = themes.join(samples, "cluster", "left").join(cats, "cluster", "left")
    category = F.coalesce(F.col("_dominant"), F.lit(THEME_OTHER))
    terms_col = F.coalesce(F.col("_terms"), F.array().cast("array<string>"))
    return out.select(
        F.col("cluster").cast("long").alias("theme_id"),
        category.alias("category"),
        F.concat(category, F.lit(THEME_LABEL_SEP), F.array_join(F.slice(terms_col, 1, 3), ", ")).alias("theme_label"),
        "ticket_count",
        F.array_join(terms_col, ", ").alias("top_terms"),
        "avg_csat",
        "sla_breach_rate",
        "transfer_rate",
        "sample_ticket_ids",
    ).orderBy(F.desc("ticket_count"), "theme_id")


TICKET_COLUMNS = ["ticket_id", "category", "csat_score", "sla_breach", "transfers"]


def complaint_themes(
    df: DataFrame,
    n_clusters: int = 8,
    seed: int = 42,
    n_init: int = 10,
    min_df: int = 2,
    max_features: int = 5000,
    min_chars: int = 15,
    reuse: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """M1-M8.  ``df`` needs ticket_id, customer_message, agent_notes, category,
    csat_score, sla_breach, transfers.  ``reuse`` materialises the tokens, the
    points and their clusters (default: ``caseflow.session.stage``).
    """
    spark, reuse = df.sparkSession, reuse or stage
    tokens = staged_tokens(df, TICKET_COLUMNS, min_chars, reuse)
    vocab, n_docs = heavy_vocabulary(tokens.select("tokens"), min_df, max_features)
    # M1: fewer than 10 usable texts (or no vocabulary) -> empty table
    if not vocab or n_docs < 10:
        return spark.createDataFrame([], THEME_SCHEMA)
    points = reuse(theme_points(tokens, vocab).withColumnRenamed("ticket_id", "id"))
    centres = best_start(points, max(2, min(n_clusters, n_docs)), len(vocab), n_init, seed)
    assigned = reuse(assign(points, centres).withColumnRenamed("id", "ticket_id"))
    vocab_index = spark.createDataFrame([(i, r[0]) for i, r in enumerate(vocab)], "idx int, term string")
    return summarize_clusters(assigned, cluster_sums(assigned), vocab_index)


def _weigher(vocab: list, id_type: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array([r[0] for r in vocab], pa.string())
        for part, idx, w, starts in _vector_parts(batches, vocab):
            ids = part.column("ticket_id").take(pa.array(np.repeat(np.arange(part.num_rows), np.diff(starts))))
            yield pa.RecordBatch.from_arrays([ids.cast(id_type), known.take(pa.array(idx)), pa.array(w, pa.float64())], names=["ticket_id", "term", "weight"])

    return run


def theme_tfidf(df: DataFrame, min_df: int = 2, max_features: int = 5000, min_chars: int = 15) -> DataFrame:
    """M6 in long form: ``ticket_id, term, weight``, the L2-normalised TF-IDF weights of every usable text.

    Texts are weighed where their tokens lie.  Only texts that share a ticket id, which
    count as one, are put together by a shuffle of their terms.
    """
    tokens = staged_tokens(df, ["ticket_id"], min_chars)
    shared = stage(tokens.groupBy("ticket_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("ticket_id").alias("_id")))
    same = tokens["ticket_id"].eqNullSafe(shared["_id"])
    terms = with_bigrams(tokens.join(shared, same, "left_semi")).select("ticket_id", F.explode("terms").alias("term"))
    joint = stage(terms.groupBy("ticket_id", "term").agg(F.count(F.lit(1)).alias("tf")))
    single = tokens.join(shared, same, "left_anti")
    vocab, _ = heavy_vocabulary(single.select("tokens"), min_df, max_features, joint, shared.count())
    id_type = tokens.schema["ticket_id"].dataType
    weighed = single.mapInArrow(_weigher(vocab, to_arrow_type(id_type)), f"ticket_id {id_type.simpleString()}, term string, weight double")
    idf = tokens.sparkSession.createDataFrame([(r[0], r[-1]) for r in vocab], "term string, idf double")
    weighted = joint.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("ticket_id")))
    return weighed.unionByName(weighted.select("ticket_id", "term", (F.col("w") / norm).alias("weight")))


def theme_summary(df: DataFrame, cluster: str, min_df: int = 2, max_features: int = 5000, min_chars: int = 15) -> DataFrame:
    """M8 over a given assignment (the text column ``cluster``) instead of K-Means clusters.

    Clusters are numbered by the order of their names, from 0.
    """
    tokens = staged_tokens(df, list(dict.fromkeys([*TICKET_COLUMNS, cluster])), min_chars)
    kept, _ = heavy_vocabulary(tokens.select("tokens"), min_df, max_features)
    index = df.sparkSession.createDataFrame([(i, r[0]) for i, r in enumerate(kept)], "idx int, term string")
    names = df.select(F.col(cluster).alias("_name")).distinct()
    # staged, so that its measured size decides how it is joined and the texts are not moved for a few names
    numbered = stage(names.withColumn("cluster", F.row_number().over(Window.orderBy("_name")) - 1))
    assigned = tokens.join(numbered, tokens[cluster].eqNullSafe(numbered["_name"]))
    return summarize_clusters(assigned.drop("tokens"), cluster_means(assigned, kept), index)


def theme_vocabulary(df: DataFrame, min_df: int = 2, max_features: int = 5000, min_chars: int = 15) -> DataFrame:
    """M2-M5 as a table: ``term, document_frequency, corpus_frequency, idf``."""
    kept, _ = heavy_vocabulary(staged_tokens(df, [], min_chars), min_df, max_features)
    return df.sparkSession.createDataFrame(kept, "term string, document_frequency long, corpus_frequency long, idf double")
