"""The corpus pipeline against a plain version of its stages."""

from __future__ import annotations

import glob
import random
import zlib

import corpus_pipeline
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from caseflow.llm import bounded_ring, kn_quality, pfair_mix, setsketch_dedup
from tests.llm import brute
from tests.llm.test_operators import CLASHING, SCHEMA, frame, odd_rows, prose


def write(spark, tmp_path, rows, items, extra=None):
    docs = frame(spark, rows)
    if extra is not None:
        docs = docs.unionByName(extra)
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_pipeline_equals_plain_stages(spark, tmp_path):
    rng = random.Random(11)
    items = [(i, ". ".join(prose(rng, 12) for _ in range(3)) + ".") for i in range(6)]
    rows = odd_rows()
    rows += [(100 + i, prose(rng, 90) + " " + t + " " + prose(rng, 90), "en", "a") for i, t in items]
    rows += [(200 + i, rows[30][1], "en", "b") for i in range(5)]
    sf = write(spark, tmp_path, rows, items)
    got = corpus_pipeline.run(spark, sf).collect()

    verdict = {r["doc_id"]: r["kept"] for r in kn_quality.quality_rules(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    docs = [(d, t) for d, t, *_ in rows if not brute.quality(t)[5] and verdict[d]]
    kept = {d for d, v in brute.near_duplicates(docs).items() if v[2]}
    want = {d: t for d, t in docs if d in kept and not any(i in t for _, i in items)}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in got} == {d: (len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in want.items()}
    sizes = {}
    for r in got:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + 1
    assert max(sizes.values()) - min(sizes.values() if len(sizes) == 16 else [0]) <= 1


def test_stages_keep_columns_and_repeated_rows_leave_one(spark, tmp_path):
    rng = random.Random(12)
    text = prose(rng, 120)
    rows = [(1, text, "en", "a"), (1, text, "en", "a"), (2, text, "en", "b"), (3, prose(rng, 100), None, None), (None, prose(rng, 100), "en", "a"), (None, None, None, None)]
    sf = write(spark, tmp_path, rows, [(1, "a benchmark item that nobody holds")])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == columns
    assert all(r[c] == "x" for r in docs.collect() for c in CLASHING)
    assert sorted(str(r["doc_id"]) for r in docs.collect()) == ["1", "3", "None"]
    assert corpus_pipeline.shard(spark, docs, sf).count() == 3


def test_mixed_order_is_written(spark, tmp_path):
    rng = random.Random(13)
    sf = write(spark, tmp_path, [(i, prose(rng, 60), "en", "ab"[i % 3 == 0]) for i in range(400)], [(1, "x")])
    docs = corpus_pipeline.mix(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    first = [r["source"] for r in docs.limit(100).collect()]
    assert 30 <= first.count("b") <= 70


def slots_in_order(spark, sf, docs):
    """(shard, slot) of every document after the last stage, and the documents of the folder in order."""
    path = f"{sf}/mixed-{id(docs)}"
    docs.write.option("maxRecordsPerFile", 30).parquet(path)
    files = sorted(glob.glob(f"{path}/part-*.parquet"))
    order = [d for f in files for d in pq.read_table(f, columns=["doc_id"])["doc_id"].to_pylist()]
    return {r["doc_id"]: (r["shard"], r["slot"]) for r in corpus_pipeline.shard(spark, spark.read.parquet(path), sf).collect()}, order


def test_shards_keep_the_mixed_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bounded_ring, "RUN_ROWS", 8)
    rng = random.Random(14)
    sf = write(spark, tmp_path, [(i, prose(rng, 20 + i % 50), "en", "ab"[i % 3 == 0]) for i in range(600)], [(1, "x")])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plain, order = slots_in_order(spark, sf, corpus_pipeline.mix(spark, docs, sf))
    assert len(plain) == 600
    for shard in range(16):
        held = [d for d in order if plain[d][0] == shard]
        assert [plain[d][1] for d in held] == list(range(len(held)))

    mixed = pfair_mix.mix_sources
    monkeypatch.setattr(corpus_pipeline, "mix_sources", lambda *a, **k: mixed(*a, **k, weights={"a": 9.0, "b": 1.0}))
    other, _ = slots_in_order(spark, sf, corpus_pipeline.mix(spark, docs, sf))
    assert sum(plain[d] != other[d] for d in plain) > 100


def test_run_ends_in_the_mixed_order(spark, tmp_path, monkeypatch):
    """The output of run() differs with and without its fourth stage."""
    rng = random.Random(15)
    sf = write(spark, tmp_path, [(i, prose(rng, 80), "en", "ab"[i % 3 == 0]) for i in range(300)], [(1, "x")])
    full = {r["doc_id"]: r["slot"] for r in corpus_pipeline.run(spark, sf).collect()}
    monkeypatch.setattr(corpus_pipeline, "STAGES", [s for s in corpus_pipeline.STAGES if s[0] != "mixing"])
    short = {r["doc_id"]: r["slot"] for r in corpus_pipeline.run(spark, sf).collect()}
    assert full.keys() == short.keys() and full != short


def test_near_copies_from_four_fifths_up_leave_one(spark, tmp_path):
    """Pairs of 196 and 90 shingles with changed words, each of which changes five shingles."""
    rng = random.Random(16)

    def pair(words, changed):
        base = prose(rng, words).split()
        other = [f"other{i}" if i % 12 == 6 and i // 12 < changed else w for i, w in enumerate(base)]
        return " ".join(base), " ".join(other)

    # similarities 191/201, 181/211, 176/216 = 0.815 (four times), 171/221 = 0.774, and 80/100 exactly
    cases = [(200, 1, True), (200, 3, True), *[(200, 4, True)] * 4, (200, 5, False), (200, 6, False), (94, 2, True)]
    rows, want = [], set()
    for i, (words, changed, linked) in enumerate(cases):
        a, b = pair(words, changed)
        rows += [(10 * i, a, "en", "a"), (10 * i + 1, b, "en", "b")]
        want |= {10 * i} if linked else {10 * i, 10 * i + 1}
    rows += [(1000 + i, prose(rng, 150), "en", "a") for i in range(40)]
    sf = write(spark, tmp_path, rows, [(1, "x")])
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect()}
    assert {d for d in got if d < 1000} == want


def test_bands_follow_the_similarity():
    assert [setsketch_dedup.band_rows(n) for n in (85, 80)] == [6, 5]
    for num in (70, 80, 85, 95):
        n = setsketch_dedup.band_rows(num)
        assert (1 - (num / 100) ** n) ** (setsketch_dedup.REGISTERS // n) <= setsketch_dedup.MISS


def test_pipeline_on_empty_tables(spark, tmp_path):
    sf = write(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, sf).count() == 0
    assert spark.createDataFrame([], SCHEMA).select(F.count("*")).first()[0] == 0
