"""The training-data operators against plain versions, and on odd rows."""

from __future__ import annotations

import math
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from caseflow.llm import brown_lm, kn_quality, latent_decontam, mincut_html, pfair_mix, secret_scan, setsketch_dedup, token_counts, warc
from caseflow.llm.bounded_ring import assign_shards, plan_pieces, shard_digest
from caseflow.llm.components import components
from tests.llm import brute

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
WORDS = "the of and to in river stone light garden engine paper window morning quiet table silver maple token".split()
#: Extra columns with names that the operators use inside or return.
CLASHING = ["slot", "shard", "_row", "node", "key", "label", "n", "word", "_text", "stream", "position", "lo", "_key", "_gone_id", "_again_id", "lang_", "n_words", "kept"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(60)) for _ in range(n))


def odd_rows():
    """Nulls, empty, blank and very long texts, ties, copies, near copies and repeated rows."""
    rng = random.Random(5)
    base = prose(rng, 200).split()
    near = [" ".join([*base[:i], "changed", *base[i + 1 :]]) for i in (3, 90, 190)]
    far = " ".join(w if i % 4 else "x" + w for i, w in enumerate(base))
    texts = [
        None, "", " \t\n ", "one", "one two three four five", "One Two THREE four five", " ".join(base), " ".join(base), *near, far,
        prose(rng, 60_000), "x" * 300_000, "a b c " * 400, 'password = "hunter22x" AKIA' + "A" * 16 + " " + "0a1b" * 8,
        "Straße naïve 東京 <|endoftext|> it's 12 İ", "token=secret=abcdef token: tokenabc", *[prose(rng, rng.randrange(40, 300)) for _ in range(30)],
    ]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", None])) for i, t in enumerate(texts)]
    return rows


def frame(spark, rows):
    full = [(d, t, lang, src, len(t) if t is not None else None, *["x"] * len(CLASHING)) for d, t, lang, src in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, odd_rows()).repartition(4).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def repeated(spark):
    """Repeated rows, one id with two texts, and null ids."""
    rows = odd_rows()
    return frame(spark, [*rows[:12], *rows[:12], (6, "another text under an id that is taken " * 9, "en", "a"), (None, rows[6][1], "en", "b"), (None, None, None, None)])


def test_shards_are_even_and_gapless(odd, repeated, empty):
    for df in (odd, repeated, empty):
        got = shard_digest(df, 5).collect()
        assert len(got) == df.count()
        slots = {}
        for r in got:
            slots.setdefault(r["shard"], []).append(r["slot"])
        sizes = [len(slots.get(s, [])) for s in range(5)]
        assert max(sizes) - min(sizes) <= 1
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    want = sorted((d, len((t or "").encode()) + 1) for d, t, *_ in odd_rows())
    assert sorted((r["doc_id"], r["size"]) for r in shard_digest(odd, 5).collect()) == want


def test_shards_of_a_hot_row_and_limited_movement(spark):
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("doc_id"))
    counts = {r["shard"]: r["count"] for r in assign_shards(hot, 7).groupBy("shard").count().collect()}
    assert sum(counts.values()) == 3000 and max(counts.values()) - min(counts.values()) <= 1
    rows = spark.range(4000).withColumnRenamed("id", "doc_id")
    before = {r["doc_id"]: r["shard"] for r in assign_shards(rows, 8, slack=0.25).collect()}
    after = {r["doc_id"]: r["shard"] for r in assign_shards(rows, 9, slack=0.25).collect()}
    assert sum(before[d] != after[d] for d in before) < 0.35 * len(before)


def test_overflow_goes_clockwise():
    got = plan_pieces([5, 1, 0], [0, 1, 2], [2, 2, 2])
    assert [(p["arc"], p["lo"], p["hi"], p["shard"]) for p in got] == [(0, 0, 2, 0), (1, 0, 1, 1), (0, 2, 3, 1), (0, 3, 5, 2)]


def test_lm_base_score_and_held_out_gain(spark, odd, repeated, empty):
    rows = {r["doc_id"]: r for r in brown_lm.lm_scores(odd).collect()}
    for d, (held, n, known, total, score) in brute.unigram([(d, t) for d, t, *_ in odd_rows()]).items():
        r = rows[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(score, rel=1e-9)
        assert r["score"] < 0
    assert brown_lm.lm_scores(empty).count() == 0
    assert brown_lm.lm_scores(repeated).count() == repeated.count()


def test_lm_scores_beat_the_base(spark):
    rng = random.Random(1)
    a, b = [[f"{x}{i}" for i in range(40)] for x in "ab"]
    docs = [(i, " ".join(rng.choice((a, b)[(i + k) % 2]) for k in range(60)), "en", "s") for i in range(300)]
    rows = brown_lm.lm_scores(frame(spark, docs)).where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) + 0.2 * sum(r["n_tokens"] for r in rows)


def coded(spark, texts, tier):
    rows = spark.createDataFrame([(i, i, False, bytearray(t)) for i, t in enumerate(texts)], "_row long, doc_id long, held_out boolean, _text binary")
    return brown_lm.code_rows(rows, spark.sparkContext.broadcast(tier)).select("_codes")


def test_lm_probabilities_sum_to_one(spark):
    """Over the classes after any class, and over the words of a class with its unknown word."""
    rng = random.Random(14)
    words = [f"{rng.choice('abcdefgh')}{i}" for i in range(1500)]
    texts = [" ".join(rng.choice(words) for _ in range(120)).encode() for _ in range(60)]
    train = spark.createDataFrame([(bytearray(t),) for t in texts], "_text binary")
    counted = brown_lm.count_words(train)
    tier = [(bytes(w), n) for w, n in brown_lm.frequent_words(counted)]
    assert len(tier) > brown_lm.TOP_WORDS
    np = brown_lm.np
    of = np.append(np.random.default_rng(1).integers(0, brown_lm.CLASSES, brown_lm.UNITS), brown_lm.CLASSES)
    own = np.random.default_rng(2).integers(0, brown_lm.CLASSES, len(tier)).astype(np.int64)
    classes = brown_lm.by_code(own, of)
    classed = spark.sparkContext.broadcast(classes)
    table = brown_lm.count_class_pairs(coded(spark, texts, tier), classed)
    assert table.sum() == sum(len(t.split()) + 1 for t in texts)
    assert (10 ** brown_lm.transitions(table)).sum(axis=1) == pytest.approx(1.0)
    tokens, kinds = brown_lm.class_sizes(counted, spark.sparkContext.broadcast(tier), classed)
    mass = np.full(brown_lm.CLASSES + 1, 0.5)
    coder = brown_lm.Coder(tier)
    for r in counted.collect():
        mass[classes[coder([bytes(r["word"])])[0] + brown_lm.SUFFIXES]] += r["n"] + 0.5
    assert mass == pytest.approx(tokens + 0.5 * (kinds + 1))


def test_lm_classes_of_words_by_their_contexts(spark):
    np, k = brown_lm.np, brown_lm.CLASSES
    rng = np.random.default_rng(3)
    step, tokens = np.log10(rng.dirichlet(np.ones(k + 1), k + 1)), rng.integers(1, 1000, k + 1).astype(float)
    counts = rng.integers(0, 4, (30, 2 * (k + 1)))
    rows = [(w, s, int(counts[w, s])) for w in range(30) for s in range(2 * (k + 1)) if counts[w, s]]
    got = {r["word"]: r["class"] for r in brown_lm.classes_of_words(spark.createDataFrame(rows, "word int, side int, n long"), step, tokens).collect()}
    for w in range(30):
        def gain(c, w=w):
            before = sum(int(counts[w, b]) * (step[b, c] - np.log10(tokens[c])) for b in range(k + 1))
            return before + sum(int(counts[w, k + 1 + a]) * step[c, a] for a in range(k + 1))

        assert got[w] == max(range(k), key=gain)


def test_lm_counts_neighbours(spark):
    rng = random.Random(15)
    words = [f"w{i}" for i in range(1300)]
    text = " ".join(words * 2 + [rng.choice(words) for _ in range(4000)]).encode()
    tier = sorted(((w.encode(), text.split().count(w.encode())) for w in words), key=lambda p: (-p[1], p[0]))
    np = brown_lm.np
    of = np.append(np.arange(brown_lm.UNITS) % brown_lm.CLASSES, brown_lm.CLASSES)
    classes = brown_lm.by_code(of[brown_lm.units_of(tier)], of)
    got = {(r["word"], r["side"]): r["n"] for r in brown_lm.count_neighbours(coded(spark, [text], tier), spark.sparkContext.broadcast(classes)).collect()}
    index = {w: i for i, (w, _) in enumerate(tier)}
    path = [brown_lm.CLASSES, *classes[brown_lm.Coder(tier)(text.split()) + brown_lm.SUFFIXES].tolist(), brown_lm.CLASSES]
    want = {}
    for i, w in enumerate(text.split()):
        if index[w] >= brown_lm.TOP_WORDS:
            for side in (path[i], path[i + 2] + brown_lm.CLASSES + 1):
                want[index[w], side] = want.get((index[w], side), 0) + 1
    assert got == want


def test_html_blocks_and_cut(spark):
    page = """<!doctype html><html><head><title>t &amp; u</title><style>p{}</style></head><body class="has-sidebar">
      <header><a href=/>Home</a></header><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav>
      <div class="cookie-notice">We use cookies.</div><div class=ad>Buy now.</div>
      <article><h1>Head &amp; tail</h1><p>First <b>bold</b>text&nbsp;here.<br>Next
      line.<p>Second &lt;p&gt;.</p><script>var x = "</p>";</script><aside>Related things</aside><form><label>Mail</label><button>Go</button></form></article>
      <div id="comments"><article>I liked it. Really.</article></div><footer>&copy; x</footer></body></html>"""
    rows = [(1, "u", page), (2, "v", None), (3, "w", ""), (4, "x", "<script>never closed"), (5, "y", "plain text only, long enough to be a sentence. And one more of them.")]
    got = {r["page_id"]: r for r in mincut_html.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1]["text"] == "Head & tail First boldtext here. Next line. Second <p>."
    assert [got[i]["text"] for i in (2, 3, 4)] == ["", "", ""]
    assert got[5]["text"].startswith("plain text only")
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def paragraphs(n, tag="p"):
    return "".join(f"<{tag}>Paragraph {i} tells a little more about the subject, which is a long story. It has a second sentence as well.</{tag}>" for i in range(n))


def prior_weights():
    """The weights before any page is seen."""
    odds = {w: max(min(mincut_html.math.log(a / b), mincut_html.WORD_LIMIT), -mincut_html.WORD_LIMIT) for w, (a, b) in mincut_html.WORD_PRIOR.items()}
    return odds | {f: mincut_html.math.log(a / b) for f, (a, b) in mincut_html.PRIOR.items()}


def test_class_words_do_not_veto_an_article():
    weights, nav, foot = prior_weights(), "<nav><a href=/>Home</a> <a href=/b>News</a></nav>", "<footer>Rights reserved</footer>"
    pages = [
        f'{nav}<article><section class="market share">{paragraphs(3)}</section></article>{foot}',
        f'{nav}<article><h1>Title</h1>{paragraphs(2)}<div class="head-injury">{paragraphs(2)}</div></article>{foot}',
        f'<div class="menu"><a href=/>Home</a></div><div id="content"><div class="social-history">{paragraphs(3)}</div></div>{foot}',
        f'<form id="aspnetForm"><div class="nav"><a href=/>Home</a></div>{paragraphs(3)}<div class="footer">Rights reserved</div></form>',
        f'<article><p data-state="{"x" * 5000} > 3 then sidebar text">Paragraph 0 is here, and it is long enough to read. Twice.</p>{paragraphs(2)}</article>',
        f'<div class="share-price">{paragraphs(3)}</div><div class="share"><a href=/s>Share</a></div>',
    ]
    for page in pages:
        text = mincut_html.main_text(f"<html><body>{page}</body></html>", weights)
        assert text.count("second sentence") == page.count("second sentence") and "Paragraph 0" in text
        assert not any(x in text for x in ("Home", "Rights", "sidebar", "Share")), text


def test_the_cut_changes_labels():
    """A short line between paragraphs stays with them; a list of links goes."""
    weights = prior_weights()
    page = f"<body><div>{paragraphs(2)}<div>So it went</div>{paragraphs(2)}</div><ul>" + "<li><a href=/x>Item to click</a></li>" * 4 + "</ul></body>"
    blocks = mincut_html.blocks_of(page)
    odds = mincut_html.block_odds(blocks, weights)
    labels = mincut_html.min_cut(odds, mincut_html.edges_of(blocks))
    assert any((o > 0) != keep for o, keep in zip(odds, labels, strict=True))
    text = mincut_html.main_text(page, weights)
    assert "So it went" in text and text.count("second sentence") == 4 and "click" not in text


def test_html_odd_pages(spark):
    schema = "page_id long, url string, html string, text string, _html string, n_chars string"
    page = f"<article>{paragraphs(2)}</article><div class=ad>Buy this now</div>"
    rows = [(1, "u", page, "x", "x", "x")] * 2 + [(None, None, page, "x", "x", "x"), (2, "v", f"<article>{paragraphs(20_000)}</article>", None, None, None)]
    got = mincut_html.extract_main_text(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 4 and all(r["text"].startswith("Paragraph 0") and "Buy" not in r["text"] for r in got)
    assert max(r["n_chars"] for r in got) == len(paragraphs(20_000, "p").replace("<p>", "").replace("</p>", " ")) - 1
    assert mincut_html.extract_main_text(spark.createDataFrame([], schema)).count() == 0


def test_html_takes_linear_time():
    import time

    for page in ('<x a=">"' * 100_000, "<div class=ad>" * 20_000 + "x", '<a b="' * 100_000 + ">", "<p>a</p>" * 50_000, "<a b='" * 50_000 + '<i c="' * 50_000):
        started = time.perf_counter()
        mincut_html.main_text(page, prior_weights())
        assert time.perf_counter() - started < 20


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(-3, 3), min_size=1, max_size=9), st.data())
def test_min_cut_is_minimal(odds, data):
    n = len(odds)
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n)]
    edges = [(i, j, data.draw(st.floats(0, 2))) for i, j in data.draw(st.lists(st.sampled_from(pairs), max_size=10, unique=True))] if pairs else []

    def cost(labels):
        return sum(max(o, 0) if not keep else max(-o, 0) for o, keep in zip(odds, labels, strict=True)) + sum(w for i, j, w in edges if labels[i] != labels[j])

    best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(2**n))
    assert cost(mincut_html.min_cut(odds, edges)) == pytest.approx(best, abs=1e-6)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="<>/abp \"'=&;!-d", max_size=60))
def test_html_never_fails(page):
    assert all(b.text == " ".join(b.text.split()) for b in mincut_html.blocks_of(page))


def test_secrets_match_base_rules(odd, repeated, empty):
    docs, _ = secret_scan.scan_secrets(odd)
    got = {r["doc_id"]: r for r in docs.collect()}
    for d, t, *_ in odd_rows():
        want = brute.secrets(t)
        assert (got[d]["n_assign"], got[d]["n_access"], got[d]["n_hex"], got[d]["base_sha256"]) == want[:4]
        assert set(want[4].split(",")) - {""} <= set(got[d]["spans"].split(","))
    assert secret_scan.scan_secrets(empty)[0].count() == 0
    assert secret_scan.scan_secrets(repeated)[0].count() == repeated.count()


def test_ownership_separates_examples_from_live_values(spark):
    copied, own = "sk_live_" + "Example0" * 3, "sk_live_" + "R4nd0mV4lu3x9Qz7"
    rows = [(i, f"see {copied} here", "en", f"s{i}") for i in range(9)] + [(20, f"key {own}", "en", "s1"), (21, f"key {own}", "de", "s1")]
    docs, candidates = secret_scan.scan_secrets(frame(spark, rows))
    got = {r["doc_id"]: r for r in docs.collect()}
    assert got[20]["spans"] == f"stripe:4:{4 + len(own)}" and got[20]["n_live"] == 1
    assert got[3]["spans"] == "" and got[3]["n_copied"] == 0  # not base and not live: not reported
    figures = {(r["n_owners"], r["n_repositories"], r["n_copies"], r["live"]) for r in candidates.collect()}
    assert figures == {(9, 9, 9, False), (1, 2, 2, True)}


def test_token_formats_take_linear_time():
    import re
    import time

    plain = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
    pattern = secret_scan.ISSUED["jwt"][1]
    rng = random.Random(8)
    for _ in range(3000):
        text = "".join(rng.choice(["eyJ", "abcdefgh", ".", "e", "yJ", " ", "-", "eyJabcdefgh."]) for _ in range(rng.randrange(12)))
        assert [m.span(1) for m in pattern.finditer(text)] == [m.span() for m in plain.finditer(text)]
    for text in ("eyJ" * 350_000, "eyJabcdefgh." * 90_000, "-----BEGIN PRIVATE KEY-----ab" * 40_000, "AKIA" * 250_000, "token=" * 170_000):
        started = time.perf_counter()
        secret_scan.scan_text(text)
        assert time.perf_counter() - started < 5


def test_token_counts_equal_the_library(odd, repeated, empty):
    tok = Tokenizer.from_file(TOKENIZER)
    got = {r["doc_id"]: r for r in token_counts.count_tokens(odd, TOKENIZER).collect()}
    for d, t, *_ in odd_rows():
        assert got[d]["n_tokens"] == len(tok.encode(t or "", add_special_tokens=False).ids)
        assert got[d]["n_bytes"] == len((t or "").encode())
    assert token_counts.count_tokens(empty, TOKENIZER).count() == 0
    assert token_counts.count_tokens(repeated, TOKENIZER).count() == repeated.count()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aA's tT.! \n\t12é<|>ßİıſ²ªŉ…"), st.characters(max_codepoint=0x400, exclude_categories=["Cs"])), max_size=40))
def test_token_counts_of_any_text(text):
    tok = Tokenizer.from_file(TOKENIZER)
    assert token_counts.Counts(TOKENIZER, {})([text]) == [len(tok.encode(text, add_special_tokens=False).ids)]


def test_mixing_keeps_every_row_and_meets_its_weights(spark, odd, repeated, empty):
    for df in (odd, repeated, empty):
        got = pfair_mix.mix_sources(df, block_rows=3)
        assert sorted(r["position"] for r in got.collect()) == list(range(df.count()))
        assert set(df.columns) - {"stream", "position", "slot"} <= set(got.columns)
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 5).alias("source"))
    weights = {"s0": 5, "s1": 3, "s2": 1, "s3": 0.5, "s4": 0.5}
    slots = {(r["slot"], r["source"]) for r in pfair_mix.mix_sources(rows, weights=weights, block_rows=1).collect()}
    had = dict.fromkeys(weights, 0)
    # all sources have blocks until the first ends, at about 600 / 0.5 slots
    for t, source in sorted(slots)[:1100]:
        had[source] += 1
        for s, w in weights.items():
            assert abs(had[s] - w / 10 * (t + 1)) < 1 + 1e-9
    late = {r["position"]: r["source"] for r in pfair_mix.mix_sources(rows, weights={"s1": 2, "s3": 1, "none": 4, "s0": 0}).collect()}
    assert {late[i] for i in range(1200)} == {"s1", "s3"} and {late[i] for i in range(1200, 3000)} == {"s0", "s2", "s4"}


def check_schedule(blocks, weights):
    slots = pfair_mix.edf_slots(blocks, weights)
    assert slots == brute.earliest_deadline_first(blocks, weights)
    assert sorted(x for held in slots for x in held) == list(range(sum(blocks)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.one_of(st.integers(1, 12), st.floats(1e-6, 1.0))), min_size=1, max_size=6))
def test_schedule_is_that_of_a_plain_edf(streams):
    check_schedule([n for n, _ in streams], [w for _, w in streams])


def test_deviation_stays_below_a_block_of_the_unrounded_targets():
    rng = random.Random(2)
    cases = [([9000, 30], [0.99999, 0.00001]), ([300, 200, 3, 1, 1], [0.5, 0.49, 1e-5, 1e-5, 0.1]), ([rng.randrange(1, 6) for _ in range(2000)], [rng.random() ** 8 + 1e-5 for _ in range(2000)])]
    for blocks, weights in cases:
        slots = pfair_mix.edf_slots(blocks, weights)
        at = {t: i for i, held in enumerate(slots) for t in held}
        assert sorted(at) == list(range(sum(blocks)))
        # the fluid schedule in floats, event by event: the deviation can only change where a source is served or t passes
        had, fluid, order = [0] * len(blocks), [0.0] * len(blocks), list(range(len(blocks)))
        for t in range(sum(blocks)):
            left = 1.0
            while left > 1e-12 and order:
                rate = sum(weights[i] for i in order)
                step = min(left, min((blocks[i] - fluid[i]) * rate / weights[i] for i in order))
                for i in order:
                    fluid[i] += step * weights[i] / rate
                order = [i for i in order if blocks[i] - fluid[i] > 1e-9]
                left -= step
            had[at[t]] += 1
            if t % 7 == 0 or t < 500:
                assert max(abs(h - f) for h, f in zip(had, fluid, strict=True)) < 1 + 1e-6


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.integers(0, 12)), min_size=1, max_size=5), st.integers(1, 4))
def test_positions_are_gapless(streams, block_rows):
    rows = [r for r, _ in streams]
    plan = pfair_mix.plan_blocks(rows, [w for _, w in streams], block_rows)
    at = [p["starts"][k // block_rows] + k % block_rows for p in plan for k in range(rows[p["stream"]])]
    assert sorted(at) == list(range(sum(rows)))


def test_mixing_of_many_sources_and_of_larger_blocks(spark, monkeypatch):
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 2000).alias("source"))
    got = pfair_mix.mix_sources(rows, weights={f"s{i}": 1e-5 if i else 1.0 for i in range(2000)}, block_rows=1).collect()
    assert sorted(r["position"] for r in got) == list(range(6000)) and len({r["stream"] for r in got}) == 2000
    assert {r["source"] for r in got if r["slot"] < 3} == {"s0"} or sum(r["source"] == "s0" for r in got if r["slot"] < 4) == 3
    monkeypatch.setattr(pfair_mix, "MAX_BLOCKS", 100)
    monkeypatch.setattr(pfair_mix, "MAX_STREAMS", 50)
    got = pfair_mix.mix_sources(rows).collect()
    assert sorted(r["position"] for r in got) == list(range(6000)) and len({r["stream"] for r in got}) == 51


def test_sources_beyond_the_own_streams_keep_their_weights(spark, monkeypatch):
    """Of equal sources in one group, each has had its share of the group at any time, give or take a block."""
    monkeypatch.setattr(pfair_mix, "MAX_STREAMS", 12)
    sizes = {f"s{i:02d}": 400 if i < 12 else 100 for i in range(18)}
    rows = spark.createDataFrame([(1000 * k + i, s) for k, (s, n) in enumerate(sizes.items()) for i in range(n)], "doc_id long, source string")
    got = sorted(pfair_mix.mix_sources(rows, block_rows=1).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in got] == list(range(sum(sizes.values()))) and len({r["stream"] for r in got}) == 13
    late = [r["source"] for r in got if r["stream"] == 12]
    had = dict.fromkeys(set(late), 0)
    for t, source in enumerate(late, 1):
        had[source] += 1
        assert all(abs(n - t / 6) < 1 + 1e-9 for n in had.values())
    monkeypatch.setattr(pfair_mix, "MAX_STREAMS", 4)  # 14 others in four groups
    got = pfair_mix.mix_sources(rows, block_rows=3).collect()
    assert sorted(r["position"] for r in got) == list(range(sum(sizes.values()))) and {r["stream"] for r in got} == set(range(5))


def test_every_source_is_scheduled_by_its_own_blocks(spark, monkeypatch):
    """Few numbered streams and runs held at once change no slot: each block is where a plain EDF of all sources puts it."""
    monkeypatch.setattr(pfair_mix, "MAX_STREAMS", 3)
    monkeypatch.setattr(pfair_mix, "MAX_BLOCKS", 10)
    monkeypatch.setattr(pfair_mix, "RUN_BLOCKS", 2, raising=False)
    sizes = {f"s{i:02d}": n for i, n in enumerate([40, 17, 17, 9, 9, 9, 8, 8, 3, 3, 3, 3, 3, 2, 1, 1, 1, 1])}
    rows = spark.createDataFrame([(1000 * k + i, s) for k, (s, n) in enumerate(sizes.items()) for i in range(n)], "doc_id long, source string")
    blocks = [-(-n // 2) for n in sizes.values()]
    want = brute.earliest_deadline_first(blocks, [math.floor(n**pfair_mix.ALPHA * 2**20) for n in sizes.values()])
    got = pfair_mix.mix_sources(rows.repartition(3), block_rows=2).collect()
    assert sorted(r["position"] for r in got) == list(range(sum(sizes.values()))) and {r["stream"] for r in got} == set(range(4))
    assert {(r["source"], r["block"], r["slot"]) for r in got} == {(s, j, slot) for s, held in zip(sizes, want, strict=True) for j, slot in enumerate(held)}
    by_position = sorted(got, key=lambda r: r["position"])
    assert [r["slot"] for r in by_position] == sorted(r["slot"] for r in got)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 20), st.integers(1, 9), st.integers(1, 5)), min_size=1, max_size=5))
def test_classes_are_scheduled_like_their_streams(classes):
    each = [(n, w) for n, w, m in classes for _ in range(m)]
    first = [sum(m for *_, m in classes[:i]) for i in range(len(classes))]
    slots = [[] for _ in each]
    runs = [(first[i] + k + x, j) for i, j, k, n in pfair_mix.edf_runs(*zip(*classes, strict=True)) for x in range(n)]
    for t, (i, j) in enumerate(runs):
        assert j == len(slots[i])
        slots[i].append(t)
    assert slots == brute.earliest_deadline_first([n for n, _ in each], [w for _, w in each])


def test_warc_round_trip(spark, tmp_path):
    tricky = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 4
    rows = [(1, "u", "x" * 200), (2, "v\r\nX: y%0A", "x" * 200), (3, None, "short"), (4, "w", "short"), (5, "w", None), (6, "w", ""), (7, "ü", tricky), (9, "z", tricky), (8, "z", "é" * 50)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    got = {r["page_id"]: r for r in warc.round_trip(pages).collect()}
    for p, want in brute.warc([(p, h) for p, _, h in rows]).items():
        assert tuple(got[p][c] for c in ("payload_bytes", "payload_digest", "record_type", "refers_to")) == want
    assert [got[p]["target_uri"] for p in (1, 2, 3, 7)] == ["u", "v\r\nX: y%0A", None, "ü"]
    assert warc.round_trip(pages.limit(0)).count() == 0
    twice = warc.round_trip(pages.where("page_id in (1, 2)").unionByName(pages.where("page_id in (1, 2)")))
    assert sorted((r["page_id"], r["record_type"]) for r in twice.collect()) == [(1, "response")] * 2 + [(2, "revisit")] * 2
    nulls = spark.createDataFrame([(None, "u", "y" * 200), (None, "u", "y" * 200), (3, "u", "z" * 200), (None, "u", "z" * 200)], "page_id long, url string, html string")
    found = sorted((str(r["page_id"]), r["record_type"], str(r["refers_to"])) for r in warc.round_trip(nulls).collect())
    assert found == [("3", "response", "None"), ("None", "response", "None"), ("None", "response", "None"), ("None", "revisit", "3")]


def test_warc_filters_skip_payloads(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"{i}" * 300) for i in range(20)], "page_id long, url string, html string")
    for compression in (None, "gzip"):
        path = f"{tmp_path}/{compression}"
        warc.write_archives(warc.classify(pages.unionByName(pages.withColumn("page_id", F.col("page_id") + 100))), path, rows_per_file=7, compression=compression)
        got = warc.read_archives(spark, path)
        assert got.where("record_type = 'revisit'").count() == 20
        assert [r["payload"].decode() for r in got.where("page_id = 7").collect()] == ["7" * 300]
        assert got.where("page_id > 110 and target_uri = 'u'").count() == 9
    reader = warc.WarcReader([], True)
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    rest = list(reader.pushFilters([EqualTo(("record_type",), "response"), GreaterThan(("page_id",), 3), In(("page_id",), (1, 2))]))
    assert rest == [GreaterThan(("page_id",), 3)] and len(reader.wanted) == 2


def test_near_duplicates_equal_brute_force(odd, empty):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in setsketch_dedup.near_duplicates(odd).collect()}
    assert got == brute.near_duplicates([(d, t) for d, t, *_ in odd_rows()])
    assert setsketch_dedup.near_duplicates(empty).count() == 0


def test_near_duplicates_of_repeated_rows(repeated):
    rows = setsketch_dedup.near_duplicates(repeated).collect()
    assert len(rows) == repeated.count()
    assert {r["component_id"] for r in rows if r["doc_id"] == 6} == {6}  # one of them is another text
    by_text = [r for r in rows if r["n_shingles"] == 196 and r["doc_id"] in (6, 7, None)]
    assert {r["component_id"] for r in by_text} == {6} and sum(r["kept"] for r in by_text) == 2


def test_large_group_of_near_copies_loses_no_link(spark, monkeypatch):
    """Chains and stars of near copies in one bucket, compared in several blocks."""
    monkeypatch.setattr(setsketch_dedup, "BLOCK", 16)
    rng = random.Random(9)
    base = prose(rng, 120).split()
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(0, 7)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
        rows.append((i, " ".join(w), "en", "s"))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in setsketch_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute.near_duplicates([(d, t) for d, t, *_ in rows])


def test_sketches_merge():
    a, b = (setsketch_dedup.shingles(prose(random.Random(i), 300).encode()) for i in (1, 2))
    one, two, both = setsketch_dedup.sketch_many([a, b, setsketch_dedup.np.union1d(a, b)])
    assert (setsketch_dedup.merge_registers(one, two) == both).all()


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_quality_features_and_bands(odd, repeated, empty, spark):
    got = {r["doc_id"]: r for r in kn_quality.quality_rules(odd).collect()}
    for d, t, *_ in odd_rows():
        r = got[d]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute.quality(t)
        assert not (r["base_failed"] and r["kept"])
    assert kn_quality.quality_rules(empty).count() == 0
    assert kn_quality.quality_rules(repeated).count() == repeated.count()
    rng = random.Random(2)
    clean = [(i, prose(rng, 80), "en", "s") for i in range(200)]
    junk = [(900, " ".join("".join(rng.choice("qxzjkvw#@~") for _ in range(9)) for _ in range(90)), "en", "s")]
    kept = {r["doc_id"]: r["kept"] for r in kn_quality.quality_rules(frame(spark, clean + junk)).collect()}
    assert all(kept[d] for d, *_ in clean) and not kept[900]


def test_upper_band_rejects_noise_and_keeps_quotes_and_keys(spark):
    rng = random.Random(21)
    foreign = "der fluss und das haus mit einer alten strasse über den wald am morgen ruhig".split()

    def speak(words, n):
        return " ".join(rng.choice(words) for _ in range(n))

    def noisy(text, share):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") if c != " " and rng.random() < share else c for c in text)

    rows = [(i, speak(WORDS, 100), "en", "s") for i in range(300)] + [(1000 + i, speak(foreign, 100), "de", "s") for i in range(300)]
    rows += [(2000, speak(WORDS, 60) + " " + speak(foreign, 60), "en", "s"), (2001, speak(WORDS, 120) + ' key = "9f8a7b6c5d4e3f2a1b0c9d8e7f6a5b4c3d2e1f0a"', "en", "s")]
    rows += [(3000 + i, noisy(speak(WORDS, 100), 0.05), "en", "s") for i in range(3)]
    got = {r["doc_id"]: r for r in kn_quality.quality_rules(frame(spark, rows)).collect()}
    assert all(r["kept"] for d, r in got.items() if d < 3000)
    assert [got[d]["kept"] for d in (3000, 3001, 3002)] == [False] * 3
    assert all(got[d]["window_ppl"] > got[d]["band_high"] and not got[d]["base_failed"] for d in (3000, 3001, 3002))
    assert kn_quality.UPPER_IQRS == kn_quality.LOWER_IQRS


def test_bands_tell_noise_in_any_script(spark):
    rng = random.Random(31)
    russian = "река камень свет сад двигатель бумага окно утро тихий стол серебро клён город дорога книга вечер письмо".split()
    chinese = ["".join(chr(0x4E00 + int(rng.paretovariate(0.6)) * 7 % 900) for _ in range(rng.randrange(2, 5))) for _ in range(150)]
    astral = [chr(0x20000 + i) * 2 for i in range(40)]

    def speak(words, n=100):
        return " ".join(rng.choice(words) for _ in range(n))

    def noise(text, first, count):
        return "".join(chr(first + rng.randrange(count)) if c != " " else c for c in text)

    rows = [(i, speak(russian).capitalize(), "ru", "s") for i in range(200)] + [(1000 + i, speak(chinese), "zh", "s") for i in range(200)]
    rows += [(2000 + i, speak(astral), "x", "s") for i in range(20)]
    rows += [(3000 + i, noise(speak(russian), 0x430, 32), "ru", "s") for i in range(3)] + [(3100 + i, noise(speak(chinese), 0x4E00, 20000), "zh", "s") for i in range(3)]
    got = {r["doc_id"]: r for r in kn_quality.quality_rules(frame(spark, rows)).collect()}
    assert {d for d, r in got.items() if not r["kept"]} == {d for d in got if d >= 3000}
    assert all(got[d]["window_ppl"] > got[d]["band_high"] and not got[d]["base_failed"] for d in got if d >= 3000)


def test_every_language_has_its_band(spark, monkeypatch):
    monkeypatch.setattr(kn_quality, "OPEN_MODELS", 3)
    rng = random.Random(32)
    rows = []
    for k in range(40):
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz"[k % 13 :]) for _ in range(rng.randrange(2, 8))) for _ in range(20 + 5 * k)]
        rows += [(100 * k + i, " ".join(rng.choice(words) for _ in range(70)), f"l{k}" if k else None, "s") for i in range(12)]
    got = kn_quality.quality_rules(frame(spark, rows)).collect()
    assert len({r["lang"] for r in got}) == 40 and len({(r["band_low"], r["band_high"]) for r in got}) == 40
    monkeypatch.setattr(kn_quality, "MAX_LANGUAGES", 10)
    few = kn_quality.quality_rules(frame(spark, rows)).collect()
    assert len(few) == 480 and len({(r["band_low"], r["band_high"]) for r in few}) == 40


def test_languages_beyond_the_broadcast_ones_have_their_models(spark, monkeypatch):
    """Shuffled models give what broadcast ones do: quotes, texts without letters, repeated rows, several copies of a model."""
    rng = random.Random(35)
    speech = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz"[k::6] if k < 6 else "абвгдежзийклмнопрст") for _ in range(rng.randrange(2, 8))) for _ in range(30 + 3 * k)] for k in range(7)]
    speak = lambda k, n=70: " ".join(rng.choice(speech[k]) for _ in range(n))
    rows = [(100 * k + i, speak(k), f"l{k}" if k != 5 else None, "s") for k in range(7) for i in range(14 - k)]
    rows += [(1000 + 10 * a + b, f"{speak(a)} {speak(b, 60)} {speak((a + b) % 7, 20)}", f"l{a}", "s") for a in (0, 1, 4, 6) for b in range(7)]
    rows += [(2000 + i, " ".join(str(rng.randrange(10**6)) for _ in range(60)), "digits", "s") for i in range(3)]
    rows += [(3000, None, "empty", "s"), (3001, "", "l6", "s"), (None, speak(6, 3000), "l6", "s"), (3002, "a", "tiny", "s"), rows[-5], rows[-5], rows[60], rows[60]]
    plain = lambda: sorted((str(r["doc_id"]), r["_key"], r["lang"], r["log_ppl"] or 0.0, r["window_ppl"] or 0.0, r["n_words"], r["base_failed"], r["kept"]) for r in kn_quality.quality_rules(frame(spark, rows)).collect())
    broadcast = plain()
    assert len(broadcast) == len(rows)
    for limit, deal in ((2, 16_000_000), (1, 3000)):
        monkeypatch.setattr(kn_quality, "MAX_LANGUAGES", limit)
        monkeypatch.setattr(kn_quality, "DEAL_BYTES", deal)
        monkeypatch.setattr(kn_quality, "VOTE_TABLE", 3)
        for got, want in zip(plain(), broadcast, strict=True):
            assert got[:3] + got[5:] == want[:3] + want[5:] and got[3:5] == pytest.approx(want[3:5], abs=1e-5)


def test_quartiles_are_exact(spark):
    rng = random.Random(33)
    values = [(rng.choice("ab"), rng.randrange(4000) / 1024, rng.randrange(4000) / 1024, False) for _ in range(777)]
    bands = {r["lang"]: r for r in kn_quality.bands_of(spark.createDataFrame(values, "lang string, log_ppl double, window_ppl double, base_failed boolean"), 2.0, 3.0).collect()}
    for name in "ab":
        own, windows = (sorted(v[c] for v in values if v[0] == name) for c in (1, 2))
        at = lambda x, q: x[-(-len(x) * q // 4) - 1]
        assert bands[name]["band_low"] == pytest.approx(at(own, 1) - 2 * (at(own, 3) - at(own, 1)))
        assert bands[name]["band_high"] == pytest.approx(at(windows, 3) + 3 * (at(windows, 3) - at(windows, 1)))


def test_verdict_equals_a_plain_kneser_ney(spark):
    """Log-perplexities and bands from counts in dictionaries, symbol by symbol."""
    rng = random.Random(34)
    rows = [(i, prose(rng, 60 + i), "en", "s") for i in range(40)] + [(50, "a b " * 3 + prose(rng, 50), "en", "s")]
    got = {r["doc_id"]: r["log_ppl"] for r in kn_quality.quality_rules(frame(spark, rows)).collect()}
    want = brute.kneser_ney({d: t for d, t, *_ in rows}, kn_quality.LETTERS, kn_quality.SYMBOLS)
    assert got == {d: pytest.approx(p, abs=1e-4) for d, p in want.items()}


def test_kneser_ney_sums_to_one_and_survives_storage():
    codes = kn_quality.np.concatenate([kn_quality.ngram_codes(prose(random.Random(i), 400).encode()) for i in range(5)])
    keys, counts = kn_quality.np.unique(codes, return_counts=True)
    p = kn_quality.np.exp(kn_quality.expand(kn_quality.fit(keys, counts)).astype(float)).reshape(-1, kn_quality.SYMBOLS)
    assert p.min() > 0 and p.sum(axis=1) == pytest.approx(1.0, abs=1e-4)


def test_decontamination(spark, odd, repeated, empty):
    rng = random.Random(3)
    items = [(i, ". ".join(prose(rng, 12) for _ in range(3)) + ".") for i in range(12)] + [(50, None), (51, ""), (None, prose(rng, 30))]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, node string")

    def planted(text, drop):
        return prose(rng, 150) + " " + " ".join(w for w in text.upper().split() if rng.random() >= drop) + " " + prose(rng, 150)

    docs = [(i, planted(t, 0.0), "en", "s") for i, t in items[:12]] + [(100 + i, planted(t, 0.15), "en", "s") for i, t in items[:12]] + [(200 + i, prose(rng, 300), "en", "s") for i in range(30)]
    docs += [(300, None, None, None), (301, "", "en", "s"), (302, prose(rng, 90_000) + " " + items[4][1], "en", "s")]
    found = {(r["doc_id"], r["item_id"]) for r in latent_decontam.contaminated(frame(spark, docs), benchmark).collect()}
    assert found == {(i, i) for i in range(12)} | {(100 + i, i) for i in range(12)} | {(302, 4)}
    assert latent_decontam.contaminated(empty, benchmark).count() == 0
    assert latent_decontam.contaminated(odd, benchmark.limit(0)).count() == 0
    twice = frame(spark, [docs[0], docs[0], (None, docs[1][1], "en", "s")])
    again = [(r["doc_id"], r["item_id"]) for r in latent_decontam.contaminated(twice, benchmark).collect()]
    assert sorted(again, key=str) == [(0, 0), (0, 0), (None, 1)]
    assert latent_decontam.contaminated(repeated, benchmark).count() == 0


def test_decontamination_of_long_items(spark, monkeypatch):
    """Items of 100 to 1,000 words, copied whole or with a tenth of the words dropped, in several blocks and groups."""
    monkeypatch.setattr(latent_decontam, "BLOCK_PARTS", 24)
    monkeypatch.setattr(latent_decontam, "GROUP_BLOCKS", 2)
    monkeypatch.setattr(latent_decontam, "LONGEST", 800)
    rng = random.Random(31)
    sizes = [40, 100, 200, 220, 300, 600, 700, 1000]
    items = [(i, ". ".join(prose(rng, 20) for _ in range(n // 20)) + ".") for i, n in enumerate(sizes)]

    def planted(text, drop):
        return prose(rng, 120) + " " + " ".join(w for w in text.split() if rng.random() >= drop) + " " + prose(rng, 120)

    docs = [(i, planted(t, 0.0), "en", "s") for i, t in items] + [(100 + i, planted(t, 0.1), "en", "s") for i, t in items] + [(200 + i, prose(rng, 1500), "en", "s") for i in range(20)]
    docs += [(300, prose(rng, 140_000) + " " + items[6][1] + " " + prose(rng, 9000), "en", "s")] * 2
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = latent_decontam.contaminated(frame(spark, docs).repartition(3), benchmark).collect()
    got = sorted((r["doc_id"], r["item_id"]) for r in rows)
    assert got == sorted([(i, i) for i, _ in items] + [(100 + i, i) for i, _ in items] + [(300, 6)] * 2)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), max_size=12))
def test_common_subsequence(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    assert latent_decontam.lcs(a, b) == rows[-1][-1]


def test_latent_space_is_fitted_on_all_windows_of_all_documents(spark, monkeypatch):
    """The space holds every window, so a cosine in it is the plain one of TF-IDF vectors, also with few windows' weight and sums in strips."""
    import numpy as np

    monkeypatch.setattr(latent_decontam, "FIT_WINDOWS", 4)
    monkeypatch.setattr(latent_decontam, "HELD_CELLS", 30_000, raising=False)
    rng = random.Random(36)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.sample(words, 40))) for i in range(10)]
    # parts of the items in other words, and words of all items strewn in between
    noise = lambda n: [rng.choice(words) if rng.random() < 0.08 else f"z{rng.randrange(10**6)}" for _ in range(n)]
    docs = [(i, " ".join(noise(50) + t.split()[: rng.randrange(28, 41)] + noise(45)), "en", "s") for i, t in items for _ in range(2)]
    docs += [(100 + i, " ".join(noise(90)), "en", "s") for i in range(40)]
    found = latent_decontam.contaminated(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(i, i) for i, _ in items} and len(found) == len(docs[:20])
    seen = {w: sum(w in d[1].split() for d in docs) for w in words}
    rare = [w for _, t in items for w in t.split() if seen[w] <= 0.1 * len(docs)]
    idf = {w: math.log((1 + len(docs)) / (1 + seen[w])) + 1 for w in rare}
    vector = lambda text: np.array([text.count(w) * idf[w] for w in sorted(idf)])
    for r in found:
        item = vector(items[r["item_id"]][1].split())
        plain = []
        for d in docs[:20]:
            if d[0] == r["doc_id"]:
                v = vector(d[1].split()[r["first_word"] : r["first_word"] + 64])
                plain.append(v @ item / np.linalg.norm(v) / np.linalg.norm(item))
        assert min(abs(r["cosine"] - c) for c in plain) < 1e-4


def test_sums_of_the_latent_space_reach_the_driver_in_small_parts(spark, monkeypatch):
    """The driver's JVM passes on small Arrow parts and keeps no broadcast of a step that is over."""
    import numpy as np
    from pyspark.core.broadcast import Broadcast
    from pyspark.sql.classic.dataframe import DataFrame

    rng = np.random.default_rng(7)
    a = rng.standard_normal((40, 1500)) * (rng.random((40, 1500)) < 0.02)
    sparse = [([int(t) for t in np.flatnonzero(row)], [float(row[t]) for t in np.flatnonzero(row)]) for row in a.astype(np.float32)]
    rows = spark.createDataFrame(sparse, "terms array<int>, weights array<float>").repartition(3)
    q = rng.standard_normal((1500, 200))
    arrived, gone = [], []
    to_arrow, destroy = DataFrame.toArrow, Broadcast.destroy

    def seen(df):
        arrived.append(to_arrow(df))
        return arrived[-1]

    monkeypatch.setattr(DataFrame, "toArrow", seen)
    monkeypatch.setattr(DataFrame, "collect", lambda df: pytest.fail("sums are collected as rows"))
    monkeypatch.setattr(Broadcast, "destroy", lambda b, *args: (gone.append(b), destroy(b, *args)))
    found = latent_decontam.gram_times(rows, q)
    dense = a.astype(np.float32).astype(np.float64)
    np.testing.assert_allclose(found, dense.T @ (dense @ q), rtol=1e-5, atol=1e-5)
    parts = [len(p.as_py()) for p in arrived[0]["part"]]
    assert sum(parts) == q.nbytes and max(parts) <= latent_decontam.SUM_BYTES
    assert len(gone) == 1
    assert not latent_decontam.gram_times(rows.limit(0), q).any()
