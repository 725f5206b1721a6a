"""Theme invariants (cluster ids cannot match another K-Means implementation)."""

import math

from pyspark.sql import functions as F

from caseflow.operators import themes as th
from caseflow.plans.catalog import document_tickets

from .conftest import SF_SMALL


def test_theme_invariants_on_documents(spark):
    docs = document_tickets(spark, SF_SMALL)
    usable = th.usable_texts(docs).count()
    themes = th.complaint_themes(docs, n_init=2).collect()
    assert 2 <= len(themes) <= 8
    assert sum(r["ticket_count"] for r in themes) == usable
    for r in themes:
        terms = r["top_terms"].split(", ")
        assert 1 <= len(terms) <= 8
        assert r["theme_label"].startswith(r["category"] + " — ")
        assert len(r["sample_ticket_ids"].split(", ")) == min(8, r["ticket_count"])
        assert 0 <= r["sla_breach_rate"] <= 1 and 0 <= r["transfer_rate"] <= 1
    assert [r["ticket_count"] for r in themes] == sorted((r["ticket_count"] for r in themes), reverse=True)


def test_tfidf_vectors_are_unit_norm_and_match_sql_weights(spark):
    docs = document_tickets(spark, SF_SMALL)
    usable = th.usable_texts(docs.select("ticket_id", "customer_message", "agent_notes"))
    terms = th.add_terms(usable)
    n_docs = usable.agg(F.count(F.lit(1)).cast("double").alias("n_docs"))
    vocab = th.with_idf(th.vocabulary(terms), n_docs).orderBy("term").collect()
    feats = th.tfidf_features(terms, vocab).select("ticket_id", "features", "terms").limit(20).collect()
    idf = {r["term"]: r["idf"] for r in vocab}
    for r in feats:
        v = r["features"]
        norm = math.sqrt(sum(x * x for x in v.values))
        assert norm == 0 or abs(norm - 1) < 1e-9
        counts = {}
        for t in r["terms"]:
            if t in idf:
                counts[t] = counts.get(t, 0) + 1
        raw = {t: c * idf[t] for t, c in counts.items()}
        z = math.sqrt(sum(x * x for x in raw.values())) or 1.0
        words = sorted(idf)
        for i, x in zip(v.indices, v.values):
            assert abs(x - raw[words[i]] / z) < 1e-9


def test_too_few_texts_gives_empty_typed_table(spark):
    docs = document_tickets(spark, SF_SMALL).limit(5)
    out = th.complaint_themes(docs)
    assert out.count() == 0 and out.schema == th.THEME_SCHEMA


def test_tokeniser_rules(spark):
    df = spark.createDataFrame([("D1", "The CAFÉ's menu: a b 42 x_y and-the end")], "ticket_id string, theme_text string")
    terms = th.add_terms(df).first()["terms"]
    # lower-case, >= 2 word chars, stop words out, bigrams of the kept tokens
    assert terms == ["café", "menu", "42", "x_y", "end", "café menu", "menu 42", "42 x_y", "x_y end"]


def test_one_pass_vocabulary_equals_filtered_two_pass(spark):
    docs = document_tickets(spark, SF_SMALL).select("ticket_id", "customer_message", "agent_notes")
    texts = th.theme_text(docs)
    gated = th.add_terms(texts)  # unusable rows keep the flag and get no terms
    usable = th.usable_texts(docs)
    n_usable = usable.count()
    marker = th.term_statistics(gated).filter(F.col("term").isNull()).first()
    assert marker["n_docs"] == n_usable
    one_pass = th.vocabulary_idf(gated).orderBy("term").collect()
    n_docs = usable.agg(F.count(F.lit(1)).cast("double").alias("n_docs"))
    two_pass = th.with_idf(th.vocabulary(th.add_terms(usable)), n_docs).orderBy("term").collect()
    assert len(one_pass) == len(two_pass) > 0
    for a, b in zip(one_pass, two_pass):
        assert (a["term"], a["document_frequency"], a["corpus_frequency"]) == (b["term"], b["document_frequency"], b["corpus_frequency"])
        assert abs(a["idf"] - b["idf"]) < 1e-12


def test_term_statistics_against_brute_force(spark):
    texts = ["refund refund late order", "late delivery refund", "ok", "order late late late", "  "]
    rows = [(f"D{i}", t, True) for i, t in enumerate(texts)] + [("X", "refund refund", False)]
    df = spark.createDataFrame(rows, "ticket_id string, theme_text string, usable boolean")
    stats = {r["term"]: r for r in th.term_statistics(th.add_terms(df)).collect()}
    local = [th.add_terms(spark.createDataFrame([(t,)], "theme_text string")).first()["terms"] for t in texts]
    for term in {t for ts_ in local for t in ts_}:
        assert stats[term]["corpus_frequency"] == sum(ts_.count(term) for ts_ in local)
        assert stats[term]["document_frequency"] == sum(term in ts_ for ts_ in local)
    assert stats[None]["n_docs"] == len(texts)  # the unusable row is not counted


def test_nine_usable_texts_among_short_ones_gives_empty_table(spark):
    rows = [(f"T{i}", f"my parcel number {i} arrived broken", "", "Returns", 3.0, False, 0.0) for i in range(9)]
    rows += [(f"S{i}", "short", "", "Returns", 3.0, False, 0.0) for i in range(30)]
    df = spark.createDataFrame(
        rows,
        "ticket_id string, customer_message string, agent_notes string, category string, csat_score double, sla_breach boolean, transfers double",
    )
    assert th.complaint_themes(df, n_init=1).count() == 0
    more = df.union(spark.createDataFrame([("T9", "my parcel number 9 arrived broken", "", "Returns", 3.0, False, 0.0)], df.schema))
    out = th.complaint_themes(more, n_init=1).collect()
    assert sum(r["ticket_count"] for r in out) == 10


def staged_frames(monkeypatch):
    """The frames that the themes stage from now on."""
    held, stage = [], th.stage
    monkeypatch.setattr(th, "stage", lambda df: held.append(stage(df)) or held[-1])
    return held


def test_weights_of_texts_that_share_a_ticket_and_nothing_staged_by_term(spark, monkeypatch):
    texts = [("A", "late parcel arrived late broken parcel"), ("B", "parcel arrived broken refund wanted"), ("B", "refund refund wanted parcel late"), (None, "late refund arrived broken"), (None, "parcel parcel wanted broken"), ("C", "late parcel refund arrived")]
    df = spark.createDataFrame([(i, t, "") for i, t in texts], "ticket_id string, customer_message string, agent_notes string")
    got = {(r["ticket_id"], r["term"]): r["weight"] for r in th.theme_tfidf(df).collect()}
    tf = {}
    for ticket, text in texts:
        words = text.split()
        for term in words + [" ".join(p) for p in zip(words, words[1:])]:
            of = tf.setdefault(ticket, {})
            of[term] = of.get(term, 0) + 1
    df_of = {t: sum(t in of for of in tf.values()) for of in tf.values() for t in of}
    want = {}
    for ticket, of in tf.items():
        raw = {t: n * (math.log((1 + len(tf)) / (1 + df_of[t])) + 1) for t, n in of.items() if df_of[t] >= 2}
        want |= {(ticket, t): x / math.sqrt(sum(y * y for y in raw.values())) for t, x in raw.items()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    held = staged_frames(monkeypatch)
    single = df.where("ticket_id in ('A', 'C')")
    assert th.theme_tfidf(single).count() > 0
    assert sum(f.count() for f in held) <= 2 * single.count()  # before: one row per text and term


def test_summary_of_clusters_moves_and_stages_no_vectors(spark, monkeypatch):
    held = staged_frames(monkeypatch)
    docs = document_tickets(spark, SF_SMALL)
    got = {r["category"]: r["top_terms"].split(", ") for r in th.theme_summary(docs, "category").collect()}
    assert not any("vector" in t or t.startswith("array<int") for f in held for _, t in f.dtypes)
    weights = th.theme_tfidf(docs).join(docs.select("ticket_id", "category"), "ticket_id").groupBy("category", "term").agg(F.round(F.sum("weight"), 9).alias("w")).collect()
    for category, terms in got.items():
        best = sorted(((r["w"], r["term"]) for r in weights if r["category"] == category), reverse=True)[:8]
        assert terms == [t for _, t in best]
