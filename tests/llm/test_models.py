"""Trained operators: held-out accuracy on the small tables, and defined results on odd rows."""

import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchbook.llm import language_id, quality, toxicity, url_filter

DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize(("op", "label", "least"), [(toxicity.toxicity, "toxic", 0.9), (quality.quality, "quality", 0.97)])
def test_held_out(spark, op, label, least):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = op(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r[label] for r in rows) / len(rows) >= least


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = language_id.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.98


def test_rare_languages(spark):
    """Every language of the training rows is learnt, however rare; null ids and repeated rows don't hide or swell one."""
    rows = [(i, f"common words of text {i}", "en") for i in range(3000)]
    rows += [(10_000 + i, f"palabras raras {i}", f"r{i // 12}") for i in range(96)]
    rows += [(None, "sans numéro", "fr")] * 500 + [(30_002, "immer derselbe text", "de")] * 500
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    net = language_id.fit(df, train_docs=200)
    assert net.languages == sorted({r[2] for r in rows})
    sample, sampled = language_id.training_rows(df, train_docs=200)
    sizes = {r.lang: r.n for r in sample.distinct().groupBy("lang").agg(F.count("*").alias("n")).collect()}
    assert sampled and sizes["en"] <= 2 * language_id.LANGUAGE_DOCS and sizes["fr"] == sizes["de"] == 1


def test_an_interaction_is_learnt():
    """Two insults, two groups: only the pair decides, no word by itself says anything about the label."""
    rng = np.random.default_rng(7)
    filler = [f"word{i}" for i in range(300)]

    def texts(n):
        rows, labels = [], []
        for _ in range(n):
            a, b = rng.integers(0, 2, 2)
            words = [*rng.choice(filler, 25), ("zorkish", "blaggard")[a], ("northfolk", "southfolk")[b]]
            rng.shuffle(words)
            rows.append(" ".join(words))
            labels.append(int(a == b))
        return [np.sort(toxicity.text_ids(t, {})) for t in rows], np.array(labels)

    train, y = texts(2500)
    machine = toxicity.fit_machine(train, y)
    held, want = texts(400)

    def decisions(m):
        found = [np.searchsorted(m.buckets, x[np.isin(x, m.buckets)]) for x in held]
        rows = np.repeat(np.arange(len(held)), [len(x) for x in found])
        margin = m.margin(rows, np.concatenate(found), len(held))
        # the pairwise sum against a double loop
        for i in range(20):
            at = found[i]
            pairs = sum(float(m.factors[p] @ m.factors[q]) for k, p in enumerate(at) for q in at[k + 1 :])
            assert abs(m.bias + m.weights[at].sum() + pairs - margin[i]) < 1e-6
        return toxicity.sigmoid(margin) >= 0.5

    assert (decisions(machine) == want).mean() >= 0.95
    additive = dataclasses.replace(machine, factors=np.zeros_like(machine.factors))
    assert (decisions(additive) == want).mean() <= 0.65


def test_odd_rows(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (None, 1, 1), (9, None, None)], "doc_id bigint, toxic int, quality int")
    for op in (toxicity.toxicity, quality.quality):
        rows = op(docs, labels).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert all(r.score == 0 for r in op(docs, labels.limit(0)).collect())
        assert op(empty, labels).count() == 0
    rows = language_id.language_id(docs).collect()
    assert len(rows) == docs.count()
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {4, 5, 6, 7}
    assert language_id.language_id(empty).count() == 0
    assert language_id.keep_known(docs).columns == docs.columns


def test_urls(spark):
    urls = ["http://A.org/x", "https://m.example.org/es/1", "http://example.org/en/12?q", "http://x.com/fr/", "http://x.com", "nope", None, "http://b.net?x#y"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    rows = {r.page_id: r for r in url_filter.judge(pages).collect()}
    assert [(rows[i].host, rows[i].path, rows[i].rule) for i in range(8)] == [
        ("a.org", "/x", "org/"), ("m.example.org", "/es/1", "example.org/es/"), ("example.org", "/en/12", "example.org/en/1"),
        ("x.com", "/fr/", "com/fr/"), ("x.com", "", None), ("", "", None), ("", "", None), ("b.net", "", None),
    ]
    assert [rows[i].verdict for i in range(4)] == ["allow", "block", "block", "allow"]
    assert {r.verdict for r in rows.values()} <= {"allow", "block"}
    assert url_filter.judge(pages.limit(0)).count() == 0
