import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.duck import ROOT
from voxsieve.llm import reading as rd
from voxsieve.sources.tables import table


def test_pairs_are_ordered():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 4))
    y = np.digitize(x @ [2.0, -1.0, 0.0, 0.5], [-1, 0, 1])
    w = rd.fit_pairs(x, y.astype(float))
    s = x @ w
    above = y[:, None] > y[None, :]
    assert ((s[:, None] > s[None, :]) & above).sum() / above.sum() > 0.97
    # the gradient at the solution is nearly that of the penalised loss over all pairs
    i, j = np.nonzero(above)
    p = 1 / (1 + np.exp((x[i] - x[j]) @ w))
    assert np.abs(-(p[:, None] * (x[i] - x[j])).mean(0) + 1e-2 * w).max() < 5e-3


def test_isotonic_is_the_monotone_fit():
    rng = np.random.default_rng(1)
    s, y = rng.normal(size=200), rng.integers(1, 6, 200).astype(float)
    xs, ys = rd.isotonic(s, y)
    assert all(a < b for a, b in zip(ys, ys[1:])) and all(a <= b for a, b in zip(xs, xs[1:]))
    # min-max formula of the isotonic regression
    o = np.argsort(s)
    c = np.concatenate([[0], np.cumsum(y[o])])
    fit = [max(min((c[b] - c[a]) / (b - a) for b in range(i + 1, 201)) for a in range(i + 1)) for i in range(200)]
    assert np.allclose(sorted(set(np.round(fit, 9))), np.round(ys, 9))


def test_held_out_labels(spark):
    root = f"{ROOT}/sf0.1"
    docs, labels = table(spark, root, "documents"), table(spark, root, "level_labels")
    common = rd.common_units(docs)
    assert all(len(words) <= rd.COMMON_WORDS for words in common.values()) and "the" in common["latin"][:50] and "的" in common["zh"][:50]
    for x, y in rd.graded(docs, labels, common).values():
        held = np.arange(len(y)) % 3 == 0
        p = rd.fit(x[~held], y[~held]).levels(x[held])
        assert np.abs(p - y[held]).mean() < 0.4 and (np.rint(p) == np.rint(y[held])).mean() > 0.7


def test_scripts_and_syntax(spark):
    docs = spark.createDataFrame([(1, "The cat sat. The dog ran, and it barked."), (2, "小猫坐着。小狗跑了。"), (3, "Кошка сидела. Собака бежала."), (4, "Read <img alt='" + "x" * 300 + "'> this."), (5, "Cafe cats, cafe dogs")], "doc_id long, text string")
    got = {r.doc_id: r for r in rd.segmented(docs).collect()}
    assert {k: r.script for k, r in got.items()} == {1: "latin", 2: "zh", 3: "other", 4: "latin", 5: "latin"} and got[4].words == ["read", "this"]
    assert got[1].marks[:2] == [2.0, 1.0] and got[1].marks[6] == 10.0 and got[2].marks[2] == 2.0 and got[1].text_chars == 40
    common = rd.common_units(docs, 3)
    assert set(common) == set(rd.SCRIPTS) and common["latin"] == ["and", "barked", "cafe"] and "小" in common["zh"] and len(common["other"]) == 3
    f = {r.doc_id: dict(zip(rd.FEATURES, r.f)) for r in rd.with_features(docs, common).collect()}
    assert f[1]["sentence_length"] == pytest.approx(np.log1p(4.5)) and f[1]["clause_length"] == pytest.approx(np.log1p(3)) and f[5]["syllables"] == pytest.approx(1.5)


def test_column_expression_equals_the_model(spark):
    root = f"{ROOT}/sf0.01"
    docs, labels = table(spark, root, "documents"), table(spark, root, "level_labels")
    common = rd.common_units(docs)
    models = {s: rd.fit(x, y) for s, (x, y) in rd.graded(docs, labels, common).items()}
    got = {r.doc_id: r for r in rd.reading_levels(docs, labels, common).collect()}
    for r in rd.with_features(docs, common).collect():
        if r.script is None:
            assert got[r.doc_id].score is None and got[r.doc_id].level is None
            continue
        m = models[r.script]
        assert abs(got[r.doc_id].score - m.scores(np.array([r.f]))[0]) < 1e-9 and abs(got[r.doc_id].level_estimate - m.levels(np.array([r.f]))[0]) < 1e-5
    assert len(got) == docs.count()


def test_odd_texts_and_missing_labels(spark):
    docs = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (3, "|---|", "s"), (4, "word " * 200_000, "s"), (5, "小" * 3000, "s"), (6, "A short one.", "s"), (6, "A short one.", "s")], "doc_id long, text string, script string")
    labels = spark.createDataFrame([(6, 2, "r"), (6, 4, "q"), (4, None, "r"), (None, 3, "r"), (99, 5, "r")], "doc_id long, reading_level int, rater string")
    got = {r.doc_id: r for r in rd.reading_levels(docs, labels).collect()}
    assert got[1].level is None and got[2].level is None and got[3].level is None and got[6].level == 3 and got[5].level == 3 and got[4].script == "latin"
    none = rd.reading_levels(docs, labels.limit(0)).agg(F.count("level").alias("n")).first().n
    assert none == 0 and rd.reading_levels(docs.limit(0), labels).count() == 0
    assert rd.profile(rd.reading_levels(docs, labels), ["script"]).agg(F.sum("n_documents")).first()[0] == 7
