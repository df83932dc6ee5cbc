"""Trained operators: held-out accuracy, and that scores mean what they should."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tests.llm.awkward import awkward, empty, rows
from ticketlake.llm import lm_score, toxicity
from ticketlake.llm.common import table

SF = SF_DIR.replace("0.001", "0.1")


def labels(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def scored(spark):
    docs = table(spark, SF, "documents")
    return toxicity.toxicity(docs, table(spark, SF, "labels")).join(table(spark, SF, "labels"), "doc_id").toPandas()


def test_toxicity_on_held_out_documents(scored):
    test = scored[scored.held_out]
    assert (test.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in test.doc_id]).all()
    hit = ((test.predicted == 1) & (test.toxic == 1)).sum()
    assert hit / (test.toxic == 1).sum() > 0.85
    assert ((test.predicted == 1) & (test.toxic == 0)).sum() / (test.toxic == 0).sum() < 0.05
    assert ((scored.score >= 0) & (scored.score <= 1)).all()
    assert (scored.predicted == (scored.score >= 0.3)).all()


def test_labels_and_other_columns_are_no_input(spark, scored):
    """A document's score depends on its text alone, once the model is fitted."""
    docs = table(spark, SF, "documents")
    changed = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None))
    again = toxicity.toxicity(changed, table(spark, SF, "labels")).toPandas().set_index("doc_id").score
    assert np.allclose(again.loc[scored.doc_id], scored.score)


@pytest.mark.parametrize("clash", [False, True])
def test_toxicity_of_awkward_rows(spark, clash):
    docs = awkward(spark, clash)
    some = labels(spark, [(7, 1, 1), (7, 1, 0), (8, 1, 1), (9, 0, 0), (13, 1, 0), (17, 1, None), (None, 1, 1), (999, 1, 1)])
    out = toxicity.toxicity(docs, some).collect()
    assert len(out) == len(rows())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    wordless = {r["score"] for r in out if r["doc_id"] in (0, 1, 2)}
    assert len(wordless) == 1 and len({r["score"] for r in out if r["doc_id"] == 100}) == 1
    left = toxicity.without_toxic(docs, some)
    assert left.columns == docs.columns
    assert left.count() == sum(r["predicted"] == 0 for r in out)


def test_toxicity_without_labels_or_rows(spark):
    none = toxicity.toxicity(awkward(spark), labels(spark, []))
    assert {r["score"] for r in none.collect()} == {0.0}
    assert toxicity.toxicity(empty(spark), labels(spark, [(1, 1, 1)])).isEmpty()


def test_letter_probabilities_sum_to_one():
    spelling = toxicity.Spelling([[b"tree", b"three", b"thing"], [b"bad", b"badly", b"thing"]])
    for c in (0, 1):
        for context in (b"", b"t", b"th", b"\x01\x01\x01\x01", b"zzzz", b"\x01bad"):
            assert math.isclose(sum(spelling.letter(c, context + bytes([k])) for k in range(256)), 1, rel_tol=1e-9)


def test_gradients_of_the_network():
    net = lm_score.Network(classes=4, in_class=4, width=3, hidden=5)
    net.parts = {k: v.astype(np.float64) for k, v in net.parts.items()}
    rng = np.random.default_rng(0)
    around, target = rng.integers(0, 17, (6, 4)), rng.integers(0, 16, 6)
    loss = lambda: -net.log_probability(around, target).mean()
    before = {k: v.copy() for k, v in net.parts.items()}
    squares = {k: np.zeros_like(v) for k, v in before.items()}
    net.step(around, target, squares, 0.0)
    for name, s in squares.items():
        for place in list(np.ndindex(s.shape))[:: max(s.size // 7, 1)]:
            ends = []
            for sign in (1, -1):
                net.parts[name][place] = before[name][place] + sign * 1e-5
                ends.append(loss())
            net.parts[name][place] = before[name][place]
            assert math.isclose(((ends[0] - ends[1]) / 2e-5) ** 2, s[place], rel_tol=1e-3, abs_tol=1e-9)


def test_probabilities_sum_to_one():
    net = lm_score.Network(classes=4, in_class=4, width=3, hidden=5)
    around = np.array([[1, 2, 16, 16]] * 16)
    assert math.isclose(np.exp(net.log_probability(around, np.arange(16))).sum(), 1, rel_tol=1e-5)


def test_lm_scores_prefer_ordered_text(spark):
    """Texts of fixed phrases score better than the same words shuffled, and than a model of single words."""
    rng = np.random.default_rng(3)
    phrases = [[f"p{k}w{j}" for j in range(6)] for k in range(30)]
    made = [[w for k in rng.integers(0, 30, 40) for w in phrases[k]] for _ in range(300)]
    shuffled = [list(rng.permutation(t)) for t in made[:20]]
    docs = [(k, " ".join(t)) for k, t in enumerate(made)] + [(1000 + k, " ".join(t)) for k, t in enumerate(shuffled)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    out = {r["doc_id"]: r for r in lm_score.lm_scores(df, rounds=4).collect()}
    assert all(r["n_words"] == 240 for r in out.values())
    good = np.mean([out[k]["mean_log_likelihood"] for k in range(20)])
    assert good > np.mean([out[1000 + k]["mean_log_likelihood"] for k in range(20)]) + 0.3
    assert good > -math.log(180)


@pytest.mark.parametrize("clash", [False, True])
def test_lm_scores_of_awkward_rows(spark, clash):
    out = lm_score.lm_scores(awkward(spark, clash)).collect()
    assert len(out) == len(rows())
    for r in out:
        if r["n_words"] == 0:
            assert r["log_likelihood"] == 0 and r["mean_log_likelihood"] == 0
        else:
            assert r["log_likelihood"] < 0
            assert math.isclose(r["mean_log_likelihood"], r["log_likelihood"] / r["n_words"])
    assert len({round(r["log_likelihood"], 3) for r in out if r["doc_id"] == 100}) == 1
    assert lm_score.lm_scores(empty(spark)).isEmpty()
