"""Every stage of the pipeline against a plain version, each on what its predecessor left."""

import math

import pytest

import corpus_pipeline
from tests.conftest import SF_DIR
from tests.llm import plain
from tests.llm.awkward import SCHEMA, awkward, rows
from tests.llm.test_packing_and_warc import check
from ticketlake.llm import toxicity
from ticketlake.llm.common import settle, table


def expected_toxicity(spark, docs):
    model = toxicity.fitted(spark.createDataFrame(docs, SCHEMA), table(spark, SF_DIR, "labels"))
    if model is None:  # no labelled text of one class: every score is 0
        return docs
    ratios, slope, intercept = model
    score = lambda t: 1 / (1 + math.exp(-(slope * ratios.of(t or "") + intercept)))
    return [d for d in docs if score(d[1]) < toxicity.THRESHOLD]


def expected_lines(spark, docs):
    left = plain.line_dedup([d[:2] for d in docs])
    return [
        (d[0], None if d[1] is None else t, *d[2:4], None if d[1] is None else len(t)) for d, (_, t) in zip(docs, left, strict=True)
    ]


def expected_near(spark, docs):
    """One row of each group, its smallest id, null ids last; no group of these tables has one id with several texts."""
    links = plain.near([(k, d[1]) for k, d in enumerate(docs)])  # places as ids tell all groups apart
    groups = {}
    for k, n, group, _ in links:
        groups.setdefault((group if n else f"wordless {k}"), []).append(docs[k])
    return [min(g, key=lambda d: (d[0] is None, d[0] or 0)) for g in groups.values()]


def expected_clean(spark, docs):
    items = [tuple(r) for r in table(spark, SF_DIR, "benchmark").collect()]
    return [d for d, hit in zip(docs, plain.hits([d[:2] for d in docs], items), strict=True) if not hit[5]]


EXPECTED = [expected_toxicity, expected_lines, expected_near, expected_clean]


@pytest.mark.parametrize("source", ["small table", "awkward rows"])
def test_stages(spark, source):
    if source == "small table":
        docs = table(spark, SF_DIR, "documents")
    else:
        docs = awkward(spark)
    plain_docs = sorted((tuple(r) for r in docs.collect()), key=repr) if source == "small table" else rows()
    for (name, stage), brute in zip(corpus_pipeline.STAGES[:-1], EXPECTED, strict=True):
        columns = docs.columns
        docs = settle(stage(spark, docs, SF_DIR), name)
        plain_docs = brute(spark, plain_docs)
        assert docs.columns == columns
        assert sorted((tuple(r) for r in docs.collect()), key=repr) == sorted(plain_docs, key=repr), name
    if source == "small table":
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
        check([d[:2] for d in plain_docs], packed, 4096)
        whole = corpus_pipeline.run(spark, SF_DIR)
        keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
        assert sorted(map(tuple, whole.select(*keep).collect())) == sorted(tuple(r[c] for c in keep) for r in packed)


def test_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, SF_DIR), name)
        assert docs.isEmpty()
