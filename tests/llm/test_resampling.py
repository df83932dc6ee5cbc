"""Importance resampling against a plain version, whole texts and single words."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from tests.conftest import SF_DIR
from tests.llm import plain
from tests.llm.awkward import awkward, documents, empty, rows
from ticketlake.llm import queries, resampling
from ticketlake.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = [(1, "one two three four over the lazy dog"), (2, None), (3, ""), (None, "été 日本語 repeated"), (1, "word1 word2")]
COLUMNS = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]


def features(text, orders, buckets):
    words = WORD.findall(plain.lower(text))
    grams = [" ".join(words[k : k + n]) for n in range(orders[0], orders[1] + 1) for k in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % buckets for g in grams]


def brute(docs, items, orders=(1, 1), buckets=10_000, share=(10, 100), min_words=20, seed=2024):
    made = [features(t, orders, buckets) for _, t in docs]
    s, t = Counter(b for _, f in made for b in f), Counter(b for _, x in items for b in features(x, orders, buckets)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1.0) * (s_all + buckets) / ((s[b] + 1.0) * (t_all + buckets)))) for b in range(buckets)
    ]
    out = []
    for (i, _), (n, f) in zip(docs, made, strict=True):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = math.floor(sum(gain[b] for b in f) / len(f)) if f else 0
        out.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, row in enumerate(able[: share[0] * len(able) // share[1]]):
        row[5] = k + 1
    return sorted(map(tuple, out), key=repr)


def got(df, columns=COLUMNS):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


AWKWARD = [(r[0], r[1]) for r in rows()]


@pytest.mark.parametrize("clash", [False, True])
@pytest.mark.parametrize("method", [{}, {"orders": (1, 3), "buckets": 70_000, "share": (1, 2), "min_words": 3}, {"orders": (2, 2), "share": (1, 1), "min_words": 0}])
def test_awkward_rows(spark, method, clash):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = resampling.importance_resampling(awkward(spark, clash).repartition(3), items, **method)
    assert got(found) == brute(AWKWARD, ITEMS, **method)


def test_pieces_of_long_texts_make_no_difference(spark, monkeypatch):
    known = resampling.Crcs()
    texts = [plain.lower(t).encode() for _, t in AWKWARD]
    whole = resampling.batch_features(texts, (1, 4), 5000, known)
    monkeypatch.setattr(resampling, "PIECE", 7)
    cut = resampling.batch_features(texts, (1, 4), 5000, known)
    assert [sorted(f) for f in cut[0]] == [sorted(f) for f in whole[0]] and (cut[1] == whole[1]).all()


def test_small_table(spark):
    items = [tuple(r) for r in table(spark, SF_DIR, "benchmark").collect()]
    found = queries.QUERIES["op13_resampling"](spark, SF_DIR)
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    expected = [(r[0], *r[2:]) for r in brute(documents(), items)]
    assert got(found, columns) == sorted(expected, key=repr)
    assert found.where("rank is not null").count() > 10


def test_drawn_rows(spark):
    docs = table(spark, SF_DIR, "documents")
    scores = resampling.importance_resampling(docs, table(spark, SF_DIR, "benchmark"))
    left = resampling.drawn(docs, scores)
    ids = {r["doc_id"] for r in scores.where("rank is not null").collect()}
    assert {r["doc_id"] for r in left.collect()} == ids and left.columns == docs.columns


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert got(resampling.importance_resampling(empty(spark), items)) == []
    none = items.where("false")
    assert got(resampling.importance_resampling(awkward(spark), none)) == brute(AWKWARD, [])


def test_target_rows_come_first(spark):
    """Documents in the target's words are drawn, others are not."""
    like = [(k, "alpha beta gamma delta " * 10) for k in range(50)]
    other = [(k, " ".join(f"w{k}x{j}" for j in range(40))) for k in range(1000, 1450)]
    df = spark.createDataFrame(like + other, "doc_id long, text string").repartition(4)
    items = spark.createDataFrame([("alpha beta gamma delta " * 500,)], "text string")
    found = resampling.importance_resampling(df, items, buckets=100)
    top = [r["doc_id"] for r in found.where("rank is not null").collect()]
    assert len(top) == 50 and sum(i < 50 for i in top) >= 40
