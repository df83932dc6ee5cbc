"""Each operator against its plain version, on the small table and on awkward rows."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF_DIR
from tests.llm import plain
from tests.llm.awkward import as_bag, awkward, documents, empty, rows
from ticketlake.llm import decontaminate, exact_dedup, line_dedup, near_dedup, pii, queries, suffix_dedup
from ticketlake.llm.common import table

AWKWARD = [(r[0], r[1]) for r in rows()]


def ordered(expected):
    return sorted(expected, key=repr)


CASES = {
    "op1": (
        exact_dedup.exact_dedup,
        ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
        plain.exact,
    ),
    "op3": (
        lambda df: pii.report(pii.personal_data(df)),
        ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"],
        plain.personal,
    ),
    "op4": (
        lambda df: suffix_dedup.suffix_dedup(df).select(
            "doc_id", "n_bytes", "n_removed", F.size("spans").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
        ),
        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        plain.repeated_bytes,
    ),
    "op5": (
        lambda df: line_dedup.shortened(df).select("doc_id", F.coalesce("text", F.lit("")).alias("left")),
        ["doc_id", "left"],
        plain.line_dedup,
    ),
    "op10": (near_dedup.near_dedup, ["doc_id", "n_shingles", "component_id", "kept"], plain.near),
}


@pytest.mark.parametrize("name", CASES)
def test_awkward_rows(spark, name):
    operator, columns, brute = CASES[name]
    expected = ordered(brute(AWKWARD))
    assert as_bag(operator(awkward(spark)), *columns) == expected
    assert as_bag(operator(awkward(spark, clash=True)), *columns) == expected


@pytest.mark.parametrize("name", CASES)
def test_small_table(spark, name):
    operator, columns, brute = CASES[name]
    expected = ordered(brute(documents()))
    assert as_bag(operator(table(spark, SF_DIR, "documents")), *columns) == expected


@pytest.mark.parametrize("name", CASES)
def test_empty_table(spark, name):
    operator, columns, _ = CASES[name]
    assert operator(empty(spark)).select(*columns).collect() == []


ITEMS = [(1, "one two three four"), (2, plain.lower("seven WIZARDS quietly judge the quick brown fox jumps over the lazy dog while seven")), (None, "été über"), (3, None), (3, ""), (2, "a")]


def bench(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 5])
def test_decontaminate_awkward(spark, block_words):
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    for clash in (False, True):
        found = decontaminate.decontaminate(awkward(spark, clash), bench(spark), block_words=block_words)
        assert as_bag(decontaminate.verdicts(found), *columns) == ordered(plain.hits(AWKWARD, ITEMS))


def test_decontaminate_small_table_and_clean(spark):
    docs = table(spark, SF_DIR, "documents")
    items = [tuple(r) for r in table(spark, SF_DIR, "benchmark").collect()]
    found = decontaminate.decontaminate(docs, table(spark, SF_DIR, "benchmark"), slop=2)
    expected = plain.hits(documents(), items)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert as_bag(decontaminate.verdicts(found), *columns) == ordered(expected)
    assert found.where("n_near < n_hit").isEmpty()
    left = {r["doc_id"] for r in decontaminate.clean(docs, found).collect()}
    assert left == {e[0] for e in expected if not e[5]}


def test_decontaminate_near_misses(spark):
    docs = spark.createDataFrame([(1, "alpha beta x gamma delta"), (2, "alpha beta gamma delta"), (3, "delta gamma beta alpha")], "doc_id long, text string")
    found = decontaminate.decontaminate(docs, bench(spark, [(7, "alpha beta gamma delta")]), slop=1)
    assert as_bag(found, "doc_id", "n_hit", F.col("n_near") > 0) == [(1, 0, True), (2, 4, True), (3, 0, False)]


@pytest.mark.parametrize("places", [1, 40])
def test_decontaminate_parts_do_not_matter(spark, monkeypatch, places):
    monkeypatch.setattr(decontaminate, "PART_PLACES", places)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    found = decontaminate.decontaminate(awkward(spark).coalesce(1), bench(spark))
    assert as_bag(decontaminate.verdicts(found), *columns) == ordered(plain.hits(AWKWARD, ITEMS))


def test_decontaminate_long_texts_are_searched_in_parts(spark):
    """300 texts of 20,000 benchmark words each; searched at once they take 240 MB."""

    class Index:
        schema = T.StructType.fromDDL("id long, text_key long, n_words long")

        def mapInArrow(self, function, schema):
            self.search = function
            return self

    texts, length, terms = 300, 20_000, 200
    drawn = np.random.default_rng(1).integers(0, terms, (texts, length))
    counts = [np.bincount(d, minlength=terms).astype(np.int32) for d in drawn]
    places = [np.argsort(d, kind="stable").astype(np.int32) for d in drawn]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(texts)), pa.array(range(texts)), pa.array([length] * texts)]
        + [pa.array(x, pa.list_(pa.int32())) for x in ([np.arange(terms, dtype=np.int32)] * texts, counts, places)],
        names=["id", "text_key", "n_words", "terms", "sizes", "positions"],
    )
    block = decontaminate.Windows([("1", [b"%03d" % k for k in range(terms)])], decontaminate.WINDOW)
    index = decontaminate.intersect(Index(), block, np.sum(counts, 0), 2)
    tracemalloc.start()
    found = sum(part.num_rows for part in index.search(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == texts
    assert peak < 160e6


def test_decontaminate_without_items_or_rows(spark):
    none = decontaminate.decontaminate(awkward(spark), bench(spark, []))
    assert none.where("n_hit > 0").isEmpty() and none.count() == len(AWKWARD)
    assert decontaminate.decontaminate(empty(spark), bench(spark)).isEmpty()


def test_exact_dedup_keeps_one_row_of_each_text(spark):
    left = exact_dedup.deduplicated(awkward(spark, clash=True))
    texts = [plain.SPACE.sub("", r["text"] or "") for r in left.collect()]
    assert sorted(texts) == sorted({plain.SPACE.sub("", t or "") for _, t in AWKWARD})
    assert left.columns == awkward(spark, clash=True).columns


def test_near_dedup_keeps_one_row_of_each_group(spark):
    left = near_dedup.representatives(awkward(spark, clash=True))
    groups = plain.near(AWKWARD)
    wordless = sum(n == 0 for _, n, _, _ in groups)
    assert left.columns == awkward(spark, clash=True).columns
    assert left.count() == wordless + len({c for _, n, c, _ in groups if n})


def test_near_dedup_finds_a_link_that_no_pivot_shows(spark):
    """A long chain of near copies, each similar only to its neighbours, and a star whose points differ."""
    words = [f"w{k}" for k in range(400)]
    chain = [(k, " ".join(words[6 * k : 6 * k + 120])) for k in range(40)]
    base = [f"b{k}" for k in range(200)]
    star = [(1000, " ".join(base))]
    for k in range(60):
        own = list(base)
        for j in range(3):
            own[(k * 3 + j * 61) % 195 + 2] = f"edit{k}x{j}"
        star.append((1001 + k, " ".join(own)))
    docs = chain + star
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    columns = ["doc_id", "n_shingles", "component_id", "kept"]
    assert as_bag(near_dedup.near_dedup(df), *columns) == ordered(plain.near(docs))


def test_one_row_stays_of_groups_that_share_ids_or_have_none(spark):
    text = " ".join(f"w{k}" for k in range(60))
    near = text + " and more"
    other = " ".join(f"v{k}" for k in range(60))
    docs = [(1, text), (1, near), (1, near), (None, other), (None, other + " x"), (2, "alone in its group here")]
    left = near_dedup.representatives(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] or 0 for r in left) == [0, 1, 2]


def test_a_block_gives_few_links_for_many_similar_members(spark):
    """300 variants, most of them similar to each other: links join components, they do not list pairs."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**32, 400, np.uint64).astype("<u4")
    sets = [np.unique(np.concatenate([np.delete(base, rng.integers(0, 400, 30)), rng.integers(0, 2**32, 30, np.uint64).astype("<u4")])) for _ in range(300)]
    keys = [b"%03d" % k for k in range(300)]
    a, b = near_dedup.coefficients(near_dedup.FINE)
    bits = [near_dedup.signature(x.astype(np.uint64), a, b) & 15 for x in sets]
    fine = [(x[::2] | x[1::2] << 4).astype(np.uint8).tobytes() for x in bits]
    same = np.zeros(32 * 4, "<u4").tobytes()  # all buckets in common
    rows = [
        (k, k, len(s), s.tobytes(), f, same, 0, asks) for asks in (False, True) for k, s, f in zip(keys, sets, fine, strict=True)
    ]
    fields = ["set_key", "component", "n", "short", "fine", "signature", "band", "asks"]
    links = near_dedup.block_links(pa.table(dict(zip(fields, map(list, zip(*rows, strict=True)), strict=True))), 75, 32)
    similar = [(a, b) for a in range(300) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))]
    assert len(similar) > 5000 and len(links) == 299 - (300 - len({x for p in similar for x in p}))
    assert all((int(b), int(a)) in similar for a, b in links)


def test_suffix_dedup_within_one_periodic_text(spark):
    docs = [(1, "abc " * 300), (2, "x" * 399), (3, "x" * 400), (4, "y" * 401 + "q" * 500), (5, "".join(chr(97 + k * k % 23) for k in range(900)))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    operator, columns, brute = CASES["op4"]
    assert as_bag(operator(df), *columns) == ordered(brute(docs))


def test_suffix_dedup_with_large_groups(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", 3)
    shared = " ".join(f"shared{k}" for k in range(70))
    docs = [(k, f"begin{k} " * 30 + shared + f" end{k}" * 30) for k in range(12)] + [(50, shared), (51, shared + "!")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    operator, columns, brute = CASES["op4"]
    assert as_bag(operator(df), *columns) == ordered(brute(docs))


def test_terms_that_give_an_entity_away(spark):
    told = [(k, f"{'filler text ' * k} the zebrafish keeper wrote to jo@x.org from home number{k}") for k in range(1, 6)]
    other = [(k, f"the keeper of something else {k} was at home") for k in range(10, 60)]
    df = spark.createDataFrame(told + other, "doc_id long, text string")
    found = pii.personal_data(df)
    shown = {r["doc_id"]: r["spans"] for r in pii.report(found).collect()}
    for k, text in told:
        a = text.index("zebrafish")
        assert f"term:{a}:{a + 9}" in shown[k]
        assert "term" not in shown[10 + k]
        assert f":{text.index('keeper')}:" not in shown[k]  # a common word tells little
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(df, found).collect()}
    assert "zebrafish" not in clean[1] and "<email>" in clean[1] and "keeper" in clean[1]
    assert clean[20] == dict(other)[20]


def test_copies_are_no_evidence(spark):
    text = "the zebrafish keeper wrote to jo@x.org from home"
    df = spark.createDataFrame([(k, text) for k in range(8)] + [(k, "nothing here") for k in range(10, 20)], "doc_id long, text string")
    assert all("term" not in r["spans"] for r in pii.report(pii.personal_data(df)).collect())


def test_hostile_texts_for_the_patterns(spark):
    texts = ["1" * 50_000, "a" * 50_000, "1 " * 30_000, "+1" + "(" * 30_000, "a@" * 20_000, "1.2.3." * 10_000, "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "12  4111111111111111", "9 4111 1111 1111 1111", "x@y.z.@w.v"]
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    operator, columns, brute = CASES["op3"]
    assert as_bag(operator(df), *columns) == ordered(brute(docs))


def test_native_plans_have_no_python(spark):
    for name in ("op1_exact_dedup", "op3_personal_data", "op5_line_dedup"):
        plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "InArrow" not in plan and "CartesianProduct" not in plan
