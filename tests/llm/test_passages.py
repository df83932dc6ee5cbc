"""Line deduplication against a plain finder of repeated passages that knows no chunks."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tests.llm.awkward import documents
from ticketlake.llm import line_dedup
from ticketlake.llm.common import table

COMMON = [
    *(" ".join(f"of{n}line{k}word{j}" for j in range(4)) for n in range(2, 9) for k in range(n)),
    " ".join(f"paragraph{j}" for j in range(60)),
]


def left(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return {r["doc_id"]: r["text"] for r in line_dedup.shortened(df).collect()}


def test_short_passages_between_other_neighbours(spark):
    """Passages of 2 to 8 lines, and one paragraph of a single line, each between own lines in twelve texts."""
    rng = random.Random(5)
    docs, own = [], {}
    for d in range(12):
        lines, own[d] = [], []
        for n in [*range(2, 9), 1]:
            mine = [f"own {d} {n} {k} {rng.random()}" for k in range(rng.randint(1, 3))]
            lines += mine + (COMMON[-1:] if n == 1 else [x for x in COMMON if x.startswith(f"of{n}line")])
            own[d] += mine
        lines.append(f"the end of {d}")
        own[d].append(f"the end of {d}")
        docs.append((d, "\n".join(lines)))
    out = left(spark, docs)
    assert out[0] == docs[0][1]
    assert all(out[d] == "\n".join(own[d]) for d in range(1, 12))


def test_blank_lines_short_lines_and_runs(spark):
    docs = [(1, "a\n\n\nb\nc"), (2, "x\na\n\n\nb\ny"), (3, "x1\na\n\nb\ny1"), (4, "q\nb\nq"), (5, "r\n" * 5 + "r"), (6, "\n\n\n"), (7, "\n\n\n")]
    out = left(spark, docs)
    assert out == {1: docs[0][1], 2: "x\ny", 3: docs[2][1], 4: docs[3][1], 5: "r\nr", 6: "\n\n\n", 7: "\n\n\n"}


def test_counts(spark):
    shared = "shared one\nshared two"
    docs = [(1, f"p\n{shared}\nq"), (2, f"{shared}\nu\n{shared}\nv")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r["id"]: (r["n_lines"], r["n_removed"], r["n_chunks"]) for r in line_dedup.line_dedup(df).collect()}
    assert found == {1: (4, 0, 0), 2: (6, 4, 2)}


def runs_held_before(docs):
    """By text: the places of all pairs of visible neighbours and long lines that stand earlier too."""
    seen, out = {}, {}
    for d, text in sorted(docs, key=lambda x: (x[0] is None, x[0])):
        lines = (text or "").split("\n")
        shown = [k for k, x in enumerate(lines) if any(c > " " for c in x)]
        spans = [(a, b + 1) for a, b in zip(shown, shown[1:], strict=False)] + [(k, k + 1) for k in shown if len(lines[k]) >= 100]
        gone = set()
        for a, b in sorted(spans):
            content = "\n".join(lines[a:b])
            where = seen.setdefault(content, (d, a, b))
            if where != (d, a, b) and not (where[0] == d and a < where[2]):
                gone |= set(range(a, b))
        out[d] = lines, gone
    return out


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_every_repeated_run_goes_and_every_line_stays_somewhere(spark, sf):
    path = SF_DIR.replace("0.001", sf)
    docs = documents() if sf == "0.001" else [tuple(r) for r in table(spark, path, "documents").select("doc_id", "text").collect()]
    assert len({d for d, _ in docs}) == len(docs)
    out = {r["doc_id"]: r["left"] for r in line_dedup.shortened(table(spark, path, "documents")).select("doc_id", F.coalesce("text", F.lit("")).alias("left")).collect()}
    repeated = 0
    for d, (lines, gone) in runs_held_before(docs).items():
        repeated += len(gone)
        rest = iter([x for k, x in enumerate(lines) if k not in gone])
        assert all(any(x == y for y in rest) for x in (out[d].split("\n") if out[d] else []))  # what is left is in the rest, in order
        # beyond the runs, chunks take only lines beside blank ones
    assert repeated > 0
    stay = {x for t in out.values() for x in t.split("\n")}
    assert all(x in stay for _, t in docs for x in (t or "").split("\n") if x)


def test_one_text_of_very_many_short_lines(spark):
    """Linear in the lines: a text of 100,000 of them, and one that repeats its middle."""
    lines = [f"l{k * 7919 % 100_003}" for k in range(100_000)]
    docs = [(1, "\n".join(lines)), (2, "own\n" + "\n".join(lines[1000:60_000]) + "\nend")]
    began = time.monotonic()
    out = left(spark, docs)
    assert out == {1: docs[0][1], 2: "own\nend"}
    assert time.monotonic() - began < 60
