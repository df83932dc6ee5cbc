"""Benchmark decontamination with a positional inverted index.

The index is a stored table with one row per document: for every benchmark
term in it, the ascending word positions (its postings).  It is built where
the documents lie and never regrouped by term, so a word that stands in every
line of the corpus makes no task larger than another.

A window is ``window`` consecutive words of a benchmark item (a shorter item is
one window).  To find it in a batch of documents, the posting list of the
window's rarest term (by its corpus frequency, summed from the index) is
shifted by the term's offset and intersected with the shifted lists of the
next rarer terms, until no start is left or all terms agree: those are exact
phrases.  With ``slop`` > 0 the same intersection allows every term to stand up
to ``slop`` words from its place: proximity matches.

The benchmark is read in blocks of ``block_words`` words; only one block's terms
and windows are shipped to the executors at a time, and each block has an
index of its own.  Results of the blocks are combined per document.

Words: after lower-casing A-Z, runs of ``0-9``, ``a-z`` and characters outside
ASCII.  Defined results: null and wordless texts have no words, no hits and
are not contaminated; items without words have no window; items that repeat an
id count once; an item without an id marks words but is not listed; rows that
repeat an id and text get the same result each.  An empty benchmark hits
nothing, an empty table gives an empty result.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.llm.common import col, settle, text_of

WINDOW = 13
BLOCK_WORDS = 500_000
#: a part that is searched at once has at most so many documents, and so many places unless it is one document
PART_ROWS = 2000
PART_PLACES = 2_000_000
#: bytes to bytes: A-Z lowered, everything that is not part of a word becomes a space
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
HIT = "array<struct<first:int,after:int>>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class Windows:
    """The windows of one block of items: a vocabulary and rows of term numbers."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        vocabulary = sorted({w for _, words in items for w in words})
        self.number = {w: k for k, w in enumerate(vocabulary)}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, words in items:
            terms = [self.number[w] for w in words]
            for k in range(max(len(terms) - window, 0) + 1):
                own = owners.setdefault(tuple(terms[k : k + window]), set())
                if item is not None:
                    own.add(item)
        self.windows = list(owners)
        self.owners = [sorted(o) for o in owners.values()]
        self.terms = len(vocabulary)

    def plan(self, frequency: np.ndarray) -> list[list[tuple[int, int]]]:
        """For each window its (term, offset), the rarest term first, each repeated term at all its offsets."""
        return [sorted(((t, k) for k, t in enumerate(w)), key=lambda x: (frequency[x[0]], x)) for w in self.windows]


def blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> Iterator[Windows]:
    """Items in blocks of bounded size, streamed through the driver."""
    held: list[tuple[str | None, list[bytes]]] = []
    size = 0
    rows = benchmark.select(col(id_col).cast("string").alias("item"), F.encode(text_of(text_col), "UTF-8").alias("utf8"))
    for row in rows.toLocalIterator():
        words = words_of(bytes(row["utf8"]))
        if words:
            held.append((row["item"], words))
            size += len(words)
        if size >= block_words:
            yield Windows(held, window)
            held, size = [], 0
    if held or size == 0:
        yield Windows(held, window)


def build_index(df: DataFrame, block: Windows, id_col: str, text_col: str) -> DataFrame:
    """id, text_key, n_words and the postings: terms, how many positions each has, and the positions."""
    number = block.number
    rows = df.select(
        col(id_col).alias("id"),
        F.xxhash64(text_of(text_col)).alias("text_key"),
        F.encode(text_of(text_col), "UTF-8").alias("utf8"),
    )
    schema = T.StructType(
        [
            rows.schema[0],
            T.StructField("text_key", T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("terms", T.ArrayType(T.IntegerType())),
            T.StructField("sizes", T.ArrayType(T.IntegerType())),
            T.StructField("positions", T.ArrayType(T.IntegerType())),
        ]
    )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, terms, sizes, positions = [], [], [], []
            for text in batch.column(2):
                words = words_of(text.as_py())
                ids = np.fromiter(map(number.get, words, repeat(-1)), np.int32, len(words))
                at = np.flatnonzero(ids >= 0).astype(np.int32)
                at = at[np.argsort(ids[at], kind="stable")]
                own, counts = np.unique(ids[at], return_counts=True)
                n.append(len(words))
                terms.append(own)
                sizes.append(counts.astype(np.int32))
                positions.append(at)
            numbers = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(n, pa.int64()),
                    *(pa.array(x, numbers) for x in (terms, sizes, positions)),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(index, schema)


def term_frequencies(index: DataFrame, terms: int) -> np.ndarray:
    """How often each term of the block stands in the corpus."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            own, sizes = (batch.column(c).flatten().to_numpy() for c in (0, 1))
            total += np.bincount(own, sizes, minlength=terms).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["term", "n"])

    out = np.zeros(terms, np.int64)
    counted = index.select("terms", "sizes").mapInArrow(add, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    for row in counted.collect():  # at most one row per term of the block
        out[row["term"]] = row["n"]
    return out


def starts_of(order: list[tuple[int, int]], postings: list[np.ndarray], slop: int) -> np.ndarray:
    """Where a window starts: shifted lists intersected, the rarest first, each place within ``slop``."""
    term, offset = order[0]
    found = postings[term] - offset
    if slop:
        found = np.unique((found[:, None] + np.arange(-slop, slop + 1)).ravel())
    for term, offset in order[1:]:
        if not len(found):
            break
        places = postings[term]
        at = np.searchsorted(places, found + offset - slop)
        at[at == len(places)] = len(places) - 1
        there = places[at]
        found = found[(there >= found + offset - slop) & (there <= found + offset + slop)]
    return found


def merged(first: np.ndarray, after: np.ndarray) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(zip(first.tolist(), after.tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def intersect(index: DataFrame, block: Windows, frequency: np.ndarray, slop: int) -> DataFrame:
    """id, text_key, n_words, exact and proximity hits (merged word ranges) and the items of the exact ones."""
    orders, owners, terms = block.plan(frequency), block.owners, block.terms
    width = max(map(len, orders), default=1)
    table = np.array([[t for t, _ in o] + [o[0][0]] * (width - len(o)) for o in orders], np.int64).reshape(-1, width)
    schema = T.StructType(
        [*index.schema.fields[:3], *T.StructType.fromDDL(f"hits {HIT}, near {HIT}, items array<string>").fields]
    )
    ranges = pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))

    def search(part: pa.RecordBatch) -> pa.RecordBatch:
        n = part.num_rows
        lengths = part.column(2).to_numpy()
        base = np.zeros(n, np.int64)  # documents in one line, too far apart for a window over two
        np.cumsum(lengths[:-1] + 2 * (width + slop), out=base[1:])
        own, sizes, places = (part.column(k).flatten().to_numpy().astype(np.int64) for k in (3, 4, 5))
        doc_terms = np.diff(part.column(3).offsets.to_numpy())
        doc_places = np.diff(part.column(5).offsets.to_numpy())
        places = places + np.repeat(base, doc_places)
        by_term = np.repeat(own, sizes)
        order = np.argsort(by_term, kind="stable")
        places, bounds = places[order], np.searchsorted(by_term[order], np.arange(terms + 1))
        postings = [places[bounds[t] : bounds[t + 1]] for t in range(terms)]
        alive = np.flatnonzero((np.diff(bounds) > 0)[table].all(axis=1)) if len(table) else []
        found: list[tuple[list, list, set]] = [([], [], set()) for _ in range(n)]
        for w in alive:
            exact = starts_of(orders[w], postings, 0)
            loose = starts_of(orders[w], postings, slop) if slop else exact
            for starts, k in ((exact, 0), (loose, 1)):
                docs = np.searchsorted(base, starts, "right") - 1
                for d, s in zip(docs.tolist(), (starts - base[docs]).tolist(), strict=True):
                    a, b = max(s, 0), min(s + len(orders[w]), int(lengths[d]))
                    if a < b:
                        found[d][k].append((a, b))
                        if k == 0:
                            found[d][2].update(owners[w])
        spans = [[merged(*np.array(f[k], np.int64).reshape(-1, 2).T) for f in found] for k in (0, 1)]
        as_rows = [[[{"first": a, "after": b} for a, b in doc] for doc in s] for s in spans]
        return pa.RecordBatch.from_arrays(
            [
                *(part.column(k) for k in range(3)),
                *(pa.array(s, ranges) for s in as_rows),
                pa.array([sorted(f[2]) for f in found], pa.list_(pa.string())),
            ],
            names=schema.names,
        )

    def all_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            upto = batch.column(5).offsets.to_numpy()
            low = 0
            while low < batch.num_rows:
                most = int(np.searchsorted(upto, upto[low] + PART_PLACES, "right")) - 1
                high = max(low + 1, min(low + PART_ROWS, most, batch.num_rows))
                # a copy: slices keep the offsets of the whole batch
                yield search(pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([c]) for c in batch.slice(low, high - low).columns], names=batch.schema.names
                ))
                low = high

    return index.mapInArrow(all_batches, schema)


def covered(ranges: str):
    """Words inside a set of ranges."""
    ordered = F.array_sort(F.col(ranges))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))
    step = lambda acc, r: F.struct(
        (acc["n"] + F.greatest(r["after"] - F.greatest(r["first"], acc["upto"]), F.lit(0))).alias("n"),
        F.greatest(acc["upto"], r["after"]).alias("upto"),
    )
    return F.aggregate(ordered, start, step, lambda acc: acc["n"])


def decontaminate(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    slop: int = 0,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per input row: id, n_words, hits and near (word ranges), items, n_hit, n_near."""
    parts = []
    for block in blocks(benchmark, item_col, item_text_col, window, block_words):
        index = settle(build_index(df, block, id_col, text_col), "postings")
        parts.append(intersect(index, block, term_frequencies(index, block.terms), slop))
    out = parts[0]
    if len(parts) > 1:
        for part in parts[1:]:
            out = out.union(part)
        merged_rows = out.groupBy("id", "text_key", "n_words").agg(
            F.flatten(F.collect_list("hits")).alias("hits"),
            F.flatten(F.collect_list("near")).alias("near"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            (F.count("*") / len(parts)).cast("int").alias("times"),
        )
        out = merged_rows.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return out.select(
        F.col("id").alias(id_col),
        "text_key",
        "n_words",
        "hits",
        "near",
        "items",
        covered("hits").alias("n_hit"),
        covered("near").alias("n_near"),
    )


def verdicts(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Contaminated: at least one word in twenty lies in a benchmark window."""
    return found.select(
        id_col,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        "n_near",
    )


def clean(df: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are not contaminated, with all their columns."""
    bad = found.where((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).select(
        col(id_col).alias("bad_id"), F.col("text_key").alias("bad_key")
    )
    rows = df.select(F.struct("*").alias("row"), col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("key"))
    same = F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("key") == F.col("bad_key"))
    return rows.join(bad.distinct(), same, "left_anti").select("row.*")
