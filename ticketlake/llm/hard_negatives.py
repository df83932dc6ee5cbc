"""Hard negatives of anchors, by segment summaries that bound inner products.

Vectors become whole numbers, ``floor(scale * x)``, and scores are their exact
inner products.  An anchor's positives are its best rows of the same label; for
each positive, the best rows of other labels that score at most as high as it
and at least ``percent`` of that are the hard negatives.

1. Every vector is stored once with the mean and the deviation of each of its
   segments, for every level of ``levels`` (a level cuts the vector into so many
   segments of one length).  Over a segment of length L two vectors' product lies
   within ``L * (mean * mean -+ deviation * deviation)``, so the sums bound the score.
2. Anchors are taken in blocks of at most about ``block``, against all rows.
   For a block and a batch of rows the coarsest level bounds all pairs; those
   that may still be among the best are bounded by the next finer level, and
   what is left after the last is scored exactly.  The scores found raise the
   limits for the batches that follow.
3. The limits a block starts with come from the anchors themselves, which are
   rows too: the best among them bound the best of all.  So a task sends on few
   rows that another task beats.

Only one block of anchors, its limits and its positives' scores pass through
the driver at a time.  No pair is left out: a bound only drops pairs that cannot
be in the result, with a margin for rounding.  The number of bounded pairs is
the number of anchors times the number of rows.

Defined results: rows with a null id or label, a null vector, or a null or
non-finite component take no part.  Shorter vectors are filled up with zeros.
Rows that repeat an id count once for each different score; of rows with an
anchor's id, the least one (by label, then numbers) is the anchor, and none is
its positive or negative.  An anchor without positives has no row, nor has a
positive without negatives.  Numbers beyond 32 bits or sums that a double
cannot hold exactly end the job with an error.  An empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketlake.llm.common import col, settle

LEVELS = (2, 8, 32)
BLOCK = 8192
TILE = 1024
DENSE = 64  # one matrix product for all pairs of a tile if at least every 64th of them is left
GATHERED = 1 << 22  # numbers taken together at once otherwise
ROUNDING = 1e-5  # share of the largest possible score that 32-bit bounds may be off by
EXACT = float(1 << 53)


def whole_numbers(vectors: pa.Array, width: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(which rows are valid, their numbers, zeros at the end)."""
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    row = np.repeat(np.arange(len(vectors)), lengths)
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    valid = vectors.is_valid().to_numpy(zero_copy_only=False)
    finite = np.isfinite(values)
    valid[row[~finite]] = False
    numbers = np.zeros((len(vectors), width))
    numbers[row[finite], place[finite]] = np.floor(scale * values[finite])
    numbers = numbers[valid]
    if len(numbers) and np.abs(numbers).max() >= 1 << 31:
        raise ValueError("a vector component does not fit into 32 bits after scaling")
    return valid, numbers


def summaries(numbers: np.ndarray, levels: tuple[int, ...]) -> np.ndarray:
    """Means, then deviations, of each level's segments, one row of 32-bit numbers per vector."""
    parts = []
    for segments in levels:
        cut = numbers.reshape(len(numbers), segments, -1)
        parts += [cut.mean(axis=2), cut.std(axis=2)]
    return np.concatenate([*parts, np.empty((len(numbers), 0))], axis=1).astype("<f4")


def fitting(width: int, levels: tuple[int, ...]) -> tuple[int, tuple[int, ...]]:
    """The width filled up so that every level divides it, and the levels that cut it at all."""
    levels = tuple(sorted({s for s in levels if s < width}))
    step = int(np.lcm.reduce(levels)) if levels else 1
    return max(-(-width // step), 1) * step, levels


@dataclass
class Level:
    length: int
    means: np.ndarray
    deviations: np.ndarray

    def pair_bounds(self, other: Level) -> tuple[np.ndarray, np.ndarray]:
        """(middle, reach) of all pairs' scores."""
        return self.length * (self.means @ other.means.T), self.length * (self.deviations @ other.deviations.T)

    def bounds(self, other: Level, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for the pairs (i, j)."""
        middle = pair_products(self.means, other.means, i, j)
        return self.length * middle, self.length * pair_products(self.deviations, other.deviations, i, j)


def pair_products(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of rows i of ``x`` with rows j of ``y``."""
    out, step = np.empty(len(i), x.dtype), max(GATHERED // max(x.shape[1], 1), 1)
    for at in range(0, len(i), step):
        part = slice(at, at + step)
        np.einsum("ij,ij->i", x[i[part]], y[j[part]], out=out[part])
    return out


@dataclass
class Vectors:
    ids: np.ndarray
    labels: np.ndarray
    numbers: np.ndarray
    levels: list[Level]

    @staticmethod
    def of(ids, labels, numbers: list[bytes], summary: list[bytes], width: int, levels: tuple[int, ...]) -> Vectors:
        whole = np.frombuffer(b"".join(numbers), "<i4").reshape(len(ids), width).astype(float)
        held = np.frombuffer(b"".join(summary), "<f4").reshape(len(ids), 2 * sum(levels))
        cut, at = [], 0
        for segments in levels:
            cut.append(Level(width // segments, held[:, at : at + segments], held[:, at + segments : at + 2 * segments]))
            at += 2 * segments
        return Vectors(np.asarray(ids, np.int64), np.asarray(labels, object), whole, cut)

    def take(self, rows: np.ndarray) -> Vectors:
        cut = [Level(v.length, v.means[rows], v.deviations[rows]) for v in self.levels]
        return Vectors(self.ids[rows], self.labels[rows], self.numbers[rows], cut)


def tile_pairs(a: Vectors, b: Vectors, allowed: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """(i, j, score) of the allowed pairs with low[i] <= score <= high[i]."""
    largest = np.abs(a.numbers).max(initial=0) * np.abs(b.numbers).max(initial=0) * a.numbers.shape[1]
    slack = 1 + ROUNDING * largest
    least, most = (low - slack).astype(np.float32), (high + slack).astype(np.float32)
    i, j = np.nonzero(allowed)
    for x, y in zip(a.levels, b.levels, strict=True):
        if len(i) * DENSE > allowed.size:
            middle, reach = x.pair_bounds(y)
            allowed &= (middle + reach >= least[:, None]) & (middle - reach <= most[:, None])
            i, j = np.nonzero(allowed)
        else:
            middle, reach = x.bounds(y, i, j)
            left = (middle + reach >= least[i]) & (middle - reach <= most[i])
            i, j = i[left], j[left]
    if len(i) * DENSE > allowed.size:
        score = (a.numbers @ b.numbers.T)[i, j]
    else:
        score = pair_products(a.numbers, b.numbers, i, j)
    left = (score >= low[i]) & (score <= high[i])
    return i[left], j[left], score[left].astype(np.int64)


class Best:
    """The best candidates of each anchor within each of its score windows, at most ``keep`` a window."""

    def __init__(self, floors: np.ndarray, caps: np.ndarray, keep: int):
        self.floors, self.caps, self.keep = floors.astype(float), caps.astype(float), keep
        self.anchor, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))
        self._limits()

    def _limits(self) -> None:
        open_ = self.floors <= self.caps
        self.low = np.where(open_, self.floors, np.inf).min(axis=1, initial=np.inf)
        self.high = np.where(open_, self.caps, -np.inf).max(axis=1, initial=-np.inf)

    def add(self, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        anchor = np.concatenate([self.anchor, anchor])
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score, anchor))
        anchor, score, ids = anchor[order], score[order], ids[order]
        if not len(anchor):
            return
        again = np.concatenate([[False], (anchor[1:] == anchor[:-1]) & (score[1:] == score[:-1]) & (ids[1:] == ids[:-1])])
        wanted = np.zeros(len(anchor), bool)
        begin = np.searchsorted(anchor, anchor)  # where the anchor's candidates begin
        for k in range(self.floors.shape[1]):
            fits = ~again & (score >= self.floors[anchor, k]) & (score <= self.caps[anchor, k])
            count = np.cumsum(fits)
            rank = count - (count - fits)[begin]
            wanted |= fits & (rank <= self.keep)
            last = fits & (rank == self.keep)
            self.floors[anchor[last], k] = np.maximum(self.floors[anchor[last], k], score[last])
        self.anchor, self.score, self.id = anchor[wanted], score[wanted], ids[wanted]
        self._limits()


def search(
    rows: DataFrame, block: Vectors, floors: np.ndarray, caps: np.ndarray, keep: int, same: bool, width: int, levels
) -> DataFrame:
    """(anchor_id, id, score): each task's best rows within the anchors' windows, of their label or of all others."""
    largest = np.abs(block.numbers).max(initial=0)

    def pairs(tile: Vectors, found: Best) -> Iterator[tuple[np.ndarray, ...]]:
        searching = found.low <= found.high
        if same:
            kinds = sorted(set(tile.labels))
            groups = [(np.flatnonzero(searching & (block.labels == k)), np.flatnonzero(tile.labels == k)) for k in kinds]
        else:
            groups = [(np.flatnonzero(searching), np.arange(len(tile.ids)))]
        for anchors, members in groups:
            b = tile.take(members)
            for at in range(0, len(anchors), TILE):
                part = anchors[at : at + TILE]
                a = block.take(part)
                allowed = a.ids[:, None] != b.ids[None, :]
                if not same:
                    allowed &= a.labels[:, None] != b.labels[None, :]
                i, j, score = tile_pairs(a, b, allowed, found.low[part], found.high[part])
                yield part[i], score, b.ids[j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Best(floors.copy(), caps, keep)
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                tile = Vectors.of(*(c.to_pylist() for c in batch.slice(at, TILE).columns), width, levels)
                if largest * np.abs(tile.numbers).max() * width >= EXACT:
                    raise ValueError("inner products are too large to be exact")
                new = list(pairs(tile, found))
                if new:
                    found.add(*(np.concatenate(c) for c in zip(*new, strict=True)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.ids[found.anchor]), pa.array(found.id), pa.array(found.score)], names=["anchor_id", "id", "score"]
        )

    # a row that is there again in another task gives the same line
    return rows.mapInArrow(run, "anchor_id long, id long, score long").distinct()


def first_of(found: DataFrame, by: list[str], keep: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def prepared(
    df: DataFrame, id_col: str, vector_col: str, label_col: str, is_anchor: Column, scale: float, width: int, levels
) -> DataFrame:
    """id, label, numbers, summary, anchor of the rows that take part."""
    rows = df.where(col(id_col).isNotNull() & col(label_col).isNotNull() & col(vector_col).isNotNull()).select(
        col(id_col).cast("long").alias("id"),
        col(label_col).cast("string").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        col(vector_col).cast("array<double>").alias("vector"),
    )

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            valid, numbers = whole_numbers(batch.column(3), width, scale)
            kept = batch.filter(pa.array(valid))
            packed = [r.tobytes() for r in numbers.astype("<i4")], [r.tobytes() for r in summaries(numbers, levels)]
            made = [pa.array(p, pa.binary()) for p in packed]
            yield pa.RecordBatch.from_arrays(
                [kept.column(0), kept.column(1), *made, kept.column(2)], names=["id", "label", "numbers", "summary", "anchor"]
            )

    return rows.mapInArrow(prepare, "id long, label string, numbers binary, summary binary, anchor boolean")


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
    levels: tuple[int, ...] = LEVELS,
    block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = df.sparkSession
    width = df.agg(F.max(F.size(col(vector_col))).alias("width")).first()["width"]
    width, levels = fitting(max(width or 0, 1), levels)
    rows = settle(prepared(df, id_col, vector_col, label_col, is_anchor, scale, width, levels), "vectors")
    fields = ["id", "label", "numbers", "summary"]
    least = F.min(F.struct("label", "numbers", "summary")).alias("least")
    anchors = settle(rows.where("anchor").groupBy("id").agg(least).select("id", "least.*"), "anchors")
    rows = rows.select(*fields)
    blocks = -(-anchors.count() // block)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    done = []
    for number in range(blocks):
        part = anchors.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number).select(*fields).collect()
        if part:
            held = Vectors.of(*zip(*part, strict=True), width, levels)
            done.append(settle(_block_result(rows, anchors, held, width, levels, positives, negatives, percent), "negatives"))
    if not done:
        return spark.createDataFrame([], schema)
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def _block_result(rows, anchors, held: Vectors, width, levels, positives, negatives, percent) -> DataFrame:
    n = len(held.ids)
    place = {int(a): k for k, a in enumerate(held.ids)}
    sample = anchors.select("id", "label", "numbers", "summary")

    floors, caps = np.full((n, 1), -np.inf), np.full((n, 1), np.inf)
    seeds = first_of(search(sample, held, floors, caps, positives, True, width, levels), ["anchor_id"], positives)
    for row in seeds.where(F.col("rank") == positives).collect():  # one number an anchor of the block
        floors[place[row["anchor_id"]]] = row["score"]
    near = first_of(search(rows, held, floors, caps, positives, True, width, levels), ["anchor_id"], positives)
    near = settle(near, "positives")

    scores = np.full((n, positives), np.nan)
    for row in near.collect():  # `positives` numbers an anchor of the block
        scores[place[row["anchor_id"]], row["rank"] - 1] = row["score"]
    caps = np.where(np.isnan(scores), -np.inf, scores)
    # a little too low does no harm: the windows are exact below
    floors = np.where(np.isnan(scores), np.inf, percent / 100 * scores - 1 - 1e-12 * np.abs(scores))
    wanted = near.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))

    def ranked(found: DataFrame) -> DataFrame:
        pairs = found.join(wanted, "anchor_id").where(
            (percent * F.col("positive_score") <= 100 * F.col("score")) & (F.col("score") <= F.col("positive_score"))
        )
        return first_of(pairs, ["anchor_id", "positive_id", "positive_score"], negatives)

    seeds = ranked(search(sample, held, floors, caps, negatives, False, width, levels))
    for row in seeds.where(F.col("rank") == negatives).collect():  # one number a positive
        k = place[row["anchor_id"]]
        floors[k, scores[k] == row["positive_score"]] = row["score"]
    return ranked(search(rows, held, floors, caps, negatives, False, width, levels)).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
