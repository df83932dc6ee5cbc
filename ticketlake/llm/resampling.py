"""Importance resampling of documents towards a target distribution of word n-grams.

Words are runs of digits, lower-case letters and characters beyond ASCII, after
lower-casing A-Z.  A document's features are its runs of ``orders[0]`` to
``orders[1]`` consecutive words, hashed into buckets; a bucket's gain is the log
ratio of its smoothed share in the target and in the documents.  A document's
weight is the mean gain of its features, and with Gumbel noise made from its id
the highest scores are a draw without replacement.

1. Texts are read once.  A task joins the texts of a batch with a separator
   that no word holds; one regular expression pass finds the words of all of
   them, a binary search in the text offsets tells whose a word is, and n-grams
   that reach over a separator are masked out.  What is kept is the bucket of
   each feature, two bytes a word, in the shared folder.
2. Buckets are counted from there: one ``bincount`` per task, summed by bucket.
   The driver sees one number per bucket, whatever the input's size.
3. Weights and scores come from the stored buckets.
4. The lowest score that is drawn follows from a histogram of the scores, whole
   numbers within some tens of thousands.  Only rows from there on are sorted,
   by range, and numbered with their partitions' offsets, so that no task sees
   all of them.

Defined results: a null text has no words; no features give weight 0.  A null
id is hashed as the empty text.  Ties go to the smaller id, null ids last; rows
that are equal there too are numbered in any order.  Repeated rows are rows of
their own.  ``rank`` is null for rows that are not drawn, those with fewer than
``min_words`` words among them.  A text longer than ``PIECE`` bytes is searched
in pieces cut between words, with the words that n-grams need from the piece
before.  An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ticketlake.llm.common import col, settle, text_of

#: fixed values of the features: what a word is, in UTF-8
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
BETWEEN = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
SEPARATOR = b"\x00"

PIECE = 4 << 20
KNOWN_WORDS = 300_000
IS_WORD = np.zeros(256, bool)
IS_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


class Crcs(dict):
    """crc32 of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = zlib.crc32(word)
        return h


def pieces(text: bytes, reach: int) -> Iterator[tuple[bytes, int]]:
    """A text in parts of some ``PIECE`` bytes, each with the number of words it repeats from the one before."""
    at, carried, repeated = 0, b"", 0
    while True:
        cut = BETWEEN.search(text, at + PIECE) if len(text) - at > PIECE else None
        part = carried + text[at : cut.start() if cut else len(text)]
        yield part, repeated
        if not cut:
            return
        last = WORD.findall(part.lower())[-reach:] if reach else []
        carried, repeated, at = b"".join(w + b" " for w in last), len(last), cut.start()


def joined_features(parts: list[tuple[int, bytes, int]], orders: tuple[int, int], known: Crcs) -> tuple[np.ndarray, ...]:
    """(owner of each feature, its crc32, owner of each own word) of parts (owner, bytes, words repeated)."""
    text = SEPARATOR.join(p for _, p, _ in parts).lower()  # bytes: A-Z only
    words = WORD.findall(text)
    inside = IS_WORD[np.frombuffer(text, np.uint8)]
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    offsets = np.cumsum([0] + [len(p) + 1 for _, p, _ in parts])
    part = np.searchsorted(offsets, starts, "right") - 1
    owners = np.array([o for o, _, _ in parts])
    first = np.searchsorted(part, np.arange(len(parts)))  # first word of each part
    repeated = np.array([r for _, _, r in parts])
    place = np.arange(len(words)) - first[part]
    own = place >= repeated[part]
    whose, hashes = [], []
    crcs = np.fromiter(map(known.__getitem__, words), np.uint32, len(words))
    for order in range(1, orders[1] + 1):
        begin = np.arange(len(words) - order + 1)
        if order > 1:
            begin = begin[part[begin] == part[begin + order - 1]]
            longer = [zlib.crc32(b" " + words[k + order - 1], int(crcs[k])) for k in begin]
            crcs = crcs.copy()
            crcs[begin] = longer
        if order >= orders[0]:
            mine = begin[place[begin] + order - 1 >= repeated[part[begin]]]
            whose.append(owners[part[mine]])
            hashes.append(crcs[mine])
    return np.concatenate(whose), np.concatenate(hashes), owners[part[own]]


def batch_features(texts: Iterable[bytes], orders: tuple[int, int], buckets: int, known: Crcs) -> tuple[list[np.ndarray], np.ndarray]:
    """Buckets of each text's features, and its number of words."""
    found: list[list[np.ndarray]] = []
    n_words: list[int] = []
    waiting: list[tuple[int, bytes, int]] = []
    size = 0

    def flush() -> None:
        if len(known) > KNOWN_WORDS:
            known.clear()
        whose, crcs, words = joined_features(waiting, orders, known)
        order = np.argsort(whose, kind="stable")
        whose, hashed = whose[order], (crcs[order] % np.uint32(buckets)).astype(np.uint32)
        low = waiting[0][0]
        here = np.arange(low, waiting[-1][0] + 1)
        ends = np.searchsorted(whose, here, "right")
        for k, a, b in zip(here, np.concatenate([[0], ends[:-1]]), ends, strict=True):
            if b > a:
                found[k].append(hashed[a:b])
        for k, n in enumerate(np.bincount(words - low, minlength=len(here))):
            n_words[low + k] += int(n)

    for k, text in enumerate(texts):
        found.append([])
        n_words.append(0)
        for part, repeated in pieces(text, orders[1] - 1):
            waiting.append((k, part, repeated))
            size += len(part) + 1
            if size >= PIECE:
                flush()
                waiting, size = [], 0
    if waiting:
        flush()
    none = np.empty(0, np.uint32)
    return [np.concatenate(f) if f else none for f in found], np.array(n_words, np.int64)


def hashed_features(df: DataFrame, id_col: str, text_col: str, orders: tuple[int, int], buckets: int) -> DataFrame:
    """id, text_key, n_words, features (little-endian bucket numbers) of every row."""
    rows = df.select(
        col(id_col).alias("id"),
        F.xxhash64(text_of(text_col)).alias("text_key"),
        F.encode(text_of(text_col), "UTF-8").alias("utf8"),
    )
    schema = T.StructType(
        [*rows.schema[:2], T.StructField("n_words", T.LongType()), T.StructField("features", T.BinaryType())]
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Crcs()
        for batch in batches:
            found, n_words = batch_features((t.as_py() for t in batch.column(2)), orders, buckets, known)
            packed = [f.astype(number_type(buckets)).tobytes() for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_words), pa.array(packed, pa.binary())], names=schema.names
            )

    return rows.mapInArrow(hashed, schema)


def number_type(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs; one row per bucket and task is shuffled, one per bucket reaches the driver."""
    kind = number_type(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in batch.column(0):
                total += np.bincount(np.frombuffer(part.as_py(), kind), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    rows = features.select("features").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in rows.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares, rounded down."""
    buckets, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets))))
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def noise(seed: int, key: str | None) -> int:
    """Thousandths of a Gumbel variable made from an id, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{key or ''}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(features: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """id, text_key, n_words, n_features, weight, score."""
    kind = number_type(len(gain))
    rows = features.select("id", "text_key", "n_words", "features", F.col("id").cast("string").alias("key"))
    schema = T.StructType(
        [*rows.schema[:3], *(T.StructField(c, T.LongType()) for c in ("n_features", "weight", "score"))]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, weights, scores = [], [], []
            for part, key in zip(batch.column(3), batch.column(4), strict=True):
                found = np.frombuffer(part.as_py(), kind)
                sizes.append(len(found))
                weights.append(int(gain[found].sum()) // len(found) if len(found) else 0)
                scores.append(weights[-1] + noise(seed, key.as_py()))
            added = [pa.array(v, pa.int64()) for v in (sizes, weights, scores)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *added], names=schema.names)

    return rows.mapInArrow(score, schema)


def ranked(rows: DataFrame, share: tuple[int, int], min_words: int) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, 3 ... for the highest floor(a * N / b) scores of the N rows with enough words."""
    able = rows.where(F.col("n_words") >= min_words)
    sizes = able.groupBy("score").agg(F.count("*").alias("n"))  # whole numbers: a few ten thousand at most
    total = F.sum("n").over(Window.partitionBy()) * share[0]
    above = F.sum("n").over(Window.orderBy(F.desc("score"))) - F.col("n")
    reached = sizes.select("score", above.alias("above"), F.floor(total / share[1]).alias("draw"), (total % share[1]).alias("_"))
    row = reached.where("above < draw").agg(F.min("score").alias("least"), F.max("draw").alias("draw")).first()
    nobody = F.lit(None).cast("long")
    if row["least"] is None:
        return rows.withColumn("rank", nobody)
    in_reach = (F.col("n_words") >= min_words) & (F.col("score") >= row["least"])
    order = [F.desc("score"), F.asc_nulls_last("id")]
    tie = F.monotonically_increasing_id()  # rows come from files: the same on every attempt
    line = rows.where(in_reach).withColumn("tie", tie).repartitionByRange(*order, "tie").sortWithinPartitions(*order, "tie")
    line = settle(line.withColumn("place", F.monotonically_increasing_id()), "line")
    part, place = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    per_part = line.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # one row per partition
    before = per_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    placed = line.withColumn("part", part).join(F.broadcast(before), "part")
    rank = F.col("before") + place + 1
    drawn = placed.withColumn("rank", F.when(rank <= row["draw"], rank)).select(*rows.columns, "rank")
    return rows.where(~in_reach).withColumn("rank", nobody).union(drawn)


def importance_resampling(
    df: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
    orders: tuple[int, int] = (1, 1),
    buckets: int = 10_000,
    share: tuple[int, int] = (10, 100),
    min_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """One row per input row: id, text_key, n_words, n_features, weight, score, rank."""
    features = settle(hashed_features(df, id_col, text_col, orders, buckets), "features")
    wanted = target.select(F.lit(0).alias("id"), col(target_text).alias("text"))
    aim = hashed_features(wanted, "id", "text", orders, buckets)
    gain = gains(bucket_counts(features, buckets), bucket_counts(aim, buckets))
    out = ranked(settle(scored(features, gain, seed), "scored"), share, min_words)
    return out.withColumnRenamed("id", id_col)


def drawn(df: DataFrame, scores: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The drawn rows, whole.  Rows equal in id and text go together: all are there if one was drawn."""
    chosen = scores.where("rank is not null").select(col(id_col).alias("_id"), F.col("text_key").alias("_key"))
    same = col(id_col).eqNullSafe(F.col("_id")) & (F.xxhash64(text_of(text_col)) == F.col("_key"))
    return df.join(chosen, same, "left_semi")
