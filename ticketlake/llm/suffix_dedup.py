"""Removal of repeated byte strings with difference-cover suffix sorting.

A byte goes if it lies in a string of ``length`` bytes that also starts anywhere
else in the corpus.  Sorting all suffixes of a corpus would move many times its
size, so two lossless steps first leave out whatever is decided without it:

1. Every window of ``length`` bytes has a smallest gram of ``GRAM`` bytes (by hash,
   the last of equal ones), which depends on the window alone.  Neighbouring
   windows with the same gram form a run.  Equal windows have equal grams, so a
   run whose gram occurs in no other run holds no repeat.  Runs are found where
   the texts lie; a bitmap of fixed size drops most of the single ones before
   anything is shuffled, exact counts the rest.
2. A run whose whole string (up to ``2 * length - GRAM`` bytes) occurs again is
   repeated from end to end.
3. Of a gram with any other run, each different string is taken once; strings of
   one gram go to one task and are suffix-sorted by a difference cover: sampled
   triples are sorted and named, the names recursed on, the remaining suffixes
   merged, and adjacent suffixes compared in their first ``length`` bytes.
   A gram with more than ``GROUP`` strings is split by the place of the windows
   before the gram, then by the windows' own hash, so no task gets more.
4. The covered ranges return to the texts.

Matches never cross documents.  Defined results: a null text has no bytes, texts
shorter than ``length`` lose nothing, texts that occur twice lose everything from
``length`` bytes on; null and repeated ids do not matter, as texts are compared
and joined by their content (a 128-bit key).  An empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.llm.common import col, settle, spread_join, text_of
from ticketlake.llm.suffix_array import repeated_prefixes

LENGTH = 400
GRAM = 256
BITS = 26
GROUP = 1500
BLOCK = 1 << 20
SORTED = 3 << 19
A = np.uint64(0x9E3779B97F4A7C15)
B = np.uint64(0xC2B2AE3D27D4EB4F)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes (a power of two) from every place on."""
    h = np.random.default_rng(11).integers(0, 2**64, 256, dtype=np.uint64)[data]
    size = 1
    while size < gram:
        n = max(len(h) - size, 0)
        x = h[:n] * A
        x ^= x >> np.uint64(32)
        x += h[size : size + n] * B
        h, size = x, 2 * size
    h ^= h >> np.uint64(29)
    h *= A
    return h


def runs_of(data: np.ndarray, last_start: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of starts with one smallest gram: first and last start, hash of the gram, hash of the string.

    ``last_start`` says for every place the last start of its own text.
    """
    h = gram_hashes(data, gram)
    width = length - gram + 1  # grams in a window
    low, smallest = h, np.arange(len(h), dtype=np.int32)
    size = 1
    while size < width:  # minima of ever wider windows, the last of equal ones
        shift = min(size, width - size)
        n = max(len(low) - shift, 0)
        right = low[shift : shift + n] <= low[:n]
        smallest = np.where(right, smallest[shift : shift + n], smallest[:n])
        low = np.where(right, low[shift : shift + n], low[:n])
        size += shift
    at = np.arange(len(low))
    starts = np.flatnonzero(at <= last_start[: len(at)])
    if not len(starts):
        return (np.empty(0, np.int64),) * 4
    chosen = smallest[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1) | (last_start[starts[1:]] != last_start[starts[:-1]])
    first = starts[new]
    last = starts[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)]
    window = lambda i: (h[i] * A) ^ (h[i + length - gram] * B)
    whole = (window(first) ^ (window(last) >> np.uint64(17))) * A + window(last) * B + (last - first).astype(np.uint64)
    whole ^= whole >> np.uint64(31)
    return first, last, h[chosen[new]].view(np.int64), (whole * B).view(np.int64)


def blocks(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[int], np.ndarray]]:
    """Parts of texts of about ``BLOCK`` bytes: owners, first places and numbers of starts, and the bytes of all."""
    owner, place, count, held, size = [], [], [], [], 0
    for k, text in enumerate(texts):
        for low in range(0, max(len(text) - length + 1, 0), BLOCK):
            n = min(BLOCK, len(text) - length + 1 - low)
            owner.append(k)
            place.append(low)
            count.append(n)
            held.append(text[low : low + n + length - 1])
            size += len(held[-1])
            if size >= BLOCK:
                yield owner, place, count, np.frombuffer(b"".join(held), np.uint8)
                owner, place, count, held, size = [], [], [], [], 0
    if held:
        yield owner, place, count, np.frombuffer(b"".join(held), np.uint8)


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, the text's key (k1, k2) and its bytes."""
    text = text_of(text_col)
    return df.select(
        col(id_col).alias("id"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"), F.encode(text, "UTF-8").alias("utf8")
    )


RUN = "k1 bigint, k2 bigint, first int, last int, gram bigint, whole bigint"


def runs(texts: DataFrame, length: int, gram: int, passing=None) -> DataFrame:
    """All runs, or those whose gram passes a bitmap."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if passing is None else passing.value
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
            for owner, place, count, data in blocks(batch.column("utf8").to_pylist(), length):
                sizes = np.array(count) + length - 1
                base = np.cumsum(sizes) - sizes
                part = np.repeat(np.arange(len(owner)), sizes)
                first, last, g, whole = runs_of(data, (base + count - 1)[part], length, gram)
                if bits is not None:
                    keep = (bits[(g & ((1 << BITS) - 1)) >> 6] >> (g & 63)) & 1 == 1
                    first, last, g, whole = first[keep], last[keep], g[keep], whole[keep]
                own = part[first]
                shift = np.array(place)[own] - base[own]
                rows = np.array(owner)[own]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(k1[rows]),
                        pa.array(k2[rows]),
                        pa.array((first + shift).astype(np.int32)),
                        pa.array((last + shift).astype(np.int32)),
                        pa.array(g),
                        pa.array(whole),
                    ],
                    names=["k1", "k2", "first", "last", "gram", "whole"],
                )

    return texts.select("k1", "k2", "utf8").mapInArrow(find, RUN)


def bitmap(texts: DataFrame, length: int, gram: int) -> np.ndarray:
    """``2 ** BITS`` bits, set for the grams of more than one run; at most ``2 ** BITS / 64`` numbers come back."""
    word = F.shiftright(F.col("gram").bitwiseAND((1 << BITS) - 1), 6)
    again = runs(texts, length, gram).groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    bit = F.expr("shiftleft(1L, cast(gram & 63 as int))")
    words = again.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out


def strings(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """gram, whole and the bytes of the wanted runs, cut from one text each."""
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("gram", "whole", "first", "last")).alias("own"))
    joined = by_text(texts, lists, "inner")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, own in zip(batch.column("utf8"), batch.column("own"), strict=True):
                data, rows = text.as_py(), own.as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r["gram"] for r in rows], pa.int64()),
                        pa.array([r["whole"] for r in rows], pa.int64()),
                        pa.array([data[r["first"] : r["last"] + length] for r in rows], pa.binary()),
                    ],
                    names=["gram", "whole", "string"],
                )

    made = joined.select("id", "utf8", "own").mapInArrow(cut, "gram bigint, whole bigint, string binary")
    return made.groupBy("gram", "whole").agg(F.first("string").alias("string"))  # a text's copies give the same


def by_text(texts: DataFrame, per_text: DataFrame, how: str) -> DataFrame:
    """Join texts with one row per text key, on plain exchanges that AQE can split where a text has many copies."""
    extra = F.xxhash64("k1", "k2")
    return texts.withColumn("_spread", extra).join(per_text.withColumn("_spread", extra), ["k1", "k2", "_spread"], how)


def sorted_groups(rows: DataFrame, length: int) -> DataFrame:
    """For strings (part, gram, whole, string, from_, upto): the first and last start in that range that is repeated within a part."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def out() -> pa.RecordBatch:
            data = np.frombuffer(b"".join(r[3] for r in held), np.uint8)
            sizes = np.array([len(r[3]) for r in held])
            base = np.cumsum(sizes) - sizes
            starts = np.concatenate([np.arange(b + r[4], b + r[5] + 1) for b, r in zip(base, held, strict=True)])
            found = repeated_prefixes(data, starts, length) if len(starts) > 1 else np.empty(0, np.int64)
            owner = np.searchsorted(base, found, "right") - 1
            some, at = np.unique(owner, return_index=True)
            ends = np.append(at[1:], len(found)) - 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([held[k][1] for k in some], pa.int64()),
                    pa.array([held[k][2] for k in some], pa.int64()),
                    pa.array((found[at] - base[some]).astype(np.int32)) if len(some) else pa.array([], pa.int32()),
                    pa.array((found[ends] - base[some]).astype(np.int32)) if len(some) else pa.array([], pa.int32()),
                ],
                names=["gram", "whole", "low", "high"],
            )

        last = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != last and size >= SORTED // 2:
                    yield out()
                    held, size = [], 0
                last = row[0]
                held.append(row)
                size += len(row[3])
        if held:
            yield out()

    placed = rows.repartition("part").sortWithinPartitions("part")
    return placed.select("part", "gram", "whole", "string", "from_", "upto").mapInArrow(
        sort, "gram bigint, whole bigint, low int, high int"
    )


def contested_ranges(found: DataFrame, length: int) -> DataFrame:
    """gram, whole, low, high: the repeated starts of strings that have their gram in common."""
    sizes = found.groupBy("gram").agg(F.count("*").alias("n"))
    held = spread_join(found, sizes, "gram").withColumn("upto", F.length("string") - length)
    usual = held.where(F.col("n") <= GROUP).select(
        F.col("gram").alias("part"), "gram", "whole", "string", F.lit(0).alias("from_"), "upto"
    )
    # too many strings for one task: every window by itself, and equal hashes meet
    single = (
        held.where(F.col("n") > GROUP)
        .select("gram", "whole", F.col("string"), F.explode(F.sequence(F.lit(0), F.col("upto"))).alias("at"))
        .select("gram", "whole", "at", F.xxhash64(F.expr(f"substring(string, at + 1, {length})")).alias("h1"),
                F.xxhash64(F.lit(1), F.expr(f"substring(string, at + 1, {length})")).alias("h2"))
    )
    again = single.groupBy("gram", "h1", "h2").agg(F.count("*").alias("n"), F.lit(True).alias("again")).where("n > 1")
    many = single.join(again.select("gram", "h1", "h2"), ["gram", "h1", "h2"]).select("gram", "whole", F.col("at").alias("low"), F.col("at").alias("high"))
    both = sorted_groups(usual, length).union(many)
    return both.groupBy("gram", "whole").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def repeated_ranges(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """k1, k2 and the byte ranges to remove of every text that has any."""
    bits = texts.sparkSession.sparkContext.broadcast(bitmap(texts, length, gram))
    some = settle(runs(texts, length, gram, bits), "runs")
    kinds = some.groupBy("gram", "whole").agg(
        F.count("*").alias("n"), F.min(F.struct("k1", "k2", "first", "last")).alias("where")
    )
    kinds = settle(kinds, "strings")
    shape = kinds.groupBy("gram").agg(F.count("*").alias("different"), F.min("n").alias("least"))
    contested = shape.where("different > 1 and least = 1").select("gram")
    wanted = spread_join(kinds, contested, "gram").select("gram", "whole", "where.*")
    found = contested_ranges(settle(strings(texts, wanted, length), "contested"), length)
    single = kinds.where("n = 1").join(found, ["gram", "whole"]).select(
        "where.k1", "where.k2", (F.col("where.first") + F.col("low")).alias("first"), (F.col("where.first") + F.col("high") + length).alias("after")
    )
    several = kinds.where("n > 1").select("gram", "whole", F.xxhash64("gram", "whole").alias("_spread"))
    whole = (
        some.withColumn("_spread", F.xxhash64("gram", "whole"))
        .join(several, ["gram", "whole", "_spread"])
        .select("k1", "k2", "first", (F.col("last") + length).alias("after"))
        .distinct()
    )
    return whole.union(single).groupBy("k1", "k2").agg(F.collect_list(F.struct("first", "after")).alias("ranges"))


def suffix_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, spans (first, after), kept (the remaining bytes)."""
    texts = keyed(df, id_col, text_col)
    ranges = settle(repeated_ranges(texts, length, gram), "ranges")
    joined = by_text(texts, ranges, "left").select("id", "utf8", "ranges")
    spans = pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))
    schema = T.StructType(
        [
            T.StructField(id_col, df.schema[id_col].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            *T.StructType.fromDDL("spans array<struct<first:int,after:int>>, kept binary").fields,
        ]
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, cuts, left = [], [], [], []
            for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                merged: list[dict] = []
                for r in sorted(ranges or (), key=lambda r: r["first"]):
                    if merged and r["first"] <= merged[-1]["after"]:
                        merged[-1]["after"] = max(merged[-1]["after"], r["after"])
                    else:
                        merged.append(r)
                ends = [0, *(r["after"] for r in merged)]
                begins = [*(r["first"] for r in merged), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(ends, begins, strict=True))
                sizes.append(len(text))
                gone.append(len(text) - len(kept))
                cuts.append(merged)
                left.append(kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(cuts, spans), pa.array(left, pa.binary())],
                names=schema.names,
            )

    return joined.mapInArrow(remove, schema)
