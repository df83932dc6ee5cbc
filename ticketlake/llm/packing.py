"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Method: pieces above a third of the capacity (at most two fit together) are
matched greedily, the longest with the longest that still fits; smaller pieces
then go to the tightest remaining gap, longest first.

The plan depends on the piece lengths only, and there are at most ``capacity``
different ones.  So the corpus is tokenised where it lies, the number of
pieces of each length (at most ``capacity`` rows) comes to the driver, and
the plan is made there for *all* pieces at once as runs: "the pieces of this
length with these ranks go to these sequences at this offset".  The ranks are
assigned on the cluster; a length that a third of all pieces have is ranked in
``buckets`` separate groups.  Nothing else leaves the executors.

Tokens: the tokenizer splits a text into words whose ids do not depend on their
neighbours, so each worker process keeps the ids of the words it has met: those
of late and, when that cache is full (``CACHED_WORDS``), those before.

Defined results: a null or empty text has only the closing id; repeated rows
are packed each for itself, ties of length in order of id and piece; a null id
is packed like any other; an empty table gives no sequences.  Other columns
are not looked at.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.llm.common import col, settle, text_of

CAPACITY = 4096
END_ID = 1
CACHED_WORDS = 500_000
JOINED = 256
# The tokenizer's word pattern for lower-case text of the characters that UNCOMMON leaves.
LETTERS = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff\u0153"
NUMBERS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^ \t-\r{LETTERS}{NUMBERS}]+")
UNCOMMON = re.compile("[^\t-\r -~\u00a1-\u00ff\u0152\u0153]")


class WordIds:
    """The ids of a text as little-endian unsigned 32-bit numbers, word by word.

    Texts of common Latin characters are split as the tokenizer's own pattern
    splits them after lower-casing, and only words not met before are given to
    the tokenizer, many in one text; any other text is given to it whole.
    """

    def __init__(self, tokenizer_path: str, caches: tuple[dict, dict] | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.known, self.older = caches or ({}, {})  # words met lately, and before that
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # ids that end a word
        if suffix:
            self.closes[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _ids(self, texts: list[str]) -> Iterator[bytes]:
        for low in range(0, len(texts), 4096):
            for e in self.tokenizer.encode_batch_fast(texts[low : low + 4096], add_special_tokens=False):
                yield array("I", e.ids).tobytes()

    def _word_ids(self, words: list[str]) -> Iterator[bytes]:
        """The ids of each word: of all in one text, cut after the ids that end a word, or one by one if these are not as many."""
        for low in range(0, len(words), JOINED):
            some = words[low : low + JOINED]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(some) or ends[-1] != len(ids):
                yield from self._ids(some)
                continue
            data, at = ids.tobytes(), 0
            for end in (4 * ends).tolist():
                yield data[at:end]
                at = end

    def _learn(self, new: set[str]) -> None:
        """Take up words that are not among those met lately."""
        if len(self.known) > CACHED_WORDS:
            self.older.clear()
            self.older.update(self.known)
            self.known.clear()
        if self.older:
            again = new.intersection(self.older)
            self.known.update((w, self.older[w]) for w in again)
            new = new - again
        missing = list(new)
        self.known.update(zip(missing, self._word_ids(missing), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [None if UNCOMMON.search(t) or "<|" in t else WORDS.findall(t.lower()) for t in texts]
        every = [w for words in split if words for w in words]
        found = list(map(self.known.get, every))
        gaps = [k for k, own in enumerate(found) if own is None]
        if gaps:
            self._learn({every[k] for k in gaps})
            for k in gaps:
                found[k] = self.known[every[k]]
        whole = self._ids([t for t, words in zip(texts, split, strict=True) if words is None])
        out, at = [], 0
        for words in split:
            if words is None:
                out.append(next(whole))
            else:
                out.append(b"".join(found[at : at + len(words)]))
                at += len(words)
        return out


def tokenized_pieces(
    df: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 and, if wanted, the ids themselves."""
    rows = df.select(col(id_col).alias(id_col), text_of(text_col).alias("text"))
    fields = [
        rows.schema[0],
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    names = [f.name for f in fields]
    caches = df.sparkSession.sparkContext.broadcast(({}, {}))  # each worker process fills its own copy, task after task
    closing = array("I", [end_id]).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(tokenizer_path, caches.value)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for k, data in enumerate(words.encode(part.column(1).to_pylist())):
                    data += closing
                    for p, at in enumerate(range(0, len(data), 4 * capacity)):
                        own = data[at : at + 4 * capacity]
                        row.append(k)
                        piece.append(p)
                        start.append(at // 4)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                        if with_ids:
                            ids.append(np.frombuffer(own, "<u4").astype(np.int32))
                columns = [
                    part.column(0).take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(cut, T.StructType(fields))


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Runs (length, first rank, pieces, first sequence, pieces a sequence, offset) for so many pieces of each length.

    Sequences of the same filling are kept as ranges, so the work depends on
    the number of different lengths, not on the number of pieces.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    ranked: dict[int, int] = defaultdict(int)
    runs: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
    sizes: list[int] = []  # gaps in use, ascending
    sequences = 0

    def place(n: int, pieces: int, first: int, each: int, offset: int) -> None:
        runs.append((n, ranked[n], pieces, first, each, offset))
        ranked[n] += pieces

    def leave(gap: int, first: int, how_many: int) -> None:
        if gap > 0 and how_many > 0:
            if not gaps[gap]:
                insort(sizes, gap)
            gaps[gap].append((first, how_many))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        n = large[-1]
        k = bisect_left(large, capacity - n + 1) - 1  # the longest partner that fits
        if k < 0:
            m, partner = left[n], 0
        else:
            partner = large[k]
            m = left[n] // 2 if partner == n else min(left[n], left[partner])
            if m == 0:  # one piece left of a length that pairs with itself
                if k > 0:
                    partner, m = large[k - 1], 1
                else:
                    partner, m = 0, left[n]
        place(n, m, sequences, 1, 0)
        left[n] -= m
        if partner:
            place(partner, m, sequences, 1, n)
            left[partner] -= m
        leave(capacity - n - partner, sequences, m)
        sequences += m
        for used in {n, partner} - {0}:
            if left[used] == 0:
                large.remove(used)

    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        c = left[n]
        while c:
            at = bisect_left(sizes, n)
            if at == len(sizes):
                each = capacity // n
                full, rest = divmod(c, each)
                if full:
                    place(n, full * each, sequences, each, 0)
                    leave(capacity - each * n, sequences, full)
                if rest:
                    place(n, rest, sequences + full, rest, 0)
                    leave(capacity - rest * n, sequences + full, 1)
                sequences += full + bool(rest)
                break
            gap = sizes[at]
            first, many = gaps[gap].pop()
            if not gaps[gap]:
                sizes.pop(at)
            each = gap // n
            full, rest = (many, 0) if c >= many * each else divmod(c, each)
            if full:
                place(n, full * each, first, each, capacity - gap)
                leave(gap - each * n, first, full)
            if rest:
                place(n, rest, first + full, rest, capacity - gap)
                leave(gap - rest * n, first + full, 1)
            leave(gap, first + full + bool(rest), many - full - bool(rest))
            c -= full * each + rest
    return np.array(runs, np.int64).reshape(-1, 6)


def pack(pieces: DataFrame, capacity: int = CAPACITY, buckets: int = 64) -> DataFrame:
    """Give every piece (a row with ``length``) its ``sequence_id`` and ``offset``."""
    bucket = F.pmod(F.xxhash64(*[c for c in pieces.columns if c != "ids"]), F.lit(buckets))
    order = [c for c in pieces.columns if c != "ids"]
    held = pieces.withColumn("bucket", bucket)
    groups = held.groupBy("length", "bucket").agg(F.count("*").alias("pieces"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = groups.withColumn("first", F.coalesce(F.sum("pieces").over(before), F.lit(0)))
    counts = {r["length"]: r["n"] for r in groups.groupBy("length").agg(F.sum("pieces").alias("n")).collect()}
    runs = packing_plan(counts, capacity)  # at most `capacity` lengths: bounded whatever the corpus
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    starts = (runs[:, 0] << 44) + runs[:, 1]
    within = Window.partitionBy("length", "bucket").orderBy(*order)
    ranked = (
        held.withColumn("rank", F.row_number().over(within) - 1)
        .join(firsts.select("length", "bucket", "first"), ["length", "bucket"])
        .withColumn("rank", (F.col("rank") + F.col("first")).cast("long"))
        .select(*pieces.columns, "rank")
    )
    own_columns, out = pieces.columns, [*pieces.columns, "sequence_id", "offset"]
    schema = T.StructType(
        [*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            own = runs[np.searchsorted(starts, (length << 44) + rank, "right") - 1]
            nth = rank - own[:, 1]
            sequence, offset = own[:, 3] + nth // own[:, 4], own[:, 5] + nth % own[:, 4] * length
            kept = [batch.column(c) for c in own_columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=out)

    return ranked.mapInArrow(placed, schema)


def best_fit_packing(
    df: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Tokenise, cut and pack ``df``: one row per piece with its sequence and offset."""
    pieces = tokenized_pieces(df, tokenizer_path, id_col, text_col, capacity, end_id, with_ids)
    return pack(settle(pieces, "pieces"), capacity)
