"""Near-duplicate groups: MinHash with banding, signature and set verification, large-star and small-star components.

A document is its set of distinct ``width``-word shingles (a shorter one has
its whole word sequence as the only shingle).  Documents are linked when
``100 * |A & B| >= percent * |A | B|``; groups are the connected components.

1. Every task sketches its documents: ``bands * rows`` minima of universal
   hashes, and a 128-bit key of the set.  Documents with equal sets are one
   node from here on, so a group of copies costs one row per set.
2. Nodes that agree in a whole band share a bucket.  Each is compared with the
   bucket's smallest and largest node only, never with all others: first by
   signature, then by the full sets.
3. The links give components.  A bucket whose members then still lie in
   several components may hide links between them, so there the members
   outside the bucket's most frequent component are compared with the members
   of other components, in blocks of limited rows and shingles: by finer
   signatures (the last four bits of ``FINE`` minima, made for these members
   only), then by their sets as 32-bit hashes.  As soon as two members are
   similar their components are one in this block: it gives at most one link
   for each component it has, never all pairs.  Should a link not hold on the
   full sets, two hashes were equal by chance, and the comparison is made again
   with others.  No bucket is capped.

With 32 bands of 4 rows a pair at exactly 0.75 is missed with a probability of
about 5 in a million, a closer one far less often; ``LEAST_EQUAL`` of the 128
minima (five standard deviations under the expectation at 0.75) adds one in a
million, and so do the finer signatures.  Whatever is linked is confirmed on the
full sets.

Defined results: null or wordless texts have an empty set and are linked with
nothing.  ``component_id`` is the smallest id of the group; null ids do not
count, and a group of null ids only has the component null.  ``kept`` is
``doc_id = component_id`` (for null ids: that the component is null), so rows
that repeat the smallest id are all kept; ``group_key`` tells the groups apart
whatever their ids (null without words).  An empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.llm.common import col, settle, spread_join, text_of
from ticketlake.llm.components import components

WIDTH = 5
PERCENT = 75
BANDS = 32
ROWS = 4
LEAST_EQUAL = 72
FINE = 1024
BLOCK = 1000
BLOCK_SHINGLES = 4_000_000
KNOWN_WORDS = 300_000
SEED = 20260


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: bytes, width: int, known: WordHashes) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word shingles."""
    words = text.lower().split()  # bytes: lowers A-Z only and splits at ASCII white space only
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    if len(known) > KNOWN_WORDS:
        known.clear()
    h = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    size = min(n, width)
    mixed = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ h[k : n - size + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima of ``len(a)`` multiply-add-shift hashes."""
    out = np.full(len(a), 0xFFFFFFFF, np.uint64)
    for at in range(0, len(shingles), 1024):  # a block stays in the processor's cache
        part = shingles[None, at : at + 1024] * a[:, None]
        part += b[:, None]
        np.minimum(out, part.min(axis=1) >> np.uint64(32), out=out)
    return out.astype("<u4")


def coefficients(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    a = rng.integers(1, 2**63, hashes, np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 2**63, hashes, np.uint64) * np.uint64(2)


def sketches(df: DataFrame, id_col: str, text_col: str, width: int, hashes: int) -> DataFrame:
    """id, text_key, set_key, n_shingles, signature of every row; key and signature are null for an empty set."""
    a, b = coefficients(hashes)
    rows = df.select(
        col(id_col).alias("id"),
        F.xxhash64(text_of(text_col)).alias("text_key"),
        F.encode(text_of(text_col), "UTF-8").alias("utf8"),
    )
    schema = T.StructType(
        [
            rows.schema[0],
            T.StructField("text_key", T.LongType()),
            T.StructField("set_key", T.BinaryType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("signature", T.BinaryType()),
        ]
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            keys, sizes, signed = [], [], []
            for text in batch.column(2):
                s = shingle_set(text.as_py(), width, known)
                sizes.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                signed.append(signature(s, a, b).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(keys, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(signed, pa.binary()),
                ],
                names=["id", "text_key", "set_key", "n_shingles", "signature"],
            )

    return rows.mapInArrow(sketch, schema)


def full_sets(df: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """set_key and shingles of the wanted nodes, made from the text of one document of each."""
    rows = df.select(
        col(id_col).alias("id"),
        F.xxhash64(text_of(text_col)).alias("text_key"),
        F.encode(text_of(text_col), "UTF-8").alias("utf8"),
    )
    picked = rows.join(
        wanted.select(F.col("rep.id").alias("rep_id"), F.col("rep.text_key").alias("rep_key"), "set_key"),
        rows["id"].eqNullSafe(F.col("rep_id")) & (F.col("text_key") == F.col("rep_key")),
    ).select("set_key", "utf8")

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            keys, sets = [], []
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                s = shingle_set(text.as_py(), width, known)
                if xxhash.xxh3_128_digest(s.tobytes()) == key.as_py():
                    keys.append(key.as_py())
                    sets.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["set_key", "shingles"]
            )

    # rows that repeat an id and its text give a set more than once
    made = picked.mapInArrow(shingles, "set_key binary, shingles array<bigint>")
    return made.dropDuplicates(["set_key"])


def alike(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many minima two signatures have in common, row by row."""
    return (left == right).sum(axis=1)


def signed_pairs(pairs: DataFrame, nodes: DataFrame, hashes: int, least: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree in at least ``least`` places."""
    sa = nodes.select(F.col("set_key").alias("a"), F.col("signature").alias("sa"))
    sb = nodes.select(F.col("set_key").alias("b"), F.col("signature").alias("sb"))

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, hashes) for c in ("sa", "sb")
                )
                yield batch.select(["a", "b"]).filter(pa.array(alike(left, right) >= least))

    return pairs.join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb").mapInArrow(agree, "a binary, b binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough, as edges (u, v)."""
    left = sets.select(F.col("set_key").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("set_key").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", common.alias("i"), (F.size("x") + F.size("y")).alias("n"))
    return joined.where(F.col("i") * 100 >= percent * (F.col("n") - F.col("i"))).select(
        F.col("b").alias("u"), F.col("a").alias("v")
    )


def short_sets(sets: DataFrame, salt: int) -> DataFrame:
    """set_key, n (shingles) and the distinct 32-bit hashes of the shingles, as bytes."""
    multiplier = coefficients(1 + salt)[0][salt]

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, sizes = [], []
            for row in batch.column(1):
                s = row.values.to_numpy().view(np.uint64)
                sizes.append(len(s))
                made.append(np.unique((s * multiplier >> np.uint64(32)).astype("<u4")).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(made, pa.binary())], names=["set_key", "n", "short"]
            )

    return sets.select("set_key", "shingles").mapInArrow(shorten, "set_key binary, n long, short binary")


class Parts:
    """Components that are joined as links are found."""

    def __init__(self, names: list[bytes]):
        self.of = np.unique(np.array(names, object), return_inverse=True)[1]

    def join(self, i: int, j: int) -> None:
        a, b = self.of[i], self.of[j]
        self.of[self.of == max(a, b)] = min(a, b)


def fine_signatures(sets: DataFrame) -> DataFrame:
    """set_key and four bits of each of ``FINE`` minima, two to a byte."""
    a, b = coefficients(FINE)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for row in batch.column(1):
                s = row.values.to_numpy().view(np.uint64)
                bits = np.concatenate([signature(s, a[k : k + 128], b[k : k + 128]) for k in range(0, FINE, 128)]) & 15
                made.append((bits[::2] | bits[1::2] << 4).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["set_key", "fine"])

    return sets.select("set_key", "shingles").mapInArrow(sign, "set_key binary, fine binary")


def least_alike(percent: int) -> int:
    """Five standard deviations under the number of equal four-bit minima expected at the threshold."""
    p = percent / 100 + (1 - percent / 100) / 16
    return int(FINE * p - 5 * (FINE * p * (1 - p)) ** 0.5)


def block_links(group: pa.Table, percent: int, bands: int) -> list[tuple[bytes, bytes]]:
    """Links between members of different components, enough to join all that are similar.

    A pair with several buckets in common is looked at in the first of them.
    """
    asks = group.column("asks").to_numpy()
    keys, sizes = group.column("set_key").to_pylist(), group.column("n").to_numpy()
    parts = Parts(group.column("component").to_pylist())
    signs = np.frombuffer(b"".join(group.column("fine").to_pylist()), np.uint8).reshape(len(keys), -1)
    coarse = np.frombuffer(b"".join(group.column("signature").to_pylist()), "<u4").reshape(len(keys), bands, -1)
    sets = [np.frombuffer(s.as_py(), "<u4") for s in group.column("short")]
    band, least, base = group.column("band")[0].as_py(), least_alike(percent), np.flatnonzero(~asks)
    links = []
    for k in np.flatnonzero(asks):
        others = base[parts.of[base] != parts.of[k]]
        differ = signs[others] ^ signs[k]
        equal = ((differ & 15) == 0).sum(axis=1) + (differ < 16).sum(axis=1)
        near = others[equal >= least]
        near = near[(coarse[near] == coarse[k]).all(axis=2).argmax(axis=1) == band]
        for other in near:
            if parts.of[other] == parts.of[k]:
                continue
            common = len(np.intersect1d(sets[k], sets[other], assume_unique=True))
            if 100 * common >= percent * (sizes[k] + sizes[other] - common):
                links.append((min(keys[k], keys[other]), max(keys[k], keys[other])))
                parts.join(k, other)
    return links


def hidden_pairs(
    members: DataFrame, nodes: DataFrame, sets: DataFrame, found: DataFrame, percent: int, bands: int, salt: int
) -> DataFrame:
    """Pairs (a, b) of one bucket that join components, at most one for each component in a block."""
    labelled = members.join(found, members["set_key"] == found["node"], "left").select(
        "bucket", "band", "set_key", F.coalesce("component", "set_key").alias("component")
    )
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    rows = settle(spread_join(labelled, mixed.select("bucket"), "bucket"), "mixed")
    wanted = settle(sets.join(rows.select("set_key").distinct(), "set_key", "left_semi"), "mixed-sets")
    short = short_sets(wanted, salt).join(fine_signatures(wanted), "set_key").join(nodes.select("set_key", "signature"), "set_key")
    short = settle(short, "short")
    sized = rows.join(short.select("set_key", "n"), "set_key")
    per = sized.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("n").alias("shingles"))
    top = F.max(F.struct("n", "component", "shingles"))
    blocks = lambda n, shingles: F.ceil(F.greatest(n / BLOCK, shingles / BLOCK_SHINGLES, F.lit(1))).cast("int")
    all_n, all_shingles = F.sum("n"), F.sum("shingles")
    shape = per.groupBy("bucket").agg(
        top["component"].alias("main"),
        blocks(all_n, all_shingles).alias("across"),
        blocks(all_n - top["n"], all_shingles - top["shingles"]).alias("down"),
    )
    held = spread_join(rows, shape, "bucket").join(short, "set_key")
    place = lambda n: F.pmod(F.xxhash64("set_key"), F.col(n)).cast("int")
    base = held.withColumn("i", place("across")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("down") - 1)))
    asked = (
        held.where("component <> main")
        .withColumn("j", place("down"))
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("across") - 1)))
    )
    fields = ["bucket", "i", "j", "band", "set_key", "component", "n", "short", "fine", "signature"]
    both = base.select(*fields, F.lit(False).alias("asks")).union(asked.select(*fields, F.lit(True).alias("asks")))

    def compare(group: pa.Table) -> pa.Table:
        links = block_links(group, percent, bands)
        return pa.table({"a": pa.array([p[0] for p in links], pa.binary()), "b": pa.array([p[1] for p in links], pa.binary())})

    return both.groupBy("bucket", "i", "j").applyInArrow(compare, "a binary, b binary").distinct()


def near_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    least_equal: int = LEAST_EQUAL,
) -> DataFrame:
    """One row per input row: id, text_key, n_shingles, component_id, kept, group_key."""
    hashes = bands * rows
    docs = settle(sketches(df, id_col, text_col, width, hashes), "sketches")
    nodes = settle(
        docs.where("set_key is not null")
        .groupBy("set_key")
        .agg(
            F.min("id").alias("min_id"),
            F.min(F.struct("id", "text_key")).alias("rep"),
            F.first("signature").alias("signature"),
        ),
        "nodes",
    )
    bucket = F.posexplode(
        F.array(*[F.xxhash64(F.lit(k), F.substring("signature", 4 * rows * k + 1, 4 * rows)) for k in range(bands)])
    )
    buckets = nodes.select("set_key", bucket.alias("band", "bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high")).where("low <> high")
    members = settle(spread_join(buckets, shared, "bucket"), "members")
    first = (
        members.select(F.col("low").alias("a"), F.col("set_key").alias("b"))
        .union(members.select(F.col("set_key").alias("a"), F.col("high").alias("b")))
        .where("a <> b")
        .distinct()
    )
    in_use = members.select("set_key").distinct()
    sets = settle(full_sets(df, nodes.join(in_use, "set_key"), id_col, text_col, width), "sets")
    links = settle(confirmed(signed_pairs(first, nodes, hashes, least_equal), sets, percent), "links")
    found = components(links)
    salt = 0
    while True:
        pairs = settle(hidden_pairs(members, nodes, sets, found, percent, bands, salt), "hidden")
        more = settle(confirmed(pairs, sets, percent), "links")
        n_pairs, n_links = pairs.count(), more.count()
        if n_links:
            stars = found.where("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))
            found = components(stars.union(more))
        if n_links == n_pairs:
            break
        salt += 1  # hashes that are equal by chance joined what is not similar
    labels = nodes.select("set_key", "min_id").join(found, F.col("set_key") == F.col("node"), "left")
    labels = labels.select("set_key", "min_id", F.coalesce("component", "set_key").alias("component"))
    least = labels.groupBy("component").agg(F.min("min_id").alias("component_id"))
    named = spread_join(labels, least, "component").select("set_key", "component_id", F.col("component").alias("group_key"))
    out = spread_join(docs, named, "set_key", "left").withColumn(
        "component_id", F.when(F.col("set_key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    )
    return out.select(
        F.col("id").alias(id_col),
        "text_key",
        "n_shingles",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        "group_key",
    )


def representatives(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **method) -> DataFrame:
    """One row of each group, with all columns of ``df``: its smallest id (null last), of those the least text hash.

    Rows without words are all kept.
    """
    groups = settle(near_dedup(df, id_col, text_col, **method).where("group_key IS NOT NULL"), "groups")
    least = F.min(F.struct(col(id_col).isNull().alias("none"), col(id_col).alias("own_id"), F.col("text_key").alias("own_key")))
    chosen = groups.groupBy("group_key").agg(least.alias("one")).select("group_key", "one.own_id", "one.own_key")
    rows = df.select(F.struct("*").alias("row"), col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("key"))
    wordless = ~text_of(text_col).rlike(r"[^\x20\x09-\x0D]")
    same = rows["id"].eqNullSafe(F.col("own_id")) & (F.col("key") == F.col("own_key"))
    kept = rows.join(chosen, same)
    copies = groups.join(chosen, "group_key").where(col(id_col).eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key")))
    if not copies.groupBy("group_key").count().where("count > 1").isEmpty():  # rows that repeat an id and its text
        kept = kept.groupBy("group_key").agg(F.first("row").alias("row"))
    return kept.select("row.*").union(df.where(wordless))
