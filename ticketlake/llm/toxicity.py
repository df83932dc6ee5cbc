"""Toxicity by class-conditional Kneser-Ney models.

Two word models, one of toxic and one of ordinary labelled texts, give every
word a log-likelihood ratio.  The words of a toxic text are mostly ordinary, so its
model is the ordinary one but for a part ``SPECIFIC``, and a word can speak for
toxicity much more strongly than against it.  A document's ratio is the mean over
its words, so length does not count by itself.  A word's probability under a class is its
discounted share of the class's words plus, for the mass the discount frees,
its spelling's probability under a Kneser-Ney character model: the counts of
the longest context are of the class's distinct words, every shorter one
counts the different letters that precede it, and contexts of up to
``SHARED`` letters are counted over both classes together.  So a rare or new
expression is judged by the spellings it shares with known ones.

The models are fitted on at most ``max_docs`` labelled documents of each class
(those with the smallest hash of the id), the only bounded part: whole texts,
collected to the driver.  Four fifths of them give the counts, the rest the
logistic curve that turns the ratio into a score.  Scoring reads every row;
each task keeps the ratios of the words it has met.

Defined results: null, empty and wordless texts have ratio 0 and get the score
of that ratio.  A document labelled more than once is toxic if any label says
so; null labels and labels of unknown documents are ignored.  Without labels of
both classes every score is 0.  Repeated rows get the same score; other columns
are not looked at.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.llm.common import col, text_of

MAX_DOCS = 4000
THRESHOLD = 0.3
ORDER = 4
SHARED = 1
DISCOUNT = 0.95
WORD_DISCOUNT = 0.95
SPECIFIC = 0.02
FLOOR = 0.01
KNOWN_WORDS = 300_000
NO_WORD = re.compile(rb"[\x00-\x60\x7B-\x7F]+")


def words_of(text: str) -> list[bytes]:
    """Lower-case words: letters a-z and everything outside ASCII."""
    return NO_WORD.sub(b" ", text.lower().encode("utf-8", "replace")).split()


class Spelling:
    """Interpolated Kneser-Ney over the letters of distinct words, for two classes."""

    def __init__(self, types: list[list[bytes]]):
        top = [Counter(), Counter()]
        for c, own in enumerate(types):
            for word in own:
                s = b"\x01" * (ORDER - 1) + word + b"\x02"
                top[c].update(s[k : k + ORDER] for k in range(len(s) - ORDER + 1))
        self.counts: list[dict[bytes, int]] = []
        self.contexts: list[dict[bytes, tuple[int, int]]] = []
        grams = [dict(t) for t in top]
        seen = [set(t) for t in top]
        levels = [grams]
        for _ in range(ORDER - 1):  # one letter shorter: how many different letters stand before it
            lower = [dict(Counter(g[1:] for g in s)) for s in seen]
            levels.append(lower)
            seen = [set(x) for x in lower]
        merged = []
        for n, level in zip(range(ORDER, 0, -1), levels, strict=True):
            if n - 1 <= SHARED:
                both = Counter(level[0])
                both.update(level[1])
                level = [dict(both)] * 2
            merged.append(level)
        for c in (0, 1):
            counts: dict[bytes, int] = {}
            context: dict[bytes, list[int]] = defaultdict(lambda: [0, 0])
            for level in merged:
                counts.update(level[c])
                for g, n in level[c].items():
                    at = context[g[:-1]]
                    at[0] += n
                    at[1] += 1
            self.counts.append(counts)
            self.contexts.append({k: (v[0], v[1]) for k, v in context.items()})
        self.known: dict[tuple[int, bytes], float] = {}
        self.log_ratios = LetterRatios(self)

    def letter(self, c: int, gram: bytes) -> float:
        """Probability of a gram's last letter after the others."""
        key = (c, gram)
        p = self.known.get(key)
        if p is None:
            lower = self.letter(c, gram[1:]) if len(gram) > 1 else 1 / 256
            total, kinds = self.contexts[c].get(gram[:-1], (0, 0))
            p = lower
            if total:
                p = (max(self.counts[c].get(gram, 0) - DISCOUNT, 0) + DISCOUNT * kinds * lower) / total
            if len(self.known) > 500_000:
                self.known.clear()
            self.known[key] = p
        return p

    def word(self, c: int, word: bytes) -> float:
        return math.exp(sum(math.log(self.letter(c, g)) for g in grams_of(word)))

    def log_ratio(self, word: bytes) -> float:
        return sum(map(self.log_ratios.__getitem__, grams_of(word)))


def grams_of(word: bytes) -> list[bytes]:
    s = b"\x01" * (ORDER - 1) + word + b"\x02"
    return [s[k : k + ORDER] for k in range(len(s) - ORDER + 1)]


class LetterRatios(dict):
    """Log ratio of a gram's last letter between the classes."""

    def __init__(self, spelling: Spelling):
        super().__init__()
        self.spelling = spelling

    def __missing__(self, gram: bytes) -> float:
        if len(self) > 500_000:
            self.clear()
        p = self[gram] = math.log(self.spelling.letter(1, gram)) - math.log(self.spelling.letter(0, gram))
        return p

    def __reduce__(self):
        return LetterRatios, (self.spelling,)


class Ratios(dict):
    """Log-likelihood ratio, toxic against ordinary, of every word asked for."""

    def __init__(self, counts: list[Counter]):
        super().__init__()
        self.counts = [dict(c) for c in counts]
        self.totals = [max(sum(c.values()), 1) for c in counts]
        self.spelling = Spelling([sorted(c) for c in counts])

    def __missing__(self, word: bytes) -> float:
        freed = [WORD_DISCOUNT * len(own) / total for own, total in zip(self.counts, self.totals, strict=True)]
        if word in self.counts[0] or word in self.counts[1]:
            p0, p1 = (
                max(own.get(word, 0) - WORD_DISCOUNT, 0) / total + f * self.spelling.word(c, word) + 1e-300
                for c, (own, total, f) in enumerate(zip(self.counts, self.totals, freed, strict=True))
            )
            ratio = math.log(p1 / p0)
        else:  # neither has met it: only the spelling differs
            ratio = math.log(freed[1] / freed[0]) + self.spelling.log_ratio(word)
        # most words of a toxic text are ordinary ones: its model shares the ordinary one but for a part
        mixed = self[word] = math.log1p(SPECIFIC * math.expm1(min(ratio, 50.0)))
        return mixed

    def of(self, text: str) -> float:
        """Length-normalised ratio of a text, on a scale of powers: clear cases shall not flatten the curve."""
        words = words_of(text)
        if not words:
            return math.log(FLOOR)
        if len(self) > KNOWN_WORDS:
            self.clear()
        own = np.fromiter(map(self.__getitem__, words), np.float64, len(words))
        return math.log(FLOOR + max(float(own.mean()), 0.0))


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope (not negative) and intercept of a slightly damped logistic fit, by Newton steps on the scaled ratio."""
    scale = float(np.std(x)) or 1.0
    a = np.stack([x / scale, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    damp = np.diag([1e-2, 1e-4])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -35, 35)))
        hessian = (a * (p * (1 - p))[:, None]).T @ a + damp
        w = w + np.linalg.solve(hessian, a.T @ (y - p) - damp @ w)
    return max(w[0], 0.0) / scale, w[1]


def fit(toxic: list[str], ordinary: list[str], toxic_share: float) -> tuple[Ratios, float, float] | None:
    """Models from four fifths of the texts, the curve from the rest, set for the given share of toxic documents."""
    if not toxic or not ordinary:
        return None
    cut = [len(own) * 4 // 5 for own in (ordinary, toxic)]
    parts = [own[:n] or own for own, n in zip((ordinary, toxic), cut, strict=True)]
    rest = [own[n:] or own for own, n in zip((ordinary, toxic), cut, strict=True)]
    counts = [Counter(w for t in part for w in words_of(t)) for part in parts]
    ratios = Ratios(counts)
    x = np.array([ratios.of(t) for part in rest for t in part])
    y = np.repeat([0.0, 1.0], [len(rest[0]), len(rest[1])])
    slope, intercept = logistic(x, y)
    sampled = len(rest[1]) / len(x)
    share = min(max(toxic_share, 1e-6), 1 - 1e-6)
    intercept += math.log(share / (1 - share)) - math.log(sampled / (1 - sampled))
    return ratios, slope, intercept


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(col(id_col).cast("string"), F.lit(""))), F.lit(4)) == 2


def fitted(
    texts: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_docs: int = MAX_DOCS
) -> tuple[Ratios, float, float] | None:
    """The model made from labelled rows of ``texts`` that are not held out."""
    truth = (
        labels.where("toxic is not null and doc_id is not null")
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .where(~held_out("label_id"))
    )
    known = texts.select(col(id_col).alias("label_id"), text_of(text_col).alias("text"))
    shares = {r["toxic"]: r["count"] for r in truth.groupBy("toxic").count().collect()}
    order = [F.xxhash64("label_id"), F.col("label_id")]
    sampled = truth.where("toxic = 0").orderBy(*order).limit(max_docs)
    sampled = sampled.union(truth.where("toxic = 1").orderBy(*order).limit(max_docs))
    # at most 2 * max_docs ids: small whatever the table
    chosen = known.join(F.broadcast(sampled), "label_id").dropDuplicates(["label_id"]).orderBy(*order)
    rows = chosen.select("toxic", "text").collect()
    total = sum(shares.values())
    return fit(
        [r["text"] for r in rows if r["toxic"] == 1],
        [r["text"] for r in rows if r["toxic"] == 0],
        shares.get(1, 0) / total if total else 0.0,
    )


def scores(
    df: DataFrame, model: tuple[Ratios, float, float] | None, kept: Column, text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """kept, score and predicted of every row of ``df``."""
    rows = df.select(kept.alias("kept"), text_of(text_col).alias("text"))
    schema = T.StructType(
        [rows.schema[0], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )
    shipped = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = pickle.loads(shipped.value)
        for batch in batches:
            out = np.zeros(batch.num_rows)
            if made:
                ratios, slope, intercept = made
                means = np.array([ratios.of(t.as_py()) for t in batch.column(1)])
                out = 1 / (1 + np.exp(-np.clip(slope * means + intercept, -35, 35)))
            flags = pa.array((out >= threshold).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out), flags], names=schema.names)

    return rows.mapInArrow(scored, schema)


def toxicity(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_docs: int = MAX_DOCS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``df``: id, held_out, score, predicted."""
    model = fitted(df, labels, id_col, text_col, max_docs)
    return scores(df, model, col(id_col), text_col, threshold).select(
        F.col("kept").alias(id_col), held_out("kept").alias("held_out"), "score", "predicted"
    )


def without_toxic(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_docs: int = MAX_DOCS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``df`` that are not predicted toxic, with all their columns."""
    model = fitted(df, labels, id_col, text_col, max_docs)
    return scores(df, model, F.struct("*"), text_col, threshold).where("predicted = 0").select("kept.*")
