"""Document scores by masked pseudo-likelihood.

A window network sees ``side`` words on both sides of a masked word and gives
it a probability; a document's score is the sum of the log-probabilities of all
its words, each predicted from both sides.

1. Word counts of the whole corpus choose the vocabulary: every word of up to
   ``LONGEST`` bytes that makes up at least one in ``SHARE`` of all words, so
   never more than ``SHARE`` words, has a number, its rank.  Any other word is
   predicted in two steps: its first byte has one of 256 numbers in the network,
   and the rest of its bytes, and its end, come from a model of letter pairs
   counted over all such words.  So each word has its own probability, whether
   the corpus knows it or not, and those of all words sum to at most one.
   Neighbouring numbers form classes, about as many as a class has numbers: the
   network predicts the class, then the number in it.  It begins with the shares
   of classes and numbers in the corpus.
2. Training, in numpy: in every round each task starts from the same weights,
   passes over all its documents with Adagrad steps, and the results are
   averaged, weighted by the words they have predicted.  Each round masks one
   residue of the places in a text, and the rounds take turns: after ``rounds``
   rounds every word of every text has been predicted once.  Averages are
   formed piece by piece in two steps, so no task and not the driver gets more
   than one network's worth of numbers plus a bounded number of rows.
3. Scoring predicts every word of every text.

Texts are split, learnt and scored in slices, so memory does not grow with
their length beyond two bytes a word.  The weights depend slightly on how the rows are
partitioned, as with any averaged training.

Words are runs of characters between ASCII white space, A-Z lowered.  Defined
results: null and wordless texts have no words, log-likelihood 0 and mean 0;
repeated rows get the same score; an empty table gives an empty result.  Other
columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.llm.common import col, settle, text_of

SIDE = 2
CLASSES = 64
IN_CLASS = 64
SHARE = 60_000
LONGEST = 256
FIRST_BYTES = 256
EDGE = 256
SMOOTH = 0.1
WIDTH = 16
HIDDEN = 32
ROUNDS = 2
BATCH = 8192
BLOCK = 2048
PART = 256
FEWEST = 16
MOST = 128
SAFE = 60
RATE = 0.1
PIECE = 1024
SALTS = 64
COUNTED = 1 << 25
SLICE = 1 << 20
SEED = 7
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def text_slices(text: bytes) -> Iterator[bytes]:
    """A text, cut at white space."""
    at = 0
    while at < len(text):
        cut = SPACE.search(text, at + SLICE) if len(text) - at > SLICE else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, slice by slice."""
    return (part.lower().split() for part in text_slices(text))


def text_words(texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, pa.StringArray]]:
    """The words of many texts in their order, those of about ``SLICE`` bytes at a time, and the number of each word's text."""

    def split() -> tuple[np.ndarray, pa.StringArray]:
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(held, pa.binary()).view(pa.string())))
        words, text = lists.flatten(), np.repeat(owner, lists.value_lengths().to_numpy())
        some = pc.greater(pc.binary_length(words), 0)  # white space at an end of a text leaves an empty string there
        if pc.all(some).as_py() is False:
            words, text = words.filter(some), text[some.to_numpy(zero_copy_only=False)]
        return text, words

    owner: list[int] = []
    held: list[bytes] = []
    size = 0
    for k, text in enumerate(texts):
        for part in text_slices(text):
            owner.append(k)
            held.append(part)
            size += len(part)
            if size >= SLICE:
                yield split()
                owner, held, size = [], [], 0
    if held:
        yield split()


def raw_bytes(words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Where the bytes of each word begin and those of the last end, and the bytes of all."""
    if not len(words):
        return np.zeros(1, np.int32), np.empty(0, np.uint8)
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    return ends - ends[0], np.frombuffer(words.buffers()[2], np.uint8)[ends[0] : ends[-1]]


class Numbers:
    """Numbers of words: the rank of a frequent word, that of its first byte for any other."""

    def __init__(self, frequent: list[bytes]):
        self.ranks = pa.array(frequent, pa.binary()).view(pa.string())
        self.first = len(frequent)

    def of(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray, pa.StringArray]:
        """The numbers of some words, the places of those that are not frequent, and these."""
        rank = pc.index_in(words, value_set=self.ranks)
        own = rank.fill_null(0).to_numpy().astype("<u2")
        rare = words.filter(rank.is_null())
        places = np.flatnonzero(rank.is_null().to_numpy(zero_copy_only=False))
        ends, every = raw_bytes(rare)
        own[places] = every[ends[:-1]] + np.uint16(self.first)
        return own, places, rare


class Spelling:
    """Log-probabilities of the bytes of a word after its first, by the byte before; ``EDGE`` ends a word."""

    def __init__(self, pairs: np.ndarray):
        """``pairs[a, b]``: how often byte b follows byte a; row ``EDGE`` counts first bytes and is not used."""
        counts = pairs[:EDGE].astype(np.float64) + SMOOTH
        self.logs = np.log(counts / counts.sum(axis=1, keepdims=True))
        joined = self.logs[:, :EDGE].copy()  # a space, which no word holds, ends one
        joined[:, 32] = self.logs[:, EDGE]
        self.joined = joined.ravel()

    def of_bytes(self, ends: np.ndarray, every: np.ndarray) -> np.ndarray:
        """What every byte of some words adds, as ``raw_bytes`` gives them."""
        pairs = every.astype(np.uint16)
        pairs <<= 8
        pairs[:-1] |= every[1:]
        last = ends[1:] - 1
        pairs[last] &= 0xFF00
        pairs[last] |= 32
        return self.joined.take(pairs)

    def of(self, words: list[bytes]) -> float:
        """The sum over some words."""
        return float(self.of_bytes(*raw_bytes(pa.array(words, pa.binary()))).sum())

    def of_texts(self, words: pa.StringArray, text: np.ndarray, n: int) -> np.ndarray:
        """The sums over the words of n texts; ``text``, in order, says whose each word is."""
        out = np.zeros(n)
        if len(words):
            ends, every = raw_bytes(words)
            firsts = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
            out[text[firsts]] = np.add.reduceat(self.of_bytes(ends, every), ends[firsts])
        return out


def byte_pairs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Every byte of the words with the byte, or the end, that follows."""
    every = np.frombuffer(b" ".join(words) + b" ", np.uint8).astype(np.intp)
    before, after = every[:-1], every[1:]
    inside = before != 32
    after = np.where(after == 32, EDGE, after)
    return before[inside], after[inside]


def blocks(low: int, high: int) -> Iterator[slice]:
    """Rows whose numbers a processor's cache can hold, as many as whole parts hold, and what is left over."""
    while low < high:
        n = min(BLOCK, high - low)
        n = n - n % PART or n
        yield slice(low, low + n)
        low += n


def stacked(rows: np.ndarray) -> np.ndarray:
    """The rows of a block part by part: gradients take less time as products of small matrices."""
    return rows.reshape(-1, min(len(rows), PART), *rows.shape[1:])


class Network:
    """Window network with a two-step softmax; ``size`` = classes * in_class numbers, and ``size`` itself as padding."""

    def __init__(self, side: int = SIDE, width: int = WIDTH, hidden: int = HIDDEN, classes: int = CLASSES, in_class: int = IN_CLASS):
        self.shape = {"side": side, "width": width, "hidden": hidden, "classes": classes, "in_class": in_class}
        self.side, self.classes, self.in_class, self.size = side, classes, in_class, classes * in_class
        rng = np.random.default_rng(SEED)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[-1])).astype(np.float32)
        self.parts = {
            "embed": draw(self.size + 1, width),
            "inner": draw(hidden, 2 * side * width),
            "inner_bias": np.zeros(hidden, np.float32),
            "by_class": draw(classes, hidden) * 0.1,
            "class_bias": np.zeros(classes, np.float32),
            "by_word": draw(self.size, hidden) * 0.1,
            "word_bias": np.zeros(self.size, np.float32),
        }
        self.parts = {k: np.ascontiguousarray(v, np.float32) for k, v in self.parts.items()}
        self.rooms: dict[str, np.ndarray] = {}

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> Network:
        """A network for numbers that occur so often, which begins with their shares."""
        in_class = max(int(np.ceil(np.sqrt(len(counts)))), 1)
        classes = -(-len(counts) // in_class)
        net = cls(classes=classes, in_class=in_class)
        n = np.full(net.size, 1e-3)
        n[: len(counts)] = np.maximum(counts, 1e-3)
        n = n.reshape(classes, in_class)
        of_class = n.sum(axis=1)
        net.parts["class_bias"] = np.log(of_class / of_class.sum()).astype(np.float32)
        net.parts["word_bias"] = np.log(n / of_class[:, None]).ravel().astype(np.float32)
        return net

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts.values()])

    def load(self, values: np.ndarray) -> Network:
        at = 0
        for k, p in self.parts.items():
            self.parts[k] = values[at : at + p.size].reshape(p.shape).astype(np.float32)
            at += p.size
        return self

    def windows(self, ids: np.ndarray, first: int = 0, step: int = 1) -> np.ndarray:
        """The numbers around every ``step``-th place of one text, from ``first`` on."""
        edge = np.full(self.side, self.size, np.intp)
        padded = np.concatenate([edge, ids, edge])
        around = np.empty((len(range(first, len(ids), step)), 2 * self.side), np.intp)
        for k in range(2 * self.side):
            shift = k if k < self.side else k + 1
            around[:, k] = padded[first + shift : len(ids) + shift : step]
        return around

    def _room(self, name: str, *shape: int) -> np.ndarray:
        """Memory for numbers of one step that the next step uses again; new memory for each costs more than the sums."""
        kind, size = self.parts["inner"].dtype, math.prod(shape)
        held = self.rooms.get(name)
        if held is None or held.size < size or held.dtype != kind:
            held = self.rooms[name] = np.empty(size, kind)
        return held[:size].reshape(shape)

    def _hidden(self, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The joined vectors of the windows, and the hidden layer with a last column of ones for the biases."""
        p, n = self.parts, len(around)
        x = self._room("x", around.size, p["embed"].shape[1])
        p["embed"].take(around.ravel(), axis=0, out=x, mode="clip")
        x = x.reshape(n, -1)
        inside = np.matmul(x, p["inner"].T, out=self._room("inside", n, len(p["inner"])))
        inside += p["inner_bias"]
        h = self._room("h", n, len(p["inner"]) + 1)
        np.tanh(inside, out=h[:, :-1])
        h[:, -1] = 1
        return x, h

    def _outer(self) -> tuple[np.ndarray, np.ndarray]:
        """The weights of classes and of numbers, these class by class, each with its bias as last column."""
        p, both = self.parts, []
        for name, bias in (("by_class", "class_bias"), ("by_word", "word_bias")):
            rows, columns = p[name].shape
            both.append(self._room(name, rows, columns + 1))
            both[-1][:, :-1] = p[name]
            both[-1][:, -1] = p[bias]
        return both[0], both[1].reshape(self.classes, self.in_class, -1)

    def _is_safe(self, weights: np.ndarray) -> bool:
        """Whether single precision holds the exponentials of all inputs of a softmax; no number of the hidden layer exceeds one."""
        return bool(self._row_sums(np.abs(weights, out=self._room("abs", *weights.shape))).max() < SAFE)

    def _level(self, h: np.ndarray, weights: np.ndarray, safe: bool) -> np.ndarray:
        """Inputs of a softmax, less the greatest of each row unless all are safe."""
        z = np.matmul(h, weights.swapaxes(-1, -2), out=self._room("z", *h.shape[:-1], weights.shape[-2]))
        if not safe:
            z -= z.max(axis=-1, keepdims=True)
        return z

    @staticmethod
    def _at(z: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of z in one row, and where the chosen one of each of its rows is."""
        flat = z.reshape(-1)
        return flat, np.arange(0, flat.size, z.shape[-1]) + chosen.reshape(-1)

    @staticmethod
    def _row_sums(z: np.ndarray) -> np.ndarray:
        return z @ np.ones(z.shape[-1], z.dtype)

    def _gradients(
        self, h: np.ndarray, weights: np.ndarray, chosen: np.ndarray, n: int, safe: bool, real: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the loss over n, part by part or class by class: by the hidden layer and by the weights."""
        e = self._level(h, weights, safe)
        np.exp(e, out=e)
        sums = self._row_sums(e)
        flat, at = self._at(e, chosen)
        flat[at] -= sums.reshape(-1)
        share = 1 / (n * sums)
        if real is not None:
            share *= real
        share = share[..., None]
        back = np.matmul(e, weights, out=self._room("part", *h.shape))
        back *= share
        return back, np.matmul(e.swapaxes(-1, -2), np.multiply(h, share, out=self._room("scaled", *h.shape)))

    def _log_share(self, h: np.ndarray, weights: np.ndarray, chosen: np.ndarray, safe: bool) -> np.ndarray:
        """Log of the softmax at one place of each row."""
        z = self._level(h, weights, safe)
        flat, at = self._at(z, chosen)
        own = flat[at].reshape(chosen.shape)
        return own - np.log(self._row_sums(np.exp(z, out=z)))

    def _by_class(self, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """An order of the targets by class, and where each class begins and the last one ends in it."""
        group = (target // self.in_class).astype(np.uint16)
        order = np.argsort(group, kind="stable")
        return order, np.append(0, np.cumsum(np.bincount(group, minlength=self.classes)))

    def _large(self, bounds: np.ndarray) -> Iterator[tuple[int, slice]]:
        """Classes of more than ``MOST`` rows, each with some of its rows."""
        for c in np.flatnonzero(np.diff(bounds) > MOST):
            for rows in blocks(bounds[c], bounds[c + 1]):
                yield c, rows

    def _small(self, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """All other classes, those of about one size together: the classes, their rows, and which of these are real.

        Each class is filled up with other rows to the next power of two, as one product of many small matrices takes
        less time than many products.
        """
        first, count = bounds[:-1], np.diff(bounds)
        least, width = 0, FEWEST
        while least < MOST:
            some = np.flatnonzero((count > least) & (count <= width))
            for low in range(0, len(some), BLOCK // width):
                c = some[low : low + BLOCK // width]
                rows = first[c][:, None] + np.arange(width)
                yield c, np.minimum(rows, bounds[-1] - 1), np.arange(width) < count[c][:, None]
            least, width = width, 2 * width

    def _taken(self, h: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Rows of the hidden layer."""
        out = self._room("taken", rows.size, h.shape[1])
        return h.take(rows.ravel(), axis=0, out=out, mode="clip").reshape(*rows.shape, -1)

    def log_probability(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        by_class, by_word = self._outer()
        order, bounds = self._by_class(target)
        h = self._hidden(around[order])[1]
        group, inside = np.divmod(target[order], self.in_class)
        safe = self._is_safe(by_class)
        own = np.empty(len(h), h.dtype)
        for rows in blocks(0, len(h)):
            own[rows] = self._log_share(h[rows], by_class, group[rows], safe)
        safe = self._is_safe(by_word)
        for c, rows in self._large(bounds):
            own[rows] += self._log_share(h[rows], by_word[c], inside[rows], safe)
        for c, rows, real in self._small(bounds):
            own[rows[real]] += self._log_share(self._taken(h, rows), by_word[c], inside[rows], safe)[real]
        out = np.empty_like(own)
        out[order] = own
        return out

    def step(self, around: np.ndarray, target: np.ndarray, squares: dict[str, np.ndarray], rate: float) -> None:
        """One Adagrad step on the mean negative log-probability."""
        p, n = self.parts, len(target)

        def move(name: str, rows: slice | np.ndarray, gradient: np.ndarray) -> None:
            total = squares[name][rows] + gradient * gradient
            squares[name][rows] = total
            total += 1e-8
            p[name][rows] -= rate * gradient / np.sqrt(total, out=total)

        by_class, by_word = self._outer()
        order, bounds = self._by_class(target)
        around = around[order]
        group, place = np.divmod(target[order], self.in_class)
        x, h = self._hidden(around)
        back, of_word = self._room("back", *h.shape), self._room("of_word", *by_word.shape)
        of_class = np.zeros_like(by_class)
        of_word[:] = 0
        safe = self._is_safe(by_class)
        for rows in blocks(0, n):
            more, own = self._gradients(stacked(h[rows]), by_class, stacked(group[rows]), n, safe)
            back[rows] = more.reshape(-1, h.shape[1])
            of_class += own.sum(axis=0)
        safe = self._is_safe(by_word)
        for c, rows in self._large(bounds):
            more, own = self._gradients(stacked(h[rows]), by_word[c], stacked(place[rows]), n, safe)
            back[rows] += more.reshape(-1, h.shape[1])
            of_word[c] += own.sum(axis=0)
        for c, rows, real in self._small(bounds):
            more, of_word[c] = self._gradients(self._taken(h, rows), by_word[c], place[rows], n, safe, real)
            back[rows[real]] += more[real]
        of_word = of_word.reshape(self.size, -1)
        h = h[:, :-1]
        inside = self._room("inside", *h.shape)
        np.subtract(1, np.multiply(h, h, out=inside), out=inside)
        inside *= back[:, :-1]
        # by vector column, then place in the window: the rows that the sums by number read one after the other
        width = p["embed"].shape[1]
        by_column = p["inner"].reshape(len(p["inner"]), -1, width).T.reshape(-1, len(p["inner"]))
        into = np.matmul(by_column, inside.T, out=self._room("into", len(by_column), n)).reshape(width, -1)
        every = slice(None)
        move("by_class", every, of_class[:, :-1])
        move("class_bias", every, of_class[:, -1])
        move("by_word", every, of_word[:, :-1])
        move("word_bias", every, of_word[:, -1])
        move("inner", every, sum((stacked(inside[rows]).swapaxes(1, 2) @ stacked(x[rows])).sum(axis=0) for rows in blocks(0, n)))
        move("inner_bias", every, np.ones(n, inside.dtype) @ inside)
        seen = around.T.ravel()
        touched = np.flatnonzero(np.bincount(seen, minlength=self.size + 1))
        sums = [np.bincount(seen, column, self.size + 1)[touched] for column in into]
        move("embed", touched, np.stack(sums, axis=1).astype(into.dtype))


def word_counts(df: DataFrame, text_col: str) -> DataFrame:
    """How often every word of the corpus occurs: word, n."""
    rows = df.select(F.encode(text_of(text_col), "UTF-8").alias("utf8"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.StringArray] = []
        size = 0

        def out() -> pa.RecordBatch:
            words, n = pc.value_counts(pa.chunked_array(held)).flatten()
            return pa.RecordBatch.from_arrays([words.view(pa.binary()), n], names=["word", "n"])

        for batch in batches:
            for _, words in text_words(text.as_py() for text in batch.column(0)):
                held.append(words)
                size += words.nbytes
                if size >= COUNTED:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return rows.mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def pair_counts(outside: DataFrame) -> np.ndarray:
    """Over all occurrences of some words (word, n): how often a byte, or the end, follows a byte, or the beginning."""
    width = EDGE + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(width * width, np.int64)
        for batch in batches:
            words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            if words:
                before, after = byte_pairs(words)
                np.add.at(sums, before * width + after, np.repeat(n, [len(w) for w in words]))
                np.add.at(sums, EDGE * width + np.array([w[0] for w in words]), n)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(sums[some])], names=["pair", "n"])

    counted = outside.select("word", "n").mapInArrow(count, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    out = np.zeros(width * width, np.int64)
    for r in counted.collect():  # at most 257 * 257 rows
        out[r["pair"]] = r["n"]
    return out.reshape(width, width)


def encoded(df: DataFrame, frequent: list[bytes], spelling: Spelling, id_col: str, text_col: str) -> DataFrame:
    """id, the numbers of the words, two bytes each, and what the spelling of the others adds to the log-likelihood."""
    rows = df.select(col(id_col).alias("id"), F.encode(text_of(text_col), "UTF-8").alias("utf8"))
    schema = T.StructType([rows.schema[0], T.StructField("numbers", T.BinaryType()), T.StructField("spelled", T.DoubleType())])
    shipped = df.sparkSession.sparkContext.broadcast((frequent, spelling))  # at most SHARE words of LONGEST bytes

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, spells = shipped.value
        numbers = Numbers(known)
        for batch in batches:
            made, spelled = [], np.zeros(batch.num_rows)
            n = np.zeros(batch.num_rows, np.int64)
            for text, words in text_words(text.as_py() for text in batch.column(1)):
                own, places, rare = numbers.of(words)
                made.append(own.tobytes())
                n += np.bincount(text, minlength=len(n))
                spelled += spells.of_texts(rare, text[places], len(n))
            ends = np.append(0, np.cumsum(2 * n)).astype(np.int32)
            texts = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(made))])
            yield pa.RecordBatch.from_arrays([batch.column(0), texts, pa.array(spelled)], names=schema.names)

    return rows.mapInArrow(encode, schema)


def averaged(parts: DataFrame) -> np.ndarray:
    """Weighted mean of the tasks' weights (salt, piece, weight, numbers), in two steps."""

    def add(group: pa.Table) -> pa.Table:
        sums = np.zeros(PIECE)
        for batch in group.to_batches():
            w = batch.column("weight").to_numpy()
            sums += w @ np.frombuffer(b"".join(batch.column("sums").to_pylist()), "<f4").reshape(len(w), PIECE)
        total = float(np.sum(group.column("weight").to_numpy()))
        mean = (sums / max(total, 1e-30)).astype("<f4").tobytes()
        return pa.table({"piece": group.column("piece").slice(0, 1), "weight": [total], "sums": pa.array([mean], pa.binary())})

    schema = "piece int, weight double, sums binary"
    once = parts.groupBy("piece", "salt").applyInArrow(add, schema)
    rows = once.groupBy("piece").applyInArrow(add, schema).collect()  # one network
    return np.concatenate([np.frombuffer(r["sums"], "<f4") for r in sorted(rows, key=lambda r: r["piece"])]) if rows else np.empty(0)


def turn(n: int, r: int, rounds: int) -> np.ndarray:
    """The places of a text of n words that round r predicts; the rounds share them all out."""
    return np.arange((r + n) % rounds, n, rounds)


def slices(data: bytes, net: Network, r: int = 0, rounds: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The windows and numbers of one round's places in a text, slice by slice."""
    ids = np.frombuffer(data, "<u2")
    places = turn(len(ids), r, rounds)
    for low in range(0, len(places), BATCH):
        first, last = int(places[low]), int(places[min(low + BATCH, len(places)) - 1])
        start = max(first - net.side, 0)
        own = ids[start : last + net.side + 1].astype(np.intp)
        target = own[first - start : last - start + 1 : rounds]
        yield net.windows(own, first - start, rounds)[: len(target)], target


def text_windows(
    texts: Iterable[bytes], net: Network, r: int = 0, rounds: int = 1, size: int = BATCH
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The windows and numbers of one round's places in many texts, in their order, and whose each is; about ``size`` at a time."""
    edge = np.full(net.side, net.size, "<u2").tobytes()

    def joined() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = np.frombuffer(edge + edge.join(held) + edge, "<u2")
        n = np.array([len(data) // 2 for data in held])
        start = np.cumsum(n + net.side) - n
        first = (r + n) % rounds
        count = np.maximum(-((first - n) // rounds), 0)
        before = np.cumsum(count) - count
        places = np.arange(0, rounds * count.sum(), rounds) + np.repeat(start + first - rounds * before, count)
        around = np.empty((len(places), 2 * net.side), np.intp)
        for k in range(2 * net.side):
            around[:, k] = ids.take(places + (k - net.side if k < net.side else k - net.side + 1))
        return around, ids.take(places).astype(np.intp), np.repeat(owner, count)

    owner: list[int] = []
    held: list[bytes] = []
    words = 0
    for k, data in enumerate(texts):
        if words and words + len(data) // 2 > size * rounds:
            yield joined()
            owner, held, words = [], [], 0
        if len(data) // 2 > size * rounds:
            for around, target in slices(data, net, r, rounds):
                yield around, target, np.full(len(target), k)
        else:
            owner.append(k)
            held.append(data)
            words += len(data) // 2
    if words:
        yield joined()


def full_batches(parts: Iterable[tuple[np.ndarray, np.ndarray]], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The windows and numbers of all parts in their order, ``size`` at a time; only the last batch may hold fewer."""
    around: list[np.ndarray] = []
    target: list[np.ndarray] = []
    held = 0
    for a, t in parts:
        around.append(a)
        target.append(t)
        held += len(t)
        if held >= size:
            a, t = np.concatenate(around), np.concatenate(target)
            full = held - held % size
            for low in range(0, full, size):
                yield a[low : low + size], t[low : low + size]
            around, target, held = [a[full:]], [t[full:]], held - full
    if held:
        yield np.concatenate(around), np.concatenate(target)


def trained(numbers: DataFrame, rounds: int, net: Network | None = None) -> Network:
    """A network trained on all texts, from the given one on."""
    net = net or Network()
    shape = net.shape
    weights = net.flat()
    for r in range(rounds):
        shipped = numbers.sparkSession.sparkContext.broadcast(weights)

        def learn(batches: Iterator[pa.RecordBatch], r: int = r, shipped=shipped) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            own = Network(**shape).load(shipped.value)
            squares = {k: np.full_like(p, 1e-4) for k, p in own.parts.items()}
            seen = 0
            texts = ((data.as_py() for data in batch.column(0)) for batch in batches)
            parts = ((around, target) for own_texts in texts for around, target, _ in text_windows(own_texts, own, r, rounds))
            for around, target in full_batches(parts, BATCH):
                own.step(around, target, squares, RATE)
                seen += len(target)
            if seen:
                flat = own.flat()
                flat = np.concatenate([flat, np.zeros(-len(flat) % PIECE, np.float32)]).reshape(-1, PIECE)
                n = len(flat)
                salt = TaskContext.get().partitionId() % SALTS
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([salt] * n, pa.int32()),
                        pa.array(range(n), pa.int32()),
                        pa.array([float(seen)] * n, pa.float64()),
                        pa.array([x.astype("<f4").tobytes() for x in flat], pa.binary()),
                    ],
                    names=["salt", "piece", "weight", "sums"],
                )

        got = averaged(numbers.select("numbers").mapInArrow(learn, "salt int, piece int, weight double, sums binary"))
        if len(got):
            weights = got[: len(weights)]
    return net.load(weights)


def scored(numbers: DataFrame, net: Network, id_col: str = "id") -> DataFrame:
    """id, n_words, log_likelihood, mean_log_likelihood of encoded texts."""
    shape = net.shape
    shipped = numbers.sparkSession.sparkContext.broadcast(net.flat())
    schema = T.StructType(
        [
            T.StructField(id_col, numbers.schema["id"].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("log_likelihood", T.DoubleType()),
            T.StructField("mean_log_likelihood", T.DoubleType()),
        ]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network(**shape).load(shipped.value)
        for batch in batches:
            sums = batch.column(2).to_numpy().copy()
            n = np.zeros(batch.num_rows, np.int64)
            for around, target, text in text_windows((data.as_py() for data in batch.column(1)), own, size=2 * BATCH):
                sums += np.bincount(text, own.log_probability(around, target), minlength=len(sums))
                n += np.bincount(text, minlength=len(n))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(sums), pa.array(sums / np.maximum(n, 1))], names=schema.names
            )

    return numbers.select("id", "numbers", "spelled").mapInArrow(score, schema)


def vocabulary(df: DataFrame, text_col: str = "text") -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The frequent words, how often each number occurs, and the byte pairs of all other words."""
    counts = settle(word_counts(df, text_col), "words")
    total = counts.select(F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()["total"]
    frequent = (F.col("n") * SHARE >= total) & (F.octet_length("word") <= LONGEST)
    top = counts.where(frequent).orderBy(F.desc("n"), "word").collect()  # at most SHARE words
    pairs = pair_counts(counts.where(~frequent))
    return [bytes(r["word"]) for r in top], np.concatenate([[r["n"] for r in top], pairs[EDGE, :FIRST_BYTES]]), pairs


def lm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per input row: id, n_words, log_likelihood, mean_log_likelihood."""
    frequent, counts, pairs = vocabulary(df, text_col)
    numbers = settle(encoded(df, frequent, Spelling(pairs), id_col, text_col), "numbers")
    return scored(numbers, trained(numbers, rounds, Network.of_counts(counts)), id_col)
