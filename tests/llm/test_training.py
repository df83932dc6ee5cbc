"""Every word of every text is a target of the training."""

import math
from collections import Counter

import numpy as np
import pytest

from ticketlake.llm import lm_score
from ticketlake.llm.common import settle


@pytest.mark.parametrize("rounds", [1, 2, 3, 8])
def test_rounds_share_out_all_places(rounds):
    for n in range(20):
        places = np.concatenate([lm_score.turn(n, r, rounds) for r in range(rounds)])
        assert sorted(places) == list(range(n))


def test_short_texts_train(spark):
    """A text of one word moves the weights, and so does each word of a text of three."""
    for words in ([5], [6, 70, 800]):
        numbers = spark.createDataFrame([(bytearray(np.array(words, "<u2").tobytes()),)], "numbers binary")
        net = lm_score.trained(numbers, 2)
        fresh = lm_score.Network()
        assert all(net.parts["word_bias"][w] > fresh.parts["word_bias"][w] for w in words)


def texts():
    rng = np.random.default_rng(5)
    common = [f"w{k}" for k in range(12)]
    made = [" ".join(rng.choice(common, 30)) + f" rare{k % 7} ünique{k}" for k in range(40)]
    return [*made, "", None, "  ", "W1 w2\tw3\x0bw4", "é", "q" * 300 + " w1"]


def plain_log_probability(net, spelled, frequent, words, place):
    """The log-probability of one word, number by number and byte by byte."""
    number = lambda w: frequent.index(w) if w in frequent else len(frequent) + w[0]
    p = {k: v.astype(np.float64) for k, v in net.parts.items()}
    around = [place + k for k in (-2, -1, 1, 2)]
    x = np.concatenate([p["embed"][number(words[k]) if 0 <= k < len(words) else net.size] for k in around])
    h = np.tanh(p["inner"] @ x + p["inner_bias"])
    of_class = p["by_class"] @ h + p["class_bias"]
    c, j = divmod(number(words[place]), net.in_class)
    own = [p["by_word"][c * net.in_class + k] @ h + p["word_bias"][c * net.in_class + k] for k in range(net.in_class)]
    out = of_class[c] - math.log(sum(math.exp(z) for z in of_class)) + own[j] - math.log(sum(math.exp(z) for z in own))
    if words[place] not in frequent:
        rest = [*words[place], lm_score.EDGE]
        for before, after in zip(rest, rest[1:], strict=False):
            n = spelled[before]
            out += math.log((n[after] + lm_score.SMOOTH) / (sum(n.values()) + lm_score.SMOOTH * (lm_score.EDGE + 1)))
    return out


def test_sums_equal_a_plain_network(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "SHARE", 60)
    docs = list(enumerate(texts()))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    words = {i: (t or "").lower().encode().split() for i, t in docs}
    counted = Counter(w for own in words.values() for w in own)
    total = sum(counted.values())
    frequent, counts, pairs = lm_score.vocabulary(df)
    assert frequent == sorted((w for w, n in counted.items() if n * 60 >= total), key=lambda w: (-counted[w], w))
    assert 0 < len(frequent) < len(counted) and counts.sum() == total
    spelled = {a: Counter() for a in range(256)}
    for w, n in counted.items():
        if w not in frequent:
            for a, b in zip([*w], [*w[1:], lm_score.EDGE], strict=True):
                spelled[a][b] += n
    assert all(pairs[a, b] == n for a, c in spelled.items() for b, n in c.items())
    numbers = settle(lm_score.encoded(df, frequent, lm_score.Spelling(pairs), "doc_id", "text"), "numbers")
    net = lm_score.trained(numbers, 2, lm_score.Network.of_counts(counts))
    out = {r["id"]: r for r in lm_score.scored(numbers, net).collect()}
    for i, own in words.items():
        expected = sum(plain_log_probability(net, spelled, frequent, own, k) for k in range(len(own)))
        assert out[i]["n_words"] == len(own)
        assert math.isclose(out[i]["log_likelihood"], expected, rel_tol=1e-4, abs_tol=1e-6), i


def test_spellings_sum_to_one():
    """All continuations of a byte together, to any length, have probability one."""
    pairs = np.zeros((257, 257), np.int64)
    pairs[97, 98] = 5
    pairs[98, 256] = 3
    steps = np.exp(lm_score.Spelling(pairs).logs)
    assert np.allclose(steps.sum(axis=1), 1)
    assert math.isclose(lm_score.Spelling(pairs).of([b"ab", b"b"]), math.log(steps[97, 98] * steps[98, 256] ** 2))


def test_slices_equal_whole_texts(monkeypatch):
    monkeypatch.setattr(lm_score, "SLICE", 7)
    text = b"Aa bb  cccccccccccccccc\tdd e " * 5
    assert [w for part in lm_score.word_lists(text) for w in part] == text.lower().split()
    net = lm_score.Network(classes=4, in_class=4, width=3, hidden=5)
    ids = np.arange(15, dtype="<u2")
    padded = [16, 16, *ids, 16, 16]
    monkeypatch.setattr(lm_score, "BATCH", 4)
    for rounds in (1, 2, 3):
        got = {}
        for r in range(rounds):
            for around, target in lm_score.slices(ids.tobytes(), net, r, rounds):
                got.update(zip(target.tolist(), around.tolist(), strict=True))
        assert got == {k: [padded[k], padded[k + 1], padded[k + 3], padded[k + 4]] for k in range(15)}


def test_only_the_last_batch_is_small():
    """What is left over of a full batch waits for more texts and is no small step of its own."""
    lengths = [5, 9, 0, 3, 30, 1, 7]
    made = [np.arange(sum(lengths[:k]), sum(lengths[: k + 1])) for k in range(len(lengths))]
    got = list(lm_score.full_batches(((np.stack([t, t], axis=1), t) for t in made), 8))
    assert [len(t) for _, t in got] == [8, 8, 8, 8, 8, 8, 7]
    assert np.array_equal(np.concatenate([t for _, t in got]), np.arange(55))
    assert all(np.array_equal(a[:, 1], t) for a, t in got)
    assert list(lm_score.full_batches(iter([]), 8)) == []


def test_memory_of_a_step_is_used_again():
    """Steps of any size leave no trace in later results, and a later step of no greater size takes no new memory."""
    rng = np.random.default_rng(1)
    draw = lambda n: (rng.integers(0, 17, (n, 4)), rng.integers(0, 16, n))
    net, fresh = (lm_score.Network(classes=4, in_class=4, width=3, hidden=5) for _ in range(2))
    squares = {k: np.full_like(p, 1e-4) for k, p in net.parts.items()}
    net.step(*draw(50), squares, 0.1)
    rooms = {k: id(v) for k, v in net.rooms.items()}
    assert rooms
    net.step(*draw(20), squares, 0.1)
    assert {k: id(v) for k, v in net.rooms.items()} == rooms
    around, target = draw(30)
    expected = fresh.load(net.flat()).log_probability(around, target)
    assert np.array_equal(net.log_probability(around, target), expected)


def test_weights_beyond_single_precision():
    """exp of the inputs is infinite or zero in single precision; the log-probabilities are not."""
    for shift in (200, -200):
        net = lm_score.Network(classes=4, in_class=4, width=3, hidden=5)
        around, target = np.array([[1, 2, 16, 16]] * 16), np.arange(16)
        expected = net.log_probability(around, target)
        net.parts["class_bias"] += shift
        net.parts["word_bias"] += shift
        assert np.allclose(net.log_probability(around, target), expected, atol=1e-4)


def test_words_of_many_texts(monkeypatch):
    """Words, numbers and spelling of many texts at once are those of each text, word by word."""
    made = [(t or "").encode() for t in texts()] + [b" \t a  B\n", b"\x0c", b"\xc3\x89t\xc3\xa9 \x1c\x85 I\xcc\x87", b"x" * 40]
    plain = [t.lower().split() for t in made]
    counted = Counter(w for own in plain for w in own)
    frequent = [w for w, n in counted.most_common(12)]
    rest = [w for w in counted if w not in frequent]
    pairs = np.zeros((257, 257), np.int64)
    np.add.at(pairs, lm_score.byte_pairs(rest), 1)
    numbers, spelling = lm_score.Numbers(frequent), lm_score.Spelling(pairs)
    for size in (1, 50, 1 << 20):
        monkeypatch.setattr(lm_score, "SLICE", size)
        own = [[] for _ in made]
        found = [[] for _ in made]
        spelled = np.zeros(len(made))
        for text, words in lm_score.text_words(made):
            ids, places, rare = numbers.of(words)
            assert [w.as_py() for w in rare.view("binary")] == [w for w in words.view("binary").to_pylist() if w not in frequent]
            spelled += spelling.of_texts(rare, text[places], len(made))
            for k, w, i in zip(text.tolist(), words.view("binary").to_pylist(), ids.tolist(), strict=True):
                own[k].append(w)
                found[k].append(i)
        assert own == plain
        assert found == [[frequent.index(w) if w in frequent else len(frequent) + w[0] for w in t] for t in plain]
        assert np.allclose(spelled, [spelling.of([w for w in t if w not in frequent]) for t in plain])


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_windows_of_many_texts(rounds, monkeypatch):
    monkeypatch.setattr(lm_score, "BATCH", 4)
    net = lm_score.Network(classes=4, in_class=4, width=3, hidden=5)
    made = [np.random.default_rng(n).integers(0, 16, n).astype("<u2").tobytes() for n in (0, 3, 1, 0, 40, 2, 9, 5, 1, 0)]
    for r in range(rounds):
        got = list(lm_score.text_windows(made, net, r, rounds, size=7))
        whole = [(a, t, k) for k, data in enumerate(made) for around, target in lm_score.slices(data, net, r, rounds)
                 for a, t in zip(around.tolist(), target.tolist(), strict=True)]
        assert [x for part in got for x in zip(*(p.tolist() for p in part), strict=True)] == whole
        assert max(len(t) for _, t, _ in got) <= 7


def uneven(classes):
    """A network and places whose classes have from none to some thousand rows."""
    net = lm_score.Network(classes=classes, in_class=6, width=3, hidden=5)
    rng = np.random.default_rng(3)
    group = np.repeat(np.arange(classes), [3000, 129, 128, 65, 17, 16, 1, *[(7 * k) % 23 for k in range(classes - 7)]])
    target = rng.permutation(group * 6 + rng.integers(0, 6, len(group)))
    return net, rng.integers(0, net.size + 1, (len(target), 4)), target


def test_small_classes_are_taken_together(monkeypatch):
    """A step on 60 classes, 54 of them small, takes some products for classes of one size, not some for each class."""
    net, around, target = uneven(60)
    calls = []
    gradients = lm_score.Network._gradients
    monkeypatch.setattr(lm_score.Network, "_gradients", lambda *a: calls.append(1) or gradients(*a))
    net.step(around, target, {k: np.full_like(p, 1e-4) for k, p in net.parts.items()}, 0.1)
    assert len(calls) < 15


@pytest.mark.parametrize("shift", [0, 200])
def test_classes_together_equal_single_ones(shift, monkeypatch):
    moved, shares = [], []
    for most in (lm_score.MOST, 0):
        monkeypatch.setattr(lm_score, "MOST", most, raising=False)
        net, around, target = uneven(60)
        net.parts["word_bias"] += shift
        shares.append(net.log_probability(around, target))
        net.step(around, target, {k: np.full_like(p, 1e-4) for k, p in net.parts.items()}, 0.1)
        moved.append(net.flat())
    assert np.allclose(*shares, atol=1e-4)
    assert np.allclose(*moved, atol=2e-4)
    p = {k: v.astype(np.float64) for k, v in uneven(60)[0].parts.items()}
    h = np.tanh(p["embed"][around].reshape(len(around), -1) @ p["inner"].T + p["inner_bias"])
    rows = np.arange(len(h))
    of_class = h @ p["by_class"].T + p["class_bias"]
    of_word = (h @ p["by_word"].T + p["word_bias"]).reshape(len(h), net.classes, net.in_class)[rows, target // 6]
    expected = of_class[rows, target // 6] - np.log(np.exp(of_class).sum(axis=1)) + of_word[rows, target % 6] - np.log(np.exp(of_word).sum(axis=1))
    assert np.allclose(shares[0], expected, atol=2e-4)
