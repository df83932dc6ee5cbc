"""Suffix order by a difference cover modulo three, in whole-array steps."""

from __future__ import annotations

import numpy as np

MOST = 1 << 21  # three names are packed into 63 bits


def names_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The order of some keys, a name (1, 2, ...) for each, equal for equal keys, and the number of names."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.ones(len(keys), np.int64)
    new[1:] = ranked[1:] != ranked[:-1]
    names = np.empty(len(keys), np.int64)
    names[order] = np.cumsum(new)
    return order, names, int(new.sum())


def suffix_ranks(s: np.ndarray, depth: int) -> np.ndarray:
    """Ranks (from 1) of the suffixes of ``s`` (numbers from 1 below ``MOST``), right in their first ``depth`` places.

    Suffixes that agree that far may have one rank or several neighbouring
    ones, so a recursion ends at names that cover the depth.
    """
    n = len(s)
    if n < 3:
        order = sorted(range(n), key=lambda i: tuple(s[i:]))
        ranks = np.empty(n, np.int64)
        ranks[order] = np.arange(1, n + 1)
        return ranks
    t = np.concatenate([s.astype(np.int64), np.zeros(4, np.int64)])
    ones = np.arange(1, n + (n % 3 == 1), 3)
    twos = np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    # 1. sort the sampled triples and name them
    triples = (t[sample] << 42) | (t[sample + 1] << 21) | t[sample + 2]
    _, names, different = names_of(triples)
    # 2. recurse on the names until they tell all samples apart or reach far enough
    if different < len(sample) and depth > 3:
        names = suffix_ranks(names, -(-depth // 3))
    rank = np.zeros(n + 4, np.int64)
    rank[sample] = names
    # 3. the other suffixes follow from their first symbol and the rank after it, then the three kinds are merged
    zeros = np.arange(0, n, 3)
    wide = rank.max() + 1
    own = t[zeros] * wide + rank[zeros + 1]
    zeros = zeros[np.argsort(own, kind="stable")]
    kept = sample[sample < n]
    kept = kept[np.argsort(rank[kept], kind="stable")]
    first, second = kept[kept % 3 == 1], kept[kept % 3 == 2]
    under_first = np.searchsorted(t[first] * wide + rank[first + 1], t[zeros] * wide + rank[zeros + 1])
    both = np.unique(np.concatenate([(t[second] << 21) | t[second + 1], (t[zeros] << 21) | t[zeros + 1]]))
    pair = lambda at: np.searchsorted(both, (t[at] << 21) | t[at + 1])
    under_second = np.searchsorted(pair(second) * wide + rank[second + 2], pair(zeros) * wide + rank[zeros + 2])
    place = np.arange(len(zeros)) + np.maximum.accumulate(under_first + under_second)
    ranks = np.zeros(n, np.int64)
    free = np.ones(n, bool)
    free[place] = False
    ranks[zeros] = place + 1
    ranks[kept] = np.flatnonzero(free) + 1
    return ranks


def repeated_prefixes(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of the suffixes at ``starts`` share their first ``length`` bytes with another one of them."""
    symbols = text.astype(np.int64) + 1
    order = starts[np.argsort(suffix_ranks(symbols, length)[starts], kind="stable")]
    # adjacent prefixes, eight bytes at a time
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    eight = np.zeros(len(text), np.uint64)
    for k in range(8):
        eight |= padded[k : k + len(text)].astype(np.uint64) << np.uint64(8 * k)
    same = np.arange(len(order) - 1)
    steps = [*range(0, length - 7, 8), length - 8]
    for k in steps:
        same = same[eight[order[same] + k] == eight[order[same + 1] + k]]
        if not len(same):
            break
    return np.unique(np.concatenate([order[same], order[same + 1]]))
