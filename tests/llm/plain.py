"""Plain versions of the operators: one process, no tricks."""

from __future__ import annotations

import hashlib
import re
import struct
from collections import Counter, defaultdict

import xxhash

SPACE = re.compile(r"[\x20\x09-\x0D]")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def exact(docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups[SPACE.sub("", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = []
    for i, t in docs:
        own = groups[SPACE.sub("", t or "")]
        best = min(own)
        out.append((i, best[3], len(own), i == best[3] and -len(t or "") == best[0], sha(SPACE.sub("", t or ""))))
    return out


def hits(docs, items, window=13):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for i, t in items:
        w = word.findall(lower(t))
        for k in range(max(len(w) - window, 0) + 1):
            if w:
                windows[tuple(w[k : k + window])].add(i)
    sizes = {len(w) for w in windows}
    out = []
    for i, t in docs:
        w, hit, found = word.findall(lower(t)), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= {str(x) for x in windows[tuple(w[k : k + n])] if x is not None}
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w)))
    return out


PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(number)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def is_personal(kind: str, value: str) -> bool:
    n = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 14 <= len(n) <= 19 and luhn(n)
    return kind == "email" or 10 <= len(n) <= 15


def personal(docs):
    out = []
    for i, t in docs:
        found = [
            (m.start(), r, m.end(), kind)
            for r, (kind, pattern) in enumerate(PERSONAL.items())
            for m in re.finditer(pattern, t or "")
            if is_personal(kind, m[0])
        ]
        shown = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))
        out.append((i, *(sum(f[3] == k for f in found) for k in PERSONAL), sha(shown)))
    return out


def repeated_bytes(docs, length=400):
    texts = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        runs = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(t), sum(gone), runs, sha(bytes(b for b, g in zip(t, gone, strict=True) if not g))))
    return out


def signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def line_chunks(text):
    lines = (text or "").split("\n")
    h = [signed(xxhash.xxh64_intdigest(x.encode(), 42)) for x in lines]

    def pair(a, b):
        seed = 42
        for v in (a, b):
            seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed)
        return signed(seed)

    r = [None] + [pair(h[k - 1], h[k]) for k in range(1, len(h))]
    begins = [0] + [k for k in range(2, len(lines) - 1) if r[k] < r[k - 1] and r[k] <= r[k + 1]]
    return lines, list(zip(begins, [*begins[1:], len(lines)], strict=True))


def line_units(text):
    """The lines, and the places of all units: chunks of two lines or more, visible neighbours, long lines."""
    lines, spans = line_chunks(text)
    shown = [k for k, x in enumerate(lines) if re.search(r"[^\x00-\x20]", x)]
    units = {(a, b) for a, b in spans if b - a >= 2} | {(a, b + 1) for a, b in zip(shown, shown[1:], strict=False)}
    return lines, units | {(k, k + 1) for k in shown if len(lines[k]) >= 100}


def line_dedup(docs):
    """(id, text left) with rows of one id and text taken as one."""
    groups, cut = defaultdict(set), {}
    for i, t in docs:
        cut[i, t or ""], units = line_units(t)
        for a, b in units:
            piece = "\n".join(cut[i, t or ""][a:b])
            if re.search(r"[^\x00-\x20]", piece):
                key = signed(xxhash.xxh64_intdigest((t or "").encode(), 42))
                groups[piece].add((i is None, i or 0, key, a, b, i, t or ""))
    gone = defaultdict(set)
    for places in groups.values():
        (*_, keeper_end, keeper_id, keeper_text), *others = sorted(places)
        for *_, a, b, i, t in others:
            if (i, t) != (keeper_id, keeper_text) or a >= keeper_end:
                gone[i, t].update(range(a, b))
    return [(i, "\n".join(x for k, x in enumerate(cut[i, t or ""]) if k not in gone[i, t or ""])) for i, t in docs]


def near(docs, width=5, percent=75):
    sets = []
    for _, t in docs:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", lower(t)) if x]
        sets.append({tuple(w[k : k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            by[g].append(k)
    for k, s in enumerate(sets):
        for other, n in Counter(o for g in s for o in by[g] if o < k).items():
            if 100 * n >= percent * (len(s) + len(sets[other]) - n):
                a, b = root(k), root(other)
                parent[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(docs):
        if i is not None:
            least[root(k)].append(i)
    out = []
    for k, (i, _) in enumerate(docs):
        c = i if not sets[k] else min(least[root(k)], default=None)
        out.append((i, len(sets[k]), c, i == c))
    return out
