"""Terms that give personal data away, against plain counts over whole documents."""

import math
import random
import re
from collections import Counter

from tests.conftest import SF_DIR
from tests.llm import plain
from tests.llm.awkward import documents
from ticketlake.llm import pii
from ticketlake.llm.common import table

WORD = re.compile(r"[^\W\d_]\w+")


def expected(docs, support=3, generalise=0.8):
    """By text: places of the terms, from every pair of an entity and a word of one document."""
    words, entities, texts = [], [], []
    for _, t in docs:
        t = t or ""
        spans = [(m.start(), m.end(), kind, m[0]) for kind, p in plain.PERSONAL.items() for m in re.finditer(p, t) if plain.is_personal(kind, m[0])]
        for a, b, _, _ in spans:
            t = t[:a] + " " * (b - a) + t[b:]
        texts.append(t)
        words.append({w.lower() for w in WORD.findall(t)})
        entities.append({(k, v.lower() if k in ("email", "ip") else re.sub("[^0-9]", "", v)) for _, _, k, v in spans})
    n, n_term, n_entity = len(docs), Counter(w for x in words for w in x), Counter(e for x in entities for e in x)
    both, seen = Counter(), {}
    for (_, t), own, there in zip(docs, words, entities, strict=True):
        for e in there:
            for w in own:
                both[e, w] += 1
                seen.setdefault((e, w), set()).add(t)
    telling = {
        w
        for (e, w), k in both.items()
        if len(seen[e, w]) >= support
        and n_entity[e] < n
        and math.log2(n * k / (n_term[w] * n_entity[e])) / math.log2(n / n_entity[e]) >= generalise - 1e-12
    }
    return {i: [(m.start(), m.end()) for m in WORD.finditer(t) if m[0].lower() in telling] for (i, _), t in zip(docs, texts, strict=True)}


def found(df, **more):
    rows = pii.personal_data(df, **more).collect()
    return {r["doc_id"]: [(s["start"], s["after"]) for s in r["spans"] if s["kind"] == "term"] for r in rows}


def test_names_far_from_the_mention_and_in_texts_without_it(spark):
    rng = random.Random(2)
    filler = lambda n: " ".join(f"word{rng.randint(0, 9)}x" for _ in range(n))
    docs = [(k, f"Zebrafish {filler(300)} jo@x.org {filler(300)} zebrafish") for k in range(5)]
    docs += [(k, f"{filler(40 + k)}") for k in range(10, 90)] + [(99, f"{filler(30)} Zebrafish alone")]
    out = found(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    for i, t in docs:
        assert out[i] == [(m.start(), m.end()) for m in re.finditer("zebrafish", t.lower())], i
    assert out[0] and out[99]


def test_small_table_equals_plain_counts(spark):
    docs = documents()
    for support in (1, 3):
        assert found(table(spark, SF_DIR, "documents"), support=support) == expected(docs, support)
    assert any(expected(docs, 1).values())


def test_long_text_with_many_terms(spark):
    names = [f"name{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(300)]
    docs = [(k, " ".join(names * 7) + f" {k} jo@x.org über10.0.0.1 é😀 " + " ".join(names)) for k in range(3)]
    docs += [(k, f"nothing here {k}") for k in range(10, 40)]
    assert found(spark.createDataFrame(docs, "doc_id long, text string")) == expected(docs)


def test_places_of_many_matches(spark):
    """Places are right across blocks, and 5,000 addresses in one text take no longer than their length asks for."""
    texts = {n: " ".join(f"é user{k}@mail{k % 7}.org" for k in range(n)) for n in (1, 63, 64, 65, 129, 5000)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in pii.base_spans(df, "doc_id", "text").collect():
        t = texts[r["id"]]
        expected = [(m.start(), m.end(), m[0]) for m in re.finditer(plain.PERSONAL["email"], t)]
        assert [(s["start"], s["after"], s["value"]) for s in r["spans"]] == expected and len(expected) == r["id"]
