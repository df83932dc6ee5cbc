"""Packing against the tokenizer and its bounds; archives by a round trip."""

import gzip
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from tests.llm.awkward import awkward, documents, empty, rows
from tests.oracle_check import compare, connect
from ticketlake.llm import packing, warc
from ticketlake.llm.common import table, tokenizer_path
from ticketlake.session import scratch_dir

TOKENIZER = Tokenizer.from_file(tokenizer_path())
SPECIAL = [(900, "a<|endoftext|>b <|startoftext|>"), (901, "It's WE'LL don't 'tis x'sy!!'s"), (902, "½ ²3 \x1c \x85 \xa0 İ Σίσυφος ﬁ é"), (903, "日本語 😀")]


def ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


def check(docs, out, capacity):
    pieces = defaultdict(list)
    for r in out:
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    expected = defaultdict(list)
    for i, t in docs:
        own = ids(t)
        for p, at in enumerate(range(0, len(own), capacity)):
            part = own[at : at + capacity]
            expected[i].append((p, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in expected.items()}
    bins = defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


def test_pieces_of_the_small_table(spark):
    docs = documents()
    out = packing.best_fit_packing(table(spark, SF_DIR, "documents"), tokenizer_path()).collect()
    used = check(docs, out, 4096)
    total = sum(r["length"] for r in out)
    assert used <= best_fit_decreasing([r["length"] for r in out], 4096) <= -(-total // 4096) + 2


@pytest.mark.parametrize("clash", [False, True])
def test_awkward_texts(spark, clash):
    docs = [(r[0], r[1]) for r in rows()] + SPECIAL
    more = spark.createDataFrame([(i, t, None, None, 0) for i, t in SPECIAL], awkward(spark).schema)
    df = awkward(spark).union(more)
    if clash:
        from tests.llm.awkward import clashing

        df = clashing(df)
    out = packing.best_fit_packing(df, tokenizer_path(), capacity=512, with_ids=True).collect()
    check(docs, out, 512)
    assert all(len(r["ids"]) == r["length"] for r in out)
    assert packing.best_fit_packing(empty(spark), tokenizer_path()).isEmpty()


@pytest.mark.parametrize("seed", range(40))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(5, 60))
    lengths = rng.integers(1, capacity + 1, rng.integers(1, 200)).tolist()
    counts = Counter(lengths)
    runs = packing.packing_plan(dict(counts), capacity)
    seen = defaultdict(set)
    bins = defaultdict(list)
    for n, rank, pieces, first, each, offset in runs.tolist():
        for k in range(pieces):
            assert rank + k not in seen[n]
            seen[n].add(rank + k)
            bins[first + k // each].append((offset + k % each * n, n))
    assert {n: len(s) for n, s in seen.items()} == dict(counts)
    for held in bins.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= capacity
        assert sum(3 * n > capacity for _, n in held) <= 2
    assert len(bins) <= best_fit_decreasing(lengths, capacity)


def test_a_larger_plan_is_as_good_as_best_fit():
    rng = np.random.default_rng(5)
    lengths = np.clip(rng.lognormal(6, 1, 4000), 1, 4096).astype(int).tolist()
    runs = packing.packing_plan(dict(Counter(lengths)), 4096)
    used = {b for _, _, pieces, first, each, _ in runs.tolist() for b in range(first, first + -(-pieces // each))}
    assert len(used) <= best_fit_decreasing(lengths, 4096)


HTML = "<html>" + "some page " * 30 + "</html>"
PAGES = [(1, "http://a", HTML), (2, "http://b\r\nX: y", HTML), (3, None, "short"), (4, "é", "short"), (5, "u", None), (6, "u", ""), (7, "v", HTML + "!"), (None, "w", HTML), (None, "w", "only without id " * 20), (8, "x", HTML), (8, "x", HTML), (9, "y", "x" * 300_000), (9, "y", "x" * 300_000)]


def pages(spark, some=PAGES):
    from tests.llm.awkward import clashing

    return clashing(spark.createDataFrame(some, "page_id long, url string, html string")).repartition(3)


def test_round_trip(spark):
    folder = scratch_dir(spark, "warc")
    warc.write_pages(pages(spark), folder)
    out = warc.read_pages(spark, folder).collect()
    first = {}
    for i, _, html in PAGES:
        if i is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, i), i)
    expected = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        again = html in first and first[html] != i
        expected.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[html] if again else None))
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    whole = {r["payload_digest"]: bytes(r["payload"]) for r in out if r["payload"] is not None}
    assert set(whole) == {e[2] for e in expected}
    assert all(hashlib.sha256(v).hexdigest() == k for k, v in whole.items())


def test_files_are_ordinary_gzip_and_filters_are_pushed_down(spark):
    folder = scratch_dir(spark, "warc")
    warc.write_pages(pages(spark), folder)
    fs, root = warc.file_system(folder)
    from pyarrow.fs import FileSelector

    texts = [gzip.open(fs.open_input_stream(f.path, compression=None)).read() for f in fs.get_file_info(FileSelector(root)) if f.path.endswith(".gz")]
    assert sum(t.count(b"WARC/1.1\r\n") for t in texts) == len(PAGES) + len(texts)
    one = spark.read.format("warc").load(folder).where("record_type = 'revisit' and target_uri = 'x'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "Scan" in plan and not re.search(r"\bFilter\b", plan)  # the source has taken both
    assert one.count() == 2 and one.select("payload").distinct().collect()[0][0] in (None, b"")
    assert spark.read.format("warc").load(folder).where("record_type in ('warcinfo')").count() == len(texts)


@pytest.mark.parametrize("packed", [False, True])
def test_archives_of_other_writers(spark, tmp_path, packed):
    """Without a manifest, plain or in members that do not tell their length."""
    records = []
    for k, kind in enumerate(["warcinfo", "response", "request", "response"]):
        block = b"HTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\nhell%d" % k if kind == "response" else b"x" * 9000
        media = b"application/http; msgtype=response" if kind == "response" else b"text/plain"
        records.append(
            b"WARC/1.0\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:%d>\r\nContent-Type: %s\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
            % (kind.encode(), k, media, len(block), block)
        )
    name = "a.warc.gz" if packed else "a.warc"
    (tmp_path / name).write_bytes(b"".join(gzip.compress(r) if packed else r for r in records))
    warc.use(spark)
    df = spark.read.format("warc").load(str(tmp_path))
    assert sorted(r["record_id"] for r in df.collect()) == [f"urn:{k}" for k in range(4)]
    kept = df.where("record_type = 'response'").collect()
    assert sorted(bytes(r["payload"]) for r in kept) == [b"hell1", b"hell3"]
    bare = spark.read.format("warc").option("payload", "false").load(str(tmp_path)).where("record_type = 'response'")
    assert [(r["payload"], r["payload_length"]) for r in bare.collect()] == [(None, 5)] * 2


def test_large_files_are_split(spark, monkeypatch):
    monkeypatch.setattr(warc, "SPLIT_BYTES", 300)
    folder = scratch_dir(spark, "warc")
    some = [(k, f"u{k}", f"page {k} " * 40) for k in range(30)]
    warc.write_pages(spark.createDataFrame(some, "page_id long, url string, html string").coalesce(1), folder)
    assert sorted(r["page_id"] for r in warc.read_pages(spark, folder).collect()) == list(range(30))
    assert spark.read.format("warc").load(folder).rdd.getNumPartitions() > 3


def test_no_pages(spark):
    folder = scratch_dir(spark, "warc")
    warc.write_pages(pages(spark).where("false"), folder)
    assert warc.read_pages(spark, folder).isEmpty()


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op8_warc"])
def test_queries_agree_with_sql(spark, name):
    assert compare(entry.queries()[name](spark, SF_DIR), connect(SF_DIR), entry.oracle_sql()[name]) is None


def test_new_words_are_encoded_together():
    """Many words go to the tokenizer as one text; a word's ids are the same as alone, also if ends of words cannot be told."""
    signs = ["'s", "'", "''", "'ll", "½", "²", "3", "<", "|>", "</w>", "...", "\x00", "é", "œuvre", "ÿ", "ß", "¿qué?", "a\x1cb"]
    spelled = lambda k: "wö" + "".join(chr(97 + k // 26**j % 26) for j in range(3))
    made = [" ".join(f"{spelled(k)} it's-{k}" for k in range(low, low + 400)) for low in range(0, 4000, 400)]
    texts = [*signs, "".join(signs[:9]), "", " ", *made, made[0]]
    expected = [np.array(TOKENIZER.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]

    class Counted:
        given = 0

        def encode_batch_fast(self, texts, add_special_tokens):
            self.given += len(texts)
            return TOKENIZER.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    for told in (True, False):
        words = packing.WordIds(tokenizer_path())
        words.tokenizer = Counted()
        words.closes &= told
        assert words.encode(texts) == expected
        n = len(words.known)
        assert n > 3000 and (words.tokenizer.given < n / 50) == told
        before = words.tokenizer.given
        assert words.encode(texts) == expected and words.tokenizer.given - before < len(texts)


def test_full_cache_keeps_the_words_of_the_batch(monkeypatch):
    """Words met lately move to the older cache while a batch still uses them."""
    monkeypatch.setattr(packing, "CACHED_WORDS", 5)
    words = packing.WordIds(tokenizer_path())
    texts = ["a b c d e f g h", "a b new words here and there", "f g a other new words", "x y z here again a"]
    for _ in range(2):
        for t in texts:
            assert words.encode([t, t]) == [np.array(TOKENIZER.encode(t, add_special_tokens=False).ids, "<u4").tobytes()] * 2
    assert words.older
