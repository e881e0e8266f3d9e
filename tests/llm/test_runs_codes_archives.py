"""Periodic runs, vector codes and web archives against plain Python."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from starsmelt.llm import periodic_runs, vector_codes, warc  # noqa: E402
from starsmelt.llm.queries import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def brute_runs(words):
    """Every period, every place: maximal stretches, each under the first period that gives it."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and j > i:
                found.setdefault((i, j + q), q)
            i = max(i + 1, j)
    return sorted((a, e - a, q) for (a, e), q in found.items())


def brute_digest(doc, text, planted=True):
    words = brute.WORD.findall((text or "").encode())
    h, n = (zlib.crc32(str(doc).encode()), len(words)) if doc is not None else (1, 0)
    if planted and n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    return (doc, len(runs), *top, runs and 1000 * top[1] // top[2] or None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_of_the_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("length(text) < 30000").select("doc_id", "text")
    assert docs.count() > 190
    found = periodic_runs.digest(periodic_runs.find_runs(periodic_runs.plant_runs(docs))).collect()
    expected = [brute_digest(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, found)) == sorted(expected)
    assert sum(1 for r in expected if r[1]) >= 10
    whole = QUERIES["op11_runs"](spark, FOLDER).collect()
    assert set(map(tuple, found)) <= set(map(tuple, whole)) and len(whole) == 200


def test_runs_of_odd_texts(spark):
    texts = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "A a A a A a A a", "x " + "p q r " * 4 + "y",
             "p q r " * 4 + "p", "é ü " * 9 + "\x1c\x85 " * 7, "be " * 9000, "one two\x0b" * 5000 + "one",
             " ".join(f"w{k % 700}" for k in range(2900)), "a a a a a a b a a a a a a b " * 5]
    rows = [(k, t, 3, "z", k) for k, t in enumerate(texts)] + [(None, "c d " * 8, 0, "", 0)] * 2 + [(3, "e " * 6, 0, "", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, runs string, h long")
    found = [tuple(r) for r in periodic_runs.digest(periodic_runs.find_runs(df)).collect()]
    expected = [brute_digest(r[0], r[1], False) if r[0] is not None else (None, *brute_digest(10, r[1], False)[1:])
                for r in rows]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    planted = periodic_runs.plant_runs(df).collect()
    assert len(planted) == len(rows) and [r["text"] for r in planted if r["doc_id"] is None] == ["c d " * 8] * 2
    for step in (periodic_runs.find_runs, periodic_runs.plant_runs):
        assert not step(df.limit(0)).collect()
    assert not periodic_runs.digest(periodic_runs.find_runs(df.limit(0))).collect()


@pytest.mark.parametrize("block", [1 << 12, 4, 1])
def test_runs_at_every_scale(block, monkeypatch):
    monkeypatch.setattr(periodic_runs, "BLOCK", block)
    rng = random.Random(5)
    for _ in range(60):
        texts = []
        for _ in range(rng.randint(1, 6)):
            n, k = rng.choice([0, 1, 5, 7, 30, 100, 300]), rng.choice([1, 2, 3, 50])
            w = [b"%d" % rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.5:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randint(3, 10)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            texts.append(w)
        assert periodic_runs.runs_of(texts) == [brute_runs(w) for w in texts]


def test_transform_is_exact():
    rng = np.random.default_rng(2)
    for size in (2, 8, 64):
        rows = rng.integers(0, periodic_runs.PRIME, (5, size)).astype(np.uint64)
        assert (periodic_runs.inverse(periodic_runs.transform(rows)) == rows).all()
    blocks, windows = rng.integers(0, 2, (40, 4)), rng.integers(0, 2, (40, 8))
    row, shift = periodic_runs.zero_mismatches(blocks, windows)
    expected = [(r, s) for r in range(40) for s in range(4) if (blocks[r] == windows[r, s:s + 4]).all()]
    assert list(zip(row.tolist(), shift.tolist())) == expected


def brute_codes(rows):
    """``vec_id, code, error, label_error`` of every row with a whole vector, and the entries."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1]) // 4
    cut = lambda v, k: v[k * size:(k + 1) * size]
    books = [[cut(v, k) for _, v, _ in kept[:256]] for k in range(4)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), at) for at, e in enumerate(book))

    for _ in range(4):
        for k in range(4):
            of = {}
            for _, v, _ in kept:
                of.setdefault(nearest(cut(v, k), books[k])[1], []).append(cut(v, k))
            books[k] = [[sum(c) // len(of[e]) for c in zip(*of[e])] if e in of else old
                        for e, old in enumerate(books[k])]
    out, sums = [], {}
    for i, v, label in kept:
        best = [nearest(cut(v, k), books[k]) for k in range(4)]
        error = sum(b[0] for b in best)
        sums[label] = sums.get(label, 0) + error
        out.append([i, "".join(f"{b[1]:02x}" for b in best), error, label])
    text = ",".join(str(x) for book in books for e in book for x in e)
    return sorted(((i, c, e, sums[label], hashlib.sha256(text.encode()).hexdigest()) for i, c, e, label in out), key=repr)


def test_codes_of_odd_vectors(spark):
    rng = random.Random(7)
    rows = [(k, [round(rng.gauss(0, 0.2), 2) for _ in range(8)], rng.choice([0, 1, None])) for k in range(330)]
    rows += [(400 + k, [0.25] * 8, 1) for k in range(40)] + [(5, rows[5][1], 0), (5, [0.5] * 8, None), (None, [-0.5] * 8, 2)]
    rows += [(500, None, 1), (501, [0.1] * 7 + [None], 1), (502, [float("nan")] + [0.0] * 7, None),
             (503, [float("-inf")] * 8, 3)]
    clash = [(*r, "x", 1, 2) for r in rows]
    df = spark.createDataFrame(clash, "vec_id long, embedding array<double>, label int, v string, of int, error int")
    found = vector_codes.digest(vector_codes.compress(df.repartition(5)))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_codes(rows)
    few = df.filter("vec_id < 3 OR vec_id IS NULL")
    found = vector_codes.digest(vector_codes.compress(few)).collect()
    expected = brute_codes([r for r in rows if r[0] is None or r[0] < 3])
    assert sorted((tuple(r) for r in found), key=repr) == expected
    assert not vector_codes.digest(vector_codes.compress(df.limit(0))).collect()
    for bad in ([0.5] * 6, [0.5] * 4, [1e30] + [0.0] * 7):
        more = spark.createDataFrame([(900, bad, 1)], "vec_id long, embedding array<double>, label int")
        with pytest.raises(Exception, match="component"):
            vector_codes.compress(df.select("vec_id", "embedding", "label").union(more)).rows.collect()


def test_nearest_entry_is_exact():
    rng = np.random.default_rng(4)
    for size, dims, wide in ((256, 16, 50), (1, 3, 5), (65, 2, 3), (200, 1, 1 << 28)):
        entries, x = rng.integers(-wide, wide, (size, dims)), rng.integers(-wide, wide, (3000, dims))
        index, error = vector_codes.Codebook(entries).nearest(x)
        far = ((x[:, None] - entries) ** 2).sum(axis=2)
        assert (index == far.argmin(axis=1)).all() and (error == far.min(axis=1)).all()


PAGES = [
    (4, "http://www.b.org:80/x?b=2&a=1#top", "same page"), (2, "https://a.org/", "same page"),
    (9, "http://a.org/", "same page"), (9, "http://a.org/", "same page"), (2, "https://a.org/", "same page"),
    (None, "http://a.org/", "same page"), (5, None, None), (6, "", ""), (7, "not a url\r\nX: y", "é<p>\r\n\r\nWARC/1.0\r\n"),
    (8, "http://[bad/", "x" * 300_000), (None, None, "alone"), (None, None, "alone"), (11, "http://a.org/", "later"),
]


def brute_archives(rows, least=0):
    texts = [(h or "").encode() for _, _, h in rows]
    out = []
    for (page, _, _), text in zip(rows, texts):
        ids = [p for (p, _, _), t in zip(rows, texts) if t == text and p is not None]
        first = min(ids) if ids and len(text) >= least else page
        digest = base64.b32encode(hashlib.sha1(text).digest()).decode()
        same = page == first
        out.append((page, len(text), digest, "response" if same else "revisit", None if same else first))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*r, "clash", 1, b"z") for r in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string, first int, key binary")


@pytest.mark.parametrize("least, size", [(0, 8 << 20), (10, 400), (0, 1)])
def test_archives_read_back(spark, pages, least, size):
    folder = warc.write_archives(pages.repartition(3), least=least, archive_bytes=size)
    captures = warc.read_captures(spark, folder)
    index = warc.merge_index(captures, rows_per_range=3)
    assert sorted((tuple(r) for r in warc.digest(index).collect()), key=repr) == brute_archives(PAGES, least)
    rows = index.orderBy("range", "position").collect()
    order = [(r["urlkey"], r["timestamp"], r["page_id"] is None, r["page_id"] or 0, r["archive"], r["offset"])
             for r in rows]
    assert order == sorted(order) and len(set(order)) == len(PAGES)
    assert len({r["range"] for r in rows}) > 1
    texts = {(p, (h or "").encode()) for p, _, h in PAGES}
    back = {(r["page_id"], bytes(r["payload"])) for r in warc.read_payloads(spark, folder).collect()}
    assert back <= texts and {t for _, t in back} == {t for _, t in texts}


def test_archives_are_plain_gzip(spark, pages):
    folder = warc.write_archives(pages.coalesce(1))
    for file in Path(folder.removeprefix("file://").removeprefix("file:")).glob("part-*"):
        raw = file.read_bytes()
        whole = gzip.decompress(raw)
        assert whole == b"".join(content for _, _, content in warc.members(raw))
        assert whole.count(b"WARC-Type: ") == len(PAGES)
    damaged = raw[:-30]
    with pytest.raises(ValueError, match="cut off"):
        list(warc.members(damaged))


def test_times_make_histories(spark):
    rows = [(k, "http://A.org/p", f"text {k}", f"2020-01-{20 - k:02d}T00:00:00Z") for k in range(10)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, at string")
    index = warc.merge_index(warc.read_captures(spark, warc.write_archives(df, time_col="at", archive_bytes=700)), 4)
    found = index.orderBy("range", "position").collect()
    assert [r["page_id"] for r in found] == list(range(9, -1, -1))
    assert found[0]["timestamp"] == "20200111000000" and found[0]["urlkey"] == "org,a)/p"


def test_no_pages(spark, pages):
    folder = warc.write_archives(pages.limit(0))
    assert not warc.digest(warc.merge_index(warc.read_captures(spark, folder))).collect()


def test_loser_tree():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 7, 20):
        runs = [sorted(rng.randrange(30) for _ in range(rng.randrange(9))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_url_keys():
    assert warc.url_key("http://www.B.org:80/x?b=2&a=1#top") == "org,b)/x?a=1&b=2"
    assert warc.url_key("https://b.org:8443") == "org,b:8443)/"
    assert warc.url_key(None) == "" and warc.url_key("Plain Text") == "plain text"
    assert warc.url_key("http://[bad/") == "http://[bad/"
