"""Every stage of the pipeline against plain Python: which documents stay, and with which texts."""

from __future__ import annotations

import math
import re
import sys
import zlib
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from starsmelt.llm import quality_classifier  # noqa: E402
from starsmelt.llm.queries import tokenizer_file  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\x0c\r"


def score(text, model):
    """Mean weight of words, byte 3- to 5-grams of marked words, and pairs of neighbours."""
    bucket = lambda x: (x * 0x9E3779B97F4A7C15 % (1 << 64)) >> (64 - model.bits)
    words = brute.WORD.findall((text or "").encode())
    found = [bucket(zlib.crc32(w) + (1 << 56)) for w in words]
    for w in words:
        marked = b"\x02" + w + b"\x03"
        found += [bucket(int.from_bytes(marked[k:k + n], "little") + (n << 57))
                  for n in (3, 4, 5) for k in range(len(marked) - n + 1)]
    found += [bucket(zlib.crc32(a) ^ zlib.crc32(b)) for a, b in zip(words, words[1:])]
    logit = sum(float(model.weights[x]) for x in found) / max(1, len(found)) + model.bias
    return 1 / (1 + math.exp(-logit))


def without_repeated_lines(docs):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANKS))
    first = {}
    for doc, row in docs.items():
        for k in {key(x) for x in (row[0] or "").split("\n")}:
            first[k] = min(doc, first.get(k, doc))
    out = {}
    for doc, row in docs.items():
        lines = [x for x in (row[0] or "").split("\n") if len(key(x)) < 10 or first[key(x)] == doc]
        text = "\n".join(lines)
        out[doc] = (text, *row[1:-1], len(text))
    return out


def without_near_copies(docs):
    groups = brute.near_duplicates([(doc, row[0]) for doc, row in docs.items()], 5, 80)
    return {doc: row for doc, row in docs.items() if groups[doc][1] == doc}


def without_benchmark(docs, items):
    cut = lambda text: re.findall("[0-9a-zA-Z\x80-\U0010ffff]+", text or "")
    fold = lambda text: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in cut(text)]
    patterns = set()
    for words in map(fold, items):
        size = min(13, len(words))
        patterns |= {tuple(words[k:k + size]) for k in range(len(words) - size + 1)} if size else set()
    sizes = {len(p) for p in patterns}
    out = {}
    for doc, row in docs.items():
        words = fold(row[0])
        hit = {j for n in sizes for k in range(len(words) - n + 1)
               if tuple(words[k:k + n]) in patterns for j in range(k, k + n)}
        if not hit or 20 * len(hit) < len(words):
            out[doc] = row
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The small fixture with near copies, in one line each, and texts that hold benchmark items."""
    path = str(tmp_path_factory.mktemp("corpus"))
    docs, labels, items = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    top = docs.agg({"doc_id": "max"}).first()[0]
    some = docs.filter("length(text) > 1500").orderBy("doc_id").limit(12).collect()
    held = [r["text"] for r in items.orderBy("item_id").limit(4).collect()]
    added = []
    for k, r in enumerate(some):
        words = r["text"].split()
        words = words[:-1] + ["changed"] if k < 8 else words[:60 + k] + held[k - 8].split()
        text = " ".join(words)
        added.append((top + 1 + k, text, r["lang"], r["source"], len(text)))
    more = spark.createDataFrame(added, "doc_id long, text string, lang string, source string, n_chars long")
    docs.select(*corpus_pipeline.COLUMNS).unionByName(more).write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    items.write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def expected(spark, folder):
    """The documents that each stage leaves, each made from those of the stage before."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = quality_classifier.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    items = [r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    whole = kept(docs)
    good = {doc: row for doc, row in whole.items() if score(row[0], model) >= 0.5}
    lines = without_repeated_lines(good)
    single = without_near_copies(lines)
    clean = without_benchmark(single, items)
    assert len(whole) > len(good) == len(lines) > len(single) > len(clean) > 0 and good != lines
    return [good, lines, single, clean]


def kept(df):
    rows = [tuple(r) for r in df.select(*corpus_pipeline.COLUMNS).collect()]
    found = {r[0]: r[1:] for r in rows}
    assert len(found) == len(rows)
    return found


def test_every_stage_keeps_what_it_should(spark, folder, expected):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for (name, step), wanted in zip(corpus_pipeline.STAGES, expected):
        docs = corpus_pipeline.stage(step(spark, docs, folder), "tested")
        assert kept(docs) == wanted, name


def test_run_packs_every_clean_document(spark, folder, expected):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    rows = corpus_pipeline.run(spark, folder).collect()
    wanted = brute.pieces([(doc, row[0]) for doc, row in expected[-1].items()], Tokenizer.from_file(path))
    assert {(r["doc_id"], r["start"]): (r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows} == wanted
    assert len(rows) == len(wanted)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spots in sequences.values():
        ends = [0]
        for offset, length in sorted(spots):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 2048
