"""Benchmark decontamination by Wu-Manber multi-pattern search over word windows.

Texts become word strings (ASCII lower case, one space around each word), windows of benchmark
items become patterns in the same form. Patterns of similar length form a searcher: a block shift
table says how far a search position may jump, suffix-hash buckets list the patterns to test where
it may not, and bytes are compared directly. All texts of a slice are searched at once, one numpy
cursor for each stretch of text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsmelt.llm.common import byte_slices, id_and_text, ragged, small_batches, whole_bytes

#: Words of a window.
WINDOW = 13
#: Bytes of windows that are searched for at once; a larger benchmark is searched in blocks.
BLOCK_BYTES = 16 << 20
#: Search positions that start out together in a slice.
LANE_BYTES = 512

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:0x80] = 0x20
_FOLD[0x30:0x3A] = np.arange(0x30, 0x3A)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_SPACE, _END = 0x20, 0xFF  # 0xFF occurs in no UTF-8 text, so no pattern spans two texts

HITS = "doc_id long, row long, n_words long, hit_from array<long>, hit_to array<long>, items array<long>"


def word_string(texts: list[bytes]) -> np.ndarray:
    """Bytes of all texts as ' w1 w2 ... wn ' followed by 0xFF each."""
    raw = _FOLD[np.frombuffer(b" " + b" \xff ".join(texts) + b" \xff", np.uint8)]
    keep = np.empty(len(raw), bool)
    keep[0] = True
    np.logical_or(raw[1:] != _SPACE, raw[:-1] != _SPACE, out=keep[1:])
    return raw[keep]


def words_of(text: bytes) -> list[bytes]:
    return word_string([text])[:-1].tobytes().split()


def windows(items: list[tuple[int, bytes]], size: int = WINDOW) -> dict[bytes, set[int]]:
    """Pattern -> ids of the items that hold it. An item of fewer words is one window."""
    found: dict[bytes, set[int]] = {}
    for item, text in items:
        words = words_of(text)
        for at in range(max(1, len(words) - size + 1) if words else 0):
            found.setdefault(b" " + b" ".join(words[at:at + size]) + b" ", set()).add(item)
    return found


class Searcher:
    """Wu-Manber tables for patterns of at least ``m`` bytes, ``m`` being the shortest."""

    def __init__(self, patterns: list[bytes], ids: np.ndarray):
        self.m = min(map(len, patterns))
        self.block = min(8, self.m)
        blocks = len(patterns) * (self.m - self.block + 1)
        self.bits = min(24, max(16, (8 * blocks).bit_length()))  # chance hits stay rare
        data = np.frombuffer(b"".join(patterns), np.uint8)
        self.lengths = np.array([len(p) for p in patterns])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data, self.ids = data, ids
        reach = self.m - self.block + 1  # blocks in the first m bytes of a pattern
        self.shift = np.full(1 << self.bits, reach, np.int32)
        keys = None
        for at in range(reach):
            keys = self.hash(data, self.starts + at)
            np.minimum.at(self.shift, keys, reach - 1 - at)
        order = np.argsort(keys, kind="stable")  # by the suffix block: the buckets
        self.order = order
        self.bucket = np.searchsorted(keys[order], np.arange((1 << self.bits) + 1))

    def hash(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        value = data[at].astype(np.uint64)
        for k in range(1, self.block):
            value = value << np.uint64(8) | data[at + k]
        return ((value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def candidates(self, text: np.ndarray) -> np.ndarray:
        """Positions whose first m bytes end in the suffix block of some pattern."""
        last = len(text) - self.m
        if last < 0:
            return np.empty(0, np.int64)
        at = np.arange(0, last + 1, LANE_BYTES)
        end = np.minimum(at + LANE_BYTES, last + 1)
        found = []
        while len(at):
            jump = self.shift[self.hash(text, at + self.m - self.block)]
            hit = at[jump == 0]
            if len(hit):
                found.append(hit)
            at = at + np.maximum(jump, 1)
            alive = at < end
            at, end = at[alive], end[alive]
        return np.concatenate(found) if found else np.empty(0, np.int64)

    def search(self, text: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions in ``text`` and numbers of the patterns that start there."""
        spots = self.candidates(text)
        spots = spots[text[spots] == _SPACE]
        for lo in range(0, len(spots), 1 << 16):
            at = spots[lo:lo + (1 << 16)]
            key = self.hash(text, at + self.m - self.block)
            first, size = self.bucket[key], self.bucket[key + 1] - self.bucket[key]
            at = np.repeat(at, size)
            which = self.order[ragged(first, size)]
            fits = at + self.lengths[which] <= len(text)
            at, which = at[fits], which[fits]
            step, width = 0, self.lengths[which]
            live = np.arange(len(at))
            same = np.ones(len(at), bool)
            while len(live):  # direct comparison, eight bytes at a time
                for k in range(step, step + 8):
                    inside = live[width[live] > k]
                    same[inside] &= text[at[inside] + k] == self.data[self.starts[which[inside]] + k]
                step += 8
                live = live[same[live] & (width[live] > step)]
            yield at[same], self.ids[which[same]]


class Decontaminator:
    """Tables for one block of windows: searchers by length class, items of each window."""

    def __init__(self, found: dict[bytes, set[int]]):
        patterns = sorted(found)
        self.items = [sorted(found[p]) for p in patterns]
        self.words = np.array([p.count(b" ") - 1 for p in patterns])
        classes: dict[int, list[int]] = {}
        for at, pattern in enumerate(patterns):  # short windows would spoil the jumps of long ones
            classes.setdefault(min(6, len(pattern).bit_length()), []).append(at)
        self.searchers = [Searcher([patterns[i] for i in ids], np.array(ids))
                          for ids in classes.values()]

    def scan(self, texts: list[bytes]) -> list[tuple[int, list[int], list[int], list[int]]]:
        """For each text its number of words, hit word ranges (merged) and items found."""
        text = word_string(texts)
        ends = np.flatnonzero(text == _END)
        spaces = np.concatenate([[0], np.cumsum(text == _SPACE)])
        first = np.concatenate([[0], ends[:-1] + 1])
        n_words = spaces[ends] - spaces[first] - 1  # n words stand between n + 1 spaces
        places, which = [], []
        for searcher in self.searchers:
            for at, ids in searcher.search(text):
                places.append(at)
                which.append(ids)
        out = [(int(n), [], [], []) for n in n_words]
        if not places or not sum(map(len, places)):
            return out
        at, ids = np.concatenate(places), np.concatenate(which)
        order = np.argsort(at, kind="stable")
        at, ids = at[order], ids[order]
        doc = np.searchsorted(ends, at)
        begin = spaces[at] - spaces[first[doc]]
        end = begin + self.words[ids]
        for lo, hi in zip(*_runs(doc)):
            _, frm, to, items = out[doc[lo]]
            reach = np.maximum.accumulate(end[lo:hi])
            gap = np.append(True, begin[lo + 1:hi] > reach[:-1])
            frm += begin[lo:hi][gap].tolist()
            to += reach[np.append(np.flatnonzero(gap)[1:] - 1, hi - lo - 1)].tolist()
            items += sorted({i for w in set(ids[lo:hi].tolist()) for i in self.items[w]})
        return out


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(values)) + 1
    return np.concatenate([[0], edge]), np.append(edge, len(values))


def _blocks(benchmark: DataFrame, size: int, limit: int) -> Iterator[dict[bytes, set[int]]]:
    """Windows of the items, in blocks of about ``limit`` bytes, one block at a time on the driver."""
    items, weight, some = [], 0, False
    for row in benchmark.toLocalIterator():
        text = (row["text"] or "").encode()
        items.append((row["doc_id"], text))
        weight += len(text) * size
        if weight > limit:
            yield windows(items, size)
            items, weight, some = [], 0, True
    if items or not some:
        yield windows(items, size)


def find_passages(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  item_col: str = "item_id", text_col: str = "text", size: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, n_words, n_hit, spans, items`` for every document, and the columns ``keep`` of its row.

    A word is a run of ASCII digits and letters (case folded) and non-ASCII characters. A word is
    hit if it lies inside an occurrence of a window of ``size`` consecutive words of an item, or
    of a whole item of fewer words. ``spans`` are maximal hit ranges ``[from, to)`` of words.
    A null or empty text has no words and no hits; an item without words or with a null id is
    never found. Every row of ``docs`` gives one row, repeated ones too.

    The benchmark is the stated query set: its windows are sent to the tasks in blocks of at most
    ``block_bytes`` (or one item), and documents are scanned once for each block, without a shuffle
    as long as there is one block.
    """
    kept = [f"kept_{k}" for k in range(len(keep))]
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
        *[F.col(c).alias(name) for c, name in zip(keep, kept) if c != text_col]).withColumn(
        "row", F.monotonically_increasing_id())
    held = ["text" if c == text_col else name for c, name in zip(keep, kept)]  # the text goes to a task once
    schema = ", ".join([HITS, *[f"{name} {source.schema[of].dataType.simpleString()}" for name, of in zip(kept, held)]])
    queries = id_and_text(benchmark, item_col, text_col).filter("doc_id IS NOT NULL")
    spark = docs.sparkSession
    parts = []
    for found in _blocks(queries, size, block_bytes):
        tables = spark.sparkContext.broadcast(found)

        def run(batches, tables=tables):
            engine = Decontaminator(tables.value) if tables.value else None
            for batch in small_batches(batches):
                texts = whole_bytes(batch.column("text"))
                rows = []
                for a, b in byte_slices(texts):
                    rows += (engine.scan(texts[a:b]) if engine else
                             [(len(words_of(t)), [], [], []) for t in texts[a:b]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("row"),
                     pa.array([r[0] for r in rows], pa.int64()),
                     *[pa.array([r[k] for r in rows], pa.list_(pa.int64())) for k in (1, 2, 3)],
                     *[batch.column(of) for of in held]],
                    names=["doc_id", "row", "n_words", "hit_from", "hit_to", "items", *kept])

        parts.append(source.mapInArrow(run, schema))
    merged = parts[0]
    if len(parts) > 1:  # a row has one entry for each block: as many as there are blocks
        for other in parts[1:]:
            merged = merged.unionByName(other)
        merged = merged.groupBy("doc_id", "row").agg(
            F.max("n_words").alias("n_words"),
            F.flatten(F.collect_list("hit_from")).alias("hit_from"),
            F.flatten(F.collect_list("hit_to")).alias("hit_to"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            *[F.first(name).alias(name) for name in kept])
    spans = F.arrays_zip(F.col("hit_from").alias("begin"), F.col("hit_to").alias("end"))
    if len(parts) > 1:
        spans = _merged(F.array_sort(spans))
    return merged.select(
        "doc_id", "n_words",
        F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"]).alias("n_hit"),
        spans.alias("spans"), "items", *[F.col(name).alias(c) for name, c in zip(kept, keep)])


def _merged(spans):
    """Sorted spans without overlaps: a span gives what lies beyond all before it."""
    kind = "struct<reach:bigint,out:array<struct<begin:bigint,end:bigint>>>"
    start = F.lit(None).cast("bigint")

    def add(state, span):
        begin = F.greatest(span["begin"], F.coalesce(state["reach"], F.lit(-1)))
        return F.struct(
            F.greatest(F.coalesce(state["reach"], F.lit(-1)), span["end"]).alias("reach"),
            F.when(begin < span["end"], F.concat(state["out"], F.array(
                F.struct(begin.alias("begin"), span["end"].alias("end")))))
            .otherwise(state["out"]).alias("out"))

    empty = F.struct(start.alias("reach"), F.array().alias("out")).cast(kind)
    return F.aggregate(spans, empty, add, lambda state: state["out"])


def contaminated(passages: DataFrame) -> DataFrame:
    """``contaminated``: a word is hit, and at least one word in twenty."""
    return passages.withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))


def digest(passages: DataFrame) -> DataFrame:
    """Counts and the SHA-256 of the found ids, sorted as strings and joined by commas."""
    names = F.array_sort(F.transform("items", lambda item: item.cast("string")))
    return contaminated(passages).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), "contaminated")


SQL = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark),
sized AS (SELECT *, least(len(w), {WINDOW}) AS size FROM items WHERE len(w) > 0),
spots AS (SELECT item_id, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM sized),
patterns AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS p FROM spots),
sizes AS (SELECT DISTINCT size FROM patterns),
places AS (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM words, sizes WHERE len(w) >= size),
found AS (SELECT doc_id, item_id, i, size FROM
          (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS p FROM places) JOIN patterns USING (size, p)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
