"""Exact substring de-duplication with a run-length index of the passages that may repeat.

A string of ``length`` bytes that starts at two places is removed at both. The corpus is cut by
content: in every window of ``length`` bytes the k-gram with the smallest hash, the leftmost of
equals, is its anchor, so equal windows have their anchor at the same place within them. Windows in
a row with one anchor form a passage. Only passages whose anchor k-gram occurs again go on, each
distinct one once with its number of occurrences, to the blocks of an index, all passages of an
anchor in one block:

* the windows of a block are sorted, and the bytes before them are its Burrows-Wheeler transform,
  kept as one byte for each window; equal passages only make runs longer, so they are one entry with
  a weight;
* at the run ends the longest match with the neighbour is measured by comparing bytes;
* elsewhere it is streamed along the passage: one byte on, a match is one byte shorter. Where that
  falls below the length that counts, bytes are compared again.

A window whose matching statistic reaches ``length``, or of a passage with more than one
occurrence, starts at another place too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsmelt.llm.common import (
    bucketed,
    byte_slices,
    id_and_text,
    ragged,
    small_batches,
    stage,
    whole_bytes,
)

LENGTH = 200
GRAM = 64
#: Bytes of text that are hashed at once, bytes of passages that are indexed at once.
SLICE_BYTES, BLOCK_BYTES = 1 << 20, 4 << 20
#: Distinct passages of one anchor that go to one block. Windows of an anchor with more are grouped
#: by their bytes instead.
HOT = 20_000
#: The key of a row, in two columns.
ROW, ROW_TYPES = ["k1", "k2"], "k1 long, k2 long"
_MUL = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << 24) - 1)


def _gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes (a power of two) from each position on."""
    value = (raw.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    width = 1
    while width < size:
        value = value[:len(value) - width] * _MUL + value[width:]
        value ^= value >> np.uint64(29)
        width *= 2
    return value


def _sliding_min(values: np.ndarray, span: int) -> np.ndarray:
    width = 1
    while 2 * width <= span:
        values = np.minimum(values[:len(values) - width], values[width:])
        width *= 2
    rest = span - width
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def passages(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """For all texts: text number, first window, number of windows and anchor hash of each passage."""
    span = length - gram + 1
    out: list[tuple[np.ndarray, ...]] = []
    # a text longer than a slice is cut into parts that overlap by the reach of a window
    parts = [(k, at, t[at:at + 4 * SLICE_BYTES + length - 1]) for k, t in enumerate(texts)
             for at in range(0, max(1, len(t) - length + 1), 4 * SLICE_BYTES) if len(t) >= length]
    for a, b in byte_slices([p for _, _, p in parts], SLICE_BYTES):
        data = b"".join(p for _, _, p in parts[a:b])
        sizes = np.array([len(p) for _, _, p in parts[a:b]])
        base = np.cumsum(sizes) - sizes
        hashes = _gram_hashes(np.frombuffer(data, np.uint8), gram)
        places = np.arange(len(hashes), dtype=np.uint64)
        anchor = (_sliding_min(hashes & ~_PLACE | places, span) & _PLACE).astype(np.int64)
        windows = ragged(base, sizes - length + 1)
        owner = np.repeat(np.arange(b - a), sizes - length + 1)
        at = anchor[windows]
        head = np.append(True, (at[1:] != at[:-1]) | (owner[1:] != owner[:-1]))
        first = np.flatnonzero(head)
        count = np.diff(np.append(first, len(windows)))
        who = owner[first]
        text = np.array([k for k, _, _ in parts[a:b]])[who]
        start = windows[first] - base[who] + np.array([s for _, s, _ in parts[a:b]])[who]
        out.append((text, start, count, hashes[at[first]]))
    if not out:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(c) for c in zip(*out))


class RunLengthIndex:
    """Sorted windows of some passages, their Burrows-Wheeler runs, and matching statistics.

    ``texts[k]`` has ``counts[k]`` windows of ``length`` bytes and occurs ``weights[k]`` times.
    """

    def __init__(self, texts: list[bytes], counts: np.ndarray, weights: np.ndarray, length: int = LENGTH):
        self.length = length
        data = np.frombuffer(b"".join(texts) + bytes(16), np.uint8)
        sizes = np.array([len(t) for t in texts])
        base = np.cumsum(sizes) - sizes
        self.data, self.counts, self.weights = data, counts, weights
        self.at = ragged(base, counts)  # windows in the order of the passages
        self.owner = np.repeat(np.arange(len(texts)), counts)
        self.room = (base + sizes)[self.owner] - self.at
        self.first = np.append(True, self.owner[1:] != self.owner[:-1])
        words = np.zeros(len(data) - 8, np.uint64)
        for k in range(8):
            words = words << np.uint64(8) | data[k:len(words) + k]
        self.words = words
        self.order = self._sorted()
        # the byte before each window in sorted order; the first window of a passage has none
        before = np.where(self.first, -1, data[self.at - 1].astype(np.int16))
        self.bwt = before[self.order]

    def _sorted(self) -> np.ndarray:
        words, at = self.words, self.at
        order = np.argsort(words[at], kind="stable")
        key = words[at[order]]
        fresh = np.append(True, key[1:] != key[:-1])
        for depth in range(8, self.length, 8):
            tied = ~fresh
            tied[:-1] |= ~fresh[1:]
            spots = np.flatnonzero(tied)
            if not len(spots):
                break
            some = order[spots]
            group = np.cumsum(fresh[spots])
            key = words[at[some] + min(depth, self.length - 8)]
            rank = np.lexsort((key, group))
            order[spots] = some[rank]
            key, group = key[rank], group[rank]
            fresh[spots] = np.append(True, (group[1:] != group[:-1]) | (key[1:] != key[:-1]))
        return order

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and weighted lengths of the runs of the transform."""
        head = np.append(True, self.bwt[1:] != self.bwt[:-1])
        weight = self.weights[self.owner[self.order]]
        return self.bwt[head], np.add.reduceat(weight, np.flatnonzero(head))

    def _common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Common prefix of the windows numbered x and y, as far as both passages reach."""
        most = np.minimum(self.room[x], self.room[y])
        out = np.zeros(len(x), np.int64)
        live = np.arange(len(x))
        while len(live):
            u, v = self.words[self.at[x[live]] + out[live]], self.words[self.at[y[live]] + out[live]]
            differ = u ^ v
            same = np.full(len(live), 8)
            odd = np.flatnonzero(differ)
            top = np.zeros(len(odd), np.int64)  # equal leading bytes of the word
            for k in range(1, 8):
                top += differ[odd] < (np.uint64(1) << np.uint64(64 - 8 * k))
            same[odd] = top
            out[live] += same
            live = live[(same == 8) & (out[live] < most[live])]
        return np.minimum(out, most)

    def matches(self) -> np.ndarray:
        """For each window the longest match with a neighbour in sorted order."""
        order, n = self.order, len(self.order)
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        inner = np.append(False, (self.bwt[1:] == self.bwt[:-1]) & (self.bwt[1:] >= 0))[rank]
        sample = np.flatnonzero(~inner)  # run ends, and windows that no other leads to
        lcp = np.zeros(n, np.int64)  # with the window sorted just before, by window
        near = sample[rank[sample] > 0]
        lcp[near] = self._common(near, order[rank[near] - 1])
        last = np.maximum.accumulate(np.where(inner, 0, np.arange(n)))
        lcp = np.maximum(lcp[last] - (np.arange(n) - last), 0)
        # windows are sorted by `length` bytes only, so a shorter streamed match may be too short
        short = np.flatnonzero(inner & (lcp < self.length))
        lcp[short] = self._common(short, order[rank[short] - 1])
        after = np.append(lcp[order][1:], 0)
        return np.maximum(lcp, after[rank])

    def repeated(self) -> np.ndarray:
        return (self.matches() >= self.length) | (self.weights[self.owner] > 1)


def _row_keys(ids: list, texts: list[bytes]) -> list[pa.Array]:
    """128 bits for each row, of its id and text, so that no two texts of any corpus share them."""
    hashes = b"".join(hashlib.blake2b(text, digest_size=16, key=str(doc_id).encode()).digest()
                      for doc_id, text in zip(ids, texts))
    parts = np.frombuffer(hashes, np.int64).reshape(-1, 2)
    return [pa.array(parts[:, 0]), pa.array(parts[:, 1])]


def _long(values) -> pa.Array:
    return pa.array(np.asarray(values).view(np.int64) if len(values) else [], pa.int64())


def _ranges(flags: np.ndarray) -> np.ndarray:
    """``[from, to)`` of the runs of true values."""
    return np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))).astype(np.int32)


def _anchors(source: DataFrame, length: int, gram: int) -> DataFrame:
    """One row for each text, with the distinct anchor hashes and what a whole text needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts, ids = whole_bytes(batch.column("text")), batch.column("doc_id").to_pylist()
            for a, b in byte_slices(texts):
                text, _, _, hashes = passages(texts[a:b], length, gram)
                bounds = np.searchsorted(text, np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*_row_keys(ids[a:b], texts[a:b]),
                     pa.array(ids[a:b], pa.int64()), pa.array([len(t) for t in texts[a:b]], pa.int64()),
                     pa.array([hashlib.sha256(t).hexdigest() for t in texts[a:b]]),
                     pa.ListArray.from_arrays(pa.array(bounds), _long(hashes))],
                    names=[*ROW, "doc_id", "n_bytes", "sha256", "anchors"])

    return source.mapInArrow(
        run, f"{ROW_TYPES}, doc_id long, n_bytes long, sha256 string, anchors array<long>")


def _blobs(source: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            pack = zstandard.ZstdCompressor(level=1)
            texts, ids = whole_bytes(batch.column("text")), batch.column("doc_id").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*_row_keys(ids, texts),
                 pa.array([pack.compress(t) for t in texts], pa.binary())], names=[*ROW, "blob"])

    return source.mapInArrow(run, f"{ROW_TYPES}, blob binary")


def _cut(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Distinct passages of each text whose anchor occurs again: where, and their bytes.

    The bytes come with the first passage of their kind in a batch only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = zstandard.ZstdDecompressor()
        for batch in small_batches(batches, "blob"):
            keys = list(zip(*(batch.column(c).to_pylist() for c in ROW)))
            blobs = batch.column("blob").to_pylist()
            wanted = batch.column("wanted")
            rows: dict[tuple, list] = {}
            sent: set[tuple] = set()
            whole = [plain.decompress(x) for x in blobs]
            for a, b in byte_slices(whole):
                text, start, count, hashes = passages(whole[a:b], length, gram)
                signed = hashes.view(np.int64) if len(hashes) else hashes
                bounds = np.searchsorted(text, np.arange(b - a + 1))
                for k in range(b - a):
                    lo, hi = bounds[k], bounds[k + 1]
                    again = np.isin(signed[lo:hi], wanted[a + k].values.to_numpy())
                    own = whole[a + k]
                    for s, n, h in zip(start[lo:hi][again].tolist(), count[lo:hi][again].tolist(),
                                       signed[lo:hi][again].tolist()):
                        piece = own[s:s + n + length - 1]
                        digest = int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(),
                                                "little", signed=True)
                        row = rows.get((*keys[a + k], h, digest))
                        if row is None:
                            new = (h, digest) not in sent
                            sent.add((h, digest))
                            rows[(*keys[a + k], h, digest)] = [[s], n, piece if new else None]
                        else:
                            row[0].append(s)
            at = list(rows)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([x[i] for x in at], pa.int64()) for i in range(4)),
                 pa.array([rows[x][0] for x in at], pa.list_(pa.int32())),
                 pa.array([rows[x][1] for x in at], pa.int32()),
                 pa.array([rows[x][2] for x in at], pa.binary())],
                names=[*ROW, "anchor", "digest", "starts", "windows", "piece"])

    return texts.mapInArrow(
        run, f"{ROW_TYPES}, anchor long, digest long, starts array<int>, windows int, piece binary")


FOUND = "anchor long, digest long, spans binary"


def _indexed(pieces: DataFrame, length: int) -> DataFrame:
    """``anchor, digest, spans``: ranges of repeated windows of passages, from blocks of the index."""

    def block(rows: list[tuple]) -> pa.RecordBatch:
        counts = np.array([r[2] for r in rows], np.int64)
        index = RunLengthIndex([r[4] for r in rows], counts, np.array([r[3] for r in rows]), length)
        flags = index.repeated()
        ends = np.cumsum(counts)
        spans = [_ranges(flags[e - c:e]).tobytes() for c, e in zip(counts.tolist(), ends.tolist())]
        kept = [(r[0], r[1], s) for r, s in zip(rows, spans) if s]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*kept) if kept else ((), (), ()),
                                            (pa.int64(), pa.int64(), pa.binary()))],
            names=["anchor", "digest", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "digest", "windows", "weight", "piece"))):
                if size > BLOCK_BYTES and row[0] != last:  # a block ends where an anchor ends
                    yield block(rows)
                    rows, size = [], 0
                rows.append(row)
                size, last = size + len(row[4]), row[0]
        if rows:
            yield block(rows)

    dealt = pieces.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.select("anchor", "digest", "windows", "weight", "piece").mapInArrow(run, FOUND)


def _counted(pieces: DataFrame, length: int) -> DataFrame:
    """As ``_indexed``, for anchors with very many passages: windows grouped by their bytes."""
    spread = pieces.select("anchor", "digest", "weight", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.col("windows")),
        lambda at: F.substring(F.col("piece"), at, F.lit(length)))).alias("at", "window"))
    again = spread.groupBy("anchor", "window").agg(F.sum("weight").alias("n")).filter("n > 1")
    hit = spread.join(again, ["anchor", "window"]).groupBy("anchor", "digest").agg(
        F.sort_array(F.collect_list("at")).alias("at"))  # at most the windows of a passage

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for at in batch.column("at").to_pylist():
                flags = np.zeros(at[-1] + 1, bool)
                flags[at] = True
                spans.append(_ranges(flags).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("anchor"), batch.column("digest"), pa.array(spans, pa.binary())],
                names=["anchor", "digest", "spans"])

    return hit.mapInArrow(run, FOUND)


def _removed(texts: DataFrame, length: int) -> DataFrame:
    """``k1, k2, spans, n_removed, kept`` of texts with repeated windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = zstandard.ZstdDecompressor()
        for batch in small_batches(batches, "blob"):
            spans, removed, kept = [], [], []
            for blob, found in zip(batch.column("blob").to_pylist(), batch.column("found").to_pylist()):
                text = plain.decompress(blob)
                edge = np.zeros(len(text) + 1, np.int64)
                for hit in found:
                    ranges = np.frombuffer(hit["spans"], np.int32).reshape(-1, 2).astype(np.int64)
                    starts = np.array(hit["starts"], np.int64)[:, None]
                    np.add.at(edge, starts + ranges[:, 0], 1)
                    np.add.at(edge, starts + ranges[:, 1] - 1 + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                ends = _ranges(gone).reshape(-1, 2)
                spans.append([{"begin": int(x), "end": int(y)} for x, y in ends])
                removed.append(int(gone.sum()))
                kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ROW),
                 pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                 pa.array(removed, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                 pa.array(kept, pa.binary())],
                names=[*ROW, "spans", "n_removed", "sha256", "kept"])

    return texts.select(*ROW, "blob", "found").mapInArrow(
        run, f"{ROW_TYPES}, spans array<struct<begin:long,end:long>>, n_removed long, "
             "sha256 string, kept binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept_sha256`` for every row of ``docs``.

    Texts are UTF-8 bytes, a null text is empty, and matches never cross texts. A byte goes if it
    lies in a string of ``length`` bytes that also starts at another place, in this text or another;
    overlaps count, and all is judged on the input. ``spans`` are the maximal removed ranges,
    ``kept_sha256`` is of the bytes that remain. Rows with one id are texts of their own, also if
    they are equal; null ids are allowed. Shorter texts lose nothing.
    """
    if not 8 <= gram <= length or gram & (gram - 1):
        raise ValueError("gram must be a power of two, 8 at least and length at most")
    source = id_and_text(docs, id_col, text_col)
    base = stage(_anchors(source, length, gram), "anchors")
    each = base.select(*ROW, F.explode("anchors").alias("anchor"))
    again = each.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    wanted = each.join(again, "anchor", "left_semi").groupBy(*ROW).agg(
        F.collect_set("anchor").alias("wanted"))  # no more than the text has passages
    # which texts go on grows with the corpus: not to be broadcast at any size
    some = _blobs(source).join(wanted.hint("merge"), ROW)
    with bucketed(some, "passages", *ROW) as texts:
        cut = stage(_cut(texts, length, gram), "cut")
        occurrences = cut.groupBy("anchor", "digest").agg(
            F.sum(F.size("starts")).alias("weight"), F.first("windows").alias("windows"),
            F.first("piece", ignorenulls=True).alias("piece"))
        pieces = stage(occurrences, "pieces")
        hot = pieces.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT)
        hot = stage(hot.select("anchor"), "hot")
        if hot.head(1):
            found = _indexed(pieces.join(hot, "anchor", "left_anti"), length).unionByName(
                _counted(pieces.join(hot, "anchor", "left_semi"), length))
        else:
            found = _indexed(pieces, length)
        places = cut.select(*ROW, "anchor", "digest", "starts").join(
            stage(found, "found"), ["anchor", "digest"])
        hits = places.groupBy(*ROW).agg(  # no more than the text has passages
            F.collect_set(F.struct("starts", "spans")).alias("found"))
        gone = stage(_removed(texts.join(hits.hint("merge"), ROW), length).drop("kept")
                     .dropDuplicates(ROW), "removed")
    return base.select(*ROW, "doc_id", "n_bytes", "sha256").join(
        gone.withColumnRenamed("sha256", "rest"), ROW, "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("spans", F.array().cast("array<struct<begin:long,end:long>>")).alias("spans"),
        F.coalesce("rest", "sha256").alias("kept_sha256"))


def digest(removed: DataFrame) -> DataFrame:
    return removed.select("doc_id", "n_bytes", "n_removed",
                          F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
