"""Exact Jaccard join of word shingle sets in the metric space of the Jaccard distance.

With distance 1 - J, documents link at distance e = 1 - t at most. Pivots come in three kinds, and
the triangle inequality bounds what each has to see:

* Every shingle is a pivot; its region holds the documents for which it is among the nearest.
  A document's pivots are ordered: crowded shingles last, by a sketch of fixed size over all texts,
  then by hash. The distance of x to the set of its first k shingles is 1 - k/|x|, so a document
  within e of x is at less than 1 from that set, that is, meets it, once k > e |x|. A document is
  therefore replicated to the regions of its first floor(e |x|) + 1 pivots, and linked documents
  meet in a region.
* Pivot sets divide all shingles. By how much two documents' counts differ in each of them adds up
  to no more than their symmetric difference, so a pair of small vectors rules out most pairs.
  Longer documents have more pivot sets, and neighbouring sets add up to coarser ones.
* In a region, documents become pivots: a document goes to the first pivot that the vectors do not
  rule out, or becomes one. Regions with very many documents are dealt to salts, whose pivots
  are joined again.

Pairs that pass are verified with whole sets. Linked documents are one component, and within a
region only pairs across components are left to test, so a large group of near copies costs in
proportion to its size. Documents with the same set are one class throughout.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starsmelt.llm.common import bucketed, byte_slices, id_and_text, small_batches, stage, whole_bytes
from starsmelt.llm.components import components
from starsmelt.llm.shingles import shingle_sets, shingles

SKETCH = 1 << 16
VECTOR = 64
#: Regions of at most this many documents give all their passing pairs, if these are few.
SMALL = 64
#: Documents of a region, or a salt of it, that one task joins.
REGION = 20_000
#: Members of a region's largest component that the others meet, round by round.
ROUNDS = (16, 64)


@dataclass(frozen=True)
class Threshold:
    """Link if ``100 * intersection >= percent * union``."""

    percent: int = 85

    def window(self, n: int) -> int:
        """How many first pivots of a set of n shingles a linked set must meet."""
        return n - (-(-self.percent * n // 100)) + 1

    def least(self) -> int:
        """Smaller sets link with equal sets only: one differing shingle is too much."""
        n = 1
        while 100 * n < self.percent * (n + 1):
            n += 1
        return n

    def sizes(self, a, b):
        return 100 * np.minimum(a, b) >= self.percent * np.maximum(a, b)

    def difference(self, a, b, found):
        """A symmetric difference of at least ``found`` leaves a link possible."""
        return (100 + self.percent) * found <= (100 - self.percent) * (a + b)

    def places(self, a, at_a, b, at_b):
        """Whether two sets can link whose first common pivot stands ``at_a`` and ``at_b``.

        None of the pivots before is common, so the rest of each set bounds the intersection. Where
        the pivot is not the first common one this may say no to a link; its own region does not.
        """
        rest = np.minimum(a - at_a, b - at_b)
        return (100 + self.percent) * rest >= self.percent * (a + b)


def _scan(source: DataFrame, each, schema: str) -> DataFrame:
    """``each(ids, texts)`` gives the columns for a slice of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts, ids = whole_bytes(batch.column("text")), batch.column("doc_id").to_pylist()
            for a, b in byte_slices(texts):
                yield from each(ids[a:b], texts[a:b])

    return source.mapInArrow(run, schema)


def crowding(source: DataFrame, size: int) -> np.ndarray:
    """A level for each of ``SKETCH`` buckets of shingles: 0, or how far it is over the usual count.

    Counts over all texts, summed up in each task before they are shuffled; the driver gets one row
    for each bucket, whatever the input.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.int64)
        for batch in small_batches(batches):
            texts = whole_bytes(batch.column("text"))
            for a, b in byte_slices(texts):
                found = np.concatenate(shingles(texts[a:b], size))
                total += np.bincount((found & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    rows = source.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(SKETCH)
    counts[[r["bucket"] for r in rows]] = [r["n"] for r in rows]
    usual = np.median(counts)
    over = (counts - usual) / (4 * np.sqrt(usual) + 4)
    return np.where(over > 1, 1 + np.log2(np.maximum(over, 1)), 0).astype(np.uint8)


def sketches(source: DataFrame, size: int, limit: Threshold, level: np.ndarray) -> DataFrame:
    """``doc_id, n, d1, d2, t1, t2, window, vector``: set size, digests of set and text, first pivots,
    pivot vector."""
    least = limit.least()

    def each(ids, texts):
        n, digests, windows, vectors = [], [], [], []
        texted = _text_digests(texts)
        for found in shingle_sets(texts, size):
            n.append(len(found))
            digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
            first = found[:0]
            if len(found) >= least:
                order = np.lexsort((found, level[(found & np.uint64(SKETCH - 1)).astype(np.int64)]))
                first = found[order[:limit.window(len(found))]]
            windows.append(first.view(np.int64))
            vectors.append(_vector(found))
        digest = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        offsets = np.concatenate([[0], np.cumsum([len(w) for w in windows])]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n, pa.int32()), pa.array(digest[:, 0]),
             pa.array(digest[:, 1]), pa.array(texted[:, 0]), pa.array(texted[:, 1]),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(windows))),
             pa.array(vectors, pa.binary())],
            names=["doc_id", "n", "d1", "d2", "t1", "t2", "window", "vector"])

    return _scan(source, each, "doc_id long, n int, d1 long, d2 long, t1 long, t2 long, "
                               "window array<long>, vector binary")


def _text_digests(texts: list[bytes]) -> np.ndarray:
    """Two longs for each text, which tell apart the texts of one id."""
    found = b"".join(hashlib.blake2b(t, digest_size=16).digest() for t in texts)
    return np.frombuffer(found, np.int64).reshape(-1, 2)


def _vector(found: np.ndarray) -> bytes:
    """Counts of the shingles in 64 to 2048 pivot sets; nothing if a count doesn't fit a byte."""
    log2 = 6 + min(5, max(0, (len(found) >> 9).bit_length() - 1))
    counts = np.bincount((found >> np.uint64(64 - log2)).astype(np.int64), minlength=1 << log2)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""


def _folded(vectors: list[bytes], to: int) -> np.ndarray:
    """Vectors over ``to`` pivot sets, from vectors of one length that is at least that."""
    flat = np.frombuffer(b"".join(vectors), np.uint8).reshape(len(vectors), to, -1)
    return flat.sum(axis=2, dtype=np.int32)


def _apart(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """Least symmetric difference of each pair, as far as their vectors tell."""
    out = np.zeros(len(x), np.int64)
    kinds: dict[tuple[int, int], list[int]] = {}
    for k, (u, v) in enumerate(zip(x, y)):
        if u and v:
            kinds.setdefault((len(u), len(v)), []).append(k)
    for sizes, at in kinds.items():
        to = min(sizes)
        gap = _folded([x[k] for k in at], to) - _folded([y[k] for k in at], to)
        out[at] = np.abs(gap).sum(axis=1)
    return out


PAIRS = "kind int, a long, b long, n int, at int, vector binary"
_PAIR, _PARTIAL, _PIVOT = 0, 1, 2


class _Region:
    """Pairs of one region, as its documents come by; memory for its pivots only if it is large."""

    def __init__(self, key: tuple, limit: Threshold):
        self.key, self.limit = key, limit
        self.small = key[2] <= SMALL
        self.ids: list[int] = []
        self.raw: list[bytes] = []
        self.n, self.at = np.empty(16, np.int64), np.empty(16, np.int64)
        self.v = np.empty((16, VECTOR), np.int32)
        self.out: list[tuple] = []
        self.partial = False

    def near(self, n: int, place: int, raw: bytes, v: np.ndarray) -> list[int]:
        """Which of the documents kept so far no size, place or vector rules out."""
        m = len(self.ids)
        if not m:
            return []
        coarse = np.abs(self.v[:m] - v).sum(axis=1) if raw else np.zeros(m, np.int64)
        at = np.flatnonzero(self.limit.sizes(self.n[:m], n)
                            & self.limit.places(self.n[:m], self.at[:m], n, place) & (
            self.limit.difference(self.n[:m], n, coarse) | np.array([not r for r in self.raw])))
        if len(at) and len(raw) > VECTOR:
            apart = _apart([self.raw[k] for k in at], [raw] * len(at))
            at = at[self.limit.difference(self.n[at], n, apart)]
        return at.tolist()

    def keep(self, doc: int, n: int, place: int, raw: bytes, v: np.ndarray) -> None:
        at = len(self.ids)
        if at == len(self.n):
            self.n, self.at = np.resize(self.n, 2 * at), np.resize(self.at, 2 * at)
            self.v = np.resize(self.v, (2 * at, VECTOR))
        self.n[at], self.at[at], self.v[at] = n, place, v
        self.ids.append(doc)
        self.raw.append(raw)

    def add(self, doc: int, n: int, place: int, raw: bytes, v: np.ndarray) -> None:
        near = self.near(n, place, raw, v)
        if self.small:
            self.out += [(_PAIR, self.ids[k], doc, None, None, None) for k in near]
            self.keep(doc, n, place, raw, v)
        elif near:
            self.out.append((_PAIR, self.ids[near[0]], doc, None, None, None))
            self.partial = True
        else:
            self.keep(doc, n, place, raw, v)

    def close(self) -> list[tuple]:
        pivot, salts, m = self.key
        if self.small and len(self.out) > 4 * m:  # a dense group: pivots will do
            again = _Region((pivot, salts, SMALL + 1), self.limit)
            for k, doc in enumerate(self.ids):
                again.add(doc, int(self.n[k]), int(self.at[k]), self.raw[k], self.v[k])
            self.out, self.partial = again.out, True
        if self.partial:
            self.out.append((_PARTIAL, pivot, None, None, None, None))
        if salts > 1:  # its pivots meet those of the other salts
            self.out += [(_PIVOT, pivot, doc, int(self.n[k]), int(self.at[k]), self.raw[k])
                         for k, doc in enumerate(self.ids)]
        return self.out


def region_pairs(rows: DataFrame, limit: Threshold) -> DataFrame:
    """Pairs, partial regions and pivots of salted regions, from ``pivot, m, salts, salt, doc, n, at, vector``.

    Rows come sorted by region, so a task holds one region at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Region | None = None
        last = None
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("pivot", "salts", "salt", "m", "doc", "n", "at")]
            vectors = batch.column("vector").to_pylist()
            coarse = np.zeros((len(vectors), VECTOR), np.int32)
            for length in {len(v) for v in vectors} - {0}:
                at = [k for k, v in enumerate(vectors) if len(v) == length]
                coarse[at] = _folded([vectors[k] for k in at], VECTOR)
            out: list[tuple] = []
            for k, (pivot, salts, salt, m, doc, n, place) in enumerate(zip(*cols)):
                if (pivot, salt) != last:
                    if now:
                        out += now.close()
                    now, last = _Region((pivot, salts, m), limit), (pivot, salt)
                now.add(doc, n, place, vectors[k], coarse[k])
            out += now.out if now and not now.small else []
            if now and not now.small:
                now.out = []
            yield _pair_batch(out)
        if now:
            yield _pair_batch(now.close())

    dealt = rows.repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "n", "doc")
    return dealt.select("pivot", "salts", "salt", "m", "doc", "n", "at", "vector").mapInArrow(run, PAIRS)


def _pair_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 6
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                      names=["kind", "a", "b", "n", "at", "vector"])


def verify(pairs: DataFrame, texts: DataFrame, size: int, limit: Threshold) -> DataFrame:
    """The ``a, b`` of ``pairs`` whose whole sets link. ``texts``: ``doc, blob``, a row for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = zstandard.ZstdDecompressor()
        known: dict[int, np.ndarray] = {}
        for batch in small_batches(batches, "blob_a"):
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            blobs = dict(zip(a, batch.column("blob_a").to_pylist())) | dict(
                zip(b, batch.column("blob_b").to_pylist()))
            held = sum(map(len, known.values()))
            known = {k: known[k] for k in blobs if k in known} if held > 1 << 22 else known
            new = [k for k in blobs if k not in known]
            for lo in range(0, len(new), 256):
                some = new[lo:lo + 256]
                known.update(zip(some, shingle_sets([plain.decompress(blobs[k]) for k in some], size)))
            linked = [limit_holds(known[x], known[y]) for x, y in zip(a, b)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, ok in zip(a, linked) if ok], pa.int64()),
                 pa.array([y for y, ok in zip(b, linked) if ok], pa.int64())], names=["a", "b"])

    def limit_holds(x: np.ndarray, y: np.ndarray) -> bool:
        if len(x) > len(y):
            x, y = y, x
        at = np.searchsorted(y, x)
        common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
        return 100 * common >= limit.percent * (len(x) + len(y) - common)

    of = lambda name: texts.select(F.col("doc").alias(name), F.col("blob").alias(f"blob_{name}"))
    return pairs.select("a", "b").join(of("b"), "b").join(of("a"), "a").select(
        "a", "b", "blob_a", "blob_b").mapInArrow(run, "a long, b long")


def _compressed(source: DataFrame) -> DataFrame:
    def each(ids, texts):
        pack = zstandard.ZstdCompressor(level=1)
        texted = _text_digests(texts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(texted[:, 0]), pa.array(texted[:, 1]),
             pa.array([pack.compress(t) for t in texts], pa.binary())], names=["doc_id", "t1", "t2", "blob"])

    return _scan(source, each, "doc_id long, t1 long, t2 long, blob binary")


#: Set sizes fall into bands, each larger by this factor; sizes that can link are a few bands apart.
BAND = 1.02


def _with_partners(met: DataFrame, percent: int) -> DataFrame:
    """The rows of crowded regions that some row of their region may link with, by sizes and places.

    ``met``: ``pivot, doc, n, at``. A set of n shingles whose first common pivot stands at ``at`` has a
    reach of ``(100 + percent) (n - at) - percent n``; two sets can link only if the reach of each is at
    least ``percent`` times the size of the other. A region is one row for each band of sizes, summed up
    before it moves, and a row stays if a band near its own has the reach and a size within its own.
    Texts of one template that differ in some words fall here: what they have in common comes last.
    """
    reach = (100 + percent) * (F.col("n") - F.col("at")) - percent * F.col("n")
    band = F.floor(F.log("n") / math.log(BAND))
    far = math.ceil(math.log(100 / percent) / math.log(BAND)) + 1
    rows = met.withColumn("reach", reach.cast("long")).withColumn("band", band)
    bands = rows.groupBy("pivot", "band").agg(F.max("reach").alias("most"), F.min("n").alias("least"))
    near = bands.select(
        F.col("pivot").alias("p"), F.explode(F.sequence(F.col("band") - far, F.col("band") + far)).alias("b"),
        "most", "least")
    fits = ((rows["pivot"] == near["p"]) & (rows["band"] == near["b"])
            & (near["most"] >= percent * rows["n"]) & (rows["reach"] >= percent * near["least"]))
    return rows.join(near, fits, "left_semi").drop("reach", "band")


def _across(rows: DataFrame, roots: DataFrame, limit: Threshold, some: int | None) -> DataFrame:
    """Passing pairs across components in the given regions, smaller components against all.

    ``rows``: ``pivot, doc, n, at, vector`` of regions whose pairs were not all given. With ``some``,
    only so many documents of a region's largest component stand for it: those first in an order
    by hash that is the same in all regions, so that regions agree on them.
    """
    own = rows.join(roots.select(F.col("node").alias("doc"), "root"), "doc", "left").withColumn(
        "root", F.coalesce("root", "doc"))
    sizes = own.groupBy("pivot", "root").agg(F.count(F.lit(1)).alias("members"))
    largest = sizes.groupBy("pivot").agg(
        F.max(F.struct("members", "root")).alias("top"), F.count(F.lit(1)).alias("roots")).filter(
        "roots > 1").select("pivot", F.col("top.root").alias("top"))
    own = stage(own.join(largest, "pivot"), "across")
    few = own.filter("root <> top").select(
        "pivot", F.col("doc").alias("a"), F.col("root").alias("ra"), F.col("n").alias("na"),
        F.col("at").alias("ata"), F.col("vector").alias("va"))
    if some:
        rank = F.row_number().over(Window.partitionBy("pivot").orderBy(F.xxhash64("doc"), "doc"))
        own = own.filter("root = top").withColumn("rank", rank).filter(F.col("rank") <= some)
    rest = F.least(F.col("n") - F.col("at"), F.col("na") - F.col("ata"))
    met = own.join(few, "pivot").filter("root <> ra AND (root = top OR doc < a)").filter(
        (F.least("n", "na") * 100 >= F.greatest("n", "na") * limit.percent)
        & (rest * (100 + limit.percent) >= (F.col("n") + F.col("na")) * limit.percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = _apart(batch.column("va").to_pylist(), batch.column("vector").to_pylist())
            ok = pa.array(limit.difference(batch.column("n").to_numpy().astype(np.int64),
                                           batch.column("na").to_numpy(), apart))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(ok), batch.column("doc").filter(ok)], names=["a", "b"])

    found = met.select("a", "doc", "na", "n", "va", "vector").mapInArrow(run, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4,
                   percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """Classes of equal sets, and the classes that links connect.

    The first result has a row for each row of ``docs``: ``doc_id, n_shingles, class, class_id``, a
    number for the set and the smallest id that has it. The second has ``node, root`` for each class
    with a link to another: its number, and the smallest id that links reach. Rows with a null id take
    part in nothing; a null or empty text, or one without words, has no shingles and links with
    nothing, whatever else its id has. Rows with the same id are one document: all that their texts
    link with is linked.
    """
    limit = Threshold(percent)
    source = id_and_text(docs, id_col, text_col)
    level = crowding(source, size)
    sets = stage(sketches(source, size, limit, level), "sketches")
    # numbered when written, so that a number is a class for good; ids may belong to several classes
    classes = stage(sets.filter("n > 0 AND doc_id IS NOT NULL").groupBy("d1", "d2").agg(
        F.min(F.struct("doc_id", "t1", "t2")).alias("first"), F.first("n").alias("n"),
        F.first("window").alias("window"), F.first("vector").alias("vector")).withColumn(
        "doc", F.monotonically_increasing_id()), "classes")
    keys = classes.select("doc", "d1", "d2", F.col("first.doc_id").alias("class_id"))
    has_class = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    member = stage(sets.select("doc_id", "n", "d1", "d2").join(keys, ["d1", "d2"], "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(has_class, F.col("doc")).alias("class"),
        F.when(has_class, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id")), "members")
    spread = classes.select(F.posexplode("window").alias("at", "pivot"), "doc", "n")
    shared = stage(spread.groupBy("pivot").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), "shared")
    vectors = classes.select("doc", "vector")
    # rows whose neighbours by size are too small and too large link with nothing in the region
    sizes = Window.partitionBy("pivot").orderBy("n")
    fits = (F.lag("n").over(sizes) * 100 >= F.col("n") * percent) | (
        F.col("n") * 100 >= F.lead("n").over(sizes) * percent)
    # crowded pivots are few, at most one for REGION rows, and meet the rows apart from the others
    crowds = stage(shared.filter(F.col("m") > REGION).select("pivot"), "crowds")
    crowded = stage(_with_partners(spread.join(crowds, "pivot"), percent), "crowded")
    counted = crowded.groupBy("pivot").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    met = spread.join(shared.filter(F.col("m") <= REGION), "pivot")
    rows = stage(crowded.join(counted, "pivot").unionByName(
        met.withColumn("fits", fits).filter("fits").drop("fits")), "regions")
    salts = F.ceil(F.col("m") / REGION).cast("int")
    salted = rows.join(vectors, "doc").select(
        "pivot", "m", "doc", "n", "at", "vector", salts.alias("salts"),
        F.pmod(F.xxhash64("doc"), salts).cast("int").alias("salt"))
    first = stage(region_pairs(salted, limit), "pairs")
    pivots = first.filter(F.col("kind") == _PIVOT)
    again = pivots.select(F.col("a").alias("pivot"), F.lit(REGION).cast("long").alias("m"),
                          F.col("b").alias("doc"), "n", "at", "vector", F.lit(1).alias("salts"),
                          F.lit(0).alias("salt"))
    second = stage(region_pairs(again, limit), "pairs")
    both = first.unionByName(second)
    pairs = stage(both.filter(F.col("kind") == _PAIR).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    partial = both.filter(F.col("kind") == _PARTIAL).select(F.col("a").alias("pivot")).distinct()
    rest = rows.join(partial, "pivot").join(vectors, "doc").select("pivot", "doc", "n", "at", "vector")
    rest = stage(rest, "partial")
    needed = needed.unionByName(rest.select("doc")).distinct()
    # what is needed grows with the corpus: not to be broadcast at any size
    wanted = classes.select("doc", "first.*").join(needed, "doc", "left_semi")
    reps = _compressed(source.filter("doc_id IS NOT NULL")).join(
        wanted.hint("merge"), ["doc_id", "t1", "t2"]).dropDuplicates(["doc_id", "t1", "t2"]).select("doc", "blob")
    # classes of one id are one document
    of_id = member.filter("class IS NOT NULL").groupBy("doc_id").agg(
        F.min("class").alias("a"), F.max("class").alias("last")).filter("a < last").drop("last")
    same = stage(member.join(of_id, "doc_id").filter(F.col("class") > F.col("a")).select(
        "a", F.col("class").alias("b")).distinct(), "same-id")
    with bucketed(reps, "texts", "doc") as texts:
        links = stage(verify(pairs, texts, size, limit).unionByName(same), "links")
        roots = stage(components(links), "roots")
        for some in (*ROUNDS, None):  # a last round without a bound makes it exact
            more = stage(_across(rest, roots, limit, some).join(pairs, ["a", "b"], "left_anti"), "pairs")
            if not more.head(1):
                continue
            extra = stage(verify(more, texts, size, limit), "links")
            pairs = pairs.unionByName(more)
            if extra.head(1):
                links = links.unionByName(extra)
                roots = stage(components(links), "roots")
    named = roots.join(keys.select(F.col("doc").alias("node"), "class_id"), "node")
    lowest = named.groupBy("root").agg(F.min("class_id").alias("low"))
    return member, named.join(lowest, "root").select("node", F.col("low").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4,
                    percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``; see ``link_documents``.

    ``component_id`` is the smallest id that links reach, the document's own included; for a null
    id it is null.
    """
    member, roots = link_documents(docs, id_col, text_col, size, percent)
    named = roots.select(F.col("node").alias("class"), "root")
    return member.join(named, "class", "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "class_id").alias("component_id"))
