"""Periodic runs of words: maximal stretches that repeat with a smallest period, found by block convolution.

A run with period q in [B, 2B), B a power of two, and at least four periods long holds a block of B
words, aligned to multiples of B, that occurs again q words later. So at every dyadic scale B each
aligned block is matched against the window that follows it, at all distances of [B, 2B) at once: the
sum of squared differences between block and window is 0 exactly where they are equal, and that sum
comes from two squared norms and a product of number-theoretic transforms, in integers without
rounding. The distances found seed extensions to both sides.

What keeps this cheap and exact:

* A word that does not come again within 2B words stops its block: every word of a block that occurs
  again at a distance under 2B does so itself. Most blocks of prose fall at once.
* A block whose window lies in a known run of period d, 2d <= B, can only match at multiples of d,
  whose extension is that run. Such blocks need no transform.
* Words are taken modulo a small number, so that no sum reaches the modulus of the transform. Equal
  words stay equal; a match of unequal words is found when it is extended, by comparing the words.

The words of many texts are one array, each text with numbers of its own, so nothing matches across
texts. Texts are taken in slices of about a megabyte, a longer text alone; nothing is cut short.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsmelt.llm.common import byte_slices, id_and_text, null_to_empty, small_batches, whole_bytes

#: A run is at least this many words long, and this many of its periods.
MIN_WORDS, MIN_PERIODS = 6, 4
#: A prime of the form 15 * 2**27 + 1, and a generator of its multiplicative group.
PRIME, GENERATOR = 2013265921, 31
#: Longest block that one transform takes; longer scales use the first words of their blocks.
BLOCK = 1 << 12
#: Elements that are transformed at once, so that they stay in the processor's cache.
AT_ONCE = 1 << 17
SLICE_BYTES = 1 << 20

_roots: dict[tuple[int, bool], np.ndarray] = {}


def _powers(half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order ``2 * half``."""
    if (half, inverse) not in _roots:
        root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
        root = pow(root, -1, PRIME) if inverse else root
        powers = [1]
        for _ in range(half - 1):
            powers.append(powers[-1] * root % PRIME)
        _roots[half, inverse] = np.array(powers, np.uint64)
    return _roots[half, inverse]


def transform(rows: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of every row; the length is a power of two. Results are in
    bit-reversed order, which :func:`inverse` expects."""
    count, size = rows.shape
    p, a = np.uint64(PRIME), rows.astype(np.uint64)
    half = size // 2
    while half:
        pairs = a.reshape(count, -1, 2, half)
        u, v = pairs[:, :, 0], pairs[:, :, 1]
        a = np.stack([(u + v) % p, (u + (p - v)) * _powers(half, False) % p], axis=2).reshape(count, size)
        half //= 2
    return a


def inverse(rows: np.ndarray) -> np.ndarray:
    count, size = rows.shape
    p, a = np.uint64(PRIME), rows
    half = 1
    while half < size:
        pairs = a.reshape(count, -1, 2, half)
        u, v = pairs[:, :, 0], pairs[:, :, 1] * _powers(half, True) % p
        a = np.stack([(u + v) % p, (u + (p - v)) % p], axis=2).reshape(count, size)
        half *= 2
    return a * np.uint64(pow(size, -1, PRIME)) % p


def zero_mismatches(blocks: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and shift where a block of b values equals its window of 2b values, at shifts 0 .. b - 1.

    Values are at least 0, and ``b * max(values) ** 2`` is less than the prime, so every sum is exact.
    """
    count, b = blocks.shape
    turned = np.zeros((count, 2 * b), np.uint64)
    turned[:, 0] = blocks[:, 0]
    turned[:, 2 * b - 1:b:-1] = blocks[:, 1:]
    product = inverse(transform(turned) * transform(windows) % np.uint64(PRIME))[:, :b].astype(np.int64)
    squares = np.zeros((count, 2 * b + 1), np.int64)
    np.cumsum(windows.astype(np.int64) ** 2, axis=1, out=squares[:, 1:])
    sums = squares[:, b:2 * b] - squares[:, :b]
    own = (blocks.astype(np.int64) ** 2).sum(axis=1, keepdims=True)
    return np.nonzero(own + sums - 2 * product == 0)


def _next_distance(words: np.ndarray) -> np.ndarray:
    """How far on each word comes again; the length of the array where it does not."""
    order = np.argsort(words, kind="stable")
    gap = np.full(len(words), len(words), np.int64)
    same = words[order[1:]] == words[order[:-1]]
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return gap


def _first_difference(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the common start of two arrays of one length, in steps that grow."""
    done, step = 0, 32
    while done < len(x):
        differs = x[done:done + step] != y[done:done + step]
        at = int(differs.argmax())
        if differs[at]:
            return done + at
        done, step = done + step, step * 4
    return len(x)


def _extent(words: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """Bounds of the stretch around ``at`` in which words q apart are equal."""
    right = _first_difference(words[at:len(words) - q], words[at + q:])
    left = _first_difference(words[:at][::-1], words[q:at + q][::-1])
    return at - left, at + right + q


class _Runs:
    """The runs of one array of words, scale by scale."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.found: dict[tuple[int, int], int] = {}

    def covered(self, scale: int, block: int, count: int) -> np.ndarray:
        """Blocks whose window lies in a known run of at most half a block's period."""
        change = np.zeros(count + 1, np.int64)
        for (start, end), period in self.found.items():
            first, last = -(-start // scale), (end - 2 * scale - block) // scale
            if 2 * period <= block and last >= first:
                change[first] += 1
                change[min(last + 1, count)] -= 1
        return np.cumsum(change[:-1]) > 0

    def seeds(self, scale: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and distances at which the given blocks occur again, as far as residues tell."""
        block = min(scale, BLOCK)
        levels = math.isqrt((PRIME - 1) // block)
        residues = ((self.words * np.int64(0x9E3779B1)) >> 16) % levels
        residues = np.concatenate([residues, np.zeros(2 * scale + 2 * block, np.int64)])
        at, distance = [starts[:0]], [starts[:0]]
        rows = max(1, AT_ONCE // (2 * block))
        for shift in range(scale, 2 * scale, block):
            for k in range(0, len(starts), rows):
                some = starts[k:k + rows, None]
                row, more = zero_mismatches(
                    residues[some + np.arange(block)], residues[some + shift + np.arange(2 * block)])
                at.append(some[row, 0])
                distance.append(shift + more)
        return np.concatenate(at), np.concatenate(distance)

    def news(self, scale: int, at: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """Which seeds, in the order of ``at``, do not just say that a known run repeats.

        A distance that is a multiple of a run's period, at a block inside it, extends to that run.
        """
        block = min(scale, BLOCK)
        new = np.ones(len(at), bool)
        long = [(a, e, d) for (a, e), d in self.found.items() if d <= block and e - a >= scale + block]
        for a, e, d in long:
            lo, hi = np.searchsorted(at, (a, e))
            new[lo:hi] &= (distance[lo:hi] % d != 0) | (at[lo:hi] + block + distance[lo:hi] > e)
        return new

    def scan(self, scale: int, starts: np.ndarray) -> None:
        at, distance = self.seeds(scale, starts)
        order = np.argsort(at, kind="stable")
        at, distance = at[order], distance[order]
        new = self.news(scale, at, distance)
        order = np.lexsort((at[new], distance[new]))
        at, distance = at[new][order], distance[new][order]
        block = min(scale, BLOCK)
        reached: dict[int, int] = {}
        for s, q in zip(at.tolist(), distance.tolist()):
            if s + block + q <= reached.get(q, 0):  # in the stretch found from an earlier block
                continue
            x, y = self.words[s:s + block], self.words[s + q:s + q + block]
            if len(y) < block or _first_difference(x, y) < block:
                continue
            a, e = _extent(self.words, s, q)
            reached[q] = e
            if e - a >= max(MIN_WORDS, MIN_PERIODS * q):
                self.found.setdefault((a, e), q)  # a divisor of q was found at a scale before


def find(words: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """``start, end, period`` of all runs of an array of words, by start, then period.

    ``ends`` bounds the texts in it; words of two texts are never equal. Periods of a scale are
    searched in every text that is long enough to have a run of them.
    """
    runs = _Runs(words)
    longest = int(np.diff(ends, prepend=0).max(initial=0))
    gap = _next_distance(words)
    scale, worst = 1, gap
    while MIN_PERIODS * scale <= longest and scale <= len(words):
        count = len(words) // scale
        if scale > 1 and scale <= BLOCK:  # the largest gap in each block
            worst = worst[:len(worst) // 2 * 2].reshape(-1, 2).max(axis=1)
        elif scale > BLOCK:
            worst = worst[::2]
        live = worst[:count] < 2 * scale
        if runs.found and live.any():
            live &= ~runs.covered(scale, min(scale, BLOCK), count)
        starts = np.flatnonzero(live) * scale
        if len(starts):
            runs.scan(scale, starts)
        scale *= 2
    return sorted((a, e, q) for (a, e), q in runs.found.items())


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """For each text, given as its words, ``start, length, period`` of its runs."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    codes = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
    owner = np.repeat(np.arange(len(texts)), sizes)
    words = codes.indices.to_numpy().astype(np.int64) + owner * (len(codes.dictionary) + 1)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, e, q in find(words, ends):
        k = int(owner[a])
        out[k].append((a - int(ends[k] - sizes[k]), e - a, q))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that some run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return list(compress(words, np.cumsum(change[:-1]) == 0))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs``.

    ``runs`` holds ``start, length, period`` in words, by start, then period; ``collapsed`` is the text
    without repeated periods, its words joined by one space. Words are runs of bytes other than space
    and tab to carriage return, compared as they are. A null or empty text has no words, no runs and an
    empty collapsed text. Rows are independent: null and repeated ids are kept, equal rows give equal
    results, no rows give none, and other columns of ``docs`` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in small_batches(batches):
            raw, ids = whole_bytes(batch.column("text")), batch.column("doc_id")
            for a, b in byte_slices(raw, SLICE_BYTES):
                texts = [t.split() for t in raw[a:b]]
                found = runs_of(texts)
                short = [b" ".join(collapse(t, r)) for t, r in zip(texts, found)]
                rows = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array(rows, kind), pa.array(short, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_words long, "
             "runs array<struct<start: long, length: long, period: long>>, collapsed string")


def plant_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, where one id in ten gets a long run, so that every scale has something to find.

    With h = crc32 of the decimal id and g = h // 10, a text of n > 0 words whose h is a multiple of 10
    repeats its p = 1 + (n - a) // (3 + g % 8) words from word a = g % n on. Texts of null ids stay.
    """
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    source = id_and_text(docs).select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    words = F.filter(F.split(null_to_empty(F.col("text")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def rotated(w: Column, g: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        places = F.sequence(F.lit(0).cast("long"), (n - 1).cast("long"))
        # concat_ws reads the array once; the words are one bound value, not split anew for each place
        return F.array_join(F.transform(places, lambda i: F.get(
            w, F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int"))), " ")

    bound = F.transform(F.array(F.struct(words.alias("w"), F.col("g").alias("g"))), lambda x: F.when(
        F.size(x["w"]) > 0, rotated(x["w"], x["g"])))
    planted = F.when(F.col("h") % 10 == 0, F.get(bound, F.lit(0)))
    return source.select("doc_id", F.coalesce(planted, F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """The columns by which the work on a document is compared: its runs, the longest, and digests.

    The longest run is the first by start, then period, of equal lengths; without a run its four
    columns are null and ``runs_sha256`` is that of an empty text.
    """
    order = F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period")))
    top = F.array_min(order)
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")),
        F.lit("\n")))
    best = found.withColumn("top", top)
    length, period = -F.col("top.l"), F.col("top.period")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"),
        length.alias("length"), period.alias("period"),
        F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(F.encode(F.array_join(lines, ""), "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"))
