"""Quality classifier on supervised subword embeddings.

A text's features are its words, the byte 3- to 5-grams of each word between boundary marks, and
pairs of neighbouring words, all hashed into one table of learned vectors. A text is the average of
its feature vectors, a softmax over two classes gives the score, and stochastic gradient descent in
numpy trains both. A trained model scores with one number for each bucket, because everything
behind the average is linear.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from starsmelt.llm.common import (
    byte_slices,
    chunk_codes,
    id_and_text,
    null_to_empty,
    ragged,
    range_sums,
    small_batches,
    whole_bytes,
)

_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled texts that are fitted; labels beyond it are not read.

    Few labels are gone through more than ``epochs`` times, for ``least_steps`` steps in all.
    """

    sample: int = 4000
    buckets_log2: int = 16
    dimensions: int = 8
    epochs: int = 6
    least_steps: int = 4000
    rate: float = 20.0
    seed: int = 7


def _bucket(values: np.ndarray, bits: int) -> np.ndarray:
    return ((values * _MIX) >> np.uint64(64 - bits)).astype(np.int32)


class Features:
    """Hashed features of a batch of texts, by distinct word and by pair of neighbours."""

    def __init__(self, texts: list[bytes], bits: int):
        data = b" ".join(texts) + b" "
        raw = np.frombuffer(data, np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        blank = _SPACE[raw]
        starts = np.flatnonzero(~blank & np.append(True, blank[:-1]))  # a word and the blanks behind
        self.words_at = np.searchsorted(starts, bounds)
        if not len(starts):
            self.codes = np.empty(0, np.int32)
            chunks = []
        else:
            self.codes, chunks = chunk_codes(data[starts[0]:], starts - starts[0])
        words = [c.rstrip(b" \t\n\x0b\x0c\r") for c in chunks]
        hashes = np.array([zlib.crc32(w) for w in words], np.uint64)
        marked = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), np.uint8).astype(np.uint64)
        width = np.array([len(w) + 2 for w in words], np.int64)
        ends = np.cumsum(width)
        owner = np.repeat(np.arange(len(words)), width)
        left = np.repeat(ends, width) - np.arange(len(marked))  # bytes up to the word's end
        who, what = [np.arange(len(words))], [_bucket(hashes + np.uint64(1 << 56), bits)]
        gram = marked.copy()
        for n in range(2, 6):
            gram = gram[:len(gram) - 1] | marked[n - 1:] << np.uint64(8 * (n - 1))
            if n > 2:
                at = np.flatnonzero(left[:len(gram)] >= n)
                who.append(owner[at])
                what.append(_bucket(gram[at] + np.uint64(n << 57), bits))
        self.owner, self.bucket = np.concatenate(who), np.concatenate(what)
        # equal neighbours give 0 whatever the word, so that repetition is one feature
        pair = hashes[self.codes[:-1]] ^ hashes[self.codes[1:]]
        inner = np.ones(len(pair), bool)
        inner[self.words_at[(self.words_at > 0) & (self.words_at < len(self.codes))] - 1] = False
        self.pair_at = np.flatnonzero(inner)
        self.pair = _bucket(pair[inner], bits)

    def sums(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text the sum of its features' weights, and how many features it has."""
        n = int(self.owner.max()) + 1 if len(self.owner) else 0
        of_word = np.bincount(self.owner, weights=weights[self.bucket], minlength=n)
        size = np.bincount(self.owner, minlength=n)
        pairs_at = np.searchsorted(self.pair_at, self.words_at)
        return (range_sums(of_word[self.codes], self.words_at) + range_sums(weights[self.pair], pairs_at),
                range_sums(size[self.codes], self.words_at) + np.diff(pairs_at))

    def rows(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text its distinct buckets and how often each occurs."""
        order = np.argsort(self.owner, kind="stable")
        bucket = self.bucket[order]
        size = np.bincount(self.owner)
        first = np.cumsum(size) - size
        pairs_at = np.searchsorted(self.pair_at, self.words_at)
        for k in range(len(self.words_at) - 1):
            codes, times = np.unique(self.codes[self.words_at[k]:self.words_at[k + 1]], return_counts=True)
            own = bucket[ragged(first[codes], size[codes])] if len(codes) else np.empty(0, np.int32)
            pairs = self.pair[pairs_at[k]:pairs_at[k + 1]]
            both = np.concatenate([own, pairs])
            counts = np.concatenate([np.repeat(times, size[codes]) if len(codes) else [], np.ones(len(pairs))])
            distinct, at = np.unique(both, return_inverse=True)
            yield distinct, np.bincount(at, weights=counts, minlength=len(distinct))


def _narrow(values: np.ndarray) -> bytes:
    """Whole numbers in 16 bits each where all fit, else in 32."""
    fits = not len(values) or values.max() < 1 << 16
    return values.astype(np.uint16 if fits else np.uint32).tobytes()


def _widened(raw: pa.Buffer, n: int) -> np.ndarray:
    """A view of the ``n`` numbers that ``_narrow`` packed."""
    return np.frombuffer(raw, np.uint32 if raw.size == 4 * n else np.uint16)


@dataclass(frozen=True)
class Model:
    """Weight of each bucket towards label 1, and the weight of no feature at all."""

    weights: np.ndarray
    bias: float
    bits: int

    def scores(self, texts: list[bytes]) -> np.ndarray:
        total, n = Features(texts, self.bits).sums(self.weights)
        logit = total / np.maximum(n, 1) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -40, 40)))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], settings: Settings) -> Model:
    """Gradient descent over ``(buckets, counts, label)``, one text at a time, in a fixed order."""
    rng = np.random.default_rng(settings.seed)
    size = 1 << settings.buckets_log2
    vectors = rng.uniform(-1, 1, (size, settings.dimensions)) / settings.dimensions
    out, bias = np.zeros((2, settings.dimensions)), np.zeros(2)
    epochs = max(settings.epochs, -(-settings.least_steps // max(1, len(rows))))
    steps, done = max(1, epochs * len(rows)), 0
    for _ in range(epochs if rows else 0):
        for k in rng.permutation(len(rows)):
            buckets, counts, label = rows[k]
            share = counts / max(1.0, counts.sum())
            mean = share @ vectors[buckets]
            logit = out @ mean + bias
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[label] -= 1.0
            rate = 1.0 - done / steps
            back = p @ out
            out -= 0.5 * rate * np.outer(p, mean)
            bias -= 0.05 * rate * p
            vectors[buckets] -= settings.rate * rate * share[:, None] * back
            done += 1
    return Model((vectors @ (out[1] - out[0])), float(bias[1] - bias[0]), settings.buckets_log2)


def held_out(id_col: Column) -> Column:
    """Rows that no model may learn from: CRC-32 of the id as text leaves 1 over 3."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> Model:
    """A model of ``label_col``, learned from labelled texts that are not held out.

    At most ``settings.sample`` labels are used, those with the smallest MD5 of the id; a label
    given twice counts once and null labels or ids do not count. Of rows with the same id the text
    with the smallest MD5 is fitted, once. Features are made by the tasks, and the driver gets at
    most ``1 << buckets_log2`` buckets for each sampled text. Without labels every score is 0.5.
    """
    usable = labels.select(F.col(id_col).cast("long").alias("doc_id"),
                           F.col(label_col).cast("int").alias("label")).filter(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    chosen = (usable.groupBy("doc_id").agg(F.min("label").alias("label"))
              .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(settings.sample))
    bits = settings.buckets_log2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = whole_bytes(batch.column("text"))
            ids, given = batch.column("doc_id").to_pylist(), batch.column("label").to_pylist()
            for a, b in byte_slices(texts):
                found = list(Features(texts[a:b], bits).rows())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a:b], pa.int64()), pa.array(given[a:b], pa.int32()),
                     pa.array([len(x) for x, _ in found], pa.int32()),
                     pa.array([_narrow(x) for x, _ in found], pa.binary()),
                     pa.array([_narrow(x) for _, x in found], pa.binary())],
                    names=["doc_id", "label", "n", "buckets", "counts"])

    # the sample has a bound, so it may be broadcast to the texts
    text = null_to_empty(F.col("text"))
    one = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.first("label").alias("label"),
        F.min(F.struct(F.md5(text).alias("hash"), text.alias("text"))).alias("least"))
    sample = one.select("doc_id", "label", "least.text").mapInArrow(
        run, "doc_id long, label int, n int, buckets binary, counts binary")
    found = sample.toArrow()
    rows = [(_widened(buckets.as_buffer(), n), _widened(counts.as_buffer(), n), label)
            for buckets, counts, n, label in zip(found["buckets"], found["counts"],
                                                 found["n"].to_pylist(), found["label"].to_pylist())]
    # rows are put in order as views: sorting the table would copy it
    rows = [rows[k] for k in np.argsort(found["doc_id"].to_numpy(), kind="stable")]
    return train(rows, settings)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          keep: tuple[str, ...] | None = None) -> DataFrame:
    """``doc_id, score`` for every row: the chance of label 1 by the text alone.

    Null and empty texts have no features and get the score of the bias. There is no shuffle. With
    ``keep``, the rows also have the text and the named columns, unchanged, before the score.
    """
    plain = keep is None
    source = id_and_text(docs, id_col, text_col) if plain else docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *keep)
    fields = source.schema.fields[:1] if plain else source.schema.fields
    schema = StructType([*fields, StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = whole_bytes(batch.column("text"))
            found = [model.scores(texts[a:b]) for a, b in byte_slices(texts)]
            scores = pa.array(np.concatenate(found) if found else [], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(fields)], scores], names=schema.names)

    return source.mapInArrow(run, schema)
