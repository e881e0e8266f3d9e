"""Vector codes of four bytes: each quarter of a vector is replaced by its nearest codebook entry.

The nearest entry is found by slice and intersect. For every dimension the codebook keeps its
coordinates in order, and for every prefix of that order a bit mask of the entries in it. A radius,
the distance to the nearest of a few first guesses, cuts a range out of every dimension; the entries of
the range are the masks of its two ends, one without the other. The intersection over all dimensions,
four uint64 for 256 entries, holds every entry within the radius and so the nearest; distances are
computed for these candidates alone. All arithmetic is in integers.

Codebooks are learnt in rounds over all vectors. A task sends one sum and count for each entry, so the
driver gets 1,024 rows of a quarter's components whatever the input, and sends back codebooks of the
same size.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsmelt.llm.common import stage

PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Components are scaled by this before they are cut to integers.
SCALE = 1024
#: Vectors that are compared at once.
AT_ONCE = 1024


class Codebook:
    """The entries of one part position, ready for searching; 256 at most."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        size, dims = entries.shape
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, order, axis=0)
        self.order = order
        words = -(-size // 64)
        one = np.zeros((size, words), np.uint64)
        at = np.arange(size)
        one[at, at // 64] = np.uint64(1) << (at % 64).astype(np.uint64)
        self.prefix = np.zeros((dims, size + 1, words), np.uint64)
        for d in range(dims):
            self.prefix[d, 1:] = np.bitwise_or.accumulate(one[order[:, d]], axis=0)

    def _radius(self, x: np.ndarray) -> np.ndarray:
        """A distance, rounded up, within which there is an entry: the nearest of one guess a dimension."""
        best = None
        for d in range(x.shape[1]):
            at = np.minimum(np.searchsorted(self.sorted[:, d], x[:, d]), len(self.entries) - 1)
            far = ((x - self.entries[self.order[at, d]]) ** 2).sum(axis=1)
            best = far if best is None else np.minimum(best, far)
        root = np.sqrt(best.astype(np.float64)).astype(np.int64)
        root = np.where(root * root > best, root - 1, root)  # sums beyond 2**53 round in a double
        return np.where(root * root < best, root + 1, root)

    def candidates(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries that differ by ``radius`` at most in every dimension."""
        mask = None
        for d in range(x.shape[1]):
            low = np.searchsorted(self.sorted[:, d], x[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], x[:, d] + radius, "right")
            part = self.prefix[d, high] & ~self.prefix[d, low]
            mask = part if mask is None else mask & part
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry for every row, the lower of equals, and its squared distance."""
        index, error = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        for a in range(0, len(x), AT_ONCE):
            some = x[a:a + AT_ONCE]
            mask = self.candidates(some, self._radius(some))
            bits = np.unpackbits(np.ascontiguousarray(mask).view(np.uint8), axis=1, bitorder="little")
            row, entry = np.nonzero(bits)
            far = ((some[row] - self.entries[entry]) ** 2).sum(axis=1)
            first = np.searchsorted(row, np.arange(len(some)))
            least = np.minimum.reduceat(far, first)
            hit = np.flatnonzero(far == least[row])
            index[a + row[hit[::-1]]] = entry[hit[::-1]]  # the lowest of equals is written last
            error[a:a + len(some)] = least
        return index, error


@dataclass(frozen=True)
class Codes:
    """``rows``: ``vec_id, label, code, error``; ``books``: the final entries, by part."""

    rows: DataFrame
    books: list[np.ndarray]

    def sha256(self) -> str:
        """Digest of all entries' components, by part, entry and place, joined by commas."""
        text = ",".join(str(x) for book in self.books for x in book.ravel().tolist())
        return hashlib.sha256(text.encode()).hexdigest()


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str = "label") -> DataFrame:
    """``vec_id, label, v`` of the rows whose vector is there and has finite components only."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return vectors.filter(F.col(vector_col).isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
        F.transform(vector_col, lambda x: F.floor(x.cast("double") * SCALE)).alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors as rows. All have ``dims`` components, and squares of differences fit 62 bits."""
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes != dims).any():
        raise ValueError(f"vectors of {sorted(set(sizes.tolist()))} components, expected {dims}")
    found = column.flatten().to_numpy().reshape(-1, dims)
    limit = math.isqrt((1 << 62) // dims) // 2
    if len(found) and max(int(found.max()), -int(found.min())) > limit:
        raise ValueError(f"a component beyond {limit / SCALE:g}")
    return found


def _assign(found: np.ndarray, books: list[Codebook]) -> tuple[np.ndarray, np.ndarray]:
    """Index of each part, a column for each, and the squared distances of all parts summed."""
    size = found.shape[1] // PARTS
    index, error = np.empty((len(found), PARTS), np.int64), np.zeros(len(found), np.int64)
    for k, book in enumerate(books):
        index[:, k], far = book.nearest(found[:, k * size:(k + 1) * size])
        error += far
    return index, error


def _sums(vectors: DataFrame, entries: list[np.ndarray], dims: int) -> list[np.ndarray]:
    """The next entries: the floor of the mean of the parts that each is nearest to."""
    size = dims // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(e) for e in entries]
        count = np.zeros((PARTS, ENTRIES), np.int64)
        total = np.zeros((PARTS, ENTRIES, size), np.int64)
        for batch in batches:
            found = _matrix(batch.column("v"), dims)
            index, _ = _assign(found, books)
            for k in range(PARTS):
                np.add.at(total[k], index[:, k], found[:, k * size:(k + 1) * size])
                count[k] += np.bincount(index[:, k], minlength=ENTRIES)
        part, entry = np.nonzero(count)
        values = total[part, entry].ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(part, size)), pa.array(np.repeat(entry, size)),
             pa.array(np.tile(np.arange(size), len(part))), pa.array(np.repeat(count[part, entry], size)),
             pa.array(values)], names=["part", "entry", "place", "n", "total"])

    # decimals, so that sums over any number of tasks are exact
    rows = vectors.select("v").mapInArrow(run, "part long, entry long, place long, n long, total long").groupBy(
        "part", "entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("t"))
    moved = [e.copy() for e in entries]
    for r in rows.collect():  # at most PARTS * ENTRIES * size rows, whatever the input
        moved[r["part"]][r["entry"], r["place"]] = int(r["t"]) // r["n"]
    return moved


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str = "label") -> Codes:
    """Codes of all vectors, and the codebooks they refer to.

    Rows whose vector is null, or holds a null or a component that is not finite, are left out. The
    codebooks begin as the parts of the 256 smallest ids, nulls last, equal ids by their vectors; with
    fewer rows there are fewer entries. Null and repeated ids and null labels are kept, no rows give no
    rows and empty codebooks, and other columns of ``vectors`` are not read. Vectors must be of one
    length, a multiple of 4 and at least 4, and of components below about 2**29 / sqrt(length) after
    scaling is undone; others raise, so that no sum can overflow.
    """
    kept = stage(integers(vectors, id_col, vector_col, label_col), "vectors")
    first = [r["v"] for r in kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).collect()]
    dims = len(first[0]) if first else PARTS
    if not dims or dims % PARTS:
        raise ValueError(f"vectors of {dims} components cannot be cut into {PARTS} equal parts")
    if any(len(v) != dims for v in first):
        raise ValueError(f"vectors of {sorted({len(v) for v in first})} components, expected one length")
    start = np.array(first, np.int64).reshape(len(first), dims)
    entries = np.split(start, PARTS, axis=1)
    for _ in range(ROUNDS if first else 0):
        entries = _sums(kept, entries, dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(e) for e in entries]
        for batch in batches:
            index, error = _assign(_matrix(batch.column("v"), dims), books)
            code = [row.tobytes().hex() for row in index.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error)],
                names=["vec_id", "label", "code", "error"])

    label = kept.schema["label"].dataType.simpleString()
    rows = kept.mapInArrow(run, f"vec_id long, label {label}, code string, error long")
    return Codes(rows, entries)


def digest(codes: Codes) -> DataFrame:
    """The codes with the error of each label, nulls together, and the digest of the codebooks.

    A label's sum is one row for each task before it moves, and joins back without a hint: Spark
    broadcasts the sums if they are few and splits a hot label otherwise.
    """
    rows = stage(codes.rows, "codes")
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    sums = stage(sums, "label-errors")
    return rows.join(sums, rows["label"].eqNullSafe(sums["of"]), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(codes.sha256()).alias("codebooks_sha256"))


def _round_sql(k: int) -> str:
    """Assignment to the entries of round k, and the entries that follow."""
    return f"""
, near{k} AS MATERIALIZED (
  SELECT p.r, p.part, arg_min(e.entry, (list_sum(list_transform(list_zip(p.v, e.v),
      lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e.entry)) AS entry
  FROM parts p JOIN book{k} e USING (part) GROUP BY p.r, p.part
), means{k} AS (
  SELECT part, entry, list(m ORDER BY place) AS v FROM (
    SELECT part, entry, place, (sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*) AS m
    FROM (SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS place
      FROM near{k} JOIN parts USING (r, part))
    GROUP BY part, entry, place) GROUP BY part, entry
), book{k + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m.v, b.v) AS v FROM book{k} b LEFT JOIN means{k} m USING (part, entry))"""


#: The digest in DuckDB, for vectors of one length.
SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT r, part, v[part * len(v) // {PARTS} + 1:(part + 1) * len(v) // {PARTS}] AS v
  FROM kept, range({PARTS}) AS t(part)
), book0 AS MATERIALIZED (
  SELECT part, r - 1 AS entry, v FROM parts WHERE r <= {ENTRIES}
)""" + "".join(_round_sql(k) for k in range(ROUNDS)) + f"""
, last AS MATERIALIZED (
  SELECT p.r, p.part, min((list_sum(list_transform(list_zip(p.v, e.v),
      lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e.entry)) AS best
  FROM parts p JOIN book{ROUNDS} e USING (part) GROUP BY p.r, p.part
), coded AS (
  SELECT r, string_agg(lower(printf('%02x', CAST(best[2] AS INTEGER))), '' ORDER BY part) AS code,
    CAST(sum(best[1]) AS BIGINT) AS error
  FROM last GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM book{ROUNDS})
    AS codebooks_sha256
FROM coded JOIN kept USING (r)"""
