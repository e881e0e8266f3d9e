"""Line de-duplication: explode normalised lines, hash, count documents, drop, reassemble.

Lines are exploded within a task into one row for each document and distinct key; the key travels
as a 128-bit hash. A document keeps all its lines whose key is short or rare, or for which it is
the first holder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from starsmelt.llm.common import id_and_text, small_batches, whole_bytes

#: White space that is stripped from both ends of a line.
BLANKS = b" \t\n\x0b\x0c\r"
KEYS = "doc_id long, k1 long, k2 long"


def _key(line: bytes) -> bytes:
    return line.strip(BLANKS).lower()  # bytes.lower folds ASCII letters only


def _points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode())


def _hash(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def line_keys(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """``doc_id, k1, k2``: the distinct keys of each row's lines, short ones left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            ids, hashes = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                    whole_bytes(batch.column("text"))):
                keys = {k for k in map(_key, text.split(b"\n"))
                        if len(k) >= min_chars and _points(k) >= min_chars}
                ids += [doc_id] * len(keys)
                hashes += map(_hash, keys)
            parts = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(parts[:, 0]), pa.array(parts[:, 1])],
                names=["doc_id", "k1", "k2"])

    return docs.mapInArrow(run, KEYS)


def dropped_keys(keys: DataFrame, min_docs: int = 2) -> DataFrame:
    """``doc_id, drop``: for each document the hashes of its lines that go.

    A key goes from all documents but the smallest id if ``min_docs`` documents hold it. Counts
    are added up before they are shuffled; a key that very many documents hold is joined by Spark's
    adaptive splitting. ``drop`` is as long as the document has lines, at most.
    """
    held = keys.distinct() if min_docs != 2 else keys
    owners = held.groupBy("k1", "k2").agg(
        F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"),
        F.count(F.lit(1)).alias("docs"))
    # two documents hold a key exactly if the smallest and the largest id differ
    common = owners.filter("owner < last" if min_docs == 2 else f"docs >= {int(min_docs)}")
    lost = (keys.join(common, ["k1", "k2"]).filter("doc_id <> owner").select("doc_id", "k1", "k2"))
    return lost.groupBy("doc_id").agg(F.collect_set(F.struct("k1", "k2")).alias("drop"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 10, min_docs: int = 2, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, text``, the columns of ``keep``, ``n_lines, n_dropped`` for every row.

    ``text`` has the lines that stay.

    Lines end at line feeds; a null or empty text is one empty line, which stays (a null text
    becomes empty). A key is a line without blanks at its ends and with ASCII letters in lower
    case. Keys of at least ``min_chars`` code points that at least ``min_docs`` documents hold stay
    only in the document with the smallest id, there as often as it has them. Rows with the same
    id are one document for the count and one row each in the result. Rows with a null id count
    for no key and lose no line.
    """
    named = id_and_text(docs, id_col, text_col).filter("doc_id IS NOT NULL")
    drops = dropped_keys(line_keys(named, min_chars), min_docs)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                         *[F.col(name).alias(f"kept_{k}") for k, name in enumerate(keep)])
    passed = [f"kept_{k}" for k in range(len(keep))]
    fields = [StructField("doc_id", LongType()), StructField("text", StringType()),
              *(source.schema[name] for name in passed),
              StructField("n_lines", LongType()), StructField("n_dropped", LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts, lines, lost = [], [], []
            for text, drop in zip(whole_bytes(batch.column("text")), batch.column("drop").to_pylist()):
                own = text.split(b"\n")
                kept = own
                if drop:
                    gone = {np.array([d["k1"], d["k2"]]).tobytes() for d in drop}
                    kept = [x for x in own if len(k := _key(x)) < min_chars or _hash(k) not in gone]
                texts.append(b"\n".join(kept))
                lines.append(len(own))
                lost.append(len(own) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string()),
                 *(batch.column(name) for name in passed),
                 pa.array(lines, pa.int64()), pa.array(lost, pa.int64())],
                names=["doc_id", "text", *passed, "n_lines", "n_dropped"])

    result = source.join(drops, "doc_id", "left").mapInArrow(run, StructType(fields))
    return result.toDF("doc_id", "text", *keep, "n_lines", "n_dropped")


def digest(deduped: DataFrame) -> DataFrame:
    return deduped.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[ \t-\r]+|[ \t-\r]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (
  SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING min(doc_id) < max(doc_id))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (owner <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (owner IS NULL OR owner = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN common USING (key) GROUP BY doc_id
"""
