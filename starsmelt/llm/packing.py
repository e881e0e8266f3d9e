"""Sequence packing, shortest pack first over the length histogram.

Texts become token ids and then pieces of at most ``size`` ids. Only the histogram of piece lengths
is packed, on the driver: lengths are placed longest first, each into the packs that are shortest
so far, and packs that are filled alike are one pattern with a count, so the work depends on
``size`` and not on the number of documents. Pieces get their place by their rank among the pieces
of the same length.
"""

from __future__ import annotations

import bisect
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starsmelt.llm.common import (
    byte_slices,
    chunk_codes,
    id_and_text,
    ragged,
    stage,
    small_batches,
    whole_bytes,
)

#: Distinct chunks whose ids a Python worker remembers.
CACHE_CHUNKS = 120_000
#: ``part`` and ``nth`` number the pieces of one length within the task that made them.
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, nth long")
PLACES = "sequence_id long, offset long"


def _cuts() -> np.ndarray:
    """Pairs of neighbouring ASCII bytes that the tokenizer never keeps in one word.

    White space ends a word. A letter and a sign are never in one word, apart from apostrophes
    (``'s``) and the signs of special tokens.
    """
    space = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
    letter = np.zeros(256, bool)
    letter[0x41:0x5B] = letter[0x61:0x7B] = True
    sign = np.zeros(256, bool)
    sign[0x21:0x80] = True
    sign &= ~letter & ~np.isin(np.arange(256), [ord(c) for c in "'<|>"])
    return (space[None, :] & ~space[:, None] | letter[:, None] & sign[None, :]
            | sign[:, None] & letter[None, :]).ravel()


_CUT = _cuts()
_BLANK = np.arange(256, dtype=np.uint8)
_BLANK[9:14] = 0x20
_LOWER = _BLANK.copy()
_LOWER[0x41:0x5B] += 0x20


class WordEncoder:
    """Ids of texts under a tokenizer that lower-cases and drops white space.

    Equal chunks have equal ids, so each distinct chunk of a batch is encoded once; a bounded
    cache carries ids from batch to batch.
    """

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        probe = "Aé b's\t3, x"
        parts = [self._ids([p])[0] for p in ("aé", " b's", "\t3", ",", " x")]
        if list(np.concatenate(parts)) != list(self._ids([probe])[0]):
            raise ValueError(f"{tokenizer_file}: words must be encoded apart and in lower case")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a word
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.cache: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32)
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _chunk_ids(self, chunks: list[bytes]) -> None:
        """Put the ids of new chunks into the cache.

        Chunks of letters only have at least one word each. They are encoded many in a text; if
        that has as many word ends as chunks, every chunk is one word and the ends part them.
        """
        texts = [c.decode().strip(" ") for c in chunks]
        plain = [k for k, text in enumerate(texts) if text.isalpha()]
        groups = [plain[at:at + 100] for at in range(0, len(plain), 100)]
        alone = [k for k, text in enumerate(texts) if not text.isalpha()]
        for group, ids in zip(groups, self._ids([" ".join(texts[k] for k in g) for g in groups])):
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(group):
                alone += group
                continue
            data, begin = ids.tobytes(), 0
            for k, end in zip(group, (4 * ends).tolist()):
                self.cache[chunks[k]] = data[begin:end]
                begin = end
        for k, ids in zip(alone, self._ids([texts[k] for k in alone])):
            self.cache[chunks[k]] = ids.tobytes()

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text begins among them (one entry more)."""
        data = b"".join(texts)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        if not data:
            return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        # a special token is written in lower case; other case must not become one
        raw = (_BLANK if b"<|" in data else _LOWER)[np.frombuffer(data, np.uint8)]
        first = np.append(True, _CUT[raw[:-1].astype(np.int32) * 256 + raw[1:]])
        first[bounds[:-1][bounds[:-1] < len(raw)]] = True
        starts = np.flatnonzero(first)
        codes, chunks = chunk_codes(raw.tobytes(), starts)
        cache = self.cache
        if len(cache) > CACHE_CHUNKS:
            cache.clear()
        new = [c for c in chunks if c not in cache]
        for at in range(0, len(new), 10_000):
            self._chunk_ids(new[at:at + 10_000])
        ids = [cache[c] for c in chunks]
        for chunk in new:
            if len(chunk) > 64:
                del cache[chunk]
        sizes = np.array([len(x) for x in ids], np.int64) // 4
        flat = np.frombuffer(b"".join(ids), np.uint32)
        width = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(width)])
        return (flat[ragged((np.cumsum(sizes) - sizes)[codes], width)],
                ends[np.searchsorted(starts, bounds)])


@lru_cache(maxsize=2)
def encoder(tokenizer_file: str) -> WordEncoder:
    return WordEncoder(tokenizer_file)


def token_pieces(docs: DataFrame, tokenizer_file: str, end_id: int = 1, size: int = 2048,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``size`` ids of every document; ``end_id`` closes each document.

    A long document is cut every ``size`` ids, so only its last piece is shorter. A null or empty
    text is the end id alone. Repeated rows and null ids are documents like any other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = encoder(tokenizer_file)
        part = TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        for batch in small_batches(batches):
            texts = whole_bytes(batch.column("text"))
            doc_ids = batch.column("doc_id").to_pylist()
            out: list[tuple] = []
            for a, b in byte_slices(texts):
                ids, bounds = words.encode(texts[a:b])
                ids = np.insert(ids, bounds[1:], end_id).astype("<u4")
                bounds = bounds + np.arange(len(bounds))
                for k, doc_id in enumerate(doc_ids[a:b]):
                    lo, hi = int(bounds[k]), int(bounds[k + 1])
                    for at in range(lo, hi, size):
                        length = min(size, hi - at)
                        out.append((doc_id, at - lo, length,
                                    zlib.crc32(ids[at:at + length]), hi - lo, part, seen[length]))
                        seen[length] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*out) if out else [()] * 7)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, PIECES)


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Slots ``(length, first rank, count, first sequence, offset)`` for all pieces.

    A pattern is a run of consecutive sequences that hold the same lengths. Pieces of the current
    length go one each to the sequences of the emptiest pattern that has room, until none is left;
    where no pattern has room, as many sequences are opened as the rest needs. A length splits at
    most one pattern and opens at most one, so there are at most twice as many patterns as lengths
    and the slots of a pattern have ``size`` ids at most: a bound that no corpus changes.
    """
    by_room: dict[int, list[tuple[int, int]]] = {}  # room -> patterns (first sequence, count)
    rooms: list[int] = []
    slots, sequences = [], 0

    def put(room: int, first: int, count: int) -> None:
        if room not in by_room:
            by_room[room] = []
            bisect.insort(rooms, room)
        by_room[room].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            if rooms and rooms[-1] >= length:
                room = rooms[-1]
                first, count = by_room[room].pop()
                if not by_room[room]:
                    del by_room[rooms.pop()]
            else:
                room, first = size, sequences
                count = -(-left // (size // length))
                sequences += count
            used = min(count, left)
            slots.append((length, rank, used, first, size - room))
            rank, left = rank + used, left - used
            if room > length:
                put(room - length, first, used)
            if count > used:
                put(room, first + used, count - used)
    return slots


def pack(pieces: DataFrame, size: int = 2048) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; sequences have no gaps and no overlaps.

    Pieces are numbered per length: by the task that made them, then in its order. ``pieces`` must
    be a staged table, for it is read for the counts and again for the places.
    """
    counts = pieces.groupBy("length", "part").agg(F.max("nth").alias("last"))
    # one row for each task and length, so a length that many pieces share has few rows here
    order = Window.partitionBy("length").orderBy("part")
    before = F.sum(F.col("last") + 1).over(order.rowsBetween(Window.unboundedPreceding, -1))
    bases = stage(counts.select("length", "part", "last", F.coalesce(before, F.lit(0)).alias("base")),
                  "bases")
    histogram = {r["length"]: r["n"] for r in  # at most `size` rows
                 bases.groupBy("length").agg(F.sum(F.col("last") + 1).alias("n")).collect()}
    slots = sorted(shortest_pack_first(histogram, size))
    table = np.array(slots, np.int64).reshape(-1, 5)

    @F.pandas_udf(PLACES)
    def place(length, rank):
        import pandas as pd

        length, rank = length.to_numpy(), rank.to_numpy()
        out = np.zeros((len(rank), 2), np.int64)
        order = np.argsort(length, kind="stable")
        edges = np.flatnonzero(np.diff(length[order])) + 1
        for group in np.split(order, edges) if len(order) else []:
            value = length[group[0]]
            lo, hi = np.searchsorted(table[:, 0], [value, value + 1])
            row = lo + np.searchsorted(table[lo:hi, 1], rank[group], side="right") - 1
            out[group, 0] = table[row, 3] + rank[group] - table[row, 1]
            out[group, 1] = table[row, 4]
        return pd.DataFrame({"sequence_id": out[:, 0], "offset": out[:, 1]})

    ranked = pieces.join(bases.drop("last"), ["length", "part"])
    spot = place("length", F.col("base") + F.col("nth"))
    return (ranked.withColumn("spot", spot)
            .select(*[c for c in pieces.columns if c not in ("part", "nth")], "spot.*"))


def pack_documents(docs: DataFrame, tokenizer_file: str, end_id: int = 1, size: int = 2048,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Every id of every document lies in one piece, and every piece in one sequence of at most
    ``size`` ids. An empty table gives no rows. Columns other than the two named are not read.
    """
    pieces = stage(token_pieces(docs, tokenizer_file, end_id, size, id_col, text_col), "pieces")
    return pack(pieces, size)
