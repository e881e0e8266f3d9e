"""Token counts by byte-pair merging with a heap over a linked list of symbols.

A text is cut where no vocabulary piece spans the cut, so merges never cross it and equal chunks
have equal counts. Each distinct chunk is merged once for a batch; a bounded cache carries counts
from batch to batch. No identifiers are made: the count is the initial symbols less the merges,
where a symbol that stays outside the vocabulary counts its UTF-8 bytes.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsmelt.llm.common import byte_slices, chunk_codes, id_and_text, range_sums, small_batches, whole_bytes

SPACE = "▁"
#: Distinct chunks whose counts a Python worker remembers.
CACHE_CHUNKS = 400_000
SLICE_BYTES = 8 << 20
SCHEMA = "doc_id long, n_bytes long, n_tokens long"


class PieceMerger:
    """Counts the pieces that a sentencepiece BPE model with byte fallback makes of a text.

    The model must keep texts as they are but for a space put in front of a text that is not
    empty; any other normalisation raises ValueError.
    """

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        probe = "  ﬁ\tÁ\n x  "
        if model.normalize(probe) != (" " + probe).replace(" ", SPACE) or not model.is_byte(3):
            raise ValueError(f"{model_file}: only identity normalisation with byte fallback")
        kept = [i for i in range(model.get_piece_size())
                if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        order = sorted(kept, key=lambda i: (-model.get_score(i), i))
        self.rank = {model.id_to_piece(i): at for at, i in enumerate(order)}
        joined = np.zeros((256, 256), bool)  # last byte of a character, first byte of the next
        for piece in self.rank:
            parts = [c.encode() for c in piece.replace(SPACE, " ")]
            for left, right in zip(parts, parts[1:]):
                joined[left[-1], right[0]] = True
        joined[:, 0x80:0xC0] = True  # within a character
        self.cut = ~joined.ravel()
        self.cache: dict[bytes, int] = {}

    def merge(self, chunk: str) -> int:
        symbols = list(chunk.replace(" ", SPACE))
        n, rank = len(symbols), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        best = [-1] * n  # rank of the pair that starts at a symbol
        heap = []
        for at in range(n - 1):
            r = rank(symbols[at] + symbols[at + 1])
            if r is not None:
                best[at] = r
                heap.append((r, at))
        heapq.heapify(heap)
        while heap:
            r, at = heapq.heappop(heap)
            if best[at] != r:
                continue  # one of the two symbols has been merged since
            gone = after[at]
            symbols[at] += symbols[gone]
            symbols[gone] = ""
            best[at] = best[gone] = -1
            after[at] = follow = after[gone]
            if follow < n:
                before[follow] = at
                r = rank(symbols[at] + symbols[follow])
                if r is not None:
                    best[at] = r
                    heapq.heappush(heap, (r, at))
            lead = before[at]
            if lead >= 0:
                r = rank(symbols[lead] + symbols[at])
                best[lead] = -1 if r is None else r
                if r is not None:
                    heapq.heappush(heap, (r, lead))
        return sum(1 if x in self.rank else len(x.encode()) for x in symbols if x)

    def counts(self, texts: list[bytes]) -> np.ndarray:
        literal = SPACE.encode()
        texts = [b" " + t.replace(literal, b" ") if t else t for t in texts]
        data = b"".join(texts)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        if not data:
            return np.zeros(len(texts), np.int64)
        raw = np.frombuffer(data, np.uint8)
        pairs = raw[:-1].astype(np.int32) * 256 + raw[1:]
        first = np.append(True, self.cut[pairs])
        first[bounds[:-1][bounds[:-1] < len(raw)]] = True
        starts = np.flatnonzero(first)
        codes, chunks = chunk_codes(data, starts)
        cache = self.cache
        if len(cache) > CACHE_CHUNKS:
            cache.clear()
        sizes = np.empty(len(chunks), np.int64)
        for at, chunk in enumerate(chunks):
            size = cache.get(chunk)
            if size is None:
                size = self.merge(chunk.decode())
                if len(chunk) < 64:
                    cache[chunk] = size
            sizes[at] = size
        return range_sums(sizes[codes], np.searchsorted(starts, bounds))


@lru_cache(maxsize=2)
def merger(model_file: str) -> PieceMerger:
    """One vocabulary for each Python worker."""
    return PieceMerger(model_file)


def count_tokens(docs: DataFrame, model_file: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` for every row, as the model's own library counts them.

    Begin and end tokens are not counted; strings that look like them are ordinary text. A null or
    empty text has 0 bytes and 0 tokens. Repeated rows, null ids and extra columns are allowed:
    every input row gives one output row, in no order. There is no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = merger(model_file)
        for batch in small_batches(batches):
            texts = whole_bytes(batch.column("text"))
            found = [counter.counts(texts[a:b]) for a, b in byte_slices(texts, SLICE_BYTES)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array(np.concatenate(found) if found else [], pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def with_limit(counted: DataFrame, limit: int = 4096) -> DataFrame:
    """``over_limit``: the text has more than ``limit`` tokens."""
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
