"""Web archives: pages to WARC records, and one globally ordered index of all captures.

**Writing.** Payloads that occur more than once are found from digests alone; of these, the record of
the smallest page id is a ``response``, and the others are ``revisit`` records that refer to it and hold
its HTTP header without the payload. Every record is a gzip member of its own, and a task closes an
archive at a size that any reader can hold, so a lost executor costs the archives of its tasks only.

**Indexing.** An archive is read whole, each payload is checked against its digest, and its captures,
sorted by URL key and timestamp, are one run. The runs are merged outside memory: Spark cuts the order
into ranges of about equal size, by keys that end in the place of the record, so that no URL is too
common to be cut; a task then merges the pieces of all runs that fall in its range with a tree of losers.
The ranges, one after another, are the history of every URL.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starsmelt.llm.common import shared_folder, small_batches, stage, whole_bytes

#: Compressed bytes at which a task closes an archive; a larger record has one of its own.
ARCHIVE_BYTES = 8 << 20
#: Captures of one range of the index, which one task merges.
RANGE = 50_000
LEVEL = 6
#: The time of captures whose table has none.
NO_TIME = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: A gzip member of nothing. It ends an archive, as the line separator of the writer.
_LAST = zlib.compressobj(LEVEL, wbits=31).flush()
_FEED = 1 << 16

CAPTURE = ("page_id long, url string, urlkey string, timestamp string, record_type string, refers_to long, "
           "payload_digest string, payload_bytes long, archive string, offset long, size long")


def url_key(url: str | None) -> str:
    """Sort key of a URL: host turned round, no scheme, ``www.``, usual port or fragment, arguments in
    order. A text that is no URL is its own key in lower case; null is an empty key."""
    text = (url or "").strip()
    try:
        parts = urlsplit(text)
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return text.lower()
    if not host:
        return text.lower()
    host = host.removeprefix("www.")
    turned = ",".join(reversed(host.split(".")))
    port_text = f":{port}" if port not in (None, 80, 443) else ""
    query = "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    return f"{turned}{port_text}){(parts.path or '/').lower()}{'?' + query.lower() if query else ''}"


def _page(value: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"null" if value is None else b"%d" % value)


def _page_id(value: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
    return int(found[1]) if found else None


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, time: str, payload: bytes, first: int | None,
           revisit: bool) -> bytes:
    """One WARC record, compressed. A revisit keeps the HTTP header, with the payload's length."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
            % len(payload))
    head = [b"WARC/1.0", b"WARC-Type: " + (b"revisit" if revisit else b"response"),
            b"WARC-Record-ID: " + _page(page_id), b"WARC-Date: " + time.encode(),
            b"WARC-Payload-Digest: sha1:" + _digest(payload).encode(),
            b"Content-Type: application/http; msgtype=response"]
    if url is not None:  # a URL has no blanks or control characters; whatever else it has is kept
        safe = "".join(c if c > " " and c != "\x7f" else quote(c) for c in url)
        head.append(b"WARC-Target-URI: " + safe.encode())
    if revisit:
        head += [b"WARC-Refers-To: " + _page(first), b"WARC-Profile: " + _PROFILE.encode()]
    block = http if revisit else http + payload
    head.append(b"Content-Length: %d" % len(block))
    pack = zlib.compressobj(LEVEL, wbits=31)
    return pack.compress(b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def members(archive: bytes) -> Iterator[tuple[int, int, bytes]]:
    """``offset, size, content`` of every gzip member; the input is fed in parts, never copied whole."""
    view, at = memoryview(archive), 0
    while at < len(view):
        unpack, parts, end = zlib.decompressobj(wbits=31), [], at
        while not unpack.eof:
            if end >= len(view):
                raise ValueError(f"the gzip member at {at} is cut off")
            part = view[end:end + _FEED]
            parts.append(unpack.decompress(part))
            end += len(part) - len(unpack.unused_data)
        content = b"".join(parts)
        if content:
            yield at, end - at, content
        at = end


def parse(content: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields of a WARC record in lower case, its HTTP header, and its payload, by their lengths."""
    end = content.index(b"\r\n\r\n")
    version, *lines = content[:end].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]}")
    fields = {name.lower(): value for name, value in (line.split(": ", 1) for line in lines)}
    block = content[end + 4:end + 4 + int(fields["content-length"])]
    if content[end + 4 + len(block):] != b"\r\n\r\n":
        raise ValueError(f"wrong length of record {fields.get('warc-record-id')}")
    cut = block.index(b"\r\n\r\n") + 4
    return fields, block[:cut], block[cut:]


def _payload(html_col: str) -> Column:
    return F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")


def repeated_payloads(pages: DataFrame, id_col: str, html_col: str, least: int) -> DataFrame:
    """``payload, first``: SHA-256 and smallest page id of payloads of ``least`` bytes that occur again.

    Only digests and ids are shuffled, and a payload that fills a third of the table is one row a task.
    """
    payload = _payload(html_col)
    keys = pages.filter(F.octet_length(payload) >= least).select(
        F.unhex(F.sha2(payload, 256)).alias("payload"), F.col(id_col).cast("long").alias("id"))
    found = keys.groupBy("payload").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    return stage(found.filter("n > 1").select("payload", "first"), "repeated")


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   time_col: str | None = None, least: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Write every row as a record and return the folder of the archives, in the shared store.

    Of rows with equal payloads of at least ``least`` bytes, those with the smallest id are responses and
    the others revisits; a null id comes last, and rows that repeat the smallest id are all responses. A
    null payload is empty, a null URL is left out, a null or absent time is ``NO_TIME``. Other columns are
    not read. The join with the repeated payloads has no hint: few are broadcast, more are sorted, where
    Spark splits a payload that very many rows share.
    """
    spark = pages.sparkSession
    repeated = repeated_payloads(pages, id_col, html_col, least)
    time = F.coalesce(F.col(time_col).cast("string"), F.lit(NO_TIME)) if time_col else F.lit(NO_TIME)
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), time.alias("time"),
        _payload(html_col).alias("html"))
    key = F.when(F.octet_length("html") >= least, F.unhex(F.sha2("html", 256)))
    marked = rows.withColumn("key", key).join(repeated, F.col("key") == F.col("payload"), "left")
    # null-safe, so that rows without any id stay responses
    revisit = F.col("payload").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    typed = marked.select("id", "url", "time", "html", "first", revisit.alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["content"])

        for batch in small_batches(batches, "html"):
            names = ("id", "url", "time", "first", "revisit")
            columns = [batch.column(c).to_pylist() for c in names]
            for html, (page, url, at, first, again) in zip(whole_bytes(batch.column("html")), zip(*columns)):
                held.append(record(page, url, at, html, first, again))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield archive()
                    held, size = [], 0
        if held:
            yield archive()

    path = f"{shared_folder(spark)}/llm-warc-{uuid.uuid4().hex[:12]}"
    # one row, one file: the text writer puts the bytes as they are and commits whole tasks only
    typed.mapInArrow(run, "content binary").select(F.col("content").cast("string")).write.option(
        "maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option(
        "lineSep", _LAST.decode("latin-1")).text(path)
    _forget(spark, path)
    return path


def _forget(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)


def _order(capture: dict) -> tuple:
    page = capture["page_id"]
    return (capture["urlkey"], capture["timestamp"], page is None, page or 0, capture["archive"], capture["offset"])


def read_captures(spark: SparkSession, folder: str) -> DataFrame:
    """A row for every record of the archives, with its ``run`` and ``place`` in it.

    An archive is a run: its captures sorted by URL key, timestamp, page id and place of the record. The
    digest of a response is taken from its payload and must be the one it states; a revisit states those
    of the payload it refers to.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in batches:
            for path, archive in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows = []
                for offset, size, content in members(archive.as_py()):
                    fields, http, payload = parse(content)
                    kind, stated = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                    length = int(re.search(rb"\r\nContent-Length: (\d+)\r\n", http)[1])
                    if kind == "response" and (_digest(payload) != stated or len(payload) != length):
                        raise ValueError(f"damaged payload of {fields['warc-record-id']} in {path}")
                    url = fields.get("warc-target-uri")
                    rows.append({
                        "page_id": _page_id(fields["warc-record-id"]), "url": url, "urlkey": url_key(url),
                        "timestamp": re.sub("[^0-9]", "", fields["warc-date"])[:14], "record_type": kind,
                        "refers_to": _page_id(fields.get("warc-refers-to")), "payload_digest": stated,
                        "payload_bytes": length, "archive": path, "offset": offset, "size": size})
                rows.sort(key=_order)
                for place, row in enumerate(rows):
                    row["place"] = place
                schema = schema or pa.schema([*_arrow(CAPTURE), ("place", pa.int64())])
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(run, f"{CAPTURE}, place long")


def _arrow(ddl: str) -> list[tuple[str, pa.DataType]]:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return [(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(", "))]


class LoserTree:
    """Merges sorted runs: every inner node keeps the loser of its match, the root the next of all.

    Taking one element replays the path of its run, one comparison for each doubling of the runs.
    """

    def __init__(self, runs: list[list], key):
        self.runs, self.key = runs, key
        self.at = [0] * len(runs)
        self.heads = [self._head(k) for k in range(len(runs))]
        self.losers = [-1] * max(1, len(runs))
        for k in range(len(runs)):
            self._replay(k)

    def _head(self, k: int) -> tuple:
        """The next key of a run, after all others where the run has ended; no two are equal."""
        run, at = self.runs[k], self.at[k]
        return (0, self.key(run[at]), k) if at < len(run) else (1, k)

    def _replay(self, k: int) -> None:
        node = (k + len(self.runs)) // 2
        while node:
            if self.losers[node] < 0:  # while the tree is built, the first to come waits
                self.losers[node] = k
                return
            if self.heads[self.losers[node]] < self.heads[k]:
                self.losers[node], k = k, self.losers[node]
            node //= 2
        self.losers[0] = k

    def __iter__(self) -> Iterator:
        while self.runs:
            k = self.losers[0]
            if self.at[k] == len(self.runs[k]):
                return
            yield self.runs[k][self.at[k]]
            self.at[k] += 1
            self.heads[k] = self._head(k)
            self._replay(k)


def merge_index(captures: DataFrame, rows_per_range: int = RANGE) -> DataFrame:
    """The captures in global order by URL key, timestamp, page id and place: by ``range``, ``position``.

    ``captures`` are sorted runs as :func:`read_captures` gives them. The number of ranges follows the
    number of captures, so a task's memory does not grow with the corpus.
    """
    kept = stage(captures, "captures")
    ranges = max(1, -(-kept.count() // rows_per_range))
    cut = kept.repartitionByRange(
        ranges, F.col("urlkey"), F.col("timestamp"), F.col("page_id").asc_nulls_last(), F.col("archive"),
        F.col("offset"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list[dict]] = {}
        for batch in batches:  # by run and place, so every piece arrives in its order
            for row in batch.to_pylist():
                runs.setdefault(row["archive"], []).append(row)
        here = TaskContext.get().partitionId()
        merged, schema = [], pa.schema([*_arrow(CAPTURE), ("range", pa.int64()), ("position", pa.int64())])
        for position, row in enumerate(LoserTree(list(runs.values()), _order)):
            merged.append({**row, "range": here, "position": position})
            if len(merged) == 4096:
                yield pa.RecordBatch.from_pylist(merged, schema)
                merged = []
        yield pa.RecordBatch.from_pylist(merged, schema)

    return stage(cut.sortWithinPartitions("archive", "place").mapInArrow(
        run, f"{CAPTURE}, range long, position long"), "index")


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id, payload`` of the responses, for readers that want the pages back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("content"):
                for _, _, content in members(archive.as_py()):
                    fields, _, payload = parse(content)
                    if fields["warc-type"] == "response":
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([_page_id(fields["warc-record-id"])], pa.int64()),
                             pa.array([payload], pa.binary())], names=["page_id", "payload"])

    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(run, "page_id long, payload binary")


def digest(index: DataFrame) -> DataFrame:
    """What the archives say of every page, through the index."""
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_BITS = "list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(" \
        "(('0x' || substr(digest, 1 + 10 * (i // 8), 10))::BIGINT >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31 " \
        "AS INTEGER), 1))"
SQL = f"""
WITH page AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages
), typed AS (
  SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM page
)
SELECT page_id, strlen(html) AS payload_bytes, array_to_string({_BITS}, '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM typed"""
