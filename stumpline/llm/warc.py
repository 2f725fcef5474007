"""WARC archives of pages and their index, merged from locally sorted runs.

Every Spark partition sorts its captures by URL key and time and writes them as WARC 1.1 files (one gzip stream
each) through Spark's writer, so any store Spark writes to will do. Of captures with equal payloads of at least
``MIN_REVISIT`` bytes, that with the smallest page_id is a response and the others are revisits without payload.
Archives are bounded by records and by bytes: captures are written by class of size, the larger the fewer to a file,
and a page that is larger than an archive should be has one to itself.
Each archive, read back record by record, is a sorted run of the index. The runs are cut at common ranges of key,
page, run and place, so that captures with one key are cut as well, and every range is merged by a loser tree into
the globally ordered capture history.

Pages have no capture time, so ``EPOCH`` plus the page's id in seconds serves as one. A null html is an empty
payload, a null url an empty one. A null page_id is never the one referred to unless all its copies have none;
fully repeated rows are equal records. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stumpline.llm.common import bounded_batches, written
from stumpline.session import shared_folder

EPOCH = "2024-01-01T00:00:00Z"
MIN_REVISIT = 0
#: Records of one archive, their bytes before compression, and rows of one merge, at most about.
ARCHIVE_RECORDS = 20_000
ARCHIVE_BYTES = 512 << 20
MERGE_ROWS = 100_000
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = "run string, seq long, page_id long, url_key string, captured string, payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean"


def base32_sha1(payload: str) -> Column:
    """Upper-case base32 of the SHA-1 of a string's UTF-8 bytes."""
    hexed = F.sha1(F.col(payload))
    digits = [F.lpad(F.conv(F.substring(hexed, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.upper(F.concat(*digits)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def url_key(url: str) -> Column:
    """Host labels reversed, then the rest: ``http://a.b.org/x`` is ``org,b,a)/x``."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def captures(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Pages with payload digest, type and the page a revisit refers to."""
    seconds = F.unix_timestamp(F.lit(EPOCH), "yyyy-MM-dd'T'HH:mm:ssX") + F.coalesce("page_id", F.lit(0))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumns({
        "digest": base32_sha1("payload"), "bytes": F.octet_length("payload").cast("long"), "url_key": url_key("url"),
        "captured": F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    })
    large = rows.filter(F.col("bytes") >= min_revisit).select("page_id", "digest", "bytes")
    first = large.groupBy("digest", "bytes").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = large.join(first, ["digest", "bytes"]).filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    again = written(again.select(F.col("page_id").alias("p"), F.col("digest").alias("d"), "refers_to").distinct(), "revisits")
    return rows.join(again, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")), "left").drop("p", "d")


def _size_class(archive_records: int, archive_bytes: int) -> Column:
    """0 where ``archive_records`` such captures fit an archive; every class above has 16 times larger ones."""
    size = F.col("bytes") + 3 * F.octet_length("url") + 1_024
    fits = [(archive_bytes // archive_records) << 4 * k for k in range(archive_records.bit_length() // 4 + 1)]
    return sum((F.when(size > most, 1).otherwise(0) for most in fits), F.lit(0))


def write_archives(found: DataFrame, path: str, archive_records: int = ARCHIVE_RECORDS, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write captures as WARC files below ``path``; each file is sorted by URL key, time and page."""
    end = "\r\n"
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{end}Content-Type: text/html; charset=utf-8{end}Content-Length: "), F.col("bytes").cast("string"), F.lit(end * 2))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    name = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    fields = [
        ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", name("page_id")),
        ("WARC-Date", F.col("captured")),
        ("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", "")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        ("X-URL-Key", F.regexp_replace("url_key", r"[\r\n]", "")),
        ("X-Payload-Length", F.col("bytes").cast("string")),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", F.octet_length("block").cast("string")),
    ]
    head = [F.lit("WARC/1.1\r\n"), *[F.concat(F.lit(f"{k}: "), v, F.lit(end)) for k, v in fields]]
    more = F.when(revisit, F.concat(F.lit(f"WARC-Profile: {_PROFILE}{end}WARC-Refers-To: "), name("refers_to"), F.lit(end))).otherwise(F.lit(""))
    # The writer adds the last line feed.
    record = F.concat(*head, more, F.lit(end), F.col("block"), F.lit("\r\n\r")).alias("value")
    size_class = _size_class(archive_records, archive_bytes)
    for k in sorted(r.k for r in found.select(size_class.alias("k")).distinct().collect()) or [0]:
        alike = found.filter(size_class == k).withColumn("block", block)
        ordered = alike.sortWithinPartitions("url_key", "captured", "page_id").select(record)
        most = max(1, archive_records >> 4 * k)
        ordered.write.mode("append").option("maxRecordsPerFile", most).option("compression", "gzip").text(path)


def records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of a gzip archive, decompressed piece by piece."""
    held, at, rest = bytearray(), 0, archive
    zipped = zlib.decompressobj(31)

    def more() -> bool:
        nonlocal rest, zipped
        while rest:
            piece = zipped.decompress(rest, 1 << 20)
            rest = zipped.unconsumed_tail or zipped.unused_data
            if zipped.eof:
                zipped = zlib.decompressobj(31)
            if piece:
                held.extend(piece)
                return True
        return False

    while True:
        while (stop := held.find(b"\r\n\r\n", at)) < 0:
            if not more():
                if held[at:].strip():
                    raise ValueError("the archive ends within a record")
                return
        lines = held[at:stop].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no record begins here")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        begin = stop + 4
        end = begin + int(fields["Content-Length"])
        while len(held) < end + 4 and more():
            pass
        yield fields, bytes(held[begin:end])
        at = end + 4
        if at > 1 << 22:
            del held[:at]
            at = 0


def _page(name: str) -> int | None:
    number = name.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def read_archives(found: DataFrame) -> DataFrame:
    """Index rows of binary-file rows; ``intact`` tells whether a response's payload has the stated digest and length."""
    bounded_batches(found.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                out = []
                for seq, (h, block) in enumerate(records(content.as_py())):
                    digest, size = h["WARC-Payload-Digest"].removeprefix("sha1:"), int(h["X-Payload-Length"])
                    kind = h["WARC-Type"]
                    payload = block[block.index(b"\r\n\r\n") + 4 :]
                    intact = kind == "revisit" or (len(payload) == size and base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest)
                    refers = _page(h["WARC-Refers-To"]) if kind == "revisit" else None
                    out.append((path.as_py(), seq, _page(h["WARC-Record-ID"]), h["X-URL-Key"], h["WARC-Date"], size, digest, kind, refers, intact))
                    if len(out) == 10_000:
                        yield _batch(out)
                        out = []
                if out:
                    yield _batch(out)

    return found.select("path", "content").mapInArrow(run, _INDEX)


_TYPES = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
_FIELDS = [f.split() for f in _INDEX.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.record_batch([pa.array(c, _TYPES[t]) for c, (_, t) in zip(columns, _FIELDS, strict=True)], names=[n for n, _ in _FIELDS])


def merge_runs(runs: list[list[tuple]]) -> Iterator[tuple[int, int]]:
    """(run, place) of all keys of sorted runs in order, by a tree of losers; equal keys in order of run."""
    k = len(runs)
    at = [0] * k
    done = (1,)

    def head(i: int) -> tuple:
        return (0, runs[i][at[i]], i) if at[i] < len(runs[i]) else done

    heads = [head(i) for i in range(k)]
    loser: list[int | None] = [None] * max(1, k)
    winner = 0

    def play(i: int) -> int | None:
        """Send run i up the tree: the better one goes on, the other stays; None while a place was empty."""
        node = (i + k) // 2
        while node:
            other = loser[node]
            if other is None:
                loser[node] = i
                return None
            if heads[other] < heads[i]:
                loser[node], i = i, other
            node //= 2
        return i

    for i in range(k):
        winner = w if (w := play(i)) is not None else winner
    while k and heads[winner] != done:
        yield winner, at[winner]
        at[winner] += 1
        heads[winner] = head(winner)
        winner = play(winner)


def merged_history(index: DataFrame) -> DataFrame:
    """Index rows with ``position``, their place in the global order of URL key, time and page."""
    spark = index.sparkSession
    rows = index.count()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // MERGE_ROWS))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        run = table.column("run").to_pylist()
        page = [(p is not None, p or 0) for p in table.column("page_id").to_pylist()]
        keys = list(zip(table.column("url_key").to_pylist(), table.column("captured").to_pylist(), page, strict=True))
        cut = [0, *(i for i in range(1, len(run)) if run[i] != run[i - 1]), len(run)]
        order = [cut[r] + p for r, p in merge_runs([keys[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)])]
        out = table.take(order).append_column("seq_in_range", pa.array(range(len(order)), pa.int64()))
        yield from out.combine_chunks().to_batches()

    # Of equal keys the merge takes the earlier run first, so run and place may cut them without changing the order.
    sliced = index.repartitionByRange(ranges, "url_key", "captured", "page_id", "run", "seq").sortWithinPartitions("run", "seq")
    merged = sliced.mapInArrow(merge, _INDEX + ", seq_in_range long").withColumn("range", F.spark_partition_id())
    merged = written(merged, "history")
    # One row for each range, so a window without keys is small.
    sizes = merged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return merged.join(starts, "range").withColumn("position", F.col("start") + F.col("seq_in_range")).drop("start", "seq_in_range")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in the shared folder, read them back and merge their index."""
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/llm-warc-{uuid.uuid4().hex}"
    write_archives(captures(pages), path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    index = written(read_archives(files), "index")
    return merged_history(index).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "intact", "position"
    )
