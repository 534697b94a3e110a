"""WARC archives: records written with an index first, and read back by coalesced byte ranges.

Each task writes one archive through the file system of the shared folder and returns an index row per record
(archive, offset, length, URL, digest). Only index rows of tasks that Spark committed reach the index table, so
an archive left by a lost or repeated attempt is never read. A reader selects index rows, sorts them by archive
and offset, joins neighbours to larger ranges, and fetches only those.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closewright.llm.shared import new_path

RESPONSE, REVISIT = "response", "revisit"
#: Ranges closer than this are read as one; no range grows beyond this unless a single record does.
GAP_BYTES, RANGE_BYTES = 64 << 10, 8 << 20
ID_PREFIX = "urn:x-page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ESCAPED_URI = "X-Target-URI-Escaped"
_PLAIN_URL = re.compile(r"[^\x00-\x20\x7f-\xa0\ud800-\udfff]+")
BATCH = 500
INDEX = "archive string, offset long, length long, page_id long, url string, payload_digest string, record_type string"
READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload string"


def with_record_type(pages: DataFrame, key: str = "page_id", payload: str = "html", url: str = "url", least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload and refers_to (null for a response) of each row.

    Of equal payloads of at least `least_bytes` bytes, the row with the smallest id is the response and the others
    refer to it. A null payload is empty. Rows that share the smallest id and the payload are all responses; a null
    id is never the smallest, and if all ids of a payload are null, all its rows are responses. The smallest id is
    aggregated before the join, and the join key is derived anew, so that a hot payload can be split over tasks.
    """
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("payload"))
    rows = rows.withColumn("same", F.sha2(F.encode("payload", "UTF-8"), 256))
    large = F.octet_length("payload") >= least_bytes
    first = rows.filter(large).groupBy("same").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1")
    first = first.select(F.concat("same", F.lit("|")).alias("same_key"), "first_id")
    keyed = rows.withColumn("same_key", F.concat("same", F.lit("|")))
    joined = keyed.join(first, "same_key", "left")
    revisits = large & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select("page_id", "url", "payload", F.when(revisits, F.col("first_id")).alias("refers_to"))


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> tuple[bytes, str]:
    """One gzip member that holds one record, and the payload's digest. A revisit keeps the full length in its HTTP head."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {RESPONSE if refers_to is None else REVISIT}", f"WARC-Record-ID: <{ID_PREFIX}{'' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        # A URL that no header line can hold as it stands is kept escaped.
        plain = _PLAIN_URL.fullmatch(url)
        head.append(f"WARC-Target-URI: {url}" if plain else f"{ESCAPED_URI}: {quote(url, safe='')}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{ID_PREFIX}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 1, mtime=0), digest


def parsed(member: bytes) -> tuple:
    """Fields of one record, in the order of READ; the payload of a revisit is null."""
    whole = gzip.decompress(member)
    head, _, rest = whole.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this offset")
    told = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(told["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    full = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    number = lambda name: int(told[name][len(ID_PREFIX) + 1 : -1] or -1) if len(told.get(name, "")) > len(ID_PREFIX) + 2 else None
    kind, digest = told["WARC-Type"], told["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == RESPONSE and (len(payload) != full or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError("payload does not match its record")
    url = unquote(told[ESCAPED_URI]) if ESCAPED_URI in told else told.get("WARC-Target-URI")
    return number("WARC-Record-ID"), url, full, digest, kind, number("WARC-Refers-To"), payload.decode() if kind == RESPONSE else None


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write rows of `with_record_type` as archives below `folder`; the index, read back from its table there."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        name, out, at = f"{uuid.uuid4().hex}.warc.gz", None, 0
        try:
            for batch in batches:
                found = []
                for page_id, url, payload, refers_to in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                    if out is None:
                        store.create_dir(f"{root}/archives", recursive=True)
                        out = store.open_output_stream(f"{root}/archives/{name}", compression=None)
                    member, digest = record_bytes(page_id, url, payload.encode(), refers_to)
                    out.write(member)
                    found.append((name, at, len(member), page_id, url, digest, RESPONSE if refers_to is None else REVISIT))
                    at += len(member)
                yield index_batch(found)
        finally:
            if out is not None:
                out.close()

    spark = rows.sparkSession
    # Batches of few rows: a record can hold a very long text.
    rows.mapInArrow(write, INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def index_batch(found: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    names = [x.split()[0] for x in INDEX.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)], names=names)


def read_records(index: DataFrame, folder: str, where: Column | None = None) -> DataFrame:
    """Records of the selected index rows (all, without `where`), one row each, in the columns of READ.

    Rows are dealt by archive and block of RANGE_BYTES, sorted by offset; within a task neighbours are fetched in
    one read. The number of tasks follows the bytes to read, not those of the index. An empty selection reads nothing.
    """
    chosen = index if where is None else index.filter(where)
    chosen = chosen.select("archive", "offset", "length", F.floor(F.col("offset") / RANGE_BYTES).alias("block"))
    total = chosen.agg(F.sum("length")).first()[0] or 0
    dealt = chosen.repartition(max(1, -(-total // RANGE_BYTES)), "archive", "block").sortWithinPartitions("archive", "offset")
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    names = [x.split()[0] for x in READ.split(", ")]

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        archive, members = None, []
        for batch in batches:
            for name, offset, length in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if members and (name != archive or offset - sum(members[-1]) > GAP_BYTES or offset + length - members[0][0] > RANGE_BYTES):
                    yield archive, members
                    members = []
                archive = name
                members.append((offset, length))
        if members:
            yield archive, members

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for archive, members in ranges(batches):
            begin = members[0][0]
            with store.open_input_file(f"{root}/archives/{archive}") as f:
                held = f.read_at(sum(members[-1]) - begin, begin)
            for k in range(0, len(members), BATCH):
                rows = [parsed(held[o - begin : o - begin + n]) for o, n in members[k : k + BATCH]]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)], names=names)

    return dealt.mapInArrow(read, READ)


def archived(spark: SparkSession, pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write every page to archives in the shared folder and read all records back. No page, no archive, no row."""
    folder = new_path(spark, "warc")
    index = write_archives(with_record_type(pages, least_bytes=least_bytes), folder)
    return read_records(index, folder)
