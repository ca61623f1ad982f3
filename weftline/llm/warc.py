"""WARC archives: a writer, a normaliser of whole-file gzip streams, a reader.

The writer puts records into archives that are one gzip stream each. The
normaliser inflates such a stream once, rewrites every record as a member of
its own and writes a sidecar index of offsets. The reader seeks by that index
and inflates single members. Archives are bounded in bytes and records, so a
task holds one record and one index at a time.

Files carry names of their own for every attempt, and only those that a
finished task reports are used, so lost executors leave at most orphans.

Defined results: a null payload is empty; of records with equal payloads the
one with the largest page_id is the response (null ids smallest; among equal
ids the last written), all others revisit it; an empty table writes nothing and
gives no rows; payloads of any length are written whole, and a task holds one;
further columns don't matter, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.scratch import materialise, new_path
from weftline.llm.textbytes import arrays

ARCHIVE_BYTES = 32 << 20
ARCHIVE_RECORDS = 20_000
_CHUNK = 1 << 20
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
WRITTEN = "archive string, ordinal int, page_id long, payload_bytes long, payload_digest string"
INDEXED = "warc string, ordinal int, offset long, length long, record_type string"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def record(kind: str, page: str, uri: str, payload: bytes, mark: str, refers: str | None = None, size: int | None = None) -> bytes:
    """The bytes of a record; a revisit has no payload but states its size and digest."""
    block = _HTTP % len(payload) + payload if kind == "response" else b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Target-URI: {json.dumps(uri)[1:-1]}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{mark}", f"X-Payload-Length: {len(payload) if size is None else size}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(raw: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in raw.decode().split("\r\n")[1:])


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES, archive_records: int = ARCHIVE_RECORDS) -> DataFrame:
    """Write page_id, url, html into archives below path; one row per record written."""
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(path)
        out = name = deflate = None
        held, rows = 0, []

        def close() -> pa.RecordBatch:
            out.write(deflate.flush())
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), pa.array(range(len(rows)), pa.int32()), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True))], names=["archive", "ordinal", "page_id", "payload_bytes", "payload_digest"])

        for batch in stream:
            data, at = arrays(batch.column(2))
            for i, (page, url) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                payload = data[at[i] : at[i + 1]].tobytes()
                if out is None:
                    store.create_dir(root, recursive=True)
                    name = f"crawl-{uuid.uuid4().hex}.warc.gz"
                    out, deflate, held, rows = store.open_output_stream(f"{root}/{name}", compression=None), zlib.compressobj(1, zlib.DEFLATED, 31), 0, []
                mark = digest(payload)
                raw = record("response", "" if page is None else str(page), url or "", payload, mark)
                out.write(deflate.compress(raw))
                held += len(raw)
                rows.append((page, len(payload), mark))
                if held >= archive_bytes or len(rows) >= archive_records:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return pages.mapInArrow(run, WRITTEN)


def decide(written: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Rows of written with record_type and, for revisits, refers_to."""
    rank = F.struct(F.col("page_id").isNotNull().alias("has"), F.col("page_id").alias("page_id"), F.col("archive").alias("archive"), F.col("ordinal").alias("ordinal"))
    best = written.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes").agg(F.max(rank).alias("best"), F.count("*").alias("n"))
    best = best.where("n > 1").select(F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("b"), "best")
    rows = written.join(best, (F.col("payload_digest") == F.col("d")) & (F.col("payload_bytes") == F.col("b")), "left").drop("d", "b")
    first = F.col("best").isNull() | ((F.col("best.archive") == F.col("archive")) & (F.col("best.ordinal") == F.col("ordinal")))
    return rows.withColumn("record_type", F.when(first, "response").otherwise("revisit")).withColumn("refers_to", F.when(~first, F.col("best.page_id"))).drop("best")


def _spread(rows: DataFrame, file: str) -> DataFrame:
    """One partition per file on average: a few short rows stand for a whole archive."""
    return rows.repartition(max(1, rows.select(file).distinct().count()), file)


def inflated_records(source, size: int = _CHUNK) -> Iterator[tuple[bytes, bytes]]:
    """Header and block of every record of one whole-file gzip stream, in one pass."""
    inflate, kept, chunk = zlib.decompressobj(31), bytearray(), b""
    while True:
        # at most so many bytes come out at once, however well they were packed
        chunk = inflate.unconsumed_tail or source.read(size)
        kept += inflate.decompress(chunk, size) if chunk else inflate.flush()
        at = 0
        while (end := kept.find(b"\r\n\r\n", at)) >= 0:
            head = bytes(kept[at:end])
            length = int(headers(head)["Content-Length"])
            if len(kept) < end + 8 + length:
                break
            yield head, bytes(kept[end + 4 : end + 4 + length])
            at = end + 8 + length
        del kept[:at]
        if not chunk:
            if kept:
                raise ValueError("the archive ends inside a record")
            return


def normalise(decided: DataFrame, path: str, out_path: str) -> DataFrame:
    """Rewrite every archive with one member per record, and its sidecar index."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        store, root = filesystem(path)
        target, out_root = filesystem(out_path)
        target.create_dir(out_root, recursive=True)
        archive = group["archive"].iloc[0]
        group = group.sort_values("ordinal")
        refers = {int(o): None if pd.isna(r) else int(r) for o, t, r in zip(group["ordinal"], group["record_type"], group["refers_to"], strict=True) if t == "revisit"}
        name, offset, rows = f"normal-{uuid.uuid4().hex}.warc.gz", 0, []
        with store.open_input_stream(f"{root}/{archive}", compression=None) as source, target.open_output_stream(f"{out_root}/{name}", compression=None) as out:
            for ordinal, (head, block) in enumerate(inflated_records(source)):
                kind = "response"
                if ordinal in refers:
                    kind, h, to = "revisit", headers(head), refers[ordinal]
                    raw = record("revisit", h["WARC-Record-ID"][10:-1], json.loads(f'"{h["WARC-Target-URI"]}"'), b"", h["WARC-Payload-Digest"][5:], "" if to is None else str(to), int(h["X-Payload-Length"]))
                else:
                    raw = head + b"\r\n\r\n" + block + b"\r\n\r\n"
                deflate = zlib.compressobj(1, zlib.DEFLATED, 31)
                member = deflate.compress(raw) + deflate.flush()
                out.write(member)
                rows.append((name, ordinal, offset, len(member), kind))
                offset += len(member)
        with target.open_output_stream(f"{out_root}/{name}.idx", compression=None) as out:
            out.write("".join(f"{json.dumps(dict(zip(('ordinal', 'offset', 'length', 'type'), r[1:], strict=True)))}\n" for r in rows).encode())
        return pd.DataFrame(rows, columns=["warc", "ordinal", "offset", "length", "record_type"])

    rows = decided.select("archive", "ordinal", "record_type", "refers_to")
    return _spread(rows, "archive").groupBy("archive").applyInPandas(run, INDEXED)


def read_archives(index: DataFrame, path: str) -> DataFrame:
    """Every record of normalised archives, one member at a time, found by each archive's sidecar.

    ``index`` only says which archives there are; offsets come from the sidecars.
    """

    def number(urn: str) -> int | None:
        return int(urn) if urn else None

    def run(group: pd.DataFrame) -> pd.DataFrame:
        store, root = filesystem(path)
        rows = []
        archive = group["warc"].iloc[0]
        with store.open_input_stream(f"{root}/{archive}.idx", compression=None) as sidecar:
            places = [json.loads(line) for line in sidecar.read().decode().splitlines()]
        with store.open_input_file(f"{root}/{archive}") as source:
            for place in places:
                source.seek(place["offset"])
                raw = zlib.decompress(source.read(place["length"]), 31)
                end = raw.index(b"\r\n\r\n")
                h = headers(raw[:end])
                page, kind = number(h["WARC-Record-ID"][10:-1]), h["WARC-Type"]
                size, mark, to = int(h["X-Payload-Length"]), h["WARC-Payload-Digest"][5:], None
                if kind == "response":
                    block = raw[end + 4 : end + 4 + int(h["Content-Length"])]
                    payload = block[block.index(b"\r\n\r\n") + 4 :]
                    if len(payload) != size or digest(payload) != mark:
                        raise ValueError(f"page {page}: its payload is not what its header states")
                else:
                    to = number(h["WARC-Refers-To"][10:-1])
                rows.append((page, size, mark, kind, to))
        made = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        return made.astype({"page_id": "Int64", "refers_to": "Int64"})

    return _spread(index.select("warc").distinct(), "warc").groupBy("warc").applyInPandas(run, READ)


def round_trip(pages: DataFrame, min_bytes: int = 0, **bounds) -> DataFrame:
    """Write pages, decide revisits, normalise, and read every record back."""
    spark = pages.sparkSession
    raw, normal = new_path(spark, "warc-raw"), new_path(spark, "warc-normal")
    written = materialise(write_archives(pages, raw, **bounds), "warc-written")
    index = materialise(normalise(decide(written, min_bytes), raw, normal), "warc-index")
    return read_archives(index, normal)


def op6_warc_pages(spark, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


OP6_SQL = """
WITH d AS (SELECT page_id, html, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, unhex(sha1(coalesce(html, ''))) AS b,
                  max(page_id) OVER (PARTITION BY coalesce(html, '')) AS best FROM pages),
bits AS (SELECT *, bitstring(b::BIT::VARCHAR, 160)::VARCHAR AS s FROM d)
SELECT page_id, payload_bytes,
       list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (substr(s, 1 + 5 * i, 1)::INT * 16 + substr(s, 2 + 5 * i, 1)::INT * 8 + substr(s, 3 + 5 * i, 1)::INT * 4 + substr(s, 4 + 5 * i, 1)::INT * 2 + substr(s, 5 + 5 * i, 1)::INT)::INT, 1) FOR i IN range(32)], 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> best THEN best END AS refers_to
FROM bits
"""
