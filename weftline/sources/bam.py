"""BAM files as a data source: whole files, and regions by their index.

A file with an index beside it (``x.bam.bai``) is cut where the index says that
records start, so its parts are read in parallel; without one a file is one part.
Blocks are inflated one at a time, so memory doesn't grow with the file. Files
are opened by URI in the executors, so any file system that Arrow knows will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from weftline.sources.readers import SAM_FIELDS

_NUMBERS = {"flag", "pos", "mapq", "mpos", "isize"}
#: The fields of SAM, tags as one string of tabs, and the last position on the reference by the cigar.
SCHEMA = ", ".join(f"{n} {'int' if n in _NUMBERS else 'string'}" for n in SAM_FIELDS) + ", tags string, ref_end int"
#: Compressed bytes of a part, and records of a batch.
SPLIT_BYTES, BATCH = 64 << 20, 10_000
# Fixed values of the format: letters of cigar operations and bases, tag types, the bin that holds counts.
CIGAR, BASES = "MIDNSHP=X", "=ACMGRSVTWYHKDBN"
NUMERIC = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
COUNTS_BIN = 37450


def opened(path: str):
    """The file behind a path or URI."""
    system, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system.open_input_file(name)


class Blocks:
    """The inflated bytes of a file from a virtual offset on, a block at a time."""

    def __init__(self, file, offset: int = 0):
        self.file = file
        self._load(offset >> 16)
        self.at = offset & 0xFFFF

    def _load(self, start: int) -> None:
        self.start, self.at, self.data, self.after = start, 0, b"", start
        self.file.seek(start)
        head = self.file.read(12)
        if not head:
            return
        if len(head) < 12 or head[:4] != b"\x1f\x8b\x08\x04":
            raise ValueError(f"no block begins at byte {start}")
        extra = self.file.read(struct.unpack_from("<H", head, 10)[0])
        at = 0
        while extra[at : at + 2] != b"BC":
            if at >= len(extra):
                raise ValueError(f"the block at byte {start} has no size")
            at += 4 + struct.unpack_from("<H", extra, at + 2)[0]
        size = struct.unpack_from("<H", extra, at + 4)[0] + 1
        body = self.file.read(size - 12 - len(extra))
        self.data, self.after = zlib.decompress(body[:-8], -15), start + size

    def _settle(self) -> bool:
        """Go to the next byte, past empty blocks; False at the end of the file."""
        while self.at >= len(self.data):
            if self.after == self.start:
                return False
            self._load(self.after)
        return True

    def tell(self) -> int | None:
        return self.start << 16 | self.at if self._settle() else None

    def read(self, n: int) -> bytes:
        parts = []
        while n and self._settle():
            parts.append(self.data[self.at : self.at + n])
            self.at += len(parts[-1])
            n -= len(parts[-1])
        if n:
            raise ValueError("the file ends inside a record")
        return b"".join(parts)

    def number(self) -> int:
        return struct.unpack("<i", self.read(4))[0]


def header(file) -> tuple[list[str], int | None]:
    """Names of the references and the virtual offset of the first record."""
    blocks = Blocks(file)
    if blocks.read(4) != b"BAM\x01":
        raise ValueError("not a BAM file")
    blocks.read(blocks.number())
    names = []
    for _ in range(blocks.number()):
        names.append(blocks.read(blocks.number())[:-1].decode())
        blocks.number()
    return names, blocks.tell()


def index(data: bytes) -> list[tuple[dict[int, list[tuple[int, int]]], list[int]]]:
    """Per reference the chunks of its bins and its linear index."""
    if data[:4] != b"BAI\x01":
        raise ValueError("not a BAM index")
    at, out = 8, []
    for _ in range(struct.unpack_from("<i", data, 4)[0]):
        held: dict[int, list[tuple[int, int]]] = {}
        n_bins, at = struct.unpack_from("<i", data, at)[0], at + 4
        for _ in range(n_bins):
            number, n = struct.unpack_from("<Ii", data, at)
            flat = struct.unpack_from(f"<{2 * n}Q", data, at + 8)
            at += 8 + 16 * n
            if number != COUNTS_BIN:
                held[number] = list(zip(flat[::2], flat[1::2], strict=True))
        n = struct.unpack_from("<i", data, at)[0]
        out.append((held, list(struct.unpack_from(f"<{n}Q", data, at + 4))))
        at += 4 + 8 * n
    return out


def region_chunks(held: dict[int, list[tuple[int, int]]], linear: list[int], s: int, e: int) -> list[tuple[int, int]]:
    """Where the records that overlap s to e (from 1) may lie: disjoint ranges of virtual offsets."""
    lo, hi = max(s, 1) - 1, max(e, 1) - 1
    numbers = [b for k in range(6) for b in range(((1 << 3 * k) - 1) // 7 + (lo >> 29 - 3 * k), ((1 << 3 * k) - 1) // 7 + (hi >> 29 - 3 * k) + 1)]
    least = linear[min(lo >> 14, len(linear) - 1)] if linear else 0
    out: list[tuple[int, int]] = []
    for a, b in sorted(c for n in numbers for c in held.get(n, ()) if c[1] > least):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def _tags(data: bytes) -> str:
    at, out = 0, []
    while at < len(data):
        name, kind = data[at : at + 2].decode(), chr(data[at + 2])
        at += 3
        if kind in "ZH":
            end = data.index(0, at)
            value, at = data[at:end].decode(), end + 1
        elif kind == "A":
            value, at = chr(data[at]), at + 1
        elif kind == "B":
            code = "<" + str(struct.unpack_from("<i", data, at + 1)[0]) + NUMERIC[chr(data[at])]
            value = ",".join([chr(data[at]), *(f"{x:g}" if code.endswith("f") else str(x) for x in struct.unpack_from(code, data, at + 5))])
            at += 5 + struct.calcsize(code)
        else:
            code = "<" + NUMERIC[kind]
            x = struct.unpack_from(code, data, at)[0]
            value, at, kind = f"{x:g}" if kind == "f" else str(x), at + struct.calcsize(code), "f" if kind == "f" else "i"
        out.append(f"{name}:{kind}:{value}")
    return "\t".join(out)


def record(data: bytes, names: list[str]) -> tuple:
    """The columns of SCHEMA from the bytes of a record after its size."""
    ref, pos, n_name, mapq, _, n_cigar, flag, n_seq, mate_ref, mate_pos, isize = struct.unpack_from("<iiBBHHHiiii", data)
    at = 32 + n_name
    ops = struct.unpack_from(f"<{n_cigar}I", data, at)
    at += 4 * n_cigar
    packed = data[at : at + (n_seq + 1) // 2]
    at += len(packed)
    seq = "".join(BASES[b >> 4] + BASES[b & 15] for b in packed)[:n_seq]
    raw = data[at : at + n_seq]
    qual = "*" if raw[:1] in (b"\xff", b"") else bytes(b + 33 for b in raw).decode()
    cigar = "".join(f"{x >> 4}{CIGAR[x & 15]}" for x in ops)
    length = sum(x >> 4 for x in ops if CIGAR[x & 15] in "MDN=X")
    name = lambda k: names[k] if k >= 0 else "*"
    mate = "=" if mate_ref == ref >= 0 else name(mate_ref)
    return data[32 : at - len(packed) - 4 * n_cigar - 1].decode(), flag, name(ref), pos + 1, mapq, cigar or "*", mate, mate_pos + 1, isize, seq or "*", qual, _tags(data[at + n_seq :]), pos + max(length, 1)


class Part(InputPartition):
    def __init__(self, path: str, ranges: list[tuple[int, int | None]]):
        super().__init__(None)
        self.path, self.ranges = path, ranges


class BamReader(DataSourceReader):
    def __init__(self, schema, options: dict[str, str]):
        self.schema = schema
        self.path = options["path"]
        self.split = int(options.get("split_bytes", SPLIT_BYTES))
        self.region = (options["reference"], int(options.get("start", 1)), int(options.get("end", 1 << 29))) if "reference" in options else None

    def _files(self) -> list[str]:
        system, name = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)
        if system.get_file_info(name).type != fs.FileType.Directory:
            return [self.path]
        found = system.get_file_info(fs.FileSelector(name))
        return sorted(f"{self.path.rstrip('/')}/{f.base_name}" for f in found if f.base_name.endswith(".bam"))

    def _index(self, path: str):
        try:
            with opened(path + ".bai") as file:
                return index(file.read())
        except FileNotFoundError:
            return None

    def partitions(self) -> list[Part]:
        out = []
        for path in self._files():
            with opened(path) as file:
                names, first = header(file)
            if first is None:
                continue
            held = self._index(path)
            if self.region and held is not None:
                if self.region[0] in names:
                    out += [Part(path, [c]) for c in region_chunks(*held[names.index(self.region[0])], *self.region[1:])]
                continue
            cuts = [first]
            for start in sorted({c[0] for bins, _ in held or () for chunks in bins.values() for c in chunks}):
                if (start >> 16) - (cuts[-1] >> 16) >= self.split:
                    cuts.append(start)
            out += [Part(path, [(a, b)]) for a, b in zip(cuts, [*cuts[1:], None], strict=True)]
        return out or [Part(self.path, [])]

    def _rows(self, part: Part) -> Iterator[tuple]:
        if not part.ranges:
            return
        with opened(part.path) as file:
            names, _ = header(file)
            for begin, end in part.ranges:
                blocks = Blocks(file, begin)
                while (at := blocks.tell()) is not None and (end is None or at < end):
                    row = record(blocks.read(blocks.number()), names)
                    if self.region:
                        name, s, e = self.region
                        if row[2] != name or row[3] > e or row[12] < s:
                            continue
                    yield row

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        columns = [(f.name, pa.int32() if f.dataType.typeName() == "integer" else pa.string()) for f in self.schema.fields]
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], t) for i, (_, t) in enumerate(columns)], names=[n for n, _ in columns])

        for row in self._rows(partition):
            held.append(row)
            if len(held) == BATCH:
                yield batch()
                held = []
        if held:
            yield batch()


class BamSource(DataSource):
    """Options: path (a file or a folder), reference, start, end (from 1, inclusive), split_bytes."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BamReader:
        return BamReader(schema, dict(self.options))


def bam(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """All records of a file or of a folder's files, as SAM columns and ref_end."""
    spark.dataSource.register(BamSource)
    return spark.read.format("bam").option("split_bytes", split_bytes).load(path)


def bam_region(spark: SparkSession, path: str, reference: str, s: int, e: int, strand: str | None = None) -> DataFrame:
    """The mapped records that overlap s to e (from 1) of a reference, of one strand if given.

    An index limits what is read; without one the whole file is.
    """
    spark.dataSource.register(BamSource)
    rows = spark.read.format("bam").option("reference", reference).option("start", s).option("end", e).load(path)
    minus, mapped = F.col("flag").bitwiseAND(0x10) != 0, F.col("flag").bitwiseAND(0x4) == 0
    rows = rows.where(mapped)
    return rows.where(minus == F.lit(strand == "-")) if strand else rows


def mates(rows: DataFrame) -> DataFrame:
    """name, read_end, seq, qual, minus, failed of paired records, as ``paired_mates`` takes them.

    Secondary and supplementary records are no reads of their own.
    """
    bit = lambda k: F.col("flag").bitwiseAND(k) != 0
    end = F.when(bit(0x40), 1).when(bit(0x80), 2)
    rows = rows.where(~bit(0x900)).withColumn("read_end", end).where("read_end IS NOT NULL")
    return rows.select(F.col("qname").alias("name"), "read_end", "seq", "qual", bit(0x10).alias("minus"), bit(0x200).alias("failed"))
