"""Exact substring dedup over shards of suffix arrays built by induced sorting.

A byte goes if a string of ``length`` bytes that covers it also starts earlier.
Every such string has an owner: the leftmost smallest hash among its 32-byte
grams. Equal strings have equal owners, so the runs of strings with one owner,
dealt by the owner's hash, bring all copies of a string into one shard.

Equal runs are represented once, by their earliest occurrence; all others of
them are wholly repeated. That is settled among the documents of a task first,
so a run that very many documents share is not dealt out as often. Runs are
taken as equal by 64-bit hashes of them and of their owners both: among n runs
of one owner two different ones pass for equal with a probability below
n * n / 2**65. Runs that share an owner but differ are put, with
their bytes, into shard texts of bounded size. There a suffix array is induced,
permuted common prefixes of ``length`` group equal strings, and the earliest of
a group stays. An owner with more runs than a shard text holds has its strings
dealt by their own hashes instead, streamed in order.

Defined results: matches never cross documents; a null text is empty; a text
shorter than ``length`` is kept whole; null ids come before all others; rows
that share an id are separate documents in the order of their texts' digests,
equal ones too; an empty table gives no rows; texts of any length are read
whole; further columns don't matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.scratch import materialise
from weftline.llm.suffix import permuted_lcp, suffix_array
from weftline.llm.textbytes import U64, arrays, batches, byte_sums, mix

LENGTH = 100
GRAM = 32
#: Bytes of a shard text, and of one owner's runs before they are dealt by string.
SHARD_BYTES, OWNER_BYTES = 1 << 19, 4 << 20
#: Bytes whose runs are found, and compared with each other, at once.
SLICE_BYTES = 1 << 20
_FIRST = -(2**63)
_RUNS = "owner long, mark long, doc long, place long, shape int"
#: kind 0: a removed range of a document; 1: a run to compare; 2: a single string by hash
_FOUND = "kind int, owner long, doc long, place long, shape int"


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` entries in a row."""
    n = len(x)
    rows = -(-n // width) * width
    block = np.full(rows, np.iinfo(x.dtype).max, x.dtype)
    block[:n] = x
    block = block.reshape(-1, width)
    before = np.minimum.accumulate(block, axis=1).reshape(-1)
    after = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Owner hash, run hash, document, first string, and strings and owner offset of each run."""
    sums, inverse = byte_sums(data)
    n = len(data)
    whole = np.maximum(np.diff(offsets) - length + 1, 0)
    if not whole.sum():
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    doc = np.repeat(np.arange(len(whole)), whole)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(whole) - whole, whole) + offsets[doc]
    gram = mix((sums[GRAM:] - sums[:-GRAM]) * inverse[: n - GRAM + 1])
    shift = U64(int(n).bit_length())
    key = ((gram >> shift) << shift) | np.arange(len(gram), dtype=U64)
    owner = (_sliding_least(key, length - GRAM + 1)[start] & ((U64(1) << shift) - U64(1))).astype(np.int64)
    new = np.ones(len(owner), bool)
    new[1:] = owner[1:] != owner[:-1]
    at = np.flatnonzero(new)
    n_strings = np.diff(np.append(at, len(owner)))
    first, own = start[at], owner[at]
    shape = n_strings * 256 + (own - first)
    end = first + n_strings + length - 1
    mark = mix(((sums[end] - sums[first]) * inverse[first]) ^ mix(shape.astype(U64)))
    return gram[own].astype(np.int64), mark.astype(np.int64), doc[at], first - offsets[doc[at]], shape


def keyed(docs: DataFrame) -> DataFrame:
    """doc, variant, text: one key per row, also where ids repeat or are null."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias("doc"), F.col("text").cast("string").alias("text"))
    if rows.groupBy("doc").count().where("count > 1").isEmpty():
        return rows.select("doc", F.lit(0).cast("long").alias("variant"), "text")
    order = Window.partitionBy("doc").orderBy(F.sha2("text", 256))
    return rows.select("doc", (F.row_number().over(order) - 1).cast("long").alias("variant"), "text")


def all_runs(rows: DataFrame, length: int) -> DataFrame:
    """The runs of all documents; place holds the variant above 32 bits of offset.

    Of equal runs in a slice the later ones are known to go: their shape is
    negative and their owner a hash of their own, so that they are dealt evenly.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in batches(stream, "text", SLICE_BYTES):
            owner, mark, doc, first, shape = runs(data, offsets, length)
            ids, variants = batch.column(0).to_numpy()[doc], batch.column(1).to_numpy()[doc]
            place = (variants << 32) + first
            order = np.lexsort((place, ids, mark))
            again = (mark[order][1:] == mark[order][:-1]) & (owner[order][1:] == owner[order][:-1])
            # the same run stands behind the first one of its mark, or another run parts them
            late = order[1:][again]
            shape[late] *= -1
            owner[late] = mix(ids[late].astype(U64) * U64(0x9E3779B97F4A7C15) + place[late].astype(U64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(mark), pa.array(ids), pa.array(place), pa.array(shape, pa.int32())], names=["owner", "mark", "doc", "place", "shape"])

    return rows.mapInArrow(run, _RUNS)


def _found(kind: int, owner, doc, place, shape) -> pa.RecordBatch:
    n = len(doc)
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind), pa.int32()), pa.array(np.asarray(owner, np.int64)), pa.array(np.asarray(doc, np.int64)), pa.array(np.asarray(place, np.int64)), pa.array(np.asarray(shape), pa.int32())], names=["kind", "owner", "doc", "place", "shape"])


def sort_out(dealt: DataFrame, length: int) -> DataFrame:
    """From runs: ranges of equal later runs, and first runs whose owner has others.

    A stream sorted by owner, mark and place; only the row before is kept. Runs
    of negative shape pass as ranges.
    """
    rows = dealt.repartition("owner").sortWithinPartitions("owner", "mark", "doc", "place")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # owner, mark of the row before
        rep = None  # owner, doc, place, shape of the last first run, and whether it shares its owner
        for batch in stream:
            owner, mark, doc, place, shape = (batch.column(i).to_numpy() for i in range(5))
            known = shape < 0
            if known.any():
                yield _found(0, owner[known], doc[known], place[known], -shape[known] // 256 + length - 1)
                owner, mark, doc, place, shape = (x[~known] for x in (owner, mark, doc, place, shape))
            if not len(owner):
                continue
            first = np.ones(len(owner), bool)
            first[1:] = (owner[1:] != owner[:-1]) | (mark[1:] != mark[:-1])
            first[0] = last != (owner[0], mark[0])
            last = (owner[-1], mark[-1])
            late = ~first
            if late.any():
                yield _found(0, owner[late], doc[late], place[late], shape[late] // 256 + length - 1)
            cols = [x[first] for x in (owner, doc, place, shape)]
            shared = np.zeros(len(cols[0]), bool)
            shared[1:] = cols[0][1:] == cols[0][:-1]
            if len(shared):
                if rep is not None:
                    joined = rep[0][0] == cols[0][0]
                    shared[0] |= joined
                    if rep[1] or joined:
                        yield _found(1, *[[x] for x in rep[0]])
                shared[:-1] |= cols[0][1:] == cols[0][:-1]
                out = shared.copy()
                out[-1] = False
                if out.any():
                    yield _found(1, *[x[out] for x in cols])
                rep = (tuple(x[-1] for x in cols), shared[-1])
        if rep is not None and rep[1]:
            yield _found(1, *[[x] for x in rep[0]])

    return rows.mapInArrow(run, _FOUND)


def with_bytes(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of wanted runs, cut from their documents."""
    per_doc = wanted.groupBy("doc", (F.shiftright("place", 32)).alias("variant")).agg(F.collect_list(F.struct("owner", "place", "shape")).alias("runs"))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            if not batch.num_rows:
                continue
            data, offsets = arrays(batch.column(0))
            lists = batch.column(2)
            at = np.asarray(lists.offsets)
            flat = lists.values
            owner, place, shape = (flat.field(i).to_numpy()[at[0] : at[-1]] for i in range(3))
            doc = np.repeat(np.arange(batch.num_rows), np.diff(at))
            first = offsets[doc] + (place & 0xFFFFFFFF)
            size = shape // 256 + length - 1
            for lo in range(0, len(doc), 20_000):
                part = slice(lo, lo + 20_000)
                ends = np.cumsum(size[part])
                take = np.arange(ends[-1]) - np.repeat(ends - size[part], size[part]) + np.repeat(first[part], size[part])
                raw = pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(data[take])])
                ids = batch.column(1).to_numpy()[doc[part]]
                yield pa.RecordBatch.from_arrays([pa.array(owner[part]), pa.array(ids), pa.array(place[part]), pa.array(shape[part], pa.int32()), raw], names=["owner", "doc", "place", "shape", "raw"])

    joined = rows.join(per_doc, ["doc", "variant"]).select("text", "doc", "runs")
    return joined.mapInArrow(run, "owner long, doc long, place long, shape int, raw binary")


def repeated_in_shard(data: np.ndarray, offsets: np.ndarray, doc: np.ndarray, place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Run number and offset of every string in a shard text that starts earlier elsewhere."""
    sa = suffix_array(data, length)
    lcp = permuted_lcp(data, sa, length)[sa]
    group = np.cumsum(lcp < length)
    run = np.repeat(np.arange(len(doc)), np.diff(offsets))[sa]
    offset = sa - offsets[run]
    inside = sa + length <= offsets[run + 1]
    group, run, offset = group[inside], run[inside], offset[inside]
    order = np.lexsort((place[run] + offset, doc[run], group))
    group, run, offset = group[order], run[order], offset[order]
    late = np.zeros(len(group), bool)
    late[1:] = group[1:] == group[:-1]
    # one string of one document may stand in the runs of two rounds only as itself
    same = np.zeros(len(group), bool)
    same[1:] = late[1:] & (doc[run][1:] == doc[run][:-1]) & ((place[run] + offset)[1:] == (place[run] + offset)[:-1])
    late &= ~same
    return run[late], offset[late]


def shards(contexts: DataFrame, length: int, shard_bytes: int = SHARD_BYTES, owner_bytes: int = OWNER_BYTES) -> DataFrame:
    """Removed ranges from runs with bytes; strings of overfull owners come out by hash."""
    rows = contexts.repartition("owner").sortWithinPartitions("owner")

    def solve(held: list) -> Iterator[pa.RecordBatch]:
        doc, place = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
        data = np.concatenate([h[3] for h in held])
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([h[4] for h in held]))])
        run, offset = repeated_in_shard(data, offsets, doc, place, length)
        if len(run):
            order = np.lexsort((offset, run))
            run, offset = run[order], offset[order]
            new = np.ones(len(run), bool)
            new[1:] = (run[1:] != run[:-1]) | (offset[1:] != offset[:-1] + 1)
            at = np.flatnonzero(new)
            n = np.diff(np.append(at, len(run)))
            yield _found(0, np.zeros(len(at)), doc[run[at]], place[run[at]] + offset[at], n + length - 1)

    def strings(part: tuple) -> Iterator[pa.RecordBatch]:
        owner, doc, place, data, sizes = part
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        sums, inverse = byte_sums(data)
        n = sizes - length + 1
        run = np.repeat(np.arange(len(n)), n)
        offset = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
        at = offsets[run] + offset
        mark = mix((sums[at + length] - sums[at]) * inverse[at]).astype(np.int64)
        yield _found(2, mark, doc[run], place[run] + offset, np.full(len(run), 256))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0  # whole owners, waiting to fill a shard text
        open_, open_size, overfull = [], 0, False  # the owner at the end of the stream so far

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal held, size, open_, open_size, overfull
            if not overfull and open_:
                held += open_
                size += open_size
            open_, open_size, overfull = [], 0, False
            if size >= shard_bytes:
                yield from solve(held)
                held, size = [], 0

        for batch in stream:
            if not batch.num_rows:
                continue
            owner, doc, place = (batch.column(i).to_numpy() for i in range(3))
            data, offsets = arrays(batch.column(4))
            cuts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            for lo, hi in zip(cuts, np.append(cuts[1:], len(owner)), strict=True):
                part = (owner[lo], doc[lo:hi], place[lo:hi], data[offsets[lo] : offsets[hi]], np.diff(offsets[lo : hi + 1]))
                if open_ and open_[0][0] != part[0] or overfull is not False and overfull != part[0]:
                    yield from close()
                if overfull is not False:
                    yield from strings(part)
                    continue
                open_.append(part)
                open_size += len(part[3])
                if open_size > owner_bytes:
                    for x in open_:
                        yield from strings(x)
                    open_, open_size, overfull = [], 0, part[0]
        yield from close()
        if held:
            yield from solve(held)

    return rows.mapInArrow(run, _FOUND)


def repeated_ranges(rows: DataFrame, length: int = LENGTH, **bounds) -> DataFrame:
    """doc, place, n: removed byte ranges, overlapping ones not yet joined. rows: from keyed()."""
    found = materialise(sort_out(all_runs(rows, length), length), "sa-found")
    compared = materialise(shards(with_bytes(rows, found.where("kind = 1"), length), length, **bounds), "sa-compared")
    single = compared.where("kind = 2").select("owner", F.col("owner").alias("mark"), "doc", "place", "shape")
    late = sort_out(single, length)
    return found.unionByName(compared).unionByName(late).where("kind = 0").select("doc", "place", F.col("shape").alias("n"))


def _outcome(data: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[int, int, int, bytes]:
    """Bytes, bytes removed, removed runs and the bytes kept of one document."""
    if not len(start):
        return len(data), 0, 0, data.tobytes()
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate((start + n)[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    first = start[new]
    last = np.append(end[np.flatnonzero(new)[1:] - 1], end[-1])
    edges = np.zeros(len(data) + 1, np.int32)
    edges[first] += 1
    edges[last] -= 1
    keep = np.cumsum(edges[:-1]) == 0
    return len(data), int((last - first).sum()), len(first), data[keep].tobytes()


def remove_repeats(docs: DataFrame, length: int = LENGTH, **bounds) -> DataFrame:
    """Per row of docs: doc_id, n_bytes, n_removed, n_spans and kept, the remaining bytes."""
    rows = keyed(docs)
    ranges = repeated_ranges(rows, length, **bounds)
    per_doc = ranges.groupBy("doc", F.shiftright("place", 32).alias("variant")).agg(F.collect_list(F.struct(F.col("place").bitwiseAND(0xFFFFFFFF).cast("int").alias("start"), "n")).alias("ranges"))
    joined = rows.join(per_doc, ["doc", "variant"], "left").select("doc", "text", "ranges")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in batches(stream, "text", 4 << 20):
            lists = batch.column(2)
            at, valid = np.asarray(lists.offsets), lists.is_valid().to_numpy(zero_copy_only=False)
            start, n = (lists.values.field(i).to_numpy() for i in range(2))
            made = []
            for i in range(batch.num_rows):
                part = slice(at[i], at[i + 1]) if valid[i] else slice(0, 0)
                made.append(_outcome(data[offsets[i] : offsets[i + 1]], start[part], n[part]))
            ids = [None if d == _FIRST else d for d in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array([m[k] for m in made], pa.int64()) for k in range(3)), pa.array([m[3] for m in made], pa.binary())], names=schema.names)

    return joined.mapInArrow(run, schema)


def op9_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    done = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
