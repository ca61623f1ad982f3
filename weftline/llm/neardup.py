"""MinHash near-dedup with DartMinHash signatures (Christiani, 2020).

A text is a weighted set: its distinct five-word shingles with their counts.
Around every element, hashed darts fall into the region of its weight as a
Poisson process over ranks; a dart counts if its height is under the weight.
Of the darts that aim at one coordinate the earliest is the signature there,
so two texts agree in a coordinate with their weighted Jaccard similarity.

Each distinct text is one vertex, whatever its copies and ids. Vertices that
share a band of coordinates are compared in rounds: all members of a bucket
with its smallest, then the members outside the bucket's largest component with
all others, small buckets as pairs and large ones in blocks inside tasks. No
bucket is left with a pair that is neither joined nor compared. Links are
verified on the full multisets. Texts of any length are read whole.

Defined results: a row with a null text or id is a class of its own and kept;
equal texts are copies, empty ones too; a text of fewer than five words is one
shingle of all its words; different texts under one id are decided one by one,
so one may stay and the other go; class_id is the smallest doc_id of a class and
the row kept is of that id (of several such texts the first by digest); repeated
rows appear repeatedly here, and once after :func:`deduplicate`; an empty table
gives no rows; further columns, whatever their names, pass through
:func:`deduplicate` unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.graph import components
from weftline.llm.scratch import BROADCAST_IDS, by_ids, fresh, materialise
from weftline.llm.textbytes import U64, Words, arrays, batches, mix

SHINGLE = 5
BANDS, ROWS = 25, 5
SIMILARITY = 0.8
#: Standard errors below the similarity at which a signature rules a pair out.
SLACK = 6
#: Members up to which a bucket's pairs are rows; larger ones are compared in blocks.
SMALL_BUCKET, BLOCK = 8, 512
#: Documents and bytes of a slice, as darts take memory per document too.
SLICE_DOCS, SLICE_BYTES = 1024, 1 << 19
_SALTS = mix(np.arange(1, 64, dtype=np.uint64) * U64(0x9E3779B97F4A7C15))


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every run of ``width`` words; shorter texts give one."""
    words = Words(data, offsets)
    ids, counts, first = words.hashed(), words.counts(), words.first_word
    n = np.where(counts >= width, counts - width + 1, (counts > 0).astype(counts.dtype))
    doc = np.repeat(np.arange(len(counts)), n)
    begin = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + first[doc]
    end = first[doc + 1]
    total = np.zeros(len(doc), U64)
    for k in range(width):
        inside = begin + k < end
        total += np.where(inside, ids[np.minimum(begin + k, max(len(ids) - 1, 0))] * (_SALTS[k] | U64(1)), _SALTS[k + 16]) if len(ids) else U64(0)
    return mix(total), doc


def weighted(ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements per document in order: hash, document, count."""
    packed = len(doc) and doc[-1] < 1 << 16
    order = np.argsort((doc.astype(U64) << U64(48)) | (ids >> U64(16))) if packed else np.lexsort((ids, doc))
    ids, doc = ids[order], doc[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return ids[at], doc[at], np.diff(np.append(at, len(ids)))


def _unit(h: np.ndarray) -> np.ndarray:
    return ((h >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53


def dart_signatures(ids: np.ndarray, doc: np.ndarray, weight: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """n_docs x k signatures of weighted sets; documents without elements get zeros.

    Weights are cut into slabs [0, 1), [1, 2), [2, 4), ...: in a slab darts come
    at exponential gaps of rank at the rate of its width, which depends on the
    element and slab only, so equal regions of two sets hold the same darts.
    """
    out = np.zeros((n_docs, k), U64)
    total = np.bincount(doc, weight, n_docs) if len(doc) else np.zeros(n_docs)
    limit = np.where(total > 0, (k * math.log(k) + 2 * k) / np.maximum(total, 1e-12), 0.0)
    todo = total > 0
    while todo.any():
        use = todo[doc]
        e_id, e_doc, e_weight = ids[use], doc[use], weight[use].astype(np.float64)
        last = np.maximum(np.frexp(np.maximum(np.ceil(e_weight), 1) - 0.5)[1], 0)  # slabs below the weight
        n = last + 1
        owner = np.repeat(np.arange(len(e_id)), n)
        slab = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        low = np.where(slab == 0, 0.0, 2.0 ** (slab - 1))
        use = low < e_weight[owner]
        owner, slab, low = owner[use], slab[use], low[use]
        width = np.where(slab == 0, 1.0, low)
        key = mix(e_id[owner] ^ (slab.astype(U64) * _SALTS[40]))
        d, w = e_doc[owner], e_weight[owner]
        rank, best = np.zeros(len(key)), np.full(n_docs * k, np.inf)
        sign = np.zeros(n_docs * k, U64)
        throw = 0
        while len(key):
            throw += 1
            h = mix(key + np.full(1, throw, U64) * _SALTS[41])
            rank = rank - np.log(_unit(h)) / width
            alive = rank <= limit[d]
            key, rank, d, w, low, width, h = (x[alive] for x in (key, rank, d, w, low, width, h))
            if not len(key):
                break
            h2 = mix(h ^ _SALTS[42])
            hit = low + width * _unit(h2) < w
            cell = d[hit] * k + (mix(h2 ^ _SALTS[43])[hit] % U64(k)).astype(np.int64)
            r, s = rank[hit], mix(h2 ^ _SALTS[44])[hit]
            np.minimum.at(best, cell, r)
            won = r == best[cell]
            sign[cell[won]] = s[won]
        filled = np.isfinite(best).reshape(n_docs, k)
        full = filled.all(axis=1) & todo
        out[full] = sign.reshape(n_docs, k)[full]
        todo &= ~full
        limit[todo] *= 2
    return out


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id and digest of docs, the weight of its shingles, a byte per coordinate, a key per band."""
    k = bands * rows

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in batches(stream, "text", SLICE_BYTES, SLICE_DOCS):
            n = batch.num_rows
            ids, doc, count = weighted(*shingles(data, offsets))
            sign = dart_signatures(ids, doc, count, n, k).reshape(n, bands, rows)
            keys = np.zeros((n, bands), U64)
            for j in range(rows):
                keys = mix(keys * U64(3) + sign[:, :, j])
            keys = mix(keys ^ np.arange(bands, dtype=U64))
            marks = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * k).astype(np.int32)), pa.py_buffer(np.ascontiguousarray((sign >> U64(17)).astype(np.uint8)))])
            weight = np.bincount(doc, count, n).astype(np.int64)
            at = np.concatenate([[0], np.cumsum(np.where(weight > 0, bands, 0))])
            listed = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(keys[weight > 0].reshape(-1).astype(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(weight), marks, listed], names=["doc_id", "digest", "weight", "marks", "bands"])

    return docs.select("doc_id", "digest", "text").mapInArrow(run, "doc_id long, digest binary, weight long, marks binary, bands array<long>")


def multisets(docs: DataFrame) -> DataFrame:
    """rep and the shingle multiset as distinct hashes: occurrence i of a shingle is its own element."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in batches(stream, "text", SLICE_BYTES, SLICE_DOCS):
            ids, doc, count = weighted(*shingles(data, offsets))
            every = np.repeat(ids, count)
            turn = np.arange(len(every)) - np.repeat(np.cumsum(count) - count, count)
            member = (mix(every ^ (turn.astype(U64) * _SALTS[45])) >> U64(32)).astype(np.uint32).view(np.int32)
            sizes = np.bincount(np.repeat(doc, count), minlength=batch.num_rows)
            at = np.concatenate([[0], np.cumsum(sizes)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(member))], names=["rep", "members"])

    return docs.select("rep", "text").mapInArrow(run, "rep long, members array<int>")


def plausible(pairs: DataFrame, marks: DataFrame, least: float) -> DataFrame:
    """Pairs a, b whose signatures don't rule the similarity out."""
    side = lambda x: marks.select(F.col("rep").alias(x), F.col("marks").alias(f"m_{x}"))
    k = BANDS * ROWS
    bound = k * least - SLACK * math.sqrt(k * least * (1 - least))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            if batch.num_rows:
                a, b = (arrays(batch.column(i))[0].reshape(batch.num_rows, k) for i in (2, 3))
                yield batch.select([0, 1]).filter(pa.array((a == b).sum(1) >= bound))

    joined = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "m_a", "m_b")
    return joined.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs a, b whose multisets reach the similarity."""
    side = lambda x: sets.select(F.col("rep").alias(x), F.col("members").alias(f"m_{x}"))
    full = pairs.join(side("b"), "b").join(side("a"), "a")
    common = F.size(F.array_intersect("m_a", "m_b"))
    return full.where(common >= F.lit(least) * (F.size("m_a") + F.size("m_b") - common)).select("a", "b")


def _similar_size(least: float):
    return F.least("n_a", "n_b") >= F.lit(least) * F.greatest("n_a", "n_b")


def star_pairs(buckets: DataFrame, least: float) -> DataFrame:
    """Every bucket's smallest member with each of the others."""
    first = buckets.groupBy("key").agg(F.min(F.struct("rep", "weight")).alias("m")).select("key", F.col("m.rep").alias("a"), F.col("m.weight").alias("n_a"))
    pairs = buckets.withColumnsRenamed({"rep": "b", "weight": "n_b"}).join(first, "key").where("a <> b")
    return pairs.where(_similar_size(least)).select("a", "b").distinct()


def mixed_buckets(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of the buckets that hold several components: key, rep, weight, component, n."""
    mine = buckets.join(classes.withColumnRenamed("vertex", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = mine.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")).where("lo < hi").select("key", "n")
    return mine.join(mixed, "key")


def small_pairs(mixed: DataFrame, tested: DataFrame, least: float) -> DataFrame:
    """Pairs across components in buckets of at most SMALL_BUCKET members."""
    rows = mixed.where(F.col("n") <= SMALL_BUCKET)
    left = rows.select("key", F.col("rep").alias("a"), F.col("weight").alias("n_a"), F.col("component").alias("c_a"))
    right = rows.select("key", F.col("rep").alias("b"), F.col("weight").alias("n_b"), F.col("component").alias("c_b"))
    pairs = left.join(right, "key").where("a < b AND c_a <> c_b").where(_similar_size(least)).select("a", "b").distinct()
    return pairs.join(tested, ["a", "b"], "left_anti")


def joining_links(left: list[np.ndarray], right: list[np.ndarray], c_left: np.ndarray, c_right: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Pairs of similar multisets, one of either side, that join different components: a forest."""
    members, n = [*left, *right], len(left)
    size = np.array([len(m) for m in members])
    every, owner = np.concatenate(members), np.repeat(np.arange(len(members)), size)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    number = np.cumsum(np.append(True, every[1:] != every[:-1])) - 1
    often = np.bincount(number) > 1  # what one text has alone is in no intersection
    column = np.cumsum(often) - 1
    owner, number = owner[often[number]], column[number[often[number]]]
    common = np.zeros((n, len(right)), np.float32)
    at = np.searchsorted(number, np.arange(0, int(often.sum()) + 4096, 4096))
    for k, (lo, hi) in enumerate(zip(at[:-1], at[1:], strict=True)):
        part = np.zeros((len(members), 4096), np.float32)
        part[owner[lo:hi], number[lo:hi] - 4096 * k] = 1
        common += part[:n] @ part[n:].T
    similar = (common >= least * (size[:n, None] + size[None, n:] - common)) & (c_left[:, None] != c_right[None])
    label = {c: c for c in [*c_left.tolist(), *c_right.tolist()]}

    def root(c: int) -> int:
        while label[c] != c:
            label[c] = c = label[label[c]]
        return c

    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(similar)), strict=True):
        a, b = root(int(c_left[i])), root(int(c_right[j]))
        if a != b:
            label[max(a, b)] = min(a, b)
            out.append((i, j))
    return out


def block_rows(mixed: DataFrame) -> DataFrame:
    """key, i, j, side, rep, component: what meets in block i, j of a larger bucket.

    Strays, the members outside the bucket's largest component, lie in blocks
    from 0, the members of that component in the blocks after them. Blocks of
    strays meet all blocks, so rows grow with strays times members, not with
    the square of the members.
    """
    rows = mixed.where(F.col("n") > SMALL_BUCKET)
    sizes = rows.groupBy("key", "component").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("key").agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.max("size").alias("n_main"))
    rows = rows.join(largest, "key").withColumn("stray", F.col("component") != F.col("main"))
    blocks = lambda n: F.greatest(F.ceil(n / BLOCK).cast("int"), F.lit(1))
    rows = rows.withColumns({"strays": blocks(F.col("n") - F.col("n_main")), "mains": blocks(F.col("n_main"))})
    dealt = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    rows = rows.withColumn("own", F.when(F.col("stray"), dealt(F.col("strays"))).otherwise(F.col("strays") + dealt(F.col("mains"))))
    others = F.when(F.col("stray"), F.sequence(F.lit(0), F.col("strays") + F.col("mains") - 1)).otherwise(F.sequence(F.lit(0), F.col("strays") - 1))
    rows = rows.select("key", "rep", "component", "own", F.explode(others).alias("other"))
    return rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "rep", "component")


def large_links(mixed: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links across components in larger buckets, compared in blocks against blocks.

    A task holds two blocks of at most BLOCK multisets on average, and gives a
    forest of links, not all pairs.
    """
    rows = block_rows(mixed).join(sets, "rep").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side", "rep")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key = None

        def solve() -> list[tuple[int, int]]:
            sides = [[h for h in held if h[0] == s] for s in ((0, 0) if key[1] == key[2] else (0, 1))]
            if not all(sides):
                return []
            found = joining_links(*([h[3] for h in s] for s in sides), *(np.array([h[2] for h in s]) for s in sides), least)
            return [(sides[0][i][1], sides[1][j][1]) for i, j in found]

        out: list[tuple[int, int]] = []
        for batch in stream:
            if not batch.num_rows:
                continue
            flat, at = batch.column("members").flatten().to_numpy(), np.asarray(batch.column("members").offsets)
            at = at - at[0]
            keys = zip(*(batch.column(c).to_pylist() for c in ("key", "i", "j")), strict=True)
            rest = zip(*(batch.column(c).to_pylist() for c in ("side", "rep", "component")), strict=True)
            for r, (k, x) in enumerate(zip(keys, rest, strict=True)):
                if k != key:
                    if held:
                        out += solve()
                    held, key = [], k
                held.append((*x, flat[at[r] : at[r + 1]].copy()))
        if held:
            out += solve()
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return rows.select("key", "i", "j", "side", "rep", "component", "members").mapInArrow(run, "a long, b long").distinct()


def links(docs: DataFrame, least: float = SIMILARITY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """doc_id and digest of all rows; the distinct texts as rep, digest and smallest doc_id; the components of verified links.

    docs: doc_id, digest, text. The first round compares every bucket's smallest
    member with the others; the second compares, inside buckets, what then lies
    in different components. So each pair in a bucket is joined or compared.
    """
    rows = materialise(signatures(docs), "mh-rows")
    copies = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    copies = materialise(copies.select(F.monotonically_increasing_id().alias("rep"), "digest", "doc_id"), "mh-copies")
    # one row of each text carries its signature: that of the smallest id
    reps = rows.join(copies, ["digest", "doc_id"]).select("rep", "weight", "marks", "bands")
    reps = materialise(reps.dropDuplicates(["rep"]), "mh-reps")
    keys = reps.select("rep", "weight", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    buckets = materialise(keys.join(shared, "key"), "mh-buckets")
    marks = materialise(reps.select("rep", "marks").join(buckets.select("rep").distinct(), "rep", "left_semi"), "mh-marks")

    def sets(ids: DataFrame) -> DataFrame:
        wanted = materialise(copies.join(ids.distinct(), "rep", "left_semi").select(F.col("doc_id").alias("w_id"), F.col("digest").alias("w_digest"), "rep"), "mh-wanted")
        held = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
        texts = docs.join(held, (F.col("doc_id") == F.col("w_id")) & (F.col("digest") == F.col("w_digest"))).select("rep", "text")
        return materialise(multisets(texts).dropDuplicates(["rep"]), "mh-sets")

    both = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("rep"))
    edges = lambda pairs: pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
    tested = materialise(star_pairs(buckets, least), "mh-pairs")
    likely = materialise(plausible(tested, marks, least), "mh-likely")
    classes = components(edges(materialise(verified(likely, sets(both(likely)), least), "mh-links")))
    mixed = materialise(mixed_buckets(buckets, classes), "mh-mixed")
    likely = materialise(plausible(small_pairs(mixed, tested, least), marks, least), "mh-likely")
    held = sets(both(likely).unionByName(mixed.where(F.col("n") > SMALL_BUCKET).select("rep")))
    more = materialise(verified(likely, held, least).unionByName(large_links(mixed, held, least)), "mh-links")
    if not more.isEmpty():
        # what is joined already enters as one link per member
        classes = components(classes.select(F.col("vertex").alias("u"), F.col("component").alias("v")).unionByName(edges(more)))
    return rows.select("doc_id", "digest"), copies, classes


def decided(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, digest, class_id and kept of every row; the digest is null where id or text is."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    whole = F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    rows = rows.withColumn("digest", F.when(whole, F.unhex(F.sha2("text", 256))))
    ids, copies, classes = links(rows.where(whole), least)
    owned = copies.join(classes.withColumnRenamed("vertex", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    owned = materialise(owned, "mh-owned")
    first = owned.groupBy("component").agg(F.min(F.struct("doc_id", "digest")).alias("first"))
    owned = owned.join(first, "component").select("digest", F.col("first.doc_id").alias("class_id"), (F.col("first.digest") == F.col("digest")).alias("leads"))
    found = ids.join(owned, "digest").select("doc_id", "digest", "class_id", (F.col("leads") & (F.col("doc_id") == F.col("class_id"))).alias("kept"))
    return found.unionByName(rows.where(~whole).select("doc_id", "digest", F.col("doc_id").alias("class_id"), F.lit(True).alias("kept")))


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id and kept of every row of docs; class_id is the smallest doc_id of the class."""
    return decided(docs, least).select("doc_id", "class_id", "kept")


def deduplicate(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of docs without those that are not the first of their class.

    Of rows that repeat both id and text one stays.
    """
    found = materialise(decided(docs, least).where("digest IS NOT NULL"), "mh-decided")
    of_id, of_text = fresh("__gone", *docs.columns), fresh("__digest", *docs.columns)
    gone = found.where("NOT kept").select(F.col("doc_id").alias(of_id), F.col("digest").alias(of_text)).distinct()
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    mine = (F.col("doc_id").cast("long") == F.col(of_id)) & (F.unhex(F.sha2(F.col("text").cast("string"), 256)) == F.col(of_text))
    kept = docs.join(gone, mine, "left_anti")
    repeated = found.where("kept").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    again = by_ids(kept, repeated, "doc_id", "left_semi")
    return by_ids(kept, repeated, "doc_id", "left_anti").unionByName(again.dropDuplicates(["doc_id", "text"]))


def op2_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
