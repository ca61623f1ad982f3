"""Toxicity: a convolutional text classifier, trained in numpy on the executors.

A word is the sum of the hashed embeddings of itself and of its first four and
five bytes. Filters of several widths run over the words, each keeps its
maximum over the whole text, and a logistic layer joins them. Every labelled
row outside the held-out fifth trains it, and scoring covers every whole text.

The training rows are written once as shards of hashed words. In each epoch
every shard goes on from the common state (parameters and moments of Adam) by
itself; the new state is the mean over the shards, for a word's embedding over
the shards that met the word. The means are made of sums of integers, so they
don't depend on the order of tasks. Beside the model one more per fold is
trained without the fold, and thresholds are cut between the logits that all
training rows get from the model that didn't see them.

Neither labels, language, source nor id enter a score. Languages only get
thresholds of their own, for flagging.

Defined results: a null or empty text scores from the biases; a document with
several labels counts with the highest, null labels don't count; without
examples of both classes every score is the share of the class seen, or 0;
equal texts score alike; an unknown or null language has the common threshold.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm import scratch
from weftline.llm.textbytes import U64, Words, batches, fold

VOCABULARY = 1 << 15
WIDTH, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
PAD = VOCABULARY
#: Bytes of text that a training shard has about; more shards, not fewer rows, for more text.
SHARD_BYTES = 8 << 20
#: Parts of the training rows; thresholds judge each by a model trained on the others.
FOLDS = 2
#: Tasks that add an epoch's sums before one more moves the states.
PARTIALS = 4
#: Words whose filters are weighed at once in training.
PIECE = 4096
#: Logits are counted in steps of 1 / GRID for the thresholds.
GRID = 256
_ONE = 2.0**28

_BREAK = np.ones(256, bool)
_BREAK[48:58] = _BREAK[65:91] = _BREAK[97:123] = _BREAK[128:] = False


def buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Three buckets per word, and where each document's words begin."""
    words = Words(fold(data), offsets, _BREAK)
    pick = lambda h: (h >> U64(49)).astype(np.int32)
    ends = [words.end, np.minimum(words.start + 4, words.end), np.minimum(words.start + 5, words.end)]
    salts = [U64(0), U64(0x5851F42D4C957F2D), U64(0x14057B7EF767814F)]
    return np.stack([pick(words.hashed(words.start, e) * (s | U64(1))) for e, s in zip(ends, salts, strict=True)]), words.first_word


def padded(found: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with room for the widest filter after each document, and first rows."""
    extra = max(WIDTHS) - 1
    starts = first[:-1] + extra * np.arange(len(first) - 1)
    rows = np.full((len(found), first[-1] + extra * (len(first) - 1)), PAD, np.int32)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    rows[:, np.arange(first[-1]) + extra * doc] = found
    return rows, starts


@dataclass
class Model:
    """All parameters; about 0.3 million numbers, whatever the input."""

    embed: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    shift: np.ndarray
    constant: float | None = None
    thresholds: dict[str, float] = field(default_factory=dict)

    def convolve(self, rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        x = self.embed.take(rows[0], axis=0)
        for r in rows[1:]:
            x += self.embed.take(r, axis=0)
        tail = np.zeros((max(WIDTHS) - 1, x.shape[1]), x.dtype)
        x = np.concatenate([x, tail])
        n, pad = rows.shape[1], rows[0] == PAD
        maps = [x[:n] @ w[0] for w in self.filters]
        for m, w in zip(maps, self.filters, strict=True):
            for o in range(1, len(w)):
                m += x[o : o + n] @ w[o]
            m[pad] = 0  # a window that begins behind the text would reach into the next one
        return x, maps

    def pooled(self, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
        _, maps = self.convolve(rows)
        return np.concatenate([np.maximum.reduceat(m, starts, axis=0) for m in maps], axis=1)

    def logits(self, found: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(first) - 1, self.constant)
        return np.maximum(self.pooled(*padded(found, first)) + self.bias, 0) @ self.out + self.shift[0]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class State:
    """A model in training: its parameters, Adam's two moments of each, and the steps made."""

    model: Model
    first: list[np.ndarray]
    second: list[np.ndarray]
    step: int = 0

    def params(self) -> list[np.ndarray]:
        own = self.model
        return [own.embed, *own.filters, own.bias, own.out, own.shift]


def initial(seed: int) -> State:
    rng = np.random.default_rng(seed)
    normal = lambda *shape, scale=0.1: rng.normal(0, scale, shape).astype(np.float32)
    embed = normal(VOCABULARY + 1, WIDTH)
    embed[PAD] = 0
    total = FILTERS * len(WIDTHS)
    model = Model(embed, [normal(w, WIDTH, FILTERS, scale=0.3) for w in WIDTHS], np.zeros(total, np.float32), np.abs(normal(total, scale=0.5)), np.array([-1.0], np.float32))
    model.out[::2] *= -1
    state = State(model, [], [])
    state.first, state.second = ([np.zeros_like(p) for p in state.params()] for _ in range(2))
    return state


def spaced(parts: list[np.ndarray]) -> list[np.ndarray]:
    """Each document's hashed words with room for the widest filter after them."""
    room = np.full((3, max(WIDTHS) - 1), PAD, np.uint16)
    return [np.concatenate([p, room], axis=1) for p in parts]


def peaks(model: Model, rows: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as vectors, every filter's maximum over each document, and the row where it comes first.

    In pieces of rows that fit a processor's cache, all filters at once; a
    document may reach over several pieces.
    """
    n, extra = rows.shape[1], max(WIDTHS) - 1
    x = np.zeros((n + extra, WIDTH), np.float32)
    top = np.full((FILTERS * len(WIDTHS), len(starts)), -np.inf, np.float32)
    place = np.repeat(starts[None], len(top), axis=0)
    weights = np.concatenate([w[o].T for w in model.filters for o in range(len(w))])
    # arrays of a piece are made once, as new ones cost more than the work on them
    vectors = np.empty((WIDTH, PIECE + extra), np.float32)
    products = np.empty((len(weights), PIECE + extra), np.float32)
    taken = np.empty((PIECE + extra, WIDTH), np.float32)
    spread, same = np.empty((len(top), PIECE), np.float32), np.empty((len(top), PIECE), bool)
    known = 0
    for a in range(0, n, PIECE):
        size, end = min(PIECE, n - a), min(a + PIECE + extra, n)
        for at in rows[:, known:end]:
            x[known:end] += model.embed.take(at, axis=0, out=taken[: end - known], mode="clip")
        known = end
        if size < PIECE:
            vectors, products, spread, same = (np.empty((len(v), size + (v.shape[1] - PIECE)), v.dtype) for v in (vectors, products, spread, same))
        vectors[:] = x[a : a + size + extra].T
        np.matmul(weights, vectors, out=products)
        maps, used = [], 0
        for w in WIDTHS:
            own = products[used : used + FILTERS, :size]
            for o in range(1, w):
                own += products[used + o * FILTERS : used + (o + 1) * FILTERS, o : o + size]
            maps.append(own)
            used += w * FILTERS
        pad = np.flatnonzero(rows[0, a : a + size] == PAD)
        lo, hi = int(np.searchsorted(starts, a, "right")) - 1, int(np.searchsorted(starts, a + size))
        inside = np.maximum(starts[lo:hi] - a, 0)
        doc = np.repeat(np.arange(len(inside)), np.append(inside[1:], size) - inside)
        best = np.empty((len(top), len(inside)), np.float32)
        for k, own in enumerate(maps):
            own[:, pad] = 0
            part = slice(k * FILTERS, (k + 1) * FILTERS)
            np.maximum.reduceat(own, inside, axis=1, out=best[part])
            np.equal(own, best[part].take(doc, axis=1, out=spread[part], mode="clip"), out=same[part])
        f, row = np.divmod(np.flatnonzero(same)[::-1], size)
        spot = place[:, lo:hi].copy()
        spot[f, doc[row]] = a + row  # the first is written last
        better = best > top[:, lo:hi]
        np.copyto(place[:, lo:hi], spot, where=better)
        np.maximum(top[:, lo:hi], best, out=top[:, lo:hi])
    return x, top, place


def epoch(state: State, parts: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, order: np.ndarray, rate: float, batch_words: int) -> np.ndarray:
    """Train once over spaced rows by Adam on batches; returns which embeddings had gradients.

    Gradients flow through the maxima only.
    """
    model, params = state.model, state.params()
    met = np.zeros(VOCABULARY + 1, bool)
    sums, free = np.zeros_like(model.embed), [np.empty_like(p) for p in params]
    sizes = np.cumsum([parts[i].shape[1] for i in order])
    for group in np.split(order, np.flatnonzero(np.diff(sizes // batch_words)) + 1):
        state.step += 1
        starts = np.cumsum([0, *[parts[i].shape[1] for i in group[:-1]]])
        rows = np.concatenate([parts[i] for i in group], axis=1).astype(np.intp)
        x, top, place = peaks(model, rows, starts)
        z = top.T + model.bias
        hidden = np.maximum(z, 0)
        d = ((sigmoid(hidden @ model.out + model.shift[0]) - labels[group]) * weights[labels[group]] / len(group)).astype(np.float32)
        dz = d[:, None] * model.out * (z > 0)
        gradient = [sums, *[np.empty_like(p) for p in params[1:]]]
        gradient[-1][0], gradient[-2][:], gradient[-3][:] = d.sum(), hidden.T @ d, dz.sum(0)
        through = dz.T * (rows[0][place] != PAD)
        at, back = [], []
        for k, w in enumerate(model.filters):
            own = slice(k * FILTERS, (k + 1) * FILTERS)
            f, doc = np.nonzero(through[own])
            row, g = place[own][f, doc], through[own][f, doc]
            spread = np.zeros((FILTERS, len(f)), np.float32)
            spread[f, np.arange(len(f))] = g
            for o in range(len(w)):
                gradient[1 + k][o] = (spread @ x[row + o]).T
                inside = row + o < rows.shape[1]
                at.append((row + o)[inside])
                back.append((g[:, None] * w[o].T[f])[inside])
        at, back = rows[:, np.concatenate(at)].ravel(), np.concatenate(back).astype(np.float64)
        for k in range(WIDTH):
            sums[:, k] = np.bincount(at, np.tile(back[:, k], len(rows)), len(sums))
        sums[PAD] = 0
        met[at] = True
        for p, one, two, g, t in zip(params, state.first, state.second, gradient, free, strict=True):
            # one += 0.1 * (g - one), two += 0.01 * (g * g - two), without new arrays
            one += np.multiply(np.subtract(g, one, out=t), np.float32(0.1), out=t)
            two += np.multiply(np.subtract(np.multiply(g, g, out=t), two, out=t), np.float32(0.01), out=t)
            np.sqrt(np.divide(two, np.float32(1 - 0.99**state.step), out=t), out=t)
            np.divide(one, np.add(t, np.float32(1e-8), out=t), out=t)
            p -= np.multiply(t, np.float32(rate / (1 - 0.9**state.step)), out=t)
    met[PAD] = False
    return met


def averaged(state: State) -> list[np.ndarray]:
    """What is averaged: second moments by their roots, which integers can hold."""
    return [*state.params(), *state.first, *[np.sqrt(v) for v in state.second]]


def changes(before: State, after: State, met: np.ndarray) -> np.ndarray:
    """What a shard changed, as integers: such vectors add exactly, in any order."""
    out = []
    for old, new in zip(averaged(before), averaged(after), strict=True):
        change = np.rint((new.astype(np.float64) - old) * _ONE).astype(np.int64)
        if len(old) == len(met):
            change[~met] = 0
        out.append(change.ravel())
    steps = after.step - before.step
    return np.concatenate([*out, met, [steps > 0, steps]])


def advance(state: State, total: np.ndarray) -> None:
    """Move a state by the mean of summed changes."""
    counts, (shards, steps), at = np.maximum(total[-(VOCABULARY + 3) : -2], 1)[:, None], total[-2:], 0
    if not shards:
        return
    values = averaged(state)
    for a in values:
        part = total[at : at + a.size].reshape(a.shape)
        a += (part / (_ONE * (counts if len(a) == len(counts) else shards))).astype(np.float32)
        at += a.size
    for own, root in zip(state.second, values[-len(state.second) :], strict=True):
        own[:] = np.square(np.maximum(root, 0))
    state.step += max(round(int(steps) / int(shards)), 1)


def sealed(totals: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The sums of each model as rows, their bytes by significance: most of the higher ones are alike."""
    for number, total in totals.items():
        planes = np.ascontiguousarray(total.astype("<i8", copy=False).view(np.uint8).reshape(-1, 8).T)
        data = pa.compress(pa.py_buffer(planes), codec="zstd", asbytes=True)
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([planes.size], pa.int64()), pa.array([data], pa.binary())], names=["model", "size", "total"])


def totals(stream: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
    """Sealed sums of each model added up."""
    found: dict[int, np.ndarray] = {}
    for batch in stream:
        for number, size, data in zip(*[batch.column(c) for c in range(3)], strict=True):
            planes = np.frombuffer(pa.decompress(data.as_buffer(), size.as_py(), codec="zstd"), np.uint8).reshape(8, -1)
            add(found, number.as_py(), np.ascontiguousarray(planes.T).view("<i8").ravel())
    return found


def add(found: dict[int, np.ndarray], number: int, total: np.ndarray) -> None:
    if number in found:
        found[number] += total
    else:
        found[number] = total


SEALED = "model int, size long, total binary"


SHARD = "found binary, sizes binary, labels binary, folds binary, langs array<string>"


def packed(stream: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The rows of a task as shards of about ``limit`` bytes of hashed words, none left out."""

    def shard(rows: list[tuple]) -> pa.RecordBatch:
        lang, label, part, found = zip(*rows, strict=True)
        columns = [b"".join(found), np.array([len(f) // 6 for f in found], np.int64).tobytes(), np.array(label, np.int8).tobytes(), np.array(part, np.int8).tobytes()]
        return pa.RecordBatch.from_arrays([*[pa.array([c], pa.binary()) for c in columns], pa.array([list(lang)], pa.list_(pa.string()))], names=["found", "sizes", "labels", "folds", "langs"])

    rows, size = [], 0
    for batch in stream:
        for row in zip(*[batch.column(c).to_pylist() for c in ("lang", "label", "part", "found")], strict=True):
            rows.append(row)
            size += len(row[-1])
            if size >= limit:
                yield shard(rows)
                rows, size = [], 0
    if rows:
        yield shard(rows)


def unpacked(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray, list, int]]:
    """Hashed words, labels, folds and languages of each shard, and a number made of its content."""
    for batch in stream:
        for i in range(batch.num_rows):
            found, sizes, labels, folds = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in enumerate([np.uint16, np.int64, np.int8, np.int8]))
            ends = 3 * np.cumsum(sizes)
            parts = [found[b - 3 * n : b].reshape(3, -1) for n, b in zip(sizes, ends, strict=True)]
            yield parts, labels.astype(np.int64), folds, batch.column(4)[i].as_py(), zlib.crc32(found)


def fit(shards: DataFrame, weights: np.ndarray, epochs: int = 12, rate: float = 0.02, batch_words: int = 60_000, seed: int = 5) -> list[Model]:
    """The model of all rows, then those without fold 0, 1, ...

    The driver only passes the states on, as bytes; executors add the sums and
    move the states.
    """
    spark = shards.sparkSession
    states = [pickle.dumps(initial(seed))] * (1 + FOLDS)
    for turn in range(epochs):
        held = spark.sparkContext.broadcast(states)

        def run(stream: Iterator[pa.RecordBatch], held=held, turn=turn) -> Iterator[pa.RecordBatch]:
            found: dict[int, np.ndarray] = {}
            for parts, labels, folds, _, number in unpacked(stream):
                parts = spaced(parts)
                for k, data in enumerate(held.value):
                    before, after, rows = pickle.loads(data), pickle.loads(data), np.flatnonzero(folds != k - 1)
                    order = np.random.default_rng([seed, turn, number]).permutation(rows)
                    met = epoch(after, parts, labels, weights, order, rate, batch_words) if len(rows) else np.zeros(VOCABULARY + 1, bool)
                    add(found, k, changes(before, after, met))
            yield from sealed(found)

        def moved(stream: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for k, total in totals(stream).items():
                state = pickle.loads(held.value[k])
                advance(state, total)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([pickle.dumps(state)], pa.binary())], names=["model", "state"])

        paths = [scratch.new_path(spark, "toxicity-epoch") for _ in range(2)]
        shards.mapInArrow(run, SEALED).write.parquet(paths[0])
        sums = spark.read.schema(SEALED).parquet(paths[0]).coalesce(PARTIALS)
        sums.mapInArrow(lambda stream: sealed(totals(stream)), SEALED).write.parquet(paths[1])
        new = spark.read.schema(SEALED).parquet(paths[1]).coalesce(1).mapInArrow(moved, "model int, state binary")
        states = [bytes(r.state) for r in sorted(new.collect(), key=lambda r: r.model)]
        held.destroy()
        for path in paths:
            scratch.remove(spark, path)
    return [pickle.loads(data).model for data in states]


def cut(at: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> float:
    """The logit between classes with the best balanced accuracy, midway in its gap.

    Of rising logits with their rows of each class.
    """
    if not zeros.sum() or not ones.sum():
        return 0.0
    ok = np.concatenate([[0], np.cumsum(zeros)]) / zeros.sum() + np.concatenate([[ones.sum()], ones.sum() - np.cumsum(ones)]) / ones.sum()
    ends = np.concatenate([[at[0] - 1], at, [at[-1] + 1]])
    top = np.flatnonzero(ok >= ok.max() - 1e-12)
    middle = top[len(top) // 2]
    return float((ends[middle] + ends[middle + 1]) / 2)


def training_rows(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """text, lang, label, doc_id of every labelled document outside the held-out fifth."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.max(label).cast("int").alias("__label"))
    rows = rows.where(~held_out(F.col("__id")))
    if rows.count() <= scratch.BROADCAST_IDS:
        rows = F.broadcast(rows)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("__doc"), F.col("text").alias("__text"), lang.alias("__lang"))
    return texts.join(rows, F.col("__doc") == F.col("__id")).select(F.col("__text").alias("text"), F.col("__lang").alias("lang"), F.col("__label").alias("label"), F.col("__doc").alias("doc_id"))


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", shard_bytes: int = SHARD_BYTES, **options) -> Model:
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in batches(stream, "text"):
            found, first = buckets(data, offsets)
            rows = [found[:, a:b].astype(np.uint16).tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(rows, pa.binary())], names=["lang", "label", "part", "spot", "found"])

    rows = training_rows(docs, labels, label)
    # copies of a text share a fold, so that none is judged by a model that saw the others
    part = (F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")) % FOLDS).cast("int").alias("part")
    seen = rows.select("label", part, F.octet_length("text").alias("n")).groupBy("label", "part").agg(F.count("*").alias("rows"), F.sum("n").alias("bytes")).collect()
    counts = np.zeros((FOLDS, 2), np.int64)
    for r in seen:
        counts[r.part, r.label] = r.rows
    if not counts.sum(axis=0).all():
        return Model(*[np.zeros(1)] * 5, constant=40.0 if counts[:, 1].any() else -40.0)
    n = 1 + sum(r.bytes or 0 for r in seen) // shard_bytes
    hashed = rows.select("text", "lang", "label", part, F.xxhash64("doc_id", "text").alias("spot")).mapInArrow(run, "lang string, label int, part int, spot long, found binary")
    hashed = hashed.repartition(n, "spot").sortWithinPartitions("spot", "found", "label", "lang")
    shards = scratch.materialise(hashed.mapInArrow(lambda stream: packed(stream, 4 * shard_bytes), SHARD), "toxicity")
    total = counts.sum(axis=0)
    model, *others = fit(shards, (0.5 * total.sum() / total).astype(np.float32), **options)
    # a fold is judged by the model without it, if that one saw both classes
    judges = others if (total - counts).all() else [model] * FOLDS
    held = docs.sparkSession.sparkContext.broadcast(judges)

    def judge(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts, y, folds, langs, _ in unpacked(stream):
            logits = [held.value[k].logits(p, np.array([0, p.shape[1]]))[0] for p, k in zip(parts, folds, strict=True)]
            at = np.rint(np.array(logits, np.float64) * GRID).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(at), pa.array(y)], names=["lang", "at", "label"])

    cells = shards.mapInArrow(judge, "lang string, at long, label long").groupBy("lang", "at").agg(F.sum(1 - F.col("label")).alias("zeros"), F.sum("label").alias("ones"))
    cells = scratch.materialise(cells, "toxicity-cells")
    found = cells.groupBy("at").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")).orderBy("at").collect()
    column = lambda rows, name: np.array([r[name] for r in rows], np.float64)
    common = cut(column(found, "at") / GRID, column(found, "zeros"), column(found, "ones"))
    model.shift = model.shift - np.float32(common)
    enough = cells.where(F.col("lang") != "").groupBy("lang").agg(F.sum("zeros").alias("__z"), F.sum("ones").alias("__o")).where("least(__z, __o) >= 20").select(F.col("lang").alias("__own"))
    own = {}
    for r in cells.join(enough, F.col("lang") == F.col("__own")).orderBy("lang", "at").collect():
        own.setdefault(r.lang, []).append(r)
    for lang, rows in own.items():
        model.thresholds[lang] = float(sigmoid(np.array(cut(column(rows, "at") / GRID, column(rows, "zeros"), column(rows, "ones")) - common)))
    return model


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """docs with the score of every whole text; a column of that name is replaced."""
    kept = docs.drop(out)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch, data, offsets in batches(stream, "text"):
            found = sigmoid(own.logits(*buckets(data, offsets)).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, out])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(out, T.DoubleType())]))


def flagged(score_column, lang, model: Model):
    """Whether a score reaches its language's threshold, or 0.5 without one."""
    own = F.lit(0.5)
    for name, at in sorted(model.thresholds.items()):
        own = F.when(lang == name, F.lit(at)).otherwise(own)
    return score_column >= own


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), flagged(F.col("score"), F.col("lang"), model).alias("flagged_by_language"))
