"""Benchmark decontamination by latent semantic retrieval.

Terms are hashed words weighted by tf-idf, with document frequencies over the
whole corpus. The passages of the benchmark span a latent space, found by a
distributed randomised SVD. All documents pass in overlapping windows: a window
whose latent cosine with a passage is high becomes a candidate, and candidates
are checked on words: the share of the passage's term weight in the region, the
longest common subsequence of content words, and the answer (a given one whole,
or a quarter of the passage's eight rarest words). Edited and reordered passages are thus found too.
A term counts once in each half of a window, so repeats cannot drown a passage,
and the cosine bound falls with the root of a short passage's length.

Verbatim passages need no candidate: the hash of the first MIN_WORDS words is
looked up at every word and the whole passage compared there. Such a stretch is
a window by itself with cosine 1, and it needs no answer; neither does a region
that holds all words of the passage in order.

The benchmark goes through in blocks of a fixed number of passages, each a
search against all documents, so what a worker holds is bounded.

Items of fewer than MIN_WORDS words are found by their words alone: word for word
anywhere if one of them is rare in the corpus, else only as a whole document.

Rows are decided one by one, so ids, null or repeated, don't matter to
:func:`decontaminate`. Texts of any length are searched whole.

Defined results: a null or empty text matches nothing; benchmark rows with a null
or wordless text match nothing; items with a null id match like others, under a
null item_id; repeated items match each by themselves; rows of documents with
the same id, null included, give one row per id and item; an empty corpus or
benchmark gives no rows and removes none; further columns pass through
:func:`decontaminate` unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.scratch import materialise
from weftline.llm.textbytes import U64, Words, batches, fold, mix, run_sums

TERM_BITS = 17
TERMS = 1 << TERM_BITS
RANK, EXTRA = 192, 8
BLOCK = 32  # words; a window is two blocks
PASSAGE = 64  # words of a benchmark passage at most
MIN_WORDS = 5
#: Passages that one search holds.
SEARCH_PASSAGES = 20_000
COSINE, MASS, COMMON = 0.4, 0.45, 0.6
#: Words below which a passage lowers the cosine bound.
SHORT = 16
#: Words in more than this share of documents are no content words.
FREQUENT = 0.1

_BREAK = np.ones(256, bool)
_BREAK[48:58] = _BREAK[65:91] = _BREAK[97:123] = _BREAK[128:] = False


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, their term numbers, and where each document's words begin."""
    words = Words(fold(data), offsets, _BREAK)
    ids = words.hashed()
    return ids, (ids >> U64(64 - TERM_BITS)).astype(np.int64), words.first_word


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each term occurs, and how many documents there are."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(TERMS, np.int64), 0
        for batch, data, offsets in batches(stream, "text"):
            _, term, first = terms(data, offsets)
            n += batch.num_rows
            doc = np.repeat(np.arange(batch.num_rows), np.diff(first))
            pair = np.sort(doc * TERMS + term)
            pair = pair[np.append(True, pair[1:] != pair[:-1])] if len(pair) else pair
            counts += np.bincount(pair % TERMS, minlength=TERMS)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1), pa.int32()), pa.array(np.append(counts[seen], n))], names=["term", "n"])

    rows = docs.select("text").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out, term, n = np.zeros(TERMS, np.int64), rows["term"].to_numpy(), rows["n"].to_numpy()
    out[term[term >= 0]] = n[term >= 0]
    return out, int(n[term < 0].sum())


def idf_weights(frequencies: np.ndarray, n_docs: int) -> np.ndarray:
    return np.log((n_docs + 1) / (frequencies + 1)).astype(np.float32) + 0.05


def passages(benchmark: DataFrame, idf: np.ndarray) -> DataFrame:
    """item_id, part, words (hashes) and answer words of every passage of the benchmark."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string").alias("text"), answer.alias("answer")).where("text IS NOT NULL")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in batches(stream, "text"):
            ids, _, first = terms(data, offsets)
            out = []
            for i, (item, own) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                words = ids[first[i] : first[i + 1]].astype(np.int64)
                if not len(words):
                    continue
                raw = np.frombuffer((own or "").encode(), np.uint8)
                said = terms(raw, np.array([0, len(raw)]))[0].astype(np.int64).tolist()
                n = -(-len(words) // PASSAGE)  # every part of a longer one has half of PASSAGE at least
                for part, piece in enumerate(np.array_split(words, n)):
                    out.append((item, part, piece.tolist(), said))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())), strict=True)], names=["item_id", "part", "words", "answer"])

    return rows.mapInArrow(run, "item_id long, part int, words array<long>, answer array<long>")


def _weighted(words: list, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms and unit tf-idf weights of a passage."""
    term, count = np.unique(np.asarray(words, np.int64).view(np.uint64) >> U64(64 - TERM_BITS), return_counts=True)
    weight = count * idf[term.astype(np.int64)]
    return term.astype(np.int64), weight / max(float(np.linalg.norm(weight)), 1e-9)


def latent_space(parts: DataFrame, idf: np.ndarray, rank: int = RANK, extra: int = EXTRA, seed: int = 17) -> tuple[np.ndarray, np.ndarray]:
    """Terms of the passages and their rows of V in A = U S V', by randomised SVD.

    Y = A G with a Gaussian G drawn per term; Y'Y gives an orthogonal basis Q of
    the range, B = Q'A is summed per term over partitions, and the small
    product B B' gives the singular vectors. At most TERMS rows come back.
    """
    spark, width = parts.sparkSession, rank + extra
    held = spark.sparkContext.broadcast(idf)

    def gaussian(term: np.ndarray) -> np.ndarray:
        return np.stack([np.random.default_rng([seed, int(t)]).standard_normal(width) for t in term])

    def projected(words: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        term, weight = _weighted(words, held.value)
        return term, weight, weight @ gaussian(term)

    def gram(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in stream:
            for words in batch.column(0).to_pylist():
                y = projected(words)[2]
                total += np.outer(y, y)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["row", "sums"])

    sums = parts.select("words").mapInArrow(gram, "row int, sums array<double>").select("row", F.posexplode("sums")).groupBy("row", "pos").agg(F.sum("col").alias("s")).toArrow()
    g = np.zeros((width, width))
    g[sums["row"].to_numpy(), sums["pos"].to_numpy()] = sums["s"].to_numpy()
    values, vectors = np.linalg.eigh((g + g.T) / 2)
    good = values > max(values.max(), 0) * 1e-10
    basis = vectors[:, good] / np.sqrt(values[good])  # Q = Y basis
    if not good.any():
        return np.zeros(0, np.int64), np.zeros((0, rank), np.float32)

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in stream:
            for words in batch.column(0).to_pylist():
                term, weight, y = projected(words)
                q = y @ basis
                for t, w in zip(term.tolist(), weight, strict=True):
                    found[t] = found.get(t, 0) + w * q
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([v.tolist() for v in found.values()], pa.list_(pa.float64()))], names=["term", "b"])

    b = parts.select("words").mapInArrow(rows, "term int, b array<double>").select("term", F.posexplode("b")).groupBy("term", "pos").agg(F.sum("col").alias("s")).toArrow()
    term, at = np.unique(b["term"].to_numpy(), return_inverse=True)
    matrix = np.zeros((len(term), basis.shape[1]))
    matrix[at, b["pos"].to_numpy()] = b["s"].to_numpy()
    values, vectors = np.linalg.eigh(matrix.T @ matrix)
    top = np.argsort(-values)[:rank]
    top = top[values[top] > 1e-9]
    return term.astype(np.int64), (matrix @ (vectors[:, top] / np.sqrt(values[top]))).astype(np.float32)


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence, by bit vectors over a."""
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        m = where.get(x, 0)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def run_hashes(sums: np.ndarray, inverse: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n words from each start, by the prefix sums of word hashes."""
    return mix((sums[start + n] - sums[start]) * inverse[start])


@dataclass
class Passage:
    item: int
    words: np.ndarray
    term: np.ndarray
    mass: np.ndarray
    content: list
    every: bool  # the content is all words, as too few are rare
    answer: list
    given: bool


class Searcher:
    """A block of passages, ready to be searched for."""

    def __init__(self, rows: list, idf: np.ndarray, frequent: float, term: np.ndarray, space: np.ndarray):
        self.idf, self.frequent = idf, frequent
        short = [r for r in rows if len(r[1]) < MIN_WORDS]
        rows = [r for r in rows if len(r[1]) >= MIN_WORDS]
        self.short = self.short_items(short)
        self.index = np.full(TERMS, -1, np.int32)
        self.index[term] = np.arange(len(term))
        self.space = space * idf[term][:, None]  # a term's contribution to a window
        self.passages, latent = [], []
        for item, words, answer in rows:
            words = np.asarray(words, np.int64).view(np.uint64)
            t, w = _weighted(words.view(np.int64), idf)
            z = w @ space[self.index[t]]
            latent.append(z / max(float(np.linalg.norm(z)), 1e-9))
            content = self.content(words)
            every = len(self.rare_words(words)) < 3
            rare = sorted(set(words.tolist()), key=lambda x: (-idf[x >> (64 - TERM_BITS)], x))[:8]
            said = [int(np.int64(x).view(np.uint64)) for x in answer]
            self.passages.append(Passage(item, words, t, idf[t] / idf[t].sum(), content, every, said or rare, bool(said)))
        #: rare terms of passages; without two of them near it no window is confirmed, but for passages of common words
        self.rare = (self.index >= 0) & (idf > frequent)
        self.prune = not any(p.every for p in self.passages)
        #: rows of the space and weights of all passages' terms, one passage after the other
        self.flat_rows = np.concatenate([self.index[p.term] for p in self.passages]) if self.passages else np.zeros(0, np.int32)
        self.flat_mass = np.concatenate([p.mass for p in self.passages]) if self.passages else np.zeros(0)
        self.begins = np.concatenate([[0], np.cumsum([len(p.term) for p in self.passages])]).astype(np.int64)
        self.ease = np.sqrt(np.minimum([len(p.words) / SHORT for p in self.passages], 1)).astype(np.float32)
        texts: dict[bytes, list] = {}
        for k, p in enumerate(self.passages):
            texts.setdefault(p.words.tobytes(), []).append(k)
        self.texts = list(texts.values())
        own = [self.passages[k[0]].words for k in self.texts]
        start = np.array([run_hashes(*run_sums(w), np.zeros(1, np.int64), MIN_WORDS)[0] for w in own], U64)
        #: distinct hashes of first words, and a filter by their upper bits
        self.heads, head = np.unique(start, return_inverse=True)
        self.filter = np.zeros(1 << 16, bool)
        self.filter[self.heads >> U64(48)] = True
        #: per length the heads it occurs with, and the sorted hashes and numbers of its texts
        self.lengths = []
        size = np.array([len(w) for w in own], np.int64)
        for n in np.unique(size).tolist():
            some = np.flatnonzero(size == n)
            whole = np.array([run_hashes(*run_sums(own[k]), np.zeros(1, np.int64), n)[0] for k in some], U64)
            order = np.argsort(whole, kind="stable")
            starts = np.zeros(len(self.heads), bool)
            starts[head[some]] = True
            self.lengths.append((n, starts, whole[order], some[order]))
        self.latent = np.array(latent, np.float32).reshape(len(latent), space.shape[1]).T

    def rare_words(self, words: np.ndarray) -> np.ndarray:
        return words[self.idf[(words >> U64(64 - TERM_BITS)).astype(np.int64)] > self.frequent]

    def content(self, words: np.ndarray) -> list:
        kept = self.rare_words(words)
        return (kept if len(kept) >= 3 else words).tolist()

    def massive(self, term: np.ndarray, first: np.ndarray, begin: np.ndarray, passage: np.ndarray, mass: float) -> np.ndarray:
        """Which candidates may hold the share of term weight that confirm() asks for.

        The blocks within PASSAGE words of a window hold all that confirm() looks
        at, so what fails here would fail there.
        """
        keep = np.zeros(len(begin), bool)
        if not len(begin):
            return keep
        counts = np.diff(first)
        n_blocks = -(-counts // BLOCK)
        base, of = np.cumsum(n_blocks) - n_blocks, np.repeat(np.arange(len(counts)), n_blocks)
        doc = np.searchsorted(first, begin, "right") - 1
        block = base[doc] + (begin - first[doc]) // BLOCK
        word_doc = np.repeat(np.arange(len(counts)), counts)
        at = base[word_doc] + (np.arange(len(term)) - first[word_doc]) // BLOCK
        row, reach, n_terms = self.index[term], PASSAGE // BLOCK, len(self.space)
        step = max(1, (1 << 24) // n_terms)  # blocks whose presences are held at once
        order = np.argsort(block, kind="stable")
        cuts = np.searchsorted(block[order], np.arange(0, len(of) + step, step))
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            mine = order[a:b]
            if not len(mine):
                continue
            low, high = max(k * step - reach, 0), min((k + 1) * step + 1 + reach, len(of))
            present = np.zeros((high - low, n_terms), bool)
            words = slice(*np.searchsorted(at, [low, high]))
            known = row[words] >= 0
            present[at[words][known] - low, row[words][known]] = True
            own = passage[mine]
            size = self.begins[own + 1] - self.begins[own]
            pair = np.repeat(np.arange(len(mine)), size)
            flat = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size) + self.begins[own][pair]
            there = np.zeros(len(pair), bool)
            for shift in range(-reach, reach + 2):
                near = block[mine] + shift
                valid = (near >= 0) & (near < len(of))
                near = np.where(valid, near, block[mine])
                valid &= of[near] == doc[mine]
                there |= present[near[pair] - low, self.flat_rows[flat]] & valid[pair]
            keep[mine] = np.bincount(pair, self.flat_mass[flat] * there, len(mine)) >= mass - 1e-4
        return keep

    def short_items(self, rows: list) -> list[tuple[int, dict[int, list], dict[int, list]]]:
        """Per number of words the items by the hash of their words: those with a rare word, and the others."""
        out = []
        for n in sorted({len(r[1]) for r in rows}):
            found: tuple[dict, dict] = ({}, {})
            for item, words, _ in rows:
                if len(words) == n:
                    words = np.asarray(words, np.int64).view(np.uint64)
                    key = int(run_hashes(*run_sums(words), np.zeros(1, np.int64), n)[0])
                    found[not len(self.rare_words(words))].setdefault(key, []).append(item)
            out.append((n, *found))
        return out

    def short_matches(self, ids: np.ndarray, first: np.ndarray) -> list[tuple[int, int | None]]:
        """Document and item of every short item that a document holds."""
        found: set = set()
        sums, inverse = run_sums(ids) if self.short else (None, None)
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first)) if self.short else None
        for n, anywhere, whole in self.short:
            for held, at in ((anywhere, np.flatnonzero(np.arange(len(ids)) + n <= first[doc + 1])), (whole, first[:-1][np.diff(first) == n])):
                if held and len(at):
                    key = run_hashes(sums, inverse, at, n)
                    for k in np.flatnonzero(np.isin(key, np.array(list(held), U64))):
                        found |= {(int(doc[at[k]]), item) for item in held[int(key[k])]}
        return list(found)

    def found(self, ids: np.ndarray, term: np.ndarray, first: np.ndarray, cosine: float, mass: float, common: float) -> list[tuple[int, int | None, float, float]]:
        """Document, item, cosine and share of every match in a slice of documents."""
        out = [(d, self.passages[k].item, 1.0, 1.0) for d, k in self.verbatim(ids, first)]
        out += [(d, item, 1.0, 1.0) for d, item in self.short_matches(ids, first)]
        begin, end, passage, near = self.candidates(term, first, cosine)
        some = self.massive(term, first, begin, passage, mass)
        begin, end, passage, near = begin[some], end[some], passage[some], near[some]
        doc = np.searchsorted(first, begin, "right") - 1
        last, present = None, set()
        for k in range(len(begin)):
            p, d = self.passages[passage[k]], doc[k]
            lo, hi = max(begin[k] - len(p.words), first[d]), min(end[k] + len(p.words), first[d + 1])
            if (lo, hi) != last:
                last, present = (lo, hi), set(term[lo:hi].tolist())
            share = self.confirm(p, ids[lo:hi], present, mass, common)
            if share is not None:
                out.append((int(d), p.item, float(near[k]), float(share)))
        return out

    def verbatim(self, ids: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
        """Document and passage of every passage that a document holds word for word."""
        if len(ids) < MIN_WORDS or not len(self.heads):
            return []
        sums, inverse = run_sums(ids)
        key = run_hashes(sums, inverse, np.arange(len(ids) - MIN_WORDS + 1), MIN_WORDS)
        at = np.flatnonzero(self.filter[key >> U64(48)])
        head = np.minimum(np.searchsorted(self.heads, key[at]), len(self.heads) - 1)
        same = self.heads[head] == key[at]
        at, head = at[same], head[same]
        doc = np.searchsorted(first, at, "right") - 1
        found = set()
        for n, starts, hashes, texts in self.lengths:
            fits = np.flatnonzero(starts[head] & (at + n <= first[doc + 1]))
            whole = run_hashes(sums, inverse, at[fits], n)
            where = np.searchsorted(hashes, whole, "left")
            while len(fits):
                equal = np.flatnonzero(where < len(hashes))
                equal = equal[hashes[where[equal]] == whole[equal]]
                fits, whole, where = fits[equal], whole[equal], where[equal]
                for k, t in zip(fits.tolist(), texts[where].tolist(), strict=True):
                    pair = (int(doc[k]), t)
                    if pair not in found and np.array_equal(ids[at[k] : at[k] + n], self.passages[self.texts[t][0]].words):
                        found.add(pair)
                where = where + 1
        return [(d, k) for d, t in sorted(found) for k in self.texts[t]]

    def candidates(self, term: np.ndarray, first: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Window's first word, its end, passage and cosine of all pairs above the bound."""
        counts = np.diff(first)
        n_blocks = -(-counts // BLOCK)
        doc = np.repeat(np.arange(len(counts)), n_blocks)
        start = first[doc] + BLOCK * (np.arange(len(doc)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks))
        none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.float32),)
        if not len(start) or not self.latent.size:
            return none
        row = self.index[term]
        known = np.flatnonzero(row >= 0)
        paired = np.append(doc[1:] == doc[:-1], False)
        if self.prune:
            # what confirm() looks at reaches PASSAGE words beyond a window
            rare = np.add.reduceat(self.rare[term].astype(np.int32), start)
            total = np.concatenate([[0], np.cumsum(rare)])
            reach = PASSAGE // BLOCK
            lo = np.maximum(np.arange(len(start)) - reach, np.searchsorted(doc, doc))
            hi = np.minimum(np.arange(len(start)) + 2 + reach, np.searchsorted(doc, doc, "right"))
            wanted = total[hi] - total[lo] >= 2
            used = wanted.copy()
            used[1:] |= wanted[:-1] & paired[:-1]
            known = known[used[np.searchsorted(start, known, "right") - 1]]
        else:
            wanted = np.ones(len(start), bool)
        sums = np.zeros((len(start), self.space.shape[1]), np.float32)
        at = np.searchsorted(known, start)
        # a term counts once in a block
        block = np.repeat(np.arange(len(start)), np.diff(np.append(at, len(known))))
        once = np.sort(block * len(self.space) + row[known])
        once = once[np.append(True, once[1:] != once[:-1])] if len(once) else once
        rows = once % len(self.space)
        at = np.searchsorted(once, np.arange(len(start)) * len(self.space))
        full = at < np.append(at[1:], len(rows))
        for lo in range(0, len(start), 512):
            some = np.flatnonzero(full[lo : lo + 512]) + lo
            if len(some):
                end = at[lo + 512] if lo + 512 < len(start) else len(rows)
                sums[some] = np.add.reduceat(self.space[rows[at[some[0]] : end]], at[some] - at[some[0]], axis=0)
        more = np.zeros_like(sums)
        more[:-1][paired[:-1]] = sums[1:][paired[:-1]]
        windows = (sums + more)[wanted]
        start, doc = start[wanted], doc[wanted]
        norm = np.maximum(np.linalg.norm(windows, axis=1), 1e-6)
        found = []
        for lo in range(0, self.latent.shape[1], 1024):
            near = windows @ self.latent[:, lo : lo + 1024]
            w, p = np.nonzero(near >= norm[:, None] * (cosine * self.ease[lo : lo + 1024]))
            found.append((w, p + lo, near[w, p] / norm[w]))
        w, p, c = (np.concatenate(x) for x in zip(*found, strict=True))
        return start[w], np.minimum(start[w] + 2 * BLOCK, first[doc[w] + 1]), p, c

    def confirm(self, p: Passage, words: np.ndarray, present: set, mass: float, common: float) -> float | None:
        """The share of content words in common order, if all checks hold."""
        if sum(m for t, m in zip(p.term.tolist(), p.mass.tolist(), strict=True) if t in present) < mass:
            return None
        region = words.tolist() if p.every else self.content(words)
        share = common_subsequence(p.content, region) / len(p.content)
        if share < common:
            return None
        inside = set(words.tolist())
        said = sum(x in inside for x in p.answer)
        # without a given answer a paraphrase may lack rare words, but not most of them
        if said == len(p.answer) or not p.given and 4 * said >= len(p.answer):
            return share
        return share if common_subsequence(p.words.tolist(), words.tolist()) == len(p.words) else None


def searches(docs: DataFrame, benchmark: DataFrame):
    """Per block of passages what a worker searches with, as a broadcast of bounded size."""
    spark = docs.sparkSession
    frequencies, n_docs = document_frequencies(docs.select(F.col("text").cast("string").alias("text")))
    idf = idf_weights(frequencies, n_docs)
    frequent = float(np.log((n_docs + 1) / (FREQUENT * n_docs + 1)) + 0.05)
    parts = materialise(passages(benchmark, idf), "lsa-passages")
    term, space = latent_space(parts.where(F.size("words") >= MIN_WORDS), idf)
    n_blocks = max(1, -(-parts.count() // SEARCH_PASSAGES))
    for block in range(n_blocks):
        own = parts.where(F.pmod(F.xxhash64("item_id", "part", "words"), F.lit(n_blocks)) == block).select("item_id", "words", "answer").collect()
        rows = sorted(((r.item_id, r.words, r.answer) for r in own), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
        yield spark.sparkContext.broadcast((rows, idf, frequent, term, space))


def leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, mass: float = MASS, common: float = COMMON) -> DataFrame:
    """doc_id, item_id, cosine and lcs_share of every document that holds a benchmark passage."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    found = None
    for held in searches(docs, benchmark):

        def run(stream: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            search = Searcher(*held.value)
            for batch, data, offsets in batches(stream, "text", 1 << 19):
                out = search.found(*terms(data, offsets), cosine, mass, common)
                if out:
                    names = batch.column(0).to_pylist()
                    yield pa.RecordBatch.from_arrays([pa.array([names[o[0]] for o in out], pa.int64()), *(pa.array([o[k] for o in out], t) for k, t in ((1, pa.int64()), (2, pa.float64()), (3, pa.float64())))], names=["doc_id", "item_id", "cosine", "lcs_share"])

        one = rows.mapInArrow(run, "doc_id long, item_id long, cosine double, lcs_share double")
        found = one if found is None else found.unionByName(one)
    return found.groupBy("doc_id", "item_id").agg(F.max("cosine").alias("cosine"), F.max("lcs_share").alias("lcs_share"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, mass: float = MASS, common: float = COMMON) -> DataFrame:
    """The rows of docs that hold no benchmark passage; each row is judged by its own text."""
    kept = docs
    for held in searches(docs, benchmark):

        def run(stream: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            search = Searcher(*held.value)
            for batch, data, offsets in batches(stream, "text", 1 << 19):
                clean = np.ones(batch.num_rows, bool)
                clean[[o[0] for o in search.found(*terms(data, offsets), cosine, mass, common)]] = False
                yield batch.filter(pa.array(clean))

        kept = kept.mapInArrow(run, docs.schema)
    return kept


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
