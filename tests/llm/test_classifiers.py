"""Scores of the classifiers against plain versions that take one text and one word at a time."""

import hashlib
import math
import pickle
import random
import re
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import quality, toxicity

from test_llm_small import docs_of

TOKENS = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
SPACED = re.compile(rb"[^\x20\x09-\x0d]+")


def alone(buckets, raw):
    found, first = buckets(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert first[1] == found.shape[1]
    return found


def plain_toxicity(model, text):
    """The score of one text, window by window."""
    words = [sum(model.embed[k] for k in alone(toxicity.buckets, w)[:, 0]) for w in TOKENS.findall((text or "").encode())]
    pooled = []
    for filters in model.filters:
        best = np.zeros(toxicity.FILTERS)
        for i in range(len(words)):
            best = np.maximum(best, sum(w @ f for w, f in zip(words[i : i + len(filters)], filters)))
        pooled.append(best)
    z = float(np.maximum(np.concatenate(pooled) + model.bias, 0) @ model.out + model.shift[0])
    return 1 / (1 + math.exp(-z))


def plain_tails(model, text):
    """P(grade > k) of one text, each word seen with the one before it."""
    words = SPACED.findall((text or "").encode())
    total = 0.0
    for i, w in enumerate(words):
        found = alone(quality.buckets, b" ".join(words[max(i - 1, 0) : i + 1]))
        total += sum(float(model.weights[f[-1]]) for f in found)
    return [1 / (1 + math.exp(-(total / max(len(words), 1) - t))) for t in model.thresholds]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    made = ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeioué") for _ in range(rng.randint(1, 4))) for _ in range(300)]
    text = lambda n: rng.choice([" ", "  ", "\n", " - "]).join(rng.choice(made) for _ in range(n))
    out = []
    for i in range(240):
        bad = i % 3 == 0
        words = [*(["Vexling"] if bad else []), text(rng.randint(1, 40))]
        out.append((i, " ".join(words), rng.choice(["en", "fr", None]), "s", 1))
    out += [(300, None, "en", "s", 0), (301, "", None, "s", 0), (302, " \n!", "en", "s", 0), (303, "a", "en", "s", 1), (None, "no id", "en", "s", 1)]
    out += [(304, text(30_000), "en", "s", 1), (5, out[5][1], "en", "s", 1), (306, "!!" + out[5][1], "en", "s", 1)]
    return out


def test_toxicity_scores_stand_alone(spark, rows):
    docs = docs_of(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(240)] + [(7, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, epochs=6)
    want = {t: plain_toxicity(model, t) for _, t, *_ in rows}
    for parts in (1, 7):  # whatever texts lie beside it
        got = toxicity.score(docs.repartition(parts, F.xxhash64("text")), model).collect()
        assert len(got) == len(rows)
        assert max(abs(r.score - want[r.text]) for r in got) < 1e-4
    assert want[None] == want[""] == want[" \n!"]


def test_toxicity_learns_from_every_labelled_row(spark):
    rng = random.Random(4)
    made = ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(60)]
    text = lambda *extra: " ".join(rng.sample([*rng.choices(made, k=5), *extra], 5 + len(extra)))
    ids = [i for i in range(6000) if zlib.crc32(str(i).encode()) % 5]
    bad = sorted(ids[:3000], key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    # one word is common to the first 2,500 rows of its class by a hash, others to the last 500
    rows = [(i, text("grumpola" if k < 2500 else "vexling"), "en", "s", 1) for k, i in enumerate(bad)] + [(i, text(), "en", "s", 1) for i in ids[3000:4000]]
    labels = spark.createDataFrame([(i, 1) for i in bad] + [(i, 0) for i in ids[3000:4000]], "doc_id long, toxic int")
    model = toxicity.train(docs_of(spark, rows), labels, epochs=20)
    asked = docs_of(spark, [(10_000 + k, text(*w), "en", "s", 1) for k, w in enumerate([("grumpola",), ("vexling",), ()] * 50)])
    right = {w: [] for w in range(3)}
    for r in toxicity.score(asked, model).collect():
        right[(r.doc_id - 10_000) % 3].append((r.score >= 0.5) == ((r.doc_id - 10_000) % 3 < 2))
    assert min(np.mean(v) for v in right.values()) > 0.9
    # rows of one language alone beyond the first 2,500 still get it a threshold
    late = set(bad[2500:]) | set(ids[3000:3500])
    tongues = docs_of(spark, [(i, t, "fr" if i in late else "en", s, n) for i, t, _, s, n in rows])
    assert set(toxicity.train(tongues, labels, epochs=1).thresholds) == {"en", "fr"}


def test_toxicity_shards_hold_every_row_in_any_order(spark, rows, monkeypatch):
    docs, labels = docs_of(spark, rows), spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(240)], "doc_id long, toxic int")
    seen, fit = [], toxicity.fit

    def watched(shards, weights, **options):
        kept = [s for r in shards.toArrow().to_batches() for s in toxicity.unpacked([r])]
        words = sorted((p.tobytes(), int(y), lang or "") for parts, labels, _, langs, _ in kept for p, y, lang in zip(parts, labels, langs, strict=True))
        seen.append((len(kept), words))
        return fit(shards, weights, **options)

    monkeypatch.setattr(toxicity, "fit", watched)
    models = [toxicity.train(docs.repartition(1), labels, shard_bytes=4000, epochs=3)]
    monkeypatch.setattr(toxicity, "PARTIALS", 1)
    models.append(toxicity.train(docs.repartition(7), labels, shard_bytes=4000, epochs=3))
    trained = [(t, i % 3 == 0, lang) for i, t, lang, *_ in rows if i is not None and i < 240 and zlib.crc32(str(i).encode()) % 5]
    want = sorted((alone(toxicity.buckets, t.encode()).astype(np.uint16).tobytes(), int(y), lang or "") for t, y, lang in trained)
    assert [words for _, words in seen] == [want] * 2 and seen[0][0] == seen[1][0] > 4
    assert all((a == b).all() for a, b in zip(toxicity.State(models[0], [], []).params(), toxicity.State(models[1], [], []).params(), strict=True))
    assert models[0].thresholds == models[1].thresholds


def test_toxicity_epochs_leave_no_sums_on_the_driver(spark, rows):
    docs, labels = docs_of(spark, rows), spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(240)], "doc_id long, toxic int")
    states = (1 + toxicity.FOLDS) * len(pickle.dumps(toxicity.initial(5)))
    tracemalloc.start()
    try:
        toxicity.train(docs, labels, shard_bytes=4000, epochs=2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 6 * states


def plain_gradients(model, texts, labels, weights):
    """Gradients of a batch, text by text and filter by filter, and where each maximum lies."""
    found, places, at = [np.zeros(p.shape) for p in toxicity.State(model, [], []).params()], [], 0
    for text, y in zip(texts, labels):
        words = np.concatenate([np.sum(model.embed[text.astype(int)], axis=0, dtype=float), np.zeros((2, toxicity.WIDTH))])
        sums = [np.array([sum(words[i + o] @ f[o] for o in range(len(f))) for i in range(text.shape[1])] + [np.zeros(toxicity.FILTERS)] * 2) for f in model.filters]
        tops = np.concatenate([s.max(axis=0) for s in sums])
        spots = np.concatenate([s.argmax(axis=0) for s in sums])
        z = tops + model.bias
        d = (1 / (1 + math.exp(-(np.maximum(z, 0) @ model.out + model.shift[0]))) - y) * weights[y] / len(texts)
        dz = d * model.out * (z > 0)
        found[-1] += d
        found[-2] += d * np.maximum(z, 0)
        found[-3] += dz
        for j, i in enumerate(spots):
            k, f = divmod(j, toxicity.FILTERS)
            for o in range(len(model.filters[k]) if i < text.shape[1] else 0):
                found[1 + k][o][:, f] += dz[j] * words[i + o]
                for b in text[:, i + o] if i + o < text.shape[1] else []:
                    found[0][b] += dz[j] * model.filters[k][o][:, f]
        places.append(at + spots)
        at += text.shape[1] + 2
    return found, np.array(places).T


@pytest.mark.parametrize("piece", [3, 64, 4096])
def test_toxicity_gradients_text_by_text(monkeypatch, piece):
    monkeypatch.setattr(toxicity, "PIECE", piece)
    rng = np.random.default_rng(8)
    texts = [rng.integers(0, toxicity.VOCABULARY, (3, n)).astype(np.uint16) for n in (0, 1, 2, 5, 0, 150, 3, 64, 62, 1, 0, 40, 0)]
    texts.append(np.repeat(texts[3], 4, axis=1))
    labels, weights = rng.integers(0, 2, len(texts)), np.array([0.7, 2], np.float32)
    state = toxicity.initial(3)
    want, places = plain_gradients(state.model, texts, labels, weights)
    rows = toxicity.spaced(texts)
    starts = np.cumsum([0, *[r.shape[1] for r in rows[:-1]]])
    assert (toxicity.peaks(state.model, np.concatenate(rows, axis=1).astype(np.intp), starts)[2] == places).all()
    met = toxicity.epoch(state, rows, labels, weights, np.arange(len(texts)), 0.02, 10_000)
    assert (met == want[0].any(axis=1)).all() and state.step == 1
    for got, g in zip(state.first, want, strict=True):
        assert np.abs(10 * got - g).max() < 1e-5 * max(np.abs(g).max(), 1)


def test_toxicity_cut_of_counts():
    rng = np.random.default_rng(6)
    at = np.sort(rng.choice(1000, 40, replace=False)) / 16
    zeros, ones = rng.integers(0, 5, 40), rng.integers(0, 5, 40)
    right = lambda t: zeros[at < t].sum() / zeros.sum() + ones[at >= t].sum() / ones.sum()
    assert right(toxicity.cut(at, zeros, ones)) == pytest.approx(max(right(t) for t in [*(at - 1e-6), at[-1] + 1]))
    assert toxicity.cut(at, zeros, 0 * ones) == 0


def test_grades_stand_alone(spark, rows):
    docs = docs_of(spark, rows)
    ratings = spark.createDataFrame([(i, 1 if i % 3 == 0 else 2 + 2 * (i % 2)) for i in range(240)] + [(7, None), (None, 1), (8, 1)], "doc_id long, quality int")
    model = quality.train(docs, ratings, epochs=20)
    assert model.grades.tolist() == [1, 2, 4]
    want = {t: plain_tails(model, t) for _, t, *_ in rows}
    got = quality.score(docs.repartition(3), model).collect()
    assert len(got) == len(rows)
    for r in got:
        tails = want[r.text]
        assert abs(r.p_good - tails[0]) < 1e-6 and abs(r.expected_grade - (1 + tails[0] + 2 * tails[1])) < 1e-6
    upper = quality.score(docs, model, cut=2).collect()
    assert all(abs(r.p_good - want[r.text][1]) < 1e-6 for r in upper)
