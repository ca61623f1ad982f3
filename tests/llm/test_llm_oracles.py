"""The SQL texts of the corpus queries on small tables with nulls, ties and hard strings."""

import random

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from conftest import SMALL
from weftline.llm.registry import ORACLES, QUERIES


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    return repr(v + 0.0) if isinstance(v, float) else f"{type(v).__name__}:{v}"


def same(spark, name, folder, tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    df, relation = QUERIES[name](spark, str(folder)), con.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    at = [relation.columns.index(c) for c in columns]
    found = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert found == sorted(tuple(plain(r[i]) for i in at) for r in relation.fetchall())
    return found


@pytest.fixture(scope="module")
def hard(tmp_path_factory):
    rng = random.Random(3)
    folder = tmp_path_factory.mktemp("hard")
    alphabet = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    bits = ["password", "PassWD", "Token", "api_key", " ", "=", ":", '"', "'", "abcdefgh", "AKIAABCDEFGHIJKL", "é", "\n", "0123456789abcdef" * 2, "get_user_name_2024_index", "".join(rng.choice(alphabet) for _ in range(32))]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(200)]
    texts += ["see " + "".join(rng.choice(alphabet) for _ in range(rng.randint(18, 60))) + " now" for _ in range(100)] + [None, "", "x\x0by\x0cz"]
    sources = [rng.choice(["a", "B", "é", "zz", None, ""]) for _ in texts]
    pq.write_table(pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts, "lang": ["en"] * len(texts), "source": sources, "n_chars": pa.array([len(t or "") for t in texts], pa.int64())}), folder / "documents.parquet")
    html = [rng.choice(["a", "b", "é" * 9, "", "<p>"]) + rng.choice(["", "x"]) for _ in range(60)]
    pq.write_table(pa.table({"page_id": pa.array(range(60), pa.int64()), "url": ["http://x"] * 60, "html": html}), folder / "pages.parquet")
    texts = ["\\### Assistant: </turn> ok", "", None, "<|image:0|>", "a\nb\\", "####", "é"]
    rows = [(c, t, ["user", "assistant", "system"][t % 3], texts[(c + t) % len(texts)]) for c in range(20) for t in range(6)]
    pq.write_table(pa.table({k: pa.array([r[i] for r in rows], t) for i, (k, t) in enumerate([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])}), folder / "conversations.parquet")
    x = np.random.default_rng(1).standard_normal((30, 8))
    x = np.concatenate([x, x[:10] + 0.1, x[:5], np.zeros((1, 8))]).astype(np.float32)
    vectors = [*x.tolist(), None, [float("nan")] * 8]
    pq.write_table(pa.table({"vec_id": pa.array(range(len(vectors)), pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32())), "label": pa.array([0] * len(vectors), pa.int32())}), folder / "embeddings.parquet")
    return folder


@pytest.mark.parametrize(("name", "table"), [("op1_source_mixing", "documents"), ("op4_embedding_dedup", "embeddings"), ("op6_warc_pages", "pages"), ("op8_chat_format", "conversations"), ("op10_secret_scan", "documents")])
def test_hard_rows(spark, hard, name, table):
    found = same(spark, name, hard, [table])
    if name == "op10_secret_scan":
        assert sum("random:" in str(r) for r in found) > 60


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_run_whole(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert df.count() > 0 or name == "op7_decontamination"
    assert df.columns[0] == "doc_id"
