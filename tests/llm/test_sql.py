"""The SQL of the two similarity joins against the operators, on fixtures with planted links."""

import random

import duckdb
import numpy as np
import pandas as pd

from roadsight.llm import embed_dedup, ngram_join


def same(df, sql, **tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        con.register(name, rows)
    want = con.sql(sql)
    cols = sorted(want.columns)
    assert sorted(df.columns) == cols
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    want = sorted(want.select(*cols).fetchall(), key=repr)
    assert got == want
    return [dict(zip(cols, r)) for r in got]


def test_dedup_sql(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((40, 16))
    rows = [v for v in base]
    rows += [base[i] + 0.05 * rng.standard_normal(16) for i in range(20) for _ in range(3)]  # near copies
    rows += [base[0]] * 5 + [2 * base[1]]
    rows += [None, np.zeros(16), np.where(np.arange(16) == 3, np.nan, base[2]), np.where(np.arange(16) == 3, np.inf, base[2])]
    data = pd.DataFrame({"vec_id": rng.permutation(len(rows)) + 7,
                         "embedding": [None if v is None else [float(np.float32(x)) for x in v] for v in rows]})
    df = spark.createDataFrame([(int(i), e) for i, e in zip(data.vec_id, data.embedding)], "vec_id long, embedding array<float>")
    got = same(embed_dedup.dedup(df), embed_dedup.DEDUP_SQL, embeddings=data)
    assert sum(r["n_links"] > 0 for r in got) == 86 and sum(r["kept"] for r in got) == 44


def test_join_sql(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.choice([60, 90, 200]))] for _ in range(30)]
    texts = [" ".join(b) for b in base]
    for b in base[:15]:
        for _ in range(3):
            c = list(b)
            c[rng.randrange(len(c))] = "changed"
            texts.append(" \t".join(c).upper())
    texts += [texts[0]] * 4 + ["a b c", "A  b\nc", "a b", "", " ", None, None, "äÄ Ö", "Ää Ö"]
    data = pd.DataFrame({"doc_id": rng.sample(range(1000), len(texts)), "text": texts})
    df = spark.createDataFrame(list(zip(data.doc_id.tolist(), texts)), "doc_id long, text string")
    got = same(ngram_join.join(df), ngram_join.JOIN_SQL, documents=data)
    assert sum(r["component_id"] != r["doc_id"] for r in got) == 50
