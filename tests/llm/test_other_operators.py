"""Pages, vectors and the pipeline against brute force and SQL."""

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from roadsight.llm import embed_dedup, fixity, hilbert_ann, url_cascade
from roadsight.llm.common import components

SF = "/root/testdata/sf0.001"


def same(spark_df, sql, **tables):
    for name, pdf in tables.items():
        duckdb.register(name, pdf)
    want = duckdb.sql(sql).df()
    got = spark_df.toPandas()[list(want.columns)]
    plain = lambda v: None if pd.isna(v) else float(v) if isinstance(v, (int, float)) else v
    as_text = lambda d: sorted(str([plain(v) for v in row]) for row in d.astype(object).values.tolist())
    assert as_text(got) == as_text(want)


def test_fixity(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    same(fixity.audit_pages(pages), fixity.AUDIT_SQL, pages=pages.toPandas())
    odd = spark.createDataFrame([(5, None, "h", "x"), (5, None, "h", "x"), (None, "u", None, "x"), (11, "u", "lost", "x"), (102, "u", None, "x")],
                                "page_id long, url string, html string, archive string")
    got = {r.page_id: r.status for r in fixity.audit_pages(odd).collect()}
    assert got == {5: "altered", 11: "missing", 102: "resized"}
    assert fixity.audit_pages(odd.limit(0)).count() == 0


def test_cascade_is_exact(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    same(url_cascade.judge(pages, url_cascade.spam_host), url_cascade.JUDGE_SQL, pages=pages.toPandas())
    keys = spark.range(3000).select(F.concat(F.lit("h"), "id").alias("key"), (F.col("id") % 3 == 0).alias("listed"))
    for max_bytes in (4 << 20, 256):
        cascade = url_cascade.Cascade(keys, max_bytes)
        marked = cascade.mark(keys, "key", "found")
        assert marked.count() == 3000 and marked.where("found <> listed").count() == 0
    assert cascade.groups > 1


def test_urls_without_a_host(spark):
    rows = [(1, None), (2, "no scheme"), (3, "HTTP://EXAMPLE.Net/en/x?y"), (4, "a://example.net"), (5, "a://b.org#/fr/"), (6, "a://b.org/fr/1"), (None, "a://x.net/")]
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in rows], "page_id long, url string, host string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_cascade.judge(pages, url_cascade.spam_host).collect()}
    assert got == {1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 3: ("example.net", "/en/x", "example.net/en/", "allow"),
                   4: ("example.net", "", None, "allow"), 5: ("b.org", "", None, "allow"), 6: ("b.org", "/fr/1", "org/fr/", "allow"),
                   None: ("x.net", "/", "net/", "block")}
    assert url_cascade.judge(pages.limit(0), url_cascade.spam_host).count() == 0


def vectors():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((300, 16)).astype(np.float32)
    x[50:90] = x[50] + 0.05 * rng.standard_normal((40, 16))
    x[100:140] = x[100]
    return x


def embeddings(spark, x):
    rows = [(i, v.tolist(), 0, 1) for i, v in enumerate(x)]
    n = len(rows)
    rows += [(n, None, 0, 1), (n + 1, [0.0] * 16, 0, 1), (n + 2, [float("nan")] * 16, 0, 1), (n + 3, [1.0, None] + [0.0] * 14, 0, 1),
             (n + 4, [1.0] * 8, 0, 1), (n + 5, [], 0, 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node int")


def test_embedding_dedup(spark):
    x = vectors()
    df = embeddings(spark, x)
    got = embed_dedup.dedup(df, block=64).toPandas().set_index("vec_id")
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    links = (u @ u.T >= 0.95).sum(1) - 1
    assert len(got) == 306 and (got.n_links[:300] == links).all() and (got.n_links[300:] == 0).all()
    assert got.component_id[120] == 100 and got.component_id[89] == 50 and not got.kept[120] and got.kept[303]
    doubles = embed_dedup.dedup(df.withColumn("embedding", F.col("embedding").cast("array<double>")), block=64)
    assert doubles.toPandas().set_index("vec_id").sort_index().equals(got.sort_index())
    assert embed_dedup.dedup(df.limit(0)).count() == 0


def test_embedding_dedup_counts_groups_wider_than_its_windows(spark):
    rng = np.random.default_rng(10)
    x = rng.standard_normal((1500, 32))
    x[100:800] = x[100] + 0.2 * rng.standard_normal((700, 32))
    x[900:905] = x[900] + 0.1 * rng.standard_normal((5, 32))
    x[800:803] = x[150]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = embed_dedup.dedup(df, block=32).toPandas().set_index("vec_id").sort_index()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert (got.n_links == (u @ u.T >= 0.95).sum(1) - 1).all()


def test_embedding_dedup_passes_grow_with_the_rows(spark):
    rng = np.random.default_rng(12)
    x = rng.standard_normal((8000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal((400, 32))
    side -= (side * x[:400]).sum(1, keepdims=True) * x[:400]
    x[400:800] = 0.9505 * x[:400] + np.sqrt(1 - 0.9505 ** 2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = embed_dedup.dedup(df, passes=2, block=32).toPandas().set_index("vec_id")
    assert (got.n_links[:400] >= 1).sum() >= 392
    assert embed_dedup.passes_for(80_000, 0.95, 1024) == 8 < embed_dedup.passes_for(1_000_000, 0.95, 1024)


def test_hilbert_search(spark):
    x = vectors()
    df = embeddings(spark, x)
    got = hilbert_ann.search(df, F.col("vec_id") % 20 == 0, k=5, block=64).toPandas()
    s = x.astype(np.float64) @ x.astype(np.float64).T
    hit = total = 0
    for q in range(0, 300, 20):
        order = sorted((j for j in range(300) if j != q), key=lambda j: (-round(s[q, j], 9), j))[:5]
        own = got[got.query_id == q].sort_values("rank")
        assert list(own["rank"]) == [1, 2, 3, 4, 5]
        hit, total = hit + len(set(order) & set(own.vec_id)), total + 5
        if 100 <= q < 140:
            assert set(order) == set(own.vec_id)
    assert hit / total >= 0.9
    few = hilbert_ann.search(df.where("vec_id < 3"), F.col("vec_id") == 0).toPandas()
    assert sorted(few.vec_id) == [1, 2]
    assert hilbert_ann.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_hilbert_recall_holds_as_rows_outgrow_the_blocks(spark):
    x = np.random.default_rng(8).standard_normal((6000, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = hilbert_ann.search(df, F.col("vec_id") % 20 == 0, orderings=4, block=64).toPandas()
    asked = np.arange(0, 6000, 20)
    s = x[asked].astype(np.float64) @ x.T.astype(np.float64)
    s[np.arange(len(asked)), asked] = -2
    true = {(int(q), int(j)) for q, row in zip(asked, np.argsort(-s, axis=1)[:, :20]) for j in row}
    assert len(true & set(zip(got.query_id, got.vec_id))) >= 0.9 * len(true)


def test_hilbert_search_ranks_by_product_of_unequal_norms(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((6000, 32))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True) * np.exp(0.5 * rng.standard_normal((6000, 1)))).astype(np.float32)
    x[17] *= 1e-30
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = hilbert_ann.search(df, F.col("vec_id") % 20 == 0, block=64).toPandas()
    asked = np.arange(0, 6000, 20)
    s = x[asked].astype(np.float64) @ x.T.astype(np.float64)
    s[np.arange(len(asked)), asked] = -np.inf
    true = {(int(q), int(j)) for q, row in zip(asked, np.argsort(-s, axis=1)[:, :20]) for j in row}
    assert len(true & set(zip(got.query_id, got.vec_id))) >= 0.9 * len(true)
    assert got.groupby("query_id").size().eq(20).all()


def test_hilbert_curve_visits_neighbours():
    grid = np.stack(np.meshgrid(np.arange(8), np.arange(8), indexing="ij"), -1).reshape(-1, 2)
    path = grid[np.argsort(hilbert_ann.hilbert_key(grid, 3))]
    assert sorted(hilbert_ann.hilbert_key(grid, 3)) == list(range(64))
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_components(spark):
    rng = np.random.default_rng(7)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))] + [(i, i + 1) for i in range(1000, 1040)]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in edges:
        lo, hi = sorted((find(a), find(b)))
        root[hi] = lo
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: find(n) for n in root if any(n in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_pipeline(spark):
    import corpus_pipeline
    from roadsight.llm.common import stage, table
    docs, seen = table(spark, SF, "documents"), []
    for name, function in corpus_pipeline.STAGES:
        out = stage(function(spark, docs, SF), name)
        seen.append(out.count())
        if name != "pack":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            docs = out
    assert seen[0] >= seen[1] == seen[2] > 0
    packed: pd.DataFrame = out.toPandas()
    assert packed.groupby("sequence_id")["length"].sum().max() <= 2048
