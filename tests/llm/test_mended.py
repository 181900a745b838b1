"""Cases that lost results or grew without bound before."""

import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadsight.llm import embed_dedup, fixity, license_scan, mixing, url_cascade
from roadsight.llm.common import components


def planted(rows, pairs, width, cone, seed):
    """Unit vectors with a mean cosine of about ``cone``; the first ``pairs`` have a partner at cosine 0.955."""
    rng = np.random.default_rng(seed)
    axis = np.zeros(width)
    axis[0] = 1
    x = rng.standard_normal((rows, width))
    x = np.sqrt(1 - cone) * x / np.linalg.norm(x, axis=1, keepdims=True) + np.sqrt(cone) * axis
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal((pairs, width))
    side -= (side * x[:pairs]).sum(1, keepdims=True) * x[:pairs]
    x[pairs:2 * pairs] = 0.955 * x[:pairs] + np.sqrt(1 - 0.955 ** 2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    return x


@pytest.mark.parametrize("cone", [0.0, 0.8])
def test_embedding_pairs_are_found_in_a_cone(spark, cone):
    x = planted(12_000, 300, 48, cone, 4)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = embed_dedup.dedup(df, passes=1, block=48).toPandas().set_index("vec_id").sort_index()
    true = (x[:300] @ x.T >= 0.95).sum(1) - 1
    assert (got.n_links[:300] >= 1).mean() >= 0.98 and (got.n_links[:300] <= true).all()


def brute_chain(found):
    """Words covered by the best of all chains."""
    best = 0
    for n in range(1, len(found) + 1):
        for chain in itertools.combinations(sorted(found), n):
            covered, ok = chain[0][2], True
            for (s0, p0, z0), (s1, p1, z1) in zip(chain, chain[1:]):
                over = max(0, s0 + z0 - s1, p0 + z0 - p1)
                ok &= (s1 <= s0 + z0 + license_scan.MAX_GAP and p1 >= p0 and s1 + z1 > s0 + z0 and p1 + z1 > p0 + z0 and z1 > over)
                covered += z1 - over
            if ok:
                best = max(best, covered)
    return best


def test_best_chain_equals_all_chains():
    rng = np.random.default_rng(8)
    for _ in range(150):
        found = [(int(rng.integers(0, 60)), int(rng.integers(0, 40)), int(rng.integers(3, 15))) for _ in range(int(rng.integers(1, 8)))]
        first, past, covered = license_scan.best_chain(found)
        assert covered == brute_chain(found) and first < past
        spans = license_scan.chains(found)
        assert max(c for _, _, c in spans) == covered
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_template_that_repeats_a_passage_is_one_span():
    middle, tail = " ".join(f"d{i}" for i in range(7)), " ".join(f"k{i}" for i in range(7))
    template = f"alpha beta gamma {middle} alpha beta gamma {tail}"
    scanner = license_scan.Scanner((("t", template),), ())
    text = f"alpha beta gamma {middle} extra alpha beta gamma other {tail}"
    hashes, _ = scanner.hasher.texts(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    spans = scanner.spans(scanner.numbers(hashes))
    assert len(spans) == 1 and spans[0][3] >= 0.85


def test_end_places_follow_the_link_tree():
    rng = np.random.default_rng(2)
    templates = [list(map(int, rng.integers(0, 3, 15))) for _ in range(3)]
    auto = license_scan.Automaton(templates)
    for t, words in enumerate(templates):
        for i, j in itertools.combinations(range(16), 2):
            state = 0
            for w in words[i:j]:
                state = auto.next[state][w]
            want = {(u, k + j - i - 1) for u, other in enumerate(templates) for k in range(16 - (j - i)) if other[k:k + j - i] == words[i:j]}
            assert set(auto.ends(state)) == want


def test_cascade_levels_stay_small_with_few_listed_keys(spark):
    keys = spark.range(200_000).select(F.concat(F.lit("h"), "id").alias("key"), (F.col("id") < 6).alias("listed"))
    cascade = url_cascade.Cascade(keys, max_bytes=1024)
    assert cascade.groups == 1 and all(level.bits <= 8 * 1024 for level in cascade.levels[0])
    assert cascade.mark(keys, "key", "found").where("found <> listed").count() == 0


def test_judge_by_a_table_of_hosts(spark):
    pages = spark.createDataFrame([(i, f"http://{h}/p{i}", "g") for i, h in enumerate(["A.com", "b.com", "c.com", "b.com", "x.net"])],
                                  "page_id long, url string, group string")
    listed = spark.createDataFrame([("B.com",), ("gone.com",), (None,), ("b.com",)], "host string")
    for max_bytes in (1 << 20, 8):
        got = {r.page_id: (r.listed, r.verdict) for r in url_cascade.judge(pages, listed, max_bytes=max_bytes).collect()}
        assert got == {0: (False, "allow"), 1: (True, "block"), 2: (False, "allow"), 3: (True, "block"), 4: (False, "block")}


def test_one_id_of_very_many_records_is_cut_into_ranges(spark, monkeypatch):
    monkeypatch.setattr(fixity, "LEAF", 256)
    monkeypatch.setattr(fixity, "FANOUT", 4)
    rows = [(7, f"http://a.org/{i}", "x" * (i % 9)) for i in range(400)] + [(None, f"http://b.org/{i}", None) for i in range(50)]
    rows += [(i, f"http://c.org/{i}", "y") for i in range(8, 60)] + [(7, "http://a.org/1", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    record = fixity.record(F.col("url"), F.col("html"))
    placed = fixity.manifest(df.select("page_id", F.octet_length(record).cast("long").alias("length"), F.sha2(record, 256).alias("digest")))
    got = placed.toPandas()
    assert len(got) == 502
    for _, archive in got.groupby("archive"):
        archive = archive.sort_values(["page_id", "digest"])
        assert archive.offset.tolist() == (archive.length.cumsum() - archive.length).tolist()
    size = int((got.offset + got.length).max())
    assert fixity.levels_for(size) > 4 and 256 * 4 ** (fixity.levels_for(size) - 1) >= size
    other = placed.withColumn("digest", F.when(F.col("offset") == 0, F.lit("rot")).otherwise(F.col("digest")))
    bad = fixity.audit(placed, other).collect()
    assert len(bad) == got.archive.nunique() and {(r.offset, r.status, r.found_digest) for r in bad} == {(0, "altered", "rot")}
    assert fixity.audit(placed, placed).count() == 0


def brute_targets(sizes):
    """Sharing round after round, sources by code point with null last."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, total = {}, 1.5 * sum(sizes.values())
    while True:
        left = [s for s in names if s not in target]
        if not left:
            return target
        rate = (total - sum(target.values())) / sum(weight[s] for s in left)
        over = [s for s in left if weight[s] * rate > 2 * sizes[s]]
        if not over:
            return target | {s: weight[s] * rate for s in left}
        target |= {s: 2.0 * sizes[s] for s in over}


@pytest.mark.parametrize("span", [3, 4096])
def test_targets_equal_sharing_in_rounds(spark, monkeypatch, span):
    monkeypatch.setattr(mixing, "RANGE", span)
    rng = np.random.default_rng(8)
    for trial in range(4):
        sizes = {f"s{i}": int(n) for i, n in enumerate(np.exp(rng.uniform(0, 9, 4 + 9 * trial)))} | {None: 40, "empty": 0}
        items = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, size long, copies long")
        got = {r.source: r.target for r in mixing.targets(items).collect()}
        want = brute_targets(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) <= 1e-9 * max(1, want[s]) for s in want)
    none = spark.createDataFrame([], "source string, size long, copies long")
    assert mixing.targets(none).count() == 0
    zero = spark.createDataFrame([("a", 0, 3), (None, 0, 1)], "source string, size long, copies long")
    assert {r.target for r in mixing.targets(zero).collect()} == {0.0}


def test_components_of_a_hub_and_a_chain(spark):
    edges = [(0, i) for i in range(1, 3000)] + [(i, i + 1) for i in range(5000, 5040)] + [(2999, 9000), (9000, 9001), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(3000)} | {i: 5000 for i in range(5000, 5041)} | {9000: 0, 9001: 0}
    assert got == want


def test_mixed_documents_fill_all_partitions_in_order_of_their_shards(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 8)
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 6)
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("source"),
                                    F.expr("if(id % 50 = 0, null, repeat('w ', int(id % 9) + 1))").alias("text"))
    got = mixing.mixed_documents(docs).withColumn("part", F.spark_partition_id())
    sizes = sorted(r["count"] for r in got.groupBy("part").count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 1.5 * sizes[0]
    taken = {r.doc_id: (r.taken // r["size"] if r["size"] else 1) for r in mixing.taken_words(docs).collect()}
    count = {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert count == {d: n for d, n in taken.items() if n}


def test_mixed_documents_move_a_text_only_to_its_shard(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 4)
    docs = spark.range(2000).select(
        F.expr("if(id % 90 = 0, null, id)").alias("doc_id"), F.expr("element_at(array('a', 'b', null), int(id % 7 % 3) + 1)").alias("source"),
        F.expr("if(id % 50 = 0, null, repeat('w ', int(id % 9) + 1))").alias("text"), F.col("id").alias("row"))
    apart = mixing.mixed_documents(docs.where("doc_id is not null"))
    apart.collect()
    moved = apart._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"(?<!Broadcast)Exchange ", moved)) == 1
    several = docs.unionByName(docs.where("row % 40 = 1")).unionByName(docs.where("row % 40 = 1"))
    counted = lambda df: sorted((r.row, r["count"]) for r in df.groupBy("row").count().collect())
    got = counted(mixing.mixed_documents(several))
    assert len(got) > 1000
    monkeypatch.setattr(mixing, "DECISIONS", 0)     # texts meet their items by a shuffle
    assert counted(mixing.mixed_documents(several)) == got
