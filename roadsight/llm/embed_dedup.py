"""Embedding near-duplicates by sorted projection passes.

Each pass gives a vector the concatenated signs of its products with random directions, orders all
vectors by that string and compares each with its neighbours in the order: blocks of ``BLOCK``
consecutive vectors meet themselves and the block before, so every vector sees at least ``BLOCK``
neighbours on either side.  Verified pairs (cosine in double precision) of all passes are united to
components, to which a block gives at most one edge a row.

Links are then counted within each component, every row against every other that can link with it, so
no window bounds ``n_links``: it is exact wherever the component is whole.  Large components are counted
by pairs of chunks.  Equal vectors are one class, counted with their number, so copies are never paired.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing, as do
vectors of different lengths.  Rows without vec_id take part; their component is the smallest id
reachable, if any.  An empty table gives no rows.

Signs are taken of unit vectors less their mean direction, as embeddings that lie in a cone would
share most signs otherwise.  Recall: passes are added until probes meet.  Probes are rows of a bounded
sample (``SAMPLE``), each with a made-up partner at the least cosine; how far two keys lie apart among all
rows is read off the sample, and the number of passes is such that the mean chance of a probe to stay
unmet in all of them is ``MISS`` at most.  Every row is indexed.  Links are never wrong.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from roadsight.llm.common import components, small_side, stage, with_rank
from roadsight.llm.vectors import by_length, classes, in_blocks, matrix, valid, vector_of

LEAST, PASSES, BLOCK, SIGNS = 0.95, 8, 1024, 48
#: Components of more than a block that are broadcast at most.
BROADCAST = 100_000
#: Bound on the chance that all passes miss a pair at the least cosine.
MISS = 0.005
#: Rows, about, that the mean direction and the number of passes are taken from; probes and passes measured.
SAMPLE, PROBES, MEASURED = 32_768, 512, 64


def passes_for(rows: int, least: float, block: int) -> int:
    """How many passes keep the chance to miss a pair at cosine ``least`` within ``MISS``."""
    meet = (1 - np.arccos(least) / np.pi) ** np.log2(max(rows / block, 1))
    return 1 if meet >= 1 else int(np.ceil(np.log(MISS) / np.log1p(-meet)))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _keys(x: np.ndarray, mean: np.ndarray | None, passes: int, seed: int) -> np.ndarray:
    """Concatenated signs of the rows of x, one key a pass; the first passes are the same whatever their number."""
    weights = np.left_shift(np.int64(1), np.arange(SIGNS, dtype=np.int64)[::-1])
    centred = _unit(x) if mean is None else _unit(x) - mean
    out = np.empty((len(x), passes), np.int64)
    for k in range(passes):
        planes = np.random.default_rng([seed, x.shape[1], k]).standard_normal((x.shape[1], SIGNS))
        out[:, k] = ((centred @ planes) > 0) @ weights
    return out


def survey(sets: DataFrame, rows: int, least: float, block: int, seed: int) -> tuple[dict[int, np.ndarray], int]:
    """Mean direction of the vectors of each length, and how many passes keep missed probes within ``MISS``."""
    share = max(1, rows // SAMPLE)
    some = sets.where(F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(share)) == 0).select("vector").toArrow()  # about SAMPLE rows
    means, passes = {}, 1
    for n, _, x in (g for batch in some.combine_chunks().to_batches() for g in by_length(batch, 0)):
        means[n] = _unit(x).mean(0)
        rng = np.random.default_rng([seed, n, 1])
        probes = _unit(x[rng.permutation(len(x))[:PROBES]])
        side = rng.standard_normal(probes.shape)
        side -= (side * probes).sum(1, keepdims=True) * probes
        if n < 2 or len(x) * share <= block:
            continue
        partners = least * probes + np.sqrt(1 - least * least) * _unit(side)
        keys, a, b = (np.sort(_keys(x, means[n], MEASURED, seed), axis=0), _keys(probes, means[n], MEASURED, seed),
                      _keys(partners, means[n], MEASURED, seed))
        met = np.zeros(len(probes))
        for k in range(MEASURED):
            apart = np.abs(np.searchsorted(keys[:, k], a[:, k]) - np.searchsorted(keys[:, k], b[:, k])) * share
            met += apart < block
        chance = (met + 0.5) / (MEASURED + 1)
        own = 1
        while np.mean((1 - chance) ** own) > MISS:
            own += 1
        passes = max(passes, own)
    return means, passes


def _signs(passes: int, seed: int, means: dict[int, np.ndarray]):
    def apply(batches):
        import pyarrow as pa

        for batch in batches:
            nodes = batch.column(0).to_numpy()
            for n, rows, x in by_length(batch, 1):
                key = _keys(x, means.get(n), passes, seed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(passes, dtype=np.int32), len(rows))), pa.array(np.full(len(rows) * passes, n, np.int32)),
                     pa.array(key.reshape(-1)), pa.array(np.repeat(nodes[rows], passes))], ["pass", "length", "key", "node"])
    return apply


def _compare(least: float):
    def apply(key, table):
        """One edge a linked row, for the links of a block's own rows among themselves and with the block before."""
        import pyarrow as pa

        nodes, own = table["node"].to_numpy(), table["own"].to_numpy()
        x = matrix(table["vector"])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        mine = np.flatnonzero(own)
        i, j = np.nonzero(x[mine] @ x.T >= least)
        i = mine[i]
        use = (i < j) | ~own[j]
        i, j = i[use], j[use]
        near = np.arange(len(nodes))
        while True:  # smallest neighbour until nothing moves: one edge a row
            low = near.copy()
            np.minimum.at(low, i, near[j])
            np.minimum.at(low, j, near[i])
            low = low[low]
            if (low == near).all():
                break
            near = low
        some = np.unique(np.concatenate([i, j]))
        return pa.table([pa.array(nodes[some]), pa.array(nodes[near[some]])], names=["u", "v"])
    return apply


def _links(x: np.ndarray, y: np.ndarray | None, mx: np.ndarray, my: np.ndarray | None, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Weighted link counts of the rows of x and of y, or of x with itself."""
    of_x, of_y = np.zeros(len(x)), np.zeros(0 if y is None else len(y))
    other, weight = (x, mx) if y is None else (y, my)
    for at in range(0, len(x), 512):
        s = x[at:at + 512] @ other.T >= least
        if y is None:
            s[np.arange(len(s)), np.arange(at, at + len(s))] = False
        else:
            of_y += mx[at:at + 512] @ s
        of_x[at:at + 512] = s @ weight
    return of_x, of_y


def _count(least: float):
    def apply(key, table):
        """Links of a bucket of whole components (i < 0), or of two chunks of one component."""
        import pyarrow as pa

        table = table.combine_chunks()
        x, m, root = matrix(table["vector"]), table["m"].to_numpy().astype(np.float64), table["root"].to_numpy()
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        i, j, chunk = table["i"][0].as_py(), table["j"][0].as_py(), table["chunk"].to_numpy()
        found = np.zeros(len(x))
        if i < 0:
            order = np.argsort(root, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(root[order])) + 1):
                found[rows] = _links(x[rows], None, m[rows], None, least)[0]
        elif i == j:
            found = _links(x, None, m, None, least)[0]
        else:
            a, b = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
            found[a], found[b] = _links(x[a], x[b], m[a], m[b], least)
        return pa.table([table["node"], pa.array(found.astype(np.int64))], names=["u", "links"])
    return apply


def _counts(linked: DataFrame, least: float, block: int) -> DataFrame:
    """(u, links): exact link counts within each component of ``linked`` (node, root, m, vector).

    Components of up to ``block`` rows are counted whole, many to a task.  Larger ones are ordered by the
    angle to a pivot and cut into chunks; every two chunks whose angles let them link are a task.
    """
    schema, task = "u long, links long", ["root", "node", "m", "vector", "chunk", "i", "j"]
    sizes = stage(linked.groupBy("root").agg(F.count(F.lit(1)).alias("g")).where(F.col("g") > block), "crowded")
    n = sizes.count()
    rare = linked.join(small_side(sizes, n, BROADCAST), "root", "left_anti") if n else linked
    buckets = max(1, -(-linked.count() // (4 * block)))
    none = F.lit(-1).cast("long")
    rare = rare.withColumns({"chunk": none, "i": none, "j": none})
    counts = (rare.select(*task, F.pmod(F.xxhash64("root"), F.lit(buckets)).alias("bucket"), F.size("vector").alias("length"))
              .groupBy("bucket", "length").applyInArrow(_count(least), schema))
    if not n:
        return counts
    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda t, x: t + x)
    pivots = linked.where("node = root").select("root", F.col("vector").alias("p"))
    pivots = small_side(sizes.join(pivots, "root"), n, BROADCAST)
    cosine = dot(F.col("vector"), F.col("p")) / F.sqrt(dot(F.col("vector"), F.col("vector"))) / F.sqrt(dot(F.col("p"), F.col("p")))
    angles = linked.join(pivots, "root").select("root", "node", "g", F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))).alias("angle"))
    ranked = stage(with_rank(angles, [F.col("root"), F.col("angle"), F.col("node")], "rank"), "angles")
    starts = small_side(ranked.groupBy("root").agg(F.min("rank").alias("start")), n, BROADCAST)
    rows = F.greatest(F.lit(block), F.least(F.lit(16 * block), F.floor(16 * F.sqrt("g"))))
    numbered = stage(ranked.join(starts, "root").select("root", "node", "angle", F.floor((F.col("rank") - F.col("start")) / rows).alias("chunk")), "chunks")
    spans = numbered.groupBy("root", "chunk").agg(F.min("angle").alias("lo"), F.max("angle").alias("hi"))
    left = spans.select("root", F.col("chunk").alias("i"), F.col("hi").alias("hi_i"))
    right = spans.select("root", F.col("chunk").alias("j"), F.col("lo").alias("lo_j"))
    pairs = left.join(right, "root").where((F.col("i") <= F.col("j")) & (F.col("lo_j") - F.col("hi_i") <= float(np.arccos(least)) + 1e-6))
    sides = pairs.select("root", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("chunk"))
    dealt = numbered.select("root", "node", "chunk").join(linked.select("node", "m", "vector"), "node").join(sides, ["root", "chunk"])
    return counts.unionByName(dealt.select(*task).groupBy("root", "i", "j").applyInArrow(_count(least), schema))


def dedup(embeddings: DataFrame, least: float = LEAST, passes: int = PASSES, block: int = BLOCK, seed: int = 5) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept.  ``passes`` is the least number of them."""
    sets = stage(classes(embeddings, F.count(F.lit(1)).alias("m"), F.min("vec_id").alias("low")), "vectors")
    rows = sets.count()
    means, needed = survey(sets, rows, least, block, seed)
    passes = max(passes, passes_for(rows, least, block), needed)
    keys = sets.select("node", "vector").mapInArrow(_signs(passes, seed, means), "pass int, length int, key long, node long")
    rows = in_blocks(keys, block, "projections").join(sets.select("node", "vector"), "node")
    meet = rows.withColumn("at", F.explode(F.array(F.col("block"), F.col("block") + 1))).withColumn("own", F.col("at") == F.col("block"))
    found = stage(meet.select("pass", "length", "at", "own", "node", "vector").groupBy("pass", "length", "at")
                  .applyInArrow(_compare(least), "u long, v long"), "links")
    roots = components(found)
    linked = stage(roots.join(sets.select("node", "m", "vector"), "node"), "linked")
    counts = _counts(linked, least, block).groupBy("u").agg(F.sum("links").alias("links"))
    roots = roots.withColumnRenamed("node", "r_node")
    known = (sets.select("node", "m", "low").join(counts, F.col("node") == F.col("u"), "left")
             .join(roots, F.col("node") == F.col("r_node"), "left").withColumn("root", F.coalesce("root", "node")))
    known = stage(known.select("node", "root", "low", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links")), "known")
    lows = known.groupBy("root").agg(F.min("low").alias("component_id"))
    named = known.join(lows, "root").where("n_links > 0").select(F.col("node").alias("n"), "n_links", "component_id")
    vector = vector_of(embeddings)
    every = embeddings.select("vec_id", F.when(valid(vector), F.xxhash64(vector)).alias("node"))
    return (every.join(named, F.col("node") == F.col("n"), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", F.col("vec_id")).cast("long").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


DEDUP_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL),
ok AS (SELECT * FROM v WHERE len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN e IF x <> 0]) > 0),
link AS (SELECT a.vec_id AS u, b.vec_id AS v FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {LEAST}),
reach AS (SELECT DISTINCT u, v FROM link UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u),
lows AS (SELECT u, min(v) AS low FROM reach GROUP BY u),
n AS (SELECT u, count(*) AS n_links FROM link GROUP BY u)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, CAST(least(vec_id, coalesce(low, vec_id)) AS BIGINT) AS component_id,
  vec_id <= coalesce(low, vec_id) AS kept
FROM embeddings e LEFT JOIN n ON n.u = e.vec_id LEFT JOIN lows ON lows.u = e.vec_id
"""
