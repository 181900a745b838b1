"""Nearest neighbours by shifted space-filling curves.

Vectors are projected to a few random directions, shifted and put on a grid; their place on the
Hilbert curve through the grid is the key.  Several projections with shifts of their own give several
orderings.  In each, rows are ranked in Spark by sorted ranges and cut into blocks of ``BLOCK``
consecutive rows; a query meets its own block and both neighbours, so its window holds at least
``BLOCK`` rows on either side.  The windows' best rows are merged and ranked again by their exact
inner products.

What share of the neighbours the windows meet falls as the table grows, so it is measured: ``PROBES``
fixed queries are answered by brute force, and orderings are added until their windows hold ``TARGET``
of these answers; beyond ``MOST`` orderings the windows are widened instead, to the whole table if
need be.

Curves compare directions, but the answer is by inner product, so rows are split into ranges of their
norm (``RATIO`` wide, the greatest first; ``RANGES`` at most, the last one holds all shorter vectors)
and a query searches every range of its length.  Vectors of one norm make one range.

Equal vectors are one class with its smallest ids, so ties go to smaller ids however many copies there
are.  Vectors that are null, empty, zero or hold null or non-finite components take no part; vectors
only meet others of their length.  Rows without vec_id are neither query nor candidate.  With fewer
candidates than k all are returned; an empty table gives no rows.

The grid's centre and scale come from ``FIT_ROWS`` vectors at most (documented bound); every row is
indexed.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from roadsight.llm.common import stage
from roadsight.llm.vectors import by_length, in_blocks, matrix, valid, vector_of

K, ORDERINGS, BLOCK = 20, 10, 4096
#: Least recall on the probes, above the 0.9 asked for as they are a sample.
TARGET, PROBES, MOST = 0.93, 256, 64
AXES, BITS = 8, 4
RATIO, RANGES = 1.25, 16
FIT_ROWS = 4096


def hilbert_key(grid: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid points (rows of unsigned axes) on the Hilbert curve.

    Axes are turned from the top bit down so that each cell is entered where the last was left, then
    Gray-decoded and interleaved.
    """
    axes, n = grid.shape[1], len(grid)
    x = grid.T.astype(np.uint64).copy()
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        high, below = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for i in range(axes):
            flip = (x[i] & high) != 0
            swap = np.where(flip, np.uint64(0), (x[0] ^ x[i]) & below)
            x[0] ^= np.where(flip, below, swap)
            x[i] ^= swap if i else np.uint64(0)
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros(n, np.uint64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] & np.uint64(1 << b)) != 0, np.uint64((1 << b) - 1), np.uint64(0))
    x ^= turn
    key = np.zeros(n, np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << one) | ((x[i] >> np.uint64(b)) & one)
    return key.astype(np.int64)


def _curves(centre: dict[int, np.ndarray], ranges: dict[int, list[int]], orderings: range, seed: int):
    """Places of rows in the range of their norm, and of queries in every range of their length."""
    def apply(batches):
        import pyarrow as pa

        for batch in batches:
            nodes, own = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            asks = batch.column(3).to_numpy(zero_copy_only=False)
            for n, rows, x in by_length(batch, 1):
                ask = np.flatnonzero(asks[rows])
                places = [(np.arange(len(rows)), own[rows], 0)] + [(ask, np.full(len(ask), r), 1) for r in ranges[n]]
                at, part = (np.concatenate([p[i] for p in places]) for i in (0, 1))
                role = np.concatenate([np.full(len(p[0]), p[2], np.int32) for p in places])
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                middle, spread = centre.get(n, (np.zeros(n), np.full(n, n ** -0.5)))
                for o in orderings:
                    rng = np.random.default_rng([seed, n, o])
                    axes = rng.standard_normal((n, AXES))
                    y = (x - middle) @ axes / np.sqrt((spread ** 2) @ axes ** 2) + rng.uniform(-0.5, 0.5, AXES)
                    grid = np.clip((y + 4) / 8 * (1 << BITS), 0, (1 << BITS) - 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), o, np.int32)), pa.array((n * RANGES + part).astype(np.int32)),
                         pa.array(hilbert_key(grid, BITS)[at]), pa.array(nodes[rows][at]), pa.array(role)],
                        ["pass", "length", "key", "node", "query"])
    return apply


def _windows(k: int):
    def apply(key, table):
        """The k + 1 best rows of a block for every query that meets it."""
        import pyarrow as pa

        role = table["query"].to_numpy()
        own, ask = table.filter(pa.array(role == 0)), table.filter(pa.array(role == 1))
        if not own.num_rows or not ask.num_rows:
            return pa.table([pa.array([], pa.int64())] * 2 + [pa.array([], pa.float64())], names=["asker", "node", "score"])
        x, q = matrix(own["vector"]), matrix(ask["vector"])
        nodes, askers, top = own["node"].to_numpy(), ask["node"].to_numpy(), min(k + 1, own.num_rows)
        out = []
        for at in range(0, len(q), 256):
            s = q[at:at + 256] @ x.T
            best = np.argpartition(-s, top - 1, axis=1)[:, :top] if top < s.shape[1] else np.tile(np.arange(s.shape[1]), (len(s), 1))
            out.append((np.repeat(askers[at:at + 256], best.shape[1]), nodes[best].reshape(-1), np.take_along_axis(s, best, 1).reshape(-1)))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], names=["asker", "node", "score"])
    return apply


def _exact(probes: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    """The k best rows of a task's part for every probe, itself left out."""
    def apply(batches):
        import pyarrow as pa

        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            for n, rows, x in by_length(batch, 1):
                if n not in probes:
                    continue
                own = nodes[rows]
                score = np.where(probes[n][0][:, None] == own[None, :], -np.inf, probes[n][1] @ x.T)
                node = np.broadcast_to(own, score.shape)
                if n in best:
                    node, score = np.hstack([best[n][0], node]), np.hstack([best[n][1], score])
                if score.shape[1] > k:
                    top = np.argpartition(-score, k - 1, axis=1)[:, :k]
                    node, score = np.take_along_axis(node, top, 1), np.take_along_axis(score, top, 1)
                best[n] = node, score
        for n, (node, score) in best.items():
            real = np.isfinite(score)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(probes[n][0], real.sum(1))), pa.array(node[real]), pa.array(score[real])],
                ["asker", "target", "score"])
    return apply


def _truth(sets: DataFrame, k: int) -> DataFrame:
    """(asker, target): the true k nearest classes of the probes, a fixed sample of the queries."""
    sample = sets.where("query").orderBy(F.hash("node"), "node").limit(PROBES).select("node", "vector").toArrow()
    probes = {}
    if sample.num_rows:
        batch = sample.combine_chunks().to_batches()[0]
        probes = {n: (batch.column(0).to_numpy()[rows], x) for n, rows, x in by_length(batch, 1)}
    found = sets.select("node", "vector").mapInArrow(_exact(probes, k), "asker long, target long, score double")
    nth = F.row_number().over(Window.partitionBy("asker").orderBy(F.desc("score"), "target"))
    return stage(found.withColumn("nth", nth).where(F.col("nth") <= k).select("asker", "target"), "truth")


def _gaps(placed: DataFrame, truth: DataFrame) -> list[tuple[int, int]]:
    """(least distance in blocks over all orderings, how many true neighbours have it), sorted."""
    asker = placed.where("query = 1").join(F.broadcast(truth), F.col("node") == F.col("asker")).select(
        "asker", "target", "pass", "length", F.col("block").alias("at"))
    target = placed.where("query = 0").join(F.broadcast(truth.select("target").distinct()), F.col("node") == F.col("target")).select(
        "target", "pass", "length", "block")
    gaps = asker.join(target, ["target", "pass", "length"]).groupBy("asker", "target").agg(F.min(F.abs(F.col("at") - F.col("block"))).alias("gap"))
    return [(r["gap"], r["count"]) for r in gaps.groupBy("gap").count().orderBy("gap").collect()]


def _place(sets: DataFrame, truth: DataFrame, centre: dict[int, np.ndarray], orderings: int, block: int,
           seed: int) -> tuple[DataFrame, int]:
    """All rows in as many orderings as the probes need, and how many blocks on either side a query meets."""
    ranges: dict[int, list[int]] = {}
    for r in sets.select(F.size("vector").alias("n"), "range").distinct().collect():  # RANGES a length at most
        ranges.setdefault(r["n"], []).append(r["range"])
    placed, done = None, 0
    while True:
        keys = sets.select("node", "vector", "range", "query").mapInArrow(
            _curves(centre, ranges, range(done, orderings), seed), "pass int, length int, key long, node long, query int")
        more = in_blocks(keys, block, "curves", "query")
        placed, done = more if placed is None else placed.unionByName(more), orderings
        gaps = _gaps(placed, truth)
        total = sum(n for _, n in gaps)
        met = sum(n for gap, n in gaps if gap <= 1)
        if met >= TARGET * total:
            return placed, 1
        if done >= MOST:
            share = np.cumsum([n for _, n in gaps]) >= TARGET * total
            return placed, gaps[int(np.argmax(share))][0]
        # every ordering misses about the same share of what the others missed
        need = done * np.log(1 - TARGET) / np.log(1 - met / total) if met else MOST
        orderings = min(MOST, max(done + 2, int(np.ceil(need))))


def search(embeddings: DataFrame, is_query: Column, k: int = K, orderings: int = ORDERINGS, block: int = BLOCK,
           seed: int = 3) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row that ``is_query`` holds for.

    ``orderings`` is the least number of them.
    """
    vector = vector_of(embeddings)
    rows = embeddings.where(valid(vector) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("query"))
    # the k + 1 smallest ids of a class are enough for any answer; the window limit keeps them map-side
    first = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    least = rows.withColumn("nth", first).where(F.col("nth") <= k + 1).groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asked = rows.where("query").select(F.col("vector").alias("v")).distinct()
    classes = least.join(asked, F.col("vector") == F.col("v"), "left").select(
        F.xxhash64("vector").alias("node"), "vector", "ids", F.col("v").isNotNull().alias("query"),
        F.sqrt(F.aggregate("vector", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))).alias("norm"))
    sets = stage(classes, "vectors")
    greatest = F.broadcast(sets.groupBy(F.size("vector").alias("of")).agg(F.max("norm").alias("most")))  # one row a length
    part = F.least(F.floor(F.log(F.col("most") / F.col("norm")) / np.log(RATIO)), F.lit(RANGES - 1))
    sets = sets.join(greatest, F.size("vector") == F.col("of")).select(
        "node", "vector", "ids", "query", F.coalesce(part, F.lit(RANGES - 1)).cast("int").alias("range"))
    sample = sets.orderBy(F.hash("node"), "node").limit(FIT_ROWS).select("vector").toArrow()
    centre = {}
    if sample.num_rows:
        for n, _, x in by_length(sample.combine_chunks().to_batches()[0], 0):
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            centre[n] = (x.mean(0), np.maximum(x.std(0), 1e-9))
    placed, reach = _place(sets, _truth(sets, k), centre, orderings, block, seed)
    placed = placed.join(sets.select("node", "vector"), "node")
    own = placed.where("query = 0").select("pass", "length", "block", F.lit(0).alias("query"), "node", "vector")
    near = F.sequence(F.col("block") - reach, F.col("block") + reach)
    ask = placed.where("query = 1").select("pass", "length", F.explode(near).alias("block"), F.lit(1).alias("query"), "node", "vector")
    found = own.unionByName(ask).groupBy("pass", "length", "block").applyInArrow(_windows(k), "asker long, node long, score double")
    merged = found.groupBy("asker", "node").agg(F.max("score").alias("score"))
    ids = sets.select("node", "ids")
    # classes with equal scores are kept with the last one, so that ties are settled by ids below
    last = F.rank().over(Window.partitionBy("asker").orderBy(F.desc("score")))
    short = merged.withColumn("nth", last).where(F.col("nth") <= k + 1).join(ids, "node").select(
        "asker", "score", F.explode("ids").alias("vec_id"))
    final = F.row_number().over(Window.partitionBy("asker").orderBy(F.desc("score"), "vec_id"))
    answers = (short.withColumn("nth", final).where(F.col("nth") <= k + 1).groupBy("asker")
               .agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("a")))
    queries = rows.where("query").select(F.col("vec_id").alias("query_id"), F.xxhash64("vector").alias("node"))
    others = queries.join(answers, F.col("node") == F.col("asker")).select(
        "query_id", F.slice(F.filter("a", lambda a: a["vec_id"] != F.col("query_id")), 1, k).alias("a"))
    return others.select("query_id", F.posexplode("a").alias("p", "a")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("a.vec_id").alias("vec_id"), F.col("a.score").alias("score"))
