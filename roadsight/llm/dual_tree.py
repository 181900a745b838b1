"""Ranked lexical search by two trees: node pairs are bounded by coordinate maxima and pruned together.

A document's coordinate for a term is its saturated frequency, an item's is the term's weight times
its occurrences in the item; a score is their inner product.  Items form a tree (8 and 64 neighbours
a node) that every task holds; the documents of a task form trees of up to 4,096 with nodes of 512
and 64.  A node keeps the largest value of each coordinate, so the product of two nodes' maxima bounds
the score of every pair below them.  A pair goes on only if its bound reaches the weakest of its
items' 20th best scores so far; at the leaves the exact scores are computed.  All numbers are whole and
stay below 2**53 (float products are exact), or are 64-bit integers where an item is too long for that.

The first bounds come from a search over at most about ``SEEDS`` documents: scores of real documents,
so nothing that belongs in the result can be pruned.  Each task returns at most 20 rows an item.

* Items are searched in blocks of about ``ITEMS``; a block's terms and counts are all that reaches the
  driver and every task.  Each block reads the documents anew.
* A text without terms, empty or null, is no document here; an item without terms, or with no
  document above 0, has no row.  Every item row is an item: repeated ones get their rows each.
* Documents without id rank after equal scores with one; a repeated id stands for several documents.
* Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from roadsight.llm.common import WordHasher, ascii_fold, binary_parts, stage

K = 20
ITEMS = 1024
SEEDS = 16384
#: Documents a node and items a node, from the top of the trees to their leaves.
DOC_NODES, ITEM_NODES = (4096, 512, 64), (64, 8, 1)
_LAST = np.iinfo(np.int64).max


def term_hasher() -> WordHasher:
    """Runs of ASCII letters and digits and of bytes above ASCII, A-Z lower-cased."""
    is_word = np.zeros(256, bool)
    is_word[48:58] = is_word[65:91] = is_word[97:123] = is_word[128:] = True
    return WordHasher(is_word, ascii_fold())


def _counted(own: np.ndarray, terms: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, term) in order, with their number."""
    key, times = np.unique(own * np.int64(max(width, 1)) + terms, return_counts=True)
    return key // max(width, 1), key % max(width, 1), times


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, terms, times): distinct term hashes of each row's text."""
    import pyarrow as pa

    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"),
                        F.col("text").cast("binary").alias("text"))

    def apply(batches: Iterator) -> Iterator:
        hasher = term_hasher()
        for batch in batches:
            hashes, counts = hasher.texts(*binary_parts(batch.column(2)))
            found = [np.unique(h.view(np.int64), return_counts=True) for h in np.split(hashes, np.cumsum(counts)[:-1])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([t for t, _ in found], pa.list_(pa.int64())),
                 pa.array([n for _, n in found], pa.list_(pa.int64()))], ["item", "item_id", "terms", "times"])

    return rows.mapInArrow(apply, "item long, item_id long, terms array<long>, times array<long>")


def document_terms(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, times) of documents that have a term; only terms of ``vocabulary`` are listed, by place."""
    import pyarrow as pa

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))

    def apply(batches: Iterator) -> Iterator:
        hasher, maybe = term_hasher(), np.zeros(1 << 20, bool)
        maybe[(vocabulary >> np.uint64(44)).astype(np.int64)] = True
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                hashes, counts = hasher.texts(*binary_parts(part.column(1)))
                use = np.flatnonzero(maybe[(hashes >> np.uint64(44)).astype(np.int64)])
                own, hashes = np.repeat(np.arange(part.num_rows), counts)[use], hashes[use]
                place = np.minimum(np.searchsorted(vocabulary, hashes), max(len(vocabulary) - 1, 0))
                hit = vocabulary[place] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
                own, place, times = _counted(own[hit], place[hit], len(vocabulary))
                ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(own, minlength=part.num_rows))]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts), pa.ListArray.from_arrays(ends, pa.array(place.astype(np.int32))),
                     pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int64)))],
                    ["doc_id", "n", "terms", "times"]).filter(pa.array(counts > 0))

    return rows.mapInArrow(apply, "doc_id long, n long, terms array<int>, times array<long>")


def corpus_counts(terms: DataFrame, width: int) -> tuple[int, int, np.ndarray]:
    """Documents, their terms with repeats, and documents that hold each term of the vocabulary."""
    import pyarrow as pa

    def apply(batches: Iterator) -> Iterator:
        total = np.zeros(width + 2, np.int64)
        for batch in batches:
            total[:width] += np.bincount(batch.column(1).flatten().to_numpy(), minlength=width)
            total[width] += batch.num_rows
            total[width + 1] += int(batch.column(0).to_numpy().sum())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "total"])

    found = (terms.select("n", "terms").mapInArrow(apply, "at long, total long")
             .groupBy("at").agg(F.sum("total").alias("total")).toArrow())  # one row a term of the block's items
    total = np.zeros(width + 2, np.int64)
    total[found["at"].to_numpy()] = found["total"].to_numpy()
    return int(total[width]), int(total[width + 1]), total[:width]


@dataclass
class ItemTree:
    """Items in tree order; each level's maxima by term: (term's start in the lists, node, value)."""

    rows: np.ndarray  # items in tree order, as places in the block
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    whole: type  # number type that holds every score exactly
    weights: np.ndarray

    def part(self, level: int, terms: np.ndarray) -> np.ndarray:
        """Nodes of a level x the given terms."""
        starts, nodes, values = self.levels[level]
        sizes = starts[terms + 1] - starts[terms]
        at = np.arange(sizes.sum()) + np.repeat(starts[terms] - np.cumsum(sizes) + sizes, sizes)
        out = np.zeros((-(-len(self.rows) // ITEM_NODES[level]), len(terms)), self.whole)
        out[nodes[at], np.repeat(np.arange(len(terms)), sizes)] = values[at]
        return out


def near_order(own: np.ndarray, terms: np.ndarray, values: np.ndarray, n: int, leaf: int) -> np.ndarray:
    """An order of n sparse rows in which neighbours are alike: median splits of 16 random projections."""
    signs = np.random.default_rng(3).integers(0, 1 << 16, int(terms.max(initial=0)) + 1)[terms]
    sketch = np.stack([np.bincount(own, np.where((signs >> d) & 1, values, -values), n) for d in range(16)], 1)
    order, work = [], [np.arange(n)]
    while work:
        rows = work.pop()
        if len(rows) <= leaf:
            order.append(rows)
            continue
        side = sketch[rows, np.argmax(np.ptp(sketch[rows], axis=0))]
        rows, middle = rows[np.argsort(side, kind="stable")], -(-len(rows) // (2 * leaf)) * leaf
        work += [rows[middle:], rows[:middle]]
    return np.concatenate(order) if order else np.empty(0, np.int64)


def item_tree(own: np.ndarray, terms: np.ndarray, times: np.ndarray, n: int, weights: np.ndarray) -> ItemTree:
    values = times * weights[terms]
    bound = np.zeros(n, np.float64)
    np.add.at(bound, own, values.astype(np.float64) * 1e6)
    order = near_order(own, terms, values.astype(np.float64), n, 1)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    levels = []
    for size in ITEM_NODES:
        node = place[own] // size
        by = np.lexsort((node, terms))
        t, node, v = terms[by], node[by], values[by]
        heads = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (node[1:] != node[:-1])])) if len(t) else np.empty(0, np.int64)
        most = np.maximum.reduceat(v, heads) if len(t) else v
        levels.append((np.searchsorted(t[heads], np.arange(len(weights) + 1)), node[heads], most))
    return ItemTree(order, levels, np.float64 if bound.max(initial=0) < 2.0 ** 52 else np.int64, weights)


class Best:
    """The best K rows of each item (tree order): scores, ids (null last) and whether the id is known."""

    def __init__(self, floors: np.ndarray):
        n = len(floors)
        self.score, self.id = np.zeros((n, K), np.int64), np.full((n, K), _LAST)
        self.known = np.zeros((n, K), bool)
        self.floors = floors

    def least(self) -> np.ndarray:
        """Scores below this cannot be among an item's best."""
        return np.maximum(np.maximum(self.score[:, -1], self.floors), 1)

    def add(self, item: int, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        score, ids = np.concatenate([self.score[item], score]), np.concatenate([self.id[item], ids])
        known = np.concatenate([self.known[item], known])
        by = np.lexsort((ids, -score))[:K]
        self.score[item], self.id[item], self.known[item] = score[by], ids[by], known[by]


class DocTree:
    """Up to 4,096 documents in an order of likeness; nodes are ranges of it."""

    def __init__(self, ids, known, own, terms, values, weights):
        n = len(ids)
        order = near_order(own, terms, values * weights[terms].astype(np.float64), n, DOC_NODES[-1])
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        by = np.lexsort((terms, place[own]))
        self.ids, self.known = ids[order], known[order]
        self.own, self.terms, self.values = place[own][by], terms[by], values[by]
        self.starts = np.searchsorted(self.own, np.arange(n + 1))

    def node(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms of the documents in a range, the largest value of each, and all (term's place, value)."""
        a, b = self.starts[lo], self.starts[min(hi, len(self.ids))]
        terms, at = np.unique(self.terms[a:b], return_inverse=True)
        most = np.zeros(len(terms), np.int64)
        np.maximum.at(most, at, self.values[a:b])
        return terms, most, at, self.values[a:b]

    def search(self, tree: ItemTree, best: Best) -> None:
        self._visit(0, 0, np.arange(-(-len(tree.rows) // ITEM_NODES[0])), tree, best)

    def _visit(self, level: int, lo: int, nodes: np.ndarray, tree: ItemTree, best: Best) -> None:
        """Keep the item nodes whose bound with this node of documents may still matter, and go down in both trees."""
        hi = min(lo + DOC_NODES[level], len(self.ids))
        terms, most, at, values = self.node(lo, hi)
        size, n = ITEM_NODES[level], len(tree.rows)
        part = tree.part(level, terms)
        least, lowest_id = best.least(), self.ids[lo:hi].min()
        heads = np.arange(0, n, size)
        weakest = np.minimum.reduceat(least, heads)
        bound = (part[nodes] @ most.astype(tree.whole)).astype(np.int64)
        go = bound >= weakest[nodes]
        if size == 1:  # an equal score only counts with a smaller id
            go &= (bound > weakest[nodes]) | (lowest_id <= best.id[nodes, -1])
        nodes = nodes[go]
        if not len(nodes):
            return
        if level + 1 < len(DOC_NODES):
            step = size // ITEM_NODES[level + 1]
            below = (nodes[:, None] * step + np.arange(step)).ravel()
            below = below[below < -(-n // ITEM_NODES[level + 1])]
            for start in range(lo, hi, DOC_NODES[level + 1]):
                self._visit(level + 1, start, below, tree, best)
            return
        matrix = np.zeros((hi - lo, len(terms)), tree.whole)
        matrix[self.own[self.starts[lo]:self.starts[hi]] - lo, at] = values
        scores = (matrix @ part[nodes].T).astype(np.int64)
        ids, known = self.ids[lo:hi], self.known[lo:hi]
        for column in np.flatnonzero((scores >= least[nodes]).any(0)):
            item = nodes[column]
            good = scores[:, column] >= least[item]
            best.add(item, scores[good, column], ids[good], known[good])


def _search(terms: DataFrame, tree: ItemTree, counts: tuple[int, int], floors: np.ndarray) -> DataFrame:
    """Each task's best rows: (part, item, doc_id, score); ``item`` is a place in the block."""
    import pyarrow as pa
    from pyspark import TaskContext

    docs_n, length = counts

    def apply(batches: Iterator) -> Iterator:
        best = Best(floors[tree.rows])
        for batch in batches:
            for at in range(0, batch.num_rows, DOC_NODES[0]):
                part = batch.slice(at, DOC_NODES[0])
                m = np.array([75 + 25 * x * docs_n // length for x in part.column(1).to_pylist()], np.int64)
                times, lists = part.column(3).flatten().to_numpy(), part.column(2)
                own = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
                places = lists.flatten().to_numpy().astype(np.int64)
                values = 1_000_000_000 * times // (1000 * times + 12 * m[own])
                ids, known = part.column(0).fill_null(_LAST).to_numpy(), part.column(0).is_valid().to_numpy(zero_copy_only=False)
                DocTree(ids, known, own, places, values, tree.weights).search(tree, best)
        item, rank = np.nonzero(best.score > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(item), TaskContext.get().partitionId(), np.int32)), pa.array(tree.rows[item].astype(np.int32)),
             pa.array(best.id[item, rank], mask=~best.known[item, rank]), pa.array(best.score[item, rank])],
            ["part", "item", "doc_id", "score"])

    found = terms.select("doc_id", "n", "terms", "times").mapInArrow(apply, "part int, item int, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = Window.partitionBy("item", F.col("part") % 64).orderBy(*order)  # an item's rows in 64 groups first
    some = found.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= K)
    every = Window.partitionBy("item").orderBy(*order)
    return some.withColumn("rank", F.row_number().over(every)).where(F.col("rank") <= K).drop("part")


def search(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The 20 best documents of each item: item_id, rank, doc_id, score."""
    spark = documents.sparkSession
    items = stage(item_terms(items), "items")
    blocks, out = -(-items.count() // ITEMS), None
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        rows = own.orderBy("item").toArrow()  # about ITEMS rows
        sizes = rows["terms"].combine_chunks().value_lengths().to_numpy() if len(rows) else np.empty(0, np.int64)
        hashes = np.array(rows["terms"].combine_chunks().flatten()).astype(np.int64).view(np.uint64) if len(rows) else np.empty(0, np.uint64)
        if not len(hashes):
            continue
        vocabulary, place = np.unique(hashes, return_inverse=True)
        times = rows["times"].combine_chunks().flatten().to_numpy()
        terms = stage(document_terms(documents, vocabulary), "terms")
        n, length, df = corpus_counts(terms, len(vocabulary))
        if not n:
            continue
        weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        tree = item_tree(np.repeat(np.arange(len(rows)), sizes), place, times, len(rows), weights)
        seeds = terms.where(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(-(-n // SEEDS))) == 0)
        floors = np.zeros(len(rows), np.int64)
        for r in _search(seeds, tree, (n, length), floors).where(F.col("rank") == K).collect():
            floors[r["item"]] = r["score"]
        found = stage(_search(terms, tree, (n, length), floors), "found")
        names = spark.createDataFrame([(i, x) for i, x in enumerate(rows["item_id"].to_pylist())], "item int, item_id long")
        found = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # one block's items
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out


_TERMS = ("regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
SEARCH_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents WHERE text IS NOT NULL),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY r, term),
c AS (SELECT count(*) AS n_all, CAST(sum(len(ts)) AS BIGINT) AS l_all FROM d WHERE len(ts) > 0),
w AS (SELECT term, CAST(floor(1000 * ln((2 * max(n_all) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM t, c GROUP BY term),
i AS (SELECT q, item_id, term, count(*) AS times FROM (
  SELECT q, item_id, unnest(ts) AS term FROM (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS ts FROM benchmark WHERE text IS NOT NULL))
  GROUP BY q, item_id, term),
s AS (SELECT q, item_id, doc_id, r, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(ts) * n_all) // l_all)))) AS BIGINT) AS score
  FROM i JOIN w USING (term) JOIN t USING (term) JOIN d USING (r), c GROUP BY q, item_id, doc_id, r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0) WHERE rank <= {K}
"""
