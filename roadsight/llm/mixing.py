"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Targets.  Sources, by code point with null last, weigh 5, 2, 1, repeating; a mix of 150 % of all
   words is shared by weight, a source stops at twice its size and the rest is shared again.
2. Blocks.  A source's documents are dealt by hash into blocks of about ``BLOCK`` documents, so the
   block number is a random order.  With ``full`` whole passes, all documents come that often; the
   rest of the target takes further whole blocks, and the block at the edge gives whole documents,
   in hash order, as long as they fit.
3. Output shards.  The blocks to draw of every source are split down a binary tree of shards: a
   node's two halves get equal numbers of blocks, and how many of each source follows the
   multivariate hypergeometric law.  Shards then draw disjoint runs of each source's blocks, and
   documents are shuffled inside a shard.

Hot sources are only ever met block by block or as sums; a tree node holds one count a source.
A null text has size 0 and is never over its target.  Rows that agree in id, source and size share a
decision and are counted apart; rows without id do so too.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from roadsight.llm.common import stage, with_rank

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2.0
BLOCK = 256
#: Blocks a super block holds, so that running sums never pass one task a source.
SUPER = 128
#: Sources a range holds for the running sums of the targets.
RANGE = 4096
#: Blocks an output shard gets, about.
SHARD_BLOCKS = 64
#: Blocks, sources and items of blocks at an edge, together, whose decisions are broadcast to the texts.
DECISIONS = 500_000


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): number of runs without blanks; null counts 0."""
    words = F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.coalesce(words, F.lit(0)).cast("long").alias("size"))


def targets(items: DataFrame) -> DataFrame:
    """(source, source_size, n, target): the lesser of a source's cap and its weight times one rate.

    Sources stop at their caps in the order of cap / weight.  With the first k stopped, the rest share
    (total - their caps) / (weights left) a unit of weight.  That rate rises with k as long as the next
    source stops too, and never after, so the rate is the largest of these: two passes over sources,
    by running sums within ranges of ``RANGE`` sources.
    """
    per = items.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"),
                                      F.sum("copies").alias("n"))
    ranked = with_rank(per, [F.col("source").isNull(), F.col("source")], "position")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("position") % len(WEIGHTS) + 1).cast("int"))
    capped = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(MOST))
    placed = with_rank(capped, [F.col("cap") / F.col("weight"), F.col("position")], "place").withColumn(
        "range", F.floor(F.col("place") / RANGE))
    words, weights = placed.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    sums, inner = Window.orderBy("range"), Window.partitionBy("range").orderBy("place")
    tops = placed.groupBy("range").agg(F.sum("cap").alias("c"), F.sum("weight").alias("w")).select(
        "range", (F.sum("c").over(sums) - F.col("c")).alias("caps"), (F.sum("w").over(sums) - F.col("w")).alias("gone"))
    rates = placed.select("range", (F.sum("cap").over(inner) - F.col("cap")).alias("c"),
                          (F.sum("weight").over(inner) - F.col("weight")).alias("w")).join(tops, "range")
    rate = rates.agg(F.max((F.lit(SHARE * float(words)) - F.col("caps") - F.col("c"))
                           / (F.lit(weights) - F.col("gone") - F.col("w")))).first()[0] or 0.0
    return placed.select("source", "source_size", "n", F.least("cap", F.col("weight") * F.lit(rate)).alias("target"))


def _running(blocks: DataFrame) -> DataFrame:
    """Add ``before``: the words of a source's earlier blocks, by sums over super blocks first."""
    tops = blocks.groupBy("source", "super").agg(F.sum("words").alias("top"))
    tops = tops.select(F.col("source").alias("s2"), F.col("super").alias("u2"), (
        F.sum("top").over(Window.partitionBy("source").orderBy("super")) - F.col("top")).alias("base"))
    inner = F.sum("words").over(Window.partitionBy("source", "super").orderBy("block")) - F.col("words")
    return (blocks.withColumn("inner", inner)
            .join(tops, F.col("source").eqNullSafe(F.col("s2")) & (F.col("super") == F.col("u2")))
            .withColumn("before", F.col("base") + F.col("inner")).drop("s2", "u2", "base", "inner"))


def _edge(key, pdf):
    """Whole documents of the block at the edge, in hash order, as long as they fit."""
    rest = int(pdf["rest"].iloc[0])
    pdf = pdf.sort_values(["order", "doc_id", "size"], kind="stable")
    extra = np.zeros(len(pdf), np.int64)
    for i, (size, copies) in enumerate(zip(pdf["size"].tolist(), pdf["copies"].tolist())):
        if 0 < size <= rest:
            extra[i] = min(copies, rest // size)
            rest -= extra[i] * size
    return pdf[["source", "block", "doc_id", "size", "copies", "full"]].assign(extra=extra)


def _block(order, n):
    """Block of an item with the hash ``order`` in a source of ``n`` documents."""
    return F.pmod(order, F.greatest(F.lit(1), F.ceil(n / BLOCK)))


def draws(items: DataFrame, per_source: DataFrame, seed: int = 17) -> DataFrame:
    """How often the mix takes each item: (source, block, doc_id, size, copies, full, extra).

    ``full`` times for all copies, once more for ``extra`` of them.
    """
    goal = per_source.select(
        F.col("source").alias("s"), "n",
        F.when(F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))).otherwise(0).alias("full"),
        F.round("target").cast("long").alias("words_goal"), "source_size")
    placed = (items.join(goal, F.col("source").eqNullSafe(F.col("s")))
              .withColumn("order", F.xxhash64("doc_id", "size", F.lit(seed)))
              .withColumn("block", _block(F.col("order"), F.col("n")))
              .withColumn("super", F.floor(F.col("block") / SUPER))
              .withColumn("goal", F.col("words_goal") - F.col("full") * F.col("source_size"))
              .select("source", "block", "super", "doc_id", "size", "copies", "order", "full", "goal"))
    blocks = placed.groupBy("source", "block", "super").agg(
        F.sum(F.col("size") * F.col("copies")).alias("words"), F.max("goal").alias("goal"))
    told = _running(blocks).select(
        F.col("source").alias("s"), F.col("block").alias("b"),
        F.greatest(F.lit(0), F.least(F.col("words"), F.col("goal") - F.col("before"))).alias("rest"), "words")
    both = placed.join(told, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))).drop("s", "b")
    at_edge = (F.col("rest") > 0) & (F.col("rest") < F.col("words"))
    columns = ["source", "block", "doc_id", "size", "copies", "full"]
    whole = both.where(~at_edge).select(*columns, F.when(F.col("rest") > 0, F.col("copies")).otherwise(0).alias("extra"))
    edge = (both.where(at_edge).select(*columns, "rest", "order").groupBy("source", "block")
            .applyInPandas(_edge, "source string, block long, doc_id long, size long, copies long, full long, extra long"))
    return whole.select(*[F.col(c).cast("string" if c == "source" else "long") for c in [*columns, "extra"]]).unionByName(edge)


def split_tree(quota: DataFrame, shards: int, seed: int = 17) -> DataFrame:
    """Split (source, blocks) among shards: (shard, source, blocks).

    Each call of the group function halves its node down three levels; a node's left part gets the
    same share of blocks as it has of shards, drawn from the node's blocks without replacement.
    """
    def halve(key, pdf):
        import pandas as pd

        done, todo = [], [(int(pdf["lo"].iloc[0]), int(pdf["hi"].iloc[0]), 3)]
        pdf = pdf.sort_values("source", na_position="last", kind="stable")
        counts = {todo[0][:2]: pdf["blocks"].to_numpy(np.int64)}
        while todo:
            lo, hi, levels = todo.pop()
            own = counts.pop((lo, hi))
            if hi - lo == 1 or not levels:
                done.append(pd.DataFrame({"lo": lo, "hi": hi, "source": pdf["source"].to_numpy(), "blocks": own}))
                continue
            mid = (lo + hi) // 2
            rng = np.random.default_rng([seed, lo, hi])
            take, left, total = int(own.sum()) * (mid - lo) // (hi - lo), np.zeros_like(own), int(own.sum())
            for i, n in enumerate(own.tolist()):  # source by source: the law's conditionals
                left[i] = rng.hypergeometric(n, total - n, take) if take and n and total > n else min(n, take)
                take, total = take - int(left[i]), total - n
            counts[lo, mid], counts[mid, hi] = left, own - left
            todo += [(lo, mid, levels - 1), (mid, hi, levels - 1)]
        out = pd.concat(done)
        return out[out["blocks"] > 0]

    nodes, width = quota.select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "source", "blocks"), shards
    schema = "lo int, hi int, source string, blocks long"
    while width > 1:
        nodes, width = nodes.groupBy("lo", "hi").applyInPandas(halve, schema), -(-width // 8)
    return nodes.select(F.col("lo").alias("shard"), "source", "blocks")


def shard_blocks(drawn: DataFrame, seed: int = 17) -> DataFrame:
    """Output shard of every drawn block: (source, block, pass, shard).  Runs of blocks are disjoint."""
    n_pass = F.col("full") + (F.col("extra") > 0).cast("long")
    taken = drawn.groupBy("source", "block").agg(F.max(n_pass).alias("passes")).where("passes > 0")
    units = taken.select("source", "block", F.explode(F.sequence(F.lit(1).cast("long"), "passes")).alias("pass"))
    units = stage(units, "units")
    quota = units.groupBy("source").agg(F.count(F.lit(1)).alias("blocks"))
    shards = max(1, units.count() // SHARD_BLOCKS)
    split = split_tree(quota, shards, seed)
    end = F.sum("blocks").over(Window.partitionBy("source").orderBy("shard"))
    runs = split.withColumn("end", end).select(
        F.col("source").alias("s"), "shard", F.explode(F.sequence(F.col("end") - F.col("blocks"), F.col("end") - 1)).alias("at"))
    order = [F.col("source").isNull(), F.col("source"), F.xxhash64("block", "pass", F.lit(seed)), F.col("block"), F.col("pass")]
    ranked = with_rank(units, order, "rank")
    first = ranked.groupBy("source").agg(F.min("rank").alias("first")).withColumnRenamed("source", "f")
    ranked = ranked.join(first, F.col("source").eqNullSafe(F.col("f"))).withColumn("at_", F.col("rank") - F.col("first"))
    return ranked.join(runs, F.col("source").eqNullSafe(F.col("s")) & (F.col("at_") == F.col("at"))).select(
        "source", "block", "pass", "shard")


def mix(docs: DataFrame, seed: int = 17) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Decisions on all documents.

    Returns (items with ``full`` and ``extra``, targets a source, shard of each drawn block).
    """
    items = stage(sizes(docs).groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies")), "items")
    per_source = stage(targets(items), "targets")
    drawn = stage(draws(items, per_source, seed), "draws")
    return drawn, per_source, shard_blocks(drawn, seed)


def taken_words(docs: DataFrame, seed: int = 17) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, taken, and ``shards`` that got it."""
    drawn, per_source, units = mix(docs, seed)
    got = units.groupBy("source", "block").agg(F.array_sort(F.collect_list(F.struct("pass", "shard"))).alias("units"))
    got = got.withColumnRenamed("source", "s").withColumnRenamed("block", "b")
    rows = (drawn.join(got, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")), "left").drop("s", "b")
            .join(per_source.select(F.col("source").alias("s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("s"))))
    times = F.col("full") + (F.col("copy") <= F.col("extra")).cast("long")
    return (rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"),
                    F.transform(F.filter("units", lambda u: u["pass"] <= times), lambda u: u["shard"]).alias("shards")))


def _decisions(drawn: DataFrame, units: DataFrame) -> DataFrame:
    """One row a block: (source, block, full, all, units, edge).

    All rows of a block come ``full`` times and, with ``all``, once more; a block at the edge names its items
    in ``edge``, every other has null there.  ``units`` are the shards of its passes.
    """
    item = F.struct("doc_id", "size", "copies", "extra")
    blocks = drawn.groupBy("source", "block").agg(
        F.max("full").alias("full"), F.sum("extra").alias("_extra"), F.sum("copies").alias("_copies"))
    at_edge = (F.col("_extra") > 0) & (F.col("_extra") < F.col("_copies"))
    places = blocks.where(at_edge).select(F.col("source").alias("s"), F.col("block").alias("b"))
    edge = drawn.join(places, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")), "left_semi").groupBy(
        F.col("source").alias("s"), F.col("block").alias("b")).agg(F.collect_list(item).alias("edge"))
    got = units.groupBy(F.col("source").alias("u"), F.col("block").alias("ub")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pass", "shard"))), lambda x: x["shard"]).alias("units"))
    return (blocks.join(edge, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")), "left")
            .join(got, F.col("source").eqNullSafe(F.col("u")) & (F.col("block") == F.col("ub")), "left")
            .select("source", "block", "full", (F.col("_extra") > 0).alias("all"), "units", "edge"))


def _decided(own: DataFrame, drawn: DataFrame, per_source: DataFrame, units: DataFrame, seed: int) -> DataFrame:
    """Texts with their decision: ``full``, ``extra`` of ``copies`` like rows, and the shards of the passes.

    A text's block follows from its own columns, and a block's rows share a decision but at an edge: one row in
    about ``BLOCK`` is broadcast, and no text is moved.  Beyond ``DECISIONS`` of them texts meet their item's
    decision by a shuffle.
    """
    plan = stage(_decisions(drawn, units), "decisions")
    rows = (plan.agg(F.sum(F.lit(1) + F.coalesce(F.array_size("edge"), F.lit(0)))).first()[0] or 0) + per_source.count()
    if rows > DECISIONS:
        got = plan.select(F.col("source").alias("u"), F.col("block").alias("ub"), "units")
        items = drawn.join(got, F.col("source").eqNullSafe(F.col("u")) & (F.col("block") == F.col("ub"))).select(
            F.col("source").alias("__s"), F.col("doc_id").alias("__i"), F.col("size").alias("__z"), "copies", "full", "extra", "units")
        return own.join(items, F.col("__id").eqNullSafe(F.col("__i")) & F.col("__src").eqNullSafe(F.col("__s"))
                        & (F.col("__size") == F.col("__z"))).drop("__s", "__i", "__z")
    goal = F.broadcast(per_source.select(F.col("source").alias("__s"), "n"))
    blocks = F.broadcast(plan.select(F.col("source").alias("__u"), F.col("block").alias("__b"), "full", "all", "units", "edge"))
    order = F.xxhash64("__id", "__size", F.lit(seed))
    placed = own.join(goal, F.col("__src").eqNullSafe(F.col("__s"))).withColumn("__block", _block(order, F.col("n"))).drop("__s", "n")
    found = F.get(F.filter("edge", lambda x: x["doc_id"].eqNullSafe(F.col("__id")) & (x["size"] == F.col("__size"))), F.lit(0))
    at = placed.join(blocks, F.col("__src").eqNullSafe(F.col("__u")) & (F.col("__block") == F.col("__b"))).withColumn("__item", found)
    return at.select("__doc", "__id", "__src", "__size", "full", "units",
                     F.coalesce(F.col("__item.copies"), F.lit(1)).alias("copies"),
                     F.coalesce(F.col("__item.extra"), F.col("all").cast("long")).alias("extra"))


def mixed_documents(docs: DataFrame, seed: int = 17) -> DataFrame:
    """The mix itself: every document as often as it is taken, its columns as they were.

    Rows come by output shard, shuffled inside each.  Documents of size 0 are kept once, as
    nothing is gained or lost by them.
    """
    drawn, per_source, units = mix(docs, seed)
    units = stage(units, "shards")
    shard_count = 1 + (units.agg(F.max("shard")).first()[0] or 0)
    names = docs.columns
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__doc"),
                      F.col("doc_id").cast("long").alias("__id"), F.col("source").cast("string").alias("__src"),
                      size.alias("__size"))
    joined = _decided(own, drawn, per_source, units, seed)
    every = joined.where("extra in (0, copies)").withColumn("__times", F.col("full") + (F.col("extra") > 0).cast("long"))
    if not drawn.where("extra not in (0, copies)").isEmpty():
        # rows that agree in id, source and size are dealt the extra copies in the order of a row number
        number = F.row_number().over(Window.partitionBy("__id", "__src", "__size").orderBy(F.xxhash64("__doc")))
        several = joined.where("extra not in (0, copies)").withColumn("__n", number).withColumn(
            "__times", F.col("full") + (F.col("__n") <= F.col("extra")).cast("long")).drop("__n")
        every = every.unionByName(several)
    # the text travels as often as it is taken, to its shard
    shards = F.slice("units", F.lit(1), F.col("__times").cast("int"))
    shards = F.when(F.col("__size") == 0, F.array(F.lit(None).cast("int"))).otherwise(shards)
    every = every.select("__doc", "__id", F.posexplode(shards).alias("__pass", "shard"))
    mixed = F.xxhash64("__id", "__pass", F.lit(seed))
    # equal shares of the line of (shard, place): equal partitions whatever the number and size of the
    # shards, without the second run over the texts that sampled ranges would take
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = every.withColumn("__place", mixed)
    at = (F.col("shard") + F.col("__place") / F.lit(2.0 ** 64) + F.lit(0.5)) / F.lit(float(shard_count))
    part = F.when(F.col("shard").isNull(), F.pmod("__place", F.lit(parts))).otherwise(
        F.least(F.floor(at * parts), F.lit(parts - 1))).cast("int")
    return (every.repartitionById(parts, part).sortWithinPartitions("shard", "__place")
            .select(*[F.col("__doc")[c].alias(c) for c in names]))
