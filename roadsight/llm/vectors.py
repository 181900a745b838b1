"""What the two operators on embeddings share: valid vectors, classes of equal ones, blocks by rank."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from roadsight.llm.common import stage, with_rank


def valid(vector: Column) -> Column:
    """Not null, not empty, finite throughout and not all zero."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(ok & F.exists(vector, lambda x: x != 0), F.lit(False))


def vector_of(rows: DataFrame) -> Column:
    """The embedding as it is shuffled: floats stay floats (half the bytes), all else becomes doubles.

    ``matrix`` computes in doubles either way.
    """
    floats = rows.schema["embedding"].dataType.simpleString() == "array<float>"
    return F.col("embedding") if floats else F.col("embedding").cast("array<double>")


def classes(rows: DataFrame, *more: Column) -> DataFrame:
    """Equal vectors as one row (node, vector) with aggregates ``more``."""
    vector = vector_of(rows)
    own = rows.where(valid(vector)).select("vec_id", vector.alias("vector"))
    return own.groupBy("vector").agg(*more).withColumn("node", F.xxhash64("vector"))


def matrix(column) -> np.ndarray:
    """Rows of an Arrow list column whose vectors are equally long."""
    if hasattr(column, "combine_chunks"):
        column = column.combine_chunks()
    values = column.flatten().to_numpy()
    return values.reshape(len(column), -1).astype(np.float64)


def by_length(batch, at: int):
    """(length, row numbers, matrix) for each vector length in a batch."""
    import pyarrow as pa
    import pyarrow.compute as pc

    lengths = pc.list_value_length(batch.column(at)).to_numpy()
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        yield n, rows, matrix(batch.column(at).take(pa.array(rows)))


def in_blocks(keys: DataFrame, block: int, name: str, *more: str) -> DataFrame:
    """(pass, length, key, node, more) to (node, pass, length, block, more): blocks of equally many rows in key order.

    One ranking serves all passes.  Ranks do not depend on how keys are spread, so ties and
    crowded places give no larger block.  Ties stand in another order in every pass, so that rows
    of one crowded place do not always miss the same others.
    """
    order = [F.col("pass"), F.col("length"), F.col("key"), F.xxhash64("node", "pass"), F.col("node"), *map(F.col, more)]
    ranked = with_rank(keys, order, "rank")
    return stage(ranked.select("node", "pass", "length", F.floor(F.col("rank") / block).alias("block"), *more), name)
