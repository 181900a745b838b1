"""Helpers the operators of this folder share: lineage cuts, word hashes, ranks, components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from roadsight.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared checkpoint folder and read it back."""
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Hint a broadcast when ``rows`` (already counted) is within ``limit``; beyond it a shuffle join."""
    return F.broadcast(df) if rows <= limit else df


# --- word hashes over whole Arrow buffers --------------------------------------------------------

_P = 0x9E3779B97F4A7C15
_CHUNK = 1 << 19
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(33))
    h = h * _M1
    h = h ^ (h >> np.uint64(33))
    h = h * _M2
    return h ^ (h >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64."""
    base = np.full(n, _P, np.uint64)
    inverse = np.full(n, pow(_P, -1, 1 << 64), np.uint64)
    base[0] = inverse[0] = 1
    return np.cumprod(base, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)


class WordHasher:
    """64-bit hashes of the words of UTF-8 texts; ``is_word`` and ``fold`` say what words are.

    A word's hash is a polynomial over random byte values, taken from prefix sums, so a whole
    buffer is hashed without a Python object per word.
    """

    def __init__(self, is_word: np.ndarray, fold: np.ndarray):
        values = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
        self.values, self.is_word = values[fold], is_word
        self.power, self.inverse = _powers(_CHUNK)

    def _hash(self, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and start offsets of the words of ``data``; ``first`` marks bytes where a text starts."""
        n = len(data)
        if n > len(self.power):
            self.power, self.inverse = _powers(n)
        inside = self.is_word[data]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | first[1:]
        end = inside.copy()
        end[:-1] &= ~inside[1:] | first[1:]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(end)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * self.power[:n], out=total[1:])
        return mix((total[ends + 1] - total[starts]) * self.inverse[starts]), starts

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of many texts, concatenated, and the number of words of each text.

        Texts are handled in runs of about half a MB; a longer text is cut between words.
        """
        hashes, counts, i, n = [], np.zeros(len(offsets) - 1, np.int64), 0, len(offsets) - 1
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _CHUNK, "right")) - 1)
            lo, hi = int(offsets[i]), int(offsets[j])
            if hi - lo > _CHUNK:  # one long text
                while lo < hi:
                    cut = min(hi, lo + _CHUNK)
                    while cut < hi:
                        gaps = np.flatnonzero(~self.is_word[data[cut - 1:cut - 1 + _CHUNK]])
                        if len(gaps):
                            cut += int(gaps[0])
                            break
                        cut = min(hi, cut + _CHUNK)
                    part = data[lo:cut]
                    h, _ = self._hash(part, np.zeros(len(part), bool))
                    hashes.append(h)
                    counts[i] += len(h)
                    lo = cut
            elif hi > lo:
                part, first = data[lo:hi], np.zeros(hi - lo, bool)
                at = offsets[i:j] - lo
                first[at[at < hi - lo]] = True
                h, starts = self._hash(part, first)
                hashes.append(h)
                counts[i:j] = np.diff(np.searchsorted(starts, offsets[i:j + 1] - lo))
            i = j
        return (np.concatenate(hashes) if hashes else np.empty(0, np.uint64)), counts


def ascii_fold() -> np.ndarray:
    """Byte table that lower-cases A-Z only."""
    fold = np.arange(256)
    fold[65:91] += 32
    return fold


def space_words() -> WordHasher:
    """Words between the blanks 0x20 and 0x09 to 0x0D, A-Z lower-cased."""
    is_word = np.ones(256, bool)
    is_word[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
    return WordHasher(is_word, ascii_fold())


def binary_parts(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow binary column (nulls are empty)."""
    import pyarrow as pa

    if column.null_count:
        column = column.fill_null(b"")
    wide = pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    d = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return d, o.astype(np.int64)


# --- ranks and components ------------------------------------------------------------------------

def with_rank(df: DataFrame, by: list[Column], name: str, parts: int | None = None) -> DataFrame:
    """Number all rows from 0 in the order ``by`` (last key should break ties).

    Rows are dealt by sorted ranges, counted per range, and numbered within each range; only one
    row a range passes through a single task.  ``df`` is written first, so both passes see the
    same ranges even when an executor is lost.
    """
    spark = df.sparkSession
    parts = parts or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    ranged = stage(ranged.withColumn("__part", F.spark_partition_id())
                   .withColumn("__row", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "rank")
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    from pyspark.sql.window import Window

    starts = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__start"))
    return (ranged.join(F.broadcast(starts), "__part")  # one row a partition
            .withColumn(name, F.col("__start") + F.col("__row")).drop("__part", "__row", "__start", "__n"))


#: Keys a node's edges are dealt to in ``components``.
SALTS = 64
EDGE = StructType([StructField("u", LongType()), StructField("v", LongType())])


def _with_least(edges: DataFrame) -> DataFrame:
    """(u, v, m): edges with the least neighbour m of u.

    Edges are dealt by (u, salt of v), so a hub that many nodes point at is spread over ``SALTS`` keys;
    only one row a salt meets at the hub itself.
    """
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    parts = salted.groupBy("u", "salt").agg(F.min("v").alias("m"))
    least = parts.groupBy("u").agg(F.min("m").alias("m"))
    return salted.join(parts.select("u", "salt").join(least, "u"), ["u", "salt"]).select("u", "v", "m")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(u long, v long)``: one row (node, root) a node that has an edge.

    Alternating large-star and small-star rounds; the smallest node of a component is its root.
    Every round is a few grouped aggregations over edges, written to the shared folder, until the
    edges stay the same; each node then points straight at its root.
    """
    edges = edges.where("u is not null and v is not null and u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, last = stage(edges, "edges"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        pairs = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))
        small = _with_least(large).select(F.inline(pairs)).where("u <> v").distinct()
        edges = stage(small, "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        last = now
