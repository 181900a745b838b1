"""Best-fit decreasing packing of tokenised documents into fixed-length sequences.

Documents become ids plus an end id; only those longer than a sequence are cut, from their end, so
that every piece but the first fills a sequence.  Pieces are dealt at random into shards of about
``SHARD`` pieces; each shard packs its pieces, longest first, into the open sequence with the least
room that still fits, found by a segment tree over the remaining capacities in O(log capacity).
One shard wastes at most a part of its last sequences, whatever the corpus size.

A null text is empty: its piece is the end id alone.  Repeated rows and rows without id are pieces
of their own.  An empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, functions as F

from roadsight.llm.common import stage

CAPACITY = 2048
SHARD = 16384
#: Documents a worker holds the ids of at once.
ROWS = 256
PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _fast(ranks_path: str):
    """Encoder over the vocabulary's ranks: the tokenizer's ids, several times as fast."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def _whole(json_path: str):
    """The tokenizer itself, loaded only for texts with an added token and where the encoder refuses a text."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(json_path)


@lru_cache(maxsize=2)
def _added(json_path: str):
    """Finds the strings that the tokenizer takes as tokens of their own, which the ranks do not know."""
    with open(json_path, encoding="utf-8") as f:
        strings = [token["content"] for token in json.load(f).get("added_tokens") or []]
    return re.compile("|".join(map(re.escape, strings)) or r"(?!)").search


def encode(text: str, ranks_path: str, json_path: str) -> np.ndarray:
    if _added(json_path)(text):
        return np.array([*_whole(json_path).encode(text, add_special_tokens=False).ids, 0], np.uint32)
    try:
        ids = _fast(ranks_path).encode_ordinary(text)
    except BaseException as error:  # the pattern engine panics on some very long runs
        if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
            raise
        ids = _whole(json_path).encode(text, add_special_tokens=False).ids
    return np.array([*ids, 0], np.uint32)


def cuts(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``total`` ids; the first may be shorter than a sequence."""
    first = total if total <= capacity else (total % capacity or capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, total, capacity)]


def token_pieces(docs: DataFrame, keep_ids: bool = False, capacity: int = CAPACITY, json_path: str | None = None,
                 ranks_path: str | None = None) -> DataFrame:
    """One row a piece, with its ids if asked for; ``row`` numbers input rows apart."""
    import pyarrow as pa

    json_path = json_path or _vocabulary("byte_bpe_50k.json")
    ranks_path = ranks_path or _vocabulary("byte_bpe_50k.tiktoken")

    def apply(batches):
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            out = [[] for _ in range(7)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text or "", ranks_path, json_path)
                for k, (start, length) in enumerate(cuts(len(ids), capacity)):
                    own = ids[start:start + length]
                    values = (doc_id, row, k, start, length, zlib.crc32(own.astype("<u4").tobytes()), own.astype(np.int32))
                    for column, value in zip(out, values):
                        column.append(value)
                row += 1
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            n = 7 if keep_ids else 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out[:n], types)], names[:n])

    schema = PIECES + (", ids array<int>" if keep_ids else "")
    names = [field.split()[0] for field in schema.split(", ")]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(apply, schema)


class RoomTree:
    """Segment tree over remaining capacities: how many open sequences have each, below each node."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        node = self.size + room
        while node:
            self.open[node] += by
            node >>= 1

    def put(self, room: int, number: int) -> None:
        if room:
            self.bins[room].append(number)
            self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Room and number of an open sequence with the least room of at least ``need``."""
        node = self.size + need
        if not self.open[node]:
            while node > 1 and (node & 1 or not self.open[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.open[2 * node] else 2 * node + 1
        room = node - self.size
        self._add(room, -1)
        return room, self.bins[room].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length (already in decreasing order)."""
    tree, sequence, offset, opened = RoomTree(capacity), np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, length in enumerate(lengths.tolist()):
        found = tree.take(length) if length < capacity else None
        room, number = found or (capacity, opened)
        opened += found is None
        sequence[i], offset[i] = number, capacity - room
        tree.put(room - length, number)
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (row, piece, length, any more columns)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    shards = max(1, -(-pieces.count() // shard))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"

    def apply(key, table):
        table = table.sort_by([("length", "descending"), ("row", "ascending"), ("piece", "ascending")])
        sequence, offset = best_fit_decreasing(table["length"].to_numpy(), capacity)
        own = pc.cast(key[0], pa.int64()).as_py() << 32
        return (table.drop_columns(["__shard"]).append_column("sequence_id", pa.array(sequence + own))
                .append_column("offset", pa.array(offset)))

    dealt = pieces.withColumn("__shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)))
    return dealt.groupBy("__shard").applyInArrow(apply, schema)


def pack_documents(docs: DataFrame, keep_ids: bool = False, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack all documents: one row a piece with its place."""
    return pack(stage(token_pieces(docs, keep_ids, capacity), "pieces"), capacity).drop("row")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces that kept their ids: one row a sequence."""
    placed = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(placed, lambda p: p["ids"])).alias("ids"))
