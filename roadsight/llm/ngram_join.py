"""N-gram Jaccard self-join of whole documents by a size-aware heavy-light join.

A document's set holds its distinct shingles of five words (fewer words: the whole sequence as one);
two documents link when |A n B| / |A u B| >= 0.75.  Results are exact up to hash collisions of
64-bit set and of shingle fingerprints, which are 56 bits where frequencies are counted (a bucket and
48 bits in it) and 48 bits where the shingles of two sets are compared.

1. One pass over the texts makes shingle fingerprints.  They travel packed, 8 bytes a shingle, to
   hash buckets, where every shingle's document frequency is counted over all documents; equal sets
   count once a chunk.  Only shingles of at least two documents go back to their documents.
2. Equal sets become one class.  In the order (frequency, fingerprint), a set of n shingles can only
   link with sets that share ``l`` shingles of its first n - ceil(0.75 n) + l (l = 1, 2).  Shingles
   that no other document has fill most of these places, so few sets have any candidate at all.
3. Size-aware: small sets enumerate the fixed-size subsets (pairs) of their places and meet each
   other there; sets above the boundary scan the inverted lists of their single places, in which
   small sets are entered too.  The boundary is the size with the least summed cost, from the cost of
   both ways over all sets.
4. Light keys (up to ``LIGHT`` sets) give candidate pairs, each once, that are verified on their
   shared shingles.  Heavy keys give no pairs: their sets are numbered so that alike sets stand
   together and cut into chunks; pairs of chunks with a heavy key in common are verified as blocks,
   and a block returns the edges of a spanning forest only.
5. Connected components of all verified links.

Null, empty and blank texts have an empty set and link with nothing.  Rows without id keep a null
component unless their set's class has one.  Repeated rows are rows of one class.  Empty tables give
no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from roadsight.llm.common import (binary_parts, components, mix, small_side, space_words, stage, with_rank)

WORDS = 5
#: Least number of buckets; beyond it there are as many as keep so many shingles a bucket and a task.
BUCKETS, PER_BUCKET, PER_TASK = 1024, 1 << 19, 1 << 21
#: Bytes of text for a shingle, at least.
BYTES_A_SHINGLE = 5
#: Documents and shingles of a chunk that travels together.
CHUNK_DOCS, CHUNK_SHINGLES = 4096, 1 << 20
LIGHT = 32
BLOCK = 256
#: Cost of a subset, which is dealt out, sorted and counted, in entries of a scanned list.
SUBSET_COST = 3
_STEP = [np.uint64(c) for c in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]
_LOW = np.uint64((1 << 48) - 1)


def shingles(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """56-bit fingerprints of the shingles of concatenated texts, and their text's number."""
    text = np.repeat(np.arange(len(counts)), counts)
    out, own = [], []
    if len(words) >= WORDS:
        inside = text[WORDS - 1:] == text[:-(WORDS - 1)]
        h = words[:len(words) - WORDS + 1] * _STEP[0]
        for j in range(1, WORDS):
            h = (h ^ (h >> np.uint64(29))) * _STEP[j] + words[j:len(words) - WORDS + 1 + j]
        out.append(mix(h)[inside])
        own.append(text[:len(inside)][inside])
    starts = np.concatenate([[0], np.cumsum(counts)])
    for i in np.flatnonzero((counts > 0) & (counts < WORDS)):
        h = counts[i:i + 1].astype(np.uint64)  # arrays of one: products wrap without a warning
        for k in range(starts[i], starts[i + 1]):
            h = (h ^ (h >> np.uint64(31))) * _STEP[4] + words[k:k + 1]
        out.append(mix(h))
        own.append(np.array([i]))
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(out) >> np.uint64(8), np.concatenate(own)


def _pack48(tokens: np.ndarray) -> bytes:
    return np.ascontiguousarray((tokens & _LOW).astype("<u8").view("<u2").reshape(-1, 4)[:, :3]).tobytes()


def _unpack48(raw: bytes) -> np.ndarray:
    three = np.frombuffer(raw, "<u2").reshape(-1, 3)
    four = np.zeros((len(three), 4), "<u2")
    four[:, :3] = three
    return four.reshape(-1).view("<u8").astype(np.uint64)


def _sets(batch, hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, shingle) of a batch sorted by both, and the documents' set sizes."""
    data, offsets = binary_parts(batch.column(1))
    tokens, own = shingles(*hasher.texts(data, offsets))
    order = np.lexsort((tokens, own)) if len(tokens) else np.empty(0, np.int64)
    tokens, own = tokens[order], own[order]
    if len(tokens):
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (own[1:] != own[:-1])
        tokens, own = tokens[new], own[new]
    return tokens, own, np.bincount(own, minlength=batch.num_rows)


CHUNKS = "kind int, bucket int, chunk long, a binary, b binary, c binary"


def _chunks(buckets: int):
    """Texts to rows of two kinds: 0 the documents of a chunk, 1 its shingles in one bucket."""
    def apply(batches):
        import pyarrow as pa
        import xxhash
        from pyspark import TaskContext

        hasher, number = space_words(), TaskContext.get().partitionId() << 24
        width = np.uint64(56 - (buckets.bit_length() - 1))
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, min(CHUNK_DOCS, batch.num_rows - at))
                ends = np.cumsum(np.diff(binary_parts(part.column(1))[1])) // 4  # about as many shingles at most
                part = part.slice(0, max(1, int(np.searchsorted(ends, CHUNK_SHINGLES, "right"))))
                at += part.num_rows
                tokens, own, sizes = _sets(part, hasher)
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                prints = np.array([xxhash.xxh3_64_intdigest(tokens[lo:hi].tobytes(), seed=int(hi - lo))
                                   for lo, hi in zip(bounds[:-1], bounds[1:])], np.uint64).view(np.int64)
                _, first = np.unique(prints, return_index=True)  # equal sets count once a chunk
                alone = np.zeros(len(prints), bool)
                alone[first] = True
                ids, rows_of = part.column(0), part.column(2).to_numpy()
                known = np.array(ids.is_valid().to_pylist(), bool)
                rows = [(0, number % buckets, number, ids.fill_null(0).to_numpy().astype("<i8").tobytes(),
                         np.stack([sizes, known, rows_of], 1).astype("<i8").tobytes(), prints.tobytes())]
                use = alone[own]
                tokens, own = tokens[use], own[use].astype("<u2")
                order = np.argsort(tokens, kind="stable")
                tokens, own = tokens[order], own[order]
                edges = np.searchsorted(tokens, np.arange(buckets + 1, dtype=np.uint64) << width)
                for b in np.flatnonzero(np.diff(edges)):
                    lo, hi = edges[b], edges[b + 1]
                    rows.append((1, int(b), number, _pack48(tokens[lo:hi]), own[lo:hi].tobytes(), None))
                number += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32(), pa.int32(), pa.int64()] + [pa.binary()] * 3)],
                    ["kind", "bucket", "chunk", "a", "b", "c"])
    return apply


def _shared(key, table):
    """Shingles of one bucket that at least two documents have: (chunk, document, shingle, frequency)."""
    import pyarrow as pa

    kinds = table["kind"].to_numpy()
    whole = table.filter(pa.array(kinds == 0))
    rows = table.filter(pa.array(kinds == 1))
    if not rows.num_rows:
        return whole
    bucket = int(rows["bucket"][0].as_py())
    blobs = [_unpack48(x) for x in rows["a"].to_pylist()]
    docs = np.concatenate([np.frombuffer(x, "<u2") for x in rows["b"].to_pylist()])
    chunk = np.repeat(rows["chunk"].to_numpy(), [len(x) for x in blobs])
    tokens = np.concatenate(blobs)
    order = np.argsort(tokens, kind="stable")
    tokens = tokens[order]
    new = np.ones(len(tokens), bool)
    new[1:] = tokens[1:] != tokens[:-1]
    counts = np.diff(np.append(np.flatnonzero(new), len(tokens)))
    df = np.repeat(counts, counts)
    keep = df > 1
    order, tokens, df = order[keep], tokens[keep], df[keep]
    docs, chunk = docs[order], chunk[order]
    by = np.argsort(chunk, kind="stable")
    docs, chunk, tokens, df = docs[by], chunk[by], tokens[by], df[by]
    starts = np.flatnonzero(np.diff(chunk, prepend=-1)) if len(chunk) else np.empty(0, np.int64)
    ends = np.append(starts[1:], len(chunk))
    out = [(1, bucket, int(chunk[s]), _pack48(tokens[s:e]), docs[s:e].tobytes(), df[s:e].astype("<u4").tobytes())
           for s, e in zip(starts, ends)]
    found = pa.Table.from_pylist([dict(zip(table.column_names, r)) for r in out], table.schema)
    return pa.concat_tables([whole, found])


def _documents(batches):
    import pyarrow as pa

    for batch in batches:
        for chunk, a, b, c in zip(*(batch.column(i).to_pylist() for i in range(4))):
            sizes = np.frombuffer(b, "<i8").reshape(-1, 3)
            ids = pa.array(np.frombuffer(a, "<i8"), mask=sizes[:, 1] == 0)
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes[:, 0]), pa.array(np.frombuffer(c, "<i8")), pa.array(np.full(n, chunk)),
                 pa.array(np.arange(n, dtype=np.int32)), pa.array(sizes[:, 2])], ["doc_id", "n", "print", "chunk", "place", "row"])


CANDIDATE = ("print long, n long, single binary, pair binary, weight long, subsets long, scans long, shared binary")


def _places(key, postings, classes):
    """The sets of a chunk that may have a partner, with their first places in the global order.

    ``single`` and ``pair`` hold the shared shingles among the first places for l = 1 and l = 2.
    """
    import pyarrow as pa

    n = classes["n"].to_numpy()
    by_place = {p: i for i, p in enumerate(classes["place"].to_pylist())}
    rows = []
    if postings.num_rows and len(n):
        tokens = np.concatenate([_unpack48(x) for x in postings["a"].to_pylist()])
        docs = np.concatenate([np.frombuffer(x, "<u2") for x in postings["b"].to_pylist()])
        df = np.concatenate([np.frombuffer(x, "<u4") for x in postings["c"].to_pylist()])
        order = np.lexsort((tokens, df, docs))
        tokens, docs, df = tokens[order], docs[order], df[order]
        starts = np.flatnonzero(np.diff(docs.astype(np.int64), prepend=-1))
        prints = classes["print"].to_numpy()
        for lo, hi in zip(starts, np.append(starts[1:], len(docs))):
            i = by_place.get(int(docs[lo]))
            if i is None:
                continue
            size, own = int(n[i]), hi - lo
            rest = size - -(-3 * size // 4) - (size - own)  # places that other documents' shingles reach
            one, two = max(0, min(own, rest + 1)), max(0, min(own, rest + 2))
            if one:
                rows.append((int(prints[i]), size, tokens[lo:lo + one].tobytes(), tokens[lo:lo + two].tobytes(),
                             int(df[lo]), two * (two - 1) // 2, int(np.minimum(df[lo:lo + one], LIGHT).sum()), _pack48(np.sort(tokens[lo:hi]))))
    names = [f.split()[0] for f in CANDIDATE.split(", ")]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 8, types)], names=names)


def boundary(candidates: DataFrame) -> int:
    """The set size up to which subsets are cheaper than scans, by the summed costs of all sets.

    A subset costs ``SUBSET_COST``; a scan costs the entries of its list, ``LIGHT`` at most, as longer lists are not scanned but met in blocks.  Sizes are grouped four classes an
    octave, so the driver sees a few hundred sums at most.
    """
    size_class = F.floor(F.log2("n") * 4)
    costs = (candidates.groupBy(size_class.alias("k")).agg(F.max("n").alias("n"), F.sum("subsets").alias("subsets"),
                                                           F.sum("scans").alias("scans")).orderBy("k").collect())
    at, total = 0, sum(r.scans for r in costs)
    least = total
    for r in costs:
        total += SUBSET_COST * r.subsets - r.scans
        if total <= least:
            least, at = total, r.n
    return at


KEYS = "key long, kind int, print long, n long"


def _keys(limit: int):
    """Keys of the candidate sets: 0 a pair of a small set, 1 a shingle of a small set, 2 of a large one."""
    def apply(batches):
        import pyarrow as pa

        for batch in batches:
            keys, kinds, prints, sizes = [], [], [], []
            for p, n, single, pair in zip(*(batch.column(i).to_pylist() for i in range(4))):
                one = np.frombuffer(single, np.uint64)
                own, kind = [mix(one)], [np.full(len(one), 1 if n <= limit else 2, np.int32)]
                if n <= limit:
                    two = np.sort(np.frombuffer(pair, np.uint64))
                    i, j = np.triu_indices(len(two), 1)
                    own.append(mix(mix(two[i]) * _STEP[1] + two[j]))
                    kind.append(np.zeros(len(i), np.int32))
                keys += own
                kinds += kind
                m = sum(map(len, own))
                prints.append(np.full(m, p, np.int64))
                sizes.append(np.full(m, n, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(kinds)),
                     pa.array(np.concatenate(prints)), pa.array(np.concatenate(sizes))], ["key", "kind", "print", "n"])
    return apply


def _linked(a: np.ndarray, na: int, b: np.ndarray, nb: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (na + nb - both)


def _verify(batches):
    import pyarrow as pa

    for batch in batches:
        a, b, sa, sb, na, nb = (batch.column(i).to_pylist() for i in range(6))
        cache: dict[int, np.ndarray] = {}
        good = []
        for i in range(batch.num_rows):
            if a[i] not in cache:
                cache = {a[i]: _unpack48(sa[i])}
            good.append(_linked(cache[a[i]], na[i], _unpack48(sb[i]), nb[i]))
        mask = pa.array(good, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["u", "v"])


def _block(key, table):
    """Edges of a spanning forest of the links between two chunks of sets (or within one)."""
    import pyarrow as pa

    prints, side = table["print"].to_numpy(), table["side"].to_numpy()
    n = table["n"].to_numpy()
    sets = [_unpack48(x) for x in table["shared"].to_pylist()]
    m = len(sets)
    tokens, own = np.concatenate(sets), np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(tokens, kind="stable")
    tokens, own = tokens[order], own[order]
    column = np.cumsum(np.diff(tokens, prepend=tokens[:1]) != 0)
    twice = np.bincount(column) > 1
    use = twice[column]
    own, column = own[use], (np.cumsum(twice) - 1)[column[use]]
    both = np.zeros((m, m), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 8192):
        s, e = np.searchsorted(column, [lo, lo + 8192])
        x = np.zeros((m, 8192), np.float32)
        x[own[s:e], column[s:e] - lo] = 1
        both += x @ x.T
    linked = 100 * both >= 75 * (n[:, None] + n[None, :] - both)
    if len(np.unique(side)) > 1:
        linked &= side[:, None] != side[None, :]
    root = np.arange(m)
    for i in range(m):  # labels of the components, a set at a time
        near = np.flatnonzero(linked[i, :i])
        if len(near):
            roots = np.unique(root[near])
            root[np.isin(root[:i], roots).nonzero()[0]] = roots[0]
            root[i] = roots[0]
    far = np.flatnonzero(root != np.arange(m))
    return pa.table([pa.array(prints[far]), pa.array(prints[root[far]])], names=["u", "v"])


def _heavy_links(heavy: DataFrame, candidates: DataFrame) -> DataFrame:
    """Links among the sets of heavy keys, by blocks of chunks that have a heavy key in common."""
    home = heavy.groupBy("print", "n").agg(F.max(F.struct("size", "key")).alias("home"))
    numbered = with_rank(home, [F.col("home.key"), F.col("n"), F.col("print")], "rank")
    numbered = stage(numbered.select("print", "n", F.floor(F.col("rank") / BLOCK).alias("chunk")), "heavy")
    by_key = heavy.select("print", "key").join(numbered, "print").groupBy("key", "chunk").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"))
    left = by_key.select("key", F.col("chunk").alias("c1"), F.col("lo").alias("lo1"), F.col("hi").alias("hi1"))
    right = by_key.select("key", F.col("chunk").alias("c2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    blocks = left.join(right, "key").where("c1 <= c2 and 100 * hi1 >= 75 * lo2 and 100 * hi2 >= 75 * lo1").select("c1", "c2").distinct()
    sides = blocks.select("c1", "c2", F.explode(F.array_distinct(F.array("c1", "c2"))).alias("chunk"))
    sets = numbered.join(candidates.select("print", "shared"), "print")
    dealt = sides.join(sets, "chunk").select("c1", "c2", (F.col("chunk") == F.col("c1")).cast("int").alias("side"), "print", "n", "shared")
    return dealt.groupBy("c1", "c2").applyInArrow(_block, "u long, v long")


def links(candidates: DataFrame, limit: int | None = None, light: int = LIGHT) -> DataFrame:
    """Links (u, v) between candidate sets that connect all that is linked."""
    limit = boundary(candidates) if limit is None else limit
    keys = stage(candidates.select("print", "n", "single", "pair").mapInArrow(_keys(limit), KEYS), "keys")
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.max(F.col("kind") != 1).alias("any")).where("size > 1 and any")
    sized = keys.join(sizes, "key")
    lists = sized.where(F.col("size") <= light).groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("print", "kind", "n"))).alias("l"))
    a = lists.select(F.posexplode("l").alias("i", "a"), "l")
    ab = a.select("a", F.explode(F.slice("l", F.col("i") + 2, F.size("l"))).alias("b"))
    near = ab.where("(a.kind <> 1 or b.kind <> 1) and 100 * a.n >= 75 * b.n and 100 * b.n >= 75 * a.n and a.print <> b.print")
    pairs = near.select(F.col("a.print").alias("u"), F.col("b.print").alias("v")).distinct()
    sets = candidates.select("print", "n", "shared")
    left = sets.select(F.col("print").alias("u"), F.col("shared").alias("su"), F.col("n").alias("nu"))
    right = sets.select(F.col("print").alias("v"), F.col("shared").alias("sv"), F.col("n").alias("nv"))
    light_links = pairs.join(right, "v").join(left, "u").select("u", "v", "su", "sv", "nu", "nv").mapInArrow(_verify, "u long, v long")
    heavy = stage(sized.where(F.col("size") > light).select("print", "n", "key", "size"), "heavy-keys")
    if heavy.isEmpty():
        return light_links
    return light_links.unionByName(_heavy_links(heavy, candidates))


def _row_key() -> Column:
    """Tells rows apart by id and text; rows with both equal are interchangeable."""
    text = F.col("text").cast("binary")
    return F.xxhash64(F.col("doc_id").cast("long"), text, F.col("doc_id").isNull(), text.isNull()).alias("row")


def _bucketing(texts: DataFrame) -> tuple[int, int]:
    """Buckets (a power of two) and tasks for the shingles of ``texts``, by the size of all texts."""
    most = (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BYTES_A_SHINGLE
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(BUCKETS, 1 << max(0, most // PER_BUCKET).bit_length()), max(tasks, -(-most // PER_TASK))


def classes_and_links(docs: DataFrame, buckets: int | None = None, limit: int | None = None,
                      light: int = LIGHT) -> tuple[DataFrame, DataFrame]:
    """(documents with set size and class, links between classes)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), _row_key())
    most, tasks = _bucketing(texts)
    pieces = texts.mapInArrow(_chunks(buckets or most), CHUNKS).repartition(tasks, "bucket")
    counted = stage(pieces.groupBy("bucket").applyInArrow(_shared, CHUNKS), "shingles")
    rows = counted.where("kind = 0").select("chunk", "a", "b", "c").mapInArrow(
        _documents, "doc_id long, n long, print long, chunk long, place int, row long")
    rows = stage(rows, "sets")
    classes = rows.where("n > 0").groupBy("print", "n").agg(F.min(F.struct("chunk", "place")).alias("r")).select(
        "print", "n", "r.chunk", "r.place")
    # the class's set was counted with the first equal set of its chunk, which has the smallest place
    postings = counted.where("kind = 1").select("chunk", "a", "b", "c")
    candidates = stage(postings.groupBy("chunk").cogroup(classes.groupBy("chunk")).applyInArrow(_places, CANDIDATE), "candidates")
    return rows, links(candidates, limit, light)


def _joined(docs: DataFrame, buckets: int | None, limit: int | None, light: int) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, its row key and that of the row to keep.

    ``first`` is the component's row with the smallest id, then the smallest row key; rows without id come
    last.  It is null for documents that link with nothing.
    """
    rows, found = classes_and_links(docs, buckets, limit, light)
    roots = components(found).withColumnRenamed("node", "print")
    classes = rows.where("n > 0").groupBy("print", "n").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("m"),
                                                            F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "row"))).alias("first"),
                                                            F.min(F.when(F.col("doc_id").isNull(), F.col("row"))).alias("bare"))
    rooted = stage(classes.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print")), "rooted")
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.sum("m").alias("m"), F.min("first").alias("first"), F.min("bare").alias("bare")).where("m > 1")
    named = rooted.select("print", "n", "root").join(lows.select("root", "component_id", F.col("first.row").alias("first"), "bare"), "root").select(
        F.col("print").alias("p"), F.col("n").alias("s"), "component_id", "first", "bare")
    return rows.join(named, (F.col("print") == F.col("p")) & (F.col("n") == F.col("s")), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "row",
        F.coalesce("first", "bare").alias("first"))


def join(docs: DataFrame, buckets: int | None = None, limit: int | None = None, light: int = LIGHT) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id."""
    return _joined(docs, buckets, limit, light).drop("row", "first")


def keep_one(docs: DataFrame, broadcast_rows: int = 2_000_000) -> DataFrame:
    """The documents with one of each linked group kept, all columns as they were.

    Kept is the row with the smallest id; a row without id only where no row of its group has one.
    Rows are told apart by id and text, so a repeated id drops no text that links with nothing.
    """
    joined = stage(_joined(docs, None, None, LIGHT).select("row", "first").where("first is not null"), "joined")
    gone = joined.where("row <> first").select(F.col("row").alias("__gone")).distinct()
    rest = docs.join(small_side(gone, gone.count(), broadcast_rows), _row_key() == F.col("__gone"), "left_anti")
    twice = joined.where("row = first").groupBy("row").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    if twice.isEmpty():
        return rest
    several = small_side(twice.select(F.col("row").alias("__twice")), twice.count(), broadcast_rows)
    once = (rest.join(several, _row_key() == F.col("__twice"), "left_semi").withColumn("__row", _row_key())
            .dropDuplicates(["__row"]).drop("__row"))
    return rest.join(several, _row_key() == F.col("__twice"), "left_anti").unionByName(once)


JOIN_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, len(ws) AS words, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
k AS (SELECT DISTINCT doc_id, shingle FROM (
  SELECT doc_id, words, i, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS shingle
  FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)) WHERE i <= greatest(1, words - {WORDS - 1})),
n AS (SELECT doc_id, count(*) AS n FROM k GROUP BY doc_id),
pair AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS inter FROM k a JOIN k b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
link AS (SELECT u, v FROM pair JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * inter >= 75 * (a.n + b.n - inter)),
reach AS (SELECT u, v FROM link UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u),
lows AS (SELECT u, min(v) AS low FROM reach GROUP BY u)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, CAST(least(d.doc_id, coalesce(low, d.doc_id)) AS BIGINT) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN lows ON lows.u = d.doc_id
"""
