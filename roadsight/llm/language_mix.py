"""Language identification: each document is a mixture of languages, its proportions found by EM.

A language is a Markov model of the letters in a word: p(word) is the product of p(c | a, b) over the
word's bytes, blanks standing before and after it.  A document's words come from its languages in
unknown proportions; expectation-maximisation over its words estimates them.  Sets of languages are
tried from the strongest on, and one more is taken only while the likelihood gains more than its
penalty.  The answer is the largest proportion in the chosen set.

Words are runs of ASCII letters and bytes above ASCII, A-Z lower-cased; runs beyond 32 bytes (scripts
without blanks) are cut there, so that one run can hold several languages.  Counts come from all rows
that may be learnt from; the model has 2 x 65,536 numbers a language, whatever the corpus.

* Texts that are null or have no letter get ``und`` and score 0, and so does every text where nothing
  was learnt.  Rows without language, and rows whose text has no word, teach nothing.
* ``score`` is the answer's proportion; where one language was chosen, its posterior among all.
* Equal likelihoods go to the language that sorts first.  Rows without id are not held out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from roadsight.llm.common import ascii_fold, binary_parts

CELLS = 1 << 16
#: What a further language must gain in likelihood (nats): so much a word, and so much a doubling of the words.
PER_WORD, PER_DOUBLING = 0.05, 1.0
ROUNDS = 25
_RUN = 32
_CHUNK = 1 << 18
#: A text that is longer is read again in every round, and not held as likelihoods.
_HELD = 1 << 24
_BLANK = np.uint32(32)
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[65:91] = _LETTER[128:] = True
_FOLD = ascii_fold().astype(np.uint32)


@dataclass
class Model:
    """Logs of the smoothed counts of (a, b, c), hashed to cells, and of (a, b): cells x languages."""

    languages: list[str]
    cells: np.ndarray
    pairs: np.ndarray


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def words(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the bytes of all words, each with the blank after it: cell, pair; and words' bounds and places.

    ``first`` marks bytes where a text starts.
    """
    inside = _LETTER[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | first[1:]
    end[:-1] &= ~inside[1:] | first[1:]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(1, np.int64), starts
    pieces = -(-(ends - starts) // _RUN)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = np.repeat(starts, pieces) + nth * _RUN
    ends = np.minimum(np.repeat(ends, pieces), starts + _RUN)
    lengths = ends - starts + 1
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    spread = np.arange(bounds[-1]) - np.repeat(bounds[:-1], lengths)
    at = np.minimum(np.repeat(starts, lengths) + spread, len(data) - 1)
    c = _FOLD[data[at]]
    c[bounds[1:] - 1] = _BLANK
    b = np.concatenate([[_BLANK], c[:-1]])
    a = np.where(spread > 0, np.concatenate([[_BLANK], b[:-1]]), _BLANK)
    pair = (a << np.uint32(8)) | b
    cell = (((pair << np.uint32(8)) | c) * np.uint32(2654435761)) >> np.uint32(16)
    return cell.astype(np.int64), pair.astype(np.int64), bounds, starts


def _runs(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(text from, text to, bytes, text starts) in runs of bounded size; a long text comes alone, in several."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _CHUNK, "right")) - 1)
        lo, hi = int(offsets[i]), int(offsets[j])
        while lo < hi:
            cut = min(hi, lo + _CHUNK)
            if cut < hi:  # between words; a run without blanks is cut anywhere
                gaps = np.flatnonzero(~_LETTER[data[lo:cut]])
                cut = lo + int(gaps[-1]) + 1 if len(gaps) else cut
            first = np.zeros(cut - lo, bool)
            if j - i > 1:
                at = offsets[i:j] - lo
                first[at[at < hi - lo]] = True
            yield i, j, data[lo:cut], first
            lo = cut
        i = j


def learn(docs: DataFrame) -> Model:
    """Counts over all texts that have a language and are not held out."""
    import pyarrow as pa

    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    rows = known.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("binary").alias("text"))

    def apply(batches: Iterator) -> Iterator:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            for name in dict.fromkeys(names.tolist()):
                texts = batch.column(1).take(pa.array(np.flatnonzero(names == name)))
                total = counts.setdefault(name, np.zeros((2, CELLS), np.int64))
                for _, _, part, first in _runs(*binary_parts(texts)):
                    cell, pair, _, _ = words(part, first)
                    total[0] += np.bincount(cell, minlength=CELLS)
                    total[1] += np.bincount(pair, minlength=CELLS)
        for name, total in counts.items():
            kind, at = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(kind.astype(np.int32)),
                 pa.array(at.astype(np.int32)), pa.array(total[kind, at])], ["lang", "kind", "at", "n"])

    found = (rows.mapInArrow(apply, "lang string, kind int, at int, n long")
             .groupBy("lang", "kind", "at").agg(F.sum("n").alias("n")).toArrow())  # 131,072 rows a language at most
    names = np.array(found["lang"].to_pylist(), object)
    languages = sorted(set(names.tolist()))
    column = np.array([{x: k for k, x in enumerate(languages)}[x] for x in names.tolist()], np.int64)
    kind, at, n = (found[c].to_numpy() for c in ("kind", "at", "n"))
    counts = np.zeros((2, CELLS, len(languages)))
    counts[kind, at, column] = n
    return Model(languages, np.log(counts[0] + 0.25).astype(np.float32), np.log(counts[1] + 16).astype(np.float32))


def likelihoods(model: Model, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log p(word | language) of all words, and the words' places in ``data``."""
    cell, pair, bounds, starts = words(data, first)
    if not len(starts):
        return np.empty((0, len(model.languages))), starts
    steps = model.cells.take(cell, axis=0)
    steps -= model.pairs.take(pair, axis=0)
    np.minimum(steps, 0, out=steps)
    return np.add.reduceat(steps, bounds[:-1], axis=0).astype(np.float64), starts


# One block of words: p relative to the word's best language, log of that best, the word's document.
Block = tuple[np.ndarray, np.ndarray, np.ndarray]


def _sums(own: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows by document (``own`` rises)."""
    out = np.zeros((n, values.shape[1]))
    if len(own):
        heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        out[own[heads]] = np.add.reduceat(values, heads, axis=0)
    return out


def proportions(blocks: Callable[[], Iterable[Block]], allowed: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation of all documents at once: shares of the allowed languages, and likelihoods."""
    shares = allowed / allowed.sum(1, keepdims=True)
    n, last = len(shares), False
    for step in range(ROUNDS + 1):
        taken, gained = np.zeros_like(shares), np.zeros((n, 1))
        for p, best, own in blocks():
            mixed = p * shares[own]
            whole = mixed.sum(1, keepdims=True)
            gained += _sums(own, np.log(whole) + best[:, None], n)
            if not last:
                taken += _sums(own, mixed / whole, n)
        if last:
            break
        new = taken / sizes[:, None]
        last = step == ROUNDS - 1 or np.abs(new - shares).max(initial=0) < 1e-3
        shares = new
    return shares, gained[:, 0]


def choose(blocks: Callable[[], Iterable[Block]], single: np.ndarray, ceiling: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the chosen languages (documents x languages), and the score of each document.

    ``single`` holds each language's likelihood alone, ``ceiling`` that of the best language word by word.
    """
    n, k = single.shape
    rows = np.arange(n)
    best = single.argmax(1)
    now, shares = single[rows, best].copy(), np.zeros((n, k))
    shares[rows, best] = 1
    posterior = 1 / np.exp(np.maximum(single - now[:, None], -700)).sum(1)
    penalty = PER_WORD * sizes + PER_DOUBLING * np.log2(1 + sizes)
    open_, order = ceiling - now > penalty, None
    for size in range(2, k + 1):
        use = np.flatnonzero(open_)
        if not len(use):
            break
        to = np.full(n, -1)
        to[use] = np.arange(len(use))

        def some():
            for p, top, own in blocks():
                inside = open_[own]
                yield p[inside], top[inside], to[own[inside]]

        if order is None:
            every, _ = proportions(some, np.ones((len(use), k)), sizes[use])
            order = np.zeros((n, k), np.int64)
            order[use] = np.argsort(-every, axis=1, kind="stable")
        allowed = np.zeros((len(use), k))
        np.put_along_axis(allowed, order[use, :size], 1.0, axis=1)
        found, gained = proportions(some, allowed, sizes[use])
        better = gained - now[use] > penalty[use]
        shares[use[better]], now[use[better]] = found[better], gained[better]
        open_ = open_.copy()
        open_[use[~better]] = False
    score = shares.max(1) * np.where((shares > 0).sum(1) > 1, 1.0, posterior)
    return shares, np.clip(score, 0.0, 1.0)


def _block(model: Model, data, first, bounds) -> tuple[np.ndarray, Block]:
    logs, starts = likelihoods(model, data, first)
    top = logs.max(1) if logs.size else np.empty(0)
    own = np.searchsorted(bounds, starts, "right") - 1
    return logs, (np.exp(np.maximum(logs - top[:, None], -60)), top, own)


def infer(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the chosen languages in each text (all zero without a word), and scores."""
    n, k = len(offsets) - 1, len(model.languages)
    shares, scores = np.zeros((n, k)), np.zeros(n)
    if not k:
        return shares, scores
    runs, at = list(_runs(data, offsets)), 0
    while at < len(runs):
        i, j = runs[at][:2]
        until = at + 1
        while until < len(runs) and runs[until][0] == i:
            until += 1
        own_runs, at = runs[at:until], until
        bounds = offsets[i:j] - offsets[i] if j - i > 1 else np.zeros(1, np.int64)
        blocks = (_block(model, part, first, bounds) for _, _, part, first in own_runs)
        held: list[Block] | None = [] if offsets[j] - offsets[i] <= _HELD else None
        single, ceiling, sizes = np.zeros((j - i, k)), np.zeros(j - i), np.zeros(j - i)
        for logs, block in blocks:
            single += _sums(block[2], logs, j - i)
            ceiling += np.bincount(block[2], block[1], j - i)
            sizes += np.bincount(block[2], minlength=j - i)
            if held is not None:
                held.append(block)
        again = (lambda h=held: h) if held is not None else (
            lambda r=own_runs, b=bounds: (_block(model, part, first, b)[1] for _, _, part, first in r))
        has = np.flatnonzero(sizes > 0)
        if len(has) == j - i:
            shares[i:j], scores[i:j] = choose(again, single, ceiling, sizes)
        elif len(has):
            to = np.full(j - i, -1)
            to[has] = np.arange(len(has))
            shares[i + has], scores[i + has] = choose(
                lambda: ((p, t, to[o]) for p, t, o in again()), single[has], ceiling[has], sizes[has])
    return shares, scores


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row a document: doc_id, held_out, lang_pred, score, and the chosen languages with their shares."""
    import pyarrow as pa
    import pyarrow.compute as pc

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    schema = "doc_id long, held_out boolean, lang_pred string, score double, mixture map<string,double>"
    mixture = pa.map_(pa.string(), pa.float64())

    def apply(batches: Iterator) -> Iterator:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                letters = pc.fill_null(pc.match_substring_regex(part.column(2), r"\p{L}"), False).to_numpy(zero_copy_only=False)
                shares, scores = infer(model, *binary_parts(part.column(2).cast(pa.binary())))
                known = letters & (shares.sum(1) > 0)
                shares[~known] = 0
                names = [model.languages[s] if ok else "und" for s, ok in zip(shares.argmax(1) if shares.size else scores.astype(int), known)]
                mixes = [[(model.languages[k], float(s[k])) for k in np.flatnonzero(s)] for s in shares]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(np.where(known, scores, 0.0)),
                     pa.array(mixes, mixture)], ["doc_id", "held_out", "lang_pred", "score", "mixture"])

    return rows.mapInArrow(apply, schema)
