"""Licence scans with a generalised suffix automaton over the words of licence templates.

Words are runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased.  The
automaton of all templates is built once (templates are a bounded parameter).  Each whole text is
streamed through it: the matching statistics give, for every word, the longest template passage that
ends there.  Matches of at least ``MIN_MATCH`` words are chained per template, in order and with
bounded gaps; a chain that covers enough of its template is a span with the template's label.  Runs
of words that no template has are skipped by array operations, as they reset the automaton.

Besides, ``base`` phrases are found at all places where their words stand consecutively.

Null, empty and wordless texts have no word, no label and score 0.  Repeated rows are scanned each;
an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from roadsight.llm.common import WordHasher, ascii_fold, binary_parts

MIN_MATCH, MAX_GAP, MIN_COVER = 3, 6, 0.6

# fixed values: base phrases and labels
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# fixed values: public licence notices
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", "Released under the MIT License."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
               "with the License. You may obtain a copy of the License at"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl", "GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]


def _is_word() -> np.ndarray:
    keep = np.zeros(256, bool)
    keep[48:58] = keep[65:91] = keep[97:123] = keep[128:] = True
    return keep


def split_words(text: str) -> list[str]:
    keep, fold = _is_word(), ascii_fold()
    return bytes(int(fold[b]) if keep[b] else 32 for b in text.encode()).decode().split()


class Automaton:
    """Generalised suffix automaton: states are sets of end places of template passages."""

    def __init__(self, templates: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        for t, words in enumerate(templates):
            last = 0
            for place, word in enumerate(words):
                last = self._extend(last, word, ends)
                ends[last].add((t, place))
        self.own_ends, self.below = [sorted(e) for e in ends], [[] for _ in self.link]
        for state, link in enumerate(self.link):
            if link >= 0:
                self.below[link].append(state)

    def ends(self, state: int) -> list[tuple[int, int]]:
        """All (template, place) where the state's passages end: its own and those of the link tree below it."""
        found, work = [], [state]
        while work:
            at = work.pop()
            found += self.own_ends[at]
            work += self.below[at]
        return found

    def _new(self, length: int, ends, follow=None) -> int:
        self.next.append(dict(follow or {}))
        self.link.append(0)
        self.length.append(length)
        ends.append(set())
        return len(self.link) - 1

    def _split(self, state: int, word: int, ends) -> int:
        """The target of ``state`` on ``word``, split so that its longest passage is state's plus the word."""
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        clone = self._new(self.length[state] + 1, ends, self.next[target])
        self.link[clone], self.link[target] = self.link[target], clone
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, word: int, ends) -> int:
        if word in self.next[last]:
            return self._split(last, word, ends)
        new, state = self._new(self.length[last] + 1, ends), last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        self.link[new] = self._split(state, word, ends) if state >= 0 else 0
        return new

    def statistics(self, words: list[int]):
        """For each word: state and length of the longest template passage that ends there."""
        state = size = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state, size = self.next[state][word], size + 1
            yield state, size


class Scanner:
    def __init__(self, templates=tuple(TEMPLATES), base=tuple(BASE.items())):
        self.labels = [label for label, _ in templates]
        texts = [split_words(text) for _, text in templates]
        phrases = [(split_words(phrase), label) for phrase, label in base]
        names = sorted({w for t in texts for w in t} | {w for p, _ in phrases for w in p})
        self.hasher = WordHasher(_is_word(), ascii_fold())
        raw = [n.encode() for n in names]
        hashes, _ = self.hasher.texts(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
        order = np.argsort(hashes)
        self.known, number = hashes[order], {names[o]: i for i, o in enumerate(order)}
        self.automaton = Automaton([[number[w] for w in t] for t in texts])
        self.sizes = [len(t) for t in texts]
        self.phrases = [(np.array([number[w] for w in p]), label) for p, label in phrases]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Template word numbers of word hashes, -1 for all other words."""
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, at, -1)

    def base_places(self, words: np.ndarray) -> list[tuple[int, str]]:
        found = []
        for phrase, label in self.phrases:
            n = len(words) - len(phrase) + 1
            if n > 0:
                ok = np.ones(n, bool)
                for k, w in enumerate(phrase):
                    ok &= words[k:n + k] == w
                found += [(int(i), label) for i in np.flatnonzero(ok)]
        return found

    def matches(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """Maximal passages (start, length, state) of at least ``MIN_MATCH`` words."""
        inside = np.concatenate([[False], words >= 0, [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        found = []
        for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if hi - lo < MIN_MATCH:
                continue
            before = (0, 0)
            for i, (state, size) in enumerate(self.automaton.statistics(words[lo:hi].tolist()), lo):
                if size <= before[1] and before[1] >= MIN_MATCH:
                    found.append((i - before[1], before[1], before[0]))
                before = (state, size)
            if before[1] >= MIN_MATCH:
                found.append((hi - before[1], before[1], before[0]))
        return found

    def spans(self, words: np.ndarray) -> list[tuple[str, int, int, float]]:
        """Chained spans (label, first word, past the last word, share of the template covered)."""
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for start, size, state in self.matches(words):
            for t, end in self.automaton.ends(state):
                by_template.setdefault(t, []).append((start, end - size + 1, size))
        return [(self.labels[t], first, past, covered / self.sizes[t])
                for t, found in sorted(by_template.items()) for first, past, covered in chains(found)]


def chains(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The best chain of matches (start, place, size) of one template, then the best ones on either side of it.

    In a chain every match goes on behind the one before, in the text and in the template, at most
    ``MAX_GAP`` words later in the text; where two overlap, the later counts without the shared words.
    Chains are (first word, past the last word, template words covered), in order.
    """
    out, work = [], [sorted(set(found))]
    while work:
        run = work.pop()
        if not run:
            continue
        first, past, covered = best_chain(run)
        out.append((first, past, covered))
        work.append([m for m in run if m[0] + m[2] <= first])
        work.append([m for m in run if m[0] >= past])
    return sorted(out)


def best_chain(run: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """Dynamic programming over matches by start: the most covered words, then the earliest chain."""
    run = sorted(run)
    longest = max(size for _, _, size in run)
    best: list[tuple[int, int]] = []  # covered words and first word (negative) of the best chain that ends here
    for i, (start, place, size) in enumerate(run):
        own = (size, -start)
        for k in range(i - 1, -1, -1):
            start_k, place_k, size_k = run[k]
            if start_k + longest + MAX_GAP < start:
                break
            end, place_end = start_k + size_k, place_k + size_k
            if start > end + MAX_GAP or place < place_k or start + size <= end or place + size <= place_end:
                continue
            new = size - max(0, end - start, place_end - place)
            if new > 0:
                own = max(own, (best[k][0] + new, best[k][1]))
        best.append(own)
    at = max(range(len(run)), key=lambda i: (best[i][0], best[i][1], -run[i][0]))
    return -best[at][1], run[at][0] + run[at][2], best[at][0]


SCAN = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, spans array<struct<label:string,first:long,past:long,cover:double>>")


def scan(docs: DataFrame, templates=tuple(TEMPLATES), base=tuple(BASE.items())) -> DataFrame:
    """One row a document: word count, base phrases, labels, score and covered spans."""
    import pyarrow as pa

    span_type = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("past", pa.int64()), ("cover", pa.float64())]))

    def row(scanner, doc_id, words):
        places = scanner.base_places(words)
        spans = scanner.spans(words)
        kept = [s for s in spans if s[3] >= MIN_COVER]
        low = {label for _, label in places}
        high = max([s[3] for s in spans], default=0.0)
        return (doc_id, len(words), len(places), min(places)[0] if places else None, max(places)[0] if places else None,
                ",".join(sorted(low)), ",".join(sorted(low | {s[0] for s in kept})), max(high, 0.5) if low else high,
                [dict(zip(("label", "first", "past", "cover"), s)) for s in kept])

    shared = docs.sparkSession.sparkContext.broadcast(Scanner(templates, base))  # built once; as large as the templates

    def apply(batches):
        scanner = shared.value
        names = [f.split()[0] for f in SCAN.split(", ")]
        types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), span_type]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                data, offsets = binary_parts(part.column(1))
                hashes, counts = scanner.hasher.texts(data, offsets)
                words, bounds = scanner.numbers(hashes), np.concatenate([[0], np.cumsum(counts)])
                rows = [row(scanner, d, words[lo:hi]) for d, lo, hi in zip(part.column(0).to_pylist(), bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(apply, SCAN)
