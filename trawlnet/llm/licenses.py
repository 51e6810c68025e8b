"""Licence texts in documents: winnowed template fingerprints for candidates, banded alignment for coverage and spans."""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from importlib import resources

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawlnet.llm.near_dup import text_parts
from trawlnet.llm.shared import as_text
from trawlnet.llm.words import KEEP, MARKS, buffers, shingle_hashes, word_hashes, word_spans

#: The GNU licences but GPL-3.0, whose notices stand by themselves, and the Creative Commons ones.
GNU = (("GPL", "", "2.0"), ("LGPL", "Lesser ", "2.1"), ("LGPL", "Lesser ", "3.0"), ("LGPL", "Library ", "2.0"), ("AGPL", "Affero ", "3.0"), ("GPL", "", "1.0"))
CC = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
#: Words that tell licences and versions apart; a version's closing zero is often left out.
DECIDING = "mit apache gnu mozilla eclipse boost cc cc0 creative lesser affero nc nd sa noncommercial noderivatives noderivs sharealike".split() + [str(n) for n in range(1, 10)] + ["v1", "v2", "v3"]
#: Templates of more words are whole texts: the words shared decide, and alignments take the fullest diagonals only.
NOTICE_WORDS = 100
#: Public licence notices and paragraphs, by SPDX name.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software'),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *((f"{short}-{v}", f"This work is licensed under the GNU {name}General Public License, version {v.removesuffix('.0')}.") for short, name, v in GNU),
    *((f"{short}-{v}", f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name}General Public License as published by the Free Software Foundation, either version {v.removesuffix('.0')} of the License, or (at your option) any later version.") for short, name, v in GNU if (short, v) != ("GPL", "2.0")),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1"),
    ("EPL-1.0", "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC0-1.0", "This work is licensed under CC0 1.0 Universal."),
    *((f"CC-{kind}-{v}", f"Licensed under CC {kind} {v}.") for v in ("4.0", "3.0") for kind in CC if (kind, v) not in (("BY", "4.0"), ("BY-SA", "4.0"), ("BY-NC", "4.0"))),
    *((f"CC-{kind}-{v}", f"This work is licensed under a Creative Commons {name} {v} {place} License.") for v, place in (("4.0", "International"), ("3.0", "Unported")) for kind, name in CC.items() if (kind, v) != ("BY", "4.0")),
)


def _whole() -> tuple[tuple[str, str], ...]:
    """The whole licence texts of ``license_texts``, from their first word to their last."""
    files = sorted((f for f in resources.files(__package__).joinpath("license_texts").iterdir() if f.name.endswith(".txt")), key=lambda f: f.name)
    return tuple((f.name.removesuffix(".txt"), f.read_text(encoding="utf-8").strip(string.whitespace + string.punctuation)) for f in files)


TEMPLATES = NOTICES + _whole()


@dataclass(frozen=True)
class Licences:
    """Fingerprints are the lowest of ``window`` neighbouring hashes of ``gram`` words, so any ``gram`` + ``window`` - 1
    words shared in a row share one. Alignments allow for ``band`` words more or less, or an eighth of the template.
    Reported are templates of which ``least`` of the words are matched in order."""

    gram: int = 3
    window: int = 3
    band: int = 4
    least: float = 0.8


def _words(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Word hashes of lower-cased texts without punctuation, their byte places, each text's first word, and the bytes."""
    raw, offsets = buffers(column)
    begins, ends = word_spans(raw, offsets, MARKS)
    return word_hashes(raw, begins, ends, KEEP), begins, ends, np.searchsorted(begins, offsets), raw, offsets


def winnow(grams: np.ndarray, window: int) -> np.ndarray:
    """Places of the lowest hash, the last of equals, in each run of ``window``; of fewer hashes the lowest."""
    if len(grams) <= window:
        return np.array([len(grams) - 1 - int(np.argmin(grams[::-1]))]) if len(grams) else np.zeros(0, int)
    views = np.lib.stride_tricks.sliding_window_view(grams, window)[:, ::-1]
    return np.unique(np.arange(len(views)) + window - 1 - views.argmin(axis=1))


class TemplateIndex:
    """Templates as word hashes, and an inverted index from their fingerprints to template and place."""

    def __init__(self, templates: Sequence[tuple[str, str]], spec: Licences):
        self.spec, self.names, self.words = spec, [], []
        self.deciding = np.unique(_words(pa.array(DECIDING, pa.large_string()))[0])
        keys, owners, places = [], [], []
        for name, text in templates:
            words = _words(pc.utf8_lower(pa.array([text], pa.large_string())))[0]
            if not len(words):
                continue
            k = min(spec.gram, len(words))
            if k < spec.gram:
                raise ValueError(f"the template {text!r} has fewer than {spec.gram} words")
            grams = shingle_hashes(words, k)
            chosen = winnow(grams, spec.window)
            keys += grams[chosen].tolist()
            owners += [len(self.words)] * len(chosen)
            places += chosen.tolist()
            self.names.append(name)
            self.words.append(words)
        order = np.argsort(np.array(keys, dtype=np.uint64), kind="stable")
        self.keys = np.array(keys, dtype=np.uint64)[order]
        self.owners, self.places = np.array(owners, dtype=np.int64)[order], np.array(places, dtype=np.int64)[order]
        self.counts = [np.unique(w, return_counts=True) for w in self.words]
        self.bits = np.bincount((self.keys & np.uint64(0xFFFF)).astype(np.int64), minlength=1 << 16) > 0

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the grams that are fingerprints, with template and the template's place for each entry."""
        maybe = np.flatnonzero(self.bits[(grams & np.uint64(0xFFFF)).astype(np.int64)])
        low = np.searchsorted(self.keys, grams[maybe], side="left")
        n = np.searchsorted(self.keys, grams[maybe], side="right") - low
        entry = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(maybe, n), self.owners[entry], self.places[entry]

    def matches(self, words: np.ndarray, at: np.ndarray, owners: np.ndarray, places: np.ndarray) -> list[tuple]:
        """``(score, matched, template, first word, end word)`` of one text, the best where they overlap."""
        found = []
        for template in np.unique(owners).tolist():
            own = self.words[template]
            band = max(self.spec.band, len(own) // 8)
            if len(own) > NOTICE_WORDS and not self._enough(template, words):
                continue
            shifts = np.sort(at[owners == template] - places[owners == template])
            for group in _diagonals(shifts, band, len(own)):
                # hits that drift apart keep the band around their middle
                matched, first, end = align(own, words, int(group[len(group) // 2]), band + int(group[-1] - group[0]))
                if matched >= self.spec.least * len(own) and self._decided(own, words[first:end]):
                    found.append((2 * matched / (len(own) + end - first), matched, template, first, end))
        out: list[tuple] = []
        for hit in sorted(found, key=lambda h: (-h[0] * h[1], h[2], h[3])):
            if not any(hit[3] < o[4] and o[3] < hit[4] for o in out):
                out.append(hit)
        return sorted(out, key=lambda h: h[3])


    def _enough(self, template: int, words: np.ndarray) -> bool:
        """Whether a text has so many of a template's words, in any order, that it may be matched."""
        vocabulary, counts = self.counts[template]
        at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
        have = np.bincount(at[vocabulary[at] == words], minlength=len(vocabulary))
        return np.minimum(have, counts).sum() >= self.spec.least * counts.sum()

    def _decided(self, own: np.ndarray, span: np.ndarray) -> bool:
        """Whether a notice that names a version or variant and the text found agree in all words that decide it."""
        want = np.sort(own[np.isin(own, self.deciding)])
        return len(own) > NOTICE_WORDS or not len(want) or np.array_equal(want, np.sort(span[np.isin(span, self.deciding)]))


def _diagonals(shifts: np.ndarray, band: int, n: int) -> list[np.ndarray]:
    """Groups of sorted shifts to align: those within a band of their neighbours, or of a whole text the fullest bands.

    Bands of a whole text with fewer hits than one for every 100 words are stray phrases.
    """
    if n <= NOTICE_WORDS:
        shifts = np.unique(shifts)
        return np.split(shifts, np.flatnonzero(np.diff(shifts) > band) + 1)
    out = []
    while len(shifts):
        to = np.searchsorted(shifts, shifts + band, side="right")
        a = int(np.argmax(to - np.arange(len(shifts))))
        if to[a] - a < max(2, n // 100):
            break
        middle = shifts[a : to[a]][(to[a] - a) // 2]
        out.append(np.array([middle]))
        shifts = shifts[np.abs(shifts - middle) > band]
    return out


def align(template: np.ndarray, words: np.ndarray, shift: int, band: int) -> tuple[int, int, int]:
    """The longest common subsequence near one diagonal: its length, and the words from its first to past its last.

    Cell (i, c) stands for the words before template place i and text place i + shift - band + c.
    """
    n, width = len(template), 2 * band + 1
    best = np.zeros((n + 1, width), dtype=np.int32)
    for i in range(1, n + 1):
        at = i - 1 + shift - band + np.arange(width)
        inside = (at >= 0) & (at < len(words))
        same = inside & (words[np.clip(at, 0, len(words) - 1)] == template[i - 1])
        above = np.append(best[i - 1, 1:], 0)
        best[i] = np.maximum.accumulate(np.maximum(above, best[i - 1] + same))
    i, c, first, end = n, width - 1, -1, -1
    while i > 0 and best[i, c] > 0:
        at = i - 1 + shift - band + c
        if c > 0 and best[i, c - 1] == best[i, c]:
            c -= 1
        elif c + 1 < width and best[i - 1, c + 1] == best[i, c]:
            i, c = i - 1, c + 1
        elif best[i - 1, c] == best[i, c]:
            i -= 1
        else:
            first, end = at, end if end >= 0 else at + 1
            i -= 1
    return int(best[n, -1]), first, end


def _scanner(index: TemplateIndex):
    """Arrow batches of ``doc_id, text`` to the matches with places in characters."""
    gram = index.spec.gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch, 1):
                # lower-casing may change a character's bytes, so characters are counted in the folded text
                folded = pc.utf8_lower(part.column(1).cast(pa.large_string()).fill_null(""))
                words, begins, ends, bounds, raw, offsets = _words(folded)
                at, owners, places = index.hits(shingle_hashes(words, gram))
                texts = np.searchsorted(bounds, at, side="right") - 1
                inside = at + gram <= bounds[texts + 1]
                at, owners, places, texts = at[inside], owners[inside], places[inside], texts[inside]
                rows, found = [], []
                for text in np.unique(texts).tolist():
                    a, b, own = bounds[text], bounds[text + 1], texts == text
                    head = int(offsets[text])
                    for score, matched, template, first, end in index.matches(words[a:b], at[own] - a, owners[own], places[own]):
                        low, high = int(begins[a + first]), int(ends[a + end - 1])
                        start = int(((raw[head:low] & 0xC0) != 0x80).sum())
                        rows.append(text)
                        found.append((index.names[template], template, matched / len(index.words[template]), start, start + int(((raw[low:high] & 0xC0) != 0x80).sum()), score))
                made = [part.column(0).take(pa.array(rows, pa.int64()))]
                kinds = (pa.string(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.float64())
                made += [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
                yield pa.record_batch(made, names=["doc_id", "licence", "template", "coverage", "start", "end", "score"])

    return run


def licence_matches(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, spec: Licences = Licences(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, licence, template, coverage, start, end, score`` for every licence text found in ``docs``.

    Texts are lower-cased; white space and ASCII punctuation separate words. Fingerprint hits on one template near one
    diagonal are aligned within a band: ``coverage`` is the share of the template's words matched in order, ``start``
    and ``end`` span them in characters, ``score`` also counts the words in between. Of matches that overlap the one
    with most matched words, weighed by score, is given, and of equals the earlier template.

    Templates are a short list that the caller holds and go with the code; documents stay where they are. Null and
    empty texts match nothing; null ids are kept; repeated rows are each reported; blank templates are skipped and
    those shorter than a gram refused; other columns are ignored; an empty table gives no rows.
    """
    index = TemplateIndex(templates, spec)
    texts = docs.select(F.col(id_col).alias("doc_id"), as_text(F.col(text_col)).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return texts.mapInArrow(
        _scanner(index), f"doc_id {kind}, licence string, template int, coverage double, start long, end long, score double"
    )
