"""Licence scan by a positional rare-token index.

Templates are licence texts or notices. The index holds, for each template, the positions of its RARE highest-IDF words, as
counted over all documents, and the same for each phrase. A file looks up those of its words that are index keys, rarest
first. Each hit is a posting (template, position) and proposes a base (file position less template position); postings are
intersected by these relative positions:

* a phrase stands where all of its rare words propose the same start, which shrinks with each further word and ends the
  lookup when nothing is left, and where its other words then follow;
* a template is at a base that at least two of its rare words propose (one, if it has no more).

A template counts when it is at a base beside which all of its mandatory phrases are verified, each within SLACK words of its
place. Its coverage is the IDF-weighted share of its words that stand where one of its bases puts them, so a text with
words put in or left out is covered on both sides of them. The score is the best coverage of a template that counts, or
0.5 for a base phrase alone.

Words are runs of characters other than ASCII separators; A-Z are lower-cased, nothing else is.

Defined cases: null text counts as empty; no words: no places, empty labels, score 0, null first and last word; repeated
rows give repeated results; an empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches, only, text_column

#: The phrases that give the base labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


@dataclass(frozen=True)
class Template:
    """label: what it says; text: its wording; key: phrases of the text that must all stand in a file."""

    label: str
    text: str
    key: tuple[str, ...]


#: Short notices, and the wording of licences that are given in full.
TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("gpl-2.0", "this work is licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("all-rights-reserved", "all rights reserved", ("all rights reserved",)),
    Template(
        "mit-text",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
        merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
        to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies
        or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
        ("permission is hereby granted free of charge", "included in all copies or substantial portions of the software"),
    ),
    Template(
        "bsd-2-clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
        disclaimer in the documentation and/or other materials provided with the distribution.""",
        ("redistribution and use in source and binary forms", "redistributions in binary form must reproduce the above copyright notice"),
    ),
    Template(
        "bsd-3-clause",
        """Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
        in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of
        its contributors may be used to endorse or promote products derived from this software without specific prior written permission.""",
        ("redistributions in binary form must reproduce the above copyright notice", "used to endorse or promote products derived from this software without specific prior written permission"),
    ),
    Template(
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
        that the above copyright notice and this permission notice appear in all copies.""",
        ("distribute this software for any purpose with or without fee is hereby granted",),
    ),
    Template(
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
        damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including
        commercial applications, and to alter it and redistribute it freely, subject to the following restrictions""",
        ("in no event will the authors be held liable", "to alter it and redistribute it freely"),
    ),
    Template(
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
        sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial,
        and by any means.""",
        ("free and unencumbered software released into the public domain",),
    ),
    Template(
        "mpl-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with
        this file, You can obtain one at""",
        ("subject to the terms of the mozilla public license",),
    ),
)

RARE, SLACK = 8, 12

#: Separators become spaces, A-Z lower case; bytes of other than ASCII characters stay.
FOLD = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class RareIndex:
    """Postings of the rarest words of phrases and templates. idf: of every word that occurs in them."""

    def __init__(self, idf: dict[bytes, float], base: dict[str, str] = BASE, templates: tuple[Template, ...] = TEMPLATES):
        self.idf, self.templates = idf, templates
        self.base = {tuple(words_of(p.encode())): label for p, label in base.items()}
        self.text = [words_of(t.text.encode()) for t in templates]
        self.keys = [[tuple(words_of(k.encode())) for k in t.key] for t in templates]
        #: of each phrase its rare words, rarest first, with their positions
        self.phrases = {p: self.rarest(list(p)) for p in sorted({*self.base, *(k for keys in self.keys for k in keys)})}
        #: rarest word -> the phrases that are looked up when a file has it
        self.first: dict[bytes, list[tuple[bytes, ...]]] = {}
        for phrase, rare in self.phrases.items():
            self.first.setdefault(rare[0][0], []).append(phrase)
        self.rare = [self.rarest(text) for text in self.text]
        self.lookup = frozenset(w for rare in (*self.phrases.values(), *self.rare) for w, _ in rare)

    def rarest(self, words: list[bytes]) -> list[tuple[bytes, list[int]]]:
        """The RARE words of the highest IDF, each with its positions."""
        at: dict[bytes, list[int]] = {}
        for i, w in enumerate(words):
            at.setdefault(w, []).append(i)
        return sorted(at.items(), key=lambda x: (-self.idf.get(x[0], 0.0), x[1]))[:RARE]

    def places(self, words: list[bytes], hits: dict[bytes, list[int]]) -> dict[tuple[bytes, ...], list[int]]:
        """Start of each place of each phrase, in order."""
        found: dict[tuple[bytes, ...], list[int]] = {}
        for word in sorted(self.first.keys() & hits.keys(), key=lambda w: (-self.idf.get(w, 0.0), w)):
            for phrase in self.first[word]:
                starts: set[int] | None = None
                for w, at in self.phrases[phrase]:
                    for p in at:  # every posting of the word must agree
                        mine = {h - p for h in hits.get(w, ()) if h >= p}
                        starts = mine if starts is None else starts & mine
                    if not starts:
                        break
                if here := sorted(s for s in starts or () if tuple(words[s : s + len(phrase)]) == phrase):
                    found[phrase] = here
        return found

    def bases(self, k: int, hits: dict[bytes, list[int]]) -> list[int]:
        """Where rare words put the start of template k; at least two of them, if it has two."""
        votes: Counter = Counter()
        for w, at in self.rare[k]:
            votes.update({h - p for h in hits.get(w, ()) for p in at})
        least = min(2, len(self.rare[k]))
        return sorted(b for b, n in votes.items() if n >= least)

    def covered(self, words: list[bytes], k: int, hits: dict[bytes, list[int]], found: dict) -> float | None:
        """Coverage of template k; None if it doesn't count."""
        text = self.text[k]
        where = [[i for i in range(len(text) - len(key) + 1) if tuple(text[i : i + len(key)]) == key] for key in self.keys[k]]
        bases = self.bases(k, hits)
        near = lambda b: all(any(abs(s - (b + i)) <= SLACK for i in inside for s in found[key]) for key, inside in zip(self.keys[k], where))
        if not any(near(b) for b in bases):
            return None
        stands = [False] * len(text)
        for b in bases:
            for i in range(max(0, -b), min(len(text), len(words) - b)):
                stands[i] = stands[i] or words[b + i] == text[i]
        weights = [self.idf.get(w, 0.0) + 0.01 for w in text]
        return sum(x for x, y in zip(weights, stands) if y) / sum(weights)

    def scan(self, text: bytes) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score."""
        words = words_of(text)
        hits: dict[bytes, list[int]] = {}
        for w in self.lookup.intersection(words):
            at, hits[w] = -1, []
            for _ in range(words.count(w)):
                at = words.index(w, at + 1)
                hits[w].append(at)
        found = self.places(words, hits)
        if not found:
            return len(words), 0, None, None, "", "", 0.0
        starts = [s for phrase in self.base for s in found.get(phrase, ())]
        base = {label for phrase, label in self.base.items() if phrase in found}
        own = {k: x for k, keys in enumerate(self.keys) if all(key in found for key in keys) and (x := self.covered(words, k, hits, found)) is not None}
        score = max([0.5 * bool(base), *own.values()])
        labels = base | {self.templates[k].label for k in own}
        return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score


def template_words(base: dict[str, str] = BASE, templates: tuple[Template, ...] = TEMPLATES) -> frozenset[bytes]:
    return frozenset(w for text in [*base, *(t.text for t in templates), *(k for t in templates for k in t.key)] for w in words_of(text.encode()))


def document_frequency(texts: DataFrame, vocabulary: frozenset[bytes]) -> tuple[dict[bytes, int], int]:
    """Documents that hold each word of the vocabulary, over all texts, and their number. The vocabulary bounds what is gathered."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                seen[b""] += 1
                seen.update(vocabulary.intersection(words_of(text.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    rows = in_batches(texts.select("text"), count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    held = {bytes(r["word"]): r["n"] for r in rows}
    return held, held.pop(b"", 0)


def license_scan(docs: DataFrame, base: dict[str, str] = BASE, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    texts = only(docs, doc_id="long", text="string").select("doc_id", text_column().cast("binary").alias("text"))
    vocabulary = template_words(base, templates)
    held, n = document_frequency(texts, vocabulary)
    index = RareIndex({w: math.log((n + 1) / (held.get(w, 0) + 1)) for w in vocabulary}, base, templates)
    kinds = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    names = [c.split()[0] for c in kinds.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [index.scan(text.as_py()) for text in batch.column("text")]
            columns = zip(*found) if found else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(list(c), t) for c, t in zip(columns, types))], names)

    return in_batches(texts, work, kinds)
