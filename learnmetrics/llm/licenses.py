"""Licence scans by a positional rare-token index.

The index holds, for the rarest words of every licence notice, the notices and positions where
they stand; a corpus pass counts in how many documents each licence word occurs. A scan then
looks up the rarest licence words of each file and lets every occurrence vote for (notice,
start = place - position). Votes whose starts lie within the notice's tolerance of each other
belong together (a few words put in or left out move what follows); where enough rare words
agree, each mandatory key phrase must stand, word by word, at its own offset from there, give
or take the tolerance, and the notice's words must be there by weight. Base phrases are found
wherever their words stand one after the other.

Defined results
* null or empty text: no words, no places, empty labels, score 0;
* a very long text is scanned whole, at every place;
* ties between words of equal frequency go to the one that sorts first; of several places of
  one notice the best counts; a file with a base phrase has score 1;
* rows sharing an id are scanned row by row; other columns aren't read; an empty table gives
  an empty table.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnmetrics.llm.common import table, text_slices
from learnmetrics.llm.shingles import text_bytes, word_bounds, word_hashes

#: Base phrases and their labels (fixed values).
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: (label, text, mandatory key phrases): notices as they are usually worded (fixed values).
#: Phrases are parts of the text.
_GPL_HEADER = (
    "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} General Public License "
    "as published by the Free Software Foundation, {2}"
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_CC = "This work is licensed under a Creative Commons Attribution{} 4.0 International License"
TEMPLATES = [
    ("agpl-3.0", _GPL_HEADER.format("program", "Affero", "either version 3 of the License"), ["gnu affero general public license", "version 3 of the license"]),
    ("agpl-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", ["gnu affero general public license version 3"]),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ["apache license version 2 0"]),
    (
        "apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        ["apache license version 2 0", "except in compliance with the license"],
    ),
    ("apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/", ["apache license version 2 0 january 2004"]),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        ["redistribution and use in source and binary forms", "conditions are met"],
    ),
    ("bsd-2-clause", _BSD, ["redistribution and use in source and binary forms", "redistributions in binary form must reproduce the above copyright notice"]),
    (
        "bsd-3-clause",
        _BSD + " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
        ["redistributions in binary form must reproduce the above copyright notice", "endorse or promote products derived from this software"],
    ),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0", ["boost software license version 1 0"]),
    ("cc-by-4.0", _CC.format(""), ["creative commons attribution 4 0"]),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ["cc by nc 4 0"]),
    ("cc-by-nc-4.0", _CC.format("-NonCommercial"), ["attribution noncommercial 4 0"]),
    ("cc-by-nc-sa-4.0", _CC.format("-NonCommercial-ShareAlike"), ["attribution noncommercial sharealike 4 0"]),
    ("cc-by-nd-4.0", _CC.format("-NoDerivatives"), ["attribution noderivatives 4 0"]),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ["cc by sa 4 0"]),
    ("cc-by-sa-4.0", _CC.format("-ShareAlike"), ["attribution sharealike 4 0"]),
    ("cc0-1.0", "CC0 1.0 Universal (CC0 1.0) Public Domain Dedication", ["cc0 1 0 universal"]),
    ("gpl-2.0", _GPL_HEADER.format("program", "", "either version 2 of the License"), ["gnu general public license", "version 2 of the license"]),
    ("gpl-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", ["gnu general public license version 2 june 1991"]),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2", ["gnu general public license version 2"]),
    ("gpl-3.0", _GPL_HEADER.format("program", "", "either version 3 of the License"), ["gnu general public license", "version 3 of the license"]),
    ("gpl-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", ["gnu general public license version 3 29 june 2007"]),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", ["gnu general public license version 3"]),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
        ["distribute this software for any purpose with or without fee is hereby granted", "appear in all copies"],
    ),
    ("lgpl-2.1", _GPL_HEADER.format("library", "Lesser", "either version 2.1 of the License"), ["gnu lesser general public license", "version 2 1 of the license"]),
    ("lgpl-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", ["gnu lesser general public license version 2 1"]),
    ("lgpl-3.0", _GPL_HEADER.format("library", "Lesser", "either version 3 of the License"), ["gnu lesser general public license", "version 3 of the license"]),
    ("lgpl-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", ["gnu lesser general public license version 3"]),
    ("mit", "Released under the MIT License", ["the mit license"]),
    ("mit", "This software is licensed under the terms of the MIT License", ["terms of the mit license"]),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        ["permission is hereby granted free of charge", "without restriction", "publish distribute sublicense"],
    ),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
        ["permission is hereby granted free of charge", "without restriction"],
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
        ["subject to the terms of the mozilla public license v 2 0", "a copy of the mpl was not distributed"],
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ["mozilla public license v 2 0"]),
    ("mpl-2.0", "Mozilla Public License Version 2.0", ["mozilla public license version 2 0"]),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software",
        ["free and unencumbered software released into the public domain"],
    ),
    (
        "zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
        "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose",
        ["provided as is without any express or implied warranty", "permission is granted to anyone to use this software"],
    ),
]
#: Rarest distinct licence words of a file that are looked up, besides the rarest key word of
#: each notice, which always is; rarest words of a notice that are listed in the index; words that
#: must agree on a start, where so many were looked up; share of a notice's words, by weight.
RARE_WORDS = 16
LISTED = 12
AGREE = 3
COVERED = 0.7


def tolerance(words: int) -> int:
    """Places by which parts of a notice of so many words may be moved against each other."""
    return 2 + words // 8


IN_WORD = np.zeros(256, dtype=bool)
IN_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def words_of(text: str) -> list[str]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def _hash_of(words: list[str]) -> np.ndarray:
    data, bounds = text_bytes(pa.array(words, pa.string()))
    return word_hashes(data, bounds[:-1], bounds[1:])


class Index:
    """Word numbers of the licence vocabulary, base phrases, notices and their key phrases."""

    def __init__(self, templates: list, base: dict[str, str]):
        self.labels = [label for label, _, _ in templates]
        texts = [words_of(text) for _, text, _ in templates]
        self.vocabulary = sorted({w for ws in texts for w in ws} | {w for p in base for w in words_of(p)})
        number = {w: i for i, w in enumerate(self.vocabulary)}
        hashes = _hash_of(self.vocabulary)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.sequences = [np.array([number[w] for w in ws]) for ws in texts]
        self.base = [(label, np.array([number[w] for w in words_of(p)])) for p, label in base.items()]
        #: Per notice: (offset, words) of its mandatory phrases, their words, the tolerance.
        self.phrases = []
        for ws, (_, _, phrases) in zip(texts, templates, strict=True):
            found = []
            for part in map(words_of, phrases):
                at = next(i for i in range(len(ws)) if ws[i : i + len(part)] == part)
                found.append((at, np.array([number[w] for w in part])))
            self.phrases.append(found)
        self.key_words = [{int(w) for _, part in found for w in part} for found in self.phrases]
        self.slack = [tolerance(len(s)) for s in self.sequences]

    def listed(self, rank: np.ndarray) -> list[list[tuple[int, int]]]:
        """Postings: word number -> [(notice, position)], of the ``LISTED`` words of each notice that
        are rarest in the corpus, and of its rarest key word."""
        postings: list[list[tuple[int, int]]] = [[] for _ in self.vocabulary]
        for t, sequence in enumerate(self.sequences):
            rare = sorted(set(sequence.tolist()), key=lambda w: rank[w])[:LISTED]
            rare = {*rare, min(self.key_words[t], key=lambda w: rank[w])}
            for position, w in enumerate(sequence.tolist()):
                if w in rare:
                    postings[w].append((t, position))
        return postings

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary number of every word, -1 for other words."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)


def _numbered(index: Index, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(vocabulary number of every word of every text, offset of every text's first word)."""
    data, bounds = text_bytes(texts)
    starts, ends, first = word_bounds(data, bounds, IN_WORD)
    return index.numbers(word_hashes(data, starts, ends)), first


def document_frequencies(docs: DataFrame, index: Index) -> tuple[np.ndarray, int]:
    """(documents that hold each vocabulary word, documents), over all of ``docs``."""
    size = len(index.vocabulary)

    def run(batches):
        counts, rows = np.zeros(size, np.int64), 0
        for _, texts in text_slices(batches, "text"):
            numbers, first = _numbered(index, texts)
            row = np.repeat(np.arange(len(texts)), np.diff(first))
            held = numbers >= 0
            pairs = np.unique(row[held] * size + numbers[held])
            counts += np.bincount(pairs % size, minlength=size)
            rows += len(texts)
        words = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(words, -1)), pa.array(np.append(counts[words], rows))], names=["word", "n"])

    partial = docs.select("text").mapInArrow(run, "word long, n long")
    found = dict(partial.groupBy("word").agg(F.sum("n")).collect())  # a row for each vocabulary word at most
    return np.array([found.get(w, 0) for w in range(size)], dtype=np.int64), found.get(-1, 0)


def _stands(numbers: np.ndarray, phrase: np.ndarray, low: int, high: int) -> bool:
    """The phrase begins at a place from ``low`` to ``high``."""
    low, high = max(0, low), min(high, len(numbers) - len(phrase))
    at = low + np.flatnonzero(numbers[low : high + 1] == phrase[0]) if high >= low else np.zeros(0, np.int64)
    return any(np.array_equal(numbers[i : i + len(phrase)], phrase) for i in at.tolist())


def _matches(index: Index, postings: list, numbers: np.ndarray, looked: np.ndarray, idf: np.ndarray) -> dict[int, float]:
    """Notice -> weighted share of its words in place, of the notices verified in one text.

    ``numbers`` are the text's words, ``looked`` the places of the words looked up.
    """
    votes: dict[int, list[tuple[int, int]]] = {}
    for place in looked.tolist():
        word = int(numbers[place])
        for template, position in postings[word]:
            votes.setdefault(template, []).append((place - position, word))
    known = set(numbers[looked].tolist())
    found: dict[int, float] = {}
    for template, starts in votes.items():
        starts.sort()
        sequence, slack = index.sequences[template], index.slack[template]
        listed = {w for w in set(sequence.tolist()) & known if any(t == template for t, _ in postings[w])}
        need = min(AGREE, len(listed))
        weight = idf[np.unique(sequence)].sum()
        first = 0
        for last, (start, _) in enumerate(starts):
            while starts[first][0] < start - slack:
                first += 1
            # Judged at the last of a run of votes that belong together.
            if last + 1 < len(starts) and starts[last + 1][0] <= starts[first][0] + slack:
                continue
            if len({w for _, w in starts[first : last + 1]}) < need:
                continue
            low, high = start - slack, starts[first][0] + slack
            if not all(_stands(numbers, phrase, low + at, high + at) for at, phrase in index.phrases[template]):
                continue
            there = np.intersect1d(sequence, numbers[max(0, low) : max(0, high) + len(sequence)])
            share = float(idf[there].sum() / weight)
            if share >= COVERED:
                found[template] = max(found.get(template, 0.0), min(1.0, share))
    return found


def scan(docs: DataFrame, text: str = "text", doc: str = "doc_id", templates: list | None = None, base: dict | None = None) -> DataFrame:
    """(doc, n_words, n_base, first_word, last_word, base_labels, labels, score).

    Two passes over the texts, no shuffle of rows: the corpus frequencies of the licence
    words (a count per word), then the scan itself, task by task.
    """
    index = Index(templates or TEMPLATES, base or BASE)
    docs = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    frequency, rows = document_frequencies(docs, index)
    idf = np.log((rows + 1) / (frequency + 1)) + 1e-6
    rank = np.empty(len(idf), dtype=np.int64)
    rank[np.lexsort((np.arange(len(idf)), -idf))] = np.arange(len(idf))
    # Without the rarest word of its mandatory phrases, a template can't be verified.
    anchors = np.array(sorted({min(words, key=lambda w: rank[w]) for words in index.key_words}))
    postings = index.listed(rank)

    def run(batches):
        for batch, texts in text_slices(batches, "text"):
            numbers, first = _numbered(index, texts)
            count = len(texts)
            row_of = np.repeat(np.arange(count), np.diff(first))
            n_base = np.zeros(count, np.int64)
            low, high = np.full(count, np.iinfo(np.int64).max), np.full(count, -1)
            base_labels = [set() for _ in range(count)]
            for label, phrase in index.base:
                at = np.flatnonzero(numbers == phrase[0])
                at = at[at + len(phrase) <= first[row_of[at] + 1]]
                for j, word in enumerate(phrase[1:].tolist(), 1):
                    at = at[numbers[at + j] == word]
                rows_hit = row_of[at]
                n_base += np.bincount(rows_hit, minlength=count)
                np.minimum.at(low, rows_hit, at - first[rows_hit])
                np.maximum.at(high, rows_hit, at - first[rows_hit])
                for r in np.unique(rows_hit).tolist():
                    base_labels[r].add(label)
            labels, scores = [set(x) for x in base_labels], np.zeros(count)
            held = np.flatnonzero(numbers >= 0)
            for r in np.unique(row_of[held[np.isin(numbers[held], anchors)]]).tolist():
                own = numbers[first[r] : first[r + 1]]
                places = held[np.searchsorted(held, first[r]) : np.searchsorted(held, first[r + 1])] - first[r]
                words = np.unique(own[places])
                looked = np.union1d(words[np.argsort(rank[words])][:RARE_WORDS], np.intersect1d(words, anchors))
                for template, share in _matches(index, postings, own, places[np.isin(own[places], looked)], idf).items():
                    labels[r].add(index.labels[template])
                    scores[r] = max(scores[r], share)
            scores[n_base > 0] = 1.0
            none = n_base == 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(first)),
                    pa.array(n_base),
                    pa.array(low, mask=none),
                    pa.array(high, mask=none),
                    pa.array([",".join(sorted(x)) for x in base_labels]),
                    pa.array([",".join(sorted(x)) for x in labels]),
                    pa.array(scores),
                ],
                names=[doc, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    long, string = T.LongType(), T.StringType()
    kinds = [("n_words", long), ("n_base", long), ("first_word", long), ("last_word", long), ("base_labels", string), ("labels", string), ("score", T.DoubleType())]
    schema = T.StructType([T.StructField(doc, docs.schema["doc"].dataType), *(T.StructField(n, k) for n, k in kinds)])
    return docs.mapInArrow(run, schema)


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
