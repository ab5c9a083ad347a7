"""License scans: an exact set-similarity join of text blocks with license templates, and the base phrases.

Words are lower-cased runs of letters, digits and characters beyond ASCII. Blocks are windows of a document's words: for a
template of n words, windows of 2 * 2^ceil(log2 n) words, each beginning half a window after the one before, so every
stretch of n words lies in one block. A block meets a template if it holds at least THRESHOLD of the template's distinct
words. Template words are ordered by their counts over the whole corpus, rarest first; a block can only meet a template
if it holds one of the first |T| - ceil(THRESHOLD * |T|) + 1 (prefix filter), and if the words of that order still to come,
counted from the first one found, are enough (positional filter); a block with fewer words than needed is left out (length
filter). Pairs that stay are counted in full. Licenses share most of their wording, so a block must also hold the
template's naming phrase, the words that tell this license from others, one after the other.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .wordhash import NOT_WORD, words

THRESHOLD = 0.8
#: Base phrases and their labels (fixed values of the contract).
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
_MIT_OPENING = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
_BSD_OPENING = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
_ISC_OPENING = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"
#: Public license texts, whole ("-text"), their openings, and the notices and lines that refer to one (fixed values).
TEMPLATES = {
    "mit-text": _MIT_OPENING
    + ", and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    "The Software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. "
    "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software.",
    "bsd-3-text": _BSD_OPENING
    + ": Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
    "This software is provided by the copyright holders and contributors as is and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. "
    "In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption) "
    "however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage.",
    "isc-text": _ISC_OPENING
    + ". The software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness. "
    "In no event shall the author be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software.",
    "mit": _MIT_OPENING,
    "apache-2.0": "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. You may obtain a copy of the License at www.apache.org/licenses/LICENSE-2.0",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version",
    "bsd": _BSD_OPENING,
    "cc-by-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "isc": _ISC_OPENING,
    "apache-line": "Licensed under the Apache License, Version 2.0",
    "mit-line": "Released under the MIT License",
    "gpl-line": "under the terms of the GNU General Public License",
}
#: Naming phrases; a template without one needs none.
NAMING = {
    "mit-text": "permission is hereby granted free of charge",
    "bsd-3-text": "neither the name of",
    "isc-text": "the author disclaims all warranties",
    "mit": "permission is hereby granted free of charge",
    "apache-2.0": "apache license",
    "gpl-notice": "gnu general public license",
    "bsd": "redistribution and use in source and binary forms",
    "cc-by-notice": "creative commons attribution 4 0",
    "mpl-2.0": "mozilla public license",
    "isc": "permission to use copy modify",
    "apache-line": "apache license",
    "mit-line": "mit license",
    "gpl-line": "gnu general public license",
}


def template_words(text: str) -> np.ndarray:
    return words([text], NOT_WORD, True)[0]


def phrase_places(hashes: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Places where the words of phrase stand one after the other."""
    at = np.flatnonzero(hashes[: max(0, len(hashes) - len(phrase) + 1)] == phrase[0])
    for k in range(1, len(phrase)):
        at = at[hashes[at + k] == phrase[k]]
    return at


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def corpus_counts(docs: DataFrame, vocabulary: np.ndarray) -> dict[int, int]:
    """How often each template word stands in all documents; added up in each task before it is shuffled."""
    known = np.unique(vocabulary)

    def count(batches):
        total = np.zeros(len(known), np.int64)
        for pdf in batches:
            h = words(pdf["text"].tolist(), NOT_WORD, True)[0]
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            total += np.bincount(at[known[at] == h], minlength=len(known))
        yield pd.DataFrame({"word": known.view(np.int64), "n": total})

    rows = _texts(docs).mapInPandas(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()  # as many as template words
    return {int(np.int64(r["word"]).view(np.uint64)): r["n"] for r in rows}


class Join:
    """The templates with their words in the corpus's order, ready to probe blocks."""

    def __init__(self, templates: dict[str, str], counts: dict[int, int], threshold: float, naming: dict[str, str]):
        self.names, self.order, self.need, self.width, self.naming = [], [], [], [], []
        for name, text in templates.items():
            all_words = template_words(text)
            if not len(all_words):
                continue
            distinct = np.array(sorted(set(all_words.tolist()), key=lambda w: (counts.get(w, 0), w)), np.uint64)
            self.names.append(name)
            self.naming.append(template_words(naming.get(name, "")))
            self.order.append(distinct)
            self.need.append(max(1, math.ceil(threshold * len(distinct) - 1e-9)))
            self.width.append(2 << common.bits_for(len(all_words)))
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        for t, (ordered, need) in enumerate(zip(self.order, self.need, strict=True)):
            for place, w in enumerate(ordered[: len(ordered) - need + 1].tolist()):
                self.prefix.setdefault(w, []).append((t, place))
        self.probe = np.array(sorted(self.prefix), np.uint64)

    def blocks(self, doc: np.ndarray, hits: np.ndarray) -> dict[int, float]:
        """Best containment by template among the blocks of a document that meet it; hits: places of prefix words."""
        met: dict[int, float] = {}
        first: dict[tuple[int, int], int] = {}
        for at in hits.tolist():
            for t, place in self.prefix[int(doc[at])]:
                half = self.width[t] // 2
                for block in {max(0, at // half - 1), at // half}:
                    if block * half < max(1, len(doc)):
                        key = (t, block)
                        first[key] = min(first.get(key, place), place)
        for (t, block), place in first.items():
            ordered, need, half = self.order[t], self.need[t], self.width[t] // 2
            if len(ordered) - place < need:  # positional filter: too few words of the order are left
                continue
            part = doc[block * half : block * half + 2 * half]
            if len(part) < need:  # length filter
                continue
            common_words = int(np.isin(ordered, part).sum())
            if common_words >= need and (not len(self.naming[t]) or len(phrase_places(part, self.naming[t]))):
                met[t] = max(met.get(t, 0.0), common_words / len(ordered))
        return met


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD, base: dict[str, str] | None = None, naming: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    A null text counts as empty: no words, no labels, null first_word and last_word, score 0. score is 1 where a base
    phrase stands, else the best containment that met a template, else 0. Rows with the same id are scanned each by
    itself; other columns aren't read; an empty table gives no rows.
    """
    templates, base, naming = TEMPLATES if templates is None else templates, BASE if base is None else base, NAMING if naming is None else naming
    vocabulary = np.concatenate([template_words(t) for t in templates.values()] or [np.zeros(0, np.uint64)])
    counts = corpus_counts(docs, vocabulary) if len(vocabulary) else {}
    phrases = [(template_words(p), label) for p, label in base.items()]

    def probe(batches):
        join = Join(templates, counts, threshold, naming)
        for pdf in batches:
            hashes, first = words(pdf["text"].tolist(), NOT_WORD, True)
            places = []
            for phrase, label in phrases:
                at = phrase_places(hashes, phrase)
                owner = np.searchsorted(first, at, "right") - 1
                inside = at + len(phrase) <= first[owner + 1]
                places += [(int(o), int(a), label) for o, a in zip(owner[inside], at[inside], strict=True)]
            by_doc: dict[int, list[tuple[int, str]]] = {}
            for o, a, label in places:
                by_doc.setdefault(o, []).append((a - int(first[o]), label))
            near = np.flatnonzero(np.isin(hashes, join.probe))
            owners = np.searchsorted(first, near, "right") - 1
            met, cut = {}, np.flatnonzero(np.diff(owners, prepend=-1))
            for a, b in zip(cut, np.append(cut[1:], len(near))[: len(cut)], strict=True):
                o = int(owners[a])
                met[o] = join.blocks(hashes[first[o] : first[o + 1]], near[a:b] - first[o])
            rows = []
            for i, doc_id in enumerate(pdf["doc_id"].tolist()):
                found, best = by_doc.get(i, []), met.get(i, {})
                base_labels = {label for _, label in found}
                labels = base_labels | {join.names[t] for t in best}
                at = [a for a, _ in found]
                rows.append((doc_id, int(first[i + 1] - first[i]), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)), 1.0 if at else max(best.values(), default=0.0)))
            out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
            yield out.astype({k: "Int64" for k in ("doc_id", "first_word", "last_word")})

    return _texts(docs).mapInPandas(probe, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.table(spark, sf_dir, "documents"))


QUERIES = {"op3_license_scan": op3_license_scan}
ORACLES: dict[str, str] = {}
