"""License scans by a positional index of rare words.

License notices are templates. A first pass counts in how many documents each
template word occurs. In the second, a text's most informative words of a
template (highest inverse document frequency) look up their places in the
template; the place in the text less the place in the template is where the
template would begin, and beginnings that several words agree on are candidate
places. A candidate holds if the template's mandatory phrases stand there, and
its score is the share of the template's words found in place. A template is
only skipped where one of its mandatory words does not occur at all, which no
accepted place could lack.

Phrases of three licenses are found by themselves, wherever they stand; the
templates add labels, and take none away.

Null and empty texts have no words; very long texts are scanned whole; of
equal scores of one label any place counts, as only the score is given; repeated
rows are each scanned; an empty table gives no rows; columns besides doc_id and
text are not read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import documents, map_batches, texts

RARE_WORDS = 8
SLACK = 3
MIN_SHARE = 0.7

# The phrases that are found by themselves.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

PHRASE_ENDS = {phrase.encode().split()[-1] for phrase in PHRASES}

#: label, notice, and phrases that must stand in it.
NOTICES = [
    *((label, phrase, [phrase]) for phrase, label in PHRASES.items()),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
        ["permission is hereby granted free of charge", "without restriction"],
    ),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ["apache license", "version 2 0"]),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License",
        ["apache license version 2 0", "in compliance with the license"],
    ),
    ("gpl-3.0", "GNU General Public License, version 3", ["gnu general public license", "version 3"]),
    ("gpl-2.0", "GNU General Public License, version 2", ["gnu general public license", "version 2"]),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
        ["free software", "gnu general public license", "free software foundation"],
    ),
    ("lgpl", "GNU Lesser General Public License", ["lesser general public license"]),
    ("agpl", "GNU Affero General Public License", ["affero general public license"]),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        ["redistribution and use in source and binary forms", "conditions are met"],
    ),
    ("bsd", "Licensed under the BSD 3-Clause License", ["bsd 3 clause license"]),
    ("bsd", "Licensed under the BSD 2-Clause License", ["bsd 2 clause license"]),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ["mozilla public license", "2 0"],
    ),
    ("cc-by-4.0", "Licensed under CC BY 4.0", ["cc by 4 0"]),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ["cc by sa 4 0"]),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ["cc by nc 4 0"]),
    ("cc-by", "Creative Commons Attribution 4.0 International License", ["creative commons attribution"]),
    ("cc0", "Released under CC0 1.0 Universal", ["cc0 1 0"]),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted",
        ["permission to use copy modify and or distribute this software", "with or without fee"],
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain",
        ["free and unencumbered software", "public domain"],
    ),
    ("proprietary", "All rights reserved. Proprietary and confidential", ["proprietary and confidential"]),
]

#: Lower case for A-Z; every other byte outside words becomes a space.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(FOLD).split()


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    places: dict
    phrases: tuple[tuple[bytes, ...], ...]
    needed: frozenset


def templates(notices: list = NOTICES) -> list[Template]:
    out = []
    for label, notice, phrases in notices:
        words = tuple(words_of(notice))
        places = defaultdict(list)
        for i, word in enumerate(words):
            places[word].append(i)
        cut = tuple(tuple(words_of(p)) for p in phrases)
        out.append(Template(label, words, dict(places), cut, frozenset(w for p in cut for w in p)))
    return out


def stands_at(words: list[bytes], phrase: tuple, low: int, high: int) -> bool:
    """Whether ``phrase`` begins at a place of words[low:high]."""
    n = len(phrase)
    return any(tuple(words[i : i + n]) == phrase for i in range(max(0, low), min(high, len(words) - n + 1)))


def share_in_place(words: list[bytes], template: Template, begin: int) -> float:
    """Share of the template's words that stand within SLACK of their place."""
    hits = 0
    for i, word in enumerate(template.words):
        at = begin + i
        hits += word in words[max(0, at - SLACK) : max(0, at + SLACK + 1)]
    return hits / len(template.words)


def scan(words: list[bytes], places: dict, template: Template, idf: dict) -> float:
    """Best score of the template over all its places in the text, or 0."""
    if not template.needed <= places.keys():
        return 0.0
    rare = sorted((w for w in template.places if w in places), key=lambda w: (-idf.get(w, math.inf), w))[:RARE_WORDS]
    votes: dict[int, set] = defaultdict(set)
    for word in rare:
        for begin in {at - q for at in places[word] for q in template.places[word]}:
            votes[begin].add(word)
    least = min(2, len(rare))
    best = 0.0
    for begin, agreeing in votes.items():
        near = set(agreeing).union(*(votes.get(begin + d, ()) for d in range(1, SLACK + 1)))
        if len(near) < least:
            continue
        share = share_in_place(words, template, begin)
        if share >= MIN_SHARE and share > best:
            end = begin + len(template.words) + SLACK
            if all(stands_at(words, p, begin - SLACK, end) for p in template.phrases):
                best = share
    return best


def base_places(words: list[bytes]) -> tuple[list[int], list[str]]:
    """Starts of all phrases found by themselves, and their labels, whatever the
    notices are."""
    starts, labels = [], []
    for phrase, label in PHRASES.items():
        wanted = phrase.encode().split()
        n = len(wanted)
        ends = [i + 1 for i, word in enumerate(words) if word == wanted[-1]]
        found = [end - n for end in ends if end >= n and words[end - n : end] == wanted]
        if found:
            starts += found
            labels.append(label)
    return starts, sorted(labels)


def scan_text(text: str, known: list[Template], vocabulary: frozenset, idf: dict) -> dict:
    words = words_of(text)
    present = vocabulary.intersection(words)
    starts, base = base_places(words) if any(end in words for end in PHRASE_ENDS) else ([], [])
    found: dict[str, float] = {}
    if any(t.needed <= present for t in known):
        places = defaultdict(list)
        for i, word in enumerate(words):
            if word in present:
                places[word].append(i)
        for template in known:
            score = scan(words, places, template, idf)
            if score:
                found[template.label] = max(score, found.get(template.label, 0.0))
    return {
        "n_words": len(words),
        "n_base": len(starts),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(base),
        "labels": ",".join(sorted({*base, *found})),
        "score": max([1.0] * bool(base) + list(found.values()), default=0.0),
    }


def document_frequencies(docs: DataFrame, vocabulary: frozenset) -> tuple[dict, int]:
    """In how many documents each word of ``vocabulary`` occurs, and how many
    documents there are. One partial row per word and task; the vocabulary
    bounds what is collected."""

    def make():
        counts: Counter = Counter()

        def step(rows):
            for text in rows["text"]:
                counts.update(vocabulary.intersection(words_of(text)))
            counts[b""] += len(rows["text"])
            return ()

        def finish():
            yield {"word": list(counts), "n": list(counts.values())}

        step.finish = finish
        return step

    partial = map_batches(texts(docs).select("text"), make, "word binary, n bigint")
    found = {bytes(r["word"]): r["n"] for r in partial.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return found, found.pop(b"", 0)


def license_scan(docs: DataFrame, notices: list = NOTICES) -> DataFrame:
    known = templates(notices)
    vocabulary = frozenset(w for t in known for w in t.words)
    counts, total = document_frequencies(docs, vocabulary)
    idf = {w: math.log((total + 1) / (counts.get(w, 0) + 1)) for w in vocabulary}

    def make():
        def step(rows):
            found = [scan_text(text, known, vocabulary, idf) for text in rows["text"]]
            yield {"doc_id": rows["doc_id"], **{k: [f[k] for f in found] for k in found[0]}}

        return step

    columns = (
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double"
    )
    return map_batches(texts(docs), make, columns)


def op5_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan(documents(spark, sf))
