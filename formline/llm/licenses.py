"""Licence notices in texts: an exact containment join of text blocks with templates, and fixed phrases."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.texts import ALNUM_BYTES, LOWER, hashed_words, slices, text_bytes

# Fixed phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# Widely used notices, in their usual words.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
            " documentation files, to deal in the Software without restriction"),
    ("mit", "Released under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
            " License as published by the Free Software Foundation"),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
            " the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
)
# Share of a template's distinct words that a block has to hold; of fewer than SHORT words, all.
THRESHOLD, SHORT = 0.8, 10

RESULT = ("struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base_labels:string,labels:string,score:double,"
          "blocks:array<struct<label:string,start:bigint,end:bigint,containment:double,inside:boolean>>>")
_RESULT = pa.struct([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
    ("labels", pa.string()), ("score", pa.float64()),
    ("blocks", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64()), ("inside", pa.bool_())])))])


def words_of(text: str) -> list[str]:
    """Runs of letters, digits and everything outside ASCII, A-Z lower-cased."""
    lowered = text.translate({c: c + 32 for c in range(0x41, 0x5B)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def hashes_of(words: Sequence[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    with np.errstate(over="ignore"):
        return hashed_words(data, np.array([0, len(data)]), ALNUM_BYTES)[0]


@dataclass
class Template:
    label: str
    tokens: list[int]  # distinct words as vocabulary numbers, rarest first
    width: int  # words of the notice, repeats counted
    needed: int  # distinct words that a block has to share
    prefix: frozenset[int] = field(default_factory=frozenset)
    sequence: list[int] = field(default_factory=list)  # all words in the order of the notice


@dataclass
class Index:
    """Templates over a vocabulary whose words are ordered by their frequency in the whole corpus."""

    hashes: np.ndarray  # sorted hashes of the vocabulary
    number: np.ndarray  # vocabulary number of each
    templates: list[Template]
    phrases: list[tuple[list[int], str]]
    rare: np.ndarray  # by vocabulary number: a prefix word of some template, or the first word of a phrase


def words_needed(words: int, threshold: float = THRESHOLD) -> int:
    return words if words < SHORT else int(np.ceil(threshold * words - 1e-9))


def vocabulary(templates, phrases) -> list[str]:
    return sorted({w for _, text in templates for w in words_of(text)} | {w for text, _ in phrases for w in words_of(text)})


def frequencies(docs: DataFrame, words: list[str], text_col: str) -> np.ndarray:
    """How often each vocabulary word occurs in all texts."""
    hashes = hashes_of(words)
    order = np.argsort(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(words), np.int64)
        for batch in batches:
            data, bounds = text_bytes(batch.column(0))
            for a, b in slices(bounds):
                _, hits, _, _ = _hits(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], hashes[order])
                total += np.bincount(order[hits], minlength=len(words))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(words))), pa.array(total)], ["word", "times"])

    counted = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, "word long, times long")
    found = np.zeros(len(words), np.int64)
    for row in counted.groupBy("word").agg(F.sum("times").alias("times")).collect():  # one row per vocabulary word
        found[row["word"]] = row["times"]
    return found


def _hits(data: np.ndarray, bounds: np.ndarray, hashes: np.ndarray):
    """Words of the slice that are in the sorted hashes: (word index, place in hashes, firsts per row, words in all)."""
    with np.errstate(over="ignore"):
        found, firsts = hashed_words(LOWER[data], bounds, ALNUM_BYTES)
    place = np.searchsorted(hashes, found)
    place[place == len(hashes)] = 0
    at = np.flatnonzero(hashes[place] == found) if len(hashes) else np.zeros(0, np.int64)
    return at, place[at], firsts, len(found)


def build_index(docs: DataFrame, text_col: str = "text", templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD) -> Index:
    """Orders the vocabulary by corpus frequency and takes from each template the prefix that a match must touch.

    A block that shares ``needed`` of the n distinct words misses n - needed at most, so it has one of the
    n - needed + 1 rarest.
    """
    words = vocabulary(templates, phrases)
    times = frequencies(docs, words, text_col)
    rank = {words[j]: r for r, j in enumerate(sorted(range(len(words)), key=lambda j: (times[j], words[j])))}
    built, rare = [], np.zeros(len(words), bool)
    for label, text in templates:
        sequence = [rank[w] for w in words_of(text)]
        tokens = sorted(set(sequence))
        needed = words_needed(len(tokens), threshold)
        prefix = frozenset(tokens[: len(tokens) - needed + 1])
        rare[list(prefix)] = True
        built.append(Template(label, tokens, len(sequence), needed, prefix, sequence))
    fixed = [([rank[w] for w in words_of(text)], label) for text, label in phrases]
    for tokens, _ in fixed:
        rare[min(tokens)] = True
    hashes = hashes_of(words)
    order = np.argsort(hashes)
    return Index(hashes[order], np.array([rank[words[j]] for j in order], np.int64), built, fixed, rare)


def matching_blocks(at: np.ndarray, token: np.ndarray, count: int, index: Index) -> list[tuple[str, int, int, float, bool]]:
    """All blocks of a text that hold a template: (label, first word, last word + 1, containment, inside).

    For a template of w words the blocks are the runs of 2 w words that begin at multiples of w (the last
    one shorter), so every stretch of w words lies in one. ``inside`` tells that the block says nothing more
    than a larger notice: a template that has all its template's words matches in an overlapping block, and too
    few words stand outside that notice. ``at``, ``token``: word numbers in the text and vocabulary numbers of
    its vocabulary words, in order. The work is linear in the text: a block meets a bounded number of others.
    """
    found: list[list[tuple[int, int, float]]] = []  # by template, in order
    for template in index.templates:
        found.append([])
        member = np.isin(token, template.tokens)
        where, which = at[member], token[member]
        if len(np.unique(which)) < template.needed:  # length filter, over the whole text first
            continue
        touched = where[np.isin(which, list(template.prefix))] // template.width
        for block in np.unique(np.concatenate([touched - 1, touched])).tolist():
            start = block * template.width
            end = min(count, start + 2 * template.width)
            if block < 0 or end - start < template.needed:
                continue
            inside = np.unique(which[np.searchsorted(where, start) : np.searchsorted(where, end)])
            # Positional filter: the rarest shared word is the i-th of the template, so i words are missing.
            if len(inside) < template.needed or len(template.tokens) - template.tokens.index(int(inside[0])) < template.needed:
                continue
            found[-1].append((start, end, len(inside) / len(template.tokens)))
    larger = [[j for j, other in enumerate(index.templates) if found[j] and set(template.tokens) < set(other.tokens)] for template in index.templates]
    places: dict[tuple[int, int], np.ndarray] = {}
    blocks = []
    for i, template in enumerate(index.templates):
        for start, end, containment in found[i]:
            taken = []
            for j in larger[i]:
                width = index.templates[j].width
                first = bisect_left(found[j], (start - 2 * width + 1,))
                for k in range(first, len(found[j])):
                    if found[j][k][0] >= end:
                        break
                    if found[j][k][1] > start:
                        if (j, k) not in places:
                            a, b = np.searchsorted(at, found[j][k][:2])
                            places[j, k] = _notice_places(at[a:b], token[a:b], index.templates[j])
                        taken.append(places[j, k])
            inside = False
            if taken:
                a, b = np.searchsorted(at, [start, end])
                own = np.isin(token[a:b], template.tokens) & ~np.isin(at[a:b], np.concatenate(taken))
                inside = len(np.unique(token[a:b][own])) < template.needed
            blocks.append((template.label, start, end, containment, inside))
    return blocks


def _notice_places(at: np.ndarray, token: np.ndarray, template: Template) -> np.ndarray:
    """Where the notice itself stands in a block: the shortest stretches with all of the block's template words.

    Of the shortest ones those that follow the template's order best: a stretch that begins with the last words
    of another notice may be as short.
    """
    member = np.isin(token, template.tokens)
    where, which = at[member].tolist(), token[member].tolist()
    distinct, inside, j = len(set(which)), Counter(), 0
    stretches = []
    for i, first in enumerate(where):
        while j < len(where) and len(inside) < distinct:
            inside[which[j]] += 1
            j += 1
        if len(inside) < distinct:
            break
        stretches.append((where[j - 1] - first, i, j))
        inside[which[i]] -= 1
        if not inside[which[i]]:
            del inside[which[i]]
    least, ranked = min(stretches)[0], []
    for length, i, j in stretches:
        if length == least:
            equal = sum(w - where[i] < template.width and template.sequence[w - where[i]] == t for w, t in zip(where[i:j], which[i:j]))
            ranked.append((-equal, where[i]))
    best = min(ranked)[0]
    return np.unique(np.concatenate([np.arange(first, first + least + 1) for equal, first in ranked if equal == best]))


def phrase_places(at: np.ndarray, token: np.ndarray, index: Index) -> list[tuple[int, str]]:
    found = []
    for tokens, label in index.phrases:
        starts = at[token == tokens[0]]
        for step, t in enumerate(tokens[1:], 1):
            starts = starts[np.isin(starts + step, at[token == t])]
        found += [(int(s), label) for s in starts]
    return found


def _scan(index: Index, column: pa.Array) -> pa.Array:
    rows = []
    data, bounds = text_bytes(column)
    for a, b in slices(bounds):
        at, place, firsts, _ = _hits(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], index.hashes)
        token = index.number[place]
        cut = np.searchsorted(at, firsts)
        rare = np.concatenate([[0], np.cumsum(index.rare[token])]) if len(token) else np.zeros(1, np.int64)
        for j in range(b - a):
            count, lo, hi = int(firsts[j + 1] - firsts[j]), cut[j], cut[j + 1]
            if rare[hi if len(token) else 0] == rare[lo if len(token) else 0]:
                rows.append((count, 0, None, None, "", "", 0.0, []))
                continue
            here, which = at[lo:hi] - firsts[j], token[lo:hi]
            places = phrase_places(here, which, index)
            blocks = matching_blocks(here, which, count, index)
            base = sorted({label for _, label in places})
            labels = sorted({*base, *(block[0] for block in blocks if not block[4])})
            starts = [s for s, _ in places]
            rows.append((count, len(places), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(labels),
                         1.0 if places else max((block[3] for block in blocks), default=0.0),
                         [dict(zip(("label", "start", "end", "containment", "inside"), block)) for block in blocks]))
    names = [f.name for f in _RESULT]
    return pa.array([dict(zip(names, row)) for row in rows], _RESULT)


def license_notices(docs: DataFrame, text_col: str = "text", index: Index | None = None) -> DataFrame:
    """``docs`` with a struct column ``license``.

    n_words; n_base, first_word, last_word (places where a fixed phrase's words stand consecutively, and their
    smallest and largest start); base_labels and labels (of the phrases; of the matching blocks as well, but for
    those inside a larger notice); score (1 with a phrase, else the best containment, 0 without a match); blocks
    (label, start, end, containment, inside: every block of words that holds THRESHOLD or more of a template's
    distinct words, and whether a larger notice there explains it).

    Texts are read whole, in time linear in their length. Repeated rows each get their result. A null or empty
    text has no word and no label; an empty table gives an empty table. A column named license is replaced.
    """
    built = build_index(docs, text_col) if index is None else index

    @F.arrow_udf(RESULT)
    def scan(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            yield _scan(built, column)

    kept = [F.col(f"`{c}`") for c in docs.columns if c != "license"]
    return docs.select(*kept, scan(F.col(f"`{text_col}`").cast("string")).alias("license"))
