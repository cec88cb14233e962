"""Operator 9, licence scan by Dice coefficient over word bigrams.

Texts and templates are normalised alike: A-Z lower-cased, words parted by
anything but letters, digits and non-ASCII bytes; a segment's set holds its
distinct word bigrams (a single word counts as one). Segments are each line,
each paragraph (between empty lines), the whole text, and, however the text is
broken into lines or marked as comments, every window of a document's words of
up to (2-t)/t times a template's length. A template can only reach the threshold
t with segments of between t/(2-t) and (2-t)/t times its size; other segments are
never compared. The best window starts and ends with a bigram of the template,
so only such starts are looked at, and only where enough of the template's
bigrams follow: work is linear in the text. Templates of one word only meet
one-word segments.

Licences of a family share most of their words, so likeness is not all:

- Deciding bigrams. A segment must hold every bigram of the template that ends
  in a number (a version), and, where the template differs from one of another
  licence by at most two bigrams, those. "Attribution-ShareAlike 4.0" holds no
  "attribution 4", so it is no CC-BY-4.0.
- Denial. A segment with a denying word (``DENIALS``) that its template lacks, or
  with one among the three words before it in the same sentence, does not match.
- Whole before part. A match that lies inside one that shares more bigrams with its
  template does not name the document: the first clauses of a BSD-3-Clause text are
  no BSD-2-Clause.

Per document the best match counts; ties go to the template first by name.
n_matches counts lines, paragraphs and whole texts that match, and matching
windows (the best first) that overlap neither those nor each other. ``BSD`` names
a notice of that family that does not show its clauses.

Null and empty texts match nothing (license null, dice 0). Rows without doc_id name
no document and give no row; each of repeated rows gives its own. Long texts are
read whole. Empty table: no rows.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from threadlens.llm import common as C
from threadlens.llm.toxicity import _parting

# Sentences of the BSD licences, shared by several of them.
BSD_START = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
             "that the following conditions are met:")
BSD_TWO = (" 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
           "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list "
           "of conditions and the following disclaimer in the documentation and/or other materials provided with the "
           "distribution.")
BSD_NAMES = (" {}. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
             "promote products derived from this software without specific prior written permission.")

#: Licence notices as they are written into files (fixed values).
TEMPLATES = {
    "0BSD": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted."],
    "Apache-1.1": [
        "Licensed under the Apache License, Version 1.1.",
        BSD_START + BSD_TWO + " 3. The end-user documentation included with the redistribution, if any, must include the "
        "following acknowledgment: This product includes software developed by the Apache Software Foundation "
        "(http://www.apache.org/). Alternately, this acknowledgment may appear in the software itself, if and wherever "
        "such third-party acknowledgments normally appear. 4. The names \"Apache\" and \"Apache Software Foundation\" "
        "must not be used to endorse or promote products derived from this software without prior written permission."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"],
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."],
    "BSD": [BSD_START, "Use of this source code is governed by a BSD-style license."],
    "BSD-2-Clause": [BSD_START + BSD_TWO, "Licensed under the BSD 2-Clause License."],
    "BSD-3-Clause": [BSD_START + BSD_TWO + BSD_NAMES.format(3), "Licensed under the BSD 3-Clause License."],
    "BSD-4-Clause": [
        BSD_START + BSD_TWO + " 3. All advertising materials mentioning features or use of this software must display the "
        "following acknowledgement: This product includes software developed by the organization." + BSD_NAMES.format(4),
        "Licensed under the BSD 4-Clause License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring "
                "rights to this work."],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "LGPL-2.0": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, or (at "
        "your option) any later version."],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."],
    "LGPL-3.0": [
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}

# Conditions of the Creative Commons licences by their letters, and the names of their versions.
CC_PARTS = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
CC_KINDS = ["BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"]
CC_VERSIONS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic"}
for _kind in CC_KINDS:
    for _version, _scope in CC_VERSIONS.items():
        _words = "-".join(CC_PARTS[x] for x in _kind.split("-"))
        if _version != "4.0":
            _words = _words.replace("NoDerivatives", "NoDerivs")
        TEMPLATES[f"CC-{_kind}-{_version}"] = [
            f"This work is licensed under a Creative Commons {_words} {_version} {_scope} License.",
            f"This work is licensed under a Creative Commons {_words} {_version} License.",
            f"Licensed under CC {_kind} {_version}."]

# Words that deny what follows, and the verbs whose short denials count as well.
DENIALS = ["not", "never", "neither", "nor", "cannot"]
DENYING_VERBS = ["is", "was", "are", "were", "has", "have", "had", "does", "do", "did"]


@dataclass
class Template:
    name: str
    grams: np.ndarray                                        # distinct bigrams, sorted
    n_words: int
    deciding: np.ndarray                                     # bigrams a segment must hold
    denials: frozenset                                       # denying words it holds itself


def _words(text: str):
    raw = np.frombuffer(text.encode(), np.uint8)
    return C.words(raw, np.array([0, len(raw)]), lower=True, space=_parting())


def denial_hashes() -> frozenset:
    """Hashes of denying words, short forms as both kinds of apostrophe leave them."""
    short = [f"{v}n{end}" for v in DENYING_VERBS for end in ("", "\u2019t")]
    return frozenset(_words(" ".join(DENIALS + short))[2].tolist())


def compiled(templates: dict[str, list[str]]) -> list[Template]:
    """Templates by name, with their bigrams and what decides between them."""
    out, denials = [], denial_hashes()
    for name in sorted(templates):
        for text in templates[name]:
            starts, _, h, _ = _words(text)
            raw = text.encode()
            seg = np.zeros(len(h), np.int64)
            at, grams = _bigrams(h, seg) if len(h) > 1 else (np.zeros(0, np.int64), h)
            number = [k for k, i in enumerate(at.tolist()) if raw[starts[i + 1]:starts[i + 1] + 1].isdigit()]
            out.append(Template(name, np.unique(grams), len(h), np.unique(grams[number]) if number else h[:0],
                                denials & frozenset(h.tolist())))
    for t in out:
        apart = [np.setdiff1d(t.grams, u.grams) for u in out if u.name != t.name]
        t.deciding = np.unique(np.concatenate([t.deciding, *(x for x in apart if 0 < len(x) <= 2 < len(t.grams))]))
    return out


def _bigrams(h: np.ndarray, seg: np.ndarray):
    """Places of the words that have a next one in their segment, and the bigrams' hashes."""
    two = np.flatnonzero(seg[1:] == seg[:-1]) if len(h) else np.zeros(0, np.int64)
    return two, C.mix(h[two] * np.uint64(3) + C.mix(h[two + 1])) if len(two) else h[:0]


def bigram_sets(data: np.ndarray, offs: np.ndarray):
    """Distinct bigram hashes of each segment: (hash, segment), sorted by segment."""
    _, _, h, ptr = C.words(data, offs, lower=True, space=_parting())
    count = np.diff(ptr)
    seg = np.repeat(np.arange(len(count)), count)
    two, pairs = _bigrams(h, seg)
    one = ptr[:-1][count == 1]
    value = np.concatenate([pairs, h[one]])
    own = np.concatenate([seg[two], seg[one]])
    order = np.lexsort((value, own))
    value, own = value[order], own[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (own[1:] != own[:-1])
    return value[new], own[new]


def _line_ends(data: np.ndarray, offs: np.ndarray):
    """Segment bounds (starts of lines, starts of paragraphs) as byte offsets."""
    feed = np.flatnonzero(data == 10) + 1
    lines = np.unique(np.concatenate([offs, feed]))
    empty = feed[np.isin(feed - 1, feed)]
    return lines, np.unique(np.concatenate([offs, empty]))


def _windows(words, docs: int, templates: list[Template], known: np.ndarray, least: float):
    """Best matching window from each start: (-dice, template, document, first word, last word, shared bigrams)."""
    _, _, h, ptr = words
    doc = np.repeat(np.arange(docs), np.diff(ptr))
    at, value = _bigrams(h, doc)
    hit = np.flatnonzero(known[np.minimum(np.searchsorted(known, value), len(known) - 1)] == value)
    found = []
    for t, template in enumerate(templates):
        grams = template.grams
        if template.n_words < 2:
            continue
        reach = int((2 - least) / least * (template.n_words - 1) + 1e-9)
        need = max(int(np.ceil(least * len(grams) / (2 - least) - 1e-9)), 1)
        own = hit[grams[np.minimum(np.searchsorted(grams, value[hit]), len(grams) - 1)] == value[hit]]
        if len(own) < need:
            continue
        last = len(own) - need + 1                              # enough anchors within reach, in one document?
        near = (at[own[need - 1:]] - at[own[:last]] < reach) & (doc[at[own[need - 1:]]] == doc[at[own[:last]]])
        if not near.any():
            continue
        wanted, deciding = set(grams.tolist()), set(template.deciding.tolist())
        for k in own[:last][near].tolist():
            d = int(doc[at[k]])
            seen, shared, missing, top = set(), 0, len(deciding), (0.0, 0, 0)
            for j, v in enumerate(value[k:min(k + reach, int(np.searchsorted(at, ptr[d + 1])))].tolist(), k):
                if v not in seen:
                    seen.add(v)
                    if v in wanted:
                        shared += 1
                        missing -= v in deciding
                        dice = 2 * shared / (len(seen) + len(wanted))
                        if dice > top[0] and not missing:
                            top = (dice, j, shared)
            if top[0] >= least:
                found.append((-top[0], t, d, int(at[k]), int(at[top[1]]) + 1, top[2]))
    return found


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _denied(raw: bytes, words, first: int, last: int, begin: int, template: Template, denials: frozenset) -> bool:
    """Does a denying word stand in words first..last, or up to three words before them in their sentence?"""
    starts, ends, h, _ = words
    if any(x in denials and x not in template.denials for x in h[first:last + 1].tolist()):
        return True
    for k in range(max(first - 3, begin), first):
        if int(h[k]) in denials and not any(c in b".!?;:" for c in raw[ends[k]:starts[first]]):
            return True
    return False


def _best(found: list[tuple]):
    """(dice, template) of the best match (dice, template, first, last word, shared) inside none that shares more."""
    top = (0.0, -1)
    for size in sorted({m[4] for m in found}):
        larger = sorted((m[2], m[3]) for m in found if m[4] > size)
        reach = np.maximum.accumulate([b for _, b in larger]) if larger else []
        for dice, t, first, last, shared in found:
            if shared != size:
                continue
            before = bisect.bisect_right(larger, (first, 1 << 62))
            if before and reach[before - 1] >= last:
                continue
            if dice > top[0] or (dice == top[0] and t < top[1]):
                top = (dice, t)
    return top


def matches(data: np.ndarray, offs: np.ndarray, templates: list[Template], least: float):
    """For each document: number of matches, best Dice, its template's place."""
    docs, raw, denials = len(offs) - 1, data.tobytes(), denial_hashes()
    hits, best, which = np.zeros(docs, np.int64), np.zeros(docs), np.full(docs, -1)
    known = np.unique(np.concatenate([t.grams for t in templates]))
    lo = min(len(t.grams) for t in templates) * least / (2 - least)
    hi = max(len(t.grams) for t in templates) * (2 - least) / least
    words = C.words(data, offs, lower=True, space=_parting())
    starts, _, _, ptr = words
    lines, paragraphs = _line_ends(data, offs)
    seen, taken, found = set(), [[] for _ in range(docs)], [[] for _ in range(docs)]
    for bounds in (lines, paragraphs, offs):
        value, own = bigram_sets(data, bounds)
        n = np.bincount(own, minlength=len(bounds) - 1)
        place = np.minimum(np.searchsorted(known, value), len(known) - 1)
        shared = np.bincount(own[known[place] == value], minlength=len(n))
        for s in np.flatnonzero((n >= lo) & (n <= hi) & (2 * shared >= least * (shared + n) - 1e-9)).tolist():
            span = (int(bounds[s]), int(bounds[s + 1]))
            if span in seen:
                continue
            seen.add(span)
            a, b = np.searchsorted(own, [s, s + 1])
            d = int(np.searchsorted(offs, span[0], side="right")) - 1
            first, last = int(np.searchsorted(starts, span[0])), int(np.searchsorted(starts, span[1])) - 1
            size, some = b - a, False
            for t, template in enumerate(templates):
                grams = template.grams
                if not (least * len(grams) <= (2 - least) * size and least * size <= (2 - least) * len(grams)):
                    continue
                common = len(np.intersect1d(value[a:b], grams, assume_unique=True))
                dice = 2 * common / (size + len(grams))
                if (dice >= least and np.isin(template.deciding, value[a:b]).all()
                        and not _denied(raw, words, first, last, int(ptr[d]), template, denials)):
                    found[d].append((dice, t, first, last, common))
                    some = True
            if some:
                hits[d] += 1
                taken[d].append((first, last + 1))
    for spans in taken:
        spans[:] = _merged(spans)
    for dice, t, d, first, last, common in sorted(_windows(words, docs, templates, known, least)):
        if _denied(raw, words, first, last, int(ptr[d]), templates[t], denials):
            continue
        found[d].append((-dice, t, first, last, common))
        span = (first, last + 1)
        place = bisect.bisect_left(taken[d], span)
        if ((place == 0 or taken[d][place - 1][1] <= span[0])
                and (place == len(taken[d]) or taken[d][place][0] >= span[1])):
            taken[d].insert(place, span)
            hits[d] += 1
    for d, some in enumerate(found):
        if some:
            best[d], which[d] = _best(some)
    return hits, best, which


RESULT = "doc_id long, license string, dice double, n_matches long"


def license_scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, least: float = 0.8) -> DataFrame:
    """Per document: doc_id, license, dice, n_matches."""
    templates = templates or TEMPLATES

    def run(batches):
        table = compiled(templates)
        for batch in batches:
            ids = np.asarray(batch.column(0))
            data, offs = C.strings(batch.column(1))
            for i, j in C.pieces(offs, 1 << 20):
                hits, best, which = matches(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], table, least)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids[i:j],
                    "license": pa.array([table[w].name if w >= 0 else None for w in which.tolist()], pa.string()),
                    "dice": best, "n_matches": hits})

    return C.whole(docs).mapInArrow(run, RESULT)
