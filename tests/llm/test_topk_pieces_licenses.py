import math
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from tests.llm import data
from threadlens.llm import topk, viterbi
from threadlens.llm.licenses import TEMPLATES, license_scan
from threadlens.llm.topk import top_inner_products
from threadlens.llm.viterbi import Encoder, Pieces, default_model, sentencepiece_ids, stream

VEC = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                    T.StructField("label", T.IntegerType()), T.StructField("block", T.IntegerType()),
                    T.StructField("norm", T.StringType())])


def brute_top(rows, k):
    ok = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in ok:
        if i % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 16])
def test_top_products_as_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", 5)
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in r.normal(size=12) * (1 + i % 7)]) for i in range(300)]
    rows += [(1000 + i, rows[i][1]) for i in range(60)]                      # ties
    rows += [(401, None), (420, [1.0] * 11 + [None]), (440, [float("nan")] * 12), (460, [float("inf")] * 12),
             (None, [1.0] * 12), (480, [0.0] * 12), (500, []), (520, [3.0] * 4)]
    df = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], VEC).repartition(3)
    got = data.result(top_inner_products(df), "query_id", "rank", "vec_id", "score")
    assert got == brute_top(rows, 20)


def test_top_products_few_rows(spark):
    assert top_inner_products(spark.createDataFrame([], VEC)).collect() == []
    few = spark.createDataFrame([(0, [1.0, 2.0], 0, 0, ""), (3, [2.0, 1.0], 0, 0, "")], VEC)
    assert data.result(top_inner_products(few), "query_id", "rank", "vec_id", "score") == [(0, 1, 3, 16384)]


def full_viterbi(text, p):
    best, back = [0.0], [None]
    for end in range(1, len(text) + 1):
        top = None
        for start in range(max(0, end - p.longest), end):
            hit = p.score.get(text[start:end])
            if hit is None and end - start == 1:
                hit = (p.missing, None)
            if hit and (top is None or best[start] + hit[0] > top[0]):
                top = (best[start] + hit[0], start, [hit[1]] if hit[1] is not None else p.fallback(text[start]))
        best.append(top[0])
        back.append(top[1:])
    out, end = [], len(text)
    while end:
        end, ids = back[end]
        out.append(ids)
    return [i for ids in reversed(out) for i in ids]


def test_stream_and_lock_step_as_full_viterbi():
    p = Pieces(default_model())
    enc = Encoder(default_model())
    texts = [t for t in data.texts(51, 60) if t and len(t) < 4000] + ["日本語 テキスト", "a  b   c", "ééé\n\tx"]
    for t in texts:
        esc = viterbi.SPACE + t.replace(" ", viterbi.SPACE)
        want = full_viterbi(esc, p)
        assert list(stream(esc, p)) == want
        raw = np.frombuffer(t.encode(), np.uint8)
        ids, _ = viterbi.encode(raw, np.array([0, len(raw)]), enc)
        assert ids.tolist() == want


def test_round_trip(spark):
    rs = data.rows(52, 100) + [(9001, viterbi.SPACE), (9002, "  lead and trail  ")]
    got = sentencepiece_ids(data.frame(spark, [*rs, (None, "x")]), with_ids=True).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rs)
    text = dict(rs)
    for r in got:
        assert r.round_trip == (viterbi.SPACE not in (text[r.doc_id] or "")) and r.n_ids == len(r.ids)
    assert sentencepiece_ids(data.frame(spark, [])).collect() == []


DENY = {"not", "never", "neither", "nor", "cannot"}
DENY |= {v + e for v in "is was are were has have had does do did".split() for e in ("n", "n\u2019t")}


def spelled(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return [(m[0], m.start(), m.end()) for m in re.finditer(r"[0-9a-z\x80-\U0010ffff]+", low)]


def word_pairs(words):
    return set(zip(words, words[1:])) if len(words) > 1 else {(x,) for x in words}


def brute_templates():
    rows = [(name, [w for w, _, _ in spelled(t)]) for name in sorted(TEMPLATES) for t in TEMPLATES[name]]
    out = []
    for name, words in rows:
        own = word_pairs(words)
        must = {g for g in own if len(g) == 2 and g[1][0] in "0123456789"}
        for other, theirs in rows:
            apart = own - word_pairs(theirs)
            if other != name and 0 < len(apart) <= 2 < len(own):
                must |= apart
        out.append((name, words, own, must))
    return out


def brute_license(text, least=0.8):
    """Best name, its Dice and the number of matches: all segments and all windows, one by one."""
    w, table = spelled(text), brute_templates()
    alone = [x for x, _, _ in w]

    def denied(i, j, words):
        early = [k for k in range(max(0, i - 3), i) if not re.search("[.!?;:]", text[w[k][2]:w[i][1]])]
        return (any(x in DENY and x not in words for x in alone[i:j])
                or any(alone[k] in DENY for k in early))

    cuts = [[m.end() for m in re.finditer("\n", text)],
            [k + 1 for k in range(1, len(text)) if text[k] == "\n" and text[k - 1] == "\n"], []]
    segs = {z for c in cuts for z in zip([0, *c], [*c, len(text)])}
    found, spans = [], []
    for a, b in segs:
        at = [k for k, (_, x, y) in enumerate(w) if a <= x and y <= b]
        if not at:
            continue
        i, j = at[0], at[-1] + 1
        g, some = word_pairs(alone[i:j]), False
        for t, (_, words, own, must) in enumerate(table):
            dice = 2 * len(g & own) / (len(g) + len(own))
            if dice >= least and must <= g and not denied(i, j, words):
                found.append((dice, t, i, j, len(g & own)))
                some = True
        if some:
            spans.append((i, j))
    hits, windows = len(spans), []
    every = word_pairs(alone)
    for t, (_, words, own, must) in enumerate(table):
        if len(words) < 2 or len(every & own) < least * len(own) / (2 - least) - 1e-9:
            continue
        reach = int((2 - least) / least * (len(words) - 1) + 1e-9)
        for i in range(len(w) - 1):
            if (alone[i], alone[i + 1]) not in own:
                continue
            top, g = (0, 0, 0), set()
            for j in range(i + 1, min(i + reach, len(w) - 1) + 1):
                g.add((alone[j - 1], alone[j]))
                dice = 2 * len(g & own) / (len(g) + len(own))
                if must <= g and dice > top[0]:
                    top = (dice, j + 1, len(g & own))
            if top[0] >= least and not denied(i, top[1], words):
                windows.append((-top[0], t, i, top[1], top[2]))
    for dice, t, i, j, shared in sorted(windows):
        found.append((-dice, t, i, j, shared))
        if all(j <= a or b <= i for a, b in spans):
            hits += 1
            spans.append((i, j))
    whole = [m for m in found if not any(o[4] > m[4] and o[2] <= m[2] and m[3] <= o[3] for o in found)]
    if not whole:
        return None, 0.0, hits
    best = min(whole, key=lambda m: (-m[0], m[1]))
    return table[best[1]][0], round(best[0], 9), hits


def test_licenses_as_brute_force(spark):
    rs = data.rows(61, 60)
    rs += [(8000, "MIT"), (8001, TEMPLATES["MIT"][1].upper()), (8002, "x\n\n" + TEMPLATES["ISC"][0] + "\n\ny"),
           (8003, "a\nLicensed under CC BY-NC 4.0.\nb\nReleased under the MIT License"),
           (8004, TEMPLATES["MIT"][1].replace(" the ", "\nthe ")), (8005, "\n\n\n")]
    got = {r.doc_id: (r.license, round(r.dice, 9), r.n_matches)
           for r in license_scan(data.frame(spark, [*rs, (None, "x")])).collect()}
    assert got == {i: brute_license(t or "") for i, t in rs}
    assert got[8001][0] == got[8004][0] == "MIT" and got[8002][0] == "ISC" and got[8003][2] == 2
    assert license_scan(data.frame(spark, [])).collect() == []


def test_license_windows_as_brute_force(spark):
    import textwrap
    gpl, mit = TEMPLATES["GPL-3.0"][1], TEMPLATES["MIT"][1]
    tail = ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
            "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
            "License for more details. You should have received a copy of the GNU General Public License along with "
            "this program. If not, see the project's page, where all of it can be read at leisure.")
    wrap = textwrap.wrap
    block = "\n".join(["# Copyright 2020 A. Writer", "#", *("# " + x for x in wrap(gpl, 60)), "#",
                       *("# " + x for x in wrap(tail, 60)), "", "import os"])
    stars = "\n".join(["/*", " * Copyright (c) 2020", " *", *(" * " + x for x in wrap(mit, 60)), " *",
                       *(" * " + x for x in wrap(tail * 2, 60)), " */", "int x;"])
    crlf = "\r\n".join([*wrap(tail, 70), "", *wrap(TEMPLATES["ISC"][0], 50), "", *wrap(tail, 70)])
    blanks = " \n".join([*wrap(tail, 70), "  ", *wrap(TEMPLATES["MPL-2.0"][0], 30), "\t", *wrap(tail, 70)])
    line = ("Some words about this page and who wrote it. " * 4 + "It is all licensed under CC BY-SA 4.0. " + tail + " "
            + TEMPLATES["Unlicense"][0] + " And more words follow here, none of them of any use.")
    two = "GNU General Public License as published by the Free Software Foundation; either version 2 of the License"
    old = tail + " " + TEMPLATES["GPL-2.0"][1] + " " + tail
    near = tail + " " + gpl.replace("modify it", "change all of it") + " " + tail
    rs = list(enumerate([block, stars, crlf, blanks, line, two, old, near, tail]))
    got = {r.doc_id: r for r in license_scan(data.frame(spark, rs)).collect()}
    for i, t in rs:
        assert (got[i].license, round(got[i].dice, 9), got[i].n_matches) == brute_license(t)
    assert [got[i].license for i, _ in rs] == [
        "GPL-3.0", "MIT", "ISC", "MPL-2.0", "CC-BY-SA-4.0", None, "GPL-2.0", "GPL-3.0", None]
    assert got[4].n_matches == 2 and got[0].n_matches == 1 and got[8].n_matches == 0


def test_each_licence_of_a_family_by_its_own_name_or_none(spark):
    """Expected names are written down here, not computed."""
    cc = "This work is licensed under a Creative Commons Attribution"
    gnu = ("{} is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by "
           "the Free Software Foundation; either version {} of the License, or (at your option) any later version.")
    bsd = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright "
           "notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must "
           "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
           "documentation and/or other materials provided with the distribution.\n")
    third = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
             "promote products derived from this software without specific prior written permission.\n")
    grant = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted")
    probes = [
        (cc + "-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
        (cc + "-NoDerivatives 4.0 International License.", "CC-BY-ND-4.0"),
        (cc + "-NonCommercial-ShareAlike 4.0 International License.", "CC-BY-NC-SA-4.0"),
        (cc + "-NonCommercial-NoDerivatives 4.0 International License.", "CC-BY-NC-ND-4.0"),
        (cc + " 4.0 International License.", "CC-BY-4.0"), (cc + " 3.0 Unported License.", "CC-BY-3.0"),
        (cc + " 3.0 License.", "CC-BY-3.0"), (cc + " 1.0 License.", None), (cc + "-Sampling 4.0 License.", None),
        ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"), ("Licensed under CC BY-SA 3.0.", "CC-BY-SA-3.0"),
        ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Licensed under CC BY 5.0.", None),
        (bsd, "BSD-2-Clause"), (bsd + third, "BSD-3-Clause"), ("Copyright 1999\n" + bsd + third + "THIS", "BSD-3-Clause"),
        (bsd.split("\n")[0], "BSD"),
        ("\n".join("# " + x for x in (bsd + third).split("\n")), "BSD-3-Clause"),
        (gnu.format("This library", "Library General Public License", "2"), "LGPL-2.0"),
        (gnu.format("This library", "Lesser General Public License", "2.1"), "LGPL-2.1"),
        (gnu.format("This program", "General Public License", "2"), "GPL-2.0"),
        (gnu.format("This program", "General Public License", "3"), "GPL-3.0"),
        (gnu.format("This program", "Affero General Public License", "3"), "AGPL-3.0"),
        (gnu.format("This program", "General Public License", "1"), None),
        ("Licensed under the Apache License, Version 1.1.", "Apache-1.1"),
        ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
        (grant + ", provided that the above copyright notice and this permission notice appear in all copies.", "ISC"),
        (grant + ".", "0BSD"),
        ("We were not released under the MIT License because of patents", None),
        ("It wasn't released under the MIT License.", None), ("It wasn\u2019t released under the MIT License.", None),
        ("This is no toy and not a game. Released under the MIT License.", "MIT"),
        ("All of it is released under the MIT License.", "MIT"),
    ]
    rs = [(i, t) for i, (t, _) in enumerate(probes)] + [(100, "Released under the MIT License.")] * 2
    rows = license_scan(data.frame(spark, rs)).collect()
    got = {r.doc_id: r for r in rows}
    assert {probes[i][0]: got[i].license for i in range(len(probes))} == dict(probes)
    assert sum(r.doc_id == 100 for r in rows) == 2 and got[100].license == "MIT"
    for i, (t, _) in enumerate(probes):
        assert (got[i].license, round(got[i].dice, 9), got[i].n_matches) == brute_license(t), t


def test_scores_are_log_probabilities_of_the_documents(spark):
    import collections

    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2
    path = default_model()
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    rs = [*data.rows(53, 60), (7001, "An international agreement between the governments of the north"),
          (7002, "the international governments agree  on 日本語 "), (7003, "international " * 50)]
    docs = data.frame(spark, [*rs, (None, "nobody counts this")]).repartition(3)
    scores = viterbi.piece_scores(docs, path)
    n = collections.Counter(i for _, t in rs for i in lib.encode(t or ""))
    plain = [i for i in range(lib.get_piece_size()) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))]
    total = sum(n[i] for i in plain) + len(plain) / 2
    assert all(abs(scores[i] - math.log((n[i] + .5) / total)) < 1e-6 for i in plain)
    # the library's own Viterbi over a unigram model of these scores
    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for i in plain:
        proto.pieces[i].score = scores[i]
    other = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    p = Pieces(path, scores)

    def worth(ids):
        return sum(scores[i] if not lib.is_byte(i) else 0.0 for i in ids)

    got = {r.doc_id: list(r.ids) for r in sentencepiece_ids(docs, with_ids=True).collect()}
    same = 0
    for i, t in rs:
        esc = viterbi.SPACE + (t or "").replace(" ", viterbi.SPACE) if t else ""
        assert got[i] == full_viterbi(esc, p)
        want = other.encode(t or "")
        same += want == got[i]
        assert abs(worth(want) - worth(got[i])) <= 1e-4 * (1 + abs(worth(want)))        # it adds in 32 bits
    assert same >= 0.9 * len(rs)
    assert got[7003] == lib.encode("international " * 50)


def test_equal_segments_of_spaces_and_marks_keep_the_memo_right():
    enc = Encoder(default_model())
    for texts in ([viterbi.SPACE, "lead  ", "then words"], ["other words", "and more of them"]):
        raw = [t.encode() for t in texts]
        offs = np.concatenate(([0], np.cumsum([len(t) for t in raw])))
        ids, ptr = viterbi.encode(np.frombuffer(b"".join(raw), np.uint8), offs, enc)
        for t, a, b in zip(texts, ptr[:-1], ptr[1:]):
            assert ids[a:b].tolist() == full_viterbi(viterbi.SPACE + t.replace(" ", viterbi.SPACE), enc.p)


def test_segments_at_once_as_one_by_one():
    """Random runs of pieces, rare characters and very short or long segments; repeated ones too."""
    import random
    enc, r = Encoder(default_model()), random.Random(7)
    pieces = list(enc.p.score)
    rare = [chr(c) for c in (0x61, 0x4E00, 0x1F600, 0x301, 0xE9, 0x20, 0x2581)]
    words = ["".join(r.choice(pieces) if r.random() < .7 else r.choice(rare) for _ in range(r.randint(0, 14)))
             for _ in range(1500)] + ["", "a" * 31, "a" * 32, "a" * 500, "", "a" * 31]
    size = [len(w) for w in words]
    assert min(size) == 0 and max(size) >= 4 * enc.p.longest
    got = enc.encode([w.encode() for w in words])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [list(stream(w, enc.p)) for w in words]
    assert enc.encode([]) == [] and enc.encode([b""]) == [b""]
