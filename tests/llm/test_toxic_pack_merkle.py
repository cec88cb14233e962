import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tests.llm import data
from threadlens.llm import merkle
from threadlens.llm.merkle import document_fingerprints
from threadlens.llm.packing import column_generation, default_tokenizer, pack, plan
from threadlens.llm.toxicity import toxicity

SF = "/root/testdata/sf0.01"


def labels(spark, rs):
    return spark.createDataFrame(rs, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark):
    docs, lab = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity(docs, lab).join(lab, "doc_id").where("held_out").toPandas()
    pos, neg = got[got.toxic == 1].score.to_numpy(), got[got.toxic == 0].score.to_numpy()
    auc = (pos[:, None] > neg[None, :]).mean()
    assert auc > 0.85
    assert (got.predicted == got.toxic).mean() > (got.toxic == 0).mean()


def test_toxicity_edges(spark):
    rs = [(1, "good day"), (2, "bad bad"), (3, None), (4, ""), (4, ""), (None, "x")]
    got = data.result(toxicity(data.frame(spark, rs), labels(spark, [(1, 1, 0), (2, None, 1), (9, 0, 1), (None, 1, 1)])),
                      "doc_id", "held_out", "score", "predicted")
    assert [r[0] for r in got] == [1, 2, 3, 4, 4]
    assert all(r[1] == (zlib.crc32(str(r[0]).encode()) % 4 == 2) and 0 <= r[2] <= 1 for r in got)
    none = toxicity(data.frame(spark, rs), labels(spark, []))
    assert {r.score for r in none.collect()} == {0.5}
    assert toxicity(data.frame(spark, []), labels(spark, [])).collect() == []


def test_pieces_are_the_tokenizers_and_fill_sequences(spark):
    from tokenizers import Tokenizer
    rs = data.rows(31, 150) + [(9001, "It's <|endoftext|> l'été x\x85y ΣΑΣ é Don'T 42"), (9002, "a " * 9000)]
    tok = Tokenizer.from_file(default_tokenizer())
    got = pack(data.frame(spark, [*rs, (None, "z")]).repartition(3)).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for i, t in rs:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        at = 0
        for r in sorted(by_doc.pop(i), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            at += r.length
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:at], "<u4").tobytes())
        assert at == len(ids)
    assert not by_doc
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    total = sum(r.length for r in got)
    assert len(by_seq) <= -(-total // 4096) * 1.05 + 1


def test_column_generation_reaches_the_bound():
    size, demand = np.array([3, 5, 7]), np.array([300., 200., 100.])
    patterns, use = column_generation(size, demand, 10)
    assert np.allclose(patterns.T @ use, demand) and use.sum() <= 300
    p, x = plan(np.arange(1, 11), np.array([0, 0, 301, 0, 200, 0, 100, 0, 0, 3]), 10)
    assert (p.T @ x).tolist() == [0, 0, 301, 0, 200, 0, 100, 0, 0, 3]
    assert (p @ np.arange(1, 11) <= 10).all()


def test_pack_edges(spark):
    assert pack(data.frame(spark, [])).collect() == []
    got = data.result(pack(data.frame(spark, [(1, None), (1, None), (2, "")])), "doc_id", "length", "doc_tokens")
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1)]


@pytest.mark.parametrize("ranges", [1 << 30, 1 << 12])
def test_fingerprints_as_brute_force(spark, monkeypatch, ranges):
    if ranges < 1 << 20:                                     # many ranges on a small table
        real = merkle._ranges
        monkeypatch.setattr(merkle, "_ranges", lambda base, total: real(base, 40 << 20))
    rs = sorted(data.rows(41, 120))
    got = {r.doc_id: r for r in document_fingerprints(data.frame(spark, rs[::-1]).repartition(4)).collect()}
    assert len(got) == len(rs)
    texts = [t or "" for _, t in rs]
    nxt = texts[1:] + texts[:1]
    edited = [t[:len(t) - len(t) // 4] + n[:len(t) // 4] for t, n in zip(texts, nxt)]
    for (i, _), t, e in zip(rs, texts, edited):
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert r.fingerprint == merkle.fingerprint(merkle.trees([t.encode()])[0])
        assert r.edited_fingerprint == merkle.fingerprint(merkle.trees([e.encode()])[0])
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    seen = {}
    for (i, _), t in zip(rs, texts):
        assert seen.setdefault(got[i].fingerprint, t) == t
    long = [got[i] for i, t in rs if t and len(t) > 400]
    assert np.mean([r.near_edited for r in long]) > 0.5


def test_tree_locates_edits_and_edges(spark):
    text = "".join(f"line {k} of a text\n" for k in range(200)).encode()
    a, b = merkle.trees([text, text.replace(b"line 77 ", b"line 7x ")])
    (lo, hi), = merkle.differing(a, b)
    assert text[lo:hi] == b"line 77 of a text\n" and merkle.differing(a, a) == []
    assert document_fingerprints(data.frame(spark, [])).collect() == []
    one = document_fingerprints(data.frame(spark, [(5, "abcdefgh"), (None, "x")])).collect()
    assert [(r.n_chars, r.near_next) for r in one] == [(8, 1.0)]
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
