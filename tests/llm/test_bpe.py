import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import tiktoken

from tests.llm import data
from threadlens.llm import bpe
from threadlens.llm import common as C
from threadlens.llm.bpe import Decoder, Transducer, default_ranks, read_ranks, round_trip

RANKS = read_ranks(default_ranks())
LIBRARY = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TRICKY = ["it's we've I'll 're'' 's's\n's  's  's 'tx ''s x's'll 'm'd 'S 'lly 'vex", "  a\n b \n\n c\t\td  　e  f\u0085g ", " ", "\n",
          "a" * 700 + " " * 90 + "\n" * 40 + "é" * 50, "x1y22 333٠١²½ⅷ", "é \U0001f600\U0001f468‍\U0001f469 ज़ 漢字 한국",
          "'", "''", " '", "'s", " 'll", "\x00\x1c\x1d \x1f\x7f", "#$% *** |||\t|", "ﬁ ǅ ʰ ª"]


def arrow(texts):
    return C.strings(pa.array(texts, pa.large_string()))


def encoded(worker, texts):
    out = [[] for _ in texts]
    for d, got, _ in worker.encoded(*arrow(texts)):
        out[d] += [i for ids, _ in got for i in np.frombuffer(ids, "<u4").tolist()]
    return out


def test_pattern_is_the_files():
    import public_tokenizers
    assert bpe.PATTERN == public_tokenizers.PATTERN


@pytest.mark.parametrize("window,states,kept", [(4 << 20, 100_000, 200_000), (50, 40, 10)])
def test_ids_and_text_as_the_library(monkeypatch, window, states, kept):
    """Small windows and tables change nothing."""
    monkeypatch.setattr(bpe, "WINDOW", window)
    worker = bpe._Worker(default_ranks())
    worker.matches.most, worker.matches.transducer.most = kept, states
    texts = [t or "" for t in data.texts(7, 150)][:-1 if window > 1000 else 40] + TRICKY
    if window > 1000:
        points = [*range(0x3400), *range(0x3400, 0xD800, 61), *range(0xE000, 0x110000, 61), *range(0x1D400, 0x1D800)]
        texts += ["".join(map(chr, points)), " ".join(map(chr, points))]
    want = [LIBRARY.encode_ordinary(t) for t in texts]
    assert encoded(worker, texts) == want
    assert [worker.decoder.feed(i) + worker.decoder.close() for i in want] == texts


def merged(raw, ranks):
    """The library's rule, spelled out: a token by itself, or merges of the lowest rank."""
    if raw in ranks:
        return [ranks[raw]]
    parts = [raw[k:k + 1] for k in range(len(raw))]
    while pairs := [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]:
        k = min(pairs)[1]
        parts[k:k + 2] = [parts[k] + parts[k + 1]]
    return [ranks[p] for p in parts]


@pytest.mark.parametrize("seed", range(12))
def test_any_ranks(seed):
    """Vocabularies whose merges do not follow their ranks, tokens that no merge makes."""
    r = random.Random(seed)
    letters = [b"a", b"b", b"c"][:r.choice([1, 2, 3])]
    tokens = list(letters)
    while len(tokens) < r.choice([5, 12, 30]):
        t = b"".join(r.choices(tokens if r.random() < .7 else letters, k=r.choice([2, 2, 3])))
        if len(t) <= 9 and t not in tokens:
            tokens.append(t)
        elif len(letters) == 1 and len(tokens) > 6:
            break
    order = list(range(len(tokens)))
    r.shuffle(order)
    ranks = dict(zip(tokens, order))
    t = Transducer(ranks)
    for _ in range(400):
        raw = b"".join(r.choices(letters, k=r.randint(1, 25)))
        assert t.encode(raw) == merged(raw, ranks), (raw, ranks)


def test_lookahead_is_bounded():
    """Ids are committed while a long match is read, not at its end."""
    t = Transducer(RANKS)
    r = random.Random(3)
    for raw in (b"a" * 4000, b" " * 4000, b"\n" * 999, "".join(r.choice("etaoinshrdlu") for _ in range(4000)).encode(),
                "".join(r.choice("éñßаб漢字") for _ in range(1500)).encode()):
        ids, done = [], 0
        for read, new in t.stream(raw):
            ids += new
            done += sum(len(t.bytes[i]) for i in new)
            assert read - done <= 200
        assert ids == LIBRARY.encode_ordinary(raw.decode()) and done == len(raw)


def test_decoder_as_pythons():
    r = random.Random(1)
    tokens = {i: bytes(r.choices([0x41, 0x80, 0xBF, 0xC2, 0xE0, 0xE1, 0xED, 0xA0, 0x9F, 0xF0, 0x90, 0xF4, 0x8F, 0xFF, 0xC0],
                                 k=r.randint(1, 4))) for i in range(300)}
    tokens |= {300 + i: bytes([i]) for i in range(256)}
    d = Decoder(tokens)
    for _ in range(300):
        ids = [r.randrange(556) for _ in range(r.randint(0, 40))]
        got, at = "", 0
        while at < len(ids):                                 # in pieces of any length
            n = r.randint(1, 5)
            got += d.feed(ids[at:at + n])
            at += n
        assert got + d.close() == b"".join(tokens[i] for i in ids).decode("utf-8", "replace")


def rows_of():
    rows = data.rows(9, 100) + [(8000 + k, t) for k, t in enumerate(TRICKY)]
    return rows + [(8000, "again"), (8000, "again"), (None, "x")]


def test_query_as_the_library(spark):
    rows = rows_of()
    want = []
    for i, t in rows:
        if i is not None:
            ids = LIBRARY.encode_ordinary(t or "")
            want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(LIBRARY.decode_bytes(ids)).hexdigest()))
    got = round_trip(data.frame(spark, rows).repartition(3))
    assert data.result(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want)
    assert round_trip(data.frame(spark, [])).collect() == []


def test_encode_and_decode_tables(spark):
    rows = [(i, t) for i, t in rows_of() if i is not None]
    docs = data.frame(spark, rows).repartition(2)
    assert data.result(bpe.encode(docs), "doc_id", "ids") == sorted((i, LIBRARY.encode_ordinary(t or "")) for i, t in rows)
    assert data.result(bpe.decode(bpe.encode(docs)), "doc_id", "text") == sorted((i, t or "") for i, t in rows)
    assert bpe.decode(bpe.encode(data.frame(spark, []))).collect() == []
