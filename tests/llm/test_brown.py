import math
import zlib
from collections import Counter

import pytest

from tests.llm import brute, data
from threadlens.llm.brown import _model, class_scores


def held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def expected_base(rs):
    toks = {i: brute.WORD.findall(brute.low(t)) + [None] for i, t in rs}
    c = Counter(x for i, w in toks.items() if not held(i) for x in w)
    n, v = sum(c.values()), len(c)
    return sorted((i, held(i), len(w), sum(x in c for x in w), n,
                   round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)) for i, w in toks.items())


@pytest.mark.parametrize("sweeps", [1, 2, 3])
def test_base_counts_and_perplexity(spark, sweeps):
    rs = data.rows(21, 150)
    df = data.frame(spark, [*rs, (None, "nobody")]).repartition(4)
    got = class_scores(df, classes=16, sweeps=sweeps).collect()
    assert sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                  for r in got) == expected_base(rs)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_model_sums_to_one():
    import numpy as np
    r = np.random.default_rng(1)
    k = 5
    cells = r.integers(0, 9, (k + 2, k + 2))
    p = 10 ** _model(cells, k, 1.0)
    size = cells[:k + 1, :k].sum(0)
    total = (p[:, :k] * size).sum(1) + p[:, k] + p[:, k + 1]  # words by class count, end, unseen
    assert np.allclose(total, 1)


def test_empty_tables(spark):
    assert class_scores(data.frame(spark, []), classes=4).collect() == []
    only = next(i for i in range(100) if held(i))
    got = class_scores(data.frame(spark, [(only, "a b")]), classes=4).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(3, 0, 0, 0.0, 0.0)]


def test_both_halves_move_after_the_first_sweep(spark, monkeypatch):
    from threadlens.llm import brown
    seen, real = [], brown._exchange

    def noted(cells, k, half):
        seen.append((k, half))
        return real(cells, k, half)

    monkeypatch.setattr(brown, "_exchange", noted)
    df = data.frame(spark, data.rows(22, 40))
    class_scores(df, sweeps=3).collect()
    assert seen == [(128, 0), (128, 1), (128, 2), (128, 1), (128, 2)]


def test_halves_make_the_moves_of_all():
    import numpy as np

    from threadlens.llm import brown
    from threadlens.llm import common as C
    texts = [(t or "").encode() for t in data.texts(23, 60)]
    offs = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    w = brown._Words(C.Chunk(np.arange(len(texts)), offs, np.frombuffer(b"".join(texts), np.uint8)), 16, 7, 2)
    moved = {}
    for half in (0, 1, 2):
        ask = list(w.questions(1))
        rows = brown._exchange(w.cells(), 16, half)(brown.WORD, [0], [ask[0][2]])
        moved[half] = C.unblob(rows[1][3], np.uint8, np.int64)[0].astype(int)
    own = w.cls[w.deal(1)[0]]
    one, two = moved[1] != own, moved[2] != own
    assert one.any() and two.any() and not (one & two).any()
    assert (np.where(one, moved[1], moved[2]) == moved[0]).all()
