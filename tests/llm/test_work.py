"""Work done once, bytes sent once."""

import numpy as np

from threadlens.llm import brown, parsing
from threadlens.llm import common as C


def _chunk(texts):
    raw = [t.encode() for t in texts]
    offs = np.cumsum([0, *map(len, raw)]).astype(np.int64)
    return C.Chunk(np.arange(len(raw), dtype=np.int64), offs, np.frombuffer(b"".join(raw), np.uint8))


def test_brown_asks_while_it_deals(spark, monkeypatch):
    asks, dealt = [], C.chunked
    monkeypatch.setattr(C, "chunked", lambda docs, size, ask, *extra: asks.append(ask) or dealt(docs, size, ask, *extra))
    docs = spark.createDataFrame([(1, "a b a"), (2, None), (3, "b c")], "doc_id long, text string")
    assert brown.class_scores(docs, classes=4).count() == 3
    kinds = [row[0] for row in asks[0](_chunk(["a b a", "b c"] * 4))]
    assert kinds[0] == brown.CELLS and brown.WORD in kinds
    assert [row[0] for row in asks[0](_chunk(["", ""]))] == [brown.CELLS]


def test_brown_cells_count_every_bigram():
    chunk = _chunk([f"a b{i % 3} A" for i in range(20)])
    w = brown._Words(chunk, 4, 7, 2)
    held = brown.is_held_out(np.arange(20), 7, 2)
    cells = w.cells()
    assert cells.sum() == 4 * (~held).sum()                  # three words and an end
    assert cells[4, :4].sum() == cells[:4, 4].sum() == (~held).sum()
    assert w.values.size == 4 and (w.values[w.word] == C.words(chunk.data, chunk.offs, lower=True)[2]).all()


def test_suffixes_are_sent_compressed():
    words = [f"word{i % 40} follows" for i in range(4000)]
    p = parsing._Parse(_chunk([" ".join(words)]), 50, 24, 8)
    runs = np.arange(len(p.mark))
    sent = sum(len(x) for _, _, x in parsing._send_suffixes(p, runs, 16))
    assert len(runs) and sent < len(runs) * (2 * 50 - 24)     # less than the windows' bytes alone
