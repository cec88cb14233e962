"""Operator 5, SentencePiece encoding and decoding by streaming Viterbi.

A text is escaped as SentencePiece does (a space before it, spaces as U+2581)
and cut into the pieces of greatest total score; of equal totals the longest
last piece wins. A character that is no piece costs ten less than the least
score and becomes its UTF-8 bytes.

Scores are unigram log probabilities of the model's pieces: the model is a BPE
model, whose own scores are merge ranks and mean nothing when added up. A first
job counts the pieces over all documents, as the model's library cuts them; a
piece seen n times of N scores log((n + 1/2) / (N + V/2)), V the number of
pieces, rounded to 2^-20. So the vocabulary is the model's, and the ids are those of a unigram
model: they may differ from what BPE merges give (README: how often).

``stream`` reads characters one by one and keeps scores for a window of the
longest piece; whenever the paths behind all positions of the window meet in
one boundary, everything before it is committed, so memory does not grow with
the text. No piece holds a U+2581 after another character, so paths always
meet before a space: the text falls into segments (spaces and a word), and
each distinct segment of a block is solved once. Segments shorter than two longest
pieces, of which ``stream`` commits nothing before the end, are solved many at a time by the
same recurrence: a trie of the pieces is walked from every character at once, and
totals are handed forwards place by place. Longer ones go through ``stream``.

Decoding joins the pieces, turns byte pieces into bytes and drops the first
space. Null text is empty: no ids. Rows without doc_id name no document and give no
row; each of repeated rows gives its own; an empty table gives no rows. A text that itself holds U+2581 decodes to a
space there (as in SentencePiece), and ``round_trip`` is false.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm import common as C

SPACE = "▁"


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """Pieces of a model file, with its scores or those given (by id)."""

    def __init__(self, path: str, scores: np.ndarray | None = None):
        import sentencepiece
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score, self.bytes_of, self.byte_id = {}, [], {}
        for i in range(m.get_piece_size()):
            piece, raw = m.id_to_piece(i), b""
            if m.is_byte(i):
                raw = bytes([int(piece[3:5], 16)])
                self.byte_id[raw[0]] = i
            elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
                self.score[piece] = (m.get_score(i) if scores is None else float(scores[i]), i)
                raw = piece.replace(SPACE, " ").encode()
            self.bytes_of.append(raw)
        self.longest = max(map(len, self.score))
        self.missing = min(s for s, _ in self.score.values()) - 10.0

    def fallback(self, char: str) -> list[int]:
        return [self.byte_id[b] for b in char.encode()]


def stream(chars: Iterable[str], p: Pieces) -> Iterator[int]:
    """Ids of the best path, committed as soon as all surviving paths agree."""
    window = ""                                              # the last characters
    best = {0: 0.0}                                          # position: score, for the window
    back: dict[int, tuple[int, list[int]]] = {}              # position: previous one, ids; uncommitted part
    done = at = 0

    def path(end):
        out = []
        while end > done:
            end, ids = back[end]
            out.append(ids)
        return [i for ids in reversed(out) for i in ids]

    for char in chars:
        at += 1
        window = (window + char)[-p.longest:]
        top = None
        for size in range(len(window), 0, -1):
            start = at - size
            if start < done or start not in best:
                continue
            hit = p.score.get(window[-size:])
            if hit is None:
                if size > 1:
                    continue
                hit = (p.missing, None)
            total = best[start] + hit[0]
            if top is None or total > top[0]:
                top = (total, start, [hit[1]] if hit[1] is not None else p.fallback(char))
        best[at], back[at] = top[0], (top[1], top[2])
        best.pop(at - p.longest, None)
        if at - done >= 2 * p.longest:
            alive = set(best)                                # where do their paths meet?
            while len(alive) > 1:
                last = max(alive)
                alive.remove(last)
                alive.add(back[last][0] if last > done else done)
            meet = alive.pop()
            if meet > done:
                yield from path(meet)
                done = meet
                back = {k: v for k, v in back.items() if k > done}
    yield from path(at)


class Trie:
    """Pieces by their characters; children in an open hash table of (node, character)."""

    def __init__(self, pieces: dict[str, tuple[float, int]]):
        children: dict[int, int] = {}
        ends = {}
        for piece, (score, i) in pieces.items():
            node = 0
            for c in piece:
                node = children.setdefault(node << 21 | ord(c), len(children) + 1)
            ends[node] = (score, i)
        self.id = np.full(len(children) + 1, -1, dtype=np.int32)
        self.score = np.zeros(len(children) + 1)
        at = np.fromiter(ends, np.int64, len(ends))
        self.score[at], self.id[at] = zip(*ends.values())
        bits = max(int(4 * len(children)).bit_length(), 4)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.key = np.full(1 << bits, -1, dtype=np.int64)
        self.child = np.full(1 << bits, -1, dtype=np.int32)
        key = np.fromiter(children, np.int64, len(children))
        value = np.fromiter(children.values(), np.int32, len(children))
        place = self._place(key)
        while len(key):                                      # the first at a free place takes it, others go on
            free = np.flatnonzero(self.key[place] == -1)
            _, first = np.unique(place[free], return_index=True)
            won = free[first]
            self.key[place[won]], self.child[place[won]] = key[won], value[won]
            rest = np.ones(len(key), dtype=bool)
            rest[won] = False
            key, value, place = key[rest], value[rest], (place[rest] + 1) & self.mask

    def _place(self, key: np.ndarray) -> np.ndarray:
        return (C.mix(key.astype(np.uint64)) >> self.shift).astype(np.int64)

    def step(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Children of nodes by a character each, -1 where there is none."""
        key = node.astype(np.int64) << 21 | code
        place = self._place(key)
        out, there = self.child[place], self.key[place]
        open_ = np.flatnonzero((there != key) & (there != -1))
        out[there != key] = -1
        while len(open_):
            place[open_] = (place[open_] + 1) & self.mask
            there = self.key[place[open_]]
            hit = there == key[open_]
            out[open_[hit]] = self.child[place[open_[hit]]]
            open_ = open_[~hit & (there != -1)]
        return out


class Encoder(C.Memo):
    """Ids of segments (UTF-8, spaces as U+2581)."""

    def __init__(self, path: str, scores: np.ndarray | None = None):
        self.p = Pieces(path, scores)
        self.trie = Trie(self.p.score)
        super().__init__()

    def encode(self, words):
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))[ends]
        size = np.diff(chars, prepend=0)
        out: list = [None] * len(words)
        fits = size < 2 * self.p.longest
        short = np.flatnonzero(fits).tolist()
        for i, ids in zip(short, self._lock_step([words[i] for i in short], size[short])):
            out[i] = ids
        for i in np.flatnonzero(~fits).tolist():
            out[i] = array("I", stream(words[i].decode(), self.p)).tobytes()
        return out

    def _edges(self, flat, left):
        """All pieces in the texts: (place of the first character, length, score, id); ``left``:
        characters from each place to the end of its text. The work follows the matches."""
        at = np.arange(len(flat))
        node = np.zeros(len(flat), dtype=np.int32)
        none = np.ones(len(flat), dtype=bool)                # single characters that are no piece
        found, length = [], 0
        while len(at):
            node = self.trie.step(node, flat[at + length])
            length += 1
            on = node >= 0
            at, node = at[on], node[on]
            i = self.trie.id[node]
            ends = i >= 0
            if length == 1:
                none[at[ends]] = False
            found.append((at[ends], np.full(int(ends.sum()), length), self.trie.score[node[ends]], i[ends]))
            more = left[at] > length
            at, node = at[more], node[more]
        at = np.flatnonzero(none)
        found.append((at, np.ones(len(at), dtype=np.int64), np.full(len(at), self.p.missing),
                      np.full(len(at), -1, dtype=np.int32)))
        return [np.concatenate(x) for x in zip(*found)]

    def _lock_step(self, words: list[bytes], size: np.ndarray) -> list[bytes]:
        """The best paths of many texts at once, forwards from each place; the same totals and
        choices as ``stream``."""
        n = len(words)
        flat = np.frombuffer(b"".join(words).decode().encode("utf-32-le"), dtype="<u4").astype(np.int64)
        first = np.cumsum(size) - size
        row = np.repeat(np.arange(n), size)
        inside = np.arange(len(flat)) - first[row]
        start, length, score, piece = self._edges(flat, size[row] - inside)
        order = np.argsort(inside[start].astype(np.int16), kind="stable")
        start, length, score, piece = start[order], length[order], score[order], piece[order]
        cuts = np.searchsorted(inside[start], np.arange(int(size.max(initial=0)) + 1)).tolist()
        source = start + row[start]                          # a text of k characters has k + 1 places
        target = source + length
        best = np.full(len(flat) + n, -np.inf)
        prev = np.zeros(len(flat) + n, dtype=np.int64)
        pick = np.full(len(flat) + n, -1, dtype=np.int64)
        zero = first + np.arange(n)
        best[zero] = 0
        for a, b in zip(cuts[:-1], cuts[1:]):
            total = best[source[a:b]] + score[a:b]
            better = total > best[target[a:b]]               # longer last pieces come first and win ties
            to = target[a:b][better]
            best[to], prev[to], pick[to] = total[better], source[a:b][better], piece[a:b][better]
        end, who = zero + size, np.arange(n)
        rows, ids, chars = [], [], []
        while True:
            on = end > zero[who]
            end, who = end[on], who[on]
            if not len(end):
                break
            rows.append(who)
            ids.append(pick[end])
            end = prev[end]
            chars.append(end - who)                          # place of the piece's first character
        if not rows:
            return [b""] * n
        rows, ids, chars = np.concatenate(rows), np.concatenate(ids), np.concatenate(chars)
        order = np.lexsort((chars, rows))
        rows, ids, chars = rows[order], ids[order], chars[order]
        lost = np.flatnonzero(ids < 0)
        if len(lost):                                        # characters that are no piece: their bytes
            own = [self.p.fallback(chr(c)) for c in flat[chars[lost]].tolist()]
            times = np.ones(len(ids), dtype=np.int64)
            times[lost] = [len(x) for x in own]
            rows, ids = np.repeat(rows, times), np.repeat(ids, times)
            ids[ids < 0] = [i for x in own for i in x]
        raw = ids.astype("<u4").tobytes()
        bounds = (4 * np.searchsorted(rows, np.arange(n + 1))).tolist()
        return [raw[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


_ONLY_SPACE = np.zeros(256, dtype=bool)
_ONLY_SPACE[0x20] = True


def _segments(data: np.ndarray, offs: np.ndarray):
    """Distinct segments of documents; for each word, then for each document's
    end, the place of its segment; the words' documents."""
    starts, ends, h, ptr = C.words(data, offs, lower=False, space=_ONLY_SPACE)
    docs, count = len(offs) - 1, np.diff(ptr)
    doc = np.repeat(np.arange(docs), count)
    before = starts - np.concatenate(([0], ends[:-1]))[:len(starts)] if len(starts) else starts.copy()
    first = ptr[:-1][count > 0]
    before[first] = starts[first] - offs[:-1][count > 0] + 1     # the added space
    # what a document ends with: spaces only
    tail = np.diff(offs) + 1
    last = ptr[1:][count > 0] - 1
    tail[count > 0] = offs[1:][count > 0] - ends[last]
    tail[np.diff(offs) == 0] = 0                                 # empty text: nothing
    key = np.concatenate([C.mix(h + C.mix(before.astype(np.uint64))), C.mix(tail.astype(np.uint64))])
    _, at, inverse = np.unique(key, return_index=True, return_inverse=True)
    raw, mark, n = data.tobytes(), SPACE.encode(), len(h)
    words = []
    for i in at.tolist():
        if i < n:
            words.append(mark * int(before[i]) + raw[starts[i]:ends[i]])
        else:
            words.append(mark * int(tail[i - n]))
    if mark in raw:                                          # a U+2581 may be one of the text: equal segments
        place: dict[bytes, int] = {}
        inverse = np.array([place.setdefault(w, len(place)) for w in words], dtype=np.int64)[inverse]
        words = list(place)
    return words, inverse, doc


def encode(data: np.ndarray, offs: np.ndarray, encoder: Encoder) -> tuple[np.ndarray, np.ndarray]:
    """Ids of documents and their pointer."""
    words, inverse, doc = _segments(data, offs)
    docs = len(offs) - 1
    slot = encoder.slots(words)[inverse]
    order = np.argsort(np.concatenate([doc * 2, np.arange(docs) * 2 + 1]), kind="stable")
    ids = encoder.gather(slot[order])
    size = (encoder.ptr[slot + 1] - encoder.ptr[slot])
    per_doc = np.bincount(np.concatenate([doc, np.arange(docs)]), weights=size, minlength=docs).astype(np.int64)
    return ids, np.concatenate(([0], np.cumsum(per_doc)))


def decode(ids: np.ndarray, ptr: np.ndarray, pieces: Pieces) -> list[bytes]:
    """UTF-8 texts of id lists (ids[ptr[i]:ptr[i+1]])."""
    table = pieces.bytes_of
    out = []
    for lo, hi in zip(ptr[:-1].tolist(), ptr[1:].tolist()):
        raw = b"".join([table[i] for i in ids[lo:hi].tolist()])
        out.append(raw[1:] if raw[:1] == b" " else raw)
    return out


class Merges(C.Memo):
    """Ids of segments as the model's own library cuts them."""

    def __init__(self, path: str):
        import sentencepiece
        self.m = sentencepiece.SentencePieceProcessor(model_file=path)
        super().__init__()

    def encode(self, words):
        texts = [w.decode()[1:].replace(SPACE, " ") for w in words]     # the library adds the first space
        out: list = [b""] * len(words)
        some = [i for i, w in enumerate(words) if w]
        for i, ids in zip(some, self.m.encode([texts[i] for i in some], out_type=int, num_threads=1)):
            out[i] = array("I", ids or [self.m.piece_to_id(SPACE)]).tobytes()     # one space: no text is left
        return out


def _state(kind: str, path: str) -> str:
    return f"{kind}_" + "".join(c if c.isalnum() else "_" for c in path)


def piece_scores(docs: DataFrame, path: str) -> np.ndarray:
    """Log probability of each piece id, counted over all documents."""
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    size = m.get_piece_size()
    plain = np.array([not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))
                      for i in range(size)])

    def count(batches):
        merges = C.worker_state(_state("merges", path), lambda: Merges(path))
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            data, offs = C.strings(batch.column(1))
            for i, j in C.pieces(offs, 4 << 20):
                words, inverse, _ = _segments(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                slot = merges.slots(words)
                often = np.repeat(np.bincount(inverse, minlength=len(words)), merges.ptr[slot + 1] - merges.ptr[slot])
                total += np.bincount(merges.gather(slot), weights=often, minlength=size).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"piece": at, "n": total[at]})

    rows = C.whole(docs).mapInArrow(count, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(size)
    n[rows["piece"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    # multiples of 2^-20: totals are exact, so ties are the same wherever a text is cut
    return np.round(np.log((n + 0.5) / (n[plain].sum() + 0.5 * plain.sum())) * (1 << 20)) / (1 << 20)


RESULT = "doc_id long, n_ids long, ids_crc32 long, n_bytes long, round_trip boolean"


def sentencepiece_ids(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Per document: doc_id, n_ids, ids_crc32, n_bytes, round_trip (and the ids)."""
    path = path or default_model()
    scores = piece_scores(docs, path)
    state = f"{_state('pieces', path)}_{zlib.crc32(scores.tobytes())}"

    def run(batches):
        encoder = C.worker_state(state, lambda: Encoder(path, scores))
        for batch in batches:
            doc_ids = np.asarray(batch.column(0))
            data, offs = C.strings(batch.column(1))
            for i, j in C.pieces(offs, 4 << 20):
                part, o = data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
                ids, ptr = encode(part, o, encoder)
                raw, four = part.tobytes(), memoryview(ids.astype("<u4").tobytes())
                back = decode(ids, ptr, encoder.p)
                cols = {"doc_id": doc_ids[i:j], "n_ids": np.diff(ptr),
                        "ids_crc32": [zlib.crc32(four[4 * a:4 * b]) for a, b in zip(ptr[:-1], ptr[1:])],
                        "n_bytes": np.diff(o),
                        "round_trip": [raw[a:b] == t for a, b, t in zip(o[:-1], o[1:], back)]}
                if with_ids:
                    cols["ids"] = [ids[a:b].astype(np.int64) for a, b in zip(ptr[:-1], ptr[1:])]
                yield pa.RecordBatch.from_pydict(cols)

    return C.whole(docs).mapInArrow(run, RESULT + (", ids array<long>" if with_ids else ""))
