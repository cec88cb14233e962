"""Operator 12, byte-level BPE by a lazily determinised transducer, and streaming decoding.

Encoding. A text is parted by the pattern, and each match is encoded by itself:
a match that is a token is that token, any other is merged by rank. Two tokens
are compatible if merging the bytes of both gives just these two; a sequence of
tokens is a match's encoding exactly if all neighbours are compatible (no merge
ever crosses their borders). So a prefix of a match has one last token, found
from the last tokens of shorter prefixes: a transducer whose arcs read a token's
bytes and whose states are last tokens. ``Transducer`` determinises it as input
comes: a state is the bytes read since the last committed token, and the tokens
found in them; of the places in these bytes, those that a token can still begin
at survive, and when the paths of all survivors pass one place, the tokens
before it are emitted. The last committed token itself is no part of a state:
an arc on which it matters asks whether it and the next are compatible.
How far it looks ahead is bounded by the vocabulary, not by the text. Arcs are
kept up to ``ARCS``, and as many that were used before these.

Decoding. ``Decoder`` takes ids one after the other and gives text: a state is
the bytes of an unfinished character (three at most); arcs are the steps of a
UTF-8 machine along a token's bytes, made when first needed. Bytes that belong
to no character become U+FFFD, as many as Python's decoder gives.

Texts are read whole, in windows that end where a match begins. Rows without
doc_id name no document and give no row; a null text is empty (no ids); repeated
rows are encoded once each; further columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

import gc
import hashlib
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from threadlens.llm import common as C

ARCS = 400_000                                             # of a worker's transducer
KEPT = 200_000                                               # matches with their ids that a worker keeps
WINDOW = 4 << 20                                             # bytes of text parted at once
PAIRS = 1_000_000                                            # of tokens, told compatible or not, that it keeps
NEVER = 1 << 62                                              # above all ranks
NONE: list[int] = []                                         # shared, never changed

#: The pattern whose rules ``split`` follows (a fixed value of the vocabulary).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def read_ranks(path: str) -> dict[bytes, int]:
    import base64
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


# ------------------------------------------------------------------ splitting

OTHER, LETTER, NUMBER, SPACE = range(4)


def code_point_kinds() -> np.ndarray:
    """Kind of each code point as the pattern's classes tell."""
    import regex
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    whole = "".join(map(chr, points))
    at, kind = np.array(points), np.zeros(0x110000, dtype=np.uint8)
    for name, k in (("L", LETTER), ("N", NUMBER), ("White_Space", SPACE)):
        for m in regex.finditer(rf"\p{{{name}}}+", whole):
            kind[at[m.start():m.end()]] = k
    return kind


def split(data: np.ndarray, offs: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts of all matches of concatenated documents, and their pointer by document."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype="<u4")
    begins = np.flatnonzero((data & 0xC0) != 0x80)           # byte at which each code point begins
    docs = np.searchsorted(begins, offs)
    n = len(points)
    kind = kinds[points]
    edge = np.zeros(n + 1, dtype=bool)
    edge[docs] = True                                        # a document begins (or all end) here
    change = edge[:-1].copy()
    change[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(change)
    end = np.append(run[1:], n)
    space = kind[run] == SPACE
    last = edge[end]                                         # the run ends its document
    start = np.zeros(n + 1, dtype=bool)
    # white space before other characters: all but its last character is a match, a last blank joins what follows
    start[run[space]] = True
    inner = space & ~last
    start[end[inner] - 1] = True
    joined = np.zeros(len(run), dtype=bool)
    joined[1:] = inner[:-1] & (points[end[:-1] - 1] == 0x20)
    begin = run[~space & ~joined]
    start[begin] = True
    # an apostrophe by itself and the letters of an ending after it
    mark = np.flatnonzero((points[run] == 0x27) & (end - run == 1) & ~joined & ~last)
    mark = mark[kind[run[mark + 1]] == LETTER] if len(mark) else mark
    for k in mark.tolist():
        at, stop = int(end[k]), int(end[k + 1])
        for ending in ENDINGS:
            to = at + len(ending)
            if to <= stop and all(points[at + x] == ord(c) for x, c in enumerate(ending)):
                start[at] = False
                if to < stop:
                    start[to] = True
                break
    found = np.flatnonzero(start[:-1])
    return begins[found], np.searchsorted(found, docs)


def windows(data: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Cuts of one text into about ``size`` bytes, each before a blank after a visible
    ASCII character: a match begins there whatever comes before."""
    if len(data) <= size:
        yield 0, len(data)
        return
    safe = np.flatnonzero((data[1:] == 0x20) & (data[:-1] > 0x20) & (data[:-1] < 0x7F)) + 1
    at = 0
    while at < len(data):
        k = int(np.searchsorted(safe, at + size, side="right"))
        to = int(safe[k - 1]) if k and safe[k - 1] > at else int(safe[k]) if k < len(safe) else len(data)
        yield at, to
        at = to


# ----------------------------------------------------------------- transducer


class _State:
    """Bytes ``held`` since the last committed token; ``node``: the longest ending of
    them that begins a token. ``path``: for each place among the bytes that the path of
    a survivor passes, the token that ends there times 256, plus its bytes (0 at others
    and at place 0). ``rest``: ids still due if the input ends here. ``name``: a
    multiple of 256; with a byte it names an arc."""

    __slots__ = ("name", "held", "node", "path", "rest")

    def __init__(self, name: int, held: bytes, node: int, path: list[int]):
        self.name, self.held, self.node, self.path = name, held, node, path
        self.rest = _tokens(path, len(held))


def _tokens(path: list[int], place: int) -> list[int]:
    """Ids on the path from place 0 to ``place``."""
    out = []
    while place > 0:
        out.append(path[place] >> 8)
        place -= path[place] & 255
    out.reverse()
    return out


class Transducer:
    """Encodes matches by the ranks of a vocabulary (tokens of 255 bytes at most).

    The beginnings of tokens form a trie. The survivors of a state are the endings
    of its bytes that begin a longer token: the trie node of the longest, and those
    that its falls (to the next shorter ending in the trie) pass.
    """

    def __init__(self, ranks: dict[bytes, int], arcs: int = ARCS):
        if max(map(len, ranks), default=0) > 255:
            raise ValueError("tokens of more than 255 bytes")
        self.ranks, self.most = ranks, arcs
        self.bytes = {r: t for t, r in ranks.items()}
        self.child: dict[int, int] = {}                      # node * 256 + byte to node
        token, depth, inner, parent = [-1], [0], [True], [0]
        for raw in sorted(ranks):                            # beginnings before what they begin
            node = 0
            for k, byte in enumerate(raw):
                inner[node] = True
                to = self.child.get(node << 8 | byte)
                if to is None:
                    to = self.child[node << 8 | byte] = len(token)
                    token.append(-1)
                    depth.append(k + 1)
                    inner.append(False)
                    parent.append(node << 8 | byte)
                node = to
            token[node] = ranks[raw]
        fall = [0] * len(token)
        # of each node: (bytes, token) of the tokens, and bytes of the survivors, the longest first
        self.ends: list[tuple] = [()] * len(token)
        self.lives: list[tuple] = [()] * len(token)
        for node in sorted(range(1, len(token)), key=depth.__getitem__):
            if depth[node] > 1:
                up, byte = fall[parent[node] >> 8], parent[node] & 255
                while up and up << 8 | byte not in self.child:
                    up = fall[up]
                fall[node] = self.child.get(up << 8 | byte, 0)
            self.ends[node] = (((depth[node], token[node]),) if token[node] >= 0 else ()) + self.ends[fall[node]]
            self.lives[node] = ((depth[node],) if inner[node] else ()) + self.lives[fall[node]]
        self.fall = fall
        self.fits: dict[int, bool] = {}
        self.steps: dict[int, tuple | None] = {}
        self.names = 0
        self.table: dict[tuple, _State] = {}
        self.old_table: dict[tuple, _State] = {}
        # (state, its name, committed ids), or a list: token to ask for, such arcs for no and yes
        self.arcs: dict[int, tuple | list] = {}
        self.root = self._state(b"", 0, [0])
        self._turn()

    def _state(self, held: bytes, node: int, path: list[int]) -> _State:
        key = (held, *path)
        state = self.table.get(key) or self.old_table.get(key)
        if state is None:
            self.names += 256
            state = _State(self.names, held, node, path)
        self.table[key] = state
        return state

    def _turn(self):
        """Begin new tables; of the old ones, what is asked for again is taken over."""
        self.old_table, self.old_arcs = self.table, self.arcs
        self.table, self.arcs = {}, {}

    def merges(self, raw: bytes) -> tuple[list[bytes], list[tuple[int, bytes, bytes]]]:
        """Merging the lowest rank, leftmost first: the parts left, and for each merge
        its rank with the first and last part before it."""
        parts, done = [raw[k:k + 1] for k in range(len(raw))], []
        while True:
            least, at = None, 0
            for k in range(len(parts) - 1):
                r = self.ranks.get(parts[k] + parts[k + 1])
                if r is not None and (least is None or r < least):
                    least, at = r, k
            if least is None:
                return parts, done
            done.append((least, parts[0], parts[-1]))
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _inside(self, token: int):
        """Of a token that merging its bytes gives: ranks of its merges, the first part
        and the last part before each and at the end. None of other tokens."""
        got = self.steps.get(token, 0)
        if got == 0:
            raw = self.bytes[token]
            parts, done = self.merges(raw)
            got = self.steps[token] = (
                ([r for r, _, _ in done] + [NEVER], [a for _, a, _ in done] + [raw], [z for _, _, z in done] + [raw])
                if len(parts) == 1 else None)
        return got

    def compatible(self, before: int, token: int) -> bool:
        """May ``token`` follow ``before`` (-1: nothing) in an encoding? The merges inside
        both take place in order of rank; none may be preceded by one across the border."""
        key = before << 32 | token
        ok = self.fits.get(key)
        if ok is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            self.fits[key] = ok = self._border_holds(before, token)
        return ok

    def _border_holds(self, before: int, token: int) -> bool:
        right = self._inside(token)
        if before < 0 or right is None:
            return right is not None
        left_rank, _, left_part = self._inside(before)
        right_rank, right_part, _ = right
        i = j = 0
        while True:
            a, b = left_rank[i], right_rank[j]
            across = self.ranks.get(left_part[i] + right_part[j])
            if across is not None and across < a and across <= b:
                return False
            if a <= b:
                if a == NEVER:
                    return True
                i += 1
            else:
                j += 1

    def _arc(self, state: _State, byte: int) -> tuple | list:
        """The arc of a byte; kept for the next time. If all bytes since the last committed
        token are a token, it depends on whether that one may follow."""
        name = state.name | byte
        arc = self.old_arcs.get(name)
        if arc is None:
            to = self._fallen(state.node, byte)
            here = len(state.held) + 1
            whole = next((token for length, token in self.ends[to] if length == here), None)
            arc = self._made(state, byte, False) if whole is None else [whole, None, None]
        self.arcs[name] = arc
        return arc

    def _fallen(self, node: int, byte: int) -> int:
        to = self.child.get(node << 8 | byte)
        while to is None:
            node = self.fall[node]
            to = self.child.get(node << 8 | byte)
        return to

    def _made(self, state: _State, byte: int, whole: bool) -> tuple[_State, int, list[int]]:
        """The state after ``byte`` with its name, and the ids committed; ``whole``: all
        bytes since the last committed token are a token that may follow it."""
        held = state.held + bytes((byte,))
        here = base = len(held)
        to = self._fallen(state.node, byte)
        path, found = state.path, 0
        for length, token in self.ends[to]:
            if whole if length == here else length < here and self.compatible(path[here - length] >> 8, token):
                found = token << 8 | length
                break
        path = [*path, found]
        # the furthest place that the paths of all survivors pass is committed
        lives = self.lives[to]
        for length in lives:
            place = here - length
            while place != base:
                if place > base:
                    place -= path[place] & 255
                else:
                    base -= path[base] & 255
        passed = [0] * (here + 1 - base)
        for length in (*lives, 0):
            place = here - length
            while place > base and not passed[place - base]:
                passed[place - base] = path[place]
                place -= path[place] & 255
        after = self._state(held[base:], to, passed)
        return after, after.name, _tokens(path, base) if base else NONE

    def stream(self, raw: bytes) -> Iterator[tuple[int, list[int]]]:
        """(bytes read, ids committed by them) along a match that is no token itself."""
        state, before, fits = self.root, -1, self.fits
        for lo in range(0, len(raw), 1000):
            if len(self.arcs) >= self.most:
                self._turn()
            known, name = self.arcs.get, state.name
            for k, byte in enumerate(raw[lo:lo + 1000], lo + 1):
                arc = known(name | byte) or self._arc(state, byte)
                if arc.__class__ is list:
                    ok = fits.get(before << 32 | arc[0])
                    if ok is None:
                        ok = self.compatible(before, arc[0])
                    if arc[1 + ok] is None:
                        arc[1 + ok] = self._made(state, byte, ok)
                    arc = arc[1 + ok]
                state, name, ids = arc
                if ids:
                    before = ids[-1]
                    yield k, ids
        yield len(raw), state.rest

    def encode(self, raw: bytes) -> list[int]:
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        if len(raw) > 100 or len(self.arcs) >= self.most:
            return [i for _, ids in self.stream(raw) for i in ids]
        # the same steps for the many short matches
        state, before, out = self.root, -1, []
        known, fits, name = self.arcs.get, self.fits, state.name
        for byte in raw:
            arc = known(name | byte) or self._arc(state, byte)
            if arc.__class__ is list:
                ok = fits.get(before << 32 | arc[0])
                if ok is None:
                    ok = self.compatible(before, arc[0])
                if arc[1 + ok] is None:
                    arc[1 + ok] = self._made(state, byte, ok)
                arc = arc[1 + ok]
            state, name, ids = arc
            if ids:
                before = ids[-1]
                out += ids
        out += state.rest
        return out


class Matches(dict):
    """Ids of matches as (little-endian 32-bit, decimal separated by commas); those
    seen of late are kept, ``most`` to twice as many."""

    def __init__(self, ranks: dict[bytes, int], most: int = KEPT):
        super().__init__()
        self.transducer, self.most, self.older = Transducer(ranks), most, {}

    def __missing__(self, match: bytes) -> tuple[bytes, bytes]:
        got = self.older.get(match)
        if got is None:
            ids = self.transducer.encode(match)
            got = (array("I", ids).tobytes(), ",".join(map(str, ids)).encode())
        if len(match) <= 64:                                 # longer ones are rare and large
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[match] = got
        return got


# ------------------------------------------------------------------- decoding

_TAIL = (0x80, 0xBF)
#: Well-formed UTF-8 (fixed values): first bytes, then the range of each further byte.
_FORMS = [((0x00, 0x7F), ()), ((0xC2, 0xDF), (_TAIL,)),
          ((0xE0, 0xE0), ((0xA0, 0xBF), _TAIL)), ((0xE1, 0xEC), (_TAIL, _TAIL)),
          ((0xED, 0xED), ((0x80, 0x9F), _TAIL)), ((0xEE, 0xEF), (_TAIL, _TAIL)),
          ((0xF0, 0xF0), ((0x90, 0xBF), _TAIL, _TAIL)), ((0xF1, 0xF3), (_TAIL, _TAIL, _TAIL)),
          ((0xF4, 0xF4), ((0x80, 0x8F), _TAIL, _TAIL))]
_FIRST = {b: further for (lo, hi), further in _FORMS for b in range(lo, hi + 1)}


def utf8_step(held: bytes, due: tuple, byte: int) -> tuple[bytes, tuple, str]:
    """One step of the UTF-8 machine: (bytes of an unfinished character, ranges of the
    bytes it still needs, text that this byte completes)."""
    text = ""
    if due:
        if due[0][0] <= byte <= due[0][1]:
            held += bytes([byte])
            return (held, due[1:], "") if len(due) > 1 else (b"", (), held.decode())
        text = "�"                                      # the unfinished one ends here
    further = _FIRST.get(byte)
    if further is None:
        return b"", (), text + "�"
    return (bytes([byte]), further, text) if further else (b"", (), text + chr(byte))


class _Unfinished(dict):
    """Arcs of one state, by id: (next state, text)."""

    def __init__(self, decoder: Decoder, held: bytes, due: tuple):
        super().__init__()
        self.decoder, self.held, self.due = decoder, held, due

    def __missing__(self, token: int):
        held, due, out = self.held, self.due, []
        for byte in self.decoder.bytes[token]:
            held, due, text = utf8_step(held, due, byte)
            out.append(text)
        arc = self[token] = (self.decoder.state(held, due), "".join(out))
        return arc


class Decoder:
    """Text of ids, in pieces as they come."""

    def __init__(self, tokens: dict[int, bytes]):
        self.bytes, self.states = tokens, {}
        self.at = self.state(b"", ())

    def state(self, held: bytes, due: tuple) -> _Unfinished:
        found = self.states.get(held)
        if found is None:
            if len(self.states) > 1000:                      # unfinished characters of large alphabets
                self.states.clear()
            found = self.states[held] = _Unfinished(self, held, due)
        return found

    def feed(self, ids: list[int]) -> str:
        at, out = self.at, []
        for i in ids:
            at, text = at[i]
            out.append(text)
        self.at = at
        return "".join(out)

    def close(self) -> str:
        """What is left at the end; the decoder is ready for other ids."""
        left = "�" if self.at.due else ""
        self.at = self.state(b"", ())
        return left


# ------------------------------------------------------------------ documents


class _Worker:
    def __init__(self, path: str):
        ranks = read_ranks(path)
        self.kinds = code_point_kinds()
        self.matches = Matches(ranks)
        self.decoder = Decoder({r: t for t, r in ranks.items()})

    def encoded(self, data: np.ndarray, offs: np.ndarray) -> Iterator[tuple[int, list, bool]]:
        """(document, ids of some of its matches in order, whether these end it)."""
        for i, j in C.pieces(offs, WINDOW):
            part = data[offs[i]:offs[j]]
            cuts = list(windows(part, WINDOW)) if j == i + 1 else [(0, len(part))]
            for lo, hi in cuts:
                window = part[lo:hi]
                starts, ptr = split(window, np.array([0, hi - lo]) if j == i + 1 else offs[i:j + 1] - offs[i], self.kinds)
                raw, at = window.tobytes(), starts.tolist()
                matches = self.matches
                got = [matches[raw[s:e]] for s, e in zip(at, [*at[1:], len(raw)])]
                for d in range(i, j):
                    yield d, got[ptr[d - i]:ptr[d - i + 1]], hi == len(part)


def _state(path: str) -> str:
    return "bpe_" + "".join(c if c.isalnum() else "_" for c in path)


def _worker(path: str) -> _Worker:
    return C.worker_state(_state(path), lambda: _Worker(path))


def _kept(run, path: str):
    """``run`` of mapInArrow in a worker that keeps its tables from task to task, and
    nothing of other operators; without the cycle collector, which would walk the
    tables (they hold no cycles) again and again."""
    mine = _state(path)

    def task(batches):
        held = sys.modules.get(C.WORKER_STATE)
        for name in [n for n in vars(held) if not n.startswith("__") and n != mine] if held else []:
            delattr(held, name)
        gc.disable()
        try:
            yield from run(batches)
        finally:
            gc.enable()
            C.give_back()
    return task


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) of every document."""
    path = path or default_ranks()

    def run(batches):
        worker = _worker(path)
        for batch in batches:
            data, offs = C.strings(batch.column(1))
            held: list[bytes] = []
            for d, got, end in worker.encoded(data, offs):
                held += [ids for ids, _ in got]
                if end:
                    ids = np.frombuffer(b"".join(held), dtype="<i4")
                    held = []
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(d, 1), pa.array([ids], pa.list_(pa.int32()))],
                                                     names=["doc_id", "ids"])

    C.small_batches(docs.sparkSession)
    return C.whole(docs).mapInArrow(_kept(run, path), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids)."""
    path = path or default_ranks()

    def run(batches):
        decoder = _worker(path).decoder
        for batch in batches:
            texts = []
            for ids in batch.column(1):
                texts.append(decoder.feed(ids.as_py() or []) + decoder.close())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    C.small_batches(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(_kept(run, path), "doc_id long, text string")


ROUND_TRIP = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Every document's number of ids, the digest of the ids, and that of the text
    decoded from them; a document's ids are passed on match by match."""
    path = path or default_ranks()

    def run(batches):
        worker = _worker(path)
        decoder = worker.decoder
        for batch in batches:
            data, offs = C.strings(batch.column(1))
            rows: list[tuple] = []
            n, ids_sha, text_sha = 0, hashlib.sha256(), hashlib.sha256()
            for _, got, end in worker.encoded(data, offs):
                if got:
                    if n:
                        ids_sha.update(b",")
                    ids_sha.update(b",".join([text for _, text in got]))
                    ids = np.frombuffer(b"".join([raw for raw, _ in got]), dtype="<u4")
                    n += len(ids)
                    text_sha.update(decoder.feed(ids.tolist()).encode())
                if end:
                    text_sha.update(decoder.close().encode())
                    rows.append((n, ids_sha.hexdigest(), text_sha.hexdigest()))
                    n, ids_sha, text_sha = 0, hashlib.sha256(), hashlib.sha256()
            counts, ids_hex, text_hex = map(list, zip(*rows)) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()),
                                              pa.array(text_hex, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    C.small_batches(docs.sparkSession)
    return C.whole(docs).mapInArrow(_kept(run, path), ROUND_TRIP)
