"""Byte-level BPE as a finite-state transducer, and streaming decode.

The rank file is compiled to a prefix table of its tokens. The transducer reads a piece (one match of the
split pattern) byte by byte. Its state holds every way in which a token may still be open: where that token
began, the token before it, and the tokens closed but not yet emitted. A token may follow another exactly if
merging their joint bytes gives the two of them back, which makes the encoding of every prefix unique; so the
set of open ways determines the next set, and states with their transitions are built only when first met
(lazy determinisation). A token is emitted as soon as all open ways agree on it, after a lookahead that the
longest token bounds. States are dropped and rebuilt when their number reaches ``max_states``, and frequent
pieces are remembered in a table of ``max_pieces``, so memory is bounded whatever the corpus.

Decoding maps ids to bytes in blocks and runs an incremental UTF-8 state machine over block ends.

Defined results: null text is empty text with no tokens; repeated rows are encoded row by row; special tokens
are never produced (their strings are ordinary text); an empty table gives an empty result.
"""
from __future__ import annotations

import base64
import gc
import hashlib
import re
import sys
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import long_id, prepare

BLOCK = 1 << 16
BMP = 0xFFFF
BYTES = [bytes((i,)) for i in range(256)]
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _class_of(prop: str, last: int) -> str:
    """Ranges of all code points up to ``last`` with a Unicode property, as the inside of a character class.

    The tokenizer library's own Unicode version counts, so it is asked which code points match."""
    import tiktoken
    every = "".join(chr(i) for i in range(last + 1) if not 0xD800 <= i < 0xE000)
    probe = tiktoken.Encoding("probe", pat_str=prop, mergeable_ranks={BYTES[i]: i for i in range(256)}, special_tokens={})
    points = list(map(ord, bytes(probe.encode_ordinary(every)).decode()))
    cuts = [i for i in range(1, len(points)) if points[i] != points[i - 1] + 1]
    return "".join(f"\\U{points[a]:08x}-\\U{points[b - 1]:08x}" for a, b in zip([0, *cuts], [*cuts, len(points)]))


def compile_pattern(pattern: str, last: int = sys.maxunicode) -> re.Pattern:
    """The split pattern for texts of code points up to ``last``, with its Unicode classes spelt out for the
    standard library's engine (which is the faster the fewer ranges a class has)."""
    white = _class_of(r"\s", last)
    for name in ("L", "N"):
        inside = _class_of(rf"\p{{{name}}}", last)
        pattern = re.sub(rf"(\[[^\]]*)\\p\{{{name}\}}", lambda m: m[1] + inside, pattern).replace(rf"\p{{{name}}}", f"[{inside}]")
    pattern = re.sub(r"(\[\^[^\]]*?)\\s", lambda m: m[1] + white, pattern)
    return re.compile(pattern.replace(r"\s", f"[{white}]").replace(r"\S", f"[^{white}]"))


class Transducer:
    """Encodes one piece at a time. A state is a dict: byte -> (next state, tokens emitted on the way), with its
    description under HELD and the tokens still to emit at the end of a piece under LAST."""

    HELD, LAST = -1, -2

    def __init__(self, ranks: dict[bytes, int], max_states: int = 150_000):
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {t: b for b, t in ranks.items()}
        self.prefixes: dict[bytes, int] = {}  # -1: a prefix that is no token
        for b in ranks:
            for i in range(1, len(b)):
                self.prefixes.setdefault(b[:i], -1)
        self.prefixes.update(ranks)
        self.pairs: dict[int, bool] = {}
        self.parts: dict[int, tuple[int, ...] | None] = {}
        self._reset()

    def _reset(self):
        # described by: bytes since the earliest open token, and per open token (begin, token before, tokens to emit)
        self.states: dict[tuple, dict] = {}
        self.start = self._state((b"", ((0, -1, ()),)))

    def _state(self, held) -> dict:
        state = self.states.get(held)
        if state is None:
            state = self.states[held] = {self.HELD: held, self.LAST: held[1][-1][2]}
        return state

    def merge(self, data: bytes) -> list[int]:
        """Plain merging by rank; used on the bytes of at most two tokens."""
        none, rank_of = sys.maxsize, self.ranks.get
        parts = [BYTES[x] for x in data]
        ranks = [rank_of(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) != none:
            i = ranks.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank_of(parts[i] + parts[i + 1], none)
            if i:
                ranks[i - 1] = rank_of(parts[i - 1] + parts[i], none)
        return [self.ranks[p] for p in parts]

    def halves(self, token: int) -> tuple[int, ...] | None:
        """The two tokens whose merge made ``token``; () for a byte, None for a token that merging never makes."""
        if token not in self.parts:
            data = self.bytes_of[token]
            made = () if len(data) == 1 else None
            if len(data) > 1 and self.merge(data) == [token]:
                made = next((left, right) for left, right in
                            ((self.ranks.get(data[:i]), self.ranks.get(data[i:])) for i in range(1, len(data)))
                            if left is not None and right is not None and self._meet(left, right, token))
            self.parts[token] = made
        return self.parts[token]

    def _meet(self, left: int, right: int, limit: int) -> bool:
        """Whether merging keeps a boundary between two tokens until the merge of rank ``limit``.

        Merges are undone along the boundary, the latest first: the tokens that meet there at that time must not
        have merged before. Of equal ranks the left one merged first."""
        while True:
            joint = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            if joint is not None and joint < limit:
                return False
            from_left, from_right = self.halves(left), self.halves(right)
            if from_left is None or from_right is None:
                return False
            if from_left and (left > right or not from_right):
                left, limit = from_left[1], left
            elif from_right:
                right, limit = from_right[0], right + 1
            else:
                return True

    def follows(self, before: int, token: int) -> bool:
        """Whether merging the bytes of both tokens (of ``token`` alone if ``before`` is -1) gives them back."""
        key = before << 32 | token
        ok = self.pairs.get(key)
        if ok is None:
            ok = self.halves(token) is not None if before < 0 else self._meet(before, token, sys.maxsize)
            if len(self.pairs) >= 4 * self.max_states:
                self.pairs.clear()
            self.pairs[key] = ok
        return ok

    def _step(self, state: dict, byte: int):
        """Builds the transition of ``state`` on ``byte``."""
        held, ways = state[self.HELD]
        held += BYTES[byte]
        alive, closed, n, token_of = [], None, len(held), self.prefixes.get
        for way in ways:  # in order of their begin
            token = token_of(held[way[0]:])
            if token is not None:
                alive.append(way)
                if closed is None and token >= 0 and self.follows(way[1], token):
                    closed = (n, token, way[2] + (token,))
        alive.append(closed)  # the way on which a token has just closed
        first = alive[0]
        same = len(first[2])
        for w in alive[1:]:
            same = min(same, len(w[2]))
            while first[2][:same] != w[2][:same]:
                same -= 1
        cut = first[0]
        if cut or same:
            alive = [(b - cut, t, c[same:]) for b, t, c in alive]
        hop = state[byte] = (self._state((held[cut:], tuple(alive))), first[2][:same])
        return hop

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) >= self.max_states:
            self._reset()
            gc.collect()  # states refer to each other
        out, state = [], self.start
        for byte in piece:
            state, emitted = state.get(byte) or self._step(state, byte)
            if emitted:
                out += emitted
        out += state[self.LAST]
        return out


class _Pieces(dict):
    """Piece -> its ids as little-endian unsigned 32-bit integers. When full, the newer half of the entries stays."""

    def __init__(self, transducer: Transducer, limit: int):
        super().__init__()
        self.transducer, self.limit, self.older = transducer, limit // 2, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            encoded = self.transducer.encode(piece.encode())
            ids = pack(f"<{len(encoded)}I", *encoded)
        if len(piece) <= 48:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Utf8Stream:
    """Incremental UTF-8 machine: give it bytes in any cuts, take whole characters; ill-formed bytes become U+FFFD."""

    def __init__(self):
        self.tail = b""

    @staticmethod
    def _need(lead: int) -> int:
        return 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 1

    def feed(self, data: bytes) -> str:
        data = self.tail + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if b & 0xC0 != 0x80:  # the last character's first byte
                if self._need(b) > back:
                    cut -= back
                break
        self.tail = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.tail = self.tail, b""
        return rest.decode("utf-8", "replace")


class Codec:
    """``ranks``: token bytes to id; ``pattern``: the split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_states: int = 150_000, max_pieces: int = 500_000):
        self.find_bmp, self.find_any = compile_pattern(pattern, BMP).findall, compile_pattern(pattern).findall
        self.pieces = _Pieces(Transducer(ranks, max_states), max_pieces)
        top = max(ranks.values()) + 1
        ordered = [b""] * top
        for b, t in ranks.items():
            ordered[t] = b
        self.sizes = np.array([len(b) for b in ordered], np.int64)
        self.places = np.cumsum(self.sizes) - self.sizes
        self.blob = np.frombuffer(b"".join(ordered), np.uint8)

    def split(self, text: str) -> list[str]:
        return (self.find_bmp if len(text.encode("utf-16-le")) == 2 * len(text) else self.find_any)(text)

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.split(text or ""))), "<u4")

    def token_bytes(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.places[ids] - ends + sizes, sizes)
        return self.blob[shift + np.arange(len(shift))].tobytes()

    def decode(self, ids: np.ndarray):
        """Text in parts, one per block of ids."""
        stream = Utf8Stream()
        for i in range(0, len(ids), BLOCK):
            yield stream.feed(self.token_bytes(ids[i:i + BLOCK]))
        yield stream.close()


_WORKER: dict = {}


def _codec(path: str, pattern: str) -> Codec:
    if _WORKER.get("key") != (path, pattern):
        _WORKER.update(key=(path, pattern), codec=Codec(load_ranks(path), pattern))
    return _WORKER["codec"]


def _encoded(codec: Codec, b: pa.RecordBatch, with_ids: bool) -> pa.RecordBatch:
    n, ids_sha, text_sha, all_ids = [], [], [], []
    for text in b.column("text").to_pylist():
        ids = codec.encode(text)
        back = hashlib.sha256()
        for part in codec.decode(ids):
            back.update(part.encode())
        n.append(len(ids))
        ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
        text_sha.append(back.hexdigest())
        if with_ids:
            all_ids.append(ids)
    columns = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    if with_ids:
        flat = np.concatenate(all_ids or [np.zeros(0, "<u4")]).astype(np.int32)
        columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(flat, pa.int32())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names=names)


def _encode(path: str, pattern: str, with_ids: bool):
    def run(batches):
        codec = _codec(path, pattern)
        gc.disable()  # hundreds of thousands of live states make full collections costly
        try:
            for b in batches:
                yield _encoded(codec, b, with_ids)
        finally:
            gc.enable()
    return run


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids array<int>) of every whole text of ``docs``.

    ``ranks_path`` is a rank file that every worker can open, such as one installed with a package.
    """
    prepare(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(long_id(), "text").mapInArrow(_encode(ranks_path, pattern, with_ids), schema)
