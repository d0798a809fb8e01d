import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from shelfwise.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def pair():
    ranks = bpe.load_ranks(PATH)
    return bpe.Codec(ranks, public_tokenizers.PATTERN), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(5)
    yield from ["", " ", "a" * 20000, "é" * 3000, " " * 5000, "=-" * 4000, "don't we'll <|endoftext|> 1²Ⅷ", "\x1c\x1d a\x85b　 c"]
    for _ in range(1500):
        yield "".join(rng.choice("abthe \n\t'slrvd19é漢😀-.  ABXß_") for _ in range(rng.randint(0, 80)))
    for i in range(0, 0x3400, 97):
        yield "x " + " 1a".join(chr(c) for c in range(i, i + 97) if not 0xD800 <= c < 0xE000) + "'s"


def test_ids_equal_the_library_and_round_trip(pair):
    codec, ref = pair
    for t in texts():
        ids = codec.encode(t)
        assert ids.tolist() == ref.encode_ordinary(t), t[:80]
        assert "".join(codec.decode(ids)) == t


def test_small_state_table_is_rebuilt(pair):
    small = bpe.Codec(bpe.load_ranks(PATH), public_tokenizers.PATTERN, max_states=50, max_pieces=20)
    for t in list(texts())[8:300]:
        assert small.encode(t).tolist() == pair[1].encode_ordinary(t)


def test_lookahead_is_bounded(pair):
    """Tokens come out while a long piece is still being read."""
    tr = pair[0].pieces.transducer
    state, out = tr.start, 0
    for n, byte in enumerate(b"thequickbrownfox" * 200, 1):
        state, emitted = state.get(byte) or tr._step(state, byte)
        out += len(b"".join(tr.bytes_of[t] for t in emitted))
        assert n - out <= 128


def test_utf8_stream_in_any_cuts():
    rng = random.Random(6)
    data = "aé漢😀ß\U0010ffff".encode() * 50
    for _ in range(50):
        s, out, i = bpe.Utf8Stream(), "", 0
        while i < len(data):
            j = i + rng.randint(0, 5)
            out += s.feed(data[i:j])
            i = j
        assert out + s.close() == data.decode()
    s = bpe.Utf8Stream()
    assert s.feed(b"a\xe6") + s.close() == "a�"


def test_documents(docs_of, pair):
    rows = [(1, None), (1, ""), (None, "x"), (2, "same text"), (2, "same text"), (3, "long " * 60000)]
    out = bpe.encode_documents(docs_of(rows), PATH, public_tokenizers.PATTERN, with_ids=True).collect()
    assert len(out) == len(rows)
    want = sorted([(i, hashlib.sha256(np.array(pair[1].encode_ordinary(t or ""), "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows], key=str)
    assert sorted([(r.doc_id, r.ids_sha256, r.decoded_sha256) for r in out], key=str) == want
    assert all(r.n_tokens == len(r.ids) for r in out)
    assert bpe.encode_documents(docs_of([]), PATH, public_tokenizers.PATTERN).count() == 0


def test_the_boundary_check_equals_merging_anew(pair):
    tr = pair[0].pieces.transducer
    rng, ids = random.Random(9), sorted(tr.bytes_of)
    for _ in range(20000):
        a, b = rng.choice([-1, rng.choice(ids), rng.choice(ids[:600])]), rng.choice([rng.choice(ids), rng.choice(ids[:600])])
        want = [b] if a < 0 else [a, b]
        assert tr.follows(a, b) == (tr.merge(b"".join(tr.bytes_of[t] for t in want)) == want), (a, b)
