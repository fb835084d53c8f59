import hashlib
import random

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from inboxlens.llm.bpe import decode, detokenize, encode, load_ranks, pieces, round_trip, tokenize  # noqa: E402

from .helpers import odd_docs, odd_rows, same_rows  # noqa: E402

PATH = P.path("byte_bpe_50k.tiktoken")
PLAIN = tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=load_ranks(PATH), special_tokens={})


def strange(rng, n):
    alphabet = ["a", "B", "é", "語", "1", "٣", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "'", "'s", "'ll", "!", "<|endoftext|>", "́", "😀"]
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_cuts_do_not_change_the_ids():
    rng = random.Random(5)
    for _ in range(300):
        text = strange(rng, rng.randrange(120))
        assert "".join(pieces(text, 7)) == text
        ids = encode(text, PATH, P.PATTERN, 7)
        assert ids.tolist() == PLAIN.encode_ordinary(text)
        assert decode(ids, PATH, P.PATTERN) == text.encode()


def test_match_by_match_is_the_same():
    rng = random.Random(6)
    for _ in range(100):
        text = strange(rng, 60).replace(" ", "")
        assert encode(text, PATH, P.PATTERN, 3).tolist() == PLAIN.encode_ordinary(text)


def test_stretches_that_overflow_the_library():
    for text in (" " * 2_000_000 + "x", "ab" * 300_000, "\n" * 400_000):
        ids = encode(text, PATH, P.PATTERN)
        assert decode(ids, PATH, P.PATTERN) == text.encode() and len(ids)


def test_raw_bytes_of_single_ids():
    """A token can be a part of a character; its bytes come back as they are."""
    ids = PLAIN.encode_ordinary("語")
    assert len(ids) > 1 and b"".join(decode(np.array([i]), PATH, P.PATTERN) for i in ids) == "語".encode()


def test_operator(spark, tmp_path):
    rows = odd_rows()
    expected = []
    for r in rows:
        ids = PLAIN.encode_ordinary(r[1] or "")
        expected.append((r[0], len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                         hashlib.sha256((r[1] or "").encode()).hexdigest()))
    docs = odd_docs(spark, tmp_path, rows)
    same_rows(round_trip(docs, PATH, P.PATTERN).collect(), expected)
    back = detokenize(tokenize(docs, PATH, P.PATTERN), PATH, P.PATTERN)
    assert back.columns == [*docs.columns, "ids", "bytes"]
    assert back.where("bytes <> cast(coalesce(text, '') as binary)").count() == 0
    checked = tokenize(docs, PATH, P.PATTERN, exact="exact", keep_text=False)
    assert "text" not in checked.columns and checked.where("not exact").count() == 0
    assert round_trip(docs.limit(0), PATH, P.PATTERN).count() == 0
