"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from inboxlens.llm import spelling
from inboxlens.llm.fm_index import Vocabulary
from inboxlens.llm.spelling import spelling_variants

from .helpers import odd_docs, same_rows


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, least=7):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{doc_id}:{word}".encode()) if doc_id is not None else 1
            if h % 31 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= 2}
    close, forms = {}, {}
    for w in words:
        close[w] = [v for v in words if abs(len(v) - len(w)) < 2 and near(w, v)]
        best = min(((-words[v], v) for v in close[w]), default=(0, None))
        if best[1] and -best[0] >= 10 * words[w]:
            forms[w] = best[1]

    def root(w):
        while w in forms:
            w = forms[w]
        return w

    return [(w, forms.get(w), root(w), n, len(close[w]), words.get(forms.get(w))) for w, n in words.items()]


def texts(seed=1, n=120):
    """Common words, their rarer variants in chains of three, other letters, long runs."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeéÿz") for _ in range(rng.randint(7, 10))) for _ in range(25)]
    rows = []
    for i in range(n):
        out = []
        for _ in range(60):
            w = rng.choice(base)
            for _ in range(rng.choice([0] * 60 + [1, 1, 2])):
                p = rng.randrange(len(w))
                w = rng.choice([w[:p] + w[p + 1:], w[:p] + "q" + w[p:], w[:p] + "x" + w[p + 1:]])
            out.append(rng.choice([w, w.upper(), w.capitalize()]))
        rows.append((i, " ".join(out), "en", "s0", 1))
    rows += [(1000 + i, f"{'x' * 300} {'x' * 299}y aaaaaaaa aaaaaaa aaaaaaaaa Straße_naïveté-naïveté Ābcdefgh ×÷×÷×÷× ÀÀÀÀÀÀÀ àààààààà", "de", "s1", 1) for i in range(3)]
    rows += [(None, "without an id without an id", None, None, None)] * 3
    return rows


@pytest.fixture
def tiny(monkeypatch):
    """Many shards, several blocks of patterns."""
    for name, value in (("SYMBOLS", 300), ("TOGETHER", 7), ("HELD", 50), ("SAMPLE", 200)):
        monkeypatch.setattr(spelling, name, value)


def test_variants(spark, tmp_path, tiny):
    rows = texts() + [(None, None, None, None, None), (9, "", "en", "s", 0)]
    got = spelling_variants(odd_docs(spark, tmp_path, rows))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = brute(rows)
    assert sum(w[1] is not None for w in expected) > 20
    same_rows(got.collect(), expected)


def test_odd_documents_and_chains_of_forms(spark, tmp_path):
    """Each form ten times as common as the word before: forms lead on to the root."""
    chain = ["abcdefgh", "abcdefg", "abcdefgz", "abcdefyz", "abcdexyz"]
    rows = [(i, " ".join([w] * n), "en", "s0", 1) for i in range(1, 3) for w, n in zip(chain, (1, 10, 100, 1000, 10000))]
    expected = brute(rows)
    assert {w[2] for w in expected} == {chain[-1]} and len(expected) == 5
    same_rows(spelling_variants(odd_docs(spark, tmp_path, rows)).collect(), expected)
    odd = odd_docs(spark, tmp_path)
    same_rows(spelling_variants(odd).collect(), brute([tuple(r) for r in odd.collect()]))
    assert spelling_variants(odd.limit(0)).count() == 0


def test_a_text_that_is_not_utf8(spark):
    df = spark.createDataFrame([(1, bytearray(b"abcdefgh\xff\xfeabcdefgh")), (2, bytearray(b"abcdefgh"))], "doc_id long, text binary")
    df = df.selectExpr("doc_id", "cast(text as string) as text")
    assert [(r.word, r.n) for r in spelling_variants(df).collect()] == [("abcdefgh", 3)]


def test_a_beginning_that_many_words_share(spark, tiny):
    """A third of the vocabulary begins alike: its words are in several shards and still meet."""
    rng = random.Random(7)
    words = sorted({"pre" + "".join(rng.choice("abc") for _ in range(rng.randint(4, 5))) for _ in range(150)}
                   | {"".join(rng.choice("abcdef") for _ in range(7)) for _ in range(300)})
    df = spark.createDataFrame([(w, i % 9 + 2) for i, w in enumerate(words)], "word string, n long")
    n = dict(df.collect())
    expected = []
    for w in words:
        close = [v for v in words if near(w, v) and v != w]
        if close:
            neg, best = min((-n[v], v) for v in close)
            expected.append((w, len(close), best, -neg))
    assert len([e for e in expected if e[0].startswith("pre")]) > 50
    same_rows(spelling.near_words(df).collect(), expected)


@pytest.mark.parametrize("seed", range(12))
def test_one_error(seed):
    rng = random.Random(seed)
    letters, (low, high) = "abcéz"[:rng.choice([1, 2, 3, 5])], rng.choice([(1, 4), (3, 7), (7, 9)])
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(low, high))) for _ in range(rng.choice([1, 5, 80]))})
    asked = words + ["aab", "q", "zzzzzzzz"]
    index = Vocabulary(words)
    got = [(q, w) for q, w in zip(*(x.tolist() for x in index.one_error(asked, True)))]
    got += [(q, w) for q, w in zip(*(x.tolist() for x in index.one_error(asked, False))) if not words[w].startswith(asked[q][:len(asked[q]) // 2])]
    assert sorted(got) == [(i, j) for i, a in enumerate(asked) for j, b in enumerate(words) if a != b and abs(len(a) - len(b)) < 2 and near(a, b)]
