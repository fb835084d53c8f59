"""What line dedup shuffles and computes no more often than needed."""

import random

import numpy as np

from inboxlens.llm import line_dedup, similar
from inboxlens.llm.line_dedup import char_shingles, kept_lines, line_report, plain_line, plain_lines, shingle_sets, signatures

from .helpers import DOCS


def text_of(r, n):
    return "".join(r.choice("abcdefghij klmnop") for _ in range(n)).strip()


def test_posts_are_shuffled_once_and_later_steps_read_only_members_of_lists(spark, monkeypatch, tmp_path):
    r = random.Random(3)
    lines = [text_of(r, 200) for _ in range(60)]
    texts = lines + [x[:40] + "#" + x[41:] for x in lines[:20]]
    spark.createDataFrame([(i, x, "en", "s0", 1) for i, x in enumerate(texts)], DOCS).write.parquet(str(tmp_path / "docs"))
    exchanges, inputs, folder, real = {}, {}, {}, line_dedup.stored

    def stored(df, name):
        exchanges.setdefault(name, df._jdf.queryExecution().executedPlan().toString().count("Exchange "))
        inputs.setdefault(name, df.inputFiles())
        out = real(df, name)
        folder[name] = out.inputFiles()[0].rsplit("/", 1)[0] if out.inputFiles() else None
        return out

    monkeypatch.setattr(line_dedup, "stored", stored)
    monkeypatch.setattr(similar, "stored", stored)
    kept = {x.doc_id: x.n_kept for x in line_report(spark.read.parquet(str(tmp_path / "docs"))).collect()}
    assert kept == {i: int(i < 60) for i in range(80)}
    assert exchanges["lists"] == 1
    for name in ("pairs", "links", "open", "wanted"):
        assert not any(f.startswith(folder["lines"]) for f in inputs[name]), name


def test_lists_hold_each_post_of_a_shared_key(spark):
    posts = spark.createDataFrame([(7, 1), (7, 2), (7, 3), (8, 1), (9, 2), (9, 3)], "key long, id long")
    rows = similar._first_lists(posts).select("key", "id", "n").collect()
    assert sorted(map(tuple, rows)) == [(7, 1, 3), (7, 2, 3), (7, 3, 3), (9, 2, 2), (9, 3, 2)]


def test_first_line_stays_of_lines_with_and_without_links(spark):
    r = random.Random(4)
    a, b, alone = (text_of(r, 200) for _ in range(3))
    near = lambda x: x[:60] + "#" + x[61:]
    docs = [(0, None, near(a)), (1, 5, f"{b}\n{a}"), (2, 5, f"{alone}\n{near(b)}"), (3, 6, f"{a}\n{alone}\n{b}")]
    kept = kept_lines(spark.createDataFrame(docs, "row long, doc_id long, text string")).collect()
    assert sorted(map(tuple, kept)) == [(1, 5, 0), (1, 5, 1), (2, 5, 0)]


def test_plain_lines():
    for text in (b"", b"\n", b" A b\nC  d\n", b"A b \n c", b"x\ty\r\nz", b"\x0b\n\x0c a", "É  É\nb".encode(), b"\xff A\nb\x00 "):
        assert plain_lines(text) == [plain_line(x) for x in text.split(b"\n")]


def test_signatures_and_sets_of_odd_lines():
    r, k = random.Random(6), 27
    for letters in ("ab", "ab\0é", "aé語😀"):
        lines = ["".join(r.choice(letters) for _ in range(n)).encode() for n in (1, 7, 8, 9, 15, 40, 300)] + [b"", letters.encode() + b"\xff"]
        hashes, counts = char_shingles(lines)
        assert counts.tolist() == [0 if not x else max(1, len(x.decode("utf-8", "replace")) - 7) for x in lines]
        sigs = signatures(hashes, counts, k)
        ends = np.cumsum(counts)
        for i, own in enumerate(shingle_sets(lines)):
            h = hashes[ends[i] - counts[i]:ends[i]]
            assert own.tolist() == sorted(set(h.tolist()))
            if not len(h):
                continue
            least = {}
            for x in h.tolist():
                x = (x ^ x >> 29) * 0xBF58476D1CE4E5B9 % 2**64
                at, value = (x >> 32) * k >> 32, x >> 16 & 0xFFFFFFFF
                least[at] = min(value, least.get(at, value))
            far = [next(d for d in range(k) if (c + d) % k in least) for c in range(k)]
            values = [(least[(c + d) % k] + d * 0x9E3779B1) % 2**32 for c, d in enumerate(far)]
            assert sigs[i, :k].tolist() == (line_dedup.mix(np.array(values, np.uint64)) & np.uint64(0xFFFF)).tolist()
            assert sigs[i, k] == (sum(d > 0 for d in far) > k // line_dedup.BORROWED)


def test_shared_counts_by_pair_and_by_bitmap():
    r = random.Random(7)
    sets = [np.unique(np.array([r.randrange(50) for _ in range(30)], np.uint64)) for _ in range(30)]
    every = np.array([(i, j) for i in range(15) for j in range(15)])
    for pairs in (every, every[:5]):
        i, j = pairs.T
        got = similar._shared_counts(sets[:15], sets[15:], i, j).tolist()
        assert got == [len(set(sets[a].tolist()) & set(sets[15 + b].tolist())) for a, b in pairs.tolist()]
