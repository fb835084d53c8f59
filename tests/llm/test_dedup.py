import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from inboxlens.llm import similar
from inboxlens.llm.exact_dedup import exact_dedup
from inboxlens.llm.line_dedup import dedup_lines, kept_lines, line_report, plain_line
from inboxlens.llm.near_dedup import near_dedup, one_per_group
from inboxlens.llm import substring_dedup
from inboxlens.llm.substring_dedup import mark_repeats, suspected_windows

from .helpers import SPACES, odd_docs, odd_rows, roots, same_rows, words


def bare(text):
    return "".join(c for c in text or "" if c not in SPACES)


@pytest.mark.parametrize("block_bytes", [16, 4096])
def test_exact(spark, tmp_path, block_bytes):
    rows = [r for r in odd_rows() if not (r[1] and len(r[1]) > 5000 and block_bytes == 16)]
    groups = defaultdict(list)
    for r in rows:
        groups[bare(r[1])].append(r)
    expected = []
    for text, members in groups.items():
        best = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        kept = [m for m in members if m is best or m == best][:1]
        expected += [(m[0], best[0], len(members), sha) for m in members]
        assert kept
    got = exact_dedup(odd_docs(spark, tmp_path, rows), block_bytes).collect()
    same_rows([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], expected)
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter({hashlib.sha256(t.encode()).hexdigest(): 1 for t in groups})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_hot_copies_over_many_partitions(spark):
    docs = spark.range(600).selectExpr("id as doc_id", "if(id % 3 = 0, repeat('same text ', 40), concat('own ', id)) as text")
    got = exact_dedup(docs, 64, partitions=7)
    assert got.where("kept").count() == 401
    assert got.where("group_size = 200 and keep_id = 0").count() == 200


def shingles(text):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def near_groups(rows, percent=85):
    sets = [shingles(r[1]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return sets, roots(range(len(rows)), links)


def test_near(spark, tmp_path):
    rows = odd_rows()
    sets, root = near_groups(rows)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        least[root[i]].append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    docs = odd_docs(spark, tmp_path, rows)
    got = near_dedup(docs).collect()
    same_rows(got, [(r[0], len(sets[i]), least[root[i]], r[0] == least[root[i]]) for i, r in enumerate(rows)])
    stay = one_per_group(docs)
    assert stay.columns == [c for c in docs.columns if c != "__row"]
    same_rows([(r.doc_id,) for r in stay.collect()], [(x,) for x in least.values()])


def variants_and_a_common_passage(variants, others):
    """A large group of near copies, and a passage that unlike documents share."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(variants):
        t = list(base)
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(t), None, None, None))
    passage = " ".join(f"p{i}" for i in range(40))
    return rows + [(1000 + i, passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randint(8, 40))), None, None, None)
                   for i in range(others)]


def check_groups(spark, rows):
    _, root = near_groups(rows)
    expected = [(r[0], rows[root[i]][0]) for i, r in enumerate(rows)]
    got = near_dedup(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"))
    same_rows(got.select("doc_id", "component_id").collect(), expected)


def test_near_many_variants_and_a_common_passage(spark):
    check_groups(spark, variants_and_a_common_passage(150, 120))


def test_near_lists_posted_anew(spark, monkeypatch):
    """With tiny limits the longer keys, blocks and chunks are used; same groups."""
    monkeypatch.setattr(similar, "OUTSIDE", 3)
    monkeypatch.setattr(similar, "BLOCK", 2)
    monkeypatch.setattr(similar, "CHUNK", 8)
    monkeypatch.setattr(similar, "DEPTH", 2)
    check_groups(spark, variants_and_a_common_passage(30, 20))


def line_items(rows):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    return [(i, n, plain_line(x.encode()).decode()) for i in order for n, x in enumerate((rows[i][1] or "").split("\n"))
            if plain_line(x.encode())]


def test_lines(spark, tmp_path):
    rows = [r for r in odd_rows() if r != odd_rows()[3]] + [odd_rows()[3]]
    rows += [(400, "First line of all here is long enough\nsecond line stands alone", "en", "s0", 1),
             (401, "first  LINE of all here is long enough!\n\nthird line is its own thing", "en", "s0", 1)]
    docs = odd_docs(spark, tmp_path, rows)
    items = line_items(rows)
    texts = sorted({t for _, _, t in items})
    sets = [{t[i:i + 8] for i in range(max(1, len(t) - 7))} for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    root = dict(zip(texts, roots(range(len(texts)), links).values()))
    seen, stay = set(), defaultdict(list)
    for i, n, t in items:
        if root[t] not in seen:
            seen.add(root[t])
            stay[i].append(n)
    ids = Counter(r[0] for r in rows)
    got = {r.doc_id: r for r in line_report(docs).collect()}
    for i, r in enumerate(rows):
        if ids[r[0]] == 1:
            assert got[r[0]].kept == stay[i] and got[r[0]].n_kept == len(stay[i])
            assert got[r[0]].n_lines == sum(1 for j, _, _ in items if j == i)
    out = dedup_lines(docs)
    assert out.columns == [c for c in docs.columns if c not in ("__row", "__kept")]
    text = {r.doc_id: r.text for r in out.collect()}
    assert out.count() == len(rows) and text[301] is None and text[303] == ""
    assert text[400] == rows[-2][1] and text[401] == "\nthird line is its own thing"


def removed_by_force(rows, window):
    places = Counter(tuple(w[i:i + window]) for r in rows for w in [words(r[1])] for i in range(len(w) - window + 1))
    out = []
    for r in rows:
        w = words(r[1])
        gone = {j for i in range(len(w) - window + 1) if places[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((r[0], len(w), len(gone), " ".join(kept)))
    return out


@pytest.mark.parametrize("window,gram", [(35, 16), (7, 3)])
def test_substrings(spark, tmp_path, window, gram):
    rows = odd_rows()
    got = mark_repeats(odd_docs(spark, tmp_path, rows), window, gram)
    same_rows(got.select("doc_id", "n_words", "n_removed", "kept_text").collect(), removed_by_force(rows, window))


def test_substrings_with_a_full_sketch(spark, tmp_path, monkeypatch):
    """A sketch that is far too small lets everything pass; the result stays."""
    rows = odd_rows()
    got = mark_repeats(odd_docs(spark, tmp_path, rows), 7, 3, max_cells=1 << 16)
    same_rows(got.select("doc_id", "n_words", "n_removed", "kept_text").collect(), removed_by_force(rows, 7))


@pytest.mark.parametrize("cell_bytes", [12, 1 << 30])
def test_substrings_by_a_sketch_that_stays_dealt_out(spark, tmp_path, monkeypatch, cell_bytes):
    """No sketch is small enough to be broadcast; also a full one, and tasks that ask in many pieces."""
    monkeypatch.setattr(substring_dedup, "CELL_BYTES", cell_bytes)
    monkeypatch.setattr(substring_dedup, "FLUSH", 64)
    rows = odd_rows()
    got = mark_repeats(odd_docs(spark, tmp_path, rows), 7, 3, max_cells=0)
    same_rows(got.select("doc_id", "n_words", "n_removed", "kept_text").collect(), removed_by_force(rows, 7))
    assert mark_repeats(odd_docs(spark, tmp_path, []), 7, 3, max_cells=0).count() == 0


@pytest.mark.parametrize("max_cells", [0, 1 << 28])
def test_sketch_lets_few_windows_pass_at_any_size(spark, max_cells):
    """The sketch grows with the input: of windows that occur once the same few pass."""
    def share(n, words=250):
        text = f"concat_ws(' ', transform(sequence(1, {words}), x -> hex(xxhash64(id, x))))"
        docs = spark.range(n).selectExpr("id as doc_id", f"{text} as text")
        _, windows, _ = suspected_windows(docs, max_cells=max_cells)
        return windows.count() / (n * (words - 34))

    assert 0 < share(400) < 0.05 and 0 < share(6400) < 0.05


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string, row int")
    for f in (exact_dedup, near_dedup, one_per_group, dedup_lines, line_report, mark_repeats):
        assert f(empty).count() == 0, f.__name__
    assert kept_lines(empty.select("doc_id", "text", F.lit(0).cast("long").alias("row"))).count() == 0
