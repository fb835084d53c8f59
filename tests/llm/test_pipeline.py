"""Every stage of the pipeline, on its own input, row by row against brute force."""

from collections import Counter, defaultdict
from math import floor

import pytest

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

import corpus_pipeline  # noqa: E402
from inboxlens.llm.bpe import load_ranks  # noqa: E402
from inboxlens.llm.line_dedup import plain_line  # noqa: E402
from inboxlens.llm.quality import quality_scores  # noqa: E402

from .helpers import odd_docs, odd_rows, roots, words  # noqa: E402
from .test_dedup import line_items, near_groups  # noqa: E402
from .test_mixing import targets_by_rounds  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(input, output) rows of each stage, the input being what the stage before wrote."""
    folder = tmp_path_factory.mktemp("pipeline")
    driver = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS).collect()]
    own = [(10000 + i, f"tail {i} of its own " * 3, "en", "s1", 60) for i in range(4)]
    odd = [(None if r[0] is None else r[0] + 20000, *r[1:]) for r in odd_rows()]
    docs = odd_docs(spark, folder, driver + own + odd, clashes=False)
    out, scores = {}, {r.doc_id: r.predicted for r in quality_scores(docs.where("doc_id is not null"), spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, SF).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        out[name] = before, docs.collect()
    return out, scores


def counted(rows):
    return Counter(map(tuple, rows))


def test_quality(stages):
    stages, scores = stages
    before, after = stages["quality classifier"]
    with_id = lambda rows: counted(r for r in rows if r.doc_id is not None)
    assert with_id(after) == counted(r for r in before if r.doc_id is not None and scores[r.doc_id] == 1)
    assert 0 < len(after) < len(before)


def test_lines(stages):
    before, after = stages[0]["line dedup"]
    items = line_items(before)
    texts = sorted({t for _, _, t in items})
    sets = [{t[i:i + 8] for i in range(max(1, len(t) - 7))} for t in texts]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    links = []
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x] if j < i)
        links += [(i, j) for j, n in shared.items() if 100 * n >= 85 * (len(s) + len(sets[j]) - n)]
    root = dict(zip(texts, roots(range(len(texts)), links).values()))
    seen, stay = set(), defaultdict(set)
    for i, n, t in items:
        if root[t] not in seen:
            seen.add(root[t])
            stay[i].add(n)
    expected = []
    for i, r in enumerate(before):
        lines = (r.text or "").split("\n")
        left = "\n".join(x for n, x in enumerate(lines) if n in stay[i] or not plain_line(x.encode()))
        if words(left):
            expected.append((r.doc_id, left, r.lang, r.source, len(left)))
    assert counted(after) == Counter(expected)
    assert len(after) < len(before)


def test_near_copies(stages):
    before, after = stages[0]["MinHash near-dedup"]
    _, root = near_groups(before)
    group = {tuple(r): root[i] for i, r in enumerate(before)}  # equal rows are in one group
    assert Counter(group[tuple(r)] for r in after) == Counter(set(root.values()))


def test_mixture(stages):
    before, after = stages[0]["mixing sources"]
    sizes, texts = defaultdict(int), defaultdict(set)
    for r in before:
        sizes[r.source] += len(words(r.text))
        texts[r.doc_id, r.source].add(r.text)
    taken, cut, times = defaultdict(int), Counter(), Counter()
    for r in after:
        taken[r.source] += len(words(r.text))
        times[r.doc_id, r.source, r.text] += 1
        if r.text not in texts[r.doc_id, r.source]:
            cut[r.source] += 1
            assert any(t.startswith(r.text) for t in texts[r.doc_id, r.source])
    target = targets_by_rounds(sizes)
    assert {s: taken[s] for s in sizes} == {s: floor(t + 1e-9) for s, t in target.items()}
    assert max(cut.values(), default=0) <= 1
    rows = Counter((r.doc_id, r.source, r.text) for r in before)
    assert all(n <= 2 * rows[key] for key, n in times.items() if key in rows)


def test_encoding(stages):
    before, after = stages[0]["BPE encoding"]
    path = P.path("byte_bpe_50k.tiktoken")
    plain = tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})
    expected = Counter((r.doc_id, r.lang, r.source, tuple(plain.encode_ordinary(r.text or ""))) for r in before)
    assert Counter((r.doc_id, r.lang, r.source, tuple(r.ids)) for r in after) == expected
    assert all(r.exact and r.n_tokens == len(r.ids) for r in after)
