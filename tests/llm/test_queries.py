"""The registered queries on driver tables against their SQL, and the pipeline."""

import duckdb
import pytest

import corpus_pipeline
from inboxlens.llm.queries import QUERIES
from inboxlens.llm.sql import ORACLE

from .helpers import CLASHES, odd_docs, odd_rows, same_rows
from .test_dedup import near_groups

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    expected = con.sql(ORACLE[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    plain = lambda f: f[columns].astype(object).where(f[columns].notna(), None).values.tolist()
    tidy = lambda rows: [[float(x) if isinstance(x, (int, float)) else x for x in r] for r in rows]
    same_rows(tidy(plain(got)), tidy(plain(expected)))


def test_pipeline_stages(spark, tmp_path):
    """Each stage on its own input, which holds nulls, ties and repeats."""
    docs = odd_docs(spark, tmp_path, odd_rows() + [(500 + i, f"tail {i} of its own " * 3, "en", "s1", 60) for i in range(4)], clashes=False)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "MinHash near-dedup", "mixing sources", "BPE encoding"]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        if i < 4:
            assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes), name
        if name == "MinHash near-dedup":
            rows = [tuple(r) for r in docs.collect()]
            _, root = near_groups(rows)
            assert out.count() == len(set(root.values()))
        if i < 3:
            assert 0 < out.count() <= docs.count()
        else:
            assert out.count() > 0
        docs = out
    assert docs.where("not exact").count() == 0 and docs.where("n_tokens > 0").count() > 0


def test_pipeline_on_tables(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and out.where("not exact").count() == 0


def not_utf8(spark, tmp_path):
    """Documents among which one holds bytes that are not UTF-8, and columns with clashing names."""
    good = [(i, f"a plain text number {i} with some words of its own\nand a second line {i} behind it".encode()) for i in range(20)]
    rows = [(i, bytearray(t)) for i, t in good + [(50, b"bytes \xff\xfe that are no text\nand more of them \xc3 here"), (51, b"\xff")]]
    df = spark.createDataFrame(rows, "doc_id long, text binary").selectExpr(
        "doc_id", "cast(text as string) as text", "'en' as lang", "'s0' as source", "cast(1 as bigint) as n_chars")
    for c in CLASHES:
        df = df.selectExpr("*", f"'clash' as `{c}`")
    path = str(tmp_path / "bytes")
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_stages_on_odd_bytes_clashing_columns_and_empty_tables(spark, tmp_path):
    """A text that is not UTF-8 keeps its bytes; only the last stage, BPE, calls it inexact."""
    odd = not_utf8(spark, tmp_path)
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, odd, SF)
        if i < 4:
            assert out.columns == list(corpus_pipeline.COLUMNS), name
        rows = out.collect() if i == 4 else out.selectExpr("doc_id", "cast(text as binary) as text").collect()
        if i in (1, 2):
            assert {r.doc_id: bytes(r.text) for r in rows} == {r.doc_id: bytes(r.text) for r in odd.selectExpr("doc_id", "cast(text as binary) as text").collect()}, name
        if i == 4:
            assert {r.doc_id for r in rows if not r.exact} == {50, 51} and len(rows) == 22
        assert stage(spark, odd.limit(0), SF).count() == 0, name
