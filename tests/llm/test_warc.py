import hashlib
import json
import zlib

import pytest
from pyarrow import fs

from inboxlens.llm.shared import new_folder
from inboxlens.llm.warc import archive_pages, decided, normalise, read_record, write_monolithic

from .helpers import same_rows

LONG = "<p>" + "é" * 600 + "</p>"
PAGES = [(1, "http://a/1", LONG), (2, "http://a/2", LONG), (3, None, LONG), (4, "http://a/\r\nX: y", "short"), (5, "http://a/5", "short"),
         (6, "http://é/6", None), (7, "", ""), (8, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 100), (8, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 100),
         (9, "u", "z" * 3_000_000), (None, "u", LONG), (None, None, None), (10, "u", "y" * 999), (11, "u", "y" * 999), (12, "u", "y" * 1000),
         (13, "u", "y" * 1000)]


def expected(pages):
    groups = {}
    for i, _, h in pages:
        data = (h or "").encode()
        if len(data) >= 1000 and i is not None:
            groups[data] = max(groups.get(data, i), i)
    out = []
    for i, _, h in pages:
        data = (h or "").encode()
        first = groups.get(data)
        revisit = first is not None and i != first
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return out


@pytest.mark.parametrize("file_bytes", [2000, 1 << 28])
def test_round_trip(spark, file_bytes):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'clash' as revisit", "1 as same")
    same_rows(archive_pages(pages, file_bytes=file_bytes).collect(), expected(PAGES))


def test_files(spark):
    """One stream before; after it, a member per record, found by the index."""
    mono, final = new_folder(spark, "m"), new_folder(spark, "f")
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1)
    files = write_monolithic(decided(pages).coalesce(1), mono)
    assert [r.records for r in files.collect()] == [len(PAGES)]
    done = normalise(files, mono, final).collect()
    store, base = fs.FileSystem.from_uri(final)
    seen = []
    for name, n in done:
        data = store.open_input_file(f"{base}/{name}.warc.gz").read()
        entries = [json.loads(x) for x in store.open_input_file(f"{base}/{name}.idx").read().splitlines()]
        assert len(entries) == n and sum(e["length"] for e in entries) == len(data)
        for e in entries:
            fields, block = read_record(data[e["offset"]:e["offset"] + e["length"]])
            assert fields["warc-type"] == e["type"] and int(fields["content-length"]) == len(block)
            assert "\n" not in fields["warc-target-uri"]
            seen.append(e["page_id"])
    assert sorted(seen, key=repr) == sorted((p[0] for p in PAGES), key=repr)
    raw_store, raw_base = fs.FileSystem.from_uri(mono)
    z = zlib.decompressobj(31)
    z.decompress(raw_store.open_input_file(f"{raw_base}/{files.head().path}").read())
    assert z.eof and not z.unused_data  # a single member


def test_empty(spark):
    assert archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
