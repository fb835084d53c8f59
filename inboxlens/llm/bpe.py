"""Byte-level BPE encoding and decoding with a local rank file.

Long texts are cut before the library's regular expression sees them, at places
where a match always ends: between a character that is not white space and a
space before another such character. Runs without such a place (no white space
at all, or white space only) are handed over match by match.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import batch, extended, small, texts_of

PIECE_CHARS = 1 << 15
# The white space of the pattern (Unicode White_Space), and Python's own extras
# \x1c-\x1f, at which nothing is cut.
_CUT = regex.compile(r"(?<=[^\s\x1c-\x1f])(?= [^\s\x1c-\x1f])")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Cut a text at safe places, each piece ``size`` characters or somewhat
    more; a stretch without a safe place stays whole."""
    at = 0
    while len(text) - at > size:
        m = _CUT.search(text, at + size)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


def encode(text: str, path: str, pattern: str, size: int = PIECE_CHARS) -> np.ndarray:
    """Token ids of one text, special tokens treated as ordinary text."""
    enc, out = encoding(path, pattern), []
    for piece in pieces(text, size):
        if len(piece) <= 4 * size:
            out.append(np.array(enc.encode_ordinary(piece), dtype="<u4"))
        else:  # the library's matcher can overflow its stack here
            for m in regex.finditer(pattern, piece):
                out.append(np.array(enc._encode_single_piece(m.group()), dtype="<u4"))
    return np.concatenate(out) if out else np.empty(0, dtype="<u4")


def _texts(column: pa.Array) -> list[str]:
    """Each value; null counts as empty, bytes that are not UTF-8 as U+FFFD."""
    return [v.decode("utf-8", "replace") for v in texts_of(column)]


def tokenize(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids",
             exact: str | None = None, keep_text: bool = True) -> DataFrame:
    """Add column ``ids`` (array of int) with the token ids of ``text``, and, if
    named, column ``exact``: the ids decode to the text's bytes again.

    A null or empty text has no ids. Bytes that are not UTF-8 are encoded as
    U+FFFD, and such a text is not exact. All other columns are kept (``text`` unless
    ``keep_text`` is off); those named like the new ones are replaced. The rank
    file at ``path`` must exist on each executor."""
    names = [c for c in docs.columns if c not in (ids, exact)]
    out = docs.select(*[F.col(f"`{c}`") for c in names])
    at = names.index(text)
    kept = [c for c in names if keep_text or c != text]

    def run(batches):
        for b in small(batches, 1 << 20):
            texts = _texts(b.column(at))
            found = [encode(t, path, pattern) for t in texts]
            flat = np.concatenate([np.empty(0, "<u4"), *found]).astype(np.int32)
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
            columns = [b.column(names.index(c)) for c in kept] + [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]
            if exact:
                columns.append(pa.array([decode(x, path, pattern) == t for x, t in zip(found, texts_of(b.column(at)))]))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, ids, *([exact] if exact else [])])

    return out.mapInArrow(run, extended(out.select(*[F.col(f"`{c}`") for c in kept]),
                                        **{ids: "array<int>"}, **({exact: "boolean"} if exact else {})))


def decode(ids: np.ndarray, path: str, pattern: str) -> bytes:
    """The bytes that the ids stand for (not always valid UTF-8)."""
    return encoding(path, pattern).decode_bytes(ids.tolist())


def detokenize(tokens: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """Add the raw bytes of ``ids`` as a binary column; null ids count as none."""
    names = [c for c in tokens.columns if c != out]

    def run(batches):
        for b in small(batches, 1 << 20):
            found = [encoding(path, pattern).decode_bytes(v or []) for v in b.column(names.index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.binary())], names=[*names, out])

    df = tokens.select(*[F.col(f"`{c}`") for c in names])
    return df.mapInArrow(run, extended(df, **{out: "binary"}))


_DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                      ("decoded_sha256", pa.string())])


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode each text and decode the ids again, in one pass.

    Returns doc_id, n_tokens, ids_sha256 (of the ids as little-endian unsigned
    32-bit integers) and decoded_sha256, one row per input row; a null text
    counts as empty, bytes that are not UTF-8 as U+FFFD. Other columns are ignored."""

    def run(batches):
        for b in small(batches, 1 << 20):
            n, ids_sha, decoded_sha = [], [], []
            for text in _texts(b.column(1)):
                ids = encode(text, path, pattern)
                back = hashlib.sha256()
                for lo in range(0, len(ids), 1 << 16):
                    back.update(decode(ids[lo:lo + (1 << 16)], path, pattern))
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                decoded_sha.append(back.hexdigest())
            yield batch(_DIGESTS, b.column(0), n, ids_sha, decoded_sha)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
