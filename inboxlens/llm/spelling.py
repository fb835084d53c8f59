"""Spelling variants: words of a corpus that differ by one code point.

Words are counted over all texts. Two words that differ by one inserted, deleted
or replaced code point share the first half of either or its last half, so a
word is searched for twice: among the words that may begin with its first half,
extending to the right with one error, and among those that may end with its
last half, extending to the left. For that the vocabulary is dealt out twice, in
ranges of the words and of the reversed words, a bidirectional FM-index each
(``fm_index``). A range that many words begin with is several shards, and a word
visits all that its half reaches into. A pair that shares both halves counts in
the first search only.

A word's form is its commonest near word, if that is far commoner; following
forms leads to the root.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fm_index import Vocabulary
from .shared import batch, drop, small, stored, texts_of

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10  # a form is at least so many times as common
SYMBOLS = 1 << 19  # of a shard's words, about
SAMPLE = 1 << 15  # words that the ranges are cut by
SHARDS = 4096  # at most, in each direction
CUT_LENGTH = 64  # code points of a cut
TOGETHER = 1 << 14  # words that search a shard in one go
HELD = 1 << 19  # words counted in a task before they are passed on
ONE_IN = 31  # runs that lose a code point
LAST = "\U0010ffff"

_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
_VISITS = pa.schema([("side", pa.int32()), ("shard", pa.int32()), ("flag", pa.int32()), ("word", pa.string()), ("n", pa.int64())])
_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("neg", pa.int64()), ("near", pa.string())])

# Fixed by the contract: letters A-Z (lower-cased), a-z and U+00C0 to U+00FF.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def _count(least: int):
    """Words of at least ``least`` code points and how often they occur."""
    runs = re.compile(rb"[^ ]{%d,}" % least)

    def run(batches):
        held: Counter = Counter()
        for b in small(batches):
            for doc, text in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
                # one byte a code point; those beyond U+00FF become "?", which is no letter
                found = runs.findall(text.decode("utf-8", "replace").encode("latin-1", "replace").translate(_LETTERS))
                start = None if doc is None else zlib.crc32(b"%d:" % doc)
                for word, n in Counter(found).items():
                    if start is not None:
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                        if h % ONE_IN == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < least:
                                continue
                    held[word] += n
            if len(held) > HELD:
                yield batch(_COUNTS, [w.decode("latin-1") for w in held], held.values())
                held = Counter()
        if held:
            yield batch(_COUNTS, [w.decode("latin-1") for w in held], held.values())
    return run


def count_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word and n of the words of ``docs`` (doc_id, text).

    Words are the maximal runs of letters of a text, A-Z lower-cased. Where 31
    divides the crc32 of ``<doc_id>:<run>``, the run has lost a code point, at
    the crc32 modulo its length (not without a doc_id). Those of at least
    ``least_length`` code points that occur ``least_count`` times in all stay."""
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
    return (plain.mapInArrow(_count(least_length), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


def _cuts(words: DataFrame, shards: int) -> tuple[list[str], list[str]]:
    """Where the ranges of words and of reversed words end, by a sample's symbols."""
    rows = (words.orderBy(F.xxhash64("word"), "word").limit(SAMPLE)
            .select(F.substring("word", 1, CUT_LENGTH), F.substring(F.reverse("word"), 1, CUT_LENGTH), F.char_length("word")).collect())
    total = sum(r[2] for r in rows)
    out = []
    for column in (0, 1):
        cuts, sum_ = [], 0
        for r in sorted(rows, key=lambda r: r[column]):
            if sum_ * shards >= total * (len(cuts) + 1):
                cuts.append(r[column])
            sum_ += r[2]
        out.append(sorted(set(cuts)))
    return out[0], out[1]


def _visits(cuts: tuple[list[str], list[str]]):
    """Each word in its shard of both sides (flag 0), and in those it searches (flag 1)."""
    def run(batches):
        for b in small(batches, 1 << 20):
            out = []
            for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                half = len(word) // 2
                for side, (own, part) in enumerate(((word, word[:half]), (word[::-1], word[half:][::-1]))):
                    out.append((side, bisect_right(cuts[side], own), 0, word, n))
                    # words that begin with the half are behind it and before it with the last code point
                    for shard in range(bisect_right(cuts[side], part), bisect_left(cuts[side], part + LAST) + 1):
                        out.append((side, shard, 1, word, n))
            if out:
                yield batch(_VISITS, *zip(*out))
    return run


def _found(vocabulary: Vocabulary, counts: list[int], words: list[str], side: int):
    """Each word's number of near words and the commonest, in this shard."""
    if side == 0:
        pairs = zip(*(x.tolist() for x in vocabulary.one_error(words, True)))
    else:
        pairs = ((q, w) for q, w in zip(*(x.tolist() for x in vocabulary.one_error(words, False)))
                 if not vocabulary.words[w].startswith(words[q][:len(words[q]) // 2]))
    best: dict[int, tuple] = {}
    for q, w in pairs:
        n, *old = best.get(q, (0, (1, "")))
        best[q] = (n + 1, min(old[0], (-counts[w], vocabulary.words[w])))
    return [(words[q], n, neg, near) for q, (n, (neg, near)) in best.items()]


def _search(batches):
    """Sorted rows: a shard's words in order (flag 0), then those that search it."""
    at, words, counts, asked, vocabulary = None, [], [], [], None

    def answers():
        nonlocal vocabulary, asked
        if asked and words:
            vocabulary = vocabulary or Vocabulary(words)
            out = _found(vocabulary, counts, asked, at[0])
            if out:
                yield batch(_NEAR, *zip(*out))
        asked = []

    for b in small(batches):
        side, shard, flag = (b.column(i).to_numpy() for i in range(3))
        text, n = b.column(3).to_pylist(), b.column(4).to_pylist()
        for i in range(b.num_rows):
            if (side[i], shard[i]) != at:
                yield from answers()
                at, words, counts, vocabulary = (side[i], shard[i]), [], [], None
            if flag[i] == 0:
                words.append(text[i])
                counts.append(n[i])
            else:
                asked.append(text[i])
                if len(asked) >= TOGETHER:
                    yield from answers()
    yield from answers()


def near_words(words: DataFrame) -> DataFrame:
    """For each of the stored, distinct ``words`` (word, n) that has near words,
    those that differ by exactly one inserted, deleted or replaced code point:
    word, n_near, near (the commonest; ties: the smallest by code points) and near_n."""
    symbols = words.agg(F.sum(F.char_length("word") + 1)).head()[0] or 0
    cuts = _cuts(words, max(1, min(SHARDS, symbols // SYMBOLS)))
    visits = words.select("word", "n").mapInArrow(_visits(cuts), "side int, shard int, flag int, word string, n long")
    found = (visits.repartition("side", "shard").sortWithinPartitions("side", "shard", "flag", "word")
             .mapInArrow(_search, "word string, n_near long, neg long, near string"))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("neg", "near")).alias("best"))
            .select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.neg")).alias("near_n")))


def _roots(forms: DataFrame) -> DataFrame:
    """word and root of stored (word, form): forms are followed twice as far each
    time. Counts grow along them, by RATIO at least, so that there is an end."""
    roots, mine = forms.select("word", F.col("form").alias("root")), False
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        if roots.join(further, "root", "left_semi").isEmpty():
            return roots
        new = stored(roots.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "roots")
        if mine:
            drop(roots)
        roots, mine = new, True


def spelling_variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """The words of ``docs`` (doc_id, text; see ``count_words``) and how they are
    spelt elsewhere: word, form, root, n, n_near, form_n.

    n is how often a word occurs, n_near the number of its near words (see
    ``near_words``). Its form is the commonest of these (ties: the smallest by
    code points), if that occurs at least ``ratio`` times as often, and form_n
    that word's n; else both are null. root is where following forms ends, the
    word itself if it has none. A null text has no words; repeated rows count as
    often as they occur. Other columns are ignored; an empty table gives an
    empty result."""
    words = stored(count_words(docs, least_length, least_count), "words")
    far = F.col("near_n") >= ratio * F.col("n")
    judged = stored(words.join(near_words(words), "word", "left")
                    .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                            F.when(far, F.col("near")).alias("form"), F.when(far, F.col("near_n")).alias("form_n")), "judged")
    drop(words)
    roots = _roots(stored(judged.where("form is not null").select("word", "form"), "forms"))
    return (judged.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
