"""Substring dedup by sliding spans of sentences.

Sentences are cut so that a passage falls into the same ones wherever it
stands, and so that text without punctuation has sentences too: a sentence
ends after the word that is the best end within ``REACH`` words on either
side.  Words that end in ``.``, ``!`` or ``?`` or stand last in their line are
better ends than others; among equals the checksum of the word decides.  A
sentence so has more than ``REACH`` words, and seldom very many; where one
phrase repeats over and over no word is the best, and the stretch is cut every
``PERIOD`` words.

From every sentence the shortest run of at least ``RUN`` sentences and
``MIN_WORDS`` words is taken forward, and to every sentence the shortest such
run backward: each sentence of a repeated passage that is long enough lies
in a run within the passage, the last ones included.  Runs are hashed and
joined over the whole corpus, and a sentence goes if any run over it is not
the first of its kind.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import LOWER, arrow_batch, stage_table

RUN = 3
MIN_WORDS = 16
REACH = 3
PERIOD = 12
SPANS = pa.schema([("hash", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64()), ("size", pa.int32())])


def split_words(text: bytes) -> tuple[list[bytes], list[int]]:
    """The words of a text and how many of them each line has."""
    words: list[bytes] = []
    lines = []
    for line in text.split(b"\n"):
        found = line.split()
        lines.append(len(found))
        words += found
    return words, lines


def sentence_ends(words: list[bytes], lines: list[int]) -> list[int]:
    """Index after the last word of each sentence."""
    n = len(words)
    if not n:
        return []
    rank = np.fromiter(map(zlib.crc32, words), np.int64, n)
    good = np.fromiter((w[-1] in b".!?" for w in words), np.bool_, n)
    last = np.cumsum(lines) - 1
    good[last[np.array(lines) > 0]] = True
    rank[~good] += 1 << 32
    best = np.ones(n, np.bool_)
    for d in range(1, REACH + 1):
        best[d:] &= rank[d:] < rank[:-d]
        best[:-d] &= rank[:-d] <= rank[d:]
    best[-1] = True
    ends = np.flatnonzero(best) + 1
    begins = np.concatenate(([0], ends[:-1]))
    if (ends - begins).max() <= 2 * PERIOD:
        return ends.tolist()
    return [x for a, e in zip(begins.tolist(), ends.tolist()) for x in ([*range(a + PERIOD, e - PERIOD, PERIOD), e] if e - a > 2 * PERIOD else [e])]


def runs(counts: list[int], least: int = RUN, words: int = MIN_WORDS) -> set[tuple[int, int]]:
    """(first, end) of the shortest runs from and to every sentence, for the
    sentences' word counts."""
    n, total = len(counts), [0]
    for c in counts:
        total.append(total[-1] + c)
    found: set[tuple[int, int]] = set()
    end = 0
    for i in range(n):
        end = max(end, i + least)
        while end <= n and total[end] - total[i] < words:
            end += 1
        if end > n:
            break
        found.add((i, end))
    start = 0
    for e in range(least, n + 1):
        if total[e] - total[0] < words:
            continue
        while start + 1 <= e - least and total[e] - total[start + 1] >= words:
            start += 1
        found.add((start, e))
    return found


def span_hashes(text: bytes) -> list[tuple[int, int, int]]:
    """(first sentence, sentences, signed hash) of every run of a text."""
    words, lines = split_words(text)
    ends = sentence_ends(words, lines)
    joined = b" ".join(words).translate(LOWER)
    at = np.concatenate(([0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1))).tolist()
    starts = [0, *ends]
    found = []
    for a, e in runs([e - s for s, e in zip(starts, ends)]):
        h = xxhash.xxh3_64_intdigest(joined[at[starts[a]]:at[starts[e]] - 1])
        found.append((a, e - a, h - (1 << 64) if h >> 63 else h))
    return found


def span_table(docs: DataFrame) -> DataFrame:
    """``(hash, doc_id, place, size)`` of every run of a document; ``place``
    has the low half of the text's hash above the number of the sentence."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns: list[list] = [[], [], [], []]
            for doc, key, text in zip(b.column("doc_id").to_pylist(), b.column("key").to_pylist(), b.column("text").to_pylist(), strict=True):
                for a, size, h in span_hashes(text):
                    for c, v in zip(columns, (h, doc, key + a, size), strict=True):
                        c.append(v)
                if len(columns[0]) > 200_000:
                    yield arrow_batch(SPANS, columns)
                    columns = [[], [], [], []]
            yield arrow_batch(SPANS, columns)

    return docs.mapInArrow(run, "hash long, doc_id long, place long, size int")


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, n_sentences, n_removed)`` per row: the text without
    the sentences under any repeated run but the first, by (doc_id, place).

    Lines that lose sentences have their other words joined by one space and
    go if nothing is left; other lines stay as they are.  A null text counts
    as empty.  Rows that agree in ``doc_id`` and text are one occurrence and
    all keep what it keeps; a null ``doc_id`` comes after all others.  A hash
    that a third of the documents share is one row once it is counted, and
    meets its occurrences in a join that adaptive execution can split.
    """
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
            .withColumn("key", F.shiftleft(F.xxhash64("text"), 32)))
    spans = stage_table(span_table(rows), "spans")
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place")
    repeated = stage_table(spans.groupBy("hash").agg(F.min(at).alias("first"), F.count("*").alias("n")).filter("n > 1")
                           .select("hash", F.col("first.doc_id").alias("d"), F.col("first.place").alias("p")), "spans-repeated")
    later = spans.join(repeated, "hash").filter("NOT (doc_id <=> d AND place = p)")
    start = F.col("place").bitwiseAND(F.lit((1 << 32) - 1))
    gone = (later.groupBy("doc_id", (F.col("place") - start).alias("key")).agg(F.collect_set(F.struct(start.cast("int").alias("start"), "size")).alias("gone"))
            .select(F.col("doc_id").alias("g_id"), F.col("key").alias("g_key"), F.col("gone.start").alias("starts"), F.col("gone.size").alias("sizes")))
    gone = stage_table(gone, "spans-gone")
    joined = rows.join(gone.hint("shuffle_hash"), rows["doc_id"].eqNullSafe(gone["g_id"]) & (rows["key"] == gone["g_key"]), "left")
    out = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_sentences", pa.int64()), ("n_removed", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [clean(*x) for x in zip(b.column("text").to_pylist(), b.column("starts").to_pylist(), b.column("sizes").to_pylist(), strict=True)]
            yield arrow_batch(out, [b.column("doc_id"), *[list(c) for c in zip(*found, strict=True)]] if found else [[], [], [], []])

    return joined.select("doc_id", "text", "starts", "sizes").mapInArrow(run, "doc_id long, text string, n_sentences long, n_removed long")


def clean(text: bytes, starts: list[int] | None, sizes: list[int] | None) -> tuple[str, int, int]:
    """The text without the sentences of these runs, and how many it had and
    lost."""
    words, lines = split_words(text)
    ends = sentence_ends(words, lines)
    if not starts:
        return text.decode(), len(ends), 0
    gone = {i for a, n in zip(starts, sizes or (), strict=True) for i in range(a, a + n)}
    lost = np.zeros(len(words), np.bool_)
    begins = [0, *ends]
    for i in gone:
        lost[begins[i]:begins[i + 1]] = True
    kept, at = [], 0
    for line, n in zip(text.split(b"\n"), lines, strict=True):
        cut = lost[at:at + n]
        if not cut.any():
            kept.append(line)
        elif not cut.all():
            kept.append(b" ".join(w for w, x in zip(words[at:at + n], cut, strict=True) if not x))
        at += n
    return b"\n".join(kept).decode(), len(ends), len(gone)
