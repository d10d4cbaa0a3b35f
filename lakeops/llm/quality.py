"""Quality rules: counts of words, symbols and repeats, and compression bands.

zstandard ratios (compressed bytes / bytes) of a whole document and of its
chunks tell repetitive text (low) and incompressible text (high) from
prose.  Short texts compress badly whatever they say and long ones find more
to refer back to, so each length has its own pair of limits.  One map pass;
no shuffle, and a row's memory is its own text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import arrow_batch

LEVEL = 3
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
#: From how many bytes on a whole text must stay within these ratios.  Set
#: from the ratios of documents labelled as good (0.1 % quantile and below,
#: less a margin of about a tenth).
BANDS = (
    (200, 0.40, 1.00),
    (500, 0.43, 0.85),
    (1_000, 0.40, 0.75),
    (2_000, 0.38, 0.70),
    (4_000, 0.36, 0.66),
    (8_000, 0.34, 0.64),
    (16_000, 0.32, 0.62),
    (32_000, 0.29, 0.60),
    (128_000, 0.24, 0.60),
)
#: Bytes of a chunk and its limits; a text has the largest chunks that fit into
#: it twice, or the smallest.  The limits below 2,048 bytes leave about a tenth around the ratios of all
#: such chunks of documents labelled as good.
CHUNKS = (
    (256, 0.51, 0.90),
    (512, 0.50, 0.79),
    (2_048, 0.38, 0.75),
)
#: Share of a text's bytes that may stand in chunks outside their limits.
MAX_ODD_CHUNKS = 0.34


def repeat_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows of ``width`` (a power of two) words that occur at
    least twice.  Windows get ranks by doubling: the rank of a window of 2w
    words is that of its two halves, so equal ranks mean equal words."""
    n = len(words)
    if n <= width:
        return 0
    ids = {w: i for i, w in enumerate(set(words))}
    rank = np.fromiter(map(ids.__getitem__, words), np.int64, n)
    w, kinds = 1, len(ids)
    while True:
        _, rank, count = np.unique(rank[:-w] * kinds + rank[w:], return_inverse=True, return_counts=True)
        w, kinds = 2 * w, len(count)
        if kinds == len(rank):          # no two alike: nor are longer ones
            return 0
        if w == width:
            break
    edges = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(count[rank] > 1)
    edges[at] += 1
    edges[at + width] -= 1
    return int((np.cumsum(edges[:-1]) > 0).sum())


def ratio(data: bytes, coder: zstandard.ZstdCompressor) -> float:
    return len(coder.compress(data)) / len(data)


def within_bands(data: bytes, coder: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """Whole ratio, share of bytes in odd chunks, and whether both are within
    limits.  The bytes after the last whole chunk are measured by a chunk that
    ends with the text, and count for themselves only.  A text below the first
    band's length has no verdict against it."""
    if not data:
        return 1.0, 0.0, True
    whole = ratio(data, coder)
    low, high = next(((lo, hi) for at, lo, hi in reversed(BANDS) if len(data) >= at), (0.0, float("inf")))
    odd = 0.0
    size, lowest, highest = next((c for c in reversed(CHUNKS) if len(data) >= 2 * c[0]), CHUNKS[0])
    if len(data) >= size:
        for end in range(size, len(data) + size, size):
            last = min(end, len(data))
            if not lowest <= ratio(data[last - size:last], coder) <= highest:
                odd += (size - (end - last)) / len(data)
    return whole, odd, low <= whole <= high and odd <= MAX_ODD_CHUNKS


def measure(text: bytes, coder: zstandard.ZstdCompressor) -> tuple:
    words = text.split()
    inside = b"".join(words)
    seen: set[bytes] = set()
    dup = 0
    for line in text.split(b"\n"):
        if line.strip():
            dup += line in seen
            seen.add(line)
    again = repeat_words(words)
    failed = len(words) < MIN_WORDS or 100 * again > MAX_REPEAT_PERCENT * len(words)
    whole, odd, fine = within_bands(text, coder)
    return (len(words), len(inside.decode()), len(text) - len(text.translate(None, SYMBOLS)), dup, again,
            failed, not failed and fine, whole, odd)


MEASURES = pa.schema([("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
                      ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
                      ("zstd_ratio", pa.float64()), ("odd_chunks", pa.float64())])
DDL = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
       " base_failed boolean, kept boolean, zstd_ratio double, odd_chunks double")


def quality_rules(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the measures of every row, one row each.

    A null text has no words and fails.  Empty texts likewise; very long
    ones are measured whole; repeated rows stay repeated; an empty table
    gives an empty result; other columns are left aside.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=LEVEL)
        for b in batches:
            rows = [measure(t, coder) for t in b.column("text").to_pylist()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(MEASURES)
            schema = pa.schema([b.schema.field("doc_id"), *MEASURES])
            yield arrow_batch(schema, [b.column("doc_id"), *columns])

    data = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return data.mapInArrow(run, f"doc_id {kind}, {DDL}")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=LEVEL)
        for b in batches:
            kept = [measure((t or "").encode(), coder)[6] for t in b.column(names.index("text")).to_pylist()]
            yield b.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
