"""Benchmark decontamination as a prefix-filtered set join.

A benchmark item is cut into windows of 13 consecutive words (a shorter item
is one window).  A window occurs in a document only if all of its shingles
do, so one shingle is a sufficient prefix of the join: the window's rarest
one by document frequency over the whole corpus.  Windows whose rarest
shingle occurs nowhere leave the join.  A prefix match at a position fixes
where the window would have to start; it must lie inside the document
(positional and length bound) and then agree word by word.

Documents are never shuffled: the windows travel to them, in blocks of at
most ``BLOCK_WINDOWS`` distinct windows.  A larger benchmark takes several
blocks, each with its own passes over the documents, whose hits are merged by
document.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import arrow_batch, doc_bytes, stage_table

WINDOW = 13
SHINGLE = 5
#: Distinct windows (about 100 bytes each) sent to the tasks at once.
BLOCK_WINDOWS = 500_000
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z went to lower case: ASCII
#: letters and digits and all bytes of other characters; the rest separate.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))

#: Shingle length -> shingle -> what is known of it.
Table = dict[int, dict[bytes, object]]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def shingles_of(window: list[bytes], size: int = SHINGLE) -> list[bytes]:
    k = min(size, len(window))
    return [b" ".join(window[i:i + k]) for i in range(len(window) - k + 1)]


def windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """``(window, items)``: each distinct window and the ids of its items."""
    out = pa.schema([("window", pa.binary()), ("item", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for item, text in zip(b.column("item").to_pylist(), b.column("text").to_pylist(), strict=True):
                w = words_of(text)
                n = min(width, len(w))
                found += [(b" ".join(w[i:i + n]), item) for i in range(len(w) - n + 1) if n]
            yield arrow_batch(out, list(zip(*found, strict=True)) if found else [[], []])

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, "window binary, item string").groupBy("window").agg(F.collect_set("item").alias("items"))


def _positions(words: list[bytes], table: Table, firsts: set[bytes]) -> Iterator[tuple[int, bytes, object]]:
    """Where the document holds a shingle of the table."""
    near = [i for i, w in enumerate(words) if w in firsts]
    for k, known in table.items():
        last = len(words) - k
        for i in near:
            if i <= last:
                shingle = b" ".join(words[i:i + k])
                if shingle in known:
                    yield i, shingle, known[shingle]


def _firsts(table: Table) -> set[bytes]:
    return {s.split(b" ", 1)[0] for known in table.values() for s in known}


def document_frequency(docs: DataFrame, table: Table) -> Counter:
    """How many documents hold each shingle of the table: one pass over all
    documents, one partial count per task, summed by Spark."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(table)
    out = pa.schema([("shingle", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = sent.value, Counter()
        firsts = _firsts(known)
        for b in batches:
            for text in b.column("text").to_pylist():
                counts.update({s for _, s, _ in _positions(words_of(text), known, firsts)})
        yield arrow_batch(out, [list(counts.keys()), list(counts.values())])

    rows = doc_bytes(docs).select("text").mapInArrow(run, "shingle binary, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    return Counter({bytes(r.shingle): r.n for r in rows.toLocalIterator()})


def prefix_table(found: list[tuple[bytes, list[str]]], frequency: Counter) -> Table:
    """Rarest shingle -> (its offset, the window's words, the window, items)."""
    table: Table = defaultdict(lambda: defaultdict(list))
    for window, items in found:
        words = window.split(b" ")
        shingles = shingles_of(words)
        rare = min(shingles, key=lambda s: (frequency[s], s))
        if frequency[rare]:
            table[min(SHINGLE, len(words))][rare].append((shingles.index(rare), len(words), window, items))
    return {k: dict(v) for k, v in table.items()}


def scan(text: bytes, table: Table, firsts: set[bytes]) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, (start, end) of every occurring window, items."""
    words = words_of(text)
    spans: list[tuple[int, int]] = []
    items: set[str] = set()
    for i, _, known in _positions(words, table, firsts):
        for offset, size, window, names in known:
            start = i - offset
            if start >= 0 and start + size <= len(words) and b" ".join(words[start:start + size]) == window:
                spans.append((start, start + size))
                items.update(names)
    return len(words), spans, items


def covered(spans: list[tuple[int, int]]) -> int:
    """Words inside any span."""
    total, reach = 0, 0
    for a, b in sorted(spans):
        total += max(0, b - max(a, reach))
        reach = max(reach, b)
    return total


def _blocks(docs: DataFrame, benchmark: DataFrame, size: int) -> tuple[int, Iterator[Table]]:
    """The number of blocks and their prefix tables, each made when asked for:
    the driver holds one block's windows at a time."""
    found = stage_table(windows(benchmark), "decontam-windows")
    n = -(-max(found.count(), 1) // size)

    def block(k: int) -> Table:
        part = found.filter(F.pmod(F.xxhash64("window"), F.lit(n)) == k)
        rows = [(bytes(r.window), r.items) for r in part.toLocalIterator()]
        every: Table = defaultdict(dict)
        for window, _ in rows:
            for s in shingles_of(window.split(b" ")):
                every[s.count(b" ") + 1][s] = True
        return prefix_table(rows, document_frequency(docs, dict(every)))

    return n, map(block, range(n))


def _verdict(n_words: int, n_hit: int) -> bool:
    return n_hit > 0 and 20 * n_hit >= n_words


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated``; ``text_hash`` tells rows of one ``doc_id`` apart.

    Null and empty texts have no words and are never contaminated; an item
    without words has no window; an item without id goes by the empty name
    and items that share an id are one.  Repeated rows stay repeated; either
    table may be empty; other columns are left aside.
    """
    n_blocks, tables = _blocks(docs, benchmark, block_windows)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = doc_bytes(docs).withColumn("text_hash", F.xxhash64("text"))
    ddl = f"doc_id {kind}, text_hash long, n_words long, starts array<long>, ends array<long>, items array<string>"

    def hits(table: Table, everyone: bool) -> DataFrame:
        sent = docs.sparkSession.sparkContext.broadcast(table)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = sent.value
            firsts = _firsts(known)
            for b in batches:
                found = [scan(t, known, firsts) for t in b.column("text").to_pylist()]
                schema = pa.schema([b.schema.field("doc_id"), ("text_hash", pa.int64()), ("n_words", pa.int64()),
                                    ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
                out = arrow_batch(schema, [b.column("doc_id"), b.column("text_hash"), [n for n, _, _ in found],
                                           [[a for a, _ in s] for _, s, _ in found], [[e for _, e in s] for _, s, _ in found],
                                           [sorted(i) for _, _, i in found]])
                yield out if everyone else out.filter(pa.array([bool(s) for _, s, _ in found], pa.bool_()))

        return rows.mapInArrow(run, ddl)

    if n_blocks == 1:
        found = hits(next(tables), everyone=True)
    else:
        parts = [stage_table(hits(t, everyone=k == 0), f"decontam-hits-{k}").withColumn("n_rows", F.lit(int(k == 0)))
                 for k, t in enumerate(tables)]
        found = (reduce(DataFrame.unionByName, parts).groupBy("doc_id", "text_hash")
                 .agg(F.max("n_words").alias("n_words"), F.sum("n_rows").alias("n_rows"),
                      *[F.flatten(F.collect_set(c)).alias(c) for c in ("items",)],
                      F.flatten(F.collect_set(F.arrays_zip("starts", "ends"))).alias("spans"))
                 .select("doc_id", "text_hash", "n_words", F.col("spans.starts").alias("starts"), F.col("spans.ends").alias("ends"),
                         F.array_distinct("items").alias("items"), F.explode(F.sequence(F.lit(1), F.col("n_rows")))).drop("col"))
    report = pa.schema([("text_hash", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                        ("items_sha256", pa.string()), ("contaminated", pa.bool_())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, items = b.column("n_words").to_pylist(), b.column("items").to_pylist()
            hit = [covered(list(zip(s, e, strict=True))) for s, e in zip(b.column("starts").to_pylist(), b.column("ends").to_pylist(), strict=True)]
            yield arrow_batch(pa.schema([b.schema.field("doc_id"), *report]), [
                b.column("doc_id"), b.column("text_hash"), words, hit, [len(i) for i in items],
                [hashlib.sha256(",".join(sorted(i)).encode()).hexdigest() for i in items],
                [_verdict(n, h) for n, h in zip(words, hit, strict=True)]])

    return found.mapInArrow(judge, f"doc_id {kind}, text_hash long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def keep_clean(docs: DataFrame, benchmark: DataFrame, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they
    are.  With one block of windows the rows are judged where they lie; with
    more, the judged rows are taken out by an anti-join."""
    n_blocks, tables = _blocks(docs, benchmark, block_windows)
    if n_blocks == 1:
        sent, at = docs.sparkSession.sparkContext.broadcast(next(tables)), docs.columns.index("text")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = sent.value
            firsts = _firsts(known)
            for b in batches:
                found = [scan((t or "").encode(), known, firsts) for t in b.column(at).to_pylist()]
                yield b.filter(pa.array([not _verdict(n, covered(s)) for n, s, _ in found], pa.bool_()))

        return docs.mapInArrow(run, docs.schema)
    bad = stage_table(decontaminate(docs, benchmark, block_windows).filter("contaminated").select("doc_id", "text_hash").distinct(), "decontam-bad")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(F.coalesce("text", F.lit("")).cast("binary")).alias("hash"))
    return rows.join(bad, rows["row.doc_id"].eqNullSafe(bad["doc_id"]) & (rows["hash"] == bad["text_hash"]), "left_anti").select("row.*")


def oracle_sql() -> str:
    """The report in DuckDB SQL by comparing every window with every run of
    as many words."""
    words = ("list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
             " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')")
    return f"""WITH b AS (SELECT item_id, {words} AS w FROM benchmark),
        win AS (SELECT item_id, least({WINDOW}, len(w)) AS n, array_to_string(w[i:i + least({WINDOW}, len(w)) - 1], ' ') AS s
                FROM (SELECT item_id, w, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
        d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
        g AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
              FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
        h AS (SELECT g.r, g.i, g.n, win.item_id FROM g JOIN win ON g.s = win.s AND g.n = win.n),
        c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM h)) GROUP BY r),
        t AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
        FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)"""
