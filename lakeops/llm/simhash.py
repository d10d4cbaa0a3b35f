"""SimHash near-duplicates by covering locality-sensitive hashing.

A document's 64-bit fingerprint is the bitwise majority of the XXH64 hashes
of its word shingles.  Documents whose fingerprints differ in at most
``radius`` bits are linked; a component of links is a group.

Candidates come from covering LSH: bit position i gets a non-zero vector
m(i) of radius+1 bits, and table v (each non-zero v) masks the fingerprint
to the positions with odd <m(i), v>.  The at most ``radius`` vectors of a
pair's differing positions span less than the whole space, so some v is
orthogonal to all of them and that table's mask hides every difference: the
pair shares that table's key for certain, no probability involved.

Only distinct fingerprints enter the tables (copies are one row, however
many there are).  A bucket is never turned into pairs: fingerprints with
company in a bucket are checked through midpoints.  Two fingerprints are at
most 2 bits apart exactly if some z is at most 1 bit from both, so each
candidate names itself and its one-bit neighbours at the positions its
shared tables hide, and all that name the same z are linked to the smallest
of them -- at most 65 per z, whatever the size of the bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import LOWER, arrow_batch, doc_bytes, stage_table
from lakeops.llm.components import connected_components

BITS = 64
RADIUS = 2
SHINGLE = 3
SEED = 42
#: Hashes whose bits are counted at once: bounds the memory of a long text.
BLOCK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit majority fingerprint; 0 for a text without words."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        value = digest(joined, SEED)
        return value - (1 << 64) if value >> 63 else value
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-shingle] + 1)).tolist()
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist(), strict=True)], dtype="<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at:at + BLOCK]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, text_hash, fp)`` for every row; a null text counts as empty.
    ``text_hash`` tells rows apart that share a ``doc_id``."""
    out = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            yield arrow_batch(out, [b.column("doc_id"), b.column("text_hash"), [fingerprint(t, shingle) for t in texts]])

    rows = doc_bytes(docs).select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """One mask per non-zero v of radius+1 bits; position i has the vector
    1 + i mod (2^(radius+1) - 1), so every mask keeps about half the bits."""
    n = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(bits) if bin((1 + i % n) & v).count("1") % 2) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(classes: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` between the distinct values ``fp`` of ``classes``
    whose components are those of 'at most 2 bits apart'."""
    masks = [_signed(m) for m in covering_masks()]
    keyed = classes.select("fp", F.posexplode(F.array(*[F.lit(m).bitwiseAND(F.col("fp")) for m in masks])).alias("v", "key"))
    shared = stage_table(keyed.groupBy("v", "key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"))
                         .filter("lo < hi").select("v", "key"), "simhash-buckets")
    hidden = F.element_at(F.array(*[F.lit(_signed(~m & ((1 << 64) - 1))) for m in covering_masks()]), F.col("v") + 1)
    candidates = stage_table(keyed.join(shared, ["v", "key"]).groupBy("fp").agg(F.bit_or(hidden).alias("free")), "simhash-candidates")
    near = candidates.select("fp", F.explode(F.expr(
        "array_append(transform(filter(sequence(0, 63), i -> (shiftright(free, i) & 1L) = 1L),"
        " i -> fp ^ shiftleft(1L, i)), fp)")).alias("z"))
    groups = near.groupBy("z").agg(F.collect_list("fp").alias("members")).filter("size(members) > 1")
    return (groups.select(F.array_min("members").alias("a"), F.explode("members").alias("b")).filter("a <> b"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, text_hash, fp, component_id, first_id, first_hash)``, one row
    per input row: the smallest ``doc_id`` reachable over links of at most 2
    differing bits, and the (doc_id, text_hash) of the row that stands for
    the group.

    Null and word-less texts have fingerprint 0 and are linked like any
    other; repeated rows stay repeated.  A null ``doc_id`` is never the
    smallest unless the whole group has none.  An empty table gives an empty
    result.  The hot group of copies is one row from the first aggregate on;
    the last join, where its rows meet that row again, is one adaptive
    execution can split.
    """
    rows = stage_table(fingerprints(docs, shingle), "simhash-fp")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    classes = stage_table(rows.groupBy("fp").agg(first.alias("first")), "simhash-classes")
    labels = connected_components(links(classes))
    labelled = stage_table(classes.join(labels, classes.fp == labels.id, "left").select("fp", "first", F.coalesce("label", "fp").alias("label")), "simhash-labelled")
    groups = stage_table(labelled.groupBy("label").agg(F.min("first").alias("first")), "simhash-groups")
    named = stage_table(labelled.select("fp", "label").join(groups, "label")
                        .select("fp", F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_hash")), "simhash-named")
    return rows.join(named, "fp").select("doc_id", "text_hash", "fp", F.col("first_id").alias("component_id"), "first_id", "first_hash")


def fingerprint_hex(fp):
    """The 16 lowercase hexadecimal digits of a signed fingerprint column."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` less all but one of each near-duplicate group: the
    one with the smallest ``doc_id``; of rows that agree in ``doc_id`` and
    text, one.  All columns are kept as they are."""
    from pyspark.sql import Window

    groups = near_duplicates(docs, shingle)
    stay = stage_table(groups.filter("first_id <=> doc_id and first_hash = text_hash")
                       .select(F.coalesce("first_id", F.lit(-1)).alias("id"), F.col("first_id").isNull().alias("none"), F.col("first_hash").alias("hash")).distinct(), "simhash-stay")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("id"),
                       F.col("doc_id").isNull().alias("none"), F.xxhash64(F.coalesce("text", F.lit("")).cast("binary")).alias("hash"))
    kept = rows.join(stay, ["id", "none", "hash"], "left_semi")
    one = F.row_number().over(Window.partitionBy("id", "none", "hash").orderBy("hash"))
    return kept.withColumn("one", one).filter("one = 1").select("row.*")
