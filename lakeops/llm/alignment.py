"""Alignment of two tokenizers' ids, an Arrow-native pipeline.

Every text is encoded twice: space + text by a byte-level BPE (A), text by a
piece model that adds the space itself (B).  Both give tokens whose bytes,
joined, are space + text; a byte offset where a token of each ends closes a
group, and the two tokens that end there are a link.

A task works on Arrow tables of some ``PORTION`` bytes of text at a time:

* ids are a list column; flattened, with the parent indices of the list, they
  are a table of (document, id) rows;
* a token's length comes from the vocabulary by ``take``; a cumulative sum less
  the sum at the document's first token is its end in the document's bytes;
* an Acero hash join of the two tables on (document, end) gives the links;
* ``Table.group_by`` counts the id pairs of the portion.

The portions' counts are merged by Spark.  Each portion then gets back the
counts of its own pairs, a table no larger than the portion, and sums them
over its links.  Texts are encoded once: between the two passes
the documents stand in a written table, their links as ids into the portion's
pairs.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lakeops.llm import packing
from lakeops.llm.common import stage_table

#: The two vocabularies: their names in ``public_tokenizers``.
VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A run that the library by ranks is slow or recursive on: the other encodes its text.
LONG_RUN = re.compile(r"\s{2000}|\S{2000}")
#: Bytes of text in an Arrow table (a longer text is a table of its own).
PORTION = 1 << 20

#: What the first pass writes: a row per document (``local`` null) with its
#: links, and a row per id pair of a portion (``doc_id`` and ``n_a`` null).
FOUND = pa.schema([("portion", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                   ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("links", pa.list_(pa.int32())), ("local", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])
FOUND_DDL = ("portion long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links array<int>, "
             "local int, a int, b int, n long")
SCORED = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                    ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])
SCORED_DDL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """Letters of a byte-level vocabulary: printable Latin-1 bytes are their
    own letter, the others are the letters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def piece_bytes(piece: str) -> bytes:
    """A piece's bytes: ``<0xHH>`` is that byte, U+2581 a space."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


@lru_cache(maxsize=2)
def encoder_a(file: str, ranks: str | None = None):
    """``(texts -> ids, bytes of every id)``; special tokens' strings are text.

    With ``ranks``, the same vocabulary by ranks, its library encodes: the same
    ids at a third of the time, but for texts with a ``LONG_RUN``."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a task has one core
    model, letters = Tokenizer.from_file(file), byte_letters()
    model.encode_special_tokens = True
    size = model.get_vocab_size()
    table = [b""] * size
    for token, i in model.get_vocab().items():
        known = all(c in letters for c in token)
        table[i] = bytes(letters[c] for c in token) if known else token.encode()

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]

    if not ranks:
        return encode, table
    quick = packing.tokenizer(ranks)
    return lambda texts: [encode([t])[0] if LONG_RUN.search(t) else quick.encode_ordinary(t) for t in texts], table


@lru_cache(maxsize=2)
def encoder_b(file: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=file)
    table = [piece_bytes(model.id_to_piece(i)) for i in range(model.get_piece_size())]
    return lambda texts: model.encode(texts, num_threads=1), table


def lists(ids: list) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)])
    flat = np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def joined(ids: pa.ListArray, vocabulary: pa.Array) -> pa.Array:
    """The bytes of every list of ids."""
    spelled = pa.LargeListArray.from_arrays(pc.cast(ids.offsets, pa.int64()), vocabulary.take(ids.values))
    return pc.binary_join(spelled, pa.scalar(b"", pa.large_binary()))


def token_ends(ids: pa.ListArray, lengths: pa.Array, name: str) -> pa.Table:
    """``(doc, end, <name>, i<name>)`` for every token: its list, its end, its
    id, its place among all tokens.  ``end`` is the document's start in the
    portion plus the offset of the token's end in the document: as both sides
    have the same bytes, a document and an end there are one number."""
    flat = ids.flatten()
    return pa.table({"doc": pc.list_parent_indices(ids), "end": pc.cumulative_sum(lengths.take(flat)), name: flat, f"i{name}": pa.array(np.arange(len(flat), dtype=np.int32))})


@lru_cache(maxsize=2)
def spellings(size_a: int, size_b: int) -> pa.Array:
    """Decimal ids with what may follow them: A's before a comma and a bar,
    B's before a comma, a semicolon and nothing."""
    a, b = (pc.cast(pa.array(np.arange(n)), pa.large_string()) for n in (size_a, size_b))
    mark = [pa.scalar(c, pa.large_string()) for c in ("", ",", "|", ";")]
    return pa.concat_arrays([pc.binary_join_element_wise(x, mark[i], mark[0]) for x, i in ((a, 1), (a, 2), (b, 1), (b, 3), (b, 0))])


def group_texts(ids_a: pa.ListArray, ids_b: pa.ListArray, sizes: tuple[int, int], last_a: np.ndarray, last_b: np.ndarray, at: np.ndarray) -> pa.Array:
    """Each document's groups as text; ``last_a``, ``last_b`` and ``at`` have
    every group's last token on both sides and its document, in order.  All
    tokens are laid out in one row, A's of a group before B's, each spelled
    with the mark that follows it, and joined by document."""
    (size_a, size_b), (a, b) = sizes, (x.values.to_numpy().astype(np.int64) for x in (ids_a, ids_b))
    code = np.empty(len(a) + len(b), np.int64)
    group_a, group_b = (np.repeat(np.arange(len(last)), np.diff(last, prepend=-1)) for last in (last_a, last_b))
    a[last_a] += size_a                                 # a bar follows
    code[np.arange(len(a)) + np.concatenate([[0], last_b + 1])[group_a]] = a
    b += 2 * size_a
    b[last_b] += size_b                                 # a semicolon, or nothing at the document's end
    b[last_b[np.diff(at, append=-1) != 0]] += size_b
    code[np.arange(len(b)) + last_a[group_b] + 1] = b
    offsets = pc.add(pc.cast(ids_a.offsets, pa.int64()), pc.cast(ids_b.offsets, pa.int64()))
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, spellings(size_a, size_b).take(pa.array(code))), pa.scalar("", pa.large_string()))


def align(texts: list[str | None], file_a: str, file_b: str) -> tuple[list[tuple], pa.ListArray, pa.Table]:
    """One portion: ``(n_a, n_b, n_groups, groups)`` of every text, each
    text's links as places in the table of pairs, and that table
    ``(a, b, n)``."""
    ranks = path(packing.VOCABULARY) if file_a == path(VOCABULARY_A) else None
    (encode_a, bytes_a), (encode_b, bytes_b) = encoder_a(file_a, ranks), encoder_b(file_b)
    word_a, word_b = (pa.array(t, pa.large_binary()) for t in (bytes_a, bytes_b))
    given = [t or "" for t in texts]
    ids_a, ids_b = lists(encode_a([" " + t for t in given])), lists(encode_b(given))
    # a text has tokens only where both spell it
    whole = pa.array([b" " + t.encode() for t in given], pa.large_binary())
    kept = pc.and_(pc.and_(pc.equal(joined(ids_a, word_a), whole), pc.equal(joined(ids_b, word_b), whole)), pa.array(list(map(bool, given)), pa.bool_()))
    kept = kept.to_numpy(zero_copy_only=False).astype(bool)
    if not kept.all():
        ids_a, ids_b = (pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(x.value_lengths().to_numpy())]), pa.int32()), x.flatten())
                        for x in (ids_a.take(pa.array(np.flatnonzero(kept))), ids_b.take(pa.array(np.flatnonzero(kept)))))
    n_kept = int(kept.sum())
    ends_a = token_ends(ids_a, pc.cast(pc.binary_length(word_a), pa.int64()), "a")
    ends_b = token_ends(ids_b, pc.cast(pc.binary_length(word_b), pa.int64()), "b").drop_columns(["doc"])
    links = ends_a.join(ends_b, "end", join_type="inner", use_threads=False).sort_by([("ia", "ascending"), ("ib", "ascending")])
    code = pc.add(pc.multiply(pc.cast(links["a"], pa.int64()), len(bytes_b)), pc.cast(links["b"], pa.int64())).combine_chunks().dictionary_encode()
    code = code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code
    counts = pa.table({"local": code.indices}).group_by("local", use_threads=False).aggregate([([], "count_all")]).sort_by("local")
    spelled = code.dictionary.to_numpy()
    pairs = pa.table({"a": pa.array((spelled // len(bytes_b)).astype(np.int32)), "b": pa.array((spelled % len(bytes_b)).astype(np.int32)),
                      "n": counts["count_all"], "local": counts["local"]})
    doc = links["doc"].to_numpy()
    # groups end where a link does; tokens of no bytes share an end with others and close no further group
    new = np.flatnonzero(np.concatenate([(doc[1:] != doc[:-1]) | (np.diff(links["end"].to_numpy()) != 0), [True]])) if len(doc) else np.empty(0, np.int64)
    last_a, last_b = links["ia"].to_numpy()[new], links["ib"].to_numpy()[new]
    texts_out = group_texts(ids_a, ids_b, (len(bytes_a), len(bytes_b)), last_a, last_b, doc[new]).to_pylist()
    n_groups, n_links = np.bincount(doc[new], minlength=n_kept), np.bincount(doc, minlength=n_kept)
    rows, flat = [(0, 0, 0, 0, "")] * len(texts), pc.cast(code.indices, pa.int32())
    sizes = np.zeros(len(texts), np.int64)
    sizes[kept] = n_links
    counts = zip(np.flatnonzero(kept).tolist(), ids_a.value_lengths().to_pylist(), ids_b.value_lengths().to_pylist(), n_groups.tolist(), n_links.tolist(), texts_out, strict=True)
    for d, na, nb, ng, nl, groups in counts:
        rows[d] = (na, nb, ng, nl, groups)
    return rows, pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), flat), pairs


def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list]]:
    """``(doc_ids, texts)`` of about ``PORTION`` bytes each."""
    for b in batches:
        size = pc.fill_null(pc.binary_length(pc.cast(b.column("text"), pa.binary())), 0).to_numpy().astype(np.int64)
        start, held = 0, 0
        for i, n in enumerate(size.tolist()):
            if held and held + n > PORTION:
                yield b.column("doc_id").slice(start, i - start), b.column("text").slice(start, i - start).to_pylist()
                start, held = i, 0
            held += n
        yield b.column("doc_id").slice(start), b.column("text").slice(start).to_pylist()


def found(docs: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """The first pass: see :data:`FOUND`.  A portion's number is that of the
    task and its place there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for i, (ids, texts) in enumerate(portions(batches)):
            rows, links, pairs = align(texts, file_a, file_b)
            n, m = len(rows), len(pairs)
            portion = (task << 32) + i
            na, nb, ng, nl, groups = zip(*rows, strict=True) if rows else ((),) * 5
            sha = [hashlib.sha256(g.encode()).hexdigest() if a else "" for g, a in zip(groups, na, strict=True)]
            cols = [np.full(n, portion), ids, na, nb, ng, nl, sha, links]
            yield pa.RecordBatch.from_arrays([*[c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, FOUND, strict=False)],
                                              *[pa.nulls(n, f.type) for f in list(FOUND)[8:]]], schema=FOUND)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, portion)), *[pa.nulls(m, f.type) for f in list(FOUND)[1:8]],
                                              *[pc.cast(pairs[c], f.type).combine_chunks() for c, f in zip(("local", "a", "b", "n"), list(FOUND)[8:], strict=True)]], schema=FOUND)

    text = F.when(F.is_valid_utf8("text"), F.col("text")).alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(run, FOUND_DDL)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``(a, b, count, best)`` of ``pairs(a, b, n)``: the pair's links in the
    whole corpus, and whether no other pair of that ``b`` has more."""
    counts = stage_table(pairs.groupBy("a", "b").agg(F.sum("n").alias("count")), "align-counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def _score(left: pa.Table, right: pa.Table) -> pa.Table:
    """A portion's documents with the sums over their links."""
    links, known = left["links"].combine_chunks(), right.sort_by("local").combine_chunks()
    flat = links.flatten()
    sums = pa.table({"doc": pc.list_parent_indices(links), "count": known["count"].take(flat), "best": pc.cast(known["best"], pa.int64()).take(flat)})
    sums = sums.group_by("doc", use_threads=False).aggregate([("count", "sum"), ("best", "sum")])
    count, best = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
    at = sums["doc"].to_numpy()
    count[at], best[at] = sums["count_sum"].to_numpy(), sums["best_sum"].to_numpy()
    return pa.Table.from_arrays([*[left[f.name].cast(f.type) for f in list(SCORED)[:5]], pa.array(best), pa.array(count), left["groups_sha256"].cast(pa.string())], schema=SCORED)


def token_alignment(docs: DataFrame, file_a: str | None = None, file_b: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Per document ``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256)``, and the corpus's id pairs ``(a, b, count, best)``.

    A text has no tokens -- zeros, and '' for the hash -- if it is null, empty
    or not valid UTF-8, or if either side's bytes are not those of space + text
    (a piece model may normalise).  Repeated rows and null ids are rows as any
    other, a text of any length is whole, columns other than ``doc_id`` and
    ``text`` are not read, an empty table gives an empty result.
    """
    rows = stage_table(found(docs, file_a or path(VOCABULARY_A), file_b or path(VOCABULARY_B)), "align-found")
    documents = rows.filter("n_a IS NOT NULL").select("portion", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")
    pairs = rows.filter("n_a IS NULL").select(F.col("portion").alias("of"), "local", "a", "b", "n")
    counts = stage_table(pair_counts(pairs), "align-pairs")
    # a frequent pair is in every portion, and adaptive execution can split its rows
    back = pairs.join(counts, ["a", "b"]).select("of", "local", "count", "best")
    scored = documents.groupBy("portion").cogroup(back.groupBy("of")).applyInArrow(_score, SCORED_DDL)
    return scored, counts
