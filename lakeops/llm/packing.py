"""Hierarchical multi-length packing of tokenised documents.

Context tiers are powers of two.  A document gives whole windows of the
longest tier; what is left is routed to the smallest tier that holds it.
Tiers are packed from the longest down: a piece opens a window of its tier,
and the gap behind it is filled with the longest pieces of shorter tiers that
fit; when none fits, a piece is cut to close the gap exactly.  So every
window is full, at the price of one cut each.  What remains when a task's
documents run out is written as windows of decreasing powers of two.

Finished windows are dealt to step groups of equal tokens, longest first to
the group with the fewest tokens so far.  A task packs its own partition as
it streams by; nothing is shuffled and no task sees more than its split.
"""

from __future__ import annotations

import heapq
import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lakeops.llm.common import arrow_batch, doc_bytes

TIERS = (256, 512, 1024, 2048)
END = 1
STEP_TOKENS = 1 << 17
#: Tokens that a task holds before it packs: bounds its memory.
POOL_TOKENS = 1 << 21
#: The vocabulary by ranks: the same ids as ``byte_bpe_50k.json`` gives, at a
#: quarter of the time; the special token's text is its id, as there.
VOCABULARY = "byte_bpe_50k.tiktoken"
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256

PIECES = pa.schema([("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
                    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("context", pa.int32()), ("step_group", pa.int64())])
DDL = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, context int, step_group long"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def tokenizer(path: str):
    import base64

    import public_tokenizers
    import tiktoken
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


#: White space of this length goes to the other library: this one's pattern
#: recurses on it and ends the process on runs of some 100,000.
LONG_BLANK = re.compile(r"\s{2000}")


@lru_cache(maxsize=1)
def careful_tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))


def encode(coder, text: str) -> list[int]:
    """The text's ids, without those of begin and end."""
    if LONG_BLANK.search(text):
        return careful_tokenizer().encode(text, add_special_tokens=False).ids
    if SPECIAL not in text:
        return coder.encode_ordinary(text)
    first, *rest = text.split(SPECIAL)
    return coder.encode_ordinary(first) + [i for part in rest for i in (SPECIAL_ID, *coder.encode_ordinary(part))]


class Piece:
    """A run of one document's ids."""

    __slots__ = ("doc", "doc_tokens", "ids", "start")

    def __init__(self, doc, start: int, ids: np.ndarray, doc_tokens: int):
        self.doc, self.start, self.ids, self.doc_tokens = doc, start, ids, doc_tokens

    def split(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[:n], self.doc_tokens), Piece(self.doc, self.start + n, self.ids[n:], self.doc_tokens)


class Packer:
    """Packs the documents of one task; ``out`` collects rows of pieces."""

    def __init__(self, first_id: int, tiers: tuple[int, ...] = TIERS):
        self.tiers, self.next_sequence, self.next_group = sorted(tiers), first_id, first_id
        self.pool: list[tuple[int, int, Piece]] = []       # by length, then arrival
        self.tokens = self.arrived = 0
        self.windows: list[tuple[int, list[Piece]]] = []

    def add(self, doc, ids: np.ndarray) -> None:
        longest, piece = self.tiers[-1], Piece(doc, 0, ids, len(ids))
        while len(piece.ids) >= longest:
            head, piece = piece.split(longest)
            self.windows.append((longest, [head]))
        if len(piece.ids):
            self._hold(piece)

    def _hold(self, piece: Piece) -> None:
        self.arrived += 1
        self.tokens += len(piece.ids)
        insort(self.pool, (len(piece.ids), self.arrived, piece))

    def _take(self, at: int) -> Piece:
        n, _, piece = self.pool.pop(at)
        self.tokens -= n
        return piece

    def pack(self, last: bool = False) -> None:
        """Fill windows while the pool can; with ``last`` empty it."""
        while self.pool and (last or self.tokens >= self.tiers[-1]):
            opener = self._take(len(self.pool) - 1)
            size = next(t for t in self.tiers if t >= len(opener.ids))
            pieces, gap = [opener], size - len(opener.ids)
            while gap and self.pool:
                at = bisect_right(self.pool, (gap, float("inf")))
                piece = self._take(at - 1 if at else 0)
                if len(piece.ids) > gap:
                    piece, rest = piece.split(gap)
                    self._hold(rest)
                pieces.append(piece)
                gap -= len(piece.ids)
            self._close(size, pieces, gap)

    def _close(self, size: int, pieces: list[Piece], gap: int) -> None:
        if not gap:
            self.windows.append((size, pieces))
            return
        queue, left = pieces[::-1], size - gap              # the task's last window: decreasing powers of two
        while left:
            part = 1 << (left.bit_length() - 1)
            taken, need = [], part
            while need:
                piece = queue.pop()
                if len(piece.ids) > need:
                    piece, rest = piece.split(need)
                    queue.append(rest)
                taken.append(piece)
                need -= len(piece.ids)
            self.windows.append((part, taken))
            left -= part

    def rows(self) -> list[tuple]:
        """Rows of the finished windows, dealt to step groups."""
        total = sum(size for size, _ in self.windows)
        groups = [(0, self.next_group + g) for g in range(max(1, round(total / STEP_TOKENS)))]
        self.next_group += len(groups)
        out = []
        for size, pieces in sorted(self.windows, key=lambda w: -w[0]):
            used, group = heapq.heappop(groups)
            heapq.heappush(groups, (used + size, group))
            offset = 0
            for p in pieces:
                out.append((p.doc, p.start, len(p.ids), zlib.crc32(p.ids), p.doc_tokens, self.next_sequence, offset, size, group))
                offset += len(p.ids)
            self.next_sequence += 1
        self.windows = []
        return out


def pack(docs: DataFrame, path: str | None = None, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """Per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, context`` (the window's size) and ``step_group``.

    A null or empty text is its end id alone.  Rows that repeat are packed
    each.  A very long text gives whole windows piece by piece.  An empty
    table gives no pieces; other columns are left aside.  A task's ids start
    at its partition number, so a task that runs again gives the same rows.
    """
    path = path or vocabulary_path()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(path)
        packer = Packer(TaskContext.get().partitionId() << 40, tiers)
        field = None

        def batch() -> pa.RecordBatch:
            rows = packer.rows()
            return arrow_batch(pa.schema([field, *PIECES]), [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * (len(PIECES) + 1))

        for b in batches:
            field = b.schema.field("doc_id")
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            for at in range(0, len(texts), 64):
                for doc, text in zip(ids[at:at + 64], texts[at:at + 64], strict=True):
                    packer.add(doc, np.array([*encode(coder, text.decode()), END], dtype="<u4"))
                if packer.tokens >= POOL_TOKENS:
                    packer.pack()
                    yield batch()
        if field is not None:
            packer.pack(last=True)
            yield batch()

    return doc_bytes(docs).mapInArrow(run, f"doc_id {kind}, {DDL}")
