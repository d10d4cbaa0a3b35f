"""Personal data: fixed patterns, and a linear-chain conditional random field.

The patterns give the base spans.  The field adds spans that they miss
(numbers without a plus sign, spelled-out addresses, grouped cards ...): it
labels the words of each line from their shapes and their neighbours', is
trained by gradient ascent on the small labelled table below, and is decoded
by Viterbi over batches of lines.  An added span never overlaps a base span.

One map pass over the documents; the trained weights are a few hundred numbers.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import arrow_batch

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
#: A run of digits is tried from its start only: from later starts the same dot is missing.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SEPARATORS = str.maketrans("", "", " -().+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Sorted (start, rank of the kind, end); leftmost matches of a kind do
    not overlap, and a match that fails its test is dropped."""
    found, done = [], 0
    if "@" in text:
        for m in DOMAIN.finditer(text):
            # The address is the run of local characters before the @, from the last address on.
            start = m.start()
            while start > done and text[start - 1] in LOCAL:
                start -= 1
            if start < m.start():
                found.append((start, 0, m.end()))
                done = m.end()
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m[0].translate(SEPARATORS)
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(m[0].translate(SEPARATORS)) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


#: The labelled table: words, each with a label where it is personal data.
LABELLED = (
    "write to jane.doe@mail.example.com/email today", "mail bob_7@example.org/email or call", "mail: lee@uni.example.edu,/email please",
    "reach me at john/email at/email example/email dot/email com/email soon", "contact ann/email [at]/email example/email [dot]/email org/email now",
    "email (at) noon and bring the book .", "it is at the example of the year .", "meet at ten dot",
    "call +1/phone (212)/phone 555-0147/phone now", "phone: (415)/phone 555-0199/phone before noon", "tel 212-555-0123/phone or later",
    "phone 030/phone 5550/phone 1234/phone and ask", "call 415.555.0142/phone after nine", "fax: 212/phone 555/phone 0188/phone .",
    "tel. 0049/phone 30/phone 555012/phone bitte", "mobile 07700-900123/phone only", "ring +44/phone 20/phone 7946/phone 0958/phone tomorrow",
    "card 4111-1111-1111-1111/card expires", "visa 4111/card 1111/card 1111/card 1111/card was charged", "card number: 4242424242424242/card ok",
    "amex 3782/card 822463/card 10005/card declined", "order number 2669109448945250 shipped", "id 4736962573099581 was found", "invoice 1234 of 2021",
    "host 192.168.10.4/ip is down", "ip: 10.0.0.254/ip refused", "from 172.16.0.3:8080/ip to the server", "address 2001:db8::ff00:42:8329/ip replied",
    "version 1.2.3 was released on 2021-03-04 .", "in 1998 there were 1,250 people in 12 towns .", "see section 4.2.1 for 3.5 percent of 100",
    "the price is 19.99 or 20.50 at 10:30 today .", "pages 100-120 and 7 of 12 chapters", "license version 2.0 and 3 .", "released under cc by 4.0 .",
    "the and of that this with from have was are", "der die das und ist nicht mit ein", "le la de et que les pour dans", "el la que los por con para una",
    "a word , and another ! and more words ? yes .", "ERWHED.!! EDHEEA!! ONLYND!! LOUD!!", "thoner$$$ to%%% the&&& rend*** blean###", "edge | of | a | table | row",
    "token = abe29cfcdae4f03e1e339fcaa4c5bb6c83baff71 set", "key a1b2c3d4e5f6 and deadbeef00112233 end", "x=10 y=20 z=-3.5e10 end", "he said 5 of 10 , or 50 % .",
    "@home we met # 3 times", "at at at at at at", "dot dot dot", "version version at at", "email me", "call me later", "my phone broke", "the card game", "the ip was new", "12 34 56 78 were drawn", "room 212 on floor 3",
)
#: Words that the field knows by name; of all others it sees the shape.
CUES = tuple("call phone tel tel. fax mobile ring mail email write contact reach card visa amex number id order invoice host ip address version at dot [at] [dot] (at) of the in".split())

SHAPES = bytes(97 if 97 <= c <= 122 or c > 127 else 65 if 65 <= c <= 90 else 57 if 48 <= c <= 57 else c for c in range(256))


def features(shape: bytes, cue: str) -> list[str]:
    """What the field sees of a word, from its shape (letters as a or A,
    digits as 9) and its name if it is a cue.  Counts are of the whole word; the
    names ``pattern`` (repeats left out) and ``exact`` hold its first 24 signs."""
    s = shape.decode("latin-1")
    digits = s.count("9")
    out = ["bias", "digits=%d" % min(digits, 20), "pattern=" + re.sub(r"(.)\1+", r"\1", s)[:24], "all=%s" % (digits == len(s)),
           "dots=%d" % min(s.count("."), 4), "@=%d" % min(s.count("@"), 2), "colons=%d" % min(s.count(":"), 3), "dashes=%d" % min(s.count("-"), 4)]
    if digits:
        out.append("exact=" + s[:24])
    if not digits and s.strip("aA.,;!?") == "":
        out.append("word")
    return [*out, "cue=" + cue] if cue else out


def describe(word: bytes) -> tuple[bytes, str]:
    name = word.lower().rstrip(b":,").decode("utf-8", "replace")
    return word.translate(SHAPES), name if name in CUE_SET else ""


CUE_SET = frozenset(CUES)


class Field:
    """Weights: of a word's own features, of those before and after, of label
    pairs and of first labels.  ``index`` numbers the features."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}
        k = len(LABELS)
        self.pair, self.first = np.zeros((k, k)), np.zeros(k)
        self.weights = np.zeros((3, 0, k))

    def ids(self, shape: bytes, cue: str, grow: bool = False) -> list[int]:
        names = features(shape, cue)
        if grow:
            return [self.index.setdefault(n, len(self.index)) for n in names]
        return [self.index[n] for n in names if n in self.index]


def _examples() -> list[tuple[list[bytes], list[int]]]:
    out = []
    for line in LABELLED:
        words, labels = [], []
        for item in line.split():
            word, slash, kind = item.rpartition("/")
            known = bool(slash) and kind in KINDS
            words.append((word if known else item).encode())
            labels.append(LABELS.index(kind) if known else 0)
        out.append((words, labels))
    return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(steps: int = 80, rate: float = 0.25, penalty: float = 0.02) -> Field:
    """Maximum likelihood by Adagrad: forward-backward gives the expected
    counts of each line of the labelled table."""
    field, k = Field(), len(LABELS)
    lines = [([field.ids(*describe(w), grow=True) for w in words], np.array(labels)) for words, labels in _examples()]
    field.weights = np.zeros((3, len(field.index), k))
    params = [field.weights, field.pair, field.first]
    seen = [np.full_like(p, 1e-8) for p in params]
    for _ in range(steps):
        grads = [-penalty * p for p in params]
        for ids, labels in lines:
            n = len(ids)
            score = np.zeros((n, k))
            for t in range(n):
                for place, u in ((0, t), (1, t - 1), (2, t + 1)):
                    if 0 <= u < n:
                        score[t] += field.weights[place, ids[u]].sum(axis=0)
            ahead, back = np.zeros((n, k)), np.zeros((n, k))
            ahead[0] = field.first + score[0]
            for t in range(1, n):
                ahead[t] = score[t] + _logsum(ahead[t - 1][:, None] + field.pair, 0)
            for t in range(n - 2, -1, -1):
                back[t] = _logsum(field.pair + (score[t + 1] + back[t + 1])[None, :], 1)
            total = _logsum(ahead[-1], 0)
            miss = np.eye(k)[labels] - np.exp(ahead + back - total)
            grads[2] += miss[0]
            for t in range(n):
                for place, u in ((0, t), (1, t - 1), (2, t + 1)):
                    if 0 <= u < n:
                        grads[0][place, ids[u]] += miss[t]
                if t:
                    grads[1][labels[t - 1], labels[t]] += 1
                    grads[1] -= np.exp(ahead[t - 1][:, None] + field.pair + (score[t] + back[t])[None, :] - total)
        for p, g, s in zip(params, grads, seen, strict=True):
            s += g * g
            p += rate * g / np.sqrt(s)
    return field


class Scores(dict):
    """Shape, or (shape, cue), -> row of ``table``, made when first asked."""

    def __init__(self, field: Field):
        super().__init__()
        self.field, self.table, self.held = field, np.zeros((64, 3, len(LABELS))), 0

    def __missing__(self, key) -> int:
        n = len(self)
        if n == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        shape, cue = key if isinstance(key, tuple) else (key, "")
        self.table[n] = self.field.weights[:, self.field.ids(shape, cue)].sum(axis=1)
        self[key] = n
        self.held += len(shape)
        return n


class Decoder:
    """Viterbi over batches of lines.  A word's scores depend on its shape and
    cue alone and are looked up by them."""

    def __init__(self, field: Field):
        self.field, self.scores = field, Scores(field)
        self.cues = {c.encode() + end: c for c in CUES for end in (b"", b":", b",")}

    def emissions(self, line: bytes) -> np.ndarray:
        """Scores (words, labels) of a line."""
        if len(self.scores) > 200_000 or self.scores.held > 50_000_000:     # bounds the memory of a long task
            self.scores = Scores(self.field)
        shapes = line.translate(SHAPES).split()
        ids = list(map(self.scores.__getitem__, shapes))
        lowered = line.lower().split()
        if not self.cues.keys().isdisjoint(lowered):
            for i, w in enumerate(lowered):
                if w in self.cues:
                    ids[i] = self.scores[shapes[i], self.cues[w]]
        rows = self.scores.table[ids]
        out = rows[:, 0].copy()
        out[1:] += rows[:-1, 1]
        out[:-1] += rows[1:, 2]
        return out

    def decode(self, lines: list[np.ndarray]) -> list[np.ndarray]:
        """Best labels of each line; lines of like length share their steps."""
        order = sorted(range(len(lines)), key=lambda i: len(lines[i]))
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(lines)
        at = 0
        while at < len(order):
            end = at + 1
            longest = len(lines[order[at]])
            while end < len(order) and len(lines[order[end]]) <= longest + longest // 4 + 2 and (end - at) * len(lines[order[end]]) < 200_000:
                end += 1
            group = order[at:end]
            size, k = len(lines[group[-1]]), len(LABELS)
            lengths = np.array([len(lines[i]) for i in group])
            score = np.zeros((size, len(group), k))
            for j, i in enumerate(group):
                score[:lengths[j], j] = lines[i]
            best = self.field.first + score[0]
            came = np.zeros((size, len(group), k), np.int8)
            for t in range(1, size):
                step = best[:, :, None] + self.field.pair
                came[t] = step.argmax(axis=1)
                now = np.take_along_axis(step, came[t][:, None, :].astype(np.int64), 1)[:, 0] + score[t]
                best = np.where((lengths > t)[:, None], now, best)
            label = best.argmax(axis=1)
            path = np.zeros((size, len(group)), np.int8)
            for t in range(size - 1, -1, -1):
                path[t] = label
                back = came[t][np.arange(len(group)), label]
                label = np.where(lengths > t, back, label) if t else label
            for j, i in enumerate(group):
                out[i] = path[:lengths[j], j]
            at = end
        return out


@lru_cache(maxsize=1)
def trained() -> Field:
    return train()


def added_spans(text: str, labels: list[np.ndarray], lines: list[str], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs of words with one label, less punctuation around them, that meet
    no base span."""
    found, at = [], 0
    taken = [(a, e) for a, _, e in base]
    for line, path in zip(lines, labels, strict=True):
        if path.any():
            places = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", line)]
            i = 0
            while i < len(path):
                j = i + 1
                while j < len(path) and path[j] == path[i]:
                    j += 1
                if path[i]:
                    a, e = places[i][0], places[j - 1][1]
                    while e > a and line[e - 1] in ".,;:!?)]}\"'|#$%&*" and not (line[e - 1] == ")" and "(" in line[a:e]):
                        e -= 1
                    while a < e and line[a] in "[{\"'<|":
                        a += 1
                    if a < e and not any(at + a < y and x < at + e for x, y in taken):
                        found.append((at + a, int(path[i]) - 1, at + e))
                i = j
        at += len(line) + 1
    return found


def find_personal(texts: list[str], decoder: Decoder) -> list[tuple[list, list]]:
    """(base spans, added spans) of each text."""
    base = [base_spans(t) for t in texts]
    lines = [t.split("\n") for t in texts]
    data = [[x.encode("utf-8", "replace") for x in ls] for ls in lines]
    scores, where = [], []
    for n, ls in enumerate(data):
        for m, line in enumerate(ls):
            if line.strip():
                scores.append(decoder.emissions(line))
                where.append((n, m))
    labels = [[np.zeros(0, np.int8)] * len(ls) for ls in lines]
    for (n, m), path in zip(where, decoder.decode(scores), strict=True):
        labels[n][m] = path
    return [(b, added_spans(t, p, ls, b)) for t, b, p, ls in zip(texts, base, labels, lines, strict=True)]


def span_string(spans: list[tuple[int, int, int]], names: tuple[str, ...]) -> str:
    return ",".join(f"{names[k]}:{a}:{e}" for a, k, e in sorted(spans))


NAMES = (*KINDS, *("crf_" + k for k in KINDS))
REPORT = pa.schema([*((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, counts of base spans per kind, a digest of them,
    and all spans as ``kind:start:end`` in code points; those that the field
    adds have kinds ``crf_...``.

    A null text counts as empty.  Texts are read whole, by batches of lines;
    rows that repeat stay repeated; an empty table gives an empty result;
    other columns are left aside.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    field = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(field)
        for b in batches:
            ids, texts = b.column("doc_id"), b.column("text").to_pylist()
            for at in range(0, len(texts), 256):
                rows = []
                for base, added in find_personal(texts[at:at + 256], decoder):
                    plain = span_string(base, NAMES)
                    every = span_string(base + [(a, k + len(KINDS), e) for a, k, e in added], NAMES)
                    rows.append((*(sum(k == n for _, k, _ in base) for n in range(len(KINDS))), hashlib.sha256(plain.encode()).hexdigest(), every))
                yield arrow_batch(pa.schema([b.schema.field("doc_id"), *REPORT]), [ids[at:at + 256], *[list(c) for c in zip(*rows, strict=True)]])

    data = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return data.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")
