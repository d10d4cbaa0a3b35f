"""Masked pseudo-likelihood: a bidirectional window network scores documents.

Every word is predicted from the two words on either side; a document's score
is the sum of the log-probabilities of its words, each given its neighbours.

Words fall into classes: the ``TOP`` most frequent ones of the corpus have one
each, all others share ``BUCKETS`` by their ending.  The network (an embedding
per place and class, one tanh layer, a softmax over classes) gives P(class |
neighbours); P(word | class) is the word's share of its class in the counts of
all documents, whatever the word's rank.

Counts are summed by Spark over every document and stay a table.  Only the
``VOCABULARY`` most frequent words also go to the tasks; a document's other words
meet their counts in a join.  Training is data-parallel:
in each round every task runs Adagrad over all its documents from the same
weights, and the tasks' weights are averaged by their number of words.  The
network's size is fixed by the parameters; the counts grow with the corpus.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import LOWER, arrow_batch, doc_bytes, stage_table

TOP = 48
BUCKETS = 16
CLASSES = TOP + BUCKETS
PAD = CLASSES
#: Most words that are sent to the tasks; the others' counts are joined.
VOCABULARY = 20_000
#: Steps of a word's count per doubling, at which the words sent may end.
STEPS = 16
PLACES = (-2, -1, 1, 2)
HIDDEN = 16
ROUNDS = 2
RATE = 0.1
BATCH = 4096
#: Distinct words that a task counts before it hands its counts on.
COUNTED = 300_000
#: Words that are scored, or whose gradient is taken, at once.
PART = 1 << 11


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


def word_counts(rows: DataFrame) -> DataFrame:
    """``(word, n)`` over all documents; a frequent word leaves each task as
    one row, so no task receives more than a row per word and task."""
    out = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for text in b.column("text").to_pylist():
                counts.update(words_of(text))
                if len(counts) > COUNTED:
                    yield arrow_batch(out, [list(counts.keys()), list(counts.values())])
                    counts.clear()
        yield arrow_batch(out, [list(counts.keys()), list(counts.values())])

    return rows.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def bucket(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % BUCKETS


@dataclass
class Lexicon:
    """Class and log P(word | class) by word number; the last ``BUCKETS``
    numbers stand for a word not sent, as if counted once: the log of its
    count is to be added."""

    numbers: dict[bytes, int]
    classes: np.ndarray
    within: np.ndarray
    prior: np.ndarray

    def encode(self, words: list[bytes]) -> np.ndarray:
        n, get = len(self.numbers), self.numbers.get
        return np.fromiter((i if (i := get(w)) is not None else n + bucket(w) for w in words), np.int32, len(words))


def lexicon(counts: DataFrame) -> Lexicon:
    """From the counts of all words: the frequent ones by name, the rest as
    sums per bucket."""
    # Sent is what lies above a count, found on some hundreds of steps of the
    # count's logarithm: no task and no driver sorts words.  A word not sent has
    # at most about one in VOCABULARY of all tokens, so no key of the join is hot.
    step = F.floor(F.log2("n") * STEPS)
    kept, above = 0, None
    for r in sorted(counts.groupBy(step.alias("s")).count().collect(), reverse=True):
        kept += r["count"]
        if kept > VOCABULARY:
            break
        above = r.s
    named = counts.filter(step >= above) if above is not None else counts.limit(0)
    frequent = [(bytes(r.word), r.n) for r in named.collect()]
    if len(frequent) < TOP:                              # too many words share a step, or there are few
        frequent = [(bytes(r.word), r.n) for r in counts.orderBy(F.desc("n"), "word").limit(TOP).collect()]
    frequent.sort(key=lambda x: (-x[1], x[0]))
    place = F.pmod(F.crc32(F.expr("substring(word, -3)")), F.lit(BUCKETS)).cast("int")
    sums = counts.groupBy(place.alias("b")).agg(F.sum("n").alias("n")).collect()
    mass = np.zeros(BUCKETS)
    for r in sums:
        mass[r.b] = r.n
    for w, n in frequent[:TOP]:
        mass[bucket(w)] -= n
    total = mass + 1.0                                   # one for words never counted
    classes = np.zeros(len(frequent) + BUCKETS, np.int16)
    within = np.zeros(len(frequent) + BUCKETS, np.float32)
    for i, (w, n) in enumerate(frequent):
        b = bucket(w)
        classes[i], within[i] = (i, 0.0) if i < TOP else (TOP + b, np.log(n / total[b]))
    classes[len(frequent):] = TOP + np.arange(BUCKETS)
    within[len(frequent):] = -np.log(total)
    prior = np.ones(CLASSES)
    prior[:min(TOP, len(frequent))] += [n for _, n in frequent[:TOP]]
    prior[TOP:] += total
    return Lexicon({w: i for i, (w, _) in enumerate(frequent)}, classes, within, np.log(prior / prior.sum()).astype(np.float32))


SHAPES = ((len(PLACES), CLASSES + 1, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,))


def initial(prior: np.ndarray, seed: int = 7) -> list[np.ndarray]:
    r = np.random.default_rng(seed)
    return [(0.1 * r.standard_normal(SHAPES[0])).astype(np.float32), np.zeros(SHAPES[1], np.float32),
            (0.1 * r.standard_normal(SHAPES[2])).astype(np.float32), prior.copy()]


def unpack(flat: np.ndarray) -> list[np.ndarray]:
    out, at = [], 0
    for shape in SHAPES:
        n = int(np.prod(shape))
        out.append(flat[at:at + n].reshape(shape).astype(np.float32))
        at += n
    return out


def line_up(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All classes in one row with two pads around each document, and where
    the words are."""
    parts, places, at = [np.full(2, PAD, np.int16)], [], 2
    for d in docs:
        parts += [d, np.full(2, PAD, np.int16)]
        places.append(np.arange(at, at + len(d)))
        at += len(d) + 2
    return np.concatenate(parts), np.concatenate(places) if places else np.zeros(0, np.int64)


def forward(params: list[np.ndarray], row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """At these places: hidden layer, the classes' logits less the largest,
    their exponentials and the sums of those."""
    tables, bias, out, offset = params
    h = tables[0][row[at + PLACES[0]]]
    for k in range(1, len(PLACES)):
        h += tables[k][row[at + PLACES[k]]]
    h += bias
    np.tanh(h, out=h)
    z = h @ out + offset
    z -= z.max(axis=1, keepdims=True)
    e = np.exp(z)
    return h, z, e, e.sum(axis=1)


def learn(params: list[np.ndarray], seen: list[np.ndarray], row: np.ndarray, at: np.ndarray) -> None:
    """One Adagrad step on the words at these places.  The gradient is summed
    over parts of ``PART`` words, whose tables stay in the cache."""
    grads = [np.zeros(shape, np.float32) for shape in SHAPES]
    for i in range(0, len(at), PART):
        part = at[i:i + PART]
        h, _, d, total = forward(params, row, part)
        d *= (1.0 / (total * len(at))).astype(np.float32)[:, None]
        d[np.arange(len(part)), row[part]] -= 1.0 / len(at)
        dh = d @ params[2].T
        dh *= 1.0 - h * h
        for k, place in enumerate(PLACES):
            # the sum of dh by neighbour's class, in runs of equal classes
            who = row[part + place]
            order = np.argsort(who, kind="stable")
            who = who[order]
            runs = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1])))
            grads[0][k][who[runs]] += np.add.reduceat(dh[order], runs, axis=0)
        for g, more in zip(grads[1:], (dh.sum(axis=0), h.T @ d, d.sum(axis=0)), strict=True):
            g += more
    for p, g, s in zip(params, grads, seen, strict=True):
        s += g * g
        p -= RATE * g / (np.sqrt(s) + 1e-6)


def classes_of(column: pa.Array) -> list[np.ndarray]:
    """Each document's classes, a byte a word."""
    return [np.frombuffer(c, np.int8).astype(np.int16) for c in column.to_pylist()]


def coded(rows: DataFrame, lex: Lexicon) -> DataFrame:
    """``(row, doc_id, classes, within, rest)``, written: a document's classes,
    the sum of log P(word | class) with words not sent as if counted once, and
    those words with their times.  Texts are split and encoded here alone;
    training and scoring read this table.  ``row`` is the row's own number: ids
    may be null or repeat."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    words = rows.sparkSession.sparkContext.broadcast(lex)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.value
        n = len(known.numbers)
        for b in batches:
            out = pa.schema([b.schema.field("doc_id"), ("classes", pa.binary()), ("within", pa.float64()), ("rest", pa.map_(pa.binary(), pa.int64()))])
            ids, texts = b.column("doc_id"), b.column("text").to_pylist()
            for i in range(0, len(texts), 256):
                classes, within, rest = [], [], []
                for t in texts[i:i + 256]:
                    split = words_of(t)
                    code = known.encode(split)
                    classes.append(known.classes[code].astype(np.int8).tobytes())
                    within.append(float(known.within[code].sum(dtype=np.float64)))
                    rest.append(list(Counter(split[j] for j in np.flatnonzero(code >= n).tolist()).items()))
                yield arrow_batch(out, [ids[i:i + 256], classes, within, rest])

    found = rows.mapInArrow(run, f"doc_id {kind}, classes binary, within double, rest map<binary,bigint>")
    return stage_table(found.withColumn("row", F.monotonically_increasing_id()), "lm-coded")


def train(rows: DataFrame, lex: Lexicon) -> list[np.ndarray]:
    """The weights after ``ROUNDS`` passes over the coded documents."""
    sc = rows.sparkSession.sparkContext
    params = initial(lex.prior)
    out = pa.schema([("weights", pa.list_(pa.float64())), ("n", pa.int64())])
    for _ in range(ROUNDS):
        sent = sc.broadcast(params)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = [p.copy() for p in sent.value]
            seen, n = [np.zeros_like(p) for p in own], 0
            for b in batches:
                for i in range(0, b.num_rows, 256):
                    row, at = line_up(classes_of(b.column("classes").slice(i, 256)))
                    for j in range(0, len(at), BATCH):
                        learn(own, seen, row, at[j:j + BATCH])
                    n += len(at)
            if n:
                yield arrow_batch(out, [[np.concatenate([p.ravel() for p in own]).astype(np.float64).tolist()], [n]])

        parts = rows.select("classes").mapInArrow(run, "weights array<double>, n long")
        mean = (parts.select("n", F.posexplode("weights").alias("i", "w")).groupBy("i")
                .agg((F.sum(F.col("w") * F.col("n")) / F.sum("n")).alias("w")))
        flat = sorted((r.i, r.w) for r in mean.collect())  # one number per weight, whatever the corpus
        if flat:
            params = unpack(np.array([w for _, w in flat]))
    return params


def class_scores(classes: list[np.ndarray], params: list[np.ndarray]) -> list[float]:
    """The summed log P(class | neighbours) of each document."""
    row, at = line_up(classes)
    each = np.empty(len(at) + 1)
    each[0] = 0.0
    for i in range(0, len(at), PART):
        part = at[i:i + PART]
        _, z, _, sums = forward(params, row, part)
        each[i + 1:i + 1 + len(part)] = z[np.arange(len(part)), row[part]] - np.log(sums)
    total, ends = np.cumsum(each), np.cumsum([0, *map(len, classes)])
    return (total[ends[1:]] - total[ends[:-1]]).tolist()


def score(texts: list[bytes], lex: Lexicon, params: list[np.ndarray]) -> list[tuple[int, float]]:
    """Words and summed log-probability of each text, words not sent as if
    counted once."""
    codes = [lex.encode(words_of(t)) for t in texts]
    found = class_scores([lex.classes[c] for c in codes], params)
    return [(len(c), x + float(lex.within[c].sum(dtype=np.float64))) for c, x in zip(codes, found, strict=True)]


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, n_words, log_prob`` (the sum), ``mean_log_prob`` and
    ``perplexity`` (null without words).

    Null and empty texts have no words and log-probability 0.  Rows that
    repeat count each.  Long texts are scored in blocks, words at a block's
    edge seeing their neighbours beyond it.  An empty table gives an empty
    result; other columns are left aside.
    """
    rows = doc_bytes(docs)
    counts = stage_table(word_counts(rows), "lm-counts")
    lex = lexicon(counts)
    table = coded(rows, lex)
    sent = docs.sparkSession.sparkContext.broadcast(train(table, lex))
    out = pa.schema([("row", pa.int64()), ("n_words", pa.int64()), ("log_prob", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                classes = classes_of(part.column("classes"))
                found = np.array(class_scores(classes, sent.value)) + part.column("within").to_numpy()
                out_ = pa.schema([part.schema.field("doc_id"), *out])
                yield arrow_batch(out_, [part.column("doc_id"), part.column("row"), [len(c) for c in classes], found])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = table.select("doc_id", "row", "classes", "within").mapInArrow(run, f"doc_id {kind}, row long, n_words long, log_prob double")
    # log 1 = 0: a word counted once in all has nothing to add.
    more = (table.select("row", F.explode("rest").alias("word", "times")).join(counts.filter("n > 1"), "word")
            .groupBy("row").agg(F.sum(F.col("times") * F.log("n")).alias("more")))
    scored = scored.join(more, "row", "left").select(
        "doc_id", "n_words", (F.col("log_prob") + F.coalesce("more", F.lit(0.0))).alias("log_prob"))
    mean = F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words"))
    return scored.withColumn("mean_log_prob", mean).withColumn("perplexity", F.exp(-F.col("mean_log_prob")))
