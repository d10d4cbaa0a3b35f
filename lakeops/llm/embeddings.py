"""Near-duplicate vectors by a subspace pigeonhole join.

Cosine c between two vectors is squared distance 2 - 2c between their unit
vectors.  These are rotated by a fixed random orthogonal matrix, which spreads
the distance of a pair evenly, and split into blocks of ``BLOCK`` dimensions.
A pair within squared distance T has some block with a share of at most
T * (block's dimensions) / (all dimensions): if every block had more, their sum
would be more than T.  So one range join per block, each under its own budget,
finds every pair.

Range join of a block: a grid over its first ``GRID`` coordinates, of cells
twice the radius wide.  A vector stands in its home cell and visits the cells
behind it (in the order of their coordinates) that its radius reaches; a pair
then meets in exactly one cell, as both at home or as visitor and host.

The distinct vectors are written once, in pages of up to ``CHUNK`` of one
length, and every two pages meet in a Cartesian product of the written table
with itself, whose tasks read the pages again: no vector is shuffled to its
cells or written twice, whatever the number of blocks and the size of a cell.
The range joins of two pages run in numpy, ``STEP`` rows of a cell at a time,
so a task's memory is bounded.

A pair that passes several budgets is taken in the first such block alone,
which each task can tell from the two vectors.  So nothing has to be made
distinct: a task verifies the cosine, and sends per vector of two pages the
number of its links and one link of a spanning forest -- a row per vector, not
per pair.  Equal vectors are one vector with a count from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import arrow_batch, stage_table
from lakeops.llm.components import connected_components
from lakeops.session import scratch_path

COSINE = 0.95
#: Dimensions of a block, and of those the ones that the cells divide.
BLOCK, GRID = 8, 3
#: Seed of the rotation.
SEED = 12
#: Rows of a page at most, and rows of a cell that are compared at once.
CHUNK, STEP = 4096, 256
#: Bytes of a page's vectors at most, and of the unit vectors that a task keeps.
PAGE_BYTES, KEPT_BYTES = 8 << 20, 96 << 20
#: Pages of a file: its reader holds them all.
PAGES = 16
#: Numbers kept for the rows of a page.
ROWS = 1 << 16
#: Budgets above this are tried in single precision first; over them, so much
#: is let through to be looked at in double precision.
ROUGH, ROUGHLY = 1e-4, 1e-5
#: Slack of budgets and cells over the last digits of a double.
SLACK = 1e-9


def unit(values: np.ndarray) -> np.ndarray:
    """Rows over their length in double precision, scaled first so that no
    square over- or underflows."""
    values = values.astype(np.float64)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt(np.einsum("ij,ij->i", values, values))[:, None]


@lru_cache(maxsize=4)
def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix that depends on the two numbers alone."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dims]).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def rotate(units: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """``units @ matrix``, each row summed on its own: its digits must not
    depend on which rows stand beside it in a task."""
    out = np.empty_like(units)
    rows = max(1, (1 << 22) // matrix.size)
    for at in range(0, len(units), rows):
        out[at:at + rows] = (units[at:at + rows, None, :] * matrix.T[None]).sum(axis=2)
    return out


def blocks(dims: int) -> list[slice]:
    return [slice(a, min(a + BLOCK, dims)) for a in range(0, dims, BLOCK)]


def budgets(dims: int, cosine: float) -> np.ndarray:
    """Squared distance of each block in proportion to its dimensions."""
    shares = np.array([b.stop - b.start for b in blocks(dims)]) / dims
    return (2 - 2 * cosine) * shares * (1 + SLACK) + SLACK ** 2


def cells(rotated: np.ndarray, block: slice, budget: float) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """``(rows, cells, home)``: the home cell of every row, then the later
    cells that its radius in the grid's coordinates reaches."""
    at = rotated[:, block][:, :GRID]
    radius = np.sqrt(budget) * (1 + SLACK)
    width = 2 * radius
    home = np.floor(at / width).astype(np.int64)
    yield np.arange(len(at)), home, True
    low = at - home * width                     # distance to the neighbour below, on each axis
    for step in product((-1, 0, 1), repeat=at.shape[1]):
        if step <= (0,) * at.shape[1]:
            continue
        gap = np.zeros(len(at))
        for axis, move in enumerate(step):
            if move:
                gap += np.maximum(0, low[:, axis] if move < 0 else width - low[:, axis]) ** 2
        near = np.flatnonzero(gap <= (radius * (1 + SLACK)) ** 2)
        if len(near):
            yield near, home[near] + np.array(step), False


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length, from a list column without nulls."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 0))


def pages(classes: DataFrame) -> DataFrame:
    """``(page, dims, copies, smallest, key_a, key_b, vectors)``: the classes
    in pages of up to ``CHUNK`` of one length; lists, and the vectors' bytes."""
    single, most = dict(classes.dtypes)["vector"] == "array<float>", min(CHUNK, ROWS)
    kind = np.dtype(np.float32 if single else np.float64)
    lists = ["copies", "smallest", "key_a", "key_b"]
    out = pa.schema([("page", pa.int64()), ("dims", pa.int32()), *[(c, pa.list_(pa.int64())) for c in lists], ("vectors", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made, waiting = TaskContext.get().partitionId() << 24, 0, {}

        def full(dims: int) -> int:
            return max(1, min(most, PAGE_BYTES // (dims * kind.itemsize)))

        def take(dims: int, n: int) -> pa.RecordBatch:
            nonlocal made
            rows = pa.Table.from_batches(waiting.pop(dims)).combine_chunks()
            if rows.num_rows > n:
                waiting[dims] = rows.slice(n).to_batches()
            rows, made = rows.slice(0, n), made + 1
            values = _matrix(rows.column("vector").combine_chunks())
            return arrow_batch(out, [[first + made], [dims], *[[rows.column(c).to_pylist()] for c in lists], [values.astype(kind).tobytes()]])

        for b in batches:
            lengths = b.column("vector").value_lengths().to_numpy()
            for dims in np.unique(lengths).tolist():
                waiting.setdefault(dims, []).append(b.take(pa.array(np.flatnonzero(lengths == dims))))
                while sum(x.num_rows for x in waiting.get(dims, [])) >= full(dims):
                    yield take(dims, full(dims))
        for dims in list(waiting):
            yield take(dims, full(dims))

    return classes.select("vector", *lists).mapInArrow(run, "page long, dims int, copies array<long>, smallest array<long>, key_a array<long>, key_b array<long>, vectors binary")


def forest(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Smallest label reachable over links a-b, given the labels so far, each
    of which is its own label.  Only these are lowered: a row keeps to those
    that it was joined with before."""
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        label = label.copy()
        for side in (x, y):
            np.minimum.at(label, side, np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def _first_is(k: int, x: np.ndarray, y: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Whether block ``k`` is the first within its budget, for each row of two
    rotated sets."""
    starts = [b.start for b in blocks(x.shape[1])]
    within = np.add.reduceat((x - y) ** 2, starts, axis=1) <= limits
    return within[:, k] & (within.argmax(axis=1) == k)


def by_cell(rows: np.ndarray, cell: np.ndarray) -> dict[bytes, np.ndarray]:
    """The rows of every cell."""
    order = np.lexsort(cell.T[::-1])
    rows, cell = rows[order], cell[order]
    ends = np.flatnonzero(np.any(cell[1:] != cell[:-1], axis=1)) + 1
    starts = [0, *ends.tolist()] if len(rows) else []
    return {cell[at].tobytes(): rows[at:to] for at, to in zip(starts, [*ends.tolist(), len(rows)], strict=False)}


@dataclass
class Page:
    """The vectors of a page, rotated, and their places in every block."""
    cid: np.ndarray
    copies: np.ndarray
    units: np.ndarray
    turned: np.ndarray
    left: list[np.ndarray]                        # rows of a block and of the other page's ``right``
    right: list[np.ndarray]                       # multiply to squared distances
    homes: list[dict[bytes, np.ndarray]]          # rows by home cell
    visits: list[dict[bytes, np.ndarray]]         # rows by visited cell
    places: list[dict[bytes, np.ndarray]]         # both


def read_page(number: int, values: np.ndarray, copies: np.ndarray, cosine: float) -> Page:
    units = unit(values)
    dims = units.shape[1]
    turned = units @ rotation(dims)
    page = Page(number * ROWS + np.arange(len(units)), copies, units, turned, [], [], [], [], [])
    for block, budget in zip(blocks(dims), budgets(dims, cosine), strict=True):
        sub = turned[:, block]
        size, one = np.einsum("ij,ij->i", sub, sub)[:, None], np.ones((len(sub), 1))
        kind = np.float32 if budget > ROUGH else np.float64
        page.left.append(np.hstack([sub, size, one]).astype(kind))
        page.right.append(np.hstack([-2 * sub, one, size]).astype(kind))
        (rows, home, _), *visited = cells(turned, block, budget)
        page.homes.append(by_cell(rows, home))
        behind = [np.concatenate([v[i] for v in visited] or [x[:0]]) for i, x in enumerate((rows, home))]
        page.visits.append(by_cell(*behind))
        page.places.append(by_cell(np.concatenate([rows, behind[0]]), np.concatenate([home, behind[1]])))
    return page


def meetings(a: Page, b: Page, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of two pages (or of one) that stand in one cell of block ``k`` as
    both at home or as visitor and host."""
    for cell, hosts in b.homes[k].items():
        for guests in ([hosts, a.visits[k].get(cell)] if a is b else [a.places[k].get(cell)]):
            if guests is not None:
                yield guests, hosts
    if a is not b:
        for cell, guests in b.visits[k].items():
            if cell in a.homes[k]:
                yield a.homes[k][cell], guests


def page_links(a: Page, b: Page, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(cid, links, other)`` of the rows of two pages, or of one with itself:
    ``links`` counted with copies, ``other`` a class of the same component."""
    dims = a.units.shape[1]
    limits, split, edge = budgets(dims, cosine), blocks(dims), 1e-12 + 4e-16 * dims
    shift = 0 if a is b else len(a.cid)
    cid, copies = (a.cid, a.copies) if a is b else (np.concatenate([a.cid, b.cid]), np.concatenate([a.copies, b.copies]))
    links, label = np.zeros(len(cid)), np.arange(len(cid))
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def apart(k: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        u, v = a.turned[x, split[k]], b.turned[y, split[k]]
        return np.einsum("ij,ij->i", u, u)[:, None] + np.einsum("ij,ij->i", v, v) - 2 * (u @ v.T)

    def verified(k: int, x: np.ndarray, y: np.ndarray) -> None:
        for at in range(0, len(x), 1 << 16):
            i, j = x[at:at + (1 << 16)], y[at:at + (1 << 16)]
            here = _first_is(k, a.turned[i], b.turned[j], limits)
            i, j = i[here], j[here]
            linked = np.einsum("ij,ij->i", a.units[i], b.units[j]) >= cosine
            if linked.any():
                found.append((i[linked], j[linked] + shift))

    def crowded(k: int, x: np.ndarray, y: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Takes the links of a dense ``near`` in whole matrices but for those
        within the last digits of a limit, which it returns."""
        nonlocal links, label
        here = apart(k, x, y)
        near, unsure = near & (here <= limits[k] + edge), np.abs(here - limits[k]) <= edge
        for e in range(k):
            there = apart(e, x, y)
            near = near & (there >= limits[e] - edge)
            unsure |= there <= limits[e] + edge
        if np.count_nonzero(near) <= near.size >> 3:
            return near
        like = a.units[x] @ b.units[y].T
        unsure |= np.abs(like - cosine) <= edge
        sure = near & ~unsure & (like >= cosine)
        mine, theirs = x, y + shift
        links[mine] += sure @ copies[theirs].astype(np.float64)
        links[theirs] += copies[mine].astype(np.float64) @ sure
        while True:                               # one link a row between parts that are not yet joined
            new = sure & (label[mine][:, None] != label[theirs][None, :])
            rows = np.flatnonzero(new.any(axis=1))
            if not len(rows):
                return near & unsure
            label = forest(mine[rows], theirs[new[rows].argmax(axis=1)], label)

    for k, limit in enumerate(limits):
        most, some = limit + (ROUGHLY if limit > ROUGH else edge), []
        for guests, hosts in meetings(a, b, k):
            right = b.right[k][hosts].T
            for at in range(0, len(guests), STEP):
                x = guests[at:at + STEP]
                near = a.left[k][x] @ right <= most
                if guests is hosts:               # among themselves, rows meet those after them
                    near &= x[:, None] < hosts[None, :]
                if np.count_nonzero(near) > max(1 << 10, near.size >> 3):
                    near = crowded(k, x, hosts, near)
                i, j = np.divmod(np.flatnonzero(near), len(hosts))
                some.append((x[i], hosts[j]))
        verified(k, *[np.concatenate(side) for side in zip(*some, strict=True)] if some else 2 * [np.arange(0)])
    if found:
        x, y = [np.concatenate(side) for side in zip(*found, strict=True)]
        links += np.bincount(x, copies[y], len(cid)) + np.bincount(y, copies[x], len(cid))
        label = forest(x, y, label)
    some = np.flatnonzero(links)
    return cid[some], links[some].astype(np.int64), cid[label[some]]


def vector_classes(vectors: DataFrame) -> DataFrame:
    """The :func:`pages` of the distinct vectors that can link -- not null, not
    empty, without null or non-finite components, not all zero -- with their
    number of rows, smallest id and key."""
    rows = ids_and_vectors(vectors).filter(usable(F.col("vector")))
    classes = rows.groupBy("vector").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("smallest"))
    classes = classes.select("*", *keys(F.col("vector"))).coalesce(vectors.sparkSession.sparkContext.defaultParallelism)
    path = scratch_path(vectors.sparkSession, "embed-pages")
    staged = pages(classes)
    staged.write.option("maxRecordsPerFile", PAGES).parquet(path)
    return vectors.sparkSession.read.schema(staged.schema).parquet(path)


def keys(vector) -> list:
    """128 bits of hashes that stand for a vector in joins."""
    return [F.xxhash64(vector).alias("key_a"), F.xxhash64(F.lit(SEED), vector).alias("key_b")]


def ids_and_vectors(vectors: DataFrame) -> DataFrame:
    """``(vec_id, vector)``; single precision stays as it is until it is
    computed with, in double."""
    single = dict(vectors.dtypes)["embedding"] == "array<float>"
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("vector"))


def usable(vector):
    """Whether a vector has a direction."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def links(paged: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``(cid, links, other)``: parts of each class's number of linked vectors
    in other classes, and links whose components are those of all links."""
    sides = [paged.select(*[F.col(c).alias(f"{side}_{c}") for c in ("page", "dims", "copies", "vectors")]) for side in "ab"]
    # a Cartesian product, whatever the table's size: both sides are read where
    # they are; the dimensions are no join key, as one of them may have all rows
    even = (F.col("a_page") + F.col("b_page")) % 2 == 0
    once = F.when(even, F.col("a_page") <= F.col("b_page")).otherwise(F.col("a_page") > F.col("b_page"))
    pairs = sides[0].hint("shuffle_replicate_nl").crossJoin(sides[1]).filter(once & (F.col("a_dims") - F.col("b_dims") == 0))
    out = pa.schema([("cid", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, Page] = {}

        def page(b: pa.RecordBatch, i: int, side: str) -> Page:
            number, dims = b.column(f"{side}_page")[i].as_py(), b.column(f"{side}_dims")[i].as_py()
            if number not in kept:
                copies = b.column(f"{side}_copies")[i].values.to_numpy(zero_copy_only=False)
                data = b.column(f"{side}_vectors")[i].as_buffer()
                kept[number] = read_page(number, np.frombuffer(data, f"f{data.size // dims // len(copies)}").reshape(len(copies), dims), copies, cosine)
            kept[number] = found = kept.pop(number)
            while len(kept) > 2 and sum(p.units.nbytes + p.turned.nbytes for p in kept.values()) > KEPT_BYTES:
                kept.pop(next(iter(kept)))
            return found

        for b in batches:
            for i in range(b.num_rows):
                cid, n, other = page_links(page(b, i, "a"), page(b, i, "b"), cosine)
                if len(cid):
                    yield arrow_batch(out, [pa.array(cid), pa.array(n), pa.array(other)])

    return pairs.select(*[f"{side}_{c}" for side in "ab" for c in ("page", "dims", "copies", "vectors")]).mapInArrow(run, "cid long, links long, other long")


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row.

    ``n_links`` counts the other rows at a cosine of at least ``cosine`` (equal
    vectors included), ``component_id`` is the smallest ``vec_id`` reachable
    over links, ``kept`` whether that is the row's own.  Rows with a null,
    empty or all-zero vector or with a null or non-finite component link with
    nothing and are kept; vectors of different lengths do not link; a null
    ``vec_id`` is never the smallest unless the component has no other (then
    its rows are kept).  Repeated rows are rows; other columns are not read;
    an empty table gives an empty result.
    """
    paged = vector_classes(vectors)
    found = stage_table(links(paged, cosine), "embed-links")
    labels = connected_components(found.filter("cid <> other").select(F.col("cid").alias("a"), F.col("other").alias("b")))
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    each = F.posexplode(F.arrays_zip("copies", "smallest", "key_a", "key_b")).alias("_at", "_c")
    classes = paged.select("page", each).select((F.col("page") * ROWS + F.col("_at")).alias("cid"), "_c.*")
    named = stage_table(classes.join(labels.withColumnRenamed("id", "cid"), "cid", "left").join(counts, "cid", "left").select(
        "key_a", "key_b", "smallest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("label", "cid").alias("label")), "embed-named")
    least = named.groupBy("label").agg(F.min("smallest").alias("component_id"))
    named = named.join(least, "label").select("key_a", "key_b", "n_links", "component_id")
    rows = ids_and_vectors(vectors)
    can = usable(F.col("vector"))
    rows = rows.select("vec_id", *[F.when(can, key).alias(name) for name, key in zip(("key_a", "key_b"), keys(F.col("vector")), strict=True)])
    alone = F.col("n_links").isNull()
    rows = rows.join(named, ["key_a", "key_b"], "left").withColumn("component_id", F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")))
    return rows.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def oracle_sql() -> str:
    """The same rows in DuckDB, from all pairs; components by a recursive walk."""
    return f"""
WITH RECURSIVE v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS MATERIALIZED (SELECT rid, vec_id, e FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_max(e) - list_min(e) + abs(list_max(e)) > 0),
near AS MATERIALIZED (SELECT a.rid AS a, b.rid AS b FROM u a JOIN u b ON a.rid <> b.rid AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= {COSINE}),
walk AS (SELECT rid AS a, rid AS b FROM v UNION SELECT w.a, n.b FROM walk w JOIN near n ON n.a = w.b),
reach AS (SELECT w.a AS rid, min(v.vec_id) AS component_id FROM walk w JOIN v ON v.rid = w.b GROUP BY w.a),
counts AS (SELECT a AS rid, count(*) AS n FROM near GROUP BY a)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, r.component_id, v.vec_id IS NOT DISTINCT FROM r.component_id AS kept
FROM v JOIN reach r USING (rid) LEFT JOIN counts c USING (rid)"""
