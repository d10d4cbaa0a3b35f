"""The embedding join against brute force, and on odd input."""

import numpy as np
import pandas as pd
import pytest

from lakeops.llm import embeddings, queries

SF = "/root/testdata/sf0.001"


def slow(rows, cosine=0.95):
    """(vec_id, n_links, component_id, kept) by all pairs."""
    good = {}
    for i, (_, v) in enumerate(rows):
        if v is not None and len(v) and not any(x is None or not np.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=np.float64)
            good[i] = x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max())
    near = {i: [j for j in good if j != i and len(good[i]) == len(good[j]) and good[i] @ good[j] >= cosine] for i in good}
    out = []
    for i, (vid, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((vid, len(near.get(i, [])), least, vid == least))
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def crowd(seed=3, dims=24):
    """Random directions, a chain of turns, a tight crowd, copies."""
    rng = np.random.default_rng(seed)
    rows = [(i, rng.standard_normal(dims).tolist()) for i in range(150)]
    a, b = np.linalg.qr(rng.standard_normal((dims, 2)))[0].T
    rows += [(1000 + i, (3 * (np.cos(0.3 * i) * a + np.sin(0.3 * i) * b)).tolist()) for i in range(15)]
    c = rng.standard_normal(dims)
    rows += [(2000 + i, (c + 0.15 * rng.standard_normal(dims)).tolist()) for i in range(120)]
    return rows + [(3000 + i, rows[i % 3][1]) for i in range(30)]


@pytest.mark.parametrize("chunk", [4096, 7])
def test_all_links_are_found(spark, monkeypatch, chunk):
    """Chunks of seven rows: every way in which parts of a cell meet."""
    monkeypatch.setattr(embeddings, "CHUNK", chunk)
    rows = crowd()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    want = slow(rows)
    assert got(embeddings.near_vectors(frame)) == want
    assert len({r[2] for r in want}) < len(rows) - 100


def test_budgets_hold_every_pair():
    """Of two vectors at the limit, some block is within its budget, and both
    stand or visit in one cell of it."""
    rng = np.random.default_rng(5)
    for dims in (1, 2, 5, 64, 70):
        x = embeddings.unit(rng.standard_normal((200, dims)))
        y = embeddings.unit(x + rng.standard_normal(x.shape) * 0.32 / np.sqrt(dims))
        near = np.einsum("ij,ij->i", x, y) >= 0.95
        m = embeddings.rotation(dims)
        assert np.allclose(m @ m.T, np.eye(dims))
        x, y = embeddings.rotate(x, m), embeddings.rotate(y, m)
        met = np.zeros(200, bool)
        for block, budget in zip(embeddings.blocks(dims), embeddings.budgets(dims, 0.95), strict=True):
            places = [[set() for _ in range(200)] for _ in range(4)]
            for s, side in enumerate((x, y)):
                for some, cell, home in embeddings.cells(side, block, budget):
                    for i, c in zip(some, cell, strict=True):
                        places[2 * s + (not home)][i].add(tuple(c))
            close = ((x - y)[:, block] ** 2).sum(axis=1) <= budget
            for i in np.flatnonzero(close):
                meetings = len(places[0][i] & places[2][i]) + len(places[1][i] & places[2][i]) + len(places[0][i] & places[3][i])
                assert meetings == 1
            met |= close
        assert near.any() and (met | ~near).all()


def test_vectors_are_written_once(spark, monkeypatch):
    """No vector is shuffled to the cells of its blocks: pages meet where they
    are read, however many rows a cell has."""
    rng = np.random.default_rng(8)
    rows = [(i, rng.standard_normal(48).tolist()) for i in range(900)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    monkeypatch.setattr(embeddings, "CHUNK", 100)
    found = embeddings.links(embeddings.vector_classes(frame))
    plan = found._jdf.queryExecution().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan
    written, stage = [], embeddings.stage_table
    monkeypatch.setattr(embeddings, "stage_table", lambda df, name: written.append(df) or stage(df, name))
    assert embeddings.near_vectors(frame).count() == 900
    assert not any(kind in ("binary", "array<double>") for df in written for _, kind in df.dtypes)


def test_links_join_what_was_joined_before():
    """A row of a part that two links join to others takes the whole part
    along, as links come in several steps."""
    label = np.arange(10)
    for links in ([(7, 9), (8, 9)], [(7, 3), (8, 1)], [(5, 6)], [(6, 9), (2, 5)]):
        label = embeddings.forest(*np.array(links).T, label)
    assert label.tolist() == [0, 1, 1, 1, 4, 1, 1, 1, 1, 1]


@pytest.mark.parametrize("spread", [0.01, 0.17])
def test_crowds_of_two_pages(spread):
    """Dense cells are taken in whole matrices: the same links and parts."""
    rng = np.random.default_rng(11)
    near = rng.standard_normal(24) + spread * rng.standard_normal((500, 24))
    v = rng.permutation(np.concatenate([near, rng.standard_normal((200, 24)), near[:100] * 2]))
    copies = rng.integers(1, 4, len(v))
    sim = np.corrcoef(np.hstack([v, -v])) >= 0.95       # cosines: the mean is taken away
    np.fill_diagonal(sim, False)
    a, b = [embeddings.read_page(k, v[part], copies[part], 0.95) for k, part in enumerate((slice(0, 450), slice(450, 800)))]
    links, label = {}, {}
    for pair in ((a, a), (a, b), (b, b)):
        for cid, n, other in zip(*embeddings.page_links(*pair, 0.95), strict=True):
            links[cid] = links.get(cid, 0) + n
            label.setdefault(cid, set()).add(other)
    ids = np.concatenate([a.cid, b.cid])
    assert [links.get(c, 0) for c in ids] == (sim @ copies).tolist()
    at = {c: i for i, c in enumerate(ids)}
    ends = [(at[c], at[o]) for c, others in label.items() for o in others]
    mine = embeddings.forest(*np.array(ends).T, np.arange(800))
    assert mine.tolist() == embeddings.forest(*np.nonzero(sim), np.arange(800)).tolist()


def test_query_equals_brute_force(spark):
    t = pd.read_parquet(f"{SF}/embeddings.parquet")
    rows = list(zip(t.vec_id.tolist(), t.embedding.tolist(), strict=True))
    assert got(queries.QUERIES["op12_embedding_near_dedup"](spark, SF)) == slow(rows)


def test_copies_with_either_zero(spark):
    """Equal vectors are joined by their keys, 0.0 and -0.0 alike."""
    rows = [(i, [0.0 if i % 2 else -0.0, 1.0, float(i % 3)]) for i in range(12)]
    for kind in ("double", "float"):
        assert got(embeddings.near_vectors(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>"))) == slow(rows)


def test_odd_input(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, -0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]),
            (None, [2.0, 4.0]), (8, [1e200, 2e200]), (9, [1e-300, 2e-300]), (10, [1.0, 2.0, 0.0]), (None, [-5.0, 1.0]), (None, [-5.0, 1.0]),
            (11, [3.0]), (12, [-2.0]), (13, [0.5]), (14, [0.0, 1.0]), (15, [-0.0, 2.0]), (None, None)]
    frame = spark.createDataFrame([(*r, 1, "clash", "clash") for r in rows], "vec_id long, embedding array<double>, label int, cid string, vector string")
    assert got(embeddings.near_vectors(frame)) == slow(rows)
    assert embeddings.near_vectors(frame.limit(0)).count() == 0
    wide = spark.createDataFrame([(1, [float(i % 7) for i in range(3000)]), (2, [float(i % 7) + 0.01 for i in range(3000)])], "vec_id int, embedding array<float>")
    assert got(embeddings.near_vectors(wide)) == [(1, 1, 1, True), (2, 1, 1, False)]
