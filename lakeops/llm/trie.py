"""The prefix trie of conversations, by van Emde Boas recursion.

A node is a distinct sequence of first turns; the conversations that begin
with it are its members, and its name is (depth, smallest member).

Downward: a trie of height 2h is cut at depth h.  Every conversation's first
h turns are one digest, and (name of the trie's root, digest) names the node
at the cut: the smallest conversation with that pair.  The cut leaves the
upper trie and a forest of lower ones, one below each name, all of height h;
every trie of one height is cut by the same job, so log2(height) jobs name
all depths.  The digests of a cut are made by doubling: two neighbouring
halves give the digest of the whole, and a turn enters as the SHA-256 of its
role and text -- texts are never shuffled.

Upward: two tries of height h, an upper and a lower one, become one of height
2h.  The totals of a lower root are added to the upper nodes above it; these
are found through its own name, as that conversation passes through all of
them.  A node at depth d meets the upper halves of its tries only, at most
log2(height) of them.

Everything is joins and sums by key, so a first turn that a third of all
conversations share is a sum with partial sums, or a join that adaptive
execution can split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.llm.common import arrow_batch, stage_table

#: Turns taken from the first conversation of a hundred.
HUNDRED, HEADS = 100, 6


def turn_digest(role: Column, text: Column) -> Column:
    """SHA-256 of a turn; the role's length keeps role and text apart."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))


def ordered_turns(convs: DataFrame) -> DataFrame:
    """``(conv_id, pos, item, chars)``: the turns of every conversation with
    their place in it, from 1.

    Order: ``turn``, null first; turns that tie go by their digest, which is
    their content's, so repeated rows do not matter.  Null role and text count
    as empty; rows without a ``conv_id`` belong to no conversation and are
    left out.  A conversation of any length is spread over many tasks: places
    are counted within range partitions, whose offsets are summed.
    """
    rows = stage_table(convs.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("at"), turn_digest(F.col("role"), F.col("text")).alias("item"),
        F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("chars")), "trie-turns")
    order = [F.col("at").asc_nulls_first(), F.col("item")]
    dealt = stage_table(rows.repartitionByRange("conv_id", *order).withColumn("pid", F.spark_partition_id()), "trie-ranges")
    before = Window.partitionBy("conv_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("pid", "conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        "pid", "conv_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("pid", "conv_id").orderBy(*order))
    return dealt.withColumn("place", place).join(offsets, ["pid", "conv_id"]).select(
        "conv_id", (F.col("before") + F.col("place")).cast("long").alias("pos"), "item", "chars")


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: ``(conv_id, pos, item, chars)`` and
    ``(conv_id, n_turns)``, the second with the turnless ones.

    Conversation c begins with the first h turns of conversation c - c % 100
    (all if it has fewer, none if there is none) and goes on with its own turns
    after its first h, where h is the unsigned CRC-32 of c's digits modulo 6.
    """
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    heads = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("long")
    ids = sizes.withColumn("h", heads).withColumn("base", F.col("conv_id") - F.col("conv_id") % HUNDRED)
    first = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    ids = stage_table(ids.join(first, "base", "left").withColumn("k", F.least("h", F.coalesce("n_base", F.lit(0)))), "trie-ids")
    taken = turns.filter(F.col("pos") < HEADS).withColumnRenamed("conv_id", "base").join(ids.select("base", "conv_id", "k"), "base")
    own = turns.join(ids.select("conv_id", "h", "k"), "conv_id").filter("pos > h")
    rows = (taken.filter("pos <= k").select("conv_id", "pos", "item", "chars")
            .union(own.select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "item", "chars")))
    return stage_table(rows, "trie-rebuilt"), ids.select("conv_id", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns"))


def _cuts(turns: DataFrame, height: int) -> dict[int, DataFrame]:
    """For each half height h the digests of the h turns above every cut:
    ``(conv_id, top, depth, digest)``, ``depth`` = ``top`` + h.  Blocks of 2h
    turns are made from their two halves; half a block is no block."""
    cuts, h = {}, 1
    blocks = turns.select("conv_id", (F.col("pos") - 1).alias("block"), F.col("item").alias("digest"))
    while h < height:
        cuts[h] = blocks.filter("block % 2 = 0").select("conv_id", (F.col("block") * h).alias("top"), ((F.col("block") + 1) * h).alias("depth"), "digest")
        half = [F.max(F.when(F.col("block") % 2 == i, F.col("digest"))).alias(f"d{i}") for i in (0, 1)]
        pairs = blocks.groupBy("conv_id", F.floor(F.col("block") / 2).alias("up")).agg(*half).filter("d0 IS NOT NULL AND d1 IS NOT NULL")
        h *= 2
        if h < height:
            blocks = stage_table(pairs.select("conv_id", F.col("up").alias("block"), F.unhex(F.sha2(F.concat("d0", "d1"), 256)).alias("digest")), f"trie-blocks-{h}")
    return cuts


def name_prefixes(turns: DataFrame, members: DataFrame) -> tuple[DataFrame, int]:
    """``(conv_id, depth, name)`` for every conversation and depth from 0 to
    its length -- ``name`` is the smallest conversation with the same first
    ``depth`` turns -- and the height (a power of two) above all depths."""
    deepest = members.agg(F.max("n_turns")).first()[0] or 0
    height = 1 << deepest.bit_length()
    cuts = _cuts(turns, height)
    root = members.crossJoin(F.broadcast(members.agg(F.min("conv_id").alias("name"))))      # one row: the root's name
    named = [stage_table(root.select("conv_id", F.lit(0).cast("long").alias("depth"), "name"), "trie-names-0")]
    for h in sorted(cuts, reverse=True):
        tops = reduce(DataFrame.union, named).select("conv_id", F.col("depth").alias("top"), F.col("name").alias("root"))
        rows = stage_table(cuts[h].join(tops, ["conv_id", "top"]), f"trie-cut-{h}")
        # written before the join: a hot prefix's rows can then be split over tasks
        names = stage_table(rows.groupBy("depth", "root", "digest").agg(F.min("conv_id").alias("name")), f"trie-least-{h}")
        named.append(stage_table(rows.join(names, ["depth", "root", "digest"]).select("conv_id", "depth", "name"), f"trie-names-{h}"))
    return reduce(DataFrame.union, named), height


def graft(state: DataFrame, names: DataFrame, height: int, totals: list[str]) -> DataFrame:
    """``state(depth, name, totals...)`` with every total summed over the
    node's subtree."""
    h = 1
    while h < height:
        block = F.floor(F.col("depth") / (2 * h)).alias("block")
        lower = state.filter(F.col("depth") % (2 * h) == h).select(F.col("name").alias("conv_id"), block, *totals)
        upper = names.filter(F.col("depth") % (2 * h) < h).select("conv_id", block, "depth", "name")
        more = upper.join(lower, ["conv_id", "block"]).select("depth", "name", *totals)
        state = stage_table(state.union(more).groupBy("depth", "name").agg(*[F.sum(t).alias(t) for t in totals]), f"trie-graft-{h}")
        h *= 2
    return state


def ends_digest(ends: DataFrame) -> DataFrame:
    """``(depth, name, ends_sha256)`` of ``ends(depth, name, conv_id)``: the
    digest of a node's ids in order, comma-joined.  Range partitions join the
    ids of their own rows; a task then reads a node's pieces in order and
    feeds them to the hash, holding one Arrow batch at a time."""
    dealt = stage_table(ends.repartitionByRange("depth", "name", "conv_id").withColumn("pid", F.spark_partition_id()), "trie-ends")
    pieces = dealt.groupBy("pid", "depth", "name").agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    pieces = pieces.select("depth", "name", F.col("ids")[0].alias("first"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    out = pa.schema([("depth", pa.int64()), ("name", pa.int64()), ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for b in batches:
            done = []
            for depth, name, ids in zip(b.column("depth").to_pylist(), b.column("name").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if (depth, name) != node:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = (depth, name), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield arrow_batch(out, list(zip(*done, strict=True)))
        if node:
            yield arrow_batch(out, [[node[0]], [node[1]], [state.hexdigest()]])

    fed = pieces.repartition("depth", "name").sortWithinPartitions("depth", "name", "first").select("depth", "name", "ids")
    return fed.mapInArrow(run, "depth long, name long, ends_sha256 string")


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns(conv_id, pos, item, chars)``
    (places from 1 without gaps) over ``members(conv_id, n_turns)``: conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.  The node's last turn is turn ``depth`` of ``conv_id``.
    Without members there is no node.
    """
    names, height = name_prefixes(turns, members)
    sizes = names.groupBy("depth", "name").agg(F.count(F.lit(1)).alias("n_convs"))
    own = names.filter("conv_id = name").select("depth", "name")
    above = names.select((F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("name"), F.col("name").alias("parent"))
    last = turns.select(F.col("conv_id").alias("name"), F.col("pos").alias("depth"), "chars")
    nodes = own.join(above, ["depth", "name"], "left").join(last, ["depth", "name"], "left").join(sizes, ["depth", "name"])
    nodes = stage_table(nodes, "trie-nodes")
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stage_table(nodes.join(children, ["depth", "name"], "left").fillna(0, ["n_children", "chars"]), "trie-children")
    state = nodes.select("depth", "name", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"))
    totals = graft(state, names, height, ["n_leaves", "saved_tokens"])
    ends = names.join(members.select("conv_id", F.col("n_turns").alias("depth")), ["conv_id", "depth"]).select("depth", "name", "conv_id")
    rows = nodes.drop("chars").join(totals, ["depth", "name"]).join(ends_digest(ends), ["depth", "name"], "left")
    return rows.select(F.col("name").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
                       F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def rebuilt_trie(convs: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations (see :func:`rebuild`).

    Null and tied turns, null roles and texts and repeated rows: see
    :func:`ordered_turns`; a turn of any length is its digest and its length.
    Other columns are not read, an empty table gives an empty result."""
    return prefix_trie(*rebuild(stage_table(ordered_turns(convs), "trie-order")))


def oracle_sql() -> str:
    """The same nodes in DuckDB, by comparing whole prefixes: CRC-32 bit by
    bit, prefixes as lists of turn digests, subtrees as all pairs of a node and
    the nodes on the path of its smallest member."""
    crc = ("list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))), "
           "lambda acc, byte: list_reduce(list_concat([xor(acc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]), "
           "lambda bits, z: CASE WHEN bits % 2 = 1 THEN xor(bits // 2, 3988292384) ELSE bits // 2 END))")
    return f"""
WITH items AS (SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS item,
                      length(coalesce(text, '')) AS chars FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT conv_id, item, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, item) AS pos FROM items),
ids AS (SELECT conv_id, max(pos) AS n, xor({crc}, 4294967295) % {HEADS} AS h, conv_id - conv_id % {HUNDRED} AS base FROM turns GROUP BY conv_id),
sized AS (SELECT i.conv_id, i.n, i.h, i.base, least(i.h, coalesce(b.n, 0)) AS k FROM ids i LEFT JOIN ids b ON b.conv_id = i.base),
rebuilt AS (SELECT s.conv_id, t.pos, t.item, t.chars FROM sized s JOIN turns t ON t.conv_id = s.base AND t.pos <= s.k
            UNION ALL SELECT s.conv_id, t.pos - s.h + s.k, t.item, t.chars FROM sized s JOIN turns t ON t.conv_id = s.conv_id AND t.pos > s.h),
members AS (SELECT s.conv_id, count(r.pos) AS n_turns, coalesce(list(r.item ORDER BY r.pos) FILTER (WHERE r.pos IS NOT NULL), []) AS line
            FROM sized s LEFT JOIN rebuilt r USING (conv_id) GROUP BY s.conv_id),
prefixes AS (SELECT conv_id, n_turns, d AS depth, list_slice(line, 1, d) AS prefix FROM members, unnest(range(0, n_turns + 1)) u(d)),
named AS (SELECT *, min(conv_id) OVER (PARTITION BY prefix) AS name FROM prefixes),
nodes AS (SELECT depth, name, count(*) AS n_convs,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n_turns = depth), '')) AS ends_sha256
          FROM named GROUP BY depth, name),
linked AS (SELECT x.*, p.name AS parent, coalesce(r.chars, 0) AS chars FROM nodes x LEFT JOIN named p ON p.conv_id = x.name AND p.depth = x.depth - 1
           LEFT JOIN rebuilt r ON r.conv_id = x.name AND r.pos = x.depth),
children AS (SELECT depth - 1 AS depth, parent AS name, count(*) AS n FROM linked WHERE depth > 0 GROUP BY 1, 2),
full_nodes AS (SELECT l.*, coalesce(c.n, 0) AS n_children FROM linked l LEFT JOIN children c ON c.depth = l.depth AND c.name = l.name),
totals AS (SELECT a.depth, a.name, sum(CASE WHEN x.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((x.n_convs - 1) * x.chars) AS saved
           FROM full_nodes x JOIN named a ON a.conv_id = x.name AND a.depth <= x.depth GROUP BY a.depth, a.name)
SELECT f.name AS conv_id, f.depth, f.parent AS parent_conv_id, f.n_convs, f.n_children, CAST(t.n_leaves AS BIGINT) AS n_leaves,
       CAST(t.saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_nodes f JOIN totals t ON t.depth = f.depth AND t.name = f.name"""
