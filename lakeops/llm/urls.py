"""URL filter: path rules, and exact list membership by a Bloom filter cascade.

Level 1 is a Bloom filter of the listed keys.  The keys of the corpus that it
takes for listed by mistake are the content of level 2, the listed keys that
level 2 takes for mistakes that of level 3, and so on until a level makes no
mistake on the corpus's complete key universe.  The first level that denies
a key decides: an odd one says 'not listed', an even one 'listed'.  For every
key of the universe that is exact, and a page is judged where it lies,
without a join.  All of it is built-in column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.llm.common import stage_table

#: Fixed by the contract: (verdict, host, start of the path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Labels of hosts that the built-in list takes for advertising or fraud.
LISTED_HOST = r"(^|[.-])(spam|pills|casino|warez|malware|phishing|betting|viagra|adserver|clickbait)([.-]|$)"
HASHES = 5
BITS_PER_KEY = 8
#: A cascade's bits go to every task; a list that needs more than this is refused (split the list then).
MAX_BITS = 1 << 29
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


@dataclass(frozen=True)
class Level:
    """One Bloom filter: a one-row table ``bits`` of 64-bit words."""

    number: int
    words: int
    bits: DataFrame


def _slots(key: Column, level: int, words: int) -> list[Column]:
    """The bit positions of a key, by double hashing."""
    size = F.lit(64 * words)
    a, b = F.pmod(F.xxhash64(F.lit(level), key), size), F.pmod(F.xxhash64(key, F.lit(level)), size)
    return [F.pmod(a + F.lit(j) * b, size) for j in range(HASHES)]


def build_level(keys: DataFrame, number: int) -> Level:
    """Bloom filter of the distinct ``key`` values."""
    words = max(1, -(-keys.count() * BITS_PER_KEY // 64))
    if 64 * words > MAX_BITS:
        raise ValueError(f"{64 * words} bits in level {number}: the list is too long for one cascade, split it")
    slot = keys.select(F.explode(F.array(*_slots(F.col("key"), number, words))).alias("slot"))
    # A word's bits are set by or-ing; F.bit_or sums them up before the shuffle.
    filled = (slot.groupBy(F.floor(F.col("slot") / 64).alias("word"))
              .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 AS int))")).alias("bits")))
    dense = (keys.sparkSession.range(words).withColumnRenamed("id", "word").join(filled, "word", "left")
             .agg(F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))).alias("w"))
             .select(F.col("w.bits").alias("bits")))
    return Level(number, words, stage_table(dense, f"cascade-{number}"))


def in_level(key: Column, level: Level) -> Column:
    """Whether the level's filter holds all bits of the key."""
    bits = level.bits.scalar()
    word = lambda s: F.element_at(bits, (F.floor(s / 64) + 1).cast("int"))
    return reduce(lambda x, y: x & y, [F.getbit(word(s), (s % 64).cast("int")) == 1 for s in _slots(key, level.number, level.words)])


def build_cascade(listed: DataFrame, universe: DataFrame) -> list[Level]:
    """Levels for the distinct non-null ``key`` values of ``listed`` against
    those of ``universe``.  A listed key need not occur in the universe."""
    content = stage_table(listed.select("key").filter("key IS NOT NULL").distinct(), "cascade-listed")
    others = stage_table(universe.select("key").filter("key IS NOT NULL").distinct().join(content, "key", "left_anti"), "cascade-others")
    levels: list[Level] = []
    while not content.isEmpty():
        level = build_level(content, len(levels) + 1)
        levels.append(level)
        mistaken = stage_table(others.filter(in_level(F.col("key"), level)), "cascade-false")
        content, others = mistaken, content
    return levels


def is_listed(key: Column, levels: list[Level]) -> Column:
    """Exact for every key of the universe and of the list."""
    out = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        out = F.when(~in_level(key, level), F.lit(level.number % 2 == 0)).otherwise(out)
    return out


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def listed_hosts(pages: DataFrame, pattern: str = LISTED_HOST) -> DataFrame:
    """The list that the query uses: hosts of the corpus with a listed label."""
    return pages.select(host_of(F.col("url")).alias("key")).distinct().filter(F.col("key").rlike(pattern))


def url_verdicts(pages: DataFrame, listed: DataFrame) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``: the longest
    fitting rule's, else block if the list has the host or host and path
    (``key`` of ``listed``), else allow.

    A null url and one without ``://`` have empty host and path: no rule fits
    and no key is looked up.  Rows keep their number; an empty list or table
    is no error; columns of these four names are replaced.
    """
    parts = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    keys = parts.select(F.explode(F.array("host", F.concat("host", "path"))).alias("key")).filter("key <> ''")
    levels = build_cascade(listed, keys)
    rule, said = rule_of(F.col("host"), F.col("path"))
    hit = (F.col("host") != "") & (is_listed(F.col("host"), levels) | is_listed(F.concat("host", "path"), levels))
    return parts.withColumns({"rule": rule, "verdict": F.coalesce(said, F.when(hit, "block").otherwise("allow"))})


def oracle_sql() -> str:
    order = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, says) for says, h, p in order]
    case = lambda n: " ".join(f"WHEN {f[0]} THEN '{f[n]}'" for f in fits)
    return f"""WITH p AS (SELECT page_id,
            translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
            regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages)
        SELECT page_id, host, path, CASE {case(1)} END AS rule,
            CASE {case(2)} WHEN regexp_matches(host, '{LISTED_HOST}') THEN 'block' ELSE 'allow' END AS verdict FROM p"""
