"""Secret scan over a trigram inverted index.

Each rule's regular expression gives a Boolean trigram query.  The index has
a posting (trigram, document) for every trigram that some rule asks for and
every document that holds it, in any case.  A rule's candidates are the
intersection of the postings of one of its trigram sets; only they are
searched with the rule's expression.  A rule without mandatory trigrams
(``hex``) searches every text.  All of it is built-in column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.llm.trigrams import trigram_query


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose group ``group`` has at least ``least``
    characters; shorter matches are dropped without a second try."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


def _any_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


#: Fixed by the contract, in its order.  A run of hex digits, and one of
#: capitals and digits after AKIA, is maximal, so asking for its length in
#: the pattern drops the same matches.
BASE = (
    Rule("assign", "(" + _any_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", "AKIA[A-Z0-9]{12,}"),
    Rule("hex", "[0-9a-f]{32,}"),
)
#: What the scan adds: published forms of keys and tokens.
ADDED = (
    Rule("private_key", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", "[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE + ADDED


def postings(rows: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The inverted index ``(trigram, id)`` of the rules' trigrams."""
    wanted = sorted({t for r in rules for way in trigram_query(r.pattern) or () for t in way})
    text = rows.select("id", F.lower("text").alias("text"))
    found = F.array_compact(F.array(*[F.when(F.contains("text", F.lit(t)), F.lit(t)) for t in wanted]))
    return text.select("id", F.explode(found).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(id, kinds)``: the rules whose trigram query a document meets.

    The queries' table has a row per rule, way and trigram -- some dozens,
    whatever the data -- and is the only broadcast side.  A posting list may
    hold a third of the corpus: intersecting groups by document, so that no
    list is gathered anywhere.
    """
    asked = [(r.kind, n, t, len(way)) for r in rules for n, way in enumerate(trigram_query(r.pattern) or ()) for t in way]
    queries = index.sparkSession.createDataFrame(asked, "kind string, way int, trigram string, need int")
    met = (index.join(F.broadcast(queries), "trigram").groupBy("id", "kind", "way")
           .agg(F.countDistinct("trigram").alias("n"), F.max("need").alias("need")).filter("n = need"))
    return met.groupBy("id").agg(F.collect_set("kind").alias("kinds"))


def _spans(rule: Rule, rank: int) -> Column:
    """Sorted spans from a rule's matches and the pieces between them: the
    i-th match starts after the first i pieces and i-1 matches."""
    m, p, g = f"m{rank}", f"p{rank}", f"g{rank}"
    return F.expr(f"""aggregate(sequence(1, size({m})),
        struct(0 AS pos, cast(array() AS array<struct<start:int,rank:int,end:int>>) AS found),
        (a, i) -> struct(a.pos + length({p}[i - 1]) + length({m}[i - 1]) AS pos,
            if(length({g}[i - 1]) >= {rule.least},
               array_append(a.found, named_struct('start', a.pos + length({p}[i - 1]), 'rank', {rank},
                                                  'end', a.pos + length({p}[i - 1]) + length({m}[i - 1]))),
               a.found) AS found),
        a -> a.found)""")


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``row`` (the columns of ``docs`` as a struct, so that no name can clash)
    and ``spans``: array of (start, rank of the rule, end) in code points,
    sorted.

    A null text counts as empty and has no spans.  Repeated rows stay
    repeated.  Texts are matched whole.  ``doc_id`` may be null or repeated:
    documents that share one share their candidate rules, which the search
    itself then settles.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    hits = candidates(postings(rows.select("id", "text"), rules), rules)
    # The text crosses the shuffle once, inside ``row``.
    rows = (rows.select("row", "id").join(hits.hint("shuffle_hash"), "id", "left")
            .withColumn("text", F.coalesce(F.col("row")["text"], F.lit(""))))
    none = F.expr("cast(array() AS array<string>)")
    found: dict[str, Column] = {}
    pieces: dict[str, Column] = {}
    for rank, rule in enumerate(rules):
        pattern = F.lit(rule.pattern)
        found[f"m{rank}"] = F.regexp_extract_all("text", pattern, F.lit(0))
        if trigram_query(rule.pattern) is not None:
            asked = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
            found[f"m{rank}"] = F.when(asked, found[f"m{rank}"]).otherwise(none)
        some = F.size(f"m{rank}") > 0
        pieces[f"p{rank}"] = F.when(some, F.split("text", pattern, -1)).otherwise(none)
        pieces[f"g{rank}"] = F.when(some, F.regexp_extract_all("text", pattern, F.lit(rule.group))).otherwise(none) if rule.group else F.col(f"m{rank}")
    empty = F.expr("cast(array() AS array<struct<start:int,rank:int,end:int>>)")
    each = [F.when(F.size(f"m{rank}") > 0, _spans(rule, rank)).otherwise(empty) for rank, rule in enumerate(rules)]
    return (rows.withColumns(found).withColumns(pieces).select("row", F.array_sort(F.concat(*each)).alias("spans")))


def span_string(spans: Column | str, rules: tuple[Rule, ...] = RULES) -> Column:
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"], s["end"])), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, counts of the base rules, a digest of their spans
    and all spans as text; see ``find_secrets`` for odd input."""
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    count = lambda n: F.size(F.filter("spans", lambda s: s["rank"] == n)).cast("long")
    return find_secrets(docs.select("doc_id", "text")).select(
        F.col("row.doc_id").alias("doc_id"), *[count(n).alias(f"n_{r.kind}") for n, r in enumerate(BASE)],
        F.sha2(span_string(base), 256).alias("base_sha256"), span_string("spans").alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark`` (overlapping spans
    by one) and ``n_chars``, where there is one, set to the new length of
    changed texts.  Rows without spans stay as they are."""
    rows = find_secrets(docs)
    merged = F.expr("""aggregate(spans, cast(array() AS array<struct<start:int,end:int>>), (a, s) ->
        if(size(a) > 0 AND s.start <= element_at(a, -1).end,
           array_append(slice(a, 1, size(a) - 1), named_struct('start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, s.end))),
           array_append(a, named_struct('start', s.start, 'end', s.end))))""")
    rows = rows.withColumn("cuts", F.when(F.size("spans") > 0, merged)).withColumn("mark", F.lit(mark))
    clean = F.expr("""concat_ws('', aggregate(cuts, struct(1 AS at, cast(array() AS array<string>) AS parts),
        (a, c) -> struct(c.end + 1 AS at, concat(a.parts, array(substring(row.text, a.at, c.start + 1 - a.at), mark)) AS parts),
        a -> array_append(a.parts, substring(row.text, a.at))))""")
    rows = rows.withColumn("clean", F.when(F.col("cuts").isNotNull(), clean))
    out = {"text": F.coalesce("clean", "row.text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(F.col("clean").isNotNull(), F.length("clean").cast(kind)).otherwise(F.col("row.n_chars"))
    return rows.select(*[out.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def oracle_sql() -> str:
    """The report in DuckDB SQL: every rule over every text, no index."""
    lists, spans = [], []
    for rank, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        lists.append(f"regexp_extract_all(t, '{p}', 0) AS m{rank}, regexp_extract_all(t, '{p}', {r.group}) AS g{rank}, string_split_regex(t, '{p}') AS p{rank}")
        at = f"list_sum(list_transform(p{rank}[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m{rank}[1:i-1], lambda x: length(x))), 0)"
        spans.append(f"list_transform(list_filter(range(1, len(m{rank}) + 1), lambda i: length(g{rank}[i]) >= {r.least}),"
                     f" lambda i: {{'s': ({at})::BIGINT, 'r': {rank}, 'e': ({at} + length(m{rank}[i]))::BIGINT}})")
    names = ", ".join(f"'{r.kind}'" for r in RULES)
    text = f"array_to_string(list_transform({{}}, lambda s: [{names}][s.r + 1] || ':' || s.s || ':' || s.e), ',')"
    counts = ", ".join(f"len(list_filter(a, lambda s: s.r = {n})) AS n_{r.kind}" for n, r in enumerate(BASE))
    return (f"WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS (SELECT doc_id, {', '.join(lists)} FROM d),"
            f" s AS (SELECT doc_id, list_sort(list_concat({', '.join(spans)})) AS a FROM m)"
            f" SELECT doc_id, {counts}, sha256({text.format(f'list_filter(a, lambda s: s.r < {len(BASE)})')}) AS base_sha256, {text.format('a')} AS spans FROM s")
