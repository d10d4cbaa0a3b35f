"""Boolean trigram queries derived from regular expressions.

A text can match a pattern only if it holds the trigrams of some literal
that every match must contain.  ``trigram_query`` returns them as an OR of
ANDs over lower-cased trigrams, or ``None`` where the pattern has no such
literal: such a rule has to scan every text.
"""

from __future__ import annotations

from itertools import product
from re import _constants as sre, _parser

#: Literal alternatives that are followed before a run of literals is closed.
MAX_LITERALS = 64


def _chars(arg) -> set[str] | None:
    """The few lower-cased characters that a set stands for, if few."""
    found: set[str] = set()
    for op, value in arg:
        if op is sre.LITERAL:
            found.add(chr(value).lower())
        elif op is sre.RANGE and value[1] - value[0] < 8:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= 8 else None


def _literals(items) -> set[str] | None:
    """Every string the items can match (lower-cased), if these are few."""
    out = {""}
    for op, arg in items:
        if op is sre.LITERAL:
            more = {chr(arg).lower()}
        elif op is sre.IN:
            more = _chars(arg)
        elif op is sre.SUBPATTERN:
            more = _literals(arg[3])
        elif op is sre.BRANCH:
            parts = [_literals(x) for x in arg[1]]
            more = None if None in parts else set().union(*parts)
        elif op is sre.MAX_REPEAT and arg[1] == 1:
            more = _literals(arg[2])
            more = more if more is None or arg[0] else more | {""}
        else:
            more = None
        if more is None or len(out) * len(more) > MAX_LITERALS:
            return None
        out = {a + b for a, b in product(out, more)}
    return out


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    runs: list[set[str]] = [{""}]
    for item in _parser.parse(pattern):
        repeated = item[0] is sre.MAX_REPEAT and item[1][0] >= 1 and item[1][1] > 1
        literal = _literals(item[1][2]) if repeated else _literals([item])
        if literal is None or len(runs[-1]) * len(literal) > MAX_LITERALS:
            runs.append({""})
            literal = literal or {""}
        runs[-1] = {a + b for a, b in product(runs[-1], literal)}
        if repeated:
            runs.append({""})
    best: list[frozenset[str]] | None = None
    for run in runs:
        ways = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in run}
        if frozenset() in ways:
            continue
        ways = {w for w in ways if not any(o < w for o in ways)}
        if best is None:
            best = list(ways)
        elif len(best) * len(ways) <= MAX_LITERALS:
            best = list({a | b for a, b in product(best, ways)})
    return None if best is None else sorted((w for w in set(best) if not any(o < w for o in best)), key=sorted)
