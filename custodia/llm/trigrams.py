"""Boolean trigram queries from regular expressions, for an inverted index of lower-cased trigrams.

A query is True (every text may match), a trigram, or ("and" | "or", parts). It holds for every text
that the expression can match; the converse is not promised, so candidates are verified.
"""

from __future__ import annotations

from re import _constants as op
from re import _parser

#: Alternatives of one sub-expression that are spelt out; more than that and the part asks for nothing.
MOST_STRINGS = 64

Query = bool | str | tuple


def both(kind: str, parts: list[Query]) -> Query:
    """The parts joined by "and" or "or", simplified."""
    unit = kind == "and"
    parts = [p for p in dict.fromkeys(parts) if p is not unit]
    if any(isinstance(p, bool) for p in parts):
        return not unit
    return unit if not parts else parts[0] if len(parts) == 1 else (kind, *parts)


def of_strings(strings: set[str]) -> Query:
    """Any of the strings; one whose trigrams include another's adds nothing."""
    each = {frozenset(s[i : i + 3] for i in range(len(s) - 2)): s for s in sorted(strings, reverse=True)}
    least = [s for grams, s in each.items() if not any(other < grams for other in each)]
    return both("or", [both("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(least)])


def _strings(item) -> set[str] | None:
    """Every string that a parsed item stands for, if they are few."""
    kind, arg = item
    if kind is op.LITERAL:
        return {chr(arg).lower()}
    if kind is op.IN:
        out = set()
        for k, a in arg:
            if k is op.LITERAL:
                out.add(chr(a).lower())
            elif k is op.RANGE and a[1] - a[0] < 8:
                out |= {chr(x).lower() for x in range(a[0], a[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if kind is op.SUBPATTERN:
        return _sequence(arg[-1])[0]
    if kind is op.BRANCH:
        each = [_sequence(p)[0] for p in arg[1]]
        return None if any(e is None for e in each) else set().union(*each)
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and arg[1] <= 2 and (once := _sequence(arg[2])[0]) is not None:
        out, power = ({""} if arg[0] == 0 else set()), {""}
        for n in range(1, arg[1] + 1):
            power = {a + b for a in power for b in once}
            out |= power if n >= arg[0] else set()
        return out if len(out) <= MOST_STRINGS else None
    return {""} if kind is op.AT else None


def _asks(item) -> Query:
    """What an item asks for whose strings are too many."""
    kind, arg = item
    if kind is op.SUBPATTERN:
        return _sequence(arg[-1])[1]
    if kind is op.BRANCH:
        return both("or", [_sequence(p)[1] for p in arg[1]])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and arg[0] > 0:
        return _sequence(arg[2])[1]
    return True


def _sequence(items) -> tuple[set[str] | None, Query]:
    """(all strings of the sequence or None, its query)."""
    runs, asked, run, exact = [], [], {""}, True
    for item in items:
        found = _strings(item)
        if found is not None and len(run) * len(found) <= MOST_STRINGS:
            run = {a + b for a in run for b in found}
            continue
        runs.append(run)
        exact = False
        run = found if found is not None else {""}
        if found is None:
            asked.append(_asks(item))
    runs.append(run)
    return (run if exact else None), both("and", [of_strings(r) for r in runs] + asked)


def query_of(pattern: str) -> Query:
    return _sequence(_parser.parse(pattern))[1]


def trigrams_of(query: Query) -> set[str]:
    if isinstance(query, bool):
        return set()
    return {query} if isinstance(query, str) else set().union(*(trigrams_of(p) for p in query[1:]))
