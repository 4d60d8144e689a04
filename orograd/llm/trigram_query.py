"""Boolean trigram queries that every text matching a regular expression must satisfy."""

from __future__ import annotations

import re._constants as c
import re._parser as parser

MAX_STRINGS = 24   # more possible strings at one place are cut into trigrams or given up

# A query is a list of clauses, all needed; a clause is a set of alternatives, one needed; an
# alternative is a set of trigrams, all needed.
Query = list[frozenset[frozenset[str]]]


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[k:k + 3] for k in range(len(text) - 2))


def query(pattern: str) -> Query:
    """Mandatory trigrams of a pattern in lower case; empty when it has none and texts must be scanned in full."""
    clauses: set[frozenset[frozenset[str]]] = set()
    strings = {""}

    def flush() -> None:
        """What the strings collected so far demand becomes a clause; strings of fewer than three letters demand nothing."""
        nonlocal strings
        if all(len(s) >= 3 for s in strings):
            clauses.add(frozenset(trigrams(s) for s in strings))
        strings = {""}

    def extend(options: set[str] | None) -> None:
        nonlocal strings
        if options is None:
            flush()
        elif len(strings) * len(options) > MAX_STRINGS:
            flush()
            strings = options if len(options) <= MAX_STRINGS else {""}
        else:
            strings = {s + o for s in strings for o in options}

    def walk(items) -> None:
        for op, arg in items:
            exact = options_of([(op, arg)])
            if exact is not None:
                extend(exact)
            elif op is c.SUBPATTERN:
                walk(arg[-1])
            elif op in (c.MAX_REPEAT, c.MIN_REPEAT) and arg[0] > 0:
                one = options_of(arg[2])
                extend(one)
                flush()
            else:
                flush()

    walk(parser.parse(pattern))
    flush()
    return sorted(clauses, key=lambda q: sorted(map(sorted, q)))


def options_of(items) -> set[str] | None:
    """All strings, in lower case, that a part of a pattern matches; None when they are many or endless."""
    out = {""}
    for op, arg in items:
        if op is c.LITERAL:
            more = {chr(arg).lower()}
        elif op is c.IN:
            more = set()
            for kind, x in arg:
                if kind is c.LITERAL:
                    more.add(chr(x).lower())
                elif kind is c.RANGE and x[1] - x[0] < 8:
                    more |= {chr(k).lower() for k in range(x[0], x[1] + 1)}
                else:
                    return None
        elif op is c.SUBPATTERN:
            more = options_of(arg[-1])
        elif op is c.BRANCH:
            parts = [options_of(p) for p in arg[1]]
            more = None if None in parts else set().union(*parts)
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT) and arg[1] is not c.MAXREPEAT and arg[1] <= 6:
            one = options_of(arg[2])
            more = None if one is None else repeated(one, int(arg[0]), int(arg[1]))
        else:
            return None
        if more is None or len(out) * len(more) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in more}
    return out


def repeated(one: set[str], least: int, most: int) -> set[str] | None:
    out, level = set(), {""}
    for k in range(most + 1):
        if k >= least:
            out |= level
        level = {a + b for a in level for b in one}
        if len(out) + len(level) > 4 * MAX_STRINGS:
            return None
    return out
