"""Boolean trigram queries from regular expressions.

A query is a list of clauses, all of which must hold; a clause is a list of
alternatives, one of which must; an alternative is a set of trigrams, all of which
must occur in the text. It is a necessary condition for a match: a pattern with
no clause says nothing, and its texts are scanned in full. Letters are folded to
lower case (ASCII), so the query serves patterns with and without regard to case.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from re import _constants as op
from re import _parser

#: Sets of strings beyond this many are forgotten rather than multiplied.
MOST = 48

Clause = tuple[frozenset[str], ...]


@dataclass
class Known:
    """What is known of the strings that a part matches."""

    exact: frozenset[str] | None  # all of them, if few
    before: frozenset[str]  # each begins with one of these
    after: frozenset[str]  # each ends with one of these
    clauses: list[Clause] = field(default_factory=list)


ANY = frozenset({""})


def fold(text: str) -> str:
    return "".join(c.lower() if c.isascii() else c for c in text)


def grams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def clause(strings: frozenset[str]) -> list[Clause]:
    """One of these strings occurs; nothing follows if one is shorter than a trigram."""
    if not strings or min(map(len, strings)) < 3:
        return []
    sets = {grams(s) for s in strings}
    return [tuple(sorted((a for a in sets if not any(b < a for b in sets)), key=sorted))]


def cross(left: frozenset[str], right: frozenset[str]) -> frozenset[str] | None:
    return frozenset(a + b for a in left for b in right) if len(left) * len(right) <= MOST else None


def one_of(chars: frozenset[str] | None) -> Known:
    return Known(chars, chars, chars) if chars is not None and len(chars) <= 8 else Known(None, ANY, ANY)


def charset(items) -> frozenset[str] | None:
    out: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            out.add(fold(chr(value)))
        elif kind is op.RANGE and value[1] - value[0] < 26:
            out |= {fold(chr(c)) for c in range(value[0], value[1] + 1)}
        else:
            return None
    return frozenset(out)


def joined(a: Known, b: Known) -> Known:
    """a, then b."""
    if a.exact is not None and b.exact is not None and (both := cross(a.exact, b.exact)) is not None:
        return Known(both, both, both, a.clauses + b.clauses)
    clauses = a.clauses + b.clauses
    for part in (a, b):
        if part.exact is not None:
            clauses = clauses + clause(part.exact)
    seam = cross(a.exact or a.after, b.exact or b.before)
    if seam is not None:
        clauses = clauses + clause(seam)
    before = cross(a.exact, b.before) if a.exact is not None else a.before
    after = cross(a.after, b.exact) if b.exact is not None else b.after
    return Known(None, before if before is not None else a.exact, after if after is not None else b.exact, clauses)


def either(parts: list[Known]) -> Known:
    """One of the parts."""
    if all(p.exact is not None for p in parts):
        strings = frozenset().union(*(p.exact for p in parts))
        if len(strings) <= MOST:
            return Known(strings, strings, strings)
    own = [p.clauses + (clause(p.exact) if p.exact is not None else []) for p in parts]
    clauses = [tuple(dict.fromkeys(a for c in own for a in c[0]))] if all(own) else []
    ends = [frozenset().union(*(getattr(p, k) for p in parts)) for k in ("before", "after")]
    return Known(None, *(e if len(e) <= MOST else ANY for e in ends), clauses)


def walk(tree) -> Known:
    out = Known(ANY, ANY, ANY)
    for kind, value in tree:
        if kind is op.LITERAL:
            part = one_of(frozenset({fold(chr(value))}))
        elif kind is op.IN:
            part = one_of(charset(value))
        elif kind is op.SUBPATTERN:
            part = walk(value[3])
        elif kind is op.BRANCH:
            part = either([walk(b) for b in value[1]])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            least, most, inner = value
            inner = walk(inner)
            if least == most == 1:
                part = inner
            elif least == 0:
                part = either([Known(ANY, ANY, ANY), inner]) if most == 1 and inner.exact is not None else Known(None, ANY, ANY)
            else:
                part = inner
                for _ in range(min(least, 4) - 1):
                    part = joined(part, inner)
                if least != most or least > 4:
                    part = Known(None, part.before, part.after, part.clauses + (clause(part.exact) if part.exact is not None else []))
        elif kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
            continue
        else:
            part = Known(None, ANY, ANY)
        out = joined(out, part)
    return out


def query(pattern: str) -> list[Clause]:
    """The clauses of `pattern`, without repeats and without those that another implies."""
    known = walk(_parser.parse(pattern, re.IGNORECASE if pattern.startswith("(?i)") else 0))
    clauses = known.clauses + (clause(known.exact) if known.exact is not None else clause(known.before) + clause(known.after))
    found = list(dict.fromkeys(clauses))
    weaker = lambda c, d: all(any(a <= b for a in c) for b in d)  # noqa: E731  d implies c
    return [c for i, c in enumerate(found) if not any(weaker(c, d) and (not weaker(d, c) or j < i) for j, d in enumerate(found) if j != i)]
