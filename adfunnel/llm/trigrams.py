"""Boolean trigram queries derived from regular expressions, as code search indexes do.

``derive(pattern)`` gives an OR of ANDs of lower-cased trigrams that the lower-cased text of every match answers.
The pattern's syntax tree is walked from the leaves: each node has either the finite set of strings it matches
(``exact``) or the beginnings and ends that its matches must have, besides the query its inside demands.  Sets that
grow beyond ``MOST`` are shortened and queries that do are weakened: a query may let through more texts than match,
never fewer.  Parts that it does not look into (look-around, back references, large classes) demand nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _parser as parser  # the standard library's own reader of patterns

MOST = 64
#: Characters a class may have to be spelled out.
CLASS = 8

Query = frozenset[frozenset[str]]
Strings = frozenset[str]
TRUE: Query = frozenset([frozenset()])
EMPTY: Strings = frozenset([""])


def _minimal(query: Query) -> Query:
    """Without the clauses that demand all that another clause demands, and more."""
    return frozenset(c for c in query if not any(o < c for o in query))


def _either(a: Query, b: Query) -> Query:
    both = _minimal(a | b)
    return both if len(both) <= MOST else TRUE


def _both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > MOST:
        return min(a, b, key=len) if TRUE not in (a, b) else a if b == TRUE else b
    return _minimal(frozenset(x | y for x, y in product(a, b)))


def _cover(s: str) -> frozenset[str]:
    """Every third trigram and the last, which cover the string; those that overlap more add little."""
    return frozenset(s[i:i + 3] for i in [*range(0, len(s) - 2, 3), len(s) - 3])


def _any_of(strings: Strings) -> Query:
    """The text holds one of the strings."""
    least = [s for s in strings if not any(o != s and o in s for o in strings)]
    return TRUE if len(least) > MOST or any(len(s) < 3 for s in least) else _minimal(frozenset(map(_cover, least)))


def _cross(a: Strings, b: Strings) -> Strings:
    return frozenset(x + y for x, y in product(a, b))


@dataclass(frozen=True)
class Node:
    """What the matches of a part of the pattern have in common.  ``exact``: all that it matches, or None."""
    exact: Strings | None = None
    begins: Strings = EMPTY
    ends: Strings = EMPTY
    query: Query = TRUE

    def opened(self) -> "Node":
        """The same without ``exact``, its sets short enough to be joined to others."""
        begins, ends = (self.begins, self.ends) if self.exact is None else (self.exact, self.exact)
        query = self.query
        if len(begins) > MOST:
            query, begins = _both(query, _any_of(begins)), frozenset(s[:2] for s in begins)
        if len(ends) > MOST:
            query, ends = _both(query, _any_of(ends)), frozenset(s[-2:] for s in ends)
        return Node(None, begins if len(begins) <= MOST else EMPTY, ends if len(ends) <= MOST else EMPTY, query)

    def whole(self) -> Query:
        """All that a match demands."""
        if self.exact is not None:
            return _any_of(self.exact)
        return _both(_both(self.query, _any_of(self.begins)), _any_of(self.ends))


NOTHING = Node(exact=EMPTY)
ANYTHING = Node()


def _then(a: Node, b: Node) -> Node:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MOST:
        return Node(exact=_cross(a.exact, b.exact))
    x, y = a.opened(), b.opened()
    if a.exact is not None and len(a.exact) * len(y.begins) <= MOST and b.exact is None:
        return Node(None, _cross(a.exact, y.begins), y.ends, y.query)
    if b.exact is not None and len(x.ends) * len(b.exact) <= MOST and a.exact is None:
        return Node(None, x.begins, _cross(x.ends, b.exact), x.query)
    border = _any_of(_cross(x.ends, y.begins)) if len(x.ends) * len(y.begins) <= MOST else _both(_any_of(x.ends),
                                                                                                _any_of(y.begins))
    return Node(None, x.begins, y.ends, _both(_both(x.query, y.query), border))


def _or(a: Node, b: Node) -> Node:
    if a.exact is not None and b.exact is not None and len(a.exact | b.exact) <= MOST:
        return Node(exact=a.exact | b.exact)
    x, y = a.opened(), b.opened()
    return Node(None, x.begins | y.begins, x.ends | y.ends, _either(a.whole(), b.whole())).opened()


def _class(items: list) -> Node:
    letters: set[str] = set()
    for op, arg in items:
        if str(op) == "LITERAL":
            letters.add(chr(arg).lower())
        elif str(op) == "RANGE" and arg[1] - arg[0] < CLASS:
            letters.update(chr(c).lower() for c in range(arg[0], arg[1] + 1))
        else:
            return ANYTHING
    return Node(exact=frozenset(letters)) if len(letters) <= CLASS else ANYTHING


def _repeat(least: int, most: int, inner: Node) -> Node:
    if least == 0:
        return _or(inner, NOTHING) if most == 1 else ANYTHING
    times = min(least, 3)
    node = inner
    for _ in range(times - 1):
        node = _then(node, inner)
    return node if most == times else node.opened()


def _node(op: str, arg) -> Node:
    if op == "LITERAL":
        return Node(exact=frozenset([chr(arg).lower()]))
    if op == "IN":
        return _class(arg)
    if op == "BRANCH":
        first, *rest = [_sequence(p) for p in arg[1]]
        for n in rest:
            first = _or(first, n)
        return first
    if op == "SUBPATTERN":
        return _sequence(arg[3])
    if op == "ATOMIC_GROUP":
        return _sequence(arg)
    if op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        return _repeat(int(arg[0]), int(arg[1]), _sequence(arg[2]))
    if op in ("AT", "ASSERT", "ASSERT_NOT"):
        return NOTHING
    return ANYTHING


def _sequence(items) -> Node:
    node = NOTHING
    for op, arg in items:
        node = _then(node, _node(str(op), arg))
    return node


def derive(pattern: str) -> list[list[str]]:
    """OR of ANDs of trigrams; empty if a match need not hold any trigram, so that all texts must be scanned."""
    query = _sequence(parser.parse(pattern)).whole()
    return [] if query == TRUE else sorted(sorted(c) for c in query)
