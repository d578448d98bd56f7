"""The role grammar of conversations, its LR automaton, and generalised LR repair over it.

A stack is a node (state, node below); nodes are shared, so all stacks of a parse form one graph and
equal tops are the same node.  Reading a row takes every stack of the frontier through every edit: keep
or rerole it (a shift, then the reductions that follow), delete it (the stack stays), or insert a turn
before it.  Stacks that meet on a node are merged into the cheapest by (cost, audit).

Merging is safe: edits of one length of rows and of equal cost never have audits of which one begins
the other (the rest could only be insertions, which cost), so what follows cannot turn their order.
"""

from __future__ import annotations

from collections.abc import Iterable

# The grammar, written left-recursively so that stacks stay shallow, the names of the
# roles that edits can make, the costs of edits, and what one row's cut-off text adds while it stays.
START_SYMBOL = "Talk"
RULES = [("Talk", ()), ("Talk", ("Turns",)), ("Talk", ("s", "Turns")), ("Turns", ("u", "a")), ("Turns", ("Turns", "u", "a"))]
ROLE_NAMES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

TERMINALS = frozenset(s for _, rhs in RULES for s in rhs) - {lhs for lhs, _ in RULES}


def _closure(items: Iterable[tuple[int, int]]) -> frozenset:
    found, todo = set(items), list(items)
    while todo:
        rule, dot = todo.pop()
        rhs = RULES[rule][1]
        for r, (lhs, _) in enumerate(RULES):
            if dot < len(rhs) and rhs[dot] == lhs and (r, 0) not in found:
                found.add((r, 0))
                todo.append((r, 0))
    return frozenset(found)


def _goto(state: frozenset, symbol: str) -> frozenset:
    return _closure([(r, dot + 1) for r, dot in state if dot < len(RULES[r][1]) and RULES[r][1][dot] == symbol])


def _complete(state: frozenset) -> list[int]:
    return [r for r, dot in state if dot == len(RULES[r][1])]


def _shift(stack: tuple, symbol: str) -> tuple | None:
    """Push a symbol, then reduce while the state holds nothing but a complete rule."""
    state = _goto(stack[0], symbol)
    if not state:
        return None
    stack = (state, stack)
    done = _complete(state)
    if len(state) == len(done) == 1 and RULES[done[0]][0] != START_SYMBOL:
        lhs, rhs = RULES[done[0]]
        for _ in rhs:
            stack = stack[1]
        return _shift(stack, lhs)
    return stack


def _accepted(stack: tuple) -> bool:
    """Whether a complete rule of the start symbol covers the whole stack."""
    for r in _complete(stack[0]):
        below = stack
        if RULES[r][0] == START_SYMBOL:
            for _ in RULES[r][1]:
                below = below[1]
            if below[1] is None:
                return True
    return False


def _graph() -> tuple[list[dict[str, int]], list[bool]]:
    """All stacks that the grammar's prefixes leave, numbered: shifts from each, and which are accepted."""
    nodes = {(_closure([(r, 0) for r, (lhs, _) in enumerate(RULES) if lhs == START_SYMBOL]), None): 0}
    shifts: list[dict[str, int]] = []
    for stack in (todo := list(nodes)):
        shifts.append({})
        for symbol in sorted(TERMINALS):
            to = _shift(stack, symbol)
            if to is not None:
                if to not in nodes:
                    nodes[to] = len(nodes)
                    todo.append(to)
                shifts[-1][symbol] = nodes[to]
    return shifts, [_accepted(n) for n in nodes]


SHIFTS, ACCEPTED = _graph()
FIRST = 0                                                    # the empty stack
MADE = [[(s, SHIFTS[n][s]) for s in ROLE_NAMES if s in SHIFTS[n]] for n in range(len(SHIFTS))]

#: Stack node -> (cost, audit) of the cheapest edits that lead to it.
Frontier = dict[int, tuple[int, str]]


def _merge(frontier: Frontier, node: int, cost: int, audit: str) -> bool:
    now = frontier.get(node)
    if now is None or (cost, audit) < now:
        frontier[node] = (cost, audit)
        return True
    return False


def with_inserts(frontier: Frontier) -> Frontier:
    """The frontier after any number of inserted turns."""
    out, todo = dict(frontier), list(frontier)
    while todo:
        node = todo.pop()
        cost, audit = out[node]
        todo += [to for _, to in MADE[node] if _merge(out, to, cost + INSERT, audit + "I")]
    return out


def read_row(frontier: Frontier, initial: str, must_go: bool, truncated: bool) -> Frontier:
    """The frontier after one row: role initial, whether it has to be deleted, whether its text breaks off."""
    out: Frontier = {}
    extra = TRUNCATED if truncated else 0
    for node, (cost, audit) in with_inserts(frontier).items():
        _merge(out, node, cost + DELETE, audit + "D")
        if must_go:
            continue
        if initial in SHIFTS[node]:
            _merge(out, SHIFTS[node][initial], cost + KEEP + extra, audit + "K")
        for _, to in MADE[node]:
            _merge(out, to, cost + REROLE + extra, audit + "R")
    return out


def endings() -> Frontier:
    """For each stack that can be brought to an end, the cost and audit of the turns inserted to do so."""
    out = {}
    for node in range(len(SHIFTS)):
        ends = [v for n, v in with_inserts({node: (0, "")}).items() if ACCEPTED[n]]
        if ends:
            out[node] = min(ends)
    return out


ENDINGS = endings()


def apply_edits(node: int, audit: str, rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Rows (role, text) that the edits leave, from stack ``node`` on."""
    out, at = [], 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else rows[at]
        at += edit != "I"
        if edit == "D":
            continue
        symbol = role[:1] if edit == "K" else MADE[node][0][0]
        out.append((role if edit == "K" else ROLE_NAMES[symbol], text))
        node = SHIFTS[node][symbol]
    return out
