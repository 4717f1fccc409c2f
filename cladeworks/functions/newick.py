"""Newick text to node rows and back (H1, H2), without recursion."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

COLUMNS = ("node_id", "parent_id", "is_leaf", "edge_length", "pre", "last", "depth", "root_dist")
_TOKEN = re.compile(r"\s*(?:\[[^\]]*\]\s*)*('(?:[^']|'')*'|[(),:;]|[^\s(),:;'\[\]]+)")


def parse_newick(text: str) -> list[dict]:
    """Nodes in preorder with ``node_id, parent_id, is_leaf, edge_length, pre, last, depth, root_dist``.

    Names are kept; unnamed internal nodes become ``internal_{k}`` by preorder with a
    counter of their own, unnamed leaves ``leaf_{k}``. A missing length is 0. The tree
    is rooted as written.
    """
    return [dict(zip(COLUMNS, row, strict=True)) for part in newick_parts(text) for row in zip(*part, strict=True)]


def newick_parts(text: str, size: int = 1 << 16) -> Iterator[list[list]]:
    """The same nodes as lists of :data:`COLUMNS`, ``size`` nodes at a time; a whole tree is held as flat arrays only."""
    names: list[str | None] = []
    up, inner, length = array("q"), bytearray(), array("d")
    stack: list[int] = []
    now, await_length = None, False

    def add():
        names.append(None)
        up.append(stack[-1] if stack else -1)
        inner.append(0)
        length.append(0.0)
        if stack:
            inner[stack[-1]] = 1
        return len(names) - 1

    for match in _TOKEN.finditer(text):
        token = match[1]
        if token == "(":
            now = add() if now is None else now
            stack.append(now)
            now = None
        elif token == ",":
            if not stack:
                raise IndexError("a comma outside of brackets")
            now = add() if now is None else now
            now, await_length = None, False
        elif token == ")":
            if not stack:
                raise ValueError("unbalanced brackets")
            if now is None:
                add()
            now, await_length = stack.pop(), False
        elif token == ":":
            await_length = True
        elif token == ";":
            break
        elif await_length:
            now = add() if now is None else now
            length[now], await_length = float(token), False
        else:
            now = add() if now is None else now
            names[now] = token[1:-1].replace("''", "'") if token.startswith("'") else token
    if stack:
        raise ValueError("unbalanced brackets")
    internal = leaf = 0
    n = len(names)
    last, depth, dist = array("q", range(n)), array("q", bytes(8 * n)), array("d", bytes(8 * n))
    for i in range(n):
        if names[i] is None:
            internal, leaf = internal + inner[i], leaf + (not inner[i])
            names[i] = f"internal_{internal}" if inner[i] else f"leaf_{leaf}"
        if up[i] >= 0:
            depth[i], dist[i] = depth[up[i]] + 1, dist[up[i]] + length[i]
    for i in range(n - 1, 0, -1):
        if up[i] >= 0:
            last[up[i]] = max(last[up[i]], last[i])
    for a in range(0, n, size):
        b = min(a + size, n)
        above = [names[k] if k >= 0 else None for k in up[a:b]]
        yield [names[a:b], above, [not x for x in inner[a:b]], list(length[a:b]), list(range(a, b)), list(last[a:b]), list(depth[a:b]), list(dist[a:b])]


def _name(label: str) -> str:
    return label if re.fullmatch(r"[^\s(),:;'\[\]]*", label) else "'" + label.replace("'", "''") + "'"


def format_newick(rows: list[dict]) -> str:
    """Text of nodes with ``label, pre, last, edge_length``; the root has no length."""
    out: list[str] = []
    open_until: list[tuple[int, str]] = []
    for r in sorted(rows, key=lambda r: r["pre"]):
        while open_until and open_until[-1][0] < r["pre"]:
            out.append(")" + open_until.pop()[1])
        if out and out[-1] != "(":
            out.append(",")
        tail = _name(r["label"]) + (f":{r['edge_length']:g}" if r["pre"] else "")
        if r["last"] > r["pre"]:
            out.append("(")
            open_until.append((r["last"], tail))
        else:
            out.append(tail)
    while open_until:
        out.append(")" + open_until.pop()[1])
    return "".join(out) + ";"
