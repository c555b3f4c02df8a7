"""Statements of a SQL script: where one ends and which named parameters it uses.

Quoted texts (with backslash escapes), raw texts (``r'...'``), quoted names, line comments and
nested block comments are passed over, so a ``;`` or ``:name`` inside them means nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

_PIECE = re.compile(r"""
    (?P<raw>(?<!\w)[rR](?:'[^']*(?:'|\Z)|"[^"]*(?:"|\Z)))
  | (?P<quoted>'(?:[^'\\]|\\.)*(?:'|\Z)|"(?:[^"\\]|\\.)*(?:"|\Z)|`(?:[^`]|``)*(?:`|\Z))
  | (?P<line>--(?:\\\r?\n|[^\r\n])*)
  | (?P<block>/\*)
  | (?P<end>;)
  | (?P<parameter>(?<![:\w]):[A-Za-z_]\w*)
""", re.X | re.S)
_EDGE = re.compile(r"/\*|\*/")


def pieces(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of the quoted texts, comments, ends and parameters in ``text``; an
    unclosed quote or comment runs to its end."""
    at = 0
    while found := _PIECE.search(text, at):
        kind, start, at = found.lastgroup, found.start(), found.end()
        if kind == "block":
            depth = 1
            while depth:
                edge = _EDGE.search(text, at)
                if edge is None:
                    at = len(text)
                    break
                depth += 1 if edge[0] == "/*" else -1
                at = edge.end()
        yield kind, start, at


def split_statements(text: str) -> list[str]:
    """The statements of a script, in order; pieces without any word of SQL (nothing, or
    only comments) are left out."""
    out, start, words = [], 0, ""
    last = 0
    for kind, begin, end in [*pieces(text), ("end", len(text), len(text))]:
        words += text[last:begin]
        if kind == "end":
            if words.strip():
                out.append(text[start:begin].strip())
            start, words = end, ""
        elif kind not in ("line", "block") or text.startswith("/*+", begin):
            words += "x"
        last = end
    return out


def one_statement(text: str) -> str:
    """The only statement of ``text``."""
    found = split_statements(text)
    if len(found) != 1:
        raise ValueError(f"expected one statement, found {len(found)}: {text.strip()[:80]!r}")
    return found[0]


def parameters(statement: str) -> set[str]:
    """Names of the ``:name`` parameters a statement uses."""
    return {statement[a + 1:b] for kind, a, b in pieces(statement) if kind == "parameter"}
