"""Composition of the DuckDB oracle text: merge CTE blocks that share definitions (first one wins)."""
from __future__ import annotations


def _split_top(block: str) -> list[str]:
    """Split ``a AS (...), b AS (...)`` at top-level commas (quotes and parentheses respected)."""
    out, depth, quote, cur = [], 0, None, []
    for ch in block:
        if quote:
            cur.append(ch)
            if ch == quote:
                quote = None
            continue
        if ch in ("'", '"'):
            quote = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == "," and depth == 0:
            out.append("".join(cur).strip())
            cur = []
            continue
        cur.append(ch)
    if "".join(cur).strip():
        out.append("".join(cur).strip())
    return out


def with_ctes(*blocks: str) -> str:
    seen, parts = set(), []
    for b in blocks:
        for cte in _split_top(b):
            name = cte.split()[0].lower()
            if name not in seen:
                seen.add(name)
                parts.append(cte)
    return "WITH " + ",\n".join(parts)
