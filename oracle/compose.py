"""Build a self-contained DuckDB query from named CTE bodies.

``compose(final_sql, ctes)`` scans the final query for CTE names, pulls in
their dependencies transitively and emits ``WITH a AS (...), b AS (...)``
in dependency order.
"""

from __future__ import annotations

import re


def _refs(sql: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b{re.escape(n)}\b", sql)]


def compose(final_sql: str, ctes: dict[str, str], materialized: bool = False) -> str:
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str, stack: tuple = ()):
        if name in seen:
            return
        if name in stack:
            raise ValueError(f"cycle at {name}")
        for dep in _refs(ctes[name], [n for n in ctes if n != name]):
            visit(dep, stack + (name,))
        seen.add(name)
        order.append(name)

    for n in _refs(final_sql, ctes):
        visit(n)
    if not order:
        return final_sql.strip()
    body = ",\n".join(f"{n} AS {'MATERIALIZED ' if materialized else ''}(\n{ctes[n].strip()}\n)" for n in order)
    final = final_sql.strip()
    if re.match(r"(?i)^with\s", final):
        return f"WITH {body},\n{final[4:].lstrip()}"
    return f"WITH {body}\n{final}"
