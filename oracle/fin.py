"""Final-projection helper for oracle SQL.

``fin("b_security", "$latest_close_price, ~_sources_in_conflict")`` produces
``SELECT * REPLACE (CAST(latest_close_price AS DOUBLE) AS latest_close_price,
array_to_string(_sources_in_conflict, ',') AS _sources_in_conflict) FROM b_security``.
Markers: ``$`` DOUBLE, ``#`` BIGINT, ``~`` list -> comma string, ``@`` DATE.
"""

from __future__ import annotations


def _cast(c: str) -> tuple[str, str]:
    n = c[1:]
    if c[0] == "$":
        return n, f"CAST({n} AS DOUBLE)"
    if c[0] == "#":
        return n, f"CAST({n} AS BIGINT)"
    if c[0] == "~":
        return n, f"array_to_string({n}, ',')"
    if c[0] == "@":
        return n, f"CAST({n} AS DATE)"
    raise ValueError(c)


def fin(source: str, casts: str = "", where: str = "", exclude: str = "") -> str:
    items = [c.strip() for c in casts.split(",") if c.strip()]
    star = "*"
    if exclude:
        star += f" EXCLUDE ({exclude})"
    if items:
        star += " REPLACE (" + ", ".join(f"{e} AS {n}" for n, e in map(_cast, items)) + ")"
    sql = f"SELECT {star} FROM {source}"
    if where:
        sql += f" WHERE {where}"
    return sql
