"""Building blocks of the checking SQL.

The checks use plain grouping and joins (one query per aggregate, then a join)
where the library works in one pass, so both ways must agree.
"""

from __future__ import annotations

import re
from importlib import import_module

from viewtally.plans.standins import STANDINS, check_sql, needs

SQL: dict[str, str] = {}
EXTRA: dict[str, str] = {}  # tables only the checks know
MODULES = (
    "base", "facts", "channels", "programs", "music", "live", "launcher", "logins", "users",
    "retention", "rollout", "quality", "crashes", "distributions", "identity", "streams", "stores",
)


def _body(name: str) -> tuple[str, list[str]]:
    if name in STANDINS:
        return check_sql(name), needs(STANDINS[name])
    text = EXTRA[name]
    return text, [n for n in (*STANDINS, *EXTRA) if n != name and re.search(rf"\b{n}\b", text)]


def check(name: str, sql: str) -> None:
    """Register the check of a report; used stand-ins become CTEs."""
    if name in SQL:
        raise ValueError(f"check {name} exists")
    done: list[str] = []

    def add(table: str) -> None:
        if table in done or (table not in STANDINS and table not in EXTRA):
            return
        for other in _body(table)[1]:
            add(other)
        done.append(table)

    for table in (*STANDINS, *EXTRA):
        if re.search(rf"\b(FROM|JOIN|from|join)\s+{table}\b", sql):
            add(table)
    head = ", ".join(f"{t} AS ({_body(t)[0]})" for t in done)
    if head and re.match(r"\s*WITH\s", sql):
        sql = re.sub(r"^\s*WITH\s", "", sql, count=1)
        SQL[name] = f"WITH {head}, {sql}"
    else:
        SQL[name] = f"WITH {head} {sql}" if head else sql


def _keys(keys) -> list[tuple[str, str]]:
    """(expression, alias) pairs; ``day`` and ``datetime`` come out as text."""
    out = []
    for k in [keys] if isinstance(keys, str) else keys:
        m = re.match(r"^(.*)\s+AS\s+(\w+)$", k, re.S)
        expr, alias = (m.group(1), m.group(2)) if m else (k, k)
        if alias == "day" and expr == "day":
            expr = "CAST(day AS VARCHAR)"
        out.append((expr, alias))
    return out


def select_keys(keys) -> str:
    return "".join(f"{e} AS {a}, " for e, a in _keys(keys))


def names(keys) -> list[str]:
    return [a for _, a in _keys(keys)]


def group_by(keys) -> str:
    n = len(_keys(keys))
    return " GROUP BY " + ", ".join(str(i + 1) for i in range(n)) if n else ""


def where(*conditions: str | None) -> str:
    kept = [f"({c})" for c in conditions if c]
    return " WHERE " + " AND ".join(kept) if kept else ""


def pv_uv(table: str, keys=(), cond: str | None = None, user: str = "userId", pv: str = "pv", uv: str = "uv") -> str:
    return (
        f"SELECT {select_keys(keys)}count({user}) AS {pv}, count(DISTINCT {user}) AS {uv} "
        f"FROM {table}{where(cond)}{group_by(keys)}"
    )


def pv_uv_null(table: str, keys=(), cond: str | None = None, user: str = "userId", pv="pv", uv="uv") -> str:
    """All rows; the missing user is one more user."""
    return (
        f"SELECT {select_keys(keys)}count(*) AS {pv}, count(DISTINCT {user}) + max(CASE WHEN {user} IS NULL THEN 1 ELSE 0 END) AS {uv} "
        f"FROM {table}{where(cond)}{group_by(keys)}"
    )


START = "event IN ('startplay', 'playview')"


def on(left: str, right: str, keys) -> str:
    joined = [f"{left}.{n} IS NOT DISTINCT FROM {right}.{n}" for n in names(keys)]
    return " AND ".join(joined) if joined else "TRUE"


def duration(
    table: str, keys=(), cond=None, start: str = START, rows: str = "event <> 'startplay'", low=0, high=10800,
    avg: str | None = None, digits: int | None = None, dur_users: str | None = None, how: str = "inner", dur: str = "duration",
    user: str = "userId", pick: str | None = None, null_dur: bool = False,
) -> str:
    """Starts and durations as two aggregates joined on the keys."""
    value = f"coalesce({dur}, 0)" if null_dur else dur
    bounds = " AND ".join(x for x in [f"{value} >= {low}" if low is not None else "", f"{value} <= {high}" if high is not None else "", f"{value} IS NOT NULL"] if x)
    shown = "".join(f"s.{n}, " for n in names(keys))
    extra = ""
    if avg:
        ratio = "d.duration / NULLIF(s.uv, 0)"
        extra += f", {ratio if digits is None else f'round({ratio}, {digits})'} AS {avg}"
    if dur_users:
        extra += f", d.du AS {dur_users}"
    kind = {"inner": "JOIN", "left": "LEFT JOIN"}[how]
    body = (
        f"SELECT {shown}s.pv, s.uv, CAST(d.duration AS BIGINT) AS duration{extra} FROM "
        f"({pv_uv(table, keys, ' AND '.join(f'({c})' for c in (cond, start) if c), user)}) s {kind} "
        f"(SELECT {select_keys(keys)}sum({value}) AS duration, count(DISTINCT {user}) AS du FROM {table}"
        f"{where(cond, rows, bounds)}{group_by(keys)}{'' if names(keys) else ' HAVING count(*) > 0'}) d ON {on('s', 'd', keys)}"
    )
    return body if pick is None else f"SELECT {pick} FROM ({body})"


def side_by_side(parts: dict[str, str], keys, how: str = "full", default: int | None = 0) -> str:
    """Aggregates (name -> SELECT with the keys and that column) joined."""
    first, *rest = parts
    kn = names(keys)
    sql = parts[first]
    have = [first]
    for part in rest:
        kind = {"full": "FULL JOIN", "inner": "JOIN", "left": "LEFT JOIN"}[how]
        shown = "".join(f"coalesce(a.{n}, b.{n}) AS {n}, " for n in kn)
        sql = (
            f"SELECT {shown}{', '.join(f'a.{h}' for h in have)}, b.{part} FROM ({sql}) a {kind} ({parts[part]}) b "
            f"ON {on('a', 'b', keys)}"
        )
        have.append(part)
    cols = ", ".join(f"coalesce({h}, {default}) AS {h}" if default is not None else h for h in have)
    return f"SELECT {''.join(n + ', ' for n in kn)}{cols} FROM ({sql})"


def current(table: str) -> str:
    return f"(SELECT * FROM {table} WHERE dim_invalid_time IS NULL)"


def one_per_key(table: str, key: str, value: str, name: str | None = None, valid: bool = True) -> str:
    """Largest value per key of the current rows."""
    cond = " WHERE dim_invalid_time IS NULL" if valid else ""
    return f"(SELECT {key}, max({value}) AS {name or value} FROM {table}{cond} GROUP BY 1)"


def load() -> dict[str, str]:
    for module in MODULES:
        import_module(f"oracles.{module}")
    return SQL
