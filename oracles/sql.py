"""Helpers that write the DuckDB check queries.

The checks are written the naive way (self-joins over all earlier rows, plain
window frames); with the Spark side they share only the view texts of the base tables.
"""

from __future__ import annotations

import re

from foretally.plans.views import VIEWS

CTES: dict[str, str] = {k: re.sub(r"\{(\w+)\}", r"\1", v) for k, v in VIEWS.items()}


def cte(name: str, sql: str) -> str:
    CTES[name] = sql
    return name


def compose(sql: str) -> str:
    """Prefix the CTEs a statement needs, in dependency order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in order and re.search(rf"\b{name}\b", text):
                visit(CTES[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    if not order:
        return _marks(sql, True)
    return "with " + ",\n".join(f"{n} as ({_marks(CTES[n], False)})" for n in order) + "\n" + _marks(sql, True)


def h(x: str, n: int) -> str:
    return f"cast(round(cast({x} as decimal(38,9)), {n}) as double)"


def r(x: str) -> str:
    """Mark a value to be rounded to 6 digits when it is the result.

    Inside a CTE the mark is dropped, so later models work on exact values.
    """
    return f"r6({x})"


def _marks(sql: str, rounding: bool) -> str:
    while (i := sql.find("r6(")) >= 0:
        depth, j = 1, i + 3
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[j], 0)
            j += 1
        inner = sql[i + 3 : j - 1]
        sql = sql[:i] + (h(f"({inner})", 6) if rounding else f"({inner})") + sql[j:]
    return sql


def lit(v) -> str:
    if isinstance(v, bool):
        return str(v).lower()
    return repr(v)


def val(x: str, d) -> str:
    """Expression with default; doubles are rounded as the Spark side does."""
    c = x if d is None else f"coalesce({x}, {lit(d)})"
    return r(c) if isinstance(d, float) else c


IDS = "g.game_id, g.game_date, g.home_team_id, g.away_team_id"


def sides(feats: str, cols: dict, diffs: dict | None = None, base: str = "games", ids: str = IDS, extra: str = "", real=()) -> str:
    """home_/away_ columns from (game_id, is_home, ...) features."""
    out = []
    for s in ("home", "away"):
        for c, d in cols.items():
            x = val(f"{s[0]}.{c}", d)
            out.append(f"{r(x) if c in real else x} as {s}_{c}")
    for n, c in (diffs or {}).items():
        d = cols[c]
        hx, ax = (f"h.{c}", f"a.{c}") if d is None else (f"coalesce(h.{c}, {lit(d)})", f"coalesce(a.{c}, {lit(d)})")
        x = f"{hx} - {ax}"
        out.append(f"{r(x) if isinstance(d, float) or c in real else x} as {n}")
    return (f"select {ids}, {', '.join(out)}{extra} from {base} g left join {feats} h on h.game_id = g.game_id and h.is_home "
            f"left join {feats} a on a.game_id = g.game_id and not a.is_home")


def game(feats: str, cols: dict, base: str = "games", ids: str = IDS) -> str:
    out = ", ".join(f"{val('f.' + c, d)} as {c}" for c, d in cols.items())
    return f"select {ids}, {out} from {base} g left join {feats} f on f.game_id = g.game_id"


def hist(rows: str, aggs: dict[str, str], keys: list[str], days: int | None = None) -> str:
    """Aggregates of all earlier-day rows with the same keys, by self-join."""
    on = " and ".join(f"p.{k} is not distinct from a.{k}" for k in keys)
    on += " and p.game_date < a.game_date" + (f" and p.game_date >= a.game_date - {days}" if days else "")
    cols = ", ".join(f"{e} as {n}" for n, e in aggs.items())
    return f"select a.game_id, a.is_home, {cols} from {rows} a left join {rows} p on {on} group by a.game_id, a.is_home"


def last_n(probes: str, rows: str, n: int, aggs: dict[str, str], keys: list[str], more: str = "true") -> str:
    """Aggregates over the n latest rows of an earlier day, by self-join and rank."""
    on = " and ".join(f"p.{k} = a.{k}" for k in keys)
    cols = ", ".join(f"{e} as {c}" for c, e in aggs.items())
    return (f"select game_id, is_home, {cols} from (select a.game_id, a.is_home, p.* exclude (game_id, is_home), "
            f"row_number() over (partition by a.game_id, a.is_home order by p.game_date desc, p.game_id desc) as k "
            f"from {probes} a join {rows} p on {on} and p.game_date < a.game_date and {more}) where k <= {n} group by 1, 2")


def over(lo: int, hi: int, by: str = "team_id") -> str:
    def b(x):
        return "current row" if x == 0 else f"{-x} preceding"
    return f"over (partition by {by} order by game_date, game_id rows between {b(lo)} and {b(hi)})"


def split(prefix: str, cond: str, names=("win_pct", "game_count", "avg_point_diff")) -> dict[str, str]:
    a, b, c = names
    return {f"{prefix}{a}": f"avg(case when {cond} then p.is_win end)", f"{prefix}{b}": f"count(case when {cond} then 1 end)",
            f"{prefix}{c}": f"avg(case when {cond} then p.margin end)"}


def defaults(*ps: str) -> dict:
    out = {}
    for p in ps:
        out |= {f"{p}win_pct": 0.5, f"{p}game_count": 0, f"{p}avg_point_diff": 0.0}
    return out
