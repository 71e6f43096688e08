"""Values, win/draw/loss model, time allocation and other formulas over numbers, as SQL text that Spark and DuckDB share.

Divisions that truncate are written trunc_div(a, b) here and filled in per engine: Spark has `div`, DuckDB `//`.
"""

from __future__ import annotations

import re

MATE, MAX_PLY = 32000, 246
TB = MATE - MAX_PLY - 1
TB_WIN = TB - MAX_PLY
NONE = 32002
#: Cubics of the win-rate model over clamped material / 58.
WDL_A = (-72.32565836, 185.93832038, -144.58862193, 416.44950446)
WDL_B = (83.86794042, -136.06112997, 69.98820887, 47.62901433)


def engine(text: str, duck: bool) -> str:
    """trunc_div(a, b) in one engine's words. Arguments hold no comma outside parentheses of their own."""
    out, at = "", 0
    for m in re.finditer(r"trunc_div\(", text):
        if m.start() < at:
            continue
        depth, i, comma = 1, m.end(), None
        while depth:
            c = text[i]
            depth += (c == "(") - (c == ")")
            if c == "," and depth == 1:
                comma = i
            i += 1
        a, b = (engine(x.strip(), duck) for x in (text[m.end() : comma], text[comma + 1 : i - 1]))
        out += text[at : m.start()] + (f"(({a}) // ({b}))" if duck else f"(({a}) div ({b}))")
        at = i
    return out + text[at:]


def cubic(c: tuple[float, ...], m: str) -> str:
    return f"((({c[0]!r} * ({m}) + ({c[1]!r})) * ({m}) + ({c[2]!r})) * ({m}) + ({c[3]!r}))"


def material(p: str, n: str, b: str, r: str, q: str) -> str:
    """Material of both sides, clamped, over 58."""
    return f"(cast(least(78, greatest(17, {p} + 3 * {n} + 3 * {b} + 5 * {r} + 9 * {q})) as double) / cast(58 as double))"


def win_rate(v: str, a: str, b: str) -> str:
    """Per mille, by truncation."""
    return f"cast(floor(cast(0.5 as double) + cast(1000 as double) / (cast(1 as double) + exp((({a}) - ({v})) / ({b})))) as int)"


def centipawns(v: str, a: str) -> str:
    return f"cast(round(cast(100 as double) * ({v}) / ({a})) as int)"


def kind(v: str) -> str:
    """mate, tb or cp."""
    return f"CASE WHEN abs({v}) < {TB_WIN} THEN 'cp' WHEN abs({v}) <= {TB} THEN 'tb' ELSE 'mate' END"


def plies(v: str) -> str:
    """Signed plies of a decisive value; null of another."""
    return f"CASE WHEN abs({v}) < {TB_WIN} THEN NULL WHEN abs({v}) <= {TB} THEN CASE WHEN {v} > 0 THEN {TB} - ({v}) ELSE -{TB} - ({v}) END WHEN {v} > 0 THEN {MATE} - ({v}) ELSE -{MATE} - ({v}) END"


def score_text(v: str, a: str) -> str:
    p = plies(v)
    return f"""CASE WHEN abs({v}) < {TB_WIN} THEN concat('cp ', cast({centipawns(v, a)} as varchar(20)))
        WHEN abs({v}) <= {TB} THEN concat('cp ', cast(CASE WHEN {v} > 0 THEN 20000 - ({p}) ELSE -20000 - ({p}) END as varchar(20)))
        ELSE concat('mate ', cast(CASE WHEN {v} > 0 THEN trunc_div(({p}) + 1, 2) ELSE trunc_div({p}, 2) END as varchar(20))) END"""


def to_table(v: str, ply: str) -> str:
    """A value for a transposition table: distances count from the node."""
    return f"CASE WHEN {v} = {NONE} THEN {NONE} WHEN {v} >= {TB_WIN} THEN ({v}) + ({ply}) WHEN {v} <= -{TB_WIN} THEN ({v}) - ({ply}) ELSE {v} END"


def from_table(v: str, ply: str, rule50: str) -> str:
    """Back from the table; decisive values that the fifty-move count may spoil are lowered, no value stays none."""
    return f"""CASE WHEN {v} = {NONE} THEN {NONE} WHEN {v} >= {TB_WIN} THEN
            CASE WHEN {v} >= {MATE - MAX_PLY} AND {MATE} - ({v}) > 100 - ({rule50}) THEN {TB_WIN - 1}
                 WHEN {v} < {MATE - MAX_PLY} AND {TB} - ({v}) > 100 - ({rule50}) THEN {TB_WIN - 1} ELSE ({v}) - ({ply}) END
        WHEN {v} <= -{TB_WIN} THEN
            CASE WHEN {v} <= -{MATE - MAX_PLY} AND {MATE} + ({v}) > 100 - ({rule50}) THEN -{TB_WIN - 1}
                 WHEN {v} > -{MATE - MAX_PLY} AND {TB} + ({v}) > 100 - ({rule50}) THEN -{TB_WIN - 1} ELSE ({v}) + ({ply}) END
        ELSE {v} END"""


def final_eval(psqt: str, pos: str, optimism: str, mat: str, rule50: str) -> str:
    """Blend of a network's parts, scaled by material and damped by the fifty-move count; every division truncates."""
    c = f"abs(({psqt}) - ({pos}))"
    n0 = f"trunc_div(125 * ({psqt}) + 131 * ({pos}), 128)"
    o = f"(({optimism}) + trunc_div(({optimism}) * {c}, 476))"
    n = f"({n0} - trunc_div({n0} * {c}, 18236))"
    v = f"trunc_div({n} * (77871 + ({mat})) + {o} * (7191 + ({mat})), 77871)"
    return f"least({TB_WIN - 1}, greatest(-{TB_WIN - 1}, {v} - trunc_div({v} * ({rule50}), 199)))"
