"""Positions of few men as dense numbers, and what men attack, as SQL text over columns of squares.

A set of men is two kings and up to three others; its columns are wk, bk, m0, m1, ... and stm (0 white, 1 black). Boards that turn or
mirror into one another have the same number: without pawns all eight turns and mirrors, with a pawn the mirror of files. The kings
together take one of 462 codes, equal men take the rank of their set of squares among those that are free (a set x0 < x1 < ... of k
squares has rank C(x0, 1) + C(x1, 2) + ...), and the side to move is the last bit. Ranking and unranking are plain expressions, so a
table is an array in key order that any task can compute its part of.
"""

from __future__ import annotations

import json
from math import comb

from pyspark.sql import DataFrame

from . import kernel as Kn

ORDER = "QRBNP"
#: Bits of a key below the number of the set of men.
BITS = 40


def lookup(values: list[int]) -> str:
    """Whole numbers as an array that the planner folds into one literal."""
    return f"from_json('{json.dumps(values, separators=(',', ':'))}', 'array<bigint>')"


def taken(values: str, at: str) -> str:
    return f"element_at({values}, CAST({at} AS int) + 1)"


#: Squares of a file, and of the two directions of diagonals from the square that a shift moves them to.
FILE, RISING, FALLING = 0x0101010101010101, 0x8040201008040201 - (1 << 64), 0x8102040810204081 - (1 << 64)


def attacks(kind: str, color: int, s: str, t: str, occ: str) -> str:
    """Whether a man on s attacks t, another square, past the men in the bits occ. Plain arithmetic: a piece of plan without tables."""
    across, up = f"({t} % 8 - {s} % 8)", f"({t} div 8 - {s} div 8)"
    if kind == "P":
        return f"({up} = {1 if color == 0 else -1} AND abs({across}) = 1)"
    if kind == "N":
        return f"(abs({across} * {up}) = 2)"
    if kind == "K":
        return f"(greatest(abs({across}), abs({up})) = 1)"
    low, high = f"CAST(least({s}, {t}) AS int)", f"CAST(greatest({s}, {t}) AS int)"
    # men between the two squares in the order of squares
    inside = f"(({occ}) & shiftleft(-1L, {low} + 1) & ~shiftleft(-1L, {high}))"
    straight = [f"{up} = 0 AND {inside} = 0", f"{across} = 0 AND ({inside} & shiftleft({FILE}L, CAST({s} % 8 AS int))) = 0"]
    slanted = [f"{across} = {up} AND ({inside} & shiftleft({RISING}L, {low})) = 0", f"{across} = -{up} AND ({inside} & shiftleft({FALLING}L, {low})) = 0"]
    return "(" + " OR ".join(f"({x})" for x in (straight if kind == "R" else slanted if kind == "B" else straight + slanted)) + ")"


def bits(*squares: str) -> str:
    return "(" + " | ".join(f"shiftleft(1L, CAST({s} AS int))" for s in squares) + ")"


def _king_codes() -> tuple[list[int], list[tuple[int, int]]]:
    """By square in the triangle a1-d1-d4 (file by file) * 64 + bk the code or -1; by code the two squares. White's king stands in the
    triangle; if it stands on its diagonal, black's isn't above it."""
    codes, pairs = [], []
    for wk in (r * 8 + f for f in range(4) for r in range(f + 1)):
        for bk in range(64):
            good = bk != wk and bk not in Kn.KING[wk] and (wk // 8 != wk % 8 or bk // 8 <= bk % 8)
            codes.append(len(pairs) if good else -1)
            if good:
                pairs.append((wk, bk))
    return codes, pairs


def king_code(wk: str, bk: str) -> str:
    """The code of two kings, -1 if they touch or black's is above the diagonal; null unless white's is in the triangle."""
    at = f"({wk} % 8 * ({wk} % 8 + 1) div 2 + {wk} div 8)"
    return f"get({lookup(CODES)}, CAST(CASE WHEN {wk} % 8 < 4 AND {wk} div 8 <= {wk} % 8 THEN {at} * 64 + {bk} END AS int))"


CODES, PAIRS = _king_codes()


class Men:
    """A set of men beside the kings, white's first. pawns: at most one, and white's alone."""

    def __init__(self, white: str, black: str = ""):
        self.white, self.black = ("".join(sorted(x, key=ORDER.index)) for x in (white, black))
        self.kinds = [(k, 0) for k in self.white] + [(k, 1) for k in self.black]
        self.pawn = "P" in self.white
        if self.pawn and (self.white != "P" or self.black) or "P" in self.black:
            raise ValueError("of sets with pawns only a single white pawn is covered")
        self.name = f"K{self.white}vK{self.black}"
        self.columns = [f"m{i}" for i in range(len(self.kinds))]
        self.squares = ["wk", "bk", *self.columns]

    def groups(self) -> list[list[str]]:
        """Columns of equal men."""
        out: list[list[str]] = []
        for i, c in enumerate(self.columns):
            if i and self.kinds[i] == self.kinds[i - 1]:
                out[-1].append(c)
            else:
                out.append([c])
        return out

    def radices(self) -> list[int]:
        """Ranks of each group, in order; with a pawn those of the pawn and both kings."""
        if self.pawn:
            return [24, 63, 62]
        out, placed = [len(PAIRS)], 2
        for g in self.groups():
            out.append(comb(64 - placed, len(g)))
            placed += len(g)
        return out

    def size(self) -> int:
        n = 2
        for r in self.radices():
            n *= r
        return n

    # --- ranking

    def _less(self, x: str, placed: list[str]) -> str:
        return f"({x}" + "".join(f" - CAST({x} > {p} AS int)" for p in placed) + ")"

    def _ranks(self, name=lambda c: c) -> list[str]:
        wk, bk = name("wk"), name("bk")
        if self.pawn:
            p = name("m0")
            return [f"(({p} div 8 - 1) * 4 + {p} % 8)", self._less(wk, [p]), self._less(bk, [p, wk])]
        out, placed = [king_code(wk, bk)], [wk, bk]
        for g in self.groups():
            x = [self._less(name(c), placed) for c in g]
            if len(g) == 1:
                out.append(x[0])
            elif len(g) == 2:
                out.append(f"(greatest({x[0]}, {x[1]}) * (greatest({x[0]}, {x[1]}) - 1) div 2 + least({x[0]}, {x[1]}))")
            else:
                chosen = lookup([comb(n, k + 1) for k in range(len(g)) for n in range(64)])
                out.append(f"aggregate(transform(array_sort(array({', '.join(x)})), (v, i) -> {taken(chosen, '(i * 64 + v)')}), 0L, (a, v) -> a + v)")
            placed += [name(c) for c in g]
        return out

    def _number(self, name=lambda c: c) -> str:
        text = "0L"
        for rank, radix in zip(self._ranks(name), self.radices()):
            text = f"({text} * {radix} + {rank})"
        return f"({text} * 2 + stm)"

    def ranked(self, rows: DataFrame, code: int = 0, to: str = "key") -> DataFrame:
        """rows with the number of each position, code << BITS added; null where men share a square, kings touch or a pawn can't stand."""
        s = [f"_{c}" for c in self.squares]
        rest = rows.columns
        turned = rows.selectExpr("*", *[f"{c} AS _{c}" for c in self.squares])

        def turn(df: DataFrame, when: str, how) -> DataFrame:
            return df.selectExpr(*rest, *[f"CASE WHEN {when} THEN {how(c)} ELSE {c} END AS {c}" for c in s])

        across = lambda c: f"({c} % 8 * 8 + {c} div 8)"
        lead = "_m0" if self.pawn else "_wk"
        turned = turn(turned, f"{lead} % 8 > 3", lambda c: f"({c} ^ 7)")
        number = self._number(lambda c: f"_{c}")
        good = [f"{a} <> {b}" for i, a in enumerate(s) for b in s[i + 1 :]]
        if self.pawn:
            good += ["_m0 BETWEEN 8 AND 55", f"NOT {attacks('K', 0, '_wk', '_bk', '0L')}"]
        else:
            turned = turn(turned, "_wk div 8 > 3", lambda c: f"({c} ^ 56)")
            turned = turn(turned, "_wk div 8 > _wk % 8 OR _wk div 8 = _wk % 8 AND _bk div 8 > _bk % 8", across)
            # both kings on the diagonal: of the two mirrors the one with the smaller number
            mirrored = self._number(lambda c: across(f"_{c}") if c in self.columns else f"_{c}")
            number = f"CASE WHEN _wk div 8 = _wk % 8 AND _bk div 8 = _bk % 8 THEN least({number}, {mirrored}) ELSE {number} END"
            good.append(f"NOT {attacks('K', 0, '_wk', '_bk', '0L')}")
        return turned.selectExpr(*rest, f"CASE WHEN {' AND '.join(good)} THEN {code << BITS} + {number} END AS {to}")

    # --- unranking

    def placed(self, rows: DataFrame, key: str = "key") -> DataFrame:
        """rows (with a key) with the squares and stm of its position; keys of mirrors that have another number give that mirror."""
        radices = self.radices()
        rest = [c for c in rows.columns]
        rows = rows.selectExpr("*", f"CAST({key} & 1 AS int) AS stm", f"({key} & {(1 << BITS) - 1}) div 2 AS _n")
        for i in range(len(radices) - 1, -1, -1):
            rows = rows.selectExpr("* EXCEPT (_n)", f"CAST(_n % {radices[i]} AS int) AS _r{i}", f"_n div {radices[i]} AS _n")
        free = lambda x, placed: f"aggregate(array_sort(array({', '.join(placed)})), {x}, (a, p) -> a + CAST(a >= p AS int))"
        if self.pawn:
            rows = rows.selectExpr(*rest, "stm", "_r1", "_r2", "(_r0 div 4 + 1) * 8 + _r0 % 4 AS m0")
            rows = rows.selectExpr(*rest, "stm", "_r2", "m0", f"{free('_r1', ['m0'])} AS wk")
            return rows.selectExpr(*rest, "stm", "wk", f"{free('_r2', ['m0', 'wk'])} AS bk", "m0")
        got = [f"CAST({taken(lookup([p[k] for p in PAIRS]), '_r0')} AS int) AS {c}" for k, c in enumerate(("wk", "bk"))]
        rows = rows.selectExpr("* EXCEPT (_r0)", *got)
        have = ["wk", "bk"]
        for i, g in enumerate(self.groups(), 1):
            for k in range(len(g), 0, -1):  # from the largest square down
                if len(g) == 1:
                    x, left = f"_r{i}", "0"
                else:
                    chosen = lookup([comb(n, k) for n in range(64)])
                    x = f"(size(filter({chosen}, c -> c <= _r{i})) - 1)"
                    left = f"CAST(_r{i} - {taken(chosen, x)} AS int)"
                rows = rows.selectExpr(f"* EXCEPT (_r{i})", f"{x} AS _x{k}", f"{left} AS _r{i}")
            xs = [f"_x{k}" for k in range(1, len(g) + 1)]
            rows = rows.selectExpr(f"* EXCEPT ({', '.join(xs)})", *[f"{free(x, have)} AS {c}" for x, c in zip(xs, g)])
            have = have + g
        return rows.select(*rest, "stm", *self.squares)
