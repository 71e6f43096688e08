"""Attacks, pins, legal moves, making moves and counting trees, as expressions over one row a position.

Nothing is joined or shuffled to generate moves: a position explodes into its pieces, the pieces' rays are constants of the
plan, and blockers are read off the position's own board text. Legality looks at the board after the move, again by rays
from the king. Trees are counted by a loop over plies in which equal states are merged with their multiplicity.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import board as B
from ..functions import kernel as Kn
from ..operators.rows import rows_of, spread
from ..sources import corpus as C

STATE = ("board", "stm", "wk", "wq", "bk", "bq", "ep")

def _dim(rows: list, kind: str) -> str:
    """A constant as SQL text: folded into one literal when the plan is made."""
    return f"from_json('{json.dumps(rows, separators=(',', ':'))}', '{kind}')"


#: By square: arrays of squares (leapers, pawns by colour) and of rays, nearest square first.
KNIGHT = _dim([list(x) for x in Kn.KNIGHT], "array<array<int>>")
KING = _dim([list(x) for x in Kn.KING], "array<array<int>>")
PAWN = [_dim([list(x) for x in side], "array<array<int>>") for side in Kn.PAWN]
SLANTED = _dim([[list(Kn.RAYS[s][d]) for d in Kn.SLANTED] for s in range(64)], "array<array<array<int>>>")
STRAIGHT = _dim([[list(Kn.RAYS[s][d]) for d in Kn.STRAIGHT] for s in range(64)], "array<array<array<int>>>")


def at(dim: str, sq: str) -> str:
    return f"element_at({dim}, cast({sq} as int) + 1)"


def cell(board: str, sq: str) -> str:
    return f"substr({board}, {sq} + 1, 1)"


def attacked(board: str, sq: str, by: str) -> str:
    """SQL text: whether a piece of colour `by` (0, 1) attacks the square, on a board text."""
    own = lambda c: f"CASE WHEN {by} = 0 THEN '{c}' ELSE '{c.lower()}' END"
    near = lambda squares, c: f"exists({squares}, t -> {cell(board, 't')} = {own(c)})"
    first = lambda r: f"left(ltrim('.', array_join(transform({r}, t -> {cell(board, 't')}), '')), 1)"
    line = lambda dim, c: f"exists({at(dim, sq)}, r -> {first('r')} IN ({own(c)}, {own('Q')}))"
    pawns = f"CASE WHEN {by} = 0 THEN {at(PAWN[1], sq)} ELSE {at(PAWN[0], sq)} END"
    return f"({near(at(KNIGHT, sq), 'N')} OR {near(at(KING, sq), 'K')} OR {near(pawns, 'P')} OR {line(SLANTED, 'B')} OR {line(STRAIGHT, 'R')})"


def reach(board: str, sq: str, kind: str) -> str:
    """SQL text: the squares that a piece (upper-case letter, no pawn) attacks, whatever stands on them."""
    upto = f"r -> slice(r, 1, CASE WHEN exists(r, t -> {cell(board, 't')} <> '.') THEN array_position(transform(r, t -> {cell(board, 't')} <> '.'), true) ELSE size(r) END)"
    rays = lambda dim: f"flatten(transform({at(dim, sq)}, {upto}))"
    return f"CASE {kind} WHEN 'N' THEN {at(KNIGHT, sq)} WHEN 'K' THEN {at(KING, sq)} WHEN 'B' THEN {rays(SLANTED)} WHEN 'R' THEN {rays(STRAIGHT)} WHEN 'Q' THEN concat({rays(SLANTED)}, {rays(STRAIGHT)}) END"


def pseudo(positions: DataFrame, *keep: str) -> DataFrame:
    """A row a pseudo-legal move: the kept columns and state, frm, dest, promo (letter or null), kind (see the kernel)."""
    p = positions.select(*keep, *STATE, F.explode(F.sequence(F.lit(0), F.lit(63))).alias("frm")).withColumn("ch", F.expr(cell("board", "frm")))
    p = p.where("ch <> '.' AND (ch = upper(ch)) = (stm = 0)")
    free = lambda t: f"{cell('board', t)} = '.'"
    foe = lambda t: f"({cell('board', t)} <> '.' AND ({cell('board', t)} = upper({cell('board', t)})) <> (stm = 0))"
    up = "CASE WHEN stm = 0 THEN 8 ELSE -8 END"
    side = lambda d: f"CASE WHEN frm % 8 + {d} BETWEEN 0 AND 7 THEN frm + {up} + {d} END"
    # a move is dest + 64 * kind + 512 * promotion (0 for none)
    pawn = f"""filter(array(CASE WHEN {free(f'(frm + {up})')} THEN frm + {up} END,
        CASE WHEN frm div 8 = CASE WHEN stm = 0 THEN 1 ELSE 6 END AND {free(f'(frm + {up})')} AND {free(f'(frm + 2 * {up})')} THEN frm + 2 * {up} END,
        CASE WHEN {foe(f'({side(-1)})')} OR {side(-1)} = ep THEN {side(-1)} END, CASE WHEN {foe(f'({side(1)})')} OR {side(1)} = ep THEN {side(1)} END), x -> x IS NOT NULL)"""
    fan = "flatten(transform(tos, x -> CASE WHEN x div 8 IN (0, 7) THEN transform(array(4, 3, 2, 1), q -> x + 64 + 512 * q) WHEN x <=> ep AND x % 8 <> frm % 8 THEN array(x + 128) ELSE array(x) END))"
    piece = f"filter({reach('board', 'frm', 'upper(ch)')}, x -> {free('x')} OR {foe('x')})"
    # castling: king takes own rook; what lies between the two and their places is empty
    place = lambda k, short, long: f"(frm div 8 * 8 + CASE WHEN {k} > frm THEN {short} ELSE {long} END)"
    clear = f"""forall(concat(sequence(least(frm, cast({place('k', 6, 2)} as int)), greatest(frm, cast({place('k', 6, 2)} as int))),
        sequence(least(k, cast({place('k', 5, 3)} as int)), greatest(k, cast({place('k', 5, 3)} as int)))), t -> t = frm OR t = k OR {free('t')})"""
    castles = f"transform(filter(CASE WHEN stm = 0 THEN array(wk, wq) ELSE array(bk, bq) END, k -> k IS NOT NULL AND {clear}), k -> cast(k + 192 as int))"
    p = p.withColumn("tos", F.expr(f"CASE WHEN upper(ch) = 'P' THEN {pawn} ELSE {piece} END"))
    codes = f"CASE upper(ch) WHEN 'P' THEN {fan} WHEN 'K' THEN concat(tos, {castles}) ELSE tos END"
    p = p.select(*keep, *STATE, "frm", F.explode(F.expr(codes)).alias("m"))
    return p.selectExpr(*keep, *STATE, "frm", "m % 64 AS dest", "CASE WHEN m >= 512 THEN substr('nbrq', m div 512, 1) END AS promo", "cast(m % 512 div 64 as int) AS kind")


AFTER = """
    CASE WHEN kind = 3 THEN overlay(overlay(overlay(overlay(board PLACING '.' FROM frm + 1 FOR 1) PLACING '.' FROM dest + 1 FOR 1)
              PLACING CASE WHEN stm = 0 THEN 'K' ELSE 'k' END FROM cast(frm div 8 * 8 + CASE WHEN dest > frm THEN 7 ELSE 3 END as int) FOR 1)
              PLACING CASE WHEN stm = 0 THEN 'R' ELSE 'r' END FROM cast(frm div 8 * 8 + CASE WHEN dest > frm THEN 6 ELSE 4 END as int) FOR 1)
         WHEN kind = 2 THEN overlay(overlay(overlay(board PLACING '.' FROM frm + 1 FOR 1) PLACING substr(board, frm + 1, 1) FROM dest + 1 FOR 1)
              PLACING '.' FROM cast(frm div 8 * 8 + dest % 8 + 1 as int) FOR 1)
         ELSE overlay(overlay(board PLACING '.' FROM frm + 1 FOR 1)
              PLACING CASE WHEN promo IS NULL THEN substr(board, frm + 1, 1) WHEN stm = 0 THEN upper(promo) ELSE promo END FROM dest + 1 FOR 1) END"""


def once(rows: DataFrame, **made: str) -> DataFrame:
    """rows with more columns, by a generator of one row: the planner doesn't repeat their expressions in filters and lambdas above."""
    return rows.selectExpr("*", f"inline(array(struct({', '.join(f'{text} AS {c}' for c, text in made.items())})))")


def legal(positions: DataFrame, *keep: str) -> DataFrame:
    """The pseudo-legal moves after which the mover's king isn't attacked, with the board after them.

    A castling king neither leaves nor crosses an attacked square. Where the king isn't in check, a man that stands on no line with it can't
    uncover it, so only other moves, and en passant, are looked at on the board after them.
    """
    king = "instr(board, CASE WHEN stm = 0 THEN 'K' ELSE 'k' END) - 1"
    p = once(positions, _own=king)
    p = once(p, _checked=attacked("board", "_own", "(1 - stm)"))
    m = once(once(pseudo(p, *keep, "_own", "_checked"), after=AFTER), ksq="instr(after, CASE WHEN stm = 0 THEN 'K' ELSE 'k' END) - 1")
    across, up = "abs(frm % 8 - _own % 8)", "abs(frm div 8 - _own div 8)"
    apart = f"NOT _checked AND kind NOT IN ({Kn.EN_PASSANT}, {Kn.CASTLING}) AND {across} <> 0 AND {up} <> 0 AND {across} <> {up}"
    crossed = f"exists(sequence(least(frm, ksq), greatest(frm, ksq)), o -> {attacked('board', 'o', '(1 - stm)')})"
    return m.where(f"({apart}) OR NOT {attacked('after', 'ksq', '(1 - stm)')}").where(f"kind <> {Kn.CASTLING} OR NOT {crossed}").drop("ksq", "_own", "_checked")


def successors(moves: DataFrame, *keep: str) -> DataFrame:
    """The state after each legal move. En passant is kept if a capture of it would be legal."""
    clear = lambda c, king: f"CASE WHEN {c} IN (frm, dest) OR {cell('board', 'frm')} = '{king}' THEN NULL ELSE {c} END AS {c}"
    double = f"CASE WHEN upper({cell('board', 'frm')}) = 'P' AND abs(dest - frm) = 16 THEN cast((frm + dest) div 2 as int) END AS ep"
    s = moves.selectExpr(*keep, "after AS board", "1 - stm AS stm", clear("wk", "K"), clear("wq", "K"), clear("bk", "k"), clear("bq", "k"), double)
    mine = "CASE WHEN stm = 0 THEN 'P' ELSE 'p' END"
    ksq = "(instr(board, CASE WHEN stm = 0 THEN 'K' ELSE 'k' END) - 1)"
    takers = f"filter(CASE WHEN stm = 0 THEN {at(PAWN[1], 'ep')} ELSE {at(PAWN[0], 'ep')} END, t -> {cell('board', 't')} = {mine})"
    taken = f"overlay(overlay(overlay(board PLACING '.' FROM x + 1 FOR 1) PLACING {mine} FROM ep + 1 FOR 1) PLACING '.' FROM ep + CASE WHEN stm = 0 THEN -7 ELSE 9 END FOR 1)"
    safe = f"exists(transform({takers}, x -> {taken}), y -> NOT {attacked('y', ksq, '(1 - stm)')})"
    return s.withColumn("ep", F.expr(f"CASE WHEN ep IS NOT NULL AND {safe} THEN ep END"))


def perft(positions: DataFrame, depth: int, spread: int | None = None, cut: bool = False) -> DataFrame:
    """id, root, leaves: the legal move sequences of `depth` plies below each root move. positions: id and state.

    cut: write each ply's states to the checkpoint folder, for deep trees. Equal states of one root are merged with their multiplicity before they are expanded; the last ply is only counted.
    """
    level = legal(positions, "id") if depth else None
    root = F.concat(F.expr("concat(char(97 + frm % 8), char(49 + frm div 8), char(97 + dest % 8), char(49 + dest div 8))"), F.coalesce("promo", F.lit("")))
    level = level.withColumn("root", root).withColumn("times", F.lit(1).cast("long"))
    for _ in range(depth - 1):
        states = successors(level, "id", "root", "times").groupBy("id", "root", *STATE).agg(F.sum("times").alias("times"))
        if spread:
            states = states.repartition(spread)
        level = legal(states.checkpoint() if cut else states, "id", "root", "times")
    return level.groupBy("id", "root").agg(F.sum("times").alias("leaves"))


def perft_positions(spark: SparkSession, deep: bool = False) -> DataFrame:
    rows = [(i, f) for i, f, *_ in (C.PERFT_DEEP if deep else C.PERFT)]
    return B.parse(spark.createDataFrame(rows, "id int, fen string"))


def move_text(chess960: str = "chess960") -> str:
    to = f"CASE WHEN kind = 3 AND NOT {chess960} THEN frm div 8 * 8 + CASE WHEN dest > frm THEN 6 ELSE 2 END ELSE dest END"
    return f"concat({B.square_text('frm')}, {B.square_text(to)}, coalesce(promo, ''))"


def raw_move() -> str:
    """SQL text: 16 bits: to, from << 6, promotion - 2 << 12, kind << 14."""
    return "cast(dest + frm * 64 + coalesce(instr('nbrq', promo) - 1, 0) * 4096 + kind * 16384 as int)"


def attack_rows(positions: DataFrame, *keep: str) -> DataFrame:
    """the kept columns, frm, ch, color and dest: every square that a piece attacks, whatever stands there."""
    p = positions.select(*keep, "board", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("frm")).withColumn("ch", F.expr(cell("board", "frm"))).where("ch <> '.'")
    p = p.withColumn("color", F.expr("CASE WHEN ch = upper(ch) THEN 0 ELSE 1 END"))
    tos = f"CASE ch WHEN 'P' THEN {at(PAWN[0], 'frm')} WHEN 'p' THEN {at(PAWN[1], 'frm')} ELSE {reach('board', 'frm', 'upper(ch)')} END"
    return p.select(*keep, "frm", "ch", "color", F.explode(F.expr(tos)).alias("dest"))


def pins(positions: DataFrame, *keep: str) -> DataFrame:
    """color of a king, the only piece between it and an enemy slider (blocker), and that slider (pinner)."""
    p = positions.select(*keep, "board", F.explode(F.array(F.lit(0), F.lit(1))).alias("color")).withColumn("ksq", F.expr("instr(board, CASE WHEN color = 0 THEN 'K' ELSE 'k' END) - 1"))
    rows = [(s, kind, list(Kn.RAYS[s][d])) for s in range(64) for kind, ds in (("B", Kn.SLANTED), ("R", Kn.STRAIGHT)) for d in ds if Kn.RAYS[s][d]]
    rays = positions.sparkSession.createDataFrame(rows, "ksq int, kind string, ray array<int>")
    p = p.join(F.broadcast(rays), "ksq").withColumn("men", F.expr("filter(ray, t -> substr(board, t + 1, 1) <> '.')")).where("size(men) > 1")
    p = p.withColumn("blocker", F.expr("get(men, 0)")).withColumn("pinner", F.expr("get(men, 1)")).withColumn("x", F.expr("substr(board, pinner + 1, 1)"))
    return p.where("(x = upper(x)) <> (color = 0) AND upper(x) IN (kind, 'Q')").select(*keep, "color", "blocker", "pinner")


# --- queries -----------------------------------------------------------------------------------------------------------


def answered(spark: SparkSession, sf_dir: str, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """work(parsed positions) for each order, each distinct position once."""
    return C.answered(spark, sf_dir, lambda positions: work(B.parse(positions)))


def legal_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All legal moves of the corpus with text, code, capture flags and the board after them."""
    return answered(spark, sf_dir, lambda p: legal(p, "pos_id", "chess960").selectExpr(
        "pos_id", f"{move_text()} AS uci", f"{raw_move()} AS raw", "kind", "substr(board, dest + 1, 1) <> '.' AND kind <> 3 OR kind = 2 AS is_capture",
        "(substr(board, dest + 1, 1) <> '.' AND kind <> 3) OR kind = 2 OR coalesce(promo, '') = 'q' AS capture_stage", "after",
    ))


def pseudo_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-legal moves of each position by kind and promotion."""

    def work(p: DataFrame) -> DataFrame:
        m = pseudo(p, "pos_id").selectExpr("pos_id", "kind", "coalesce(promo, '-') AS promo", "substr(board, dest + 1, 1) <> '.' AND kind <> 3 OR kind = 2 AS is_capture")
        return m.groupBy("pos_id", "kind", "promo", "is_capture").agg(F.count(F.lit(1)).alias("moves"))

    return answered(spark, sf_dir, work)


def attacked_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """how many pieces of each colour attack each square of each position."""

    def work(p: DataFrame) -> DataFrame:
        rows = attack_rows(p, "pos_id").groupBy("pos_id", F.col("dest").alias("sq"))
        return rows.agg(F.count(F.when(F.col("color") == 0, 1)).alias("by_white"), F.count(F.when(F.col("color") == 1, 1)).alias("by_black"))

    return answered(spark, sf_dir, work)


def pin_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """blockers and pinners of both kings."""
    return answered(spark, sf_dir, lambda p: pins(p, "pos_id"))


def checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legal moves, those that give check, whether the side to move is in check, and mate or stalemate."""
    return answered(spark, sf_dir, checked)


def checked(base: DataFrame) -> DataFrame:
    """The same of parsed positions with pos_id."""
    m = once(legal(base, "pos_id"), foe="instr(after, CASE WHEN stm = 0 THEN 'k' ELSE 'K' END) - 1")
    line = lambda s: f"(({s} - foe) % 8 = 0 OR {s} div 8 = foe div 8 OR abs({s} % 8 - foe % 8) = abs({s} div 8 - foe div 8))"
    leap = "abs((dest % 8 - foe % 8) * (dest div 8 - foe div 8)) = 2"
    # a man that neither left nor reached a line of the king, nor is a leap away, gives no check
    may = f"({line('frm')} OR {line('dest')} OR {leap} OR kind IN ({Kn.EN_PASSANT}, {Kn.CASTLING}))"
    m = m.withColumn("gives", F.expr(f"{may} AND {attacked('after', 'foe', 'stm')}")).groupBy("pos_id").agg(F.count(F.lit(1)).alias("moves"), F.count(F.when(F.col("gives"), 1)).alias("checks"))
    king = "(instr(board, CASE WHEN stm = 0 THEN 'K' ELSE 'k' END) - 1)"
    now = base.select("pos_id", F.expr(attacked("board", king, "(1 - stm)")).alias("in_check"))
    out = now.join(m, "pos_id", "left").selectExpr("pos_id", "in_check", "coalesce(moves, 0L) AS moves", "coalesce(checks, 0L) AS checks")
    return out.withColumn("state", F.expr("CASE WHEN moves > 0 THEN 'open' WHEN in_check THEN 'mate' ELSE 'stalemate' END"))


def made_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States after each legal move of the corpus, summed up by position, and after passing."""
    return answered(spark, sf_dir, made)


def made(positions: DataFrame) -> DataFrame:
    """The same of parsed positions with pos_id."""
    s = successors(legal(positions, "pos_id"), "pos_id")
    return s.groupBy("pos_id", "stm").agg(F.count(F.lit(1)).alias("states"), F.countDistinct("board").alias("boards"), F.count("ep").alias("with_ep"), F.count("wk").alias("wk"), F.count("wq").alias("wq"), F.count("bk").alias("bk"), F.count("bq").alias("bq"))


def perft_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves of the known trees that are run: two plies by the relational generator, which spreads a tree over all tasks, the
    rest of each state by the kernel."""
    rows = B.parse(spark.createDataFrame([(i, f, d) for i, f, d, *_ in C.PERFT], "id int, fen string, depth int"))
    states = successors(legal(rows, "id", "depth"), "id", "depth").groupBy("id", "depth", *STATE).agg(F.count(F.lit(1)).alias("times"))
    states = successors(legal(states, "id", "depth", "times"), "id", "depth", "times").groupBy("id", "depth", *STATE).agg(F.sum("times").alias("times"))
    return below(states.withColumn("left", F.col("depth") - 2)).groupBy("id").agg(F.sum("leaves").alias("leaves"))


def below(states: DataFrame) -> DataFrame:
    """id, leaves below each state (id, state, times, left: plies)."""
    def work(r: dict) -> list:
        rooks = {right: r[c] for right, c in ((1, "wk"), (2, "wq"), (4, "bk"), (8, "bq")) if r[c] is not None}
        b = Kn.Board([Kn.CODES.get(c, 0) for c in r["board"]], r["stm"], rooks, r["ep"])
        return [(r["id"], r["times"] * Kn.perft(b, r["left"]))]

    return rows_of(spread(states, 8), "id int, leaves long", work)


def perft_divide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves below each root move of the deeper positions at two plies."""
    return perft(perft_positions(spark, deep=True), 2)


#: DuckDB relations over pos and pieces that share nothing with the expressions above: rays, occupancy and windows.
DUCK_MOVES = """, sqs AS (SELECT CAST(unnest(range(64)) AS INTEGER) AS s), dirs AS (SELECT * FROM (VALUES (1,0,'R'),(-1,0,'R'),(0,1,'R'),(0,-1,'R'),(1,1,'B'),(1,-1,'B'),(-1,1,'B'),(-1,-1,'B')) d(dx, dy, kind)),
ray AS (SELECT s AS frm, dx, dy, kind, n AS step, s + n * dx + 8 * n * dy AS too FROM sqs, dirs, (SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS n) WHERE s % 8 + n * dx BETWEEN 0 AND 7 AND s // 8 + n * dy BETWEEN 0 AND 7),
leap AS (SELECT 2 AS ptype, a.s AS frm, b.s AS too FROM sqs a, sqs b WHERE abs(a.s % 8 - b.s % 8) * abs(a.s // 8 - b.s // 8) = 2
   UNION ALL SELECT 6, a.s, b.s FROM sqs a, sqs b WHERE greatest(abs(a.s % 8 - b.s % 8), abs(a.s // 8 - b.s // 8)) = 1),
pawnhit AS (SELECT c AS color, a.s AS frm, b.s AS too FROM sqs a, sqs b, (SELECT unnest([0, 1]) AS c) WHERE abs(a.s % 8 - b.s % 8) = 1 AND b.s // 8 - a.s // 8 = CASE WHEN c = 0 THEN 1 ELSE -1 END),
walk AS (SELECT p.pos_id, p.stm, p.sq AS frm, p.ch, p.color, r.dx, r.dy, r.step, r.too, o.ch AS hit, o.color AS hit_color,
            min(CASE WHEN o.ch IS NOT NULL THEN r.step END) OVER (PARTITION BY p.pos_id, p.sq, r.dx, r.dy) AS stop
         FROM pieces p JOIN ray r ON r.frm = p.sq AND (p.ptype = 5 OR (p.ptype = 3 AND r.kind = 'B') OR (p.ptype = 4 AND r.kind = 'R')) LEFT JOIN pieces o ON o.pos_id = p.pos_id AND o.sq = r.too),
att AS (SELECT pos_id, stm, frm, ch, color, too FROM walk WHERE stop IS NULL OR step <= stop
   UNION ALL SELECT p.pos_id, p.stm, p.sq, p.ch, p.color, l.too FROM pieces p JOIN leap l ON l.ptype = p.ptype AND l.frm = p.sq
   UNION ALL SELECT p.pos_id, p.stm, p.sq, p.ch, p.color, h.too FROM pieces p JOIN pawnhit h ON p.ptype = 1 AND h.color = p.color AND h.frm = p.sq),
steps AS (SELECT p.pos_id, p.sq AS frm, p.sq + (CASE WHEN p.color = 0 THEN 8 ELSE -8 END) * n AS too, n, p.color FROM pieces p, (SELECT unnest([1, 2]) AS n) WHERE p.ptype = 1 AND p.color = p.stm AND (n = 1 OR p.sq // 8 = CASE WHEN p.color = 0 THEN 1 ELSE 6 END)),
push AS (SELECT s.* FROM steps s WHERE NOT EXISTS (SELECT 1 FROM pieces o WHERE o.pos_id = s.pos_id AND o.sq IN (s.too, CASE WHEN s.color = 0 THEN s.frm + 8 ELSE s.frm - 8 END))),
raw_ AS (SELECT a.pos_id, a.stm, a.frm, a.too AS dest, upper(a.ch) AS t, CASE WHEN upper(a.ch) = 'P' AND o.ch IS NULL THEN 2 ELSE 0 END AS kind FROM att a LEFT JOIN pieces o ON o.pos_id = a.pos_id AND o.sq = a.too JOIN pos q ON q.pos_id = a.pos_id
         WHERE a.color = a.stm AND (o.color IS NULL OR o.color <> a.stm) AND (upper(a.ch) <> 'P' OR o.ch IS NOT NULL OR a.too = q.ep)
   UNION ALL SELECT p.pos_id, p.color, p.frm, p.too, 'P', 0 FROM push p),
cast_ AS (SELECT q.pos_id, q.stm, k.sq AS frm, r.sq AS dest, 'K' AS t, 3 AS kind, k.sq // 8 * 8 + CASE WHEN r.sq > k.sq THEN 6 ELSE 2 END AS kt, k.sq // 8 * 8 + CASE WHEN r.sq > k.sq THEN 5 ELSE 3 END AS rt
          FROM pos q JOIN pieces k ON k.pos_id = q.pos_id AND k.ptype = 6 AND k.color = q.stm JOIN pieces r ON r.pos_id = q.pos_id AND r.sq IN (CASE WHEN q.stm = 0 THEN q.wk ELSE q.bk END, CASE WHEN q.stm = 0 THEN q.wq ELSE q.bq END)),
castok AS (SELECT * FROM cast_ c WHERE NOT EXISTS (SELECT 1 FROM pieces o WHERE o.pos_id = c.pos_id AND o.sq NOT IN (c.frm, c.dest) AND (o.sq BETWEEN least(c.frm, c.kt) AND greatest(c.frm, c.kt) OR o.sq BETWEEN least(c.dest, c.rt) AND greatest(c.dest, c.rt)))),
pm AS (SELECT row_number() OVER () AS mid, m.* FROM (
   SELECT pos_id, stm, frm, dest, kind, CASE WHEN t = 'P' AND dest // 8 IN (0, 7) THEN unnest(['q', 'r', 'b', 'n']) END AS promo, t, NULL AS kt, NULL AS rt FROM raw_ WHERE t = 'P' AND dest // 8 IN (0, 7)
   UNION ALL SELECT pos_id, stm, frm, dest, kind, NULL, t, NULL, NULL FROM raw_ WHERE NOT (t = 'P' AND dest // 8 IN (0, 7))
   UNION ALL SELECT pos_id, stm, frm, dest, kind, NULL, t, kt, rt FROM castok) m),
pmk AS (SELECT * REPLACE (CASE WHEN promo IS NOT NULL THEN 1 ELSE kind END AS kind) FROM pm),
post AS (SELECT m.mid, m.pos_id, m.stm, p.sq, p.ch FROM pmk m JOIN pieces p ON p.pos_id = m.pos_id WHERE p.sq NOT IN (m.frm, m.dest) AND NOT (m.kind = 2 AND p.sq = m.frm // 8 * 8 + m.dest % 8)
   UNION ALL SELECT m.mid, m.pos_id, m.stm, m.dest, CASE WHEN m.promo IS NULL THEN p.ch WHEN m.stm = 0 THEN upper(m.promo) ELSE m.promo END FROM pmk m JOIN pieces p ON p.pos_id = m.pos_id AND p.sq = m.frm WHERE m.kind <> 3
   UNION ALL SELECT mid, pos_id, stm, kt, CASE WHEN stm = 0 THEN 'K' ELSE 'k' END FROM pmk WHERE kind = 3 UNION ALL SELECT mid, pos_id, stm, rt, CASE WHEN stm = 0 THEN 'R' ELSE 'r' END FROM pmk WHERE kind = 3),
ks AS (SELECT mid, pos_id, sq, CASE WHEN ch = 'K' THEN 0 ELSE 1 END AS color, stm FROM post WHERE ch IN ('K', 'k')),
seen AS (SELECT k.mid, k.color, k.stm, r.kind, arg_min(p.ch, r.step) AS ch FROM ks k JOIN ray r ON r.frm = k.sq JOIN post p ON p.mid = k.mid AND p.sq = r.too GROUP BY k.mid, k.color, k.stm, r.kind, r.dx, r.dy),
hit AS (SELECT DISTINCT mid, color, stm FROM (SELECT mid, color, stm FROM seen WHERE (ch = upper(ch)) <> (color = 0) AND upper(ch) IN (kind, 'Q')
   UNION ALL SELECT k.mid, k.color, k.stm FROM ks k JOIN leap l ON l.frm = k.sq JOIN post p ON p.mid = k.mid AND p.sq = l.too AND (p.ch = upper(p.ch)) <> (k.color = 0) AND instr('PNBRQK', upper(p.ch)) = l.ptype
   UNION ALL SELECT k.mid, k.color, k.stm FROM ks k JOIN pawnhit h ON h.color = k.color AND h.frm = k.sq JOIN post p ON p.mid = k.mid AND p.sq = h.too AND p.ch = CASE WHEN k.color = 0 THEN 'p' ELSE 'P' END)),
legal AS (SELECT m.* FROM pmk m WHERE NOT EXISTS (SELECT 1 FROM hit h WHERE h.mid = m.mid AND h.color = m.stm)
   AND NOT (m.kind = 3 AND EXISTS (SELECT 1 FROM att a WHERE a.pos_id = m.pos_id AND a.color <> m.stm AND a.too BETWEEN least(m.frm, m.kt) AND greatest(m.frm, m.kt))))
"""


def _duck(select: str, base: str | None = None) -> str:
    from .positions import POS_SQL

    return (base or POS_SQL) + DUCK_MOVES + select


_SQ = "chr(CAST(97 + {0} % 8 AS INTEGER)) || chr(CAST(49 + {0} // 8 AS INTEGER))"
_LEGAL_OUT = f"""SELECT l.pos_id, {_SQ.format("l.frm")} || {_SQ.format("(CASE WHEN l.kind = 3 AND NOT c.chess960 THEN l.kt ELSE l.dest END)")} || coalesce(promo, '') AS uci,
  CAST(l.dest + l.frm * 64 + coalesce(instr('nbrq', promo) - 1, 0) * 4096 + l.kind * 16384 AS INTEGER) AS raw, CAST(l.kind AS INTEGER) AS kind,
  (l.kind <> 3 AND o.ch IS NOT NULL) OR l.kind = 2 AS is_capture, (l.kind <> 3 AND o.ch IS NOT NULL) OR l.kind = 2 OR coalesce(promo, '') = 'q' AS capture_stage, b.after
FROM legal l JOIN corpus c USING (pos_id) LEFT JOIN pieces o ON o.pos_id = l.pos_id AND o.sq = l.dest
JOIN (SELECT mid, string_agg(coalesce(ch, '.'), '' ORDER BY s) AS after FROM (SELECT m.mid, s, p.ch FROM (SELECT DISTINCT mid FROM post) m CROSS JOIN sqs LEFT JOIN post p ON p.mid = m.mid AND p.sq = s) GROUP BY mid) b USING (mid)"""
#: The relations of DUCK_MOVES once more, over the positions that its legal moves lead to; names end in 2.
_AGAIN = re.sub(r"\b(pos|pieces|walk|att|steps|push|raw_|cast_|castok|pm|pmk|post|ks|seen|hit|legal)\b", r"\g<1>2", DUCK_MOVES[DUCK_MOVES.index("walk AS") :])
_RIGHT = "CASE WHEN q.{0} IN (l.frm, l.dest) OR (l.t = 'K' AND l.stm = {1}) THEN NULL ELSE q.{0} END AS {0}"
DUCK_REPLIES = f""", pos2 AS (SELECT l.mid AS pos_id, 1 - l.stm AS stm, {_RIGHT.format("wk", 0)}, {_RIGHT.format("wq", 0)}, {_RIGHT.format("bk", 1)}, {_RIGHT.format("bq", 1)},
    CASE WHEN l.t = 'P' AND abs(l.dest - l.frm) = 16 THEN (l.frm + l.dest) // 2 END AS ep FROM legal l JOIN pos q USING (pos_id)),
pieces2 AS (SELECT p.mid AS pos_id, 1 - p.stm AS stm, p.sq, p.ch, CASE WHEN p.ch = upper(p.ch) THEN 0 ELSE 1 END AS color, instr('PNBRQK', upper(p.ch)) AS ptype FROM post p SEMI JOIN legal l ON l.mid = p.mid),
{_AGAIN}"""
_MADE_OUT = """SELECT l.pos_id, CAST(1 - l.stm AS INTEGER) AS stm, count(*) AS states, count(DISTINCT b.board) AS boards, count(e.pos_id) AS with_ep, count(q.wk) AS wk, count(q.wq) AS wq, count(q.bk) AS bk, count(q.bq) AS bq
FROM legal l JOIN pos2 q ON q.pos_id = l.mid JOIN (SELECT mid, string_agg(ch || chr(CAST(33 + sq AS INTEGER)), '' ORDER BY sq) AS board FROM post GROUP BY mid) b ON b.mid = l.mid
LEFT JOIN (SELECT DISTINCT pos_id FROM legal2 WHERE kind = 2) e ON e.pos_id = l.mid GROUP BY l.pos_id, l.stm"""
_DIVIDE_OUT = f"""SELECT CAST(l.pos_id AS INTEGER) AS id, {_SQ.format("l.frm")} || {_SQ.format("l.dest")} || coalesce(l.promo, '') AS root, count(*) AS leaves FROM legal l JOIN legal2 r ON r.pos_id = l.mid GROUP BY ALL"""
#: Exchanges as a recursion over who takes next: men that reach the square once all between are gone, the least valuable first.
EXCHANGE_SQL = f""", cap AS (SELECT l.mid, l.pos_id, l.stm, l.frm, l.dest, l.kind, {_SQ.format("l.frm")} || {_SQ.format("l.dest")} || coalesce(l.promo, '') AS uci, o.ptype AS victim, m.ptype AS mover
    FROM legal l JOIN pieces o ON o.pos_id = l.pos_id AND o.sq = l.dest JOIN pieces m ON m.pos_id = l.pos_id AND m.sq = l.frm WHERE l.kind <> 3),
line AS (SELECT c.mid, r.dx, r.dy, r.kind, r.step, p.sq, p.color, p.ptype FROM cap c JOIN ray r ON r.frm = c.dest JOIN pieces p ON p.pos_id = c.pos_id AND p.sq = r.too AND p.sq <> c.frm WHERE c.kind = 0),
taker AS (SELECT a.mid, a.sq, a.color, a.ptype, coalesce(list(b.sq) FILTER (b.sq IS NOT NULL), []) AS before FROM line a LEFT JOIN line b ON b.mid = a.mid AND b.dx = a.dx AND b.dy = a.dy AND b.step < a.step
      WHERE a.ptype = 5 OR (a.ptype = 3 AND a.kind = 'B') OR (a.ptype = 4 AND a.kind = 'R') GROUP BY a.mid, a.sq, a.color, a.ptype
  UNION ALL SELECT c.mid, p.sq, p.color, p.ptype, [] FROM cap c JOIN leap l ON l.too = c.dest JOIN pieces p ON p.pos_id = c.pos_id AND p.sq = l.frm AND p.ptype = l.ptype AND p.sq <> c.frm WHERE c.kind = 0
  UNION ALL SELECT c.mid, p.sq, p.color, p.ptype, [] FROM cap c JOIN pawnhit h ON h.too = c.dest JOIN pieces p ON p.pos_id = c.pos_id AND p.sq = h.frm AND p.ptype = 1 AND p.color = h.color AND p.sq <> c.frm WHERE c.kind = 0),
kline AS (SELECT k.pos_id, k.color, r.dx, r.dy, r.step, p.sq, p.color AS own, p.color <> k.color AND (p.ptype = 5 OR (p.ptype = 3 AND r.kind = 'B') OR (p.ptype = 4 AND r.kind = 'R')) AS slides
    FROM pieces k JOIN ray r ON k.ptype = 6 AND r.frm = k.sq JOIN pieces p ON p.pos_id = k.pos_id AND p.sq = r.too),
tie AS (SELECT s.pos_id, s.color, s.sq AS pinner, min(b.sq) AS blocker FROM kline s JOIN kline b ON b.pos_id = s.pos_id AND b.color = s.color AND b.dx = s.dx AND b.dy = s.dy AND b.step < s.step AND NOT b.slides
    WHERE s.slides GROUP BY s.pos_id, s.color, s.sq HAVING count(*) = 1 AND min(b.own) = s.color),
held AS (SELECT pos_id, color, list(pinner) AS pinners, list(blocker) AS blockers FROM tie GROUP BY pos_id, color),
turn AS (SELECT mid, pos_id, 0 AS n, [frm, dest] AS gone, 1 - stm AS side, mover AS stands, CAST([] AS BIGINT[]) AS taken FROM cap WHERE kind = 0
  UNION ALL SELECT mid, pos_id, n + 1, list_append(gone, sq), 1 - side, ptype, list_append(taken, stands) FROM (
    SELECT *, row_number() OVER (PARTITION BY mid ORDER BY ptype, sq) AS place FROM (
      SELECT t.*, c.sq, c.ptype, c.color, max(CASE WHEN c.color <> t.side THEN 1 ELSE 0 END) OVER (PARTITION BY t.mid) AS answered, h.pinners, h.blockers
      FROM turn t JOIN taker c ON c.mid = t.mid AND NOT list_contains(t.gone, c.sq) AND list_has_all(t.gone, c.before) LEFT JOIN held h ON h.pos_id = t.pos_id AND h.color = t.side) x
    WHERE color = side AND (pinners IS NULL OR list_has_all(gone, pinners) OR NOT list_contains(blockers, sq))) y
  WHERE place = 1 AND (ptype < 6 OR answered = 0)),
ended AS (SELECT mid, arg_max(taken, n) AS taken FROM turn GROUP BY mid),
gain AS (SELECT c.pos_id, c.uci, CASE WHEN c.kind <> 0 THEN 0 ELSE [208, 781, 825, 1276, 2538, 0][c.victim]
    - list_reduce(list_prepend(0, list_reverse(list_transform(e.taken, lambda x: [208, 781, 825, 1276, 2538, 0][x]))), lambda a, v: greatest(0, v - a)) END AS g FROM cap c LEFT JOIN ended e ON e.mid = c.mid)
SELECT pos_id, uci, g >= 0 AS gains, g >= 100 AS gains_100, g >= -100 AS loses_100 FROM gain"""
_STAGES_OUT = EXCHANGE_SQL[: EXCHANGE_SQL.rindex("SELECT pos_id, uci")] + f""", m AS (SELECT l.pos_id, {_SQ.format("l.frm")} || {_SQ.format("(CASE WHEN l.kind = 3 AND NOT c.chess960 THEN l.kt ELSE l.dest END)")} || coalesce(l.promo, '') AS uci,
    l.kind, l.promo, CASE WHEN l.kind = 3 THEN 0 ELSE coalesce(o.ptype, 0) END AS victim FROM legal l JOIN corpus c USING (pos_id) LEFT JOIN pieces o ON o.pos_id = l.pos_id AND o.sq = l.dest),
w AS (SELECT m.pos_id, m.uci, 7 * [0, 208, 781, 825, 1276, 2538][victim + 1] AS v, kind = 2 OR victim > 0 OR coalesce(promo, '') = 'q' AS takes, coalesce(g, 0) AS g FROM m LEFT JOIN gain USING (pos_id, uci)),
st AS (SELECT pos_id, uci, v, CAST(CASE WHEN NOT takes THEN 2 WHEN g >= -(v // 18) THEN 1 ELSE 3 END AS INTEGER) AS stage FROM w)
SELECT pos_id, CAST(row_number() OVER (PARTITION BY pos_id ORDER BY stage, v DESC, uci) AS INTEGER) AS place, uci, stage FROM st"""
QUERIES = {
    "g5_legal_moves": legal_moves, "f7_pseudo_moves": pseudo_moves, "f1_attacked_squares": attacked_squares, "f4_pins": pin_rows, "f8_checks": checks, "g10_made_moves": made_moves,
    "g15_perft": perft_counts, "g15_perft_divide": perft_divide,
}


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def _deep() -> str:
    from .positions import RIGHTS_CTE

    return f"WITH corpus AS (SELECT * FROM {C.values([(i, f, c) for i, f, c in C.PERFT_DEEP], 'pos_id, fen, chess960')}), {B.duck_board('corpus')}, {RIGHTS_CTE}"


def _oracles() -> dict[str, str]:
    return {
        "g5_legal_moves": _duck(_LEGAL_OUT),
        "f7_pseudo_moves": _duck("""SELECT m.pos_id, CAST(m.kind AS INTEGER) AS kind, coalesce(promo, '-') AS promo, (m.kind <> 3 AND o.ch IS NOT NULL) OR m.kind = 2 AS is_capture, count(*) AS moves
            FROM pmk m LEFT JOIN pieces o ON o.pos_id = m.pos_id AND o.sq = m.dest GROUP BY ALL"""),
        "f1_attacked_squares": _duck("SELECT pos_id, too AS sq, count(*) FILTER (color = 0) AS by_white, count(*) FILTER (color = 1) AS by_black FROM att GROUP BY ALL"),
        "f4_pins": _duck(""", kray AS (SELECT k.pos_id, k.color, r.dx, r.dy, r.kind, r.step, p.sq, p.ch, row_number() OVER (PARTITION BY k.pos_id, k.color, r.dx, r.dy ORDER BY r.step) AS n
              FROM pieces k JOIN ray r ON k.ptype = 6 AND r.frm = k.sq JOIN pieces p ON p.pos_id = k.pos_id AND p.sq = r.too)
            SELECT a.pos_id, a.color, a.sq AS blocker, b.sq AS pinner FROM kray a JOIN kray b USING (pos_id, color, dx, dy) WHERE a.n = 1 AND b.n = 2 AND (b.ch = upper(b.ch)) <> (b.color = 0) AND upper(b.ch) IN (b.kind, 'Q')"""),
        "f8_checks": _duck(""", m AS (SELECT l.pos_id, count(*) AS moves, count(h.mid) AS checks FROM legal l LEFT JOIN hit h ON h.mid = l.mid AND h.color <> l.stm GROUP BY l.pos_id),
            c AS (SELECT q.pos_id, EXISTS (SELECT 1 FROM att a JOIN pieces k ON k.pos_id = a.pos_id AND k.sq = a.too AND k.ptype = 6 AND k.color = q.stm WHERE a.pos_id = q.pos_id AND a.color <> q.stm) AS in_check FROM pos q)
            SELECT pos_id, in_check, coalesce(moves, 0) AS moves, coalesce(checks, 0) AS checks, CASE WHEN coalesce(moves, 0) > 0 THEN 'open' WHEN in_check THEN 'mate' ELSE 'stalemate' END AS state FROM c LEFT JOIN m USING (pos_id)"""),
        "f13_exchange": _recursive(_duck(EXCHANGE_SQL)),
        "o3_move_stages": _recursive(_duck(_STAGES_OUT)),
        "g10_made_moves": _duck(DUCK_REPLIES + _MADE_OUT),
        "g15_perft_divide": _duck(DUCK_REPLIES + _DIVIDE_OUT, _deep()),
        "g15_perft": "SELECT id, CAST(leaves AS BIGINT) AS leaves FROM " + C.values([(i, n) for i, _, _, n, _ in C.PERFT], "id, leaves"),
    }


ORACLE_SQL = _oracles()
for _name in ("g5_legal_moves", "f7_pseudo_moves", "f1_attacked_squares", "f4_pins", "f8_checks", "g10_made_moves"):
    ORACLE_SQL[_name] = C.by_order(ORACLE_SQL[_name])
