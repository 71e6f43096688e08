"""Lookups by key, rank formulas, consistency, passing, square sets, info lines, move stages and played games."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import board as B
from ..functions import kernel as K
from ..functions.score import engine
from ..functions.zobrist import lcg, signed, tables
from ..operators.rows import rows_of, spread
from ..sources import corpus as C
from . import aggregates as A
from .positions import CORPUS_CTE, POS_SQL
from .sequential import DEPTH, NODES

TOP = 1 << 18
#: Rank of a root move from its distance to zeroing, the fifty-move count and whether the position repeated.
ROOT_RANK = f"""CASE WHEN dtz > 0 THEN CASE WHEN dtz + c <= 99 AND NOT rep THEN {TOP} - CASE WHEN by_dtz THEN dtz ELSE 0 END ELSE trunc_div({TOP}, 2) - (dtz + c) END
  WHEN dtz < 0 THEN CASE WHEN -2 * dtz + c < 100 THEN -{TOP} - CASE WHEN by_dtz THEN dtz ELSE 0 END ELSE -trunc_div({TOP}, 2) + (c - dtz) END ELSE 0 END"""
RANK_BASE = "SELECT o_orderkey, CAST(o_orderkey * 7 % 241 - 120 AS bigint) AS dtz, CAST(o_orderkey % 101 AS bigint) AS c, o_orderkey % 5 = 0 AS rep, o_orderkey % 2 = 0 AS by_dtz, CAST(o_orderkey % 5 - 2 AS int) AS wdl FROM ORDERS"
#: What is shown for a rank: a table win or loss from WON on; below it at least 3, growing with the rank, of 200ths of a pawn.
WON, NEAR, SHOWN, PAWN_VALUE = TOP // 2 - 100, TOP // 2 - 200, 32000 - 246 - 1, 208
ROOT_SCORE = f"""CASE WHEN rank >= {WON} THEN {SHOWN} WHEN rank > 0 THEN trunc_div(greatest(3, rank - {NEAR}) * {PAWN_VALUE}, 200) WHEN rank = 0 THEN 0
  WHEN rank > -{WON} THEN trunc_div(least(-3, rank + {NEAR}) * {PAWN_VALUE}, 200) ELSE -{SHOWN} END"""
#: Before-zeroing distance and fallback rank of an outcome.
RANK_TEXT = f"""SELECT o_orderkey, rank, CAST({ROOT_SCORE} AS bigint) AS score, zeroing, fallback FROM (SELECT o_orderkey, {ROOT_RANK} AS rank, CAST(CASE wdl WHEN 2 THEN 1 WHEN 1 THEN 101 WHEN 0 THEN 0 WHEN -1 THEN -101 ELSE -1 END AS bigint) AS zeroing,
  CAST(CASE wdl WHEN 2 THEN {TOP} WHEN 1 THEN {TOP} - 101 WHEN 0 THEN 0 WHEN -1 THEN -{TOP} + 101 ELSE -{TOP} END AS bigint) AS fallback FROM ({RANK_BASE}) AS x) AS y"""
#: The same by outcome tables, absolute distances and signs.
RANK_ORACLE = f"""WITH x AS ({RANK_BASE.replace("ORDERS", "orders")}), w AS (SELECT * FROM (VALUES (2, 1, 262144), (1, 101, 262043), (0, 0, 0), (-1, -101, -262043), (-2, -1, -262144)) t(wdl, zeroing, fallback)),
d AS (SELECT *, abs(dtz) AS n, sign(dtz) AS s FROM x),
r AS (SELECT o_orderkey, wdl, s, CAST(s * CASE WHEN dtz = 0 THEN 0 WHEN dtz > 0 AND (rep OR n + c > 99) THEN 131072 - n - c WHEN dtz < 0 AND 2 * n + c >= 100 THEN 131072 - n - c ELSE 262144 - CASE WHEN by_dtz THEN n ELSE 0 END END AS BIGINT) AS k FROM d)
SELECT o_orderkey, k AS rank, CAST(CASE WHEN abs(k) >= 130972 THEN sign(k) * 31753 WHEN k = 0 THEN 0 ELSE sign(k) * (greatest(3, abs(k) - 130872) * 208 // 200) END AS BIGINT) AS score, CAST(zeroing AS BIGINT) AS zeroing, CAST(fallback AS BIGINT) AS fallback FROM r JOIN w USING (wdl)"""


def root_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks by distance to zeroing with the score that is shown, and ranks by outcome alone."""
    return spark.sql(engine(RANK_TEXT, False).replace("ORDERS", "{orders}"), orders=spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey"))


def consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a sound position has, of the position that each order asks for."""
    outer = "concat(substr(board, 1, 8), substr(board, 57, 8))"
    return B.parse(C.asked(spark, sf_dir)).selectExpr(
        "pos_id", f"{B.count_of('K')} = 1 AND {B.count_of('k')} = 1 AS one_king", f"length(regexp_replace({outer}, '[Pp]', '')) = 16 AS no_outer_pawns", f"{B.count_of('P')} <= 8 AND {B.count_of('p')} <= 8 AS pawns",
        "length(regexp_replace(board, '[a-z.]', '')) <= 16 AND length(regexp_replace(board, '[A-Z.]', '')) <= 16 AS men", "castling > 0 AS can_castle", "length(board) = 64 AS full",
    )


CONSISTENCY_SQL = f"""{POS_SQL} SELECT p.pos_id, (SELECT count(*) FROM pieces x WHERE x.pos_id = p.pos_id AND x.ch = 'K') = 1 AND (SELECT count(*) FROM pieces x WHERE x.pos_id = p.pos_id AND x.ch = 'k') = 1 AS one_king,
  NOT EXISTS (SELECT 1 FROM pieces x WHERE x.pos_id = p.pos_id AND x.ptype = 1 AND x.sq // 8 IN (0, 7)) AS no_outer_pawns, NOT EXISTS (SELECT 1 FROM pieces x WHERE x.pos_id = p.pos_id AND x.ptype = 1 GROUP BY x.color HAVING count(*) > 8) AS pawns,
  NOT EXISTS (SELECT 1 FROM pieces x WHERE x.pos_id = p.pos_id GROUP BY x.color HAVING count(*) > 16) AS men, castling > 0 AS can_castle, length(board) = 64 AS "full" FROM pos p"""


def passed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each position after passing: the other side to move, no en passant square, one more ply on the fifty-move count."""
    return B.parse(C.asked(spark, sf_dir)).selectExpr("pos_id", "board", "1 - stm AS stm", "castling", "rule50 + 1 AS rule50", "game_ply + 1 AS game_ply")


def reversible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """moves that a later move can take back, by piece letter: pairs of squares one apart on the empty board."""
    return spark.createDataFrame(reversible_rows(), "ch string, a int, b int").groupBy("ch").agg(F.count(F.lit(1)).alias("moves"))


def reversible_rows() -> list[tuple[str, int, int]]:
    """3668 rows: every piece but pawns, lower square first."""
    def near(kind: str, s: int) -> set[int]:
        if kind in "NK":
            return set((K.KNIGHT if kind == "N" else K.KING)[s])
        ds = {"B": K.SLANTED, "R": K.STRAIGHT, "Q": K.STRAIGHT + K.SLANTED}[kind]
        return {t for d in ds for t in K.RAYS[s][d]}

    return [(c if side == 0 else c.lower(), s, t) for side in (0, 1) for c in "NBRQK" for s in range(64) for t in sorted(near(c, s)) if s < t]


REVERSIBLE_SQL = """WITH s AS (SELECT CAST(unnest(range(64)) AS INTEGER) AS q), p AS (SELECT x.q AS a, y.q AS b, abs(x.q % 8 - y.q % 8) AS dx, abs(x.q // 8 - y.q // 8) AS dy FROM s x, s y WHERE x.q < y.q),
k AS (SELECT * FROM (VALUES ('N'), ('B'), ('R'), ('Q'), ('K')) t(c))
SELECT CASE WHEN side = 0 THEN c ELSE lower(c) END AS ch, count(*) AS moves FROM p, k, (SELECT unnest([0, 1]) AS side) WHERE CASE c WHEN 'N' THEN dx * dy = 2 WHEN 'K' THEN greatest(dx, dy) = 1 WHEN 'B' THEN dx = dy WHEN 'R' THEN dx = 0 OR dy = 0 ELSE dx = dy OR dx = 0 OR dy = 0 END GROUP BY ALL"""


def table_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's user looks up the table that all events have written; a hit has the same key, a miss nulls."""
    table = A.table_updates(spark, sf_dir).select("slot", "key", "move", "depth8")
    asked = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_id", "user_id AS asked", f"user_id % {A.CELLS} AS slot")
    met = asked.join(table, "slot", "left")
    return met.selectExpr("event_id", "asked = key AS hit", "CASE WHEN asked = key THEN move END AS move", "CASE WHEN asked = key THEN depth8 END AS depth8")


LOOKUP_SQL = f"SELECT e.event_id, e.user_id = t.key AS hit, CASE WHEN e.user_id = t.key THEN t.move END AS move, CASE WHEN e.user_id = t.key THEN t.depth8 END AS depth8 FROM events e JOIN ({A.UPDATES_SQL}) t ON t.slot = e.user_id % {A.CELLS}"


def square_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares of each side's men, their union and what only one has, as names; drawn rank by rank."""
    squares = lambda cond: f"array_join(transform(filter(sequence(0, 63), s -> {cond}), s -> concat(char(97 + s % 8), char(49 + s div 8))), ' ')"
    cell = "substr(board, s + 1, 1)"
    drawn = ", ".join(f"translate(substr(board, {8 * r + 1}, 8), 'PNBRQKpnbrqk.', 'XXXXXXXXXXXX.')" for r in range(7, -1, -1))
    return B.parse(C.asked(spark, sf_dir)).selectExpr("pos_id", f"{squares(f'{cell} <> upper({cell})')} AS black", f"{squares(f'{cell} <> lower({cell})')} AS white", f"concat_ws('/', {drawn}) AS drawn")


SETS_SQL = f"""{CORPUS_CTE} {B.duck_board("corpus")}, c AS (SELECT pos_id, s // 8 AS r, string_agg(CASE WHEN substr(board, CAST(s + 1 AS INTEGER), 1) = '.' THEN '.' ELSE 'X' END, '' ORDER BY s) AS t FROM brd, (SELECT unnest(range(64)) AS s) GROUP BY ALL),
d AS (SELECT pos_id, string_agg(t, '/' ORDER BY r DESC) AS drawn FROM c GROUP BY pos_id)
SELECT pos_id, string_agg(CASE WHEN color = 1 THEN chr(97 + sq % 8) || chr(49 + sq // 8) END, ' ' ORDER BY sq) AS black, string_agg(CASE WHEN color = 0 THEN chr(97 + sq % 8) || chr(49 + sq // 8) END, ' ' ORDER BY sq) AS white, drawn FROM pieces JOIN d USING (pos_id) GROUP BY pos_id, drawn"""


#: The generator's constants and the number of its states.
STEP, ADDED, STATES = 6364136223846793005, 1442695040888963407, 1 << 64


def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Congruential hashes of order keys, from the constants that keys use, as signed numbers."""
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderkey AS i", f"(CAST(o_orderkey AS decimal(18, 0)) * {STEP} + {ADDED}) % {STATES} AS h")
    return rows.selectExpr("i", f"CAST(CASE WHEN h >= {STATES // 2} THEN h - {STATES} ELSE h END AS bigint) AS k")


HASH_SQL = f"SELECT i, CAST(CASE WHEN h >= {STATES // 2} THEN h - {STATES} ELSE h END AS BIGINT) AS k FROM (SELECT o_orderkey AS i, (CAST(o_orderkey AS HUGEINT) * {STEP} + {ADDED}) % {STATES} AS h FROM orders)"


def info_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8, K9: a line for each of the best moves of each position, and the move played with the reply that is expected; positions
    without moves say so. No times, table fill or table hits."""

    def work(r: dict) -> list:
        b, s = K.Board.parse(r["fen"]), K.Search(limit=NODES)
        ranked = s.run(b, DEPTH, chess960=r["chess960"], k=2)
        if not ranked:
            return [(r["pos_id"], 0, f"info depth 0 score {'mate 0' if b.in_check() else 'cp 0'}"), (r["pos_id"], 99, "bestmove (none)")]
        text = lambda v: f"mate {(K.MATE - v + 1) // 2}" if v > 31000 else f"mate {-((K.MATE + v) // 2)}" if v < -31000 else f"cp {v}"
        lines = [(r["pos_id"], i + 1, f"info depth {d} seldepth {max(d, s.deepest)} multipv {i + 1} score {text(v)} nodes {s.nodes} pv {' '.join(line)}") for i, (v, line, d) in enumerate(ranked)]
        best = ranked[0][1]
        return [*lines, (r["pos_id"], 99, f"bestmove {best[0]}" + (f" ponder {best[1]}" if len(best) > 1 else ""))]

    return rows_of(spread(C.corpus(spark), 4), "pos_id int, n int, line string", work)


def move_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2, O3: moves in picking order: captures that don't lose the exchange, quiet moves, losing captures; within a stage by what they take, then by text. No histories."""

    def work(r: dict) -> list:
        b = K.Board.parse(r["fen"])
        rows = []
        for m in b.moves():
            capture = m[3] == K.EN_PASSANT or m[2] == K.Q or (m[3] != K.CASTLING and b.cells[m[1]] > 0)
            value = 7 * K.WORTH[b.cells[m[1]]] if m[3] != K.CASTLING else 0
            stage = 2 if not capture else 1 if K.see(b, m, -(value // 18)) else 3
            rows.append((stage, -value, b.text(m, r["chess960"])))
        return [(r["pos_id"], i + 1, text, stage) for i, (stage, _, text) in enumerate(sorted(rows))]

    return rows_of(spread(C.corpus(spark)), "pos_id int, place int, uci string, stage int", work)


def games(spark: SparkSession, n: int = 20, plies: int = 60) -> DataFrame:
    """game, ply, key, fresh (an irreversible move led here), move, loud (it captures or makes a queen), mated, the kernel's repetition, board
    and stm: games played by a rule, a row a game.

    The rule prefers moves that undo the last one, so that positions repeat.
    """

    def work(r: dict) -> list:
        b, seed, out, last = K.Board.parse(C.POSITIONS[r["id"] % len(C.POSITIONS)][0]), r["id"] + 1, [], {}
        text = lambda b: "".join(K.LETTERS.get(c, ".") for c in b.cells)
        out.append((r["id"], 0, signed(b.key()), False, None, False, False, 0, text(b), b.stm))
        for ply in range(1, plies):
            moves = b.moves()
            if not moves:
                break
            seed = lcg(seed)
            back = [m for m in moves if m[:2] == last.get(b.stm, (None, None))[::-1]]
            m = back[0] if back and seed >> 63 else moves[(seed >> 33) % len(moves)]
            last[b.stm] = m[:2]
            loud = m[3] != K.CASTLING and (b.cells[m[1]] > 0 or m[3] == K.EN_PASSANT or m[2] == K.Q)
            uci, before = b.text(m), sum(b.rooks)
            b = b.after(m)
            out.append((r["id"], ply, signed(b.key()), b.rule50 == 0 or sum(b.rooks) != before, uci, loud, b.in_check() and not b.moves(), b.repetition(), text(b), b.stm))
        return out

    return rows_of(spread(spark.range(n)), "id long, ply int, key long, fresh boolean, move string, loud boolean, mated boolean, kernel int, board string, stm int", work).withColumnRenamed("id", "game")


def game_repetitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """repetitions of played games by windows over keys, beside the kernel's, and moves that shuffle back and forth."""
    return shuffles(A.repeats(games(spark), "game")).select("game", "ply", "move", "repetition", "kernel", "shuffling")


def shuffles(rows: DataFrame) -> DataFrame:
    """rows (game, ply, move, loud, rule50 after the move) with shuffling: the move goes back where its side's last one came from, and
    that one did so too; quiet, from ply 20 on, over six plies into the game, ten or more plies after the last irreversible move."""
    by = Window.partitionBy("game").orderBy("ply")
    two, four = F.lag("move", 2).over(by), F.lag("move", 4).over(by)
    part = lambda c, a: F.substring(c, a, 2)
    back = (part("move", 1) == part(two, 3)) & (part(two, 1) == part(four, 3))
    late = (F.col("ply") - 1 >= 20) & (F.lag("rule50").over(by) >= 10)
    return rows.withColumn("shuffling", F.coalesce(back & late & ~F.col("loud"), F.lit(False)))


def upcoming(rows: DataFrame) -> DataFrame:
    """rows (game, ply, key, rule50, board, stm) with upcoming: the least number of plies back to a position that a move of the side to move
    brings back, null if there is none.

    Positions an odd number of plies apart differ by one such move if their keys differ by the move's key: each of the last
    rule50 plies meets its position by game and ply, and the difference meets the moves that can be taken back. Their way must be free.
    """
    spark = rows.sparkSession
    psq, extra = tables()
    side = extra["side", 0]
    moves = [(signed(psq[c, a] ^ psq[c, b] ^ side), int(c.islower()), _between(a, b)) for c, a, b in reversible_rows()]
    moves = F.broadcast(spark.createDataFrame(moves, "diff long, mover int, way array<int>"))  # 3668 rows
    back = rows.where("rule50 >= 3").withColumn("d", F.explode(F.sequence(F.lit(3), F.col("rule50").cast("int"), F.lit(2)))).withColumn("at", F.col("ply") - F.col("d"))
    then = rows.select("game", F.col("ply").alias("at"), F.col("key").alias("then"))
    met = back.join(then, ["game", "at"]).withColumn("diff", F.expr("key ^ then")).join(moves, "diff").where("mover = stm AND forall(way, s -> substr(board, s + 1, 1) = '.')")
    return rows.join(met.groupBy("game", "ply").agg(F.min("d").alias("upcoming")), ["game", "ply"], "left")


def _between(a: int, b: int) -> list[int]:
    """Squares on the straight or slanted way between two squares, none for a knight's."""
    dx, dy = b % 8 - a % 8, b // 8 - a // 8
    n = max(abs(dx), abs(dy))
    return [a + i * (dx // n + 8 * (dy // n)) for i in range(1, n)] if dx == 0 or dy == 0 or abs(dx) == abs(dy) else []


def upcoming_repetitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """positions of played games that a move can bring back."""
    return upcoming(A.repeats(games(spark), "game")).select("game", "ply", "upcoming")


#: Two numbers of 64 bits, without sign, for each order.
WIDE = "CAST(18446744073709551616 AS decimal(38, 0))"


def high_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The high 64 bits of products of 64 bits, by halves of 32 bits, and the cluster of a key in a table of a million and three."""
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    number = lambda x, f, c: F.expr(f"CAST((CAST({x} AS decimal(20, 0)) * CAST({f} AS decimal(19, 0)) + {c}) % {WIDE} AS decimal(20, 0))")
    rows = rows.withColumn("a", number("o_orderkey", 6364136223846793005, 1442695040888963407)).withColumn("b", number("o_orderkey + 77", 3935559000370003845, 2691343689449507681))
    half = "CAST(4294967296 AS decimal(38, 0))"
    rows = rows.selectExpr("o_orderkey", "a", *[f"CAST({x} {op} {half} AS decimal(20, 0)) AS {x}{y}" for x in "ab" for y, op in (("l", "%"), ("h", "div"))])
    rows = rows.withColumn("m", F.expr(f"ah * bl + (al * bl) div {half}"))
    rows = rows.withColumn("high", F.expr(f"ah * bh + m div {half} + (al * bh + m % {half}) div {half}"))
    return rows.selectExpr("o_orderkey", "CAST(high AS string) AS high", f"CAST(ah * 1000003 + (al * 1000003) div {half} AS decimal(38, 0)) div {half} AS cluster")


HIGH_SQL = """WITH n AS (SELECT o_orderkey, (CAST(o_orderkey AS UHUGEINT) * 6364136223846793005 + 1442695040888963407) % 18446744073709551616 AS a, (CAST(o_orderkey + 77 AS UHUGEINT) * 3935559000370003845 + 2691343689449507681) % 18446744073709551616 AS b FROM orders)
SELECT o_orderkey, CAST(a * b // 18446744073709551616 AS VARCHAR) AS high, CAST(a * 1000003 // 18446744073709551616 AS BIGINT) AS cluster FROM n"""

QUERIES = {
    "p12_high_products": high_products, "o7_root_ranks": root_ranks, "f14_consistency": consistency, "g13_null_move": passed, "f12_reversible_moves": reversible, "j1_table_lookup": table_lookup, "k3_square_sets": square_sets, "p10_hashes": hashes,
    "k8_info_lines": info_lines, "o3_move_stages": move_stages, "s9_game_repetitions": game_repetitions, "f12_upcoming_repetition": upcoming_repetitions,
}
ORACLE_SQL = {
    "p12_high_products": HIGH_SQL, "o7_root_ranks": RANK_ORACLE, "f14_consistency": CONSISTENCY_SQL, "g13_null_move": f"{POS_SQL} SELECT pos_id, board, 1 - stm AS stm, castling, rule50 + 1 AS rule50, game_ply + 1 AS game_ply FROM pos",
    "f12_reversible_moves": REVERSIBLE_SQL, "j1_table_lookup": LOOKUP_SQL, "k3_square_sets": SETS_SQL, "p10_hashes": HASH_SQL,
}
for _name in ("f14_consistency", "g13_null_move", "k3_square_sets"):
    ORACLE_SQL[_name] = C.by_order(ORACLE_SQL[_name])
