"""Queries over positions: parsing, writing, material, keys, the win/draw/loss model and score text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import board as B
from ..functions import score as S
from ..functions import zobrist as Z
from ..sources import corpus as C

CORPUS_CTE = f"WITH corpus AS {C.corpus_sql()},"


def _sum(color: int) -> str:
    return " + ".join(f"{v} * {B.count_of(k if color == 0 else k.lower())}" for k, v in B.VALUES.items() if v and k != "P")


def _both(k: str) -> str:
    return f"({B.count_of(k)} + {B.count_of(k.lower())})"


MATERIAL = S.material(*(_both(k) for k in "PNBRQ"))


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.parse(C.stream(spark, sf_dir))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Material balance and win/draw/loss of every streamed position, by order priority."""
    rows = _stream(spark, sf_dir).selectExpr("o_orderpriority", "stm", f"cast({B.balance()} as int) AS v", f"{MATERIAL} AS m")
    rows = rows.selectExpr("*", f"{S.cubic(S.WDL_A, 'm')} AS a", f"{S.cubic(S.WDL_B, 'm')} AS b")
    rows = rows.selectExpr("*", f"{S.win_rate('v', 'a', 'b')} AS win", f"{S.win_rate('-v', 'a', 'b')} AS loss", f"{S.centipawns('v', 'a')} AS cp")
    return rows.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("positions"), F.sum("v").alias("sum_balance"), F.sum("cp").alias("sum_cp"), F.sum("win").alias("sum_win"),
        F.sum(F.expr("1000 - win - loss")).alias("sum_draw"), F.sum("loss").alias("sum_loss"), F.min("v").alias("min_balance"), F.max("v").alias("max_balance"),
    )


FLAGSHIP_SQL = f"""{CORPUS_CTE} st AS {C.STREAM_SQL},
{B.duck_board("st", "o_orderkey", ", o_orderpriority")},
val AS (SELECT o_orderkey, o_orderpriority, stm,
          sum((CASE ptype WHEN 1 THEN 208 WHEN 2 THEN 781 WHEN 3 THEN 825 WHEN 4 THEN 1276 WHEN 5 THEN 2538 ELSE 0 END) * CASE WHEN color = stm THEN 1 ELSE -1 END) AS v,
          least(78, greatest(17, sum(CASE ptype WHEN 1 THEN 1 WHEN 2 THEN 3 WHEN 3 THEN 3 WHEN 4 THEN 5 WHEN 5 THEN 9 ELSE 0 END))) / 58.0::double AS m
        FROM pieces GROUP BY ALL),
ab AS (SELECT *, {S.cubic(S.WDL_A, "m")} AS a, {S.cubic(S.WDL_B, "m")} AS b FROM val),
w AS (SELECT *, CAST(floor(0.5 + 1000 / (1 + exp((a - v) / b))) AS INTEGER) AS win, CAST(floor(0.5 + 1000 / (1 + exp((a + v) / b))) AS INTEGER) AS loss, CAST(round(100.0::double * v / a) AS INTEGER) AS cp FROM ab)
SELECT o_orderpriority, count(*) AS positions, CAST(sum(v) AS BIGINT) AS sum_balance, CAST(sum(cp) AS BIGINT) AS sum_cp, CAST(sum(win) AS BIGINT) AS sum_win,
       CAST(sum(1000 - win - loss) AS BIGINT) AS sum_draw, CAST(sum(loss) AS BIGINT) AS sum_loss, CAST(min(v) AS INTEGER) AS min_balance, CAST(max(v) AS INTEGER) AS max_balance
FROM w GROUP BY o_orderpriority"""


def fen_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the position that each order asks for."""
    rows = B.parse(C.asked(spark, sf_dir))
    return rows.select("pos_id", "board", "stm", "castling", "wk", "wq", "bk", "bq", F.col("ep").cast("int").alias("ep"), "rule50", "game_ply")


#: The same by joining letters to rooks as rows, not by expressions over arrays.
RIGHTS_CTE = """
kings AS (SELECT pos_id, color, min(sq) AS ksq FROM pieces WHERE ptype = 6 GROUP BY ALL),
letters AS (SELECT pos_id, unnest(string_split(rights, '')) AS c FROM brd),
rooks AS (SELECT l.pos_id, p.color, p.sq, CASE
              WHEN upper(l.c) = 'K' THEN CASE WHEN p.sq = max(p.sq) OVER (PARTITION BY l.pos_id, l.c, p.color) THEN 1 ELSE 0 END
              WHEN upper(l.c) = 'Q' THEN CASE WHEN p.sq = min(p.sq) OVER (PARTITION BY l.pos_id, l.c, p.color) THEN 1 ELSE 0 END
              WHEN upper(l.c) BETWEEN 'A' AND 'H' THEN CASE WHEN p.sq % 8 = ascii(upper(l.c)) - 65 THEN 1 ELSE 0 END ELSE 0 END AS chosen
          FROM letters l JOIN pieces p ON p.pos_id = l.pos_id AND p.ptype = 4 AND p.color = CASE WHEN l.c = upper(l.c) THEN 0 ELSE 1 END AND p.sq // 8 = CASE WHEN l.c = upper(l.c) THEN 0 ELSE 7 END),
rts AS (SELECT r.pos_id, max(CASE WHEN r.color = 0 AND r.sq > k.ksq THEN r.sq END) AS wk, min(CASE WHEN r.color = 0 AND r.sq < k.ksq THEN r.sq END) AS wq,
               max(CASE WHEN r.color = 1 AND r.sq > k.ksq THEN r.sq END) AS bk, min(CASE WHEN r.color = 1 AND r.sq < k.ksq THEN r.sq END) AS bq
        FROM rooks r JOIN kings k USING (pos_id, color) WHERE r.chosen = 1 GROUP BY r.pos_id),
eps AS (SELECT b.pos_id, ascii(ep_given) - 97 + 8 * (CASE WHEN stm = 0 THEN 5 ELSE 2 END) AS ep FROM brd b
        WHERE ep_given <> '-' AND substr(ep_given, 2, 1) = CASE WHEN stm = 0 THEN '6' ELSE '3' END
          AND EXISTS (SELECT 1 FROM pieces p WHERE p.pos_id = b.pos_id AND p.ptype = 1 AND p.color = b.stm AND p.sq // 8 = CASE WHEN b.stm = 0 THEN 4 ELSE 3 END AND abs(p.sq % 8 - (ascii(ep_given) - 97)) = 1)
          AND EXISTS (SELECT 1 FROM pieces p WHERE p.pos_id = b.pos_id AND p.ptype = 1 AND p.color <> b.stm AND p.sq = ascii(ep_given) - 97 + 8 * CASE WHEN b.stm = 0 THEN 4 ELSE 3 END)
          AND NOT EXISTS (SELECT 1 FROM pieces p WHERE p.pos_id = b.pos_id AND p.sq % 8 = ascii(ep_given) - 97 AND p.sq // 8 IN (CASE WHEN b.stm = 0 THEN 5 ELSE 2 END, CASE WHEN b.stm = 0 THEN 6 ELSE 1 END))),
pos AS (SELECT b.pos_id, board, b.stm, (CASE WHEN wk IS NULL THEN 0 ELSE 1 END) + (CASE WHEN wq IS NULL THEN 0 ELSE 2 END) + (CASE WHEN bk IS NULL THEN 0 ELSE 4 END) + (CASE WHEN bq IS NULL THEN 0 ELSE 8 END) AS castling,
               wk, wq, bk, bq, CAST(ep AS INTEGER) AS ep, rule50, greatest(2 * (fullmove - 1), 0) + b.stm AS game_ply
        FROM brd b LEFT JOIN rts USING (pos_id) LEFT JOIN eps USING (pos_id))"""
POS_SQL = f"{CORPUS_CTE} {B.duck_board('corpus')}, {RIGHTS_CTE}"


def fen_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: positions written back."""
    rows = B.parse(C.asked(spark, sf_dir)).withColumn("placement", B.placement_of("board"))
    return rows.select("pos_id", B.write().alias("fen"))


def flip_fen(fen: str) -> str:
    """SQL text: a position with colours exchanged, by its text alone (Spark)."""
    part = lambda i: f"element_at(split(trim({fen}), '\\\\s+'), {i})"
    swap = "translate({}, 'PNBRQKpnbrqkABCDEFGHabcdefgh', 'pnbrqkPNBRQKabcdefghABCDEFGH')"
    ep = f"CASE WHEN {part(4)} = '-' THEN '-' ELSE translate({part(4)}, '36', '63') END"
    tail = f"CASE WHEN size(split(trim({fen}), '\\\\s+')) > 4 THEN concat(' ', array_join(slice(split(trim({fen}), '\\\\s+'), 5, 2), ' ')) ELSE '' END"
    placement = f"array_join(reverse(split(translate({part(1)}, 'PNBRQKpnbrqk', 'pnbrqkPNBRQK'), '/')), '/')"
    return f"concat({placement}, CASE WHEN {part(2)} = 'w' THEN ' b ' ELSE ' w ' END, {swap.format(part(3))}, ' ', {ep}, {tail})"


def flip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each position with colours exchanged."""
    return C.asked(spark, sf_dir).selectExpr("pos_id", f"{flip_fen('fen')} AS flipped")


FLIP_SQL = f"""{CORPUS_CTE} p AS (SELECT pos_id, regexp_split_to_array(trim(fen), '\\s+') AS f FROM corpus),
ranks AS (SELECT pos_id, unnest(string_split(f[1], '/')) AS r, unnest(range(8)) AS i FROM p),
placed AS (SELECT pos_id, string_agg(translate(r, 'PNBRQKpnbrqk', 'pnbrqkPNBRQK'), '/' ORDER BY i DESC) AS placement FROM ranks GROUP BY pos_id)
SELECT pos_id, placement || CASE WHEN f[2] = 'w' THEN ' b ' ELSE ' w ' END
       || translate(f[3], 'PNBRQKpnbrqkABCDEFGHabcdefgh', 'pnbrqkPNBRQKabcdefghABCDEFGH') || ' '
       || CASE WHEN f[4] = '-' THEN '-' ELSE translate(f[4], '36', '63') END || CASE WHEN len(f) > 4 THEN ' ' || array_to_string(f[5:6], ' ') ELSE '' END AS flipped
FROM p JOIN placed USING (pos_id)"""


def material_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, A2: balance, non-pawn material and counts of streamed positions, by position."""
    rows = _stream(spark, sf_dir).selectExpr(
        "pos_id", f"cast({B.balance()} as int) AS balance", f"cast({_sum(0)} as int) AS npm_white", f"cast({_sum(1)} as int) AS npm_black", f"cast({_both('P')} as int) AS pawns", f"cast(64 - length(replace(board, '.', '')) as int) AS empty"
    )
    return rows.groupBy("pos_id", "balance", "npm_white", "npm_black", "pawns", F.expr("64 - empty").alias("men")).agg(F.count(F.lit(1)).alias("times"))


MATERIAL_SQL = f"""{CORPUS_CTE} st AS {C.STREAM_SQL}, {B.duck_board("corpus")},
v AS (SELECT *, CASE ptype WHEN 1 THEN 208 WHEN 2 THEN 781 WHEN 3 THEN 825 WHEN 4 THEN 1276 WHEN 5 THEN 2538 ELSE 0 END AS val FROM pieces),
g AS (SELECT pos_id, CAST(sum(CASE WHEN color = stm THEN val ELSE -val END) AS INTEGER) AS balance, CAST(sum(CASE WHEN color = 0 AND ptype > 1 THEN val ELSE 0 END) AS INTEGER) AS npm_white,
             CAST(sum(CASE WHEN color = 1 AND ptype > 1 THEN val ELSE 0 END) AS INTEGER) AS npm_black, CAST(sum(CASE WHEN ptype = 1 THEN 1 ELSE 0 END) AS INTEGER) AS pawns, CAST(count(*) AS INTEGER) AS men FROM v GROUP BY pos_id)
SELECT pos_id, balance, npm_white, npm_black, pawns, men, count(*) AS times FROM st JOIN g USING (pos_id) GROUP BY ALL"""


def position_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full, pawn, minor, non-pawn and material keys, and the key that the fifty-move count adjusts."""
    return Z.keys(B.parse(C.asked(spark, sf_dir)), spark, "pos_id")


KEYS_SQL = f"""{POS_SQL}, zob AS {Z.piece_sql()}, ext AS {Z.extra_sql()},
pk AS (SELECT p.pos_id, p.color, p.ptype, z.k FROM pieces p JOIN zob z ON z.ch = p.ch AND z.sq = p.sq),
base AS (SELECT pos_id, bit_xor(k) AS psq, bit_xor(CASE WHEN ptype = 1 THEN k ELSE 0 END) AS pawn, bit_xor(CASE WHEN ptype IN (2, 3, 6) THEN k ELSE 0 END) AS minor,
               bit_xor(CASE WHEN color = 0 AND ptype > 1 THEN k ELSE 0 END) AS npw, bit_xor(CASE WHEN color = 1 AND ptype > 1 THEN k ELSE 0 END) AS npb FROM pk GROUP BY pos_id),
mat AS (SELECT pos_id, bit_xor(z.k) AS material FROM (SELECT pos_id, ch, 8 + row_number() OVER (PARTITION BY pos_id, ch) - 1 AS slot FROM pieces) c JOIN zob z ON z.ch = c.ch AND z.sq = c.slot GROUP BY pos_id),
full_ AS (SELECT p.pos_id, rule50, xor(xor(xor(psq, (SELECT k FROM ext WHERE kind = 'castling' AND i = p.castling)), coalesce((SELECT k FROM ext WHERE kind = 'ep' AND i = p.ep % 8), 0)), CASE WHEN p.stm = 1 THEN (SELECT k FROM ext WHERE kind = 'side') ELSE 0 END) AS key,
                xor(pawn, (SELECT k FROM ext WHERE kind = 'nopawns')) AS pawn_key, minor AS minor_key, npw AS nonpawn_white_key, npb AS nonpawn_black_key, material AS material_key
         FROM pos p JOIN base USING (pos_id) JOIN mat USING (pos_id))
SELECT pos_id, key, pawn_key, minor_key, nonpawn_white_key, nonpawn_black_key, material_key,
       CASE WHEN rule50 < 14 THEN key ELSE xor(key, (SELECT k FROM ext WHERE kind = 'rule50' AND i = (rule50 - 14) // 8)) END AS probe_key FROM full_"""

GRID = "(o_orderkey * 7919 % 64001 - 32000)"


def score_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind, plies, centipawns and text of a value for each order, under material that varies."""
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderkey", f"cast({GRID} as int) AS v", f"{S.material(*_COUNTS)} AS m")
    rows = rows.selectExpr("o_orderkey", "v", f"{S.cubic(S.WDL_A, 'm')} AS a")
    return rows.selectExpr("o_orderkey", "v", f"{S.kind('v')} AS kind", f"cast({S.plies('v')} as int) AS plies", f"{S.centipawns('v', 'a')} AS cp", f"{S.engine(S.score_text('v', 'a'), False)} AS text")


_COUNTS = ("(o_orderkey % 17)", "(o_orderkey % 5)", "(o_orderkey % 4)", "(o_orderkey % 3)", "(o_orderkey % 2)")
SCORE_SQL = f"""WITH g AS (SELECT o_orderkey, CAST({GRID} AS INTEGER) AS v, {S.material(*_COUNTS)} AS m FROM orders), a AS (SELECT o_orderkey, v, {S.cubic(S.WDL_A, "m")} AS a FROM g)
SELECT o_orderkey, v, {S.kind("v")} AS kind, CAST({S.plies("v")} AS INTEGER) AS plies, {S.centipawns("v", "a")} AS cp, {S.engine(S.score_text("v", "a"), True)} AS text FROM a"""


def wdl_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Win, draw and loss per mille for a value and material of each order."""
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderkey", "cast(o_orderkey * 31 % 2001 - 1000 as int) AS v", f"{S.material(*_COUNTS)} AS m")
    rows = rows.selectExpr("o_orderkey", "v", f"{S.cubic(S.WDL_A, 'm')} AS a", f"{S.cubic(S.WDL_B, 'm')} AS b")
    rows = rows.selectExpr("o_orderkey", f"{S.win_rate('v', 'a', 'b')} AS win", f"{S.win_rate('-v', 'a', 'b')} AS loss")
    return rows.selectExpr("o_orderkey", "win", "1000 - win - loss AS draw", "loss")


WDL_SQL = f"""WITH g AS (SELECT o_orderkey, CAST(o_orderkey * 31 % 2001 - 1000 AS INTEGER) AS v, {S.material(*_COUNTS)} AS m FROM orders),
a AS (SELECT o_orderkey, v, {S.cubic(S.WDL_A, "m")} AS a, {S.cubic(S.WDL_B, "m")} AS b FROM g), w AS (SELECT o_orderkey, {S.win_rate("v", "a", "b")} AS win, {S.win_rate("-v", "a", "b")} AS loss FROM a)
SELECT o_orderkey, win, 1000 - win - loss AS draw, loss FROM w"""

TT_TEXT = ("o_orderkey", "v", "ply", "rule50", f"{S.to_table('v', 'ply')} AS stored", f"{S.from_table('v', 'ply', 'rule50')} AS restored")
TT_BASE = f"o_orderkey, cast(CASE WHEN o_orderkey % 50 = 0 THEN {S.NONE} ELSE {GRID} END as int) AS v, cast(o_orderkey % 246 as int) AS ply, cast(o_orderkey % 101 as int) AS rule50"


def table_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values to and from a transposition table."""
    return spark.sql(f"SELECT {', '.join(TT_TEXT)} FROM (SELECT {TT_BASE} FROM {{orders}})", orders=spark.read.parquet(f"{sf_dir}/orders.parquet"))


#: The same by distance from zero and sign; remaining: plies to the mate or the table win that a value stands for.
TT_SQL = f"""WITH b AS (SELECT {TT_BASE} FROM orders), d AS (SELECT *, CASE WHEN v = 32002 THEN 0 ELSE sign(v) END AS s, abs(v) AS a, CASE WHEN abs(v) > 31753 THEN 32000 ELSE 31753 END - abs(v) AS remaining FROM b)
SELECT o_orderkey, v, ply, rule50, CAST(CASE WHEN s = 0 OR a < 31507 THEN v ELSE s * (a + ply) END AS INTEGER) AS stored, CAST(CASE WHEN s = 0 OR a < 31507 THEN v WHEN remaining + rule50 > 100 THEN s * 31506 ELSE s * (a - ply) END AS INTEGER) AS restored FROM d"""
EVAL_BASE = "o_orderkey, cast(o_orderkey * 13 % 4001 - 2000 as bigint) AS psqt, cast(o_orderkey * 29 % 3001 - 1500 as bigint) AS pos, cast(o_orderkey * 17 % 201 - 100 as bigint) AS opt, cast(o_orderkey % 17 * 534 + o_orderkey % 9000 as bigint) AS mat, cast(o_orderkey % 100 as bigint) AS rule50, " + ", ".join(f"cast(o_orderkey * {k} % 2049 - 1024 as bigint) AS {c}" for k, c in ((19, "pawn"), (23, "minor"), (37, "white"), (41, "black"), (43, "two"), (47, "four"))) + ", o_orderkey % 9 <> 0 AS moved"


#: What corrects an evaluation, of 131072ths: entries by pawns, by minor pieces, by each side's other pieces, and by the moves two and four plies ago
#: (8 in place of their sum where no move was made).
CORRECTION = "10347 * pawn + 8821 * minor + 11665 * (white + black) + 7841 * CASE WHEN moved THEN two + four ELSE 8 END"


def _eval_text(duck: bool) -> str:
    return f"o_orderkey, cast({S.engine(S.final_eval('psqt', 'pos', 'opt', 'mat', 'rule50'), duck)} as int) AS value, cast(least({S.TB_WIN - 1}, greatest(-{S.TB_WIN - 1}, {S.engine(f'psqt + trunc_div({CORRECTION}, 131072)', duck)})) as int) AS corrected"


def final_evals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blended and corrected evaluations, given a network's parts."""
    return spark.sql(f"SELECT {_eval_text(False)} FROM (SELECT {EVAL_BASE} FROM {{orders}})", orders=spark.read.parquet(f"{sf_dir}/orders.parquet"))


EVAL_SQL = f"""WITH b AS (SELECT {EVAL_BASE} FROM orders), e AS (SELECT {_eval_text(True)} FROM b),
t AS (SELECT o_orderkey, psqt, list_sum([10347.0 * pawn, 8821.0 * minor, 11665.0 * white, 11665.0 * black, CASE WHEN moved THEN 7841.0 * two + 7841.0 * four ELSE 62728.0 END]) AS c FROM b)
SELECT o_orderkey, value, CAST(CASE WHEN psqt + trunc(c / 131072) > {S.TB_WIN - 1} THEN {S.TB_WIN - 1} WHEN psqt + trunc(c / 131072) < -{S.TB_WIN - 1} THEN -{S.TB_WIN - 1} ELSE psqt + trunc(c / 131072) END AS INTEGER) AS corrected FROM e JOIN t USING (o_orderkey)"""

QUERIES = {
    "flagship_material_wdl": flagship, "s5_fen_parse": fen_parse, "k1_fen_write": fen_round_trip, "p26_flip": flip, "a1_material_balance": material_balance, "p14_position_keys": position_keys,
    "k7_score_text": score_texts, "p16_wdl_model": wdl_model, "p21_table_values": table_values, "e1_final_eval": final_evals,
}
_FEN_OUT = """SELECT pos_id, concat_ws(' ', placement, CASE WHEN stm = 0 THEN 'w' ELSE 'b' END,
  CASE WHEN castling = 0 THEN '-' ELSE CASE WHEN wk IS NULL THEN '' WHEN chess960 THEN chr(CAST(65 + wk AS INTEGER)) ELSE 'K' END || CASE WHEN wq IS NULL THEN '' WHEN chess960 THEN chr(CAST(65 + wq AS INTEGER)) ELSE 'Q' END
    || CASE WHEN bk IS NULL THEN '' WHEN chess960 THEN chr(CAST(41 + bk AS INTEGER)) ELSE 'k' END || CASE WHEN bq IS NULL THEN '' WHEN chess960 THEN chr(CAST(41 + bq AS INTEGER)) ELSE 'q' END END,
  CASE WHEN ep IS NULL THEN '-' ELSE chr(97 + ep % 8) || chr(49 + ep // 8) END, CAST(rule50 AS VARCHAR), CAST(1 + (game_ply - stm) // 2 AS VARCHAR)) AS fen
FROM pos JOIN corpus USING (pos_id) JOIN placed USING (pos_id)"""
_PLACED = """, cells AS (SELECT pos_id, r, f, substr(board, CAST(8 * r + f + 1 AS INTEGER), 1) AS c FROM brd, (SELECT unnest(range(8)) AS r), (SELECT unnest(range(8)) AS f)),
islands AS (SELECT *, f - row_number() OVER (PARTITION BY pos_id, r, c = '.' ORDER BY f) AS isle FROM cells),
runs AS (SELECT pos_id, r, min(f) AS f, CASE WHEN c = '.' THEN CAST(count(*) AS VARCHAR) ELSE c END AS t FROM islands GROUP BY pos_id, r, c, CASE WHEN c = '.' THEN isle ELSE 100 + f END),
rk AS (SELECT pos_id, r, string_agg(t, '' ORDER BY f) AS t FROM runs GROUP BY ALL), placed AS (SELECT pos_id, string_agg(t, '/' ORDER BY r DESC) AS placement FROM rk GROUP BY pos_id) """
ORACLE_SQL = {
    "flagship_material_wdl": FLAGSHIP_SQL, "s5_fen_parse": f"{POS_SQL} SELECT pos_id, board, stm, castling, wk, wq, bk, bq, ep, rule50, game_ply FROM pos", "k1_fen_write": POS_SQL + _PLACED + _FEN_OUT,
    "p26_flip": FLIP_SQL, "a1_material_balance": MATERIAL_SQL, "p14_position_keys": KEYS_SQL, "k7_score_text": SCORE_SQL, "p16_wdl_model": WDL_SQL, "p21_table_values": TT_SQL, "e1_final_eval": EVAL_SQL,
}
for _name in ("s5_fen_parse", "k1_fen_write", "p26_flip", "p14_position_keys"):
    ORACLE_SQL[_name] = C.by_order(ORACLE_SQL[_name])
