"""Values of the positions that orders ask for, by a stored tree of two plies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import board as B
from ..operators import backup as K
from ..sources import corpus as C
from . import moves as M
from .positions import POS_SQL

DEPTH = 2


def backed_values(spark: SparkSession, sf_dir: str, depth: int = DEPTH) -> DataFrame:
    """Exact value over material and best line of each order's position, and how many moves it has. Orders that ask for equal
    positions share a tree."""
    rows = B.parse(C.asked(spark, sf_dir)).select("pos_id", K.node_key().alias("node"), *K.STATE)
    levels, edges = K.grown(rows.select(*K.STATE), depth)
    moves = edges[0].groupBy("node").count().withColumnRenamed("count", "moves")
    found = K.backed_up(levels, edges).join(moves, "node", "left")
    return rows.select("pos_id", "node").join(found, "node").selectExpr("pos_id", "value", "line", "coalesce(moves, 0L) AS moves")


_WORTH = " + ".join(f"CASE WHEN upper(ch) = '{k}' THEN {v} ELSE 0 END" for k, v in B.VALUES.items() if v)
_UCI = "chr(CAST(97 + {x}.frm % 8 AS INTEGER)) || chr(CAST(49 + {x}.frm // 8 AS INTEGER)) || chr(CAST(97 + (CASE WHEN {x}.kind = 3 AND NOT c.chess960 THEN {x}.kt ELSE {x}.dest END) % 8 AS INTEGER)) || chr(CAST(49 + (CASE WHEN {x}.kind = 3 AND NOT c.chess960 THEN {x}.kt ELSE {x}.dest END) // 8 AS INTEGER)) || coalesce({x}.promo, '')"
#: Two plies as rows: boards after each reply from squares that are left, the least for each move, the most for each position.
BACKED_SQL = f"""{POS_SQL}{M.DUCK_MOVES}{M.DUCK_REPLIES}, w2 AS (SELECT p.mid, sum(({_WORTH}) * CASE WHEN (ch = upper(ch)) = (p.stm = 1) THEN 1 ELSE -1 END) AS v FROM post2 p SEMI JOIN legal2 r ON r.mid = p.mid GROUP BY p.mid),
replies AS (SELECT l.mid, l.pos_id, arg_min({_UCI.format(x="r")}, w2.v * 1000000 + row_no) AS uci, min(w2.v) AS v FROM (SELECT *, row_number() OVER (PARTITION BY pos_id ORDER BY frm % 8, frm // 8, CASE WHEN kind = 3 THEN kt ELSE dest END % 8, CASE WHEN kind = 3 THEN kt ELSE dest END // 8, promo) AS row_no FROM legal2) r
  JOIN w2 ON w2.mid = r.mid JOIN legal l ON l.mid = r.pos_id JOIN corpus c ON c.pos_id = l.pos_id GROUP BY l.mid, l.pos_id),
firsts AS (SELECT l.pos_id, {_UCI.format(x="l")} AS uci, coalesce(p.v, CASE WHEN EXISTS (SELECT 1 FROM hit h WHERE h.mid = l.mid AND h.color <> l.stm) THEN 31999 ELSE 0 END) AS v, p.uci AS reply
  FROM legal l JOIN corpus c USING (pos_id) LEFT JOIN replies p ON p.mid = l.mid),
best AS (SELECT *, row_number() OVER (PARTITION BY pos_id ORDER BY v DESC, uci) AS n, count(*) OVER (PARTITION BY pos_id) AS moves FROM firsts),
chk AS (SELECT q.pos_id, EXISTS (SELECT 1 FROM att a JOIN pieces k ON k.pos_id = a.pos_id AND k.sq = a.too AND k.ptype = 6 AND k.color = q.stm WHERE a.pos_id = q.pos_id AND a.color <> q.stm) AS in_check FROM pos q)
SELECT q.pos_id, CAST(coalesce(b.v, CASE WHEN in_check THEN -32000 ELSE 0 END) AS INTEGER) AS value, concat_ws(' ', b.uci, b.reply) AS line, coalesce(b.moves, 0) AS moves FROM chk q LEFT JOIN best b ON b.pos_id = q.pos_id AND b.n = 1"""

QUERIES = {"h2_backed_values": backed_values}
ORACLE_SQL = {"h2_backed_values": C.by_order(BACKED_SQL)}
