"""Positions of orders meet the endgame tables: probes, the moves at the root in bands, and what the tables hold.

Order keys make up positions of three men: o_orderkey % 5 names the set of men, further remainders the side to move and the squares.
That binding is synthetic. Positions that aren't legal stay as rows without values.

The oracle solves the tables by recursive queries over all boards, without symmetry, keys or un-moves: one recursion over all moves
for the outcome, one over moves that don't zero for the distance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import board as B
from ..functions.placement import BITS, ORDER
from ..functions.score import engine
from ..operators import retrograde as R
from ..operators.rows import dealt
from ..sources.packed import probe_packed, write_packed
from .tables import ROOT_RANK, TOP

SQUARES = "CAST(o_orderkey * 7 % 64 AS int) AS wk, CAST(o_orderkey * 29 % 63 AS int) AS bk, CAST(CASE WHEN o_orderkey % 5 = 4 THEN 8 + o_orderkey * 13 % 48 ELSE o_orderkey * 13 % 61 END AS int) AS m0"
ASKED = f"SELECT o_orderkey, substr('{ORDER}', CAST(o_orderkey % 5 AS int) + 1, 1) AS k, CAST(o_orderkey % 2 AS int) AS stm, CAST(o_orderkey % 60 AS bigint) AS clock, {SQUARES} FROM orders"


def asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders' positions: o_orderkey, k, clock, stm, squares, key (null if men collide or kings touch) and legal. Written, as more than
    one set of men and more than one filter read it."""
    rows = spark.sql(ASKED.replace("FROM orders", "FROM {orders}"), orders=spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey"))
    parts = []
    for men in map(R.Men, ORDER):
        part = R.with_check(men.ranked(rows.where(F.col("k") == men.white), R.CODE[men.name]), men)
        parts.append(part.withColumn("legal", F.col("key").isNotNull() & F.col("legal")).drop("checked"))
    return R.stored(R._union(parts), "endgame-asked")


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome and distance to zeroing of each order's position, by key; all orders stay."""
    rows = asked(spark, sf_dir).selectExpr("o_orderkey", "k", "legal", "CASE WHEN legal THEN key END AS key")
    return rows.join(R.tables(spark).drop("plies"), "key", "left").select("o_orderkey", "k", "legal", "wdl", "dtz")


_PACKED: dict[str, str] = {}


def packed_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as probes, from packed blocks: those that an order asks for are read and decoded."""
    app = spark.sparkContext.applicationId
    if app not in _PACKED:
        path = R.shared_path(spark, "endgames-packed")
        write_packed(R.tables(spark), path)
        _PACKED[app] = path
    rows = asked(spark, sf_dir).selectExpr("o_orderkey", "k", "legal", "CASE WHEN legal THEN key END AS key")
    return rows.join(probe_packed(rows, _PACKED[app]), "key", "left").select("o_orderkey", "k", "legal", "wdl", "dtz")


def root_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each legal move of each order's position with outcome and distance for the mover, its rank, the band of equal
    ranks and its place. Values come from the position after the move; the mating move has distance 1."""
    keep = ("o_orderkey", "clock")
    rows = asked(spark, sf_dir).where("legal")
    moves = R._union([R.moves(rows.where(F.col("k") == men.white), men, *keep) for men in map(R.Men, ORDER)])
    after = R.tables(spark).selectExpr("key AS dst", "wdl AS w", "dtz AS d", "plies")
    met = moves.join(after, "dst", "left").selectExpr(
        *keep, f"concat({B.square_text('frm')}, {B.square_text('dest')}, coalesce(promo, '')) AS uci", "-coalesce(w, 0) AS wdl",
        "CAST(CASE WHEN zeroing THEN -sign(coalesce(w, 0)) WHEN plies = 0 THEN 1 ELSE -coalesce(d, 0) - sign(coalesce(d, 0)) END AS bigint) AS dtz",
    )
    met = met.selectExpr("*", "clock AS c", "false AS rep", "o_orderkey % 2 = 0 AS by_dtz").selectExpr("o_orderkey", "uci", "wdl", "dtz", f"CAST({engine(ROOT_RANK, False)} AS bigint) AS rank")
    return banded(met, rows.count())


#: Positions whose moves one task sorts.
SORTED = 100_000


def banded(moves: DataFrame, positions: int) -> DataFrame:
    """moves with band and place among those of their order; one sort serves both, in partitions of SORTED positions."""
    order = Window.partitionBy("o_orderkey")  # a position's moves
    placed = dealt(moves, positions, SORTED, "o_orderkey").withColumn("place", F.row_number().over(order.orderBy(F.desc("rank"), "uci")))
    return placed.select(*moves.columns, F.dense_rank().over(order.orderBy(F.desc("rank"))).alias("band"), "place")


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By set of men, side to move and outcome: boards that the table's rows stand for, the longest distance, and orders that asked."""
    solved = R.tables(spark)
    rows = []
    for men in map(R.Men, ORDER):
        low = R.CODE[men.name] << BITS
        part = men.placed(solved.where(F.col("key").between(low, low + men.size() - 1)).select("key", "wdl", "dtz"))
        on = " AND ".join(f"{c} div 8 = {c} % 8" for c in men.squares)
        images = "2" if men.pawn else f"CASE WHEN {on} THEN 4 ELSE 8 END"
        rows.append(part.selectExpr(f"'{men.white}' AS k", "stm", "wdl", "abs(dtz) AS far", f"{images} AS images"))
    held = R._union(rows).groupBy("k", "stm", "wdl").agg(F.sum("images").alias("boards"), F.max("far").alias("longest"))
    met = asked(spark, sf_dir).where("legal").select("k", "stm", "key").join(solved.select("key", "wdl"), "key")
    met = met.groupBy("k", "stm", "wdl").agg(F.count(F.lit(1)).alias("asked"))
    return held.join(met, ["k", "stm", "wdl"], "left").select("k", "stm", "wdl", "boards", "longest", F.coalesce("asked", F.lit(0)).alias("asked"))


_ID = "(((ascii({k}) * 2 + {stm}) * 64 + {w}) * 64 + {b}) * 64 + {p}"


def _id(k: str, stm: int | str, w: str, b: str, p: str) -> str:
    return _ID.format(k=k, stm=stm, w=w, b=b, p=p)


_WHITE, _BLACK = "(e.src // 262144) % 2 = 0", "(e.src // 262144) % 2 = 1"


def _recursion(name: str, edges: str, first: str = "") -> str:
    """Positions decided ply by ply: white wins by one move to a lost one, black loses if all moves lead to won ones."""
    return f"""{name}(src, n) USING KEY (src) AS (SELECT src, 0 FROM mated
  UNION SELECT s.src, s.n FROM (
    SELECT e.src, max(t.n) + 1 AS n FROM {name} t JOIN {edges} e ON e.dst = t.src WHERE {_WHITE} GROUP BY e.src
    {first}
    UNION ALL SELECT c.src, c.n FROM (SELECT e.src, max(t.n) + 1 AS n FROM {name} t JOIN {edges} e ON e.dst = t.src WHERE {_BLACK} GROUP BY e.src) c
      JOIN deg USING (src) WHERE deg.n = (SELECT count(*) FROM edges x JOIN recurring.{name} r ON r.src = x.dst WHERE x.src = c.src)) s
  WHERE s.src NOT IN (SELECT src FROM recurring.{name}))"""


SOLVED = f"""sq AS MATERIALIZED (SELECT CAST(unnest(range(64)) AS INTEGER) AS s),
two AS MATERIALIZED (SELECT a.s AS a, b.s AS b, abs(a.s % 8 - b.s % 8) AS dx, abs(a.s // 8 - b.s // 8) AS dy FROM sq a, sq b WHERE a.s <> b.s),
near AS MATERIALIZED (SELECT a, b FROM two WHERE greatest(dx, dy) = 1),
kings AS MATERIALIZED (SELECT a AS w, b FROM two WHERE greatest(dx, dy) > 1),
lines AS MATERIALIZED (SELECT k, a, b FROM two, (VALUES ('Q'), ('R'), ('B'), ('N')) v(k) WHERE CASE k WHEN 'N' THEN dx * dy = 2 WHEN 'B' THEN dx = dy WHEN 'R' THEN dx = 0 OR dy = 0 ELSE dx = 0 OR dy = 0 OR dx = dy END),
cuts AS MATERIALIZED (SELECT a, b, s AS c FROM two, sq WHERE s NOT IN (a, b) AND (dx = 0 OR dy = 0 OR dx = dy) AND (s % 8 - a % 8) * (b // 8 - a // 8) = (s // 8 - a // 8) * (b % 8 - a % 8)
  AND s % 8 BETWEEN least(a % 8, b % 8) AND greatest(a % 8, b % 8) AND s // 8 BETWEEN least(a // 8, b // 8) AND greatest(a // 8, b // 8)),
hits AS MATERIALIZED (SELECT l.k, l.a AS p, l.b, s AS w FROM lines l, sq WHERE s NOT IN (l.a, l.b) AND NOT EXISTS (SELECT 1 FROM cuts c WHERE c.a = l.a AND c.b = l.b AND c.c = s)
  UNION ALL SELECT 'P', p.s, b.s, w.s FROM sq p, sq b, sq w WHERE p.s // 8 BETWEEN 1 AND 6 AND b.s // 8 = p.s // 8 + 1 AND abs(b.s % 8 - p.s % 8) = 1 AND w.s NOT IN (p.s, b.s)),
men AS MATERIALIZED (SELECT v.k, w, b, s AS p FROM kings, sq, (VALUES ('Q'), ('R'), ('B'), ('N'), ('P')) v(k) WHERE s NOT IN (w, b) AND (v.k <> 'P' OR s // 8 BETWEEN 1 AND 6)),
checks AS MATERIALIZED (SELECT m.* FROM men m SEMI JOIN hits h ON h.k = m.k AND h.p = m.p AND h.b = m.b AND h.w = m.w),
whites AS MATERIALIZED (SELECT m.* FROM men m ANTI JOIN checks c USING (k, w, b, p)),
pushes AS MATERIALIZED (SELECT s AS a, s + 8 AS t FROM sq WHERE s // 8 BETWEEN 1 AND 6 UNION ALL SELECT s, s + 16 FROM sq WHERE s // 8 = 1),
wm AS (SELECT x.k, x.w, x.b, x.p, n.b AS w2, x.p AS p2, x.k AS k2, false AS z FROM whites x JOIN near n ON n.a = x.w JOIN kings g ON g.w = n.b AND g.b = x.b WHERE n.b <> x.p
  UNION ALL SELECT x.k, x.w, x.b, x.p, x.w, h.b, x.k, false FROM whites x JOIN lines h ON h.k = x.k AND h.a = x.p WHERE h.b NOT IN (x.w, x.b)
    AND (x.k = 'N' OR NOT EXISTS (SELECT 1 FROM cuts c WHERE c.a = x.p AND c.b = h.b AND c.c = x.w) AND NOT EXISTS (SELECT 1 FROM cuts c WHERE c.a = x.p AND c.b = h.b AND c.c = x.b))
  UNION ALL SELECT x.k, x.w, x.b, x.p, x.w, q.t, v.k, true FROM whites x JOIN pushes q ON q.a = x.p, (VALUES ('Q'), ('R'), ('B'), ('N'), ('P')) v(k)
    WHERE x.k = 'P' AND q.t NOT IN (x.w, x.b) AND (q.t = x.p + 8 OR x.p + 8 NOT IN (x.w, x.b)) AND (q.t > 55) = (v.k <> 'P')),
bm AS (SELECT x.k, x.w, x.b, x.p, n.b AS b2, n.b = x.p AS z FROM men x JOIN near n ON n.a = x.b JOIN kings g ON g.w = x.w AND g.b = n.b
  WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.k = x.k AND h.p = x.p AND h.b = n.b AND h.w = x.w)),
edges AS MATERIALIZED (SELECT {_id("k", 0, "w", "b", "p")} AS src, {_id("k2", 1, "w2", "b", "p2")} AS dst, z, CASE WHEN w2 <> w THEN w ELSE p END AS frm, CASE WHEN w2 <> w THEN w2 ELSE p2 END AS dest, CASE WHEN k2 <> k THEN lower(k2) ELSE '' END AS promo FROM wm
  UNION ALL SELECT {_id("k", 1, "w", "b", "p")}, CASE WHEN NOT z THEN {_id("k", 0, "w", "b2", "p")} END, z, b, b2, '' FROM bm),
mated AS MATERIALIZED (SELECT {_id("k", 1, "w", "b", "p")} AS src FROM checks EXCEPT SELECT src FROM edges),
deg AS MATERIALIZED (SELECT src, count(*) AS n FROM edges e WHERE {_BLACK} GROUP BY src),
{_recursion("won", "edges")},
quiet AS MATERIALIZED (SELECT src, dst FROM edges WHERE NOT z),
ends AS MATERIALIZED (SELECT DISTINCT src FROM edges SEMI JOIN won ON won.src = edges.dst WHERE z),
{_recursion("zero", "quiet", "UNION SELECT src, 1 FROM ends WHERE EXISTS (SELECT 1 FROM zero WHERE n = 0)")},
legal AS MATERIALIZED (SELECT {_id("k", 0, "w", "b", "p")} AS id, k, 0 AS stm FROM whites UNION ALL SELECT {_id("k", 1, "w", "b", "p")}, k, 1 FROM men),
solved AS MATERIALIZED (SELECT id, k, stm, n, CAST(CASE WHEN n IS NULL THEN 0 WHEN stm = 0 THEN 2 ELSE -2 END AS INTEGER) AS wdl, CAST(CASE WHEN n IS NULL THEN 0 WHEN stm = 0 THEN n ELSE -greatest(n, 1) END AS INTEGER) AS dtz
  FROM legal LEFT JOIN zero ON zero.src = id),
asked AS (SELECT *, {_id("k", "stm", "wk", "bk", "m0")} AS id FROM ({ASKED}))"""

QUERIES = {"j3_table_probe": probes, "j6_packed_probe": packed_probes, "o5_table_bands": root_moves, "j5_endgame_tables": holdings}
ORACLE_SQL = {
    "j3_table_probe": f"WITH RECURSIVE {SOLVED} SELECT o_orderkey, a.k, s.id IS NOT NULL AS legal, wdl, dtz FROM asked a LEFT JOIN solved s USING (id)",
    "j5_endgame_tables": f"""WITH RECURSIVE {SOLVED}, h AS (SELECT k, stm, wdl, CAST(count(*) AS BIGINT) AS boards, max(abs(dtz)) AS longest FROM solved GROUP BY ALL), m AS (SELECT s.k, s.stm, s.wdl, count(*) AS asked FROM asked a JOIN solved s USING (id) GROUP BY ALL)
SELECT k, h.stm, h.wdl, boards, longest, coalesce(asked, 0) AS asked FROM h LEFT JOIN m USING (k, stm, wdl)""",
    "o5_table_bands": f"""WITH RECURSIVE {SOLVED}, r AS (SELECT o_orderkey, clock, o_orderkey % 2 = 0 AS by_dtz, chr(97 + frm % 8) || chr(49 + frm // 8) || chr(97 + dest % 8) || chr(49 + dest // 8) || promo AS uci,
  -coalesce(s.wdl, 0) AS wdl, CASE WHEN e.z THEN CAST(sign(-coalesce(s.wdl, 0)) AS BIGINT) WHEN s.n = 0 AND s.stm = 1 THEN 1 WHEN s.dtz < 0 THEN 1 - s.dtz WHEN s.dtz > 0 THEN -1 - s.dtz ELSE 0 END AS dtz
  FROM asked a JOIN legal l USING (id) JOIN edges e ON e.src = a.id LEFT JOIN solved s ON s.id = e.dst),
q AS (SELECT o_orderkey, uci, wdl, CAST(dtz AS BIGINT) AS dtz, CAST(sign(dtz) * CASE WHEN dtz = 0 THEN 0 WHEN dtz > 0 AND dtz + clock > 99 OR dtz < 0 AND clock - 2 * dtz >= 100 THEN {TOP // 2} - abs(dtz) - clock ELSE {TOP} - CASE WHEN by_dtz THEN abs(dtz) ELSE 0 END END AS BIGINT) AS "rank" FROM r)
SELECT o_orderkey, uci, wdl, dtz, "rank", CAST(dense_rank() OVER (PARTITION BY o_orderkey ORDER BY "rank" DESC) AS INTEGER) AS band, CAST(row_number() OVER (PARTITION BY o_orderkey ORDER BY "rank" DESC, uci) AS INTEGER) AS place FROM q""",
}
ORACLE_SQL["j6_packed_probe"] = ORACLE_SQL["j3_table_probe"]
