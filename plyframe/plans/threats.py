"""Pair features: which man attacks which, numbered, and sums of weights over them.

A feature is an attack on an occupied square, seen from one side: squares are turned so that this side plays upwards and its king stands
on the a to d files. Features come from the attack relation joined with the men on the attacked squares; two small relations, built
by rule, give their numbers. The sums are a sparse product: features meet a table of weights by number and are added up, dimension by
dimension, before anything is gathered by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernel as K
from ..sources import corpus as C
from . import moves as M
from .positions import POS_SQL

MEN = "PNBRQKpnbrqk"
# Places for the attacked men by kind of the attacker; which of them by kind of the attacked (-1: no feature).
PLACES = {"P": 6, "N": 12, "B": 10, "R": 10, "Q": 12, "K": 8}
PLACE = {"P": (0, 1, -1, 2, -1, -1), "N": (0, 1, 2, 3, 4, 5), "B": (0, 1, 2, 3, -1, 4), "R": (0, 1, 2, 3, -1, 4), "Q": (0, 1, 2, 3, 4, 5), "K": (0, 1, 2, 3, -1, -1)}
#: Rows of the weights (the smallest table holds so many) and dimensions that are summed.
WEIGHTS, SUMS = 500, 8


def reached(man: str, s: int) -> list[int]:
    """Squares that a man attacks on an empty board, in order; none for pawns where they don't stand."""
    kind = man.upper()
    if kind == "P":
        return sorted(K.PAWN[int(man == "p")][s]) if 8 <= s < 56 else []
    if kind in "NK":
        return sorted((K.KNIGHT if kind == "N" else K.KING)[s])
    return sorted(t for d in {"B": K.SLANTED, "R": K.STRAIGHT, "Q": K.STRAIGHT + K.SLANTED}[kind] for t in K.RAYS[s][d])


def numbering() -> tuple[list[tuple], list[tuple]]:
    """(man, frm, dest, step: its number among the man's steps; man, other, base: number of the first feature of the two)."""
    steps, pairs, begun = [], [], 0
    for man in MEN:
        own = [(s, t) for s in range(64) for t in reached(man, s)]
        steps += [(man, s, t, i) for i, (s, t) in enumerate(own)]
        for other in MEN:
            place = PLACE[man.upper()]["PNBRQK".index(other.upper())]
            if place >= 0:
                pairs.append((man, other, begun + (PLACES[man.upper()] // 2 * int(other.islower()) + place) * len(own)))
        begun += PLACES[man.upper()] * len(own)
    return steps, pairs


def threats(positions: DataFrame) -> DataFrame:
    """pos_id, side, feature. positions: parsed, with pos_id. Of two equal men that attack one another one direction counts, but for pawns
    of one colour, of which both would."""
    spark = positions.sparkSession
    steps, pairs = numbering()
    seen = M.attack_rows(positions, "pos_id", "wking", "bking", "board").withColumn("other", F.expr(M.cell("board", "dest"))).where("other <> '.'")
    seen = seen.select("pos_id", "frm", "dest", "ch", "other", F.inline(F.array(F.struct(F.lit(0).alias("side"), F.col("wking").alias("ksq")), F.struct(F.lit(1).alias("side"), F.col("bking").alias("ksq")))))
    turn = "(CASE WHEN ksq % 8 > 3 THEN 7 ELSE 0 END ^ (56 * side))"
    man = lambda c: f"CASE WHEN side = 0 THEN {c} WHEN {c} = upper({c}) THEN lower({c}) ELSE upper({c}) END"
    seen = seen.selectExpr("pos_id", "side", f"{man('ch')} AS man", f"{man('other')} AS other", f"frm ^ {turn} AS frm", f"dest ^ {turn} AS dest")
    seen = seen.where("NOT (upper(man) = upper(other) AND (man <> other OR upper(man) <> 'P') AND frm < dest)")
    # fewer than 8000 and 150 rows, whatever the input
    seen = seen.join(F.broadcast(spark.createDataFrame(steps, "man string, frm int, dest int, step int")), ["man", "frm", "dest"])
    seen = seen.join(F.broadcast(spark.createDataFrame(pairs, "man string, other string, base int")), ["man", "other"])
    return seen.selectExpr("pos_id", "side", "base + step AS feature")


def threat_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pair features of each order's position from both sides: how many, the least, the largest, their sum."""

    def work(p: DataFrame) -> DataFrame:
        return threats(p).groupBy("pos_id", "side").agg(F.count(F.lit(1)).alias("features"), F.min("feature").alias("least"), F.max("feature").alias("largest"), F.sum("feature").alias("total"))

    return M.answered(spark, sf_dir, work)


def sparse_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of weights over the pair features of each position and side. Weights are quantised embeddings, by feature % 500."""
    held = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where(f"vec_id < {WEIGHTS}")
    held = held.selectExpr("vec_id", *[f"CAST(floor(1024 * CAST(embedding[{j}] AS double)) AS bigint) AS w{j}" for j in range(SUMS)])

    def work(p: DataFrame) -> DataFrame:
        rows = threats(p).groupBy("pos_id", "side", F.expr(f"feature % {WEIGHTS}").alias("vec_id")).agg(F.count(F.lit(1)).alias("n"))
        met = rows.join(F.broadcast(held), "vec_id")  # 500 rows
        return met.groupBy("pos_id", "side").agg(F.sum("n").alias("features"), *[F.sum(F.col("n") * F.col(f"w{j}")).alias(f"s{j}") for j in range(SUMS)])

    return M.answered(spark, sf_dir, work)


_PLACE = "(VALUES " + ", ".join(f"('{k}', '{o}', {PLACES[k]}, {p})" for k, row in PLACE.items() for o, p in zip("PNBRQK", row) if p >= 0) + ") t(kind, okind, places, place)"
#: The same by windows over all attacks on an empty board and a relation of the fixed places.
THREATS_CTE = f"""{POS_SQL}{M.DUCK_MOVES}, mans AS (SELECT substr('{MEN}', i, 1) AS man, i FROM (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS i)),
bare AS (SELECT m.man, m.i, r.frm, r.too FROM mans m JOIN ray r ON upper(m.man) = 'Q' OR upper(m.man) = r.kind UNION ALL SELECT m.man, m.i, l.frm, l.too FROM mans m JOIN leap l ON l.ptype = instr('PNBRQK', upper(m.man))
  UNION ALL SELECT m.man, m.i, h.frm, h.too FROM mans m JOIN pawnhit h ON upper(m.man) = 'P' AND h.color = CASE WHEN m.man = 'p' THEN 1 ELSE 0 END WHERE h.frm BETWEEN 8 AND 55),
nums AS (SELECT man, frm, too, row_number() OVER (PARTITION BY man ORDER BY frm, too) - 1 AS step FROM bare),
size_ AS (SELECT man, i, count(*) AS n FROM bare GROUP BY ALL),
begun AS (SELECT s.man, s.n, coalesce(sum(s.n * p.places) OVER (ORDER BY s.i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM size_ s JOIN (SELECT DISTINCT kind, places FROM {_PLACE}) p ON p.kind = upper(s.man)),
sides AS (SELECT a.pos_id, k.color AS side, k.sq % 8 > 3 AS right_, a.frm, a.too, a.ch, o.ch AS och FROM att a JOIN pieces o ON o.pos_id = a.pos_id AND o.sq = a.too JOIN pieces k ON k.pos_id = a.pos_id AND k.ptype = 6),
seen_ AS (SELECT pos_id, side, CASE WHEN side = 0 THEN ch ELSE translate(ch, '{MEN}', '{MEN[6:]}{MEN[:6]}') END AS man, CASE WHEN side = 0 THEN och ELSE translate(och, '{MEN}', '{MEN[6:]}{MEN[:6]}') END AS other,
  CASE WHEN right_ THEN 7 - frm % 8 ELSE frm % 8 END + 8 * CASE WHEN side = 1 THEN 7 - frm // 8 ELSE frm // 8 END AS f, CASE WHEN right_ THEN 7 - too % 8 ELSE too % 8 END + 8 * CASE WHEN side = 1 THEN 7 - too // 8 ELSE too // 8 END AS t FROM sides),
feats AS (SELECT s.pos_id, CAST(s.side AS INTEGER) AS side, CAST(b.b + (p.places // 2 * CASE WHEN s.other = lower(s.other) THEN 1 ELSE 0 END + p.place) * b.n + n.step AS BIGINT) AS feature FROM seen_ s JOIN nums n ON n.man = s.man AND n.frm = s.f AND n.too = s.t
  JOIN begun b ON b.man = s.man JOIN (SELECT * FROM {_PLACE}) p ON p.kind = upper(s.man) AND p.okind = upper(s.other) WHERE s.f > s.t OR upper(s.man) <> upper(s.other) OR s.man = s.other AND upper(s.man) = 'P')
"""

QUERIES = {"g17_threat_features": threat_features, "a14_sparse_sums": sparse_sums}
ORACLE_SQL = {
    "g17_threat_features": C.by_order(THREATS_CTE + "SELECT pos_id, side, count(*) AS features, CAST(min(feature) AS INTEGER) AS least, CAST(max(feature) AS INTEGER) AS largest, CAST(sum(feature) AS BIGINT) AS total FROM feats GROUP BY ALL"),
    "a14_sparse_sums": C.by_order(
        THREATS_CTE + "SELECT f.pos_id, f.side, count(*) AS features, " + ", ".join(f"CAST(sum(floor(1024 * CAST(e.embedding[{j + 1}] AS DOUBLE))) AS BIGINT) AS s{j}" for j in range(SUMS)) + f" FROM feats f JOIN embeddings e ON e.vec_id = f.feature % {WEIGHTS} GROUP BY ALL"
    ),
}
