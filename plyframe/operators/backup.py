"""Exact values of positions by a stored tree: grown ply by ply, then backed up by one aggregation a ply.

A node is a state, so positions that meet, from one root or from many, are one node of their ply and are expanded once. Each ply's
moves are written, keyed by parent and child. Values start as material at the last ply; going up, a node takes the move to the child
that is worst for the other side, with the sign turned and the line carried along. Nodes without moves are mated or stalemated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import board as B
from ..plans import moves as M
from .stored import stored

MATE = 32000
#: What a node is: the state and how castling is written.
STATE = (*M.STATE, "chess960")


def node_key() -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in STATE])


def grown(roots: DataFrame, depth: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """(nodes of each ply from 0 to depth, moves of each ply: node, uci, child). roots: the state and chess960; equal ones are one node."""
    tasks = max(roots.sparkSession.sparkContext.defaultParallelism, int(roots.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    apart = lambda rows: rows.repartition(tasks, "node").dropDuplicates(["node"])
    levels, edges = [stored(apart(roots.select(node_key().alias("node"), *STATE)), "tree-nodes")], []
    for _ in range(depth):
        made = M.legal(levels[-1], "node", "chess960").withColumn("uci", F.expr(M.move_text()))
        after = M.successors(made, "node", "uci", "chess960")
        ply = stored(after.select("node", "uci", node_key().alias("child"), *STATE), "tree-moves")
        edges.append(ply.select("node", "uci", "child"))
        levels.append(apart(ply.select(F.col("child").alias("node"), *STATE)))
        if len(levels) <= depth:
            levels[-1] = stored(levels[-1], "tree-nodes")
    return levels, edges


def backed_up(levels: list[DataFrame], edges: list[DataFrame]) -> DataFrame:
    """node, value for the side to move and the line to it, of the first ply. Of equal values the first move by its text counts. A mate
    is worth 32000 less the plies to it; a mate at the last ply isn't seen."""
    values = levels[-1].select("node", F.expr(f"CAST({B.balance()} AS int)").alias("value"), F.lit("").alias("line"))
    king = "(instr(board, CASE WHEN stm = 0 THEN 'K' ELSE 'k' END) - 1)"
    for ply in range(len(edges) - 1, -1, -1):
        below = values.select(F.col("node").alias("child"), "value", "line")
        best = edges[ply].join(below, "child").groupBy("node").agg(F.min(F.struct("value", "uci", "line")).alias("b"))
        nodes = levels[ply].select("node", F.expr(f"CASE WHEN {M.attacked('board', king, '(1 - stm)')} THEN {ply - MATE} ELSE 0 END").alias("ended"))
        values = nodes.join(best, "node", "left").select("node", F.coalesce(-F.col("b.value"), "ended").alias("value"), F.concat_ws(" ", "b.uci", F.expr("nullif(b.line, '')")).alias("line"))
    return values
