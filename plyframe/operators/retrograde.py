"""Endgame tables as a fixpoint over DataFrames: outcome and distance to zeroing of every position of few men.

A table is a set of men; its rows have dense keys (functions/placement.py). Moves are edges between keys, made by joining the men to
a small relation of steps with the bits that must be empty. Captures and promotions lead to tables of other sets, pawn moves to a
pawn that is nearer to its goal, so tables are solved in stages, each from stages before it: such a move ends the count, and its
worth is looked up. Within a stage a loop over plies joins the frontier, the positions decided one ply before, to the edges that lead
to it. A position is won once an edge leads to a lost one; it is lost once none of its replies is left, of which the loop keeps a
count for every open position. Each ply is written before the next, so what a ply costs is its frontier and the open positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernel as Kn
from ..functions.placement import BITS, ORDER, Men, attacks, bits
from .stored import broadcastable, shared_path, stored

PIECES = "QRBN"
#: Sets of men with their numbers: three men, then two pieces against none, then one against one.
SETS = [Men(k) for k in ORDER] + [Men(a + b) for i, a in enumerate(PIECES) for b in PIECES[i:]] + [Men(a, b) for i, a in enumerate(PIECES) for b in PIECES[i:]]
CODE = {m.name: i for i, m in enumerate(SETS)}
THREE_MEN = tuple(m.name for m in SETS[:5])
ROWS = "key long, wdl int, dtz int, plies int"
#: Plies from which a win is one that the fifty-move rule undoes.
CURSED = 100


def steps(spark: SparkSession, kind: str) -> DataFrame:
    """frm, dest and the bits that must be empty, of every step of a man on an empty board; fewer than 1500 rows a kind."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    if kind == "P":
        rows = [(s, s + 8, signed(1 << s + 8)) for s in range(8, 56)] + [(s, s + 16, 1 << s + 8 | 1 << s + 16) for s in range(8, 16)]
    elif kind in "NK":
        rows = [(s, t, 0) for s in range(64) for t in (Kn.KNIGHT if kind == "N" else Kn.KING)[s]]
    else:
        ways = {"B": Kn.SLANTED, "R": Kn.STRAIGHT, "Q": Kn.STRAIGHT + Kn.SLANTED}[kind]
        rows = [(s, t, signed(sum(1 << x for x in Kn.RAYS[s][d][:i]))) for s in range(64) for d in ways for i, t in enumerate(Kn.RAYS[s][d])]
    return spark.createDataFrame(rows, "frm int, dest int, path long")


def _attacked(men: list[tuple[str, int, str]], king: str, occ: str) -> str:
    return "(" + " OR ".join([attacks(k, color, c, king, occ) for k, color, c in men] or ["false"]) + ")"


def _sides(men: Men) -> tuple[list[tuple[str, int, str]], list[tuple[str, int, str]]]:
    all_ = [(k, color, c) for (k, color), c in zip(men.kinds, men.columns)]
    return [m for m in all_ if m[1] == 0], [m for m in all_ if m[1] == 1]


def with_check(rows: DataFrame, men: Men) -> DataFrame:
    """rows with `legal` (the side that isn't to move isn't in check) and `checked` (the side to move is)."""
    white, black = _sides(men)
    occ = bits(*men.squares)
    rows = rows.selectExpr("*", f"{_attacked(white, 'bk', occ)} AS _w", f"{_attacked(black, 'wk', occ)} AS _b")
    return rows.selectExpr("* EXCEPT (_w, _b)", "NOT CASE WHEN stm = 0 THEN _w ELSE _b END AS legal", "CASE WHEN stm = 0 THEN _b ELSE _w END AS checked")


def positions(spark: SparkSession, men: Men) -> DataFrame:
    """key, stm, squares, checked and slice (rank of the pawn, else 0) of every legal position of the table, each once."""
    low = CODE[men.name] << BITS
    rows = men.placed(spark.range(low, low + men.size()).withColumnRenamed("id", "key"))
    rows = with_check(men.ranked(rows, CODE[men.name], "_own"), men).selectExpr("*", ("m0 div 8" if men.pawn else "0") + " AS slice")
    # written before it is filtered, else the planner repeats the whole unranking in the filter
    return stored(rows, "endgame-positions").where("_own = key AND legal").drop("_own", "legal")


def _led(rows: DataFrame, white: list[tuple[str, str]], black: list[tuple[str, str]], to: str) -> DataFrame:
    """rows with the key of the position of these men (kind, column); null with kings alone. The stronger side is white."""
    if not white and not black:
        return rows.withColumn(to, F.lit(None).cast("long"))
    order = lambda side: sorted(side, key=lambda m: ORDER.index(m[0]))
    white, black = order(white), order(black)
    names = ["".join(k for k, _ in side) for side in (white, black)]
    turned = f"K{names[0]}vK{names[1]}" not in CODE
    if turned:
        white, black = black, white
        names.reverse()
    men = SETS[CODE[f"K{names[0]}vK{names[1]}"]]
    square = (lambda c: f"({c} ^ 56)") if turned else (lambda c: c)
    kings = ("bk", "wk") if turned else ("wk", "bk")
    out = rows.selectExpr(
        *[f"{c} AS _k_{c}" for c in rows.columns], ("1 - stm" if turned else "stm") + " AS stm", f"{square(kings[0])} AS wk", f"{square(kings[1])} AS bk",
        *[f"{square(c)} AS m{i}" for i, (_, c) in enumerate(white + black)],
    )
    out = men.ranked(out, CODE[men.name], "_led")
    return out.selectExpr(*[f"_k_{c} AS {c}" for c in rows.columns], f"_led AS {to}")


def moves(rows: DataFrame, men: Men, *keep: str) -> DataFrame:
    """The kept columns, frm, dest, promo (letter or null), zeroing, and dst: the key after each legal move, null with kings alone."""
    spark = rows.sparkSession
    whole = [(k, color, c) for (k, color), c in zip(men.kinds, men.columns)] + [("K", 0, "wk"), ("K", 1, "bk")]
    led: dict[tuple, list[DataFrame]] = {}  # by the men that are left
    for kind, color, mover in whole:
        own = [c for _, s, c in whole if s == color and c != mover]
        foes = [m for m in whole if m[1] != color and m[0] != "K"]
        king, other = ("wk", "bk") if color == 0 else ("bk", "wk")
        went = rows.where(f"stm = {color}").join(F.broadcast(steps(spark, kind)), F.col(mover) == F.col("frm"))
        went = went.where(f"(path & {bits(*men.squares)}) = 0 AND dest NOT IN ({', '.join([*own, other])})")
        for caught in [None, *foes] if kind != "P" else [None]:
            part = went.where(f"dest = {caught[2]}" if caught else f"dest NOT IN ({', '.join(c for _, _, c in foes)})" if foes else "true")
            part = part.selectExpr(*keep, "frm", "dest", "1 - stm AS stm", *[("dest AS " if c == mover else "") + c for c in men.squares])
            left = [m for m in whole if m != caught and m[0] != "K"]
            occ = bits("wk", "bk", *[c for _, _, c in left])
            part = part.where(f"NOT {attacks('K', 0, 'wk', 'bk', '0L')} AND NOT {_attacked([m for m in left if m[1] != color], king, occ)}")
            for promo in [None, *PIECES] if kind == "P" else [None]:
                # a pawn on the last rank is another man
                some = part.where("dest >= 56" if promo else "dest < 56") if kind == "P" else part
                sides = tuple(tuple((promo if promo and c == mover else k, c) for k, s, c in left if s == side) for side in (0, 1))
                some = some.select("*", F.lit(promo.lower() if promo else None).cast("string").alias("promo"), F.lit(bool(caught or kind == "P")).alias("zeroing"))
                led.setdefault(sides, []).append(some)
    out = [_led(_union(parts), *map(list, sides), "dst").select(*keep, "frm", "dest", "promo", "zeroing", "dst") for sides, parts in led.items()]
    return _union(out)


def needed(names: tuple[str, ...]) -> list[list[tuple[str, int | None]]]:
    """Stages of (set, rank of its pawn or null), each leading to earlier ones alone, for the sets and all that they lead to."""
    todo, have = list(names), set()
    while todo:
        men = SETS[CODE[todo.pop()]]
        if men.name not in have:
            have.add(men.name)
            if men.pawn:
                todo += [f"K{k}vK" for k in PIECES]
            elif len(men.kinds) == 2:
                todo += [f"K{k}vK" for k in men.white + men.black]
    pieces = lambda n: [(m.name, None) for m in SETS if m.name in have and not m.pawn and len(m.kinds) == n]
    stages = [pieces(1), *([("KPvK", rank)] for rank in range(6, 0, -1) if "KPvK" in have), pieces(2)]
    return [s for s in stages if s]


def _prepared(spark: SparkSession, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """(key, checked, slice; src, dst, zeroing, slice) of all tables: positions and moves."""
    held, edges = [], []
    for name in names:
        rows = positions(spark, SETS[CODE[name]])
        held.append(rows.select("key", "checked", "slice"))
        edges.append(moves(rows, SETS[CODE[name]], "key", "slice").select(F.col("key").alias("src"), "dst", "zeroing", "slice"))
    return _union(held), stored(_union(edges), "endgame-edges")


def _stage(held: DataFrame, edges: DataFrame, solved: DataFrame | None) -> DataFrame:
    """key, wdl, dtz of the positions (key, checked) of one stage."""
    inner = edges.where("NOT zeroing").select("src", "dst")
    ends = edges.where("zeroing")
    if solved is not None:
        ends = ends.join(solved.select(F.col("key").alias("dst"), "wdl"), "dst", "left")
    else:
        ends = ends.withColumn("wdl", F.lit(0))
    # a zeroing move to a position that isn't won for the other side keeps a position from being lost
    counts = inner.select("src", F.lit(1).alias("n"), F.lit(False).alias("wins")).unionByName(
        ends.select("src", F.when(F.coalesce("wdl", F.lit(0)) > 0, 0).otherwise(1).alias("n"), (F.coalesce("wdl", F.lit(0)) < 0).alias("wins"))
    )
    counts = counts.groupBy(F.col("src").alias("key")).agg(F.sum("n").alias("left"), F.max("wins").alias("wins"))
    state = held.join(counts, "key", "left").where("left IS NOT NULL OR checked").withColumn("won", F.when(F.col("left").isNull(), False))
    level, plies, done = stored(state.drop("checked"), "endgame-ply"), 0, []
    while True:
        found = level.where("won IS NOT NULL").select("key", "won")
        n = found.count()
        if n:
            done.append(found.withColumn("plies", F.lit(plies)))
        elif plies > 1:
            break
        plies += 1
        hits = inner.join(broadcastable(found.select(F.col("key").alias("dst"), "won"), n), "dst")
        hits = hits.groupBy(F.col("src").alias("key")).agg(F.sum(F.when(F.col("won"), 1).otherwise(0)).alias("gone"), F.max(~F.col("won")).alias("beats"))
        open_ = level.where("won IS NULL").join(hits, "key", "left").withColumn("left", F.col("left") - F.coalesce("gone", F.lit(0)))
        beats = F.coalesce("beats", F.lit(False)) | (F.col("wins") if plies == 1 else F.lit(False))
        level = stored(open_.select("key", "left", "wins", F.when(beats, True).when(F.col("left") == 0, False).alias("won")), "endgame-ply")
    out = held.select("key").join(done[0] if len(done) == 1 else _union(done), "key", "left") if done else held.select("key").withColumns({"won": F.lit(None).cast("boolean"), "plies": F.lit(None).cast("int")})
    sign = F.when(F.col("won"), 1).when(~F.col("won"), -1).otherwise(0)
    wdl = sign * F.when(F.col("plies") > CURSED, 1).otherwise(2)
    dtz = F.when(sign == 0, 0).otherwise(sign * F.greatest("plies", F.lit(1)))
    return out.select("key", wdl.cast("int").alias("wdl"), dtz.cast("int").alias("dtz"), F.col("plies").cast("int").alias("plies"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def solve(spark: SparkSession, names: tuple[str, ...] = THREE_MEN, path: str | None = None) -> DataFrame:
    """key, wdl (2 won, 0 drawn, -2 lost for the side to move; 1 and -1 beyond the fifty-move rule), dtz and plies of every legal position
    of the tables and of all that they lead to. plies: to a capture, a pawn move or mate, of the winner's fastest and the loser's slowest
    play; null if drawn. dtz: the same with a sign, negative if lost, -1 too if mated, 0 if drawn. Written to path, a folder a stage."""
    path = path or shared_path(spark, "endgames")
    solved, made = None, {}
    for i, sets in enumerate(needed(names)):
        rank = sets[0][1]
        of = tuple(name for name, _ in sets)
        if of not in made:
            made[of] = _prepared(spark, list(of))
        held, edges = made[of]
        if rank is not None:
            held, edges = held.where(f"slice = {rank}"), edges.where(f"slice = {rank}")
        part = stored(_stage(held.select("key", "checked"), edges, solved), "", f"{path}/stage={i}")
        solved = part if solved is None else solved.unionByName(part)
    return solved


def opened(spark: SparkSession, path: str) -> DataFrame:
    """Tables that solve() wrote."""
    return spark.read.schema(f"{ROWS}, stage int").parquet(path).drop("stage")


_KEPT: dict[tuple, DataFrame] = {}


def tables(spark: SparkSession, names: tuple[str, ...] = THREE_MEN) -> DataFrame:
    """The tables, solved once an application."""
    key = (spark.sparkContext.applicationId, names)
    if key not in _KEPT:
        _KEPT[key] = solve(spark, names)
    return _KEPT[key]
