"""Position text to columns and back, as expressions over one row.

A board is a string of 64 characters from a1 to h8, '.' where a square is empty. All functions take and return columns, so
parsing is part of whatever stage reads the text: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Piece codes (type, black adds 8) and material values.
CODES = {"P": 1, "N": 2, "B": 3, "R": 4, "Q": 5, "K": 6, "p": 9, "n": 10, "b": 11, "r": 12, "q": 13, "k": 14}
VALUES = {"P": 208, "N": 781, "B": 825, "R": 1276, "Q": 2538, "K": 0}
EMPTY = "." * 64


def board_of(placement: str) -> Column:
    """The board of a placement field: digits are runs of empty squares, ranks come from the eighth down."""
    text = F.col(placement)
    for n in range(8, 0, -1):
        text = F.replace(text, F.lit(str(n)), F.lit("." * n))
    return F.array_join(F.reverse(F.split(text, "/")), "")


def placement_of(board: str) -> Column:
    """The placement field of a board."""
    ranks = [F.substring(board, 8 * r + 1, 8) for r in range(7, -1, -1)]
    text = F.concat_ws("/", *ranks)
    for n in range(8, 0, -1):
        text = F.replace(text, F.lit("." * n), F.lit(str(n)))
    return text


def parse(df: DataFrame, fen: str = "fen") -> DataFrame:
    """df with board, stm (0 white, 1 black), rights (as given), rook_sq (squares of castling rooks), ep_given, rule50, fullmove, game_ply.

    Missing fields read as '-' and 0; any side but 'w' is black. Letters K and Q name the outermost rook of that side, A-H a
    file; a letter without its rook is dropped.
    """
    part = F.split(F.trim(F.col(fen)), r"\s+")
    field = lambda i, other: F.coalesce(F.try_element_at(part, F.lit(i)), F.lit(other))
    df = df.withColumn("_placement", part[0]).withColumn("board", board_of("_placement")).drop("_placement")
    df = df.withColumn("stm", F.when(field(2, "w") == "w", 0).otherwise(1)).withColumn("rights", field(3, "-"))
    df = df.withColumn("ep_given", field(4, "-"))
    df = df.withColumn("rule50", F.coalesce(field(5, "0").try_cast("int"), F.lit(0))).withColumn("fullmove", F.coalesce(field(6, "0").try_cast("int"), F.lit(0)))
    df = df.withColumn("game_ply", F.greatest(2 * (F.col("fullmove") - 1), F.lit(0)) + F.col("stm"))
    rooks = F.expr("""
        filter(transform(filter(split(rights, ''), c -> c <> ''), c -> CASE
            WHEN c = 'K' AND instr(substr(board, 1, 8), 'R') > 0 THEN 8 - instr(reverse(substr(board, 1, 8)), 'R')
            WHEN c = 'Q' AND instr(substr(board, 1, 8), 'R') > 0 THEN instr(substr(board, 1, 8), 'R') - 1
            WHEN c = 'k' AND instr(substr(board, 57, 8), 'r') > 0 THEN 64 - instr(reverse(substr(board, 57, 8)), 'r')
            WHEN c = 'q' AND instr(substr(board, 57, 8), 'r') > 0 THEN 55 + instr(substr(board, 57, 8), 'r')
            WHEN c BETWEEN 'A' AND 'H' AND substr(board, ascii(c) - 64, 1) = 'R' THEN ascii(c) - 65
            WHEN c BETWEEN 'a' AND 'h' AND substr(board, ascii(c) - 40, 1) = 'r' THEN ascii(c) - 41
            END), x -> x IS NOT NULL)""")
    df = df.withColumn("rook_sq", rooks)
    df = df.withColumn("wking", F.instr("board", "K") - 1).withColumn("bking", F.instr("board", "k") - 1)
    df = df.withColumn("wk", F.expr("array_max(filter(rook_sq, x -> x < 8 AND x > wking))")).withColumn("wq", F.expr("array_min(filter(rook_sq, x -> x < 8 AND x < wking))"))
    df = df.withColumn("bk", F.expr("array_max(filter(rook_sq, x -> x > 55 AND x > bking))")).withColumn("bq", F.expr("array_min(filter(rook_sq, x -> x > 55 AND x < bking))"))
    mask = F.lit(0)
    for bit, side in ((1, "wk"), (2, "wq"), (4, "bk"), (8, "bq")):
        mask = mask + F.when(F.col(side).isNotNull(), bit).otherwise(0)
    return df.withColumn("castling", mask).withColumn("ep", ep_kept()).drop("rook_sq")


def ep_kept() -> Column:
    """The en passant square, if a pawn of the side to move attacks it, an enemy pawn stands in front and it and the square behind are empty."""
    return F.expr("""
        CASE WHEN ep_given RLIKE '^[a-h][36]$' AND substr(ep_given, 2, 1) = CASE WHEN stm = 0 THEN '6' ELSE '3' END THEN
            CASE WHEN substr(board, ascii(ep_given) - 96 + 8 * CASE WHEN stm = 0 THEN 5 ELSE 2 END, 1) = '.'
                  AND substr(board, ascii(ep_given) - 96 + 8 * CASE WHEN stm = 0 THEN 6 ELSE 1 END, 1) = '.'
                  AND substr(board, ascii(ep_given) - 96 + 8 * CASE WHEN stm = 0 THEN 4 ELSE 3 END, 1) = CASE WHEN stm = 0 THEN 'p' ELSE 'P' END
                  AND ((ascii(ep_given) > 97 AND substr(board, ascii(ep_given) - 97 + 8 * CASE WHEN stm = 0 THEN 4 ELSE 3 END, 1) = CASE WHEN stm = 0 THEN 'P' ELSE 'p' END)
                    OR (ascii(ep_given) < 104 AND substr(board, ascii(ep_given) - 95 + 8 * CASE WHEN stm = 0 THEN 4 ELSE 3 END, 1) = CASE WHEN stm = 0 THEN 'P' ELSE 'p' END))
                 THEN ascii(ep_given) - 97 + 8 * CASE WHEN stm = 0 THEN 5 ELSE 2 END END
        END""")


def square_text(sq: str) -> str:
    """SQL text of a square's name."""
    return f"concat(char(97 + ({sq}) % 8), char(49 + ({sq}) div 8))"


def write() -> Column:
    """The FEN text of parsed columns. Castling rooks are named by file if chess960 is set."""
    return F.expr(f"""
        concat_ws(' ', placement, CASE WHEN stm = 0 THEN 'w' ELSE 'b' END,
            CASE WHEN castling = 0 THEN '-' ELSE concat(
                CASE WHEN wk IS NOT NULL THEN CASE WHEN chess960 THEN char(65 + wk) ELSE 'K' END ELSE '' END,
                CASE WHEN wq IS NOT NULL THEN CASE WHEN chess960 THEN char(65 + wq) ELSE 'Q' END ELSE '' END,
                CASE WHEN bk IS NOT NULL THEN CASE WHEN chess960 THEN char(41 + bk) ELSE 'k' END ELSE '' END,
                CASE WHEN bq IS NOT NULL THEN CASE WHEN chess960 THEN char(41 + bq) ELSE 'q' END ELSE '' END) END,
            CASE WHEN ep IS NULL THEN '-' ELSE {square_text("ep")} END,
            cast(rule50 AS string), cast(1 + (game_ply - stm) div 2 AS string))""")


def pieces(df: DataFrame, *keep: str) -> DataFrame:
    """A row a piece: the kept columns, sq, ch (its letter), color, ptype."""
    df = df.select(*keep, "board", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("sq")).withColumn("ch", F.expr("substr(board, sq + 1, 1)")).where("ch <> '.'").drop("board")
    return df.withColumn("color", F.when(F.col("ch") == F.upper("ch"), 0).otherwise(1)).withColumn("ptype", F.expr("instr('PNBRQK', upper(ch))"))


def count_of(letter: str) -> str:
    """SQL text: how often a letter stands on the board."""
    return f"(64 - length(replace(board, '{letter}', '')))"


def balance() -> str:
    """SQL text: material of the side to move less that of the other."""
    total = " + ".join(f"{v} * ({count_of(k)} - {count_of(k.lower())})" for k, v in VALUES.items() if v)
    return f"CASE WHEN stm = 0 THEN {total} ELSE -({total}) END"


#: The same in DuckDB, for oracles: relations fenp (fields), brd (board and side) and pieces over a relation of pos_id, fen.
def duck_board(source: str, key: str = "pos_id", extra: str = "") -> str:
    placement = "f[1]"
    for n in range(8, 0, -1):
        placement = f"replace({placement}, '{n}', '{'.' * n}')"
    return f"""
fenp AS (SELECT {key}{extra}, regexp_split_to_array(trim(fen), '\\s+') AS f FROM {source}),
brd AS (SELECT {key}{extra}, array_to_string(list_reverse(string_split({placement}, '/')), '') AS board,
               CASE WHEN f[2] = 'w' THEN 0 ELSE 1 END AS stm, coalesce(f[3], '-') AS rights, coalesce(f[4], '-') AS ep_given,
               coalesce(try_cast(f[5] AS INTEGER), 0) AS rule50, coalesce(try_cast(f[6] AS INTEGER), 0) AS fullmove FROM fenp),
pieces AS (SELECT {key}{extra}, stm, sq, substr(board, CAST(sq AS INTEGER) + 1, 1) AS ch,
                  CASE WHEN substr(board, CAST(sq AS INTEGER) + 1, 1) = upper(substr(board, CAST(sq AS INTEGER) + 1, 1)) THEN 0 ELSE 1 END AS color,
                  instr('PNBRQK', upper(substr(board, CAST(sq AS INTEGER) + 1, 1))) AS ptype
           FROM brd, (SELECT CAST(unnest(range(64)) AS INTEGER) AS sq) WHERE substr(board, CAST(sq AS INTEGER) + 1, 1) <> '.')"""
