"""Requests, options, board pictures, bit arithmetic and geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import board as B
from ..sources import corpus as C
from . import moves as M
from .positions import CORPUS_CTE, POS_SQL

COMMANDS = (
    (0, "position startpos"),
    (1, "position startpos moves e2e4 e7e5 g1f3"),
    (2, "position fen 8/2p5/3p4/KP5r/1R3p1k/8/4P1P1/8 w - - 0 11"),
    (3, "position fen 7k/7P/6K1/8/3B4/8/8/8 b - - moves h8g8"),
    (4, "go depth 18"),
    (5, "go wtime 60000 btime 55000 winc 1000 binc 900 movestogo 40"),
    (6, "go infinite"),
    (7, "go nodes 100000 mate 3"),
    (8, "go depth 18 searchmoves c6d7 E3E2"),
    (9, "go movetime 250 ponder"),
    (10, "go perft 4"),
    (11, "go"),
    (12, "position   fen 5K2/8/2qk4/2nPp3/3r4/6B1/B7/3R4 w - e6   moves   d5e6"),
)
START = C.POSITIONS[0][0]


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, text: a command for each event, by its key. That binding is synthetic; the commands are fixed and few."""
    held = F.broadcast(spark.createDataFrame(COMMANDS, "n int, text string"))
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("id")).join(held, F.expr(f"id % {len(COMMANDS)} = n")).select("id", "text")


def _by_key(sql: str, table: str, key: str, n: int) -> str:
    """A DuckDB query by id, its rows for each row of a table whose key is the id modulo n."""
    return f"SELECT _t.{key} AS id, _x.* EXCLUDE (id) FROM ({sql}) AS _x JOIN {table} AS _t ON _t.{key} % {n} = _x.id"


def positions_asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position and the moves that a request names."""
    return parse_positions(_requests(spark, sf_dir))


def parse_positions(requests: DataFrame) -> DataFrame:
    """id, fen, moves, n_moves of the requests (id, text) that name a position."""
    rows = requests.withColumn("t", F.trim(F.regexp_replace("text", r"\s+", " "))).where("t LIKE 'position %'")
    body = F.regexp_replace(F.regexp_extract("t", r"^position (?:fen )?(.*?)(?: moves .*)?$", 1), "^startpos$", START)
    return rows.select("id", body.alias("fen"), F.regexp_extract("t", r" moves (.*)$", 1).alias("moves"), F.expr("CASE WHEN t LIKE '% moves %' THEN size(split(regexp_extract(t, ' moves (.*)$', 1), ' ')) ELSE 0 END").alias("n_moves"))


POSITION_SQL = f"""WITH c AS (SELECT id, string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ') AS w FROM {C.values(COMMANDS, "id, text")}), p AS (SELECT id, w, list_position(w, 'moves') AS m FROM c WHERE w[1] = 'position')
SELECT id, CASE WHEN w[2] = 'startpos' THEN '{START}' ELSE array_to_string(w[3:CASE WHEN m IS NULL OR m = 0 THEN len(w) ELSE m - 1 END], ' ') END AS fen,
  CASE WHEN m IS NULL OR m = 0 THEN '' ELSE array_to_string(w[m + 1:], ' ') END AS moves, CAST(CASE WHEN m IS NULL OR m = 0 THEN 0 ELSE len(w) - m END AS INTEGER) AS n_moves FROM p"""
LIMITS = ("wtime", "btime", "winc", "binc", "movestogo", "depth", "nodes", "movetime", "mate", "perft")


def limits_asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits of a request; what follows searchmoves are moves, in lower case."""
    return parse_limits(_requests(spark, sf_dir))


def parse_limits(requests: DataFrame) -> DataFrame:
    """id, limits, flags and searchmoves of the requests (id, text) that start a search."""
    rows = requests.where("text = 'go' OR text LIKE 'go %'").withColumn("head", F.regexp_replace("text", r" searchmoves .*$", ""))
    numbers = [F.coalesce(F.regexp_extract("head", rf" {k} (-?\d+)", 1).try_cast("long"), F.lit(0).cast("long")).alias(k) for k in LIMITS]
    flags = [F.col("head").rlike(rf" {k}( |$)").alias(k) for k in ("infinite", "ponder")]
    return rows.select("id", *numbers, *flags, F.lower(F.regexp_extract("text", r" searchmoves (.*)$", 1)).alias("searchmoves"))


LIMITS_SQL = f"""WITH c AS (SELECT id, string_split(text, ' ') AS w FROM {C.values(COMMANDS, "id, text")}), g AS (SELECT id, w, list_position(w, 'searchmoves') AS s, CASE WHEN coalesce(list_position(w, 'searchmoves'), 0) > 0 THEN w[:list_position(w, 'searchmoves') - 1] ELSE w END AS h FROM c WHERE w[1] = 'go')
SELECT id, {', '.join(f"coalesce(CAST(h[nullif(list_position(h, '{k}'), 0) + 1] AS BIGINT), 0) AS {k}" for k in LIMITS)}, coalesce(list_contains(h, 'infinite'), false) AS infinite, coalesce(list_contains(h, 'ponder'), false) AS ponder,
  CASE WHEN coalesce(s, 0) > 0 THEN lower(array_to_string(w[s + 1:], ' ')) ELSE '' END AS searchmoves FROM g"""
CODES = ((0, "KQK", 0), (1, "KBPKN", 0), (2, "KBPKN", 1), (3, "KRPPPKBN", 0), (4, "KNNKP", 1), (5, "KQvKR", 0))


def endgame_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position that an endgame code names; `color` has the stronger side's letters in lower case if 1."""
    held = F.broadcast(spark.createDataFrame(CODES, "n int, code string, color int"))
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("id")).join(held, F.expr(f"id % {len(CODES)} = n")).drop("n").withColumn("code", F.replace("code", F.lit("v"), F.lit("")))
    rows = rows.withColumn("cut", F.expr("locate('K', code, 2)")).withColumn("weak", F.expr("substr(code, cut)")).withColumn("strong", F.expr("substr(code, 1, cut - 1)"))
    rows = rows.withColumn("weak", F.expr("CASE WHEN color = 0 THEN lower(weak) ELSE weak END")).withColumn("strong", F.expr("CASE WHEN color = 1 THEN lower(strong) ELSE strong END"))
    return rows.selectExpr("id", "concat('8/', weak, 8 - length(weak), '/8/8/8/8/', strong, 8 - length(strong), '/8 w - - 0 10') AS fen")


CODE_SQL = f"""WITH c AS (SELECT id, color, replace(code, 'v', '') AS code FROM {C.values(CODES, "id, code, color")}), s AS (SELECT id, color, regexp_extract(code, '^(K[^K]*)(K.*)$', 1) AS st, regexp_extract(code, '^(K[^K]*)(K.*)$', 2) AS wk FROM c)
SELECT id, '8/' || CASE WHEN color = 0 THEN lower(wk) ELSE wk END || (8 - length(wk)) || '/8/8/8/8/' || CASE WHEN color = 1 THEN lower(st) ELSE st END || (8 - length(st)) || '/8 w - - 0 10' AS fen FROM s"""


def position_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a text of positions without the empty ones, with their words."""
    text = C.asked(spark, sf_dir).select("pos_id", F.concat(F.lit("\n"), "fen", F.lit("\n  \n"), "moves").alias("text"))
    lines = text.select("pos_id", F.posexplode(F.split("text", "\n")).alias("n", "line")).where("trim(line) <> ''")
    return lines.select("pos_id", "line", F.size(F.split(F.trim("line"), r"\s+")).alias("words"))


LINES_SQL = f"""{CORPUS_CTE} l AS (SELECT pos_id, fen AS line FROM corpus UNION ALL SELECT pos_id, moves FROM corpus WHERE moves <> '') SELECT pos_id, line, CAST(len(regexp_split_to_array(trim(line), '\\s+')) AS INTEGER) AS words FROM l"""


def pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the board drawn with ranks and files."""
    rule = "' +---+---+---+---+---+---+---+---+'"
    ranks = ", ".join(f"concat(' | ', array_join(split(replace(substr(board, {8 * r + 1}, 8), '.', ' '), ''), ' | '), ' | {r + 1}'), {rule}" for r in range(7, -1, -1))
    return B.parse(C.asked(spark, sf_dir)).selectExpr("pos_id", f"concat_ws('\\n', {rule}, {ranks}, '   a   b   c   d   e   f   g   h') AS picture")


PICTURE_SQL = f"""{CORPUS_CTE} {B.duck_board("corpus")}, c AS (SELECT pos_id, s // 8 AS r, string_agg(' | ' || coalesce(nullif(substr(board, CAST(s + 1 AS INTEGER), 1), '.'), ' '), '' ORDER BY s) || ' | ' || (s // 8 + 1) AS t FROM brd, (SELECT unnest(range(64)) AS s) GROUP BY pos_id, s // 8)
SELECT pos_id, ' +---+---+---+---+---+---+---+---+' || chr(10) || string_agg(t || chr(10) || ' +---+---+---+---+---+---+---+---+', chr(10) ORDER BY r DESC) || chr(10) || '   a   b   c   d   e   f   g   h' AS picture FROM c GROUP BY pos_id"""


def named_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested move texts that are legal; a position none of whose requested moves is legal gets all its moves."""
    asked = spark.createDataFrame(ASKED, "pos_id long, text string").selectExpr("pos_id", "lower(text) AS uci")
    return M.answered(spark, sf_dir, lambda p: named(M.legal(p, "pos_id", "chess960").selectExpr("pos_id", f"{M.move_text()} AS uci"), asked))


def named(legal: DataFrame, asked: DataFrame) -> DataFrame:
    """pos_id, moves, first: of the legal moves (pos_id, uci) those asked for, or all where none of those asked for is legal; in one pass, so
    that moves are generated once."""
    met = legal.join(F.broadcast(asked.distinct().withColumn("_hit", F.lit(True))), ["pos_id", "uci"], "left")  # a fixed list
    out = met.groupBy("pos_id").agg(F.count("_hit").alias("hits"), F.min(F.when(F.col("_hit"), F.col("uci"))).alias("hit"), F.count(F.lit(1)).alias("all"), F.min("uci").alias("least"))
    return out.select("pos_id", F.when(F.col("hits") > 0, F.col("hits")).otherwise(F.col("all")).alias("moves"), F.coalesce("hit", "least").alias("first"))


ASKED = ((0, "E2E4"), (0, "e2e5"), (1, "e1g1"), (1, "a1a9"), (4, "d4e6"), (5, "zzzz"), (48, "g2g3"))
ASKED_OUT = f""", lg AS (SELECT l.pos_id, {M._SQ.format("l.frm")} || {M._SQ.format("(CASE WHEN l.kind = 3 AND NOT c.chess960 THEN l.kt ELSE l.dest END)")} || coalesce(promo, '') AS uci FROM legal l JOIN corpus c USING (pos_id)),
ask AS (SELECT pos_id, lower(text) AS uci FROM {C.values(ASKED, "pos_id, text")}), n AS (SELECT lg.*, (SELECT count(*) FROM ask JOIN lg b ON b.pos_id = ask.pos_id AND b.uci = ask.uci WHERE ask.pos_id = lg.pos_id) AS named FROM lg)
SELECT pos_id, count(*) AS moves, min(uci) AS first FROM n WHERE named = 0 OR EXISTS (SELECT 1 FROM ask WHERE ask.pos_id = n.pos_id AND ask.uci = n.uci) GROUP BY pos_id"""

#: Bits as squares; words that differ between the engines are filled in.
BITS_TEXT = """SELECT k, CAST(bit_count(b) AS int) AS ones, CAST(b & 72340172838076673 AS bigint) AS file_a, CAST(b & 255 AS bigint) AS rank_1, CAST(SHL(b & 35887507618889599, 9) AS bigint) AS north_east, CAST(SHR(b & 71775015237779198, 9) AS bigint) AS south_west,
  CAST(m % 64 AS int) AS dest, CAST(SHR(m, 6) & 63 AS int) AS frm, CAST(SHR(m, 12) & 3 AS int) AS promo, CAST(SHR(m, 14) & 3 AS int) AS kind, CAST(XOR(s, 56) AS int) AS flipped, CAST(XOR(s, 7) AS int) AS mirrored
FROM (SELECT o_orderkey AS k, CAST(o_orderkey * 104729 % 1000003 * 61680013 % 36028797018963967 AS bigint) AS b, CAST(o_orderkey * 7919 % 65536 AS bigint) AS m, CAST(o_orderkey % 64 AS bigint) AS s FROM ORDERS) AS x"""


def _call(text: str, name: str, to) -> str:
    out = text
    while (i := out.find(name + "(")) >= 0:
        depth, j, comma = 1, i + len(name) + 1, 0
        while depth:
            depth += (out[j] == "(") - (out[j] == ")")
            if out[j] == "," and depth == 1:
                comma = j
            j += 1
        out = out[:i] + to(out[i + len(name) + 1 : comma], out[comma + 1 : j - 1]) + out[j:]
    return out


def _bits() -> str:
    t = _call(BITS_TEXT, "SHL", lambda a, b: f"shiftleft({a},{b})")
    t = _call(t, "SHR", lambda a, b: f"shiftrightunsigned({a},{b})")
    return _call(t, "XOR", lambda a, b: f"(({a}) ^{b})")


#: The same square by square, with division in place of bits.
BITS_SQL = """WITH x AS (SELECT o_orderkey AS k, CAST(o_orderkey * 104729 % 1000003 * 61680013 % 36028797018963967 AS HUGEINT) AS b, o_orderkey * 7919 % 65536 AS m, o_orderkey % 64 AS s FROM orders),
p AS (SELECT CAST(unnest(range(63)) AS INTEGER) AS q), w AS (SELECT q, CAST(pow(2::DOUBLE, q) AS HUGEINT) AS w FROM p),
z AS (SELECT k, count(*) AS ones, sum(CASE WHEN q % 8 = 0 THEN w ELSE 0 END) AS fa, sum(CASE WHEN q < 8 THEN w ELSE 0 END) AS r1, sum(CASE WHEN q % 8 < 7 AND q < 56 THEN w * 512 ELSE 0 END) AS ne, sum(CASE WHEN q % 8 > 0 AND q > 8 THEN w // 512 ELSE 0 END) AS sw
  FROM x, w WHERE b // w % 2 = 1 GROUP BY k)
SELECT x.k, CAST(coalesce(ones, 0) AS INTEGER) AS ones, CAST(coalesce(fa, 0) AS BIGINT) AS file_a, CAST(coalesce(r1, 0) AS BIGINT) AS rank_1, CAST(coalesce(ne, 0) AS BIGINT) AS north_east, CAST(coalesce(sw, 0) AS BIGINT) AS south_west, CAST(m % 64 AS INTEGER) AS dest, CAST(m // 64 % 64 AS INTEGER) AS frm,
  CAST(m // 4096 % 4 AS INTEGER) AS promo, CAST(m // 16384 AS INTEGER) AS kind, CAST((7 - s // 8) * 8 + s % 8 AS INTEGER) AS flipped, CAST(s // 8 * 8 + 7 - s % 8 AS INTEGER) AS mirrored FROM x LEFT JOIN z USING (k)"""


def bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bit counts, masks, shifts and move codes of numbers from each order."""
    return spark.sql(_bits().replace("ORDERS", "{orders}"), orders=spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey"))


OTHER_SQUARE = "(o_orderkey * 37 + o_orderkey * o_orderkey) % 64"


def geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances, lines, squares between and attacks on the empty board for the pair of squares that each order names."""
    pair = f"CAST(o_orderkey % 64 AS int) AS a, CAST({OTHER_SQUARE} AS int) AS b"
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderkey", *pair.split(", ")).where("a <> b").selectExpr("o_orderkey", "a", "b", "abs(a % 8 - b % 8) AS dx", "abs(a div 8 - b div 8) AS dy")
    far = "CASE WHEN dx = 0 OR dy = 0 OR dx = dy THEN greatest(dx, dy) - 1 ELSE 0 END"
    step = "signum(b % 8 - a % 8) + 8 * signum(b div 8 - a div 8)"
    mid = f"transform(filter(sequence(1, 7), n -> n <= {far}), n -> CAST(a + n * ({step}) AS int))"
    return rows.selectExpr("o_orderkey", "a", "b", "CAST(greatest(dx, dy) AS int) AS distance", f"CAST({far} AS int) AS between", f"CAST(coalesce(aggregate({mid}, 0, (s, x) -> s + x), 0) AS int) AS between_sum", "dx * dy = 2 AS knight", "greatest(dx, dy) = 1 AS king", "dx = dy AS bishop", "dx = 0 OR dy = 0 AS rook")


GEOMETRY_SQL = """WITH s AS (SELECT CAST(unnest(range(64)) AS INTEGER) AS q), p AS (SELECT x.q AS a, y.q AS b, abs(x.q % 8 - y.q % 8) AS dx, abs(x.q // 8 - y.q // 8) AS dy FROM s x, s y WHERE x.q <> y.q),
m AS (SELECT a, b, count(*) AS n, sum(q) AS t FROM p, s WHERE (dx = 0 OR dy = 0 OR dx = dy) AND q <> a AND q <> b AND greatest(abs(q % 8 - a % 8), abs(q // 8 - a // 8)) + greatest(abs(q % 8 - b % 8), abs(q // 8 - b // 8)) = greatest(dx, dy)
   AND (q % 8 - a % 8) * (b // 8 - a // 8) = (q // 8 - a // 8) * (b % 8 - a % 8) GROUP BY a, b)
SELECT a, b, CAST(greatest(dx, dy) AS INTEGER) AS distance, CAST(coalesce(n, 0) AS INTEGER) AS "between", CAST(coalesce(t, 0) AS INTEGER) AS between_sum, dx * dy = 2 AS knight, greatest(dx, dy) = 1 AS king, dx = dy AS bishop, dx = 0 OR dy = 0 AS rook FROM p LEFT JOIN m USING (a, b)"""

# Options as (order, name, type, default, least, most).
OPTIONS = (
    (0, "Debug Log File", "string", "", None, None), (1, "NumaPolicy", "string", "auto", None, None), (2, "Threads", "spin", "1", 1, 1024), (3, "Hash", "spin", "16", 1, 33554432), (4, "Clear Hash", "button", "", None, None),
    (5, "Ponder", "check", "false", None, None), (6, "MultiPV", "spin", "1", 1, 256), (7, "Skill Level", "spin", "20", 0, 20), (8, "Move Overhead", "spin", "10", 0, 5000), (9, "nodestime", "spin", "0", 0, 10000),
    (10, "UCI_Chess960", "check", "false", None, None), (11, "UCI_LimitStrength", "check", "false", None, None), (12, "UCI_Elo", "spin", "1320", 1320, 3190), (13, "UCI_ShowWDL", "check", "false", None, None), (14, "SyzygyPath", "string", "", None, None),
    (15, "SyzygyProbeDepth", "spin", "1", 1, 100), (16, "Syzygy50MoveRule", "check", "true", None, None), (17, "SyzygyProbeLimit", "spin", "7", 0, 7), (18, "EvalFile", "string", "", None, None), (19, "EvalFileSmall", "string", "", None, None),
)
SETTINGS = ((0, "multipv", "4"), (1, "MultiPV", "300"), (2, "hash", "x"), (3, "PONDER", "true"), (4, "Ponder", "maybe"), (5, "uci_elo", "2000"), (6, "NoSuch", "1"), (7, "syzygypath", "/tables"), (8, "Skill Level", "-1"))


def options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options after settings in order; names match in any case, values out of range or malformed are ignored."""
    return spark.sql(OPTION_TEXT.replace("OPTS", "{o}").replace("SETS", "{s}"), o=spark.createDataFrame(OPTIONS, "idx int, name string, type string, dflt string, lo int, hi int"), s=spark.createDataFrame(SETTINGS, "n int, name string, value string"))


OPTION_TEXT = """SELECT o.idx, o.name, o.type, coalesce(max(v.value), max(o.dflt)) AS value, count(v.n) AS accepted FROM OPTS AS o LEFT JOIN (
  SELECT s.n, s.value, p.idx, row_number() OVER (PARTITION BY p.idx ORDER BY s.n DESC) AS r FROM SETS AS s JOIN OPTS AS p ON lower(s.name) = lower(p.name)
  WHERE CASE p.type WHEN 'spin' THEN try_cast(s.value AS bigint) BETWEEN p.lo AND p.hi WHEN 'check' THEN s.value IN ('true', 'false') ELSE p.type = 'string' END) AS v ON v.idx = o.idx AND v.r = 1 GROUP BY o.idx, o.name, o.type"""

QUERIES = {
    "s2_position_request": positions_asked, "s4_limits_request": limits_asked, "s6_endgame_codes": endgame_codes, "s7_position_lines": position_lines, "k2_pictures": pictures, "k6_named_moves": named_moves, "p1_bits": bits, "p4_geometry": geometry, "x2_options": options,
}
ORACLE_SQL = {
    "s2_position_request": POSITION_SQL, "s4_limits_request": LIMITS_SQL, "s6_endgame_codes": CODE_SQL, "s7_position_lines": LINES_SQL, "k2_pictures": PICTURE_SQL, "k6_named_moves": POS_SQL + M.DUCK_MOVES + ASKED_OUT,
    "p1_bits": BITS_SQL, "p4_geometry": f"SELECT o_orderkey, _g.* FROM ({GEOMETRY_SQL}) AS _g JOIN orders ON _g.a = o_orderkey % 64 AND _g.b = {OTHER_SQUARE}",
    "x2_options": OPTION_TEXT.replace("OPTS AS o", C.values(OPTIONS, "idx, name, type, dflt, lo, hi") + " AS o").replace("OPTS AS p", C.values(OPTIONS, "idx, name, type, dflt, lo, hi") + " AS p").replace("SETS AS s", C.values(SETTINGS, "n, name, value") + " AS s"),
}
for _name in ("s7_position_lines", "k2_pictures", "k6_named_moves"):
    ORACLE_SQL[_name] = C.by_order(ORACLE_SQL[_name])
for _name, _table, _key, _n in (("s2_position_request", "events", "event_id", len(COMMANDS)), ("s4_limits_request", "events", "event_id", len(COMMANDS)), ("s6_endgame_codes", "orders", "o_orderkey", len(CODES))):
    ORACLE_SQL[_name] = _by_key(ORACLE_SQL[_name], _table, _key, _n)
