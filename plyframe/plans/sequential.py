"""Steps that are sequential within a position, a row a position in Arrow batches; and network features and layers.

Rows are independent, so batches spread over any number of executors; nothing is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import board as B
from ..functions import kernel as K
from ..functions.network import Network, evaluate_both
from ..operators.rows import rows_of, spread
from ..sources import corpus as C
from .positions import CORPUS_CTE

# Forced mates as (id, fen, moves made first, moves allowed at the root, mate in; negative: the side to move is mated).
MATES = (
    (294, "5K2/8/2qk4/2nPp3/3r4/6B1/B7/3R4 w - e6", "", "", 1),
    (304, "2brrb2/8/p7/Q7/1p1kpPp1/1P1pN1K1/3P4/8 b - -", "", "", -1),
    (321, "8/5R2/2K1P3/4k3/8/b1PPpp1B/5p2/8 w - -", "", "c6d7", 2),
    (331, "8/5R2/2K1P3/4k3/8/b1PPpp1B/5p2/8 w - -", "", "c6d7", 2),
    (351, "r1b2r1k/pp1p2pp/2p5/2B1q3/8/8/P1PN2PP/R4RK1 w - - 0 18", "", "", 1),
    (361, "8/5R2/2K1P3/4k3/8/b1PPpp1B/5p2/8 w - -", "c6d7 f2f1q", "", 1),
    (380, "8/5R2/2K1P3/4k3/8/b1PPpp1B/5p2/8 w - -", "c6d7", "e3e2", -1),
)
#: The search of the registered queries: plies, and nodes after which a depth is given up.
DEPTH, NODES = 5, 15_000


def replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3, K1, Q20: positions after their moves, up to the first illegal one, with keys and repetition."""

    def work(r: dict) -> list:
        try:
            b, n = K.Board.parse(r["fen"]).replay(r["moves"].split(), r["chess960"])
        except ValueError as error:
            return [(r["pos_id"], None, 0, None, None, str(error))]
        signed = lambda k: k - (1 << 64) if k >> 63 else k
        return [(r["pos_id"], b.fen(r["chess960"]), n, signed(b.key()), signed(b.probe_key()), None)]

    return rows_of(C.corpus(spark), "pos_id int, fen string, made int, key long, probe_key long, error string", work)


def exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """captures of the corpus that gain at least 0, 100 and -100 in the exchange on their square."""

    def work(r: dict) -> list:
        b = K.Board.parse(r["fen"])
        return [(r["pos_id"], b.text(m, r["chess960"]), *(K.see(b, m, t) for t in (0, 100, -100))) for m in b.moves() if b.cells[m[1]] and m[3] != K.CASTLING]

    return rows_of(spread(C.corpus(spark)), "pos_id int, uci string, gains boolean, gains_100 boolean, loses_100 boolean", work)


def searches(spark: SparkSession, sf_dir: str, depth: int = DEPTH, k: int = 3, nodes: int = NODES) -> DataFrame:
    """The best root moves of each position over material, with the depth that was reached."""

    def work(r: dict) -> list:
        ranked = K.Search(limit=nodes).run(K.Board.parse(r["fen"]), depth, chess960=r["chess960"], k=k)
        return [(r["pos_id"], i + 1, score, " ".join(line), d) for i, (score, line, d) in enumerate(ranked)]

    return rows_of(spread(C.corpus(spark), 4), "pos_id int, rank int, score int, line string, depth int", work)


def forced_mates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H7: fewest moves to a forced mate of the other side, or of the side to move (negative)."""

    def work(r: dict) -> list:
        b, _ = K.Board.parse(r["fen"]).replay(r["moves"].split())
        among = r["among"].split() or None
        if found := K.mate_in(b, 2, among):
            return [(r["id"], found[0])]
        found = K.mated_in(b, 2, among)
        return [(r["id"], -found[0] if found else None)]

    return rows_of(spread(spark.createDataFrame(MATES, "id int, fen string, moves string, among string, mate int")), "id int, mate int", work)


def piece_worth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each piece adds to a position's evaluation, by leaving it out; both networks' parts by bucket need weights."""
    return C.answered(spark, sf_dir, lambda p: worth(B.parse(p)))


def worth(positions: DataFrame) -> DataFrame:
    """The same of parsed positions with pos_id."""
    rows = positions.selectExpr("pos_id", "board", "stm", f"{B.balance()} AS whole", "explode(sequence(0, 63)) AS sq").where("substr(board, sq + 1, 1) NOT IN ('.', 'K', 'k')")
    rows = rows.selectExpr("pos_id", "stm", "sq", "whole", "overlay(board PLACING '.' FROM sq + 1 FOR 1) AS board")
    return rows.selectExpr("pos_id", "sq", f"CAST(whole - ({B.balance()}) AS int) AS worth")


WORTH_SQL = f"""{CORPUS_CTE} {B.duck_board("corpus")} SELECT pos_id, sq, CAST(CASE ptype WHEN 1 THEN 208 WHEN 2 THEN 781 WHEN 3 THEN 825 WHEN 4 THEN 1276 ELSE 2538 END * CASE WHEN color = stm THEN 1 ELSE -1 END AS INTEGER) AS worth FROM pieces WHERE ptype < 6"""

FEATURE = "((sq ^ CASE WHEN ksq % 8 < 4 THEN 7 ELSE 0 END) ^ (56 * side)) + 64 * CASE WHEN ptype = 6 THEN 10 ELSE 2 * (ptype - 1) + CASE WHEN color <> side THEN 1 ELSE 0 END END + 704 * (28 - 4 * ((ksq ^ (56 * side)) div 8) + least(ksq % 8, 7 - ksq % 8))"


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active piece-square features of each position from both sides."""

    def work(p: DataFrame) -> DataFrame:
        men = B.pieces(B.parse(p), "pos_id", "wking", "bking").withColumn("side", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("ksq", F.expr("CASE WHEN side = 0 THEN wking ELSE bking END"))
        return men.selectExpr("pos_id", "side", "sq", f"CAST({FEATURE} AS int) AS feature")

    return C.answered(spark, sf_dir, work)


FEATURE_SQL = f"""{CORPUS_CTE} {B.duck_board("corpus")}, k AS (SELECT pos_id, color AS side, sq AS ksq, CASE WHEN color = 0 THEN sq // 8 ELSE 7 - sq // 8 END AS kr FROM pieces WHERE ptype = 6)
SELECT pos_id, side, sq, CAST((CASE WHEN side = 0 THEN sq // 8 ELSE 7 - sq // 8 END) * 8 + (CASE WHEN ksq % 8 < 4 THEN 7 - sq % 8 ELSE sq % 8 END) + 64 * CASE WHEN ptype = 6 THEN 10 ELSE 2 * (ptype - 1) + CASE WHEN color = side THEN 0 ELSE 1 END END
  + 704 * (28 - 4 * kr + CASE WHEN ksq % 8 < 4 THEN ksq % 8 ELSE 7 - ksq % 8 END) AS INTEGER) AS feature FROM pieces JOIN k USING (pos_id)"""


def _networks(spark: SparkSession):
    """A big and a small synthetic network, broadcast as files; the loader of a task."""
    files = spark.sparkContext.broadcast((Network.synthetic(32, 1).save(), Network.synthetic(16, 2).save()))
    held: list = []

    def load() -> tuple[Network, Network]:
        if not held:
            big, small = (Network.load(x)[0] for x in files.value)
            held.append((big, small.doubled()))
        return held[0]

    return load


def network_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and value of each position by two networks, the small one first where material is far apart. The
    weights are synthetic, of small width, and read back from their file format."""
    load = _networks(spark)

    def work(r: dict) -> list:
        return [(r["pos_id"], *evaluate_both(*load(), K.Board.parse(r["fen"])))]

    return rows_of(C.corpus(spark), "pos_id int, psqt int, positional int, value int, small boolean", work)


def bucket_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The big network's parts by each of its eight stacks, and which one the number of men picks."""
    load = _networks(spark)

    def work(r: dict) -> list:
        b = K.Board.parse(r["fen"])
        own = (sum(c > 0 for c in b.cells) - 1) // 4
        return [(r["pos_id"], i, psqt, positional, i == own) for i, (psqt, positional) in enumerate(load()[0].trace(b))]

    return rows_of(C.corpus(spark), "pos_id int, bucket int, psqt int, positional int, used boolean", work)


QUANT = "CAST(floor(1024 * CAST({} AS double)) AS bigint)"


def dense_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dense layer over quantised embeddings with weights by a rule, then both activations."""
    x = spark.read.parquet(f"{sf_dir}/embeddings.parquet").selectExpr("vec_id", f"transform(embedding, v -> {QUANT.format('v')}) AS x")
    x = x.withColumn("out", F.expr("explode(sequence(0, 15))")).withColumn("y", F.expr("aggregate(transform(x, (v, i) -> v * ((out * 31 + i * 17) % 255 - 127)), CAST(out * 100 AS bigint), (s, v) -> s + v)"))
    return x.selectExpr("vec_id", "out", "y", "greatest(0L, least(127L, shiftright(y, 6))) AS clipped", "least(127L, shiftright(y * y, 19)) AS squared")


DENSE_SQL = f"""WITH x AS (SELECT vec_id, unnest(embedding) AS v, unnest(range(len(embedding))) AS i FROM embeddings), o AS (SELECT CAST(unnest(range(16)) AS INTEGER) AS out),
y AS (SELECT vec_id, out, CAST(out * 100 + sum({QUANT.format('v')} * ((out * 31 + i * 17) % 255 - 127)) AS BIGINT) AS y FROM x, o GROUP BY vec_id, out)
SELECT vec_id, out, y, greatest(0, least(127, CAST(floor(y / 64.0::double) AS BIGINT))) AS clipped, least(127, CAST(floor(CAST(y AS DOUBLE) * y / 524288) AS BIGINT)) AS squared FROM y"""


QUERIES = {
    "s3_replay": replays, "f13_exchange": exchanges, "h1_search": searches, "h7_forced_mates": forced_mates, "k11_piece_worth": piece_worth, "g16_features": features, "e3_network": network_values, "e4_bucket_trace": bucket_trace, "e8_dense_layers": dense_layers,
}
ORACLE_SQL = {
    "h7_forced_mates": "SELECT id, mate FROM " + C.values(MATES, "id, fen, moves, among, mate"),
    "k11_piece_worth": WORTH_SQL, "g16_features": FEATURE_SQL, "e8_dense_layers": DENSE_SQL,
}
for _name in ("k11_piece_worth", "g16_features"):
    ORACLE_SQL[_name] = C.by_order(ORACLE_SQL[_name])
