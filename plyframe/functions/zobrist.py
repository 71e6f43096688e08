"""Position keys: random 64-bit values for pieces on squares, combined by exclusive or.

The values come from a xorshift generator with 64-bit wraparound, so they are made in Python once and held as signed
BIGINTs; Spark only combines them.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .board import CODES, pieces

M64 = (1 << 64) - 1
#: Seed, multiplier and shifts of the generator; multiplier and addend of the congruential hash.
SEED, MULTIPLIER, SHIFTS = 1070372, 2685821657736338717, (12, 25, 27)
LCG = (6364136223846793005, 1442695040888963407)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class Generator:
    """xorshift64*."""

    def __init__(self, seed: int):
        self.s = seed

    def next(self) -> int:
        a, b, c = SHIFTS
        self.s ^= self.s >> a
        self.s ^= self.s << b & M64
        self.s ^= self.s >> c
        return self.s * MULTIPLIER & M64

    def sparse(self) -> int:
        """About an eighth of the bits set."""
        return self.next() & self.next() & self.next()


def lcg(seed: int) -> int:
    return (seed * LCG[0] + LCG[1]) & M64


@lru_cache
def tables() -> tuple[dict, dict]:
    """{(letter, square): key} and {(kind, i): key}. Pawns have no key on the outer ranks, though values are drawn for them."""
    g = Generator(SEED)
    psq = {(ch, sq): g.next() for ch in sorted(CODES, key=CODES.get) for sq in range(64)}
    for ch in "Pp":
        for sq in (*range(8), *range(56, 64)):
            psq[ch, sq] = 0
    extra = {("ep", i): g.next() for i in range(8)}
    extra |= {("castling", i): g.next() for i in range(16)}
    extra["side", 0] = g.next()
    extra["nopawns", 0] = g.next()
    extra |= {("rule50", i): lcg(i) for i in range(16)}
    return psq, extra


def piece_rows() -> list[tuple[str, int, int]]:
    return [(ch, sq, signed(k)) for (ch, sq), k in tables()[0].items()]


def extra_rows() -> list[tuple[str, int, int]]:
    return [(kind, i, signed(k)) for (kind, i), k in tables()[1].items()]


def piece_sql() -> str:
    from ..sources.corpus import values

    return values(piece_rows(), "ch, sq, k")


def extra_sql() -> str:
    from ..sources.corpus import values

    return values(extra_rows(), "kind, i, k")


def _pick(kind: str, index: Column) -> Column:
    """The extra key of that kind at an index, as an array lookup."""
    found = [k for name, _, k in extra_rows() if name == kind]
    return F.element_at(F.array(*[F.lit(k) for k in found]), index + 1)


def keys(positions: DataFrame, spark: SparkSession, *ids: str) -> DataFrame:
    """ids and all keys of parsed positions. One shuffle, of partial results by position."""
    zob = F.broadcast(spark.createDataFrame(piece_rows(), "zch string, zsq int, k long"))
    rows = pieces(positions, *ids, "stm", "castling", "ep", "rule50").join(zob, (F.col("ch") == F.col("zch")) & (F.col("sq") == F.col("zsq")))
    pick = lambda cond: F.bit_xor(F.when(cond, F.col("k")).otherwise(F.lit(0).cast("long")))
    white, pawn = F.col("color") == 0, F.col("ptype") == 1
    held = rows.groupBy(*ids, "stm", "castling", "ep", "rule50").agg(
        F.bit_xor("k").alias("psq"), pick(pawn).alias("pawn"), pick(F.col("ptype").isin(2, 3, 6)).alias("minor_key"),
        pick(white & ~pawn).alias("nonpawn_white_key"), pick(~white & ~pawn).alias("nonpawn_black_key"), F.collect_list("ch").alias("men"),
    )
    x = lambda a, b: a.bitwiseXOR(b)
    zero = F.lit(0).cast("long")
    key = x(F.col("psq"), _pick("castling", F.col("castling")))
    key = x(key, F.when(F.col("ep").isNull(), zero).otherwise(_pick("ep", F.col("ep") % 8)))
    key = x(key, F.when(F.col("stm") == 1, _pick("side", F.lit(0))).otherwise(zero))
    held = held.withColumn("key", key).withColumn("pawn_key", x(F.col("pawn"), _pick("nopawns", F.lit(0))))
    # the n-th piece of a kind takes the key of that kind on square 8 + n
    material = zero
    psq = tables()[0]
    for ch in CODES:
        slots = [signed(psq[ch, 8 + n]) for n in range(16)]
        upto = [0]
        for s in slots:
            upto.append(upto[-1] ^ s)
        n = F.expr(f"size(filter(men, m -> m = '{ch}'))")
        material = x(material, F.element_at(F.array(*[F.lit(u).cast("long") for u in upto]), n + 1))
    held = held.withColumn("material_key", material)
    held = held.withColumn("probe_key", F.when(F.col("rule50") < 14, F.col("key")).otherwise(x(F.col("key"), _pick("rule50", F.expr("cast((greatest(rule50, 14) - 14) div 8 as int)")))))
    return held.select(*ids, "key", "pawn_key", "minor_key", "nonpawn_white_key", "nonpawn_black_key", "material_key", "probe_key")
