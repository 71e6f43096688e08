"""Kernel and relational generators against each other and against known counts; text, keys, formats."""

import io
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plyframe.functions import board as B
from plyframe.functions import endgames as E
from plyframe.functions import kernel as K
from plyframe.functions import network as N
from plyframe.functions import score as S
from plyframe.functions import zobrist as Z
from plyframe.plans import moves as M
from plyframe.sources import corpus as C


@pytest.mark.parametrize("row", [r for r in C.PERFT if r[3] < 100_000], ids=lambda r: str(r[0]))
def test_kernel_counts_known_trees(row):
    _, fen, depth, leaves, _ = row
    assert K.perft(K.Board.parse(fen), depth) == leaves


def test_relational_moves_equal_kernel_moves(spark):
    rows = M.legal(B.parse(C.corpus(spark)), "pos_id", "chess960").selectExpr("pos_id", f"{M.move_text()} AS uci", "after").collect()
    got = {}
    for r in rows:
        got.setdefault(r["pos_id"], {})[r["uci"]] = r["after"]
    for i, (fen, _, chess960) in enumerate(C.POSITIONS):
        b = K.Board.parse(fen)
        expected = {b.text(m, chess960): "".join(K.LETTERS.get(c, ".") for c in b.after(m).cells) for m in b.moves()}
        assert got.get(i, {}) == expected, fen


def test_relational_tree_equals_kernel_tree(spark):
    got = {r["id"]: r["n"] for r in M.perft(M.perft_positions(spark, deep=True), 2).groupBy("id").agg({"leaves": "sum"}).withColumnRenamed("sum(leaves)", "n").collect()}
    assert got == {i: K.perft(K.Board.parse(fen), 2) for i, fen, _ in C.PERFT_DEEP}


def test_relational_tree_by_plies_written_out(spark):
    i, fen, depth, leaves, _ = C.PERFT[0]
    rows = M.perft(B.parse(spark.createDataFrame([(i, fen)], "id int, fen string")), depth, spread=4, cut=True)
    assert sum(r["leaves"] for r in rows.collect()) == leaves


def test_successors_keep_en_passant_only_if_legal(spark):
    fens = ["8/8/8/8/k2Pp2Q/8/8/3K4 w - - 0 1", "4k3/8/8/8/4p3/8/3P4/4K3 w - - 0 1", "4k3/8/8/8/1q6/8/3P4/4K3 w - - 0 1"]
    base = B.parse(spark.createDataFrame(list(enumerate(fens)), "pos_id int, fen string"))
    rows = M.successors(M.legal(base, "pos_id"), "pos_id").select("pos_id", "board", "ep").collect()
    got = sorted((r["pos_id"], r["board"], r["ep"]) for r in rows)
    expected = []
    for i, fen in enumerate(fens):
        b = K.Board.parse(fen)
        for m in b.moves():
            a = b.after(m)
            expected.append((i, "".join(K.LETTERS.get(c, ".") for c in a.cells), a.ep))
    assert got == sorted(expected, key=lambda x: (x[0], x[1]))


def test_keys_equal_known_keys():
    # goldens from the rule by an independent program
    assert K.Board.parse(C.POSITIONS[0][0]).key() == 0x8F8F01D4562F59FB
    assert K.Board.parse("8/2p5/3p4/KP5r/1R3p1k/8/4P1P1/8 w - - 0 11").key() == 0xC5F0C6634A313C2C
    assert Z.tables()[1]["side", 0] == 0xA0F520A4C9FA5BCC


def test_relational_keys_equal_kernel_keys(spark):
    rows = Z.keys(B.parse(C.corpus(spark)), spark, "pos_id").collect()
    for r in rows:
        b = K.Board.parse(C.POSITIONS[r["pos_id"]][0])
        assert (r["key"] & Z.M64, r["probe_key"] & Z.M64) == (b.key(), b.probe_key())


def test_text_round_trip():
    for fen, moves, chess960 in C.POSITIONS:
        b, made = K.Board.parse(fen).replay(moves.split(), chess960)
        assert made == len(moves.split())
        assert K.Board.parse(b.fen(chess960)).fen(chess960) == b.fen(chess960)


@pytest.mark.parametrize("fen", ["", "8/8/8/8/8/8/8/8 w - - 0 1", "9/8/8/8/8/8/8/K1k5 w", "K1k5/8 w - -", "xyz"])
def test_bad_positions_are_refused(fen):
    with pytest.raises(ValueError):
        K.Board.parse(fen)


def test_castling_letter_without_a_rook_is_dropped(spark):
    row = B.parse(spark.createDataFrame([("4k3/8/8/8/8/8/8/4K2R w KQkq - 0 1",)], "fen string")).first()
    assert (row["castling"], row["wk"], row["wq"]) == (1, 7, None)
    assert K.Board.parse("4k3/8/8/8/8/8/8/4K2R w KQkq - 0 1").rooks == {1: 7}


def test_replay_stops_at_the_first_illegal_move():
    b, made = K.Board.parse(C.POSITIONS[0][0]).replay(["e2e4", "e2e4", "d7d5"])
    assert made == 1 and b.stm == 1


def test_exchange_by_full_search():
    """see() against a search of the exchange on maps of squares, with the rule for pins in its own words."""

    def sees(men, sq, to):
        """Whether the piece on sq attacks to."""
        kind, dx, dy = men[sq].lower(), to % 8 - sq % 8, to // 8 - sq // 8
        far = max(abs(dx), abs(dy))
        if kind == "p":
            return abs(dx) == 1 and dy == (1 if men[sq] == "P" else -1)
        if kind == "n":
            return abs(dx * dy) == 2
        if kind == "k":
            return far == 1
        if not far or not ((kind in "rq" and dx * dy == 0) or (kind in "bq" and abs(dx) == abs(dy))):
            return False
        return not any(sq + i * (dx // far + 8 * (dy // far)) in men for i in range(1, far))

    def tied(men, white):
        """Shields of a king, and what pins them: what would attack it without that one man, other sliders left out."""
        king = next(s for s, c in men.items() if c == ("K" if white else "k"))
        lines = [s for s, c in men.items() if c.isupper() != white and c.lower() in "brq" and sees({s: c, king: "K"}, s, king)]
        out = set(), set()
        for s in lines:
            bare = {x: c for x, c in men.items() if x not in lines or x == s}
            own = [x for x in bare if bare[x].isupper() == white and x not in (king, s) and not sees(bare, s, king) and sees({y: c for y, c in bare.items() if y != x}, s, king)]
            for x in own:
                out[0].add(x)
                out[1].add(s)
        return out

    def gain(men, to, white, held, worth):
        """What the side to move gains on the square, whose last taker is worth that much and isn't on the map."""
        able = [s for s in men if men[s].isupper() == white and sees({**men, to: "X"}, s, to)]
        if held[white][1] & set(men):
            able = [s for s in able if s not in held[white][0]]
        if not able:
            return 0
        s = min(able, key=lambda s: ("pnbrqk".index(men[s].lower()), s))
        rest = {x: c for x, c in men.items() if x != s}
        if men[s].lower() == "k" and any(men[x].isupper() != white and sees({**men, to: "X"}, x, to) for x in men):
            return 0
        return max(0, worth - gain(rest, to, not white, held, K.WORTH[K.CODES[men[s]]]))

    played, rng = [], random.Random(6)
    for fen, _, _ in C.POSITIONS:  # positions of random games too
        b = K.Board.parse(fen)
        for _ in range(6):
            if moves := b.moves():
                b = b.after(rng.choice(moves))
                played.append((b.fen(True), "", True))
    checked = pinned = 0
    for fen, _, _ in (*C.POSITIONS, *played, ("4k1r1/pp2N3/3p2p1/n2Nnpbp/4PP2/Pb4q1/1P2BRPP/R1rQ2K1 w - - 0 23", "", False)):
        b = K.Board.parse(fen)
        men = {s: K.LETTERS[c] for s, c in enumerate(b.cells) if c}
        held = {w: tied(men, w) for w in (True, False)}
        pinned += bool(held[True][0] or held[False][0])
        for m in b.moves():
            if m[3] == K.NORMAL:
                rest = {s: c for s, c in men.items() if s not in m[:2]}
                value = K.WORTH[b.cells[m[1]]] - gain(rest, m[1], b.stm == 1, held, K.WORTH[b.cells[m[0]]])
                assert K.see(b, m, value) and not K.see(b, m, value + 1), (fen, b.text(m))
                checked += 1
    b = K.Board.parse("4k1r1/pp2N3/3p2p1/n2Nnpbp/4PP2/Pb4q1/1P2BRPP/R1rQ2K1 w - - 0 23")
    assert checked > 1000 and pinned > 10 and not K.see(b, b.find("a1b1"), 0)



def test_forced_mates():
    from plyframe.plans.sequential import MATES

    for _, fen, moves, among, mate in MATES:
        b, _ = K.Board.parse(fen).replay(moves.split())
        n, line = K.mate_in(b, 2, among.split() or None) if mate > 0 else K.mated_in(b, 2, among.split() or None)
        assert n == abs(mate) and not b.replay(line)[0].moves()


def test_search_finds_mate_and_draws():
    ranked = K.Search().run(K.Board.parse("7k/5Q2/6K1/8/8/8/8/8 w - - 0 1"), 2)
    assert ranked[0][0] == K.MATE - 1
    assert K.Search().run(K.Board.parse("8/8/8/8/8/6k1/6p1/6K1 w - -"), 2) == []


def test_repetition_of_the_kernel():
    b = K.Board.parse(C.POSITIONS[0][0])
    found = []
    for text in ["g1f3", "g8f6", "f3g1", "f6g8"] * 2:
        b = b.after(b.find(text))
        found.append(b.repetition())
    assert found[3] == 4 and found[7] < 0


def test_queen_and_rook_tables():
    wdl, dtm = E.solve("Q")
    assert dtm.max() == 20 and wdl[0][wdl[0] != E.ILLEGAL].min() == E.WIN  # a queen always mates, in ten at most
    for wk, p, bk in [(46, 13, 63), (0, 9, 63), (27, 36, 0)]:
        if wdl[1, wk, p, bk] != E.ILLEGAL:
            cells = [0] * 64
            cells[wk], cells[p], cells[bk] = 6, 5, 14
            b = K.Board(cells, 1)
            mate = b.in_check() and not b.moves()
            assert (dtm[1, wk, p, bk] == 0 and wdl[1, wk, p, bk] == E.LOSS) == mate
    minor, _ = E.solve("N")
    assert set(np.unique(minor)) <= {E.ILLEGAL, E.DRAW}


def test_rank_of_dtz():
    assert E.rank_of_dtz(5, 0) == 1 << 18 and E.rank_of_dtz(90, 20) == (1 << 17) - 110
    assert E.rank_of_dtz(-5, 0) == -(1 << 18) and E.rank_of_dtz(0, 3) == 0 and E.rank_of_dtz(-60, 0) == -(1 << 17) + 60


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-(1 << 40), 1 << 40)))
def test_leb128_round_trip(values):
    raw = N.write_leb128(np.array(values, dtype=np.int64))
    assert N.read_leb128(io.BytesIO(raw), len(values), np.int64).tolist() == values


def test_network_file_round_trip_and_errors():
    net = N.Network.synthetic(8)
    raw = net.save("made by a rule")
    again, text = N.Network.load(raw)
    assert text == "made by a rule" and again.save(text) == raw
    b = K.Board.parse(C.POSITIONS[4][0])
    assert net.trace(b) == again.trace(b)
    for bad in (raw[:-1], raw + b"x", b"\0\0\0\0" + raw[4:]):
        with pytest.raises(ValueError):
            N.Network.load(bad)


def test_features_are_mirrored_by_colour():
    swap = str.maketrans("PNBRQKpnbrqk", "pnbrqkPNBRQK")
    for fen, _, _ in C.POSITIONS[:20]:
        part = fen.split()
        other = "/".join(reversed(part[0].translate(swap).split("/"))) + (" b" if part[1] == "w" else " w") + " - -"
        x, y = K.Board.parse(fen), K.Board.parse(other)
        assert sorted(N.active(x, 0)) == sorted(N.active(y, 1)) and max(N.active(x, 0)) < N.FEATURES


def test_truncating_division_differs_from_flooring():
    assert S.engine("trunc_div(a + 1, trunc_div(b, 2))", True) == "((a + 1) // (((b) // (2))))"
    assert int(N.trunc(-7, 2)) == -3


def test_reversible_moves():
    from plyframe.plans.tables import reversible_rows

    assert len(reversible_rows()) == len(set(reversible_rows())) == 3668


def test_repetitions_by_windows_equal_the_kernel(spark):
    from plyframe.plans.tables import game_repetitions

    rows = game_repetitions(spark, "").collect()
    assert all(r["repetition"] == r["kernel"] for r in rows) and any(r["kernel"] for r in rows)


def test_table_files(spark, tmp_path):
    from plyframe.sources.files import MAGIC, network_file, table_files

    (tmp_path / "KQvK.rtbw").write_bytes(MAGIC["rtbw"] + bytes(76))
    (tmp_path / "KRvK.rtbz").write_bytes(MAGIC["rtbw"] + bytes(76))
    (tmp_path / "other.txt").write_bytes(b"x")
    got = {r["material"]: r["sound"] for r in table_files(spark, f"{tmp_path}").collect()}
    assert got == {"KQvK": True, "KRvK": False} and table_files(spark, "").count() == 0
    assert network_file(spark, "other.txt", [str(tmp_path)]) == b"x"
    with pytest.raises(FileNotFoundError):
        network_file(spark, "none.bin", [str(tmp_path)])


def test_position_files(spark, tmp_path):
    path = tmp_path / "bench.epd"
    path.write_text("\n" + "\n".join(p[0] for p in C.POSITIONS[:3]) + "\n\n")
    assert [r["fen"] for r in C.read_positions(spark, str(path)).collect()] == [p[0] for p in C.POSITIONS[:3]]
    with pytest.raises(Exception):
        C.read_positions(spark, str(tmp_path / "missing.epd")).collect()
