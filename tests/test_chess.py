import pytest

from plycask.chess.position import START, IllegalMove, Position
from plycask.chess.replay import PgnError, Replayer, full_fens, sans_of


def perft(position, depth):
    return 1 if not depth else sum(perft(after, depth - 1) for after in position.legal())


@pytest.mark.parametrize(
    "fen,counts",
    [
        (START, [20, 400, 8902]),
        ("r3k2r/p1ppqpb1/bn2pnp1/3PN3/1p2P3/2N2Q1p/PPPBBPPP/R3K2R w KQkq - 0 1", [48, 2039]),
        ("8/2p5/3p4/KP5r/1R3p1k/8/4P1P1/8 w - - 0 1", [14, 191, 2812]),
        ("r3k2r/Pppp1ppp/1b3nbN/nP6/BBP1P3/q4N2/Pp1P2PP/R2Q1RK1 w kq - 0 1", [6, 264]),
        ("rnbq1k1r/pp1Pbppp/2p5/8/2B5/8/PPP1NnPP/RNBQK2R w KQ - 1 8", [44, 1486]),
    ],
)
def test_numbers_of_legal_positions(fen, counts):
    assert [perft(Position.of(fen), i + 1) for i in range(len(counts))] == counts


def line(text):
    return Replayer().line(text.split())


def test_known_positions():
    assert line("e4")[-1] == "rnbqkbnr/pppppppp/8/8/4P3/8/PPPP1PPP/RNBQKBNR b KQkq -"
    assert line("d4")[-1] == "rnbqkbnr/pppppppp/8/8/3P4/8/PPP1PPPP/RNBQKBNR b KQkq -"
    assert line("e4 c5")[-1] == "rnbqkbnr/pp1ppppp/8/2p5/4P3/8/PPPP1PPP/RNBQKBNR w KQkq -"
    assert line("e4 e5 Nf3 Nc6 Bb5 a6 Ba4 Nf6 O-O")[-1] == "r1bqkb1r/1ppp1ppp/p1n2n2/4p3/B3P3/5N2/PPPP1PPP/RNBQ1RK1 b kq -"


def test_en_passant_shows_only_where_it_can_be_played():
    assert line("e4 a6 e5 d5")[-1].endswith(" w KQkq d6")
    assert line("e4 a6 e5 d5 exd6")[-1] == "rnbqkbnr/1pp1pppp/p2P4/8/8/8/PPPP1PPP/RNBQKBNR b KQkq -"
    pinned = Position.of("8/8/8/8/k2Pp2Q/8/8/3K4 b - d3 0 1")
    assert pinned.key().endswith(" b - -")  # the capture would open the rank to the queen


@pytest.mark.parametrize("moves", ["e5", "e4 e5 Ke3", "e4 e5 O-O", "Nd2", "e4 e5 Nf3 Nc6 Nxe6", "d4 d5 exd5", "e4 d5 d5", "--", "e8=Q"])
def test_illegal_moves(moves):
    with pytest.raises(PgnError):
        line(moves)


def test_notation():
    two = Position.of("4k3/8/8/8/8/8/8/R3K2R w KQ - 0 1")
    assert two.play("O-O").key() == "4k3/8/8/8/8/8/8/R4RK1 b - -"
    assert two.play("0-0-0").key() == "4k3/8/8/8/8/8/8/2KR3R b - -"
    knights = Position.of("4k3/8/8/8/8/5N2/8/1N2K3 w - - 0 1")
    with pytest.raises(IllegalMove):
        knights.play("Nd2")
    assert knights.play("Nbd2!?").key() == knights.play("Nb1-d2").key()
    promoting = Position.of("1n2k3/P7/8/8/8/8/8/4K3 w - - 0 1")
    assert promoting.play("axb8=N+").key() == "1N2k3/8/8/8/8/8/8/4K3 b - -"
    assert promoting.play("a8Q").key() == "Qn2k3/8/8/8/8/8/8/4K3 b - -"
    with pytest.raises(IllegalMove):
        promoting.play("a8")
    pinned = Position.of("4r1k1/8/8/8/8/8/4N3/4K3 w - - 0 1")
    with pytest.raises(IllegalMove):
        pinned.play("Nc3")


def test_move_text():
    text = "1. e4 $1 {a [%eval 0.1] (b)} e5 (1... c5 (1... c6) 2. Nf3) 2.Nf3 ; rest\n2... Nc6! 1/2-1/2"
    assert sans_of(text) == ["e4", "e5", "Nf3", "Nc6!"]
    with pytest.raises(PgnError):
        sans_of("1. e4 (1. d4")


def test_games():
    replay = Replayer()
    assert len(replay.positions('[Event "x"]\n\n1. e4 e5 1-0')) == 3
    assert len(replay.positions('[Event "x"]\n\n1. e4 e5 2. Nf3 1-0', 1)) == 2
    assert replay.positions('[Event "x"]\n\n1. e4 Ke4 1-0') == []
    setup = '[Event "x"]\n[FEN "4k3/8/8/8/8/8/4P3/4K3 w - - 0 1"]\n\n1. e4 Kd7 1-0'
    assert len(replay.positions(setup)) == 2  # Kd7 is illegal from the standard start
    assert replay.positions('[FEN "nonsense"]\n\n1. e4 1-0') == []


def test_counters():
    sans = "Nf3 Nf6 Ng1 d5 e4 dxe4".split()
    counters = [fen.split()[4:] for fen in full_fens(sans, line("Nf3 Nf6 Ng1 d5 e4 dxe4"))]
    assert counters == [["0", "1"], ["1", "1"], ["2", "2"], ["3", "2"], ["0", "3"], ["0", "3"], ["0", "4"]]
