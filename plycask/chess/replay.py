"""Replay of games from their PGN text to the positions that they pass."""

from __future__ import annotations

import re

from plycask.chess.position import START, IllegalMove, Position

_HEADER = re.compile(r'^\s*\[(\w+)\s+"((?:[^"\\]|\\.)*)"\]\s*$')
_NOISE = re.compile(r"\{[^}]*\}|;[^\n]*|\$\d+|(?m:^%[^\n]*)")
_NUMBER = re.compile(r"\d+\.+|\.{2,}")
RESULTS = ("1-0", "0-1", "1/2-1/2", "*")
START_KEY = " ".join(START.split()[:4])


class PgnError(ValueError):
    """A text that is no valid game; the message up to the first colon is the class of the error."""


def headers_and_moves(pgn: str) -> tuple[dict[str, str], str]:
    """The tags, in order, and the move text behind them."""
    headers: dict[str, str] = {}
    lines = pgn.replace("\r\n", "\n").split("\n")
    at = 0
    while at < len(lines):
        match = _HEADER.match(lines[at])
        if match:
            headers[match[1]] = match[2]
        elif lines[at].strip():
            break
        at += 1
    return headers, "\n".join(lines[at:])


def _without_variations(text: str) -> str:
    if "(" not in text:
        return text
    out, depth = [], 0
    for c in text:
        if c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
            if depth < 0:
                raise PgnError("Unbalanced variation: )")
        elif not depth:
            out.append(c)
    if depth:
        raise PgnError("Unbalanced variation: (")
    return "".join(out)


def sans_of(movetext: str) -> list[str]:
    """The moves of the main line, without comments, variations, glyphs, numbers and the result."""
    text = _without_variations(_NOISE.sub(" ", movetext))
    if "{" in text or "}" in text:
        raise PgnError("Unbalanced comment: {")
    tokens = _NUMBER.sub(" ", text).split()
    out = []
    for token in tokens:
        if token in RESULTS:
            break
        out.append(token)
    return out


class Replayer:
    """Positions along lines of moves; steps from positions that were met before are remembered, up to a number of them."""

    def __init__(self, remembered: int = 200_000):
        self.after: dict[tuple[str, str], str] = {}
        self.remembered = remembered

    def step(self, key: str, san: str) -> str:
        """The first four FEN fields after a move; raises IllegalMove."""
        found = self.after.get((key, san))
        if found is None:
            found = Position.of(key).play(san).key()
            if len(self.after) >= self.remembered:
                self.after.clear()
            self.after[key, san] = found
        return found

    def line(self, sans: list[str], key: str = START_KEY) -> list[str]:
        """The position before the first move and after each; raises PgnError at an illegal one."""
        keys = [key]
        for san in sans:
            try:
                key = self.step(key, san)
            except IllegalMove as e:
                raise PgnError(f"Invalid move in PGN: {san}") from e
            keys.append(key)
        return keys

    def load(self, pgn: str) -> tuple[dict[str, str], list[str], str]:
        """Tags, moves and first position of a valid game; raises PgnError."""
        headers, movetext = headers_and_moves(pgn)
        sans = sans_of(movetext)
        key = START_KEY
        if "FEN" in headers:
            try:
                key = Position.of(headers["FEN"]).key()
            except ValueError as e:
                raise PgnError(f"Invalid FEN: {headers['FEN']}") from e
        self.line(sans, key)
        return headers, sans, key

    def positions(self, pgn: str, max_ply: int | None = None) -> list[str]:
        """The positions of a game, always replayed from the standard start: none if the game is not valid,
        and those up to the first move that is illegal there if it was set up from another position."""
        try:
            _, sans, _ = self.load(pgn)
        except PgnError:
            return []
        keys, key = [START_KEY], START_KEY
        for san in sans[:max_ply]:
            try:
                key = self.step(key, san)
            except IllegalMove:
                break
            keys.append(key)
        return keys


def full_fens(sans: list[str], keys: list[str]) -> list[str]:
    """The positions with their counters: half moves since a capture or pawn move, and the move's number."""
    out, half, number = [f"{keys[0]} 0 1"], 0, 1
    for i, (san, key) in enumerate(zip(sans, keys[1:], strict=True)):
        half = 0 if san[0] in "abcdefgh" or "x" in san else half + 1
        number += i % 2
        out.append(f"{key} {half} {number}")
    return out
