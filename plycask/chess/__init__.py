"""Rules of chess in plain Python: positions, moves in algebraic notation, and replay of games."""
