"""Settings of a run, passed to the transformations that need them."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Config:
    #: Least rating of both players of an online game.
    min_online_elo: int = 2500
    #: Least base time of a limited game, in seconds.
    min_game_time: int = 180
    #: Least number of plies, as the monthly source counts them.
    min_ply_depth: int = 10
    #: Least number of moves, as the archive source counts them.
    min_archive_moves: int = 10
    #: Ratings above this are errors of the data.
    max_elo: int = 3500
    #: Records with more characters are put aside unread.
    max_record_chars: int = 50 * 1024 * 1024
    with_online_game: bool = True
    generate_fen: bool = True

    @classmethod
    def of_json(cls, text: str) -> "Config":
        """From a JSON object with keys in camel case; keys that are not settings here are passed over."""
        given = json.loads(text)
        names = {"".join([part.capitalize() if i else part for i, part in enumerate(field.name.split("_"))]): field for field in fields(cls)}
        return cls(**{field.name: type(field.default)(given[name]) for name, field in names.items() if name in given})
