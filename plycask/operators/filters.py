"""Predicates of games, as columns over their text or their typed columns.

Each takes the columns it needs, so that over a typed table Spark pushes the comparisons into the scan; the
cheap ones stand first in a conjunction.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plycask.config import Config
from plycask.functions import headers, moves

#: Names of engine events, and of the one event that is left out of the statistics.
ENGINE_EVENT = r"(?i)\[Event .*(TCEC|CCC [Ss]|WCCC|Computer Chess|ICGA)"
EXCLUDED_EVENT = "tcec"
EVALUATED = "[%eval "
#: Ratings of the later, stricter pass over files that were filtered by a lower one.
REFILTER_ELO = 2500


def _at_least(value: Column, least: int) -> Column:
    return F.coalesce(value, F.lit(0)) >= least


def both_rated(white_elo: Column, black_elo: Column, config: Config) -> Column:
    """Both players have at least the rating; a missing rating is 0."""
    return _at_least(white_elo, config.min_online_elo) & _at_least(black_elo, config.min_online_elo)


def _monthly_elo(text: Column, name: str) -> Column:
    return headers.leading_int(headers.header(text, name))


def keep_all(text: Column, config: Config) -> Column:
    """Monthly games: both rated, and enough plies."""
    return both_rated(_monthly_elo(text, "WhiteElo"), _monthly_elo(text, "BlackElo"), config) & (moves.count_plies(text) >= config.min_ply_depth)


def keep_limited(text: Column, config: Config) -> Column:
    """Those of keep_all with enough base time."""
    return (headers.base_seconds(headers.header(text, "TimeControl")) >= config.min_game_time) & keep_all(text, config)


def keep_evaluated(text: Column, config: Config) -> Column:
    """Those of keep_all with an engine's evaluations, whatever their time."""
    return text.contains(EVALUATED) & keep_all(text, config)


def keep_archived(text: Column, config: Config) -> Column:
    """Archive games: both ratings there and high enough, and enough moves by the archive's count."""
    return both_rated(headers.elo(text, "WhiteElo"), headers.elo(text, "BlackElo"), config) & (moves.count_moves(text) >= config.min_archive_moves)


def valid_time_control(time_control: Column, config: Config) -> Column:
    """Not by correspondence, and enough base time; false where it is missing or no number."""
    base = headers.leading_int(F.split_part(time_control, F.lit("+"), F.lit(1)))
    return F.coalesce(~time_control.contains("/") & (base >= config.min_game_time), F.lit(False))


def keep_archived_limited(text: Column, time_control: Column, config: Config) -> Column:
    return valid_time_control(time_control, config) & keep_archived(text, config)


def engine_event(text: Column) -> Column:
    return text.rlike(ENGINE_EVENT)


def excluded(text: Column) -> Column:
    """Whether the text names the excluded event anywhere."""
    return F.lower(text).contains(EXCLUDED_EVENT)


def countable(text: Column) -> Column:
    """Whether a game takes part in the statistics: not excluded, with a decided result and an identifier."""
    result = headers.result(text)
    return ~excluded(text) & result.isNotNull() & (result != "*") & headers.tag(text, "ID").isNotNull()


def sane_elo(max_elo: Column, config: Config) -> Column:
    return max_elo <= config.max_elo


def refiltered(text: Column, least: int = REFILTER_ELO) -> Column:
    """Both ratings at least the constant, whatever the configuration says."""
    return _at_least(_monthly_elo(text, "WhiteElo"), least) & _at_least(_monthly_elo(text, "BlackElo"), least)


def fits(text: Column, config: Config) -> Column:
    return F.length(text) <= config.max_record_chars


def has_players(text: Column) -> Column:
    return text.contains("[White ") & text.contains("[Black ")
