"""Schemas of what the sources read and the sinks write."""

RAW_GAMES = "source_file string, block long, seq long, pgn string"
GAMES = (
    "id string, source string, official int, event string, site string, date_raw string, game_date date, white string, black string, "
    "white_elo int, black_elo int, max_elo int, time_control string, base_seconds int, result string, ply_count int, tags map<string,string>, "
    "movetext string, pgn string, source_file string, block long, seq long"
)
POSITIONS = "hash string, fen string, ply int, result string, game_id string, max_elo int, official int, date string"
POSITION_STATS = "hash string, fen string, occurrence long, white long, black long, draw long"
POSITION_INDEX = "hashFen string, fen string, gameId string, maxElo int, official int, date string"
OPENINGS = "eco string, name string, pgn string, fen string, ply int"
QUARANTINE = "pgn string, error string, error_class string"
ARCHIVE = "games array<struct<pgn:string,time_control:string>>"
LEADERBOARD = "leaders array<struct<user:struct<username:string>>>"
ARCHIVE_LIST = "archives array<string>"
