"""Fixed values.

Column lists, name parts and code tables that have to equal the data contract of the
game-log files and of the tables built from them. They are data, kept in one place and
in their natural order; no logic lives here.
"""

# ---------------------------------------------------------------- fixed values: targets
TARGETS = ["FANTASY_PTS", "PTS", "REB", "AST", "STL", "BLK", "TOV", "3PM"]
PRIMARY_TARGET = "FANTASY_PTS"
ROLLING_WINDOWS = [5, 10, 20]

# ---------------------------------------------------------------- fixed values: game logs
GAME_LOG_INT_COLUMNS = [
    "SEASON_ID", "PLAYER_ID", "TEAM_ID", "GAME_ID", "MIN", "FGM", "FGA", "3PM", "FG3A", "FTM", "FTA",
    "OREB", "DREB", "REB", "AST", "STL", "BLK", "TOV", "PF", "PTS", "PLUS_MINUS", "VIDEO_AVAILABLE",
]
GAME_LOG_DOUBLE_COLUMNS = ["FG_PCT", "FG3_PCT", "FT_PCT", "FANTASY_PTS"]
# Keys need 64 bits when the tables come from elsewhere; the rest are small counts.
LONG_COLUMNS = ["SEASON_ID", "PLAYER_ID", "TEAM_ID", "GAME_ID"]

# ---------------------------------------------------------------- fixed values: lookups
PLAYER_INFO_COLUMNS = [
    "PLAYER_ID", "PLAYER_SLUG", "BIRTHDATE", "SCHOOL", "COUNTRY", "HEIGHT", "WEIGHT", "SEASON_EXP",
    "POSITION", "ROSTERSTATUS", "FROM_YEAR", "TO_YEAR", "DRAFT_YEAR", "DRAFT_ROUND", "DRAFT_PICK",
]
PLAYER_PROFILE_SOURCE_COLUMNS = [
    "PERSON_ID", "DISPLAY_FIRST_LAST", "PLAYER_SLUG", "BIRTHDATE", "SCHOOL", "COUNTRY", "HEIGHT", "WEIGHT",
    "SEASON_EXP", "POSITION", "ROSTERSTATUS", "TEAM_ID", "TEAM_NAME", "TEAM_ABBREVIATION", "FROM_YEAR",
    "TO_YEAR", "DRAFT_YEAR", "DRAFT_ROUND", "DRAFT_NUMBER",
]
PLAYER_PROFILE_RENAMES = {
    "PERSON_ID": "PLAYER_ID",
    "DISPLAY_FIRST_LAST": "PLAYER_NAME",
    "DRAFT_NUMBER": "DRAFT_PICK",
}
OPPONENT_DEFENSE_COLUMNS = [
    "SEASON", "TEAM_ID", "TEAM_NAME", "GP", "W", "L", "W_PCT", "E_DEF_RATING", "DEF_RATING",
    "DEF_RATING_RANK", "PACE", "POSS",
]
OPPONENT_DEFENSE_RENAMES = {
    "TEAM_ID": "opponent_team_id",
    "W_PCT": "opponent_win_pct",
    "DEF_RATING": "opponent_def_rating",
}
TEAM_CODES = {
    "ATL": 1610612737,
    "BOS": 1610612738,
    "CLE": 1610612739,
    "NOP": 1610612740,
    "NOH": 1610612740,
    "NOK": 1610612740,
    "CHI": 1610612741,
    "DAL": 1610612742,
    "DEN": 1610612743,
    "GSW": 1610612744,
    "HOU": 1610612745,
    "LAC": 1610612746,
    "LAL": 1610612747,
    "MIA": 1610612748,
    "MIL": 1610612749,
    "MIN": 1610612750,
    "BKN": 1610612751,
    "NJN": 1610612751,
    "NYK": 1610612752,
    "ORL": 1610612753,
    "IND": 1610612754,
    "PHI": 1610612755,
    "PHX": 1610612756,
    "POR": 1610612757,
    "SAC": 1610612758,
    "SAS": 1610612759,
    "OKC": 1610612760,
    "SEA": 1610612760,
    "TOR": 1610612761,
    "UTA": 1610612762,
    "MEM": 1610612763,
    "WAS": 1610612764,
    "DET": 1610612765,
    "CHA": 1610612766,
}

# ------------------------------------------- fixed values: formats, patterns and constants
NULL_SENTINEL = "NA"
HOME_MARKER = "vs."
AWAY_MARKER = "@"
OPPONENT_PATTERN = r"(?:@|vs\.)\s+([A-Z]{2,3})"
FIRST_GAME = "first_game"
LONG_REST = "3+"
UNKNOWN_REST = "unknown"
UNDRAFTED = "Undrafted"
UNDRAFTED_ROUND = "0"
UNDRAFTED_PICK = 61
DAYS_PER_YEAR = 365.25
FREE_THROW_WEIGHT = 0.44
THREE_POINT_BONUS = 0.5
RECENT_FORM_GAMES = 5
PLAYERS_PER_TEAM = 10
SCORE_WEIGHTS = {
    "current_minutes": 1.0,
    "previous_minutes": 0.7,
    "current_games": 10.0,
    "previous_games": 7.0,
}
MANUAL_WEIGHT = {1642377: 206}
MANUAL_HOW_ACQUIRED = {1630577: "Signed on 02/16/23"}
TEST_SIZE = 0.2
COLLINEAR_THRESHOLD = 0.95
WELL_PREDICTED_R2 = 0.4
MODERATELY_PREDICTED_R2 = 0.2

# ---------------------------------------------------- fixed values: columns kept out of X
IDENTIFIER_COLUMNS = [
    "SEASON_ID", "PLAYER_ID", "PLAYER_NAME", "TEAM_ID", "TEAM_ABBREVIATION", "TEAM_NAME", "GAME_ID",
    "GAME_DATE", "MATCHUP", "PLAYER_SLUG", "opponent_team_id",
]
CATEGORICAL_SOURCE_COLUMNS = [
    "WL", "SEASON", "BIRTHDATE", "SCHOOL", "COUNTRY", "HEIGHT", "POSITION", "ROSTERSTATUS", "DRAFT_YEAR",
    "DRAFT_ROUND", "DRAFT_PICK", "opponent_abbreviation", "days_rest_category",
]
SAME_GAME_RESULT_COLUMNS = [
    "MIN", "FGM", "FGA", "FG_PCT", "FG3A", "FG3_PCT", "FTM", "FTA", "FT_PCT", "OREB", "DREB", "PF",
    "PLUS_MINUS", "VIDEO_AVAILABLE",
    "true_shooting_pct", "effective_fg_pct", "three_point_attempt_rate", "free_throw_attempt_rate",
    "fantasy_pts_change_from_previous", "pts_change_from_previous", "reb_change_from_previous",
    "ast_change_from_previous", "stl_change_from_previous", "blk_change_from_previous",
    "tov_change_from_previous", "3pm_change_from_previous",
]

# ------------------------------------------------------- fixed values: feature families
TIME_SERIES_MARKERS = ["_rolling_", "_lag_", "_season_", "_career_", "_cumulative_"]
CONTEXTUAL_FEATURES = [
    "home_game", "away_game", "days_rest", "opponent_win_pct", "opponent_def_rating", "opponent_recent_form",
]
PLAYER_SPECIFIC_FEATURES = [
    "career_games_played", "season_start_year", "season_number", "age_at_game", "height_inches",
    "draft_pick_numeric", "is_undrafted", "WEIGHT", "SEASON_EXP", "FROM_YEAR", "TO_YEAR",
]
FAMILIES = ["time_series", "contextual", "player_specific", "other"]

# ------------------------------------------------------------ fixed values: report columns
RANGE_COLUMNS = [
    "pts_rolling_5g_avg", "pts_rolling_20g_avg", "fantasy_pts_rolling_5g_avg", "pts_season_min",
    "pts_season_max", "pts_lag_1", "pts_change_from_previous", "3pm_rolling_5g_avg",
]
IMPORTANT_COLUMNS = [
    "home_game", "opponent_abbreviation", "opponent_def_rating", "age_at_game", "height_inches",
    "draft_pick_numeric", "true_shooting_pct", "effective_fg_pct",
]
CORRELATION_ID_COLUMNS = ["SEASON_ID", "PLAYER_ID", "TEAM_ID", "GAME_ID", "VIDEO_AVAILABLE", "opponent_team_id"]
BINARY_COLUMNS = [
    "home_game", "away_game", "is_undrafted", "position_Center", "position_Forward", "position_Guard",
]
ENGINEERED_COLUMNS = [
    "opponent_def_rating", "career_games_played", "season_number", "age_at_game", "height_inches",
    "draft_pick_numeric", "true_shooting_pct", "effective_fg_pct", "three_point_attempt_rate",
    "free_throw_attempt_rate",
]
