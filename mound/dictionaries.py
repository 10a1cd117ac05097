"""Code dictionaries shipped as data.

Each dictionary is a plain ``{code: value}`` mapping.  Operators turn a
dictionary into either a literal ``map`` expression (tiny, fixed size) or
a small dimension DataFrame that is broadcast (its size is the size of
the dictionary, known on the driver).
"""

from __future__ import annotations

from datetime import date

# --- fixed values: must equal the published encodings -----------------------

# Team code -> index, 1..30.
TEAM_INDEX = {
    "TEX": 1, "SEA": 2, "OAK": 3, "HOU": 4, "LAA": 5, "CWS": 6, "CLE": 7, "DET": 8,
    "KC": 9, "MIN": 10, "BAL": 11, "TOR": 12, "BOS": 13, "TB": 14, "NYY": 15, "AZ": 16,
    "SF": 17, "COL": 18, "SD": 19, "LAD": 20, "STL": 21, "CHC": 22, "CIN": 23, "PIT": 24,
    "MIL": 25, "WAS": 26, "ATL": 27, "PHI": 28, "NYM": 29, "MIA": 30,
}

# Plate-appearance outcome -> index.
EVENTS_INDEX = {
    "field_out": 1, "single": 2, "home_run": 3, "strikeout": 4,
    "grounded_into_double_play": 5, "hit_by_pitch": 6, "triple": 7, "force_out": 8,
    "double": 9, "walk": 10, "sac_bunt": 11, "fielders_choice_out": 12,
    "catcher_interf": 13, "truncated_pa": 14, "fielders_choice": 15, "sac_fly": 16,
    "field_error": 17, "double_play": 18, "strikeout_double_play": 19,
    "triple_play": 20, "sac_fly_double_play": 21,
}

# Infield / outfield alignment -> index.
IF_ALIGNMENT_INDEX = {"Standard": 1, "Strategic": 2, "Infield shade": 3}
OF_ALIGNMENT_INDEX = {"Standard": 1, "Strategic": 2, "4th outfielder": 3}

# Half inning -> index.
TOPBOT_INDEX = {"Top": 1, "Bot": 2}

# Pitch result type (in play / strike / ball) -> index.
TYPE_INDEX = {"X": 1, "S": 2, "B": 3}

# Launch speed/angle category -> index; keys are strings as published
# (some carry a trailing dot).  0 means "missing", not zero degrees.
LAUNCH_SPEED_ANGLE_INDEX = {"0": 0, "1.": 1, "2.": 2, "3": 3, "4.": 4, "5.": 5, "6.": 6}

# Pitch type -> index: published empty.
PITCH_TYPE_INDEX: dict[str, int] = {}

# Columns that get a default of 0 when null.
NULL_DEFAULTS = {
    "on_1b": 0, "on_2b": 0, "on_3b": 0,
    "if_fielding_alignment": 0, "of_fielding_alignment": 0, "launch_speed_angle": 0,
}

# Pitch-result merge: when the pitch description is ``hit_into_play`` and the
# plate-appearance outcome is one of these, the outcome wins; otherwise the
# description is kept.
IN_PLAY_OUTCOMES = (
    "field_out", "home_run", "single", "grounded_into_double_play", "triple",
    "force_out", "double", "walk", "sac_bunt",
)

# Outcomes that count as hits.
HIT_EVENTS = ("single", "double", "triple", "home_run")

# Regular-season calendar, 2015-2024 (start and end inclusive).
SEASON_CALENDAR = {
    2015: ("2015-04-05", "2015-10-04"),
    2016: ("2016-04-03", "2016-10-02"),
    2017: ("2017-04-02", "2017-10-01"),
    2018: ("2018-03-29", "2018-09-30"),
    2019: ("2019-03-28", "2019-09-29"),
    2020: ("2020-07-23", "2020-09-27"),
    2021: ("2021-04-01", "2021-10-03"),
    2022: ("2022-04-07", "2022-10-05"),
    2023: ("2023-03-30", "2023-10-01"),
    2024: ("2024-03-20", "2024-09-29"),
}

# Fence distances (feet) of the one park that is described, listed from
# the left-field foul pole to the right-field foul pole.  The park is
# keyed by its home team code.
PARK_FENCES = {
    "PHI": [
        ("Left-Field Foul Pole", 329),
        ("Left-Field Power-Alley", 374),
        ("Monty's Angle", 409),
        ("Monty's Angle", 381),
        ("Monty's Angle", 387),
        ("Right-Field Power-Alley", 369),
        ("Right-Field Foul-Pole", 330),
    ]
}

# Column prune lists of the two cleaning passes.
DROP_COLUMNS_PASS_1 = [
    "Unnamed: 0.1", "Unnamed: 0.2", "Unnamed: 0.3", "Unnamed: 0.4", "Unnamed: 0.5",
    "Unnamed: 0", "player_name", "spin_dir", "spin_rate_deprecated",
    "break_angle_deprecated", "break_length_deprecated", "des", "game_type",
    "tfs_deprecated", "tfs_zulu_deprecated", "umpire", "sv_id",
    "estimated_ba_using_speedangle", "estimated_woba_using_speedangle", "woba_value",
    "woba_denom", "babip_value", "iso_value", "at_bat_number", "pitch_name",
    "estimated_slg_using_speedangle", "hyper_speed", "age_pit_legacy", "age_bat_legacy",
    "n_priorpa_thisgame_player_at_bat", "pitcher_days_since_prev_game",
    "batter_days_since_prev_game", "pitcher_days_until_next_game",
    "batter_days_until_next_game", "api_break_z_with_gravity", "api_break_x_arm",
    "api_break_x_batter_in", "arm_angle",
]
DROP_COLUMNS_PASS_2 = [
    "age_bat_legacy", "age_pit_legacy", "game_type", "spin_rate_deprecated", "arm_angle",
    "api_break_x_batter_in", "api_break_z_with_gravity", "batter_days_until_next_game",
    "pitcher_days_until_next_game", "batter_days_since_prev_game",
    "pitcher_days_since_prev_game", "n_priorpa_thisgame_player_at_bat", "age_bat",
    "hyper_speed", "age_pit", "of_fielding_alignment", "if_fielding_alignment",
    "pitch_name", "iso_value", "woba_value", "babip_value", "woba_denom",
    "tfs_zulu_deprecated", "tfs_deprecated", "game_year", "game_pk", "des",
    "break_angle_deprecated", "break_length_deprecated",
]

# Feature sets of the game-outcome model.
FEATURES_6 = [
    "home_team_index", "away_team_index", "home_avg_hits", "away_avg_hits",
    "home_strikeouts", "away_strikeouts",
]
FEATURES_11 = FEATURES_6 + [
    "avg_exit_velocity", "avg_launch_angle", "home_runs",
    "home_avg_pitch_speed", "away_avg_pitch_speed",
]

# --- end of fixed values -----------------------------------------------------


def season_rows() -> list[tuple[int, date, date]]:
    return [
        (y, date.fromisoformat(a), date.fromisoformat(b))
        for y, (a, b) in sorted(SEASON_CALENDAR.items())
    ]
