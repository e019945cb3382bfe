"""Declared schemas and fixed vocabularies of the batted-ball data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The curated columns, in storage order.
EVENT_COLUMNS = [
    "game_date",
    "events",
    "is_hit",
    "bb_type",
    "zone",
    "plate_x",
    "plate_z",
    "stand",
    "p_throws",
    "launch_speed",
    "launch_angle",
    "bat_speed",
    "swing_length",
    "attack_direction",
    "attack_angle",
    "swing_path_tilt",
    "intercept_ball_minus_batter_pos_x_inches",
    "intercept_ball_minus_batter_pos_y_inches",
    "hc_x",
    "hc_y",
    "hit_distance_sc",
]
KEY_COLUMN = "batted_ball_id"
DATE_COLUMN = "game_date"
LABEL_COLUMN = "is_hit"

# Event outcomes that count as a hit.
HIT_EVENTS = ["single", "double", "triple", "home_run"]
# Ball types, in the order used for display.
BALL_TYPES_DISPLAY_ORDER = ["line_drive", "fly_ball", "ground_ball", "popup"]

# Model features.
CONTACT_NUMERIC = ["plate_x", "plate_z", "launch_speed", "launch_angle"]
SWING_NUMERIC = [
    "bat_speed",
    "swing_length",
    "attack_direction",
    "attack_angle",
    "swing_path_tilt",
    "intercept_ball_minus_batter_pos_x_inches",
    "intercept_ball_minus_batter_pos_y_inches",
]
CATEGORICAL = ["bb_type", "stand", "p_throws"]
REFERENCE_LEVELS = {"bb_type": "ground_ball", "stand": "R", "p_throws": "R"}

MODEL_A_FEATURES = CONTACT_NUMERIC + CATEGORICAL
MODEL_B_FEATURES = CONTACT_NUMERIC + SWING_NUMERIC + CATEGORICAL

# Columns that never enter a model: what they encode is only known after contact, repeats the
# outcome, or is a coarser form of a column that is kept.
EXTRACT_COLUMNS = [KEY_COLUMN, DATE_COLUMN, LABEL_COLUMN, "bb_type", "plate_x", "plate_z",
                   "stand", "p_throws", "launch_speed", "launch_angle", *SWING_NUMERIC]
EXTRACT_REQUIRED = [c for c in EXTRACT_COLUMNS if c != KEY_COLUMN]
REQUIRED_MEASURES = ["launch_speed", "launch_angle"]
NON_FEATURES = [LABEL_COLUMN, DATE_COLUMN, KEY_COLUMN]

# Columns of the two missing-value reports (attack_angle is on neither list).
MISSING_ALWAYS_TRACKED = ["events", "zone", "plate_x", "plate_z", "stand", "p_throws", "launch_speed",
                          "launch_angle", "hc_x", "hc_y", "hit_distance_sc"]
MISSING_SWING = ["bat_speed", "swing_length", "swing_path_tilt", "attack_direction",
                 "intercept_ball_minus_batter_pos_x_inches",
                 "intercept_ball_minus_batter_pos_y_inches"]

# Regular-season windows, both ends inclusive.
SEASON_WINDOWS = [
    (2021, "2021-04-01", "2021-10-03"),
    (2022, "2022-04-07", "2022-10-05"),
    (2023, "2023-03-30", "2023-10-01"),
    (2024, "2024-03-28", "2024-09-30"),
    (2025, "2025-03-27", "2025-09-28"),
]


@dataclass(frozen=True)
class Window:
    """Training dates (inclusive) and the first test date."""

    train_start: str
    train_end: str
    test_start: str


# The split windows of the experiments.
BASELINE_WINDOW = Window("2021-01-01", "2024-12-31", "2025-01-01")
TRACKING_WINDOW = Window("2023-07-14", "2024-12-31", "2025-01-01")
THRESHOLD = 0.5
SAMPLE_SIZE = 1000
SAMPLE_SEED = 100


@dataclass(frozen=True)
class Bounds:
    """Typical range of a measure; a value beyond either side is reported, not removed."""

    column: str
    low: float | None
    high: float | None
    label: str


# Typical contact ranges and the report column of each.
CONTACT_BOUNDS = [
    Bounds("launch_speed", 20.0, None, "percent_launch_speed_below_20mph"),
    Bounds("launch_angle", -80.0, 80.0, "percent_launch_angle_plus_minus_80"),
    Bounds("plate_x", -4.0, 4.0, "percent_plate_x_outside_typical_contact_window"),
    Bounds("plate_z", 0.5, 5.0, "percent_plate_z_outside_typical_contact_window"),
]

# Display names of encoded features; other names are shown as they are.
FEATURE_DISPLAY_NAMES = {
    "numeric__plate_x": "Plate X",
    "numeric__plate_z": "Plate Z",
    "numeric__launch_speed": "Launch Speed",
    "numeric__launch_angle": "Launch Angle",
    "categorical__bb_type_fly_ball": "Fly Ball",
    "categorical__bb_type_line_drive": "Line Drive",
    "categorical__bb_type_popup": "Popup",
    "categorical__stand_L": "LH Batter",
    "categorical__p_throws_L": "LH Pitcher",
}

_TEXT = {"events", "bb_type", "zone", "stand", "p_throws"}
_REQUIRED = {DATE_COLUMN, LABEL_COLUMN, "bb_type"}


def _field(name: str) -> T.StructField:
    if name == DATE_COLUMN:
        kind = T.DateType()
    elif name == LABEL_COLUMN:
        kind = T.BooleanType()
    elif name in _TEXT:
        kind = T.StringType()
    else:
        kind = T.DoubleType()
    return T.StructField(name, kind, name not in _REQUIRED)


EVENT_SCHEMA = T.StructType([_field(c) for c in EVENT_COLUMNS])
TABLE_SCHEMA = T.StructType([T.StructField(KEY_COLUMN, T.LongType(), False), *EVENT_SCHEMA.fields])
# A pitch has no label yet, and most pitches have no ball type.
PITCH_SCHEMA = T.StructType([
    T.StructField(f.name, f.dataType, f.name != DATE_COLUMN)
    for f in EVENT_SCHEMA.fields if f.name != LABEL_COLUMN
])
NUMERIC_COLUMNS = [f.name for f in EVENT_SCHEMA.fields if isinstance(f.dataType, T.DoubleType)]
