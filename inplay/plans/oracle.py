"""SQL for another engine that gives the results of the registered queries."""

from __future__ import annotations

from inplay.operators.metrics import DIFFERENCE, METRICS, MODEL_A, MODEL_B
from inplay.plans.catalog import (
    CATEGORICAL, CONTACT_NUMERIC, LOAD_RANGE, NUMERIC_B, ROC_THRESHOLDS, ROUND_TRIP, SAMPLE_DRAW, SCAN_RANGE, SCORE_A, SCORE_B, STORED_BEFORE,
)
from inplay.schema import (
    BASELINE_WINDOW, BALL_TYPES_DISPLAY_ORDER, CONTACT_BOUNDS, EVENT_COLUMNS, EXTRACT_COLUMNS, FEATURE_DISPLAY_NAMES,
    HIT_EVENTS, MISSING_ALWAYS_TRACKED, MISSING_SWING, MODEL_B_FEATURES, REFERENCE_LEVELS, SAMPLE_SIZE,
    SEASON_WINDOWS, TRACKING_WINDOW, Window,
)
from inplay.sources.sample_feed import PITCH_COLUMNS, sql_tables

_HITS = ", ".join(f"'{e}'" for e in HIT_EVENTS)
_IN_SEASON = "(" + " OR ".join(
    f"game_date BETWEEN DATE '{a}' AND DATE '{b}'" for _, a, b in SEASON_WINDOWS) + ")"
_MEASURED = "launch_speed IS NOT NULL AND launch_angle IS NOT NULL"
_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in MODEL_B_FEATURES)


def _with(body: str, *ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join([sql_tables(), _EXTRACT, _CLEAN, *ctes]) + "\n" + body


_EXTRACT = (f"modeling_extract AS (SELECT {', '.join(EXTRACT_COLUMNS)} FROM batted_ball_events "
            f"WHERE {_IN_SEASON} AND {_MEASURED})")
_CLEAN = ("clean AS (SELECT "
          + ", ".join(f"coalesce(events IN ({_HITS}), false) AS is_hit" if c == "is_hit" else c for c in EVENT_COLUMNS)
          + " FROM pitches WHERE bb_type IS NOT NULL)")


def _split(window: Window) -> str:
    return (f"CASE WHEN game_date BETWEEN DATE '{window.train_start}' AND DATE '{window.train_end}' THEN 'train' "
            f"WHEN game_date >= DATE '{window.test_start}' THEN 'test' END")


def _tagged(window: Window, source: str = "modeling_extract") -> str:
    return f"tagged AS (SELECT * FROM (SELECT *, {_split(window)} AS split FROM {source}) WHERE split IS NOT NULL)"


def _half_up(part: str, whole: str, factor: int) -> str:
    """part * factor / whole rounded to a whole number, half up, in integers."""
    return f"((2 * {factor} * {part} + {whole}) // (2 * {whole}))"


def _rate(key: str, name: str, table: str = "batted_ball_events", label: str = "is_hit") -> str:
    rate = _half_up("total_hits", "total_bbe", 10_000)
    return (f"SELECT {name}, total_hits, total_bbe, CAST({rate} AS DOUBLE) / 10000 AS bbe_hit_rate FROM ("
            f"SELECT {key} AS {name}, CAST(sum(CAST({label} AS INT)) AS BIGINT) AS total_hits, count(*) AS total_bbe "
            f"FROM {table} GROUP BY 1)")


def _nulls(columns: list[str]) -> str:
    parts = [f"CAST({_half_up(f'count(*) FILTER (WHERE {c} IS NULL)', 'count(*)', 10_000)} AS DOUBLE) / 100 "
             f"AS percent_null_{c}" for c in columns]
    return f"SELECT {_SEASON} AS season, {', '.join(parts)} FROM batted_ball_events GROUP BY 1"


_SEASON = "CAST(year(game_date) AS VARCHAR)"
_MONTH = "CAST(date_trunc('month', game_date) AS DATE)"


def _ranges() -> str:
    parts = ["count(*) AS total_rows"]
    for b in CONTACT_BOUNDS:
        sides = [s for s in (f"{b.column} > {b.high}" if b.high is not None else "",
                             f"{b.column} < {b.low}" if b.low is not None else "") if s]
        parts += [f"round(min({b.column}), 8) AS min_{b.column}", f"round(max({b.column}), 8) AS max_{b.column}",
                  f"round(100.0 * count(*) FILTER (WHERE {' OR '.join(sides)}) / count(*), 8) AS {b.label}"]
    return f"SELECT {', '.join(parts)} FROM batted_ball_events"


_CLEAN_RANGE = f"clean WHERE game_date BETWEEN DATE '{LOAD_RANGE[0]}' AND DATE '{LOAD_RANGE[1]}'"
_STORED_DAYS = f"SELECT DISTINCT game_date FROM batted_ball_events WHERE game_date < DATE '{STORED_BEFORE}'"
_NEW_ROWS = f"SELECT {', '.join(EVENT_COLUMNS)} FROM {_CLEAN_RANGE} AND game_date NOT IN ({_STORED_DAYS})"
_REPORT = (
    f"SELECT game_date, CASE WHEN game_date IN ({_STORED_DAYS}) THEN 'already loaded' "
    "WHEN n IS NULL THEN 'no rows' ELSE 'loaded' END AS status, "
    f"CASE WHEN game_date IN ({_STORED_DAYS}) OR n IS NULL THEN 0 ELSE n END AS loaded_rows FROM ("
    f"SELECT CAST(d AS DATE) AS game_date FROM generate_series(DATE '{LOAD_RANGE[0]}', DATE '{LOAD_RANGE[1]}', "
    f"INTERVAL 1 DAY) t(d)) LEFT JOIN (SELECT game_date, count(*) AS n FROM {_CLEAN_RANGE} GROUP BY 1) "
    "USING (game_date)")

def _schema_cases() -> str:
    """What each expectation must say of the splits as they are, and of those that break it; the rows without a label are counted."""
    names = ["column_order", "required_columns", "no_leakage", "same_features", "numeric", "categorical", "reference_levels", "window_order"]
    shifted = ", ".join(sorted(EXTRACT_COLUMNS[EXTRACT_COLUMNS.index("stand"):]))
    broken = [shifted, "stand", "is_hit", "bat_speed, stand", "bat_speed, p_throws", "launch_speed", "is_hit, launch_speed", "test_start, train_end"]
    rows = [f"('as it is', '{n}', true, '')" for n in [*names, "label_rows"]] + [f"('broken', '{n}', false, '{d}')" for n, d in zip(names, broken)]
    return (f"SELECT * FROM (VALUES {', '.join(rows)}) t(\"case\", \"check\", passed, detail) UNION ALL "
            "SELECT 'broken', 'label_rows', false, 'is_hit ' || count(*) FROM tagged WHERE split = 'train' AND launch_angle = 0")


# ---- features

_TRACK = _tagged(TRACKING_WINDOW)
_MEDIANS = ("medians AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in NUMERIC_B)
            + " FROM tagged WHERE split = 'train')")
_FILLED = ("filled AS (SELECT batted_ball_id, split, " + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in NUMERIC_B)
           + " FROM tagged CROSS JOIN medians)")
_MOMENTS = ("moments AS (SELECT " + ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in NUMERIC_B)
            + " FROM filled WHERE split = 'train')")
# Indicator columns of the feed's levels other than the reference ones.
_LEVELS = {"bb_type": ["fly_ball", "ground_ball", "line_drive", "popup"], "stand": ["L", "R"], "p_throws": ["L", "R"]}
_INDICATORS = ", ".join(
    f"CAST({c} = '{v}' AS DOUBLE) AS categorical__{c}_{v}"
    for c in CATEGORICAL for v in _LEVELS[c] if v != REFERENCE_LEVELS[c])
_FEATURES = (
    "features AS (SELECT unnest([" + ", ".join(f"'numeric__{c}'" for c in NUMERIC_B) + "]) AS feature"
    + "".join(f" UNION ALL SELECT 'categorical__{c}_' || v FROM (SELECT DISTINCT {c} AS v FROM tagged "
              f"WHERE split = 'train' AND {c} IS NOT NULL) WHERE v <> '{REFERENCE_LEVELS[c]}'" for c in CATEGORICAL) + ")")
_NAMES = "CASE feature " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in FEATURE_DISPLAY_NAMES.items()) + " ELSE feature END"


def _mode(column: str) -> str:
    return (f"(SELECT {column} FROM tagged WHERE split = 'train' AND {column} IS NOT NULL "
            f"GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)")


# ---- fitted models: the penalised loss is minimised by gradient steps with momentum over all training rows

_STEPS, _RATE, _MOMENTUM = 1000, "(1e0 / 15e-1)", "95e-2"


def _names(numeric: list[str]) -> list[str]:
    """Feature names in the order of the weights w1, w2, ..."""
    return [f"numeric__{c}" for c in numeric] + [
        f"categorical__{c}_{v}" for c in CATEGORICAL for v in _LEVELS[c] if v != REFERENCE_LEVELS[c]]


def _model(name: str, numeric: list[str], complete: bool = False) -> list[str]:
    """Tables ``weights_{name}``, of one row, and ``scored_{name}``: the test rows with the probability ``p``."""
    rows = f"(SELECT * FROM tagged WHERE {_COMPLETE})" if complete else "tagged"
    middle = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in numeric)
    spread = ", ".join(f"avg(coalesce({c}, m_{c})) AS a_{c}, stddev_pop(coalesce({c}, m_{c})) AS s_{c}" for c in numeric)
    inputs = [f"(coalesce({c}, m_{c}) - a_{c}) / s_{c}" for c in numeric] + [
        f"CAST(coalesce({c}, {_mode(c)}) = '{v}' AS DOUBLE)" for c in CATEGORICAL for v in _LEVELS[c] if v != REFERENCE_LEVELS[c]]
    places = range(len(inputs) + 1)
    margin = " + ".join(["w0"] + [f"w{i} * x{i}" for i in places[1:]])
    slope = ["avg(e) AS g0"] + [f"avg(e * x{i}) + any_value(w{i}) / count(*) AS g{i}" for i in places[1:]]
    move = [f"({_MOMENTUM} * v{i} - {_RATE} * g{i})" for i in places]
    return [
        f"middle_{name} AS (SELECT {middle} FROM {rows} WHERE split = 'train')",
        f"spread_{name} AS (SELECT {spread} FROM {rows} CROSS JOIN middle_{name} WHERE split = 'train')",
        f"inputs_{name} AS MATERIALIZED (SELECT batted_ball_id, bb_type, is_hit, split, CAST(is_hit AS DOUBLE) AS y, "
        + ", ".join(f"{x} AS x{i}" for i, x in enumerate(inputs, 1))
        + f" FROM {rows} CROSS JOIN middle_{name} CROSS JOIN spread_{name})",
        f"train_{name} AS MATERIALIZED (SELECT * FROM inputs_{name} WHERE split = 'train')",
        f"steps_{name} AS (SELECT 0 AS step, " + ", ".join(f"0e0 AS w{i}, 0e0 AS v{i}" for i in places)
        + " UNION ALL SELECT step + 1, " + ", ".join(f"w{i} + {move[i]}, {move[i]}" for i in places)
        + " FROM (SELECT any_value(step) AS step, " + ", ".join(f"any_value(w{i}) AS w{i}, any_value(v{i}) AS v{i}" for i in places)
        + ", " + ", ".join(slope) + f" FROM (SELECT *, 1e0 / (1e0 + exp(-({margin}))) - y AS e FROM train_{name} "
        f"CROSS JOIN steps_{name} WHERE step < {_STEPS})) WHERE step IS NOT NULL)",
        f"weights_{name} AS (SELECT * FROM steps_{name} WHERE step = {_STEPS})",
        f"scored_{name} AS (SELECT batted_ball_id, bb_type, is_hit, 'only' AS model, 1e0 / (1e0 + exp(-({margin}))) AS p "
        f"FROM inputs_{name} CROSS JOIN weights_{name} WHERE split = 'test')",
    ]


def _weights(name: str, numeric: list[str]) -> str:
    return "weights AS (" + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, w{i} AS w FROM weights_{name}" for i, f in enumerate(_names(numeric), 1)) + ")"


_BASE_MODEL = _model("base", CONTACT_NUMERIC)
_BASE_WEIGHTS = _weights("base", CONTACT_NUMERIC)
_TRACK_MODEL = _model("track", NUMERIC_B)
_BOTH_MODELS = [*_model("a", CONTACT_NUMERIC, complete=True), *_model("b", NUMERIC_B, complete=True),
                f"both_models AS (SELECT is_hit, '{MODEL_A}' AS model, p FROM scored_a UNION ALL "
                f"SELECT is_hit, '{MODEL_B}', p FROM scored_b)"]

# ---- metrics

_ONE = f"one AS (SELECT bb_type, is_hit, 'only' AS model, {SCORE_A} AS p FROM modeling_extract)"
_SCORED = (f"scored AS (SELECT *, {SCORE_A} AS p_a, {SCORE_B} AS p_b FROM tagged WHERE split = 'test' AND {_COMPLETE})")
_TWO = (f"two AS (SELECT is_hit, '{MODEL_A}' AS model, p_a AS p FROM scored UNION ALL "
        f"SELECT is_hit, '{MODEL_B}', p_b FROM scored)")


def _curve(source: str) -> str:
    return (
        "per_score AS (SELECT model, p, count(*) FILTER (WHERE is_hit) AS pos, "
        f"count(*) FILTER (WHERE NOT is_hit) AS neg FROM {source} GROUP BY 1, 2),\n"
        "curve AS (SELECT *, CAST(sum(pos) OVER w AS BIGINT) AS tps, CAST(sum(neg) OVER w AS BIGINT) AS fps, "
        "CAST(sum(pos) OVER (PARTITION BY model) AS BIGINT) AS p_all, "
        "CAST(sum(neg) OVER (PARTITION BY model) AS BIGINT) AS n_all, "
        "row_number() OVER w AS i, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg "
        "FROM per_score WINDOW w AS (PARTITION BY model ORDER BY p DESC))")


def _sums(strict: bool) -> str:
    op = ">" if strict else ">="
    return (
        "sums AS (SELECT model, CAST(sum(pos) AS DOUBLE) AS pa, CAST(sum(neg) AS DOUBLE) AS na, "
        f"CAST(coalesce(sum(pos) FILTER (WHERE p {op} 5e-1), 0) AS DOUBLE) AS tp, "
        f"CAST(coalesce(sum(neg) FILTER (WHERE p {op} 5e-1), 0) AS DOUBLE) AS fp, "
        "CAST(coalesce(sum(pos + neg) FILTER (WHERE p >= 5e-1), 0) AS DOUBLE) AS predicted, "
        "sum(p * (pos + neg)) AS p_sum, sum(neg * (tps - pos / 2e0)) AS area, "
        "sum(pos * (tps / CAST(tps + fps AS DOUBLE))) AS steps FROM curve GROUP BY 1),\n"
        "measured AS (SELECT model, pa / (pa + na) AS observed_hit_rate, p_sum / (pa + na) AS expected_hit_rate, "
        "predicted / (pa + na) AS predicted_hits_at_threshold, (tp + na - fp) / (pa + na) AS accuracy, "
        "tp / (tp + fp) AS precision, tp / pa AS recall, (na - fp) / na AS specificity, "
        "2 * tp / (tp + fp + pa) AS f1, area / (pa * na) AS roc_auc, steps / pa AS average_precision FROM sums)")


def _metric_columns(wrap: str = "round({c}, 8)") -> str:
    return ", ".join(f"{wrap.format(c=c)} AS {c}" for c in METRICS)


def _points(where: str = "") -> str:
    return ("SELECT CAST('Infinity' AS DOUBLE) AS threshold, 0e0 AS fpr, 0e0 AS tpr UNION ALL "
            "SELECT round(p, 10), round(CAST(fps AS DOUBLE) / n_all, 10), round(CAST(tps AS DOUBLE) / p_all, 10) "
            f"FROM curve {where}")


_DIFFERENCE = ("difference AS (SELECT * FROM measured UNION ALL SELECT '" + DIFFERENCE + "', "
               + ", ".join(f"b.{c} - a.{c}" for c in METRICS)
               + f" FROM measured a, measured b WHERE a.model = '{MODEL_A}' AND b.model = '{MODEL_B}')")
_LONG = " UNION ALL ".join(
    f"SELECT '{name}' AS metric, round(a.{c}, 8) AS model_a, round(b.{c}, 8) AS model_b, "
    f"round(b.{c} - a.{c}, 8) AS difference FROM measured a, measured b "
    f"WHERE a.model = '{MODEL_A}' AND b.model = '{MODEL_B}'" for c, name in METRICS.items())


def _check(name: str, violations: str) -> str:
    return (f"SELECT '{name}' AS \"check\", v = 0 AS passed, CAST(v AS VARCHAR) || ' violations' AS detail "
            f"FROM (SELECT CAST({violations} AS BIGINT) AS v FROM ")


def _checks(source: str, items: dict[str, str]) -> str:
    return " UNION ALL ".join(f"{_check(n, v)}{source})" for n, v in items.items())


def oracle_sql() -> dict[str, str]:
    columns = ", ".join(EVENT_COLUMNS)
    extract_columns = ", ".join(EXTRACT_COLUMNS)
    base, track = _tagged(BASELINE_WINDOW), _TRACK
    ends = ("SELECT {cols}, 'head' AS part FROM (SELECT * FROM modeling_extract "
            "ORDER BY game_date, batted_ball_id LIMIT 3) "
            "UNION ALL SELECT {cols}, 'tail' FROM (SELECT * FROM modeling_extract "
            "ORDER BY game_date DESC, batted_ball_id DESC LIMIT 3)").format(cols=extract_columns)
    mislabeled = f"count(*) FILTER (WHERE is_hit AND events NOT IN ({_HITS})) AS mislabeled_hits"
    missed = f"count(*) FILTER (WHERE NOT is_hit AND events IN ({_HITS})) AS missed_hits"
    order = "[" + ", ".join(f"'{v}'" for v in BALL_TYPES_DISPLAY_ORDER) + "]"
    some_null = f"count(*) FILTER (WHERE NOT ({_COMPLETE}))"
    return {
        "scan_date_range": _with(
            f"SELECT {', '.join(PITCH_COLUMNS)} FROM pitches "
            f"WHERE game_date BETWEEN DATE '{SCAN_RANGE[0]}' AND DATE '{SCAN_RANGE[1]}'"),
        "clean_batted_balls": _with(f"SELECT {columns} FROM clean"),
        "derive_label": _with(
            f"SELECT events, coalesce(events IN ({_HITS}), false) AS is_hit, count(*) AS observations "
            "FROM pitches GROUP BY 1, 2"),
        "date_spine": _with(
            "SELECT CAST(d AS DATE) AS game_date FROM (SELECT unnest(generate_series(min(game_date), max(game_date), "
            "INTERVAL 1 DAY)) AS d FROM batted_ball_events)"),
        "unloaded_days": _with(f"SELECT game_date, count(*) AS observations FROM ({_NEW_ROWS}) GROUP BY 1"),
        "incremental_load": _with(_NEW_ROWS),
        "load_report": _with(_REPORT),
        "load_total": _with(f"SELECT CAST(sum(loaded_rows) AS BIGINT) AS total_inserted FROM ({_REPORT})"),
        "surrogate_key": _with("SELECT pitch_id, game_date, launch_speed, plate_x, hc_x, hc_y FROM pitches"),
        "assigned_keys": _with(
            "SELECT game_date, n AS observations, CAST(1001 + upto - n AS BIGINT) AS first_key, "
            "CAST(1000 + upto AS BIGINT) AS last_key FROM (SELECT *, sum(n) OVER (ORDER BY game_date) AS upto "
            "FROM (SELECT game_date, count(*) AS n FROM clean GROUP BY 1))"),
        "load_round_trip": _with(
            f"SELECT game_date, CASE WHEN game_date <= DATE '{ROUND_TRIP[0][1]}' THEN 1 ELSE 2 END AS load_number, n AS change, "
            "n AS observations, n AS keys, CAST(1 + upto - n AS BIGINT) AS first_key, CAST(upto AS BIGINT) AS last_key FROM ("
            "SELECT *, sum(n) OVER (ORDER BY game_date) AS upto FROM (SELECT game_date, count(*) AS n FROM clean "
            f"WHERE game_date BETWEEN DATE '{ROUND_TRIP[0][0]}' AND DATE '{ROUND_TRIP[1][1]}' GROUP BY 1))"),
        "published_unloaded_days": _with(
            f"SELECT game_date, count(*) AS observations FROM {_CLEAN_RANGE} AND game_date > DATE '{ROUND_TRIP[0][1]}' GROUP BY 1"),
        "qa_total": _with("SELECT count(*) AS observations FROM batted_ball_events"),
        "qa_date_range": _with(
            "SELECT min(game_date) AS date_of_first_record, max(game_date) AS date_of_last_record FROM batted_ball_events"),
        "qa_daily": _with("SELECT game_date, count(*) AS observations FROM batted_ball_events GROUP BY 1"),
        "qa_monthly": _with(f"SELECT {_MONTH} AS year_month, count(*) AS observations FROM batted_ball_events GROUP BY 1"),
        "qa_yearly": _with(f"SELECT {_SEASON} AS season, count(*) AS observations FROM batted_ball_events GROUP BY 1"),
        "qa_days": _with("SELECT count(DISTINCT game_date) AS total_number_of_days_w_bbe FROM batted_ball_events"),
        "qa_days_by_year": _with(
            f"SELECT {_SEASON} AS season, count(DISTINCT game_date) AS number_of_days_w_bbe "
            "FROM batted_ball_events GROUP BY 1"),
        "qa_hit_rate_daily": _with(_rate("game_date", "game_date")),
        "qa_hit_rate_monthly": _with(_rate(_MONTH, "year_month")),
        "qa_hit_rate_yearly": _with(_rate(_SEASON, "season")),
        "qa_null_core": _with(_nulls(MISSING_ALWAYS_TRACKED)),
        "qa_null_tracking": _with(_nulls(MISSING_SWING)),
        "qa_ranges": _with(_ranges()),
        "qa_mislabeled": _with(f"SELECT {mislabeled} FROM batted_ball_events"),
        "qa_missed": _with(f"SELECT {missed} FROM batted_ball_events"),
        "qa_label_consistency": _with(f"SELECT {mislabeled}, {missed} FROM batted_ball_events"),
        "null_counts": _with(
            "SELECT " + ", ".join(f"count(*) - count({c}) AS {c}" for c in EXTRACT_COLUMNS) + ", "
            + " + ".join(f"count(*) - count({c})" for c in EXTRACT_COLUMNS) + " AS all_columns FROM modeling_extract"),
        "other_table_daily": "SELECT CAST(ts AS DATE) AS day, count(*) AS observations FROM events GROUP BY 1",
        "other_table_monthly_rate": _rate(
            "CAST(date_trunc('month', ts) AS DATE)", "year_month", "events", "event_type = 'purchase'").replace(
            "CAST(event_type = 'purchase' AS INT)", "CAST((event_type = 'purchase') AS INT)"),
        "modeling_extract": _with(f"SELECT {extract_columns} FROM modeling_extract"),
        "load_modeling_extract": _with(f"SELECT {extract_columns} FROM modeling_extract"),
        "season_semi_join": _with(
            "SELECT game_date, events, is_hit, bb_type, launch_speed, launch_angle, hc_x, hc_y FROM batted_ball_events "
            f"WHERE {_MEASURED} AND EXISTS (SELECT 1 FROM (VALUES "
            + ", ".join(f"(DATE '{a}', DATE '{b}')" for _, a, b in SEASON_WINDOWS)
            + ") AS s(season_start, season_end) WHERE game_date BETWEEN season_start AND season_end)"),
        "extract_check": _with(
            f"SELECT t.n AS table_rows, v.n AS view_rows, t.a AS first_date, t.b AS last_date, "
            "t.n = v.n AND t.a = v.a AND t.b = v.b AS same FROM (SELECT count(*) AS n, min(game_date) AS a, "
            f"max(game_date) AS b FROM batted_ball_events WHERE {_IN_SEASON} AND {_MEASURED}) t, "
            "(SELECT count(*) AS n, min(game_date) AS a, max(game_date) AS b FROM modeling_extract) v"),
        "pull_profile": _with(
            "SELECT count(*) AS n_rows, CAST(21 AS BIGINT) AS n_columns, "
            "(SELECT count(*) FROM (SELECT DISTINCT events FROM clean)) AS n_events, "
            "(SELECT count(*) FROM (SELECT DISTINCT bb_type FROM clean)) AS n_bb_types, "
            "round(avg(CAST(events IS NULL AS INT)), 8) AS missing_events, "
            "round(avg(CAST(bb_type IS NULL AS INT)), 8) AS missing_bb_type FROM clean"),
        "pull_distinct_events": _with("SELECT DISTINCT events FROM clean"),
        "pull_distinct_bb_types": _with("SELECT DISTINCT bb_type FROM clean"),
        "extract_profile": _with(
            f"SELECT count(*) AS n_rows, CAST({len(EXTRACT_COLUMNS)} AS BIGINT) AS n_columns, 'boolean' AS label_type, "
            "min(game_date) AS first_date, max(game_date) AS last_date, count(DISTINCT year(game_date)) AS n_years "
            "FROM modeling_extract"),
        "extract_distinct_years": _with(f"SELECT DISTINCT {_SEASON} AS season FROM modeling_extract"),
        "label_value_counts": _with(
            "SELECT is_hit, count(*) AS observations FROM modeling_extract GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"),
        "label_text_counts": _with(
            "SELECT is_hit, CASE WHEN is_hit THEN 'Hit' ELSE 'Non-Hit' END AS label, count(*) AS observations "
            "FROM modeling_extract GROUP BY 1, 2"),
        "head_tail": _with(ends),
        "sample_n": _with(
            "SELECT batted_ball_id, launch_angle, launch_speed, CASE WHEN is_hit THEN 'Hit' ELSE 'Non-Hit' END AS label "
            f"FROM modeling_extract ORDER BY {SAMPLE_DRAW}, batted_ball_id LIMIT {SAMPLE_SIZE}"),
        "hit_rate_by_type": _with(
            f"SELECT bb_type, CAST(list_position({order}, bb_type) AS INT) AS display_rank, round(r, 8) AS hit_rate, "
            "printf('%.1f%%', r * 100) AS hit_rate_text FROM (SELECT bb_type, avg(CAST(is_hit AS INT)) AS r "
            "FROM modeling_extract GROUP BY 1)"),
        "validate_extract": _with(_checks("modeling_extract", {
            "not_empty": "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END",
            "is_hit_not_null": "count(*) - count(is_hit)",
            "is_hit_binary": "count(*) FILTER (WHERE CAST(is_hit AS INT) NOT IN (0, 1))"})),
        "validate_not_null": _with(_checks("batted_ball_events", {
            **{f"{c}_not_null": f"count(*) - count({c})" for c in ("game_date", "is_hit", "bb_type", "batted_ball_id")},
            "batted_ball_id_unique": "count(batted_ball_id) - count(DISTINCT batted_ball_id)"})),
        "validate_complete": _with(
            "SELECT *, 'all' AS rows FROM (" + _checks("tagged", {"no_nulls": some_null}) + ") UNION ALL "
            "SELECT *, 'complete' FROM ("
            + _checks(f"(SELECT * FROM tagged WHERE {_COMPLETE})", {"no_nulls": some_null}) + ")", track),
        "validate_same_rows": _with(
            _checks("(SELECT batted_ball_id FROM scored WHERE (p_a IS NULL) <> (p_b IS NULL))", {"same_rows": "count(*)"}),
            track, _SCORED),
        "time_split": _with("SELECT batted_ball_id, game_date, split FROM tagged", base),
        "split_profile": _with(
            "SELECT split, count(*) AS observations, min(game_date) AS first_date, max(game_date) AS last_date, "
            "round_even(avg(CAST(is_hit AS INT)), 3) AS hit_rate FROM tagged GROUP BY 1", base),
        "split_disjoint": _with(
            "SELECT count(*) AS common_keys FROM (SELECT batted_ball_id FROM tagged WHERE split = 'train' INTERSECT "
            "SELECT batted_ball_id FROM tagged WHERE split = 'test')", base),
        "complete_cases": _with(
            f"SELECT batted_ball_id, split, {', '.join(MODEL_B_FEATURES)} FROM tagged WHERE {_COMPLETE}", track),
        "row_loss": _with(
            "SELECT split, b AS rows_before, a AS rows_after, b - a AS rows_dropped, "
            "round(CAST(b - a AS DOUBLE) / b, 6) AS share_dropped, format('{:,}', b - a) AS dropped_text, "
            "printf('%.2f%%', CAST(b - a AS DOUBLE) / b * 100) AS share_text FROM (SELECT split, count(*) AS b, "
            f"count(*) FILTER (WHERE {_COMPLETE}) AS a FROM tagged GROUP BY 1)", track),
        "median_impute": _with(f"SELECT batted_ball_id, split, {', '.join(NUMERIC_B)} FROM filled",
                               track, _MEDIANS, _FILLED),
        "standardize": _with(
            "SELECT batted_ball_id, split, " + ", ".join(f"round(({c} - a_{c}) / s_{c}, 6) AS {c}" for c in NUMERIC_B)
            + " FROM filled CROSS JOIN moments", track, _MEDIANS, _FILLED, _MOMENTS),
        "mode_impute": _with(
            "SELECT split, " + ", ".join(f"coalesce({c}, {_mode(c)}) AS {c}" for c in ("bb_type", "events", "stand"))
            + ", count(*) AS observations FROM tagged GROUP BY ALL", _tagged(BASELINE_WINDOW, "pitches")),
        "validate_schema": _with(_schema_cases(), track),
        "interval_semi_join": (
            "SELECT event_id, user_id, event_type FROM events e WHERE EXISTS (SELECT 1 FROM (SELECT ts AS a, "
            "ts + to_seconds(event_id * 37 % 240) + to_days(CASE WHEN user_id % 50 = 0 THEN 1 ELSE 0 END) AS b "
            "FROM events WHERE event_type = 'error') WHERE e.ts BETWEEN a AND b)"),
        "one_hot": _with(f"SELECT batted_ball_id, split, {_INDICATORS} FROM tagged", track),
        "feature_display_names": _with(f"SELECT feature, {_NAMES} AS predictor FROM features", track, _FEATURES),
        "threshold_predict": _with(
            "SELECT bb_type, CAST(p >= 5e-1 AS INT) AS at_threshold, CAST(p > 5e-1 AS INT) AS above_half, "
            "count(*) AS observations FROM one GROUP BY 1, 2, 3", _ONE),
        "roc_curve": _with(_points(), _ONE, _curve("one")),
        "roc_curve_pruned": _with(
            _points("WHERE i = 1 OR NOT coalesce(next_pos = pos AND next_neg = neg, false)"), _ONE, _curve("one")),
        "roc_auc": _with("SELECT round(roc_auc, 8) AS roc_auc FROM measured", _ONE, _curve("one"), _sums(False)),
        "average_precision": _with(
            "SELECT round(average_precision, 8) AS average_precision FROM measured", _ONE, _curve("one"), _sums(False)),
        "evaluation": _with(f"SELECT model, {_metric_columns()} FROM measured",
                            track, _SCORED, _TWO, _curve("two"), _sums(False)),
        "evaluation_strict": _with(f"SELECT {_metric_columns('round_even({c}, 3)')} FROM measured",
                                   _ONE, _curve("one"), _sums(True)),
        "confusion_matrix": _with(
            "SELECT CAST(is_hit AS INT) AS actual, CAST(p > 5e-1 AS INT) AS predicted, count(*) AS observations "
            "FROM one GROUP BY 1, 2", _ONE),
        "ab_table": _with(f"SELECT model, {_metric_columns()} FROM difference",
                          track, _SCORED, _TWO, _curve("two"), _sums(False), _DIFFERENCE),
        "ab_metric_diff": _with(_LONG, track, _SCORED, _TWO, _curve("two"), _sums(False)),
        "fit_baseline": _with(
            "SELECT feature, round(w, 4) AS coefficient FROM weights UNION ALL SELECT 'intercept', round(w0, 4) FROM weights_base",
            base, *_BASE_MODEL, _BASE_WEIGHTS, recursive=True),
        "score_test": _with(
            "SELECT bb_type, is_hit, count(*) AS observations, round(avg(p), 4) AS mean_p FROM scored_base GROUP BY 1, 2",
            base, *_BASE_MODEL, recursive=True),
        "baseline_experiment": _with(
            f"SELECT {_metric_columns('round_even({c}, 3)')} FROM measured",
            base, *_BASE_MODEL, _curve("scored_base"), _sums(True), recursive=True),
        "tracking_experiment": _with(
            f"SELECT {_metric_columns('round_even({c}, 3)')} FROM measured",
            track, *_TRACK_MODEL, _curve("scored_track"), _sums(True), recursive=True),
        "fitted_coefficients": _with(
            "SELECT feature, round(w, 4) AS coefficient, round(exp(w), 3) AS odds_ratio FROM weights",
            base, *_BASE_MODEL, _BASE_WEIGHTS, recursive=True),
        "fitted_coefficient_impact": _with(
            f"SELECT {_NAMES} AS predictor, round(w, 4) AS coefficient, round(exp(w), 3) AS odds_ratio, "
            "CASE WHEN w > 0 THEN 'positive' ELSE 'negative' END AS impact FROM weights",
            base, *_BASE_MODEL, _BASE_WEIGHTS, recursive=True),
        "fitted_roc_curve": _with(
            "SELECT t AS at_least, round(CAST(count(*) FILTER (WHERE NOT is_hit AND p >= t) AS DOUBLE) / count(*) FILTER (WHERE NOT is_hit), 8) AS fpr, "
            "round(CAST(count(*) FILTER (WHERE is_hit AND p >= t) AS DOUBLE) / count(*) FILTER (WHERE is_hit), 8) AS tpr "
            "FROM scored_base CROSS JOIN (SELECT unnest([" + ", ".join(f"CAST({t} AS DOUBLE)" for t in ROC_THRESHOLDS) + "]) AS t) GROUP BY 1",
            base, *_BASE_MODEL, recursive=True),
        "fitted_confusion_matrix": _with(
            "SELECT CAST(is_hit AS INT) AS actual, CAST(p > 5e-1 AS INT) AS predicted, count(*) AS observations "
            "FROM scored_track GROUP BY 1, 2", track, *_TRACK_MODEL, recursive=True),
        "ab_comparison": _with(
            f"SELECT model, {_metric_columns('round_even({c}, 3)')} FROM difference",
            track, *_BOTH_MODELS, _curve("both_models"), _sums(False), _DIFFERENCE, recursive=True),
    }
