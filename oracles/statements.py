"""SQL for DuckDB, written from the semantics and not from the Spark code.

Long statements are chains of common table expressions that build on each other;
``with_ctes`` puts the needed ones in front of a final select.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}


def r6(expression: str, name: str | None = None) -> str:
    """Six digits; see ``tidegrid.catalog.rounded`` for the place of the cut."""
    text = f"floor(({expression}) * 1e6::DOUBLE + 0.50005::DOUBLE) / 1e6::DOUBLE"
    return f"{text} AS {name}" if name else text


def with_ctes(ctes: list[tuple[str, str]], select: str) -> str:
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes)
    return f"WITH {body}\n{select}"


# --- input tables -------------------------------------------------------------------------

READINGS_HOURLY = (
    "readings",
    """SELECT event_type AS series_id, date_trunc('hour', ts) AS ts, avg(value) AS target,
       max(value) AS aux, CAST(min(event_id) % 12 AS VARCHAR) AS weather_code
FROM events GROUP BY event_type, date_trunc('hour', ts)""",
)
READINGS_SPARSE = (
    "readings",
    """SELECT CAST(user_id AS VARCHAR) AS series_id, date_trunc('hour', ts) AS ts,
       avg(value) AS target
FROM events GROUP BY user_id, date_trunc('hour', ts)""",
)
READINGS_DAILY = (
    "readings",
    """SELECT CAST(c.c_nationkey AS VARCHAR) AS series_id, o.o_orderdate AS ts,
       sum(o.o_totalprice) / 10000 AS target
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_nationkey, o.o_orderdate""",
)
READINGS_OFFGRID = [
    READINGS_HOURLY,
    (
        "offgrid",
        """SELECT series_id, ts, target FROM readings
UNION ALL
SELECT series_id, ts + INTERVAL '30' MINUTE, target + 1 FROM readings WHERE aux > 100""",
    ),
]
READINGS_RAW = (
    "raw",
    """SELECT event_type AS series_id,
       CASE WHEN event_id % 97 = 0 THEN 'not-a-time' ELSE CAST(ts AS VARCHAR) END AS time_text,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS target
FROM events""",
)
RUNS = (
    "runs",
    """SELECT o_orderkey AS run_id, concat('run-', CAST(o_orderkey AS VARCHAR)) AS name,
       CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'running'
            ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'failed' ELSE 'crashed' END END AS state,
       o_orderdate AS created_at,
       CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS user_id, o_orderpriority AS tag,
       o_orderkey % 7 <> 0 AS has_metrics,
       CASE WHEN o_orderkey % 10 = 0 THEN NULL
            ELSE CAST(500 + o_orderkey * 37 % 500 AS DOUBLE) / 1000 END AS single_acc,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL
            ELSE CAST(400 + o_orderkey * 53 % 500 AS DOUBLE) / 1000 END AS multi_acc,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice / 50 END AS runtime_s
FROM orders""",
)
ARTIFACTS = (
    "artifacts",
    """SELECT CASE WHEN l_orderkey % 3 = 0 THEN l_orderkey + 1 ELSE l_orderkey END AS run_id,
       concat('model-', CAST(l_partkey AS VARCHAR)) AS name,
       concat('v', CAST(l_linenumber AS VARCHAR)) AS version,
       CASE l_returnflag WHEN 'R' THEN 'model' WHEN 'A' THEN 'processor' ELSE 'run_log' END AS type,
       l_suppkey AS seq
FROM lineitem""",
)
REGISTRY = (
    "registry",
    """SELECT p_partkey AS version_id, p_name AS name,
       concat('v', CAST(p_partkey AS VARCHAR)) AS version,
       CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_partkey * 3 END AS run_id,
       CASE WHEN p_size % 5 = 0 THEN 'production,latest' WHEN p_size % 5 = 1 THEN 'Staging'
            WHEN p_size % 5 = 2 THEN 'staging-latest' WHEN p_size % 5 = 3 THEN 'latest'
            ELSE '' END AS aliases_csv,
       CASE WHEN p_partkey % 11 = 0 THEN '' WHEN p_partkey % 13 = 0 THEN 'last spring'
            ELSE concat('2024-', lpad(CAST(p_partkey % 12 + 1 AS VARCHAR), 2, '0'), '-15',
                 CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'T08:30:00' END) END AS created_at,
       CASE WHEN p_partkey % 4 <> 0 THEN concat('about ', p_name) END AS description
FROM part""",
)
PROMOTIONS = (
    "promotions",
    """SELECT p_name AS name,
       CASE WHEN p_partkey % 19 = 0 THEN 'v-none'
            ELSE concat('v', CAST(p_partkey AS VARCHAR)) END AS version,
       CASE p_partkey % 3 WHEN 0 THEN 'production' WHEN 1 THEN 'staging' END AS target
FROM part""",
)

# --- cleaning ---------------------------------------------------------------------------------


def gridded(source: str, unit: str, columns: list[str]) -> list[tuple[str, str]]:
    step = {"hour": "1 HOUR", "day": "1 DAY"}[unit]
    values = ", ".join(f"r.{c}" for c in columns)
    return [
        (
            "bounds",
            f"""SELECT series_id, min(date_trunc('{unit}', ts)) AS lo,
       max(date_trunc('{unit}', ts)) AS hi
FROM {source} GROUP BY series_id""",
        ),
        (
            "spine",
            f"""SELECT series_id, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP),
       CAST(hi AS TIMESTAMP), INTERVAL {step})) AS TIMESTAMP) AS ts FROM bounds""",
        ),
        (
            "grid",
            f"""SELECT s.series_id, s.ts, {values}
FROM spine s LEFT JOIN {source} r ON r.series_id = s.series_id AND r.ts = s.ts""",
        ),
    ]


def interpolated(columns: list[str], limit: int, others: list[str]) -> list[tuple[str, str]]:
    """Known neighbours found by position; the gap's cells lie on the line between them."""
    windows, fills = [], []
    for c in columns:
        at = f"CASE WHEN {c} IS NOT NULL THEN pos END"
        windows += [
            f"last_value({c} IGNORE NULLS) OVER back AS {c}_p",
            f"last_value({at} IGNORE NULLS) OVER back AS {c}_pp",
            f"first_value({c} IGNORE NULLS) OVER ahead AS {c}_n",
            f"first_value({at} IGNORE NULLS) OVER ahead AS {c}_np",
        ]
        fills.append(
            f"""CASE WHEN {c} IS NOT NULL THEN {c}
            WHEN {c}_pp IS NULL OR pos - {c}_pp > {limit} THEN NULL
            WHEN {c}_np IS NULL THEN {c}_p
            ELSE {c}_p + ({c}_n - {c}_p) * (pos - {c}_pp) / ({c}_np - {c}_pp) END AS {c}"""
        )
    extra = "".join(f", {c}" for c in others)
    return [
        (
            "numbered",
            "SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS pos FROM grid",
        ),
        (
            "neighbours",
            f"""SELECT *, {", ".join(windows)} FROM numbered
WINDOW back AS (PARTITION BY series_id ORDER BY pos
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       ahead AS (PARTITION BY series_id ORDER BY pos
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
        ),
        ("interp", f"SELECT series_id, ts{extra}, {', '.join(fills)} FROM neighbours"),
    ]


def seasonal(columns: list[str], others: list[str], tiers: str = "both") -> list[tuple[str, str]]:
    month, day, hour = (f"{part}(ts)" for part in ("month", "day", "hour"))
    one = ", ".join(f"quantile_cont({c}, 0.5) AS {c}_1" for c in columns)
    two = ", ".join(f"quantile_cont({c}, 0.5) AS {c}_2" for c in columns)
    parts = {
        "both": "coalesce(i.{c}, t1.{c}_1, t2.{c}_2) AS {c}",
        "day": "coalesce(i.{c}, t1.{c}_1) AS {c}",
        "month_hour": "coalesce(i.{c}, t2.{c}_2) AS {c}",
    }
    filled = ", ".join(parts[tiers].format(c=c) for c in columns)
    extra = "".join(f", i.{c}" for c in others)
    return [
        (
            "tier1",
            f"""SELECT series_id, {month} AS m, {day} AS d, {hour} AS h, {one}
FROM interp GROUP BY ALL""",
        ),
        ("tier2", f"SELECT series_id, {month} AS m, {hour} AS h, {two} FROM interp GROUP BY ALL"),
        (
            "clean",
            f"""SELECT i.series_id, i.ts{extra}, {filled}
FROM interp i
LEFT JOIN tier1 t1 ON t1.series_id = i.series_id AND t1.m = month(i.ts)
     AND t1.d = day(i.ts) AND t1.h = hour(i.ts)
LEFT JOIN tier2 t2 ON t2.series_id = i.series_id AND t2.m = month(i.ts) AND t2.h = hour(i.ts)""",
        ),
    ]


ENCODING = [
    (
        "encoding",
        """SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS code
FROM (SELECT DISTINCT coalesce(weather_code, 'nan') AS label FROM grid)""",
    ),
    (
        "encoded",
        """SELECT g.* EXCLUDE (weather_code), e.code AS weather_code
FROM grid g JOIN encoding e ON e.label = coalesce(g.weather_code, 'nan')""",
    ),
]


def clean_hourly() -> list[tuple[str, str]]:
    grid = gridded("readings", "hour", ["target", "aux", "weather_code"])
    steps = interpolated(["target", "aux"], 24, ["weather_code"])
    steps[0] = (
        "numbered",
        "SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS pos FROM encoded",
    )
    return [READINGS_HOURLY, *grid, *ENCODING, *steps, *seasonal(["target", "aux"], ["weather_code"])]


CLEAN_HOURLY = clean_hourly()
CLEAN_SPARSE = [
    READINGS_SPARSE,
    *gridded("readings", "hour", ["target"]),
    *interpolated(["target"], 24, []),
    *seasonal(["target"], []),
]

# --- features -----------------------------------------------------------------------------------

LAGS, MEANS, STDS = (1, 3, 6, 12, 24), (3, 6, 12, 24), (6, 12, 24)


def lag_sql() -> list[str]:
    over = "(PARTITION BY series_id ORDER BY ts)"
    return [f"lag(target, {k}) OVER {over} AS lag_{k}h" for k in LAGS]


def rolling_sql(function: str, windows: tuple[int, ...], prefix: str) -> list[str]:
    columns = []
    for w in windows:
        frame = (
            f"(PARTITION BY series_id ORDER BY ts ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
        )
        columns.append(
            f"CASE WHEN count(target) OVER {frame} = {w} "
            f"THEN {function}(target) OVER {frame} END AS {prefix}_{w}h"
        )
    return columns


CALENDAR = [
    "CAST(hour(ts) AS INTEGER) AS hour",
    "CAST(day(ts) AS INTEGER) AS day",
    "CAST(month(ts) AS INTEGER) AS month",
    "CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week",
    "CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend",
    "CASE WHEN hour(ts) < 6 OR hour(ts) >= 20 THEN 1 ELSE 0 END AS is_night",
]
CYCLICAL = [
    "sin(2 * pi() * hour(ts) / 24) AS sin_hour",
    "cos(2 * pi() * hour(ts) / 24) AS cos_hour",
]
TIER = """CASE WHEN {v} <= 12.0 THEN 0 WHEN {v} <= 35.4 THEN 1 WHEN {v} <= 55.4 THEN 2
     WHEN {v} <= 150.4 THEN 3 WHEN {v} <= 250.4 THEN 4 ELSE 5 END AS pm2_5_tier"""
LAG_NAMES = [f"lag_{k}h" for k in LAGS]
MEAN_NAMES = [f"rolling_mean_{w}h" for w in MEANS]
STD_NAMES = [f"rolling_std_{w}h" for w in STDS]
CALENDAR_NAMES = ["hour", "day", "month", "day_of_week", "is_weekend", "is_night"]
CYCLICAL_NAMES = ["sin_hour", "cos_hour"]
INT_NAMES = [*CALENDAR_NAMES, "pm2_5_tier"]
FEATURE_NAMES = [
    *LAG_NAMES, *MEAN_NAMES, *STD_NAMES, *CALENDAR_NAMES, *CYCLICAL_NAMES, "pm2_5_tier",
]


def features(own: list[str]) -> list[tuple[str, str]]:
    columns = [
        *lag_sql(),
        *rolling_sql("avg", MEANS, "rolling_mean"),
        *rolling_sql("stddev_samp", STDS, "rolling_std"),
        *CALENDAR,
        *CYCLICAL,
        TIER.format(v="target"),
    ]
    complete = " AND ".join(f"{c} IS NOT NULL" for c in [*own, *FEATURE_NAMES])
    return [
        ("engineered", f"SELECT *, {', '.join(columns)} FROM clean"),
        ("features", f"SELECT * FROM engineered WHERE {complete}"),
    ]


def show(names: list[str], whole: tuple[str, ...] = ()) -> str:
    """Select list: doubles rounded, integers and keys as they are."""
    plain = {*INT_NAMES, "series_id", "ts", "weather_code", "split", "split_row", *whole}
    return ", ".join(n if n in plain else r6(n, n) for n in names)


HOURLY_OWN = ["target", "aux", "weather_code"]
FEATURES_HOURLY = [*CLEAN_HOURLY, *features(HOURLY_OWN)]
FEATURES_SPARSE = [*CLEAN_SPARSE, *features(["target"])]

SPLIT = [
    (
        "placed",
        """SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS rn,
       count(*) OVER (PARTITION BY series_id) AS n FROM features""",
    ),
    (
        "cut",
        """SELECT *, CAST(floor(n * 0.7::DOUBLE) AS BIGINT) AS a,
       CAST(floor(n * 0.1::DOUBLE) AS BIGINT) AS b FROM placed""",
    ),
    (
        "split",
        """SELECT * EXCLUDE (rn, n, a, b),
       CASE WHEN rn <= a THEN 'train' WHEN rn <= a + b THEN 'val' ELSE 'test' END AS split,
       CASE WHEN rn <= a THEN rn WHEN rn <= a + b THEN rn - a ELSE rn - a - b END AS split_row
FROM cut""",
    ),
]
SPLIT_HOURLY = [*FEATURES_HOURLY, *SPLIT]
SCALED_NAMES = ["aux", "weather_code", *FEATURE_NAMES]
MONITORED = ["target", *SCALED_NAMES]


def limits(names: list[str]) -> tuple[str, str]:
    ends = ", ".join(f"min({c}) AS {c}_lo, max({c}) AS {c}_hi" for c in names)
    return ("limits", f"SELECT {ends} FROM split WHERE split = 'train'")


def scaled(c: str) -> str:
    return (
        f"CASE WHEN {c}_hi = {c}_lo THEN {c} - {c}_lo "
        f"ELSE ({c} - {c}_lo) / CAST({c}_hi - {c}_lo AS DOUBLE) END"
    )


# --- queries: cleaning ------------------------------------------------------------------------------

ORACLES["scan_readings"] = f"SELECT event_id, ts, event_type, {r6('value', 'value')} FROM events"
ORACLES["normalize_columns"] = with_ctes(
    [READINGS_HOURLY],
    f"""SELECT series_id, ts, {r6('target')} AS "pm2_5_(μg/m³)", {r6('aux', 'wind_speed')},
       weather_code FROM readings""",
)
ORACLES["parse_time"] = with_ctes(
    [READINGS_RAW],
    f"""SELECT TRY_CAST(time_text AS TIMESTAMP) AS ts, series_id, {r6('target', 'target')}
FROM raw WHERE TRY_CAST(time_text AS TIMESTAMP) IS NOT NULL""",
)
ORACLES["drop_columns"] = with_ctes(
    [READINGS_HOURLY], f"SELECT series_id, ts, {r6('target', 'target')} FROM readings"
)
ORACLES["regrid_hourly"] = with_ctes(
    [*READINGS_OFFGRID, *gridded("offgrid", "hour", ["target"])],
    f"SELECT series_id, ts, {r6('target', 'target')} FROM grid",
)
ORACLES["duplicate_timestamps"] = """SELECT event_type AS series_id,
       date_trunc('hour', ts) AS ts, count(*) AS n_rows
FROM events GROUP BY 1, 2 HAVING count(*) > 1"""
ORACLES["encode_weather"] = with_ctes(
    [READINGS_HOURLY, *gridded("readings", "hour", ["weather_code"]), *ENCODING],
    "SELECT series_id, ts, weather_code FROM encoded",
)
ORACLES["interpolate_linear"] = with_ctes(
    [
        READINGS_SPARSE,
        *gridded("readings", "hour", ["target"]),
        *interpolated(["target"], 24, []),
    ],
    f"SELECT series_id, ts, {r6('target', 'target')} FROM interp",
)
DAILY_GAPS = [
    READINGS_DAILY,
    *gridded("readings", "day", ["target"]),
    *interpolated(["target"], 3, []),
]
TARGET_ONLY = f"SELECT series_id, ts, {r6('target', 'target')} FROM clean"
ORACLES["fill_seasonal_year"] = with_ctes(
    [*DAILY_GAPS, *seasonal(["target"], [], "day")], TARGET_ONLY
)
ORACLES["fill_seasonal_month_hour"] = with_ctes(
    [
        READINGS_SPARSE,
        *gridded("readings", "hour", ["target"]),
        *interpolated(["target"], 24, []),
        *seasonal(["target"], [], "month_hour"),
    ],
    TARGET_ONLY,
)
ORACLES["clean_readings"] = with_ctes(
    CLEAN_HOURLY,
    f"SELECT series_id, ts, {r6('target', 'target')}, {r6('aux', 'aux')}, weather_code FROM clean",
)
ORACLES["clean_readings_sparse"] = with_ctes(CLEAN_SPARSE, TARGET_ONLY)
ORACLES["clean_readings_daily"] = with_ctes(
    [*DAILY_GAPS, *seasonal(["target"], [])], TARGET_ONLY
)

DELIVERED = [
    ("hourly", READINGS_HOURLY[1]),
    (
        "delivered",
        """SELECT series_id AS "station name", target AS "pm2_5 (μg/m³)", aux AS "wind speed ()", weather_code,
       unnest(CASE WHEN weather_code = '0' THEN [CAST(ts AS VARCHAR), 'soon'] ELSE [CAST(ts AS VARCHAR)] END) AS time
FROM hourly""",
    ),
    (
        "readings",
        """SELECT "station name" AS series_id, TRY_CAST(time AS TIMESTAMP) AS ts, "pm2_5 (μg/m³)" AS target,
       "wind speed ()" AS aux, weather_code
FROM delivered WHERE TRY_CAST(time AS TIMESTAMP) IS NOT NULL""",
    ),
]
ORACLES["scan_unreadable"] = f"""SELECT event_id, CASE WHEN reason IS NULL THEN ts END AS ts,
       CASE WHEN reason IS NULL THEN event_type END AS event_type,
       CASE WHEN reason IS NULL THEN {r6('value')} END AS value, reason
FROM (SELECT *, CASE WHEN event_id % 89 = 0 OR event_id % 83 = 0 THEN 'unreadable record'
                     WHEN event_id % 97 = 0 THEN 'value is no double' END AS reason FROM events)"""
ORACLES["clean_raw"] = with_ctes(
    [*DELIVERED, *CLEAN_HOURLY[1:]],
    f"""SELECT series_id, ts, {r6('target')} AS "pm2_5_(μg/m³)", {r6('aux', 'wind_speed')}, weather_code FROM clean""",
)

# --- queries: features ----------------------------------------------------------------------------------

ORACLES["calendar_features"] = with_ctes(
    [READINGS_HOURLY], f"SELECT series_id, ts, {', '.join(CALENDAR)} FROM readings"
)
ORACLES["cyclical_features"] = with_ctes(
    [READINGS_HOURLY, ("angles", f"SELECT series_id, ts, {', '.join(CYCLICAL)} FROM readings")],
    f"SELECT {show(['series_id', 'ts', *CYCLICAL_NAMES])} FROM angles",
)
GRIDDED = [READINGS_HOURLY, *gridded("readings", "hour", ["target"])]


def history(columns: list[str], names: list[str]) -> str:
    return with_ctes(
        [*GRIDDED, ("history", f"SELECT *, {', '.join(columns)} FROM grid")],
        f"SELECT {show(['series_id', 'ts', 'target', *names])} FROM history",
    )


ORACLES["lag_features"] = history(lag_sql(), LAG_NAMES)
ORACLES["rolling_mean"] = history(rolling_sql("avg", MEANS, "rolling_mean"), MEAN_NAMES)
ORACLES["rolling_std"] = history(rolling_sql("stddev_samp", STDS, "rolling_std"), STD_NAMES)
ORACLES["rolling_week"] = with_ctes(
    [
        *CLEAN_HOURLY,
        (
            "weeks",
            f"""SELECT series_id, ts, target,
       {", ".join(rolling_sql("avg", (168,), "rolling_mean") + rolling_sql("stddev_samp", (168,), "rolling_std"))}
FROM clean""",
        ),
    ],
    f"SELECT {show(['series_id', 'ts', 'target', 'rolling_mean_168h', 'rolling_std_168h'])} FROM weeks",
)
ORACLES["aqi_tier"] = f"SELECT event_id, {TIER.format(v='value')} FROM events"
ORACLES["feature_table"] = with_ctes(
    FEATURES_HOURLY, f"SELECT {show(['series_id', 'ts', *HOURLY_OWN, *FEATURE_NAMES])} FROM features"
)
ORACLES["feature_table_sparse"] = with_ctes(
    FEATURES_SPARSE, f"SELECT {show(['series_id', 'ts', 'target', *FEATURE_NAMES])} FROM features"
)

# --- queries: split and scale ------------------------------------------------------------------------------

ORACLES["time_split"] = with_ctes(
    SPLIT_HOURLY, "SELECT series_id, ts, split, split_row FROM split"
)
ORACLES["cv_folds"] = with_ctes(
    [
        *FEATURES_HOURLY,
        (
            "tiles",
            """SELECT series_id, ts, ntile(6) OVER (PARTITION BY series_id ORDER BY ts) AS tile
FROM features""",
        ),
        ("folds", "SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS fold"),
    ],
    """SELECT series_id, ts, fold, CASE WHEN tile <= fold THEN 'train' ELSE 'val' END AS role
FROM tiles JOIN folds ON tile <= fold + 1""",
)
ORACLES["select_features"] = f"""SELECT {r6('l_quantity', 'l_quantity')},
       CAST(l_linenumber AS DOUBLE) AS line_text,
       CAST(l_discount > 0.05 AS INTEGER) AS discounted FROM lineitem"""
ORACLES["minmax_fit"] = with_ctes(
    SPLIT_HOURLY,
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", {r6(f'CAST(min({c}) AS DOUBLE)', 'min')}, "
        f"{r6(f'CAST(max({c}) AS DOUBLE)', 'max')} FROM split WHERE split = 'train'"
        for c in SCALED_NAMES
    ),
)
ORACLES["minmax_scale"] = with_ctes(
    [*SPLIT_HOURLY, limits(SCALED_NAMES)],
    f"""SELECT series_id, ts, {r6('target', 'target')}, split, split_row,
{", ".join(r6(scaled(c), c) for c in SCALED_NAMES)}
FROM split JOIN limits ON TRUE""",
)
ORACLES["minmax_inverse"] = with_ctes(
    [*SPLIT_HOURLY, limits(["target"])],
    f"""SELECT series_id, ts, {r6('target', 'target')}, split, split_row,
{r6(scaled('target'), 'target_scaled')}, {r6('target', 'target_again')}
FROM split JOIN limits ON TRUE""",
)
ORACLES["prepare_dataset"] = with_ctes(
    [*SPLIT_HOURLY, limits(["target", *SCALED_NAMES])],
    f"""SELECT series_id, ts, split, split_row, {r6('target', 'target_raw')},
{", ".join(r6(scaled(c), c) for c in ["target", *SCALED_NAMES])}
FROM split JOIN limits ON TRUE""",
)


def _transform_new() -> str:
    recent = (
        "recent",
        f"""SELECT * FROM ({READINGS_HOURLY[1]}) WHERE ts >= TIMESTAMP '2024-01-23 00:00:00'""",
    )
    columns = ["target", "aux", "weather_code"]
    grid = [
        (f"new_{n}", s.replace("FROM bounds", "FROM new_bounds").replace("FROM spine", "FROM new_spine"))
        for n, s in gridded("recent", "hour", columns)
    ]
    encoded = (
        "new_encoded",
        """SELECT g.* EXCLUDE (weather_code), coalesce(e.code, -1) AS weather_code
FROM new_grid g LEFT JOIN encoding e ON e.label = coalesce(g.weather_code, 'nan')""",
    )
    steps = interpolated(["target", "aux"], 24, ["weather_code"])
    steps[0] = (
        "numbered",
        "SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS pos FROM encoded",
    )
    chain = [*steps, *seasonal(["target", "aux"], ["weather_code"]), *features(HOURLY_OWN)]
    renamed = []
    for name, sql in chain:
        for other in ("encoded", "numbered", "neighbours", "interp", "tier1", "tier2", "clean",
                      "engineered"):
            sql = sql.replace(f"FROM {other}", f"FROM new_{other}")
            sql = sql.replace(f"JOIN {other} ", f"JOIN new_{other} ")
        renamed.append((f"new_{name}", sql))
    ctes = [*SPLIT_HOURLY, limits(SCALED_NAMES), recent, *grid, encoded, *renamed]
    return with_ctes(
        ctes,
        f"""SELECT series_id, ts, {", ".join(r6(scaled(c), c) for c in SCALED_NAMES)}
FROM new_features JOIN limits ON TRUE WHERE ts >= TIMESTAMP '2024-01-24 00:00:00'""",
    )


ORACLES["transform_new"] = _transform_new()
ORACLES["saved_transform"] = ORACLES["transform_new"]
ORACLES["transform_batches"] = with_ctes(
    [*SPLIT_HOURLY, limits(SCALED_NAMES)],
    f"""SELECT series_id, ts, {", ".join(r6(scaled(c), c) for c in SCALED_NAMES)}
FROM split JOIN limits ON TRUE WHERE ts >= TIMESTAMP '2024-01-24 00:00:00'""",
)
ORACLES["sequence_windows"] = with_ctes(
    [
        *SPLIT_HOURLY,
        (
            "windows",
            f"""SELECT series_id, ts, split, target, split_row,
       count(*) OVER w AS length, first_value(target) OVER w AS first_target,
       last_value(aux) OVER w AS last_aux,
       {" + ".join(f"sum({c}) OVER w" for c in MONITORED)} AS total
FROM split
WINDOW w AS (PARTITION BY series_id, split ORDER BY split_row
             ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)""",
        ),
    ],
    f"""SELECT series_id, ts, split, {r6('target', 'target')}, CAST(length AS INTEGER) AS length,
       {r6('first_target', 'first_target')}, {r6('last_aux', 'last_aux')}, {r6('total', 'total')},
       CAST({len(MONITORED)} AS INTEGER) AS width
FROM windows WHERE split_row > 24""",
)

# --- queries: forecasts ----------------------------------------------------------------------------------------

PERSISTENCE = [
    *SPLIT_HOURLY,
    (
        "forecast",
        """SELECT series_id, ts, split_row, target AS actual, lag_1h AS predicted,
       target - lag_1h AS error FROM split WHERE split = 'test'""",
    ),
]
ORACLES["forecast_first_horizon"] = with_ctes(
    PERSISTENCE,
    f"""SELECT series_id, ts, split_row, {r6('actual', 'actual')}, {r6('predicted', 'predicted')}
FROM forecast WHERE split_row <= 24""",
)
ORACLES["actual_vs_predicted"] = with_ctes(
    PERSISTENCE,
    f"""SELECT series_id, ts, {r6('actual', 'actual')}, {r6('predicted', 'predicted')},
       {r6('error', 'error')} FROM forecast""",
)
METRIC_SQL = {
    "mae": "avg(abs(error))",
    "mape": "avg(abs(error) / greatest(abs(actual), 2.220446049250313e-16))",
    "mse": "avg(error * error)",
    "rmse": "sqrt(avg(error * error))",
    "r2": """CASE WHEN var_pop(actual) = 0 THEN CASE WHEN sum(error * error) = 0 THEN 1.0 ELSE 0.0 END
     ELSE 1 - sum(error * error) / (var_pop(actual) * count(*)) END""",
    "accuracy": "1 - avg(abs(error) / greatest(abs(actual), 2.220446049250313e-16))",
}
ORACLES["forecast_metrics"] = with_ctes(
    PERSISTENCE,
    f"""SELECT series_id, {", ".join(r6(sql, m) for m, sql in METRIC_SQL.items())}
FROM forecast GROUP BY series_id""",
)
ORACLES["metrics_report"] = with_ctes(
    PERSISTENCE,
    "\nUNION ALL\n".join(
        f"SELECT series_id, '{stage}' AS stage, '{m}' AS metric, {r6(sql, 'value')} "
        f"FROM forecast WHERE {rows} GROUP BY series_id"
        for stage, rows in (
            ("train_metrics", "TRUE"),
            ("single_step_metrics", "TRUE"),
            ("multi_step_metrics", "split_row <= 24"),
        )
        for m, sql in METRIC_SQL.items()
    ),
)


def histogram_sql(source: str, value: str, by: str | None) -> list[tuple[str, str]]:
    key = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    match = f"b.{by} = r.{by}" if by else "TRUE"
    return [
        (
            "ranges",
            f"""SELECT {key}min({value}) AS lo, (max({value}) - min({value})) / 30 AS width,
       count({value}) AS total FROM {source} {group}""",
        ),
        ("bins", "SELECT CAST(unnest(range(0, 30)) AS INTEGER) AS bin"),
        (
            "binned",
            f"""SELECT {"r." + by + ", " if by else ""}least(CAST(floor((b.{value} - r.lo) / r.width)
       AS INTEGER), 29) AS bin, count(*) AS n
FROM {source} b JOIN ranges r ON {match} GROUP BY ALL""",
        ),
        (
            "histogram",
            f"""SELECT {"r." + by + ", " if by else ""}s.bin, r.lo + s.bin * r.width AS bin_start,
       r.lo + (s.bin + 1) * r.width AS bin_end, coalesce(n.n, 0) AS n,
       coalesce(n.n, 0) / (r.total * r.width) AS density
FROM ranges r JOIN bins s ON TRUE
LEFT JOIN binned n ON n.bin = s.bin {f"AND n.{by} = r.{by}" if by else ""}""",
        ),
    ]


HISTOGRAM_SHOW = (
    f"bin, {r6('bin_start', 'bin_start')}, {r6('bin_end', 'bin_end')}, n, {r6('density', 'density')}"
)
ORACLES["error_histogram"] = with_ctes(
    [*PERSISTENCE, *histogram_sql("forecast", "error", None)],
    f"SELECT {HISTOGRAM_SHOW} FROM histogram",
)


def _recursive() -> str:
    """One level of recursion per step over all origins; the history is a list."""
    hour = "hour(origin + to_hours(CAST(step + 1 AS INTEGER)))"
    mean6 = "list_sum(history[1:6]) / 6"
    p = (
        "2.0 + 0.5 * history[1] + 0.15 * history[3] + 0.1 * history[24] "
        f"+ 0.2 * ({mean6}) + 1.5 * sin(2 * pi() * {hour} / 24)"
    )
    ctes = ",\n".join(f"{n} AS (\n{sql}\n)" for n, sql in CLEAN_HOURLY)
    return f"""WITH RECURSIVE {ctes},
starts AS (
SELECT series_id, ts AS origin, list_reverse(list(target) OVER w) AS history,
       count(target) OVER w AS n
FROM clean
WINDOW w AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
),
steps AS (
SELECT series_id, origin, 0 AS step, history, CAST(NULL AS DOUBLE) AS predicted
FROM starts WHERE n = 24
UNION ALL
SELECT series_id, origin, step + 1, list_concat([p], history[1:23]), p
FROM (SELECT *, {p} AS p FROM steps WHERE step < 24)
)
SELECT series_id, origin, CAST(step AS INTEGER) AS step,
       origin + to_hours(CAST(step AS INTEGER)) AS ts, {r6('predicted', 'predicted')}
FROM steps WHERE step > 0"""


ORACLES["forecast_recursive"] = _recursive()


def _window_recursive() -> str:
    """A window of 24 feature rows as one list per feature; each level pushes a row into it."""
    scales = {"target": 0.1, "aux": 0.02, "sin_hour": 0.5, "lag_1h": 0.03, "rolling_mean_6h": 0.05}
    fading = "list_transform(range(24), lambda k: {w}::DOUBLE * pow(0.8, 23 - k))"
    dot = " + ".join(f"list_dot_product({c}, {fading.format(w=w)})" for c, w in scales.items())
    pushed = {
        "target": "p",
        "aux": "aux[24]",
        "sin_hour": "sin(2 * pi() * hour(origin + to_hours(CAST(step + 1 AS INTEGER))) / 24)",
        "lag_1h": "target[24]",
        "rolling_mean_6h": "(p + list_sum(target[20:24])) / 6",
    }
    ctes = ",\n".join(f"{n} AS (\n{sql}\n)" for n, sql in FEATURES_HOURLY)
    return f"""WITH RECURSIVE {ctes},
windows AS (
SELECT series_id, ts AS origin, {", ".join(f"list({c}) OVER w AS {c}" for c in scales)},
       count(*) OVER w AS n, min(ts) OVER w AS since
FROM features
WINDOW w AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
),
steps AS (
SELECT series_id, origin, 0 AS step, {", ".join(scales)}, CAST(NULL AS DOUBLE) AS predicted
FROM windows WHERE n = 24 AND since = origin - INTERVAL 23 HOUR
UNION ALL
SELECT series_id, origin, step + 1, {", ".join(f"list_concat({c}[2:24], [{x}])" for c, x in pushed.items())}, p
FROM (SELECT *, 3.0::DOUBLE + {dot} AS p FROM steps WHERE step < 24)
)
SELECT series_id, origin, CAST(step AS INTEGER) AS step,
       origin + to_hours(CAST(step AS INTEGER)) AS ts, {r6('predicted', 'predicted')}
FROM steps WHERE step > 0"""


ORACLES["forecast_sequence_recursive"] = _window_recursive()

# --- queries: monitoring ----------------------------------------------------------------------------------------


def drift_ctes() -> list[tuple[str, str]]:
    parts = "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column",
       avg({c}) FILTER (WHERE split = 'train') AS train_mean,
       avg({c}) FILTER (WHERE split = 'test') AS test_mean,
       stddev_samp({c}) FILTER (WHERE split = 'train') AS train_std,
       stddev_samp({c}) FILTER (WHERE split = 'test') AS test_std FROM split"""
        for c in MONITORED
    )
    return [
        *SPLIT_HOURLY,
        ("moments", parts),
        (
            "changes",
            """SELECT *,
       CASE WHEN train_mean = 0 THEN 0.0
            ELSE abs((test_mean - train_mean) / train_mean * 100) END AS mean_change_pct,
       CASE WHEN train_std = 0 THEN 0.0
            ELSE abs((test_std - train_std) / train_std * 100) END AS std_change_pct
FROM moments""",
        ),
        (
            "drift",
            """SELECT *, coalesce(mean_change_pct > 20, FALSE) OR coalesce(std_change_pct > 30, FALSE)
       AS drift_detected FROM changes""",
        ),
    ]


DRIFT_NUMBERS = [
    "train_mean", "test_mean", "train_std", "test_std", "mean_change_pct", "std_change_pct",
]
ORACLES["drift_report"] = with_ctes(
    drift_ctes(), f'SELECT "column", {show(DRIFT_NUMBERS)}, drift_detected FROM drift'
)
ORACLES["drift_summary"] = with_ctes(
    drift_ctes(),
    """SELECT count(*) FILTER (WHERE drift_detected) AS drifted_columns,
       count(*) AS checked_columns,
       coalesce(string_agg("column", ', ' ORDER BY "column") FILTER (WHERE drift_detected), '')
       AS drifted_names FROM drift""",
)
ORACLES["target_stats"] = with_ctes(
    SPLIT_HOURLY,
    f"""SELECT split, {r6('avg(target)', 'mean')}, {r6('stddev_samp(target)', 'std')},
       {r6('min(target)', 'min')}, {r6('max(target)', 'max')}
FROM split WHERE split <> 'val' GROUP BY split""",
)
ORACLES["target_shift"] = with_ctes(
    [
        *SPLIT_HOURLY,
        (
            "means",
            """SELECT avg(target) FILTER (WHERE split = 'train') AS train_mean,
       avg(target) FILTER (WHERE split = 'test') AS test_mean FROM split""",
        ),
        (
            "shift",
            "SELECT *, abs((test_mean - train_mean) / train_mean * 100) AS shift_pct FROM means",
        ),
    ],
    f"SELECT {show(['train_mean', 'test_mean', 'shift_pct'])}, shift_pct > 15 AS alert FROM shift",
)
ORACLES["target_histogram"] = with_ctes(
    [
        *SPLIT_HOURLY,
        ("both_sets", "SELECT * FROM split WHERE split <> 'val'"),
        *histogram_sql("both_sets", "target", "split"),
    ],
    f"SELECT split, {HISTOGRAM_SHOW} FROM histogram",
)
ORACLES["target_boxplot"] = with_ctes(
    [
        *SPLIT_HOURLY,
        ("both_sets", "SELECT split, target FROM split WHERE split <> 'val'"),
        (
            "quartiles",
            """SELECT split, quantile_cont(target, 0.25) AS q1, quantile_cont(target, 0.5) AS median,
       quantile_cont(target, 0.75) AS q3 FROM both_sets GROUP BY split""",
        ),
        (
            "fences",
            """SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high
FROM quartiles""",
        ),
        (
            "boxes",
            """SELECT f.split, q1, median, q3,
       least(min(target) FILTER (WHERE target >= low), q1) AS whisker_low,
       greatest(max(target) FILTER (WHERE target <= high), q3) AS whisker_high,
       count(*) FILTER (WHERE target < low OR target > high) AS outliers
FROM both_sets b JOIN fences f ON f.split = b.split GROUP BY f.split, q1, median, q3""",
        ),
    ],
    f"SELECT split, {show(['q1', 'median', 'q3', 'whisker_low', 'whisker_high'])}, outliers FROM boxes",
)
ORACLES["quality_summary"] = with_ctes(
    SPLIT_HOURLY,
    """SELECT split, count(*) AS total_rows,
       CAST(max(len(json_keys(to_json(s)))) - 1 AS INTEGER) AS total_columns
FROM split s GROUP BY split""",
)
PARSED = [
    READINGS_RAW,
    (
        "parsed",
        """SELECT TRY_CAST(time_text AS TIMESTAMP) AS ts, series_id, target FROM raw
WHERE TRY_CAST(time_text AS TIMESTAMP) IS NOT NULL""",
    ),
]
ORACLES["missing_values"] = with_ctes(
    PARSED,
    "\nUNION ALL\n".join(
        f"""SELECT series_id, '{c}' AS "column", count(*) - count({c}) AS missing_count,
       round((count(*) - count({c})) / count(*) * 100, 2) AS missing_pct
FROM parsed GROUP BY series_id"""
        for c in ("ts", "target")
    ),
)
ORACLES["duplicate_rows"] = with_ctes(
    PARSED,
    """SELECT series_id, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
FROM (SELECT series_id, target, count(*) AS n FROM parsed GROUP BY series_id, target)
GROUP BY series_id""",
)


def outliers_sql(table: str, columns: list[str]) -> str:
    parts = []
    for c in columns:
        quartiles = (
            f"SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {table}"
        )
        parts.append(
            f"""SELECT '{c}' AS "column", {r6('q1', 'q1')}, {r6('q3', 'q3')},
       count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers
FROM {table} JOIN ({quartiles}) ON TRUE GROUP BY q1, q3"""
        )
    return "\nUNION ALL\n".join(parts)


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ORACLES["iqr_outliers"] = outliers_sql("lineitem", LINE_NUMBERS)
ORACLES["iqr_outliers_events"] = outliers_sql("events", ["value"])
ORACLES["clip_outliers"] = f"""WITH q AS (
SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events
)
SELECT event_id, event_type,
       {r6('least(greatest(value, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1))', 'value')}
FROM events JOIN q ON TRUE"""
CORRELATED = [*LINE_NUMBERS, "l_linenumber", "constant"]
ORACLES["correlation_matrix"] = "WITH lines AS (SELECT *, 1.0::DOUBLE AS constant FROM lineitem),\nc AS (\n" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS c FROM lines"
    for a in CORRELATED
    for b in CORRELATED
) + f"\n)\nSELECT column_a, column_b, CASE WHEN isnan(c) THEN NULL ELSE {r6('c')} END AS correlation FROM c"

# --- queries: runs and registry -------------------------------------------------------------------------------------


def metrics_of(prefix: str = "") -> str:
    """The metric columns of a run; NULL where the run has no metrics."""

    def when(expression: str, name: str) -> str:
        return f"CASE WHEN {prefix}has_metrics THEN {r6(expression)} END AS {name}"

    columns = []
    for stage, acc in (("single_step", f"{prefix}single_acc"), ("multi_step", f"{prefix}multi_acc")):
        columns += [
            when(acc, f"{stage}_accuracy"),
            when(f"1 - {acc}", f"{stage}_mape"),
            when(f"(1 - {acc}) * 40", f"{stage}_mae"),
        ]
    return ", ".join(columns) + ", " + r6(f"{prefix}runtime_s", "runtime")


ORACLES["run_metrics"] = with_ctes(
    [RUNS],
    f"SELECT run_id, name, state, created_at, user_id, {metrics_of()} FROM runs WHERE has_metrics",
)
ORACLES["filter_runs"] = with_ctes(
    [RUNS],
    """SELECT run_id, name, state, tag FROM runs
WHERE state = 'finished' AND tag IN ('1-URGENT', '2-HIGH')""",
)
COUNTED = [
    RUNS,
    ARTIFACTS,
    (
        "per_run",
        """SELECT run_id, count(*) AS artifacts_count,
       count(*) FILTER (WHERE type = 'model') AS model_artifacts FROM artifacts GROUP BY run_id""",
    ),
    (
        "first_models",
        """SELECT run_id, name AS first_model, version AS first_version FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY seq, version, name) AS rn
  FROM artifacts WHERE type = 'model') WHERE rn = 1""",
    ),
    (
        "counted",
        """SELECT r.*, coalesce(p.artifacts_count, 0) AS artifacts_count,
       coalesce(p.model_artifacts, 0) AS model_artifacts, f.first_model, f.first_version,
       CASE coalesce(p.model_artifacts, 0) WHEN 0 THEN 'not registered'
            WHEN 1 THEN concat('registered (1 model: ', f.first_model, ')')
            ELSE concat('registered (', CAST(p.model_artifacts AS VARCHAR), ' models)') END
       AS registration
FROM runs r LEFT JOIN per_run p ON p.run_id = r.run_id
LEFT JOIN first_models f ON f.run_id = r.run_id
WHERE r.has_metrics""",
    ),
]
ORACLES["run_artifacts"] = with_ctes(
    COUNTED,
    """SELECT run_id, artifacts_count, model_artifacts, first_model, first_version, registration
FROM counted""",
)
ORACLES["run_model_details"] = with_ctes(
    [RUNS, ARTIFACTS],
    """SELECT run_id, seq, concat(name, ':', version) AS detail FROM artifacts
WHERE type = 'model' AND run_id IN (SELECT run_id FROM runs WHERE has_metrics)""",
)
ORACLES["runs_summary"] = with_ctes(
    COUNTED,
    """SELECT count(*) AS total_runs, count(*) FILTER (WHERE state = 'finished') AS finished_runs,
       count(*) FILTER (WHERE model_artifacts > 0) AS registered_runs,
       round_even(count(*) FILTER (WHERE model_artifacts > 0) * 100.0::DOUBLE / count(*), 0)
       AS registered_pct,
       CAST(sum(model_artifacts) AS BIGINT) AS total_models FROM counted""",
)
ORACLES["runs_leaderboard"] = with_ctes(
    COUNTED,
    f"""SELECT CAST(row_number() OVER (ORDER BY coalesce(single_acc, 0) DESC,
       created_at DESC NULLS LAST, run_id) AS INTEGER) AS rank, run_id, name,
       {r6('single_acc', 'single_step_accuracy')}, {r6('multi_acc', 'multi_step_accuracy')},
       model_artifacts, state
FROM counted ORDER BY rank LIMIT 10""",
)
ORACLES["problem_runs"] = with_ctes(
    [
        RUNS,
        (
            "problems",
            """SELECT * FROM runs WHERE has_metrics AND state IN ('failed', 'crashed', 'killed')""",
        ),
    ],
    """SELECT run_id, name, state, coalesce(user_id, 'Unknown') AS user_id, strftime(created_at, '%Y-%m-%d %H:%M') AS created,
       greatest((SELECT count(*) FROM problems) - 5, 0) AS more_runs
FROM problems ORDER BY run_id LIMIT 5""",
)
ORACLES["unregistered_top_runs"] = with_ctes(
    COUNTED,
    f"""SELECT run_id, name, {r6('single_acc', 'single_step_accuracy')},
       {r6('multi_acc', 'multi_step_accuracy')}, coalesce(user_id, 'Unknown') AS user_id,
       count(*) OVER () AS total_runs
FROM counted WHERE model_artifacts = 0 AND single_acc > 0.8
ORDER BY single_acc DESC, run_id LIMIT 5""",
)


def one_decimal(expression: str) -> str:
    return f"printf('%.1f', round(CAST({expression} AS DECIMAL(28, 12)), 1)::DOUBLE)"


ORACLES["run_labels"] = with_ctes(
    COUNTED,
    f"""SELECT run_id,
       CASE WHEN single_acc IS NULL THEN 'unknown' WHEN single_acc >= 0.95 THEN 'champion'
            WHEN single_acc >= 0.90 THEN 'gold' WHEN single_acc >= 0.85 THEN 'silver'
            WHEN single_acc >= 0.80 THEN 'bronze' WHEN single_acc >= 0.70 THEN 'fair'
            ELSE 'low' END AS accuracy_band,
       CASE WHEN state IN ('finished', 'running', 'failed', 'crashed', 'killed', 'preempted')
            THEN state ELSE 'unknown' END AS state_label,
       CASE WHEN runtime_s IS NULL THEN 'N/A'
            WHEN runtime_s < 60 THEN concat({one_decimal('runtime_s')}, 's')
            WHEN runtime_s < 3600 THEN concat({one_decimal('runtime_s / 60')}, 'm')
            ELSE concat({one_decimal('runtime_s / 3600')}, 'h') END AS runtime_label,
       coalesce(strftime(created_at, '%Y-%m-%d %H:%M'), 'Unknown') AS created_label,
       registration AS registration_label,
       CASE WHEN artifacts_count = 0 THEN 'not registered'
            WHEN model_artifacts > 0 THEN concat('registered (', CAST(model_artifacts AS VARCHAR),
                 ' models, ', CAST(artifacts_count AS VARCHAR), ' total)')
            ELSE concat('registered (', CAST(artifacts_count AS VARCHAR), ' artifacts, no models)')
            END AS artifact_label
FROM counted""",
)
ORACLES["run_paths"] = """WITH ids AS (
SELECT CASE WHEN o_orderkey % 3 = 0 THEN concat('team/other/', CAST(o_orderkey AS VARCHAR))
            ELSE CAST(o_orderkey AS VARCHAR) END AS run_id FROM orders
)
SELECT run_id, CASE WHEN contains(run_id, '/') THEN run_id ELSE concat('team/air/', run_id) END
       AS run_path FROM ids"""
ORACLES["registrable_models"] = with_ctes(
    COUNTED[:4],
    """SELECT r.run_id,
       CASE WHEN r.state = 'finished' THEN f.first_model END AS model_name,
       CASE WHEN r.state = 'finished' THEN f.first_version END AS model_version,
       CASE WHEN r.state <> 'finished' THEN 'run not finished'
            WHEN f.run_id IS NULL THEN 'no model artifacts' ELSE 'registrable' END AS status
FROM runs r LEFT JOIN first_models f ON f.run_id = r.run_id""",
)
MODELS = [
    REGISTRY,
    RUNS,
    (
        "models",
        f"""SELECT v.version_id, v.name, v.version, v.run_id, v.aliases_csv, v.created_at, v.description,
       r.name AS run_name, r.state AS run_state, r.created_at AS run_created_at,
       {metrics_of('r.')}
FROM registry v LEFT JOIN runs r ON r.run_id = v.run_id""",
    ),
]
CREATED = """CASE WHEN created_at = '' THEN 'Unknown'
     ELSE coalesce(strftime(TRY_CAST(created_at AS TIMESTAMP), '%Y-%m-%d'), created_at) END AS created"""
ORACLES["registry_models"] = with_ctes(MODELS, "SELECT * EXCLUDE (aliases_csv) FROM models")
ALIAS_STATUS = """CASE aliases_csv WHEN 'production,latest' THEN 'production, latest'
     WHEN 'Staging' THEN 'staging' WHEN 'staging-latest' THEN 'staging'
     WHEN 'latest' THEN 'latest' ELSE version END AS status"""
ORACLES["alias_status"] = with_ctes(
    [REGISTRY], f"SELECT version_id, {ALIAS_STATUS} FROM registry"
)
ORACLES["registry_summary"] = with_ctes(
    [REGISTRY],
    """SELECT count(*) FILTER (WHERE list_contains(string_split(lower(aliases_csv), ','),
       'production')) AS production_models,
       count(*) FILTER (WHERE list_contains(string_split(lower(aliases_csv), ','), 'staging'))
       AS staging_models, count(*) AS total_versions FROM registry""",
)
ORACLES["registry_leaderboard"] = with_ctes(
    MODELS,
    f"""SELECT CAST(row_number() OVER (ORDER BY coalesce(single_step_accuracy, 0) DESC, version_id)
       AS INTEGER) AS rank, coalesce(run_name, 'Unknown') AS model_name, version,
       single_step_accuracy, multi_step_accuracy, {CREATED}, {ALIAS_STATUS}
FROM models ORDER BY rank LIMIT 10""",
)
ORACLES["registry_by_stage"] = with_ctes(
    MODELS,
    "\nUNION ALL\n".join(
        f"""SELECT '{stage}' AS stage, CAST(row_number() OVER (ORDER BY
       coalesce(single_step_accuracy, 0) DESC, version_id) AS INTEGER) AS rank,
       coalesce(run_name, 'Unknown') AS model_name, version,
       single_step_accuracy, multi_step_accuracy, {CREATED} FROM models
WHERE list_contains(string_split(lower(aliases_csv), ','), '{stage}')"""
        for stage in ("production", "staging")
    ),
)
ORACLES["apply_promotions"] = with_ctes(
    [REGISTRY, PROMOTIONS],
    """SELECT v.version_id, v.version,
       CASE WHEN p.target IS NULL OR list_contains(string_split(v.aliases_csv, ','), p.target)
            THEN v.aliases_csv WHEN v.aliases_csv = '' THEN p.target
            ELSE concat(v.aliases_csv, ',', p.target) END AS aliases_csv,
       p.target IS NOT NULL AS promoted
FROM registry v LEFT JOIN promotions p
     ON p.name = v.name AND p.version = v.version AND p.target IS NOT NULL""",
)
ORACLES["rejected_promotions"] = with_ctes(
    [REGISTRY, PROMOTIONS],
    """SELECT p.name, p.version, p.target, CASE WHEN p.target IS NULL THEN 'incomplete request'
       ELSE 'unknown version' END AS reason
FROM promotions p LEFT JOIN registry v ON v.name = p.name AND v.version = p.version
WHERE p.target IS NULL OR v.version_id IS NULL""",
)

# --- queries: models ----------------------------------------------------------------------------------------------------

ORACLES["dotted_names"] = ORACLES["prepare_dataset"]
ORACLES["train_linear"] = with_ctes(
    [
        *SPLIT_HOURLY,
        (
            "sums",
            """SELECT avg(target) AS y, avg(lag_1h) AS a, avg(aux) AS b,
       covar_pop(lag_1h, target) AS ay, covar_pop(aux, target) AS "by", covar_pop(lag_1h, aux) AS ab,
       var_pop(lag_1h) AS aa, var_pop(aux) AS bb FROM split WHERE split = 'train'""",
        ),
        (
            "slopes",
            """SELECT *, (ay * bb - "by" * ab) / (aa * bb - ab * ab) AS wa,
       ("by" * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM sums""",
        ),
    ],
    """SELECT 'intercept' AS term, round(y - wa * a - wb * b, 4) AS weight FROM slopes
UNION ALL SELECT 'lag_1h', round(wa, 4) FROM slopes
UNION ALL SELECT 'aux', round(wb, 4) FROM slopes""",
)
for _name in ("train_random_forest", "train_gbt"):
    ORACLES[_name] = with_ctes(
        SPLIT_HOURLY,
        """SELECT series_id, count(*) AS n_rows, TRUE AS all_predicted, TRUE AS beats_train_mean
FROM split WHERE split = 'test' GROUP BY series_id""",
    )
ORACLES["train_sequence_model"] = with_ctes(
    SPLIT_HOURLY,
    """SELECT series_id, count(*) AS n_rows, TRUE AS all_predicted, TRUE AS beats_train_mean
FROM split WHERE split = 'test' AND split_row > 24 GROUP BY series_id""",
)
ORACLES["window_products"] = with_ctes(
    [
        *SPLIT_HOURLY,
        ("train", "SELECT series_id, split_row AS p, target, aux FROM split WHERE split = 'train'"),
        (
            "cells",
            """SELECT series_id, p, 0 AS i, target AS v FROM train
UNION ALL SELECT series_id, p, 1, aux FROM train
UNION ALL SELECT series_id, p, 2, 1.0 FROM train""",
        ),
        (
            "windows",
            """SELECT w.series_id, w.p, c.p - w.p + 6 AS a, c.i, c.v
FROM train w JOIN cells c ON c.series_id = w.series_id AND c.p BETWEEN w.p - 6 AND w.p
WHERE w.p > 6 AND (c.p < w.p OR c.i = 0)""",
        ),
    ],
    """SELECT CAST(x.a AS INTEGER) AS a, CAST(y.a AS INTEGER) AS b, x.i, y.i AS j,
       round(sum(x.v * y.v) / (SELECT count(*) FROM train WHERE p > 6), 4) AS value
FROM windows x JOIN windows y ON y.series_id = x.series_id AND y.p = x.p AND y.a >= x.a
WHERE x.a < 6 GROUP BY ALL""",
)
ORACLES["staged_validation"] = """SELECT CAST(unnest(range(1, 21)) AS INTEGER) AS trees, TRUE AS train_error_falls,
       TRUE AS cut_at_best"""
ORACLES["forecast_single_step"] = with_ctes(
    SPLIT_HOURLY,
    f"""SELECT series_id, ts, {r6('target', 'actual')}, TRUE AS predicted_present,
       TRUE AS within_train_range, TRUE AS beats_train_mean FROM split WHERE split = 'test'""",
)
ORACLES["forecast_recursive_model"] = with_ctes(
    [
        *CLEAN_HOURLY,
        (
            "starts",
            """SELECT series_id, ts AS origin, count(target) OVER w AS n FROM clean
WINDOW w AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)""",
        ),
        ("steps", "SELECT CAST(unnest(range(1, 25)) AS INTEGER) AS step"),
    ],
    """SELECT series_id, origin, step, origin + to_hours(step) AS ts, TRUE AS predicted_present, TRUE AS beats_train_mean
FROM starts JOIN steps ON n = 24""",
)
ORACLES["forecast_sequence_model"] = with_ctes(
    [
        *FEATURES_HOURLY,
        (
            "starts",
            """SELECT series_id, ts AS origin, count(*) OVER w AS n, min(ts) OVER w AS since FROM features
WINDOW w AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)""",
        ),
        ("steps", "SELECT CAST(unnest(range(1, 25)) AS INTEGER) AS step"),
    ],
    """SELECT series_id, origin, step, origin + to_hours(step) AS ts, TRUE AS predicted_present, TRUE AS beats_train_mean
FROM starts JOIN steps ON n = 24 AND since = origin - INTERVAL 23 HOUR""",
)
ORACLES["forecast_window_linear"] = ORACLES["forecast_sequence_model"]
ORACLES["feature_importance"] = f"""SELECT feature, CAST(rank AS INTEGER) AS rank, TRUE AS not_negative,
       TRUE AS shares_sum_to_one
FROM (SELECT unnest([{", ".join(f"'{c}'" for c in SCALED_NAMES)}]) AS feature)
LEFT JOIN (VALUES ('sin_hour', 1), ('cos_hour', 2), ('weather_code', 3)) AS t(feature, rank) USING (feature)"""
ORACLES["transform_new_text"] = ORACLES["transform_new"].replace(
    f"SELECT series_id, ts, {', '.join(r6(scaled(c), c) for c in SCALED_NAMES)}\nFROM new_features",
    f"""SELECT series_id, ts, CASE WHEN hour(ts) <> 5 THEN {r6("(hour(ts) % 3) / 2.0::DOUBLE")} END AS mood
FROM (SELECT * FROM new_features WHERE (series_id, ts) IN (SELECT (series_id, ts) FROM recent))""",
)


def _monitoring_report() -> str:
    """Every part of the report in one table."""
    parts = []

    def melt(section: str, dataset: str, item: str, measures: list[str], source: str) -> None:
        for m in measures:
            parts.append(
                f"""SELECT '{section}' AS section, CAST({dataset} AS VARCHAR) AS dataset,
       CAST({item} AS VARCHAR) AS item, '{m}' AS measure, {r6(f'CAST({m} AS DOUBLE)', 'value')}
FROM {source}"""
            )

    names = "[" + ", ".join(f"'{c}'" for c in MONITORED) + "]"

    def listed(expression: str) -> str:
        return "[" + ", ".join(expression.format(c=c) for c in MONITORED) + "]"

    def per_column(expression: str) -> str:
        return f"unnest({listed(expression)})"

    ctes = [
        *drift_ctes(),
        ("both_sets", "SELECT * FROM split WHERE split <> 'val'"),
        (
            "summary",
            "SELECT count(*) FILTER (WHERE drift_detected) AS drifted_columns, count(*) AS checked_columns FROM drift",
        ),
        (
            "stats",
            """SELECT split, avg(target) AS mean, stddev_samp(target) AS std, min(target) AS min,
       max(target) AS max FROM both_sets GROUP BY split""",
        ),
        (
            "shift",
            """SELECT *, shift_pct > 15 AS alert FROM (
  SELECT abs((b - a) / a * 100) AS shift_pct FROM (
    SELECT avg(target) FILTER (WHERE split = 'train') AS a,
           avg(target) FILTER (WHERE split = 'test') AS b FROM split))""",
        ),
        (
            "sizes",
            f"SELECT split, count(*) AS total_rows, {len(MONITORED)} AS total_columns FROM both_sets GROUP BY split",
        ),
        (
            "types",
            f"""SELECT CASE t WHEN 'INTEGER' THEN 'int' ELSE lower(t) END AS dtype, count(*) AS columns
FROM (SELECT {per_column("typeof({c})")} AS t FROM (SELECT * FROM split LIMIT 1)) GROUP BY ALL""",
        ),
        (
            "missing",
            f"""SELECT split, unnest({names}) AS name, unnest(gone) AS missing_count, unnest(pct) AS missing_pct
FROM (SELECT split, {listed("count(*) - count({c})")} AS gone,
       {listed("round((count(*) - count({c})) / count(*) * 100, 2)")} AS pct
  FROM both_sets GROUP BY split)""",
        ),
        (
            "copies",
            f"""SELECT split, sum(n - 1) AS duplicate_rows FROM (
  SELECT split, count(*) AS n FROM both_sets GROUP BY split, {', '.join(MONITORED)}) GROUP BY split""",
        ),
        (
            "values",
            f"SELECT split, unnest({names}) AS name, {per_column('CAST({c} AS DOUBLE)')} AS v FROM both_sets",
        ),
        (
            "quartiles",
            """SELECT split, name, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
       quantile_cont(v, 0.75) AS q3 FROM "values" GROUP BY split, name""",
        ),
        (
            "boxes",
            """SELECT q.split, q.name, q1, median, q3,
       least(min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1)), q1) AS whisker_low,
       greatest(max(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1)), q3) AS whisker_high,
       count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers
FROM quartiles q JOIN "values" v ON v.split = q.split AND v.name = q.name
GROUP BY q.split, q.name, q1, median, q3""",
        ),
        *histogram_sql("both_sets", "target", "split"),
        (
            "pairs",
            "SELECT unnest(["
            + ", ".join(f"'{a} ~ {b}'" for a in MONITORED for b in MONITORED)
            + "]) AS item, unnest(cs) AS c FROM (SELECT ["
            + ", ".join(f"corr({a}, {b})" for a in MONITORED for b in MONITORED)
            + "] AS cs FROM split WHERE split = 'train')",
        ),
        ("correlations", "SELECT item, CASE WHEN isnan(c) THEN NULL ELSE c END AS correlation FROM pairs"),
    ]
    melt("drift", "NULL", '"column"', ["mean_change_pct", "std_change_pct", "drift_detected"], "drift")
    melt("drift_summary", "NULL", "NULL", ["drifted_columns", "checked_columns"], "summary")
    melt("target_stats", "split", "NULL", ["mean", "std", "min", "max"], "stats")
    melt("target_shift", "NULL", "NULL", ["shift_pct", "alert"], "shift")
    melt("quality", "split", "NULL", ["total_rows", "total_columns"], "sizes")
    melt("dtypes", "NULL", "dtype", ["columns"], "types")
    melt("missing", "split", "name", ["missing_count", "missing_pct"], "missing")
    melt("duplicates", "split", "NULL", ["duplicate_rows"], "copies")
    melt("outliers", "split", "name", ["q1", "q3", "outliers"], "boxes")
    melt("histogram", "split", "bin", ["n", "density"], "histogram")
    box = ["q1", "median", "q3", "whisker_low", "whisker_high", "outliers"]
    melt("boxplot", "split", "NULL", box, "boxes WHERE name = 'target'")
    melt("correlation", "'train'", "item", ["correlation"], "correlations")
    ctes = [(f'"{n}"' if n == "values" else n, q) for n, q in ctes]
    return with_ctes(ctes, "\nUNION ALL\n".join(parts))


ORACLES["monitoring_report"] = _monitoring_report()
