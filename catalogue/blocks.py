"""Named SQL blocks the oracle queries are put together from."""

from __future__ import annotations

from catalogue.inputs import MODELS, REGISTRATIONS, TABLES
from fleetprep import contracts as K

TEXT = [
    "country", "vehicle_family_id", "manufacturer_pool", "manufacturer_name_eu", "manufacturer_name_oem",
    "type_approval_number", "vehicle_type", "vehicle_variant", "vehicle_version", "manufacturer_make",
    "commercial_name", "vehicle_category_type", "vehicle_category", "fuel_type", "fuel_mode",
    "innovative_technology", "status", "emission_standard", "rlfi", "mms",
]
CATEGORIES = {
    "vehicle_category_type": ["M1", "M1G", "N1"],
    "fuel_type": [
        "diesel", "diesel/electric", "e85", "electric", "hydrogen", "lpg", "ng", "petrol", "petrol/electric", "unknown",
    ],
    "fuel_mode": ["B", "E", "F", "H", "M", "P"],
}
ALL_COLUMNS = [
    "vehicle_record_id", "country", "vehicle_family_id", "manufacturer_pool", "manufacturer_name_eu",
    "manufacturer_name_oem", "type_approval_number", "vehicle_type", "vehicle_variant", "vehicle_version",
    "manufacturer_make", "commercial_name", "vehicle_category_type", "vehicle_category", "new_registrations",
    "mass_running_order_kg", "wltp_test_mass_kg", "co2_wltp_g_km", "fuel_type", "fuel_mode", "engine_capacity_cm3",
    "engine_power_kw", "electric_energy_consumption_wh_km", "innovative_technology", "co2_reduction_wltp_g_km",
    "status", "registration_year", "registration_date", "registration_date_dirty", "fuel_consumption",
    "emission_standard", "rlfi", "electric_range_km", "mms",
]
LONGS = ["vehicle_record_id", "new_registrations", "registration_year"]
DOUBLES = K.DOUBLE_COLUMNS
NOT_IN_CLEANED = ["mms", "registration_date_dirty", "vehicle_category", "new_registrations", "status", "registration_year"]
CLEANED_COLUMNS = [c for c in ALL_COLUMNS if c not in NOT_IN_CLEANED]


def q(column: str) -> str:
    return '"' + column + '"'


def quoted(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def spelling_key(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(upper(trim({x})), '[._/-]+', ' ', 'g'), '\s+', ' ', 'g'))"


def digits(x: str) -> str:
    return rf"coalesce(regexp_full_match({strip(x)}, '\d+'), false)"


def emission_class(x: str) -> str:
    cases = " ".join(f"WHEN {x} <= {b} THEN '{c}'" for b, c in zip(K.CLASS_BOUNDS, K.CLASS_LABELS))
    return f"CASE WHEN {x} IS NULL THEN NULL {cases} ELSE '{K.CLASS_LABELS[-1]}' END"


def per_column(columns, select: str) -> str:
    """UNION ALL of one SELECT per column; {c} is the quoted column, {v} its name as a literal."""
    return " UNION ALL ".join(select.replace("{c}", q(c)).replace("{v}", f"'{c}'") for c in columns)


_upper = {"vehicle_category_type", "fuel_mode"}
_norm = ", ".join(
    f"{'upper(' + strip(c) + ')' if c in _upper else strip(c)} AS {c}" for c in TEXT
)
_pair = "SELECT upper(trim(manufacturer_name_eu)) AS eu, upper(trim(manufacturer_name_oem)) AS oem, manufacturer_make AS make"


def _median(column: str, table: str = "train_filled") -> str:
    if column in K.CONDITIONAL_RULES:
        return f"(SELECT median(CASE WHEN fuel_type IN ({quoted(K.CONDITIONAL_RULES[column])}) THEN {column} END) FROM {table})"
    return f"(SELECT median({column}) FROM {table})"


def _fill(column: str) -> str:
    if column in K.CONDITIONAL_RULES:
        groups = quoted(K.CONDITIONAL_RULES[column])
        return (
            f"CASE WHEN {column} IS NOT NULL THEN {column} WHEN fuel_type IN ({groups}) THEN {_median(column)} ELSE 0.0 END"
        )
    if column in K.ZERO_FILL_COLUMNS:
        return f"coalesce({column}, 0.0)"
    return f"coalesce({column}, {_median(column)})"


_mode = "(SELECT {c} FROM split WHERE part = 'train' AND {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
HASH = "md5(concat(CAST(vehicle_record_id AS VARCHAR), '|{seed}'))"


def split_sql(source: str, seed: str, test: str, train: str, columns: str = "*") -> str:
    return (
        f"SELECT {columns}, CASE WHEN rn <= (n + 4) // 5 THEN '{test}' ELSE '{train}' END AS part FROM (SELECT *, "
        f"row_number() OVER (ORDER BY {HASH.format(seed=seed)}, vehicle_record_id) AS rn, count(*) OVER () AS n FROM {source}) z"
    )


_exclude = "* EXCLUDE (rn, n)"
_models = ", ".join(f"('{m}', CAST({d} AS DOUBLE), CAST({s} AS DOUBLE))" for m, d, s in MODELS)

BLOCKS: dict[str, tuple[list[str], str]] = {
    "registrations": ([], REGISTRATIONS.format(**{t: t for t in TABLES})),
    "labelled": (["registrations"], "SELECT * FROM registrations WHERE co2_wltp_g_km IS NOT NULL"),
    "norm": (
        ["registrations"],
        f"SELECT * EXCLUDE (registration_date_dirty) REPLACE ({_norm}, try_cast(registration_date AS TIMESTAMP) AS registration_date) "
        "FROM registrations",
    ),
    "made": (["norm"], f"SELECT *, {digits('manufacturer_make')} AS is_num, {spelling_key('manufacturer_make')} AS cmp FROM norm"),
    "variants": (
        ["made"],
        "SELECT cmp AS comparison_key, manufacturer_make AS spelling, count(*) AS n FROM made "
        "WHERE manufacturer_make IS NOT NULL AND NOT is_num GROUP BY ALL",
    ),
    "canon": (
        ["variants"],
        "SELECT comparison_key, spelling AS canonical, observations, variants FROM (SELECT *, "
        "row_number() OVER (PARTITION BY comparison_key ORDER BY n DESC, spelling) AS rn, "
        "sum(n) OVER (PARTITION BY comparison_key) AS observations, count(*) OVER (PARTITION BY comparison_key) AS variants "
        "FROM variants) z WHERE rn = 1",
    ),
    "spelled": (
        ["made", "canon"],
        "SELECT m.* EXCLUDE (cmp) REPLACE (coalesce(c.canonical, m.manufacturer_make) AS manufacturer_make) "
        "FROM made m LEFT JOIN canon c ON c.comparison_key = m.cmp AND NOT m.is_num",
    ),
    "pair_counts": (
        ["spelled"],
        f"SELECT eu, oem, make, count(*) AS observations FROM ({_pair} FROM spelled WHERE manufacturer_make IS NOT NULL AND NOT is_num) z "
        "WHERE eu IS NOT NULL AND oem IS NOT NULL GROUP BY ALL",
    ),
    "pair_shares": (
        ["pair_counts"],
        "SELECT *, sum(observations) OVER (PARTITION BY eu, oem) AS pair_observations, "
        "CAST(observations AS DOUBLE) / sum(observations) OVER (PARTITION BY eu, oem) AS share FROM pair_counts",
    ),
    "pairs": (
        ["pair_shares"],
        "SELECT eu, oem, make, observations, share FROM (SELECT *, row_number() OVER (PARTITION BY eu, oem ORDER BY observations DESC, make) AS rn "
        f"FROM pair_shares) z WHERE rn = 1 AND share >= {K.MIN_PAIR_SHARE}",
    ),
    "resolved": (
        ["spelled", "pairs"],
        "SELECT s.* REPLACE (CASE WHEN s.is_num THEN p.make ELSE s.manufacturer_make END AS manufacturer_make) "
        "FROM spelled s LEFT JOIN pairs p ON s.is_num AND p.eu = upper(trim(s.manufacturer_name_eu)) AND p.oem = upper(trim(s.manufacturer_name_oem))",
    ),
    "cleaned": (
        ["resolved"],
        "SELECT " + ", ".join(CLEANED_COLUMNS) + " FROM (SELECT * REPLACE (CASE WHEN upper(trim(manufacturer_make)) = 'VOLKSWAGEN VW' "
        "THEN 'VOLKSWAGEN' ELSE manufacturer_make END AS manufacturer_make) FROM resolved) z WHERE co2_wltp_g_km IS NOT NULL",
    ),
    "features": (
        ["norm"],
        "SELECT vehicle_record_id, " + ", ".join(["manufacturer_make", *K.CATEGORICAL_FEATURES, *K.SOURCE_NUMERIC_FEATURES])
        + ", sin(2 * pi() * (month(registration_date) - 1) / 12) AS registration_month_sin, "
        "cos(2 * pi() * (month(registration_date) - 1) / 12) AS registration_month_cos, co2_wltp_g_km "
        "FROM norm WHERE co2_wltp_g_km IS NOT NULL",
    ),
    "split": (["features"], split_sql("features", "42", "test", "train", _exclude)),
    "filled": (
        ["split"],
        "SELECT * REPLACE (" + ", ".join(f"coalesce({c}, {_mode.format(c=c)}) AS {c}" for c in K.CATEGORICAL_FEATURES) + ") FROM split",
    ),
    "train_filled": (["filled"], "SELECT * FROM filled WHERE part = 'train'"),
    "flagged": (
        ["filled"],
        "SELECT *, " + ", ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END AS {f}" for c, f in K.INDICATORS.items()) + " FROM filled",
    ),
    "imputed": (
        ["flagged", "train_filled"],
        "SELECT * REPLACE (" + ", ".join(f"{_fill(c)} AS {c}" for c in K.NUMERIC_FEATURES) + ") FROM flagged",
    ),
    "train_imputed": (["imputed"], "SELECT * FROM imputed WHERE part = 'train'"),
    "scaled": (
        ["imputed", "train_imputed"],
        "SELECT * REPLACE (" + ", ".join(
            f"({c} - (SELECT avg({c}) FROM train_imputed)) / (SELECT stddev_pop({c}) FROM train_imputed) AS {c}" for c in K.NUMERIC_FEATURES
        ) + ") FROM imputed",
    ),
    "predictions": (
        ["labelled"],
        "SELECT vehicle_record_id, y_true, y_pred, " + emission_class("y_true") + " AS class_true, " + emission_class("y_pred")
        + " AS class_pred FROM (SELECT vehicle_record_id, co2_wltp_g_km AS y_true, "
        "co2_wltp_g_km + (vehicle_record_id % 15 - 7) / CAST(4 AS DOUBLE) AS y_pred FROM labelled) z",
    ),
    "labelled_split": (["labelled"], split_sql("labelled", "42", "validation", "train", _exclude)),
    "model_predictions": (
        ["labelled_split"],
        "SELECT *, " + emission_class("y_true") + " AS class_true, " + emission_class("y_pred") + " AS class_pred FROM ("
        "SELECT s.vehicle_record_id, s.part, m.model, m.training_seconds, s.co2_wltp_g_km AS y_true, s.co2_wltp_g_km + "
        "(s.vehicle_record_id % 15 - 7) / (m.divisor * CASE WHEN s.part = 'train' THEN CAST(1.25 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END) AS y_pred "
        f"FROM labelled_split s, (VALUES {_models}) m(model, divisor, training_seconds)) z",
    ),
    "regression_measures": (
        ["model_predictions"],
        "SELECT model, part, count(*) AS n, avg(abs(y_true - y_pred)) AS mae, sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse, "
        "1 - sum((y_true - y_pred) * (y_true - y_pred)) / (var_pop(y_true) * count(*)) AS r2, max(training_seconds) AS training_seconds "
        "FROM model_predictions GROUP BY ALL",
    ),
    "regression_comparison": (
        ["regression_measures"],
        "SELECT t.model, t.mae AS mae_train, v.mae AS mae_validation, v.mae - t.mae AS mae_gap, t.rmse AS rmse_train, "
        "v.rmse AS rmse_validation, v.rmse - t.rmse AS rmse_gap, t.r2 AS r2_train, v.r2 AS r2_validation, t.r2 - v.r2 AS r2_gap, "
        "t.training_seconds FROM regression_measures t JOIN regression_measures v ON v.model = t.model "
        "AND t.part = 'train' AND v.part = 'validation'",
    ),
}
MATERIALIZED = {"registrations", "made", "spelled", "features", "split", "filled", "imputed", "model_predictions", "labelled_split"}


def sql(select: str, *blocks: str) -> str:
    """The query with the blocks it names, and those they need, in front."""
    order: list[str] = []

    def add(block: str) -> None:
        if block not in order:
            for needed in BLOCKS[block][0]:
                add(needed)
            order.append(block)

    for block in blocks:
        add(block)
    ctes = [f"{b} AS {'MATERIALIZED ' if b in MATERIALIZED else ''}({BLOCKS[b][1]})" for b in order]
    if not ctes:
        return select
    if select.lstrip().upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + select.lstrip()[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + select
