"""Profiling, association and discretisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import blocks as B
from catalogue.blocks import per_column, q, sql
from catalogue.inputs import feature_rows, labelled, normalized, registrations, table
from catalogue.registry import n, pct, query, r
from catalogue.tables import DTYPES
from fleetprep import contracts as K
from fleetprep.operators import association, discretize, profile
from fleetprep.operators.shape import text_columns
from fleetprep.operators.split import train_test_split

TEXTS = [c for c in B.ALL_COLUMNS if DTYPES[c] == "string"]
MISSING = "count(*) - count({c})"
Y = "co2_wltp_g_km"


def _dtype(c: str) -> str:
    return f"'{DTYPES[c]}' AS dtype"


def _typed(columns, select: str, source: str = "registrations") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS variable, {_dtype(c)}, {select.replace('{c}', q(c))} FROM {source}" for c in columns)


@query("profile_overview", sql(per_column(
    B.ALL_COLUMNS, f"SELECT {{v}} AS variable, count(*) AS rows, CAST({len(B.ALL_COLUMNS)} AS BIGINT) AS columns, count({{c}}) AS non_null FROM registrations"
), "registrations"))
def _(spark, sf):
    return profile.overview(registrations(spark, sf))


@query("missingness", sql(_typed(
    B.ALL_COLUMNS, f"{MISSING} AS missing, {r(pct(MISSING, 'count(*)'))} AS missing_pct, count({{c}}) = 0 AS all_missing"
), "registrations"))
def _(spark, sf):
    return profile.missingness(registrations(spark, sf))


@query("type_report", sql(_typed(
    B.ALL_COLUMNS, f"{MISSING} AS missing, {r('round(' + pct(MISSING, 'count(*)') + ', 2)')} AS missing_pct, count(DISTINCT {{c}}) AS distinct_values"
), "registrations"))
def _(spark, sf):
    return profile.type_report(registrations(spark, sf))


_summary = f"SELECT {{v}} AS variable, count(DISTINCT {{c}}) AS distinct_values, {MISSING} AS missing, {r(pct(MISSING, 'count(*)'))} AS missing_pct FROM registrations"
_distinct_all = "count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"
_summary_all = _summary.replace("count(DISTINCT {c})", n(_distinct_all))


def _level(limits, x="distinct_values"):
    return f"CASE WHEN {x} <= {limits[0]} THEN 'low' WHEN {x} <= {limits[1]} THEN 'medium' ELSE 'high' END"


@query("categorical_summary", sql(per_column(TEXTS, _summary), "registrations"))
def _(spark, sf):
    return profile.categorical_summary(registrations(spark, sf))


@query("cardinality_level", sql(
    f"SELECT *, {_level(K.CARDINALITY_CLEANING)} AS cardinality_level FROM ({per_column(TEXTS, _summary)}) z", "registrations"
))
def _(spark, sf):
    return profile.with_cardinality(profile.categorical_summary(registrations(spark, sf)), K.CARDINALITY_CLEANING)


_encodings = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.ENCODING_BY_LEVEL.items())


@query("encoding_strategy", sql(
    f"SELECT *, CASE cardinality_level {_encodings} END AS recommended_encoding FROM (SELECT *, {_level(K.CARDINALITY_FEATURES)} AS cardinality_level "
    f"FROM ({per_column(TEXTS, _summary_all)}) z) z2", "registrations",
))
def _(spark, sf):
    summary = profile.categorical_summary(registrations(spark, sf), count_missing=True)
    return profile.with_encoding(profile.with_cardinality(summary, K.CARDINALITY_FEATURES), K.ENCODING_BY_LEVEL)


@query("value_frequencies", sql(
    "SELECT variable, value, n, " + r("100.0 * n / rows") + " AS pct FROM (SELECT *, count(*) OVER (PARTITION BY variable) AS d, "
    "sum(n) OVER (PARTITION BY variable) AS rows FROM ("
    + per_column(TEXTS, "SELECT {v} AS variable, {c} AS value, count(*) AS n FROM registrations GROUP BY {c}")
    + f") z) z2 WHERE d <= {K.CARDINALITY_CLEANING[0]}", "registrations",
))
def _(spark, sf):
    rows = registrations(spark, sf)
    return profile.value_frequencies(rows, text_columns(rows), K.CARDINALITY_CLEANING[0])


@query("duplicate_rows", (
    "SELECT rows, dup AS duplicated, " + r("100.0 * dup / rows") + " AS duplicated_pct FROM (SELECT count(*) AS rows, "
    "count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_suppkey, l_quantity, l_returnflag, l_linestatus FROM lineitem) d) AS dup FROM lineitem) z"
))
def _(spark, sf):
    return profile.duplicate_rows(table(spark, sf, "lineitem"), ["l_suppkey", "l_quantity", "l_returnflag", "l_linestatus"])


@query("duplicate_registrations", sql(
    "SELECT rows, dup AS duplicated, " + r("100.0 * dup / rows") + " AS duplicated_pct FROM (SELECT count(*) AS rows, "
    "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM registrations) d) AS dup FROM registrations) z", "registrations",
))
def _(spark, sf):
    return profile.duplicate_rows(registrations(spark, sf))


@query("identifier_check", (
    "SELECT count(*) AS rows, count(*) - count(l_orderkey) AS missing, count(DISTINCT l_orderkey) AS distinct_values, "
    "count(*) - count(DISTINCT l_orderkey) AS duplicated FROM lineitem"
))
def _(spark, sf):
    return profile.identifier_check(table(spark, sf, "lineitem"), "l_orderkey")


@query("identifier_uniqueness", sql(_typed(
    K.IDENTIFIER_CANDIDATES, f"{MISSING} AS missing, count(DISTINCT {{c}}) AS distinct_values, "
    f"{r('round(' + pct('count(DISTINCT {c})', 'count({c})') + ', 2)')} AS uniqueness_pct"
), "registrations"))
def _(spark, sf):
    return profile.identifier_uniqueness(registrations(spark, sf), K.IDENTIFIER_CANDIDATES)


NUMERIC = K.SOURCE_NUMERIC_FEATURES


@query("missing_by_group", sql(
    "SELECT fuel_type, " + ", ".join(f"{r(f'100.0 * avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)')} AS {c}" for c in NUMERIC)
    + " FROM norm GROUP BY fuel_type", "norm",
))
def _(spark, sf):
    return profile.missing_by_group(normalized(spark, sf), K.FUEL, NUMERIC)


@query("missing_by_group_long", sql(per_column(
    NUMERIC, f"SELECT fuel_type, {{v}} AS variable, count(*) AS observations, {MISSING} AS missing, {r(pct(MISSING, 'count(*)'))} AS missing_pct FROM norm GROUP BY fuel_type"
), "norm"))
def _(spark, sf):
    return profile.missing_by_group_long(normalized(spark, sf), K.FUEL, NUMERIC)


def _unexpected() -> str:
    lines = []
    for fuel, columns in K.EXPECTED_VALUES.items():
        rows, here = f"count(*) FILTER (WHERE fuel_type = '{fuel}')", f"fuel_type = '{fuel}' AND "
        for c in columns:
            gaps = f"count(*) FILTER (WHERE {here}{c} IS NULL)"
            lines.append(
                f"SELECT '{fuel}' AS fuel_type, '{c}' AS variable, {rows} AS rows, {gaps} AS missing, {r('round(' + pct(gaps, rows) + ', 2)')} AS missing_pct FROM norm"
            )
    return " UNION ALL ".join(lines)


@query("unexpected_missing", sql(_unexpected(), "norm"))
def _(spark, sf):
    return profile.unexpected_missing(normalized(spark, sf), K.FUEL, K.EXPECTED_VALUES)


@query("target_summary", sql(
    f"SELECT '{Y}' AS variable, count(*) AS rows, count(*) - count({Y}) AS missing, {r(pct(f'count(*) - count({Y})', 'count(*)'))} AS missing_pct, "
    f"count(DISTINCT {Y}) AS distinct_values, {r(f'min({Y})')} AS min, {r(f'median({Y})')} AS median, {r(f'avg({Y})')} AS mean, {r(f'max({Y})')} AS max FROM registrations",
    "registrations",
))
def _(spark, sf):
    return profile.target_summary(registrations(spark, sf), K.TARGET)


@query("target_by_group", sql(
    f"SELECT fuel_type, count(*) AS rows, count(*) - count({Y}) AS missing, count(*) FILTER (WHERE {Y} = 0) AS zeros, {r(f'avg({Y})')} AS mean, "
    f"{r(f'median({Y})')} AS median, {r(f'min({Y})')} AS min, {r(f'max({Y})')} AS max, {r(pct(f'count(*) FILTER (WHERE {Y} = 0)', 'count(*)'))} AS zero_pct, "
    f"{r(pct(f'count(*) - count({Y})', 'count(*)'))} AS missing_pct FROM norm GROUP BY fuel_type", "norm",
))
def _(spark, sf):
    return profile.target_by_group(normalized(spark, sf), K.TARGET, K.FUEL)


@query("top_groups", sql(
    f"SELECT manufacturer_make, count(*) AS n, {r(f'avg({Y})')} AS mean, {r(f'stddev_samp({Y})')} AS std, {r(f'min({Y})')} AS min, {r(f'max({Y})')} AS max "
    f"FROM registrations WHERE manufacturer_make IS NOT NULL AND {Y} IS NOT NULL GROUP BY manufacturer_make ORDER BY n DESC, manufacturer_make LIMIT 20", "registrations",
))
def _(spark, sf):
    return profile.top_groups(registrations(spark, sf), K.MAKE, K.TARGET, 20)


_described = [Y, *NUMERIC]
_percents = ", ".join(f"{r(f'quantile_cont({{c}}, {p / 100})')} AS p{p}" for p in profile.DESCRIBE_PERCENTS)


@query("describe_percentiles", sql(per_column(
    _described, f"SELECT {{v}} AS variable, count({{c}}) AS n, {r('avg({c})')} AS mean, {r('stddev_samp({c})')} AS std, {r('min({c})')} AS min, {r('max({c})')} AS max, {_percents} FROM registrations"
), "registrations"))
def _(spark, sf):
    return profile.describe(registrations(spark, sf), _described)


@query("distribution_summary", sql(
    f"SELECT '{Y}' AS variable, {r(f'min({Y})')} AS min, {r(f'quantile_cont({Y}, 0.25)')} AS q1, {r(f'median({Y})')} AS median, {r(f'avg({Y})')} AS mean, "
    f"{r(f'quantile_cont({Y}, 0.75)')} AS q3, {r(f'max({Y})')} AS max, {r(f'stddev_samp({Y})')} AS std, {r(f'skewness({Y})')} AS skewness FROM registrations", "registrations",
))
def _(spark, sf):
    return profile.distribution_summary(registrations(spark, sf), K.TARGET)


def _histogram(bins: int) -> str:
    return (
        f"SELECT CAST({bins} AS BIGINT) AS bins, b.bin, {r(f'e.lo + b.bin * ((e.hi - e.lo) / {bins})')} AS lo, {r(f'e.lo + (b.bin + 1) * ((e.hi - e.lo) / {bins})')} AS hi, "
        f"count(x.{Y}) AS n FROM (SELECT unnest(range({bins})) AS bin) b CROSS JOIN (SELECT min({Y}) AS lo, max({Y}) AS hi FROM registrations) e "
        f"LEFT JOIN registrations x ON least(floor((x.{Y} - e.lo) / ((e.hi - e.lo) / {bins})), {bins - 1}) = b.bin GROUP BY b.bin, e.lo, e.hi"
    )


@query("histogram", sql(_histogram(50) + " UNION ALL " + _histogram(100), "registrations"))
def _(spark, sf):
    rows = registrations(spark, sf)
    parts = [profile.histogram(rows, K.TARGET, k).select(F.lit(k).alias("bins"), "*") for k in (50, 100)]
    return parts[0].unionByName(parts[1])


@query("box_summary", sql(
    f"WITH c AS (SELECT quantile_cont({Y}, 0.25) AS q1, median({Y}) AS median, quantile_cont({Y}, 0.75) AS q3 FROM registrations) "
    f"SELECT {r('c.q1')} AS q1, {r('c.median')} AS median, {r('c.q3')} AS q3, {r(f'min(x.{Y}) FILTER (WHERE x.{Y} >= c.q1 - 1.5 * (c.q3 - c.q1))')} AS whisker_lo, "
    f"{r(f'max(x.{Y}) FILTER (WHERE x.{Y} <= c.q3 + 1.5 * (c.q3 - c.q1))')} AS whisker_hi, "
    f"count(*) FILTER (WHERE x.{Y} < c.q1 - 1.5 * (c.q3 - c.q1) OR x.{Y} > c.q3 + 1.5 * (c.q3 - c.q1)) AS outliers "
    "FROM registrations x, c GROUP BY c.q1, c.median, c.q3", "registrations",
))
def _(spark, sf):
    return profile.box_summary(registrations(spark, sf), K.TARGET)


@query("tail_above_quantile", sql(
    f"WITH c AS (SELECT quantile_cont({Y}, 0.99) AS t FROM registrations) SELECT {r('c.t')} AS threshold, count(*) FILTER (WHERE x.{Y} > c.t) AS n, "
    f"{r(pct(f'count(*) FILTER (WHERE x.{Y} > c.t)', f'count(x.{Y})'))} AS pct, {r(f'max(x.{Y}) FILTER (WHERE x.{Y} > c.t)')} AS max FROM registrations x, c GROUP BY c.t",
    "registrations",
))
def _(spark, sf):
    return profile.tail_above_quantile(registrations(spark, sf), K.TARGET, 0.99)


_makers = ["manufacturer_pool", "manufacturer_name_eu", "manufacturer_name_oem", "manufacturer_make"]
_dependency_pairs = [(a, b) for a in _makers for b in _makers if a != b]


@query("column_dependency", sql(" UNION ALL ".join(
    f"SELECT '{a}' AS source, '{b}' AS target, count(*) AS source_values, {r('round(avg(k), 3)')} AS mean_targets, {r('median(k)')} AS median_targets, "
    f"max(k) AS max_targets, {r('round(' + pct('count(*) FILTER (WHERE k = 1)', 'count(*)') + ', 2)')} AS one_target_pct FROM "
    f"(SELECT {a}, count(DISTINCT {b}) AS k FROM registrations WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY {a}) z" for a, b in _dependency_pairs
), "registrations"))
def _(spark, sf):
    return association.column_dependency(registrations(spark, sf), _dependency_pairs)


_corr = f"corr({{c}}, {Y}) FILTER (WHERE {{c}} IS NOT NULL AND {Y} IS NOT NULL)"


@query("target_correlation", sql(per_column(
    K.LEAKAGE_CANDIDATES, f"SELECT {{v}} AS variable, count({{c}}) AS non_null, {r(pct(MISSING, 'count(*)'))} AS missing_pct, {r(_corr)} AS correlation, {r('abs(' + _corr + ')')} AS abs_correlation FROM registrations"
), "registrations"))
def _(spark, sf):
    return association.target_correlation(registrations(spark, sf), K.TARGET, K.LEAKAGE_CANDIDATES)


_eta_columns = ["fuel_type", "fuel_mode", "vehicle_category_type", "manufacturer_make", "country"]


@query("eta_squared", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, count(*) AS groups, {n('sum(k)')} AS n, {r('coalesce(sum(k * (m - g) * (m - g)) / nullif(max(t), 0), 0)')} AS eta_squared FROM "
    f"(SELECT {c}, count(*) AS k, avg({Y}) AS m, max(g) AS g, max(t) AS t FROM (SELECT *, avg({Y}) OVER () AS g, var_pop({Y}) OVER () * count(*) OVER () AS t "
    f"FROM norm WHERE {c} IS NOT NULL AND {Y} IS NOT NULL) z GROUP BY {c}) z2" for c in _eta_columns
), "norm"))
def _(spark, sf):
    return association.eta_squared(normalized(spark, sf), K.TARGET, _eta_columns)


_candidates = [c for c in B.ALL_COLUMNS if c != Y]


@query("candidate_analysis", sql(_typed(
    _candidates, f"{n(_distinct_all)} AS distinct_values, {r(pct(MISSING, 'count(*)'))} AS missing_pct, {r(pct(_distinct_all, 'count(*)'))} AS distinct_ratio_pct"
), "registrations"))
def _(spark, sf):
    return profile.candidate_analysis(registrations(spark, sf), K.TARGET)


def _samples(columns, size: int) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count(DISTINCT {c}) AS distinct_values, {r('round(' + pct(MISSING.replace('{c}', c), 'count(*)') + ', 2)')} AS missing_pct, "
        f"(SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT {c} AS v FROM registrations WHERE {c} IS NOT NULL ORDER BY v LIMIT {size}) s) AS \"values\" FROM registrations"
        for c in columns
    )


@query("sample_values", sql(_samples([c for c in TEXTS if c != "mms"], 10), "registrations"))
def _(spark, sf):
    return profile.sample_values(registrations(spark, sf), [c for c in TEXTS if c != "mms"], 10)


_codes = ["vehicle_family_id", "type_approval_number", "vehicle_type", "vehicle_variant", "vehicle_version", "commercial_name", "rlfi", "innovative_technology"]
_code_like = r"regexp_matches(v, '\d') AND (regexp_matches(v, '[-_*./]') OR regexp_matches(v, '[A-Za-z]'))"


@query("code_like_share", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, {r(f'round(100.0 * avg(CASE WHEN {_code_like} THEN 1 ELSE 0 END), 2)')} AS code_like_pct, {r('round(avg(length(v)), 2)')} AS mean_length "
    f"FROM (SELECT DISTINCT {B.strip(c)} AS v FROM registrations WHERE {c} IS NOT NULL) z" for c in _codes
), "registrations"))
def _(spark, sf):
    return profile.code_like_share(registrations(spark, sf), _codes)


_diagnosed = [*K.CATEGORICAL_FEATURES, *NUMERIC]


def _diagnostic() -> str:
    lines = []
    for c in _diagnosed:
        stats = ", ".join(
            f"{r(f'{f}({c})') if c in NUMERIC else 'CAST(NULL AS DOUBLE)'} AS {a}" for f, a in
            [("min", "min"), ("median", "median"), ("avg", "mean"), ("max", "max")]
        )
        gaps = MISSING.replace("{c}", c)
        lines.append(
            f"SELECT '{c}' AS variable, {gaps} AS missing, {r(pct(gaps, 'count(*)'))} AS missing_pct, count(DISTINCT {c}) AS distinct_values, {stats} FROM features"
        )
    return " UNION ALL ".join(lines)


@query("missing_diagnostic", sql(_diagnostic(), "features"))
def _(spark, sf):
    return profile.missing_diagnostic(feature_rows(spark, sf), _diagnosed)


@query("category_control", sql(
    "SELECT * FROM (SELECT 'manufacturer_make' AS variable, manufacturer_make AS item, count(*) AS n FROM norm WHERE manufacturer_make IS NOT NULL "
    "GROUP BY manufacturer_make ORDER BY n DESC, item LIMIT 30) z UNION ALL "
    + per_column(K.CATEGORICAL_FEATURES, "SELECT {v}, {c}, count(*) FROM norm WHERE {c} IS NOT NULL GROUP BY {c}"), "norm",
))
def _(spark, sf):
    return profile.category_control(normalized(spark, sf), K.MAKE, K.CATEGORICAL_FEATURES, 30)


@query("dataset_report", sql(
    "SELECT part AS dataset, count(*) AS rows, CAST(13 AS BIGINT) AS variables, CASE part WHEN 'train' THEN 'development' ELSE 'final test' END AS role FROM split GROUP BY part "
    "UNION ALL SELECT 'full', count(*), CAST(13 AS BIGINT), 'source' FROM features", "split",
))
def _(spark, sf):
    rows = feature_rows(spark, sf)
    split = train_test_split(rows, K.KEY, K.TEST_SHARE, K.SEED, K.PART)
    variables = len([*K.CATEGORICAL_FEATURES, *K.NUMERIC_FEATURES])
    parts = profile.part_report(split, K.PART, {"train": "development", "test": "final test"}, variables)
    return parts.unionByName(profile.dataset_report({"full": (rows, "source")}, variables))


# ---- discretisation ----

K_BINS = 5


def _right_closed(x: str, edges: str, k: int) -> str:
    """Bin number of x among k bins with the edges in a list column."""
    return "CASE " + " ".join(f"WHEN {x} <= {edges}[{i + 1}] THEN {i}" for i in range(1, k)) + f" ELSE {k} END"


@query("cut_uniform", sql(
    f"WITH e AS (SELECT min({Y}) AS lo, max({Y}) AS hi FROM labelled) "
    f"SELECT b.bin, {r(f'CASE WHEN b.bin = 1 THEN e.lo - 0.001 * (e.hi - e.lo) ELSE e.lo + (e.hi - e.lo) * (b.bin - 1) / {K_BINS} END')} AS lo, "
    f"{r(f'CASE WHEN b.bin = {K_BINS} THEN e.hi ELSE e.lo + (e.hi - e.lo) * b.bin / {K_BINS} END')} AS hi, count(x.{Y}) AS n, "
    f"{r(f'100.0 * count(x.{Y}) / (SELECT count(*) FROM labelled)')} AS pct "
    f"FROM (SELECT unnest(range(1, {K_BINS + 1})) AS bin) b CROSS JOIN e LEFT JOIN labelled x ON (b.bin = 1 OR x.{Y} > e.lo + (e.hi - e.lo) * (b.bin - 1) / {K_BINS}) "
    f"AND (b.bin = {K_BINS} OR x.{Y} <= e.lo + (e.hi - e.lo) * b.bin / {K_BINS}) GROUP BY b.bin, e.lo, e.hi", "labelled",
))
def _(spark, sf):
    rows = labelled(spark, sf)
    return discretize.bin_counts(rows, K.TARGET, {"uniform": discretize.uniform_edges(rows, K.TARGET, K_BINS)}).drop("strategy")


def _quantile_bins(k: int) -> str:
    """(k, bin, lo, hi, n, pct) of quantile bins with equal edges merged."""
    steps = ", ".join(repr(i / k) for i in range(k + 1))
    return (
        f"SELECT CAST({k} AS BIGINT) AS k, e.bin, e.lo, e.hi, count(x.{Y}) AS n, 100.0 * count(x.{Y}) / (SELECT count(*) FROM labelled) AS pct FROM ("
        "SELECT row_number() OVER (ORDER BY v) AS bin, v AS lo, lead(v) OVER (ORDER BY v) AS hi FROM "
        f"(SELECT DISTINCT unnest(quantile_cont({Y}, [{steps}])) AS v FROM labelled) d) e "
        f"LEFT JOIN labelled x ON (x.{Y} > e.lo OR (e.bin = 1 AND x.{Y} = e.lo)) AND x.{Y} <= e.hi WHERE e.hi IS NOT NULL GROUP BY e.bin, e.lo, e.hi"
    )


@query("cut_quantile", sql(f"SELECT bin, {r('lo')} AS lo, {r('hi')} AS hi, n, {r('pct')} AS pct FROM ({_quantile_bins(K_BINS)}) z", "labelled"))
def _(spark, sf):
    rows = labelled(spark, sf)
    edges = discretize.quantile_edges(rows, K.TARGET, [K_BINS])[K_BINS]
    return discretize.bin_counts(rows, K.TARGET, {"quantile": edges}).drop("strategy")


@query("quantile_class_counts", sql(
    f"SELECT k AS requested, count(*) AS bins, {r('min(pct)')} AS min_pct, {r('max(pct)')} AS max_pct, {r('max(pct) - min(pct)')} AS spread FROM ("
    + " UNION ALL ".join(_quantile_bins(k) for k in (3, 4, 5, 6, 7)) + ") z GROUP BY k", "labelled",
))
def _(spark, sf):
    rows = labelled(spark, sf)
    edges = discretize.quantile_edges(rows, K.TARGET, [3, 4, 5, 6, 7])
    counts = discretize.bin_counts(rows, K.TARGET, {str(k): e for k, e in edges.items()})
    return discretize.bin_spread(counts).select(F.col("strategy").cast("int").alias("requested"), "bins", "min_pct", "max_pct", "spread")


def _scenario_bins(label: str, bounds) -> str:
    ends = [None, *bounds, None]
    lines = []
    for i, (lo, hi) in enumerate(zip(ends, ends[1:]), start=1):
        test = " AND ".join(filter(None, [f"{Y} > {lo}" if lo is not None else "", f"{Y} <= {hi}" if hi is not None else ""]))
        lines.append(f"SELECT '{label}' AS strategy, CAST({i} AS BIGINT) AS bin, count(*) FILTER (WHERE {test}) AS n, 100.0 * count(*) FILTER (WHERE {test}) / count(*) AS pct FROM labelled")
    return " UNION ALL ".join(lines)


@query("bound_scenarios", sql(
    f"SELECT strategy AS scenario, count(*) AS bins, {r('min(pct)')} AS min_pct, {r('max(pct)')} AS max_pct, {r('max(pct) - min(pct)')} AS spread FROM ("
    + " UNION ALL ".join(_scenario_bins(s, b) for s, b in K.BOUND_SCENARIOS.items()) + ") z GROUP BY strategy", "labelled",
))
def _(spark, sf):
    edges = {s: discretize.open_edges(b) for s, b in K.BOUND_SCENARIOS.items()}
    return discretize.bin_spread(discretize.bin_counts(labelled(spark, sf), K.TARGET, edges)).withColumnRenamed("strategy", "scenario")


@query("discretization_compare", sql(
    f"SELECT 'quantile' AS strategy, bin, n, {r('pct')} AS pct FROM ({_quantile_bins(K_BINS)}) z UNION ALL "
    + f"SELECT strategy, bin, n, {r('pct')} AS pct FROM ({_scenario_bins('classes', K.CLASS_BOUNDS)}) z2 UNION ALL "
    + f"SELECT 'uniform', bin, count(*) , {r('100.0 * count(*) / max(total)')} FROM (SELECT greatest(1, least({K_BINS}, CAST(ceil(({Y} - lo) / ((hi - lo) / {K_BINS})) AS BIGINT))) AS bin, total FROM "
    f"(SELECT {Y}, min({Y}) OVER () AS lo, max({Y}) OVER () AS hi, count(*) OVER () AS total FROM labelled) w) u GROUP BY bin", "labelled",
))
def _(spark, sf):
    rows = labelled(spark, sf)
    strategies = {
        "uniform": discretize.uniform_edges(rows, K.TARGET, K_BINS),
        "quantile": discretize.quantile_edges(rows, K.TARGET, [K_BINS])[K_BINS],
        "classes": discretize.open_edges(K.CLASS_BOUNDS),
    }
    return discretize.bin_counts(rows, K.TARGET, strategies).select("strategy", "bin", "n", "pct")


def _classes_sql() -> str:
    lines = []
    for c in K.CLASS_LABELS:
        test = f"count(*) FILTER (WHERE {B.emission_class(Y)} = '{c}')"
        lines.append(
            f"SELECT '{c}' AS class, '{K.class_intervals()[c]}' AS interval, '{K.CLASS_DESCRIPTIONS[c]}' AS description, {test} AS n, {r(pct(test, f'count({Y})'))} AS pct FROM registrations"
        )
    return " UNION ALL ".join(lines)


@query("class_distribution", sql(_classes_sql(), "registrations"))
def _(spark, sf):
    return discretize.class_distribution(
        registrations(spark, sf), K.TARGET, K.CLASS_BOUNDS, K.CLASS_LABELS, K.class_intervals(), K.CLASS_DESCRIPTIONS
    )
