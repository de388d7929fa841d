"""Scans, schema work, cleaning and features."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from catalogue import blocks as B
from catalogue.blocks import q, sql
from catalogue.inputs import cleaned_rows, feature_rows, labelled, normalized, registrations, split_rows
from catalogue.registry import n, query, r
from fleetprep import contracts as K
from fleetprep.cluster import shared_folder, stage
from fleetprep.functions.text import comparison_key, name
from fleetprep.functions.values import parse_bound, present, right_closed_class
from fleetprep.operators import makes, schema
from fleetprep.operators.checks import rows_of
from fleetprep.operators.dictionary import dictionary
from fleetprep.operators.fingerprint import fingerprint
from fleetprep.operators.infer import KINDS, infer_types
from fleetprep.operators.profile import numeric_text_rows
from fleetprep.operators.split import parts_overlap
from fleetprep.plans import cleaning, features
from fleetprep.sources.tables import load_split, scan_parquet, write_split

DTYPES = {c: "bigint" if c in B.LONGS else "double" if c in B.DOUBLES else "string" for c in B.ALL_COLUMNS}
HEAD_ROWS = 1000


def _out(columns, renames={}) -> str:
    """Select list in the shape tidy gives."""
    return ", ".join(
        f"{r(q(c)) if c in B.DOUBLES + K.TEMPORAL_FEATURES else q(c)} AS {q(renames.get(c, c))}" for c in columns
    )


# ---- scans ----

@query("scan_parquet_head", (
    f"SELECT count(*) AS row_count, least(count(*), {HEAD_ROWS}) AS head_rows, {n(f'sum(o_orderkey) FILTER (WHERE file_row_number < {HEAD_ROWS})')} AS key_sum "
    f"FROM (SELECT o_orderkey, row_number() OVER () - 1 AS file_row_number FROM orders)"
))
def _(spark, sf):
    path = f"{sf}/orders.parquet"
    head = scan_parquet(spark, path, HEAD_ROWS).agg(F.count("*").alias("head_rows"), F.sum("o_orderkey").alias("key_sum")).withColumn("k", F.lit(1))
    full = scan_parquet(spark, path).agg(F.count("*").alias("row_count")).withColumn("k", F.lit(1))
    return full.join(head, "k").drop("k")


_CELLS = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus"))


@query("table_fingerprint", (
    f"WITH d AS (SELECT md5({_CELLS}) AS d FROM orders) "
    "SELECT count(*) AS row_count, CAST(sum(CAST(CAST(concat('0x', d[1:15]) AS BIGINT) AS HUGEINT)) AS VARCHAR) AS hash_sum, "
    "bit_xor(CAST(concat('0x', d[17:31]) AS BIGINT)) AS hash_xor FROM d"
))
def _(spark, sf):
    return fingerprint(scan_parquet(spark, f"{sf}/orders.parquet"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])


# text columns of every type: whole, decimal, date, mixed, with missing tokens, and one without values
_TEXTS = {
    "whole": "CAST(o_custkey AS STRING)", "decimal": "CASE WHEN o_orderkey % 3 = 0 THEN '1.5e3' ELSE CAST(o_custkey AS STRING) END",
    "day": "substr(CAST(o_orderdate AS STRING), 1, 10)", "mixed": "CASE WHEN o_orderkey % 97 = 5 THEN o_orderstatus ELSE CAST(o_orderkey AS STRING) END",
    "days_and_numbers": "CASE WHEN o_orderkey % 50 = 7 THEN substr(CAST(o_orderdate AS STRING), 1, 10) ELSE '-12' END",
    "gaps": "CASE WHEN o_orderkey % 2 = 0 THEN 'N/A' WHEN o_orderkey % 5 = 1 THEN CAST(NULL AS STRING) ELSE '.5' END",
    "no_day": "CASE WHEN o_orderkey % 11 = 3 THEN '2024-02-30' ELSE '2024-02-28' END", "none": "CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'null' END",
    "long_number": "CAST(o_orderkey AS STRING) || '000000000000000000'", "words": "o_orderpriority",
}
_TOKENS = ", ".join(f"'{t}'" for t in K.MISSING_TOKENS)
_KIND = (
    f"CASE WHEN v IS NULL OR v IN ({_TOKENS}) THEN 'missing' WHEN regexp_full_match(v, '[+-]?[0-9]{{1,18}}') THEN 'whole' "
    "WHEN regexp_full_match(v, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]{1,3})?') THEN 'decimal' "
    "WHEN regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_cast(v AS DATE) IS NOT NULL THEN 'date' ELSE 'text' END"
)


@query("infer_types", (
    "WITH l AS (" + " UNION ALL ".join(f"SELECT '{c}' AS variable, {e} AS v FROM orders" for c, e in _TEXTS.items()) + "), "
    f"k AS (SELECT variable, v, {_KIND} AS kind FROM l), "
    "n AS (SELECT variable, " + ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}, min(v) FILTER (WHERE kind = '{k}') AS least_{k}" for k in KINDS) + " FROM k GROUP BY variable) "
    "SELECT variable, CASE WHEN n_whole + n_decimal + n_date + n_text = 0 THEN 'empty' WHEN n_text > 0 OR (n_date > 0 AND n_whole + n_decimal > 0) THEN 'text' "
    "WHEN n_date > 0 THEN 'date' WHEN n_decimal > 0 THEN 'decimal' ELSE 'whole' END AS type, " + ", ".join(f"n_{k} AS {q(k)}" for k in KINDS) + ", "
    "CASE WHEN n_text > 0 AND n_whole + n_decimal + n_date > 0 THEN least_text WHEN n_text = 0 AND n_date > 0 AND n_whole + n_decimal > 0 "
    "THEN CASE WHEN n_date <= n_whole + n_decimal THEN least_date ELSE least(least_whole, least_decimal) END END AS counter_example FROM n"
))
def _(spark, sf):
    orders = scan_parquet(spark, f"{sf}/orders.parquet")
    return infer_types(orders.select(*[F.expr(e).alias(c) for c, e in _TEXTS.items()]))


@query("category_dictionary", (
    "SELECT value, CAST(row_number() OVER (ORDER BY n DESC, value) - 1 AS BIGINT) AS id FROM (SELECT CAST(o_custkey AS VARCHAR) AS value, count(*) AS n FROM orders GROUP BY 1)"
))
def _(spark, sf):
    values = scan_parquet(spark, f"{sf}/orders.parquet").groupBy(F.col("o_custkey").cast("string").alias("value")).agg(F.count("*").alias("n"))
    return dictionary(values)


@query("load_split", sql(
    f"SELECT part, count(*) AS rows_in_part, {n('sum(vehicle_record_id)')} AS key_sum, count(co2_wltp_g_km) AS targets FROM split GROUP BY part", "split"
))
def _(spark, sf):
    path = os.path.join(shared_folder(spark), "split-" + uuid.uuid4().hex)
    write_split(split_rows(spark, sf), path)
    return load_split(spark, path).groupBy("part").agg(
        F.count("*").alias("rows_in_part"), F.sum(K.KEY).alias("key_sum"), F.count(K.TARGET).alias("targets")
    )


# ---- schema ----

@query("drop_empty_columns", sql(f"SELECT {_out([c for c in B.ALL_COLUMNS if c != 'mms'])} FROM registrations", "registrations"))
def _(spark, sf):
    return schema.drop_empty_columns(registrations(spark, sf))


@query("normalize_column_names", sql(f"SELECT {_out(B.ALL_COLUMNS)} FROM registrations", "registrations"))
def _(spark, sf):
    headers = {c: f" {h} " for h, c in K.SOURCE_NAMES.items()}
    source = registrations(spark, sf)
    return schema.normalize_column_names(source.toDF(*[headers.get(c, c) for c in source.columns]), K.SOURCE_NAMES)


@query("parse_dates", sql(
    "SELECT vehicle_record_id, registration_date_dirty AS text, "
    "strftime(try_cast(registration_date_dirty AS TIMESTAMP), '%Y-%m-%d') AS parsed FROM registrations", "registrations"
))
def _(spark, sf):
    rows = registrations(spark, sf).select(K.KEY, F.col("registration_date_dirty").alias("text"), F.col("registration_date_dirty").alias("parsed"))
    return schema.parse_date_column(rows, "parsed")


_protected = B.quoted([*K.CLEAN_REQUIRED, K.TARGET])


@query("constant_columns", sql(B.per_column(
    B.ALL_COLUMNS,
    "SELECT {v} AS variable, count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) <= 1 AS constant, "
    f"{{v}} IN ({_protected}) AS protected FROM registrations",
), "registrations"))
def _(spark, sf):
    return schema.constant_report(registrations(spark, sf), [*K.CLEAN_REQUIRED, K.TARGET])


_feature_columns = ["vehicle_record_id", *[c for c in B.ALL_COLUMNS if c in K.FEATURE_OUTPUT], *K.TEMPORAL_FEATURES]


@query("select_features", sql(f"SELECT {_out(_feature_columns)} FROM features", "features"))
def _(spark, sf):
    return feature_rows(spark, sf)


@query("split_xy", sql(
    f"SELECT 'x' AS side, count(*) AS row_count, {n('sum(vehicle_record_id)')} AS key_sum, CAST({len(_feature_columns) - 3} AS BIGINT) AS columns FROM features "
    f"UNION ALL SELECT 'y', count(*), {n('sum(vehicle_record_id)')}, CAST(1 AS BIGINT) FROM features WHERE co2_wltp_g_km IS NOT NULL", "features"
))
def _(spark, sf):
    x, y = schema.split_xy(feature_rows(spark, sf), K.TARGET, K.MODEL_EXCLUDED, K.KEY)

    def side(label, df):
        return df.agg(F.count("*").alias("row_count"), F.sum(K.KEY).alias("key_sum")).select(
            F.lit(label).alias("side"), "*", F.lit(len(df.columns) - 1).alias("columns")
        )

    return side("x", x).unionByName(side("y", y.dropna()))


@query("column_kinds", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, count({q(c)}) AS non_null, '{'categorical' if t == 'string' else 'numeric'}' AS kind FROM registrations"
    for c, t in DTYPES.items()
), "registrations"))
def _(spark, sf):
    return schema.column_kinds(registrations(spark, sf))


REASONS = {
    "target": "what the models predict", "identifier": "names a row, explains nothing", "constant": "one value only, so far",
    "high_cardinality": "too many values to encode as it is", "other": "may explain the target",
}


def _registry_entry(kind: str) -> tuple[str, str, str]:
    return (*K.ROLES[kind], REASONS[kind])


def _registry_sql() -> str:
    lines = []
    for c in B.ALL_COLUMNS:
        one_value = f"count(DISTINCT {q(c)}) + max(CASE WHEN {q(c)} IS NULL THEN 1 ELSE 0 END) <= 1"
        if c == K.TARGET or c == K.KEY:
            entry = [f"'{x}'" for x in _registry_entry("target" if c == K.TARGET else "identifier")]
        else:
            plain = _registry_entry("high_cardinality" if c in K.HIGH_CARDINALITY_COLUMNS else "other")
            entry = [f"CASE WHEN {one_value} THEN '{x}' ELSE '{y}' END" for x, y in zip(_registry_entry("constant"), plain)]
        lines.append(
            f"SELECT '{c}' AS variable, count(*) - count({q(c)}) AS missing, {entry[0]} AS role, {entry[1]} AS decision, "
            f"{entry[2]} AS rationale, '{DTYPES[c]}' AS dtype FROM registrations"
        )
    return " UNION ALL ".join(lines)


@query("variable_registry", sql(_registry_sql(), "registrations"))
def _(spark, sf):
    v = F.col("variable")
    conditions = {
        "target": v == K.TARGET, "identifier": v == K.KEY, "constant": F.col("constant"), "high_cardinality": v.isin(K.HIGH_CARDINALITY_COLUMNS),
    }
    rules = [(condition, *_registry_entry(kind)) for kind, condition in conditions.items()]
    return schema.variable_registry(registrations(spark, sf), rules, _registry_entry("other"))


# ---- filters ----

@query("drop_missing_target", sql(f"SELECT vehicle_record_id, {r('co2_wltp_g_km')} AS co2_wltp_g_km FROM labelled", "labelled"))
def _(spark, sf):
    return registrations(spark, sf).dropna(subset=[K.TARGET]).select(K.KEY, K.TARGET)


@query("numeric_text_rows", sql(
    f"SELECT vehicle_record_id, manufacturer_make FROM registrations WHERE {B.digits('manufacturer_make')}", "registrations"
))
def _(spark, sf):
    return numeric_text_rows(registrations(spark, sf), K.MAKE).select(K.KEY, K.MAKE)


# ---- scalar functions ----

_texts = ["manufacturer_name_eu", "manufacturer_make", "vehicle_category_type", "fuel_type", "fuel_mode"]


@query("normalize_text", sql(
    "SELECT vehicle_record_id, " + ", ".join(f"{B.strip(c)} AS {c}" for c in _texts) + " FROM registrations", "registrations"
))
def _(spark, sf):
    return makes.normalize_text(registrations(spark, sf).select(K.KEY, *_texts))


@query("normalize_codes", sql(
    "SELECT vehicle_record_id, " + ", ".join(f"{'upper' if c in K.UPPER_CODES else ''}({B.strip(c)}) AS {c}" for c in _texts)
    + " FROM registrations", "registrations"
))
def _(spark, sf):
    return makes.normalize_text(registrations(spark, sf).select(K.KEY, *_texts), K.UPPER_CODES)


@query("comparison_key", sql(
    f"SELECT vehicle_record_id, {B.spelling_key('manufacturer_make')} AS comparison_key FROM registrations", "registrations"
))
def _(spark, sf):
    return registrations(spark, sf).select(K.KEY, comparison_key(name(K.MAKE)).alias("comparison_key"))


@query("apply_aliases", sql(
    "SELECT vehicle_record_id, CASE WHEN upper(trim(manufacturer_make)) = 'VOLKSWAGEN VW' THEN 'VOLKSWAGEN' ELSE manufacturer_make END "
    "AS manufacturer_make FROM (SELECT vehicle_record_id, replace(manufacturer_make, '-', ' ') AS manufacturer_make FROM registrations) z",
    "registrations",
))
def _(spark, sf):
    rows = registrations(spark, sf).select(K.KEY, F.regexp_replace(K.MAKE, "-", " ").alias(K.MAKE))
    return makes.apply_aliases(rows, K.MAKE, K.MAKE_ALIASES)


@query("alias_report", sql(
    "SELECT 'VOLKSWAGEN VW' AS alias, 'VOLKSWAGEN' AS brand, count(*) FILTER (WHERE upper(trim(replace(manufacturer_make, '-', ' '))) = 'VOLKSWAGEN VW') "
    "AS replaced FROM registrations", "registrations",
))
def _(spark, sf):
    rows = registrations(spark, sf).select(K.KEY, F.regexp_replace(K.MAKE, "-", " ").alias(K.MAKE))
    return makes.alias_counts(rows, K.MAKE, K.MAKE_ALIASES)


@query("temporal_features", sql(
    "SELECT vehicle_record_id, " + ", ".join(f"{r(c)} AS {c}" for c in K.TEMPORAL_FEATURES) + " FROM features", "features"
))
def _(spark, sf):
    rows = normalized(spark, sf).where(name(K.TARGET).isNotNull()).select(K.KEY, K.DATE)
    return features.temporal_features(rows, K.DATE).select(K.KEY, *K.TEMPORAL_FEATURES)


@query("presence_indicators", sql(
    "SELECT vehicle_record_id, " + ", ".join(f"{n(f'CASE WHEN {c} IS NULL THEN 0 ELSE 1 END')} AS {f}" for c, f in K.INDICATORS.items())
    + " FROM registrations", "registrations",
))
def _(spark, sf):
    return registrations(spark, sf).select(K.KEY, *[present(name(c)).alias(f) for c, f in K.INDICATORS.items()])


@query("emission_class", sql(
    f"SELECT vehicle_record_id, {B.emission_class('co2_wltp_g_km')} AS co2_emission_class FROM registrations", "registrations"
))
def _(spark, sf):
    label = right_closed_class(name(K.TARGET), K.CLASS_BOUNDS, K.CLASS_LABELS)
    return registrations(spark, sf).select(K.KEY, label.alias(K.CLASS))


def _bounds_sql() -> str:
    rows = ", ".join(
        f"('{c}', '{lo}', '{hi}')" for c, lo, hi in zip(K.CLASS_LABELS, K.CLASS_BOUNDS_TEXT, K.CLASS_BOUNDS_TEXT[1:])
    )
    return (
        "SELECT b.label, CAST(b.lo AS DOUBLE) = CAST('-inf' AS DOUBLE) AS open_below, CAST(b.hi AS DOUBLE) = CAST('inf' AS DOUBLE) AS open_above, "
        f"{r('CASE WHEN b.hi = ' + chr(39) + 'inf' + chr(39) + ' THEN NULL ELSE CAST(b.hi AS DOUBLE) END')} AS upper_bound, "
        f"count(x.co2_wltp_g_km) AS n FROM (VALUES {rows}) b(label, lo, hi) LEFT JOIN labelled x "
        "ON x.co2_wltp_g_km > CAST(b.lo AS DOUBLE) AND x.co2_wltp_g_km <= CAST(b.hi AS DOUBLE) GROUP BY b.label, b.lo, b.hi"
    )


@query("class_bounds", sql(_bounds_sql(), "labelled"))
def _(spark, sf):
    y = name(K.TARGET)
    ends = list(zip(K.CLASS_LABELS, K.CLASS_BOUNDS_TEXT, K.CLASS_BOUNDS_TEXT[1:]))
    counted = labelled(spark, sf).agg(*[
        F.count_if((y > parse_bound(F.lit(lo))) & (y <= parse_bound(F.lit(hi)))).alias(f"n{i}") for i, (_, lo, hi) in enumerate(ends)
    ])
    upper = lambda hi: F.nullif(parse_bound(F.lit(hi)), F.lit(float("inf")))
    return counted.select(F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("label"), (parse_bound(F.lit(lo)) == float("-inf")).alias("open_below"),
            (parse_bound(F.lit(hi)) == float("inf")).alias("open_above"), upper(hi).alias("upper_bound"), F.col(f"n{i}").alias("n"),
        ) for i, (c, lo, hi) in enumerate(ends)
    ])))


# ---- makes ----

@query("canonical_variants", sql(
    f"SELECT comparison_key, canonical, {n('observations')} AS observations, variants FROM canon", "canon"
))
def _(spark, sf):
    return makes.canonical_variants(makes.spelling_counts(_make_counts(spark, sf)))


def _make_counts(spark, sf):
    return makes.make_counts(normalized(spark, sf), K.MAKE, K.MAKER_EU, K.MAKER_OEM)


def _pair_share(counts, spellings):
    return makes.pair_share(counts, spellings, K.MAKE, K.MAKER_EU, K.MAKER_OEM)


_pair_names = "eu AS manufacturer_name_eu, oem AS manufacturer_name_oem, make AS manufacturer_make"


@query("pair_share", sql(
    f"SELECT {_pair_names}, observations, {n('pair_observations')} AS pair_observations, {r('share')} AS share FROM pair_shares", "pair_shares"
))
def _(spark, sf):
    counts = _make_counts(spark, sf)
    return _pair_share(counts, makes.canonical_spellings(counts))


@query("reliable_pairs", sql(f"SELECT {_pair_names}, observations, {r('share')} AS share FROM pairs", "pairs"))
def _(spark, sf):
    counts = _make_counts(spark, sf)
    shares = _pair_share(counts, makes.canonical_spellings(counts))
    return makes.reliable_pairs(shares, K.MAKE, K.MAKER_EU, K.MAKER_OEM, K.MIN_PAIR_SHARE)


@query("resolve_numeric_make", sql(
    "SELECT vehicle_record_id, CASE WHEN is_num THEN 'numeric' ELSE 'text' END AS kind, manufacturer_make FROM resolved", "resolved"
))
def _(spark, sf):
    counts = _make_counts(spark, sf)
    spellings = makes.canonical_spellings(counts)
    pairs = stage(makes.reliable_pairs(_pair_share(counts, spellings), K.MAKE, K.MAKER_EU, K.MAKER_OEM, K.MIN_PAIR_SHARE))
    rows = makes.with_canonical(normalized(spark, sf), K.MAKE, spellings)
    kind = F.when(makes.is_digits(name(K.MAKE)), "numeric").otherwise("text")
    out = makes.resolve_numeric_make(rows.withColumn("kind", kind), K.MAKE, K.MAKER_EU, K.MAKER_OEM, pairs)
    return out.select(K.KEY, "kind", K.MAKE)


@query("normalize_make", sql("SELECT vehicle_record_id, manufacturer_make FROM resolved", "resolved"))
def _(spark, sf):
    rows, _report = makes.normalize_make(normalized(spark, sf), K.MAKE, K.MAKER_EU, K.MAKER_OEM, K.MIN_PAIR_SHARE)
    return rows.select(K.KEY, K.MAKE)


@query("normalize_make_report", sql(
    "SELECT count(*) FILTER (WHERE is_num) AS numeric_before, count(manufacturer_make) FILTER (WHERE is_num) AS numeric_resolved, "
    "count(*) FILTER (WHERE is_num AND manufacturer_make IS NULL) AS numeric_unresolved, (SELECT count(*) FROM canon) AS typographic_keys, "
    f"(SELECT count(*) FROM pairs) AS reliable_manufacturer_pairs, {r(str(K.MIN_PAIR_SHARE))} AS resolution_threshold FROM resolved",
    "canon", "pairs", "resolved",
))
def _(spark, sf):
    return makes.normalize_make(normalized(spark, sf), K.MAKE, K.MAKER_EU, K.MAKER_OEM, K.MIN_PAIR_SHARE)[1]


# ---- whole cleaning and features ----

@query("cleaned", sql(
    "SELECT " + ", ".join(
        f"strftime({c}, '%Y-%m-%d') AS {c}" if c == K.DATE else f"{r(c)} AS {c}" if c in B.DOUBLES else c for c in B.CLEANED_COLUMNS
    ) + " FROM cleaned", "cleaned",
))
def _(spark, sf):
    return cleaned_rows(spark, sf)


@query("features", sql(
    f"SELECT {_out([c for c in _feature_columns if c != K.MAKE and c not in K.TEMPORAL_FEATURES], {})}, c.manufacturer_make, "
    + ", ".join(f"{r('f.' + c)} AS {c}" for c in K.TEMPORAL_FEATURES)
    + " FROM features f JOIN (SELECT vehicle_record_id AS k, manufacturer_make FROM cleaned) c ON c.k = f.vehicle_record_id",
    "features", "cleaned",
))
def _(spark, sf):
    return features.build(stage(cleaned_rows(spark, sf)))


@query("split_disjoint", sql(
    "SELECT count(*) AS keys, CAST(sum(CASE WHEN p > 1 THEN 1 ELSE 0 END) AS BIGINT) AS shared FROM "
    "(SELECT vehicle_record_id, count(DISTINCT part) AS p FROM split GROUP BY 1) z", "split",
))
def _(spark, sf):
    return parts_overlap(split_rows(spark, sf), K.KEY, K.PART)


# ---- checks of the cleaned and the feature table ----

def _cleaned_checks_sql() -> str:
    def stage_sql(label: str, source: str) -> str:
        numeric = f"count(*) FILTER (WHERE {B.digits('manufacturer_make')}) = 0"
        checks = {
            "required_columns": "true", "key_complete": "count(vehicle_record_id) = count(*)",
            "target_complete": "count(co2_wltp_g_km) = count(*)", "date_is_timestamp": "true", "no_numeric_make": numeric,
            "upper_case:vehicle_category_type": "count(*) FILTER (WHERE vehicle_category_type <> upper(vehicle_category_type)) = 0",
            "upper_case:fuel_mode": "count(*) FILTER (WHERE fuel_mode <> upper(fuel_mode)) = 0",
            "key_unique": "count(DISTINCT vehicle_record_id) = count(*)",
            "no_duplicate_rows": f"count(*) = (SELECT count(*) FROM (SELECT DISTINCT * FROM {source}) d)",
        }
        return " UNION ALL ".join(f"SELECT '{label}' AS stage, '{k}' AS \"check\", {v} AND count(*) > 0 AS ok FROM {source}" for k, v in checks.items())

    return stage_sql("normalized", "norm") + " UNION ALL " + stage_sql("cleaned", "cleaned")


@query("quality_checks_cleaned", sql(_cleaned_checks_sql(), "norm", "cleaned"))
def _(spark, sf):
    before = cleaning.checks(normalized(spark, sf)).select(F.lit("normalized").alias("stage"), "*")
    after = cleaning.checks(stage(cleaned_rows(spark, sf))).select(F.lit("cleaned").alias("stage"), "*")
    return before.unionByName(after)


_feature_checks = {
    "target_present": "true", "unique_names": "true", "excluded_absent": "true", "present:registration_month_sin": "true",
    "present:registration_month_cos": "true",
    "temporal_complete": "count(*) FILTER (WHERE registration_month_sin IS NULL OR registration_month_cos IS NULL) = 0",
    "contract_columns": "true", "column_count": "true",
}


@query("quality_checks_features", sql(
    " UNION ALL ".join(f"SELECT '{k}' AS \"check\", {v} AND count(*) > 0 AS ok FROM features" for k, v in _feature_checks.items()), "features"
))
def _(spark, sf):
    return features.checks(feature_rows(spark, sf))


@query("quality_checks_input", sql(
    "SELECT 'required_columns' AS \"check\", true AS ok UNION ALL SELECT 'unique_names', true UNION ALL SELECT 'numeric_types', true "
    "UNION ALL SELECT 'target_complete', count(*) = count(co2_wltp_g_km) FROM features "
    "UNION ALL SELECT 'target_finite', count(*) FILTER (WHERE isinf(co2_wltp_g_km)) = 0 FROM features", "features",
))
def _(spark, sf):
    from fleetprep.plans.preprocessing import input_checks

    return input_checks(feature_rows(spark, sf))


@query("leakage_check", sql(
    "SELECT 'forbidden:co2_wltp_g_km' AS \"check\", true AS ok UNION ALL SELECT 'forbidden:manufacturer_make', true "
    + "".join(f"UNION ALL SELECT 'keyword:{k}', true " for k in K.TARGET_KEYWORDS)
    + "UNION ALL SELECT 'same_columns', true UNION ALL SELECT 'parts_disjoint', "
    "count(*) = count(DISTINCT vehicle_record_id) AND count(DISTINCT part) = 2 FROM split", "split",
))
def _(spark, sf):
    from fleetprep.operators.metrics import leakage_checks

    split = split_rows(spark, sf)
    x = schema.split_xy(split.drop(K.PART), K.TARGET, K.MODEL_EXCLUDED, K.KEY)[0].drop(K.KEY).columns
    names = leakage_checks({"train": x, "test": x}, [K.TARGET, K.MAKE], K.TARGET_KEYWORDS)
    both = parts_overlap(split, K.KEY, K.PART).select(F.lit("parts_disjoint").alias("check"), (F.col("shared") == 0).alias("ok"))
    return rows_of(split, names).unionByName(both)
