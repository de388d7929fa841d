"""Input tables of the queries, derived from the given tables by the same SQL text in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetprep import contracts as K
from fleetprep.cluster import stage
from fleetprep.functions.text import name
from fleetprep.functions.values import month_angle, right_closed_class
from fleetprep.operators.makes import normalize_text
from fleetprep.operators.schema import parse_date_column, select_contract
from fleetprep.operators.split import train_test_split
from fleetprep.plans.cleaning import clean

TABLES = ["orders", "customer", "nation", "part"]

REGISTRATIONS = """
SELECT
  o.o_orderkey AS vehicle_record_id,
  n.n_name AS country,
  'VFN-' || CAST(p.p_partkey AS STRING) AS vehicle_family_id,
  CASE WHEN o.o_orderkey % 11 = 0 THEN CAST(NULL AS STRING) ELSE c.c_mktsegment END AS manufacturer_pool,
  CASE WHEN o.o_orderkey % 89 = 0 THEN CAST(NULL AS STRING)
       WHEN o.o_orderkey % 3 = 0 THEN ' eu ' || lower(p.p_brand) ELSE 'EU ' || p.p_brand END AS manufacturer_name_eu,
  'OEM ' || p.p_brand AS manufacturer_name_oem,
  'TAN*' || CAST(p.p_size AS STRING) || '/' || CAST(c.c_nationkey AS STRING) AS type_approval_number,
  p.p_type AS vehicle_type,
  p.p_type || '-' || CAST(p.p_size AS STRING) AS vehicle_variant,
  p.p_type || '-' || CAST(p.p_size AS STRING) || '-' || CAST(p.p_partkey % 7 AS STRING) AS vehicle_version,
  CASE WHEN o.o_orderkey % 97 = 0 THEN CAST(1000 + o.o_orderkey % 9 AS STRING)
       WHEN o.o_orderkey % 113 = 0 THEN CAST(NULL AS STRING)
       WHEN p.p_brand = 'Brand#1' AND o.o_orderkey % 2 = 0 THEN ' Volkswagen-VW'
       WHEN p.p_brand = 'Brand#1' THEN 'VOLKSWAGEN'
       WHEN o.o_orderkey % 5 = 1 THEN upper(replace(p.p_brand, '#', ' '))
       WHEN o.o_orderkey % 5 = 2 THEN lower(replace(p.p_brand, '#', '-'))
       WHEN o.o_orderkey % 5 = 3 THEN '  ' || replace(p.p_brand, '#', ' _ ') || ' '
       ELSE replace(p.p_brand, '#', ' ') END AS manufacturer_make,
  p.p_name AS commercial_name,
  CASE WHEN o.o_orderkey % 53 = 0 THEN CAST(NULL AS STRING)
       WHEN p.p_size % 5 = 0 THEN 'm1' WHEN p.p_size % 5 = 1 THEN 'N1'
       WHEN p.p_size % 5 = 2 THEN ' M1G' ELSE 'M1' END AS vehicle_category_type,
  'M1' AS vehicle_category,
  CAST(1 AS BIGINT) AS new_registrations,
  CASE WHEN o.o_orderkey % 211 = 0 THEN CAST(NULL AS DOUBLE) ELSE 900 + p.p_size * 25.0 END AS mass_running_order_kg,
  CASE WHEN o.o_orderkey % 199 = 0 THEN CAST(NULL AS DOUBLE) ELSE 950 + p.p_size * 26.0 END AS wltp_test_mass_kg,
  CASE WHEN o.o_orderkey % 61 = 0 THEN CAST(NULL AS DOUBLE)
       WHEN o.o_orderkey % 20 IN (12, 13, 14, 18) THEN CAST(0 AS DOUBLE)
       ELSE CAST(60 + p.p_size * 4 + o.o_orderkey % 20 AS DOUBLE) END AS co2_wltp_g_km,
  CASE WHEN o.o_orderkey % 71 = 0 THEN CAST(NULL AS STRING)
       WHEN o.o_orderkey % 20 <= 6 THEN 'petrol' WHEN o.o_orderkey % 20 <= 9 THEN ' diesel'
       WHEN o.o_orderkey % 20 = 10 THEN 'lpg' WHEN o.o_orderkey % 20 = 11 THEN 'e85'
       WHEN o.o_orderkey % 20 <= 14 THEN 'electric' WHEN o.o_orderkey % 20 <= 16 THEN 'petrol/electric'
       WHEN o.o_orderkey % 20 = 17 THEN 'diesel/electric' WHEN o.o_orderkey % 20 = 18 THEN 'hydrogen'
       WHEN o.o_orderkey % 3 = 0 THEN 'ng' ELSE 'unknown' END AS fuel_type,
  CASE WHEN o.o_orderkey % 20 <= 9 THEN 'M' WHEN o.o_orderkey % 20 = 10 THEN 'b'
       WHEN o.o_orderkey % 20 = 11 THEN 'F' WHEN o.o_orderkey % 20 <= 14 THEN 'e'
       WHEN o.o_orderkey % 20 <= 17 THEN 'P' ELSE 'H' END AS fuel_mode,
  CASE WHEN o.o_orderkey % 20 IN (12, 13, 14, 18) OR o.o_orderkey % 83 = 0 THEN CAST(NULL AS DOUBLE)
       ELSE CAST(1000 + p.p_size * 40 AS DOUBLE) END AS engine_capacity_cm3,
  CASE WHEN o.o_orderkey % 197 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(40 + p.p_size * 3 AS DOUBLE) END AS engine_power_kw,
  CASE WHEN o.o_orderkey % 20 BETWEEN 12 AND 17 AND o.o_orderkey % 37 <> 0
       THEN CAST(120 + p.p_size AS DOUBLE) ELSE CAST(NULL AS DOUBLE) END AS electric_energy_consumption_wh_km,
  CASE WHEN o.o_orderkey % 13 = 0 THEN 'e' || CAST(p.p_size % 6 AS STRING) || ' 37' ELSE CAST(NULL AS STRING) END AS innovative_technology,
  CASE WHEN o.o_orderkey % 5 < 2 AND o.o_orderkey % 20 <= 9 THEN (p.p_size % 10) / 8.0 ELSE CAST(NULL AS DOUBLE) END AS co2_reduction_wltp_g_km,
  'P' AS status,
  CAST(2024 AS BIGINT) AS registration_year,
  CAST(CAST(o.o_orderdate AS DATE) AS STRING) AS registration_date,
  CASE WHEN o.o_orderkey % 307 = 0 THEN 'not-a-date' ELSE CAST(CAST(o.o_orderdate AS DATE) AS STRING) END AS registration_date_dirty,
  CASE WHEN o.o_orderkey % 20 IN (12, 13, 14, 18, 19) OR o.o_orderkey % 79 = 0 THEN CAST(NULL AS DOUBLE)
       ELSE (30 + p.p_size * 2) / 8.0 END AS fuel_consumption,
  CASE WHEN o.o_orderkey % 4 = 0 THEN 'EURO 6' ELSE '36AP' END AS emission_standard,
  'RL-' || CAST(p.p_partkey AS STRING) || '*' || CAST(p.p_size AS STRING) AS rlfi,
  CASE WHEN o.o_orderkey % 20 BETWEEN 12 AND 17 AND o.o_orderkey % 41 <> 0
       THEN CAST(40 + p.p_size * 7 AS DOUBLE) ELSE CAST(NULL AS DOUBLE) END AS electric_range_km,
  CAST(NULL AS STRING) AS mms
FROM {orders} o
JOIN {customer} c ON c.c_custkey = o.o_custkey
JOIN {nation} n ON n.n_nationkey = c.c_nationkey
JOIN {part} p ON p.p_partkey = o.o_orderkey % (SELECT count(*) FROM {part})
"""

# three stand-in models: name, divisor of the planted error, training seconds
MODELS = [("boosting", 3.0, 2.0), ("forest", 4.0, 3.0), ("ridge", 1.0, 1.0)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, in the shape of the vehicle registration table."""
    return spark.sql(REGISTRATIONS, **{t: table(spark, sf_dir, t) for t in TABLES})


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registrations without the second, dirty date column."""
    return registrations(spark, sf_dir).drop("registration_date_dirty")


def cleaned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned table, from a stored source as in the cleaning job."""
    return clean(stage(source_rows(spark, sf_dir))).rows


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stripped text, upper-case codes, parsed dates."""
    rows = parse_date_column(source_rows(spark, sf_dir), K.DATE)
    return normalize_text(rows, K.UPPER_CODES)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registrations that have a target."""
    return registrations(spark, sf_dir).where(name(K.TARGET).isNotNull())


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key, the model features and the target; the make is left as it is, since no model uses it."""
    rows = normalized(spark, sf_dir).where(name(K.TARGET).isNotNull())
    angle = month_angle(name(K.DATE))
    rows = rows.withColumns({"registration_month_sin": F.sin(angle), "registration_month_cos": F.cos(angle)})
    return select_contract(rows, K.FEATURE_EXCLUDED, K.FEATURE_OUTPUT, [K.KEY])


def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature rows, stored as the feature job stores them, with their part."""
    return train_test_split(stage(feature_rows(spark, sf_dir)), K.KEY, K.TEST_SHARE, K.SEED, K.PART)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True and predicted value and class with a planted error, no model needed."""
    y = name(K.TARGET)
    p = y + (name(K.KEY) % 15 - 7) / F.lit(4.0)
    return labelled(spark, sf_dir).select(
        name(K.KEY), y.alias("y_true"), p.alias("y_pred"),
        right_closed_class(y, K.CLASS_BOUNDS, K.CLASS_LABELS).alias("class_true"),
        right_closed_class(p, K.CLASS_BOUNDS, K.CLASS_LABELS).alias("class_pred"),
    )


def model_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As predictions, for three stand-in models on train and validation rows; the error is smaller on train."""
    split = train_test_split(
        labelled(spark, sf_dir).select(name(K.KEY), name(K.TARGET).alias("y_true")), K.KEY, K.TEST_SHARE, K.SEED, K.PART
    )
    part = F.when(name(K.PART) == "test", "validation").otherwise("train")
    rows = split.withColumn(K.PART, part).select("*", F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), F.lit(d).alias("divisor"), F.lit(s).alias("training_seconds")) for m, d, s in MODELS
    ])))
    shrink = F.when(name(K.PART) == "train", F.lit(1.25)).otherwise(F.lit(1.0))
    rows = rows.withColumn("y_pred", F.col("y_true") + (name(K.KEY) % 15 - 7) / (F.col("divisor") * shrink))
    return rows.withColumns({
        "class_true": right_closed_class(F.col("y_true"), K.CLASS_BOUNDS, K.CLASS_LABELS),
        "class_pred": right_closed_class(F.col("y_pred"), K.CLASS_BOUNDS, K.CLASS_LABELS),
    })
