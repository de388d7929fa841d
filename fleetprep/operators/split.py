"""Reproducible splits, samples and folds of exact size.

Every function turns counted positions into a comparison on the key's hash, so assigning the rows is a projection, or a join with
one small row per stratum: no sort of the table, no shuffle for its rows, and the same rows on every run and after every lost executor.

Keys should be unique and present. A missing key counts as one more key. Where copies of one key lie across the end of a part, no
size can be exact, and a ValueError says so.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import ROUND_CEILING, Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetprep.functions.hashing import HASH_MAX, HASH_MIN, hash_number, hash_text
from fleetprep.functions.text import name
from fleetprep.operators.ranks import bounds, marks_at, stratum_key

_S, _T, _ENDS = "__stratum", "__order", "__ends"


def exact_rows(n: int, share: str | float) -> int:
    """ceil(share * n) in decimal arithmetic."""
    return int((Decimal(str(share)) * n).to_integral_value(ROUND_CEILING))


def total(sizes: DataFrame) -> int:
    return sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def allocate(sizes: DataFrame, rows: int) -> DataFrame:
    """(s, n) -> (s, p): whole numbers proportional to n that sum to rows: floors, then the largest remainders, ties by name."""
    n = total(sizes)
    if not n:
        return sizes.select("s", F.col("n").alias("p"))
    exact = F.col("n").cast("decimal(19,0)") * F.lit(rows).cast("decimal(19,0)")
    parts = sizes.withColumn("whole", F.expr(f"CAST(n AS DECIMAL(19,0)) * CAST({rows} AS DECIMAL(19,0)) div {n}"))
    parts = parts.withColumn("rest", exact - F.col("whole").cast("decimal(19,0)") * F.lit(n).cast("decimal(19,0)"))
    short = rows - parts.agg(F.sum("whole")).first()[0]
    rank = F.row_number().over(Window.orderBy(F.desc("rest"), "s"))  # one row per stratum
    return parts.select("s", (F.col("whole") + (rank <= short).cast("bigint")).alias("p"))


def _hash_key(key: str) -> Column:
    return F.coalesce(name(key).cast("string"), F.lit("\0"))


def _marks(df: DataFrame, key: str, seed: int | str, positions: Callable[[DataFrame], DataFrame], stratum: str | None) -> DataFrame:
    """(s, p, t) in hash order for the positions that are not 0."""
    k = _hash_key(key)
    wanted = lambda sizes: positions(sizes).where("p > 0")
    label = None if stratum is None else name(stratum)
    return _whole(marks_at(df, hash_number(k, seed), hash_text(k, seed), HASH_MIN, HASH_MAX, wanted, label), key)


def _whole(marks: DataFrame, key: str) -> DataFrame:
    bad = marks.where("upto > p").first()
    if bad:
        raise ValueError(f"copies of one key lie across position {bad.p}: {key} must be unique for exact sizes")
    return marks


def _first(df: DataFrame, key: str, seed: int | str, take: Callable[[DataFrame], DataFrame], stratum: str | None = None) -> tuple[DataFrame, Column]:
    """df and a condition on it that holds for the first rows in hash order; take maps sizes (s, n) to rows per stratum (s, p)."""
    marks = _marks(df, key, seed, take, stratum)
    t = hash_text(_hash_key(key), seed)
    if stratum is None:
        mark = marks.first()
        return df, t <= F.lit(mark.t) if mark else F.lit(False)
    marks = marks.select(F.col("s").alias(_S), F.col("t").alias(_ENDS))
    return df.withColumn(_S, stratum_key(name(stratum))).join(marks, _S, "left"), F.coalesce(t <= F.col(_ENDS), F.lit(False))


def _with_part(df: DataFrame, rows: DataFrame, chosen: Column, part: str) -> DataFrame:
    columns = [name(c) for c in df.columns if c != part]
    return rows.select(*columns, F.when(chosen, "test").otherwise("train").alias(part))


def train_test_split(df: DataFrame, key: str, share: str | float, seed: int | str, part: str = "part") -> DataFrame:
    """Add a part column: exactly ceil(share * n) rows are 'test', the others 'train'."""
    take = lambda sizes: sizes.select("s", F.lit(exact_rows(total(sizes), share)).alias("p"))
    return _with_part(df, *_first(df, key, seed, take), part)


def sample_rows(df: DataFrame, key: str, rows: int, seed: int | str) -> DataFrame:
    """min(rows, n) rows without replacement."""
    rows_of = _first(df, key, seed, lambda sizes: sizes.select("s", F.least("n", F.lit(rows)).alias("p")))
    return rows_of[0].where(rows_of[1]).select(*[name(c) for c in df.columns])


def development_sample(
    df: DataFrame, key: str, rows: int | None, share: str | float, seed: int | str, part: str = "part"
) -> DataFrame:
    """A seeded sample of at most that many rows (None: all rows), split into 'train' and 'validation'."""
    sample = df if rows is None else sample_rows(df, key, rows, f"{seed}|sample")
    split = train_test_split(sample, key, share, f"{seed}|validation", part)
    return split.withColumn(part, F.when(name(part) == "test", "validation").otherwise("train"))


def stratified_split(
    df: DataFrame, key: str, stratum: str, share: str | float, seed: int | str, part: str = "part"
) -> DataFrame:
    """As train_test_split, with the class shares kept in both parts; rows without a class are a class of their own."""
    return _with_part(df, *_first(df, key, seed, lambda sizes: allocate(sizes, exact_rows(total(sizes), share)), stratum), part)


def stratified_sample(df: DataFrame, key: str, stratum: str, rows: int, seed: int | str) -> DataFrame:
    """min(rows, n) rows without replacement, the class shares kept."""
    rows_of = _first(df, key, seed, lambda sizes: allocate(sizes, min(rows, total(sizes))), stratum)
    return rows_of[0].where(rows_of[1]).select(*[name(c) for c in df.columns])


def _fold_ends(sizes: DataFrame, k: int) -> DataFrame:
    """(s, p): where each fold but the last one ends; the first n % k folds get one row more."""
    i = F.explode(F.sequence(F.lit(1), F.lit(k - 1))) if k > 1 else F.explode(F.array().cast("array<int>"))
    ends = sizes.select("s", "n", i.alias("i"))
    return ends.select("s", (F.expr(f"n div {k}") * F.col("i") + F.least(F.expr(f"n % {k}"), F.col("i"))).alias("p"))


def k_folds(df: DataFrame, key: str, k: int, fold: str = "fold") -> DataFrame:
    """Contiguous folds 0..k-1 in key order (a whole-number key, a missing one first), sizes differing by at most one."""
    order = F.coalesce(name(key).cast("bigint"), F.lit(-(2**63)))
    limits = bounds(df, order)
    if limits is None:
        return df.withColumn(fold, F.lit(0))
    marks = _whole(marks_at(df, order, order, *limits, lambda sizes: _fold_ends(sizes, k).where("p > 0")), key)
    ends = F.lit(sorted(m.x for m in marks.collect())).cast("array<bigint>")  # k - 1 numbers
    return df.withColumn(fold, F.size(F.filter(ends, lambda e: e < order)))


def stratified_folds(df: DataFrame, key: str, stratum: str, k: int, seed: int | str, fold: str = "fold") -> DataFrame:
    """Shuffled folds 0..k-1 that each hold an equal share of every class, sizes per class differing by at most one."""
    marks = _marks(df, key, seed, lambda sizes: _fold_ends(sizes, k), stratum)
    ends = marks.groupBy(F.col("s").alias(_S)).agg(F.collect_list("t").alias(_ENDS))  # k - 1 texts per class
    rows = df.withColumn(_S, stratum_key(name(stratum))).withColumn(_T, hash_text(_hash_key(key), seed)).join(ends, _S, "left")
    number = F.coalesce(F.size(F.filter(_ENDS, lambda e: e < F.col(_T))), F.lit(0))
    columns = [name(c) for c in df.columns if c != fold]
    return rows.select(*columns, number.alias(fold))


def split_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(shared): rows of the left set whose key is in the right set."""
    return left.select(key).join(right.select(key), key, "left_semi").agg(F.count("*").alias("shared"))


def parts_overlap(df: DataFrame, key: str, part: str) -> DataFrame:
    """(keys, shared): keys of a split table, and how many of them sit in more than one part."""
    per_key = df.groupBy(name(key)).agg((F.min(name(part)) != F.max(name(part))).alias("both"))
    return per_key.agg(F.count("*").alias("keys"), F.count_if("both").alias("shared"))
