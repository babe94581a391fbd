"""Row numbers, order by hash, and splits, without one global sort task.

Rows fall into buckets in key order; bucket sizes (a bounded table) give each
bucket its first number, and a window numbers rows within their bucket.  Up to
``FEW`` rows are one bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one task numbers by itself.
FEW = 100_000
#: Numeric keys are cut at so many quantiles, at least and at most, with about
#: ROWS rows between two of them.
CUTS, MOST_CUTS = 64, 1024
ROWS = 1_000_000


def _numbered(df: DataFrame, bucket: Column, order: list[Column], name: str, by: list[str]) -> DataFrame:
    df = df.withColumn("_bucket", bucket)
    sizes = df.groupBy(*by, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(*by, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    joined = df.join(first if by else F.broadcast(first), [*by, "_bucket"])
    within = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(*order))
    return joined.withColumn(name, F.col("_first") + within).select(*[c for c in df.columns if c != "_bucket"], name)


def number_rows(df: DataFrame, key: str, name: str = "n", ties: list[str] | None = None) -> DataFrame:
    """``name``: 1, 2, ... by a numeric ``key``, then ``ties``.  Nulls first."""
    order = [F.col(c) for c in [key, *(ties or [])]]
    n = df.count()
    if n <= FEW:
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))
    shares = F.array(*[F.lit(i / MOST_CUTS) for i in range(1, MOST_CUTS)])
    cuts = df.select(F.percentile_approx(key, shares, 10 * MOST_CUTS)).first()[0]
    step = MOST_CUTS // min(MOST_CUTS, max(CUTS, n // ROWS))
    cuts = (cuts or [])[step - 1 :: step]
    bounds = F.array(*[F.lit(c) for c in sorted(set(cuts))]) if cuts else F.array().cast("array<double>")
    bucket = F.coalesce(F.size(F.filter(bounds, lambda b: b < F.col(key))), F.lit(-1))
    return _numbered(df, bucket, order, name, [])


def shuffle_key(id_: Column, seed: int = 42) -> Column:
    """A pseudo-random order that any engine can repeat."""
    return F.md5(F.concat(F.lit(f"{seed}:"), id_.cast("string")))


def shuffled(df: DataFrame, id_: str, seed: int = 42, name: str = "n") -> DataFrame:
    """``name``: 1, 2, ... in the order of md5(seed:id), then id."""
    df = df.withColumn("_key", shuffle_key(F.col(id_), seed))
    bucket = F.coalesce(F.conv(F.substring("_key", 1, 3), 16, 10).cast("int"), F.lit(-1))
    return _numbered(df, bucket, [F.col("_key"), F.col(id_)], name, []).drop("_key")


def sample(df: DataFrame, id_: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement (all, if fewer)."""
    return df.orderBy(shuffle_key(F.col(id_), seed), id_).limit(n)


def _labelled(df: DataFrame, id_: str, seed: int, first: str, train: Column, val: Column) -> DataFrame:
    return shuffled(df, id_, seed, "_n").withColumn("split", F.when(F.col("_n") <= train, "train").when(F.col("_n") <= train + val, "val").otherwise("test")).drop("_n")


def split_train_val_test(df: DataFrame, id_: str, train: float = 0.9, val: float = 0.05, seed: int = 42) -> DataFrame:
    """``split``: sizes of val and test are rounded half to even, at least one
    each; train has the rest, which may be nothing."""
    n = df.count()
    n_val, n_test = (max(1, int(_even(n * x))) for x in (val, 1.0 - train - val))
    n_train = n - n_val - n_test
    # as slices would: a negative size counts from the end
    first = n_train if n_train >= 0 else max(0, n + n_train)
    last = n_train + n_val
    second = (last if last >= 0 else max(0, n + last)) - first
    return _labelled(df, id_, seed, "train", F.lit(first), F.lit(max(second, 0)))


def _even(x: float) -> int:
    return round(x)


def split_two_steps(df: DataFrame, id_: str, test: float = 0.2, val: float = 0.1, seed: int = 42) -> DataFrame:
    """``test`` of all, then ``val`` of the rest; both sizes rounded up."""
    n = df.count()
    n_test = -int(-n * test // 1)
    n_val = -int(-(n - n_test) * val // 1)
    return _labelled(df, id_, seed, "train", F.lit(n - n_test - n_val), F.lit(n_val))
