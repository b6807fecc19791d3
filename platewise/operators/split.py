"""Train/val/test assignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.constants import SEED, TRAIN_RATIO, VAL_RATIO
from platewise.functions.hashing import seeded_digest, stable_bucket
from platewise.operators.ranking import cut_digests


def check_ratios(train: float, val: float) -> None:
    if not 0.0 < train < 1.0:
        raise ValueError("train ratio must be in (0, 1)")
    if not 0.0 <= val < 1.0:
        raise ValueError("val ratio must be in [0, 1)")
    if train + val >= 1.0:
        raise ValueError("train + val ratios must stay below 1")


def split_hash(
    df: DataFrame, id_col: str = "simulation_id", train: float = TRAIN_RATIO, val: float = VAL_RATIO, seed: int = SEED
) -> DataFrame:
    """Split by the bucket of the id: a row keeps its split whatever else is in the table. No shuffle.

    A null id has no bucket and fails the job.
    """
    check_ratios(train, val)
    if id_col not in df.columns:
        raise ValueError(f"column {id_col!r} is required to assign splits")
    key = F.coalesce(F.col(id_col).cast("string"), F.raise_error(F.lit("null id has no split")).cast("string"))
    bucket = stable_bucket(key, seed)
    label = F.when(F.col("_bucket") < train, "train").when(F.col("_bucket") < train + val, "val").otherwise("test")
    return df.withColumn("_bucket", bucket).withColumn("split", label).drop("_bucket")


def split_random(
    df: DataFrame,
    id_col: str = "simulation_id",
    train: float = TRAIN_RATIO,
    val: float = VAL_RATIO,
    seed: int = SEED,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Exact-size seeded split: rows in digest order, cut at int(n*train) and int(n*val).

    The table itself is not shuffled: only the two digests at the cuts are looked up, and each row compares
    its own digest with them. ``tie`` names columns that, with the id, identify a row; rows with equal
    digests fall on the same side of a cut.
    """
    check_ratios(train, val)
    key = F.concat_ws("|", F.col(id_col).cast("string"), *[F.col(c).cast("string") for c in tie])
    digest = seeded_digest(key, f"split|{seed}")
    total = F.col("total")
    n_train = F.floor(total * F.lit(train))
    cuts = cut_digests(df, digest, {"val": n_train, "test": n_train + F.floor(total * F.lit(val))})
    at = cuts.agg(
        F.struct(
            F.max(F.when(F.col("name") == "val", F.col("digest"))).alias("val"),
            F.max(F.when(F.col("name") == "test", F.col("digest"))).alias("test"),
        ).alias("at")
    ).scalar()
    # A missing cut lies past the end: no row reaches it.
    reached = lambda name: F.coalesce(F.col("_digest") >= at[name], F.lit(False))
    label = F.when(reached("test"), "test").when(reached("val"), "val").otherwise("train")
    return df.withColumn("_digest", digest).withColumn("split", label).drop("_digest")


def assert_split(df: DataFrame) -> dict[str, int]:
    """Raise on fewer than three rows or an empty split; return the sizes."""
    sizes = {r["split"]: r["n"] for r in df.groupBy("split").agg(F.count("*").alias("n")).collect()}
    if sum(sizes.values()) < 3:
        raise ValueError("at least 3 rows are needed to split")
    empty = [s for s in ("train", "val", "test") if not sizes.get(s)]
    if empty:
        raise ValueError(f"empty splits: {empty}")
    return sizes


def split_table(df: DataFrame, strategy: str = "hash", **options) -> DataFrame:
    if strategy == "hash":
        return split_hash(df, **options)
    if strategy == "random":
        return split_random(df, **options)
    raise ValueError("strategy must be 'hash' or 'random'")


def split_sizes(df: DataFrame) -> DataFrame:
    """Rows and share per split; the total is a scalar over the three counts."""
    sizes = df.groupBy("split").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n")).scalar()
    return sizes.withColumn("share", F.col("n") / total)


def split_overlap(df: DataFrame, id_col: str = "simulation_id") -> DataFrame:
    """Ids found in more than one split; empty when the split is sound."""
    return (
        df.groupBy(id_col)
        .agg(F.min("split").alias("first_split"), F.max("split").alias("last_split"))
        .filter(F.col("first_split") != F.col("last_split"))
    )


def split_changes(left: DataFrame, right: DataFrame, id_col: str = "simulation_id") -> DataFrame:
    """(id, split) pairs of ``left`` that ``right`` does not have."""
    pairs: list[str | Column] = [id_col, "split"]
    return left.select(*pairs).distinct().join(right.select(*pairs).distinct(), [id_col, "split"], "left_anti")


def union_splits(train: DataFrame, val: DataFrame, test: DataFrame) -> DataFrame:
    return train.unionByName(val).unionByName(test)
