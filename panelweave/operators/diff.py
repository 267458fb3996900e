"""Compare releases of a keyed panel.

Two releases are stacked with a side marker and aggregated by the identity key
instead of being joined: one shuffle, combined on the map side, with NULL keys
equal to each other, and with the row count per side at hand so the uniqueness
of the key is checked in the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from panelweave.operators.reshape import count_by_status, union_all
from panelweave.schema import nan_to_null

STATUSES = ["added", "removed", "changed", "unchanged"]
DEFAULT_TOLERANCE = 1e-6


def _value(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    return nan_to_null(name) if isinstance(dtype, (T.DoubleType, T.FloatType)) else F.col(name)


def _keep_checked(df: DataFrame, n_old: str, n_new: str, message: Column | str) -> DataFrame:
    """Fail the running job when a key occurs more than once on either side."""
    message = F.lit(message) if isinstance(message, str) else message
    unique = (F.col(n_old) <= 1) & (F.col(n_new) <= 1)
    return df.filter(F.when(unique, True).otherwise(F.raise_error(message).cast("boolean")))


def align_snapshots(
    old: DataFrame, new: DataFrame, key_cols: Sequence[str], value_col: str
) -> DataFrame:
    """Full outer alignment of two releases: rows and value per key and side.

    When both sides already lie partitioned by the key, because they were
    de-duplicated by it or come from tables bucketed by it, Spark keeps that
    through the union and shuffles nothing here. For tables it only recognises
    the partitioning if the key columns have lost their table name, hence the
    aliases.
    """
    is_new, value = "__is_new", "__value"
    stacked = union_all(
        [
            df.select(
                *[F.col(key).alias(key) for key in key_cols],
                _value(df, value_col).alias(value),
                F.lit(flag).alias(is_new),
            )
            for df, flag in ((old, False), (new, True))
        ]
    )
    return stacked.groupBy(*key_cols).agg(
        F.count_if(~F.col(is_new)).alias("n_old"),
        F.count_if(F.col(is_new)).alias("n_new"),
        F.max(F.when(~F.col(is_new), F.col(value))).alias("value_old"),
        F.max(F.when(F.col(is_new), F.col(value))).alias("value_new"),
    )


def diff_status(
    n_old: Column, n_new: Column, old: Column, new: Column, tol: float = DEFAULT_TOLERANCE
) -> Column:
    """Status of one data point; the branches are ordered by precedence.

    Infinite values of equal sign have no numeric distance and count as equal.
    """
    distance = F.abs(new.cast("double") - old.cast("double"))
    return (
        F.when(n_old == 0, "added")
        .when(n_new == 0, "removed")
        .when(old.isNull() != new.isNull(), "changed")
        .when(~F.isnan(distance) & (distance > tol), "changed")
        .otherwise("unchanged")
    )


def diff_snapshots(
    old: DataFrame,
    new: DataFrame,
    key_cols: Sequence[str],
    value_col: str,
    tol: float = DEFAULT_TOLERANCE,
    labels: tuple[str, str] = ("old", "new"),
) -> DataFrame:
    """Classify every data point of two releases.

    Returns the key, ``value_old``, ``value_new`` and ``status``. A key that is
    not unique within one of the releases fails the job.
    """
    aligned = align_snapshots(old, new, key_cols, value_col)
    checked = _keep_checked(
        aligned,
        "n_old",
        "n_new",
        F.concat(
            F.lit("a key occurs more than once in snapshot "),
            F.when(F.col("n_old") > 1, labels[0]).otherwise(labels[1]),
        ),
    )
    status = diff_status(
        F.col("n_old"), F.col("n_new"), F.col("value_old"), F.col("value_new"), tol
    )
    return checked.select(*key_cols, "value_old", "value_new", status.alias("status"))


def diff_pairs(
    snapshots: DataFrame,
    pairs: Sequence[tuple[str, str]],
    key_cols: Sequence[str],
    value_col: str,
    release_col: str = "release_id",
    tol: float = DEFAULT_TOLERANCE,
    clustered: bool = False,
) -> DataFrame:
    """Compare several pairs of releases of one long table in a single job.

    The rows are shuffled once by identity key whatever the number of pairs.
    Rows are counted per key and release first, so what is then gathered per key
    is at most one entry per release, also where a key is not unique; the pairs
    are formed from that. A pair given twice is compared once. ``clustered``
    says that the rows already lie partitioned by the key, as in a table of
    ``save_releases``: they are not shuffled then.
    """
    if any(old == new for old, new in pairs):
        raise ValueError("a release cannot be compared with itself")
    pairs = list(dict.fromkeys(tuple(pair) for pair in pairs))
    aligned = _align_pairs(snapshots, pairs, key_cols, value_col, release_col, clustered)
    checked = _keep_checked(
        aligned,
        "n_old",
        "n_new",
        F.concat(F.lit("a key occurs more than once in a snapshot of "), F.col("pair")),
    )
    status = diff_status(
        F.col("n_old"), F.col("n_new"), F.col("value_old"), F.col("value_new"), tol
    )
    return checked.select("pair", *key_cols, "value_old", "value_new", status.alias("status"))


def _pair_name(pair: tuple[str, str]) -> str:
    return "_vs_".join(pair)


def _align_pairs(snapshots, pairs, key_cols, value_col, release_col, clustered) -> DataFrame:
    releases = list(dict.fromkeys(release for pair in pairs for release in pair))
    rows = snapshots.filter(F.col(release_col).isin(releases)).select(
        *[F.col(key).alias(key) for key in key_cols],
        F.col(release_col).alias("__release"),
        _value(snapshots, value_col).alias("__value"),
    )
    if not clustered:
        rows = rows.repartition(*key_cols)
    per_release = rows.groupBy(*key_cols, "__release").agg(
        F.count("*").alias("__n"), F.max("__value").alias("__value")
    )
    entry = F.struct("__release", F.struct("__n", "__value"))
    per_key = per_release.groupBy(*key_cols).agg(
        F.map_from_entries(F.collect_list(entry)).alias("__found")
    )
    wanted = F.array(
        *[
            F.struct(
                F.lit(_pair_name(pair)).alias("pair"),
                F.lit(pair[0]).alias("old"),
                F.lit(pair[1]).alias("new"),
            )
            for pair in pairs
        ]
    )

    def sides(pair: Column) -> Column:
        old, new = (F.try_element_at("__found", pair[side]) for side in ("old", "new"))
        return F.struct(
            pair["pair"].alias("pair"),
            F.coalesce(old["__n"], F.lit(0)).alias("n_old"),
            F.coalesce(new["__n"], F.lit(0)).alias("n_new"),
            old["__value"].alias("value_old"),
            new["__value"].alias("value_new"),
        )

    present = F.filter(
        F.transform(wanted, sides), lambda side: (side["n_old"] > 0) | (side["n_new"] > 0)
    )
    return per_key.select(*key_cols, F.inline(present))


def summarise_diff_by(diff: DataFrame, by: Sequence[str]) -> DataFrame:
    """Data points per status within groups, sorted with missing groups last."""
    counts = count_by_status(diff, by, "status", STATUSES)
    return counts.orderBy(*[F.col(c).asc_nulls_last() for c in by])


def diff_detail(diff: DataFrame, order: Sequence[str]) -> DataFrame:
    """The data points that differ, sorted."""
    return diff.filter(F.col("status") != "unchanged").orderBy(
        *[F.col(c).asc_nulls_last() for c in order]
    )


def status_totals(diff: DataFrame) -> DataFrame:
    """Always one row per status, zero when it does not occur."""
    counts = diff.agg(*[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])
    rows = F.array(*[F.struct(F.lit(s).alias("status"), F.col(s).alias("n")) for s in STATUSES])
    return counts.select(F.inline(rows))


def diff_headline(diff: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Size of both releases and the four status totals, in one aggregate."""
    status = F.col("status")
    return diff.groupBy(*by).agg(
        F.count_if(status != "added").alias("old_rows"),
        F.count_if(status != "removed").alias("new_rows"),
        *[F.count_if(status == s).alias("n_" + s) for s in STATUSES],
    )


def top_added_entities(diff: DataFrame, entity: str, n: int = 15) -> DataFrame:
    """Entities with the most added points; equal counts in entity order."""
    return (
        diff.filter(F.col("status") == "added")
        .groupBy(entity)
        .agg(F.count("*").alias("n_added"))
        .orderBy(F.desc("n_added"), F.col(entity).asc_nulls_last())
        .limit(n)
    )
