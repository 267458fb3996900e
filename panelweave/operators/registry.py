"""The registry of snapshots: which file holds which release of which pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from panelweave.functions.rules import ordinal
from panelweave.functions.scalars import pair_label
from panelweave.functions.vocabulary import is_excluded
from panelweave.operators.dedup import keep_first
from panelweave.operators.joins import not_covered
from panelweave.operators.reshape import union_all

SORT_ORDER = ["pipeline", "release_id", "snapshot_date", "file"]


def manifest_upsert(
    manifest: DataFrame, rows: DataFrame, sequence: str | None = None
) -> DataFrame:
    """Add rows to the registry, replacing those registered for the same file.

    ``sequence`` orders several new rows for one file; the last one wins.
    Registry rows without a file are dropped. Applying the same rows twice
    changes nothing.
    """
    if sequence:
        rows = keep_first(rows, ["file"], [F.col(sequence).desc_nulls_last()]).drop(sequence)
    # One shuffle by file: the newest side that has the file wins. The marker
    # spares reading the new rows once for a join and once for their own sake.
    marked = union_all(
        [
            manifest.filter(F.col("file").isNotNull()).withColumn("__new", F.lit(False)),
            rows.withColumn("__new", F.lit(True)),
        ]
    )
    replaced = F.max("__new").over(Window.partitionBy("file"))
    kept = marked.withColumn("__replaced", replaced).filter(
        F.col("__new") == F.col("__replaced")
    )
    return kept.drop("__new", "__replaced").orderBy(*[F.col(c).asc_nulls_last() for c in SORT_ORDER])


def manifest_merge(registry: DataFrame, builtin: DataFrame) -> DataFrame:
    """Registry plus built-in rows for release and pipeline pairs it lacks.

    One row per file; a registry row outranks a built-in one.
    """
    fill = not_covered(builtin, registry, ["release_id", "pipeline"])
    ranked = union_all(
        [registry.withColumn("__rank", F.lit(1)), fill.withColumn("__rank", F.lit(2))]
    )
    order = [F.col("__rank")] + [F.col(c).asc_nulls_last() for c in SORT_ORDER]
    return keep_first(ranked, ["file"], order).drop("__rank")


def manifest_flags(
    manifest: DataFrame, files: DataFrame, release_order: Sequence[str]
) -> DataFrame:
    """Flag rows whose file exists and rows excluded from comparisons.

    ``release_ord`` is the position in ``release_order``; a release that is not
    listed becomes NULL, as a value outside an ordered category does.
    """
    listed = files.select("file").distinct().withColumn("__listed", F.lit(True))
    position = ordinal("release_id", release_order)
    return manifest.join(listed, "file", "left").select(
        F.when(position.isNotNull(), F.col("release_id")).alias("release_id"),
        "snapshot_date",
        "pipeline",
        "file",
        "source",
        "notes",
        F.col("__listed").isNotNull().alias("available"),
        is_excluded("notes").alias("excluded"),
        position.alias("release_ord"),
    )


def first_snapshot_per_release(flags: DataFrame) -> DataFrame:
    """Earliest usable snapshot of every release of every pipeline."""
    usable = flags.filter(F.col("available") & ~F.col("excluded"))
    return keep_first(
        usable,
        ["pipeline", "release_id"],
        [F.col("snapshot_date").asc_nulls_last(), F.col("file").asc_nulls_last()],
    )


def consecutive_pairs(first_snapshots: DataFrame) -> DataFrame:
    """Each release next to the following one that has a snapshot.

    The input has at most one row per pipeline and release, so the window only
    ever sorts as many rows as there are releases.
    """
    window = Window.partitionBy("pipeline").orderBy(F.col("release_ord").asc_nulls_last())
    return (
        first_snapshots.select(
            "pipeline",
            F.col("release_id").alias("old_release"),
            F.lead("release_id").over(window).alias("new_release"),
            F.col("file").alias("old_file"),
            F.lead("file").over(window).alias("new_file"),
        )
        .filter(F.col("new_file").isNotNull())
        .withColumn("label", pair_label("old_release", "new_release"))
    )


def available_releases(flags: DataFrame) -> DataFrame:
    """Release and pipeline pairs with a file that can be compared."""
    usable = flags.filter(F.col("available") & ~F.col("excluded"))
    return usable.select("release_id", "pipeline").distinct()


def inventory(flags: DataFrame) -> DataFrame:
    """The registry as listed in a report."""
    return flags.select(
        "release_id",
        "pipeline",
        "snapshot_date",
        "file",
        "source",
        F.when(F.col("available"), "yes").otherwise("no").alias("available"),
        "notes",
    )


def unavailable_releases(flags: DataFrame) -> DataFrame:
    """Release and pipeline pairs with a registered file that does not exist."""
    return flags.filter(~F.col("available")).select("release_id", "pipeline").distinct()


def latest_file(manifest: DataFrame, pattern: str) -> DataFrame:
    """Last file name that matches; date-prefixed names sort by date."""
    return manifest.filter(F.col("file").rlike(pattern)).agg(F.max("file").alias("file"))


def require_latest_file(manifest: DataFrame, pattern: str) -> str:
    name = latest_file(manifest, pattern).first()["file"]
    if name is None:
        raise ValueError(f"no registered file matches {pattern}")
    return name
