"""All tables of a release comparison."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from panelweave.operators.dedup import keep_first
from panelweave.operators.diff import STATUSES, diff_detail, diff_pairs
from panelweave.operators.registry import consecutive_pairs, first_snapshot_per_release
from panelweave.operators.reshape import count_by_status, union_all
from panelweave.sources.scratch import materialize


@dataclass(frozen=True)
class DiffReport:
    """Tables of a release comparison; all but ``detail`` are small."""

    headline: DataFrame
    by_group: DataFrame
    top_added: DataFrame
    detail: DataFrame


def pairs_of(flags: DataFrame, pipeline: str) -> list[tuple[str, str]]:
    """Consecutive releases of one pipeline; as short as the list of releases."""
    pairs = consecutive_pairs(first_snapshot_per_release(flags)).filter(
        F.col("pipeline") == pipeline
    )
    return [(row["old_release"], row["new_release"]) for row in pairs.collect()]


def report_registered(
    flags: DataFrame,
    pipeline: str,
    read: Callable[[str], DataFrame],
    key_cols: Sequence[str],
    value_col: str,
    release_col: str = "release_id",
    **options,
) -> DiffReport:
    """Compare the consecutive releases of a pipeline, starting from the registry.

    ``read`` loads the snapshot of a file on its harmonised key, such as
    ``read_raw_snapshot``. Each release is read once, though it may be in two pairs;
    only release names and files reach the driver. Needs two usable releases.
    """
    pairs = (
        consecutive_pairs(first_snapshot_per_release(flags))
        .filter(F.col("pipeline") == pipeline)
        .collect()
    )
    if not pairs:
        raise ValueError(f"no two releases of {pipeline} can be compared")
    files = {p["old_release"]: p["old_file"] for p in pairs}
    files |= {p["new_release"]: p["new_file"] for p in pairs}
    snapshots = union_all(
        [read(file).withColumn(release_col, F.lit(release)) for release, file in files.items()]
    )
    named = [(p["old_release"], p["new_release"]) for p in pairs]
    return diff_report(
        snapshots, named, key_cols, value_col, release_col=release_col, **options
    )


def diff_report(
    snapshots: DataFrame,
    pairs: Sequence[tuple[str, str]],
    key_cols: Sequence[str],
    value_col: str,
    group: str = "year",
    entity: str = "iso3",
    detail_order: Sequence[str] = ("iso3", "year", "var_short"),
    release_col: str = "release_id",
    top: int = 15,
) -> DiffReport:
    """Compare all pairs once and derive every table of the report from it.

    The diff is written to the shared work folder because several results read
    it; the three summaries come from one small count per pair, group and entity.
    """
    diff = materialize(
        diff_pairs(snapshots, pairs, key_cols, value_col, release_col), "diff"
    )
    cells = count_by_status(diff, ["pair", group, entity], "status", STATUSES)
    columns = ["n_" + status for status in STATUSES]

    def totals(*by: str) -> DataFrame:
        return cells.groupBy(*by).agg(*[F.sum(c).alias(c) for c in columns])

    headline = totals("pair").select(
        "pair",
        (F.col("n_removed") + F.col("n_changed") + F.col("n_unchanged")).alias("old_rows"),
        (F.col("n_added") + F.col("n_changed") + F.col("n_unchanged")).alias("new_rows"),
        *columns,
    )
    by_group = totals("pair", group).orderBy("pair", F.col(group).asc_nulls_last())
    return DiffReport(
        headline=headline,
        by_group=by_group,
        top_added=top_added_per_pair(totals("pair", entity), entity, top),
        detail=diff_detail(diff, ["pair", *detail_order]),
    )


def top_added_per_pair(counts: DataFrame, entity: str, top: int) -> DataFrame:
    """The entities with most added points of every pair."""
    return keep_first(
        counts.filter(F.col("n_added") > 0).select("pair", entity, "n_added"),
        ["pair"],
        [F.desc("n_added"), F.col(entity).asc_nulls_last()],
        n=top,
    )
