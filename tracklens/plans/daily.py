"""One day's run: choose, transcribe, load, refresh, publish."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.constants import EXCLUDED_STYLE_IDS, MIN_POP_SCORE
from tracklens.functions import today
from tracklens.operators.joins import not_processed
from tracklens.operators.scoring import split_errors
from tracklens.plans.audit import Audit
from tracklens.plans.create import create_candidates
from tracklens.plans.ledger import Ledger
from tracklens.plans.refresh import append_source, refresh_target, with_source
from tracklens.plans.reports import track_statistics
from tracklens.plans.upload import track_metrics, upload_metrics
from tracklens.sources.frequent import known_heavy_keys
from tracklens.sources.readers import read_table, read_work_list
from tracklens.sources.versions import (
    buckets_of,
    recover,
    replace_by_version,
    switch_version,
    version_tag,
    write_version,
)
from tracklens.sources.writers import (
    create_table_as,
    materialize,
    replace_via_staging,
    write_single_csv,
)

# The error of an id that the transcriber gave nothing for.
NOT_RETURNED = "not returned"


@dataclass
class DailyTables:
    """Catalog names of the tables a run reads and writes, and its settings."""

    track_all: str
    mcp_track: str
    mcp_artist: str
    genre_map: str
    genre: str
    daily: str
    target: str
    staging: str
    statistics: str
    threshold: float = MIN_POP_SCORE
    style_ids: Sequence[int] = field(default_factory=lambda: list(EXCLUDED_STYLE_IDS))
    lyric_key: str = "track_id"
    replace: str = "switch"


def run_create(spark: SparkSession, tables: DailyTables, path: str, audit: Audit) -> int:
    """Write the work list of tracks to transcribe; returns how many there are."""
    todo = create_candidates(
        read_table(spark, tables.track_all),
        read_table(spark, tables.mcp_track),
        read_table(spark, tables.target),
        tables.threshold,
        tables.style_ids,
    )
    selected = write_single_csv(todo, path)
    audit.note("selected", selected)
    return selected


def run_detect(
    spark: SparkSession,
    work_list: str,
    folder: str,
    transcribe: Callable[[DataFrame], DataFrame],
    audit: Audit,
) -> None:
    """Transcribe the work list into ``folder``/metrics and ``folder``/errors.

    Every id ends in one of the two: an id that ``transcribe`` does not return is an
    error too. Lines of the list that are no id go to ``folder``/rejects.
    """
    ids, rejects = read_work_list(spark, work_list)
    rejects.write.mode("overwrite").csv(f"{folder}/rejects", header=True)
    # Three outputs follow from the transcripts, which are made only once.
    scored = materialize(transcribe(ids), folder, "transcripts")
    ok, errors = split_errors(scored)
    track_metrics(ok).write.mode("overwrite").csv(f"{folder}/metrics", header=True)
    missing = not_processed(ids, scored).select("track_id", F.lit(NOT_RETURNED).alias("error"))
    missing = materialize(missing, folder, "missing")
    failed = errors.select("track_id", "error").unionByName(missing)
    failed.write.mode("overwrite").csv(f"{folder}/errors", header=True)
    done = scored.agg(
        F.count_if(F.col("error").isNull()).alias("ok"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    ).first()
    audit.note("rejected", rejects.count())
    audit.note("transcribed", done["ok"])
    audit.note("failed", done["failed"])
    audit.note("missing", missing.count())


def run_merge(
    spark: SparkSession,
    tables: DailyTables,
    audit: Audit,
    source: DataFrame | None = None,
    ledger: Ledger | None = None,
) -> None:
    """Put ``source`` behind the target's rows, rebuild the target filtered, publish statistics.

    With ``replace="switch"`` the daily rows never enter the old target: the new one is worked out
    from both and takes its place in one statement, so a rerun cannot add them twice. ``copy``
    appends them first.
    """
    run_refresh(spark, tables, audit, source, ledger)
    run_publish(spark, tables)


def run_refresh(
    spark: SparkSession,
    tables: DailyTables,
    audit: Audit,
    source: DataFrame | None = None,
    ledger: Ledger | None = None,
) -> None:
    """The target's part of ``run_merge``.

    With a ``ledger``, a version that an earlier attempt has switched to already is left as it is.
    """
    recover(spark, tables.target)
    target = read_table(spark, tables.target)
    switch = tables.replace == "switch"
    tag = ledger.run_id() if ledger else "v"
    if switch and ledger and version_tag(spark, tables.target) == tag:
        for name, n in ledger.counts("refreshed").items():
            audit.note(name, n)
        return
    # Behind a union Spark no longer knows of the buckets.
    in_place = source is None and buckets_of(spark, tables.target)[1] == ["track_id"]
    if source is not None:
        if switch:
            target = with_source(target, source)
        else:
            append_source(source, tables.target)
            target = read_table(spark, tables.target)
    found = Audit()
    refreshed = refresh_target(
        target,
        read_table(spark, tables.track_all),
        read_table(spark, tables.mcp_track),
        tables.style_ids,
        tables.lyric_key,
        audit=found,
        in_place=in_place,
    )
    if switch:
        path = write_version(refreshed, tables.target, tag)
        if ledger:
            ledger.finish("refreshed", found.counts())
        switch_version(spark, tables.target, path)
    else:
        replace_via_staging(refreshed, tables.target, tables.staging, tables.replace)
    for name, n in found.counts().items():
        audit.note(name, n)


def run_publish(spark: SparkSession, tables: DailyTables) -> None:
    """Replace the statistics by those of the present target."""
    statistics = track_statistics(
        read_table(spark, tables.target),
        read_table(spark, tables.mcp_track),
        read_table(spark, tables.mcp_artist),
        read_table(spark, tables.genre_map),
        read_table(spark, tables.genre),
        heavy={"mcp_track": known_heavy_keys(spark, tables.mcp_track, "b_track_id")},
    )
    if spark.catalog.tableExists(tables.statistics):
        replace_by_version(statistics, tables.statistics)
    else:
        create_table_as(statistics, tables.statistics)


def run_daily(
    spark: SparkSession,
    tables: DailyTables,
    root: str,
    transcribe: Callable[[DataFrame], DataFrame],
    day: str | None = None,
) -> DataFrame:
    """Run one day, by default today, and return its (stage, n) counts.

    Any failure raises. Called again with the same ``root`` and day, it goes on behind the last step
    that was finished, and ends with the rows and counts of a run without a failure (with
    ``replace="switch"``); a day that is finished returns its counts. Another ``root`` runs the day anew.

    ``transcribe`` turns the work list (track_id) into (track_id, text,
    segments, error), for instance with ``score_batches``. Each selected id counts as
    transcribed, failed or missing. Files of the run go
    below ``root``, a folder all executors can reach. The target table exists;
    the statistics table is created on the first run. The parts can also
    be run one by one.
    """
    audit = Audit()
    day = day or today()
    folder = f"{root.rstrip('/')}/{day}"
    ledger = Ledger(spark, f"{folder}/steps")
    ledger.run_id()
    recover(spark, tables.target)

    def step(name: str, work: Callable[[Audit], object]) -> dict[str, int]:
        counts = ledger.counts(name)
        if counts is None:
            found = Audit()
            work(found)
            counts = found.counts()
            ledger.finish(name, counts)
        for stage, n in counts.items():
            audit.note(stage, n)
        return counts

    work_list = f"{folder}/work_list"
    source = None
    if step("create", lambda a: run_create(spark, tables, work_list, a))["selected"]:
        step("detect", lambda a: run_detect(spark, work_list, folder, transcribe, a))
        step("upload", lambda a: upload_metrics(
            spark, f"{folder}/metrics", tables.daily, day, audit=a, bad_keys=f"{folder}/bad_keys"
        ))
        source = read_table(spark, tables.daily, day)
    step("refresh", lambda a: run_refresh(spark, tables, a, source, ledger))
    step("publish", lambda a: run_publish(spark, tables))
    return audit.frame(spark)
