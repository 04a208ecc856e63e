"""Spark side of the registered queries: one per operator or job."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklens import operators as ops
from tracklens import plans, sources
from tracklens.constants import METRIC_COLUMNS
from tracklens.session import apply_runtime_options, scratch_dir
from workload.views import TEST_STYLE_IDS, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY = "20240103"
_SCRATCH = "scratch_"
EXCERPT = {"rate": 1, "keep_s": 45, "slice_s": 15}


def query(name: str, *views: str) -> Callable[[Callable[..., DataFrame]], Query]:
    """Register a function of (spark, *views) under ``name``."""

    def register(fn: Callable[..., DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_runtime_options(spark)
            return fn(spark, *(table(spark, sf_dir, v) for v in views))

        QUERIES[name] = run
        return run

    return register


def scratch_database(spark: SparkSession) -> str:
    """A new database whose tables lie in a new shared folder.

    The frames that queries return read its tables; ``drop_scratch`` comes after that.
    """
    name = f"{_SCRATCH}{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark, name)}'")
    return name


def drop_scratch(spark: SparkSession) -> None:
    """Drop the scratch databases of queries whose results have been read."""
    for db in spark.catalog.listDatabases(f"{_SCRATCH}*"):
        spark.sql(f"DROP DATABASE {db.name} CASCADE")


TRACK = ["track_id", "track_nm", "pop_score"]


# --- filters and projections ----------------------------------------------


@query("min_popularity", "track_all")
def _(spark, track_all):
    return ops.min_popularity(track_all).select(*TRACK)


@query("without_lyrics", "mcp_track")
def _(spark, mcp_track):
    return ops.without_lyrics(mcp_track)


@query("with_role", "mcp_artist")
def _(spark, mcp_artist):
    return ops.with_role(mcp_artist)


@query("exclude_styles_strict", "track_all")
def _(spark, track_all):
    return ops.exclude_styles_strict(track_all, TEST_STYLE_IDS).select(*TRACK)


@query("excluded_track_ids", "track_all")
def _(spark, track_all):
    return ops.excluded_track_ids(track_all, TEST_STYLE_IDS)


@query("require_key", "meta_raw")
def _(spark, meta_raw):
    return ops.require_key(meta_raw)


@query("genre_substring", "genre_map", "genre")
def _(spark, genre_map, genre):
    return ops.genre_substring(ops.genre_listagg(genre_map, genre))


@query("genre_any", "genre_map", "genre")
def _(spark, genre_map, genre):
    return ops.genre_any(ops.genre_listagg(genre_map, genre))


@query("normalize_key", "meta_raw")
def _(spark, meta_raw):
    text_key = meta_raw.withColumn("track_id", F.col("track_id").cast("string"))
    return ops.normalize_key(text_key)


def _as_strings(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


@query("cast_metrics_fixed", "transcripts")
def _(spark, transcripts):
    return ops.cast_metrics(_as_strings(plans.track_metrics(transcripts)))


@query("cast_metrics_faithful", "transcripts")
def _(spark, transcripts):
    return ops.cast_metrics(_as_strings(plans.track_metrics(transcripts)), mode="faithful")


@query("with_day", "meta")
def _(spark, meta):
    return ops.with_day(meta, DAY)


@query("tier_flags", "meta")
def _(spark, meta):
    return ops.tier_flags(meta)


@query("stat_projection", "meta", "mcp_track")
def _(spark, meta, mcp_track):
    entries = mcp_track.select(
        F.col("b_track_id").alias("track_id"),
        "track_title",
        F.col("track_artist_name_list").alias("artist_array"),
        F.lit(None).cast("string").alias("genre_array"),
        "lyric_yn",
    )
    return ops.stat_projection(meta.join(entries, "track_id"))


@query("verdict", "transcripts")
def _(spark, transcripts):
    return ops.verdict(plans.track_metrics(transcripts)).select("track_id", "verdict")


@query("verdict_by_duration", "transcripts")
def _(spark, transcripts):
    return ops.verdict_by_duration(transcripts).select("track_id", "verdict")


@query("run_date", "events")
def _(spark, events):
    return ops.with_run_date(events, "ts").groupBy("run_date").agg(F.count("*").alias("n"))


@query("run_date_instant", "events")
def _(spark, events):
    """The same from a TIMESTAMP, whatever the session's zone."""
    ntz = F.col("ts").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ntz)
    instants = events.select(F.timestamp_micros(micros).alias("ts"))
    return ops.with_run_date(instants, "ts").groupBy("run_date").agg(F.count("*").alias("n"))


# --- joins ------------------------------------------------------------------


@query("catalog_join", "track_all", "mcp_track")
def _(spark, track_all, mcp_track):
    return ops.catalog_join(track_all.drop("style_id_list"), mcp_track)


@query("genre_join", "genre_map", "genre")
def _(spark, genre_map, genre):
    return ops.genre_join(genre_map, genre)


@query("not_processed", "track_all", "seen")
def _(spark, track_all, seen):
    return ops.not_processed(track_all.select(*TRACK), seen)


@query("anti_excluded", "meta_raw", "track_all")
def _(spark, meta_raw, track_all):
    return ops.anti_excluded(meta_raw, ops.excluded_track_ids(track_all, TEST_STYLE_IDS))


@query("keep_without_lyrics", "meta_raw", "mcp_track")
def _(spark, meta_raw, mcp_track):
    return ops.keep_without_lyrics(meta_raw, mcp_track)


@query("keep_without_lyrics_catalog_key", "meta_raw", "mcp_track")
def _(spark, meta_raw, mcp_track):
    return ops.keep_without_lyrics(meta_raw, mcp_track, lyric_key="b_track_id")


# --- aggregates -------------------------------------------------------------


@query("dedupe_tracks", "meta_raw")
def _(spark, meta_raw):
    return ops.dedupe_tracks(meta_raw)


@query("vocal_artists", "mcp_artist")
def _(spark, mcp_artist):
    return ops.vocal_artists(mcp_artist)


@query("track_genres", "genre_map", "genre")
def _(spark, genre_map, genre):
    return ops.track_genres(genre_map, genre)


@query("genre_listagg", "genre_map", "genre")
def _(spark, genre_map, genre):
    return ops.genre_listagg(genre_map, genre)


@query("audit_counts", "meta_raw", "track_all", "mcp_track")
def _(spark, meta_raw, track_all, mcp_track):
    return plans.audit_counts(meta_raw, track_all, mcp_track, TEST_STYLE_IDS)


@query("stage_counts", "track_all", "seen", "transcripts")
def _(spark, track_all, seen, transcripts):
    return ops.stage_counts(
        selected=ops.not_processed(track_all, seen), uploaded=plans.track_metrics(transcripts)
    )


@query("verdict_counts", "transcripts")
def _(spark, transcripts):
    return ops.verdict_counts(ops.verdict(plans.track_metrics(transcripts)))


@query("append_union", "meta_raw", "meta")
def _(spark, meta_raw, meta):
    return meta_raw.unionByName(ops.with_day(meta, DAY))


@query("top_tracks", "track_all")
def _(spark, track_all):
    return ops.top_tracks(track_all.select(*TRACK), 25)


# --- metrics and excerpts ---------------------------------------------------


@query("segment_metrics", "transcripts")
def _(spark, transcripts):
    return ops.segment_metrics(transcripts)


@query("segment_metrics_long", "segments")
def _(spark, segments):
    return ops.segment_metrics_long(segments)


@query("segment_metrics_long_tracks", "segments", "documents")
def _(spark, segments, documents):
    tracks = documents.select(F.col("doc_id").alias("track_id"), "text")
    return ops.segment_metrics_long(segments, tracks)


@query("excerpt_thirds", "embeddings")
def _(spark, embeddings):
    cut = ops.excerpt_thirds(_samples(embeddings), "samples", **EXCERPT)
    return cut.select("track_id", F.posexplode("samples").alias("pos", "sample")).select(
        "track_id", "pos", F.col("sample").cast("double").alias("sample")
    )


@query("excerpt_ranges", "embeddings")
def _(spark, embeddings):
    sized = _samples(embeddings).withColumn("n", F.size("samples"))
    return ops.excerpt_ranges(sized, "n", **EXCERPT)


def _samples(embeddings: DataFrame) -> DataFrame:
    """Sample arrays of differing length, every second one doubled."""
    e = F.col("embedding")
    length = (F.lit(1) + F.col("vec_id") % 64).cast("int")
    return embeddings.select(
        F.col("vec_id").alias("track_id"), F.concat(F.slice(e, 1, length), e).alias("samples")
    )


# --- files ------------------------------------------------------------------


@query("metrics_csv", "transcripts")
def _(spark, transcripts):
    path = scratch_dir(spark, "metrics")
    plans.track_metrics(transcripts).write.csv(path, header=True)
    return sources.read_metrics_csv(spark, path)


@query("metrics_src_csv", "transcripts")
def _(spark, transcripts):
    path = scratch_dir(spark, "metrics_src")
    rows = plans.track_metrics(transcripts).withColumnRenamed("track_id", "track_id_src")
    rows.write.csv(path, header=True)
    return sources.read_metrics_src_csv(spark, path)


@query("metrics_src_table", "transcripts")
def _(spark, transcripts):
    path = scratch_dir(spark, "metrics_src")
    rows = plans.track_metrics(transcripts).withColumnRenamed("track_id", "track_id_src")
    rows.write.csv(path, header=True)
    name = f"{scratch_database(spark)}.metrics_src"
    sources.create_metrics_src_table(spark, name, path)
    return sources.read_table(spark, name)


@query("track_id_list", "documents")
def _(spark, documents):
    path = scratch_dir(spark, "ids")
    lines = documents.select(F.concat(F.lit("  "), F.col("doc_id").cast("string")).alias("value"))
    noise = documents.select(F.when(F.col("lang") == "en", "").otherwise(F.col("lang")))
    lines.union(noise).write.text(path)
    ids, rejects = sources.read_track_id_list(spark, path)
    return ids.select("track_id", F.lit(None).cast("string").alias("reject")).union(
        rejects.select(F.lit(None).cast("bigint"), "value")
    )


@query("work_list", "track_all", "mcp_track", "seen")
def _(spark, track_all, mcp_track, seen):
    path = scratch_dir(spark, "work_list")
    todo = plans.create_candidates(track_all, mcp_track, seen, style_ids=TEST_STYLE_IDS)
    # Names among the ids, as a damaged list would have them.
    names = mcp_track.select(F.col("track_artist_name_list").alias("track_id"))
    listed = todo.select(F.col("track_id").cast("string")).unionByName(names)
    sources.write_single_csv(listed, path, files=2)
    ids, rejects = sources.read_work_list(spark, path)
    return ids.select("track_id", F.lit(None).cast("string").alias("reject")).union(
        rejects.select(F.lit(None).cast("bigint"), "value")
    )


@query("results_quarantine", "transcripts", "documents")
def _(spark, transcripts, documents):
    path = scratch_dir(spark, "results")
    metrics = plans.track_metrics(transcripts).select(F.concat_ws(",", *METRIC_COLUMNS))
    # Error rows of two columns, and timing lines with and without the comment sign.
    failed = documents.select(F.concat(F.col("doc_id"), F.lit(',"ERROR: no audio, skipped"')))
    timing = documents.select(
        F.concat(
            F.when(F.col("lang") == "en", "# ").otherwise(""),
            F.lit("Total Processing Time: 0:00:"),
            F.col("doc_id"),
        )
    )
    header = spark.range(1).select(F.lit(",".join(METRIC_COLUMNS)))
    header.union(metrics).union(failed).union(timing).write.text(path)
    good, bad = sources.read_results_quarantine(spark, path)
    return good.withColumn("kind", F.lit("good")).unionByName(bad, allowMissingColumns=True)


@query("verdict_log_counts", "transcripts")
def _(spark, transcripts):
    return plans.log_verdict_summary(spark, _write_log(spark, transcripts))


@query("verdict_log_lines", "transcripts")
def _(spark, transcripts):
    return ops.parse_verdict_lines(sources.read_logs(spark, _write_log(spark, transcripts)))


def _write_log(spark: SparkSession, transcripts: DataFrame) -> str:
    path = scratch_dir(spark, "logs")
    judged = ops.verdict(plans.track_metrics(transcripts))
    phrase = F.when(F.col("verdict"), "Voice detected: ").otherwise("Voice is not detected: ")
    record = F.format_string(
        "{'track_id': %d, 'nsp06_unique_word_cnt': %d}", "track_id", "nsp06_unique_word_cnt"
    )
    started = judged.select(F.format_string("track %d started", "track_id").alias("value"))
    started.union(judged.select(F.concat(F.lit("[INFO] "), phrase, record))).write.text(path)
    return path + "/*.txt"


# --- tables -----------------------------------------------------------------


@query("read_table", "meta")
def _(spark, meta):
    name = f"{scratch_database(spark)}.meta"
    meta.write.saveAsTable(name)
    return sources.read_table(spark, name)


@query("write_daily_table", "meta")
def _(spark, meta):
    name = f"{scratch_database(spark)}.daily"
    sources.write_daily(meta, name, "20240102")
    sources.write_daily(meta, name, DAY)
    return sources.read_table(spark, name)


@query("write_daily_day", "meta")
def _(spark, meta):
    name = f"{scratch_database(spark)}.daily"
    for day in ("20240102", DAY, DAY):
        sources.write_daily(meta, name, day, replace="day")
    return sources.read_table(spark, name)


@query("append_positional", "meta")
def _(spark, meta):
    name = f"{scratch_database(spark)}.target"
    meta.write.saveAsTable(name)
    swapped = meta.select("track_id", "nsp06_unique_word_cnt", "nsp06_word_cnt")
    sources.append_positional(swapped, name)
    return sources.read_table(spark, name)


@query("append_by_name", "meta")
def _(spark, meta):
    name = f"{scratch_database(spark)}.target"
    meta.write.saveAsTable(name)
    swapped = meta.select("nsp06_unique_word_cnt", "nsp06_word_cnt", "track_id")
    sources.append_by_name(swapped, name)
    return sources.read_table(spark, name)


@query("append_source", "meta_raw", "meta")
def _(spark, meta_raw, meta):
    name = f"{scratch_database(spark)}.target"
    meta_raw.write.saveAsTable(name)
    source = ops.with_day(meta, DAY).withColumn("track_id", F.col("track_id").cast("int"))
    plans.append_source(source, name)
    return sources.read_table(spark, name)


@query("replace_via_staging", "meta_raw")
def _(spark, meta_raw):
    db = scratch_database(spark)
    meta_raw.write.partitionBy("yyyymmdd").saveAsTable(f"{db}.target")
    rows = ops.dedupe_tracks(sources.read_table(spark, f"{db}.target"))
    sources.replace_via_staging(rows, f"{db}.target", f"{db}.staging")
    return sources.read_table(spark, f"{db}.target")


@query("truncate_insert", "meta_raw", "meta")
def _(spark, meta_raw, meta):
    name = f"{scratch_database(spark)}.stat"
    sources.create_table_as(meta_raw.drop("yyyymmdd"), name)
    sources.truncate_insert(meta, name)
    return sources.read_table(spark, name)


@query("create_table_as", "meta")
def _(spark, meta):
    name = f"{scratch_database(spark)}.stat"
    sources.create_table_as(ops.tier_flags(meta), name)
    return sources.read_table(spark, name)


@query("ensure_metrics_table", "transcripts")
def _(spark, transcripts):
    name = f"{scratch_database(spark)}.daily"
    sources.ensure_metrics_table(spark, name)
    sources.ensure_metrics_table(spark, name)
    rows = ops.with_day(ops.cast_metrics(_as_strings(plans.track_metrics(transcripts))), DAY)
    sources.append_positional(rows, name)
    return sources.read_table(spark, name, DAY)


@query("materialize", "meta")
def _(spark, meta):
    return sources.materialize(ops.tier_flags(meta), scratch_dir(spark, "footprint"), "tiers")


# --- scoring ----------------------------------------------------------------


def _scored(documents: DataFrame) -> DataFrame:
    """A stand-in scorer: text length, but it has no model for French."""

    def make_scorer():
        known = {"en", "de", "es"}

        def score(row):
            if row["lang"] not in known:
                raise ValueError(f"no model for {row['lang']}")
            return {"text_length": len(row["text"])}

        return score

    rows = documents.select(F.col("doc_id").alias("track_id"), "lang", "text")
    # Large ids beside NULL ones: both must come through untouched.
    large = F.when(F.col("track_id") % 7 != 0, F.col("track_id") + 9_007_199_254_740_993)
    return ops.score_batches(
        rows.withColumn("track_id", large), ops.row_by_row(make_scorer), "text_length bigint"
    )


@query("score_batches", "documents")
def _(spark, documents):
    return _scored(documents)


@query("split_errors", "documents")
def _(spark, documents):
    folder = scratch_dir(spark, "scored")
    ok, errors = ops.split_errors(sources.materialize(_scored(documents), folder, "all"))
    return ok.withColumn("part", F.lit("ok")).unionByName(
        errors.withColumn("part", F.lit("error")), allowMissingColumns=True
    )


# --- whole jobs -------------------------------------------------------------


@query("create_candidates", "track_all", "mcp_track", "seen")
def _(spark, track_all, mcp_track, seen):
    return plans.create_candidates(track_all, mcp_track, seen, style_ids=TEST_STYLE_IDS)


@query("track_metrics", "transcripts")
def _(spark, transcripts):
    return plans.track_metrics(transcripts)


@query("upload_metrics", "transcripts")
def _(spark, transcripts):
    path = scratch_dir(spark, "detect")
    plans.track_metrics(transcripts).write.csv(path, header=True)
    name = f"{scratch_database(spark)}.daily"
    plans.upload_metrics(spark, path, name, DAY)
    return sources.read_table(spark, name)


@query("upload_large_ids", "transcripts")
def _(spark, transcripts):
    """Ids beyond INT from the metric file to the refreshed target; a few are no number."""
    path, db = scratch_dir(spark, "detect"), scratch_database(spark)
    metrics = plans.track_metrics(transcripts)
    text_id = F.when(F.col("track_id") % 10 == 3, F.concat(F.lit("id "), "track_id")).otherwise(
        (F.col("track_id") + 3_000_000_000).cast("string")
    )
    metrics.withColumn("track_id", text_id).write.csv(path, header=True)
    audit = plans.Audit()
    bad = f"{path}_bad"
    plans.upload_metrics(spark, path, f"{db}.daily", DAY, audit=audit, bad_keys=bad)
    sources.ensure_metrics_table(spark, f"{db}.target")
    plans.append_source(sources.read_table(spark, f"{db}.daily", DAY), f"{db}.target")
    kept = ops.dedupe_tracks(sources.read_table(spark, f"{db}.target")).select(
        F.col("track_id").cast("string").alias("track_id"), "nsp06_word_cnt"
    )
    set_aside = sources.read_metrics_csv(spark, bad).select(
        "track_id", F.col("nsp06_word_cnt").cast("bigint")
    )
    counts = audit.frame(spark).select(F.concat(F.lit("count of "), "stage"), "n")
    return kept.union(set_aside).union(counts)


@query("refresh_target", "meta_raw", "track_all", "mcp_track")
def _(spark, meta_raw, track_all, mcp_track):
    return plans.refresh_target(meta_raw, track_all, mcp_track, TEST_STYLE_IDS)


@query("refresh_target_catalog_key", "meta_raw", "track_all", "mcp_track")
def _(spark, meta_raw, track_all, mcp_track):
    return plans.refresh_target(
        meta_raw, track_all, mcp_track, TEST_STYLE_IDS, lyric_key="b_track_id"
    )


@query("track_statistics", "meta", "mcp_track", "mcp_artist", "genre_map", "genre")
def _(spark, meta, mcp_track, mcp_artist, genre_map, genre):
    return plans.track_statistics(meta, mcp_track, mcp_artist, genre_map, genre)


@query("candidate_report", "track_all", "mcp_track", "genre_map", "genre")
def _(spark, track_all, mcp_track, genre_map, genre):
    return plans.candidate_report(track_all, mcp_track, genre_map, genre)


_DAILY_INPUTS = ["track_all", "mcp_track", "mcp_artist", "genre_map", "genre"]


def _run_day(spark, transcripts, documents, target, *inputs) -> tuple[DataFrame, DataFrame]:
    """(audit, statistics) of one day over fresh tables."""
    db = scratch_database(spark)
    prefix = f"v_{uuid.uuid4().hex}_"
    views = {n: prefix + n for n in _DAILY_INPUTS}
    for name, df in zip(_DAILY_INPUTS, inputs):
        df.createOrReplaceTempView(views[name])
    target.write.saveAsTable(f"{db}.target")
    texts = transcripts.join(
        documents.select(F.col("doc_id").alias("track_id"), "lang"), "track_id"
    )

    def make_scorer():
        def score(row):
            if row["lang"] == "fr":
                raise ValueError("no model for fr")
            return {"text": row["text"], "segments": row["segments"]}

        return score

    def transcribe(ids):
        # What has no text is not returned.
        return ops.score_batches(
            ids.join(texts, "track_id"),
            ops.row_by_row(make_scorer),
            T.StructType([f for f in transcripts.schema if f.name != "track_id"]),
        )

    tables = plans.DailyTables(
        **views,
        daily=f"{db}.daily",
        target=f"{db}.target",
        staging=f"{db}.staging",
        statistics=f"{db}.statistics",
        style_ids=TEST_STYLE_IDS,
    )
    audit = plans.run_daily(
        spark,
        tables,
        scratch_dir(spark, "daily"),
        transcribe,
        DAY,
    )
    for view in views.values():
        spark.catalog.dropTempView(view)
    return audit, sources.read_table(spark, tables.statistics)


@query("daily_run", "transcripts", "documents", "target_full", *_DAILY_INPUTS)
def _(spark, *views):
    return _run_day(spark, *views)[1]


@query("daily_run_audit", "transcripts", "documents", "target_full", *_DAILY_INPUTS)
def _(spark, *views):
    return _run_day(spark, *views)[0]
