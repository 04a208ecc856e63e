"""DuckDB side of the registered queries, written from the semantics alone.

Joins are spelled the plain way (fan-out and all), lists are string aggregates
and metrics come from unnested segments, so nothing mirrors the Spark plans.
"""

from __future__ import annotations

from workload.views import TEST_STYLE_IDS, with_views

ORACLE: dict[str, str] = {}

_IDS = "list_value(" + ", ".join(map(str, TEST_STYLE_IDS)) + ")"
DAY = "20240103"


def oracle(name: str, sql: str, *views: str) -> None:
    ORACLE[name] = with_views(sql, *views) if views else sql.strip()


# Three-valued overlap: a list with a NULL element and no hit is unknown.
def _overlap(col: str) -> str:
    return f"""CASE WHEN list_has_any({col}, {_IDS}) THEN TRUE
        WHEN {col} IS NULL OR len({col}) > list_count({col}) THEN NULL ELSE FALSE END"""


# --- filters and projections ----------------------------------------------

oracle(
    "min_popularity",
    "SELECT track_id, track_nm, pop_score FROM track_all WHERE pop_score >= 0.2",
    "track_all",
)
oracle(
    "without_lyrics",
    "SELECT * FROM mcp_track WHERE lyric_yn = 'N' AND sync_lyric_yn = 'N'",
    "mcp_track",
)
oracle("with_role", "SELECT * FROM mcp_artist WHERE artist_role_type = 'VOCAL'", "mcp_artist")
oracle(
    "exclude_styles_strict",
    f"""SELECT track_id, track_nm, pop_score FROM track_all
        WHERE style_id_list IS NULL OR NOT ({_overlap('style_id_list')})""",
    "track_all",
)
_EXCLUDED = f"SELECT DISTINCT track_id FROM track_all WHERE {_overlap('style_id_list')}"
oracle("excluded_track_ids", _EXCLUDED, "track_all")
oracle("require_key", "SELECT * FROM meta_raw WHERE track_id IS NOT NULL", "meta_raw")

# A track's genres, name and id, one row per line of the map; NULL is a track too.
_TRACK_GENRE = """
    SELECT track_id, svc_genre_nm AS name, svc_genre_id AS id
    FROM genre_map INNER JOIN genre USING (svc_genre_id)"""
_LISTAGG = f"""
    SELECT track_id, string_agg(name, ',' ORDER BY name) AS genre_array,
           string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS genre_id_array
    FROM ({_TRACK_GENRE}) GROUP BY track_id"""
_SUBSTRING = " OR ".join(f"genre_id_array ILIKE '%{i}%'" for i in (19, 20, 22))
oracle("genre_listagg", _LISTAGG, "genre_map", "genre")
oracle(
    "genre_substring", f"SELECT * FROM ({_LISTAGG}) WHERE {_SUBSTRING}", "genre_map", "genre"
)
oracle(
    "genre_any",
    f"""SELECT * FROM ({_LISTAGG})
        WHERE list_has_any(string_split(genre_id_array, ','), ['19', '20', '22'])""",
    "genre_map",
    "genre",
)
oracle("normalize_key", "SELECT * FROM meta_raw", "meta_raw")
oracle("with_day", f"SELECT *, '{DAY}' AS yyyymmdd FROM meta", "meta")

_TIERS = ", ".join(
    f"CASE WHEN nsp06_unique_word_cnt >= {t} THEN 'Y' ELSE 'N' END AS nsp06uc{t}"
    for t in (28, 20, 16, 13, 10)
)
oracle("tier_flags", f"SELECT *, {_TIERS} FROM meta", "meta")
oracle("create_table_as", f"SELECT *, {_TIERS} FROM meta", "meta")
oracle("materialize", f"SELECT *, {_TIERS} FROM meta", "meta")
oracle(
    "stat_projection",
    f"""SELECT meta.track_id, track_title, track_artist_name_list AS artist_array,
               CAST(NULL AS VARCHAR) AS genre_array, lyric_yn,
               nsp06_word_cnt, nsp06_unique_word_cnt, {_TIERS}
        FROM meta JOIN mcp_track ON meta.track_id = b_track_id""",
    "meta",
    "mcp_track",
)
for _name in ("run_date", "run_date_instant"):
    oracle(
        _name,
        """SELECT strftime(ts + INTERVAL 9 HOUR, '%Y%m%d') AS run_date, COUNT(*) AS n
           FROM events GROUP BY 1""",
    )

# --- joins ------------------------------------------------------------------

oracle(
    "catalog_join",
    """SELECT a.track_id, a.track_nm, a.pop_score, m.track_id AS mcp_track_id, m.track_title,
              m.track_artist_name_list, m.lyric_yn, m.sync_lyric_yn
       FROM track_all a JOIN mcp_track m ON a.track_id = m.b_track_id""",
    "track_all",
    "mcp_track",
)
oracle(
    "genre_join",
    """SELECT m.track_id, m.svc_genre_id, g.svc_genre_nm
       FROM genre_map m JOIN genre g ON m.svc_genre_id = g.svc_genre_id""",
    "genre_map",
    "genre",
)
oracle(
    "not_processed",
    """SELECT a.track_id, a.track_nm, a.pop_score FROM track_all a
       LEFT JOIN seen s ON a.track_id = s.track_id WHERE s.track_id IS NULL""",
    "track_all",
    "seen",
)
oracle(
    "anti_excluded",
    f"""SELECT m.* FROM meta_raw m LEFT JOIN ({_EXCLUDED}) x ON m.track_id = x.track_id
        WHERE x.track_id IS NULL""",
    "meta_raw",
    "track_all",
)
for _name, _key in (
    ("keep_without_lyrics", "track_id"),
    ("keep_without_lyrics_catalog_key", "b_track_id"),
):
    oracle(
        _name,
        f"""SELECT m.track_id, m.nsp06_word_cnt, m.nsp06_unique_word_cnt, m.yyyymmdd,
                   COUNT(*) AS lyric_rows
            FROM meta_raw m LEFT JOIN mcp_track l ON m.track_id = l.{_key}
            WHERE coalesce(l.lyric_yn, 'N') = 'N' GROUP BY ALL""",
        "meta_raw",
        "mcp_track",
    )

# --- aggregates -------------------------------------------------------------


def _newest(source: str, rest: str = "") -> str:
    return f"""SELECT * FROM {source} QUALIFY row_number() OVER (
        PARTITION BY track_id ORDER BY yyyymmdd DESC NULLS LAST,
        nsp06_word_cnt DESC NULLS LAST, nsp06_unique_word_cnt DESC NULLS LAST{rest}) = 1"""


oracle("dedupe_tracks", _newest("meta_raw"), "meta_raw")
oracle("replace_via_staging", _newest("meta_raw"), "meta_raw")

# Lists per track: of all its names; a list without names is empty, not NULL.
_VOCALS = """
    SELECT track_id, array_to_string(list_sort(list_filter(names, lambda n: n IS NOT NULL)), ',')
           AS artist_array
    FROM (SELECT track_id, list(CASE WHEN artist_role_type = 'VOCAL' THEN artist_text END) AS names,
                 bool_or(artist_role_type = 'VOCAL') AS sung FROM mcp_artist GROUP BY track_id)
    WHERE sung"""
_GENRES = f"""
    SELECT track_id, array_to_string(list_sort(list_filter(list(name), lambda n: n IS NOT NULL)), ',')
           AS genre_array
    FROM ({_TRACK_GENRE}) GROUP BY track_id"""
oracle("vocal_artists", _VOCALS, "mcp_artist")
oracle("track_genres", _GENRES, "genre_map", "genre")


def _refresh(source: str, key: str) -> str:
    """The refresh as it is defined: anti join, fan-out, filter, one per track."""
    return f"""
        excluded AS ({_EXCLUDED}),
        styled AS (SELECT m.* FROM {source} m LEFT JOIN excluded x ON m.track_id = x.track_id
                   WHERE x.track_id IS NULL),
        lyric_filtered AS (SELECT s.* FROM styled s LEFT JOIN mcp_track l ON s.track_id = l.{key}
                           WHERE coalesce(l.lyric_yn, 'N') = 'N'),
        refreshed AS ({_newest('(SELECT * FROM lyric_filtered WHERE track_id IS NOT NULL)')})"""


for _name, _key in (("refresh_target", "track_id"), ("refresh_target_catalog_key", "b_track_id")):
    oracle(
        _name,
        f"WITH {_refresh('meta_raw', _key)} SELECT * FROM refreshed",
        "meta_raw",
        "track_all",
        "mcp_track",
    )

_REFRESH_COUNTS = """
    SELECT 'source' AS stage, COUNT(*) AS n FROM {source}
    UNION ALL SELECT 'excluded', COUNT(*) FROM excluded
    UNION ALL SELECT 'after_style', COUNT(*) FROM styled
    UNION ALL SELECT 'after_lyric', COUNT(*) FROM lyric_filtered
    UNION ALL SELECT 'after_dedupe', COUNT(*) FROM refreshed"""
oracle(
    "audit_counts",
    f"WITH {_refresh('meta_raw', 'track_id')} " + _REFRESH_COUNTS.format(source="meta_raw"),
    "meta_raw",
    "track_all",
    "mcp_track",
)
oracle(
    "stage_counts",
    """SELECT 'selected' AS stage, COUNT(*) AS n FROM track_all a
       WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.track_id = a.track_id)
       UNION ALL SELECT 'uploaded', COUNT(*) FROM transcripts""",
    "track_all",
    "seen",
    "transcripts",
)
_META_DAY = f"SELECT *, '{DAY}' AS yyyymmdd FROM meta"
oracle(
    "append_union", f"SELECT * FROM meta_raw UNION ALL {_META_DAY}", "meta_raw", "meta"
)
oracle(
    "append_source", f"SELECT * FROM meta_raw UNION ALL {_META_DAY}", "meta_raw", "meta"
)
oracle(
    "top_tracks",
    """SELECT track_id, track_nm, pop_score FROM track_all
       ORDER BY pop_score DESC, track_id LIMIT 25""",
    "track_all",
)

# --- metrics and excerpts ---------------------------------------------------

# Regular expressions here lack \v in \s, so the white space is spelled out.
_WORD = r"[^\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\p{Z}]+"


def _metrics(segments: str, tracks: str, text_length: str) -> str:
    """CTEs ending in ``metrics``, from a segment table and a track table."""
    return f"""
        seg AS ({segments}),
        trk AS ({tracks}),
        kept AS (SELECT * FROM seg WHERE coalesce(no_speech_prob, 0) < CAST(0.6 AS DOUBLE)),
        word AS (SELECT track_id, unnest(regexp_extract_all(lower(text), '{_WORD}')) AS w FROM kept),
        a AS (SELECT track_id, COUNT(*) AS all_seg_cnt, arg_max(end_s, seg_no) AS total_duration,
                     SUM(length(text)) AS chars FROM seg GROUP BY 1),
        k AS (SELECT track_id, COUNT(*) AS seg_cnt, SUM(end_s - start_s) AS secs
              FROM kept GROUP BY 1),
        w AS (SELECT track_id, COUNT(*) AS words, COUNT(DISTINCT w) AS uniq FROM word GROUP BY 1),
        metrics AS (
            SELECT trk.track_id, CAST({text_length} AS BIGINT) AS text_length,
                   coalesce(all_seg_cnt, 0) AS all_seg_cnt,
                   coalesce(total_duration, 0) AS total_duration,
                   coalesce(secs, 0) AS speech_duration,
                   CASE WHEN total_duration > 0 THEN coalesce(secs, 0) / total_duration
                        ELSE 0 END AS speech_ratio,
                   coalesce(seg_cnt, 0) AS nsp06_seg_cnt,
                   coalesce(words, 0) AS nsp06_word_cnt,
                   coalesce(uniq, 0) AS nsp06_unique_word_cnt
            FROM trk LEFT JOIN a USING (track_id) LEFT JOIN k USING (track_id)
                     LEFT JOIN w USING (track_id))"""


_DOC_SEGMENTS = """
    SELECT track_id, s."start" AS start_s, s."end" AS end_s, s."text" AS text, s.no_speech_prob,
           seg_no
    FROM (SELECT track_id, unnest(segments) AS s, generate_subscripts(segments, 1) AS seg_no
          FROM transcripts)"""
_NESTED = _metrics(_DOC_SEGMENTS, "SELECT * FROM transcripts", "coalesce(length(text), 0)")


def _over_metrics(sql: str) -> str:
    return f"WITH {_NESTED} {sql}"


# The original contract has INT where the metrics are BIGINT.
_INTS = ", ".join(
    f"CAST({c} AS INTEGER) AS {c}"
    for c in (
        "track_id",
        "text_length",
        "all_seg_cnt",
        "nsp06_seg_cnt",
        "nsp06_word_cnt",
        "nsp06_unique_word_cnt",
    )
)
_LOADED = "SELECT * FROM metrics"
_CUT = f"SELECT * REPLACE ({_INTS}, CAST(trunc(total_duration) AS INTEGER) AS total_duration) FROM metrics"
for _name in ("segment_metrics", "track_metrics"):
    oracle(_name, _over_metrics("SELECT * FROM metrics"), "transcripts")
oracle("cast_metrics_fixed", _over_metrics(_LOADED), "transcripts")
oracle("cast_metrics_faithful", _over_metrics(_CUT), "transcripts")
for _name in ("upload_metrics", "ensure_metrics_table"):
    oracle(_name, _over_metrics(f"SELECT *, '{DAY}' AS yyyymmdd FROM ({_LOADED})"), "transcripts")
oracle(
    "metrics_csv",
    # Doubles are texts in the file; these print alike in both engines.
    _over_metrics("SELECT CAST(COLUMNS(*) AS VARCHAR) FROM metrics"),
    "transcripts",
)
for _name in ("metrics_src_csv", "metrics_src_table"):
    oracle(
        _name,
        _over_metrics("SELECT * RENAME (track_id AS track_id_src) FROM metrics"),
        "transcripts",
    )
_JUDGED = "SELECT track_id, nsp06_unique_word_cnt >= 28 AS verdict FROM metrics"
_COUNTED = """SELECT v.verdict, COUNT(j.track_id) AS n
    FROM (VALUES (TRUE), (FALSE)) v(verdict) LEFT JOIN ({judged}) j ON v.verdict = j.verdict
    GROUP BY 1""".format(judged=_JUDGED)
for _name in ("verdict", "verdict_log_lines"):
    oracle(_name, _over_metrics(_JUDGED), "transcripts")
for _name in ("verdict_counts", "verdict_log_counts"):
    oracle(_name, _over_metrics(_COUNTED), "transcripts")
oracle(
    "verdict_by_duration",
    f"""SELECT t.track_id, coalesce(SUM(end_s - start_s), 0) > 20 AS verdict
        FROM transcripts t LEFT JOIN ({_DOC_SEGMENTS}) s ON t.track_id = s.track_id
        GROUP BY t.track_id""",
    "transcripts",
)
oracle(
    "segment_metrics_long",
    "WITH "
    + _metrics("SELECT * FROM segments", "SELECT DISTINCT track_id FROM segments", "chars")
    + " SELECT * FROM metrics",
    "segments",
)
oracle(
    "segment_metrics_long_tracks",
    "WITH "
    + _metrics(
        "SELECT * FROM segments",
        "SELECT doc_id AS track_id, text FROM documents",
        "coalesce(length(text), 0)",
    )
    + " SELECT * FROM metrics",
    "segments",
)

_SAMPLES = """SELECT vec_id AS track_id, n, samples FROM (
    SELECT vec_id, embedding[1:1 + vec_id % 64] || embedding AS samples, len(samples) AS n
    FROM embeddings)"""
oracle(
    "excerpt_thirds",
    f"""WITH s AS ({_SAMPLES}),
        cut AS (SELECT track_id, CASE WHEN n < 45 THEN samples
                ELSE samples[n // 3 + 1 : n // 3 + 15]
                     || samples[2 * n // 3 + 1 : 2 * n // 3 + 15] END AS samples FROM s)
        SELECT track_id, CAST(pos - 1 AS INTEGER) AS pos, CAST(sample AS DOUBLE) AS sample
        FROM (SELECT track_id, unnest(samples) AS sample,
                     generate_subscripts(samples, 1) AS pos FROM cut)""",
)
oracle(
    "excerpt_ranges",
    f"""WITH s AS ({_SAMPLES})
        SELECT track_id, 0 AS part, CAST(0 AS BIGINT) AS start_sample,
               CAST(n AS BIGINT) AS end_sample FROM s WHERE n < 45
        UNION ALL SELECT track_id, 0, n // 3, n // 3 + 15 FROM s WHERE n >= 45
        UNION ALL SELECT track_id, 1, 2 * n // 3, 2 * n // 3 + 15 FROM s WHERE n >= 45""",
)

# --- files and tables -------------------------------------------------------

oracle(
    "track_id_list",
    """SELECT doc_id AS track_id, CAST(NULL AS VARCHAR) AS reject FROM documents
       UNION ALL SELECT NULL, lang FROM documents WHERE lang <> 'en'""",
)
oracle(
    "results_quarantine",
    _over_metrics(
        """SELECT 'good' AS kind, CAST(NULL AS VARCHAR) AS line, * FROM metrics
           UNION ALL BY NAME
           SELECT doc_id AS track_id, 'error' AS kind,
                  doc_id || ',"ERROR: no audio, skipped"' AS line FROM documents
           UNION ALL BY NAME
           SELECT 'timing' AS kind,
                  (CASE WHEN lang = 'en' THEN '# ' ELSE '' END)
                  || 'Total Processing Time: 0:00:' || doc_id AS line FROM documents"""
    ),
    "transcripts",
)
oracle(
    "upload_large_ids",
    _over_metrics(
        f"""SELECT CASE WHEN track_id % 10 = 3 THEN 'id ' || track_id
                   ELSE CAST(track_id + 3000000000 AS VARCHAR) END AS track_id, nsp06_word_cnt
            FROM metrics
            UNION ALL SELECT 'count of bad_key', COUNT(*) FROM metrics WHERE track_id % 10 = 3
            UNION ALL SELECT 'count of uploaded', COUNT(*) FROM metrics WHERE track_id % 10 <> 3"""
    ),
    "transcripts",
)
oracle("read_table", "SELECT * FROM meta", "meta")
oracle("truncate_insert", "SELECT * FROM meta", "meta")
oracle("write_daily_table", _META_DAY, "meta")
oracle(
    "write_daily_day",
    f"SELECT *, '20240102' AS yyyymmdd FROM meta UNION ALL {_META_DAY}",
    "meta",
)
oracle(
    "append_positional",
    """SELECT * FROM meta
       UNION ALL SELECT track_id, nsp06_unique_word_cnt, nsp06_word_cnt FROM meta""",
    "meta",
)
oracle("append_by_name", "SELECT * FROM meta UNION ALL SELECT * FROM meta", "meta")

# --- scoring ----------------------------------------------------------------

_SCORES = """
    SELECT CASE WHEN doc_id % 7 <> 0 THEN doc_id + 9007199254740993 END AS track_id,
           CASE WHEN lang <> 'fr' THEN length(text) END AS text_length,
           CASE WHEN lang = 'fr' THEN 'ValueError: no model for fr' END AS error
    FROM documents"""
oracle("score_batches", _SCORES)
oracle(
    "split_errors",
    f"SELECT *, CASE WHEN error IS NULL THEN 'ok' ELSE 'error' END AS part FROM ({_SCORES})",
)

# --- whole jobs -------------------------------------------------------------


# Chosen ids: sets first (known styles, done), then how often each id stands in both catalogs.
def _candidates(done: str) -> str:
    return f"""
        SELECT track_id FROM (
            SELECT a.track_id, unnest(range(a.n * e.n))
            FROM (SELECT track_id, COUNT(*) AS n FROM track_all
                  WHERE pop_score >= 0.2 AND coalesce(NOT ({_overlap('style_id_list')}), style_id_list IS NULL)
                  GROUP BY track_id) a
            JOIN (SELECT b_track_id, COUNT(*) AS n FROM mcp_track
                  WHERE (lyric_yn, sync_lyric_yn) = ('N', 'N') GROUP BY b_track_id) e
              ON e.b_track_id = a.track_id
            WHERE a.track_id NOT IN (SELECT track_id FROM {done} WHERE track_id IS NOT NULL))"""


oracle("create_candidates", _candidates("seen"), "track_all", "mcp_track", "seen")
oracle(
    "work_list",
    f"""SELECT track_id, CAST(NULL AS VARCHAR) AS reject FROM ({_candidates('seen')})
        UNION ALL SELECT NULL, track_artist_name_list FROM mcp_track""",
    "track_all",
    "mcp_track",
    "seen",
)


def _statistics(source: str) -> str:
    """Each catalog entry as a described track, then what the target has of it."""
    return f"""
        SELECT track_id, track_title, artist_array, genre_array, lyric_yn,
               nsp06_word_cnt, nsp06_unique_word_cnt, {_TIERS}
        FROM {source}
        LEFT JOIN (SELECT b_track_id AS track_id, track_title, lyric_yn, artist_array
                   FROM mcp_track LEFT JOIN ({_VOCALS}) USING (track_id)) described USING (track_id)
        LEFT JOIN ({_GENRES}) genres USING (track_id)"""


oracle(
    "track_statistics",
    _statistics("meta"),
    "meta",
    "mcp_track",
    "mcp_artist",
    "genre_map",
    "genre",
)
oracle(
    "candidate_report",
    f"""WITH wanted AS (SELECT track_id, genre_array FROM ({_LISTAGG}) WHERE {_SUBSTRING}),
        silent AS (SELECT b_track_id AS track_id, track_artist_name_list, lyric_yn, sync_lyric_yn
                   FROM mcp_track WHERE concat(lyric_yn, sync_lyric_yn) = 'NN'),
        popular AS (SELECT track_id, track_nm, pop_score FROM track_all WHERE pop_score >= 0.2)
        SELECT * FROM wanted NATURAL JOIN silent NATURAL JOIN popular""",
    "track_all",
    "mcp_track",
    "genre_map",
    "genre",
)

# The day: choose, transcribe (French fails, some have no text), append, refresh, publish.
_SCORED = f"""
        todo AS ({_candidates('target_full')}),
        scored AS (SELECT t.*, lang FROM todo JOIN transcripts t USING (track_id)
                   JOIN documents ON doc_id = t.track_id),
        {_metrics(
            _DOC_SEGMENTS.replace("FROM transcripts", "FROM once"),
            "SELECT * FROM scored WHERE lang <> 'fr'",
            "coalesce(length(text), 0)",
        ).replace("seg AS", "once AS (SELECT DISTINCT ON (track_id) * FROM scored), seg AS", 1)},
        appended AS (SELECT * FROM target_full
                     UNION ALL SELECT *, '{DAY}' FROM metrics)"""
_DAILY_VIEWS = "transcripts target_full track_all mcp_track mcp_artist genre_map genre".split()
oracle(
    "daily_run",
    f"WITH {_SCORED}, {_refresh('appended', 'track_id')} {_statistics('refreshed')}",
    *_DAILY_VIEWS,
)
oracle(
    "daily_run_audit",
    f"""WITH {_SCORED}, {_refresh('appended', 'track_id')}
        {_REFRESH_COUNTS.format(source='appended')}
        UNION ALL SELECT 'selected', COUNT(*) FROM todo
        UNION ALL SELECT 'rejected', 0
        UNION ALL SELECT 'transcribed', COUNT(*) FROM metrics
        UNION ALL SELECT 'failed', COUNT(*) FROM scored WHERE lang = 'fr'
        UNION ALL SELECT 'missing', COUNT(*) FROM todo WHERE track_id NOT IN (SELECT doc_id FROM documents)
        UNION ALL SELECT 'bad_key', 0
        UNION ALL SELECT 'uploaded', COUNT(*) FROM metrics""",
    *_DAILY_VIEWS,
)
