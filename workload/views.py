"""The batch's input tables, derived from the given Parquet tables.

One SQL text per view serves both engines; ``ARR(`` stands for the array
constructor and ``{name}`` for another table or view. Every view uses all rows of the
tables it is made from, none is filtered, and no value is blanked to have its row
dropped later: what outer and anti joins leave unmatched comes from tables whose ids
overlap in part only. Keys repeat on both sides of the catalog joins, and some are NULL.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession

from tracklens.operators import use_all_cores

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

TEST_STYLE_IDS = [3, 7, 19, 22, 29, 35, 41]

VIEWS: dict[str, str] = {
    # Every sixth part repeats the track before it.
    "track_all": """
        SELECT CASE WHEN p_partkey % 6 = 4 THEN p_partkey - 1 ELSE p_partkey END AS track_id,
               p_name AS track_nm, CAST((p_partkey * 37) % 100 AS DOUBLE) / 100 AS pop_score,
               CASE WHEN p_size % 10 = 0 THEN NULL
                    WHEN p_size % 7 = 0 THEN ARR(p_size, NULL)
                    ELSE ARR(p_size, CAST(p_partkey % 50 AS INT)) END AS style_id_list
        FROM {part}""",
    # Its own id is shifted by 100, so a join on the wrong id shows. Every fifth entry
    # belongs to the track before, and one in 17 to a track that is not in the catalog.
    "mcp_track": """
        SELECT p_partkey + 100 AS track_id,
               CASE WHEN p_partkey % 17 = 0 THEN -1 - p_partkey
                    WHEN p_partkey % 5 = 0 THEN p_partkey - 1 ELSE p_partkey END AS b_track_id,
               p_name AS track_title, p_brand AS track_artist_name_list,
               CASE WHEN p_partkey % 11 = 0 THEN NULL
                    WHEN p_partkey % 3 = 0 THEN 'Y' ELSE 'N' END AS lyric_yn,
               CASE WHEN p_partkey % 8 = 0 THEN 'Y' ELSE 'N' END AS sync_lyric_yn
        FROM {part}""",
    # NULL names and tracks included; a track repeats its artists.
    "mcp_artist": """
        SELECT CASE WHEN l_partkey % 83 = 0 THEN NULL ELSE l_partkey + 100 END AS track_id,
               CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE s_name END AS artist_text,
               CASE WHEN l_returnflag = 'A' THEN 'VOCAL'
                    WHEN l_returnflag = 'R' THEN 'COMPOSER'
                    ELSE 'LYRICIST' END AS artist_role_type
        FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey""",
    # One pair per line, so pairs repeat; some have no track, some no genre.
    "genre_map": """
        SELECT CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE l_partkey END AS track_id,
               CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE CAST(s_nationkey AS BIGINT) END AS svc_genre_id
        FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey""",
    # Genre 24 has another id here, so map rows with 24 find no partner; one has no name.
    "genre": """
        SELECT CASE WHEN n_nationkey = 24 THEN CAST(-24 AS BIGINT)
                    ELSE CAST(n_nationkey AS BIGINT) END AS svc_genre_id,
               CASE WHEN n_nationkey = 7 THEN NULL ELSE n_name END AS svc_genre_nm
        FROM {nation}""",
    # The target before its refresh: two days, so two rows per track, and NULL keys.
    "meta_raw": """
        SELECT CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_partkey END AS track_id,
               COUNT(*) AS nsp06_word_cnt,
               COUNT(DISTINCT l_suppkey) AS nsp06_unique_word_cnt,
               CASE WHEN l_linenumber <= 4 THEN '20240101' ELSE '20240102' END AS yyyymmdd
        FROM {lineitem} GROUP BY 1, 4""",
    # Already processed: twice the ids of customers, which meet even tracks only; repeated.
    "seen": "SELECT o_custkey * 2 AS track_id FROM {orders}",
    # One row per track over all lines.
    "meta": """
        SELECT l_partkey AS track_id, COUNT(*) AS nsp06_word_cnt,
               COUNT(DISTINCT l_suppkey) AS nsp06_unique_word_cnt
        FROM {lineitem} GROUP BY 1""",
    # A target as the daily job keeps it: all metric columns, rows of two days per track.
    "target_full": """
        SELECT o_custkey * 2 AS track_id, COUNT(*) * 6 AS text_length, COUNT(*) AS all_seg_cnt,
               CAST(COUNT(*) AS DOUBLE) AS total_duration,
               CAST(COUNT(*) AS DOUBLE) / 2 AS speech_duration,
               CAST(0.5 AS DOUBLE) AS speech_ratio, COUNT(*) AS nsp06_seg_cnt,
               COUNT(*) AS nsp06_word_cnt, COUNT(DISTINCT o_orderpriority) AS nsp06_unique_word_cnt,
               CASE WHEN o_orderkey % 2 = 0 THEN '20240101' ELSE '20240102' END AS yyyymmdd
        FROM {orders} GROUP BY 1, 10""",
    # Probability missing for 'system', exactly 0.6 present; all times are
    # multiples of 1/8 second, so sums of them are exact in any order.
    "segments": """
        SELECT conv_id AS track_id, turn AS seg_no, CAST(turn * 10 AS DOUBLE) AS start_s,
               CAST(turn * 10 + 2 AS DOUBLE) + CAST(length(text) % 60 AS DOUBLE) / 8 AS end_s,
               text,
               CASE WHEN role = 'system' THEN NULL
                    ELSE CAST((conv_id * 7 + turn * 13) % 10 AS DOUBLE) / 10 END AS no_speech_prob
        FROM {conversations}""",
}

# Nested transcripts: each whole document is one track and each of its lines one
# segment. Every benchmark text comes as a track without segments, NULL or an empty
# list. Lambdas differ by engine.
_TRANSCRIPTS = """
    SELECT doc_id AS track_id, text, {segments} AS segments FROM {{documents}}
    UNION ALL
    SELECT -1 - item_id, text, CASE WHEN item_id % 2 = 0 THEN {empty} END FROM {{benchmark}}"""
SPARK_VIEWS = {
    **VIEWS,
    "transcripts": _TRANSCRIPTS.format(
        empty="array()",
        segments="""
           transform(split(text, '\\n'), (line, i) -> named_struct(
               'start', CAST(i * 10 AS DOUBLE),
               'end', CAST(i * 10 + 2 AS DOUBLE) + CAST(length(line) % 60 AS DOUBLE) / 8,
               'text', line,
               'no_speech_prob', CASE WHEN (doc_id + i) % 11 = 0 THEN NULL
                    ELSE CAST((doc_id * 7 + i * 13) % 10 AS DOUBLE) / 10 END))""",
    ),
}
DUCKDB_VIEWS = {
    **VIEWS,
    # Element numbers start at 1 here, at 0 above.
    "transcripts": _TRANSCRIPTS.format(
        empty="[]",
        segments="""
           list_transform(string_split(text, chr(10)), lambda line, k: struct_pack(
               "start" := CAST((k - 1) * 10 AS DOUBLE),
               "end" := CAST((k - 1) * 10 + 2 AS DOUBLE) + CAST(length(line) % 60 AS DOUBLE) / 8,
               "text" := line,
               "no_speech_prob" := CASE WHEN (doc_id + k - 1) % 11 = 0 THEN NULL
                    ELSE CAST((doc_id * 7 + (k - 1) * 13) % 10 AS DOUBLE) / 10 END))""",
    ),
}


def _uses(text: str) -> list[str]:
    return [n for n in [*TABLES, *SPARK_VIEWS] if "{" + n + "}" in text]


@cache
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or one of the views above, as a DataFrame.

    Kept per session, so file footers are read and views analysed only once.
    """
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = SPARK_VIEWS[name]
    parts = {n: table(spark, sf_dir, n) for n in _uses(text)}
    if name == "transcripts":
        parts["documents"] = use_all_cores(parts["documents"])
    return spark.sql(text.replace("ARR(", "array("), **parts)


@cache
def _needed(name: str) -> tuple[str, ...]:
    found: list[str] = []
    for n in _uses(DUCKDB_VIEWS[name]):
        if n in DUCKDB_VIEWS:
            found += [m for m in (*_needed(n), n) if m not in found]
    return tuple(found)


def with_views(query: str, *names: str) -> str:
    """``query`` for DuckDB behind a WITH list of the views it reads."""
    order: list[str] = []
    for name in names:
        order += [n for n in (*_needed(name), name) if n not in order]
    plain = {n: n for n in [*TABLES, *SPARK_VIEWS]}
    ctes = [
        f"{n} AS ({DUCKDB_VIEWS[n].replace('ARR(', 'list_value(').format(**plain)})"
        for n in order
    ]
    query = query.strip()
    if query[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ",\n" + query[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + query
