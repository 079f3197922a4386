"""The registered queries as SQL over the raw test tables, written independently.

Models are written in their plain form: un-partitioned windows, plays joined to every
playlist, one row per play and playlist. PARTS are named sub-queries; a query gets the
ones it mentions, in order, as a WITH clause.
"""

from __future__ import annotations

import re

from playspan import fixed
from playspan.sources.schemas import HISTORY_TRACK_URI as URI

PREFIX = fixed.TRACK_URI_PREFIX
NO_VALUE = fixed.SURROGATE_NULL_TEXT
CUT = len(PREFIX) + 1


def ties(columns: str) -> str:
    return ", ".join(f"{c} ASC NULLS LAST" for c in columns.split())


def newest(source: str, keys: str, rest: str, at: str = "loaded_at", where: str = "TRUE") -> str:
    """Rows of ``source`` with the highest ``at`` per key, ties by ``rest``."""
    return f"""
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY {keys} ORDER BY {at} DESC NULLS LAST, {ties(rest)}) AS place
            FROM {source}) WHERE place = 1 AND {where}"""


def totals(source: str, key: str) -> str:
    return f"""
        SELECT {key}, count(*) AS total_plays,
            count(DISTINCT track_id) AS unique_tracks_played,
            count(DISTINCT played_date) AS days_played,
            min(played_at) AS first_played_at, max(played_at) AS last_played_at,
            CAST(sum(duration_ms) AS BIGINT) AS total_listen_time_ms
        FROM {source} GROUP BY {key}"""


def hashed(*columns: str) -> str:
    texts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{NO_VALUE}')" for c in columns)
    return f"md5(concat_ws('-', {texts}))"


def calendar(ts: str, hour: str = "played_hour") -> str:
    return f"""
        CAST({ts} AS DATE) AS played_date, CAST(year({ts}) AS BIGINT) AS played_year,
        CAST(month({ts}) AS BIGINT) AS played_month, CAST(day({ts}) AS BIGINT) AS played_day,
        CAST(hour({ts}) AS BIGINT) AS {hour}, CAST(dayofweek({ts}) AS BIGINT) AS played_day_of_week,
        strftime({ts}, '%A') AS played_day_name"""


def name_id(column: str, prefix: str, length: int) -> str:
    return f"'{prefix}' || left(md5(coalesce({column}, '{fixed.UNKNOWN_NAME}')), {length})"


def artist_name_id(column: str) -> str:
    return name_id(column, fixed.ARTIST_FALLBACK_PREFIX, fixed.ARTIST_FALLBACK_LENGTH)


def album_name_id(column: str) -> str:
    return name_id(column, fixed.ALBUM_FALLBACK_PREFIX, fixed.ALBUM_FALLBACK_LENGTH)


def mood(high: float, low: float, calm: float) -> str:
    labels = [
        (f"valence >= {high} AND energy >= {high}", fixed.MOOD_HAPPY_ENERGETIC),
        (f"valence >= {high} AND energy < {calm}", fixed.MOOD_HAPPY_CALM),
        (f"valence < {low} AND energy >= {high}", fixed.MOOD_SAD_ENERGETIC),
        (f"valence < {low} AND energy < {calm}", fixed.MOOD_SAD_CALM),
    ]
    cases = " ".join(f"WHEN {c} THEN '{label}'" for c, label in labels)
    return f"CASE {cases} ELSE '{fixed.MOOD_NEUTRAL}' END"


TRACK_MOOD = mood(fixed.TRACK_MOOD_HIGH, fixed.TRACK_MOOD_LOW, fixed.TRACK_MOOD_LOW)
PLAYLIST_MOOD = mood(fixed.PLAYLIST_MOOD_HIGH, fixed.PLAYLIST_MOOD_LOW, fixed.PLAYLIST_MOOD_HIGH)
MODE_NAME = "CASE WHEN mode = 0 THEN 'Minor' WHEN mode = 1 THEN 'Major' END"

RAW_PLAY = (
    "track_name artist_id artist_name album_id album_name album_release_date duration_ms "
    "popularity explicit track_uri user_id"
)
HISTORY_REST = (
    "played_date track_name artist_name album_name platform ms_played conn_country "
    f"{URI} reason_start reason_end shuffle skipped offline incognito_mode"
)
TRACK_REST = (
    "track_name artist_id artist_name album_id album_name album_release_date "
    "album_release_year duration_ms popularity explicit"
)
FEATURES = (
    "danceability energy key loudness mode speechiness acousticness instrumentalness liveness "
    "valence tempo duration_ms time_signature"
)
LINE_REST = (
    "l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus"
)

PARTS = {
    "numbered_events": """
        SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events""",
    "raw_plays": f"""
        SELECT ts AS played_at, 't' || k AS track_id, 'Track ' || k AS track_name,
            'a' || (k % 20) AS artist_id, 'Artist ' || (k % 20) AS artist_name,
            'l' || (k % 40) AS album_id, 'Album ' || (k % 40) AS album_name,
            CAST(1980 + k % 40 AS VARCHAR) || '-06-01' AS album_release_date,
            CAST(floor(value * 1000) AS INTEGER) AS duration_ms, k AS popularity,
            k % 2 = 0 AS explicit, '{PREFIX}t' || k AS track_uri,
            date_trunc('day', ts) + INTERVAL 1 DAY AS loaded_at, user_id
        FROM numbered_events""",
    "history_once": f"""
        SELECT CASE WHEN event_type = 'purchase' THEN ts ELSE ts - INTERVAL 15 DAY END AS ts,
            event_type AS platform, CAST(floor(value * 1000) AS INTEGER) AS ms_played,
            'C' || (user_id % 5) AS conn_country,
            'Track ' || n AS master_metadata_track_name,
            CASE WHEN n % 20 <> 7 THEN 'Artist ' || (n % 20) END AS master_metadata_album_artist_name,
            'Album ' || (n % 40) AS master_metadata_album_album_name,
            CASE WHEN event_type = 'signup' THEN '{fixed.EPISODE_URI_PREFIX}e' || k
                 WHEN event_type = 'error' AND k % 10 = 0 THEN NULL
                 ELSE '{PREFIX}t' || n END AS {URI},
            CASE WHEN value > 100 THEN 'clickrow' ELSE 'trackdone' END AS reason_start,
            CASE WHEN value > 50 THEN 'trackdone' ELSE 'fwdbtn' END AS reason_end,
            k % 3 = 0 AS shuffle, event_type = 'error' AS skipped, FALSE AS offline,
            event_id AS offline_timestamp, user_id % 7 = 0 AS incognito_mode,
            TIMESTAMP '2024-02-01 00:00:00' AS loaded_at, user_id
        FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN k ELSE k + 20 END AS n
              FROM numbered_events)""",
    "raw_history": """
        SELECT * FROM history_once
        UNION ALL
        SELECT * REPLACE (ms_played + 1 AS ms_played, loaded_at + INTERVAL 1 DAY AS loaded_at)
        FROM history_once WHERE platform = 'view'""",
    "raw_artists": """
        SELECT 'a' || c_nationkey AS artist_id, 'Artist ' || c_nationkey AS artist_name,
            CASE WHEN r_name <> 'ASIA' THEN lower(r_name) || ',' || lower(c_mktsegment) END AS genres,
            CAST(c_custkey % 101 AS INTEGER) AS popularity,
            CAST(floor(c_acctbal) AS INTEGER) AS followers,
            TIMESTAMP '2024-01-01 00:00:00' + to_hours(c_custkey // 10) AS loaded_at
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "raw_playlists": """
        SELECT 'p' || s_suppkey AS playlist_id, s_name AS playlist_name,
            'u' || s_nationkey AS owner_id, s_nationkey = 0 AS is_owner, s_acctbal > 0 AS is_public,
            s_nationkey % 2 = 1 AS is_collaborative, CAST(s_nationkey * 3 AS INTEGER) AS total_tracks,
            CASE WHEN s_acctbal >= 0 THEN 'mix ' || s_suppkey END AS description,
            md5(s_name) AS snapshot_id, TIMESTAMP '2024-02-01 06:00:00' AS extracted_at,
            TIMESTAMP '2024-02-01 06:00:00' AS loaded_at
        FROM supplier""",
    "raw_playlist_tracks": """
        SELECT 'p' || l_suppkey AS playlist_id, 't' || (l_partkey % 120) AS track_id,
            min(l_shipdate) AS added_at, 'u' || min(l_linenumber) AS added_by,
            CAST(min(l_quantity) AS INTEGER) AS position, max(l_shipdate) AS loaded_at
        FROM lineitem GROUP BY 1, 2""",
    "raw_features": """
        SELECT 't' || (vec_id % 120) AS id, m[1] AS danceability, m[2] AS energy, label AS key,
            m[3] AS loudness, CASE WHEN label = 9 THEN 2 ELSE label % 2 END AS mode,
            m[4] AS speechiness, m[5] AS acousticness, m[6] AS instrumentalness, m[7] AS liveness,
            m[8] AS valence, m[9] AS tempo, CAST(vec_id * 100 AS INTEGER) AS duration_ms,
            4 AS time_signature, TIMESTAMP '2024-01-01 00:00:00' + to_hours(vec_id // 120) AS loaded_at
        FROM (SELECT *, [abs(CAST(x AS DOUBLE)) * 5 FOR x IN embedding] AS m FROM embeddings)""",
    "newest_plays": newest("raw_plays", "track_id, played_at", RAW_PLAY),
    "stg_plays": f"""
        SELECT {hashed("track_id", "played_at")} AS play_id, played_at, track_id, track_name,
            artist_id, artist_name, album_id, album_name, album_release_date,
            CAST(left(album_release_date, 4) AS INTEGER) AS album_release_year, duration_ms,
            popularity, explicit, track_uri, {calendar("played_at")}, loaded_at
        FROM newest_plays WHERE duration_ms >= {fixed.MIN_PLAY_MS}""",
    "stg_artists": newest("raw_artists", "artist_id", "artist_name genres popularity followers"),
    "stg_playlists": "SELECT * FROM raw_playlists",
    "stg_playlist_tracks": "SELECT * FROM raw_playlist_tracks",
    "known_ids": """
        SELECT track_id, first(artist_id ORDER BY loaded_at DESC, played_at DESC, artist_id, album_id) AS artist_id,
            first(album_id ORDER BY loaded_at DESC, played_at DESC, artist_id, album_id) AS album_id
        FROM raw_plays GROUP BY track_id""",
    "music": f"""
        SELECT ts AS played_at, CAST(ts AS DATE) AS played_date,
            substr({URI}, {CUT}) AS track_id, master_metadata_track_name AS track_name,
            master_metadata_album_artist_name AS artist_name,
            master_metadata_album_album_name AS album_name, platform, ms_played, conn_country,
            {URI}, reason_start, reason_end, shuffle, skipped, offline, incognito_mode, loaded_at
        FROM raw_history WHERE starts_with({URI}, '{PREFIX}')""",
    "newest_music": newest("music", "track_id, played_at", HISTORY_REST),
    "stg_history": f"""
        SELECT played_at, played_date, platform, ms_played, conn_country, m.track_id, track_name,
            coalesce(i.artist_id, {artist_name_id("artist_name")}) AS artist_id, artist_name,
            coalesce(i.album_id, {album_name_id("album_name")}) AS album_id, album_name,
            {URI}, reason_start, reason_end, shuffle, skipped, offline, incognito_mode, loaded_at
        FROM newest_music m LEFT JOIN known_ids i ON m.track_id = i.track_id""",
    "stg_features": f"""
        SELECT id AS track_id, danceability, energy, key, loudness, mode, {MODE_NAME} AS mode_name,
            speechiness, acousticness, instrumentalness, liveness, valence, tempo, duration_ms,
            time_signature, {TRACK_MOOD} AS mood_category, loaded_at
        FROM ({newest("raw_features", "id", FEATURES)})""",
    "told_plays": """
        SELECT track_id, artist_id, album_id, played_at, played_date, duration_ms FROM stg_plays
        UNION ALL
        SELECT track_id, artist_id, album_id, played_at, played_date, ms_played FROM stg_history""",
    "track_versions": """
        SELECT track_id, track_name, artist_id, artist_name, album_id, album_name,
            album_release_date, album_release_year, duration_ms, popularity, explicit, loaded_at
        FROM stg_plays
        UNION
        SELECT track_id, track_name, artist_id, artist_name, album_id, album_name,
            NULL, NULL, ms_played, NULL, NULL, loaded_at
        FROM stg_history""",
    "track_totals": totals("told_plays", "track_id"),
    "dim_tracks": f"""
        SELECT row_number() OVER (ORDER BY v.track_id NULLS LAST) AS track_key, v.* EXCLUDE (loaded_at),
            coalesce(total_plays, 0) AS total_plays, first_played_at, last_played_at,
            coalesce(days_played, 0) AS days_played
        FROM ({newest("track_versions", "track_id", TRACK_REST)}) v
        LEFT JOIN track_totals t ON v.track_id = t.track_id""",
    "artist_totals": totals("told_plays", "artist_id"),
    "artist_versions": """
        SELECT artist_id, artist_name, genres, popularity, followers FROM stg_artists
        UNION
        SELECT artist_id, artist_name, NULL, NULL, NULL FROM stg_history""",
    "best_artists": f"""
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY artist_id
                ORDER BY genres IS NULL, {ties("artist_name genres popularity followers")}) AS place
            FROM artist_versions) WHERE place = 1""",
    "dim_artists": """
        SELECT row_number() OVER (ORDER BY b.artist_id NULLS LAST) AS artist_key, b.*,
            coalesce(total_plays, 0) AS total_plays,
            coalesce(unique_tracks_played, 0) AS unique_tracks_played,
            coalesce(days_played, 0) AS days_played, first_played_at, last_played_at,
            round(CAST(coalesce(total_listen_time_ms, 0) AS DOUBLE) / 3600000, 2) AS total_listen_time_hours
        FROM best_artists b LEFT JOIN artist_totals t ON b.artist_id = t.artist_id""",
    "album_versions": """
        SELECT album_id, album_name, artist_id, artist_name, loaded_at FROM stg_plays
        UNION
        SELECT album_id, album_name, artist_id, artist_name, loaded_at FROM stg_history""",
    "album_totals": totals("told_plays", "album_id"),
    "dim_albums": f"""
        SELECT row_number() OVER (ORDER BY v.album_id NULLS LAST) AS album_key, v.* EXCLUDE (loaded_at),
            coalesce(total_plays, 0) AS total_plays,
            coalesce(unique_tracks_played, 0) AS unique_tracks_played,
            coalesce(days_played, 0) AS days_played, first_played_at, last_played_at
        FROM ({newest("album_versions", "album_id", "album_name artist_id artist_name")}) v
        LEFT JOIN album_totals t ON v.album_id = t.album_id""",
    "entry_totals": """
        SELECT playlist_id, count(DISTINCT track_id) AS actual_track_count,
            min(added_at) AS first_track_added, max(added_at) AS last_track_added
        FROM stg_playlist_tracks GROUP BY playlist_id""",
    "dim_playlists": """
        SELECT row_number() OVER (ORDER BY p.playlist_id) AS playlist_key,
            md5(p.playlist_id) AS playlist_sk, p.playlist_id, playlist_name, owner_id, is_owner,
            is_public, is_collaborative, total_tracks AS reported_track_count,
            coalesce(actual_track_count, 0) AS actual_track_count, description,
            first_track_added, last_track_added, snapshot_id, extracted_at
        FROM stg_playlists p LEFT JOIN entry_totals t ON p.playlist_id = t.playlist_id""",
    "all_plays": f"""
        SELECT play_id, played_at, played_date, played_year, played_month, played_day,
            played_hour, played_day_of_week, played_day_name, track_id, artist_id, album_id,
            duration_ms, track_uri, loaded_at, popularity AS track_popularity, explicit,
            '{fixed.SOURCE_API}' AS data_source, CAST(NULL AS VARCHAR) AS platform,
            CAST(NULL AS VARCHAR) AS conn_country, CAST(NULL AS VARCHAR) AS reason_start,
            CAST(NULL AS VARCHAR) AS reason_end, CAST(NULL AS BOOLEAN) AS shuffle,
            CAST(NULL AS BOOLEAN) AS skipped
        FROM stg_plays
        UNION ALL BY NAME
        SELECT {hashed("track_id", "played_at")} AS play_id, played_at, {calendar("played_at")},
            track_id, artist_id, album_id, ms_played AS duration_ms, {URI} AS track_uri, loaded_at,
            '{fixed.SOURCE_EXPORT}' AS data_source, platform, conn_country, reason_start,
            reason_end, shuffle, skipped
        FROM stg_history""",
    "memberships": """
        SELECT e.track_id, d.playlist_key, e.added_at
        FROM stg_playlist_tracks e JOIN dim_playlists d ON e.playlist_id = d.playlist_id""",
    "play_playlists": """
        SELECT play_id, list(playlist_key ORDER BY added_at DESC NULLS LAST, playlist_key) AS held,
            count(DISTINCT playlist_key) AS playlist_count
        FROM all_plays JOIN memberships ON all_plays.track_id = memberships.track_id
        GROUP BY play_id""",
    "keyed_plays": """
        SELECT a.*, held, coalesce(playlist_count, 0) AS playlist_count, track_key, artist_key, album_key
        FROM all_plays a LEFT JOIN play_playlists p ON a.play_id = p.play_id
        LEFT JOIN dim_tracks t ON a.track_id = t.track_id
        LEFT JOIN dim_artists r ON a.artist_id = r.artist_id
        LEFT JOIN dim_albums l ON a.album_id = l.album_id""",
    "play_sequence": """
        SELECT *, lag(track_key) OVER w AS prev_track_key, lag(artist_key) OVER w AS prev_artist_key,
            lag(played_at) OVER w AS prev_at, lag(played_date) OVER w AS prev_date,
            lag(track_id) OVER w AS prev_track_id
        FROM keyed_plays WINDOW w AS (ORDER BY played_at, play_id, data_source)""",
    "play_marks": f"""
        SELECT *, date_diff('microsecond', prev_at, played_at) / 1e6 / 60 AS minutes_since_prev_play,
            CASE WHEN prev_at IS NULL OR date_diff('microsecond', prev_at, played_at) > {fixed.SESSION_GAP_MINUTES} * 60000000
                OR played_date <> prev_date THEN 1 ELSE 0 END AS is_new_session,
            coalesce(track_id = prev_track_id, FALSE) AS is_repeat,
            CASE WHEN prev_track_id IS NULL OR track_id <> prev_track_id THEN 1 ELSE 0 END AS starts_run
        FROM play_sequence""",
    "play_runs": """
        SELECT *, CAST(sum(is_new_session) OVER w AS BIGINT) AS session_number,
            sum(starts_run) OVER w AS run
        FROM play_marks WINDOW w AS (ORDER BY played_at, play_id, data_source ROWS UNBOUNDED PRECEDING)""",
    "fct_history": f"""
        SELECT play_id, played_at, played_at - INTERVAL {fixed.LOCAL_OFFSET_HOURS} HOUR AS played_at_cst,
            played_date, played_year, played_month, played_day, played_hour AS played_hour_utc,
            CAST(hour(played_at - INTERVAL {fixed.LOCAL_OFFSET_HOURS} HOUR) AS BIGINT) AS played_hour_cst,
            played_day_of_week, played_day_name,
            strftime(played_at - INTERVAL {fixed.LOCAL_OFFSET_HOURS} HOUR, '%A') AS played_day_name_cst,
            track_key, artist_key, album_key, held[1] AS playlist_key_1, held[2] AS playlist_key_2,
            held[3] AS playlist_key_3, held[4] AS playlist_key_4, held[5] AS playlist_key_5,
            playlist_count, duration_ms, track_popularity, explicit, track_uri, prev_track_key,
            prev_artist_key, minutes_since_prev_play, is_new_session, session_number, is_repeat,
            row_number() OVER (PARTITION BY run ORDER BY played_at, play_id, data_source) - 1 AS repeat_sequence,
            data_source, platform, conn_country, shuffle, skipped, reason_start, reason_end, loaded_at
        FROM play_runs""",
    "top_artists_daily": """
        SELECT played_date, f.artist_key, artist_id, artist_name, genres AS artist_genres,
            count(*) AS play_count, count(DISTINCT f.track_key) AS unique_tracks_played,
            CAST(sum(duration_ms) AS BIGINT) AS total_listen_time_ms,
            round(CAST(sum(duration_ms) AS DOUBLE) / 60000, 2) AS total_listen_time_minutes,
            avg(track_popularity) AS avg_track_popularity, max(followers) AS artist_followers
        FROM fct_history f LEFT JOIN dim_artists d ON f.artist_key = d.artist_key
        GROUP BY played_date, f.artist_key, artist_id, artist_name, genres""",
    "session_days": """
        SELECT played_date, session_number, count(*) AS songs,
            CAST(round(CAST(sum(duration_ms) AS DOUBLE) / 60000, 2) AS DECIMAL(18, 2)) AS minutes,
            min(played_at) AS opened, max(played_at) AS closed
        FROM fct_history GROUP BY played_date, session_number""",
    "entry_plays": """
        SELECT e.playlist_id, e.track_id, e.added_at, p.plays, p.first_played, p.last_played, s.duration_ms
        FROM stg_playlist_tracks e
        LEFT JOIN (SELECT track_id, count(*) AS plays, min(played_at) AS first_played,
                   max(played_at) AS last_played FROM stg_plays GROUP BY track_id) p ON e.track_id = p.track_id
        LEFT JOIN stg_plays s ON e.track_id = s.track_id""",
    "playlist_analysis": """
        SELECT d.playlist_id, playlist_name, is_owner, is_public, is_collaborative,
            count(DISTINCT track_id) AS total_tracks,
            count(DISTINCT track_id) FILTER (plays > 0) AS played_tracks,
            count(DISTINCT track_id) FILTER (plays IS NULL) AS unplayed_tracks,
            round(100.0 * count(DISTINCT track_id) FILTER (plays > 0) / CAST(nullif(count(DISTINCT track_id), 0) AS DOUBLE), 1) AS played_percentage,
            CAST(sum(coalesce(plays, 0)) AS BIGINT) AS total_plays,
            round(avg(coalesce(plays, 0)), 2) AS avg_plays_per_track, max(plays) AS max_plays,
            round(CAST(sum(duration_ms) AS DOUBLE) / 1000 / 60, 2) AS total_duration_minutes,
            round(avg(duration_ms) / 1000 / 60, 2) AS avg_track_duration_minutes,
            min(added_at) AS first_track_added, max(added_at) AS last_track_added,
            min(first_played) AS first_play_date, max(last_played) AS last_play_date
        FROM entry_plays e JOIN dim_playlists d ON e.playlist_id = d.playlist_id
        GROUP BY d.playlist_id, playlist_name, is_owner, is_public, is_collaborative""",
    "names_per_track": """
        SELECT track_id, string_agg(DISTINCT playlist_name, ', ' ORDER BY playlist_name) AS playlists_containing_track,
            count(DISTINCT e.playlist_id) AS playlist_count
        FROM stg_playlist_tracks e LEFT JOIN stg_playlists p ON e.playlist_id = p.playlist_id
        GROUP BY track_id""",
    "fct_history_wide": """
        SELECT s.play_id, played_at, played_date, played_year, played_month, played_day, played_hour,
            played_day_of_week, played_day_name, s.track_id, track_name, s.duration_ms,
            s.popularity AS track_popularity, explicit, track_uri, s.artist_id, s.artist_name,
            genres AS artist_genres, a.popularity AS artist_popularity, followers AS artist_followers,
            album_id, album_name, album_release_date, album_release_year, playlists_containing_track,
            coalesce(playlist_count, 0) AS playlist_count, danceability, energy, key, loudness, mode,
            mode_name, speechiness, acousticness, instrumentalness, liveness, valence, tempo,
            time_signature, mood_category, s.loaded_at
        FROM stg_plays s LEFT JOIN stg_features f ON s.track_id = f.track_id
        LEFT JOIN stg_artists a ON s.artist_id = a.artist_id
        LEFT JOIN names_per_track n ON s.track_id = n.track_id""",
    "event_sequence": """
        SELECT *, lag(ts) OVER w AS prev_ts, lag(event_type) OVER w AS prev_type
        FROM events WINDOW w AS (ORDER BY ts, event_id)""",
    "event_sequence_per_user": """
        SELECT *, lag(ts) OVER w AS prev_ts FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "user_plays": f"""
        SELECT *, user_id || '/' || coalesce(track_id, '-') AS play_id FROM (
            SELECT user_id, played_at, track_id FROM raw_plays
            UNION SELECT user_id, ts, string_split({URI}, ':')[-1] FROM raw_history)""",
    "user_sequence": """
        SELECT *, lag(played_at) OVER w AS prev_at, lag(track_id) OVER w AS prev_track_id
        FROM user_plays WINDOW w AS (PARTITION BY user_id ORDER BY played_at, play_id)""",
    "user_runs": f"""
        SELECT *, CAST(sum(CASE WHEN prev_at IS NULL OR date_diff('microsecond', prev_at, played_at) > {fixed.SESSION_GAP_MINUTES} * 60000000
                OR CAST(played_at AS DATE) <> CAST(prev_at AS DATE) THEN 1 ELSE 0 END) OVER w AS BIGINT) AS session_number,
            sum(CASE WHEN prev_track_id IS NULL OR track_id <> prev_track_id THEN 1 ELSE 0 END) OVER w AS run
        FROM user_sequence
        WINDOW w AS (PARTITION BY user_id ORDER BY played_at, play_id ROWS UNBOUNDED PRECEDING)""",
    "first_lines": newest("(SELECT * FROM lineitem WHERE l_linestatus = 'O')", "l_orderkey, l_linenumber", LINE_REST, "l_shipdate"),
    "second_lines": f"""
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate ASC NULLS LAST, {ties(LINE_REST)}) AS place
            FROM lineitem) WHERE place = 1""",
    "old_balances": """
        SELECT c_custkey, c_acctbal AS balance, c_mktsegment AS note,
            TIMESTAMP '1990-01-01 00:00:00' AS loaded_at FROM customer""",
    "order_balances": """
        SELECT o_custkey + 100 AS c_custkey, o_totalprice AS balance, o_orderpriority AS note,
            o_orderdate AS loaded_at FROM orders""",
    "new_balances": newest("order_balances", "c_custkey", "balance note"),
    "merged_balances": """
        SELECT * FROM new_balances
        UNION ALL SELECT * FROM old_balances o
        WHERE NOT EXISTS (SELECT 1 FROM new_balances n WHERE n.c_custkey = o.c_custkey)""",
    "landed_plays": """
        SELECT * EXCLUDE (user_id, loaded_at), TIMESTAMP '2024-03-01 00:00:00' AS loaded_at FROM raw_plays""",
    "exported": f"""
        SELECT DISTINCT ts AS played_at, string_split({URI}, ':')[-1] AS track_id,
            master_metadata_track_name AS track_name, master_metadata_album_artist_name AS artist_name,
            master_metadata_album_album_name AS album_name, ms_played AS duration_ms, {URI} AS track_uri
        FROM raw_history WHERE ms_played >= {fixed.MIN_PLAY_MS}""",
    "page_plays": f"""
        SELECT ts AS played_at, 't' || k AS track_id, 'Track ' || k AS track_name,
            'a' || (k % 20) AS artist_id, 'Artist ' || (k % 20) AS artist_name,
            'l' || (k % 40) AS album_id, 'Album ' || (k % 40) AS album_name,
            '1999-01' AS album_release_date, CAST(floor(value * 1000) AS INTEGER) AS duration_ms,
            k AS popularity, k % 2 = 0 AS explicit, '{PREFIX}t' || k AS track_uri
        FROM numbered_events WHERE event_type NOT IN ('error', 'signup')""",
    "good_page_plays": f"""
        SELECT ts AS played_at, 't' || k AS track_id, 'Track ' || k AS track_name,
            'a' || (k % 20) AS artist_id, 'Artist ' || (k % 20) AS artist_name,
            'l' || (k % 40) AS album_id, 'Album ' || (k % 40) AS album_name,
            '1999-01' AS album_release_date, CAST(floor(value * 1000) AS INTEGER) AS duration_ms,
            k AS popularity, k % 2 = 0 AS explicit, '{PREFIX}t' || k AS track_uri
        FROM numbered_events WHERE event_type NOT IN ('error', 'signup')
            AND event_id // 50 % 7 <> 0 AND event_id // 50 % 11 <> 3""",
    "artist_records": """
        SELECT o_custkey, o_orderkey % 3 AS b, max(o_orderkey) AS k,
            max_by(o_orderpriority, o_orderkey) AS priority, max_by(o_totalprice, o_orderkey) AS price
        FROM orders GROUP BY 1, 2""",
    "last_artist_records": """
        SELECT 'a' || o_custkey AS artist_id, 'Artist ' || o_custkey AS artist_name,
            lower(max_by(priority, b)) AS genres, CAST(max_by(k, b) % 101 AS INTEGER) AS popularity,
            CAST(floor(max_by(price, b)) AS INTEGER) AS followers, TIMESTAMP '2024-03-01 00:00:00' AS loaded_at
        FROM artist_records GROUP BY o_custkey""",
    "order_lines": """
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate,
            l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS place FROM lineitem""",
    "bad_ids": f"""
        SELECT artist_id, album_id FROM stg_history
        WHERE NOT (artist_id LIKE '{fixed.ARTIST_FALLBACK_PREFIX}%' OR length(artist_id) = {fixed.NATIVE_ID_LENGTH})
            OR NOT (album_id LIKE '{fixed.ALBUM_FALLBACK_PREFIX}%' OR length(album_id) = {fixed.NATIVE_ID_LENGTH})""",
}

WORD = re.compile(r"[a-z_]+")


def with_parts(body: str) -> str:
    """``body`` with the parts it mentions, directly or not, as a WITH clause."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(WORD.findall(text)):
            if name in PARTS and name not in needed:
                visit(PARTS[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body
    clauses = ",\n".join(f"{n} AS ({PARTS[n]})" for n in needed)
    return f"WITH {clauses}\n{body}"


MEASURES = "danceability energy valence tempo acousticness instrumentalness speechiness liveness loudness"


def averages(names: str) -> str:
    return ", ".join(f"round(avg({m}), 6) AS avg_{m}" for m in names.split())


def count_where(condition: str) -> str:
    return f"count(*) FILTER ({condition})"


def failing(table: str, column: str, kind: str, condition: str) -> str:
    """A check row for rows of ``table`` that fulfil ``condition``."""
    return (
        f"SELECT '{table}' AS table_name, '{kind}:{column}' AS check_name, "
        f"count(*) FILTER ({condition}) AS failures FROM {table}"
    )


# What the report has to check, written out here so that a check missing there shows up.
# table: (unique, not_null, ranges, accepted, parents)
EXPECTED_CHECKS = {
    "stg_plays": ("play_id", "play_id played_at track_id duration_ms", {"popularity": (0, 100)}, {}, {}),
    "stg_artists": ("artist_id", "artist_id", {"popularity": (0, 100), "followers": (0, None)}, {}, {}),
    "stg_playlists": ("playlist_id", "playlist_id", {}, {}, {}),
    "stg_playlist_tracks": ("", "playlist_id track_id", {}, {}, {}),
    "stg_history": (
        "", "played_at platform ms_played conn_country track_name artist_name album_name",
        {"ms_played": (0, 86_400_000)}, {}, {},
    ),
    "fct_history": (
        "play_id", "play_id played_at track_key artist_key album_key data_source",
        {
            "played_hour_utc": (0, 23), "played_hour_cst": (0, 23), "played_day_of_week": (0, 6),
            "track_popularity": (0, 100),
        },
        {"data_source": ("api", "extended_history")},
        {
            "track_key": ("dim_tracks", "track_key"), "artist_key": ("dim_artists", "artist_key"),
            "album_key": ("dim_albums", "album_key"),
        },
    ),
    "dim_tracks": ("track_id", "track_id", {"popularity": (0, 100), "total_plays": (0, None)}, {}, {}),
    "dim_artists": (
        "artist_key artist_id", "artist_key artist_id artist_name",
        {"popularity": (0, 100), "followers": (0, None), "total_plays": (0, None)}, {}, {},
    ),
    "dim_albums": (
        "album_key album_id", "album_key album_id album_name artist_id artist_name", {"total_plays": (0, None)}, {}, {},
    ),
    "dim_playlists": (
        "playlist_key playlist_sk playlist_id", "playlist_key playlist_sk playlist_id playlist_name", {}, {}, {},
    ),
}


def declared_checks() -> str:
    """Report rows of the declared checks, one plain query each."""
    rows = []
    for table, (unique, not_null, ranges, accepted, parents) in EXPECTED_CHECKS.items():
        for c in not_null.split():
            rows.append(failing(table, c, "not_null", f"{c} IS NULL"))
        for c, (low, high) in ranges.items():
            upper = "" if high is None else f" OR {c} > {high}"
            rows.append(failing(table, c, "range", f"{c} < {low}{upper}"))
        for c, values in accepted.items():
            listed = ", ".join(f"'{v}'" for v in values)
            rows.append(failing(table, c, "accepted", f"{c} NOT IN ({listed})"))
        for c in unique.split():
            rows.append(
                f"SELECT '{table}', 'unique:{c}', count(*) FROM "
                f"(SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
            )
        for c, (parent, key) in parents.items():
            rows.append(
                f"SELECT '{table}', 'parent:{c}', count(*) FROM {table} WHERE {c} IS NOT NULL "
                f"AND {c} NOT IN (SELECT {key} FROM {parent})"
            )
    special = {
        "counts_match": COUNTS_DIFFER,
        "ids_are_valid": "SELECT * FROM bad_ids",
        "no_duplicate_plays": REPEATED,
        "positive_play_count": "SELECT * FROM top_artists_daily WHERE play_count <= 0",
        "sessions_are_sequential": SESSION_GAPS,
        "valid_duration": OUT_OF_BOUNDS,
    }
    for name, sql in special.items():
        rows.append(f"SELECT 'special', '{name}', count(*) FROM ({sql})")
    return "\nUNION ALL ".join(rows)


COUNTS_DIFFER = """
    SELECT f.artist_key, fact_play_count, total_plays AS dim_play_count,
        abs(fact_play_count - total_plays) AS difference
    FROM (SELECT artist_key, count(*) AS fact_play_count FROM fct_history GROUP BY artist_key) f
    JOIN dim_artists d ON f.artist_key = d.artist_key WHERE fact_play_count <> total_plays"""
REPEATED = """
    SELECT track_key, played_at, count(*) AS play_count FROM fct_history
    GROUP BY track_key, played_at HAVING count(*) > 1"""
SESSION_GAPS = """
    SELECT session_number, prev_session, session_number - prev_session AS gap FROM (
        SELECT session_number, lag(session_number) OVER (ORDER BY session_number) AS prev_session
        FROM (SELECT DISTINCT session_number FROM fct_history WHERE session_number IS NOT NULL))
    WHERE session_number - prev_session > 1"""
OUT_OF_BOUNDS = f"""
    SELECT play_id, track_key, duration_ms FROM fct_history
    WHERE duration_ms < 0 OR duration_ms > {fixed.MAX_PLAY_MS}"""


# Raw table: hours after which it is late, and stale.
EXPECTED_FRESHNESS = {
    "raw_plays": (6, 24),
    "raw_artists": (24, 48),
    "raw_playlists": (24, 48),
    "raw_playlist_tracks": (24, 48),
    "raw_history": (None, None),
}


def freshness_rows() -> str:
    rows = []
    for table, (warn, error) in EXPECTED_FRESHNESS.items():
        status = "'pass'"
        if warn is not None:
            status = f"CASE WHEN h > {error} THEN 'error' WHEN h > {warn} THEN 'warn' ELSE 'pass' END"
        rows.append(
            f"SELECT '{table}' AS table_name, newest, round(h, 4) AS age_hours, {status} AS status "
            f"FROM (SELECT newest, date_diff('microsecond', newest, TIMESTAMP '2024-02-02 12:00:00') / 3.6e9 AS h "
            f"FROM (SELECT max(loaded_at) AS newest FROM {table}))"
        )
    return " UNION ALL ".join(rows)


#: Queries that reach the rows of another one in steps.
SAME_ROWS = {
    "sessionize_late": "sessionize", "sessionize_per_user_late": "sessionize_per_user", "repeat_runs_late": "repeat_runs",
    "refreshed_top_artists": "top_artists_daily", "refreshed_top_tracks": "top_tracks_daily",
    "refreshed_patterns": "listening_patterns_hourly", "refreshed_sessions": "consecutive_listening_daily",
}


def bodies() -> dict[str, str]:
    out = {name: f"SELECT * FROM {name}" for name in (
        "stg_plays stg_artists stg_playlists stg_playlist_tracks stg_history dim_tracks dim_artists "
        "dim_albums dim_playlists fct_history top_artists_daily playlist_analysis fct_history_wide"
    ).split()}
    out.update(
        ingest_csv="SELECT * FROM landed_plays",
        ingest_latest_file="""
            SELECT * FROM landed_plays WHERE CAST(played_at AS DATE) =
                (SELECT max(CAST(played_at AS DATE)) FROM landed_plays)""",
        ingest_all_files="SELECT * FROM landed_plays",
        ingest_json_export=f"""
            SELECT ts, platform, ms_played, conn_country, NULL::VARCHAR AS ip_addr, master_metadata_track_name,
                master_metadata_album_artist_name, master_metadata_album_album_name, {URI},
                NULL::VARCHAR AS episode_name, NULL::VARCHAR AS episode_show_name,
                NULL::VARCHAR AS spotify_episode_uri, NULL::VARCHAR AS audiobook_title,
                NULL::VARCHAR AS audiobook_uri, NULL::VARCHAR AS audiobook_chapter_uri,
                NULL::VARCHAR AS audiobook_chapter_title, reason_start, reason_end, shuffle, skipped, offline,
                offline_timestamp, incognito_mode, TIMESTAMP '2024-03-01 00:00:00' AS loaded_at
            FROM raw_history WHERE {URI} LIKE '{PREFIX}%'""",
        ingest_exported_plays=f"""
            SELECT * EXCLUDE (place), TIMESTAMP '2024-03-01 00:00:00' AS loaded_at FROM (
                SELECT *, row_number() OVER (PARTITION BY track_id, played_at
                    ORDER BY {ties("track_name artist_name album_name duration_ms track_uri")}) AS place
                FROM exported WHERE track_id IS NOT NULL) WHERE place = 1""",
        ingest_csv_quoted="""
            SELECT 'p' || doc_id AS playlist_id, 'My ""best"", ' || source AS playlist_name, lang AS owner_id,
                doc_id % 2 = 0 AS is_owner, TRUE AS is_public, FALSE AS is_collaborative,
                CAST(n_chars AS INTEGER) AS total_tracks, text AS description, NULL::VARCHAR AS snapshot_id,
                TIMESTAMP '2024-01-01 00:00:00' AS extracted_at, TIMESTAMP '2024-03-01 00:00:00' AS loaded_at
            FROM documents""",
        ingest_export_processed="SELECT * FROM exported ORDER BY played_at, track_uri, duration_ms",
        sink_partitioned_csv="""
            SELECT CAST(year(played_at) AS INTEGER) AS year, CAST(month(played_at) AS INTEGER) AS month,
                CAST(day(played_at) AS INTEGER) AS day, count(*) AS n_rows,
                CAST(sum(duration_ms) AS BIGINT) AS total_ms
            FROM landed_plays GROUP BY 1, 2, 3""",
        sink_csv="""
            SELECT track_id, track_uri, track_name, count(*) AS n_rows,
                CAST(sum(duration_ms) AS BIGINT) AS total_ms FROM exported GROUP BY 1, 2, 3""",
        ingest_insert_ignore="""
            SELECT * FROM first_lines UNION ALL BY NAME SELECT s.* FROM second_lines s
            WHERE NOT EXISTS (SELECT 1 FROM first_lines f
                WHERE f.l_orderkey = s.l_orderkey AND f.l_linenumber = s.l_linenumber)""",
        ingest_upsert="SELECT * FROM merged_balances",
        ingest_once="""
            SELECT o_orderstatus, TRUE AS first_load, FALSE AS second_load, count(*) AS n_rows
            FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderstatus""",
        ingest_load_metrics="""
            SELECT 'lines' AS table_name, o AS rows_before, o + n AS rows_after, n AS rows_added,
                CAST(0 AS BIGINT) AS rows_updated
            FROM (SELECT (SELECT count(*) FROM first_lines) AS o,
                (SELECT count(*) FROM second_lines s ANTI JOIN first_lines f
                 ON f.l_orderkey = s.l_orderkey AND f.l_linenumber = s.l_linenumber) AS n)
            UNION ALL
            SELECT 'balances', (SELECT count(*) FROM old_balances), (SELECT count(*) FROM merged_balances),
                (SELECT count(*) FROM new_balances ANTI JOIN old_balances USING (c_custkey)),
                (SELECT count(*) FROM new_balances SEMI JOIN old_balances USING (c_custkey))""",
        sink_layers="""
            SELECT 'staging' AS layer, count(*) AS n_rows, min(artist_id) AS low_id FROM stg_artists
            UNION ALL SELECT 'marts', count(*), min(artist_id) FROM dim_artists
            UNION ALL SELECT 'returned', count(*), min(artist_id) FROM stg_artists""",
        flatten_plays="SELECT * FROM page_plays",
        flatten_artists="""
            SELECT 'a' || c_custkey AS artist_id, c_name AS artist_name,
                CASE WHEN c_custkey % 3 <> 0 THEN lower(c_mktsegment) || ',pop' ELSE '' END AS genres,
                CAST(c_custkey % 101 AS INTEGER) AS popularity, CAST(floor(c_acctbal) AS INTEGER) AS followers
            FROM customer WHERE c_nationkey > 0""",
        flatten_playlists="""
            SELECT 'p' || s_suppkey AS playlist_id, s_name AS playlist_name, 'u' || s_nationkey AS owner_id,
                s_nationkey = 7 AS is_owner, s_suppkey % 2 = 0 AS is_public,
                s_suppkey % 3 = 0 AS is_collaborative, s_nationkey * 2 AS total_tracks,
                CASE WHEN s_acctbal > 0 THEN 'mix ' || s_suppkey ELSE '' END AS description,
                md5(s_name) AS snapshot_id, TIMESTAMP '2024-03-01 00:00:00' AS extracted_at
            FROM supplier""",
        flatten_playlist_tracks="""
            SELECT 'p' || (l_orderkey // 4) AS playlist_id, 't' || l_partkey AS track_id,
                l_shipdate AS added_at, CASE WHEN l_quantity > 10 THEN 'u' || l_suppkey END AS added_by,
                CAST(l_orderkey % 4 * 100 + place AS INTEGER) AS position
            FROM order_lines WHERE l_quantity > 5""",
        distinct_artist_ids="SELECT DISTINCT artist_id FROM page_plays",
        filter_min_duration="""
            SELECT track_id, played_at, duration_ms FROM newest_plays WHERE duration_ms >= 60000""",
        filter_music_only=f"""
            SELECT {URI} AS uri, count(*) AS n_rows FROM raw_history
            WHERE {URI} IS NOT NULL AND {URI} LIKE '{PREFIX}%' GROUP BY 1""",
        filter_not_null_key="""
            SELECT master_metadata_album_artist_name AS artist_name, count(*) AS n_rows,
                CAST(sum(ms_played) AS BIGINT) AS total_ms
            FROM raw_history WHERE master_metadata_album_artist_name IS NOT NULL GROUP BY 1""",
        bucket_mood=f"""
            SELECT {TRACK_MOOD} AS track_mood, {PLAYLIST_MOOD} AS playlist_mood,
                {MODE_NAME} AS mode_name, count(*) AS n_rows
            FROM raw_features GROUP BY 1, 2, 3""",
        project_hidden="""
            SELECT artist_id, round(CAST(sum(duration_ms) AS DOUBLE) / 3600000, 2) AS total_listen_time_hours
            FROM stg_plays GROUP BY artist_id""",
        join_dim_stats=f"""
            SELECT a.artist_id, artist_name, coalesce(total_plays, 0) AS total_plays,
                coalesce(unique_tracks_played, 0) AS unique_tracks_played,
                coalesce(days_played, 0) AS days_played, first_played_at, last_played_at,
                coalesce(total_listen_time_ms, 0) AS total_listen_time_ms
            FROM stg_artists a LEFT JOIN ({totals("stg_plays", "artist_id")}) t ON a.artist_id = t.artist_id""",
        join_plays_playlists="""
            SELECT playlist_key, count(*) AS plays, count(DISTINCT m.track_id) AS tracks
            FROM stg_plays s JOIN memberships m ON s.track_id = m.track_id GROUP BY playlist_key""",
        join_star_keys="SELECT play_id, data_source, track_key, artist_key, album_key FROM keyed_plays",
        join_fact_dim_attrs="""
            SELECT CAST(l_shipdate AS DATE) AS ship_date, l_suppkey, s_name, s_nationkey,
                count(*) AS n_lines, sum(l_quantity) AS quantity
            FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3, 4""",
        join_enrich_fallback="""
            SELECT track_id, artist_id, album_id, count(*) AS n_rows FROM stg_history GROUP BY 1, 2, 3""",
        join_fanout="""
            SELECT playlist_id, total_plays, avg_plays_per_track, total_duration_minutes
            FROM playlist_analysis""",
        join_fanout_exact="""
            SELECT e.playlist_id, CAST(sum(coalesce(n, 0)) AS BIGINT) AS total_plays,
                round(avg(coalesce(n, 0)), 2) AS avg_plays_per_track,
                round(CAST(sum(ms) AS DOUBLE) / 1000 / 60, 2) AS total_duration_minutes
            FROM stg_playlist_tracks e LEFT JOIN (
                SELECT track_id, count(*) AS n, sum(duration_ms) AS ms FROM stg_plays GROUP BY track_id) p
            ON e.track_id = p.track_id GROUP BY e.playlist_id""",
        join_reconcile="""
            SELECT l_orderkey, count(*) AS fact_play_count, o_custkey % 7 AS dim_play_count,
                abs(count(*) - o_custkey % 7) AS difference
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            GROUP BY l_orderkey, o_custkey HAVING count(*) <> o_custkey % 7""",
        join_wide_denorm="""
            SELECT track_id, artist_id, mood_category, playlist_count, count(*) AS n_plays,
                max(artist_followers) AS artist_followers
            FROM fct_history_wide GROUP BY 1, 2, 3, 4""",
        agg_entity_stats=totals("stg_plays", "album_id"),
        agg_playlist_stats="SELECT * FROM entry_totals",
        agg_pivot_topk="""
            SELECT track_id, held[1] AS playlist_key_1, held[2] AS playlist_key_2, held[3] AS playlist_key_3,
                held[4] AS playlist_key_4, held[5] AS playlist_key_5, playlist_count
            FROM (SELECT track_id, list(playlist_key ORDER BY added_at DESC, playlist_key) AS held,
                count(DISTINCT playlist_key) AS playlist_count FROM memberships GROUP BY track_id)""",
        agg_track_plays="""
            SELECT track_id, count(*) AS play_count, min(played_at) AS first_played,
                max(played_at) AS last_played FROM stg_plays GROUP BY track_id""",
        agg_having_dups="""
            SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
            GROUP BY 1, 2 HAVING count(*) > 1""",
        audio_features_daily=f"""
            SELECT played_date,
                {count_where(f"mood_category = '{fixed.MOOD_HAPPY_ENERGETIC}'")} AS happy_energetic_count,
                {count_where(f"mood_category = '{fixed.MOOD_HAPPY_CALM}'")} AS happy_calm_count,
                {count_where(f"mood_category = '{fixed.MOOD_SAD_ENERGETIC}'")} AS sad_energetic_count,
                {count_where(f"mood_category = '{fixed.MOOD_SAD_CALM}'")} AS sad_calm_count,
                {count_where(f"mood_category = '{fixed.MOOD_NEUTRAL}'")} AS neutral_count,
                {averages(MEASURES)}, min(energy) AS min_energy, max(energy) AS max_energy,
                min(valence) AS min_valence, max(valence) AS max_valence, min(tempo) AS min_tempo,
                max(tempo) AS max_tempo, {count_where("mode_name = 'Major'")} AS major_key_count,
                {count_where("mode_name = 'Minor'")} AS minor_key_count,
                {count_where("explicit")} AS explicit_tracks_count,
                round(CAST(100 * {count_where("explicit")} AS DOUBLE) / count(*), 2) AS explicit_percentage
            FROM fct_history_wide GROUP BY played_date""",
        agg_mode="""
            SELECT played_date, played_hour, mode() WITHIN GROUP (ORDER BY mood_category) AS most_common_mood
            FROM fct_history_wide GROUP BY 1, 2""",
        agg_string_distinct="SELECT * FROM names_per_track",
        agg_hourly_features=f"""
            SELECT played_date, played_hour, played_day_of_week, played_day_name, count(*) AS play_count,
                count(DISTINCT track_id) AS unique_tracks, count(DISTINCT artist_id) AS unique_artists,
                CAST(sum(duration_ms) AS BIGINT) AS total_listen_time_ms,
                round(CAST(sum(duration_ms) AS DOUBLE) / 60000, 2) AS total_listen_time_minutes,
                {averages(MEASURES.replace(" liveness", ""))},
                mode() WITHIN GROUP (ORDER BY mood_category) AS most_common_mood
            FROM fct_history_wide GROUP BY 1, 2, 3, 4""",
        dedup_latest=newest("lineitem", "l_orderkey, l_linenumber", LINE_REST, "l_shipdate"),
        qualify_latest_per_entity="""
            SELECT o.*, c_name, c_mktsegment FROM orders o LEFT JOIN customer ON o_custkey = c_custkey
            QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey,
                o_orderstatus, o_totalprice, o_orderpriority) = 1""",
        qualify_prefer_source=f"""
            SELECT artist_id, artist_name, genres, popularity, followers FROM raw_artists
            QUALIFY row_number() OVER (PARTITION BY artist_name ORDER BY genres IS NULL,
                {ties("artist_id genres popularity followers")}) = 1""",
        first_value_lookup="SELECT * FROM known_ids",
        dense_surrogate_key="""
            SELECT row_number() OVER (ORDER BY o_orderpriority, o_orderdate, o_orderkey) AS order_number,
                o_orderpriority, o_orderdate, o_orderkey FROM orders""",
        rank_playlists_per_play="""
            SELECT track_id, playlist_key, playlist_rank FROM (
                SELECT *, row_number() OVER (PARTITION BY track_id
                    ORDER BY added_at DESC, playlist_key) AS playlist_rank FROM memberships)
            WHERE playlist_rank <= 5""",
        lag_prev_play="SELECT event_id, prev_type AS prev_track_id FROM event_sequence",
        gap_minutes="""
            SELECT event_id, round(date_diff('microsecond', prev_ts, ts) / 1e6 / 60, 6) AS minutes
            FROM event_sequence""",
        sessionize="""
            SELECT event_id, opens AS is_new_session,
                CAST(sum(opens) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_number
            FROM (SELECT *, CASE WHEN prev_ts IS NULL OR ts - prev_ts > INTERVAL 5 MINUTE
                OR CAST(ts AS DATE) <> CAST(prev_ts AS DATE) THEN 1 ELSE 0 END AS opens FROM event_sequence)""",
        sessionize_per_user="""
            SELECT event_id, user_id, opens AS is_new_session, CAST(sum(opens) OVER (PARTITION BY user_id
                ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_number
            FROM (SELECT *, CASE WHEN prev_ts IS NULL OR ts - prev_ts > INTERVAL 240 MINUTE
                OR CAST(ts AS DATE) <> CAST(prev_ts AS DATE) THEN 1 ELSE 0 END AS opens
                FROM event_sequence_per_user)""",
        repeat_runs="""
            SELECT event_id, is_repeat, row_number() OVER (PARTITION BY run ORDER BY ts, event_id) - 1 AS repeat_sequence
            FROM (SELECT *, coalesce(event_type = prev_type, FALSE) AS is_repeat,
                sum(CASE WHEN event_type = prev_type THEN 0 ELSE 1 END)
                    OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM event_sequence)""",
        repeat_runs_per_user="""
            SELECT play_id, played_at, prev_track_id, session_number,
                coalesce(track_id = prev_track_id, FALSE) AS is_repeat,
                row_number() OVER (PARTITION BY user_id, run ORDER BY played_at, play_id) - 1 AS repeat_sequence
            FROM user_runs""",
        first_date_over_groups="""
            SELECT played_date, track_id, count(*) AS play_count,
                min(played_date) OVER (PARTITION BY track_id) AS first_played_date
            FROM stg_plays GROUP BY played_date, track_id""",
        lag_over_distinct="""
            SELECT l_orderkey, prev_session, l_orderkey - prev_session AS gap FROM (
                SELECT l_orderkey, lag(l_orderkey) OVER (ORDER BY l_orderkey) AS prev_session
                FROM (SELECT DISTINCT l_orderkey FROM lineitem))
            WHERE l_orderkey - prev_session > 1""",
        sort_daily_rank="""
            SELECT played_date, track_id, count(*) AS play_count FROM stg_plays GROUP BY 1, 2
            ORDER BY played_date DESC, play_count DESC, track_id""",
        sort_multi="""
            SELECT playlist_id, total_plays, total_tracks FROM playlist_analysis
            ORDER BY total_plays DESC, total_tracks DESC, playlist_id""",
        limit_n="SELECT DISTINCT * FROM bad_ids ORDER BY artist_id, album_id LIMIT 10",
        topk_per_group="""
            SELECT l_partkey, l_shipdate, l_orderkey, l_linenumber, l_extendedprice, place, n_lines FROM (
                SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC,
                    l_orderkey, l_linenumber, l_extendedprice) AS place,
                    count(*) OVER (PARTITION BY l_partkey) AS n_lines FROM lineitem) WHERE place <= 5""",
        sort_by_time="SELECT played_at, track_id, duration_ms FROM raw_plays ORDER BY 1, 2",
        union_all_sources="""
            SELECT data_source, track_id, platform, explicit, count(*) AS n_plays,
                CAST(sum(duration_ms) AS BIGINT) AS total_ms FROM all_plays GROUP BY 1, 2, 3, 4""",
        union_distinct="""
            SELECT album_id, album_name, artist_id, artist_name FROM stg_plays
            UNION SELECT album_id, album_name, artist_id, artist_name FROM stg_history""",
        distinct_rows="SELECT DISTINCT artist_id, artist_name FROM stg_history",
        expr_calendar=f"""
            SELECT event_id, {calendar("ts")}, ts - INTERVAL 6 HOUR AS played_at_cst,
                CAST(hour(ts - INTERVAL 6 HOUR) AS BIGINT) AS played_hour_cst,
                strftime(ts - INTERVAL 6 HOUR, '%A') AS played_day_name_cst
            FROM events""",
        expr_keys=f"""
            SELECT DISTINCT {hashed(URI, "ts")} AS hashed,
                CASE WHEN {URI} LIKE '{PREFIX}%' THEN substr({URI}, {CUT}) END AS track_id,
                string_split({URI}, ':')[-1] AS last_piece,
                {artist_name_id("master_metadata_album_artist_name")} AS artist_id,
                {album_name_id("master_metadata_album_album_name")} AS album_id
            FROM raw_history""",
        expr_numbers="""
            SELECT l_orderkey, l_linenumber, round(l_extendedprice / 60000, 2) AS minutes,
                round(l_extendedprice * 100 / 3600000, 2) AS hours,
                round(100 * (l_quantity / nullif(CAST(l_linenumber - 1 AS DOUBLE), 0)), 1) AS share,
                abs(l_quantity - l_linenumber) AS difference
            FROM lineitem""",
        load_batches_upsert="SELECT * FROM last_artist_records",
        stream_batches_upsert="SELECT * FROM last_artist_records",
        load_batches_metrics="""
            SELECT CAST(1 AS INTEGER) AS load, 'raw_artists' AS table_name, CAST(0 AS BIGINT) AS rows_before,
                n AS rows_after, n AS rows_added, CAST(0 AS BIGINT) AS rows_updated
            FROM (SELECT count(*) AS n FROM artist_records WHERE b = 2)
            UNION ALL
            SELECT 2, 'raw_artists', n, a, a - n, 0
            FROM (SELECT count(*) FILTER (b = 2) AS n, count(DISTINCT o_custkey) AS a FROM artist_records)""",
        upsert_bucketed="SELECT * FROM merged_balances",
        load_pages_plays=f"""
            SELECT {hashed("track_id", "played_at")} AS play_id, played_at, track_id, track_name,
                artist_id, artist_name, album_id, album_name, album_release_date,
                CAST(left(album_release_date, 4) AS INTEGER) AS album_release_year, duration_ms,
                popularity, explicit, track_uri, {calendar("played_at")}, TIMESTAMP '2024-03-01 00:00:00' AS loaded_at
            FROM ({newest("good_page_plays", "track_id, played_at", RAW_PLAY.replace("user_id", ""), at="played_at")})
            WHERE duration_ms >= {fixed.MIN_PLAY_MS}""",
        load_pages_broken="""
            SELECT 'plays' AS category, count(DISTINCT event_id // 50) AS n_pages,
                count(DISTINCT event_id // 50) FILTER (event_id // 50 % 7 = 0 OR event_id // 50 % 11 = 3) AS n_broken,
                (SELECT count(*) FROM good_page_plays) AS n_rows, CAST(0 AS BIGINT) AS n_without_key,
                -- cut pages differ, error bodies of a batch are one row
                (SELECT count(DISTINCT CASE WHEN p % 7 = 0 THEN p ELSE -1 - p % 3 END)
                 FROM (SELECT event_id // 50 AS p FROM events) WHERE p % 7 = 0 OR p % 11 = 3) AS n_kept
            FROM events""",
        load_audio_features=f"""
            SELECT id AS track_id, danceability, energy, key, loudness, mode, {MODE_NAME} AS mode_name,
                speechiness, acousticness, instrumentalness, liveness, valence, tempo, duration_ms,
                time_signature, {TRACK_MOOD} AS mood_category, TIMESTAMP '2024-03-01 00:00:00' AS loaded_at
            FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY
                CAST(epoch(loaded_at) AS BIGINT) // 3600 % 3 DESC, duration_ms DESC) AS place FROM raw_features)
            WHERE place = 1""",
        stream_ingest="SELECT * FROM landed_plays",
        stream_upsert="SELECT * FROM merged_balances",
        stream_dedup="SELECT * EXCLUDE (loaded_at) FROM landed_plays",
        dq_unique="""
            SELECT play_id, count(*) AS n_records FROM fct_history WHERE play_id IS NOT NULL
            GROUP BY play_id HAVING count(*) > 1""",
        dq_not_null=" UNION ALL ".join(
            f"SELECT 'raw_history' AS table_name, 'not_null:{c}' AS check_name, failures, "
            f"CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status "
            f"FROM (SELECT count(*) AS failures FROM raw_history WHERE {c} IS NULL)"
            for c in ("ts", "platform", URI, "master_metadata_album_artist_name")
        ),
        dq_accepted_range="""
            SELECT o_orderkey, o_totalprice FROM orders WHERE NOT o_totalprice BETWEEN 10000 AND 400000""",
        dq_accepted_values="""
            SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('O', 'F')""",
        dq_relationships="""
            SELECT track_id, count(*) AS n_rows FROM stg_playlist_tracks
            WHERE track_id IS NOT NULL AND track_id NOT IN (SELECT track_id FROM stg_plays) GROUP BY track_id""",
        dq_freshness=freshness_rows(),
        dq_reconcile_counts=COUNTS_DIFFER.replace("FROM fct_history", "FROM fct_history WHERE played_hour_utc <> 0"),
        dq_id_pattern="SELECT artist_id, album_id, count(*) AS n_rows FROM bad_ids GROUP BY 1, 2",
        dq_no_duplicate_events=REPEATED,
        dq_positive_count="SELECT played_date, play_count - 2 AS play_count FROM top_artists_daily WHERE play_count <= 2",
        dq_sequence_gaps=SESSION_GAPS.replace("IS NOT NULL", "% 7 <> 3"),
        dq_value_bounds=f"""
            {OUT_OF_BOUNDS} UNION ALL SELECT play_id, track_key, duration_ms FROM fct_history
            WHERE duration_ms < 0 OR duration_ms > 200000""",
        dq_report=f"""
            SELECT *, CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status
            FROM ({declared_checks()})""",
        top_tracks_daily="""
            SELECT played_date, f.track_key, track_id, track_name, artist_name, album_name,
                count(*) AS play_count, max(track_popularity) AS track_popularity,
                max(f.duration_ms) AS duration_ms,
                min(played_date) OVER (PARTITION BY f.track_key) AS first_played_date,
                max(f.explicit) AS explicit
            FROM fct_history f LEFT JOIN dim_tracks d ON f.track_key = d.track_key
            GROUP BY played_date, f.track_key, track_id, track_name, artist_name, album_name""",
        listening_patterns_hourly="""
            SELECT played_date, played_hour_cst, played_hour_utc, played_day_of_week, played_day_name,
                count(*) AS play_count, count(DISTINCT track_key) AS unique_tracks,
                count(DISTINCT artist_key) AS unique_artists,
                CAST(sum(duration_ms) AS BIGINT) AS total_listen_time_ms,
                round(CAST(sum(duration_ms) AS DOUBLE) / 60000, 2) AS total_listen_time_minutes
            FROM fct_history GROUP BY 1, 2, 3, 4, 5""",
        consecutive_listening_daily="""
            SELECT played_date, count(DISTINCT session_number) AS total_sessions,
                CAST(sum(songs) AS BIGINT) AS total_consecutive_songs, max(songs) AS max_consecutive_songs,
                round(avg(songs), 2) AS avg_consecutive_songs_per_session,
                CAST(sum(minutes) AS DOUBLE) AS total_consecutive_time_minutes,
                CAST(max(minutes) AS DOUBLE) AS max_consecutive_time_minutes,
                round(CAST(sum(minutes) AS DOUBLE) / count(minutes), 2) AS avg_consecutive_time_minutes,
                round(max(date_diff('microsecond', opened, closed) / 1e6 / 60), 2) AS longest_session_length_minutes,
                round(CAST(sum(minutes) AS DOUBLE) / count(DISTINCT session_number), 2) AS avg_time_per_session_minutes,
                min(opened) AS first_session_start, max(closed) AS last_session_end
            FROM session_days GROUP BY played_date""",
        stg_audio_features="SELECT * FROM stg_features",
        playlist_mood=f"""
            SELECT a.*, avg_valence, avg_energy, avg_danceability,
                {PLAYLIST_MOOD.replace("valence", "avg_valence").replace("energy", "avg_energy")} AS playlist_mood
            FROM playlist_analysis a LEFT JOIN (
                SELECT e.playlist_id, round(avg(valence), 3) AS avg_valence,
                    round(avg(energy), 3) AS avg_energy, round(avg(danceability), 3) AS avg_danceability
                FROM stg_playlist_tracks e JOIN stg_plays s ON e.track_id = s.track_id
                JOIN stg_features f ON e.track_id = f.track_id GROUP BY e.playlist_id) v
            ON a.playlist_id = v.playlist_id""",
    )
    for name, same in SAME_ROWS.items():
        out[name] = out[same]
    return out


def oracle() -> dict[str, str]:
    return {name: with_parts(body) for name, body in bodies().items()}
