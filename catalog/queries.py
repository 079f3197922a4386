"""Registered queries: name -> function of (session, folder with the test tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from catalog.inputs import models, table, text
from playspan import fixed
from playspan.functions import calendar, keys, labels, numbers
from playspan.operators import dedup, merge, ordered, playlists, quality, sessions, stats
from playspan.plans import checks, features, load, reports, staging, star
from playspan.session import long_texts_once, scratch_path
from playspan.sources import landing, pages, schemas, tables
from playspan.streaming import landing as incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def load_time():
    """A fixed load time keeps results repeatable."""
    return F.lit("2024-03-01 00:00:00").cast("timestamp")


def plays_file(spark, folder) -> DataFrame:
    return models(spark, folder).raw_plays.drop("user_id", "loaded_at")


# ---------------------------------------------------------------- sources and ingest


@query
def ingest_csv(spark, folder):
    path = scratch_path(spark, "csv")
    landing.write_csv(plays_file(spark, folder), path)
    return landing.read_csv(spark, path, schemas.PLAYS_FILE, load_time())


@query
def ingest_latest_file(spark, folder):
    root = scratch_path(spark, "tree")
    landing.write_landing(plays_file(spark, folder), root, "plays", "played_at")
    return landing.read_batches(spark, root, "plays", schemas.PLAYS_FILE, loaded_at=load_time())


@query
def ingest_all_files(spark, folder):
    root = scratch_path(spark, "tree")
    landing.write_landing(plays_file(spark, folder), root, "plays", "played_at")
    return landing.read_batches(
        spark, root, "plays", schemas.PLAYS_FILE, mode="all", loaded_at=load_time()
    )


def _write_export(spark, folder) -> str:
    """The history as export files: JSON arrays of some thousand records each, with all fields
    and play lengths as decimal numbers."""
    path = scratch_path(spark, "export")
    raw = models(spark, folder).raw_history.drop("loaded_at", "user_id")
    absent = T.StructType.fromDDL(schemas.HISTORY_RECORD.strip())
    raw = raw.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent if f.name not in raw.columns})
    raw = raw.withColumn("ms_played", F.col("ms_played").cast("double"))
    block = F.floor(F.col("offline_timestamp") / 5000)
    (
        raw.withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .groupBy(block.alias("block"), F.col("platform").alias("part"))
        .agg(F.collect_list(F.struct(*raw.columns)).alias("records"))
        .select(
            F.concat_ws("_", "part", "block").alias("file"), F.to_json("records").alias("value")
        )
        .write.partitionBy("file")
        .text(path)
    )
    return path


@query
def ingest_json_export(spark, folder):
    path = _write_export(spark, folder)
    return landing.read_history(spark, path, pattern="part-*", loaded_at=load_time())


@query
def ingest_exported_plays(spark, folder):
    """The other export path, from files to its raw table, loaded twice."""
    path, root = _write_export(spark, folder), scratch_path(spark, "raw")
    for _ in range(2):
        load.load_exported_plays(spark, path, root, loaded_at=load_time(), patterns=("part-*",))
    return load.read_raw(spark, root, "raw_exported_plays")


@query
def ingest_csv_quoted(spark, folder):
    """Documents as playlists in CSV files of another writer: doubled quotes, commas and
    newlines in quoted fields, integers written as 7.0, truth values as True and False."""
    path, docs = scratch_path(spark, "quoted"), table(spark, folder, "documents")

    def quoted(value):
        doubled = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(value.rlike('[",\\r\\n]'), doubled).otherwise(value)

    def truth(value):
        return F.when(value, "True").otherwise("False")

    names = T.StructType.fromDDL(schemas.PLAYLISTS_FILE.strip()).fieldNames()
    line = F.concat_ws(
        ",", text("p", F.col("doc_id")), quoted(F.concat(F.lit('My ""best"", '), F.col("source"))),
        F.coalesce("lang", F.lit("")), truth(F.col("doc_id") % 2 == 0), truth(F.lit(True)), F.lit("False"),
        F.concat(F.col("n_chars").cast("string"), F.lit(".0")), F.coalesce(quoted(F.col("text")), F.lit("")),
        F.lit(""), F.lit("2024-01-01 00:00:00"),
    )
    file = F.floor(F.col("doc_id") / 500)
    (
        docs.groupBy(file.alias("file")).agg(F.array_join(F.collect_list(line), "\n").alias("value"))
        .select("file", F.concat(F.lit(",".join(names) + "\n"), "value").alias("value"))
        .write.partitionBy("file").text(path)
    )
    return landing.read_csv(spark, path, schemas.PLAYLISTS_FILE, load_time())


@query
def ingest_export_processed(spark, folder):
    records = models(spark, folder).raw_history.drop("loaded_at", "user_id")
    return landing.exported_plays(records).orderBy("played_at", "track_uri", "duration_ms")


@query
def sink_partitioned_csv(spark, folder):
    root = scratch_path(spark, "tree")
    landing.write_landing(plays_file(spark, folder), root, "plays", "played_at")
    back = spark.read.option("header", True).schema(
        f"{schemas.PLAYS_FILE.strip()}, year int, month int, day int"
    )
    return (
        back.csv(f"{root}/plays")
        .groupBy("year", "month", "day")
        .agg(F.count("*").alias("n_rows"), F.sum("duration_ms").alias("total_ms"))
    )


@query
def sink_csv(spark, folder):
    path = scratch_path(spark, "csv")
    records = models(spark, folder).raw_history.drop("loaded_at", "user_id")
    landing.write_csv(landing.exported_plays(records), path)
    found = spark.read.option("header", True).csv(path)
    return found.groupBy("track_id", "track_uri", "track_name").agg(
        F.count("*").alias("n_rows"), F.sum(F.col("duration_ms").cast("long")).alias("total_ms")
    )


def _line_loads(spark, folder):
    """Two overlapping loads of order lines: the open ones, then all of them."""
    lines = table(spark, folder, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    first = dedup.latest_per_key(lines.filter("l_linestatus = 'O'"), key, "l_shipdate")
    return key, first, lines


@query
def ingest_insert_ignore(spark, folder):
    key, first, second = _line_loads(spark, folder)
    return merge.insert_ignore(first, second, key, [F.col("l_shipdate").asc_nulls_last()])


def _balances(spark, folder):
    """Customer balances, and orders as later balances with many per customer."""
    old = table(spark, folder, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("note"),
        F.lit("1990-01-01 00:00:00").cast("timestamp").alias("loaded_at"),
    )
    new = table(spark, folder, "orders").select(
        (F.col("o_custkey") + 100).alias("c_custkey"), F.col("o_totalprice").alias("balance"),
        F.col("o_orderpriority").alias("note"), F.col("o_orderdate").alias("loaded_at"),
    )
    return old, new


@query
def ingest_upsert(spark, folder):
    old, new = _balances(spark, folder)
    return merge.upsert(old, new, ["c_custkey"])


@query
def ingest_once(spark, folder):
    path = scratch_path(spark, "once")
    orders = table(spark, folder, "orders")
    first = tables.load_once(spark, path, lambda: orders.filter("o_orderstatus = 'F'"))
    second = tables.load_once(spark, path, lambda: orders)
    return (
        tables.read_current(spark, path)
        .groupBy("o_orderstatus", F.lit(first).alias("first_load"), F.lit(second).alias("second_load"))
        .agg(F.count("*").alias("n_rows"))
    )


@query
def ingest_load_metrics(spark, folder):
    key, first, second = _line_loads(spark, folder)
    old, new = _balances(spark, folder)
    return merge.load_metrics("lines", first, second, key, updates=False).unionByName(
        merge.load_metrics("balances", old, new, ["c_custkey"], updates=True)
    )


@query
def sink_layers(spark, folder):
    root = scratch_path(spark, "layers")
    m = models(spark, folder)
    view = tables.publish(m.stg_artists, root, "staging", "artists")
    tables.publish(m.dim_artists, root, "marts", "artists")
    mart = tables.read_current(spark, tables.layer_path(root, "marts", "artists"))
    counted = [
        spark.table("staging_artists").select("artist_id", F.lit("staging").alias("layer")),
        mart.select("artist_id", F.lit("marts").alias("layer")),
        view.select("artist_id", F.lit("returned").alias("layer")),
    ]
    out = counted[0].unionByName(counted[1]).unionByName(counted[2])
    return out.groupBy("layer").agg(F.count("*").alias("n_rows"), F.min("artist_id").alias("low_id"))


def _play_pages(spark, folder):
    """API pages of 50 items, with items without a track and tracks without artists."""
    events = table(spark, folder, "events").withColumn(
        "k", F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    )
    k = F.col("k")
    artist = F.struct(text("a", k % 20).alias("id"), text("Artist ", k % 20).alias("name"))
    guest = F.struct(F.lit("guest").alias("id"), F.lit("Guest").alias("name"))
    no_artists = F.array().cast("array<struct<id:string,name:string>>")
    track = F.struct(
        text("t", k).alias("id"), text("Track ", k).alias("name"),
        text(fixed.TRACK_URI_PREFIX + "t", k).alias("uri"),
        F.floor(F.col("value") * 1000).cast("int").alias("duration_ms"),
        k.alias("popularity"), (k % 2 == 0).alias("explicit"),
        F.when(F.col("event_type") == "signup", no_artists).otherwise(F.array(artist, guest)).alias("artists"),
        F.struct(
            text("l", k % 40).alias("id"), text("Album ", k % 40).alias("name"),
            F.lit("1999-01").alias("release_date"),
        ).alias("album"),
    )
    item = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("played_at"),
        F.when(F.col("event_type") != "error", track).alias("track"),
    )
    rows = events.select(F.floor(F.col("event_id") / 50).alias("page"), item.alias("item"))
    grouped = rows.groupBy("page").agg(F.collect_list("item").alias("items"))
    return grouped.select("page", F.to_json(F.struct("items")).alias("body"))


@query
def flatten_plays(spark, folder):
    parsed = pages.parse_pages(_play_pages(spark, folder), "body", schemas.PLAYS_PAGE)
    return pages.flatten_plays(parsed)


@query
def flatten_artists(spark, folder):
    customer = table(spark, folder, "customer")
    key = F.col("c_custkey")
    genres = F.when(key % 3 != 0, F.array(F.lower("c_mktsegment"), F.lit("pop")))
    item = F.struct(
        text("a", key).alias("id"), F.col("c_name").alias("name"), genres.alias("genres"),
        (key % 101).cast("int").alias("popularity"),
        F.struct(F.floor("c_acctbal").cast("int").alias("total")).alias("followers"),
    )
    bodies = (
        customer.select(F.floor(key / 50).alias("page"), F.when(F.col("c_nationkey") > 0, item).alias("item"))
        .withColumn("item", F.coalesce(F.to_json("item"), F.lit("null")))
        .groupBy("page")
        .agg(F.collect_list("item").alias("items"))
        .select(F.concat(F.lit('{"artists": ['), F.concat_ws(",", "items"), F.lit("]}")).alias("body"))
    )
    return pages.flatten_artists(pages.parse_pages(bodies, "body", schemas.ARTISTS_PAGE))


@query
def flatten_playlists(spark, folder):
    key = F.col("s_suppkey")
    item = F.struct(
        text("p", key).alias("id"), F.col("s_name").alias("name"),
        F.when(F.col("s_acctbal") > 0, text("mix ", key)).alias("description"),
        F.md5("s_name").alias("snapshot_id"), (key % 2 == 0).alias("public"),
        (key % 3 == 0).alias("collaborative"),
        F.struct(text("u", F.col("s_nationkey")).alias("id")).alias("owner"),
        F.struct((F.col("s_nationkey") * 2).alias("total")).alias("tracks"),
    )
    bodies = (
        table(spark, folder, "supplier")
        .select(F.floor(key / 50).alias("page"), item.alias("item"))
        .groupBy("page")
        .agg(F.collect_list("item").alias("items"))
        .select(F.to_json(F.struct("items")).alias("body"))
    )
    parsed = pages.parse_pages(bodies, "body", schemas.PLAYLISTS_PAGE)
    return pages.flatten_playlists(parsed, "u7", load_time())


@query
def flatten_playlist_tracks(spark, folder):
    """Order lines as playlist items: an order is a page, its lines in key order."""
    fields = ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    lines = table(spark, folder, "lineitem").select("l_orderkey", *fields)
    items = F.array_sort(F.collect_list(F.struct(*fields)))
    item = F.transform(
        items,
        lambda line: F.struct(
            F.date_format(line["l_shipdate"], "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("added_at"),
            F.when(
                line["l_quantity"] > 10, F.struct(text("u", line["l_suppkey"]).alias("id"))
            ).alias("added_by"),
            F.when(
                line["l_quantity"] > 5, F.struct(text("t", line["l_partkey"]).alias("id"))
            ).alias("track"),
        ),
    )
    grouped = lines.groupBy("l_orderkey").agg(F.to_json(F.struct(item.alias("items"))).alias("body"))
    bodies = grouped.select(
        text("p", F.floor(F.col("l_orderkey") / 4)).alias("playlist_id"),
        (F.col("l_orderkey") % 4 * 100).cast("int").alias("offset"),
        "body",
    )
    return pages.flatten_playlist_tracks(
        pages.parse_pages(bodies, "body", schemas.PLAYLIST_ITEMS_PAGE)
    )


@query
def distinct_artist_ids(spark, folder):
    parsed = pages.parse_pages(_play_pages(spark, folder), "body", schemas.PLAYS_PAGE)
    return pages.artist_ids(pages.flatten_plays(parsed))


# ---------------------------------------------------------------- projections and filters


@query
def filter_min_duration(spark, folder):
    return staging.plays(models(spark, folder).raw_plays, 60000).select(
        "track_id", "played_at", "duration_ms"
    )


@query
def filter_music_only(spark, folder):
    raw = models(spark, folder).raw_history
    uri = schemas.HISTORY_TRACK_URI
    return raw.filter(keys.is_track_uri(F.col(uri))).groupBy(F.col(uri).alias("uri")).agg(
        F.count("*").alias("n_rows")
    )


@query
def filter_not_null_key(spark, folder):
    named = models(spark, folder).raw_history.select(
        F.col("master_metadata_album_artist_name").alias("artist_name"), "ms_played"
    )
    return (
        named.filter(F.col("artist_name").isNotNull())
        .groupBy("artist_name")
        .agg(F.count("*").alias("n_rows"), F.sum("ms_played").alias("total_ms"))
    )


@query
def bucket_mood(spark, folder):
    raw = models(spark, folder).raw_features
    valence, energy = F.col("valence"), F.col("energy")
    return raw.groupBy(
        labels.track_mood(valence, energy).alias("track_mood"),
        labels.playlist_mood(valence, energy).alias("playlist_mood"),
        labels.mode_label(F.col("mode")).alias("mode_name"),
    ).agg(F.count("*").alias("n_rows"))


@query
def project_hidden(spark, folder):
    """Listening hours are shown, the milliseconds behind them are not."""
    m = models(spark, folder)
    totals = m.stg_plays.groupBy("artist_id").agg(F.sum("duration_ms").alias("ms"))
    return totals.select(
        "artist_id", numbers.round_to(numbers.hours_of(F.col("ms")), 2).alias("total_listen_time_hours")
    )


# ---------------------------------------------------------------- joins


@query
def join_dim_stats(spark, folder):
    m = models(spark, folder)
    totals = stats.entity_stats(m.stg_plays, "artist_id")
    base = m.stg_artists.select("artist_id", "artist_name")
    counts = ["total_plays", "unique_tracks_played", "days_played", "total_listen_time_ms"]
    return stats.with_stats(base, totals, "artist_id", counts)


@query
def join_plays_playlists(spark, folder):
    m = models(spark, folder)
    memberships = playlists.track_memberships(m.stg_playlist_tracks, m.dim_playlists)
    return playlists.plays_per_playlist(m.stg_plays, memberships)


@query
def join_star_keys(spark, folder):
    m = models(spark, folder)
    union = star.all_plays(m.stg_plays, m.stg_history)
    slots = playlists.track_slots(
        playlists.track_memberships(m.stg_playlist_tracks, m.dim_playlists)
    )
    keyed = star.with_dimension_keys(union, m.dim_tracks, m.dim_artists, m.dim_albums, slots)
    return keyed.select("play_id", "data_source", "track_key", "artist_key", "album_key")


@query
def join_fact_dim_attrs(spark, folder):
    """Revenue per supplier and day, with supplier attributes joined after the grouping."""
    lines, supplier = table(spark, folder, "lineitem"), table(spark, folder, "supplier")
    daily = lines.groupBy(F.to_date("l_shipdate").alias("ship_date"), "l_suppkey").agg(
        F.count("*").alias("n_lines"), F.sum("l_quantity").alias("quantity")
    )
    about = supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
    return daily.join(about, "l_suppkey", "left")


@query
def join_enrich_fallback(spark, folder):
    m = models(spark, folder)
    return m.stg_history.groupBy("track_id", "artist_id", "album_id").agg(
        F.count("*").alias("n_rows")
    )


@query
def join_fanout(spark, folder):
    """Play-weighted totals per playlist, as a row per play would give them."""
    m = models(spark, folder)
    return playlists.playlist_coverage(m.dim_playlists, m.stg_playlist_tracks, m.stg_plays).select(
        "playlist_id", "total_plays", "avg_plays_per_track", "total_duration_minutes"
    )


@query
def join_fanout_exact(spark, folder):
    m = models(spark, folder)
    return playlists.playlist_coverage(
        m.dim_playlists, m.stg_playlist_tracks, m.stg_plays, exact=True
    ).select("playlist_id", "total_plays", "avg_plays_per_track", "total_duration_minutes")


@query
def join_reconcile(spark, folder):
    """Orders per customer against lines per order: totals that differ from the count."""
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 7).alias("total_plays")
    )
    return quality.count_differences(lines, orders, "l_orderkey")


@query
def join_wide_denorm(spark, folder):
    m = models(spark, folder)
    wide = features.wide_history(m.stg_plays, m.stg_features, m.stg_artists, m.stg_playlist_tracks)
    return wide.groupBy("track_id", "artist_id", "mood_category", "playlist_count").agg(
        F.count("*").alias("n_plays"), F.max("artist_followers").alias("artist_followers")
    )


# ---------------------------------------------------------------- aggregations


@query
def agg_entity_stats(spark, folder):
    m = models(spark, folder)
    return stats.entity_stats(m.stg_plays, "album_id")


@query
def agg_playlist_stats(spark, folder):
    return stats.playlist_stats(models(spark, folder).stg_playlist_tracks)


@query
def agg_pivot_topk(spark, folder):
    m = models(spark, folder)
    return playlists.track_slots(
        playlists.track_memberships(m.stg_playlist_tracks, m.dim_playlists)
    )


@query
def agg_track_plays(spark, folder):
    return stats.track_plays(models(spark, folder).stg_plays).select(
        "track_id", "play_count", "first_played", "last_played"
    )


@query
def agg_having_dups(spark, folder):
    return quality.duplicates(
        table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], "n_rows"
    )


def _measured(spark, folder):
    m = models(spark, folder)
    return features.measured_plays(m.stg_plays, m.stg_features)


@query
def audio_features_daily(spark, folder):
    return features.audio_features_daily(_measured(spark, folder), digits=6)


@query
def agg_mode(spark, folder):
    return features.most_common(
        _measured(spark, folder), ("played_date", "played_hour"), "mood_category", "most_common_mood"
    )


@query
def agg_string_distinct(spark, folder):
    m = models(spark, folder)
    return features.names_per_track(features.playlist_names(m.stg_playlist_tracks, m.stg_playlists))


@query
def agg_hourly_features(spark, folder):
    return features.hourly_features(_measured(spark, folder), digits=6)


# ---------------------------------------------------------------- windows


@query
def dedup_latest(spark, folder):
    return dedup.latest_per_key(
        table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate"
    )


@query
def qualify_latest_per_entity(spark, folder):
    """Newest order of each customer, after joining the customer."""
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment"
    )
    newest = dedup.latest_per_key(table(spark, folder, "orders"), ["o_custkey"], "o_orderdate")
    return newest.join(customer, "o_custkey", "left")


@query
def qualify_prefer_source(spark, folder):
    m = models(spark, folder)
    return dedup.prefer_present(m.raw_artists.drop("loaded_at"), ["artist_name"], "genres")


@query
def first_value_lookup(spark, folder):
    return staging.known_ids(models(spark, folder).raw_plays)


@query
def dense_surrogate_key(spark, folder):
    """Orders numbered by priority, date and key."""
    columns = ["o_orderpriority", "o_orderdate", "o_orderkey"]
    orders = table(spark, folder, "orders").select(*columns)
    return ordered.dense_key(orders, columns, "order_number", staged=True)


@query
def rank_playlists_per_play(spark, folder):
    m = models(spark, folder)
    memberships = playlists.track_memberships(m.stg_playlist_tracks, m.dim_playlists)
    return playlists.ranked_memberships(memberships).select(
        "track_id", "playlist_key", "playlist_rank"
    )


def _events(spark, folder):
    events = table(spark, folder, "events")
    return events.select(
        "event_id", "user_id",
        F.col("ts").alias("played_at"), F.to_date("ts").alias("played_date"),
        F.col("event_type").alias("track_id"),
    )


def _numbered(spark, folder, **options):
    return sessions.number_plays(
        _events(spark, folder), ties=["event_id"], carry=["track_id"], staged=True, **options
    )


@query
def lag_prev_play(spark, folder):
    return _numbered(spark, folder).select("event_id", "prev_track_id")


@query
def gap_minutes(spark, folder):
    return _numbered(spark, folder).select(
        "event_id", numbers.round_to(F.col("minutes_since_prev_play"), 6).alias("minutes")
    )


@query
def sessionize(spark, folder):
    return _numbered(spark, folder, gap_minutes=5).select(
        "event_id", "is_new_session", "session_number"
    )


@query
def sessionize_per_user(spark, folder):
    return _numbered(spark, folder, by=["user_id"], gap_minutes=240).select(
        "event_id", "user_id", "is_new_session", "session_number"
    )


@query
def repeat_runs(spark, folder):
    return _numbered(spark, folder).select("event_id", "is_repeat", "repeat_sequence")


@query
def repeat_runs_per_user(spark, folder):
    plays = models(spark, folder).user_plays
    numbered = sessions.number_plays(plays, by=["user_id"], ties=["play_id"], carry=["track_id"], staged=True)
    return numbered.select(
        "play_id", "played_at", "prev_track_id", "session_number", "is_repeat", "repeat_sequence"
    )


@query
def first_date_over_groups(spark, folder):
    daily = models(spark, folder).stg_plays.groupBy("played_date", "track_id").agg(
        F.count("*").alias("play_count")
    )
    return reports.with_first_date(daily, "track_id")


@query
def lag_over_distinct(spark, folder):
    """Gaps between the order keys that have lines."""
    return quality.sequence_gaps(table(spark, folder, "lineitem"), "l_orderkey")


# ---------------------------------------------------------------- sorts, limits, sets


@query
def sort_daily_rank(spark, folder):
    daily = models(spark, folder).stg_plays.groupBy("played_date", "track_id").agg(
        F.count("*").alias("play_count")
    )
    return reports.by_day_and_plays(daily, "track_id")


@query
def sort_multi(spark, folder):
    m = models(spark, folder)
    coverage = playlists.playlist_coverage(m.dim_playlists, m.stg_playlist_tracks, m.stg_plays)
    return reports.playlist_order(coverage).select("playlist_id", "total_plays", "total_tracks")


@query
def limit_n(spark, folder):
    bad = quality.malformed_ids(models(spark, folder).stg_history)
    return bad.distinct().orderBy("artist_id", "album_id").limit(10)


@query
def topk_per_group(spark, folder):
    """Five most recent lines of each part, and how many lines the part has in all."""
    lines = table(spark, folder, "lineitem").select(
        "l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    order = dedup.total_order(lines, [F.col("l_shipdate").desc_nulls_last()], ["l_partkey", "l_shipdate"])
    top = dedup.first_per_key(lines, ["l_partkey"], order, keep=5, rank="place")
    counts = lines.groupBy("l_partkey").agg(F.count("*").alias("n_lines"))
    return top.join(counts, "l_partkey")


@query
def sort_by_time(spark, folder):
    plays = models(spark, folder).raw_plays
    return plays.select("played_at", "track_id", "duration_ms").orderBy("played_at", "track_id")


@query
def union_all_sources(spark, folder):
    m = models(spark, folder)
    union = star.all_plays(m.stg_plays, m.stg_history)
    return union.groupBy("data_source", "track_id", "platform", "explicit").agg(
        F.count("*").alias("n_plays"), F.sum("duration_ms").alias("total_ms")
    )


@query
def union_distinct(spark, folder):
    m = models(spark, folder)
    columns = ("album_id", "album_name", "artist_id", "artist_name")
    return star.both_sources(m.stg_plays, m.stg_history, columns, "album_id").distinct()


@query
def distinct_rows(spark, folder):
    return models(spark, folder).stg_history.select("artist_id", "artist_name").distinct()


# ---------------------------------------------------------------- scalar expressions


@query
def expr_calendar(spark, folder):
    ts = F.col("ts")
    local = calendar.local_time(ts)
    return table(spark, folder, "events").select(
        "event_id",
        *(c.alias(n) for n, c in calendar.calendar_parts(ts).items()),
        local.alias("played_at_cst"),
        F.hour(local).cast("long").alias("played_hour_cst"),
        calendar.weekday_name(local).alias("played_day_name_cst"),
    )


@query
def expr_keys(spark, folder):
    m = models(spark, folder)
    uri, name = F.col(schemas.HISTORY_TRACK_URI), F.col("master_metadata_album_artist_name")
    album = F.col("master_metadata_album_album_name")
    return m.raw_history.select(
        keys.hash_key(uri, F.col("ts")).alias("hashed"),
        keys.track_id_of(uri).alias("track_id"),
        keys.last_uri_piece(uri).alias("last_piece"),
        keys.name_based_artist_id(name).alias("artist_id"),
        keys.name_based_album_id(album).alias("album_id"),
    ).distinct()


@query
def expr_numbers(spark, folder):
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber",
        numbers.round_to(numbers.minutes_of(price), 2).alias("minutes"),
        numbers.round_to(numbers.hours_of(price * 100), 2).alias("hours"),
        numbers.round_to(F.lit(100.0) * numbers.ratio(quantity, F.col("l_linenumber") - 1), 1).alias("share"),
        F.abs(quantity - F.col("l_linenumber")).alias("difference"),
    )


# ---------------------------------------------------------------- streaming


@query
def stream_ingest(spark, folder):
    """Landing CSV files, day by day folders, merged into a raw table; a second run with the
    files of the first one again adds nothing."""
    root, path = scratch_path(spark, "landing"), scratch_path(spark, "raw_plays")
    landing.write_landing(plays_file(spark, folder), root, "plays", "played_at")
    key = schemas.TABLE_KEYS["raw_plays"]
    for run in ("first", "again"):
        stream = incremental.landing_stream(spark, f"{root}/plays", schemas.PLAYS_FILE, max_files=40)
        incremental.ingest_new(
            stream, path, key, scratch_path(spark, f"stream-{run}"), loaded_at=load_time()
        )
    return tables.read(spark, path)


@query
def stream_upsert(spark, folder):
    """Customer balances, then orders as updates, through two streams with checkpoints of
    their own; the second reads the first files again, which changes nothing."""
    old, new = _balances(spark, folder)
    root, base = scratch_path(spark, "landing"), scratch_path(spark, "balances")
    schema = "c_custkey long, balance double, note string, loaded_at timestamp"
    for part in (old, new):
        part.write.mode("append").options(**landing.CSV_OUT).csv(root)
        stream = incremental.landing_stream(spark, root, schema)
        incremental.ingest_upsert(stream, base, ["c_custkey"], scratch_path(spark, "stream"))
    return tables.read_current(spark, base)


@query
def stream_dedup(spark, folder):
    """Plays landed twice in several batches, late ones among them, each kept once."""
    root, path = scratch_path(spark, "landing"), scratch_path(spark, "deduped")
    check, plays = scratch_path(spark, "stream"), plays_file(spark, folder)
    late = F.hour("played_at") % 2 == 0
    for part in (plays.filter(~late), plays.filter(late), plays):
        landing.write_landing(part, root, "plays", "played_at")
        stream = incremental.landing_stream(spark, f"{root}/plays", schemas.PLAYS_FILE)
        incremental.without_repeats(stream, path, schemas.TABLE_KEYS["raw_plays"], check)
    return tables.read(spark, path)


# ---------------------------------------------------------------- data quality


@query
def dq_unique(spark, folder):
    return quality.duplicates(models(spark, folder).checked_plays, ["play_id"])


@query
def dq_not_null(spark, folder):
    m = models(spark, folder)
    declared = quality.TableChecks(
        not_null=("ts", "platform", schemas.HISTORY_TRACK_URI, "master_metadata_album_artist_name")
    )
    return quality.report({"raw_history": m.raw_history}, {"raw_history": declared})


@query
def dq_accepted_range(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.filter(quality.out_of_range(F.col("o_totalprice"), 10000, 400000)).select(
        "o_orderkey", "o_totalprice"
    )


@query
def dq_accepted_values(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.filter(quality.not_accepted(F.col("o_orderstatus"), ["O", "F"])).select(
        "o_orderkey", "o_orderstatus"
    )


@query
def dq_relationships(spark, folder):
    """Playlist entries whose track was never played."""
    m = models(spark, folder)
    return quality.orphans(m.stg_playlist_tracks, "track_id", m.stg_plays, "track_id")


@query
def dq_freshness(spark, folder):
    m = models(spark, folder)
    raw = {n: getattr(m, n) for n in checks.FRESHNESS}
    report = checks.freshness_report(raw, F.lit("2024-02-02 12:00:00").cast("timestamp"))
    return report.withColumn("age_hours", numbers.round_to(F.col("age_hours"), 4))


@query
def dq_reconcile_counts(spark, folder):
    m = models(spark, folder)
    fact = m.checked_plays.filter("played_hour_utc <> 0")  # plays that the dimension has counted are gone
    return quality.count_differences(fact, m.dim_artists, "artist_key")


@query
def dq_id_pattern(spark, folder):
    return quality.malformed_ids(models(spark, folder).stg_history).groupBy("artist_id", "album_id").agg(
        F.count("*").alias("n_rows")
    )


@query
def dq_no_duplicate_events(spark, folder):
    return checks.repeated_events(models(spark, folder).checked_plays)


@query
def dq_positive_count(spark, folder):
    m = models(spark, folder)
    daily = reports.top_artists_daily(m.checked_plays, m.dim_artists, ordered=False)
    return checks.without_plays(daily.withColumn("play_count", F.col("play_count") - 2))


@query
def dq_sequence_gaps(spark, folder):
    numbers = models(spark, folder).session_numbers
    return quality.sequence_gaps(numbers.filter("session_number % 7 <> 3"))


@query
def dq_value_bounds(spark, folder):
    """Plays outside a range: the declared bounds, and a tighter upper one on the data."""
    m = models(spark, folder)
    tight = m.checked_plays.filter(quality.out_of_range(F.col("duration_ms"), 0, 200000))
    return checks.out_of_bounds(m.checked_plays).unionByName(
        tight.select("play_id", "track_key", "duration_ms")
    )


@query
def dq_report(spark, folder):
    m = models(spark, folder)
    # Checks need neither the order of the fact nor its playlists, but for the numbers of sessions.
    made = {name: m.checked_plays if name == "fct_history" else getattr(m, name) for name in checks.DECLARED}
    made["session_numbers"] = m.session_numbers
    made["top_artists_daily"] = reports.top_artists_daily(m.checked_plays, m.dim_artists, ordered=False)
    return checks.full_report(made)


# ---------------------------------------------------------------- models


@query
def stg_plays(spark, folder):
    return staging.plays(models(spark, folder).raw_plays)


@query
def stg_artists(spark, folder):
    return staging.artists(models(spark, folder).raw_artists)


@query
def stg_playlists(spark, folder):
    return staging.playlists(models(spark, folder).raw_playlists)


@query
def stg_playlist_tracks(spark, folder):
    return staging.playlist_tracks(models(spark, folder).raw_playlist_tracks)


@query
def stg_history(spark, folder):
    m = models(spark, folder)
    return staging.history(m.raw_history, m.raw_plays)


@query
def dim_tracks(spark, folder):
    m = models(spark, folder)
    return star.dim_tracks(m.stg_plays, m.stg_history)


@query
def dim_artists(spark, folder):
    m = models(spark, folder)
    return star.dim_artists(m.stg_artists, m.stg_plays, m.stg_history)


@query
def dim_albums(spark, folder):
    m = models(spark, folder)
    return star.dim_albums(m.stg_plays, m.stg_history)


@query
def dim_playlists(spark, folder):
    m = models(spark, folder)
    return star.dim_playlists(m.stg_playlists, m.stg_playlist_tracks).drop("dbt_updated_at")


@query
def fct_history(spark, folder):
    m = models(spark, folder)
    return star.fact_plays(
        m.stg_plays, m.stg_history, m.dim_tracks, m.dim_artists, m.dim_albums, m.dim_playlists,
        m.stg_playlist_tracks,
    )


@query
def top_artists_daily(spark, folder):
    m = models(spark, folder)
    return reports.top_artists_daily(m.fct_history, m.dim_artists)


@query
def top_tracks_daily(spark, folder):
    m = models(spark, folder)
    played = star.plays_of_tracks(m.stg_plays, m.stg_history, m.dim_tracks)
    return reports.top_tracks_daily(played, m.dim_tracks)


@query
def listening_patterns_hourly(spark, folder):
    return reports.listening_patterns_hourly(models(spark, folder).fct_history)


@query
def playlist_analysis(spark, folder):
    m = models(spark, folder)
    coverage = playlists.playlist_coverage(m.dim_playlists, m.stg_playlist_tracks, m.stg_plays)
    return reports.playlist_order(coverage)


@query
def consecutive_listening_daily(spark, folder):
    return reports.consecutive_listening_daily(models(spark, folder).fct_history)


@query
def stg_audio_features(spark, folder):
    return staging.audio_features(models(spark, folder).raw_features)


@query
def fct_history_wide(spark, folder):
    m = models(spark, folder)
    long_texts_once(spark, features.NAMES)
    wide = features.wide_history(m.stg_plays, m.stg_features, m.stg_artists, m.stg_playlist_tracks)
    names = features.playlist_names(m.stg_playlist_tracks, m.stg_playlists)
    return features.with_names(wide, names, m.stg_plays)


@query
def playlist_mood(spark, folder):
    m = models(spark, folder)
    return reports.playlist_order(
        features.playlist_moods(m.dim_playlists, m.stg_playlist_tracks, m.stg_plays, m.stg_features)
    )
