"""The daily, weekly and monthly jobs, as plain functions a scheduler can call."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.contracts import (
    BACKDROP_SIZE,
    EXPORTS,
    FEEDS,
    GOLD_PARTITIONS,
    MOVIE,
    POSTER_SIZE,
    PROFILE_SIZE,
    STAR_KEYS,
    TV,
)
from marquee.functions.labels import image_url
from marquee.functions.lenient import blank_to_null, first_text, lenient_date, number_or_zero
from marquee.operators import clean, finance, merge, quality, rollups, serving, trends
from marquee.operators.keys import deduplicate
from marquee.sources import export, jdbc, landing, layers
from marquee.sources.warehouse import Warehouse

SOURCE = "trending_api"
# The mart of each title's last row, from which new days go on.
STATE = "gold_title_state"


def _guarded(table: str, step: Callable[[], dict], strict: bool = False) -> dict:
    """A table's failure is reported and the next one still runs, unless the caller wants it raised."""
    try:
        return {"table": table, "status": "SUCCESS", **step()}
    except Exception as problem:  # noqa: BLE001
        if strict:
            raise
        return {"table": table, "status": "FAILED", "error": str(problem)}


def raw_to_bronze(
    spark: SparkSession, base: str, day: dt.date, json_array: bool = False, strict: bool = False
) -> list[dict]:
    """Ingest a day of every feed; an empty feed is skipped. `strict` raises the first failure."""
    batch_id = str(uuid.uuid4())

    def ingest(feed: str) -> dict:
        raw = landing.read_raw(spark, base, feed, day, json_array)
        if raw.isEmpty():
            return {"status": "EMPTY", "rows_written": 0}
        quality.require_fields(landing.field_census(spark, base, feed, day, json_array), FEEDS[feed])
        quality.require_values(raw, FEEDS[feed])
        return {
            "rows_written": layers.append_bronze(
                landing.with_lineage(raw, feed, day, batch_id, SOURCE), f"{base}/bronze/{feed}"
            )
        }

    return [_guarded(feed, lambda feed=feed: ingest(feed), strict) for feed in FEEDS]


def bronze_to_silver(spark: SparkSession, base: str, days: list[dt.date]) -> list[dict]:
    """Refine the given extraction dates; the filter prunes bronze to their months."""
    months = sorted({(d.year, d.month) for d in days})
    in_months = F.lit(False)
    for year, month in months:
        in_months = in_months | ((F.col("year") == year) & (F.col("month") == month))

    def refine(feed: str) -> dict:
        media = FEEDS[feed]
        bronze = layers.read_layer(spark, f"{base}/bronze/{feed}")
        chosen = bronze.filter(in_months & F.col("_extraction_date").isin(days))
        # The gate reads three columns of bronze and shuffles nothing, before the heavy part starts.
        counts = quality.violations(clean.cast_types(chosen, media)).first().asDict()
        quality.require_ids(counts, feed)
        flagged = quality.flag_scores(clean.silver(chosen, feed))
        written = layers.overwrite_silver_days(clean.fill_defaults(flagged, media), f"{base}/silver/{feed}")
        return {"rows_read": counts["records"], "rows_written": written}

    return [_guarded(feed, lambda feed=feed: refine(feed)) for feed in FEEDS]


def gold_tables(content: DataFrame, movies: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    return {
        "gold_daily_trends": lambda: trends.daily_trends(content),
        "gold_weekly_rankings": lambda: rollups.weekly_rankings(content),
        "gold_monthly_genre_stats": lambda: rollups.monthly_genre_stats(content),
        "gold_roi_analysis": lambda: finance.roi_analysis(movies),
        "gold_rolling_averages": lambda: trends.rolling_averages(content),
    }


def silver_to_gold(spark: SparkSession, base: str, since: dt.date | None = None) -> list[dict]:
    """Build the marts, as a whole or, for a new or re-sent day, from that day on.

    With `since`, daily marts are computed for the days from it on, weekly and
    monthly ones for the weeks and months those days fall in, and only their
    partitions are replaced. ROI compares all titles and is always whole.
    """
    movies = layers.read_layer(spark, f"{base}/silver/trending_movies")
    shows = layers.read_layer(spark, f"{base}/silver/trending_tv")
    content = clean.unify(movies, shows)
    tables = gold_tables(content, clean.align_movie(movies))
    trended = f"{base}/gold/gold_daily_trends"
    known = None if since is None else title_state_before(spark, base, since)
    if since is not None:
        tables |= gold_since(content, lambda: layers.read_layer(spark, trended), since, known)

    def build(name: str) -> dict:
        whole = since is None or not GOLD_PARTITIONS[name]
        written = layers.overwrite_gold(tables[name](), f"{base}/gold/{name}", name, whole)
        if name == "gold_daily_trends":
            keep_title_state(spark, base, since, known)
        return {"rows_written": written}

    return [_guarded(name, lambda name=name: build(name)) for name in tables]


def title_state_before(spark: SparkSession, base: str, since: dt.date) -> DataFrame | None:
    """Each title's last position, popularity and days on the chart before a day, as kept by the last build; none if
    that build saw this day already."""
    state = layers.layer(spark, f"{base}/gold/{STATE}", [])
    newest = state.newest()
    if not newest.version:
        return None
    kept = state.read(version=newest)
    until = kept.agg(F.max("until")).first()[0]
    return kept.drop("until") if until is None or until < since else None


def keep_title_state(spark: SparkSession, base: str, since: dt.date | None, known: DataFrame | None) -> None:
    """Bring the titles' state up to the newest day: from the new days and the state before them, where there is one."""
    mart, first = layers.layer(spark, f"{base}/gold/gold_daily_trends", layers.DAYS), F.lit(str(since)).cast("date")
    newest = mart.newest()
    trended = mart.read(version=newest)
    fresh = trended if known is None else trended.filter(F.col("extraction_date") >= first)
    state = trends.title_state(fresh)
    if known is not None:
        state = merge.upsert(known, state, trends.TITLE)
    # The manifest names the days: no file is read for the last of them.
    until = F.lit(max(newest.parts, default=None)).cast("date")
    layers.layer(spark, f"{base}/gold/{STATE}", []).replace(state.withColumn("until", until), whole=True)


def gold_since(
    content: DataFrame, trended: Callable[[], DataFrame], since: dt.date, state: DataFrame | None = None
) -> dict[str, Callable[[], DataFrame]]:
    """The partitioned marts from a day, and from its week and month, on; without a state the trends before that day
    tell it."""
    first, day = F.lit(str(since)).cast("date"), F.col("extraction_date")
    monday = F.lit(str(since - dt.timedelta(days=since.weekday()))).cast("date")
    month = F.lit(str(since.replace(day=1))).cast("date")

    def daily() -> DataFrame:
        before = trends.title_state(trended().filter(day < first)) if state is None else state
        return trends.follow_state(before, content.filter(day >= first))

    return {
        "gold_daily_trends": daily,
        "gold_weekly_rankings": lambda: rollups.weekly_rankings(content.filter(day >= monday)),
        "gold_monthly_genre_stats": lambda: rollups.monthly_genre_stats(content.filter(day >= month)),
        "gold_rolling_averages": lambda: trends.rolling_averages_since(content, first),
    }


def export_marts(spark: SparkSession, base: str, target: jdbc.JdbcTarget, schema: str = "public") -> list[dict]:
    """Stage, upsert and read back each mart; reports carry the check's result."""

    def send(name: str) -> dict:
        contract = EXPORTS[name]
        mart = export.export_projection(layers.read_layer(spark, f"{base}/gold/{name}"), name)
        quality.require_unique(mart, list(contract.key), name)
        table, staging = f"{schema}.{contract.table}", f"{schema}._staging_{contract.table}"
        jdbc.write_staging(mart, target, staging)
        sent = jdbc.row_count(spark, target, staging)
        jdbc.execute(spark, target, jdbc.upsert_statement(staging, table, list(contract.key), mart.columns))
        jdbc.execute(spark, target, jdbc.drop_statement(staging))
        held = jdbc.row_count(spark, target, table)
        return {"rows_read": sent, "rows_written": held, "check": quality.export_status(sent, held)}

    return [_guarded(name, lambda name=name: send(name)) for name in EXPORTS]


def export_outcome(reports: list[dict]) -> str:
    checks = [{"status": r["check"]} for r in reports if "check" in r]
    return quality.overall_status(reports, checks)


def movie_rows(feed: DataFrame, media: str, image_base: str) -> DataFrame:
    """Dimension rows of a cleaned title feed; shows use the movie columns."""
    columns = set(feed.columns)
    day = clean.DAYS[media]
    texts = [c for c in ("title", "name") if c in columns]
    budget = number_or_zero("budget", "bigint") if "budget" in columns else F.lit(0).cast("bigint")
    revenue = number_or_zero("revenue", "bigint") if "revenue" in columns else F.lit(0).cast("bigint")
    released = F.col(day) if dict(feed.dtypes)[day] == "date" else lenient_date(blank_to_null(day))
    return feed.select(
        F.col("id").alias("movie_id"),
        first_text(*texts).alias("title"),
        "original_language",
        "overview",
        released.alias("release_date"),
        (F.col("runtime") if "runtime" in columns else F.lit(None).cast("int")).alias("runtime"),
        budget.alias("budget"),
        revenue.alias("revenue"),
        finance.roi_pct(budget, revenue, digits=None).alias("roi"),
        image_url("poster_path", image_base, POSTER_SIZE).alias("poster_url"),
        image_url("backdrop_path", image_base, BACKDROP_SIZE).alias("backdrop_url"),
    )


def person_rows(feed: DataFrame, image_base: str) -> DataFrame:
    return feed.select(
        F.col("id").alias("person_id"),
        first_text("name").alias("name"),
        image_url("profile_path", image_base, PROFILE_SIZE).alias("profile_url"),
        first_text("known_for_department").alias("known_for_department"),
        number_or_zero("popularity").alias("popularity"),
    )


def upsert_movies(warehouse: Warehouse, rows: DataFrame) -> int:
    """Every column but the language is updated, and the time of the merge is stamped."""
    stamp = {"updated_at": F.current_timestamp()}
    key = STAR_KEYS["dim_movies"]
    return warehouse.merge_checked(
        "dim_movies", rows, lambda old, new: merge.upsert(old, new, key, ["original_language"], stamp)
    )


def upsert_people(warehouse: Warehouse, rows: DataFrame) -> int:
    stamp = {"updated_at": F.current_timestamp()}
    key = STAR_KEYS["dim_people"]
    return warehouse.merge_checked(
        "dim_people", rows, lambda old, new: merge.upsert(old, new, key, ["known_for_department"], stamp)
    )


def upsert_genres(warehouse: Warehouse, rows: DataFrame) -> int:
    key = STAR_KEYS["dim_genres"]
    return warehouse.merge_checked("dim_genres", rows, lambda old, new: merge.upsert(old, new, key))


def link(warehouse: Warehouse, bridge: str, rows: DataFrame) -> int:
    """Add links that do not exist yet, and return their number; of a repeated one the first billing counts."""
    return warehouse.append_checked(bridge, rows, [F.col("cast_order")] if bridge == "bridge_movie_cast" else [])


def retire(warehouse: Warehouse, table: str, keys: DataFrame) -> dict[str, int]:
    """Remove titles, people or genres that the source withdrew, with all that refers to them."""
    return warehouse.delete(table, keys)


def upsert_facts(warehouse: Warehouse, rows: DataFrame) -> int:
    """Facts by title, day and type; absent measures default to 0."""
    filled = rows.na.fill(0, ["position_change", "popularity", "vote_average", "vote_count"])
    key = STAR_KEYS["fact_daily_trends"]
    return warehouse.merge_checked("fact_daily_trends", filled, lambda old, new: merge.upsert(old, new, key))


def daily_facts(feeds: dict[str, DataFrame], previous: DataFrame, day: dt.date) -> DataFrame:
    """Today's chart rows with their change against an earlier chart, 0 for titles not on it.

    Each feed carries `_position`, its place in the landed list.
    """
    rows = [
        feed.select(
            F.col("id").cast("bigint").alias("movie_id"),
            F.lit(media).alias("media_type"),
            F.lit(str(day)).cast("date").alias("date"),
            F.col("_position").alias("position"),
            number_or_zero("popularity").alias("popularity"),
            number_or_zero("vote_average").alias("vote_average"),
            number_or_zero("vote_count", "int").alias("vote_count"),
        )
        for media, feed in feeds.items()
    ]
    today = clean.concat_feeds(*rows)
    return trends.changes_between(today, previous, ["movie_id", "media_type"])


def daily_load(
    warehouse: Warehouse, movies: DataFrame, shows: DataFrame, people: DataFrame, genres: DataFrame,
    day: dt.date, image_base: str,
) -> dict:
    """Load a day of feeds into the star schema and check that facts arrived."""
    kept_movies = clean.clean_titles(movies, MOVIE, "_position")
    kept_shows = clean.clean_titles(shows, TV, "_position")
    upsert_genres(warehouse, genres)
    # Shows share the dimension and come second, so a shared id keeps the show's row.
    upsert_movies(warehouse, movie_rows(kept_movies, MOVIE, image_base))
    upsert_movies(warehouse, movie_rows(kept_shows, TV, image_base))
    upsert_people(warehouse, deduplicate(person_rows(people, image_base), ["person_id"], [F.col("popularity")]))
    links = clean.concat_feeds(
        *[
            f.select(F.col("id").alias("movie_id"), F.explode("genre_ids").alias("genre_id"))
            for f in (kept_movies, kept_shows)
        ]
    )
    link(warehouse, "bridge_movie_genres", links)
    facts = warehouse.read("fact_daily_trends")
    earlier = facts.filter(F.col("date") < F.lit(str(day)).cast("date"))
    # The last charted day before this one: a single partition of the fact.
    previous = serving.on_latest(earlier)
    upsert_facts(warehouse, daily_facts({MOVIE: kept_movies, TV: kept_shows}, previous, day))
    counts = quality.load_counts(
        warehouse.read("fact_daily_trends"),
        warehouse.read("dim_movies"),
        warehouse.read("dim_genres"),
        F.lit(str(day)).cast("date"),
    ).first()
    quality.require_load(counts.asDict())
    return counts.asDict()


def weekly_refresh(warehouse: Warehouse, today: dt.date) -> int:
    """Recompute the weeks the last seven days fall in.

    Whole weeks are read, and the week before them as the base of the change, so
    a refresh in the middle of a week agrees with one at its end.
    """
    start = today - dt.timedelta(days=7)
    first = start - dt.timedelta(days=start.weekday())
    facts = serving.between_days(
        warehouse.read("fact_daily_trends"), F.lit(str(first - dt.timedelta(days=7))).cast("date")
    )
    weekly = rollups.week_over_week(rollups.weekly_summary(facts))
    fresh = weekly.filter(F.col("week_start") >= F.lit(str(first)).cast("date"))
    key = STAR_KEYS["agg_weekly_summary"]
    return warehouse.merge_checked("agg_weekly_summary", fresh, lambda old, new: merge.replace_by_key(old, new, key))


def monthly_refresh(warehouse: Warehouse, today: dt.date) -> int:
    """Recompute the genre statistics of last month."""
    facts = serving.last_month(warehouse.read("fact_daily_trends"), F.lit(str(today)).cast("date"))
    stats = rollups.monthly_genres(facts, warehouse.read("bridge_movie_genres"), warehouse.read("dim_movies"))
    key = STAR_KEYS["agg_monthly_genres"]
    return warehouse.merge_checked("agg_monthly_genres", stats, lambda old, new: merge.replace_by_key(old, new, key))


def enrich(warehouse: Warehouse, details: DataFrame, image_base: str, billed: int) -> dict:
    """Merge landed title details: finances, then cast members and their links."""
    titles = movie_rows(details, MOVIE, image_base)
    cast = landing.billed_cast(details.withColumnRenamed("id", "movie_id"), F.col("credits"), billed)
    people = deduplicate(cast.withColumn("profile_url", F.lit("")), ["person_id"], [F.col("popularity")])
    return {
        "movies": upsert_movies(warehouse, titles),
        "people": upsert_people(warehouse, people),
        "links": link(warehouse, "bridge_movie_cast", cast),
    }

