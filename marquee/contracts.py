"""Schemas, keys and fixed values shared by the layers."""

from __future__ import annotations

from dataclasses import dataclass

MOVIE, TV, PERSON = "movie", "tv", "person"

# Landing folders, and the media type each one holds.
FEEDS = {"trending_movies": MOVIE, "trending_tv": TV, "trending_people": PERSON}

# Columns a raw record must have.
REQUIRED = {
    MOVIE: ["id", "title", "popularity", "vote_average", "vote_count", "release_date", "genre_ids"],
    TV: ["id", "name", "popularity", "vote_average", "vote_count", "first_air_date", "genre_ids"],
    PERSON: ["id", "name", "popularity", "known_for_department"],
}
REQUIRED_IN_RECORD = ["id", "_source", "_extracted_at"]

# Genre ids of the source catalogue.
GENRES = {
    12: "Adventure",
    14: "Fantasy",
    16: "Animation",
    18: "Drama",
    27: "Horror",
    28: "Action",
    35: "Comedy",
    36: "History",
    37: "Western",
    53: "Thriller",
    80: "Crime",
    99: "Documentary",
    878: "Science Fiction",
    9648: "Mystery",
    10402: "Music",
    10749: "Romance",
    10751: "Family",
    10752: "War",
    10759: "Action & Adventure",
    10762: "Kids",
    10763: "News",
    10764: "Reality",
    10765: "Sci-Fi & Fantasy",
    10766: "Soap",
    10767: "Talk",
    10768: "War & Politics",
    10770: "TV Movie",
}

# Image sizes, defaults and limits.
POSTER_SIZE, BACKDROP_SIZE, PROFILE_SIZE = "w500", "w1280", "w185"
NO_OVERVIEW = "No overview available"
SCORE_RANGE = (0, 10)
JDBC_BATCH_ROWS = 5000
PAGE_ROWS = 20
BILLED_CAST = 10
SHOWN_CAST = 15
ENRICH_TITLES = 50

_CONTENT = """id bigint, {title} string, original_language string, overview string, {day} string,
popularity string, vote_average string, vote_count string, genre_ids array<int>,
poster_path string, backdrop_path string, budget string, revenue string, _corrupt_record string"""

# Schemas are DDL text, readable without a session.
# Numbers and dates land as text, so one bad value cannot spoil its record; casting is a later step.
RAW_SCHEMAS = {
    MOVIE: _CONTENT.format(title="title", day="release_date"),
    TV: _CONTENT.format(title="name", day="first_air_date"),
    PERSON: (
        "id bigint, name string, popularity string, known_for_department string, "
        "profile_path string, _corrupt_record string"
    ),
}

CREDITS_SCHEMA = (
    "id bigint, credits struct<cast: array<struct<id: bigint, name: string, character: string, order: int, "
    "known_for_department: string, popularity: double>>>"
)
RESPONSE_SCHEMA = "results array<struct<id: bigint, title: string, name: string, popularity: double>>"

# Columns of the unified content, and bronze columns silver does not keep.
UNIFIED_COLUMNS = [
    "id",
    "title",
    "popularity",
    "vote_average",
    "vote_count",
    "release_date",
    "genres",
    "extraction_date",
    "media_type",
    "_ingested_at",
    "_source",
    "_batch_id",
]

SILVER_DROPS = ["_file_path", "_row_num", "_corrupt_record", "year", "month"]


@dataclass(frozen=True)
class Export:
    """Columns and key under which a mart leaves for the warehouse."""

    table: str
    key: tuple[str, ...]
    columns: tuple[str, ...]


# Names of the exported tables and columns. The keys carry media_type wherever a movie and a show may share an id.
EXPORTS = {
    "gold_daily_trends": Export(
        "daily_trends",
        ("id", "media_type", "extraction_date"),
        (
            "id", "title", "media_type", "popularity", "vote_average", "vote_count", "position", "prev_position",
            "position_change", "popularity_delta", "is_new_entry", "days_on_chart", "extraction_date",
        ),
    ),
    "gold_weekly_rankings": Export(
        "weekly_rankings",
        ("id", "media_type", "year_week"),
        (
            "id", "title", "media_type", "year_week", "weekly_rank", "avg_popularity", "peak_popularity",
            "avg_vote_average", "total_vote_count", "days_tracked",
        ),
    ),
    "gold_monthly_genre_stats": Export(
        "monthly_genre_stats",
        ("genre", "year_month"),
        (
            "genre", "year_month", "title_count", "avg_popularity", "avg_vote_average", "total_vote_count",
            "peak_popularity", "top_title",
        ),
    ),
    "gold_roi_analysis": Export(
        "roi_analysis",
        ("id", "genre"),
        (
            "id", "title", "genre", "budget", "revenue", "roi", "profit_margin_pct", "roi_genre_rank",
            "rolling_avg_roi", "release_date",
        ),
    ),
    "gold_rolling_averages": Export(
        "rolling_averages",
        ("id", "media_type", "extraction_date"),
        (
            "id", "title", "media_type", "popularity", "vote_average", "rolling_7d_avg_popularity",
            "rolling_7d_data_points", "rolling_30d_avg_vote_average", "rolling_30d_data_points",
            "rolling_7d_avg_vote_count", "extraction_date",
        ),
    ),
}

# Columns that part the marts.
GOLD_PARTITIONS = {
    "gold_daily_trends": ["extraction_date"],
    "gold_weekly_rankings": ["year_week"],
    "gold_monthly_genre_stats": ["year_month"],
    "gold_roi_analysis": [],
    "gold_rolling_averages": ["extraction_date"],
}

# Names and types of the star schema.
STAR_SCHEMA = {
    "dim_genres": "genre_id int, name string",
    "dim_movies": (
        "movie_id bigint, title string, original_language string, overview string, release_date date, runtime int, "
        "budget bigint, revenue bigint, roi double, poster_url string, backdrop_url string, updated_at timestamp"
    ),
    "dim_people": (
        "person_id bigint, name string, profile_url string, known_for_department string, popularity double, "
        "updated_at timestamp"
    ),
    "bridge_movie_genres": "movie_id bigint, genre_id int",
    "bridge_movie_cast": (
        "movie_id bigint, person_id bigint, character_name string, cast_order int"
    ),
    "fact_daily_trends": (
        "movie_id bigint, media_type string, date date, position int, position_change int, popularity double, "
        "vote_average double, vote_count int"
    ),
    "agg_weekly_summary": (
        "movie_id bigint, media_type string, week_start date, days_trending bigint, avg_position double, "
        "best_position int, avg_popularity double, popularity_change_pct double"
    ),
    "agg_monthly_genres": (
        "month date, genre_id int, trending_count bigint, avg_popularity double, avg_vote_average double, "
        "top_movie_id bigint, total_budget bigint, total_revenue bigint, avg_roi double"
    ),
}

# Keys of the star schema.
STAR_KEYS = {
    "dim_genres": ["genre_id"],
    "dim_movies": ["movie_id"],
    "dim_people": ["person_id"],
    "bridge_movie_genres": ["movie_id", "genre_id"],
    "bridge_movie_cast": ["movie_id", "person_id"],
    "fact_daily_trends": ["movie_id", "date", "media_type"],
    "agg_weekly_summary": ["movie_id", "media_type", "week_start"],
    "agg_monthly_genres": ["month", "genre_id"],
}

# Order in which a table is listed; ids settle ties.
LISTING_ORDER = {
    "dim_genres": [("name", "asc"), ("genre_id", "asc")],
    "dim_movies": [("updated_at", "desc"), ("movie_id", "asc")],
    "dim_people": [("popularity", "desc"), ("person_id", "asc")],
    "bridge_movie_cast": [("cast_order", "asc"), ("movie_id", "asc"), ("person_id", "asc")],
    "fact_daily_trends": [("date", "asc"), ("position", "asc"), ("media_type", "asc"), ("movie_id", "asc")],
    "agg_weekly_summary": [("week_start", "desc"), ("avg_position", "asc"), ("media_type", "asc"), ("movie_id", "asc")],
    "agg_monthly_genres": [("month", "desc"), ("trending_count", "desc"), ("genre_id", "asc")],
}

# Columns that must not be null, and what an absent value becomes.
NOT_NULL = {
    "dim_genres": ["genre_id", "name"],
    "dim_movies": ["movie_id", "title"],
    "dim_people": ["person_id", "name"],
    "bridge_movie_genres": ["movie_id", "genre_id"],
    "bridge_movie_cast": ["movie_id", "person_id"],
    "fact_daily_trends": ["media_type", "date", "position"],
    "agg_weekly_summary": ["week_start"],
    "agg_monthly_genres": ["month"],
}
DEFAULTS = {
    "dim_movies": {"original_language": "", "overview": "", "budget": 0, "revenue": 0, "poster_url": "", "backdrop_url": ""},
    "dim_people": {"profile_url": "", "known_for_department": "", "popularity": 0.0},
    "bridge_movie_cast": {"character_name": "", "cast_order": 0},
    "fact_daily_trends": {"position_change": 0, "popularity": 0.0, "vote_average": 0.0, "vote_count": 0},
    "agg_weekly_summary": {
        "media_type": "", "days_trending": 0, "avg_position": 0.0, "best_position": 0, "avg_popularity": 0.0,
        "popularity_change_pct": 0.0,
    },
    "agg_monthly_genres": {
        "trending_count": 0, "avg_popularity": 0.0, "avg_vote_average": 0.0, "total_budget": 0, "total_revenue": 0,
    },
}

# Fixed values: (table, column, parent table, parent column, on delete)
FOREIGN_KEYS = [
    ("bridge_movie_genres", "movie_id", "dim_movies", "movie_id", "cascade"),
    ("bridge_movie_genres", "genre_id", "dim_genres", "genre_id", "cascade"),
    ("bridge_movie_cast", "movie_id", "dim_movies", "movie_id", "cascade"),
    ("bridge_movie_cast", "person_id", "dim_people", "person_id", "cascade"),
    ("fact_daily_trends", "movie_id", "dim_movies", "movie_id", "cascade"),
    ("agg_weekly_summary", "movie_id", "dim_movies", "movie_id", "cascade"),
    ("agg_monthly_genres", "genre_id", "dim_genres", "genre_id", "cascade"),
    ("agg_monthly_genres", "top_movie_id", "dim_movies", "movie_id", "set null"),
]
