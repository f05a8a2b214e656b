"""Registered queries: what each covers, its Spark form and its SQL form."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from marquee.plans.model import Tables


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    covers: tuple[str, ...]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Register a function over the tables under its own name."""

    def add(build: Callable[[Tables], DataFrame]):
        if build.__name__ in REGISTRY:
            raise ValueError(f"{build.__name__} is registered twice")
        REGISTRY[build.__name__] = Query(build, tuple(covers.split()), sql)
        return build

    return add


# --- SQL fragments of the model, written independently of the Spark expressions ---


def half_up(numerator: str, denominator: str, digits: int) -> str:
    """Exact quotient in integer arithmetic, rounded half away from zero."""
    n, d = f"cast({numerator} as hugeint)", f"cast({denominator} as hugeint)"
    whole = f"cast(sign({n}) * sign({d}) as hugeint) * ((2 * abs({n}) * {10**digits} + abs({d})) // (2 * abs({d})))"
    return f"(case when {d} <> 0 then cast({whole} as double) / {10**digits}e0 end)"


def exact(value: str) -> str:
    """Twelve places of a double, from its shortest form; none of an infinite one."""
    return f"try_cast(cast({value} as varchar) as decimal(38,12))"


def units(value: str) -> str:
    """The same as a whole number of UNIT-ths."""
    return f"cast(replace(cast({exact(value)} as varchar), '.', '') as hugeint)"


def rounded(total: str, count: str, digits: int) -> str:
    """Average of summed units, as a whole number of 10**-digits."""
    return f"cast((2 * ({total}) * {10**digits} + ({count}) * {UNIT}) // (2 * ({count}) * {UNIT}) as hugeint)"


UNIT = 10**12
CHART = f"""
chart as (
  select user_id as movie_id, event_type as media_type, cast(ts as date) as date,
         sum({units("value")}) as units, sum({exact("value")}) as total, count({exact("value")}) as rated, count(*) as vote_count
  from events group by 1, 2, 3),
scored as (
  select * exclude (total), cast(cast(total as varchar) as double) as popularity,
         case when rated > 0 then {rounded("units", "rated", 6)} end / 1e6 as vote_average,
         case when rated > 0 then {rounded("units", "rated", 6)} * 1000000 end as score_units
  from chart),
fact as (
  select *, dense_rank() over (partition by date order by units desc) as position from scored)"""

WORDS = """
words as (
  select distinct p_partkey as movie_id, unnest(string_split(p_name, ' ')) as genre_name from part),
genres as (
  select distinct cast(('0x' || substr(md5(genre_name), 1, 8))::bigint & 2147483647 as integer) as genre_id,
         genre_name as name from words),
bridge as (select movie_id, genre_id from words join genres on name = genre_name)"""

CONTENT = f"""{CHART},
content as (
  select movie_id as id, p_name as title, string_split(p_name, ' ') as genres, media_type, date as extraction_date,
         units, popularity, score_units, vote_average, vote_count
  from scored left join part on p_partkey = movie_id)"""

MONEY = f"""
sold as (
  select l_partkey, min(cast(l_shipdate as date)) as release_date, sum(cast(l_quantity as bigint)) as pieces,
         sum(cast(cast(l_extendedprice as varchar) as decimal(20,6)) * cast(1 - cast(l_discount as decimal(4,2)) as decimal(4,2))) as income
  from lineitem group by 1),
money as (
  select l_partkey as movie_id, release_date,
         cast(floor(cast(cast(p_retailprice as varchar) as decimal(16,6)) * cast(pieces as decimal(18,0))) as bigint) as budget,
         cast(floor(income) as bigint) as revenue
  from sold join part on p_partkey = l_partkey),
movies as (
  select p_partkey as movie_id, p_name as title, lower(p_type) as original_language, p_brand as overview,
         release_date, p_size as runtime, coalesce(budget, 0) as budget, coalesce(revenue, 0) as revenue,
         case when budget > 0 then {half_up("(revenue - budget) * 100", "budget", 1)} end as roi,
         'https://images.example.org/t/w500/' || p_partkey || '.jpg' as poster_url
  from part left join money on movie_id = p_partkey)"""

SALES = f"""
sales as (
  select l_partkey as movie_id, cast(l_shipdate as date) as date,
         {units("l_extendedprice")} as units, l_extendedprice as price, {units("l_quantity")} as quantity
  from lineitem)"""

CAST = """
cast_links as (
  select l_partkey as movie_id, l_suppkey as person_id, min(l_linenumber) as cast_order from lineitem group by 1, 2)"""
