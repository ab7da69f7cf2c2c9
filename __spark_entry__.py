
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velomart import fixtures
from velomart.functions.checksum import checksum_sql
from velomart.functions.dates import mixed_date, month_bucket
from velomart.functions.names import last_segment
from velomart.operators import enrich, filters, pairs
from velomart.plans.mart import build_mart, land_mart
from velomart.plans import rollups
from velomart.plans.publish import published, run_all
from velomart.plans.reports import REPORTS, preview
from velomart.schema import TRIP_FILE
from velomart.sinks import pairs as sinks_pairs
from velomart.sinks.mart import by_month, write_mart
from velomart.sinks.reports import parquet_sink
from velomart.sources.archives import unpack_archives
from velomart.sources.mart import read_extremes, read_mart
from velomart.sources.pages import extract_links
from velomart.sources.rescue import read_trips_with_faults
from velomart.sources.trips import classify_files, read_stations, read_trips, trip_parts
from velomart.workspace import fresh_path, materialize, scope

try:
    import corpus_pipeline
    import velomart.llm.queries as llm
except ModuleNotFoundError as missing:  # the subpackage may be left out as a whole
    if missing.name not in ("corpus_pipeline", "velomart.llm", "velomart.llm.queries"):
        raise
    llm = corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Share of trips below their station pair's average, per bike type."""
    return queries()["r14"](spark, "/root/testdata/sf0.001")


def _report(key: str, **options) -> Query:
    return lambda spark, sf: REPORTS[key].build(fixtures.trips(spark, sf), **options)


def _preview(key: str, **options) -> Query:
    """The first rows in reading order, as the report's user sees them."""
    report = _report(key, **options)
    return lambda spark, sf: preview(report(spark, sf), key)


def _over_trips(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: operator(fixtures.trips(spark, sf))


def _scan_trips(spark: SparkSession, sf: str) -> DataFrame:
    return read_trips(spark, fixtures.export_trips(spark, sf))


def _scan_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Every row of damaged files, with what is wrong with it."""
    found = read_trips_with_faults(spark, fixtures.export_damaged(spark, sf), header=False)
    return found.select("trip_id", "duration", "start_station", "bike_type", "fault")


def _scan_recent(spark: SparkSession, sf: str) -> DataFrame:
    return read_trips(spark, fixtures.recent_files(fixtures.export_trips(spark, sf)))


def _scan_stations(spark: SparkSession, sf: str) -> DataFrame:
    return read_stations(
        spark, fixtures.export_stations(fixtures.supplier_stations(spark, sf))
    )


def _scan_archives(spark: SparkSession, sf: str) -> DataFrame:
    return unpack_archives(fixtures.archives(spark, sf), TRIP_FILE, kind="trips")


def _classify(spark: SparkSession, sf: str) -> DataFrame:
    return classify_files(fixtures.file_paths(spark, sf)).drop("path")


def _links(spark: SparkSession, sf: str) -> DataFrame:
    return extract_links(fixtures.table(spark, sf, "pages"), "nav")


def _links_by_class(spark: SparkSession, sf: str) -> DataFrame:
    return extract_links(fixtures.classed_pages(spark, sf), "nav", "menu")


def _url_file_name(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.table(spark, sf, "pages").select(
        "page_id", last_segment(F.col("url")).alias("file_name")
    )


def _mixed_dates(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.mixed_times(spark, sf).select(
        "o_orderkey", mixed_date(F.col("s")).alias("d")
    )


def _mart_files(spark: SparkSession, sf: str) -> tuple[str, str]:
    # Read twice in whole files of the size of one task's rows, so that nothing has to split them.
    folder = fixtures.export_trips(spark, sf, compression="lz4")
    return folder, fixtures.export_stations(fixtures.station_table(spark, sf))


def _built(spark: SparkSession, sf: str) -> DataFrame:
    folder, stations = _mart_files(spark, sf)
    return build_mart(
        read_trips(spark, folder),
        read_trips(spark, fixtures.recent_files(folder)),
        read_stations(spark, stations),
    )


def _sink_mart(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "mart")
    write_mart(_built(spark, sf), path)
    return read_mart(spark, path)


def _join_bike_type(spark: SparkSession, sf: str) -> DataFrame:
    trips = fixtures.trips(spark, sf)
    return enrich.join_bike_type(
        trips.select("trip_id", "bike_id"), fixtures.recent(trips)
    )


def _join_stations(spark: SparkSession, sf: str) -> DataFrame:
    trips = fixtures.raw_trips(spark, sf)
    return enrich.join_stations(
        trips.select("trip_id", "start_station", "end_station"),
        fixtures.station_table(spark, sf),
    )


def _mart_extremes(spark: SparkSession, sf: str) -> DataFrame:
    """A mart written whole, then its months from 1995 on written again by themselves."""
    path = fresh_path(spark, "mart")
    with scope(spark):
        built = materialize(by_month(_built(spark, sf)), "built")
        write_mart(built, path, dealt=True)
        later = built.filter(F.col("start_station_time") >= F.lit("1995-01-01").cast("date"))
        write_mart(later.filter("duration > 5"), path, keep_other_months=True, dealt=True)
    return read_extremes(spark, path)


def _run_all(spark: SparkSession, sf: str) -> DataFrame:
    """Publish everything from a landed mart: rows and checksum of what was published."""
    folder = fresh_path(spark, "reports")
    mart = fresh_path(spark, "mart")
    with scope(spark):  # the trip files go before the reports are made
        files, stations = _mart_files(spark, sf)
        land_mart(
            read_trips(spark, files),
            trip_parts(spark, files),
            read_trips(spark, fixtures.recent_files(files)),
            read_stations(spark, stations),
            mart,
        )
    with scope(spark):
        tables = run_all(
            read_mart(spark, mart), parquet_sink(folder), pass_type=fixtures.PASS_TYPE
        )
    return published(spark, folder, tables)


def _laid_out(spark: SparkSession, sf: str) -> sinks_pairs.PairLayout:
    path = fresh_path(spark, "pairs")
    return sinks_pairs.write_pairs(fixtures.trips(spark, sf), path.rsplit("/", 1)[1].replace("-", "_"), path)


def _laid_averages(spark: SparkSession, sf: str) -> DataFrame:
    """Report 13 over trips laid out by their pair of stations."""
    rows = sinks_pairs.with_averages(spark, _laid_out(spark, sf))
    return rows.select(*pairs.PAIR, "avg", "duration", "bike_type")


def _laid_shares(spark: SparkSession, sf: str) -> DataFrame:
    return _percentages(
        pairs.shares_of(sinks_pairs.with_averages(spark, _laid_out(spark, sf), "left"))
    )


def _percentages(shares: DataFrame) -> DataFrame:
    return shares.select(
        "bike_type",
        (F.col("below") * 100 / F.col("total")).alias("delay_percentage"),
        (F.col("not_below") * 100 / F.col("total")).alias("good_percentage"),
    )


def _shared_bikes(spark: SparkSession, sf: str) -> DataFrame:
    """Bikes by type and by category, both from one table of bitmaps."""
    maps = rollups.bike_bitmaps(fixtures.trips(spark, sf))
    by_type = rollups.bikes_by_type_month(maps).withColumnRenamed("bike_type", "value")
    by_category = rollups.bikes_by_category_month(maps).withColumnRenamed(
        "trip_route_category", "value"
    )
    return by_type.withColumn("kind", F.lit("type")).unionByName(
        by_category.withColumn("kind", F.lit("category"))
    )


def queries() -> dict[str, Query]:
    """One entry per operator; each callable takes (spark, sf_dir)."""
    more = {**llm.queries(), "pipeline": corpus_pipeline.run} if llm else {}
    return {**_own_queries(), **more}


def _own_queries() -> dict[str, Query]:
    reports = {key: _report(key) for key in REPORTS}
    reports["r3"] = _report("r3", pass_type=fixtures.PASS_TYPE)
    return {
        **reports,
        "preview_r3": _preview("r3", pass_type=fixtures.PASS_TYPE),
        "preview_r6": _preview("r6"),
        "preview_r8": _preview("r8"),
        "preview_r13": _preview("r13"),
        "pair_shares": _over_trips(
            lambda t: _percentages(pairs.shares_around_average(t))
        ),
        "r13_laid_out": _laid_averages,
        "pair_shares_laid_out": _laid_shares,
        "scan_trips": _scan_trips,
        "scan_faults": _scan_faults,
        "scan_recent": _scan_recent,
        "scan_stations": _scan_stations,
        "scan_archives": _scan_archives,
        "classify_files": _classify,
        "extract_links": _links,
        "extract_links_class": _links_by_class,
        "url_file_name": _url_file_name,
        "build_mart": _built,
        "sink_mart": _sink_mart,
        "mart_extremes": _mart_extremes,
        "run_all": _run_all,
        "bikes_shared": _shared_bikes,
        "parse_mixed_dates": _mixed_dates,
        "month_bucket": _over_trips(
            lambda t: t.select(
                "trip_id",
                month_bucket(F.col("start_station_time")).alias("month_year"),
            )
        ),
        "filter_pass_type": _over_trips(
            lambda t: t.filter(F.col("passholder_type") == fixtures.PASS_TYPE).select(
                "trip_id", "passholder_type"
            )
        ),
        "filter_not_null": _over_trips(
            lambda t: t.filter(F.col("trip_route_category").isNotNull()).select(
                "trip_id", "trip_route_category"
            )
        ),
        "filter_at_max": _over_trips(
            lambda t: filters.at_max(t, "duration").select(
                "trip_id", "start_station", "duration"
            )
        ),
        "filter_at_min": _over_trips(
            lambda t: filters.at_min(t, "duration").select(
                "trip_id", "start_station", "duration"
            )
        ),
        "join_bike_type": _join_bike_type,
        "join_stations": _join_stations,
        "agg_count": _over_trips(
            lambda t: t.groupBy("passholder_type").agg(
                F.count("trip_id").alias("n_trips"),
                F.count("duration").alias("n_durations"),
                F.count("trip_route_category").alias("n_categories"),
            )
        ),
        "agg_count_distinct": _over_trips(
            lambda t: t.groupBy("passholder_type").agg(
                F.count_distinct("bike_id").alias("n_bikes")
            )
        ),
        "agg_sum": _over_trips(
            lambda t: t.groupBy("start_station").agg(
                F.sum("duration").alias("total_duration")
            )
        ),
        "agg_avg": _over_trips(
            lambda t: t.groupBy("start_station_name", "bike_type").agg(
                F.avg("duration").alias("avg_duration")
            )
        ),
        "agg_min_max": _over_trips(
            lambda t: t.agg(
                F.min("duration").alias("min_duration"),
                F.max("duration").alias("max_duration"),
            )
        ),
        "distinct_pairs": _over_trips(enrich.bike_types),
    }


_TRIPS = """with trips as (
select l.l_orderkey*10+l.l_linenumber as trip_id,
       nullif(cast(l.l_quantity as int),13) as duration,
       cast(o.o_orderdate as date) as start_station_time,
       cast(l.l_shipdate as date) as end_station_time,
       s.s_nationkey as start_station, ns.n_name as start_station_name,
       c.c_nationkey as end_station, ne.n_name as end_station_name,
       l.l_partkey as bike_id, p.p_type as bike_type,
       c.c_mktsegment as passholder_type,
       nullif(l.l_returnflag,'N') as trip_route_category
from lineitem l
join orders o on l.l_orderkey=o.o_orderkey
join part p on l.l_partkey=p.p_partkey
join supplier s on l.l_suppkey=s.s_suppkey
join customer c on o.o_custkey=c.c_custkey
join nation ns on s.s_nationkey=ns.n_nationkey
join nation ne on c.c_nationkey=ne.n_nationkey)
"""

# The rows of the exported trip files: times are text in one of two formats or
# in neither.
_RAW = """with raw as (
select l.l_orderkey*10+l.l_linenumber as trip_id,
       nullif(cast(l.l_quantity as int),13) as duration,
       case when l.l_orderkey%3=0 then strftime(o.o_orderdate,'%Y-%m-%d %H:%M:%S')
            when l.l_orderkey%3=1 then strftime(o.o_orderdate,'%-m/%-d/%Y %-H:%M')
            else 'bad' end as start_time,
       case when l.l_orderkey%3=0 then strftime(l.l_shipdate,'%Y-%m-%d %H:%M:%S')
            when l.l_orderkey%3=1 then strftime(l.l_shipdate,'%-m/%-d/%Y %-H:%M')
            else 'bad' end as end_time,
       s.s_nationkey as start_station,
       cast(s.s_nationkey as double)*0.5 as start_lat,
       cast(s.s_nationkey as double)*-0.25 as start_lon,
       c.c_nationkey as end_station,
       cast(c.c_nationkey as double)*0.5 as end_lat,
       cast(c.c_nationkey as double)*-0.25 as end_lon,
       cast(l.l_partkey as varchar) as bike_id,
       l.l_linenumber as plan_duration,
       nullif(l.l_returnflag,'N') as trip_route_category,
       c.c_mktsegment as passholder_type, p.p_type as bike_type,
       o.o_orderdate as ordered_at
from lineitem l
join orders o on l.l_orderkey=o.o_orderkey
join part p on l.l_partkey=p.p_partkey
join supplier s on l.l_suppkey=s.s_suppkey
join customer c on o.o_custkey=c.c_custkey)
"""

_BUILT = (
    _RAW
    + """, trips as (
select r.trip_id, r.duration, r.start_station, r.start_lat, r.start_lon,
       r.end_station, r.end_lat, r.end_lon, r.bike_id, r.plan_duration,
       r.trip_route_category, r.passholder_type,
       cast(coalesce(try_strptime(r.start_time,'%Y-%m-%d %H:%M:%S'),
                     try_strptime(r.start_time,'%m/%d/%Y %H:%M')) as date)
         as start_station_time,
       cast(coalesce(try_strptime(r.end_time,'%Y-%m-%d %H:%M:%S'),
                     try_strptime(r.end_time,'%m/%d/%Y %H:%M')) as date)
         as end_station_time,
       k.bike_type, ns.n_name as start_station_name, ne.n_name as end_station_name
from raw r
join (select distinct bike_id, bike_type from raw
      where ordered_at >= timestamp '2001-01-01') k on r.bike_id=k.bike_id
join nation ns on r.start_station=ns.n_nationkey
join nation ne on r.end_station=ne.n_nationkey)
"""
)

_MONTH = "cast(date_trunc('month',start_station_time) as date)"

_DETAIL = (
    "start_station,start_station_name,start_station_time,end_station,"
    "end_station_name,end_station_time,duration,passholder_type,bike_type"
)

_NAMED = "start_station_name is not null and end_station_name is not null"

_AROUND = f"""select bike_type, duration,
       avg(duration) over (partition by start_station_name,end_station_name) as avg
from trips where {_NAMED}"""


_LINKS = """select page_id, pos, href from (
select page_id, cast(i-1 as integer) as pos,
       regexp_extract(l[i],'(?s)<a [^>]*href="([^"]*)"',1) as href
from (select page_id, l, unnest(range(1,len(l)+1)) as i
      from (select page_id,
                   regexp_extract_all(
                     regexp_extract(html,'(?s)<nav>(.*?)</nav>',1),
                     '(?s)<li>(.*?)</li>',1) as l
            from pages) y) x) z
where href <> ''"""


def _share(comparison: str, name: str) -> str:
    return f"""select g.bike_type, g.n*100/t.total as {name}
from (select bike_type,count(*) as n from ({_AROUND}) x
      where duration {comparison} avg group by 1) g
join (select bike_type,count(*) as total from trips group by 1) t
  on g.bike_type=t.bike_type"""


def _extreme(function: str) -> str:
    return f"duration=(select {function}(duration) from trips)"


def _report_sql() -> dict[str, str]:
    """The reports over a relation ``trips``."""
    return {
        "r1": f"""select {_MONTH} as month_year, count(trip_id) as total_trip
from trips group by 1""",
        "r2": f"""select {_MONTH} as month_year, passholder_type as pass_type,
       count(trip_id) as trip_count
from trips group by 1,2""",
        "r3": f"""select {_MONTH} as month_year, start_station, start_station_name,
       count(trip_id) as monthly_pass_total
from trips where passholder_type='MACHINERY' group by 1,2,3""",
        "r4": f"""select start_station, start_station_name,
       count(trip_id) as "No_of_LongDuration_ride"
from trips where {_extreme("max")} group by 1,2
order by 3 desc, 1, 2 limit 5""",
        "r5": f"""select {_MONTH} as month_year, bike_type,
       count(distinct bike_id) as total_bike
from trips group by 1,2""",
        "r6": f"""select trip_route_category, count(distinct bike_id) as total_bike,
       {_MONTH} as month_year
from trips where trip_route_category is not null group by 1,3""",
        "r7": """select bike_type, trip_route_category, count(trip_id) as total_trip
from trips where trip_route_category is not null group by 1,2""",
        "r8": """select bike_type, cast(sum(duration) as bigint) as total_duration
from trips group by 1""",
        "r9": f"""select distinct {_DETAIL} from trips where {_extreme("max")}
order by {_DETAIL.replace(",", " nulls last,")} nulls last limit 5""",
        "r10": f"""select distinct {_DETAIL} from trips where {_extreme("min")}
order by {_DETAIL.replace(",", " nulls last,")} nulls last limit 5""",
        "r11": """select start_station_name, start_station, bike_type,
       count(bike_id) as total_bike
from trips group by 1,2,3
order by total_bike desc, start_station, bike_type, start_station_name limit 10""",
        "r12": """select distinct start_station_name, end_station_name, bike_type
from trips""",
        "r13": f"""select t.start_station_name, t.end_station_name, a.avg,
       t.duration, t.bike_type
from trips t
join (select start_station_name, end_station_name, avg(duration) as avg
      from trips where {_NAMED} group by 1,2) a
  on t.start_station_name=a.start_station_name
 and t.end_station_name=a.end_station_name""",
        "r14": _share("<", "delay_percentage"),
        "r15": _share(">=", "good_percentage"),
        "r16": """select start_station, end_station, min(duration) as min_duration
from trips group by 1,2""",
    }


# Columns of the published tables; fractions are compared in millionths.
_REPORT_COLUMNS = {
    "r1": "month_year total_trip",
    "r2": "month_year pass_type trip_count",
    "r3": "month_year start_station start_station_name monthly_pass_total",
    "r4": "start_station start_station_name No_of_LongDuration_ride",
    "r5": "month_year bike_type total_bike",
    "r6": "trip_route_category total_bike month_year",
    "r7": "bike_type trip_route_category total_trip",
    "r8": "bike_type total_duration",
    "r9": _DETAIL.replace(",", " "),
    "r10": _DETAIL.replace(",", " "),
    "r11": "start_station_name start_station bike_type total_bike",
    "r12": "start_station_name end_station_name bike_type",
    "r13": "start_station_name end_station_name avg duration bike_type",
    "r14": "bike_type delay_percentage",
    "r15": "bike_type good_percentage",
    "r16": "start_station end_station min_duration",
}
_FRACTIONS = ("avg", "delay_percentage", "good_percentage")


def _preview_sql() -> dict[str, str]:
    """The first twenty rows in reading order, ties ordered by all columns."""
    order = {
        "r3": "monthly_pass_total desc, month_year, start_station, start_station_name",
        "r6": "total_bike desc, trip_route_category, month_year",
        "r8": "total_duration desc, bike_type",
        "r13": "start_station_name, end_station_name, avg, duration, bike_type",
    }
    reports = _report_sql()
    return {
        f"preview_{key}": f"select * from ({reports[key]}) x order by {keys.replace(',', ' nulls last,')} nulls last limit 20"
        for key, keys in order.items()
    }


def oracle_sql() -> dict[str, str]:
    """For each query that SQL can express, SQL that gives the same rows from the same tables."""
    return {**_own_sql(), **(llm.oracle_sql() if llm else {})}


def _own_sql() -> dict[str, str]:
    over_trips = {
        **_report_sql(),
        **_preview_sql(),
        "pair_shares": """select bike_type, n_lt*100/total as delay_percentage,
       n_ge*100/total as good_percentage
from (select t.bike_type, count_if(t.duration<a.avg) as n_lt,
             count_if(t.duration>=a.avg) as n_ge, count(*) as total
      from trips t
      left join (select start_station_name, end_station_name, avg(duration) as avg
                 from trips group by 1,2) a
        on t.start_station_name=a.start_station_name
       and t.end_station_name=a.end_station_name
      group by 1) g""",
        "month_bucket": f"select trip_id, {_MONTH} as month_year from trips",
        "filter_pass_type": """select trip_id, passholder_type from trips
where passholder_type='MACHINERY'""",
        "filter_not_null": """select trip_id, trip_route_category from trips
where trip_route_category is not null""",
        "filter_at_max": f"""select trip_id, start_station, duration from trips
where {_extreme("max")}""",
        "filter_at_min": f"""select trip_id, start_station, duration from trips
where {_extreme("min")}""",
        "join_bike_type": """select t.trip_id, t.bike_id, k.bike_type from trips t
join (select distinct bike_id, bike_type from trips
      where start_station_time >= date '2001-01-01') k on t.bike_id=k.bike_id""",
        "join_stations": """select trip_id, start_station, end_station,
       start_station_name, end_station_name
from trips""",
        "agg_count": """select passholder_type, count(trip_id) as n_trips,
       count(duration) as n_durations, count(trip_route_category) as n_categories
from trips group by 1""",
        "agg_count_distinct": """select passholder_type,
       count(distinct bike_id) as n_bikes
from trips group by 1""",
        "agg_sum": """select start_station,
       cast(sum(duration) as bigint) as total_duration
from trips group by 1""",
        "agg_avg": """select start_station_name, bike_type,
       avg(duration) as avg_duration
from trips group by 1,2""",
        "agg_min_max": """select min(duration) as min_duration,
       max(duration) as max_duration
from trips""",
        "distinct_pairs": "select distinct bike_id, bike_type from trips",
        "bikes_shared": f"""select 'type' as kind, bike_type as value, {_MONTH} as month_year,
       count(distinct bike_id) as total_bike
from trips group by 2,3
union all
select 'category', trip_route_category, {_MONTH}, count(distinct bike_id)
from trips where trip_route_category is not null group by 2,3""",
    }
    over_trips["r13_laid_out"] = over_trips["r13"]
    over_trips["pair_shares_laid_out"] = over_trips["pair_shares"]
    checksums = "\nunion all ".join(
        f"select '{key}' as report, * from ({checksum_sql(sql, _REPORT_COLUMNS[key].split(), _FRACTIONS)}) {key}"
        for key, sql in _report_sql().items()
    )
    return {
        **{key: _TRIPS + sql for key, sql in over_trips.items()},
        "scan_trips": _RAW + "select * exclude (ordered_at) from raw",
        "scan_faults": _RAW
        + """select trip_id,
       case when trip_id%97<>0 then duration end as duration,
       case when trip_id%89=0 or trip_id%83<>0 then start_station end as start_station,
       case when trip_id%89=0 or (trip_id%83<>0 and trip_id%7<>0) then bike_type end as bike_type,
       case when trip_id%89=0 then 'surplus_field' when trip_id%83=0 then 'short_row'
            when trip_id%97=0 then 'bad_value' end as fault
from raw""",
        "scan_recent": _RAW
        + """select * exclude (ordered_at) from raw
where ordered_at >= timestamp '2001-01-01'""",
        "scan_archives": _RAW + "select * exclude (ordered_at) from raw",
        "scan_stations": """select cast(s_suppkey as int) as station_id,
       s_name as station_name, '2016-07-07' as station_date, n_name as station_type,
       case when s_acctbal < 0 then 'Inactive' else 'Active' end as current_status
from supplier join nation on s_nationkey=n_nationkey""",
        "build_mart": _BUILT + "select * from trips",
        "sink_mart": _BUILT + f"select *, {_MONTH} as month_year from trips",
        "mart_extremes": _BUILT
        + f"""select {_MONTH} as month_year, min(duration) as least, max(duration) as greatest,
       count(*) as trips
from trips
where start_station_time < date '1995-01-01' or start_station_time is null or duration > 5
group by 1""",
        "run_all": _BUILT + checksums,
        "classify_files": """select o_orderkey, file_name,
       case when contains(lower(file_name),'q')
            then case when contains(lower(file_name),'.csv') then 'trips' end
            when contains(file_name,'.csv') then 'stations' end as kind
from (select o_orderkey,
             case o_orderkey%6
               when 0 then 'trips-'||year(o_orderdate)||'-q'||quarter(o_orderdate)||'.csv'
               when 1 then 'TRIPS-'||year(o_orderdate)||'-Q'||quarter(o_orderdate)||'.CSV'
               when 2 then 'stations-'||year(o_orderdate)||'.csv'
               when 3 then 'stations-'||year(o_orderdate)||'.CSV'
               when 4 then 'readme-q'||quarter(o_orderdate)||'.txt'
               else 'notes-'||year(o_orderdate)||'.txt' end as file_name
      from orders) x""",
        "extract_links": _LINKS,
        "extract_links_class": _LINKS,
        "url_file_name": """select page_id, string_split(url,'/')[-1] as file_name
from pages""",
        "parse_mixed_dates": """select o_orderkey,
       cast(coalesce(try_strptime(s,'%Y-%m-%d %H:%M:%S'),
                     try_strptime(s,'%m/%d/%Y %H:%M')) as date) as d
from (select o_orderkey,
             case when o_orderkey%3=0 then strftime(o_orderdate,'%Y-%m-%d %H:%M:%S')
                  when o_orderkey%3=1 then strftime(o_orderdate,'%-m/%-d/%Y %-H:%M')
                  else 'bad' end as s
      from orders) x""",
    }
