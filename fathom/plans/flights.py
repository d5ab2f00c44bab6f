"""Flight queries over ``trip``, ``pass_in_trip``, ``passenger``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fathom.functions import dialect
from fathom.operators.aggregates import top_with_ties
from fathom.operators.calendar import calendar_fill, date_spine
from fathom.plans.registry import query

# Parameters: the week and the departure town of the calendar query.
WEEK_START = dt.date(1997, 1, 1)
WEEK_END = dt.date(1997, 1, 7)
TOWN = "NATION_5"
# The same days as the text that the trips are selected by.
WEEK_FROM, WEEK_TO = "01/01/1997", "07/01/1997"
DAY_MINUTES = 1440


@query(
    "e63_same_seat",
    sql="""
    SELECT p.name FROM passenger p
    WHERE EXISTS (SELECT 1 FROM pass_in_trip t WHERE t.id_psg = p.id_psg GROUP BY t.place HAVING count(*) > 1)""",
)
def e63_same_seat(v):
    """Passengers who sat on the same seat more than once."""
    repeat = v.pass_in_trip.groupBy("id_psg", "place").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return v.passenger.join(repeat.select("id_psg"), "id_psg", "left_semi").select("name")


def _week_trips(v):
    return v.trip.filter(F.col("date").between(dialect.day_of(F.lit(WEEK_FROM)), dialect.day_of(F.lit(WEEK_TO))) & (F.col("town_from") == TOWN)).select(
        "trip_no", "date"
    )


def _fill_week(v, counts):
    return calendar_fill(date_spine(v.spark, WEEK_START, WEEK_END, "date"), counts, "date", "departures", 0)


@query(
    "e66_calendar",
    sql=f"""
    SELECT CAST(w.day AS DATE) AS date,
           (SELECT count(*) FROM trip f
            WHERE f.date = CAST(w.day AS DATE) AND f.town_from = '{TOWN}'
              AND f.trip_no IN (SELECT p.trip_no FROM pass_in_trip p)) AS departures
    FROM (SELECT unnest(generate_series(TIMESTAMP '{WEEK_START}', TIMESTAMP '{WEEK_END}', INTERVAL 1 DAY)) AS day) w""",
)
def e66_calendar(v):
    """Flights with passengers leaving a town on each day of a week, 0 filled.

    The week's trips, the small side, stand on the right of the join, so that
    AQE can broadcast them and the passenger list is not shuffled; a trip's
    passengers then meet in a distinct count, combined map-side.
    """
    flown = v.pass_in_trip.select("trip_no").join(_week_trips(v), "trip_no")
    counts = flown.groupBy("date").agg(F.count_distinct("trip_no").alias("departures"))
    return _fill_week(v, counts)


@query(
    "e66_task",
    sql=f"""
    SELECT CAST(w.day AS DATE) AS date,
           (SELECT count(*) FROM trip f WHERE f.date = CAST(w.day AS DATE) AND f.town_from = '{TOWN}') AS departures
    FROM (SELECT unnest(generate_series(TIMESTAMP '{WEEK_START}', TIMESTAMP '{WEEK_END}', INTERVAL 1 DAY)) AS day) w""",
)
def e66_task(v):
    """Flights leaving a town on each day of a week, with or without passengers."""
    counts = _week_trips(v).groupBy("date").agg(F.count_distinct("trip_no").alias("departures"))
    return _fill_week(v, counts)


def _top_route_count(routes):
    """How many routes have the largest flight count.

    One pass: routes are counted per flight count, and the count belonging
    to the largest flight count is picked by ``max_by`` (flight counts are
    unique after that grouping).  A global aggregate always yields one row;
    no routes at all gives 0, as ``count(*)`` does in SQL.
    """
    per_count = routes.groupBy("flights").agg(F.count(F.lit(1)).alias("qty"))
    return per_count.agg(F.coalesce(F.max_by("qty", "flights"), F.lit(0).cast("long")).alias("qty"))


@query(
    "e67_top_routes",
    sql="""
    SELECT count(*) AS qty FROM (
      SELECT count(DISTINCT trip_no) AS n, max(count(DISTINCT trip_no)) OVER () AS top
      FROM trip GROUP BY town_from, town_to) r
    WHERE r.n = r.top""",
)
def e67_top_routes(v):
    """Number of directed routes served by the most flights."""
    routes = v.trip.groupBy("town_from", "town_to").agg(F.count_distinct("trip_no").alias("flights"))
    return _top_route_count(routes)


@query(
    "e68_top_routes_undirected",
    sql="""
    SELECT count(*) AS qty FROM (
      SELECT count(DISTINCT trip_no) AS n, max(count(DISTINCT trip_no)) OVER () AS top
      FROM trip
      GROUP BY CASE WHEN town_from > town_to THEN town_from ELSE town_to END,
               CASE WHEN town_from < town_to THEN town_from ELSE town_to END) r
    WHERE r.n = r.top""",
)
def e68_top_routes_undirected(v):
    """Same, with A-B and B-A counted as one route (IIF keys, NULL-exact)."""
    a, b = F.col("town_from"), F.col("town_to")
    routes = v.trip.groupBy(dialect.iif(a > b, a, b).alias("hi"), dialect.iif(a < b, a, b).alias("lo")).agg(
        F.count_distinct("trip_no").alias("flights")
    )
    return _top_route_count(routes)


@query(
    "e72_loyal_top",
    sql="""
    WITH per AS (
      SELECT p.id_psg, count(*) AS flights
      FROM pass_in_trip p JOIN trip t ON p.trip_no = t.trip_no
      GROUP BY p.id_psg HAVING count(DISTINCT t.id_comp) = 1)
    SELECT ps.name, per.flights FROM per JOIN passenger ps ON per.id_psg = ps.id_psg
    WHERE per.flights = (SELECT max(flights) FROM per)""",
)
def e72_loyal_top(v):
    """Among passengers who flew with one company only, those with the most
    flights (ties kept): name, number of flights."""
    flights = v.pass_in_trip.select("trip_no", "id_psg").join(v.trip_legs.select("trip_no", "id_comp"), "trip_no")
    per = flights.groupBy("id_psg").agg(
        F.count_distinct("id_comp").alias("companies"), F.count(F.lit(1)).alias("flights")
    )
    # The maximum reads the same exchange by passenger as the filter does.
    loyal = per.filter(F.col("companies") == 1).select("id_psg", "flights")
    return top_with_ties(loyal, "flights").join(v.passenger, "id_psg").select("name", "flights")


@query(
    "e76_flight_minutes",
    sql=f"""
    SELECT ps.name, x.minutes FROM (
      SELECT p.id_psg,
             CAST(sum(CASE WHEN t.min_in >= t.min_out THEN t.min_in - t.min_out
                           ELSE t.min_in - t.min_out + {DAY_MINUTES} END) AS BIGINT) AS minutes
      FROM pass_in_trip p JOIN trip t ON p.trip_no = t.trip_no
      GROUP BY p.id_psg HAVING count(*) = count(DISTINCT p.place)) x
    JOIN passenger ps ON x.id_psg = ps.id_psg""",
)
def e76_flight_minutes(v):
    """Minutes in the air of passengers who never sat on the same seat twice.

    A flight landing before its departure time of day lands the next day.
    """
    t = v.trip_legs
    span = F.col("min_in") - F.col("min_out")
    minutes = F.when(F.col("min_in") >= F.col("min_out"), span).otherwise(span + DAY_MINUTES)
    flights = v.pass_in_trip.join(t.select("trip_no", minutes.alias("minutes")), "trip_no")
    per = flights.groupBy("id_psg").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("place").alias("seats"), F.sum("minutes").alias("minutes")
    )
    never_twice = per.filter(F.col("n") == F.col("seats")).select("id_psg", "minutes")
    return never_twice.join(v.passenger, "id_psg").select("name", "minutes")
