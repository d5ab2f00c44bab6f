"""Fleet queries over ``classes``, ``ships``, ``battles``, ``outcomes``.

A ship is known either from ``ships`` (with its class) or only from
``outcomes``; an outcome ship whose name is a class name is that class's lead
ship.  Queries that attach a class to an outcome therefore match
``classes.class = ships.class OR classes.class = outcomes.ship``; that OR join
is run as equi-joins by ``either_key_join``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions import dialect
from fathom.operators.aggregates import top_with_ties
from fathom.operators.asof import first_event_from
from fathom.operators.entities import every_ship
from fathom.operators.joins import either_key_join, not_in
from fathom.operators.setops import intersect_distinct, union_distinct
from fathom.plans.registry import query

# Parameters of the fleet queries (chosen for the value ranges of the views).
BATTLE = "B199701"
TREATY_YEAR = 1995
TREATY_TONS = 35000
PREFIX = "N"
KONGO = "NATION_5"
HOME = "ASIA"
ABSENT = "RUSSIA"

OUTCOME_CLASS_SQL = """
    FROM outcomes o
    LEFT JOIN ships s ON s.name = o.ship
    JOIN classes c ON c.class IN (s.class, o.ship)"""


def _prefixed_classes(v):
    return v.classes.select(*[F.col(c).alias(f"c_{c}") for c in v.classes.columns])


def outcome_classes(v, outs, how: str = "inner"):
    """``outs LEFT JOIN ships ON ship = name`` then classes on either key.

    Output: the columns of ``outs`` plus ``s_class`` and ``c_*`` class columns.
    """
    s = v.ships.select(F.col("name").alias("s_name"), F.col("class").alias("s_class"))
    left = outs.join(s, outs["ship"] == s["s_name"], "left").drop("s_name")
    # classes has one row per nation (bounded), so it is broadcast.
    return either_key_join(left, _prefixed_classes(v), ["s_class", "ship"], "c_class", how, broadcast_right=True)


def _losses(v):
    """Sunk outcomes counted per ship (map-side) before the joins: one row per ship and class, with n."""
    sunk = v.outcomes.filter(F.col("result") == "sunk").groupBy("ship").agg(F.count(F.lit(1)).alias("n"))
    return outcome_classes(v, sunk)


def maybe(cond, col):
    """Predicate that also accepts an unknown (NULL) value."""
    return cond | col.isNull()


@query(
    "e14_join_filter",
    sql="SELECT s.class, s.name, c.country FROM ships s JOIN classes c ON c.class = s.class WHERE c.numGuns >= 10",
)
def e14_join_filter(v):
    """Class, name and country of ships with at least ten guns."""
    big = v.classes.filter(F.col("numGuns") >= 10).select("class", "country")
    return v.ships.join(big, "class").select("class", "name", "country")


@query("e31_filter_class", sql="SELECT class, country FROM classes WHERE bore >= 16")
def e31_filter_class(v):
    """Classes with a bore of at least 16."""
    return v.classes.filter(F.col("bore") >= 16).select("class", "country")


@query(
    "e32_avg_pow",
    sql="""
    WITH fleet AS (SELECT name, class FROM ships UNION SELECT ship, ship FROM outcomes)
    SELECT c.country, CAST(avg(power(c.bore, 3) * 0.5) AS DECIMAL(6,2)) AS mw
    FROM fleet f JOIN classes c ON c.class = f.class
    GROUP BY c.country""",
)
def e32_avg_pow(v):
    """Mean of bore^3 / 2 over all ships of each country, two decimals."""
    fleet = every_ship(v.ships, v.outcome_ships, v.classes).join(v.classes.select("class", "country", "bore"), "class")
    mw = F.avg(dialect.power(F.col("bore"), 3) * F.lit(0.5)).cast("decimal(6,2)")
    return fleet.groupBy("country").agg(mw.alias("mw"))


@query("e33_two_preds", sql=f"SELECT ship FROM outcomes WHERE result = 'sunk' AND battle = '{BATTLE}'")
def e33_two_preds(v):
    """Ships sunk in one battle."""
    return v.outcomes_of(BATTLE).filter(F.col("result") == "sunk").select("ship")


@query(
    "e34_using_filter",
    sql=f"""
    SELECT DISTINCT s.name FROM ships s
    WHERE s.launched >= {TREATY_YEAR}
      AND s.class IN (SELECT class FROM classes WHERE type = 'bb' AND displacement > {TREATY_TONS})""",
)
def e34_using_filter(v):
    """Battleships launched from a year on, heavier than a limit."""
    heavy = v.classes.filter((F.col("displacement") > TREATY_TONS) & (F.col("type") == "bb")).select("class")
    return v.ships.filter(F.col("launched") >= TREATY_YEAR).join(heavy, "class").select("name").distinct()


@query(
    "e36_union_in",
    sql="""
    SELECT name FROM ships WHERE name = class
    UNION
    SELECT o.ship FROM outcomes o JOIN classes c ON c.class = o.ship""",
)
def e36_union_in(v):
    """Lead ships (named like their class) from both tables."""
    listed = v.ships.filter(F.col("name") == F.col("class")).select("name")
    known = v.classes.select(F.col("class").alias("ship"))
    fought = v.outcome_ships.join(known, "ship", "left_semi")
    return union_distinct(listed, fought)


@query(
    "e37_union_having",
    sql="""
    WITH fleet AS (SELECT name, class FROM ships UNION SELECT ship, ship FROM outcomes)
    SELECT c.class FROM classes c JOIN fleet f ON f.class = c.class
    GROUP BY c.class HAVING count(f.name) = 1""",
)
def e37_union_having(v):
    """Classes with exactly one ship, counting ships known only from outcomes."""
    fleet = every_ship(v.ships, v.outcome_ships, v.classes)
    return fleet.groupBy("class").agg(F.count("name").alias("n")).filter(F.col("n") == 1).select("class")


@query(
    "e38_intersect_type",
    sql="""
    SELECT country FROM classes GROUP BY country
    HAVING count(CASE WHEN type = 'bb' THEN 1 END) > 0 AND count(CASE WHEN type = 'bc' THEN 1 END) > 0""",
)
def e38_intersect_type(v):
    """Countries that had both battleship and cruiser classes."""
    c = v.classes
    return intersect_distinct(
        c.filter(F.col("type") == "bb").select("country"), c.filter(F.col("type") == "bc").select("country")
    )


@query(
    "e39_later_battle",
    sql="""
    SELECT DISTINCT o.ship
    FROM outcomes o JOIN battles b ON b.name = o.battle
    WHERE o.result = 'damaged'
      AND EXISTS (SELECT 1 FROM outcomes o2 JOIN battles b2 ON b2.name = o2.battle
                  WHERE o2.ship = o.ship AND b2.date > b.date)""",
)
def e39_later_battle(v):
    """Ships damaged in a battle that fought again in a later one.

    "Some damage date < some battle date of the same ship" is
    ``min(damage date) < max(battle date)`` per ship: one grouped aggregate
    with map-side combine, instead of a self join whose output grows with
    the square of a ship's number of battles.
    """
    dated = v.outcomes.join(v.battles.select(F.col("name").alias("battle"), "date"), "battle")
    per_ship = dated.groupBy("ship").agg(
        F.min(F.when(F.col("result") == "damaged", F.col("date"))).alias("first_damage"),
        F.max("date").alias("last_battle"),
    )
    return per_ship.filter(F.col("first_damage") < F.col("last_battle")).select("ship")


@query("e42_sunk", sql="SELECT ship, battle FROM outcomes WHERE result = 'sunk'")
def e42_sunk(v):
    """Sunk ships and the battle they were sunk in."""
    return v.outcomes.filter(F.col("result") == "sunk").select("ship", "battle")


@query(
    "e43_not_in",
    sql="""
    SELECT b.name FROM battles b
    WHERE year(b.date) NOT IN (SELECT s.launched FROM ships s WHERE s.launched IS NOT NULL)""",
)
def e43_not_in(v):
    """Battles in years in which no ship was launched (null-aware NOT IN)."""
    launched = v.ships.filter(F.col("launched").isNotNull()).select("launched")
    return not_in(v.battles, dialect.year_of(F.col("date")), launched, "launched").select("name")


def _names_like(v, pattern: str):
    listed = v.ships.filter(F.col("name").like(pattern)).select("name")
    fought = v.outcome_ships.filter(F.col("ship").like(pattern))
    return union_distinct(listed, fought)


@query(
    "e44_prefix",
    sql=f"SELECT name FROM ships WHERE name LIKE '{PREFIX}%' UNION SELECT ship FROM outcomes WHERE ship LIKE '{PREFIX}%'",
)
def e44_prefix(v):
    """All ship names starting with a letter (prefix LIKE, pushed to the scan)."""
    return _names_like(v, f"{PREFIX}%")


@query(
    "e45_three_words",
    sql="SELECT name FROM ships WHERE name LIKE '% % %' UNION SELECT ship FROM outcomes WHERE ship LIKE '% % %'",
)
def e45_three_words(v):
    """Ship names of three or more words."""
    return _names_like(v, "% % %")


@query(
    "e46_either_key_left",
    sql=f"""
    SELECT o.ship, c.displacement, c.numGuns
    FROM outcomes o
    LEFT JOIN ships s ON s.name = o.ship
    LEFT JOIN classes c ON c.class IN (s.class, o.ship)
    WHERE o.battle = '{BATTLE}'""",
)
def e46_either_key_left(v):
    """Displacement and guns of every ship in one battle (either-key LEFT JOIN)."""
    outs = v.outcomes_of(BATTLE).select("ship")
    joined = outcome_classes(v, outs, how="left")
    return joined.select("ship", F.col("c_displacement").alias("displacement"), F.col("c_numGuns").alias("numGuns"))


@query(
    "e47_all_lost",
    sql=f"""
    SELECT country FROM (
      SELECT c.country, 1 AS owned, 0 AS lost FROM classes c JOIN (SELECT name, class FROM ships UNION SELECT ship, ship FROM outcomes) f ON f.class = c.class
      UNION ALL
      SELECT c.country, 0, 1 {OUTCOME_CLASS_SQL} WHERE o.result = 'sunk') t
    GROUP BY country HAVING sum(lost) > 0 AND sum(owned) = sum(lost)""",
)
def e47_all_lost(v):
    """Countries whose number of sunk ships equals their number of ships."""
    fleet = every_ship(v.ships, v.outcome_ships, v.classes).join(v.classes.select("class", "country"), "class")
    fleet_by_country = fleet.groupBy("country").agg(F.count(F.lit(1)).alias("number"))
    sunk_by_country = _losses(v).groupBy(F.col("c_country").alias("country")).agg(F.sum("n").alias("number"))
    return intersect_distinct(sunk_by_country, fleet_by_country).select("country")


@query(
    "e48_class_sunk",
    sql=f"SELECT DISTINCT c.class {OUTCOME_CLASS_SQL} WHERE o.result = 'sunk'",
)
def e48_class_sunk(v):
    """Classes with at least one sunk ship.

    Only the set of classes is asked for, so sunk ships are made distinct
    (map-side) before they are joined to ships and classes.
    """
    sunk = outcome_classes(v, v.outcomes.filter(F.col("result") == "sunk").select("ship").distinct())
    return sunk.select(F.col("c_class").alias("class")).distinct()


@query(
    "e49_bore16",
    sql="""
    SELECT s.name FROM ships s WHERE s.class IN (SELECT class FROM classes WHERE bore = 16)
    UNION
    SELECT o.ship FROM outcomes o WHERE o.ship IN (SELECT class FROM classes WHERE bore = 16)""",
)
def e49_bore16(v):
    """Names of ships with 16-inch guns, from both tables."""
    big = v.classes.filter(F.col("bore") == 16).select("class")
    listed = v.ships.join(big, "class").select("name")
    fought = v.outcome_ships.join(big, F.col("ship") == F.col("class")).select("class")
    return union_distinct(listed, fought)


@query(
    "e50_battles_of_class",
    sql=f"SELECT DISTINCT o.battle FROM outcomes o WHERE o.ship IN (SELECT name FROM ships WHERE class = '{KONGO}')",
)
def e50_battles_of_class(v):
    """Battles fought by ships of one class."""
    members = v.ships.filter(F.col("class") == KONGO).select(F.col("name").alias("ship"))
    return v.outcomes.join(members, "ship").select("battle").distinct()


@query(
    "e51_group_max",
    sql="""
    SELECT ship FROM (
      SELECT DISTINCT f.name AS ship, k.displacement, k.numGuns, max(k.numGuns) OVER (PARTITION BY k.displacement) AS most
      FROM classes k JOIN (SELECT name, class FROM ships UNION SELECT ship, ship FROM outcomes) f ON f.class = k.class) x
    WHERE numGuns = most AND displacement IS NOT NULL""",
)
def e51_group_max(v):
    """Ships with the most guns among ships of the same displacement.

    Top-with-ties per displacement as aggregate + join-back: displacement has
    a handful of values, so a window partitioned by it would put whole
    fleets into single tasks; the per-displacement maxima are a few rows.
    """
    c = v.classes.select("class", "displacement", "numGuns")
    fought = v.outcome_ships.join(c, F.col("ship") == F.col("class")).select("ship", "displacement", "numGuns")
    listed = v.ships.join(c, "class").select(F.col("name").alias("ship"), "displacement", "numGuns")
    fleet = union_distinct(fought, listed)
    # Displacement values come from classes (one per nation at most).
    return top_with_ties(fleet, "numGuns", by=["displacement"], few_groups=True).select("ship")


@query(
    "e52_maybe",
    sql=f"""
    SELECT s.name FROM ships s JOIN classes c ON c.class = s.class
    WHERE c.country = '{HOME}' AND c.type = 'bb'
      AND coalesce(c.numGuns >= 9, true)
      AND coalesce(c.bore < 17, true)
      AND coalesce(c.displacement <= 42000, true)""",
)
def e52_maybe(v):
    """Ships that may satisfy limits when unknown values count as possible."""
    c = v.classes
    ok = c.filter(
        (F.col("country") == HOME)
        & maybe(F.col("numGuns") >= 9, F.col("numGuns"))
        & maybe(F.col("bore") < 17, F.col("bore"))
        & maybe(F.col("displacement") <= 42000, F.col("displacement"))
        & (F.col("type") == "bb")
    ).select("class")
    return v.ships.join(ok, "class").select("name")


@query(
    "e53_avg_numeric",
    sql="SELECT CAST(sum(numGuns) * 1.0 / count(numGuns) AS DECIMAL(4,2)) AS avg_guns FROM classes WHERE type = 'bb'",
)
def e53_avg_numeric(v):
    """Mean number of guns of battleship classes as NUMERIC(4,2).

    The mean is taken without integer truncation (a double mean of integer
    inputs is exact up to the final rounding) and cast once to (4,2).
    """
    return v.classes.filter(F.col("type") == "bb").agg(F.avg("numGuns").cast("decimal(4,2)").alias("avg_guns"))


@query(
    "e54_avg_union",
    sql="""
    SELECT CAST(avg(k.numGuns) AS DECIMAL(4,2)) AS avg_guns
    FROM (SELECT name, class FROM ships UNION SELECT ship, ship FROM outcomes) f JOIN classes k ON k.class = f.class AND k.type = 'bb'""",
)
def e54_avg_union(v):
    """Mean number of guns over all battleships, lead ships from outcomes included."""
    bb = v.classes.filter(F.col("type") == "bb").select("class", "type", "numGuns")
    fought = v.outcome_ships.join(bb, F.col("ship") == F.col("class")).select("class", "ship", "type", "numGuns")
    listed = v.ships.join(bb, "class").select("class", "name", "type", "numGuns")
    return union_distinct(fought, listed).agg(F.avg("numGuns").cast("decimal(4,2)").alias("avg_guns"))


@query(
    "e55_min_launch",
    sql="""
    SELECT c.class, (SELECT min(s.launched) FROM ships s WHERE s.class = c.class) AS min_launched
    FROM classes c""",
)
def e55_min_launch(v):
    """Earliest launch year per class (the SQL as written: a plain MIN).

    The second LEFT JOIN of the SQL only repeats rows, which cannot change a
    MIN, so ships are aggregated per class first and joined to classes once.
    """
    first = v.ships.groupBy("class").agg(F.min("launched").alias("min_launched"))
    return v.classes.select("class").join(first, "class", "left")


@query(
    "e55_task",
    sql="""
    SELECT c.class,
           coalesce((SELECT s.launched FROM ships s WHERE s.class = c.class AND s.name = c.class),
                    (SELECT min(s.launched) FROM ships s WHERE s.class = c.class)) AS launch_year
    FROM classes c""",
)
def e55_task(v):
    """Launch year of each class's lead ship, else the earliest of the class."""
    per = v.ships.groupBy("class").agg(
        F.max(F.when(F.col("name") == F.col("class"), F.col("launched"))).alias("lead"),
        F.min("launched").alias("first"),
    )
    joined = v.classes.select("class").join(per, "class", "left")
    return joined.select("class", F.coalesce("lead", "first").alias("launch_year"))


@query(
    "e56_count_sunk",
    sql="""
    SELECT c.class, count(DISTINCT o.ship) AS sunk_ships
    FROM classes c
    LEFT JOIN ships s ON s.class = c.class
    LEFT JOIN (SELECT ship FROM outcomes WHERE result = 'sunk') o ON o.ship IN (s.name, c.class)
    GROUP BY c.class""",
)
def e56_count_sunk(v):
    """Number of sunk ships per class, 0 kept.

    A class's sunk ships are those named like one of its ships or like the
    class itself.  Both routes are equi-joins against the distinct sunk
    ships; their union is counted per class and joined back to all classes.
    """
    sunk = v.outcomes.filter(F.col("result") == "sunk").select("ship").distinct()
    by_member = v.ships.select("name", "class").join(sunk, F.col("name") == F.col("ship")).select("class", "ship")
    by_class = v.classes.select("class").join(sunk, F.col("class") == F.col("ship")).select("class", "ship")
    counts = by_member.unionByName(by_class).groupBy("class").agg(F.count_distinct("ship").alias("sunk_ships"))
    joined = v.classes.select("class").join(counts, "class", "left")
    return joined.select("class", F.coalesce(F.col("sunk_ships"), F.lit(0).cast("long")).alias("sunk_ships"))


@query(
    "e57_sunk_of_three",
    sql="""
    SELECT class, losses FROM (
      SELECT k.class,
             (SELECT count(*) FROM outcomes o LEFT JOIN ships s ON s.name = o.ship
              WHERE o.result = 'sunk' AND (k.class = s.class OR k.class = o.ship)) AS losses,
             (SELECT count(*) FROM (SELECT name, class FROM ships UNION SELECT ship, ship FROM outcomes) f WHERE f.class = k.class) AS members
      FROM classes k) t
    WHERE losses > 0 AND members >= 3""",
)
def e57_sunk_of_three(v):
    """Classes with losses and at least three ships: class, number sunk."""
    fleet = every_ship(v.ships, v.outcome_ships, v.classes)
    big = fleet.groupBy("class").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= 3).select("class")
    per = _losses(v).groupBy(F.col("c_class").alias("class")).agg(F.sum("n").alias("losses"))
    # ``big`` holds known classes only (fleet is restricted to classes): one row per nation at most.
    return per.join(F.broadcast(big), "class", "left_semi")


@query(
    "e70_three_of_country",
    sql=f"""
    SELECT DISTINCT battle FROM (
      SELECT o.battle, c.country, count(DISTINCT o.ship) AS n {OUTCOME_CLASS_SQL}
      GROUP BY o.battle, c.country) t
    WHERE n >= 3""",
)
def e70_three_of_country(v):
    """Battles with at least three ships of one country."""
    part = outcome_classes(v, v.outcomes.select("ship", "battle"))
    per = part.groupBy("battle", "c_country").agg(F.count_distinct("ship").alias("n"))
    return per.filter(F.col("n") >= 3).select("battle").distinct()


@query(
    "e73_absent_battles",
    sql=f"""
    SELECT c.country, b.name AS battle FROM (SELECT DISTINCT country FROM classes) c, battles b
    EXCEPT
    SELECT DISTINCT c.country, o.battle {OUTCOME_CLASS_SQL}""",
)
def e73_absent_battles(v):
    """(country, battle) pairs where no ship of the country took part.

    The answer ranges over the country x battle grid.  Countries are the
    domain of ``classes.country`` (one per class at most); they travel as one
    scalar array, are exploded per battle, and the present pairs are removed
    with an anti join.
    """
    countries = v.classes.agg(F.array_sort(F.collect_set("country"))).scalar()
    grid = v.battles.select(F.explode(countries).alias("country"), F.col("name").alias("battle"))
    present = outcome_classes(v, v.outcomes.select("ship", "battle")).select(
        F.col("c_country").alias("country"), "battle"
    )
    # Distinct before the join: at most one row per pair and task is shuffled.
    return grid.join(present.distinct(), ["country", "battle"], "left_anti")


def _fallback(v, country: str):
    c = v.classes
    has_country = c.filter(F.col("country") == country).exists()
    return c.filter((F.col("country") == country) | ~has_country).select("country", "class")


@query(
    "e74_fallback",
    sql=f"""
    SELECT country, class FROM classes
    WHERE country = '{HOME}' OR NOT EXISTS (SELECT 1 FROM classes WHERE country = '{HOME}')""",
)
def e74_fallback(v):
    """Classes of one country, or of all countries when it has none (present)."""
    return _fallback(v, HOME)


@query(
    "e74_fallback_absent",
    sql=f"""
    SELECT country, class FROM classes
    WHERE country = '{ABSENT}' OR NOT EXISTS (SELECT 1 FROM classes WHERE country = '{ABSENT}')""",
)
def e74_fallback_absent(v):
    """Same query for a country without classes: every class is returned."""
    return _fallback(v, ABSENT)


@query(
    "e75_asof_forward",
    sql="""
    SELECT s.name, s.launched,
      CASE WHEN s.launched IS NULL THEN (SELECT name FROM battles ORDER BY date DESC LIMIT 1)
           ELSE (SELECT b.name FROM battles b WHERE year(b.date) >= s.launched ORDER BY b.date LIMIT 1)
      END AS battle
    FROM ships s""",
)
def e75_asof_forward(v):
    """Per ship: first battle in or after its launch year; latest battle when
    the year is unknown; NULL when no battle is late enough.

    Forward as-of on the year: distinct launch years are mapped to their
    first battle (``first_event_from`` works on distinct years only), then
    ships equi-join that small map.
    """
    ships = v.ships.select("name", "launched")
    battles = v.battles.select(F.col("name").alias("battle"), "date", dialect.year_of(F.col("date")).alias("year"))
    year_map = first_event_from(ships, "launched", battles, "year", "battle", "date")
    latest = v.battles.agg(F.max_by("name", "date")).scalar()
    # The map has one row per distinct launch year; AQE measures it and
    # broadcasts it, or splits the skewed years.
    joined = ships.join(year_map, "launched", "left")
    chosen = F.when(F.col("launched").isNull(), latest).otherwise(F.col("battle"))
    return joined.select("name", "launched", chosen.alias("battle"))
