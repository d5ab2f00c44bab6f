"""Cash-point ledgers: ``income``/``outcome`` (many rows per day) and the
daily ``income_o``/``outcome_o`` (one row per point and day).

A cash point has few distinct values, so nothing here partitions raw ledger
rows by point alone: sums are combined map-side (partial aggregation) and
the only window runs over one row per (point, day).
Sums of money are reported as decimal(38,2).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fathom.functions import dialect
from fathom.operators.ledger import merge_ledgers, one_sided_days
from fathom.operators.windows import running_total
from fathom.plans.registry import query

# Parameter: the cut-off day (the text's 15/04/01 read as 15 April 2001).
CUTOFF = dt.date(2001, 4, 15)
CUTOFF_SQL = "DATE '2001-04-15'"
MONEY = "decimal(38,2)"


def _remain():
    return (F.coalesce(F.sum("inc"), F.lit(0)) - F.coalesce(F.sum("out"), F.lit(0))).cast(MONEY).alias("remain")


def _daily_moves(v, before: dt.date | None):
    """Both daily ledgers under one another: sums over them need no matching of days."""
    inc = v.income_o.select("point", "date", "inc", F.lit(None).cast("decimal(18,2)").alias("out"))
    out = v.outcome_o.select("point", "date", F.lit(None).cast("decimal(18,2)").alias("inc"), "out")
    moves = inc.unionByName(out)
    return moves if before is None else moves.filter(F.col("date") < F.lit(before))


@query(
    "e29_ledger_min",
    sql="""
    SELECT coalesce(i.point, o.point) AS point, coalesce(i.date, o.date) AS date, i.inc, o.out
    FROM income_o i FULL JOIN outcome_o o ON o.point = i.point AND o.date = i.date""",
)
def e29_ledger_min(v):
    """Daily ledgers merged into (point, date, inc, out) by a padded union."""
    return merge_ledgers(v.income_o, v.outcome_o, ["point", "date"], "inc", "out", agg=F.min)


@query(
    "e30_ledger_sum",
    sql="""
    WITH day_in AS (SELECT point, date, sum(inc) AS total FROM income GROUP BY point, date),
         day_out AS (SELECT point, date, sum(out) AS total FROM outcome GROUP BY point, date)
    SELECT coalesce(i.point, o.point) AS point, coalesce(i.date, o.date) AS date,
           CAST(o.total AS DECIMAL(38,2)) AS out, CAST(i.total AS DECIMAL(38,2)) AS inc
    FROM day_in i FULL JOIN day_out o ON o.point = i.point AND o.date = i.date""",
)
def e30_ledger_sum(v):
    """Per point and day: total outgo and total income, NULL when absent."""
    merged = merge_ledgers(v.income, v.outcome, ["point", "date"], "inc", "out")
    return merged.select("point", "date", F.col("out").cast(MONEY).alias("out"), F.col("inc").cast(MONEY).alias("inc"))


def _balance(v, key_expr):
    inc = v.income_o.groupBy("point").agg(F.sum("inc").alias("inc"))
    out = v.outcome_o.groupBy(F.col("point").alias("o_point")).agg(F.sum("out").alias("out"))
    joined = inc.join(out, inc["point"] == out["o_point"], "full")
    balance = dialect.isnull_default(F.col("inc"), 0) - dialect.isnull_default(F.col("out"), 0)
    return joined.select(key_expr.alias("point"), balance.cast(MONEY).alias("balance"))


@query(
    "e59_balance",
    sql="""
    WITH got AS (SELECT point, sum(inc) AS total FROM income_o GROUP BY point),
         paid AS (SELECT point, sum(out) AS total FROM outcome_o GROUP BY point)
    SELECT g.point, CAST(coalesce(g.total, 0) - coalesce(p.total, 0) AS DECIMAL(38,2)) AS balance
    FROM got g FULL JOIN paid p ON p.point = g.point""",
)
def e59_balance(v):
    """Balance per point; as written, the point comes from the income side
    (NULL for a point that only has outgo)."""
    return _balance(v, F.col("point"))


@query(
    "e59_task",
    sql="""
    WITH got AS (SELECT point, sum(inc) AS total FROM income_o GROUP BY point),
         paid AS (SELECT point, sum(out) AS total FROM outcome_o GROUP BY point)
    SELECT coalesce(g.point, p.point) AS point, CAST(coalesce(g.total, 0) - coalesce(p.total, 0) AS DECIMAL(38,2)) AS balance
    FROM got g FULL JOIN paid p ON p.point = g.point""",
)
def e59_task(v):
    """Balance per point with the point taken from whichever side has it."""
    return _balance(v, F.coalesce(F.col("point"), F.col("o_point")))


@query(
    "e60_balance_before",
    sql=f"""
    SELECT point, CAST(coalesce(sum(inc), 0) - coalesce(sum(out), 0) AS DECIMAL(38,2)) AS remain
    FROM (SELECT point, date, inc, NULL AS out FROM income_o
          UNION ALL
          SELECT point, date, NULL, out FROM outcome_o) moves
    WHERE date < {CUTOFF_SQL}
    GROUP BY point""",
)
def e60_balance_before(v):
    """Balance per point at the start of a day."""
    return _daily_moves(v, CUTOFF).groupBy("point").agg(_remain())


@query(
    "e61_total_balance",
    sql="""
    SELECT CAST(coalesce((SELECT sum(inc) FROM income_o), 0) - coalesce((SELECT sum(out) FROM outcome_o), 0)
                AS DECIMAL(38,2)) AS remain""",
)
def e61_total_balance(v):
    """One balance over all points."""
    return _daily_moves(v, None).agg(_remain())


@query(
    "e62_total_before",
    sql=f"""
    SELECT CAST(coalesce((SELECT sum(inc) FROM income_o WHERE date < {CUTOFF_SQL}), 0)
                - coalesce((SELECT sum(out) FROM outcome_o WHERE date < {CUTOFF_SQL}), 0) AS DECIMAL(38,2)) AS remain""",
)
def e62_total_before(v):
    """One balance over all points at the start of a day."""
    return _daily_moves(v, CUTOFF).agg(_remain())


@query(
    "e64_one_sided_days",
    sql="""
    WITH day_in AS (SELECT point, date, true AS present, sum(inc) AS total FROM income GROUP BY point, date),
         day_out AS (SELECT point, date, sum(out) AS total FROM outcome GROUP BY point, date)
    SELECT coalesce(i.point, o.point) AS point, coalesce(i.date, o.date) AS date,
           CASE WHEN i.present THEN 'inc' ELSE 'out' END AS side,
           CAST(coalesce(i.total, o.total) AS DECIMAL(38,2)) AS amount
    FROM day_in i FULL JOIN day_out o ON o.point = i.point AND o.date = i.date
    WHERE i.total IS NULL OR o.total IS NULL""",
)
def e64_one_sided_days(v):
    """Days on which a point had income but no outgo, or the reverse."""
    days = one_sided_days(v.income, v.outcome, ["point", "date"], "inc", "out")
    return days.select("point", "date", "side", F.col("amount").cast(MONEY).alias("amount"))


@query(
    "e69_running_balance",
    sql="""
    WITH days AS (
      SELECT u.point, u.date, sum(u.net) AS net
      FROM (SELECT point, date, 0 - out AS net FROM outcome UNION ALL SELECT point, date, inc FROM income) u
      GROUP BY u.point, u.date)
    SELECT d.point, strftime(d.date, '%d/%m/%Y') AS day,
           CAST((SELECT sum(e.net) FROM days e WHERE e.point = d.point AND e.date <= d.date) AS DECIMAL(38,2)) AS balance
    FROM days d
    ORDER BY point, day""",
)
def e69_running_balance(v):
    """Balance of each point at the end of every day with operations,
    day as dd/mm/yyyy text, sorted by (point, day text)."""
    moves = v.income.select("point", "date", F.col("inc").alias("rev")).unionByName(
        v.outcome.select("point", "date", (-F.col("out")).alias("rev"))
    )
    balance = running_total(moves, "point", "date", "rev", "balance")
    return balance.select("point", dialect.day_text(F.col("date")).alias("day"), F.col("balance").cast(MONEY).alias("balance")).orderBy(
        "point", "day"
    )
