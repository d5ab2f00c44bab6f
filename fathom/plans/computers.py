"""Computer-catalog queries over ``product``, ``pc``, ``laptop``, ``printer``.

Money is decimal(18,2).  Averages of money are an exact decimal sum and a
count, divided once as doubles, so the mean does not depend on the order of
summation (nor on the engine).
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fathom.functions import dialect
from fathom.operators.aggregates import divides, null_poisoned_max, top_with_ties
from fathom.operators.pairs import pairs_within
from fathom.operators.setops import except_distinct, union_all, union_distinct
from fathom.operators.shares import share_of_group
from fathom.operators.subquery import filter_all
from fathom.operators.windows import global_row_number
from fathom.plans.registry import query

# Parameters of the catalog queries (chosen for the value ranges of the views).
CHEAP = 960
PRICEY = 960
MAKER = "Brand#1-0"
FAST = 750


def _avg_money(col: str, name: str):
    return F.try_divide(F.sum(col).cast("double"), F.count(col)).alias(name)


def _models_of(v, maker: str):
    return v.product.filter(F.col("maker") == maker).select("model")


@query("e01_filter", sql=f"SELECT model, speed, hd FROM pc WHERE price < {CHEAP}")
def e01_filter(v):
    """PCs under a price: model, speed, hd."""
    return v.pc.filter(F.col("price") < CHEAP).select("model", "speed", "hd")


@query("e02_distinct", sql="SELECT DISTINCT maker FROM product WHERE type = 'Printer'")
def e02_distinct(v):
    """Makers of printers."""
    return v.product.filter(F.col("type") == "Printer").select("maker").distinct()


@query("e03_filter_gt", sql=f"SELECT model, ram, screen FROM laptop WHERE price > {PRICEY}")
def e03_filter_gt(v):
    """Laptops over a price: model, ram, screen."""
    return v.laptop.filter(F.col("price") > PRICEY).select("model", "ram", "screen")


@query("e04_select_all", sql="SELECT * FROM printer WHERE color = 'y'")
def e04_select_all(v):
    """All columns of colour printers."""
    return v.printer.filter(F.col("color") == "y")


@query(
    "e05_in_list",
    sql=f"SELECT model, speed, hd FROM pc WHERE cd IN ('12x', '24x') AND price < {CHEAP}",
)
def e05_in_list(v):
    """PCs with a 12x or 24x CD under a price."""
    return v.pc.filter(F.col("cd").isin("12x", "24x") & (F.col("price") < CHEAP)).select("model", "speed", "hd")


@query(
    "e06_join_distinct",
    sql="SELECT DISTINCT p.maker, l.speed FROM laptop l JOIN product p ON p.model = l.model WHERE l.hd >= 10",
)
def e06_join_distinct(v):
    """Maker and speed of laptops with a disk of at least 10."""
    big = v.laptop.filter(F.col("hd") >= 10).select("model", "speed")
    return v.product.join(big, "model").select("maker", "speed").distinct()


@query(
    "e07_union_join",
    sql=f"""
    SELECT DISTINCT u.model, u.price
    FROM product p JOIN (SELECT model, price FROM pc UNION ALL SELECT model, price FROM laptop
                         UNION ALL SELECT model, price FROM printer) u ON u.model = p.model
    WHERE p.maker = '{MAKER}'""",
)
def e07_union_join(v):
    """Model and price of every product of one maker.

    The maker filter is applied to each branch (a semi join on the maker's
    models; ``model`` is the product key) before the UNION, so the distinct
    runs over one maker's rows, not over the whole catalog.
    """
    models = _models_of(v, MAKER)
    branches = [t.select("model", "price").join(models, "model", "left_semi") for t in (v.pc, v.laptop, v.printer)]
    return union_distinct(*branches)


@query(
    "e08_except",
    sql="SELECT maker FROM product WHERE type = 'PC' EXCEPT SELECT maker FROM product WHERE lower(type) = 'laptop'",
)
def e08_except(v):
    """Makers of PCs but not of laptops (type compared case-insensitively)."""
    pcs = v.product.filter(F.col("type") == "PC").select("maker")
    laptops = v.product.filter(dialect.ci_equals(F.col("type"), "laptop")).select("maker")
    return except_distinct(pcs, laptops)


def _fast_pc_makers(v, speed: int):
    fast = v.pc.filter(F.col("speed") >= speed).select("model")
    return v.product.join(fast, "model").select("maker").distinct()


@query(
    "e09_join_subquery",
    sql="SELECT DISTINCT p.maker FROM product p JOIN pc c ON c.model = p.model WHERE c.speed >= 800",
)
def e09_join_subquery(v):
    """Makers of PCs with speed >= 800 (the threshold as written in the SQL)."""
    return _fast_pc_makers(v, 800)


@query(
    "e09_task",
    sql="SELECT DISTINCT p.maker FROM product p JOIN pc c ON c.model = p.model WHERE c.speed >= 900",
)
def e09_task(v):
    """Makers of PCs with speed >= 900 (the threshold the task text asks for)."""
    return _fast_pc_makers(v, 900)


@query(
    "e10_in_max",
    sql="SELECT model, price FROM printer WHERE price = (SELECT max(price) FROM printer)",
)
def e10_in_max(v):
    """Printers at the maximum price, ties kept."""
    return top_with_ties(v.printer.select("model", "price"), "price")


@query("e11_avg", sql="SELECT avg(speed) AS avg_speed FROM pc")
def e11_avg(v):
    """Mean PC speed."""
    return v.pc.agg(F.avg("speed").alias("avg_speed"))


@query("e12_avg_filter", sql=f"SELECT avg(speed) AS avg_speed FROM laptop WHERE price > {PRICEY}")
def e12_avg_filter(v):
    """Mean speed of laptops over a price."""
    return v.laptop.filter(F.col("price") > PRICEY).agg(F.avg("speed").alias("avg_speed"))


@query(
    "e13_avg_join",
    sql=f"""
    SELECT avg(c.speed) AS avg_speed
    FROM pc c WHERE c.model IN (SELECT model FROM product WHERE maker = '{MAKER}')""",
)
def e13_avg_join(v):
    """Mean PC speed of one maker (join, filter, global average)."""
    return v.pc.join(_models_of(v, MAKER), "model").agg(F.avg("speed").alias("avg_speed"))


@query(
    "e15_having",
    sql="SELECT hd FROM pc GROUP BY hd HAVING count(code) > 1",
)
def e15_having(v):
    """Disk sizes shared by at least two PCs."""
    return v.pc.groupBy("hd").agg(F.count("code").alias("n")).filter(F.col("n") >= 2).select("hd")


@query(
    "e16_self_pairs",
    sql="""
    SELECT DISTINCT x.model AS model1, y.model AS model2, x.speed, x.ram
    FROM pc x JOIN pc y ON x.speed = y.speed AND x.ram = y.ram AND x.model > y.model""",
)
def e16_self_pairs(v):
    """Pairs of PC models with equal speed and RAM, each pair once.

    The answer is the set of pairs, so its size is quadratic in the group
    size by definition.  (model, speed, ram) is made distinct *before* the
    self join, so no duplicate pair is ever produced and then thrown away.
    (speed, ram) has few values: large groups are joined block by block
    (``pairs_within``).
    """
    m = v.pc.select("model", "speed", "ram").distinct()
    return pairs_within(m, ["speed", "ram"], "model", "model1", "model2").select("model1", "model2", "speed", "ram")


@query(
    "e17_lt_all",
    sql="""
    SELECT DISTINCT p.type, l.model, l.speed
    FROM laptop l JOIN product p ON p.model = l.model
    WHERE l.speed < ALL (SELECT speed FROM pc)""",
)
def e17_lt_all(v):
    """Laptops slower than every PC (``< ALL``, empty and NULL aware)."""
    slow = filter_all(v.laptop.select("model", "speed"), F.col("speed"), "<", v.pc, "speed")
    return v.product.join(slow, "model").select("type", "model", "speed").distinct()


@query(
    "e18_eq_min",
    sql="""
    WITH colour AS (SELECT model, price FROM printer WHERE color = 'y')
    SELECT DISTINCT p.maker, c.price
    FROM colour c JOIN product p ON p.model = c.model
    WHERE c.price = (SELECT min(price) FROM colour)""",
)
def e18_eq_min(v):
    """Makers of the cheapest colour printers."""
    colour = v.printer.filter(F.col("color") == "y").select("model", "price")
    cheapest = top_with_ties(colour, "price", largest=False)
    return v.product.join(cheapest, "model").select("maker", "price").distinct()


@query(
    "e19_avg_group",
    sql="SELECT p.maker, avg(l.screen) AS avg_screen FROM laptop l JOIN product p ON p.model = l.model GROUP BY p.maker",
)
def e19_avg_group(v):
    """Mean laptop screen per maker."""
    return v.product.join(v.laptop.select("model", "screen"), "model").groupBy("maker").agg(F.avg("screen").alias("avg_screen"))


@query(
    "e20_count_having",
    sql="SELECT maker, count(model) AS number FROM product WHERE type = 'PC' GROUP BY maker HAVING count(model) >= 3",
)
def e20_count_having(v):
    """Makers with at least three PC rows (COUNT(model), as written)."""
    pcs = v.product.filter(F.col("type") == "PC")
    return pcs.groupBy("maker").agg(F.count("model").alias("number")).filter(F.col("number") >= 3)


@query(
    "e20_task",
    sql="SELECT maker, count(DISTINCT model) AS number FROM product WHERE type = 'PC' GROUP BY maker HAVING count(DISTINCT model) >= 3",
)
def e20_task(v):
    """Makers with at least three *different* PC models (the task text)."""
    pcs = v.product.filter(F.col("type") == "PC")
    return pcs.groupBy("maker").agg(F.count_distinct("model").alias("number")).filter(F.col("number") >= 3)


@query(
    "e21_max_group",
    sql="SELECT p.maker, max(c.price) AS max_price FROM pc c JOIN product p ON p.model = c.model GROUP BY p.maker",
)
def e21_max_group(v):
    """Highest PC price per maker."""
    return v.product.join(v.pc.select("model", "price"), "model").groupBy("maker").agg(F.max("price").alias("max_price"))


@query(
    "e22_avg_by_speed",
    sql="SELECT speed, CAST(sum(price) AS DOUBLE) / count(price) AS avg_price FROM pc WHERE speed > 600 GROUP BY speed",
)
def e22_avg_by_speed(v):
    """Mean PC price per speed above 600."""
    return v.pc.filter(F.col("speed") > 600).groupBy("speed").agg(_avg_money("price", "avg_price"))


@query(
    "e23_intersect",
    sql=f"""
    SELECT p.maker FROM product p JOIN laptop l ON l.model = p.model WHERE l.speed >= {FAST}
    INTERSECT
    SELECT p.maker FROM product p JOIN pc c ON c.model = p.model WHERE c.speed >= {FAST}""",
)
def e23_intersect(v):
    """Makers of both fast PCs and fast laptops.

    INTERSECT of two projections of the same join: the fast models of both
    tables are tagged and unioned, joined to ``product`` once (one shuffle
    of the big table instead of two), and a maker qualifies when both tags
    occur.  GROUP BY keeps a NULL maker as one value, as INTERSECT does.
    """

    def fast(t, laptop: int):
        return t.filter(F.col("speed") >= FAST).select(
            "model", F.lit(laptop).alias("is_laptop"), F.lit(1 - laptop).alias("is_pc")
        )

    tagged = union_all(fast(v.laptop, 1), fast(v.pc, 0))
    flags = v.product.select("maker", "model").join(tagged, "model").groupBy("maker").agg(
        F.max("is_laptop").alias("l"), F.max("is_pc").alias("p")
    )
    return flags.filter((F.col("l") == 1) & (F.col("p") == 1)).select("maker")


@query(
    "e24_cte_union_max",
    sql="""
    WITH priced AS (SELECT model, price FROM pc UNION SELECT model, price FROM laptop UNION SELECT model, price FROM printer)
    SELECT model FROM priced WHERE price IS NOT NULL AND price >= ALL (SELECT price FROM priced WHERE price IS NOT NULL)""",
)
def e24_cte_union_max(v):
    """Models (of any type) at the highest price of the whole catalog.

    The maximum of a UNION equals the maximum of the UNION ALL, so it is one
    scalar aggregate over the three tables; the distinct then runs only on
    the rows at that price rather than on the whole catalog.
    """
    branches = [t.select("price", "model") for t in (v.pc, v.laptop, v.printer)]
    top = union_all(*branches).agg(F.max("price")).scalar()
    return union_distinct(*[b.filter(F.col("price") == top) for b in branches]).select("model")


@query(
    "e25_nested_in",
    sql="""
    WITH low AS (SELECT model, speed FROM pc WHERE ram = (SELECT min(ram) FROM pc)),
         best AS (SELECT model FROM low WHERE speed = (SELECT max(speed) FROM low))
    SELECT DISTINCT p.maker FROM product p
    WHERE p.type = 'Printer'
      AND EXISTS (SELECT 1 FROM product q JOIN best b ON b.model = q.model WHERE q.maker = p.maker)""",
)
def e25_nested_in(v):
    """Printer makers who make a fastest PC among the PCs with the least RAM."""
    least_ram = v.pc.agg(F.min("ram")).scalar()
    low = v.pc.filter(F.col("ram") == least_ram).select("model", "speed")
    best = top_with_ties(low, "speed").select("model")
    pc_makers = v.product.join(best, "model", "left_semi").select("maker")
    printers = v.product.filter(F.col("type") == "Printer").select("maker")
    return printers.join(pc_makers, "maker", "left_semi").distinct()


@query(
    "e26_avg_union_all",
    sql=f"""
    SELECT CAST(sum(u.price) AS DOUBLE) / count(u.price) AS avg_price
    FROM (SELECT model, price FROM pc UNION ALL SELECT model, price FROM laptop) u
    JOIN product p ON p.model = u.model
    WHERE p.maker = '{MAKER}'""",
)
def e26_avg_union_all(v):
    """Mean price over the PCs and laptops of one maker."""
    both = union_all(v.pc.select("price", "model"), v.laptop.select("price", "model"))
    return both.join(_models_of(v, MAKER), "model").agg(_avg_money("price", "avg_price"))


@query(
    "e27_avg_semi",
    sql="""
    SELECT p.maker, avg(c.hd) AS avg_hd
    FROM pc c JOIN product p ON p.model = c.model
    WHERE EXISTS (SELECT 1 FROM product r WHERE r.maker = p.maker AND r.type = 'Printer')
    GROUP BY p.maker""",
)
def e27_avg_semi(v):
    """Mean PC disk per maker that also makes printers."""
    printer_makers = v.product.filter(F.col("type") == "Printer").select("maker")
    disks = v.product.join(v.pc.select("model", "hd"), "model").join(printer_makers, "maker", "left_semi")
    return disks.groupBy("maker").agg(F.avg("hd").alias("avg_hd"))


@query(
    "e28_count_groups",
    sql="""
    SELECT count(s.maker) AS qty
    FROM (SELECT maker FROM product GROUP BY maker HAVING count(model) = 1) s""",
)
def e28_count_groups(v):
    """Number of makers with exactly one model (an aggregate of an aggregate)."""
    single = v.product.groupBy("maker").agg(F.count("model").alias("number")).filter(F.col("number") == 1)
    return single.agg(F.count("maker").alias("qty"))


@query(
    "e35_char_class",
    sql="""
    SELECT model, type FROM product
    WHERE regexp_full_match(model, '[0-9]*') OR regexp_full_match(model, '[a-zA-Z]*')""",
)
def e35_char_class(v):
    """Models made only of digits or only of Latin letters."""
    m = F.col("model")
    return v.product.filter(dialect.only_digits(m) | dialect.only_latin_letters(m)).select("model", "type")


@query(
    "e40_single_type",
    sql="""
    SELECT g.maker, g.type FROM (SELECT maker, type, count(model) AS models FROM product GROUP BY maker, type) g
    WHERE g.models > 1
      AND (SELECT min(p.type) = max(p.type) FROM product p WHERE p.maker = g.maker)""",
)
def e40_single_type(v):
    """Makers with more than one model, all of a single type.

    One aggregate per maker (combined map-side, so a maker with a huge
    number of rows shrinks before the shuffle): "one distinct non-NULL type"
    is ``min(type) = max(type)``, and the models are counted separately for
    the typed rows and for NULL-typed rows, which form their own
    (maker, NULL) group exactly as GROUP BY maker, type does.
    """
    t = F.col("type")
    per = v.product.groupBy("maker").agg(
        F.min(t).alias("lo"),
        F.max(t).alias("hi"),
        F.count(F.when(t.isNotNull(), F.col("model"))).alias("n_typed"),
        F.count(F.when(t.isNull(), F.col("model"))).alias("n_untyped"),
    )
    single = per.filter(F.col("lo") == F.col("hi"))
    groups = F.explode(
        F.array(
            F.struct(F.col("lo").alias("type"), F.col("n_typed").alias("n")),
            F.struct(F.lit(None).cast("string").alias("type"), F.col("n_untyped").alias("n")),
        )
    )
    return single.select("maker", groups.alias("g")).filter(F.col("g.n") > 1).select("maker", F.col("g.type").alias("type"))


@query(
    "e41_null_poison_max",
    sql="""
    WITH priced AS (SELECT model, price FROM pc UNION ALL SELECT model, price FROM laptop UNION ALL SELECT model, price FROM printer)
    SELECT p.maker, CASE WHEN count(*) = count(x.price) THEN max(x.price) END AS max_price
    FROM priced x JOIN product p ON p.model = x.model
    GROUP BY p.maker""",
)
def e41_null_poison_max(v):
    """Highest price per maker, NULL when any of its prices is unknown."""
    all_m = union_all(*[t.select("model", "price") for t in (v.pc, v.laptop, v.printer)])
    joined = v.product.select("maker", "model").join(all_m, "model")
    return joined.groupBy("maker").agg(null_poisoned_max(F.col("price")).alias("max_price"))


PC_ATTRS = ("model", "speed", "ram", "hd", "cd", "price")


@query(
    "e41_unpivot",
    sql="WITH top_pc AS (SELECT * FROM pc WHERE code = (SELECT max(code) FROM pc))\n"
    + "\nUNION ALL\n".join(f"SELECT '{c}' AS attr, CAST({c} AS VARCHAR) AS value FROM top_pc" for c in PC_ATTRS),
)
def e41_unpivot(v):
    """Every attribute but the code of the PC with the highest code, as
    (attr, value) rows; a NULL value stays a row."""
    top = v.pc.filter(F.col("code") == v.pc.agg(F.max("code")).scalar())
    as_text = top.select(*[F.col(c).cast("string").alias(c) for c in PC_ATTRS])
    return as_text.unpivot([], list(PC_ATTRS), "attr", "value")


@query(
    "e58_share",
    sql="""
    WITH grid AS (SELECT m.maker, t.type FROM (SELECT DISTINCT maker FROM product) m CROSS JOIN (SELECT DISTINCT type FROM product) t),
    per_type AS (SELECT maker, type, count(model) AS n FROM product WHERE type IS NOT NULL GROUP BY maker, type),
    per_maker AS (SELECT maker, count(model) AS n FROM product WHERE type IS NOT NULL GROUP BY maker)
    SELECT g.maker, g.type,
           CAST(round(coalesce(c.n, 0) * 100.0 / NULLIF(t.n, 0), 2) AS DECIMAL(5,2)) AS share_pct
    FROM grid g
    LEFT JOIN per_maker t ON t.maker = g.maker
    LEFT JOIN per_type c ON c.maker = g.maker AND c.type = g.type""",
)
def e58_share(v):
    """Percent of each product type in each maker's models, 0 included."""
    return share_of_group(v.product, "maker", "type", "model", "share_pct")


@query(
    "e65_numbered",
    sql="""
    WITH pairs AS (
      SELECT DISTINCT maker, type,
             CASE lower(type) WHEN 'pc' THEN 1 WHEN 'laptop' THEN 2 ELSE 3 END AS rank_type
      FROM product),
    ranked AS (
      SELECT maker, type,
             row_number() OVER (PARTITION BY maker ORDER BY rank_type, type) AS rn_maker,
             row_number() OVER (ORDER BY maker, rank_type, type) AS rn_all
      FROM pairs)
    SELECT rn_all AS row_no, CASE WHEN rn_maker = 1 THEN maker ELSE '' END AS maker, type FROM ranked""",
)
def e65_numbered(v):
    """Number the distinct (maker, type) pairs by maker, then PC, Laptop,
    Printer; print each maker only on its first row.

    The global numbering uses ``global_row_number`` (range partitions +
    offsets), never a window over a single partition.
    """
    t = F.lower(F.col("type"))
    ord_ = F.when(t == "pc", 1).when(t == "laptop", 2).otherwise(3)
    pairs = v.product.select("maker", "type", ord_.alias("ord")).distinct()
    within = F.row_number().over(Window.partitionBy("maker").orderBy("ord", "type"))
    labelled = pairs.select("maker", "type", "ord", within.alias("num"))
    numbered = global_row_number(labelled, [F.col("maker"), F.col("ord"), F.col("type")], "row_no")
    return numbered.select(
        "row_no", F.when(F.col("num") == 1, F.col("maker")).otherwise(F.lit("")).alias("maker"), "type"
    )


@query(
    "e71_division",
    sql="""
    SELECT DISTINCT maker FROM product p
    WHERE type = 'PC' AND NOT EXISTS (
      SELECT 1 FROM product q
      WHERE q.maker = p.maker AND q.type = 'PC'
        AND NOT EXISTS (SELECT 1 FROM pc WHERE pc.model = q.model))""",
)
def e71_division(v):
    """PC makers all of whose PC models occur in the PC table (division)."""
    return divides(v.product.filter(F.col("type") == "PC"), "maker", "model", v.pc, "model")
