"""The domain views as plain SQL, for the independent oracle.

Each entry is the body of a CTE over the base tables (registered as views of
the same names by the checker).  ``with_views`` prepends exactly the views a
query needs, in dependency order, so every oracle string is self-contained.
The expressions mirror ``fathom.sources.views`` row for row.
"""

from __future__ import annotations

import re

MODEL = (
    "CASE WHEN p_partkey % 7 = 0 THEN 'M' || CAST(p_partkey AS VARCHAR) "
    "WHEN p_partkey % 5 = 0 THEN translate(CAST(p_partkey AS VARCHAR), '0123456789', 'abcdefghij') "
    "ELSE CAST(p_partkey AS VARCHAR) END"
)
PRICE = "NULLIF(CAST(floor(p_retailprice / 10) * 10 AS DECIMAL(18,2)), 950)"
TYPE = (
    "CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'PC' "
    "WHEN p_type IN ('MEDIUM', 'PROMO') THEN 'Laptop' ELSE 'Printer' END"
)
MAKER = "p_brand || '-' || CAST(CAST(floor(p_partkey / 80) AS INTEGER) AS VARCHAR)"
SHIP = (
    "CASE WHEN c_custkey < 25 THEN 'NATION_' || CAST(c_custkey AS VARCHAR) "
    "WHEN c_custkey % 10 = 0 THEN c_name || ' of NATION_' || CAST(c_nationkey AS VARCHAR) "
    "ELSE c_name END"
)

VIEWS: dict[str, str] = {
    "parts_x": f"""
        SELECT p_partkey, p_size, {MODEL} AS model, {TYPE} AS type, {MAKER} AS maker, {PRICE} AS price
        FROM part""",
    "product": "SELECT maker, model, type FROM parts_x",
    "pc": """
        SELECT p_partkey AS code, model,
               400 + 100 * (p_size % 10) AS speed,
               64 * (1 + p_size % 4) AS ram,
               CAST(5 * (1 + p_size % 8) AS DOUBLE) AS hd,
               CASE p_size % 3 WHEN 0 THEN '12x' WHEN 1 THEN '24x' ELSE '40x' END AS cd,
               price
        FROM parts_x WHERE type = 'PC' AND p_size > 1""",
    "laptop": """
        SELECT model,
               300 + 100 * (p_size % 10) AS speed,
               64 * (1 + p_size % 4) AS ram,
               CAST(5 * (1 + p_size % 8) AS DOUBLE) AS hd,
               price,
               CAST(11 + p_size % 7 AS DOUBLE) AS screen
        FROM parts_x WHERE type = 'Laptop'""",
    "printer": """
        SELECT model, CASE WHEN p_partkey % 2 = 0 THEN 'y' ELSE 'n' END AS color, price
        FROM parts_x WHERE type = 'Printer'""",
    "classes": """
        SELECT n_name AS class,
               CASE WHEN n_nationkey % 3 = 0 THEN 'bc' ELSE 'bb' END AS type,
               r_name AS country,
               CAST(NULLIF(6 + n_nationkey % 7, 8) AS INTEGER) AS numGuns,
               CAST(12 + n_nationkey % 7 AS DOUBLE) AS bore,
               CAST(NULLIF(30000 + 3000 * (n_nationkey % 6), 36000) AS INTEGER) AS displacement
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "ship_names": f"SELECT c_custkey, c_nationkey, {SHIP} AS name FROM customer",
    "ships": """
        SELECT name,
               CASE WHEN c_custkey < 25 THEN name ELSE 'NATION_' || CAST(c_nationkey AS VARCHAR) END AS class,
               CAST(NULLIF(1993 + c_custkey % 12, 1999) AS INTEGER) AS launched
        FROM ship_names
        WHERE c_custkey >= 10 AND NOT (c_nationkey >= 23 AND c_custkey >= 25)""",
    "battles": """
        SELECT DISTINCT 'B' || strftime(o_orderdate, '%Y%m') AS name,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS date
        FROM orders""",
    "outcomes": """
        SELECT s.name AS ship, 'B' || strftime(o.o_orderdate, '%Y%m') AS battle,
               min(CASE o.o_orderstatus WHEN 'F' THEN 'sunk' WHEN 'P' THEN 'damaged' ELSE 'OK' END) AS result
        FROM orders o JOIN ship_names s ON o.o_custkey = s.c_custkey
        GROUP BY 1, 2""",
    "income": """
        SELECT c_nationkey AS point, CAST(o_orderdate AS DATE) AS date,
               CAST(o_totalprice AS DECIMAL(18,2)) AS inc
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderstatus = 'F' AND c_nationkey <> 3""",
    "outcome": """
        SELECT s_nationkey AS point, CAST(l_shipdate AS DATE) AS date,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS out
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        WHERE l_returnflag = 'R' AND s_nationkey <> 7""",
    "income_o": "SELECT point, date, CAST(sum(inc) AS DECIMAL(18,2)) AS inc FROM income GROUP BY point, date",
    "outcome_o": "SELECT point, date, CAST(sum(out) AS DECIMAL(18,2)) AS out FROM outcome GROUP BY point, date",
    "trip": """
        SELECT o_orderkey AS trip_no, greatest(o_orderkey % 64 - 61, 0) AS id_comp, CAST(o_orderdate AS DATE) AS date,
               'NATION_' || CAST(c_nationkey AS VARCHAR) AS town_from,
               'NATION_' || CAST(o_orderkey % 25 AS VARCHAR) AS town_to,
               (o_orderkey * 37) % 1440 AS min_out,
               (o_orderkey * 37 + 45 + o_orderkey % 300) % 1440 AS min_in
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "pass_in_trip": """
        SELECT l_orderkey AS trip_no, l_partkey AS id_psg, l_suppkey * 10 + l_linenumber AS place
        FROM lineitem""",
    "passenger": "SELECT p_partkey AS id_psg, p_name AS name FROM part",
}

DEPENDS = {
    "product": ["parts_x"],
    "pc": ["parts_x"],
    "laptop": ["parts_x"],
    "printer": ["parts_x"],
    "ships": ["ship_names"],
    "outcomes": ["ship_names"],
    "income_o": ["income"],
    "outcome_o": ["outcome"],
}

_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _closure(names) -> list[str]:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dep in DEPENDS.get(name, []):
            visit(dep)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def with_views(body: str) -> str:
    """Prefix ``body`` with the CTEs of every domain view it mentions."""
    words = set(_WORD.findall(body))
    used = [name for name in VIEWS if name in words and not name.endswith("_x")]
    ctes = [f"{name} AS ({VIEWS[name].strip()})" for name in _closure(used)]
    text = body.strip()
    if not ctes:
        return text
    if text[:4].upper() == "WITH":
        return "WITH " + ",\n".join(ctes) + ",\n" + text[4:].lstrip()
    return "WITH " + ",\n".join(ctes) + "\n" + text
