"""Domain views derived from the base tables.

The analytical queries are written against four small relational schemas:

* computers:  ``product``, ``pc``, ``laptop``, ``printer``        (from ``part``)
* fleet:      ``classes`` (nation x region), ``ships`` (customer),
              ``battles`` and ``outcomes`` (orders x customer)
* cash:       ``income``/``outcome`` with the daily ``income_o``/``outcome_o``
              (orders x customer, lineitem x supplier)
* flights:    ``trip`` (orders x customer), ``pass_in_trip`` (lineitem),
              ``passenger`` (part)

Each view is a lazy DataFrame over the Parquet scans, so a query that uses two
columns of ``pc`` reads two columns of ``part`` (plus the ones the view's
filter needs).  Nothing is cached or collected here.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.functions import derive as d
from fathom.sources.tables import read_table


class Views:
    """Lazily built domain DataFrames for one data directory."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.root, name)

    NAMES = (
        "product", "pc", "laptop", "printer",
        "classes", "ships", "battles", "outcomes",
        "income", "outcome", "income_o", "outcome_o",
        "trip", "pass_in_trip", "passenger",
    )

    def register(self, prefix: str = "") -> list[str]:
        """Expose every domain table as a temporary view, so questions can
        also be asked in Spark SQL (``spark.sql("SELECT ... FROM pc")``).
        The views are the same lazy plans: nothing is computed here."""
        names = []
        for name in self.NAMES:
            getattr(self, name).createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        return names

    # ------------------------------------------------------------------ computers
    def _parts(self) -> DataFrame:
        p = self.table("part")
        return p.select(
            F.col("p_partkey"),
            F.col("p_name"),
            F.col("p_size"),
            d.model_text(F.col("p_partkey")).alias("model"),
            d.product_type(F.col("p_type")).alias("type"),
            d.maker_name(F.col("p_brand"), F.col("p_partkey")).alias("maker"),
            d.money_price(F.col("p_retailprice")).alias("price"),
        )

    @cached_property
    def product(self) -> DataFrame:
        return self._parts().select("maker", "model", "type")

    def _family(self, family: str) -> DataFrame:
        p = self.table("part").filter(d.family_filter(F.col("p_type"), family))
        return p.select(
            F.col("p_partkey"),
            F.col("p_size"),
            d.model_text(F.col("p_partkey")).alias("model"),
            d.money_price(F.col("p_retailprice")).alias("price"),
        )

    @cached_property
    def pc(self) -> DataFrame:
        size = F.col("p_size")
        # A PC of the smallest size is announced as a product but not built yet.
        return self._family("PC").filter(size > 1).select(
            F.col("p_partkey").alias("code"),
            "model",
            (F.lit(400) + F.lit(100) * (size % 10)).alias("speed"),
            (F.lit(64) * (F.lit(1) + size % 4)).alias("ram"),
            (F.lit(5) * (F.lit(1) + size % 8)).cast("double").alias("hd"),
            F.when(size % 3 == 0, F.lit(d.CD_SPEEDS[0]))
            .when(size % 3 == 1, F.lit(d.CD_SPEEDS[1]))
            .otherwise(F.lit(d.CD_SPEEDS[2]))
            .alias("cd"),
            "price",
        )

    @cached_property
    def laptop(self) -> DataFrame:
        size = F.col("p_size")
        return self._family("Laptop").select(
            "model",
            (F.lit(300) + F.lit(100) * (size % 10)).alias("speed"),
            (F.lit(64) * (F.lit(1) + size % 4)).alias("ram"),
            (F.lit(5) * (F.lit(1) + size % 8)).cast("double").alias("hd"),
            "price",
            (F.lit(11) + size % 7).cast("double").alias("screen"),
        )

    @cached_property
    def printer(self) -> DataFrame:
        return self._family("Printer").select(
            "model",
            F.when(F.col("p_partkey") % 2 == 0, F.lit(d.COLOUR_YES)).otherwise(F.lit(d.COLOUR_NO)).alias("color"),
            "price",
        )

    # ---------------------------------------------------------------------- fleet
    @cached_property
    def classes(self) -> DataFrame:
        # One row per nation: the nation table has a fixed, data-volume
        # independent size (25 rows in the TPC-H schema), so every join with
        # a class is a broadcast -- never a shuffle on ~25 key values.
        n = self.table("nation")
        r = self.table("region")
        k = F.col("n_nationkey")
        return F.broadcast(n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)).select(
            F.col("n_name").alias("class"),
            F.when(k % 3 == 0, F.lit(d.BATTLECRUISER)).otherwise(F.lit(d.BATTLESHIP)).alias("type"),
            F.col("r_name").alias("country"),
            d.null_if(F.lit(6) + k % 7, 8, "int").alias("numGuns"),
            (F.lit(12) + k % 7).cast("double").alias("bore"),
            d.null_if(F.lit(30000) + F.lit(3000) * (k % 6), 36000, "int").alias("displacement"),
        )

    def _customer_ships(self) -> DataFrame:
        c = self.table("customer")
        return c.select(
            "c_custkey",
            "c_nationkey",
            d.ship_name(F.col("c_custkey"), F.col("c_name"), F.col("c_nationkey")).alias("name"),
        )

    @cached_property
    def ships(self) -> DataFrame:
        key = F.col("c_custkey")
        kept = self._customer_ships().filter(
            (key >= 10) & ~((F.col("c_nationkey") >= 23) & (key >= 25))
        )
        return kept.select(
            "name",
            F.when(key < 25, F.col("name")).otherwise(d.nation_label(F.col("c_nationkey"))).alias("class"),
            d.null_if(F.lit(1993) + key % 12, 1999, "int").alias("launched"),
        )

    @staticmethod
    def _battle_name(month: F.Column) -> F.Column:
        return F.concat(F.lit("B"), F.date_format(month, "yyyyMM"))

    @cached_property
    def battles(self) -> DataFrame:
        # One row per calendar month of the order dates: bounded by the date
        # range (some tens of months), not by the number of orders.
        months = self.table("orders").select(F.trunc("o_orderdate", "month").alias("date")).distinct()
        return months.select(self._battle_name(F.col("date")).alias("name"), "date")

    @cached_property
    def outcomes(self) -> DataFrame:
        return self._outcomes(self.table("orders"))

    def outcomes_of(self, battle: str) -> DataFrame:
        """``outcomes`` of one battle: the month's bounds reach the scan of
        orders, where a filter on the formatted name would not."""
        first = dt.date(int(battle[1:5]), int(battle[5:7]), 1)
        after = (first + dt.timedelta(days=31)).replace(day=1)
        orders = self.table("orders")
        day = F.col("o_orderdate")
        return self._outcomes(orders.filter((day >= F.lit(first)) & (day < F.lit(after))))

    def _outcomes(self, o: DataFrame) -> DataFrame:
        # One row per (ship, battle).  A ship name is a function of the
        # customer key, so orders are first reduced to one row per (customer,
        # month) -- an aggregate with map-side combine, so even a customer
        # holding a large share of all orders leaves each map task as at most
        # one row per month -- and only then joined to customers.  MIN runs
        # over an integer severity code (hash aggregate, no sort), turned
        # back into the result text at the end.
        per_month = o.groupBy(
            F.col("o_custkey").alias("c_custkey"),
            self._battle_name(F.trunc("o_orderdate", "month")).alias("battle"),
        ).agg(F.min(d.order_result_code(F.col("o_orderstatus"))).alias("code"))
        return per_month.join(self._customer_ships(), "c_custkey").select(
            F.col("name").alias("ship"), "battle", d.result_label(F.col("code")).alias("result")
        )

    @cached_property
    def outcome_ships(self) -> DataFrame:
        """The set of ships that appear in ``outcomes`` (one row per ship).

        Queries that only need this set (entity unions, DISTINCT ship lists)
        read it instead of ``outcomes``: a distinct over the customer key of
        orders -- combined map-side, so a customer with a huge number of
        orders collapses before the shuffle -- instead of the per-month
        aggregate.  Names are unique per customer key, so the rows are
        distinct.
        """
        buyers = self.table("orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
        return buyers.join(self._customer_ships(), "c_custkey").select(F.col("name").alias("ship"))

    # ----------------------------------------------------------------------- cash
    @cached_property
    def income(self) -> DataFrame:
        o = self.table("orders").filter(F.col("o_orderstatus") == "F")
        c = self.table("customer").filter(F.col("c_nationkey") != 3)
        return o.join(c, o.o_custkey == c.c_custkey).select(
            F.col("c_nationkey").alias("point"),
            F.col("o_orderdate").cast("date").alias("date"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("inc"),
        )

    @cached_property
    def outcome(self) -> DataFrame:
        li = self.table("lineitem").filter(F.col("l_returnflag") == "R")
        s = self.table("supplier").filter(F.col("s_nationkey") != 7)
        return li.join(s, li.l_suppkey == s.s_suppkey).select(
            F.col("s_nationkey").alias("point"),
            F.col("l_shipdate").cast("date").alias("date"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("out"),
        )

    @cached_property
    def income_o(self) -> DataFrame:
        return self.income.groupBy("point", "date").agg(
            F.sum("inc").cast("decimal(18,2)").alias("inc")
        )

    @cached_property
    def outcome_o(self) -> DataFrame:
        return self.outcome.groupBy("point", "date").agg(
            F.sum("out").cast("decimal(18,2)").alias("out")
        )

    # -------------------------------------------------------------------- flights
    @cached_property
    def trip_legs(self) -> DataFrame:
        """``trip`` without ``town_from``: every column that comes from orders.

        ``trip`` is orders LEFT JOIN customer on the customer primary key, so
        it has exactly one row per order; queries that do not need the
        departure town read this projection and skip that join entirely
        (a full shuffle of both tables at scale).
        """
        k = F.col("o_orderkey")
        return self.table("orders").select(
            k.alias("trip_no"),
            F.greatest(k % 64 - 61, F.lit(0)).alias("id_comp"),
            F.col("o_orderdate").cast("date").alias("date"),
            F.col("o_custkey"),
            d.nation_label(k % 25).alias("town_to"),
            ((k * 37) % 1440).alias("min_out"),
            ((k * 37 + 45 + k % 300) % 1440).alias("min_in"),
        )

    @cached_property
    def trip(self) -> DataFrame:
        c = self.table("customer").select("c_custkey", d.nation_label(F.col("c_nationkey")).alias("town_from"))
        legs = self.trip_legs
        joined = legs.join(c, legs.o_custkey == c.c_custkey, "left")
        return joined.select("trip_no", "id_comp", "date", "town_from", "town_to", "min_out", "min_in")

    @cached_property
    def pass_in_trip(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(
            F.col("l_orderkey").alias("trip_no"),
            F.col("l_partkey").alias("id_psg"),
            (F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("place"),
        )

    @cached_property
    def passenger(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("id_psg"), F.col("p_name").alias("name")
        )
