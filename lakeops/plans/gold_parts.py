"""The aggregates kept up to date from changes, as partial sums that can be added up.

Every load adds one small table of signed sums: its own rows count once, the state's rows that it
replaces count minus once. Sums and counts of a group are then the sums over all loads. A maximum
cannot be taken back, so the columns that need one, the day and the discount rate, are part of
the group: the maximum is the largest value whose count is not zero. The price log only grows, so
its minimum and maximum are those of the loads. The summary of a day is computed anew for the days
that a load touched, from their raw rows alone.

A load that is repeated replaces its sums. A day that is loaded after later days changes what
those replaced; then the sums are built anew from the state, as one more generation, which is also
what to do after a rollback. Adding up many loads into one generation from time to time keeps
reads short.
"""

from __future__ import annotations

import time
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.text import NO_BRAND
from lakeops.plans.gold import DEEP_DISCOUNT, GOOD_DISCOUNT, GROUP, daily_summary
from lakeops.plans.lake import Lake
from lakeops.sinks.files import append_run, existing_folders, remove_folders, write_partitions

GRAIN = [*GROUP, "crawl_date", "discount_rate", "sold"]
BASE = "base"


def _measures() -> dict[str, Column]:
    # decimals add up exactly in any order
    rating = F.col("rating_average").cast("decimal(20,10)")
    return {
        "products": F.lit(1),
        "units": F.col("quantity_sold"),
        "ratings": rating,
        "rated": rating.isNotNull().cast("int"),
        "reviews": F.col("review_count"),
        "reviewed": F.col("review_count").isNotNull().cast("int"),
        "prices": F.col("price"),
        "priced": F.col("price").isNotNull().cast("int"),
        "originals": F.col("original_price"),
        "with_original": F.col("original_price").isNotNull().cast("int"),
    }


def product_sums(rows: DataFrame, sign: int = 1) -> DataFrame:
    """Signed sums of product rows by group, day, discount rate and whether any unit was sold."""
    graded = rows.withColumn("sold", F.coalesce(F.col("quantity_sold") > 0, F.lit(False)))
    return graded.groupBy(*GRAIN).agg(*(_stored(name, F.sum(m) * sign) for name, m in _measures().items()))


def summed(sums: DataFrame) -> DataFrame:
    return sums.groupBy(*GRAIN).agg(*(_stored(name, F.sum(name)) for name in _measures()))


def _stored(name: str, total: Column) -> Column:
    """A sum under one type, however many sums it is made of."""
    return total.cast("decimal(38,10)" if name == "ratings" else "bigint").alias(name)


def added_up(sums: DataFrame) -> DataFrame:
    """One row per group and grain over all loads, without those whose rows have all been replaced."""
    return summed(sums).filter("products <> 0")


def _mean(total: str, count: str, digits: int) -> Column:
    return F.round(F.try_divide(F.sum(total).cast("double"), F.sum(count)), digits)


def _rate(digits: int) -> Column:
    rated = F.when(F.col("discount_rate").isNotNull(), F.col("products"))
    return F.round(F.try_divide(F.sum(F.col("discount_rate") * F.col("products")).cast("double"), F.sum(rated)), digits)


def brand_performance(sums: DataFrame) -> DataFrame:
    """As ``gold.brand_performance`` of the state, from its sums."""
    brand = F.col("brand_name")
    branded = brand.isNotNull() & (brand != NO_BRAND) & (F.trim(brand) != "")
    return (
        sums.filter(branded & F.col("sold"))
        .groupBy(*GROUP)
        .agg(
            F.sum("products").alias("total_products"),
            F.sum("units").alias("total_quantity_sold"),
            _mean("ratings", "rated", 2).alias("avg_rating"),
            _mean("reviews", "reviewed", 0).alias("avg_reviews"),
            _mean("prices", "priced", 0).alias("avg_price"),
            _rate(1).alias("avg_discount_rate"),
            F.max("crawl_date").alias("last_updated"),
        )
    )


def discount_analysis(sums: DataFrame) -> DataFrame:
    """As ``gold.discount_analysis`` of the state, from its sums."""

    def at_least(rate: int) -> Column:
        return F.sum(F.when(F.col("discount_rate") >= rate, F.col("products")).otherwise(0))

    return (
        sums.filter(F.col("discount_rate") > 0)
        .groupBy(*GROUP)
        .agg(
            F.sum("products").alias("product_count"),
            _rate(1).alias("avg_discount_rate"),
            F.max("discount_rate").alias("max_discount_rate"),
            at_least(GOOD_DISCOUNT).alias("products_30pct_off"),
            at_least(DEEP_DISCOUNT).alias("products_50pct_off"),
            _mean("prices", "priced", 0).alias("avg_current_price"),
            _mean("originals", "with_original", 0).alias("avg_original_price"),
            F.max("crawl_date").alias("last_updated"),
        )
    )


TREND = ["crawl_date", "category_id", "category_name"]


def trend_sums(log: DataFrame) -> DataFrame:
    return log.groupBy(*TREND).agg(
        F.count("id").alias("changes"),
        F.sum("price").alias("prices"),
        F.count("price").alias("priced"),
        F.min("price").alias("lowest"),
        F.max("price").alias("highest"),
        F.sum("discount_rate").alias("rates"),
        F.count("discount_rate").alias("rated"),
    )


def trends_added_up(sums: DataFrame) -> DataFrame:
    total = [F.sum(c).alias(c) for c in ("changes", "prices", "priced", "rates", "rated")]
    return sums.groupBy(*TREND).agg(*total, F.min("lowest").alias("lowest"), F.max("highest").alias("highest"))


def price_trend(sums: DataFrame) -> DataFrame:
    """As ``gold.price_trend`` of the log, from its sums."""
    return trends_added_up(sums).select(
        *TREND,
        F.col("changes").alias("total_price_changes"),
        F.round(F.try_divide(F.col("prices").cast("double"), F.col("priced")), 0).alias("avg_new_price"),
        F.round("lowest", 0).alias("min_new_price"),
        F.round("highest", 0).alias("max_new_price"),
        F.round(F.try_divide(F.col("rates").cast("double"), F.col("rated")), 1).alias("avg_new_discount_rate"),
    )


class GoldParts:
    """The sums of one lake, below its folder of aggregates."""

    def __init__(self, spark: SparkSession, lake: Lake):
        self.spark, self.lake = spark, lake
        self._root, self._days = lake.gold("parts"), lake.gold("parts_by_day")

    def begin(self, without: str) -> None:
        """The sums of all loads so far but the run ``without``, unless there are sums already."""
        if not existing_folders(self.spark, f"{self._root}/generation=*"):
            log = self.lake.read_history(self.spark).filter(F.col("run") != without)
            self.rebuild(self.lake.state(self.spark).read(without=without), log)

    def add(self, run: str, new: DataFrame, replaced: DataFrame, logged: DataFrame) -> None:
        """The sums of one load: its rows, the rows of the state that they replace, and its rows of the log."""
        self.begin(run)
        here = self._generation()
        # rows may change without a change of their number, so nothing is left out here
        append_run(summed(product_sums(new).unionByName(product_sums(replaced, -1))), f"{here}/products", run)
        append_run(trend_sums(logged), f"{here}/trends", run)

    def add_days(self, days: list[date]) -> None:
        """The summaries of some days anew, from the raw rows of these days alone."""
        raw = self.lake.read_bronze(self.spark).drop("ingest").filter(F.col("crawl_date").isin(days))
        write_partitions(daily_summary(raw), self._days, ["crawl_date"])

    def rebuild(self, state: DataFrame, log: DataFrame) -> None:
        """Sums of the whole state and log, as a new generation in place of the loads so far."""
        self._begin(product_sums(state), trend_sums(log))

    def fold(self) -> None:
        """Add all loads up into one; not while a load is running."""
        self._begin(added_up(self._sums("products")), trends_added_up(self._sums("trends")))

    def tables(self) -> dict[str, DataFrame]:
        """The aggregates by name; the leader board is no sum and comes from the state.

        Without ``add_days`` there is no daily summary.
        """
        products = added_up(self._sums("products"))
        found = {
            "brand_performance": brand_performance(products),
            "discount_analysis": discount_analysis(products),
            "price_trend": price_trend(self._sums("trends")),
        }
        if existing_folders(self.spark, self._days):
            found["daily_summary"] = self.spark.read.parquet(self._days)
        return found

    def _sums(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._generation()}/{name}").drop("run")

    def _begin(self, products: DataFrame, trends: DataFrame) -> None:
        earlier = existing_folders(self.spark, f"{self._root}/generation=*")
        fresh = f"{self._root}/generation={time.time_ns():020d}"
        append_run(trends, f"{fresh}/trends", BASE)
        append_run(products, f"{fresh}/products", BASE)  # its mark of success makes the generation count
        remove_folders(self.spark, earlier)

    def _generation(self) -> str:
        whole = existing_folders(self.spark, f"{self._root}/generation=*/products/run={BASE}/_SUCCESS")
        return sorted(whole)[-1].split("/products/")[0] if whole else f"{self._root}/generation={0:020d}"
