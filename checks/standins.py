"""The retail inputs, derived from the test tables with plain expressions.

``oracles.py`` spells the same derivations in SQL.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from footfall.context import Week
from footfall.functions.ids import hashed_id
from footfall.functions.rates import sigmoid
from footfall.plans.calendar import regular_calendar

BANNER = "B1"
LOOK_BACK_DAYS = 1095
CALENDAR_START = dt.date(1994, 12, 31)
CALENDAR_WEEKS = 1518
FEATURE_WEEK = Week("2001_327", dt.date(2001, 6, 30), dt.date(2001, 7, 6))
TARGET_WEEK = Week("2001_329", dt.date(2001, 7, 14), dt.date(2001, 7, 20))
EVENT_WEEK = Week("2024_305", dt.date(2024, 1, 27), dt.date(2024, 2, 2))
EMBEDDING_WIDTH = 64
OFFER_YEARS = tuple(range(1995, 2002))


def when_text(*cases: tuple[Column, Column], otherwise: Column) -> Column:
    return reduce(lambda rest, case: F.when(case[0], case[1]).otherwise(rest), reversed(cases), otherwise)


@dataclass(frozen=True)
class Standins:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def calendar(self) -> DataFrame:
        return regular_calendar(self.spark, CALENDAR_START, CALENDAR_WEEKS)

    def _orders(self) -> DataFrame:
        key, customer = F.col("o_orderkey"), F.col("o_custkey")
        card = when_text(
            (key % 97 == 0, F.lit(None).cast("string")),
            ((customer % 10 == 0) & (key % 2 == 0), F.concat(F.lit("B"), customer.cast("string"))),
            otherwise=F.concat(F.lit("A"), customer.cast("string")),
        )
        banner = F.when(F.col("o_orderpriority") == "5-LOW", "B2").otherwise("B1")
        return self.table("orders").select(
            "*",
            card.alias("card"),
            banner.alias("banner"),
            banner.alias("p_banner"),
            F.date_format("o_orderdate", "yyyyMMdd").alias("p_trans_dateid"),
            key.alias("lms_transaction_id"),
        )

    def transaction_detail(self) -> DataFrame:
        lines = self.table("lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
        orders = self._orders()
        return orders.join(lines, orders.o_orderkey == lines.l_orderkey).select(
            F.col("card").alias("loyalty_card_num"),
            "p_trans_dateid",
            F.when(F.col("o_orderstatus") == "P", "Return").otherwise("Purchase").alias("transactiontype"),
            "banner",
            "p_banner",
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("sales"),
            "lms_transaction_id",
        )

    def transaction_summary(self) -> DataFrame:
        price = F.col("o_totalprice")
        base = price * 0.004
        credit = F.when(F.col("o_orderpriority") == "1-URGENT", price * 0.01).otherwise(0.0)
        bonus = F.when(F.col("o_orderpriority") == "2-HIGH", 5.0).otherwise(0.0)
        redemption = F.when(F.col("o_orderstatus") == "F", 2.0).otherwise(0.0)
        enrolled = F.date_add(F.lit("1990-01-01").cast("date"), (F.col("o_custkey") % 1500).cast("int"))
        return self._orders().select(
            F.col("card").alias("cardnumber"),
            "banner",
            "p_banner",
            "p_trans_dateid",
            "lms_transaction_id",
            base.alias("loyalty_base_points_dol"),
            credit.alias("loyalty_credit_points_dol"),
            bonus.alias("loyalty_bonus_points_dol"),
            redemption.alias("loyalty_redemption_points_dol"),
            (base + credit + bonus - redemption).alias("loyalty_total_points_dol"),
            F.round(price).cast("bigint").alias("dollarbalance"),
            enrolled.alias("enrolldate"),
            F.date_add(enrolled, 30).alias("registerdate"),
        )

    def loyalty_account(self) -> DataFrame:
        key = F.col("c_custkey")
        text = key.cast("string")
        cards = F.when(key % 10 == 0, F.array(F.concat(F.lit("A"), text), F.concat(F.lit("B"), text))).otherwise(
            F.array(F.concat(F.lit("A"), text))
        )
        return self.table("customer").select(
            F.explode(cards).alias("cardnumber"),
            key.alias("customerid"),
            F.concat(F.lit("P"), text).alias("epcl_profileid"),
        ).withColumn(
            "epcl_profileid",
            F.when(
                (F.col("customerid") % 20 == 0) & F.col("cardnumber").startswith("B"),
                F.concat(F.lit("Q"), F.col("customerid").cast("string")),
            ).otherwise(F.col("epcl_profileid")),
        )

    def active_customers(self) -> DataFrame:
        return self.table("customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("customer_id"))

    def id_mapping(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("epcl_id"), hashed_id("c_custkey").alias("customer_id_hashed")
        )

    def views(self) -> DataFrame:
        day = F.col("ts").cast("date")
        sees_offers = F.col("user_id") % 7 != 0
        never = F.lit(None).cast("date")

        def on(kind: str) -> Column:
            return F.when((F.col("event_type") == kind) & sees_offers, day)

        return (
            self.table("events")
            .filter("event_type <> 'purchase'")
            .select(
                F.col("user_id").alias("customerid"),
                on("view").alias("program_website_view_date"),
                on("click").alias("program_app_view_date"),
                on("signup").alias("email_view_date"),
                never.alias("banner_website_view_date"),
                never.alias("banner_page_view_date"),
                never.alias("banner_app_view_date"),
                F.lit(BANNER).alias("p_banner"),
                day.alias("p_trans_dateid"),
            )
        )

    def event_detail(self) -> DataFrame:
        """Purchases among the events, in the shape of transaction lines of one-card customers."""
        return (
            self.table("events")
            .filter("event_type = 'purchase'")
            .select(
                F.concat(F.lit("A"), F.col("user_id").cast("string")).alias("loyalty_card_num"),
                F.date_format("ts", "yyyyMMdd").alias("p_trans_dateid"),
                F.lit("Purchase").alias("transactiontype"),
                F.lit(BANNER).alias("banner"),
                F.lit(BANNER).alias("p_banner"),
                F.col("value").alias("sales"),
                F.col("event_id").alias("lms_transaction_id"),
            )
        )

    def adhoc_offers(self) -> DataFrame:
        key = F.col("p_partkey")
        start = F.date_add(F.lit("1995-01-01").cast("date"), (key * 7 % 2300).cast("int"))
        return self.table("part").select(
            F.concat_ws(" ", "p_type", "p_name").alias("Offer Description"),
            start.alias("Start Date"),
            F.date_add(start, (F.col("p_size") % 21).cast("int")).alias("End Date"),
            F.concat(F.lit("BC"), key.cast("string")).alias("Bonus Code"),
            when_text(
                (key % 13 == 0, F.lit(None).cast("string")), (key % 2 == 0, F.lit("Y")), otherwise=F.lit("N")
            ).alias("NPP"),
            F.col("p_brand").alias("Funding"),
            F.lit(None).cast("string").alias("Notes"),
        )

    def embedding_segments(self) -> list[tuple[DataFrame, DataFrame]]:
        vectors = self.table("embeddings")
        ids = vectors.select(
            F.col("vec_id").alias("lightfm_id"),
            (F.col("vec_id") % 400).alias("user_id"),
            hashed_id(F.col("vec_id") % 400).alias("epsilon_id"),
        )
        return [
            (
                vectors.filter(F.col("label") % 3 == segment).select(
                    F.col("vec_id").alias("lightfm_id"), "embedding"
                ),
                ids,
            )
            for segment in range(3)
        ]

    def predictions(self) -> DataFrame:
        return self.table("customer").select(
            hashed_id("c_custkey").alias("epsilon_id"),
            F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("epcl_profileid"),
            F.round(sigmoid((F.col("c_acctbal") - 4000) / 2000), 6).alias("predicted_purchase_prob"),
        )

    def model_performance(self) -> DataFrame:
        day = F.lpad((F.col("n_nationkey") + 1).cast("string"), 2, "0")
        return self.table("nation").select(
            F.when(F.col("n_regionkey") % 2 == 0, "B1").otherwise("B2").alias("banner"),
            F.concat(F.lit("2024-01-"), day, F.lit(" 00:00:00")).alias("train_timestamp"),
            F.round(F.col("n_nationkey") / 100.0 + 0.3, 4).alias("optimal_threshold"),
            F.round(F.col("n_nationkey") / 100.0 + 0.5, 4).alias("optimal_f1"),
        )

    def previous_labels(self) -> DataFrame:
        key = F.col("c_custkey")
        return (
            self.table("customer")
            .filter("c_nationkey < 20")
            .select(
                key.alias("customer_id"),
                F.explode(F.array(F.lit("B1"), F.lit("B2"))).alias("banner"),
                F.when(key % 3 == 0, "H").otherwise("L").alias("shop_prob_label"),
                F.when(key % 5 == 0, "H").otherwise("L").alias("lift_label"),
            )
        )

    def scored(self) -> DataFrame:
        return self.table("lineitem").select(
            (F.col("l_returnflag") == "R").cast("int").alias("actual"),
            F.col("l_discount").alias("score_ties"),
            F.round(F.col("l_extendedprice") / 110000, 6).alias("score_fine"),
        )
