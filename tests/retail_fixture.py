"""Return-fraud tables with planted groups, built from a parameter table by fingerprint draws."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark import cloudpickle

import farmhash
from farmhash import farm_fingerprint

cloudpickle.register_pickle_by_value(farmhash)  # workers do not see the tests folder

# Fixed values of the published data set: cohorts by customer id, with the
# share of orders returned, and the planted groups' order rules.
#          cohort          first  last  returned of 100
COHORTS = [("group_a",      9001, 9006, 65),
           ("group_b",      9101, 9104, 67),
           ("group_c",      9201, 9205, 80),
           ("high_returner", 4001, 4050, 50)]
OTHERS_RETURNED = 8
#          first member, members, orders each, order id base, first day, step, span of days
PLANTED = [(9001, 6, 25, 900000, "2025-09-01", 11, 290),
           (9101, 4, 12, 910000, "2025-10-01", 19, 260),
           (9201, 5, 10, 920000, "2025-11-01", 23, 230)]
SEGMENTS = ["new", "regular", "vip", "occasional"]


def draw(tag: str, key, n: int):
    return F.abs(farm_fingerprint(F.concat(F.lit(tag), key.cast("string"))) % n)


def cohort_of(customer):
    name, returned = F.lit("regular"), F.lit(OTHERS_RETURNED)
    for label, first, last, share in COHORTS:
        inside = customer.between(first, last)
        name, returned = F.when(inside, label).otherwise(name), F.when(inside, share).otherwise(returned)
    return name, returned


def build(spark: SparkSession) -> dict[str, DataFrame]:
    key = F.col("order_id")
    ordinary = spark.range(1, 50001).select(F.col("id").alias("order_id")).select(
        key, (1 + draw("c", key, 5000)).alias("customer_id"),
        F.date_add(F.lit("2025-01-01").cast("date"), draw("d", key, 540).cast("int")).alias("order_date"))
    rules = spark.createDataFrame(PLANTED, "first long, members long, per long, base long, day string, step long, span long")
    planted = (
        rules.withColumn("m", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("members") - 1)))
        .withColumn("n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("per"))))
        .select((F.col("base") + (F.col("m") - F.col("first")) * F.col("per") + F.col("n")).alias("order_id"),
                F.col("m").alias("customer_id"),
                F.date_add(F.col("day").cast("date"),
                           ((F.col("n") * F.col("step") + F.col("m")) % F.col("span")).cast("int")).alias("order_date"))
    )
    customer = F.col("customer_id")
    cohort, returned = cohort_of(customer)
    orders = (
        ordinary.unionByName(planted)
        .withColumn("cohort", cohort).withColumn("returned", returned)
        .withColumn("is_c", F.col("cohort") == "group_c")
        .withColumn("order_total", F.round(F.when(F.col("is_c"), 400 + draw("t", key, 50000) / 100)
                                           .otherwise(20 + draw("t", key, 38000) / 100), 2))
        .withColumn("device_id", F.when(F.col("cohort") == "group_a", 999001 + key % 2).otherwise(100000 + customer))
        .withColumn("address_id", F.when(F.col("cohort") == "group_a", 888001)
                    .when(F.col("cohort") == "group_b", 888101).otherwise(200000 + customer))
        .withColumn("payment_method_id", F.when(F.col("is_c"), 777201).otherwise(300000 + customer))
    )
    returns = orders.filter(draw("ret", key, 100) < F.col("returned")).select(
        (5000000 + key).alias("return_id"), "order_id", "customer_id",
        F.date_add("order_date", (5 + draw("rd", key, 15)).cast("int")).alias("return_date"),
        F.col("order_total").alias("refund_amount"))

    def neighbours(every: int, base: int):
        return spark.range(1, 5000).filter(F.col("id") % every == 0).select("id", base + F.col("id") + 1)

    devices = orders.select("customer_id", "device_id").union(neighbours(37, 100000)).distinct()
    addresses = orders.select("customer_id", "address_id").union(neighbours(41, 200000)).distinct()
    payments = orders.select("customer_id", "payment_method_id").distinct()
    points = F.round(F.col("order_total") * 10).cast("long")
    is_b = F.col("cohort") == "group_b"
    earned = orders.filter(is_b | ((customer <= 5000) & (draw("le", key, 5) == 0))).select(
        "order_id", "customer_id", F.lit("EARN").alias("txn_type"), points.alias("points"),
        F.col("order_date").alias("txn_date"))
    redeemed = orders.filter(is_b).select(
        "order_id", "customer_id", F.lit("REDEEM").alias("txn_type"), (-points).alias("points"),
        F.date_add("order_date", 2).alias("txn_date"))
    ids = spark.range(1, 5001).select(F.col("id").alias("customer_id")).union(
        planted.select("customer_id").distinct())
    segments = F.array(*[F.lit(s) for s in SEGMENTS])
    customers = ids.withColumn("segment", segments[draw("seg", customer, 4).cast("int")])
    return {"customers": customers, "orders": orders, "returns": returns, "devices": devices,
            "addresses": addresses, "payments": payments, "loyalty": earned.unionByName(redeemed)}
