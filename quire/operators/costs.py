"""Costs of provider calls, and comparison of methods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed prices by part of a model's name, in order: dollars a million tokens in and out; a page's price by method.
PRICES = [("sonnet", 3.0, 15.0), ("opus", 15.0, 75.0), ("haiku", 0.8, 4.0)]
DEFAULT = (3.0, 15.0)
PAGE_PRICES = [("landing_ai", 0.01), ("llamaparse", 0.003)]


def price(model: Column) -> Column:
    """Struct of the first matching price; a CASE over the fixed list, so no join is needed."""
    out = None
    for name, i, o in PRICES:
        one = F.struct(F.lit(i).alias("p_in"), F.lit(o).alias("p_out"))
        cond = F.contains(F.lower(model), F.lit(name))
        out = F.when(cond, one) if out is None else out.when(cond, one)
    return out.otherwise(F.struct(F.lit(DEFAULT[0]).alias("p_in"), F.lit(DEFAULT[1]).alias("p_out")))


def cost(in_tok: Column, out_tok: Column, p: Column) -> Column:
    return in_tok / 1e6 * p["p_in"] + out_tok / 1e6 * p["p_out"]


def page_cost(calls: DataFrame) -> DataFrame:
    """calls (method, n_pages): the method's price a page times pages; methods without a price cost nothing."""
    spark: SparkSession = calls.sparkSession
    prices = spark.createDataFrame(PAGE_PRICES, "method string, price double")
    return calls.join(F.broadcast(prices), "method", "left").withColumn("cost", F.round(F.coalesce("price", F.lit(0.0)) * F.col("n_pages"), 6))


def succeeded(warnings: Column, chars: Column) -> Column:
    bad = F.exists(warnings, lambda w: F.lower(w).rlike("error|not set|credentials"))
    return ~bad & (chars > 0)


def combinations(files: DataFrame, methods: DataFrame) -> DataFrame:
    """Every file with every method. methods is the registry, one row a method; a few are broadcast."""
    return files.crossJoin(F.broadcast(methods) if methods.count() <= 1000 else methods)


def matrix(results: DataFrame, methods: list[str]) -> DataFrame:
    """results (file, method, value): a column for each method, -1 where there is none."""
    return results.groupBy("file").pivot("method", methods).agg(F.max("value")).na.fill(-1, methods)


def paired(results: DataFrame, a: str, b: str) -> DataFrame:
    """Two methods' tokens and costs side by side for each file, with the saving in percent."""
    one = lambda m, c: F.sum(F.when(F.col("method") == m, F.col(c)))
    x = results.groupBy("file").agg(one(a, "tokens").alias("tokens_a"), one(b, "tokens").alias("tokens_b"), one(a, "cost").alias("cost_a"), one(b, "cost").alias("cost_b"))
    x = x.where("tokens_a is not null and tokens_b is not null")
    return x.withColumn("delta", F.col("tokens_b") - F.col("tokens_a")).withColumn("saving_pct", F.round(F.when(F.col("cost_a") == 0, 0.0).otherwise((F.col("cost_a") - F.col("cost_b")) / F.col("cost_a") * 100), 4))
