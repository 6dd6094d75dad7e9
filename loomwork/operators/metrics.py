"""Blocking, classification and clustering metrics, and rule crosstabs, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomwork.session import cut


def _hits(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.join(b, keys, "left_semi").agg(F.count("*").alias("hits"))


def blocking_stats(cand: DataFrame, gold: DataFrame, entities: DataFrame, keys: tuple[str, str] = ("ltable_id", "rtable_id")) -> DataFrame:
    """Undirected: precision over all candidate rows, recall over distinct golden pairs, pairs an entity."""
    a, b = keys
    ends = lambda d: d.select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y"))
    c, g = ends(cand).distinct(), ends(gold).distinct()
    sizes = cand.agg(F.count("*").alias("candidate_set_length")).crossJoin(g.agg(F.count("*").alias("golden"))).crossJoin(entities.agg(F.count("*").alias("entities"))).crossJoin(_hits(c, g, ["x", "y"]))
    return sizes.select("candidate_set_length", F.try_divide("candidate_set_length", "entities").alias("pair_entity_ratio"), F.try_divide("hits", "candidate_set_length").alias("precision"), F.try_divide("hits", "golden").alias("recall"))


def place_stats(cand: DataFrame, gold: DataFrame) -> DataFrame:
    """Directed placeId pairs, distinct on both sides."""
    keys = ["placeId1", "placeId2"]
    c, g = cand.select(*keys).distinct(), gold.select(*keys).distinct()
    sizes = c.agg(F.count("*").alias("candidates")).crossJoin(g.agg(F.count("*").alias("golden"))).crossJoin(_hits(c, g, keys))
    return sizes.select("candidates", F.try_divide("hits", "candidates").alias("precision"), F.try_divide("hits", "golden").alias("recall"))


def marked_blocking_stats(cand: DataFrame, golden: Column, gold: DataFrame, entities: DataFrame) -> DataFrame:
    """``blocking_stats`` where both sides are distinct and ``golden`` tells of a candidate whether it is among ``gold``: pairs are only counted."""
    hits = cand.agg(F.count("*").alias("candidate_set_length"), F.count_if(golden).alias("hits"))
    sizes = hits.crossJoin(gold.agg(F.count("*").alias("golden"))).crossJoin(entities.agg(F.count("*").alias("entities")))
    return sizes.select("candidate_set_length", F.try_divide("candidate_set_length", "entities").alias("pair_entity_ratio"), F.try_divide("hits", "candidate_set_length").alias("precision"), F.try_divide("hits", "golden").alias("recall"))


def marked_place_stats(cand: DataFrame, golden: Column, gold: DataFrame) -> DataFrame:
    """``place_stats`` of distinct pairs of ids, which carry ``solo`` of both ends (the place has one row) and tell golden ones.

    Pairs of two such places can't come twice and are only counted; the rest is made distinct and joined.
    """
    keys = ["placeId1", "placeId2"]
    rest = lambda d: d.where("not solo1").select(*keys).unionByName(d.where("solo1 and not solo2").select(*keys)).distinct()
    c, g = rest(cand), rest(gold)
    parts = [
        cand.where("solo1 and solo2").agg(F.count("*").alias("c1"), F.count_if(golden).alias("h1")), gold.where("solo1 and solo2").agg(F.count("*").alias("g1")),
        c.agg(F.count("*").alias("c2")), g.agg(F.count("*").alias("g2")), _hits(c, g, keys).withColumnRenamed("hits", "h2"),
    ]
    sizes = parts[0]
    for p in parts[1:]:
        sizes = sizes.crossJoin(p)
    sizes = sizes.select(F.expr("c1 + c2").alias("candidates"), F.expr("g1 + g2").alias("golden"), F.expr("h1 + h2").alias("hits"))
    return sizes.select("candidates", F.try_divide("hits", "candidates").alias("precision"), F.try_divide("hits", "golden").alias("recall"))


def confusion(df: DataFrame, truth: Column, guess: Column, *by: Column) -> DataFrame:
    t, g = truth.cast("int"), guess.cast("int")
    return df.groupBy(*by).agg(F.count_if((t == 1) & (g == 1)).alias("tp"), F.count_if((t == 0) & (g == 1)).alias("fp"), F.count_if((t == 1) & (g == 0)).alias("fn"), F.count_if((t == 0) & (g == 0)).alias("tn"))


def _rates() -> dict[str, Column]:
    tp, fp, fn, tn = map(F.col, ("tp", "fp", "fn", "tn"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return {"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn), "accuracy": ratio(tp + tn, tp + fp + fn + tn), "fpr": ratio(fp, fp + tn)}


def binary_metrics(df: DataFrame, truth: Column, score: Column, threshold: float = 0.5) -> DataFrame:
    return confusion(df, truth, score > threshold).withColumns(_rates())


def threshold_sweep(df: DataFrame, truth: Column, score: Column, steps: int = 20) -> DataFrame:
    """Rates at ``steps`` thresholds from 0, in one pass: scores are counted by the step they reach first."""
    reach = F.least(F.greatest(F.ceil(score * steps), F.lit(0)), F.lit(steps)).cast("int")  # over threshold k/steps for k < reach
    counts = df.groupBy(reach.alias("reach"), truth.cast("int").alias("t")).count()
    at = counts.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))))
    rows = at.groupBy("k").agg(
        *[F.sum(F.when(c, F.col("count")).otherwise(0)).alias(n) for n, c in (("tp", "t = 1 and reach > k"), ("fp", "t = 0 and reach > k"), ("fn", "t = 1 and reach <= k"), ("tn", "t = 0 and reach <= k")) for c in [F.expr(c)]]
    )
    return rows.withColumns(_rates()).select((F.col("k") / steps).alias("threshold"), "precision", "recall", "f1", "accuracy", F.col("recall").alias("tpr"), "fpr")


def confusion_percent(df: DataFrame, truth: Column, guess: Column) -> DataFrame:
    """Counts of all four outcomes, each one's percentage of all rows, and the rates made from them."""
    counts = confusion(df, truth, guess).withColumns(_rates())
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return counts.withColumns({f"{c}_percent": F.try_divide(F.col(c) * 100.0, total) for c in ("tp", "fp", "fn", "tn")})


def roc_auc(df: DataFrame, truth: Column, score: Column) -> DataFrame:
    """Area under the curve by rank sums over distinct scores, ties by half.

    Scores are dealt to ranges; a running sum within each range is shifted by what the
    ranges below hold, of which the driver gets one number each.
    """
    by = df.groupBy(score.alias("s")).agg(F.count_if(truth.cast("int") == 1).alias("p"), F.count_if(truth.cast("int") == 0).alias("n"))
    parts = cut(by.repartitionByRange("s").withColumn("_part", F.spark_partition_id()))
    base, total = {}, 0
    for row in parts.groupBy("_part").agg(F.sum("n").alias("n")).orderBy("_part").collect():
        base[row["_part"]], total = total, total + row["n"]
    shift = F.create_map(*[F.lit(x) for kv in base.items() for x in kv])[F.col("_part")] if base else F.lit(0)
    below = F.sum("n").over(W.partitionBy("_part").orderBy("s").rowsBetween(W.unboundedPreceding, -1))
    return parts.withColumn("below", F.coalesce(below, F.lit(0)) + shift).agg(F.try_divide(F.sum(F.col("p") * (F.col("below") + F.col("n") / 2)), F.sum("p") * F.sum("n")).alias("auc"))


def rule_crosstab(df: DataFrame, name: Column, brand: Column, near: Column, pairs: Column | None = None) -> DataFrame:
    """Pairs by which rules hold, and their percentage of those for which all hold; ``pairs``: how many pairs a row stands for."""
    number = F.count("*") if pairs is None else F.sum(pairs)
    counts = df.groupBy(name.alias("name_match"), brand.alias("brand_match"), near.alias("distance_match")).agg(number.alias("pairs"))
    whole = counts.where("name_match and brand_match and distance_match").agg(F.max("pairs").alias("whole"))
    return counts.crossJoin(whole).select("name_match", "brand_match", "distance_match", "pairs", (F.col("pairs") * 100.0 / F.col("whole")).alias("percent"))
