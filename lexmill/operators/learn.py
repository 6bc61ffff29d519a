"""Rankers over vectors: standardised logistic regression, pairwise differences within groups, leave-one-group-out, permutation tests."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def balanced(df: DataFrame, label: str = "y", group_weight: str | None = None) -> DataFrame:
    """Rows with a weight that gives both classes the same sum."""
    counts = df.groupBy(label).agg(F.count("*").alias("_own"))
    total = counts.agg(F.sum("_own").alias("_all"))
    w = F.col("_all") / (2 * F.col("_own"))
    return df.join(F.broadcast(counts), label).join(F.broadcast(total)).withColumn("w", w * F.col(group_weight) if group_weight else w).drop("_own", "_all")  # two rows and one row


def fit_logistic(df: DataFrame, vector: str = "v", label: str = "y", reg: float = 0.1, components: int | None = None, intercept: bool = True, weight: str | None = None):
    """Standardise, optionally reduce, and fit; a pipeline model."""
    stages = [StandardScaler(inputCol="_x", outputCol="_s", withMean=intercept, withStd=True)]
    features = "_s"
    if components:
        stages.append(PCA(k=components, inputCol="_s", outputCol="_p"))
        features = "_p"
    lr = LogisticRegression(featuresCol=features, labelCol=label, regParam=reg, fitIntercept=intercept, maxIter=60)
    if weight:
        lr = lr.setWeightCol(weight)
    return Pipeline(stages=[*stages, lr]).fit(df.withColumn("_x", array_to_vector(vector)))


def score(model, df: DataFrame, vector: str = "v") -> DataFrame:
    """df with the probability of the positive class."""
    out = model.transform(df.withColumn("_x", array_to_vector(vector)))
    return out.select(*df.columns, F.element_at(vector_to_array("probability"), 2).alias("score"))


def differences(df: DataFrame, group: str, vector: str = "v", label: str = "y", key: str = "k", sample: int = 20) -> DataFrame:
    """Difference vectors of a positive and a negative of one group, both ways round.

    Each positive meets `sample` negatives by a seeded order, so the rows grow with the positives and not with their square."""
    order = F.xxhash64(F.col(key), F.lit("order"))
    neg = df.filter(F.col(label) == 0).withColumn("n", F.row_number().over(W.partitionBy(group).orderBy(order)) - 1)
    size = neg.groupBy(group).agg(F.count("*").alias("m"))
    pos = df.filter(F.col(label) == 1).join(size, group).select(group, F.col(vector).alias("a"), F.explode(F.sequence(F.lit(0), F.least(F.col("m"), F.lit(sample)).cast("int") - 1)).alias("i"), "m", F.pmod(F.xxhash64(key), F.col("m")).alias("s"))
    pairs = pos.withColumn("n", F.pmod(F.col("s") + F.col("i"), F.col("m")).cast("int")).join(neg.select(group, "n", F.col(vector).alias("b")), [group, "n"])
    d = F.zip_with("a", "b", lambda x, y: x - y)
    return pairs.select(group, F.explode(F.array(F.struct(d.alias("v"), F.lit(1.0).alias("y")), F.struct(F.transform(d, lambda x: -x).alias("v"), F.lit(0.0).alias("y")))).alias("p")).select(group, "p.v", "p.y")


def auc(df: DataFrame, by: list[str], score_: str = "score", label: str = "y") -> DataFrame:
    """Area under the curve of each group by rank sums with average ranks for ties; null without both classes.

    Scores are counted first, so ranks are running sums over distinct scores."""
    counts = df.groupBy(*by, score_).agg(F.count("*").alias("n"), F.sum(F.col(label).cast("double")).alias("p"))
    w = W.partitionBy(*by).orderBy(score_).rowsBetween(W.unboundedPreceding, -1)
    ranks = counts.withColumn("r", F.coalesce(F.sum("n").over(w), F.lit(0)) + (F.col("n") + 1) / 2)
    g = ranks.groupBy(*by).agg(F.sum(F.col("p") * F.col("r")).alias("s"), F.sum("p").alias("p"), F.sum("n").alias("n"))
    bad = F.col("n") - F.col("p")
    return g.select(*by, F.when((F.col("p") > 0) & (bad > 0), (F.col("s") - F.col("p") * (F.col("p") + 1) / 2) / (F.col("p") * bad)).alias("auc"))


def leave_one_out(df: DataFrame, group: str, vector: str = "v", label: str = "y", key: str = "k", reg: float = 0.1) -> DataFrame:
    """Scores of each group by a model of the others. The groups' names are few (rooms, labels) and steer the fits from the driver."""
    out = None
    for (g,) in df.select(group).distinct().orderBy(group).collect():
        model = fit_logistic(balanced(df.filter(F.col(group) != g), label), vector, label, reg, weight="w")
        part = score(model, df.filter(F.col(group) == g), vector).select(group, key, label, "score")
        out = part if out is None else out.unionByName(part)
    return out


def permutation_p(df: DataFrame, group: str, rounds: int = 200, score_: str = "score", label: str = "y", key: str = "k") -> DataFrame:
    """p of the mean difference of scores between classes: labels are shuffled within groups by seeded orders; (at least as great + 1) / (rounds + 1)."""
    real = df.agg((F.avg(F.when(F.col(label) == 1, F.col(score_))) - F.avg(F.when(F.col(label) == 0, F.col(score_)))).alias("real"))
    w = lambda c: F.row_number().over(W.partitionBy("t", group).orderBy(c, key))
    base = df.select(group, key, score_, label).withColumn("t", F.explode(F.sequence(F.lit(1), F.lit(rounds))))
    a = base.withColumn("n", w(F.xxhash64(F.col(key), F.col("t")))).select("t", group, "n", F.col(label).alias("y"))
    b = base.withColumn("n", w(F.col(key))).select("t", group, "n", F.col(score_).alias("s"))
    drawn = a.join(b, ["t", group, "n"]).groupBy("t").agg((F.avg(F.when(F.col("y") == 1, F.col("s"))) - F.avg(F.when(F.col("y") == 0, F.col("s")))).alias("d"))
    return drawn.join(F.broadcast(real)).agg(F.first("real").alias("real"), ((F.count_if(F.col("d") >= F.col("real")) + 1) / (F.count("*") + 1)).alias("p"))  # one row
