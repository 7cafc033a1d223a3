"""Distributed ML named by the reference (M10, M11), on ``pyspark.ml``.

Estimators train with Spark jobs over partitioned data; nothing is
collected except the (small) model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.operators.aggregates import money_sum

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def user_feature_table(events: DataFrame, types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    """One row per user — count per event type, total value, active
    days. Conditional counts keep it one hash aggregate (a pivot would need
    the same, plus its own distinct pass when values are not given)."""
    counts = [F.count(F.when(F.col("event_type") == t, 1)).alias(t) for t in types]
    rest = F.col("event_type").isNull() | ~F.col("event_type").isin(*types)
    counts.append(F.count(F.when(rest, 1)).alias("other"))  # no event vanishes
    return (events.groupBy("user_id")
                  .agg(*counts, money_sum("value").alias("value_total"),
                       F.count_distinct(F.to_date("ts")).alias("active_days")))


def assemble(df: DataFrame, inputs: Sequence[str], out: str = "features") -> DataFrame:
    """Feature vector for the estimators (``VectorAssembler``)."""
    from pyspark.ml.feature import VectorAssembler
    cast = df.select(*[F.col(c).cast("double").alias(c) if c in inputs else F.col(c) for c in df.columns])
    return VectorAssembler(inputCols=list(inputs), outputCol=out, handleInvalid="keep").transform(cast)


def kmeans(df: DataFrame, vector_col: str, k: int = 10, seed: int = 42, max_iter: int = 20):
    """K-means on an ``array<float>`` or vector column. Returns the
    fitted model and the rows with their ``cluster``."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql.types import ArrayType
    data = df
    if isinstance(df.schema[vector_col].dataType, ArrayType):
        data = df.withColumn(vector_col, array_to_vector(vector_col))
    data = data.persist()  # iterative: every pass reads the cached vectors
    try:
        model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=vector_col,
                       predictionCol="cluster").fit(data)
    finally:
        data.unpersist()
    return model, model.transform(data)


def pca(df: DataFrame, vector_col: str, k: int = 3):
    """Principal components of a vector (or ``array<float>``) column;
    returns the model (``explainedVariance``) and the projected rows."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql.types import ArrayType
    data = df
    if isinstance(df.schema[vector_col].dataType, ArrayType):
        data = df.withColumn(vector_col, array_to_vector(vector_col))
    data = data.persist()
    try:
        model = PCA(k=k, inputCol=vector_col, outputCol="pca").fit(data)
    finally:
        data.unpersist()
    return model, model.transform(data)


def implicit_als(interactions: DataFrame, user: str, item: str, strength: str,
                 rank: int = 8, seed: int = 42, max_iter: int = 10):
    """M10 recommendations from interactions (implicit-feedback ALS)."""
    from pyspark.ml.recommendation import ALS
    als = ALS(userCol=user, itemCol=item, ratingCol=strength, implicitPrefs=True, rank=rank,
              seed=seed, maxIter=max_iter, coldStartStrategy="drop", nonnegative=True)
    return als.fit(interactions)


def classifier(kind: str = "tree", label: str = "label", features: str = "features", seed: int = 42):
    """M10 supervised learners on an assembled feature vector:
    ``logistic`` (regression), ``tree``, ``forest``, ``gbt``."""
    from pyspark.ml import classification as C
    if kind == "logistic":
        return C.LogisticRegression(labelCol=label, featuresCol=features, maxIter=50)
    if kind == "tree":
        return C.DecisionTreeClassifier(labelCol=label, featuresCol=features, seed=seed, maxDepth=5)
    if kind == "forest":
        return C.RandomForestClassifier(labelCol=label, featuresCol=features, seed=seed, numTrees=20)
    if kind == "gbt":
        return C.GBTClassifier(labelCol=label, featuresCol=features, seed=seed, maxIter=20)
    raise ValueError(f"unknown classifier {kind!r}")


def document_features(documents: DataFrame) -> DataFrame:
    """Per-document numeric features from the whole text (length, tokens,
    lines, upper-case share, digit share) for the label models."""
    t = F.col("text")
    n = F.greatest(F.length(t), F.lit(1))
    return documents.select(
        "doc_id",
        F.length(t).cast("double").alias("chars"),
        F.size(F.split(t, " ")).cast("double").alias("tokens"),
        F.size(F.split(t, "\n")).cast("double").alias("lines"),
        (F.length(F.regexp_replace(t, "[^A-Z]", "")) / n).alias("upper_share"),
        (F.length(F.regexp_replace(t, "[^0-9]", "")) / n).alias("digit_share"))


DOC_FEATURES = ("chars", "tokens", "lines", "upper_share", "digit_share")


def fit_label_model(documents: DataFrame, labels: DataFrame, label_col: str, kind: str = "tree"):
    """Train ``kind`` on the features of the labelled documents; returns (model,
    every document scored).

    The assembled vectors of all documents are checkpointed into the shared
    folder first: the learners make several passes, which then read the small
    vectors instead of re-running the text features, and a lost executor does
    not send them back to the raw documents."""
    from tidepool.session import cut_lineage
    vec = cut_lineage(assemble(document_features(documents), list(DOC_FEATURES)).select("doc_id", "features"))
    known = vec.join(labels.select("doc_id", F.col(label_col).cast("double").alias("label")), "doc_id")
    model = classifier(kind).fit(known)
    return model, model.transform(vec)


def least_squares(df: DataFrame, target: str, inputs: Sequence[str]) -> DataFrame:
    """Ordinary least squares with an intercept: ``term``, ``estimate`` and
    ``std_error``. One aggregate computes means and covariances (the Gram matrix,
    centred, so that large means cost no digits); it is mergeable, so every task
    sends one row, and the driver solves a system as large as the inputs are
    many. Rows with a null or NaN in any used column are left out; inputs that
    depend on each other, or fewer rows than terms, raise ValueError."""
    import numpy as np
    names = list(inputs)
    cols = {c: F.col(c).cast("double") for c in [*names, target]}
    used = df.select(*[v.alias(f"c{i}") for i, v in enumerate(cols.values())]).dropna()
    k = len(names)
    pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    row = used.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"c{i}").alias(f"m{i}") for i in range(k + 1)],
                   *[F.covar_samp(f"c{i}", f"c{j}").alias(f"s{i}_{j}") for i, j in pairs]).first()
    if row.n <= k + 1:
        raise ValueError(f"{row.n} rows cannot determine {k + 1} terms")
    gram = np.zeros((k + 1, k + 1))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = row[f"s{i}_{j}"]
    mean = np.array([row[f"m{i}"] for i in range(k + 1)])
    scale = np.sqrt(np.diag(gram)[:k])
    if not scale.all() or np.linalg.matrix_rank(gram[:k, :k] / np.outer(scale, scale)) < k:
        raise ValueError("the inputs are constant or depend on each other")
    inverse = np.linalg.inv(gram[:k, :k])
    slope = inverse @ gram[:k, k]
    left = max(gram[k, k] - slope @ gram[:k, k], 0.0) * (row.n - 1) / (row.n - k - 1)
    error = np.sqrt(left * np.diag(inverse) / (row.n - 1))
    at_zero = np.sqrt(left * (1 / row.n + mean[:k] @ inverse @ mean[:k] / (row.n - 1)))
    out = [("intercept", float(mean[k] - slope @ mean[:k]), float(at_zero))]
    out += [(c, float(b), float(e)) for c, b, e in zip(names, slope, error)]
    return df.sparkSession.createDataFrame(out, "term string, estimate double, std_error double")
