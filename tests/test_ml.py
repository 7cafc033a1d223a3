from conftest import SF001
from tidepool import ml


def test_kmeans_and_features(spark):
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet")
    model, scored = ml.kmeans(emb, "embedding", k=5)
    assert len(model.clusterCenters()) == 5
    assert scored.count() == emb.count()
    feats = ml.user_feature_table(spark.read.parquet(f"{SF001}/events.parquet"))
    vec = ml.assemble(feats, ["click", "error", "purchase", "value_total", "active_days"])
    row = vec.first()
    assert row.features.size == 5


def test_pca_als_and_classifiers(spark):
    from pyspark.sql import functions as F
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet")
    model, proj = ml.pca(emb, "embedding", k=3)
    assert len(model.explainedVariance) == 3 and proj.count() == emb.count()
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    inter = (ev.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("item", F.dense_rank().over(
                   __import__("pyspark.sql", fromlist=["Window"]).Window.orderBy("event_type")) - 1))
    als = ml.implicit_als(inter.select(F.col("user_id").cast("int").alias("u"), "item", "n"), "u", "item", "n")
    assert als.recommendForAllUsers(2).count() > 0
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    for kind in ("logistic", "tree", "forest", "gbt"):
        _, scored = ml.fit_label_model(docs, labels, "quality", kind=kind)
        assert scored.count() == docs.count()
