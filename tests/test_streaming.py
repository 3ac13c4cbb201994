"""Fitted preparation + model score a stream exactly as they score the batch."""

import tempfile

from pyspark.ml.regression import LinearRegression

from panelforge.operators import models as K
from panelforge.operators import preparation as I
from panelforge.streaming import score_stream


def test_stream_scores_equal_batch(spark):
    rows = [(i, f"s{i % 4}", float(i % 7) if i % 5 else None, float(i % 3), float(i) * 0.5) for i in range(60)]
    schema = "PLAYER_ID long, SEASON string, a double, b double, y double"
    df = spark.createDataFrame(rows, schema)
    feats = ["a", "b"]
    fill = I.FillValues.fit(df, feats)
    scale = I.StandardScale.fit(fill.transform(df), feats)
    train = K.assemble(scale.transform(fill.transform(df)), feats)
    model = LinearRegression(featuresCol="features", labelCol="y").fit(train)

    path = tempfile.mkdtemp(prefix="pf-stream-src-")
    df.write.mode("overwrite").parquet(path)
    stream = spark.readStream.schema(df.schema).parquet(path)
    q = (score_stream(stream, feats, fill, scale, model, ["PLAYER_ID", "SEASON"], "y")
         .writeStream.format("memory").queryName("pf_scored").outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = {r["PLAYER_ID"]: r["prediction"] for r in spark.sql("SELECT * FROM pf_scored").collect()}
    batch = {r["PLAYER_ID"]: r["prediction"]
             for r in score_stream(df, feats, fill, scale, model, ["PLAYER_ID", "SEASON"], "y").collect()}
    assert got.keys() == batch.keys() and all(abs(got[k] - batch[k]) < 1e-12 for k in got)
