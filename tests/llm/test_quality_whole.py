"""The quality ranking learns from every labelled document and every pair."""

import numpy as np
from marketstar.llm import quality
from marketstar.llm.common import importable
from pyspark.sql import functions as F


def _table(spark, x, label):
    importable(spark)
    return spark.createDataFrame([(r.astype(np.float32).tobytes(), int(y)) for r, y in zip(x, label, strict=True)], "x binary, label int")


def test_every_labelled_document_is_learnt_from(spark):
    labels = spark.range(30_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    want = labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0).count()
    assert want > 20_000
    assert quality.labelled(labels, "quality", 5, 0).count() == want


def test_loss_and_gradient_are_those_of_all_pairs(spark):
    rng = np.random.default_rng(1)
    x, label = rng.random((90, quality.WIDTH)).astype(np.float32), rng.integers(0, 2, 90)
    mean, spread, weight = x.mean(0).astype(float), x.std(0).astype(float), rng.standard_normal(quality.WIDTH) / 4

    def rows_of(rows, y):
        at = np.floor(quality._strength(rows, mean, spread, weight) / quality.STEP).astype(np.int64)
        return 2 * at + y, np.concatenate([np.ones((len(rows), 1), np.int64), np.rint(rows.astype(float) / quality._UNIT).astype(np.int64)], 1)

    loss, slope = quality._pair_loss(quality._sums(_table(spark, x, label).repartition(5), rows_of), mean, spread, weight, 0.01)
    z = (x - mean) / spread
    diff = (z[label == 1][:, None] - z[label == 0][None]).reshape(-1, quality.WIDTH)
    want = np.logaddexp(0, -diff @ weight).mean() + 0.005 * weight @ weight
    want_slope = -(diff * (1 / (1 + np.exp(diff @ weight)))[:, None]).mean(0) + 0.01 * weight
    assert abs(loss - want) < 1e-3 * want
    assert np.abs(slope - want_slope).max() < 1e-2 * np.abs(want_slope).max()


def test_values_at_ranks(spark):
    values = np.round(np.random.default_rng(2).standard_normal(3_000) ** 3, 2)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for rank in (1, 2, 1_499, 1_500, 2_999, 3_000):
        assert quality._value_at(df, "v", rank) == np.sort(values)[rank - 1]
    assert quality._value_at(df.select(F.lit(0.5).alias("v")), "v", 7) == 0.5
