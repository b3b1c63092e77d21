import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import importance as m

DOCS = [(1, "good words here " * 60, "x"), (2, "Good WORDS there", "x"), (3, "bad junk " * 200, "x"),
        (4, None, "x"), (5, "", "x"), (None, "good junk", "x"), (3, "bad junk", "x")]
LABELS = [(1, 1, 0), (2, 1, 0), (3, 0, 0), (2, 1, None), (None, 1, 0), (6, 1, 1)]


def m_bucket(gram):
    """Words and pairs as they are: the few of this test share no bucket."""
    return gram


def tables(spark):
    return (spark.createDataFrame(DOCS, "doc_id long, text string, target string"),
            spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int"))


def test_weights_are_those_of_the_models(spark):
    docs, labels = tables(spark)
    found = {}
    for r in m.resample(docs, labels, share=0.5).collect():
        found[r.doc_id, r.n_words] = r

    def grams(text):
        w = (text or "").split()
        return w + list(zip(w, w[1:]))

    raw = Counter(m_bucket(g) for _, t, _ in DOCS for g in grams(t))
    target = Counter(m_bucket(g) for g in grams(DOCS[0][1]))  # 2 has conflicting labels
    scale = sum(target.values()) / sum(raw.values())

    def ratio(b):
        """Posterior mean of the log ratio: a normal prior, a measurement of variance 1/(e+1)."""
        e = raw[b] * scale
        measured, spread = math.log(target[b] + 1) - math.log(e + 1), 1 / (e + 1)
        return (measured / spread) / (1 / m.PRIOR + 1 / spread)

    assert sum(ratio(b) != 0 for b in raw) == len(raw)

    for doc, text, _ in DOCS:
        want = sum(ratio(m_bucket(g)) for g in grams(text))
        assert found[doc, len((text or "").split())].log_weight == pytest.approx(want, abs=1e-9)
    assert found[3, 400].log_weight < 0 < found[1, 180].log_weight
    rows = m.resample(docs, labels, share=0.5).collect()
    noise = {(r.doc_id, r.n_words): r.gumbel_key - r.log_weight for r in rows}
    assert len({round(x, 9) for x in noise.values()}) == len(DOCS)  # equal ids, other texts
    assert sorted(r.place for r in rows) == list(range(1, len(DOCS) + 1))
    keys = sorted((r.gumbel_key for r in rows), reverse=True)
    assert sum(r.selected for r in rows) == round(len(DOCS) / 2)
    assert all(r.gumbel_key == keys[r.place - 1] for r in rows)


def test_all_buckets_have_a_ratio_near_the_true_one(spark):
    """Two known bag models: the ratios found are theirs, drawn towards 0 by little."""
    rng = np.random.default_rng(5)
    n = 400
    raw, target = rng.dirichlet(np.full(n, 10.0)), rng.dirichlet(np.full(n, 10.0))
    mixed = raw * 0.9 + target * 0.1
    good = rng.multinomial(200_000, target)
    every = good + rng.multinomial(1_800_000, raw)
    counts = spark.createDataFrame([(i, int(good[i]), int(every[i])) for i in range(n)],
                                   "bucket long, target long, raw long")
    found, true = m.log_ratios(counts, n), np.log(target / mixed)
    assert np.count_nonzero(found) == n
    assert np.abs(found - true).max() < 0.3
    assert np.corrcoef(found, true)[0, 1] > 0.98


def test_draws_in_proportion_to_the_weights(spark):
    weights = np.log([1.0, 2.0, 4.0, 9.0])
    rows = [(i, 1, float(w)) for i, w in enumerate(weights)]
    frame = spark.createDataFrame(rows, "doc_id long, n_words long, log_weight double")
    noise = frame.crossJoin(spark.range(4000).withColumnRenamed("id", "seed"))
    uniform = (F.pmod(F.xxhash64("doc_id", "seed"), F.lit(1 << 52)) + 0.5) / F.lit(2.0 ** 52)
    first = noise.withColumn("k", F.col("log_weight") - F.log(-F.log(uniform))).groupBy(
        "seed").agg(F.max_by("doc_id", "k").alias("w")).groupBy("w").count().collect()
    share = {r["w"]: r["count"] / 4000 for r in first}
    assert all(abs(share[i] - x / 16) < 0.03 for i, x in enumerate((1, 2, 4, 9)))


def test_empty_tables(spark):
    docs, labels = tables(spark)
    assert m.resample(docs.where("false"), labels).collect() == []
    assert sum(r.selected for r in m.resample(docs, labels.where("false")).collect()) == len(DOCS)


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = F.col("doc_id") % 3 == 0
    out = m.resample(docs, labels.where(~held)).join(labels.where(held), "doc_id")
    kept = {(r.quality, r.toxic): r.s for r in out.groupBy("quality", "toxic").agg(
        F.avg(F.col("selected").cast("double")).alias("s")).collect()}
    assert kept[1, 0] > 0.9 and kept[1, 1] < 0.45 and kept[0, 0] < 0.1, kept
