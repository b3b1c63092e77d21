from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from tallyloom.llm import toxicity as tox
from tallyloom.llm.queries import op11_toxicity

DOCS = "doc_id long, text string, lang string, source string"
SCORE = ["doc_id", "held_out", "score", "predicted"]


def naive_logit(net: tox.Network, text: str) -> float:
    """Window by window, for one text."""
    c = tox.coded(*tox.flat(pa.array([text])))
    none = np.zeros(tox.DIM)
    words = [net.embedding[c.features[i]].sum(axis=0) for i in c.seq] or [none]
    pooled = []
    for filters, bias in zip(net.filters, net.bias):
        values = []
        for i in range(len(words)):
            window = [words[i + j] if i + j < len(words) else none for j in range(len(filters))]
            values.append(sum(v @ f for v, f in zip(window, filters)))
        pooled.append(np.maximum(np.max(values, axis=0) + bias, 0))
    return float(np.concatenate(pooled) @ net.out + net.shift[0])


def small_net(seed: int = 0) -> tox.Network:
    rng = np.random.default_rng(seed)
    embedding = rng.normal(size=(tox.BUCKETS + 1, tox.DIM)).astype(np.float32)
    embedding[-1] = 0
    n = tox.FILTERS
    return tox.Network(
        embedding, [rng.normal(size=(w, tox.DIM, n)).astype(np.float32) for w in tox.WIDTHS],
        [rng.normal(size=n).astype(np.float32) for _ in tox.WIDTHS],
        rng.normal(size=n * len(tox.WIDTHS)).astype(np.float32), np.ones(1, np.float32))


def test_pooling_equals_windows_one_by_one():
    net = small_net()
    texts = ["one", "", "a b a b c", "Größe straße ñandú", "x " * 50 + "last", "!!!", None]
    got = net.logits(tox.coded(*tox.flat(pa.array(texts, pa.string()))))
    want = [naive_logit(net, t or "") for t in texts]
    assert np.allclose(got, want, atol=1e-3)


def test_gradient_of_a_filter_matches_differences():
    label, weight = np.array([1.0, 0.0, 1.0]), np.ones(3)
    c = tox.coded(*tox.flat(pa.array(["a b c", "d e", "f a g"])))

    def loss(net: tox.Network) -> float:
        z = net.logits(c).astype(np.float64)
        return float(np.mean(np.log1p(np.exp(-np.where(label > 0, z, -z)))))

    net = small_net(3)
    before = [p.copy() for p in net.parts()]
    squares = [np.full_like(p, 1.0) for p in net.parts()]
    at = (1, 2, 3)
    slopes = []
    for sign in (1, -1):
        moved = small_net(3)
        moved.filters[1][at] += sign * 1e-2
        slopes.append(loss(moved))
    tox.step(net, c, label, weight, np.ones(tox.BUCKETS + 1, bool), squares,
             np.ones(tox.BUCKETS + 1, np.float32))
    moved = (before[1][at] - net.filters[1][at]) / tox.RATE
    grad = moved / np.sqrt(max(1e-12, 1 - moved * moved)) if abs(moved) < 1 else moved
    assert grad == pytest.approx((slopes[0] - slopes[1]) / 2e-2, abs=2e-3)


def test_prefixes_follow_characters():
    c = tox.coded(*tox.flat(pa.array(["ñañañañ ñañ"])))
    assert len(c.seq) == 2 and len(c.features) == 2
    long, short = c.features[c.seq[0]], c.features[c.seq[1]]
    assert (long < tox.BUCKETS).all()
    assert short[1] == long[1] and (short[2:] == tox.BUCKETS).all()


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    got = op11_toxicity(spark, folder)
    assert got.columns[:4] == SCORE
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("toxic is not null")
    rows = got.where("held_out").join(labels, "doc_id").select("predicted", "toxic").toPandas()
    hit = ((rows.predicted == 1) & (rows.toxic == 1)).sum()
    assert hit / rows.predicted.sum() >= 0.9
    assert hit / rows.toxic.sum() >= 0.75


def planted(spark):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(600):
        words = [f"{a}{b}" for a, b in zip(rng.choice(list("bdfgklmn"), 30),
                                           rng.choice(["ando", "ire", "esto"], 30))]
        bad = i % 4 == 0
        if bad:
            words[int(rng.integers(30))] = "vile" + str(rng.choice(["", "ness", "st"]))
        rows.append((i, " ".join(words), "xx" if i % 2 else "yy", "web"))
        labels.append((i, 0, int(bad)))
    docs = spark.createDataFrame(rows, DOCS)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_inputs_of_a_score_are_texts_only(spark):
    docs, labels = planted(spark)
    model = tox.learned(docs, labels)
    base = {r.doc_id: r.score for r in tox.score(docs, model).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert np.mean([(base[i] >= 0.5) == truth[i] for i in base]) > 0.97
    # labels of held-out rows and the lang of rows that are scored change nothing
    flipped = labels.selectExpr(
        "doc_id", "quality",
        "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - toxic, toxic) as toxic")
    assert tox.learned(docs, flipped) == model
    other = docs.selectExpr("doc_id + 1000 as doc_id", "text", "'zz' as lang", "'s' as source")
    moved = {r.doc_id: r.score for r in tox.score(other, model).collect()}
    assert all(moved[i + 1000] == base[i] for i in base)


def test_cases(spark):
    docs, labels = planted(spark)
    odd = spark.createDataFrame([
        (None, "vile words", None, None), (7000, None, None, None), (7001, "", "xx", None),
        (7002, "?! --", "xx", None), (7003, "vile", "xx", None), (7003, "vile", "xx", None),
        (7004, "bando " * 300_000 + "vile", "yy", None)], DOCS)
    labels = labels.union(spark.createDataFrame(
        [(None, 1, 1), (7001, None, None), (3, 0, 5), (7003, 0, 0), (7003, 0, 1)],
        labels.schema))
    both = docs.union(odd).withColumn("score", docs.doc_id).withColumn("toxic", docs.lang)
    got = tox.classify(both, labels).collect()
    assert len(got) == 607
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[None][0].held_out is False and by[None][0].predicted == 1
    empty = {by[i][0].score for i in (7000, 7001, 7002)}
    assert len(empty) == 1 and empty.pop() < 0.5
    assert len(by[7003]) == 2 and by[7004][0].predicted == 1
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_without_labels_or_rows(spark):
    docs, labels = planted(spark)
    none = tox.classify(docs.limit(5), labels.where("toxic = 0")).collect()
    assert [r.score for r in none] == [0.0] * 5 and not any(r.predicted for r in none)
    assert tox.classify(docs.limit(0), labels).count() == 0


def test_all_labelled_rows_are_learned_from(spark, monkeypatch):
    # words that only rows beyond any sample, or only long texts, have a label for
    monkeypatch.setattr(tox, "SHARD_ROWS", 200)
    docs, labels = planted(spark)
    rng = np.random.default_rng(8)
    filler = lambda n: " ".join(rng.choice(["bando", "fire", "gesto", "lire"], n))
    bad = lambda i: i % 2
    long = [(i, filler(5000) + (" foulword" if bad(i) else "") + f" u{i}", "xx", "web")
            for i in range(10_000, 10_060)]
    assert all(len(r[1]) > 16_384 for r in long)
    docs = docs.union(spark.createDataFrame(long, DOCS))
    labels = labels.union(spark.createDataFrame([(r[0], 0, bad(r[0])) for r in long],
                                                labels.schema))
    rows = tox.training_rows(docs, labels)
    free = [i for i in [*range(600), *range(10_000, 10_060)] if crc32(str(i).encode()) % 5]
    assert sorted(r.doc_id for r in rows.collect()) == free
    trained = []
    monkeypatch.setattr(tox, "train", lambda shards, names: trained.append(shards))
    tox.learned(docs, labels)
    shards = [tox.Shard(r.shard, r.data) for r in trained[0].collect()]
    assert len(shards) == 3
    assert sum(len(s.rows(k)[1]) for s in shards for k in ("seen", "unseen")) == len(free)
    monkeypatch.undo()
    monkeypatch.setattr(tox, "SHARD_ROWS", 200)
    model = tox.learned(docs, labels)
    texts = [("foulword " + filler(30)), filler(30), "vileness " + filler(30)]
    got = tox.Model(model).scores(pa.array(texts))
    assert got[0] >= 0.5 and got[1] < 0.5 and got[2] >= 0.5


def test_texts_in_portions_are_coded_as_at_once():
    texts = ["one two", "", "two three three", "ñandú", "one"]
    whole = tox.coded(*tox.flat(pa.array(texts)))
    parts = tox.joined([tox.coded(*tox.flat(pa.array(texts[a:b]))) for a, b in ((0, 2), (2, 5))])
    assert (parts.features == whole.features).all() and (parts.seq == whole.seq).all()
    assert (parts.offsets == whole.offsets).all()


def test_a_text_with_many_copies_is_learned_once(spark):
    docs, labels = planted(spark)
    copies = spark.range(2000, 2400).selectExpr("id as doc_id", "'same text' as text",
                                                "'xx' as lang", "'s' as source")
    more = labels.union(copies.selectExpr("doc_id", "0", "0"))
    rows = tox.training_rows(docs.union(copies).union(copies), more)
    assert rows.where("doc_id >= 2000").count() == 1
    assert rows.count() == rows.select("h1", "h2").distinct().count()
