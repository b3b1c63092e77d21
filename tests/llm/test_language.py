import tracemalloc
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from tallyloom.llm import language as g

ROWS = [(1, "The cat and the dog, the END!", "en"), (2, "der Hund und die Katze über Österreich", "de"),
        (3, "the other thing that they thought", "en"), (4, "und der die das über alles", "de"),
        (5, None, "en"), (6, "", "de"), (7, "12 34 — …", "en"), (8, "no label here", None)]


def slow_grams(text):
    raw = "".join(c.lower() for c in text).encode()
    text = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in raw)
    out = Counter()
    for word in text.split(b" "):
        if word:
            word = b" " + word + b" "
            for n in range(1, 5):
                for i in range(len(word) - n + 1):
                    if word[i:i + n] != b" ":
                        # the space between two words is one byte of the text
                        out[int.from_bytes(word[i:i + n], "big")] += 1
    return out


def test_profiles_and_distances_are_those_of_the_definition(spark):
    docs = spark.createDataFrame([(*r, "x") for r in ROWS],
                                 "doc_id long, text string, lang string, score string")
    got = {}
    for r in g.train(docs, kept=30).collect():
        got.setdefault(r.lang, {})[r.place] = r.gram
    profiles = {}
    for lang in ("de", "en"):
        counts = sum((slow_grams(t) for _, t, x in ROWS if x == lang and t), Counter())
        order = sorted(counts, key=lambda k: (-counts[k], k))[:30]
        assert [got[lang][i] for i in range(len(order))] == order
        profiles[lang] = order
    found = g.predict(docs.drop("score", "lang"), g.collect_profiles(g.train(docs, kept=30), 30))
    for r, (_, text, _) in zip(sorted(found.collect()), ROWS):
        if not text or not any(map(str.isalpha, text)):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        counts = slow_grams(text)
        top = sorted(counts, key=lambda k: (-counts[k], k))[:30]
        far = {x: sum(abs(i - p.index(k)) if k in p else 30 for i, k in enumerate(top))
               for x, p in profiles.items()}
        best = min(far, key=lambda x: (far[x], x))
        assert r.lang_pred == best
        assert abs(r.score - (1 - far[best] / (30 * len(top)))) < 1e-12


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in g.predict(docs, g.learned(docs)).collect()] == ["und"]
    assert g.predict(docs.where("false"), g.learned(docs)).collect() == []


def test_any_number_of_labels(spark):
    """20,000 languages of two words each: no cap, and each text finds its own."""
    def word(i):
        return "".join(chr(97 + (i // 26 ** k) % 26) for k in range(4))

    docs = spark.range(20_000, numPartitions=4).select(
        F.col("id").alias("doc_id"), F.udf(
            lambda i: f"{word(i)} {word(i * 7 + 3)} {word(i)}", "string")("id").alias("text"),
        F.format_string("l%05d", "id").alias("lang"))
    profiles = g.collect_profiles(g.train(docs, kept=20), 20)
    assert len(profiles.names) == 20_000 and profiles.names == sorted(profiles.names)
    found = g.predict(docs, profiles).agg(
        F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score")).first()
    assert found[0] > 19_900 and found[1] > 0.9


def test_profiles_leave_a_task_before_they_fill_it(spark, monkeypatch):
    docs = spark.createDataFrame([(*r, "x") for r in ROWS * 3],
                                 "doc_id long, text string, lang string, score string")
    whole = sorted(g.train(docs, kept=30).collect())
    monkeypatch.setattr(g, "HELD", 10)
    monkeypatch.setattr(g, "pieces", lambda batches: (
        b.slice(i, 1) for b in batches for i in range(b.num_rows)))
    assert sorted(g.train(docs, kept=30).collect()) == whole


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = g.predict(docs, g.learned(docs)).where(g.third(F.col("doc_id")) == 1)
    right, n = found.where("lang is not null").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 200 and right > 0.97


def test_little_memory_beside_a_batch():
    """A batch of 8 MB is numbered in small parts, not whole or by the megabyte."""
    batch = pa.record_batch({"text": ["one more word, " * 140] * 4000})
    tracemalloc.start()
    try:
        assert sum(len(g.grams(piece.column("text"))[0]) for piece in g.pieces([batch])) > 10 ** 7
        assert tracemalloc.get_traced_memory()[1] < 40 << 20
    finally:
        tracemalloc.stop()
