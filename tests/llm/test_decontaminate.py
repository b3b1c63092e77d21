import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tallyloom.llm import decontaminate as d


def words(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="module")
def case():
    rng = random.Random(5)
    vocabulary = ["aa", "bb", "cc", "Dé", "x9", "ß", "日本"]
    items = [(i, words(rng, n, vocabulary)) for i, n in enumerate([0, 1, 4, 10, 12, 30, 30])]
    items[1] = (1, "rare")
    items += [(5, items[5][1]), (7, None), (None, "one two THREE")]
    texts = [words(rng, rng.choice([0, 3, 9, 40]), vocabulary) for _ in range(30)]
    texts += [None, "", "...", "rare. RARE-rare", "x " + items[5][1].upper() + ", aa",
              items[4][1][5:], items[6][1], items[6][1], "One, two; three",
              (items[5][1] + " foreign ") * 3000]
    return texts, items


def test_suffix_order_is_that_of_all_suffixes():
    rng = np.random.default_rng(1)
    for sigma, n in ((1, 50), (2, 300), (40, 400)):
        s = rng.integers(0, sigma + 1, n)
        s[-1] = 0
        stops = np.cumsum(s == 0)
        full = [tuple(x + n if x else k for x, k in zip(s[i:].tolist(), (stops[i:] - 1).tolist()))
                for i in range(n)]
        assert d.suffix_order(s.copy()).tolist() == sorted(range(n), key=lambda i: full[i])


def test_same_hits_as_word_by_word(spark, case):
    texts, items = case
    docs = spark.createDataFrame(
        [(i if i % 7 else None, t, "x") for i, t in enumerate(texts)],
        "doc_id long, text string, items string").repartition(3)
    bench = spark.createDataFrame(items, "item_id int, text string")
    got = d.find_hits(docs, bench).withColumn("sha", d.digest(d.F.col("items")))
    got = sorted(((r.doc_id or -1, r.n_words, r.n_hit, r.sha) for r in got.collect()))
    named = [("" if k is None else k, t) for k, t in items if t]
    want = d.brute_force(texts, named)
    assert got == sorted((i if i % 7 else -1, *w) for i, w in enumerate(want))


def test_spans_are_cut_out(spark, case):
    _, items = case
    text = f"Été début {items[5][1]}. Fin"
    docs = spark.createDataFrame([(1, text, 5, "k"), (2, "clean text", 5, "k"), (3, None, 0, "k")],
                                 "doc_id long, text string, n_chars long, items string")
    bench = spark.createDataFrame(items[5:6], "item_id int, text string")
    got = {r.doc_id: r for r in d.remove_hits(docs, bench).collect()}
    assert got[1].text == "Été début . Fin" and got[1].n_chars == len(got[1].text)
    assert got[2].text == "clean text" and got[2].n_chars == 5 and got[3].text is None


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = docs.where("false").withColumnRenamed("doc_id", "item_id")
    assert [r.n_hit for r in d.find_hits(docs, none).collect()] == [0]
    assert d.find_hits(docs.where("false"), none).collect() == []


def test_blocks_of_the_benchmark(spark, case, monkeypatch):
    texts, items = case
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([x for x in items if x[1]], "item_id int, text string")
    one = sorted(map(str, d.find_hits(docs, bench).collect()))
    monkeypatch.setattr(d, "BLOCK_BYTES", 60)
    assert sorted(map(str, d.find_hits(docs, bench).collect())) == one


def test_little_memory_for_a_shard():
    """A batch of 8 MB is indexed shard by shard; a shard takes some 40 MB, not 140."""
    phrases = d.compile_phrases([("1", "one two three four five six seven eight nine ten")], 10)
    batch = pa.record_batch({"text": ["other words, " * 160] * 4000})
    tracemalloc.start()
    try:
        for piece in d.pieces([batch], limit=d.SHARD_BYTES):
            assert not d.scan_shard(piece.column("text"), iter([phrases]))[1].any()
        assert tracemalloc.get_traced_memory()[1] < 120 << 20
    finally:
        tracemalloc.stop()
