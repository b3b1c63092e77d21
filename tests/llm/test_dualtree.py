import math
import re
from collections import Counter

import numpy as np
import pytest

from tallyloom.llm import dualtree as dual

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute_force(docs, items, best=10):
    held = [(i, Counter(words(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        rows = []
        for doc, c in held:
            m = 100 - 90 + (90 * sum(c.values()) * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(words(text)) if c[t])
            if score > 0:
                rows.append((-score, doc is None, doc or 0, doc))
        rows.sort(key=lambda r: r[:3])
        out += [(item, k, r[3], -r[0]) for k, r in enumerate(rows[:best], start=1)]
    return sorted(out, key=str)


def ranked(spark, docs, items, parts=3, **options):
    d, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    found = dual.rank_documents(d.repartition(parts), b.repartition(2), **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


def corpus(seed, n_docs=700, n_items=70):
    rng = np.random.default_rng(seed)
    stock = [f"w{int(x)}" for x in rng.zipf(1.3, 5000) if x < 3000]

    def text(n):
        return " ".join(rng.choice(stock, n))

    items = [(i, text(int(rng.integers(1, 40)))) for i in range(n_items)]
    docs = []
    for i in range(n_docs):
        body = text(int(rng.integers(1, 120)))
        if i % 9 == 0:
            body += " " + items[int(rng.integers(n_items))][1]
        docs.append((i, body))
    return docs, items


@pytest.mark.parametrize("best", [1, 10])
def test_equals_brute_force(spark, best):
    docs, items = corpus(3)
    assert ranked(spark, docs, items, best=best) == brute_force(docs, items, best)


def test_many_blocks_and_vocabulary_files(spark, monkeypatch):
    docs, items = corpus(4, 200, 40)
    items.append((99, " ".join(t for _, t in docs[:60])))
    monkeypatch.setattr(dual, "CELLS", 400)
    monkeypatch.setattr(dual, "VOCABULARY", 50)
    monkeypatch.setattr(dual, "PART_CELLS", 64)
    assert ranked(spark, docs, items) == brute_force(docs, items)


def test_copies_go_by_id_and_nulls_last(spark):
    docs = [(i, "same words here") for i in range(500, 100, -1)] + [(None, "same words here")] * 3
    docs += [(7, "other"), (7, "other"), (8, ""), (9, None), (10, "!? --"), (2, "Same ÉÉ same")]
    items = [(1, "same"), (1, "same"), (None, "other"), (3, None), (4, ""), (5, "unknown"),
             (6, "ÉÉ SAME"), (6, "words words")]
    assert ranked(spark, docs, items) == brute_force(docs, items)
    few = [(None, "a b"), (3, "a b"), (None, "a c")]
    assert ranked(spark, few, [(1, "a b c")]) == brute_force(few, [(1, "a b c")])


def test_empty_tables_long_texts_and_other_columns(spark):
    docs, items = corpus(5, 50, 5)
    assert ranked(spark, [], items) == [] and ranked(spark, docs, []) == []
    docs.append((1000, "long " * 400_000 + items[0][1]))
    want = brute_force(docs, items)
    assert ranked(spark, docs, items) == want
    d = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 as n", "2 as no", "text as terms")
    b = spark.createDataFrame(items, ITEMS).selectExpr("*", "1 as no", "2 as score")
    assert sorted(map(tuple, dual.rank_documents(d, b).collect()), key=str) == want


def test_bounds_prune_most_pairs():
    docs, items = corpus(6, 4000, 60)
    names = {t: i for i, t in enumerate(sorted({t for _, x in items for t in words(x)}))}
    counts = [Counter(t for t in words(x) if t in names) for _, x in docs]
    ptr = np.concatenate([[0], np.cumsum([len(c) for c in counts])])
    pairs = [sorted((names[t], k) for t, k in c.items()) for c in counts]
    terms = np.array([t for row in pairs for t, _ in row])
    times = np.array([k for row in pairs for _, k in row])
    n = np.array([len(words(x)) for _, x in docs])
    df = np.bincount(terms, minlength=len(names))
    at = [sorted({names[t] for t in words(x)}) for _, x in items]
    weights = np.array([dual.weight(int(x), len(docs)) for x in df])
    item_ptr = np.concatenate([[0], np.cumsum([len(a) for a in at])])
    flat = np.array([t for a in at for t in a])
    order = dual.similar_order(item_ptr, flat, weights, np.arange(len(at)))
    item_ptr, flat = dual.reordered(item_ptr, order, flat)
    block = {"term": np.arange(len(names)), "weight": weights, "ptr": item_ptr, "at": flat}
    leaves = dual.document_leaves(block, n, ptr, terms, times, len(docs), int(n.sum()))
    search = dual.Search(block, leaves, 10)
    search.run()
    assert search.exact < 0.5 * len(items) * len(docs)


def test_share_of_very_many_words():
    n = np.array([10 ** 9, 5])
    got = dual.share(np.array([3, 1]), n, 10 ** 11, 4 * 10 ** 13)
    want = [1_000_000_000 * k // (1000 * k + 8 * (10 + 90 * x * 10 ** 11 // (4 * 10 ** 13)))
            for k, x in ((3, 10 ** 9), (1, 5))]
    assert got.tolist() == want
