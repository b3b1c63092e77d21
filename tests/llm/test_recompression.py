import hashlib
import random
import re

import numpy as np
import pytest

from tallyloom.llm import recompression as r


def brute(rows, window=13):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    big = 1 << 63
    first = {}
    for (doc, _), w in zip(rows, split):
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            doc_key = big if doc is None else doc
            first[key] = min(first.get(key, big), doc_key)
    out = []
    for (doc, _), w in zip(rows, split):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (big if doc is None else doc):
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((doc, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(map(str, out))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    vocabulary = ["a", "b", "é", "\x00", "日本", "the", "The", *(f"w{i}" for i in range(40))]

    def words(n, few=False):
        return [rng.choice(vocabulary[:2] if few else vocabulary) for _ in range(n)]

    passages = [words(n) for n in (12, 13, 14, 30, 60)] + [["a"] * 20, ["a", "b"] * 15]
    texts = []
    for _ in range(70):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += rng.choice(passages) if rng.random() < 0.6 else words(rng.randint(1, 40),
                                                                           rng.random() < 0.3)
        texts.append(rng.choice([" ", "\n", " \t", " x "]).join(parts))
    texts += [texts[3], texts[3], texts[4], None, "", "   ", " ".join(passages[4]) * 200, "a " * 13,
              "a " * 40, "b " * 12]
    found = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(found)
    return found + [(5, texts[7]), (None, texts[9]), (None, " ".join(passages[3])), (6, texts[6]),
                    (None, " ".join(words(20)))]


def result(spark, rows):
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, h int")
    got = r.dedup_substrings(docs.repartition(3)).collect()
    return sorted(map(str, map(tuple, got)))


def test_same_words_go_as_by_all_windows(spark, rows):
    assert result(spark, rows) == brute(rows)


def test_the_largest_id_is_no_null(spark, rows):
    largest = (1 << 63) - 1
    more = rows + [(largest, rows[0][1]), (largest, None), (largest - 1, "own words only")]
    assert result(spark, more) == brute(more)


def test_shards_and_buckets_find_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(r, "SHARD_BYTES", 2000)
    monkeypatch.setattr(r, "BUCKET_BYTES", 1500)
    assert result(spark, rows) == brute(rows)
    assert result(spark, []) == []


def test_symbols_depend_on_what_they_say():
    rng = np.random.default_rng(3)
    words = r.mix(rng.integers(0, 4, 400).astype(np.uint64))
    s = r.recompress(words, np.zeros(400, np.int64))
    for _ in range(40):  # other words outside of what a symbol depends on change nothing
        k = rng.integers(0, len(s.name))
        if s.low[k] < 0 or s.high[k] >= 400:
            continue
        other = r.mix(rng.integers(0, 4, 400).astype(np.uint64))
        other[s.low[k]:s.high[k] + 1] = words[s.low[k]:s.high[k] + 1]
        t = r.recompress(other, np.zeros(400, np.int64))
        at = np.flatnonzero((t.first == s.first[k]) & (t.last == s.last[k]))
        assert len(at) == 1 and t.name[at[0]] == s.name[k]
        assert (t.low[at[0]], t.high[at[0]]) == (s.low[k], s.high[k])
