import hashlib
import random

import numpy as np
import pytest

from tallyloom.llm import suffixes as s


def brute(rows, length=100):
    big = 1 << 63
    data = [(t or "").encode() for _, t in rows]
    ids = [big if d is None else d for d, _ in rows]
    least = {}
    for doc, x in zip(ids, data):
        for i in range(len(x) - length + 1):
            w = x[i:i + length]
            least[w] = min(least.get(w, big), doc)
    out = []
    for (doc, _), own, x in zip(rows, ids, data):
        gone, seen = np.zeros(len(x) + 1, bool), set()
        for i in range(len(x) - length + 1):
            w = x[i:i + length]
            if least[w] < own or w in seen:
                gone[i:i + length] = True
            seen.add(w)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(x, gone) if not g)
        out.append((doc, len(x), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, out))


@pytest.mark.parametrize("letters, n", [(1, 40), (2, 200), (4, 500), (200, 600)])
def test_suffix_array_and_common_prefixes(letters, n):
    rng = np.random.default_rng(letters)
    lengths = np.array([n // 2, 1, n // 3, 5, n // 2])
    data = rng.integers(0, letters, lengths.sum())
    data[-(n // 4):] = data[:n // 4]
    t, at = [], 0
    for k in lengths:
        t += [*(data[at:at + k] + 1), 0]
        at += k
    t = np.array(t, np.int16)
    order = s.suffix_array(t)
    stops = np.cumsum(t == 0)
    full = [tuple((int(x), 0) if x else (0, int(k)) for x, k in zip(t[i:], stops[i:] - 1))
            for i in range(len(t))]
    # an end is larger the later it is, and smaller than any symbol
    assert order.tolist() == sorted(range(len(t)), key=lambda i: full[i])
    ends = np.flatnonzero(t == 0)
    until = ends[np.searchsorted(ends, np.arange(len(t)))] - np.arange(len(t))
    got = s.common_prefixes(t, order, until)
    for a, b in zip(order[:-1], order[1:]):
        k = 0
        while k < min(until[a], until[b]) and t[a + k] == t[b + k]:
            k += 1
        assert got[b] == k


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    words = ["the", "of", "Éa", "x", "\x00", "日本語", "and,", *(f"word{i}" for i in range(50))]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passages = [prose(n) for n in (12, 25, 40, 90)] + ["a" * 150, "ab" * 90, "For " * 60]
    texts = []
    for _ in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.6 else prose(rng.randint(1, 60))
                 for _ in range(rng.randint(0, 5))]
        texts.append(rng.choice(["", " ", "\n"]).join(parts))
    texts += [texts[3], texts[3], texts[4], None, "", "x" * 99, "x" * 100, "x" * 101,
              passages[3] * 30, "a" * 5000, "For " * 700]
    found = list(enumerate(texts))
    rng.shuffle(found)
    return found + [(5, texts[7]), (None, texts[9]), (None, passages[3]), (6, texts[6])]


def result(spark, rows):
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, h int")
    return sorted(map(str, map(tuple, s.dedup_bytes(docs.repartition(3)).collect())))


def test_same_bytes_go_as_by_all_windows(spark, rows):
    assert result(spark, rows) == brute(rows)


def test_the_largest_id_is_no_null(spark, rows):
    largest = (1 << 63) - 1
    more = rows + [(largest, rows[0][1]), (largest, None), (largest - 1, "own words only")]
    assert result(spark, more) == brute(more)


def test_shards_and_buckets_find_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(s, "SHARD_BYTES", 8000)
    monkeypatch.setattr(s, "BUCKET_BYTES", 9000)
    assert result(spark, rows) == brute(rows)
    assert result(spark, []) == []


def test_portions(rows, monkeypatch):
    texts = [np.frombuffer((t or "").encode()[:160], np.uint8) for _, t in rows]
    texts = [t for t in texts if len(t) >= 100]
    keys = np.array([hash(t[60:90].tobytes()) % 5 for t in texts], np.uint64)
    whole = s.class_texts(texts, np.zeros(len(texts), np.uint64), 100)
    monkeypatch.setattr(s, "PORTION", 300)
    parts = s.class_texts(texts, keys, 100)
    at = 0
    for t, k in zip(texts, keys):
        n = len(t) - 99
        assert len(set(zip(whole[at:at + n], parts[at:at + n]))) == len(set(whole[at:at + n]))
        at += n
