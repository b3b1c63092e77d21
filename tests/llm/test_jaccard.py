import random
import re

import numpy as np
import pytest

from tallyloom.llm import jaccard as j


def shingles(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    links = [[b for b in range(n) if b != a and sets[a] and sets[b]
              and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])] for a in range(n)]
    label = list(range(n))
    for _ in range(n):
        label = [min([label[a], *(label[b] for b in links[a])]) for a in range(n)]
    ids = {}
    for a in range(n):
        ids.setdefault(label[a], []).append(rows[a][0])
    small = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return [(rows[a][0], len(links[a]), small[label[a]]) for a in range(n)], len(ids)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    vocabulary = [f"w{i}é" for i in range(400)]
    out = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 40, 120]))]
        for _ in range(rng.choice([1, 1, 2, 5, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(" ".join(copy).upper() if rng.random() < 0.3 else ", ".join(copy))
    out += [None, "", "?!", "x " * 5000, "x x x x x x"]
    rng.shuffle(out)
    found = [(i * 3 + 1, t) for i, t in enumerate(out)]
    return found + [(4, found[1][1]), (None, found[5][1]), (None, "lonely one"), (4, "lonely one")]


def result(spark, rows):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n string")
    return j.join_similar(docs.repartition(3)).collect()


def test_same_links_as_all_pairs(spark, rows):
    got = result(spark, rows)
    want, parts = brute(rows)
    assert sorted(map(str, ((r.doc_id, r.n_links, r.component_id) for r in got))) == sorted(
        map(str, want))
    with_words = sum(bool(shingles(t)) for _, t in rows)
    assert sum(r.kept for r in got) == parts and len(got) == len(rows) and with_words


def test_blocks_find_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(j, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(j, "GROUP_BYTES", 500)
    assert sorted(map(str, ((r.doc_id, r.n_links, r.component_id)
                            for r in result(spark, rows)))) == sorted(map(str, brute(rows)[0]))


def test_one_of_each_group_stays(spark, rows):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, row string")
    kept = j.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == brute(rows)[1]
    assert j.keep_one(docs.where("false")).collect() == []


def test_pruning_keeps_what_may_be_similar():
    rng = np.random.default_rng(0)
    least = j.least_matches()
    a = rng.integers(0, 2 ** 32, (50, j.HASHES), dtype=np.uint32)
    b = a.copy()
    b[rng.random(b.shape) > 0.82] = 7
    keep = j.possible_pairs(a, b, least)
    assert keep.diagonal().mean() > 0.97 and keep.sum() == keep.diagonal().sum()
    assert all(m <= 0.8 * n for n, m in least.items())


def test_intersections():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in (5, 0, 30, 50)]
    got = j.shared_counts(sets[:3], sets[1:])
    assert got.tolist() == [[len(np.intersect1d(x, y)) for y in sets[1:]] for x in sets[:3]]
