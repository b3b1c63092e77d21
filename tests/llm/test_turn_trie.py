import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tallyloom.llm import turn_trie as trie

TABLE = "conv_id long, turn long, role string, text string"


def brute_force(rows):
    """Nodes as tuples in the order of trie.NODE, conversation by conversation."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[conv].append(((turn is not None, turn or 0, name), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - int(np.fmod(c, 100))
        built[c] = tuple(own.get(first, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    saved, leaves = defaultdict(int), defaultdict(int)
    children = defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    for k, convs in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(convs) - 1) * (len(k[-1][1]) if k else 0)
            leaves[k[:d]] += not children[k]
    out = []
    for k, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if built[c] == k)
        out.append((min(convs), len(k), min(members[k[:-1]]) if k else None, len(convs),
                    children[k], leaves[k], saved[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(spark, rows):
    found = trie.prefix_trie(spark.createDataFrame(rows, TABLE))
    assert found.columns == trie.NODE
    return sorted(map(tuple, found.collect()), key=str)


def random_rows(seed, groups=6, most=12):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(groups * 100):
        if rng.random() < 0.3:
            for t in range(int(rng.integers(1, most))):
                rows.append((c, t, "user" if t % 2 else "bot", "w" * int(rng.integers(1, 3))))
    return rows


def test_equals_brute_force_over_many_shards(spark, conf):
    conf("spark.sql.shuffle.partitions", "23")
    rows = random_rows(1)
    assert nodes(spark, rows) == brute_force(rows)


def test_long_rows_and_one_conversation_in_every_shard(spark, conf, monkeypatch):
    conf("spark.sql.shuffle.partitions", "9")
    monkeypatch.setattr(trie, "CHUNK_BYTES", 60)
    rows = []
    for c in range(300):  # copies but for the turns their group's first one lends
        rows += [(c, t, "user", "same") for t in range(9)]
    rows += [(1000 + c, t, "user", f"{t}" if t < 20 + c else f"{c}") for c in range(4)
             for t in range(60)]
    assert nodes(spark, rows) == brute_force(rows)


def test_nulls_ties_and_odd_ids(spark):
    rows = [(None, 0, "user", "lost"), (5, None, None, None), (5, 1, "user", "é🙂"),
            (5, 1, "user", "é🙂"), (5, 1, "a", "b"), (7, 0, "use", "rx"), (8, 0, "user", "x"),
            (-5, 0, "user", "x"), (-105, 3, "", ""), (0, 2, None, "head"), (0, 1, "z", None),
            (2 ** 63 - 1, 0, "user", "x"), (300, 0, "u", "alone"), (301, 0, "u", "alone")]
    assert nodes(spark, rows) == brute_force(rows)


def test_no_rows_and_other_columns(spark):
    assert nodes(spark, []) == []
    assert nodes(spark, [(None, 1, "user", "x")]) == []
    rows = random_rows(2, groups=1)
    table = spark.createDataFrame(rows, TABLE).selectExpr(
        "*", "1 as depth", "'x' as names", "2 as kind", "text as node")
    assert sorted(map(tuple, trie.prefix_trie(table).collect()), key=str) == brute_force(rows)


@pytest.mark.parametrize("seed", range(4))
def test_sorted_rows_and_shared_lengths(seed):
    rng = np.random.default_rng(seed)
    rows = [list(rng.integers(1, 3, rng.integers(0, 30))) for _ in range(200)]
    rows += [rows[0] * 3, rows[0] * 3, []]
    conv = rng.permutation(len(rows))
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    ids = np.array([x for r in rows for x in r], np.int64)
    order = trie.sorted_rows(ids, offsets, conv)
    assert order.tolist() == sorted(range(len(rows)), key=lambda i: (rows[i], conv[i]))
    got = trie.shared_lengths(ids, offsets, order)
    for i in range(1, len(rows)):
        a, b = rows[order[i - 1]], rows[order[i]]
        want = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert got[i] == want
