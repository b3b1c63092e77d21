import numpy as np
import pytest

from tallyloom.llm import projections as p


def brute(rows, similar=0.9):
    good = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all()
            and np.linalg.norm(v) > 0 for _, v in rows]
    n = len(rows)
    links = [[] for _ in range(n)]
    for a in range(n):
        for b in range(n):
            if a != b and good[a] and good[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if (x == y).all() or x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= similar:
                    links[a].append(b)
    label = list(range(n))
    while True:
        new = [min([label[a], *(label[b] for b in links[a])]) for a in range(n)]
        if new == label:
            break
        label = new
    small = {k: min((rows[i][0] for i in range(n) if label[i] == k and rows[i][0] is not None),
                    default=None) for k in set(label)}
    return [(rows[a][0], len(links[a]), small[label[a]]) for a in range(n)]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    out = []
    for size in (1, 1, 2, 3, 9, 30):
        for _ in range(6):
            base = rng.standard_normal(24)
            for _ in range(size):
                near = base + rng.standard_normal(24) * rng.choice([0, 0.05, 0.2])
                out.append([float(np.float32(x)) for x in near])
    out += [None, [], [0.0] * 24, [None, 1.0], [float("nan")] * 24, [float("inf"), 1.0],
            [1.0, 0.0], [1.0, 0.1], [2.0, 0.0]]
    found = [(i + 1, v) for i, v in enumerate(out)]
    return found + [(3, found[2][1]), (None, found[40][1]), (5, [0.0, -1.0])]


def result(spark, rows):
    frame = spark.createDataFrame([(*r, 1) for r in rows],
                                  "vec_id long, embedding array<float>, id int")
    return sorted(map(str, map(tuple, p.near_duplicates(frame.repartition(3)).collect())))


def test_same_links_as_all_pairs(spark, rows):
    assert result(spark, rows) == sorted(map(str, brute(rows)))


def test_blocks_and_tables_count_a_pair_once(spark, rows, monkeypatch):
    monkeypatch.setattr(p, "CELL", 40)
    monkeypatch.setattr(p, "MEET", 1 - 1e-7)  # so that no pair is missed by chance
    monkeypatch.setattr(p, "CELL_ROWS", 16)
    assert p.tables_for(len(rows))[1] > 10
    assert result(spark, rows) == sorted(map(str, brute(rows)))


def test_empty_table(spark, rows):
    assert result(spark, rows[:0]) == [] and len(result(spark, [(1, None)])) == 1


def test_recall_on_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {r[0]: r[1] for r in p.near_duplicates(table).collect()}
    data = table.select("vec_id", "embedding").collect()
    x = np.array([r.embedding for r in data], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    true = dict(zip([r.vec_id for r in data], ((x @ x.T) >= 0.9).sum(1) - 1))
    assert all(got[k] <= n for k, n in true.items())
    assert sum(got.values()) >= 0.97 * sum(true.values())
