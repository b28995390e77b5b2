"""Jaccard join, embeddings and components against plain versions."""

import random

import numpy as np
from pyspark.sql import functions as F

from llm import embeddings, jaccard
from llm.common import LOWER, as_bytes, words_of
from llm.components import connected_components


def components(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_connected_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 3)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = dict(tuple(r) for r in connected_components(df).collect())
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = components({x for l in real for x in l}, real)
    assert got == want
    assert connected_components(df.limit(0)).count() == 0


def shingles(text):
    w = words_of(as_bytes(text).translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def plain_join(docs):
    sets = {d: shingles(t) for d, t in docs}
    ids = sorted(sets)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[:k]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    part = components(ids, links)
    return {d: (len(sets[d]), part[d]) for d in ids}


def near_copies(rng, groups=14, size=12):
    docs, vocabulary = [], [f"w{i}" for i in range(400)]
    common = [rng.choice(vocabulary) for _ in range(30)]
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 6, 8, 12, 20, 40, 80, 200, 500]))]
        if rng.random() < 0.4:
            base[1:1] = common
        for _ in range(rng.randint(1, size)):
            words = list(base)
            for _ in range(rng.randint(0, 1 + len(words) // 25)):
                at = rng.randrange(len(words))
                words[at : at + rng.randint(0, 1)] = [rng.choice(vocabulary)] * rng.randint(0, 1)
            docs.append(" ".join(w.upper() if rng.random() < 0.1 else w for w in words))
    rng.shuffle(docs)
    return list(enumerate(docs))


def test_jaccard_against_brute_force(spark):
    rng = random.Random(2)
    docs = near_copies(rng) + [(900, None), (901, ""), (902, " \n"), (903, "a b c"), (904, "A B C"), (905, "a b"), (906, "x " * 300), (907, "x " * 7)]
    got = {r[0]: (r[1], r[2]) for r in jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)).collect()}
    assert got == plain_join(docs)


def test_every_linked_pair_shares_a_signature():
    rng, scheme = np.random.default_rng(3), jaccard.Scheme()
    for size in [4, 5, 6, 7, 9, 13, 20, 37, 64, 150, 400, 1200]:
        for _ in range(12):
            common = rng.integers(0, 2**64, size, np.uint64)
            spare = scheme.most_apart(size, size)
            extra = [rng.integers(0, 2**64, k, np.uint64) for k in (rng.integers(0, spare + 1), rng.integers(0, spare + 1))]
            x, y = (np.unique(np.concatenate([common, e])) for e in extra)
            if not scheme.linked(len(np.intersect1d(x, y)), len(x), len(y)) or np.array_equal(x, y):
                continue
            a, b = (jaccard.signatures(s, scheme) for s in sorted((x, y), key=len))
            index = set(a[0][(a[1] & jaccard.INDEX) > 0].tolist())
            asked = (b[1] & jaccard.PROBE) > 0
            hit = np.isin(b[0][asked], np.array(list(index), np.uint64))
            # The larger set may leave out as many as it can spare, whichever they are.
            assert hit.sum() > b[2][asked][hit].max(initial=0), size


def test_one_of_each_keeps_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, 1), (2, text + " more", 2), (2, text + " more", 2), (None, text, 3), (None, None, 4), (7, None, 5), (8, "own words that differ from all", 6), (8, "own words that differ from all", 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, component_id int")
    out = jaccard.one_of_each(docs)
    assert out.columns == docs.columns
    assert sorted(r["component_id"] for r in out.collect()) == [1, 3, 4, 5, 6, 6]
    assert jaccard.one_of_each(docs.limit(0)).count() == 0


def unit(v):
    return v / np.linalg.norm(v)


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(4)
    base = [unit(rng.standard_normal(48)) for _ in range(40)]
    vectors = []
    for k, b in enumerate(base):
        vectors += [unit(b + rng.standard_normal(48) * rng.choice([0.01, 0.03, 0.06, 0.1])) * rng.uniform(0.5, 3) for _ in range(k % 9)]
    vectors += [base[3]] * 5 + [base[4] * 2]
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 48, 0), (n + 2, [float("nan")] * 48, 0), (n + 3, [None] + [1.0] * 47, 0), (n + 4, [], 0), (n + 5, [1.0, 0.0], 0), (n + 6, [float("inf")] * 48, 0), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, kept int").repartition(5)
    got = {r[0]: tuple(r[1:]) for r in embeddings.embedding_links(df).collect()}
    m = np.array([np.array(r[1], np.float32).astype(float) for r in rows[:n]])
    u = m / np.linalg.norm(m, axis=1)[:, None]
    near = (u @ u.T >= 0.9) & ~np.eye(n, dtype=bool)
    part = components(range(n), np.argwhere(near).tolist())
    right = [got[i] == (int(near[i].sum()), part[i], part[i] == i) for i in range(n)]
    assert np.mean(right) > 0.98
    assert all(got[i][0] <= near[i].sum() for i in range(n))
    assert all(got[i] == (0, i, True) for i in range(n, n + 7)) and got[None] == (0, None, None)
    assert embeddings.embedding_links(df.limit(0)).count() == 0


def test_estimates_stay_within_their_bounds():
    rng = np.random.default_rng(5)
    turns = embeddings.Rotations.of(64, 4, 8, 1)
    a, b = (np.array([unit(v) for v in rng.standard_normal((300, 64))]) for _ in range(2))
    b[:150] = np.array([unit(x + 0.05 * y) for x, y in zip(a[:150], b[:150])])
    i, j, tried = embeddings._linked(a, b, turns, 0.9, 4.5)
    want = {tuple(x) for x in np.argwhere(a @ b.T >= 0.9).tolist()}
    assert set(zip(i.tolist(), j.tolist())) == want and tried < 300 * 300 / 4


def test_recall_on_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    m = np.array([r["embedding"] for r in rows], float)
    u = m / np.linalg.norm(m, axis=1)[:, None]
    want = int((u @ u.T >= 0.9).sum()) - len(rows)
    got = embeddings.embedding_links(df).agg(F.sum("n_links")).first()[0]
    assert 0.99 * want <= got <= want
