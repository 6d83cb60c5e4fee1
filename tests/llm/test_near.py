"""Near duplicates against all pairs."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpus import empty, prose, table
from stayloom.llm import minhash


def shingle_counts(text):
    words = (text or "").encode().split()
    return Counter([tuple(words[k : k + 5]) for k in range(len(words) - 4)] or ([tuple(words)] if words else []))


def brute(rows, similarity=0.8):
    """Class of each row number, by weighted Jaccard over all pairs."""
    counts = [shingle_counts(t) for _, t in rows]
    held = Counter(s for c in counts for s in c)
    share = {s: n / len(rows) for s, n in held.items()}
    idf = {s: 1 - 0.5 * np.log(max(p, minhash.COMMON) / minhash.COMMON) / np.log(1 / minhash.COMMON) for s, p in share.items()}
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            low = sum(min(n, counts[b][s]) * idf[s] for s, n in counts[a].items())
            high = sum(max(counts[a][s], counts[b][s]) * idf[s] for s in counts[a] | counts[b])
            if high and low >= similarity * high * (1 - 1e-6) and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    return label


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for family in range(8):
        base = prose(rng, rng.randrange(40, 120)).split()
        for _ in range(rng.randrange(1, 7)):
            w = list(base)
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(1000)}"
            rows.append((len(rows), " ".join(w)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_classes(spark, seed, monkeypatch):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs).collect()}
    want = brute(rows)
    groups = defaultdict(list)
    for (i, _), label in zip(rows, want):
        groups[label].append(i)
    assert {frozenset(g) for g in groups.values()} == {
        frozenset(i for i, r in got.items() if r["class_id"] == c) for c in {r["class_id"] for r in got.values()}
    }
    for g in groups.values():
        assert [i for i in g if got[i]["kept"]] == [min(g)] and got[g[0]]["class_size"] == len(g)


def test_edges(spark):
    docs = table(spark)
    got = minhash.near_duplicates(docs)
    rows = got.collect()
    assert len(rows) == docs.count()
    assert all(r["class_size"] == 1 and r["kept"] for r in rows if r["doc_id"] in (0, 1, 2))  # no words: alone
    kept = minhash.kept_documents(docs)
    assert kept.columns == docs.columns
    # Rows that agree in id and text are one document of the result.
    assert sum(r["doc_id"] == 5 for r in kept.collect()) <= 1
    assert minhash.near_duplicates(empty(spark)).count() == 0 and minhash.kept_documents(empty(spark)).count() == 0


def test_samples_agree_as_often_as_texts(spark):
    rng = np.random.default_rng(3)
    values = rng.integers(1, 1 << 62, size=400, dtype=np.uint64)
    weight = rng.uniform(0.5, 4, size=400).astype(np.float32)
    other = weight.copy()
    other[:120] *= 0.5
    same = []
    for scale in range(40):
        moved = values + np.uint64(scale)
        a = list(minhash.samples(moved, weight, np.array([0])))
        b = list(minhash.samples(moved, other, np.array([0])))
        same += [x[0] == y[0] for x, y in zip(a, b)]
    want = np.minimum(weight, other).sum() / np.maximum(weight, other).sum()
    assert abs(np.mean(same) - want) < 0.05


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 11), (5, 4), (4, 3), *[(k, k + 1) for k in range(20, 40)]]
    got = minhash.components(spark.createDataFrame(links, "u bigint, v bigint"))
    assert {r["node"]: r["label"] for r in got.collect()} == {
        **dict.fromkeys((1, 2, 3, 4, 5), 1), 10: 10, 11: 10, **dict.fromkeys(range(20, 41), 20)
    }
