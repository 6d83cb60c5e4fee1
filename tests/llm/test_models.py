"""Repetition rules against brute force; classifiers on held-out rows; the index against all cosines."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corpus import empty, table
from stayloom.llm import arrays, quality_classifier, quality_rules, queries, toxicity
from stayloom.llm.samples import share

DATA = "/root/testdata/sf0.01"


def grams(words, n):
    count = Counter(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    return {j for k in range(len(words) - n + 1) if count[tuple(words[k : k + n])] > 1 for j in range(k, k + n)}


def later(words, n):
    seen, out = set(), set()
    for k in range(len(words) - n + 1):
        gram = tuple(words[k : k + n])
        if gram in seen:
            out.update(range(k, k + n))
        seen.add(gram)
    return out


def rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, lines, chars = set(), 0, 0
    for line in text.split("\n"):
        own = re.findall(r"[^\x20\x09-\x0D]+", line)
        if own and line in seen:
            lines, chars = lines + 1, chars + sum(map(len, own))
        seen.add(line)
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text)}
    out |= {"n_repeat_words": len(grams(words, 3)), "n_dup_lines": lines, "dup_line_chars": chars}
    out |= {f"dup_chars_{n}": sum(len(words[k]) for k in later(words, n)) for n in quality_rules.LIMITS}
    out["base_failed"] = out["n_words"] < 50 or 100 * out["n_repeat_words"] > 50 * out["n_words"]
    return out


def test_rules(spark):
    docs = table(spark)
    got = quality_rules.quality_rules(docs)
    assert got.columns[: len(docs.columns) - 1] == [c for c in docs.columns if c != "text"]
    names = [c for c in rules("") if c != "kept"]
    rows = Counter(tuple(r[c] for c in ["doc_id", *names]) for r in got.collect())
    assert rows == Counter((r["doc_id"], *[rules(r["text"])[c] for c in names]) for r in docs.collect())
    assert not any(r["kept"] and r["base_failed"] for r in got.collect())
    assert quality_rules.quality_rules(empty(spark)).count() == 0


def test_shares(spark):
    import zlib

    from pyspark.sql import functions as F

    rows = spark.range(50).select("id", share(F.col("id"), 5).alias("s")).collect()
    assert all(r["s"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in rows)


@pytest.mark.parametrize("name, label, least", [("op1_toxicity", "toxic", 0.93), ("op6_quality_classifier", "quality", 0.97)])
def test_held_out(spark, name, label, least):
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES[name](spark, folder).collect() if r["held_out"] and r["doc_id"] in labels]
    assert len(rows) > 500
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in rows]) > least
    assert all(0 <= r["score"] <= 1 for r in rows)


LABELS = "doc_id bigint, quality int, toxic int"


@pytest.mark.parametrize("rows", [[], [(5, 1, 0), (8, 1, 0)], [(5, None, None), (None, 1, 1)], [(i, i % 2, i % 2) for i in range(20)] * 2])
def test_odd_labels(spark, rows):
    from pyspark.sql import functions as F

    labels, docs = spark.createDataFrame(rows, LABELS), table(spark)
    for got in (
        quality_classifier.quality_classifier(docs, labels, F.lit(True)),
        toxicity.toxicity(docs, labels, F.lit(True)),
    ):
        out = got.collect()
        assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
        assert [c for c in got.columns if c in docs.columns] == [c for c in docs.columns if c != "text"]
    assert quality_classifier.quality_classifier(empty(spark), labels, F.lit(True)).count() == 0
    kept = toxicity.toxicity(docs, labels, F.lit(True), keep_text=True)
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter((r["doc_id"], r["text"] or "") for r in docs.collect())


def test_nearest_is_exact():
    rng = np.random.default_rng(5)
    vocabulary = np.sort(rng.integers(1, 1 << 60, size=30, dtype=np.uint64))
    rows = []
    for _ in range(500):
        term = np.sort(rng.choice(30, size=rng.integers(0, 6), replace=False))
        rows.append((term, rng.integers(1, 5, size=len(term))))
    made = toxicity.Examples(vocabulary, rows, np.arange(500), rng.integers(0, 2, size=500))
    index = toxicity.Index(made, rng.integers(1, 400, size=30).astype(float), 1000)
    dense = np.zeros((500, 30))
    for k, (term, weight) in enumerate(index.vectors):
        dense[k, term] = weight
    for k in range(0, 500, 7):
        if len(index.vectors[k][0]):
            cosine = dense @ dense[k]
            want = sorted(np.flatnonzero(cosine > 0), key=lambda j: (-round(cosine[j], 12), j))[: toxicity.NEAREST]
            best, got = index.nearest(*index.vectors[k])
            assert np.allclose(got, cosine[want]) and np.allclose(cosine[best], cosine[want])


def test_nearest_is_exact_in_lists(monkeypatch):
    """The same with few terms in the matrix and small blocks."""
    for name, value in (("HEAD", 3), ("BLOCK", 16), ("FIRST", 1), ("BATCH", 7)):
        monkeypatch.setattr(toxicity, name, value)
    test_nearest_is_exact()


def test_every_term_of_the_examples_is_indexed():
    """Also with few labels, where no term stands out."""
    made = toxicity.choose(np.arange(3), pa.chunked_array([["good day", "bad day", "bad luck"]]), np.array([0, 1, 1]))
    assert len(made.vocabulary) == 4 and [len(t) for t, _ in made.rows] == [2, 2, 2] and (made.strength >= 1).all()
    index = toxicity.Index(made, np.array([2.0] * 4), 10)
    assert len(index.nearest(*index.vectors[0])[0]) == 2 and index.base < 1


def test_isotonic_rises():
    x, y = toxicity.isotonic(np.array([0.1, 0.2, 0.3, 0.4, 0.9]), np.array([0, 1, 0, 1, 1]))
    assert (np.diff(x) >= 0).all() and (np.diff(y) >= 0).all() and y[0] == 0 and y[-1] == 1


def test_words_and_windows():
    rows = ["", " a bb\tccc ", "x", "\n", "no-break space"]
    column = pa.array(rows)
    ((first, data, offsets),) = arrays.blocks(column)
    start, end, bounds = arrays.words(data, offsets)
    got = [data[a:b].tobytes().decode() for a, b in zip(start, end)]
    assert got == [w for r in rows for w in re.findall(r"[^\x20\x09-\x0D]+", r)]
    assert np.diff(bounds).tolist() == [0, 3, 1, 0, 1]
    blocks = list(arrays.blocks(column, 3))
    assert b"".join(d.tobytes() for _, d, _ in blocks) == "".join(rows).encode() and [b[0] for b in blocks] == sorted({b[0] for b in blocks})


def test_ftrl_equals_plain_loops():
    """Follow-the-regularised-leader one number at a time, and the score as a sum over a text's features."""
    import math

    rng, q = np.random.default_rng(2), quality_classifier
    words = ["alpha", "beta", "Gamma", "42", "x-y", "delta!"]
    texts = [" ".join(rng.choice(words, size=rng.integers(0, 9))) for _ in range(60)]
    labels = np.array([int(t.count("alpha") > 1) for t in texts])
    column = pa.chunked_array([texts])
    got, z, n, bias = q.learn(np.arange(60), column, labels), {}, {}, 1 << q.BITS

    def weight(place):
        own = z.get(place, 0.0)
        if abs(own) <= q.L1:
            return 0.0
        return -(own - math.copysign(q.L1, own)) / ((q.BETA + math.sqrt(n.get(place, 0.0))) / q.ALPHA + q.L2)

    rows = [{**dict(zip(p.tolist(), v.tolist())), bias: 1.0} for p, v in q.vectors(column)]
    for epoch in range(q.EPOCHS):
        for k in np.random.default_rng(epoch).permutation(60):
            now = {p: weight(p) for p in rows[k]}
            chance = 1 / (1 + math.exp(-sum(now[p] * v for p, v in rows[k].items())))
            for p, v in rows[k].items():
                step = (chance - labels[k]) * v
                move = (math.sqrt(n.get(p, 0.0) + step**2) - math.sqrt(n.get(p, 0.0))) / q.ALPHA
                z[p], n[p] = z.get(p, 0.0) + step - move * now[p], n.get(p, 0.0) + step**2
    assert np.flatnonzero(got).tolist() == sorted(p for p in z if weight(p))
    assert got[list(z)] == pytest.approx([weight(p) for p in z], rel=1e-5, abs=1e-7)

    class Value:
        value = got

    batch = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(texts)], ["rest", "in_text"])
    scores = np.concatenate([b.column("score").to_numpy() for b in q.scored(Value)([batch])])
    assert scores == pytest.approx([1 / (1 + math.exp(-sum(weight(p) * v for p, v in row.items()))) for row in rows], rel=1e-4)


def test_no_documents_and_no_words(spark):
    from pyspark.sql import functions as F

    labels = spark.createDataFrame([(0, 1, 1), (1, 0, 0)], LABELS)
    assert toxicity.toxicity(empty(spark), labels, F.lit(True)).count() == 0
    assert toxicity.digest(empty(spark), labels).columns == ["doc_id", "held_out", "score", "predicted", "evidence"]
    blank = spark.createDataFrame([(0, None), (1, ""), (2, " \n"), (None, "1 2 3")], "doc_id bigint, text string")
    out = toxicity.toxicity(blank, labels, F.lit(True)).collect()
    assert len(out) == 4 and len({r["score"] for r in out}) == 1 and 0 < out[0]["score"] < 1 and all(r["evidence"] == [] for r in out)
