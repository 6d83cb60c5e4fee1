"""Fingerprints against exact generalised Jaccard similarities, and the texts and neighbours they are of."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from corpus import empty, table
from pyspark.sql import functions as F

from stayloom.llm import fingerprints as fp
from stayloom.llm.frames import documents


def words(text):
    return Counter(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def jaccard(a, b):
    a, b = words(a), words(b)
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def edited(text, following):
    text, following = text or "", following or ""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def in_order(rows):
    """(id, text) as the operator orders them, for distinct ids."""
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))


def test_whole_table(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    rows = in_order([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    out = {r["doc_id"]: r for r in fp.digest(docs).collect()}
    assert len(out) == len(rows) == len({r[0] for r in rows})
    shown = {}
    for i, (id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)]
        changed, r = edited(text, following[1]), out[id]
        assert r["n_chars"] == len(text or "") and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        parts = [[f[k : k + 8] for k in range(0, len(f), 8)] for f in (r["fingerprint"], r["edited_fingerprint"], out[following[0]]["fingerprint"])]
        assert all(len(p) == fp.SAMPLES for p in parts)
        share = [sum(a == b for a, b in zip(parts[0], p, strict=True)) / fp.SAMPLES for p in parts[1:]]
        assert (r["near_edited"], r["near_next"]) == pytest.approx(tuple(share))
        assert abs(r["near_edited"] - jaccard(text, changed)) < 0.3 and abs(r["near_next"] - jaccard(text, following[1])) < 0.3
        assert shown.setdefault(text, r["fingerprint"]) == r["fingerprint"]


def test_collisions_are_as_frequent_as_the_weights_say(spark):
    """Pairs of texts of their own words each, so that samples of different pairs are independent."""
    rng, rows, exact = random.Random(3), [], []
    for pair in range(300):
        names = [f"w{pair}_{i}" for i in range(rng.choice([3, 12, 60]))]
        texts = [" ".join(n for n in names for _ in range(rng.choice([0, 1, 1, 2, 7]))) for _ in range(2)]
        if not all(texts):
            continue
        rows += [(2 * pair, texts[0]), (2 * pair + 1, texts[1])]
        exact.append(jaccard(*texts))
    out = {r["doc_id"]: r["fingerprint"] for r in fp.fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    found = []
    for i in range(0, len(rows), 2):
        a, b = out[rows[i][0]], out[rows[i + 1][0]]
        found.append(sum(a[k : k + 8] == b[k : k + 8] for k in range(0, len(a), 8)) / fp.SAMPLES)
    errors = [f - e for f, e in zip(found, exact, strict=True)]
    assert abs(sum(errors) / len(errors)) < 0.012
    assert sum(e * e for e in errors) / len(errors) < 1.3 * sum(e * (1 - e) for e in exact) / len(exact) / fp.SAMPLES


def test_gamma_quantiles():
    rng = random.Random(1)
    drawn = sorted(rng.gammavariate(2, 1) for _ in range(50_000))
    for share in (0.1, 0.5, 0.9, 0.99):
        assert fp.gamma_quantile(share) == pytest.approx(drawn[int(share * 50_000)], rel=0.04)


def test_repeated_rows_nulls_and_clashing_columns(spark):
    docs = table(spark)
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    out = fp.digest(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out) == sorted((i is None, i or 0) for i, _ in rows)
    prints = defaultdict(set)
    for r in out:
        prints[r["doc_id"]].add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert prints[0] == prints[1] == prints[2] == {""} and prints[5] == prints[6]
    # Row 5 is there three times: two of them have a copy as next, the last one row 4.
    five = [r for r in out if r["doc_id"] == 5]
    assert sorted(r["near_next"] == 1 for r in five) == [False, True, True]
    alone, four = (next(t for i, t in rows if i == k) for k in (5, 4))
    assert sorted(r["edited_sha256"] for r in five) == sorted(
        hashlib.sha256(edited(alone, t).encode()).hexdigest() for t in (alone, alone, four)
    )
    kept = fp.fingerprints(docs)
    assert kept.columns == [c for c in docs.columns if c != "text"] + ["fingerprint"] and kept.count() == len(rows)


def test_one_document_and_none(spark):
    one = fp.digest(spark.createDataFrame([(3, "a b c d")], "doc_id bigint, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1
    assert one[0]["edited_sha256"] == hashlib.sha256(edited("a b c d", "a b c d").encode()).hexdigest()
    assert fp.digest(empty(spark)).count() == 0 and fp.fingerprints(empty(spark)).count() == 0


def test_no_python_and_two_text_shuffles(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    plan = fp.digest(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    keyed = fp._keyed(docs, "text", "doc_id")
    sampled = fp.marks(fp._texts(keyed), fp._KEY, ["in_text"])
    assert sampled._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_rows_that_agree_in_all_but_other_columns(spark):
    rows = [(1, "x y z " * 5)] * 400 + [(None, "p q r")] * 400
    out = fp.digest(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8))
    counted = {(r["doc_id"], r["near_next"] == 1): r["n"] for r in out.groupBy("doc_id", "near_next").agg(F.count("*").alias("n")).collect()}
    assert counted == {(1, True): 399, (1, False): 1, (None, True): 399, (None, False): 1}
