"""The corpus pipeline, stage by stage."""

from collections import defaultdict

import corpus_pipeline
from corpus import texts
from stayloom.llm.frames import documents, settle

DATA = "/root/testdata/sf0.001"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_stages(spark):
    docs = documents(spark, DATA)
    labels = {r["doc_id"]: r["toxic"] for r in documents(spark, DATA, "labels").collect()}
    held = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        last = list(held.values())[-1]
        held[name] = settle(stage(spark, last, DATA))
        if name != "packing":
            assert held[name].schema == last.schema or held[name].columns == last.columns
    ids = {k: [r["doc_id"] for r in v.select("doc_id").collect()] for k, v in held.items()}
    gone = set(ids["documents"]) - set(ids["toxicity"])
    assert not any(labels.get(i) == 0 for i in gone)
    before = {r["doc_id"]: r["text"] for r in held["toxicity"].collect()}
    groups = defaultdict(list)
    for i, t in before.items():
        groups[lower(t)].append(i)
    assert sorted(ids["exact_dedup"]) == sorted(map(max, groups.values()))
    assert set(ids["near_dedup"]) <= set(ids["exact_dedup"]) and sorted(ids["substring_dedup"]) == sorted(ids["near_dedup"])
    assert {r["doc_id"] for r in held["packing"].collect()} == set(ids["substring_dedup"])
    for r in held["substring_dedup"].collect():
        assert r["n_chars"] == len(r["text"])


def test_toxic_rows_are_dropped(spark):
    """With 68 usable labels, 10 of them toxic: the held-out toxic row too, and no held-out clean one."""
    docs, toxic = documents(spark, DATA), documents(spark, DATA, "labels").collect()
    kept = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, DATA).collect()}
    assert 81 not in kept and sum(r["doc_id"] not in kept for r in toxic if r["toxic"]) >= 9
    assert all(r["doc_id"] in kept for r in toxic if not r["toxic"])


def test_planted_insults_are_dropped(spark, tmp_path):
    """Insults between other words, with few labels: rows that no label covers go by the words they share."""
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]
    rows, labels = [], []
    for i in range(80):
        text = [words[(i * 37 + k * k * 7 + k) % 300] for k in range(40)]
        if i % 8 == 0:
            text[5::6] = ["idiot", "moron", "scum", "vermin", "idiot", "moron"]
        rows.append((i, " ".join(text), "en", "s", 0))
        if i < 60:
            labels.append((i, 1, int(i % 8 == 0)))
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, documents(spark, folder), folder).collect()}
    assert set(range(80)) - kept == set(range(0, 80, 8))


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "substring_dedup", "packing"]


def test_odd_documents(spark, tmp_path):
    """Nulls, repeated rows and no rows at all go through every stage."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts())]
    for k, some in enumerate(([], rows + rows[5:7] + [(None, None, None, None, None)] * 2)):
        folder = str(tmp_path / str(k))
        spark.createDataFrame(some, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        out = corpus_pipeline.run(spark, folder).collect()
        assert len({r["doc_id"] for r in out}) <= len({r[0] for r in some}) and bool(out) == bool(some)


def test_a_stage_deletes_what_its_predecessor_settled(spark):
    """Each result is whole after its predecessor's tables are gone, and runs don't disturb each other."""
    from pathlib import Path

    from stayloom.session import settled_tables

    docs = documents(spark, DATA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        known = set(settled_tables())
        out = stage(spark, docs, DATA)
        own = [p for p in settled_tables() if p not in known]
        docs = settle(out)
        last = [p.removeprefix("file:") for p in own]
        assert docs.count() > 0 and (not last or all(Path(p).exists() for p in last))
    first, second = corpus_pipeline.run(spark, DATA), corpus_pipeline.run(spark, DATA)
    assert first.count() == second.count() == corpus_pipeline.run(spark, DATA).count()
