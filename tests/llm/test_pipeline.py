import itertools
from collections import Counter
from pathlib import Path

import corpus_pipeline
from capgrid.llm import decontam, line_crf, simhash


def test_stages_over_a_small_table(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = results[name] = spark.read.parquet(str(tmp_path / name))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = line_crf.train(before, labels)
    rejected = {r["id"] for r in line_crf.score(before, model).filter("score < 0.3").collect()}
    assert rejected and ids(results["quality_classifier"]) == ids(before) - rejected
    assert ids(results["line_dedup"]) == ids(results["quality_classifier"])
    groups = simhash.components(results["line_dedup"]).collect()
    assert ids(results["simhash_near_dedup"]) == {r["component_id"] for r in groups}
    hits = decontam.scan(results["simhash_near_dedup"], spark.read.parquet(f"{sf}/benchmark.parquet"))
    assert ids(results["benchmark_decontamination"]) == {r["id"] for r in hits.filter("n_hit = 0").collect()}
    assert ids(results["packing"]) == ids(results["benchmark_decontamination"])
    for name in list(results)[:-1]:
        assert results[name].columns == before.columns
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == sorted(map(tuple, results["packing"].collect()))


def test_stages_over_odd_rows(spark, sf, odd_docs, tmp_path):
    """Every stage's rows over odd texts, and none over an empty table."""
    stages = {}
    for docs in (odd_docs, odd_docs.limit(0)):
        at = docs.select(*corpus_pipeline.COLUMNS)
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{docs is odd_docs}-{i}")
            stage(spark, at, sf).write.parquet(path)
            at = spark.read.parquet(path)
            if docs is odd_docs:
                stages[name] = at
            else:
                assert at.count() == 0

    def texts(frame):
        return Counter((r["doc_id"], r["text"]) for r in frame.collect())

    whole = texts(odd_docs)
    assert texts(stages["quality_classifier"]) == whole
    # the line that three of the five pages of source a hold goes; nothing else changes
    cut = Counter()
    for (doc, text), n in whole.items():
        cut[doc, "" if text == "same words here again and again" else text] += n
    assert texts(stages["line_dedup"]) == cut
    # without words: one class, whose smallest id stays; the two others are alone
    kept = {k: 1 for k in whole if k[0] in (1, 4, 6)}
    assert texts(stages["simhash_near_dedup"]) == texts(stages["benchmark_decontamination"]) == kept
    pieces = stages["packing"].collect()
    for doc, _ in kept:
        own = sorted((r["start"], r["length"], r["doc_tokens"]) for r in pieces if r["doc_id"] == doc)
        assert [r[0] for r in own] == list(itertools.accumulate([r[1] for r in own], initial=0))[:-1]
        assert sum(r[1] for r in own) == own[0][2]
    assert {r["doc_id"] for r in pieces} == {1, 4, 6} and next(r["doc_tokens"] for r in pieces if r["doc_id"] == 1) == 1


def test_nothing_else_imports_the_subpackage():
    top = Path(corpus_pipeline.__file__).parent
    users = [p for p in (top / "capgrid").rglob("*.py") if "llm" not in p.relative_to(top).parts and "capgrid.llm" in p.read_text()]
    assert users == []
