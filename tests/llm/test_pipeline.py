"""The pipeline's stages: order, columns, what goes and what stays, and agreement with plain versions."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from tablesift.llm import decontaminate, jaccard_join, line_dedup, toxicity
from tests.llm.conftest import words
from tests.llm.test_operators import check_packing, library, plain_components, plain_hits, plain_lines


def test_stages_on_odd_rows(spark, odd, empty, sf_dir):
    for start in (odd, empty):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir).persist()
            if name != "packing":
                assert out.columns == start.columns and [t for _, t in out.dtypes] == [t for _, t in start.dtypes]
                assert out.count() <= docs.count()
                docs = out
            else:
                assert (out.count() > 0) == (start is odd)


def test_each_stage_equals_its_plain_version(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    weights = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id", "text", "toxic")
    low = {r.doc_id for r in toxicity.score(docs, "text", weights).filter(F.col("score") < toxicity.REJECT).collect()}
    stages = dict(corpus_pipeline.STAGES)

    mild = stages["toxicity"](spark, docs, sf_dir).persist()
    assert {r.doc_id for r in mild.collect()} == low

    cut = stages["line_dedup"](spark, mild, sf_dir).persist()
    expected = plain_lines([(r.doc_id, r.text) for r in mild.collect()], line_dedup.LEAST)
    assert {r.doc_id: r.text for r in cut.collect()} == {k: v for (k, t), v in expected.items() if v == t or v.strip(" ")}
    assert cut.filter(F.col("n_chars") != F.length("text")).count() == 0

    single = stages["jaccard_join"](spark, cut, sf_dir).persist()
    rows = [(r.doc_id, r.text) for r in cut.collect()]
    assert sorted(str(r.doc_id) for r in single.collect()) == sorted(k for k, _, c in plain_components(rows) if k == c)

    clean = stages["decontamination"](spark, single, sf_dir).persist()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before, after = {r.doc_id: r.text for r in single.collect()}, {r.doc_id: r.text for r in clean.collect()}
    for key, text in before.items():
        n, hit, _ = plain_hits(text, items)
        if not hit:
            assert after[key] == text
        elif hit < n:
            assert len(decontaminate.words(after[key])) == n - hit

    lib = library(tokenizer)
    check_packing(stages["packing"](spark, clean, sf_dir).collect(), {k: [lib.encode(t, add_special_tokens=False).ids + [1]] for k, t in after.items()})


def test_planted_cases(spark, sf_dir):
    """Copies, a benchmark passage, a repeated passage and toxic words are caught; clean rows pass unchanged."""
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first().text
    passage = words(900, 70)
    toxic = words(901, 40) + " idiot moron worthless stupid scum trash " + words(902, 40)
    base = words(903, 200)
    near = base.replace(base.split()[100], "other", 1)
    rows = [(10**6, base), (10**6 + 1, base), (10**6 + 2, near), (10**6 + 3, toxic), (10**6 + 4, words(904, 50) + "\n" + passage + "\n" + words(905, 50)), (10**6 + 5, words(906, 50) + "\n" + passage), (10**6 + 6, words(907, 30) + " " + item + " " + words(908, 30)), (10**6 + 7, words(909, 100))]
    planted = spark.createDataFrame([(k, t, "en", "src0", len(t)) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").unionByName(planted)
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, "/root/testdata/sf0.01")
    kept = {r.doc_id - 10**6: r.text for r in docs.filter("doc_id >= 1000000").collect()}
    assert set(kept) == {0, 4, 5, 6, 7}
    assert kept[0] == base and kept[7] == words(909, 100) and kept[4] == rows[4][1]
    assert passage not in kept[5] and kept[5] == words(906, 50)
    assert plain_hits(kept[6], [(0, item)])[1] == 0 and kept[6].startswith(words(907, 30)) and kept[6].endswith(words(908, 30))


def test_run_is_registered(spark, sf_dir):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "decontamination", "packing"]
    assert jaccard_join.PERCENT == 80
