"""Every stage works on all its predecessor kept and its decisions take effect."""

import corpus_pipeline
from goldweave.llm.common import scratch
from test_text_overlap import plain_contamination, plain_join, words

SF = "/root/testdata/sf0.001"


def test_stages_in_order_take_effect(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard_join", "decontamination", "packing"]
    work = scratch(spark, "test")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(work.save(stage(spark, kept[-1], SF), name))
    for frame in kept[1:-1]:
        assert frame.columns == docs.columns
    ids = [[r.doc_id for r in f.select("doc_id").collect()] for f in kept[:-1]]
    assert len(ids[1]) < len(ids[0]) and sorted(ids[2]) == sorted(ids[1])
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    wrong = [d for d in ids[0] if labels.get(d) == 0 and d not in set(ids[1])]
    assert len(wrong) <= 0.02 * len(ids[0])

    near_in = [(r.doc_id, r.text) for r in kept[2].collect()]
    classes = {d: c for d, c, _ in plain_join([x for x in near_in if words(x[1])])}
    assert sorted(ids[3]) == sorted({*classes.values(), *(d for d, t in near_in if not words(t))})
    leaks = {d for d, _, n, _ in plain_contamination([(r.doc_id, r.text) for r in kept[3].collect()], bench) if n}
    assert sorted(ids[4]) == sorted(set(ids[3]) - leaks)
    assert {r.doc_id for r in kept[5].select("doc_id").collect()} == set(ids[4])
    assert corpus_pipeline.run(spark, SF).count() == kept[5].count()


def test_stages_of_empty_and_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, key string"
    odd = spark.createDataFrame([(1, None, None, None, None, None, None), (2, "", "en", "s", 0, 1.0, "k"), (2, "", "en", "s", 0, 1.0, "k"), (None, "x y", "en", "s", 3, 1.0, "k")], schema)
    for docs, rows in ((odd, 4), (odd.limit(0), 0)):
        work = scratch(spark, "test")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = work.save(stage(spark, docs, SF), name)
            assert docs.columns == odd.columns and docs.count() == rows
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == (5 if rows else 0)
