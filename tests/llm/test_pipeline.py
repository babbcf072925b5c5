import corpus_pipeline
from actaspark.llm import line_dedup, minhash, mixing
from actaspark.llm.common import stored


def test_stages(spark, odd_docs, no_docs, tmp_path):
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, str(tmp_path)), "test-stage")
        seen.append((before, docs))
        if name != "packing":
            assert docs.columns == before.columns
    (a, b), (_, c), (_, d), (_, e), (_, f) = seen
    ids = lambda x: sorted(str(r["doc_id"]) for r in x.select("doc_id").collect())
    gone = set(ids(a)) - set(ids(b))
    assert {"75", "76", "77", "80"} <= gone and len(gone) <= 7
    lines = line_dedup.line_classes(b).filter("not kept").count()
    assert lines and c.count() < b.count()
    assert ids(d) == ids(c.join(minhash.near_groups(c).filter("kept").select("doc_id"), "doc_id", "left_semi").unionByName(c.filter("doc_id is null")))
    copies = mixing.mix(d).agg({"copies": "sum"}).first()[0]
    assert e.count() == copies
    assert f.groupBy("sequence_id").agg({"length": "sum"}).filter("`sum(length)` > 2048").count() == 0
    assert set(ids(f)) == set(ids(e))
    empty = no_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        empty = stored(stage(spark, empty, str(tmp_path)), "test-stage")
    assert empty.count() == 0
