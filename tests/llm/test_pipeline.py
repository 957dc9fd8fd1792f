"""The corpus pipeline, stage by stage, against brute-force versions."""

from collections import Counter

import corpus_pipeline as cp
from corpus_samples import DOCS
from pyspark.sql import functions as F
from test_corpus_ops import brute_dedup, brute_near, brute_spans, check_packing

from tracewise.llm import byte_cnn, packing

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_each_stage_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    source = rows_of(docs)
    # 1: the network, scored one text at a time
    model = byte_cnn.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = cp.keep_quality(spark, docs, SF).cache()
    assert kept.columns == columns
    want = [(i, t) for i, t in source if round(float(model.score(t or "")), 4) >= cp.MIN_SCORE]
    assert sorted(rows_of(kept)) == sorted(want) and 0 < len(want) < len(source)
    # 2: one row of each component
    near = cp.drop_near_copies(spark, kept, SF).cache()
    assert near.columns == columns
    comp = brute_near(want, 5, 80)
    want = [(i, t) for i, t in want if comp.get(i, i) == i]
    assert sorted(rows_of(near)) == sorted(want)
    # 3: repeated sentence runs
    cut = cp.cut_repeats(spark, near, SF).cache()
    assert cut.columns == columns
    clean = brute_dedup(want)
    want = [(i, clean[i][0]) for i, _ in want if not clean[i][1] or clean[i][0].strip()]
    assert sorted(rows_of(cut)) == sorted(want)
    assert cut.where("n_chars <> char_length(text)").count() == 0
    # 4: no personal data that the exact patterns find is left; other texts are untouched
    redacted = cp.redact_personal_data(spark, cut, SF).cache()
    assert redacted.columns == columns
    after = dict(rows_of(redacted))
    assert set(after) == {i for i, _ in want}
    for i, t in want:
        assert not brute_spans(after[i])
        if after[i] != t:
            assert any(f"[{k}]" in after[i] for k in ("EMAIL", "IP", "CARD", "PHONE"))
        else:
            assert not brute_spans(t)
    assert redacted.where("n_chars <> char_length(text)").count() == 0
    # 5: every character packed once
    packed = cp.pack_sequences(spark, redacted, SF).collect()
    check_packing(packed, list(after.items()), packing.CAPACITIES)
    assert all(r["piece_text"] == after[r["doc_id"]][r["start"]:r["start"] + r["size"]] for r in packed)


def test_run_equals_its_stages(spark):
    out = cp.run(spark, SF)
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "minhash near-dedup", "substring dedup", "pii",
                                         "best-fit packing"]
    again = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in cp.STAGES:
        again = stage(spark, again, SF)
    order = sorted(out.columns)
    assert sorted(map(tuple, out.select(order).collect())) == sorted(map(tuple, again.select(order).collect()))


def test_stages_handle_odd_rows(spark, odd_docs):
    extra = odd_docs.withColumn("score", F.lit("a")).withColumn("kept", F.lit(1)).withColumn("spans", F.lit(2.0))
    for docs in (extra, extra.limit(0)):
        for name, stage in cp.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            out.collect()
        cp.pack_sequences(spark, docs, SF).collect()
    near = Counter(r["doc_id"] for r in cp.drop_near_copies(spark, odd_docs, SF).collect())
    assert near[1] == 1 and 7 not in near and near[None] == 2
    assert cp.keep_quality(spark, spark.createDataFrame([], DOCS), SF).count() == 0
