import hashlib

import public_tokenizers
from llm_cases import SF, bench_words, classes, documents, edge_docs, empty_docs, lines_without_repeats, passages

import corpus_pipeline
from quarry.llm import byte_bpe, toxicity


def test_pipeline_against_brute_force(spark):
    import pandas as pd
    bench = pd.read_parquet(f"{SF}/benchmark.parquet")
    docs = documents()
    model = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    weight = lambda t: sum(model.weights.get(i, 0.0) for w in toxicity.words_of(t) for i in toxicity.word_features(w))
    import numpy as np
    toxic = {d for d, t in zip(docs.doc_id, docs.text, strict=True)
             if len(model.thresholds) and model.above(np.array([weight(t)]))[0, 0] >= toxicity.TOXIC_FROM}
    rows = [(int(d), t) for d, t in zip(docs.doc_id, docs.text, strict=True) if d not in toxic]
    lines = lines_without_repeats(rows)
    rows = [(d, lines[d][2]) for d, _ in rows if not (lines[d][1] and not lines[d][2].strip(" \t\r\n"))]
    text = dict(rows)
    rows = [(d, text[d]) for d, _, c in classes(rows, 5) if d == c]
    leaked = {d for d, _ in passages(rows, zip(bench.item_id, bench.text, strict=True))}
    codec = byte_bpe.Codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    expected = {d: codec.encode(t) for d, t in rows if d not in leaked}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(expected) and len(got) < len(docs)
    for d, ids in expected.items():
        assert got[d].ids == ids and got[d].n_tokens == len(ids)
        assert got[d].decoded_sha256 == hashlib.sha256(text[d].encode()).hexdigest()


def test_stages_keep_the_columns_and_take_edge_rows(spark, tmp_dir):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "minhash_dedup", "decontaminate", "byte_bpe"]
    for frame in (edge_docs(spark), empty_docs(spark)):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, frame, SF)
            if k < 4:
                assert out.columns == frame.columns
                assert out.schema.simpleString() == frame.schema.simpleString()
            path = f"{tmp_dir}/{len(frame.columns)}-{name}"
            out.write.parquet(path)
            frame = spark.read.parquet(path)
        assert {"doc_id", "n_tokens", "ids"} <= set(frame.columns)


def test_bench_words_rule():
    assert bench_words("It's a Test-case, Ünïcode 12!") == ["it", "s", "a", "test", "case", "ünïcode", "12"]
