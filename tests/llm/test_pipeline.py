"""The pipeline's stages, each against what it promises."""

from __future__ import annotations

import pytest

from pagewright.llm import token_counts

from .conftest import sentences
from .test_duplicates import brute, runs

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(make, spark, tmp_path):
    passage = sentences(1, 8)
    rows = [(i, sentences(100 + i, 6 + i % 5), f"s{i % 3}") for i in range(160)]
    rows = [(i, t + " zorgq you", s) if i % 6 == 0 else (i, t, s) for i, t, s in rows]
    rows += [(200 + i, sentences(101, 7) if i < 3 else sentences(900 + i, 5) + " " + passage, "s1") for i in range(8)] + [(300, None, None), (301, "", "s0")]
    make(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(160)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stage(spark, docs, str(tmp_path)).cache()
        kept[name] = docs
        if name != "piece_encoding":
            assert docs.columns == columns
    ids = {n: [r.doc_id for r in d.select("doc_id").collect()] for n, d in kept.items()}
    assert set(ids["toxicity"]) == {i for i, t, _ in rows if "zorgq" not in (t or "")}
    clean = [(i, t) for i, t, _ in rows if "zorgq" not in (t or "")]
    _, component = brute(clean, 5, 80)
    assert sorted(ids["minhash_near_dedup"]) == sorted(i for i, _ in clean if component[i] == i)
    texts = {r.doc_id: r.text for r in kept["substring_dedup"].collect()}
    assert sum(passage in (t or "") for t in texts.values()) == 1
    left = [runs(t) for t in texts.values()]
    assert sum(map(len, left)) == len(set().union(*left))
    assert all(len(t or "") == n for t, n in ((r.text, r.n_chars) for r in kept["substring_dedup"].collect()))
    sp = token_counts.processor(token_counts.MODEL)
    assert all(list(r.ids) == sp.encode(texts[r.doc_id] or "") for r in kept["piece_encoding"].collect())
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(ids["piece_encoding"])


def test_odd_and_empty_tables(odd, spark, tmp_path):
    spark.createDataFrame([(1, 1, 1), (7, 1, 0), (12, 0, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for table in (odd, odd.limit(0)):
        docs = table
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        docs.count()
