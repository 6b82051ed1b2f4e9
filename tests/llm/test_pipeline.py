"""The pipeline's stages on planted cases, and the registered queries."""

from __future__ import annotations

import __spark_entry__
import corpus_pipeline
from tests.llm.conftest import prose
from tests.llm.test_near_duplicates import brute
from tests.llm.test_pii import personal
from tests.llm.test_pu_quality import junk
from tidelog.llm.pii_patterns import base_spans


def write_tables(spark, folder: str) -> dict[int, str]:
    bench = [(i, prose(5000 + i, 25)) for i in range(10)]
    texts = {i: prose(i, 90) for i in range(300)}
    texts |= {300 + i: junk(i, 80) for i in range(0, 60)}
    texts |= {400 + i: texts[i] for i in range(10)}  # exact copies
    texts |= {420 + i: texts[i + 20] + " end" for i in range(10)}  # near copies
    texts |= {450 + i: f"{prose(700 + i, 40)} {bench[i][1]} {prose(800 + i, 40)}" for i in range(10)}
    texts |= {470 + i: personal(i) for i in range(30)}
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()]
    rows += [(1, texts[1], "en", "s", 1), (None, prose(900, 50), "en", "s", 1), (600, None, "en", "s", 0), (601, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, int(not 300 <= i < 400), 0) for i in texts]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return texts


def test_stages(spark, tmp_path):
    folder = str(tmp_path)
    texts = write_tables(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        out = stage(spark, docs, folder)
        if name != "bpe_encoding":
            assert out.columns == columns
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        seen[name] = (before, docs)
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}

    good = ids(seen["quality_classifier"][1])
    assert len(good & set(range(300, 360))) <= 3 and len(good & set(range(300))) >= 295

    before, after = seen["near_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    groups = brute([(i, t) for i, t in dict(rows).items() if i is not None], 5)
    assert ids(after) - {None} == {i for i, (_, _, kept) in groups.items() if kept}
    assert after.where("doc_id is not null").count() == len(ids(after) - {None})
    assert not ids(after) & set(range(400, 430))

    before, after = seen["decontamination"]
    assert ids(before) - ids(after) == ids(before) & set(range(450, 460))

    before, after = seen["personal_data"]
    assert ids(before) == ids(after) and before.count() == after.count()
    for r in after.collect():
        assert not base_spans(r.text or "") and r.n_chars == (None if r.text is None else len(r.text))
        if r.doc_id is not None and r.doc_id < 300:
            assert r.text == texts[r.doc_id]

    before, after = seen["bpe_encoding"]
    assert ids(before) == ids(after) and all(r.n_tokens == len(r.ids) for r in after.collect())


def test_run_applies_all_stages(spark, tmp_path):
    write_tables(spark, str(tmp_path))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "ids", "n_tokens"] and 250 < out.count() < 400


def test_every_query_is_registered():
    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and set(__spark_entry__.oracle_sql()) <= names


def test_queries_run(spark, tmp_path_factory):
    folder = "/root/testdata/sf0.001"
    for name in sorted(n for n in __spark_entry__.queries() if n.startswith("op")):
        rows = __spark_entry__.queries()[name](spark, folder)
        assert rows.count() > 0, name
