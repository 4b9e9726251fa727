from __future__ import annotations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from renewline.llm import langid, packing, tiling
from tests.llm import data
from tests.llm.test_secrets import brute
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_tiling import ITEMS


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    texts = data.odd_texts() + [data.prose(s, 120) for s in range(200, 240)]
    texts += texts[20:30] + [data.prose(300, 50) + " " + ITEMS[0] + " " + data.prose(301, 50)]
    texts += [data.prose(302, 80) + ' token = "0123456789abcdef0123456789abcdef01234567" ' + data.prose(303, 20)]
    data.parquet(data.documents(spark, texts), folder)
    items = spark.createDataFrame(list(enumerate(ITEMS)), "item_id long, text string")
    data.parquet(items, folder, "benchmark")
    return str(folder)


def test_stages_name_the_dealt_operators():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "simhash_dedup", "decontaminate", "secret_scan", "packing"]


def test_run_equals_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    kept = [r for r in docs if r.text and langid._LETTER.search(r.text)]
    groups = plain_components([plain_fingerprint(r.text) for r in kept], [r.doc_id for r in kept])
    kept = {r.doc_id: r.text for r, g in zip(kept, groups) if r.doc_id == g}
    items = tiling.Items(list(enumerate(ITEMS)))
    kept = {i: t for i, t in kept.items() if not items.leaks(t, 0.5)}
    lengths = {}
    for i, text in kept.items():
        covered: list[list[int]] = []
        for a, _, b in brute(text):
            if covered and a <= covered[-1][1]:
                covered[-1][1] = max(b, covered[-1][1])
            else:
                covered.append([a, b])
        for a, b in reversed(covered):
            text = text[:a] + "[SECRET]" + text[b:]
        lengths[i] = len(text.encode().split())
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == lengths
    assert len(rows) == len(lengths)
    bounds = packing.boundaries(sorted((n, list(lengths.values()).count(n), n * list(lengths.values()).count(n)) for n in set(lengths.values())))
    assert all(r.bucket_len == min(b for b in bounds if b >= r.n_tokens) for r in rows)


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).schema.simpleString() == docs.schema.simpleString(), name


def test_masked_texts_get_their_new_length(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    for r in corpus_pipeline.secret_scan(spark, docs, folder).collect():
        if r.text != before[r.doc_id].text and r.doc_id is not None:
            assert "[SECRET]" in r.text and r.n_chars == len(r.text)


def test_stages_take_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0, name


def test_documents_without_any_language_label_stay(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    data.parquet(bare, tmp_path)
    data.parquet(spark.read.parquet(f"{folder}/benchmark.parquet"), tmp_path, "benchmark")
    kept = corpus_pipeline.language_id(spark, bare, str(tmp_path)).collect()
    expected = [r.doc_id for r in docs.collect() if r.text and langid._LETTER.search(r.text)]
    assert sorted(map(str, expected)) == sorted(str(r.doc_id) for r in kept) and kept
    found = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert found == {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()}


def test_extra_columns_named_like_helpers_stay(spark, folder):
    names = ["_id", "_row", "_hash", "_missing", "_spans", "text_hash", "secret_spans", "id", "hash", "goes", "row", "part", "b.c"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id is not null").select("doc_id", "text", "lang", "source", "n_chars")
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.col("doc_id") * 100 + i)
    for stage, apply in corpus_pipeline.STAGES[:-1]:
        kept = apply(spark, docs, folder)
        assert kept.columns == docs.columns, stage
        rows = kept.collect()
        assert rows
        for r in rows:
            assert [r[n] for n in names] == [r.doc_id * 100 + i for i in range(len(names))], (stage, r.doc_id)


def test_missing_languages_are_filled(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    net = langid.train(docs)
    kept = corpus_pipeline.language_id(spark, docs, folder).collect()
    assert kept and all(r.lang for r in kept)
    before = {(r.doc_id, r.text): r.lang for r in docs.collect()}
    for r in kept:
        assert r.lang == (before[r.doc_id, r.text] or langid.classify(net, [r.text])[0][0])


def test_one_of_rows_repeated_many_times_stays(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    rows = [(7, data.prose(5, 90))] * 400 + [(None, data.prose(6, 90))] * 300 + [(8, data.prose(7, 90)), (9, data.prose(5, 90))]
    many = docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    assert sorted(str(r.doc_id) for r in corpus_pipeline.simhash_dedup(spark, many, folder).collect()) == ["7", "8", "None"]
