"""The registered queries against their SQL, and the pipeline against plain versions of its stages."""

from __future__ import annotations

import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline
from checks.compare import duckdb_tables, sorted_rows
from loomwork.llm import decontamination, oracles, pii, quality, queries
from tests.llm.test_near_dedup import brute_force as groups

TINY = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.queries())
    assert numbers == list(range(1, 14))
    assert set(queries.queries()) | {"pipeline"} <= set(driver.queries())
    assert set(oracles.oracle_sql()) <= set(driver.oracle_sql()) and "pipeline" not in driver.oracle_sql()


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_result_equals_sql(spark, name):
    df = driver.queries()[name](spark, TINY)
    mine = sorted_rows(df.columns, [tuple(row) for row in df.collect()])
    result = duckdb_tables(TINY).execute(driver.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert mine == sorted_rows(columns, result.fetchall()) and mine


@pytest.mark.parametrize("name", ["op6_pii", "op8_chat"])
def test_native_queries_run_no_python(spark, name):
    plan = driver.queries()[name](spark, TINY)._jdf.queryExecution().executedPlan().toString()
    for bad in ("Python", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin"):
        assert bad not in plan


def test_shapes(spark):
    wanted = {
        "op2_cross_entropy": "doc_id n_tokens target_loss background_loss difference",
        "op3_quality": "doc_id p_text p_meta quality kept",
        "op5_near_dedup": "doc_id n_shingles component_id kept",
        "op6_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
        "op7_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
        "op9_neighbours": "query_id rank vec_id score",
        "op10_token_files": "doc_id start n_tokens ids_crc32",
        "op11_token_alignment": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
        "op12_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
        "op13_chunked_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    }
    documents = spark.read.parquet(f"{TINY}/documents.parquet").count()
    for name, columns in wanted.items():
        df = driver.queries()[name](spark, TINY)
        assert df.columns == columns.split()
        assert df.count() == {"op9_neighbours": 25 * 20, "op12_prefix_trie": df.count()}.get(name, documents)


def as_dict(df):
    return {r.doc_id: r for r in df.collect()}


def test_pipeline_equals_plain_stages(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    given, columns = as_dict(docs), docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert [*stages] == ["quality_classifier", "minhash_near_dedup", "benchmark_decontamination", "personal_data", "bpe_encoding"]

    good = corpus_pipeline.staged(stages["quality_classifier"](spark, docs, TINY))
    model = quality.train(docs, queries.quality_labels(spark, TINY))
    want = set()
    for r in given.values():
        text, meta = quality.text_features(r.text.encode(), model.lexicon), quality.meta_features(r.lang, r.source)
        if model.probabilities(text[None], meta[None])[2][0] >= quality.KEEP:
            want.add(r.doc_id)
    now = as_dict(good)
    assert set(now) == want and all(now[i] == given[i] for i in now) and good.columns == columns

    single = corpus_pipeline.staged(stages["minhash_near_dedup"](spark, good, TINY))
    want = {name for name, _, _, kept in groups([(r.doc_id, r.text) for r in now.values()]) if kept}
    kept = as_dict(single)
    assert set(kept) == want and all(kept[i] == given[i] for i in kept) and single.columns == columns

    clean = corpus_pipeline.staged(stages["benchmark_decontamination"](spark, single, TINY))
    items = [decontamination.normalised_words(r.text.encode()) for r in spark.read.parquet(f"{TINY}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 10]) for w in items for i in range(max(1, len(w) - 9))}
    want = {}
    for r in kept.values():
        words = [(m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r.text)]
        lower = [r.text[a:b].encode().lower() for a, b in words]
        hit = np.zeros(len(words) + 1, dtype=bool)
        for i in range(len(words)):
            for size in {len(w) for w in windows}:
                if tuple(lower[i : i + size]) in windows:
                    hit[i : i + size] = True
        if hit.sum() > decontamination.MAX_COVERAGE * len(words):
            continue
        text, at = "", 0
        for i, (a, b) in enumerate(words):
            if hit[i]:
                if i == 0 or not hit[i - 1]:
                    text += r.text[at:a]
                at = b
        want[r.doc_id] = text + r.text[at:]
    cut = as_dict(clean)
    assert {i: r.text for i, r in cut.items()} == want
    assert all(r.n_chars == len(r.text) for r in cut.values()) and clean.columns == columns

    private = corpus_pipeline.staged(stages["personal_data"](spark, clean, TINY))
    spans = {r.doc_id: r.spans for r in pii.personal_data(clean).collect()}
    masked = as_dict(private)
    for i, r in cut.items():
        text, at = "", 0
        for s in spans[i]:
            if s["start"] >= at:
                text += r.text[at : s["start"]] + f"[{s['kind'].upper()}]"
            at = max(at, s["end"])
        assert masked[i].text == text + r.text[at:] and masked[i].n_chars == len(masked[i].text)
    assert set(masked) == set(cut) and private.columns == columns

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    final = as_dict(stages["bpe_encoding"](spark, private, TINY))
    assert set(final) == set(masked)
    for i, r in final.items():
        ids = library.encode(masked[i].text, add_special_tokens=False).ids
        assert bytes(r.ids) == np.array(ids, "<u4").tobytes() and r.n_tokens == len(ids) and r.text == masked[i].text
    assert as_dict(corpus_pipeline.run(spark, TINY)) == final
