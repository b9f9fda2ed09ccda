"""The pipeline on the smallest tables, and on no rows."""

import corpus_pipeline as pipeline
import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(llm):
    return llm.read.parquet(f"{SMALL}/documents.parquet")


def test_stages_keep_columns_and_drop_what_they_should(llm, documents):
    wide = documents.selectExpr("*", "'a' AS score", "1 AS row", "2 AS number")
    rows = wide.union(wide.where("doc_id % 3 = 0"))
    rows = rows.unionByName(
        llm.createDataFrame([(None, None, None, None, None, "a", 1, 2)], wide.schema)
    )
    before = rows.count()
    for name, work in pipeline.STAGES[:-1]:
        rows = work(llm, rows, SMALL)
        assert rows.columns == wide.columns, name
        rows = llm.createDataFrame(rows.collect(), wide.schema)
        assert 0 < rows.count() <= before
        before = rows.count()
    ids = [r.doc_id for r in rows.collect()]
    assert len(ids) == len(set(ids))
    assert None not in ids
    coded = pipeline.STAGES[-1][1](llm, rows, SMALL)
    assert sorted(r.doc_id for r in coded.collect()) == sorted(ids)


def test_no_documents(llm, documents):
    for name, work in pipeline.STAGES:
        assert work(llm, documents.where("false"), SMALL).count() == 0, name


def test_run_matches_the_stages(llm, documents):
    rows = documents
    for _, work in pipeline.STAGES:
        rows = work(llm, rows, SMALL)
    got = {(r.doc_id, r.n_tokens) for r in pipeline.run(llm, SMALL).collect()}
    assert got == {(r.doc_id, r.n_tokens) for r in rows.collect()}


def test_language_stage_drops_noise_and_keeps_clean_texts(llm, documents):
    strange = [
        (10_000_001, "zqxj vkwq jjxz qqkv xwzj kqvx zzjq wvxk qjzx vkqw xjqz " * 5),
        (10_000_002, "Съешь же ещё этих мягких французских булок да выпей чаю " * 5),
        (10_000_003, "... 123 ..."),
        (10_000_004, None),
    ]
    added = llm.createDataFrame(strange, "doc_id BIGINT, text STRING")
    rows = documents.unionByName(added, allowMissingColumns=True)
    kept = dict(pipeline.STAGES)["language ID"](llm, rows, SMALL)
    clean = {r.doc_id for r in documents.where(r"text rlike '\\p{L}'").collect()}
    assert {r.doc_id for r in kept.collect()} == clean
