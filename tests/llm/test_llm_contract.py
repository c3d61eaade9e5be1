"""Registered queries on the smallest tables, and the pipeline's stages one after the other."""

import os

import duckdb
import pytest

import corpus_pipeline
from millrace.llm import queries
from millrace.llm.components import components
from millrace.llm.jaccard_join import near_duplicates
from millrace.session import durable, shared_root

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the generated tables")

TABLE = {"op3": "pages", "op5": "pages"}
COLUMNS = {
    "op1": "doc_id piece start length ids_crc32 sequence_id offset",
    "op2": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op3": "page_id url text n_chars",
    "op4": "doc_id held_out lang_pred score",
    "op5": "page_id host path rule verdict",
    "op6": "doc_id n_shingles component_id",
    "op7": "doc_id n_words n_removed kept_sha256",
    "op8": "query_id rank vec_id score",
    "op9": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op10": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op12": "vec_id component n deviation whitened explained identity_error",
    "op13": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op11": "doc_id held_out n_tokens n_known train_tokens base_score score",
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_gives_a_row_for_each_row_of_its_table(spark, name):
    found = queries.QUERIES[name](spark, SMALL)
    number = name.split("_")[0]
    assert set(COLUMNS[number].split()) <= set(found.columns)
    rows = found.count()
    if number not in ("op1", "op8", "op12", "op13"):
        table = TABLE.get(number, "documents")
        assert rows == spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    if number == "op1":
        assert found.select("doc_id").distinct().count() == 200


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for file in os.listdir(SMALL):
        duck.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SMALL}/{file}'")
    found = queries.QUERIES[name](spark, SMALL)
    expected = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in expected.description]
    shared = [n for n in names if n in found.columns]
    assert sorted(names) == sorted(found.columns)
    mine = sorted(map(tuple, found.select(shared).collect()), key=repr)
    assert mine == sorted(expected.fetchall(), key=repr)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    empty = docs.limit(0)
    columns = docs.columns
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = durable(stage(spark, docs, SMALL), name)
        empty = durable(stage(spark, empty, SMALL), name)
        assert docs.columns == empty.columns == columns
        assert 0.7 * before < docs.count() <= before
        assert docs.select("doc_id").distinct().count() == docs.count()
        assert empty.count() == 0
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == before
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SMALL).count() == 0


def test_near_copies_in_the_pipeline_leave_one(spark):
    text = "one of the many words that a text may have in it before it says what it wants to say " * 3
    texts = [text + f"end{i}" for i in range(4)] + [text, text, "quite another text with its own words"]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    kept = corpus_pipeline.jaccard_join(spark, docs, SMALL)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 6]


def left_by(spark, job):
    """What a job returns, and the stages that it leaves below the shared folder."""
    before = set(os.listdir(shared_root(spark)))
    made = job()
    return made, sorted(n.split("-")[0] for n in set(os.listdir(shared_root(spark))) - before)


def test_near_duplicates_leave_only_the_rows_they_return(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for light in (None, 8):
        found, left = left_by(spark, lambda: near_duplicates(docs, size=5, per_cent=80, light=light))
        assert left == ["near"]
        assert found.count() == docs.count()
        assert found.filter("component_id <> doc_id").count()
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    labels, left = left_by(spark, lambda: components(chain))
    assert len(left) == 1 and labels.count() == 61


def test_pipeline_run_leaves_no_stage_that_a_later_one_has_read(spark):
    packed, left = left_by(spark, lambda: corpus_pipeline.run(spark, SMALL))
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert [n for n in left if n in names] == ["substring_dedup"]
    assert packed.count()
