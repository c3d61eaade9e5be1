"""What prediction sends to its workers."""

from millrace.llm import language

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_a_carried_text_travels_once_in_small_batches(spark):
    said = {"en": "the cat sat on the mat and it was fine", "de": "der hund lief durch den wald und heim"}
    docs = spark.createDataFrame(
        [(i, None if i == 7 else f"{said[k]} {i}", k) for i, k in enumerate(["en", "de"] * 60)],
        "doc_id long, text string, lang string",
    )
    before = spark.conf.get(BATCH)
    try:
        spark.conf.set(BATCH, "10000")
        model = language.fit(docs)
        whole = language.predict(docs, model, docs.columns)
        assert int(spark.conf.get(BATCH)) <= 1000
        spark.conf.set(BATCH, "7")
        short = language.predict(docs, model)
        assert spark.conf.get(BATCH) == "7"
        # The text is a field of what is carried, and no column beside it.
        sent = whole._jdf.queryExecution().analyzed().children().head().output().mkString(",")
        assert sent.count("text") == 0 and sent.count("__row") == 1
        found = {r.doc_id: r for r in whole.collect()}
        assert {r.doc_id: (r.lang_pred, r.score) for r in short.collect()} == {
            k: (r.lang_pred, r.score) for k, r in found.items()
        }
        assert {k: r.text for k, r in found.items()} == {r.doc_id: r.text for r in docs.collect()}
        assert found[7].lang_pred == "und"
    finally:
        spark.conf.set(BATCH, before)
