import zlib

from samples import ROWS, no_documents, odd_documents

from corpusloom.llm import languages


def test_odd_rows(spark):
    df = odd_documents(spark)
    for learned in (languages.learn_dictionaries(df), languages.learn_dictionaries(no_documents(spark))):
        rows = languages.predict(df, learned).collect()
        assert len(rows) == len(ROWS)
        for r in rows:
            text = next(t for i, t, *_ in ROWS if i == r.doc_id)
            assert 0.0 <= r.score <= 1.0
            if not learned or not text or not any(map(str.isalpha, text)):
                assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            else:
                assert r.lang_pred in learned
    assert languages.predict(no_documents(spark), learned).count() == 0


def test_held_out_third(spark):
    from pyspark.sql import functions as F

    rows = spark.range(300).select("id", languages.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)
    assert spark.sql("SELECT CAST(NULL AS bigint) AS id").select(languages.held_out(F.col("id"))).first()[0] is False


def test_dictionaries_ignore_held_out_rows_and_the_order_of_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    once = languages.learn_dictionaries(docs)
    assert once == languages.learn_dictionaries(docs.repartition(5))
    assert set(once) == {"en", "de", "fr", "es"} and all(len(v) <= languages.DICTIONARY_BYTES for v in once.values())


def test_held_out_accuracy(spark):
    from corpusloom.llm.queries import all_queries

    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = all_queries()["op5_language_id"](spark, sf).collect()
    assert len(rows) == len(truth)
    judged = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert len(judged) > 250 and sum(judged) / len(judged) > 0.97
