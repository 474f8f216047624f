from pyspark.sql import functions as F

from tidemark.llm import ctw, decontaminate, language, licenses, mixing, near_dedup, quality, token_file, topk, toxicity
from tidemark.llm.queries import VOCABULARY, tokenizer_path


def test_rows_without_an_id(spark):
    rows = [(None, "alpha beta gamma delta epsilon", "en", None), (None, None, None, "a"), (1, "alpha beta gamma delta epsilon", "en", "a"), (None, "other words stand here alone", "de", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(None, 1, 1), (1, None, None), (1, 0, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(None, "alpha beta gamma delta epsilon"), (3, None)], "item_id long, text string")
    assert ctw.score_documents(docs).count() == 4
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()} == {(None, None), (1, None)}
    assert decontaminate.decontaminated(docs, items).count() == 0  # rows without an id count as one document
    assert token_file.token_file(docs, tokenizer_path(), VOCABULARY).count() == 4
    assert quality.score_quality(docs, labels).count() == quality.accepted(docs, labels, threshold=0.0).count() == 4
    assert toxicity.score_toxicity(docs, labels).count() == 4
    assert language.identify(docs).count() == 4
    assert licenses.scan_licenses(docs).count() == 4
    taken = mixing.mix(docs)
    assert taken.count() == 4 and taken.where("taken > 2 * size").count() == 0
    found = near_dedup.near_duplicates(docs).orderBy("fp").collect()
    assert len(found) == 4 and sorted(str(r.component_id) for r in found) == ["1", "1", "None", "None"]
    assert near_dedup.representatives(docs).count() == 4
    vectors = spark.createDataFrame([(None, [1.0]), (0, [1.0]), (5, [2.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.vec_id) for r in topk.top_k(vectors, F.col("id") % 5 == 0).orderBy("query_id").collect()] == [(0, 5), (5, 0)]
