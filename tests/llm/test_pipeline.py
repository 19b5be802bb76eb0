"""The pipeline's stages on odd rows, and its queries in the driver's contract."""

from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from ledgerloom.llm import decontaminate
from ledgerloom.llm.queries import QUERIES, SQL

TEXT = " ".join(f"the and of words{i} in this line" for i in range(12))


def test_stages(spark, tmp_path):
    rows = [(1, TEXT), (2, TEXT.replace("words3", "other")), (3, None), (4, "12 34"), (5, "first own line here\n" + " ".join(f"more of the words{i} with it" for i in range(60, 80))), (None, "no id but words of its own in the text")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(f"more of the words{i} with it" for i in range(63, 66)))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left.append(spark.createDataFrame(stage(spark, left[-1], str(tmp_path)).collect(), docs.schema))
    ids = [sorted((r.doc_id or 0) for r in d.collect()) for d in left]
    assert ids[0] == [0, 1, 2, 3, 4, 5] and ids[1] == [0, 1, 2, 5]
    assert ids[2] == [0, 1, 5]  # 2 is one edit from 1 in its only line
    assert ids[3] == [0, 1, 5] and ids[4] == [0, 1]
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0) for r in out) == [0, 1] and all(r.round_trip and r.n_tokens > 0 for r in out)


COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS)


def test_repeated_ids_are_told_apart_by_their_texts(spark):
    other = " ".join(f"quite another text number{i} here" for i in range(20))
    rows = [(1, TEXT), (1, TEXT), (1, other), (1, TEXT.replace("words3", "changed")), (2, TEXT), (3, other), (4, ""), (4, ""), (5, None), (None, TEXT), (None, TEXT)]
    got = sorted((r.doc_id or 0, r.text or "") for r in corpus_pipeline.keep_one_of_each(spark, docs_of(spark, rows), "").collect())
    assert [i for i, _ in got] == [0, 0, 1, 1, 4, 5]
    assert other in [t for i, t in got if i == 1] and sum("line" in t for i, t in got if i == 1) == 1


def test_short_items_take_no_document_out(spark, tmp_path):
    bench = spark.createDataFrame([(1, "people"), (2, "the very long item of words that people keep")], "item_id bigint, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = docs_of(spark, [(i, f"Some people read text {i}") for i in range(6)] + [(7, "x the very long item of words that people keep y")])
    assert sorted(r.doc_id for r in corpus_pipeline.drop_benchmark(spark, rows, str(tmp_path)).collect()) == list(range(6))
    assert [r.item_id for r in decontaminate.short_items(bench, corpus_pipeline.MIN_ITEM_WORDS).collect()] == [1]


def test_stages_on_odd_tables(spark, tmp_path):
    spark.createDataFrame([(1, "some benchmark item of seven words here")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    long = " ".join(f"the word{i % 500} and of" for i in range(60_000))
    odd = docs_of(spark, [(1, long), (1, long), (2, "tie line of some words here to keep"), (3, "tie line of some words here to keep"), (None, None), (4, "")]).withColumns({"score": F.lit("x"), "key": F.lit(1), "digest": F.lit(2)})
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), str(tmp_path)).count() == 0
        out = stage(spark, odd, str(tmp_path))
        ids = sorted(str(r.doc_id) for r in out.collect())
        assert "1" in ids and "2" in ids
        if name != "bpe":
            assert out.columns == corpus_pipeline.COLUMNS


def test_registered():
    registered = contract.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "jaccard_join", "decontamination", "bpe"]
    assert set(QUERIES) | {"pipeline"} <= set(registered) and set(SQL) <= set(contract.oracle_sql())
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
