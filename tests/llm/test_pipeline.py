import corpus_pipeline
from tillsight.llm import simhash, toxicity
from tillsight.llm.common import fold, stored
from pyspark.sql import functions as F

from .helpers import empty, odd, words
from .test_bpe import PATH, check
from .test_quality import brute
from .test_simhash import brute_components, brute_print

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF))
        seen.append(docs)
    assert all(d.columns == columns for d in seen[:-1])
    rows = [d.collect() for d in seen]
    # Quality: no host of these tables is rejected, so exactly the base rule's failures go.
    assert {r["doc_id"] for r in rows[1]} == {r["doc_id"] for r in rows[0] if not brute(r["text"])[-1]}
    # Toxicity: the operator's own scores decide.
    machine = toxicity.train(seen[1].select("doc_id", "text"), spark.read.parquet(f"{SF}/labels.parquet"), fold(F.col("id"), 5) != 0)
    score = {r["doc_id"]: s for r, s in zip(rows[1], machine.scores([r["text"] or "" for r in rows[1]]), strict=True)}
    assert {r["doc_id"] for r in rows[2]} == {i for i, s in score.items() if s < 0.5}
    # One document of each component.
    low = brute_components([(r["doc_id"], brute_print(r["text"])) for r in rows[2]])
    assert sorted(r["doc_id"] for r in rows[3]) == sorted(set(low.values()))
    # The mix repeats documents of this stage only, up to three times.
    count = {}
    for r in rows[4]:
        count[r["doc_id"]] = count.get(r["doc_id"], 0) + 1
    assert count.keys() <= {r["doc_id"] for r in rows[3]} and max(count.values()) <= 3
    # Encoding: every row of the mix.
    text = {r["doc_id"]: r["text"] for r in rows[4]}
    assert sorted(r["doc_id"] for r in rows[5]) == sorted(r["doc_id"] for r in rows[4])
    check([r.asDict() | {"text": text[r["doc_id"]]} for r in rows[5]], Tokenizer.from_file(PATH))
    assert words("A b")


def test_run_equals_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 50
    assert corpus_pipeline.ORACLE_SQL is None and 4 <= len(corpus_pipeline.STAGES) <= 5


def test_stages_take_odd_and_empty_tables(spark):
    for docs in (odd(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF))
        assert docs.count() <= 36


def test_near_dedup_keeps_one_of_equal_rows(spark):
    rows = spark.createDataFrame([(5, "same text here again"), (5, "same text here again"), (3, "same text here again")],
                                 "doc_id long, text string")
    assert [r["doc_id"] for r in simhash.keep_one(rows).collect()] == [3]
