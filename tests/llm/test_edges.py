"""Odd input to every operator and stage: nulls, empty and long texts, copies, empty tables, clashing names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (
    decontamination, language_id, line_quality, piece_bpe, secret_scan, simhash, toxicity, transcripts, unigram_count,
    url_filter,
)
from tidemark.llm.common import prepare

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LONG = "the quick brown fox jumps over a lazy dog 12345 " * 5_000
TEXTS = [None, "", " \n\t", "x", "one line\none line\n", "\0 weird \U0001F600 ▁▁ text", LONG,
         'token = "0123456789abcdef0123456789abcdef"', "http://a.org/x", "copy me please now", "copy me please now"]
CLASH = ["score", "predicted", "lang_pred", "spans", "fingerprint", "component_id", "n_words", "hit_starts", "ids",
         "host", "rule", "verdict", "kept", "_row", "_fp", "_id", "_text", "_hash", "_host", "_lines", "_root", "n_tokens"]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, 0) for i, t in enumerate(TEXTS)]
    rows += [(10, "copy me please now", None, "s", 0), (None, "no id at all here", None, None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("own") for c in CLASH})


def run_url(docs):
    return url_filter.url_filter(docs, docs, [("allow", "org/")], url="text", listed_url="text")


def run_hits(docs):
    items = docs.select(F.col("doc_id").alias("item_id"), "text")
    return decontamination.find_hits(docs, items)


def run_clean(docs):
    items = docs.filter("doc_id = 9").select(F.col("doc_id").alias("item_id"), "text")
    return decontamination.decontaminate(docs, items)


def run_language(docs):
    return language_id.predict(docs, language_id.train(docs))


def run_toxicity(docs):
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))
    return toxicity.score(docs, toxicity.train(docs, labels))


def run_secrets(docs):
    return secret_scan.scan(docs, secret_scan.train(docs))


ALL_ROWS = [
    (run_url, {"host", "path", "rule", "listed", "verdict"}, set()),
    (run_hits, {"n_words", "hit_starts", "hit_ends", "hit_items"}, set()),
    (line_quality.quality_rules, {*line_quality.RESULTS}, {"text"}),
    (line_quality.remove_lines, set(), set()),
    (run_language, {"lang_pred", "score"}, set()),
    (run_toxicity, {"score", "predicted"}, set()),
    (run_secrets, {"n_assign", "n_access", "n_hex", "base_sha256", "spans"}, set()),
    (simhash.near_duplicates, {"fingerprint", "component_id"}, {"text"}),
    (lambda d: unigram_count.count_tokens(d, MODEL), {"n_tokens", "score"}, set()),
    (lambda d: piece_bpe.encode_documents(d, MODEL, with_ids=True),
     {"n_tokens", "ids_sha256", "decoded_sha256", "ids"}, set()),
]


@pytest.mark.parametrize("case", range(len(ALL_ROWS)))
def test_every_row_gets_a_result(docs, case):
    run, made, gone = ALL_ROWS[case]
    got = run(docs)
    assert set(got.columns) == (set(docs.columns) - gone) | made
    rows = got.collect()
    assert len(rows) == docs.count()
    for name in set(CLASH) - made:
        assert all(r[name] == "own" for r in rows)
    copies = [r.asDict() for r in rows if r["doc_id"] == 10]
    assert len(copies) == 2 and copies[0] == copies[1]


@pytest.mark.parametrize("case", range(len(ALL_ROWS)))
def test_empty_table(docs, case):
    run, made, gone = ALL_ROWS[case]
    got = run(docs.limit(0))
    assert set(got.columns) == (set(docs.columns) - gone) | made
    assert got.collect() == []


def test_cutting_keeps_columns(docs):
    rows = run_clean(docs)
    assert rows.columns == docs.columns
    left = sorted((r["doc_id"], r["text"]) for r in rows.collect() if r["doc_id"] in (8, 9, 10))
    assert left == [(8, "http://a.org/x")]  # the copies consist of the item alone
    assert run_clean(docs.limit(0)).collect() == []


def test_one_of_each_group_stays(docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    # 0, 1 and 2 have no words and link; 9 and 10 are copies; the row without an id is a group of its own.
    assert sorted(x for x in ids if x is not None) == [0, 3, 4, 5, 6, 7, 8, 9] and ids.count(None) == 1
    assert simhash.keep_one(docs.limit(0)).collect() == []


def test_transcripts(docs):
    model = transcripts.train(docs.select(F.lit(1).alias("conv_id"), F.col("doc_id").alias("seq"),
                                          F.lit("user").alias("role"), "text"))
    rows = docs.select(F.col("source").alias("conv_id"), F.lit(1).alias("seq"), "text")
    got = transcripts.parse(rows, model, chunk_rows=2).collect()
    assert {r["conv_id"] for r in got} == {None, "s"}
    text = "".join(r["content"] for r in got)
    assert text.count("copy me please now") == 3 and LONG.strip()[-40:] in text
    assert transcripts.parse(rows.limit(0), model).collect() == []
    assert transcripts.train(rows.limit(0).withColumn("role", F.lit("user"))).start.shape == (9,)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages(spark, docs, tmp_path, name, stage):
    labels = docs.select("doc_id", F.lit(0).alias("quality"), F.lit(0).alias("toxic"))
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs.select(F.col("doc_id").alias("item_id"), F.lit("some other item").alias("text")).write.parquet(
        f"{tmp_path}/benchmark.parquet")
    for rows in (docs, docs.limit(0)):
        got = stage(spark, rows, str(tmp_path))
        if name != "encode":
            assert got.columns == rows.columns and [f.dataType for f in got.schema] == [f.dataType for f in rows.schema]
        found, given = got.collect(), rows.count()
        assert len(found) <= given
        if name in ("toxicity", "decontamination", "secrets", "encode"):  # no toxic label, no passage: all stay
            assert len(found) == given
