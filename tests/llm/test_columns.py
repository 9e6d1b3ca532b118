"""Extra columns with the names of helpers are handed on as they were."""

import pytest
from pyspark.sql import functions as F

from corpusflow.llm import media, mixing, neardup, urls

TAKEN = ("_payload", "_size", "_src", "_id", "_turn", "_words", "_psrc", "_pid", "_pturn", "_digest", "_first", "_mine", "digest", "row", "_rule", "_f_length", "_url", "score", "lang_pred", "bits_per_byte", "n_words", "n_removed", "a.b")


def with_all(df):
    return df.withColumns({c: F.concat(F.lit(f"{c}:"), F.col(df.columns[0]).cast("string")) for c in TAKEN})


def kept(rows, key, names=TAKEN):
    return all(r[c] == f"{c}:{r[key]}" for r in rows for c in names)


def docs(spark):
    text = lambda i: " ".join(f"w{i * 7 + k % 50}" for k in range(60))
    return with_all(spark.createDataFrame([(i, text(i % 6), "en" if i % 2 else "de", f"s{i % 3}", 5) for i in range(12)], "doc_id long, text string, lang string, source string, n_chars long"))


def test_media_mix_and_copies(spark):
    frame = docs(spark)
    rows = media.add_media(frame, "text", "wav").collect()
    assert len(rows) == 12 and kept(rows, "doc_id") and all(r["wav"] for r in rows)
    rows = mixing.mix(frame).collect()
    assert len(rows) > 12 and kept(rows, "doc_id") and set(rows[0].asDict()) == set(frame.columns) and all(r["n_chars"] == len(r["text"]) for r in rows)
    rows = neardup.keep_one(frame).collect()
    assert len(rows) == 6 and kept(rows, "doc_id") and set(rows[0].asDict()) == set(frame.columns)


def test_urls(spark):
    frame = with_all(spark.createDataFrame([(i, f"http://a{i}.example.com/en/{i}", "mine") for i in range(9)], "page_id long, url string, host string"))
    rows = urls.judge(frame).collect()
    assert len(rows) == 9 and kept(rows, "page_id") and all(r["host"] == f"a{r['page_id']}.example.com" for r in rows)


def test_stages_of_the_pipeline(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    taken = ("score", "lang_pred", "bits_per_byte", "n_words", "n_removed", "row", "_id", "_digest", "_size")
    words = [" ".join(f"w{i}{'abcdefghij'[k % 10]}" for k in range(40)) for i in range(6)]
    docs = spark.createDataFrame([(i, words[i % 6] + " tail", "en", "s", 4) for i in range(1, 9)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")) for c in taken})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, docs, "").collect()
        assert rows and set(rows[0].asDict()) == set(docs.columns), name
        assert all(r[c] == f"{c}:{r['doc_id']}" for r in rows for c in taken), name
