"""What a Python worker holds, and keeps from one step to the next."""

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import jaccard, packing
from tidemark.llm.common import stage_lean

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_a_worker_remembers_the_words_of_one_operator():
    encoder = packing.encoder(TOKENIZER)
    before = jaccard.shingles(b"one two three four five six")
    ids = encoder.encode([b"seven eight"])
    assert encoder.words and not jaccard._WORD_HASHES
    assert (jaccard.shingles(b"one two three four five six") == before).all()
    assert jaccard._WORD_HASHES and not encoder.words
    assert encoder.encode([b"seven eight"]) == ids


def batch_sizes(batches):
    for batch in batches:
        yield pa.record_batch([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])


def test_texts_are_handed_over_in_small_batches(spark):
    texts = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("abc "), 1000).alias("text"))
    found = stage_lean(texts.mapInArrow(lambda batches: batch_sizes(batches), "n long, size long")).collect()
    assert sum(row.n for row in found) == 4000
    assert max(row.size for row in found) < 6_000_000
    assert spark.conf.get(BATCH, None) is None


def test_packing_cuts_texts_in_small_batches(spark, monkeypatch):
    met, stage = [], packing.stage
    monkeypatch.setattr(packing, "stage", lambda df: met.append(df.sparkSession.conf.get(BATCH, None)) or stage(df))
    docs = spark.createDataFrame([(1, "one two three"), (2, None)], "doc_id long, text string")
    assert packing.pack(docs, TOKENIZER).count() == 2
    assert met == [str(2**22)]
    assert spark.conf.get(BATCH, None) is None
