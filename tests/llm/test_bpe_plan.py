"""What a plan of the tokenizer holds."""

import public_tokenizers

from tidewatch.llm.bpe import Tokenizer


def test_plans_are_short(spark):
    # the rank table as a literal made each plan's text 2.5 million characters, which the driver keeps
    docs = spark.createDataFrame([(1, "unusualwordform other")], "doc_id long, text string")
    tok = Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    made = tok.encode(docs, decoded_col="decoded")
    assert len(made._jdf.queryExecution().toString()) < 100_000
    assert bytes(made.first().decoded) == b"unusualwordform other"
