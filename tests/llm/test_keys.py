"""Keys that an operator cannot order as numbers are refused before any work."""

from __future__ import annotations

import pytest

from tidelog.llm import order_minhash, tensored_minhash, warc


def test_text_keys_are_refused(spark):
    docs = spark.createDataFrame([("a", "some text", "u")], "doc_id string, text string, url string")
    for call in (
        lambda: order_minhash.fingerprints(docs),
        lambda: tensored_minhash.near_duplicates(docs),
        lambda: warc.write(docs, key="doc_id", payload="text"),
    ):
        with pytest.raises(ValueError, match="whole numbers"):
            call()
