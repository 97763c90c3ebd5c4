"""What a worker holds while documents are encoded."""

from __future__ import annotations

import numpy as np
import public_tokenizers

from roadlens.llm import bm25_packing
from roadlens.llm.common import utf8_buffers
from roadlens.llm.queries import BYTE_BPE, WORD_BPE, WORD_BPE_SIZE
from roadlens.llm.token_ids import Encoder


def test_pieces_met_once_are_not_kept():
    import pyarrow as pa

    for name in (WORD_BPE, BYTE_BPE):
        encode = Encoder(public_tokenizers.path(name))
        for n in range(4):  # two words in every batch, two thousand of its own
            texts = ["common words " + " ".join(f"once{n}x{k}" for k in range(m * 1000, m * 1000 + 1000)) for m in range(2)]
            ids, upto = encode(*utf8_buffers(pa.array(texts)))
            assert [ids[a:b].tolist() for a, b in zip(upto, upto[1:])] == encode.encode_whole(texts)
        assert len(encode.known) < 500 and sum(b"common" in piece for piece in encode.known) >= 1


def test_workers_get_small_batches_and_the_setting_comes_back(spark, monkeypatch):
    seen = []

    def told(df, name, **options):
        seen.append(int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")))
        return df

    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    monkeypatch.setattr(bm25_packing, "written", told)
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    encoded = bm25_packing.encode_documents(docs, public_tokenizers.path(WORD_BPE), 1, WORD_BPE_SIZE)
    bm25_packing.placed_documents(encoded, np.dtype("<u2"), np.zeros(WORD_BPE_SIZE), 1.0, np.ones(WORD_BPE_SIZE, bool))
    assert seen == [bm25_packing.BATCH_BYTES] * 2 and spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
