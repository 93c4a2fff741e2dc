"""What Python workers keep between tasks."""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa

from tidemark.llm.packing import Encoder, encoder, pack
from tidemark.llm.workers import with_package

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def test_forgotten_words_are_encoded_alike():
    texts = [b"A tidemark, and another one.", None, b"another tidemark"]
    own = Encoder(TOKENIZER)
    first = own.encode(texts)
    assert own.known
    own.forget()
    assert not own.known and not own.older
    assert own.encode(texts) == first


def test_a_packing_task_may_leave_no_words_in_its_worker(spark):
    with_package(spark)
    docs = spark.createDataFrame(
        [(k, f"words number {k} of some length") for k in range(40)], "doc_id long, text string"
    ).repartition(4)

    def held(remembered):
        def count(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict(
                    {"n": [len(encoder(TOKENIZER, remembered).known)] * batch.num_rows}
                )

        found = spark.range(0, 400, 1, 16).mapInArrow(count, "n long")
        return max(row.n for row in found.collect())

    kept = sorted(map(tuple, pack(docs, TOKENIZER, remembered=1001).collect()))
    assert held(1001) > 0
    freed = sorted(map(tuple, pack(docs, TOKENIZER, remembered=1002, forget=True).collect()))
    assert held(1002) == 0
    assert [row[:5] for row in freed] == [row[:5] for row in kept]
