"""A worker that has no more texts to encode does not keep its codec."""

import time

import pyarrow as pa

from demandgrid.llm import bpe


class Shared:
    value = ("key", {bytes([k]): k for k in range(256)} | {b"ab": 256}, r"\S+|\s+")


def ran(spark, n):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    batch = pa.table({"doc_id": [1], "text": ["a b"]}).to_batches()[0]
    made = []

    def work(texts):
        made.append(bpe._codec(Shared()))
        return [pa.array([len(t) for t in texts.to_pylist()], pa.int64())]

    class Docs:
        schema, columns = docs.schema, docs.columns

        @staticmethod
        def mapInArrow(run, schema):  # noqa: N802
            return list(run(iter([batch] * n)))

    bpe._added(Docs, [("n", bpe.T.LongType())], work, "text")
    return made


def test_codec_goes_after_rest_and_is_kept_between_batches(spark, monkeypatch):
    monkeypatch.setattr(bpe, "IDLE", 0.5)
    bpe._codecs.clear()
    made = ran(spark, 3)
    assert made[0] is made[1] is made[2]
    assert list(bpe._codecs) == ["key"]
    end = time.time() + 20
    while bpe._codecs and time.time() < end:
        time.sleep(0.05)
    assert not bpe._codecs
    assert ran(spark, 1)[0] is not made[0]
