"""A user's batch function gets texts by bytes, not by rows."""

import pandas as pd
from pyspark.sql import functions as F

from voxgauge.functions import batch


def test_long_texts_come_in_pieces(spark):
    rows = [(i, None if i % 10 == 3 else "x" * (i % 7) + "y" * 20_000) for i in range(300)]
    rows.append((300, "z" * (3 * batch.PIECE_BYTES)))

    def measure(batches):
        for texts in batches:
            most = texts.str.len().sum()
            yield pd.Series([None if t is None else [str(len(t)), str(int(most)), str(len(texts))] for t in texts])

    texts = spark.createDataFrame(rows, "i int, t string").coalesce(1)
    got = texts.select("i", batch.batch_udf(measure, "array<string>")("t").alias("v")).collect()
    assert [r.i for r in got] == [i for i, _ in rows]
    assert all((r.v is None) == (t is None) for r, (_, t) in zip(got, rows))
    found = [[int(x) for x in r.v] for r in got if r.v is not None]
    assert [v[0] for v in found] == [len(t) for _, t in rows if t is not None]
    assert all(v[1] <= 2 * batch.PIECE_BYTES or v[2] == 1 for v in found)
    empty = texts.where(F.col("i") < 0).select(batch.batch_udf(measure, "array<string>")("t"))
    assert empty.count() == 0
