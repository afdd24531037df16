"""A user's batch function as a column function."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

BatchFunction = Callable[[Iterator[pd.Series]], Iterator[pd.Series]]

#: Bytes of texts (one text at least) that a batch function gets at once, however large Spark's batches are.
PIECE_BYTES = 1 << 20

_ARROW = {"int": pa.int32(), "string": pa.string(), "array<float>": pa.list_(pa.float32()), "array<string>": pa.list_(pa.string())}


def text_pieces(texts: pa.Array) -> list[pa.Array]:
    """``texts`` in order, cut where PIECE_BYTES are full; no texts are one empty piece."""
    n = max(1, min(len(texts), -(-texts.nbytes // PIECE_BYTES)))
    edges = np.linspace(0, len(texts), n + 1).astype(int).tolist()
    parts = [texts.slice(lo, hi - lo) for lo, hi in zip(edges, edges[1:])]
    return [x for p in parts for x in (text_pieces(p) if len(p) > 1 and p.nbytes > 2 * PIECE_BYTES else [p])]


def batch_udf(fn: BatchFunction, return_type: str):
    """``fn`` maps an iterator of batches to one of results, so that it can load a model before its loop."""
    arrow = _ARROW[return_type]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sizes: deque[list[int]] = deque()  # rows of the pieces of each batch that is not answered yet

        def pieces() -> Iterator[pd.Series]:
            for batch in batches:
                parts = text_pieces(batch)
                sizes.append([len(p) for p in parts])
                yield from (p.to_pandas() for p in parts)

        held: list[pa.Array] = []
        for result in fn(pieces()):
            # series such as Int32 convert themselves, with their nulls
            mask = None if isinstance(result.dtype, pd.api.extensions.ExtensionDtype) else result.isnull()
            held.append(pa.Array.from_pandas(result, mask=mask, type=arrow))
            if len(held[-1]) != sizes[0][len(held) - 1]:
                raise ValueError(f"{sizes[0][len(held) - 1]} texts gave {len(held[-1])} results")
            if len(held) == len(sizes[0]):
                yield pa.concat_arrays(held)
                held = []
                sizes.popleft()

    return F.arrow_udf(run, return_type)
