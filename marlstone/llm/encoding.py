"""Token ids of a whole corpus by a public vocabulary file.

Every row gets its ids: of its whole text, without special tokens; strings that
look like special tokens are ordinary text. Null and empty texts get an
empty list. Repeated rows stay repeated, a null key is kept, and only the named
columns come out. A batch goes back whenever its ids fill it, so long texts need no more memory.
"""

from __future__ import annotations

import os
import pickle
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from marlstone.llm.vocabulary import Encoder, read_ranks
from marlstone.session import spread

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Ids in one batch that goes back to the JVM.
BATCH_IDS = 1 << 20


@lru_cache(maxsize=2)
def _encoder(path: str, _version: int) -> bytes:
    return cloudpickle.dumps(Encoder(read_ranks(path)))


def encode_corpus(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids) for each row. The file at `vocabulary` is read by the driver only."""
    # bounded by the vocabulary; by value, so that workers need no copy of this package
    shipped = df.sparkSession.sparkContext.broadcast(_encoder(vocabulary, os.stat(vocabulary).st_mtime_ns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = pickle.loads(shipped.value).encode
        for batch in batches:
            keys, at, ids, offsets = batch.column(0), 0, [], [0]
            for i, t in enumerate(batch.column(1)):
                ids.append(encode(t.as_py()))
                offsets.append(offsets[-1] + len(ids[-1]))
                if offsets[-1] >= BATCH_IDS or i + 1 == batch.num_rows:
                    flat = np.concatenate([np.asarray(x, dtype=np.int32) for x in ids])
                    lists = pa.ListArray.from_arrays(pa.array(np.array(offsets, dtype=np.int32)), pa.array(flat))
                    yield pa.RecordBatch.from_arrays([keys.slice(at, i + 1 - at), lists], [key, "ids"])
                    at, ids, offsets = i + 1, [], [0]

    if key == "ids":
        raise ValueError("ids is the name of the result")
    kind = dict(df.dtypes)[key]
    return spread(df.select(key, text)).mapInArrow(run, f"`{key}` {kind}, ids array<int>")
