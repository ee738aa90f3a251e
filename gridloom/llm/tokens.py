"""Token counts by a public tokenizer, whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.session import spread

#: Vocabulary as ranks: lines of base64 bytes and rank. It must be there on every executor.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern by which this vocabulary's tokenizer cuts text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoding(vocabulary: str) -> tiktoken.Encoding:
    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(vocabulary, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, columns: tuple[str, ...] = (), vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, text_hash, n_tokens, *columns): the whole text's tokens, Arrow batch by batch; a null text has 0.

    Rows delivered again, equal in doc_id, text and `columns`, count once; what is shuffled for that is the hash of a text,
    not the text.
    """
    kept = ["doc_id", *columns]
    rows = documents.select(*kept, F.xxhash64("text").alias("text_hash"), "text")
    schema = rows.drop("text").schema.add("n_tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(vocabulary).encode_ordinary
        for b in batches:
            texts = b.column(b.num_columns - 1)
            n = pa.array([len(encode(t)) if (t := s.as_py()) else 0 for s in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], n], names=[*b.schema.names[:-1], "n_tokens"])

    return spread(rows).mapInArrow(run, schema).distinct()
