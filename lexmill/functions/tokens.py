"""Token counts by an installed tokenizer library and a vocabulary file."""

from __future__ import annotations

import functools
import os

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def token_count(c: Column | str, path: str | None = None) -> Column:
    """Tokens of each text, 0 for null and empty ones; the vocabulary's path is a parameter."""
    file = path or os.path.join(os.environ.get("LEXMILL_TOKENIZERS", "/opt/tokenizers"), "byte_bpe_50k.json")

    @F.pandas_udf(T.IntegerType())
    def count(s: pd.Series) -> pd.Series:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        return pd.Series([len(x.ids) for x in _tokenizer(file).encode_batch([t or "" for t in s], add_special_tokens=False)], dtype="int32")

    return count(c)
