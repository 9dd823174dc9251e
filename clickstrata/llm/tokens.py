"""Token counts without token ids.

A tokenizer first cuts a text into pre-tokens, and no piece crosses from one into the next.
Each text is reduced to the frequencies of its distinct pre-tokens. Each distinct pre-token is
encoded once for its number of pieces; frequencies and numbers are joined and summed. Both live
in the task that reads the texts: the distinct pre-tokens of a batch are looked up in the
worker's table of counts and only those that it lacks are encoded. Nothing is shuffled, and the
table is emptied when it holds more than a set number of entries.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstrata.llm.common import REMEMBERED_WORDS

#: The vocabulary file, by its name in the installed package of public tokenizers.
TOKENIZER = "word_bpe_49k.json"

#: Longest text, in tokens, that does not count as over the limit.
LIMIT = 2048

#: What ``str.split`` takes for white space although the tokenizer does not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SPACE = re.compile("[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def pre_tokens(text: str) -> list[str]:
    """Runs without white space. The tokenizer drops white space, so pieces never cross it."""
    return _SPACE.findall(text) if _SEPARATORS.search(text) else text.split()


class PieceCounts(dict):
    """Number of pieces of pre-tokens, by the tokenizer itself."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def learn(self, tokens: set[str]) -> None:
        """Encode the pre-tokens that are not known yet, each once."""
        if len(self) > REMEMBERED_WORDS:
            self.clear()
        new = [t for t in tokens if t not in self]
        for at in range(0, len(new), 4096):
            block = new[at : at + 4096]
            encoded = self.tokenizer.encode_batch(block, add_special_tokens=False)
            self.update(zip(block, map(len, encoded), strict=True))

    def total(self, frequencies: Counter) -> int:
        return sum(self[t] * n for t, n in frequencies.items())


@lru_cache(maxsize=2)
def piece_counts(name: str) -> PieceCounts:
    """One table of counts per worker. ``name``: a path, or a name in the public package."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
    if os.path.sep not in name:
        import public_tokenizers

        name = public_tokenizers.path(name)
    return PieceCounts(name)


def token_count(text: Column, tokenizer: str = TOKENIZER) -> Column:
    """Number of tokens of a text, without added special tokens; 0 for null and empty."""

    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        counts, totals = piece_counts(tokenizer), []
        for at in range(0, len(texts), 64):
            block = [Counter(pre_tokens(t.as_py() or "")) for t in texts[at : at + 64]]
            counts.learn(set().union(*block))
            totals += map(counts.total, block)
        return pa.array(totals, pa.int64())

    return count(text)


def count_tokens(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: its id, bytes of UTF-8, tokens, and whether over ``limit``.

    Null texts count as empty: no bytes, no tokens. Repeated rows are counted each; an empty
    table gives an empty result; other columns are ignored. The whole text counts: nothing is
    truncated or padded.
    """
    counted = docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        token_count(F.col("text"), tokenizer).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
