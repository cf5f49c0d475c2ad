"""Token counts: an exact histogram of encoded lengths, and what it answers for every context limit."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranks of a public byte-level BPE, and the pattern that cuts a text before merging.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value

#: What the pattern's \s stands for, and the length of a run of it that the pattern is kept from: it recurses there.
SPACE, LONG_RUN = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000", 1000
_LONG = re.compile(f"[{SPACE}]{{{LONG_RUN},}}")


@lru_cache(maxsize=2)
def encoding(lines: bytes):
    """The tokenizer of the lines of a file of ranks, once a process."""
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines())}
    return tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(encoder, text: str) -> int:
    """Number of tokens of text, as the pattern cuts it.

    Of white space before other text the pattern takes all but the last character as one piece, and all of it at the
    end of a text; long runs are cut out as that piece, so that texts of any length can be encoded.
    """
    at = n = 0
    for run in _LONG.finditer(text):
        stop = run.end() - (run.end() < len(text))
        n += len(encoder.encode_ordinary(text[at : run.start()])) + len(encoder._encode_single_piece(text[run.start() : stop].encode()))
        at = stop
    return n + len(encoder.encode_ordinary(text[at:]))


def encoded_length(text: Column, path: str = RANKS) -> Column:
    """Number of tokens of the whole text; 0 for null and empty texts. Special tokens' strings are ordinary text.

    Texts may be of any length, also a single run of white space or letters; equal texts count once each.
    """
    lines = Path(path).read_bytes()  # in the driver: executors need no file

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = encoding(lines)
        for texts in batches:
            yield pd.Series([token_count(encoder, t) if t else 0 for t in texts], dtype="int64")

    return count(text)


def length_histogram(docs: DataFrame, text: str = "text", path: str = RANKS) -> DataFrame:
    """n_tokens, n_docs: how many documents have each encoded length. Null texts have length 0."""
    return docs.select(encoded_length(F.col(text), path).alias("n_tokens")).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def context_limits(histogram: DataFrame) -> DataFrame:
    """For each length L that occurs, taken as a context limit: what a corpus cut at L holds.

    n_tokens (L), n_docs of just that length, docs_over and tokens_over (longer documents and all their tokens),
    docs_within, truncated_tokens (sum of min(length, L)), lost_tokens (what the cut drops), share_within (documents
    of at most L, a quantile function). Suffix and prefix sums over one row a length; a limit between two lengths has
    the lower one's sums, plus docs_over for each token that it exceeds that length. Empty input: no rows.
    """
    up, down = Window.orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0), Window.orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    own = F.col("n_tokens") * F.col("n_docs")
    sums = histogram.withColumn("docs_over", F.coalesce(F.sum("n_docs").over(down), F.lit(0))).withColumn("tokens_over", F.coalesce(F.sum(own).over(down), F.lit(0)))
    sums = sums.withColumn("docs_within", F.sum("n_docs").over(up)).withColumn("__within", F.sum(own).over(up))
    return sums.select(
        "n_tokens",
        "n_docs",
        "docs_within",
        "docs_over",
        "tokens_over",
        (F.col("__within") + F.col("n_tokens") * F.col("docs_over")).alias("truncated_tokens"),
        (F.col("tokens_over") - F.col("n_tokens") * F.col("docs_over")).alias("lost_tokens"),
        (F.col("docs_within") / (F.col("docs_within") + F.col("docs_over"))).alias("share_within"),
    )
