"""Tokenize and count words.

``explode`` is the table-valued flatMap; the count is a hash aggregate with a
map-side partial step, so a very frequent word is pre-counted in every task
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import java_split_space, text_lines


def tokens(texts: DataFrame, text: str = "text", by_lines: bool = True) -> DataFrame:
    """One row per token with the count 1 ("(word, 1)")."""
    lines = (texts.select(F.explode(text_lines(text)).alias("line")) if by_lines
             else texts.select(F.col(text).alias("line")))
    return lines.select(F.explode(java_split_space("line")).alias("word"), F.lit(1).alias("one"))


def word_count(texts: DataFrame, text: str = "text", by_lines: bool = True) -> DataFrame:
    """A1: (word, n) over whole texts."""
    return tokens(texts, text, by_lines).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
