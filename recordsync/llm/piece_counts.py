"""Token counts of a sentencepiece vocabulary, once per distinct pre-token (operator 4).

A BPE merge never joins characters that no piece has side by side.  So a text
can be cut wherever two neighbours occur in no piece of the vocabulary, and
its count is the sum of the parts' counts: between a character and the spaces
that follow it, around a newline, and between an ASCII letter and an ASCII
punctuation mark.  Each cut is proved against the vocabulary when it is loaded;
one that a piece spans is not made.  Each text is cut once into its distinct parts
(pre-tokens) and their frequencies; each distinct one of the corpus is counted
once by the library, and documents sum frequency times count over their
pre-tokens without materialising ids.

Defined cases: a null or empty text has 0 tokens; repeated rows get equal
counts; an empty table gives no rows; a very long text without spaces is one
pre-token, which is joined by its hash; columns with the names of new
ones are replaced.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import token_sums
from .common import read, written

MODEL = "piece_bpe_32k.model"
LIMIT = 4096

_SPACE = " ▁"  # the library writes a space as the second of these
_LETTER = "A-Za-z"
_MARK = r"!-/:-@\[-`{-~"


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(2)
def _library(name: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_path(name))


def piece_neighbours(name: str) -> set[tuple[str, str]]:
    """Pairs of neighbouring characters inside the pieces that text can turn into."""
    lib = _library(name)
    pieces = [lib.id_to_piece(i) for i in range(lib.get_piece_size())
              if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))]
    return {pair for p in pieces for pair in zip(p, p[1:])}


@functools.lru_cache(2)
def pretoken_pattern(name: str = MODEL) -> str:
    """Regular expression of the pre-tokens; raises if the vocabulary spans words or lines."""
    pairs = piece_neighbours(name)
    if any("\n" in pair for pair in pairs) or any(b == _SPACE[1] != a for a, b in pairs):
        raise ValueError(f"{name}: a piece spans a newline or the start of a space; texts can't be cut there")
    lib = _library(name)
    if lib.normalize(" a  \t Aﬁ ") != "▁▁a▁▁\t Aﬁ▁":
        raise ValueError(f"{name}: its normalizer rewrites texts; they can't be cut before it")

    def mark(c: str) -> bool:
        return c.isascii() and c.isprintable() and not c.isalnum() and c != " "

    def letter(c: str) -> bool:
        return c.isascii() and c.isalpha()
    if any(letter(a) and mark(b) or mark(a) and letter(b) for a, b in pairs):
        return f"[{_SPACE}]*[^{_SPACE}\n]+|[{_SPACE}]+|\n"
    other = f"[^{_SPACE}\n{_LETTER}{_MARK}]+"
    run = f"(?:[{_LETTER}]+|[{_MARK}]+)"
    return f"[{_SPACE}]*(?:{run}(?:{other}{run}?)*|(?:{other}{run}?)+)|[{_SPACE}]+|\n"


def _count_pieces(name: str):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lib = _library(name)
        alone = len(lib.encode("\n"))  # a newline before the part keeps the library from adding a space
        for rows in batches:
            ids = lib.encode(["\n" + t for t in rows.token], num_threads=1)
            yield rows.assign(n_tokens=[len(x) - alone for x in ids])
    return count


def count_tokens(docs: DataFrame, text: str = "text", name: str = MODEL, limit: int = LIMIT,
                 keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all, if None) with n_bytes, n_tokens and over_limit."""
    made = ["n_bytes", "n_tokens", "over_limit"]
    kept = [f"`{c}`" for c in (docs.columns if keep is None else keep) if c.lower() not in made]
    body = F.col(f"`{text}`")
    listed = docs.select(*kept, F.coalesce(F.octet_length(body), F.lit(0)).cast("long").alias("n_bytes"), body.alias("__text"),
                         F.monotonically_increasing_id().alias("__row"))
    pattern = pretoken_pattern(name)

    def tokens_of() -> Callable[[str], list[str]]:
        find = re.compile(pattern).findall
        return lambda body: find(" " + body)  # the library puts one space before a text that isn't empty

    parts = token_sums.cut(listed, tokens_of)
    freqs = token_sums.each(parts).groupBy("token").agg(F.sum("times").alias("freq"))
    values = written(freqs.mapInPandas(_count_pieces(name), "token string, freq long, n_tokens long"))
    counts = token_sums.sums(parts, values, ["n_tokens"], token_sums.HEAD).withColumnRenamed("n_tokens", "__n")
    n = F.coalesce("__n", F.lit(0)).cast("long")
    return parts.join(counts, "__row", "left").select(*kept, "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))


def op4_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
