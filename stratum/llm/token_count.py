"""Token counts with a whole-token shortcut.

Offline, every vocabulary string is encoded alone; those that come back as exactly one token are
"whole". A text is split into pre-tokens; a whole pre-token counts 1 without any merge, and only the
rest goes through the merges. A worker remembers the counts of the frequent strings between spaces.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); repeated rows give repeated rows;
special strings inside a text count one token each, as the library's default has it; extra columns
don't matter, as only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import TMP, text_or_empty
from stratum.llm.pretokens import (
    BEYOND_FAST, FAST, SPACE_RUN, ByteMemo, added_tokens, byte_letters, byte_level)

#: Bytes of a generation of a worker's memos (two generations each) of the counts of strings between spaces,
#: and of pre-tokens.
MEMO_BYTES, PIECE_BYTES = 40 << 20, 16 << 20


def whole_tokens(tokenizer) -> list[str]:
    """The vocabulary strings that, encoded alone, are one pre-token and come out as one token.

    The proof is by doing it: each string that is valid UTF-8 is encoded as a text of its own.
    """
    back = {c: b for b, c in enumerate(byte_letters())}
    texts, ids = [], []
    for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
        try:
            texts.append(bytes(back[c] for c in token).decode("utf-8"))
            ids.append(i)
        except (KeyError, UnicodeDecodeError):
            continue  # not a byte-level string, or half of a character
    found = tokenizer.encode_batch(texts, add_special_tokens=False)
    return [t for t, i, e in zip(texts, ids, found) if e.ids == [i]]


class Counter:
    """Counts of whole texts. A match of the split pattern never runs from a non-space over a white
    space, so what stands between spaces (with the space before it) is counted by itself."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special, _ = added_tokens(path)
        self.whole = set(whole_tokens(self.tokenizer))
        self.merged = ByteMemo(self.merge, PIECE_BYTES)
        self.spaced = ByteMemo(lambda chunk: self.split_count(" " + chunk), MEMO_BYTES)

    def merge(self, piece: str) -> int:
        return len(self.tokenizer.model.tokenize(byte_level(piece)))

    def pretoken(self, piece: str) -> int:
        return 1 if piece in self.whole else \
            self.merged[piece] if len(piece) <= 64 else self.merge(piece)

    def split_count(self, text: str) -> int:
        return sum(map(self.pretoken, FAST.findall(text)))

    def part(self, text: str) -> int:
        if BEYOND_FAST.search(text):
            found = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
            return sum(self.pretoken(text[a:b]) for _, (a, b) in found)
        if SPACE_RUN.search(text):
            return self.split_count(text)
        first, *rest = text.split(" ")
        get = self.spaced.__getitem__
        return self.split_count(first) + sum(
            [get(c) if len(c) <= 128 else self.split_count(" " + c) for c in rest])

    def __call__(self, text: str) -> int:
        if self.special is None or self.special.search(text) is None:
            return self.part(text)
        parts = self.special.split(text)  # odd entries are the special strings
        return len(parts) // 2 + sum(map(self.part, parts[::2]))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str, limit: int = 1024, text_col: str = "text",
                 id_col: str = "doc_id") -> DataFrame:
    """Per row: the id, n_bytes, n_tokens, over_limit. No shuffle; one pass over the text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = counter(path)
        for b in batches:
            n = [tokens(t) for t in b.pop(TMP + "text")]
            yield b.assign(n_tokens=n)

    out = docs.select(id_col, F.octet_length(text_or_empty(text_col)).cast("long").alias("n_bytes"),
                      text_or_empty(text_col).alias(TMP + "text"))
    out = out.mapInPandas(count, f"`{id_col}` {id_type}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
