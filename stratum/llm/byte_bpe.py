"""Byte-level BPE encoding and decoding by monoid tree reduction.

A text is encoded by halves, down to leaves of some thousand characters that the library encodes, and
neighbours are joined by re-encoding a window around their border. The window grows on both sides to
the nearest seam, a white space after a non-space: no match of the split pattern crosses a seam, and
what matches after it depends on nothing before it, so the tokens outside are proven final.

Where the window becomes long (text without seams), its matches are encoded one by one, long ones again
by halves, now of bytes. There the window grows token by token until it is stable: a token sequence
is the encoding of its bytes if and only if each adjacent pair of tokens, taken alone, encodes to itself.
(In merging by rank, the first merge across a token border would also happen in the pair alone.) So
when the pairs at both edges of the window encode to themselves, no token outside can change.

Decoding concatenates the tokens' bytes up the tree.

Defined cases: a null text is empty (0 tokens); repeated rows give repeated rows; a text of any length
or one unbroken run is encoded whole; extra columns don't matter.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import TMP, text_or_empty
from stratum.llm.pretokens import ANY_SPACE, whole_pattern

#: Characters of a text leaf and of the longest window that the library re-encodes; bytes of a piece leaf.
TEXT_LEAF, WINDOW, PIECE_LEAF = 4096, 8192, 64
SEAM = re.compile(f"(?<=[^{ANY_SPACE}])[{ANY_SPACE}]")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f) if token}


class TreeBpe:
    """Encoder and decoder over rank-merged byte strings."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self.strings = {i: t for t, i in ranks.items()}
        self.library = tiktoken.Encoding("tree", pat_str=pattern, mergeable_ranks=ranks,
                                         special_tokens={})
        self.stable = lru_cache(maxsize=200_000)(self._stable)

    def merged(self, raw: bytes) -> list[int]:
        """Leaf: merge the adjacent pair of lowest rank, leftmost first, until none is left."""
        ranks = self.ranks
        parts = [raw[i:i + 1] for i in range(len(raw))]
        pairs = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = min((r for r in pairs if r is not None), default=None)
            if best is None:
                break
            i = pairs.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1])
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i])
        return [ranks[p] for p in parts]

    def _stable(self, left: int, right: int) -> bool:
        return self.merged(self.strings[left] + self.strings[right]) == [left, right]

    def raw(self, ids) -> bytes:
        return b"".join(map(self.strings.__getitem__, ids))

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """The monoid's operation: the encoding of both byte strings together."""
        if not left or not right:
            return left or right
        width = 1
        while True:
            a, b = max(0, len(left) - width), min(len(right), width)
            window = self.merged(self.raw(left[a:]) + self.raw(right[:b]))
            if (a == 0 or self.stable(left[a - 1], window[0])) and \
                    (b == len(right) or self.stable(window[-1], right[b])):
                return left[:a] + window + right[b:]
            width *= 2

    def encoded(self, raw: bytes) -> list[int]:
        """The tree: halves above the leaf size, joined."""
        if len(raw) <= PIECE_LEAF:
            return self.merged(raw)
        mid = len(raw) // 2
        return self.joined(self.encoded(raw[:mid]), self.encoded(raw[mid:]))

    def run(self, text: str) -> list[int]:
        """Ids of a text without seams nearby: each match by itself, through the tree over bytes."""
        ids: list[int] = []
        for piece in whole_pattern(self.pattern).findall(text):
            raw = piece.encode("utf-8")
            one = self.ranks.get(raw)
            ids += [one] if one is not None else self.encoded(raw)
        return ids

    def leaf(self, text: str) -> list[int]:
        return self.library.encode_ordinary(text) if len(text) <= WINDOW else self.run(text)

    def tail(self, ids: list[int], n_bytes: int) -> int:
        """How many last tokens make up exactly the last ``n_bytes`` bytes."""
        k = 0
        while n_bytes > 0:
            k += 1
            n_bytes -= len(self.strings[ids[-k]])
        return k

    def head(self, ids: list[int], n_bytes: int) -> int:
        k = 0
        while n_bytes > 0:
            n_bytes -= len(self.strings[ids[k]])
            k += 1
        return k

    def encode(self, text: str, start: int = 0, end: int | None = None) -> list[int]:
        """Ids of ``text[start:end]``."""
        end = len(text) if end is None else end
        if end - start <= TEXT_LEAF:
            return self.library.encode_ordinary(text[start:end])
        mid = (start + end) // 2
        if SEAM.match(text, mid):  # matches never run over a seam: nothing has to be encoded again
            return self.encode(text, start, mid) + self.encode(text, mid, end)
        width = 64
        while True:  # grow the window to a seam on each side, or to the half's other end
            low, high = max(start, mid - width), min(end, mid + width)
            seams = [m.start() for m in SEAM.finditer(text, low, mid)]
            a = seams[-1] if seams else start if low == start else None
            after = SEAM.search(text, mid, high)
            b = after.start() if after else end if high == end else None
            if a is not None and b is not None:
                break
            width *= 4
        if a == start and b == end:
            return self.leaf(text[start:end])
        left, right = self.encode(text, start, mid), self.encode(text, mid, end)
        cut = len(left) - self.tail(left, len(text[a:mid].encode("utf-8")))
        rest = self.head(right, len(text[mid:b].encode("utf-8")))
        return left[:cut] + self.leaf(text[a:b]) + right[rest:]

    def decode(self, ids) -> bytes:
        if len(ids) <= 4096:
            return self.raw(ids)
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


@lru_cache(maxsize=2)
def tree_bpe(path: str, pattern: str) -> TreeBpe:
    return TreeBpe(load_ranks(path), pattern)


def encode_decode(docs: DataFrame, path: str, pattern: str, with_ids: bool = False,
                  text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: the id, n_tokens, ids_sha256, decoded_sha256 (the ids decoded again), and with
    ``with_ids`` the ids themselves as an array. No shuffle; one pass over the text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = tree_bpe(path, pattern)
        for b in batches:
            rows = []
            for text in b[TMP + "text"]:
                ids = bpe.encode(text)
                packed = array("I", ids).tobytes()
                row = (len(ids), hashlib.sha256(packed).hexdigest(),
                       hashlib.sha256(bpe.decode(ids)).hexdigest())
                rows.append((*row, ids) if with_ids else row)
            names = ["n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]
            yield pd.concat([b[[id_col]], pd.DataFrame(rows, columns=names, index=b.index)], axis=1)

    schema = f"`{id_col}` {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" \
        + ", ids array<long>" * with_ids
    return docs.select(id_col, text_or_empty(text_col).alias(TMP + "text")).mapInPandas(run, schema)


def decode_ids(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids",
               id_col: str = "doc_id") -> DataFrame:
    """Texts of rows of ids (null: empty), the inverse of ``encode_decode(with_ids=True)``."""
    id_type = encoded.schema[id_col].dataType.simpleString()

    def run(batches):
        bpe = tree_bpe(path, pattern)
        for b in batches:
            b["text"] = [bpe.decode([int(i) for i in ids]).decode("utf-8", "replace")
                         for ids in b.pop(ids_col)]
            yield b

    return encoded.select(id_col, F.coalesce(ids_col, F.array().cast("array<long>")).alias(ids_col)) \
        .mapInPandas(run, f"`{id_col}` {id_type}, text string")
