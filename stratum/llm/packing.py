"""Hierarchical packing of documents into token sequences of several lengths.

A document longer than the longest tier gives whole windows of that tier; what is left is routed to
the shortest tier that holds it. Each tier packs its pieces into windows of its own length, longest
piece first; a gap is filled with whole pieces of the same or a shorter tier, and only a gap that no
waiting piece fits is closed by cutting one, whose rest is routed again. So every window is full. What
is left when a task ends is cut at powers of two, which need no padding either. Full sequences of one
tier are dealt into step groups of equal token counts.

Packing runs inside each task over its own documents, with a bounded number of waiting tokens, so the
token ids are never shuffled; only piece rows are written.

Defined cases: a null text is an empty document, which is its end id alone; repeated rows are packed
each; a very long text gives many windows; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratum.llm.common import TMP, stored, text_or_empty
from stratum.llm.pretokens import BEYOND_FAST, FAST_WORDS, ByteMemo, added_tokens, byte_level

#: Window lengths; all but the longest one are powers of two, which are never padded.
TIERS = (2048, 1024, 512, 256)
#: Waiting tokens, in windows of the longest tier, at which a task packs.
WAITING_WINDOWS = 256
#: Tasks whose sequences are summed up together.
PARTS = 1000
#: Tokens of a step: as many sequences of a tier as make this many.
STEP_TOKENS = 1 << 16
#: Bytes of a generation of a worker's memos of strings and their ids (two generations each): those
#: between white space, and the words in them.
MEMO_BYTES, WORD_BYTES = 80 << 20, 24 << 20
#: Characters at which str.split() splits though the pattern has them as symbols.
SPLIT_ONLY = re.compile("[\x1c-\x1f]")


class WordIds:
    """Ids of a text as the library gives them for a lower-casing word vocabulary: special strings
    first, then each match of the split pattern merged. No match holds white space, so what stands
    between white space is encoded by itself; a worker remembers the frequent strings."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special, ids = added_tokens(path)
        self.special_ids = {s: array("I", [i]).tobytes() for s, i in ids.items()}
        self.words, self.chunks = ByteMemo(self.word, WORD_BYTES), ByteMemo(self.chunk, MEMO_BYTES)

    def word(self, word: str) -> bytes:
        return array("I", [t.id for t in self.tokenizer.model.tokenize(byte_level(word))]).tobytes()

    def chunk(self, chunk: str) -> bytes:
        return b"".join([self.words[w] if len(w) <= 64 else self.word(w)
                         for w in FAST_WORDS.findall(chunk)])

    def part(self, text: str) -> bytes:
        lower = text.lower()
        # some capitals below U+0250 have their small letter beyond it
        if BEYOND_FAST.search(lower) or BEYOND_FAST.search(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if SPLIT_ONLY.search(lower):
            return self.chunk(lower)
        get = self.chunks.__getitem__
        return b"".join([get(c) if len(c) <= 128 else self.chunk(c) for c in lower.split()])

    def __call__(self, text: str) -> bytes:
        if self.special is None or self.special.search(text) is None:
            return self.part(text)
        return b"".join(self.special_ids[p] if i % 2 else self.part(p)
                        for i, p in enumerate(self.special.split(text)))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


class Packer:
    """Packs pieces (document, start, ids as bytes, document's tokens) of one task."""

    def __init__(self, tiers: tuple[int, ...], waiting_windows: int):
        self.tiers, self.limit = sorted(tiers), waiting_windows * max(tiers)
        self.longest = self.tiers[-1]
        # per tier, pieces in order of length: parallel lists of lengths and pieces
        self.sizes: dict[int, list[int]] = {t: [] for t in self.tiers}
        self.pieces: dict[int, list[tuple]] = {t: [] for t in self.tiers}
        self.waiting = 0
        self.sequences = dict.fromkeys(self.tiers, 0)
        self.made = 0
        self.rows: list[tuple] = []

    def add(self, doc, ids: bytes) -> None:
        n = len(ids) // 4
        start = 0
        while n - start >= self.longest:
            self.close([(doc, start, ids[4 * start:4 * (start + self.longest)], n)], self.longest)
            start += self.longest
        if n > start:
            self.route((doc, start, ids[4 * start:], n))
        if self.waiting >= self.limit:
            self.pack(self.longest)

    def route(self, piece: tuple) -> None:
        n = len(piece[2]) // 4
        tier = self.tiers[bisect.bisect_left(self.tiers, n)]
        at = bisect.bisect_right(self.sizes[tier], n)
        self.sizes[tier].insert(at, n)
        self.pieces[tier].insert(at, piece)
        self.waiting += n

    def take(self, tier: int, at: int) -> tuple:
        self.waiting -= self.sizes[tier].pop(at)
        return self.pieces[tier].pop(at)

    def fitting(self, gap: int, most: int) -> tuple | None:
        """The longest waiting piece of at most ``gap`` tokens, from tier ``most`` or a shorter one."""
        for tier in reversed([t for t in self.tiers if t <= most]):
            if at := bisect.bisect_right(self.sizes[tier], gap):
                return self.take(tier, at - 1)
        return None

    def window(self, tier: int, first: tuple) -> None:
        """Fill one window of a tier, the gap from shorter tiers, cutting a piece at last."""
        parts, gap = [first], tier - len(first[2]) // 4
        while gap:
            piece = self.fitting(gap, tier)
            if piece is None:
                donor = next((t for t in self.tiers if t <= tier and self.sizes[t]), None)
                if donor is None:
                    return self.end(parts)
                doc, start, ids, n = self.take(donor, 0)
                piece = (doc, start, ids[:4 * gap], n)
                self.route((doc, start + gap, ids[4 * gap:], n))
            parts.append(piece)
            gap -= len(piece[2]) // 4
        self.close(parts, tier)

    def pack(self, keep: int) -> None:
        """Pack the tiers, longest first, until at most ``keep`` tokens wait."""
        for tier in reversed(self.tiers):
            while self.sizes[tier] and self.waiting > keep:
                self.window(tier, self.take(tier, -1))

    def end(self, parts: list[tuple]) -> None:
        """Cut the pieces of a window that can't be filled at powers of two, the longest first."""
        left = sum(len(p[2]) // 4 for p in parts)
        while left:
            size, own, gap = 1 << (left.bit_length() - 1), [], 1 << (left.bit_length() - 1)
            while gap:
                doc, start, ids, n = parts.pop(0)
                own.append((doc, start, ids[:4 * gap], n))
                if len(ids) > 4 * gap:
                    parts.insert(0, (doc, start + gap, ids[4 * gap:], n))
                gap -= len(own[-1][2]) // 4
            self.close(own, size)
            left -= size

    def close(self, parts: list[tuple], size: int) -> None:
        number = self.sequences.get(size, 0)
        self.sequences[size] = number + 1
        offset = 0
        for doc, start, ids, n in parts:
            length = len(ids) // 4
            self.rows.append((doc, start, length, zlib.crc32(ids), n, self.made, offset, size, number))
            offset += length
        self.made += 1


def _pieces(docs: DataFrame, path: str, end_id: int, tiers: tuple[int, ...], id_col: str,
            text_col: str) -> DataFrame:
    id_type = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence", "offset", "tier", "number"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        ids, packer = word_ids(path), Packer(tiers, WAITING_WINDOWS)
        last = array("I", [end_id]).tobytes()

        def made() -> pd.DataFrame:
            rows, packer.rows = packer.rows, []
            return pd.DataFrame(rows, columns=names).assign(part=part)

        for b in batches:
            # ids stay Python objects: a null id must not turn the others into floats
            for doc, text in zip(b[id_col].astype(object).where(b[id_col].notna(), None), b[TMP + "text"]):
                packer.add(doc, ids(text) + last)
                if len(packer.rows) >= 50_000:
                    yield made()
            yield made()
        packer.pack(0)
        yield made()

    schema = f"`{id_col}` {id_type}, start long, length long, ids_crc32 long, doc_tokens long, " \
             "sequence long, offset long, tier int, number long, part long"
    return docs.select(id_col, text_or_empty(text_col).alias(TMP + "text")).mapInPandas(run, schema)


def pack(docs: DataFrame, path: str, end_id: int = 1, tiers: tuple[int, ...] = TIERS,
         step_tokens: int = STEP_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: the id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier
    (the sequence's length) and step_group.

    Sequences of a tier are numbered through all tasks and dealt, in that order, into steps of
    ``step_tokens``, so that steps of a tier hold equally many tokens.
    """
    if any(t & (t - 1) for t in tiers if t != max(tiers)):
        raise ValueError("tiers below the longest one must be powers of two")
    pieces = stored(_pieces(docs, path, end_id, tuple(tiers), id_col, text_col), "packed")
    # one row per task and sequence length; running sums over blocks of tasks, then within a block
    made = pieces.groupBy("tier", "part").agg((F.max("number") + 1).alias("made")) \
        .withColumn("block", F.floor(F.col("part") / F.lit(PARTS)))
    before = lambda *by: F.coalesce(F.sum("made").over(
        Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = made.groupBy("tier", "block").agg(F.sum("made").alias("made")) \
        .select("tier", "block", before("tier", "block").alias("blocks_before"))
    before = made.withColumn("before", before("tier", "block", "part")).join(blocks, ["tier", "block"]) \
        .select("tier", "part", (F.col("before") + F.col("blocks_before")).alias("before"))
    per_step = F.greatest(F.lit(1), F.floor(F.lit(step_tokens) / F.col("tier")))
    return pieces.join(before, ["tier", "part"]).select(
        id_col, "start", "length", "ids_crc32", "doc_tokens",
        # tasks number their own sequences; 2^40 of them would be a petabyte of tokens
        (F.col("part") * F.lit(1 << 40) + F.col("sequence")).alias("sequence_id"), "offset", "tier",
        F.floor((F.col("before") + F.col("number")) / per_step).alias("step_group"))
