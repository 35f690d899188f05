"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

Words are runs of digits, letters and characters beyond ASCII, A-Z lower-cased. Each item gives its
windows of some consecutive words (an item of fewer words is one window). A window is the set of its
shingles; a document holds the window only if it holds all of them, so of the shingles in order of their
rarity in the documents the first alone is the necessary prefix. The passes over the documents are two:

1. the occurrences of the items' shingles are counted, in each task and then by Spark;
2. the shingles of a document are joined with the windows' prefix shingles. A match at a place of the
   document puts the window's beginning at one place (positional bound); the window must end inside the
   document (length bound), and the words there must be the window's words, compared one by one.

The item side is sent to the tasks in blocks of a bounded number of words; more items make more blocks,
each of which goes over all documents, and a document's findings are joined from block to block. So no
text is shuffled, and no key can be hot.

Defined cases: a null or empty text has no words and is never hit; an item with a null id or without
words takes no part; items of one id count once; repeated documents are judged each; very long items
are cut into overlapping parts that hold the same windows; empty tables give no rows or no hits; extra
columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import TMP, dropped, stored

#: Words of a window; words of a shingle.
WINDOW, SHINGLE = 10, 3
#: Words of the items that one block holds (a word's number must fit 21 bits: three make a shingle's key).
BLOCK_WORDS = 500_000
#: Words of an item that are handled as one part.
PART_WORDS = 50_000
#: Candidates that are verified at a time.
CANDIDATES = 1 << 16

#: Word bytes stay, A-Z lower-cased (every byte from 0x80 on belongs to a word character); others part words.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def _parts(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(item, part, words, n): the items cut so that every window lies in a part."""
    step = max(1, PART_WORDS - window + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for item, text in zip(b.column(0), b.column(1)):
                words = words_of(text.as_py())
                for at in range(0, max(1, len(words) - window + 1), step) if words else ():
                    part = words[at:at + step + window - 1]
                    out.append((item.as_py(), at, b" ".join(part), len(part)))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("item", "part", "words", "n"), o)) for o in out],
                pa.schema([("item", pa.string()), ("part", pa.int64()), ("words", pa.binary()), ("n", pa.int64())]))

    return items.filter(F.col(id_col).isNotNull()) \
        .select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text")) \
        .mapInArrow(run, "item string, part long, words binary, n long")


class Windows:
    """The different windows of one block of items, with their words as numbers, and their shingles."""

    def __init__(self, parts: list[tuple[str, bytes]], window: int, shingle: int):
        self.window = window
        numbers: dict[bytes, int] = {}
        names: dict[str, int] = {}
        found: dict[bytes, set[int]] = {}
        for item, words in parts:
            own = np.array([numbers.setdefault(w, len(numbers)) for w in words.split()], np.int32)
            name = names.setdefault(item, len(names))
            size = min(window, len(own))
            for at in range(len(own) - size + 1):
                found.setdefault(own[at:at + size].tobytes(), set()).add(name)
        self.numbers, self.items = numbers, list(names)
        self.n = len(found)
        self.size = np.array([len(k) // 4 for k in found], np.int64)
        self.words = np.full((self.n, window), -1, np.int32)
        for i, k in enumerate(found):
            self.words[i, :len(k) // 4] = np.frombuffer(k, np.int32)
        self.owner_ends = np.cumsum([len(v) for v in found.values()], dtype=np.int64)
        self.owners = np.fromiter((x for v in found.values() for x in v), np.int32, self.owner_ends[-1] if self.n else 0)
        # shingles are as long as the window where that is shorter
        self.lengths = sorted(set(np.minimum(self.size, shingle).tolist()))
        self.shingle = shingle
        self.shingles = {n: np.unique(np.concatenate([self.keys(self.words[i, :s], n) for i, s in self.of(n)]))
                         for n in self.lengths}

    def of(self, n: int) -> Iterator[tuple[int, int]]:
        """The windows whose shingles have n words, with their sizes."""
        for i in np.flatnonzero(np.minimum(self.size, self.shingle) == n):
            yield int(i), int(self.size[i])

    def keys(self, numbers: np.ndarray, n: int) -> np.ndarray:
        """One number per shingle of n words; -1 where a word is in no item."""
        last = len(numbers) - n + 1
        if last <= 0:
            return np.zeros(0, np.int64)
        key, known = np.zeros(last, np.int64), np.ones(last, bool)
        for k in range(n):
            part = numbers[k:k + last]
            key = (key << 21) | part
            known &= part >= 0
        return np.where(known, key, -1)

    def numbered(self, words: list[bytes]) -> np.ndarray:
        get = self.numbers.get
        return np.array([get(w, -1) for w in words], np.int32)

    def places(self, own: np.ndarray, n: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in a document there are shingles of ``keys`` (sorted), and which ones."""
        mine = self.keys(own, n)
        places = np.flatnonzero(mine >= 0)
        at = np.searchsorted(keys, mine[places])
        same = keys[np.minimum(at, len(keys) - 1)] == mine[places]
        return places[same], at[same]

    def choose(self, counts: dict[int, np.ndarray]) -> None:
        """Keep each window's rarest shingle, by the occurrences in the documents; ties to the first one."""
        self.prefixes = {}
        for n in self.lengths:
            rows = []
            for i, size in self.of(n):
                keys = self.keys(self.words[i, :size], n)
                first = int(np.argmin(counts[n][np.searchsorted(self.shingles[n], keys)]))
                rows.append((int(keys[first]), i, first))
            key, which, offset = map(np.array, zip(*sorted(rows)))
            different, starts = np.unique(key, return_index=True)
            self.prefixes[n] = different, np.append(starts, len(key)), which, offset

    def search(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Beginnings of windows in a document, and which windows."""
        begins, found = [], []
        for n, (keys, starts, which, offset) in self.prefixes.items():
            places, at = self.places(own, n, keys)
            many = starts[at + 1] - starts[at]
            for lo, hi in _chunks(many):
                place, first, count = places[lo:hi], starts[at[lo:hi]], many[lo:hi]
                row = np.repeat(first - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
                begin, window = np.repeat(place, count) - offset[row], which[row]
                inside = (begin >= 0) & (begin + self.size[window] <= len(own))
                begin, window = begin[inside], window[inside]
                reach = np.minimum(begin[:, None] + np.arange(self.window), len(own) - 1)
                asked = self.words[window]
                same = ((own[reach] == asked) | (asked < 0)).all(axis=1)
                begins.append(begin[same])
                found.append(window[same])
        if not begins:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(begins), np.concatenate(found)

    def owned(self, windows: np.ndarray) -> set[str]:
        out: set[int] = set()
        for w in np.unique(windows):
            out.update(self.owners[self.owner_ends[w - 1] if w else 0:self.owner_ends[w]].tolist())
        return {self.items[i] for i in out}


def _chunks(many: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of hits whose candidates are about CANDIDATES at most."""
    if not len(many):
        return
    group = np.cumsum(many) // CANDIDATES
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    yield from zip(starts, [*starts[1:], len(many)])


def _counted(docs: DataFrame, index, lengths: list[int]) -> dict[int, np.ndarray]:
    """Occurrences in the documents of each shingle of a block. The result is as large as the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        windows: Windows = index.value
        counts = {n: np.zeros(len(windows.shingles[n]), np.int64) for n in lengths}
        for b in batches:
            for text in b.column(0):
                own = windows.numbered(words_of(text.as_py()))
                for n in lengths:
                    np.add.at(counts[n], windows.places(own, n, windows.shingles[n])[1], 1)
        for n in lengths:
            some = np.flatnonzero(counts[n])
            yield pa.RecordBatch.from_pydict({"n": pa.array([n] * len(some), pa.int32()), "shingle": pa.array(some),
                                              "count": pa.array(counts[n][some])})

    found = docs.select(TMP + "text").mapInArrow(run, "n int, shingle long, count long") \
        .groupBy("n", "shingle").agg(F.sum("count").alias("count"))
    out = {n: np.zeros(len(index.value.shingles[n]), np.int64) for n in lengths}
    for r in found.collect():
        out[r["n"]][r["shingle"]] = r["count"]
    return out


def _merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans without overlaps that cover the same words."""
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    new = np.r_[True, begins[1:] > ends[:-1]] if len(begins) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    return begins[starts], ends[np.r_[starts[1:] - 1, len(ends) - 1]] if len(starts) else ends


def _joined(docs: DataFrame, index, id_col: str, keep_text: bool) -> DataFrame:
    """The findings of one block added to those so far."""
    id_type = docs.schema[id_col].dataType.simpleString()
    text = TMP + "text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: Windows = index.value if index else None
        for b in batches:
            n_words, begins, ends, items = [], [], [], []
            for t, x, y, had in zip(b.column(text), b.column("begins"), b.column("ends"), b.column("items")):
                words = words_of(t.as_py())
                lo, hi, names = np.array(x.as_py(), np.int64), np.array(y.as_py(), np.int64), set(had.as_py())
                if windows and words:
                    begin, window = windows.search(windows.numbered(words))
                    lo, hi = _merged(np.r_[lo, begin], np.r_[hi, begin + windows.size[window]])
                    names |= windows.owned(window)
                n_words.append(len(words))
                begins.append(lo)
                ends.append(hi)
                items.append(sorted(names))
            cols = {id_col: b.column(id_col), "n_words": pa.array(n_words, pa.int64()),
                    "begins": pa.array(begins, pa.list_(pa.int64())), "ends": pa.array(ends, pa.list_(pa.int64())),
                    "items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_pydict(cols | ({text: b.column(text)} if keep_text else {}))

    schema = f"`{id_col}` {id_type}, n_words long, begins array<long>, ends array<long>, items array<string>"
    return docs.mapInArrow(run, schema + (f", {text} binary" if keep_text else ""))


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                 block_words: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per document: the id, n_words, n_hit (words inside any occurrence of an item's window), begins and
    ends (the hit spans, in words), items (sorted ids, as text, of items with occurring windows)."""
    if shingle > 3 or block_words > 1 << 21:
        raise ValueError("a shingle's key holds three words of 21 bits")
    spark = docs.sparkSession
    parts = stored(_parts(items, window, item_col, item_text_col), "decontamination_items")
    n = parts.agg(F.sum("n")).collect()[0][0] or 0
    blocks = math.ceil(n / block_words)
    state = docs.select(id_col, F.col(text_col).cast("binary").alias(TMP + "text"),
                        *[F.array().cast(t).alias(c) for c, t in
                          (("begins", "array<long>"), ("ends", "array<long>"), ("items", "array<string>"))])
    if not blocks:
        state = _joined(state, None, id_col, False)
    previous = None
    for block in range(blocks):
        own = parts.filter(F.pmod(F.xxhash64("item", "part"), F.lit(blocks)) == block)
        # at most about block_words words, the block's share
        windows = Windows([(r["item"], bytes(r["words"])) for r in own.select("item", "words").collect()],
                          window, shingle)
        if windows.n:
            shared = spark.sparkContext.broadcast(windows)
            windows.choose(_counted(state, shared, windows.lengths))
            shared.unpersist()
            windows.shingles = {}  # the workers need the prefixes only
        last = block == blocks - 1
        state = _joined(state, spark.sparkContext.broadcast(windows) if windows.n else None, id_col, not last)
        if not last:  # one block at a time in a worker's memory
            state = stored(state.drop("n_words"), "decontamination")
            if previous is not None:
                dropped(previous)
            previous = state
    hit = F.aggregate(F.zip_with("ends", "begins", lambda y, x: y - x), F.lit(0).cast("long"), lambda s, x: s + x)
    return state.select(id_col, "n_words", hit.alias("n_hit"), "begins", "ends", "items")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The findings with the items as a count and a hash."""
    return found.select(id_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
iw AS (
  SELECT DISTINCT item, size, array_to_string(w[s:s + size - 1], ' ') AS gram
  FROM (SELECT item, w, least(len(w), 10) AS size, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s
        FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM iw),
dw AS (
  SELECT rid, size, s, array_to_string(w[s:s + size - 1], ' ') AS gram
  FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT rid, item, s, size FROM dw JOIN iw USING (size, gram)),
words AS (SELECT rid, count(DISTINCT p) AS n_hit
          FROM (SELECT rid, unnest(range(s, s + size)) AS p FROM (SELECT DISTINCT rid, s, size FROM hits)) GROUP BY rid),
named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN named USING (rid)
"""
