"""Alignment of the token streams of two tokenizers over the same bytes.

A text's tokens A and B are cut into groups at the byte offsets where tokens of both end; two tokens that
end there are linked. Everything after the encoding is Arrow: lists of ids are flattened with the indices
of their parents, byte lengths are taken by id and summed up per document, A's and B's (document, end)
are joined by Acero, and the links' id pairs are counted by ``Table.group_by`` in each task and summed
up by Spark. With the corpus-wide counts, documents learn how often their own links occur.

A's texts are merged by rank where the vocabulary proves that the ids stay those of its library (see
``merges_by_rank``). Links are stored as id lists beside the documents. The table of counts is sent to the tasks if it has at most ``SHARED_PAIRS`` rows; beyond that,
documents and the pairs of their chunk meet in a shuffle, a chunk being a bounded number of links, so no pair
is a hot key and no document leaves its row.

Defined cases: texts that are null, empty, or not spelled by both token streams (a sign that the second
vocabulary writes as a blank, bytes that aren't UTF-8) have no tokens: zeros and an empty text of groups;
repeated rows count each; an empty table gives no rows; extra columns don't matter.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import TMP, shuffle_width, stored
from stratum.llm.pretokens import BEYOND_FAST, byte_letters

#: Characters of the texts that are encoded and aligned at a time, if one text isn't longer.
SLICE_CHARS = 1 << 19
#: Most id pairs that are sent to every task (17 bytes each); links of a chunk beyond that.
SHARED_PAIRS, CHUNK_LINKS = 1 << 21, 1 << 20
#: Different pairs that a task holds before it hands their counts on.
HELD = 400_000
BLANK = "▁"


def merges_by_rank(path: str) -> bool:
    """Whether merging by the rank of what comes out takes the same steps as merging by the list of pairs.

    It does if every token, spelled out, merges to itself and a merge's rank is its product's id: inside a
    token's bounds both ways go on as they would on the token alone. Proven on the whole vocabulary.
    """
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(path)
    vocabulary = library.get_vocab(with_added_tokens=False)
    with open(path, encoding="utf-8") as f:
        merges = json.load(f)["model"]["merges"]
    products = ["".join(m if isinstance(m, list) else m.split(" ")) for m in merges]
    tokenize, first = library.model.tokenize, len(vocabulary) - len(merges)
    return all(vocabulary.get(p) == first + k for k, p in enumerate(products)) and \
        all([t.id for t in tokenize(token)] == [i] for token, i in vocabulary.items())


class ByteLevel:
    """Ids and token bytes of a byte-level vocabulary: by rank, with the faster library, if ``by_rank``
    (proven beforehand); texts beyond the characters whose classes the tests compare, and all others, take
    the vocabulary's own library."""

    def __init__(self, path: str, pattern: str, by_rank: bool):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        back = {c: b for b, c in enumerate(byte_letters())}
        self.path, self.by_rank = path, by_rank
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(back[c] for c in token)
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, special_tokens={},
                                      mergeable_ranks={self.bytes[i]: i for i in vocabulary.values()})

    @cached_property
    def library(self):
        from tokenizers import Tokenizer
        library = Tokenizer.from_file(self.path)
        library.encode_special_tokens = True   # their strings in a text are ordinary text
        return library

    def __call__(self, texts: list[str]) -> list[bytes]:
        return [array("I", self.fast.encode_ordinary(t) if self.by_rank and not BEYOND_FAST.search(t)
                      else self.library.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]


class Pieces:
    """Ids and token bytes of a piece vocabulary whose library puts a blank before the text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.library = SentencePieceProcessor(model_file=path)
        self.bytes = [bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace(BLANK, " ").encode()
                      for i in range(self.library.get_piece_size()) for p in [self.library.id_to_piece(i)]]

    def __call__(self, texts: list[str]) -> list[bytes]:
        return [array("I", ids).tobytes() for ids in self.library.encode(texts, num_threads=1)] if texts else []


@lru_cache(maxsize=1)
def encoders(a_path: str, b_path: str, pattern: str, by_rank: bool) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(a_path, pattern, by_rank), Pieces(b_path)


class Tables:
    """By id: the token's bytes and how many, of A and B; and each id as text with each sign that can follow it."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.bytes = [pa.array(e.bytes, pa.binary()) for e in (a, b)]
        self.lengths = [pc.binary_length(x).cast(pa.int64()) for x in self.bytes]
        self.most = max(len(a.bytes), len(b.bytes))
        self.texts = pa.array([f"{i}{sign}" for sign in _SIGNS for i in range(self.most)])


@lru_cache(maxsize=1)
def _tables(a_path: str, b_path: str, pattern: str, by_rank: bool) -> Tables:
    return Tables(*encoders(a_path, b_path, pattern, by_rank))


#: What follows an id: another of its stream, B's ids after A's, the next group, nothing.
_SIGNS = (",", "|", ";", "")


def _spelled(lists: pa.ListArray, token_bytes: pa.Array, lengths: pa.Array, want: list[bytes]) -> np.ndarray:
    """Whether each document's tokens spell its bytes."""
    ids = lists.flatten()
    made = token_bytes.take(ids).cast(pa.large_binary())
    bounds = np.r_[0, np.cumsum(np.asarray(lengths.take(ids)))][np.asarray(lists.offsets)]
    data = memoryview(made.buffers()[2] or b"")
    return np.array([bytes(data[x:y]) == w for x, y, w in zip(bounds.tolist(), bounds[1:].tolist(), want)], bool)


def _list(ids: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(i) // 4 for i in ids)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.uint32), pa.int32()))


def _ends(lists: pa.ListArray, lengths: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Of each token its document, its id and its end in the document's bytes."""
    parent, ids = pc.list_parent_indices(lists), pc.list_flatten(lists)
    sums = pc.cumulative_sum(lengths.take(ids))
    # a document's own sums begin where the one before it ended
    first = np.asarray(lists.offsets)[:-1]
    before = np.r_[0, np.asarray(sums)][first]
    return parent, ids, pc.subtract(sums, pa.array(before).take(parent))


def aligned(a: pa.ListArray, b: pa.ListArray, tables: Tables) -> dict[str, pa.Array | np.ndarray | list]:
    """Per document: n_groups, the links' ids as lists, and groups_sha256."""
    a_doc, a_id, a_end = _ends(a, tables.lengths[0])
    b_doc, b_id, b_end = _ends(b, tables.lengths[1])
    # a document's ends are told from the others' by the document's number above them
    key = lambda doc, end: pc.bit_wise_or(pc.shift_left(doc.cast(pa.int64()), 40), end)
    left = pa.table({"key": key(a_doc, a_end), "i": pa.array(np.arange(len(a_id)))})
    right = pa.table({"key": key(b_doc, b_end), "j": pa.array(np.arange(len(b_id)))})
    links = left.join(right, "key", join_type="inner", use_threads=False)
    at, i, j = (links[c].to_numpy() for c in ("key", "i", "j"))
    order = np.lexsort((j, i))
    at, i, j, n = at[order], i[order], j[order], len(a)
    doc = at >> 40
    # a group ends with the last token of each stream there
    cut = np.r_[at[1:] != at[:-1], True][:len(at)]
    groups = np.bincount(doc[cut], minlength=n)
    ends = pa.array(np.r_[0, np.cumsum(np.bincount(doc, minlength=n))], pa.int32())
    a_ids, b_ids = np.asarray(a_id), np.asarray(b_id)
    lists = [pa.ListArray.from_arrays(ends, pa.array(ids[x])) for ids, x in ((a_ids, i), (b_ids, j))]
    # A's and B's ids of each group in turn: a token stands after all of its stream before it, and after
    # the other stream's tokens of the groups before its own (A) or up to its own (B)
    ai, bj, of = i[cut], j[cut], doc[cut]
    a_many, b_many = np.diff(np.r_[-1, ai]), np.diff(np.r_[-1, bj])
    a_place = np.arange(len(a_ids)) + np.repeat(np.r_[0, bj + 1][:len(ai)], a_many)
    b_place = np.arange(len(b_ids)) + np.repeat(ai + 1, b_many)
    a_sign, b_sign = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
    a_sign[ai] = 1
    b_sign[bj] = np.where(np.r_[of[1:] != of[:-1], True][:len(of)], 3, 2)
    spell = np.zeros(len(a_ids) + len(b_ids), np.int64)
    spell[a_place] = a_ids + tables.most * a_sign
    spell[b_place] = b_ids + tables.most * b_sign
    spelled = tables.texts.take(pa.array(spell))
    starts = np.frombuffer(spelled.buffers()[1], np.int32, len(spelled) + 1) if len(spelled) else np.zeros(1, np.int32)
    data = memoryview(spelled.buffers()[2]) if len(spelled) else memoryview(b"")
    bounds = starts[np.asarray(a.offsets) + np.asarray(b.offsets)].tolist()
    sha = [hashlib.sha256(data[x:y]).hexdigest() if y > x else "" for x, y in zip(bounds, bounds[1:])]
    return {"n_groups": groups, "a_links": lists[0], "b_links": lists[1], "groups_sha256": sha}


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts that aren't long together."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
    group = np.cumsum(lengths) // SLICE_CHARS
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else []
    yield from zip(starts, [*starts[1:], len(group)])


def token_links(docs: DataFrame, a_path: str, b_path: str, pattern: str, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Per document: the id, n_a, n_b, n_groups, groups_sha256, and its links as lists a_links, b_links."""
    id_type = docs.schema[id_col].dataType.simpleString()
    vocabularies = a_path, b_path, pattern, merges_by_rank(a_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        streams, tables = encoders(*vocabularies), _tables(*vocabularies)
        for batch in batches:
            for lo, hi in _slices(batch.column(1)):
                b = batch.slice(lo, hi - lo)
                raws, texts = [x.as_py() or b"" for x in b.column(1)], []
                for raw in raws:
                    try:
                        texts.append(raw.decode("utf-8"))
                    except UnicodeDecodeError:
                        texts.append("")
                some = [k for k, t in enumerate(texts) if t]
                ids = [[b""] * len(texts) for _ in streams]
                for own, encode, blank in zip(ids, streams, (" ", "")):
                    for k, made in zip(some, encode([blank + texts[k] for k in some])):
                        own[k] = made
                lists, want = list(map(_list, ids)), [b" " + raw if t else b"" for raw, t in zip(raws, texts)]
                good = np.logical_and(*(_spelled(x, y, z, want) for x, y, z in zip(lists, tables.bytes, tables.lengths)))
                if not good.all():
                    ids = [[x if g else b"" for x, g in zip(own, good)] for own in ids]
                    lists = list(map(_list, ids))
                found = aligned(*lists, tables)
                sizes = [pc.list_value_length(x).cast(pa.int64()) for x in lists]
                yield pa.RecordBatch.from_pydict({
                    id_col: b.column(0), "n_a": sizes[0], "n_b": sizes[1], "n_groups": pa.array(found["n_groups"], pa.int64()),
                    "groups_sha256": pa.array(found["groups_sha256"], pa.string()),
                    "a_links": found["a_links"], "b_links": found["b_links"]})

    return docs.select(id_col, F.col(text_col).cast("binary").alias(TMP + "text")) \
        .mapInArrow(run, f"`{id_col}` {id_type}, n_a long, n_b long, n_groups long, groups_sha256 string, "
                         "a_links array<int>, b_links array<int>")


def pair_counts(linked: DataFrame) -> DataFrame:
    """(a, b, count, best): how many links hold a pair, and if no pair of its B id has more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            own = pa.table({"a": batch.column(0).flatten(), "b": batch.column(1).flatten()}) \
                .group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["a", "b", "count"])
            held = own if held is None else pa.concat_tables([held, own]).group_by(["a", "b"], use_threads=False) \
                .aggregate([("count", "sum")]).rename_columns(["a", "b", "count"])
            if len(held) > HELD:
                yield from held.combine_chunks().to_batches()
                held = None
        if held is not None and len(held):
            yield from held.combine_chunks().to_batches()

    counts = linked.select("a_links", "b_links").mapInArrow(run, "a int, b int, count long") \
        .groupBy("a", "b").agg(F.sum("count").alias("count"))
    counts = stored(counts, "alignment_counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return stored(counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best")),
                  "alignment_pairs")


class Pairs:
    """Counts of id pairs, looked up for many links at a time."""

    def __init__(self, a: np.ndarray, b: np.ndarray, count: np.ndarray, best: np.ndarray):
        key = a.astype(np.int64) << 32 | b
        order = np.argsort(key)
        self.key, self.count, self.best = key[order], count[order], best[order]

    def __call__(self, a: pa.ListArray, b: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per document: links, links whose pair is best, and the sum of their counts."""
        key = np.asarray(a.flatten()).astype(np.int64) << 32 | np.asarray(b.flatten())
        at = np.searchsorted(self.key, key)
        parts = np.asarray(pc.fill_null(pc.list_value_length(a), 0)).astype(np.int64)
        ends = np.cumsum(parts)
        sums = lambda x: np.diff(np.r_[0, np.cumsum(x, dtype=np.int64)][np.r_[0, ends]])
        return parts, sums(self.best[at]), sums(self.count[at])


def _columns(linked: DataFrame, id_col: str) -> tuple[list[str], str]:
    id_type = linked.schema[id_col].dataType.simpleString()
    names = [id_col, "n_a", "n_b", "n_groups", "groups_sha256"]
    return names, f"`{id_col}` {id_type}, n_a long, n_b long, n_groups long, groups_sha256 string, " \
                  "n_links long, n_best long, count_sum long"


def _added(batch, names: list[str], pairs: Pairs) -> pa.RecordBatch:
    n, best, total = pairs(batch.column("a_links"), batch.column("b_links"))
    return pa.RecordBatch.from_pydict({c: batch.column(c) for c in names}
                                      | {"n_links": pa.array(n), "n_best": pa.array(best), "count_sum": pa.array(total)})


def _by_shared(linked: DataFrame, pairs: DataFrame, id_col: str) -> DataFrame:
    own = pairs.toPandas()  # at most SHARED_PAIRS rows
    shared = linked.sparkSession.sparkContext.broadcast(Pairs(*(own[c].to_numpy() for c in ("a", "b", "count", "best"))))
    names, schema = _columns(linked, id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _added(b, names, shared.value)

    return linked.mapInArrow(run, schema)


def _by_chunks(linked: DataFrame, pairs: DataFrame, id_col: str, chunk_links: int) -> DataFrame:
    """Documents and the counted pairs of their chunk, brought together by the chunk."""
    fields = linked.schema

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, links = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            chunk = []
            for n in pc.list_value_length(b.column("a_links")).to_pylist():
                chunk.append(part + links // chunk_links)
                links += n
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(chunk, pa.int64())], [*b.schema.names, TMP + "chunk"])

    chunk = TMP + "chunk"
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    chunked = stored(linked.mapInArrow(numbered, f"{own}, {chunk} long"), "alignment_chunks")

    def different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of = b.column(2).take(pc.list_parent_indices(b.column(0)))
            own = pa.table({"a": b.column(0).flatten(), "b": b.column(1).flatten(), chunk: of}) \
                .group_by(["a", "b", chunk], use_threads=False).aggregate([])
            yield from own.combine_chunks().to_batches()

    asked = chunked.select("a_links", "b_links", chunk).mapInArrow(different, f"a int, b int, {chunk} long").distinct()
    # many chunks ask for a frequent pair, but a chunk asks for it once: dealt by pair and a salt
    salts = 16
    salted = pairs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    answers = asked.withColumn("salt", F.pmod(F.xxhash64(chunk), F.lit(salts)).cast("int")) \
        .join(salted, ["a", "b", "salt"]).select(chunk, "a", "b", "count", "best")
    names, schema = _columns(linked, id_col)

    def meet(docs: pa.Table, found: pa.Table) -> pa.Table:
        look = Pairs(*(found[c].to_numpy() for c in ("a", "b", "count", "best")))
        return pa.Table.from_batches([_added(b, names, look) for b in docs.combine_chunks().to_batches()])

    return chunked.groupBy(chunk).cogroup(answers.groupBy(chunk)).applyInArrow(meet, schema)


def alignment(docs: DataFrame, a_path: str, b_path: str, pattern: str, shared_pairs: int = SHARED_PAIRS,
              chunk_links: int = CHUNK_LINKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the id, n_a, n_b, n_groups, groups_sha256, n_links, n_best (links whose pair is the most
    frequent one of its B id) and count_sum (the pairs' corpus-wide counts, summed over the links)."""
    linked = stored(token_links(docs, a_path, b_path, pattern, id_col, text_col), "alignment_links")
    pairs = pair_counts(linked)
    if pairs.limit(shared_pairs + 1).count() <= shared_pairs:
        return _by_shared(linked, pairs, id_col)
    return _by_chunks(linked, pairs, id_col, chunk_links)
