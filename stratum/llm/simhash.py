"""SimHash near-duplicates, found exactly through an oblivious vantage-point tree.

Fingerprints: the text with A-Z lower-cased is cut into words ``[^\\x20\\x09-\\x0D]+`` and shingles of
some words, repeats included; a bit is set if more than half of the shingles' XXH64 (seed 42) have it.

Equal fingerprints are one node. The nodes are partitioned by Hamming distance to vantage points, one
per level of the tree (picked on a bounded sample), each with a border: nodes up to the border go to the
inner side, the others to the outer one. By the triangle inequality, two nodes within r bits differ by at
most r in their distances to a vantage point, so giving r distances around the border to both sides puts
every such pair into at least one common shard. Shards are searched exactly; a shard that is still too
large is searched in blocks, each pair of blocks a group of its own. A group returns a spanning forest
of its links, never all pairs, and the forests are joined by alternating large- and small-star steps.

Defined cases: a null text is empty; a text without words has fingerprint zero, linked like any other; a
text of fewer words than a shingle is one shingle; equal and repeated rows fall into one component;
a null id links like any other row but can't name a component (component_id is null if no id is
there); an empty table gives an empty result; extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import TMP, dropped, map_groups, released, shuffle_width, stored, text_or_empty

SEED = 42
#: Fingerprints per shard aimed at; the most that one group compares; the sample for vantage points.
SHARD, BLOCK, SAMPLE = 2048, 8192, 8192
#: Shingles hashed at a time.
CHUNK = 1 << 16


def fingerprint(text: str, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    import xxhash
    words = text.encode("utf-8").lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    last = max(1, len(words) - shingle + 1)
    votes = np.zeros(64, np.int64)
    for a in range(0, last, CHUNK):
        part = words[a:min(last, a + CHUNK) + shingle - 1]
        n = min(last, a + CHUNK) - a
        grams = map(b" ".join, zip(*(part[k:k + n] for k in range(shingle)))) \
            if len(words) >= shingle else [b" ".join(words)]
        h = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64, n)
        votes += np.unpackbits(h.view(np.uint8).reshape(n, 8), axis=1, bitorder="little") \
            .sum(axis=0, dtype=np.int64)
    bits = (2 * votes > last).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, text_col: str = "text",
                 id_col: str = "doc_id") -> DataFrame:
    """(id, hash of the text, fp): the fingerprint as a signed long."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.pop(TMP + "text")], np.uint64)
            yield b.assign(fp=fps.view(np.int64))

    text = text_or_empty(text_col)
    return docs.select(id_col, F.xxhash64(text).alias(TMP + "hash"), text.alias(TMP + "text")) \
        .mapInPandas(run, f"`{id_col}` {id_type}, {TMP}hash long, fp long")


def levels(nodes: DataFrame, n: int, bits: int, shard: int = SHARD) -> list[tuple[int, int]]:
    """Vantage points with their borders, one per level: as many as halve n nodes to shards.

    Of some candidates of a bounded sample, each level takes the one whose distances spread most, and
    their median as its border.
    """
    depth = max(0, int(np.ceil(np.log2(max(1, n) / shard))))
    if not depth:
        return []
    share = max(1, n // SAMPLE)
    sample = nodes.filter(F.pmod(F.xxhash64("fp", F.lit(7)), F.lit(share)) == 0).select("fp")
    # a hash picks about SAMPLE of n distinct values
    fps = np.array(sorted(r[0] for r in sample.collect()), np.int64).view(np.uint64)
    pick = np.random.default_rng(SEED)
    out = []
    for _ in range(depth):
        candidates = pick.choice(fps, min(16, len(fps)), replace=False)
        spread = [np.bitwise_count(fps ^ c).astype(int) for c in candidates]
        best = max(range(len(candidates)), key=lambda i: spread[i].std())
        out.append((int(candidates[best].view(np.int64)), int(np.median(spread[best]))))
    return out


def sharded(nodes: DataFrame, tree: list[tuple[int, int]], bits: int) -> DataFrame:
    """(fp, shard): each node once for every shard whose overlap it lies in."""
    df = nodes.select("fp", F.lit(0).cast("long").alias("shard"))
    for point, border in tree:
        d = F.bit_count(F.col("fp").bitwiseXOR(F.lit(point).cast("long")))
        # inner: up to the border and half of the overlap; outer: the rest and the overlap, r wide
        inner, outer = d <= border + bits // 2, d > border + bits // 2 - bits
        sides = F.filter(F.array(F.when(inner, F.lit(0)), F.when(outer, F.lit(1))), lambda x: x.isNotNull())
        df = df.select("fp", (F.col("shard") * 2).alias("shard"), F.explode(sides).alias("side")) \
            .select("fp", (F.col("shard") + F.col("side")).alias("shard"))
    return df


def blocked(shards: DataFrame, block: int = BLOCK) -> DataFrame:
    """Split shards above ``block`` nodes: each pair of blocks becomes a group."""
    sizes = shards.groupBy("shard").agg(F.ceil(F.count("*") * 2 / F.lit(block)).alias("k")) \
        .filter(F.col("k") > 2)
    df = shards.join(sizes, "shard", "left").withColumn("k", F.coalesce("k", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("k"))
    df = df.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"),
                                                                              F.col("k") - 1)))
    return df.select("fp", "shard", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def forest(fps: np.ndarray, bits: int) -> np.ndarray:
    """For each fingerprint, the place of the smallest one that links lead to within this group."""
    n = len(fps)
    root = np.arange(n)
    linked = np.zeros(n, bool)
    for a in range(0, n, 512):
        close = np.bitwise_count(fps[a:a + 512, None] ^ fps[None, :]) <= bits
        linked[a:a + 512] = close.sum(axis=1) > 1
    left = np.flatnonzero(linked)
    while len(left):  # grow a component from its smallest member; each member is compared once
        seed, border = left[0], left[:1]
        left = left[1:]
        while len(border) and len(left):
            near = np.zeros(len(left), bool)
            for a in range(0, len(border), 512):
                near |= (np.bitwise_count(fps[border[a:a + 512], None] ^ fps[left][None, :]) <= bits).any(axis=0)
            border, left = left[near], left[~near]
            root[border] = seed
    return root


def links(nodes: DataFrame, bits: int, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(fp, to): a spanning forest of the links between different fingerprints, to smaller ones."""
    n = nodes.count()
    groups = blocked(sharded(nodes, levels(nodes, n, bits, shard), bits), block)

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        key = frame[["shard", "i", "j"]].to_numpy()
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
        values = frame["fp"].to_numpy()
        for a, b in zip(starts, [*starts[1:], len(frame)]):
            fps = np.sort(values[a:b])
            root = forest(fps.view(np.uint64), bits)
            moved = np.flatnonzero(root != np.arange(len(fps)))
            out.append(np.stack([fps[moved], fps[root[moved]]], axis=1))
        both = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
        return pd.DataFrame({"fp": both[:, 0], "to": both[:, 1]})

    width = max(shuffle_width(nodes.sparkSession), n // 50_000)
    return map_groups(groups, ["shard", "i", "j"], width, search, "fp long, to long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(fp, root): the smallest fingerprint that each one's links lead to, for those with links.

    Alternates large-star (link larger neighbours to the smallest one) and small-star (link a
    node and its smaller neighbours to the smallest one) until the links don't change.
    """
    spark = edges.sparkSession
    edges = stored(edges, "simhash_edges")

    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("fp", "to").cast("decimal(38,0)"))).collect()[0])

    now = state(edges)
    while now[0]:
        both = edges.unionByName(edges.select(F.col("to").alias("fp"), F.col("fp").alias("to")))
        least = both.groupBy("fp").agg(F.min("to").alias("m"))
        large = both.join(least, "fp").filter(F.col("to") > F.col("fp")) \
            .select(F.col("to").alias("fp"), F.least("m", "fp").alias("to")).distinct()
        least = large.groupBy("fp").agg(F.min("to").alias("m"))
        small = large.join(least, "fp")
        small = small.select(F.col("to").alias("fp"), F.col("m").alias("to")) \
            .unionByName(least.select("fp", F.col("m").alias("to"))) \
            .filter(F.col("fp") != F.col("to")).distinct()
        after = stored(small, "simhash_edges")
        dropped(edges)
        edges, before = after, now
        now = state(edges)
        released(spark)
        if now == before:
            break
    return edges.groupBy("fp").agg(F.min("to").alias("root"))


def _grouped(docs: DataFrame, shingle: int, bits: int, shard: int, block: int, text_col: str,
             id_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows' fingerprints, and of each fingerprint its component's root and smallest id."""
    prints = stored(fingerprints(docs, shingle, text_col, id_col), "simhash")
    nodes = stored(prints.groupBy("fp").agg(F.min(id_col).alias("first_id")), "simhash_nodes")
    roots = components(links(nodes, bits, shard, block))
    named = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints, named.join(firsts, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 2, shard: int = SHARD,
                    block: int = BLOCK, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: the id, fingerprint (16 hex digits) and component_id, the smallest id that links of at
    most ``bits`` differing bits lead to."""
    prints, named = _grouped(docs, shingle, bits, shard, block, text_col, id_col)
    return prints.join(named, "fp").select(
        id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, bits: int = 2, text_col: str = "text",
             id_col: str = "doc_id") -> DataFrame:
    """One document of each component, the one with the smallest id, with its columns as they were. Of
    repeated rows one stays. Rows are told by id and text, so texts that share an id are judged each by
    its own component; a row without an id stays only in a component that has no id at all."""
    prints, named = _grouped(docs, shingle, bits, SHARD, BLOCK, text_col, id_col)
    # an id as text that is never null, so that the join and the last step are dealt alike
    key, own = F.coalesce(F.concat(F.lit("i"), F.col(id_col).cast("string")), F.lit("")), [TMP + "key", TMP + "hash"]
    first = F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), key.alias(own[0]), own[1]))
    keep = prints.join(named.select("fp", "root"), "fp").groupBy("root").agg(first.alias("first")) \
        .select(*[F.col(f"first.{c}") for c in own]).distinct()
    return docs.withColumns({own[0]: key, own[1]: F.xxhash64(text_or_empty(text_col))}) \
        .join(keep, own, "left_semi").dropDuplicates(own).select(*docs.columns)
