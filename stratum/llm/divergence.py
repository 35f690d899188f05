"""Divergence of sources: how a source's words differ from those of its language and of other sources.

The vocabulary of a language, the terms in enough of its documents, is held as minimal acyclic
transducers: each is built incrementally from sorted terms (states of equal continuations are shared) and
gives a term's lexicographic ordinal as the sum of the numbers on its path. The sorted vocabulary is cut
into ranges, one transducer each, built where the range lies; their first ordinals are running sums, so
that ordinals are those of the whole vocabulary. The texts are streamed through the transducers once
more: what is accepted is counted by ordinal, and from there on ordinals stand for terms, in shuffles
and in ties, until the few reported terms are named.

Transducers go to the tasks in blocks of a bounded number of bytes; a larger vocabulary makes more blocks,
each of which goes over all documents. Counts are summed in each task before they are shuffled, and
their keys hold the ordinal, so no source or language is a hot key. Sources are compared in blocks of
terms by blocks of sources.

All arithmetic is on integers: counts are scaled by decimals of 38 digits, shares fit a long.

Defined cases: a null text, lang or source is ''; repeated rows count each; a source without kept terms has
even shares; a language without kept terms has pairs of value 0 and no terms; an empty table gives no
rows; extra columns don't matter.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratum.llm.common import map_groups, shuffle_width, stored

#: Documents of a language that a kept term is in; terms reported per source.
LEAST_DOCS, TOP = 10, 10
#: What 1 is scaled to.
SCALE = 1_000_000_000
#: Terms of a transducer aimed at; bytes of the transducers of a block.
RANGE_TERMS, BLOCK_BYTES = 50_000, 48 << 20
#: Terms and sources of a group in which sources are compared.
PAIR_TERMS, PAIR_SOURCES = 4096, 256
#: Counts that a task holds before it hands them on.
HELD = 400_000

#: Letters and bytes beyond ASCII stay, A-Z lower-cased; all else parts terms.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


class Builder:
    """Minimal acyclic transducer of terms that come in ascending order of their bytes."""

    def __init__(self):
        self.register: dict[tuple, int] = {}  # a state's signature -> its number
        self.arcs: list[tuple] = []           # per state its (byte, target)
        self.final: list[bool] = []
        self.size: list[int] = []             # terms that can follow from a state
        self.path: list[tuple[list, bool]] = [([], False)]  # open states along the last term
        self.last = b""

    def _close(self, depth: int) -> None:
        """Replace the open states below ``depth`` by registered ones, the deepest first."""
        while len(self.path) - 1 > depth:
            arcs, final = self.path.pop()
            own, _ = self.path[-1]
            own[-1] = (own[-1][0], self._state(arcs, final))

    def _state(self, arcs: list, final: bool) -> int:
        signature = (final, *arcs)
        number = self.register.get(signature)
        if number is None:
            number = self.register[signature] = len(self.arcs)
            self.arcs.append(tuple(arcs))
            self.final.append(final)
            self.size.append(final + sum(self.size[t] for _, t in arcs))
        return number

    def add(self, term: bytes) -> None:
        if self.last and term <= self.last:
            raise ValueError("terms must ascend")
        same = 0
        while same < min(len(term), len(self.last)) and term[same] == self.last[same]:
            same += 1
        self._close(same)
        for byte in term[same:]:
            self.path[-1][0].append((byte, -1))
            self.path.append(([], False))
        self.path[-1] = (self.path[-1][0], True)
        self.last = term

    def arrays(self) -> dict[str, np.ndarray]:
        """Arcs in the order of (state, byte): key, target, terms that are passed over; state 0 is the
        root. ``final`` per state."""
        self._close(0)
        root = self._state(*self.path[0])
        number = [(i + 1 if i < root else 0 if i == root else i) for i in range(len(self.arcs))]
        keys, targets, skipped = [], [], []
        for i in sorted(range(len(self.arcs)), key=number.__getitem__):
            passed = int(self.final[i])
            for byte, target in self.arcs[i]:
                keys.append(number[i] << 8 | byte)
                targets.append(number[target])
                skipped.append(passed)
                passed += self.size[target]
        final = np.zeros(len(number), bool)
        final[number] = self.final
        return {"keys": np.array(keys, np.int64), "targets": np.array(targets, np.int32),
                "skipped": np.array(skipped, np.int32), "final": final}


class Vocabulary:
    """The transducers of one block, walked by many terms at a time."""

    def __init__(self, rows):
        self.first: dict[str, list[bytes]] = {}
        self.start: dict[str, list[tuple[int, int]]] = {}
        keys, targets, skipped, final, states = [], [], [], [], 0
        for r in sorted(rows, key=lambda r: (r["lang"], bytes(r["first"]))):
            self.first.setdefault(r["lang"], []).append(bytes(r["first"]))
            self.start.setdefault(r["lang"], []).append((states, r["base"]))
            keys.append(np.frombuffer(r["keys"], np.int64) + (states << 8))
            targets.append(np.frombuffer(r["targets"], np.int32).astype(np.int64) + states)
            skipped.append(np.frombuffer(r["skipped"], np.int32))
            final.append(np.frombuffer(r["final"], bool))
            states += len(final[-1])
        self.keys, self.targets, self.skipped, self.final = map(np.concatenate, (keys, targets, skipped, final))

    def ordinals(self, lang: str, terms: list[bytes]) -> np.ndarray:
        """Each term's ordinal in its language's vocabulary, -1 if it isn't kept (or not in this block)."""
        found = np.full(len(terms), -1, np.int64)
        if lang not in self.start or not terms:
            return found
        starts = np.array(self.start[lang], np.int64)
        which = np.array([max(0, bisect_right(self.first[lang], t) - 1) for t in terms], np.int64)
        state, ordinal = starts[which, 0], starts[which, 1]
        length = np.fromiter(map(len, terms), np.int64, len(terms))
        letters = np.frombuffer(b"".join(terms), np.uint8)
        begin = np.cumsum(length) - length
        walking, depth = np.arange(len(terms)), 0
        while len(walking):
            key = state[walking] << 8 | letters[begin[walking] + depth]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            going = self.keys[at] == key
            walking, at = walking[going], at[going]
            state[walking] = self.targets[at]
            ordinal[walking] += self.skipped[at]
            depth += 1
            ended = length[walking] == depth
            done = walking[ended]
            done = done[self.final[state[done]]]
            found[done] = ordinal[done]
            walking = walking[~ended]
        return found


def _texts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                         for c, n in ((lang_col, "lang"), (source_col, "source"))],
                       F.col(text_col).cast("binary").alias("text"))


def kept_terms(texts: DataFrame, least: int) -> DataFrame:
    """(lang, term): the terms in at least ``least`` documents of the language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: dict[str, Counter] = {}

        def handed() -> pa.RecordBatch:
            rows = [(lang, term, n) for lang, own in docs.items() for term, n in own.items()]
            docs.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()),
                 pa.array([r[2] for r in rows], pa.int64())], ["lang", "term", "docs"])

        for b in batches:
            for lang, text in zip(b.column(0), b.column(1)):
                docs.setdefault(lang.as_py(), Counter()).update(set(terms_of(text.as_py())))
                if sum(map(len, docs.values())) > HELD:
                    yield handed()
        yield handed()

    return texts.select("lang", "text").mapInArrow(run, "lang string, term binary, docs long") \
        .groupBy("lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= least) \
        .select("lang", F.col("term").cast("string").alias("term"))


def vocabulary(kept: DataFrame, range_terms: int = RANGE_TERMS) -> tuple[DataFrame, DataFrame]:
    """(lang, part, base, terms, first, transducer's arrays) per range and (lang, ordinal, term)."""
    spark = kept.sparkSession
    kept = stored(kept, "divergence_kept")
    width = max(shuffle_width(spark), kept.count() // range_terms + 1)
    # rows of a sorted partition are numbered as they lie
    ranged = stored(kept.repartitionByRange(width, "lang", "term").sortWithinPartitions("lang", "term")
                    .select("lang", "term", F.monotonically_increasing_id().alias("at")), "divergence_ranges") \
        .withColumn("part", F.shiftright("at", 33))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (lang, part), own in frame.groupby(["lang", "part"], sort=False):
            builder, terms = Builder(), [t.encode() for t in own["term"]]
            for t in terms:
                builder.add(t)
            made = {k: v.tobytes() for k, v in builder.arrays().items()}
            out.append({"lang": lang, "part": part, "start": own["at"].iloc[0], "terms": len(terms), "first": terms[0]} | made)
        return pd.DataFrame(out)

    made = stored(map_groups(ranged, ["lang", "part"], width, build,
                             "lang string, part long, start long, terms long, first binary, keys binary, "
                             "targets binary, skipped binary, final binary", ["at"]), "divergence_transducers")
    before = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = made.select("lang", "part", "start", F.coalesce(F.sum("terms").over(before), F.lit(0)).alias("base"))
    named = ranged.join(bases, ["lang", "part"]).select("lang", (F.col("base") + F.col("at") - F.col("start"))
                                                        .alias("ordinal"), "term")
    return made.drop("start").join(bases.drop("start"), ["lang", "part"]), named


def _blocks(transducers: DataFrame, block_bytes: int) -> Iterator[list]:
    """The transducers, as many at a time as fit a block. Only their sizes are gone over at once."""
    size = F.length("keys") + F.length("targets") + F.length("skipped") + F.length("final")
    own, held = [], 0
    sizes = transducers.select("lang", "part", size.alias("size")).orderBy("lang", "part").collect()
    for i, r in enumerate(sizes):
        own.append((r["lang"], r["part"]))
        held += r["size"]
        if i + 1 == len(sizes) or held + sizes[i + 1]["size"] > block_bytes:
            low, high = own[0], own[-1]
            here = F.struct("lang", "part")
            ends = [F.struct(F.lit(x[0]).alias("lang"), F.lit(x[1]).cast("long").alias("part")) for x in (low, high)]
            yield transducers.filter((here >= ends[0]) & (here <= ends[1])).collect()
            own, held = [], 0


def recounted(texts: DataFrame, block: list) -> DataFrame:
    """(lang, source, ordinal, count) of the terms of a block."""
    shared = texts.sparkSession.sparkContext.broadcast(Vocabulary(block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[tuple, int] = {}
        held = np.zeros((2, 0), np.int64)

        def handed() -> pa.RecordBatch:
            group = list(names)
            which = held[0] >> 40
            lang, source = ([g[i] for g in group] for i in (0, 1))
            return pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()).take(pa.array(which)), pa.array(source, pa.string()).take(pa.array(which)),
                 pa.array(held[0] & ((1 << 40) - 1)), pa.array(held[1])], ["lang", "source", "ordinal", "count"])

        for b in batches:
            found: dict[tuple, Counter] = {}
            for lang, source, text in zip(*b.columns):
                found.setdefault((lang.as_py(), source.as_py()), Counter()).update(terms_of(text.as_py()))
            rows = [held]
            for key, own in found.items():
                ordinals = shared.value.ordinals(key[0], list(own))
                some = ordinals >= 0
                group = names.setdefault(key, len(names))
                rows.append(np.stack([ordinals[some] | group << 40, np.fromiter(own.values(), np.int64, len(own))[some]]))
            keys, counts = np.concatenate(rows, axis=1)
            keys, place = np.unique(keys, return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, place, counts)
            held = np.stack([keys, sums])
            if held.shape[1] > HELD:
                yield handed()
                names, held = {}, np.zeros((2, 0), np.int64)
        if held.shape[1]:
            yield handed()

    return texts.mapInArrow(run, "lang string, source string, ordinal long, count long") \
        .groupBy("lang", "source", "ordinal").agg(F.sum("count").alias("count"))


def share(count: Column | str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), exactly."""
    return F.expr(f"cast(1 + (cast({SCALE} as decimal(10,0)) * cast({count} + 2 as decimal(20,0))) "
                  f"div cast({total} + 2 * {terms} as decimal(20,0)) as bigint)")


def _pair_sums(counts: DataFrame, stats: DataFrame, pair_terms: int, pair_sources: int) -> DataFrame:
    """(lang, source, item, value): sums over all kept terms, for each ordered pair of sources."""
    stats = stats.filter(F.col("terms") > 0)
    blocks = stats.groupBy("lang").agg(F.ceil(F.count("*") / F.lit(pair_sources)).alias("blocks"))
    stats = stats.join(blocks, "lang").withColumn("own", F.pmod(F.xxhash64("source"), F.col("blocks"))) \
        .withColumn("even", share("0", "total", "terms"))
    # every source in every group of terms: with its share of an absent term, and those it has
    empty = stats.withColumn("shard", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("terms") - 1) / F.lit(pair_terms)).cast("long")))) \
        .select("lang", "shard", "own", "blocks", "source", F.lit(None).cast("long").alias("ordinal"),
                F.col("even").alias("p"), "terms")
    had = counts.join(stats, ["lang", "source"]).select(
        "lang", F.floor(F.col("ordinal") / F.lit(pair_terms)).cast("long").alias("shard"), "own", "blocks", "source",
        "ordinal", share("count", "total", "terms").alias("p"), "terms")
    rows = empty.unionByName(had).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))) \
        .select("lang", "shard", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own",
                "source", "ordinal", "p", "terms")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (lang, shard, i, j), own in frame.groupby(["lang", "shard", "i", "j"], sort=False):
            first = shard * pair_terms
            width = int(min(pair_terms, own["terms"].iloc[0] - first))
            base = own[own["ordinal"].isna()]
            names, of = base["source"].to_numpy(), base["own"].to_numpy()
            p = np.repeat(base["p"].to_numpy(np.int64)[:, None], width, axis=1)
            some = own[own["ordinal"].notna()]
            p[pd.Index(names).get_indexer(some["source"]), some["ordinal"].to_numpy(np.int64) - first] = some["p"]
            right = np.flatnonzero(of == j)
            for a in np.flatnonzero(of == i):
                d = p[right] - p[a]
                value = (d * d // (p[right] + p[a])).sum(axis=1)
                others = right != a
                out.append(pd.DataFrame({"lang": lang, "source": names[a], "item": names[right][others], "value": value[others]}))
                if i != j:  # groups of one block compare both ways by themselves
                    out.append(out[-1].rename(columns={"source": "item", "item": "source"}))
        return pd.concat(out) if out else pd.DataFrame({"lang": [], "source": [], "item": [], "value": []})

    return map_groups(rows, ["lang", "shard", "i", "j"], shuffle_width(counts.sparkSession), compare,
                      "lang string, source string, item string, value long") \
        .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP, range_terms: int = RANGE_TERMS,
               block_bytes: int = BLOCK_BYTES, pair_terms: int = PAIR_TERMS, pair_sources: int = PAIR_SOURCES,
               lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): per source its divergence from each other source of its
    language (part 'pair') and the terms that it has more often than its language (part 'term')."""
    texts = _texts(docs, lang_col, source_col, text_col)
    transducers, named = vocabulary(kept_terms(texts, least), range_terms)
    counts = None
    for block in _blocks(transducers, block_bytes):
        own = stored(recounted(texts, block), "divergence_counts")
        counts = own if counts is None else counts.unionByName(own)
    if counts is None:  # no term is kept
        counts = texts.sparkSession.createDataFrame([], "lang string, source string, ordinal long, count long")
    terms = transducers.groupBy("lang").agg(F.sum("terms").alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    stats = stored(texts.groupBy("lang", "source").agg(F.lit(1).alias("one")).drop("one")
                   .join(totals, ["lang", "source"], "left").join(terms, "lang", "left")
                   .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"),
                           F.coalesce("terms", F.lit(0)).alias("terms")), "divergence_sources")

    sums = _pair_sums(counts, stats, pair_terms, pair_sources)
    pairs = stats.select("lang", "source").join(stats.select("lang", F.col("source").alias("item")), "lang") \
        .filter(F.col("source") != F.col("item")).join(sums, ["lang", "source", "item"], "left") \
        .withColumn("value", F.coalesce("value", F.lit(0)))
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by).alias("rank"))

    whole = counts.groupBy("lang", "ordinal").agg(F.sum("count").alias("lang_count"))
    sizes = stats.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    rows = counts.join(stats, ["lang", "source"]).join(sizes, "lang").join(whole, ["lang", "ordinal"]) \
        .select("lang", "source", "ordinal", share("count", "total", "terms").alias("p"),
                share("lang_count", "lang_total", "terms").alias("q")).filter("p > q") \
        .select("lang", "source", "ordinal", F.expr("(p - q) * (p - q) div (p + q)").alias("value")) \
        .withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)
    rows = rows.join(named, ["lang", "ordinal"]) \
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(rows)


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT d.lang, source, coalesce(v, 0) AS v FROM d LEFT JOIN v ON v.lang = d.lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
l AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
lt AS (SELECT lang, sum(n) AS total FROM l GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(s.total, 0) + 2 * g.v) AS p
  FROM g JOIN kept k ON k.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN s ON s.lang = g.lang AND s.source = g.source),
q AS (SELECT l.lang, l.term, 1 + (1000000000::HUGEINT * (l.n + 2)) // (lt.total + 2 * v.v) AS q
      FROM l JOIN lt USING (lang) JOIN v USING (lang)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
terms AS (SELECT p.lang, p.source, p.term AS item, ((p - q) * (p - q)) // (p + q) AS value
          FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term' AS part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms) WHERE rank <= 10
"""
