"""Toxicity by compression distance.

Two zstandard dictionaries are built from a bounded sample of labelled documents: one of ordinary text
and one of the same text followed by the toxic lexicon. Each window of a text is compressed with both;
how many bytes shorter the toxic dictionary makes it is the window's distance. Windows without toxic
words come out alike, as both dictionaries share their ordinary part. A logistic function over a text's
distances, fitted on sample documents that built no dictionary, gives the score.

The lexicon holds the words of toxic sample documents that begin with a prefix seen in far more
contexts (preceding words) in toxic than in ordinary documents; words shorter than a prefix, from three
letters on (two beyond ASCII), are prefixes of their own. Counting contexts, not
occurrences, keeps passages out that are merely copied between toxic documents.

The sample: about ``sample_docs`` documents of each class (twice as many ordinary ones), picked by a hash
of their ids; whole texts count.

Defined cases: a null or empty text has distance 0 everywhere and gets the score of that; without a
labelled toxic document every score is 0, without an ordinary one 1; repeated rows give repeated
rows; repeated labels of a document count as toxic if one is; an empty table gives an empty result; extra
columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import TMP, crc_mod, stored, text_or_empty

#: Documents of the sample, by class; bytes of ordinary text and of lexicon in the dictionaries.
SAMPLE_DOCS, ORDINARY_BYTES, LEXICON_BYTES = 1500, 1 << 16, 4096
#: Bytes of a window and from one to the next; letters of prefixes; how many times as many contexts.
WINDOW, STRIDE, PREFIX, CONTRAST = 96, 64, (4, 8), 10
LEVEL, MIN_MATCH, THRESHOLD = 3, 5, 0.3
#: Letters of the shortest words of the lexicon: with the blanks around it, what a dictionary can match.
SHORT = 3
FEATURES = 5


@dataclass(frozen=True)
class Model:
    ordinary: bytes = b""
    toxic: bytes = b""
    weights: tuple[float, ...] = field(default=())  # of the features, then the constant; () if fixed
    fixed: float = 0.0

    def score(self, text: str) -> float:
        if not self.weights:
            return self.fixed
        z = float(np.dot(self.weights, [*features(text, self.ordinary, self.toxic), 1.0]))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


@lru_cache(maxsize=4)
def _compressor(content: bytes):
    import zstandard
    params = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, min_match=MIN_MATCH, window_log=17, write_content_size=False, write_checksum=False,
        write_dict_id=False)
    return zstandard.ZstdCompressor(compression_params=params, dict_data=zstandard.ZstdCompressionDict(
        content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))


def features(text: str, ordinary: bytes, toxic: bytes) -> list[float]:
    """Of the windows' distances: the largest, the mean of the two largest, the mean, the share and
    (as a logarithm) the number above two bytes."""
    raw = text.lower().encode("utf-8")
    plain, own = _compressor(ordinary).compress, _compressor(toxic).compress
    windows = (raw[a:a + WINDOW] for a in range(0, max(1, len(raw) - (WINDOW - STRIDE)), STRIDE))
    d = np.fromiter((len(plain(w)) - len(own(w)) for w in windows), np.float64)
    high = np.sort(d)[-2:]
    return [d.max(), high.mean(), d.mean(), (d > 2).mean(), math.log1p((d > 2).sum())]


def _words(text: Column) -> Column:
    # only the ASCII letters and what lies beyond ASCII make words
    return F.array_remove(F.split(F.lower(text), "[\\x00-@\\[-`{-\\x7f]+"), "")


def lexicon(sample: DataFrame, size: int = LEXICON_BYTES) -> list[str]:
    """Most frequent last: words of toxic documents with a prefix of far more contexts there."""
    words = sample.select("toxic", _words(F.col("text")).alias("w"))
    pairs = words.select("toxic", F.explode(F.arrays_zip(
        F.col("w").alias("word"), F.concat(F.array(F.lit("")), F.col("w")).alias("before"))).alias("p")) \
        .select("toxic", F.col("p.word").alias("word"), F.pmod(F.xxhash64("p.before"), F.lit(4096)).alias("c")) \
        .filter((F.length("word") >= SHORT) | ((F.length("word") >= SHORT - 1) & (F.octet_length("word") > F.length("word"))))
    counted = pairs.groupBy("toxic", "word", "c").count()
    counted = stored(counted, "toxicity_words")
    prefixes = F.explode(F.sequence(F.least(F.lit(PREFIX[0]), F.length("word")),
                                    F.least(F.lit(PREFIX[1]), F.length("word"))))
    # a short word stands for itself, not for all that begins like it
    prefix = lambda n: F.when(F.length("word") < PREFIX[0], F.concat("word", F.lit(" "))) \
        .otherwise(F.substring(F.col("word"), F.lit(1), F.col(n)))
    contexts = counted.select("toxic", "word", "c", prefixes.alias("n")) \
        .select("toxic", "c", prefix("n").alias("prefix")).distinct() \
        .groupBy("prefix").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("plain"))
    docs = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    ratio = docs.get(1, 0) / max(1, docs.get(0, 0))
    telling = contexts.filter(
        F.col("toxic") - 2 * F.sqrt("toxic") > CONTRAST * (F.col("plain") + 0.5) * ratio).select("prefix")
    of_toxic = counted.filter("toxic = 1").groupBy("word").agg(F.sum("count").alias("n"))
    found = of_toxic.select("word", "n", prefixes.alias("k")) \
        .withColumn("prefix", prefix("k")) \
        .join(telling, "prefix", "left_semi").groupBy("word").agg(F.max("n").alias("n"))
    top = found.orderBy(F.desc("n"), "word").limit(size // SHORT).collect()
    out, left = [], size
    for r in top:
        left -= len(r["word"].encode("utf-8")) + 2
        if left < 0:
            break
        out.append(r["word"])
    return out[::-1]


def _sample(docs: DataFrame, labels: DataFrame, sample_docs: int, id_col: str, text_col: str) -> DataFrame:
    """(id hash, text, toxic) of the sampled labelled documents that may be learnt from."""
    known = labels.filter(F.col("toxic").isin(0, 1) & ~held_out(id_col) & F.col(id_col).isNotNull()) \
        .groupBy(id_col).agg(F.max("toxic").cast("long").alias("toxic"))
    n = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    order = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 20))
    share = {c: int(min(1.0, sample_docs * (2 - c) / n[c]) * (1 << 20)) + 1 for c in n}
    chosen = known.filter(order < F.when(F.col("toxic") == 1, share.get(1, 0)).otherwise(share.get(0, 0)))
    # about 3 * sample_docs ids
    return docs.select(id_col, text_or_empty(text_col).alias("text")) \
        .join(F.broadcast(chosen), id_col).select(order.alias("order"), "text", "toxic")


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id",
          text_col: str = "text") -> Model:
    sample = stored(_sample(docs, labels, sample_docs, id_col, text_col), "toxicity_sample")
    classes = {r[0] for r in sample.select("toxic").distinct().collect()}
    if classes != {0, 1}:
        return Model(fixed=1.0 if classes == {1} else 0.0)
    builds = F.col("order") % 3 != 0
    building = sample.filter(builds)
    words = lexicon(building)
    if not words:
        return Model(fixed=0.0)
    at = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - WINDOW, F.lit(1))).cast("int") + 1
    plain = building.filter("toxic = 0").orderBy("order", "text").limit(ORDINARY_BYTES // WINDOW * 2) \
        .select(F.lower(F.substring(F.col("text"), at, F.lit(WINDOW)))).collect()
    ordinary = "\n".join(r[0] for r in plain).encode("utf-8")[:ORDINARY_BYTES]
    model = Model(ordinary, ordinary + "".join(f" {w} " for w in words).encode("utf-8"))
    return Model(model.ordinary, model.toxic, _fitted(sample.filter(~builds), model))


def _fitted(rest: DataFrame, model: Model) -> tuple[float, ...]:
    """Logistic regression (Newton's steps, a small ridge) on the features of a bounded sample."""
    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = [features(t, model.ordinary, model.toxic) for t in b["text"]]
            yield pd.DataFrame(x, columns=list("abcde")).assign(y=b["toxic"].to_numpy())

    got = rest.mapInPandas(measure, "a double, b double, c double, d double, e double, y long").toPandas()
    x, y = np.c_[got[list("abcde")].to_numpy(), np.ones(len(got))], got["y"].to_numpy(float)
    w, ridge = np.zeros(FEATURES + 1), 0.05 * np.eye(FEATURES + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(crc_mod(id_col, 4) == 2, F.lit(False))


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """The score of each text, as a column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of bounded size

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        own = shared.value
        return pd.Series([own.score(t) for t in texts], dtype="float64")

    return score(text_or_empty(text_col))


def toxicity(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS,
             threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, held_out (not learnt from), score and predicted (1 from ``threshold`` on)."""
    model = train(docs, labels, sample_docs, id_col, text_col)
    out = docs.select(id_col, text_col)
    return out.select(id_col, held_out(id_col).alias("held_out"), scored(out, model, text_col).alias(TMP + "s")) \
        .select(id_col, "held_out", F.col(TMP + "s").alias("score"),
                (F.col(TMP + "s") >= threshold).cast("int").alias("predicted"))
