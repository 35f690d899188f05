"""Language identification by error-correcting output codes.

Each language has a codeword; for each bit, a binary n-gram classifier tells the languages whose
codeword has a 1 there from the others. It is trained from n-gram counts per language: its weight for an
n-gram is the log ratio of the n-gram's smoothed shares in both groups, averaged over the languages of a
group. A text's margins (mean weight per n-gram, scaled) are decoded with a loss that weighs each
bit by how sure its classifier was in training: the nearest codeword wins, its share of
exp(-loss) is the score, and texts whose two nearest codewords are close are flagged as ambiguous.

N-grams are byte 3-grams of the lower-cased text with all but letters as blanks, hashed to buckets.

Training takes a bounded sample: about ``train_rows`` labelled documents of each language, picked by a
hash of their ids; their whole texts count.

Defined cases: a text that is null or has no letter is ``und`` with score 0; without any labelled row
all are ``und``; with one language, that one is given with score 1; repeated rows give repeated rows; an
empty table gives an empty result; extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import TMP, crc_mod

UNKNOWN = "und"
#: Buckets of n-grams, documents of a language in the training sample, and bytes handled at a time.
BUCKETS, TRAIN_ROWS, CHUNK = 1 << 15, 2000, 1 << 20
#: Margin between the two nearest codewords' shares below which a text is ambiguous; a factor
#: that brings mean log ratios to the scale of the loss.
AMBIGUOUS, SCALE = 0.1, 8.0
#: ASCII characters that aren't letters become blanks.
_BLANKED = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
_LETTER = regex.compile(r"\p{L}")


def buckets(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of a text's 3-grams, some at a time."""
    raw = np.frombuffer(b" " + text.lower().encode("utf-8").translate(_BLANKED) + b" ", np.uint8)
    for a in range(0, len(raw) - 2, CHUNK):
        x = raw[a:a + CHUNK + 2].astype(np.uint32)
        gram = (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]
        yield (gram * np.uint32(2654435761)) >> np.uint32(32 - 15)


def codewords(n: int) -> np.ndarray:
    """n codewords of +1 / -1: all splits of the languages for up to 6, else random ones far apart."""
    if n <= 6:
        masks = range(1, 1 << (n - 1))
        return np.array([[1 if (m >> i) & 1 else -1 for m in masks] for i in range(n)], np.float32)
    pick = np.random.default_rng(11)
    width = int(np.ceil(10 * np.log2(n)))
    codes = [pick.choice(np.float32([-1, 1]), (n, width)) for _ in range(50)]

    def nearest(c):
        return ((width - c @ c.T) / 2 + width * np.eye(n)).min()

    best = max(codes, key=nearest)
    return best[:, np.abs(best.sum(axis=0)) < n]  # a bit that all share tells nothing


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    trust: np.ndarray  # by bit

    def margins(self, text: str) -> np.ndarray:
        total, n = np.zeros(self.codes.shape[1]), 0
        for b in buckets(text):
            total += self.weights[b].sum(axis=0, dtype=np.float64)
            n += len(b)
        return SCALE * total / max(1, n)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if text is None or not self.languages or _LETTER.search(text) is None:
            return UNKNOWN, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        loss = (self.trust * np.log1p(np.exp(-np.clip(self.codes * self.margins(text), -30, 30)))).sum(axis=1)
        share = np.exp(loss.min() - loss)
        share /= share.sum()
        first = int(loss.argmin())
        second = np.partition(share, -2)[-2]
        return self.languages[first], float(share[first]), bool(share[first] - second < AMBIGUOUS)


def model_of(counts: dict[str, np.ndarray]) -> Model:
    languages = sorted(counts)
    if len(languages) < 2:
        return Model(languages, np.zeros((len(languages), 0)), np.zeros((BUCKETS, 0)), np.zeros(0))
    share = np.stack([(counts[x] + 0.5) / (counts[x].sum() + 0.5 * BUCKETS) for x in languages])
    codes = codewords(len(languages))
    group = [(share[codes[:, k] > 0].mean(axis=0), share[codes[:, k] < 0].mean(axis=0))
             for k in range(codes.shape[1])]
    weights = np.stack([np.log(p / q) for p, q in group], axis=1).astype(np.float32)
    # how far a bit's classifier puts the training languages on their side, on average
    sides = np.stack([s @ weights for s in share]) * codes
    trust = np.clip(sides, 0, None).mean(axis=0)
    return Model(languages, codes, weights, trust / trust.mean() if trust.mean() > 0 else np.ones_like(trust))


def train(labelled: DataFrame, train_rows: int = TRAIN_ROWS, text_col: str = "text",
          label_col: str = "lang", id_col: str = "doc_id") -> Model:
    """``labelled``: the rows that may be learnt from; those without label or text are left out."""
    labelled = labelled.filter(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    per_language = {r[0]: r[1] for r in labelled.groupBy(label_col).count().collect()}
    if not per_language:
        return model_of({})
    # of id and text: rows without an id differ by their texts
    bucket = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)), F.lit(1 << 20))
    chosen = reduce(Column.__or__, [
        (F.col(label_col) == x) & (bucket < int(min(1.0, train_rows / n) * (1 << 20)) + 1)
        for x, n in per_language.items()])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for b in batches:
            for label, text in zip(b["label"], b["text"]):
                own = totals.setdefault(label, np.zeros(BUCKETS, np.int64))
                for g in buckets(text):
                    own += np.bincount(g, minlength=BUCKETS)
        for label, own in totals.items():
            at = np.flatnonzero(own)
            yield pd.DataFrame({"label": label, "bucket": at, "n": own[at]})

    rows = labelled.filter(chosen).select(F.col(label_col).alias("label"), F.col(text_col).alias("text")) \
        .mapInPandas(count, "label string, bucket int, n long") \
        .groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas()  # languages x buckets at most
    return model_of({x: np.bincount(g["bucket"], g["n"], BUCKETS) for x, g in rows.groupby("label")})


def identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with the working column ``language``: a struct of lang, score and ambiguous."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x bits floats

    @F.pandas_udf("lang string, score double, ambiguous boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        own = shared.value
        return pd.DataFrame([own.predict(t) for t in texts], columns=["lang", "score", "ambiguous"])

    return docs.withColumn(TMP + "language", predict(F.col(text_col)))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(crc_mod(id_col, 3) == 1, F.lit(False))


def languages(docs: DataFrame, train_rows: int = TRAIN_ROWS, text_col: str = "text",
              id_col: str = "doc_id") -> DataFrame:
    """Per row: the id, held_out (not learnt from), lang_pred, score, ambiguous."""
    out = docs.select(id_col, text_col, "lang").withColumn(TMP + "out", held_out(id_col))
    model = train(out.filter(~F.col(TMP + "out")), train_rows, text_col, "lang", id_col)
    got = F.col(TMP + "language")
    return identified(out, model, text_col).select(
        id_col, F.col(TMP + "out").alias("held_out"), got["lang"].alias("lang_pred"),
        got["score"].alias("score"), got["ambiguous"].alias("ambiguous"))


def keep_known(docs: DataFrame, train_rows: int = TRAIN_ROWS, text_col: str = "text",
               id_col: str = "doc_id") -> DataFrame:
    """The rows whose language is told clearly (not ``und``, not ambiguous), columns as they were."""
    model = train(docs.filter(~held_out(id_col)), train_rows, text_col, "lang", id_col)
    got = F.col(TMP + "language")
    return identified(docs, model, text_col) \
        .filter((got["lang"] != UNKNOWN) & ~got["ambiguous"]).select(*[F.col(f"`{c}`") for c in docs.columns])
