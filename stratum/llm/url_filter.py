"""URL filter: rules first, then gradient-boosted trees on lexical features, in DataFrame functions.

The rules label the urls they fit. A bounded sample of those labelled urls trains the trees, which
judge the urls that no rule fits. Features: lengths of url, host and path, depth of path and host, share
of digits, character entropy, number of parameters, and how often the sample blocks the host's suffix.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up
to ``?``, ``#`` or the end. A rule ``host/path`` fits its host and all subdomains if the url's path
starts with the rule's path (its ``/`` included); the longest rule wins.

Defined cases: a null url or one without ``://`` has an empty host and path and fits no rule; with
labelled urls of one verdict only that verdict is given, and with none ``allow``; repeated rows give
repeated rows; an empty table gives an empty result; extra columns don't matter.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import TMP, stored

#: (verdict, rule) as the contract states them.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
#: Labelled urls that train the trees and suffix statistics, about; trees and their depth.
TRAIN_ROWS, TREES, DEPTH = 20_000, 10, 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ("url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "entropy",
            "parameters", "suffix_rate")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), \
            F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text)

    def bits(c):
        p = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return -p * F.log2(p)

    chars = F.array_remove(F.array_distinct(F.split(text, "")), "")
    return F.aggregate(F.transform(chars, bits), F.lit(0.0), lambda a, b: a + b)


def lexical(pages: DataFrame, url_col: str, keep: list[str], rules=RULES) -> DataFrame:
    """host, path, rule, rule's verdict, suffix and the lexical features of each url."""
    u = F.coalesce(F.col(url_col), F.lit(""))
    df = pages.select(*keep, u.alias(TMP + "url"))
    u = F.col(TMP + "url")
    host, path = host_and_path(u)
    df = df.withColumns({"host": host, "path": path})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    count = lambda col, pattern: F.regexp_count(col, F.lit(pattern)).cast("double")
    return df.withColumns({
        "rule": rule, TMP + "verdict": verdict,
        TMP + "suffix": F.substring_index(F.col("host"), ".", -1),
        TMP + "url_length": F.length(u).cast("double"),
        TMP + "host_length": F.length("host").cast("double"),
        TMP + "path_length": F.length("path").cast("double"),
        TMP + "depth": count(F.col("path"), "/[^/]"), TMP + "labels": count(F.col("host"), "\\."),
        TMP + "digit_ratio": count(u, "[0-9]") / F.greatest(F.length(u), F.lit(1)),
        TMP + "entropy": entropy(u),
        TMP + "parameters": count(u, "[?&][^&#=]+="),
    })


def _with_suffix_rate(df: DataFrame, suffixes: DataFrame, base: float) -> DataFrame:
    """Share of blocked urls of the host's suffix in the sample, drawn to the sample's share."""
    rate = (F.coalesce(F.col(TMP + "blocked"), F.lit(0)) + 20 * base) \
        / (F.coalesce(F.col(TMP + "seen"), F.lit(0)) + 20)
    # one row per suffix of a bounded sample
    return df.join(F.broadcast(suffixes), TMP + "suffix", "left").withColumn(TMP + "suffix_rate", rate)


def judged(pages: DataFrame, rules=RULES, train_rows: int = TRAIN_ROWS, url_col: str = "url",
           id_col: str = "page_id") -> DataFrame:
    """Per row: the id, host, path, rule (null if none fits), verdict, and blocked_score of the trees
    (null where a rule decides)."""
    urls = lexical(pages, url_col, [id_col], rules)
    labelled = urls.filter(F.col("rule").isNotNull())
    n = labelled.count()
    # a share of the labelled urls by a hash of the url, about train_rows of them at any size
    share = min(1.0, train_rows / n) if n else 1.0
    bucket = F.pmod(F.xxhash64(TMP + "url", id_col), F.lit(1_000_000))
    sample = stored(labelled.filter(bucket < int(share * 1_000_000) + 1)
                    .withColumn("label", (F.col(TMP + "verdict") == "block").cast("double")), "url_sample")
    blocked, total = sample.agg(F.sum("label"), F.count("*")).collect()[0]
    blocked = blocked or 0.0
    if total and 0 < blocked < total:
        suffixes = stored(sample.groupBy(TMP + "suffix").agg(
            F.sum("label").alias(TMP + "blocked"), F.count("*").alias(TMP + "seen")), "url_suffixes")
        to_vector = VectorAssembler(inputCols=[TMP + f for f in FEATURES], outputCol=TMP + "features")
        model = GBTClassifier(labelCol="label", featuresCol=TMP + "features", maxIter=TREES,
                              maxDepth=DEPTH, seed=7, predictionCol=TMP + "prediction")
        model.setProbabilityCol(TMP + "probability").setRawPredictionCol(TMP + "raw")
        base = blocked / total
        fitted = model.fit(to_vector.transform(_with_suffix_rate(sample, suffixes, base)))
        from pyspark.ml.functions import vector_to_array
        out = fitted.transform(to_vector.transform(_with_suffix_rate(urls, suffixes, base)))
        score = F.get(vector_to_array(F.col(TMP + "probability")), 1)
    else:
        out, score = urls, F.lit(1.0 if blocked else 0.0)
    own = F.when(score >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return out.select(id_col, "host", "path", "rule",
                      F.coalesce(F.col(TMP + "verdict"), own).alias("verdict"),
                      F.when(F.col("rule").isNull(), score).alias("blocked_score"))
