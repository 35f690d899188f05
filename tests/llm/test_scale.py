"""Bounds and rests: re-encoded lengths, samples, memos, searches over more than one cell, odd rows through
the whole pipeline."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from stratum.llm import byte_bpe, language_id, neighbours, packing, pretokens, quality_rules, toxicity
from stratum.llm.common import ready
from tests.llm.test_operators import ODD, rows


def test_byte_bpe_encodes_seams_once(monkeypatch):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tree = byte_bpe.TreeBpe(byte_bpe.load_ranks(path), public_tokenizers.PATTERN)
    seen = []
    leaf = byte_bpe.TreeBpe.leaf
    monkeypatch.setattr(byte_bpe.TreeBpe, "leaf", lambda self, t: seen.append(len(t)) or leaf(self, t))
    for text in ("plain words of prose go on and on. " * 25_000, "q" + "ab " * 60_000, "a b" * 70_000):
        seen.clear()
        assert tree.encode(text) == tree.library.encode_ordinary(text)
        assert sum(seen) < 0.2 * len(text) and max(seen, default=0) <= 1024


def test_quality_sample_is_drawn_by_every_task(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    many = docs.repartition(40)
    drawn = many.select("text").sample(min(1.0, 50 / many.count()), seed=17)
    assert "Limit" not in drawn._jdf.queryExecution().executedPlan().toString()
    ordered = quality_rules.ordered_rules(many, quality_rules.RULES, 50)
    assert {r.name for r in ordered} == {r.name for r in quality_rules.RULES}
    assert rows(quality_rules.quality(many, 50)) == rows(quality_rules.quality(docs, 10**6))


def test_language_rows_without_ids_are_sampled(spark):
    ready(spark)
    df = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("word number "), "id").alias("text"), F.lit("en").alias("lang"))
    bucket = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.col("text")), F.lit(1 << 20))
    n = df.filter(bucket < int(200 / 4000 * (1 << 20)) + 1).count()
    assert 100 < n < 400
    assert language_id.train(df, 200).languages == ["en"]


def test_short_words_enter_the_lexicon(spark):
    pick = np.random.default_rng(4)
    words = ["".join(pick.choice(list("aeioulmnrst"), pick.integers(3, 9))) for _ in range(2000)]
    made = []
    for i in range(900):
        text = list(pick.choice(words, 120))
        if i % 3 == 0:
            for at in pick.choice(120, 5, replace=False):
                text[at] = str(pick.choice(["zog", "vux", "ßö"]))
        made.append((" ".join(text), int(i % 3 == 0)))
    sample = spark.createDataFrame(made, "text string, toxic long")
    assert {"zog", "vux", "ßö"} <= set(toxicity.lexicon(sample))


def test_memos_are_bounded_by_bytes():
    memo = pretokens.ByteMemo(lambda k: k.encode() * 3, 10_000)
    for i in range(5000):
        assert memo[f"word{i}"] == f"word{i}".encode() * 3
    assert memo.held <= 10_000 and len(memo) + len(memo.old) < 120


def test_packing_numbers_step_groups_through_all_tasks(spark, monkeypatch):
    ready(spark)
    monkeypatch.setattr(packing, "PARTS", 3)   # blocks of tasks
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.expr("repeat('some words here ', cast(id % 60 as int))").alias("text")).repartition(17)
    out = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), step_tokens=512).toPandas()
    for tier, own in out.groupby("tier"):
        steps = own.drop_duplicates("sequence_id").groupby("step_group").size()
        per = max(1, 512 // tier)
        assert steps.index.tolist() == list(range(len(steps))) and (steps.iloc[:-1] == per).all() and steps.iloc[-1] <= per


@pytest.mark.parametrize("kind", ["random", "mixed", "copies"])
def test_nearest_among_many_cells(spark, monkeypatch, kind):
    ready(spark)
    monkeypatch.setattr(neighbours, "CELL", 512)   # many cells, crowded ones among them
    pick = np.random.default_rng(8)
    m = pick.normal(size=(6000, 32))
    if kind == "mixed":
        m *= pick.lognormal(0, 0.6, (6000, 1))
    if kind == "copies":
        m[1500:4500] = m[0] + pick.normal(size=(3000, 32)) * 1e-4
    m = m.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<float>")
    asked = list(range(0, 6000, 40))
    got = neighbours.nearest(df, spark.createDataFrame([(i,) for i in asked], "query_id long")).toPandas()
    m, ids, hits = m.astype(float), np.arange(len(m)), 0
    for q in asked:
        s = m @ m[q]
        s[q] = -np.inf
        hits += len(set(np.lexsort((ids, -s))[:20]) & set(got[got.query_id == q].vec_id))
    assert len(got) == 20 * len(asked) and hits / (20 * len(asked)) >= 0.95
    none = neighbours.nearest(df.limit(50), spark.createDataFrame([], "query_id long"))
    assert none.count() == 0


def test_pipeline_stages_on_odd_rows(spark, sf):
    """Nulls, repeated ids and rows, an empty table, through all stages; packed tokens are the library's."""
    ready(spark)
    real = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(i, t, "en") for i, t in ODD], "doc_id long, text string, lang string")
    twice = real.limit(40)
    docs = real.unionByName(twice).unionByName(odd, allowMissingColumns=True).unionByName(
        twice.withColumn("doc_id", F.lit(None).cast("long")))
    for table in (docs, docs.limit(0)):
        own = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            own = stage(spark, own, sf)
            assert own.columns == docs.columns, name
        packed = corpus_pipeline.STAGES[-1][1](spark, own, sf)
        want, tokenizer = [], Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
        for r in own.collect():
            ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
            want.append((r.doc_id, len(ids)))
        got = packed.groupBy("doc_id").agg(F.sum("length")).collect()
        sums = {}
        for d, n in want:
            sums[d] = sums.get(d, 0) + n
        assert {tuple(r) for r in got} == set(sums.items())
