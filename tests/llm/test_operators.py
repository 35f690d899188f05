"""Each operator against the library, brute force or an exact round trip, and on the odd cases: nulls,
empty and long texts, ties, repeated rows, empty tables, extra columns with clashing names."""

import hashlib
import struct
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from stratum.llm import (
    byte_bpe, chat_format, language_id, neighbours, packing, pretokens, quality_rules, simhash, token_count,
    toxicity, url_filter,
)
from stratum.llm.common import table

ODD = [(0, None), (1, ""), (2, " \n\t "), (3, "a<|endoftext|>b  <|endoftext|>"), (4, "x" * 20_000),
       (5, "日本語。" * 3000 + " a b"), (6, "it's  x\x1c\x85z İŉ ﬁ ẞ 😀's \n\n y"), (7, "the cat " * 3000),
       (7, "the cat " * 3000), (None, "no id here"), (8, "\n" * 500), (9, "é" * 999 + "!!!'s 12345")]
DOCS = "doc_id long, text string, lang string, n_words string, component_id string, score string"


@pytest.fixture(scope="module")
def odd(spark):
    from stratum.llm.common import ready
    ready(spark)
    return spark.createDataFrame([(i, t, "en", "x", "y", "z") for i, t in ODD], DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return table(spark, sf, "documents")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_classes_below_0250_are_the_libraries():
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for c in map(chr, range(0x250)):
        for text in (f"a{c}b", f"1{c}2", f"!{c}?", f" {c} x", f"{c}{c} {c}"):
            found = [text[a:b] for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(text)]
            assert pretokens.FAST.findall(text) == found, repr(text)


def test_token_counts(odd, docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    for df in (odd, docs):
        want = [(r.doc_id, len((r.text or "").encode()), n, n > 1024) for r in df.collect()
                for n in [len(tok.encode(r.text or "", add_special_tokens=False).ids)]]
        assert rows(token_count.token_counts(df, path)) == sorted(want, key=repr)
    assert token_count.token_counts(odd.limit(0), path).count() == 0


def test_byte_bpe(odd, docs, monkeypatch):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = byte_bpe.load_ranks(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for df in (odd, docs):
        want = []
        for r in df.collect():
            ids = library.encode_ordinary(r.text or "")
            want.append((r.doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                         hashlib.sha256((r.text or "").encode()).hexdigest()))
        assert rows(byte_bpe.encode_decode(df, path, public_tokenizers.PATTERN)) == sorted(want, key=repr)
    both = byte_bpe.decode_ids(byte_bpe.encode_decode(odd, path, public_tokenizers.PATTERN, with_ids=True),
                               path, public_tokenizers.PATTERN)
    assert rows(both) == rows(odd.select("doc_id", F.coalesce("text", F.lit(""))))
    monkeypatch.setattr(byte_bpe, "TEXT_LEAF", 16)  # many seams and joins
    monkeypatch.setattr(byte_bpe, "WINDOW", 32)
    monkeypatch.setattr(byte_bpe, "PIECE_LEAF", 4)
    tree = byte_bpe.TreeBpe(ranks, public_tokenizers.PATTERN)
    for text in [t for _, t in ODD if t] + [r.text for r in docs.limit(20).collect()]:
        assert tree.encode(text[:4000]) == library.encode_ordinary(text[:4000])


def test_every_token_of_the_vocabulary_encodes_to_itself():
    # what the proof by adjacent pairs rests on
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    tree = byte_bpe.TreeBpe(ranks, public_tokenizers.PATTERN)
    for raw, i in list(ranks.items())[::7]:
        assert tree.merged(raw) == [i]


def check_packing(df, out, path):
    tok = Tokenizer.from_file(path)
    want = {}
    for r in df.collect():
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 1]
        want.setdefault(r.doc_id, []).append(ids)
    pieces, sequences = {}, {}
    for r in out.collect():
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == set(want)
    for doc, copies in want.items():
        own = pieces[doc]
        assert sum(p.length for p in own) == sum(map(len, copies))
        for p in own:
            assert any(len(ids) == p.doc_tokens and zlib.crc32(
                struct.pack(f"<{p.length}I", *ids[p.start:p.start + p.length])) == p.ids_crc32 for ids in copies)
        at = sorted((p.start, p.start + p.length) for p in own)
        if len(copies) == 1:
            assert [a for a, _ in at] == [0, *[b for _, b in at[:-1]]]
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        n = sum(p.length for p in own)
        assert [p.offset for p in own] == list(np.cumsum([0, *[p.length for p in own[:-1]]]))
        assert n <= 2048 and n & (n - 1) == 0 and {p.tier for p in own} == {n}
    return sequences


def test_packing(odd, docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    check_packing(odd, packing.pack(odd, path), path)
    sequences = check_packing(docs, packing.pack(docs, path), path)
    steps = {}
    for own in sequences.values():
        steps.setdefault((own[0].tier, own[0].step_group), []).append(own)
    full = {tier: packing.STEP_TOKENS // tier for tier, _ in steps}
    for (tier, step), own in steps.items():  # all steps but a tier's last are full
        assert len(own) == full[tier] or step == max(s for t, s in steps if t == tier)
    assert packing.pack(odd.limit(0), path).count() == 0


def test_word_ids_of_every_code_point_below_0250():
    path = public_tokenizers.path("word_bpe_49k.json")
    tok, ids = Tokenizer.from_file(path), packing.word_ids(path)
    for c in [*map(chr, range(0x250)), "\u212a", "\u212b", "\u1e9e"]:
        for text in (f"a{c}b", f"{c}li", f"1{c}2", f"!{c}?", f" {c} x", f"{c}{c} {c}", f"it{c}'s"):
            want = tok.encode(text, add_special_tokens=False).ids
            assert ids(text) == struct.pack(f"<{len(want)}I", *want), repr(text)


def test_quality_rules(spark, sf, odd, docs):
    con = duckdb.connect()
    for df in (docs, odd.filter("doc_id is not null")):
        pdf = df.select("doc_id", "text").toPandas()  # noqa: F841
        con.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM pdf")
        got = quality_rules.quality(df)
        want = con.execute(quality_rules.ORACLE_SQL).df()
        order = got.columns
        assert rows(got) == sorted(want[order].astype(object).itertuples(index=False, name=None), key=repr)
        kept = quality_rules.keep_good(df)
        assert kept.columns == df.columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got.filter("kept").collect())
    assert quality_rules.keep_good(odd.limit(0)).count() == 0


def test_quality_uses_no_python(docs):
    assert "Python" not in quality_rules.keep_good(docs)._jdf.queryExecution().toString()


def test_url_filter(spark, sf):
    def rule(host, path):
        fits = [(len(r), r, v) for v, r in url_filter.RULES
                if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
                and path.startswith("/" + r.split("/", 1)[1])]
        return max(fits)[1:] if fits else (None, None)

    odd = [(1, None, "a"), (2, "", "b"), (3, "no scheme", "c"), (4, "http://COM", "d"), (5, "http://A.Com/x?y#z", "e"),
           (6, "x://Www.example.com/en/?a=b://c", "f"), (7, "http://notnet/fr/", "g"), (7, "http://notnet/fr/", "g"),
           (8, "h://example.com/en/" + "q" * 9000, "h"), (None, "http://b.net/es/", "i"), (9, "a://#x/com/", "j")]
    df = spark.createDataFrame(odd, "page_id long, url string, verdict string")
    for pages in (df, table(spark, sf, "pages")):
        got = url_filter.judged(pages).collect()
        assert len(got) == pages.count()
        urls = {r.page_id: r.url for r in pages.collect()}
        for r in got:
            rest = (urls[r.page_id] or "").partition("://")[2]
            host = rest[:min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])]
            path = rest[len(host):]
            path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
            name, verdict = rule(low, path)
            assert (r.host, r.path, r.rule) == (low, path, name)
            assert r.verdict == (verdict or ("block" if r.blocked_score >= 0.5 else "allow"))
    assert url_filter.judged(df.limit(0)).count() == 0
    assert {r.verdict for r in url_filter.judged(df.filter("page_id = 7")).collect()} == {"allow"}


def test_language_id(odd, docs):
    got = language_id.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.99 and got.score.between(0, 1).all()
    want = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in docs.collect()}
    assert want == dict(zip(got.doc_id, got.held_out))
    one = {r.doc_id: r for r in language_id.languages(odd).collect()}
    assert one[0].lang_pred == one[1].lang_pred == one[2].lang_pred == "und" and one[7].lang_pred == "en"
    assert language_id.languages(odd.limit(0)).count() == 0
    assert language_id.keep_known(docs).count() == docs.count()
    assert language_id.keep_known(odd).columns == odd.columns


def test_codewords_are_apart():
    for n in (2, 4, 6, 40):
        codes = language_id.codewords(n)
        apart = (codes.shape[1] - codes @ codes.T) / 2
        assert (apart + codes.shape[1] * np.eye(n)).min() >= max(1, codes.shape[1] // 4)


def linked(fps, ids, bits=2):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(find(i), []).append(ids[i])
    names = {k: min([i for i in v if i is not None], default=None) for k, v in groups.items()}
    return [names[find(i)] for i in range(len(fps))]


def plain_fingerprint(text):
    import xxhash
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else \
        [b" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


@pytest.mark.parametrize("shard, block", [(2048, 8192), (8, 16)])
def test_simhash(odd, docs, shard, block):
    for df in (odd, docs):
        own = df.collect()
        fps = [plain_fingerprint(r.text) for r in own]
        want = sorted(zip([r.doc_id for r in own], [f"{f:016x}" for f in fps],
                          linked(fps, [r.doc_id for r in own])), key=repr)
        assert rows(simhash.near_duplicates(df, shard=shard, block=block)) == want
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    by = {}
    for r, c in zip(own := odd.collect(), linked([plain_fingerprint(r.text) for r in own], [r.doc_id for r in own])):
        by.setdefault(c, r)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(i for i in by if i is not None)


def test_keep_one_tells_rows_by_id_and_text(spark):
    a, b, c = ("one two three four five six", "red green blue black white pink", "up down left right in out")
    own = [(1, a), (5, a), (5, b), (5, b), (6, b), (None, a), (None, c), (None, c)]
    for part in (own, own[::-1]):
        kept = simhash.keep_one(spark.createDataFrame(part, "doc_id long, text string").coalesce(1))
        assert rows(kept) == sorted([(1, a), (5, b), (None, c)], key=repr)


def test_simhash_finds_chains(spark):
    # each differs from the last by two bits: one component, across all shards
    start = np.random.default_rng(1).integers(0, 2**63, 400)
    fps = sorted({int(s) ^ (0b11 << (2 * k)) * (k > 0) for s in start for k in range(6)})
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r.fp: r.root for r in simhash.components(simhash.links(nodes, 2, shard=16, block=64)).collect()}
    want = linked([f for f in fps], fps)
    assert [got.get(f, f) for f in fps] == want


def test_nearest(spark, sf, odd):
    vectors = table(spark, sf, "embeddings")
    asked = vectors.filter("vec_id % 20 = 0").selectExpr("vec_id query_id")
    got = neighbours.nearest(vectors, asked).toPandas()
    pdf = vectors.toPandas()
    m, ids = np.stack(pdf.embedding).astype(float), pdf.vec_id.to_numpy()
    hits = 0
    for q, g in got.groupby("query_id"):
        s = m @ m[ids == q][0]
        s[ids == q] = -np.inf
        hits += len(set(ids[np.lexsort((ids, -s))[:20]]) & set(g.vec_id))
        assert sorted(g["rank"]) == list(range(1, 21))
    assert hits / len(got) >= 0.9
    odd = [(i, v) for i, v in enumerate([[1.0, 0.0], [0.0, 0.0], None, [1.0, None], [float("nan"), 1.0], [1.0, 0.0],
                                         [0.5, 0.5], [1.0], [float("inf"), 0.0], [-1.0, 0.0]])]
    df = spark.createDataFrame([*odd, odd[0], (None, [1.0, 1.0])], "vec_id long, embedding array<double>") \
        .withColumn("rank", F.lit("x"))
    one = neighbours.nearest(df, spark.createDataFrame([(0,), (1,), (5,)], "query_id long"))
    assert rows(one) == [(0, 1, 5, 1.0), (0, 2, 6, 0.5), (0, 3, 9, -1.0), (5, 1, 0, 1.0), (5, 2, 6, 0.5), (5, 3, 9, -1.0)]
    assert neighbours.nearest(df.limit(0), spark.createDataFrame([(0,)], "query_id long")).count() == 0


@pytest.mark.parametrize("unit", [False, True])
def test_nearest_tells_near_copies_apart(spark, unit):
    pick = np.random.default_rng(7)
    m = pick.normal(size=(4000, 64))
    m[1000:] = m[0] + 1e-4 * pick.normal(size=(3000, 64))
    m = (m / np.linalg.norm(m, axis=1, keepdims=True) if unit else m).astype(np.float32)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<float>")
    asked = list(range(1000, 4000, 50))
    got = neighbours.nearest(vectors, spark.createDataFrame([(i,) for i in asked], "query_id long")).toPandas()
    m, ids, hits = m.astype(float), np.arange(len(m)), 0
    for q in asked:
        s = m @ m[q]
        s[q] = -np.inf
        hits += len(set(np.lexsort((ids, -s))[:20]) & set(got[got.query_id == q].vec_id))
    assert hits / (20 * len(asked)) >= 0.95


def test_chat_format(spark, sf):
    calls = spark.createDataFrame([
        (1, "a", 0, "search", '{"turn": 1, "query": "x"}', None), (1, "b", 2, "search", '{"query":"y"}', "a"),
        (1, "c", 4, "nope", "{}", "b"), (1, "d", 6, "summarise", "not json", "e"), (1, "e", 8, "search", None, "d"),
        (1, "f", 9, "search", '{"turn":"1","query":"x"}', "gone"), (1, "f", 9, "search", '{"turn":"1","query":"x"}', "gone"),
        (1, "g", 9, "search", '{"turn":1,"query":"x","more":2}', None), (None, "h", 0, "search", "{}", None)],
        "conv_id long, call_id string, turn long, tool string, arguments string, depends_on string")
    results = spark.createDataFrame([(1, "a", 1, 'says "hi"\n'), (1, "zzz", 3, "no call"), (1, "b", 5, None)],
                                    "conv_id long, call_id string, turn long, content string")
    got = {r.call_id: r for r in chat_format.linked_calls(calls, results).collect()}
    assert {k: r.depth for k, r in got.items()} == {"a": 0, "b": 1, "c": 2, "d": None, "e": None, "f": 0, "g": 0}
    assert {k for k, r in got.items() if r.valid} == {"a"} and {k for k, r in got.items() if r.linked} == {"a", "b"}
    assert got["f"].n_calls == 2 and [got[k].position for k in "afgbcde"] == list(range(1, 8))
    assert got["a"].record == ('{"arguments":{"query":"x","turn":1},"id":"a","parent":null,'
                               '"result":"says \\"hi\\"\\n","tool":"search","valid":true}')
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    out = chat_format.linked_calls(*chat_format.calls_of(table(spark, sf, "conversations")))
    want = con.execute(chat_format.ORACLE_SQL).df()[out.columns]
    assert rows(out) == sorted(want.astype(object).itertuples(index=False, name=None), key=repr)
    assert chat_format.linked_calls(calls.limit(0), results).count() == 0


def test_toxicity(spark, odd, docs):
    insults = ["snarfle", "blorgish", "quzzle", "vexlump"]
    pick = np.random.default_rng(3)
    words = ["".join(pick.choice(list("aeioulmnrst"), pick.integers(3, 9))) for _ in range(3000)]
    made = []
    for i in range(900):
        text = list(pick.choice(words, 150))
        if i % 3 == 0:
            for at in pick.choice(150, 4, replace=False):
                text[at] = str(pick.choice(insults))
        made.append((i, " ".join(text), int(i % 3 == 0)))
    df = spark.createDataFrame(made, "doc_id long, text string, toxic int")
    got = toxicity.toxicity(df.select("doc_id", "text"), df.select("doc_id", "toxic")).join(df, "doc_id").toPandas()
    held = got[got.held_out]
    assert list(held.held_out) == [zlib.crc32(str(i).encode()) % 4 == 2 for i in held.doc_id]
    assert ((held.predicted == 1) == (held.toxic == 1)).mean() > 0.95 and got.score.between(0, 1).all()
    none = toxicity.toxicity(odd, df.select("doc_id", "toxic").limit(0))
    assert {(r.score, r.predicted) for r in none.collect()} == {(0.0, 0)} and none.count() == odd.count()
    assert toxicity.toxicity(odd, df.select("doc_id", "toxic")).count() == odd.count()


def test_pipeline(spark, sf, docs):
    own = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        own = stage(spark, own, sf)
        assert own.columns == docs.columns, name
    good = quality_rules.quality(docs).filter("kept").select("doc_id")
    first = docs.join(good, "doc_id").toPandas().sort_values("doc_id")
    fps = [plain_fingerprint(t) for t in first.text]
    keep = sorted(set(linked(fps, list(first.doc_id))))
    assert sorted(r.doc_id for r in own.collect()) == keep
    out = corpus_pipeline.run(spark, sf)
    assert sorted({r.doc_id for r in out.collect()}) == keep
