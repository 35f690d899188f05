"""Decontamination, source divergence and tokenizer alignment against SQL, the libraries and brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from stratum.llm import alignment, decontamination, divergence
from stratum.llm.common import ready, table
from tests.llm.test_operators import ODD, rows

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, source string, n_words string, begins string, count string, a string"


@pytest.fixture(scope="module")
def odd(spark):
    ready(spark)
    langs = ["en", None, "de", "en", "", "en", "de", "en", "en", "de", "en", None]
    return spark.createDataFrame([(i, t, langs[k], None if k % 3 == 0 else f"s{k % 3}", "x", "y", "z", "a")
                                  for k, (i, t) in enumerate(ODD)], DOCS)


def oracle(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        own = df if isinstance(df, str) else None
        if own is None:
            pdf = df.toPandas().astype(object)  # noqa: F841
            con.execute(f"CREATE TABLE {name} AS SELECT * FROM pdf")
        else:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{own}')")
    return con.execute(sql).df()


def same(df, want):
    assert rows(df) == sorted((tuple(x.item() if hasattr(x, "item") else x for x in r) for r in
                               want[df.columns].itertuples(index=False, name=None)), key=repr)


# ------------------------------------------------------------------------------------ decontamination
def plain_leaks(docs, items, window):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    asked = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w and item is not None else 0):
            asked[tuple(w[i:i + n])].add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in asked}:
            for i in range(len(w) - n + 1):
                if own := asked.get(tuple(w[i:i + n])):
                    hit.update(range(i, i + n))
                    found |= own
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_words", [500_000, 60])
def test_decontamination_brute_force(spark, odd, block_words, monkeypatch):
    monkeypatch.setattr(decontamination, "PART_WORDS", 25)
    monkeypatch.setattr(decontamination, "CANDIDATES", 7)
    pick = np.random.default_rng(1)
    few = lambda n, k: " ".join(pick.choice([f"w{i}" for i in range(k)], n))  # noqa: E731  repeated shingles
    items = [(i, few(int(pick.integers(1, 60)), 4 if i % 2 else 40)) for i in range(30)]
    items += [(3, "repeated id, another text of eleven words so it has two windows"), (50, "One"), (51, "two Words"), (52, None),
              (53, " ... "), (None, "a b c"), (54, "été 日本 1234"), (55, items[0][1]), (56, "the cat the cat the cat the cat the cat the")]
    docs = [(i, f"{few(30, 5)} {items[i % 30][1].upper()}, {few(20, 30)} Été 日本-1234 one Two wordS") for i in range(60)]
    docs += [(r.doc_id, r.text) for r in odd.collect()] + [(7, "the cat " * 4), (99, items[1][1]), (99, items[1][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    it = spark.createDataFrame(items, "item_id long, text string").withColumn("n_hit", F.lit("clash"))
    got = decontamination.contaminated(df, it, block_words=block_words)
    assert rows(decontamination.digest(got)) == plain_leaks(docs, items, 10)
    spans = [(r.begins, r.ends, r.n_hit) for r in got.collect()]
    assert all(sum(b - a for a, b in zip(x, y)) == n and x == sorted(x) and all(b < a for b, a in zip(y, x[1:]))
               for x, y, n in spans)


def test_decontamination_sql_and_empty_tables(spark, sf, odd):
    docs, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    got = decontamination.digest(decontamination.contaminated(docs, items))
    same(got, oracle(decontamination.ORACLE_SQL, documents=f"{sf}/documents.parquet", benchmark=f"{sf}/benchmark.parquet"))
    assert got.filter("contaminated").count() > 0
    assert decontamination.contaminated(docs.limit(0), items).count() == 0
    clean = decontamination.contaminated(odd, items.limit(0)).collect()
    assert len(clean) == len(ODD) and {(r.n_hit, len(r["items"])) for r in clean} == {(0, 0)}
    assert rows(decontamination.contaminated(odd, items).select("doc_id")) == rows(odd.select("doc_id"))


# ------------------------------------------------------------------------------------ divergence
def test_transducer_is_minimal_and_numbers_terms():
    pick = np.random.default_rng(5)
    terms = sorted({"".join(pick.choice(list("abé"), pick.integers(1, 7))).encode() for _ in range(900)})
    builder = divergence.Builder()
    for t in terms:
        builder.add(t)
    made = builder.arrays()
    row = {k: v.tobytes() for k, v in made.items()} | {"lang": "x", "base": 100, "first": terms[0]}
    words = divergence.Vocabulary([row])
    asked = terms + [b"zz", b"", b"ab" * 9, terms[3] + b"a" * 20]
    got = words.ordinals("x", asked).tolist()
    assert got[:len(terms)] == list(range(100, 100 + len(terms))) and got[-4:] == [-1] * 4
    # states of a minimal automaton: the different sets of continuations
    ways = defaultdict(set)
    for t in terms:
        for i in range(len(t) + 1):
            ways[t[:i]].add(t[i:])
    assert len(made["final"]) == len({frozenset(w) for w in ways.values()})
    with pytest.raises(ValueError):
        builder.add(b"a")


def test_divergence_sql(spark, sf, odd):
    docs = table(spark, sf, "documents")
    want = oracle(divergence.ORACLE_SQL, documents=f"{sf}/documents.parquet")
    assert set(want.part) == {"pair", "term"}
    same(divergence.divergence(docs), want)
    # small ranges, blocks and groups give the same
    same(divergence.divergence(docs, range_terms=200, block_bytes=40_000, pair_terms=16, pair_sources=3), want)


def test_divergence_odd_cases(spark, odd):
    many = odd.select("doc_id", "text", "lang", "source")
    for _ in range(4):
        many = many.unionByName(many)
    for df in (odd, many.withColumn("total", F.lit("clash"))):
        same(divergence.divergence(df), oracle(divergence.ORACLE_SQL, documents=df))
    assert divergence.divergence(odd.limit(0)).count() == 0
    one = spark.createDataFrame([(1, None, None, None)], "doc_id long, text string, lang string, source string")
    assert divergence.divergence(one).count() == 0


def test_shares_are_exact_beyond_long(spark):
    big = 3_000_000_000_000_000
    row = spark.createDataFrame([(big, 7 * big + 1, 12345)], "count long, total long, terms long") \
        .select(divergence.share("count", "total", "terms")).collect()[0][0]
    assert row == 1 + 10**9 * (big + 2) // (7 * big + 1 + 2 * 12345)


# ------------------------------------------------------------------------------------ alignment
def plain_alignment(docs):
    a_lib, b_lib = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a_lib.encode_special_tokens = True
    from stratum.llm.pretokens import byte_letters
    back = {c: b for b, c in enumerate(byte_letters())}
    a_bytes = lambda i: bytes(back[c] for c in a_lib.id_to_token(i))
    b_bytes = lambda i: bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i) \
        else b_lib.id_to_piece(i).replace("▁", " ").encode()
    done, counts = [], Counter()
    for doc, text in docs:
        want = (" " + (text or "")).encode()
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        if b"".join(map(a_bytes, a)) != want or b"".join(map(b_bytes, b)) != want:
            a, b = [], []
        ends = [np.cumsum([0, *(len(f(i)) for i in x)])[1:].tolist() for f, x in ((a_bytes, a), (b_bytes, b))]
        links = [(x, y) for x, p in zip(a, ends[0]) for y, q in ([(b[ends[1].index(p)], p)] if p in ends[1] else [])]
        groups, both = [], sorted(set(ends[0]) & set(ends[1]))
        for lo, hi in zip([0, *both], both):
            groups.append("|".join(",".join(str(i) for i, e in zip(x, y) if lo < e <= hi) for x, y in zip((a, b), ends)))
        counts.update(links)
        done.append((doc, a, b, groups, links))
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return sorted(((doc, len(a), len(b), len(g), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "", len(links),
                    sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links))
                   for doc, a, b, g, links in done), key=repr)


def test_alignment(spark, sf, odd):
    few = spark.createDataFrame(
        [(r.doc_id, r.text) for r in table(spark, sf, "documents").limit(80).collect()]
        + [(r.doc_id, (r.text or "")[:3000]) for r in odd.collect()]
        + [(200 + i, t) for i, t in enumerate([
            " ", "  ", "a ", "a  ", " a", "  a  b ", "x▁y", "▁", "tab\t x\r\n", "<s>a</s> <unk> <0x0A>", "\x00", "é é ﬁ ①", "🤷🏽 🤷",
            "word" * 40 + " end", "\xa0　  x", None, "", "don't 'S it'll", "a\n\n  b\n", "İstanbul ǅ"])],
        "doc_id long, text string").withColumn("count", F.lit("clash"))
    want = plain_alignment([(r.doc_id, r.text) for r in few.collect()])
    names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum"]
    for kw in ({}, {"shared_pairs": 0, "chunk_links": 500}):
        got = alignment.alignment(few, A, B, public_tokenizers.PATTERN, **kw)
        assert rows(got.select(names)) == want
        assert alignment.alignment(few.limit(0), A, B, public_tokenizers.PATTERN, **kw).count() == 0
        none = few.filter("doc_id = 216")  # the empty text
        assert rows(alignment.alignment(none, A, B, public_tokenizers.PATTERN, **kw).select("n_a", "groups_sha256", "count_sum")) == [(0, "", 0)]
    with_null = odd.withColumn("text", F.expr("substring(text, 1, 500)"))
    assert rows(alignment.alignment(with_null, A, B, public_tokenizers.PATTERN).select("doc_id")) == rows(odd.select("doc_id"))
