"""Scores and verdicts against a plain second implementation, and on cases whose answer is known."""

import math

import numpy as np
import zstandard
from pyspark.sql import functions as F

from stratum.llm import chat_format, language_id, toxicity, url_filter
from stratum.llm.common import ready
from tests.llm.test_operators import rows


def test_trees_tell_urls_by_their_features(spark):
    """Ruled urls of two kinds: blocked ones are long, full of digits and parameters. Urls without a rule
    are judged by the same features."""
    pick = np.random.default_rng(2)
    def url(host, bad):
        path = "".join(pick.choice(list("0123456789"), 40)) if bad else "".join(pick.choice(list("abcdef"), 6))
        return f"http://{host}/{path}" + ("?a=1&b=2&c=3" if bad else "")
    made = [(i, url("good.org" if i % 2 else "bad.org", i % 2 == 0)) for i in range(400)]
    made += [(1000 + i, url(f"other{i}.org", i % 2 == 0)) for i in range(200)]
    made += [(2000, None), (2001, ""), (2002, "no scheme")]
    got = url_filter.judged(spark.createDataFrame(made, "page_id long, url string"), (("allow", "good.org/"), ("block", "bad.org/")))
    got = {r.page_id: r for r in got.collect()}
    assert all(got[1000 + i].verdict == ("block" if i % 2 == 0 else "allow") and got[1000 + i].rule is None for i in range(200))
    assert all((got[i].host, got[i].path, got[i].rule) == ("", "", None) for i in (2000, 2001, 2002))


def test_language_scores_by_a_plain_reading(spark):
    """Bits by summed log ratios over 3-grams, languages by weighted logistic loss, done with dicts."""
    ready(spark)
    pick = np.random.default_rng(6)
    letters = {"aa": "abcde", "bb": "cdefg", "cc": "efghi"}
    made = [(i, " ".join("".join(pick.choice(list(letters[x]), 5)) for _ in range(30)), x)
            for i in range(120) for x in [sorted(letters)[i % 3]]]
    model = language_id.train(spark.createDataFrame(made, "doc_id long, text string, lang string"), 2000)
    for text in [m[1] for m in made[:12]] + ["CDE, efg! abc", "x", "1 2 3", "", None, "ééé zzz " * 50]:
        got = model.predict(text)
        if not text or not any(c.isalpha() for c in text):
            assert got == ("und", 0.0, False)
            continue
        raw = " " + "".join(c if ord(c) > 127 or c.isalpha() else " " for c in text.lower()) + " "
        raw = raw.encode()
        grams = [raw[i:i + 3] for i in range(len(raw) - 2)]
        slot = [(int.from_bytes(g, "big") * 2654435761 % (1 << 32)) >> 17 for g in grams]
        margins = [language_id.SCALE * sum(float(model.weights[b][k]) for b in slot) / len(slot) for k in range(model.codes.shape[1])]
        loss = [sum(float(model.trust[k]) * math.log1p(math.exp(-float(code[k]) * margins[k])) for k in range(len(margins)))
                for code in model.codes]
        share = [math.exp(min(loss) - x) for x in loss]
        share = [s / sum(share) for s in share]
        assert got[0] == model.languages[loss.index(min(loss))] and abs(got[1] - max(share)) < 1e-6
        assert got[2] == (sorted(share)[-1] - sorted(share)[-2] < language_id.AMBIGUOUS)


def test_toxicity_scores_by_a_plain_reading():
    ordinary, lexicon = b"ordinary words of prose, again and again " * 40, b" snarfle  blorgish "
    model = toxicity.Model(ordinary, ordinary + lexicon, (0.5, 0.25, 1.0, -1.0, 0.3, -2.0))
    def size(data, content):
        params = zstandard.ZstdCompressionParameters.from_level(
            toxicity.LEVEL, min_match=toxicity.MIN_MATCH, window_log=17, write_content_size=False, write_checksum=False, write_dict_id=False)
        own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(compression_params=params, dict_data=own).compress(data))
    for text in ["", "plain", "a Snarfle! " * 30, "words of prose " * 100 + "blorgish", "é" * 500]:
        raw, d, at = text.lower().encode(), [], 0
        while True:
            d.append(size(raw[at:at + toxicity.WINDOW], model.ordinary) - size(raw[at:at + toxicity.WINDOW], model.toxic))
            at += toxicity.STRIDE
            if at >= max(1, len(raw) - (toxicity.WINDOW - toxicity.STRIDE)):
                break
        top, high = sorted(d)[-2:], sum(x > 2 for x in d)
        x = [max(d), sum(top) / len(top), sum(d) / len(d), high / len(d), math.log1p(high), 1.0]
        assert abs(model.score(text) - 1 / (1 + math.exp(-sum(a * b for a, b in zip(model.weights, x))))) < 1e-9


def test_no_call_or_result_vanishes(spark):
    calls = spark.createDataFrame([(1, "a", 0, "search", "{}", None), (1, None, 2, "search", "{x}", None), (None, "b", 3, "t", None, None),
                                   (None, "b", 3, "t", None, None)],
                                  "conv_id long, call_id string, turn long, tool string, arguments string, depends_on string")
    results = spark.createDataFrame([(1, "a", 1, "ok", "z"), (1, "b", 2, "no call", "z"), (2, "a", 2, None, "z"), (1, None, 5, "none", "z")],
                                    "conv_id long, call_id string, turn long, content string, kind string")
    assert rows(chat_format.unlinked(calls, results)) == sorted([
        ("call", 1, None, 2, "{x}"), ("call", None, "b", 3, None), ("call", None, "b", 3, None), ("result", 1, None, 5, "none"),
        ("result", 1, "b", 2, "no call"), ("result", 2, "a", 2, None)], key=repr)
    linked = chat_format.linked_calls(calls.withColumn("position", F.lit("clash")), results)
    assert [(r.call_id, r.linked) for r in linked.collect()] == [("a", True)]
    assert chat_format.unlinked(calls.limit(0), results.limit(0)).count() == 0
