"""op1, op6, op7: held-out accuracy, equality with the tokenizer's library, awkward rows."""

import itertools
import math
import os
import random
import zlib

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillscore.llm import common, langid, queries, tokencount, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.01"
LONG = "lorem ipsum dolor " * 20_000


@pytest.fixture(scope="module")
def merges():
    return tokencount.Merges.of_sentencepiece(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abcthe  \n\t▁é漢😀<s>/[]0129.,-_=\x00")), max_size=60))
def test_counts_equal_the_library(text):
    m = test_counts_equal_the_library
    if not hasattr(m, "both"):
        m.both = tokencount.Merges.of_sentencepiece(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert m.both[0].count(text) == len(m.both[1].encode(text))


def test_long_stretches(merges, library):
    rng = random.Random(3)
    for text in ("x" * 20_000, "-=" * 5_000, "".join(rng.choice("abcdefgh") for _ in range(20_000)), LONG):
        assert merges.count(text) == len(library.encode(text))


def test_count_tokens_rows(spark, docs, library):
    got = sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokencount.count_tokens(docs, MODEL).where("doc_id IS NOT NULL").collect())
    want = sorted((r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in docs.where("doc_id IS NOT NULL").collect())
    assert got == [(*w, w[2] > 4096) for w in want]
    assert tokencount.count_tokens(docs.limit(0), MODEL).count() == 0
    assert tokencount.count_tokens(docs, MODEL).where("doc_id IS NULL").count() == 2


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_op7_on_the_tables(spark, library):
    got = {r.doc_id: r.n_tokens for r in queries.op7_token_counts(spark, SF).collect()}
    assert got == {r.doc_id: len(library.encode(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


# Language


def test_language_rows(spark, docs):
    train = spark.createDataFrame([(i, t, lang) for i in range(60) for t, lang in (("the house of the rising sun and the other one " + str(i), "en"), ("das haus der sonne und die andere ist nicht hier " + str(i), "de"), ("la maison du soleil et les autres ne sont pas ici " + str(i), "fr"), ("la casa del sol y los otros no estan aqui ahora " + str(i), "es"))], "doc_id long, text string, lang string")
    model = langid.fit_language_id(train, F.lit(True))
    assert [f for f, _ in model.families] == ["germanic", "romance"]
    for text, lang in (("the other house", "en"), ("die andere sonne und das haus", "de"), ("les autres maisons du soleil", "fr"), ("los otros no estan en la casa", "es")):
        assert model.predict(text)[0] == lang
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify_language(docs, model).collect()}
    assert got[4] == got[5] == got[6] == ("und", 0.0) and got[1][0] == "en" and all(0 <= s <= 1 for _, s in got.values())
    assert langid.identify_language(docs.limit(0), model).count() == 0
    nothing = langid.fit_language_id(train.limit(0), F.lit(True))
    assert nothing.predict("some text") == ("und", 0.0)
    one = langid.fit_language_id(train.where("lang = 'fr'"), F.lit(True))
    assert one.predict("some text") == ("fr", 1.0)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_op6_held_out(spark):
    got = queries.op6_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.98


def test_language_scores_equal_a_plain_loop():
    said = {"en": "the house and the garden of his mother", "de": "das haus und der garten seiner mutter", "nl": "het huis en de tuin van zijn moeder", "fr": "la maison et le jardin de sa mère", "es": "la casa y el jardín de su madre"}
    rng = random.Random(8)
    data = [(" ".join(rng.sample(said[lang].split(), 6)), lang) for _ in range(40) for lang in said]
    model = langid.Hierarchy.fit(*zip(*data, strict=True))
    for text, _ in data[::7]:
        x = [0.0] * langid.DIM
        raw = f" {text.lower()} ".encode()
        for a, b, c in zip(raw, raw[1:], raw[2:]):
            x[((a * 961 + b * 31 + c) * 2654435761 % 2**32) >> 20] += 1
        norm = math.sqrt(sum(v * v for v in x))
        prob = lambda row: 1 / (1 + math.exp(-model.a[row] * (sum(float(w) * v / norm for w, v in zip(model.w[row], x)) + model.b[row])))
        family = {f: prob(row) for (f, _), row in zip(model.families, model.family_rows)}
        best = max(family, key=family.get)
        langs = dict(model.families)[best]
        votes = dict.fromkeys(langs, 0.0)
        for p, q in itertools.combinations(langs, 2):
            won = prob(model.pair_rows[p, q])
            votes[p], votes[q] = votes[p] + won, votes[q] + 1 - won
        lang = max(votes, key=votes.get)
        got = model.predict(text)
        assert got[0] == lang and got[1] == pytest.approx(family[best] / sum(family.values()) * (votes[lang] / (len(langs) - 1) if len(langs) > 1 else 1), rel=1e-4)


def test_rare_languages_are_sampled(spark):
    rows = [(i, f"common words number {i}", "en") for i in range(3000)] + [(-i, f"seltene wörter nummer {i}", "de") for i in range(1, 6)]
    model = langid.fit_language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), sample=100)
    assert [ls for _, ls in model.families] == [["de", "en"]]


def test_samples_agree_and_are_bounded(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 2500, 7).otherwise(F.col("id")).alias("k"), F.concat(F.lit("t"), (F.col("id") % 4000).cast("string")).alias("text"))
    a, b = (common.bounded_sample(df.repartition(n), "k", 200, "text") for n in (3, 7))
    assert a == b and len(a) == 200 and len({r["_h"] for r in a}) == 200
    assert common.bounded_sample(df.limit(0), "k", 200, "text") == []
    with pytest.raises(ValueError, match="carried"):
        common.per_text(df.withColumn("Score", F.lit(1)), "text", ["k", "Score"], "score double", lambda t: [])


# Toxicity


def test_toxicity_scores_equal_a_plain_loop():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdeéж") for _ in range(rng.randrange(1, 9))) for _ in range(200)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 5, 15, 16, 17, 24, 25, 40, 100]))) for _ in range(80)]
    model = toxicity.SubwordSoftmax.fit(texts, [int("ab" in t) for t in texts])

    def bucket(gram):
        h = 0
        for n, c in enumerate(gram, 1):
            h = (h * 0x100000001B3 + ord(c) + n) % 2**64 if n > 1 else ord(c)
        return (h * 0x9E3779B97F4A7C15 % 2**64) >> (64 - toxicity.BITS)

    def value(word):
        w = f"<{word}>"
        at = [bucket(w[i : i + n]) for n in (3, 4) for i in range(len(w) - n + 1)] + [(toxicity.xxhash.xxh3_64_intdigest(word.encode()) * 0x9E3779B97F4A7C15 % 2**64) >> (64 - toxicity.BITS)]
        return sum(float(model.logit[b]) for b in at) / math.sqrt(len(at))

    for text, got in zip([*texts, "word word word", "Ж! ab"], model.scores([*texts, "word word word", "Ж! ab"]), strict=True):
        ws = [w for w, _ in itertools.groupby(toxicity.tokens(text))]
        n = min(toxicity.WINDOW, len(ws))
        starts = [*range(0, len(ws) - n, toxicity.WINDOW // 2), len(ws) - n]
        worst = max(sum(value(w) for w in ws[a : a + n]) / n for a in starts)
        assert got == pytest.approx(1 / (1 + math.exp(-worst - model.bias)), rel=1e-4)


def test_misspellings_share_vectors():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["ka", "lo", "mi", "ru", "te", "so"]) for _ in range(3))
    texts, labels = [], []
    for i in range(400):
        ws = [word() for _ in range(40)]
        if i % 2:
            ws[rng.randrange(40)] = rng.choice(["blorgish", "blorgisher", "xblorgish"])
        texts.append(" ".join(ws))
        labels.append(i % 2)
    model = toxicity.SubwordSoftmax.fit(texts, labels)
    clean, seen, unseen = model.scores([" ".join(word() for _ in range(300)), " ".join([*(word() for _ in range(300)), "blorgish"]), " ".join([*(word() for _ in range(300)), "blorgishes"])])
    assert clean < 0.3 <= seen and unseen >= 0.3
    assert model.scores([None, ""])[0] == model.scores([""])[0]


def test_toxicity_rows(spark, docs):
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (4, 1), (9, 1), (None, 1), (12, None)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels, F.lit(True))
    got = toxicity.score_toxicity(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0
    none = toxicity.fit_toxicity(docs, labels.limit(0), F.lit(True))
    assert none.scores(["anything"])[0] < 0.3


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
def test_op1_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op1_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    hit = [r.predicted for r in got if r.toxic == 1]
    false = [r.predicted for r in got if r.toxic == 0]
    assert sum(hit) / len(hit) > 0.7 and sum(false) / len(false) < 0.05
