import random
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from folioflow.llm import language, quality, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, " ", "\n\n  x", "don't we'll I'LL", "<|endoftext|>", "a<|endoftext|> b <|endoftext|>", "<|endof", "é ü ß ñ", "日本語 テスト", "՘x ᲀ 🀀", "　\xa0 x", "x" * 40000, "1234567 12.5", "\x00\x01 \x7f", "a\r\n\tb", "😀😀 ok"]


def test_token_counts(spark):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("ab c'\n.é!日՘ 12") for _ in range(rng.randint(1, 300))) for _ in range(300)] + ["same text"] * 3
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    exact = Tokenizer.from_file(PATH)
    got = {r.doc_id: r for r in token_counts.count_tokens(docs, PATH, entries=50).collect()}
    for i, t in enumerate(texts):
        n = len(exact.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 512), repr(t)[:80]
    assert token_counts.count_tokens(docs.limit(0), PATH).collect() == []


def test_first_tier_counts_all_documents(spark):
    rng = random.Random(5)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)]
    texts = [" ".join(rng.choices(words, weights=range(200, 0, -1), k=rng.randint(1, 400))) for _ in range(300)] + ["x" * 500 + " last" * 3000, None, ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(7)
    n = Counter(p for t in texts for p in token_counts.PATTERN.findall(t or ""))
    want = sorted(n, key=lambda p: (-n[p], p))[:40]
    exact = Tokenizer.from_file(PATH)
    assert token_counts.frequent_lengths(docs, PATH, entries=40) == {p: len(exact.encode(p, add_special_tokens=False).ids) for p in want}
    assert token_counts.frequent_lengths(docs.limit(0), PATH) == {}


def test_cache_stays_bounded():
    own = token_counts.Counted(PATH, {"the": 1}, most=10)
    exact = Tokenizer.from_file(PATH)
    for i in range(20):
        text = f"word{i} some more unlikelyy{i}"
        assert own.counts([text]) == [len(exact.encode(text).ids)] and len(own.known) <= 10 + 12


WORDS = {"en": "the of and to in that is was he for it with as his on be at by had".split(), "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein".split(), "fr": "de la le et les des en un du une que est pour qui dans par plus pas".split()}


def speech(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def test_language(spark):
    rng = random.Random(2)
    rows = [(i, speech(rng, lang, rng.randint(5, 80)), lang) for i, lang in enumerate(rng.choice(list(WORDS)) for _ in range(600))]
    rows += [(1000, None, "en"), (1001, "123 !!", "en"), (1002, "", None), (1003, speech(rng, "de", 20000).upper(), None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, score string")
    known = language.train(docs, dictionary_bytes=8192, sample_rows=50)
    assert set(known) == set(WORDS)
    got = {r.doc_id: r for r in language.identify(docs, known).collect()}
    right = [got[i].lang_best == lang for i, _, lang in rows[:600]]
    assert sum(right) / len(right) > 0.97 and all(0 <= r.score <= 1 for r in got.values())
    assert [got[i].lang_best for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "de"]
    assert all(r.lang == ("und" if r.score < 0.02 else r.lang_best) for r in got.values())
    assert language.identify(docs, {}).filter("lang_best <> 'und'").count() == 0
    assert language.train(docs.limit(0)) == {}


def test_language_learns_from_whole_texts(spark):
    rng = random.Random(4)
    header = "this licence opens every document of the table alike " * 100
    rows = [(i, header + speech(rng, lang, 2000), lang) for i, lang in enumerate(list(WORDS) * 30)]
    rows += [(1000 + i, "12 34 " * 1000 + " ".join(rng.choice("voi ei tai on se mutta kun niin".split()) for _ in range(60)), "fi") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = language.train(docs, dictionary_bytes=8192, sample_rows=50)
    assert set(known) == {*WORDS, "fi"}
    asked = [(i, speech(rng, lang, 40), lang) for i, lang in enumerate(list(WORDS) * 20)]
    got = {r.doc_id: r.lang_best for r in language.identify(spark.createDataFrame(asked, "doc_id long, text string, lang string"), known).collect()}
    assert sum(got[i] == lang for i, _, lang in asked) >= 57


def test_language_sample_is_bounded(spark):
    rows = [(None, f"{'ab' * (i % 7 + 1)} {chr(97 + i % 26)}{chr(97 + i // 26)} word", "en") for i in range(500)]
    known = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_rows=10)
    assert 0 < len(known["en"]) <= 10 * max(len(language.letters(t)) for _, t, _ in rows)


def test_quality(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(900):
        good = rng.random() < 0.7
        text = speech(rng, "en", rng.randint(3, 60))
        rows.append((i, text if good else text.upper().replace(" ", "!! ")))
        labels.append((i, int(good)))
    labels += [(5, None), (10_000, 1), (None, 0)]
    rows += [(2000, None), (2001, ""), (None, "the of")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.assess(docs, marks).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    held = [i for i, _ in labels[:900] if got[i].held_out]
    assert 200 < len(held) < 400 and sum(got[i].predicted == labels[i][1] for i in held) / len(held) > 0.98
    kept = quality.keep_good(docs, marks)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted}
    none = quality.assess(docs, marks.limit(0)).collect()
    assert [r.score for r in none] == [pytest.approx(0.5)] * len(rows)
    assert quality.assess(docs.limit(0), marks).collect() == []


def test_equal_sizes_repeated_rows_and_brute_force_sizes(spark):
    """Ties go to the first dictionary; the sizes are those of zstandard itself, piece by piece."""
    import zstandard

    words = {"a": b"the river and the stone of the house ", "b": b"le jardin et la maison de la nuit "}
    same = language.Classifier({"a": words["a"], "b": words["a"]})
    assert same("the river and the house") == ("a", 0.0)
    text = "The river and the stone. " * 2000
    raw = language.letters(text).encode()
    for (lang, known), size in zip(words.items(), language.Classifier(words).sizes(text), strict=True):
        dictionary = zstandard.ZstdCompressionDict(known, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        maker = zstandard.ZstdCompressor(level=5, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False)
        assert size == sum(len(maker.compress(raw[i : i + 16_384])) for i in range(0, len(raw), 16_384)), lang
    docs = spark.createDataFrame([(1, "the house", "x"), (1, "the house", "x"), (2, None, "y")], "doc_id long, text string, score string")
    got = [(r.doc_id, r.lang_best) for r in language.identify(docs, words).collect()]
    assert sorted(got) == [(1, "a"), (1, "a"), (2, "und")]


def test_quality_takes_long_texts_and_clashing_names(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["river", "stone", "winter", "house"]) for _ in range(40)) if i % 2 else "BUY!!! $$$ " * 20, "s") for i in range(200)]
    rows += [(900, "river stone " * 60_000, "s"), (901, None, "s"), (901, None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __score string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    got = sorted(r.doc_id for r in kept.collect())
    assert {i for i in got if i < 200} == {i for i in range(200) if i % 2} and got.count(901) in (0, 2)
    assert sorted(map(str, quality.assess(docs.repartition(7), labels).collect())) == sorted(map(str, quality.assess(docs, labels).collect()))
