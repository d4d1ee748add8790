"""Toxicity, language and the pipeline: exact parts by brute force, learned parts on held-out rows."""

import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

import corpus_pipeline
from cadenza.llm import decontamination, language, subwords, toxicity

SYLLABLES = {"en": ["the", "ing", "tion", "and", "er", "ly"], "xx": ["ço", "ñar", "élo", "qua", "ois", "ux"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(n))


def test_distinct_words_and_ngrams():
    words, codes, bounds = subwords.distinct_words(pa.array(["The cat, sat.", None, "", " cat  THE ", "a.b"]))
    text = [[words[c] for c in codes[a:b]] for a, b in zip(bounds[:-1], bounds[1:])]
    assert text == [["the", "cat", ",", "sat", "."], [], [], ["cat", "the"], ["a", ".b"]]
    bucket, word = subwords.char_ngrams(["abc", "ab", "abc"], range(2, 4), 1 << 20)
    own = [sorted(bucket[word == i].tolist()) for i in range(3)]
    assert own[0] == own[2] and len(own[0]) == 4 + 3 + 1 and len(own[1]) == 3 + 2 + 1
    assert len(set(own[0]) & set(own[1])) == 2 + 1  # <a, ab, <ab


def test_window_members_are_the_distinct_words_of_each_window():
    rng = np.random.default_rng(0)
    bounds = np.concatenate([[0], np.cumsum([0, 1, 7, 8, 9, 40, 0, 33])])
    codes = rng.integers(0, 6, bounds[-1])
    text, start, end = toxicity.window_bounds(bounds, 8)
    member, place = toxicity.window_members(codes, bounds, 8)
    assert set(text) == set(range(8)) and (end - start <= 8).all()
    for w in range(len(text)):
        assert sorted(codes[place[member == w]]) == sorted(set(codes[start[w]:end[w]].tolist()))
    assert all(any(s <= p < e for s, e in zip(start, end)) for p in range(bounds[-1]))


def toxic_rows(rng, n, words):
    out = []
    for i in range(n):
        toxic = i % 3 == 0
        own = prose(rng, "en", rng.randrange(3, 150)).split()
        for _ in range(max(1, len(own) // 40) if toxic else 0):
            own[rng.randrange(len(own))] = rng.choice(words)
        out.append((" ".join(own), int(toxic)))
    return out


def test_toxicity_catches_unseen_spellings_and_spares_clean_texts():
    rng = random.Random(0)
    rows = toxic_rows(rng, 500, ["stupidest", "stupidly", "idiotic", "idiots", "moronic"])
    model = toxicity.fit([t for t, _ in rows], [y for _, y in rows])
    test = toxic_rows(rng, 300, ["stupidd", "idiot", "idiotz", "moron", "stupids,"])
    found = (model.score(model.logits(pa.array([t for t, _ in test]))) >= toxicity.THRESHOLD).astype(int)
    y = np.array([y for _, y in test])
    assert (found[y == 1] == 1).mean() >= 0.95 and (found[y == 0] == 0).mean() >= 0.98


DOCS = "doc_id long, text string, lang string, score string, toxicity string, nth int"


def test_scores_of_odd_rows(spark):
    rng = random.Random(1)
    rows = toxic_rows(rng, 200, ["moron", "idiot"])
    model = toxicity.fit([t for t, _ in rows], [y for _, y in rows])
    cases = [None, "", "...", "moron", "clean words " * 40_000 + "moron idiot moron idiot", "the and"]
    docs = spark.createDataFrame([(i, t, "en", "s", "t", 1) for i, t in enumerate(cases)] + [(None, "moron", None, None, None, None)], DOCS)
    out = toxicity.with_toxicity(docs, model, "p")
    assert out.columns == [*docs.columns, "p"]
    got = {r.doc_id: r.p for r in out.collect()}
    assert all(0 <= p <= 1 for p in got.values()) and got[0] == got[1] and got[3] == got[None]
    assert got[4] > max(got[0], got[5]) and got[4] >= toxicity.THRESHOLD  # found at the end of a very long text
    assert {r.p for r in toxicity.with_toxicity(docs, None, "p").collect()} == {0.0}
    assert toxicity.with_toxicity(docs.where("false"), model, "p").count() == 0


def test_labels_outside_the_learning_rows_are_never_seen(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    docs = spark.createDataFrame([(i, f"t{i}", "en", "s", "t", 1) for i in range(200)] + [(None, "x", None, None, None, None)], DOCS)
    texts, y = toxicity.labelled_sample(docs, labels)
    ids = sorted(int(t[1:]) for t in texts)
    assert ids == [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert all(int(t[1:]) % 2 == v for t, v in zip(texts, y))
    few = toxicity.labelled_sample(docs, labels, {1: 5, 0: 7})[1]
    assert (few.count(1), few.count(0)) == (5, 7)
    texts, langs = language.labelled_sample(docs, 11)
    assert len(texts) == 11 and set(langs) == {"en"} and all(zlib.crc32(t[1:].encode()) % 4 != 2 for t in texts)


def forward_backward(scores, transitions, start):
    n, k = scores.shape
    p = np.zeros((n, k))
    paths = np.array(np.meshgrid(*[range(k)] * n, indexing="ij")).reshape(n, -1)
    weight = start[paths[0]] + scores[np.arange(n)[:, None], paths].sum(0)
    weight = np.exp(weight + (transitions[paths[:-1], paths[1:]].sum(0) if n > 1 else 0))
    for t in range(n):
        p[t] = np.bincount(paths[t], weights=weight, minlength=k)
    return p / p.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("block", [1, 2, 3, 128])
def test_posteriors_equal_all_paths(block):
    rng = np.random.default_rng(block)
    lengths = [0, 1, 2, 7, 0, 6, 3, 7]
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    scores, transitions, start = rng.normal(size=(bounds[-1], 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    got = language.posteriors(scores, bounds, transitions, start, block)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b > a:
            assert np.allclose(got[a:b], forward_backward(scores[a:b], transitions, start))
    p, pairs = language.expected(scores[3:10][None], transitions, start)
    assert np.allclose(p[0], forward_backward(scores[3:10], transitions, start)) and np.isclose(pairs.sum(), 6)


def test_gradient_of_transitions_is_the_difference_of_counts():
    rng = np.random.default_rng(0)
    scores, a, s = rng.normal(size=(1, 5, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)

    def log_z(t):
        paths = np.array(np.meshgrid(*[range(2)] * 5, indexing="ij")).reshape(5, -1)
        return np.log(np.exp(s[paths[0]] + scores[0][np.arange(5)[:, None], paths].sum(0) + t[paths[:-1], paths[1:]].sum(0)).sum())

    _, pairs = language.expected(scores, a, s)
    for i in range(2):
        for j in range(2):
            step = np.zeros((2, 2))
            step[i, j] = 1e-5
            assert np.isclose((log_z(a + step) - log_z(a - step)) / 2e-5, pairs[i, j], atol=1e-5)


@pytest.fixture(scope="module")
def two_languages():
    rng = random.Random(3)
    rows = [(prose(rng, y, rng.randrange(5, 80)), y) for y in ("en", "xx") for _ in range(60)]
    return language.fit([t for t, _ in rows], [y for _, y in rows])


def test_code_switched_words_and_odd_rows(spark, two_languages):
    rng = random.Random(9)
    mixed = f"{prose(rng, 'en', 40)} 123 ... {prose(rng, 'xx', 60)}"
    cases = [mixed, None, "", "123 !!! ... ² Ⅷ", prose(rng, "en", 30_000), prose(rng, "xx", 3)]
    docs = spark.createDataFrame([(i, t, "??", "s", "t", 1) for i, t in enumerate(cases)], DOCS)
    out = language.with_languages(docs, two_languages, words=True, out=("l", "p", "w"))
    got = {r.doc_id: r for r in out.collect()}
    assert [got[i].l for i in range(6)] == ["xx", "und", "und", "und", "en", "xx"]
    assert [got[i].p for i in (1, 2, 3)] == [0, 0, 0] and all(0 <= r.p <= 1 for r in got.values())
    named = [w.language for w in got[0].w]
    want = ["en"] * 40 + ["??"] * 2 + ["xx"] * 60
    assert np.mean([a == b for a, b in zip(named, want) if b != "??"]) > 0.97 and len(got[4].w) == 30_000
    with pytest.raises(ValueError):
        language.with_languages(docs, None)
    assert {r.l for r in language.with_languages(docs, None, out=("l", "p", "w")).collect()} == {"und"}


def test_held_out_accuracy_on_the_given_documents(spark):
    d = "/root/testdata/sf0.01"
    rows = language.op9_language(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98


def test_nothing_to_learn_from(spark):
    assert language.fit([], []) is None and language.fit(["123", "..."], ["en", "de"]) is None
    empty = spark.createDataFrame([], DOCS)
    assert language.fitted(empty) is None
    assert toxicity.fitted(empty, spark.createDataFrame([], "doc_id long, toxic int")) is None


def planted(seed):
    """Documents by kind: clean, junk without letters, toxic, copies, near copies, leaks, odd rows."""
    rng = random.Random(seed)
    item = prose(rng, "en", 30)
    rows = [("clean", prose(rng, rng.choice(["en", "xx"]), rng.randrange(30, 200))) for _ in range(150)]
    long = prose(rng, "en", 400).split()
    rows += [("copy", " ".join(long))] + [("copy of it", " ".join(long))] * 3
    rows += [("copy of it", " ".join(long[:i] + ["swapped"] + long[i + 1:])) for i in (3, 200)]
    rows += [("junk", t) for t in (None, "", "12 34 !!", "--- ***")]
    for _ in range(40):
        w = prose(rng, "en", 60).split()
        w[10] = w[30] = rng.choice(["moron", "idiot", "moronic", "idiots"])
        rows.append(("toxic", " ".join(w)))
    rows += [("leak", f"{prose(rng, 'en', 50)} {item} {prose(rng, 'en', 50)}"),
             ("leak", f"{' '.join(item.split()[15:])} {prose(rng, 'en', 40)} {' '.join(item.split()[:15])}")]
    return rows, item


def test_pipeline_on_planted_documents(spark, tmp_path):
    rows, item = planted(4)
    lang = ["xx" if t and any(c in t for c in "çñéq") else "en" for _, t in rows]
    table = [(i, t, lang[i], "src", len(t or ""), "extra", "clash") for i, (_, t) in enumerate(rows)]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long, leaks string, lang_pred string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(k == "toxic")) for i, (k, _) in enumerate(rows) if k in ("toxic", "clean")],
                          "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "toxicity", "near duplicates", "decontamination", "packing"]
    kept, before = {}, docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        after = corpus_pipeline.staged(stage(spark, before, str(tmp_path)), "t")
        assert after.columns == docs.columns
        kept[name] = {r.doc_id for r in after.select("doc_id").collect()}
        before = after
    kind = lambda ids: {rows[i][0] for i in ids}
    every = set(range(len(rows)))
    assert kind(every - kept["language"]) == {"junk"} and kind(kept["language"]) >= {"clean", "toxic", "leak", "copy"}
    gone = kept["language"] - kept["toxicity"]
    held = {i for i in every if rows[i][0] == "toxic"}
    assert len(gone & held) >= 0.9 * len(held) and len(gone - held) <= 2
    left = sorted(kept["toxicity"])
    root = brute.components([brute.simhash(rows[i][1]) for i in left], lambda a, b: (a ^ b).bit_count() <= 4)
    assert kept["near duplicates"] == {left[c] for c in root}
    items = decontamination.Items([(1, item)])
    assert kept["decontamination"] == {i for i in kept["near duplicates"] if not items.leaks([rows[i][1]])[0]}
    assert kind(kept["near duplicates"] - kept["decontamination"]) == {"leak"}

    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    library = public_tokenizers.path("word_bpe_49k.json")
    from cadenza.llm.tokens import encoder
    whole = {i: encoder(library).tokenizer.encode(rows[i][1], add_special_tokens=False).ids + [2] for i in kept["decontamination"]}
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in out) == sorted(
        (i, s, brute.crc(ids[s:s + 4096])) for i, ids in whole.items() for s in range(0, len(ids), 4096))
    n = len({r.sequence_id for r in out})
    assert n <= -(-sum(map(len, whole.values())) // 4096) + 1


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, None), (1, ""), (None, "...")], [(1, "one document alone")] * 3])
def test_pipeline_on_odd_tables(spark, tmp_path, rows):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0  # nothing is labelled: no language is known


def test_every_language_is_learned_also_from_long_texts_alone(spark):
    """101 languages of words of their own, one of them in texts above SAMPLE_CHARS only."""
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {y: ["".join(rng.choices(letters, k=rng.randrange(4, 8))) for _ in range(25)] for y in (f"l{i:03d}" for i in range(101))}
    say = lambda y, n: " ".join(rng.choices(words[y], k=n))
    rows = [(say(y, 3000 if y == "l100" else 60), y) for y in words for _ in range(12)]
    docs = spark.createDataFrame([(i, t, y, None, None, None) for i, (t, y) in enumerate(rows)], DOCS)
    texts, langs = language.labelled_sample(docs)
    assert set(langs) == set(words)
    assert all(len(t) <= language.SAMPLE_CHARS + 10 for t in texts)
    model = language.fit(texts, langs)
    asked = spark.createDataFrame([(i, say(y, 40), None, None, None, None) for i, y in enumerate(words)], DOCS)
    out = language.with_languages(asked, model, out=("l", "p", "w"), evidence="e").collect()
    assert np.mean([r.l == list(words)[r.doc_id] for r in out]) > 0.95 and all(r.e > 0.9 for r in out)
    assert next(r for r in out if r.doc_id == 100).l == "l100"


def test_learned_text_is_bounded_in_all(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_TOTAL", 5 * language.SAMPLE_CHARS)
    docs = spark.createDataFrame([(i, "some words here", f"l{i % 2}", None, None, None) for i in range(80)], DOCS)
    texts, langs = language.labelled_sample(docs)
    assert sorted(set(langs)) == ["l0", "l1"] and len(texts) == 4


def test_unlearned_languages_leave_at_the_language_stage(spark, tmp_path):
    """Also where one language alone is learned, whose model gives every text the score 1."""
    rng = random.Random(8)
    english = [(i, prose(rng, "en", rng.randrange(20, 120)), "en", None, None, None) for i in range(150)]
    foreign = [(1000 + i, prose(rng, "xx", 50), None, None, None, None) for i in range(60)]
    docs = spark.createDataFrame(english + foreign, DOCS)
    kept = {r.doc_id for r in corpus_pipeline.language_stage(spark, docs, str(tmp_path)).collect()}
    assert kept == {r[0] for r in english}


def test_labels_of_long_texts_fill_the_share_and_repeats_count_once(spark):
    short = [(i, f"text {i}", None, None, None, None) for i in range(40)]
    long = [(100 + i, f"long{i} " * 2000, None, None, None, None) for i in range(30)]
    docs = spark.createDataFrame(short + long + short[:1] * 50 + long[:1] * 50, DOCS)
    labels = spark.createDataFrame([(i, 0) for i in range(40)] + [(100 + i, 1) for i in range(30)] + [(0, 0)] * 9, "doc_id long, toxic int")
    texts, y = toxicity.labelled_sample(docs, labels, {1: 10, 0: 20})
    assert (y.count(1), y.count(0)) == (10, 20) and len(set(texts)) == 30
    assert all(len(t) <= toxicity.SAMPLE_CHARS + 10 for t in texts)
    assert toxicity.labelled_sample(docs.repartition(5), labels, {1: 10, 0: 20}) == (texts, y)
    many = toxicity.labelled_sample(docs, labels, {1: 1000, 0: 1000})[1]
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    assert many.count(1) == sum(not held(r[0]) for r in long) and many.count(0) == sum(not held(r[0]) for r in short)


def test_toxicity_score_of_a_text_is_its_most_toxic_window():
    """Brute force: windows of distinct words, averaged over WINDOW places, through the softmax and the curve."""
    rng = random.Random(2)
    rows = toxic_rows(rng, 120, ["moron", "idiot"])
    model = toxicity.fit([t for t, _ in rows], [y for _, y in rows])

    def score(text):
        words, codes, _ = subwords.distinct_words(pa.array([text]))
        said = [words[c] for c in codes]
        step = toxicity.WINDOW // 2
        windows = [said[a:a + toxicity.WINDOW] for a in range(0, max(1, len(said) - step), step)]
        logits = []
        for own in windows:
            bag = np.zeros(toxicity.DIMENSIONS)
            for w in set(own):
                bucket, _ = subwords.char_ngrams([w], toxicity.SIZES, toxicity.BUCKETS)
                bag += model.embeddings[bucket].mean(axis=0)
            z = bag / toxicity.WINDOW @ model.softmax + model.bias
            logits.append(z[1] - z[0])
        return max(logits)

    texts = [t for t, _ in toxic_rows(rng, 40, ["moron", "idiots"])] + ["", "one", prose(rng, "en", 33), prose(rng, "en", 500)]
    got = model.logits(pa.array(texts))
    assert np.allclose(got, [score(t) for t in texts], atol=1e-9)
