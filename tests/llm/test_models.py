"""Quality, language and language-model scores: held-out accuracy, hard rows, and exact counts."""

import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from corpora import SCHEMA, crc, frame, hard_rows, plain_words, words
from sluiceway.llm import lm, mixing
from sluiceway.llm.langid import DIMENSIONS, _counts, document_frequencies, fit_language, fit_rows, predict_language
from sluiceway.llm.lm import score_texts
from sluiceway.llm.mixing import MixerFit, add_sums, count_bits, fit_mixer, left_out, log10_words, no_sums
from sluiceway.llm.quality import SIZE, SLOTS, QualityModel, _index_vectors, _tokens, fit_quality, keep_good, quality_score, score_quality, word_vectors

SYLLABLES = {"aa": "ka to mi re sol na".split(), "bb": "übe sch ung zei ost".split(), "cc": "ción que ñar los men".split()}


def speech(lang, seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def graded_rows():
    rows, labels = [], []
    for i in range(240):
        good = i % 3 != 0
        text = speech("aa", i) if good else [speech("aa", i).upper().replace(" ", "!! "), " | ".join(speech("aa", i).split()), "spam " * 70][i % 9 // 3]
        rows.append((i, text, "aa", "s", len(text)))
        labels.append((i, int(good), 0))
    return rows, labels


def test_quality_of_held_out_rows(spark):
    rows, labels = graded_rows()
    docs, known = frame(spark, rows, clashing=True), spark.createDataFrame(labels + [(999, 1, 0), (5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = score_quality(docs, fit_quality(docs, known)).collect()
    assert all(r.held_out == (crc(r.doc_id, 5) == 0) and r.predicted == (r.score >= 0.3) for r in got) and len(got) == len(rows)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == labels[r.doc_id][1] for r in held) >= 0.95 * len(held)
    assert keep_good(docs, known).columns == docs.columns


def test_quality_of_hard_rows(spark):
    rows, labels = graded_rows()
    model = fit_quality(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = score_quality(frame(spark, hard_rows(), clashing=True), model).collect()
    assert len(got) == len(hard_rows()) and all(0 <= r.score <= 1 for r in got)
    by_text = {r.doc_id: r.score for r in got}
    assert by_text[0] == by_text[3] == by_text[6], "null, empty and blank texts score alike"
    empty = spark.createDataFrame([], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert fit_quality(empty, none) is None and score_quality(empty, model).collect() == []
    assert {r.score for r in score_quality(frame(spark, hard_rows()), None).collect()} == {0.5}


def brute_vectors(texts):
    """Sums over all words and all within two places of them, one at a time."""
    places, signs = _index_vectors()
    sums = np.zeros((SLOTS, SIZE))
    for text in texts:
        for tokens in _tokens(pa.array([text], pa.string()))[:2]:
            for i, a in enumerate(tokens):
                for b in tokens[max(0, i - 2) : i + 3]:
                    for place, sign in zip(places[b], signs[b]):
                        sums[a, place] += sign
    return sums


def test_word_vectors_of_all_texts(spark):
    rows = graded_rows()[0][:40] + hard_rows()
    sums = brute_vectors([text for _, text, *_ in rows])
    expected = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    got = word_vectors(frame(spark, rows, clashing=True))
    assert np.allclose(got, expected, atol=1e-6) and (np.linalg.norm(got, axis=1) > 0).sum() > 100
    # However the rows lie in tasks.
    assert np.array_equal(got, word_vectors(frame(spark, rows[::-1]).repartition(7)))
    assert not word_vectors(spark.createDataFrame([], SCHEMA)).any()
    places, signs = _index_vectors()
    assert set(signs.ravel()) == {1, -1} and set(places.ravel()) == set(range(SIZE))


def test_kept_rows_are_judged_one_by_one(spark):
    rows, labels = graded_rows()
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    # A good row outside the training folds, whose id comes again with a bad text and with its own.
    good = next(i for i in range(240) if i % 3 and crc(i, 5) == 0)
    docs = frame(spark, [*rows, (None, rows[1][1], None, None, None), (good, rows[0][1], "aa", "s", 1), rows[good], (None, None, None, None, None)], clashing=True)
    scores = {r.text: r.predicted for r in score_quality(docs.withColumn("doc_id", docs.text), fit_quality(docs, known)).withColumnRenamed("doc_id", "text").collect()}
    kept = keep_good(docs, known)
    assert sorted(map(repr, kept.collect())) == sorted(repr(r) for r in docs.collect() if scores[r.text])
    shuffles = [df._jdf.queryExecution().executedPlan().toString().count("Exchange ") for df in (docs, kept)]
    assert shuffles[0] == shuffles[1]
    assert sum(r.doc_id == good for r in kept.collect()) == 2 and any(r.doc_id is None for r in kept.collect())


def test_quality_scores_in_little_memory(spark):
    """An Arrow batch may hold many MB of text; the vectors of its words are summed a small part of it at a time."""
    words = ["alpha", "beta", "Gamma,", "delta.", "e"]
    texts = pa.array([" ".join(words[(i * j) % 5] for j in range(600)) for i in range(1200)])
    vectors = np.random.default_rng(0).normal(size=(SLOTS, SIZE)).astype(np.float32)
    n = 2 * SIZE + 3
    model = QualityModel(vectors, np.zeros(n), np.ones(n), np.full((n, 2), 0.01), np.zeros(2), np.ones(2), 0.0, 1.0)
    score = quality_score(spark, model).func
    alone = [next(score(iter([texts.slice(i, 1)])))[0].as_py() for i in (0, 7, 1199)]
    tracemalloc.start()
    whole = next(score(iter([texts])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(whole) == len(texts) and np.allclose([whole[i].as_py() for i in (0, 7, 1199)], alone)
    # 720,000 words of 48 numbers; it took 226 MB when slices of 2 MB were summed at once.
    assert peak < 40e6


def test_quality_does_not_see_other_columns(spark):
    rows, labels = graded_rows()
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = fit_quality(frame(spark, rows), known)
    other = [(i + 1000, t, None, None, None) for i, t, *_ in rows]
    a, b = ({r.doc_id: r.score for r in score_quality(frame(spark, x), model).collect()} for x in (rows, other))
    assert all(b[i + 1000] == pytest.approx(s) for i, s in a.items())


def test_languages_of_held_out_rows(spark):
    rows = [(i, speech(lang, i), lang if i % 10 else None, "s", 1) for i in range(150) for lang in [list(SYLLABLES)[i % 3]]]
    docs = frame(spark, rows, clashing=True)
    got = predict_language(docs, fit_language(docs)).collect()
    assert all(r.held_out == (crc(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in got) and len(got) == len(rows)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == list(SYLLABLES)[r.doc_id % 3] for r in held) >= 0.95 * len(held)


def test_languages_of_hard_rows(spark):
    docs = frame(spark, hard_rows(), clashing=True)
    got = sorted(((r.doc_id, r.lang_pred) for r in predict_language(docs, fit_language(docs)).collect()), key=repr)
    letters = lambda t: any(c.isalpha() for c in t or "")
    assert got == sorted(((r[0], "en" if letters(r[1]) else "und") for r in hard_rows()), key=repr)
    strict = predict_language(docs, fit_language(docs), max_distance=-1.0)
    assert {r.lang_pred for r in strict.collect()} == {"und"}
    empty = spark.createDataFrame([], SCHEMA)
    assert fit_language(empty) is None and predict_language(empty, None).collect() == []
    assert {(r.lang_pred, r.score) for r in predict_language(docs, None).collect()} == {("und", 0.0)}


def grams(text):
    """Hashed n-grams of one text by hand: letters made small, everything else that is ASCII a space."""
    data = (text or "").encode()
    small = bytearray()
    for k, c in enumerate(data):
        lead = k and data[k - 1] == 0xC3 and 0x80 <= c < 0x9F
        small.append(c + 32 if lead or 65 <= c < 91 else c if c >= 128 or 97 <= c < 123 else 32)
    found = {bytes(small[i : i + n]) for n in (1, 2, 3) for i in range(len(small) - n + 1)}
    code = lambda g: (int.from_bytes(g, "big") + (len(g) << 40)) * 0x9E3779B97F4A7C15 % (1 << 64)
    return {code(g) >> (64 - DIMENSIONS.bit_length() + 1) for g in found if g.strip(b" ")}


def test_document_frequencies_are_those_of_all_rows(spark):
    rows = [r for r in hard_rows() if r[1] is not None] + [(i, speech(list(SYLLABLES)[i % 3], i), "x", "s", 1) for i in range(90)]
    n, holding = document_frequencies(frame(spark, rows))
    lettered = [r[1] for r in rows if any(c.isalpha() for c in r[1])]
    expected = Counter(g for t in lettered for g in grams(t))
    assert n == len(lettered) and holding.tolist() == [expected[g] for g in range(DIMENSIONS)]


def test_language_sample_is_one_plan_with_equal_rows_once(spark):
    rows = [(i // 4, lang, f"text {i // 4} {i % 2}") for lang in ("a", "b", "c") for i in range(400)] + [(7, "hot", "same")] * 500
    known = spark.createDataFrame(rows, "fit_id long, lang string, text string").repartition(5)
    got = [tuple(r) for r in fit_rows(known, 9).collect()]
    assert len(set(got)) == len(got) and Counter(r[0] for r in got) == {"a": 9, "b": 9, "c": 9, "hot": 1}
    assert {(i, t) for lang, i, t in got if lang == "a"} == {(i, t) for lang, i, t in got if lang == "b"}
    plan = fit_rows(known, 9)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 2, "one narrow read and one of the texts, whatever the languages"


def test_scores_count_exactly(spark):
    rows = hard_rows() + [(1000 + i, words(i, 80), None, None, None) for i in range(60)]
    counts = Counter()
    tokens = lambda t: (t or "").encode().lower().split() + [b""]
    for r in rows:
        if crc(r[0], 7) != 2:
            counts.update(tokens(r[1]))
    total, kinds = sum(counts.values()), len(counts)
    got = sorted(score_texts(frame(spark, rows, clashing=True)).collect(), key=lambda r: (repr(r.doc_id), r.n_tokens, r.base_score))
    expected = sorted(
        ((r[0], crc(r[0], 7) == 2, len(tokens(r[1])), sum(counts[t] > 0 for t in tokens(r[1])), sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in tokens(r[1]))) for r in rows),
        key=lambda r: (repr(r[0]), r[2], r[4]),
    )
    assert len(got) == len(expected)
    for r, e in zip(got, expected):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (*e[:4], total)
        assert r.base_score == pytest.approx(e[4]) and math.isfinite(r.score) and r.score < 0 < r.bits_per_byte


def test_score_of_an_empty_table(spark):
    assert score_texts(spark.createDataFrame([], SCHEMA)).collect() == []


def flat(texts):
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    lengths = np.array([len(t) + 1 for t in texts])
    return data, np.cumsum(lengths) - lengths


def test_the_probabilities_of_all_first_bytes_add_up_to_one():
    texts = [b"abc", b"abd", b"xyz", b""]
    kinds = np.zeros(4, np.int64)
    table = np.zeros(2 << 22)
    count_bits(*flat(texts), kinds, np.array([50, 20, 5, 9]), table)
    model = fit_mixer(table, *flat(texts * 5), np.zeros(20, np.int64))
    # A word of one byte without its end: every byte value once, each as the first of a word.
    data = np.arange(256, dtype=np.uint8)
    p = 10 ** log10_words(data, np.arange(256), np.zeros(256, np.int64), model)
    assert p.sum() == pytest.approx(1, abs=1e-5)
    assert p[ord("a")] > p[ord("x")] > p[ord("q")]
    assert log10_words(*flat([b"abc"]), kinds[:1], model)[0] > log10_words(*flat([b"abq"]), kinds[:1], model)[0]


def test_weights_and_map_are_learned_from_every_training_token(spark, monkeypatch):
    rows = [(i, words(i, 40, 3000), None, None, None) for i in range(900)]
    seen = []
    learn = MixerFit.learn
    monkeypatch.setattr(MixerFit, "learn", lambda self, sums: (seen.append(sums), learn(self, sums)))
    score_texts(frame(spark, rows)).collect()
    tokens = [t for r in rows if crc(r[0], 7) != 2 for t in plain_words(r[1]) + [b""]]
    assert len(tokens) > 20_000 and seen and all(s["hits"].sum() == sum(8 * (len(t) + 1) for t in tokens) for s in seen)
    assert seen[-1]["loss"].sum() < seen[0]["loss"].sum()


def test_sums_of_a_word_that_stands_often_are_those_of_its_tokens():
    texts, counts = [b"abc", b"abd", b"", b"xyz"], np.array([5, 3, 9, 2])
    table = np.zeros(2 << 22)
    count_bits(*flat(texts), np.zeros(4, np.int64), counts, table)
    tokens = [t for t, n in zip(texts, counts) for _ in range(n)]
    once, all_tokens = no_sums(), no_sums()
    given = left_out(table), table[0::2] + table[1::2], MixerFit().weights
    add_sums(once, *flat(texts), np.zeros(4, np.int64), counts, *given)
    add_sums(all_tokens, *flat(tokens), np.zeros(len(tokens), np.int64), np.ones(len(tokens)), *given, chunk=7)
    assert all(np.allclose(once[name], all_tokens[name], rtol=1e-4) for name in once) and once["loss"].sum() > 0


def test_bits_of_a_beginning_are_looked_up_once(monkeypatch):
    rng = random.Random(1)
    texts = [b"", b"a" * 70, b"a" * 70 + b"b", b"a" * 200] + ["".join(rng.choice("abc") for _ in range(rng.randrange(12))).encode() for _ in range(600)]
    kinds, counts = np.array([rng.randrange(2) for _ in texts], np.uint8), np.array([rng.randrange(1, 9) for _ in texts])
    order = mixing.word_order(*flat(texts), kinds)
    data, starts = mixing.taken(*flat(texts), order)
    assert (data.tobytes(), starts.tolist()) == (b"".join(texts[i] + b" " for i in order), flat([texts[i] for i in order])[1].tolist())
    looked_up, slots = [], mixing._slots
    monkeypatch.setattr(mixing, "_slots", lambda context, node: (looked_up.append(len(node)), slots(context, node))[1])
    together, alone = np.zeros(2 << 22), np.zeros(2 << 22)
    count_bits(data, starts, kinds[order], counts[order], together)
    short = {(k, (t + b" ")[: i + 1]) for k, t in zip(kinds, texts) for i in range(min(64, len(t) + 1))}
    assert sum(looked_up) == 7 * 8 * (len(short) + sum(max(0, len(t) + 1 - 64) for t in texts)), "it was all bytes of all words before"
    for text, kind, n in zip(texts, kinds, counts):
        count_bits(*flat([text]), np.array([kind]), np.array([n]), alone)
    assert (together == alone).all()
    model = fit_mixer(together, data, starts, kinds[order])
    one_by_one = [log10_words(*flat([text]), np.array([kind]), model)[0] for text, kind in zip(texts, kinds)]
    assert np.allclose(log10_words(data, starts, kinds[order], model), np.array(one_by_one)[order], rtol=1e-5)
    # In any other order the result is the same, though less is shared.
    assert np.allclose(log10_words(*flat(texts), kinds, model), one_by_one, rtol=1e-5)


def test_tokens_and_profiles_of_many_texts_are_those_of_each():
    rows = ["", " \t\r\n", "One one ONE", "É é\u00a0x\x0by\x0cz", None, "a", "  lead and  trail ", "\x00 \x1f", "é", *[r[1] for r in hard_rows()], "x" * 5000, "end"]
    for texts in (pa.array(rows), pa.array(["cut", *rows, "cut"])[1:-1], pa.array([], pa.string()), pa.array([None], pa.string()), pa.array(["", ""])):
        text, number, distinct, tokens, in_bytes = lm._tokens(texts)
        distinct = lm._split(distinct)
        assert len(set(distinct)) == len(distinct) and distinct[-1] == b""
        for i, t in enumerate(texts.to_pylist()):
            expected = (t or "").encode().lower().split()
            assert [distinct[n] for n in number[text == i]] == [*expected, b""]
            assert (tokens[i], in_bytes[i]) == (len(expected) + 1, len(b" ".join(expected)) + bool(expected) + 1)
        assert (lm._profile(texts) == _counts(texts, *lm._PROFILE)[0]).all()


def test_kinds_are_clusters_of_all_training_rows(spark):
    # The reversed rows come with few words that are alike, so each kind of text has a centroid of its own.
    rows = [(i, words(i, 30) if i % 2 else words(i, 30)[::-1].upper().replace("W", "qz"), None, None, None) for i in range(1500)]
    train = pa.array([r[1] for r in rows if crc(r[0], 7) != 2])
    model = lm.fit_kinds(frame(spark, rows).selectExpr("doc_id as lm_id", "text", "crc32(cast(cast(doc_id as string) as binary)) % 7 <> 2 as train"))
    holding = (_counts(train, *lm._PROFILE)[0] > 0).sum(0)
    assert len(train) > 1200 and np.allclose(model["idf"], np.log((1 + len(train)) / (1 + holding)) + 1)
    kinds = lm._kinds(pa.array([r[1] for r in rows]), model)
    assert 2 <= len(model["centroids"]) <= lm.KINDS and not set(kinds[::2]) & set(kinds[1::2])


def test_profiles_travel_as_blocks_of_exact_counts(spark):
    texts = ["", None, " ", "a", "b" * 300, "c" * 70_000, "d" * 255, "e" * 256, "f" * 65_535, "g" * 65_536, *[words(i, 20) for i in range(2000)]]
    rows = spark.createDataFrame([(t, i % 5 > 0) for i, t in enumerate(texts)], "text string, train boolean").coalesce(1)
    expected = _counts(pa.array([t for i, t in enumerate(texts) if i % 5]), *lm._PROFILE)[0]
    expected = expected[expected.any(axis=1)]
    saved = lm._profiles(rows)
    assert saved.count() < 20, "it was a row for each text before"
    assert {r.width for r in saved.collect()} == {1, 2, 4}
    found = [(c, x) for counts, logs in lm._unprofiled(iter(saved.toArrow().to_batches())) for c, x in zip(counts, logs)]
    assert sorted(c.astype(np.int64).tobytes() for c, _ in found) == sorted(c.astype(np.int64).tobytes() for c in expected)
    assert all((x == np.log1p(c.astype(np.float64)).astype(np.float32)).all() for c, x in found)
    assert (lm._logs(expected.astype(np.int64)) == np.log1p(expected).astype(np.float32)).all()


def test_steps_of_counters_are_a_byte_each_and_the_last_pass_takes_no_derivatives():
    texts, counts = [f"{'xyz'[i % 3] * (i % 9)}{i % 40}".encode() for i in range(300)], np.arange(300) % 70 + 1
    table, kinds = np.zeros(2 << 22), np.zeros(300, np.int64)
    count_bits(*flat(texts), kinds, counts, table)
    seen = table[0::2] + table[1::2]
    steps = mixing.seen_steps(seen, less=1)
    assert steps.dtype == np.uint8
    met = np.flatnonzero(seen)
    whole, middle = (np.searchsorted(c, seen[met] - 1, side="right") for c in (mixing._WHOLE_COUNTS, mixing._MIDDLE_COUNTS))
    slots = [None] * len(mixing.CONTEXTS)
    slots[-1], slots[mixing._MIDDLE] = met, met[::-1]
    assert len(set(whole)) > 4 and (mixing._steps(steps, slots) == whole * 3 + middle[::-1]).all()
    given, weights = (left_out(table), steps), MixerFit().weights
    sums, plain, last = no_sums(), no_sums(), no_sums()
    add_sums(sums, *flat(texts), kinds, counts, *given, weights)
    add_sums(plain, *flat(texts), kinds, counts, given[0], seen, weights)
    add_sums(last, *flat(texts), kinds, counts, *given, weights, curved=False)
    assert all((sums[name] == plain[name]).all() for name in sums) and sums["curve"].any()
    assert all((last[name] == sums[name]).all() for name in ("loss", "hits", "ones")) and not last["curve"].any() and not last["slope"].any()
    fits = [MixerFit(), MixerFit()]
    for fit, of in zip(fits, (sums, last)):
        fit.learn(of)
    models = [fit.model(table) for fit in fits]
    assert all((models[0][name] == models[1][name]).all() for name in models[0])
