"""Spelling variants against brute force over all pairs of words."""

import random
import re
from collections import Counter
from zlib import crc32

from corpora import SCHEMA, frame, hard_rows
from sluiceway.llm import queries, variants
from sluiceway.llm.variants import near_words, spelling_variants

SF_DIR = "/root/testdata/sf0.001"


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, min_letters=6, min_count=5, ratio=5, slips=None):
    counts = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r[1] or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = crc32(f"{'' if r[0] is None else r[0]}:{word}".encode())
            if slips and h % slips == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if n >= min_count and len(w) >= min_letters}
    sizes = {}
    for w in counts:
        sizes.setdefault(len(w), []).append(w)
    out, form = [], {}
    for w, n in counts.items():
        near = [v for k in (-1, 0, 1) for v in sizes.get(len(w) + k, ()) if one_apart(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= ratio * n:
            form[w] = best
        out.append((w, n, len(near)))
    result = []
    for w, n, near in out:
        root = w
        while root in form:
            root = form[root]
        result.append((w, form.get(w), root, n, near, counts[form[w]] if w in form else None))
    return sorted(result, key=repr)


def rows_with_variants():
    rng = random.Random(4)
    words = ["aaabbb", "seven", "letters", "colour", "mississippi", "ÀÉîõüÿ", "straße", "Zebras"]
    bag = []
    for w in words:
        bag += [w] * 400
        for _ in range(12):
            v = w
            for _ in range(rng.randrange(1, 3)):
                at = rng.randrange(len(v))
                v = rng.choice([v[:at] + v[at + 1 :], v[:at] + v[at] + v[at:], v[:at] + rng.choice("aebÀß") + v[at + 1 :], v[:at] + rng.choice("stß") + v[at:]])
            bag += [v] * rng.randrange(3, 60)
    bag += ["long" * 700] * 60 + ["long" * 700 + "x"] * 6 + ["漢zusammen漢", "don't"] * 9
    rng.shuffle(bag)
    return [(i, " ".join(bag[i::40]), "en", "s", None) for i in range(40)]


def test_words_one_letter_apart(spark):
    rows = rows_with_variants()
    for slips in (None, 7, 199):
        got = spelling_variants(frame(spark, rows), slips=slips).collect()
        assert sorted(map(tuple, got), key=repr) == brute(rows, slips=slips)


def test_hard_rows_with_clashing_columns(spark):
    rows = hard_rows()
    for letters, least in ((1, 1), (2, 2)):
        got = spelling_variants(frame(spark, rows, clashing=True), min_letters=letters, min_count=least, slips=3).collect()
        assert sorted(map(tuple, got), key=repr) == brute(rows, letters, least, slips=3)


def test_long_texts_are_split_without_cutting_words(monkeypatch):
    monkeypatch.setattr(variants, "PART_BYTES", 10)
    words = [w for part in variants._parts("one three fivesixseven  eight Ünten", variants._letters()) for w in part]
    assert [w.decode("latin-1") for w in words] == ["one", "three", "fivesixseven", "eight", "Ünten"]


def test_clashing_numbers_are_seen_and_made_anew(spark, monkeypatch):
    words = spark.createDataFrame([(0, "abcdef", 9), (1, "abcdeg", 8), (2, "zzzzzz", 7)], "id long, word string, n long")
    assert not variants._numbers_clash(words, 0)
    exact = sorted(map(tuple, near_words(words).select("id", "n_near").collect()))
    assert exact == [(0, 1), (1, 1)]
    plain = variants.mixed
    monkeypatch.setattr(variants, "mixed", lambda h: plain(h) & variants.np.uint64(3))
    assert variants._numbers_clash(words, 0)


def test_empty_table(spark):
    assert spelling_variants(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = queries.QUERIES["op12_variants"](spark, SF_DIR).collect()
    assert sorted(map(tuple, got), key=repr) == brute(docs, slips=199) and len(got) > 100
