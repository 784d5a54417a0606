"""Spelling variants: words one letter apart, found as pairs of trie nodes, and the word that each stands for.

A word's beginnings are nodes of a trie and its ends nodes of the trie of reversed words. Words that differ in
one replaced letter have a pair (node before the letter, node after it) in common. A word with a letter more than
another has, around that letter, the pair that the other has at the place between. So the pairs with a letter
skipped and those without are a dictionary whose entries are exact neighbours, and nothing else has to be compared.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import saved, slices
from .words import mixed

MIN_LETTERS, MIN_COUNT, RATIO = 6, 5, 5
#: Distinct words that a task counts before it hands them on, and bytes of a text that are split at a time.
HELD, PART_BYTES = 300_000, 4 << 20
_RADIX = np.uint64(0x9E3779B97F4A7C15)
_RADIX_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: A pair of nodes with nothing between them, with a letter skipped, and with the first of equal letters skipped.
_GAP, _SKIP, _SKIP_FIRST = 0, 1, 2


def _letters() -> bytes:
    """Latin-1 bytes: A-Z in lower case, a-z and U+00C0 to U+00FF as they are, a space for all others."""
    keep = [*range(97, 123), *range(0xC0, 0x100)]
    return bytes(c if c in keep else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def _parts(text: str, table: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some megabytes at a time; no word is cut."""
    data = text.encode("latin-1", "replace").translate(table)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PART_BYTES)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS, slips: int | None = None) -> DataFrame:
    """(word, n): how often each word of ``min_letters`` or more occurs in all texts.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case. With ``slips`` a word loses a letter where
    the crc32 of its document's id, a colon and the word is divisible by it: the letter at that number modulo its
    length. A null id counts as empty there.
    """
    table = _letters()

    def emitted(counts: Counter) -> pa.RecordBatch:
        words = [w.decode("latin-1") for w, n in counts.items() if n and len(w) >= min_letters]
        seen = [n for w, n in counts.items() if n and len(w) >= min_letters]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(seen, pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches, "text"):
            for name, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                begin = crc32(f"{'' if name is None else name}:".encode())
                for words in _parts(text or "", table):
                    counts.update(words)
                    for word in set(words) if slips else ():
                        h = crc32(word if word.isascii() else word.decode("latin-1").encode(), begin)
                        if h % slips == 0:
                            n, at = words.count(word), h % len(word)
                            counts[word] -= n
                            counts[word[:at] + word[at + 1 :]] += n
                if len(counts) >= HELD:
                    yield emitted(counts)
                    counts.clear()
        yield emitted(counts)

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _numbered(words: list[str], seed: int) -> tuple[np.ndarray, ...]:
    """Of all places in all words: the word, the place, numbers of the nodes before and after it, and the letters.

    A node's number is made from the letters that lead to it and their number.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    begins = np.concatenate(([0], np.cumsum(sizes)))
    letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    sums = np.zeros(len(letters) + 1, np.uint64)
    powers = np.full(len(letters) + 1, _RADIX, np.uint64)
    powers[0] = 1
    np.cumsum(mixed(letters.astype(np.uint64) + np.uint64(1 + seed * 0x110000)) * np.multiply.accumulate(powers)[:-1], out=sums[1:])
    back = np.full(len(letters) + 1, _RADIX_INVERSE, np.uint64)
    back[0] = 1
    back = np.multiply.accumulate(back)
    word = np.repeat(np.arange(len(words)), sizes + 1)
    place = np.arange(len(word)) - (begins[:-1] + np.arange(len(words)))[word]
    at = begins[word] + place
    before = mixed(mixed((sums[at] - sums[begins[word]]) * back[begins[word]]) ^ place.astype(np.uint64))
    after = mixed(mixed((sums[begins[word + 1]] - sums[at]) * back[at]) ^ (sizes[word] - place).astype(np.uint64))
    return word, place, before.view(np.int64), after.view(np.int64), letters, at


def _pairs(words: DataFrame, seed: int) -> DataFrame:
    """(before, after, kind, id, n): the pairs of nodes of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "word", size=1 << 18):
            texts = batch.column("word").to_pylist()
            word, place, before, after, letters, at = _numbered(texts, seed)
            inside = np.flatnonzero(np.append(word[1:] == word[:-1], False))
            k = at[inside]
            again = (place[inside] > 0) & (letters[k] == letters[k - 1])
            owner = np.concatenate([word, word[inside]])
            kind = np.concatenate([np.full(len(word), _GAP, np.int8), np.where(again, _SKIP, _SKIP_FIRST).astype(np.int8)])
            ids, n = batch.column("id").to_numpy(), batch.column("n").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (np.concatenate([before, before[inside]]), np.concatenate([after, after[inside + 1]]), kind, ids[owner], n[owner])],
                ["before", "after", "kind", "id", "n"],
            )

    return words.mapInArrow(run, "before long, after long, kind byte, id long, n long")


def _numbers_clash(words: DataFrame, seed: int) -> bool:
    """Whether two nodes of a trie have one number: whether a number comes from different (parent, letter).

    If none does, then, from the root down, each number stands for one row of letters.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "word", size=1 << 18):
            word, _, before, after, letters, at = _numbered(batch.column("word").to_pylist(), seed)
            inside = np.flatnonzero(np.append(word[1:] == word[:-1], False))
            letter = letters[at[inside]].astype(np.int64)
            for reverse, node, parent in ((False, before[inside + 1], before[inside]), (True, after[inside], after[inside + 1])):
                order = np.lexsort((letter, parent, node))
                edge = np.stack([node[order], parent[order], letter[order]])
                edge = edge[:, np.concatenate((np.ones(min(1, len(order)), bool), (edge[:, 1:] != edge[:, :-1]).any(axis=0)))]
                yield pa.RecordBatch.from_arrays([pa.array([reverse] * edge.shape[1], pa.bool_()), *map(pa.array, edge)], ["reverse", "node", "parent", "letter"])

    edges = words.mapInArrow(run, "reverse boolean, node long, parent long, letter long")
    edge = F.struct("parent", "letter")
    return not edges.groupBy("reverse", "node").agg(F.min(edge).alias("a"), F.max(edge).alias("b")).where("a <> b").isEmpty()


def near_words(words: DataFrame) -> DataFrame:
    """(id, n_near, best) of the words (id, word, n; each word once) that have words one letter apart.

    ``best`` is (-n, id) of the most frequent of these, of equal ones that with the least id. Words that share a
    pair with a letter skipped differ in that letter alone, so there are no more of them than letters, and one
    word has the pair without a skip. Of equal neighbouring letters only the first is skipped for a shorter word,
    so each two words meet once.
    """
    seed = next(s for s in count() if not _numbers_clash(words, s))
    met = _pairs(words, seed).groupBy("before", "after").agg(F.collect_list(F.struct("id", "n", "kind")).alias("met")).where(F.size("met") > 1)
    one = met.select("met", F.explode("met").alias("x"))

    def neighbour(y):
        longer = (F.col("x.kind") == _GAP) & (y.kind == _SKIP_FIRST)
        shorter = (F.col("x.kind") == _SKIP_FIRST) & (y.kind == _GAP)
        replaced = (F.col("x.kind") != _GAP) & (y.kind != _GAP) & (F.col("x.id") != y.id)
        return longer | shorter | replaced

    near = one.select("x.id", F.filter("met", neighbour).alias("near")).where(F.size("near") > 0)
    best = F.array_min(F.transform("near", lambda y: F.struct((-y.n).alias("minus_n"), y.id.alias("id"))))
    return near.select("id", F.size("near").alias("k"), best.alias("best")).groupBy("id").agg(F.sum("k").alias("n_near"), F.min("best").alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """(id, root) for links (id, form): each form is far more frequent, so chains are short and end."""
    links = saved(links.select("id", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not links.where("moved").isEmpty():
        further = links.select(F.col("id").alias("root"), F.col("root").alias("beyond"))
        links = links.join(further, "root", "left")
        links = saved(links.select("id", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
    return links.select("id", "root")


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, ratio: int = RATIO, slips: int | None = None
) -> DataFrame:
    """(word, form, root, n, n_near, form_n): one row per word of :func:`word_counts` with ``min_count`` occurrences or more.

    Two words are near if one inserted, deleted or replaced letter makes one of the other. A word's form is its
    near word of the largest n, of ties the first in code-point order, where that n is at least ``ratio`` times the
    word's; else null. root follows forms to the last one. Null texts have no words; rows that repeat an id or a
    text count each. Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    words = word_counts(docs, id_col, text_col, min_letters, slips).where(F.col("n") >= min_count)
    # Ranges in order, numbered in order: smaller ids are smaller words.
    words = saved(words.orderBy("word").withColumn("id", F.monotonically_increasing_id()), "words")
    near = saved(near_words(words).select("id", "n_near", F.col("best.id").alias("form"), (-F.col("best.minus_n")).alias("form_n")), "near")
    links = near.join(words.select("id", "n"), "id").where(F.col("form_n") >= ratio * F.col("n")).select("id", "form", "form_n")
    links = saved(links, "forms")
    named = links.join(_roots(links), "id")
    for column in ("form", "root"):
        named = named.join(words.select(F.col("id").alias(column), F.col("word").alias(f"{column}_word")), column)
    named = named.select("id", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "form_n")
    rows = words.join(near.select("id", "n_near"), "id", "left").join(named, "id", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")
