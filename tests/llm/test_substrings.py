"""Removal of repeated passages against brute force over all windows."""

import numpy as np
import pytest
from corpora import SCHEMA, frame, hard_rows, plain_words, words
from sluiceway.llm.substrings import remove_repeats
from sluiceway.llm.words import sliding_minimum, window_hashes


def brute(rows, window=20):
    """Rows with distinct (id, text), in order of id, to (n_words, n_removed, kept)."""
    seen, out = set(), {}
    for r in rows:
        ws, marked = plain_words(r[1]), set()
        for i in range(len(ws) - window + 1):
            w = tuple(ws[i : i + window])
            if w in seen:
                marked.update(range(i, i + window))
            seen.add(w)
        out[r[0], r[1]] = (len(ws), len(marked), b" ".join(w for i, w in enumerate(ws) if i not in marked).decode())
    return out


@pytest.mark.parametrize("window", [20, 3])
def test_hard_rows_with_clashing_columns(spark, window):
    rows = hard_rows()
    # One id with two texts is ordered by a hash; keep one of them so that brute force knows the order.
    rows = [r for r in rows if r[1] != "other text for this id"]
    distinct = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None))
    expected = brute(distinct, window)
    got = remove_repeats(frame(spark, rows, clashing=True), window=window, carry=["text", "source"]).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_removed, r.kept_text) == expected[r.doc_id, r.text], r.doc_id
    assert sum(r.n_removed for r in got) > 0


def test_many_copies_and_lines_over_many_batches(spark):
    line = words(1, 25)
    rows = [(i, f"{line} {words(100 + i, 30)} {line}" if i % 3 else words(2, 100)) for i in range(300)]
    expected = brute(rows)
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), carry=["text"]).collect()
    assert {(r.doc_id, r.text): (r.n_words, r.n_removed, r.kept_text) for r in got} == expected


def test_one_id_with_two_texts(spark):
    rows = [(1, words(1, 30)), (1, "x " + words(1, 30))]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), carry=["text"]).collect()
    assert sorted(r.n_removed for r in got) == [0, 30]


def test_empty_table_and_names(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError, match="n_words"):
        remove_repeats(spark.createDataFrame([], SCHEMA), carry=["n_words"])


def test_window_hashes_tell_windows_apart():
    values = np.random.default_rng(1).integers(0, 3, 3000).astype(np.uint64)
    hashes = window_hashes(values, 5)
    windows = [tuple(values[i : i + 5]) for i in range(len(values) - 4)]
    assert len({(w, h) for w, h in zip(windows, hashes.tolist())}) == len(set(windows)) == len(set(hashes.tolist()))
    assert sliding_minimum(values, 7).tolist() == [min(values[i : i + 7]) for i in range(len(values) - 6)]
