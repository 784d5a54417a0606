"""Benchmark passages in documents, found by winnowed fingerprints. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import saved

WINDOW = 10
#: Words of a fingerprint; of each WINDOW words the least of the WINDOW - GRAM + 1 fingerprints is kept.
GRAM = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z only) runs of ASCII letters, digits and all other characters beyond ASCII; null has none."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BETWEEN_WORDS)
    return F.filter(parts, lambda w: w != "")


def _shifted(values: Column, by: int, combine) -> Column:
    """``combine`` of each value and the one ``by`` places on; ``by`` values fewer."""
    n = F.greatest(F.size(values) - by, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(1), n), F.slice(values, F.lit(by + 1), n), combine)


def _spread(df: DataFrame, column: str, width: int, combine) -> DataFrame:
    """``column`` becomes ``combine`` over each ``width`` consecutive values, by doubling with overlaps.

    Every step is a projection of its own: nested in one expression, each would be computed three times over.
    """
    have = 1
    while have < width:
        step = min(have, width - have)
        df = df.withColumn(column, _shifted(F.col(column), step, combine))
        have += step
    return df


def _with_grams(df: DataFrame, column: str, width: int) -> DataFrame:
    """A hash of each ``width`` consecutive ``words``."""
    df = df.withColumn(column, F.transform("words", lambda w: F.xxhash64(w)))
    return _spread(df, column, width, lambda a, b: F.xxhash64(a, b))


def _with_prints(df: DataFrame, column: str, width: int) -> DataFrame:
    """The fingerprint of each window, in order: for whole windows the least of their grams, else the gram."""
    if width < WINDOW:
        return _with_grams(df, column, width)
    return _spread(_with_grams(df, column, GRAM), column, WINDOW - GRAM + 1, lambda a, b: F.least(a, b))


def _texts(words: Column, width: int) -> Column:
    """The windows of ``width`` words themselves, words joined by a space."""
    starts = F.when(F.size(words) >= width, F.sequence(F.lit(1), F.size(words) - (width - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(width)), " "))


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """How much of each document occurs in the benchmark: one row per row of ``docs``.

    Returns ``id_col``, n_words, n_hit, n_items, items (the item ids as sorted strings) and contaminated. A word
    is hit within any occurrence of a window of WINDOW consecutive words of an item; an item with fewer words is
    one window. Winnowing: a window is represented by its least 4-word fingerprint, so every shared window
    shares a fingerprint. Documents and items meet on these; only windows whose fingerprint has met are
    compared word by word, and the equal ones extend to the hit spans.

    Null or wordless texts hit nothing. An item without an id marks words but is not counted; rows that repeat
    an item id are one item. Rows with one doc_id and different texts are judged apart. An empty benchmark hits
    nothing. Other columns are ignored, whatever their names.
    """
    items = benchmark.select(F.col(item_col).alias("item"), words_of(F.col(item_text_col).cast("string")).alias("words"))
    items = saved(items.where(F.size("words") > 0), "items")
    # At most nine widths, whatever the benchmark's size.
    short = sorted(r[0] for r in items.where(F.size("words") < WINDOW).select(F.size("words")).distinct().collect())

    def of_items(build) -> DataFrame:
        """``build(width)`` of the items that have windows of that width."""
        out = None
        for width in [*short, WINDOW]:
            fitting = items.where(F.size("words") >= width) if width == WINDOW else items.where(F.size("words") == width)
            part = build(fitting, width)
            out = part if out is None else out.unionByName(part)
        return out

    prints = of_items(
        lambda rows, width: _with_prints(rows, "prints", width).select(F.lit(width).alias("width"), F.explode("prints").alias("print"))
    ).distinct()
    prints = saved(prints, "prints")
    windows = of_items(lambda rows, width: rows.select("item", F.lit(width).alias("width"), F.explode(_texts(F.col("words"), width)).alias("gram")))
    windows = saved(windows.distinct(), "windows")

    keys = ["hit_id", "hit_key"]
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("hit_id"), F.xxhash64(text).alias("hit_key"), F.col(id_col).alias("hit_doc"), text.alias("hit_text")
    )
    marked = rows.select(*keys, "hit_doc", words_of(F.col("hit_text")).alias("words"))
    for width in [*short, WINDOW]:
        marked = _with_prints(marked, f"prints_{width}", width)
    columns = [F.array_distinct(f"prints_{w}").alias(f"prints_{w}") for w in [*short, WINDOW]]
    scanned = saved(marked.select(*keys, "hit_doc", F.size("words").cast("long").alias("n_words"), *columns), "scanned")
    candidates = None
    for width in [*short, WINDOW]:
        part = scanned.select(*keys, F.explode(f"prints_{width}").alias("print")).join(prints.where(F.col("width") == width), "print", "left_semi").select(*keys)
        candidates = part if candidates is None else candidates.unionByName(part)
    candidates = saved(candidates.distinct(), "candidates")

    near = rows.join(candidates, keys, "left_semi").select(*keys, words_of(F.col("hit_text")).alias("words"))
    near = saved(near, "near")
    hits = None
    for width in [*short, WINDOW]:
        part = _with_prints(near, "print", width).withColumn("gram", _texts(F.col("words"), width))
        part = part.select(*keys, F.posexplode(F.arrays_zip("print", "gram")).alias("start", "window"))
        part = part.select(*keys, "start", F.lit(width).alias("width"), "window.print", "window.gram")
        hits = part if hits is None else hits.unionByName(part)
    hits = hits.join(prints, ["width", "print"], "left_semi").join(windows.select("width", "gram").distinct(), ["width", "gram"])
    hits = saved(hits.select(*keys, "start", "width", "gram").distinct(), "hits")

    before = Window.partitionBy(*keys).orderBy("start", "width").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("width")
    covered = F.greatest(end - F.greatest("start", F.coalesce(F.max(end).over(before), F.lit(0))), F.lit(0))
    words_hit = hits.withColumn("covered", covered).groupBy(*keys).agg(F.sum("covered").cast("long").alias("n_hit"))
    named = hits.select(*keys, "width", "gram").distinct().join(windows, ["width", "gram"]).where("item is not null").select(*keys, F.col("item").cast("string").alias("item")).distinct()
    items_hit = named.groupBy(*keys).agg(F.count("*").alias("n_items"), F.sort_array(F.collect_list("item")).alias("items"))
    result = scanned.select(*keys, "hit_doc", "n_words").join(words_hit.join(items_hit, keys, "left"), keys, "left")
    return result.select(
        F.col("hit_doc").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id has no hit in the benchmark, with the columns of ``docs``."""
    hit = contamination(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("__hit_id")).distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["__hit_id"]), "left_anti")
