"""Small inputs of the operator tests: hard rows, and tables with columns whose names clash with the operators' own."""

import random
import zlib

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return.
CLASHING = ["fp", "component", "sub_id", "hit_id", "bucket", "unit", "runs", "size", "shard", "arc", "words", "score", "label", "packed_id", "salt", "n_words", "start", "key", "group"]


def words(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def hard_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows, near copies, odd white space and signs."""
    passage = words(1, 40)
    texts = [
        None, "", "   \t\n", "one", "one two three", "Ünï cödé ßs ÀÉ 漢字 data", words(2, 19), words(3, 20), passage, passage,
        f"{words(4, 15)} {passage} {words(5, 15)}", f"{passage}\x0b{passage}", "same " * 60, "x" * 3000, words(6, 6000),
        words(7, 200), words(7, 200) + " changed", words(7, 200).upper(), "<|endoftext|> here", "a\x00b\x1cc \x85 d", "!!! ??? ...", "1234 5678",
    ]
    rows = [(i * 3, t, "en" if i % 2 else None, None if i % 3 else "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return rows + [(None, "one two three", None, None, None), (None, None, None, None, None), rows[8], rows[8], (rows[9][0], "other text for this id", "en", "s", 22)]


def frame(spark, rows, clashing=False):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if clashing:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit("own").alias(c) for c in CLASHING if c not in df.columns])
    return df


def crc(value, modulus: int) -> int:
    return zlib.crc32(("" if value is None else str(value)).encode()) % modulus


def plain_words(text) -> list[bytes]:
    return (text or "").encode().split()
