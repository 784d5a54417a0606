"""Archives: exact round trips, revisits, rolling, bytes that do not depend on the cluster, damage."""

import gzip
import hashlib
import os

import pytest
from sluiceway.llm.warc import read_warc, records_of, write_warc

SCHEMA = "page_id long, url string, html string"
LONG = "<p>é" + "x" * 200
ROWS = [
    (5, "http://a/é ü?q=1\r\nX: y", LONG), (2, "http://b", LONG), (2, "http://b", LONG), (9, None, "short"), (1, "u", "short"), (3, "u", None), (4, "u", ""),
    (2000, "u", LONG), (2001, "u", "y" * 5000), (-3, "u", "z" * 150), (None, "u", "z" * 150), (None, None, None), (2001, "u", LONG),
]


def pages(spark, rows=ROWS):
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, SCHEMA).repartition(3).select("*", *[F.lit("own").alias(c) for c in ("key", "shard", "kind", "digest", "payload", "first")])


def folder(tmp_path, name="w"):
    return f"file://{tmp_path}/{name}"


def test_round_trip(spark, tmp_path):
    manifest = write_warc(pages(spark), folder(tmp_path)).collect()
    assert sum(m.records for m in manifest) == len(ROWS)
    got = read_warc(spark, folder(tmp_path)).collect()
    smallest = {}
    for i, _, html in ROWS:
        body = (html or "").encode()
        key = (i is not None, i or 0)
        if len(body) >= 100:
            smallest[body] = min(smallest.get(body, key), key)
    expected, first = [], set()
    for i, _, html in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        body = (html or "").encode()
        source = smallest.get(body)
        own = (i is not None, i or 0)
        revisit = source is not None and (source != own or (own, body) in first)
        first.add((own, body))
        expected.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", (source[1] if source[0] else None) if revisit else None, None if revisit else body))
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    assert "http://a/%C3%A9%20%C3%BC?q=1%0D%0AX:%20y" in {r.url for r in got}


def test_rolls_and_is_equal_to_the_byte_however_partitioned(spark, tmp_path):
    rows = [(i, f"u{i}", os.urandom(300).hex()) for i in range(60)]
    files = []
    for name, parts in (("a", 1), ("b", 5)):
        write_warc(pages(spark, rows).repartition(parts), folder(tmp_path, name), shard_ids=25, roll_bytes=3000)
        files.append({f: (tmp_path / name / f).read_bytes() for f in os.listdir(tmp_path / name) if not f.startswith(".")})
    assert files[0] == files[1] and sum(f.endswith(".warc.gz") for f in files[0]) > 9
    assert all(len(b) <= 3000 for f, b in files[0].items() if f.endswith(".gz"))
    assert not any(f.endswith(".tmp") for f in os.listdir(tmp_path / "a"))
    kinds = [h["warc-type"] for f, b in sorted(files[0].items()) if f.endswith(".gz") for h, _ in records_of(b)]
    assert kinds.count("response") == 60 and kinds[0] == "warcinfo"
    # Written again, as by a second attempt, nothing changes.
    write_warc(pages(spark, rows), folder(tmp_path, "a"), shard_ids=25, roll_bytes=3000)
    assert {f: (tmp_path / "a" / f).read_bytes() for f in files[0]} == files[0]


def test_damage_and_loss_raise(spark, tmp_path):
    write_warc(pages(spark), folder(tmp_path))
    files = [f for f in os.listdir(tmp_path / "w") if f.endswith(".warc.gz")]
    name, content = next((f, c) for f in files if b"zzz" in (c := gzip.decompress((tmp_path / "w" / f).read_bytes())))
    with pytest.raises(ValueError, match="damaged"):
        list(records_of(gzip.compress(content.replace(b"zzz", b"zaz", 1))))
    os.remove(tmp_path / "w" / name)
    with pytest.raises(ValueError, match="missing"):
        read_warc(spark, folder(tmp_path))


def test_files_without_a_manifest_are_left_out(spark, tmp_path):
    write_warc(pages(spark), folder(tmp_path))
    (tmp_path / "w" / "stray.warc.gz").write_bytes(b"not an archive")
    assert read_warc(spark, folder(tmp_path)).count() == len(ROWS)


def test_empty_table(spark, tmp_path):
    assert write_warc(pages(spark, []), folder(tmp_path)).collect() == []
    assert read_warc(spark, folder(tmp_path)).collect() == []
