"""Archives: round trip, revisits, seeking and repeated tasks."""

import glob
import hashlib
import random
import struct

import pytest
import zstandard

from rillstone.llm import warc
from rillstone.llm.common import new_folder


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string")


def expected(rows, least=100):
    out = []
    for page, _, html, _ in rows:
        body = (html or "").encode()
        same = [p for p, _, h, _ in rows if (h or "") == (html or "") and p is not None]
        first = min(same, default=None)
        revisit = len(body) >= least and first is not None and (page is None or page > first)
        out.append((page, "revisit" if revisit else "response", first if revisit else None, hashlib.sha256(body).hexdigest(), len(body)))
    return sorted(out, key=str)


@pytest.mark.parametrize("few", [100_000, 0])
def test_round_trip(spark, monkeypatch, few):
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", few)
    pick = random.Random(few)
    hot = "<p>hot é\r\n\r\nWARC/1.1</p>" * 9
    rows = [(i, pick.choice([None, "http://a/ü?q=1\r\nX: y", ""]), pick.choice([hot, hot, None, "", "short", "long " * 300, f"own {i} " * 40]), "x") for i in range(300)]
    rows += [(None, None, hot, None), (7, None, rows[7][2], None), (1000, None, "x" * 300_000, None)]
    path = new_folder(spark, "test-warc")
    index = warc.write_archive(pages_of(spark, rows).repartition(4), path, frame_bytes=4000, bundle_bytes=2_000)
    got = warc.read_archive(spark, path).collect()
    assert sorted(((r.page_id, r.record_type, r.refers_to, r.payload_digest, r.payload_bytes) for r in got), key=str) == expected(rows)
    for r in got:
        assert (r.payload is None) == (r.record_type == "revisit") and (r.payload is None or hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest)
    assert index.count() == len(rows) and index.select("bundle").distinct().count() > 4
    some = spark.createDataFrame([(3,), (3,), (1000,), (77,), (-5,)], "page_id long")
    assert sorted(r.page_id for r in warc.lookup(spark, path, some).collect()) == [3, 77, 1000]


def test_bundles_are_whole_zstandard_files_with_a_seek_table(spark):
    path = new_folder(spark, "test-warc")
    warc.write_archive(pages_of(spark, [(i, "u", f"page {i} " * 50, "") for i in range(40)]).coalesce(1), path, frame_bytes=3000)
    (name,) = glob.glob(f"{path.removeprefix('file://')}/bundles/*.warc.zst")
    with open(name, "rb") as f:
        data = f.read()
    n, flags, magic = struct.unpack("<IBI", data[-9:])
    assert magic == 0x8F92EAB1 and n > 3 and flags == 0
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == 40 and sum(struct.unpack_from("<II", data, len(data) - 9 - 8 * (n - k))[1] for k in range(n)) == len(whole)
    with open(name.replace("part-", "part-orphan-"), "wb") as f:  # what a lost attempt may leave behind
        f.write(data)
    assert warc.read_archive(spark, path).count() == 40


def test_damage_and_empty_tables(spark):
    path = new_folder(spark, "test-warc")
    warc.write_archive(pages_of(spark, []), path)
    assert warc.read_archive(spark, path).count() == 0
    with pytest.raises(ValueError, match="damaged"):
        list(warc._rows(warc.record(1, None, b"abc", hashlib.sha256(b"abd").hexdigest(), None, "2024-01-01T00:00:00Z"), 0, True))
