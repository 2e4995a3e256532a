import gzip
import hashlib
import io

import pyarrow as pa
import pytest

from quirework.llm.warc import DAMAGED, EMPTY_MEMBER, gzip_member, read_archives, scan_range, warc_record, write_archives


def archive(payloads):
    return b"".join(gzip_member(warc_record(i, f"http://a/{i}", p, hashlib.sha256(p).hexdigest(), None)) for i, p in enumerate(payloads))


def test_every_cut_gives_each_record_once():
    # the magic number inside of payloads that hardly compress, and a false member
    import random

    rng = random.Random(3)
    noise = [bytes(rng.randrange(256) for _ in range(300)) + b"\x1f\x8b\x08\x00" + bytes(40) for _ in range(6)]
    data = archive(noise) + EMPTY_MEMBER + gzip_member(b"not a record") + archive([b"last"])
    for step in (7, 64, 10**6):
        for width in (50, 333, 1000, len(data)):
            got = []
            for at in range(0, len(data), width):
                got += list(scan_range(pa.BufferReader(data), at, at + width, step))
            assert DAMAGED not in {r["record_type"] for _, r in got}
            assert [r["payload"] for _, r in got] == [*noise, b"last"]
            assert len({at for at, _ in got}) == len(got)


def test_files_are_plain_gzip(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://x/ä b", "h" * 200), (2, None, "h" * 200), (3, "u", None), (4, "u", "k")], "page_id long, url string, html string")
    path = f"file://{tmp_path}/warc"
    write_archives(pages, path)
    text = b"".join(gzip.GzipFile(fileobj=io.BytesIO(f.read_bytes())).read() for f in sorted((tmp_path / "warc").glob("part-*")) if f.stat().st_size)
    assert text.count(b"WARC/1.1\r\n") == 4 and text.count(b"WARC-Type: revisit") == 1


def test_odd_rows(spark, tmp_path):
    rows = [(1, "u", "p" * 100, 1), (2, "u", "p" * 100, 2), (3, "u", "q" * 99, 3), (4, "u", "q" * 99, 4), (5, "u", None, 5), (6, "u", "", 6), (0, "v", "ü" * 50, 7), (9, "v", "ü" * 50, 8), (7, "w", "z" * 20_000_000, 9), (8, "w", "r" * 500, 1), (8, "w", "r" * 500, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest long")
    path = f"file://{tmp_path}/warc"
    write_archives(pages, path)
    for size in (500, 8 << 20):
        got = sorted((int(r.record_id.split(":")[-1]), r.record_type, r.payload_bytes, r.payload_digest, r.refers_to and int(r.refers_to.split(":")[-1])) for r in read_archives(spark, path, size, with_payload=False).collect())
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert len(got) == len(rows)
        assert got[:4] == [(0, "response", 100, sha("ü" * 50), None), (1, "response", 100, sha("p" * 100), None), (2, "revisit", 100, sha("p" * 100), 1), (3, "response", 99, sha("q" * 99), None)]
        assert [x[1] for x in got if x[0] in (4, 5, 6, 7)] == ["response"] * 4
        assert [x for x in got if x[0] == 8] == [(8, "response", 500, sha("r" * 500), None)] * 2
        assert got[-1] == (9, "revisit", 100, sha("ü" * 50), 0)
    empty = f"file://{tmp_path}/empty"
    write_archives(pages.where("page_id < 0"), empty)
    assert read_archives(spark, empty).count() == 0


def test_damage_is_told_whatever_the_ranges():
    parts = [archive([bytes([65 + i]) * (50 + 400 * i)]) for i in range(6)]
    whole = b"".join(parts)
    starts = [sum(map(len, parts[:i])) for i in range(6)]
    for k in range(6):
        flipped = bytearray(whole)
        flipped[starts[k] + len(parts[k]) // 2] ^= 0x10
        for data, hurt in ((bytes(flipped), starts[k]), (whole[: starts[k] + len(parts[k]) - 3], starts[k])):
            kept = [i for i in range(6) if i != k] if len(data) == len(whole) else list(range(k))
            for width in (40, 200, 1000, len(whole)):
                got = [x for at in range(0, len(data), width) for x in scan_range(pa.BufferReader(data), at, at + width, 64)]
                assert [at for at, r in got if r["record_type"] != DAMAGED] == [starts[i] for i in kept]
                assert {at for at, r in got if r["record_type"] == DAMAGED} == {hurt}


def test_wrong_digest_is_damage():
    data = gzip_member(warc_record(1, "u", b"abc", hashlib.sha256(b"abd").hexdigest(), None))
    assert [r["record_type"] for _, r in scan_range(pa.BufferReader(data), 0, len(data))] == [DAMAGED]


def test_damage_fails_the_job(spark, tmp_path):
    path = f"file://{tmp_path}/warc"
    write_archives(spark.createDataFrame([(i, "u", f"{i} " * 300) for i in range(6)], "page_id long, url string, html string").coalesce(1), path)
    file = next(f for f in (tmp_path / "warc").glob("part-*") if f.stat().st_size)
    data = bytearray(file.read_bytes())
    data[len(data) // 2] ^= 1
    file.write_bytes(data)
    (tmp_path / "warc" / f".{file.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match="damaged record at byte"):
        read_archives(spark, path, 300).count()
    types = [r.record_type for r in read_archives(spark, path, 300, keep_damaged=True).collect()]
    assert types.count("response") == 5 and DAMAGED in types
    assert read_archives(spark, path, 300, keep_damaged=True, max_tasks=2).rdd.getNumPartitions() == 2


def test_null_ids(spark, tmp_path):
    rows = [(None, "u", "p" * 100), (2, "u", "p" * 100), (1, "u", "p" * 100), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.write.parquet(f"file://{tmp_path}/pages.parquet")
    from quirework.llm.queries import op4_warc

    got = sorted(((r.page_id or 0, r.record_type, r.refers_to) for r in op4_warc(spark, f"file://{tmp_path}").collect()), key=str)
    assert got == [(0, "response", None), (0, "response", None), (1, "response", None), (2, "revisit", 1)]
