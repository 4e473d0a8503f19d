import hashlib
import random
from collections import defaultdict

import pytest
import zstandard

from corposcope.llm import warc

SCHEMA = "page_id long, url string, html string"
BIG = "<p>grüße 🎉</p>" * 120


def expected(rows):
    groups = defaultdict(list)
    for key, _, html in rows:
        groups[html or ""].append(key)
    out = []
    for key, _, html in rows:
        payload = (html or "").encode()
        keep = max((k for k in groups[html or ""] if k is not None), default=None)
        again = len(payload) >= 1000 and keep is not None and key != keep
        out.append((key, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", keep if again else None))
    return sorted(out, key=str)


def got(spark, rows, schema=SCHEMA):
    found = warc.archived_pages(spark.createDataFrame(rows, schema).repartition(3))
    return sorted((tuple(r)[:5] for r in found.collect()), key=str)


ODD = [
    (1, "http://a.example/x", BIG), (2, "http://a.example/y\r\nWARC-Type: fake\r\n\r\n", BIG), (3, None, BIG), (None, "", BIG), (4, "http://ü.example/ö ä", None),
    (5, "u", ""), (6, "u", "x" * 999), (7, "u", "x" * 999), (8, "u", "x" * 1000), (9, "u", "x" * 1000), (9, "u", "x" * 1000), (9, "v", "other"),
    (10, "u", "WARC/1.1\r\n\r\n" * 200), (None, None, "nobody " * 300), (None, "w", "nobody " * 300), (-3, "u", "minus " * 400), (-4, "u", "minus " * 400),
    (11, "u", "very long " * 300_000), (12, "퟿", "\x00\x01 nul"),
]


def test_odd_rows(spark):
    assert got(spark, ODD) == expected(ODD)
    assert got(spark, [(*r, "p", 1) for r in ODD], SCHEMA + ", payload string, offset int") == expected(ODD)


def test_empty(spark):
    assert got(spark, []) == []


def test_a_hot_page_is_stored_once(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, "u", BIG if i % 3 == 0 else "".join(rng.choices("abcdefgh <>", k=1500))) for i in range(300)]
    assert got(spark, rows) == expected(rows)
    warc.write_archives(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "a"))
    read = warc.read_archives(spark, str(tmp_path / "a")).collect()
    assert sorted((r.page_id, r.payload) for r in read if r.record_type == "response") == sorted((i, h.encode()) for i, _, h in rows if i % 3 or i == 297)
    assert all(r.payload is None and r.payload_bytes == len(BIG.encode()) for r in read if r.record_type == "revisit")


def test_files_are_archives(spark, tmp_path, monkeypatch):
    """The dictionary leads, one record is one frame, and any decoder of frames gets the records back."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(200)]
    rows = [(i, f"http://x.example/{i}", " ".join(rng.choices(words, k=400))) for i in range(900)]
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), str(tmp_path / "a"))
    files = [p for p in (tmp_path / "a").iterdir() if p.suffix == ".txt"]
    assert files
    records = []
    for file in files:
        data = file.read_bytes()
        assert data.endswith(warc.EMPTY_FRAME)
        at, options = 0, {}
        while at < len(data):
            if data[at : at + 4] == warc.FRAME_MAGIC:
                one = zstandard.ZstdDecompressor(**options).decompressobj()
                records.append(one.decompress(data[at:]))
                at = len(data) - len(one.unused_data)
            else:
                size = int.from_bytes(data[at + 4 : at + 8], "little")
                if at == 0:
                    assert data[:4] == warc.DICTIONARY_MAGIC
                    options["dict_data"] = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
                at += 8 + size
    assert len(records) == 900 and all(r.startswith(b"WARC/1.1\r\n") for r in records)
    read = warc.read_archives(spark, str(tmp_path / "a"), strict=True)
    assert sorted((r.page_id, r.payload.decode(), r.target_uri) for r in read.collect()) == sorted((i, h, u) for i, u, h in rows)


def one_frame(raw, **options):
    return zstandard.ZstdCompressor(write_checksum=True, **options).compress(raw)


GOOD = warc.record(7, "http://a.example/", b"hello world", None)
REVISIT = warc.record(6, "http://a.example/", b"hello world", 7)


def read_bytes(spark, tmp_path, data, **options):
    (tmp_path / "x.warc.zst").write_bytes(data)
    return [(r.page_id, r.record_type, r.error) for r in warc.read_archives(spark, str(tmp_path), **options).orderBy("offset").collect()]


def test_archives_of_others(spark, tmp_path):
    """No dictionary, one that is not compressed, frames without a stated size, skippable frames in between."""
    plain = one_frame(GOOD) + warc.skippable(b"\x5a\x2a\x4d\x18", b"note") + one_frame(REVISIT)
    assert read_bytes(spark, tmp_path, plain) == [(7, "response", None), (6, "revisit", None)]
    streamed = zstandard.ZstdCompressor(write_content_size=False).compressobj()
    assert read_bytes(spark, tmp_path, streamed.compress(GOOD) + streamed.flush()) == [(7, "response", None)]
    raw = zstandard.ZstdCompressionDict(b"WARC-Type: response hello world" * 4, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    assert read_bytes(spark, tmp_path, warc.skippable(warc.DICTIONARY_MAGIC, raw.as_bytes()) + one_frame(GOOD, dict_data=raw)) == [(7, "response", None)]
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Date: d\r\nContent-Type:\r\n\ttext\r\nContent-Length: 4\r\n\r\na: b\r\n\r\n"
    assert read_bytes(spark, tmp_path, one_frame(info)) == [(None, "warcinfo", None)]
    assert read_bytes(spark, tmp_path, b"") == []


BROKEN = [
    (GOOD.replace(b"WARC/1.1", b"WARC/7"), "version"), (GOOD.replace(b"WARC-Date", b"Date"), "no warc-date"), (GOOD + b"x", "length"), (GOOD[:-1], "length"),
    (GOOD.replace(b"hello", b"jello"), "block digest"), (GOOD.replace(b"\r\n\r\nhello", b"\r\nhello") + b"\r\n", "block digest"), (GOOD + GOOD, "length"), (b"", "version"),
    (GOOD.replace(b"WARC-Block-Digest", b"X-Other").replace(b"hello", b"jello"), "payload digest"), (GOOD.replace(b"WARC-Date:", b"WARC-Type: x\r\nWARC-Date:"), "repeated warc-type"),
    (GOOD.replace(b"WARC-Block-Digest", b"X-Other").replace(b"hello world", b"hello w").replace(b"Content-Length: 9", b"Content-Length: 8"), None),
    (REVISIT.replace(b"WARC-Refers-To", b"X-Refers"), "revisit of nothing"), (GOOD.replace(b"sha1:", b"md9:"), "unknown digest"), (GOOD.replace(b"Content-Length", b"C"), "no content-length"),
]


@pytest.mark.parametrize("raw,error", BROKEN)
def test_broken_records(raw, error):
    with pytest.raises(warc.BadRecord, match=error):
        warc.parse_record(raw)


def test_broken_frames(spark, tmp_path):
    good = one_frame(GOOD)
    assert read_bytes(spark, tmp_path, good + good[:-3]) == [(7, "response", None), (None, None, "truncated frame")]
    assert read_bytes(spark, tmp_path, good + b"junk") == [(7, "response", None), (None, None, "not a frame")]
    changed = bytearray(good)
    changed[-1] ^= 1
    rows = read_bytes(spark, tmp_path, bytes(changed) + good)
    assert rows[0][2].startswith("frame:") and rows[1] == (7, "response", None)
    assert read_bytes(spark, tmp_path, good + warc.skippable(warc.EMPTY_FRAME[:4], b"abcd")[:-2])[1][2] == "truncated skippable frame"
    with pytest.raises(Exception, match="not a frame"):
        warc.read_archives(spark, str(tmp_path), strict=True).collect() if (tmp_path / "x.warc.zst").write_bytes(b"junk") else None
