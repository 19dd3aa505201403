import datetime as dt
import hashlib

import pytest
import zstandard

from tillstar.llm import warc

SCHEMA = "page_id long, url string, html string, payload int, digest string, archive int"


def pages():
    long = "<p>" + "words and more words " * 6000 + "</p>"
    page = "<html>" + "a page of its own " * 20 + "</html>"
    rows = [
        (5, "http://b.example/5", page), (3, "http://a.example/3", page), (9, "http://a.example/9", page), (None, "http://n.example/", page),
        (1, "u1", "x" * 99), (2, "u2", "x" * 99), (11, "u11", "x" * 100), (12, "u12", "x" * 100), (7, None, None), (8, "u8", ""), (6, "a b\r\nX-Page-ID: 77", long),
        (20, "u20", "ü" * 50), (21, "u21", "ü" * 50), (30, "same", page + "3"), (30, "same", page + "3"), (30, "other", page + "3"),
        (None, "n1", page + "4"), (None, "n2", page + "4"), (40, "P*M", "P*M\x18\x00\x00\x00\x00" * 30), (41, "u41", "\r\n\r\nWARC/1.1\r\n" * 20), (42, "日本", "日本語 😀 " * 40),
    ]
    return [(*r, 1, "clash", 2) for r in rows + [(100 + k, f"http://h.example/{k}", f"<html><body>{page}{k}</body></html>") for k in range(300)]]


def expected(rows):
    firsts = {}
    for i, _, html, *_ in rows:
        if i is not None and len((html or "").encode()) >= 100:
            firsts[html] = min(firsts.get(html, i), i)
    least = {html: min((u is not None, u) for i, u, h, *_ in rows if h == html and i == first) for html, first in firsts.items()}
    out = []
    for i, url, html, *_ in rows:
        data = (html or "").encode()
        first = firsts.get(html) if len(data) >= 100 else None
        revisit = first is not None and (i, url) != (first, least[html][1])
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    rows = pages()
    warc.write(spark.createDataFrame(rows, SCHEMA).repartition(3), str(tmp_path / "w"), dt.datetime(2026, 1, 2))
    back = warc.read(spark, str(tmp_path / "w")).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back], key=str) == expected(rows)
    texts = {(r.page_id, r.payload_digest): bytes(r.payload) for r in back if r.record_type == "response"}
    assert all(texts[i, hashlib.sha256((h or "").encode()).hexdigest()] == (h or "").encode() for i, _, h, *_ in rows
               if (i, hashlib.sha256((h or "").encode()).hexdigest()) in texts)
    assert {r.target_uri for r in back if r.page_id == 6} == {"a%20b%0D%0AX-Page-ID:%2077"}
    warc.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"))
    assert warc.read(spark, str(tmp_path / "none")).count() == 0


def test_archives_are_plain_zstandard(spark, tmp_path):
    warc.write(spark.createDataFrame(pages(), SCHEMA).coalesce(1), str(tmp_path / "w"))
    files = [f for f in (tmp_path / "w").rglob("part-*") if f.stat().st_size]
    assert files
    for f in files:
        data = f.read_bytes()
        assert data[:4] == warc.DICTIONARY
        held = zstandard.ZstdDecompressor().decompress(data[8 : 8 + int.from_bytes(data[4:8], "little")])
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held))
        whole = reader.stream_reader(data, read_across_frames=True).read()
        assert whole == b"".join(warc.records(data))
        assert all(r.startswith(b"WARC/1.1\r\nWARC-Type: re") and r.endswith(b"\r\n\r\n") for r in warc.records(data))


def test_new_archive_after_a_size_and_the_dictionary_pays(monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE", 200_000)
    monkeypatch.setattr(warc, "SAMPLE", 50_000)
    import pyarrow as pa

    rows = [dict(page_id=k, url=f"u{k}", digest=hashlib.sha256(h.encode()).hexdigest(), size=len(h), payload=h.encode(), first_id=None, first_url=None)
            for k, h in ((k, f"<html><head><title>{k}</title></head>" + "".join(f"<p>{k * j % 97} of {j}</p>" for j in range(20))) for k in range(1000))]
    made = [r for b in warc._archived([pa.RecordBatch.from_pylist(rows)], "d") for r in b.to_pylist()]
    archives = {}
    for r in made:
        archives.setdefault(r["archive"], []).append((r["seq"], r["frame"]))
    assert len(archives) > 3 and all([s for s, _ in a] == list(range(len(a))) for a in archives.values())
    back = [warc.parsed(x)["page_id"] for a in archives.values() for x in warc.records(warc.EMPTY_FRAME.encode().join(f for _, f in a))]
    assert back == list(range(1000))
    alone = sum(len(zstandard.ZstdCompressor(level=3).compress(warc.record(**r, date="d"))) for r in rows)
    assert sum(len(r["frame"]) for r in made) < 0.8 * alone


@pytest.mark.parametrize("place", [-20, 60])
def test_damage_is_found(place):
    import pyarrow as pa

    html = b"<p>" + bytes(range(32, 120)) * 5
    row = dict(page_id=1, url="u", digest=hashlib.sha256(html).hexdigest(), size=len(html), payload=html, first_id=None, first_url=None)
    data = bytearray(b"".join(r["frame"] for b in warc._archived([pa.RecordBatch.from_pylist([row])], "d") for r in b.to_pylist()))
    list(map(warc.parsed, warc.records(bytes(data))))
    data[place] ^= 0xFF
    with pytest.raises(Exception):
        list(map(warc.parsed, warc.records(bytes(data))))
    with pytest.raises(ValueError):
        list(warc.records(bytes(data[:-3])))
