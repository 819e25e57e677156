import hashlib
import io
import struct

import pytest
import zstandard

from spendlake.llm import warc
from spendlake.session import scratch_dir
from tests.llm.conftest import words

PAGES = "page_id long, url string, html string, digest int, body int, first string, size int, refers_to int, file int"


@pytest.fixture(scope="module")
def pages(spark):
    page = "<html><body>" + words(1, 400) + "</body></html>"
    rows = [(i, f"http://x/{i}", page + words(i, 50)) for i in range(5, 40)]
    rows += [(100, "u", page), (50, "u 2", page), (70, None, page), (50, "u 2", page), (None, "n", page)]
    rows += [(101, "s", "short"), (102, "s", "short"), (103, "", None), (104, None, ""), (105, "e", "é" * 49 + "ab"), (106, "e", "é" * 49 + "ab"), (107, "f", "é" * 50), (108, "f", "é" * 50), (109, "big", words(9, 300_000)), (None, None, None), (110, "a\r\nb", "\r\n\r\n")]
    return spark.createDataFrame([(*r, *(None,) * 6) for r in rows], PAGES)


def plain(rows):
    first = {}
    for r in rows:
        data = (r.html or "").encode()
        if len(data) >= 100 and r.page_id is not None:
            first[data] = min(r.page_id, first.get(data, r.page_id))
    for r in rows:
        data = (r.html or "").encode()
        to = first.get(data) if len(data) >= 100 and first.get(data) != r.page_id else None
        yield r.page_id, len(data), hashlib.sha256(data).hexdigest(), "response" if to is None else "revisit", to


def test_round_trip(pages):
    key = lambda x: tuple(-1 if v is None else v for v in x)
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect()]
    assert sorted(found, key=key) == sorted(plain(pages.collect()), key=key)


def test_payloads_come_back(pages, spark):
    folder = scratch_dir(spark)
    files = warc.write_archives(pages, folder)
    back = warc.read_archives(files, folder).collect()
    archived = {r[0] for r in plain(pages.collect()) if r[3] == "response" and r[0]}
    assert {r.page_id: bytes(r.payload) for r in back if r.record_type == "response" and r.page_id} == {
        r.page_id: (r.html or "").encode() for r in pages.collect() if r.page_id in archived
    }
    name = f"{folder.removeprefix('file:')}/{files.first().file}"
    data = open(name, "rb").read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and size > 0
    shared = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    plain_reader = zstandard.ZstdDecompressor(dict_data=shared).stream_reader(io.BytesIO(data[8 + size :]), read_across_frames=True)
    assert plain_reader.read().startswith(b"WARC/1.1\r\n")


def test_dictionary_pays(pages):
    dictionary = warc.train_dictionary(pages)
    record = warc.record(5, "http://x/5", "0" * 64, None, pages.filter("page_id = 5").first().html.encode())
    with_it = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).compress(record)
    assert len(with_it) < 0.7 * len(zstandard.ZstdCompressor().compress(record))


def test_no_pages_and_one_page(pages):
    assert warc.round_trip(pages.limit(0)).count() == 0
    assert warc.round_trip(pages.filter("page_id = 5")).count() == 1


def test_damage_is_noticed(tmp_path):
    codec = zstandard.ZstdCompressor()
    whole = struct.pack("<II", warc.DICTIONARY_FRAME, 0) + codec.compress(warc.record(1, "u", hashlib.sha256(b"abc").hexdigest(), None, b"abc"))
    assert [warc.parse(x)["payload"] for x in warc.read_frames(io.BytesIO(whole))] == [b"abc"]
    with pytest.raises(ValueError):
        list(warc.read_frames(io.BytesIO(whole[:-3])))
    with pytest.raises(ValueError):
        list(warc.read_frames(io.BytesIO(b"\0" * 20)))
    with pytest.raises(ValueError):
        warc.parse(warc.record(1, "u", hashlib.sha256(b"abc").hexdigest(), None, b"abd"))
