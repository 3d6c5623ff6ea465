import hashlib
import io
import os
import struct
import urllib.parse

import pytest
import zstandard

from mentionscope.llm import warc

PAGES = "page_id long, url string, html string, offset int, record_type string"


def pages(spark, rows):
    df = spark.createDataFrame([(i, u, h, 1, "own") for i, u, h in rows], PAGES)
    return df.repartition(3) if rows else df


LONG = "<p>é" + "same words here " * 80
ROWS = ([(i, f"http://a.org/{i}", f"<html><title>Page {i}</title><p>{'words and more ' * (i % 90)}{i}</p></html>") for i in range(200)]
        + [(1000 + i, "http://b.org/x", LONG) for i in range(30)]
        + [(2000 + i, None, "short") for i in range(3)] + [(3000, "http://c.org/é \r\nX: y", None), (3001, "", ""), (3002, "u", "x" * 999), (3003, "u", "x" * 999),
           (3004, "u", "y" * 1000), (3005, "u", "y" * 1000), (3005, "u", "y" * 1000), (None, "u", "y" * 1000), (None, None, "z" * 2000),
           (4000, "http://d.org", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 100), (4001, "http://d.org/2", "v" * 500_000)])


def brute(rows):
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        same = [j for j, _, g in rows if (g or "").encode() == data and j is not None]
        again = len(data) >= 1000 and bool(same) and i != max(same)
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", max(same) if again else None, True))
    return sorted(out, key=repr)


def test_equal_to_brute_force(spark):
    got = [tuple(r) for r in warc.archived(pages(spark, ROWS)).collect()]
    assert sorted(got, key=repr) == brute(ROWS)


def test_empty(spark):
    assert warc.archived(pages(spark, [])).collect() == []


@pytest.fixture()
def written(spark, scratch):
    index = warc.write(pages(spark, ROWS), scratch, archive=50_000).collect()
    return scratch, index


def test_every_record_stands_alone(written):
    """Each record can be read by its place, with nothing but the dictionary ahead of all."""
    folder, index = written
    assert len({r["archive"] for r in index}) > 3 and len(index) == len(ROWS)
    by_id = {i: h for i, _, h in ROWS if i is not None}
    for r in index:
        fields, block = warc.read_record(folder, r["archive"], r["offset"], r["length"])
        assert fields["warc-type"] == r["record_type"] and fields.get("page-id") == r["page_id"]
        if r["page_id"] is not None and r["record_type"] == "response":
            assert block.partition(b"\r\n\r\n")[2] == (by_id[int(r["page_id"])] or "").encode()


def test_format(written):
    folder, index = written
    with_dictionary = 0
    for name in {r["archive"] for r in index}:
        data = open(os.path.join(folder, name), "rb").read()
        at, dictionary = 0, None
        if struct.unpack("<I", data[:4])[0] == warc.SKIPPABLE:
            at = 8 + struct.unpack("<I", data[4:8])[0]
            dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8:at]))
            assert dictionary.dict_id()
            with_dictionary += 1
        kinds = []
        while at < len(data):                       # a frame holds one record
            frame = zstandard.ZstdDecompressor(**({"dict_data": dictionary} if dictionary else {})).decompressobj()
            whole = frame.decompress(data[at:])
            at = len(data) - len(frame.unused_data)
            found = list(warc.parse(io.BytesIO(whole)))
            assert len(found) == 1 and whole.endswith(b"\r\n\r\n")
            kinds.append(found[0][0]["warc-type"])
        assert kinds[0] == "warcinfo" and set(kinds[1:]) <= {"response", "revisit"}
        assert len(kinds) - 1 == sum(r["archive"] == name for r in index)
    assert with_dictionary


def test_dictionary_saves_space():
    made = [warc.record({"page_id": str(i), "url": f"http://a.org/{i}", "html": f"<html><head>{'menu item ' * 20}</head>{i * 7919}".encode(), "payload_bytes": 300,
                         "sha1": hashlib.sha1(str(i).encode()).hexdigest(), "record_type": "response", "refers_to": None}, "1970-01-01T00:00:00Z") for i in range(2000)]
    d = warc.dictionary(made)
    size = lambda **o: sum(len(zstandard.ZstdCompressor(level=3, **o).compress(x)) for x in made[::20])
    assert size(dict_data=d) < 0.7 * size()


def test_urls_and_damage(spark, scratch):
    warc.write(pages(spark, ROWS), scratch)
    urls = {r["page_id"]: r["url"] for r in warc.read(spark, scratch).collect()}
    assert urllib.parse.unquote(urls["3000"]) == "http://c.org/é \r\nX: y" and urls["2000"] is None
    fields, block = {"warc-type": "response", "warc-payload-digest": "sha1:" + "A" * 32}, b"HTTP/1.1 200 OK\r\nContent-Length: 1\r\n\r\nx"
    assert warc.page(fields, block)[-1] is False
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort")))
