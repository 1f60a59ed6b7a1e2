from __future__ import annotations

import gzip
import hashlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F

import corpus
from martworks.llm import zip_warc as W


class Recording(io.BytesIO):
    """Remembers the ranges that are read."""

    def __init__(self, data):
        super().__init__(data)
        self.ranges = []

    def read(self, n=-1):
        self.ranges.append((self.tell(), n))
        return super().read(n)


def records():
    for i in range(40):
        body = (f"<html>{i}</html>" * (i + 1)).encode()
        yield i, f"http://x.example/{i}", body, hashlib.sha256(body).hexdigest(), "response", None
    body = b"again" * 50
    yield 77, "a\r\nb é", body, hashlib.sha256(body).hexdigest(), "revisit", 3
    yield None, None, b"", hashlib.sha256(b"").hexdigest(), "response", None
    yield 78, "", b"\r\n\r\nx", hashlib.sha256(b"\r\n\r\nx").hexdigest(), "response", None


@pytest.mark.parametrize("wide", [False, True])
def test_records_are_read_by_range(monkeypatch, wide):
    if wide:  # all places and sizes, and the number of entries, go to the ZIP64 fields
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    assert W.write_archive(out, records()) == 43
    data = out.getvalue()
    assert (b"PK\x06\x06" in data) == wide
    file = Recording(data)
    members = W.central_directory(file, len(data))
    assert set(members) == {W.DATA, W.INDEX}
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for name, (place, length) in members.items():
            assert z.read(name) == data[place:place + length]
        whole = gzip.decompress(z.read(W.DATA))
    assert whole.count(b"WARC/1.1\r\n") == 43
    lines = list(W.index_lines(file, *members[W.INDEX], step=37))
    place = members[W.DATA][0]
    file.ranges.clear()
    for line, (page_id, url, body, digest, kind, refers_to) in zip(lines, records(), strict=True):
        got = W.parse_record(gzip.decompress(W._read(file, place + line["offset"], line["length"])))
        assert (got["page_id"], got["url"], got["payload_bytes"], got["payload_digest"], got["record_type"], got["refers_to"]) == (
            page_id, url, len(body), digest, kind, refers_to)
        assert got["payload"] == (body if kind == "response" else None)
    assert max(n for _, n in file.ranges) < len(data) / 10


def test_comments_and_damage():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("packed.txt", "x" * 1000, zipfile.ZIP_DEFLATED)
        z.writestr("é.txt", "stored")
        z.comment = b"a note at the end"
    data = out.getvalue()
    members = W.central_directory(io.BytesIO(data), len(data))
    assert list(members) == ["é.txt"] and data[members["é.txt"][0]:][:6] == b"stored"
    with pytest.raises(ValueError):
        W.central_directory(io.BytesIO(data[:50]), 50)
    body = b"<p>" * 40
    record = W.record_bytes(1, "u", body, hashlib.sha256(body).hexdigest(), "response", None)
    with pytest.raises(ValueError):
        W.parse_record(record.replace(b"<p><p>", b"<p><q>", 1))


def test_round_trip(spark):
    rng = corpus.random.Random(1)
    long, short = "<p>" + corpus.sentence(rng, 60), "<p>short"
    pages = [(i, f"http://h/{i}", "<html>" + corpus.sentence(rng, 40)) for i in range(20)]
    pages += [(30, "u", long), (25, "u", long), (41, None, long), (None, "n", long), (25, "twice", long), (50, "s", short), (51, "s", short),
              (60, "z", None), (61, "", ""), (None, None, None), (70, " odd\turl\n", corpus.sentence(rng, 200_000)), (71, "é", "é🙂" * 60), (72, "é", "é🙂" * 60)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"payload": F.lit(1), "path": F.lit("p")}).repartition(5)
    got = sorted(map(tuple, W.round_trip(df).collect()), key=repr)
    first = {}
    for i, _, h in pages:
        b = (h or "").encode()
        if i is not None:
            first[b] = min(i, first.get(b, i))
    want = []
    for i, u, h in pages:
        b = (h or "").encode()
        again = len(b) >= 100 and b in first and first[b] != i
        want.append((i, u, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    assert got == sorted(want, key=repr)
    assert W.round_trip(df.limit(0)).count() == 0
    manifest = W.write_archives(df)
    payloads = {r.page_id: r.payload for r in W.read_records(W.record_places(manifest), payloads=True).collect()}
    assert bytes(payloads[71]).decode() == "é🙂" * 60 and payloads[72] is None
