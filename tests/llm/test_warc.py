"""WARC: round trip, same bytes for the same pages, damage is found."""

import glob
import hashlib
import os

import pytest

from layerkit.llm import warc_writer as w
from layerkit.llm.common import scratch_uri

SCHEMA = "page_id long, url string, html string"


def pages():
    big = "<p>" + "é content " * 30 + "</p>"
    rows = [(i, f"http://h{i % 7}.com/{i}", f"<html>{i}</html>" + "x" * (i * 13 % 400)) for i in range(200)]
    rows += [(300, "http://a/1", big), (250, "http://a/2", big), (400, "http://a b/\r\nInjected: 1", big), (None, "http://n", big)]
    rows += [(500, None, None), (501, "http://e", ""), (502, "http://e2", "small"), (503, "http://e3", "small")]
    rows += [(None, "n1", "z" * 100), (None, "n2", "z" * 100), (600, "u", "y" * 100), (600, "u", "y" * 100)]
    rows += [(700, "http://long", "\U0001f600 long " * 100_000), (701, "http://crlf", "a\r\n\r\nWARC/1.1\r\n\r\n" * 20)]
    return rows


def want(rows):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        ids = [j for j, _, other in rows if (other or "") == (html or "") and j is not None]
        first = min(ids) if ids and len(data) >= 100 else None
        revisit = first is not None and i != first
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def read(spark, folder):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in w.read_archives(spark, folder).collect()), key=str)


def local(folder):
    return folder.removeprefix("file://").removeprefix("file:")


def files(folder):
    return {os.path.basename(f): open(f, "rb").read() for f in glob.glob(f"{local(folder)}/archives/*")}


def test_round_trip_and_same_bytes(spark):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    one, two = scratch_uri(spark, "warc"), scratch_uri(spark, "warc")
    manifest = w.write_archives(df, one, shards=5, roll_bytes=4000).collect()
    assert read(spark, one) == want(rows)
    w.write_archives(df.selectExpr("html AS shard", "*").drop("shard").repartition(2), two, shards=5, roll_bytes=4000)
    assert files(one) == files(two) and len(files(one)) > 10
    assert {m.file: (m.sha256, m.compressed_bytes) for m in manifest} == {
        n: (hashlib.sha256(b).hexdigest(), len(b)) for n, b in files(one).items()}
    assert sum(m.records for m in manifest) == len(rows) and not os.listdir(f"{local(one)}/temporary")
    ids = [r.page_id for m in sorted(files(one)) for h, _ in w.parse_archive(files(one)[m]) if "page-id" in h
           for r in [type("R", (), {"page_id": int(h["page-id"])})]]
    assert ids == sorted(ids)                                                    # range-sorted across files
    payloads = {r.page_id: r.payload for r in w.read_archives(spark, one).collect() if r.record_type == "response"}
    assert payloads[700] == ("\U0001f600 long " * 100_000).encode() and payloads[500] == b""


def test_records_are_well_formed(spark):
    folder = scratch_uri(spark, "warc")
    w.write_archives(spark.createDataFrame(pages(), SCHEMA), folder, shards=2)
    seen, kinds = set(), set()
    for data in files(folder).values():
        for i, (h, block) in enumerate(w.parse_archive(data)):
            assert (h["warc-type"] == "warcinfo") == (i == 0)
            assert {"warc-record-id", "warc-date", "content-length", "content-type"} <= set(h) and "injected" not in h
            kinds.add(h["warc-type"])
            if h["warc-type"] == "revisit":
                assert {"warc-refers-to", "warc-profile"} <= set(h)
            seen.add(h["warc-record-id"])
    assert kinds == {"warcinfo", "response", "revisit"}
    refs = {h["warc-refers-to"] for d in files(folder).values() for h, _ in w.parse_archive(d) if h["warc-type"] == "revisit"}
    assert refs <= seen


def test_leftovers_are_ignored_and_damage_is_found(spark):
    folder = scratch_uri(spark, "warc")
    w.write_archives(spark.createDataFrame(pages(), SCHEMA), folder, shards=2)
    name, data = next(iter(files(folder).items()))
    with open(f"{local(folder)}/archives/pages-999999-00000.warc.gz", "wb") as f:
        f.write(data)                                                           # of a run that failed: not in the manifest
    assert read(spark, folder) == want(pages())
    os.remove(f"{local(folder)}/archives/.{name}.crc") if os.path.exists(f"{local(folder)}/archives/.{name}.crc") else None
    with open(f"{local(folder)}/archives/{name}", "wb") as f:
        f.write(data[:-40] + bytes(40))
    with pytest.raises(Exception, match="manifest"):
        read(spark, folder)


def test_empty_table(spark):
    folder = scratch_uri(spark, "warc")
    assert w.write_archives(spark.createDataFrame([], SCHEMA), folder, shards=3).count() == 0
    assert read(spark, folder) == []


def test_one_id_with_a_third_of_the_rows_is_split(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 77, id) AS page_id", "concat('http://h/', id) AS url", "concat('page ', id) AS html")
    folder = scratch_uri(spark, "warc")
    manifest = w.write_archives(df, folder, shards=16).collect()
    assert sum(m.records for m in manifest) == 3000 and max(m.records for m in manifest) < 700
