import hashlib

import pytest

from depotflow.llm import archives
from depotflow.session import shared_folder

LONG = "<p>" + "long enough to be revisited " * 10 + "</p>"
ROWS = [(5, "http://a/", LONG), (3, "http://b/ x\ny", LONG), (9, None, LONG), (None, "http://c/", LONG),
        (7, "http://d/", "short"), (8, "http://d/", "short"), (10, "http://e/", None), (11, "http://f/", ""),
        (12, "http://g/", LONG + "\r\n\r\nWARC/1.0\r\nhttp://x 1 2 text/html 3\né\U0001f600"), (3, "http://b/ x\ny", LONG)]
SCHEMA = "page_id long, url string, html string, block string, digest string, file string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA)


def expected(rows):
    found = []
    for n, _, html in rows:
        body = (html or "").encode()
        same = [m for m, _, other in rows if (other or "") == (html or "") and m is not None]
        first = min(same, default=None) if len(body) >= archives.LEAST else None
        revisit = first is not None and first != n
        found.append((n, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response",
                      first if revisit else None))
    return sorted(found, key=repr)


def test_round_trip(spark):
    rows = archives.round_trip(pages(spark, ROWS)).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == expected(ROWS)


def test_files_of_many_sizes(spark, monkeypatch):
    monkeypatch.setattr(archives, "FILE", 2000)
    rows = [(n, f"http://h/{n}", f"{n % 7} " * (n * 20)) for n in range(60)]
    found = archives.round_trip(pages(spark, rows)).collect()
    assert sorted((tuple(r)[:5] for r in found), key=repr) == expected(rows)


def test_warc_fields(spark):
    arcs, warcs = shared_folder(spark, "arc"), shared_folder(spark, "warc")
    archives.write_arc(pages(spark, ROWS), arcs)
    archives.convert(spark, arcs, warcs)
    rows = archives.read_warcs(spark, warcs).collect()
    ids = {r.record_id: r for r in rows if r.record_type == "response"}
    assert all(r.record_id.startswith("<urn:uuid:") and r.date == "2001-02-03T04:05:06Z" for r in rows)
    for r in rows:
        if r.record_type == "revisit":
            assert ids[r.refers_to_id].payload_digest == r.payload_digest


def test_both_versions_are_parsed_by_their_own_fields():
    for version, n in ((1, 5), (2, 10)):
        block = archives.arc_block(4, "<p>x</p>\n\nhttp://not.a/header 1 2 3 4\n")
        data = b"\n".join([archives.arc_version(version, "f"), archives.arc_record(version, "f", "http://a/ b", block), b""])
        record, = archives.read_arc(data)
        assert len(record) == n + 1 and record["block"] == block
        assert (record["URL"], record["Content-type"]) == ("http://a/%20b", "text/html")
        assert int(record["Archive-length"]) == len(block)


def test_every_field_is_carried_over_and_checksums_are_checked(spark, tmp_path):
    import gzip
    dns = b"20010203040506\nexample.org. 3600 IN A 192.0.2.7\n"
    for version in (1, 2):
        http = archives.arc_block("a b%", "<p>x</p>")
        name = f"v{version}"
        lookup = b"dns:example.org 192.0.2.53 20020304050607 text/dns " + (
            b"200 " + hashlib.md5(dns).hexdigest().encode() + b" - 0 v2.arc " if version == 2 else b"") + str(len(dns)).encode()
        records = [archives.arc_version(version, name), archives.arc_record(version, name, "ftp://odd/", http), lookup + b"\n" + dns, b""]
        folder = tmp_path / name
        folder.mkdir()
        (folder / "one.gz").write_bytes(gzip.compress(b"\n".join(records)))
        parsed = {r.url: r for r in archives.read_arcs(spark, str(folder)).collect()}
        assert parsed["ftp://odd/"].page_id == "a b%" and parsed["ftp://odd/"].http
        answer = parsed["dns:example.org"]
        assert (answer.address, answer.date, answer.type, answer.http) == ("192.0.2.53", "20020304050607", "text/dns", False)
        assert bytes(answer.block) == dns and answer.bytes == len(dns)
        assert (answer.result, answer.source) == ((None, None) if version == 1 else ("200", "v2.arc"))
        warcs = shared_folder(spark, "warc")
        archives.convert(spark, str(folder), warcs)
        content = gzip.decompress(archives._contents(spark, warcs).first().content)
        fields = {f["WARC-Target-URI"]: (f, b) for f, b in archives.read_warc(content) if f["WARC-Type"] != "warcinfo"}
        held, block = fields["dns:example.org"]
        assert (held["WARC-Type"], held["Content-Type"], held["WARC-IP-Address"]) == ("resource", "text/dns", "192.0.2.53")
        assert held["WARC-Date"] == "2002-03-04T05:06:07Z" and block == dns
        assert held.get("X-ARC-Result-Code") == answer.result and held.get("X-ARC-File") == answer.source
        assert {r.record_type for r in archives.read_warcs(spark, warcs).collect()} == {"resource", "response"}
    broken = tmp_path / "broken"
    broken.mkdir()
    bad = archives.arc_record(2, "v2", "http://a/", b"HTTP/1.0 200 OK\r\n\r\nx").replace(b"\r\nx", b"\r\ny")
    (broken / "one.gz").write_bytes(gzip.compress(b"\n".join([archives.arc_version(2, "v2"), bad, b""])))
    with pytest.raises(Exception, match="checksum"):
        archives.read_arcs(spark, str(broken)).collect()


def test_text_ids(spark):
    rows = spark.createDataFrame([(n, f"http://h/{n}", LONG) for n in ("b", "a c", "%41")], "page_id string, url string, html string")
    found = {r.page_id: (r.record_type, r.refers_to) for r in archives.round_trip(rows).collect()}
    assert found == {"b": ("revisit", "%41"), "a c": ("revisit", "%41"), "%41": ("response", None)}


def test_broken_files_are_refused():
    whole = b"\n".join([archives.arc_version(1, "f"), archives.arc_record(1, "f", "u", b"x" * 20), b""])
    with pytest.raises(ValueError, match="declared length"):
        list(archives.read_arc(whole[:-5]))
    with pytest.raises(ValueError, match="version block"):
        list(archives.read_arc(archives.arc_record(1, "f", "u", b"x")))
    with pytest.raises(ValueError, match="fields"):
        list(archives.read_arc(archives.arc_version(2, "f") + b"\n" + archives.arc_record(1, "f", "u", b"x")))


def test_empty_table(spark):
    assert archives.round_trip(pages(spark, [])).count() == 0
