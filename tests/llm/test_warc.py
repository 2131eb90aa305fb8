import gzip
import hashlib

import pyarrow.fs as pafs

from refinery.llm import warc
from refinery.sources.files import open_path
from tests.llm.helpers import rows_of, sha, words


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id long, url string, html string, id string, digest int")


BIG = " ".join(words(400, 4))
ROWS = [(5, "http://a/ b\r\nc", BIG), (3, None, BIG), (9, "u", BIG), (3, None, BIG), (4, "u", "short"), (2, "u", "short"), (7, "u", None),
        (8, "u", ""), (None, "u", BIG), (None, "u", "y" * 200), (11, "u", "\u00e9\r\n\r\nWARC/1.1\r\n" * 3000), (12, "u", "z" * 99), (13, "u", "z" * 99)]


def expected(rows):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    out = []
    for i, _, h in rows:
        again = h in first and first[h] != i
        out.append((i, len((h or "").encode()), sha(h or ""), "revisit" if again else "response", first[h] if again else None))
    return sorted(out, key=repr)


def test_round_trip(spark):
    for chunk, size in ((warc.CHUNK, warc.ARCHIVE_BYTES), (7, 500)):
        manifest = warc.write(warc.plan(pages(spark, ROWS).repartition(3)), size, chunk)
        back = warc.read(manifest, 16)
        got = rows_of(warc.summaries(back), "id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        assert got == expected(ROWS)
        parts = {}
        for r in back.where("record_type = 'response'").orderBy("record", "chunk_no").collect():
            if r["record"] not in ("3", "None"):
                parts[r["record"]] = parts.get(r["record"], b"") + bytes(r["chunk"])
                assert hashlib.sha256(parts[r["record"]]).hexdigest() == r["digest_so_far"]
        assert parts == {str(i): (h or "").encode() for i, _, h in ROWS if i not in (3, None, 5, 9)}
    assert warc.summaries(warc.read(warc.write(warc.plan(pages(spark, []))))).count() == 0


def test_archives_are_plain_gzip_members(spark):
    manifest = warc.write(warc.plan(pages(spark, ROWS[:2]).coalesce(1)))
    (f,) = [r["file"] for r in manifest.collect()]
    text = gzip.decompress(pafs.LocalFileSystem().open_input_stream(f, compression=None).read()).decode()
    assert text.count("WARC/1.1\r\n") == 2 and text.count("WARC-Type: revisit") == 1 and BIG in text


def test_a_damaged_payload_is_noticed(spark):
    import zlib
    import io
    head = warc._head({"payload_bytes": 3, "record_type": "response", "id": "1", "url": "u", "digest": sha("abc"), "refers_to": None})
    for body, fails in ((b"abc", False), (b"abd", True), (b"ab", True)):
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        raw = io.BytesIO(pack.compress(head + body + b"\r\n\r\n") + pack.flush())
        try:
            assert [r["digest_so_far"] for r in warc._records(warc._Inflated(raw), 2, True)][-1] == sha("abc") and not fails
        except ValueError:
            assert fails


def test_the_manifest_names_archives_in_full(spark):
    manifest = warc.write(warc.plan(pages(spark, ROWS).coalesce(1)), 500, 7).collect()
    assert len({r["uri"] for r in manifest}) == len(manifest) > 1
    for r in manifest:
        fs, path = open_path(r["uri"])
        assert path == r["file"] and fs.get_file_info(path).size > 0
