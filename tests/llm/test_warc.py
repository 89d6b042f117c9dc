import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import warc
from ledgerline.session import scratch_path

PAGES = "page_id long, url string, html string, digest string, first string, name string"


@pytest.fixture(scope="module")
def page_rows():
    bait = "WARC/1.1\r\nWARC-Type: response\r\nX-Page-Id: 99\r\nContent-Length: %d\r\n\r\nfake\r\n\r\n"
    big = "<p>" + "filler € " * 900 + "</p>"
    rows = [(1, "http://a/ü x\r\ny", big), (2, None, ""), (3, "http://a/3", None), (4, "http://a/4", "tiny"),
            (5, "http://a/5", "tiny"), (6, "http://a/6", bait % 4 + big), (7, "http://a/7", bait % 10**9),
            (8, "http://a/8", (bait % 50) * 40), (9, "http://a/9", "x" * 99), (10, "http://a/10", "x" * 99),
            (11, "http://a/11", "x" * 100), (12, "http://a/12", "x" * 100), (11, "http://a/11b", "x" * 100),
            (None, "http://n/1", "x" * 100), (None, "http://n/2", "y" * 200), (None, "http://n/2", "y" * 200),
            (13, "http://a/13", "é" * 50), (14, "http://a/14", "é" * 50), (15, "h", "WARC/1.1\r\n"),
            (16, "h", "WARC/1.1\r\nContent-Length: x\r\n\r\n" + big)]
    rows += [(100 + k, f"http://h/{k}", big if k % 3 == 0 else f"{big}{k}") for k in range(60)]
    return [(*r, "c1", "c2", "c3") for r in rows]


def brute(rows):
    out, first = [], {}
    for i, _, html, *_ in rows:
        if len((html or "").encode()) >= 100 and i is not None:
            first[html] = min(i, first.get(html, i))
    for i, _, html, *_ in rows:
        payload = (html or "").encode()
        head = first.get(html)
        again = head is not None and (i is None or i > head)
        out.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response",
                    head if again else None))
    return sorted(map(str, out))


@pytest.mark.parametrize("block", [700, 5000, 8 << 20])
def test_round_trip_equals_brute_force(spark, page_rows, block):
    folder = scratch_path(spark, "warc")
    pages = spark.createDataFrame(page_rows, PAGES).repartition(2)
    manifest = warc.write_archives(pages, folder)
    got = warc.read_archives(manifest, folder, with_payload=True, block_bytes=block).collect()
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to))
                  for r in got) == brute(page_rows)
    held = {r.page_id: bytes(r.payload) for r in got if r.record_type == "response"}
    assert held[6] == page_rows[5][2].encode() and held[8] == page_rows[7][2].encode()
    assert next(r.url for r in got if r.page_id == 1) == "http://a/%C3%BC%20x%0D%0Ay"


def test_a_cut_archive_is_an_error(spark, page_rows):
    folder = scratch_path(spark, "warc")
    manifest = warc.write_archives(spark.createDataFrame(page_rows[:4], PAGES).coalesce(1), folder)
    name = manifest.first()["name"]
    fs, path = warc.open_fs(folder)
    with fs.open_input_stream(f"{path}/{name}") as f:
        data = f.read()
    with fs.open_output_stream(f"{path}/{name}") as f:
        f.write(data.replace(b"\r\n\r\nWARC/1.1", b"\r\n\r\nWARD/1.1", 2))
    with pytest.raises(Exception, match="no record at offset"):
        warc.read_archives(manifest, folder, block_bytes=1 << 20).collect()


def test_shuffle_path_of_the_digest_table(spark, page_rows, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 0)
    folder = scratch_path(spark, "warc")
    manifest = warc.write_archives(spark.createDataFrame(page_rows, PAGES), folder)
    got = warc.read_archives(manifest, folder).collect()
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to))
                  for r in got) == brute(page_rows)


def test_empty_table(spark):
    folder = scratch_path(spark, "warc")
    manifest = warc.write_archives(spark.createDataFrame([], PAGES), folder)
    assert warc.read_archives(manifest, folder).count() == 0


@pytest.mark.parametrize("block", [700, 8 << 20])
def test_planted_lengths_beyond_the_file(spark, block):
    """Magic in payloads with lengths that fit no offset, or no int()."""
    bait = "<p>x</p>WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %s\r\n\r\nfake"
    lengths = ["1" + "0" * 20, "9" * 5000, str(2**63 - 1), str(2**63), "9" * 18, "0" * 5000 + "7", "\u0663\u0663"]
    rows = [(k, f"http://a/{k}", bait % n, "c1", "c2", "c3") for k, n in enumerate(lengths)]
    rows += [(50 + k, "h", f"page {k} " * 60, "c1", "c2", "c3") for k in range(8)]
    folder = scratch_path(spark, "warc")
    manifest = warc.write_archives(spark.createDataFrame(rows, PAGES).coalesce(1), folder)
    got = warc.read_archives(manifest, folder, block_bytes=block).collect()
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to))
                  for r in got) == brute(rows)


def test_a_record_that_ends_beyond_the_file_is_an_error(spark, page_rows):
    folder = scratch_path(spark, "warc")
    manifest = warc.write_archives(spark.createDataFrame(page_rows[:4], PAGES).coalesce(1), folder)
    name = manifest.first()["name"]
    fs, path = warc.open_fs(folder)
    with fs.open_input_stream(f"{path}/{name}") as f:
        data = f.read()
    with fs.open_output_stream(f"{path}/{name}") as f:
        f.write(data[:-1])
    short = spark.createDataFrame([(name, len(data) - 1, 5)], warc.MANIFEST)
    with pytest.raises(Exception, match="ends beyond the file"):
        warc.read_archives(short, folder, block_bytes=1 << 20).collect()


def test_blocks_are_read_by_as_many_tasks(spark, tmp_path):
    """200 blocks in one archive: neither the search for starts nor the
    reading of records is merged into few tasks."""
    pages = spark.range(0, 400, 1, 1).selectExpr("id AS page_id", "string(id) AS url", "repeat(md5(string(id)), 20) AS html")
    manifest = warc.write_archives(pages, str(tmp_path))
    block = manifest.first()["bytes"] // 200 + 1
    got = warc.read_archives(manifest, str(tmp_path), block_bytes=block)
    assert got.count() == 400
    used = got.select(F.spark_partition_id().alias("p")).distinct().count()
    assert used > 60 and got.rdd.getNumPartitions() == 200
