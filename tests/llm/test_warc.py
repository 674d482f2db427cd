import hashlib
import random

import pytest

from shelfsense.llm import warc
from shelfsense.sources.session import fresh_path

FORGED = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def brute(rows):
    data = [(i, (h or "").encode()) for i, _, h in rows]
    out = []
    for i, b in data:
        digest = hashlib.sha1(b).hexdigest()
        largest = max((j for j, c in data if c == b and j is not None), default=None)
        again = len(b) >= 1000 and largest is not None and i != largest
        out.append((i, len(b), digest, "revisit" if again else "response", largest if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", ["128m", "4k"])
def test_round_trip_rejects_magic_in_payloads(spark, block):
    rng = random.Random(6)
    rows = [(i, f"http://h/{i}", "ü" * rng.randint(0, 700) + FORGED * rng.randint(0, 3) + "x" * rng.randint(0, 900)) for i in range(25)]
    rows += [(100 + i, None if i else "http://a\r\nb", rows[i % 3][2] + "same" * 300) for i in range(9)]
    rows += [(200, "u", None), (201, "u", ""), (202, "u", FORGED), (203, "u", "WARC/1.1\r\n"), (204, "u", FORGED * 150), (205, "u", "\r\n\r\n"), (None, "u", "no id")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        path = fresh_path(spark, "warc")
        got = warc.archived_pages(pages, path)
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
        sent, shuffled = (sorted(map(str, warc.read_archives(spark, path, n).collect())) for n in (10**6, 0))
        assert sent == shuffled
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_payloads_and_urls_come_back(spark):
    rows = [(1, "http://a/ü", "héllo"), (2, "x\r\ny", "b" * 1200), (3, None, "b" * 1200)]
    path = fresh_path(spark, "warc")
    warc.write_archives(warc.page_records(spark.createDataFrame(rows, "page_id long, url string, html string")), path)
    got = {r["page"]: r for r in warc.read_archives(spark, path).collect()}
    assert bytes(got["1"]["payload"]).decode() == "héllo" and got["1"]["url"] == "http://a/ü"
    assert got["2"]["type"] == "revisit" and got["2"]["refers"] == "3" and got["2"]["url"] == "x%0D%0Ay"
    assert got["3"]["url"] is None and len(got["3"]["payload"]) == 1200


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archived_pages(pages, fresh_path(spark, "warc")).collect() == []
