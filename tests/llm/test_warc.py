import base64
import gzip
import hashlib
import io
from collections import Counter
from pathlib import Path

from orebed.llm import warc

SCHEMA = "page_id long, url string, html string, shard int, key string"


def pages(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i % 7}</p>" * (i % 5)) for i in range(300)]
    rows += [(500, None, None), (501, "http://h/a b\nc", ""), (502, "http://h/é", "größe 😀" * 5000)]
    rows += [(7, "http://h/7", rows[7][2])] * 2 + [(None, "http://n/", "<p>1</p>"), (None, None, "only here"), (None, None, "only here")]
    rows += [(-(2**40), "http://far/", "<p>1</p>"), (2**50, "http://far/", "far")]
    return rows, spark.createDataFrame([(*r, 1, "k") for r in rows], SCHEMA)


def sha(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_round_trip_and_revisits(spark, tmp_path):
    rows, table = pages(spark)
    manifest = warc.write_archives(table, str(tmp_path / "w"), shard_bytes=4096, roll_bytes=2000)
    assert manifest.count() > 10 and manifest.where("bytes > 20000").count() <= 1
    got = warc.read_archives(spark, str(tmp_path / "w")).collect()
    keeper = {}
    for i, _, html in rows:
        if i is not None:
            keeper[html or ""] = max(i, keeper.get(html or "", i))
    want, seen = Counter(), Counter()
    for i, _, html in rows:
        text = html or ""
        seen[i, text] += 1
        target = keeper.get(text)
        revisit = target is not None and (target != i or seen[i, text] > 1)
        want[i, len(text.encode()), sha(text.encode()), "revisit" if revisit else "response", target if revisit else None] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == want


def test_archives_are_standard_and_deterministic(spark, tmp_path):
    _, table = pages(spark)
    one = warc.write_archives(table, str(tmp_path / "a"), shard_bytes=4096, roll_bytes=2000)
    two = warc.write_archives(table.repartition(7, "url"), str(tmp_path / "b"), shard_bytes=4096, roll_bytes=2000)
    assert Counter(map(tuple, one.collect())) == Counter(map(tuple, two.collect()))
    listed = {r["file"]: r for r in one.collect()}
    files = {p.name: p for p in Path(tmp_path / "a").glob("*.warc.gz")}
    assert set(files) == set(listed) and not list(Path(tmp_path / "a/_temporary").iterdir())
    for name, path in files.items():
        raw = path.read_bytes()
        assert hashlib.sha1(raw).hexdigest() == listed[name]["sha1"] and len(raw) == listed[name]["bytes"]
        records = list(warc._members(io.BytesIO(raw)))
        assert b"".join(records) == gzip.decompress(raw)
        kinds = [warc.parse_record(r)[0]["warc-type"] for r in records]
        assert kinds[0] == "warcinfo" and len(kinds) == listed[name]["records"] + 1
        assert all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in records)


def test_small_payloads_may_stay_whole_and_empty_tables(spark, tmp_path):
    _, table = pages(spark)
    warc.write_archives(table, str(tmp_path / "a"), revisit_from=1000)
    got = warc.read_archives(spark, str(tmp_path / "a"))
    assert got.where("record_type = 'revisit'").count() == 0 and got.count() == table.count()
    warc.write_archives(table.limit(0), str(tmp_path / "b"))
    assert warc.read_archives(spark, str(tmp_path / "b")).count() == 0


def test_bounds_balance_bytes(spark):
    rows = spark.range(5000).selectExpr("IF(id < 100, id * 1000000007, 5000000000 + id) AS page_id", "100L AS size")
    bounds = warc.shard_bounds(rows, 20_000)
    ids = sorted(r["page_id"] for r in rows.collect())
    edges = [-(2**63), *bounds, 2**63]
    assert bounds == sorted(set(bounds))
    assert max(sum(a <= i < b for i in ids) for a, b in zip(edges, edges[1:])) <= 250
