"""Content sort and archives: SQL oracles, odd cases, groups over several partitions."""

import gzip
import hashlib

import pytest
from oracle_check import compare, connect
from samples import ODD, SF, documents, prose

from veriledger.llm import content_sort, queries, warc
from veriledger.session import shared_folder

PAGES = "page_id bigint, url string, html string"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_oracle(spark, duck, name):
    same, note = compare(spark, duck, SF, name)
    assert same, note


def normal(text):
    return " ".join(__import__("re").split("[\x20\x09-\x0d]+", text or ""))


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    found = []
    for i, t in rows:
        ids = groups[normal(t)]
        keep = min((x for x in ids if x is not None), default=None)
        found.append((i, keep, len(ids), hashlib.sha256(normal(t).encode()).hexdigest()))
    return sorted(found, key=str)


def test_odd_documents(spark):
    rows = [*ODD, (20, "a  b"), (21, "a\tb"), (22, "a b "), (23, "A b")]
    found = content_sort.exact_duplicates(documents(spark, rows, ["norm", "digest", "row_id"])).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found], key=str) == expected(rows)
    assert sum(r.kept for r in found) == len({normal(t) for _, t in rows})


def test_groups_longer_than_partitions(spark):
    rows = [(i, "hot" if i % 3 else prose(i % 7, 20)) for i in range(600)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = documents(spark, rows).repartition(16)
        found = content_sort.exact_duplicates(frame).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found], key=str) == expected(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in found)


def test_no_documents(spark):
    assert content_sort.exact_duplicates(documents(spark, [])).collect() == []


def test_ends_of_partitions_take_no_python_workers_for_their_rows(spark, monkeypatch):
    """A list made a frame is read by workers of another kind, which idle beside those that compare."""
    rows = [(i, "hot" if i % 3 else prose(i % 7, 20)) for i in range(60)]
    frame, none = documents(spark, rows).localCheckpoint(), documents(spark, []).localCheckpoint()
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", None)
    found = content_sort.exact_duplicates(frame).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found], key=str) == expected(rows)
    assert content_sort.exact_duplicates(none).collect() == []


def test_archives_of_odd_pages(spark):
    long = "é" * 600
    rows = [
        (1, "u1", long), (2, "u2", long), (9, None, long), (9, "u9", long), (None, "n", long), (3, "a\r\nb", None),
        (4, "u4", ""), (5, "u5", "short"), (6, "u6", "short"), (7, "u7", "x\r\n\r\ny" * 400), (8, "u8", prose(2, 40_000)),
    ]
    pages = spark.createDataFrame(rows, PAGES)
    found = warc.round_trip(pages).collect()
    assert len(found) == len(rows)
    for r in found:
        html = next(h for p, _, h in rows if p == r.page_id) or ""
        assert r.payload_digest == hashlib.sha1(html.encode()).hexdigest()
        assert r.payload_bytes == len(html.encode())
        if r.record_type == "response":
            assert bytes(r.payload).decode() == html and r.refers_to is None
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in found if r.payload_bytes == 1200)
    assert kinds == [
        ("1", "revisit", 9), ("2", "revisit", 9), ("9", "response", None), ("9", "revisit", 9), ("None", "revisit", 9),
    ]


def test_archives_roll_repeat_and_are_plain_gzip(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", prose(i, 400)) for i in range(60)], PAGES).repartition(3)
    manifests = []
    for _ in range(2):
        folder = shared_folder(spark, "warc-test")
        manifests.append(sorted(warc.write_archives(pages, folder, roll_bytes=8_000).collect()))
    assert manifests[0] == manifests[1]
    assert len(manifests[0]) > 8 and sum(r.records for r in manifests[0]) == 60
    path = folder.removeprefix("file://")
    names = {p.name for p in __import__("pathlib").Path(path).iterdir()}
    assert not [n for n in names if n.startswith(".part") and not n.endswith(".crc")]
    text = gzip.open(f"{path}/{manifests[0][0].file}").read()
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    with open(f"{path}/{manifests[0][0].file}", "ab") as file:
        file.write(b"more")
    with pytest.raises(Exception, match="manifest|header"):
        warc.read_archives(spark, folder).collect()


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).collect() == []
