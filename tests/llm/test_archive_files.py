"""ARC archives are written where the pages are read, in files of bounded size; payloads go from ARC to WARC unshuffled."""

import gzip
from pathlib import Path

from shelfwise.llm import warc


def test_arc_files_need_no_shuffle_and_stay_bounded(spark, scratch, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 4000)
    rows = [(i, f"http://s/{i}", "é\r\n" * (i * 37 % 400) if i % 50 else None) for i in range(600)] + [(600, "big", "x" * 9000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(3)
    sc = spark.sparkContext
    sc.setJobGroup(scratch, "arc")
    warc.write_arc(pages, f"{scratch}/arc")
    sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    assert [len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(scratch)] == [1]

    found = []
    files = list(Path(f"{scratch}/arc").glob("*.gz"))
    for f in files:
        whole = gzip.decompress(f.read_bytes())
        own = list(warc.parse_arc(whole))
        assert len(own) == 1 or len(whole) <= 4000 + len(warc._arc_head(1, "20240101000000")) + len(own) + 1
        ids = [warc._page_id(address) for address, _, _ in own]
        assert ids == sorted(ids)
        found += [(i, body.decode()) for i, (_, _, body) in zip(ids, own, strict=True)]
    assert len(files) > 3 and sorted(found) == [(i, html or "") for i, _, html in rows]
    assert warc.read_arc(spark, f"{scratch}/arc").count() == len(rows)


def test_payloads_are_converted_where_the_archives_are_read(spark, scratch, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 3000)
    rows = [(i, f"http://s/{i}", None if i % 40 == 3 else f"page {i % 70} " * (i % 70)) for i in range(500)]
    rows += [(None, "n", "page 5 " * 5), (None, "n", "alone"), (None, "n", "alone")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5)
    low = {}
    for i, _, html in rows:
        if i is not None:
            low[html or ""] = min(i, low.get(html or "", i))
    # a payload of NULL ids only has no smallest id
    refers = [(i, len((html or "").encode()), None if low.get(html or "", i) == i else low[html or ""]) for i, _, html in rows]
    for least in (0, 40):
        want = sorted((i or -1, n, r if n >= least else None) for i, n, r in refers)
        for threshold in ("10MB", "-1"):                     # lists of revisits broadcast, or joined by a shuffle
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            try:
                got = warc.round_trip(pages, min_bytes=least).select("page_id", "payload_bytes", "refers_to", "record_type").collect()
            finally:
                spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            assert sorted(((r.page_id or -1, r.payload_bytes, r.refers_to) for r in got), key=str) == sorted(want, key=str)
            assert all((r.record_type == "revisit") == (r.refers_to is not None) for r in got)
    warc.write_arc(pages, f"{scratch}/arc")
    plan = warc.convert(spark, f"{scratch}/arc")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and plan.count("binaryFile") == 1
