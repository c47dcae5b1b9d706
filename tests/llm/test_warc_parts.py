"""op4 where its files are spread over many parts, and on an empty table."""

from tablewatch.llm import warc


def test_parts_do_not_change_the_result(spark, monkeypatch):
    same, other = "x" * 1500, "y" * 1200
    pages = [(i, f"http://h/{i}", same if i % 3 else other) for i in range(60)] + [(None, None, None), (61, None, "short"), (61, None, "short")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5)
    want = sorted([(i, 1500 if i % 3 else 1200, "response" if i in (59, 57) else "revisit", None if i in (59, 57) else (59 if i % 3 else 57))
                   for i in range(60)] + [(-1, 0, "response", None), (61, 5, "response", None), (61, 5, "response", None)],
                  key=lambda r: (r[0], r[1], r[2], str(r[3])))
    for size in (400, 1 << 30):
        monkeypatch.setattr(warc, "TASK_BYTES", size)
        assert sorted(rows_of(warc.resolve(table)), key=lambda r: (r[0], r[1], r[2], str(r[3]))) == want


def rows_of(df):
    return [(r.page_id if r.page_id is not None else -1, r.payload_bytes, r.record_type, r.refers_to) for r in df.collect()]


def test_no_pages(spark):
    assert warc.resolve(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
