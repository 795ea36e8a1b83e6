import gzip
import hashlib
import base64
import os

import pytest
from pyspark.sql import Row, functions as F

from clickscope.llm import warc as W


def expected(rows, least):
    groups = {}
    for i, _, h in rows:
        groups.setdefault((h or "").encode(), []).append(i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        ids = [x for x in groups[b] if x is not None]
        top = max(ids) if ids and len(groups[b]) > 1 and len(b) >= least else None
        again = top is not None and i != top
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                    "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


ROWS = [(1, "http://a/", "<p>x</p>"), (2, "http://b/\r\nX: 1", "<p>x</p>"), (3, None, None), (4, "u", ""),
        (None, "u", "<p>x</p>"), (None, "v", "only null"), (None, "v", "only null"), (5, "é", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n"),
        (6, "x", "\r\n\r\n"), (7, "big", "é\U0001f600" * 200000), (8, "big2", "é\U0001f600" * 200000), (2, "http://b/", "<p>x</p>"),
        (9, "s", "short"), (10, "s", "short")]


def frame(spark, rows):
    return spark.createDataFrame([Row(page_id=i, url=u, html=h, _sha1="clash") for i, u, h in rows],
                                 "page_id long, url string, html string, _sha1 string").repartition(3)


def test_round_trip(spark, tmp_path):
    for k, least in enumerate((0, 6)):
        path = f"file://{tmp_path}/w{k}"
        W.write_warc(W.page_records(frame(spark, ROWS), min_revisit_bytes=least), path)
        got = sorted(map(tuple, W.read_pages(spark, path).collect()), key=str)
        assert got == expected(ROWS, least)
        payloads = sorted(bytes(r.payload) for r in W.read_warc(spark, path).where("record_type = 'response'").collect())
        assert payloads == sorted((h or "").encode() for (i, u, h), e in zip(ROWS, [None] * len(ROWS))
                                  for x in [next(y for y in got if y[0] == i and y[1] == len((h or "").encode()))] if x[3] == "response")


def test_empty_table(spark, tmp_path):
    W.write_warc(W.page_records(frame(spark, ROWS).limit(0)), str(tmp_path / "e"))
    assert W.read_pages(spark, str(tmp_path / "e")).collect() == []


def test_predicates_are_pushed_and_payloads_skipped(spark, tmp_path):
    path = str(tmp_path / "p")
    W.write_warc(W.page_records(frame(spark, ROWS)), path)
    all_rows = W.read_warc(spark, path).select("record_type", "target_uri", "record_id").collect()
    for cond in ("record_type = 'warcinfo'", "record_type in ('revisit', 'warcinfo')", "target_uri like 'http://%'",
                 "target_uri is null", "record_type <> 'response'", "target_uri = 'é' and content_length > 5"):
        got = W.read_warc(spark, path, payload=False).where(cond).select("record_id").collect()
        full = W.read_warc(spark, path).select("*", F.lit(1).alias("one")).collect()
        want = spark.createDataFrame([r.asDict() for r in full], W.SCHEMA + ", one int").where(cond).select("record_id").collect()
        assert sorted(got) == sorted(want)
    plan = W.read_warc(spark, path).where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan  # Spark needn't filter again
    assert len(all_rows) >= len(ROWS)


class Counting:
    def __init__(self, data):
        import io
        self.io, self.got = io.BytesIO(data), 0

    def read(self, n):
        out = self.io.read(n)
        self.got += len(out)
        return out

    def seek(self, to):
        self.io.seek(to)

    def tell(self):
        return self.io.tell()

    def size(self):
        return len(self.io.getvalue())


def test_skipping_reads_little_and_any_gzip_is_read():
    big = os.urandom(3 << 20)
    recs = [({"record_type": "response", "record_id": f"<{k}>", "content_type": "x"}, {}, big if k % 2 else b"p%d" % k) for k in range(6)]
    for gz in (True, False):
        f = Counting(b"".join(W.record_bytes(*r, gz=gz) for r in recs))
        seen = [(h["WARC-Record-ID"], body(False)) for h, _, _, body in W._records(f, gz)]
        assert [i for i, _ in seen] == [f"<{k}>" for k in range(6)] and f.got < 2 << 20
    plain = b"".join(W.record_bytes(*r, gz=False) for r in recs)
    for data in (gzip.compress(plain), gzip.compress(plain[:100]) + gzip.compress(plain[100:])):
        out = [body(k % 2 == 0) for k, (_, _, _, body) in enumerate(W._records(Counting(data), True))]
        assert [o and o.partition(b"\r\n\r\n")[2] for o in out] == [b"p0", None, b"p2", None, b"p4", None]


def test_long_headers_and_other_files(spark, tmp_path):
    url = "http://a/" + "x" * (5 << 20)
    for gz in (True, False):
        data = W.record_bytes({"record_type": "response", "target_uri": url}, {}, b"p", gz=gz)
        assert [h["WARC-Target-URI"] for h, _, _, _ in W._records(Counting(data + data), gz)] == [url, url]
    for junk in (b"GIF89a" + b"x" * 100, b"WAR", b"WARC/1.1 without an end"):
        with pytest.raises(ValueError):
            list(W._records(Counting(junk), False))


def test_paths_are_qualified(spark, tmp_path):
    assert W.qualified(spark, str(tmp_path)) == f"file:{tmp_path}" and W.open_fs(f"file:{tmp_path}")[1] == str(tmp_path)
    assert W.open_fs("file:///a/b")[1] == W.open_fs("/a/b")[1] == "/a/b"


def test_files_without_a_commit_record_are_not_read(spark, tmp_path):
    path = str(tmp_path / "c")
    W.write_warc(W.page_records(frame(spark, ROWS)), path)
    n = W.read_warc(spark, path, payload=False).count()
    (tmp_path / "c" / "part-lost.warc").write_bytes(W.record_bytes({"record_type": "response"}, {}, b"x", gz=False))
    assert W.read_warc(spark, path, payload=False).count() == n
