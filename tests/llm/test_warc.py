import base64
import gzip
import hashlib
import random
from urllib.parse import unquote

import pandas as pd
import pytest

from bookflow.llm import warc

PAGES = "page_id long, url string, html string"


def plain(rows):
    best = {}
    for i, _, h in rows:
        k = h or ""
        best[k] = i if best.get(k) is None else best[k] if i is None else max(best[k], i)
    for i, _, h in rows:
        p = (h or "").encode()
        top = best[h or ""]
        yield i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if i == top else "revisit", None if i == top else top


def save(spark, rows, path):
    spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' key", "'y' sha", "1 part").write.mode("overwrite").parquet(f"{path}/pages.parquet")
    return str(path)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def keys_of(spark, urls):
    df = spark.createDataFrame([*enumerate(urls)], "i int, url string")
    return [r.k for r in df.orderBy("i").select(warc.sort_key(df.url).alias("k")).collect()]


def test_sort_key(spark):
    urls = ["http://user:pw@www.Example.com/A?b=1#top", "https://m.a.example.org:8080", "https://a.example:443?q", None, "", "not a url", "mailto:x@y"]
    assert keys_of(spark, urls) == ["com,example,www)/A?b=1", "org,example,a,m:8080)/", "example,a)?q", "", "", "not a url", "mailto:x@y"]


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    pages = pd.read_parquet(f"{sf}/pages.parquet")
    rows = [*zip(pages.page_id.tolist(), pages.url, pages.html)]
    assert rows_of(warc.op7(spark, sf)) == sorted(plain(rows), key=repr)


def fixture():
    rnd = random.Random(1)
    rows = [(i, f"http://h{rnd.randrange(3)}.example.com/p{rnd.randrange(40)}", rnd.choice(["same", "", None, "é " * 40, f"own {i}"])) for i in range(700)]
    return rows + [(5, "http://x.example/", "twice"), (5, "http://x.example/", "twice"), (None, None, "no id"), (None, "odd\r\nurl", "no id"), (9000, "http://big.example/", "<p>long</p>" * 200_000), (9001, None, None), (None, "z", "same")]


def test_odd_rows(spark, tmp_path):
    rows = fixture()
    assert rows_of(warc.op7(spark, save(spark, rows, tmp_path))) == sorted(plain(rows), key=repr)
    assert warc.op7(spark, save(spark, [], tmp_path)).count() == 0


@pytest.mark.parametrize("size", [3, 256])
def test_lookup_equals_a_filter(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(warc, "BLOCK", size)
    rows = fixture()
    df = spark.createDataFrame(rows, PAGES)
    manifest = warc.write(df, f"file://{tmp_path}/archive")
    wanted = ["http://h1.example.com/p3", "http://h2.example.com/p39#x", "http://h2.example.com/p38", "http://nowhere.example/", None, "http://x.example/", "http://a.example/", "http://big.example/", "zzz"]
    found = warc.lookup(manifest, spark.createDataFrame([(u,) for u in wanted], "url string")).collect()
    got = [(r.page_id, bytes(r.payload) if r.payload is not None else None) for r in found]
    types = {(i, d): t for i, _, d, t, _ in plain(rows)}
    want = []
    for i, u, h in rows:
        if (u or "") in {w or "" for w in wanted}:  # other spellings of a key don't count
            p = (h or "").encode()
            want.append((i, p if types[(i, base64.b32encode(hashlib.sha1(p).digest()).decode())] == "response" else None))
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(got) > 10
    assert sorted((r.page_id for r in warc.read(manifest).collect()), key=repr) == sorted((i for i, _, _ in rows), key=repr)


def test_archives_are_gzip_members_of_records(spark, tmp_path):
    manifest = warc.write(spark.createDataFrame([(1, "http://a.example/", "x"), (2, "http://b.example/", "x")], PAGES), f"file://{tmp_path}/archive")
    text = "".join(gzip.open(unquote(r.archive.removeprefix("file://"))).read().decode() for r in manifest.collect())
    assert text.count("WARC/1.1\r\n") == 2 and "WARC-Type: revisit" in text and "WARC-Refers-To: <urn:page:2>" in text and text.count("Content-Length: 1\r\n") == 2
    assert sum(r.n for r in manifest.collect()) == 2
