"""WARC audit and URL rules."""

import hashlib

from pyspark.sql import functions as F

from clipspans.llm import url_rules, warc


def test_warc_records_and_reader(spark, tmp_path):
    pages = [(1, "http://a/", "<p>é</p>"), (2, None, None), (3, "http://b/", "x" * 5000)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    full = [r.rec for r in df.select("page_id", F.concat(warc.record(F.col("url"), F.col("html")), F.lit(warc.TAIL)).alias("rec")).orderBy("page_id").collect()]
    (tmp_path / "a.warc").write_bytes("".join(full).encode())
    import gzip

    packed = tmp_path / "gz"
    packed.mkdir()
    (packed / "a.warc.gz").write_bytes(b"".join(gzip.compress(r.encode()) for r in full))  # a member for each record, as is usual
    got = warc.read_records(spark, str(tmp_path / "a.warc")).orderBy("offset").collect()
    assert [r[1:] for r in got] == [r[1:] for r in warc.read_records(spark, str(packed)).orderBy("offset").collect()]
    want = warc.layout(df).orderBy("page_id").collect()
    assert [(r.offset, r.length, r.digest) for r in got] == [(r.offset, r.length, r.digest) for r in want]
    assert got[0].digest == hashlib.sha256(full[0].encode()).hexdigest() and bytes(got[2].body).endswith(b"x" * 5000)


def leaves(spark, rows):
    return spark.createDataFrame(rows, "file bigint, offset bigint, length bigint, digest string, hash string")


def test_audit_finds_exactly_the_differences(spark):
    one = [(f, o * 30000, 30000, f"d{f}.{o}", "h") for f in (-3, 0, 1, 2, 40, 700) for o in range(12)]
    two = [(f, o, n, "other" if (f, o) == (40, 90000) else d, h) for f, o, n, d, h in one if (f, o) not in ((1, 0), (700, 330000))] + [(900, 0, 5, "new", "h")]
    got = sorted((r.file, r.offset, r.status) for r in warc.audit(leaves(spark, one), leaves(spark, two)).collect())
    assert got == [(1, 0, "missing"), (40, 90000, "corrupt"), (700, 330000, "missing"), (900, 0, "extra")]
    assert warc.audit(leaves(spark, one), leaves(spark, one)).count() == 0
    assert warc.audit(leaves(spark, one), leaves(spark, [])).count() == len(one)
    assert warc.audit(leaves(spark, []), leaves(spark, [])).count() == 0


def test_only_mismatching_branches_are_read(spark):
    one = leaves(spark, [(f, o * 70000, 70000, f"d{f}.{o}", "h") for f in range(20) for o in range(5)])
    steps = warc.plan(one)
    levels = warc.tree(one, steps)
    assert levels[-1].count() == 1 and [x.count() for x in levels][0] == 100


def plain(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fit = [(len(h), len(p), h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_url_rules(spark):
    rules = [*url_rules.RULES, ("example.com", "", "allow"), ("b.example.com", "/x", "block"), ("a.b.example.com", "/x/y", "allow"), ("a.b.example.com", "/x", "block"), ("", "/", "block"), ("example-x.com", "/", "block"), ("org", "/a", "block")]
    urls = [None, "", "nothing", "http://", "http://com/", "HTTP://Example.COM/en/1?q#f", "http://www.example.com/en/", "http://www.example.com/de/", "http://x.net/es/a", "http://net/fr", "http://example-x.com/", "http://example.comx/en/",
            "http://a.b.example.com/x/y/z", "http://a.b.example.com/x", "http://q.a.b.example.com/x/", "http://b.example.com#/x", "http://example.com?/en/", "https://org/a", "https://o.org/b", "http://.example.com/en/", "http://é.com/ü"]
    urls += [f"http://h{i % 7}.example.com/en/{i}" for i in range(60)] + ["http://www.example.com/en/"] * 300
    df = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)], "page_id bigint, url string, rule string")
    for by in (4, 40):
        spark.conf.set("spark.sql.shuffle.partitions", str(by))
        got = url_rules.judge(df, spark.createDataFrame(rules, "host string, path string, verdict string"))
        assert got.columns == ["page_id", "url", "rule", "host", "path", "_rule", "verdict"]
        assert {r.page_id: (r.host, r.path, r["_rule"], r.verdict) for r in got.collect()} == {i: plain(u, rules) for i, u in enumerate(urls)}
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    both = spark.createDataFrame([("a.com", "/", "allow"), ("a.com", "/", "block"), ("a.com", "/", "allow")], "host string, path string, verdict string")
    assert url_rules.judge(spark.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string"), both).first().verdict == "block"
    assert url_rules.judge(df.limit(0), both).count() == 0 and url_rules.judge(df, both.limit(0)).where("rule is null").count() == 0
