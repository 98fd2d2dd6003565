from orebed.llm import urlfilter
from orebed.llm.queries import URL_RULES


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def rule(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.ORG/es/x?q=1#f", "x://example.org/en/12", "http://example.org/en/2",
    "http://notexample.org/es/1", "https://com/de/", "https://www.com/fr", "https://h.com/fr/1://y", "a\nb://h/p\nq#r", "http://ÄB.com?x/y",
    "http://org", "http://x.org/", "http://x.net#/de/",
]


def judge(spark, rows, labels=None, **kw):
    table = spark.createDataFrame([(i, u, i, "z") for i, u in rows], "page_id long, url string, label_id long, host string")
    marks = None if labels is None else spark.createDataFrame(labels, "label_id long, bad boolean")
    return urlfilter.judge(table, URL_RULES, marks, **kw).collect()


def test_hosts_paths_and_rules(spark):
    got = judge(spark, list(enumerate(URLS)) + [(None, URLS[4]), (4, URLS[4])])
    assert len(got) == len(URLS) + 2
    for row in got:
        host, path = parse(URLS[4 if row["page_id"] is None else row["page_id"]])
        best = rule(host, path)
        assert (row["host"], row["path"], row["rule"]) == (host, path, best and best.text)
        assert row["verdict"] == (best.verdict if best else "allow")


def test_templates_and_purity(spark):
    rows, labels = [], []
    for i in range(400):
        branch = ("news", "tags", "spam")[i % 3]
        rows.append((i, f"http://a.net/{branch}/{i}/slug-{i}x?s={i}"))
        labels.append((i, branch == "spam" or i % 40 == 0))
    rows += [(1000 + i, f"http://a.net/spam/{i}7/other") for i in range(5)] + [(2000, "http://b.net/spam/1/x")]
    labels += [(3, None), (None, True), (0, False)]
    got = {r["page_id"]: r for r in judge(spark, rows, labels)}
    assert {got[i]["template"] for i in range(0, 400, 3)} == {got[i]["template"] for i in range(1, 400, 3)}
    assert got[0]["template"].startswith("/*0/") and got[2]["template"].startswith("/*3/")
    assert all((got[i]["verdict"] == "block") == (i % 3 == 2) for i in range(400))
    assert got[1000]["verdict"] == "block" and got[2000]["verdict"] == "allow"


def test_variable_levels_become_wildcards(spark):
    rows = [(i, f"http://a.net/u/{'abcdefghijklmnopqrstuvwxyz'[i % 26] * (1 + i // 26)}/p") for i in range(200)]
    assert {r["template"] for r in judge(spark, rows, [(0, True), (1, False)])} == {"/*/*/*"}
    deep = [(i, "http://d.net" + "/s" * 30) for i in range(3)]
    assert {r["template"] for r in judge(spark, deep)} == {"/*" * 8 + "/**"}


def test_empty(spark):
    assert judge(spark, []) == [] and judge(spark, [], []) == []
