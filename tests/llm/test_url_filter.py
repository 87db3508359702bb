import random
import re

from ledgerlens.llm.registered import RULES
from ledgerlens.llm.url_filter import judged

SCHEMA = "page_id bigint, url string, host string, score string, label int"


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    fits = [(h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda f: len(f[0]), default=(None, None))
    return host, path, rule, verdict


def urls(n):
    rng, out = random.Random(1), []
    for i in range(n):
        host = rng.choice(["a.example.org", "EXAMPLE.org", "b.example.com", "notexample.org", "x.net", "com"])
        out.append(f"http://{host}/{rng.choice(['es', 'en', 'fr', 'de'])}/{i}{rng.choice(['', '?a=1&b=2', '#top', '.html'])}")
    odd = [None, "", "no scheme", "://", "http://", "http://org", "http://org/", "x://a.org?u=http://b.com/de/", "http://com#/de/", "ftp://ü.com/de/\n", "a" * 5000]
    return out + odd


def test_rules_and_verdicts(spark):
    given = urls(300)
    rows = [(i, u, "x", "y", 1) for i, u in enumerate(given)] + [(None, given[0], None, None, None), (3, given[3], "x", "y", 1)]
    found = judged(spark.createDataFrame(rows, SCHEMA), RULES).collect()
    assert len(found) == len(rows)
    want = {(i, *brute(u)[:3]) for i, u, *_ in rows}
    assert {(r["page_id"], r["host"], r["path"], r["rule"]) for r in found} == want
    by_id = {i: brute(u)[3] for i, u, *_ in rows}
    for r in found:
        assert r["verdict"] in ("allow", "block") and (by_id[r["page_id"]] or r["verdict"]) == r["verdict"]
        if r["rule"] is None:
            assert r["verdict"] == ("block" if r["score"] >= 0.5 else "allow")


def test_trees_learn_from_labelled_urls(spark):
    rules = [(f"h{i}.test", "/", "block" if i % 2 else "allow") for i in range(40)]
    tail = lambda bad, i: f"/{i}9876543{i}?q=1&r=2&s={i}" if bad else "/plain/page"
    rows = [(1000 * i + j, f"http://h{i}.test{tail(i % 2, j)}", "", "", 0) for i in range(40) for j in range(10)]
    rows += [(900_000 + j, f"http://other.test{tail(j % 2, j)}", "", "", 0) for j in range(40)]
    found = {r["page_id"]: r["verdict"] for r in judged(spark.createDataFrame(rows, SCHEMA), rules).collect()}
    assert sum(found[900_000 + j] == ("block" if j % 2 else "allow") for j in range(40)) >= 36


def test_one_verdict_or_no_rows(spark):
    rows = [(1, "http://a.org/", "", "", 0), (2, "http://a.net/", "", "", 0)]
    assert {r["verdict"] for r in judged(spark.createDataFrame(rows, SCHEMA), RULES).collect()} == {"allow"}
    assert judged(spark.createDataFrame([], SCHEMA), RULES).count() == 0
