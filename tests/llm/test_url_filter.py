"""Parsing and rules against plain Python; the trees learn and handle odd rows."""

import math
import random
import re
from collections import Counter

from marginflow.llm.url_filter import RULES, Boosting, judge, lexical


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def plain_rule(host, path):
    fits = [(v, h + p) for v, h, p in RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda f: len(f[1]), default=(None, None))


URLS = ["http://a.b.NET/x?y=1#z", "https://example.net/en/1", "https://www.example.net/en", "x",
        None, "", "://", "http://net", "http://net/", "http://example.com/de/", "http://x.org/fr/a?b",
        "http://myexample.com/de/1", "a://b://c.net/d", "http://É.org/fr/é", "http://h?q=/net/",
        "http://example.net/en/" + "9" * 50000, "ftp://x.example.com/de/?a=1&b=2"]


def test_parsing_and_rules(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(None, "http://a.net/", "x"), (1, URLS[1], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    out = judge(pages).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.page_id is None:
            continue
        host, path = plain(URLS[r.page_id])
        verdict, rule = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict or verdict is None and r.verdict in ("block", "allow")


def test_trees_learn_from_labels(spark):
    r = random.Random(3)

    def url(bad):
        name = "".join(r.choice("abcdefgh") for _ in range(6))
        return (f"http://{name}-{name}-{r.randrange(99999)}.biz/a/{r.randrange(9999)}?x=1&y=2" if bad
                else f"http://{name}.com/{name}")

    labelled = spark.createDataFrame([(url(i % 2), i % 2) for i in range(400)] + [(None, None)],
                                     "url string, label int")
    pages = spark.createDataFrame([(i, url(i % 2)) for i in range(60)], "page_id long, url string")
    out = judge(pages, labelled=labelled).collect()
    assert all((r.verdict == "block") == (r.page_id % 2 == 1) for r in out)
    assert judge(pages).filter("verdict = 'allow' and score = 0").count() == 60  # nothing to learn
    assert judge(pages.limit(0)).count() == 0


def plain_features(url):
    """The lexical features in plain Python."""
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    behind = rest[len(host):]
    path = re.match("[^?#]*", behind)[0]
    query = behind[len(path):]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    size = max(len(url), 1)
    counts = Counter(host)
    return {
        "f_length": size, "f_host_length": len(host), "f_labels": len(host.split(".")),
        "f_depth": path.count("/"), "f_digits": len(re.sub("[^0-9]", "", url)) / size,
        "f_entropy": -sum(n / len(host) * math.log2(n / len(host)) for n in counts.values()),
        "f_parameters": query.count("="), "f_hyphens": host.count("-"),
        "f_longest": max(len(x) for x in host.split(".")), "f_query_length": len(query)}


def test_features_equal_plain(spark):
    r = random.Random(3)
    urls = [None, "", "no address", "http://", "https://a", "x://A.B-c.é.org/p/q?x=1&y=2#z=3",
            "http://a.com?x=1", "http://a.com#f", "a://b://c/d", "http://..//"]
    urls += ["".join(r.choice("ab1-.:/?#=&Zé") for _ in range(r.randrange(40))) for _ in range(150)]
    urls += ["http://" + "".join(r.choice("ab1-.") for _ in range(9)) + "/" + "".join(
        r.choice("ab1/?=&") for _ in range(r.randrange(30))) for _ in range(150)]
    out = lexical(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()
    for row in out:
        for name, value in plain_features(urls[row.page_id]).items():
            assert abs(row[name] - value) < 1e-9, (urls[row.page_id], name)


def test_trees_learn_what_no_suffix_tells(spark):
    """Labels that follow from digits and parameters, under suffixes drawn at random; repeated
    labelled addresses, also at the edge of the sample."""
    r = random.Random(7)

    def address(bad):
        name = "".join(r.choice("0123456789" if r.random() < (.5 if bad else .1) else "abcdefgh")
                       for _ in range(14))
        query = "?" + "&".join(f"k{i}=x" for i in range(r.randrange(1, 6) if bad else r.randrange(4)))
        return f"http://{name}.{r.choice(['com', 'net', 'org', 'de'])}/{r.choice('abc')}{query}"

    seen = [(address(i % 2), i % 2) for i in range(400)]
    unseen = [(i, address(i % 2)) for i in range(200)]
    labelled = spark.createDataFrame(seen + seen[:50], "url string, label int")
    pages = spark.createDataFrame(unseen, "page_id long, url string")
    out = judge(pages, rules=(), labelled=labelled).collect()
    right = sum((x.verdict == "block") == bool(x.page_id % 2) for x in out)
    assert right >= 180 and {x.rule for x in out} == {None}
    scores = {round(x.score, 6) for x in out}
    assert len(scores) > 20  # no single split decides
    copies = spark.createDataFrame([seen[0]] * 30 + [seen[1]] * 30, "url string, label int")
    few = judge(pages, rules=(), settings=Boosting(fit_rows=40), labelled=copies).collect()
    assert len(few) == 200 and all(0 <= x.score <= 1 for x in few)
