from __future__ import annotations

import os
import random
import re
from collections import Counter
from functools import cache
from math import exp, log

import pytest

from lakeops.llm.urls import LONGEST_WORD, RULES, judge, op3_url_filters, split_name, split_names, with_parts, with_rule, word_counts

PAGES = "page_id long, url string, html string"
SF = "/root/testdata/sf0.001"


def parts_of(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule_of(host, path):
    fits = [(v, h + p) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[1]), default=(None, None))


URLS = [None, "", "no scheme", "http://", "https://Example.COM", "https://example.com/", "http://a.example.com/en/1", "http://www.example.com/en/x?y#z"]
URLS += ["https://b.www.example.com/en/", "http://xample.net/es/1", "http://x.net/fr", "http://x.net/fr/", "ftp://com/", "http://com?x=/", "http://dotcom/"]
URLS += ["http://a.com#/en/", "a://b://c/d", "http://spam-farm.example.org/en/7", "http://café.com/é", "http://x.y\nz.com/en/", "http://" + "ab" * 3000 + ".org/"]


def test_parts_and_rules(spark):
    got = with_rule(with_parts(spark.createDataFrame([(i, u, "") for i, u in enumerate(URLS)], PAGES))).collect()
    for r in got:
        host, path = parts_of(r.url)
        assert (r.host, r.path) == (host, path), r.url
        assert (r["_decided"], r.rule) == rule_of(host, path), r.url


def cheapest(name, counts, total):
    @cache
    def best(stop):
        if not stop:
            return 0.0
        out = []
        for start in range(max(0, stop - LONGEST_WORD), stop):
            word = name[start:stop]
            cost = log(total) - log(counts[word]) if word in counts else log(total) + (len(word) - 1) * log(10) + log(2)
            out.append(best(start) + cost)
        return min(out)

    return best(len(name))


def cost_of(words, counts, total):
    return sum(log(total) - log(counts[w]) if w in counts else log(total) + (len(w) - 1) * log(10) + log(2) for w in words)


def test_names_are_split_at_least_cost(spark):
    draw = random.Random(1)
    counts = {"cheap": 50, "pills": 40, "pill": 5, "s": 3, "the": 500, "there": 80, "re": 20, "farm": 9, "a": 300}
    names = sorted({"".join(draw.choice([*counts, "q", "zz"]) for _ in range(draw.randrange(1, 6))) for _ in range(60)} | {"x" * 70})
    total = float(sum(counts.values()))
    got = split_names(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert sorted(r["name"] for r in got) == names
    for r in got:
        assert "".join(r.words) == r["name"]
        assert cost_of(r.words, counts, total) == pytest.approx(cheapest(r["name"], counts, total))


def test_unknown_name():
    assert split_name("abc", {}, 10.0) == ["abc"]
    assert split_name("cheappills", {(0, 5): 1.0, (5, 10): 1.0}, 100.0) == ["cheap", "pills"]


def test_word_counts(spark):
    html = "<html><style>p{x}</style><script>var y;</script><!-- no --><p class='hidden'>One two&amp;two ONE-x</p>"
    got = {r.word: r.n for r in word_counts(spark.createDataFrame([(1, "", html), (2, "", None), (3, "", "")], PAGES), "html").collect()}
    assert got == {"one": 2, "two": 2, "x": 1}


def bayes(rows):
    """p_block by a naive Bayes over tokens; hosts here are single known words between dots."""
    def tokens(url):
        host, path = parts_of(url)
        names = [t for t in re.split("[^a-z]+", host) if t]
        return ["h:" + t for t in names] + ["p:" + re.sub("^[0-9]+$", "0", t) for t in re.split("[^a-z0-9]+", path.lower()) if t]

    counts, classes = {"allow": Counter(), "block": Counter()}, Counter()
    for u in rows:
        verdict, _ = rule_of(*parts_of(u))
        if verdict:
            counts[verdict].update(tokens(u))
            classes[verdict] += 1
    used = len(set(counts["allow"]) | set(counts["block"]))
    sums = {c: sum(n.values()) for c, n in counts.items()}
    out = []
    for u in rows:
        odds = log(classes["block"] / classes["allow"])
        for t in tokens(u):
            if counts["allow"][t] + counts["block"][t]:
                odds += log((counts["block"][t] + 1) / (sums["block"] + used)) - log((counts["allow"][t] + 1) / (sums["allow"] + used))
        out.append(1 / (1 + exp(-odds)))
    return out


def test_bayes_over_all_urls(spark):
    draw = random.Random(2)
    urls = [f"http://{draw.choice(['spam', 'good', 'news'])}.{draw.choice(['com', 'net', 'org', 'example.com'])}/{draw.choice(['en', 'es', 'fr'])}/{draw.randrange(50)}" for _ in range(120)]
    # each name is a frequent word, so that none is split
    html = " ".join(["spam good news com net org example"] * 1000)
    pages = spark.createDataFrame([(i, u, html if i == 0 else None, "x") for i, u in enumerate(urls)], PAGES + ", host string")
    got = {r.page_id: r for r in judge(pages).collect()}
    for i, p in enumerate(bayes(urls)):
        verdict, rule = rule_of(*parts_of(urls[i]))
        assert got[i].p_block == pytest.approx(p)
        assert (got[i].rule, got[i].verdict) == (rule, verdict or ("block" if p > 0.5 else "allow"))


def test_odd_rows(spark):
    pages = spark.createDataFrame([(i, u, "spam farm example") for i, u in enumerate(URLS + URLS)], PAGES)
    got = judge(pages).collect()
    assert len(got) == 2 * len(URLS)
    assert all(r.verdict in ("allow", "block") for r in got)
    assert judge(pages.limit(0)).collect() == []


def test_one_class_only(spark):
    allowed = spark.createDataFrame([(1, "http://a.com/", ""), (2, "http://b.org/", "")], PAGES)
    assert {r.verdict for r in judge(allowed).collect()} == {"allow"}
    unknown = spark.createDataFrame([(1, "http://b.org/", "")], PAGES)
    assert judge(unknown).first().verdict == "allow"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_all_pages(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = op3_url_filters(spark, SF).collect()
    assert sorted(r.page_id for r in got) == sorted(urls)
    for r in got:
        assert (r.host, r.path) == parts_of(urls[r.page_id])
        verdict, rule = rule_of(r.host, r.path)
        assert r.rule == rule and (verdict is None or r.verdict == verdict)


def test_long_words_are_counted_and_recognised(spark):
    long, longer = "rindfleischetikettierung", "donaudampfschifffahrtsgesellschaft"
    html = f"<p>{long} {long} {longer} shop rind fleisch donau dampf {longer}skapitaen</p>"
    counts = word_counts(spark.createDataFrame([(1, "", html)], PAGES), "html")
    assert {r.word: r.n for r in counts.collect()}[long] == 2
    names = spark.createDataFrame([(long,), ("shop" + longer + "shop",), (longer + long,), (long[:-1],)], "name string")
    got = {r["name"]: r.words for r in split_names(names, counts).collect()}
    assert got[long] == [long]
    assert got["shop" + longer + "shop"] == ["shop", longer, "shop"]
    assert got[longer + long] == [longer, long]
    assert long not in got[long[:-1]] and "".join(got[long[:-1]]) == long[:-1]
