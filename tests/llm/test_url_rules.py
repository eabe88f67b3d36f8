import itertools
import re

from tidemark.llm.url_rules import FIXED_RULES, judge_urls, mine, url_parts

URLS = [
    "http://a.com/en/1?q=1", "https://WWW.Example.com/en/x", "http://example.com/en/", "http://sub.example.com/en/y#z", "http://x.net/es/1",
    "ftp://x.net/FR/1", "http://x.net/fr/", "http://com", "http://com/", "http://notcom/", "no scheme", None, "", "://", "http://h?x=/en/", "HTTP://É.COM/en/",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fits = []
    for rule in FIXED_RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append(rule)
    return max(fits, key=len, default=None)


def test_fixed_part_agrees_with_brute_force(spark, rows):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate([*URLS, URLS[0]])], "page_id long, url string, verdict string")
    labels = spark.createDataFrame([], "page_id long, verdict string")
    got = judge_urls(pages, labels)
    want = []
    for i, url in enumerate([*URLS, URLS[0]]):
        host, path = parts(url)
        rule = rule_of(host, path)
        want.append((i, host, path, rule, FIXED_RULES.get(rule, "allow")))
    assert rows(got, "page_id", "host", "path", "rule", "verdict") == sorted(want, key=repr)


def test_mined_rules_agree_with_counting_all_combinations(spark):
    baskets = [(["a", "b", "c"], "block")] * 6 + [(["a", "b"], "allow")] * 2 + [(["a", "d"], "allow")] * 9 + [(["b", "d"], "block")] * 3
    got = mine(spark.createDataFrame(baskets, "tokens array<string>, verdict string"), 0.05, 0.8, 1.05).collect()
    n = len(baskets)
    rules = {}
    for size in (1, 2, 3):
        for combo in itertools.combinations("abcd", size):
            holding = [v for t, v in baskets if set(combo) <= set(t)]
            for verdict in ("allow", "block"):
                share = holding.count(verdict) / len(holding) if holding else 0
                lift = share / (sum(v == verdict for _, v in baskets) / n)
                if holding.count(verdict) >= 0.05 * n and share >= 0.8 and lift >= 1.05:
                    rules[combo, verdict] = share
    best = {k for k, c in rules.items() if not any((tuple(x for x in k[0] if x != y), k[1]) in rules and rules[tuple(x for x in k[0] if x != y), k[1]] >= c for y in k[0])}
    assert {(tuple(r.antecedent), r.verdict) for r in got} == best


def test_rules_decide_where_no_fixed_rule_fits(spark):
    pages = [(i, f"http://bad{i % 2}.org/shop/{i}") if i % 3 == 0 else (i, f"http://good{i % 5}.org/news/{i}") for i in range(90)]
    frame = spark.createDataFrame([*pages, (None, "http://bad0.org/shop/7")], "page_id long, url string")
    labels = spark.createDataFrame([(i, "block" if "shop" in u else "allow") for i, u in pages[:60]] + [(None, "block"), (1, None)], "page_id long, verdict string")
    got = {r.page_id: r.verdict for r in judge_urls(frame, labels).collect()}
    assert all(got[i] == ("block" if "shop" in u else "allow") for i, u in pages) and got[None] == "block"


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(pages, spark.createDataFrame([], "page_id long, verdict string")).count() == 0
    assert len(url_parts()) == 2
