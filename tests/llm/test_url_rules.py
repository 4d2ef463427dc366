from itertools import combinations

import pytest
from small_tables import SF  # noqa: F401

from weftline.llm import url_rules

URLS = {
    None: ("", "", None),
    "": ("", "", None),
    "no scheme/x": ("", "", None),
    "http://A.Example.NET/en/1?q#f": ("a.example.net", "/en/1", "example.net/en/"),
    "http://example.net": ("example.net", "", None),
    "http://example.net/": ("example.net", "/", "net/"),
    "https://x.example.com/de/": ("x.example.com", "/de/", "example.com/de/"),
    "https://x.example.com/de": ("x.example.com", "/de", None),
    "https://notexample.com/de/": ("notexample.com", "/de/", None),
    "ftp://org/fr/a/b": ("org", "/fr/a/b", "org/fr/"),
    "http://a.org?u=http://b.net/": ("a.org", "", None),
    "http://a.org#/fr/": ("a.org", "", None),
    "http://ÄÖ.net/é\n/x": ("ÄÖ.net", "/é\n/x", "net/"),
    "x://": ("", "", None),
    "a/b?c://d.net/e": ("d.net", "/e", "net/"),
}


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame(
        [(i, u, "x", "y") for i, u in enumerate(URLS)],
        "page_id long, url string, host string, verdict string",
    )
    got = {r.page_id: r for r in url_rules.judge(df).collect()}
    for i, (host, path, rule) in enumerate(URLS.values()):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        if rule:
            allow = rule in ("example.net/en/", "org/fr/")
            assert got[i].verdict == ("allow" if allow else "block")
        assert got[i].verdict in ("allow", "block")


def mined(baskets, support, confidence, longest):
    """Every rule by counting every set of tokens."""
    n, sets, with_verdict = len(baskets), {}, {}
    for tokens, verdict in baskets:
        for size in range(1, longest + 1):
            for s in combinations(sorted(tokens), size):
                sets[s] = sets.get(s, 0) + 1
                with_verdict[s, verdict] = with_verdict.get((s, verdict), 0) + 1
    rules = {
        k: c / sets[k[0]] for k, c in with_verdict.items()
        if c >= support * n and c / sets[k[0]] >= confidence
    }
    return {
        (s, v): c for (s, v), c in rules.items()
        if not any(
            rules.get((p, v), -1) >= c for size in range(1, len(s)) for p in combinations(s, size)
        )
    }


def test_rules_and_matches_against_all_sets(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    urls = pages.select(
        "page_id", "url",
        url_rules.host(pages["url"]).alias("host"), url_rules.path(pages["url"]).alias("path"),
    )
    name, verdict = url_rules.given_rule(urls["host"], urls["path"])
    rows = urls.select(
        "page_id", verdict.alias("verdict"),
        url_rules.tokens(urls["url"], urls["host"], urls["path"]).alias("tokens"),
    ).collect()
    baskets = [(r.tokens, r.verdict) for r in rows if r.verdict]
    want = mined(baskets, url_rules.MIN_SUPPORT, url_rules.MIN_CONFIDENCE, url_rules.MAX_TOKENS)
    labelled = spark.createDataFrame(baskets, "tokens array<string>, verdict string")
    got = {(tuple(r.antecedent), r.verdict): r.confidence for r in url_rules.mine_rules(labelled).collect()}
    assert got == pytest.approx(want)
    judged = {r.page_id: r for r in url_rules.judge(pages).collect()}
    assert len(judged) == len(rows)
    for r in rows:
        fits = [c for (s, _), c in want.items() if set(s) <= set(r.tokens)]
        found = judged[r.page_id]
        if r.verdict:
            assert found.verdict == r.verdict and found.reason is None
        elif not fits:
            assert found.verdict == "allow" and found.reason is None
        else:
            reason = tuple(sorted(found.reason.split(" ")))
            assert want[reason, found.verdict] == pytest.approx(max(fits))


def test_empty_and_repeated(spark):
    schema = "page_id long, url string"
    assert url_rules.judge(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "http://a.com/x"), (1, "http://a.com/x"), (None, None)]
    out = url_rules.judge(spark.createDataFrame(rows, schema)).collect()
    assert [r.verdict for r in out] == ["allow"] * 3
