"""Verdicts by brute force over rules and aliases."""

import random
import re
from collections import defaultdict

from orrery.llm import urls
from orrery.llm.queries import URL_RULES

RULES = "host string, path string, verdict string"


def judge(spark, pages, rules=URL_RULES, redirects=None):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    moved = spark.createDataFrame(redirects, "from_url string, to_url string") if redirects else None
    got = urls.judge(df, spark.createDataFrame(rules, RULES), redirects=moved).collect()
    assert len(got) == len(pages)
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}


def canonical(url):
    return f'<html><head><LINK href="{url}" rel=\'canonical\'></head></html>'


def test_hosts_paths_and_longest_rule(spark):
    got = judge(spark, [
        (1, "http://A.Example.NET/en/x?q#f", ""), (2, "https://example.net/fr/", ""), (3, "http://net/", ""),
        (4, "http://net", ""), (5, "http://xnet/", ""), (6, "http://m.example.com/de/1.html#a?b", ""),
        (7, "http://example.com/DE/", ""), (8, None, ""), (9, "no scheme", ""), (10, "http://a.org?x/fr/", ""),
        (11, "http://a.org/fr/x://y/z", ""), (12, "://h/p", ""), (13, "", None), (14, "http://É.Net/", ""),
    ])
    assert got == {
        1: ("a.example.net", "/en/x", "example.net/en/", "allow"), 2: ("example.net", "/fr/", "net/", "block"),
        3: ("net", "/", "net/", "block"), 4: ("net", "", None, "allow"), 5: ("xnet", "/", None, "allow"),
        6: ("m.example.com", "/de/1.html", "example.com/de/", "block"), 7: ("example.com", "/DE/", None, "allow"),
        8: ("", "", None, "allow"), 9: ("", "", None, "allow"), 10: ("a.org", "", None, "allow"),
        11: ("a.org", "/fr/x://y/z", "org/fr/", "allow"), 12: ("h", "/p", None, "allow"), 13: ("", "", None, "allow"),
        14: ("É.net", "/", "net/", "block"),
    }


def test_aliases_carry_blocks_unless_one_is_allowed(spark):
    bad = "http://bad.example.net/fr/1"
    got = judge(spark, [
        (1, "http://one.example.com/x", canonical(bad)),                      # alias of a blocked url that is no page
        (2, "https://one.example.com/x/?utm_source=feed#top", ""),           # the same page as 1
        (3, "http://two.example.com/y", '<meta http-equiv="refresh" content="0; url=http://one.example.com/x">'),
        (4, "http://three.example.com/z", ""),
        (5, "http://four.example.com/q", canonical("/w")),                   # relative: four.example.com/w
        (6, "http://four.example.com/w", canonical("http://ok.example.net/en/1")),
        (7, "http://four.example.com/v", ""),
        (8, "http://five.example.com/?a=1&amp;b=2", ""),
        (9, "http://bad.example.net/fr/2", canonical("http://ok.example.net/en/1")),  # its own rule holds
    ], redirects=[("http://three.example.com/z", "http://two.example.com/y"), ("http://four.example.com/v", bad),
                  ("http://four.example.com/v", "http://four.example.com/q"), (None, bad)])
    # 4 -> 3 -> 1 -> bad <- 7 -> 5 -> 6 -> allowed: one component with an explicit allow
    assert {i: v[3] for i, v in got.items()} == {1: "allow", 2: "allow", 3: "allow", 4: "allow", 5: "allow", 6: "allow",
                                                 7: "allow", 8: "allow", 9: "block"}
    got = judge(spark, [(1, "http://one.example.com/x", canonical(bad)), (2, "https://one.example.com/x/?utm_source=feed", ""),
                        (3, "http://two.example.com/y", canonical("http://one.example.com/x")),
                        (4, "http://one.example.com/x?page=2", "")])
    assert {i: v[3] for i, v in got.items()} == {1: "block", 2: "block", 3: "block", 4: "allow"}


def test_all_forms_of_canonical_links_and_refreshes(spark):
    bad = "http://bad.example.net/fr/1"
    refresh = '<meta http-equiv="refresh" content="%s">'
    html = ["", f'<LINK REL="CANONICAL" HREF="{bad}">', f"<link rel=Canonical href={bad}>", refresh % f"5; url={bad}",
            refresh % f"300;URL={bad}", refresh % f"0.5, url='{bad}'", refresh % "300" + refresh % f"0; url={bad}",
            f'<link rel=canonical href="/self">\n<link rel=canonical href="{bad}">', refresh % "300", refresh % "5; /x"]
    got = judge(spark, [(i, f"http://h{i}.example.com/x", h) for i, h in enumerate(html)])
    assert {i: v[3] for i, v in got.items()} == {i: "block" if 0 < i < 8 else "allow" for i in range(10)}


def test_a_hot_target(spark):
    pages = [(i, f"http://h{i}.example.com/a", canonical("http://spam.net/")) for i in range(300)]
    pages += [(1000 + i, f"http://k{i}.example.com/a", "") for i in range(300)]
    got = judge(spark, pages)
    assert {v[3] for i, v in got.items() if i < 300} == {"block"} and {v[3] for i, v in got.items() if i >= 1000} == {"allow"}


def test_ends_are_judged_by_their_path_as_written(spark):
    got = judge(spark, [(1, "http://a.example.org/", canonical("http://spam.net/")),
                        (2, "http://b.example.org/", canonical("http://example.com/de/")),
                        (3, "http://c.example.org/", canonical("http://example.com/de/x")),
                        (4, "http://d.example.org/", canonical("http://spam.net")),   # no path: no rule
                        (5, "http://spam.net", "")])
    assert {i: v[3] for i, v in got.items()} == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow"}


def test_links_in_comments_and_scripts_are_none(spark):
    link = canonical("http://spam.net/x")
    html = [f"<!-- {link} -->", f"<script>var x = '{link}';</script>", f"<STYLE>{link}</style >", f"<!-- {link}",
            f"<!-- a --><b>c</b>{link}<!-- d -->", f"<script>1</script>{link}"]
    got = judge(spark, [(i, f"http://h{i}.example.org/x", h) for i, h in enumerate(html)])
    assert [got[i][3] for i in range(6)] == ["allow"] * 4 + ["block"] * 2


def test_aliases_against_union_find(spark):
    rnd = random.Random(5)
    hosts = ["a.example.com", "b.example.net", "example.org", "spam.net", "c.org", "example.com"]
    urls_ = [f"http://{h}{p}" for h in hosts for p in ("", "/", "/de/", "/de/1", "/en/2/", "/fr/3?q=1", "/x")]
    for _ in range(3):
        pages = [(i, u, "".join(canonical(rnd.choice(urls_)) for _ in range(rnd.choice((0, 0, 0, 1, 1, 2)))))
                 for i, u in enumerate(urls_)]
        moved = [(rnd.choice(urls_), rnd.choice(urls_)) for _ in range(4)]

        def parts(u):
            rest = u.split("://")[1].split("?")[0]
            return rest.split("/")[0], rest[len(rest.split("/")[0]):]

        def name(u):
            h, p = parts(u)
            return h + (p[:-1] if len(p) > 1 and p.endswith("/") else p) + ("?" + u.split("?")[1] if "?" in u else "")

        def rule(u):
            h, p = parts(u)
            fit = [(len(a + b), v) for a, b, v in URL_RULES if (h == a or h.endswith("." + a)) and p.startswith(b)]
            return max(fit)[1] if fit else None

        up = {name(u): name(u) for u in urls_}

        def top(x):
            while up[x] != x:
                x = up[x]
            return x

        for _, u, html in pages:
            for to in re.findall('href="([^"]+)"', html):
                up[top(name(u))] = top(name(to))
        for u, to in moved:
            up[top(name(u))] = top(name(to))
        said = defaultdict(set)
        for u in urls_:
            said[top(name(u))].add(rule(u))
        want = {}
        for i, u, _ in pages:
            known = said[top(name(u))]
            want[i] = rule(u) or ("block" if "block" in known and "allow" not in known else "allow")
        assert {i: v[3] for i, v in judge(spark, pages, redirects=moved).items()} == want


def test_awkward_rows(spark, awkward, empty):
    rules = spark.createDataFrame(URL_RULES, RULES)
    pages = awkward.selectExpr("doc_id as page_id", "text as url", "lang as html", "1 as host", "2 as verdict", "3 as rule")
    assert urls.judge(pages, rules).count() == awkward.count()
    assert urls.judge(pages.where("false"), rules).count() == 0
    assert {r.verdict for r in urls.judge(pages, rules.where("false")).collect()} == {"allow"}
