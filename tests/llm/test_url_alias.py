import random
import re

import duckdb
import pandas as pd
import pytest
from frames import SF, table
from pyspark.sql import functions as F

from eventlink.llm import oracles
from eventlink.llm.url_alias import RULES, Rule, absolute, judge_urls, links_of, rule_of

PAGES = "page_id long, url string, html string"


def split(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)(\?[^#]*)?", url or "")
    if not m:
        return "", "", ""
    big = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return m[1].translate(big), m[2], m[3] or ""


def slow_rule(host, path, rules=RULES):
    fit = [r for r in rules for name, _, start in [r.text.partition("/")]
           if (host == name or host.endswith("." + name)) and path.startswith("/" + start)]
    return max(fit, key=lambda r: (len(r.text), r.verdict == "allow"), default=Rule(None, None))


def slow(rows, links, rules=RULES):
    key = lambda u: (lambda h, p, q: h and h + p + q)(*split(u))
    near = {}
    for a, b in links:
        if key(a) and key(b):
            near.setdefault(key(a), set()).add(key(b))
            near.setdefault(key(b), set()).add(key(a))
    out = []
    for page, url, _ in rows:
        host, path, _ = split(url)
        rule = slow_rule(host, path, rules)
        verdict = rule.verdict
        if verdict is None:
            seen, todo = set(), [key(url)]
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    todo += near.get(x, ())
            found = {slow_rule(*split("a://" + x)[:2], rules).verdict for x in seen if x}
            verdict = "block" if "block" in found and "allow" not in found else "allow"
        out.append((page, host, path, rule.text, verdict))
    return sorted(out, key=str)


def test_rules(spark):
    urls = ["http://x.net/en/a", "http://net/", "http://example.net/en/", "http://example.net/de", "http://EXAMPLE.com/de/x?q#f",
            "http://example.com/DE/", "http://a.org/fr/b", "http://anet/x", "http://x.net", "http://org/fr", "x", "", None, "a://b://c/d",
            "http://x.com?u=http://y.net/", "://host.net/p", "http://h\n.net/a\nb"]
    rows = [(i, u, None) for i, u in enumerate(urls)]
    got = [tuple(r) for r in judge_urls(spark.createDataFrame(rows, PAGES)).collect()]
    assert sorted(got, key=str) == slow(rows, [])
    tied = (Rule("a.com/", "block"), Rule("a.com/", "allow"))
    df = spark.createDataFrame([("a.com", "/x")], "h string, p string")
    assert df.select(rule_of(F.col("h"), F.col("p"), tied)).first()[0] == "a.com/"


def test_links_resolve(spark):
    rows = [("http://a.com/x/y?q", "/z", "http://a.com/z"), ("https://a.com/x/y", "//b.com/z", "https://b.com/z"),
            ("http://a.com/x/y?q", "w", "http://a.com/x/w"), ("http://a.com", "w", "http://a.com/w"), ("http://a.com/x", "#f", None),
            ("http://a.com/x", "mailto:a@b", None), ("http://a.com/x", " HTTP://b.com/?a&amp;b ", "HTTP://b.com/?a&b"),
            ("http://a.com/x/y", "?p=1", "http://a.com/x/y?p=1"), ("http://a.com/x", "", None)]
    df = spark.createDataFrame(rows, "url string, link string, want string")
    for got, want in df.select(absolute(F.col("link"), F.col("url")), "want").collect():
        assert got == want


@pytest.mark.parametrize("seed", [1, 2])
def test_aliases_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    hosts = ["a.com", "b.com", "x.net", "example.net", "c.org", "d.info", "example.com"]
    urls = [f"{rng.choice(['http', 'https'])}://{rng.choice(hosts)}/{rng.choice(['en', 'de', 'fr'])}/{i % 23}" for i in range(90)]
    forms = ['<link rel="canonical" href="{}">', "<LINK href='{}' REL=canonical />", '<meta http-equiv="refresh" content="0; url={}">',
             '<link rel="stylesheet" href="{}">', "<p>{}</p>"]
    rows, links = [], []
    for i, u in enumerate(urls):
        form, target = rng.choice(forms), rng.choice(urls)
        rows.append((i, u, "<html>" + form.format(target) + "</html>" if i % 3 else None))
        if i % 3 and form in forms[:3]:
            links.append((u, target))
    more = [(rng.choice(urls), rng.choice(urls)) for _ in range(4)]
    rows += [(500, rows[0][1], None), (500, rows[0][1], None), (None, rows[1][1], None)]
    df = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit("x") for c in ("key", "rule", "u", "v", "aliased", "host")})
    moved = spark.createDataFrame(more + [(None, "x")], "from_url string, to_url string")
    got = [tuple(r) for r in judge_urls(df, redirects=moved).collect()]
    assert sorted(got, key=str) == slow(rows, links + more)
    assert {r[4] for r in got if r[3] is None} == {"allow", "block"}


def test_oracle(spark, tmp_path):
    rows = [(1, "http://a.com/", '<link rel="canonical" href="http://x.net/p">'), (2, "http://a.com/#f", None), (3, "http://b.com/q?z", "<p>"),
            (4, "http://b.com/q", '<meta http-equiv="refresh" content="0;url=/q?z">'), (5, "http://x.net/p", None), (6, None, None)]
    pd.DataFrame(rows, columns=["page_id", "url", "html"]).to_parquet(tmp_path / "pages.parquet")
    for path in (f"{tmp_path}/pages.parquet", f"{SF}/pages.parquet"):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW pages AS SELECT * FROM '{path}'")
        want = con.execute(oracles.URL_VERDICTS).fetchall()
        got = [tuple(r) for r in judge_urls(spark.read.parquet(path)).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert judge_urls(table(spark, "pages").limit(0)).count() == 0


def test_canonical_is_any_token(spark):
    tags = {'<link rel="alternate canonical" href="{}">': True, '<link rel="canonical"href="{}">': True,
            "<link rel='x\ncanonical y'href='{}'>": True, "<link href='{}'rel=canonical>": True, '<link rel= canonical href={} />': True,
            '<meta content="0; url={}"http-equiv="refresh">': True, '<link title="href=/no"rel=canonical href="{}">': True,
            '<link rel="canonical-x" href="{}">': False, '<link rel="noncanonical" href="{}">': False,
            '<link rel="alternate" title="canonical" href="{}">': False, '<link rel=canonicals href="{}">': False}
    rows = [(i, f"http://a.info/{i}", "<p>" + t.format(f"http://x.net/{i}") + "</p>") for i, t in enumerate(tags)]
    df = spark.createDataFrame(rows, PAGES)
    got = {r["url"]: r["link"].strip() for r in links_of(df).collect()}
    assert got == {f"http://a.info/{i}": f"http://x.net/{i}" for i, found in enumerate(tags.values()) if found}
    verdicts = {r["page_id"]: r["verdict"] for r in judge_urls(df).collect()}
    assert verdicts == {i: "block" if found else "allow" for i, found in enumerate(tags.values())}
