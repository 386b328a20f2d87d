from urllib.parse import quote

from gitloom.llm import bloom
from gitloom.llm.url_filter import UrlRule, bad_pages, judge_urls

RULES = (
    UrlRule("com", "/", "allow"), UrlRule("bad.com", "/x/", "block"),
    UrlRule("ok.bad.com", "/x/", "allow"), UrlRule("net", "/es/", "block"),
)


def _expected(url, listed):
    def split(u):
        if u is None or "://" not in u:
            return "", ""
        rest = u.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        path = rest[cut:]
        end = min((path.find(c) for c in "?#" if c in path), default=len(path))
        return rest[:cut].lower() if rest[:cut].isascii() else rest[:cut], path[:end]

    host, path = split(url)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: len(r.text))
        return host, path, best.text, best.verdict
    keys = {h + p.rstrip("/") for h, p in map(split, listed) if h}
    return host, path, None, "block" if host and host + path.rstrip("/") in keys else "allow"


def test_equals_brute_force(spark):
    listed = [f"http://spam{i}.org/p/" for i in range(40)] + ["http://SPAM1.org/p", None, "no url", "http://spam1.org/p?x"]
    urls = [f"https://spam{i}.org/p{'/' * (i % 3)}?q={i}#f" for i in range(80)]
    urls += ["http://a.com", "http://a.com/", "http://bad.com/x/1", "http://www.BAD.com/x/", "http://ok.bad.com/x/y"]
    urls += ["http://notbad.com/x/", "http://q.net/es/a", "http://q.net/es", "net", "", None, "http://", "x://?a://b/c"]
    urls += ["http://spam3.org/p"] * 50 + ["http://x.org/" + quote("é") + "a" * 5000]
    rows = [(i, u, "clash", "c") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, Verdict string, block string")
    table = spark.createDataFrame([(u,) for u in listed], "url string")
    for blocks in (1 << 16, 1):  # one block lets nearly all through to the exact join
        found = judge_urls(pages, table, RULES, blocks=blocks).collect()
        assert len(found) == len(urls)
        for r in found:
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == _expected(r["url"], listed), r
    assert {r["verdict"] for r in judge_urls(pages, table.limit(0), ()).collect()} == {"allow"}
    assert judge_urls(pages.limit(0), table, RULES).count() == 0
    plan = judge_urls(pages, table, RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_filter_is_sized_by_its_keys(spark):
    n = 100_000
    keys = spark.range(n).selectExpr("concat('http://a.org/', id) as key")
    others = spark.range(n).selectExpr("concat('http://b.org/', id) as key")
    blocks = bloom.blocks_for(n)
    assert blocks < n and bloom.blocks_for(1 << 60) == bloom.MAX_BLOCKS and bloom.blocks_for(0) == 1
    built = bloom.build_filter(keys, "key", blocks)
    assert bloom.possible_hits(keys, "key", built, blocks).where("not __possible").isEmpty()
    assert bloom.possible_hits(others, "key", built, blocks).where("__possible").count() < 0.02 * n


def test_hot_listed_url(spark):
    rows = [(i, "http://hot.org/p" if i % 3 == 0 else f"http://x{i}.org/p") for i in range(3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    listed = spark.createDataFrame([("http://hot.org/p/",)] * 5, "url string")
    blocked = judge_urls(pages, listed, ()).where("verdict = 'block'")
    assert [r[0] for r in blocked.orderBy("page_id").select("page_id").collect()] == list(range(0, 3000, 3))


def test_bad_pages(spark):
    prose = " ".join(f"w{i}" for i in range(60))
    parts = [f"<p>{prose} {i}</p>" for i in range(6)]
    cases = {
        "http://good.org/": f"<nav>a</nav><article><h1>t</h1>{''.join(parts)}</article>",
        "http://plain.org/": f"<body><div>{prose}</div></body>",
        "http://thin.org/": f"<nav>{prose}</nav><article><p>only a few words</p></article>",
        "http://again.org/": f"<article>{parts[0] * 3}{''.join(parts[:3])}</article>",
        "http://my.SPAM-farm.org/": f"<article>{''.join(parts)}</article>",
        "http://x.org/spam": f"<article>{''.join(parts)}</article>",
        "http://none.org/": None,
        "http://empty.org/": "",
        None: f"<article>{''.join(parts)}</article>",
    }
    pages = spark.createDataFrame([(u, h, "clash") for u, h in cases.items()], "url string, html string, host string")
    found = {r[0] for r in bad_pages(pages).collect()}
    assert found == {f"http://{h}.org/" for h in ("thin", "again", "my.SPAM-farm", "none", "empty")}
    assert bad_pages(pages.limit(0)).isEmpty()
