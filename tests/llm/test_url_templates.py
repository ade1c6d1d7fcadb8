import random

from loomline.llm import url_templates
from loomline.llm.queries import URL_RULES

PAGES = "page_id bigint, url string, html string, host string, path string, template int"


def frame(spark, urls):
    return spark.createDataFrame([(i, u, "x", "a", "b", 1) for i, u in enumerate(urls)], PAGES)


def brute(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [h + p for h, p, _ in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=len, default=None)


ODD = [None, "", "no scheme", "http://", "https://EXAMPLE.com", "HTTP://www.Example.COM/en/x?y#z", "x://a.net/es/", "http://a.net/es",
       "http://a.net?x=/es/", "http://a.com#/en/", "a://b://c.com/d", "http://notexample.com/en/1", "http://example.com/en/1",
       "http://sub.example.com/en/1", "http://com/x", "http://É.com/Ü", "http://h.org/" + "a/" * 50, "http://a\nb.net/fr/\nx"]


def test_host_path_and_rule(spark):
    urls = ODD + ODD[:3]
    got = {r.page_id: r for r in url_templates.judged(frame(spark, urls), URL_RULES).collect()}
    assert len(got) == len(urls)
    kinds = {h + p: v for h, p, v in URL_RULES}
    for i, u in enumerate(urls):
        host, path, rule = brute(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == kinds[rule] if rule else got[i].verdict in ("allow", "block")


def test_templates_generalise_and_reject(spark):
    rng = random.Random(1)
    urls = [f"http://h.org/{k}/{rng.randrange(10**6)}" for k in ("spam", "news") for _ in range(200)]
    urls += [f"http://h.org/user/{''.join(rng.choices('abcdefgh', k=6))}/post" for _ in range(100)]
    labels = [(u, int("/spam/" in u)) for u in urls[:60] + urls[200:260]]
    marked = spark.createDataFrame(labels, "url string, rejected int")
    got = url_templates.judged(frame(spark, urls), [], marked).collect()
    template = {}
    for r in got:
        template.setdefault(r.path.split("/")[1], set()).add((r.template, r.verdict))
    assert template == {"spam": {("/spam/*", "block")}, "news": {("/news/*", "allow")}, "user": {("/user/*/post", "allow")}}


def test_similar_branches_merge(spark):
    urls = [f"http://h.org/{k}/{i}" for k in ("en", "fr", "de") for i in range(100)]
    got = url_templates.judged(frame(spark, urls), []).collect()
    assert {r.template for r in got} == {"/*/*"}


def test_empty_tables(spark):
    assert url_templates.judged(frame(spark, []), URL_RULES).collect() == []
    none = spark.createDataFrame([], "url string, rejected int")
    assert url_templates.judged(frame(spark, ["http://a.org/x"]), [], none).collect()[0].verdict == "allow"
