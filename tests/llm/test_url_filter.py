import re

import numpy as np

from stratalake.llm.queries import QUERIES, URL_RULES
from stratalake.llm.url_filter import TemplateTree, UrlRule, alike, filter_urls


def base(url):
    """host, path, rule by the plain reading."""
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule in URL_RULES:
        own, _, prefix = rule.rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + prefix):
            best = max(best or "", rule.rule, key=len)
    return host, path, best


URLS = [
    None, "", "no scheme", "http://", "://x.net/", "http://NET/", "http://a.Net/x?y#z", "http://xnet/", "http://a.net", "https://example.net/en/1",
    "https://b.example.net/en/", "https://b.example.net/en", "http://example.com/de/1://2", "http://É.org/fr/x", "http://org/fr/", "a://b?c://d.net/", "http://x.net#/en/",
    "http://h.net\n/a\nb", "x" * 9000 + "://a.net/",
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", "t") for i, u in enumerate(URLS)], "page_id long, url string, host string, template string")
    labels = spark.createDataFrame([], "page_id long, bad boolean")
    verdicts = {r.rule: r.verdict for r in URL_RULES}
    got = {r.page_id: r for r in filter_urls(pages, labels, URL_RULES).collect()}
    for i, url in enumerate(URLS):
        host, path, rule = base(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        assert got[i].verdict == verdicts.get(rule, "allow")


def test_templates(spark):
    rows, labels = [], []
    for i in range(400):
        section = ["news", "blog", "spam"][i % 3]
        rows.append((i, f"http://site.a/{section}/{i}.html"))
        if i % 2:
            labels.append((i, section == "spam" or i % 50 == 1))
    rows += [(1000 + i, f"http://site.b/user-{chr(97 + i % 26)}{chr(97 + i // 26)}/about") for i in range(100)]
    rows += [(2000, "http://site.c/" + "/".join("abcdefghij")), (None, "http://site.a/spam/77.html"), (3, "http://site.a/spam/9.html")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([*labels, (None, True), (1, True), (1, False)], "page_id long, bad boolean")
    got = filter_urls(pages, labels, (UrlRule("allow", "site.b/"),), TemplateTree()).collect()
    assert len(got) == len(rows)
    verdicts = {(r.path.split("/")[1], r.verdict) for r in got if r.host == "site.a"}
    assert verdicts == {("news", "allow"), ("blog", "allow"), ("spam", "block")}
    assert {r.template for r in got if r.host == "site.a"} == {"/{blog|news}/#.html", "/spam/#.html"}
    assert {r.template for r in got if r.host == "site.b"} == {"/*/about"}
    assert {r.template for r in got if r.host == "site.c"} == {"/a/b/c/d/e/f/**"}


def test_empty_table_and_no_rules(spark):
    labels = spark.createDataFrame([], "page_id long, bad boolean")
    assert filter_urls(spark.createDataFrame([], "page_id long, url string"), labels, URL_RULES).collect() == []
    one = filter_urls(spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string"), labels, ()).first()
    assert (one.rule, one.verdict, one.template) == (None, "allow", "/c")


def test_labels_are_those_of_the_document_in_the_url(spark, tmp_path):
    forms = ["{}", "{}.html", "{}/", "{}?page=2&ref=x", "{}#top", "{}?utm_source=feed"]
    urls = []
    for i in range(300):
        section = "spam" if i % 3 == 0 else "news"
        urls.append((299 - i, f"http://v2.example.com/{section}/" + forms[i % 6].format(i)))
    urls += [(300, "http://v2.example.com/7"), (301, "http://v2.example.com/spam/x9"), (302, "http://v2.example.com/spam/" + "9" * 30), (303, None)]
    spark.createDataFrame(urls, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    labels = [(i, int(i % 3 > 0)) for i in range(0, 300, 2)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = QUERIES["op2_url_filter"](spark, str(tmp_path)).collect()
    assert len(got) == len(urls)
    verdicts = {(r.path.split("/")[1], r.verdict) for r in got if r.page_id < 300}
    assert verdicts == {("spam", "block"), ("news", "allow")}


def sections(counts, host="http://wide.a"):
    """Pages and labels of sections with (name, pages, labelled, bad)."""
    pages, labels = [], []
    for name, n, labelled, bad in counts:
        for i in range(n):
            if i < labelled:
                labels.append((len(pages), i < bad))
            pages.append((len(pages), f"{host}/{name}/{i}"))
    return pages, labels


def test_sparse_branches_do_not_chain_different_ones(spark):
    counts = [(1000, 0), (0, 0), (4, 3), (8, 7), (16, 16), (30, 30), (60, 60)]
    pages, labels = sections([(f"s{n}-{'abcdefg'[i]}", max(n, 5), n, bad) for i, (n, bad) in enumerate(counts)])
    some = [(f"http://other.a/x{'abcdefghij'[i % 10]}/{i}", i < 30) for i in range(300)]  # an overall share near 0.15
    labels += [(len(pages) + i, bad) for i, (_, bad) in enumerate(some)]
    pages += [(len(pages) + i, url) for i, (url, _) in enumerate(some)]
    pages, labels = spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad boolean")
    got = [r for r in filter_urls(pages, labels, ()).collect() if r.host == "wide.a"]
    verdicts = {r.path.split("/")[1]: r.verdict for r in got}
    assert verdicts["s1000-a"] == "allow" and verdicts["s30-f"] == verdicts["s60-g"] == "block"
    template = {r.path.split("/")[1]: r.template for r in got}
    assert template["s1000-a"] != template["s16-e"] and template["s8-d"] != template["s60-g"]


def test_no_group_holds_branches_that_differ():
    r = np.random.default_rng(5)
    for _ in range(300):
        labelled = r.choice([0, 1, 3, 10, 40, 200, 3000], r.integers(1, 40))
        size = labelled + 10.0
        share = (r.binomial(labelled, r.random(len(labelled))) + 1.5) / size
        order = np.lexsort((labelled, share))
        share, size = share[order], size[order]
        groups = alike(share, size, 1.96)
        error = share * (1 - share) / size
        differ = np.abs(share[:, None] - share) > 1.96 * np.sqrt(error[:, None] + error)
        assert not (differ & (groups[:, None] == groups)).any()
        for first in np.flatnonzero(np.diff(groups)) + 1:  # no group ends early
            assert differ[first, groups == groups[first] - 1].any()


def test_a_wide_node_keeps_its_branches(spark):
    word = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(3))
    pages, labels = sections([("spam", 300, 300, 300)] + [(word(i), 25, 1, 0) for i in range(1200)])
    pages, labels = spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad boolean")
    verdicts = {(r.path.split("/")[1] == "spam", r.template, r.verdict) for r in filter_urls(pages, labels, ()).collect()}
    assert verdicts == {(True, "/spam/#", "block"), (False, "/{aaa|+1199}/#", "allow")}


def test_segments_that_look_like_names(spark):
    sections = {"a": False, "b": False, "{a|b}": True, "*": True, "**": False, "\\{a|b}": True, "+1": False, "{a|+1}": True}
    rows = [(f"http://h/{name}/x", bad) for name, bad in sections.items() for _ in range(40)]
    rows += [("http://h/" + "/".join("cdefghi"), False)] * 40 + [("http://h/c/d/e/f/g/h/**", True)] * 40
    pages = spark.createDataFrame([(i, url) for i, (url, _) in enumerate(rows)], "page_id long, url string")
    labels = spark.createDataFrame([(i, bad) for i, (_, bad) in enumerate(rows)], "page_id long, bad boolean")
    for listed in (1000, 1):
        got = filter_urls(pages, labels, (), TemplateTree(listed=listed)).collect()
        for r in got[:]:
            section = r.path.split("/")[1]
            if section in sections:
                assert r.verdict == ("block" if sections[section] else "allow"), r
        names = {r.template for r in got if r.path.split("/")[1] in sections}
        assert len(names) == 2  # the good and the bad ones


def plain_tree(rows, settings):
    """Template by template, from (host, path, bad): the tree in plain Python, a node at a time."""
    import math
    from collections import defaultdict

    known = [bad for _, _, bad in rows if bad is not None]
    rate = sum(known) / len(known) if known else 0.0
    paths = []
    for host, path, bad in rows:
        parts = [re.sub(r"([\\{}|*+])", r"\\\1", x) for x in re.sub("[0-9]+", "#", path).split("/") if x]
        if len(parts) > settings.depth:
            parts = [*parts[: settings.depth], "**"]
        paths.append((host, tuple(parts), bad))
    names = {}

    def grow(members, host, at, level):
        deeper = defaultdict(list)
        for index in members:
            parts = paths[index][1]
            if len(parts) < level:
                names[index] = at
            else:
                deeper[parts[level - 1]].append(index)
        if not deeper:
            return
        total = sum(map(len, deeper.values()))
        groups = defaultdict(list)
        if len(deeper) >= settings.fan_out and len(deeper) >= total * settings.variable:
            groups["*"] = list(deeper)
        else:
            counted = []
            for segment, own in deeper.items():
                labels = [paths[i][2] for i in own if paths[i][2] is not None]
                size = len(labels) + settings.weight
                counted.append(((sum(labels) + rate * settings.weight) / size, len(labels), size, segment))
            group = []
            for share, _, size, segment in sorted(counted):
                error = share * (1 - share) / size
                if any(share - s > settings.deviations * math.sqrt(error + e) for s, e, _ in group):
                    own = sorted(x for _, _, x in group)
                    groups["{" + "|".join(own) + "}" if len(own) > 1 else own[0]] = own
                    group = []
                group.append((share, error, segment))
            own = sorted(x for _, _, x in group)
            groups["{" + "|".join(own) + "}" if len(own) > 1 else own[0]] = own
        for name, own in groups.items():
            grow([i for x in own for i in deeper[x]], host, f"{at}/{name}", level + 1)

    for host in {host for host, _, _ in paths}:
        grow([i for i, row in enumerate(paths) if row[0] == host], host, "", 1)
    purity = {}
    for key in {(paths[i][0], names[i]) for i in names}:
        labels = [paths[i][2] for i in names if (paths[i][0], names[i]) == key and paths[i][2] is not None]
        purity[key] = (sum(labels) + rate * settings.weight) / (len(labels) + settings.weight)
    return [(names[i], purity[paths[i][0], names[i]]) for i in range(len(rows))]


def check_tree(spark, rows, settings):
    pages = spark.createDataFrame([(i, f"http://{host}{path}") for i, (host, path, _) in enumerate(rows)], "page_id long, url string")
    labels = spark.createDataFrame([(i, bad) for i, (_, _, bad) in enumerate(rows) if bad is not None], "page_id long, bad boolean")
    got = {r.page_id: r for r in filter_urls(pages, labels, (), settings).collect()}
    for i, (template, purity) in enumerate(plain_tree(rows, settings)):
        assert got[i].template == template and abs(got[i].purity - purity) < 1e-12
        assert got[i].verdict == ("block" if purity >= settings.purity else "allow")


def test_tree_equals_plain_python(spark):
    import random

    r = random.Random(7)
    rows = []
    for _ in range(1500):
        host, section = r.choice("pq"), r.choice(["news", "blog", "spam", "{news|blog}", "*", "x+y", "shop"])
        depth = r.randrange(4)
        path = "/".join(["", section, *(r.choice(["en", "de", f"u{r.choice('abcdefghijklmnopqrstuvwxyz')}{r.randrange(9)}"]) for _ in range(depth))])
        bad = r.random() < {"spam": 0.9, "*": 0.6, "shop": 0.4}.get(section, 0.1)
        rows.append((host, path, bad if r.random() < 0.6 else None))
    for settings in (TemplateTree(), TemplateTree(depth=2, fan_out=4, variable=0.01)):
        check_tree(spark, rows, settings)


def test_query_equals_plain_python(spark):
    """All templates and verdicts of the registered query's table."""
    from stratalake.llm.queries import page_labels

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    labels = dict(map(tuple, page_labels(pages, spark.read.parquet("/root/testdata/sf0.01/labels.parquet")).collect()))
    urls = {r.page_id: base(r.url) for r in pages.select("page_id", "url").collect()}
    ids = sorted(urls)
    plain = plain_tree([(urls[i][0], urls[i][1], labels.get(i)) for i in ids], TemplateTree())
    got = {r.page_id: r for r in QUERIES["op2_url_filter"](spark, "/root/testdata/sf0.01").collect()}
    verdicts = {r.rule: r.verdict for r in URL_RULES}
    for i, (template, purity) in zip(ids, plain):
        assert got[i].template == template and abs(got[i].purity - purity) < 1e-12
        assert got[i].verdict == verdicts.get(urls[i][2], "block" if purity >= 0.5 else "allow")
