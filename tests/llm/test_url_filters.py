"""The path-template tree against a plain version of its rules."""

import math
import random
import re
from collections import defaultdict

import pytest

from pickwise.llm import url_filters as uf

SF = "/root/testdata/sf0.001"


def differs(g, n, all_g, all_n):
    o = all_n - n
    if not n or not o or not all_n:
        return False
    p = all_g / all_n
    return abs(g / n - (all_g - g) / o) > uf.Z * math.sqrt(p * (1 - p) * (1 / n + 1 / o))


def brute(pages, labels):
    """{(host, path): (template, purity)} for the pages (page_id, url)."""
    good = {}
    for i, y in labels:
        if i is not None:
            good[i] = min(y, good.get(i, 1))
    urls = defaultdict(list)
    for i, url in pages:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].translate(str.maketrans(uf.UPPER, uf.LOWER)), m[2]) if m else ("", "")
        urls[host, path] += [good[i]] if i in good else []
    rows = [[h, p, ["*" if re.match(uf.IDENTIFIER, s) else s for s in p.split("/") if s], int(bool(y) and min(y)), int(bool(y))]
            for (h, p), y in urls.items()]
    reach = defaultdict(int)
    for h, _, s, _, _ in rows:
        for d in range(1, len(s) + 1):
            reach[h, d] += 1
    depth = max((d for (h, d), n in reach.items() if n >= uf.MIN_CHILDREN), default=0)
    for r in rows:
        r[2] = [s if i < depth else "*" for i, s in enumerate(r[2])]
    for d in range(depth):
        nodes = defaultdict(lambda: defaultdict(lambda: [0, 0, 0]))
        for h, _, s, g, m in rows:
            if len(s) > d and s[d] != "*":
                c = nodes[h, tuple(s[:d])][s[d]]
                c[0] += 1
                c[1] += g
                c[2] += m
        for r in rows:
            children = nodes.get((r[0], tuple(r[2][:d])))
            if children and len(r[2]) > d and r[2][d] != "*":
                n, g, m = (sum(c[k] for c in children.values()) for k in range(3))
                own = children[r[2][d]]
                if n * n >= uf.MIN_CHILDREN * sum(c[0] ** 2 for c in children.values()) and not differs(own[1], own[2], g, m):
                    r[2] = [*r[2][:d], "*", *r[2][d + 1:]]
    now = {(r[0], tuple(r[2])): tuple(r[2]) for r in rows}
    tally = defaultdict(lambda: [0, 0])
    for h, _, s, g, m in rows:
        tally[h, tuple(s)][0] += g
        tally[h, tuple(s)][1] += m
    for d in reversed(range(depth)):
        wide = {k: v if len(v) <= d else (*v[:d], "*", *v[d + 1:]) for k, v in now.items()}
        per, pool = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
        for k, v in now.items():
            for t in (per[k[0], v], pool[k[0], wide[k]]):
                t[0] += tally[k][0]
                t[1] += tally[k][1]
        now = {k: v if differs(*per[k[0], v], *pool[k[0], wide[k]]) else wide[k] for k, v in now.items()}
    merged = defaultdict(lambda: [0, 0])
    for k, v in now.items():
        merged[k[0], v][0] += tally[k][0]
        merged[k[0], v][1] += tally[k][1]
    g, n = (sum(t[k] for t in merged.values()) for k in range(2))
    prior = g / n if n else 1.0
    out = {}
    for h, p, s, _, _ in rows:
        v = now[h, tuple(s)]
        a, b = merged[h, v]
        out[h, p] = (h + "/" + "/".join(v), (a + uf.SMOOTHING * prior) / (b + uf.SMOOTHING))
    return out


def check(spark, pages, labels):
    got = uf.judge(spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, host string, good int"),
                   spark.createDataFrame(labels, "page_id long, good int")).collect()
    want = brute(pages, labels)
    assert len(got) == len(pages)
    for r in got:
        template, purity = want[r.host, r.path]
        assert (r.template, round(r.purity, 9)) == (template, round(purity, 9))
        if r.rule is None:
            assert r.verdict == ("block" if purity < uf.MIN_PURITY else "allow")
    return {(r.host, r.path): (r.template, r.verdict) for r in got}


def site(rng, n=500):
    pages, labels = [], []
    for i in range(n):
        section = rng.choice(["news", "blog", "spam", "shop"])
        user = f"u{rng.randint(0, 60)}" if section == "blog" else rng.choice(["a", "b"])
        page = rng.choice([str(i), f"slug-{i}", f"{i:032x}"])
        pages.append((i, f"http://{rng.choice(['One', 'two'])}.test/{section}/{user}/{rng.choice(['p', 'ads'])}/{page}.html"))
        if rng.random() < 0.6:
            labels.append((i, int(section != "spam" and "/ads/" not in pages[-1][1] or rng.random() < 0.1)))
    return pages, labels


@pytest.mark.parametrize("seed", [1, 2])
def test_tree_equals_the_plain_rules(spark, seed):
    pages, labels = site(random.Random(seed))
    pages += [(1000, None), (1001, "no scheme"), (None, pages[3][1]), (None, "http://one.test/x"), (3, pages[3][1]), (1002, "http://")]
    verdicts = check(spark, pages, labels + [(None, 0)])
    assert {v for _, v in verdicts.values()} == {"allow", "block"}


def test_pages_seen_again_change_nothing(spark):
    pages, labels = site(random.Random(3), 300)
    once = check(spark, pages, labels)
    assert check(spark, pages + [(10_000 + i, u) for i, u in pages], labels + [(10_000 + i, y) for i, y in labels]) == once


def test_a_very_long_url_adds_no_level(spark, monkeypatch):
    pages, labels = site(random.Random(4), 120)
    levels = []
    whole = uf._generalise
    monkeypatch.setattr(uf, "_generalise", lambda nodes, d: levels.append(d) or whole(nodes, d))
    long = "http://one.test/" + "/".join(f"s{i}" for i in range(2000))
    got = check(spark, pages + [(999, long)], labels)
    assert levels == list(range(4)) and got["one.test", long[15:]][0].count("/") == 2000


def test_held_out_pages(spark):
    """Templates learnt from half of the labels reject the bad half of the others."""
    pages, labels = site(random.Random(5), 1200)
    verdicts = check(spark, pages, labels[::2])
    said = [(y, verdicts[re.match(r".*?://([^/]*)(.*)", dict(pages)[i])[1].lower(), re.match(r".*?://[^/]*(.*)", dict(pages)[i])[1]][1])
            for i, y in labels[1::2]]
    bad, good = [v for y, v in said if not y], [v for y, v in said if y]
    assert bad.count("block") / len(bad) > 0.8 and good.count("block") / len(good) < 0.15


def test_given_pages(spark):
    pages = [(r.page_id, r.url) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    check(spark, pages, [(i, i % 3 // 2) for i, _ in pages[::2]])
