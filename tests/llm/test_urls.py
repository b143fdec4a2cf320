"""URL filter: hosts, paths and rules against plain Python; propagation against numpy."""

import random
import re

import numpy as np

from panelforge.llm import urls
from panelforge.llm.queries import RULES


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]


def rule_of(host, path):
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.name), default=None)


def brute(pages):
    rows, mass = [], {}
    for page, url, html in pages:
        host, path = parts(url)
        rule = rule_of(host, path)
        rows.append((page, host, path, rule))
        if host:
            m = mass.setdefault(host, [0, 0, 0])
            m[0] += 1
            m[1] += bool(rule and rule.action == "allow")
            m[2] += bool(rule and rule.action == "block")
    hosts = sorted(mass)
    at = {h: i for i, h in enumerate(hosts)}
    w = np.zeros((len(hosts), len(hosts)))
    for page, url, html in pages:
        host = parts(url)[0]
        for link in {re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in re.findall(urls.LINK, html or "")}:
            if host in at and link in at and link != host:
                w[at[host], at[link]] += 1
    for h in hosts:
        if "." in h and (up := h.split(".", 1)[1]) in at:
            w[at[h], at[up]] += 1

    def rank(w, seed):
        total = w.sum(axis=1)
        share = np.divide(w, total[:, None], out=np.zeros_like(w), where=total[:, None] > 0)
        r = seed
        for _ in range(60):
            new = (1 - urls.DAMPING) * seed + urls.DAMPING * (r @ share + np.where(total > 0, 0, r))
            change, r = np.abs(new - r).sum(), new
            if change <= urls.TOLERANCE * seed.sum():
                break
        return r

    m = np.array([mass[h] for h in hosts], float)
    trust, distrust = rank(w, m[:, 1]), rank(w.T, m[:, 2])
    bad = {h for i, h in enumerate(hosts) if distrust[i] > trust[i] and distrust[i] >= urls.THRESHOLD * m[i, 0]}
    return sorted(((p, h, q, r.name if r else None, r.action if r else "block" if h in bad else "allow") for p, h, q, r in rows), key=str)


URLS = [None, "", "no scheme", "http://", "://Host.NET", "http://NET/x", "http://a.net", "http://a.net?x=/", "http://x.EXAMPLE.net/en/1", "http://badexample.net/en/1", "http://example.net/EN/", "http://example.com/de/#f", "http://example.com/den", "https://q.org/fr/?a://b", "http://É.org/fr/a b", "a://b://c/d", "http://x.com/a?u=http://example.net/en/", "http://internet/"]


def test_hosts_paths_rules(spark):
    pages = [(i, u, None) for i, u in enumerate(URLS)]
    got = urls.judged(spark.createDataFrame(pages, "page_id long, url string, html string"), RULES).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(pages)


def test_propagation(spark):
    rnd = random.Random(2)
    hosts = [f"h{i}.{d}" for i in range(12) for d in ("com", "org", "example.com", "net")] + ["example.com", "m.h1.com"]
    pages = []
    for i in range(600):
        links = "".join(f'<a class=x href="{rnd.choice(["http:", "https:", ""])}//{rnd.choice(hosts)}/p">' for _ in range(rnd.randint(0, 3)))
        pages.append((i, f"http://{rnd.choice(hosts[: 1 + i % len(hosts)])}/{rnd.choice(['de', 'fr', 'en'])}/{i}", rnd.choice([links, links + '<a href="/self">', None])))
    pages += [pages[0], (None, "http://h1.com/en/", None), (5, None, "<a href='//h1.com'>")]
    df = spark.createDataFrame([(*p, "v") for p in pages], "page_id long, url string, html string, verdict string")
    got = sorted((tuple(r) for r in urls.judged(df, RULES).collect()), key=str)
    want = brute(pages)
    assert got == want
    assert {v for _, _, _, r, v in want if r is None} == {"allow", "block"}  # the links decide something


def test_empty_table(spark):
    assert urls.judged(spark.createDataFrame([], "page_id long, url string, html string"), RULES).count() == 0
