import numpy as np

from voltway.llm import host_trust as H

SCHEMA = "page_id long, url string, html string, trust string, host int, verdict string"


def links(*hosts):
    return "".join(f'<a href="https://{h}/x">y</a>' for h in hosts)


def test_rules_and_hosts(spark):
    urls = [
        "http://A.Org/x", "http://a.org", "https://example.org/es/1", "https://b.example.org/en/12?x#y", "http://z.com/fr/1", "http://z.com/de/1", "no url", None, "x://h?q://r/",
        "http://org.net/a",
    ]
    rows = H.filtered_urls(spark.createDataFrame([(i, u, None, "t", 1, "v") for i, u in enumerate(urls)], SCHEMA)).orderBy("page_id").collect()
    found = [(r["host"], r["path"], r["rule"]) for r in rows]
    assert found == [
        ("a.org", "/x", "org/"), ("a.org", "", None), ("example.org", "/es/1", "example.org/es/"), ("b.example.org", "/en/12", "example.org/en/1"), ("z.com", "/fr/1", "com/fr/"),
        ("z.com", "/de/1", "com/de/"), ("", "", None), ("", "", None), ("h", "", None), ("org.net", "/a", None),
    ]
    assert [r["verdict"] for r in rows] == ["allow", "allow", "block", "block", "allow", "block", "block", "block", "allow", "allow"]


def test_propagation_equals_power_series(spark):
    """good.org (trusted) -> a.net -> b.net; s.net and t.net lead to bad.com (blocked)."""
    pages = [(1, "http://good.org/", links("a.net", "a.net", "b.net")), (2, "http://a.net/", links("b.net")), (3, "http://s.net/", links("bad.com", "b.net")),
             (4, "http://t.net/", links("s.net")), (5, "http://bad.com/de/1", links("s.net")), (6, "http://b.net/", None), (6, "http://b.net/", None)]
    df = spark.createDataFrame([(*p, "t", 1, "v") for p in pages], SCHEMA)
    found = {r["host"]: (r["trust"], r["distrust"], r["verdict"]) for r in H.filtered_urls(df, tolerance=1e-9, rounds=80).collect()}
    hosts = ["good.org", "a.net", "b.net", "s.net", "t.net", "bad.com"]
    w = np.zeros((6, 6))
    for a, b, n in ((0, 1, 2), (0, 2, 1), (1, 2, 1), (3, 5, 1), (3, 2, 1), (4, 3, 1), (5, 3, 1)):
        w[a, b] = n

    def series(m, seed):
        p = m / np.maximum(m.sum(1, keepdims=True), 1)
        total = move = 0.15 * seed
        for _ in range(200):
            move = 0.85 * move @ p
            total = total + move
        return total

    trust, distrust = series(w, np.eye(6)[0]), series(w.T, np.eye(6)[5])
    for i, h in enumerate(hosts):
        assert np.allclose(found[h][:2], (trust[i], distrust[i]), atol=1e-6), h
    assert [found[h][2] for h in hosts] == ["allow", "allow", "allow", "block", "block", "block"]


def test_far_hosts_beside_seeds_without_links(spark):
    """h0 -> h1 -> ... -> bad.com (blocked), beside 60 trusted pages without links; x.net hears of both kinds, t.net as much of each."""
    n = 30
    chain = [f"h{i}.net" for i in range(n)] + ["bad.com"]
    pages = [(f"http://{a}/", links(b)) for a, b in zip(chain, chain[1:])] + [("http://bad.com/de/1", None)]
    alone = [(f"http://g{i}.org/", None) for i in range(60)]
    mixed = [("http://good.org/", links("m.net")), ("http://m.net/", links("x.net")), ("http://x.net/", links("worse.com")), ("http://worse.com/de/1", None),
             ("http://even.org/", links("t.net")), ("http://t.net/", links("odd.com")), ("http://odd.com/de/1", None)]
    frame = lambda rows: spark.createDataFrame([(i, u, h, "t", 1, "v") for i, (u, h) in enumerate(rows)], SCHEMA)
    few, many = ({r["host"]: (r["verdict"], r["trust"], r["distrust"]) for r in H.filtered_urls(frame(rows)).collect()} for rows in (pages + mixed, pages + mixed + alone))
    for found in (few, many):
        for i in range(n):
            verdict, trust, distrust = found[f"h{i}.net"]
            assert (verdict, trust) == ("block", 0.0) and np.isclose(distrust, 0.15 * 0.85 ** (n - i), rtol=1e-9), i
        assert found["x.net"][0] == "block" and found["m.net"][0] == found["t.net"][0] == "allow"
    assert {h: many[h] for h in few} == few


def test_rounds_do_not_grow_with_the_least_mass(spark, monkeypatch):
    """A graph of 5,000 hosts with hubs, in slices: few rounds, and the verdicts and masses of the full series."""
    monkeypatch.setattr(H, "SLICE", 200)
    rng = np.random.default_rng(4)
    n, m = 5_000, 20_000
    source, target = (n * rng.power(0.3, m)).astype(int), rng.integers(0, n, m)
    pairs = {(int(a), int(b)) for a, b in zip(source, target, strict=True) if a != b}
    pairs |= {(b, a) for a, b in list(pairs)[::3]}
    edges = spark.createDataFrame([(f"h{a}", f"h{b}", 1) for a, b in sorted(pairs)], "source string, target string, n long")
    kinds = {"trust": rng.choice(n, 40, False), "distrust": rng.choice(n, 40, False)}
    seeds = spark.createDataFrame([(k, f"h{i}", 1.0) for k, own in kinds.items() for i in own], "kind string, host string, mass double")
    shares = H.common.checkpointed(H.directed_shares(edges))
    assert shares.agg({"slice": "max"}).first()[0] > 2
    mass, rounds = H.propagated(seeds, shares, 0.85, 0.01, 1.0)
    a, b = np.array(sorted(pairs)).T
    full = {}
    for kind, own in kinds.items():
        x, y = (a, b) if kind == "trust" else (b, a)
        out = np.bincount(x, minlength=n)
        move = 0.15 * np.bincount(own, minlength=n)
        full[kind] = move.copy()
        for _ in range(400):
            move = 0.85 * np.bincount(y, move[x] / out[x], n)
            full[kind] += move
    found = {k: np.zeros(n) for k in full}
    for r in mass.collect():
        found[r["kind"]][int(r["host"][1:])] = r["mass"]
    for kind in full:
        assert ((found[kind] > 0) == (full[kind] > 0)).all() and (found[kind] >= full[kind] * 0.99 - 1e-300).all()
    assert ((found["distrust"] > found["trust"] * (1 + H.TIE)) == (full["distrust"] > full["trust"] * (1 + H.TIE))).all()
    assert rounds <= 100 and min(f[f > 0].min() for f in full.values()) < 1e-5


def test_columns_of_the_operators_own_names(spark):
    """Pages with columns named as those that the operator makes: they change nothing."""
    rows = [(1, "http://good.org/", links("a.net")), (2, "http://a.net/", links("b.net")), (3, "http://b.net/", None), (4, "http://bad.com/de/1", None), (5, "http://s.net/", links("bad.com"))]
    bare = H.filtered_urls(spark.createDataFrame(rows, "page_id long, url string, html string"))
    names = ("source", "target", "kind", "mass", "moving", "slice", "distrust", "rule")
    more = H.filtered_urls(spark.createDataFrame([(*r, *["x"] * len(names)) for r in rows], "page_id long, url string, html string, " + ", ".join(f"{n} string" for n in names)))
    assert sorted(map(tuple, more.collect())) == sorted(map(tuple, bare.collect())) and more.columns == bare.columns


def test_links_with_much_space_or_long_schemes(spark):
    html = f"<a href{' ' * 20}={' ' * 30}'{'s' * 40}://A.net:80/x'>y</a><a HREF=//b.net>z</a><a href=nothing>n</a>"
    edges = H.host_edges(spark.createDataFrame([(1, "http://c.net/", html, "t", 1, "v")], SCHEMA), "url", "html")
    assert sorted(r["target"] for r in edges.collect()) == ["a.net:80", "b.net"]


def test_empty_table(spark):
    assert H.filtered_urls(spark.createDataFrame([], SCHEMA)).count() == 0
