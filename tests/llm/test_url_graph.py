"""URL verdicts: rules by a plain version, propagation by hand and by SQL on linked pages, odd rows."""

import duckdb
import numpy as np
import pytest

from snapmart.llm import queries, url_graph
from tests.oracle import difference

RULES = queries.URL_RULES


def page(host, *links, path="/en/5", scheme="http"):
    return f"{scheme}://{host}{path}", "".join(f'<a href="{x}">x</a>' for x in links)


def linked():
    rows = [
        page("good.org", "http://friend.net/x", "/own", "//cdn.friend.net/y"),
        page("bad.com", "http://other.net/", path="/de/1"),
        page("spam.net", "https://bad.com/de/1", "HTTP://BAD.com/2"),
        page("far.net", "http://spam.net/"),
        page("friend.net", "http://bad.com/", "http://third.net/"),
        page("third.net"),
        page("lone.net"),
    ]
    rows += [page("hub.net", "http://bad.com/", path=f"/{i}") for i in range(50)]
    odd = [(None, None), ("no scheme", "<a href='http://bad.com'>"), ("x://", ""), ("a://B.Org?q", None), ("://?", "")]
    return [(i, u, h, "n") for i, (u, h) in enumerate([*rows, *odd, rows[0], rows[0]])]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(linked(), "page_id long, url string, html string, host string")


def test_linked_hosts_get_verdicts(spark, pages):
    got = {r.page_id: r for r in url_graph.judge(pages, RULES).collect()}
    assert len(got) == len(linked())
    verdict = {r.host: r.verdict for r in got.values()}
    assert verdict["spam.net"] == verdict["far.net"] == verdict["hub.net"] == "block"
    assert verdict["good.org"] == verdict["friend.net"] == verdict["third.net"] == verdict["lone.net"] == "allow"
    assert got[1].rule == "com/de/" and got[1].verdict == "block" and got[0].rule == "org/"
    odd = [got[len(linked()) - 7 + k] for k in range(5)]
    assert [(r.host, r.path, r.rule) for r in odd] == [("", "", None)] * 3 + [("b.org", "", None), ("", "", None)]


def test_propagation_agrees_with_sql(spark, pages):
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    assert difference(url_graph.judge(pages, RULES), con, queries.ORACLES["op2_url_graph"]) is None


def test_distrust_reaches_the_far_end_of_a_long_chain(spark):
    """23 hosts, each with a link to the one before, the first with one to a blocked page; and a host without a path."""
    rows = [page("bad.com", path="/de/1"), page("h0.net", "http://bad.com/de/1"), page("off.net", "http://other.net/")]
    rows += [page(f"h{k}.net", f"http://h{k - 1}.net/") for k in range(1, 23)]
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    verdict = {r.host: r.verdict for r in url_graph.judge(df, RULES).collect()}
    assert {verdict[f"h{k}.net"] for k in range(23)} == {"block"}
    assert verdict["off.net"] == "allow"


def test_scores_are_those_of_the_whole_walk(spark):
    """Cycles, a hub and dead ends, against the solved linear equations."""
    rng = np.random.default_rng(5)
    n, damping = 40, url_graph.DAMPING
    counts = np.zeros((n, n))
    counts[np.arange(n - 1), np.arange(1, n)] = 1
    counts[rng.integers(0, n - 5, 30), rng.integers(0, n, 30)] = 3
    counts[[10, 39], [2, 0]] = 2
    np.fill_diagonal(counts, 0)
    seeds = np.zeros((n, 2))
    seeds[0], seeds[7], seeds[30] = (5, 0), (1, 2), (0, 4)
    along = counts / np.maximum(counts.sum(1, keepdims=True), 1)
    against = counts / np.maximum(counts.sum(0, keepdims=True), 1)
    want = np.stack(
        [np.linalg.solve(np.eye(n) - damping * m, (1 - damping) * seeds[:, k]) for k, m in enumerate((along.T, against))], 1
    )
    known = [(f"h{i}", float(t), float(d)) for i, (t, d) in enumerate(seeds) if t or d]
    links = [(f"h{i}", f"h{j}", float(counts[i, j])) for i, j in zip(*np.nonzero(counts), strict=True)]
    scores = url_graph.propagate(
        spark.createDataFrame(known, "host string, trust double, distrust double"),
        spark.createDataFrame(links, "src string, dst string, links double"),
    )
    got = {r.host: (r.trust, r.distrust) for r in scores.collect()}
    assert set(got) == {f"h{i}" for i in range(n) if want[i].any()}
    assert all(got[h] == pytest.approx(want[int(h[1:])], rel=1e-4, abs=1e-15) for h in got)


@pytest.mark.parametrize(
    ("url", "rule"),
    [
        ("http://org/", "org/"),
        ("http://a.org", None),
        ("http://EXAMPLE.org/es/1", "example.org/es/"),
        ("http://x.example.org/en/12#top", "example.org/en/1"),
        ("http://badexample.org/en/12", "org/"),
        ("http://a.com/fr/", "com/fr/"),
        ("http://a.com/fr", None),
        ("http://a.net/fr/", None),
        ("x http://a.b.com/de/http://q.org/", "com/de/"),
    ],
)
def test_longest_rule_wins(spark, url, rule):
    df = spark.createDataFrame([(1, url, None)], "page_id long, url string, html string")
    assert url_graph.judge(df, RULES).first().rule == rule


def test_empty_table(pages):
    assert url_graph.judge(pages.limit(0), RULES).count() == 0


def test_a_hub_is_several_parts_and_a_step_moves_scores_only(spark, monkeypatch):
    """A host that links to all others: the same scores from parts of seven, and messages that stay where they are."""
    links = [("hub", f"h{i}", 1.0 + i % 3) for i in range(60)] + [(f"h{i}", "hub", 2.0) for i in range(0, 60, 7)]
    links = spark.createDataFrame(links, "src string, dst string, links double")
    seeds = [("hub", 3.0, 0.0), ("h1", 0.0, 2.0), ("h7", 1.0, 1.0), ("lone", 1.0, 0.0)]
    scores = spark.createDataFrame([(*s, s[1], s[2]) for s in seeds], "host string, trust double, distrust double, "
                                   "new_trust double, new_distrust double")  # fmt: skip
    found = []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for part in (url_graph.PART, 7):
            monkeypatch.setattr(url_graph, "PART", part)
            messages, hubs = url_graph.dealt_messages(links)
            assert {r.host: r.parts for r in hubs.collect()} == ({} if part > 100 else {"hub": 10})
            messages = messages.persist()
            after = url_graph.step(messages, hubs, scores, 0.85)
            found.append(sorted((r.host, *(round(v, 9) for v in r[1:])) for r in after.collect()))
            plan = after._jdf.queryExecution().executedPlan().toString().splitlines()
            at = next(i for i, line in enumerate(plan) if "InMemoryTableScan" in line)
            depth = plan[at].find("InMemoryTableScan")
            above = []  # the operators that the scan feeds, up to the join
            for line in reversed(plan[:at]):
                own = len(line) - len(line.lstrip(" :+-*(0123456789)"))
                if own < depth:
                    depth = own
                    above.append(line)
                if "SortMergeJoin" in line:
                    break
            assert "SortMergeJoin" in above[-1] and not any("Exchange" in line for line in above)
            messages.unpersist()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found[0] == found[1] and len(found[0]) == 62
