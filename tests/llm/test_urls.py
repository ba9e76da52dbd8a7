"""Verdicts on urls (12) against a plain walk over each host's tree."""

import random
import re
from collections import Counter, defaultdict
from math import sqrt

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import CLASHING
from veiltext.llm.op12_urls import LEVELS, judge_urls
from veiltext.llm.queries import QUERIES, URL_RULES


def split_url(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path, rules):
    fitting = []
    for verdict, rule in rules:
        name, _, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            fitting.append((len(rule), len(name), rule, verdict))
    return max(fitting)[2:] if fitting else (None, None)


def kind(s):
    if s == "":
        return ""
    stem = re.sub(r"\.[A-Za-z][A-Za-z0-9]{0,4}\Z", "", s)
    name = "{n}" if re.fullmatch("[0-9]+", stem) else "{hex}" if re.fullmatch(r"(?s)(?=.*[0-9])[0-9A-Fa-f-]{8,}", stem) else "{word}"
    return name + (".*" if stem != s else "")


ALL_KINDS = ["", "{n}", "{n}.*", "{hex}", "{hex}.*", "{word}", "{word}.*"]


class Branch:
    def __init__(self):
        self.n = self.blocked = self.labelled = 0
        self.next, self.members = Counter(), []

    def add(self, other):
        for f in ("n", "blocked", "labelled"):
            setattr(self, f, getattr(self, f) + getattr(other, f))
        self.next += other.next
        self.members += other.members

    def like(self, other):
        chi, used = 0.0, 0
        for k in [None, *ALL_KINDS]:
            x, y = self.next[k], other.next[k]
            if x + y:
                used += 1
                chi += (x * sqrt(other.n / self.n) - y * sqrt(self.n / other.n)) ** 2 / (x + y)
        if chi > used - 1 + 2.33 * sqrt(2 * (used - 1)):
            return False
        if not self.labelled or not other.labelled:
            return True
        pooled = (self.blocked + other.blocked) / (self.labelled + other.labelled)
        apart = self.blocked / self.labelled - other.blocked / other.labelled
        return apart**2 <= 2.33**2 * pooled * (1 - pooled) * (1 / self.labelled + 1 / other.labelled)


def brute(rows, rules):
    """url -> host, path, rule, verdict, purity."""
    urls = [(u, *split_url(u)) for _, u in rows]
    ruled = {u: rule_of(h, p, rules) for u, h, p in urls}
    per_level, total = Counter(), Counter()
    segs = {}
    for u, h, p in urls:
        parts = p[1:].split("/") if p else []
        if len(parts) > LEVELS:
            parts = [*parts[: LEVELS - 1], "/".join(parts[LEVELS - 1 :])]
        segs[u] = parts
        for i, s in enumerate(parts):
            per_level[h, i, s] += 1
            total[h, i] += 1
    nodes = {u: [("=" + s if per_level[h, i, s] >= 5 and per_level[h, i, s] >= 0.05 * total[h, i] else "*" + kind(s)) for i, s in enumerate(segs[u])] for u, h, _ in urls}
    children = defaultdict(lambda: defaultdict(Branch))
    for u, h, _ in urls:
        verdict = ruled[u][1]
        for i, g in enumerate(nodes[u]):
            b = children[h, tuple(nodes[u][:i])][g]
            b.n += 1
            b.members = [g]
            b.labelled += verdict is not None
            b.blocked += verdict == "block"
            b.next[kind(segs[u][i + 1]) if i + 1 < len(segs[u]) else None] += 1
    leader = {}
    for (h, above), each in children.items():
        done = []
        for g, b in sorted(each.items(), key=lambda x: (-x[1].n, x[0])):
            first = next((c for c in done if c[1].like(b)), None)
            if first:
                first[1].add(b)
            else:
                done.append((g, b))
        for g, b in done:
            for m in b.members:
                leader[h, above, m] = g
    ways = {u: [leader[h, tuple(nodes[u][:i]), g] for i, g in enumerate(nodes[u])] for u, h, _ in urls}
    bad, known = Counter(), Counter()
    for u, h, _ in urls:
        verdict = ruled[u][1]
        for i in range(len(ways[u]) + 1):
            known[h, tuple(ways[u][:i])] += verdict is not None
            bad[h, tuple(ways[u][:i])] += verdict == "block"
    all_bad, all_known = (sum(bool(f(ruled[u][1])) for u, _, _ in urls) for f in (lambda v: v == "block", lambda v: v is not None))
    out = {}
    for u, h, p in urls:
        purity = (all_bad + 1) / (all_known + 2)
        for i in range(len(ways[u]) + 1):
            key = h, tuple(ways[u][:i])
            purity = (bad[key] + 2 * purity) / (known[key] + 2)
        out[u] = (h, p, ruled[u][0], ruled[u][1] or ("block" if purity > 0.5 else "allow"), round(purity, 9))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string")


def compared(df, rows, rules):
    want = brute(rows, rules)
    assert df.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    got = sorted(((r.page_id, (r.host, r.path, r.rule, r.verdict, round(r.purity, 9))) for r in df.collect()), key=str)
    assert got == sorted(((i, want[u]) for i, u in rows), key=str)
    return want


def test_whole_table_against_a_walk(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()]
    want = compared(QUERIES["op12_url_verdicts"](spark, sf), rows, URL_RULES)
    assert {v[3] for v in want.values() if v[2] is None} == {"allow", "block"}


def urls(seed, n=900):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        host = rng.choice(["a.com", "b.a.com", "c.org", "C.Org", "x.c.org"])
        section = rng.choice(["news", "shop", "tag", "u", f"w{rng.randrange(300)}"])
        leaf = {"news": f"{rng.randrange(9999)}.html", "shop": f"{rng.getrandbits(48):012x}", "tag": f"{rng.choice('pqr')}/{i}", "u": f"~name{i}/"}.get(section, str(i))
        out.append((i, f"https://{host}/{section}/{leaf}{rng.choice(['', '?q=1', '#x', '?a=/b#c'])}"))
    return out


def test_trees_against_a_walk(spark):
    rules = [("block", "c.org/shop/"), ("allow", "a.com/news/"), ("block", "a.com/news/1"), ("allow", "x.c.org/"), ("block", "a.com/tag/p")]
    for seed in (1, 2):
        rows = urls(seed)
        df = judge_urls(frame(spark, rows), rules)
        compared(df, rows, rules)
        assert df.where("template like '%(%|%'").limit(1).count() and df.where("template like '%{n}%'").limit(1).count()


def test_awkward_urls(spark):
    rows = [
        (1, None), (2, ""), (3, "no scheme/a"), (4, "://"), (5, "://?x"), (6, "http://A.net"), (7, "http://a.net/"), (8, "http://a.net//x//"), (None, "http://a.net/q"),
        (9, "http://a.net/p?u=http://b.org/fr/1"), (10, "ÄÖ://HÖST.Net/de\n/1"), (11, "http://net/" + "s/" * 5000), (12, "http://net/" + "x" * 100_000), (13, "http://xnet/"), (14, "http://net./"),
        (15, "http://a.net/=x/{n}/*{n}"), (15, "http://a.net/=x/{n}/*{n}"),
    ] + [(20 + i, "http://hot.net/" + "s/" * 30 + str(i)) for i in range(20)]
    df = frame(spark, rows).select("*", *(F.lit("x").alias(c) for c in [*CLASHING, "host", "path", "n", "rule", "verdict"]))
    want = compared(judge_urls(df, URL_RULES), rows, URL_RULES)
    assert want[None][:3] == ("", "", None) and want["http://A.net"][:3] == ("a.net", "", None) and want["http://a.net/"][2] == "net/"


def test_empty_table_and_no_labels(spark):
    assert judge_urls(frame(spark, []), URL_RULES).collect() == []
    rows = urls(3, 100)
    assert {r.verdict for r in judge_urls(frame(spark, rows), []).collect()} == {"allow"}
    compared(judge_urls(frame(spark, rows), []), rows, [])


def test_longest_rule_wins(spark):
    rules = [("block", "org/"), ("allow", "b.org/x/"), ("block", "b.org/x/y"), ("allow", "c.b.org/")]
    cases = {"http://b.org/x/z": "b.org/x/", "http://b.org/x/yy": "b.org/x/y", "http://c.b.org/x/y": "b.org/x/y", "http://c.b.org/k": "c.b.org/", "http://ab.org/x/": "org/"}
    out = judge_urls(frame(spark, list(enumerate(cases))), rules).collect()
    assert [r.rule for r in sorted(out, key=lambda r: r.page_id)] == list(cases.values())
    for wrong in [("drop", "a/")], [("block", "/a")], [("block", "a")]:
        with pytest.raises(ValueError):
            judge_urls(frame(spark, []), wrong)


def test_built_in_functions_only(spark):
    plan = judge_urls(frame(spark, urls(4, 50)), URL_RULES)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)
