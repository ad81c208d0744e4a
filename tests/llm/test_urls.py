import math
import re
from collections import Counter, defaultdict

from common import MIDDLE, table
from shotframe.llm import urls
from shotframe.llm.queries import op4_urls


def parse(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return ("".join(c.lower() if c.isascii() else c for c in m[1]), m[2]) if m else ("", "")


def rule(host, path):
    best = (None, None)
    for pattern, says in sorted(urls.RULES, key=lambda r: len(r[0])):
        name, rest = pattern.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            best = (pattern, says)
    return best


def codes(url):
    low = "".join(c.lower() if c.isascii() else c for c in url or "")
    s = [urls.EDGE] * 2 + [urls.ALPHABET.find(c) + 1 for c in low] + [urls.EDGE]
    return [tuple(s[i - 2: i + 1]) for i in range(2, len(s))]


class Model:
    def __init__(self, texts):
        self.n = Counter(c for t in texts for c in codes(t))
        self.two, self.one = Counter(), Counter()
        self.kinds2, self.kinds1, self.sum2, self.sum1 = defaultdict(set), defaultdict(set), Counter(), Counter()
        for (a, b, c), n in self.n.items():
            self.two[b, c] += n
            self.one[c] += n
            self.kinds2[a, b].add(c)
            self.kinds1[b].add(c)
            self.sum2[a, b] += n
            self.sum1[b] += n

    def p(self, a, b, c):
        p = (self.one[c] + 1) / (sum(self.one.values()) + urls.SYMBOLS)
        if self.sum1[b]:
            p = (self.two[b, c] + len(self.kinds1[b]) * p) / (self.sum1[b] + len(self.kinds1[b]))
        if self.sum2[a, b]:
            p = (self.n[a, b, c] + len(self.kinds2[a, b]) * p) / (self.sum2[a, b] + len(self.kinds2[a, b]))
        return p


def brute(rows):
    facts = [(i, u, *parse(u)) for i, u in rows]
    good = Model([u for _, u, h, p in facts if rule(h, p)[1] == "allow"])
    bad = Model([u for _, u, h, p in facts if rule(h, p)[1] == "block"])
    ratio = {}
    out = []
    for i, u, h, p in facts:
        s = 0.0
        for c in codes(u):
            if c not in ratio:
                ratio[c] = math.log(good.p(*c)) - math.log(bad.p(*c)) if good.n and bad.n else 0.0
            s += ratio[c]
        out.append((i, h, p, *rule(h, p), s / len(codes(u))))
    return out


def check(got, rows):
    want = brute(rows)
    key = lambda r: (repr(r[0]), r[1], r[2], round(r[-1], 6))
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, r.score) for r in got), key=key)
    want = sorted(want, key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want):
        assert abs(g[5] - w[5]) < 1e-9
        assert w[4] is None or g[4] == w[4]
    free = [(g[5], g[4]) for g in got if g[3] is None]
    if len({v for _, v in free}) == 2:  # one threshold parts them
        assert max(s for s, v in free if v == "block") < min(s for s, v in free if v == "allow")
    return free


def test_equals_brute_force(spark):
    rows = [(r["page_id"], r["url"]) for r in table("pages", MIDDLE)]
    assert check(op4_urls(spark, MIDDLE).collect(), rows)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://EXAMPLE.net"), (5, "http://a.net/x?q#f"), (6, "http://example.net/en/1"),
            (7, "ftp://x.org/fr/z"), (8, "http://notnet/"), (9, "x://\nnet/ä"), (9, "x://\nnet/ä"), (None, "http://a.net/"),
            (10, "http://example.com/de/" + "long" * 5000), (11, "http://a.example.com/fr/q://net/")]
    df = spark.createDataFrame([(i, u, 1, 2, 3) for i, u in rows], "page_id bigint, url string, host int, score int, context int")
    check(urls.judged(df).collect(), rows)


def test_without_rules_all_is_allowed(spark):
    df = spark.createDataFrame([(1, "http://x.com/"), (2, None)], "page_id bigint, url string")
    assert {(r.verdict, r.score) for r in urls.judged(df).collect()} == {("allow", 0.0)}
    assert urls.judged(df.where("false")).collect() == []


def test_native_plan(spark):
    plan = op4_urls(spark, MIDDLE)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Cartesian|NestedLoop", plan)
