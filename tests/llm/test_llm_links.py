"""URL verdicts, quotation links and license places."""

import math
import random

import duckdb
import pytest
from compare import database, differences

from tidemark.llm import license_scan, quote_links, url_templates
from tidemark.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert slow not in plan
    assert differences(df, database(SF_DIR), ORACLE[name]) is None


URLS = [
    (1, "http://A.Example.NET/en/1?x=/de/"), (2, "https://net"), (3, "ftp://x.net/"), (4, "http://notexample.com/de/1"),
    (5, "http://www.example.com/de/1#a"), (6, "http://b.org/fr/"), (7, "http://b.org/fr"), (8, None), (9, ""), (10, "no scheme/x"),
    (11, "http://"), (12, "a://b://c/d"), (13, "http://É.NET/x\ny?z"), (14, "http://x.net?/en/"), (15, "http://h.com/1/2/3/4/5"),
    (15, "http://h.com/1/2/3/4/5"), (16, "http://example.net/en"), (17, "http://u:p@h.com:80/%20"),
]


def test_url_parts_and_rules(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").selectExpr("*", "url as host", "url as template")
    labels = spark.createDataFrame([(1, 0), (1, 1), (99, 1), (2, None)], "page_id long, good int")
    rows = {r.page_id: r for r in url_templates.judge_urls(pages, labels).collect()}
    assert len(rows) == 17
    expected = {
        1: ("a.example.net", "/en/1", "example.net/en/", "allow"), 2: ("net", "", None, "allow"), 3: ("x.net", "/", "net/", "block"),
        4: ("notexample.com", "/de/1", None, "allow"), 5: ("www.example.com", "/de/1", "example.com/de/", "block"),
        6: ("b.org", "/fr/", "org/fr/", "allow"), 7: ("b.org", "/fr", None, "allow"), 8: ("", "", None, "allow"),
        9: ("", "", None, "allow"), 10: ("", "", None, "allow"), 11: ("", "", None, "allow"), 12: ("b:", "//c/d", None, "allow"),
        13: ("É.net", "/x\ny", "net/", "block"), 14: ("x.net", "", None, "allow"), 16: ("example.net", "/en", "net/", "block"),
        17: ("u:p@h.com:80", "/%20", None, "allow"),
    }
    for key, want in expected.items():
        row = rows[key]
        got = (row.host, row.path, row.rule, row.verdict)
        assert got[:3] == want[:3] and (row.rule is None or got == want), key


def test_impure_templates_are_blocked(spark):
    pages = [(n, f"http://h.com/{'spam' if n % 2 else 'news'}/{n}.html") for n in range(200)]
    labels = [(n, int(n % 2 == 0)) for n in range(0, 200, 3)]
    rows = url_templates.judge_urls(
        spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, good int")
    ).collect()
    assert {(r.template, r.verdict) for r in rows} == {("/spam/0.a", "block"), ("/news/0.a", "allow")}
    like = [(n, f"http://h.com/{'one' if n % 2 else 'two'}/{n}.html") for n in range(200)]
    rows = url_templates.judge_urls(
        spark.createDataFrame(like, "page_id long, url string"),
        spark.createDataFrame([(n, int(n % 4 < 3)) for n in range(0, 200)], "page_id long, good int").where("page_id % 5 < 2"),
    ).collect()
    assert len({r.template for r in rows}) <= 2


MESSAGES = [
    (1, 0, "user", "Hello there.\nHow are you?\n\nSecond para"),
    (1, 1, "assistant", "On Monday, X wrote:\n> Hello  there.\n> how are you?\n\nFine."),
    (1, 2, "user", "> > hello there.\n>> How are you?\n> Fine.\nGood!"), (1, 3, None, ">second PARA\nok\r\n> nothing known"),
    (1, 4, "user", None), (1, 5, "user", ""), (2, 0, "a", "> Hello there."), (2, 1, "b", "x\n> y\nx"), (2, 2, "c", ">x\n>\n>x"),
    (None, 1, "a", "> x"), (2, None, "a", "> x"), (1, 2, "user", "dup"), (3, 0, "a", "p1\n\np2"), (3, 1, "b", "> p1\n>\n> p2\nyes"),
    (3, 2, "c", "> yes\n> > p2\n"), (3, 7, "c", ">>> p2\n> zzz\n"), (3, 8, "d", ">" * 300 + " deep"),
]


def test_replies(spark):
    rows = MESSAGES + [(4, n, "u", f"> say {n - 1}\nsay {n}" if n else "say 0") for n in range(40)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ordered = quote_links.reply_order(messages.selectExpr("*", "turn as thread", "text as chat"))
    got = {(r.conv_id, r.turn): r for r in ordered.collect()}
    assert (got[1, 2].reply_to, got[1, 2].thread, got[1, 2].depth, got[1, 2].n_linked) == (1, 0, 2, 2)
    assert (got[3, 1].reply_to, got[3, 2].reply_to, got[3, 7].reply_to) == (0, 1, 0)
    assert got[1, 1].text == "Fine." and got[1, 3].chat == "<|unknown|>\nok<|end|>\n"
    assert (got[4, 39].thread, got[4, 39].depth) == (0, 39)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert differences(ordered, con, quote_links.oracle()) is None


def test_licenses_equal_brute_force():
    rng = random.Random(3)
    names = list(license_scan.TEMPLATES)
    docs = ["", " ", "a b"]
    for _ in range(300):
        words = [rng.choice(["aa", "bb", "cc", "the", "license"]) for _ in range(rng.randint(0, 80))]
        template = license_scan.TEMPLATES[rng.choice(names)].split()
        for _ in range(rng.randint(0, len(template) // 20)):
            template[rng.randrange(len(template))] = "zz"
        at = rng.randint(0, len(words))
        docs.append(" ".join(words[:at] + template + words[at:]))
    index = license_scan.Index(license_scan.TEMPLATES)
    for text, found in zip(docs, license_scan.scan(docs, index), strict=True):
        words = license_scan.words_of(text)
        own = license_scan.shingles(words, [len(words)]).tolist()
        expected = set()
        for template in index.templates:
            reach, least = math.ceil(template.length / 0.8), math.ceil(0.8 * len(template.shingles) - 1e-9)
            if any(len(template.shingles & {*own[i : i + reach]}) >= least for i in range(len(own))):
                expected.add(template.name)
        assert {f[0] for f in found} == expected
        for _, start, end, first, last, _ in found:
            assert license_scan.words_of(text[start:end]) == words[first:last]


def test_license_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op3_licenses"](spark, SF_DIR).collect()
    for name in ("MIT", "Apache-2.0", "CC-BY-NC-4.0", "GPL-3.0"):
        notice = license_scan.TEMPLATES[name]
        assert {k for k, t in docs.items() if notice in t} == {r.doc_id for r in rows if r.template == name}
    with pytest.raises(ValueError):
        license_scan.Index({"short": "three words only"})


def test_branches_that_differ_deep_down(spark):
    """Bad and good branches below four and more equal segments get verdicts of their own."""
    rows, labels = [], []
    for n in range(240):
        kind = ("casino", "news")[n % 2]
        path = ("blog/2023/05", "a/b/c/d/e/f")[n // 2 % 2]
        rows.append((n, f"http://deep.example/{path}/{kind}/page-{n}"))
        if n % 3 == 0:
            labels.append((n, n % 2))
    rows.append((900, "http://deep.example/x/1/y/22/z-3"))
    got = {
        r.page_id: r
        for r in url_templates.judge_urls(
            spark.createDataFrame(rows, "page_id long, url string"),
            spark.createDataFrame(labels, "page_id long, good int"),
            rules=(),
        ).collect()
    }
    assert len(got) == len(rows)
    for n in range(240):
        assert got[n].verdict == ("block", "allow")[n % 2]
        assert got[n].template.endswith(("/casino/a-0", "/news/a-0")[n % 2])
    assert got[900].template == "/a/0/a/0/a-0"
