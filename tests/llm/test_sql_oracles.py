"""Queries that SQL can express, by value; and their awkward rows."""

import hashlib

import pyarrow.parquet as pq
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from starkeel.llm import chat_format, license_scan, queries, url_filter

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_and_values(spark, name):
    con = connect(SF)
    assert differences(queries.QUERIES[name](spark, SF), con, queries.ORACLES[name]) == []
    con.close()


def test_licence_scan_is_native(spark):
    plan = queries.op3_license_scan(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Cartesian", "NestedLoop", "Exchange"))


def test_licences_near_the_threshold(spark, empty):
    """Bounds and anchors lose nothing against comparing every unit with every template."""
    texts = []
    for _, t in license_scan.TEMPLATES:
        w = t.split()
        texts += [" ".join(w[:k]) for k in range(1, len(w) + 1)] + [" ".join([*w, *["more"] * k]) for k in range(12)]
        texts += [" ".join(w[k:]) for k in range(len(w))] + [" ".join(w[: len(w) // 2]) + "\n" + " ".join(w[len(w) // 2 :])]
    rows = list(enumerate(texts)) + [(None, "Released under the MIT License."), (-1, None), (-2, ""), (-3, "\n\n")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("own", F.lit(1))
    got = {(r["doc_id"], r["unit"], r["unit_no"], r["license"]): r["dice"] for r in license_scan.scan(df).collect()}
    expected = {}
    for i, t in rows:
        units = [("line", n, u) for n, u in enumerate((t or "").split("\n"))]
        units += [("paragraph", 0, t)] if t and "\n" in t.strip() else []
        for unit, n, u in units:
            a = license_scan.bigrams(u)
            for name, template in license_scan.TEMPLATES:
                b = license_scan.bigrams(template)
                dice = 2 * len(a & b) / (len(a) + len(b))
                if dice >= license_scan.THRESHOLD - 1e-9:
                    key = (i, unit, n, name)
                    expected[key] = max(dice, expected.get(key, 0))
    assert got == pytest.approx(expected) and len(got) > 300
    assert license_scan.scan(empty).collect() == []


TURNS = "conv_id bigint, turn bigint, role string, text string"


def test_chat_round_trip(spark):
    hostile = ["[INST]", "</s>", "<\\s>", "[\\\\/INST]", "<s>x</s>[INST]\n", "[[/INST]", "", "a\\n", "é\U0001f600 <s", "</s"]
    rows = [(c, t, ["user", "assistant", "od\nd\\n<s>", "system"][(c + t) % 4], hostile[(3 * c + t) % 10]) for c in range(9) for t in range(11)]
    rows += [(None, 0, "assistant", "x"), (20, None, None, None), (20, None, None, None), (20, 1, "assistant", "y" * 3_000_000)]
    df = spark.createDataFrame(rows, TURNS).withColumn("block", F.lit("z")).repartition(5)
    blocks = chat_format.format_turns(df)
    texts, spans = {}, {}
    for r in sorted(blocks.collect(), key=lambda r: r["block"]):
        texts[r["conv_id"]] = texts.get(r["conv_id"], b"") + bytes(r["text"])
        spans.setdefault(r["conv_id"], []).extend(
            bytes(r["text"])[a:b] for a, b in zip(r["loss_starts"], r["loss_ends"], strict=True)
        )
    order = lambda r: tuple((x is not None, x) for x in r)
    digests = {r["conv_id"]: r for r in chat_format.digests(blocks).collect()}
    assert set(texts) == {r[0] for r in rows} == set(digests)
    for conv, text in texts.items():
        own = [((r or ""), (t or "")) for _, _, r, t in sorted((x for x in rows if x[0] == conv), key=order)]
        assert chat_format.read_back(text) == [(r.encode(), t.encode()) for r, t in own]
        loss = [t for r, t in own if r == "assistant"]
        assert [chat_format._broken.sub(rb"\1\2\3", s).decode() for s in spans[conv]] == loss
        d = digests[conv]
        assert d["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert d["loss_sha256"] == hashlib.sha256("".join(loss).encode()).hexdigest()
        assert (d["n_turns"], d["loss_chars"], d["formatted_chars"]) == (len(own), len("".join(loss)), len(text.decode()))
    none = spark.createDataFrame([], TURNS)
    assert chat_format.digests(chat_format.format_turns(none)).collect() == []


def test_a_hot_conversation_is_split(spark):
    df = spark.range(4000).selectExpr(
        "if(id % 3 = 0, id, 7) as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "repeat(string(id), 30) as text"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        blocks = chat_format.format_turns(df)
        assert len({r["block"] >> 32 for r in blocks.filter("conv_id = 7").collect()}) > 1
        row = chat_format.digests(blocks).filter("conv_id = 7").first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    own = sorted((r["turn"], r["role"], r["text"]) for r in df.filter("conv_id = 7").collect())
    assert row["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in own).encode()).hexdigest()


PAGES = "page_id bigint, url string, html string"


def page(n, url, *links):
    return (n, url, "".join(f'<a class=x href="{u}">' for u in links))


def test_rules_and_urls(spark):
    cases = {
        "http://a.NET/x": ("a.net", "/x", "net/", "block"),
        "http://example.net/en/1?q": ("example.net", "/en/1", "example.net/en/", "allow"),
        "http://b.example.net/en": ("b.example.net", "/en", "net/", "block"),
        "http://notexample.net/en/": ("notexample.net", "/en/", "net/", "block"),
        "https://x.example.com/de/#t": ("x.example.com", "/de/", "example.com/de/", "block"),
        "http://ÄB.org/fr/": ("Äb.org", "/fr/", "org/fr/", "allow"),
        "http://net": ("net", "", None, "allow"),
        "http://x.org?a/b://c": ("x.org", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "://": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    rows = [(i, u, None) for i, u in enumerate(cases)] + [(None, "http://q.net/", None), (0, "http://a.NET/x", "<p>")]
    df = spark.createDataFrame(rows, PAGES).withColumn("host", F.lit("z"))
    got = [tuple(r)[:5] for r in url_filter.judge(df, queries.RULES).collect()]
    expected = [(i, *cases[u]) for i, u in enumerate(cases)] + [(None, "q.net", "/", "net/", "block"), (0, *cases["http://a.NET/x"])]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert url_filter.judge(spark.createDataFrame([], PAGES), queries.RULES).collect() == []


def test_trust_and_distrust_spread(spark):
    rows = [page(1, "http://good.org/fr/1", "http://friend.com/", "/here", "//friend.com/2")]
    rows += [page(2, "http://friend.com/1", "HTTP://Friend2.com/x")]
    rows += [page(3, "http://bad.net/1"), page(4, "http://shady.com/1", "http://bad.net/1"), page(5, "http://calm.com/")]
    judged = url_filter.judge(spark.createDataFrame(rows, PAGES), queries.RULES).collect()
    by = {r["host"]: r for r in judged}
    assert by["friend.com"]["trust"] > 0 == by["friend.com"]["distrust"]
    assert by["shady.com"]["distrust"] >= url_filter.DISTRUST and by["shady.com"]["verdict"] == "block"
    assert by["calm.com"]["verdict"] == "allow" and by["calm.com"]["distrust"] == 0

    def settled(seed):
        mass = dict(seed)
        for _ in range(400):
            # friend2.com has no links and keeps what it gets.
            sent = {"friend.com": mass["good.org"], "friend2.com": mass["friend.com"], "good.org": 0.0}
            mass = {h: 0.15 * seed[h] + 0.85 * sent[h] for h in mass}
        return mass

    mass, rank = settled({"good.org": 1.0, "friend.com": 0.0, "friend2.com": 0.0}), settled({"good.org": 1.0, "friend.com": 1.0, "friend2.com": 1.0})
    assert by["friend.com"]["trust"] == pytest.approx(0.85 * mass["friend.com"] / rank["friend.com"])


@pytest.mark.parametrize("n", [0, 5, 200])
def test_links_to_a_host_do_not_change_what_it_links_to(spark, n):
    """A host that only links to a blocked one is blocked, however many trusted hosts link to it."""
    rows = [page(-1, "http://spam.com/", "http://bad.net/"), page(-2, "http://bad.net/")]
    rows += [page(i, f"http://t{i}.org/fr/", "http://spam.com/") for i in range(n)]
    by = {r["page_id"]: r for r in url_filter.judge(spark.createDataFrame(rows, PAGES), queries.RULES).collect()}
    assert by[-1]["verdict"] == "block" and 0 <= by[-1]["trust"] < url_filter.DAMPING


def test_linked_pages_by_sql(spark, tmp_path):
    """Chains, cycles, few and many that link to blocked and to trusted hosts: the query's verdicts are those of SQL."""
    rows, n = [], iter(range(10_000))
    add = lambda url, *to: rows.append(page(next(n), url, *to))
    add("http://bad.net/1")
    add("http://worse.net/1")
    add("http://good.org/fr/1", "http://c0.com/")
    for k in range(6):
        add(f"http://c{k}.com/", f"http://c{k + 1}.com/")
        add(f"http://d{k + 1}.com/", f"http://d{k}.com/")
    add("http://d0.com/", "http://bad.net/")
    for k in range(3):
        add(f"http://r{k}.com/", f"http://r{(k + 1) % 3}.com/", *(["http://bad.net/"] if k == 0 else []))
        add(f"http://q{k}.com/", f"http://q{(k + 1) % 3}.com/", "http://good.org/")
    for k in range(2):
        add(f"http://few{k}.com/", "http://worse.net/")
    for k in range(1000):
        add(f"http://many{k}.com/", "http://bad.net/")
        add(f"http://fan{k}.org/fr/", "http://spam.com/", "http://fine.com/")
    add("http://spam.com/", "http://bad.net/")
    add("http://fine.com/", "http://bad.net/", *[f"http://ok{k}.com/" for k in range(9)])
    add("http://both.com/", "http://bad.net/", "http://good.org/")
    add("http://example.com/de/", "http://fine.com/")
    add("http://example.com/other", "http://bad.net/")
    spark.createDataFrame(rows, PAGES).write.parquet(str(tmp_path / "all"))
    pq.write_table(pq.read_table(tmp_path / "all"), tmp_path / "pages.parquet")
    con = connect(str(tmp_path))
    assert differences(queries.op5_url_filter(spark, str(tmp_path)), con, queries.ORACLES["op5_url_filter"]) == []
    con.close()
    verdicts = {r["host"]: r["verdict"] for r in queries.op5_url_filter(spark, str(tmp_path)).collect()}
    assert verdicts["many7.com"] == verdicts["few0.com"] == verdicts["spam.com"] == verdicts["d1.com"] == "block"
    assert verdicts["c3.com"] == verdicts["fine.com"] == verdicts["q1.com"] == "allow"


@pytest.mark.parametrize("n", [2, 1000])
def test_distrust_does_not_thin_out_with_the_number_of_linkers(spark, n):
    """Hosts that link to a blocked one are caught however many there are; the blocked one stays blocked."""
    rows = [page(i, f"http://s{i}.com/", "http://bad.com/de/") for i in range(n)]
    rows += [page(n + i, f"http://bad.com/de/{i}") for i in range(9)] + [page(n + 9, "http://bad.com/other")]
    rules = (url_filter.Rule("block", "bad.com", "/de/"),)
    rows += [page(n + 10, "http://far.com/", "http://s0.com/", "http://s1.com/"), page(n + 11, "http://mixed.com/", *[f"http://x{i}.com/" for i in range(9)], "http://bad.com/")]
    by = {r["page_id"]: r for r in url_filter.judge(spark.createDataFrame(rows, PAGES), rules).collect()}
    assert all(by[i]["verdict"] == "block" and by[i]["distrust"] == pytest.approx(0.85 * 0.9) for i in range(n))
    assert by[n + 9]["verdict"] == "block" and by[n + 9]["distrust"] == pytest.approx(0.9)
    assert by[n + 10]["distrust"] == pytest.approx(0.85**2 * 0.9) and by[n + 10]["verdict"] == "block"
    assert by[n + 11]["distrust"] == pytest.approx(0.085 * 0.9) and by[n + 11]["verdict"] == "allow"
