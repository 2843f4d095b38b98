"""URL rules, the archive and main-text extraction."""

import base64
import hashlib
import random
import re
import time

import duckdb
import pytest

from quirefold.llm import htmlextract, urlfilter, warc
from quirefold.llm.htmlblocks import leaf_blocks

SMALL = "/root/testdata/sf0.001"
PAGES = "page_id bigint, url string, html string, host string, key int"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "h", 1) for r in rows], PAGES)


# --- url rules


def test_rules_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SMALL}/pages.parquet'")
    relation = con.sql(urlfilter.OP1_SQL)
    frame = urlfilter.op1_redirect_equivalence(spark, SMALL).select(relation.columns)
    assert sorted(map(tuple, frame.collect())) == sorted(relation.fetchall())


def judged(spark, rows, rules=urlfilter.RULES, edges=None):
    extra = None if edges is None else spark.createDataFrame(edges, "source string, target string")
    found = urlfilter.judge_pages(pages_of(spark, rows), rules, extra).collect()
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found}


def test_hosts_paths_and_longest_rule(spark):
    rows = [
        (1, "https://WWW.Example.com/en/x?q#f", None),
        (2, "https://example.com/en/", None),
        (3, "https://m.example.com/en/a", None),
        (4, "https://example.com/EN/", None),
        (5, "https://notexample.com/en/", None),
        (6, "https://a.net/fr/", None),
        (7, "https://a.net", None),
        (8, "no scheme.com/en/", None),
        (9, None, None),
        (10, "http://É.net/es/x://y", None),
        (11, "x://a.com?u=/en/", None),
        (12, "://com/", None),
        (13, "", None),
    ]
    assert judged(spark, rows) == {
        1: ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        2: ("example.com", "/en/", "example.com/en/", "block"),
        3: ("m.example.com", "/en/a", "example.com/en/", "block"),
        4: ("example.com", "/EN/", "com/", "allow"),
        5: ("notexample.com", "/en/", "com/", "allow"),
        6: ("a.net", "/fr/", "net/fr/", "block"),
        7: ("a.net", "", None, "allow"),
        8: ("", "", None, "allow"),
        9: ("", "", None, "allow"),
        10: ("É.net", "/es/x://y", "net/es/", "block"),
        11: ("a.com", "", None, "allow"),
        12: ("com", "/", "com/", "allow"),
        13: ("", "", None, "allow"),
    }


def test_blocks_reach_aliases_and_allows_come_first(spark):
    link = '<link href="{}" rel="canonical">'.format
    rows = [
        (1, "https://a.org/1", link("https://b.org/2")),
        (2, "http://b.org/2#top", '<meta http-equiv="refresh" content="0; url=/3">'),
        (3, "https://b.org/3", link("//x.net/fr/4")),
        (4, "https://c.org/1", link("https://x.net/fr/9")),
        (5, "https://c.org/2", link("https://c.org/1")),
        (6, "https://c.org/2", None),
        (7, "https://d.org/1", link("https://x.net/es/1") + link("https://ok.com/")),
        (8, "https://lone.org/1", link("https://lone.org/2")),
        (9, "https://x.net/es/1", None),
        (10, "https://e.org/dir/a", link("b?x=1&amp;y=2")),
    ]
    edges = [("https://e.org/dir/b?x=1&y=2", "https://f.net/fr/"), (None, "https://x.net/fr/"), ("https://x.net/fr/", "")]
    verdicts = {k: v[3] for k, v in judged(spark, rows, edges=edges).items()}
    blocked = {1, 2, 3, 4, 5, 6, 9, 10}
    assert verdicts == {k: "block" if k in blocked else "allow" for k in range(1, 11)}


def test_no_pages_no_rules(spark):
    assert judged(spark, []) == {}
    assert judged(spark, [(1, "http://a.net/fr/", None)], rules=[]) == {1: ("a.net", "/fr/", None, "allow")}


# --- archive


def archived(spark, rows, folder, least=0):
    warc.write_archive(pages_of(spark, rows), folder, least)
    return warc.read_records(spark, folder)


def expected(rows, least=0):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "")]
        owner = max((p for p in same if p is not None), default=None)
        response = page_id == owner or len(payload) < least
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page_id, len(payload), digest, "response" if response else "revisit", None if response else owner))
    return sorted(out, key=repr)


WARC_ROWS = [
    (1, "http://a/é", "<p>é</p>"),
    (2, "http://b/", "<p>é</p>"),
    (5, None, None),
    (4, "http://c/\r\nx: y", ""),
    (7, "http://d/", "\r\n\r\nWARC/1.1\r\n\r\n"),
    (None, "http://e/", "alone"),
    (None, "http://f/", "<p>é</p>"),
    (8, "http://g/", "x" * 100_000),
]


@pytest.mark.parametrize("least", [0, 6])
def test_records_say_what_was_archived(spark, shared, least):
    records = archived(spark, WARC_ROWS, f"{shared}/a", least)
    assert sorted(map(tuple, warc.describe_records(records).collect()), key=repr) == expected(WARC_ROWS, least)


def test_record_bytes_are_whole(spark, shared):
    for row in archived(spark, WARC_ROWS, f"{shared}/b").collect():
        record = bytes(row.record)
        head, rest = record.split(b"\r\n\r\n", 1)
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n")
        block = rest[:-4]
        assert int(fields[b"Content-Length"]) == len(block)
        body = block.split(b"\r\n\r\n", 1)[1]
        digest = base64.b32encode(hashlib.sha1(bytes(row.payload)).digest())
        assert fields[b"WARC-Payload-Digest"] == b"sha1:" + digest
        assert body == (b"" if fields[b"WARC-Type"] == b"revisit" else bytes(row.payload))


def test_payloads_are_stored_once(spark, shared):
    archived(spark, WARC_ROWS + [(8, "http://g/", "x" * 100_000)], f"{shared}/c").count()
    stored = spark.read.parquet(f"{shared}/c/payloads")
    assert stored.count() == len({h or "" for *_, h in WARC_ROWS})


def test_a_wrong_digest_is_refused(spark, shared):
    records = archived(spark, WARC_ROWS[:1], f"{shared}/d").selectExpr("head", "record", "cast('other' as binary) as payload")
    with pytest.raises(Exception, match="does not match"):
        warc.describe_records(records).collect()


def test_empty_archive(spark, shared):
    assert warc.describe_records(archived(spark, [], f"{shared}/e")).count() == 0


def test_given_pages_archive(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    found = warc.op7_content_addressed_archive(spark, SMALL).collect()
    assert sorted(map(tuple, found), key=repr) == expected(rows)


# --- main text


def test_leaf_blocks():
    html = """<!DOCTYPE html><title>T &amp; t</title><script>var x="<p>";</script><style>p{}</style>
    <div class="Ad box"><a href=x>buy</a>  now</div><p>one<p>two <b>bold<br>line</b>&nbsp;&lt;x&gt;<!-- no -->
    <ul><li>a<li>b</ul></div> tail &copy <template>no</template><p"""
    blocks = leaf_blocks(html)
    assert [b.text for b in blocks] == ["T & t", "buy now", "one", "two bold line <x>", "a", "b", "tail © <p"]
    assert blocks[1].path == (("div", ("ad", "box")),) and blocks[1].linked == 3
    assert leaf_blocks(None) == leaf_blocks("") == leaf_blocks("<p> </p>") == []
    assert len(leaf_blocks("<div>" * 3000 + "x")) == 1
    assert leaf_blocks("<script>never closed")[0:] == []


def test_quoted_values_and_open_tags():
    def texts(html):
        return [b.text for b in leaf_blocks(html)]

    assert texts("""<p title="a > b">hello</p><p title='x > "y"' class=z>you""") == ["hello", "you"]
    assert leaf_blocks("""<div title=">" class='note > big'><p>x""")[0].path[0] == ("div", ("big", "note"))
    assert texts("<p it's=1>one</p><p>don't</p>") == ["one", "don't"]
    assert texts('<p title="never closed>text</p><p>more</p>') == ["text", "more"]
    assert texts("<p>a</p><!--> b --> c") == ["a", "b --> c"]
    assert texts("<p>a</p><!-- x > --!>c") == ["a", "c"]
    assert texts("<p>a</p><a b") == ["a", "<a b"] and texts("a <! b") == ["a <! b"]
    assert texts("1 < 2 and 3 <= 4<p>x") == ["1 < 2 and 3 <= 4", "x"]


@pytest.mark.parametrize("piece", ["<a ", "<a x=", '<a x="', "<a x='\"", "<!", "</", "<a", "=\"<", "<!--", "<a class=' "])
def test_parse_time_is_linear(piece):
    def seconds(n):
        begun = time.perf_counter()
        leaf_blocks(piece * n)
        return time.perf_counter() - begun

    seconds(100)
    assert seconds(200_000) < 2  # the time of a search at each piece would be minutes


def test_the_sample_takes_equal_pages_once_and_no_long_page(spark, monkeypatch):
    monkeypatch.setattr(htmlextract, "LABELLED_CHARS", 50)
    rows = [(k, "u", f"<p>{k % 40}") for k in range(400)] + [(500, "u", "x" * 51), (501, "u", None), (None, "u", "")]
    rows += [(k, "u", "<p>copy") for k in range(600, 900)]
    table = pages_of(spark, rows)
    every = htmlextract.drawn_pages(table, 100)
    assert sorted(every) == sorted({"", "<p>copy", *(f"<p>{k}" for k in range(40))})
    assert htmlextract.drawn_pages(table.repartition(7), 10) == every[:10]
    assert htmlextract.drawn_pages(pages_of(spark, []), 10) == []


def test_repeated_long_and_wide_pages(spark, model):
    long = "<article>" + "<p>A sentence of the article, with words.</p>" * 20_000 + "</article>"
    rows = [(1, "u", long), (1, "u", long), (2, "u", "<article><p>Whole text here.</p></article>")]
    wide = pages_of(spark, rows).selectExpr("'t' as text", "1 as n_chars", "*", "2 as h")
    found = htmlextract.extract(wide, model).collect()
    assert [r.page_id for r in found] == [1, 1, 2] and found[0] == found[1]
    assert found[0].text.count("\n") > 19_000 and found[0].n_chars == len(found[0].text)


@pytest.fixture(scope="module")
def model(spark):
    return htmlextract.fit(spark.read.parquet(f"{SMALL}/pages.parquet"))


def marked_text(html):
    """The article of a page of the given tables, by its markup alone."""
    from html import unescape

    inside = re.search(r"<article>(.*?)</article>", html, re.DOTALL)[1]
    blocks = (" ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside))
    return "\n".join(b for b in blocks if b)


def test_given_pages_text(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    wanted = {r.page_id: (r.url, marked_text(r.html)) for r in pages.collect()}
    found = {r.page_id: (r.url, r.text) for r in htmlextract.extract(pages, model).collect()}
    assert found == wanted


def test_other_layouts(spark, model):
    texts = [b.text for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").limit(50).collect() for b in leaf_blocks(r.html) if len(b.text) > 20]
    draw, wrong, total = random.Random(99), 0, 0
    for _ in range(200):
        blocks, labels = htmlextract.layout(draw, texts)
        wrong += sum(a != b for a, b in zip(model.decode(blocks), labels, strict=True))
        total += len(labels)
    assert wrong < 0.04 * total


def test_viterbi_is_the_best_labelling(model):
    draw = random.Random(4)
    for _ in range(20):
        blocks, _ = htmlextract.layout(draw, ["Some text here.", "x", "Other words follow, then end."])
        blocks = blocks[:9]
        scores = [model.evidence(b, k, len(blocks)) for k, b in enumerate(blocks)]

        def value(labels, scores=scores):
            steps = sum(model.step[a][b] for a, b in zip(labels, labels[1:], strict=False))
            return model.first[labels[0]] + steps + sum(s for s, y in zip(scores, labels, strict=True) if y)

        every = ([code >> k & 1 for k in range(len(blocks))] for code in range(1 << len(blocks)))
        assert value(model.decode(blocks)) == pytest.approx(max(map(value, every)))


def test_null_and_empty_pages(spark, model):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<nav>a</nav>"), (None, "u", "<article><p>Whole &amp; true.</p></article>")]
    found = htmlextract.extract(pages_of(spark, rows), model).collect()
    assert [(r.page_id, r.text, r.n_chars) for r in found][3] == (None, "Whole & true.", 13)
    assert [r.text for r in found][:2] == ["", ""]
    assert htmlextract.extract(pages_of(spark, []), model).count() == 0
    assert htmlextract.fit(pages_of(spark, [])).main_text("<p>x</p>") in ("", "x")


def test_writing_shuffles_a_payload_once(spark):
    rows = pages_of(spark, [(1, "u", "x"), (2, "u", "x"), (2, "u", "x"), (None, "u", "y")]).selectExpr(
        "page_id", "url", "cast(coalesce(html, '') as binary) as payload"
    )
    owners = spark.range(3).selectExpr("sha2(cast(id as string), 256) as key", "nullif(id, 0) as owner")
    payloads = warc.distinct_payloads(rows, owners.hint("merge"))
    plan = payloads._jdf.queryExecution().explainString(payloads._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan)
    by_page = [m for m in moved if "payload" in m and "page_id" in m]
    assert len(by_page) == 1
