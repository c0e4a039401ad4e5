"""Extraction, URL filters, archives."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from fitledger.llm import archive, extraction
from fitledger.llm.labelled_pages import labelled_pages
from fitledger.llm.queries import QUERIES, URL_RULES
from fitledger.llm.url_rules import judge_urls

PAGES = "page_id long, url string, html string, text string, host string"


@pytest.fixture(scope="module")
def model():
    return extraction.fit_extraction()


def test_blocks_of_broken_markup():
    blocks = extraction.leaf_blocks(
        "a &lt;b&gt;  c<p>one<b>two</b>\n x<p>three<br>four<!-- no --><script>if (a<b) '</p>'</script>"
        "<ul><li>x<li>y</ul><textarea>no</textarea>1 < 2 &am &unknown; &amp<div title='a>b'>last</div><p class=\"x")
    assert [b.text for b in blocks] == [
        "a <b> c", "onetwo x", "three four", "x", "y", "1 < 2 &am &unknown; &", "last"]
    assert extraction.leaf_blocks("<p>" * 3000 + "x")[0].text == "x"
    assert extraction.leaf_blocks("<") == [] or extraction.leaf_blocks("<")[0].text == "<"


def test_held_out_layouts(model):
    right = total = 0
    for page, main in labelled_pages(100, seed=77):
        blocks = extraction.leaf_blocks(page)
        labels = extraction.viterbi(model, model.scores(extraction.features(blocks)))
        right += sum(int(b.text in main) == y for b, y in zip(blocks, labels))
        total += len(blocks)
    assert right / total > 0.97


def test_viterbi_and_marginals_against_all_labellings(model):
    import itertools
    import math

    scores = [0.3, -1.2, 2.0, -0.4]

    def weight(labels):
        return (model.ends[0][labels[0]] + model.ends[1][labels[-1]] + sum(s for s, y in zip(scores, labels) if y)
                + sum(model.moves[x][y] for x, y in zip(labels, labels[1:])))

    every = list(itertools.product((0, 1), repeat=4))
    assert extraction.viterbi(model, scores) == list(max(every, key=weight))
    total = sum(math.exp(weight(y)) for y in every)
    main, _ = extraction.marginals(model, scores)
    for i in range(4):
        assert main[i] == pytest.approx(sum(math.exp(weight(y)) for y in every if y[i]) / total)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_main_texts_against_an_independent_reading(spark, sf):
    """Every page of the table: the blocks of its article element, found without the operator's reader or model."""
    import html
    import re

    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").select("page_id", "html").collect()
    got = {r.page_id: r for r in QUERIES["op1_main_texts"](spark, f"/root/testdata/{sf}").collect()}
    assert len(got) == len(pages)
    for page in pages:
        body = re.search("<article>(.*?)(?:</article>|$)", page.html, re.DOTALL)
        parts = re.split("</?(?:p|h1)>", body[1]) if body else []
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " " if "<br" in part else "", part)).split()) for part in parts]
        expected = "\n\n".join(b for b in blocks if b)
        assert got[page.page_id].text == expected, page.page_id
        assert got[page.page_id].n_chars == len(expected)


def test_memory_of_deep_markup(model):
    """100,000 open elements with names of their own: time and memory grow with the page, not with its square."""
    import time
    import tracemalloc

    page = "".join(f'<div class="n{chr(97 + k % 26)} k{k}"><b>w{k} ' for k in range(50_000)) + "<p>Some words at the end.</p>"
    weights, start = model.ancestor_weights(), time.time()
    tracemalloc.start()
    text = extraction.main_text(model, page, weights)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert isinstance(text, str) and peak < 400 << 20 and time.time() - start < 60
    # Ends of elements far down in a deep chain.
    extraction.main_text(model, "<a>" * 30_000 + "<b>" * 30_000 + "</a>" * 30_000 + "<li><i>" * 30_000 + "x", weights)


def test_running_weights_are_those_of_the_sets(model):
    weights = model.ancestor_weights()
    for page, _ in labelled_pages(40, seed=5):
        whole, summed = extraction.leaf_blocks(page), extraction.leaf_blocks(page, weights)
        assert [b.text for b in whole] == [b.text for b in summed]
        for a, b in zip(whole, summed):
            assert b.weight == sum(weights.get(key, 0) for key in a.above)


def test_extraction_of_odd_rows(spark, model):
    page = "<nav><a href=/>Menu item</a></nav><article><h1>Title here</h1><p>Some words &amp; more.</p></article>"
    rows = [(1, None, None, "clash", "h"), (2, "u", "", None, None), (None, "u", page, None, None),
            (None, "u", page, None, None), (3, "u", "<article>" + "<p>word word.</p>" * 20_000, None, None)]
    got = extraction.extract_main_text(spark.createDataFrame(rows, PAGES), model).collect()
    texts = {r.page_id: r.text for r in got}
    assert len(got) == 5 and texts[1] == texts[2] == ""
    assert texts[None] == "Title here\n\nSome words & more."
    assert texts[3].count("word word.") == 20_000
    assert all(r.n_chars == len(r.text) for r in got)
    assert extraction.extract_main_text(spark.createDataFrame([], PAGES), model).count() == 0


def _brute(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return (host, path) + ((best[3], best[4]) if best else (None, "allow"))


def test_url_rules_against_brute_force(spark):
    rules = URL_RULES + [("a.b.net", "/es/x", "allow"), ("b.net", "/es/xy", "block"), ("com", "/", "allow"),
                         ("dup.org", "/", "allow"), ("dup.org", "/", "block"), ("org", "", "allow")]
    urls = [None, "", "no scheme", "http://", "https://EXAMPLE.com/en/1?q=/es/", "http://www.example.com/en/",
            "http://notexample.com/en/", "http://x.net/es/", "http://net/fr/a#b", "http://net/fr", "http://a.b.net/es/xyz",
            "http://c.b.net/es/xyz", "http://É.NET/es/ü", "http://com", "http://com?/", "a://b://c.net/es/",
            "http://dup.org/", "http://org", "http://x.org#y", "http://" + "a." * 5000 + "net/es/" + "z" * 10_000, "x" * 100_000]
    rows = [(i, u, None, "clash", "clash") for i, u in enumerate(urls)] + [(None, "http://x.net/es/", None, None, None)] * 2
    pages = spark.createDataFrame(rows, PAGES)
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = judge_urls(pages, table).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: tuple(r)[1:] for r in got}
    for i, u, *_ in rows:
        assert by_id[i] == _brute(u, rules), u
    assert {r.verdict for r in judge_urls(pages, table.limit(0)).collect()} == {"allow"}
    assert judge_urls(pages.limit(0), table).count() == 0


def test_url_plan_is_native(spark, tmp_path):
    plan = QUERIES["op2_url_filters"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    for word in ("Python", "Arrow", "Cartesian", "NestedLoop"):
        assert word not in plan


def _round_trip(spark, rows, folder, **options):
    records = archive.with_revisits(spark.createDataFrame(rows, PAGES), **options)
    from fitledger.session import saved_table
    manifest = saved_table(archive.write_archives(records, f"file://{folder}", package_bytes=200), "test-manifest")
    return archive.read_archives(manifest), manifest


def test_archives_round_trip(spark, tmp_path):
    page = "<p>ü\r\n\r\nx</p>"
    rows = [(5, "http://a/\n b", page, None, None), (3, None, page, None, None), (3, "u", page, None, None),
            (7, "u", None, None, None), (8, "u", "", None, None), (9, "u", "y" * 300_000, None, None),
            (None, "u", page, None, None), (None, "u", "only null", None, None), (None, "u", "only null", None, None)]
    got, manifest = _round_trip(spark, rows, tmp_path)
    found = sorted(((r.record_id, r.record_type, r.refers_to, r.payload_bytes, bytes(r.payload)) for r in got.collect()), key=str)
    n = len(page.encode())
    expected = sorted([
        ("urn:page:5", "revisit", "urn:page:3", n, b""), ("urn:page:3", "response", None, n, page.encode()),
        ("urn:page:3", "response", None, n, page.encode()), ("urn:page:7", "response", None, 0, b""),
        ("urn:page:8", "revisit", "urn:page:7", 0, b""), ("urn:page:9", "response", None, 300_000, b"y" * 300_000),
        ("urn:page:", "revisit", "urn:page:3", n, b""), ("urn:page:", "response", None, 9, b"only null"),
        ("urn:page:", "response", None, 9, b"only null")], key=str)
    assert found == expected
    assert manifest.agg(F.sum("n_records")).first()[0] == len(rows)
    assert {r.record_type for r in _round_trip(spark, rows, tmp_path, min_bytes=10**6)[0].collect()} == {"response"}
    assert _round_trip(spark, [], tmp_path)[0].count() == 0


@pytest.mark.parametrize("wide", [False, True])
def test_directories_against_zipfile(wide, monkeypatch):
    if wide:    # every size and place goes to the ZIP64 fields
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 1)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as package:
        for k in range(5):
            package.writestr(f"dir/{k}é", b"x" * (100 * k))
        package.comment = b"a comment"
    raw = out.getvalue()
    found = archive.members(lambda at, n: raw[at:at + n], len(raw))
    assert {n: s for n, (_, _, s) in found.items()} == {f"dir/{k}é": 100 * k for k in range(5)}
    for k in range(5):
        _, at, n = found[f"dir/{k}é"]
        assert raw[at:at + n] == b"x" * (100 * k)
