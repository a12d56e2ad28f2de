"""Sharding, web archives, page wrappers and the pipeline."""

import base64
import hashlib
import html
import io
import re
import struct
import zlib
from collections import Counter

import pytest
from fixtures import MEDIUM, SMALL, brute_fingerprint, connected, empty_like, odd_documents, pandas

import corpus_pipeline
from assayer.llm import sharding, warc, wrappers
from assayer.sources import scratch_folder

# ---- sharding


def check_rows_law(rows, shards):
    counts = Counter(r.shard for r in rows)
    assert set(counts) <= set(range(shards)) and {r.law for r in rows} <= {"rows"}
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    assert all(r.grown_shard is None for r in rows)


def test_shards_are_even_and_keep_equal_texts_together(spark):
    docs = pandas("documents", MEDIUM)
    rows = sharding.shard(spark.read.parquet(f"{MEDIUM}/documents.parquet")).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs.doc_id)
    check_rows_law(rows, 16)
    text = dict(zip(docs.doc_id, docs.text))
    assert all(r.size == len(text[r.doc_id].encode()) + 1 for r in rows)
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in rows)
    places = {}
    for r in rows:
        places.setdefault(text[r.doc_id], Counter())[r.shard] += 1
    assert sum(sum(c.values()) - max(c.values()) for c in places.values()) == 0


@pytest.mark.parametrize("hot", [0, 200, 600])
def test_a_group_larger_than_a_shard_fills_whole_shards(spark, hot):
    rows = [(i, "same" if i < hot else f"text {i}") for i in range(800)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id bigint, text string"), shards=8).collect()
    check_rows_law(got, 8)
    counts = Counter(r.shard for r in got if r.doc_id < hot)
    # 100 a shard: what does not fill a shard is in one more.
    assert sum(n == 100 for n in counts.values()) == hot // 100 and len(counts) == -(-hot // 100)


def test_moves_are_granted_both_ways():
    moves, returns = sharding._granted({(0, 1): 5, (1, 0): 3, (2, 1): 4}, {1: 3}, 3)
    assert moves == {(0, 1): 5, (1, 0): 3, (2, 1): 1} and returns == {(1, 0): 2, (1, 2): 1}


def test_sharding_odd_rows(spark):
    docs = odd_documents(spark)
    rows = sharding.shard(docs).collect()
    assert len(rows) == docs.count()
    check_rows_law(rows, 16)
    assert {r.size for r in rows if r.doc_id in (3, 4, 5)} == {1} and {r.text_crc32 for r in rows if r.doc_id == 4} == {0}
    assert sharding.shard(empty_like(docs)).count() == 0


# ---- web archives


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, payload string, code string")


def test_archive_round_trip(spark):
    pages = pandas("pages")
    got = {r.page_id: r for r in warc.archive(spark.read.parquet(f"{SMALL}/pages.parquet")).collect()}
    assert len(got) == len(pages)
    for page_id, _, text in pages[["page_id", "url", "html"]].itertuples(index=False):
        raw = text.encode()
        row = got[page_id]
        assert row.payload_bytes == len(raw)
        assert row.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        last = max(pages.page_id[pages.html == text])
        assert (row.record_type, row.refers_to) == (("response", None) if last == page_id else ("revisit", last))


def test_archives_are_read_by_many_tasks(spark, monkeypatch):
    """The number of tasks comes from the bytes, not from the few rows that name the ranges."""
    monkeypatch.setattr(warc, "TASK_BYTES", 10_000)
    found = warc.archive(spark.read.parquet(f"{MEDIUM}/pages.parquet").repartition(16))
    tasks = found.select("page_id").rdd.glom().map(len).collect()
    assert sum(tasks) == len(pandas("pages", MEDIUM)) and sum(n > 0 for n in tasks) >= 5


def test_archive_payloads_and_revisits(spark):
    rows = [
        (1, "http://a.example/1", "<p>same</p>", "x", "y"),
        (9, "http://a.example/9", "<p>same</p>", "x", "y"),
        (5, "http://b.example/\r\nX: 1", "<p>same</p>", "x", "y"),
        (2, None, None, None, None),
        (3, "", "", "x", "y"),
        (None, "http://c.example/", "<p>same</p>", "x", "y"),
        (4, "u", "é\r\n\r\n" * 50_000, "x", "y"),
        (9, "http://a.example/9", "<p>same</p>", "x", "y"),
    ]
    folder = "file://" + scratch_folder(spark, "test").removeprefix("file:")
    packages = warc.write(warc.prepared(pages_of(spark, rows)), folder)
    got = warc.read(packages, payloads=True).collect()
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in got)
    assert kinds == [
        (0, "revisit", 9, 11),
        (1, "revisit", 9, 11),
        (2, "revisit", 3, 0),
        (3, "response", None, 0),
        (4, "response", None, 300_000),
        (5, "revisit", 9, 11),
        (9, "response", None, 11),
        (9, "response", None, 11),
    ]
    assert {bytes(r.payload).decode() for r in got if r.record_type == "response"} == {"<p>same</p>", "", rows[6][2]}
    long = warc.prepared(pages_of(spark, rows), least=12).filter("refers_to is not null")
    assert long.count() == 0
    assert warc.archive(pages_of(spark, rows).limit(0)).count() == 0


def test_packages_are_ranges(tmp_path):
    path = tmp_path / "one.wacz"
    with open(path, "wb") as stream:
        package = warc.Package(stream)
        for i in range(300):
            package.add(warc.record(i, "u", b"x" * i, base64.b32encode(hashlib.sha1(b"x" * i).digest()).decode(), None), i)
        package.close()
    with open(path, "rb") as file:
        parts = list(warc.ranges(file, path.stat().st_size))
        pages = []
        for start, size, lengths in parts:
            data = warc._fetch(file, start, size)
            for n in lengths:
                pages.append(warc.parse(data[:n])["page_id"])
                data = data[n:]
    assert pages == list(range(300))


def test_zip64_directory():
    """A package whose directory is in ZIP64 form: sizes and offsets stand in the extra fields."""
    body = b"record"
    local = b"PK\x03\x04" + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, 20)
    local += b"a" + struct.pack("<HHQQ", 1, 16, len(body), len(body))
    extra = struct.pack("<HHQQQ", 1, 24, len(body), len(body), 0)
    central = b"PK\x01\x02" + struct.pack("<HHHHHHIII", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF)
    central += struct.pack("<HHHHHII", 1, len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + b"a" + extra
    at = len(local) + len(body)
    end = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(central), at)
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, at + len(central), 1)
    last = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    whole = local + body + central + end + locator + last
    (member,) = warc.members(io.BytesIO(whole), len(whole))
    assert member.name == "a" and whole[member.start : member.start + member.size] == body
    with pytest.raises(ValueError):
        warc.members(io.BytesIO(b"no package" * 10), 100)


def test_damage_is_seen():
    whole = warc.record(1, "u", b"abc", base64.b32encode(hashlib.sha1(b"abd").digest()).decode(), None)
    with pytest.raises(ValueError):
        warc.parse(whole)


# ---- wrappers


def plain_article(page):
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
    blocks = (html.unescape(re.sub("<[^>]*>", "", b)) for b in re.split("</?(?:p|h1|br)>", inner))
    return " ".join(x for x in (" ".join(b.split()) for b in blocks) if x)


def test_text_of_all_pages(spark):
    pages = pandas("pages", MEDIUM)
    got = {r.page_id: r for r in wrappers.main_text(spark.read.parquet(f"{MEDIUM}/pages.parquet")).collect()}
    assert len(got) == len(pages)
    for page_id, page in zip(pages.page_id, pages.html):
        assert got[page_id].text == plain_article(page) and got[page_id].n_chars == len(got[page_id].text)


def page(i, extra=""):
    items = "".join(f"<li><a href=/{i}{k}>m{k}</a></li>" for k in range(2 + i % 3))
    return (
        f"<html><body><div class=top><ul>{items}</ul></div><div class=wide><p>Our site is best.</p>"
        f"<div class='story'><h2>T{i}</h2><p>text {i} one&nbsp;two</p>{extra}<p>b<b>o</b>ld {i}</p></div></div>"
        f"<div id=comments><p>reader {i}</p></div><p>All about us</p></body></html>"
    )


def test_wrapper_has_slots_options_and_repeats():
    wrapper = wrappers.infer([page(0), page(1, "<div class=ad>buy</div>"), page(2), page(3)])
    expression = wrapper.expression()
    assert "(<li><a>#text</a></li>)+" in expression and "(<div.ad>buy</div>)?" in expression
    assert "<h2>#text</h2>" in expression and "Our site is best." in expression
    assert wrappers.decided(wrapper, 4)["container"] == "div.story"


def test_wrapper_sets_the_template_aside(spark):
    rows = [(i, f"http://h.example/{i}", page(i, "<div class=ad>buy</div>" if i % 2 else "")) for i in range(8)]
    rows += [(100, None, None), (101, "http://other.example/", ""), (102, "nonsense", "just &amp; text"), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in wrappers.main_text(df.selectExpr("*", "'x' as host", "'y' as same")).collect()}
    assert all(got[i] == f"T{i} text {i} one two bold {i}" for i in range(8))
    assert got[100] == got[101] == got[None] == "" and got[102] == "just & text"
    assert wrappers.main_text(df.limit(0)).count() == 0


def test_two_templates_of_one_host(spark):
    """Neither has an article element; each is read by the wrapper of its own template."""

    def shop(i):
        return (
            f"<html><body><table class=frame><tr><td class=left><p>Contact us by mail</p></td><td class=mid><div class=text>"
            f"<h1>Offer {i}</h1><p>long words of offer {i}</p></div></td></tr></table><section class=end>Imprint of site</section></body></html>"
        )

    rows = [(i, f"http://h.example/{i}", page(i) if i % 2 else shop(i)) for i in range(24)]
    long = page(99).replace("text 99", "text 99 " + "and " * 40_000)
    rows += [(99, "http://long.example/", long)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in wrappers.main_text(df).collect()}
    for i in range(24):
        assert got[i] == (f"T{i} text {i} one two bold {i}" if i % 2 else f"Offer {i} long words of offer {i}")
    assert got[99].startswith("T99 text 99 and and") and got[99].endswith("bold 99")
    # Without the wrappers what stands around would be read too.
    assert "Our site is best." in wrappers.extract(rows[1][2]) and "Imprint" in wrappers.extract(rows[0][2])


def notice(i, extra=""):
    return (
        f"<html><body><section class=bar><p>All our notices by date and place</p></section><table class=sheet><tr><td class=cell>"
        f"<h1>Notice {i}</h1><p>words of notice {i}</p>{extra}</td></tr></table><section class=end><p>Printed by the town</p></section></body></html>"
    )


def test_templates_come_from_all_pages(spark):
    """A template on few of a host's pages, or on long ones only, is inferred as well; one odd page changes nothing."""
    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(300)]
    rows[7] = (7, "http://h.example/7", page(7).replace("All about us", "All about them"))
    rows += [(1000 + i, f"http://h.example/n{i}", notice(i)) for i in range(5)]
    long = "<p>" + "and " * 30_000 + "</p>"
    rows += [(2000 + i, f"http://long.example/{i}", notice(i, long)) for i in range(5)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in wrappers.main_text(df).collect()}
    assert len(got) == len(rows)
    assert all(got[i] == f"T{i} text {i} one two bold {i}" for i in range(300))
    assert all(got[1000 + i] == f"Notice {i} words of notice {i}" for i in range(5))
    assert all(got[2000 + i] == f"Notice {i} words of notice {i} " + ("and " * 30_000).strip() for i in range(5))
    found = {(r.host, r.template): r for r in wrappers.infer_hosts(df.repartition(3)).collect()}
    assert sorted(r.pages for r in found.values()) == [5, 5, 300]
    again = wrappers.infer_hosts(df.repartition(7)).collect()  # the same, however the pages are stored
    assert {(r.host, r.template): r for r in again} == found


def test_wrappers_of_parts_are_aligned_like_pages():
    pages = [page(i, "<div class=ad>buy</div>" if i % 3 else "") for i in range(12)]
    sent = [wrappers.packed(wrappers.infer(pages[i : i + 4])) for i in (0, 4, 8)]
    parts = [wrappers.unpacked(text) for text in sent]
    assert [wrappers.packed(p) for p in parts] == sent
    whole = wrappers.merged(wrappers.merged(parts[0], parts[1]), parts[2])
    assert whole.expression() == wrappers.infer(pages).expression()
    assert wrappers.decided(whole, 12) == wrappers.decided(wrappers.infer(pages), 12)


def test_wrapper_does_not_grow_with_its_pages():
    """Classes that name their page, and blocks in any order, still leave the container and the template's texts."""

    def blog(i):
        blocks = "".join(f"<{b} class=b{i}x{k}>word {i}</{b}><p>some {k}</p>" for k, b in enumerate(("h2", "pre", "ul", "i")[i % 4 :]))
        return f"<body><div class=top><p>Our site</p></div><div class=text><h1>T {i}</h1>{blocks}</div><div class=low>Imprint</div>"

    def size(node):
        return 1 + sum(map(size, node.children))

    few, many = wrappers.infer([blog(i) for i in range(100)]), wrappers.infer([blog(i) for i in range(600)])
    assert max(size(few), size(many)) < 400 and ")*" in many.expression()
    assert wrappers.decided(many, 600) == {"container": "div.text", "same": ["Our site", "Imprint"]}


def test_templates_are_looked_up_like_all_are_compared():
    rows = [["h", " ".join(sorted({f"div.c{(i * k) % 11}" for k in range(1, 2 + i % 7)})), i] for i in range(1, 60)]
    rows += [["h", "", 1], ["i", "", 1]]
    templates, expected = {}, []
    for name, outline, pages in rows:
        own = frozenset(outline.split())
        near = max((t for n, t in templates if n == name), key=lambda t: (wrappers.likeness(frozenset(t.split()), own), t), default=None)
        if near is None or wrappers.likeness(frozenset(near.split()), own) < wrappers.ALIKE:
            templates[name, near := outline] = None
        expected.append((name, pages, outline, near))
    assert list(wrappers.like_templates(iter(rows))) == expected and 5 < len(templates) < 50


def test_names_and_marks_set_aside():
    text = (
        "<body><header><h1>Site</h1></header><nav>n</nav><main><article><header><h1>T &lt;x&gt;</h1></header><p>one <i>tw</i>o"
        "<p>three<aside>side</aside><div class='cookie-notice'>ok</div><ul><li>a<li>b</ul><form>f</form>"
        "<script>if (a < b) '</p>'</script><style>p{}</style><section id=comments><article>c</article></section>"
        "</article></main><footer>end</footer>"
    )
    assert wrappers.extract(text) == "T <x> one two three a b"
    assert wrappers.extract("<div hidden>no</div>yes<br>1 < 2") == "yes 1 < 2"
    shell = "<div class='page has-sidebar'><div class=menu>m</div><article class='post comments-open'>{}</article></div>"
    inner = "<p>one</p><div class=sidebar>s</div><article class=comment>c</article>"
    assert wrappers.extract(shell.format(inner)) == "one"


def test_names_inside_an_article_are_whole_names():
    """Ids and classes that name a subject keep their text; whole names of containers set aside."""
    kept = (
        "<h2 id='related-work'>Related work</h2><p class='copyright-law'>On copyright</p><div id='search-results'>Results</div>"
        "<section id='legal-status' class='status-of-cookies'><p>Legal</p></section><h3 id='comment-on-method' class=notice>Method</h3>"
        "<div class='notice-of-failure'>failure</div><ul id=menu-of-the-day><li>soup</ul><div class='entry-content form-factor'>form</div>"
        "<section id=related><p>is text</p></section>"
    )
    gone = (
        "<div class='share-buttons'>s</div><div class='ad'>a</div><div role=navigation>n</div><ul class='menu-list'><li>m</ul>"
        "<section id=comments><p>c</p></section><div id='disqus_thread'>d</div><aside>e</aside><div class='x cookie-notice'>k</div>"
        "<div class='comment-list'>z</div>"
    )
    text = "Related work On copyright Results Legal Method failure soup form is text rest"
    assert wrappers.extract(f"<body><article>{kept}{gone}<p>rest</p></article>") == text


def test_text_of_equal_very_long_and_repeated_pages(spark):
    """Repeated rows are read each; a page of millions of characters is read whole."""
    long = "<article>" + "<h2>a b</h2><p>word &amp; word</p>" * 60_000 + "</article>"
    rows = [(1, "http://a.example/", long), (1, "http://a.example/", long), (2, "http://a.example/", "<article>x</article>")]
    found = wrappers.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert sorted((r.page_id, r.n_chars) for r in found) == [(1, 60_000 * 16 - 1)] * 2 + [(2, 1)]


def test_broken_pages_take_no_long_time():
    for text in ("<div a='" * 20_000, "<div>" * 20_000, "<p><b>x" * 20_000, "<" * 50_000, "<!--" * 20_000, "</p>" * 20_000):
        wrappers.extract(text)
    wrappers.infer(["<div>" * 3000 + "x"] * 3)


# ---- pipeline


def test_stages_return_documents(spark):
    docs = odd_documents(spark)
    *middle, last = corpus_pipeline.STAGES
    for table in (docs, empty_like(docs)):
        for name, stage in middle:
            found = stage(spark, table, SMALL)
            assert found.columns == docs.columns, name
            assert found.count() <= table.count() or name == "mixture"
        assert last[1](spark, table, SMALL).count() == table.count()


def test_pipeline_against_its_stages(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    text = dict(zip(pandas("documents").doc_id, pandas("documents").text))
    good = sorted(r.doc_id for r in corpus_pipeline.good_quality(spark, docs, SMALL).collect())
    codes = {i: brute_fingerprint(text[i]) for i in good}
    links = [(a, b) for a in good for b in good if a < b and bin(codes[a] ^ codes[b]).count("1") <= 3]
    left = {i for i, c in connected(good, links).items() if i == c}
    kept = docs.filter(docs.doc_id.isin(good))
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, kept, SMALL).collect()} == left
    items = pandas("benchmark")
    bench = {w for t in items.text for w in corpus_pipeline.decontaminate.windows(corpus_pipeline.decontaminate.words(t))}
    joined = {i: b" " + b" ".join(corpus_pipeline.decontaminate.words(text[i])) + b" " for i in left}
    clean = {i for i in left if not any(b" " + w + b" " in joined[i] for w in bench)}
    mixture = corpus_pipeline.mixture(spark, docs.filter(docs.doc_id.isin([int(i) for i in clean])), SMALL)
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in mixture.collect()) and len(rows) > 0
    check_rows_law(rows, 16)
