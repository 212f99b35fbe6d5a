"""Operators on tables: similarity join, HTML, packing, URL filter, sharding, WARC, the pipeline."""

import gzip
import io
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_rows import ODD, PROSE, frame
from tickerlake.llm import html_template, ngram_join, packing, sharding, urlfilter, warc
from tickerlake.llm.common import words
from tickerlake.llm.components import components
from tickerlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"

# similarity join


def brute_classes(texts):
    sets = []
    for t in texts:
        w = words(t)
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else None)
    parent, degree = list(range(len(texts))), Counter()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a + 1, len(texts)):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                degree[a] += 1
                degree[b] += 1
                u, v = sorted((find(a), find(b)))
                parent[v] = u
    return [(find(i), degree[i]) for i in range(len(texts))]


@pytest.mark.parametrize("block", [ngram_join.BLOCK, 7])
def test_similarity_classes_equal_brute_force(spark, block):
    rng = np.random.default_rng(2)
    base = [f"word{i}" for i in rng.integers(0, 500, 120)]
    near = []
    for _ in range(40):  # a large group of near copies, some of them a chain
        w = list(base)
        for _ in range(rng.integers(0, 4)):
            w[rng.integers(0, len(w))] = f"new{rng.integers(0, 99)}"
        near.append(" ".join(w))
    texts = ODD + near + near[:5] + [" ".join(f"q{i}" for i in rng.integers(0, 99, 30)) for _ in range(10)]
    docs = frame(spark, texts).withColumnsRenamed({"source": "class_id", "lang": "digest"})
    got = ngram_join.similarity_classes(docs, block=block).orderBy("doc_id").collect()
    expected = brute_classes(texts)
    assert [(r.class_id, r.n_links) for r in got] == expected
    kept = ngram_join.one_per_class(docs, block=block)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c, _ in expected})


def test_similarity_null_ids_and_repeats(spark):
    rows = [(None, PROSE), (None, PROSE), (3, PROSE), (3, PROSE), (None, None), (5, "x y"), (5, "x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in ngram_join.one_per_class(docs).collect()]
    assert sorted(kept, key=str) == [(3, PROSE), (5, "x y"), (None, None)]
    got = Counter((r.class_id, r.n_links) for r in ngram_join.similarity_classes(docs).collect())
    assert got == {(3, 3): 4, (5, 1): 2, (None, 0): 1}
    assert ngram_join.similarity_classes(docs.limit(0)).count() == 0
    assert ngram_join.one_per_class(docs.limit(0)).count() == 0


def test_pruning_bound_and_components(spark):
    needed = ngram_join.least_matches()
    assert list(needed) == [16, 32, 48, 64] and all(0.4 * n < needed[n] + 6 < 0.8 * n + 6 for n in needed)
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(1000, 1040)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(60):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label


# HTML


def page(body, head="<title>t</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def test_main_text_rules():
    body = ('<header><h1>Site</h1></header><div class="sidebar"><p>side</p></div><nav><ul><li><a href="/">home</a></ul></nav>'
            '<article><h1>A &amp; B</h1><p>Hello <b>wor</b>ld,\n  again&nbsp;now<p class="notice">cookies<p>line<br/>next<form><input>go</form>'
            '<div class="ad-box">buy</div><section id="comments"><p>first!</p></section></article><aside>x</aside>'
            '<script>if (a<b) document.write("<p>no</p>")</script><style>p{}</style><!-- <p>no</p> --><footer>&copy; me</footer>')
    assert html_template.main_text(page(body), None) == "A & B\nHello world, again now\nline\nnext"
    assert html_template.main_text("", None) == "" and html_template.main_text("<p>a &lt; b <", None) == "a < b <"


def test_listed_names_do_not_hide_the_page():
    body = '<div class="menu">m</div>{}<div class="comments"><article><p>first</p></article></div><div class="sidebar">s</div>'
    for inner in ('<article class="post no-comments"><p>text</p></article>', '<div class="layout right-sidebar"><main id="main"><p>text</p></main></div>',
                  '<main class="with-sidebar"><p>text</p><div class="share">x</div></main>'):
        whole = page(body.format(inner)).replace("<html", '<html class="menu-open"').replace("<body", '<body class="has-sidebar"')
        assert html_template.main_text(whole, None) == "text"
    lone = page('<div class="layout right-sidebar"><div class="nav">n</div><article><p>text</p><div class="ad">a</div></article></div>')
    assert html_template.main_text(lone, None) == "text"


def test_template_finds_main_slot_without_article(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(12):
        text = " ".join(f"w{k}" for k in rng.integers(0, 1000, 60))
        rows.append((i, f"http://Blog.example.com/{i}", page(f'<div id="top"><a href="/">Home</a> <a href="/x">Next</a></div><div id="body{i}"><p>{text}</p></div><div id="end">short</div>')))
    pages = spark.createDataFrame([*rows, (12, None, None), (13, "http://x/", ""), (13, "http://x/", "")], "page_id long, url string, html string")
    got = html_template.extract(pages.withColumn("text", F.lit("clash"))).orderBy("page_id").collect()
    assert [r.text for r in got[:12]] == [re.search("<p>(.*)</p>", r[2])[1] for r in rows]
    assert [(r.text, r.n_chars) for r in got[12:]] == [("", 0)] * 3
    assert html_template.extract(pages.limit(0)).count() == 0


def test_equivalence_classes_nest():
    def token(t, pages, vector, chars, variants=9, linked=0, noise=0):
        return t, pages, noise, vector, vector, variants, 9, chars, linked

    found = [token("", 9, 7, 900), token(">html", 9, 7, 900), token(">html>body", 9, 7, 900), token(">html>body>div.x/h1", 9, 8, 400),
             token(">html>body>div.same/#", 9, 8, 400, variants=1), token(">html>body>ul", 6, 5, 100, linked=100),
             token(">html>body>div.x/h1>div.tags/#", 6, 6, 20, noise=html_template.NAMED),
             token(">html>body>div.x/h1>div.side-story/#", 6, 6, 200, noise=html_template.NAMED), token(">lost>div", 9, 4, 990)]
    got = {t["token"]: t for t in html_template.deduced(found)}
    assert got[">html"]["class"] == got[">html>body"]["class"] != got[">html>body>ul"]["class"] and ">lost>div" not in got
    assert [t for t in got if got[t]["main"]] == [">html>body>div.x/h1"]  # as long as its neighbour, which repeats
    assert [t for t in got if got[t]["drop"]] == [">html>body>div.x/h1>div.tags/#"]  # a small named part, not a large one


def neutral(html):
    """The page without names: every sectioning element is a div, without classes, ids and roles."""
    return re.sub(r' (class|id|role)="[^"]*"', "", re.sub(r"<(/?)(nav|article|footer|aside|header|main|section|form)\b", r"<\1div", html))


def test_template_decides(spark):
    """Without names the template finds the text of nine pages in ten and more; without a template no page comes out right."""
    expected = {r.page_id: r.text for r in QUERIES["op4_html_text"](spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = [(r.page_id, r.url, neutral(r.html)) for r in pages.collect()]
    got = html_template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert np.mean([r.text == expected[r.page_id] for r in got]) >= 0.9
    assert not any(html_template.main_text(r.html, []) == expected[r.page_id] for r in pages.collect())


def test_names_do_not_lose_the_article():
    body = "<article><div class='related-work'><p>content</p></div><p id='search-trees'>body</p></article>"
    assert html_template.main_text(page(body), None) == "content\nbody"


def test_very_long_page_and_other_layout(spark):
    words = " ".join(f"w{i}" for i in range(200_000))
    rows = [(i, "http://h/x", page(f"<div><a href='/'>home page</a></div><div><h1>t{i}</h1><p>text of {i} goes on here</p></div>")) for i in range(8)]
    rows += [(8, "http://h/x", page(f"<div><a href='/'>home page</a></div><div><h1>t8</h1><p>{words}</p></div>")),
             (9, "http://h/x", page("<table><tr><td>another layout altogether</table><ul><li><a href='/'>x</a></ul>"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_template.extract(pages).collect()}
    assert got[3] == "t3\ntext of 3 goes on here" and got[8] == f"t8\n{words}" and got[9] == "another layout altogether"


def test_articles_of_test_pages(spark):
    import html as entities

    rows = spark.read.parquet(f"{SF}/pages.parquet")
    source = {r.page_id: r.html for r in rows.collect()}
    for r in QUERIES["op4_html_text"](spark, SF).collect():
        article = re.search(r"(?s)<article>(.*?)</article>", source[r.page_id])[1]
        blocks = [" ".join(entities.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


# packing


def test_hilbert_curve_visits_neighbours():
    side = 8
    cells = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    keys = packing.hilbert_keys(cells, 3)
    assert sorted(keys.tolist()) == list(range(side**3))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_packing_is_complete(spark):
    from tickerlake.llm.tokens import BpeIds

    rows = [(i, t) for i, t in enumerate(ODD)] + [(6, PROSE), (None, "a"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    pieces = packing.pack(docs, length=64).collect()
    encode = BpeIds()
    expected = Counter((i, tuple([*np.frombuffer(encode(t), "<u2").tolist(), 1])) for i, t in rows)
    by_sequence = defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length > 0 and zlib.crc32(p.ids) == p.ids_crc32
        by_sequence[p.sequence_id].append(p)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    line = []
    for k in sorted(by_sequence):
        at = 0
        for p in sorted(by_sequence[k], key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
            line.append(p)
        assert at == 64 or k == len(by_sequence) - 1
    got, open_piece = Counter(), []
    for p in line:  # a document's pieces follow one another
        assert p.start == sum(len(x) for x in open_piece)
        open_piece.append(np.frombuffer(p.ids, "<u4").tolist())
        if p.start + p.length == p.doc_tokens:
            got[p.doc_id, tuple(sum(open_piece, []))] += 1
            open_piece = []
    assert got == expected
    assert packing.pack(docs.limit(0)).count() == 0


# URL filter


def brute_rule(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(r), r, v) for r, v in rules for h, p in [(r.split("/", 1)[0], "/" + r.split("/", 1)[1])]
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fits)[1:]) if fits else (host, path, None, None)


RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
URLS = [None, "", "nothing", "http://A.Example.NET/en/1?x=/de/", "https://example.net", "http://net/", "http://xnet/", "ftp://b.org/fr/?a#b", "http://b.org/frx",
        "http://u@c.example.com:80/de/", "http://example.com/de/", "http://example.com/d", "http://h?p/", "http://é.example.net/en/" + "x" * 5000, "http://a.net/en/\n2"]


@pytest.mark.parametrize("block", [urlfilter.RULES_PER_BLOCK, 1])
def test_rules_equal_brute_force(spark, block):
    urls = spark.createDataFrame([(i, u, "z") for i, u in enumerate(URLS)], "page_id long, url string, rule string").drop("rule")
    host, path = urlfilter.host_and_path(F.col("url"))
    rules = spark.createDataFrame([*RULES, (None, "block"), ("x/", None), ("net/", "block")], "rule string, verdict string")
    got = urlfilter.with_rules(urls.withColumns({"host": host, "path": path}), rules, block).orderBy("page_id").collect()
    assert [(r.host, r.path, r.best and r.best.rule, r.best and r.best.verdict) for r in got] == [brute_rule(u, RULES) for u in URLS]


def test_trees_learn_lexical_signs(spark):
    good = [f"http://site{i}.example.com/en/{i}" for i in range(60)]
    bad = [f"http://x-{i}-{i * 7919}.spam.test/{i}{i}/a/b/c?u={i}&v={i}&w=1" for i in range(60)]
    labelled = spark.createDataFrame([(u, 0) for u in good] + [(u, 1) for u in bad] + [(None, 1), ("http://q/", None)], "url string, label int")
    urls = spark.createDataFrame([(i, u, "c") for i, u in enumerate(URLS + good[:5] + bad[:5])], "page_id long, url string, verdict string")
    got = urlfilter.judge(urls, spark.createDataFrame(RULES, "rule string, verdict string"), labelled).orderBy("page_id").collect()
    assert len(got) == len(URLS) + 10 and {r.verdict for r in got} == {"allow", "block"}
    assert [r.verdict for r in got[-10:]] == ["allow"] * 5 + ["block"] * 5
    assert all(r.verdict == dict(RULES)[r.rule] for r in got if r.rule)
    none = urlfilter.judge(urls, spark.createDataFrame([], "rule string, verdict string"), labelled.limit(0))
    assert {r.verdict for r in none.collect()} == {"allow"} and none.limit(0).count() == 0


def test_suffix_shares_cover_all_labelled_urls_and_no_class_is_left_out(spark):
    rows = [(f"http://d{i % 6000}.test/{i}", int(i % 6000 < 20)) for i in range(12_000)] + [("http://hot.example/", 0)] * 9000
    labelled = spark.createDataFrame(rows, "url string, label int")
    fitted = urlfilter.fit(labelled, size=50)
    assert fitted.model is not None
    urls = spark.createDataFrame([(i, u) for i, u in enumerate(sorted({u for u, _ in rows} | {"http://new.domain/", ""}))], "page_id long, url string")
    got = urlfilter.with_features(urls, fitted.statistics).collect()
    overall, blocked, n = sum(y for _, y in rows) / len(rows), Counter(), Counter()
    for u, y in rows:
        host = u.split("/")[2]
        for s in (host, (host.split(".")[-1],)):
            blocked[s] += y
            n[s] += 1
    share = {s: (blocked[s] + urlfilter.PRIOR * overall) / (n[s] + urlfilter.PRIOR) for s in n}
    assert len(got) == urls.count() and len(share) > 4096
    for r in got:
        host = r.url.split("/")[2] if r.url else ""
        assert abs(r.f_suffix1 - share.get((host.split(".")[-1],), -1)) < 1e-12 and abs(r.f_suffix2 - share.get(host, -1)) < 1e-12
    sample = urlfilter._sample(labelled.withColumn("label", F.col("label").cast("double")), {0.0: 20_960, 1.0: 40}, 50).collect()
    assert sum(r.label for r in sample) == 40 and 800 < len(sample) - 40 < 1200
    assert 380 < sum(r.url == "http://hot.example/" for r in sample) < 480


def test_entropy_feature(spark):
    row = urlfilter.with_features(spark.createDataFrame([("http://ab/?x=1&y=22",)], "url string"), []).first()
    share = np.array(list(Counter("http://ab/?x=1&y=22").values())) / 19
    assert abs(row.f_entropy + (share * np.log2(share)).sum()) < 1e-9 and row.f_params == 2 and abs(row.f_digits - 3 / 19) < 1e-9


# sharding


def test_sharding_law_and_places(spark):
    rng = np.random.default_rng(6)
    texts = ODD + ["y" * int(n) for n in rng.integers(1, 4000, 600)] + ["same"] * 300
    docs = frame(spark, texts).withColumnsRenamed({"lang": "shard", "source": "slot"})
    got = sharding.shard(docs).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in enumerate(texts))
    places, load = defaultdict(list), Counter()
    for r in got:
        places[r.shard].append(r.slot)
        load[r.shard] += r.size
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    rest = [v for v in load.values() if v < 100_000]  # one text alone outweighs a shard
    assert set(load) == set(range(24)) and max(rest) - min(rest) < 0.05 * np.mean(rest)
    assert len({(r.virtual_slot, r.shard) for r in got}) == len({r.virtual_slot for r in got})
    assert sharding.shard(docs.limit(0)).count() == 0


def test_map_versions(spark, scratch):
    path = f"{scratch}/map"
    sharding.save_map(sharding.first_map(spark, 4, 64), path)
    weights = spark.range(64).selectExpr("int(id) as virtual_slot", "id * id as bytes")
    sharding.save_map(sharding.rebalance(sharding.read_map(spark, path), weights, 4), path)
    first, second = (sharding.read_map(spark, path, v) for v in (0, 1))
    assert first.count() == second.count() == second.select("virtual_slot").distinct().count() == 64
    moved = first.join(second.withColumnRenamed("shard", "now"), "virtual_slot").where("shard != now").count()
    loads = [r.b for r in second.join(weights, "virtual_slot").groupBy("shard").agg(F.sum("bytes").alias("b")).collect()]
    assert 0 < moved < 20 and max(loads) - min(loads) < 0.02 * np.mean(loads)
    assert sharding.read_map(spark, path).first().version == 1


# WARC


def test_archives_round_trip(spark, scratch):
    big = "".join(chr(0x3B1 + i % 20) for i in range(70_000))
    rows = [(0, "http://a/", PROSE * 2), (1, None, PROSE * 2), (2, "http://b/\r\nX: y", big), (3, "u", big), (4, "u", None), (5, "u", ""), (6, "u", "short"),
            (7, "u", "short"), (None, "n", PROSE * 2), (8, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 20), (9, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 20), (0, "again", PROSE * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("clash"))
    warc.write_archives(pages, f"{scratch}/a", segment_bytes=1000, chunk_bytes=300, records_per_file=50)
    got = warc.read_archives(spark, f"{scratch}/a").collect()
    assert all(r.complete for r in got)
    first = {PROSE * 2: 0, big: 2, rows[9][2]: 8}
    expected = Counter()
    for i, _, t in rows:
        t = t or ""
        refers = first.get(t)
        revisit = refers is not None and i != refers
        expected[str(i) if i is not None else None, len(t.encode()), sha256(t.encode()).hexdigest(), "revisit" if revisit else "response",
                 str(refers) if revisit else None, None if revisit else t] += 1
    assert expected == Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
                                None if r.payload is None else bytes(r.payload).decode()) for r in got)
    warc.write_archives(pages.limit(0), f"{scratch}/none")
    assert warc.read_archives(spark, f"{scratch}/none").count() == 0


def test_reassembly_checks():
    body = warc.chunked(b"x" * 1000, 64)
    assert warc.unchunked(body) == b"x" * 1000 and warc.unchunked(body[:-8]) is None and warc.unchunked(b"zz\r\n") is None
    parts = [(1, None, {"a": "b"}, body[:500]), (2, None, None, body[500:900]), (3, len(body), None, body[900:])]
    assert warc.reassembled(parts[::-1]) == ({"a": "b"}, body)
    assert warc.reassembled(parts[::2])[1] is None and warc.reassembled(parts[:2])[1] is None
    stream = io.BytesIO(gzip.compress(warc.record("response", [("K", "v")], b"\r\n\r\nWARC/1.1") + warc.END))
    [(headers, block)] = warc.parse(gzip.GzipFile(fileobj=stream))
    assert headers["k"] == "v" and block == b"\r\n\r\nWARC/1.1"


# pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert 0 < docs.count() <= before, name
        before = docs.count()
    assert {r.class_id == r.doc_id for r in ngram_join.similarity_classes(docs).collect()} == {True}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in docs.collect()}
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_pipeline_stages_with_clashing_columns(spark):
    """Columns named like internals, a null id, null, blank and repeated texts pass through every stage untouched."""
    import corpus_pipeline

    names = ["own", "rk", "th", "once", "n", "repeated", "kept", "score", "lang_pred", "contaminated", "__hit", "__items",
             "__repeated", "items", "ids", "key", "digest", "class", "tokens", "n_words", "curve_range"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    edges = docs.where("doc_id < 3").select(F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), *docs.columns[1:])
    blank = docs.where("doc_id < 3").withColumn("text", F.lit(" \n"))
    none = blank.withColumn("text", F.lit(None).cast("string"))
    plain = docs.union(docs.where("doc_id < 5")).union(edges).union(blank).union(none)
    clashing = plain.select("*", *[F.concat(F.lit(f"{c} "), F.coalesce("doc_id", F.lit(-1))).alias(c) for c in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clashing, SF)
        assert out.columns == clashing.columns, name
        rows = out.collect()
        assert all(r[c] == f"{c} {-1 if r.doc_id is None else r.doc_id}" for r in rows for c in names), name
        assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in rows) == \
            sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in stage(spark, plain, SF).collect()), name
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, clashing, SF).count() == last(spark, plain, SF).count()


def test_components_end_with_stars(spark):
    """Paths, a hot star, two nodes that hang on several others, many lone pairs: labels of a plain search."""
    from tickerlake.llm.components import components

    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 800)] + [(5000 - i, 5000 - i - 1) for i in range(60)]
    edges += [(2000 + 2 * i, 2001 + 2 * i) for i in range(200)] + [(9000, 9100), (9001, 9100), (9002, 9100), (9002, 9101), (9003, 9101), (9, 9)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = sorted((root(u), root(v)))
            parent[b] = a
    got = components(spark.createDataFrame(edges + edges[:50], "u long, v long")).collect()
    assert sorted((r.node, r.label) for r in got) == sorted((x, root(x)) for x in parent)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
