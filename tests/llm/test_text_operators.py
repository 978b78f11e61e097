"""The operators for training text against plain Python, and on edge rows."""

import hashlib
import random
import re
from pathlib import Path

import pyarrow as pa
import pytest
from checks.compare import database, difference
from conftest import SF_DIR
from pyspark.sql import functions as F

from geoferry.llm import common, decontamination, html_text, line_dedup, near_dedup, passages, personal_data, pieces, quality_rules, secret_scan, toxicity
from geoferry.llm.common import staged
from geoferry.llm.queries import ORACLES, QUERIES

ROOT = str(Path(__file__).resolve().parents[2])
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = " ".join(f"word{n} of the text" for n in range(60))
#: Null text, empty text, white space, repeated rows, null id, one very long line and control characters.
EDGES = [
    (1, None), (2, ""), (3, " \n\t\n "), (4, PROSE), (4, PROSE), (5, PROSE + " more"), (6, "x" * 200_000), (7, "a " * 50_000),
    (8, "\x01\x00 odd\r\nÉ ß 漢字"), (None, PROSE), (9, "line of a text that is shared by many\n" * 3),
]


@pytest.fixture(scope="module")
def edges(spark):
    frame = spark.createDataFrame(EDGES, "doc_id long, text string")
    return frame.withColumns({"n_words": F.lit("clash"), "kept": F.lit(1), "score": F.lit(2.0), "path": F.lit("p")})


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {row.doc_id: row.text for row in documents.select("doc_id", "text").collect()}


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(spark, key):
    n_rows, found = difference(QUERIES[key](spark, SF_DIR), database(SF_DIR).sql(ORACLES[key]))
    assert found is None and n_rows > 0


@pytest.mark.parametrize("key", ["op3_personal_data", "op4_secret_scan", "op5_quality_rules"])
def test_native(spark, key):
    assert "Python" not in str(QUERIES[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString())


REPORTS = {
    "quality": quality_rules.quality_report,
    "lines": line_dedup.line_dedup_report,
    "near": near_dedup.with_components,
    "personal": personal_data.personal_data_report,
    "pieces": pieces.encoded_report,
    "secrets": lambda docs: secret_scan.secrets(docs, path="path"),
    "passages": passages.repeated_passages,
    "leaks": lambda docs: decontamination.decontamination_report(docs, docs.withColumnRenamed("doc_id", "item_id")),
    "toxicity": lambda docs: toxicity.toxicity_scores(docs, docs.select("doc_id", F.lit(1).alias("toxic"))),
}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_edge_rows_and_empty_tables(edges, name):
    n = REPORTS[name](edges).count()
    assert n == len(EDGES) or name in ("secrets", "passages")
    assert REPORTS[name](edges.limit(0)).count() == 0


def test_edge_pages(spark):
    rows = [(1, "http://a.b/c", None), (2, None, ""), (3, "x", "<p>a<p>b&amp;c"), (3, "x", "<p>a<p>b&amp;c"), (None, "u", "<div>" * 3000 + "deep")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("path", F.lit(1))
    got = sorted(row.text for row in html_text.main_texts(pages).collect())
    assert got == ["", "", "a\nb&c", "a\nb&c", "deep"]
    assert html_text.main_texts(pages.limit(0)).count() == 0


def test_main_text():
    page = (
        "<html><head><title>t</title></head><body><header>Site</header><nav><a href=a>menu</a></nav><div id='cookie-notice'>We use</div>"
        "<div class=wrap><div class='sidebar-2'>side</div><div class='post-17 entry'><h2>T &amp; c</h2><p>One <b>bold</b>\n text of the page that is "
        "long enough.<ul><li>a<li>b &lt;c&gt;</ul><form>name</form><div class=comments><p>first!</div></div></div><script>x='</p>'</script>"
        "<footer>f</footer></body></html>"
    )
    blocks, nodes = html_text.parsed(page)
    assert html_text.best(nodes).path == "/html/body/div.wrap/div.entry.post-#"
    assert html_text.text_at(blocks, nodes, None) == "T & c\nOne bold text of the page that is long enough.\na\nb <c>"


def test_text_beside_large_containers_is_kept(spark):
    long = "A sentence of the text. " * 40
    text_of = lambda page, path=None: html_text.text_at(*html_text.parsed(page), path).split("\n")
    nested = f"<body><p>Site<div><article><h1>Title</h1><p>Lead</p><div class=body><p>More</p><div><p>{long}</p></div></div><p>End</p></article></div></body>"
    assert text_of(nested) == ["Title", "Lead", "More", long.strip(), "End"]
    assert text_of("<main><article><p>One text</p></article><p>Between</p><article><p>Two texts</p></article></main>") == ["One text", "Between", "Two texts"]
    assert text_of(f"<body><div><p>One</p></div><div><p>{long}</p></div></body>") == ["One", long.strip()]
    assert text_of(f"<body><div><a>menu</a></div><div class=x><p>{long}</p></div></body>") == [long.strip()]
    two = "<body><div class=post><p>Sixty of a hundred</p></div><div class=more><p>and forty</p></div></body>"
    assert text_of(two, "/body/div.post") == ["Sixty of a hundred", "and forty"]


def test_the_vote_of_a_host_takes_its_lines_away(spark):
    """No page alone can tell the line beside its article from text; the pages of the host can. One page is of another make."""
    chance = random.Random(12)
    prose = lambda n: " ".join(f"w{chance.randrange(10**6)}" for _ in range(n))
    rows, expected = [], {}
    for n in range(30):
        title, body, end = prose(5), prose(120), prose(8)
        page = f"<body><p>{title}</p><div class='post-{n}'><p>{body}</p><p>Copyright {n} by us</p></div><p>{end}</p><p>Copyright 2001 by us</p><p>Tell a friend</p></body>"
        rows.append((n, f"http://a.example/{n}", page))
        expected[n] = f"{title}\n{body}\nCopyright {n} by us\n{end}"
    other, alone = f"<body><p>Copyright 2001 by us</p><p>{prose(60)}</p></body>", f"<body><div class=post-1><p>{prose(90)}</p></div><p>Tell a friend</p></body>"
    rows += [(100, "http://a.example/other", other), (101, "http://b.example/", alone), (102, "http://a.example/empty", "")]
    expected |= {100: html_text.text_at(*html_text.parsed(other), None), 101: html_text.text_at(*html_text.parsed(alone), None), 102: ""}
    assert "Copyright" in expected[100] and "Tell a friend" in expected[101]
    got = html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {row.page_id: row.text for row in got.collect()} == expected


@pytest.mark.parametrize(
    "inner, expected",
    [
        ("<p>Let <math><mi>x</mi></math> be</p><button>Go on</button>", ["Let x be", "Go on"]),
        ("<p class='share-price'>12 a share</p><div class='post-header'><h1>Title</h1></div>", ["12 a share", "Title"]),
        ("<div class='site-header'>Menu</div><div class='share-bar'>Tweet</div><div class=comment-list>First!</div><p id=main-nav>x<p>Text", ["Text"]),
        ("<noscript>Read this</noscript><canvas>a chart</canvas><object>or that</object><p role=alert>now<p>Text", ["Read thisa chartor that", "Text"]),
        ("<div><section><article><div class=x><p>a</p><div>b</div></div></article></section></div><ul><li>c<ol><li>d</ol></ul>", ["a", "b", "c", "d"]),
        ("<table><tr><td><div>a</div>b<td>c</table>", ["a", "b", "c"]),
    ],
)
def test_contract_of_articles(inner, expected):
    assert html_text.text_at(*html_text.parsed(f"<body><nav>menu</nav><article>{inner}</article><footer>f</footer></body>"), None).split("\n") == expected


def test_pages_in_linear_time():
    import time

    for page in ("<div>" * 20_000 + "x" + "</b>" * 20_000, "<div>" * 20_000 + "<p>x" * 20_000, "<ul>" + "<li><div>a" * 20_000, "<table>" + "<tr><td>a" * 20_000, "<div class=a>" * 20_000):
        began = time.perf_counter()
        html_text.text_at(*html_text.parsed(page), "/div")
        html_text.vote_of(page)
        assert time.perf_counter() - began < 6, page[:20]


@pytest.mark.parametrize(
    "inner, expected",
    [
        ("<p class=ad>Buy<p>Text<div>More</div>", ["Text", "More"]),
        ("<p class=ad>Buy<hr>Text", ["Text"]),
        ("<p><span class=ad>Buy<p>Text", ["Text"]),
        ("<ul><li class=promo>Buy<ul><li>now</ul><li>a<li>b</ul><p>Text", ["a", "b", "Text"]),
        ("<dl><dt>t<dd class=ad>Buy<dt>u<dd>d</dl>Text", ["t", "u", "d", "Text"]),
        ("<table><tr class=ad><td>Buy<tr><td class=ad>Buy<td>a<th class=ad>Buy<th>b</table>Text", ["a", "b", "Text"]),
        ("<table><tbody class=ad><tr><td>Buy<tbody><tr><td>a</table>Text", ["a", "Text"]),
        ("<div class=ad><p>Buy<p>now</div><p>Text</p>", ["Text"]),
    ],
)
def test_marked_elements_without_end_tags(inner, expected):
    assert html_text.text_at(*html_text.parsed(f"<article>{inner}</article>"), None).split("\n") == expected


def test_pages_of_the_table(spark):
    import html

    for row in QUERIES["op10_html_extraction"](spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/pages.parquet"), ["page_id", "url"]).collect():
        article = re.search(r"<article>(.*)</article>", row.html, re.DOTALL)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub("<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1|ul|li|div)[^>]*>", article)]
        assert row.text == "\n".join(x for x in parts if x) and row.n_chars == len(row.text)


def test_pieces_equal_the_library(texts):
    import sentencepiece

    model = pieces.model_bytes()
    ours, theirs = pieces.Pieces(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    chance = random.Random(1)
    odd = [" " * n + "the" + " " * n for n in range(20)] + ["▁▁ a", "</s><0x41>", "漢字🙂é\x00\r\n", "a" * 9000, " " * 5000]
    odd += ["".join(chance.choice(" ▁\nabcdeéñß漢thing<0x41>") for _ in range(chance.randrange(40))) for _ in range(2000)]
    for text in [*odd, *texts.values()]:
        ids, decoded = ours.both(text)
        expected = theirs.encode(text)
        assert ids.tolist() == expected and decoded == theirs.decode(expected) == ours.decode(expected)


def test_texts_of_a_batch_go_in_step(monkeypatch):
    import pyarrow as pa
    import sentencepiece

    model = pieces.model_bytes()
    ours, theirs = pieces.Pieces(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    chance = random.Random(3)
    word = lambda: "".join(chance.choice("abcdefghilnorstué漢🙂\n▁<") for _ in range(chance.randrange(1, 40)))
    texts = [" ".join(word() for _ in range(chance.randrange(60))) for _ in range(200)] + ["", " ", "a  b ", "nul\0 here", "\0", "é" * 50, " " * 40 + "x"]
    alone = []
    monkeypatch.setattr(ours, "tokens", lambda text, one=ours.tokens: alone.append(text) or one(text))
    for _ in range(2):  # the second time from what is remembered
        ids = ours.encode_all(pa.array(texts, pa.string()))
        assert ids.to_pylist() == theirs.encode(texts) and ours.decode_all(ids).to_pylist() == theirs.decode(theirs.encode(texts))
    assert len([x for x in alone if len(x) <= pieces.PART_LENGTH]) < 1000 < len({x for text in texts for x in ours.split(text)})
    monkeypatch.setattr(pieces, "PARTS", 50)
    monkeypatch.setattr(pieces, "BESIDE", 100)
    assert ours.encode_all(pa.array(texts[:60] * 2, pa.string()).slice(20, 80)).to_pylist() == theirs.encode((texts[:60] * 2)[20:100])
    assert len(ours.known) == 1
    assert ours.encode_all(pa.array([], pa.string())).to_pylist() == [] and ours.encode_all(pa.array([""], pa.string())).to_pylist() == [[]]


def test_pieces_seam_equals_full_merging():
    ours = pieces.Pieces(pieces.model_bytes())
    chance, tokens = random.Random(2), list(ours.token_id)
    for _ in range(20_000):
        a, b = chance.choice(tokens), chance.choice(tokens)
        assert ours._merge_seam(a, b) == (ours.merged(a + b, ours.plain) == [a, b])


def test_leaks_in_blocks_equal_leaks_at_once(spark, documents):
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    once, blocks = (
        sorted((r.doc_id, r["__n_hit"], tuple(r["__items"])) for r in decontamination.decontaminated(documents, benchmark, block_bytes=size).collect())
        for size in (1 << 24, 4000)
    )
    assert once == blocks and any(hit for _, hit, _ in once)
    cut = decontamination.without_hits(documents, benchmark)
    assert cut.columns == documents.columns and cut.count() == documents.count()


def test_items_with_ids_of_any_type(spark, documents):
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    named = benchmark.withColumn("item_id", F.concat(F.lit("item-"), F.col("item_id")))
    plain, text = (
        {r.doc_id: r["__items"] for r in decontamination.decontaminated(documents, items, block_bytes=size).collect()}
        for items, size in ((benchmark, 1 << 24), (named, 4000))
    )
    assert {key: sorted(f"item-{n}" for n in found) for key, found in plain.items()} == {key: sorted(found) for key, found in text.items()}
    assert decontamination.decontamination_report(documents, named).where("n_items > 0").count() == sum(map(bool, plain.values())) > 0


def test_an_automaton_takes_bounded_memory():
    """Of a process that builds one over a megabyte of items that share nothing."""
    import subprocess
    import sys

    code = """
import random, resource
from geoferry.llm.decontamination import Windows
chance = random.Random(1)
items = [(n, " ".join(f"w{chance.randrange(60000)}" for _ in range(150))) for n in range(1000)]
size, before = sum(len(text) for _, text in items), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
windows = Windows(items)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) * 1024 / size)
"""
    ratio = float(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=ROOT).stdout)
    assert ratio * decontamination.BLOCK_BYTES < 500 << 20


def shingles(text):
    words = WORD.findall((text or "").translate(LOW))
    return frozenset(tuple(words[at : at + 5]) for at in range(max(1, len(words) - 4))) if words else frozenset()


def test_components_equal_brute_force(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {row.doc_id: row.text for row in documents.collect()}
    chance = random.Random(3)
    near = []
    for group in range(3):  # chains of copies, each an edit further
        words = [f"g{group}w{chance.randrange(10**6)}" for _ in range(150)]
        for copy in range(40):
            words = [f"e{chance.randrange(10**6)}" if chance.random() < 0.012 else word for word in words]
            near.append((10**7 + 100 * group + copy, " ".join(words)))
    every = {**texts, **dict(near)}
    docs = documents.select("doc_id", "text").union(spark.createDataFrame(near, "doc_id long, text string"))
    sets = {key: shingles(text) for key, text in every.items()}
    parent = {key: key for key in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    holders = {}
    for key in keys:
        for shingle in sets[key]:
            holders.setdefault(shingle, []).append(key)
    for key in keys:
        for other in {o for shingle in sets[key] for o in holders[shingle] if o < key}:
            common = len(sets[key] & sets[other])
            if 100 * common >= 75 * (len(sets[key]) + len(sets[other]) - common):
                a, b = find(key), find(other)
                parent[max(a, b)] = min(a, b)
    got = {row.doc_id: row for row in near_dedup.with_components(docs).collect()}
    assert {key: (len(sets[key]), find(key), find(key) == key) for key in keys} == {key: (r.n_shingles, r.component_id, r.kept) for key, r in got.items()}


def test_one_of_each_judges_rows(spark):
    alone, copied, unique, other = (" ".join(f"{name}{n}" for n in range(80)) for name in ("alone", "copied", "unique", "other"))
    rows = [(None, alone), (None, alone), (None, copied), (3, copied), (5, copied), (5, unique), (7, other), (7, other), (8, other + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_shingles", F.lit("clash"))
    got = near_dedup.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id or 0), r.text) for r in got.collect()) == [(0, alone), (3, copied), (5, unique), (7, other)]


def test_registers_merge_and_estimate():
    import numpy as np

    values = np.random.default_rng(1).integers(1, 1 << 63, 1500, dtype=np.uint64)
    a, b = near_dedup.registers_of(values[:1000]), near_dedup.registers_of(values[200:])
    assert (np.maximum(a, b) == near_dedup.registers_of(values)).all()
    estimate = near_dedup.estimated(a[None], b[None], np.array([1000]), np.array([1300]))[0]
    assert abs(estimate - 800 / 1500) < 0.2


def test_bands_meet_at_the_threshold_and_seldom_below():
    import numpy as np

    rng = np.random.default_rng(4)

    def meets(similarity, times):
        met = 0
        for _ in range(times):
            n, common = 200, round(2 * 200 * similarity / (1 + similarity))
            pool = rng.integers(1, 1 << 63, 2 * n, dtype=np.uint64)
            a, b = (near_dedup.registers_of(x)[None] for x in (pool[:n], pool[n - common : 2 * n - common]))
            met += (near_dedup.band_keys(a) == near_dedup.band_keys(b)).any()
        return met / times

    assert meets(0.76, 400) == 1.0 and meets(0.3, 400) < 0.1


@pytest.mark.parametrize("batch", [1, 2, 3, 1000])
def test_buckets_over_the_bounds_of_batches(spark, batch):
    chance = random.Random(batch)
    rows = sorted({(chance.randrange(12), chance.randrange(40)) for _ in range(60)} | {(99, 1), (100, 5)})
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = near_dedup.shared_buckets(spark.createDataFrame(rows, "bucket long, cid long")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    members = {bucket: [cid for b, cid in rows if b == bucket] for bucket, _ in rows}
    assert sorted(map(tuple, got)) == sorted((b, cid, min(members[b])) for b, cid in rows if len(members[b]) > 1)


def test_a_filter_of_ids_misses_none(spark):
    ids = spark.range(0, 30_000, 3).select((F.col("id") * 7919 - 10**9).alias("k"))
    rows = spark.range(30_000).select((F.col("id") * 7919 - 10**9).alias("k"), F.lit("x" * 50).alias("t"))
    marked = common.maybe_among(rows, "k", common.id_filter(ids, "k", common.Scratch()))
    assert marked.columns == ["k", "t", "__maybe"] and marked.count() == 30_000
    among = marked.where((F.col("k") + 10**9) % (3 * 7919) == 0)
    assert among.where("not __maybe").isEmpty() and marked.where("__maybe").count() < 10_000 + 30
    assert marked.where("__maybe").count() >= 10_000


def test_near_dedup_leaves_one_table(spark, edges):
    from geoferry.workspace import shared_folder

    def tables():
        path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
        return {x.getPath().getName() for x in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)}

    before = tables()
    near_dedup.with_components(edges)
    assert len(tables() - before) == 1


def test_compact_windows_hold_every_minimum():
    import numpy as np

    values = np.random.default_rng(1).integers(1, 1 << 63, 900, dtype=np.uint64)
    low, at, high = passages.compact_windows(values, np.array([0, 300]), np.array([300, 900]))
    expected = {k + int(values[k : k + 46].argmin()) for begin, end in ((0, 300), (300, 900)) for k in range(begin, end - 45)}
    assert set(at.tolist()) == expected and all(values[x:z].argmin() + x == y for x, y, z in zip(low, at, high))


def test_passages_of_fifty_words_are_found(spark):
    chance = random.Random(5)
    prose = lambda n: " ".join(f"w{chance.randrange(10**7)}" for _ in range(n))
    shared = prose(55)
    rows = [(n, f"{prose(80 + n)} {shared} {prose(70)}") for n in range(30)] + [(100 + n, prose(250)) for n in range(30)]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(row.doc_id for row in got) == list(range(30))
    assert all(row.start_word <= 80 + row.doc_id and row.end_word >= 135 + row.doc_id for row in got)


def test_passages_equal_brute_force(spark):
    """Every place of the table whose surroundings another document has, at a similarity of 0.75, lies in a passage; and
    every passage holds such a place."""
    documents = spark.read.parquet(f"{SF_DIR.replace('0.01', '0.001')}/documents.parquet")
    words = {row.doc_id: WORD.findall((row.text or "").translate(LOW)) for row in documents.collect()}
    rows = {doc: [tuple(found[at : at + 5]) for at in range(len(found) - 4)] for doc, found in words.items()}
    holders = {}
    for doc, found in rows.items():
        for at, shingle in enumerate(found):
            holders.setdefault(shingle, []).append((doc, at))
    alike = set()
    for places in holders.values():
        for doc, at in places:
            for other, there in places:
                if doc != other and (doc, at) not in alike:
                    for before in (0, 11, 22, 34, 45):  # the stretch of 50 words may lie anywhere around the place
                        x, y = rows[doc][max(0, at - before) : at - before + 46], rows[other][max(0, there - before) : there - before + 46]
                        if at >= before and there >= before and len(x) == len(y) == 46:
                            common = len(set(x) & set(y))
                            if 100 * common >= 75 * (len(set(x)) + len(set(y)) - common):
                                alike.add((doc, at))
                                break
    got = passages.repeated_passages(documents).collect()
    spans = {}
    for row in got:
        spans.setdefault(row.doc_id, []).append((row.start_word, row.end_word))
    found = sum(any(a <= at and at + 5 <= b for a, b in spans.get(doc, [])) for doc, at in alike)
    print(f"{found} of {len(alike)} places")
    assert len(alike) > 500 and found >= 0.98 * len(alike)
    assert all(any((row.doc_id, at) in alike for at in range(row.start_word, row.end_word)) for row in got)
    assert all(row.end_word - row.start_word >= 50 and row.least_doc_id <= row.doc_id and row.n_members > 1 for row in got)


def test_copies_are_passages_and_rows_of_one_document_are_none(spark):
    chance = random.Random(13)
    prose = lambda n: " ".join(f"w{chance.randrange(10**7)}" for _ in range(n))
    whole, twice, part = prose(80), prose(90), prose(60)
    rows = [(5, whole), (3, whole), (9, f"{prose(70)} {part} {prose(60)}"), (7, f"{part} {prose(30)}"), (1, twice), (1, twice), (1, f"{twice} end"), (2, prose(49)), (4, prose(200))]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.start_word <= s, r.end_word >= e, r.class_id, r.n_members) for r, s, e in [(r, {9: 70}.get(r.doc_id, 0), {9: 130, 7: 60}.get(r.doc_id, 80)) for r in got]) == [
        (3, True, True, "3:0", 2), (5, True, True, "3:0", 2), (7, True, True, "7:0", 2), (9, True, True, "7:0", 2),
    ]


@pytest.mark.parametrize("batch", [1, 3, 1000])
def test_groups_over_the_bounds_of_batches(spark, batch):
    chance = random.Random(batch)
    rows = [(chance.randrange(9), chance.randrange(5), chance.randrange(3), 10 << 32 | 5 << 16 | 0xFFFF) for _ in range(80)] + [(50, 1, 1, 10 << 32 | 5 << 16 | 6)] * 3
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        windows = spark.createDataFrame(rows, "key long, same long, at int, around long")
        met = [tuple(row) for row in passages.met_windows(windows).collect()]
        members = passages.members_of(passages.met_windows(windows)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    contents = {key: {same for k, same, *_ in rows if k == key} for key, *_ in rows}
    expected = sorted({row for row in rows if len(contents[row[0]]) > 1})
    assert sorted(met) == expected
    assert len(members) == len(expected)  # one half of each window lies in the text
    places = {(same, at) for _, same, at, _ in expected}
    assert all(row.doc != row.other and (row.other, row.at_other) in places for row in members)


def test_passages_with_words_put_in_and_left_out(spark):
    chance = random.Random(6)
    prose = lambda n: [f"w{chance.randrange(10**7)}" for _ in range(n)]
    alike = lambda a, b: len(a & b) / len(a | b)
    rows, inserted, near = [], [], []
    for group in range(200):
        shared = prose(50)
        other = [*shared[:25], *prose(1), *shared[25:]]
        if group % 2:  # another edit, if it leaves a similarity of 0.75
            at = chance.randrange(2, 49)
            changed = [*other[:at], *other[at + 1 :]] if chance.random() < 0.5 else [*other[:at], *prose(1), *other[at:]]
            other = changed if len(changed) >= 50 and alike(shingles(" ".join(shared)), shingles(" ".join(changed))) >= 0.75 else other
        (near if group % 2 else inserted).append(group)
        for number, words in enumerate((shared, other)):
            rows.append((2 * group + number, " ".join(prose(60 + group % 7) + words + prose(70))))
    got = {row.doc_id for row in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all({2 * group, 2 * group + 1} <= got for group in inserted)
    assert sum({2 * group, 2 * group + 1} <= got for group in near) >= 0.98 * len(near)


def test_passages_that_stand_twice_in_a_document(spark):
    chance = random.Random(7)
    prose = lambda n: [f"w{chance.randrange(10**7)}" for _ in range(n)]
    shared = prose(60)
    twice = prose(100) + shared + prose(700) + shared + prose(80)
    part_first = prose(90) + shared[:30] + prose(400) + shared + prose(80)
    rows = [(n, " ".join(words)) for n, words in enumerate((twice, prose(70) + shared + prose(70), part_first, twice[50:]))]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    covered = lambda doc, at: any(row.doc_id == doc and row.start_word <= at and row.end_word >= at + 60 for row in got)
    assert all(covered(doc, at) for doc, at in [(0, 100), (0, 860), (1, 70), (2, 520), (3, 50), (3, 810)])


def test_passages_that_leading_documents_hold_in_part(spark):
    chance = random.Random(8)
    prose = lambda n: [f"w{chance.randrange(10**7)}" for _ in range(n)]
    shared = prose(54)
    parts = {0: shared[:42], 1: shared[-42:], 98: shared[:42], 99: shared[-42:]}
    rows = [(n, " ".join(prose(80) + parts.get(n, shared) + prose(70))) for n in [0, 1, *range(10, 30), 98, 99]]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(row.doc_id for row in got) == list(range(10, 30))
    assert all(row.start_word <= 80 and row.end_word >= 134 for row in got)
    assert {row.class_id for row in got} == {"10:80"} and {row.n_members for row in got} == {20} and {row.least_doc_id for row in got} == {10}


def test_personal_data_equals_plain_patterns(spark, texts):
    rules = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def good(kind, match):
        digits = re.sub("[^0-9]", "", match)
        if kind == "ip":
            return all(int(part) <= 255 for part in match.split("."))
        if kind == "card":
            total = sum((v := int(c) * (1 + at % 2)) - 9 * (v > 9) for at, c in enumerate(reversed(digits)))
            return 12 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    odd = ["a@b.c_d@e.f x@y", "1.2.3.4.5.6.7.8 999.1.1.1 00255.1.1.1", "4111 1111 1111 1111 1 4111111111111111", "+1 (286) 555-5136) +++1234567890123", "\x01a@b.com"]
    every = {**texts, **{10**8 + at: text for at, text in enumerate(odd)}}
    got = personal_data.personal_data_report(spark.createDataFrame(list(every.items()), "doc_id long, text string")).collect()
    for row in got:
        spans = sorted((m.start(), at, m.end(), kind) for at, (kind, rule) in enumerate(rules.items()) for m in re.finditer(rule, every[row.doc_id]) if good(kind, m[0]))
        listed = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and set(listed.split(",")) <= set(row.spans.split(",")) | {""}


def test_reliabilities_equal_a_plain_version():
    """The same estimate, candidate by candidate and with one product of chances at a time."""
    chance = random.Random(3)
    counts = {(chance.randrange(4), chance.random() < 0.5, chance.randrange(3**5)): chance.randrange(1, 40) for _ in range(60)}
    votes = lambda pattern: [pattern // 3**place % 3 for place in range(4, -1, -1)]
    total = {key: sum(votes(key[2])) - 5 for key in counts}
    usual = {base: sum(total[key] * counts[key] for key in counts if key[1] == base) / sum(counts[key] for key in counts if key[1] == base) for base in (True, False)}
    posterior = {key: 1 / (1 + 2.718281828459045 ** -(3 * total[key] - 2 * usual[key[1]])) for key in counts}
    for _ in range(50):
        share = {}
        for base in (True, False):
            some = [key for key in counts if key[1] == base]
            share[base] = (sum(posterior[key] * counts[key] for key in some) + 1) / (sum(counts[key] for key in some) + 2)
        says = {}
        for labeler in range(5):
            for truth in (1, 0):
                belief = personal_data.BELIEFS[personal_data.LABELERS[labeler]][0 if truth else 1]
                seen = [x * (1 + sum(counts.values()) / 50 if labeler == 3 else 1) for x in belief]
                for key, n in counts.items():
                    seen[votes(key[2])[labeler]] += n * (posterior[key] if truth else 1 - posterior[key])
                says[labeler, truth] = [x / sum(seen) for x in seen]
        for key in counts:
            yes, no = share[key[1]], 1 - share[key[1]]
            for labeler, vote in enumerate(votes(key[2])):
                yes, no = yes * says[labeler, 1][vote], no * says[labeler, 0][vote]
            posterior[key] = yes / (yes + no)
    got = personal_data.reliabilities(counts)
    assert all(abs(got[key] - posterior[key]) < 1e-6 for key in counts)


def loose_texts(chance, n):
    """Lines with looser candidates, true and false; the text of each and its true spans."""
    number = lambda: f"{chance.randrange(201, 990)}-{chance.randrange(200, 999)}-{chance.randrange(1000, 9999)}"
    mail = lambda: f"{chance.choice(['ann', 'joe.b', 'info'])}{chance.randrange(99)} [at] {chance.choice(['mail', 'web-x', 'uni'])} [dot] {chance.choice(['com', 'de', 'org'])}"
    rows = []
    for key in range(n):
        parts, real = [], []
        for _ in range(5):
            kind = chance.randrange(8)
            value, is_real = (mail() if kind == 0 else f"({number()[:3]}) {number()[4:]}" if kind == 1 else number()), kind < 4
            lead = {0: "contact ", 1: "tel. ", 2: "phone: ", 3: "call me at ", 4: "order no ", 5: "serial ", 6: "invoice ", 7: "version "}[kind]
            parts.append(f"some words {lead}")
            if is_real:
                real.append((sum(map(len, parts)), sum(map(len, parts)) + len(value)))
            parts.append(value + chance.choice([". ", " and so on, ", "; "]))
        rows.append((key, "".join(parts), real))
    return rows


def test_loose_spans_are_judged_by_what_stands_around_them(spark):
    rows = loose_texts(random.Random(14), 400)
    docs = spark.createDataFrame([row[:2] for row in rows], "doc_id long, text string")
    got = {row.doc_id: {(s.start, s.end) for s in row.found if not s.base} for row in personal_data.personal_data(docs).collect()}
    hits = sum(len(got[key] & set(real)) for key, _, real in rows)
    precision, recall = hits / sum(map(len, got.values())), hits / sum(len(real) for *_, real in rows)
    print(f"precision {precision:.2f}, recall {recall:.2f}")
    assert precision >= 0.95 and recall >= 0.9
    more = [(1000, "order no 555-123-4567 serial"), (1001, "x" * 90 + " [at] " + "y" * 80 + " [dot] com")]
    both = docs.union(spark.createDataFrame(more, "doc_id long, text string"))
    found = {row.doc_id: row.found for row in personal_data.personal_data(both).collect()}
    assert not found[1000] and [(s.start, s.end) for s in found[1001]] == [(0, 90 + 6 + 80 + 7 + 3)]


def test_secrets_are_told_from_numbers(spark, documents, texts):
    got = {(row.doc_id, row.start): row for row in secret_scan.secrets(documents, path="source").collect()}
    tokens = {(key, m.start(1)) for key, text in texts.items() for m in re.finditer(r'token = "([0-9a-f]{40})"', text)}
    assert tokens and all(got[place].secret for place in tokens)
    assert not any(row.secret for row in got.values() if texts[row.doc_id][row.start : row.end].isdigit())


def test_short_and_plain_secrets_are_seen(spark, documents):
    odd = {
        'x password = "hunter2!pass" y': "hunter2!pass", "db postgres://joe:pa55!@host/db": "pa55!", "set api_key=QwErTyUiOpAsDfGh end": "QwErTyUiOpAsDfGh",
        "PWD=abc;": "abc", "{'auth_token': 'k!'}": "k!", "see https://a.b/?passwd=x1&y=2": "x1", 'secret => "two words 7"': "two words 7",
    }
    rows = [(10**7 + at, text, "code") for at, text in enumerate(odd)] + [(10**8, "The secret: patience and work.", "code")]
    docs = documents.select("doc_id", "text", "source").union(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = {(row.doc_id, row.start, row.end): row for row in secret_scan.secrets(docs, path="source").collect()}
    for at, (text, value) in enumerate(odd.items()):
        row = got[(10**7 + at, text.index(value), text.index(value) + len(value))]
        assert row.secret and row.match_sha256 == hashlib.sha256(value.encode()).hexdigest()
    # The forest has learned what the rules say, and is no copy of them.
    known = secret_scan.rule_findings(secret_scan.candidates(docs, path="source")).collect()
    assert sum(got[(row.doc_id, row.start, row.end)].secret == bool(row.label) for row in known) >= 0.95 * len(known)


def spans_in(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return sorted((row.match, row.kind) for row in secret_scan.candidates(docs).collect())


@pytest.mark.parametrize(
    "text, expected",
    [
        ('password_for_the_production_database = "hunter2!pass"', [("hunter2!pass", "named")]),
        ("password" + " " * 14 + '= "hunter2!pass"', [("hunter2!pass", "named")]),
        ("postgres://" + "u" * 65 + ":pa55!@h/db", [("pa55!", "url")]),
        ("my_api_key_2 => 'a b' token: x,", [("a b", "named"), ("x", "named")]),
        ("AWS_SECRET_KEY1=wJalrXUtnFEMI0K7MDENG", [("wJalrXUtnFEMI0K7MDENG", "named")]),
        ("a token of thanks; secret agents, password", []),
        ("id 0123456789abcdef0 and abcdefghijklmnopqrstuvw", [("0123456789abcdef0", "run")]),
        ('PASSWORD="never closed', [("never", "named")]),
        ("", []),
    ],
)
def test_candidates(spark, text, expected):
    assert spans_in(spark, text) == expected


def test_candidates_in_linear_time(spark):
    import time

    spans_in(spark, "warm = up token=1")
    for piece in ("token", "token ", "token=", "://a:", "key-", "a" * 15 + " ", "password '"):
        began = time.perf_counter()
        spans_in(spark, piece * 40_000)
        assert time.perf_counter() - began < 20, piece


def code_texts(chance, n):
    """Lines as in a code base: real secrets, and what looks like them. Gives the texts, and the secrets of each."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    some = lambda size, of=letters: "".join(chance.choice(of) for _ in range(size))
    rows = []
    for number in range(n):
        real, lines = set(), []
        for _ in range(6):
            kind = chance.randrange(7)
            value = some(chance.randrange(20, 44))
            if kind == 0:
                real.add(value)
                lines.append(f'{chance.choice(["db", "svc", "ci"])}_{chance.choice(["token", "secret", "api_key"])} = "{value}"')
            elif kind == 1:
                real.add(value)
                lines.append(f"client.connect({value})")
            elif kind == 2:
                lines.append(f"integrity sha512-{some(60)}==")
            elif kind == 3:
                lines.append(f"commit {some(40, 'abcdef0123456789')}")
            elif kind == 4:
                lines.append(f"import module_{chance.choice(['page', 'user', 'file'])}_name_data_{chance.randrange(100)}_test_index")
            elif kind == 5:
                lines.append(f"token: {chance.choice(['string', 'str', 'None', 'optional', 'number'])}")
            else:
                lines.append(f'password = "{chance.choice(["<password>", "${PASSWORD}", "********", "env.PASS"])}"')
        rows.append((number, "\n".join(lines), "src/app.py", real))
    return rows


def test_a_forest_from_labelled_findings_removes_false_positives(spark):
    """Trained on the labelled findings of some texts, tried on those of others."""
    rows = code_texts(random.Random(11), 400)
    real = {key: found for key, _, _, found in rows}
    docs = spark.createDataFrame([row[:3] for row in rows], "doc_id long, text string, source string")
    labelled = secret_scan.candidates(docs, path="source").where("doc_id < 200")
    flags = spark.createDataFrame([(key, value) for key, found in real.items() for value in found], "doc_id long, match string").withColumn("is_real", F.lit(1))
    findings = labelled.join(flags, ["doc_id", "match"], "left").withColumn("label", F.coalesce("is_real", F.lit(0)))
    found = secret_scan.secrets(docs, findings, path="source").where("doc_id >= 200").collect()
    texts = {row[0]: row[1] for row in rows}
    judged = [(row.secret, texts[row.doc_id][row.start : row.end] in real[row.doc_id]) for row in found]
    hits = sum(secret and true for secret, true in judged)
    n_real = sum(len(found) for key, found in real.items() if key >= 200)
    wide, precision, recall = sum(true for _, true in judged) / len(judged), hits / sum(secret for secret, _ in judged), hits / n_real
    print(f"candidates {len(judged)}, precision {wide:.2f} before, {precision:.2f} after, recall {recall:.2f}")
    assert wide < 0.6 and precision >= 0.9 and recall >= 0.9


def test_toxicity_on_held_out_rows(spark):
    sf_dir = SF_DIR.replace("0.01", "0.1")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = [r for r in QUERIES["op7_toxicity"](spark, sf_dir).join(labels, "doc_id").collect() if r.held_out]
    hits = sum(r.predicted and r.toxic for r in rows)
    assert hits >= 0.75 * sum(r.toxic for r in rows) and hits >= 0.9 * sum(r.predicted for r in rows)


def test_good_documents_are_kept(spark, documents):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1")
    judged = quality_rules.quality_report(documents).join(labels, "doc_id").where("not base_failed")
    assert judged.where("kept").count() == judged.count()


def test_a_filter_on_the_report_reads_a_long_text_once(spark):
    import time

    docs = spark.createDataFrame([(1, " ".join(f"w{n % 7919}" for n in range(20_000)))], "doc_id long, text string")
    report = quality_rules.quality_report(docs)
    began = time.perf_counter()
    assert report.where("not base_failed and kept and n_repeat_words < 20000").count() == 0
    assert time.perf_counter() - began < 10


def test_filter_and_report_agree(spark, documents):
    kept = {row.doc_id for row in quality_rules.quality_report(documents).where("kept").collect()}
    assert {row.doc_id for row in quality_rules.quality_filter(documents).collect()} == kept


def test_cheap_rules_that_reject_much_come_first(spark, documents):
    def rules(text, words):
        dear = F.aggregate(F.transform(words, lambda word: F.sha2(F.repeat(word, 50), 512)), F.lit(0), lambda n, h: n + F.length(h))
        return {"dear": dear < 0, "dear_and_fair": dear % 2 == 0, "cheap": F.size(words) < 400}

    order = quality_rules.measured_order(documents, rules)
    assert order[0] == "cheap" and order[-1] == "dear"


def test_pipeline_equals_its_stages_in_python(spark):
    import corpus_pipeline

    small = SF_DIR.replace("0.01", "0.001")
    documents = spark.read.parquet(f"{small}/documents.parquet")
    got = corpus_pipeline.run(spark, small)
    assert "doc_id" in got.columns and "ids" in got.columns
    rows = got.collect()
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, small), "test-stage")
        assert docs.columns == documents.columns
    import sentencepiece

    theirs = sentencepiece.SentencePieceProcessor(model_proto=pieces.model_bytes())
    assert {r.doc_id: list(r.ids) for r in rows} == {r.doc_id: theirs.encode(r.text) for r in docs.collect()}
    assert 0 < len(rows) < documents.count()


def test_only_sketches_in_question_are_shuffled(spark, documents):
    texts = common.texts_of(documents).withColumn("doc_id", F.col("doc_id").cast("long"))
    classes = common.staged(near_dedup.sketches(texts).where("n_shingles > 0").withColumnRenamed("doc_id", "cid"), "test-classes")
    asked = {row.cid for row in classes.select("cid").orderBy("cid").limit(7).collect()}
    scratch = common.Scratch()
    pairs = scratch.stage(spark.createDataFrame([(min(asked), cid) for cid in asked], "a long, b long"), "test-pairs")
    some = near_dedup.sketches_among(classes, pairs.selectExpr("b as cid"), scratch)
    assert some.columns == ["cid", "n_shingles", "registers"] and asked == {row.cid for row in some.collect()} and classes.count() > 50
    assert {(row.a, row.b) for row in near_dedup.likely(pairs, classes, scratch).collect()} >= {(min(asked), min(asked))}
    scratch.drop(spark)


def test_plans_of_the_measured_order_hold_no_text(spark):
    """Spark keeps the text of a thousand plans in the driver, so sampled texts may not stand in them."""
    words = [f"unusual{n}" for n in range(500)]
    docs = spark.createDataFrame([(n, " ".join(words)) for n in range(2_000)], "doc_id long, text string")
    store = spark._jsparkSession.sharedState().statusStore()
    ids = lambda plans: [plans.apply(n).executionId() for n in range(plans.size())]
    before = max(ids(store.executionsList()), default=-1)  # of what many tests have run Spark keeps the last thousand
    assert set(quality_rules.measured_order(docs)) == set(quality_rules.default_rules(F.col("text"), F.col("text")))
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    plans = store.executionsList()
    late = [plans.apply(n).physicalPlanDescription() for n, number in enumerate(ids(plans)) if number > before]
    assert len(late) > 6 and not any("unusual499" in plan for plan in late)


def test_shuffle_files_go_once_a_table_is_written(spark):
    import time

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {x for x in (disk.getAllFiles().apply(n).getName() for n in range(disk.getAllFiles().size())) if x.startswith("shuffle_")}
    before, setting = files(), spark.conf.get(common.SHUFFLES_GO, None)
    scratch = common.Scratch()
    numbers = spark.range(10_000).repartition(8, "id").sortWithinPartitions("id").mapInArrow(lambda batches: batches, "id long")
    table = scratch.stage(numbers.groupBy((F.col("id") % 7).alias("k")).count(), "test-shuffles")
    until = time.time() + 10
    while (left := files() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and spark.conf.get(common.SHUFFLES_GO, None) == setting
    assert {(row.k, row["count"]) for row in table.collect()} == {(k, len(range(k, 10_000, 7))) for k in range(7)}
    scratch.drop(spark)


def test_passages_leave_no_words_of_documents_behind(spark, monkeypatch):
    """By the time pairs are compared, what all documents hold, and the windows, are gone from the shared folder."""
    from geoferry.workspace import folder_exists

    chance, seen = random.Random(15), []
    prose = lambda n: " ".join(f"w{chance.randrange(10**7)}" for _ in range(n))
    shared = prose(60)
    stage, links = common.Scratch.stage, passages.passage_links
    paths = {}

    def noted(self, df, name):
        table = stage(self, df, name)
        paths[name] = self.paths[-1]
        return table

    def compared(contents, pairs):
        seen.append({name for name, path in paths.items() if folder_exists(spark, path)})
        return links(contents, pairs)

    monkeypatch.setattr(common.Scratch, "stage", noted)
    monkeypatch.setattr(passages, "passage_links", compared)
    docs = spark.createDataFrame([(n, f"{prose(70)} {shared} {prose(70)}") for n in range(6)], "doc_id long, text string")
    assert sorted(row.doc_id for row in passages.repeated_passages(docs).collect()) == list(range(6))
    assert len(seen) == 2 and not any({"coded", "met-windows"} & held for held in seen) and "members" not in seen[1]


def test_near_dedup_writes_few_tables(spark, monkeypatch):
    """Each written table is a job over all partitions, however few its rows, so only what is read again is written."""
    chance = random.Random(21)
    prose = lambda n: [f"w{chance.randrange(10**7)}" for _ in range(n)]
    rows, near = [], prose(300)
    for n in range(40):
        words = list(near)
        words[7 * n] = f"other{n}"
        rows.append((n, " ".join(words)))
    rows += [(40 + n, " ".join(prose(80))) for n in range(10)]
    names, write = [], common.written
    monkeypatch.setattr(common, "written", lambda df, name: names.append(name) or write(df, name))
    got = {row.doc_id: row.component_id for row in near_dedup.with_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {n: 0 if n < 40 else n for n, _ in rows}
    assert not {"stars", "needed", "id-filter", "marked", "named"} & set(names)
    assert len([name for name in names if name != "labels"]) <= 12


def test_only_stretches_with_places_are_cut(spark):
    """All stretches of a content are several times its words; of those, only what holds a place is shuffled."""
    import numpy as np

    chance = random.Random(22)
    codes = [np.array([chance.randrange(1 << 32) for _ in range(10_000)], "<u4").tobytes() for _ in range(2)]
    contents = spark.createDataFrame([(n, bytearray(held)) for n, held in enumerate(codes)], "same long, codes binary")
    around = passages.AROUND
    spots = [(0, 5), (0, 9_995), (0, 4_000), (0, 4_001), (1, 130)]
    places = spark.createDataFrame([(n, doc, at, at // around, None, 1) for n, (doc, at) in enumerate(spots)], "key long, doc long, at long, part long, class long, n_blocks long")
    got = sorted(tuple(row) for row in passages.stretches_of(places, contents).collect())
    shingles = [passages.shingles_of(held) for held in codes]
    wanted = sorted({(doc, at // around) for doc, at in spots})
    assert [row[:2] for row in got] == wanted
    for doc, part, base, held in got:
        assert base == max(0, (part - 1) * around) and bytes(held) == shingles[doc][base : (part + 2) * around].tobytes()


def edited(chance, words, n):
    """The numbers with n of them exchanged, put in or left out."""
    found = list(words)
    for _ in range(n):
        at = chance.randrange(len(found))
        found[at : at + chance.randrange(2)] = [chance.randrange(1 << 62)] * chance.randrange(2)
    return found


def test_most_credit_bounds_what_grown_finds():
    import numpy as np

    chance, found = random.Random(23), 0
    assert passages.most_credit(np.zeros(0, bool)).size == 0 and (passages.most_credit(np.ones(45, bool)) < 0).all()
    assert passages.most_credit(np.ones(46, bool)).tolist() == [46] * 46
    for _ in range(300):
        shared = [chance.randrange(1 << 62) for _ in range(chance.randrange(40, 200))]
        x, y = (np.array(edited(chance, shared, chance.randrange(9)), np.uint64) for _ in range(2))
        mine, theirs = passages.most_credit(np.isin(x, y)), passages.most_credit(np.isin(y, x))
        assert (passages.maybe_in(x, y) >= np.isin(x, y)).all()
        for i, j in np.argwhere(x[:, None] == y)[::9].tolist():
            if passages.grown(x, y, i, j):
                found += 1
                assert mine[i] + theirs[j] >= 0
        begin, end = sorted(chance.sample(range(len(x) + 1), 2))
        # Plainly: the best stretch of 46 or more around each place that begins and ends with a common shingle.
        common = np.isin(x, y)
        for at in range(begin, end, 17):
            sums = [int(7 * common[low:high].sum() - 6 * (high - low)) for low in range(at + 1) for high in range(max(at + 1, low + 46), len(x) + 1) if common[low] and common[high - 1]]
            assert max(sums, default=None) == (int(mine[at]) if sums else None) and (sums or mine[at] < -(1 << 20))
    assert found > 1000


@pytest.mark.parametrize("few", [2, 16])
def test_places_with_lines_in_common_are_not_grown(monkeypatch, few):
    """Documents that share lines around a place, but no passage, are told apart without growing each pair of them."""
    import numpy as np
    import pyarrow as pa

    chance, calls, grown = random.Random(24), [], passages.grown
    monkeypatch.setattr(passages, "_FEW", few)
    monkeypatch.setattr(passages, "grown", lambda *x: calls.append(x) or grown(*x))
    prose = lambda n: [chance.randrange(1, 1 << 64) for _ in range(n)]
    lines, rows = [prose(16) for _ in range(3)], []
    for key in range(3):
        for doc in range(12):
            around = prose(20) + lines[0] + prose(12) + lines[1] + prose(12) + lines[2] + prose(37)
            rows.append((key, 0, 0, 0, doc, 1000, 56, None, np.array(around, np.uint64).tobytes()))
        for doc in (20, 21):  # and two that have lines 0 and 1 with all between them
            around = prose(18) + (shared := prose(2) + lines[0] + prose(12) + lines[1] + prose(1) if doc == 20 else shared) + prose(40)
            rows.append((key, 0, 0, 0, doc, 1000, 56, None, np.array(around, np.uint64).tobytes()))
    names = ["key", "i", "j", "mine", "doc", "at", "here", "class", "around"]
    types = [pa.int64()] * 6 + [pa.int64(), pa.int64(), pa.binary()]
    table = pa.table([pa.array(list(column), kind) for column, kind in zip(zip(*rows), types)], names=names)
    for size in (5, 1000):
        calls.clear()
        got = [pair for part in passages.whole_groups(iter(table.to_batches(max_chunksize=size))) for pair in passages.joined_places(part)]
        assert got == [(20, 1000, 21, 1000)] * 3
        assert len(calls) <= 10  # and not one for most of the 273 pairs


@pytest.mark.parametrize("part", [1 << 13, 100])
def test_words_of_long_contents_are_sent_once(spark, monkeypatch, part):
    """Pairs take along the words of the shorter content, and those of the longer one are sent once for all its pairs."""
    import numpy as np

    chance = random.Random(25)
    monkeypatch.setattr(passages, "WORDS_A_PART", part)
    prose = lambda n: [chance.randrange(1 << 32) for _ in range(n)]
    lines = [prose(60) for _ in range(30)]
    long = {1000 + n: prose(500) + [word for line in lines for word in prose(20) + line] for n in (0, -2000)}
    long[5000] = prose(300) + lines[0] + prose(90) + lines[0] + prose(20)  # as long as itself in another pair, and twice the line
    long[-5000] = prose(100) + lines[0] + prose(350)
    long |= {7000: prose(20) + lines[1] + prose(40), -7000: prose(30) + lines[1] + prose(30)}  # of one length
    contents = {n: lines[n] + prose(9) for n in range(30)} | long
    codes = {n: np.array(words, "<u4") for n, words in contents.items()}
    shingled = {n: passages.shingles_of(held.tobytes()) for n, held in codes.items()}
    pairs = [(min(doc, n), max(doc, n)) for doc in (1000, -1000) for n in range(30)] + [(-5000, 5000), (0, 5000), (-7000, 7000)]
    spots = {(a, b): [(int(i), int(j)) for i, j in np.argwhere(shingled[a][:, None] == shingled[b])[::13]] for a, b in pairs}
    table = spark.createDataFrame([(n, bytearray(held.tobytes())) for n, held in codes.items()], "same long, codes binary")
    places = spark.createDataFrame([(a, i, b, j) for (a, b), found in spots.items() for i, j in found], "a long, at_a int, b long, at_b int")

    sent = passages.sent_words(table, places).collect()
    assert sent and len({tuple(row[:3]) for row in sent}) == len(sent)
    with_pairs = [row for row in sent if row.small is not None]
    assert sorted((min(row.large, row.small), max(row.large, row.small)) for row in with_pairs) == sorted(pairs)
    assert all(len(contents[row.small]) <= len(contents[row.large]) and bytes(row.codes) == codes[row.small].tobytes() for row in with_pairs)
    assert {tuple(row[:2]) for row in with_pairs} == {tuple(row[:2]) for row in sent if row.small is None}
    assert all(bytes(row.codes) == codes[row.large].tobytes() for row in sent if row.small is None)
    if part > 5000:
        both = sum(codes[a].nbytes + codes[b].nbytes for a, b in pairs)
        assert sum(len(row.codes) for row in sent) < both / 5  # both contents of each pair were sent before

    expected = {(a, s[0], s[1] + 4, b, s[2], s[3] + 4) for (a, b), found in spots.items() for s in passages.passages_from(shingled[a], shingled[b], np.array([i << 32 | j for i, j in found]))}
    assert {tuple(row) for row in passages.passage_links(table, places).collect()} == expected and len(expected) >= len(pairs)


def test_places_go_to_blocks_with_words(spark, monkeypatch):
    """What blocks compare travels as the codes of words, half as many bytes as the shingles, with the same links."""
    import numpy as np
    import pyarrow as pa

    chance, around = random.Random(26), passages.AROUND
    prose = lambda n: [chance.randrange(1 << 32) for _ in range(n)]
    shared = prose(70)
    contents = {1: prose(5) + shared + prose(10), 2: prose(300) + shared, 3: prose(130) + shared + prose(400), 4: prose(600)}
    codes = {n: np.array(words, "<u4") for n, words in contents.items()}
    table = spark.createDataFrame([(n, bytearray(held.tobytes())) for n, held in codes.items()], "same long, codes binary")
    spots = [(9, 1, 25), (9, 2, 320), (9, 3, 150), (8, 1, 45), (8, 3, 170), (7, 4, 595), (7, 4, 1), (7, 2, 2)]
    places = spark.createDataFrame([(key, None, doc, at, at // around, 1) for key, doc, at in spots], "key long, class long, doc long, at int, part long, n_blocks long")
    wide = {tuple(row[:2]): row for row in passages.stretches_of(places, table).collect()}
    narrow = {tuple(row[:2]): row for row in passages.stretches_of(places, table, words=True).collect()}
    assert wide.keys() == narrow.keys() and len(wide) == len({(doc, at // around) for _, doc, at in spots})
    for at, row in narrow.items():
        assert row.base == wide[at].base and passages.shingles_of(bytes(row.words)).tobytes() == bytes(wide[at].shingles)
        assert len(row.words) <= len(wide[at].shingles) / 2 + 16
    rows = pa.table({"doc": list(range(len(narrow))), "around": pa.array([bytes(row.words) for row in narrow.values()], pa.binary())})
    assert passages.with_shingles(rows).column("around").to_pylist() == [bytes(wide[at].shingles) for at in narrow]
    for most in (1, 1 << 13):
        monkeypatch.setattr(passages, "PLACES", most)
        found = passages.cross_pairs(places, table)
        got = sorted(tuple(row) for row in found.collect())
        assert got == [(1, 25, 2, 320), (1, 25, 3, 150), (1, 45, 3, 170)]
    assert passages.cross_pairs(places.limit(0), table).collect() == []
