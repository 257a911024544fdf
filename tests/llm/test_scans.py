"""Licence scan, decontamination, token counts and page text."""

import hashlib
import os
import random
import time

import brute
import pytest
from compare import duck
from pyspark.sql import functions as F
from frames import frame, odd_rows  # noqa: F401

from realmwatch.llm import decontaminate
from realmwatch.llm.automaton import SuffixAutomaton
from realmwatch.llm.decontaminate import contamination, item_blocks, match_benchmark
from realmwatch.llm.html_text import extract_pages, extract_text
from realmwatch.llm.license_scan import TEMPLATES, LicenseScanner, scan_licenses
from realmwatch.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("seed", range(30))
def test_automaton_knows_exactly_the_runs(seed):
    random.seed(seed)
    texts = [[random.randrange(3) for _ in range(random.randrange(1, 12))] for _ in range(4)]
    machine = SuffixAutomaton(texts)
    runs = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    stream = [random.randrange(4) for _ in range(60)]
    for end, (_, length) in enumerate(machine.stream(stream), 1):
        best = max((k for k in range(1, 13) if tuple(stream[max(0, end - k) : end]) in runs and k <= end), default=0)
        assert length == best


def test_phrases_and_templates():
    scanner = LicenseScanner()
    found = scanner.scan("x Under the MIT License, and under the mit license; Apache License Version 2")
    assert (found.n_base, found.first, found.last, found.base) == (3, 1, 10, {"mit", "apache-2"})
    found = scanner.scan("start " + TEMPLATES["bsd"] + " end")
    assert found.labels == {"bsd"} and found.n_base == 0 and found.score == 1.0
    assert found.spans[0][:2] == (1, 1 + scanner.size["bsd"])
    changed = TEMPLATES["isc"].replace("purpose", "porpoise")
    assert scanner.scan(changed).labels == {"isc"} and 0.6 < scanner.scan(changed).score < 1
    assert scanner.scan("you may not use this file").labels == set()


@pytest.mark.parametrize("label", sorted(TEMPLATES))
def test_each_template_has_its_own_label_only(label):
    found = LicenseScanner().scan(f"words before {TEMPLATES[label]} words after, {TEMPLATES[label]}")
    assert found.labels == {label} and found.score == 1.0
    assert [s[2:] for s in found.spans] == [(label, 1.0)] * 2


def test_related_licences_are_no_templates():
    found = LicenseScanner().scan
    for label, old, new in (("gpl", "General", "Library General"), ("cc-by", "Attribution", "Attribution-NoDerivs")):
        assert found(TEMPLATES[label].replace(old, new)).labels == set()
    assert found(TEMPLATES["gpl"].replace("version 3", "version 2")).labels == {"gpl"}
    both = found(TEMPLATES["zlib"] + " some words between the two " + TEMPLATES["lgpl"])
    assert both.labels == {"zlib", "lgpl"} and len(both.spans) == 2


def test_spans_of_changed_templates():
    """A template with a foreign word in every 19 is found where it stands, its cover near the share of words left."""
    scanner, draw = LicenseScanner(), random.Random(5)
    for label, text in TEMPLATES.items():
        template = brute.words(text)
        at = draw.randrange(5, 40)
        changed = [w if i % 19 != 9 or i > len(template) - 6 else "zzz" for i, w in enumerate(template)]
        found = scanner.scan(" ".join(["qqq"] * at + changed + ["qqq"] * 9))
        if len(template) >= 19:
            assert [s[:3] for s in found.spans] == [(at, at + len(template), label)]
            kept = sum(a == b for a, b in zip(changed, template, strict=True))
            assert abs(found.score - kept / len(template)) < 0.2


def test_license_scan_against_plain_search(spark):
    rows = QUERIES["op3_license_scan"](spark, SF_DIR).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    for r in rows:
        w = brute.words(texts[r.doc_id])
        at = sorted((i, l) for p, l in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
        assert (r.n_words, r.n_base) == (len(w), len(at))
        assert (r.first_word, r.last_word) == ((at[0][0], at[-1][0]) if at else (None, None))
        assert r.base_labels == ",".join(sorted({l for _, l in at})) and 0 <= r.score <= 1


def test_license_scan_of_odd_rows(frame, odd_rows):
    rows = scan_licenses(frame(odd_rows)).collect()
    assert len(rows) == len(odd_rows)
    assert {(r.n_words, r.labels) for r in rows if r.doc_id in (1, 2, 3)} == {(0, "")}
    assert scan_licenses(frame([])).count() == 0


def test_decontamination_against_sql(spark):
    con = duck(SF_DIR)
    relation = con.sql(ORACLES["op9_decontamination"])
    names = sorted(relation.columns)
    order = [relation.columns.index(n) for n in names]
    want = sorted(tuple(r[i] for i in order) for r in relation.fetchall())
    got = sorted(tuple(r) for r in QUERIES["op9_decontamination"](spark, SF_DIR).select(*names).collect())
    assert got == want


def test_blocks_at_one_address_have_matchers_of_their_own(monkeypatch):
    """A worker drops one broadcast and gets the next one at the same address."""
    made = []
    monkeypatch.setattr(decontaminate, "map_texts", lambda docs, text, keep, rows, fields: made.append(rows))
    place = [None]

    class Docs:
        class sparkSession:
            class sparkContext:
                @staticmethod
                def broadcast(value):
                    return type("Sent", (), {"value": place})

    monkeypatch.setattr(decontaminate, "ItemMatcher", lambda item: type("M", (), {"match": lambda s, t: (1, [], {item})})())
    for item in ("one", "two"):
        decontaminate._match_block(Docs, "t", [], [], 13)
        place[0] = item
        assert made[-1](["text"])[2] == [[item]]


@pytest.mark.parametrize("block_words", [2_000_000, 3])
def test_decontamination_against_plain_search(spark, frame, odd_rows, block_words):
    random.seed(block_words)
    pool = [f"a{i}" for i in range(30)]
    items = [(i, " ".join(random.choice(pool) for _ in range(random.choice([3, 12, 13, 14, 30])))) for i in range(12)]
    items += [(None, items[0][1]), (50, ""), (51, None), (1, items[1][1])]
    texts = []
    for i in range(40):
        parts = [random.choice(pool) for _ in range(random.randrange(40))]
        if i % 2:
            words = random.choice(items)[1] or ""
            parts[3:3] = words.split()[random.randrange(3) :]
        texts.append((100 + i, " ".join(parts), "s"))
    rows = odd_rows + texts
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    if block_words == 3:
        assert len(item_blocks(benchmark, "item_id", "text", block_words)) > 3
    matched = match_benchmark(frame(rows), benchmark, ["doc_id"], block_words=block_words)
    got = sorted(
        (str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
        for r in contamination(matched).collect()
    )
    want = []
    for (i, *_), (n, hit, ids) in zip(rows, brute.contamination([t for _, t, _ in rows], items), strict=True):
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        want.append((str(i), n, hit, len(ids), digest, hit > 0 and 20 * hit >= n))
    assert got == sorted(want)
    empty = match_benchmark(frame(rows), benchmark.limit(0), ["doc_id"])
    assert contamination(empty).where("contaminated OR n_hit > 0").count() == 0


@pytest.fixture(scope="module")
def tokenizers():
    tokenizers = pytest.importorskip("tokenizers")
    places = pytest.importorskip("public_tokenizers")
    path = places.path("byte_bpe_50k.json")
    from realmwatch.llm.token_count import TextCounter

    with open(path, encoding="utf-8") as file:
        return tokenizers.Tokenizer.from_file(path), TextCounter(file.read())


def test_token_counts_against_the_library(tokenizers, spark):
    library, counter = tokenizers
    parts = " |  |\n|\t|'|'s|'re|'r|'ll|'l|don't|é|漢|🙂|1|23|!|...|<|endoftext|>|<|endoftext|a|The|ing| |　|\u0085|٣|²|x'|''".split("|")
    parts += ["<|endoftext|>", "<|endoftext"]
    random.seed(5)
    texts = ["".join(random.choice(parts) for _ in range(random.randrange(30))) for _ in range(3000)]
    texts += [r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    texts += ["a" * 3000, "ab" * 2000 + " " * 500 + "\n" * 77, "0123456789" * 300]
    want = [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [n for _, n in counter.count(texts)] == want


def test_token_counts_survive_forgetting(tokenizers):
    library, counter = tokenizers
    counter.pieces.most = 10
    texts = [f"some words number {i} here" for i in range(50)]
    assert [counter.count([t])[0][1] for t in texts] == [len(library.encode(t, add_special_tokens=False)) for t in texts]
    counter.pieces.most = 200_000


def test_token_query_of_odd_rows(spark, frame, odd_rows, tokenizers):
    from realmwatch.llm.token_count import count_tokens

    import public_tokenizers

    library, _ = tokenizers
    rows = count_tokens(frame(odd_rows), public_tokenizers.path("byte_bpe_50k.json"), limit=3).collect()
    texts = [t or "" for _, t, _ in odd_rows]
    want = sorted((len(t.encode()), n := len(library.encode(t, add_special_tokens=False)), n > 3) for t in texts)
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == want
    assert os.path.exists(public_tokenizers.path("byte_bpe_50k.json"))


ARTICLE = """<html><head><title>T</title><style>p{}</style></head><body><header><a href=/>Home</a></header>
<nav><ul><li>One<li>Two</ul></nav><article><h1>A  headline</h1><p>First <b>para</b>graph &amp; more words
over two lines<p>Second<br>part<ul><li>item</li></ul><div class="comments"><p>I like this</p></div>
<aside>see also</aside></article><div class="cookie-notice">We use cookies</div><form><label>Mail</label></form>
<footer>&copy; 2024</footer><script>if (a < b) "</p>"</script></body></html>"""


def test_page_text():
    assert extract_text(ARTICLE) == (
        "A headline\n\nFirst paragraph & more words over two lines\n\nSecond part\n\nitem"
    )


def test_page_without_article_element():
    page = "<body><div id=menu><a>x</a></div><div class=post>" + "<p>some long content words here</p>" * 4
    page += "<p>Yes.</p></div><div class=sidebar>" + "<p>more</p>" * 9 + "</div></body>"
    assert extract_text(page) == "\n\n".join(["some long content words here"] * 4 + ["Yes."])


def test_layout_around_the_article():
    page = '<body class="with-sidebar"><div class="layout has-sidebar"><article><p>Text</p></article></div>'
    assert extract_text(page + '<div class="left-sidebar">x</div>') == "Text"


STORY = ["The river begins high up in the mountains, where the snow melts in spring.", "It ends in the sea.",
         "On its way it passes three towns, and in each of them a mill once stood at its bank."]
TEASER = "<p>Another story, of a lake, that you may want to read as well.</p>"
AROUND = ["<nav><a>Home</a> <a>News</a></nav>", "<footer>&copy; 2024 All rights reserved by the people of the river</footer>",
          "<div class=cookie-banner>We use cookies to show you what you like, and only then.</div>",
          "<section id=comments><p>I have been there, and it is as you say it is.</p></section>"]


def _paragraphs(lines: list[str]) -> str:
    return "".join(f"<p>{x}</p>" for x in lines)


@pytest.mark.parametrize("wrap", [
    "<article>{}</article>", "<main>{}</main>", "<div>{}</div>", "<form>{}</form>", "<div class=popular-science>{}</div>",
    "<div id=search-engine-history>{}</div>", "<div class='overflow-hidden'><form class=search>{}</form></div>",
    TEASER.join(["<article>", "</article>"]) + "<main>{}</main>", TEASER.join(["<article>", "</article>"]) + "<div>{}</div>",
    "<div class=related>" + TEASER + "</div><main>{}</main>", "<main><div>{}</div></main><article>" + TEASER + "</article>",
    "<article>{}</article><article class=comment>" + TEASER + "</article>",
])
@pytest.mark.parametrize("seed", range(4))
def test_layouts(wrap, seed):
    draw = random.Random(seed)
    lines = draw.choices(STORY, k=6) + STORY
    before, after = ("".join(x for x in AROUND if draw.random() < 0.7) for _ in range(2))
    assert extract_text(f"<body>{before}{wrap.format(_paragraphs(lines))}{after}</body>") == "\n\n".join(lines)


def test_articles_beside_each_other():
    page = "".join(f"<article>{_paragraphs(STORY[k:])}</article>" for k in range(3))
    assert extract_text(AROUND[0] + page + AROUND[1]) == "\n\n".join(STORY + STORY[1:] + STORY[2:])
    assert extract_text(AROUND[0] + AROUND[1] + "<div class=share>Share this</div>") == ""


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "x", "<div><p>a</b></p>" * 20_000, "<b>" * 20_000 + "<p>a</p>" * 20_000])
def test_deep_pages_take_linear_time(page):
    started = time.process_time()
    assert extract_text(page)
    assert time.process_time() - started < 20


@pytest.mark.parametrize("page", ["", None, "<", "<!-- cut", "<p", "<script>x", "</div></p>", "&am", "<a><b><i>" * 300])
def test_broken_pages(page):
    assert "<" not in extract_text(page) or page == "<"


def test_pages_query(spark):
    rows = QUERIES["op4_html_text"](spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/pages.parquet").count()
    assert all(r.n_chars == len(r.text) > 0 for r in rows)
    odd = spark.createDataFrame([(1, None, None, "x"), (None, "u", "", "x")], "page_id long, url string, html string, text string")
    assert [r.text for r in extract_pages(odd, ["page_id", "url"]).collect()] == ["", ""]
    assert extract_pages(odd.where(F.lit(False)), ["page_id", "url"]).count() == 0
