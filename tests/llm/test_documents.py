"""Joins, extraction, personal data, mixing, language and sharding against plain computations."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.checks.compare import compare, connect
from tidemart.llm import ngram_join
from tidemart.llm.common import components, ranked, wide_key
from tidemart.llm.html_text import main_text, smooth, threshold
from tidemart.llm.language import (
    UNDETERMINED, Scorer, WordBackoff, fit, held_out, letters, reject_unknown, training_rows)
from tidemart.llm.mixing import mix, source_targets, systematic_copies
from tidemart.llm.ngram_join import chosen_paths, one_of_each, similarity_classes
from tidemart.llm.pii import find_pii, redact
from tidemart.llm.queries import ORACLE_SQL, QUERIES
from tidemart.llm.sharding import shard_rows

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, texts, extra=""):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    assert compare(spark, connect(FOLDER), QUERIES[name], ORACLE_SQL[name], FOLDER) is None


# ---- helpers ----

def test_ranked_with_a_hot_group(spark):
    rows = [("hot", i % 7, i) for i in range(3000)] + [(g, 1, i) for i, g in enumerate("aabbb")] + [(None, 0, 1)]
    df = spark.createDataFrame(rows, "g string, v int, i int")
    got = ranked(df, ["g"], [F.col("v").desc(), F.col("i")], "at", part_rows=200).collect()
    by = defaultdict(list)
    for r in got:
        by[r["g"]].append(r)
    for group in by.values():
        group.sort(key=lambda r: (-r["v"], r["i"]))
        assert [r["at"] for r in group] == list(range(len(group)))
    assert len(got) == len(rows)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i) for i in range(40)] + [(i + 1, i) for i in range(40)]
    star = [(100 + i, 7777) for i in range(200)]
    got = components(spark.createDataFrame(chain + star, "n long, h long"), "n", "h").collect()
    assert {r["component"] for r in got if r["n"] <= 40} == {0}
    assert {r["component"] for r in got if r["n"] >= 100} == {100}


# ---- n-gram join ----

def shingle_set(text):
    words = re.findall(r"\w+", (text or "").lower())
    n = min(5, len(words))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def brute_classes(texts):
    sets = [shingle_set(t) for t in texts]
    different = sorted(set(sets) - {frozenset()}, key=sorted)
    links = defaultdict(set)
    for i, a in enumerate(different):
        for b in different[i + 1:]:
            if Fraction(len(a & b), len(a | b)) >= Fraction(4, 5):
                links[a].add(b)
                links[b].add(a)
    seen, cls = {}, {}
    for s in different:
        if s in seen:
            continue
        todo, group = [s], set()
        while todo:
            x = todo.pop()
            if x not in group:
                group.add(x)
                todo += links[x]
        least = min(i for i, x in enumerate(sets) if x in group)
        for x in group:
            seen[x], cls[x] = True, least
    return [(i, cls.get(s, i), sets.index(s) if s else i, sets.count(s) if s else 1, len(links[s]))
            for i, s in enumerate(sets)]


def near_texts(seed=0):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choices(words, k=120)) for _ in range(12)]
    shared = " ".join(rng.choices(words, k=40))
    texts = list(base) + [base[0]] * 15 + [base[1].upper() + "!"] + [None, "", "...", "few words", "Few  words"]
    for b in base[:6]:  # near copies around the threshold
        for k in (1, 2, 3, 4):
            w = b.split()
            for at in rng.sample(range(len(w)), k):
                w[at] = "changed"
            texts.append(" ".join(w))
    texts += [f"{' '.join(rng.choices(words, k=150))} {shared}" for _ in range(30)]
    w = base[7].split()
    for i in range(40):  # a group of near copies that differ in one word each
        texts.append(" ".join([*w[:60], f"unique{i}", *w[61:]]))
    return texts


@pytest.mark.parametrize("limit", [8, 512])
def test_join_equals_brute_force(spark, limit, monkeypatch):
    monkeypatch.setattr(ngram_join, "BUCKET_ROWS", limit)  # small: deeper levels and blocks
    monkeypatch.setattr(ngram_join, "SET_BLOCK", limit * 2)
    texts = near_texts()
    got = similarity_classes(docs_frame(spark, texts)).collect()
    assert sorted(tuple(r) for r in got) == brute_classes(texts)


def test_hot_group_of_near_copies_costs_a_constant_per_set(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BUCKET_ROWS", 16)
    monkeypatch.setattr(ngram_join, "SET_BLOCK", 32)
    blocks = []
    open_units = ngram_join._open_units

    def counted(members):
        units = open_units(members)
        blocks.append((members.count(), units.count()))
        return units

    monkeypatch.setattr(ngram_join, "_open_units", counted)
    rng = random.Random(6)
    words = [f"w{i}" for i in range(900)]
    base = rng.choices(words, k=300)
    texts = [" ".join([*base[:200], f"unique{i}", *base[201:]]) for i in range(300)]
    assert sorted(tuple(r) for r in similarity_classes(docs_frame(spark, texts)).collect()) == [
        (i, 0, i, 1, 299) for i in range(300)]
    assert blocks and all(units == 0 for _, units in blocks)  # every set met the representatives alone
    # Twenty sets at the border meet all others in blocks, the core still does not meet itself.
    blocks.clear()
    for i in range(20):
        w = list(base)
        for at in rng.sample(range(0, 300, 10), 9):
            w[at] = f"other{i}"
        texts.append(" ".join(w))
    got = similarity_classes(docs_frame(spark, texts)).collect()
    assert sorted(tuple(r) for r in got) == brute_classes(texts)
    assert blocks[-1][1] < 3 * blocks[-1][0]


def short_texts(seed=0):
    """Short texts of unlike words under two common lines, some with near copies."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(5000)]
    lines = "some rights of this text reserved by its author", "all words of this text go under the common license"
    texts = [f"{rng.choice(lines)} {' '.join(rng.choices(words, k=rng.randint(18, 30)))}" for _ in range(300)]
    return texts + [f"{t} {rng.choice(words)}" for t in texts[:20]] + ["a b c d e f g h i", "a b c d e f g h i j"]


@pytest.mark.parametrize("limit", [64, 512])
def test_short_texts_under_a_common_line_are_no_candidates(spark, limit, monkeypatch):
    """They were one group, whose pairs were all compared."""
    monkeypatch.setattr(ngram_join, "BUCKET_ROWS", limit)
    largest, links = [], ngram_join._links

    def counted(docs, own, near):
        largest.append(near.groupBy("component").count().agg(F.max("count")).first()[0])
        return links(docs, own, near)

    monkeypatch.setattr(ngram_join, "_links", counted)
    texts = short_texts()
    got = sorted(tuple(r) for r in similarity_classes(docs_frame(spark, texts)).collect())
    assert got == brute_classes(texts)
    assert sum(r[4] for r in got) == 42
    assert sorted(r["doc_id"] for r in one_of_each(docs_frame(spark, texts)).collect()) == sorted({r[1] for r in got})
    assert largest == [2, 2]


def test_sketches_of_small_sets_pass_every_pair_at_the_threshold():
    rng = np.random.default_rng(5)
    for size in [*range(1, 80), 120]:
        for _ in range(30):
            a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            common = rng.integers(0, size + 1)
            b = np.concatenate([a[:common], rng.integers(0, 1 << 63, rng.integers(0, size // 4 + 1), dtype=np.uint64)])
            if not len(b):
                continue
            linked = common >= 0.8 * (len(a) + len(b) - common) - 1e-9
            table = np.frombuffer(ngram_join.sketch(a) + ngram_join.sketch(b), np.uint16).reshape(2, -1)
            near = ngram_join._near(table, np.array([len(a), len(b)], np.int32), np.array([0]), np.array([1]))
            assert near.shape == (1, 1) and (near.all() or not linked)
            assert not near.any() or min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) - 1e-9


def test_one_document_of_each_class(spark):
    texts = near_texts(1)
    docs = docs_frame(spark, texts).withColumn("__row_key", F.lit(1)).withColumn("path", F.lit("x"))
    docs = docs.unionByName(docs.filter("doc_id in (0, 3)"))  # repeated rows
    got = one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] for r in got.collect()) == sorted({c[1] for c in brute_classes(texts)})


def test_join_of_nothing_and_null_ids(spark):
    empty = spark.createDataFrame([], DOCS)
    assert similarity_classes(empty).count() == 0
    assert one_of_each(empty).count() == 0
    docs = spark.createDataFrame([(None, "a b c d e f", None, None, None)] * 3 + [(None, None, None, None, None)], DOCS)
    rows = similarity_classes(docs).collect()
    assert sorted((r["n_copies"], r["n_links"]) for r in rows) == [(1, 0), (3, 0), (3, 0), (3, 0)]
    assert one_of_each(docs).count() == 2


def test_runs_reach_the_recall_at_the_last_level():
    found = 1.0
    for _ in range(ngram_join.DEPTH):  # 1.25 choices, 0.8 of them shared
        found = 1 - math.exp(-found)
    assert 1 - (1 - found) ** ngram_join.RUNS >= ngram_join.TARGET_RECALL


def test_paths_of_similar_sets_meet():
    rng = np.random.default_rng(0)
    met = 0
    for _ in range(60):
        tokens = rng.integers(0, 2 ** 63, 540).astype(np.uint64)
        a, b = np.unique(tokens[:480]), np.unique(np.concatenate([tokens[:426], tokens[480:534]]))
        first, second = chosen_paths(a), chosen_paths(b)
        met += all(np.intersect1d(x[1], y[1]).size for x, y in zip(first, second, strict=True))
    assert met >= 59  # similarity 0.8: twelve runs reach the third level together


# ---- HTML ----

PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><div class="ad">Buy now, really</div>
<div class="cookie-notice"><p>We use cookies on this site to make it better for all readers of it.</p></div>
<{tag}><h1>A &amp; B</h1><p><b>First long paragraph with   many words,<br>and a <a href="x">link</a> in it.<p>Of.
<form><p>Your name</p><input></form><p>Last paragraph &copy; 2020&nbsp;here.</p>
<div id="comments"><p>I liked this article a lot and wanted to say so at great length.</p></div></{tag}>
<aside>See also</aside><footer>&copy; host &middot; imprint</footer></body></html>"""
TEXT = "A & B\n\nFirst long paragraph with many words, and a link in it.\n\nOf.\n\nLast paragraph © 2020 here."


@pytest.mark.parametrize("tag", ["article", "main", 'div class="content"'])
def test_main_text_of_a_page(tag):
    page = PAGE.replace("{tag}", tag, 1).replace("{tag}", tag.split()[0])
    assert main_text(page) == TEXT


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<p></p><script>x</script>") == ""
    assert main_text("just text &lt;3") == "just text <3"
    assert main_text("<body><p>one two</p><p>three") == "one two\n\nthree"
    assert main_text("<article><p>cut off &am") .startswith("cut off")
    assert len(main_text("<article><p>" + "word " * 200_000)) == 999_999
    assert main_text("<p>" * 3000 + "deep" + "</div>" * 10) == "deep"


def test_comments_as_articles_and_pages_in_a_form():
    comment = '<article class="comment"><p>I liked this a lot and want to say so at great length, again and again.</p></article>'
    inside = f"<body><article><h1>A</h1><p>{LONG}</p><p>{LONG}</p>{comment}{comment}</article></body>"
    beside = f"<body><article><h1>A</h1><p>{LONG}</p><p>{LONG}</p></article>{comment.replace('again', LONG * 9)}</body>"
    main = f"<main><h1>A</h1><p>{LONG}</p><p>{LONG}</p>{comment}</main>"
    for page in (inside, beside, main):
        assert main_text(page) == f"A\n\n{LONG}\n\n{LONG}"
    assert main_text(f'<body><article class="comment post"><p>{LONG}</p></article></body>') == LONG  # no other one
    form = f"<form><header>Site</header><article><p>{LONG}</p><select><option>x</select></article><footer>f</footer></form>"
    assert main_text(f"<body>{form}</body>") == LONG
    assert main_text(f"<body><article><p>{LONG}</p><form><p>Your name</p><input></form></article></body>") == LONG


def test_deep_pages_in_time():
    start = time.time()
    deep = "<div>" * 50_000
    assert main_text(f"<article>{deep}<p>{LONG}</p>") == LONG
    mixed = "".join(f"<div><span><p>word {i}</b></i>" for i in range(20_000))
    assert main_text(f"<article>{mixed}").count("word") == 20_000
    assert time.time() - start < 20


LONG = "A long paragraph of the article, which says what there is to say, and then a little more of it."


@pytest.mark.parametrize("open_tag", ["<article>", "<main><article>", '<div class="post">'])
@pytest.mark.parametrize("inside", [
    f"<h1>Title</h1><p class=lead>Short lead.</p><div class=body>{'<p>' + LONG + '</p>'}{'<p>' + LONG * 3 + '</p>'}</div>",
    f"<section><h2>One</h2>{('<p>' + LONG + '</p>') * 17}</section><section><h2>Two</h2>{('<p>' + LONG + '</p>') * 3}</section>",
    f"<p>Before it.</p><ul>{('<li>' + LONG + '</li>') * 20}</ul><p>After it.</p>",
    f"<p>Before it.</p><table>{('<tr><td>' + LONG + '</td></tr>') * 20}</table><p>After it.</p>",
    f"<p>Before it.</p><section>{('<p>' + LONG + '</p>') * 20}</section><p>After it.</p>"])
def test_all_of_an_article(open_tag, inside):
    page = f"<body><nav><a href=x>Home</a></nav>{open_tag}{inside}</body>"
    want = [t for t in re.split(r"<[^>]*>", inside) if t]
    assert main_text(page).split("\n\n") == want


def test_all_of_a_page_without_a_container():
    items = "<ul><li>one</li><li>two</li></ul><table><tr><td>3</td><td>4</td></tr></table><div><a href=x>A link</a></div>"
    page = f"<body><ul><li><a href=x>Home</a></li></ul><h1>T</h1><p>{LONG}</p>{items}<p>{LONG}</p><ul><li>end</li></ul></body>"
    assert main_text(page).split("\n\n") == ["T", LONG, "one", "two", "3", "4", "A link", LONG, "end"]


@pytest.mark.parametrize("wrapper", [
    'div class="content has-sidebar"', 'div class="with-nav"', 'div class="hentry comments-open"',
    'div class="sidebar-right"', 'section id="related-work"', 'div id="comments"'])
@pytest.mark.parametrize("article", ["article", "main", 'article class="post comments-open"', "div"])
def test_names_of_wrappers(wrapper, article):
    inside = f"<{article}><h1>Title</h1>{('<p>' + LONG + '</p>') * 4}</{article.split()[0]}>"
    around = f"<div class=ad>Buy</div><div id=comments><p>{LONG}</p></div><div class=share-links><a href=x>Share</a></div>"
    page = f"<body><nav>Home</nav><{wrapper}>{inside}</{wrapper.split()[0]}>{around}</body>"
    assert main_text(page).split("\n\n") == ["Title", *[LONG] * 4]
    page = f"<body><nav>Home</nav><main><{wrapper}>{inside}{around}</{wrapper.split()[0]}></main></body>"
    assert main_text(page).split("\n\n") == ["Title", *[LONG] * 4]


def test_names_inside_an_article():
    page = (f"<article><h1>Title</h1>{('<p>' + LONG + '</p>') * 4}<section id=related-work><h2>Related work</h2>"
            f"<p>{LONG * 2}</p></section><div class=comment-list><p>{LONG}</p></div></article>"
            f"<div class=related><article>{LONG}</article></div><section class=comments>"
            f"<article class=comment>{LONG * 40}</article></section>")
    assert main_text(page).split("\n\n") == ["Title", *[LONG] * 4, "Related work", LONG * 2]
    assert main_text(f"<div class=sidebar><p>{LONG}</p></div>") == LONG


def test_smoothing_and_threshold():
    assert np.allclose(smooth(np.full(9, 3.0)), 3.0)
    assert 1 < threshold(np.array([1.0, 1.2, 9.0, 8.5])) < 8.5
    assert threshold(np.array([2.0])) == 2.0


def test_pages_of_the_table(spark):
    import html as names

    rows = QUERIES["op4_html_text"](spark, FOLDER).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        inside = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S).group(1)
        blocks = [" ".join(names.unescape(re.sub("<[^>]*>", " ", b)).split())
                  for b in re.split(r"</?(?:p|h1)>", inside)]
        assert r["text"] == "\n\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


# ---- personal data ----

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def brute_spans(text):
    out = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and any(int(p) > 255 for p in m.group().split("."))
                    or kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits))
                    or kind == "phone" and not 8 <= len(digits) <= 15):
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def odd_texts():
    rng = random.Random(2)
    texts = [None, "", "a@b.c_d@e.f x@y", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004", "++1 (017) 555-5036 +12 3",
             "4111 1111 1111 1111 and 4111-1111-1111-1112 0", "🙂 é me@x.org 10.0.0.1", "a" * 50_000 + "@", "1" * 30_000,
             "1 " * 20_000, "." * 1000 + "@a.b"]
    letters = list("a1@.-+ ()_%0425é🙂\n")
    texts += ["".join(rng.choices(letters, k=rng.randint(1, 120))) for _ in range(400)]
    return texts


def test_base_spans_equal_the_plain_patterns(spark):
    texts = odd_texts()
    got = {r["doc_id"]: [f"{s['kind']}:{s['start']}:{s['end']}" for s in r["base"]]
           for r in find_pii(docs_frame(spark, texts)).collect()}
    for i, text in enumerate(texts):
        assert sorted(got[i]) == sorted(brute_spans(text)), repr(text)[:200]


def test_query_over_the_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in QUERIES["op5_pii"](spark, FOLDER).collect():
        base = brute_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(filter(None, r["spans"].split(",")))
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [
            sum(s.startswith(k) for s in base) for k, _ in PATTERNS]


def test_contexts_discover_unseen_identifiers(spark):
    texts = [f"Please call me at +1 555 000 {i:04d} today" for i in range(1000, 1006)]
    texts += ["Please call me at 0175550001 today", "the year was 20240101 then", "Room number was 20240102 then"]
    texts += [f"mail was {w} then" for w in ("word", "other")]
    found = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in find_pii(docs_frame(spark, texts)).collect()}
    assert found[6] == [("phone", 18, 28)]
    assert all(not found[i] for i in range(7, 11))


def added_texts(spark, texts):
    """Per text the (kind, text) of the spans that no format has."""
    rows = {r["doc_id"]: r for r in find_pii(docs_frame(spark, texts)).collect()}
    return [[(s["kind"], t[s["start"]:s["end"]]) for s in rows[i]["spans"] if s not in rows[i]["base"]]
            for i, t in enumerate(texts)]


def test_contexts_discover_identifiers_with_spaces(spark):
    phones = [f"Please call me at +1 555 000 {i:04d} today" for i in range(1000, 1020)]
    cards = [f"Pay by card {c} please" for c in ("4111 1111 1111 1111", "5500 0000 0000 0004", "4012 8888 8888 1881",
                                                 "6011 0000 0000 0004", "4222 2222 2222 2220", "4000 0566 5566 5556")]
    texts = ["Please call me at 555 123 4567 today", "Please call me at (555) 123-4567 today",
             "Please call me at 555.123.4567, or not", "Pay by card 4111 1111 1111 1112 please",
             "Please call me at +1 (826) 555-4081 190.137.223.204", "Nothing of 12 34 here"]
    assert added_texts(spark, phones + cards + texts)[len(phones + cards):] == [
        [("phone", "555 123 4567")], [("phone", "(555) 123-4567")], [("phone", "555.123.4567")],
        [("card", "4111 1111 1111 1112")], [("phone", "+1 (826) 555-4081")], []]


def test_contexts_after_and_at_the_ends_of_texts(spark):
    texts = [f"+1 555 000 {i:04d} is my number" for i in range(1000, 1012)]
    texts += [f"Phone: +1 555 001 {i:04d}" for i in range(1000, 1012)]
    texts += ["555 123 4567 is my number", "Phone: 555 765 4321", "Well, 555 123 9999 is my number", "In 2024"]
    assert added_texts(spark, texts)[24:] == [[("phone", t)] for t in ("555 123 4567", "555 765 4321", "555 123 9999")] + [[]]


def test_found_identifiers_are_seeds_of_further_patterns(spark):
    texts = [f"one {i} Please call me at +1 555 000 {i} on day {i}" for i in range(1000, 1040)]
    texts += [f"two {i} Please call me at 555 777 {i} on day {i}" for i in range(1000, 1004)]
    texts += [f"three {w} my new fax 555 777 {i} is the line" for w, i in zip("abcd", range(1000, 1004), strict=True)]
    texts += ["four my new fax 555 999 1234 is the line", "five the old fax 555 999 1234 had no line"]
    got = added_texts(spark, texts)
    assert got[40:44] == [[("phone", f"555 777 {i}")] for i in range(1000, 1004)]
    assert got[44:] == [[("phone", f"555 777 {i}")] for i in range(1000, 1004)] + [[("phone", "555 999 1234")], []]


def test_redaction(spark):
    texts = [None, "", "clean text", "🙂 mail me@x.org, ip 10.0.0.1 or +1 (017) 555-5036.", "4111 1111 1111 1111"]
    docs = docs_frame(spark, texts).withColumn("__spans", F.lit("kept"))
    got = {r["doc_id"]: r for r in redact(docs).collect()}
    assert redact(docs).columns == docs.columns
    assert [got[i]["text"] for i in range(5)] == [
        None, "", "clean text", "🙂 mail [EMAIL], ip [IP] or [PHONE].", "[CARD]"]
    assert all(got[i]["n_chars"] == len(got[i]["text"] or "") for i in range(5))
    assert redact(docs.limit(0)).count() == 0


# ---- mixing ----

def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: Fraction(i % 3 + 1) for i, s in enumerate(order)}
    rest, free, out = Fraction(sum(sizes.values())), set(order), {}
    while free:
        level = rest / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not full:
            out.update({s: level * weight[s] for s in free})
            break
        for s in full:
            out[s] = Fraction(3 * sizes[s])
            rest -= out[s]
        free -= full
    return out


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1000, "b": 1, "c": 2, "d": 500, None: 3},
                                   {"x": 0, "y": 7, None: 0}, {"é": 5, "z": 50, "Z": 5000}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    want = brute_targets(sizes)
    for r in source_targets(frame).collect():
        assert math.isclose(r["target"], float(want[r["source"]]), rel_tol=1e-12, abs_tol=1e-12)


def test_numerals_are_no_letters(spark):
    assert letters("½ ² Ⅷ ① x²y Ä") == ["x", "y", "ä"]
    model = fit(docs_frame(spark, ["ein Wort und noch eins"] * 5).withColumn("lang", F.lit("de")))
    scorer = Scorer(model)
    assert scorer.judge("½ ²")[0] == scorer.judge("Ⅷ 3 _")[0] == UNDETERMINED != scorer.judge("wort²")[0]


def test_personal_data_of_a_text_rich_in_matches(spark):
    parts = [f"write to user{i}@host{i % 7}.example or +1 555 010 {1000 + i % 9000} and 10.0.{i % 256}.{i % 99}, " for i in range(13_400)]
    text = "".join(parts)  # a megabyte
    start = time.time()
    docs = docs_frame(spark, [text, "é" * 9000 + parts[0] + "ü" * 5000 + parts[1]])
    rows = {r["doc_id"]: r["base"] for r in find_pii(docs).collect()}
    assert [sum(s["kind"] == k for s in rows[0]) for k in ("email", "ip", "phone")] == [13_400] * 3
    for at, source in ((0, text), (1, docs.collect()[1]["text"])):
        for s in rows[at]:
            assert (source[s["start"]] in "u+1") and source[s["start"] - 1] == " "[:s["start"]] or s["start"] == 0
    clean = {r["doc_id"]: r["text"] for r in redact(docs).collect()}
    assert clean[0].count("[EMAIL]") == clean[0].count("[IP]") == 13_400 and "@" not in clean[0]
    assert clean[1] == "é" * 9000 + "write to [EMAIL] or [PHONE] and [IP], " + "ü" * 5000 + \
        "write to [EMAIL] or [PHONE] and [IP], "
    assert time.time() - start < 120


def test_copies_near_the_target(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["hot"] * 6 + ["b", "c", None]), int(rng.paretovariate(1.2) * 20)) for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long").withColumn("copies_of", F.lit(1))
    got = systematic_copies(frame, ["doc_id"]).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(3000))
    again = systematic_copies(frame.repartition(7), ["doc_id"]).collect()
    assert {r["doc_id"]: r["copies"] for r in got} == {r["doc_id"]: r["copies"] for r in again}
    taken, largest = Counter(), defaultdict(int)
    for r in got:
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for r in got:
        assert abs(taken[r["source"]] - r["target"]) <= largest[r["source"]]


def test_each_source_takes_the_nearest_of_sixteen_offsets(spark):
    rng = random.Random(11)
    rows = [(i, source, rng.randint(1, 900)) for i, source in enumerate([*"aabbbccccddddd", *"efgh" * 7, *[None] * 6])]
    got = systematic_copies(spark.createDataFrame(rows, "doc_id long, source string, size long"), ["doc_id"]).collect()
    by_source = defaultdict(list)
    for r in got:
        by_source[r["source"]].append(r)

    def md5(*parts):
        return hashlib.md5("|".join(str(p) for p in parts if p is not None).encode()).hexdigest()

    for source, found in by_source.items():
        found.sort(key=lambda r: (-r["size"], md5(29, r["doc_id"])))
        target, f = found[0]["target"], found[0]["target"] / found[0]["source_size"]
        totals = []
        for j in range(16):
            u = int(md5("29", j, source)[:5], 16) / 2**20
            totals.append(sum(r["size"] * min(math.floor((i + 1) * f + u) - math.floor(i * f + u), 3)
                              for i, r in enumerate(found)))
        taken = sum(r["size"] * r["copies"] for r in found)
        assert math.isclose(abs(taken - target), min(abs(t - target) for t in totals), abs_tol=1e-6), source


def test_mix_repeats_documents(spark):
    rows = [(i, f"{'w ' * (i % 9 + 1)}", "en", "abc"[i % 3], 1) for i in range(90)]
    rows += [(500, "same text", "en", "a", 1)] * 4 + [(None, None, None, None, None), (7, "", None, "e", 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("kept")).withColumn("__all", F.lit(9))
    got = mix(docs)
    assert got.columns == docs.columns
    counts = Counter(tuple(r) for r in got.collect())
    plain = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit("[^ ]+")), F.lit(0))
                        .cast("long").alias("size"), wide_key("doc_id", "source", "text").alias("key"))
    copies = systematic_copies(plain, ["key"]).groupBy("doc_id").agg(F.sum("copies").alias("n")).collect()
    by_doc = Counter()
    for row, n in counts.items():
        by_doc[row[0]] += n
    assert by_doc == Counter({r["doc_id"]: r["n"] for r in copies if r["n"]})
    assert mix(docs.limit(0)).count() == 0


# ---- language ----

def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: (r["lang"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op9_language_id"](spark, folder).collect()
    assert len(rows) == len(lang)
    hits = total = 0
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
        if r["held_out"]:
            total += 1
            hits += r["lang_pred"] == lang[r["doc_id"]][0]
    assert total > 200 and hits / total > 0.98


def test_texts_in_an_unlearned_script_go(spark):
    texts = ["a plain text of words", "обычный текст", "日本語 123", "mostly русский", "zzz qqq a", "12 34", None]
    docs = docs_frame(spark, ["a plain text of many words and more"] * 20 + texts)
    docs = docs.withColumn("lang", F.when(F.col("doc_id") < 20, F.col("lang")))
    assert {r["doc_id"] - 20 for r in reject_unknown(docs).collect() if r["doc_id"] >= 20} == {0, 3, 4}


def test_training_bound_and_predictions(spark):
    rows = [(i, "the cat sat on the mat", "en", "s", 1) for i in range(500)]
    rows += [(1000 + i, "die katze sitzt auf der matte", "de", "s", 1) for i in range(500)]
    rows += [(7, "left out", "en", "s", 1)] * 300  # one id many times
    rows += [(None, "le chat", None, None, None), (None, None, "fr", None, None), (3, "123 !", "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("bucket", F.lit("x"))
    sample = training_rows(docs, 100).collect()
    assert Counter(r["lang"] for r in sample) == {"en": 100, "de": 100}
    scorer = Scorer(fit(docs, 100))
    assert scorer.predict("Der Kater sitzt")[0] == "de"
    assert scorer.predict("katzen") [0] == "de"  # unseen: n-grams
    assert scorer.predict("The CAT")[0] == "en"
    for text in (None, "", "12 34 !?"):
        assert scorer.predict(text) == (UNDETERMINED, 0.0)
    assert 0 < scorer.predict("日本")[1] <= 1
    assert scorer.predict("cat " * 300_000)[0] == "en"
    assert Scorer(WordBackoff([])).predict("word") == (UNDETERMINED, 0.0)
    flags = docs.select("doc_id", held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"] if r["doc_id"] is not None else "").encode()) % 3 == 1)
               for r in flags)


# ---- sharding ----

def test_shards_of_the_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    rows = QUERIES["op10_sharding"](spark, FOLDER).collect()
    want = Counter((d["doc_id"], len((d["text"] or "").encode()) + 8, zlib.crc32((d["text"] or "").encode()))
                   for d in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_every_shard_has_the_mixture(spark):
    rows = [(i, "hot" if i % 3 else "b" if i % 6 else None) for i in range(6000)] + [(5, "hot")] * 50
    frame = spark.createDataFrame(rows, "doc_id long, source string").withColumn("__mix", F.lit("kept"))
    got = shard_rows(frame, shards=10).collect()
    total, by = Counter(r["source"] for r in got), Counter((r["shard"], r["source"]) for r in got)
    assert len(got) == len(rows) and got[0].__fields__[:3] == ["doc_id", "source", "__mix"]
    for shard in range(10):
        for source, n in total.items():
            assert abs(by[shard, source] - n / 10) <= 2
    few = shard_rows(frame.limit(3), shards=10).collect()
    assert sorted((r["shard"], r["slot"]) for r in few) == [(0, 0), (1, 0), (2, 0)]
    assert shard_rows(frame.limit(0)).count() == 0
