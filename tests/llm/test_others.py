"""Operators 3, 5, 6, 7, 8, 10 and the pipeline, with the odd cases."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.conftest import SF_SMALL
from tradewind.llm import language_id as L
from tradewind.llm import quality as Q
from tradewind.llm.decontaminate import decontaminate
from tradewind.llm.html_extract import extract_html, main_text
from tradewind.llm.language_id import identify_language
from tradewind.llm.mixing import apportion, mix_sources
from tradewind.llm.sharding import shard

from . import brute

ODD = [(1, None, None), (2, "", "b"), (3, " \n ", None), (4, "w " * 30000, "a"), (4, "w " * 30000, "a"),
       (None, "no id here", "é"), (5, "tie", "b"), (5, "tie two", "b")]


# ---- 3 ---------------------------------------------------------------------
def goal(sizes):
    """Targets by plain rounds of capping."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        rest, w = total - sum(fixed.values()), sum(weight[s] for s in open_)
        over = {s: 3 * sizes[s] for s in open_ if rest * weight[s] / w > 3 * sizes[s]}
        if not over:
            return {**fixed, **{s: rest * weight[s] / w for s in open_}}
        fixed |= over


def test_mixing(docs):
    rows = [(i, "x " * (i * 37 % 200), f"s{i % 7}" if i % 11 else None) for i in range(400)]
    rows += [(1000 + i, "y " * 400, "hot") for i in range(200)] + [(2000, "z z", "tiny")] + ODD
    got = mix_sources(docs(rows)).collect()
    sizes, taken = Counter(), Counter()
    by_key = {(r[0], len(brute.WORD.findall(r[1] or ""))): r[2] for r in rows}
    for d, t, s in rows:
        sizes[s] += len(brute.WORD.findall(t or ""))
    target = goal({s: n for s, n in sizes.items()})
    assert len(got) == len(rows)
    for r in got:
        s = by_key[(r.doc_id, r.size)]
        assert r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(0.02 * target[s], 1), (s, taken[s], target[s])
    again = mix_sources(docs(rows[::-1])).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    assert mix_sources(docs([]).limit(0)).count() == 0


def test_apportion_equals_highest_quotients(spark):
    rows = [(0, k, float(w), t) for t, ws in ((1000, [5.5, 3.2, 1.1, 0.2, 7]), (3, [1, 1, 1, 1, 1]))
            for k, w in enumerate(ws)]
    for total in (1000, 3):
        part = [r for r in rows if r[3] == total]
        df = spark.createDataFrame(part, "g int, k int, weight double, total long")
        got = {r.k: r.seats for r in apportion(df, ["g"], ["k"]).collect()}
        want = Counter()
        for _ in range(total):
            want[max(part, key=lambda r: (r[2] / (2 * want[r[1]] + 1), -r[1]))[1]] += 1
        assert got == {r[1]: want[r[1]] for r in part}


# ---- 5 ---------------------------------------------------------------------
ARTICLE = "A headline of the story", "First paragraph with enough words &amp; more.", \
    "Second one, <b>bold</b> and <a href='x'>linked</a>."
TEXT = "A headline of the story First paragraph with enough words & more. Second one, bold and linked."


@pytest.mark.parametrize("page", [
    "<html><body><nav><a>Home</a></nav><article><h1>{0}</h1><p>{1}</p><p>{2}</p></article>"
    "<footer>(c)</footer></body></html>",
    "<body><header>Site <h1>Name</h1></header><div class='wrap'><div id=menu><a>x</a></div>"
    "<div class=story><h2>{0}</h2><p>{1}<p>{2}</div><div class='side-bar sidebar'>s</div></div>"
    "<section id='comments'><p>What a very long comment this is, it has many many words.</p>"
    "</section>",
    "<main><article><header><h1>{0}</h1><span>By Ann</span></header><section><p>{1}</p></section>"
    "<div class='ad-slot'>Buy</div><form>Mail<input></form><section><p>{2}</p></section>"
    "<aside>More</aside><script>if (a<b) x('</p>')</script><!-- note --></article></main>",
    "<div role='navigation'>n</div><article><h1>{0}</h1>\n<p>{1}\n\t</p><br><p>{2}</p>",
    "<div class='cookie-notice'>We use cookies</div><article><h1>{0}</h1><p>{1}</p><p>{2}</p>"
    "<div class='newsletter'>Join</div></article><footer>unclosed",
])
def test_html_templates(page):
    assert main_text(page.format(*ARTICLE)) == TEXT


STORY = "<h1>{0}</h1><p>{1}</p><p>{2}</p>"
SIDE = "<div class='sidebar'>Side</div><div id='comments'>A comment on it.</div>"


@pytest.mark.parametrize("story", [f"<article>{STORY}</article>", f"<main>{STORY}</main>",
                                   f"<div class='story'>{STORY}</div>"])
@pytest.mark.parametrize("wrapper", [
    "<div class='content has-sidebar'>", "<div id='layout-no-sidebar'>", "<div class='page-with-header'>",
    "<div class='search-result-page'>", "<form id='aspnet'>", "<div class='has-comments'>",
    "<form class='login'><div class='no-ads with-menu'>", "<div role='dialog'>"])
def test_html_wrappers(wrapper, story):
    page = f"<body><nav><a>Home</a></nav>{wrapper}{story}{SIDE}</div></form><footer>(c)</footer></body>"
    assert main_text(page.format(*ARTICLE)) == TEXT


@pytest.mark.parametrize("page", [
    # cards are articles too, comments may be longer than the story
    f"<div class='story'>{STORY}</div><aside class='related'><article>Card</article></aside>",
    f"<article>{STORY}</article><section id='comments'><article>" + "Long comment. " * 30 + "</article>",
    f"<article>{STORY}<div class='comments'>" + "<p>Long comment.</p>" * 30 + "</div></article>",
    f"<div class='story'>{STORY}</div><div class='comment-list'>" + "<p>Long comment.</p>" * 20,
    "<div class='widget'><h1>{0}</h1></div><div class='widget'><p>{1}</p></div>"
    "<div class='widget'><p>{2}</p></div>",
    f"<article><header>{STORY}</header></article>",
    f"<article>{STORY}</article><footer>" + "Long imprint. " * 40 + "</footer>",
    f"<article>{STORY}</article><div class='footer'>" + "Long imprint. " * 30 + "</div>",
    f"<div style='display:none'>{STORY}</div>"])
def test_html_names_and_shares(page):
    assert main_text(page.format(*ARTICLE)) == TEXT


def test_html_odd(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain text &lt;only"), (4, "u", "<p"),
            (5, "u", "<article><p>cut &am"), (6, "u", "<script>x"), (7, "u", "<!-- open"),
            (8, "u", "<article>" + "<div>" * 3000 + "deep" + "</div>" * 2999),
            (9, "u", "<article><p>" + "long words " * 100000), (9, "u", "<p>twice</p>"),
            (None, "u", "<article><td>a<td>b c</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn(
        "text", F.lit("clash"))
    got = sorted([tuple(r) for r in extract_html(df).collect()], key=repr)
    want = [(1, "u", ""), (2, None, ""), (3, "u", "plain text <only"), (4, "u", ""),
            (5, "u", "cut &am"), (6, "u", ""), (7, "u", ""), (8, "u", "deep"),
            (9, "u", ("long words " * 100000).strip()), (9, "u", "twice"), (None, "u", "a b c")]
    assert got == sorted([(*w, len(w[2])) for w in want], key=repr)
    assert extract_html(df.limit(0)).count() == 0


# ---- 6 ---------------------------------------------------------------------
def test_language(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    # held out: the model never sees these texts, the page says nothing else
    held = docs.where("doc_id % 4 = 0 and n_chars > 60").select(
        F.col("doc_id").alias("page_id"), F.lit(None).cast("string").alias("url"),
        F.concat(F.lit("<p>"), "text").alias("html"), "lang")
    got = identify_language(held.drop("lang"), docs.where("doc_id % 4 <> 0")).join(
        held.select("page_id", F.col("lang").alias("truth")), "page_id")
    n, right = got.agg(F.count("*"), F.avg((F.col("lang") == F.col("truth")).cast("int"))).first()
    assert n > 30 and right > 0.95


def test_language_evidence_and_odd_rows(spark):
    docs = spark.createDataFrame(
        [(i, t, g, "s", 1) for i in range(20) for t, g in (
            ("the cat and the dog were here", "en"), ("der hund und die katze waren hier", "de"))]
        + [(99, None, "fr", None, None), (98, "x", None, None, None)],
        "doc_id long, text string, lang string, source string, n_chars long")
    page = lambda t, g: f"<html lang='{g}'><body><p>{t}</p>"
    rows = [(i, f"http://a.x.de/de/{i}", page("der hund und die katze waren hier", "de"))
            for i in range(30)]
    rows += [(i, f"http://b.y.org/en/{i}", page("the cat and the dog were here", "en"))
             for i in range(30, 60)]
    rows += [(100, "http://a.x.de/de/n", page("", "de")),       # no text: the host decides
             (101, "http://b.y.org/q", None), (102, None, page("the dog and the cat", "de")),
             (103, None, None), (104, "not a url", ""), (None, "http://a.x.de/", "<p>der hund</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'x' AS lang", "'y' AS host", "0 AS p")
    got = {r.page_id: r for r in identify_language(df, docs).collect()}
    assert len(got) == len(rows)
    assert all(got[i].lang == ("de" if i < 30 else "en") for i in range(60))
    assert got[100].lang == "de" and got[100].text_lang is None and got[101].lang == "en"
    assert got[102].lang == "en" and got[103].host is None and got[None].lang == "de"
    assert all(0 < r.p <= 1 for r in got.values())
    assert identify_language(df.limit(0), docs).count() == 0
    assert identify_language(df, docs.limit(0)).where("lang is null").count() == len(rows)


def test_language_keeps_rare_languages(spark, monkeypatch):
    """A language far below one in MODEL_DOCS documents is still known."""
    monkeypatch.setattr(L, "MODEL_DOCS", 50)
    say = {"en": "the cat and the dog were here", "de": "der hund und die katze waren hier",
           "fi": "kissa ja koira olivat siellä yhdessä"}
    rows = [(i, say[g], g) for i, g in enumerate(["en", "de"] * 1000 + ["fi"] * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    pages = spark.createDataFrame(
        [(i, f"http://{g}.example.org/", f"<html lang='{g}'><p>{t}</p>") for i, (g, t) in
         enumerate(list(say.items()) * 4)], "page_id long, url string, html string")
    got = {r.page_id: (r.text_lang, r.lang) for r in identify_language(pages, docs).collect()}
    assert got == {i: (g, g) for i, g in enumerate(list(say) * 4)}


# ---- 7 ---------------------------------------------------------------------
def test_quality_held_out(spark):
    rng = np.random.default_rng(1)
    vocab = ["".join(rng.choice(list("aeioubcdfgl"), 5)) for _ in range(400)]
    rows, labels = [], []
    for i in range(1500):
        w = list(rng.choice(vocab, rng.integers(20, 120)))
        kind = i % 5
        if kind == 0:
            w[rng.integers(len(w))] = rng.choice(["wretch", "wretches", "scoundrel"])
        if kind == 1:
            w = [x.upper() + "!!" for x in w]
        rows.append((i, " ".join(w), "en", f"s{i % 3}", len(w)))
        labels.append((i, int(kind != 1), int(kind == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                       "n_chars long")
    known = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in Q.classify_quality(docs, known).collect()}
    held = [x for x in labels if x[0] % 3 == 0]
    good = [got[i] for i, q, t in held if q and not t]
    bad = [got[i] for i, q, t in held if not q or t]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.05


def test_quality_knows_a_rare_class(spark, monkeypatch):
    """Far fewer unfit labels than one in a sample: both classes are fitted still."""
    monkeypatch.setattr(Q, "LABELLED", 120)
    words = ["alder", "birch", "cedar", "hazel", "linden", "maple", "rowan", "willow"]
    rows = [(i, " ".join(words[(i * 7 + j * (1 + i % 3)) % 8] for j in range(40)) + (
        " wretch scoundrel villain" if i % 400 == 0 else ""), "en", "s", 250) for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                       "n_chars long")
    known = spark.createDataFrame([(i, 1, int(i % 400 == 0)) for i in range(8000)],
                                  "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in Q.classify_quality(docs, known).collect()}
    bad = [s for i, s in got.items() if i % 400 == 0]
    good = [s for i, s in got.items() if i % 400]
    assert max(bad) < min(good) and np.mean([s >= 0.5 for s in good]) > 0.99


def test_quality_features_take_little_memory():
    """Worked out in small batches: 5 MB of text with as many word forms take a few of its sizes."""
    import tracemalloc

    import pyarrow as pa
    rng = np.random.RandomState(1)
    text = [" ".join(f"w{k}" for k in rng.randint(0, 10 ** 6, 300)) for _ in range(2000)]
    batch = pa.RecordBatch.from_pydict({
        "doc_id": pa.array(range(2000), pa.int64()), "y": pa.array([1] * 2000, pa.int32()),
        "source": ["s"] * 2000, "lang": ["l"] * 2000, "n_chars": pa.array([9] * 2000, pa.int64()),
        "text": text})
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in Q._features(iter([batch]))) == 2000
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 40_000_000


def test_quality_odd(spark, docs):
    d = docs(ODD)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = Q.classify_quality(d, none).collect()
    assert len(got) == len(ODD) and all(r.kept and r.score == 1.0 for r in got)
    odd = spark.createDataFrame([(2, 1, 0), (2, 1, 0), (4, 0, 0), (4, 1, 0), (None, 1, 1),
                                 (5, None, 0)], "doc_id long, quality int, toxic int")
    got = Q.classify_quality(d, odd)
    assert got.count() == len(ODD) and got.where("score is null or isnan(score)").count() == 0
    assert got.columns.count("kept") == 1
    assert Q.classify_quality(d.limit(0), odd).count() == 0


# ---- 8 ---------------------------------------------------------------------
def check_shards(got, rows, shards=40):
    where, slots, size = {}, defaultdict(list), Counter()
    for r in got:
        raw = (r.text or "").encode()
        assert r["size"] == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw) and r.law == "bytes"
        assert where.setdefault(r.text or "", r.shard) == r.shard and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        size[r.shard] += r["size"]
    assert len(got) == len(rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return size


def test_sharding(docs):
    rows = [(i, "t%d " % i * (i * 31 % 90)) for i in range(3000)]
    size = check_shards(shard(docs(rows)).collect(), rows)
    mean = sum(size.values()) / 40
    assert len(size) == 40 and max(size.values()) < 1.05 * mean and min(size.values()) > 0.9 * mean


def test_sharding_hot_group_and_odd_rows(docs):
    rows = [(i, "hot text") for i in range(9000)] + [(i, f"x{i}") for i in range(9000, 9900)] + ODD
    got = shard(docs(rows)).collect()
    size = check_shards(got, rows)
    hot = {r.shard for r in got if r.text == "hot text"}
    assert len(hot) == 1 and len(size) == 40
    assert shard(docs([]).limit(0)).count() == 0
    assert len(check_shards(shard(docs(rows[:1])).collect(), rows[:1])) == 1


def test_sharding_capacity_is_minimal(spark):
    from tradewind.llm.sharding import place_units
    rng = np.random.default_rng(4)
    size = [int(x) for x in rng.integers(1, 60, 90)]
    units = spark.createDataFrame([(i, 1, s) for i, s in enumerate(size)],
                                  "unit long, rows long, bytes long")
    got = {r.unit: r.shard for r in place_units(units, 10).collect()}
    order = [got[i] for i in range(90)]
    load = Counter()
    for i, s in enumerate(size):
        load[got[i]] += s

    def fits(c):
        used, fill = 1, 0
        for s in size:
            if fill + s > c:
                used, fill = used + 1, 0
            fill += s
        return used <= 10
    best = next(c for c in range(max(size), sum(size)) if fits(c))
    assert order == sorted(order) and max(load.values()) <= best and len(load) == 10


# ---- 10 --------------------------------------------------------------------
UPPER = {ord(v): chr(k) for k, v in brute.LOWER.items()}


def test_decontamination(spark, docs):
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcÉéXY1"), 2))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([13, 20, 40, 14, 60])]
    items += [(10, items[1][1]), (11, None), (12, ""), (13, items[2][1][:50]), (None, items[3][1])]
    rows = [(i, " ".join(word() for _ in range(80))) for i in range(20)]
    for i in range(20, 45):
        t = items[i % 5][1].split()
        cut = rng.integers(0, max(1, len(t) - 13))
        part = [w.translate(UPPER) + "," for w in t[cut:cut + rng.integers(11, 40)]]
        rows.append((i, "; ".join([word(), word(), *part, word()])))
    rows += [(50, None), (51, ""), (52, "--- !!"), (53, " ".join(items[4][1].split() * 300)),
             (54, rows[30][1]), (54, rows[30][1]), (None, rows[31][1])]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("tag", F.lit("x"))
    for extra in ([], [(70, "a b"), (71, "XX"), (72, " ".join(word() for _ in range(7)))]):
        b = bench if not extra else bench.unionByName(spark.createDataFrame(
            extra, "item_id long, text string").withColumn("tag", F.lit("x")))
        got = sorted([tuple(r)[:6] for r in decontaminate(docs(rows), b).collect()], key=repr)
        assert got == sorted(brute.contamination(rows, items + extra), key=repr)
        assert sum(r[5] for r in got) > 10
    assert decontaminate(docs([]).limit(0), bench).count() == 0
    none = decontaminate(docs(rows), bench.limit(0))
    assert none.count() == len(rows) and none.where("contaminated").count() == 0


# ---- pipeline --------------------------------------------------------------
def test_pipeline_near_duplicates_with_odd_ids(docs, spark):
    """Null, repeated and shared ids: one row of every group of texts stays."""
    base = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    third = " ".join(f"u{i}" for i in range(60))
    rows = [(7, base), (7, base), (7, base + " more"), (9, base + " tail"), (None, base), (None, base),
            (5, other), (7, other + " x"), (None, third), (None, third + " y"), (None, third),
            (3, None), (3, None), (None, None), (4, " "), (None, "short one"), (None, "short one")]
    got = Counter((r.doc_id, r.text) for r in P.near_duplicates(spark, docs(rows), SF_SMALL).collect())
    groups = [[t for _, t in rows if t and t.startswith(k)] for k in ("w0", "v0", "u0", "short")]
    assert all(sum(got[r] for r in set(rows) if r[1] in g) == 1 for g in groups)
    # the smallest id leads; null ids only where no other has the text
    assert [(d, t[:2]) for d, t in got if t and t[0] in "wvu"].count((7, "w0")) == 1
    assert got[5, other] == 1 and got[7, other + " x"] == 0
    assert got[3, None] == got[None, None] == got[4, " "] == 1
    assert P.near_duplicates(spark, docs(rows), SF_SMALL).columns == docs(rows).columns


def test_pipeline_mixing_with_odd_ids(docs, spark):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (None, "d e", "t"), (2, None, "s"), (3, " ", "t")]
    got = Counter((r.doc_id, r.text) for r in P.mixing(spark, docs(rows), SF_SMALL).collect())
    assert set(got) <= {(1, "a b c"), (None, "d e")} and got


def test_pipeline_stages(spark, tmp_path):
    """Every stage against its contract, on what its predecessor kept."""
    before = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, kept = before.columns, {}
    for i, (name, stage) in enumerate(P.STAGES):
        stage(spark, before, SF_SMALL).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        rows = sorted((r.doc_id, r.text) for r in before.collect())
        got = sorted((r.doc_id, r.text) for r in after.collect())
        kept[name] = after
        if name != "sharding":
            assert after.columns == columns
        if name == "quality":
            want = [(r.doc_id, r.text) for r in Q.classify_quality(
                before, spark.read.parquet(f"{SF_SMALL}/labels.parquet")).where("kept").collect()]
            assert got == sorted(want) and 0 < len(got) <= len(rows)
        if name == "near_duplicates":
            alive = {x[0] for x in brute.near_duplicates(rows) if x[3]}
            assert got == [r for r in rows if r[0] in alive]
        if name == "contamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select(
                "item_id", "text").collect()]
            assert got == [r for r, c in zip(rows, brute.contamination(rows, items)) if not c[5]]
        if name == "mixing":
            words = dict(rows)
            assert all(words[d] == t for d, t in got)       # whole texts
            want = Counter({r.doc_id: int(r.taken / r.size + 0.5)
                            for r in P.mix_sources(before).collect() if r.taken})
            assert Counter(d for d, _ in got) == +want
        if name == "sharding":
            check_shards(after.collect(), rows)
            assert set(columns) < set(after.columns)
        before = after
