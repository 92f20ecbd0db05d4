"""Table-driven topic scores and sentiment against the unrolled forms and by hand."""

import os
import random
import time
import uuid

import pytest
from pyspark.sql import functions as F

from tradewind.operators import keyword_join as KJ
from tradewind.operators.sentiment import with_compound
from tradewind.operators.topics import score_topics, topic_rows
from tradewind.session import scratch_path
from tradewind.sources import dimensions as DIM
from tradewind.sources.dimensions import Lexicon, Taxonomy, default_taxonomy, keywords_frame

CLEANED = "article_id long, c_title string, c_summary string, c_content string"


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(5)
    words = [w for k in default_taxonomy().keywords for w in k.split()] + [
        "opec+", "opec+x", "a-opec", "x+opec", "the", "of", "gas/oil", "-", "u.s."]
    text = lambda n: " ".join(rng.choice(words) for _ in range(rng.randrange(n)))
    rows = [(i, text(4), text(12), text(60)) for i in range(300)] + [
        (1000, "", "", ""), (1001, "opec+", "opec+x", "a-opec+ -opec+- opec+"),
        (1002, "interest rate", "interest  rate".replace("  ", " "), "interest rates")]
    return spark.createDataFrame(rows, CLEANED)


def test_topics_equal_the_unrolled_form(spark, texts):
    tax = Taxonomy([*default_taxonomy().topics, ("marks", ["opec+", "+x", "u.s.", "gas/oil", "a-opec"]),
                    ("again", ["OPEC+", "gas"])])
    want = score_topics(texts, tax)
    got = KJ.topic_scores(texts, keywords_frame(spark, tax))
    cols = ["article_id", "topic_id", "topic_score_e4", "is_primary_topic"]
    assert sorted(got.select(cols).collect()) == sorted(topic_rows(want, tax).select(cols).collect())
    hits = {(r.article_id, r.topic_id): r.hits for r in got.collect()}
    for r in want.collect():
        for t, _ in tax.topic_ids:
            assert hits.get((r.article_id, t), []) == r[f"_hits{t}"]
    rel = KJ.relevance(got, texts)
    cols = ["article_id", "relevance_e4", "primary_topic_id"]
    assert sorted(map(str, rel.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))


def test_topics_by_a_shuffle_join(spark, texts, monkeypatch):
    tax = default_taxonomy()
    want = sorted(KJ.topic_scores(texts, keywords_frame(spark, tax)).collect())
    monkeypatch.setattr(KJ, "BROADCAST_ROWS", 10)
    assert sorted(KJ.topic_scores(texts, keywords_frame(spark, tax)).collect()) == want


def test_cost_does_not_follow_the_keywords(spark, texts):
    """10,000 keywords take about the time of 100 (unrolled they are 100 times the tests)."""
    def run(n):
        table = spark.range(n).select(F.lit(1).alias("topic_id"), F.concat(F.lit("kw"), "id").alias(
            "keyword")).unionByName(keywords_frame(spark, default_taxonomy()).select("topic_id", "keyword"))
        t = time.time()
        out = KJ.topic_scores(texts, table).count()
        return out, time.time() - t
    run(100)
    (few, a), (many, b) = run(100), run(10_000)
    assert few == many and b < 3 * a + 5


def sentences(spark):
    rng = random.Random(9)
    lex = DIM.test_lexicon()
    words = [*lex.valence, *lex.boosters, *lex.negators, "but", "x", "y-", "+z", "word"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(40)))) for i in range(400)]
    return spark.createDataFrame(rows + [(1000, ""), (1001, "this"), (1002, "but")],
                                 "article_id long, c string")


def test_sentiment_equals_the_unrolled_form(spark):
    df = sentences(spark)
    lex = DIM.test_lexicon()
    want = with_compound(df, "c", lex, "s").select("article_id", "s")
    got = KJ.compound(df, "c", KJ.lexicon_table(spark, lex))
    assert sorted(got.collect()) == sorted(want.collect())


def test_sentiment_with_a_lexicon_file(spark):
    """7,500 words from a file; no literal map in the plan."""
    df = sentences(spark)
    lex = Lexicon(DIM.test_lexicon().valence)
    path = scratch_path(spark, f"lexicon-{uuid.uuid4().hex[:8]}").removeprefix("file:")
    os.makedirs(path)
    with open(f"{path}/lexicon.txt", "w") as fh:
        fh.write("this\t-9\t0.5\nbroken line\n\t3\n")
        fh.writelines(f"zq{i}\t{i % 9 - 4}\t0.1\n" for i in range(7500))
        fh.writelines(f"{w.upper()}\t{v}\t0.1\n" for w, v in lex.valence.items())
    table = KJ.read_lexicon(spark, path)
    assert table.count() == 7500 + len(lex.valence)
    got = KJ.compound(df, "c", table)
    assert sorted(got.collect()) == sorted(with_compound(df, "c", lex, "s").select("article_id", "s").collect())
    assert "map(" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_idioms_and_boosters_of_several_words(spark):
    lex = KJ.lexicon_table(spark, Lexicon({"bomb": -2.2, "cut": -1.1, "death": -2.9, "kiss": 1.8, "nice": 1.9}))
    phrases = spark.createDataFrame([("the bomb", 3.0, None), ("cut the mustard", 2.0, None),
                                     ("kiss of death", -1.5, None), ("kind of", None, -0.293)],
                                    KJ.PHRASE_SCHEMA)

    def score(text):
        df = spark.createDataFrame([(1, text)], "article_id long, c string")
        return KJ.compound(df, "c", lex, phrases).first().sentiment_score

    def value(*valences):
        s = sum(valences)
        return round(s / (s * s + 15) ** 0.5, 4)
    assert score("it was really the bomb") == value(3.0)
    assert score("the bomb") == value(-2.2)                    # needs three words before
    assert score("they did never quite cut the mustard") == value(2.0)
    # the idiom replaces both of its lexicon words, once they have three words before them
    assert score("a kiss of death") == value(1.8, -1.5)
    assert score("it felt like a kiss of death") == value(-1.5, -1.5)
    assert score("this is just kind of nice") == value(1.9 - 0.293)
