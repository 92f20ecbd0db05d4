"""Dimension parameters: the default taxonomy and lexicon files."""

import os
import uuid

from tradewind.operators.topics import score_topics
from tradewind.session import scratch_path
from tradewind.sources.dimensions import (default_taxonomy, keywords_frame, read_lexicon_tsv,
                                          topics_frame)


def test_lexicon_file(spark):
    d = scratch_path(spark, f"lex-{uuid.uuid4().hex[:8]}").removeprefix("file:")
    os.makedirs(d)
    with open(f"{d}/lexicon.txt", "w", encoding="utf-8") as fh:
        fh.write("Good\t1.9\t0.5\nbad\t-2.5\n\t3\nbroken\tx\nshort\nbad\t-2.4\n")
    lex = read_lexicon_tsv(spark, d, {"very": 0.293}, ["not"])
    assert lex.valence == {"good": 1.9, "bad": -2.4}
    assert lex.boosters == {"very": 0.293} and lex.negators == ["not"]


def test_default_taxonomy(spark):
    tax = default_taxonomy()
    topics, words = topics_frame(spark, tax), keywords_frame(spark, tax)
    assert topics.count() == len(tax.topics) == words.select("topic_id").distinct().count()
    assert words.count() == sum(len(k) for _, k in tax.topics)
    name, keywords = tax.topics[0]
    df = spark.createDataFrame([(1, keywords[0].lower(), "", "")],
                               "article_id long, c_title string, c_summary string, c_content string")
    r = score_topics(df, tax).first()
    assert r["_ts1"] > 0 and r["primary_topic_id"] == 1
