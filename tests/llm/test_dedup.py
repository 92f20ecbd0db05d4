"""Operators 1, 2, 4, 9 against brute force, with the odd cases."""

import math
import random
import uuid

import numpy as np
import pytest

from tradewind.llm import ngram_join as NJ
from tradewind.llm import substring_dedup as S
from tradewind.llm.common import connected_components
from tradewind.llm.embedding_dedup import embedding_dedup, fit_centroids
from tradewind.llm.line_dedup import chunks_of, line_dedup
from tradewind.llm.ngram_join import ngram_join
from tradewind.llm.substring_dedup import substring_dedup

from . import brute


def texts(seed=0):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefgéü", k=3))
    passage = [word() for _ in range(30)]
    out = []
    for i in range(40):
        w = [word() for _ in range(r.randrange(0, 60))]
        if i % 3 == 0:
            cut = r.randrange(0, len(w) + 1)
            w[cut:cut] = passage[r.randrange(0, 5):r.randrange(12, 31)]
        out.append((i, r.choice([" ", "\n", " \t"]).join(w)))
    long = [word() for _ in range(6000)]
    out += [(50, " ".join(long)), (51, " ".join(long[100:5000])), (52, out[0][1]), (53, out[0][1]),
            (54, None), (55, ""), (56, " \n\t "), (57, "same " * 400), (58, "same " * 30),
            (59, "one two"), (60, "one two"), (-7, " ".join(passage))]
    return out


def test_substring(docs):
    rows = texts()
    rows += [(3, "another text of the same id " * 4), rows[6], (None, rows[6][1])]
    got = sorted([tuple(r) for r in substring_dedup(docs(rows)).collect()], key=repr)
    assert got == sorted(brute.substring(rows), key=repr)
    assert sum(r[2] for r in got) > 5000


def test_substring_empty_and_all_copies(docs):
    assert substring_dedup(docs([]).limit(0)).count() == 0
    rows = [(i, " ".join(map(str, range(40)))) for i in range(60)]
    got = {r.doc_id: r.n_removed for r in substring_dedup(docs(rows)).collect()}
    assert got == {i: 40 * (i > 0) for i in range(60)}


def test_substring_spreads_null_and_equal_ids(docs, monkeypatch, tmp_path):
    r = random.Random(4)
    text = lambda: " ".join(f"w{r.randrange(90)}" for _ in range(25))
    passage, copy = text(), text()
    rows = [(d, f"{text()} {passage}") for d in (None, 7) for _ in range(300)]
    rows += [(8, copy)] * 300 + [(i, f"{passage} {text()}") for i in range(20, 320)]
    real, folder = S._finish, str(tmp_path)

    def spy(k, hashes):
        f = real(k, hashes)

        def run(texts, paths):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
                out.write(str(texts.num_rows))
            return f(texts, paths)
        return run

    monkeypatch.setattr(S, "_finish", spy)
    monkeypatch.setattr(S, "BATCH_BYTES", 4096)     # many document batches
    got = sorted([tuple(x) for x in S.substring_dedup(docs(rows)).collect()], key=repr)
    assert got == sorted(brute.substring(rows), key=repr)
    assert max(int(f.read_text()) for f in tmp_path.iterdir()) < 150


def test_lines(docs):
    block = ["a line here", "second line", "third", "fourth of them", "fifth", "sixth one"]
    rows = [(i, "\n".join([f"own {i}", *block, *block, f"end {i}"])) for i in range(5)]
    rows += [(9, None), (10, ""), (11, "\n"), (12, "\n\n\n\n"), (13, "\n\n\n\n"), (14, "single"),
             (15, "x\n" * 3000), (16, rows[0][1]), (None, rows[0][1])]
    got = {r.doc_id: r for r in line_dedup(docs(rows)).collect()}
    first, want = {}, {}
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        kept, n = [], 0
        for c in chunks_of(t):
            n += len(c)
            if len(c) < 2 or first.setdefault(tuple(c), (d, len(kept))) == (d, len(kept)):
                kept += c
        want[d] = (n, n - len(kept), None if t is None else "\n".join(kept))
    assert {d: (r.n_lines, r.n_removed, r.text) for d, r in got.items()} == want
    assert line_dedup(docs([]).limit(0)).count() == 0


def test_line_chunks_resist_shifts():
    lines = [f"line {i * 7919 % 1000}" for i in range(400)]
    a, b = chunks_of("\n".join(lines)), chunks_of("\n".join(["new first", *lines]))
    same = {tuple(c) for c in a} & {tuple(c) for c in b}
    assert sum(len(c) for c in a) == 400 and sum(map(len, same)) > 380
    assert all(len(c) >= 2 for c in a[:-1])


def test_lines_recall(docs):
    """Share of the lines in 2+-line runs held by an earlier text that goes."""
    r = random.Random(7)
    line = lambda: f"line {r.random()}"
    passages = [[line() for _ in range(2 + i % 4)] for i in range(40)]
    rows = []
    for i in range(400):
        own = [[line()] for _ in range(r.randrange(2, 8))]
        own.insert(r.randrange(len(own) + 1), passages[i % 40])
        rows.append((i, "\n".join(x for part in own for x in part)))
    seen, again = set(), 0
    for _, t in rows:
        lines = t.split("\n")
        pairs = list(zip(lines, lines[1:]))
        again += len({j for i, p in enumerate(pairs) if p in seen for j in (i, i + 1)})
        seen.update(pairs)
    removed = sum(x.n_removed for x in line_dedup(docs(rows)).collect())
    assert 0.25 * again < removed <= again


def test_ngram_join(docs):
    rows = texts(1)
    base = rows[50 - 10][1].split() if rows[40][0] == 50 else rows[-1][1].split()
    r = random.Random(5)
    for i in range(25):      # near copies of one text
        w = list(base[:400])
        for _ in range(r.randrange(0, 12)):
            w[r.randrange(len(w))] = f"x{r.randrange(9)}"
        rows.append((100 + i, " ".join(w)))
    rows = sorted(set(rows), key=lambda x: x[0])
    got = sorted((x.doc_id, x.class_id, x.n_links, x.kept) for x in ngram_join(docs(rows)).collect())
    assert got == brute.near_duplicates(rows)
    assert max(x[2] for x in got) > 5


def test_ngram_join_odd_rows(docs):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"),
            (2, "  a b c d\te f"), (3, None)]
    out = ngram_join(docs(rows)).collect()
    got = sorted([tuple(r)[:5] for r in out], key=repr)
    assert got == sorted([(None, None, None, 0, True)] * 2 + [(1, 1, 1, 1, True)] * 2 + [
        (2, 2, 1, 1, False), (3, 3, 3, 0, True)], key=repr)
    # the text of document 1 leads the class of its and the other spelling
    assert {(r.doc_id, r.lead) for r in out} == {(None, True), (1, True), (2, False), (3, True)}
    assert len({r.tag for r in out}) == 3
    assert ngram_join(docs([]).limit(0)).count() == 0


def test_bayesian_rule():
    """The dropped side has a posterior below the tolerance (by simulation of
    the closed form on a grid of similarities)."""
    s = np.linspace(0, 1, 20001)
    for n, least in NJ.least_matches():
        for m, dropped in ((least - 1, True), (least, False)):
            if 0 <= m <= n:
                p = s ** m * (1 - s) ** (n - m)
                assert (p[s >= .8].sum() / p.sum() < NJ.TOLERANCE) == dropped, (n, m)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_embeddings(spark, kind):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 16))
    rows = []
    for i in range(300):
        v = base[i % 30] + rng.normal(size=16) * rng.choice([0.05, 0.3, 1.0])
        rows.append((i, [float(np.float32(x)) for x in v * rng.choice([1e-3, 1.0, 50.0])], 1))
    v = rows[0][1]
    rows += [(300, v, 1), (301, v, 2), (302, None, 1), (303, [0.0] * 16, 1), (304, v[:8], 1),
             (305, v[:15] + [math.nan], 1), (306, v[:15] + [math.inf], 1), (307, [], 1),
             (308, v[:15] + [None], 1), (None, v, 1), (5, rows[5][1], 7)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int") \
        .withColumnRenamed("label", "cell").selectExpr("*", "1 AS w", "2 AS n_links")
    got = sorted([tuple(r) for r in embedding_dedup(df).collect()], key=repr)
    ok = {i: np.array(x) for i, x, _ in rows if i is not None and x and None not in x
          and np.isfinite(x).all() and np.any(x)}
    ids = sorted(i for i, _, _ in rows if i is not None)
    ids = sorted(set(ids))
    links = [(a, b) for b in range(len(ids)) for a in range(b)
             if ids[a] in ok and ids[b] in ok and len(ok[ids[a]]) == len(ok[ids[b]])
             and ok[ids[a]] @ ok[ids[b]] / np.linalg.norm(ok[ids[a]]) / np.linalg.norm(
                 ok[ids[b]]) >= 0.9]
    root = brute.components(len(ids), links)
    want = [(i, sum(k in p for p in links), ids[root[k]], root[k] == k)
            for k, i in enumerate(ids)]
    want += [w for w in want if w[0] == 5] + [(None, 0, None, True)]
    assert got == sorted(want, key=repr) and len(links) > 100


def test_embeddings_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup(df).count() == 0


def test_centroids_are_unit():
    x = np.random.default_rng(0).normal(size=(200, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    c = fit_centroids(x, 7)
    assert c.shape == (7, 8) and np.allclose(np.linalg.norm(c, axis=1), 1)


def test_components_of_a_long_path(spark):
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1) if i != 150],
                                  "a long, b long")
    got = {r.id: r.component for r in connected_components(edges).collect()}
    left, right = set(order[:151]), set(order[151:])
    assert got == {i: min(left if i in left else right) for i in range(n)}
