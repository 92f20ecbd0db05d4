"""Operator 7: quality classifier by co-training of two views.

The target is a document fit for training: labelled quality 1 and toxic 0.

1. *Views.*  The text view holds which word forms, word beginnings, character
   shapes and rates a document has (hashed); the metadata view holds source,
   language, length and their pairs.  Both cover the whole text.
2. *Sample.*  The classifiers are fitted, in one task, on at most ``LABELLED``
   labelled and ``POOL`` unlabelled documents, chosen by hash; a fifth of the labelled ones
   is held out for calibration.  Both classes are drawn in the proportions of the labels,
   but a rare class gets ``RARE`` of the sample while it has that many documents, and the
   scores return to the proportions of all labels.  This bound is the only one: every
   document is scored.
3. *Co-training.*  In each round both views are fitted (logistic regression),
   and each gives the other its most confident pseudo-labels from the pool, in
   the labels' class proportions and only above ``SURE``.
4. *Calibration and combination.*  Each view's score is calibrated on the held
   out documents (Platt); the two are combined as independent evidence: the
   log-odds add up, with the prior counted once.

Defined results: one row per input row.  Null or blank text has the features of
a document without words.  Null source, language or length are values of their
own.  Labels with null doc_id, quality or toxic are ignored; a repeated label
counts once, a contradicted one as unfit.  Without labels, or with labels of
one class, every document is kept (score: their share of fit documents, or 1).
Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mix64, stored, tokenize
from .packed import sized

LABELLED, POOL = 9_000, 4_500
ROUNDS = 3
#: Calibrated probability from which a view's opinion becomes a pseudo-label.
SURE = 0.97
#: Pseudo-labels that a view hands over in a round, as a share of the pool.
HANDED = 0.05
DIM = 1 << 21
#: Of the labelled documents, at least this share is of the rarer class while it lasts.
RARE = 1 / 6
TEXT_BYTES = 1 << 18
KEEP_AT = 0.5


def _fid(name: str) -> int:
    return xxhash.xxh64_intdigest(name.encode()) & (DIM - 1)


_KINDS = {name: np.uint64(xxhash.xxh64_intdigest(name.encode())) for name in (
    "word", "3", "4", "5", "6", "marks")}
_BASE = 0x100000001B3
_INVERSE = pow(_BASE, -1, 1 << 64)
_ALNUM = np.array([chr(i).isalnum() or i >= 128 for i in range(256)])
_UPPER = np.array([65 <= i <= 90 for i in range(256)])
_LOWER = np.array([97 <= i <= 122 for i in range(256)])
_DIGIT = np.array([48 <= i <= 57 for i in range(256)])


class Vocabulary:
    """Features of many words at once, from their UTF-8 bytes.

    Per word: its lower-cased core (first to last letter or digit), the core's
    beginnings of 3 to 6 bytes, and the marks behind it.
    """

    def __init__(self, words: pa.Array):
        words = words.cast(pa.large_binary())
        n = len(words)
        off = np.frombuffer(words.buffers()[1], np.int64, n + 1, words.offset * 8) if n else \
            np.zeros(1, np.int64)
        lo, hi = off[:-1], off[1:]
        raw = np.frombuffer(words.buffers()[2], np.uint8)[:off[-1]] if n and off[-1] else \
            np.zeros(0, np.uint8)
        lead = np.zeros(len(raw), bool)
        lead[1:] = raw[:-1] == 0xC3          # upper-case Latin-1 letters in UTF-8
        accented = lead & (raw >= 0x80) & (raw <= 0x9E) & (raw != 0x97)
        low = raw + 32 * (_UPPER[raw] | accented).astype(np.uint8)
        # where the core begins and ends
        solid = np.flatnonzero(_ALNUM[raw])
        first, last = np.searchsorted(solid, lo), np.searchsorted(solid, hi) - 1
        self.core = last >= first
        s = np.where(self.core, solid[np.minimum(first, max(len(solid) - 1, 0))] if len(solid)
                     else lo, lo)
        e = np.where(self.core, solid[last] + 1 if len(solid) else lo, lo)
        # substring hashes from running sums, modulo 2^64
        powers = np.ones(len(raw) + 1, np.uint64)
        powers[1:] = np.uint64(_BASE)
        back = np.ones(len(raw) + 1, np.uint64)
        back[1:] = np.uint64(_INVERSE)
        powers, back = np.multiply.accumulate(powers), np.multiply.accumulate(back)
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=total[1:])

        def part(a, b, kind):
            x = mix64((total[b] - total[a]) * back[a] + _KINDS[kind])
            return (x & np.uint64(DIM - 1)).astype(np.int64)
        cols = [np.where(self.core, part(s, e, "word"), -1)]
        for k in (3, 4, 5, 6):
            cols.append(np.where(e - s > k, part(s, np.minimum(s + k, e), str(k)), -1))
        cols.append(np.where(hi > e, part(e, np.minimum(hi, e + 4), "marks"), -1))

        def count(mask):
            c = np.concatenate([[0], np.cumsum(mask)])
            return c[hi] - c[lo]
        upper, lower = count(_UPPER[raw] | accented), count(_LOWER[raw] | (lead & (raw > 0x9E)))
        self.upper = (upper > 1) & (lower == 0)
        self.digit = count(_DIGIT[raw]) > 0
        self.bare = ~self.core
        self.long = (e - s) > 24
        self.marks = (hi - e > 0) & ~np.isin(raw[np.maximum(hi - 1, 0)] if len(raw) else lo,
                                             [ord(c) for c in ".,;:?!)\"'"]) & self.core
        cols.append(np.where(self.upper, _fid("upper"), -1))
        cols.append(np.where(self.digit, _fid("digit"), -1))
        self.features = np.stack(cols, 1)     # (words, kinds), -1: none


def _rate(x: np.ndarray) -> np.ndarray:
    """Rate in [0, 1] -> one of 12 steps, finer near 0."""
    return np.digitize(x, [1e-9, .003, .01, .02, .05, .1, .2, .3, .4, .55, .75])


def _text_pairs(texts: pa.Array, weights: np.ndarray | None = None):
    """Distinct (document, feature) pairs; only features of non-zero weight if given."""
    off, words, codes = tokenize(texts)
    n = len(off) - 1
    vocab = Vocabulary(words)
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(off))
    keep = vocab.features >= 0
    if weights is not None:
        keep &= weights[np.maximum(vocab.features, 0)] != 0
    useful = keep.any(1)[codes] if len(codes) else np.zeros(0, bool)
    pair = np.unique(doc[useful] * max(1, len(words)) + codes[useful])
    pdoc, pword = np.divmod(pair, max(1, len(words)))
    parts = []
    for j in range(vocab.features.shape[1]):
        on = keep[pword, j]
        parts.append(pdoc[on] * DIM + vocab.features[pword[on], j])
    total = np.maximum(np.diff(off), 1)
    flags = {k: getattr(vocab, k)[codes] if len(codes) else np.zeros(0, bool)
             for k in ("upper", "marks", "bare", "long", "digit")}
    same = np.zeros(len(codes), bool)
    same[1:] = (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])
    flags["twice"] = same
    for name, flag in flags.items():
        ids = np.array([_fid(f"rate:{name}:{i}") for i in range(12)])
        parts.append(np.arange(n) * DIM + ids[_rate(np.bincount(doc, flag, n) / total)])
    return n, np.unique(np.concatenate(parts))


def text_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, feature ids) of every text; ids distinct within a text."""
    n, both = _text_pairs(texts)
    doc, ids = np.divmod(both, DIM)
    return np.searchsorted(doc, np.arange(n + 1)), ids


def meta_view(source: list, lang: list, n_chars: list) -> tuple[np.ndarray, np.ndarray]:
    rows = []
    for s, g, c in zip(source, lang, n_chars):
        size = "-" if c is None else str(int(np.log2(max(c, 0) + 1)))
        rows.append([_fid(f"s:{s}"), _fid(f"l:{g}"), _fid(f"z:{size}"), _fid(f"sl:{s}|{g}"),
                     _fid(f"lz:{g}|{size}"), _fid(f"sz:{s}|{size}")])
    return np.arange(len(rows) + 1) * 6, np.array(rows, np.int64).reshape(-1)


class Linear:
    """Logistic regression on the features of a view that tell the classes apart.

    Weights start at half the smoothed log-ratio of the feature's document
    frequencies, so that rare but one-sided features count from the beginning.
    """

    def __init__(self, features: int = 60_000, least: int = 5, apart: float = 3.5,
                 l2: float = 2e-5, steps: int = 150, rate: float = 0.1):
        self.features, self.least, self.apart = features, least, apart
        self.l2, self.steps, self.rate = l2, steps, rate

    def fit(self, off: np.ndarray, ids: np.ndarray, y: np.ndarray) -> "Linear":
        row = np.repeat(np.arange(len(y), dtype=np.int32), np.diff(off))
        seen = np.bincount(ids, minlength=DIM)
        pos = np.bincount(ids[y[row] > 0], minlength=DIM)
        base = y.mean()
        z = np.abs(pos - seen * base) / np.sqrt(seen * base * (1 - base) + 1e-9)
        good = np.flatnonzero((seen >= self.least) & (z >= self.apart))
        good = np.sort(good[np.argsort(-z[good], kind="stable")[:self.features]])
        slot = np.full(DIM, -1, np.int32)
        slot[good] = np.arange(len(good))
        col = slot[ids]
        row, col = row[col >= 0], col[col >= 0]
        n_pos, n_neg = y.sum(), len(y) - y.sum()
        w = 0.5 * (np.log((pos[good] + 0.5) / (n_pos + 1))
                   - np.log((seen[good] - pos[good] + 0.5) / (n_neg + 1)))
        b = np.log(base / (1 - base))
        m, v, t = np.zeros(len(good) + 1), np.zeros(len(good) + 1), 0
        for _ in range(self.steps):      # Adam, full batch
            p = 1 / (1 + np.exp(-np.clip(b + np.bincount(row, w[col], len(y)), -30, 30)))
            g = (p - y) / len(y)
            grad = np.append(np.bincount(col, g[row], len(w)) + self.l2 * w, g.sum())
            t += 1
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
            step = self.rate * m / (1 - 0.9 ** t) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
            w, b = w - step[:-1], b - step[-1]
        self.w, self.b = np.zeros(DIM, np.float32), float(b)
        self.w[good] = w
        return self

    def logit(self, off: np.ndarray, ids: np.ndarray) -> np.ndarray:
        n = len(off) - 1
        return self.b + np.bincount(np.repeat(np.arange(n), np.diff(off)), self.w[ids], n)


def platt(logit: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """(a, c) so that a * logit + c is a calibrated log-odds (Newton steps)."""
    hi, lo = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    goal, x = np.where(y > 0, hi, lo), np.stack([logit, np.ones_like(logit)], 1)
    k = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ k, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        k = k - np.clip(np.linalg.solve(h, x.T @ (p - goal)), -1, 1)
    return float(max(k[0], 0.0)), float(k[1])


def _pick(off, ids, rows):
    """The given rows of a ragged matrix."""
    n = np.diff(off)[rows]
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(off[rows], n)
    return np.concatenate([[0], np.cumsum(n)]), ids[at]


def co_train(views: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, train: np.ndarray,
             held: np.ndarray, rounds: int = ROUNDS) -> list[tuple[Linear, float, float]]:
    """Fitted and calibrated (classifier, a, c) of each view.

    ``y`` is 1, 0 or -1 (pool); ``train`` marks the labelled rows that are
    fitted on, ``held`` those that calibrate.
    """
    guess = [np.where(train, y, -1) for _ in views]
    pool = y < 0
    prior = y[y >= 0].mean()
    out: list = []
    for r in range(rounds):
        out = []
        for (off, ids), labels in zip(views, guess):
            rows = np.flatnonzero(labels >= 0)
            model = Linear().fit(*_pick(off, ids, rows), labels[rows].astype(float))
            a, c = platt(model.logit(*_pick(off, ids, np.flatnonzero(held))),
                         y[held].astype(float))
            out.append((model, a, c))
        if r == rounds - 1:
            break
        for v, (model, a, c) in enumerate(out):
            p = 1 / (1 + np.exp(-np.clip(a * model.logit(*views[v]) + c, -30, 30)))
            other = guess[1 - v]
            free = pool & (other < 0)
            for label, sure, share in ((1, p, prior), (0, 1 - p, 1 - prior)):
                rows = np.flatnonzero(free & (sure >= SURE))
                rows = rows[np.argsort(-sure[rows], kind="stable")]
                other[rows[:int(HANDED * share * pool.sum()) + 1]] = label
    return out


def telling(rows: list[np.ndarray], y: np.ndarray, train: np.ndarray, least: int = 5,
            apart: float = 2.5, step: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, feature ids) of the rows, only features that tell the classes
    apart on the training rows; works through the rows in small steps."""
    seen, pos = np.zeros(DIM, np.int32), np.zeros(DIM, np.int32)
    at = np.flatnonzero(train)
    for lo in range(0, len(at), step):
        part = at[lo:lo + step]
        for total, some in ((seen, part), (pos, part[y[part] > 0])):
            if len(some):
                np.add.at(total, np.concatenate([rows[i] for i in some]), 1)
    base = y[train].mean()
    with np.errstate(invalid="ignore"):
        z = np.abs(pos - seen * base) / np.sqrt(seen * base * (1 - base) + 1e-9)
    keep = (seen >= least) & (z >= apart)
    kept = [r[keep[r]] for r in rows]
    return np.concatenate([[0], np.cumsum([len(k) for k in kept])]), np.concatenate(
        [np.empty(0, np.int32), *kept])


def fit_views(sample: pa.Table) -> list[tuple[Linear, float, float]] | float:
    """Classifiers from the sample, or the score of all if it has one class."""
    y = sample.column("y").to_numpy().astype(np.int64)
    known = y >= 0
    if not known.any() or y[known].min() == y[known].max():
        return float(y[known].mean()) if known.any() else 1.0
    meta = meta_view(*(sample.column(c).to_pylist() for c in ("source", "lang", "n_chars")))
    # every fifth labelled row of each class calibrates; with too few, all do both
    held = np.zeros(len(y), bool)
    for label in (0, 1):
        held[np.flatnonzero(y == label)[::5]] = True
    train = known & ~held
    if len(np.unique(y[train])) < 2:
        train = held = known
    rows = [np.frombuffer(x.as_buffer(), np.int32) for c in sample.column("ids").chunks for x in c]
    return co_train([telling(rows, y, train), meta], y, train, held)


def _features(batches):
    for t in sized(batches, TEXT_BYTES):
        off, ids = text_view(t.column("text").combine_chunks())
        yield pa.RecordBatch.from_arrays(
            [t.column(c).combine_chunks() for c in ("doc_id", "y", "source", "lang", "n_chars")]
            + [pa.array([ids[a:b].astype(np.int32).tobytes() for a, b in zip(off, off[1:])],
                        pa.binary())],
            names=["doc_id", "y", "source", "lang", "n_chars", "ids"])


MODEL = "view int, a double, c double, b double, prior double, ids binary, w binary"


def _fit(table):
    """The sample (one group, at most LABELLED + POOL rows) -> a row per view:
    its calibration and non-zero weights.  A single row of view -1 holds the
    score of all documents when there is nothing to tell apart."""
    table = table.take(pa.array(np.argsort(table.column("doc_id").to_numpy())))
    y = table.column("y").to_numpy()
    models = fit_views(table)
    if isinstance(models, float):
        rows = [(-1, models, 0.0, 0.0, 0.0, b"", b"")]
    else:
        share = y[y >= 0].mean()
        prior = float(np.log(share / (1 - share)))
        rows = []
        for v, (m, a, c) in enumerate(models):
            ids = np.flatnonzero(m.w).astype(np.int32)
            rows.append((v, a, c, m.b, prior, ids.tobytes(), m.w[ids].tobytes()))
    kinds = (pa.int32(), *[pa.float64()] * 4, pa.binary(), pa.binary())
    return pa.table({n.split()[0]: pa.array([r[i] for r in rows], k)
                     for i, (n, k) in enumerate(zip(MODEL.split(", "), kinds))})


def _scores(rows: list, share: float):
    """Scores under the share of fit documents among all labels."""
    def load(row):
        m = Linear()
        m.w, m.b = np.zeros(DIM, np.float32), row["b"]
        m.w[np.frombuffer(row["ids"], np.int32)] = np.frombuffer(row["w"], np.float32)
        return m, row["a"], row["c"]

    def run(batches):
        models = [load(r) for r in rows] if len(rows) == 2 else None
        for t in sized(batches, TEXT_BYTES):
            if models is None:       # one score for all, or an empty sample
                text = meta = both = np.full(t.num_rows, rows[0]["a"] if rows else 1.0)
                kept = np.ones(t.num_rows, bool)
            else:
                (tm, ta, tc), (mm, ma, mc) = models
                n, pairs = _text_pairs(t.column("text").combine_chunks(), tm.w)
                doc, ids = np.divmod(pairs, DIM)
                # from the sample's proportions to those of all labels
                shift = np.log(share / (1 - share)) - rows[0]["prior"]
                a = ta * (tm.b + np.bincount(doc, tm.w[ids], n)) + tc + shift
                b = ma * mm.logit(*meta_view(*(t.column(c).to_pylist() for c in (
                    "source", "lang", "n_chars")))) + mc + shift
                text, meta, both = (1 / (1 + np.exp(-np.clip(x, -30, 30)))
                                    for x in (a, b, a + b - shift - rows[0]["prior"]))
                kept = both >= KEEP_AT
            for name, col in {"p_text": text, "p_meta": meta, "score": both}.items():
                t = t.append_column(name, pa.array(col, pa.float64()))
            t = t.append_column("kept", pa.array(kept))
            yield from t.combine_chunks().to_batches()
    return run


RESULT = ("p_text", "p_meta", "score", "kept")


def classify_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """All document rows with p_text, p_meta, score and kept (columns of these
    names in the input are replaced)."""
    docs = documents.drop(*RESULT)
    known = labels.where("doc_id is not null and quality is not null and toxic is not null") \
        .groupBy("doc_id").agg(((F.min("quality") == 1) & (F.max("toxic") == 0)).cast("int")
                               .alias("y"))
    ids = docs.where("doc_id is not null").select("doc_id").distinct()
    first = lambda df, n: df.orderBy(F.xxhash64("doc_id", F.lit(29)), "doc_id").limit(n)
    known = stored(known.join(ids, "doc_id"))
    count = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    fit, unfit = count.get(1, 0), count.get(0, 0)
    share = fit / max(1, fit + unfit)
    rare = int(fit < unfit)
    drawn = min(count.get(rare, 0), int(LABELLED * max(RARE, min(share, 1 - share))))
    chosen = first(known.where(F.col("y") == rare), drawn).unionByName(
        first(known.where(F.col("y") != rare), LABELLED - drawn)).unionByName(
        first(ids.join(known, "doc_id", "left_anti"), POOL).withColumn("y", F.lit(-1)))
    # LABELLED + POOL rows of two numbers at most
    sample = docs.select("doc_id", "text", "source", "lang", F.col("n_chars").cast("long")
                         .alias("n_chars")).join(F.broadcast(stored(chosen)), "doc_id")
    sample = sample.mapInArrow(
        _features, "doc_id long, y int, source string, lang string, n_chars long, ids binary")
    # one row for a repeated doc_id, combined map-side: the bound holds
    sample = sample.groupBy("doc_id").agg(F.min(F.struct(
        "y", "source", "lang", "n_chars", "ids")).alias("r")).select("doc_id", "r.*")
    models = stored(sample.groupBy(F.lit(0).alias("all")).applyInArrow(_fit, MODEL)).collect()
    models = sorted(({k: bytes(v) if isinstance(v, bytearray) else v for k, v in r.asDict().items()}
                     for r in models), key=lambda r: r["view"])
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.DoubleType()) for n in RESULT[:3]),
                           T.StructField("kept", T.BooleanType())])
    return docs.mapInArrow(_scores(models, share), schema)
