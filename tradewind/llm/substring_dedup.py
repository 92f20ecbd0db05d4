"""Operator 1: substring dedup by De Bruijn compaction.

Every run of ``k`` = 13 words is an edge of the token graph (from its first to
its last 12 words).  A word is removed when it lies in a window whose words
also start in a document with a smaller doc_id.

1. *Edges.*  Map tasks hash all edges of their documents.  Within one map batch
   an edge is sent on only from its smallest document; larger documents of the
   batch have found an owner already.  A passage held by a third of all
   documents so crosses the shuffle once per batch, not once per document.
   Edges travel packed, one row per (batch, hash bucket).
2. *Owners.*  A bucket finds the smallest document of each edge; the others
   become source coordinates (doc, pos) -> (owner, position there).
3. *Compaction.*  Joined per document, edges that follow each other both here
   and in one owner form a nonbranching path, kept as one record; a path ends
   where the owner or the offset branches.
4. *Verification.*  Documents are joined with the paths that end and start in
   them; the words of every path are digested at both source coordinates and
   the two sides compared.  If they differ anywhere (a 64-bit collision), the
   run is repeated with 128-bit edges, and fails if these collide as well.

Defined results: one row per input row.  Null or blank text has no words.
Repeated rows get equal results; rows of one doc_id never remove each other's
words; their texts are spread by id and text, and repeated rows of a map batch
travel as one.  A null doc_id neither removes nor loses words, and is finished
where it is read.  Extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, tokenize, window_hashes, word_hashes
from .packed import SCHEMA, pack, sized, unpack

K = 13
#: Text bytes of one map batch, and (on average) of one document batch.
BATCH_BYTES = 8 << 20
#: A document is known by its id and some bits of its text's hash (ids may
#: repeat): 16 bits, or all 64 in a repeated run.  An owner has the same bits.
_DOC = [("doc", "<i8"), ("tag", "<i2"), ("pos", "<u4")]
_OWNER = [("owner", "<i8"), ("otag", "<i2"), ("at", "<u4")]
RESULT = "doc_id long, times long, n_words long, n_removed long, kept_sha256 string, check decimal(38,0)"


def _dtype(fields: list[tuple[str, str]], hashes: int) -> np.dtype:
    return np.dtype([(n, "<i8" if hashes > 1 and t == "<i2" else t) for n, t in fields])


def edge_dtype(hashes: int) -> np.dtype:
    return _dtype([(f"h{i}", "<u8") for i in range(hashes)] + _DOC, hashes)


def hit_dtype(hashes: int) -> np.dtype:
    return _dtype(_DOC + _OWNER, hashes)


def path_dtype(hashes: int) -> np.dtype:
    return _dtype(_DOC + _OWNER + [("n", "<i4")], hashes)


def _spread(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Concatenated arange(start, end)."""
    n = ends - starts
    before = np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else n
    return np.arange(int(n.sum()), dtype=np.int64) + np.repeat(starts - before, n)


def edges_of(table: pa.Table, k: int, hashes: int) -> np.ndarray:
    """Every k-word window of every document, as records."""
    off, words, codes = tokenize(table.column("text").combine_chunks())
    starts, ends = off[:-1], np.maximum(off[1:] - (k - 1), off[:-1])
    at = _spread(starts, ends)
    row = np.repeat(np.arange(len(starts)), ends - starts)
    out = np.empty(len(at), edge_dtype(hashes))
    for i in range(hashes):
        out[f"h{i}"] = window_hashes(word_hashes(words, 101 + i)[codes], k)[at]
    out["doc"] = table.column("doc_id").to_numpy()[row]
    out["tag"] = table.column("tag").to_numpy()[row]
    out["pos"] = at - starts[row]
    return out


def _by_edge(e: np.ndarray, hashes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by (edge, doc, tag, pos); index of each edge's first record; its
    number for every record."""
    e = e[np.lexsort((e["pos"], e["tag"], e["doc"]))]
    for i in range(hashes):
        e = e[np.argsort(e[f"h{i}"], kind="stable")]
    new = np.ones(len(e), bool)
    if len(e):
        new[1:] = False
        for i in range(hashes):
            new[1:] |= e[f"h{i}"][1:] != e[f"h{i}"][:-1]
    first = np.flatnonzero(new)
    return e, first, np.cumsum(new) - 1


def _hits(e: np.ndarray, first: np.ndarray, group: np.ndarray, hashes: int) -> tuple[np.ndarray, np.ndarray]:
    """(mask of records above their edge's smallest document, their hits)."""
    own = e[first][group]
    above = e["doc"] > own["doc"]
    hit = np.empty(int(above.sum()), hit_dtype(hashes))
    for c in ("doc", "tag", "pos"):
        hit[c] = e[c][above]
    hit["owner"], hit["otag"], hit["at"] = (own[c][above] for c in ("doc", "tag", "pos"))
    return above, hit[np.lexsort((hit["pos"], hit["tag"], hit["doc"]))]


def compact(hit: np.ndarray, hashes: int) -> np.ndarray:
    """Hits sorted by document and position -> maximal nonbranching paths."""
    if not len(hit):
        return np.empty(0, path_dtype(hashes))
    new = np.ones(len(hit), bool)
    same = np.ones(len(hit) - 1, bool)
    for c, step in (("doc", 0), ("tag", 0), ("owner", 0), ("otag", 0), ("pos", 1), ("at", 1)):
        same &= hit[c][1:] == hit[c][:-1] + step
    new[1:] = ~same
    first = np.flatnonzero(new)
    out = np.empty(len(first), path_dtype(hashes))
    for c in hit.dtype.names:
        out[c] = hit[c][first]
    out["n"] = np.diff(np.append(first, len(hit)))
    return out


def _batch_of(doc: np.ndarray, tag: np.ndarray, n: int) -> np.ndarray:
    """Document batch of an id and a text tag."""
    x = doc ^ (tag.astype(np.int64) << np.int64(24))
    return np.mod(x ^ (x >> np.int64(17)), np.int64(n))


def _map_edges(k: int, hashes: int, buckets: int, docs: int):
    def run(batches):
        for t in sized(batches, BATCH_BYTES):
            t, _ = _once(t)
            e, first, group = _by_edge(edges_of(t, k, hashes), hashes)
            above, hit = _hits(e, first, group, hashes)
            rest = e[~above]
            rest = rest[np.lexsort((rest["pos"], rest["tag"], rest["doc"]))]
            yield pack(0, (rest["h0"] % np.uint64(buckets)).astype(np.int64), rest)
            yield pack(1, _batch_of(hit["doc"], hit["tag"], docs), hit)
    return run


def _owners(hashes: int, docs: int):
    def run(key, table):
        if key[0].as_py() == 1:
            return table
        e, first, group = _by_edge(unpack(table, edge_dtype(hashes)), hashes)
        hit = _hits(e, first, group, hashes)[1]
        return pa.Table.from_batches([pack(1, _batch_of(hit["doc"], hit["tag"], docs), hit)])
    return run


def _paths(hashes: int, docs: int):
    def run(key, table):
        hit = unpack(table, hit_dtype(hashes))
        hit = hit[np.lexsort((hit["at"], hit["otag"], hit["owner"], hit["pos"], hit["tag"],
                              hit["doc"]))]
        twice = np.zeros(len(hit), bool)  # of input rows that are repeated as a whole
        twice[1:] = np.logical_and.reduce([hit[c][1:] == hit[c][:-1] for c in ("doc", "tag", "pos")])
        path = compact(hit[~twice], hashes)
        # to the batch of the document, and to the batch of the owner
        return pa.Table.from_batches([pack(2, np.full(len(path), key[0].as_py()), path),
                                      pack(3, _batch_of(path["owner"], path["otag"], docs), path)])
    return run


def _once(t: pa.Table | pa.RecordBatch) -> tuple[pa.Table, np.ndarray]:
    """The different (doc_id, text) of a batch, and how many rows each stands for."""
    at: dict = {}
    for i, key in enumerate(zip(t.column("doc_id").to_pylist(), t.column("text").to_pylist())):
        at.setdefault(key, []).append(i)
    rows = list(at.values())
    return (t.take(pa.array([r[0] for r in rows], pa.int64())),
            np.array([len(r) for r in rows], np.int64))


def _zip(docs: int):
    """Texts as zstd bytes: about half of what the shuffle's own compression
    leaves of them.  Repeated rows of a map batch travel as one."""
    def run(batches):
        codec = pa.Codec("zstd", compression_level=1)
        for t in sized(batches, BATCH_BYTES):
            t, times = _once(t)
            raw = [None if x is None else x.encode() for x in t.column("text").to_pylist()]
            key = _batch_of(t.column("doc_id").to_numpy(), t.column("tag").to_numpy(), docs)
            part = pa.table(
                [t.column("doc_id"), t.column("tag"), pa.array(key, pa.int64()), pa.array(times),
                 pa.array([None if r is None else len(r) for r in raw], pa.int64()),
                 pa.array([None if r is None else codec.compress(r, asbytes=True) for r in raw],
                          pa.binary())], names=["doc_id", "tag", "key", "times", "size", "text"])
            yield from part.combine_chunks().to_batches()
    return run


def _alone(batches):
    """Results of rows without an id, whose words all stay."""
    for b in batches:
        words = [(t or "").encode().split() for t in b.column("text").to_pylist()]
        n = len(words)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array([len(w) for w in words], pa.int64()),
             pa.array([0] * n, pa.int64()),
             pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words], pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def _digest(path: np.void, side: int, body: bytes, starts: np.ndarray, ends: np.ndarray,
            k: int) -> int:
    """Path record and its words at one of the two source coordinates."""
    lo = int(path["pos"] if side == 2 else path["at"])
    hi = lo + int(path["n"]) + k - 1
    words = body[starts[lo]:ends[hi - 1]] if hi <= len(ends) else b"\xff"
    return xxhash.xxh64_intdigest(path.tobytes() + words, 7)


def _finish(k: int, hashes: int):
    def run(docs: pa.Table, paths: pa.Table):
        kinds = paths.column("kind").to_numpy()
        mine, theirs = (unpack(paths.filter(pa.array(kinds == s)),
                                path_dtype(hashes)) for s in (2, 3))

        def index(p, doc, tag):
            p = p[np.lexsort((p[tag], p[doc]))]
            new = np.flatnonzero(np.append(True, (p[doc][1:] != p[doc][:-1])
                                           | (p[tag][1:] != p[tag][:-1]))) if len(p) else []
            ends = np.append(new[1:], len(p)) if len(p) else []
            return {(int(p[doc][a]), int(p[tag][a])): p[a:b] for a, b in zip(new, ends)}

        own, asked = index(mine, "doc", "tag"), index(theirs, "owner", "otag")
        ids, tags = docs.column("doc_id").to_pylist(), docs.column("tag").to_pylist()
        texts, sizes = docs.column("text").to_pylist(), docs.column("size").to_pylist()
        codec = pa.Codec("zstd")
        out = {"doc_id": ids, "times": docs.column("times").to_pylist(), "n_words": [],
               "n_removed": [], "kept_sha256": [], "check": []}
        seen: set = set()
        for i, key in enumerate(zip(ids, tags)):
            words = codec.decompress(texts[i], sizes[i], asbytes=True).split() if sizes[i] else []
            n, check, gone, kept = len(words), 0, 0, words
            sides = [(s, d[key]) for s, d in ((2, own), (3, asked)) if key in d]
            if sides:
                if key not in seen:
                    seen.add(key)
                    body = b" ".join(words)
                    ends = np.cumsum([len(w) + 1 for w in words]) - 1
                    starts = np.append(0, ends[:-1] + 1)
                    for side, ps in sides:
                        for p in ps:
                            x = _digest(p, side, body, starts, ends, k)
                            check += x if side == 2 else -x
                if key in own:
                    mark = np.zeros(n + 1, np.int64)
                    p = own[key]
                    np.add.at(mark, p["pos"], 1)
                    np.add.at(mark, np.minimum(p["pos"] + p["n"] + k - 1, n), -1)
                    cover = np.cumsum(mark)[:n] > 0
                    gone = int(cover.sum())
                    kept = [words[j] for j in np.flatnonzero(~cover)]
            out["n_words"].append(n)
            out["n_removed"].append(gone)
            out["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
            out["check"].append(check)
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), (
            pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.decimal128(38, 0)))})
    return run


def substring_dedup(documents: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document row."""
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_batches = (size // BATCH_BYTES) | 1
    n_buckets = 256 * (size // (256 * BATCH_BYTES) + 1)
    for hashes in (1, 2):
        tag = F.xxhash64("text")
        docs = documents.select("doc_id", "text", (
            F.shiftright(tag, 48) if hashes == 1 else tag).alias("tag"))
        named = docs.where("doc_id is not null")
        edges = named.where("text is not null").mapInArrow(
            _map_edges(k, hashes, n_buckets, n_batches), SCHEMA)
        hits = edges.groupBy("kind", "key").applyInArrow(_owners(hashes, n_batches), SCHEMA)
        paths = stored(hits.groupBy("key").applyInArrow(_paths(hashes, n_batches), SCHEMA))
        batched = named.mapInArrow(_zip(n_batches), "doc_id long, tag long, key long, times long, "
                                                    "size long, text binary")
        done = stored(batched.groupBy("key").cogroup(paths.groupBy("key")).applyInArrow(
            _finish(k, hashes), RESULT))
        if not int(done.agg(F.sum("check")).first()[0] or 0):
            # no more rows each than a map batch has
            every = done.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
            return every.select("doc_id", "n_words", "n_removed", "kept_sha256").unionAll(
                docs.where("doc_id is null").select("doc_id", "text").mapInArrow(
                    _alone, "doc_id long, n_words long, n_removed long, kept_sha256 string"))
    raise RuntimeError("two window texts share a 128-bit hash")
