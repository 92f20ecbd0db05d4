"""Operator 4: line dedup with content-defined line chunks.

A document's lines are cut wherever the line hash falls from one line to the
next; of falls in a row every other one cuts, so chunks have at least two lines
(but for a last line left over).  A cut so depends on the two lines around it
and the falls just before, boundaries move with the content, and an inserted
line changes only the chunks around it.  A chunk of two or more lines that occurs
more than once in all documents is removed everywhere but at its first place
(smallest doc_id, then text hash, then position).  A repeated passage stays
where no chunk lies whole inside it: of the lines in runs of two and more that an
earlier text held already, about a third are removed (figures in the README).

1. One scan groups the chunks by their bytes, so that equality is a comparison
   of bytes and a chunk held by a third of all documents is combined map-side;
   each group with more than one place keeps its first.
2. Every other place is marked (join on hash and SHA-256, which stand for the
   compared bytes).  Chunks that hold more than 1 / ``HOT`` of the repeating
   places, fewer than ``HOT``, are broadcast; the others meet by a merge join.
3. The documents are put together again without the marked places.

Defined results: one row per input row.  Null text has no lines and stays null;
empty text is one empty line.  Lines are split at ``\\n`` only.  A null doc_id
counts as the smallest.  Repeated rows (doc_id and text) are one document and
get equal results.  Extra columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Places of one chunk, among those of all repeating chunks, that may meet by a join: 1 / HOT.
HOT = 4_096


def chunks_of(text: str | None) -> list[list[str]]:
    """The lines of a text, chunk by chunk."""
    if text is None:
        return []
    lines = text.split("\n")
    h = [xxhash.xxh64_intdigest(x.encode()) for x in lines]
    ends = [0]
    for i in range(2, len(lines)):
        if h[i] < h[i - 1] and i - ends[-1] > 1:
            ends.append(i)
    return [lines[a:b] for a, b in zip(ends, [*ends[1:], len(lines)])]


def _chunks(batches):
    for b in batches:
        doc, tag, at, body, h = [], [], [], [], []
        for d, t, text in zip(b.column("doc_id").to_pylist(), b.column("tag").to_pylist(),
                              b.column("text")):
            for i, c in enumerate(chunks_of(text.as_py())):
                if len(c) > 1:
                    joined = "\n".join(c)
                    doc.append(d)
                    tag.append(t)
                    at.append(i)
                    body.append(joined)
                    h.append(xxhash.xxh64_intdigest(joined.encode()) - (1 << 63))
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array(tag, pa.int64()), pa.array(at, pa.int32()),
             pa.array(h, pa.int64()), pa.array(body, pa.string())],
            names=["doc_id", "tag", "at", "h", "body"])


def _rebuild(batches):
    for b in batches:
        n_lines, n_removed, texts = [], [], []
        for text, gone in zip(b.column("text"), b.column("gone")):
            chunks, gone = chunks_of(text.as_py()), set(gone.as_py() or ())
            n_lines.append(sum(map(len, chunks)))
            n_removed.append(sum(len(c) for i, c in enumerate(chunks) if i in gone))
            texts.append("\n".join(x for i, c in enumerate(chunks) if i not in gone for x in c)
                         if chunks else None)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(texts, pa.string())], names=["doc_id", "n_lines", "n_removed", "text"])


def line_dedup(documents: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and the kept text of every document row."""
    docs = documents.select("doc_id", F.xxhash64("text").alias("tag"), "text")
    chunks = docs.mapInArrow(_chunks, "doc_id long, tag long, at int, h long, body string")
    place = F.struct("doc_id", "tag", "at")
    # repeated rows are one document: distinct places are counted
    first = stored(chunks.groupBy("h", "body").agg(
        F.min(place).alias("owner"), F.max(place).alias("last"), F.count("*").alias("n")).where(
        "owner <> last").select("h", F.unhex(F.sha2("body", 256)).alias("sha"), "owner", "n"))
    often = (first.agg(F.sum("n")).first()[0] or 0) // HOT
    places = chunks.select(place.alias("place"), "h", F.unhex(F.sha2("body", 256)).alias("sha"))
    key = ["h", "sha"]
    hot = F.broadcast(first.where(F.col("n") > often + 1).drop("n"))
    cold = first.where(F.col("n") <= often + 1).drop("n").hint("merge")
    marked = places.join(hot, key).unionByName(places.join(hot, key, "left_anti").join(cold, key))
    removed = stored(marked.where("place <> owner").groupBy(
        "place.doc_id", "place.tag").agg(F.collect_set("place.at").alias("gone")))
    # one plan at every size: the texts move once
    whole = docs.alias("d").join(removed.alias("r").hint("merge"), F.expr(
        "d.doc_id <=> r.doc_id and d.tag = r.tag"), "left").select("d.doc_id", "text", "gone")
    return whole.mapInArrow(_rebuild, "doc_id long, n_lines long, n_removed long, text string")
