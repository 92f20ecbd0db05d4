"""Blocked pair comparison: a group of any size becomes a grid of block pairs.

Members of a group are dealt into blocks by hash; every pair of blocks is one
task.  A task returns for each member its links and one tree edge, never the
linked pairs, so the output is linear in the members.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components


def block_pairs(n_blocks: Column, own: Column) -> Column:
    """Array of (i, j), i <= j, that a member of block ``own`` takes part in."""
    return F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda o: F.struct(
        F.least(o, own).cast("int").alias("i"), F.greatest(o, own).cast("int").alias("j")))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node reachable from each of ``n`` nodes over links (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def settle(parts: DataFrame) -> DataFrame:
    """(id, links, parent) of all tasks -> (id, links, component)."""
    links = parts.groupBy("id").agg(F.sum("links").alias("links"))
    comp = connected_components(parts.where("id <> parent").select("id", "parent"), "id", "parent")
    return links.join(comp, "id", "left").select(
        "id", "links", F.coalesce("component", "id").alias("component"))
