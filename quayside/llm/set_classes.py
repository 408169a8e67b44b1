"""Exact classes of similar shingle sets within loose groups.

A loose group holds all texts that could be linked with each other, directly or through others. Its
members are compared in cells of bounded size. Within a cell an inverted index of the shingles counts
what one set shares with all others at once. The first few sets are compared with all; after that only
sets outside the largest class are, because two sets of different classes cannot both be in it.
No pair of sets of different classes is left unjudged.

A group larger than a cell is dealt into blocks. The first round compares each block within itself
and with a few members of the whole group that stand in every block, which is all that groups of near
copies need. Members that are then outside their group's largest class are compared, block against
block, with all others of the group in a second round.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.joins import per_salt, salted
from quayside.llm.components import components
from quayside.llm.text import cut

#: Sets of a cell, shingles of a cell (8 bytes each in a task), and members that stand in every block.
SETS, SHINGLES, CENTRES = 512, 4_000_000, 8


def classes_of(sets: list[np.ndarray], known: np.ndarray, similarity: float) -> np.ndarray:
    """Class labels of sets linked at a Jaccard similarity of `similarity` or more, directly or through
    others. `known` labels those already linked. Two empty sets are alike."""
    n = len(sets)
    labels = np.unique(known, return_inverse=True)[1]
    sizes = np.asarray([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1] if n else np.empty(0, np.int64)
    order = np.argsort(flat, kind="stable")
    holders, bounds = owner[order], np.concatenate([[0], np.cumsum(np.bincount(flat))]) if len(flat) else np.zeros(1, np.int64)
    starts = np.cumsum(sizes) - sizes

    def alike(i: int) -> np.ndarray:
        own = flat[starts[i]:starts[i] + sizes[i]]
        width = bounds[own + 1] - bounds[own]
        at = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(bounds[own], width)
        both = np.bincount(holders[at], minlength=n)
        union = sizes[i] + sizes - both
        return np.where(union > 0, both / np.maximum(union, 1), 1.0) >= similarity

    for i in range(n):
        if i >= CENTRES:
            if i == CENTRES:
                main = int(np.argmax(labels == np.bincount(labels).argmax()))
            if labels[i] == labels[main]:
                continue
        near = np.unique(labels[alike(i) | (np.arange(n) == i)])
        labels[np.isin(labels, near)] = near[0]
    return labels


def _judged(shingles: Callable[[str | None], np.ndarray], similarity: float):
    """Group function: members of a cell (node, known, text) to links that give its classes."""
    def judge(table: pa.Table) -> pa.Table:
        node = table["node"].to_numpy()
        node, first = np.unique(node, return_index=True)
        text, known = table["text"], table["known"].to_numpy()[first]
        sets = [np.unique(shingles(text[int(i)].as_py())) for i in first]
        labels = classes_of(sets, known, similarity)
        head = np.unique(labels, return_index=True)[1][np.unique(labels, return_inverse=True)[1]]
        linked = np.flatnonzero(head != np.arange(len(node)))
        return pa.table({"a": node[linked], "b": node[head[linked]]})

    return judge


def _cells(members: DataFrame, texts: DataFrame, keys: list[str], judge) -> DataFrame:
    """Links (a, b) of members (node, known, and `keys` that name a cell) joined with their texts."""
    return members.join(texts, "node").groupBy(*keys).applyInArrow(judge, "a long, b long")


def linked(
    members: DataFrame, texts: DataFrame, shingles: Callable[[str | None], np.ndarray], similarity: float,
    sets: int = SETS,
) -> DataFrame:
    """Links (a, b) that give the classes of `members` (node, group, weight) within each group.

    `texts` has node and text, each node once; `weight` is the number of a text's shingles.
    """
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / F.lit(sets), F.sum("weight") / F.lit(SHINGLES))).cast("int")
    large = members.groupBy("group").agg(parts.alias("parts")).where("parts > 1")
    dealt = salted(members.select("node", "group"), ["node"]).join(per_salt(large), ["group", "_salt"], "left").drop("_salt")
    block = F.pmod(F.xxhash64("node", F.lit(2)), F.coalesce("parts", F.lit(1))).cast("int")
    placed = cut(dealt.select("node", "group", "parts", block.alias("block")), "set-blocks")
    judge = _judged(shingles, similarity)
    # One member each of as many parts of the group, combined before the shuffle, stand in every block.
    centre = placed.where("parts is not null").groupBy("group", F.pmod(F.xxhash64("node", F.lit(3)), F.lit(CENTRES)).alias("k")).agg(
        F.min("node").alias("node"), F.first("parts").alias("parts"))
    everywhere = centre.select("node", "group", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("block"))
    cells = placed.select("node", "group", "block").unionByName(everywhere).withColumn("known", F.col("node"))
    links = cut(_cells(cells, texts, ["group", "block"], judge), "set-links")
    many = placed.where("parts is not null")
    if many.isEmpty():
        return links
    roots = components(links).select("node", F.col("root").alias("known"))
    known = cut(many.join(roots, "node", "left").withColumn("known", F.coalesce("known", "node")), "set-roots")
    held = known.groupBy("group", "known").agg(F.count(F.lit(1)).alias("held"))
    main = held.groupBy("group").agg(F.max_by("known", F.struct("held", "known")).alias("main"))
    others = known.join(held.join(main, "group").where("known <> main").select("group", "known"), ["group", "known"], "left_semi")
    count = others.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / F.lit(sets)).cast("int").alias("others"))
    row = F.pmod(F.xxhash64("node", F.lit(4)), F.col("others")).cast("int")
    left = salted(others, ["node"]).join(per_salt(count), ["group", "_salt"]).select(
        "node", "group", "known", row.alias("row"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("block"))
    right = salted(known, ["node"]).join(per_salt(count), ["group", "_salt"]).select(
        "node", "group", "known", F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("row"), "block")
    again = left.unionByName(right)
    return links.unionByName(cut(_cells(again, texts, ["group", "row", "block"], judge), "set-links"))
