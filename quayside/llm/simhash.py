"""SimHash near-duplicates found through pivot distance tables.

Fingerprints
    Every word shingle is hashed (XXH64, seed 42; further 64 bits by remixing the hash), and a bit
    of the fingerprint is set if it is set in over half of the hashes.

Candidates
    Pivot distances alone cannot be joined without looking at all pairs, because distances to
    references crowd around half the bits. An index therefore deals fingerprints into cells: for an
    exact search, by every choice of ``blocks - distance`` of ``blocks`` equal parts (two
    fingerprints that differ in no more bits than ``distance`` agree in one of them), how fine
    following from the number of fingerprints; for similarity search, by the shingles that come first
    in one order of all shingles, rare ones before common ones, so many of each text that two texts
    of that similarity share one of them, whatever the number of texts.

Pivots
    A cell starts with the table of Hamming distances of its fingerprints to a list of reference
    fingerprints. Two whose distances to any reference differ by more than ``distance`` cannot be
    within it and are discarded; the others are compared bit by bit.

A cell that holds more than `CELL` fingerprints is split into blocks, and every pair of blocks is a
cell of its own, so no task gets an unbounded cell. Each cell gives only the links of a least-distance
spanning forest: the classes come out the same, and a dense group gives no square of links. Where
texts are judged by their shingles afterwards, the forest gives loose groups that no candidate pair
leaves, and `set_classes` judges all that matters within each.
Identical fingerprints (or texts) are one node from the start.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.components import components
from quayside.llm.set_classes import linked
from quayside.llm.text import cut, narrow

SEED = 42
CELL = 1024
PIVOTS = 16
#: Pairs in one cell per fingerprint that the index aims to stay below.
CROWD = 0.1
#: Deviations granted to the fingerprints of texts that are judged by their shingles afterwards.
DEVIATIONS = 6
#: Texts (about) whose shingles are counted for their order, and shingles whose counts are kept. The
#: order decides how large cells are, never which texts meet.
ORDERED, COMMON = 10_000, 500_000


# Fingerprints

def _mixed(h: np.ndarray, lane: int) -> np.ndarray:
    """Further 64 bits of a hash: itself for lane 0, else multiplied and folded with odd constants."""
    if lane == 0:
        return h
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15 + 2 * lane)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of every shingle of `size` words, repeats included; fewer words are one shingle."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    joined = memoryview(b" ".join(parts))
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    last = max(1, len(parts) - size + 1)
    digest = xxhash.xxh64_intdigest
    width = min(size, len(parts)) - 1
    return np.fromiter((digest(joined[starts[i]:ends[i + width]], SEED) for i in range(last)), np.uint64, last)


def fingerprint(hashes: np.ndarray, lanes: int) -> bytes:
    """Big-endian bits set in over half of the hashes; all zero without any."""
    out = []
    for lane in range(lanes):
        if not len(hashes):
            out.append(bytes(8))
            continue
        count = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 1 << 16):  # bounded memory for texts of any length
            bits = np.unpackbits(_mixed(hashes[at:at + (1 << 16)], lane).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            count += bits.sum(0, dtype=np.int64)
        out.append(np.packbits(count * 2 > len(hashes)).tobytes())
    return b"".join(out)


def fingerprints(docs: DataFrame, size: int, bits: int) -> DataFrame:
    """doc_id, fp (binary of bits/8 bytes) and digest (of the text; null text as empty)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(shingle_hashes(t.as_py(), size), bits // 64) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), pa.array(prints, pa.binary())],
                names=["doc_id", "digest", "fp"])

    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"), text)
    kind = dict(docs.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, digest long, fp binary")


# Index

@lru_cache(maxsize=None)
def references(bits: int, count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints, random and fixed, as uint64 lanes."""
    return np.random.default_rng(SEED).integers(0, 1 << 64, (count, bits // 64), dtype=np.uint64)


def pivot_table(lanes: np.ndarray, bits: int) -> np.ndarray:
    """Hamming distances of fingerprints (rows of uint64 lanes) to every reference."""
    return np.stack([np.bitwise_count(lanes ^ r).sum(1) for r in references(bits)], axis=1).astype(np.uint8)


def block_keys(bits: int, distance: int, n: int) -> list[list[int]]:
    """Sets of bit positions of which every pair within `distance` agrees in one.

    Among 6 and more blocks, the fewest whose cells hold no more than `CROWD` random pairs per
    fingerprint.
    """
    for blocks in range(distance + 2, 2 * distance + 3):
        edges = [round(i * bits / blocks) for i in range(blocks + 1)]
        kept = blocks - distance
        sets = [sum((list(range(edges[b], edges[b + 1])) for b in c), []) for c in combinations(range(blocks), kept)]
        if n * sum(2.0 ** -len(s) for s in sets) <= 2 * CROWD:
            break
    return sets


def similar_distance(bits: int, similarity: float, deviations: float = DEVIATIONS) -> int:
    """Bits in which a pair of shingle sets of that similarity differs, plus some deviations."""
    turn = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.floor(bits * turn + deviations * math.sqrt(bits * turn * (1 - turn)))


def prefix(own: np.ndarray, common: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The first of a text's distinct shingles, by count and hash.

    Texts of Jaccard similarity `similarity` share at least that share of the shingles of each, so
    they share one of these. Texts without words share a zero.
    """
    if not len(own):
        return np.zeros(1, np.uint64)
    length = len(own) - math.ceil(similarity * len(own) - 1e-9) + 1
    seen = np.zeros(len(own), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, own), len(common) - 1)
        seen = np.where(common[at] == own, counts[at], 0)
    return own[np.lexsort((own, seen))[:length]]


def _common(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of more than one of about `ORDERED` texts, sorted, and how many have them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column("text"):
                own = np.unique(shingle_hashes(t.as_py(), size))
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64))], names=["shingle"])

    every = max(1, docs.count() // ORDERED)
    some = docs.select("text").where(F.pmod(F.xxhash64(F.xxhash64("text"), F.lit(SEED)), F.lit(every)) == 0)
    held = some.mapInArrow(run, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("held"))
    got = held.where("held > 1").orderBy(F.desc("held"), "shingle").limit(COMMON).toArrow()
    shingle = got.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(shingle)
    return shingle[order], got.column("held").to_numpy()[order]


def _indexed(docs: DataFrame, size: int, similarity: float, bits: int) -> DataFrame:
    """digest, fp, prefix and weight (number) of every text's distinct shingles, each counted once."""
    spread = docs.sparkSession.sparkContext.broadcast(_common(docs, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, counts = spread.value
        for batch in batches:
            prints, firsts, weights = [], [], []
            for t in batch.column("text"):
                own = np.unique(shingle_hashes(t.as_py(), size))
                weights.append(len(own))
                prints.append(fingerprint(own, bits // 64))
                firsts.append(prefix(own, common, counts, similarity).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(prints, pa.binary()), pa.array(firsts, pa.list_(pa.int64())),
                 pa.array(weights, pa.int64())], names=["digest", "fp", "prefix", "weight"])

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.xxhash64(text).alias("digest"), text.alias("text"))
    return rows.mapInArrow(run, "digest long, fp binary, prefix array<long>, weight long")


def _dealt(nodes: DataFrame, keys: list[list[int]], bits: int) -> DataFrame:
    """A row per node and key: cell (hash of the key's number and bits), node and fp."""
    positions = [np.asarray(k) for k in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                raw = np.frombuffer(b"".join(batch.column("fp").to_pylist()), np.uint8).reshape(-1, bits // 8)
                flat = np.unpackbits(raw, axis=1)
                for number, own in enumerate(positions):
                    code = np.packbits(flat[:, own], axis=1)
                    padded = np.zeros((len(code), 8 * -(-code.shape[1] // 8)), np.uint8)
                    padded[:, :code.shape[1]] = code
                    cell = np.full(len(code), number + 1, np.uint64)
                    for lane in padded.view(np.uint64).T:
                        cell = _mixed(cell ^ lane, 7)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell.view(np.int64)), batch.column("node"), batch.column("fp")],
                        names=["cell", "node", "fp"])

    return nodes.select("node", "fp").mapInArrow(run, "cell long, node long, fp binary")


def _close(lanes: np.ndarray, table: np.ndarray, distance: int) -> np.ndarray:
    """Distances within each row of cells (cells, members, ...), 255 and over where pivots discard."""
    n = table.shape[1]
    out = np.full((len(table), n, n), 10_000, np.int32)
    apart = np.abs(table[:, :, None, :].astype(np.int16) - table[:, None, :, :].astype(np.int16)).max(3)
    c, i, j = np.nonzero((apart <= distance) & np.triu(np.ones((n, n), bool), 1)[None])
    d = np.bitwise_count(lanes[c, i] ^ lanes[c, j]).sum(1)
    good = d <= distance
    out[c[good], i[good], j[good]] = d[good]
    out[c[good], j[good], i[good]] = d[good]
    return out


def _forest(d: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of a least-distance spanning forest of one cell, by Prim's method."""
    n, links = len(d), []
    open_ = np.ones(n, bool)
    best, source = np.full(n, 10_000), np.full(n, -1)
    for _ in range(n):
        at = int(np.where(open_, best, 20_000).argmin())
        if source[at] >= 0 and best[at] <= distance:
            links.append((int(source[at]), at))
        open_[at] = False
        nearer = open_ & (d[at] < best)
        best[nearer], source[nearer] = d[at][nearer], at
    return links


def _large(lanes: np.ndarray, table: np.ndarray, distance: int) -> np.ndarray:
    """Distances within one large cell, row blocks at a time so that memory stays bounded."""
    n = len(lanes)
    out = np.full((n, n), 10_000, np.int32)
    small = table.astype(np.int16)
    for at in range(0, n, 64):
        apart = np.abs(small[at:at + 64, None, :] - small[None]).max(2)
        i, j = np.nonzero(apart <= distance)
        d = np.bitwise_count(lanes[i + at] ^ lanes[j]).sum(1)
        good = (d <= distance) & (i + at != j)
        out[i[good] + at, j[good]] = d[good]
    return out


def _linked(bits: int, distance: int):
    """Task function: cells (lists of node and fp) to links a, b."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch.column("members")
            node, fp = members.flatten().flatten()
            lanes = np.frombuffer(b"".join(fp.to_pylist()), np.uint8).reshape(-1, bits // 8).view(">u8").astype(np.uint64)
            pivots = pivot_table(lanes, bits)
            sizes = np.asarray(members.value_lengths())
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes
            left, right = [], []
            for n in np.unique(sizes):
                own = starts[sizes == n]
                if n < 2:
                    continue
                if n > 64:
                    for s in own:
                        d = _large(lanes[s:s + n], pivots[s:s + n], distance)
                        for i, j in _forest(d, distance):
                            left.append(s + i), right.append(s + j)
                    continue
                step = max(1, 200_000 // (n * n))
                for at in range(0, len(own), step):
                    idx = own[at:at + step, None] + np.arange(n)
                    d = _close(lanes[idx], pivots[idx], distance)
                    for c in np.nonzero((d <= distance).any((1, 2)))[0]:
                        for i, j in _forest(d[c], distance):
                            left.append(idx[c, i]), right.append(idx[c, j])
            a, b = (node.take(pa.array(np.asarray(x, np.int64))) for x in (left, right))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    return run


def links(nodes: DataFrame, keys: list[list[int]], bits: int, distance: int, cell: int = CELL) -> DataFrame:
    """Links (a, b) between nodes within `distance`, enough to give all their classes."""
    return _met(_dealt(nodes, keys, bits), bits, distance, cell)


def _met(rows: DataFrame, bits: int, distance: int, cell: int = CELL) -> DataFrame:
    """Links (a, b) between nodes in one cell and within `distance`, of rows of cell, node and fp."""
    counts = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    parts = F.ceil(F.col("held") / F.lit(cell)).cast("int")
    held = rows.join(counts.select(F.col("cell"), parts.alias("parts")), "cell")
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int")
    other = F.sequence(F.lit(0), F.col("parts") - 1)
    placed = held.withColumn("_own", own).select(
        "cell", "node", "fp", "_own", F.explode(other).alias("_other")
    ).withColumns({"i": F.least("_own", "_other"), "j": F.greatest("_own", "_other")})
    cells = placed.groupBy("cell", "i", "j").agg(
        F.collect_list(F.struct("node", "fp")).alias("members")
    ).where(F.size("members") > 1)
    found = cells.select("members").mapInArrow(_linked(bits, distance), "a long, b long")
    return cut(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "simhash-links")


# Operators

def classes(docs: DataFrame, size: int = 4, distance: int = 4) -> DataFrame:
    """Classes of documents whose 64-bit fingerprints are linked at `distance` or fewer bits.

    Returns per row of `docs`: doc_id, fingerprint (16 hex digits) and component_id, the smallest
    doc_id reachable, the row's own included. The search is exact.

    A null or blank text has fingerprint zero and is linked like any other; fewer words than a
    shingle are one shingle; a row without doc_id is classed but gives no id (null if its whole
    class has none); repeated rows are returned as often as they occur; no rows give no rows; other
    columns are not looked at.
    """
    number = F.conv(F.hex("fp"), 16, -10).cast("long")
    prints = cut(fingerprints(docs, size, 64).select("doc_id", number.alias("node")), "simhash")
    nodes = cut(prints.groupBy("node").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    keys = block_keys(64, distance, nodes.count())
    digits = F.lpad(F.hex("node"), 16, "0")
    found = components(links(nodes.select("node", F.unhex(digits).alias("fp")), keys, 64, distance))
    placed = cut(nodes.join(found, "node", "left").select(
        "node", "least", F.coalesce("root", "node").alias("root")), "simhash-roots")
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(ids, "root").select("node", "component_id")
    return prints.join(named, "node").select("doc_id", F.lower(digits).alias("fingerprint"), "component_id")


def groups(docs: DataFrame, size: int = 5, similarity: float = 0.8, bits: int = 128) -> DataFrame:
    """Nearly equal texts: digest of a text and the digest `root` that stands for its group.

    Texts meet if they share one of their first shingles, as all of that similarity do, and are candidates
    if their fingerprints differ in no more bits than texts of that similarity do (`DEVIATIONS`
    granted). Texts connected by candidate pairs are a loose group. Within it, texts are linked if the
    Jaccard similarity of their shingle sets, computed from the whole texts, reaches `similarity`; every
    pair between texts that are not linked through others is judged. Only texts in links are listed.
    """
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    once = _indexed(docs, size, similarity, bits).groupBy("digest").agg(
        *[F.first(c).alias(c) for c in ("fp", "prefix", "weight")])
    seen = cut(once, "simhash-texts")
    rows = seen.select(F.explode("prefix").alias("cell"), F.col("digest").alias("node"), "fp")
    loose = components(_met(rows, bits, similar_distance(bits, similarity)))
    members = cut(loose.join(seen.select(F.col("digest").alias("node"), "weight"), "node").select(
        "node", F.col("root").alias("group"), "weight"), "simhash-members")
    held = texts.withColumn("node", F.xxhash64("text")).join(narrow(members.select("node")), "node", "left_semi")
    held = cut(held.dropDuplicates(["node"]), "simhash-held")
    true = linked(members, held, lambda text: shingle_hashes(text, size), similarity)
    return components(true).select(F.col("node").alias("digest"), "root")


def keep_one(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """`docs`, with all its columns, without all but one document of each group of near-duplicates.

    The document with the smallest id stays (null ids last; of repeated rows, one). A null text is an
    empty one, and texts that have no words are one group. Very long texts are compared whole. No rows
    give no rows; other columns are carried along, whatever their names.
    """
    digest = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    alike = groups(docs, size, similarity).select(F.col("digest").alias("_own"), "root")
    keys = docs.select(F.col("doc_id").alias("_id"), digest.alias("_digest"))
    rows = keys.groupBy("_id", "_digest").agg(F.count(F.lit(1)).alias("_n"))
    # Copies are brought down to one row a text before texts are grouped.
    firsts = rows.groupBy("_digest").agg(F.min(F.struct(F.col("_id").isNull().alias("_none"), F.col("_id"))).alias("_first"))
    rooted = firsts.join(alike, F.col("_digest") == F.col("_own"), "left").withColumn("_group", F.coalesce("root", "_digest"))
    stays = rooted.groupBy("_group").agg(F.min(F.struct("_first", "_digest")).alias("_stay")).select(
        F.col("_stay._first._id").alias("_kept_id"), F.col("_stay._digest").alias("_kept_digest"))
    same = F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_digest") == F.col("_kept_digest"))
    judged = rows.join(stays, same, "left").withColumn("_stays", F.col("_kept_digest").isNotNull())
    judged = cut(judged.where("_n > 1 or not _stays").select("_id", "_digest", "_stays"), "simhash-judged")
    hashed = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    here = docs["doc_id"].eqNullSafe(judged["_id"]) & (hashed == judged["_digest"])
    clean = docs.join(narrow(judged), here, "left_anti")
    repeated = cut(judged.where("_stays"), "simhash-repeated")
    if repeated.isEmpty():
        return clean
    here = docs["doc_id"].eqNullSafe(repeated["_id"]) & (hashed == repeated["_digest"])
    return clean.unionByName(docs.join(repeated, here, "left_semi").dropDuplicates(["doc_id", "text"]))
