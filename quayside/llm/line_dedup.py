"""Repeated lines dropped through a sharded minimal perfect hash.

Lines
    A text is split at ``\\n``. A line's key is the line without ASCII white space at both ends and with
    A-Z lower-cased; it stands as 128 bits of XXH3, `hi` and `lo`. Keys shorter than `least_chars` code
    points are never looked up.

Index
    Documents are dealt into buckets of about `BUCKET` by a hash of id and text, and each bucket counts its
    keys before anything is shuffled further, so a line that a third of all documents hold is one row per
    bucket. Distinct keys are dealt by `hi` into shards of about `SHARD` keys. A shard is one row: a
    minimal perfect hash (levels of bits; a key sits at the first level where nothing else meets it, and
    its number is the count of bits before it), and arrays in that numbering: 32 bits of `lo` as
    fingerprint, the number of documents, and the largest doc_id of keys found in enough documents.
    Keys that share `hi` with another are kept beside the arrays, whole.

Probes
    Each bucket asks the shards about its keys. Every key asked about is in the index, so a number is
    never that of another key; the fingerprint tells the keys kept beside. The shard's arrays are read
    once and the probes stream past them. What comes back to a bucket are its repeated keys, and its
    documents stream past those.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quayside.llm.answers import meet
from quayside.llm.text import cut

BUCKET = 1024
SHARD = 1 << 16
#: Levels of a perfect hash; keys left after them (none in practice) are kept beside the arrays.
LEVELS = 48
BLANK = b" \t\n\x0b\x0c\r"


# Lines

def line_key(line: bytes, least_chars: int) -> bytes | None:
    """128 bits that stand for a line's key; None if it has fewer than `least_chars` code points."""
    key = line.strip(BLANK)
    if len(key) < least_chars or not key.isascii() and len(key.decode("utf-8", "replace")) < least_chars:
        return None
    return xxhash.xxh3_128_digest(key.lower())


def _split(keys: bytes) -> tuple[pa.Array, pa.Array]:
    """Joined 128-bit keys as two columns of longs."""
    both = np.frombuffer(keys, ">i8").astype(np.int64).reshape(-1, 2)
    return pa.array(both[:, 0]), pa.array(both[:, 1])


def _keys(docs: DataFrame, least_chars: int) -> DataFrame:
    """bucket, hi, lo and doc_id of every key of every document, once a document."""
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys = [], []
            for text in batch.column("_text"):
                own = {line_key(line, least_chars) for line in text.as_py().split(b"\n")} - {None}
                sizes.append(len(own))
                keys.extend(own)
            of = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            yield pa.RecordBatch.from_arrays(
                [batch.column("bucket").take(of), *_split(b"".join(keys)), batch.column("doc_id").take(of)],
                names=["bucket", "hi", "lo", "doc_id"])

    return docs.select("bucket", "doc_id", "_text").mapInArrow(
        run, f"bucket long, hi long, lo long, doc_id {kind.simpleString()}")


# Perfect hash

def _place(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Where keys fall in a level of `bits` bits."""
    with np.errstate(over="ignore"):
        h = (keys ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((h ^ (h >> np.uint64(32))) % np.uint64(bits)).astype(np.int64)


def perfect_hash(keys: np.ndarray) -> tuple[list[int], bytes, np.ndarray]:
    """Sizes of the levels, their bits, and which keys are left over, for distinct 64-bit keys."""
    sizes, levels, rest = [], [], np.arange(len(keys))
    while len(rest) and len(sizes) < LEVELS:
        bits = 64 * math.ceil(len(rest) * 2 / 64)
        at = _place(keys[rest], len(sizes), bits)
        met = np.bincount(at, minlength=bits)
        sizes.append(bits)
        levels.append(np.packbits(met == 1))
        rest = rest[met[at] > 1]
    return sizes, b"".join(x.tobytes() for x in levels), rest


def numbers(keys: np.ndarray, sizes: list[int], bits: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Number of each key, -1 for keys at no level. `before` counts the bits before each byte."""
    out, open_, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        at = _place(keys[open_], level, size) + base
        byte, shift = bits[at >> 3], (7 - (at & 7)).astype(np.uint8)
        here = (byte >> shift) & 1 == 1
        ahead = np.bitwise_count(byte >> (shift + np.uint8(1)))
        out[open_[here]] = before[at[here] >> 3] + ahead[here]
        open_, base = open_[~here], base + size
    return out


def _ahead(bits: np.ndarray) -> np.ndarray:
    count = np.bitwise_count(bits).astype(np.int64)
    return np.cumsum(count) - count


INDEX = ("shard long, sizes array<int>, bits binary, prints binary, held binary, owners array<{0}>, "
         "rest_hi array<long>, rest_lo array<long>, rest_held array<long>, rest_owner array<{0}>")


def _shard(least_documents: int, kind: pa.DataType):
    """Group function: the distinct keys of a shard (hi, lo, held, owner) to its row of the index."""
    def build(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        hi, held = table["hi"].to_numpy(), table["held"].to_numpy()
        distinct, of, times = np.unique(hi, return_inverse=True, return_counts=True)
        alone = np.flatnonzero(times[of] == 1)
        sizes, bits, left = perfect_hash(hi[alone].view(np.uint64))
        beside = np.concatenate([np.flatnonzero(times[of] > 1), alone[left]])
        alone = np.delete(alone, left)
        raw = np.frombuffer(bits, np.uint8)
        order = alone[np.argsort(numbers(hi[alone].view(np.uint64), sizes, raw, _ahead(raw)))]
        often = order[held[order] >= least_documents]
        listed = lambda x, t=pa.int64(): pa.array([x.tolist()], pa.list_(t))
        pick = lambda name, at: table[name].take(pa.array(at)).to_pylist()
        lo = table["lo"].to_numpy()
        return pa.table({
            "shard": table["shard"].slice(0, 1).combine_chunks(), "sizes": pa.array([sizes], pa.list_(pa.int32())),
            "bits": [bits], "prints": [(lo[order] & 0xFFFFFFFF).astype("<u4").tobytes()],
            "held": [np.minimum(held[order], 0xFFFFFFFF).astype("<u4").tobytes()],
            "owners": pa.array([pick("owner", often)], pa.list_(kind)),
            "rest_hi": listed(hi[beside]), "rest_lo": listed(lo[beside]), "rest_held": listed(held[beside]),
            "rest_owner": pa.array([pick("owner", beside)], pa.list_(kind)),
        })

    return build


def index(keys: DataFrame, shards: int, least_documents: int = 3) -> DataFrame:
    """The index as a table, a row per shard, of keys counted per bucket (bucket, hi, lo, held, owner)."""
    kind = keys.schema["owner"].dataType
    dealt = keys.withColumn("shard", F.pmod("hi", F.lit(shards).cast("long"))).repartition("shard")
    distinct = dealt.groupBy("shard", "hi", "lo").agg(F.sum("held").alias("held"), F.max("owner").alias("owner"))
    return distinct.groupBy("shard").applyInArrow(
        _shard(least_documents, to_arrow_type(kind)), INDEX.format(kind.simpleString()))


def _loaded(least_documents: int):
    """A shard's row of the index, as arrays to probe."""
    def load(table: pa.Table) -> tuple:
        row = {c: table[c].combine_chunks()[0] for c in table.column_names}
        bits = np.frombuffer(row["bits"].as_py(), np.uint8)
        held = np.frombuffer(row["held"].as_py(), "<u4")
        beside = {(h, lo): (n, o) for h, lo, n, o in zip(*(row[f"rest_{c}"].as_py() for c in ("hi", "lo", "held", "owner")))}
        often = held >= least_documents
        return (row["sizes"].as_py(), bits, _ahead(bits), np.frombuffer(row["prints"].as_py(), "<u4"), often,
                np.cumsum(often) - often, row["owners"].values, beside, least_documents)

    return load


def _probe(loaded: tuple, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Probes (shard, bucket, hi, lo) to those of keys found in enough documents, with their owner."""
    sizes, bits, before, prints, often, rank, owners, beside, least = loaded
    hi, lo = batch.column("hi").to_numpy(), batch.column("lo").to_numpy()
    number = numbers(hi.view(np.uint64), sizes, bits, before)
    placed = np.flatnonzero(number >= 0)
    known = placed[prints[number[placed]] == (lo[placed] & 0xFFFFFFFF).astype(np.uint32)]
    hit = known[often[number[known]]]
    owner = owners.take(pa.array(rank[number[hit]]))
    if beside:
        pairs = [beside.get(p) for p in zip(hi.tolist(), lo.tolist())]
        known = np.setdiff1d(known, [i for i, p in enumerate(pairs) if p])
        hit = known[often[number[known]]]
        more = [i for i, p in enumerate(pairs) if p and p[0] >= least]
        owner = pa.concat_arrays([owners.take(pa.array(rank[number[hit]])), pa.array([pairs[i][1] for i in more], owners.type)])
        hit = np.concatenate([hit, np.asarray(more, np.int64)])
    found = batch.take(pa.array(hit))
    yield pa.RecordBatch.from_arrays(
        [found.column("bucket"), found.column("hi"), found.column("lo"), owner], names=["bucket", "hi", "lo", "owner"])


# Operator

def _repeated(table: pa.Table) -> dict:
    """A bucket's repeated keys and who keeps them."""
    both = np.stack([table["hi"].to_numpy(), table["lo"].to_numpy()], axis=1).astype(">i8").tobytes()
    return dict(zip((both[i:i + 16] for i in range(0, len(both), 16)), table["owner"].to_pylist()))


def _kept(least_chars: int):
    def judge(repeated: dict, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, sizes, dropped = [], [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("_text")):
            lines = text.as_py().split(b"\n")
            kept = lines
            if repeated:
                own = lambda line: repeated.get(line_key(line, least_chars), doc_id) == doc_id
                kept = [line for line in lines if own(line)]
            texts.append(b"\n".join(kept))
            sizes.append(len(lines))
            dropped.append(len(lines) - len(kept))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(texts, pa.binary()), pa.array(sizes, pa.int64()), pa.array(dropped, pa.int64())],
            names=["doc_id", "_text", "n_lines", "n_dropped"])

    return judge


def drop_repeated(
    docs: DataFrame, least_chars: int = 20, least_documents: int = 3, bucket: int = BUCKET, shard: int = SHARD,
) -> DataFrame:
    """Documents without the lines that repeat across documents.

    Keys of at least `least_chars` code points found in at least `least_documents` documents lose all
    their lines except in the largest doc_id holding them, which keeps all of its own. Returns per
    row of `docs`: doc_id, text (what is left, joined by ``\\n``), n_lines (before dropping), n_dropped.

    A null or empty text is one empty line. Every row is a document of its own, so a repeated row counts
    again, and rows that share the largest doc_id all keep their lines. A null id is smaller than any
    other; lines held by rows without id alone stay. A text whose lines all go is empty. No rows
    give no rows; columns other than doc_id and text are not looked at.
    """
    buckets = max(1, math.ceil(docs.count() / bucket))
    dealt = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets).cast("long")).alias("bucket"), "doc_id",
        F.coalesce("text", F.lit("")).cast("binary").alias("_text"))
    keys = cut(_keys(dealt, least_chars).groupBy("bucket", "hi", "lo").agg(
        F.count(F.lit(1)).alias("held"), F.max("doc_id").alias("owner")), "line-keys")
    shards = max(1, math.ceil(keys.count() / shard))
    arrays = cut(index(keys, shards, least_documents), "line-index")
    probes = keys.select(F.pmod("hi", F.lit(shards).cast("long")).alias("shard"), "bucket", "hi", "lo")
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = meet(arrays, probes, "shard", _loaded(least_documents), _probe, f"bucket long, hi long, lo long, owner {kind}")
    left = meet(found, dealt, "bucket", _repeated, _kept(least_chars),
                f"doc_id {kind}, _text binary, n_lines long, n_dropped long")
    return left.select("doc_id", F.col("_text").cast("string").alias("text"), "n_lines", "n_dropped")
