"""Tokens of two tokenizers aligned by pointer jumping.

Both tokenizers cover the same bytes, so each token overlaps some of the other side's. Every token
points to its farthest-right overlapping token of the other side, or to itself where none reaches
further (of two that end together, the A token). Doubling the pointers, vectorised over a whole chunk
of documents, ends in each component's terminal token, and tokens with one terminal are one group. A
chain through m tokens takes log2(m) doublings.

Chunks of documents count their own id pairs before anything is shuffled, so the commonest pair is one row
per chunk. The corpus-wide counts go back to each chunk, and its documents stream past them.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.answers import meet
from quayside.llm.text import cut

FOLDER = "/opt/tokenizers"
A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Documents and bytes of a chunk; a longer document is a chunk of its own.
CHUNK_DOCS, CHUNK_BYTES = 1024, 2_000_000
#: Where byte-level vocabularies split a text before merging (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_SPACE = 5000


# Vocabularies

def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters
    stand for themselves, other bytes, in order, for characters from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """The byte-level tokenizer of a vocabulary file, its merges applied by rank.

    The file's merges give the ids in their order, so its entries are a rank table, and the splitting
    pattern is the fixed one of byte-level vocabularies. Looking for the end of very long white space
    would overflow the stack of the faster encoder, so such texts go through the file's own.
    """

    def __init__(self, raw: bytes):
        import tiktoken

        document = json.loads(raw)
        model = document["model"]
        parts = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        first = len(model["vocab"]) - len(model["merges"])
        if any(model["vocab"]["".join(m)] != first + i for i, m in enumerate(parts)):
            raise ValueError("the vocabulary's ids are not in the order of its merges")
        byte = byte_level()
        ranks = {bytes(byte[c] for c in entry): i for entry, i in model["vocab"].items()}
        self.fast = tiktoken.Encoding("byte level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.raw = raw
        self.bytes = [b""] * (1 + max([*ranks.values(), *(t["id"] for t in document["added_tokens"])]))
        for entry, i in ranks.items():
            self.bytes[i] = entry

    @cached_property
    def whole(self):
        from tokenizers import Tokenizer

        out = Tokenizer.from_buffer(self.raw)
        out.encode_special_tokens = True
        return out

    def encode(self, text: str) -> list[int]:
        if len(text) > LONG_SPACE and re.search(rf"\s{{{LONG_SPACE}}}", text):
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


@lru_cache(maxsize=1)
def _tokenizers(a: bytes, b: bytes):
    """Encoders of both sides and the bytes of their ids; one pair per Python worker."""
    import sentencepiece

    left = ByteLevel(a)
    right = sentencepiece.SentencePieceProcessor(model_proto=b)
    piece = lambda i: right.id_to_piece(i).replace("▁", " ").encode()
    b_bytes = [bytes([int(right.id_to_piece(i)[3:5], 16)]) if right.is_byte(i) else piece(i)
               for i in range(right.get_piece_size())]
    return left, right, left.bytes, b_bytes


# Alignment

def terminals(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pointer jumping over tokens that end at `a_end` and `b_end` and cover the same bytes.

    Returns the terminal (an A token) of every A and B token, and the first and last B token that each
    A token overlaps.
    """
    n = len(a_end)
    start = lambda end: np.concatenate([[0], end[:-1]]) if len(end) else end
    first = np.searchsorted(b_end, start(a_end), "right")
    last = np.searchsorted(start(b_end), a_end, "left") - 1
    last_a = np.searchsorted(start(a_end), b_end, "left") - 1
    to = np.concatenate([np.where(b_end[last] > a_end, n + last, np.arange(n)) if n else last, last_a])
    while True:
        further = to[to]
        if np.array_equal(further, to):
            return to[:n], to[n:], first, last
        to = further


def _written(a_ids, b_ids, group_a, group_b, texts) -> np.ndarray:
    """The tokens of all groups in order, A before B, each with the sign that stands before it."""
    a_texts, b_texts = texts
    ids = np.concatenate([a_ids, b_ids])
    side = np.repeat([0, 1], [len(a_ids), len(b_ids)])
    key = np.concatenate([group_a, group_b]) * 2 + side
    order = np.argsort(key, kind="stable")
    key, side, ids = key[order], side[order], ids[order]
    opens = np.concatenate([[True], key[1:] != key[:-1]])
    out = np.empty(len(ids), object)
    for s, own in ((0, a_texts), (1, b_texts)):
        for o, prefixed in ((0, own[0]), (1, own[1])):
            here = (side == s) & (opens == o)
            out[here] = prefixed[ids[here]]
    return out


@lru_cache(maxsize=1)
def _prefixed(a: int, b: int):
    """Ids as text behind a comma, and behind the sign that opens their side of a group."""
    put = lambda sign, n: np.asarray([sign + str(i) for i in range(n)], object)
    return (put(",", a), put(";", a)), (put(",", b), put("|", b))


def align_chunk(texts: list[bytes], tools, digest: bool) -> dict:
    """Per document: n_a, n_b, n_groups, n_links, groups (text, or its SHA-256), and its id pairs (A id times
    65,536 plus B id) with their numbers, flat, with `held` of them per document."""
    left, right, a_bytes, b_bytes = tools
    plain = [t.decode("utf-8", "replace") for t in texts]
    a_lists = [left.encode(" " + t) for t in plain]
    b_lists = right.encode(plain, num_threads=1)
    for i, text in enumerate(texts):
        whole = b" " + text
        same = text and b"".join([a_bytes[x] for x in a_lists[i]]) == whole == b"".join([b_bytes[x] for x in b_lists[i]])
        if not same:
            a_lists[i], b_lists[i] = [], []
    n = len(texts)
    flat = lambda lists: np.concatenate([np.empty(0, np.int64), *(np.asarray(x, np.int64) for x in lists)])
    a_ids, b_ids = flat(a_lists), flat(b_lists)
    n_a, n_b = (np.asarray([len(x) for x in lists], np.int64) for lists in (a_lists, b_lists))
    length = lambda names: np.fromiter(map(len, names), np.int64, len(names))
    a_end, b_end = np.cumsum(length(a_bytes)[a_ids]), np.cumsum(length(b_bytes)[b_ids])
    to_a, to_b, first, last = terminals(a_end, b_end)
    ends = np.unique(to_a)
    group_a, group_b = np.searchsorted(ends, to_a), np.searchsorted(ends, to_b)
    doc_a = np.repeat(np.arange(n), n_a)
    n_groups = np.bincount(doc_a[ends], minlength=n)
    width = last - first + 1
    n_links = np.bincount(doc_a, weights=width, minlength=n).astype(np.int64)
    of = np.repeat(np.arange(len(a_ids)), width)
    b_at = np.arange(len(of)) - np.repeat(np.cumsum(width) - width, width) + first[of]
    pair = a_ids[of] << 16 | b_ids[b_at]
    kinds, times = np.unique(doc_a[of] << 32 | pair, return_counts=True)
    held = np.bincount(kinds >> 32, minlength=n)
    total = np.cumsum(n_a + n_b)
    signs = _written(a_ids, b_ids, group_a, group_b, _prefixed(len(a_bytes), len(b_bytes)))
    groups = []
    for start, end in zip([0, *total[:-1].tolist()], total.tolist()):
        text = "".join(signs[start:end].tolist())[1:]
        groups.append(hashlib.sha256(text.encode()).hexdigest() if digest and text else text)
    return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups": groups,
            "pairs": kinds & 0xFFFFFFFF, "times": times, "held": held}


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values))


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    sizes = [len(t.as_buffer()) for t in texts]
    for i, size in enumerate(sizes):
        if i > start and (held + size > CHUNK_BYTES or i - start >= CHUNK_DOCS):
            yield start, i
            start, held = i, 0
        held += size
    if sizes:
        yield start, len(sizes)


COUNTED = "chunk long, of_chunk boolean, doc_id {0}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"


def _aligned(spread, digest: bool):
    """Task function: documents to a row each and a row of all id pairs for each chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = _tokenizers(*spread.value)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("_text")
            for start, end in _chunks(texts):
                number += 1
                got = align_chunk([t.as_py() for t in texts.slice(start, end - start)], tools, digest)
                n = end - start
                kinds, of = np.unique(got["pairs"], return_inverse=True)
                sums = np.bincount(of, weights=got["times"], minlength=len(kinds)).astype(np.int64)
                padded = lambda c: pa.concat_arrays([pa.array(got[c], pa.int64()), pa.nulls(1, pa.int64())])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n + 1, number)), pa.array([False] * n + [True]),
                    pa.concat_arrays([ids.slice(start, n), pa.nulls(1, ids.type)]),
                    *map(padded, ("n_a", "n_b", "n_groups", "n_links")), pa.array([*got["groups"], None], pa.string()),
                    pa.concat_arrays([_lists(got["pairs"], got["held"]), _lists(kinds, np.asarray([len(kinds)]))]),
                    pa.concat_arrays([_lists(got["times"], got["held"]), _lists(sums, np.asarray([len(sums)]))]),
                ], names=[c.split()[0] for c in COUNTED.split(", ")])

    return run


# Counts brought back

def _ready(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's id pairs in order, their corpus-wide counts, and which are the best of their B id."""
    pair = table["pair"].to_numpy()
    order = np.argsort(pair)
    return pair[order], table["total"].to_numpy()[order], np.asarray(table["best"].to_numpy(), bool)[order]


def _summed(ready, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    known, total, best = ready
    pairs = batch.column("pairs")
    sizes = pairs.value_lengths().to_numpy()
    at = np.searchsorted(known, pairs.flatten().to_numpy())
    times = batch.column("times").flatten().to_numpy()
    edges = np.concatenate([[0], np.cumsum(sizes)])
    def sums(x):
        upto = np.concatenate([[0], np.cumsum(x)])
        return pa.array(upto[edges[1:]] - upto[edges[:-1]], pa.int64())
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    yield pa.RecordBatch.from_arrays(
        [*(batch.column(c) for c in names), sums(np.where(best[at], times, 0)), sums(times * total[at]), batch.column("groups")],
        names=[*names, "n_best", "count_sum", "groups"])


def align(docs: DataFrame, folder: str = FOLDER, digest: bool = False) -> DataFrame:
    """Tokens of every text under both tokenizers in `folder`, cut into groups and linked.

    Returns per row of `docs`: doc_id; n_a and n_b, its tokens of each side; n_groups; n_links, the
    pairs of an A and a B token that overlap; n_best, the links whose id pair is linked as often in
    the corpus as any pair of its B id; count_sum, the sum of those counts over its links; and groups,
    the ids as ``a1,a2|b1;a3|b2,b3``. With `digest`, groups is the SHA-256 of that text, so that the
    text itself, several times as long as the document, is never stored.

    A text that is null or empty, or that either tokenizer does not give back byte for byte, has no
    tokens: zeros and an empty `groups`. Special tokens' strings are plain text. Repeated rows are
    counted as often as they occur; ids may be null; no rows give no rows; columns other than doc_id
    and text are not looked at.
    """
    files = []
    for name in (A, B):
        with open(os.path.join(folder, name), "rb") as file:
            files.append(file.read())
    spread = docs.sparkSession.sparkContext.broadcast(tuple(files))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("_text"))
    counted = cut(rows.mapInArrow(_aligned(spread, digest), COUNTED.format(kind)), "aligned")
    asked = counted.where("of_chunk").select("chunk", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "chunk", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    # A B id meets at most as many A ids as the A vocabulary has.
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFF)))
    counts = asked.groupBy("pair").agg(F.sum("times").alias("total")).withColumn(
        "best", F.col("total") == F.max("total").over(of_b))
    answers = asked.select("chunk", "pair").join(cut(counts, "pair-counts"), "pair")
    documents = counted.where("not of_chunk").drop("of_chunk")
    return meet(answers, documents, "chunk", _ready, _summed,
                f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
