"""Whitening, line dedup and token alignment, against brute force, and on awkward rows."""

import collections
import hashlib
import json
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside.llm import alignment, line_dedup, whitening
from tests.llm.data import AWKWARD, documents, frame

TOKENIZERS = os.path.isdir(alignment.FOLDER)
VECTORS = "vec_id long, embedding array<float>, label int"


# Whitening

def vectors(spark, rows):
    df = spark.createDataFrame(rows, VECTORS)
    return df.withColumns({c: F.lit("clash") for c in ("component", "n", "_id", "_vector", "size", "place", "i")})


def gathered(df):
    out = collections.defaultdict(dict)
    for r in df.collect():
        out[r["vec_id"]][r["component"]] = r
    return out


def test_whitening_equals_the_eigenvectors(spark):
    rng = np.random.default_rng(3)
    own = (rng.standard_normal((300, 12)) * np.geomspace(3, 0.2, 12)) @ np.linalg.qr(rng.standard_normal((12, 12)))[0] + 1
    own = own.astype(np.float32)
    odd = [(900, None, 0), (901, [1.0] * 11 + [None], 0), (902, [1.0] * 11 + [float("nan")], 0),
           (903, [float("inf")] * 12, 0), (904, [1.0, 2.0], 0), (905, [], 0)]
    got = gathered(whitening.whiten(vectors(spark, [(i, v.tolist(), 1) for i, v in enumerate(own)] + odd), most=5))
    assert sorted(got) == list(range(300)) and all(sorted(v) == [1, 2, 3, 4, 5] for v in got.values())
    x = np.floor(64 * own.astype(np.float64)) + 1_000_000
    e, q = np.linalg.eigh(np.cov(x.T, bias=True))
    e, q = e[::-1], q[:, ::-1]
    z = np.array([[got[i][k]["whitened"] for k in range(1, 6)] for i in range(300)])
    want = (x - x.mean(0)) @ q[:, :5] / np.sqrt(e[:5])
    assert np.allclose(z * np.sign((z * want).sum(0)), want, atol=1e-9)
    n, s = 300, x.sum(0).astype(int)
    for i in range(300):
        r = got[i][2]
        assert r["n"] == n and r["deviation"] == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[i], s))
        assert abs(r["explained"] - e[1] / e.sum()) < 1e-12 and r["identity_error"] < 1e-9
    again = gathered(whitening.whiten(vectors(spark, [(i, v.tolist(), 1) for i, v in enumerate(own)][::-1]).repartition(7), most=5))
    assert all(abs(again[i][k]["whitened"] - got[i][k]["whitened"]) < 1e-12 for i in got for k in got[i])
    assert all(again[i][k]["explained"] == got[i][k]["explained"] for i in got for k in got[i])


def test_whitening_of_few_equal_or_huge_vectors(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, None, 0)])).columns == whitening.whiten(vectors(spark, [])).columns
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0], 0)] * 4)).count() == 0  # no variance
    got = whitening.whiten(vectors(spark, [(None, [1.0, 2.0], 0), (None, [3.0, 2.0], 0), (7, [3.0, 2.0], 0)])).collect()
    assert [r["component"] for r in got] == [1, 1, 1] and sorted(r["vec_id"] or 0 for r in got) == [0, 0, 7]
    huge = whitening.whiten(vectors(spark, [(1, [1e30, 0.5], 0), (2, [-1.0, 0.25], 0), (3, [0.0, 8.0], 0)])).collect()
    assert {r["deviation"] for r in huge} == {None} and max(r["identity_error"] for r in huge) < 1e-4


@pytest.mark.parametrize("values", [
    [5, 5, 5, 5], [1, 0, 0, 0], [3, 3, 2, 2, 2, 1e-9], list(range(40)), [1e6, 1, 1e-6], [2, 2 + 1e-9, 2 + 2e-9, 1],
])
def test_spectral_divide_and_conquer(values):
    rng = np.random.default_rng(len(values))
    q, _ = np.linalg.qr(rng.standard_normal((len(values),) * 2))
    a = (q * np.asarray(values, float)) @ q.T
    a = (a + a.T) / 2
    got, axes = whitening.components(a)
    scale = np.linalg.norm(a)
    assert np.allclose(got, sorted(values, reverse=True), atol=1e-13 * scale * len(values))
    assert np.linalg.norm(axes.T @ axes - np.eye(len(a))) < 1e-13 * len(a)
    assert np.linalg.norm(a @ axes - axes * got) < 1e-13 * scale * len(a)


def test_sums_in_limbs_are_exact():
    rng = random.Random(5)
    whole = [rng.randrange(-(1 << 120), 1 << 120) for _ in range(200)]
    parts = sum(whitening.limbs(np.asarray([w], object)) for w in whole)
    assert sum(int(p) << (40 * i) for i, p in enumerate(parts[:, 0])) == sum(whole)
    big = np.asarray([[1 << 45, -(1 << 44)], [3, 1 << 50]])
    assert whitening._gram(big)[1, 1] == (1 << 88) + (1 << 100)


# Lines

def brute_lines(rows, least=20, documents=3):
    strip = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    held = collections.defaultdict(list)
    for n, (doc_id, text, *_) in enumerate(rows):
        for key in {strip(line) for line in (text or "").split("\n")}:
            if len(key) >= least:
                held[key].append(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        kept = []
        lines = (text or "").split("\n")
        for line in lines:
            own = held.get(strip(line), [])
            ids = [i for i in own if i is not None]
            if len(own) < documents or (max(ids) if ids else None) == doc_id:
                kept.append(line)
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


LINES = ["All rights reserved by the owners", "  all RIGHTS reserved by the owners\t", "short line", "x" * 19, "X" * 20, "é" * 20,
         "é" * 19, "", " all rights reserved by the owners", "A line that only two hold, or three", "漢字" * 10]


def line_rows(seed, n=60):
    rng = random.Random(seed)
    rows = [(i, "\n".join(rng.choice(LINES + [f"own line number {rng.randint(0, 90)} of them"]) for _ in range(rng.randint(0, 9))), "en", "a")
            for i in range(n)]
    return rows + rows[:3] + [(None, "\n".join(LINES), None, None), (None, LINES[0], None, None), (n + 5, LINES[0] + "\r\n" + LINES[0], "de", "b")]


@pytest.mark.parametrize("rows", [line_rows(1), line_rows(2), AWKWARD, [], [(None, "the same line of more than twenty", None, None)] * 4])
def test_line_dedup_equals_brute_force(spark, rows):
    got = line_dedup.drop_repeated(frame(spark, rows), bucket=7, shard=9)
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_lines(rows)


def test_perfect_hash_numbers_every_key_once():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 64, 50_000, dtype=np.uint64))
    sizes, bits, left = line_dedup.perfect_hash(keys)
    raw = np.frombuffer(bits, np.uint8)
    assert len(left) == 0 and len(bits) * 8 < 4.2 * len(keys)
    assert sorted(line_dedup.numbers(keys, sizes, raw, line_dedup._ahead(raw)).tolist()) == list(range(len(keys)))
    assert line_dedup.perfect_hash(np.empty(0, np.uint64))[0] == []


def test_keys_that_share_half_their_hash_stay_apart():
    table = pa.table({"shard": [0] * 6, "hi": [5, 5, 9, 11, 11, 11], "lo": [1, 2, 3, 4, 4 + (1 << 32), 6],
                      "held": [3, 1, 4, 3, 9, 2], "owner": [70, 71, 72, 73, 74, None]})
    row = line_dedup._shard(3, pa.int64())(table)
    assert sorted(row["rest_lo"][0].as_py()) == [1, 2, 4, 6, 4 + (1 << 32)]
    batch = pa.RecordBatch.from_pydict({"shard": [0] * 6, "bucket": list(range(6)), "hi": table["hi"].to_numpy(), "lo": table["lo"].to_numpy()})
    got = next(line_dedup._probe(line_dedup._loaded(3)(row), batch)).to_pylist()
    assert sorted((r["bucket"], r["owner"]) for r in got) == [(0, 70), (2, 72), (3, 73), (4, 74)]


# Tokens

def brute_alignment(rows):
    with open(f"{alignment.FOLDER}/{alignment.A}", "rb") as a, open(f"{alignment.FOLDER}/{alignment.B}", "rb") as b:
        left, right, a_bytes, b_bytes = alignment._tokenizers(a.read(), b.read())
    docs, counts = [], collections.Counter()
    for doc_id, text, *_ in rows:
        a_ids = left.whole.encode(" " + text, add_special_tokens=False).ids if text else []
        b_ids = right.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if b"".join(a_bytes[i] for i in a_ids) != whole or b"".join(b_bytes[i] for i in b_ids) != whole:
            a_ids = b_ids = []
        spans = []
        for ids, names in ((a_ids, a_bytes), (b_ids, b_bytes)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(names[i]), i))
                at += len(names[i])
            spans.append(own)
        a, b = spans
        pairs = [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]]
        counts.update(pairs)
        cuts = sorted({x[1] for x in a} & {y[1] for y in b})
        groups, start = [], 0
        for end in cuts:
            own = ["".join(f",{i}" for s, e, i in side if start <= s < end)[1:] for side in (a, b)]
            groups.append("|".join(own))
            start = end
        docs.append((doc_id, len(a), len(b), len(groups), pairs, ";".join(groups)))
    best = {}
    for (a, b), n in counts.items():
        best[b] = max(n, best.get(b, 0))
    return sorted(((i, a, b, g, len(p), sum(counts[x] == best[x[1]] for x in p), sum(counts[x] for x in p), t)
                   for i, a, b, g, p, t in docs), key=str)


TEXTS = ["<s> </s><unk><|endoftext|> <0x41>", "  two  spaces \n\n tabs\t\t", "a▁b", "▁", "\x00\x01", "ﬁn­gers", "👩‍👩‍👧 漢字かな",
         "don't it's we'll", "12345678901234567890", " ", "\n", "éééé" * 30, "=" * 300, "1 000 000,00 €", "﻿bom"]


@pytest.mark.skipif(not TOKENIZERS, reason="the tokenizers are not here")
@pytest.mark.parametrize("rows", [
    documents(25) + [(500 + i, t, None, None) for i, t in enumerate(TEXTS)] + [(None, "the river", None, None)] * 2,
    [r if not r[1] or len(r[1]) < 5000 else (r[0], r[1][:900], *r[2:]) for r in AWKWARD], [], [(1, None, None, None)],
])
def test_alignment_equals_brute_force(spark, rows):
    got = alignment.align(frame(spark, rows)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups").collect()
    assert sorted(map(tuple, got), key=str) == brute_alignment(rows)


@pytest.mark.skipif(not TOKENIZERS, reason="the tokenizers are not here")
def test_alignment_digest_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_DOCS", 3)
    rows = documents(10) + [(90, "word " * 30_000, "en", "a"), (91, "", "en", "a")]
    text = {r["doc_id"]: r["groups"] for r in alignment.align(frame(spark, rows)).collect()}
    for r in alignment.align(frame(spark, rows), digest=True).collect():
        assert r["groups"] == (hashlib.sha256(text[r["doc_id"]].encode()).hexdigest() if text[r["doc_id"]] else "")


def test_pointer_jumping_reaches_the_end_of_a_long_chain():
    a_end, b_end = np.arange(2, 20_001, 2), np.concatenate([np.arange(1, 20_000, 2), [20_000]])
    to_a, to_b, *_ = alignment.terminals(a_end, b_end)
    assert set(to_a.tolist()) == {len(a_end) - 1} == set(to_b.tolist())


def test_byte_level_table_is_a_bijection():
    table = alignment.byte_level()
    assert sorted(table.values()) == list(range(256)) and table["Ġ"] == 32


@pytest.mark.skipif(not TOKENIZERS, reason="the tokenizers are not here")
def test_the_fast_encoder_splits_every_character_alike():
    with open(f"{alignment.FOLDER}/{alignment.A}", "rb") as a:
        left = alignment.ByteLevel(a.read())
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3100 or c % 7 == 0)]
    texts = [f" a{chr(c)}1 {chr(c)}{chr(c)} .{chr(c)}b\n{chr(c)}'s" for c in points]
    texts += [" " * 20_000 + "x", "x" * 50_000, "a" + "\t" * 6000 + "b", "\n \n  x"]
    for at in range(0, len(texts), 20_000):
        part = texts[at:at + 20_000]
        own = left.whole.encode_batch_fast(part, add_special_tokens=False)
        assert [left.encode(t) for t in part] == [e.ids for e in own]


@pytest.mark.skipif(not TOKENIZERS, reason="the tokenizers are not here")
def test_every_entry_of_the_vocabularies_has_bytes():
    with open(f"{alignment.FOLDER}/{alignment.A}", "rb") as a, open(f"{alignment.FOLDER}/{alignment.B}", "rb") as b:
        raw = a.read()
        _, _, a_bytes, b_bytes = alignment._tokenizers(raw, b.read())
    entries = len(json.loads(raw)["model"]["vocab"])  # the special token comes after them
    assert entries + 1 == len(a_bytes) < 1 << 16 > len(b_bytes)
    assert all(a_bytes[:entries]) and all(b_bytes)
