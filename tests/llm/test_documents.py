"""Operators over documents, against plain Python, and on awkward rows."""

import collections
import hashlib
import math
import random
import re
import unicodedata
import zlib

import numpy as np
import pytest
import xxhash

from quayside.llm import brown, decontaminate, divergence, langid, licenses, mixing, ranking, set_classes, simhash
from tests.llm.data import AWKWARD, SCHEMA, WORDS, documents, frame, low, prose, words

BENCH = "item_id long, text string"


def bench(spark, rows=((1, "the river is in the garden"), (2, None), (None, "12 34"))):
    return spark.createDataFrame(list(rows), BENCH)


def labels(spark, docs):
    good = [(i, 0 if i % 7 in (3, 5) else 1, 0) for i, *_ in docs if i is not None]
    return spark.createDataFrame([*good, (None, 1, 0), (1, None, None)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "brown": lambda s, d: brown.score(d),
    "language": lambda s, d: langid.of_documents(d),
    "mix": lambda s, d: mixing.mix(d),
    "benchmark": lambda s, d: decontaminate.report(d, bench(s)),
    "licenses": lambda s, d: licenses.scan(d),
    "quality": lambda s, d: ranking.classify(d, labels(s, documents(40))),
    "rules": lambda s, d: divergence.judge(d),
    "simhash": lambda s, d: simhash.classes(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_awkward_row_gets_its_row(spark, name):
    got = OPERATORS[name](spark, frame(spark, AWKWARD)).collect()
    ids = lambda rows: sorted((r[0] for r in rows), key=str)
    assert ids([(r["doc_id"],) for r in got]) == ids(AWKWARD)


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows_give_no_rows(spark, name):
    assert OPERATORS[name](spark, frame(spark, [])).count() == 0


def test_brown_base_and_gain(spark):
    rows = documents(150) + AWKWARD
    got = brown.score(frame(spark, rows)).collect()
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 != 2 or r[0] is None]
    tokens = lambda t: [*words(low(t)), None]
    c = collections.Counter(t for r in train for t in tokens(r[1]))
    n, v = sum(c.values()), len(c)
    want = collections.Counter(
        (r[0], len(tokens(r[1])), sum(c[t] > 0 for t in tokens(r[1])),
         round(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in tokens(r[1])), 4)) for r in rows)
    assert want == collections.Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in got)
    assert {r.train_tokens for r in got} == {n}
    out = [r for r in got if r.held_out and r.n_tokens > 20]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_brown_rare_words_by_join_score_as_by_table(spark, monkeypatch):
    docs = frame(spark, documents(60))
    whole = {r.doc_id: r for r in brown.score(docs).collect()}
    monkeypatch.setattr(brown, "HEAD", 12)
    monkeypatch.setattr(brown, "FREQUENT", 12)
    monkeypatch.setattr(brown.head_words, "__defaults__", (12,))
    few = {r.doc_id: r for r in brown.score(docs).collect()}
    for i, r in few.items():
        assert r.base_score == pytest.approx(whole[i].base_score) and r.n_known == whole[i].n_known


def test_brown_words_of_one_ending_have_classes_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(brown, "FREQUENT", 9)
    rng = random.Random(4)
    nouns = [*["house", "tree", "river"] * 40, *[f"n{i}xyz" for i in range(40)]]
    verbs = [*["grown", "cold", "far"] * 40, *[f"v{i}xyz" for i in range(40)]]
    rows = [(i, " ".join(f"the {rng.choice(nouns)} is {rng.choice(verbs)} ." for _ in range(8))) for i in range(120)]
    right, turned = [i for i in range(500, 600) if zlib.crc32(str(i).encode()) % 7 == 2][:2]  # not learnt from
    rows += [(right, "the n1xyz is v1xyz ."), (turned, "the v1xyz is n1xyz .")]
    got = {r.doc_id: r for r in brown.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[right].base_score == pytest.approx(got[turned].base_score)
    assert got[right].score > got[turned].score + 1


def test_exchange_finds_two_languages():
    rng = np.random.default_rng(0)
    pairs = np.zeros((20, 20))
    pairs[:10, :10], pairs[10:, 10:] = rng.integers(5, 9, (10, 10)), rng.integers(5, 9, (10, 10))
    own = brown.exchange(pairs, classes=2)
    assert len(set(own[:10])) == 1 and len(set(own[10:])) == 1 and own[0] != own[10]


def test_language_of_held_out_documents(spark):
    rows = documents(200)
    got = langid.of_documents(frame(spark, rows)).collect()
    right = [r.lang == r.declared for r in got]
    assert sum(right) / len(right) > 0.97
    wrong = [(1000 + i, prose(random.Random(i), "de", 40), "fr", "s1") for i in range(5)]
    kept = {r.doc_id: r for r in langid.of_documents(frame(spark, rows + wrong)).collect()}
    assert all(kept[1000 + i].lang == "de" for i in range(5))  # the text outweighs a wrong declaration
    noise = [(2000, "zxqj vwkz qqxz jjkv zzqw xkcd wvut " * 5, None, None)]
    assert not {r.doc_id: r.kept for r in langid.of_documents(frame(spark, rows + noise)).collect()}[2000]
    assert langid.keep(frame(spark, rows + noise)).count() == len(rows)


def test_language_priors_decide_short_texts(spark):
    docs = [(i, prose(random.Random(i), lang, 60), lang, host) for i, (lang, host) in enumerate([("en", "a"), ("fr", "b")] * 20)]
    short = [(900, None, None, "a"), (901, None, None, "b"), (902, "", "fr", "a")]
    got = {r.doc_id: r.lang for r in langid.of_documents(frame(spark, docs + short)).collect()}
    assert (got[900], got[901]) == ("en", "fr")


def test_mix_meets_targets(spark):
    rows = documents(400, seed=3) + [(9000 + i, "the same words " * 5, "en", "hot") for i in range(300)]
    got = mixing.mix(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    size = collections.Counter()
    for _, text, _, source in rows:
        size[source] += len(words(text))
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(size))}
    target, free, rest = {}, dict(weights), sum(size.values())
    while True:
        level = rest / sum(free.values())
        over = [s for s in free if level * free[s] > 3 * size[s]]
        for s in over:
            target[s] = 3 * size[s]
            rest -= target[s]
            del free[s]
        if not over:
            break
    target |= {s: level * w for s, w in free.items()}
    taken = collections.Counter()
    for r in got:
        assert r.taken == r.copies * r.size <= 3 * r.size and r.source_size == size[r.source]
        assert r.target == pytest.approx(target[r.source])
        taken[r.source] += r.taken
    for s in target:
        assert abs(taken[s] - target[s]) <= max(0.02 * target[s], 160)
    key = lambda rows: sorted((r.doc_id, r.copies) for r in rows)
    assert key(got) == key(mixing.mix(frame(spark, rows).repartition(7)).collect())


def test_mix_newton_solves_the_dual(spark):
    rows = [(i, "w " * (1 + i % 50), "en", "ab"[i % 2]) for i in range(400)]
    got = mixing.mix(frame(spark, rows)).collect()
    for s in "ab":
        own = [r for r in got if r.source == s]
        assert sum(r.rate * r.size for r in own) == pytest.approx(own[0].target, rel=1e-5)
        logs = {round(math.log(r.rate) / r.size, 6) for r in own if r.rate < 3}
        assert len(logs) == 1  # one tilt per source


def brute_hits(text, items, window=10):
    parse = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    w, hit, ids = parse(text), set(), set()
    for item, t in items:
        g = parse(t)
        for p in range(max(1, len(g) - window + 1) if g else 0):
            part = g[p:p + window]
            for q in range(len(w) - len(part) + 1):
                if w[q:q + len(part)] == part:
                    hit |= set(range(q, q + len(part)))
                    ids |= {str(item)} if item is not None else set()
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


def test_benchmark_hits_equal_brute_force(spark):
    rng = random.Random(5)
    items = [(i, prose(rng, "en", rng.choice([3, 9, 10, 11, 25]))) for i in range(12)] + [(None, "garden winter"), (20, ""), (21, None), (3, "the river")]
    rows = documents(60) + AWKWARD
    rows += [(500 + i, f"Start {t.upper()} - end {prose(rng, 'en', 20)}", "en", "s") for i, (_, t) in enumerate(items) if t]
    got = collections.Counter(tuple(r) for r in decontaminate.report(frame(spark, rows), bench(spark, items)).collect())
    assert got == collections.Counter((i, *brute_hits(t, items)) for i, t, *_ in rows)
    split = decontaminate.scan(frame(spark, rows), bench(spark, items), block=5)
    assert sorted((r.doc_id, r.n_hit) for r in split.where("doc_id >= 500").collect()) == sorted((k[0], k[2]) for k in got if (k[0] or 0) >= 500)


def test_benchmark_removal(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    docs = frame(spark, [(1, f"Before, {passage}. After!", "en", "s"), (2, "Clean text.", "en", "s"), (None, None, None, None)])
    items = bench(spark, [(1, passage)])
    left = decontaminate.decontaminate(docs, items)
    assert {r.doc_id for r in left.collect()} == {2, None} and left.columns == docs.columns
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, items, "spans").collect()}
    assert cut == {1: "Before. After!", 2: "Clean text.", None: None}


def brute_licenses(text):
    """Names whose shingles some window of twice the class length holds to four fifths, best of each window."""
    h = licenses.shingles(text).tolist()
    found = {}
    for own in licenses.index(licenses.TEMPLATES):
        near = {}
        for at in range(len(h) // own.length + 1):
            here = set(h[at * own.length:(at + 2) * own.length - licenses.SHINGLE + 1])
            share, t = max((len(s & here) / len(s), -i) for i, s in enumerate(own.sets))
            if share >= licenses.CONTAINED:
                near[at] = (share, own.names[-t])
        for at, (share, name) in near.items():
            if share >= max((near[k][0] for k in (at - 1, at + 1) if k in near), default=0):
                found[name] = max(share, found.get(name, 0))
    return found


def test_licenses_equal_brute_force(spark):
    rng, rows = random.Random(2), []
    for i, (name, text) in enumerate(sorted(licenses.TEMPLATES.items()) * 4):
        rows.append((i, f"{prose(rng, 'en', rng.randint(0, 60))}\n{text.upper() if i % 2 else text}\n{prose(rng, 'de', rng.randint(0, 60))}", "en", "s"))
    rows += documents(30)
    for r, (i, text, *_) in zip(sorted(licenses.scan(frame(spark, rows[:48], False)).collect()), rows):
        want = brute_licenses(text)
        assert r.licenses == ",".join(sorted(want)) and r.containment == pytest.approx(max(want.values(), default=0))
        assert sorted(licenses.TEMPLATES)[i % 12] in want
    assert licenses.scan(frame(spark, documents(30))).where("n_licenses > 0").count() == 0
    for text in licenses.TEMPLATES.values():
        n = len(licenses.TOKEN.findall(text.lower().encode()))
        assert licenses.miss(n, next(c for c in licenses.CLASSES if c >= n)) < 1e-4


def test_screened_hits_are_those_of_every_class():
    rng, indexes = random.Random(8), licenses.index(licenses.ALL)
    known = licenses.table(indexes)
    texts = ["", "one", prose(rng, "en", 500), *licenses.TEXTS.values(), prose(rng, "fr", 40) + licenses.HEADERS["MPL-2.0"]]
    for text in texts:
        h = licenses.shingles(text)
        at, classes = licenses.hits(h, known)
        for k, own in enumerate(indexes):
            assert at[classes >> k & 1 == 1].tolist() == np.flatnonzero(np.isin(h, own.known)).tolist()


def test_licenses_of_all_templates_are_those_that_windows_hold():
    rng, indexes = random.Random(9), licenses.index(licenses.ALL)
    known = licenses.table(indexes)
    for name in licenses.ALL:
        for own in licenses.ALL[name]:
            text = f"{prose(rng, 'en', rng.randint(0, 90))} {own} {prose(rng, 'de', rng.randint(0, 90))}"
            h, held = licenses.shingles(text).tolist(), {}
            for index in indexes:
                for start in range(0, len(h), index.length):
                    here = set(h[start:start + 2 * index.length - licenses.SHINGLE + 1])
                    for other, shape in zip(index.names, index.sets):
                        share = len(shape & here) / len(shape)
                        if share >= licenses.CONTAINED:
                            held[other] = max(share, held.get(other, 0))
            got = licenses.find(text, indexes, known, licenses.CONTAINED)
            assert name in {g[0] for g in got} <= set(held)
            assert max(g[2] for g in got) == pytest.approx(max(held.values()))


def test_licenses_side_by_side_are_all_found(spark):
    rng, rows, want = random.Random(4), [], []
    names = sorted(licenses.TEMPLATES)
    for i, (a, b) in enumerate((a, b) for a in names for b in names if a != b):
        rows.append((i, f"{prose(rng, 'en', i % 17)} {licenses.TEMPLATES[a]} {licenses.TEMPLATES[b]} {prose(rng, 'de', 9)}", "en", "s"))
        want.append(",".join(sorted((a, b))))
    got = {r.doc_id: r.licenses for r in licenses.scan(frame(spark, rows, False)).collect()}
    assert [got[i] for i in range(len(rows))] == want


def test_whole_license_texts_and_headers_are_found(spark):
    rng, rows, want = random.Random(5), [], []
    for name, text in [*licenses.TEXTS.items(), *licenses.HEADERS.items()]:
        edited = text.split()
        for k in range(20, len(edited), 60):
            edited[k] = "edited"
        for own in (text, " ".join(edited)):
            rows.append((len(rows), f"{prose(rng, 'en', 30)}\n{own}\n{prose(rng, 'de', 30)}", "en", "s"))
            want.append(name)
    got = {r.doc_id: r.licenses for r in licenses.scan(frame(spark, rows, False)).collect()}
    assert [got[i] for i in range(len(rows))] == want


def test_quality_ranks_held_out_documents(spark):
    rows = documents(420)[:420]
    got = ranking.classify(frame(spark, rows), labels(spark, rows)).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.predicted == (0 if r.doc_id % 7 in (3, 5) else 1) for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    kept = ranking.keep(frame(spark, rows), labels(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.predicted}


def test_quality_without_labels_keeps_all(spark):
    none = labels(spark, []).limit(0)
    assert {r.predicted for r in ranking.classify(frame(spark, AWKWARD), none).collect()} == {1}


def test_newton_finds_the_minimum(spark):
    rng = np.random.default_rng(4)
    d = rng.normal(0.5, 1.0, (300, 2))
    diffs = spark.createDataFrame([(list(map(float, r)),) for r in d], "d array<double>")
    w = ranking.newton(diffs, np.ones(2))
    slope = (d / (1 + np.exp(d @ w))[:, None]).mean(0) - ranking.RIDGE * w
    assert np.abs(slope).max() < 1e-6


def brute_rules(text):
    w = words(text)
    seen = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit),
            len(w) < 50 or 100 * len(hit) > 50 * len(w))


def test_rules_count_as_brute_force(spark):
    rows = documents(100) + AWKWARD + [(700, "a b c a b c\nx\n\nx\n y\n y\n" * 3, "en", "s"), (701, "one two one two one two", "en", "s")]
    got = divergence.judge(frame(spark, rows)).collect()
    assert collections.Counter((i, *brute_rules(t)) for i, t, *_ in rows) == collections.Counter(tuple(r)[:7] for r in got)


def test_divergence_rejects_what_the_references_do_not_look_like(spark):
    rows = documents(210)[:210]
    got = divergence.judge(frame(spark, rows)).collect()
    fine = [r for r in got if not r.base_failed]
    assert len(fine) > 100
    assert all(r.kept for r in fine if r.doc_id % 7 not in (3, 5))
    assert not any(r.kept for r in fine if r.doc_id % 7 == 5)


def brute_verdicts(rows, share=divergence.SHARE, least=divergence.LEAST_TEXTS):
    """(doc_id, kept, class distance, word distance) by plain Python, the means taken anew without each document."""
    def shares(text):
        space = sum(c in " \t\n\x0b\f\r" for c in text)
        kinds = [sum(unicodedata.category(c) == k for c in text) for k in ("Ll", "Lu")]
        kinds += [sum(c in "0123456789" for c in text), space, sum(c in divergence.SYMBOLS for c in text)]
        return [k / max(len(text), 1) for k in (*kinds, len(text) - sum(kinds))]

    def jsd(p, q):
        half = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x > 0)
        return math.sqrt(max((half(p, q) + half(q, p)) / 2, 0))

    held = collections.Counter(lang for _, _, lang, *_ in rows if lang is not None)
    common = set()
    for lang in held:
        if held[lang] >= share * len(rows):
            c = collections.Counter(w for _, t, own, *_ in rows if own == lang for w in words(low(t)))
            common |= set(sorted(c, key=lambda w: (-c[w], w))[:divergence.COMMON])
    common = sorted(common)
    def histogram(text):
        c, n = collections.Counter(words(low(text))), max(len(words(text)), 1)
        own = [c[w] / n for w in common]
        return shares(text or ""), [*own, 1 - sum(own)]

    each = [(i, t or "", lang, brute_rules(t)[-1], *histogram(t)) for i, t, lang, *_ in rows]
    members = collections.defaultdict(list)
    for k, (_, _, lang, failed, *_) in enumerate(each):
        if not failed and lang is not None:
            members[lang].append(k)
    members = {lang: ks for lang, ks in members.items()
               if held[lang] >= share * len(rows) and len({each[k][1] for k in ks}) >= least}
    out = []
    for k, (i, text, lang, failed, *own) in enumerate(each):
        far = {}
        for name, ks in members.items():
            rest = [j for j in ks if j != k]
            far[name] = [jsd(own[h], [sum(each[j][4 + h][x] for j in rest) / len(rest) for x in range(len(own[h]))]) for h in (0, 1)]
        a, b = [min(f[h] for f in far.values()) for h in (0, 1)]
        b = far[lang][1] if lang in far else b
        fine = (len(text) < divergence.CLASS_GUARD or a <= divergence.CLASS_LIMIT) and (
            len(words(text)) < divergence.WORD_GUARD or b <= divergence.WORD_LIMIT or (lang is not None and lang not in far))
        out.append((i, not failed and fine, a, b))
    return out


def junk(seed, n=200):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("0123456789#%&$@=+") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_verdicts_equal_brute_force(spark):
    rows = documents(150) + AWKWARD + [
        (800, junk(1), "zz", "s"), (801, junk(2), "en", "s"), (802, junk(3), None, "s"), (803, prose(random.Random(4), "de", 90), "zy", "s"),
        (804, prose(random.Random(5), "fr", 90), None, "s"), *[(810 + i, junk(9), "zx", "s") for i in range(30)]]
    got = {(r.doc_id, r.kept, round(r.class_distance, 6), round(r.word_distance, 6)) for r in divergence.judge(frame(spark, rows)).collect()}
    assert got == {(i, k, round(a, 6), round(b, 6)) for i, k, a, b in brute_verdicts(rows)}
    kept = {i: k for i, k, *_ in got}
    assert not any(kept[i] for i in (800, 801, 802, 810)) and kept[803] and kept[804]


def test_jensen_shannon_distance(spark):
    from pyspark.sql import functions as F

    p, q = [0.5, 0.5, 0.0], [0.25, 0.25, 0.5]
    got = spark.range(1).select(divergence.distance([(F.lit(a), F.lit(b)) for a, b in zip(p, q)])).first()[0]
    half = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x)
    assert got == pytest.approx(math.sqrt((half(p, q) + half(q, p)) / 2))


def brute_classes(rows, bits=4):
    def print_of(text):
        w = low(text).encode()
        w = w.split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = [print_of(t) for _, t, *_ in rows]
    root = list(range(len(rows)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                root[find(i)] = find(j)
    least = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return collections.Counter((i, format(p, "016x"), least.get(find(k))) for k, ((i, *_), p) in enumerate(zip(rows, prints)))


def test_simhash_classes_equal_brute_force(spark):
    rng = random.Random(8)
    rows, base = documents(80) + AWKWARD, prose(rng, "en", 200).split()
    for i in range(60):  # a dense group of near copies, each a word from another
        base[rng.randrange(len(base))] = rng.choice(WORDS["fr"])
        rows.append((3000 + i, " ".join(base), "en", "hot"))
    got = collections.Counter(tuple(r) for r in simhash.classes(frame(spark, rows)).collect())
    assert got == brute_classes(rows)


def test_split_cells_lose_no_link(spark):
    rng = np.random.default_rng(3)
    core = int(rng.integers(0, 1 << 63))
    prints = {core ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in range(150)}
    prints |= {int(x) for x in rng.integers(0, 1 << 63, 100)}
    rows = [(i, p.to_bytes(8, "big")) for i, p in enumerate(sorted(prints))]
    nodes = spark.createDataFrame(rows, "node long, fp binary")
    found = simhash.links(nodes, simhash.block_keys(64, 4, len(rows)), 64, 4, cell=16).collect()
    values = sorted(prints)

    def classes(pairs):
        root = list(range(len(rows)))
        find = lambda i: i if root[i] == i else find(root[i])
        for a, b in pairs:
            root[find(a)] = find(b)
        groups = collections.defaultdict(set)
        for i in range(len(rows)):
            groups[find(i)].add(i)
        return sorted(map(sorted, groups.values()))

    want = [(i, j) for i in range(len(rows)) for j in range(i) if bin(values[i] ^ values[j]).count("1") <= 4]
    assert classes([(r.a, r.b) for r in found]) == classes(want)
    assert all(bin(values[r.a] ^ values[r.b]).count("1") <= 4 for r in found)


def test_pivots_discard_only_what_is_too_far():
    rng = np.random.default_rng(6)
    lanes = rng.integers(0, 1 << 64, (1, 40, 1), dtype=np.uint64)
    lanes[0, 20:] = lanes[0, :20] ^ np.uint64(0b1011)
    table = simhash.pivot_table(lanes[0], 64)[None]
    d = simhash._close(lanes, table, 4)[0]
    true = np.bitwise_count(lanes[0] ^ lanes[0].T)
    assert ((d <= 4) == ((true <= 4) & ~np.eye(40, dtype=bool))).all()


def shingle_set(text, k=5):
    w = low(text).encode().split()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def test_near_copies_leave_one(spark):
    rng, rows = random.Random(9), []
    for g in range(30):
        base = [rng.choice("abcdefghij") + str(rng.randrange(500)) for _ in range(200)]
        rows.append((g * 10, " ".join(base), "en", "s"))
        for c in range(1, 4):
            copy = list(base)
            copy[rng.randrange(200)] = f"changed{g}{c}"
            rows.append((g * 10 + c, " ".join(copy), "en", "s"))
        far = [w if rng.random() < 0.6 else f"o{rng.randrange(9999)}" for w in base]
        rows.append((g * 10 + 9, " ".join(far), "en", "s"))
    rows += [(5000, rows[0][1], "en", "s"), (5000, rows[0][1], "en", "s"), (6000, "", "en", "s"), (6001, None, "en", "s"), (6002, "lone", "en", "s"), (6002, "lone", "en", "s")]
    docs = frame(spark, rows)
    left = simhash.keep_one(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(
        [g * 10 for g in range(30)] + [g * 10 + 9 for g in range(30)] + [6000, 6002])


def test_pairs_just_above_the_similarity_are_all_linked(spark):
    rng, rows = random.Random(12), []
    for g in range(400):
        n = rng.choice([40, 80, 300])
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
        copy = list(base)
        while True:  # words are changed until one more would take the pair below the similarity
            tried = list(copy)
            tried[rng.randrange(n)] = f"x{rng.randrange(10 ** 9)}"
            x, y = shingle_set(" ".join(base)), shingle_set(" ".join(tried))
            if len(x & y) < 0.8 * len(x | y):
                break
            copy = tried
        rows += [(2 * g, " ".join(base), "en", "s"), (2 * g + 1, " ".join(copy), "en", "s")]
    left = {r.doc_id for r in simhash.keep_one(frame(spark, rows, False)).collect()}
    assert left == {2 * g for g in range(400)}


def test_a_copy_that_repeats_a_line_many_times_is_near(spark):
    rng, rows = random.Random(13), []
    for g in range(40):
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(104)]
        rows.append((2 * g, " ".join(base), "en", "s"))
        rows.append((2 * g + 1, " ".join(base + base[:14] * 15), "en", "s"))
        assert len(shingle_set(rows[-2][1]) & shingle_set(rows[-1][1])) >= 0.8 * len(shingle_set(rows[-1][1]))
    assert {r.doc_id for r in simhash.keep_one(frame(spark, rows, False)).collect()} == {2 * g for g in range(40)}


def test_components_of_a_chain_and_a_star(spark):
    from quayside.llm.components import components

    links = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(40)] + [(7, 7), (3, 2), (3, 2)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(41)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def changed(rng, base, n):
    out = list(base)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"new{rng.randint(0, 10**9)}"
    return " ".join(out)


def brute_groups(texts):
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for t in texts]
    root = list(range(len(texts)))
    for i, x in enumerate(sets):
        for j in range(i):
            if root[i] != root[j] and len(x & sets[j]) >= 0.8 * len(x | sets[j]):
                root = [root[j] if r == root[i] else r for r in root]
    return root


@pytest.mark.parametrize("family,away", [(120, 4), (60, 6), (90, 2)])
def test_families_of_near_copies_lose_no_link(spark, monkeypatch, family, away):
    rng = random.Random(family)
    base = [f"w{rng.randint(0, 10**9)}" for _ in range(300)]
    texts = [changed(rng, base, away) for _ in range(family)] + [prose(rng, "en", 100) for _ in range(5)]
    want = brute_groups(texts)
    rows = frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)], False)
    assert {r.doc_id for r in simhash.keep_one(rows).collect()} == {i for i, r in enumerate(want) if want.index(r) == i}


def test_a_group_larger_than_a_cell_is_judged_whole(spark):
    rng = random.Random(6)
    base = [f"w{rng.randint(0, 10**9)}" for _ in range(300)]
    texts = [changed(rng, base, 4) for _ in range(100)] + [changed(rng, base, 9) for _ in range(40)]
    nodes = [(i, 0, 300) for i in range(len(texts))]
    members = spark.createDataFrame(nodes, "node long, group long, weight long")
    held = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    links = set_classes.linked(members, held, lambda t: simhash.shingle_hashes(t, 5), 0.8, sets=16).collect()
    root = list(range(len(texts)))
    for a, b in links:
        root = [root[b] if r == root[a] else r for r in root]
    want = brute_groups(texts)
    assert [root.index(r) for r in root] == [want.index(r) for r in want]


def test_near_duplicates_of_awkward_rows(spark):
    assert simhash.keep_one(frame(spark, [])).count() == 0
    left = simhash.keep_one(frame(spark, AWKWARD)).collect()
    ids = sorted((r.doc_id for r in left), key=str)
    assert ids == sorted([1, None, 4, 5, 6, 7, 8], key=str)  # 1, 2, 3 and the null row have no words; 4 is there twice
