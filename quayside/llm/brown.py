"""Language-model scores from a class-based bigram model (Brown classes by exchange).

Learning
    Words are counted over all training documents. The most frequent ones, and the endings of all
    other words, are the units to be clustered first; the counts of neighbouring units over all training
    documents are at most (units)^2 numbers. Exchange clustering moves each unit to the class that
    raises the likelihood of the class bigram most, until a sweep moves few. Then every other word, however
    rare, goes to the class under which its own neighbours are likeliest (`classed_words`): the classes
    before and after it are counted and brought to the word by a shuffle. The class bigram is counted
    anew from all training documents with the classes of all their words.

Scoring
    P(word | history) = a P(class | class before) P(word | class) + (1 - a) P(word). Both word
    probabilities are proportional to the word's count, with the Good-Turing mass of words seen once
    set aside for words never seen; so the log probability of a token splits into the log of its count
    and a part known from the classes alone. A document becomes one class per token: frequent words take
    theirs from a broadcast table of a fixed size; the places of all others go to the word's count and class
    by a join and back to the document, whatever the size of the vocabulary.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.text import cut, is_fold

MODULUS, HELD_OUT = 7, 2
#: Most words in the broadcast table of counts.
HEAD = 200_000
#: Frequent words that are units of their own, and units for the endings of all other words.
FREQUENT, ENDINGS, ENDING = 1000, 256, 3
CLASSES = 48
SWEEPS = 12
WEIGHT = 0.9
#: Entries a task counts before it passes them on.
FLUSH = 500_000


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space with A-Z lower-cased; the end token is left to the caller."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def ending(word: bytes) -> int:
    return zlib.crc32(word[-ENDING:]) % ENDINGS


def count_words(train: DataFrame) -> DataFrame:
    """word and c, its tokens in the training documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "c"])
            seen.clear()
            return batch

        for batch in batches:
            for text in batch.column("text"):
                seen.update(tokens(text.as_py()))
                if len(seen) > FLUSH:
                    yield flush()
        yield flush()

    return train.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def head_words(counts: DataFrame, limit: int = HEAD) -> tuple[list[bytes], np.ndarray, int]:
    """All words whose count is at least a bound, with their counts, and the bound, which is chosen
    so that there are no more than `limit`; most frequent first."""
    step = F.floor(F.log(F.col("c")) / F.lit(0.01)).cast("int")
    steps = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least"))
    bound, held = None, 0
    for row in sorted(steps.collect(), key=lambda r: -r["step"]):  # one per hundredth of a log count
        held += row["n"]
        if held > limit:
            break
        bound = row["least"]
    if bound is None:
        return [], np.empty(0), 1 << 62
    got = counts.where(F.col("c") >= bound).toArrow()
    words, n = got.column("word").to_pylist(), got.column("c").to_numpy()
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
    return [bytes(words[i]) for i in order], n[order].astype(float), bound


def units_of(parts: list[bytes], frequent: dict[bytes, int], n_frequent: int) -> np.ndarray:
    """Unit of each word: its own if frequent, else that of its ending."""
    own = np.fromiter((frequent.get(w, -1) for w in parts), np.int64, len(parts))
    for i in np.nonzero(own < 0)[0].tolist():
        own[i] = n_frequent + ending(parts[i])
    return own


def count_pairs(train: DataFrame, frequent: list[bytes]) -> np.ndarray:
    """Counts of neighbouring units over all training documents; the end token, last of the units,
    stands before a document and after it."""
    n_units, n_frequent = len(frequent) + ENDINGS + 1, len(frequent)
    shared = train.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(frequent)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(n_units * n_units, np.int64)
        for batch in batches:
            held, size = [], 0
            for text in batch.column("text"):
                own = units_of(tokens(text.as_py()), shared.value, n_frequent)
                held += [[n_units - 1], own]
                size += len(own) + 1
                if size > 1_000_000:
                    flow = np.concatenate([*held, [n_units - 1]])
                    np.add.at(table, flow[:-1] * n_units + flow[1:], 1)
                    held, size = [], 0
            if held:
                flow = np.concatenate([*held, [n_units - 1]])
                np.add.at(table, flow[:-1] * n_units + flow[1:], 1)
        cells = np.nonzero(table)[0]
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(table[cells])], names=["cell", "n"])

    sums = train.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    got = sums.toArrow()  # at most n_units squared rows
    table = np.zeros(n_units * n_units)
    table[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return table.reshape(n_units, n_units)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit. Units are visited by frequency; each goes where the likelihood of the
    class bigram is highest, the others staying where they are."""
    n = len(pairs)
    seen = pairs.sum(0) + pairs.sum(1)
    order = np.argsort(-seen, kind="stable")
    own = np.empty(n, np.int64)
    own[order] = np.arange(n) % min(classes, n)
    k = min(classes, n)
    member = np.eye(k)[own]
    joint = member.T @ pairs @ member
    for _ in range(sweeps):
        moves = 0
        for w in order:
            if not seen[w]:
                continue
            a = own[w]
            loop = pairs[w, w]
            after = np.bincount(own, pairs[w], k)
            before = np.bincount(own, pairs[:, w], k)
            after[a] -= loop
            before[a] -= loop
            joint[a] -= after
            joint[:, a] -= before
            joint[a, a] -= loop
            held = _xlogx(joint)
            gain = (_xlogx(joint + after) - held).sum(1) + (_xlogx(joint + before[:, None]) - held).sum(0)
            d = np.diag(joint)
            gain += _xlogx(d + after + before + loop) + _xlogx(d) - _xlogx(d + after) - _xlogx(d + before)
            rows, cols = joint.sum(1), joint.sum(0)
            gain -= _xlogx(rows + after.sum() + loop) - _xlogx(rows)
            gain -= _xlogx(cols + before.sum() + loop) - _xlogx(cols)
            b = int(np.argmax(gain))
            b = a if gain[b] <= gain[a] + 1e-9 else b
            own[w] = b
            joint[b] += after
            joint[:, b] += before
            joint[b, b] += loop
            moves += b != a
        if moves <= n // 200:
            break
    return own


def steps_between(joint: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(class | class before) and the tokens of each class, from counts of neighbouring classes."""
    size = joint.sum(0)
    share = (size + 1) / (size.sum() + len(joint))
    return (joint + 5 * share) / (joint.sum(1, keepdims=True) + 5), size


def count_neighbours(train: DataFrame, frequent: list[bytes], own: np.ndarray) -> DataFrame:
    """word, cell, n for every word that is not frequent: how often a class stands before it (cell: the
    class) and after it (cell: classes + the class). Classes are those of the units."""
    k, n_frequent = int(own.max()) + 1, len(frequent)
    shared = train.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(frequent)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        flow: list = [[-1]]
        size = 0

        def flush() -> pa.RecordBatch:
            words = list(seen)
            unit = np.append(units_of(words, shared.value, n_frequent), len(own) - 1)
            cls, at = own[unit], np.concatenate(flow).astype(np.int64)  # the end token is -1
            rare = np.nonzero((unit[at] >= n_frequent) & (at >= 0))[0]
            cells = np.concatenate([at[rare] * 2 * k + cls[at[rare - 1]], at[rare] * 2 * k + k + cls[at[rare + 1]]])
            cells, n = np.unique(cells, return_counts=True)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()).take(pa.array(cells // (2 * k))), pa.array((cells % (2 * k)).astype(np.int32)),
                 pa.array(n.astype(np.int64))], names=["word", "cell", "n"])
            seen.clear()
            flow[:] = [[-1]]
            return batch

        for batch in batches:
            for text in batch.column("text"):
                parts = tokens(text.as_py())
                flow += [np.fromiter((seen.setdefault(w, len(seen)) for w in parts), np.int64, len(parts)), [-1]]
                size += len(parts) + 1
                if len(seen) > FLUSH or size > 8 * FLUSH:
                    yield flush()
                    size = 0
        yield flush()

    return train.select("text").mapInArrow(run, "word binary, cell int, n long")


def classed_words(train: DataFrame, frequent: list[bytes], own: np.ndarray, joint: np.ndarray) -> DataFrame:
    """word, c and cls of every training word that is not frequent: the class under which its own
    neighbours are likeliest. Another class than that of its ending is charged with its name, log(classes)."""
    k = len(joint)
    step, size = steps_between(joint)
    worth = np.concatenate([np.log(step) - np.log(size + 1), np.log(step).T])
    endings = own[len(frequent):len(frequent) + ENDINGS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, cells = batch.column("word"), batch.column("cells")
            flat, sizes = cells.flatten(), np.diff(cells.offsets.to_numpy())
            table = np.zeros((len(words), 2 * k))
            table[np.repeat(np.arange(len(words)), sizes), flat.field("cell").to_numpy()] = flat.field("n").to_numpy()
            gain = table @ worth
            stay = endings[np.fromiter((ending(w.as_py()) for w in words), np.int64, len(words))]
            gain[np.arange(len(words)), stay] += np.log(k) + 1e-9
            yield pa.RecordBatch.from_arrays(
                [words, pa.array(table[:, :k].sum(1).astype(np.int64)), pa.array(gain.argmax(1).astype(np.int32))],
                names=["word", "c", "cls"])

    # Dealt by word once; both groupings below keep to that.
    met = count_neighbours(train, frequent, own).repartition("word").groupBy("word", "cell").agg(F.sum("n").alias("n"))
    cells = met.groupBy("word").agg(F.collect_list(F.struct("cell", "n")).alias("cells"))  # at most two per class
    return cells.mapInArrow(run, "word binary, c long, cls int")


@dataclass(frozen=True)
class Head:
    """What coding needs: the head words with their counts and classes, and the classes of endings and end."""

    at: dict
    log_c: np.ndarray
    log_c1: np.ndarray
    cls: np.ndarray
    endings: np.ndarray
    end: int


#: Set in the code of a token that was never seen in training, beside the class of its ending.
UNSEEN = 128


def coded(docs: DataFrame, head: Head) -> DataFrame:
    """One closing row per document (the classes of its tokens, one byte each, and what head words give) and one
    per other word of it: where it stands."""
    shared = docs.sparkSession.sparkContext.broadcast(head)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        place_of = m.at.get
        for batch in batches:
            rows: list[list] = [[] for _ in range(8)]
            add = lambda *row: [c.append(v) for c, v in zip(rows, row)]
            digests = batch.column("digest")
            for i, text in enumerate(batch.column("text")):
                parts = tokens(text.as_py())
                at = np.fromiter((place_of(w, -1) for w in parts), np.int64, len(parts))
                code = np.full(len(parts) + 1, m.end, np.uint8)
                inside = at >= 0
                held = at[inside]
                code[:-1][inside] = m.cls[held]
                rest: dict = {}
                for j in np.nonzero(~inside)[0].tolist():
                    rest.setdefault(parts[j], []).append(j)
                for word, places in rest.items():
                    places = np.array(places, np.int32)
                    code[places] = m.endings[ending(word)] | UNSEEN
                    add(i, False, word, len(places), 0, 0.0, 0.0, places.tobytes())
                # A name that no word has (it holds a space), so closing rows meet nothing and lie in all partitions.
                name = b" " + digests[i].as_py().to_bytes(8, "little", signed=True)
                add(i, True, name, len(code), len(held) + 1, float(m.log_c1[held].sum()), float(m.log_c[held].sum()), code.tobytes())
            at = pa.array(rows[0], pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(at), digests.take(at), batch.column("held_out").take(at),
                pa.array(rows[1], pa.bool_()), pa.array(rows[2], pa.binary()), pa.array(rows[3], pa.int64()),
                pa.array(rows[4], pa.int64()), pa.array(rows[5], pa.float64()), pa.array(rows[6], pa.float64()),
                pa.array(rows[7], pa.binary()),
            ], names=["doc_id", "digest", "held_out", "closing", "word", "n", "known", "base", "sure", "body"])

    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"),
                       is_fold(F.col("doc_id"), MODULUS, HELD_OUT).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, digest long, held_out boolean, closing boolean, word binary, n long, known long, "
                                "base double, sure double, body binary")


def joined(parts: DataFrame, rare: DataFrame) -> DataFrame:
    """One row per different document: its copies, sums over them, the codes of its tokens (`body`) and, of its
    seen words beyond the head, class and places (`patches`)."""
    met = parts.join(rare, "word", "left")
    closing, seen = F.col("closing"), F.col("c").isNotNull()
    one = met.select(
        "doc_id", "digest", "held_out", F.when(closing, 1).otherwise(0).alias("copies"),
        F.when(closing, F.col("n")).otherwise(0).alias("tokens"),
        F.when(closing, F.col("known")).when(seen, F.col("n")).otherwise(0).alias("known"),
        F.when(closing, F.col("base")).otherwise(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("base"),
        F.when(closing, F.col("sure")).when(seen, F.col("n") * F.log10(F.col("c"))).otherwise(0.0).alias("sure"),
        F.when(closing, F.col("body")).alias("body"),
        F.when(seen, F.struct("cls", F.col("body").alias("places"))).alias("patch"),
    ).where(closing | seen)
    return one.groupBy("doc_id", "digest", "held_out").agg(
        *[F.sum(c).alias(c) for c in ("copies", "tokens", "known", "base", "sure")],
        F.max("body").alias("body"), F.collect_list("patch").alias("patches"))


def whole_codes(docs: DataFrame) -> DataFrame:
    """`joined` with the patches put into the codes."""
    kept = [c for c in docs.columns if c != "patches"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, patches = batch.column("body"), batch.column("patches")
            flow, start = _bytes_of(body)
            flat = patches.flatten()
            places, ends = _bytes_of(flat.field("places"))
            of = np.repeat(np.repeat(start[:-1], np.diff(patches.offsets.to_numpy())), np.diff(ends) // 4)
            flow = flow.copy()
            flow[places.view(np.int32) + of] = np.repeat(flat.field("cls").to_numpy(), np.diff(ends) // 4)
            whole = pa.Array.from_buffers(pa.binary(), len(body), [None, pa.py_buffer(start.astype(np.int32)), pa.py_buffer(flow)])
            yield pa.RecordBatch.from_arrays([whole if c == "body" else batch.column(c) for c in kept], names=kept)

    return docs.mapInArrow(run, docs.select(*kept).schema)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column one after another, and where each value starts and the last ends."""
    values = column.to_pylist()
    sizes = np.fromiter((len(v) for v in values), np.int64, len(values))
    return np.frombuffer(b"".join(values), np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def _steps(flow: np.ndarray, start: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Class before and class of every token; the end token stands before a document."""
    cls = (flow & (UNSEEN - 1)).astype(np.int64)
    prev = np.empty_like(cls)
    prev[1:] = cls[:-1]
    prev[start[:-1]] = end
    return prev, cls


def count_classes(train: DataFrame, k: int, end: int) -> np.ndarray:
    """Counts of neighbouring classes over coded training documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(k * k)
        for batch in batches:
            flow, start = _bytes_of(batch.column("body"))
            prev, cls = _steps(flow, start, end)
            copies = np.repeat(batch.column("copies").to_numpy(), np.diff(start))
            table += np.bincount(prev * k + cls, copies, k * k)
        cells = np.nonzero(table)[0]
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(table[cells].astype(np.int64))], names=["cell", "n"])

    sums = train.select("body", "copies").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    got = sums.toArrow()  # at most k squared rows
    table = np.zeros(k * k)
    table[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return table.reshape(k, k)


def assemble(joint: np.ndarray, once: np.ndarray, total: int, weight: float = WEIGHT) -> tuple[np.ndarray, np.ndarray]:
    """log10 of what a word's count is to be multiplied with (known) or what stands in its place (unseen), by
    class pair. `once`: words seen once, by class; `total`: training tokens."""
    step, size = steps_between(joint)
    apart = np.minimum((once + 0.5) / (size + 1), 0.5)
    apart_all = min((once.sum() + 0.5) / (total + 1), 0.5)
    known = weight * step * ((1 - apart) / np.maximum(size, 1)) + (1 - weight) * (1 - apart_all) / max(total, 1)
    unseen = weight * step * apart + (1 - weight) * apart_all
    return np.log10(known), np.log10(unseen)


def class_scores(docs: DataFrame, known: np.ndarray, unseen: np.ndarray, end: int) -> DataFrame:
    """Coded documents with `path`: what the classes of their tokens give."""
    kept = [c for c in docs.columns if c != "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flow, start = _bytes_of(batch.column("body"))
            prev, cls = _steps(flow, start, end)
            part = np.where(flow >= UNSEEN, unseen[prev, cls], known[prev, cls])
            path = np.add.reduceat(part, start[:-1]) if len(start) > 1 else np.empty(0)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(path)], names=[*kept, "path"])

    return docs.mapInArrow(run, docs.select(*kept, F.lit(0.0).alias("path")).schema)


def score(docs: DataFrame) -> DataFrame:
    """Log10 probability of every text under the model and under the add-one unigram base.

    Learns from rows whose crc32(doc_id as text) mod 7 is not 2; a null doc_id is learnt from.
    Returns per row of `docs`: doc_id, held_out, n_tokens (words and one end), n_known, train_tokens,
    base_score, score and perplexity.

    A null or blank text is its end token; whole texts of any length are read; repeated rows are
    scored alike and all returned; without training rows every word is unseen; no rows give no rows;
    other columns are not looked at.
    """
    own = docs.select("doc_id", "text")
    train = own.where(~is_fold(F.col("doc_id"), MODULUS, HELD_OUT))
    counts = cut(count_words(train), "lm-counts")
    n_docs = train.count()
    n_words, n_distinct = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    total, vocabulary = (n_words or 0) + n_docs, n_distinct + (n_docs > 0)
    words, c, bound = head_words(counts)
    frequent = words[:FREQUENT]
    pairs = count_pairs(train, frequent)
    unit_class = exchange(pairs)
    k, end = int(unit_class.max()) + 1, int(unit_class[-1])
    member = np.eye(k)[unit_class]
    others = cut(classed_words(train, frequent, unit_class, member.T @ pairs @ member), "lm-classes")
    at = {w: i for i, w in enumerate(words)}
    cls = np.zeros(len(words), np.uint8)
    cls[:len(frequent)] = unit_class[:len(frequent)]
    got = others.where(F.col("c") >= bound).select("word", "cls").toArrow()  # no more than the head
    cls[[at[w] for w in got.column("word").to_pylist()]] = got.column("cls").to_numpy()
    head = Head(at, np.log10(c), np.log10(c + 1), cls, unit_class[len(frequent):len(frequent) + ENDINGS].astype(np.uint8), end)
    once = np.bincount(cls[:len(frequent)], c[:len(frequent)] == 1, k)
    for row in others.where("c = 1").groupBy("cls").count().collect():  # one per class
        once[row["cls"]] += row["count"]
    whole = cut(whole_codes(joined(coded(own, head), others.where(F.col("c") < bound))), "lm-codes")
    known, unseen = assemble(count_classes(whole.where(~F.col("held_out")), k, end), once, total)
    scored = class_scores(whole, known, unseen, end)
    copies = F.col("copies")
    each = lambda name: (F.col(name) / copies).cast("long")
    n = each("tokens")
    of_end = lambda seen: F.lit(float(np.log10(max(seen, 1))))
    return scored.select(
        "doc_id", "held_out", n.alias("n_tokens"), each("known").alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") / copies + of_end(n_docs + 1) - n * F.lit(float(np.log10(total + vocabulary + 1)))).alias("base_score"),
        (F.col("sure") / copies + F.col("path") + of_end(n_docs)).alias("score"),
        F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("_copy"),
    ).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))).drop("_copy")
