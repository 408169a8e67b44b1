"""License scans: MinHash bands over overlapping text windows, verified by exact containment.

Templates fall into length classes. For each class a document is cut into windows of twice the
class's length that overlap by that length, so an occurrence always lies whole in one window. A
window with as many template shingles as some template needs gets a MinHash signature; bands of one row
each retrieve the templates that agree with it anywhere. For a template of which a window contains
the required share, the chance that no band agrees is below `miss(...)`: under one in ten thousand
for the shortest template and far less for longer ones. What is retrieved is verified by counting
the template's shingles in the window exactly. Every template so found counts, unless one that holds
more shingles was found on the same words.

Windows with fewer template shingles cannot contain a template and are passed over; that loses
nothing.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Short notices by which works name their license (fixed values).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "This work is dedicated to the public domain under CC0 1.0 Universal.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
#: Paragraphs by which files are put under a license.
HEADERS = {
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
                  "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                  'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
                  "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
               "file, You can obtain one at https://mozilla.org/MPL/2.0/.",
} | {
    name: f"This program is free software; you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the Free "
          f"Software Foundation; either version {version} of the License, or (at your option) any later version. This program is distributed in the "
          "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
          f"PURPOSE. See the GNU {kind} for more details."
    for name, kind, version in (
        ("GPL-2.0", "General Public License", 2), ("GPL-3.0", "General Public License", 3), ("LGPL-3.0", "Lesser General Public License", 3))
}
#: Whole license texts.
TEXTS = {p.stem: p.read_text("utf-8") for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
#: All templates of each license.
ALL = {name: tuple(own[name] for own in (TEMPLATES, HEADERS, TEXTS) if name in own) for name in TEMPLATES}
SHINGLE = 3
CONTAINED = 0.8
BANDS = 48
CLASSES = (8, 16, 32, 64, 128, 256, 512, 1024, 2048, 4096, 8192)
#: Leading bits of a shingle by which nearly all that belong to no template are passed over.
SCREEN = 20
TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+")
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingles(text: str | None) -> np.ndarray:
    """64-bit hashes of all runs of three normalised words; of fewer words, none."""
    parts = TOKEN.findall((text or "").lower().encode("utf-8", "surrogatepass"))
    if len(parts) < SHINGLE:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(zlib.crc32, parts), np.uint64, len(parts))
    n = len(w) - SHINGLE + 1
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for k in range(SHINGLE):
            h = (h ^ w[k:k + n]) * _A
            h ^= h >> np.uint64(31)
    return h


def signature(h: np.ndarray) -> np.ndarray:
    """The least value of the shingles under each of `BANDS` fixed permutations."""
    with np.errstate(over="ignore"):
        turned = (h[None] ^ (np.arange(1, BANDS + 1, dtype=np.uint64) * _B)[:, None]) * _A
        turned ^= turned >> np.uint64(29)
        turned *= _B
    return (turned ^ (turned >> np.uint64(32))).min(1)


def miss(template_words: int, length: int, contained: float = CONTAINED, bands: int = BANDS) -> float:
    """Chance that no band retrieves a template of which a window holds the share `contained`."""
    own = template_words - SHINGLE + 1
    held = int(np.ceil(contained * own - 1e-9))
    window = 2 * length - SHINGLE + 1
    return (1 - held / (window + own - held)) ** bands


@dataclass(frozen=True)
class Index:
    """Templates of one length class: shingle sets, and template numbers by (band, value)."""

    length: int
    names: tuple[str, ...]
    sets: tuple[frozenset, ...]
    bands: dict
    known: np.ndarray


def index(templates: Mapping[str, str | tuple[str, ...]]) -> tuple[Index, ...]:
    """Templates by length class; one of fewer than three words, or longer than any class, is refused."""
    by_class: dict[int, list[tuple[str, np.ndarray]]] = {}
    for name, text in ((n, t) for n, own in sorted(templates.items()) for t in ((own,) if isinstance(own, str) else own)):
        h = np.unique(shingles(text))
        n = len(shingles(text)) + SHINGLE - 1
        if not len(h) or n > CLASSES[-1]:
            raise ValueError(f"template {name!r} must have {SHINGLE} to {CLASSES[-1]} words")
        by_class.setdefault(next(c for c in CLASSES if c >= n), []).append((name, h))
    out = []
    for length, own in sorted(by_class.items()):
        bands: dict = {}
        for t, (_, h) in enumerate(own):
            for band, value in enumerate(signature(h).tolist()):
                bands.setdefault((band, value), []).append(t)
        out.append(Index(length, tuple(n for n, _ in own), tuple(frozenset(h.tolist()) for _, h in own), bands,
                         np.unique(np.concatenate([h for _, h in own]))))
    return tuple(out)


@dataclass(frozen=True)
class Table:
    """Shingles of all templates in order, the length classes that have each (a bit per class), and the
    leading `SCREEN` bits that occur among them."""

    shingles: np.ndarray
    classes: np.ndarray
    screen: np.ndarray


def table(indexes: tuple[Index, ...]) -> Table:
    every = np.unique(np.concatenate([np.empty(0, np.uint64), *(own.known for own in indexes)]))
    classes = np.zeros(len(every), np.uint16)
    for k, own in enumerate(indexes):
        classes[np.searchsorted(every, own.known)] |= 1 << k
    screen = np.zeros(1 << SCREEN, bool)
    screen[(every >> np.uint64(64 - SCREEN)).astype(np.int64)] = True
    return Table(every, classes, screen)


def hits(h: np.ndarray, known: Table) -> tuple[np.ndarray, np.ndarray]:
    """Where a text's shingles are some template's, and the classes of those."""
    at = np.flatnonzero(known.screen[(h >> np.uint64(64 - SCREEN)).view(np.int64)])
    own = h[at]
    place = np.minimum(np.searchsorted(known.shingles, own), len(known.shingles) - 1)
    same = known.shingles[place] == own if len(at) else np.zeros(0, bool)
    return at[same], known.classes[place[same]]


def _place(part: np.ndarray, own: frozenset, start: int, contained: float) -> tuple[int, frozenset]:
    """Where a template stands in a window: how many of its shingles a stretch of about its length
    holds at most, and the words at which they start in the shortest such stretch."""
    values = part.tolist()
    at = [i for i, x in enumerate(values) if x in own]
    length, low, best = int(len(own) / contained), 0, (0, 0, 0, 0)
    count: dict = {}
    for high, i in enumerate(at):
        count[values[i]] = count.get(values[i], 0) + 1
        while i - at[low] >= length or count[values[at[low]]] > 1:
            left = values[at[low]]
            count[left] -= 1
            if not count[left]:
                del count[left]
            low += 1
        best = max(best, (len(count), at[low] - i, low, high))
    held, _, low, high = best
    return held, frozenset(start + i for i in at[low:high + 1])


def find(text: str | None, indexes: tuple[Index, ...], known: Table, contained: float) -> list[tuple[str, int, float]]:
    """The templates of each window, unless one that holds more stands on the same words: (name, first
    word of the window, containment)."""
    h = shingles(text)
    at, classes = hits(h, known)
    found = []
    for k, own in enumerate(indexes):
        step = own.length
        held = at[classes >> k & 1 == 1]
        needed = max(1, min(int(np.ceil(contained * len(s) - 1e-9)) for s in own.sets))
        if len(held) < needed:
            continue
        starts = np.arange(0, len(h), step)
        count = np.searchsorted(held, starts + 2 * step - SHINGLE + 1) - np.searchsorted(held, starts)
        for start in starts[count >= needed].tolist():
            part = h[start:start + 2 * step - SHINGLE + 1]
            seen = {t for key in enumerate(signature(part).tolist()) for t in own.bands.get(key, ())}
            here = set(part.tolist()) if seen else set()
            for t in sorted(seen):
                share = len(own.sets[t] & here) / len(own.sets[t])
                if share >= contained:
                    found.append((own.names[t], start, share, *_place(part, own.sets[t], start, contained)))
    stay: list[int] = []
    for k in sorted(range(len(found)), key=lambda k: -found[k][3]):
        if not any(found[o][3] > found[k][3] and found[o][4] & found[k][4] for o in stay):
            stay.append(k)
    return [found[k][:3] for k in sorted(stay)]


def scan(docs: DataFrame, templates: Mapping[str, str | tuple[str, ...]] = ALL, contained: float = CONTAINED) -> DataFrame:
    """License notices in every row of `docs`.

    Returns doc_id, n_licenses, licenses (names, sorted, comma-joined), containment (the best; 0 if
    none) and matches (array of license, word where its window starts, containment). A license may have
    several templates. All that are found count; of those on the same words, the ones that hold most
    shingles.

    A null, empty or very short text has none; texts are scanned whole; a null doc_id is kept;
    repeated rows are scanned alike; no rows give no rows; other columns are not looked at.
    """
    indexes = index(templates)
    known = table(indexes)
    kind = dict(docs.dtypes)["doc_id"]
    match = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("containment", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [find(t.as_py(), indexes, known, contained) for t in batch.column("text")]
            names = [sorted({m[0] for m in r}) for r in rows]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(n) for n in names], pa.int64()),
                pa.array([",".join(n) for n in names]),
                pa.array([max((m[2] for m in r), default=0.0) for r in rows], pa.float64()),
                pa.array([[dict(zip(("license", "start", "containment"), m)) for m in r] for r in rows], match),
            ], names=["doc_id", "n_licenses", "licenses", "containment", "matches"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_licenses long, licenses string, containment double, "
             "matches array<struct<license:string,start:long,containment:double>>")
