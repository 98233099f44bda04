"""License notices in documents: MinHash bands over text windows, then exact containment.

A document is a run of word shingles, cut into windows of 2c shingles that begin every c
shingles, for each power of two c. A template of more than c/2 and at most c shingles lies
whole in one such window wherever it stands. With ``threshold`` of it there, window and
template have a Jaccard similarity of at least 0.4 c / (2c + 0.1 c) = 0.19, or a quarter
for single shingles, so that one of 64 bands of one row agrees with a probability of
1 - 0.81^64, more than 0.999998. What the bands retrieve is then checked exactly.

Licenses share much of their wording, so of matches that overlap only the best stays:
the one with more of the shingles that the other does not have (see ``lead``).
"""

from __future__ import annotations

import pathlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillmill.llm.license_texts import TEMPLATES
from quillmill.llm.shingles import SIZE, shingles, word_numbers as numbers

BANDS = 64
THRESHOLD = 0.8
#: Shingles hashed together.
TOGETHER = 1_000_000

WORD = re.compile(r"[^\W_]+")
_MIX = np.random.default_rng(20_240_601).integers(0, 1 << 63, (BANDS, 2), dtype=np.uint64) * 2 + 1


def word_numbers(text: str) -> np.ndarray:
    return numbers(WORD.findall(text.lower()))


class Templates:
    """Shingles of the templates and the places of their minima, by window class.

    Templates of fewer than ``SIZE`` words are one shingle of their own length.
    """

    def __init__(self, templates: tuple, threshold: float):
        self.names, self.sets, self.sizes, self.threshold = [], [], [], threshold
        #: place of each shingle in its template, and the shingles as a Python set
        self.orders, self.members = [], []
        for name, text in templates:
            words = word_numbers(text)
            size = min(SIZE, len(words))
            if size:
                self.names.append(name)
                self.sizes.append(size)
                run = shingles(words, size)
                self.sets.append(np.unique(run))
                self.orders.append({h: k for k, h in reversed(list(enumerate(run.tolist())))})
                self.members.append(set(run.tolist()))
        self.classes: dict[tuple[int, int], dict] = {}
        for t, have in enumerate(self.sets):
            c = max(2, 1 << (len(have) - 1).bit_length())
            known = self.classes.setdefault((self.sizes[t], c), {})
            for band in range(BANDS):
                known.setdefault((band, int(minima(have, band).min())), []).append(t)
        self.keys = {
            k: [np.array(sorted(v for b, v in known if b == band), np.uint64) for band in range(BANDS)] for k, known in self.classes.items()
        }

    def candidates(self, hashes: np.ndarray, size: int) -> set[tuple[int, int, int]]:
        """``(first shingle, end, template)`` of the windows whose bands agree."""
        found, classes = set(), sorted(c for s, c in self.classes if s == size)
        if not classes or not len(hashes):
            return found
        top = classes[-1]
        padded = -len(hashes) % top
        for band in range(BANDS):
            low, c = np.concatenate((minima(hashes, band), np.full(padded, ~np.uint64(0)))), 1
            while c < top:
                c *= 2
                low = np.minimum(low[::2], low[1::2])
                if (size, c) in self.classes:
                    windows = np.minimum(low, np.append(low[1:], ~np.uint64(0)))
                    for k in np.flatnonzero(np.isin(windows, self.keys[size, c][band])).tolist():
                        found.update((k * c, (k + 2) * c, t) for t in self.classes[size, c][band, int(windows[k])])
        return found


def minima(hashes: np.ndarray, band: int) -> np.ndarray:
    """The order of a band: the smallest value of a set is its MinHash."""
    return (hashes ^ _MIX[band, 0]) * _MIX[band, 1]


def occurrences(have: np.ndarray, order: dict[int, int], at: np.ndarray, hashes: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """First and last place of each occurrence among the template's shingles found ``at``.

    The wording begins anew behind a gap as long as the template, and where a shingle
    comes again that began the occurrence, or that may be the first of the next when
    enough has been seen. Wording in another order, of which no such part is enough, is
    one occurrence.
    """
    parts, part, ranks, first, late = [], [], set(), 0, (1 - threshold) * len(have)
    for place, h in zip(at.tolist(), hashes.tolist()):
        rank = order[h]
        enough = len(ranks) >= len(have) - late and rank <= late
        again = (rank in ranks and (rank <= first or enough)) or (enough and rank < first)
        if again or (part and place - part[-1] > len(have)):
            parts.append((part, ranks))
            part, ranks = [], set()
        if not part:
            first = rank
        part.append(place)
        ranks.add(rank)
    parts.append((part, ranks))
    whole = [(p[0], p[-1]) for p, r in parts if len(r) >= threshold * len(have)]
    return whole or [(int(at[0]), int(at[-1]))]


def lead(own: set, other: set, found: set) -> tuple[int, float]:
    """How well a match does against an overlapping one, by the shingles only it has.

    Above 0 if most of them are there: a changed name costs a clause of its own some of
    its shingles, not the lead. The share of all shingles breaks ties.
    """
    only = own - other
    return (2 * len(only & found) - len(only), len(found) / len(own))


def best_matches(templates: Templates, matches: list[tuple[int, int, int, set]]) -> list[tuple[int, int, int, set]]:
    """Of ``(first word, end word, template, found)`` that overlap, those that no other beats."""
    kept: list[tuple[int, int, int, set]] = []
    for m in sorted(matches, key=lambda m: (-len(m[3]), templates.names[m[2]], m[:3])):
        rivals = [k for k in kept if k[0] < m[1] and m[0] < k[1]]
        wins = []
        for k in rivals:
            mine, theirs = templates.members[m[2]], templates.members[k[2]]
            wins.append(lead(mine, theirs, m[3]) > lead(theirs, mine, k[3]))
        if all(wins):
            kept = [k for k in kept if k not in rivals] + [m]
    return sorted(kept, key=lambda m: m[:3])


def text_matches(templates: Templates, texts: list[str]) -> list[list[tuple[int, int, int, set]]]:
    """All ``(first word, end word, template, found shingles)`` of each text, overlapping ones too."""
    words, matches = [word_numbers(t) for t in texts], [[] for _ in texts]
    for size in sorted(set(templates.sizes)):
        runs = [shingles(w, size) for w in words]
        starts = np.concatenate(([0], np.cumsum([len(r) for r in runs])))
        hashes = np.concatenate(runs) if runs else np.zeros(0, np.uint64)
        places: dict[tuple[int, int], list] = {}
        for first, end, t in sorted(templates.candidates(hashes, size)):
            have = templates.sets[t]
            hits = first + np.flatnonzero(np.isin(hashes[first:end], have))
            owner = np.searchsorted(starts, hits, "right") - 1
            for i in np.unique(owner).tolist():  # a window may span the end of a text
                own = hits[owner == i]
                if len(np.unique(hashes[own])) >= templates.threshold * len(have):
                    windows = places.setdefault((i, t), [])
                    if windows and own[0] <= windows[-1][-1]:  # of overlapping windows, one run
                        windows[-1] = np.union1d(windows[-1], own)
                    else:
                        windows.append(own)
        for (i, t), windows in places.items():
            for own in windows:
                for first, last in occurrences(templates.sets[t], templates.orders[t], own, hashes[own], templates.threshold):
                    inside = own[(own >= first) & (own <= last)]
                    matches[i].append((int(first - starts[i]), int(last - starts[i]) + size, t, set(hashes[inside].tolist())))
    return matches


def scan_texts(templates: Templates, texts: list[str]) -> list[tuple[int, str, float, int, int]]:
    """``(text number, license, containment, first word, end word)`` of the best matches."""
    return [
        (i, templates.names[t], len(found) / len(templates.sets[t]), first, end)
        for i, matches in enumerate(text_matches(templates, texts))
        for first, end, t, found in best_matches(templates, matches)
    ]


def read_templates(folder: str) -> tuple:
    """Templates from plain files on the driver, each called by its license: ``GPL-3.0-only.txt``.

    Several files of a license are told apart by ``~``: ``MIT~header.txt``.
    """
    files = sorted(pathlib.Path(folder).glob("*.txt"))
    return tuple((f.stem.split("~")[0], f.read_text(encoding="utf-8")) for f in files)


def license_notices(docs: DataFrame, templates: tuple = TEMPLATES, threshold: float = THRESHOLD, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, license, containment, start_char, end_char``: every span of license wording.

    The span covers the matched words of the text. Of overlapping matches one stays; a
    license may have many spans in a text. Letters are compared in lower case and
    punctuation is ignored. Null, empty and wordless texts have no match; repeated rows
    are all reported; null ids stay null. ``templates`` is a parameter of bounded size,
    (license, text) pairs, several of a license where it has several notices.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, threshold)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            rows, group, held = [], [], 0
            for i, t in enumerate(texts):
                group.append(i)
                held += len(t) // 6
                if held > TOGETHER or i == len(texts) - 1:
                    for k, name, share, first, end in scan_texts(known, [texts[j] for j in group]):
                        spans = [m.span() for m in WORD.finditer(texts[group[k]].lower())]
                        rows.append((keys[group[k]], name, share, spans[first][0], spans[end - 1][1]))
                    group, held = [], 0
            types = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, types)], NAMES)

    NAMES = ["doc_id", "license", "containment", "start_char", "end_char"]
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(scan, "doc_id bigint, license string, containment double, start_char bigint, end_char bigint")
