"""Fill-in-middle: texts cut at two unit ranks, found by descending an indexable skip list.

A unit is a run of A-Z and a-z, or one code point that is no such letter. The units of a text are
the nodes of a skip list held as flat arrays: a node's height is geometric in a hash of its place,
lane k links the nodes of height k or more, and each link carries its width twice, in units and in
code points. A search for a unit rank starts on the highest lane and takes links while their unit
widths fit; the code points it has passed then are the place of the cut. No prefix sums over the
text are kept, only link widths: all lanes together hold about 1 / (1 - ``RISE``) widths a unit.

Ranks and form come from SHA-256 of ``<seed>:<doc_id>``, so a repeated or lost task gives the same
output. Work is per row: no shuffle, and a task holds a slice of texts or one longer text. The text
is rebuilt from output and form alone by :func:`restore`, with DataFrame functions.

A null text is an empty one, and plain. A null id hashes as ``<seed>:``. Texts that hold a marker
are plain. Rows that repeat an id are cut alike, at ranks of their own text. Very long texts are cut
whole. Extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mix, pick, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RISE = 0.25
LANES = 16
PLAIN_FROM, SPM_BELOW = 90, 20
SHAPE = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def heights(n: int) -> np.ndarray:
    """Height of each node, 0 or more: every further lane keeps ``RISE`` of the nodes."""
    draw = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    unit = (draw >> np.uint64(11)).astype(np.float64) / 2.0**53
    return np.minimum(np.floor(np.log(np.maximum(unit, 2.0**-53)) / np.log(RISE)), LANES - 1).astype(np.int64)


class SkipList:
    """Lanes from the lowest up. Link ``j`` of a lane leads from its node ``j`` to node ``j + 1``.

    Node 0 stands on every lane, as the head. ``below[k][j]`` is the place of lane k's node ``j`` on lane k - 1.
    """

    def __init__(self, chars: np.ndarray):
        """``chars``: code points of each unit, in order."""
        self.n = len(chars)
        self.units = [np.ones(self.n, np.int64)]
        self.chars = [chars.astype(np.int64)]
        self.below: list[np.ndarray] = [np.zeros(0, np.int64)]
        height = heights(self.n)
        for lane in range(1, LANES):
            if len(height) <= 1:
                break
            stays = height >= lane
            stays[0] = True
            at = np.flatnonzero(stays)
            if len(at) == len(height):
                continue
            # the width of a link is that of the links it passes over
            self.units.append(np.add.reduceat(self.units[-1], at))
            self.chars.append(np.add.reduceat(self.chars[-1], at))
            self.below.append(at)
            height = height[at]

    def chars_before(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        if not 0 <= rank <= self.n:
            raise IndexError(rank)
        passed, units, node = 0, 0, 0
        for lane in range(len(self.units) - 1, -1, -1):
            wide, long = self.units[lane], self.chars[lane]
            while node < len(wide) and units + wide[node] <= rank:
                units += int(wide[node])
                passed += int(long[node])
                node += 1
            if units == rank:
                break
            # rank lies inside the link from ``node``: go on from the same node one lane down
            node = int(self.below[lane][node]) if lane else node
        return passed


def unit_chars(text: str) -> np.ndarray:
    """Code points of each unit of a text."""
    if not text:
        return np.zeros(0, np.int64)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    letter = ((points | 32) >= 97) & ((points | 32) <= 122) & (points < 128)
    start = np.concatenate([[True], ~(letter[1:] & letter[:-1])])
    return np.diff(np.append(np.flatnonzero(start), len(points)))


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """The first four 8-digit groups of the hash."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[8 * i : 8 * i + 8], 16) for i in range(4))


def transform_text(doc_id: int | None, text: str, seed: int) -> tuple:
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    chars = unit_chars(text)
    h1, h2, h3, h4 = draws(seed, doc_id)
    if not text or h3 % 100 >= PLAIN_FROM or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return len(chars), "plain", None, None, text
    lanes = SkipList(chars)
    first, last = sorted((h1 % (lanes.n + 1), h2 % (lanes.n + 1)))
    a, b = lanes.chars_before(first), lanes.chars_before(last)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SPM_BELOW:
        return lanes.n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return lanes.n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, seed: int = 1) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)`` for every row."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])
        for batch in batches:
            for piece in slices(batch):
                rows = [(i, *transform_text(i, t or "", seed)) for i, t in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), shape, strict=True)], schema=shape)

    return pick(docs, doc_id="doc_id", text="text").mapInArrow(task, SHAPE)


def restore(transformed: DataFrame, output: str = "output", form: str = "form", name: str = "restored") -> DataFrame:
    """Adds the text rebuilt from output and form.

    Parts hold no marker, and no marker's end is another's start, so the first suffix or prefix
    marker and the last middle marker are the true ones.
    """
    text, mark = F.col(output), len(PREFIX)

    def parts(inner: str):
        """What stands between the first marker and ``inner``, between ``inner`` and the middle marker, and after it."""
        head = F.substring_index(text, inner, 1)
        middle = F.substring_index(text, MIDDLE, -1)
        between = F.length(text) - F.length(head) - F.length(middle) - F.lit(2 * mark)
        return F.substr(head, F.lit(mark + 1)), F.substr(text, F.length(head) + F.lit(mark + 1), between), middle

    prefix, suffix, middle = parts(SUFFIX)
    suffix_first, prefix_last, middle_last = parts(PREFIX)
    psm = F.concat(prefix, middle, suffix)
    spm = F.concat(prefix_last, middle_last, suffix_first)
    return transformed.withColumn(name, F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(text))

