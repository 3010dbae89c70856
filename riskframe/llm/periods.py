"""Periodic runs of words, found by internal pattern matching.

A run is a stretch with smallest period q that is at least ``times`` periods (and ``least`` words) long and that no
neighbouring word extends. Let 2^k be the least power of two that is not below q. The run then holds a whole block
of 2^k words at a multiple of 2^k, and next to that block an occurrence of the same words exactly q further right
or left, with none in between: two occurrences closer to each other than the block is long form a progression
whose step divides q, and q is smallest. So for every dyadic block the next occurrence in either neighbouring
window is looked up, and its distance is a candidate period. Candidates are extended to both sides by longest
common extensions and kept if the stretch is long enough.

The occurrences of a block are an interval of the suffix array. A wavelet tree over the suffix array answers the
range successor queries: the least occurrence above, and the greatest below, a place. Names of blocks
(ranks of all substrings of 2^k words) give the suffix array, the intervals and the extensions.

Texts are independent of each other, so Spark deals them out and many short ones share one suffix array; a text
leaves the naming as soon as all its blocks are distinct. A task needs about 4 bytes a level and 80 more for each
word of its longest text, with as many levels as the longest repeat in it has binary digits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import Batches, arrow_type, batch, runs, text_bytes

TIMES, LEAST = 4, 6
#: Words that share a suffix array, unless one text has more.
TOGETHER = 1 << 16


class Names:
    """Ranks of the substrings of 2^k words of several texts laid end to end, for k = 0, 1, ...

    ``words`` holds numbers that tell words of one text apart and differ between texts. A level names only the
    places of texts that still have equal blocks one level below; all other places have names of their own. So do
    blocks that run past their text's end.
    """

    def __init__(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        n = len(words)
        self.starts, self.ends = starts, ends
        self.text = np.repeat(np.arange(len(starts)), ends - starts)
        self.stop = ends[self.text]
        order = np.argsort(words, kind="stable")
        self.levels = [_ranks(words[order], order, n)]
        self.order = order  # places by the names of the last level, equal ones by place
        self.active: list[np.ndarray] = []
        last, size = self.levels[0], 1
        while True:
            repeated = np.zeros(len(starts), bool)
            same = last[self.order[1:]] == last[self.order[:-1]]
            repeated[self.text[self.order[1:][same]]] = True
            at = np.flatnonzero(repeated[self.text])  # places of texts with equal blocks
            self.active.append(at)
            if not len(at):
                break
            following = at + size
            second = np.where(following < self.stop[at], last[np.minimum(following, n - 1)] + 1, 0)
            key = last[at].astype(np.int64) * (n + 1) + second
            by = np.argsort(key, kind="stable")
            # Active texts keep the same places of the order, since names of different texts never mix.
            where = np.sort(self.rank_of(at))
            inner = self.order.copy()
            inner[where] = at[by]
            self.order = inner
            names = np.arange(n, dtype=np.int32)
            sorted_key = key[by]
            new = np.concatenate(([True], sorted_key[1:] != sorted_key[:-1]))
            # A name is the first place its class has in the order: unique over all texts.
            names[self.order] = np.arange(n, dtype=np.int32)
            names[at[by]] = where[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
            self.levels.append(names)
            last, size = names, size * 2
        self.place = self.rank_of(np.arange(n))

    def rank_of(self, at: np.ndarray) -> np.ndarray:
        place = np.empty(len(self.order), np.int64)
        place[self.order] = np.arange(len(self.order))
        return place[at]

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree from ``a`` and ``b`` on (different places of one text)."""
        a, b, start = a.copy(), b.copy(), a
        top = len(self.text)
        for k in reversed(range(len(self.levels))):
            inside = (np.maximum(a, b) < top)
            name = self.levels[k]
            same = inside & (name[np.minimum(a, top - 1)] == name[np.minimum(b, top - 1)])
            a[same] += 1 << k
            b[same] += 1 << k
        return a - start

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree right before ``a`` and ``b``."""
        first = self.starts[self.text[np.minimum(a, b)]]
        a, b, start = a.copy(), b.copy(), a
        for k in reversed(range(len(self.levels))):
            x, y = a - (1 << k), b - (1 << k)
            inside = np.minimum(x, y) >= first
            name = self.levels[k]
            same = inside & (name[np.maximum(x, 0)] == name[np.maximum(y, 0)])
            a[same] -= 1 << k
            b[same] -= 1 << k
        return start - a


def _ranks(ordered: np.ndarray, order: np.ndarray, n: int) -> np.ndarray:
    """Names of places: the first rank of their class."""
    names = np.empty(n, np.int32)
    starts, ends = runs(ordered)
    names[order] = np.repeat(starts, ends - starts)
    return names


class WaveletTree:
    """Bits of a sequence of numbers, level by level; counts and selects by value within an interval.

    Each level keeps 64 bits to a word and the ones before each word: 0.19 bytes a number and level.
    """

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        for level in reversed(range(self.bits)):
            bit = (values >> level & 1).astype(bool)
            packed = np.zeros(len(bit) // 64 + 1, np.uint64)
            raw = np.packbits(bit, bitorder="little")
            packed.view(np.uint8)[: len(raw)] = raw
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)))[:-1].astype(np.int32)
            zeros = int(len(bit) - bit.sum())
            self.levels.append((packed, before, zeros))
            values = np.concatenate((values[~bit], values[bit]))

    @staticmethod
    def _ones(packed: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(packed[word] & mask)

    def below(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of the numbers at [low, high) are less than ``x``."""
        found = np.zeros(len(x), np.int64)
        for k, (packed, before, zeros) in enumerate(self.levels):
            one = (x >> (self.bits - 1 - k) & 1).astype(bool)
            a, b = self._ones(packed, before, low), self._ones(packed, before, high)
            found += np.where(one, (high - b) - (low - a), 0)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return found

    def select(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The number with ``rank`` smaller ones among those at [low, high); ``rank`` must be less than their number."""
        value, rank = np.zeros(len(rank), np.int64), rank.copy()
        for k, (packed, before, zeros) in enumerate(self.levels):
            a, b = self._ones(packed, before, low), self._ones(packed, before, high)
            less = (high - b) - (low - a)
            one = rank >= less
            rank -= np.where(one, less, 0)
            value += np.where(one, 1 << (self.bits - 1 - k), 0)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return value


def _candidates(names: Names, times: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance): dyadic blocks and their next occurrences within a block's length, on either side."""
    asked = []
    for k, at in enumerate(names.active):
        size = 1 << k
        offset = at - names.starts[names.text[at]]
        at = at[(offset & (size - 1) == 0) & (at + size <= names.stop[at])]
        if not len(at):
            continue
        # Names are first places of classes in the order, so a class is an interval of the suffix array.
        name = names.levels[k]
        ordered = name[names.order]
        low = name[at].astype(np.int64)
        ends = np.flatnonzero(np.append(ordered[1:] != ordered[:-1], True)) + 1
        high = ends[np.searchsorted(ends, low, side="right")]
        # A run holds a block of less than two periods at least this often, a single word everywhere.
        often = high - low >= (max(least, times) if k == 0 else times - 2)
        asked.append((at[often], low[often], high[often], np.full(int(often.sum()), size)))
    if not asked or not sum(len(a[0]) for a in asked):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, low, high, size = (np.concatenate(c) for c in zip(*asked, strict=True))
    tree = WaveletTree(names.order)
    smaller = tree.below(low, high, at)
    later, earlier = smaller + 1 < high - low, smaller > 0
    right = tree.select(low[later], high[later], smaller[later] + 1) - at[later]
    left = at[earlier] - tree.select(low[earlier], high[earlier], smaller[earlier] - 1)
    near, far = right <= size[later], left <= size[earlier]
    return np.concatenate((at[later][near], (at[earlier] - left)[far])), np.concatenate((right[near], left[far]))


def find_runs(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, *, times: int = TIMES, least: int = LEAST) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, sorted; places count from the start of their text.

    ``words`` are numbers as for ``Names``. ``times`` must be 4 or more, else a run may lie between the blocks.
    """
    if times < 4:
        raise ValueError("runs of less than four periods can miss all dyadic blocks")
    if not len(words):
        return np.zeros((0, 4), np.int64)
    names = Names(words, starts, ends)
    at, period = _candidates(names, times, least)
    if not len(at):
        return np.zeros((0, 4), np.int64)
    key = np.unique(at * np.int64(len(words) + 1) + period)
    at, period = key // (len(words) + 1), key % (len(words) + 1)
    right = names.forward(at, at + period)
    long = (right + period + at - starts[names.text[at]] >= np.maximum(least, times * period))
    at, period, right = at[long], period[long], right[long]
    left = names.backward(at, at + period)
    start, end = at - left, at + period + right
    kept = end - start >= np.maximum(least, times * period)
    start, end, period = start[kept], end[kept], period[kept]
    # Multiples of the smallest period give the same stretch.
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    text = names.text[start] if len(start) else start
    return np.stack((text, start - starts[text], end - start, period), axis=1)


def collapsed(parts: list[bytes], found: np.ndarray) -> bytes:
    """The words outside all runs and in their first periods, joined by one space."""
    if not len(found):
        return b" ".join(parts)
    edge = np.zeros(len(parts) + 1, np.int64)
    np.add.at(edge, found[:, 1] + found[:, 3], 1)
    np.add.at(edge, found[:, 1] + found[:, 2], -1)
    dropped = np.cumsum(edge[:-1]) > 0
    return b" ".join([w for w, d in zip(parts, dropped.tolist(), strict=True) if not d])


_FOUND = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"

Edit = Callable[[int | None, list[bytes]], list[bytes]]


def _texts(batches: Batches, edit: Edit | None) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Texts as words, in groups of about ``TOGETHER`` words."""
    group, size = [], 0
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            for key, text in zip(part.column(0).to_pylist(), text_bytes(part.column(1)), strict=True):
                words = (text or b"").split()
                if edit:
                    words = edit(key, words)
                group.append((key, words))
                size += len(words)
                if size >= TOGETHER or len(group) >= 4096:
                    yield group
                    group, size = [], 0
    if group:
        yield group


class _Numbers(dict):
    """Words in the order in which they come up."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def group_runs(texts: list[list[bytes]], *, times: int = TIMES, least: int = LEAST) -> list[np.ndarray]:
    """Rows (text, start, length, period) for each of the texts."""
    ends = np.cumsum([len(t) for t in texts])
    numbers = _Numbers()
    ids = np.fromiter(map(numbers.__getitem__, chain.from_iterable(texts)), np.int64, int(ends[-1]))
    starts = np.concatenate(([0], ends[:-1]))
    ids += np.repeat(np.arange(len(texts)), ends - starts) * len(numbers)
    found = find_runs(ids, starts, ends, times=times, least=least)
    cuts = np.searchsorted(found[:, 0], np.arange(len(texts) + 1))
    return [found[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def summaries(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", times: int = TIMES, least: int = LEAST, edit: Edit | None = None) -> DataFrame:
    """One row for each row of ``docs``: its number of runs, its longest run, and digests of all runs and of what is left.

    Among runs of equal length the first counts, then the smallest period; without a run four columns are null. A
    null text has no words; ids may be null or repeat, and stay as they are. ``edit`` changes the words of a row
    (id, words) before. Words are split at ASCII white space.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Batches) -> Batches:
        for group in _texts(batches, edit):
            rows = []
            for (key, words), found in zip(group, group_runs([w for _, w in group], times=times, least=least), strict=True):
                longest = (None,) * 4
                if len(found):
                    _, start, length, period = min(found.tolist(), key=lambda r: (-r[2], r[1], r[3]))
                    longest = (start, length, period, 1000 * length // period)
                listed = "".join(f"{s},{n},{p}\n" for _, s, n, p in sorted(found.tolist(), key=lambda r: (r[1], r[3])))
                digests = (hashlib.sha256(x).hexdigest() for x in (listed.encode(), collapsed(words, found)))
                rows.append((key, len(found), *longest, *digests))
            yield batch(arrow_type(_FOUND), zip(*rows, strict=True))

    return narrow.mapInArrow(run, _FOUND)


def collapse(docs: DataFrame, *, text_col: str = "text", times: int = TIMES, least: int = LEAST) -> DataFrame:
    """``docs`` with each run of a text cut down to its first period; texts without a run stay as they are."""
    at = docs.columns.index(text_col)

    def run(batches: Batches) -> Batches:
        for b in batches:
            columns = list(b.columns)
            texts = text_bytes(columns[at])
            out, place = [], 0
            for group in _texts(iter([pa.RecordBatch.from_arrays([pa.nulls(b.num_rows, pa.int64()), columns[at]], names=["i", "t"])]), None):
                for (_, words), found in zip(group, group_runs([w for _, w in group], times=times, least=least), strict=True):
                    out.append(collapsed(words, found) if len(found) else texts[place])
                    place += 1
            columns[at] = pa.array(out, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return docs.mapInArrow(run, docs.schema)
