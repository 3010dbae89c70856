"""Duplicate spans by relative Lempel-Ziv parsing of texts against indexed reference blocks.

Every window of ``window`` words has one anchor: its least hashed run of ``ANCHOR`` words. Consecutive
windows with the same anchor form a *piece*, so a text is a chain of overlapping pieces, and equal windows
lie in pieces with equal anchors. An anchor that occurs once in the corpus settles all windows of its piece;
where all pieces of an anchor are equal, they are duplicates as they stand. Only the other pieces are parsed:
the distinct ones, dealt by anchor, form reference blocks. Each block is indexed with a suffix order, each of
its pieces is factored greedily against the rest of the block, factors of ``window`` words or more become
spans, and windows that cross one factor boundary are looked up on their own.

An anchor with more than ``BLOCK`` distinct pieces would make an unbounded block. Its windows are counted one
by one instead, by their hash, with combining before the shuffle; the outcome is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import Batches, arrow_type, batch, fresh, mix64, runs, sorted_groups, stage, text_bytes
from riskframe.llm.membership import bloom, may_hold, split
from riskframe.operators.skew import splittable

WINDOW = 35
ANCHOR = 12
BLOCK = 20_000

_BASE = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words; forgets all when large, which costs time only."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word, 7)
        return value


def rolling(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, by doubling: combine(h(i, a), h(i + a, b)) with odd multipliers."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    power, done, out, offset = words, 1, None, 0
    need = size
    while need:
        if need & 1:
            if out is None:
                out = power
            else:
                n = len(words) - (offset + done) + 1
                out = out[:n] * _BASE + mix64(power[offset : offset + n])
            offset += done
        need >>= 1
        if need:
            n = len(power) - done
            if n > 0:
                power = power[:n] * _BASE + mix64(power[done : done + n])
            done *= 2
    return out[: len(words) - size + 1]


def anchors(words: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(hash, first window, number of windows) of the pieces of one text."""
    if len(words) < window:
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 2
    value = mix64(rolling(words, anchor))
    n, width = len(words) - window + 1, window - anchor + 1
    # Leftmost minimum over `width` values by doubling.
    at, reach = np.arange(len(value)), 1
    while 2 * reach <= width:
        left, right = at[: len(at) - reach], at[reach:]
        at = np.where(value[left] <= value[right], left, right)
        reach *= 2
    left, right = at[:n], at[width - reach : width - reach + n]
    at = np.where(value[left] <= value[right], left, right)
    starts, ends = runs(at)
    return value[at[starts]], starts, ends - starts


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


class Block:
    """Suffix order over pieces laid end to end; gives the longest factor at any place that also starts elsewhere.

    Factors do not run past the end of their piece and are measured up to ``depth`` words, a power of two or not.
    """

    def __init__(self, pieces: list[np.ndarray], copies: np.ndarray) -> None:
        lengths = np.array([len(p) for p in pieces])
        self.starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
        total = int((lengths + 1).sum())
        text = np.zeros(total, np.int64)
        _, ids = np.unique(np.concatenate(pieces), return_inverse=True)
        inside = np.ones(total, bool)
        ends = self.starts + lengths
        inside[ends] = False
        text[inside] = ids
        text[ends] = ids.max() + 1 + np.arange(len(pieces))  # separators differ: no factor crosses them
        # Ranks of runs of 1, 2, 4, ... words; runs past the end are cut.
        ranks, size = [text], 1
        longest = int(lengths.max())
        while 2 * size <= longest:
            last = ranks[-1]
            nxt = np.full(total, -1, np.int64)
            nxt[: total - size] = last[size:]
            _, rank = np.unique(last * np.int64(total + 2) + nxt + 1, return_inverse=True)
            ranks.append(rank)
            size *= 2
        order = np.lexsort(tuple(self._tail(ranks, size)))
        common = np.zeros(total + 1, np.int64)  # words shared with the neighbour above in the order
        a, b, shared = order[:-1].copy(), order[1:].copy(), np.zeros(total - 1, np.int64)
        for rank, step in [(ranks[-1], size)] + [(r, 1 << k) for k, r in reversed(list(enumerate(ranks)))]:
            fits = (a < total) & (b < total)
            same = np.zeros(len(a), bool)
            same[fits] = rank[a[fits]] == rank[b[fits]]
            a[same] += step
            b[same] += step
            shared[same] += step
        common[1:total] = shared
        best = np.maximum(common[:-1], common[1:])
        self.longest = np.zeros(total, np.int64)
        self.longest[order] = best
        for s, n, c in zip(self.starts.tolist(), lengths.tolist(), copies.tolist(), strict=True):
            if c > 1:  # the other copy holds every factor
                self.longest[s : s + n] = np.arange(n, 0, -1)

    @staticmethod
    def _tail(ranks: list[np.ndarray], size: int) -> list[np.ndarray]:
        """Sort keys, least significant first: two runs of ``size`` words cover the longest piece."""
        last = ranks[-1]
        second = np.full(len(last), -1, np.int64)
        second[: max(0, len(last) - size)] = last[size:]
        return [second, last]

    def factor(self, piece: int, length: int, window: int) -> np.ndarray:
        """Marks of the piece's windows that also start elsewhere in the block."""
        base, n = int(self.starts[piece]), length - window + 1
        marks = np.zeros(n, bool)
        longest = self.longest[base : base + length]
        at, before = 0, 0
        while at < length:
            size = max(1, int(longest[at]))
            if size >= window:  # the windows inside a long factor
                marks[at : at + size - window + 1] = True
            if at and before + size >= window:
                # A window over this boundary ends inside this factor, else it would hold a factor and
                # the word after it, which occur nowhere together.
                first = max(at - before, at - window + 1, 0)
                last = min(at, n, at + size - window + 1)
                if first < last:
                    marks[first:last] |= longest[first:last] >= window
            at, before = at + size, size
        return marks


def pieces(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(doc, anchor, piece, first, windows): anchors and content hashes of all pieces of rows (doc, text)."""
    schema = arrow_type("doc long, anchor long, piece long, first int, windows int")

    def run(batches: Batches) -> Batches:
        hashes = WordHashes()
        for b in batches:
            got: list[tuple[np.ndarray, ...]] = []
            for key, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1)), strict=True):
                parts = (text or b"").split()
                if len(parts) < window:
                    continue
                words = np.fromiter(map(hashes.__getitem__, parts), np.uint64, len(parts))
                value, first, count = anchors(words, window, anchor)
                ends = first + count + window - 1
                got.append((np.full(len(value), key), _signed(value), _signed(_span_hash(words, first, ends)), first, count))
            if got:
                yield batch(schema, [np.concatenate(c) for c in zip(*got, strict=True)])

    return docs.select("doc", "text").mapInArrow(run, "doc long, anchor long, piece long, first int, windows int")


def _span_hash(words: np.ndarray, first: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of words: position-free polynomial sums, scrambled with the length."""
    power = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(len(words), _BASE, np.uint64))))
    inverse = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(len(words), _INVERSE, np.uint64))))
    sums = np.concatenate((np.zeros(1, np.uint64), np.add.accumulate(mix64(words) * power[:-1])))
    return mix64((sums[ends] - sums[first]) * inverse[first] + (ends - first).astype(np.uint64))


_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def row_key(id_col: str, text_col: str) -> Column:
    """Tells rows apart by content; equal rows have equal spans and count as often as they occur."""
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR, block: int = BLOCK) -> DataFrame:
    """(doc, marks): for each content of a row (``row_key``) the first words of its windows that also start elsewhere.

    Contents without repeated windows have no row. A null text has no words; equal rows are occurrences of their
    own, so a repeated row is repeated throughout. Only the two named columns are read.
    """
    keyed = docs.select(row_key(id_col, text_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    found = stage(pieces(keyed, window, anchor), "pieces")
    # One aggregation tells anchors that occur once, in one content, or in several.
    kinds = found.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), (F.min("piece") != F.max("piece")).alias("mixed")
    )
    shared = found.join(splittable(kinds.filter("n > 1")), "anchor")
    shared = stage(shared.select("doc", "anchor", "piece", "first", "windows", "mixed"), "shared")
    mixed = shared.filter("mixed").groupBy("anchor", "piece").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc", "first", "windows")).alias("at")
    )
    mixed = stage(mixed, "mixed")
    crowded = mixed.groupBy("anchor").agg((F.count(F.lit(1)) > block).alias("crowded"))
    wanted = mixed.join(splittable(crowded), "anchor").select("at.doc", "anchor", "piece", "copies", "at.first", "at.windows", "crowded")
    lists = stage(wanted.groupBy("doc").agg(F.collect_list(F.struct("anchor", "piece", "copies", "first", "windows", "crowded")).alias("wanted")), "wanted")
    # Only texts that may have a wanted piece move, and lie sorted by ``doc`` after the join.
    holders = keyed.filter(may_hold(bloom(lists.select("doc"), lists.count()), F.col("doc")))
    cut = stage(holders.join(lists.hint("merge"), "doc").select("doc", "text", "wanted").mapInArrow(_cut(window), _CUT), "cut")
    parsed = sorted_groups(cut.filter("not crowded").drop("crowded"), "anchor", _parse(window), _MARKS)
    # Crowded anchors: windows by hash, with the copies of their piece; a hash seen twice is a repeat.
    single = cut.filter("crowded").select("anchor", "piece", "copies", F.posexplode(_longs("words")).alias("at", "hash"))
    often = single.groupBy("anchor", "hash").agg(F.sum("copies").alias("n")).filter("n > 1")
    counted = single.join(often, ["anchor", "hash"]).groupBy("anchor", "piece").agg(F.array_sort(F.collect_set("at")).alias("marks"))
    marks = parsed.unionByName(counted.select("anchor", "piece", "marks"))
    # Each piece meets its content's marks, one row for one row; pieces that are duplicates as they stand have none.
    whole = F.sequence(F.lit(0), F.col("windows") - 1)
    found = F.when(F.col("mixed"), F.coalesce("marks", F.array().cast("array<int>"))).otherwise(whole)
    # Equal rows have equal spans: one row for each place of a content.
    placed = shared.dropDuplicates(["doc", "first"])
    spans = placed.join(marks.hint("merge"), ["anchor", "piece"], "left").select("doc", F.transform(found, lambda m: m + F.col("first")).alias("marks"))
    return spans.groupBy("doc").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("marks")))).alias("marks"))


_CUT = "anchor long, piece long, copies long, crowded boolean, words binary"
_MARKS = "anchor long, piece long, marks array<int>"


def _longs(name: str):
    """A binary column of big-endian 64-bit integers as an array of hex strings."""
    text = F.hex(name)
    return F.transform(F.sequence(F.lit(0), F.expr(f"length({name}) div 8 - 1")), lambda i: F.substring(text, i * 16 + 1, F.lit(16)))


def _cut(window: int):
    """Words of the wanted pieces; of crowded anchors the hashes of their windows. Equal rows come together and are cut once."""

    def run(batches: Batches) -> Batches:
        schema, hashes, before = arrow_type(_CUT), WordHashes(), None
        for b in batches:
            rows = []
            for doc, text, wanted in zip(b.column(0).to_pylist(), text_bytes(b.column(1)), b.column(2).to_pylist(), strict=True):
                if doc == before:
                    continue
                before = doc
                parts = text.split()
                words = np.fromiter(map(hashes.__getitem__, parts), np.uint64, len(parts))
                for w in {x["piece"]: x for x in wanted}.values():
                    own = words[w["first"] : w["first"] + w["windows"] + window - 1]
                    kept = rolling(own, window) if w["crowded"] else own
                    rows.append((w["anchor"], w["piece"], w["copies"], w["crowded"], kept.astype(">u8").tobytes()))
            if rows:
                yield batch(schema, zip(*rows, strict=True))

    return run


def _parse(window: int):
    """Each table of whole anchors is a reference block."""

    def run(tables: Iterator[pa.Table]) -> Batches:
        schema = arrow_type(_MARKS)
        for t in tables:
            t = t.combine_chunks()
            # A split join may have cut a content more than once.
            _, first = np.unique(t.column("piece").to_numpy(), return_index=True)
            t = t.take(pa.array(np.sort(first))).combine_chunks()
            words = [np.frombuffer(w, ">u8").astype(np.uint64) for w in t.column("words").to_pylist()]
            index = Block(words, t.column("copies").to_numpy())
            marks = [np.flatnonzero(index.factor(k, len(w), window)).astype(np.int32) for k, w in enumerate(words)]
            yield batch(schema, (t.column("anchor").combine_chunks(), t.column("piece").combine_chunks(), marks))

    return run


def kept_words(text: bytes | None, marks: list[int] | None, window: int) -> tuple[bytes | None, int, int]:
    """(kept text, words, removed words): a text that loses nothing is unchanged, else its kept words are joined."""
    if text is None:
        return None, 0, 0
    parts = text.split()
    if not marks:
        return text, len(parts), 0
    edge = np.zeros(len(parts) + 1, np.int64)
    at = np.asarray(marks)
    edge[at] += 1
    edge[at + window] -= 1
    covered = np.cumsum(edge[:-1]) > 0
    return b" ".join([w for w, c in zip(parts, covered.tolist(), strict=True) if not c]), len(parts), int(covered.sum())


def _by_marks(docs: DataFrame, key: str, spans: DataFrame, marks: str) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` that may have spans, with them or null, and the others, which stay where they are."""
    touched, clear = split(docs, F.col(key), bloom(spans.select("doc"), spans.count()))
    return touched.join(splittable(spans.toDF(key, marks)).hint("merge"), key, "left"), clear


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, **settings) -> DataFrame:
    """(doc_id, n_words, n_removed, kept), one row for each row of ``docs``.

    ``kept`` is the text without the words of repeated windows. Texts of less than ``window`` words lose none;
    null texts stay null with zero words.
    """
    spans = stage(repeated_spans(docs, id_col=id_col, text_col=text_col, window=window, **settings), "spans")
    narrow = docs.select(row_key(id_col, text_col).alias("doc"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found, clear = _by_marks(narrow, "doc", spans, "marks")
    words = F.coalesce(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")
    whole = clear.select("doc_id", words.alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.col("text").alias("kept"))
    schema = "doc_id long, n_words long, n_removed long, kept string"

    def run(batches: Batches) -> Batches:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                rows = [kept_words(t, m, window) for t, m in zip(text_bytes(part.column(1)), part.column(2).to_pylist(), strict=True)]
                kept, words, removed = zip(*rows, strict=True)
                yield batch(arrow_type(schema), (part.column(0), words, removed, kept))

    return found.select("doc_id", "text", "marks").mapInArrow(run, schema).unionByName(whole)


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, **settings) -> DataFrame:
    """``docs`` with the words of repeated windows removed from ``text_col``; all rows and columns stay."""
    spans = stage(repeated_spans(docs, id_col=id_col, text_col=text_col, window=window, **settings), "spans")
    key, marks = (fresh(docs, name) for name in ("doc", "marks"))
    found, clear = _by_marks(docs.withColumn(key, row_key(id_col, text_col)), key, spans, marks)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    at = docs.columns.index(text_col)

    def run(batches: Batches) -> Batches:
        for b in batches:
            *columns, found = b.columns
            rows = zip(text_bytes(columns[at]), found.to_pylist(), strict=True)
            columns[at] = pa.array([kept_words(t, m, window)[0] for t, m in rows], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names[:-1])

    return found.select(*columns, marks).mapInArrow(run, docs.schema).unionByName(clear.select(*columns))
