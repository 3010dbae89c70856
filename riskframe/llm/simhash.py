"""SimHash near-duplicates found with pigeonring filtering.

A fingerprint is cut into ``segments`` pieces that form a ring. If two fingerprints differ in at most
``max_diff`` bits, then from some segment on, every chain of l consecutive segments differs in at most
l * max_diff / segments bits (Qin and Xiao, "Pigeonring", 2018). The first segments of such a chain
have a budget below one bit, hence are equal: they are the key that brings fingerprints together. The
longer prefixes of the chain prune pairs before all bits are compared.

Only distinct fingerprints are compared, so copies cost nothing. A bucket of more than ``TILE``
fingerprints is compared tile against tile, each pair of tiles in a group of its own: no group is
unbounded and no pair is lost. A group returns a spanning forest of its links, never all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import Batches, arrow_type, batch, mix64, runs, sorted_groups, stage, text_bytes
from riskframe.operators.graph import connected_components
from riskframe.operators.skew import splittable

TILE = 4096
MIX = 0x9E3779B97F4A7C15


def shingle_hashes(text: bytes | None, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every run of ``words`` words of the text, A-Z in lower case, joined by single spaces."""
    parts = text.lower().split() if text else []  # on bytes: ASCII letters and ASCII white space only
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[: -words] + 1)).tolist()
    digest = xxhash.xxh64_digest
    hashed = b"".join([digest(joined[a:b], seed) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)])
    return np.frombuffer(hashed, ">u8").astype(np.uint64)


def fingerprint(hashes: np.ndarray, bits: int = 64) -> bytes:
    """Majority of every bit, most significant byte first; more than 64 bits come from scrambled hashes."""
    if not len(hashes):
        return bytes(bits // 8)
    words = []
    for k in range(bits // 64):
        h = hashes if k == 0 else mix64(hashes + np.uint64(MIX * k % 2**64))
        ones = np.zeros(64, np.int64)
        for at in range(0, len(h), 8192):
            part = h[at : at + 8192].astype(">u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
        words.append(np.packbits(2 * ones > len(h)).tobytes())
    return b"".join(words)


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3, bits: int = 64, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint) with the fingerprint as lower-case hex; null and wordless texts have fingerprint zero.

    One row for each row of ``docs``; only the two named columns are read, so others may clash freely.
    """
    schema = arrow_type("doc_id long, fingerprint string")

    def run(batches: Batches) -> Batches:
        for b in batches:
            prints = [fingerprint(shingle_hashes(t, words, seed), bits).hex() for t in text_bytes(b.column(1))]
            yield batch(schema, (b.column(0), prints))

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, fingerprint string")


class Ring:
    """Cuts of a fingerprint of ``bits`` bits into ``segments``, and the budgets of chains."""

    def __init__(self, bits: int, max_diff: int, segments: int) -> None:
        self.bits, self.max_diff, self.segments = bits, max_diff, segments
        self.cuts = [round(i * bits / segments) for i in range(segments + 1)]
        # Chains of so many segments have a budget below one bit.
        self.lead = segments if not max_diff else -(-segments // max_diff) - 1
        if self.lead < 1:
            raise ValueError("more segments than differing bits are needed")

    def turned(self, prints: np.ndarray, start: int) -> np.ndarray:
        """The first 64 bits of the ring from segment ``start`` on; ``prints``: n x (bits / 64) big words."""
        n = self.bits // 64
        word, shift = divmod(self.cuts[start], 64)
        high = prints[:, word] << np.uint64(shift)
        return high if not shift else high | (prints[:, (word + 1) % n] >> np.uint64(64 - shift))

    def length(self, start: int, count: int) -> int:
        """Bits of ``count`` segments from ``start`` on."""
        end = start + count
        return self.cuts[end] - self.cuts[start] if end <= self.segments else self.bits - self.cuts[start] + self.cuts[end - self.segments]

    def prefixes(self, start: int) -> list[tuple[np.uint64, int]]:
        """Masks and budgets of the chains from ``start`` that lie in the first 64 bits."""
        found = []
        for count in range(self.lead + 1, self.segments + 1):
            size = self.length(start, count)
            if size > 64:
                break
            found.append((np.uint64((2**64 - 1) ^ (2 ** (64 - size) - 1)), count * self.max_diff // self.segments))
        return found

    def keys(self, prints: np.ndarray, start: int) -> np.ndarray:
        """The leading chain from ``start``, with the segment's number, as one integer."""
        size = min(56, self.length(start, self.lead))
        lead = self.turned(prints, start) >> np.uint64(64 - size)
        return (lead | np.uint64(start) << np.uint64(56)).view(np.int64)


def _words(column: pa.Array, bits: int) -> np.ndarray:
    raw = b"".join(bytes.fromhex(x) for x in column.to_pylist())
    return np.frombuffer(raw, ">u8").reshape(-1, bits // 64).astype(np.uint64)


def _forest(prints: np.ndarray, start: int, ring: Ring) -> Iterator[tuple[int, int]]:
    """Links (by position) that connect what is within ``max_diff`` bits, at most one less than there are prints."""
    n = len(prints)
    label, turned, tests = np.arange(n), ring.turned(prints, start), ring.prefixes(start)
    step = max(1, 2_000_000 // n)
    for at in range(0, n - 1, step):
        rows = np.arange(at, min(at + step, n - 1))
        apart = turned[rows, None] ^ turned[None, at + 1 :]
        open_pairs = label[rows, None] != label[None, at + 1 :]
        for mask, budget in tests[:3]:
            open_pairs &= np.bitwise_count(apart & mask) <= budget
        a, b = np.nonzero(open_pairs)
        a, b = a + at, b + at + 1
        keep = b > a
        a, b = a[keep], b[keep]
        for mask, budget in tests[3:]:
            keep = np.bitwise_count((turned[a] ^ turned[b]) & mask) <= budget
            a, b = a[keep], b[keep]
        keep = np.bitwise_count(prints[a] ^ prints[b]).sum(axis=1, dtype=np.int64) <= ring.max_diff
        a, b = a[keep], b[keep]
        while len(a):
            x, y = int(a[0]), int(b[0])
            yield x, y
            label[label == label[y]] = label[x]
            keep = label[a] != label[b]
            a, b = a[keep], b[keep]


def links(prints: DataFrame, *, bits: int = 64, max_diff: int = 2, segments: int = 16, tile: int = TILE) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``fingerprint``, hex) at most ``max_diff`` bits apart.

    Whatever is connected by links of that length is connected by the rows returned; every row is such a link.
    """
    ring = Ring(bits, max_diff, segments)
    schema = arrow_type("key long, fingerprint string")

    def keyed(batches: Batches) -> Batches:
        for b in batches:
            if b.num_rows:
                words = _words(b.column(0), bits)
                for start in range(segments):
                    yield batch(schema, (ring.keys(words, start), b.column(0)))

    keys = prints.select("fingerprint").distinct().mapInArrow(keyed, "key long, fingerprint string")
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # A bucket of several tiles makes a group of each pair of tiles; a single tile is one group.
    shared = keys.join(splittable(sizes), "key").withColumn("tiles", F.ceil(F.col("n") / tile).cast("int"))
    mine = F.pmod(F.xxhash64("fingerprint"), F.col("tiles")).cast("int")
    units = shared.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    units = units.select(
        F.when(F.col("tiles") == 1, F.col("key"))
        .otherwise(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")))
        .alias("unit"),
        F.shiftrightunsigned("key", 56).cast("int").alias("start"),
        "fingerprint",
    )

    def compare(tables: Iterator[pa.Table]) -> Batches:
        out = arrow_type("a string, b string")
        for t in tables:
            names = t.column("fingerprint").combine_chunks()
            starts, ends = runs(t.column("unit").to_numpy())
            many = ends - starts > 1
            words, first = _words(names, bits), t.column("start").to_numpy()
            found = [(x + s, y + s) for s, e in zip(starts[many].tolist(), ends[many].tolist(), strict=True) for x, y in _forest(words[s:e], int(first[s]), ring)]
            if found:
                a, b = zip(*found, strict=True)
                yield batch(out, (names.take(pa.array(a)), names.take(pa.array(b))))

    return sorted_groups(units, "unit", compare, "a string, b string").distinct()


def components(prints: DataFrame, **ring) -> DataFrame:
    """(doc_id, fingerprint, component_id) for rows (doc_id, fingerprint).

    ``component_id`` is the smallest doc_id that links reach, the row's own included. A null doc_id
    takes part and gets its component's smallest; it is null where the component has no other id.
    """
    prints = stage(prints, "prints")
    edges = stage(links(prints, **ring), "links")
    labels = connected_components(edges).withColumnsRenamed({"node": "fingerprint", "component": "root"})
    own = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    own = stage(own.join(labels, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint")), "roots")
    least = own.groupBy("root").agg(F.min("least").alias("component_id"))
    named = own.join(splittable(least), "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3, bits: int = 64, max_diff: int = 2, segments: int = 16, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row for each row of ``docs``.

    Null and empty texts share fingerprint zero and are linked like any other; repeated rows stay
    repeated; an empty table gives an empty result.
    """
    prints = fingerprints(docs, id_col=id_col, text_col=text_col, words=words, bits=bits, seed=seed)
    return components(prints, bits=bits, max_diff=max_diff, segments=segments)


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with one row of each group of near copies, by exact similarity: see ``near.keep_one``."""
    from riskframe.llm import near  # which searches with ``fingerprint`` and ``links``

    return near.keep_one(docs, **settings)
