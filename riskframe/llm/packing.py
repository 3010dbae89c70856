"""Packing token pieces into sequences by linear grouping (Fernandez de la Vega and Lueker, 1981).

Lengths are whole numbers up to the capacity, so the plan only needs the histogram of lengths: at most
``capacity`` rows, whatever the number of documents. On the histogram

1. lengths above ``small`` are sorted and cut into groups of equal cardinality; each is rounded up to the
   largest of its group, which leaves few sizes,
2. the few sizes are packed by configurations (multisets of sizes that fit) found by column generation:
   the linear relaxation is solved, rounded down, and the remainder packed by first fit,
3. actual lengths take the place of rounded ones, which leaves room,
4. small lengths, and what is left over, go by best fit into the room.

The plan is a list of bins with multiplicities. Documents meet it by their rank among pieces of equal length,
which a two-level count gives without a global sort.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import Batches, arrow_type, batch, stage

CAPACITY = 1024
END = 2
#: White space of the tokenizer's pattern (Unicode White_Space).
SPACE = " \t\n\r\x0b\x0c\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes, equal to the tokenizer's own.

    The pattern never crosses from a word into the next blank, so a blank and the word after it have ids of
    their own and are looked up in a cache. New words of plain letters are merged by ``merges``, the same
    vocabulary as ranks, which starts faster; all others by ``tokenizer``. The cache is emptied when full,
    which costs time only.
    """

    def __init__(self, tokenizer: str, merges: str | None = None, cache: int = 600_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(tokenizer), cache
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = _Known(self.chunk)
        self.chunks = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
        self.plain = re.compile(" ?[\x21-\x7e\nÀ-ÖØ-öø-ÿ]*").fullmatch
        self.ranks = None
        if merges:
            import public_tokenizers
            import tiktoken

            with open(merges, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            merged = tiktoken.Encoding("merges", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.ranks = merged.encode_ordinary

    def _own(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def chunk(self, text: str) -> bytes:
        """Ids of a stretch that the pattern never leaves."""
        if self.ranks and self.plain(text):
            return array("I", self.ranks(text)).tobytes()
        return self._own(text)

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self._own(text)
        if len(self.known) > self.limit:
            self.known.clear()
        first, blank, rest = text.partition(" ")
        try:
            head = self.chunk(first) if first else b""
            if blank:
                if first[-1:].isspace():
                    raise _UnevenSpaceError
                return head + b"".join(map(self.known.__getitem__, rest.split(" ")))
            return head
        except _UnevenSpaceError:
            return b"".join(map(self.chunk, self.chunks.findall(text)))


class _UnevenSpaceError(Exception):
    """Blanks beside other white space: a plain split does not follow the pattern."""


class _Known(dict):
    """Ids of a blank and the word after it."""

    def __init__(self, chunk) -> None:
        self.chunk = chunk

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise _UnevenSpaceError
        self[word] = ids = self.chunk(" " + word)
        return ids


def default_files() -> dict[str, str]:
    import public_tokenizers

    return {"tokenizer": public_tokenizers.path("byte_bpe_50k.json"), "merges": public_tokenizers.path("byte_bpe_50k.tiktoken")}


def pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END, with_ids: bool = True, files: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): token pieces of at most ``capacity`` ids.

    A document is its ids and ``end_id``. A longer one is cut so that all pieces but the first are full. A null
    text is empty and has one piece of one id; every row is a document, repeated rows and null ids included.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    last = np.array([end_id], "<u4").tobytes()

    def run(batches: Batches) -> Batches:
        encoder, out = Encoder(**(files or default_files())), arrow_type(schema)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                rows = []
                for key, text in zip(b.column(0)[at : at + 512].to_pylist(), b.column(1)[at : at + 512].to_pylist(), strict=True):
                    ids = encoder.encode(text) + last
                    start, size = 0, (len(ids) // 4 - 1) % capacity + 1
                    for piece in range(-(-len(ids) // (4 * capacity))):
                        part = ids[4 * start : 4 * (start + size)]
                        row = (key, piece, start, size, zlib.crc32(part))
                        rows.append((*row, np.frombuffer(part, "<i4")) if with_ids else row)
                        start, size = start + size, capacity
                yield batch(out, zip(*rows, strict=True))

    return narrow.mapInArrow(run, schema)


def _best_fit(room: dict[int, Counter], counts: Counter, capacity: int) -> None:
    """Lengths, largest first, into the fullest bins they fit; ``room`` maps free space to bins and their numbers."""
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            free = min((f for f, bins in room.items() if f >= length and bins), default=None)
            if free is None:
                each = capacity // length
                full, rest = divmod(left, each)
                if full:
                    room[capacity - each * length][(length,) * each] += full
                if rest:
                    room[capacity - rest * length][(length,) * rest] += 1
                break
            content, n = next(iter(room[free].items()))
            each = min(free // length, left)
            used = min(n, left // each)
            room[free][content] -= used
            if not room[free][content]:
                del room[free][content]
            room[free - each * length][content + (length,) * each] += used
            left -= used * each


def _simplex(columns: list[np.ndarray], demand: np.ndarray, capacity: int, sizes: np.ndarray, rounds: int = 400) -> tuple[np.ndarray, list[np.ndarray]]:
    """Configurations and how often to use each: column generation on a basis, priced by an integer knapsack."""
    basis = [c.astype(float) for c in columns]
    matrix = np.array(basis).T
    use = np.linalg.solve(matrix, demand)
    for _ in range(rounds):
        price = np.linalg.solve(matrix.T, np.ones(len(basis)))
        value, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for k, size in enumerate(sizes.tolist()):
            if price[k] <= 0:
                continue
            for c in range(size, capacity + 1):
                gain = value[c - size] + price[k]
                if gain > value[c] + 1e-12:
                    value[c], choice[c] = gain, k
        if value[capacity] <= 1 + 1e-7:
            break
        column, c = np.zeros(len(sizes)), capacity
        while c > 0:
            if choice[c] < 0:
                c -= 1
                continue
            column[choice[c]] += 1
            c -= int(sizes[choice[c]])
        step = np.linalg.solve(matrix, column)
        ratio = np.where(step > 1e-9, use / np.where(step > 1e-9, step, 1), np.inf)
        leave = int(np.argmin(ratio))
        if not np.isfinite(ratio[leave]):
            break
        use = np.maximum(use - ratio[leave] * step, 0)
        use[leave] = ratio[leave]
        matrix[:, leave] = column
    return use, list(matrix.T)


def plan(histogram: dict[int, int], *, capacity: int = CAPACITY, small: int | None = None, groups: int = 200) -> list[tuple[tuple[int, ...], int]]:
    """Bins as (lengths, how many such bins) for a histogram of lengths."""
    small = capacity // 3 if small is None else small
    counts = Counter({k: v for k, v in histogram.items() if v})
    room: dict[int, Counter] = defaultdict(Counter)
    if full := counts.pop(capacity, 0):
        room[0][(capacity,)] = full
    large = sorted((k for k in counts if k > small), reverse=True)
    total = sum(counts[k] for k in large)
    if total:
        # Groups of equal cardinality, largest first; a length may lie in two groups.
        border, members, done = -(-total // groups), [], 0
        for k in large:
            left = counts[k]
            while left:
                g, at = divmod(done, border)
                if g == len(members):
                    members.append([k, []])
                take = min(left, border - at)
                members[g][1].append([k, take])
                done, left = done + take, left - take
        merged: dict[int, list[list[int]]] = defaultdict(list)
        for size, items in members:
            merged[size].extend(items)
        sizes = np.array(sorted(merged, reverse=True))
        demand = np.array([sum(n for _, n in merged[s]) for s in sizes.tolist()], float)
        start = [np.eye(len(sizes))[k] * (capacity // s) for k, s in enumerate(sizes.tolist())]
        use, configurations = _simplex(start, demand, capacity, sizes)
        queues = {s: list(reversed(merged[s])) for s in sizes.tolist()}
        for often, config in sorted(zip(np.floor(use + 1e-7).astype(int).tolist(), configurations, strict=True), key=lambda x: -x[0]):
            slots = [s for s, n in zip(sizes.tolist(), config.astype(int).tolist(), strict=True) for _ in range(n)]
            while often > 0:
                # As many equal bins as the next actual lengths of every slot allow.
                content, need = [], Counter()
                for s in slots:
                    queue = queues[s]
                    at, skip = len(queue) - 1, need[s]
                    while at >= 0 and skip >= queue[at][1]:
                        skip -= queue[at][1]
                        at -= 1
                    if at < 0:
                        continue
                    content.append((s, queue[at][0]))
                    need[s] += 1
                if not content:
                    break
                same, often_now = Counter(content), often
                for (s, k), n in same.items():
                    there = next(q[1] for q in reversed(queues[s]) if q[0] == k)
                    often_now = min(often_now, max(1, there // n))
                lengths = tuple(sorted((k for _, k in content), reverse=True))
                room[capacity - sum(lengths)][lengths] += often_now
                for (s, k), n in same.items():
                    left = n * often_now
                    queue = queues[s]
                    for at in range(len(queue) - 1, -1, -1):
                        if queue[at][0] == k and left:
                            took = min(left, queue[at][1])
                            queue[at][1] -= took
                            left -= took
                    queues[s] = [q for q in queue if q[1]]
                often -= often_now
        rest = Counter()
        for queue in queues.values():
            for k, n in queue:
                rest[k] += n
        _best_fit(room, rest, capacity)
    _best_fit(room, Counter({k: v for k, v in counts.items() if k <= small}), capacity)
    return [(content, n) for free in sorted(room) for content, n in sorted(room[free].items()) if n]


def placements(bins: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first ranks, first sequence ids and offsets of the stretches of ranks that share a place."""
    taken: Counter = Counter()
    rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for content, n in bins:
        offset = 0
        for length in content:
            rows[length].append((taken[length], sequence, offset))
            taken[length] += n
            offset += length
        sequence += n
    return {k: tuple(np.array(c, np.int64) for c in zip(*v, strict=True)) for k, v in rows.items()}


def pack(found: DataFrame, *, capacity: int = CAPACITY, buckets: int = 256) -> DataFrame:
    """The rows of ``found`` (doc_id, piece, length, ...) with ``sequence_id`` and ``offset``.

    ``found`` is read twice and should be a stored table. Ranks among equal lengths come from counts per
    (length, bucket) and a numbering inside each; ``buckets`` grows with the input so that the largest
    group fits a task. Equal rows get places of their own. No rows give no rows.
    """
    spread = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int")
    keyed = found.withColumn("_bucket", spread)
    sizes = keyed.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    # At most capacity x buckets rows: bounded by two parameters.
    table = sorted((r["length"], r["_bucket"], r["n"]) for r in sizes.collect())
    histogram, base = Counter(), {}
    for length, bucket, n in table:
        base[length, bucket] = histogram[length]
        histogram[length] += n
    places = placements(plan(dict(histogram), capacity=capacity))
    names = found.columns
    schema = found.select(*names).schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ").replace("bigint", "long")
    out = schema + ", sequence_id long, offset long"
    out = ", ".join(f"{a} {b}" for a, b in (x.split() for x in out.split(", ")))
    length_at, bucket_at = names.index("length"), len(names)

    def run(batches: Batches) -> Batches:
        seen: dict[tuple[int, int], int] = {}
        for b in batches:
            keys = list(zip(b.column(length_at).to_pylist(), b.column(bucket_at).to_pylist(), strict=True))
            ranks = np.zeros(len(keys), np.int64)
            for i, key in enumerate(keys):
                n = seen.get(key, base[key])
                ranks[i], seen[key] = n, n + 1
            lengths = b.column(length_at).to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
            for length in np.unique(lengths).tolist():
                first, bins, offsets = places[length]
                mine = lengths == length
                at = np.searchsorted(first, ranks[mine], "right") - 1
                sequence[mine], offset[mine] = bins[at] + ranks[mine] - first[at], offsets[at]
            yield batch(arrow_type(out), (*(b.column(i) for i in range(len(names))), sequence, offset))

    # A (length, bucket) is numbered in one task, in an order that a repeated task finds again.
    return keyed.repartition("length", "_bucket").sortWithinPartitions("length", "_bucket", "doc_id", "piece").mapInArrow(run, out)


def pack_documents(docs: DataFrame, *, with_ids: bool = True, capacity: int = CAPACITY, buckets: int = 256, **settings) -> DataFrame:
    """Pieces of all documents with their places; see ``pieces`` and ``pack``."""
    return pack(stage(pieces(docs, with_ids=with_ids, capacity=capacity, **settings), "token-pieces"), capacity=capacity, buckets=buckets)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, from pieces with ids."""
    rows = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return rows.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
