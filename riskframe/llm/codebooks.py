"""Product codes of vectors, with codebooks trained by member-resident Lloyd rounds.

A vector is cut into ``parts`` equal consecutive parts, and each part position has a codebook. The parts of all
vectors are dealt once by (position, entry, salt) of their nearest entry. From then on they live where they are:
a task that owns members of an entry sums its resident members and hands over one row, the sums become the new
entries, every owner looks for the nearest of them, and only parts whose entry changes enter the next shuffle.
Equal parts that meet in one batch travel as one row with a weight, so a vector that many rows share is few rows.

Codes are then read off the vectors themselves, with the final codebooks (``entries`` x vector length integers, the
only thing that reaches the driver), so no code is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import Batches, arrow_type, batch, mix64, runs, stage
from riskframe.operators.skew import splittable

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components are held within these bounds, where sums of squares stay exact.
LIMIT = 2**27
#: Members of one owner, about.
OWNED = 100_000

_RESIDENT = "position int, entry int, salt int, weight long, part binary"


def integers(vectors: DataFrame, vector_col: str, *keep: Column, scale: int = SCALE) -> DataFrame:
    """(keep, vector) of the rows whose vector has finite components only, as floor(scale * x), held within ``LIMIT``."""
    x = F.col(vector_col).cast("array<double>")
    finite = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(v * scale))).cast("int"))
    return vectors.filter(finite).select(*keep, whole.alias("vector"))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of an array column; shorter vectors end in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy().astype(np.int64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each row's nearest entry, exactly; ties go to the lower index."""
    most = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    if most * most * 4 * x.shape[1] >= 2**53:
        square = np.stack([((x - e) ** 2).sum(axis=1) for e in entries], axis=1)
    else:  # small enough for exact floating point
        a, b = x.astype(float), entries.astype(float)
        square = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)
    index = square.argmin(axis=1)
    return index, square[np.arange(len(x)), index].astype(np.int64)


def _unpack(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, width).astype(np.int64)


def _positions(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(position, rows of the batch)."""
    place = b.column(0).to_numpy()
    order = np.argsort(place, kind="stable")
    for s, e in zip(*(x.tolist() for x in runs(place[order])), strict=True):
        yield int(place[order[s]]), order[s:e]


def _members(rows: DataFrame, books: np.ndarray, salts: int) -> DataFrame:
    """All parts of all vectors, with their first entry; equal parts of one batch as one row."""
    parts, _, width = books.shape

    def run(batches: Batches) -> Batches:
        from pyspark import TaskContext

        out, task = arrow_type(_RESIDENT), TaskContext.get().partitionId()
        for number, b in enumerate(batches):
            if not b.num_rows:
                continue
            x = _matrix(b.column(0), parts * width).reshape(b.num_rows, parts, width)
            for position in range(parts):
                own, weight = np.unique(x[:, position], axis=0, return_counts=True)
                entry, _ = nearest(own, books[position])
                salt = mix64(np.arange(len(own)) + (number << 20) + (task << 40)) % np.uint64(salts)
                yield batch(out, (np.full(len(own), position), entry, salt.astype(np.int64), weight, [r.tobytes() for r in own.astype("<i4")]))

    return rows.select("vector").mapInArrow(run, _RESIDENT)


def _sums(residents: DataFrame, books: np.ndarray) -> np.ndarray:
    """The next codebooks: each owner sums its residents, the sums of an entry's owners meet."""
    parts, entries, width = books.shape
    schema = "position int, entry int, n long, total array<long>"

    def run(batches: Batches) -> Batches:
        total, n = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for b in batches:
            if b.num_rows:
                owner = b.column(0).to_numpy() * entries + b.column(1).to_numpy()
                weight = b.column(3).to_numpy()
                np.add.at(total, owner, _unpack(b.column(4), width) * weight[:, None])
                np.add.at(n, owner, weight)
        used = np.flatnonzero(n)
        yield batch(arrow_type(schema), (used // entries, used % entries, n[used], list(total[used])))

    owned = residents.mapInArrow(run, schema)
    each = owned.select("position", "entry", "n", F.posexplode("total").alias("at", "x")).groupBy("position", "entry", "at")
    moved = books.copy()
    for r in each.agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect():  # at most entries x vector length rows
        moved[r["position"], r["entry"], r["at"]] = r["x"] // r["n"]
    return moved


def _migrate(residents: DataFrame, books: np.ndarray) -> DataFrame:
    """Residents under the new codebooks: those that keep their entry stay where they lie, the others are dealt anew."""
    width = books.shape[2]

    def run(batches: Batches) -> Batches:
        out = arrow_type(_RESIDENT + ", was int")
        for b in batches:
            if not b.num_rows:
                continue
            entry, x = np.zeros(b.num_rows, np.int64), _unpack(b.column(4), width)
            for position, mine in _positions(b):
                entry[mine], _ = nearest(x[mine], books[position])
            yield batch(out, (b.column(0), entry, b.column(2), b.column(3), b.column(4), b.column(1)))

    placed = stage(residents.mapInArrow(run, _RESIDENT + ", was int"), "placed")
    moved = placed.filter("was <> entry").drop("was").repartition("position", "entry", "salt")
    return placed.filter("was = entry").drop("was").unionByName(stage(moved, "moved"))


def train(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> np.ndarray | None:
    """Codebooks (parts, entries, width) after ``rounds`` Lloyd rounds; None if no vector is usable.

    They start as the vectors with the least ids (null ids last, equal ids by content), fewer if there are fewer.
    Vectors of unlike length end in zeros up to the longest, lengthened to a multiple of ``parts``.
    """
    rows = integers(vectors, vector_col, F.col(id_col).cast("long").alias("_id"), scale=scale)
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("size")).first()
    if not stats["n"]:
        return None
    width = max(1, -(-stats["size"] // parts))
    first = rows.orderBy(F.col("_id").asc_nulls_last(), "vector").limit(entries).collect()
    start = np.zeros((len(first), parts * width), np.int64)
    for at, r in enumerate(first):
        start[at, : len(r["vector"])] = r["vector"]
    books = start.reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    salts = -(-stats["n"] // OWNED)
    residents = stage(_members(rows, books, salts).repartition("position", "entry", "salt"), "residents")
    for left in reversed(range(rounds)):
        books = _sums(residents, books)
        if left:
            residents = _migrate(residents, books)
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and place, decimal and joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, books: np.ndarray, *keep: str, vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(keep, code, error): two hex digits of the nearest entry of each part, and the squared distances summed.

    ``keep`` names columns to carry along. Rows without a usable vector are left out.
    """
    parts, _, width = books.shape
    rows = integers(vectors, vector_col, *[F.col(f"`{c}`") for c in keep], scale=scale)
    schema = rows.drop("vector").schema.add("code", "string").add("error", "long") if keep else "code string, error long"

    def run(batches: Batches) -> Batches:
        for b in batches:
            *columns, vector = b.columns
            x = _matrix(vector, parts * width).reshape(b.num_rows, parts, width)
            code, error = np.zeros((b.num_rows, parts), np.uint8), np.zeros(b.num_rows, np.int64)
            for position in range(parts):
                code[:, position], square = nearest(x[:, position], books[position])
                error += square
            columns += [pa.array([c.tobytes().hex() for c in code]), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, names=[*b.schema.names[:-1], "code", "error"])

    return rows.mapInArrow(run, schema)


def compress(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", **settings) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256), one row for each usable vector.

    Null vectors and vectors with null or non-finite components have no row; no usable vector, no rows. Repeated
    rows count and are returned each time. Ids may be null or repeat. Components beyond ``LIMIT`` count as that.
    ``label_error`` sums the error of all rows with the same label, null labels together. More than 256 entries do
    not fit two hex digits.
    """
    if settings.get("entries", ENTRIES) > 256:
        raise ValueError("two hex digits name at most 256 entries")
    books = train(vectors, id_col=id_col, vector_col=vector_col, **settings)
    scale = {k: settings[k] for k in ("scale",) if k in settings}
    named = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("x"))
    if books is None:
        return named.limit(0).select("vec_id", F.lit("").alias("code"), *[F.lit(0).cast("long").alias(c) for c in ("error", "label_error")], F.lit("").alias("codebooks_sha256"))
    coded = stage(encode(named, books, "vec_id", "label", vector_col="x", **scale), "coded")
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    both = coded.join(splittable(by_label), F.col("label").eqNullSafe(F.col("_label")))
    return both.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
