"""Vector codes: a product quantizer in whole numbers, searched through memoised grid cells.

A vector is cut into equal parts, and each part is replaced by the index of the nearest entry of
that part's codebook. A grid cuts the space of a part into cells. For a cell that a part falls into,
the entries that can be nearest to some point of the cell are found once: an entry is dominated if its least
distance to the cell's box is above the greatest distance of another. The others are
cached under the cell, and only they are evaluated exactly for the parts in it. A cell's
box holds its parts, so the result doesn't depend on the grid or on what the cache still holds.

The codebooks are refined by rounds over the staged vectors. A task returns sums for each
entry, so the driver gets ``parts * entries`` entries a round and nothing that grows with the
table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickscope.llm.common import fresh, stage

PARTS = 4
ENTRIES = 256      # at most 256: an index is two hexadecimal digits
ROUNDS = 4
SCALE = 1024
CELL = 16          # side of a grid cell, in units of 1 / SCALE
MEMO_CELLS = 50_000   # of a part position that a task remembers; then it starts anew
ROWS = 1024        # vectors evaluated at a time
LIMIT = 1 << 25    # whole-number components are at most this large: sums of squares fit 64 bits


# ---------------------------------------------------------------- nearest entries

class Cells:
    """Nearest entries of one codebook, through cells remembered between batches."""

    def __init__(self, book: np.ndarray, side: int = CELL, memo_cells: int = MEMO_CELLS):
        self.book, self.side, self.room = book, side, memo_cells
        self.plain = book.astype(float)
        self.norm = (self.plain ** 2).sum(1)
        self.memo: dict[bytes, np.ndarray] = {}
        self.met = self.pairs = 0  # cells computed, exact evaluations

    def candidates(self, cells: np.ndarray) -> list[np.ndarray]:
        """For each cell (integer coordinates) the entries that no other dominates across its box, ascending."""
        low = cells * self.side
        high = low + self.side - 1  # parts are whole numbers
        # A first, wider choice by the ball around the box: an entry beyond the nearest one's distance from
        # the middle by more than the ball's diameter is dominated. A margin covers rounding.
        middle = (low + high) / 2
        square = (middle ** 2).sum(1)[:, None] - 2 * middle @ self.plain.T + self.norm
        far = np.sqrt(np.maximum(square, 0))
        reach = np.sqrt(self.book.shape[1]) * (self.side - 1) + 1
        of, entry = np.nonzero(far <= (far.min(1) + reach)[:, None] * (1 + 1e-6) + 1)
        c = self.book[entry]
        below, above = low[of] - c, c - high[of]
        least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(1)
        most = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(1)
        starts = np.searchsorted(of, np.arange(len(cells)))
        keep = least <= np.minimum.reduceat(most, starts)[of]
        entry = entry[keep].astype(np.int16)
        return np.split(entry, np.searchsorted(of[keep], np.arange(1, len(cells))))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(index, squared distance)`` of each row's nearest entry; ties go to the lower index."""
        if not len(x):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not x.shape[1]:
            return np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        cell = np.ascontiguousarray(x // self.side)
        keys = cell.view(f"V{cell.shape[1] * cell.itemsize}").ravel()
        _, first, of = np.unique(keys, return_index=True, return_inverse=True)
        names = [keys[i].tobytes() for i in first]
        if new := [k for k, n in enumerate(names) if n not in self.memo]:
            if len(self.memo) + len(new) > self.room:
                self.memo = {n: self.memo[n] for n in names if n in self.memo}
            for k, found in zip(new, self.candidates(cell[first[new]])):
                self.memo[names[k]] = found
            self.met += len(new)
        own = [self.memo[n] for n in names]
        count = np.array([len(c) for c in own])
        start = np.cumsum(count) - count
        flat = np.concatenate(own).astype(np.int64)
        size = count[of]
        ends = np.cumsum(size)
        row = np.repeat(np.arange(len(x)), size)
        entry = flat[np.repeat(start[of] - (ends - size), size) + np.arange(ends[-1])]
        gap = x[row] - self.book[entry]
        d = np.einsum("ij,ij->i", gap, gap)
        self.pairs += len(d)
        best = np.minimum.reduceat(d, ends - size)
        hit = np.flatnonzero(d == best[row])
        _, at = np.unique(row[hit], return_index=True)  # entries ascend within a row
        return entry[hit[at]], best


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), width)


def _assign(x: np.ndarray, cells: list[Cells]) -> tuple[np.ndarray, np.ndarray]:
    """``(codes, errors)`` of whole vectors, by part."""
    n = len(cells)
    codes, errors = np.zeros((len(x), n), np.int64), np.zeros((len(x), n), np.int64)
    for at in range(0, len(x), ROWS):
        for p, part in enumerate(np.split(x[at:at + ROWS], n, axis=1)):
            codes[at:at + ROWS, p], errors[at:at + ROWS, p] = cells[p].nearest(np.ascontiguousarray(part))
    return codes, errors


# ---------------------------------------------------------------- codebooks

def sums(vectors: DataFrame, books: np.ndarray, side: int = CELL) -> DataFrame:
    """``(part, entry, place, total)`` of the parts assigned to each entry; place -1 counts them. ``vectors``: ``(x)``."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b, side) for b in books]
        total = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), parts * width)
            codes, _ = _assign(x, cells)
            for p in range(parts):
                total[p, :, 0] += np.bincount(codes[:, p], minlength=entries)
                for j in range(width):  # whole numbers below 2 ** 53: exact in doubles
                    total[p, :, j + 1] += np.bincount(codes[:, p], weights=x[:, p * width + j], minlength=entries).astype(np.int64)
        p, e, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (p, e, j - 1, total[p, e, j])],
                                         ["part", "entry", "place", "total"])

    return (vectors.mapInArrow(run, "part long, entry long, place long, total long")
            .groupBy("part", "entry", "place").agg(F.sum("total").alias("total")))


def refine(vectors: DataFrame, books: np.ndarray, rounds: int = ROUNDS, side: int = CELL) -> np.ndarray:
    """The codebooks after ``rounds`` of assigning all parts and averaging; unused entries stay."""
    parts, entries, width = books.shape
    for _ in range(rounds):
        total = np.zeros((parts, entries, width + 1), np.int64)
        for r in sums(vectors, books, side).collect():
            total[r.part, r.entry, r.place + 1] = r.total
        count = total[:, :, :1]
        books = np.where(count > 0, total[:, :, 1:] // np.maximum(count, 1), books)
    return books


def book_digest(books: np.ndarray) -> str:
    """sha256 of the components by part, entry and place, as decimal numbers joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             side: int = CELL) -> DataFrame:
    """``vectors`` with ``code, error, label_error, codebooks_sha256``, without the rows that take no part.

    Rows whose vector is null or holds null or non-finite components are dropped. Components become
    ``floor(scale * x)``. A codebook starts as that part of the ``entries`` smallest ids (ties by vector; all, if
    fewer). ``rounds`` times each part is assigned to the nearest entry (squared distance, ties to the lower index)
    and each used entry becomes the floored mean of its parts; then parts are assigned again.
    ``code``: the indexes in part order, two hexadecimal digits each; ``error``: the squared distances summed over the
    parts; ``label_error``: errors summed over equal labels, nulls together; ``codebooks_sha256``: of the final entries.
    Vectors of another length than the smallest id's, or of one that isn't a multiple of ``parts``, stay
    with null code and error (a label without any error has null). Components beyond ``LIMIT / scale`` are an error.
    Null ids come last, repeated rows count each, other columns stay; the four columns replace input columns of these
    names. An empty table gives an empty result.
    """
    own = ["code", "error", "label_error", "codebooks_sha256"]
    d = vectors.drop(*[c for c in own if c in vectors.columns and c not in (vec_id, vector, label)])
    x, n, k, total = fresh(d.columns, "_x", "_n", "_k", "_total")
    v = F.col(vector)
    fine = v.isNotNull() & ~F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == F.lit(float("inf"))))
    whole = F.transform(v, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("bigint"))
    kept = stage(d.where(fine).withColumn(x, whole), "codes_vectors")
    first = kept.select(F.col(vec_id).alias("i"), F.col(x).alias("x")).orderBy(F.col("i").asc_nulls_last(), "x").limit(entries).collect()
    width = len(first[0].x) if first else 0
    alike = (F.size(x) == width) & F.lit(width % parts == 0)
    large = kept.where(alike).agg(F.max(F.array_max(F.transform(x, F.abs)))).first()[0] or 0
    if large > LIMIT:
        raise ValueError(f"components are at most {LIMIT // scale} in size")
    first = [r.x for r in first if len(r.x) == width] if width % parts == 0 else []
    if not first:
        return kept.drop(x).withColumns({"code": F.lit(None).cast("string"), "error": F.lit(None).cast("bigint"),
                                         "label_error": F.lit(None).cast("bigint"), "codebooks_sha256": F.lit(book_digest(np.zeros(0)))})
    books = np.array(first, np.int64).reshape(len(first), parts, width // parts).transpose(1, 0, 2).copy()
    books = refine(kept.where(alike).select(x), books, rounds, side)

    kind = kept.select(*[c for c in kept.columns if c != x])
    names = kind.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b, side) for b in books]
        for batch in batches:
            codes, errors = _assign(_matrix(batch.column(len(names)), width), cells)
            text, step = codes.astype(np.uint8).tobytes().hex(), 2 * parts
            out = [text[i:i + step] for i in range(0, len(text), step)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.string()), pa.array(errors.sum(1), pa.int64())],
                                             [*names, "code", "error"])

    schema = kind.withColumns({"code": F.lit("").cast("string"), "error": F.lit(0).cast("bigint")}).schema
    for f in schema:
        f.nullable = True
    coded = kept.where(alike).mapInArrow(run, schema).unionByName(
        kept.where(~alike).drop(x).withColumns({"code": F.lit(None).cast("string"), "error": F.lit(None).cast("bigint")}))
    coded = stage(coded, "codes_coded")
    # aggregated before the shuffle, and joined back by a join that can be split: one label may hold a third of the rows
    by = coded.groupBy(F.col(label).alias(k)).agg(F.sum("error").alias(total))
    return (coded.join(by, F.col(label).eqNullSafe(F.col(k)), "left").drop(k).withColumnRenamed(total, "label_error")
            .withColumn("codebooks_sha256", F.lit(book_digest(books))))
