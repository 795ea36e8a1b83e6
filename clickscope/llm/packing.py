"""Packing token sequences by cutting-stock column generation.

A document's ids are cut into pieces of the capacity and one remainder. The
histogram of piece lengths, rounded up to ``UNIT`` tokens, has at most capacity / UNIT
classes, whatever the corpus. A linear program chooses how often to use each pattern (a multiset of
classes that fits a sequence); a knapsack dynamic program over the dual prices
finds the next column until none improves it. Patterns are rounded down, and
what remains is filled greedily. Pieces are ranked within their class by a distributed count,
and a rank says which use of which pattern, hence which sequence and slot, a piece gets.
Only the histogram and the patterns are on the driver.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from clickscope.llm.common import stage

CAPACITY = 4096
UNIT = 8
RANK_BUCKETS = 1024
MEMO_PARTS = 300_000
MEMO_CHARS = 48
CHUNK = 1 << 22     # bytes of text encoded at a time
JOINED = 512
_BLANK = re.compile(rb"[ \t\n\r\x0b\f]")
GAP = 1e-3      # the program stops this close to its bound
ROUNDS = 5000   # and after so many columns; any set of patterns packs everything
DRAWN = 0.9     # weight of the best bound's dual values in the prices


# ---------------------------------------------------------------- tokens

# Letters whose lower case any library agrees on, then ASCII signs that start no special string
# and no contraction: the pre-tokenizer cuts between the two.
_LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+"
_PLAIN = f"^(?P<head>{_LETTERS})(?P<signs>[!-%(-/:;=?@\\[-`{{}}~]*)$"


class _Ids:
    """Ids of whole texts under a tokenizers file that drops ASCII white space.

    Texts are cut at white space, the words of a batch dictionary-encoded, and plain words cut into their
    letters and the signs behind, all in Arrow's own functions; Python sees each distinct part once a batch.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.only_letters = re.compile(_LETTERS).fullmatch
        mark = json.loads(self.tok.to_str())["model"].get("end_of_word_suffix")
        known = self.tok.get_vocab()
        self.last = np.zeros(max(known.values(), default=0) + 1, bool)  # ids that end a word
        for word, i in known.items():
            self.last[i] = bool(mark) and word.endswith(mark)

    def _encoded(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Of words of letters only, many of which make one text: an id that ends a word ends one of them."""
        out = []
        for at in range(0, len(words), JOINED):
            some = words[at:at + JOINED]
            data = self._encoded([" ".join(some)])[0]
            cut = 4 * np.flatnonzero(self.last[np.frombuffer(data, "<u4")]) + 4
            if len(cut) == len(some):
                cut = [0, *cut.tolist()]
                out += [data[i:j] for i, j in zip(cut, cut[1:])]
            else:  # a vocabulary without such a mark
                out += self._encoded(some)
        return out

    def parts(self, keys: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of distinct parts of words. What was met before is remembered, in
        two generations, so that what is in use outlives a full one."""
        if len(self.new) > MEMO_PARTS:
            self.new, self.old = {}, self.new
        new, old = self.new, self.old
        out = list(map(new.get, keys))
        lost = [i for i, v in enumerate(out) if v is None]
        simple, other = [], []
        for i in lost:
            k = keys[i]
            if (v := old.get(k)) is not None:
                out[i] = new[k] = v
            else:
                (simple if self.only_letters(k) else other).append(i)
        for some, encode in ((simple, self._letters), (other, self._encoded)):
            for i, v in zip(some, encode([keys[i] for i in some])):
                out[i] = v
                if len(keys[i]) <= MEMO_CHARS:
                    new[keys[i]] = v
        return out

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's begin (and the last one's end)."""
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        words = split.flatten().dictionary_encode()
        plain = pc.extract_regex(words.dictionary, _PLAIN)  # null for any other word, which is encoded whole
        head, signs = plain.flatten()
        head = pc.coalesce(pc.utf8_lower(head), words.dictionary)
        parts = pa.concat_arrays([head, signs.fill_null("")]).dictionary_encode()
        found = self.parts(parts.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        start = np.cumsum(size) - size
        of = parts.indices.to_numpy().reshape(2, -1).T[words.indices.to_numpy()].ravel()  # two parts a word
        ends = np.concatenate([[0], np.cumsum(size[of])])
        place = np.repeat(start[of] - ends[:-1], size[of]) + np.arange(ends[-1])
        bounds = split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()
        return flat[place], ends[2 * bounds]

    def texts(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; a long one is cut at white space first."""
        size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        ends = np.cumsum(size)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, side="right")))
            if size[at] > CHUNK:
                parts = pa.array(list(cut_long((texts[at].as_py() or "").encode())), pa.string())
                yield np.concatenate([self.batch(parts[i:i + 1])[0] for i in range(len(parts))])
            else:
                ids, bounds = self.batch(texts.slice(at, to - at))
                yield from (ids[i:j] for i, j in zip(bounds, bounds[1:]))
            at = to


def cut_long(text: bytes, size: int | None = None) -> Iterator[str]:
    """A text in parts of about ``size`` (``CHUNK``) bytes, cut at ASCII white space only."""
    size, at = size or CHUNK, 0
    while at < len(text):
        found = _BLANK.search(text, at + size)
        to = found.start() if found else len(text)
        yield text[at:to].decode()
        at = to


_IDS: dict[str, _Ids] = {}
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
           capacity: int = CAPACITY) -> DataFrame:
    """The pieces of each document: whole sequences, then the remainder.

    A document's ids are those of its text (null: none) and ``end_id``. Empty documents are one
    piece of one id. Repeated rows are documents of their own.
    """
    kind = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _IDS.get(path) or _IDS.setdefault(path, _Ids(path))
        end = np.array([end_id], "<u4")
        for batch in batches:
            rows = []
            for d, own in zip(batch.column(0).to_pylist(), ids.texts(batch.column(1))):
                own = np.concatenate([own, end])
                n = len(own)
                rows += [(d, s, min(capacity, n - s), zlib.crc32(own[s:s + capacity]), n) for s in range(0, n, capacity)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=kind)

    return docs.select(F.col(doc_id).cast("bigint"), F.col(text).cast("string")).mapInArrow(run, PIECES)


# ---------------------------------------------------------------- patterns

def best_pattern(prices: np.ndarray, widths: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern: an unbounded knapsack over ``room`` units."""
    best, took = np.zeros(room + 1), np.full(room + 1, -1)
    upto = np.searchsorted(widths, np.arange(room + 1), side="right")
    for c in range(1, room + 1):
        best[c] = best[c - 1]
        if k := upto[c]:
            value = best[c - widths[:k]] + prices[:k]
            j = int(value.argmax())
            if value[j] > best[c] + 1e-12:
                best[c], took[c] = value[j], j
    out, c = np.zeros(len(widths), np.int64), room
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            out[took[c]] += 1
            c -= widths[took[c]]
    return float(best[room]), out


def generate(widths: np.ndarray, demand: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and their uses in the linear program's solution.

    Revised simplex: minimise the uses subject to meeting the demand exactly. Each round prices the
    next column with dual values drawn towards those of the best bound so far, or with the
    plain ones where that finds nothing, and replaces the column that the ratio test names.
    Scaled dual values bound the optimum from below; the program stops ``GAP`` above.
    """
    cols = np.diag(room // widths).astype(np.int64)
    inverse = np.diag(1.0 / np.diag(cols))
    x = inverse @ demand
    centre, bound = inverse.sum(0), 0.0
    for turn in range(ROUNDS):
        prices, drawn = inverse.sum(0), DRAWN
        while True:
            mixed = np.maximum(drawn * centre + (1 - drawn) * prices, 0)
            value, new = best_pattern(mixed, widths, room)
            if value > 0 and mixed @ demand / value > bound:
                bound, centre = mixed @ demand / value, mixed / value
            if drawn == 0 or prices @ new > 1 + 1e-7:
                break
            drawn = drawn / 2 if drawn > 0.3 else 0
        if x.sum() <= bound * (1 + GAP) or prices @ new <= 1 + 1e-9:
            break
        step = inverse @ new
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        x = np.maximum(x - ratio[out] * step, 0)
        x[out] = ratio[out]
        cols[:, out] = new
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        if turn % 100 == 99:  # against rounding errors
            inverse = np.linalg.inv(cols.astype(float))
            x = np.maximum(inverse @ demand, 0)
    return cols, x


def plan(widths: np.ndarray, demand: np.ndarray, room: int) -> list[tuple[np.ndarray, int]]:
    """(pattern, times) that together hold the whole demand: the program's, rounded
    down, then patterns that fill a sequence with the largest of what remains."""
    out, rest = [], demand.astype(np.int64).copy()
    if not len(widths):
        return out
    cols, x = generate(widths, demand.astype(float), room)
    for j in np.argsort(-x, kind="stable"):
        col = cols[:, j]
        has = col > 0
        times = int(min(np.floor(x[j] + 1e-9), (rest[has] // col[has]).min()))
        if times > 0:
            out.append((col.copy(), times))
            rest -= times * col
    while rest.any():
        col, free = np.zeros_like(rest), room
        for i in range(len(widths) - 1, -1, -1):
            col[i] = min(rest[i], free // widths[i])
            free -= col[i] * widths[i]
        has = col > 0
        times = int((rest[has] // col[has]).min())
        out.append((col, times))
        rest -= times * col
    return out


# ---------------------------------------------------------------- assignment

def assign(found: DataFrame, capacity: int = CAPACITY, unit: int = UNIT) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; the columns of :func:`pieces` are kept.

    Sequences hold ``capacity`` tokens at most, offsets are gapless from 0. The pieces of a class are
    ranked by hash bucket counts and a window within a bucket, so a length
    that a third of all documents share is spread over ``RANK_BUCKETS`` groups. A pattern
    table has a row for each class of each pattern, which is bounded by the number of classes.
    """
    spark = found.sparkSession
    cls = F.ceil(F.col("length") / unit).cast("int")
    p = (found.withColumn("class", cls)
         .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(RANK_BUCKETS))))
    counts = stage(p.groupBy("class", "bucket").agg(F.count(F.lit(1)).alias("n")), "pack_counts")
    histogram = counts.groupBy("class").agg(F.sum("n").alias("n")).orderBy("class").collect()
    widths = np.array([r["class"] for r in histogram], np.int64)
    rows, sequence, used = [], 0, dict.fromkeys(widths.tolist(), 0)
    for col, times in plan(widths, np.array([r["n"] for r in histogram], np.int64), capacity // unit):
        for i in np.flatnonzero(col):
            w, each = int(widths[i]), int(col[i])
            rows.append((w, used[w], used[w] + each * times, each, sequence))
            used[w] += each * times
        sequence += times
    patterns = spark.createDataFrame(rows, "class int, first long, last long, each long, base long")
    over = Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(counts.withColumn("before", F.coalesce(F.sum("n").over(over), F.lit(0))).drop("n"), "pack_ranks")
    order = Window.partitionBy("class", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = (p.withColumn("row", F.row_number().over(order) - 1).join(offsets, ["class", "bucket"])
              .withColumn("rank", F.col("before") + F.col("row")))
    t = F.broadcast(patterns)  # at most classes squared rows
    placed = ranked.join(t, (ranked["class"] == t["class"]) & (F.col("rank") >= F.col("first"))
                         & (F.col("rank") < F.col("last"))).drop(t["class"])
    use = F.col("rank") - F.col("first")
    placed = (placed.withColumn("sequence_id", F.col("base") + F.floor(use / F.col("each")))
              .withColumn("slot", use % F.col("each")))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(*found.columns, "sequence_id",
                         F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"))


def pack(docs: DataFrame, path: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text",
         capacity: int = CAPACITY, unit: int = UNIT) -> DataFrame:
    """One row for each piece of each document row: ``doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset``.

    ``path``: a tokenizers file whose pre-tokenizer drops white space. No document shorter than a sequence is
    cut. Null ids and texts, repeats and an empty table are fine; other columns are left out.
    """
    return assign(stage(pieces(docs, path, end_id, doc_id, text, capacity), "pack_pieces"), capacity, unit)
