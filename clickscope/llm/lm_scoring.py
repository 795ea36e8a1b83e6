"""Language-model scores by deleted interpolation.

A word has the probability l2 * c(v,w)/c(v) + l1 * c(w)/N + l0/(V+1) after the word v: n-gram
maximum-likelihood estimates, mixed by weights that depend on the bucket (by powers of two) of
the context's frequency c(v). The weights come from expectation-maximisation on held-out
counts: each training document in turn is left out of all counts it is
predicted from, and what every document says is summed in a histogram whose size doesn't depend
on the corpus (log probabilities rounded to ``1 / OCTAVE`` of a power of two).

The corpus is cut into blocks of documents, stored in a table bucketed by block. Each
block's distinct n-grams, as sorted 64-bit hashes with counts, are dealt by hash range
to where all blocks' counts of a range are added up, and the totals go back to the blocks
that asked, in the same order. So an n-gram travels once for each block that has it, and a
frequent one is no hot key. The fit and the scores then each read a block beside its totals
(bucketed alike, so nothing is shuffled again).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from clickscope.llm.common import crc_mod, stage
from clickscope.session import scratch_path

BLOCK_BYTES = 4 << 20
RANGE_BYTES = 8 << 20    # text whose n-grams a hash range gets, about
BUCKET_BYTES = 32 << 20  # text of a bucket of blocks, about
MEMO_WORDS = 250_000
MEMO_BYTES = 48
OCTAVE = 4
ROUNDS = 60
LEAST_WEIGHT = 1e-6
STATS = -1               # the block id of a range's own sums
NEVER = -(1 << 14)       # rounded logarithm of 0


# ---------------------------------------------------------------- words

class _Hashes(dict):
    """64-bit hashes of words, remembered for short ones up to a bound."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= MEMO_BYTES and len(self) < MEMO_WORDS:
            self[word] = h
        return h


_HASHES = _Hashes()
_END = np.uint64(xxhash.xxh64_intdigest(b""))  # no word is empty


class Block:
    """N-gram keys of a block's documents. A text is lower-cased (A-Z), cut into words at
    ASCII white space, and followed by one end token, which is also the context of a first word.

    ``keys``: distinct, sorted, even for words and odd for pairs; ``one, two, context``: for each
    token the places of its word, its pair and its context's word; ``doc``: its document.
    """

    def __init__(self, texts: list[bytes | None], train: np.ndarray):
        parts, sizes = [], []
        for t in texts:
            words = t.lower().split() if t else []
            h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
            parts += [h, [_END]]
            sizes.append(len(words) + 1)
        h = np.concatenate(parts).astype(np.uint64) if parts else np.empty(0, np.uint64)
        self.sizes = np.array(sizes, np.int64)
        self.doc = np.repeat(np.arange(len(sizes)), self.sizes)
        prev = np.concatenate((h[-1:], h[:-1]))  # the end token before a first word
        with np.errstate(over="ignore"):
            pair = (prev * np.uint64(0x9E3779B97F4A7C15)) ^ ((h << np.uint64(29)) | (h >> np.uint64(35)))
            pair = (pair ^ (pair >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            pair ^= pair >> np.uint64(30)
        words = h & ~np.uint64(1)
        self.keys, where = np.unique(np.concatenate((words, pair | np.uint64(1))), return_inverse=True)
        self.one, self.two = where[:len(h)], where[len(h):]
        self.context = np.concatenate((self.one[-1:], self.one[:-1]))
        self.train = train[self.doc] if len(h) else np.empty(0, bool)

    def counts(self) -> np.ndarray:
        """Occurrences of each key in training documents."""
        n = len(self.keys)
        return np.bincount(self.one[self.train], minlength=n) + np.bincount(self.two[self.train], minlength=n)

    def own(self, at: np.ndarray, total: np.ndarray) -> np.ndarray:
        """For each token of a training document the occurrences of key ``at`` in the document.

        A key that the whole corpus has once occurs once here; only the others are sorted.
        """
        out = self.train.astype(np.int64)
        many = np.flatnonzero(self.train & (total[at] > 1))
        pairs = self.doc[many] * np.int64(len(self.keys)) + at[many]
        _, where, n = np.unique(pairs, return_inverse=True, return_counts=True)
        out[many] = n[where]
        return out


# ---------------------------------------------------------------- numbers on the way

def _pack(keys: np.ndarray) -> tuple[int, bytes]:
    """Sorted keys as differences of as many bytes as the largest needs."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    first, gaps = gaps[:1], gaps[1:]
    width = max(1, (int(gaps.max(initial=0)).bit_length() + 7) // 8)
    return width, first.astype("<u8").tobytes() + gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpack(width: int, data: bytes) -> np.ndarray:
    body = np.frombuffer(data, np.uint8, offset=8).reshape(-1, width)
    gaps = np.zeros((len(body) + 1, 8), np.uint8)
    gaps[1:, :width] = body
    gaps[0] = np.frombuffer(data, np.uint8, 8)
    return np.cumsum(gaps.view("<u8").ravel(), dtype=np.uint64)


def _small(n: np.ndarray) -> tuple[bytes, bytes]:
    """Counts as bytes, and those of 255 or more apart."""
    return np.minimum(n, 255).astype(np.uint8).tobytes(), n[n >= 255].astype("<i8").tobytes()


def _large(small: bytes, large: bytes) -> np.ndarray:
    n = np.frombuffer(small, np.uint8).astype(np.int64)
    n[n == 255] = np.frombuffer(large, "<i8")
    return n


# ---------------------------------------------------------------- jobs

BLOCKS = "g bigint, ids array<bigint>, train array<boolean>, held array<boolean>, texts array<binary>"
ASKED = "range int, g bigint, width int, keys binary, small binary, large binary"
TOTALS = "g bigint, range int, small binary, large binary, n bigint, v bigint"
CELLS = "bucket int, q2 int, q1 int, n bigint"
SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(),
             "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_()),
             "array<binary>": pa.list_(pa.binary())}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind, n, held, size = _schema(BLOCKS), 0, [], 0

    def block():
        g = (TaskContext.get().partitionId() << 32) + n
        return pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip([g, *map(list, zip(*held))], kind)],
                                          schema=kind)

    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(3)):
            held.append((*row[:3], row[3].as_py()))
            size += len(held[-1][3] or b"") + 64
            if size >= BLOCK_BYTES:
                yield block()
                n, held, size = n + 1, [], 0
    if held:
        yield block()


def _block_of(row: dict) -> Block:
    return Block(row["texts"], np.array(row["train"], bool))


def _ask(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                b = _block_of(row)
                counts, rows = b.counts(), []
                which = (b.keys >> np.uint64(64 - bits)).astype(np.int64)
                ends = np.searchsorted(which, np.arange((1 << bits) + 1))
                for r in np.flatnonzero(np.diff(ends)):
                    part = slice(ends[r], ends[r + 1])
                    rows.append((int(r), row["g"], *_pack(b.keys[part]), *_small(counts[part])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _schema(ASKED))],
                                                 schema=_schema(ASKED))
    return run


def _add_up(table: pa.Table) -> pa.Table:
    """Totals of a hash range, for each block that asked, and the range's sums."""
    rows = table.to_pylist()
    keys = [_unpack(r["width"], r["keys"]) for r in rows]
    kinds, where = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(where, np.concatenate([_large(r["small"], r["large"]) for r in rows]), len(kinds)).astype(np.int64)
    every, at, out = total[where], 0, []
    for r, k in zip(rows, keys):
        out.append((r["g"], r["range"], *_small(every[at:at + len(k)]), 0, 0))
        at += len(k)
    words = total[kinds & np.uint64(1) == 0]
    out.append((STATS, rows[0]["range"], b"", b"", int(words.sum()), int((words > 0).sum())))
    return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), _schema(TOTALS))], schema=_schema(TOTALS))


def _with_totals(blocks: pa.Table, totals: pa.Table):
    """The block, its row and the totals of its keys."""
    row = blocks.to_pylist()[0]
    got = sorted(totals.to_pylist(), key=lambda r: r["range"])
    return _block_of(row), row, np.concatenate([_large(r["small"], r["large"]) for r in got])


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + the power of two of its count."""
    return np.where(context > 0, 1 + np.log2(np.maximum(context, 1)).astype(np.int64), 0)


def rounded(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.rint(OCTAVE * np.log2(np.where(p > 0, p, 1))), NEVER).astype(np.int64)


def _ratio(a: np.ndarray, b) -> np.ndarray:
    return np.where(b > 0, a / np.maximum(b, 1), 0.0)


def _cells(n_all: int):
    def run(key, blocks: pa.Table, totals: pa.Table) -> pa.Table:
        kind = _schema(CELLS)
        if not blocks.num_rows:
            return kind.empty_table()
        b, _, total = _with_totals(blocks, totals)
        t = b.train  # each token's document left out of the counts
        one = b.own(b.one, total)
        before = np.concatenate((one[-1:], one[:-1]))  # of the token before; an end token occurs once
        before[np.concatenate(([0], np.cumsum(b.sizes)[:-1]))] = 1
        context = (total[b.context] - before)[t]
        p2 = _ratio((total[b.two] - b.own(b.two, total))[t], context)
        p1 = _ratio((total[b.one] - one)[t], np.int64(n_all) - b.sizes[b.doc][t])
        code = (bucket_of(context) * 2 * -NEVER + rounded(p2) - NEVER) * 2 * -NEVER + rounded(p1) - NEVER
        code, n = np.unique(code, return_counts=True)
        cells = (code // (4 * NEVER * NEVER), code // (-2 * NEVER) % (-2 * NEVER) + NEVER, code % (-2 * NEVER) + NEVER)
        return pa.Table.from_arrays([pa.array(c.astype(np.int64), pa.int64()).cast(f.type) for c, f in zip((*cells, n), kind)],
                                    schema=kind)
    return run


def learn(cells: np.ndarray, vocabulary: int) -> np.ndarray:
    """Mixture weights ``[bucket, (pair, word, uniform)]`` by expectation-maximisation.

    ``cells``: rows (bucket, rounded log2 of the pair's and the word's estimate, tokens). A bucket
    without tokens has the weights of the next lower one that has some, or trusts words.
    """
    out = np.tile([0.0, 0.9, 0.1], (65, 1))
    for k in range(65):
        mine = cells[cells[:, 0] == k]
        if not len(mine):
            out[k] = out[k - 1] if k > 1 else out[k]
            continue
        p = np.stack([np.where(mine[:, c] == NEVER, 0.0, 2.0 ** (mine[:, c] / OCTAVE)) for c in (1, 2)]
                     + [np.full(len(mine), 1 / (vocabulary + 1))], 1)
        w, n = np.full(3, 1 / 3), mine[:, 3] / mine[:, 3].sum()
        for _ in range(ROUNDS):
            part = p * w
            w = (part / part.sum(1, keepdims=True) * n[:, None]).sum(0)
        w = np.maximum(w, LEAST_WEIGHT)
        out[k] = w / w.sum()
    return out


def _scores(n_all: int, vocabulary: int, weights: np.ndarray):
    def run(key, blocks: pa.Table, totals: pa.Table) -> pa.Table:
        kind = _schema(SCORES)
        if not blocks.num_rows:
            return kind.empty_table()
        b, row, total = _with_totals(blocks, totals)
        one, context = total[b.one], total[b.context]
        w = weights[bucket_of(context)]
        p = w[:, 0] * _ratio(total[b.two], context) + w[:, 1] * (one / max(n_all, 1)) + w[:, 2] / (vocabulary + 1)
        base = np.log10((one + 0.1) / (n_all + 0.1 * (vocabulary + 1)))

        def by_doc(x):
            return np.bincount(b.doc, x, len(b.sizes))
        cols = [row["ids"], row["held"], b.sizes, by_doc(one > 0).astype(np.int64), by_doc(base), by_doc(np.log10(p))]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, kind)], schema=kind)
    return run


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 10,
                    held: int = 0) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for each input row.

    Learnt from rows whose crc32(id as text) mod ``folds`` isn't ``held``; rows with a null id are neither learnt from
    nor held out. A null text is empty: one end token. ``n_known``: tokens with a training count; ``base_score``: log10
    probability under add-0.1 word frequencies; ``score``: under the model. With nothing to
    learn from every token has the uniform probability. Repeated rows count each. N-grams are
    told apart by 64-bit hashes. Other columns are left out; an empty table gives no row. The
    result is staged, and the working tables are dropped from the catalogue.
    """
    spark = docs.sparkSession
    fold = crc_mod(doc_id, folds)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("i"), F.coalesce(fold != held, F.lit(False)).alias("t"),
                       F.coalesce(fold == held, F.lit(False)).alias("o"), F.col(text).cast("binary").alias("x"))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = min(100_000, max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES))
    bits = max(3, int(size // RANGE_BYTES).bit_length())
    names = []

    def bucketed(df: DataFrame, what: str) -> DataFrame:
        names.append(f"lm_{what}_{uuid.uuid4().hex}")
        (df.write.bucketBy(buckets, "g").option("path", scratch_path(spark, names[-1])).format("parquet")
         .saveAsTable(names[-1]))
        return spark.table(names[-1])

    try:
        blocks = bucketed(rows.mapInArrow(_to_blocks, BLOCKS), "blocks")
        totals = bucketed(blocks.select(*[c.split()[0] for c in BLOCKS.split(", ")]).mapInArrow(_ask(bits), ASKED)
                          .groupBy("range").applyInArrow(_add_up, TOTALS), "totals")
        n, v = totals.where(F.col("g") == STATS).agg(F.sum("n"), F.sum("v")).first()
        n, v = n or 0, v or 0
        beside = blocks.groupBy("g").cogroup(totals.where(F.col("g") != STATS).groupBy("g"))
        found = beside.applyInArrow(_cells(n), CELLS).groupBy("bucket", "q2", "q1").agg(F.sum("n")).collect()
        weights = learn(np.array([tuple(r) for r in found], np.int64).reshape(-1, 4), v)
        out = stage(beside.applyInArrow(_scores(n, v, weights), SCORES)
                    .withColumn("train_tokens", F.lit(n).cast("bigint")), "lm_scores")
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
