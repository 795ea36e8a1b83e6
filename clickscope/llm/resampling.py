"""Importance resampling towards a target distribution, on hashed n-gram counts.

The texts of a batch are joined with a sentinel that belongs to no word, and one pass of a
regular expression finds all words of the batch. ``searchsorted`` in the documents' offsets says
which document a word lies in, so runs of words that would span two documents are masked before
``bincount`` adds up hash buckets. The hash of a run of words follows from those of its words,
because a checksum of joined bytes is linear in the checksums of the parts.

Two passes over the corpus: one for the bucket totals (``buckets`` rows, whatever the
corpus), one for each document's weight. The draw ranks all documents without gathering
them: scores are integers, so a histogram of scores gives the rank at which each score begins, and
ties are ranked within a score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf

from clickscope.llm.common import fresh, stage

BUCKETS = 10000
ORDER = 2          # runs of 1 to this many words
MIN_WORDS = 20
SHARE = 25         # per cent of the documents with at least MIN_WORDS words
SEED = 7
BATCH_BYTES = 4 << 20   # texts joined at a time; a longer text is a batch of its own

_SENTINEL = b"\n"
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of lower-cased bytes: no ASCII sign, blank or control


# ---------------------------------------------------------------- hashes of runs of words

class _Crc:
    """CRC-32 of joined byte strings from the CRC-32 of the parts.

    ``crc(a + b) = zeros(crc(a), len(b)) ^ crc(b)``, where ``zeros`` is linear over single bits: for each length
    four tables of 256 entries, made from the images of the 32 bits, apply it to whole arrays.
    """

    def __init__(self):
        self.rows: dict[int, int] = {}
        self.tables = np.zeros((0, 4, 256), np.uint32)

    @staticmethod
    def _times(images: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(values), np.uint32)
        for bit in range(32):
            out ^= np.where(values >> np.uint32(bit) & np.uint32(1), images[bit], np.uint32(0))
        return out

    def _images(self, length: int) -> np.ndarray:
        """What becomes of each bit when ``length`` bytes follow: squares of the step for one byte."""
        bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
        # one zero byte appended to the register of a CRC, which zlib takes and gives inverted
        step = np.array([zlib.crc32(b"\0", int(b) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF for b in bits], np.uint32)
        out = bits
        while length:
            if length & 1:
                out = self._times(step, out)
            step = self._times(step, step)
            length >>= 1
        return out

    def _row(self, lengths: np.ndarray) -> np.ndarray:
        kinds, at = np.unique(lengths, return_inverse=True)
        new = [int(n) for n in kinds if int(n) not in self.rows]
        if new:
            if len(self.rows) + len(new) > 4096:  # lengths that were seen once don't pile up
                self.rows, self.tables, new = {}, self.tables[:0], [int(n) for n in kinds]
            made = np.empty((len(new), 4, 256), np.uint32)
            for k, n in enumerate(new):
                images = self._images(n)
                for byte in range(4):
                    made[k, byte] = self._times(images, np.arange(256, dtype=np.uint32) << np.uint32(8 * byte))
                self.rows[n] = len(self.tables) + k
            self.tables = np.concatenate([self.tables, made])
        return np.array([self.rows[int(n)] for n in kinds])[at]

    def join(self, first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Of ``a + b``, given those of ``a`` and ``b`` and the lengths of ``b``."""
        if not len(first):
            return second
        row, t = self._row(lengths), self.tables
        return (t[row, 0, first & 255] ^ t[row, 1, first >> 8 & 255] ^ t[row, 2, first >> 16 & 255]
                ^ t[row, 3, first >> 24] ^ second)


_CRC = _Crc()


def batches_of(texts: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``limit`` bytes together."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + limit, side="right")))
        yield at, to
        at = to


def features(texts: pa.Array, order: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(bucket, document, words)``: the bucket and row of every feature of the batch, and each row's words."""
    n = len(texts)
    whole = pc.fill_null(texts.cast(pa.large_binary()), b"")
    ends = np.cumsum(pc.binary_length(whole).to_numpy(zero_copy_only=False).astype(np.int64) + len(_SENTINEL))
    joined = _SENTINEL.join(whole.to_pylist()).lower()  # bytes: A-Z only
    found = [(m.start(), m[0]) for m in _WORD.finditer(joined)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n, np.int64)
    starts, words = zip(*found)
    crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    length = np.fromiter(map(len, words), np.int64, len(words))
    doc = np.searchsorted(ends, np.array(starts), side="right")
    own, owners, run = [crc % buckets], [doc], crc
    blank = np.full(1, zlib.crc32(b" "), np.uint32)
    for k in range(1, order):
        # runs of k + 1 words: the run of k words, a blank, the word behind
        head, tail = run[:-1], crc[k:]
        run = _CRC.join(_CRC.join(head, blank, np.ones(len(head), np.int64)), tail, length[k:])
        inside = doc[:-k] == doc[k:]
        own.append((run % buckets)[inside])
        owners.append(doc[:-k][inside])
    return (np.concatenate(own).astype(np.int64), np.concatenate(owners).astype(np.int64),
            np.bincount(doc, minlength=n).astype(np.int64))


# ---------------------------------------------------------------- passes

def bucket_counts(docs: DataFrame, text: str = "text", order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)`` of all texts' features: a task adds up its own and gives a row for each bucket it met."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for at, to in batches_of(batch.column(0)):
                total += np.bincount(features(batch.column(0).slice(at, to - at), order, buckets)[0], minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], ["bucket", "n"])

    return (docs.select(F.col(text).cast("binary")).mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", order: int = ORDER,
          buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's gain, in thousandths: how much likelier it is in the target than in the corpus.

    ``floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets))))`` of the bucket's counts s and t and their
    sums S and T. The driver gets ``buckets`` counts of either table.
    """
    both = (bucket_counts(docs, text, order, buckets).withColumn("side", F.lit(0))
            .unionByName(bucket_counts(target, target_text, order, buckets).withColumn("side", F.lit(1)))).collect()
    count = np.zeros((2, buckets))
    for row in both:
        count[row.side, row.bucket] = row.n
    (s, t), (ss, tt) = count, count.sum(1)
    return np.floor(1000 * np.log((t + 1) * (ss + buckets) / ((s + 1) * (tt + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, names: tuple[str, str, str], text: str, order: int) -> DataFrame:
    """``docs`` with the columns ``names``: words, features and weight of each text."""
    buckets, words, n, weight = len(gain), *names

    @arrow_udf("struct<words:bigint,features:bigint,weight:bigint>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            cols: list[list[np.ndarray]] = [[], [], []]
            for at, to in batches_of(texts):
                bucket, doc, count = features(texts.slice(at, to - at), order, buckets)
                all_of = np.bincount(doc, minlength=to - at)
                # whole numbers below 2 ** 53: exact in doubles
                total = np.bincount(doc, weights=gain[bucket], minlength=to - at).astype(np.int64)
                for col, x in zip(cols, (count, all_of, total // np.maximum(all_of, 1))):
                    col.append(x)
            yield pa.StructArray.from_arrays([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in cols],
                                             ["words", "features", "weight"])

    (s,) = fresh(docs.columns, "_weighed")
    out = docs.withColumn(s, run.asNondeterministic()(F.col(text).cast("binary")))  # evaluated once
    return out.withColumns({words: F.col(s)["words"], n: F.col(s)["features"], weight: F.col(s)["weight"]}).drop(s)


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
             order: int = ORDER, buckets: int = BUCKETS, min_words: int = MIN_WORDS, share: int = SHARE,
             seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_features, weight, score, rank`` (all long); of the other columns those of ``keep`` (all).

    Texts are lower-cased (A-Z) and cut into words of letters, digits and non-ASCII characters; features are all
    runs of 1 to ``order`` words, repeats counted. ``weight``: the floored mean gain of a text's features (none: 0).
    ``score`` adds Gumbel noise in thousandths, from a hash of ``seed`` and the id. Of the N documents with at least
    ``min_words`` words the ``share * N // 100`` of highest score are drawn: ``rank`` is 1, 2, 3... by score,
    ties to the smaller id (then to fewer features and words, else in any order); others have null.
    A null text has no word; a null id is hashed as empty text and loses ties. Every row, repeats too, is a
    document of its own, every other column is kept; the four columns replace input columns of these names. An empty
    table gives an empty result, an empty target counts 0 everywhere.
    """
    gain = gains(docs, target, text, target_text, order, buckets)
    words, before, s, m = fresh(docs.columns, "_words", "_before", "_s", "_m")
    weighed = weigh(docs.drop(*[c for c in ("n_features", "weight", "score", "rank")
                                if c in docs.columns and c not in (doc_id, text)]), gain, (words, "n_features", "weight"), text, order)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    noise = F.floor(-1000 * F.log(-F.log((F.conv(digest.substr(1, 8), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(4294967296.0))))
    own = ["n_features", "weight", "score"]
    kept = [c for c in weighed.columns if c not in (*own, words) and (keep is None or c in keep or c == doc_id)]
    scored = stage(weighed.withColumn("score", (F.col("weight") + noise).cast("bigint")).select(*kept, *own, words), "resampling_scores")
    # How many documents have each score: as many rows as scores, some 10^5 at most (gains and noise are logarithms).
    fit = scored.where(F.col(words) >= min_words)
    counts = stage(fit.groupBy(F.col("score").alias(s)).agg(F.count(F.lit(1)).alias(m)), "resampling_counts")
    drawn = (counts.agg(F.sum(m)).first()[0] or 0) * share // 100
    below = Window.orderBy(F.col(s).desc())
    counts = (counts.withColumn(before, F.sum(m).over(below.rowsBetween(Window.unboundedPreceding, -1)))
              .withColumn(before, F.coalesce(before, F.lit(0))).where(F.col(before) < drawn).drop(m))
    ties = Window.partitionBy(s).orderBy(F.col(doc_id).asc_nulls_last(), "n_features", words)
    top = fit.join(F.broadcast(counts), F.col("score") == F.col(s))
    ranked = top.withColumn("rank", (F.col(before) + F.row_number().over(ties)).cast("bigint"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).select(*scored.columns, "rank")
    (low,) = fresh([*docs.columns, words], "_low")
    rest = (scored.join(F.broadcast(counts.select(F.col(s).alias(low))),
                        (F.col("score") == F.col(low)) & (F.col(words) >= min_words), "left_anti")
            .withColumn("rank", F.lit(None).cast("bigint")))
    return ranked.unionByName(rest).drop(words)
