"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has 64 bits; bit b is set if it is set in over half of the XXH64 values
(seed 42) of the text's word shingles. For radius r every bit position gets
a non-zero vector of r+1 bits; the mask of each of the 2^(r+1)-1 non-zero vectors v
selects the positions whose vector has an odd overlap with v. The vectors
of at most r differing positions span at most r dimensions, so some v is
orthogonal to all of them and its mask leaves them out: every pair within the radius
agrees under at least one mask (no false negatives), whatever the data.

Equal fingerprints are one node. A bucket (mask, masked bits) emits a spanning forest of
its links, never all pairs; a bucket of more than ``BLOCK`` fingerprints
is dealt out as pairs of blocks, which together compare all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from clickscope.llm.common import connected_components, stage

SEED = 42
BLOCK = 4096
STEP = 1 << 15

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes, words: int) -> Iterator[np.ndarray]:
    """XXH64 values of the shingles of a lower-cased text, some at a time.

    White space is \\x09-\\x0D and space; fewer words than a shingle's are one
    shingle, no word is none.
    """
    b = np.frombuffer(text.lower(), np.uint8)
    space = _SPACE[b]
    keep = ~space
    keep[1:] |= ~space[:-1]  # one separator after each word
    b, space = b[keep], space[keep]
    norm = np.where(space, np.uint8(32), b)
    if len(norm) and space[-1]:
        norm, space = norm[:-1], space[:-1]
    if len(norm) and space[0]:
        norm, space = norm[1:], space[1:]
    if not len(norm):
        return
    gaps, data = np.flatnonzero(space), norm.tobytes()
    starts, ends = np.concatenate(([0], gaps + 1)), np.append(gaps, len(norm))
    if len(starts) > words:
        starts, ends = starts[:len(starts) - words + 1], ends[words - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    for k in range(0, len(starts), STEP):
        cut = map(data.__getitem__, map(slice, starts[k:k + STEP].tolist(), ends[k:k + STEP].tolist()))
        yield np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(SEED)), np.uint64,
                          len(starts[k:k + STEP]))


def fingerprint(text: bytes | None, words: int = 4) -> int:
    """The 64-bit fingerprint as a signed integer (null or wordless text: 0)."""
    counts, n = np.zeros((8, 8), np.int64), 0  # [bit within byte, byte]
    for h in shingle_hashes(text or b"", words):
        n += len(h)
        at = np.arange(0, len(h), 255)  # sums of 255 bits fit a byte lane
        for k in range(8):
            counts[k] += np.add.reduceat((h >> np.uint64(k)) & _LANES, at).view(np.uint8).reshape(-1, 8).sum(0, np.int64)
    bits = np.packbits((2 * counts.T > n).astype(np.uint8).ravel(), bitorder="little")
    return int(bits.view("<i8")[0]) if n else 0


def fingerprint_column(text, words: int = 4):
    """A bigint column: :func:`fingerprint` of a text column."""

    @arrow_udf("bigint")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([fingerprint(t.as_py(), words) for t in texts], pa.int64())

    return run(F.coalesce(F.col(text).cast("binary"), F.lit(b"")))


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """Masks as signed integers, ordered by vector."""
    n = (1 << (radius + 1)) - 1
    vector = [1 + i % n for i in range(bits)]
    masks = [sum(1 << i for i in range(bits) if (vector[i] & v).bit_count() % 2) for v in range(1, n + 1)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def spanning_edges(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the pairs within ``radius`` bits."""
    rest, out = fps, []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            u = queue.pop()
            near = np.bitwise_count(rest ^ u) <= radius
            if near.any():
                found, rest = rest[near], rest[~near]
                out += zip(repeat(int(u)), found.tolist())
                queue += list(found)
    return out


def _bucket_edges(radius: int):
    """mapInArrow over rows sorted by (mask, key, part): edges of each bucket."""
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def edges(fps):
        # int64 values; XOR and bit counts see the same bits as unsigned ones
        return [(a, b) for a, b in spanning_edges(np.unique(fps).view(np.uint64), radius)] if len(fps) > 1 else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found):
            ab = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(ab[:, 0].copy()), pa.array(ab[:, 1].copy())], schema=kind)

        held = [np.empty(0, np.int64)] * 4
        for batch in batches:
            cols = [np.concatenate((h, c.to_numpy(zero_copy_only=False))) for h, c in zip(held, batch.columns)]
            if not len(cols[0]):
                continue
            new = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols[:3]])) + 1
            bounds = np.concatenate(([0], new))
            several = np.flatnonzero(np.diff(bounds) > 1)  # closed runs of two rows or more
            found = [e for i in several for e in edges(cols[3][bounds[i]:bounds[i + 1]])]
            held = [c[bounds[-1]:] for c in cols]
            if found:
                yield out(found)
        if found := edges(held[3]):
            yield out(found)

    return run


def near_edges(nodes: DataFrame, radius: int, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``(fp)``: enough of them to connect
    whatever is connected by pairs within ``radius`` bits."""
    keys = nodes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in covering_masks(radius)]))
                        .alias("mask", "key")).select(F.col("mask").cast("bigint").alias("mask"), "key", "fp")
    large = stage(keys.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
                  .select("mask", "key", F.ceil(F.col("n") / block).alias("blocks")), "simhash_large")
    own = F.pmod(F.xxhash64("fp"), "blocks")
    pair = F.transform(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: x != own),
                       lambda x: F.least(x, own) * F.col("blocks") + F.greatest(x, own))
    dealt = (keys.join(large, ["mask", "key"], "left")
             .select("mask", "key", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("bigint")))
                                              .otherwise(pair)).alias("part"), "fp"))
    return (dealt.repartition("mask", "key", "part").sortWithinPartitions("mask", "key", "part")
            .mapInArrow(_bucket_edges(radius), "a long, b long"))


def _classes(docs: DataFrame, doc_id: str, text: str, words: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """Staged ``(doc_id, th, fp)`` of each row, and ``(fp, root, component_id)`` of each fingerprint."""
    fps = stage(docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("th"),
                            fingerprint_column(text, words).alias("fp")), "simhash_fps")
    nodes = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash_nodes")
    roots = stage(connected_components(near_edges(nodes.select("fp"), radius)), "simhash_roots")
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    linked = placed.where("root is not null")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    whole = stage(linked.join(least, "root").select("fp", "root", "component_id")
                  .unionByName(placed.where("root is null").select("fp", F.col("fp").alias("root"),
                                                                   F.col("least").alias("component_id"))), "simhash_classes")
    return fps, whole


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       words: int = 4, radius: int = 4) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row for each input row.

    ``fingerprint`` is a signed bigint, ``component_id`` the smallest doc id reachable by links
    of at most ``radius`` differing bits (null if all those ids are null). Null and wordless
    texts have fingerprint 0 and link like any other; repeated rows share
    their fingerprint; other columns are left out. Fingerprints are staged once;
    the components are found among distinct fingerprints.
    """
    fps, whole = _classes(docs, doc_id, text, words, radius)
    return fps.join(whole, "fp").select("doc_id", F.col("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one row of each component of :func:`simhash_components`: that of the
    smallest id (a null id after all others), then the smallest text hash; of equal rows any."""
    fps, whole = _classes(docs, doc_id, text, words, radius)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    best = fps.join(whole, "fp").groupBy("root").agg(F.min(rank).alias("best")).select("best.doc_id", "best.th")
    rows = fps.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("times"))
    best = stage(best.join(rows, best["doc_id"].eqNullSafe(rows["doc_id"]) & (best["th"] == rows["th"]))
                 .select(best["doc_id"].alias("_s_id"), best["th"].alias("_s_th"), "times"), "simhash_best")

    def rows_of(which):
        return docs.join(best.where(which), F.col(doc_id).eqNullSafe(F.col("_s_id"))
                         & (F.xxhash64(text) == F.col("_s_th"))).select(*[F.col(c) for c in docs.columns], "_s_th")

    once = rows_of("times = 1")
    repeated = rows_of("times > 1").dropDuplicates([doc_id, "_s_th"])
    return once.unionByName(repeated).drop("_s_th")


def hex16(col):
    """A bigint's 64 bits as 16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(col)), 16, "0")
