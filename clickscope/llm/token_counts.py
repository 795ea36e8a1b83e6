"""Token counts: batch encoding in an Arrow function that returns lengths only.

Texts are cut into batches of about ``BATCH_CHARS``; a longer text is cut at
safe boundaries: before a single space between two characters that are not
white space. No pre-token and no special string of a byte-level BPE spans such a
place, so the counts of the parts add up to the count of the whole. The
words of a batch are encoded once each, and a worker remembers the lengths
of up to ``MEMO_WORDS`` short words. These bounds only move work around;
the result doesn't depend on them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

BATCH_CHARS = 1 << 20
MEMO_WORDS = 400_000
MEMO_CHARS = 48

# A character that some library may take for white space is never next to a cut.
_SAFE = re.compile(r"(?<=[^\s\u180e\u200b\ufeff])(?= [^\s\u180e\u200b\ufeff])")
_ODD = re.compile(r" [\s\u180e\u200b\ufeff]|[^\S ] |[\u180e\u200b\ufeff] ")


def parts_of(text: str, limit: int = BATCH_CHARS) -> Iterator[str]:
    """``text`` in parts of about ``limit`` characters, cut at safe boundaries
    only (a text without any stays whole)."""
    at = 0
    while len(text) - at > limit:
        cut = _SAFE.search(text, at + limit)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def words_of(part: str) -> list[str]:
    """Pieces that are encoded apart; all but the first begin with their space."""
    if _ODD.search(part):
        return _SAFE.split(part)
    head, *rest = part.split(" ")
    return [head, *[" " + w for w in rest]]


class _Counter:
    """Lengths of words under one tokenizer file, with a bounded memory."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece
            own = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda xs: [len(x) for x in own.encode(xs, num_threads=1)]
            self.whole = True  # its pieces may span spaces
        else:
            from tokenizers import Tokenizer
            tok = Tokenizer.from_file(path)
            tok.no_truncation()
            tok.no_padding()
            self.encode = lambda xs: [len(x) for x in tok.encode_batch_fast(xs, add_special_tokens=False)]
            self.whole = False
        self.memo: dict[str, int] = {}

    def count(self, parts: list[str]) -> list[int]:
        if self.whole:
            return self.encode(parts)
        split = [words_of(p) for p in parts]
        memo = self.memo
        new = list(set().union(*split).difference(memo))
        fresh = dict(zip(new, self.encode(new)))
        if len(memo) + len(fresh) > MEMO_WORDS:
            memo = self.memo = {w: memo[w] for w in set().union(*split) if w in memo}
        memo.update(fresh)
        out = [sum(map(memo.__getitem__, words)) for words in split]
        for w in fresh:
            if len(w) > MEMO_CHARS:
                del memo[w]
        return out


_COUNTERS: dict[str, _Counter] = {}


def lengths(texts: list[str | None], path: str) -> list[int]:
    """Token counts of whole texts (null: 0)."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    counter = _COUNTERS.get(path) or _COUNTERS.setdefault(path, _Counter(path))
    totals, batch, owners, size = [0] * len(texts), [], [], 0

    def flush():
        for i, n in zip(owners, counter.count(batch)):
            totals[i] += n
        batch.clear()
        owners.clear()

    for i, text in enumerate(texts):
        for part in [text] if counter.whole and text else parts_of(text) if text else ():
            batch.append(part)
            owners.append(i)
            size += len(part)
            if size >= BATCH_CHARS:
                flush()
                size = 0
    if batch:
        flush()
    return totals


def token_length(col, path: str):
    """A column: the number of tokens of text column ``col`` under the file ``path``."""

    @arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            step = 1024  # so that few texts are Python objects at a time
            yield pa.array([n for k in range(0, len(texts), step)
                            for n in lengths(texts[k:k + step].to_pylist(), path)], pa.int64())

    return count(col)


def token_counts(docs: DataFrame, path: str, text: str = "text", limit: int = 512) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``).

    ``path``: a tokenizers ``.json`` file of a byte-level BPE, or a sentencepiece
    ``.model``; it must exist on every executor. A null or empty text has 0
    bytes and 0 tokens. Every row is kept, repeats and null ids included; the three
    columns replace input columns of these names. No shuffle.
    """
    return (docs.withColumn("n_tokens", token_length(F.coalesce(F.col(text), F.lit("")), path))
            .withColumn("n_bytes", F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("bigint"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
