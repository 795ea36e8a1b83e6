"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text accepts exactly that text's
substrings. A new text is parsed into phrases, each the longest match from its
place (a byte that the language never uses is a phrase by itself). A language
whose sample has L bytes spends about phrases * log2(L) bits; the one that needs
the fewest bits a byte wins. Texts are lower-cased and read as UTF-8 bytes.

The automata are fitted on a bounded sample, ``ROWS_PER_LANGUAGE`` labelled rows
of at most ``CHARS_PER_ROW`` characters each, chosen by a hash; every text is parsed
whole. Parsing walks many segments of the texts side by side: a segment starts
as if a phrase began there, and is walked again from the true state
its predecessor ends in until both walks are in the same state, so the phrase
counts are those of one walk through the whole text.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf

from clickscope.llm.common import crc_mod, fresh, release

ROWS_PER_LANGUAGE = 16
CHARS_PER_ROW = 2000
MAX_LANGUAGES = 256

SEGMENT = 4096
SYNC = 128
WAVE_BYTES = 4 << 20
ROWS = 2048

_LETTER = regex.compile(r"\p{L}")


def automaton(data: list[int], width: int) -> array:
    """Transitions of the suffix automaton of ``data``, symbols below ``width``: a row of next
    states for each state (-1: none); state 0 is the start."""
    none = array("i", [-1]) * width
    nxt, link, length, last = array("i", none), [-1], [0], 0
    for c in data:
        cur = len(link)
        nxt.extend(none)
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and nxt[p * width + c] < 0:
            nxt[p * width + c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p * width + c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = len(link)
                nxt.extend(nxt[q * width:(q + 1) * width])
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nxt[p * width + c] == q:
                    nxt[p * width + c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return nxt


class Parser:
    """Phrase counts of texts under each language of ``samples`` (name -> bytes)."""

    def __init__(self, samples: dict[str, bytes]):
        self.names = sorted(samples)
        self.cost = np.array([np.log2(max(2, len(samples[n]))) for n in self.names])
        if not samples:
            return
        used = sorted(set().union(*map(set, samples.values())))
        self.symbol = np.zeros(256, np.int64)  # 0: a byte that no sample has
        self.symbol[used] = np.arange(1, len(used) + 1)
        width = len(used) + 1
        found = [automaton(self.symbol[np.frombuffer(samples[n], np.uint8)].tolist(), width) for n in self.names]
        size = sum(map(len, found))
        kind = np.int32 if size << 2 < 2 ** 31 else np.int64
        self.table, roots, base = np.empty(size, kind), [], 0
        for k in range(len(found)):  # one language at a time, each in its place
            states = np.frombuffer(found[k], np.intc).reshape(-1, width)
            missing, start = states < 0, states[0].copy()
            ends = missing.astype(np.int8)  # a phrase ends before this byte
            ends += missing & (start < 0)  # and the byte is one by itself
            ends[0] = start < 0
            t = self.table[base * width:base * width + states.size].reshape(states.shape)
            t[:] = states
            np.copyto(t, np.maximum(start, 0), where=missing, casting="same_kind")
            t += base
            t *= width << 2
            t |= ends  # next row's place, phrases ended
            roots.append(base * width << 2)
            base += len(states)
            found[k] = states = missing = ends = None
        self.roots = np.array(roots, kind)

    def _walk(self, text, order, sizes, entry, stop=None):
        """Walk segments (rows of ``text`` in ``order``, longest first) from ``entry``.

        Returns the last states, the phrases ended, and both as they were after
        ``SYNC`` bytes. ``stop``: walk that far at most.
        """
        v, ended = entry.copy(), np.zeros(entry.shape, np.int64)
        mid_v, mid_ended, block = v.copy(), ended.copy(), np.zeros(entry.shape, v.dtype)
        top = min(int(sizes[0]) if len(sizes) else 0, stop or 1 << 62)
        active = np.searchsorted(-sizes, -np.arange(top), side="left")  # segments longer than t
        for t0 in range(0, top, 64):
            cols = np.ascontiguousarray(text[order[:active[t0]], t0:min(t0 + 64, top)].T)
            for t in range(t0, min(t0 + 64, top)):
                k = active[t]
                w = v[:k]
                w >>= 2
                w += cols[t - t0, :k, None]
                np.take(self.table, w, out=w, mode="clip")
                block[:k] += w & 3
                w &= ~3
                if t + 1 == SYNC:
                    mid_v[:], mid_ended[:] = v, ended + block
            ended += block
            block[:] = 0
        if top < SYNC:
            mid_v, mid_ended = v.copy(), ended.copy()
        return v, ended, mid_v, mid_ended

    def counts(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of each text (rows) under each language (columns)."""
        total = np.zeros((len(texts), len(self.names)), np.int64)
        state = np.repeat(self.roots[None], len(texts), 0)
        wave, size = [], 0
        for i, text in enumerate(texts):
            for at in range(0, len(text), WAVE_BYTES):
                part = text[at:at + WAVE_BYTES]
                if size + len(part) > WAVE_BYTES:
                    self._wave(wave, total, state)
                    wave, size = [], 0
                wave.append((i, part))
                size += len(part)
        self._wave(wave, total, state)
        return total + (state != self.roots)  # a text's last phrase is ended by its end

    def _wave(self, wave, total, state):
        if not wave:
            return
        lens = np.array([len(p) for _, p in wave])
        segs = -(-lens // SEGMENT)
        owner = np.repeat(np.arange(len(wave)), segs)
        first = np.concatenate(([0], np.cumsum(segs)[:-1]))
        sizes = np.full(len(owner), SEGMENT)
        sizes[first + segs - 1] = lens - (segs - 1) * SEGMENT
        flat = self.symbol.astype(self.table.dtype)[np.frombuffer(b"".join(p for _, p in wave), np.uint8)]
        text = np.zeros((len(owner), SEGMENT), np.uint8 if flat.max() < 256 else flat.dtype)
        text[np.arange(SEGMENT) < sizes[:, None]] = flat  # segments are in the order of the bytes
        doc = np.array([i for i, _ in wave])
        entry = np.repeat(self.roots[None], len(owner), 0)
        entry[first] = state[doc]
        order = np.argsort(-sizes, kind="stable")
        out, ended, mid, mid_ended = (np.empty_like(entry) if k % 2 == 0 else np.empty(entry.shape, np.int64) for k in range(4))
        out[order], ended[order], mid[order], mid_ended[order] = self._walk(text, order, sizes[order], entry[order])
        later = np.ones(len(owner), bool)
        later[first] = False
        dirty = np.flatnonzero(later)
        while len(dirty):
            true = out[dirty - 1]
            dirty = dirty[(true != entry[dirty]).any(1)]
            if not len(dirty):
                break
            entry[dirty] = out[dirty - 1]
            dirty = dirty[np.argsort(-sizes[dirty], kind="stable")]
            v, n, _, _ = self._walk(text, dirty, sizes[dirty], entry[dirty], SYNC)
            met = (v == mid[dirty]).all(1)
            same = dirty[met]
            ended[same] += n[met] - mid_ended[same]
            mid_ended[same] = n[met]
            rest, changed = dirty[~met], np.empty(0, np.int64)
            if len(rest):
                was = out[rest].copy()
                out[rest], ended[rest], mid[rest], mid_ended[rest] = self._walk(text, rest, sizes[rest], entry[rest])
                changed = rest[(out[rest] != was).any(1)]
            dirty = changed + 1
            dirty = dirty[dirty < len(owner)]
            dirty = dirty[later[dirty]]
        np.add.at(total, doc[owner], ended)
        state[doc] = out[first + segs - 1]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float | None]]:
        """(language, score, bits a byte) of each text."""
        fine = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if self.names else []
        data = [texts[i].lower().encode("utf-8", "replace") for i in fine]
        out: list = [("und", 0.0, None)] * len(texts)
        if not fine:
            return out
        bits = self.counts(data) * self.cost / np.array([[len(d)] for d in data])
        best = bits.argmin(1)
        for k, i in enumerate(fine):
            two = np.sort(bits[k])[:2]
            score = float(two[1] / (two[0] + two[1])) if len(two) > 1 else 1.0
            out[i] = (self.names[best[k]], score, float(bits[k, best[k]]))
        return out


def fit_sample(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
               learn=None, rows: int = ROWS_PER_LANGUAGE, chars: int = CHARS_PER_ROW) -> dict[str, bytes]:
    """The labelled sample, language -> bytes: of the rows where ``learn`` holds, for each
    non-null language the ``rows`` first by a hash of the id among those with a letter,
    ``chars`` characters of each at most. The ranking is limited before its shuffle. At
    most ``MAX_LANGUAGES`` labels (an error beyond), so the driver gets a bounded sample."""
    i, t, n, h, r = fresh([], "i", "t", "n", "h", "r")
    d = docs.where(F.coalesce(learn, F.lit(False))) if learn is not None else docs
    d = (d.where(F.col(lang).isNotNull() & F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
         .select(F.col(doc_id).alias(i), F.substring(F.col(text), 1, chars).alias(t), F.col(lang).alias(n))
         .withColumn(h, F.xxhash64(i)))
    by = Window.partitionBy(n).orderBy(h, i, t)
    found = (d.withColumn(r, F.row_number().over(by)).where(F.col(r) <= rows)
             .select(n, r, t).limit(MAX_LANGUAGES * rows + 1).collect())
    if len({x[n] for x in found}) > MAX_LANGUAGES or len(found) > MAX_LANGUAGES * rows:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    out: dict[str, list[bytes]] = {}
    for x in sorted(found, key=lambda x: (x[n], x[r])):
        out.setdefault(x[n], []).append(x[t].lower().encode("utf-8", "replace"))
    return {k: b"\n".join(v) for k, v in out.items()}


_PARSERS: dict[int, tuple[dict, Parser]] = {}


def _parser(samples: dict[str, bytes]) -> Parser:
    key = hash(tuple(sorted(samples.items())))
    if key not in _PARSERS:
        _PARSERS.clear()  # a worker keeps the tables of one model
        _PARSERS[key] = (samples, Parser(samples))
    return _PARSERS[key][1]


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """``texts`` in slices of at most ``ROWS`` rows and ``WAVE_BYTES`` bytes, or one longer text:
    only a slice is held as Python objects."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + WAVE_BYTES, side="right"))
        to = min(max(at + 1, to), at + ROWS)
        yield texts.slice(at, to - at)
        at = to


def predictions(batches: Iterator[pa.Array], samples: dict[str, bytes]) -> Iterator[pa.Array]:
    """A struct ``(lang_pred, score, bits_per_byte)`` for each text. A worker outlives the task and then
    keeps the model's tables only, as the stages that follow need the memory."""
    parser = _parser(samples)
    texts = some = None
    for texts in batches:
        found = []
        for some in slices(texts):
            found += parser.predict(some.to_pylist())
        cols = list(zip(*found)) or [(), (), ()]
        yield pa.StructArray.from_arrays(
            [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.float64())],
            ["lang_pred", "score", "bits_per_byte"])
    texts = some = found = cols = None
    release()


def language(text, samples: dict[str, bytes]):
    """A struct column ``(lang_pred, score, bits_per_byte)`` of a text column."""

    @arrow_udf("struct<lang_pred:string,score:double,bits_per_byte:double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from predictions(batches, samples)

    # else a filter on the result would be pushed below the projection and parse every text twice
    return run.asNondeterministic()(F.col(text))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             rows: int = ROWS_PER_LANGUAGE, chars: int = CHARS_PER_ROW, folds: int = 3, held: int = 1) -> DataFrame:
    """``docs`` with ``held_out, lang_pred, score, bits_per_byte``.

    Rows whose crc32(id as text) mod ``folds`` is ``held`` are held out and never learnt
    from, nor are rows with a null id. ``lang_pred`` is a learned language, or ``und`` (score 0,
    bits null) if the text is null or has no letter or no language was learned;
    ties go to the first name by code point. ``score``: the runner-up's bits over those of the best two (0.5 to 1;
    1 if one language was learned). Language and id are no inputs of a prediction.
    Every row and other column is kept; the four columns replace input columns of these
    names. No shuffle besides the sample's.
    """
    fold = crc_mod(doc_id, folds)
    samples = fit_sample(docs, doc_id, text, lang, fold != held, rows, chars)
    (s,) = fresh(docs.columns, "_language")
    own = ["held_out", "lang_pred", "score", "bits_per_byte"]
    found = docs.withColumn(s, language(text, samples)).withColumn(own[0], F.coalesce(fold == held, F.lit(False)))
    return found.withColumns({c: F.col(s)[c] for c in own[1:]}).drop(s)
