"""Line dedup by a segment-partition edit join, in DataFrame expressions only.

A line is dropped if an equal line, or another within ``edits`` edits, first occurs
earlier. Lines are cut at newlines; documents are ordered by id, then by text hash.

Near lines: a line of l characters is split into edits + 1 even segments. If another line is within
that many edits, it contains one of them at a place that the length difference allows, so
each line is indexed under (length, segment number, segment) and probes the lengths
from its own down to ``edits`` less, at the few starts that the pigeonhole argument leaves (before
and after the segment the errors share out). A bit filter of fixed size over the index
keys drops most probes that nothing answers before they are shuffled. Pairs are verified with a banded
bit-parallel edit distance. A line first meets the earliest line of each of its keys only; what that
decides isn't expanded further. An index key of more than ``HOT`` lines isn't expanded into pairs at all:
its lines are dealt into blocks, and semi joins ask only whether any earlier line is near.

Lines travel as two 64-bit hashes and lengths; texts are fetched for candidates only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickscope.llm.common import fresh, stage

EDITS = 2
MIN_CHARS = 24
HOT = 32
FREQUENT = 2000
FILTER_BITS = 26
FIRST = 16   # columns of the distance matrix after which a pair may be given up
BLANKS = " \t\n\r\x0b\f"  # a line of nothing else is white space
_LETTERS = "abcdefghijklmnopqrstuvwxyz ,."  # an edit changes all counts together by 2 at most


# ---------------------------------------------------------------- edit distance

def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _alike(a: Column, b: Column) -> Column:
    """Length of the longest common beginning, by halving steps."""
    steps = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])
    return _let(F.least(F.length(a), F.length(b)), lambda room: F.aggregate(steps, F.lit(0), lambda done, step: F.when(
        (step <= room - done) & (F.substr(a, done + 1, step) == F.substr(b, done + 1, step)), done + step).otherwise(done)))


def near(a: Column, b: Column, edits: int) -> Column:
    """Whether two texts whose lengths differ by at most ``edits`` are within that many edits.

    Column by column of the distance matrix a word of 2 * edits + 1 bits holds the rows of the band around the
    diagonal: where a cell is one more (vp) or one less (vn) than the cell above it.
    The band moves down one row with each column. The distance is followed along the band's
    lower edge, and then along the last row.
    """
    width = 2 * edits + 1
    mask = F.lit((1 << width) - 1).cast("bigint")

    def bit(word: Column, at) -> Column:
        at = at if isinstance(at, Column) else F.lit(at)
        return F.call_function("shiftright", word, at).bitwiseAND(F.lit(1))

    def within(x: Column) -> Column:
        p, t, m, n = x["p"], x["t"], x["m"], x["n"]

        def step(s: Column, j: Column) -> Column:
            def match(char: Column) -> Column:
                return reduce(lambda y, z: y.bitwiseOR(z), [
                    F.when(F.coalesce(F.get(p, j - edits + r - 1) == char, F.lit(False)), F.lit(1 << r).cast("bigint"))
                    .otherwise(F.lit(0).cast("bigint")) for r in range(width)])

            def next_state(y: Column) -> Column:
                vp, vn = s["vp"], s["vn"]
                d0 = ((y.bitwiseAND(vp) + vp).bitwiseAND(mask).bitwiseXOR(vp)).bitwiseOR(y).bitwiseOR(vn)

                def after(d: Column) -> Column:
                    hp, hn = vn.bitwiseOR(F.bitwise_not(d.bitwiseOR(vp)).bitwiseAND(mask)), d.bitwiseAND(vp)
                    down = F.shiftright(d, 1)
                    last = m + F.lit(edits) - j  # the last row's place in the band
                    return F.struct(
                        hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp)).bitwiseAND(mask)).alias("vp"),
                        down.bitwiseAND(hp).alias("vn"),
                        (s["d"] + F.when(j <= m - edits, 1 - bit(d, 2 * edits))
                         .otherwise(bit(hp, last) - bit(hn, last))).cast("bigint").alias("d"))

                return _let(d0, after)

            return _let(_let(F.get(t, j - 1), match), next_state)

        start = F.struct(F.lit(((1 << (edits + 1)) - 1) << edits).cast("bigint").alias("vp"),
                         F.lit(0).cast("bigint").alias("vn"), F.least(F.lit(edits), m).cast("bigint").alias("d"))

        def hopeless(s: Column) -> Column:  # every cell of the band's column is above the threshold
            cells = [s["d"]]
            for r in range(2 * edits, 0, -1):
                cells.append(cells[-1] - bit(s["vp"], r) + bit(s["vn"], r))
            return F.least(*cells) > edits

        # Texts that aren't near are told by the first columns.
        few = F.aggregate(F.sequence(F.lit(1), F.least(n, F.lit(FIRST))), start, step)
        whole = _let(few, lambda s: F.when(n <= FIRST, s["d"]).when((m >= FIRST + edits) & hopeless(s), F.lit(edits + 1).cast("bigint"))
                     .otherwise(F.aggregate(F.sequence(F.lit(FIRST + 1), n), s, step, lambda t: t["d"])))
        distance = F.when(n == 0, m).otherwise(whole)
        return (F.abs(m - n) <= edits) & (distance <= edits)

    def verified(x: Column) -> Column:
        split = F.struct(F.split(x["p"], "").alias("p"), F.split(x["t"], "").alias("t"), x["m"].alias("m"), x["n"].alias("n"))
        return F.when(ends_fit(x["p"], x["t"], x["m"], x["n"], edits), _let(split, within)).otherwise(False)

    # What both begin and end with alike is cut off first, which leaves the distance as it is; the
    # characters of the rest are split off once for a pair, not once for each use.
    def middles(x: Column) -> Column:
        def rest(head: Column) -> Column:
            u, v = F.substr(x["a"], head + 1), F.substr(x["b"], head + 1)
            return _let(F.struct(u.alias("u"), v.alias("v"), F.reverse(u).alias("ru"), F.reverse(v).alias("rv")), tails)

        def tails(y: Column) -> Column:
            def cut(tail: Column) -> Column:
                m, n = F.length(y["u"]) - tail, F.length(y["v"]) - tail
                return _let(F.struct(F.substr(y["u"], F.lit(1), m).alias("p"), F.substr(y["v"], F.lit(1), n).alias("t"),
                                     m.alias("m"), n.alias("n")), verified)
            return _let(_alike(y["ru"], y["rv"]), cut)

        return _let(_alike(x["a"], x["b"]), rest)

    return _let(F.struct(a.alias("a"), b.alias("b")), middles)


def ends_fit(p: Column, t: Column, m: Column, n: Column, edits: int) -> Column:
    """False only for texts more than ``edits`` edits apart, of lengths ``m`` and ``n``, that neither begin nor end alike.

    The first and the last column of any alignment are edits then. So one edit leaves one
    character at most, and two leave what lies between them equal.
    """
    short = F.least(m, n) <= 1
    if edits == 1:
        return short
    if edits != 2:
        return F.lit(True)
    ways = [(1, 1), (1, 0), (0, 1)]  # characters of either text that an edit takes
    return reduce(lambda x, y: x | y, [short, *[
        (m - i - j == n - k - l) & (F.substr(p, F.lit(1 + i), m - (i + j)) == F.substr(t, F.lit(1 + k), n - (k + l)))
        for i, k in ways for j, l in ways]])


def letter_counts(line: Column) -> Column:
    """How often each of ``_LETTERS`` occurs."""
    return F.array(*[F.length(line) - F.length(F.replace(line, F.lit(c), F.lit(""))) for c in _LETTERS])


def may_be_near(a: Column, b: Column, edits: int, a_letters: Column | None = None, b_letters: Column | None = None) -> Column:
    """False only for texts more than ``edits`` edits apart; the counts of their letters may be given."""
    x, y = (letter_counts(t) if n is None else n for t, n in ((a, a_letters), (b, b_letters)))
    apart = reduce(lambda p, q: p + q, [F.abs(x[i] - y[i]) for i in range(len(_LETTERS))])
    return (F.abs(F.length(a) - F.length(b)) <= edits) & (apart <= 2 * edits)


# ---------------------------------------------------------------- segments

def _pieces(lines: DataFrame, edits: int, places: list[tuple[int, int, int]], least: int) -> DataFrame:
    """``(h, d, key)``: for each line and each ``(less, i, shift)`` the key of segment ``i`` of a line ``less``
    characters shorter, cut out ``shift`` characters off its place."""
    k = edits + 1
    table = F.array(*[F.struct(*[F.lit(v).alias(c) for v, c in zip(x, ("less", "i", "shift"))]) for x in places])
    # In a line of ASCII only, characters are bytes: its segments are cut without a walk through the characters before them.
    plain = F.when(F.octet_length("line") == F.col("n"), F.col("line").cast("binary"))
    rows = lines.select("h", "d", "line", plain.alias("plain"), "n", F.explode(table).alias("x")).select(
        "h", "d", "line", "plain", "n", (F.col("n") - F.col("x.less")).alias("other"), F.col("x.i").alias("i"), F.col("x.shift").alias("shift"))
    base, longer = F.floor(F.col("other") / k).cast("int"), F.col("other") % k  # the last segments are longer
    start = 1 + F.col("i") * base + F.greatest(F.lit(0), F.col("i") - k + longer) + F.col("shift")
    rows = rows.select("h", "d", "line", "plain", "n", "other", "i", start.alias("at"), (base + (F.col("i") >= k - longer).cast("int")).alias("size"))
    at, size = F.col("at"), F.col("size")
    segment = F.when(F.col("plain").isNotNull(), F.substr("plain", at, size)).otherwise(F.substr("line", at, size).cast("binary"))
    return (rows.where((F.col("other") >= least) & (at >= 1) & (at + size - 1 <= F.col("n")))
            .select("h", "d", F.xxhash64("other", "i", segment).alias("key")))


def index_keys(lines: DataFrame, edits: int, least: int) -> DataFrame:
    return _pieces(lines, edits, [(0, i, 0) for i in range(edits + 1)], least)


def probe_keys(lines: DataFrame, edits: int, least: int) -> DataFrame:
    """Keys of lines of the same length or up to ``edits`` less that may be near, but for a line's
    own index keys: lines that share one of those meet in the index."""
    places = [(less, i, shift) for less in range(edits + 1) for i in range(edits + 1)
              for shift in range(max(-i, less - (edits - i)), min(i, less + (edits - i)) + 1) if less or shift]
    return _pieces(lines, edits, places, least)


def bit_filter(keys: DataFrame, key: str) -> DataFrame:
    """A Bloom filter of ``2 ** FILTER_BITS`` bits, three for a key in one word: at most a 64th as
    many narrow rows, whatever ``keys`` holds."""
    word, mask = _bits(F.col(key))
    return keys.select(word.alias("word"), mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("bits"))


def _bits(key: Column) -> tuple[Column, Column]:
    def one(low: int) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(key, low).bitwiseAND(F.lit(63)).cast("int"))
    return F.pmod(key, F.lit(1 << (FILTER_BITS - 6))), one(30).bitwiseOR(one(38)).bitwiseOR(one(46))


def may_hold(rows: DataFrame, key: str, words: DataFrame) -> DataFrame:
    """``rows`` without most of those whose key the filter's source doesn't hold."""
    word, mask = _bits(F.col(key))
    return (rows.join(F.broadcast(words), word == F.col("word"))  # a bounded table
            .where(F.col("bits").bitwiseAND(mask) == mask).select(*rows.columns))


# ---------------------------------------------------------------- the operator

def lines_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(d, th, pos, line, h, g, n)``: each line with its document's id and text hash, two hashes and length."""
    return (docs.where(F.col(text).isNotNull())
            .select(F.col(doc_id).alias("d"), F.xxhash64(text).alias("th"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
            .select("*", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("g"), F.length("line").alias("n")))


def near_later(lines: DataFrame, firsts: DataFrame, edits: int, least: int, hot: int = HOT) -> DataFrame:
    """``(h)``: distinct lines that have a near line whose first occurrence is earlier.

    ``lines`` as from :func:`lines_of`, ``firsts``: ``(h, g, first, times)``.
    """
    # Lines are keyed at every occurrence (only the first of very frequent ones, of which
    # there can be FREQUENT at most) and made distinct where a key's rows meet.
    total = firsts.agg(F.sum("times")).first()[0] or 0
    frequent = (firsts.where(F.col("times") >= max(2, -(-total // FREQUENT)))
                .select(F.col("h").alias("fh"), F.col("g").alias("fg"), "first"))
    here = F.struct("d", "th", "pos")
    keyed = (lines.where(F.col("n") >= least)
             .join(F.broadcast(frequent), (F.col("h") == F.col("fh")) & (F.col("g") == F.col("fg")), "left")
             .where(F.col("first").isNull() | (here == F.col("first"))))

    # The index: the lines of each key, earliest documents first, in lists: the first of HOT + 1 lines, which tells
    # a hot key, the others of HOT.
    index = (index_keys(keyed, edits, least).repartition("key")  # one shuffle, by key
             .groupBy("key", "h").agg(F.min("d").alias("d")))
    by_age = Window.partitionBy("key").orderBy("d", "h")
    rn, after = F.col("rn"), F.col("rn") - (hot + 2)  # from 0 after the first list
    lists = stage(index.withColumn("rn", F.row_number().over(by_age))
                  .withColumn("ids", F.collect_list("h").over(by_age.rowsBetween(0, hot)))  # a list starts at this line
                  .where((rn == 1) | ((after >= 0) & (after % hot == 0)))
                  .select("key", F.when(rn == 1, 0).otherwise(F.floor(after / hot) + 1).cast("int").alias("part"),
                          F.when(rn == 1, F.col("ids")).otherwise(F.slice("ids", 1, hot)).alias("ids")), "line_index")
    groups = lists.where("part = 0").select("key", "ids")
    # Probes, most of which no key answers, pass a filter of bounded size before they are shuffled.
    probes = may_hold(probe_keys(keyed, edits, least).drop("d"), "key", stage(bit_filter(groups, "key"), "line_filter"))
    met = stage(probes.distinct().join(groups, "key"), "line_matches")
    shared = groups.where(F.size("ids") > 1)
    hot_keys = stage(groups.where(F.size("ids") > hot).select("key", F.col("ids")[0].alias("least")), "line_hot_keys")
    hot_index = stage(lists.where((F.col("part") > 0) | (F.size("ids") > hot)).select("key", F.explode("ids").alias("h"))
                      .join(hot_keys, "key"), "line_hot_index")
    heat = stage(met.where(F.size("ids") > hot).select("key", "h", F.col("ids")[0].alias("least")).union(hot_index), "line_heat")

    cold_met, cold_shared = met.where(F.size("ids") <= hot), shared.where(F.size("ids") <= hot)
    members = cold_shared.select("key", F.explode("ids").alias("h"))
    answered = groups.join(cold_met.select("key").distinct(), "key", "left_semi").select(F.explode("ids").alias("h"))
    wanted = stage(met.select("h").union(answered).union(members.select("h")).union(heat.select("h")).distinct(), "line_wanted")
    # staged, or the semi join below would be planned before the filter and shuffle all lines
    some = stage(may_hold(keyed.select("h", "g", "line"), "h", stage(bit_filter(wanted, "h"), "line_filter")), "line_some")
    texts = stage(some.join(wanted, "h", "left_semi").groupBy("h", "g").agg(F.first("line").alias("line"))
                  .join(firsts.select("h", "g", "first"), ["h", "g"])
                  .select("h", "line", "first", letter_counts(F.col("line")).alias("letters")), "line_texts")

    def named(tag: str) -> DataFrame:
        return texts.select(*[F.col(c).alias(f"{tag}{c}") for c in texts.columns])

    a, b = F.col("aline"), F.col("bline")
    alike = may_be_near(a, b, edits, F.col("aletters"), F.col("bletters"))

    def verified(pairs: DataFrame) -> DataFrame:
        """The later line of each pair of near ones."""
        pairs = (pairs.where("h <> other").select(F.least("h", "other").alias("h"), F.greatest("h", "other").alias("other")).distinct())
        both = pairs.join(named("a"), F.col("h") == F.col("ah")).join(named("b"), F.col("other") == F.col("bh"))
        later = F.when(F.col("afirst") < F.col("bfirst"), F.col("bh")).otherwise(F.col("ah"))
        return both.where(alike).where(near(a, b, edits)).select(later.alias("h"))

    # A line is decided by one near line before it. So each line first meets only the earliest line of
    # each of its keys, which leaves few of a family of near copies to be compared with one another.
    one = (cold_met.select("h", F.col("ids")[0].alias("other"))
           .union(cold_shared.select(F.explode(F.slice("ids", 2, hot)).alias("h"), F.col("ids")[0].alias("other")))
           .union(heat.select("h", F.col("least").alias("other"))))
    decided = stage(verified(one).distinct(), "line_decided")
    undecided = stage(texts.select("h").join(decided, "h", "left_anti"), "line_open")

    # Then whatever pair has an undecided line, but for those just compared.
    rest = F.slice("ids", 2, hot)
    open_ids = stage(groups.where(F.size("ids") <= hot).select("key", F.explode("ids").alias("h"))
                     .join(undecided, "h", "left_semi").groupBy("key").agg(F.collect_list("h").alias("open")), "line_open_keys")
    cold = verified(cold_met.join(undecided, "h", "left_semi").select("h", F.explode(rest).alias("other"))
                    .union(cold_met.join(open_ids, "key").select("h", F.explode(F.array_except("open", F.array(F.col("ids")[0]))).alias("other")))
                    .union(cold_shared.join(open_ids, "key").select(F.explode("open").alias("h"), rest.alias("ids"))
                           .select("h", F.explode("ids").alias("other"))))

    # Keys of more than HOT lines aren't expanded: their lines are dealt into blocks.
    blocks = hot_index.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / hot).alias("blocks"))

    def side(rows: DataFrame, tag: str) -> DataFrame:
        rows = rows.drop("least").join(blocks, "key").join(named(tag), F.col("h") == F.col(f"{tag}h")).withColumnRenamed("key", f"{tag}key")
        if tag == "a":
            return rows.withColumn("ablock", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).drop("h", "blocks")
        return rows.withColumn("bblock", F.pmod(F.xxhash64("bh"), F.col("blocks"))).drop("h", "blocks")

    meet = ((F.col("akey") == F.col("bkey")) & (F.col("ablock") == F.col("bblock")) & (F.col("ah") != F.col("bh"))
            & alike & near(a, b, edits))
    open_heat, open_index = heat.join(undecided, "h", "left_semi"), hot_index.join(undecided, "h", "left_semi")
    warm = (side(open_heat, "a").join(side(hot_index, "b"), meet & (F.col("bfirst") < F.col("afirst")), "left_semi").select(F.col("ah").alias("h"))
            .union(side(open_index, "b").join(side(heat, "a"), meet & (F.col("afirst") < F.col("bfirst")), "left_semi").select(F.col("bh").alias("h"))))
    return decided.union(cold).union(warm).distinct()


def line_decisions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", edits: int = EDITS,
                   min_chars: int = MIN_CHARS, hot: int = HOT) -> DataFrame:
    """``(d, th, n_exact, n_near, dropped)`` of each document that loses a line.

    ``d`` is the id, ``th`` xxhash64 of its text; ``dropped`` lists line numbers (from 0).
    """
    # From the left only: a line that isn't blank is told by its first characters.
    lines = lines_of(docs, doc_id, text).where(F.ltrim("line", F.lit(BLANKS)) != "")
    narrow = stage(lines.drop("line"), "line_rows")
    firsts = stage(narrow.groupBy("h", "g").agg(F.min(F.struct("d", "th", "pos")).alias("first"),
                                                F.count(F.lit(1)).alias("times")), "line_firsts")
    again = stage(near_later(lines, firsts, edits, min_chars, hot).withColumn("again", F.lit(True)), "line_near")
    flags = stage(firsts.join(again, "h", "left").where("times > 1 or again")
                  .select("h", "g", "first", F.coalesce("again", F.lit(False)).alias("again")), "line_flags")
    first = F.struct("d", "th", "pos") == F.col("first")
    return (narrow.select("d", "th", "pos", "h", "g").join(flags, ["h", "g"]).where(~first | F.col("again"))
            .groupBy("d", "th").agg(F.size(F.collect_set(F.when(~first, F.col("pos")))).cast("bigint").alias("n_exact"),
                                    F.size(F.collect_set(F.when(first, F.col("pos")))).cast("bigint").alias("n_near"),
                                    F.sort_array(F.collect_set("pos")).alias("dropped")))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", edits: int = EDITS,
                min_chars: int = MIN_CHARS, hot: int = HOT) -> DataFrame:
    """``docs`` with the text of the kept lines, and ``n_lines, n_exact, n_near, dropped``.

    ``n_lines`` counts the lines of the input text (null: 0), ``n_exact`` dropped repeats of an earlier equal
    line, ``n_near`` first occurrences dropped for an earlier near line; lines of fewer than
    ``min_chars`` characters are near to nothing, lines of white space are never
    dropped. A line without an earlier near one stays even if it has later ones. A text whose lines are all
    dropped becomes empty. A null id is before any other; rows with equal id and text are one
    document and get the same decisions. Every row and other column is kept (the four columns
    replace input columns of these names).
    """
    (th,) = fresh(docs.columns, "_th")
    d = line_decisions(docs, doc_id, text, edits, min_chars, hot)
    d = d.toDF(*[f"_l_{c}" for c in d.columns])
    whole = F.split(F.col(text), "\n")
    kept = F.array_join(F.filter(whole, lambda x, i: ~F.array_contains(F.col("_l_dropped"), i)), "\n")
    own = docs.withColumn(th, F.xxhash64(text)).join(
        d, F.col(doc_id).eqNullSafe(F.col("_l_d")) & (F.col(th) == F.col("_l_th")), "left")
    new = {text: F.when(F.col("_l_dropped").isNull(), F.col(text)).otherwise(kept),
           "n_lines": F.when(F.col(text).isNull(), 0).otherwise(F.size(whole)).cast("bigint"),
           "n_exact": F.coalesce("_l_n_exact", F.lit(0).cast("bigint")),
           "n_near": F.coalesce("_l_n_near", F.lit(0).cast("bigint")),
           "dropped": F.coalesce("_l_dropped", F.array().cast("array<int>"))}
    return own.withColumns(new).drop(th, *d.columns)
