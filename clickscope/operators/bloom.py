"""Anti join that shuffles only the rows that may have a partner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

FILTER_BITS = 22   # the filter has 2 ** FILTER_BITS bits: 65,536 narrow rows at most, whatever it holds


def _word(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << (bits - 6)))


def _mask(key: Column) -> Column:
    """Three bits of a word, from other bits of the hash than the word's place."""
    h = F.xxhash64(key, F.lit(1))
    one = F.lit(1).cast("bigint")
    return (F.call_function("shiftleft", one, h.bitwiseAND(63).cast("int"))
            .bitwiseOR(F.call_function("shiftleft", one, F.shiftright(h, 6).bitwiseAND(63).cast("int")))
            .bitwiseOR(F.call_function("shiftleft", one, F.shiftright(h, 12).bitwiseAND(63).cast("int"))))


def bloom_filter(keys: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """``(word, held)``: a Bloom filter over a column, a row for each word that holds any bit."""
    k = F.col(key)
    return (keys.where(k.isNotNull()).select(_word(k, bits).alias("word"), _mask(k).alias("mask"))
            .groupBy("word").agg(F.bit_or("mask").alias("held")))


def with_maybe(rows: DataFrame, key: str, words: DataFrame, maybe: str, bits: int = FILTER_BITS) -> DataFrame:
    """``rows`` with the flag ``maybe``: false only where the filter's source hasn't the key."""
    k, mask = F.col(key), _mask(F.col(key))
    w = F.broadcast(words.withColumnsRenamed({"word": "_word", "held": "_held"}))  # bounded by FILTER_BITS
    return (rows.join(w, _word(k, bits) == F.col("_word"), "left")
            .withColumn(maybe, F.coalesce(k.isNotNull() & (F.col("_held").bitwiseAND(mask) == mask), F.lit(False)))
            .drop("_word", "_held"))


def split_anti_join(rows: DataFrame, listed: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """``rows`` whose ``key`` isn't in ``listed`` (null keys stay).

    A Bloom filter of bounded size over the listed keys, broadcast, divides the rows: those it doesn't hold are
    surely not listed and go on where they are, and only the rest, near the listed share, is shuffled and joined.
    More keys than the filter has room for only make the rest larger.
    """
    flagged = with_maybe(rows, key, bloom_filter(listed, key, bits), "_maybe", bits)
    sure = flagged.where(~F.col("_maybe")).drop("_maybe")
    rest = flagged.where("_maybe").drop("_maybe").join(listed.select(key), key, "left_anti")
    return sure.select(*rows.columns).unionByName(rest.select(*rows.columns))
