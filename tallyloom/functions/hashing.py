"""32-bit string hashes and the bit arithmetic behind the sketches."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallyloom.functions.columns import as_column

HASH_BITS = 32
_UINT32 = 0xFFFFFFFF


def _first_word(hex_digest: Column) -> Column:
    """The first four bytes of a hex digest, read big-endian, as bigint."""
    return F.conv(F.substring(hex_digest, 1, 8), 16, 10).cast("bigint")


def byte_swap32(word: Column) -> Column:
    """Reverse the four bytes of an unsigned 32-bit value held in a bigint."""
    return (
        F.shiftleft(word.bitwiseAND(0xFF), 24)
        .bitwiseOR(F.shiftleft(word.bitwiseAND(0xFF00), 8))
        .bitwiseOR(F.shiftright(word, 8).bitwiseAND(0xFF00))
        .bitwiseOR(F.shiftright(word, 24))
    )


def hash32_sha256(value: Column | str) -> Column:
    """Little-endian first word of SHA-256 over UTF-8, 0..2^32-1; null stays null."""
    return byte_swap32(_first_word(F.sha2(as_column(value).cast("string"), 256)))


def hash64_sha256(value: Column | str) -> Column:
    """Little-endian first eight bytes of SHA-256 over UTF-8, as the bits of a bigint; null stays null."""
    digest = F.sha2(as_column(value).cast("string"), 256)
    low = byte_swap32(_first_word(digest))
    high = byte_swap32(F.conv(F.substring(digest, 9, 8), 16, 10).cast("bigint"))
    return F.shiftleft(high, 32).bitwiseOR(low)


def hash32_md5(value: Column | str, signed: bool = True) -> Column:
    """Big-endian first word of MD5 over UTF-16LE, as signed int32 by default."""
    word = _first_word(F.md5(F.encode(as_column(value).cast("string"), "UTF-16LE")))
    return _to_signed(word) if signed else word


def _to_signed(word: Column) -> Column:
    return F.when(word >= 1 << 31, word - (1 << 32)).otherwise(word)


def hash31_poly(value: Column | str) -> Column:
    """``31*h + unit`` over UTF-16 code units on wrapping int32, then ``abs``."""
    mask = F.lit(_UINT32)

    def add(h: Column, char: Column) -> Column:
        point = F.ascii(char).cast("bigint")
        beyond = point - 0x10000
        high = F.shiftright(beyond, 10) + 0xD800
        low = beyond.bitwiseAND(0x3FF) + 0xDC00
        one = h * 31 + point
        two = (h * 31 + high) * 31 + low
        return F.when(point < 0x10000, one).otherwise(two).bitwiseAND(mask)

    chars = F.filter(F.split(as_column(value).cast("string"), ""), lambda char: char != "")
    return F.abs(_to_signed(F.aggregate(chars, F.lit(0).cast("bigint"), add)))


def bit_length32(value: Column) -> Column:
    """Number of significant bits of a value in 0..2^32-1 (0 for 0).

    Half is added so that the logarithm never sits on an integer: its distance
    to the nearest one stays far above double rounding for 32-bit values.
    """
    return (F.floor(F.log2(value + F.lit(0.5))) + 1).cast("int")


def bit_length64(value: Column) -> Column:
    """Number of significant bits of 64 (0 for 0), from its two 32-bit words, which doubles hold exactly."""
    high = F.shiftrightunsigned(value, 32)
    return F.when(high > 0, bit_length32(high) + 32).otherwise(bit_length32(value.bitwiseAND(_UINT32)))


def count_leading_zeros(value: Column | str, width: Column | int) -> Column:
    """Leading zero bits of ``value`` in a ``width``-bit window; ``width`` for 0."""
    width = F.lit(width) if isinstance(width, int) else width
    return (width - bit_length32(as_column(value))).cast("int")


def bucket_of(hash_value: Column, precision: Column | int) -> Column:
    """Register index: the low ``precision`` bits of the hash."""
    if isinstance(precision, int):
        mask = F.lit((1 << precision) - 1)
    else:
        mask = F.call_function("shiftleft", F.lit(1), precision) - 1
    return hash_value.bitwiseAND(mask).cast("int")


def rank_of(hash_value: Column, precision: Column | int, hash_bits: int = HASH_BITS) -> Column:
    """One more than the leading zeros of the bits above the register index."""
    if hash_bits == 64:
        precision = F.lit(precision) if isinstance(precision, int) else precision
        above = F.call_function("shiftrightunsigned", hash_value, precision)
        return (F.lit(64) - precision - bit_length64(above) + F.lit(1)).cast("int")
    precision = F.lit(precision) if isinstance(precision, int) else precision
    above = F.call_function("shiftright", hash_value, precision)
    return count_leading_zeros(above, F.lit(HASH_BITS) - precision) + F.lit(1)
