"""Symbol normalisation and lexicographic routing, as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the routing rule: letters weigh base 26 over the first five
# bytes of the upper-cased key; a key with no bytes falls back to hashing.
POSITION_BYTES = 5
RADIX = 26.0
# The Unicode White_Space code points, stripped at both ends
# (a plain F.trim strips U+0020 only).
WHITE_SPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_space(c: Column | str) -> Column:
    """Remove White_Space characters at both ends (a character-set trim, no regex)."""
    return F.trim(_col(c), F.lit(WHITE_SPACE))


def normalise_symbol(c: Column | str) -> Column:
    """Trim Unicode white space at both ends, then upper-case."""
    return F.upper(strip_space(c))


def lex_position(c: Column | str) -> Column:
    """Position of a key in [0, 1): sum of letter values (A=0 .. Z=25) times 26^-(i+1).

    Works on the first five UTF-8 bytes of the upper-cased key; any byte that
    is not an ASCII letter counts 0 (after upper-casing no a-z byte is left, so
    only A-Z is tested). Decoding the UTF-8 bytes as ISO-8859-1 turns each byte
    into one character whose code is the byte value, so ``ascii(substring(...))``
    reads byte i. Weights are divided down by 26 in double precision in the
    routing rule's order, so results agree to the last bit.
    """
    latin1 = F.decode(F.encode(F.upper(_col(c)), "UTF-8"), "ISO-8859-1")
    score = F.lit(0.0)
    weight = 1.0 / RADIX
    for i in range(POSITION_BYTES):
        letter = F.ascii(F.substring(latin1, i + 1, 1)) - 65
        value = F.when((letter >= 0) & (letter <= 25), letter).otherwise(0)
        score = score + value.cast("double") * F.lit(weight)
        weight /= RADIX
    return score


def lex_bucket(c: Column | str, n: int) -> Column:
    """Alphabetical bucket in [0, n): floor(position * n), clamped to n - 1."""
    return F.least(F.floor(lex_position(c) * F.lit(float(n))), F.lit(n - 1)).cast("int")


def route(symbol: Column | str, fallback_key: Column | str, n: int) -> Column:
    """Partition of a request: alphabetical by symbol; hash of another key when the symbol is empty."""
    s = _col(symbol)
    hashed = F.pmod(F.xxhash64(_col(fallback_key)), F.lit(n)).cast("int")
    return F.when(F.coalesce(F.length(s), F.lit(0)) == 0, hashed).otherwise(lex_bucket(s, n))


# Fixed values of the 32-bit FNV-1a hash.
FNV_BASIS, FNV_PRIME = 2166136261, 16777619


def hash_bucket(key: Column | str, n: int) -> Column:
    """Partition of a keyed message in [0, n): 32-bit FNV-1a of the key's UTF-8 bytes, taken as a signed number, its
    remainder without the sign."""
    data = F.hex(F.encode(_col(key), "UTF-8"))
    places = F.sequence(F.lit(0), F.greatest(F.length(data) / 2 - 1, F.lit(0)).cast("int"))
    byte = lambda i: F.conv(F.substring(data, i * 2 + 1, F.lit(2)), 16, 10).cast("long")
    step = lambda h, i: (h.bitwiseXOR(byte(i)) * FNV_PRIME).bitwiseAND(F.lit((1 << 32) - 1))
    start = F.lit(FNV_BASIS).cast("long")
    hashed = F.when(F.length(data) == 0, start).otherwise(F.aggregate(places, start, step))
    signed = F.when(hashed >= 1 << 31, hashed - (1 << 32)).otherwise(hashed)
    return F.abs(signed % n).cast("int")
