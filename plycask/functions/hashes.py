"""Hash keys of positions, as decimal strings of unsigned 64-bit numbers, and identifiers of games."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_M = (1 << 64) - 1
#: Fixed values of the public CityHash64 algorithm.
_K0, _K1, _K2, _KMUL = 0xC3A5C85C97CB3127, 0xB492B66FBE98F273, 0x9AE16A3B2F90404F, 0x9DDFEA08EB382D69


def sha_key(text: Column) -> Column:
    """The first eight bytes of the SHA-256, read as a little-endian number."""
    digest = F.substring(F.sha2(F.encode(text, "UTF-8"), 256), 1, 16)
    little = F.concat(*(F.substring(digest, 15 - 2 * i, 2) for i in range(8)))
    return F.conv(little, 16, 10)


def numeric(key: Column) -> Column:
    """For ordering: as text, 9 would come after 18446744073709551615."""
    return key.cast("decimal(20,0)")


def _fetch(s: bytes, at: int, n: int = 8) -> int:
    return int.from_bytes(s[at : at + n], "little")


def _rotate(x: int, n: int) -> int:
    x &= _M
    return ((x >> n) | (x << (64 - n))) & _M


def _swap(x: int) -> int:
    return int.from_bytes((x & _M).to_bytes(8, "little"), "big")


def _shift_mix(x: int) -> int:
    x &= _M
    return x ^ (x >> 47)


def _two(u: int, v: int, mul: int = _KMUL) -> int:
    a = _shift_mix((u ^ v) * mul)
    b = _shift_mix(((v & _M) ^ a) * mul)
    return (b * mul) & _M


def _weak(s: bytes, at: int, a: int, b: int) -> tuple[int, int]:
    w, x, y, z = (_fetch(s, at + 8 * i) for i in range(4))
    a += w
    b = _rotate(b + a + z, 21)
    c = a
    a += x + y
    b += _rotate(a, 44)
    return (a + z) & _M, (b + c) & _M


def city64(s: bytes) -> int:
    """CityHash64."""
    n = len(s)
    mul = (_K2 + 2 * n) & _M
    if n == 0:
        return _K2
    if n < 4:
        return (_shift_mix((s[0] + (s[n >> 1] << 8)) * _K2 ^ (n + (s[n - 1] << 2)) * _K0) * _K2) & _M
    if n < 8:
        return _two(n + (_fetch(s, 0, 4) << 3), _fetch(s, n - 4, 4), mul)
    if n <= 16:
        a, b = _fetch(s, 0) + _K2, _fetch(s, n - 8)
        return _two((_rotate(b, 37) * mul + a) & _M, ((_rotate(a, 25) + b) * mul) & _M, mul)
    if n <= 32:
        a, b, c, d = _fetch(s, 0) * _K1, _fetch(s, 8), _fetch(s, n - 8) * mul, _fetch(s, n - 16) * _K2
        return _two((_rotate(a + b, 43) + _rotate(c, 30) + d) & _M, (a + _rotate(b + _K2, 18) + c) & _M, mul)
    if n <= 64:
        a, b, c, d = _fetch(s, 0) * _K2, _fetch(s, 8), _fetch(s, n - 24), _fetch(s, n - 32)
        e, f, g, h = _fetch(s, 16) * _K2, _fetch(s, 24) * 9, _fetch(s, n - 8), _fetch(s, n - 16) * mul
        u = _rotate(a + g, 43) + (_rotate(b, 30) + c) * 9
        v = (((a + g) & _M) ^ d) + f + 1
        w = _swap((u + v) * mul) + h
        x = _rotate(e + f, 42) + c
        y = (_swap((v + w) * mul) + g) * mul
        z = e + f + c
        a = _swap((x + z) * mul + y) + b
        return (_shift_mix((z + a) * mul + d + h) * mul + x) & _M
    x = _fetch(s, n - 40)
    y = _fetch(s, n - 16) + _fetch(s, n - 56)
    z = _two((_fetch(s, n - 48) + n) & _M, _fetch(s, n - 24))
    v, w = _weak(s, n - 64, n, z), _weak(s, n - 32, y + _K1, x)
    x = x * _K1 + _fetch(s, 0)
    for at in range(0, (n - 1) & ~63, 64):
        x = _rotate(x + y + v[0] + _fetch(s, at + 8), 37) * _K1
        y = _rotate(y + v[1] + _fetch(s, at + 48), 42) * _K1
        x = (x ^ w[1]) & _M
        y = (y + v[0] + _fetch(s, at + 40)) & _M
        z = (_rotate(z + w[0], 33) * _K1) & _M
        v = _weak(s, at, v[1] * _K1, x + w[0])
        w = _weak(s, at + 32, z + w[1], y + _fetch(s, at + 16))
        z, x = x, z
    return _two((_two(v[0], w[0]) + _shift_mix(y) * _K1 + z) & _M, (_two(v[1], w[1]) + x) & _M)


@F.pandas_udf(T.StringType())
def city_key(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """CityHash64; to be applied after aggregation, when every position is there once."""
    for series in texts:
        yield series.map(lambda text: None if text is None else str(city64(text.encode())))


def game_id(source: Column, pgn: Column) -> Column:
    """A name of 21 characters that the same game always gets, so that a repeated run makes the same tables."""
    return F.substring(F.sha2(F.concat_ws("|", source, F.trim(F.regexp_replace(pgn, r"\s+", " "))), 256), 1, 21)
