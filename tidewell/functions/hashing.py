"""Hash functions with results fixed by an outside format."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F

# Hash of the constant feature, and the modulus of the prime hash family.
CONSTANT_HASH = 11650396
PRIME = 4294967311


def prime_hash(x: Column | str, a: int, b: int) -> Column:
    """``(a*x + b) mod PRIME`` without overflow: x is split so that all products stay below 2^63."""
    x = F.col(x) if isinstance(x, str) else x
    p = F.lit(PRIME)
    x = F.pmod(x.cast("long"), p)
    high, low = F.shiftright(x, 16), x.bitwiseAND(F.lit(0xFFFF).cast("long"))
    aa = F.lit(a % PRIME).cast("long")
    top = F.pmod(aa * high, p)  # below 2^33 * 2^17
    top = F.pmod(top * F.lit(1 << 16).cast("long"), p)
    return F.pmod(top + F.pmod(aa * low, p) + F.lit(b % PRIME).cast("long"), p)


def hash_bits(text: Column | str, part: int = 0) -> Column:
    """60 hash bits of a text as a whole number; the same in every engine that knows md5."""
    c = F.col(text) if isinstance(text, str) else text
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{part}:"), c.cast("string")).cast("binary")), 1, 15), 16, 10).cast("long")


def hash_share(cols: list[str], seed: int) -> Column:
    """Number in [0, 1) from a row's columns: a rerun after a lost executor gives every row the same one."""
    return F.pmod(hash_bits(F.concat_ws(":", *[F.col(c).cast("string") for c in cols]), seed), F.lit(1_000_000)) / 1_000_000.0


def hash_family(n: int, seed: int = 42) -> list[tuple[int, int]]:
    """``n`` distinct seeded coefficient pairs."""
    rng = np.random.default_rng(seed)
    pairs: dict[tuple[int, int], None] = {}
    while len(pairs) < n:
        pairs[(int(rng.integers(1, 2**31 - 2)), int(rng.integers(0, 2**31 - 2)))] = None
    return list(pairs)


# Fixed values of the 32-bit murmur hash (version 3): multipliers, rotations and addend of a block, multipliers of the end.
_M1, _M2, _M3, _ADD, _M4, _M5 = 0xCC9E2D51, 0x1B873593, 5, 0xE6546B64, 0x85EBCA6B, 0xC2B2AE35
_R1, _R2 = 15, 13
_MASK = 0xFFFFFFFF


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def _times(x: Column, c: int) -> Column:
    """``x * c`` modulo 2^32; the product may pass 64 bits."""
    return (x.cast("decimal(10,0)") * F.lit(c).cast("decimal(10,0)") % F.lit(1 << 32).cast("decimal(10,0)")).cast("long")


def _rotated(x: Column, by: int) -> Column:
    """Rotation to the left of 32 bits: a product modulo 2^32 - 1, where all ones stand for themselves and not for zero."""
    return (x * _long(1 << by) - _long(1)) % _long(_MASK) + _long(1)


def _bound(value: Column, then) -> Column:
    """``then(x)`` with ``x`` worked out once."""
    return F.transform(F.array(value), then)[0]


def _mixed_block(k: Column) -> Column:
    return _times(_rotated(_times(k, _M1), _R1), _M2)


def murmur3(text: Column, seed: Column) -> Column:
    """32-bit murmur hash of a text's UTF-8 bytes as a signed number; a fold over the bytes, in the JVM."""
    octets = F.transform(F.split(F.decode(F.encode(text, "UTF-8"), "ISO-8859-1"), ""), lambda c: F.ascii(c).cast("long"))
    octets = F.when(text == "", F.array().cast("array<bigint>")).otherwise(octets)
    start = F.struct(F.pmod(seed.cast("long"), _long(1 << 32)).alias("h"), _long(0).alias("k"), _long(0).alias("n"))

    def step(acc: Column, octet: Column) -> Column:
        place = acc["n"] % 4
        k = acc["k"] + F.when(place == 0, octet).when(place == 1, octet * 256).when(place == 2, octet * 65536).otherwise(octet * 16777216)
        full = place == 3
        h = F.when(full, (_rotated(acc["h"].bitwiseXOR(_mixed_block(k)), _R2) * _M3 + _long(_ADD)).bitwiseAND(_long(_MASK))).otherwise(acc["h"])
        return F.struct(h.alias("h"), F.when(full, _long(0)).otherwise(k).alias("k"), (acc["n"] + 1).alias("n"))

    def end(acc: Column) -> Column:
        h = acc["h"].bitwiseXOR(_mixed_block(acc["k"])).bitwiseXOR(acc["n"])
        for shift, c in ((16, _M4), (13, _M5)):
            h = _shifted(h, shift, c)
        h = _bound(h, lambda x: x.bitwiseXOR(F.shiftright(x, 16)))
        return _bound(h, lambda x: F.when(x > 0x7FFFFFFF, x - _long(1 << 32)).otherwise(x).cast("int"))

    return F.when(text.isNotNull(), F.aggregate(octets, start, step, end))


def _shifted(h: Column, shift: int, c: int) -> Column:
    return _bound(h, lambda x: _times(x.bitwiseXOR(F.shiftright(x, shift)), c))


def murmur3_sql(text: str, seed: str) -> str:
    """The same hash of a text's UTF-8 bytes in DuckDB, for SQL twins."""
    size = f"strlen({text})"

    def times(x: str, c: int) -> str:
        return f"(({x})::HUGEINT * {c} % {1 << 32})"

    def rotated(x: str, by: int) -> str:
        return f"list_transform([{x}], lambda r: r * {1 << by} % {1 << 32} + r // {1 << (32 - by)})[1]"

    def code(at: str) -> str:
        return f"coalesce(('0x' || nullif(substr(hex({text}), 2 * ({at}) - 1, 2), ''))::BIGINT, 0)"

    def mixed(k: str) -> str:
        return times(rotated(times(k, _M1), _R1), _M2)

    word = f"({code('4 * i + 1')} + {code('4 * i + 2')} * 256 + {code('4 * i + 3')} * 65536 + {code('4 * i + 4')} * 16777216)::HUGEINT"
    blocks = f"list_transform(range(0, {size} // 4), lambda i: {word})"
    block = f"({rotated(f'xor(h, {mixed(chr(107))})', _R2)} * {_M3} + {_ADD}) % {1 << 32}"
    body = f"list_reduce(list_prepend((({seed}) + {1 << 32})::HUGEINT % {1 << 32}, {blocks}), lambda h, k: {block})"
    tail = f"list_transform([{size} // 4], lambda i: CASE WHEN {size} % 4 = 0 THEN 0::HUGEINT ELSE {mixed(word)} END)[1]"
    h = f"xor(xor({body}, {tail}), {size}::HUGEINT)"
    for shift, c in ((16, _M4), (13, _M5)):
        h = f"list_transform([{h}], lambda x: {times(f'xor(x, x // {1 << shift})', c)})[1]"
    h = f"list_transform([{h}], lambda x: xor(x, x // 65536))[1]"
    return f"list_transform([{h}], lambda x: CASE WHEN x > {0x7FFFFFFF} THEN x - {1 << 32} ELSE x END)[1]"


def feature_hash(namespace: Column | str, feature: Column | str, label: Column, bits: int, classes: int) -> Column:
    """Weight index of a feature for one class of a one-against-all model.

    The namespace hash seeds the feature hash; whole-number features are added to it instead.
    """
    ns = F.col(namespace) if isinstance(namespace, str) else namespace
    ft = F.col(feature) if isinstance(feature, str) else feature
    stride = _stride(classes)
    ns_hash = F.when(F.coalesce(ns, F.lit("")) == "", F.lit(0)).otherwise(murmur3(ns, F.lit(0)))
    whole = ft.rlike("^-?[0-9]+$")
    base = F.when(whole, ft.try_cast("long") + ns_hash).otherwise(murmur3(ft, ns_hash).cast("long"))
    return _index(base, label, stride, bits)


def constant_hash(label: Column, bits: int, classes: int) -> Column:
    return _index(F.lit(CONSTANT_HASH).cast("long"), label, _stride(classes), bits)


def _stride(classes: int) -> int:
    return 1 << max(0, (classes - 1).bit_length())


def _index(base: Column, label: Column, stride: int, bits: int) -> Column:
    return (base * stride + label - 1).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
