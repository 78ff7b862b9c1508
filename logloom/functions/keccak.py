"""Keccak-256 (the pre-standard padding used for Ethereum hashes).

Used only inside ``mapInPandas`` over the *distinct* canonical signatures of
the registry job, never per log row. Round constants and rotation offsets are
generated from their defining rules (FIPS 202, section 3).
"""

from __future__ import annotations

_MASK = (1 << 64) - 1
_RATE = 136  # bytes, for a 256-bit output


def _round_constants() -> list[int]:
    out = []
    r = 1  # LFSR state of x^8 + x^6 + x^5 + x^4 + 1

    def step():
        nonlocal r
        bit = r & 1
        r <<= 1
        if r & 0x100:
            r ^= 0x171
        return bit

    for _ in range(24):
        rc = 0
        for j in range(7):
            if step():
                rc |= 1 << ((1 << j) - 1)
        out.append(rc)
    return out


def _rotation_offsets() -> list[list[int]]:
    rot = [[0] * 5 for _ in range(5)]
    x, y = 1, 0
    for t in range(24):
        rot[x][y] = ((t + 1) * (t + 2) // 2) % 64
        x, y = y, (2 * x + 3 * y) % 5
    return rot


_RC = _round_constants()
_ROT = _rotation_offsets()


def _rotl(v: int, n: int) -> int:
    return ((v << n) | (v >> (64 - n))) & _MASK if n else v


def _permute(a: list[list[int]]) -> None:
    for rc in _RC:
        c = [a[x][0] ^ a[x][1] ^ a[x][2] ^ a[x][3] ^ a[x][4] for x in range(5)]
        d = [c[(x - 1) % 5] ^ _rotl(c[(x + 1) % 5], 1) for x in range(5)]
        for x in range(5):
            for y in range(5):
                a[x][y] ^= d[x]
        b = [[0] * 5 for _ in range(5)]
        for x in range(5):
            for y in range(5):
                b[y][(2 * x + 3 * y) % 5] = _rotl(a[x][y], _ROT[x][y])
        for x in range(5):
            for y in range(5):
                a[x][y] = b[x][y] ^ ((~b[(x + 1) % 5][y]) & b[(x + 2) % 5][y])
        a[0][0] ^= rc


def keccak256(data: bytes) -> bytes:
    msg = bytearray(data)
    msg.append(0x01)
    while len(msg) % _RATE:
        msg.append(0)
    msg[-1] |= 0x80
    a = [[0] * 5 for _ in range(5)]
    for off in range(0, len(msg), _RATE):
        block = msg[off:off + _RATE]
        for i in range(_RATE // 8):
            x, y = i % 5, i // 5
            a[x][y] ^= int.from_bytes(block[8 * i:8 * i + 8], "little")
        _permute(a)
    out = b"".join(a[i % 5][i // 5].to_bytes(8, "little") for i in range(4))
    return out


def keccak_hex(text: str) -> str:
    """``0x``-prefixed Keccak-256 of the UTF-8 text."""
    return "0x" + keccak256(text.encode("utf-8")).hex()
