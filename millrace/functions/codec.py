"""Avro binary for a record of one long: a zig-zag varint, seven bits to a byte, low bits first.

Both directions handle the whole payload at once, in plain bigint arithmetic that runs inside
generated code. Eight bytes are one bigint, first byte lowest. Three masked shifts spread its
seven-bit groups over bytes, or squeeze them together again. Hex text is the only way between
bigint and binary, and reversed hex of a value whose half-bytes are swapped is its bytes from
the lowest up.

Each direction is a chain of projections rather than one expression, because every step is
used more than once: Spark keeps such a step as its own projection instead of computing it
again wherever it is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODES = ("FAILFAST", "PERMISSIVE")

_PREFIX = "__varint_"

# Where seven-bit groups sit before and after each of the three moves: (stay, move, by).
_MOVES = (
    (0x007F007F007F007F, 0x7F007F007F007F00, 1),
    (0x00003FFF00003FFF, 0x3FFF00003FFF0000, 2),
    (0x000000000FFFFFFF, 0x0FFFFFFF00000000, 4),
)


def _bits(pattern: int) -> str:
    """A 64-bit pattern as a bigint literal."""
    return f"({pattern - (1 << 64) if pattern >> 63 else pattern}L)"


def _half_bytes_swapped(value: str) -> str:
    low = _bits(0x0F0F0F0F0F0F0F0F)
    return f"shiftleft({value} & {low}, 4) | (shiftrightunsigned({value}, 4) & {low})"


def _squeezed(value: str, stay: int, move: int, by: int) -> str:
    return f"({value} & {_bits(stay)}) | shiftrightunsigned({value} & {_bits(move)}, {by})"


def _spread(value: str, stay: int, move: int, by: int) -> str:
    return f"({value} & {_bits(stay)}) | shiftleft({value} & {_bits(move >> by)}, {by})"


def _chain(df: DataFrame, *steps: dict[str, str]) -> DataFrame:
    """Add prefixed columns step by step; ``$name`` in an expression is one added earlier."""
    for step in steps:
        df = df.selectExpr("*", *(f"{sql.replace('$', _PREFIX)} as {_PREFIX}{name}" for name, sql in step.items()))
    return df


def encode_long(df: DataFrame, column: str, out: str = "data") -> DataFrame:
    """Add the Avro binary body of ``{id: long}`` as column ``out``; null stays null."""
    kept = [c for c in df.columns if c != out]
    squeeze_1, squeeze_2, squeeze_3 = _MOVES
    steps = _chain(
        df,
        {"z": f"shiftleft(`{column}`, 1) ^ shiftright(`{column}`, 63)"},
        {"low": f"$z & {_bits((1 << 56) - 1)}", "rest": "shiftrightunsigned($z, 56)"},
        {"x1": _spread("$low", *squeeze_3)},
        {"x2": _spread("$x1", *squeeze_2)},
        {"x": _spread("$x2", *squeeze_1)},
        # Each byte of y is zero only if all bytes above it in x are.
        {"y1": "shiftrightunsigned($x, 8) | shiftrightunsigned($x, 16)"},
        {"y2": "$y1 | shiftrightunsigned($y1, 16)"},
        {"y": "$y2 | shiftrightunsigned($y2, 32)"},
        # The top bit of every byte that is not the last.
        {
            "more": f"if($rest = 0, ($y + {_bits(0x007F7F7F7F7F7F7F)}) & {_bits(0x0080808080808080)},"
            f" {_bits(0x8080808080808080)})"
        },
        {"head": "$x | $more", "tail": "if($rest < 128, $rest, $rest | 256)"},
        {
            "bytes": f"reverse(lpad(hex({_half_bytes_swapped('$head')}), 16, '0'))",
            "end": f"reverse(lpad(hex({_half_bytes_swapped('$tail')}), 4, '0'))",
            "size": "case when $rest = 0 then 1 + bit_count($more) when $rest < 128 then 9 else 10 end",
        },
        {"out": "unhex(substr(if($rest = 0, $bytes, concat($bytes, $end)), 1, 2 * $size))"},
    )
    return steps.select(*kept, F.col(f"{_PREFIX}out").alias(out))


def _loaded(payload: str, start: int, length: int) -> str:
    """Up to eight payload bytes as a bigint, absent bytes zero, half-bytes still swapped."""
    return f"coalesce(cast(conv(reverse(hex(substr(`{payload}`, {start}, {length}))), 16, -10) as bigint), 0L)"


def decode_long(df: DataFrame, payload: str, out: str = "id", mode: str = "FAILFAST") -> DataFrame:
    """Add the long held by an Avro binary payload as column ``out``.

    Bytes after the record are ignored. An empty, unterminated or null payload fails the job
    in ``FAILFAST`` mode and gives null in ``PERMISSIVE`` mode, where the row is kept.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    kept = [c for c in df.columns if c != out]
    squeeze_1, squeeze_2, squeeze_3 = _MOVES
    broken = "null" if mode == "PERMISSIVE" else "raise_error('payload is not one varint-encoded long')"
    steps = _chain(
        df,
        {"h": _loaded(payload, 1, 8), "t": _loaded(payload, 9, 2), "size": f"octet_length(`{payload}`)"},
        {"x": _half_bytes_swapped("$h"), "tail": _half_bytes_swapped("$t")},
        # The lowest bit of each byte that ends a varint.
        {
            "ends": f"shiftrightunsigned(~$x & {_bits(0x8080808080808080)}, 7)",
            "b9": "$tail & 255",
            "b10": "shiftrightunsigned($tail, 8) & 255",
        },
        {"first_end": "$ends & -$ends"},
        # Bytes up to the one that ends the varint; all eight when none of them does.
        {"x1": f"$x & (shiftleft($first_end, 8) - 1) & {_bits(0x7F7F7F7F7F7F7F7F)}"},
        {"x2": _squeezed("$x1", *squeeze_1)},
        {"x3": _squeezed("$x2", *squeeze_2)},
        {
            "low": _squeezed("$x3", *squeeze_3),
            "rest": "if($first_end <> 0, 0L, shiftleft($b9 & 127, 56) | if($b9 < 128, 0L, shiftleft($b10, 63)))",
            "complete": "if($first_end <> 0,"
            " $size >= 8 or $first_end < shiftleft(1L, 8 * $size),"
            " ($size >= 9 and $b9 < 128) or ($size >= 10 and $b10 < 128))",
        },
        {"z": "$low | $rest"},
        {"out": f"if($complete, shiftrightunsigned($z, 1) ^ -($z & 1), cast({broken} as bigint))"},
    )
    return steps.select(*kept, F.col(f"{_PREFIX}out").alias(out))
