"""Python values as VARIANT bytes, by the public Variant encoding; the way back is ``VariantVal.toPython``.

Types stay what they are: binary, dates, timestamps with and without time zone, decimals, doubles.  Integers take the fewest bytes; floats are doubles.
"""

from __future__ import annotations

import datetime
import decimal

import pyarrow as pa
from pyspark.sql import VariantVal

VARIANT = pa.struct([pa.field("value", pa.binary(), nullable=False), pa.field("metadata", pa.binary(), nullable=False, metadata={b"variant": b"true"})])
EPOCH = datetime.datetime(1970, 1, 1)

# Numbers of the primitive types in the Variant encoding.
NULL, TRUE, FALSE, INT8, INT16, INT32, INT64, DOUBLE = range(8)
DECIMAL4, DECIMAL8, DECIMAL16, DATE, TIMESTAMP, TIMESTAMP_NTZ = range(8, 14)
BINARY, STRING = 15, 16


def to_python(cell: dict | None) -> object:
    """The Python value of a VARIANT as Arrow gives it; decimals keep all their digits."""
    if cell is None:
        return None
    with decimal.localcontext(prec=38):
        return VariantVal(cell["value"], cell["metadata"]).toPython()


def from_python(value: object) -> dict[str, bytes]:
    """The VARIANT of a Python value, as Arrow takes it."""
    names: dict[str, int] = {}
    body = _encoded(value, names)
    texts = [name.encode() for name in names]
    size = _width(max(len(names), sum(map(len, texts))))
    ends = [0]
    for text in texts:
        ends.append(ends[-1] + len(text))
    header = bytes([1 | (size - 1) << 6])
    return {"value": body, "metadata": header + b"".join(n.to_bytes(size, "little") for n in (len(names), *ends)) + b"".join(texts)}


def _width(largest: int) -> int:
    return 1 if largest < 1 << 8 else 2 if largest < 1 << 16 else 3 if largest < 1 << 24 else 4


def _primitive(kind: int, body: bytes = b"") -> bytes:
    return bytes([kind << 2]) + body


def _integer(n: int) -> bytes:
    for kind, size in ((INT8, 1), (INT16, 2), (INT32, 4), (INT64, 8)):
        if -(1 << (8 * size - 1)) <= n < 1 << (8 * size - 1):
            return _primitive(kind, n.to_bytes(size, "little", signed=True))
    return _decimal(decimal.Decimal(n))


def _decimal(value: decimal.Decimal) -> bytes:
    sign, digits, exponent = value.as_tuple()
    unscaled = int("".join(map(str, digits)) or "0") * 10 ** max(exponent, 0) * (-1 if sign else 1)
    for kind, size, most in ((DECIMAL4, 4, 9), (DECIMAL8, 8, 18), (DECIMAL16, 16, 38)):
        if abs(unscaled) < 10**most and -exponent <= most:
            return _primitive(kind, bytes([max(-exponent, 0)]) + unscaled.to_bytes(size, "little", signed=True))
    raise ValueError(f"{value} has more than 38 digits")


def _moment(value: datetime.datetime) -> bytes:
    kind = TIMESTAMP_NTZ if value.tzinfo is None else TIMESTAMP
    plain = value if value.tzinfo is None else value.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    return _primitive(kind, ((plain - EPOCH) // datetime.timedelta(microseconds=1)).to_bytes(8, "little", signed=True))


def _encoded(value: object, names: dict[str, int]) -> bytes:
    import struct

    if value is None:
        return _primitive(NULL)
    if isinstance(value, bool):
        return _primitive(TRUE if value else FALSE)
    if isinstance(value, int):
        return _integer(value)
    if isinstance(value, float):
        return _primitive(DOUBLE, struct.pack("<d", value))
    if isinstance(value, decimal.Decimal):
        return _decimal(value)
    if isinstance(value, datetime.datetime):
        return _moment(value)
    if isinstance(value, datetime.date):
        return _primitive(DATE, (value - EPOCH.date()).days.to_bytes(4, "little", signed=True))
    if isinstance(value, (bytes, bytearray)):
        return _primitive(BINARY, len(value).to_bytes(4, "little") + bytes(value))
    if isinstance(value, str):
        text = value.encode()
        return bytes([len(text) << 2 | 1]) + text if len(text) < 64 else _primitive(STRING, len(text).to_bytes(4, "little") + text)
    keys = sorted(value, key=str.encode) if isinstance(value, dict) else range(len(value))
    parts = [_encoded(value[k], names) for k in keys]
    ends = [0]
    for part in parts:
        ends.append(ends[-1] + len(part))
    size, large = _width(ends[-1]), len(parts) > 255
    count, offsets = len(parts).to_bytes(4 if large else 1, "little"), b"".join(n.to_bytes(size, "little") for n in ends)
    if not isinstance(value, dict):
        return bytes([(large << 2 | (size - 1)) << 2 | 3]) + count + offsets + b"".join(parts)
    ids = [names.setdefault(k, len(names)) for k in keys]
    wide = _width(max(ids, default=0))
    head = bytes([(large << 4 | (wide - 1) << 2 | (size - 1)) << 2 | 2])
    return head + count + b"".join(n.to_bytes(wide, "little") for n in ids) + offsets + b"".join(parts)
