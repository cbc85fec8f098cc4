"""Avro records without Spark's Avro package: decoding and encoding of flat records in Arrow batches.

Covers records of null, boolean, int, long, float, double, string and bytes, and unions of them, which is
all that the bar topic has.  A payload that is cut off, has bytes left over or names a branch that is not
there decodes to null, as PERMISSIVE mode does for unreadable payloads.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Callable, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

SPARK_TYPES = {"boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(), "string": T.StringType(), "bytes": T.BinaryType()}


def branches(kind: Any) -> list[str]:
    """The types of a field: those of a union, or one."""
    found = [x["type"] if isinstance(x, dict) else x for x in (kind if isinstance(kind, list) else [kind])]
    for x in found:
        if x != "null" and x not in SPARK_TYPES:
            raise ValueError(f"Avro type {x} is not covered")
    return found


def fields_of(schema: str) -> list[tuple[str, list[str]]]:
    return [(f["name"], branches(f["type"])) for f in json.loads(schema)["fields"]]


def shape_of(schema: str) -> T.StructType:
    """The Spark type of a record; a union of a type with null is that type."""
    out = T.StructType()
    for name, kinds in fields_of(schema):
        real = [k for k in kinds if k != "null"]
        if len(real) != 1:
            raise ValueError(f"{name}: unions of several types are not covered")
        out.add(name, SPARK_TYPES[real[0]])
    return out


def read_long(body: bytes, at: int) -> tuple[int, int]:
    """A zigzag number of seven bits a byte, and where it ends."""
    shift = n = 0
    while True:
        b = body[at]
        at += 1
        n |= (b & 127) << shift
        shift += 7
        if b < 128:
            return (n >> 1) ^ -(n & 1), at


def _fixed(code: str) -> Callable[[bytes, int], tuple[Any, int]]:
    size = struct.calcsize(code)
    return lambda body, at: (struct.unpack_from(code, body, at)[0], at + size)


def read_bytes(body: bytes, at: int) -> tuple[bytes, int]:
    size, at = read_long(body, at)
    if size < 0 or at + size > len(body):
        raise ValueError("cut off")
    return body[at : at + size], at + size


def _text(body: bytes, at: int) -> tuple[str, int]:
    raw, at = read_bytes(body, at)
    return raw.decode(), at


READ: Mapping[str, Callable[[bytes, int], tuple[Any, int]]] = {
    "null": lambda body, at: (None, at),
    "boolean": _fixed("<?"),
    "int": read_long,
    "long": read_long,
    "float": _fixed("<f"),
    "double": _fixed("<d"),
    "string": _text,
    "bytes": read_bytes,
}


def decode(body: bytes | None, fields: list[tuple[str, list[str]]]) -> dict[str, Any] | None:
    if body is None:
        return None
    try:
        at, out = 0, {}
        for name, kinds in fields:
            which = 0
            if len(kinds) > 1:
                which, at = read_long(body, at)
                if which < 0:
                    return None
            out[name], at = READ[kinds[which]](body, at)
        return out if at == len(body) else None
    except (IndexError, ValueError, struct.error):
        return None


def write_long(n: int) -> bytes:
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _sized(raw: bytes) -> bytes:
    return write_long(len(raw)) + raw


WRITE: Mapping[str, Callable[[Any], bytes]] = {
    "null": lambda x: b"",
    "boolean": lambda x: struct.pack("<?", x),
    "int": lambda x: write_long(int(x)),
    "long": lambda x: write_long(int(x)),
    "float": lambda x: struct.pack("<f", x),
    "double": lambda x: struct.pack("<d", x),
    "string": lambda x: _sized(x.encode()),
    "bytes": lambda x: _sized(bytes(x)),
}


def encode(row: Mapping[str, Any], fields: list[tuple[str, list[str]]]) -> bytes:
    """A record; a missing value of a field that allows none is an error."""
    out = bytearray()
    for name, kinds in fields:
        value = row.get(name)
        if value is None and "null" not in kinds:
            raise ValueError(f"{name} is missing")
        kind = "null" if value is None else next(k for k in kinds if k != "null")
        if len(kinds) > 1:
            out += write_long(kinds.index(kind))
        out += WRITE[kind](value)
    return bytes(out)


def from_avro(body: Column, schema: str) -> Column:
    """The record of each payload, null where it cannot be read."""
    fields, shape = fields_of(schema), shape_of(schema)
    wrapped = T.StructType().add("record", shape)

    @F.pandas_udf(wrapped)
    def read(col: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"record": [decode(None if x is None else bytes(x), fields) for x in col]})

    return read(body)["record"]


def to_avro(row: Column, schema: str) -> Column:
    """The payload of each struct."""
    fields = fields_of(schema)

    @F.pandas_udf("binary")
    def write(rows: pd.DataFrame) -> pd.Series:
        return pd.Series([encode({k: None if v is pd.NaT or v is pd.NA or v != v else v for k, v in r.items()}, fields) for r in rows.to_dict("records")], dtype=object)

    return write(row)
