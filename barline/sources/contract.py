"""The message contract as an Avro schema: made from the declared message, read with a fallback, linted."""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path
from typing import Any

from pyspark.sql import types as T

from ..schemas import BAR_MESSAGE

OPTIONAL = frozenset({"accumulated_volume", "official_open", "average_trade_size", "otc", "transactions"})
_AVRO = {"string": "string", "double": "double", "bigint": "long", "boolean": "boolean", "int": "int"}


def message_schema(shape: T.StructType = BAR_MESSAGE, optional: frozenset[str] = OPTIONAL) -> dict[str, Any]:
    """An Avro record: optional fields are unions with null, null by default."""

    def field(f: T.StructField) -> dict[str, Any]:
        kind: Any = _AVRO[f.dataType.simpleString()]
        if f.name == "ingestion_timestamp":
            kind = {"type": "long", "logicalType": "timestamp-millis"}
        return {"name": f.name, "type": ["null", kind], "default": None} if f.name in optional else {"name": f.name, "type": kind}

    return {"type": "record", "name": "MinuteBar", "fields": [field(f) for f in shape]}


def load_schema(path: str | Path, registry: Callable[[], str] | None = None) -> dict[str, Any]:
    """The registry's schema; the file's where there is no registry or it does not answer."""
    if registry is not None:
        try:
            return json.loads(registry())
        except (OSError, ValueError):
            pass
    return json.loads(Path(path).read_text())


def lint(schema: dict[str, Any], produced: set[str], not_produced: frozenset[str] = frozenset({"transactions"})) -> list[str]:
    """What is wrong with a schema, if anything: shape, unions, and fields that differ from the producer's."""
    wrong = []
    if schema.get("type") != "record" or not schema.get("name") or not isinstance(schema.get("fields"), list):
        return ["not a record with a name and fields"]
    for f in schema["fields"]:
        kind = f.get("type")
        if isinstance(kind, list):
            if len(kind) != 2 or kind[0] != "null":
                wrong.append(f"{f['name']}: a union must be null and one type")
            elif "default" not in f or f["default"] is not None:
                wrong.append(f"{f['name']}: a nullable field needs the default null")
    names = {f["name"] for f in schema["fields"]}
    wrong += [f"{n}: in the schema, not produced" for n in sorted(names - produced - not_produced)]
    wrong += [f"{n}: produced, not in the schema" for n in sorted(produced - names)]
    return wrong


def backward_compatible(old: dict[str, Any], new: dict[str, Any]) -> list[str]:
    """New fields without a default, which readers of old data could not fill."""
    known = {f["name"] for f in old["fields"]}
    return [f["name"] for f in new["fields"] if f["name"] not in known and "default" not in f]
