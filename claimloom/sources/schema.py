"""A declared schema (LinkML as a dictionary) compiled to Spark types, enum tables and checks."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, IntegerType, StringType, StructField, StructType

_SCALARS = {"integer": IntegerType(), "float": DoubleType(), "double": DoubleType(), "decimal": DoubleType(), "boolean": BooleanType()}


@dataclass
class Slot:
    name: str
    range: str = "string"
    required: bool = False
    multivalued: bool = False
    identifier: bool = False
    default: str | None = None
    pattern: str | None = None
    minimum: float | None = None
    maximum: float | None = None


@dataclass
class Profile:
    classes: dict[str, dict[str, Slot]] = field(default_factory=dict)
    enums: dict[str, list[str]] = field(default_factory=dict)

    def reachable(self, top: str) -> list[str]:
        """Classes that instances of `top` can hold, breadth first."""
        seen, queue = [], [top]
        while queue:
            name = queue.pop(0)
            if name in self.classes and name not in seen:
                seen.append(name)
                queue += [s.range for s in self.classes[name].values()]
        return seen

    def struct(self, name: str, inside: tuple[str, ...] = ()) -> DataType:
        """The Spark type of a class; a class inside itself is a reference by id."""
        if name in self.classes and name not in inside:
            return StructType([StructField(s.name, self.slot_type(s, (*inside, name))) for s in self.classes[name].values()])
        return _SCALARS.get(name, StringType())

    def slot_type(self, slot: Slot, inside: tuple[str, ...] = ()) -> DataType:
        one = self.struct(slot.range, inside)
        return ArrayType(one) if slot.multivalued else one

    def checks(self, name: str) -> dict[str, Column]:
        """Rules of a class's own slots as conditions that hold for valid rows."""
        rules: dict[str, Column] = {}
        for s in self.classes[name].values():
            c = F.col(s.name)
            if s.required:
                rules[f"{s.name}: required"] = c.isNotNull() & (F.size(c) > 0 if s.multivalued else F.lit(True))
            if s.range in self.enums:
                allowed = self.enums[s.range]
                fine = F.forall(c, lambda x, allowed=allowed: x.isin(allowed)) if s.multivalued else c.isin(allowed)
                rules[f"{s.name}: permitted value"] = c.isNull() | fine
            if s.pattern:
                rules[f"{s.name}: pattern"] = c.isNull() | c.rlike(s.pattern)
            if s.minimum is not None:
                rules[f"{s.name}: minimum"] = c.isNull() | (c >= s.minimum)
            if s.maximum is not None:
                rules[f"{s.name}: maximum"] = c.isNull() | (c <= s.maximum)
        return rules

    def defaults(self, name: str) -> dict[str, Column]:
        """Enum slots with their declared value where it is absent."""
        return {s.name: F.coalesce(F.col(s.name), F.lit(s.default)) for s in self.classes[name].values() if s.default is not None and s.range in self.enums}


def _default(text: str | None) -> str | None:
    found = re.fullmatch(r"string\((.*)\)", text or "")
    return found[1] if found else text


def _slot(name: str, *layers: dict | None) -> Slot:
    d: dict = {}
    for layer in layers:
        d |= {k: v for k, v in (layer or {}).items() if v is not None}
    any_of = [x.get("range") for x in d.get("any_of") or [] if x.get("range")]
    return Slot(
        name, d.get("range") or (any_of[0] if any_of else "string"), bool(d.get("required")), bool(d.get("multivalued")), bool(d.get("identifier")),
        _default(d.get("ifabsent")), d.get("pattern"), d.get("minimum_value"), d.get("maximum_value"),
    )


def compile_schema(schema: dict) -> Profile:
    """Classes with inherited, top-level and inline slots, and enums in declared order."""
    top_slots, classes = schema.get("slots") or {}, schema.get("classes") or {}
    profile = Profile()
    for name, body in (schema.get("enums") or {}).items():
        values = (body or {}).get("permissible_values") or (body or {}).get("values") or {}
        profile.enums[name] = list(values)

    def slots_of(name: str, seen: tuple[str, ...] = ()) -> dict[str, Slot]:
        body = classes.get(name) or {}
        parent = body.get("is_a")
        out = dict(slots_of(parent, (*seen, name))) if parent and parent not in seen else {}
        for s in body.get("slots") or []:
            out[s] = _slot(s, top_slots.get(s), (body.get("slot_usage") or {}).get(s))
        for s, d in (body.get("attributes") or {}).items():
            out[s] = _slot(s, d)
        return out

    for name in classes:
        profile.classes[name] = slots_of(name)
    return profile


def interpolate(value, environment: dict[str, str] | None = None):
    """Replaces ${NAME} and ${NAME:-default} in all strings of a configuration; unknown names are empty."""
    env = os.environ if environment is None else environment
    if isinstance(value, dict):
        return {k: interpolate(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [interpolate(v, env) for v in value]
    if isinstance(value, str):
        return re.sub(r"\$\{(\w+)(?::-([^}]*))?\}", lambda m: env.get(m[1]) or m[2] or "", value)
    return value
