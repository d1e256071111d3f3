"""Documents of exactly the known keys and kinds, at any depth, before they are parsed: a parser with a schema drops
unknown keys and reads numbers as texts, silently."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kinds of values, as Spark names a VARIANT's; a number may be written in any of its ways.
TEXT, FLAG, NOTHING = ("STRING",), ("BOOLEAN",), ("VOID",)
WHOLE = ("BIGINT",)
NUMBER = (*WHOLE, "DOUBLE", "DECIMAL")
TEXTS, NUMBERS = ("ARRAY<STRING>", "ARRAY<VOID>"), ("ARRAY<DOUBLE>", "ARRAY<DECIMAL", "ARRAY<BIGINT>")

Shape = dict[str, "tuple[str, ...] | Shape"]


def object_problems(value: Column, shape: Shape, optional: tuple[str, ...] = (), at: str = "$") -> list[Column]:
    """Columns that are null where a JSON text's object at a path is sound, else say what is wrong. shape: key -> kinds, or
    an object's own shape; objects named in optional may be null."""
    whole = F.try_parse_json(value)
    here = value if at == "$" else F.get_json_object(value, at)
    there = F.lit(True) if at == "$" else F.schema_of_variant(F.try_variant_get(whole, at, "variant")).startswith("OBJECT")
    keys = F.array_sort(F.json_object_keys(here))
    own = F.when(there & ~F.coalesce(keys == F.array(*map(F.lit, sorted(shape))), F.lit(False)), F.lit(f"keys of {at}"))
    found = [F.when(whole.isNull(), F.lit("no JSON")), own] if at == "$" else [own]
    for key, kinds in sorted(shape.items()):
        path = f"{at}.{key}"
        kind = F.schema_of_variant(F.try_variant_get(whole, path, "variant"))
        if isinstance(kinds, dict):
            fits = kind.startswith("OBJECT") | ((kind == "VOID") if key in optional else F.lit(False))
            found += object_problems(value, kinds, optional, path)
        else:
            fits = F.lit(False)
            for k in kinds:
                fits = fits | (kind.startswith(k) if k.endswith("DECIMAL") else kind == k)
        found.append(F.when(there & ~F.coalesce(fits, F.lit(False)), F.lit(f"kind of {path}")))
    return found


def strict(value: Column, shape: Shape, optional: tuple[str, ...] = ()) -> Column:
    """The problems of a JSON text against a shape, sorted; empty for a sound one."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*object_problems(value, shape, optional)))))
