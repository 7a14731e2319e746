"""JSON payloads as columns: where the record array is, fields by one of several names, the envelope.

Types are told by VARIANT, so text that looks like an array is text; the order of names is
that of the payload's own text, which VARIANT does not keep. A payload that is no JSON, or
that repeats a name within an object, has nothing in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import let, stripped

RECORDS = "struct<at:string,records:array<string>>"
#: How much of a scalar an envelope shows, and of how many names.
SHOWN, NAMES = 80, 12
# JSON of what counts as blank.
BLANK = ("null", "false", "0", "0.0", "-0.0", '""', "[]", "{}")


def _steps(path: str) -> str:
    return "$" + "".join(f"[{p}]" if p.isdigit() else f".{p}" for p in path.split("."))


def _array(v: Column, path: str = "$") -> Column:
    """The array at a path; null where there is none."""
    return F.try_variant_get(v, path, "array<variant>")


def _object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _holds_objects(array: Column) -> Column:
    return F.coalesce(F.exists(array, lambda x: _object(x).isNotNull()), F.lit(False))


def _children(raw: Column) -> Column:
    """(key, value) of an object in the order of its text, values as text."""
    return F.map_entries(F.from_json(raw, "map<string,string>"))


def _below(raw: Column, v: Column, at: Column, levels: int) -> Column:
    """Array of (at, raw): arrays with objects, v itself or within so many levels of objects, in the order of the text."""
    found = F.array(F.struct(at.alias("at"), raw.alias("raw")))
    nothing = F.filter(found, lambda x: F.lit(False))
    here = F.when(_holds_objects(_array(v)), found)
    if not levels:
        return F.coalesce(here, nothing)

    def inside(object_: Column) -> Column:
        def child(e: Column) -> Column:
            path = F.when(at == "", e["key"]).otherwise(F.concat(at, F.lit("."), e["key"]))
            return _below(e["value"], F.try_element_at(object_, e["key"]), path, levels - 1)

        return F.when(object_.isNotNull(), F.flatten(F.transform(_children(raw), child)))

    return F.coalesce(here, let(_object(v), inside), nothing)


def located(payload: Column, paths: Sequence[str], given: str = "", levels: int = 3) -> Column:
    """(at, records) of a payload's record array, null without one; records are JSON text.

    An array at the given path counts whatever it holds. Else it is the first with an
    object among those at the paths, and then among all within so many levels of objects.
    """

    def search(v: Column) -> Column:
        tries = [F.when(_array(v, _steps(given)).isNotNull(), _at(payload, given))] if given else []
        tries += [F.when(_holds_objects(_array(v, _steps(p))), _at(payload, p)) for p in paths]
        return F.coalesce(*tries, let(F.get(_below(payload, v, F.lit(""), levels), F.lit(0)), lambda x: F.when(x.isNotNull(), _named(x["at"], x["raw"]))))

    return let(F.try_parse_json(payload), search)


def _at(payload: Column, path: str) -> Column:
    return _named(F.lit(path), F.get_json_object(payload, _steps(path)))


def _named(at: Column, raw: Column) -> Column:
    return F.struct(at.alias("at"), F.from_json(raw, "array<string>").alias("records")).cast(RECORDS)


def record_rows(df: DataFrame, payload: str, paths: Sequence[str], given: str = "", levels: int = 3) -> DataFrame:
    """A row for each record of each payload, with `at`, its `place` from 0 and its text as `record`; none for payloads without."""
    found = df.withColumn("_found", located(F.col(payload), paths, given, levels)).where("_found is not null")
    return found.select(*df.columns, F.col("_found.at").alias("at"), F.posexplode("_found.records").alias("place", "record"))


def first_filled(record: Column, names: Sequence[str]) -> Column:
    """Stripped text of the first of the dotted names whose value is not blank; else empty. Blank are also zero, false and empty values."""

    def value(v: Column, name: str) -> Column:
        inner = F.try_variant_get(v, _steps(name), "variant")
        text = stripped(F.coalesce(F.try_variant_get(v, _steps(name), "string"), F.to_json(inner)))
        return F.when(~F.to_json(inner).isin(*BLANK) & (text != ""), text)

    return let(F.try_parse_json(record), lambda v: F.coalesce(*[value(v, n) for n in names], F.lit("")))


def envelope(payload: Column) -> Column:
    """(names, scalars) of an object: its first names, and the text of what is neither object nor array; null for others."""

    def scalars(object_: Column) -> Column:
        plain = F.filter(_children(payload), lambda e: _object(F.try_element_at(object_, e["key"])).isNull() & _array(F.try_element_at(object_, e["key"])).isNull())
        cut = F.transform(plain, lambda e: F.struct(e["key"].alias("key"), F.left(e["value"], F.lit(SHOWN)).alias("value")))
        return F.when(object_.isNotNull(), F.struct(F.slice(F.json_object_keys(payload), 1, NAMES).alias("names"), F.map_from_entries(cut).alias("scalars")))

    return let(_object(F.try_parse_json(payload)), scalars)
