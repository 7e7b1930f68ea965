"""JSON kept in strings: extraction with defaults, merge patches and the normal form of classifications."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def extract_string(doc: Column, key: str) -> Column:
    """A member as text, '' if it is missing."""
    return F.coalesce(F.get_json_object(doc, f"$.{key}"), F.lit(""))


def extract_bool(doc: Column, key: str) -> Column:
    """A member as boolean, false if it is missing."""
    return F.coalesce(F.get_json_object(doc, f"$.{key}") == "true", F.lit(False))


def is_valid(doc: Column) -> Column:
    return F.try_parse_json(doc).isNotNull()


def kind(doc: Column) -> Column:
    """'Array', 'Object', 'Null' or 'Value'; null if the text is no JSON."""
    v = F.try_parse_json(doc)
    shape = F.schema_of_variant(v)
    return (
        F.when(v.isNull(), F.lit(None).cast("string"))
        .when(shape.startswith("ARRAY"), "Array")
        .when(shape.startswith("OBJECT"), "Object")
        .when(shape == "VOID", "Null")
        .otherwise("Value")
    )


def _entries(doc: Column) -> Column:
    return F.coalesce(F.map_entries(F.from_json(doc, "map<string,string>")), F.array().cast("array<struct<key:string,value:string>>"))


def merge_flat(base: Column, patch: Column) -> Column:
    """RFC 7396 merge of two flat objects of text members: the patch's members win, its null members delete."""
    mine, theirs = _entries(base), _entries(patch)
    keys = F.transform(theirs, lambda e: e["key"])
    rest = F.filter(mine, lambda e: ~F.array_contains(keys, e["key"]) & e["value"].isNotNull())
    return F.to_json(F.map_from_entries(F.concat(rest, F.filter(theirs, lambda e: e["value"].isNotNull()))))


#: Objects within objects that `merge_patch` follows; a patch that is nested deeper is an error, not a wrong result.
MERGE_DEPTH = 8


def _members(v: Column) -> Column:
    """An object's members; null for any other kind. Cheap beside schema_of_variant, which walks the whole value."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def _quoted(key: Column) -> Column:
    return F.to_json(key.cast("variant"))


def _merged_object(base: Column, patch: Column, depth: int) -> Column:
    """JSON text of the members of a patch applied to a base, a variant of any kind."""
    if depth == 0:
        return F.raise_error(F.lit(f"JSON patch nested deeper than {MERGE_DEPTH} objects")).cast("string")

    def value(mine: Column, e: Column) -> Column:
        one = F.transform(F.array(_members(e["value"])), lambda inner: F.when(inner.isNotNull(), _merged_object(F.try_element_at(mine, e["key"]), inner, depth - 1)).otherwise(F.to_json(e["value"])))
        return one[0]

    def text(pair: Column) -> Column:
        mine, theirs = pair["mine"], pair["theirs"]
        rest = F.filter(F.map_entries(mine), lambda e: ~F.map_contains_key(theirs, e["key"]))
        new = F.filter(F.map_entries(theirs), lambda e: ~F.is_variant_null(e["value"]))
        parts = F.concat(
            F.transform(rest, lambda e: F.concat(_quoted(e["key"]), F.lit(":"), F.to_json(e["value"]))),
            F.transform(new, lambda e: F.concat(_quoted(e["key"]), F.lit(":"), value(mine, e))),
        )
        return F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))

    empty = F.create_map().cast("map<string,variant>")
    pair = F.struct(F.coalesce(_members(base), empty).alias("mine"), patch.alias("theirs"))
    return F.transform(F.array(pair), text)[0]


def merge_patch(base: Column, patch: Column) -> Column:
    """RFC 7396 merge of two JSON texts: objects member by member at every level, null members of the patch delete,
    anything else in the patch replaces what is there. Numbers, booleans and arrays keep their kinds.

    Members come in the order of their names. Null, '' and invalid text counts as {} on either side; a patch of no
    members leaves the base, without a merge.
    """
    mine, theirs = F.try_parse_json(base), F.coalesce(F.try_parse_json(patch), F.parse_json(F.lit("{}")))
    members = F.transform(F.array(F.struct(theirs.alias("v"), _members(theirs).alias("m"))), lambda t: F.when(t["m"].isNotNull(), _merged_object(mine, t["m"], MERGE_DEPTH)).otherwise(F.to_json(t["v"])))[0]
    kept = F.when(_members(mine).isNotNull(), F.to_json(mine)).otherwise(F.lit("{}"))
    return F.to_json(F.parse_json(F.when(patch.isNull() | (patch == "{}"), kept).otherwise(members)))


def object_or_empty(doc: Column) -> Column:
    """The text if it is a JSON object; else, also for null, '', 'null' and arrays, {}."""
    return F.when(_members(F.try_parse_json(doc)).isNotNull(), doc).otherwise(F.lit("{}"))


def combined_classification(product: Column, own: Column) -> Column:
    """Both classifications in normal form, the own one merged over the product's."""
    return merge_patch(normalize_classification(product), normalize_classification(own))


def normalize_classification(doc: Column) -> Column:
    """'' , null and invalid text to {}; an array of {type, value} to an object, the last of a type wins; an object as it is."""
    pairs = F.from_json(doc, "array<struct<type:string,value:string>>")
    last = F.aggregate(
        F.coalesce(pairs, F.array().cast("array<struct<type:string,value:string>>")),
        F.array().cast("array<struct<key:string,value:string>>"),
        lambda acc, e: F.concat(F.filter(acc, lambda x: x["key"] != e["type"]), F.array(F.struct(e["type"].alias("key"), e["value"].alias("value")))),
    )
    shape = kind(doc)
    return F.when(shape == "Array", F.to_json(F.map_from_entries(F.filter(last, lambda x: x["key"].isNotNull())))).when(shape == "Object", doc).otherwise(F.lit("{}"))
