"""Shaping records: choosing and renaming keys, validity, texts, members of a stored sample."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardweave.functions.packing import pack_npz
from shardweave.functions.tensor import to_bfloat16
from shardweave.functions.text import base64_text
from shardweave.functions.text import image_bytes as decode_image

VECTOR_LIST = T.ArrayType(T.ArrayType(T.FloatType()))


# JSON text of the keys that the schema does not name, or whose values do not fit it. Readers make it and
# writers put it back, so that records pass through whole.
REST = "_rest"


def is_internal(name: str) -> bool:
    """Columns of the engine itself (``_shard``, ``_pos``, ...) are not keys of a record."""
    return name.startswith("_")


def as_struct(schema: T.StructType | str) -> T.StructType:
    """A schema given as a type or as DDL text."""
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _inner(json_object: Column) -> Column:
    """The text between the braces of a JSON object."""
    return F.substr(json_object, F.lit(2), F.length(json_object) - 2)


def key_json(name: str, value: Column) -> Column:
    """``"name":value`` as JSON text, nulls within the value kept."""
    return _inner(F.to_json(F.struct(value.alias(name)), {"ignoreNullFields": "false"}))


def to_json_object(df: DataFrame, values: dict[str, Column], optional: tuple[str, ...] = ()) -> Column:
    """A JSON object of ``values`` and the record's other keys.

    With ``_rest`` a null value is left to it: there the key stands with what the input had, or not at all.
    Without, it is written as null, but for ``optional`` keys. A value that a column has wins over the same key
    in ``_rest``.
    """
    if REST not in df.columns:
        parts = [F.when(value.isNotNull() | F.lit(name not in optional), key_json(name, value)) for name, value in values.items()]
        return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")) if parts else F.lit("{}")
    parts = [F.when(value.isNotNull(), key_json(name, value)) for name, value in values.items()]
    kept = F.try_parse_json(F.col(REST)).cast("map<string,variant>")
    if values:
        here = F.array_compact(F.array(F.lit(""), *[F.when(value.isNotNull(), F.lit(name)) for name, value in values.items()]))
        kept = F.map_filter(kept, lambda k, _: ~F.array_contains(here, k) | (k == ""))
    rest = F.when(F.size(F.map_keys(kept)) > 0, _inner(F.to_json(kept, {"ignoreNullFields": "false"})))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts, rest), F.lit("}"))


def rest_of(record: Column, values: dict[str, Column], pattern: str | None = None) -> Column:
    """``_rest`` of a VARIANT object: the keys that ``pattern`` matches from their start and that are not in
    ``values``, or are null there. Null if there are none."""
    present = F.array_compact(F.array(F.lit(""), *[F.when(v.isNotNull(), F.lit(k)) for k, v in values.items()]))

    def stays(key: Column, _: Column) -> Column:
        open_key = ~F.array_contains(present, key) | (key == "")
        return open_key & key.rlike(f"^(?:{pattern})") if pattern not in (None, ".*") else open_key

    kept = F.map_filter(record.cast("map<string,variant>"), stays)
    return F.when(F.size(F.map_keys(kept)) > 0, F.to_json(kept, {"ignoreNullFields": "false"}))


def record_keys(df: DataFrame) -> list[str]:
    """Keys of the records of ``df``."""
    return [c for c in df.columns if not is_internal(c)]


def select_keys(df: DataFrame, pattern: str | None, map_column: str | None = None) -> DataFrame:
    """Keep the keys that ``pattern`` matches from their start; None or ``.*`` keeps all.

    With ``map_column`` the keys are those of a MAP column, otherwise the columns themselves.
    """
    if pattern is None or pattern == ".*":
        return df
    if map_column is not None:
        kept = F.map_filter(F.col(map_column), lambda k, v: k.rlike(f"^(?:{pattern})"))
        return df.withColumn(map_column, kept)
    return df.select([c for c in df.columns if is_internal(c) or re.match(pattern, c)])


def select_fields(schema: T.StructType, pattern: str | None) -> T.StructType:
    """The same choice for a schema, to be made before anything is read."""
    if pattern is None or pattern == ".*":
        return schema
    return T.StructType([f for f in schema.fields if re.match(pattern, f.name)])


def rename_keys(df: DataFrame, mapping: dict[str, str], map_column: str | None = None) -> DataFrame:
    """Map input keys to output keys; keys without an entry stay."""
    if map_column is None:
        return df.withColumnsRenamed(mapping)
    if not mapping:
        return df
    pairs = [F.lit(v) for item in mapping.items() for v in item]
    table = F.create_map(*pairs)
    renamed = F.transform_keys(
        F.col(map_column), lambda k, v: F.coalesce(F.try_element_at(table, k), k)
    )
    return df.withColumn(map_column, renamed)


def record_id(df: DataFrame, out: str = "uid") -> DataFrame:
    """``uid``, else ``id``, else a digest of the record itself (so that a rerun finds the same)."""
    known = [F.col(c).cast("string") for c in ("uid", "id") if c in df.columns]
    content = [F.col(c) for c in record_keys(df) if c not in ("uid", "id")]
    digest = F.md5(F.encode(F.to_json(F.struct(*content)), "UTF-8")) if content else F.lit(None)
    return df.withColumn(out, F.coalesce(*known, digest))


def flag_valid(df: DataFrame, image: str = "image") -> DataFrame:
    """Add ``_image`` (payload), ``_valid`` and ``_reason``; invalid records stay in the data."""
    kind = df.schema[image].dataType.simpleString() if image in df.columns else "none"
    payload = decode_image(F.col(image) if image in df.columns else F.lit(None), kind)
    reason = F.when(F.col("_image").isNull(), "undecodable").when(F.length("_image") == 0, "empty")
    return (
        df.withColumn("_image", payload)
        .withColumn("_reason", reason)
        .withColumn("_valid", F.col("_reason").isNull())
    )


def _as_list(column: Column, kind: T.DataType) -> Column:
    """Scalar as a one-element list."""
    return column if isinstance(kind, T.ArrayType) else F.when(column.isNotNull(), F.array(column))


def unify_text(df: DataFrame) -> DataFrame:
    """Let ``caption`` take the place of ``text``.

    A record with a caption must have no text, and no texts that differ from the caption; otherwise
    it becomes invalid and keeps its keys.
    """
    if "caption" not in df.columns:
        return df
    kinds = {f.name: f.dataType for f in df.schema.fields}
    caption = F.col("caption")
    sound = F.lit(True)
    if "text" in kinds:
        sound = sound & F.col("text").isNull()
    if "texts" in kinds:
        listed = _as_list(caption, kinds["caption"])
        texts = _as_list(F.col("texts"), kinds["texts"])
        sound = sound & (F.col("texts").isNull() | texts.eqNullSafe(listed))
    conflict = caption.isNotNull() & ~sound
    as_text = caption
    text = F.col("text") if "text" in kinds else F.lit(None).cast(kinds["caption"])
    if "text" in kinds and kinds["text"] != kinds["caption"]:
        as_text, text = _as_list(caption, kinds["caption"]), _as_list(text, kinds["text"])
    moved = caption.isNotNull() & sound
    columns = {
        "_conflict": conflict,
        "_moved": moved,
    }
    out = df.withColumns(columns)
    valid = F.col("_valid") if "_valid" in df.columns else F.lit(True)
    changes = {
        "_valid": valid & ~F.col("_conflict"),
        "text": F.when(F.col("_moved"), as_text).otherwise(text),
    }
    if "texts" in kinds:
        changes["texts"] = F.when(~F.col("_moved"), F.col("texts"))
    if "_reason" in df.columns:
        changes["_reason"] = F.coalesce(F.col("_reason"), F.when(F.col("_conflict"), "caption conflict"))
    return out.withColumns(changes).drop("_conflict", "_moved")


def match_syn_keys(df: DataFrame, regex: str = "syn_text") -> list[str]:
    """Synthetic text columns: those whose name ``regex`` matches from its start."""
    return [
        f.name
        for f in df.schema.fields
        if not is_internal(f.name) and isinstance(f.dataType, T.ArrayType) and re.match(regex, f.name)
    ]


def collect_texts(df: DataFrame, syn_regex: str = "syn_text") -> DataFrame:
    """Add ``_texts`` (ground truth first, then synthetic) and ``_text_lengths`` per source key."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    truth = [c for c in df.columns if c in ("text", "texts")]
    keys = [*truth, *[k for k in match_syn_keys(df, syn_regex) if k not in truth]]
    nothing = F.array().cast("array<string>")
    parts = [F.coalesce(_as_list(F.col(k), kinds[k]), nothing) for k in keys]
    entries = [
        F.when(F.col(k).isNotNull(), F.struct(F.lit(k).alias("key"), F.size(p).alias("len")))
        for k, p in zip(keys, parts)
    ]
    lengths = F.array_compact(F.array(*entries)) if entries else F.array().cast("array<struct<key:string,len:int>>")
    return df.withColumns(
        {"_texts": F.concat(*parts) if parts else nothing, "_text_lengths": lengths}
    )


def attach_column(df: DataFrame, name: str, value: Column, suffix: str = "") -> DataFrame:
    """New column ``name + suffix`` that only valid records get."""
    return df.withColumn(f"{name}{suffix}", F.when(F.col("_valid"), value))


def emb_name(name: str) -> str:
    """Stored name of an embedding key."""
    return name.replace("embedding", "emb") if "emb" in name else name


def normalise_emb_names(df: DataFrame) -> DataFrame:
    """Rename every embedding column to its stored name."""
    changed = {c: emb_name(c) for c in record_keys(df) if emb_name(c) != c}
    return df.withColumnsRenamed(changed)


def unwrap_features(
    df: DataFrame, schema: T.StructType | str, column: str = "features", keys: str | None = None
) -> DataFrame:
    """Columns of ``schema`` from a feature map, by the declared types: lists of any length for ARRAY columns,
    the value of a single-valued feature for others, integers and floats never one through the other.
    Bytes become text where text is declared. What cannot be converted becomes null.

    The bytes of ``image`` become base64 text. All other features, and those that became null, are in ``_rest``.
    """
    out = {}
    for field in as_struct(schema).fields:
        feature = F.try_element_at(F.col(column), F.lit(field.name))
        first = F.get(feature["bytes"], F.lit(0))
        kind = field.dataType
        if field.name == "image":
            value = base64_text(first) if isinstance(kind, T.StringType) else first
        elif isinstance(kind, T.StringType):
            value = F.when(F.size(feature["bytes"]) == 1, F.try_validate_utf8(first.cast("string")))
        elif isinstance(kind, T.BinaryType):
            value = F.when(F.size(feature["bytes"]) == 1, first)
        elif isinstance(kind, T.ArrayType):
            value = _feature_list(feature, kind)
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            real = F.coalesce(feature["floats"].cast("array<double>"), feature["ints"].cast("array<double>"))
            value = F.when(F.size(real) == 1, F.get(real, F.lit(0))).cast(kind)
        else:
            value = F.when(F.size(feature["ints"]) == 1, F.get(feature["ints"], F.lit(0))).cast(kind)
        out[field.name] = value
    typed = df.withColumns(out)
    present = F.array_compact(F.array(F.lit(""), *[F.when(F.col(k).isNotNull(), F.lit(k)) for k in out]))
    left = F.filter(F.map_entries(column), lambda e: ~F.array_contains(present, e["key"]) | (e["key"] == ""))
    if keys not in (None, ".*"):
        left = F.filter(left, lambda e: e["key"].rlike(f"^(?:{keys})"))
    rest = F.array_join(F.transform(left, _feature_json), ",")
    return typed.withColumn(REST, F.when(F.size(left) > 0, F.concat(F.lit("{"), rest, F.lit("}")))).drop(column)


def _feature_list(feature: Column, kind: T.ArrayType) -> Column:
    element = kind.elementType
    if isinstance(element, T.StringType):
        texts = F.transform(feature["bytes"], lambda b: F.try_validate_utf8(b.cast("string")))
        return F.when(~F.exists(texts, lambda t: t.isNull()), texts)
    if isinstance(element, T.BinaryType):
        return feature["bytes"]
    if isinstance(element, (T.FloatType, T.DoubleType)):
        return F.coalesce(feature["floats"].cast(kind), feature["ints"].cast(kind))
    return feature["ints"].cast(kind)


def _feature_json(entry: Column) -> Column:
    """``"key":value`` of a feature: a single value plain, several as a list, bytes as text or else as base64."""

    def listed(values: Column, as_json) -> Column:
        items = F.transform(values, as_json)
        return F.when(F.size(values) == 1, F.get(items, F.lit(0))).otherwise(F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")))

    def text(data: Column) -> Column:
        return F.coalesce(F.try_validate_utf8(data.cast("string")), base64_text(data))

    def quoted(value: Column) -> Column:
        pair = F.to_json(F.struct(value.alias("v")))
        return F.substr(pair, F.lit(6), F.length(pair) - 6)

    feature = entry["value"]
    value = F.coalesce(
        F.when(F.size(feature["ints"]) > 0, listed(feature["ints"], lambda x: x.cast("string"))),
        F.when(F.size(feature["floats"]) > 0, listed(feature["floats"], lambda x: quoted(x))),
        F.when(F.size(feature["bytes"]) > 0, listed(feature["bytes"], lambda x: quoted(text(x)))),
        F.lit("[]"),
    )
    return F.concat(quoted(entry["key"]), F.lit(":"), value)


def _is_synthetic(name: str) -> bool:
    listed = name.startswith("syn_text") or "_captions" in name
    return listed and not name.endswith(("embedding", "emb"))


def to_members(df: DataFrame, bfloat16: bool = False) -> DataFrame:
    """Add ``_key`` and ``_members``: the files (extension to content) that store each record."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    keys = record_keys(df)
    members: dict[str, Column] = {}
    taken = {"uid", "id"}

    def text(name: str) -> Column:
        kind = kinds[name]
        value = F.col(name) if isinstance(kind, T.StringType) else F.to_json(F.struct(F.col(name)))
        return F.encode(value, "UTF-8")

    if "url" in keys:
        members["url.txt"] = text("url")
        taken.add("url")
    leftover_image = None
    if "image" in keys:
        # A column of its own, so that each image is decoded once.
        df = df.withColumn("_payload", decode_image(F.col("image"), kinds["image"].simpleString()))
        payload = F.col("_payload")
        members["jpg"] = F.when(F.length(payload) > 0, payload)
        taken.add("image")
        if isinstance(kinds["image"], T.StringType):
            leftover_image = F.when(F.coalesce(F.length(payload), F.lit(0)) == 0, F.col("image"))
    captions = [c for c in ("text", "caption") if c in keys]
    if captions:
        members["txt"] = F.coalesce(*[text(c) for c in captions])
        taken.update(captions)
    synthetic = [c for c in keys if c not in taken and _is_synthetic(c)]
    if synthetic:
        present = F.lit(False)
        for c in synthetic:
            present = present | F.col(c).isNotNull()
        members["syn.json"] = F.when(present, F.encode(F.to_json(F.struct(*synthetic)), "UTF-8"))
        taken.update(synthetic)
    if "param_aug" in keys:
        stored = F.to_json(F.struct("param_aug"))
        members["paug.json"] = F.when(F.col("param_aug").isNotNull(), F.encode(stored, "UTF-8"))
        taken.add("param_aug")
    vectors = [c for c in keys if c not in taken and "emb" in c]
    if vectors:
        named = {emb_name(c): _as_matrix(F.col(c), kinds[c], bfloat16) for c in vectors}
        members["npz"] = pack_npz(named, bfloat16)
        taken.update(vectors)
    rest = {c: F.col(c) for c in keys if c not in taken}
    if leftover_image is not None:
        rest["image"] = leftover_image
    members["json"] = F.encode(to_json_object(df, rest, ("image",)), "UTF-8")
    pairs = F.array(
        *[F.struct(F.lit(ext).alias("ext"), content.alias("content")) for ext, content in members.items()]
    )
    known = [F.col(c).cast("string") for c in ("uid", "id") if c in keys]
    return df.withColumns(
        {
            "_key": F.coalesce(*known),
            "_members": F.map_from_entries(F.filter(pairs, lambda m: m["content"].isNotNull())),
        }
    ).drop("_payload")


def _as_matrix(column: Column, kind: T.DataType, bfloat16: bool) -> Column:
    """Embedding column as ARRAY<ARRAY<FLOAT>>, rounded when it is to be stored as bfloat16."""
    nested = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType)
    matrix = column if nested else F.when(column.isNotNull(), F.array(column))
    matrix = matrix.cast("array<array<float>>")
    return F.transform(matrix, to_bfloat16) if bfloat16 else matrix
