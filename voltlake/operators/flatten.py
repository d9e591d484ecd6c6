"""Bronze payload text to flat records."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlake.sources.feeds import Feed
from voltlake.sources.staging import new_folder

# The request columns carried along, and the fields that hold a list of records.
METADATA = ["dataset", "from_timestamp", "to_timestamp", "hours", "ingestion_timestamp"]
LISTS = ("items", "data")

#: Without it the parser refuses texts of more than 20 million characters.
ANY_LENGTH = {"maxStringLen": str(2**31 - 1)}
JSON_WHITE_SPACE = " \t\r\n"
CORRUPT = "_corrupt"
CORRUPT_LINE = "corrupt_line"
PARSING = {**ANY_LENGTH, "columnNameOfCorruptRecord": CORRUPT}


def carry_metadata(bronze: DataFrame) -> list[Column]:
    """Request metadata kept next to each record.

    ``source`` becomes ``bronze_source`` because records have a ``source`` of their own; the Bronze
    ``state`` is left out because the payload names its state.
    """
    source = [F.col("source").alias("bronze_source")] if "source" in bronze.columns else []
    return source + [F.col(name) for name in METADATA if name in bronze.columns]


def parsed(raw: Column, record: T.StructType, shape: str) -> dict[str, Column]:
    """Columns holding a payload parsed as one of the forms its ``shape`` allows, else null.

    The ``any`` shape reads a payload as a list or as an object after its first character, and the
    object with room for each list it may hold. They are columns of their own so that
    :func:`record_list` can refer to them more than once without parsing again.
    """
    if shape == "array":
        return {"_list": F.from_json(raw, T.ArrayType(record), ANY_LENGTH)}
    if shape in LISTS:
        return {"_object": parsed_object(raw, T.StructType().add(shape, T.ArrayType(record)))}
    if shape == "object":
        return {"_object": parsed_object(raw, record)}
    if shape != "any":
        raise ValueError(f"Unsupported payload shape: {shape}")
    is_list = F.ltrim(raw, F.lit(JSON_WHITE_SPACE)).startswith("[")
    holder = T.StructType(list(record.fields))
    for name in LISTS:
        holder = holder.add(name, T.ArrayType(record))
    return {
        "_list": F.when(is_list, F.from_json(raw, T.ArrayType(record), ANY_LENGTH)),
        "_object": F.when(~is_list, parsed_object(raw, holder)),
    }


def parsed_object(raw: Column, record: T.StructType) -> Column:
    """A payload object; its ``CORRUPT`` field holds the text if it could not be read."""
    return F.from_json(raw, T.StructType(list(record.fields)).add(CORRUPT, T.StringType()), PARSING)


def record_list(record: T.StructType, shape: str) -> Column:
    """Records of a payload parsed by :func:`parsed`, as one array."""
    itself = F.array(F.struct(*[F.col(f"_object.{name}").alias(name) for name in record.names]))
    if shape == "array":
        return F.col("_list")
    if shape in LISTS:
        return F.col(f"_object.{shape}")
    if shape == "object":
        return itself
    return F.coalesce("_list", *[f"_object.{name}" for name in LISTS], itself)


def flatten(bronze: DataFrame, feed: Feed) -> DataFrame:
    """One row per observation: request metadata, then the payload fields of ``feed`` as text.

    Payloads without observations, and unreadable ones, give one row of nulls; ``conform`` drops it
    and :func:`rejected` reports the unreadable ones.
    """
    return unfolded(with_parsed(bronze, feed), feed)


def unfolded(rows: DataFrame, feed: Feed, *more: Column) -> DataFrame:
    """The observations of payloads parsed by :func:`with_parsed`, with their metadata and columns ``more``."""
    payloads = rows.select(*carry_metadata(rows), *more, *parsed_names(feed))
    names = [c for c in payloads.columns if c not in ("_list", "_object")]
    records = payloads.select(
        *names, F.explode_outer(record_list(feed.record_type, feed.shape)).alias("_record")
    )
    if feed.nested is None:
        return records.select(*names, "_record.*")
    outer = [F.col(f"_record.{name}").alias(name) for name in feed.outer_fields]
    points = records.select(*names, *outer, F.explode_outer(f"_record.{feed.nested}").alias("_point"))
    return points.select(*names, *feed.outer_fields, "_point.*")


def read_once(bronze: DataFrame, feed: Feed) -> DataFrame:
    """:func:`flatten` and :func:`rejected` in one parse: rows of either, told apart by ``_rejected``.

    Rejects have their text in ``_text`` and the ``_reason``; their other columns are null but for the metadata.
    """
    line = F.col(CORRUPT_LINE) if CORRUPT_LINE in bronze.columns else F.lit(None).cast("string")
    rows = with_parsed(bronze.withColumn("_line", line), feed)
    nothing = reduce(and_, [F.col(name).isNull() for name in parsed_names(feed)])
    lost = F.col("_line").isNotNull() | (F.col("raw_response").isNotNull() & nothing)
    return unfolded(
        rows,
        feed,
        lost.alias("_rejected"),
        F.when(lost, F.coalesce("_line", "raw_response")).alias("_text"),
        F.when(F.col("_line").isNotNull(), "line").when(lost, "payload").alias("_reason"),
    )


def with_parsed(bronze: DataFrame, feed: Feed) -> DataFrame:
    """Bronze rows with the columns of :func:`parsed`; an object that broke off is null as a whole."""
    _require_payload(bronze)
    rows = bronze.withColumns(parsed(F.col("raw_response"), feed.record_type, feed.shape))
    if "_object" not in parsed_names(feed):
        return rows
    whole = F.when(F.col(f"_object.{CORRUPT}").isNull(), F.col("_object"))
    return rows.withColumn("_object", whole)


def parsed_names(feed: Feed) -> list[str]:
    return list(parsed(F.lit(""), feed.record_type, feed.shape))


def rejected(bronze: DataFrame, feed: Feed) -> DataFrame:
    """Bronze rows that :func:`flatten` gets nothing from, by the same parse, and lines that are no rows.

    ``raw_response`` is the payload, or the line as it was. ``reason`` is ``payload`` or ``line``.
    """
    line = F.col(CORRUPT_LINE) if CORRUPT_LINE in bronze.columns else F.lit(None).cast("string")
    nothing = reduce(and_, [F.col(name).isNull() for name in parsed_names(feed)])
    rows = with_parsed(bronze.withColumn("_line", line), feed)
    return rows.where(F.col("_line").isNotNull() | (F.col("raw_response").isNotNull() & nothing)).select(
        F.lit(feed.dataset).alias("dataset"),
        "ingestion_timestamp",
        F.coalesce("_line", "raw_response").alias("raw_response"),
        F.when(F.col("_line").isNotNull(), "line").otherwise("payload").alias("reason"),
    )


def payload_fields(bronze: DataFrame, listing: str | None = None) -> DataFrame:
    """(field, type) of the payload objects, merged over every payload.

    With ``listing``, the fields of the objects in that list instead.
    """
    _require_payload(bronze)
    objects = bronze.select(F.try_parse_json("raw_response").alias("_object"))
    spark = bronze.sparkSession
    if listing is not None:
        parts = spark.tvf.variant_explode(
            F.try_variant_get(F.col("_object").outer(), f"$.{listing}", "variant")
        )
        objects = objects.lateralJoin(parts).select(F.col("value").alias("_object"))
    fields = objects.lateralJoin(spark.tvf.variant_explode(F.col("_object").outer()))
    return (
        fields.where(F.col("key").isNotNull())
        .groupBy(F.col("key").alias("field"))
        .agg(F.schema_of_variant_agg("value").alias("type"))
    )


def infer_payload_type(bronze: DataFrame) -> T.DataType:
    """Payload type merged over every payload, for feeds nobody described yet.

    Takes type names, not data, to the driver. Lists and objects are merged apart; if both occur, the payload
    is a :class:`Mixed` of the two.
    """
    return found_types(bronze).declared()


def found_types(bronze: DataFrame) -> FoundTypes:
    """The types of lists and of objects in all payloads."""
    _require_payload(bronze)
    return FoundTypes.named(*bronze.select(*as_variants()).agg(*variant_types().values()).first())


def as_variants() -> list[Column]:
    is_list = F.ltrim("raw_response", F.lit(JSON_WHITE_SPACE)).startswith("[")
    return [F.try_parse_json("raw_response").alias("_value"), is_list.alias("_is_list")]


def variant_types() -> dict[str, Column]:
    """Aggregates of :func:`as_variants`: the type names of lists and of objects."""
    is_list = F.col("_is_list")
    return {
        "lists": F.schema_of_variant_agg(F.when(is_list, F.col("_value"))),
        "objects": F.schema_of_variant_agg(F.when(~is_list, F.col("_value"))),
    }


@dataclass(frozen=True)
class FoundTypes:
    """What payloads turned out to be: the merged type of the lists among them, and that of the objects.

    ``NullType`` stands for what was only ever null or did not occur. Types of batches are put together by
    :meth:`widened`, with the result that all payloads at once would have given.
    """

    lists: T.DataType = T.NullType()
    objects: T.DataType = T.NullType()

    @classmethod
    def named(cls, lists: str, objects: str) -> FoundTypes:
        return cls(T.DataType.fromDDL(column_type(lists)), T.DataType.fromDDL(column_type(objects)))

    def widened(self, other: FoundTypes) -> FoundTypes:
        return FoundTypes(widened(self.lists, other.lists), widened(self.objects, other.objects))

    def declared(self) -> T.DataType:
        """The type to read payloads with."""
        found = [
            without_nulls(k) for k in (self.lists, self.objects) if isinstance(k, T.ArrayType | T.StructType)
        ]
        found = [k for k in found if isinstance(k, T.ArrayType | T.StructType)]
        if len(found) == 2:
            return Mixed(*found)
        if not found:
            raise ValueError(f"Unsupported payload type: {self.objects.simpleString()}")
        return found[0]


#: Digits of a whole number, and the most that a decimal may have.
WHOLE_DIGITS, MOST_DIGITS = 20, 38


def widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds values of both, as ``schema_of_variant_agg`` merges them."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widened(a.elementType, b.elementType))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        kinds = {f.name: f.dataType for f in a}
        for f in b:
            kinds[f.name] = widened(kinds.get(f.name, T.NullType()), f.dataType)
        return T.StructType([T.StructField(name, kinds[name]) for name in sorted(kinds, key=str.encode)])
    if not (isinstance(a, T.NumericType) and isinstance(b, T.NumericType)):
        return T.VariantType()
    if T.DoubleType() in (a, b):
        return T.DoubleType()
    scale = max(getattr(k, "scale", 0) for k in (a, b))
    whole = max(k.precision - k.scale if isinstance(k, T.DecimalType) else WHOLE_DIGITS for k in (a, b))
    return T.DecimalType(whole + scale, scale) if whole + scale <= MOST_DIGITS else T.DoubleType()


def without_nulls(kind: T.DataType) -> T.DataType:
    """``kind`` with text for what was only ever null and for objects without fields."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(without_nulls(kind.elementType))
    if isinstance(kind, T.StructType) and len(kind):
        return T.StructType([T.StructField(f.name, without_nulls(f.dataType)) for f in kind])
    return T.StringType() if isinstance(kind, T.NullType | T.StructType) else kind


class Mixed(T.StructType):
    """Payloads of both kinds: a list of records, or an object."""

    def __init__(self, records: T.ArrayType, single: T.StructType):
        super().__init__([T.StructField("list", records), T.StructField("object", single)])


# Type names of variants that are none of columns; field names, quoted or before a colon, are passed over.
_TYPE_NAMES = re.compile(r"`(?:[^`]|``)*`|[\w$-]+(?=\s*:)|(?P<object>OBJECT(?=<))")


def column_type(name: str) -> str:
    """The column type of a variant's type name."""
    return _TYPE_NAMES.sub(lambda m: "STRUCT" if m["object"] else m[0], name)


def flatten_inferred(bronze: DataFrame, kind: T.DataType | None = None) -> DataFrame:
    """Flatten payloads of an undeclared feed with a stored type, or the one found in them.

    Without a type Bronze is read once all the same, see :func:`flatten_widening`.
    """
    if kind is None:
        return flatten_widening(bronze)[0]
    return _records(bronze, kind, lambda part: F.from_json("raw_response", part, ANY_LENGTH))


def flatten_widening(bronze: DataFrame, known: FoundTypes | None = None) -> tuple[DataFrame, FoundTypes]:
    """Flat payloads of an undeclared feed, and the type they were read with, for the next batch.

    ``known`` is what earlier batches gave; the payloads of this one widen it. They are parsed once, into a
    table in the shared folder, and their type is observed on the way.
    """
    _require_payload(bronze)
    spark, seen = bronze.sparkSession, Observation()
    values = bronze.select(*carry_metadata(bronze), *as_variants())
    folder = new_folder(spark, "payloads")
    values.observe(seen, *[c.alias(name) for name, c in variant_types().items()]).write.parquet(folder)
    kind = FoundTypes.named(**seen.get)
    kind = kind if known is None else known.widened(kind)
    values = spark.read.schema(values.schema).parquet(folder)
    return _records(values, kind.declared(), lambda part: F.col("_value").try_cast(part)), kind


def _records(rows: DataFrame, kind: T.DataType, read: Callable[[T.DataType], Column]) -> DataFrame:
    """The records of payloads of type ``kind`` that ``read`` makes of them."""
    if isinstance(kind, Mixed):
        is_list = F.col("_is_list") if "_is_list" in rows.columns else as_variants()[1]
        parts = [
            _records(rows.where(condition), part.dataType, read)
            for condition, part in zip((is_list, ~is_list), kind.fields, strict=True)
        ]
        return parts[0].unionByName(parts[1], allowMissingColumns=True)
    payload = read(kind)
    if isinstance(kind, T.ArrayType):
        records = F.explode_outer(payload)
    elif isinstance(kind, T.StructType):
        listing = next(
            (n for n in LISTS if n in kind.names and isinstance(kind[n].dataType, T.ArrayType)), None
        )
        records = payload if listing is None else F.explode_outer(payload[listing])
    else:
        raise ValueError(f"Unsupported payload type: {kind.simpleString()}")
    flat = rows.select(*carry_metadata(rows), records.alias("_record"))
    return flat.select(*[c for c in flat.columns if c != "_record"], "_record.*")


def _require_payload(bronze: DataFrame) -> None:
    if "raw_response" not in bronze.columns:
        raise ValueError("Bronze rows have no raw_response column")
