"""Row validation and cleansing against the declared tables.

All rules of a table become one projection: cleaned and typed columns plus an array of
error texts. Valid and invalid rows are filters on that array.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions import dates, numeric, text
from granary.schemas import Entity, Field

ERRORS = "_errors"
RAW = "_raw"


class InvalidRowsError(ValueError):
    """Raised by ``require_valid`` with a few example errors."""


def _text_only(step: Callable[[Column], Column]) -> Callable[[Column, T.DataType], Column]:
    return lambda c, kind: step(c) if isinstance(kind, T.StringType) else c


def _nan(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return numeric.nan_to_null(c)
    if isinstance(kind, T.StringType):
        # An empty cell of a numeric export column arrives as this text.
        return F.when(F.lower(c) != "nan", c)
    return c


CLEANERS: dict[str, Callable[[Column, T.DataType], Column]] = {
    "commas": _text_only(text.blank_commas),
    "email": _text_only(text.email_or_default),
    "sku": _text_only(text.sku_or_default),
    "blank": _text_only(lambda c: F.when(c != "", c)),
    "nan": _nan,
}


def cleaned(c: Column, kind: T.DataType, field: Field) -> Column:
    for step in field.clean:
        c = CLEANERS[step](c, kind)
    return c


def _whole(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        # "12" and "12.0" are whole numbers, "12.5" and "1e3" are not.
        digits = F.regexp_extract(c, r"^\s*([+-]?\d+)\.0*\s*$", 1)
        return F.coalesce(c.try_cast("bigint"), digits.try_cast("bigint"))
    if isinstance(kind, T.FractionalType):
        return F.when(c == F.floor(c), c).try_cast("bigint")
    return c.try_cast("bigint")


def _truth(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        word = F.lower(F.trim(c))
        c = F.when(word == "on", "true").when(word == "off", "false").otherwise(c)
    return c.try_cast("boolean")


def coerced(c: Column, kind: T.DataType, target: str) -> Column:
    """Value as ``target``, null when it cannot be read as one."""
    if target == "bigint":
        return _whole(c, kind)
    if target == "boolean":
        return _truth(c, kind)
    if target == "date" and isinstance(kind, T.StringType):
        return dates.parse_day(c)
    if target == "timestamp_ntz":
        return dates.wall_clock(c)
    if target == "string":
        return c.cast("string")
    return c.try_cast(target)


def _below(c: Column, minimum: float, target: str) -> Column:
    low = c < F.lit(minimum)
    # NaN orders above every number, yet is not a non-negative amount.
    return (low | F.isnan(c)) if target == "double" else low


def _errors_of(field: Field, value: Column, typed: Column) -> list[Column]:
    errors = []
    if field.required:
        errors.append(F.when(value.isNull(), F.lit(f"{field.name}: required")))
    if field.type != "string":
        errors.append(
            F.when(value.isNotNull() & typed.isNull(), F.lit(f"{field.name}: not a {field.type}"))
        )
    if field.minimum is not None:
        errors.append(
            F.when(
                _below(typed, field.minimum, field.type),
                F.lit(f"{field.name}: below {field.minimum:g}"),
            )
        )
    return errors


def check(df: DataFrame, entity: Entity) -> DataFrame:
    """Typed columns of ``entity`` plus ``_errors`` and the untouched row in ``_raw``.

    Columns the entity does not declare are kept only inside ``_raw``.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    typed, errors = [], []
    for field in entity.fields:
        kind = kinds.get(field.name, T.StringType())
        source = F.col(f"`{field.name}`") if field.name in kinds else F.lit(None).cast("string")
        value = cleaned(source, kind, field)
        cast = coerced(value, kind, field.type)
        typed.append(cast.alias(field.name))
        errors.extend(_errors_of(field, value, cast))
    return df.select(
        *typed,
        F.array_compact(F.array(*errors)).alias(ERRORS),
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(RAW),
    )


def split(df: DataFrame, entity: Entity) -> tuple[DataFrame, DataFrame]:
    """(valid rows, coerced) and (invalid rows as they came, plus ``error``)."""
    checked = check(df, entity)
    valid = checked.filter(F.size(ERRORS) == 0).select(*entity.columns)
    invalid = checked.filter(F.size(ERRORS) > 0).select(
        f"{RAW}.*", F.array_join(ERRORS, "; ").alias("error")
    )
    return valid, invalid


def require_valid(df: DataFrame, entity: Entity) -> DataFrame:
    """Coerced rows; fails when any row is invalid, stopping at the first ones found."""
    valid, invalid = split(df, entity)
    examples = [row["error"] for row in invalid.select("error").take(5)]
    if examples:
        raise InvalidRowsError(f"invalid rows for {entity.name}: {examples}")
    return valid


def staged_valid(df: DataFrame, entity: Entity, staging: str) -> DataFrame:
    """Coerced rows, checked and written to ``staging`` in one pass.

    Valid rows go below ``rejected=false``, invalid ones with their errors and the row as it
    came below ``rejected=true``, where they can be read after a failure. Any invalid row
    stops the job; a table is published from the staged rows only after that.
    """
    seen = Observation()
    flagged = check(df, entity).select(
        *entity.columns,
        F.array_join(ERRORS, "; ").alias("error"),
        F.when(F.size(ERRORS) > 0, F.to_json(RAW)).alias("source"),
        (F.size(ERRORS) > 0).alias("rejected"),
    )
    flagged.observe(seen, F.count_if("rejected").alias("bad")).write.mode("overwrite").partitionBy("rejected").parquet(staging)
    staged = df.sparkSession.read.schema(flagged.schema).parquet(staging)
    if seen.get.get("bad"):
        examples = [r["error"] for r in staged.filter("rejected").select("error").limit(5).collect()]
        raise InvalidRowsError(f"invalid rows for {entity.name}: {examples}, see {staging}/rejected=true")
    return staged.filter("not rejected").select(*entity.columns)


def summary(df: DataFrame, entity: Entity) -> DataFrame:
    """Total, valid and invalid row counts in one pass."""
    invalid = F.count_if(F.size(ERRORS) > 0)
    return check(df, entity).agg(
        F.count("*").alias("total_rows"),
        (F.count("*") - invalid).alias("valid_rows"),
        invalid.alias("invalid_rows"),
    )


def cleanse(df: DataFrame, entity: Entity) -> DataFrame:
    """Only the cleaning steps: no typing, no errors, all rows and columns kept."""
    by_name = {f.name: f for f in entity.fields}
    return df.select(
        *[
            cleaned(F.col(f"`{f.name}`"), f.dataType, by_name[f.name]).alias(f.name)
            if f.name in by_name
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NaN -> null in the given floating-point columns (all of them by default)."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    chosen = floats if columns is None else [c for c in columns if c in floats]
    return df.withColumns({c: numeric.nan_to_null(F.col(f"`{c}`")) for c in chosen})


def flatten_completeness(docs: DataFrame, doc_id: str, flat: DataFrame, flat_id: str) -> DataFrame:
    """Document count against distinct ids after flattening."""
    counts = docs.agg(F.count("*").alias("document_count"))
    found = flat.select(flat_id).distinct().agg(F.count("*").alias("n")).scalar()
    return counts.select(
        "document_count",
        found.alias("flattened_ids"),
        (F.col("document_count") == found).alias("complete"),
    )


def reconcile_ids(headers: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """Distinct ids of header rows and of line rows, side by side."""
    line_ids = lines.select(key).distinct().agg(F.count("*").alias("n")).scalar()
    header_ids = headers.select(key).distinct().agg(F.count("*").alias("header_ids"))
    return header_ids.select("header_ids", line_ids.alias("line_ids"))


def _range(c: Column, ranges: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(ranges)).cast("int")


def differing_ids(left: DataFrame, left_id: str, right: DataFrame, right_id: str, ranges: int = 1024) -> DataFrame:
    """``(id, side)`` of ids that only one of two frames has; nulls are no ids.

    The ids of both sides meet in one aggregate with a row for each id: either side is read
    once, nothing is joined, and an id that repeats reaches the shuffle once a task.
    """
    bits = {"left": 1, "right": 2}
    ids = [
        df.select(F.col(c).alias("id"), F.lit(bit).alias("sides")).filter("id is not null")
        for df, c, bit in ((left, left_id, bits["left"]), (right, right_id, bits["right"]))
    ]
    # Dealt by range too: results dealt by id alone would share their tasks, and the memory of
    # one, in a union.
    met = ids[0].unionByName(ids[1]).groupBy(_range(F.col("id"), ranges).alias("range"), "id").agg(F.bit_or("sides").alias("sides"))
    side = F.when(F.col("sides") == bits["left"], "left").otherwise("right").alias("side")
    return met.filter(F.col("sides") != sum(bits.values())).select("id", side)


def require_complete(
    docs: DataFrame, doc_id: str, flat: DataFrame, flat_id: str, lost_to: str | None = None
) -> DataFrame:
    """``flat`` if it has all documents. Otherwise fails and names the first ids that differ;
    with ``lost_to`` all of them are written there."""
    row = flatten_completeness(docs, doc_id, flat, flat_id).first()
    if row["complete"]:
        return flat
    found = differing_ids(docs, doc_id, flat, flat_id)
    where = ""
    if lost_to:
        found.write.mode("overwrite").parquet(lost_to)
        found, where = docs.sparkSession.read.parquet(lost_to), f", all in {lost_to}"
    names = [f"{r['id']}{'' if r['side'] == 'left' else ' (no document)'}" for r in found.orderBy("id").limit(20).collect()]
    raise ValueError(
        f"{row['document_count']} documents but {row['flattened_ids']} ids after flattening, lost: {', '.join(names)}{where}"
    )
