"""String cleaning, masking and hashing."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Replacements and defaults that stored tables already contain.
DEFAULT_EMAIL = "unknown@unknown.com"
DEFAULT_SKU = "No SKU"
MASK = "***"
UNSAFE_CHARS = ',\n"'
SAFE_CHARS = "; '"

# Local part: dot-separated runs of the characters of RFC 5322 and RFC 6531, 64 at most.
# Domain: dot-separated labels of letters and digits with inner hyphens, ending in a letter.
_ATOM = r"[\p{L}\p{M}\p{N}!#$%&'*+/=?^_`{|}~-]+"
_LABEL = r"[\p{L}\p{N}](?:[\p{L}\p{M}\p{N}-]{0,61}[\p{L}\p{M}\p{N}])?"
EMAIL_PATTERN = rf"^(?=[^@]{{1,64}}@.{{1,189}}$){_ATOM}(?:\.{_ATOM})*@{_LABEL}(?:\.{_LABEL})+(?<=[\p{{L}}\p{{M}}])$"


def tidy_name(name: str) -> str:
    """Header text -> table column name: ``"In stock (kg)"`` -> ``in_stock_kg``."""
    return re.sub(r"\W+", "_", name).lower().strip("_")


def tidy_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[tidy_name(c) for c in df.columns])


def tidy_value(c: Column) -> Column:
    """``tidy_name`` for values held in a column."""
    return F.btrim(F.lower(F.regexp_replace(c, r"(?U)\W+", "_")), F.lit("_"))


def blank_commas(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(" "))


def delimiter_safe(c: Column) -> Column:
    """Make a value safe for an unquoted comma-delimited file."""
    return F.translate(c, UNSAFE_CHARS, SAFE_CHARS)


def sanitize_delimiters(df: DataFrame) -> DataFrame:
    """Apply ``delimiter_safe`` to every string column, keeping column order."""
    return df.select(
        *[
            delimiter_safe(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def email_or_default(c: Column) -> Column:
    return F.when(c.rlike(EMAIL_PATTERN), c).otherwise(F.lit(DEFAULT_EMAIL))


def sku_or_default(c: Column) -> Column:
    return F.when(c != "", c).otherwise(F.lit(DEFAULT_SKU))


def hash_hex(c: Column, salt: str | None = None) -> Column:
    """Upper-case SHA-256 hex. A salt makes the hash unguessable from known inputs."""
    value = c if salt is None else F.concat(F.lit(salt), c)
    return F.upper(F.sha2(value, 256))


def mask_email(c: Column) -> Column:
    """Keep only the domain; null stays null."""
    domain = F.split_part(c, F.lit("@"), F.lit(2))
    return F.when(F.instr(c, "@") > 0, F.concat(F.lit(MASK + "@"), domain)).when(
        c.isNotNull(), F.lit(MASK)
    )


def mask_name(c: Column) -> Column:
    """Keep only the first character; null stays null."""
    return F.concat(F.substring(c, 1, 1), F.lit(MASK))
