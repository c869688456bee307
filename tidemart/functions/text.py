"""Text checks, masking and naming."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The formats of a mobile number, of an e-mail address and of a permitted text.
MOBILE_FORMAT = r"^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$"
EMAIL_FORMAT = r"^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$"
PERMITTED_TEXT = r'^[一-龥a-zA-Z0-9\[\]\-_+{}:：“<>`?!——+·~@#$%^&*(、，。；‘【】！￥…（）)"]+$'

NAME_SEPARATOR = "丨"


def camel_case(name: str) -> str:
    """`order_count` -> `orderCount`"""
    head, *tail = name.lower().split("_")
    return head + "".join(part.capitalize() for part in tail)


def camel_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[camel_case(name) for name in df.columns])


def is_blank(col: Column) -> Column:
    """Null, empty, or nothing but control characters and spaces."""
    return col.isNull() | col.rlike(r"\A[\x00-\x20]*\z")


def is_permitted(col: Column) -> Column:
    # `$` would also match before a final line end.
    return F.coalesce(col.rlike(PERMITTED_TEXT.removesuffix("$") + r"\z"), F.lit(False))


def mask_name(col: Column) -> Column:
    return F.concat(F.substring(col, 1, 1), F.lit("*"))


def mask_phone(col: Column) -> Column:
    return F.when(col.rlike(MOBILE_FORMAT), F.concat(F.substring(col, 1, 3), F.lit("*")))


def mask_email(col: Column) -> Column:
    return F.when(col.rlike(EMAIL_FORMAT),
                  F.concat(F.lit("*@"), F.substring_index(col, "@", -1)))


def product_name_parts(col: Column) -> Column:
    """struct(brand_path, brand_series, product_name) of `brand丨series 名称 …`.

    The series runs from the separator to the first Han character; a name without separator or
    without Han text has no series and stays whole.
    """
    pattern = rf"^([^{NAME_SEPARATOR}]*){NAME_SEPARATOR}([^\p{{IsHan}}]*)(\p{{IsHan}}.*)$"
    found = col.rlike(pattern)
    brand = F.trim(F.regexp_extract(col, pattern, 1))
    series = F.trim(F.regexp_extract(col, pattern, 2))
    return F.struct(
        F.when(found, F.concat(brand, F.lit(NAME_SEPARATOR), series)).alias("brand_path"),
        F.when(found, series).alias("brand_series"),
        F.when(found, F.regexp_extract(col, pattern, 3)).otherwise(col).alias("product_name"),
    )


def any_word(words: list[str]) -> str:
    """One pattern that finds any of the words; longer words first."""
    return "|".join(re.escape(w) for w in sorted(set(words), key=lambda w: (-len(w), w)))
