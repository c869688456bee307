"""Row keys, hash buckets, token amounts and log words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.operators.exact import hex_to_decimal, shift_point

DEFAULT_BUCKETS = 128

# Addresses with a bucket of their own.
RESERVED_BUCKETS = {
    "0x0000000000000000000000000000000000000000": "9001",
    "0xdac17f958d2ee523a2206206994597c13d831ec7": "9002",
    "0x7a250d5630b4cf539739df2c5dacb4c659f2488d": "9003",
    "0xea674fdde714fd979de3edf0f56aa9716b898ec8": "9004",
    "0xc02aaa39b223fe8d0a0e5c4f27ead9083c756cc2": "9005",
    "0x0000000000000000000000000000000000000001": "9006",
    "0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48": "9007",
}

WORD_DIGITS = 64
NULL_FIELD = "\\N"


def hash_bucket(key: Column, buckets: int = DEFAULT_BUCKETS) -> Column:
    """Four-digit bucket from the last three hex digits of the MD5 of the key.

    More buckets than these digits can fill take more of them; the text grows with the number.
    """
    digits = max(3, -(-(max(buckets, 1) - 1).bit_length() // 4) if buckets > 4096 else 3)
    tail = F.conv(F.right(F.md5(key.cast("string")), F.lit(digits)), 16, 10).cast("bigint")
    return F.lpad((tail % buckets).cast("string"), max(4, len(str(buckets - 1))), "0")


def spread_bucket(key: Column, reserved: dict[str, str] | None = None,
                  buckets: int = DEFAULT_BUCKETS) -> Column:
    """Hash bucket, except for hot keys, which get the bucket reserved for them."""
    reserved = RESERVED_BUCKETS if reserved is None else reserved
    if not reserved:
        return hash_bucket(key, buckets)
    own = F.create_map(*[F.lit(x) for pair in reserved.items() for x in pair])
    return F.coalesce(F.try_element_at(own, F.lower(key.cast("string"))),
                      hash_bucket(key, buckets))


def row_key(fields: list[str | tuple[str, bool]], separator: str = "",
            digest: bool = False) -> Column:
    """Key text from several fields; `(name, True)` digests that field, `digest` the whole.

    A null field keeps its place as `NULL_FIELD`, so keys of rows with nulls in other fields differ.
    """
    parts = []
    for field in fields:
        name, hashed = field if isinstance(field, tuple) else (field, False)
        text = F.col(name).cast("string")
        parts.append(F.coalesce(F.md5(text) if hashed else text, F.lit(NULL_FIELD)))
    key = F.concat_ws(separator, *parts)
    return F.md5(key) if digest else key


def token_amount(text: Column, in_units: bool = False) -> Column:
    """Whole number behind hex (`0x…`) or decimal text, exact at any size, as decimal text.

    Null text counts as 0. Text that is no whole number, such as a fraction or damaged hex, gives
    null, which callers count as rejected. `in_units` moves the decimal point by 18 places.
    """
    plain = F.lower(text)
    hex_digits = F.regexp_extract(plain, r"\A0x0*([0-9a-f]+)\z", 1)
    digits = F.regexp_extract(plain, r"\A0*([0-9]+)\z", 1)
    value = (F.when(text.isNull(), F.lit("0"))
             .when(hex_digits != "", hex_to_decimal(hex_digits))
             .when(digits != "", digits))
    return shift_point(value, 18) if in_units else value


def log_words(data: Column) -> Column:
    """Array of the complete 32-byte words of `0x…` data, each with its own `0x`.

    One pass over the text, however long it is; an incomplete last word is left out.
    """
    words = F.regexp_extract_all(F.regexp_replace(data, "^0x", ""), F.lit(f".{{{WORD_DIGITS}}}"),
                                 F.lit(0))
    return F.transform(F.coalesce(words, F.array().cast("array<string>")),
                       lambda word: F.concat(F.lit("0x"), word))


def history_append(history: Column, element: Column) -> Column:
    """Add an element to a JSON list of texts; no list yet counts as an empty one.

    A text that is no such list gives null: the caller keeps the old text and rejects the row.
    """
    items = F.from_json(history, "array<string>")
    whole = F.trim(history).rlike(r"(?s)\A\[.*\]\z") & items.isNotNull()
    return F.when(history.isNull(), F.to_json(F.array(element))).when(
        whole, F.to_json(F.array_append(items, element)))
