"""JSON values as a whole: what Spark's parser alone would take with something after its end."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_value(text: Column) -> Column:
    """The JSON value of a text as a variant; null if it isn't one value and nothing else.

    try_parse_json() stops at the end of the first value. Whatever follows it would have to end a list around it and an
    object around it, so the text is one value if it is one in both.
    """
    listed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    named = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    return F.when((F.size(listed) == 1) & named.isNotNull(), F.try_parse_json(text))


#: Of Spark's JSON parser: what is in single quotes is no JSON.
_STRICT = {"allowSingleQuotes": "false"}


def is_json(text: Column) -> Column:
    """Whether a text is one JSON value as lenient readers take it: keys may repeat, and NaN, Infinity and -Infinity are numbers.

    The value is tried inside a list and inside an object, as in json_value(). A mark of byte order may come first.
    """
    own = F.regexp_replace(text, "^\ufeff", "")
    listed = F.from_json(F.concat(F.lit("["), own, F.lit("]")), "array<string>", _STRICT)
    named = F.from_json(F.concat(F.lit('{"v":'), own, F.lit("}")), "v string, _corrupt_record string", _STRICT)
    # the parser also knows INF and a plus before Infinity; what is in strings may say so
    bare = F.regexp_replace(own, r'"(?:[^"\\]|\\.)*+"', '""')
    return F.coalesce((F.size(listed) == 1) & named["_corrupt_record"].isNull() & ~bare.rlike(r"INF|\+I"), F.lit(False))


def has_list(text: Column, field: str) -> Column:
    """Whether the JSON object in a text, which is_json() takes, holds a list in a field; of a field that repeats the last counts."""
    own = F.regexp_replace(text, "^\ufeff", "")
    v = json_value(own)
    strict = F.startswith(F.schema_of_variant(F.try_variant_get(v, f"$.{field}", "variant")), F.lit("ARRAY"))
    lists = F.from_json(own, f"`{field}` array<string>, _corrupt_record string", _STRICT)
    last = F.from_json(own, f"`{field}` string, _corrupt_record string", _STRICT)[field]
    # where some of the field's values are no lists, the last one's text tells, and whether it stands in quotes
    quoted = F.regexp_extract(own, rf'(?s)^.*"{field}"\s*:\s*(\S)', 1) == '"'
    loose = F.when(lists["_corrupt_record"].isNull(), lists[field].isNotNull()).otherwise(F.startswith(last, F.lit("[")) & ~quoted)
    return F.coalesce(F.when(v.isNotNull(), strict).otherwise(loose), F.lit(False))
