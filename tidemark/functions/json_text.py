"""Column expressions over JSON text and base64 record data."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import REQUIRED_FIELDS

_PROBE_SCHEMA = (
    "array<struct<"
    + ", ".join(f"`{name}`: variant" for name in REQUIRED_FIELDS)
    + ", `__end`: string>>"
)


def decode_data(data) -> Column:
    """base64 → UTF-8 text; NULL when either step fails."""
    return decode_bytes(F.try_to_binary(data, F.lit("base64")))


def decode_bytes(data) -> Column:
    """Bytes → UTF-8 text; NULL when they are not UTF-8."""
    return F.try_validate_utf8(data.cast("string"))


def probe(raw) -> Column:
    """Parse the required fields and whether the text is one whole JSON value.

    The text is put in front of a marker inside an array. Only when it is
    exactly one JSON value does the parse yield two elements with the marker
    last; trailing characters or a second value give something else. Variant
    fields tell an absent key (NULL) from a null value (a VOID variant) and
    keep the JSON type, so one parse serves every check.

    A text that may name the marker itself (plainly or by an escape) gets a
    marker that holds the text's own digest, which the text can't know.
    """
    wrapped = F.concat(F.lit("["), raw, F.lit(',{"__end":"'), _end_mark(raw), F.lit('"}]'))
    return F.from_json(wrapped, _PROBE_SCHEMA, {"allowSingleQuotes": "false"})


def _end_mark(raw) -> Column:
    names_marker = raw.contains("__end") | raw.contains("\\u")
    return F.when(names_marker, F.sha2(raw, 256)).otherwise(F.lit("end"))


def probe_is_object(probed, raw) -> Column:
    whole = (F.size(probed) == 2) & (F.get(probed, F.lit(1))["__end"] == _end_mark(raw))
    return F.coalesce(whole & F.get(probed, F.lit(0)).isNotNull(), F.lit(False))


def is_json_value(raw) -> Column:
    """True when the text is one JSON value of any kind."""
    wrapped = F.concat(F.lit("["), raw, F.lit(",0]"))
    return F.try_parse_json(wrapped).isNotNull()


def starts_object(raw) -> Column:
    return F.ltrim(F.translate(raw, "\t\r\n", "   ")).startswith("{")


def variant_type(value) -> Column:
    return F.schema_of_variant(value)


def variant_text(value) -> Column:
    """The value as text: strings unquoted, everything else as JSON."""
    return F.try_variant_get(value, "$", "string")


def json_line(text) -> Column:
    """One JSON value on one line.

    Line breaks and tabs can only stand between tokens in valid JSON, so
    turning them into spaces does not change the value. Few texts have any,
    and looking for them is far cheaper than replacing them.
    """
    breaks = text.contains("\n") | text.contains("\r") | text.contains("\t")
    return F.rtrim(F.when(breaks, F.translate(text, "\t\r\n", "   ")).otherwise(text))


def add_member(raw, name: str, value) -> Column:
    """Add one member at the end of a non-empty JSON object given as text.

    All other members, known or not, keep their exact text. If the member is
    already there, the added one comes last and so wins when it is parsed.
    """
    line = json_line(raw)
    head = F.left(line, F.length(line) - F.lit(1))
    member = F.to_json(value, {"ignoreNullFields": "false"})
    return F.concat(head, F.lit(f',"{name}":'), member, F.lit("}"))


def members(raw) -> Column:
    """Object members as a map of text; nested values stay JSON text."""
    return F.from_json(raw, "map<string,string>", {"allowSingleQuotes": "false"})


def lower_names(mapping) -> Column:
    """Member names in lower case, last member first."""
    return F.reverse(F.transform(F.map_keys(mapping), F.lower))


def values_backwards(mapping) -> Column:
    """Member values, last member first."""
    return F.reverse(F.map_values(mapping))


def member_value(names, values, name: str) -> Column:
    """Value of the last member of that name, from the two arrays above."""
    return F.get(values, F.array_position(names, name.lower()).cast("int") - 1)


def path_equals(raw, path: str, value) -> Column:
    """True when the JSON path holds the value (as text)."""
    return F.get_json_object(raw, path) == F.lit(value)
