"""Column expressions that decode, parse and validate raw stream records.

Every step is a built-in expression, so a record batch stays one narrow
projection (no Python worker, no shuffle). A bad record never fails the batch:
each step yields NULL and the ``error`` column says which step refused it.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import OPTIONAL_DEFAULTS, REQUIRED_FIELDS, TTL_HOURS

# ---- fixed values: decoding rules ------------------------------------------------------
# Lenient base64: characters outside the alphabet are skipped, padding must be right.
B64_FOREIGN = r"[^A-Za-z0-9+/=]"
# Shape: alphabet characters, at most two '=' at the end, length a multiple of 4. (Same
# language as ^([A-Za-z0-9+/]{4})*([A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$ but without a
# repeated group, which Java matches recursively: slow, and a stack overflow on long text.)
# (\z, not $: in Java $ also matches before a final line break.)
B64_SHAPE = r"^[A-Za-z0-9+/]*={0,2}\z"
# Any text the lenient decoder accepts: '=' counts only where it completes a group of four, and
# what follows such padding is ignored. (Possessive repeats: Java matches them without recursion.)
B64_GROUPS = r"^=*+((?:C=*+C=?CC=*+)*+(?:C=*+C(?:==|=?C=))?+)".replace("C", "[A-Za-z0-9+/]")
B64_LENIENT = r"^=*+(?:C=*+C=?CC=*+)*+(?:\z|C=*+C(?:==|=?C=))".replace("C", "[A-Za-z0-9+/]")
# ISO-8601 date or date-time in the extended or the basic form; minutes, seconds, fraction (after a
# point or a comma) and zone are optional.
ISO_SHAPE = (r"^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{8})"
             r"(?:[T ][0-9]{2}(?::[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]+)?)?|[0-9]{2}(?:[0-9]{2}(?:[.,][0-9]+)?)?)?"
             r"(?:Z|[+-][0-9]{2}(?::?[0-9]{2})?)?)?\z")
# What a cast reads as it is: extended form, to the second at least, with a zone.
ISO_FULL = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?(?:Z|[+-][0-9]{2}:[0-9]{2})\z"
# End marker appended after the payload: text after a complete JSON value is refused.
SENTINEL = "earshot:end-of-payload:4d9b2f7e1a6c"
BOM = "\ufeff"
# Error codes, in the order the checks run.
ERRORS = ["bad_record", "bad_base64", "bad_utf8", "bad_json", "not_object", "missing:<field>",
          "bad_timestamp", "bad_duration", "null_key"]
# ----------------------------------------------------------------------------------------


def b64_clean(data: Column) -> Column:
    """Drop characters outside the base64 alphabet (lenient decoding).

    Line breaks of wrapped (MIME-style) base64 are removed with a plain replace;
    text then in shape skips the regex replace: an anchored full match is about
    ten times cheaper than a replace scan, and almost every record is clean.
    """
    unwrapped = F.replace(data, F.lit("\r\n"), F.lit(""))
    return F.when(unwrapped.rlike(B64_SHAPE), unwrapped) \
        .otherwise(F.regexp_replace(data, B64_FOREIGN, ""))


def decode_clean_base64(clean: Column) -> Column:
    """Bytes of cleaned base64 text, or NULL when the padding or length is wrong.
    ``clean`` should be a column (it is read several times). Text in plain shape is decoded as it
    is; only other text is searched for misplaced padding and what comes after padding."""
    shape_ok = clean.rlike(B64_SHAPE) & (F.length(clean) % 4 == 0)
    groups = F.replace(F.regexp_extract(clean, B64_GROUPS, 1), F.lit("="), F.lit(""))
    padded = F.concat(groups, F.repeat(F.lit("="), F.pmod(-F.length(groups), F.lit(4))))
    return F.when(shape_ok, F.try_to_binary(clean, F.lit("base64"))) \
        .when(clean.rlike(B64_LENIENT), F.try_to_binary(padded, F.lit("base64")))


def valid_text(s: Column) -> Column:
    """UTF-8 text with a leading BOM removed; NULL when the bytes are not valid UTF-8.
    ``s`` is the bytes cast to string, as a column."""
    return F.when(F.is_valid_utf8(s),
                  F.when(s.startswith(BOM), F.substring(s, F.lit(2), F.length(s))).otherwise(s))


def wrap_parse(text: Column) -> Column:
    """The payload parsed inside ``[payload, SENTINEL]`` (variant or NULL)."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"' + SENTINEL + '"]')))


def unwrap(wrapped: Column) -> Column:
    """The payload's value when the wrapper holds exactly it and the sentinel."""
    whole = ((F.try_variant_get(wrapped, "$[1]", "string") == F.lit(SENTINEL))
             & F.variant_get(wrapped, "$[2]", "variant").isNull())
    return F.when(whole, F.variant_get(wrapped, "$[0]", "variant"))


def parse_json_strict(text: Column) -> Column:
    """Variant of the JSON value, or NULL — strict: trailing text is refused.

    The payload is parsed inside ``[payload, SENTINEL]``; it is accepted only when
    the array has exactly those two elements.
    """
    return unwrap(wrap_parse(text))


def is_object(v: Column) -> Column:
    """The value is a JSON object. Extracting it as a struct with no fields succeeds only
    for objects and reads no field (``schema_of_variant`` would walk the whole value;
    about 4 times slower)."""
    return F.try_variant_get(v, "$", "struct<>").isNotNull()


def present(v: Column, field: str) -> Column:
    """The key exists (an explicit JSON null counts as present)."""
    return F.variant_get(v, f"$.{field}", "variant").isNotNull()


def text_field(v: Column, field: str) -> Column:
    """Field as text; NULL for JSON null or absence."""
    return F.try_variant_get(v, f"$.{field}", "string")


def first_missing(v: Column) -> Column:
    """Name of the first absent required field, else NULL."""
    expr = None
    for f in REQUIRED_FIELDS:
        expr = (F.when(~present(v, f), F.lit(f)) if expr is None
                else expr.when(~present(v, f), F.lit(f)))
    return expr


def iso_normalised(s: Column) -> Column:
    """Basic form -> extended; date-only -> midnight; HH, HH:MM -> HH:MM:00; no zone -> UTC ('Z')."""
    t = F.regexp_replace(s, r"^([0-9]{4})([0-9]{2})([0-9]{2})", "$1-$2-$3")
    t = F.regexp_replace(t, r"^(.{10}[T ][0-9]{2})([0-9]{2})([0-9]{2}(?:[.,][0-9]+)?)?", "$1:$2:$3")
    t = F.regexp_replace(t, r"^(.{10}[T ][0-9]{2}:[0-9]{2}):(?![0-9])", "$1")
    t = F.replace(t, F.lit(","), F.lit("."))
    t = F.regexp_replace(t, r"^(.{10}[T ].*[+-][0-9]{2})([0-9]{2})\z", "$1:$2")
    t = F.regexp_replace(t, r"^(.{10}[T ].*[+-][0-9]{2})\z", "$1:00")
    t = F.regexp_replace(t, r"^(.{10}[T ][0-9]{2})(Z?|[+-][0-9]{2}:[0-9]{2})\z", "$1:00$2")
    t = F.when(t.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), F.concat(t, F.lit("T00:00:00"))).otherwise(t)
    t = F.regexp_replace(t, r"^(.{10}[T ][0-9]{2}:[0-9]{2})(Z?|[+-][0-9]{2}:[0-9]{2})\z", "$1:00$2")
    return F.when(t.rlike(r"(Z|[+-][0-9]{2}:[0-9]{2})\z"), t).otherwise(F.concat(t, F.lit("Z")))


def parse_event_time(s: Column) -> Column:
    """Instant of an ISO-8601 string (offset honoured, none = UTC); NULL if invalid."""
    return F.when(s.rlike(ISO_FULL), s.try_cast("timestamp")) \
        .when(s.rlike(ISO_SHAPE), iso_normalised(s).try_cast("timestamp"))


def ttl_epoch(event_time: Column, hours: int = TTL_HOURS) -> Column:
    """Expiry as epoch seconds: event time plus ``hours``."""
    return F.unix_seconds(event_time + F.expr(f"INTERVAL {int(hours)} HOURS"))


def duration_decimal(v: Column) -> Column:
    """Absent -> 0; a number or numeric string -> DECIMAL(38,9) through its text (so
    ``true`` is not read as 1); anything else -> NULL (the record is refused)."""
    raw = text_field(v, "listen_duration_ms")
    val = F.when(~present(v, "listen_duration_ms"),
                 F.lit(OPTIONAL_DEFAULTS["listen_duration_ms"]).cast("decimal(38,9)")) \
        .otherwise(raw.try_cast("decimal(38,9)"))
    return val


def with_default(v: Column, field: str) -> Column:
    """Absent -> the field's default; present -> its text (JSON null stays NULL)."""
    return F.when(~present(v, field), F.lit(OPTIONAL_DEFAULTS[field])).otherwise(text_field(v, field))
