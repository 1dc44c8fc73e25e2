"""Raw JSON event lines -> typed valid rows + a dead letter with the names of the failed rules.

A malformed or wrongly typed message is data to inspect, not an exception: ``from_json`` takes the eight fields of a
line out as VARIANTs in one pass, each field is checked by one column expression, and the failed rule names are
collected into ``array<string>``. Everything stays JVM-side (no UDF).

A line must be one JSON object and nothing else. Spark's parser stops after the first value; a line with one pair of
braces, which is what events look like, has no room for anything after it. Any other line is parsed twice, as the only
element of an array and as the only member of an object: what could follow the value in the one (``]`` or another
element) is an error in the other, and both parse only if nothing follows.

Typing follows lax model validation:

* text fields (ids, codes, enums) must be JSON strings; a number is not an id, and half of a surrogate pair is no text;
* ``amount_minor`` may be a JSON number, a numeric string or ``true`` (1), and must be integral, exactly, and
  non-zero (``"100"``, ``"1_000"`` and ``100.0`` pass, ``100.5``, ``100.0000001`` and ``"1e2"`` fail), within BIGINT;
* ``currency`` is stripped of edge whitespace (tabs and no-break spaces too) and upper-cased, then must be 3 letters;
* ``occurred_at`` is ISO-8601 text: a date, or a date, one of ``T``, ``t``, ``_`` and space, hours and minutes, and
  optionally seconds, a fraction after a point or a comma, and a zone (none means UTC; an offset needs its minutes and
  is converted). Or it is a number, as text or not, of seconds since 1970 (milliseconds beyond 2e10);
* a key given twice counts as given last; extra keys are ignored, whatever they hold (``NaN`` too); a missing or NULL
  field fails its rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerproof.functions.rules import (
    THREE_LETTERS,
    failed_rule_list,
    is_direction,
    is_transaction_type,
    min_length,
    normalised_currency,
    strip,
)
from ledgerproof.functions.time import utc_wall_clock

# Rule names, in the order they are reported.
RULES = (
    "json_object",
    "event_id",
    "account_id",
    "amount_minor",
    "currency",
    "direction",
    "transaction_type",
    "occurred_at",
    "source_system",
)
TEXT_FIELDS = ("event_id", "account_id", "currency", "direction", "transaction_type", "occurred_at", "source_system")
NUMERIC_TYPES = ("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE")
EVENT_OUTPUT = (
    "event_id", "account_id", "amount_minor", "currency", "direction", "transaction_type", "occurred_at",
    "source_system",
)


NUMBER_SHAPE = r"^[+-]?\d+(\.\d+)?$"
WHOLE_NUMBER = r"^[+-]?\d+(_\d+)*(\.0+)?$"
MILLISECONDS_FROM = 20_000_000_000

_OFFSET = r"[+\-\u2212]([01]\d|2[0-3]):?[0-5]\d"
ISO_SHAPE = (r"^(?!0000)\d{4}-\d{2}-\d{2}([Tt _]([01]\d|2[0-3]):[0-5]\d(:[0-5]\d([.,]\d+)?)?(Z|z|" + _OFFSET + r")?)?\z")

#: Escapes of half a surrogate pair, which no text can hold.
_UNESCAPED = r"(?<!\\)((?:\\\\)*)"
_HIGH, _LOW = r"\\u[dD][89abAB][0-9a-fA-F]{2}", r"\\u[dD][c-fC-F][0-9a-fA-F]{2}"
LONE_HALF = f"{_UNESCAPED}{_HIGH}(?!{_LOW})|{_UNESCAPED}(?<!{_HIGH}){_LOW}"
_MARK = "\ufdd0"  # a code point that is never a character stands for it


def iso_to_utc(text: Column) -> Column:
    """ISO-8601 text -> ``timestamp_ntz`` holding the UTC wall clock; NULL when it does not parse.

    The pieces go into one zone-less literal and the offset is subtracted, so no session zone is involved."""
    rest = F.substring(text, 17, 1 << 20)
    timed = F.length(text) > 10
    clock = F.when(timed, F.substring(text, 12, 5)).otherwise("00:00")
    seconds = F.when(rest.startswith(":"), F.substring(rest, 2, 2)).otherwise("00")
    fraction = F.rpad(F.regexp_extract(rest, r"[.,](\d{1,6})", 1), 6, "0")
    local = F.concat(F.substring(text, 1, 10), F.lit(" "), clock, F.lit(":"), seconds, F.lit("."), fraction)
    zone = F.regexp_extract(rest, f"({_OFFSET})$", 1)
    minutes = F.substring(zone, 2, 2).try_cast("int") * 60 + F.right(zone, F.lit(2)).try_cast("int")
    ahead = F.when(zone == "", 0).when(zone.startswith("+"), minutes).otherwise(-minutes)
    stamp = F.when(text.rlike(ISO_SHAPE), local).try_cast("timestamp_ntz")
    return F.when(ahead == 0, stamp).otherwise(F.timestamp_add("MINUTE", -ahead, stamp))


def epoch_to_utc(number: Column) -> Column:
    """Seconds (or milliseconds) since 1970 as ``decimal(38,9)`` -> ``timestamp_ntz`` in UTC."""
    seconds = F.when(F.abs(number) > MILLISECONDS_FROM, number / 1000).otherwise(number)
    micros = F.round(seconds.cast("decimal(28,9)") * 1_000_000).try_cast("bigint")
    in_range = F.when(F.abs(seconds) < 253_402_300_800, micros)  # up to the year 9999
    return utc_wall_clock(F.timestamp_micros(in_range))


#: Strict JSON but for NaN, as the producers' parser has it; a field is whatever value it holds.
_STRICT = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_corrupt"}
_FIELDS = ", ".join(f"{f}: variant" for f in (*TEXT_FIELDS, "amount_minor"))
_RECORD = f"struct<{_FIELDS}>"


def _sole_objects(lines: DataFrame, raw: str) -> DataFrame:
    """Adds ``_broken`` (half a surrogate pair is escaped) and ``_doc``: the line's fields as a struct of VARIANTs if the
    line is exactly one JSON object, else NULL.

    Every step is a column of its own, which the next ones read: nothing is matched or parsed twice for a line."""
    line = F.col(raw)
    # the search for halves costs more than the parse, so it is only made where there are escapes
    p = lines.select("*", F.when(line.contains("\\u"), line.rlike(LONE_HALF)).otherwise(False).alias("_broken"))
    whole = F.when(F.col("_broken"), F.regexp_replace(line, LONE_HALF, "$1$2" + r"\\ufdd0")).otherwise(line)
    p = p.select("*", whole.alias("_json_line"))
    p = p.select("*", F.col("_json_line").rlike(r"^[ \t\r\n]*\{[^{}]*\}[ \t\r\n]*\z").alias("_json_plain"))
    # braces inside: nothing may follow the object, in either frame
    nested = F.when(~F.col("_json_plain") & F.col("_json_line").rlike(r"^[ \t\r\n]*\{"), F.col("_json_line"))
    p = p.select(
        *lines.columns,
        "_broken",
        "_json_plain",
        F.from_json(F.when(F.col("_json_plain"), F.col("_json_line")), f"struct<{_FIELDS}, _corrupt: string>", _STRICT).alias("_json_alone"),
        F.from_json(F.concat(F.lit('{"line":'), nested, F.lit("}")), f"struct<line: {_RECORD}, _corrupt: string>", _STRICT).alias(
            "_json_member"),
        F.from_json(F.concat(F.lit("["), nested, F.lit("]")), f"array<{_RECORD}>", _STRICT).alias("_json_element"),
    )
    fields = F.struct(*[F.col(f"_json_alone.{f}").alias(f) for f in (*TEXT_FIELDS, "amount_minor")])
    doc = F.when(F.col("_json_plain") & F.col("_json_alone._corrupt").isNull(), fields).when(
        F.col("_json_member._corrupt").isNull() & (F.size("_json_element") == 1), F.col("_json_member.line"))
    return p.select(*lines.columns, "_broken", doc.alias("_doc"))


def parse_event_lines(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds the typed event fields and ``failed_rules`` (empty array = valid) to every line."""
    p = _sole_objects(lines, raw)
    fields = (*TEXT_FIELDS, "amount_minor")

    p = p.select(
        "*",
        *[F.schema_of_variant(F.col(f"_doc.{f}")).alias(f"_t_{f}") for f in fields],
        *[F.try_variant_get(F.col(f"_doc.{f}"), "$", "string").alias(f"_s_{f}") for f in fields],
        F.try_variant_get(F.col("_doc.amount_minor"), "$", "double").alias("_double"),
    )

    def text(f: str) -> Column:
        told = F.when(F.col(f"_t_{f}") == F.lit("STRING"), F.col(f"_s_{f}"))
        return F.when(F.col("_broken") & told.contains(_MARK), F.lit(None)).otherwise(told)

    p = p.select(
        *lines.columns,
        F.col("_doc").isNotNull().alias("_is_object"),
        "_double",
        F.col("_t_amount_minor").alias("_json_kind"),
        strip(F.col("_s_amount_minor")).alias("_json_written"),
        F.col("_t_occurred_at").alias("_json_when_kind"),
        F.col("_s_occurred_at").alias("_json_when_text"),
        text("occurred_at").alias("_json_when"),
        *[text(f).alias(f) for f in TEXT_FIELDS if f != "occurred_at"],
    )
    kind, written = F.col("_json_kind"), F.col("_json_written")
    digits = F.regexp_replace(F.regexp_replace(written, r"(\.0+)?$", ""), "_", "")
    amount = (
        F.when(kind == "BOOLEAN", F.when(written == "true", F.lit(1)).otherwise(F.lit(0)).cast("bigint"))
        .when(kind.isin("FLOAT", "DOUBLE"), F.when(F.col("_double") == F.floor("_double"), F.col("_double").try_cast("bigint")))
        .when((kind == "STRING") | kind.isin(*NUMERIC_TYPES) | kind.startswith("DECIMAL"),
              F.when(written.rlike(WHOLE_NUMBER), digits.try_cast("decimal(38,0)").try_cast("bigint")))
    )
    when_kind, when_text = F.col("_json_when_kind"), F.col("_json_when_text")
    number = F.when(when_kind.isin("FLOAT", "DOUBLE"), when_text.try_cast("double").try_cast("decimal(38,9)")).when(
        when_text.rlike(NUMBER_SHAPE), when_text.try_cast("decimal(38,9)"))
    timed = when_kind.isin("STRING", *NUMERIC_TYPES) | when_kind.startswith("DECIMAL")
    p = p.select(
        *lines.columns,
        "_is_object",
        "event_id",
        "account_id",
        amount.alias("_amount"),
        normalised_currency("currency").alias("currency"),
        "direction",
        "transaction_type",
        F.coalesce(iso_to_utc(F.col("_json_when")), F.when(timed, epoch_to_utc(number))).alias("occurred_at"),
        "source_system",
    )
    rules = {
        "event_id": min_length("event_id", 8),
        "account_id": min_length("account_id", 1),
        "amount_minor": F.col("_amount") != 0,
        "currency": F.col("currency").rlike(THREE_LETTERS),
        "direction": is_direction("direction"),
        "transaction_type": is_transaction_type("transaction_type"),
        "occurred_at": F.col("occurred_at").isNotNull(),
        "source_system": min_length("source_system", 1),
    }
    failed = F.when(F.col("_is_object"), failed_rule_list(rules)).otherwise(F.lit("json_object"))
    verdict = F.struct(
        *[c for c in EVENT_OUTPUT if c != "amount_minor"][:2],
        F.when(F.col("_amount") != 0, F.col("_amount")).alias("amount_minor"),
        *[c for c in EVENT_OUTPUT if c != "amount_minor"][2:],
        F.when(failed == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(failed, ","))
        .alias("failed_rules"),
    )
    # The verdict leaves through a one-row generator: a filter on it (valid rows, dead letter) then
    # runs after the parse instead of being pushed into the scan with the whole parse inlined.
    return p.select(*lines.columns, F.inline(F.array(verdict)))


def valid_events(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return parsed.filter(F.size("failed_rules") == 0).select(*keep, *EVENT_OUTPUT)


def dead_letter(parsed: DataFrame, keep: tuple[str, ...] = (), raw: str = "raw") -> DataFrame:
    return parsed.filter(F.size("failed_rules") > 0).select(*keep, raw, "failed_rules")


def split_event_lines(lines: DataFrame, raw: str = "raw", keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """``(valid, dead_letter)`` from one parse; persist or checkpoint ``parsed`` if both are written."""
    parsed = parse_event_lines(lines, raw)
    return valid_events(parsed, keep), dead_letter(parsed, keep, raw)


def event_json(records: DataFrame) -> Column:
    """One event record (eight fields, ``occurred_at`` a UTC ``timestamp_ntz``) as compact JSON text.

    The timestamp is written with microseconds and a ``Z`` (``to_json`` would cut it to milliseconds).
    """
    return F.to_json(
        F.struct(
            "event_id",
            "account_id",
            "amount_minor",
            "currency",
            "direction",
            "transaction_type",
            F.date_format("occurred_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("occurred_at"),
            "source_system",
        )
    )


def read_events_json(spark, path: str, *, streaming: bool = False) -> DataFrame:
    """A plain typed read of JSON event files with the declared 8-field schema (no inference).

    Fields that do not fit the schema come back NULL; use ``parse_event_lines`` over ``read.text`` when
    bad lines must be kept with the reason they failed.
    """
    from ledgerproof.schemas import EVENT_JSON_SCHEMA

    reader = spark.readStream if streaming else spark.read
    return reader.schema(EVENT_JSON_SCHEMA).json(path)
