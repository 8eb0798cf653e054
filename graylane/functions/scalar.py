"""Column functions: labels, tolerant and strict parsing, identities, fingerprints, dates. All stay in the JVM."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from graylane.operators.joins import small


def label(col: Column, mapping: dict, keep_unknown: bool = True) -> Column:
    """The label of a code; an unknown code stays as it is, or is null."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    found = F.try_element_at(pairs, col)
    return F.coalesce(found, col) if keep_unknown else found


def normal_status(col: Column) -> Column:
    """Trimmed, lower case, blanks and hyphens as one underscore."""
    return F.regexp_replace(F.lower(F.trim(col)), r"[-\s]+", "_")


def status_catalog(df: DataFrame, col: str, catalog: DataFrame) -> DataFrame:
    """df with label, terminal and known; catalog has code, label, terminal. Unknown codes keep the raw text and aren't terminal."""
    c = catalog.select(F.col("code").alias("_code"), F.col("label").alias("_label"), F.col("terminal").alias("_terminal"))
    joined = df.join(small(c), normal_status(F.col(col)) == F.col("_code"), "left")
    return joined.withColumns({"label": F.coalesce("_label", col), "terminal": F.coalesce("_terminal", F.lit(False)), "known": F.col("_code").isNotNull()}).drop("_code", "_label", "_terminal")


def parse_decimal(col: Column, precision: int, scale: int) -> Column:
    """A number with currency signs, blanks and thousands' commas; null for blank or bad text."""
    number = F.regexp_extract(F.trim(col), r"^(?:[A-Za-z]{0,3}[$€£]?\s*)([-+]?[0-9][0-9,]*(?:\.[0-9]+)?)$", 1)
    return F.nullif(F.regexp_replace(number, ",", ""), F.lit("")).try_cast(f"decimal({precision},{scale})")


def strict_number(col: Column, given: Column | None = None) -> Column:
    """struct(state, number): ABSENT, NULL, VALID or INVALID; ASCII digits only, at most 9 decimals and 38 digits, nothing behind them. given: the field's presence, which tells NULL from ABSENT; without it a missing text is ABSENT."""
    ok = col.rlike(r"\A-?[0-9]{1,29}(\.[0-9]{1,9})?\z")
    missing = F.lit("ABSENT") if given is None else F.when(given == "ABSENT", "ABSENT").otherwise("NULL")
    state = F.when(col.isNull(), missing).when(ok, "VALID").otherwise("INVALID")
    return F.struct(state.alias("state"), F.when(ok, col).try_cast("decimal(38,9)").alias("number"))


def presence(json: Column, field: str) -> Column:
    """ABSENT, NULL or VALUE of a field of a JSON object."""
    there = F.array_contains(F.json_object_keys(json), field)
    return F.when(~F.coalesce(there, F.lit(False)), "ABSENT").when(F.get_json_object(json, f"$.{field}").isNull(), "NULL").otherwise("VALUE")


def document_key(col: Column, digits: int = 14) -> Column:
    """The digits of a document number if there are exactly so many, else null."""
    only = F.regexp_replace(col, "[^0-9]", "")
    return F.when(F.length(only) == digits, only)


def party_key(document: Column, name: Column) -> Column:
    """`doc:` and the document number, else `name:` and the normalised name."""
    doc = document_key(document)
    return F.when(doc.isNotNull(), F.concat(F.lit("doc:"), doc)).otherwise(F.concat(F.lit("name:"), F.upper(F.trim(F.regexp_replace(name, r"\s+", " ")))))


#: Letters are equal whatever their case and accents, in whatever form the accents are written.
CI_AI = "UNICODE_CI_AI"


def folded(col: Column) -> Column:
    """The text for comparisons and joins that ignore case and accents."""
    return F.collate(col, CI_AI)


def contains_tokens(col: Column, tokens: Sequence[str]) -> Column:
    """The tokens stand in the text in this order, one behind the other, whatever case and accents either has. A match ends with the fewest characters that equal the token, as accents may be characters of their own."""
    text, at = folded(col), F.lit(1)

    def behind(start: Column, token: Column) -> Column:
        found = F.call_function("locate", token, text, start)
        lengths = F.sequence(F.length(token), 4 * F.length(token))
        size = F.get(F.filter(lengths, lambda n: F.substring(text, found, n) == folded(token)), F.lit(0))
        return F.when((start == 0) | (found == 0), 0).otherwise(found + F.coalesce(size, F.length(token)))

    return F.coalesce(F.aggregate(F.array(*[F.lit(t) for t in tokens]), at, behind) > 0, F.lit(False))


def contains_ci_ai(col: Column, token: str) -> Column:
    return F.contains(F.collate(col, "UNICODE_CI_AI"), F.collate(F.lit(token), "UNICODE_CI_AI"))


def starts_with_ci_ai(col: Column, token: str) -> Column:
    return F.startswith(F.collate(col, "UNICODE_CI_AI"), F.collate(F.lit(token), "UNICODE_CI_AI"))


def civil_date(instant: Column, zone: str) -> Column:
    """The calendar day of a UTC instant in a zone; 1900-01-01 stands for no date."""
    day = F.to_date(F.from_utc_timestamp(instant.cast("timestamp"), zone))
    return F.when(day != F.lit("1900-01-01").cast("date"), day)


def to_instant(col: Column, zone: str) -> Column:
    """Text with an offset is an instant; text without one is local time of the zone."""
    has_offset = col.rlike(r"(Z|[+-][0-9]{2}:?[0-9]{2})$")
    return F.when(has_offset, F.try_to_timestamp(col)).otherwise(F.to_utc_timestamp(F.try_to_timestamp(col), zone))


def clock_text(col: Column) -> Column:
    """HH:mm[:ss] of a bare time or a date-time text, else null."""
    found = F.regexp_extract(col, r"(?:^|[T ])([01][0-9]|2[0-3])(:[0-5][0-9](?::[0-5][0-9])?)", 1)
    rest = F.regexp_extract(col, r"(?:^|[T ])([01][0-9]|2[0-3])(:[0-5][0-9](?::[0-5][0-9])?)", 2)
    return F.when(found != "", F.concat(found, rest))


def type_token(col: Column, sep: str = "::") -> Column:
    """What follows the last separator."""
    return F.substring_index(col, sep, -1)


def row_hash(cols: Sequence[str], null_marker: str = "\\N", sep: str = "|") -> Column:
    """sha-256 of the columns' texts, with a marker for null."""
    return F.sha2(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit(null_marker)) for c in cols]), 256)


def framed_hash(cols: Sequence[str]) -> Column:
    """sha-256 of the columns' texts, each after its length in bytes (-1 for null), so no two rows share their bytes."""
    parts = [F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-1:")) for c in cols]
    return F.sha2(F.concat(*parts), 256)


def stable_json_hash(json: Column, drop: Sequence[str] = ()) -> Column:
    """sha-256 of an object's fields in the order of their names, without some; objects inside are ordered too. Names and values are each framed by their length in bytes. Null for what is no JSON object."""
    fields = F.try_parse_json(json).cast("map<string,variant>")
    kept = F.map_filter(fields, lambda k, _: ~k.isin(*drop)) if drop else fields
    entries = F.array_sort(F.transform(F.map_entries(kept), lambda e: F.struct(e["key"].alias("k"), F.to_json(e["value"]).alias("v"))))
    frame = lambda c: F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)
    return F.sha2(F.array_join(F.transform(entries, lambda e: F.concat(frame(e["k"]), frame(e["v"]))), ""), 256)


def identity_key(rules: Sequence[tuple[str, Column]]) -> Column:
    """sha-256 of `tag:value` of the first rule whose value isn't null."""
    return F.sha2(F.coalesce(*[F.concat(F.lit(f"{tag}:"), value.cast("string")) for tag, value in rules]), 256)


def canonical_list(col: Column, sep: str = ",") -> Column:
    """Elements trimmed, blanks dropped, sorted and joined; an empty list is '', a missing one null."""
    return F.array_join(F.array_sort(F.filter(F.transform(col, lambda x: F.trim(x)), lambda x: F.coalesce(x != "", F.lit(False)))), sep)


def join_array(col: Column, sep: str = ", ") -> Column:
    """Elements in order for display, without brackets and quotes."""
    return F.regexp_replace(F.array_join(col, sep), r"[\[\]\"]", "")


def amounts(json: Column, precision: int = 18, scale: int = 2) -> Column:
    """An object with any keys as a map of exact decimals."""
    return F.from_json(json, f"map<string,decimal({precision},{scale})>")


def sum_components(cols: Sequence[Column], kind: str = "decimal(18,2)") -> Column:
    """The sum with null as zero."""
    return functools.reduce(operator.add, [F.coalesce(c.cast(kind), F.lit(0).cast(kind)) for c in cols])


def delay_band(days: Column) -> Column:
    """Nine signed bands of days late; negative is early."""
    return (
        F.when(days <= -4, "-4 or less").when(days == -3, "-3").when(days == -2, "-2").when(days == -1, "-1").when(days == 0, "0")
        .when(days == 1, "+1").when(days == 2, "+2").when(days == 3, "+3").when(days >= 4, "+4 or more")
    )


def route_parts(col: Column, sep: str = " X ") -> tuple[Column, Column]:
    """Origin and destination of a route text; null where it has no two parts."""
    parts = F.split(col, sep)
    two = F.size(parts) == 2
    return F.when(two, F.trim(F.get(parts, F.lit(0)))), F.when(two, F.trim(F.get(parts, F.lit(1))))


#: The longest duration of a trip in minutes (fixed value).
LONGEST = 43_200


def duration_text(minutes: Column, least: int = 0, most: int = LONGEST) -> Column:
    """HH:mm of minutes within bounds, else null."""
    inside = minutes.between(least, most)
    return F.when(inside, F.format_string("%02d:%02d", F.floor(minutes / 60).cast("int"), (minutes % 60).cast("int")))


def transit_minutes(direct: Column, start: Column, arrival: Column, end: Column) -> tuple[Column, Column, Column]:
    """(minutes, provenance, invalid) of a trip: its stated minutes within bounds (DIRECT), else from the planned start to the planned arrival, or end, by the clock's minutes (PREDICTED_DIFFERENCE), else null (INVALID_OR_ABSENT); invalid: minutes are stated and out of bounds."""
    inside = lambda m: F.coalesce(m.between(0, LONGEST), F.lit(False))
    minute = lambda c: F.floor(F.unix_timestamp(c.cast("timestamp")) / 60)
    planned = minute(F.coalesce(arrival, end)) - minute(start)
    provenance = F.when(inside(direct), "DIRECT").when(inside(planned), "PREDICTED_DIFFERENCE").otherwise("INVALID_OR_ABSENT")
    return F.when(inside(direct), direct).when(inside(planned), planned), provenance, direct.isNotNull() & ~inside(direct)


def payment_state(paid: Column, due: Column, at: Column) -> Column:
    return F.when(paid.isNotNull() & (paid <= at), "PAID").when(due.isNull(), "UNDATED").when(due < at, "OVERDUE").otherwise("OPEN")


def first_evidence(rules: Sequence[tuple[str, Column]]) -> Column:
    """The name of the first rule that holds."""
    return F.coalesce(*[F.when(c, name) for name, c in rules])


def freshness_max(instants: Sequence[Column], days: Sequence[Column]) -> Column:
    """The latest of instants and of the ends of civil days (the next midnight)."""
    return F.greatest(*[c.cast("timestamp") for c in instants], *[F.date_add(d, 1).cast("timestamp") for d in days])


def freshness_first(sources: Sequence[tuple[str, Column]]) -> Column:
    """The first source that isn't null: an instant, or of a civil day (kind `day`) its end (the next midnight)."""
    return F.coalesce(*[(F.date_add(c, 1) if kind == "day" else c).cast("timestamp") for kind, c in sources])


def freshness_strict(sources: Sequence[tuple[str, Column]]) -> Column:
    """struct(at, origin, reason): the first given text; if it is no time, that is the result, without a fall to the next."""
    at, origin, reason = F.lit(None).cast("timestamp"), F.lit(None).cast("string"), F.lit("MISSING")
    for name, text in reversed(list(sources)):
        parsed = F.try_to_timestamp(text)
        given = text.isNotNull()
        at, origin = F.when(given, parsed).otherwise(at), F.when(given, F.lit(name)).otherwise(origin)
        reason = F.when(given, F.when(parsed.isNull(), "INVALID").otherwise("OK")).otherwise(reason)
    return F.struct(at.alias("at"), origin.alias("origin"), reason.alias("reason"))


def typed_key(kind: str, value: Column) -> Column:
    """struct(key, valid): the kind before the value; valid without blanks at the ends and within 1 to 100 characters."""
    return F.struct(F.concat(F.lit(f"{kind}:"), value).alias("key"), F.coalesce(value.rlike(r"\A\S(.{0,98}\S)?\z"), F.lit(False)).alias("valid"))


def yyyymm(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def typed_projection(json: Column, schema: DataType | str) -> Column:
    """The declared fields of an object; what doesn't fit its type is null."""
    return F.from_json(json, schema, {"mode": "PERMISSIVE"})
