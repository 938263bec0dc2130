"""Codes, labels, references and numbers as column expressions. Alias tables are data."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: compact form -> measure code. Fixed values.
MEASURES = {"no2": "no2", "ino2": "no2", "nitrogendioxide": "no2", "pm25": "pm25", "pm2": "pm25", "ipm25": "pm25", "pm10": "pm10", "ipm10": "pm10", "o3": "o3", "ozone": "o3"}
#: Form of a postcode. Fixed value.
POSTCODE = r"^(GIR0AA|[A-Z]{1,2}\d[A-Z\d]?\d[A-Z]{2})$"


def measure_code(text: Column) -> Column:
    compact = F.regexp_replace(F.lower(F.trim(text)), "[^a-z0-9]+", "")
    out = F.lit(None).cast("string")
    for code in dict.fromkeys(MEASURES.values()):
        out = F.when(compact.isin(*[k for k, v in MEASURES.items() if v == code]), code).otherwise(out)
    return out


def allowed(text: Column, values) -> Column:
    """Lower case and trimmed if it is one of the values, else null."""
    t = F.lower(F.trim(text))
    return F.when(t.isin(*values), t)


def number(text: Column) -> Column:
    """A finite number or null."""
    n = F.trim(text).try_cast("double")
    return F.when(~F.isnan(n) & (F.abs(n) != float("inf")), n)


def positive_int(text: Column) -> Column:
    n = number(text)
    return F.when((n > 0) & (n == F.floor(n)), n.cast("long"))


def capped(text: Column, most: int) -> Column:
    n = number(text)
    return F.when(n >= 0, F.least(n, F.lit(most)).cast("int"))


#: Unit as sources write it, in lower case -> unit. Fixed values.
UNITS = {"ugm-3": "ug/m3", "µgm-3": "ug/m3", "μgm-3": "ug/m3", "mgm-3": "mg/m3"}
#: What is dropped from a label without a space, and what becomes one. Fixed values.
SUBSCRIPT, BETWEEN = r"<\s*/?\s*sub\s*>", "[^a-z0-9]+"


def unit(text: Column) -> Column:
    """As shown: micrograms a cubic metre in one form, others as they are."""
    t = F.lower(F.trim(text))
    micro = F.regexp_replace(t, "[µμ]", "u")
    return F.when(micro.contains("ug") & micro.rlike(r"m\s*[-^]?\s*3"), "µg/m³").when(t != "", F.trim(text))


def unit_code(text: Column) -> Column:
    """As stored: known aliases to one code, others trimmed; null is empty."""
    t = F.coalesce(F.trim(text), F.lit(""))
    known = F.element_at(F.create_map(*[F.lit(x) for pair in UNITS.items() for x in pair]), F.lower(t))
    return F.coalesce(known, t)


def unescaped(text: Column) -> Column:
    """Character references resolved: decimal and hexadecimal numbers, and the names of HTML (Python's own table). Only
    texts with an ampersand are handed over."""
    @F.pandas_udf("string")
    def resolved(v: pd.Series) -> pd.Series:
        return v.map(lambda x: None if x is None else html.unescape(x))

    return F.coalesce(resolved(F.when(text.contains("&"), text)), text)


def label(text: Column) -> Column:
    """For matching: character references resolved, subscript tags dropped, and all but letters and digits one space."""
    t = F.regexp_replace(F.lower(unescaped(text)), SUBSCRIPT, "")
    return F.trim(F.regexp_replace(F.replace(t, F.lit("ß"), F.lit("ss")), BETWEEN, " "))


def station_label(name: Column, ref: Column, series: Column) -> Column:
    """The name, else the first part of the series label that is no address, else the reference."""
    parts = F.filter(F.transform(F.when(series.contains(" - "), F.split(series, " - ")).otherwise(F.split(series, "-")), lambda p: F.trim(p)), lambda p: p != "")
    first = F.get(parts, F.lit(0))
    url = first.rlike(r"^(https?://|www\.)")
    derived = F.when(url & (F.size(parts) > 1), F.element_at(parts, -1)).when(url, F.lit(None)).otherwise(first)
    filled = lambda c: F.when(F.trim(c) != "", F.trim(c))
    return F.coalesce(filled(name), filled(derived), filled(ref))


def phenomenon_label(*chain: Column) -> Column:
    """The first that is not empty; of the last, the last part after a colon or slash."""
    last = F.try_element_at(F.filter(F.split(chain[-1], "[:/]"), lambda p: p != ""), F.lit(-1))
    return F.coalesce(*[F.when(c != "", c) for c in chain[:-1]], last)


def _filled(text: Column) -> Column:
    return F.when(F.trim(text) != "", F.trim(text))


def rendered(template: Column, name: Column, ref: Column, label: Column | None = None) -> Column:
    """{station_name}, {station_label} and {station_ref} filled in as they are written here (the reference is left out where
    the template has both and the name holds it); empty brackets, double spaces and delimiters at the ends go."""
    empty = lambda c: F.coalesce(c, F.lit("")) if c is not None else F.lit("")
    n, r = empty(name), F.coalesce(_filled(ref), F.lit(""))
    both = template.rlike(r"(?i)\{station_name\}") & template.rlike(r"(?i)\{station_ref\}")
    r = F.when(both & (F.trim(n) != "") & (r != "") & F.contains(F.lower(n), F.lower(r)), "").otherwise(r)
    t = template
    for token, value in (("station_name", n), ("station_label", empty(label)), ("station_ref", r)):
        t = F.replace(t, F.lit("{" + token + "}"), value)
    t = F.regexp_replace(F.regexp_replace(t, r"\(\s*\)|\[\s*\]", ""), r"\s+", " ")
    t = F.regexp_replace(t, r"^[\s,:;|/-]+|[\s,:;|/-]+$", "")
    return F.when(t != "", t)


def display_name(template: Column, name: Column, label: Column, ref: Column, ident: Column) -> Column:
    """The template rendered, or if there is none or nothing comes of it: the name with the reference unless the name holds
    it, else the label, the reference, or the number."""
    n, r = _filled(name), _filled(ref)
    named = F.when(r.isNull() | F.contains(F.lower(n), F.lower(r)), n).otherwise(F.concat(n, F.lit(" - "), r))
    plain = F.coalesce(named, _filled(label), r, F.concat(F.lit("Station "), _filled(ident.cast("string"))))
    return F.coalesce(rendered(_filled(template), name, ref, label), plain)


def reference_parts(ref: Column) -> tuple[Column, Column]:
    """What stands before and after the last colon."""
    last = F.substring_index(ref, ":", -1)
    has = ref.contains(":")
    return F.when(has, F.regexp_replace(ref, ":[^:]*$", "")), F.when(has, last)


def postcode(text: Column) -> Column:
    compact = F.regexp_replace(F.upper(F.trim(text)), "[^A-Z0-9]", "")
    return F.when(compact.rlike(POSTCODE), compact)


def postcode_shard(code: Column) -> Column:
    return F.regexp_extract(code, "^[A-Z]+", 0)


def postcode_outward(code: Column) -> Column:
    return F.regexp_replace(code, ".{3}$", "")


def postcode_display(code: Column) -> Column:
    return F.regexp_replace(code, "(.{3})$", " $1")


def coordinate(text: Column, least: float, most: float) -> Column:
    n = number(text)
    return F.when(n.between(least, most), F.round(n, 6))


def canonical_number(value: Column) -> Column:
    """As text, with -0 as 0."""
    return (value + F.lit(0.0)).cast("string")


def verification(code: Column) -> Column:
    """P (also provisional), R (also ratified) or null; anything else is an error."""
    t = F.lower(F.trim(code))
    known = F.when(t.isin("p", "provisional"), "P").when(t.isin("r", "ratified"), "R")
    return F.when(t.isNull() | (t == ""), F.lit(None).cast("string")).otherwise(F.coalesce(known, F.raise_error(F.concat(F.lit("unknown verification status "), t))))


def _scaled(value: Column, power: Column) -> Column:
    """value * 2**power without leaving the range on the way: in two steps, each an exact power of two."""
    half = F.floor(power / 2)
    return value * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)


def float_bits(value: Column) -> Column:
    """The sixteen hexadecimal digits of a finite double, most significant first; -0 as 0. Exponent and mantissa are found
    by exact arithmetic. Null stays null; no number and infinite ones are an error."""
    a = F.abs(value)
    guess = F.floor(F.log2(a))
    # The logarithm may be off by one next to a power of two; below the normal range the exponent is -1022.
    e = guess + F.when(_scaled(a, -guess) >= 2, 1).when(_scaled(a, -guess) < 1, -1).otherwise(0)
    e = F.greatest(e, F.lit(-1022))
    mantissa = _scaled(a, 52 - e).cast("long")
    bits = F.when(mantissa >= 1 << 52, F.shiftleft((e + 1022).cast("long"), 52) + mantissa).otherwise(mantissa)
    bits = F.when(value == 0, F.lit(0).cast("long")).otherwise(F.when(value < 0, bits.bitwiseOR(F.lit(-(1 << 63)))).otherwise(bits))
    finite = ~F.isnan(value) & (a != float("inf"))
    return F.when(value.isNull(), F.lit(None).cast("string")).when(finite, F.lower(F.lpad(F.hex(bits), 16, "0"))).otherwise(F.raise_error(F.lit("value must be a finite number")).cast("string"))


def bits_float(text: Column) -> Column:
    """The double of sixteen hexadecimal digits."""
    high = F.conv(F.substring(text, 1, 3), 16, 10).cast("int")
    low = F.conv(F.substring(text, 4, 13), 16, 10).cast("long")
    e = high.bitwiseAND(0x7FF)
    size = F.when(e == 0x7FF, F.when(low == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))).when(e == 0, _scaled(low.cast("double"), F.lit(-1074))).otherwise(_scaled((low + (1 << 52)).cast("double"), e - 1075))
    return F.when(high >= 0x800, -size).otherwise(size)


#: Form of a measure's code in canonical rows. Fixed value.
CANONICAL_CODE = "^[a-z0-9_]+$"


def canonical_row(connector: Column, station: Column, series: Column, measure: Column, at: Column, value: Column, status: Column) -> Column:
    """A row as a JSON array: ids as numbers (the station's may be null), measure, time in milliseconds, the value's bits,
    P, R or null. What has no such form is an error: ids that are not positive, other codes, finer times, values that are
    no finite number, other statuses."""
    wrong = lambda what: F.raise_error(F.lit(what)).cast("string")
    ident = lambda c, name: F.when(c > 0, c.cast("string")).otherwise(wrong(f"{name} must be a positive number"))
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    exact = F.unix_micros(at.cast("timestamp")) % 1000 == 0
    return F.concat(
        F.lit("["), F.concat_ws(
            ",", ident(connector, "connector"), F.when(station.isNull(), "null").otherwise(ident(station, "station")), ident(series, "series"),
            F.when(measure.rlike(CANONICAL_CODE), quoted(measure)).otherwise(wrong("measure must be a lower-case code")),
            F.when(exact, quoted(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))).otherwise(wrong("time must be in whole milliseconds")),
            F.when(value.isNull(), wrong("value must be a finite number")).otherwise(quoted(float_bits(value))),
            F.when(status.isNull(), "null").when(status.isin("P", "R"), quoted(status)).otherwise(wrong("status must be P, R or null")),
        ), F.lit("]"),
    )


def range_start(ident: Column, width: int = 1000) -> Column:
    return F.floor(ident / width) * width


def cache_class(end: Column, now: str, hours: int = 120) -> Column:
    """Rows of the last hours may still change."""
    return F.when(end <= F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {hours} HOURS"), "immutable").otherwise("mutable")
