"""Text normalisation as column expressions.

White space here is what a browser's regular expressions call white space; Java's ``\\s`` alone is narrower.
"""

from __future__ import annotations

import functools
import json
import sys
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"[\s\u00A0\uFEFF\p{Z}]"
APOSTROPHES = "['’]"


def trimmed(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def collapsed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, f"{WS}+", " "))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def blank(c: Column) -> Column:
    """Null where a string is empty."""
    return F.nullif(c, F.lit(""))


def words_text(c: Column) -> Column:
    """Lower case, underscores and hyphens as spaces, white space collapsed; null gives ''."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), f"[_{WS[1:-1]}-]+", " "))


def title_text(c: Column) -> Column:
    """As ``words_text``, with all but letters, numbers and white space as spaces."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def field_key(c: Column) -> Column:
    """Lower case, only a-z and 0-9; null gives ''."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]", "")


def identity_key(c: Column) -> Column:
    """As ``field_key``, but null where nothing is left."""
    return blank(field_key(c))


@functools.cache
def decompositions() -> tuple[str, str, dict[str, str]]:
    """Of all characters whose compatibility form without the marks U+0300 to U+036F differs from them: those with one character, their forms, and those with several.

    Marks themselves come last in the first text, without a form. Syllables of Hangul are left out.
    """
    ones, forms, several, gone = [], [], {}, []
    for c in map(chr, [*range(0x80, 0xAC00), *range(0xD7A4, 0xD800), *range(0xE000, sys.maxunicode + 1)]):
        if "\u0300" <= c <= "\u036f":
            gone.append(c)
        elif unicodedata.decomposition(c):
            form = "".join(x for x in unicodedata.normalize("NFKD", c) if not "\u0300" <= x <= "\u036f")
            if len(form) == 1:
                ones.append(c)
                forms.append(form)
            elif form:
                several[c] = form
            else:
                gone.append(c)
    return "".join(ones + gone), "".join(forms), several


def unaccented(c: Column) -> Column:
    """Compatibility decomposition without combining marks U+0300 to U+036F; only texts that aren't ASCII are looked at.

    Characters with one character as their form are translated, syllables of Hangul are taken apart by arithmetic, and
    only where one with a longer form is found are characters looked up one by one.
    """
    ones, forms, several = decompositions()
    starts = sorted(map(ord, several))
    ranges, first = [], None
    for n in [*starts, None]:
        if first is not None and n != last + 1:
            ranges.append((first, last))
            first = None
        if first is None:
            first = n
        last = n
    longer = "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "\\x{AC00}-\\x{D7A3}]"
    table = F.from_json(F.lit(json.dumps(several)), "map<string,string>")

    def taken(x: Column) -> Column:
        n = F.ascii(x) - 0xAC00
        parts = F.concat(*(_letter(v) for v in (F.floor(n / 588) + 0x1100, F.floor(n % 588 / 28) + 0x1161)), F.when(n % 28 > 0, _letter(n % 28 + 0x11A7)).otherwise(""))
        return F.when(x.between("\uac00", "\ud7a3"), parts).otherwise(F.coalesce(F.try_element_at(table, x), x))

    letters = F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: taken(F.substr(c, i, F.lit(1))))
    whole = F.when(c.rlike(longer), F.array_join(letters, "")).otherwise(c)
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.translate(whole, ones, forms)).otherwise(c)


def _letter(n: Column) -> Column:
    """The character with a number from 0x800 to 0xFFFF."""
    raw = F.concat(*(F.lpad(F.hex(x.cast("long")), 2, "0") for x in (F.floor(n / 4096) + 0xE0, F.floor(n % 4096 / 64) + 0x80, n % 64 + 0x80)))
    return F.decode(F.unhex(raw), "UTF-8")


def place_key(c: Column) -> Column:
    """A city's name in the registry's comparisons: no accents or apostrophes, all other punctuation as space."""
    plain = F.regexp_replace(F.lower(unaccented(c)), APOSTROPHES, "")
    return collapsed(F.regexp_replace(F.regexp_replace(plain, "-", " "), r"[^\p{L}\p{N}\s\u00A0\uFEFF\p{Z}]", " "))


def census_key(c: Column) -> Column:
    """A city's name in the gazetteer's comparisons: periods and apostrophes are dropped, other punctuation stays."""
    plain = F.regexp_replace(F.lower(unaccented(c)), r"\.|" + APOSTROPHES, "")
    return collapsed(F.regexp_replace(plain, "-", " "))


def without_place_suffix(c: Column) -> Column:
    """A place's name without one trailing kind of place."""
    return trimmed(F.regexp_replace(c, f"(?i){WS}+(city|town|village|borough|municipality|township)$", ""))


# Codes and names of the states and the capital's district.
STATES = {
    "AL": "ALABAMA", "AK": "ALASKA", "AZ": "ARIZONA", "AR": "ARKANSAS", "CA": "CALIFORNIA", "CO": "COLORADO", "CT": "CONNECTICUT",
    "DE": "DELAWARE", "DC": "DISTRICT OF COLUMBIA", "FL": "FLORIDA", "GA": "GEORGIA", "HI": "HAWAII", "ID": "IDAHO", "IL": "ILLINOIS",
    "IN": "INDIANA", "IA": "IOWA", "KS": "KANSAS", "KY": "KENTUCKY", "LA": "LOUISIANA", "ME": "MAINE", "MD": "MARYLAND",
    "MA": "MASSACHUSETTS", "MI": "MICHIGAN", "MN": "MINNESOTA", "MS": "MISSISSIPPI", "MO": "MISSOURI", "MT": "MONTANA", "NE": "NEBRASKA",
    "NV": "NEVADA", "NH": "NEW HAMPSHIRE", "NJ": "NEW JERSEY", "NM": "NEW MEXICO", "NY": "NEW YORK", "NC": "NORTH CAROLINA",
    "ND": "NORTH DAKOTA", "OH": "OHIO", "OK": "OKLAHOMA", "OR": "OREGON", "PA": "PENNSYLVANIA", "RI": "RHODE ISLAND",
    "SC": "SOUTH CAROLINA", "SD": "SOUTH DAKOTA", "TN": "TENNESSEE", "TX": "TEXAS", "UT": "UTAH", "VT": "VERMONT", "VA": "VIRGINIA",
    "WA": "WASHINGTON", "WV": "WEST VIRGINIA", "WI": "WISCONSIN", "WY": "WYOMING",
}


def state_code(c: Column) -> Column:
    """The two-letter code of a state given by code or name; anything else trimmed and in capitals."""
    up = F.upper(trimmed(c))
    names = F.create_map(*(F.lit(x) for code, name in STATES.items() for x in (name, code)))
    return F.coalesce(F.try_element_at(names, up), up)


def coordinate(c: Column) -> Column:
    """A finite number, else null; white space only counts as 0, an empty string as null, 0x.. as hexadecimal."""
    t = trimmed(c)
    hexa = F.when(t.rlike("^0[xX][0-9a-fA-F]{1,15}$"), F.conv(F.substring(t, 3, 20), 16, 10).cast("double"))
    decimal = F.when(t.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), t.try_cast("double"))
    number = F.when(c == "", F.lit(None).cast("double")).when(t == "", F.lit(0.0)).otherwise(F.coalesce(hexa, decimal))
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def byte_size(c: Column) -> Column:
    """A number of bytes as B, KB or MB, the last two with one decimal."""
    kilo, mega = (F.concat(fixed(c / n, 1), F.lit(unit)) for n, unit in ((1024, " KB"), (1024 * 1024, " MB")))
    return F.when(c < 1024, F.concat(c.cast("string"), F.lit(" B"))).when(c < 1024 * 1024, kilo).otherwise(mega)


def fixed(c: Column, digits: int) -> Column:
    """A double with so many decimals (three at most), rounded by its exact binary value, ties away from zero.

    The product with a power of ten is rounded; what that loses is worked out from the number's two halves, and says
    on which side of a tie the exact product is. Null for what is no number.
    """
    x, m = F.abs(c.cast("double")), F.lit(float(10**digits))
    big = x * 134217729.0
    high = big - (big - x)
    p = x * m
    lost = (high * m - p) + (x - high) * m
    half = p - F.floor(p)
    up = F.when((half > 0.5) | ((half == 0.5) & (lost >= 0)), 1).otherwise(0)
    n = F.floor(p).cast("long") + up
    shown = F.concat(F.floor(n / 10**digits).cast("string"), F.lit("."), F.lpad((n % 10**digits).cast("string"), digits, "0"))
    exact = F.when(x < 1e12, F.concat(F.when(c < 0, "-").otherwise(""), shown)).otherwise(c.cast(f"decimal(38,{digits})").cast("string"))
    return F.when(F.isnan(c.cast("double")), None).otherwise(exact)


def iso_now() -> Column:
    """The time of the query in UTC with milliseconds."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


# The standard form of dates (a day up to 31 in any month), and how one begins that has a time.
_STANDARD = r"(?:[+-][0-9]{6}|[0-9]{4})(?:-(?:0[1-9]|1[0-2])(?:-(?:0[1-9]|[12][0-9]|3[01]))?)?"
_CLOCK = r"(?:(?:[01][0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9](?:\.[0-9]+)?)?|24:00(?::00(?:\.0+)?)?)"
STANDARD_DATE = rf"^{_STANDARD}(?:[Tt]{_CLOCK}(?:[Zz]|[+-](?:[01][0-9]|2[0-3]):?[0-5][0-9])?)?$"
STANDARD_TIME = rf"^{_STANDARD}[Tt](?![A-Za-z])"
# The tokens of other dates: numbers, words, signs, text in parentheses (up to three deep), white space, anything else.
DATE_TOKENS = r"[0-9]+|[^\x00-\x40\s\u00A0\uFEFF\p{Z}]+|[:.+)-]|\((?:[^()]|\((?:[^()]|\([^()]*\))*\))*\)|[\s\u00A0\uFEFF\p{Z}]+|[\s\S]"
# Words that dates have: months by their first letters, halves of a day, names of time zones.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
ZONES = ["ut", "utc", "z", "gmt", "cdt", "cst", "edt", "est", "mdt", "mst", "pdt", "pst"]
#: The last year that a time can be in.
LAST_YEAR = 275759


def is_date(c: Column) -> Column:
    """Whether a text is a date as a browser reads it; null is none.

    That is the standard form, or a row of numbers, words and signs: a number before a colon is part of the time, what else
    numbers can be depends on what was read, a sign after a time or a zone's name begins an offset, words beside months,
    halves of a day and zones may only stand before the first number, and text in parentheses is passed over.
    """
    text = trimmed(c)
    loose = F.when(text.rlike("[0-9]"), _reads_as_date(text))
    return F.coalesce(text.rlike(STANDARD_DATE) | (~text.rlike(STANDARD_TIME) & F.coalesce(loose, F.lit(False))), F.lit(False))


def _reads_as_date(text: Column) -> Column:
    """One fold over the tokens of a text; the state has what was read so far."""
    whole = F.regexp_extract_all(text, F.lit(DATE_TOKENS), F.lit(0))
    some = F.array().cast("array<long>")
    nothing = F.lit(None).cast("long")

    def state(**parts: Column) -> Column:
        return F.struct(*(v.alias(k) for k, v in parts.items()))

    def kept(s: Column, **new: Column) -> Column:
        names = ("ok", "skip", "number", "days", "month", "times", "half", "hour", "minute")
        return state(**{n: new.get(n, s[n]) for n in names})

    start = state(ok=F.lit(True), skip=F.lit(0), number=F.lit(False), days=some, month=nothing, times=some, half=F.lit(False), hour=nothing, minute=nothing)

    def step(s: Column, t: Column) -> Column:
        """``t`` is a token, with the two after it."""
        word, after, then = t["x"], t["y"], t["z"]
        n = F.substring(F.regexp_replace(word, "^0+(?=[0-9])", ""), 1, 9).try_cast("long")
        few = F.size(s["times"])
        expects = ((few == 1) | (few == 2)) & (n < 60) | (few == 3) & (n < 1000)
        bad = kept(s, ok=F.lit(False))

        def timed(values: Column, skip: Column) -> Column:
            return F.when(F.size(values) <= 4, kept(s, number=F.lit(True), times=values, skip=skip)).otherwise(bad)

        def full(values: Column) -> Column:
            return F.slice(F.concat(values, F.array_repeat(F.lit(0).cast("long"), 4)), 1, 4)

        one = F.array(n)
        colon = F.when(then == ":", F.when(few > 0, bad).otherwise(timed(F.array(n, F.lit(0).cast("long")), F.lit(2)))).otherwise(timed(F.concat(s["times"], one), F.when(then == ".", 2).otherwise(1)))
        dotted = F.when(then.rlike("^[0-9]"), timed(full(F.concat(s["times"], one)), F.lit(2))).otherwise(bad)
        ends = (after == "") | after.rlike(r"^(?:[\s\u00A0\uFEFF\p{Z}]|[zZ]$|[+-])")
        day = F.when(F.size(s["days"]) < 3, kept(s, number=F.lit(True), days=F.concat(s["days"], one), skip=F.when(after.isin("-", "."), 1).otherwise(0))).otherwise(bad)
        number = (
            F.when(after == ":", colon)
            .when((after == ".") & expects, dotted)
            .when(s["hour"].isNotNull() & s["minute"].isNull() & (n < 60), kept(s, number=F.lit(True), minute=n, skip=F.when(after == ".", 1).otherwise(0)))
            .when(expects, F.when(ends | (after == "."), timed(full(F.concat(s["times"], one)), F.lit(0))).otherwise(bad))
            .otherwise(day)
        )
        low = F.lower(word)
        month = F.array_position(F.array(*map(F.lit, MONTHS)), F.substring(low, 1, 3))
        named = (
            F.when(low.isin("am", "pm") & (few > 0), kept(s, half=F.lit(True)))
            .when(month > 0, kept(s, month=month, skip=F.when(after == "-", 1).otherwise(0)))
            .when(low.isin(ZONES) & s["number"], kept(s, hour=F.lit(0).cast("long"), minute=F.lit(0).cast("long")))
            .when(s["number"] | after.rlike("^[0-9]"), bad)
            .otherwise(s)
        )
        m, size = F.substring(F.regexp_replace(after, "^0+(?=[0-9])", ""), 1, 9).try_cast("long"), F.when(after.rlike("^[0-9]"), F.length(after)).otherwise(0)
        digits = F.when(size > 0, 1).otherwise(0)
        clock = F.when(size > 0, then).otherwise(after) == ":"
        value = F.coalesce(m, F.lit(0).cast("long"))
        offset = F.when(clock, kept(s, number=F.lit(True), hour=value, minute=nothing, skip=digits)).when(size.between(1, 2), kept(s, number=F.lit(True), hour=value, minute=F.lit(0).cast("long"), skip=digits)).when(size.between(3, 4), kept(s, number=F.lit(True), hour=F.floor(value / 100), minute=value % 100, skip=digits)).otherwise(bad)
        sign = word.isin("+", "-")
        zoned = F.coalesce((s["hour"] == 0) & (s["minute"] == 0), F.lit(False))
        next_state = F.when(word.rlike("^[0-9]"), number).when(word.rlike(r"^[^\x00-\x40\s\u00A0\uFEFF\p{Z}]"), named).when(sign & (zoned | (few > 0)), offset).when((sign | (word == ")")) & s["number"], bad).otherwise(s)
        return F.when(~s["ok"], s).when(s["skip"] > 0, kept(s, skip=s["skip"] - 1)).otherwise(next_state)

    def fine(s: Column) -> Column:
        d = F.concat(s["days"], F.array_repeat(F.lit(1).cast("long"), 3))
        a, b, c = (F.get(d, F.lit(i)) for i in range(3))
        first_is_day = a.between(1, 31)
        year = F.when(~first_is_day, a).when(s["month"].isNull(), c).otherwise(b)
        day = F.when(s["month"].isNotNull() & first_is_day, a).when(s["month"].isNull() & ~first_is_day, c).otherwise(b)
        month = F.coalesce(s["month"], F.when(first_is_day, a).otherwise(b))
        h, mi, se = (F.coalesce(F.get(s["times"], F.lit(i)), F.lit(0)) for i in range(3))
        ms = F.coalesce(F.get(s["times"], F.lit(3)), F.lit(0))
        hour = F.when(s["half"], h.between(0, 12)).otherwise((h < 24) | (h == 24) & (mi == 0) & (se == 0) & (ms == 0))
        return s["ok"] & (F.size(s["days"]) > 0) & (year <= LAST_YEAR) & month.between(1, 12) & day.between(1, 31) & hour & (mi < 60) & (se < 60)

    def folded(tokens: Column) -> Column:
        seen = F.transform(tokens, lambda x, i: F.struct(x.alias("x"), F.coalesce(F.get(tokens, i + 1), F.lit("")).alias("y"), F.coalesce(F.get(tokens, i + 2), F.lit("")).alias("z")))
        return F.aggregate(seen, start, step, fine)

    return F.get(F.transform(F.array(whole), folded), F.lit(0))
