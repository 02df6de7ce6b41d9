"""Column expressions for text and numbers found in text.

All stay inside the JVM. Numbers use ``try_cast`` because ANSI mode raises on
bad input, and Unicode white space is handled explicitly because neither
``trim`` nor a plain ``\\s`` removes a no-break space.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANK = r"[\s\x1c-\x1f]"
# Every Unicode white-space character, for trimming without a regex.
_BLANKS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
           + "".join(chr(c) for c in range(0x2000, 0x200b)) + "\u2028\u2029\u202f\u205f\u3000")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utrim(c: Column | str) -> Column:
    """Strip Unicode white space at both ends."""
    return F.btrim(col(c), F.lit(_BLANKS))


def squeeze(c: Column | str) -> Column:
    """Strip, and turn inner runs of white space into one space."""
    return utrim(F.regexp_replace(col(c), rf"(?U){_BLANK}+", " "))


def only_if(c: Column, test) -> Column:
    """``c`` where ``test(c)`` holds, else null, computing ``c`` once. Meant for
    values that are costly to compute, such as a search through a whole page."""
    return F.get(F.filter(F.array(c), test), F.lit(0))


def bind(c: Column, body) -> Column:
    """``body(c)`` with ``c`` computed once, however often it is used."""
    return F.get(F.transform(F.array(c), body), F.lit(0))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def first_match(c: Column | str, pattern: str, group: int = 1) -> Column:
    """First regex match, null (not ``''``) where there is none; searched for once."""
    return only_if(F.regexp_extract(col(c), pattern, group), lambda m: m != "")


def first_of(c: Column | str, patterns: list[str], group: int = 1) -> Column:
    """First match of the first pattern that matches."""
    return F.coalesce(*[first_match(c, p, group) for p in patterns])


def contains_any(c: Column | str, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(col(c), F.lit(w)) for w in words])


def literal_pattern(words: list[str]) -> str:
    """One alternation of quoted literals: a single pass instead of one per word."""
    return "|".join(rf"\Q{w}\E" for w in words)


# Possessive and without a repeated group, so that a text of a million digits neither
# goes back nor goes deep.
_FLOAT = r"(?i)^[+-]?(?:\d++\.?\d*+|\.\d++)(?:e[+-]?\d++)?$"
_SPECIAL = r"(?i)^[+-]?(?:nan|inf|infinity)$"
_LOOSE_UNDERSCORE = r"^_|[^0-9]_|_[^0-9]|_$"


def to_double(c: Column | str) -> Column:
    """Text to double, null unless it is a plain decimal number; single underscores may
    stand between digits.

    Java also takes ``1d``, ``1f`` and hex floats; those give null here.
    """
    def read(t: Column) -> Column:
        plain = F.replace(t, F.lit("_"), F.lit(""))
        fits = ~(F.contains(t, F.lit("_")) & t.rlike(_LOOSE_UNDERSCORE)) & plain.rlike(_FLOAT)
        return F.when(fits | t.rlike(_SPECIAL), plain.try_cast("double"))

    return bind(col(c), read)


def parse_money(c: Column | str) -> Column:
    """Money text to a number: ``RM 1,000`` is 1000, ``1.5 million`` is 1500000.

    The letters r and m, ``$``, commas and blanks go wherever they stand, so
    ``RM500/day`` has no value.
    """
    def read(t: Column) -> Column:
        cleaned = F.regexp_replace(t, r"(?iU)[RM$,\s]", "")
        return (F.when(F.contains(F.lower(t), F.lit("million")),
                       to_double(F.regexp_replace(cleaned, r"[^0-9.]", "")) * F.lit(1e6))
                .otherwise(to_double(cleaned)))

    return bind(col(c), read)


def parse_reply_money(c: Column | str) -> Column:
    """Money text in a model reply: only digits and points count, zero is kept out
    by the caller, and the word million has no effect."""
    return to_double(F.regexp_replace(col(c), r"[^\d.]", ""))


def parse_percentage(c: Column | str) -> Column:
    return first_match(c, r"(\d+(?:\.\d+)?)").try_cast("double")


def parse_int(c: Column | str) -> Column:
    return first_match(c, r"(\d+)").try_cast("int")


def parse_rating(c: Column | str) -> Column:
    """First number; a comma is a decimal point."""
    return to_double(F.replace(first_match(c, r"(\d+[.,]?\d*)"), F.lit(","), F.lit(".")))


def parse_review_count(c: Column | str) -> Column:
    return parse_int(F.translate(col(c), ",. ", ""))


def coordinates(url: Column | str) -> Column:
    """``struct(latitude, longitude)`` from a map URL.

    The second pattern is used where the first gives no point on the globe.
    """
    def point(pattern: str) -> Column:
        def read(text: Column) -> Column:
            pair = F.struct(F.regexp_extract(text, pattern, 1).try_cast("double").alias("latitude"),
                            F.regexp_extract(text, pattern, 2).try_cast("double").alias("longitude"))
            return only_if(pair, lambda p: p["latitude"].between(-90, 90)
                           & p["longitude"].between(-180, 180))

        return bind(first_match(url, pattern, 0), read)

    # The two coordinate notations.
    found = F.coalesce(point(r"@(-?\d+\.?\d*),(-?\d+\.?\d*)"),
                       point(r"!3d(-?\d+\.?\d*)!4d(-?\d+\.?\d*)"))
    nothing = F.lit(None).cast("double")
    return F.coalesce(found, F.struct(nothing.alias("latitude"), nothing.alias("longitude")))


def place_id(url: Column | str) -> Column:
    # The three place-id notations, in order of trust.
    return first_of(url, [
        r"!1s(0x[a-f0-9]+:[a-f0-9]+)",
        r"(ChIJ[a-zA-Z0-9_-]+)",
        r"place_id[=:]([a-zA-Z0-9_-]+)",
    ])


def clean_phone(c: Column | str) -> Column:
    bare = F.replace(F.replace(col(c), F.lit("phone:tel:"), F.lit("")), F.lit("Phone:"), F.lit(""))
    return blank_to_null(F.regexp_replace(utrim(bare), r"(?U)[^\d+\-\s()]+", ""))


def pick_phone(attribute: Column | str, label: Column | str,
               tooltips: Column | str, panel: Column | str) -> Column:
    """Phone from four places, best first.

    ``attribute`` and ``label`` are strings, ``tooltips`` and ``panel`` arrays
    of strings in page order.
    """
    def first_clean(items: Column, test) -> Column:
        cleaned = F.transform(F.filter(items, test), clean_phone)
        return F.get(F.filter(cleaned, lambda p: p.isNotNull()), F.lit(0))

    return F.coalesce(
        clean_phone(attribute),
        # Fixed value: a run that may be a phone number.
        first_clean(F.array(F.regexp_extract(col(label), r"(?U)[\d\s+\-()]{8,}", 0)),
                    lambda t: t != ""),
        first_clean(col(tooltips), lambda t: t.rlike(r"(?U)\d{2,}")),
        first_clean(col(panel), lambda t: utrim(t).rlike(r"(?U)^[\d\s+\-()]{8,}$")),
    )


def pick_hours(groups: Column | str, label: Column | str) -> Column:
    """Opening-hours struct from an array of text arrays, one per place looked at.

    The first place with a usable line wins; else a label of over 10 characters.
    """
    def usable(lines: Column) -> Column:
        flat = F.transform(lines, lambda t: F.translate(utrim(t), "\t\n", "  "))
        return F.filter(flat, lambda t: F.length(t) > 3)

    lists = F.filter(F.transform(col(groups), usable), lambda a: F.size(a) > 0)
    text = F.coalesce(F.get(lists, F.lit(0)),
                      F.when(F.length(col(label)) > 10, F.array(col(label))))
    found = F.filter(F.array(text), lambda t: t.isNotNull())
    return F.get(F.transform(found, lambda t: F.struct(t.alias("weekday_text"))), F.lit(0))


def pick_services(groups: Column | str, limit: int | None = None) -> Column:
    """First group with a text of 4 to 99 characters: trimmed, distinct in order;
    null where no group has one. ``limit`` keeps the first so many."""
    def usable(lines: Column) -> Column:
        trimmed = F.transform(lines, utrim)
        return F.array_distinct(F.filter(
            trimmed, lambda t: (F.length(t) > 3) & (F.length(t) < 100)))

    lists = F.filter(F.transform(col(groups), usable), lambda a: F.size(a) > 0)
    found = F.get(lists, F.lit(0))
    return found if limit is None else F.slice(found, 1, limit)


def pick_specialties(categories: Column | str) -> Column:
    """The first category text below 100 characters, as an array."""
    good = F.filter(F.transform(col(categories), utrim),
                    lambda t: (F.length(t) > 0) & (F.length(t) < 100))
    return only_if(F.slice(good, 1, 1), lambda a: F.size(a) > 0)


def is_open_24_hours(name: Column | str) -> Column:
    up = F.upper(col(name))
    return F.contains(up, F.lit("24 JAM")) | F.contains(up, F.lit("24JAM"))


def emergency_flag(page_text: Column | str) -> Column:
    """True where round-the-clock or emergency care is named, else null."""
    low = F.lower(col(page_text))
    return F.when(contains_any(low, ["24 hour", "24-hour", "emergency"]), F.lit(True))


def truthy(c: Column, kind: str) -> Column:
    """Python truth of a column of simple type ``kind`` (never null)."""
    if kind in ("double", "int", "bigint", "float"):
        test = c != 0
    elif kind == "string":
        test = c != ""
    elif kind == "boolean":
        test = c
    elif kind.startswith("array"):
        test = F.size(c) > 0
    else:
        test = c.isNotNull()
    return F.coalesce(test, F.lit(False))


def truthy_coalesce(kind: str, *columns: Column) -> Column:
    """First true value; the last column is taken as it is."""
    *head, last = columns
    return F.coalesce(*[F.when(truthy(c, kind), c) for c in head], last)


def deterministic_id(first: Column | str, second: Column | str) -> Column:
    """Stable id of two texts, blind to case and outer blanks: SHA-256 laid out
    8-4-4-4-12. Null where either text is null."""
    key = F.concat(utrim(F.lower(col(first))), F.lit("|"), utrim(F.lower(col(second))))
    # One replace, so that the hash is computed once.
    return F.regexp_replace(F.substring(F.sha2(key, 256), 1, 32),
                            "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
