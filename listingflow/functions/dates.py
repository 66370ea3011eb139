"""Date columns.  "Today" is always the caller's ``as_of``; nothing here reads the clock."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .text import col_of, strip

# Accepted shapes, and the layouts tried for each.  Separators are brought to one form first.  A text is
# handed only to parsers that can succeed.
_ISO_SHAPE = r"^\d{4}(-\d{1,2}(-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,9})?)?)?)?)?$"
_NUMERIC_SHAPE = r"^\d{1,2}([/.-])\d{1,2}\1\d{4}$"
_NUMERIC_SHORT_SHAPE = r"^\d{1,2}([/.-])\d{1,2}\1\d{2}$"
_MONTH_NAME_SHAPE = r"^[A-Za-z]{3,9} \d{1,2},? \d{4}$"
_DAY_NAME_SHAPE = r"^\d{1,2}[ -][A-Za-z]{3,9}[ -]\d{4}$"
_DAY_NAME_SHORT_SHAPE = r"^\d{1,2}[ -][A-Za-z]{3,9}[ -]\d{2}$"
_YEAR_FIRST_SHAPE = r"^\d{4}([/.])\d{1,2}\1\d{1,2}$"
_DIGITS_SHAPE = r"^\d{8}$"
_OVER_TWELVE_FIRST = r"^(1[3-9]|[2-9]\d)/"
_OVER_TWELVE_SECOND = r"^\d{1,2}/(1[3-9]|[2-9]\d)/"
_LONG_MONTH = r"[A-Za-z]{4}"
_MONTH_FIRST, _DAY_FIRST, _YEAR, _SHORT_YEAR = "M/d/", "d/M/", "yyyy", "yy"
_MONTH_NAME = ("MMM d yyyy", "MMMM d yyyy")
_DAY_NAME = ("d MMM yyyy", "d MMMM yyyy")
_DAY_NAME_SHORT = ("d MMM yy", "d MMMM yy")
_YEAR_FIRST = "yyyy/M/d"
_DIGITS = "yyyyMMdd"
_MONTH_YEAR_SHAPE = r"^[A-Za-z]{3,9},? \d{4}$"
_MONTH_YEAR = ("MMM yyyy", "MMMM yyyy")
# What may stand around a date and is cut away before the layouts are tried again.
_DAYS = "mon|tues?|wed|thu|thurs?|fri|sat|sun|monday|tuesday|wednesday|thursday|friday|saturday|sunday"
_WEEKDAY = rf"(?i)^(?:{_DAYS})[.,]* +"
# How a date with other things around it begins, and what only such a date holds.
_BEGINS = rf"(?iU)^(?:(?:{_DAYS})[.,]* +)?(?:\d{{1,4}}[-/. 年년]|\d{{8}}[ T]|\d{{1,2}}(?:st|nd|rd|th)\b|\p{{L}}{{3,}}[.,]* ?\d)"
_AROUND = r"[^-/.0-9]"
_ORDINAL = r"(?i)\b(\d{1,2})(st|nd|rd|th)\b"
_MONTH_DOT = r"\b([A-Za-z]{3,9})\."
_CLOCK = (
    r"(?i)[ T,]+(?:at +)?(?:(\d{1,2}):(\d{2})(?::(\d{2}(?:\.\d{1,9})?))?(?: ?([ap])\.?m\.?)?|(\d{1,2}) ?([ap])\.?m\.?)"
    r"(?: ?(Z|UTC|GMT|[+-]\d{2}:?\d{2}))?$"
)
# A word that may be a month's name, what is written between day, month and year in some languages, a dot after
# the day, and year, month and day in signs of East Asia.
_NAME = r"(?U)(\p{L}{3,})"
_BETWEEN = r"(?i) (de|del|di|of) "
_DAY_DOT = r"^(\d{1,2})\. ?(?=\p{L})"
_EAST_ASIAN = r"^(\d{4}) ?[年년] ?(\d{1,2}) ?[月월] ?(\d{1,2}) ?[日일]$"
# Names of the months, in lower case.
_MONTHS = {
    "English": "january february march april may june july august september october november december",
    "German": "januar februar märz april mai juni juli august september oktober november dezember",
    "French": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "Spanish": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "Italian": "gennaio febbraio marzo aprile maggio giugno luglio agosto settembre ottobre novembre dicembre",
    "Portuguese": "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro",
    "Dutch": "januari februari maart april mei juni juli augustus september oktober november december",
    "Swedish": "januari februari mars april maj juni juli augusti september oktober november december",
    "Danish": "januar februar marts april maj juni juli august september oktober november december",
}
_ENGLISH = [m[:3].title() for m in _MONTHS["English"].split()]


def _month_names() -> dict[str, str]:
    """Every name of a month, and every beginning of one of three letters or more that belongs to no other month."""
    found: dict[str, set[str]] = {}
    for names in _MONTHS.values():
        for name, english in zip(names.split(), _ENGLISH, strict=True):
            for end in range(3, len(name) + 1):
                found.setdefault(name[:end], set()).add(english)
    return {name: months.pop() for name, months in found.items() if len(months) == 1}


# Two-digit years from this one on are of the last century.
_PIVOT = 69


def as_of_stamp(as_of: datetime | date | str) -> Column:
    """The caller's "now" as an instant."""
    return F.lit(str(as_of)).cast("timestamp_ntz")


def as_of_date(as_of: datetime | date | str) -> Column:
    return as_of_stamp(as_of).cast("date")


def _read(text: Column, layout: str) -> Column:
    read = F.try_to_timestamp(text, F.lit(layout)).cast("timestamp_ntz")
    if _YEAR in layout:
        return read
    return F.when(F.year(read) >= 2000 + _PIVOT, F.add_months(read.cast("date"), -1200).cast("timestamp_ntz")).otherwise(read)


def _read_numeric(text: Column, year: str, dayfirst: bool) -> Column:
    """By the asked-for convention, unless a number over twelve stands where the month should be."""
    if year == _YEAR:
        # nothing is lost by trying both: where both numbers may be a month, the second reading fails if the first does
        day_first, month_first = _read_year_last(text, _DAY_FIRST), _read_year_last(text, _MONTH_FIRST)
        return F.coalesce(day_first, month_first) if dayfirst else F.coalesce(month_first, day_first)
    day_first, month_first = _read(text, _DAY_FIRST + year), _read(text, _MONTH_FIRST + year)
    if dayfirst:
        return F.when(text.rlike(_OVER_TWELVE_SECOND), month_first).otherwise(day_first)
    return F.when(text.rlike(_OVER_TWELVE_FIRST), day_first).otherwise(month_first)


def _read_year_last(text: Column, layout: str) -> Column:
    """Two numbers and a year of four figures, between slashes; put the other way round the date needs no layout."""
    numbers = F.substring_index(text, "/", 1), F.substring_index(F.substring_index(text, "/", 2), "/", -1)
    month, day = numbers if layout == _MONTH_FIRST else numbers[::-1]
    return F.concat_ws("-", F.substring(text, -4, 4), month, day).try_cast("timestamp_ntz")


def _read_named(text: Column, layouts: tuple[str, str]) -> Column:
    short, full = layouts
    return F.when(text.rlike(_LONG_MONTH), _read(text, full)).otherwise(_read(text, short))


def parse_stamp(value: Column | str, dayfirst: bool = False) -> Column:
    """Tolerant parse: null when no layout fits.

    An ambiguous text is read by the asked-for convention, any other by the one that gives a date.  Texts that fit no layout
    are tried again without weekday, ordinal endings, dots after months, time of day and zone, with month names of several
    languages; a zoned time is read as UTC.

    One expression can hold an intermediate text only as the element of an array, which keeps its projection out of generated
    code.  For columns of a frame use ``parse_stamps``, which gives the same in generated code.
    """
    text = strip(value)
    held = lambda c, use: F.get(F.transform(F.array(c), use), F.lit(0))
    inside = held(_bare(text), lambda bare: held(_day(bare), lambda day: _read_plain(day, dayfirst)) + _clock(bare))
    return F.coalesce(_read_plain(text, dayfirst), F.when(_worth(text), inside))


def parse_stamps(df: DataFrame, values: dict[str, tuple[Column | str, bool]]) -> DataFrame:
    """``df`` with columns parsed as by ``parse_stamp``, given as new name -> (value, day first).

    Every step is a column of its own, worked out once for a value however many conventions it is read by; steps stay in
    generated code.  Only texts that fit no layout as they are get to the costly ones.
    """
    texts: dict[str, Column] = {}
    step: dict[str, tuple[str, bool]] = {}
    for name, (value, dayfirst) in values.items():
        c = col_of(value)
        slot = next((k for k, known in texts.items() if str(known) == str(c)), f"_date{len(texts)}")
        texts.setdefault(slot, c)
        step[name] = (slot, dayfirst)
    out = df.withColumns(texts)
    stripped = {slot: _stripped(F.col(slot), out.schema[slot].dataType) for slot in texts}
    # one projection for all of this: Spark works out an expression that stands in it several times only once
    as_is = [_read_plain(stripped[slot], dayfirst) for slot, dayfirst in step.values()]
    missed = {slot: [c.isNull() for c, (s, _) in zip(as_is, step.values(), strict=True) if s == slot] for slot in texts}
    bare = {f"{s}_bare": F.when(reduce(lambda a, b: a | b, missed[s]) & _worth(c), _bare(c)) for s, c in stripped.items()}
    out = out.withColumns({f"_as_is_{i}": c for i, c in enumerate(as_is)} | bare)
    out = out.withColumns({f"{s}_day": _day(F.col(f"{s}_bare")) for s in texts} | {f"{s}_{i}": p for s in texts for i, p in enumerate(_clock_parts(F.col(f"{s}_bare")))})
    found = {}
    for i, (name, (slot, dayfirst)) in enumerate(step.items()):
        inside = _read_plain(F.col(f"{slot}_day"), dayfirst) + _time_of_day([F.col(f"{slot}_{k}") for k in range(5)])
        found[name] = F.coalesce(F.col(f"_as_is_{i}"), F.when(F.col(f"{slot}_bare").isNotNull(), inside))
    new = [found[c].alias(c) for c in found if c not in df.columns]
    return out.select(*[found[c].alias(c) if c in found else F.col(f"`{c}`") for c in df.columns], *new)


def _stripped(text: Column, kind: T.DataType) -> Column:
    """``strip``, which takes a text apart, only for texts that do not begin and end with a visible sign of ASCII."""
    if not isinstance(kind, T.StringType):
        return strip(text)
    shown = lambda c: (c >= F.lit(b"!")) & (c <= F.lit(b"~"))
    written = text.cast("binary")
    return F.when(shown(F.substring(written, 1, 1)) & shown(F.substring(written, -1, 1)), text).otherwise(strip(text))


def _worth(text: Column) -> Column:
    """Whether a text that fits no layout may hold a date with other things around it."""
    return text.rlike(_AROUND) & text.rlike(_BEGINS)


def _bare(text: Column) -> Column:
    """A text without what may stand around a date, its month in English."""
    bare = F.regexp_replace(F.regexp_replace(text, _WEEKDAY, ""), _ORDINAL, "$1")
    bare = F.regexp_replace(F.regexp_replace(bare, _EAST_ASIAN, "$1-$2-$3"), _BETWEEN, " ")
    bare = F.regexp_replace(F.regexp_replace(bare, _MONTH_DOT, "$1"), _DAY_DOT, "$1 ")
    word = F.regexp_extract(bare, _NAME, 1)
    known = F.create_map(*[F.lit(x) for pair in _month_names().items() for x in pair])
    return F.when(word == "", bare).otherwise(F.replace(bare, word, F.coalesce(F.element_at(known, F.lower(word)), word)))


def _day(bare: Column) -> Column:
    return strip(F.regexp_replace(bare, _CLOCK, ""))


def _clock(bare: Column) -> Column:
    """The time of day in a text, as an interval in UTC; none is midnight."""
    return _time_of_day(_clock_parts(bare))


def _clock_parts(bare: Column) -> list[Column]:
    """Hour, minute, second, half of the day and zone, empty where they are missing."""
    whole = F.regexp_extract(bare, _CLOCK, 0)
    part = lambda i: F.regexp_extract(whole, _CLOCK, i)
    either = lambda a, b: F.coalesce(F.when(part(a) != "", part(a)), part(b))
    return [either(1, 5), part(2), part(3), F.lower(either(4, 6)), part(7)]


def _time_of_day(parts: list[Column]) -> Column:
    number = lambda c: F.coalesce(F.substring(c, 1, 9).try_cast("decimal(8,6)"), F.lit(0).cast("decimal(8,6)"))
    hour, half = number(parts[0]).cast("int"), parts[3]
    hour = F.when(half == "p", hour % 12 + 12).when(half == "a", hour % 12).otherwise(hour)
    offset = r"([+-])(\d{2}):?(\d{2})"
    away = number(F.regexp_extract(parts[4], offset, 2)).cast("int") * 60 + number(F.regexp_extract(parts[4], offset, 3)).cast("int")
    away = F.when(F.startswith(parts[4], F.lit("+")), -away).otherwise(away)
    minute = number(parts[1]).cast("int")
    return F.when((hour < 24) & (minute < 60), F.make_dt_interval(F.lit(0), hour, minute + away, number(parts[2])))


def _read_plain(text: Column, dayfirst: bool) -> Column:
    """By the first layout that fits."""
    slashed = F.replace(F.replace(text, F.lit("-"), F.lit("/")), F.lit("."), F.lit("/"))
    spaced = F.replace(F.replace(text, F.lit("-"), F.lit(" ")), F.lit(","), F.lit(""))
    return (
        F.when(text.rlike(_ISO_SHAPE), text.try_cast("timestamp_ntz"))
        .when(text.rlike(_NUMERIC_SHAPE), _read_numeric(slashed, _YEAR, dayfirst))
        .when(text.rlike(_DAY_NAME_SHAPE), _read_named(spaced, _DAY_NAME))
        .when(text.rlike(_MONTH_NAME_SHAPE), _read_named(spaced, _MONTH_NAME))
        .when(text.rlike(_NUMERIC_SHORT_SHAPE), _read_numeric(slashed, _SHORT_YEAR, dayfirst))
        .when(text.rlike(_DAY_NAME_SHORT_SHAPE), _read_named(spaced, _DAY_NAME_SHORT))
        .when(text.rlike(_YEAR_FIRST_SHAPE), _read(slashed, _YEAR_FIRST))
        .when(text.rlike(_DIGITS_SHAPE), _read(text, _DIGITS))
        .when(text.rlike(_MONTH_YEAR_SHAPE), _read_named(F.replace(text, F.lit(","), F.lit("")), _MONTH_YEAR))
    )


def parse_date(value: Column | str, dayfirst: bool = False) -> Column:
    return parse_stamp(value, dayfirst).cast("date")


def parse_date_columns(df: DataFrame, columns: list[str], dayfirst: bool = False, stamp: bool = False) -> DataFrame:
    """Parse the listed columns that exist; columns already holding dates are only cast."""
    target = "timestamp_ntz" if stamp else "date"
    listed = [f for f in df.schema.fields if f.name in columns]
    texts = {f.name: (F.col(f"`{f.name}`"), dayfirst) for f in listed if isinstance(f.dataType, T.StringType)}
    parsed = parse_stamps(df, texts) if texts else df
    return parsed.withColumns({f.name: F.col(f"`{f.name}`").cast(target) for f in listed}) if listed else df


def parse_dates(df: DataFrame, values: dict[str, tuple[Column | str, bool]]) -> DataFrame:
    """``parse_stamps``, as dates."""
    return parse_stamps(df, values).withColumns({c: F.col(f"`{c}`").cast("date") for c in values})


def shift_days(value: Column | str, days: int) -> Column:
    return F.date_add(col_of(value), days)


def infer_year(value: Column | str, as_of, separator: str = "-", roll_back: bool = True) -> Column:
    """Complete a month-day text with the year of ``as_of``.

    A calendar read in January still shows December; with ``roll_back`` a result more than six months ahead is moved to
    the year before.
    """
    dated = parse_date(F.concat(col_of(value), F.lit(separator), F.year(as_of_date(as_of)).cast("string")))
    if not roll_back:
        return dated
    limit = as_of_stamp(as_of) + F.expr("INTERVAL 6 MONTHS")
    return F.when(dated.cast("timestamp_ntz") > limit, F.add_months(dated, -12)).otherwise(dated)


def null_unless_after(value: Column | str, as_of) -> Column:
    """Dates not after the instant ``as_of`` become null (a bare year reads as 1 January)."""
    c = col_of(value)
    return F.when(c.cast("timestamp_ntz") > as_of_stamp(as_of), c)


def iso_text(value: Column | str) -> Column:
    return F.date_format(col_of(value), "yyyy-MM-dd")


def dated_note(label: str, value: Column | str) -> Column:
    """``label`` and the ISO date; null when there is no date."""
    return F.concat(F.lit(label), iso_text(value))


def drop_zone(value: Column | str) -> Column:
    """A zoned stamp as the naive UTC stamp."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), col_of(value).cast("timestamp_ntz"))


def as_instant(value: Column | str) -> Column:
    """A naive UTC stamp as an instant, whatever the session's zone (streams need one for event time)."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), col_of(value)).cast("timestamp")


# --- predicates --------------------------------------------------------------------------------------------------


def on_or_after(value: Column | str, as_of) -> Column:
    """On the day of ``as_of`` or later; a plain comparison, so it reaches the scan (null for a null date)."""
    return col_of(value) >= as_of_date(as_of)


def any_on_or_after(values: list[Column | str], as_of) -> Column:
    found = on_or_after(values[0], as_of)
    for value in values[1:]:
        found = found | on_or_after(value, as_of)
    return found


def within_days(value: Column | str, as_of, days: int) -> Column:
    """Later than midnight ``days`` days before ``as_of``; a plain range, so it reaches the scan."""
    return col_of(value) > F.date_sub(as_of_date(as_of), days).cast("timestamp_ntz")


def text_on_or_after(value: Column | str, bound: str) -> Column:
    """ISO date texts compare as text."""
    return col_of(value) >= F.lit(bound)
