"""Tolerant text parsing.  Nothing here throws under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialwright import fixed_values as fv
from dialwright.functions.keys import _col


def strip_noise(c: Column | str, noise: str = '\u0000"\ufeff\r') -> Column:
    """Remove NUL characters, quotes, byte-order marks and carriage returns."""
    return F.translate(_col(c), noise, "")


def first_number(c: Column | str) -> Column:
    """First signed number in the text as a double; NULL when there is none."""
    return F.regexp_extract(_col(c), f"({fv.NUMBER_PATTERN})", 1).try_cast("double")


def first_match(c: Column | str, pattern: str) -> Column:
    """First substring matching ``pattern``; NULL instead of an empty string."""
    return F.nullif(F.regexp_extract(_col(c), f"({pattern})", 1), F.lit(""))


def parse_timestamp(text: Column, formats: list[str]) -> Column:
    """First format that parses wins; NULL when none does.

    The result has no time zone, since the raw files carry local clock time.
    """
    attempts = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*attempts)


def _number(c: Column) -> Column:
    return c.try_cast("int")


def clock_parts(clock: Column | str) -> tuple[Column, Column, Column]:
    """Hour, minute and second of ``H:mm[:ss]`` text; a missing second is 0."""
    parts = F.split(F.trim(_col(clock)), ":")
    seconds = F.when(F.size(parts) == 2, F.lit(0)).when(F.size(parts) == 3, _number(F.get(parts, F.lit(2))))
    return _number(F.get(parts, F.lit(0))), _number(F.get(parts, F.lit(1))), seconds


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add costly columns that a later filter will test.

    Catalyst pushes a filter below a projection by repeating its expressions
    there, which for a parse means doing it twice, in one oversized generated
    method.  A filter stays above a generator, so the values come out of an
    ``inline`` over one struct.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def with_timestamp(df: DataFrame, date_col: str, clock_col: str, out: str) -> DataFrame:
    """Add the timestamp of a raw date cell and a raw clock cell.

    Dates are ISO, ``dd.MM.yy`` or ``dd.MM.yyyy`` (two-digit years are of this
    century); clocks have seconds or not; noise around them is ignored;
    anything else gives NULL.  Built from numbers, as no format pattern reads
    all widths.  Extraction is a projection of its own, or each use of a token
    would extract it again.
    """
    tokens = df.withColumns(
        {
            "__date": F.split(first_match(date_col, f"{fv.ISO_DATE_PATTERN}|{fv.SENSOR_DATE_PATTERN}"), "[.-]"),
            "__clock": first_match(clock_col, fv.SENSOR_TIME_PATTERN),
        }
    )
    first, month, last = (F.get("__date", F.lit(i)) for i in range(3))
    iso = F.length(first) == 4
    year = F.when(iso, first).when(F.length(last) == 4, last).when(F.length(last) == 2, F.concat(F.lit("20"), last))
    stamp = F.try_make_timestamp_ntz(
        _number(year), _number(month), _number(F.when(iso, last).otherwise(first)), *clock_parts("__clock")
    )
    return computed_once(tokens, {out: stamp}).drop("__date", "__clock")


def month_text_date(c: Column | str, months: dict[str, int] | None = None) -> Column:
    """``8 janv. 2023`` to a date; impossible days and unknown months give NULL."""
    months = fv.FRENCH_MONTHS if months is None else months
    text = F.trim(_col(c))
    token = F.lower(F.substring_index(F.substring_index(text, " ", 2), " ", -1))
    # A map evaluates the token once; a CASE chain would do so per month.
    numbers = F.create_map(*[F.lit(x) for pair in months.items() for x in pair])
    number = F.try_element_at(numbers, token)
    zero = F.lit(0)
    return F.try_make_timestamp_ntz(
        _number(F.substring_index(text, " ", -1)),
        number,
        _number(F.substring_index(text, " ", 1)),
        zero,
        zero,
        zero,
    ).cast("date")


def at_clock(day: Column | str, clock: Column | str) -> Column:
    """Date plus ``H:mm[:ss]`` text to a timestamp; NULL when malformed."""
    day = _col(day)
    return F.try_make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day), *clock_parts(clock))


def on_day(day: Column | str, clock_ts: Column | str) -> Column:
    """Keep the clock of ``clock_ts`` but put it on ``day``.

    For readers that turned a bare time of day into a timestamp of some
    unrelated date.
    """
    day, clock_ts = _col(day), _col(clock_ts)
    return F.make_timestamp_ntz(
        F.year(day),
        F.month(day),
        F.dayofmonth(day),
        F.hour(clock_ts),
        F.minute(clock_ts),
        F.extract(F.lit("SECOND"), clock_ts),
    )


def pseudonym(c: Column | str, salt: str | None = None) -> Column:
    """One-way SHA-256 of a person's name, optionally salted."""
    c = _col(c).cast("string")
    return F.sha2(c if salt is None else F.concat(F.lit(salt), c), 256)


def initials(c: Column | str, longest: int = 10) -> Column:
    """Upper-case first letters of the words, cut to ``longest``."""
    words = F.filter(F.split(F.trim(_col(c)), r"\s+"), lambda w: F.length(w) > 0)
    return F.left(F.array_join(F.transform(words, lambda w: F.upper(F.left(w, F.lit(1)))), ""), F.lit(longest))


def unit_name(number: Column | str, prefix: str = "INV-") -> Column:
    """``1`` to ``INV-01``."""
    return F.format_string(prefix + "%02d", _col(number).cast("int"))


def code_label(code: Column | str, label: Column | str | None = None) -> Column:
    """Documented label, else ``Code n``, else ``Unknown`` for a missing code."""
    code = _col(code)
    made_up = F.coalesce(F.concat(F.lit("Code "), code.cast("string")), F.lit("Unknown"))
    return made_up if label is None else F.coalesce(_col(label), made_up)


def room_base(code: Column | str, prefix: str) -> Column:
    """Room code without the building prefix."""
    code = _col(code)
    return F.when(code.startswith(prefix), code.substr(F.lit(len(prefix) + 1), F.length(code))).otherwise(code)


def room_type(code: Column | str, prefix: str = "") -> Column:
    """Room kind from the words in its code."""
    base = room_base(code, prefix)
    return (
        F.when(base == "Foyer", "Foyer")
        .when(base == "SUM", "Seminar")
        .when(base.contains("Aula"), "Auditorium")
        .when(base.contains("Comodal"), "Comodal")
        .otherwise("Classroom")
    )


def room_parts(code: Column | str, prefix: str = "") -> Column:
    """Struct (wing, floor, room_number, room_type) parsed from the code.

    Only lettered rooms (``N301``) have a wing, a floor and a number.  Ground
    floor is 0, not missing.
    """
    base = room_base(code, prefix)
    kind = room_type(code, prefix)
    pattern = r"^([A-Z])(\d)(\d+)"
    numbered = kind.isin("Classroom", "Comodal") & base.rlike(pattern)
    return F.struct(
        F.when(numbered, F.regexp_extract(base, pattern, 1)).alias("wing"),
        F.when(numbered, F.regexp_extract(base, pattern, 2).try_cast("int")).alias("floor"),
        F.when(numbered, F.regexp_extract(base, pattern, 3)).alias("room_number"),
        kind.alias("room_type"),
    )


def route_of(file_name: Column | str) -> Column:
    """Target folder of a raw file, decided by a token in its name."""
    name = F.lower(_col(file_name))
    (token, folder), *others = fv.FILE_ROUTES
    routed = F.when(name.contains(token), folder)
    for token, folder in others:
        routed = routed.when(name.contains(token), folder)
    return routed.otherwise(fv.OTHER_ROUTE)
