"""Dimension loads: insert-if-new, upsert-on-change, effective dating, calendars.

Plain Parquet has no MERGE.  Every function returns the *new state* of a table
as a DataFrame; ``sinks.staged_overwrite`` puts it in place of the old one.
Running a load twice gives the same state as running it once.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialwright import fixed_values as fv
from dialwright.functions.calendar import day_before, is_weekend
from dialwright.functions.keys import assign_keys, date_key
from dialwright.functions.text import code_label, initials, room_parts, unit_name
from dialwright.operators import scans
from dialwright.operators.joins import align_outer, new_members


def with_metadata(members: DataFrame, meta: DataFrame, on: str, fallbacks: dict[str, Column]) -> DataFrame:
    """Describe members from a metadata frame; undocumented ones get fallbacks.

    A member counts as documented when ``meta`` has a row for it, so a NULL in
    its metadata stays NULL.
    """
    known = meta.withColumn("__known", F.lit(True))
    joined = members.join(known, on, "left")
    described = {}
    for name, fallback in fallbacks.items():
        value = F.col(name) if name in meta.columns else F.lit(None)
        described[name] = F.when(F.col("__known"), value).otherwise(fallback)
    return joined.withColumns(described).drop("__known")


def insert_new(
    dim: DataFrame, incoming: DataFrame, natural_key: list[str], key: str, assign: bool = True
) -> DataFrame:
    """Existing members unchanged, plus members whose natural key is new.

    ``incoming`` must be unique on the natural key and carry every attribute.
    New members are numbered after the largest existing surrogate key.
    """
    fresh = incoming.join(dim.select(*natural_key), natural_key, "left_anti")
    if assign:
        highest = dim.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
        fresh = assign_keys(fresh, natural_key, key, highest)
    columns = [F.col(c).cast(dim.schema[c].dataType) for c in dim.columns]
    return dim.unionByName(fresh.select(*columns))


def load_dimension(
    dim: DataFrame, src: DataFrame, natural_key: str, key: str, attributes: dict[str, Column]
) -> DataFrame:
    """Insert-if-new with attributes computed from the natural key."""
    fresh = new_members(src, dim, [natural_key]).withColumns(attributes)
    return insert_new(dim, fresh, [natural_key], key)


def ensure_member(dim: DataFrame, member: DataFrame, natural_key: list[str]) -> DataFrame:
    """Add a member with a fixed surrogate key unless its natural key is present."""
    absent = member.join(dim.select(*natural_key), natural_key, "left_anti")
    return dim.unionByName(absent.select(*[F.col(c).cast(dim.schema[c].dataType) for c in dim.columns]))


def load_units(dim: DataFrame, src: DataFrame, unit: str, rated_kwp: str, strings: int) -> DataFrame:
    """Units seen for the first time are active and get default ratings."""
    return load_dimension(
        dim,
        src.select(F.col(unit).cast("int").alias("unit_id")),
        "unit_id",
        "unit_key",
        {
            "unit_name": unit_name("unit_id"),
            "rated_kwp": F.lit(rated_kwp).cast("decimal(18,4)"),
            "string_count": F.lit(strings),
            "roof_section": F.lit(None).cast("string"),
            "install_date": F.lit(None).cast("date"),
            "is_active": F.lit(True),
        },
    )


def load_statuses(dim: DataFrame, src: DataFrame, code: str, meta: DataFrame, unknown: DataFrame) -> DataFrame:
    """Status codes with documented labels, the rest labelled ``Code n``.

    The ``unknown`` member keeps its fixed key whatever else is loaded.
    """
    guarded = ensure_member(dim, unknown, ["status_code"])
    codes = new_members(src.select(F.col(code).cast("int").alias("status_code")), guarded, ["status_code"])
    fresh = with_metadata(
        codes,
        meta,
        "status_code",
        {
            "status_label": code_label("status_code"),
            "status_category": F.lit("Unknown"),
            "is_failure": F.lit(False),
            "needs_maintenance": F.lit(False),
        },
    )
    return insert_new(guarded, fresh, ["status_code"], "status_key")


def load_sites(
    dim: DataFrame, src: DataFrame, site: str, meta: DataFrame, forced: list[str], country: str = fv.DEFAULT_COUNTRY
) -> DataFrame:
    """Weather sites; the ``forced`` (synthetic) ones are added even if never observed.

    ``country`` is that of sites whose metadata names none.
    """
    names = src.select(F.trim(F.col(site)).alias("site_name"))
    if forced:
        names = names.unionByName(meta.filter(F.col("site_name").isin(forced)).select("site_name"))
    fresh = with_metadata(
        new_members(names, dim, ["site_name"]),
        meta,
        "site_name",
        {
            "site_description": F.concat(F.lit("Station "), F.col("site_name")),
            "is_synthetic": F.lit(False),
            "latitude": F.lit(None).cast("double"),
            "longitude": F.lit(None).cast("double"),
            "altitude_m": F.lit(None).cast("int"),
            "country": F.lit(None).cast("string"),
        },
    ).withColumn("country", F.coalesce("country", F.lit(country)))
    return insert_new(dim, fresh, ["site_name"], "site_key")


def load_measures(dim: DataFrame, src: DataFrame, code: str, unit: str, meta: DataFrame) -> DataFrame:
    """Measurement types; undocumented ones keep the unit found in the data."""
    seen = (
        src.select(F.trim(F.col(code)).alias("measure_code"), F.trim(F.col(unit)).alias("source_unit"))
        .dropna(subset=["measure_code"])
        .groupBy("measure_code")
        .agg(F.min("source_unit").alias("source_unit"))
        .join(dim.select("measure_code"), "measure_code", "left_anti")
    )
    fresh = with_metadata(
        seen,
        meta,
        "measure_code",
        {
            "measure_name": F.col("measure_code"),
            "category": F.lit("Unknown"),
            "unit": F.col("source_unit"),
            "description": F.lit(None).cast("string"),
            "is_production_driver": F.lit(False),
        },
    ).drop("source_unit")
    fresh = fresh.withColumn("description", F.coalesce("description", F.lit(fv.MEASURE_DESCRIPTION)))
    return insert_new(dim, fresh, ["measure_code"], "measure_key")


def load_divisions(dim: DataFrame, src: DataFrame, division: str, meta: DataFrame) -> DataFrame:
    """Divisions with a known code and school, or a code made of initials."""
    names = src.select(F.trim(F.col(division)).alias("division_name")).filter(F.col("division_name") != "")
    fresh = with_metadata(
        new_members(names, dim, ["division_name"]),
        meta,
        "division_name",
        {
            "division_code": initials("division_name"),
            "school_name": F.left(F.col("division_name"), F.lit(50)),
            "is_active": F.lit(True),
        },
    )
    return insert_new(dim, fresh, ["division_name"], "division_key")


def load_rooms(dim: DataFrame, src: DataFrame, room: str, campus: str, building: str) -> DataFrame:
    """Rooms of a building; attributes are parsed from the code, members never deleted."""
    prefix = f"{building}."
    codes = src.select(F.trim(F.col(room)).alias("room_code")).filter(F.col("room_code").startswith(prefix))
    parts = room_parts("room_code", prefix)
    fresh = (
        new_members(codes, dim, ["room_code"])
        .withColumn("__parts", parts)
        .select(
            "room_code",
            F.col("room_code").alias("room_full_name"),
            F.lit(campus).alias("campus"),
            F.lit(building).alias("building"),
            "__parts.*",
            F.lit(None).cast("int").alias("nominal_capacity"),
            F.lit(True).alias("is_active"),
        )
    )
    return insert_new(dim, fresh, ["room_code"], "room_key")


def _changed(watch: list[str]) -> Column:
    return reduce(or_, [~F.col(f"__new_{c}").eqNullSafe(F.col(c)) for c in watch], F.lit(False))


def _beside(dim: DataFrame, src: DataFrame, on: list[str]) -> DataFrame:
    """Outer alignment with the source columns prefixed ``__new_``."""
    incoming = src.select(*on, *[F.col(c).alias(f"__new_{c}") for c in src.columns if c not in on])
    return align_outer(dim.withColumn("__old", F.lit(True)), incoming.withColumn("__new", F.lit(True)), on)


def upsert_on_change(
    dim: DataFrame, src: DataFrame, natural_key: list[str], watch: list[str], update: list[str]
) -> DataFrame:
    """Insert new keys; update ``update`` columns only when a ``watch`` column differs.

    Comparison treats two NULLs as equal.  Columns of ``dim`` that ``src``
    lacks are NULL on inserted rows.
    """
    both = _beside(dim, src, natural_key)
    inserted = F.col("__old").isNull()
    replaced = F.col("__old").isNotNull() & F.col("__new").isNotNull() & _changed(watch)
    out = []
    for c in dim.columns:
        if c in natural_key or c not in src.columns:
            out.append(F.col(c))
        else:
            takes_new = inserted | replaced if c in update else inserted
            out.append(F.when(takes_new, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c))
    return both.select(*out)


def merge_by_key(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Keyed document merge: incoming fields win, fields they lack are kept."""
    both = _beside(old, new, key)
    names = [*old.columns, *[c for c in new.columns if c not in old.columns]]
    out = []
    for c in names:
        if c in key or c not in new.columns:
            out.append(F.col(c))
        elif c in old.columns:
            out.append(F.coalesce(F.col(f"__new_{c}"), F.col(c)).alias(c))
        else:
            out.append(F.col(f"__new_{c}").alias(c))
    return both.select(*out)


def scd2(
    dim: DataFrame,
    src: DataFrame,
    natural_key: list[str],
    watch: list[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """Effective dating with one open line per key.

    A key without an open line is inserted.  If a watched value differs, the
    open line is closed the day before the new one starts and the new line is
    added; a change on the day the open line starts replaces that line.  A
    change dated before the open line would overlap what is known: it is left
    out here and returned by :func:`scd2_rejects`.  Equal values change
    nothing.  ``src`` has one row per key with ``valid_from``.

    Everything derives from one full join of the open lines with the source;
    each joined row yields its one or two result lines by a narrow ``inline``.
    """
    is_open = F.col(valid_to).isNull()
    history, current = dim.filter(~is_open), dim.filter(is_open)
    both = _beside(current, src, natural_key)
    has_old, has_new = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    starts, old_start = F.col(f"__new_{valid_from}").cast("date"), F.col(valid_from).cast("date")
    changed = has_old & has_new & _changed(watch) & (starts >= old_start)
    replaced = changed & (starts == old_start)

    def line(new: bool) -> Column:
        fields = []
        for c in dim.columns:
            type_ = dim.schema[c].dataType
            if c in natural_key:
                value = F.col(c)
            elif c == valid_to:
                closing = day_before(F.col(f"__new_{valid_from}").cast("date"))
                value = F.lit(None) if new else F.when(changed, closing)
            elif new:
                value = F.col(f"__new_{c}") if c in src.columns else F.lit(None)
            else:
                value = F.col(c)
            fields.append(value.cast(type_).alias(c))
        return F.struct(*fields)

    keep_old = F.when(has_old & ~F.coalesce(replaced, F.lit(False)), line(new=False))
    add_new = F.when(~has_old | changed, line(new=True))
    lines = F.filter(F.array(keep_old, add_new), lambda x: x.isNotNull())
    return history.unionByName(both.select(F.inline(lines)))


def scd2_timeline(
    dim: DataFrame,
    src: DataFrame,
    natural_key: list[str],
    watch: list[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """Effective dating with any number of changes per key, in any order, back-dated ones included.

    A key's timeline is cut at every day where a line starts or has ended and at
    every day of a change.  A change holds from its day up to the next cut, so
    one that is dated into an old line splits it and leaves later lines alone;
    on a day where a line starts it replaces that line.  Neighbours with equal
    watched values become one line.  Days without a line stay without one.  Of
    several changes of a key on one day the largest by the watched values holds.

    The lines of a key are swept in segments (:mod:`dialwright.operators.scans`),
    so neither a long history nor a dominant key ends up in one task.
    """
    kept = [c for c in dim.columns if c not in (*natural_key, valid_from, valid_to)]

    def cuts(rows: DataFrame, day: Column, rank: int) -> DataFrame:
        values = [(F.col(c) if c in rows.columns and rank else F.lit(None)).cast(dim.schema[c].dataType).alias(c) for c in kept]
        place = F.struct(F.lit(rank).alias("rank"), *[v for v, c in zip(values, kept, strict=True) if c in watch])
        return rows.select(*natural_key, day.alias("__day"), place.alias("__rank"), F.struct(*values, F.lit(rank > 0).alias("__held")).alias("__line"))

    ended = cuts(dim.filter(F.col(valid_to).isNotNull()), F.date_add(F.col(valid_to).cast("date"), 1), 0)
    events = ended.unionByName(cuts(dim, F.col(valid_from).cast("date"), 1)).unionByName(cuts(src, F.col(valid_from).cast("date"), 2))
    daily = events.groupBy(*natural_key, "__day").agg(F.max_by("__line", "__rank").alias("__line"))
    seen = daily.withColumn("__watched", F.struct(*[F.col(f"__line.{c}") for c in watch], F.col("__line.__held")))
    before = scans.with_previous(seen, natural_key, ["__day"], "__watched", "__before")
    starts = before.filter(~F.col("__watched").eqNullSafe(F.col("__before"))).withColumn("__back", -F.unix_date("__day"))
    bounded = scans.with_previous(starts, natural_key, ["__back"], "__day", "__next").filter("__line.__held")
    lines = {c: F.col(f"__line.{c}") for c in kept} | {
        valid_from: F.col("__day").cast(dim.schema[valid_from].dataType),
        valid_to: day_before(F.col("__next")).cast(dim.schema[valid_to].dataType),
    }
    return bounded.select(*[lines[c].alias(c) if c in lines else F.col(c) for c in dim.columns])


def scd2_rejects(
    dim: DataFrame,
    src: DataFrame,
    natural_key: list[str],
    watch: list[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """Rows of ``src`` that :func:`scd2` leaves out: changes dated before the open line of their key."""
    current = dim.filter(F.col(valid_to).isNull()).select(*natural_key, *[F.col(c).alias(f"__old_{c}") for c in {*watch, valid_from}])
    differs = reduce(or_, (~F.col(c).eqNullSafe(F.col(f"__old_{c}")) for c in watch))
    early = F.col(valid_from).cast("date") < F.col(f"__old_{valid_from}").cast("date")
    return src.join(current, natural_key).filter(differs & early).select(*src.columns)


def dim_date(
    days: DataFrame,
    day: str = "day",
    holidays: dict[str, str] | None = None,
    season_starts: dict[int, str] | None = None,
    academic_year_start_month: int = 9,
    spring_start_month: int = 2,
    autumn_name: str = "Autumn",
    spring_name: str = "Spring",
) -> DataFrame:
    """Calendar attributes for a column of days.

    ``holidays`` maps ISO dates to names.  Seasons, the academic year and its
    semesters have no published rule, so they are parameters.  An academic day
    is a weekday that is not a holiday.
    """
    seasons = season_starts or {3: "Spring", 6: "Summer", 9: "Autumn", 12: "Winter"}
    d = F.col(day).cast("date")
    month = F.month(d)
    season = F.lit(seasons[max(seasons)])
    for start in sorted(seasons):
        season = F.when(month >= start, F.lit(seasons[start])).otherwise(season)
    holiday = F.lit(None).cast("string")
    if holidays:
        names = F.create_map(*[F.lit(x) for pair in holidays.items() for x in pair])
        holiday = F.try_element_at(names, F.date_format(d, "yyyy-MM-dd"))
    starts = F.year(d) - (month < academic_year_start_month).cast("int")
    autumn = (month >= academic_year_start_month) | (month < spring_start_month)
    weekend = is_weekend(d) == 1
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        month.alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        weekend.alias("is_weekend"),
        holiday.isNotNull().alias("is_holiday"),
        holiday.alias("holiday_name"),
        season.alias("season"),
        F.concat_ws("-", starts.cast("string"), (starts + 1).cast("string")).alias("academic_year"),
        F.when(autumn, F.lit(autumn_name)).otherwise(F.lit(spring_name)).alias("academic_semester"),
        (~weekend & holiday.isNull()).alias("is_academic_day"),
    )


def calendar_between(lo_hi: DataFrame, lo: str = "lo", hi: str = "hi", day: str = "day") -> DataFrame:
    """Every day between the two dates of a one-row frame."""
    return lo_hi.select(
        F.explode(F.sequence(F.col(lo).cast("date"), F.col(hi).cast("date"), F.expr("interval 1 day"))).alias(day)
    )


def dim_time(
    spark: SparkSession,
    business_hours: tuple[int, int] = (8, 18),
    lecture_minutes: tuple[int, int] = (8 * 60 + 30, 17 * 60),
    periods: dict[int, str] | None = None,
) -> DataFrame:
    """The 1 440 minutes of a day with their slots.

    Business hours, lecture hours and named periods are parameters: the start
    counts, the end does not.
    """
    named = periods or {0: "Night", 6: "Morning", 12: "Afternoon", 18: "Evening"}
    minute = F.col("id").cast("int")
    hour = F.floor(minute / 60).cast("int")
    period = F.lit(None).cast("string")
    for start in sorted(named):
        period = F.when(hour >= start, F.lit(named[start])).otherwise(period)
    return spark.range(1440).select(
        minute.alias("time_key"),
        F.format_string("%02d:%02d", hour, minute % 60).alias("time_label"),
        hour.alias("hour"),
        (minute % 60).alias("minute"),
        F.floor(minute / 15).cast("int").alias("quarter_hour_slot"),
        F.floor(minute / 30).cast("int").alias("half_hour_slot"),
        hour.alias("hour_slot"),
        period.alias("time_period"),
        ((hour >= business_hours[0]) & (hour < business_hours[1])).alias("is_business_hour"),
        ((minute >= lecture_minutes[0]) & (minute < lecture_minutes[1])).alias("is_lecture_hour"),
    )
