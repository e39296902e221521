"""Small column rules: references, dates, numbers and texts.

Null ordering: the reports sort ascending with NULL last and descending with
NULL first, the opposite of Spark's default, so the clause is always explicit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import literals as fixed


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- references -----------------------------------------------------------

def has_ref(ref: Column | str) -> Column:
    """True for a set reference; NULL stays NULL and therefore never passes a filter."""
    return as_column(ref) != F.lit(fixed.ZERO_REF)


def no_ref(ref: Column | str) -> Column:
    return as_column(ref) == F.lit(fixed.ZERO_REF)


def null_ref(ref: Column | str) -> Column:
    """The zero reference turned into NULL, so it cannot become a hot join key."""
    return F.nullif(as_column(ref), F.lit(fixed.ZERO_REF))


def is_true(flag: Column | str) -> Column:
    return as_column(flag).eqNullSafe(F.lit(True))


def is_false(flag: Column | str) -> Column:
    return as_column(flag).eqNullSafe(F.lit(False))


def live(df: DataFrame, deleted: str = "deleted", posted: str = "posted") -> DataFrame:
    """Documents that are posted and not marked as deleted; an unknown flag drops the row."""
    return df.where((F.col(deleted) == F.lit(False)) & (F.col(posted) == F.lit(True)))


# --- order ----------------------------------------------------------------

def descending(col: Column | str) -> Column:
    return as_column(col).desc_nulls_first()


def ascending(col: Column | str) -> Column:
    return as_column(col).asc_nulls_last()


def latest(value: Column | str, by: Column | str, *ties: Column | str, nulls_win: bool = True) -> Column:
    """Aggregate: the value on the row with the greatest ``by``.

    With ``nulls_win`` a NULL ``by`` counts as the greatest, as in a descending
    sort with NULL first. Remaining ties go to the greatest value, so the result
    is repeatable. Combines map-side, so a hot key stays one small buffer.
    """
    by, value = as_column(by), as_column(value)
    flag = by.isNull() if nulls_win else by.isNotNull()
    return F.max_by(value, F.struct(flag, by, *[as_column(t) for t in ties], value))


def earliest(value: Column | str, by: Column | str, *ties: Column | str) -> Column:
    """Aggregate: the value on the row with the smallest ``by``, NULL last."""
    by, value = as_column(by), as_column(value)
    return F.min_by(value, F.struct(by.isNull(), by, *[as_column(t) for t in ties], value))


# --- dates ----------------------------------------------------------------

def real_date(col: Column | str, floor: str = fixed.REAL_DATE_FLOOR, inclusive: bool = True) -> Column:
    """Dates before the floor mean "not set" and become NULL."""
    col = as_column(col)
    edge = F.lit(floor).cast("timestamp_ntz")
    return F.when(col >= edge if inclusive else col > edge, col)


def first_real_date(*cols: Column | str, fallback: Column | str) -> Column:
    return F.coalesce(*[real_date(c) for c in cols], as_column(fallback))


def effective_date(
    unloaded: Column | str, requested: Column | str, unload_plan: Column | str,
    loaded: Column | str, load_plan: Column | str,
) -> Column:
    """Accounting date of a request: first credible of the four loading facts and plans.

    An unloading before the request itself is not credible. Loading dates are
    shifted by five days of travel; the loading plan is the last resort even
    when it is not credible.
    """
    unloaded, requested, unload_plan, loaded, load_plan = map(
        as_column, (unloaded, requested, unload_plan, loaded, load_plan)
    )
    travel = F.expr("INTERVAL 5 DAYS")
    done = F.when(unloaded < requested, F.lit(None)).otherwise(unloaded)
    return F.coalesce(
        real_date(done, inclusive=False),
        real_date(unload_plan, inclusive=False),
        real_date(loaded, inclusive=False) + travel,
        load_plan + travel,
    ).cast("date")


def month_of(col: Column | str) -> Column:
    return F.trunc(as_column(col).cast("date"), "month")


def month_index(col: Column | str) -> Column:
    col = as_column(col)
    return (F.year(col) * 12 + F.month(col)).cast("int")


def age_months(later: Column | str, earlier: Column | str) -> Column:
    """Whole calendar months between two dates, truncated towards zero.

    Not ``months_between``: that treats two month ends as a whole month.
    """
    later, earlier = as_column(later).cast("date"), as_column(earlier).cast("date")
    months = month_index(later) - month_index(earlier)
    short = F.when((months > 0) & (F.dayofmonth(later) < F.dayofmonth(earlier)), 1).when(
        (months < 0) & (F.dayofmonth(later) > F.dayofmonth(earlier)), -1
    ).otherwise(0)
    return months - short


def repair_year(col: Column | str) -> Column:
    """Two-digit years typed into the source land before year 1000; move them to this century."""
    col = as_column(col)
    return F.when(F.year(col) < 1000, col + F.expr("INTERVAL 2000 YEARS")).otherwise(col)


def shift_hours(col: Column | str, hours: Column | str) -> Column:
    zero = F.lit(0)
    return as_column(col) + F.make_dt_interval(zero, as_column(hours).cast("int"), zero, zero)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(as_column(later).cast("date"), as_column(earlier).cast("date"))


def age_days(later: Column, earlier: Column) -> Column:
    """Age in days with one decimal."""
    seconds = F.unix_timestamp(later.cast("timestamp")) - F.unix_timestamp(earlier.cast("timestamp"))
    return (seconds.cast("decimal(20,0)") / F.lit(86400)).cast("decimal(10,1)")


# --- numbers --------------------------------------------------------------

def round_int(col: Column | str) -> Column:
    """Integer cast that rounds half away from zero, where Spark's own cast truncates."""
    return F.round(as_column(col), 0).cast("long")


def to_quantity(text: Column | str) -> Column:
    """A number typed as text, with blanks between thousands and a decimal comma."""
    plain = F.replace(F.replace(as_column(text), F.lit(" "), F.lit("")), F.lit(","), F.lit("."))
    return plain.cast("decimal(24,6)")


def largest_dimension(*dims: Column | str) -> Column:
    """The greatest dimension, known only when every dimension is known."""
    cols = [as_column(d) for d in dims]
    known = cols[0].isNotNull()
    for col in cols[1:]:
        known = known & col.isNotNull()
    return F.when(known, F.greatest(*cols))


def weight_by_dimension(weight: Column | str, *dims: Column | str) -> Column:
    """Chargeable weight: a long cargo counts at least as the class of its longest side."""
    weight = as_column(weight)
    longest = F.greatest(*[as_column(d) for d in dims])
    floor = None
    for edge, tons in fixed.DIMENSION_CLASSES:
        hit = longest >= F.lit(edge).cast("decimal(10,3)")
        tons = F.lit(tons).cast("decimal(10,3)")
        floor = F.when(hit, tons) if floor is None else floor.when(hit, tons)
    floor = floor.when(longest.isNotNull(), F.lit(fixed.SMALLEST_WEIGHT).cast("decimal(10,3)"))
    return F.when(weight < floor, floor).otherwise(weight)


def weight_class(weight: Column, classes: list[tuple[str, str]], above: str | Column) -> Column:
    """First class whose upper edge the weight does not exceed; NULL weight falls to ``above``."""
    chain = None
    for edge, name in classes:
        hit = weight <= F.lit(edge).cast("decimal(10,2)")
        chain = F.when(hit, F.lit(name)) if chain is None else chain.when(hit, F.lit(name))
    return chain.otherwise(F.lit(above) if isinstance(above, str) else above)


# --- texts ----------------------------------------------------------------

def acronym(name: Column | str) -> Column:
    """Branch name reduced to its capitals: every word capitalised, then small Russian
    letters, blanks and hyphens removed. A word starts after any character that is
    not a letter or digit, which Spark's ``initcap`` does not do.
    """
    words = F.regexp_extract_all(as_column(name), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    capitalised = F.transform(
        words, lambda w: F.concat(F.upper(w.substr(F.lit(1), F.lit(1))), F.lower(w.substr(F.lit(2), F.length(w))))
    )
    return F.regexp_replace(F.array_join(capitalised, ""), "[а-я -]", "")


def pad_code(code: Column | str, width: int = fixed.ITEM_CODE_WIDTH) -> Column:
    """Item code with leading zeros restored; a code that is long enough stays as it is."""
    code = as_column(code)
    return F.when(F.length(code) < width, F.lpad(code, width, "0")).otherwise(code)


def starts_with_any(col: Column | str, prefixes: list[str], length: int) -> Column:
    return F.substring(as_column(col), 1, length).isin(*prefixes)


def matches_any(col: Column | str, patterns: list[str]) -> Column:
    """Case-insensitive LIKE against any of the patterns."""
    col = as_column(col)
    hit = col.ilike(patterns[0])
    for pattern in patterns[1:]:
        hit = hit | col.ilike(pattern)
    return hit


def route_key(route: Column | str, request: Column | str) -> Column:
    """``route/request`` text key where a missing part is nine blanks."""
    blank = F.lit(" " * 9)
    return F.concat(F.coalesce(as_column(route), blank), F.lit("/"), F.coalesce(as_column(request), blank))
