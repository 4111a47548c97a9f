"""Column expressions. All are built-in Spark functions, so they stay inside
whole-stage codegen; nothing here runs Python per row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from finlake.schemas import DATE_FORMAT, NULL_TOKENS, PATH_SEPARATOR, ROUTES, DEFAULT_FEED, TREND_SCENARIOS


def col(name: str) -> Column:
    """Column by exact name; names here hold spaces, dots, slashes and '&'."""
    return F.col("`" + name.replace("`", "``") + "`")


def _c(x: str | Column) -> Column:
    return col(x) if isinstance(x, str) else x


def fiscal_type(
    wbs_code: str | Column = "WBS Element Code",
    cost_center: str | Column = "Cost Center Code",
    partner_cost_center: str | Column = "Partner Cost Center Code",
    product: str | Column = "Product Code",
    type_char: str | Column | None = None,
) -> Column:
    """First rule that holds: WBS code set -> WBS; cost centre or partner cost
    centre set -> COST CENTER; product set -> NO WBS; else FINANCE.

    With ``type_char`` (the actuals rule) a WBS code whose type char is 'M'
    counts as absent; a null type char does not."""
    wbs = _c(wbs_code)
    if type_char is not None:
        wbs = F.when(~_c(type_char).eqNullSafe(F.lit("M")), wbs)
    return (
        F.when(wbs.isNotNull(), F.lit("WBS"))
        .when(_c(cost_center).isNotNull() | _c(partner_cost_center).isNotNull(), F.lit("COST CENTER"))
        .when(wbs.isNull() & _c(product).isNotNull(), F.lit("NO WBS"))
        .otherwise(F.lit("FINANCE"))
    )


def first_char(c: str | Column) -> Column:
    """First character of a text (null stays null, '' stays '')."""
    return F.substring(_c(c), 1, 1)


def concat_codes(code: str | Column, description: str | Column) -> Column:
    """Code followed by its description; null if either is null."""
    return F.concat(_c(code), _c(description))


def period_digits(c: str | Column) -> Column:
    """First digit run of a period text ('M04_T' -> 4) as a long; no digits,
    bad or null -> 0."""
    digits = F.nullif(F.regexp_extract(_c(c), r"(\d+)", 1), F.lit(""))
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def month_start(year: str | Column, month: str | Column, strict: bool = True) -> Column:
    """Timestamp (no zone) of day 1 of year/month. Strict raises on a month
    outside 1..12; soft gives null."""
    y, m = _c(year), _c(month)
    if strict:
        return F.make_timestamp_ntz(y, m, F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return F.try_make_timestamp_ntz(y, m, F.lit(1), F.lit(0), F.lit(0), F.lit(0))


MDY_PATTERN = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"


def parse_date(c: str | Column, strict: bool = True, fmt: str = DATE_FORMAT) -> Column:
    """Parse month/day/year text to a timestamp without zone. Strict: a
    non-matching text fails the job (ANSI); soft: it becomes null. The soft
    form matches the month/day/year shape and builds the value from its
    parts, so no session time zone is involved."""
    x = _c(c)
    if strict:
        return F.to_timestamp_ntz(x, F.lit(fmt))
    part = [F.regexp_extract(x, MDY_PATTERN, i).cast("int") for i in (1, 2, 3)]
    built = F.try_make_timestamp_ntz(part[2], part[0], part[1], F.lit(0), F.lit(0), F.lit(0))
    return F.when(x.rlike(MDY_PATTERN), built)


def null_tokens(c: str | Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Text equal to one of the missing-value tokens becomes null."""
    x = _c(c)
    return F.when(~x.isin(list(tokens)), x)


INTEGER_PATTERN = r"^\s*([+-]?\d+)(\.0*)?\s*$"


def strict_long(c: str | Column) -> Column:
    """Text -> long accepting '12', '12.0' and '1.2e1' but not '12.5',
    '100.0000001', '1,234' or a number a long cannot hold. Returns null for
    those; callers flag rows where text was set and the result is null."""
    x = _c(c)
    direct = x.try_cast("bigint")  # most texts are just the digits, and need no pattern
    plain = F.regexp_extract(x, INTEGER_PATTERN, 1).try_cast("bigint")
    number = x.try_cast("double")
    exact = (number == F.floor(number)) & (F.abs(number) < F.lit(2.0**53))
    scientific = F.when(x.rlike("[eE]") & exact, number.try_cast("bigint"))
    return F.when(direct.cast("string") == x, direct).when(x.rlike(INTEGER_PATTERN), plain).otherwise(scientific)


def route_feed(file_name: str | Column) -> Column:
    """Feed table of a file: first routing token in its lower-cased name."""
    name = F.lower(_c(file_name))
    expr = None
    for token, feed in ROUTES:
        cond = name.contains(token)
        expr = F.when(cond, F.lit(feed)) if expr is None else expr.when(cond, F.lit(feed))
    return expr.otherwise(F.lit(DEFAULT_FEED))


def trend_scenario(source_file: str | Column) -> Column:
    """Trend scenario from a case-sensitive token in the source file name."""
    name = _c(source_file)
    expr = None
    for token, scenario in TREND_SCENARIOS:
        cond = name.contains(token)
        expr = F.when(cond, F.lit(scenario)) if expr is None else expr.when(cond, F.lit(scenario))
    return expr.otherwise(F.lit(None).cast("string"))


def path_join(parts: Column) -> Column:
    """Array of texts -> one path text."""
    return F.array_join(parts, PATH_SEPARATOR)


def path_part(path: str | Column, i: int) -> Column:
    """i-th (0-based) piece of a path text, null past the end."""
    return F.get(F.split(_c(path), F.lit(PATH_SEPARATOR), -1), F.lit(i))


#: A folder that a writer filled with part files: one extract, under the folder's name.
PARTS = r"^(.*/[^/_.][^/]*\.(?:csv|parquet))/part-[^/]*$"


def extract_path(path: str | Column) -> Column:
    """The extract that a listed file belongs to: the folder of a part file, else the file."""
    folder = F.regexp_extract(_c(path), PARTS, 1)
    return F.when(folder != "", folder).otherwise(_c(path))


def base_name(path: str | Column) -> Column:
    """Last path segment of a file URI/path."""
    return F.regexp_extract(_c(path), r"([^/\\]+)$", 1)
