"""Typed CSV and Parquet reads of fact extracts.

Spark maps an explicit CSV schema to columns by position and ignores the
header, so a file whose columns come in another order would be silently
swapped. We therefore (1) look at every file's first record and quotes (see
``probe``), (2) group files with identical headers, (3) read each group as text
under its own header, (4) turn missing-value tokens into nulls and (5) cast by
column name. A value that does not parse to its declared type, or a row with more
or fewer fields than the header, marks its row bad (``__bad``) instead of failing
the job or moving values; the import plan quarantines files that hold bad rows. Only
one empty field too many, from a delimiter at the end of a row, is let pass.

Files are split over tasks by Spark's line reader; those whose quoted fields hold
line breaks are read as records (see ``records``), split as well.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.functions.columns import base_name, col, extract_path, null_tokens, strict_long
from finlake.schemas import RAW_TYPES
from finlake.sources.probe import csv_facts, csv_head
from finlake.sources.records import csv_records
from finlake.sources.store import for_each, literal, readable
from finlake.sources.store import norm as _norm

#: Prefix under which files that Spark's readers hide are copied (see ``files.visible_copies``).
VISIBLE = "visible~"


def source_file_name() -> Column:
    """Name of the extract a row was read from: its file, or the folder of its
    part file. Spark reports it URI-encoded ('a%20b.csv'); decode it so it equals the listed name. A
    literal '+' is kept (form decoding would turn it into a space).

    This is worked out for every row, so paths without encoded characters (no line ends or
    backslashes then, either) are cut by plain text functions; patterns take several times
    as long as parsing the row."""
    uri = F.col("_metadata.file_path")
    path = F.url_decode(F.regexp_replace(uri, r"\+", "%2B"))
    decoded = F.regexp_replace(base_name(extract_path(path)), f"^{VISIBLE}", "")
    name, folder = F.substring_index(uri, "/", -1), F.substring_index(F.substring_index(uri, "/", -2), "/", 1)
    is_part = name.startswith("part-") & (folder.endswith(".csv") | folder.endswith(".parquet"))
    plain = F.when(is_part & ~folder.startswith("_") & ~folder.startswith("."), folder).otherwise(name)
    odd = uri.contains("%") | uri.contains("\\") | uri.contains(VISIBLE)
    return F.when(odd, decoded).otherwise(plain)


FACT_ENCODING = "ISO-8859-1"
DIM_ENCODING = "UTF-8"


@dataclass
class Rejected:
    path: str
    reason: str


@dataclass
class HeaderGroups:
    """Paths by (column names, line end of files to be read as records or None)."""

    groups: dict[tuple[tuple[str, ...], str | None], list[str]] = field(default_factory=dict)
    rejected: list[Rejected] = field(default_factory=list)


def header_names(record: str) -> tuple[str, ...]:
    return tuple(next(csv.reader([record.lstrip("\ufeff")])))


def read_headers(spark: SparkSession, paths: list[str], encoding: str = FACT_ENCODING) -> dict[str, str]:
    """First record of each non-empty file. Folders are expanded by Spark's file index."""
    if not paths:
        return {}
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([literal(p) for p in paths]).select("path")
    heads = for_each([r["path"] for r in listing.collect()], lambda p: csv_head(spark, p))
    return {p: h["record"].decode(encoding, "replace") for p, h in heads.items() if h["record"] is not None}


def group_by_header(
    spark: SparkSession, paths: list[str], encoding: str = FACT_ENCODING, multi_line: bool | None = None
) -> HeaderGroups:
    """Files by header. They are read as records if a quoted field holds a line break, or as ``multi_line`` says."""
    facts = csv_facts(spark, paths, encoding)
    out = HeaderGroups()
    groups: dict[tuple[tuple[str, ...], str | None], list[str]] = defaultdict(list)
    for p in paths:
        f = facts[p]
        if f["empty"]:
            out.rejected.append(Rejected(p, "empty file"))
            continue
        if f["unclosed"]:
            out.rejected.append(Rejected(p, "a quoted field is not closed"))
            continue
        if f["mixed"]:
            out.rejected.append(Rejected(p, "the part files differ in header or line end"))
            continue
        if f["header"] is None:
            out.rejected.append(Rejected(p, "no header record at the start of the file"))
            continue
        try:
            names = header_names(f["header"])
        except csv.Error as error:
            out.rejected.append(Rejected(p, f"the header cannot be read: {error}"))
            continue
        if len(set(names)) != len(names):
            out.rejected.append(Rejected(p, f"duplicate column names in header {names}"))
            continue
        if len({n.lower() for n in names}) != len(names):
            out.rejected.append(Rejected(p, f"column names equal but for case in header {names}"))
            continue
        as_records = f["quoted_newline"] if multi_line is None else multi_line
        groups[names, f["line_end"] if as_records else None].append(p)
    out.groups = dict(groups)
    return out


def cast_text(c: Column, dtype: T.DataType) -> tuple[Column, Column]:
    """(typed value, bad flag) for a text column already cleaned of tokens."""
    if isinstance(dtype, T.LongType):
        typed = strict_long(c)
    elif isinstance(dtype, T.StringType):
        return c, F.lit(False)
    else:
        typed = c.try_cast(dtype)
    return typed, (c.isNotNull() & typed.isNull())


def first_reason(checks: list[tuple[str, Column, Column]]) -> Column:
    """Text naming the first (column, bad flag, value) whose flag holds, else null."""
    if not checks:
        return F.lit(None).cast("string")
    return F.coalesce(
        *[F.when(bad, F.concat(F.lit(f"column {name!r}: "), F.substring(value.cast("string"), 1, 80))) for name, bad, value in checks]
    )


#: Column of the text of rows whose fields do not match the header.
ODD = "__odd"
OPTIONS = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": ODD}


def text_schema(n: int) -> T.StructType:
    """``n`` text columns by position, and the row itself if it has another number of fields."""
    return T.StructType([T.StructField(f"__c{i}", T.StringType()) for i in range(n)] + [T.StructField(ODD, T.StringType())])


def text_ddl(n: int) -> str:
    return ", ".join(f"{f.name} string" for f in text_schema(n).fields)


def odd_row(n: int) -> Column:
    """Why a row has the wrong shape, or null; a delimiter at its end is not counted."""
    shorter = F.expr(f"substring({ODD}, 1, length({ODD}) - 1)")
    closed = F.col(ODD).endswith(",") & F.from_csv(shorter, text_ddl(n), OPTIONS)[ODD].isNull()
    return F.when(
        F.when(F.col(ODD).isNotNull(), ~closed).otherwise(False), F.concat(F.lit(f"not the {n} fields of the header: "), F.substring(ODD, 1, 80))
    )


def read_csv_group(
    spark: SparkSession,
    names: tuple[str, ...],
    paths: list[str],
    types: dict[str, T.DataType] | None = None,
    encoding: str = FACT_ENCODING,
    records: str | None = None,
    work: str | None = None,
) -> DataFrame:
    """Read files sharing one header; return typed columns in header order,
    ``source_file`` (base name) and ``__bad`` (why the row is bad, or null).
    ``records`` is the line end of files whose quoted fields hold line breaks (``work``
    is then a folder on shared storage for them); without it every line is a row."""
    types = RAW_TYPES if types is None else types
    schema = text_schema(len(names))
    if records is None:
        raw = (
            spark.read.schema(schema)
            .options(**OPTIONS, header="true", encoding=encoding, multiLine="false", columnPruning="false")
            .csv(readable(spark, paths))
            .select("*", source_file_name().alias("source_file"))
        )
    else:
        name = F.regexp_replace(base_name(extract_path("path")), f"^{VISIBLE}", "")
        raw = csv_records(spark, paths, records, work).select(
            F.from_csv(F.decode("record", encoding), text_ddl(len(names)), OPTIONS).alias("r"), name.alias("source_file")
        )
        raw = raw.select("r.*", "source_file")
    # each value is cast once, in a step of its own, for its column and its check
    dtypes = [types.get(name, T.StringType()) for name in names]
    texts = raw.select(*[null_tokens(F.col(f"__c{i}")).alias(f"__c{i}") for i in range(len(names))], ODD, "source_file")
    typed = texts.select("*", *[cast_text(F.col(f"__c{i}"), t)[0].alias(f"__v{i}") for i, t in enumerate(dtypes)])
    checks = [
        (name, F.col(f"__c{i}").isNotNull() & F.col(f"__v{i}").isNull(), F.col(f"__c{i}"))
        for i, (name, t) in enumerate(zip(names, dtypes))
        if not isinstance(t, T.StringType)
    ]
    cols = [F.col(f"__v{i}").alias(name) for i, name in enumerate(names)]
    return typed.select(*cols, F.col("source_file"), F.coalesce(odd_row(len(names)), first_reason(checks)).alias("__bad"))


def read_parquet_files(spark: SparkSession, paths: list[str], types: dict[str, T.DataType] | None = None) -> DataFrame:
    """S3: Parquet extracts of one schema keep it; known columns are cast to
    their registry type so unions and joins line up."""
    types = RAW_TYPES if types is None else types
    df = spark.read.parquet(*readable(spark, paths)).select("*", source_file_name().alias("source_file"))
    cols, checks = [], []
    for f in df.schema.fields:
        if f.name == "source_file":
            continue
        want = types.get(f.name)
        if want is not None and f.dataType != want:
            typed, bad = cast_value(f.name, f.dataType, want)
            checks.append((f.name, bad, col(f.name)))
            cols.append(typed.alias(f.name))
        else:
            cols.append(col(f.name))
    return df.select(*cols, F.col("source_file"), first_reason(checks).alias("__bad"))


def cast_value(name: str, source: T.DataType, want: T.DataType) -> tuple[Column, Column]:
    """(column ``name`` as ``want``, bad flag): no value may change or get lost."""
    c = col(name)
    if isinstance(source, T.StringType):
        return cast_text(null_tokens(c), want)
    typed = c.try_cast(want)
    bad = c.isNotNull() & typed.isNull()
    if isinstance(want, T.LongType) and isinstance(source, (T.FractionalType,)):
        bad = bad | (c != F.floor(c))
    return typed, bad


def headers_under(spark: SparkSession, paths: list[str], encoding: str = DIM_ENCODING) -> dict[str, tuple[str, ...]]:
    """Column names of each given file or folder (all part files of a
    folder must share one header), from one distributed scan."""
    found = {_norm(k): v for k, v in read_headers(spark, paths, encoding).items()}
    out: dict[str, tuple[str, ...]] = {}
    for p in paths:
        base = _norm(p).rstrip("/")
        lines = {h for f, h in found.items() if f == base or f.startswith(base + "/")}
        if len(lines) != 1:
            raise ValueError(f"{p}: expected one header, found {len(lines)}")
        names = header_names(lines.pop())
        if len({n.lower() for n in names}) != len(names):
            raise ValueError(f"{p}: duplicate column names in header {names}")
        out[p] = names
    return out


def read_dim_csv(
    spark: SparkSession,
    path: str,
    types: dict[str, T.DataType],
    columns: list[str] | None = None,
    ordinal: str | None = None,
    names: tuple[str, ...] | None = None,
) -> DataFrame:
    """One dimension file or folder of part files (UTF-8, header row,
    text unless typed). A bad typed value fails the read, as a broken
    dimension must not load. With ``ordinal`` the file order (file path,
    then line) is kept as a distinct long column. ``names`` is the header
    when already known."""
    if names is None:
        names = headers_under(spark, [path])[path]
    raw = (
        spark.read.schema(text_schema(len(names)))
        .options(**OPTIONS, header="true", encoding=DIM_ENCODING, multiLine="true", columnPruning="false")
        .csv(literal(path))
    )
    # a row with other fields than the header must not load
    odd = odd_row(len(names))
    raw = raw.withColumn("__c0", F.when(odd.isNotNull(), F.raise_error(F.concat(F.lit(f"{path}: "), odd))).otherwise(F.col("__c0")))
    if ordinal:
        # File order: file path, then split offset, then row id in the split.
        raw = raw.select(
            "*",
            F.col("_metadata.file_path").alias("__file"),
            F.col("_metadata.file_block_start").alias("__blk"),
            F.monotonically_increasing_id().alias("__rid"),
        )
    cols = []
    for i, name in enumerate(names):
        if columns is not None and name not in columns:
            continue
        text = null_tokens(F.col(f"__c{i}"))
        dtype = types.get(name, T.StringType())
        if isinstance(dtype, T.LongType):
            typed = F.when(text.isNull() | strict_long(text).isNotNull(), strict_long(text)).otherwise(
                F.raise_error(F.concat(F.lit(f"{path}: bad integer in column {name}: "), text))
            )
        elif isinstance(dtype, T.StringType):
            typed = text
        else:
            typed = text.cast(dtype)
        cols.append(typed.cast(dtype).alias(name))
    if ordinal:
        from finlake.operators.filldown import with_ordinal

        staged = raw.select(*cols, "__file", "__blk", "__rid")
        return with_ordinal(staged, ["__file", "__blk", "__rid"], name=ordinal).drop("__file", "__blk", "__rid")
    return raw.select(*cols)
