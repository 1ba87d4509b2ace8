"""CSV reader and writer for landing files (IO1).

Landing CSV holds free text with line breaks and doubled quotes, so records
may span lines (``multiLine``).  Spark reads such a file in one task at any
size; a table's parallelism comes from its number of files, all read in one
job, so a large table should land as a folder of part files.

Every file's header must name the columns of the first: ``enforceSchema`` is
off, so a file with other or reordered columns fails the read instead of
being matched by position.

No schema is inferred: without ``inferSchema`` every column is a string
named by the header, which keeps leading zeros (zip ``"01037"``) and avoids a
full extra pass over the data.  Types are set later by safe casts.

``read_csv`` is Spark's permissive reader: a record with too few fields gets
NULLs, surplus fields are lost, an open quote swallows what follows.
``read_checked`` loses nothing: records that don't fit the header are set
apart with their text, and a file that ends inside a quote is named.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

CSV_READ_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "enforceSchema": "false",
}

# Spark's CSV writer trims values unless told not to; text must stay whole.
CSV_WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, path: str | list[str],
             schema: StructType | str | None = None,
             glob: str | None = "*.csv", **options: str) -> DataFrame:
    """Read CSV files below ``path`` (a file or a folder of files).

    With no ``schema`` all columns are strings named by the header.
    ``glob`` keeps only matching file names (other files in the folder are
    skipped); folders are searched recursively.
    """
    reader = spark.read.options(**{**CSV_READ_OPTIONS, **options})
    if glob:
        reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options: str) -> None:
    """Write with a header and quotes escaped by doubling (readable by ``read_csv``)."""
    df.write.mode(mode).options(**{**CSV_WRITE_OPTIONS, **options}).csv(path)


# ------------------------------------------------------------------ checked reads

FEW = "too_few_fields"
SURPLUS = "surplus_fields"
QUOTES = "text_after_quote"
OPEN = "open_quote"
#: Reasons of a record that is set apart, in the order of precedence.
REASONS = (OPEN, QUOTES, FEW, SURPLUS)


@dataclass(frozen=True)
class Checked:
    """A checked read of one table's files; all frames read the same records.

    ``rows``: records that fit the header.  ``seen`` has its values once they
    have been written: ``n_rows``, ``n_odd`` (all other records but blank
    ones: headers and misfits) and ``header_files``, a hash of the files that
    hold the headers.  ``misfits``: (file, reason, record) of the records that
    don't fit.  ``per_file``: (file, n_headers, n_records).
    """

    rows: DataFrame
    seen: Observation
    misfits: DataFrame
    per_file: DataFrame


def _plain(char: str) -> str:
    """A pattern of one character, in the form that splits fastest."""
    return "\\" + char if char in r".$|()[{^?*+\\" else char


def _count_in(text: Column, sep: str) -> Column:
    return F.size(F.split(text, r"\Q" + sep + r"\E" if len(sep) > 1 else _plain(sep), -1)) - 1


def _quoting(record: Column, sep: str, quote: str) -> Column:
    """(n_seps, bad, open) of a record with quotes, by walking over the pieces between them.

    A quote opens a value only at the start of a field; inside, two quotes are
    one character, and the closing one must be followed by a separator or the
    end.  bad: other text follows it.  open: the record ends inside a value.
    A quote inside an unquoted field is a character like any other.
    """
    begin, out, within, maybe = 0, 1, 2, 3  # maybe: a quote within, closing unless another follows at once

    def step(at: Column, piece: Column) -> Column:
        state = at["state"]
        opens = (state == out) & at["start"]
        closes = (state == within) & (piece != "")
        outside = (state == begin) | ((state == out) & ~at["start"]) | closes
        follows = piece.rlike(r"^[ \t\r\n]*(\Q" + sep + r"\E|$)")
        return F.struct(
            F.when(opens | (state == maybe), within).when((state == within) & (piece == ""), maybe).otherwise(out).alias("state"),
            (outside & (piece.endswith(sep) | ((state == begin) & (piece == "")))).alias("start"),
            (at["n_seps"] + F.when(outside, _count_in(piece, sep)).otherwise(0)).alias("n_seps"),
            (at["bad"] | (closes & ~follows)).alias("bad"))

    start = F.struct(F.lit(begin).alias("state"), F.lit(False).alias("start"), F.lit(0).alias("n_seps"), F.lit(False).alias("bad"))
    return F.aggregate(F.split(record, _plain(quote), -1), start, step, lambda at: F.struct(
        at["n_seps"].alias("n_seps"), at["bad"].alias("bad"), (at["state"] == within).alias("open")))


def file_print(file: Column, where: Column) -> Column:
    """Order-free hash of the files of some rows, as an aggregate."""
    return F.coalesce(F.bit_xor(F.when(where, F.xxhash64(file))), F.lit(0).cast("long"))


def _slots(n: int) -> list[str]:
    return [f"__f{i}" for i in range(n)]


def _wide(slots: list[str]) -> list[str]:
    """Columns of a read that is one column wider than its header, and the record's text."""
    return [*slots, "__more", "__record"]


def _strings(names: Sequence[str]) -> StructType:
    out = StructType()
    for c in names:
        out = out.add(c, StringType())
    return out


def _judged(wide: DataFrame, slots: list[str], header: Sequence[str | None] | None, sep: str, quote: str) -> DataFrame:
    """``wide`` with ``__kind``: NULL for a record that fits, else ``header``, ``blank`` or its reason."""
    n = len(slots)
    record, more = F.col("__record"), F.col("__more")
    quoted = F.when(record.contains(quote), _quoting(record, sep, quote))
    fields = F.when(record.isNull(), n + 1).otherwise(F.coalesce(F.col("__q.n_seps"), _count_in(record, sep)) + 1)
    bad, open_ = (F.coalesce(F.col(f"__q.{c}"), F.lit(False)) for c in ("bad", "open"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(h)) for c, h in zip(slots, header or [None] * n)])
    blank = more.isNull() & (F.trim(record) == "")
    kind = (F.when(open_, OPEN).when(bad, QUOTES).when(F.col("__n") < n, F.when(blank, "blank").otherwise(FEW))
            .when(F.col("__n") > n, SURPLUS).when(same, "header"))
    return wide.withColumn("__q", quoted).withColumn("__n", fields).withColumn("__kind", kind)


def _text(slots: list[str], sep: str, quote: str) -> Column:
    """A record's text; of one with exactly one field too many, its fields as CSV."""
    return F.coalesce(F.col("__record"), F.to_csv(F.struct(*slots, "__more"), {"quote": quote, "escape": quote, "sep": sep}))


def stream_checked(spark: SparkSession, source: str, names: Sequence[str], glob: str = "*.csv") -> tuple[DataFrame, DataFrame]:
    """Streams of the records below ``source`` that fit the header ``names``, and of (file, reason, record) of the others.

    As in ``read_checked``; a record that ends inside a quoted value is one of
    the others, with all that it swallows.
    """
    slots = _slots(len(names))
    wide = (spark.readStream.format("csv").options(**{**CSV_READ_OPTIONS, "header": "false"})
            .option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
            .option("columnNameOfCorruptRecord", "__record").schema(_strings(_wide(slots))).load(source))
    judged = _judged(wide, slots, names, CSV_READ_OPTIONS.get("sep", ","), CSV_READ_OPTIONS["quote"])
    good = judged.where(F.col("__kind").isNull()).select(*[F.col(s).alias(c) for s, c in zip(slots, names)])
    bad = judged.where(F.col("__kind").isin(*REASONS)).select(
        F.input_file_name().alias("file"), F.col("__kind").alias("reason"),
        _text(slots, ",", CSV_READ_OPTIONS["quote"]).alias("record"))
    return good, bad


def read_checked(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True,
                 glob: str = "*.csv", skip: DataFrame | None = None, **options: str) -> Checked:
    """Read CSV files so that no value is lost.

    The files are read once, one column wider than their header, so that
    Spark hands over the text of every record that has not exactly one field
    too many, and the text tells how many fields it has and whether its
    quotes are closed.  A record with fewer fields than the header, with
    more, or with text after a closing quote is a misfit; blank records are
    skipped, as by Spark's reader.  Header records are told by their values,
    wherever they are.  ``skip`` has a column ``file``, as ``input_file_name``
    spells it, of files whose records are left out.
    """
    paths = [path] if isinstance(path, str) else list(path)
    given = {**CSV_READ_OPTIONS, **options, "multiLine": str(multi_line).lower()}
    sep, quote = given.get("sep", ","), given["quote"]
    names = read_csv(spark, paths, glob=glob, **{**options, "multiLine": given["multiLine"]}).columns
    n = len(names)

    def reader():
        return (spark.read.options(**{**given, "header": "false"})
                .option("pathGlobFilter", glob).option("recursiveFileLookup", "true"))

    slots = _slots(n)
    header = reader().schema(_strings(slots)).csv(paths).head()  # the first record of some file
    wide = reader().option("columnNameOfCorruptRecord", "__record").schema(_strings(_wide(slots))).csv(paths)
    file = F.input_file_name()
    if skip is not None:  # a join ends the scan that input_file_name belongs to
        wide = wide.withColumn("__from", file).join(skip.select(F.col("file").alias("__from")), "__from", "left_anti")
        file = F.col("__from")

    judged = _judged(wide, slots, header, sep, quote)
    good = F.col("__kind").isNull()
    odd = ~good & (F.col("__kind") != "blank")
    header_ = F.col("__kind").eqNullSafe("header")
    judged = judged.withColumn("__file", F.when(odd, file))

    seen = Observation()
    rows = (judged.observe(seen, F.count_if(good).alias("n_rows"), F.count_if(odd).alias("n_odd"),
                           file_print(F.col("__file"), header_).alias("header_files"))
            .where(good).select(*[F.col(s).alias(c) for s, c in zip(slots, names)]))
    misfits = judged.where(odd & ~header_).select(
        F.col("__file").alias("file"), F.col("__kind").alias("reason"), _text(slots, sep, quote).alias("record"))
    per_file = (judged.where(good | odd).groupBy(file.alias("file"))
                .agg(F.count_if(header_).alias("n_headers"), F.count_if(good).alias("n_records")))
    return Checked(rows, seen, misfits, per_file)
