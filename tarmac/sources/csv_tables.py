"""CSV readers. Fields may be quoted and hold commas; a blank one reads as null."""

from pyspark.sql import functions as F

_FORMAT = {"sep": ",", "quote": '"', "escape": '"'}


def read_header_csv(spark, path, columns=None):
    """CSV with a header line, every column text; ``columns`` are picked by name.

    Picking by name lets the parser skip the columns that are not used. Names come from the first
    file; a file with other names or another order fails the job.
    """
    table = spark.read.options(**_FORMAT).csv(
        path, header=True, inferSchema=False, enforceSchema=False
    )
    return table.select(*columns) if columns else table


def read_positional_csv(spark, path, schema, trim=False):
    """CSV file or folder of part files without a header, columns by position.

    With a typed schema a malformed field fails the job. ``trim`` strips blanks
    around each field, also inside quotes.
    """
    table = (
        spark.read.options(**_FORMAT)
        .option("ignoreLeadingWhiteSpace", trim)
        .option("ignoreTrailingWhiteSpace", trim)
        .csv(path, schema=schema, mode="FAILFAST")
    )
    if not trim:
        return table
    return table.select(
        [
            F.trim(f.name).alias(f.name) if f.dataType.typeName() == "string" else F.col(f.name)
            for f in table.schema.fields
        ]
    )


SHORT, LONG, MALFORMED = "short", "long", "malformed"


def _fields_in(line):
    """Number of fields of a line: separators outside quotes, and one."""
    plain = F.regexp_replace(line, '"(?:[^"]|"")*"', "")
    return F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1


def read_ragged_csv(spark, path, schema, trim=False):
    """A headerless CSV whose lines may be short, long or malformed, as two tables.

    The first holds the rows: a short line is filled with nulls, of a long one the further
    fields are dropped, and a line with a field that its type cannot hold is left out. The
    second holds the lines set aside for a look: ``line``, its number of ``fields``, ``reason``
    (``short``, ``long`` or ``malformed``, the last one first) and ``kept``, whether a row was
    made of it. Blank lines are no lines. A field holds no line break.
    """
    texts = ", ".join(f"`{name}` string" for name in schema.names)
    blanks = str(trim).lower()
    options = {
        **_FORMAT, "ignoreLeadingWhiteSpace": blanks, "ignoreTrailingWhiteSpace": blanks
    }
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.from_csv("value", texts, options).alias("fields"))
    columns = {
        f.name: F.trim(F.col("fields")[f.name]) if trim else F.col("fields")[f.name]
        for f in schema.fields
    }
    typed = {f.name: columns[f.name].try_cast(f.dataType) for f in schema.fields}
    bad = F.lit(False)
    for name, value in typed.items():
        bad = bad | (columns[name].isNotNull() & value.isNull())
    fields = _fields_in(F.col("value"))
    reason = (
        F.when(bad, MALFORMED)
        .when(fields < len(schema.names), SHORT)
        .when(fields > len(schema.names), LONG)
    )
    rows = parsed.where(~bad).select([value.alias(name) for name, value in typed.items()])
    aside = parsed.select(
        F.col("value").alias("line"),
        fields.alias("fields"),
        reason.alias("reason"),
        (~bad).alias("kept"),
    ).where("reason IS NOT NULL")
    return rows, aside
