"""Writers. All replace what is at the path.

``files`` merges an output into about so many files: fewer if they would be small, more if they
would be large, as the session's advisory partition size says. ``records`` bounds the rows of a
file. With ``order`` the files, by name, and the rows inside each follow it, and ``files`` is exact.
"""


def _placed(table, files, order):
    """Rows are dealt by their content, so a task that runs again makes the same files."""
    if files is None:
        return table.orderBy(*order) if order else table
    if not order:
        return table.hint("rebalance", files, *table.columns)
    return table.repartitionByRange(files, *order).sortWithinPartitions(*order)


def write_csv(table, path, header=False, files=None, order=None, records=0):
    (
        _placed(table, files, order)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", records)
        .options(sep=",", quote='"', escape='"', header=header)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_parquet(table, path, compression="snappy", files=None, order=None, records=0):
    (
        _placed(table, files, order)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", records)
        .option("compression", compression)
        .parquet(path)
    )


def write_lines(lines, path, text="line", order="line_no"):
    """A small report as one text file, its lines in order."""
    lines.repartition(1).sortWithinPartitions(order).select(text).write.mode(
        "overwrite"
    ).text(path)


def show_table(table, rows=20):
    """Print the first rows on the console."""
    table.show(rows, truncate=False)
