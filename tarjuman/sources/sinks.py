"""Table and statistics sinks."""

from pyspark.sql import DataFrame

OUTPUT_FORMATS = ("csv", "json", "parquet")


def output_format(path: str, explicit: str | None = None) -> str:
    """The explicit format, else the one the extension names, else csv."""
    if explicit:
        if explicit not in OUTPUT_FORMATS:
            raise ValueError(f"Unsupported output format: {explicit}")
        return explicit
    ending = path.rstrip("/").rsplit(".", 1)[-1].lower()
    return ending if ending in OUTPUT_FORMATS else "csv"


def write_table(
    df: DataFrame, path: str, file_format: str | None = None, mode: str = "overwrite"
) -> str:
    """Write ``df`` as a folder of part files; JSON is written as lines."""
    kind = output_format(path, file_format)
    writer = df.write.mode(mode)
    if kind == "csv":
        # Without these the writer trims cells and escapes quotes with a backslash.
        writer.csv(
            path, header=True, quote='"', escape='"', encoding="UTF-8",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
    elif kind == "json":
        writer.option("ignoreNullFields", "false").json(path)
    else:
        writer.parquet(path)
    return kind


def statistics_path(path: str) -> str:
    """``<stem>_stats.json`` beside the output."""
    folder, _, name = path.rstrip("/").rpartition("/")
    stem = name.rsplit(".", 1)[0] if "." in name else name
    return f"{folder}/{stem}_stats.json" if folder else f"{stem}_stats.json"


def write_statistics(stats: DataFrame, failures: DataFrame, path: str) -> str:
    """The one row of counters, and beside it the failures, whatever their number."""
    target = statistics_path(path)
    stats.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(target)
    failures.write.mode("overwrite").json(target.removesuffix(".json") + "_failures.json")
    return target
