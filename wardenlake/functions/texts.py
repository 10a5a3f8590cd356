"""Log-line tokens, keys and escapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOG_LINE = r"^\d{4}-\d{2}-\d{2}"


def is_log_line(line: Column) -> Column:
    """A data line starts with a date; headers and comments do not."""
    return F.coalesce(line.rlike(LOG_LINE), F.lit(False))


def log_tokens(line: Column) -> Column:
    """Tokens of a log line; a quoted part is one token and keeps its quotes."""
    return F.regexp_extract_all(line, F.lit(r'("[^"]*"|\S+)'), F.lit(1))


def request_key(client: Column, uri: Column, time_text: Column) -> Column:
    """md5 of client and URI followed by the hour."""
    return F.concat(F.md5(F.concat(client, uri)), F.get(F.split(time_text, ":"), F.lit(0)))


def escaped_newlines(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit("\\n"))
