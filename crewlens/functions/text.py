"""Text and number columns shared by the operators."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F


def sentence_case(c: Column) -> Column:
    """'  RESEARCH & dev ' -> 'Research & dev'."""
    t = F.trim(c)
    return F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substr(t, F.lit(2))))


def match_key(c: Column) -> Column:
    """Key on which names are compared: case and outer blanks do not count."""
    return F.lower(F.trim(c))


def strip(c: Column) -> Column:
    """Without white space of any kind at its ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(r"^\s*$")


def full_name(first: str = "first_name", last: str = "last_name") -> Column:
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def contains(c: Column, part: str) -> Column:
    """Case-insensitive LIKE '%part%'; % and _ inside `part` stay wildcards."""
    return c.ilike(f"%{part}%")


def said_yes(c: Column) -> Column:
    return F.lower(c) == "yes"


def exact_avg(column: str) -> Column:
    """Mean of an integer column as a decimal with four digits (no floating-point drift)."""
    return F.avg(F.col(column).cast("decimal(10,0)"))


def fill(template: str) -> Column:
    """Text with {column} places filled per row; a missing value reads None, never blanks the text.

    Compiled concatenation: format_string would run a formatter per row.
    """
    parts = []
    for literal, column, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if column:
            parts.append(F.coalesce(F.col(column).cast("string"), F.lit("None")))
    return F.concat(*parts)


def person_label() -> Column:
    """'First Last (email)' for pick lists."""
    return fill("{first_name} {last_name} ({email})")


def project_label(with_status: bool = False) -> Column:
    """'name (ID: n)' or 'name (ID: n | Status: s)' for pick lists."""
    if with_status:
        return fill("{project_name} (ID: {project_id} | Status: {status})")
    return fill("{project_name} (ID: {project_id})")


def searchable(term: str | None) -> bool:
    """A directory search needs a letter or an @."""
    return any(ch == "@" or (ch.isascii() and ch.isalpha()) for ch in term or "")
