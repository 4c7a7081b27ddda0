"""Name handling for table references, paths and SQL text.

Everything here runs on the driver over *names*, never over data.  All SQL
text built by the library goes through :func:`quote_ident` /
:func:`quote_ref` / :func:`sql_string`, so table names with odd characters
and paths with quotes cannot break the generated statements.
"""

from __future__ import annotations

import re
from pathlib import PurePosixPath

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def quote_ident(name: str) -> str:
    """Back-quote one identifier part, doubling any back-quote inside it."""
    if not name:
        raise ValueError("empty identifier")
    return "`" + name.replace("`", "``") + "`"


def split_ref(ref: str) -> list[str]:
    """Split a multi-part reference on dots outside back-quotes.

    ``a.b`` -> ``["a", "b"]``; ```my.db`.t`` -> ``["my.db", "t"]``.  Spaces
    around an unquoted part are dropped; a quoted part is kept as written.
    """
    parts: list[str] = []
    buf: list[str] = []
    quoted_part = False
    quoted = False
    i = 0

    def close() -> None:
        text = "".join(buf)
        if not quoted_part:
            text = text.strip()
        if not text:
            raise ValueError(f"empty name part in {ref!r}")
        parts.append(text)

    while i < len(ref):
        ch = ref[i]
        if ch == "`":
            if quoted and i + 1 < len(ref) and ref[i + 1] == "`":
                buf.append("`")
                i += 2
                continue
            if not quoted:
                if quoted_part or "".join(buf).strip():
                    raise ValueError(f"text before a quoted name part in {ref!r}")
                buf.clear()  # spaces before an opening quote are not part of the name
            quoted = not quoted
            quoted_part = True
        elif ch == "." and not quoted:
            close()
            buf, quoted_part = [], False
        elif quoted or not quoted_part:
            buf.append(ch)
        elif not ch.isspace():
            raise ValueError(f"text after a quoted name part in {ref!r}")
        i += 1
    if quoted:
        raise ValueError(f"unbalanced back-quote in {ref!r}")
    close()
    return parts


def quote_ref(ref: str | list[str] | tuple[str, ...]) -> str:
    """Quote every part of a multi-part reference."""
    parts = split_ref(ref) if isinstance(ref, str) else list(ref)
    return ".".join(quote_ident(p) for p in parts)


def sql_string(value: str) -> str:
    """A Spark SQL string literal in single quotes (paths, values).

    Backslashes and single quotes are escaped, so a path holding ``'``
    survives (reference fault: paths were pasted in raw).  Single quotes
    stay a string literal even with ``spark.sql.ansi.doubleQuotedIdentifiers``.
    """
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_col(name: str):
    """A DataFrame column for a plain column name, dots and spaces included."""
    from pyspark.sql import functions as F

    return F.col(quote_ident(name))


def qualify(ref: str, default_database: str) -> str:
    """Keep a reference that names its database, else prefix the default."""
    parts = split_ref(ref)
    if len(parts) > 1:
        return ref
    return quote_ref(split_ref(default_database) + parts)  # the default may name a catalog too


def path_stem(path: str) -> str:
    """Display name of a file or directory path: the stem of its last part."""
    stem = PurePosixPath(path.rstrip("/")).stem
    if not stem:
        raise ValueError(f"no name in path {path!r}")
    return stem


def path_table_name(path: str) -> str:
    """Table name for a path: its last part, minus a ``.parquet`` suffix only.

    Unlike the display stem, ``sales.2024`` stays ``sales.2024`` (and is then
    refused as a table name) instead of being cut to ``sales``.
    """
    last = PurePosixPath(path.rstrip("/")).name
    if last.lower().endswith(".parquet"):
        last = last[: -len(".parquet")]
    if not last:
        raise ValueError(f"no name in path {path!r}")
    return last


def is_plain_identifier(name: str) -> bool:
    return bool(_IDENT.match(name))


def target_table_name(name: str) -> str:
    """Check a derived target table name.

    Catalog sources derive it from the last part of ``db.table``, Parquet
    sources from the path stem.  Unlike the reference, a name that is not a
    plain identifier (stem ``a.b`` of ``a.b.parquet``, or ``*`` of a glob)
    is rejected instead of being cut at its last dot; give an explicit
    target name for such sources.
    """
    if not is_plain_identifier(name):
        raise ValueError(
            f"derived target name {name!r} is not a plain identifier; give an explicit target name"
        )
    return name
