"""Assertions over the same table answered by one scan of it.

A check file asks many small questions of few tables.  Each assertion that is a
plain aggregate, ``SELECT <expression over aggregates> FROM table [WHERE …]``, or a
comparison of such scalar subqueries (J1), is cut into its aggregate calls; a
``WHERE`` becomes the calls' ``FILTER``; equal calls are asked once; and every table
gets one query with all its calls.  The expressions are then evaluated over the one row of
answers.  If all calls of a table are filtered, the scan keeps the filters' disjunction, so
partitions that no call concerns are still pruned.

Shapes are read off Spark's own parser (node names and the source positions it
records), so nothing here reads SQL text by itself.  Whatever is not of these shapes
(joins, grouping, windows, subqueries elsewhere, several columns, functions
that might be aggregates unknown here) runs alone, as does every check of a table whose
fused query fails, so a failing expression fails by itself with its own message.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..functions.names import quote_ident

#: Aggregates that take a FILTER, and functions that may stand around them.
AGGREGATES = frozenset("count sum min max avg mean count_if bool_and bool_or every some any approx_count_distinct stddev variance".split())
AROUND = frozenset("between coalesce abs greatest least round floor ceil if ifnull nvl nullif".split())
#: Expressions that cannot stay inside a fused call, or outside one.
_NEVER = ("Subquery", "Exists", "ListQuery", "Window", "Lambda", "Generator")
_COLUMNS = ("UnresolvedAttribute", "UnresolvedStar", "UnresolvedRegex", "UnresolvedNamedLambdaVariable", "UnresolvedOrdinal")


class _NotPlain(Exception):
    """The statement is not of a shape that can be fused."""


@dataclass(frozen=True)
class Call:
    """One aggregate call over a table, with the statement's filter."""

    table: tuple[str, ...]
    call: str
    where: str | None

    @property
    def key(self) -> tuple[str, ...]:
        return tuple(p.lower() for p in self.table)

    @property
    def sql(self) -> str:
        return self.call if self.where is None else f"{self.call} FILTER (WHERE {self.where}\n)"


@dataclass
class Plain:
    """A statement as text around calls: ``pieces[0] calls[0] pieces[1] …``."""

    pieces: list[str] = field(default_factory=lambda: [""])
    calls: list[Call] = field(default_factory=list)
    name: str = ""  # of the statement's column

    def add(self, text: str) -> None:
        self.pieces[-1] += text

    def take(self, other: Plain) -> None:
        self.add("(" + other.pieces[0])
        self.calls += other.calls
        self.pieces += other.pieces[1:]
        self.add(")")

    def spelled(self, names: dict[Call, str]) -> str:
        out = self.pieces[0]
        for call, text in zip(self.calls, self.pieces[1:]):
            out += names[call] + text
        return out


def _children(node) -> list:
    return [node.children().apply(i) for i in range(node.children().size())]


def _span(node) -> tuple[int, int]:
    """Where an expression stands; of ``x IS NULL`` and the like the parser notes the predicate, not ``x``."""
    spans = [(o.startIndex().get(), o.stopIndex().get()) for o in (n.origin() for n in _every(node)) if o.startIndex().isDefined() and o.stopIndex().isDefined()]
    if not spans:
        raise _NotPlain
    return min(a for a, _ in spans), max(b for _, b in spans) + 1


def _every(node):
    yield node
    for child in _children(node):
        yield from _every(child)


def _only_expression(project):
    """The expression of a one-column projection, without its alias."""
    if project.nodeName() != "Project" or project.projectList().size() != 1:
        raise _NotPlain
    named = project.projectList().apply(0)
    if named.nodeName() not in ("Alias", "UnresolvedAlias"):
        raise _NotPlain
    return named.child()


def _one_table(sql: str, plan) -> Plain:
    """``SELECT <aggregates> FROM table [WHERE …]``."""
    expression, source, where = _only_expression(plan), plan.child(), None
    if source.nodeName() == "Filter":
        if any(n in x.nodeName() for x in _every(source.condition()) for n in _NEVER):
            raise _NotPlain
        a, b = _span(source.condition())
        where, source = sql[a:b], source.child()
    if source.nodeName() != "UnresolvedRelation":
        raise _NotPlain
    parts = source.multipartIdentifier()
    table = tuple(parts.apply(i) for i in range(parts.size()))
    spans: list[tuple[int, int]] = []

    def visit(node) -> None:
        name = node.nodeName()
        if name in _COLUMNS or any(n in name for n in _NEVER):
            raise _NotPlain
        if name == "UnresolvedFunction":
            function = node.nameParts().mkString(".").lower()
            if function in AGGREGATES:
                inside = [x for child in _children(node) for x in _every(child)]
                if any(n in x.nodeName() for x in inside for n in (*_NEVER, "UnresolvedOrdinal")) or (where and node.filter().isDefined()):
                    raise _NotPlain
                spans.append(_span(node))
                return
            if function not in AROUND:
                raise _NotPlain
        for child in _children(node):
            visit(child)

    visit(expression)
    if not spans:
        raise _NotPlain
    out, (at, end) = Plain(), _span(expression)
    for a, b in sorted(spans):
        out.add(sql[at:a])
        out.calls.append(Call(table, sql[a:b], where))
        out.pieces.append("")
        at = b
    out.add(sql[at:end])
    return out


def analyse(spark: SparkSession, sql: str) -> Plain | None:
    """The statement's calls and the text around them, or ``None`` if it must run alone."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
        expression = _only_expression(plan)
        if plan.child().nodeName() != "OneRowRelation":
            return _one_table(sql, plan)
        found, todo = [], [expression]
        while todo:
            node = todo.pop()
            if node.nodeName() == "ScalarSubquery":
                found.append((*_span(node), _one_table(sql, node.plan())))
            elif node.nodeName() in _COLUMNS or any(n in node.nodeName() for n in _NEVER):
                return None
            elif node.nodeName() == "UnresolvedFunction" and node.nameParts().mkString(".").lower() not in AROUND:
                return None
            else:
                todo += _children(node)
        if not found:
            return None
        out, (at, end) = Plain(), _span(expression)
        for a, b, inner in sorted(found, key=lambda f: f[0]):
            out.add(sql[at:a])
            out.take(inner)
            at = b
        out.add(sql[at:end])
        return out
    except Exception:  # noqa: BLE001 - not plain, or not SQL: run alone, it reports itself
        return None


@dataclass
class Fused:
    """The queries of a list of statements: one a table, and how each statement reads their answers."""

    plain: dict[int, Plain]
    names: dict[Call, str]
    queries: dict[tuple[str, ...], DataFrame]

    def tables_of(self, i: int) -> set[tuple[str, ...]]:
        return {c.key for c in self.plain[i].calls}

    def answers(self, spark: SparkSession, rows: dict[tuple[str, ...], object]) -> DataFrame:
        """One local row with the answers of the tables in ``rows``."""
        fields = [f for key in rows for f in self.queries[key].schema.fields]
        from pyspark.sql.types import StructType

        return spark.createDataFrame([tuple(v for r in rows.values() for v in r)], StructType(fields))

    def expression(self, i: int) -> str:
        return f"{self.plain[i].spelled(self.names)} AS {quote_ident(self.plain[i].name)}"


def fuse(spark: SparkSession, statements: Sequence[str | None]) -> Fused:
    """Fuse the statements that can be; ``None`` entries are passed over.  No job runs here.

    A statement that does not pass Spark's analysis by itself is left out."""
    plain = {i: p for i, sql in enumerate(statements) if sql is not None and (p := analyse(spark, sql)) is not None}
    for i, p in list(plain.items()):
        try:
            p.name = spark.sql(statements[i]).columns[0]
        except Exception:  # noqa: BLE001 - it runs alone and reports itself
            del plain[i]
    names: dict[Call, str] = {}
    by_table: dict[tuple[str, ...], list[Call]] = {}
    for p in plain.values():
        p.calls = [Call(by_table[c.key][0].table if c.key in by_table else c.table, c.call, c.where) for c in p.calls]
        for c in p.calls:
            if c not in names:
                names[c] = f"_s{len(names)}"
                by_table.setdefault(c.key, []).append(c)
    queries = {}
    for key, calls in by_table.items():
        asked = ", ".join(f"{c.sql} AS {names[c]}" for c in calls)
        where = " OR ".join(dict.fromkeys(f"({c.where}\n)" for c in calls)) if all(c.where for c in calls) else ""
        relation = ".".join(quote_ident(p) for p in calls[0].table)
        try:
            queries[key] = spark.sql(f"SELECT {asked} FROM {relation}" + (f" WHERE {where}" if where else ""))
        except Exception:  # noqa: BLE001 - its statements run alone and report themselves
            continue
    kept = {i: p for i, p in plain.items() if all(c.key in queries for c in p.calls)}
    return Fused(kept, names, queries)
