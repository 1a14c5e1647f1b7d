"""Statements: commands for catalogs, and queries whose catalogued tables are put in place of their names."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame

from ..functions import types
from ..model import InvalidInput, NotFound, NotImplementedInCatalog
from . import ddl

_OPTION = re.compile(r"""([A-Za-z_]\w*)\s*(?:=|\s)?\s*('(?:[^']|'')*'|"[^"]*"|[\w.:/-]+)?""")
_WORD = r"[`\"]?[\w$-]+[`\"]?"
_NAME = rf"{_WORD}(?:\s*\.\s*{_WORD})*"
ATTACH_OPTIONS = {"type", "default_schema", "warehouse_location", "read_only"}
KINDS = {"hive_metastore", "hms_catalog"}


def parts_of(name: str) -> list[str]:
    return [p.strip().strip('`"') for p in re.findall(r'`[^`]+`|"[^"]+"|[^.\s]+', name)]


def options_of(text: str) -> dict[str, str]:
    """name value, name = value or a bare name, separated by commas."""
    out = {}
    for part in types.split_nested(text, ","):
        m = _OPTION.fullmatch(part.strip())
        if not m:
            raise InvalidInput(f"not an option: {part!r}")
        value = m[2]
        out[m[1].lower()] = "true" if value is None else value[1:-1].replace("''", "'") if value[0] in "'\"" else value
    return out


def command(engine, text: str) -> DataFrame | None:
    """Runs text if it is a command for catalogs; None if it is a query."""
    sql = without_comments(text).strip().rstrip(";").strip()
    flat = re.sub(r"\s+", " ", sql)
    up = flat.upper()
    done = lambda: engine.rows([(True,)], "Success boolean")

    if m := re.fullmatch(rf"ATTACH\s+(?:DATABASE\s+)?'([^']*)'\s+AS\s+({_WORD})\s*(?:\((.*)\))?", sql, re.I | re.S):
        o = options_of(m[3] or "")
        if unknown := set(o) - ATTACH_OPTIONS:
            raise InvalidInput(f"unknown options: {', '.join(sorted(unknown))}")
        if o.get("type", "hive_metastore").lower() not in KINDS:
            raise InvalidInput(f"unknown catalog type {o['type']}")
        engine.attach(m[1], parts_of(m[2])[0], o.get("default_schema", "default"), o.get("warehouse_location"), o.get("read_only", "false").lower() in ("true", "1"))
        return done()
    if m := re.fullmatch(rf"DETACH (?:DATABASE )?(?:IF EXISTS )?({_WORD})", flat, re.I):
        engine.detach(parts_of(m[1])[0], "IF EXISTS" in up)
        return done()
    if up in ("SHOW DATABASES", "SHOW CATALOGS"):
        return engine.attached()
    if m := re.fullmatch(rf"SHOW TABLES (?:FROM|IN) ({_NAME})", flat, re.I):
        names = parts_of(m[1])
        if names[0] in engine.catalogs:
            c = engine.catalogs[names[0]]
            return engine.rows([(t,) for t in c.tables(names[1] if len(names) > 1 else c.default_schema)], "name string")
        return None
    if (m := re.fullmatch(rf"(?:DESCRIBE|DESC)(?: TABLE)? ({_NAME})", flat, re.I)) and engine.resolve(parts_of(m[1])):
        return engine.describe(m[1])
    if m := re.fullmatch(rf"USE ({_NAME})", flat, re.I):
        names = parts_of(m[1])
        if names[0] in engine.catalogs:
            engine.current = (names[0], names[1] if len(names) > 1 else engine.catalogs[names[0]].default_schema)
            return done()
        return None
    if re.fullmatch(r"(CALL|SELECT \* FROM) HMS_CLEAR_CACHE\(\)", up):
        engine.clear_cache()
        return done()
    if re.match(r"(LOAD|INSTALL) ", up) or up in ("BEGIN", "BEGIN TRANSACTION", "COMMIT", "ROLLBACK", "CHECKPOINT", "START TRANSACTION"):
        return done()  # nothing to load, and catalogs have no transactions
    if m := re.fullmatch(rf"CREATE (?:OR REPLACE )?(?:PERSISTENT |TEMPORARY )?SECRET ({_WORD} )?\((.*)\)", flat, re.I):
        engine.create_secret((m[1] or "default").strip(), **options_of(m[2]))
        return done()
    if m := re.fullmatch(r"SET (?:GLOBAL |SESSION )?(unsafe_enable_version_guessing) ?(?:=|TO) ?(\w+)", flat, re.I):
        engine.options[m[1].lower()] = m[2].lower() in ("true", "1", "on")
        return done()
    return _change(engine, sql, up, done)


def _change(engine, sql: str, up: str, done) -> DataFrame | None:
    """Statements that change something; those on attached catalogs that aren't supported say so."""
    m = re.match(rf"CREATE\s+(OR\s+REPLACE\s+)?TABLE\s+(IF\s+NOT\s+EXISTS\s+)?({_NAME})\s*(.*)", sql, re.I | re.S)
    if m and (where := engine.place(parts_of(m[3]))):
        if m[1] or m[2]:
            raise NotImplementedInCatalog("OR REPLACE and IF NOT EXISTS aren't supported in attached catalogs")
        depth, end = 0, 0
        for end, ch in enumerate(m[4]):
            depth += (ch == "(") - (ch == ")")
            if not depth:
                break
        head, rest = m[4][1:end], m[4][end + 1 :]
        if not m[4].startswith("(") or re.match(r"\s*AS\b", rest, re.I):
            raise NotImplementedInCatalog("CREATE TABLE AS isn't supported in attached catalogs")
        given = re.search(r"WITH\s*\((.*?)\)\s*$|WITH\s*\((.*?)\)", rest, re.I | re.S)
        keys = re.search(r"PARTITIONED\s+BY\s*\(([^)]*)\)", rest, re.I)
        catalog, database, name = where
        ddl.create_table(catalog, database, name, types.parse_columns(head), options_of(next(filter(None, given.groups()), "")) if given else None, [k.strip() for k in keys[1].split(",")] if keys else None)
        return done()
    rules = (
        (r"INSERT\s+(?:INTO|OVERWRITE)\s+(?:TABLE\s+)?", "INSERT"), (r"DELETE\s+FROM\s+", "DELETE"), (r"UPDATE\s+", "UPDATE"), (r"MERGE\s+INTO\s+", "MERGE"), (r"TRUNCATE\s+(?:TABLE\s+)?", "TRUNCATE"),
        (r"DROP\s+(?:TABLE|VIEW|SCHEMA|DATABASE)\s+(?:IF\s+EXISTS\s+)?", "DROP"), (r"ALTER\s+(?:TABLE|VIEW)\s+(?:IF\s+EXISTS\s+)?", "ALTER"),
        (r"CREATE\s+(?:OR\s+REPLACE\s+)?(?:SCHEMA|DATABASE|VIEW|(?:TABLE\s+|PRAGMA\s+)?FUNCTION|MACRO|TYPE|SEQUENCE|INDEX|COLLATION)\s+(?:IF\s+NOT\s+EXISTS\s+)?(?:[\w$]+\s+ON\s+)?", "CREATE"), (r"COPY\s+", "COPY"),
    )
    for pattern, what in rules:
        m = re.match(rf"{pattern}({_NAME})", sql, re.I)
        if m and parts_of(m[1])[0] in engine.catalogs:
            raise NotImplementedInCatalog(f"attached catalogs do not support {what}: {m[1]}")
    return None


# ---------------------------------------------------------------- text
_PIECES = re.compile(r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|`(?:[^`]|``)*`|--[^\n]*|/\*.*?\*/""", re.S)


def without_comments(text: str) -> str:
    """text with a blank for each comment that isn't a hint."""
    return _PIECES.sub(lambda m: " " if m[0].startswith(("--", "/*")) and not m[0].startswith("/*+") else m[0], text)


def quoted_names(text: str) -> str:
    """text of the same length whose double-quoted parts beside a dot, which can't be strings, are names as Spark writes them."""

    def name(m: re.Match) -> str:
        beside = text[: m.start()].rstrip().endswith(".") or text[m.end() :].lstrip().startswith(".")
        plain = m[0].startswith('"') and beside and not any(c in m[0][1:-1] for c in '"`')
        return f"`{m[0][1:-1]}`" if plain else m[0]

    return _PIECES.sub(name, text)


# ---------------------------------------------------------------- names in a query
class Names:
    """The relations and qualified columns that a text names, by Spark's own parser.

    relations: (start, stop, name, whether it has an alias); what a WITH binds is none. columns: (start, stop, name).
    """

    def __init__(self, spark, text: str):
        self.relations: dict[tuple[int, int], tuple[list[str], bool]] = {}
        self.columns: dict[tuple[int, int], list[str]] = {}
        self._subquery = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.expressions.SubqueryExpression", True, spark._jvm.java.lang.Thread.currentThread().getContextClassLoader())
        self._walk(spark._jsparkSession.sessionState().sqlParser().parsePlan(text), False, frozenset())

    def _walk(self, node, aliased: bool, bound: frozenset[str]) -> None:
        kind = node.getClass().getSimpleName()
        if kind == "UnresolvedWith":
            given = node.cteRelations()
            for i in range(given.size()):
                name, plan = given.apply(i)._1().casefold(), given.apply(i)._2()
                self._walk(plan, False, bound | {name} if node.allowRecursion() else bound)
                bound |= {name}
            self._walk(node.child(), False, bound)
            return
        if kind == "UnresolvedRelation":
            name = _strings(node.multipartIdentifier())
            if len(name) > 1 or name[0].casefold() not in bound:
                self.relations[_span(node)] = name, aliased
        for kids in (node.children(), node.innerChildren()):
            for i in range(kids.size()):
                if kids.apply(i).getClass().getName().startswith("org.apache.spark.sql.catalyst.") and hasattr(kids.apply(i), "expressions"):
                    self._walk(kids.apply(i), kind == "SubqueryAlias", bound)
        found = node.expressions()
        for i in range(found.size()):
            self._expression(found.apply(i), bound)

    def _expression(self, e, bound: frozenset[str]) -> None:
        kind = e.getClass().getSimpleName()
        if kind == "UnresolvedAttribute" and e.origin().startIndex().isDefined():
            self.columns[_span(e)] = _strings(e.nameParts())
        elif kind == "UnresolvedStar" and e.target().isDefined() and e.origin().startIndex().isDefined():
            self.columns[_span(e)] = [*_strings(e.target().get()), "*"]
        if self._subquery.isInstance(e):
            self._walk(e.plan(), False, bound)
        kids = e.children()
        for i in range(kids.size()):
            self._expression(kids.apply(i), bound)


def _span(node) -> tuple[int, int]:
    return node.origin().startIndex().get(), node.origin().stopIndex().get()


def _strings(parts) -> list[str]:
    return [parts.apply(i) for i in range(parts.size())]


def query(engine, text: str) -> DataFrame:
    """A query, its catalogued tables replaced by views of their DataFrames; the views last until the query is analysed."""
    text = quoted_names(text.strip().rstrip(";"))
    if not engine.catalogs:
        return engine.spark.sql(text)
    names = Names(engine.spark, text)
    edits: list[tuple[int, int, str]] = []
    views: list[str] = []
    replaced: list[list[str]] = []
    try:
        for (start, stop), (name, aliased) in names.relations.items():
            if (df := engine.relation(name)) is None:
                if len(name) > 1 and name[0] in engine.catalogs:
                    raise NotFound(f"no table {'.'.join(name)}")
                continue
            view = f"_metalake_{uuid.uuid4().hex}"
            df.createOrReplaceTempView(view)
            views.append(view)
            edits.append((start, stop, view + ("" if aliased else f" AS `{name[-1]}`")))
            if not aliased:
                where = engine.place(name)
                replaced.append([x.casefold() for x in ((where[0].name, *where[1:]) if where else name)])
        for (start, stop), name in names.columns.items():
            low = [x.casefold() for x in name]
            before = next((k for full in replaced for k in range(2, len(full) + 1) if len(low) > k and low[:k] == full[-k:]), 0)
            if before:  # the table's name alone stands for it
                edits.append((start, stop, ".".join(x if x == "*" else f"`{x}`" for x in name[before - 1 :])))
        for start, stop, new in sorted(edits, reverse=True):
            text = text[:start] + new + text[stop + 1 :]
        return engine.spark.sql(text)
    finally:
        for view in views:
            engine.spark.catalog.dropTempView(view)
