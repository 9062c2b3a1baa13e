"""Which columns of which datasets Python sources use, and their SQL texts: files are rows, scanned in parallel, and facts are joined.

A file's uses belong to the datasets that the file names by subject, topic or path. Which calls take column names is read from
PySpark's own signatures.
"""

from __future__ import annotations

import ast
import inspect
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, DataFrameWriter, GroupedData, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import registry

FACTS = "consumer string, path string, line int, kind string, name string"
#: Identifiers, with what qualifies them and a bracket behind them; or what is quoted.
_NAMES = re.compile(r"`([^`]*)`|'([^']*)'|\"([^\"]*)\"|((?:[^\W\d]\w*\.)*[^\W\d]\w*)(\s*\()?")
#: Words of SQL that are never columns.
RESERVED = frozenset(
    "ALL AND ANTI ANY AS ASC BETWEEN BY CASE CAST CROSS CURRENT DELTA DESC DISTINCT ELSE END ESCAPE EXCEPT EXISTS FALSE FETCH FOLLOWING FOR FROM FULL GROUP HAVING ILIKE IN INNER INTERSECT INTERVAL INTO IS"
    " JOIN LATERAL LEFT LIKE LIMIT NATURAL NOT NULL OFFSET ON OR ORDER OUTER OVER PARQUET PARTITION PRECEDING RANGE RIGHT RLIKE ROWS SELECT SEMI SET THEN TRUE UNBOUNDED UNION USING WHEN WHERE WINDOW WITH".split()
)
_ALIAS = re.compile(r"\bas\s+(?:`([^`]+)`|([^\W\d]\w*))", re.IGNORECASE)
_ALL = re.compile(r"(?:^|,|\bselect)\s*(?:[^\W\d]\w*\.)?\*\s*(?:$|,|\bfrom\b)", re.IGNORECASE)


def _taking(owner, kind: str) -> set[str]:
    """Public functions of a class or module with a parameter of that kind."""
    out = set()
    for name, f in inspect.getmembers(owner, callable):
        if not name.startswith("_"):
            try:
                parameters = inspect.signature(f).parameters.values()
            except (TypeError, ValueError):
                continue
            if any(kind in str(p.annotation) for p in parameters):
                out.add(name)
    return out


METHODS = set().union(*(_taking(c, "ColumnOrName") for c in (DataFrame, DataFrameWriter, GroupedData, Window))) | {"drop_duplicates", "dropDuplicates", "partitionBy", "groupby", "groupBy", "orderBy", "sort", "select", "drop"}
FUNCTIONS = _taking(F, "ColumnOrName") | {"col", "column"}
#: Calls whose strings are SQL.
EXPRESSIONS = {"selectExpr", "expr", "filter", "where", "sql"}


def expression_names(text: str, reserved: frozenset[str] = RESERVED) -> tuple[list[str], list[str], bool, list[str]]:
    """Columns, aliases, whether all is selected, and quoted text of SQL."""
    defined = [a or b for a, b in _ALIAS.findall(text)]
    names, quoted = [], []
    for back, single, double, name, call in _NAMES.findall(text):
        if back or single or double:
            quoted.append(back or single or double)
        elif name and not call and name.upper() not in reserved and name not in defined:
            names.append(name)
    return names, defined, bool(_ALL.search(re.sub(r"'[^']*'", "", text))), quoted


def _text(node: ast.AST | None) -> str | None:
    return node.value if isinstance(node, ast.Constant) and isinstance(node.value, str) else None


def _unknown(node: ast.AST) -> bool:
    """Whether a name is made at run time."""
    if isinstance(node, ast.Starred):
        return not isinstance(node.value, ast.List | ast.Tuple)
    if isinstance(node, ast.BinOp):
        return isinstance(node.op, ast.Add | ast.Mod) and any(_text(x) is not None or isinstance(x, ast.JoinedStr) for x in (node.left, node.right))
    if isinstance(node, ast.Call):
        return isinstance(node.func, ast.Attribute) and node.func.attr in ("format", "join")
    return isinstance(node, ast.JoinedStr | ast.Name | ast.ListComp | ast.GeneratorExp)


class _Visitor(ast.NodeVisitor):
    def __init__(self):
        self.facts = []

    def add(self, line: int, kind: str, name: str = "") -> None:
        self.facts.append((line, kind, name))

    def sql(self, line: int, text: str) -> None:
        names, defined, all_, _ = expression_names(text)
        for kind, found in (("field", names), ("defined", defined)):
            for n in found:
                self.add(line, kind, n)
        if all_:
            self.add(line, "wildcard", "*")

    def visit_Call(self, node: ast.Call) -> None:
        name = node.func.attr if isinstance(node.func, ast.Attribute) else getattr(node.func, "id", "")
        first = _text(node.args[0]) if node.args else None
        if name == "from_avro":
            self.add(node.lineno, "from_avro")
        if name in ("alias", "withColumn") and first:
            self.add(node.lineno, "defined", first)
        elif name == "withColumnRenamed" and len(node.args) > 1:
            for a, kind in zip(node.args, ("field", "defined"), strict=False):
                if _text(a):
                    self.add(a.lineno, kind, _text(a))
        elif name == "sql" and first is not None:  # its columns are those of the tables it names: scopes.sql_uses()
            self.add(node.args[0].lineno, "sql", first)
        elif name in EXPRESSIONS:
            for a in node.args:
                if _text(a) is not None:
                    self.sql(a.lineno, _text(a))
                elif _unknown(a):
                    self.add(node.lineno, "dynamic")
        elif name in METHODS and isinstance(node.func, ast.Attribute) or name in FUNCTIONS:
            method = name in METHODS and not (isinstance(node.func, ast.Attribute) and isinstance(node.func.value, ast.Name) and node.func.value.id in ("F", "f", "functions", "fn"))
            for a in node.args:
                inner = a.value if isinstance(a, ast.Starred) else a
                for x in inner.elts if isinstance(inner, ast.List | ast.Tuple) else [a]:
                    if (n := _text(x)) is None:
                        if (method or name in ("col", "column")) and _unknown(x):
                            self.add(x.lineno, "dynamic")
                    elif n == "*" or n.endswith(".*"):
                        if method:
                            self.add(x.lineno, "wildcard", "*")
                    elif re.fullmatch(r"(?:[^\W\d]\w*\.)*[^\W\d]\w*", n):
                        self.add(x.lineno, "field", n)
        self.generic_visit(node)

    def visit_Subscript(self, node: ast.Subscript) -> None:
        if n := _text(node.slice):
            self.add(node.slice.lineno, "field", n)
        self.generic_visit(node)

    def visit_Constant(self, node: ast.Constant) -> None:
        if isinstance(node.value, str):
            self.add(node.lineno, "literal", node.value)


def facts_of(path: str, source: str) -> list[tuple[int, str, str]]:
    """(line, kind, name): field, defined, wildcard, dynamic, from_avro, literal, sql (a whole text, for scopes.sql_uses()); error for
    a file that can't be parsed."""
    if path.endswith(".sql"):
        quoted = [(i, "literal", n) for i, line in enumerate(source.splitlines(), 1) for n in expression_names(line.split("--")[0])[3]]
        return [*quoted, (1, "sql", source)]
    try:
        tree = ast.parse(source)
    except SyntaxError as e:
        return [(e.lineno or 0, "error", e.msg)]
    visitor = _Visitor()
    visitor.visit(tree)
    return visitor.facts


def scan(files: DataFrame) -> DataFrame:
    """consumer, path, line, kind, name from files (consumer, path, source); a null source has none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(c, p, *fact) for c, p, s in zip(pdf["consumer"], pdf["path"], pdf["source"], strict=True) if s is not None for fact in facts_of(p, s)]
            yield pd.DataFrame(rows, columns=["consumer", "path", "line", "kind", "name"])

    return files.select("consumer", "path", "source").mapInPandas(run, FACTS).distinct()


def references(facts: DataFrame, named: DataFrame) -> DataFrame:
    """consumer, path, line, dataset, kind (subject, topic, delta_path): where files name datasets (as in registry.references)."""
    literals = facts.where("kind = 'literal'").select(F.struct("consumer", "path", "line").alias("id"), F.col("name").alias("literal"))
    return registry.references(literals, named).select("id.consumer", "id.path", "id.line", "dataset", "kind").distinct()


def usage(facts: DataFrame, refs: DataFrame) -> DataFrame:
    """consumer, dataset, name, qualified, path, line: the columns used by Python files that name the dataset; name is `*` where a file
    selects all, null where it can't be told. Names that a file defines itself aren't columns of the dataset. SQL texts count in
    scopes.sql_usage(), which knows whose columns they are."""
    files = refs.select("consumer", "path", "dataset").distinct()
    defined = facts.where("kind = 'defined'").select("consumer", "path", "name").distinct()
    fields = facts.where("kind = 'field'").join(defined, ["consumer", "path", "name"], "left_anti")
    parts = F.split("name", r"\.")
    fields = fields.select("consumer", "path", "line", F.element_at(parts, -1).alias("name"), (F.size(parts) > 1).alias("qualified"))
    name: Column = F.when(F.col("kind") == "wildcard", "*")
    other = facts.where("kind in ('wildcard', 'dynamic')").select("consumer", "path", "line", name.alias("name"), F.lit(False).alias("qualified"))
    return fields.unionByName(other).join(files, ["consumer", "path"]).select("consumer", "dataset", "name", "qualified", "path", "line").distinct()


def sql_columns(spark: SparkSession, sql: str) -> set[str]:
    """Columns that an expression names, by Spark's own parser."""
    leaves = spark._jsparkSession.sessionState().sqlParser().parseExpression(sql).collectLeaves()
    found = (leaves.apply(i) for i in range(leaves.size()))
    return {x.name() for x in found if x.getClass().getSimpleName() == "UnresolvedAttribute"}
