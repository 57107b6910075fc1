"""Ad-hoc SQL for readers: one query, over allowed schemas only, checked on Spark's own plans, parsed and then analysed.

The parsed plan shows what a query asks for: only reading nodes, listed functions, and tables that are named with their schema or
stand for a common table expression in whose scope they are. Analysis says what that has become: every expression must then be of
a listed class, which for functions are the classes that Spark's registry has under the listed names, and every relation must be a
catalog table or view of an allowed schema, whatever it was called. Last, how large a single value can get is reckoned from the
literals in a query, so that a short query cannot ask for gigabytes.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from ..operators.serve import capped

# Logical operators that a reader's query may have.
READ_NODES = set(
    "Project Filter Aggregate Sort GlobalLimit LocalLimit Limit Offset Distinct Join LateralJoin SubqueryAlias UnresolvedRelation UnresolvedSubqueryColumnAliases UnresolvedWith UnresolvedHaving Union Intersect Except With WithWindowDefinition OneRowRelation UnresolvedInlineTable Generate Pivot UnresolvedPivot Unpivot Tail Sample LocalRelation Window CTERelationDef CTERelationRef WithCTE GroupingSets UnresolvedOrdinal".split()
)


# Functions that a reader's query may call; none reaches beyond the rows it is given.
FUNCTIONS = set(
    "abs acos add_months any any_value approx_count_distinct approx_percentile array array_agg array_contains array_distinct array_join array_max array_min array_position array_size array_sort ascii asin atan atan2 avg between bigint bool_and bool_or boolean cardinality cast ceil ceiling char_length character_length coalesce collect_list collect_set concat concat_ws contains corr cos count count_if covar_pop covar_samp cume_dist current_date current_timestamp date date_add date_diff date_format date_part date_sub date_trunc datediff day dayofmonth dayofweek dayofyear decimal dense_rank double element_at endswith every exists exp explode extract filter first first_value flatten float floor format_number from_unixtime get greatest grouping grouping_id hour if ifnull in initcap instr int isnotnull isnull kurtosis lag last last_day last_value lcase lead least left length like ln locate log log10 log2 lower lpad ltrim make_date map map_contains_key map_keys map_values max max_by mean median min min_by minute mod mode month months_between named_struct not now nth_value ntile nullif nvl nvl2 percent_rank percentile percentile_approx pmod posexplode position pow power quarter rank regexp_count regexp_extract regexp_like regexp_replace repeat replace reverse right rint rlike round row_number rpad rtrim second sequence sign sin size skewness slice some sort_array split split_part sqrt startswith std stddev stddev_pop stddev_samp string struct substr substring substring_index sum tan timestamp to_char to_date to_timestamp transform translate trim trunc try_add try_cast try_divide try_subtract try_to_timestamp ucase unix_timestamp upper var_pop var_samp variance weekofyear when year zip_with".split()
)


# Logical operators of an analysed query.
ANALYSED_NODES = READ_NODES | {"Expand", "View", "LogicalRelation", "HiveTableRelation", "DataSourceV2Relation", "RelationV2"}

# Operators of the language, whose classes the registry knows.
OPERATORS = set("+ - * / % = == <=> < <= > >= and or not in between & | ^ ~ div like ilike rlike".split())

# Classes that analysis puts in place of syntax or of functions that it builds otherwise.
EXPRESSIONS = set(
    "AggregateExpression Alias ArrayExcept AttributeReference BinaryContains BinaryPad Ceil Contains CreateNamedStruct CurrentRow$ DateAddInterval DateAddYMInterval DatetimeSub DayTimeIntervalLiteral DivideDTInterval DivideYMInterval EndsWith EulerNumber Exists Explode Floor GetArrayItem GetArrayStructFields GetMapValue GetStructField Hour ILike InSubquery IntegralDivide LambdaFunction ListQuery Literal Minute Mode MultiplyDTInterval MultiplyYMInterval NamedLambdaVariable OuterReference ParseToTimestamp PivotFirst PosExplode RoundCeil RoundFloor ScalarSubquery Second ShiftRight SortOrder SpecifiedWindowFrame StartsWith StringLPad StringRPad SubtractDates SubtractTimestamps TimestampAdd TimestampAddInterval TimestampAddYMInterval TimestampDiff ToCharacter TryEval UnaryMinus UnaryPositive UnboundedFollowing$ UnboundedPreceding$ UnspecifiedFrame$ WindowExpression WindowSpecDefinition".split()
)

# Functions whose values may be far larger than what they are given, and their classes.
GROWING = {"repeat": "StringRepeat", "lpad": "StringLPad", "rpad": "StringRPad", "sequence": "Sequence", "replace": "StringReplace", "regexp_replace": "RegExpReplace", "transform": "ArrayTransform", "zip_with": "ZipWith"}

#: Characters or elements that one value of a query may have by its literals, and what a column's value counts as.
MOST_SIZE, COLUMN_SIZE = 10_000_000, 1_000


class SqlRejected(ValueError):
    """Not one read-only query over allowed tables."""


def _seq(found) -> list:
    return [found.apply(i) for i in range(found.size())]


def _parts(plan, kinds=("children", "innerChildren", "subqueries")) -> list:
    """The plans right below a plan, those in its subqueries and common table expressions included."""
    out = []
    for kind in kinds:
        try:
            found = _seq(getattr(plan, kind)())
        except Exception:  # noqa: BLE001, S112 - not every node has them
            continue
        out += [x for x in found if hasattr(x, "nodeName")]
    return out


def _walk(plan):
    """A plan's nodes, those in its subqueries and common table expressions included."""
    yield plan
    for child in _parts(plan):
        yield from _walk(child)


def _kind(expression) -> str:
    return expression.getClass().getSimpleName()


def _under(expression) -> list:
    """What an expression is made of: where Spark replaces it by others, what it was given."""
    try:
        return _seq(expression.parameters())
    except Exception:  # noqa: BLE001 - only some have them
        return _seq(expression.children())


def _asked(node):
    """Names of the functions that a parsed node's expressions call."""
    held = _seq(node.expressions())
    while held:
        e = held.pop()
        kind = _kind(e)
        if "UnresolvedIdentifier" in kind:
            raise SqlRejected("names must be written out, not computed")
        if kind == "UnresolvedFunction":
            yield ".".join(p.lower() for p in _seq(e.nameParts()))
        elif kind == "UnresolvedGenerator":
            yield e.name().unquotedString().lower()
        held += _seq(e.children())


def _unqualified(plan, known: frozenset[str]):
    """Names without a schema that stand for no common table expression in whose scope they are."""
    kind = plan.nodeName()
    if kind == "UnresolvedRelation":
        parts = _seq(plan.multipartIdentifier())
        if len(parts) == 1 and parts[0].lower() not in known:
            yield parts[0]
        return
    if kind == "UnresolvedWith":
        for cte in _seq(plan.cteRelations()):
            name = cte._1().lower()
            yield from _unqualified(cte._2(), known | {name} if plan.allowRecursion() else known)
            known = known | {name}
        yield from _unqualified(plan.child(), known)
        return
    for child in _parts(plan):
        yield from _unqualified(child, known)


@cache
def _classes(jvm_registry) -> frozenset[str]:
    """Classes of the listed functions and operators, as Spark's registry has them."""
    found = (jvm_registry.get(name) for name in FUNCTIONS | OPERATORS)
    return EXPRESSIONS | {x.get()._1().getClassName().rpartition(".")[2] for x in found if x.isDefined()}


def _number(expression) -> int:
    """The value of an integer or date literal, perhaps cast; anything else is refused."""
    if _kind(expression) == "Cast":
        return _number(expression.child())
    if _kind(expression) == "UnaryMinus":
        return -_number(expression.child())
    if _kind(expression) == "Literal" and expression.dataType().simpleString() in ("tinyint", "smallint", "int", "bigint", "date"):
        return int(expression.value())
    raise SqlRejected("sizes must be literal integers, and ranges lie between literal integers or dates")


def _size(expression) -> int:
    """Characters or elements that a value may have, reckoned from literals; SqlRejected beyond MOST_SIZE. Parsed expressions
    count as analysed ones do: analysis itself works some of them out, such as rows of VALUES and limits."""
    kind, under = _kind(expression), _under(expression)
    if kind == "UnresolvedFunction":
        kind = GROWING.get(expression.nameParts().last().lower(), kind)
    if kind == "Literal":
        return len(str(expression.value()))
    if kind == "Sequence":
        if len(under) not in (2, 3):
            raise SqlRejected("a range has two ends, and may have a step")
        low, high = _number(under[0]), _number(under[1])
        by_number = len(under) == 3 and _kind(under[2]) == "Literal" and under[2].dataType().simpleString() in ("tinyint", "smallint", "int", "bigint")
        size = abs(high - low) // (max(1, abs(_number(under[2]))) if by_number else 1) + 1
    else:
        sizes = [_size(x) for x in under]
        if kind in GROWING.values() and len(sizes) < 2:
            raise SqlRejected(f"{kind} lacks arguments")
        if kind == "StringRepeat":
            size = sizes[0] * max(1, _number(under[1]))
        elif kind in ("StringLPad", "StringRPad", "BinaryPad"):
            size = max(sizes[0], _number(under[1]))
        elif kind in ("StringReplace", "RegExpReplace"):
            size = sizes[0] * (1 + sum(sizes[2:3]))
        elif kind == "StringTranslate":
            size = sizes[0]
        elif kind in ("ArrayTransform", "ZipWith"):
            size = max(sizes[:-1]) * sizes[-1]
        else:
            size = sum(sizes) if sizes else COLUMN_SIZE
    if size > MOST_SIZE:
        raise SqlRejected(f"a value of this query may have {size} parts")
    return size


def _table(node) -> tuple[str | None, str] | None:
    """Schema and name of the catalog table or view that an analysed relation reads; None where it is neither."""
    kind = node.nodeName()
    if kind == "View":
        if node.isTempView():
            return None
        of = node.desc().identifier()
    elif kind == "HiveTableRelation":
        of = node.tableMeta().identifier()
    elif kind == "LogicalRelation":
        if not node.catalogTable().isDefined():
            return None
        of = node.catalogTable().get().identifier()
    else:
        if not (node.catalog().isDefined() and node.identifier().isDefined() and node.catalog().get().name() == "spark_catalog"):
            return None
        space = node.identifier().get().namespace()
        return (space[0], node.identifier().get().name()) if len(space) == 1 else None
    return (of.database().get() if of.database().isDefined() else None), of.table()


def _read(plan, schemas: set[str], allowed: frozenset[str], names: set[str]) -> None:
    """Check an analysed plan and gather the tables that it reads. What a view of an allowed schema reads is its owner's concern."""
    kind = plan.nodeName().split(" ")[0]
    if kind not in ANALYSED_NODES:
        raise SqlRejected(f"only queries are allowed ({kind} found)")
    if kind in ("View", "LogicalRelation", "HiveTableRelation", "DataSourceV2Relation", "RelationV2"):
        found = _table(plan)
        if found is None or (found[0] or "").lower() not in schemas:
            raise SqlRejected(f"only tables of {', '.join(sorted(schemas))} are available")
        names.add(".".join(found).lower())
        return
    held = _seq(plan.expressions())
    for e in held:
        _size(e)
    while held:
        e = held.pop()
        if _kind(e) not in allowed:
            raise SqlRejected(f"{_kind(e)} is not allowed")
        held += _under(e)
    for child in _parts(plan):
        _read(child, schemas, allowed, names)


def _checked(spark: SparkSession, sql: str, schemas: set[str]) -> tuple[DataFrame, list[str]]:
    if not sql or not sql.strip():
        raise SqlRejected("empty query")
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except Exception as e:
        raise SqlRejected(f"not one SQL query: {str(e).splitlines()[0][:200]}") from e
    for node in _walk(plan):
        kind = node.nodeName()
        if kind not in READ_NODES:
            raise SqlRejected(f"only queries are allowed ({kind} found)")
        if kind == "UnresolvedRelation":
            parts = [p.lower() for p in _seq(node.multipartIdentifier())]
            if len(parts) > 2 or len(parts) == 2 and (parts[0] not in schemas or not re.fullmatch(r"\w+", parts[1])):
                raise SqlRejected(f"only schemas {', '.join(sorted(schemas))} are available, not {'.'.join(parts[:-1])!r}")
        for e in _seq(node.expressions()):
            _size(e)
        for name in _asked(node):
            if name not in FUNCTIONS:
                raise SqlRejected(f"function {name!r} is not allowed")
    for name in _unqualified(plan, frozenset()):
        raise SqlRejected(f"qualify table {name!r} with its schema")
    try:
        df = spark.sql(sql)
        analysed = df._jdf.queryExecution().analyzed()
    except Exception as e:
        raise SqlRejected(f"not a query that can run: {str(e).splitlines()[0][:200]}") from e
    names: set[str] = set()
    _read(analysed, schemas, _classes(spark._jvm.org.apache.spark.sql.catalyst.analysis.FunctionRegistry.expressions()), names)
    return df, sorted(names)


def check_sql(spark: SparkSession, sql: str, schemas: set[str]) -> list[str]:
    """The schema.table names that a query reads; raises SqlRejected."""
    return _checked(spark, sql, schemas)[1]


def guarded_sql(spark: SparkSession, sql: str, schemas: set[str], max_rows: int = 1000) -> DataFrame:
    """At most ``max_rows`` rows of a checked query, and in ``truncated`` whether there were more; what was checked is what runs."""
    return capped(_checked(spark, sql, schemas)[0], max_rows)


def list_tables(spark: SparkSession, schema: str) -> list[tuple[str, str | None]]:
    return [(t.name, t.description) for t in spark.catalog.listTables(schema) if not t.isTemporary]


def describe(df: DataFrame, rows: int = 5) -> tuple[list[tuple[str, str]], DataFrame]:
    """Columns with their types, and a few sample rows."""
    return df.dtypes, df.limit(rows)
