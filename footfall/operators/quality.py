"""Data-quality checks: each counts the rows that break a rule; zero passes."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMN_CHECKS = {"not_null", "unique", "accepted_values", "relationships"}
MODEL_CHECKS = {"unique_combination", "assert_expression"}


@dataclass(frozen=True)
class Check:
    """One declared rule. Column checks name a column, model checks do not."""

    model: str
    kind: str
    column: str | None = None
    values: tuple[str, ...] = ()
    columns: tuple[str, ...] = ()
    parent: str | None = None
    parent_column: str | None = None
    expression: str | None = None

    def __post_init__(self) -> None:
        if self.kind not in COLUMN_CHECKS | MODEL_CHECKS:
            raise ValueError(f"unknown check {self.kind!r}")
        if (self.kind in COLUMN_CHECKS) != (self.column is not None):
            raise ValueError(f"{self.model}: {self.kind} has a column, or lacks one, wrongly")
        if self.kind == "accepted_values" and not self.values:
            raise ValueError(f"{self.model}.{self.column}: accepted_values needs values")
        if self.kind == "relationships" and not (self.parent and self.parent_column):
            raise ValueError(f"{self.model}.{self.column}: relationships needs a parent column")
        if self.kind == "unique_combination" and len(self.columns) < 2:
            raise ValueError(f"{self.model}: unique_combination needs two columns or more")
        if self.kind == "assert_expression" and not (self.expression or "").strip():
            raise ValueError(f"{self.model}: assert_expression needs an expression")


# --- the six rules ----------------------------------------------------------


def _is_null(column: str) -> Column:
    return F.col(column).isNull()


def _not_accepted(column: str, values: Iterable[str]) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).cast("string").isin(list(values))


def _not_true(expression: str) -> Column:
    """False and null both break an assertion."""
    return ~F.coalesce(F.expr(f"({expression})"), F.lit(False))


def _count(df: DataFrame, broken: Column) -> DataFrame:
    return df.agg(F.count_if(broken).alias("failing_rows"))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return _count(df, _is_null(column))


def accepted_values(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Non-null values outside the list, compared as text."""
    return _count(df, _not_accepted(column, values))


def assert_expression(df: DataFrame, expression: str) -> DataFrame:
    return _count(df, _not_true(expression))


def _surplus(counts: DataFrame) -> DataFrame:
    """Copies beyond the first: three equal keys are two broken rows."""
    return counts.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("failing_rows"))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Surplus rows per value; nulls are left to not_null."""
    keyed = df.where(F.col(column).isNotNull())
    return _surplus(keyed.groupBy(column).agg(F.count("*").alias("_copies")))


def unique_combination(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Surplus rows per compound key; nulls count as equal."""
    return _surplus(df.groupBy(*columns).agg(F.count("*").alias("_copies")))


def relationships(df: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Non-null children without a parent. Children are counted per value before the
    anti join, and parents are made distinct, so one value held by very many rows joins once."""
    children = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_key"))
        .agg(F.count("*").alias("_copies"))
    )
    parents = parent.select(F.col(field).alias("_key")).distinct()
    orphans = children.join(parents, "_key", "left_anti")
    return orphans.agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("failing_rows"))


# --- running a suite --------------------------------------------------------


@dataclass
class Suite:
    """A list of checks against named relations; `select` keeps only some models."""

    relations: dict[str, DataFrame]
    checks: list[Check]
    select: list[str] | None = None
    _chosen: list[tuple[int, Check]] = field(init=False)

    def __post_init__(self) -> None:
        wanted = None if self.select is None else set(self.select)
        self._chosen = [
            (i, c) for i, c in enumerate(self.checks) if wanted is None or c.model in wanted
        ]

    def results(self) -> DataFrame:
        """All results as one lazy relation; a rule that cannot be planned is an error.

        Per model, the rules that look at single rows share one scan.
        """
        spark = SparkSession.active()
        parts, errors = [], []
        shared: dict[str, list[tuple[int, Check, Column]]] = {}
        for place, check in self._chosen:
            try:
                broken = _row_rule(check)
                if broken is None:
                    parts.append(_labelled(self._single(check), place))
                else:
                    self._relation(check.model).select(broken)
                    shared.setdefault(check.model, []).append((place, check, broken))
            except (PySparkException, LookupError) as problem:
                errors.append((place, f"{type(problem).__name__}: {problem}"))
        for model, rules in shared.items():
            one_row = self._relation(model).agg(
                *[F.count_if(broken).alias(f"r{place}") for place, _, broken in rules]
            )
            pairs = [
                F.struct(F.lit(place).alias("place"), F.col(f"r{place}").alias("failing_rows"))
                for place, _, _ in rules
            ]
            parts.append(one_row.select(F.inline(F.array(*pairs))))
        parts = [p.withColumn("error", F.lit(None).cast("string")) for p in parts]
        if errors or not parts:
            failed = spark.createDataFrame(errors, "place INT, error STRING")
            parts.append(
                failed.select("place", F.lit(None).cast("bigint").alias("failing_rows"), "error")
            )
        return self._described(reduce(DataFrame.unionByName, parts))

    def run(self) -> DataFrame:
        """Results as one small row per check, evaluated now, model by model.

        If a rule fails while running, the rules of its model are run one by one, so
        only that one is reported as an error and the rest keep their results.
        """
        rows = []
        for model in dict.fromkeys(c.model for _, c in self._chosen):
            alone = Suite(self.relations, self.checks, [model])
            try:
                rows += alone.results().collect()
            except PySparkException:
                for _, check in alone._chosen:
                    rows.append(Suite(self.relations, [check])._one())
        schema = (
            "model_name STRING, column_name STRING, test_name STRING, status STRING, "
            "failing_rows BIGINT, error STRING"
        )
        return SparkSession.active().createDataFrame(rows, schema)

    def _one(self) -> tuple:
        try:
            return tuple(self.results().first())
        except PySparkException as problem:
            check = self.checks[0]
            reason = f"{type(problem).__name__}: {problem}"
            return (check.model, check.column, check.kind, "error", None, reason)

    def _relation(self, name: str) -> DataFrame:
        if name not in self.relations:
            raise LookupError(f"relation {name} is not built")
        return self.relations[name]

    def _single(self, check: Check) -> DataFrame:
        df = self._relation(check.model)
        if check.kind == "unique":
            return unique(df, check.column)
        if check.kind == "unique_combination":
            return unique_combination(df, check.columns)
        return relationships(
            df, check.column, self._relation(check.parent), check.parent_column
        )

    def _described(self, results: DataFrame) -> DataFrame:
        """Adds names and status; the list of checks is as small as its source text."""
        names = F.array(*[_names(check) for check in self.checks])
        status = (
            F.when(F.col("error").isNotNull(), "error")
            .when(F.col("failing_rows") == 0, "pass")
            .otherwise("fail")
        )
        named = results.withColumn("names", F.element_at(names, F.col("place") + 1))
        return named.select("names.*", status.alias("status"), "failing_rows", "error")


def _row_rule(check: Check) -> Column | None:
    if check.kind == "not_null":
        return _is_null(check.column)
    if check.kind == "accepted_values":
        return _not_accepted(check.column, check.values)
    if check.kind == "assert_expression":
        return _not_true(check.expression)
    return None


def _labelled(one_row: DataFrame, place: int) -> DataFrame:
    return one_row.select(F.lit(place).alias("place"), F.col("failing_rows").cast("bigint"))


def _names(check: Check) -> Column:
    return F.struct(
        F.lit(check.model).alias("model_name"),
        F.lit(check.column).cast("string").alias("column_name"),
        F.lit(check.kind).alias("test_name"),
    )
