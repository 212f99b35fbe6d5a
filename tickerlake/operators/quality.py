"""Declarative data-quality checks.

Each check returns the DataFrame of *failing* rows (empty = pass), like a
test query.  ``quality_report`` evaluates many checks in few jobs: all
row-level checks on the same DataFrame are fused into one aggregate of
``count_if`` columns (one scan), grouped checks run as their own aggregates,
and everything is unioned into one small (check, failures, passed) table.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pred(expr) -> Column:
    return F.expr(expr) if isinstance(expr, str) else expr


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their count."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column combinations that occur more than once (NULLs included as values)."""
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str,
                  where=None) -> DataFrame:
    """Child rows whose non-NULL key is absent from the parent.

    Scale: the missing keys are found first, from the distinct child keys (a
    hot key is one row for each task there), and only they are joined back to
    the rows.  That join carries one more key, a hash of the key, which
    nothing before it is partitioned by: both sides get an exchange of their
    own, so AQE can broadcast few missing keys or split a hot orphan.
    """
    c = (child if where is None else child.where(_pred(where))).where(F.col(column).isNotNull())
    keys = c.select(F.col(column).alias("_key")).distinct()
    parents = parent.select(F.col(parent_column).alias("_parent_key"))
    missing = keys.join(parents, F.col("_key") == F.col("_parent_key"), "left_anti").withColumn("_hash", F.xxhash64("_key"))
    rows = c.withColumn("_child_hash", F.xxhash64(column))
    return (rows.join(missing, (F.col(column) == F.col("_key")) & (F.col("_child_hash") == F.col("_hash")))
            .select(*[F.col(f"`{x}`") for x in child.columns]))


def expression_is_true(df: DataFrame, expression, where=None) -> DataFrame:
    """Rows where ``expression`` is FALSE; NULL results pass."""
    d = df if where is None else df.where(_pred(where))
    return d.where(~_pred(expression))


@dataclass(frozen=True)
class Check:
    """One declared check.  ``kind``: not_null | unique | unique_combination |
    relationships | expression_is_true."""

    name: str
    table: str
    kind: str
    column: str | None = None
    columns: tuple[str, ...] = ()
    expression: str | None = None
    where: str | None = None
    parent: str | None = None
    parent_column: str | None = None

    def row_condition(self) -> Column | None:
        """Per-row failure condition for fusable checks, else None."""
        if self.kind == "not_null":
            return F.col(self.column).isNull()
        if self.kind == "expression_is_true":
            cond = ~_pred(self.expression)
            if self.where:
                cond = _pred(self.where) & cond
            return F.coalesce(cond, F.lit(False))
        return None

    def failure_count(self, tables: dict[str, DataFrame]) -> DataFrame:
        """One row, one column ``failures``: the number of failing rows."""
        if self.kind == "relationships":
            # count per child key first (partial aggregation collapses a hot key),
            # then anti-join distinct keys only
            child = tables[self.table] if self.where is None else tables[self.table].where(_pred(self.where))
            keys = (child.where(F.col(self.column).isNotNull())
                    .groupBy(F.col(self.column).alias("_k")).agg(F.count(F.lit(1)).alias("_n")))
            parent = tables[self.parent].select(F.col(self.parent_column).alias("_p")).distinct()
            missing = keys.join(parent, F.col("_k") == F.col("_p"), "left_anti")
            return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures"))
        return self.failures(tables).agg(F.count(F.lit(1)).alias("failures"))

    def failures(self, tables: dict[str, DataFrame]) -> DataFrame:
        df = tables[self.table]
        if self.kind == "not_null":
            return not_null(df, self.column)
        if self.kind == "unique":
            return unique(df, self.column)
        if self.kind == "unique_combination":
            return unique_combination(df, self.columns)
        if self.kind == "relationships":
            return relationships(df, self.column, tables[self.parent], self.parent_column, self.where)
        if self.kind == "expression_is_true":
            return expression_is_true(df, self.expression, self.where)
        raise ValueError(f"unknown check kind {self.kind!r}")


def _unique_failure(check: Check) -> Column:
    """Failure condition of a key group (``_n`` rows) in the fused aggregate."""
    if check.kind == "unique":
        return F.col(check.column).isNotNull() & (F.col("_n") > 1)
    return F.col("_n") > 1


def _fusable_relationship(check: Check, key: list[str]) -> bool:
    """A relationships check on the fused aggregate's single key column."""
    trivial_where = (None, f"{check.column} is not null")
    return (check.kind == "relationships" and key == [check.column]
            and (check.where or None) in trivial_where)


def quality_report(checks: Sequence[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """(check_name, table, failures, passed) for every check.

    Per table, the row-level checks, one uniqueness check and relationship
    checks on that same key share a single two-level aggregate: rows are
    grouped by the key (partial aggregation, so a hot duplicate key costs one
    row per task) with per-group failure counts; the groups (one row per key)
    are joined to the parents' distinct keys and summed.  Other grouped checks
    and relationships run as their own aggregates.
    """
    parts: list[DataFrame] = []
    by_table: dict[str, tuple[list[Check], list[Check], list[Check]]] = {}
    others: list[Check] = []
    for c in checks:
        rows, uniques, _ = by_table.setdefault(c.table, ([], [], []))
        if c.row_condition() is not None:
            rows.append(c)
        elif c.kind in ("unique", "unique_combination") and not uniques:
            uniques.append(c)
        else:
            others.append(c)
    for c in others:  # relationships on the unique key ride on the fused aggregate
        rows, uniques, rels = by_table[c.table]
        u = uniques[0] if uniques else None
        key = ([u.column] if u.kind == "unique" else list(u.columns)) if u else []
        if u is not None and _fusable_relationship(c, key):
            rels.append(c)
        else:
            parts.append(c.failure_count(tables)
                         .select(F.lit(c.name).alias("check_name"), F.lit(c.table).alias("table"), "failures"))
    for table, (rows, uniques, rels) in by_table.items():
        if not rows and not uniques:
            continue
        df = tables[table]
        row_counts = [F.count_if(c.row_condition()).alias(f"c{i}") for i, c in enumerate(rows)]
        pairs = [(c.name, f"c{i}") for i, c in enumerate(rows)]
        if uniques:
            u = uniques[0]
            keys = [u.column] if u.kind == "unique" else list(u.columns)
            groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *row_counts)
            rel_counts = []
            for j, r in enumerate(rels):
                parent = tables[r.parent].select(F.col(r.parent_column).alias(f"_p{j}")).distinct()
                groups = groups.join(parent, F.col(r.column) == F.col(f"_p{j}"), "left")
                missing = F.col(r.column).isNotNull() & F.col(f"_p{j}").isNull()
                rel_counts.append(F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0)).alias(f"r{j}"))
            counts = groups.agg(*[F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in range(len(rows))],
                                F.count_if(_unique_failure(u)).alias("u0"), *rel_counts)
            pairs += [(u.name, "u0")] + [(r.name, f"r{j}") for j, r in enumerate(rels)]
        else:
            counts = df.agg(*row_counts)
        stack = F.expr("stack({n}, {pairs}) AS (check_name, failures)".format(
            n=len(pairs), pairs=", ".join(f"'{name}', CAST({col} AS BIGINT)" for name, col in pairs)))
        parts.append(counts.select(stack).select("check_name", F.lit(table).alias("table"), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("failures", F.col("failures").cast("bigint")) \
        .withColumn("passed", F.col("failures") == 0)


class QualityError(RuntimeError):
    pass


def assert_quality(report: DataFrame) -> None:
    """Raise when any check failed (collects the small report only)."""
    failed = [r for r in report.where(~F.col("passed")).collect()]
    if failed:
        msg = ", ".join(f"{r.check_name}={r.failures}" for r in failed)
        raise QualityError(f"{len(failed)} data-quality check(s) failed: {msg}")


def standard_checks() -> list[Check]:
    """The 33 checks declared on the silver and gold datasets."""
    C = Check
    return [
        # silver board (7)
        C("stg_board.id.unique", "stg_board", "unique", column="id"),
        C("stg_board.id.not_null", "stg_board", "not_null", column="id"),
        C("stg_board.symbol.not_null", "stg_board", "not_null", column="symbol"),
        C("stg_board.fetched_at.not_null", "stg_board", "not_null", column="fetched_at"),
        C("stg_board.current_price.positive", "stg_board", "expression_is_true",
          expression="current_price > 0", where="current_price is not null"),
        C("stg_board.change_pct.range", "stg_board", "expression_is_true",
          expression="change_pct between -50 and 50", where="change_pct is not null"),
        C("stg_board.volume.non_negative", "stg_board", "expression_is_true",
          expression="volume >= 0", where="volume is not null"),
        # silver bars (5)
        C("stg_bars.symbol.not_null", "stg_bars", "not_null", column="symbol"),
        C("stg_bars.price_date.not_null", "stg_bars", "not_null", column="price_date"),
        C("stg_bars.close.not_null", "stg_bars", "not_null", column="close"),
        C("stg_bars.volume.non_negative", "stg_bars", "expression_is_true",
          expression="volume >= 0", where="volume is not null"),
        C("stg_bars.symbol_price_date.unique", "stg_bars", "unique_combination",
          columns=("symbol", "price_date")),
        # portfolio snapshot (10)
        C("snapshot.symbol.unique", "portfolio_snapshot", "unique", column="symbol"),
        C("snapshot.symbol.not_null", "portfolio_snapshot", "not_null", column="symbol"),
        C("snapshot.symbol.in_holdings", "portfolio_snapshot", "relationships", column="symbol",
          parent="holdings", parent_column="symbol", where="symbol is not null"),
        C("snapshot.qty_held.not_null", "portfolio_snapshot", "not_null", column="qty_held"),
        C("snapshot.qty_held.positive", "portfolio_snapshot", "expression_is_true", expression="qty_held > 0"),
        C("snapshot.avg_buy_rate.not_null", "portfolio_snapshot", "not_null", column="avg_buy_rate"),
        C("snapshot.avg_buy_rate.positive", "portfolio_snapshot", "expression_is_true",
          expression="avg_buy_rate > 0"),
        C("snapshot.total_cost.not_null", "portfolio_snapshot", "not_null", column="total_cost"),
        C("snapshot.total_cost.positive", "portfolio_snapshot", "expression_is_true", expression="total_cost > 0"),
        C("snapshot.unrealized_pct.range", "portfolio_snapshot", "expression_is_true",
          expression="unrealized_pct between -100 and 1000", where="unrealized_pct is not null"),
        # portfolio summary (8)
        C("summary.price_date.unique", "portfolio_summary", "unique", column="price_date"),
        C("summary.price_date.not_null", "portfolio_summary", "not_null", column="price_date"),
        C("summary.total_invested.not_null", "portfolio_summary", "not_null", column="total_invested"),
        C("summary.total_invested.positive", "portfolio_summary", "expression_is_true",
          expression="total_invested > 0"),
        C("summary.total_current_value.not_null", "portfolio_summary", "not_null", column="total_current_value"),
        C("summary.total_current_value.positive", "portfolio_summary", "expression_is_true",
          expression="total_current_value > 0"),
        C("summary.holdings_count.not_null", "portfolio_summary", "not_null", column="holdings_count"),
        C("summary.holdings_count.positive", "portfolio_summary", "expression_is_true",
          expression="holdings_count > 0"),
        # technical indicators (3)
        C("indicators.symbol.unique", "technical_indicators", "unique", column="symbol"),
        C("indicators.symbol.not_null", "technical_indicators", "not_null", column="symbol"),
        C("indicators.close.not_null", "technical_indicators", "not_null", column="close"),
    ]
