"""Full build: silver views -> gold marts -> data-quality gate.

``build_all`` wires the marts in dependency order and returns them lazily;
``materialize`` writes them (full rebuild) and ``build_and_check`` runs the
33 declared checks on the result.  The silver board feeds four marts and is
stored once; it is small (one row per snapshot and symbol) but costly to
derive (a de-duplication over the whole raw board).  The portfolio snapshot
is stored for the same reason.  With an output folder, ``build_and_check`` goes
through ``publish``: marts go live only when their checks have passed.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tickerlake.operators import indicators as ind
from tickerlake.operators import market as mkt
from tickerlake.operators import portfolio as pf
from tickerlake.operators import quality as dq
from tickerlake.operators import staging as stg
from tickerlake.session import ensure_checkpoint_dir

INPUTS = ("board", "bars", "sector_map", "holdings", "trades", "tax")


def build_all(inputs: dict[str, DataFrame], share: str | None = "checkpoint") -> dict[str, DataFrame]:
    """All marts in dependency order.

    ``share`` decides how the silver board and the portfolio snapshot (each
    read by several marts) are shared: ``"checkpoint"`` writes them once to
    the session's shared checkpoint folder (cuts lineage, leaves nothing
    cached), ``"persist"`` caches them (the caller unpersists), ``None``
    recomputes them per reader.
    """
    missing = [k for k in INPUTS if k not in inputs]
    if missing:
        raise KeyError(f"missing inputs: {missing}")
    def shared(df: DataFrame) -> DataFrame:
        if share == "persist":
            return df.persist(StorageLevel.MEMORY_AND_DISK)
        if share == "checkpoint":
            ensure_checkpoint_dir(df.sparkSession)
            return df.checkpoint(eager=True)
        return df

    board = shared(stg.stage_board(inputs["board"]))
    bars = stg.stage_bars(inputs["bars"])
    snapshot = shared(pf.portfolio_snapshot(inputs["holdings"], board))
    return {"stg_board": board, "stg_bars": bars, **_gold(inputs, bars, board, snapshot)}


def _gold(inputs: dict[str, DataFrame], bars: DataFrame, board: DataFrame, snapshot: DataFrame,
          ordered: bool = False) -> dict[str, DataFrame]:
    """The gold marts, by name, from the silver tables and the snapshot.

    ``ordered``: by their declared sort keys, for marts that are written; the sort deals rows
    out by range, so the files of a mart hold ranges that do not overlap.
    """
    return {
        "top_movers": mkt.top_movers(board, ordered=ordered),
        "sector_summary": mkt.sector_summary(board, inputs["sector_map"], ordered=ordered),
        "technical_indicators": ind.technical_indicators(bars, ordered=ordered),
        "portfolio_snapshot": snapshot,
        "portfolio_summary": pf.portfolio_summary(snapshot),
        "portfolio_trades": pf.realized_trades(inputs["trades"]),
        "tax_summary": pf.tax_summary(inputs["tax"], ordered=ordered),
    }


GOLD = ("top_movers", "sector_summary", "technical_indicators", "portfolio_snapshot", "portfolio_summary",
        "portfolio_trades", "tax_summary")


def build_stored(inputs: dict[str, DataFrame], base_path: str,
                 names: tuple[str, ...] = GOLD) -> dict[str, DataFrame]:
    """The silver board and the marts in ``names``, each written under ``base_path`` and read back.

    Every mart is derived once, from the stored tables before it; nothing is
    cached and no reader depends on the build's lineage.
    """
    base, spark = base_path.rstrip("/"), inputs["board"].sparkSession

    def stored(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    silver = dict(inputs, bars=stored("stg_bars", stg.stage_bars(inputs["bars"])))
    board = stored("stg_board", stg.stage_board(inputs["board"]))
    snapshot = stored("portfolio_snapshot", pf.portfolio_snapshot(inputs["holdings"], board))
    marts = _gold(silver, silver["bars"], board, snapshot, ordered=True)
    out = {"stg_board": board, "stg_bars": silver["bars"]}
    for name in names:
        out[name] = snapshot if name == "portfolio_snapshot" else stored(name, marts[name])
    return out


def register_views(marts: dict[str, DataFrame]) -> None:
    """Expose every dataset by name for SQL users (lazy temp views)."""
    for name, df in marts.items():
        df.createOrReplaceTempView(name)


def create_view(spark: SparkSession, name: str, sql: str) -> None:
    """A persistent view: its text is kept by the catalog and read by name in every session on it."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")


def materialize(marts: dict[str, DataFrame], base_path: str, mode: str = "overwrite") -> None:
    """Write every gold mart (the silver ones stay views)."""
    for name, df in marts.items():
        if not name.startswith("stg_"):
            df.write.mode(mode).parquet(f"{base_path.rstrip('/')}/{name}")


def build_and_check(inputs: dict[str, DataFrame], base_path: str | None = None,
                    raise_on_failure: bool = True) -> DataFrame:
    """Build and evaluate the declared checks; raise on failure.

    With ``base_path`` the build is written to a version folder below it,
    checked there, and published only if every check passes (see
    ``publish``); readers of the version before are not disturbed.  Nothing
    stays cached.
    """
    if base_path is None:
        tables = dict(build_all(inputs), holdings=inputs["holdings"])
        report = dq.quality_report(dq.standard_checks(), tables)
        if raise_on_failure:
            dq.assert_quality(report)
        return report
    from tickerlake.plans import publish as pub

    spark = inputs["board"].sparkSession
    version = pub.write_checked(inputs, base_path)
    try:
        pub.make_live(spark, base_path, version)
    except dq.QualityError:
        if raise_on_failure:
            raise
    return pub.read_report(spark, base_path, version)


def main(argv: list[str]) -> int:
    """``python -m tickerlake.plans.build <sf_dir> <out_dir>``: build from the test-table feeds,
    run the 33 checks, publish the marts if all pass, print the report rows."""
    import json

    from tickerlake.session import get_session
    from tickerlake.sources.feeds import Feeds

    sf_dir, out_dir = argv[1], argv[2]
    spark = get_session()
    f = Feeds(spark, sf_dir)
    inputs = {"board": f.board(), "bars": f.bars(), "sector_map": f.sector_map(),
              "holdings": f.holdings(), "trades": f.trades(), "tax": f.tax()}
    rows = build_and_check(inputs, out_dir, raise_on_failure=False).collect()  # 33 rows
    for r in rows:
        print(json.dumps(r.asDict()))
    ok = all(r.passed for r in rows)
    return 0 if ok else 1


if __name__ == "__main__":
    import sys

    sys.exit(main(sys.argv))
