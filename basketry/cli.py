"""Command line: load raw files, build the models, run the checks, write
forecasts. Only one-row summaries, check counts, the rows of the bounded
reports and what ``--show N`` asks for reach the driver.

    python -m basketry load --orders PATH --sales PATH --dest DIR [--format csv] [--namespace NAME] [--enforce]
    python -m basketry build --raw DIR [--dest DIR | --publish DIR [--gate error]] [--config reference|driver]
    python -m basketry build --tables SF_DIR            # the generated test tables
    python -m basketry builds --publish DIR [--drop] [--keep N] [--unpublished]
    python -m basketry check --raw DIR | --tables SF_DIR [--marts DIR]
    python -m basketry forecast --raw DIR | --tables SF_DIR [--marts DIR] --dest DIR [--by COL] [--show N]
    python -m basketry insights --raw DIR | --tables SF_DIR [--marts DIR]
    python -m basketry explore --raw DIR | --tables SF_DIR [--marts DIR] --measures M1,M2 [--dims D1,D2]
                               [--view orders|order_lines] [--grain day|week|month|quarter] [--segment VIP]
                               [--metric revenue|orders|aov|basket|units] (in place of --measures)
                               [--profile VIP] [--date-from D] [--date-to D] [--complete-only]
                               [--dest DIR] [--show N]
    python -m basketry drill --raw DIR | --tables SF_DIR [--marts DIR] [--view orders|order_lines]
                               [--segment VIP] [--profile VIP] [--date-from D] [--date-to D] [--complete-only]
                               [--product-id N] [--customer-id N] [--order-id N ...] [--dest DIR] [--show N]

``--marts DIR`` reads the tables that ``build --dest DIR`` wrote, or the
current snapshot of ``build --publish DIR``; without it the tables are built
first. A published build appears by one write, and only if the gate lets it
(``--gate error``: no row check of severity error finds anything). Shuffles and scans are sized from the input unless
``--no-size`` is given.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from basketry.config import DRIVER_CONFIG, REFERENCE_CONFIG


def _session():
    from basketry.session import get_session
    return get_session()


def _parse_vars(text: str) -> dict:
    """``--vars '{"vip_min_prior_orders": 5, "dataset_start_date": "2025-07-09"}'``"""
    raw = json.loads(text)
    out = {}
    for k, v in raw.items():
        out[k] = dt.date.fromisoformat(v) if k == "dataset_start_date" else v
    return out


def _marts(spark, args, build: bool = True):
    """The models of the given source; with ``build`` their published tables,
    read from ``--marts`` or written now."""
    from basketry.plans.marts import Marts
    from basketry.session import size_session
    from basketry.sources.readers import load_orders, load_sales
    if not args.no_size:
        src = [f"{args.tables}/orders.parquet", f"{args.tables}/lineitem.parquet"] if args.tables \
            else [f"{args.raw}/raw_orders", f"{args.raw}/raw_sales"]
        size_session(spark, src)
    cfg = DRIVER_CONFIG if (args.config == "driver" or (args.config is None and args.tables)) else REFERENCE_CONFIG
    if args.vars:
        cfg = cfg.with_(**_parse_vars(args.vars))
    if args.tables:
        m = Marts.from_tables(spark, args.tables, cfg)
    else:
        m = Marts(load_orders(spark, f"{args.raw}/raw_orders"), load_sales(spark, f"{args.raw}/raw_sales"), cfg)
    if not build:
        return m
    return m.published(spark, args.marts) if args.marts else m.materialize(spark)


def cmd_load(args) -> int:
    from basketry.sources import contracts, readers, sinks
    spark = _session()
    summary = {}
    if args.namespace:
        sinks.ensure_namespace(spark, args.namespace)
    for name, path, loader in (("raw_orders", args.orders, readers.load_orders),
                               ("raw_sales", args.sales, readers.load_sales)):
        if args.enforce:
            raw = spark.read.format(args.format).options(**({"header": "true"} if args.format == "csv" else {})).load(path)
            summary[name] = contracts.write(raw, contracts.CONTRACTS[name], args.dest)
            if args.namespace:
                sinks.register_table(spark, args.namespace, name, f"{args.dest}/{name}")
            continue
        df = loader(spark, path, fmt=args.format)
        watched = ["date_date", "customers_id", "orders_id", "net_sales"] if name == "raw_orders" else []
        observed, obs = sinks.with_load_observation(df, name, "date_date", watched)
        sinks.write_table(observed, f"{args.dest}/{name}")
        if args.namespace:
            sinks.register_table(spark, args.namespace, name, f"{args.dest}/{name}")
        got = dict(obs.get)
        nulls = {c: got.pop(f"nulls_{c}") for c in watched}
        readers.warn_on_null_counts(nulls)
        summary[name] = {**got, "columns": len(df.columns)}
    print(json.dumps(summary, default=str))
    return 0


def cmd_build(args) -> int:
    from basketry.operators.checks import BuildHeld
    spark = _session()
    models = _marts(spark, args, build=False)
    try:
        built = models.publish(spark, args.publish, args.gate) if args.publish else models.materialize(spark, args.dest)
    except BuildHeld as held:
        print(json.dumps({"held": held.root, "failing": held.failing}))
        return 1
    print(json.dumps({"tables": built.root, "rows": built.row_counts}))
    return 0


def cmd_builds(args) -> int:
    """The builds under a destination; ``--drop`` drops old ones."""
    from basketry.sources import snapshots
    spark = _session()
    if args.drop:
        print(json.dumps({"dropped": snapshots.drop_builds(spark, args.publish, args.keep, args.unpublished)}))
    for build in snapshots.builds(spark, args.publish):
        print(json.dumps(build))
    return 0


def cmd_check(args) -> int:
    from basketry.plans.quality import check_summary
    spark = _session()
    rows = check_summary(_marts(spark, args)).collect()   # one row per check
    failed = [r for r in rows if r.severity == "error" and r.failures > 0]
    for r in sorted(rows, key=lambda r: r.check_name):
        status = "PASS" if r.failures == 0 else ("WARN" if r.severity == "warn" else "FAIL")
        print(f"{status:4s} {r.check_name} ({r.failures})")
    print(f"{len(rows)} checks: {len(rows) - sum(1 for r in rows if r.failures)} pass, "
          f"{sum(1 for r in rows if r.failures and r.severity == 'warn')} warn, {len(failed)} error")
    return 1 if failed else 0


def cmd_forecast(args) -> int:
    from basketry.plans import forecast as fc
    from basketry.sources.sinks import write_table
    from basketry import registry
    spark = _session()
    m = _marts(spark, args)
    keys = [args.by] if args.by else []
    facts = m.mart_orders
    dims = {"market_segment": registry._by_market_segment, "nation": registry._by_nation,
            "brand": registry._by_brand}
    if args.by in dims:
        if not args.tables:
            raise SystemExit(f"--by {args.by} needs the dimension tables (--tables)")
        facts = dims[args.by](m, spark, args.tables)
    write_table(fc.sales_forecast(facts, keys), f"{args.dest}/v_sales_forecast")
    write_table(fc.sales_forecast_all(facts, keys), f"{args.dest}/v_sales_forecast_all")
    write_table(fc.backtest(facts, keys), f"{args.dest}/forecast_backtest")
    for r in spark.read.parquet(f"{args.dest}/forecast_backtest").limit(args.show).collect():
        print(json.dumps(r.asDict(), default=str))
    return 0


def _print_rows(title: str, df) -> None:
    from basketry.registry import present   # money as cents
    print(f"--- {title}")
    for r in present(df).collect():   # aggregated reports: a bounded number of rows
        print("  " + json.dumps(r.asDict(), default=str))


def cmd_insights(args) -> int:
    """The key insight numbers of the report year (and the three exercises)."""
    from basketry.plans import reports as rp
    spark = _session()
    m = _marts(spark, args)
    mo, cfg = m.mart_orders, m.cfg
    _print_rows(f"orders in {cfg.report_year}", rp.orders_in_year(mo, cfg))
    _print_rows("orders per month", rp.orders_per_month(mo, cfg))
    _print_rows("mean quantity per order per month", rp.avg_qty_per_month(mo, cfg))
    _print_rows("monthly pattern", rp.monthly_pattern(mo, cfg))
    _print_rows("fourth quarter share", rp.quarter_share(mo, cfg))
    _print_rows("busiest and quietest month", rp.peak_month_ratio(mo, cfg))
    _print_rows("segments", rp.segment_breakdown(mo, cfg))
    _print_rows("returning + VIP", rp.returning_vip_share(mo, cfg))
    _print_rows("overall", rp.overall_stats(mo, cfg))
    _print_rows("orphan lines", rp.orphan_line_count(m.stg_sales, m.stg_orders))
    _print_rows("same-day orders", rp.same_day_collisions(mo))
    _print_rows("history completeness", rp.history_completeness(mo))
    _print_rows("revenue reconciliation", rp.revenue_reconciliation(mo, m.mart_order_lines))
    return 0


def _filter(args):
    """The filter bar's options."""
    from basketry.operators.rollups import Slice
    return Slice(args.date_from, args.date_to, None if args.segment == "All" else args.segment, args.profile,
                 args.complete_only)


def cmd_drill(args) -> int:
    """The rows behind a measure: the group's filters, the detail columns. A
    product or customer is looked up in its zones of the clustered tables."""
    from basketry.plans import semantic as sm
    from basketry.sources.sinks import write_table
    spark = _session()
    m = _marts(spark, args)
    table = "mart_orders" if args.view == "orders" else "mart_order_lines"
    columns = sm.ORDER_DETAIL if args.view == "orders" else sm.LINE_DETAIL
    keys = {k: v for k, v in (("customer_id", args.customer_id), ("product_id", args.product_id)) if v is not None}
    df = m.slice(spark, table, **keys) if keys and table in m.layouts else getattr(m, table)
    for k, v in keys.items():
        df = df.where(df[k] == v)
    if args.order_id:  # a predicate that the files' Bloom filters answer
        df = m.among(df, args.order_id)
    out = sm.drill(df, _filter(args), columns)
    if args.dest:
        write_table(out, args.dest)
        out = spark.read.parquet(args.dest)
    _print_rows(f"{args.view}: rows", out.orderBy(*columns[:2]).limit(args.show))
    return 0


def cmd_explore(args) -> int:
    """Grouped measures of one metric view, e.g.
    ``explore --view orders --dims order_date_at_selected_grain --measures order_count,total_net_sales
    --grain quarter --segment VIP``."""
    from basketry.operators.explore import explore
    from basketry.plans import semantic as sm
    spark = _session()
    m = _marts(spark, args)
    view = sm.orders_view(m.cfg) if args.view == "orders" else sm.order_lines_view(m.cfg)
    df = m.mart_orders if args.view == "orders" else m.mart_order_lines
    dims = [d for d in (args.dims or "").split(",") if d]
    params = {"date_granularity": args.grain} if args.view == "orders" else {}
    wanted = _filter(args)
    if args.metric:
        measures = [args.metric]
        out = sm.focus_metric(view, wanted.over(df), dims, args.metric, args.segment, params)
    else:
        measures = [x for x in args.measures.split(",") if x]
        out = explore(view, df, dims, measures, wanted, params)
    if args.dest:
        from basketry.sources.sinks import write_table
        write_table(out, args.dest)
        out = spark.read.parquet(args.dest)
    # a top-n over the dimensions: --show rows reach the driver
    _print_rows(f"{args.view}: {', '.join(measures)} by {', '.join(dims) or 'all'}",
                (out.orderBy(*dims) if dims else out).limit(args.show))
    return 0


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="basketry")
    sub = p.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load")
    ld.add_argument("--orders", required=True)
    ld.add_argument("--sales", required=True)
    ld.add_argument("--dest", required=True)
    ld.add_argument("--format", default="parquet", choices=["parquet", "csv", "json", "orc"])
    ld.add_argument("--namespace", help="create it where it is missing and register the raw tables in it")
    ld.add_argument("--enforce", action="store_true", help="rows that break the contract go to <table>_quarantine")
    bs = sub.add_parser("builds")
    bs.add_argument("--publish", required=True, help="destination of published builds")
    bs.add_argument("--drop", action="store_true", help="drop all but the last --keep published builds")
    bs.add_argument("--keep", type=int, default=1)
    bs.add_argument("--unpublished", action="store_true", help="with --drop: also builds without a manifest")
    for name in ("build", "check", "forecast", "insights", "explore", "drill"):
        sp = sub.add_parser(name)
        src = sp.add_mutually_exclusive_group(required=True)
        src.add_argument("--raw")
        src.add_argument("--tables")
        sp.add_argument("--config", choices=["reference", "driver"])
        sp.add_argument("--vars", help="JSON object overriding configuration values")
        sp.add_argument("--no-size", action="store_true",
                        help="keep the session's shuffle partitions and scan splits instead of sizing them from the input")
        if name != "build":
            sp.add_argument("--marts", help="folder of tables written by build --dest or --publish")
        if name in ("forecast", "explore", "drill"):
            sp.add_argument("--show", type=int, default=20, help="rows to print")
        if name == "build":
            where = sp.add_mutually_exclusive_group()
            where.add_argument("--dest")
            where.add_argument("--publish", help="destination of snapshots: a new build appears there by one write")
            sp.add_argument("--gate", choices=["none", "error"], default="none")
        if name == "forecast":
            sp.add_argument("--dest", required=True)
            sp.add_argument("--by", help="series key: a mart column (e.g. order_segmentation) or "
                                         "market_segment / nation / brand (with --tables)")
        if name in ("explore", "drill"):
            sp.add_argument("--view", choices=["orders", "order_lines"], default="orders")
            sp.add_argument("--segment", choices=["All", "New", "Returning", "VIP"], default="All")
            sp.add_argument("--profile", choices=["New", "Returning", "VIP"])
            sp.add_argument("--date-from", type=dt.date.fromisoformat)
            sp.add_argument("--date-to", type=dt.date.fromisoformat, help="the day after the last")
            sp.add_argument("--complete-only", action="store_true")
            sp.add_argument("--dest", help="write all result rows there")
        if name == "explore":
            sp.add_argument("--dims")
            what = sp.add_mutually_exclusive_group(required=True)
            what.add_argument("--measures")
            what.add_argument("--metric", choices=["revenue", "orders", "aov", "basket", "units"])
            sp.add_argument("--grain", choices=["day", "week", "month", "quarter"], default="month")
        if name == "drill":
            sp.add_argument("--product-id", type=int)
            sp.add_argument("--customer-id", type=int)
            sp.add_argument("--order-id", type=int, action="append", default=[])
    args = p.parse_args(argv)
    return {"load": cmd_load, "build": cmd_build, "check": cmd_check, "forecast": cmd_forecast,
            "insights": cmd_insights, "explore": cmd_explore, "drill": cmd_drill, "builds": cmd_builds}[args.cmd](args)


if __name__ == "__main__":
    sys.exit(main())
