"""Registered queries over the market tables, each with its DuckDB equivalent in barloom.plans.sql."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators import actions, articles, cross_section, gates, membership, merge, returns, technicals
from barloom.plans import catalog_inputs, filings, known, panels, passes, records, reports, series, shapes, sql, states, stores, tolerant, trees, upkeep
from barloom.plans.registry import DIGITS, merged, rounded
from barloom.sources import tables

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    if f.__name__ in _queries:
        raise ValueError(f"registered twice: {f.__name__}")
    _queries[f.__name__] = lambda spark, sf_dir: rounded(f(spark, sf_dir))
    return f


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Momentum, trend and drawdown of each ticker's newest bar, the strongest first."""
    f = technicals.latest(technicals.price_features(tables.bars(spark, sf_dir)))
    return f.select("ticker", "date", "close", "momentum_20d", "price_vs_ma50", "max_drawdown_60d").orderBy(F.desc_nulls_last("momentum_20d"), "ticker")


@query
def bars(spark, d):  # noqa: ANN001, ANN201
    return tables.bars(spark, d)


@query
def price_features(spark, d):  # noqa: ANN001, ANN201
    return technicals.price_features(tables.bars(spark, d)).select("ticker", "date", *sql.PRICE_FEATURES)


@query
def oscillators(spark, d):  # noqa: ANN001, ANN201
    return technicals.oscillators(tables.bars(spark, d)).select("ticker", "date", *sql.OSCILLATORS)


@query
def market_features(spark, d):  # noqa: ANN001, ANN201
    return technicals.market_features(tables.bars(spark, d), tables.benchmark(spark, d)).select("ticker", "date", "return_vs_spy_5d", "beta_60d", "idio_vol_60d", "residual_momentum_ratio")


@query
def latest_technicals(spark, d):  # noqa: ANN001, ANN201
    return technicals.latest(technicals.price_features(tables.bars(spark, d))).select("ticker", "date", "momentum_20d", "price_vs_ma50", "max_drawdown_60d")


@query
def dispersion(spark, d):  # noqa: ANN001, ANN201
    return technicals.dispersion(tables.bars(spark, d))


@query
def admitted_universe(spark, d):  # noqa: ANN001, ANN201
    return technicals.admitted(tables.bars(spark, d), 480, 400).groupBy("ticker").agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date"))


def _loadings(spark, d):  # noqa: ANN001, ANN202
    f = technicals.price_features(tables.bars(spark, d))
    cols = ["momentum_20d", "price_vs_ma50", "realized_vol_20d"]
    # exploded, not unpivoted: rows stay dealt by ticker, so windows and groups of a ticker need no further shuffle
    return f.select("ticker", "date", F.col("_ret").alias("ret"), F.explode(F.array(*[F.struct(F.lit(c).alias("factor"), F.col(c).alias("loading")) for c in cols])).alias("_l")).select("ticker", "date", "ret", "_l.factor", "_l.loading")


@query
def robust_zscores(spark, d):  # noqa: ANN001, ANN201
    return cross_section.robust_zscores(_loadings(spark, d), x="loading").select("ticker", "date", "factor", "z")


@query
def plain_zscores(spark, d):  # noqa: ANN001, ANN201
    f = technicals.price_features(tables.bars(spark, d))
    return cross_section.zscores(f, "momentum_20d", "z").select("ticker", "date", "z")


@query
def factor_returns(spark, d):  # noqa: ANN001, ANN201
    return cross_section.factor_returns(_loadings(spark, d), 0.3, 5)


@query
def factor_momentum_ratio(spark, d):  # noqa: ANN001, ANN201
    return cross_section.factor_momentum_ratio(_loadings(spark, d), 60, 5, 0.3, 5)


@query
def breadth(spark, d):  # noqa: ANN001, ANN201
    return cross_section.breadth(technicals.price_features(tables.bars(spark, d)))


@query
def sector_medians(spark, d):  # noqa: ANN001, ANN201
    part = tables.read(spark, d, "part")
    return cross_section.positive_medians(part, ["p_brand"], ["p_retailprice", "p_size"])


@query
def dead_columns(spark, d):  # noqa: ANN001, ANN201
    t = tables.read(spark, d, "lineitem").withColumn("nothing", F.lit(None).cast("double")).withColumn("same", F.lit(1.0))
    return cross_section.dead_columns(t, ["l_quantity", "l_discount", "l_tax", "nothing", "same"])


@query
def modal_share(spark, d):  # noqa: ANN001, ANN201
    return cross_section.modal_share(tables.read(spark, d, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


@query
def source_coverage(spark, d):  # noqa: ANN001, ANN201
    e = tables.read(spark, d, "events").withColumn("v", F.when(F.col("value") > 20, F.col("value")))
    return cross_section.coverage(e, "event_type", ["v"], 0.8)


@query
def authority_merge(spark, d):  # noqa: ANN001, ANN201
    c = tables.closes(spark, d)
    new = merge.keep_last(c.where("source in ('click', 'view', 'error')"), ["ticker", "date"], [F.desc("run")])
    prior = merge.keep_last(c.where("source in ('signup', 'purchase')"), ["ticker", "date"], [F.desc("run")])
    new = new.withColumn("close", F.when(F.col("source") != "error", F.col("close")))
    return merge.merge_by_authority(new, prior, {"click": 3, "purchase": 3, "view": 1, "signup": 1}).drop("run")


@query
def delta_upsert(spark, d):  # noqa: ANN001, ANN201
    b = tables.bars(spark, d).select("ticker", "date", "close")
    delta = b.where("ticker % 3 = 0").withColumn("close", F.col("close") * 2)
    return merge.upsert(b, delta, ["ticker", "date"])


@query
def freshness(spark, d):  # noqa: ANN001, ANN201
    return merge.freshness(tables.bars(spark, d))


@query
def missing_sessions(spark, d):  # noqa: ANN001, ANN201
    return merge.missing_sessions(tables.bars(spark, d), "1995-01-01")


@query
def ingestion_watermarks(spark, d):  # noqa: ANN001, ANN201
    e = tables.read(spark, d, "events").withColumn("day", F.to_date("ts"))
    marks = e.where("event_type != 'error' and value < 50").groupBy("event_type").agg(F.min("day").alias("mark"))
    return merge.watermarks(e, marks, "event_type", "day")


@query
def row_gate(spark, d):  # noqa: ANN001, ANN201
    g = gates.row_gate(tables.bars(spark, d), 0.3, 3.0)
    return g.select("ticker", "date", F.array_join("blocking", ",").alias("blocking"), F.array_join("warnings", ",").alias("warnings"), "blocked")


@query
def series_gate(spark, d):  # noqa: ANN001, ANN201
    return gates.series_gate(tables.bars(spark, d))


@query
def source_agreement(spark, d):  # noqa: ANN001, ANN201
    return gates.source_agreement(tables.closes(spark, d), 2000.0)


@query
def field_gate(spark, d):  # noqa: ANN001, ANN201
    return gates.field_gate(tables.read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], [("l_quantity", 2, 48), ("l_discount", 0.01, 0.09)])


@query
def universe_drift(spark, d):  # noqa: ANN001, ANN201
    li = tables.read(spark, d, "lineitem")
    a = li.where("year(l_shipdate) <= 1994").select(F.col("l_partkey").alias("ticker"))
    b = li.where("year(l_shipdate) >= 1995").select(F.col("l_partkey").alias("ticker"))
    return gates.drift(a, b)


@query
def quote_sanity(spark, d):  # noqa: ANN001, ANN201
    return gates.quote_sanity(tables.bars(spark, d))


@query
def split_restatement(spark, d):  # noqa: ANN001, ANN201
    return actions.restate_splits(tables.bars(spark, d), catalog_inputs.splits(spark, d)).select("ticker", "date", "open", "close", "volume", "split_factor")


@query
def total_return(spark, d):  # noqa: ANN001, ANN201
    return actions.total_return(tables.bars(spark, d), catalog_inputs.dividends(spark, d)).select("ticker", "date", "close", "total_return_close")


@query
def split_evidence(spark, d):  # noqa: ANN001, ANN201
    return actions.orientation(catalog_inputs.splits(spark, d), tables.bars(spark, d))


@query
def residual_jumps(spark, d):  # noqa: ANN001, ANN201
    return actions.residual_jumps(tables.bars(spark, d), catalog_inputs.splits(spark, d))


@query
def splice_guard(spark, d):  # noqa: ANN001, ANN201
    return actions.splice_guard(tables.bars(spark, d))


@query
def action_ids(spark, d):  # noqa: ANN001, ANN201
    s = catalog_inputs.splits(spark, d).select(F.lit("split").alias("type"), "ticker", "ex_date", F.col("split_from").cast("int").alias("split_from"), F.col("split_to").cast("int").alias("split_to"), F.lit(None).cast("int").alias("cash_amount"))
    return actions.action_id(s).select("ticker", "ex_date", "action_id")


@query
def forward_returns(spark, d):  # noqa: ANN001, ANN201
    return returns.forward_returns(tables.bars(spark, d), tables.benchmark(spark, d))


@query
def outcome_hit_rates(spark, d):  # noqa: ANN001, ANN201
    b = tables.bars(spark, d)
    label = F.when(F.col("close") > F.col("open"), "UP").when(F.col("close") < F.col("open"), "DOWN").otherwise("FLAT")
    s = b.select(F.concat_ws("-", "ticker", "date").alias("signal_id"), "ticker", "date", label.alias("label"))
    return returns.hit_rates(returns.outcomes(s, returns.forward_returns(b, tables.benchmark(spark, d))))


@query
def risk_stats(spark, d):  # noqa: ANN001, ANN201
    return returns.risk_stats(tables.bars(spark, d))


@query
def market_beta(spark, d):  # noqa: ANN001, ANN201
    return returns.market_beta(tables.bars(spark, d), tables.benchmark(spark, d))


@query
def period_returns(spark, d):  # noqa: ANN001, ANN201
    return returns.period_returns(tables.bars(spark, d))


def _rosters(spark, d):  # noqa: ANN001, ANN202
    return tables.read(spark, d, "lineitem").select(F.expr("cast(trunc(l_shipdate, 'quarter') as date)").alias("date"), F.col("l_partkey").alias("ticker")).distinct()


@query
def roster_changes(spark, d):  # noqa: ANN001, ANN201
    return membership.roster_changes(_rosters(spark, d))


@query
def point_in_time_membership(spark, d):  # noqa: ANN001, ANN201
    r = _rosters(spark, d)
    newest = r.agg(F.max("date").alias("date"))
    return membership.point_in_time(r, r.join(newest, "date", "left_semi"), membership.roster_changes(r))


@query
def membership_windows(spark, d):  # noqa: ANN001, ANN201
    return membership.membership_windows(_rosters(spark, d))


def _holdings(spark, d):  # noqa: ANN001, ANN202
    li = tables.read(spark, d, "lineitem")
    return li.select(F.date_format("l_shipdate", "yyyy").alias("quarter"), (F.col("l_partkey") % 100).alias("ticker"), F.col("l_suppkey").alias("filer"), F.col("l_quantity").alias("shares"), F.col("l_extendedprice").alias("market_value"))


@query
def ownership(spark, d):  # noqa: ANN001, ANN201
    return membership.holdings_by_ticker(_holdings(spark, d))


@query
def ownership_deltas(spark, d):  # noqa: ANN001, ANN201
    h = _holdings(spark, d).groupBy("quarter", "ticker", "filer").agg(F.sum("shares").alias("shares"))
    return membership.quarter_deltas(h.where("quarter = '1996'"), h.where("quarter = '1995'"), ["ticker", "filer"])


def _articles(spark, d):  # noqa: ANN001, ANN202
    docs = tables.read(spark, d, "documents")
    return docs.select("doc_id", F.substring_index("text", "\n", 1).alias("title"), F.concat(F.lit("http://x/"), F.col("doc_id") % 40, F.lit("?r="), "doc_id").alias("url"), "source", F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(doc_id % 30 as int))").alias("published_at"), F.array(F.col("doc_id") % 50, F.col("doc_id") % 7).alias("tickers"), "text")


@query
def article_dedupe(spark, d):  # noqa: ANN001, ANN201
    a = _articles(spark, d).withColumn("fingerprint", articles.fingerprint("title", "url"))
    c = articles.canonical_articles(a, {"src0": 0.9, "src1": 0.8, "src2": 0.7})
    text = lambda x: F.array_join(F.transform("records", lambda r: F.concat(F.coalesce(r["source"], F.lit("")), F.lit(" "), r["url"])), "; ") if x else F.array_join(F.col("tickers").cast("array<string>"), ",")
    return c.withColumns({"tickers": text(False), "records": F.md5(text(True))})


@query
def article_chunks(spark, d):  # noqa: ANN001, ANN201
    return articles.word_chunks(tables.read(spark, d, "documents"), "doc_id", "text").select("doc_id", "chunk", F.md5("body").alias("body_md5"))


@query
def transcript_sections(spark, d):  # noqa: ANN001, ANN201
    return articles.transcript_sections(tables.read(spark, d, "conversations"))


@query
def vector_centroids(spark, d):  # noqa: ANN001, ANN201
    e = tables.read(spark, d, "embeddings").withColumn("half", F.col("vec_id") % 2)
    c = articles.centroids(e, ["label", "half"], [["label", "half"], ["label"]])
    return c.select("label", "half", "all_half", "n", F.get("centroid", F.lit(0)).alias("first"), F.aggregate("centroid", F.lit(0.0), lambda s, x: s + x).alias("total"))


@query
def centroid_drift(spark, d):  # noqa: ANN001, ANN201
    e = tables.read(spark, d, "embeddings").withColumn("part", F.col("vec_id") % 4)
    c = articles.centroids(e, ["label", "part"], [["label", "part"]])
    return articles.drift_between(c, "label", "part")


@query
def corpus_manifest(spark, d):  # noqa: ANN001, ANN201
    return articles.corpus_manifest(tables.read(spark, d, "documents"), "source", "n_chars")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return merged(_queries, *(m.R.queries for m in MODULES))


def oracle_sql() -> dict[str, str]:
    return merged({k: v for k, v in sql.oracle_sql(DIGITS).items() if k in _queries}, *(m.R.sql for m in MODULES))


#: Modules with queries beside their SQL.
MODULES = [known, trees, tolerant, passes, series, records, states, upkeep, shapes, filings, panels, stores, reports]
