"""What was known on each day: statements and valuation by the filings public at the time.

The default marts keep the last filed version of every fact, so a quarter repeated as a comparative a
year later is visible from that later filing only. Here time has two axes. A version of a fact is
known from its filing until the next filing of the same period; what a company's filings said on a
day is the set of versions whose interval holds that day. It only changes on the company's filing dates, so
the statements are computed once for each (company, filing date), by the very plans of the default, with the
ticker and the date's number in the ticker's place. A restatement shows from its own filing on, and the first version until then.

A company has as many states as days on which it filed, some four a year, and a state holds its
facts up to then: rows grow with the square of a company's years, never with the number of
companies, and no join or window is wider than one company's calendar. So facts are not listed under states: a period
changes only where one of its own versions is filed, and between two such filings, in a piece of the states, its row is pivoted
once. The balance sheet is done with that; the income statement, whose rows depend on other periods, is computed on period
rows listed under every state. These are never shuffled: the versions are dealt by company once, and
each statement is reduced where it is computed to runs of states in which a row reads the same; only runs travel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.scalars import days_between
from ledgerline.operators.asof import asof_join
from ledgerline.operators.latest import latest_by
from ledgerline.plans import statements
from ledgerline.plans.staging import reported_facts, same_day, typed_facts
from ledgerline.plans.valuation import market_caps, valued, with_policy_rate

#: Statement columns that a valuation takes from the quarter in force.
PUBLIC = {
    "period_end": "latest_filed_period_end",
    "ebitda_ttm": "ebitda_ttm",
    "total_debt": "reported_total_debt",
    "cash_and_equivalents": "cash_and_equivalents",
}


#: Whose statements are computed: a company's in one of its states, which are numbered from 1 on.
STATE = ("ticker", "state")
#: The same in neighbouring states, the first and the last of them.
RUN = ("ticker", "_first", "_last")
#: Neighbouring states between two filings of one period; its pieces are numbered from 1 on.
PIECE = ("ticker", "piece")


def _partitions(df: DataFrame) -> int:
    """As many as shuffles start with: a merged partition's states would be too many rows for one task."""
    conf = df.sparkSession.conf
    first = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(first or conf.get("spark.sql.shuffle.partitions"))


def fact_versions(raw: DataFrame) -> DataFrame:
    """Every filed version of every fact with the days it was the newest: known_from, known_to (open when null).

    Of versions filed on one day one counts, by the order the default uses. A version without a
    filing date was never public and is left out.
    """
    period = ["ticker", "concept", "start", "end"]
    filed = reported_facts(raw).filter("filed is not null")
    versions = typed_facts(latest_by(filed, [*period, "filed"], same_day()))
    # The length is added where the versions were dealt to: balance sheets don't read it, and what ships the same is shipped once.
    versions = versions.drop("period_length_days").repartition(_partitions(versions), "ticker")
    versions = versions.withColumn("period_length_days", days_between("period_start", "period_end"))
    # The filings of one period of one concept: a handful of rows.
    succession = Window.partitionBy("ticker", "concept", "period_start", "period_end").orderBy("filed")
    return versions.withColumns({"known_from": F.col("filed"), "known_to": F.lead("filed").over(succession)})


def filing_days(facts: DataFrame) -> DataFrame:
    """(ticker, known_from): each day on which what is known of a company changed; equal for raw facts and their versions."""
    days = facts.select("ticker", F.col("filed").cast("date").alias("known_from"))
    return days.filter("ticker is not null and known_from is not null").distinct()


def states(versions: DataFrame) -> DataFrame:
    """(ticker, days): the days on which what is known of a company changed, in order; a state's number is its day's place."""
    return versions.filter("ticker is not null").groupBy("ticker").agg(F.array_sort(F.collect_set("known_from")).alias("days"))


def facts_as_known(versions: DataFrame) -> DataFrame:
    """The staged facts, each once, with the state that first knows it and the number of its company's states.

    ``versions`` holds all versions of its periods.
    """
    company = Window.partitionBy("ticker")
    placed = versions.filter("ticker is not null and known_from is not null").withColumn(
        "_first", F.dense_rank().over(company.orderBy("known_from"))
    )
    return placed.withColumn("_states", F.max("_first").over(company)).drop("known_from", "known_to")


def _pieces(known: DataFrame, period: Sequence[str], start: str) -> DataFrame:
    """Facts listed under the pieces of their period's states: nothing of a period changes but where one of its versions begins.

    A version holds from its own piece, ``_own``, up to the one before its successor's.
    """
    begin = Window.partitionBy("ticker", *period).orderBy("_first")
    later = begin.rangeBetween(1, Window.unboundedFollowing)
    until = F.coalesce(F.min("_first").over(later) - 1, "_states")
    placed = known.withColumns({"_own": F.dense_rank().over(begin), "_until": until})
    placed = placed.withColumn("_pieces", F.max("_own").over(Window.partitionBy("ticker", *period)))
    succession = Window.partitionBy("ticker", "concept", start, "period_end").orderBy("_first")
    listed = placed.withColumn("_end", F.coalesce(F.lead("_own").over(succession) - 1, "_pieces")).filter("_own <= _end")
    return listed.withColumn("piece", F.explode(F.sequence("_own", "_end")))


def _states_of_piece() -> list[Column]:
    """What a pivot by ``PIECE`` aggregates as its first and its last state."""
    own = F.when(F.col("_own") == F.col("piece"), F.col("_until"))
    return [F.max("_first").alias("_first"), F.max(own).alias("_last")]


def _balance_in_runs(known: DataFrame) -> DataFrame:
    """The balance sheets with the states they hold in; of a few runs of a quarter neighbours may read the same."""
    instants = _pieces(known.filter("period_start is null"), ["period_end"], "period_start")
    return statements.balance_of(statements.instant_rows(instants, PIECE, _states_of_piece()), RUN)


def _income_by_state(known: DataFrame, contiguous: bool) -> DataFrame:
    """The income statement of every state. Only its periods' rows are listed under states, not their facts."""
    spans = _pieces(statements.reported_spans(known, by=("ticker", "_first", "_states")), statements.SPAN, "_start")
    periods = _each_state(statements.period_rows(spans, PIECE, _states_of_piece()).drop("piece"))
    return statements.statement_of(statements.quarters_of(statements.labelled_periods(periods, STATE), STATE), contiguous, STATE)


def _each_state(runs: DataFrame) -> DataFrame:
    return runs.withColumn("state", F.explode(F.sequence("_first", "_last"))).drop("_first", "_last")


def _runs(rows: DataFrame, place=F.dense_rank) -> DataFrame:
    """Rows of states as runs: neighbouring states, ``_first`` to ``_last``, in which a row reads the same are one row."""
    read = [c for c in rows.columns if c != "state"]
    # Along the states in which a row reads the same, the state's number less the row's is one number.
    alike = Window.partitionBy(*read).orderBy("state")
    numbered = rows.withColumn("_run", F.col("state") - place().over(alike))
    return numbered.groupBy(*read, "_run").agg(F.min("state").alias("_first"), F.max("state").alias("_last")).drop("_run")


def financials_by_state(versions: DataFrame, contiguous: bool = False) -> DataFrame:
    """The quarterly financials of every state: ticker, state and the columns of the default."""
    known = facts_as_known(versions)
    balance = _balance_in_runs(known).repartition(_partitions(versions), "ticker", "period_end")
    income = _runs(_income_by_state(known, contiguous))
    # Dealt by company and quarter, runs meet runs; a balance sheet's states are listed again where it was dealt to.
    flows = statements.shown_flows(income, RUN)
    on = [F.col(f"b.{c}") == F.col(f"f.{c}") for c in ("ticker", "period_end")]
    on.append(F.col("b.state").between(F.col("f._first"), F.col("f._last")))
    taken = [F.col(f"f.{c}") for c in flows.columns if c not in ("ticker", "period_end", "_first", "_last")]
    return statements.combined(_each_state(balance).alias("b").join(flows.alias("f"), on, "left").select("b.*", *taken), STATE)


def financials_as_known(versions: DataFrame) -> DataFrame:
    """The quarterly financials with the days each row was what the filings said: known_from, known_to (open when null).

    Neighbouring states in which a quarter reads the same are one row.
    """
    runs = _runs(financials_by_state(versions), F.row_number)
    known = {"known_from": F.get("days", F.col("_first") - 1), "known_to": F.get("days", F.col("_last"))}
    return runs.join(states(versions), "ticker").withColumns(known).drop("days", "_first", "_last")


def totals_as_known(versions: DataFrame, contiguous: bool = False) -> DataFrame:
    """The quarters with a trailing total, with the states they hold in: ticker, _first, _last and the keys of ``PUBLIC``."""
    known = facts_as_known(versions)
    income = statements.shown_flows(_income_by_state(known, contiguous), STATE)
    totals = _runs(income.filter("ebitda_ttm is not null").select(*STATE, "period_end", "ebitda_ttm"))
    on = [F.col(f"b.{c}") == F.col(f"t.{c}") for c in ("ticker", "period_end")]
    on += [F.col("b._first") <= F.col("t._last"), F.col("t._first") <= F.col("b._last")]
    both = _balance_in_runs(known).alias("b").join(totals.alias("t"), on)
    run = [F.greatest("b._first", "t._first").alias("_first"), F.least("b._last", "t._last").alias("_last")]
    return both.select("b.ticker", *run, "b.period_end", "t.ebitda_ttm", "b.total_debt", "b.cash_and_equivalents")


def valuation_as_known(
    prices: DataFrame,
    snapshot: DataFrame,
    versions: DataFrame,
    series: DataFrame,
    contiguous: bool = False,
    filed_on: DataFrame | None = None,
) -> DataFrame:
    """The daily valuation with, on each day, the latest quarter whose trailing total was known by then.

    A restatement of an older quarter never takes a newer one's place. Columns as in the default. ``filed_on``: the
    versions' ``filing_days``, where a caller has them without settling the versions first.
    """
    payload = F.struct(*[F.col(c).alias(out) for c, out in PUBLIC.items()])
    dealt = _each_state(totals_as_known(versions, contiguous).repartition(_partitions(versions), "ticker"))
    best = dealt.groupBy(*STATE).agg(F.max_by(payload, "period_end").alias("_best"))
    # A state without any such quarter says so, instead of leaving the one before in force.
    every = filing_days(versions) if filed_on is None else filed_on
    every = every.withColumn("state", F.row_number().over(Window.partitionBy("ticker").orderBy("known_from")))
    public = every.join(best, list(STATE), "left").select("ticker", "known_from", "_best.*")
    rated = with_policy_rate(market_caps(prices, snapshot), series, "price_date")
    joined = asof_join(rated, public, "price_date", "known_from", {c: c for c in PUBLIC.values()}, by=["ticker"])
    return valued(joined)
