"""Change-driven silver: only the months that a run's changes touch are rewritten.

What a refresh of a silver table has to look at again:

* the keys of the bronze batches committed since the last refresh, and all
  rows without a key in them;
* stored rows, good or quarantined, that look up something another table's
  refresh has changed (a customer or product that is now good or no longer, a
  rate that came or moved, an order whose date or rate moved);
* customers whose signup date lies between the last clock and this one.

Stored rows keep every bronze column, so the latest row of a key is the latest
of its stored row and its new ones: bronze history is not read.  The rows are
judged by the same transforms as a rebuild's; with what the touched months hold
besides, they replace those months' partitions, silver and quarantine, and no
other file changes.  The result equals a rebuild's.  Whole rows are read from the
touched months once and are written once as judged, the others beside them.

A refresh notes what it consumed and which refresh of its look-up tables it
was judged by.  Where that does not add up -- no note, a plain rebuild or a
crash in between, a batch rewritten or abandoned, a new source column, a missed
change of a look-up table -- the table is rebuilt.  ``products`` arrives whole
on each run and is rebuilt whenever it does; what changed in it is found by
comparing look-up columns.

Not seen: changed tie-breakers or checks; run a rebuild after such a change.
A reader that holds a plan on a month while it is replaced has to plan again.
"""
from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.clock import ts_lit
from strata.operators.audit import BATCH_ID, INGESTED_DATE
from strata.operators.enrich import FX_RATE
from strata.operators.quality import FAILED
from strata.plans import pipeline
from strata.plans.jobs import side_by_side
from strata.plans.pipeline import MONTH, PROCESSED_AT, SILVER_LAYOUT, PipelineConfig
from strata.plans.silver import FX_KEYS
from strata.session import ensure_checkpoint_dir
from strata.sources import batches
from strata.sources.store import PASSED, TableStore, empty_frame

STATE = "silver_state"
SCHEMA = (
    "silver_table STRING, refresh STRING, version STRING, upto TIMESTAMP, commits BIGINT, source STRING, "
    "as_of DATE, parents STRING, logged_at TIMESTAMP"
)

KEYS = {
    "customers": ["customer_id"], "products": ["product_id"], "exchange_rates": FX_KEYS,
    "orders": ["order_id"], "order_items": ["order_item_id"],
}
#: Key columns with a not-null check: rows without them are no key's rows.
CHECKED = {**KEYS, "exchange_rates": ["rate_date"]}
#: What other tables take from a table's good rows.
LOOKED_UP = {
    "customers": ["customer_id"], "products": ["product_id"],
    "exchange_rates": ["rate_date", "quote_currency", "rate"], "orders": ["order_id", "order_date", FX_RATE],
}
#: table -> looked-up table -> (own columns, its columns)
LOOKS_UP = {
    "orders": {
        "customers": (["customer_id"], ["customer_id"]),
        "exchange_rates": (["order_date", "currency_code"], ["rate_date", "quote_currency"]),
    },
    "order_items": {"orders": (["order_id"], ["order_id"]), "products": (["product_id"], ["product_id"])},
}
#: Tables that do not need one another's refresh, in order.
STEPS = [["products", "customers", "exchange_rates"], ["orders"], ["order_items"]]


@dataclass
class Refresh:
    """``mode``: kept, months or rebuilt.  ``changed``: look-up rows that came,
    went or moved (None: any may have).  ``before``/``after``: refresh ids."""

    table: str
    mode: str
    months: list[str | None]
    changed: DataFrame | None
    before: str | None
    after: str
    good: int = 0
    bad: int = 0


@dataclass(frozen=True)
class _Consumed:
    """How far a table's sources have come."""

    upto: dt.datetime | None
    commits: int
    source: str | None
    fresh: list[tuple[str, dt.date]]
    rewritten: bool


def _state(store: TableStore, name: str) -> dict | None:
    """The last note of a table's refreshes."""
    log = store.read_or_empty("control", STATE, SCHEMA).where(F.col("silver_table") == name)
    fields = [c.split()[0] for c in SCHEMA.split(", ")]
    row = log.agg(F.max_by(F.struct(*fields), "logged_at").alias("s")).first()
    return row["s"].asDict() if row and row["s"] else None


def _note(store: TableStore, refresh: Refresh, seen: _Consumed, as_of: dt.date, parents: dict[str, str], begun: bool = False) -> None:
    """``begun``: the version is being changed; until the next note it is
    nobody's known state."""
    version = None if begun else store.split_version(refresh.table).rsplit("/", 1)[-1]
    row = store.spark.range(1).select(
        F.lit(refresh.table).alias("silver_table"), F.lit(refresh.after).alias("refresh"),
        F.lit(version).cast("string").alias("version"),
        F.lit(seen.upto).cast("timestamp").alias("upto"),
        F.lit(seen.commits).cast("bigint").alias("commits"), F.lit(seen.source).cast("string").alias("source"),
        F.lit(as_of).alias("as_of"), F.lit(json.dumps(parents)).alias("parents"),
        ts_lit(dt.datetime.now(dt.timezone.utc)).alias("logged_at"),
    )
    store.log(STATE, "silver_table", refresh.table, row)


def _consumed(store: TableStore, name: str, state: dict | None) -> _Consumed:
    """The batches past the last note, and whether older ones changed since.
    Timestamps are compared in Spark; the driver gets one row and one for each
    new batch."""
    source = (store.current_path("bronze", name) or "").rsplit("/", 1)[-1]
    ended = batches.log(store).where((F.col("source_table") == name) & F.col("status").isin(batches.COMMITTED, batches.ABANDONED))
    ended = ended.distinct()
    since = F.lit(state["upto"]) if state and state["upto"] else F.lit(None).cast("timestamp")
    old = F.coalesce(F.col("logged_at") <= since, F.lit(False))
    total = ended.agg(F.max("logged_at").alias("upto"), F.count(F.lit(1)).alias("n"), F.count_if(old).alias("old")).first()
    new = (
        ended.groupBy("batch_id", "ingested_date")
        .agg(F.count_if(old).alias("old"), F.count_if(~old).alias("new"), F.count_if(~old & (F.col("status") == batches.ABANDONED)).alias("lost"))
        .where("new > 0")
        .collect()
    )
    rewritten = any(r["old"] or r["lost"] for r in new) or bool(state) and total["old"] != (state["commits"] or 0)
    return _Consumed(total["upto"], total["n"], source if source.startswith("_v=") else None,
                     [(r["batch_id"], r["ingested_date"]) for r in new], rewritten)


def _saved(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _named(df: DataFrame, own: Sequence[str], keys: DataFrame, theirs: Sequence[str]) -> DataFrame:
    """Those of ``keys`` that ``own`` columns of ``df`` name, each once: no more
    than ``df`` has, however many keys came."""
    side = keys.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(theirs)])
    held = df.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(own)]).distinct().hint("rebalance")
    same = F.lit(True)
    for i in range(len(own)):
        same = same & side[f"_k{i}"].eqNullSafe(held[f"_o{i}"])
    return _saved(side.join(held, same, "left_semi").distinct())


def _hit(df: DataFrame, keys: DataFrame, own: Sequence[str], flag: str) -> DataFrame:
    """``flag``: do the row's ``own`` columns name one of ``keys`` (see
    ``_named``)?  Keys are rebalanced, so a hot key of ``df`` can be split."""
    side = keys.hint("rebalance").withColumn(flag, F.lit(True))
    same = F.lit(True)
    for i, c in enumerate(own):
        same = same & df[c].eqNullSafe(side[f"_k{i}"])
    return df.join(side, same, "left").drop(*[f"_k{i}" for i in range(len(own))]).withColumn(flag, F.coalesce(flag, F.lit(False)))


def _changes(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Look-up rows that are in one of the two only."""
    old, new = old.select(*columns, F.lit(0).alias("_side")), new.select(*columns, F.lit(1).alias("_side"))
    sides = old.union(new).groupBy(*columns).agg(F.min("_side").alias("_first"), F.max("_side").alias("_last"))
    return _saved(sides.where("_first = _last").select(*columns))


def _in(column: str, values: Sequence[str | None]):
    some = [v for v in values if v is not None]
    found = F.col(column).isin(some) if some else F.lit(False)
    return found | F.col(column).isNull() if None in values else found


def _clustered(df: DataFrame, date_col: str) -> DataFrame:
    return df.hint("rebalance", PASSED, MONTH).sortWithinPartitions(PASSED, MONTH, date_col)


def _rebuild(store: TableStore, name: str, cfg: PipelineConfig, known: bool) -> tuple[int, int, DataFrame | None]:
    """(good, bad, changes) -- changes only against a version whose rows the
    other tables are known to have been judged by."""
    _, run_ts = cfg.clock()
    columns = LOOKED_UP.get(name)
    old = store.read("silver", name).select(*columns) if known and columns else None
    if old is not None and store.keep_versions < 2:
        old = _saved(old)  # the version goes with the rebuild
    good, bad = pipeline.write_silver(store, name, pipeline.build_silver(store, name, cfg), run_ts)
    if columns is None:
        return good, bad, empty_frame(store.spark, "nothing INT")
    return good, bad, None if old is None else _changes(old, store.read("silver", name), columns)


def _rewrite(
    store: TableStore, name: str, cfg: PipelineConfig, seen: _Consumed, state: dict, parents: dict[str, Refresh]
) -> tuple[list[str | None], DataFrame]:
    """(months rewritten, changes)."""
    as_of, run_ts = cfg.clock()
    date_col, _ = SILVER_LAYOUT[name]
    keys, checked, stored = KEYS[name], CHECKED[name], store.read_split(name)
    bronze = store.read("bronze", name)
    new_batch = F.lit(False)
    for batch, day in seen.fresh:
        new_batch = new_batch | (F.col(INGESTED_DATE) == F.lit(day)) & (F.col(BATCH_ID) == batch)
    fresh = bronze.where(new_batch)
    has_key = F.lit(True)
    for c in checked:
        has_key = has_key & F.col(c).isNotNull()
    fresh_keys = _named(stored, keys, fresh.where(has_key), keys)
    probes = {
        p: (own, _named(stored, own, parents[p].changed, theirs))
        for p, (own, theirs) in LOOKS_UP.get(name, {}).items() if not parents[p].changed.isEmpty()
    }

    def touched(df: DataFrame) -> DataFrame:
        df = _hit(df, fresh_keys, keys, "_t_own")
        flag = F.col("_t_own")
        for parent, (own, named) in probes.items():
            df = _hit(df, named, own, f"_t_{parent}")
            flag = flag | F.col(f"_t_{parent}")
        if name == "customers" and state["as_of"] != as_of:
            first, last = sorted([state["as_of"], as_of])
            flag = flag | F.coalesce((F.col("signup_date") > F.lit(first)) & (F.col("signup_date") <= F.lit(last)), F.lit(False))
        return df.withColumn("_touched", flag).drop("_t_own", *[f"_t_{p}" for p in probes])

    # A narrow scan finds the months; whole rows are read from those only, once.
    needed = dict.fromkeys([*keys, *[c for own, _ in probes.values() for c in own], *(["signup_date"] if name == "customers" else []), MONTH])
    months = [r[0] for r in touched(stored.select(*needed)).where("_touched").select(MONTH).distinct().collect()]
    staged = store.staging(name)
    marked = store.stage(f"{staged}/marked", touched(stored.where(_in(MONTH, months))), ["_touched"]) if months else None
    old = stored.where(F.lit(False)) if marked is None else marked.where("_touched").drop("_touched")

    rows = old.select(*fresh.columns).unionByName(fresh)
    judged = (
        pipeline.build_silver(store, name, cfg, rows).flagged.withColumn(PROCESSED_AT, ts_lit(run_ts))
        .withColumn(PASSED, F.col(FAILED) == "")
        .withColumn(MONTH, F.date_format(F.col(date_col), "yyyy-MM"))
    )
    # Written as they will stay; the folders tell which months they are in.
    as_stored = [F.col(f.name).cast(f.dataType) for f in stored.schema.fields]
    judged = store.stage(f"{staged}/judged", _clustered(judged.select(*as_stored), date_col), [PASSED, MONTH])
    more = [m for m in store.staged_values(f"{staged}/judged", MONTH) if m not in months]
    columns = LOOKED_UP.get(name)
    changed = empty_frame(store.spark, "nothing INT") if columns is None else _changes(old.where(PASSED), judged.where(PASSED), columns)
    if months or more:
        rest = stored.where(_in(MONTH, more))  # touched rows of these would be in ``months``
        if marked is not None:
            rest = rest.unionByName(marked.where("NOT _touched").drop("_touched"))
        store.stage(f"{staged}/rest", _clustered(rest, date_col), [PASSED, MONTH])
        _note(store, Refresh(name, "months", [], None, None, state["refresh"]), seen, as_of, {}, begun=True)
        store.swap_split(name, [f"{staged}/judged", f"{staged}/rest"], MONTH, [*months, *more])
    store.unstage(staged)
    return [*months, *more], changed


def refresh_table(store: TableStore, name: str, cfg: PipelineConfig, parents: dict[str, Refresh]) -> Refresh:
    """Brings one silver table up to its bronze table and to ``parents``."""
    as_of, _ = cfg.clock()
    state, version = _state(store, name), store.split_version(name)
    seen = _consumed(store, name, state)
    known = state is not None and version is not None and state["version"] == version.rsplit("/", 1)[-1]
    judged_by = json.loads(state["parents"]) if state else {}
    wanted = {p: r.after for p, r in parents.items()}
    before = state["refresh"] if known else None
    usable = (
        known and not seen.rewritten and state["source"] == seen.source
        and set(store.read("bronze", name).columns) <= set(store.read_split(name).columns)
        and all(r.changed is not None and r.before == judged_by.get(p) for p, r in parents.items())
    )
    nothing = empty_frame(store.spark, store.read("silver", name).select(*LOOKED_UP[name]).schema) if known and name in LOOKED_UP else empty_frame(store.spark, "nothing INT")
    if usable and not seen.fresh and (name != "customers" or state["as_of"] == as_of) and all(r.changed.isEmpty() for r in parents.values()):
        out = Refresh(name, "kept", [], nothing, before, before)
        if judged_by != wanted:
            _note(store, out, seen, state["as_of"], wanted)
    elif usable:
        months, changed = _rewrite(store, name, cfg, seen, state, parents)
        if months:
            out = Refresh(name, "months", months, changed, before, uuid.uuid4().hex[:12])
        else:  # nothing stored depends on what came
            out = Refresh(name, "kept", [], changed, before, before)
        _note(store, out, seen, as_of, wanted)
    else:
        good, bad, changed = _rebuild(store, name, cfg, known)
        out = Refresh(name, "rebuilt", [], changed, before, uuid.uuid4().hex[:12], good, bad)
        _note(store, out, seen, as_of, wanted)
        return out
    # The side is a partition column: files' footers count the rows.
    counts = {r[PASSED]: r["count"] for r in store.read_split(name).groupBy(PASSED).count().collect()}
    out.good, out.bad = counts.get(True, 0), counts.get(False, 0)
    return out


def refresh_silver(store: TableStore, cfg: PipelineConfig) -> dict[str, Refresh]:
    """All silver tables, dimensions side by side, then orders, then items."""
    done: dict[str, Refresh] = {}
    for step in STEPS:
        done |= side_by_side(
            store.spark,
            {n: (lambda n=n: refresh_table(store, n, cfg, {p: done[p] for p in LOOKS_UP.get(n, {})})) for n in step},
        )
    return {n: done[n] for n in SILVER_LAYOUT}
