"""Silver to gold: the full load and the incremental load."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakestar.operators.dimensions import (
    build_dimensions,
    concurrently,
    incoming_members,
    stamped,
    upsert,
    with_parent_key,
)
from lakestar.operators.fact import fact_lookups, keyed_rows, lacks
from lakestar.operators.incremental import high_water_mark
from lakestar.operators.incremental import late as late_sales
from lakestar.operators.incremental import slice_after, slice_of_batches, undated
from lakestar.operators.lookup import Limits, measure
from lakestar.plans.ingest import now
from lakestar.sources.catalog import known_sizes
from lakestar.sources.ledger import GOLD, SILVER, Current, few_rows
from lakestar.sources.tables import Lake, gathered, with_place
from lakestar.specs import (
    CUSTOMER,
    DIMENSIONS,
    FACT,
    FACT_LOOKUPS,
    FACT_LOOKUPS_BY_NAME,
    PERIOD,
)

Versions = dict[str, Current]


def star(lake: Lake) -> dict[str, DataFrame]:
    """All gold tables as of the last finished batch."""
    at = lake.ledger.current_versions()
    return {t: lake.gold_table(t, at.get(t)) for t in [*[d.name for d in DIMENSIONS], FACT]}


def mark_of_lake(lake: Lake) -> dt.date | None:
    """The latest sale date of the fact, from the ledger; no file of the fact is opened."""
    at = lake.ledger.current_versions().get(FACT)
    return at.max_date if at else None


def mark_from_footers(lake: Lake) -> dt.date | None:
    """The latest sale date of the fact, from the fact itself: Parquet's footers answer, no row is read."""
    return marks_in_footers(lake).first()["max_sale_date"]


def marks_in_footers(lake: Lake) -> DataFrame:
    """``max_sale_date`` in a session of its own, in which Spark asks the footers for aggregates.

    Sales without a date lie in the month null, whose files have no latest date to tell; it is left out.
    """
    session = lake.spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")  # the reader that can
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    fact = replace(lake, spark=session).gold_table(FACT)
    return high_water_mark(fact.where(F.col(PERIOD[0]).isNotNull()))


def _added(
    lake: Lake,
    rows: DataFrame | None,
    table: str,
    version: int,
    batch_id: int,
    before: Current | None,
    **options,
) -> Current:
    """Write rows, if any, as an attempt at a batch of a version; what the table is then made of."""
    kept = before.parts if before and before.version == version else ()
    latest = before.max_date if kept else None
    if rows is None:
        return Current(version, batch_id, kept, latest)
    written = lake.write_batch(rows, lake.gold(table, version), batch_id, **options)
    return Current(version, batch_id, (*[p for p in kept if p[0] != batch_id], (batch_id, written)), latest)


def _record(
    lake: Lake,
    versions: Versions,
    batch_id: int,
    stamp: dt.datetime | None,
    counts: dict[str, int] | None = None,
) -> None:
    """One entry per table, and one per count of rows loaded, lost or left behind.

    A table that the batch did not touch gets one without an attempt.
    """
    tables = [(t, at.version, dict(at.parts).get(batch_id), at.max_date, None) for t, at in sorted(versions.items())]
    rows = [(name, None, None, None, n) for name, n in (counts or {}).items()]
    columns = "item string, version long, written string, max_date date, row_count long"
    lake.ledger.record(GOLD, batch_id, few_rows(lake.spark, columns, tables + rows), stamp or now())


def _write_dimensions(
    lake: Lake, tables: dict[str, DataFrame], batch_id: int, before: Versions
) -> Versions:
    """Write each table as a new version of its own."""

    def write(name: str) -> Current:
        version = before[name].version + 1 if name in before else 1
        return _added(lake, tables[name], name, version, batch_id, None)

    written = concurrently(lake.spark, [lambda name=name: write(name) for name in tables])
    return dict(zip(tables, written))


def _write_fact(
    lake: Lake,
    rows: DataFrame,
    versions: Versions,
    version: int,
    batch_id: int,
    before: Current | None,
    *,
    stamp: dt.datetime | None,
    on_duplicate: str,
    by_name: bool,
    limits: Limits,
    max_records_per_file: int | None,
    database: str | None = None,
) -> tuple[Current, dict[str, int]]:
    """The fact joins the dimensions as written, so its keys are the ones readers find.

    Rows that find no key are kept up to the tasks that write, which count them by dimension and
    leave them out; so neither the written rows nor silver are read again to be counted.
    """
    by = FACT_LOOKUPS_BY_NAME if by_name else FACT_LOOKUPS
    dimensions = {d.name: lake.gold_table(d.name, versions[d.name]) for d in DIMENSIONS}
    # rows that fan out can't be counted before the lookups; that mode counts what it offers by itself
    how = "left" if on_duplicate == "fail" else "inner"
    lookups = fact_lookups(dimensions, by)
    sizes = known_sizes(lake, database, versions, by) if database else {}
    sizes |= measure([l for l in lookups if l.name not in sizes])
    keyed = keyed_rows(rows, dimensions, by=by, how=how, stamp=stamp, on_duplicate=on_duplicate, limits=limits, sizes=sizes)
    seen, lacking = Observation(), lacks(by)
    whole = ~reduce(Column.__or__, lacking.values())
    counted = keyed.observe(
        seen,
        F.count("*").alias("rows_offered"),
        F.count_if(whole).alias("rows_loaded"),
        F.max(F.when(whole, F.col("sale_date"))).alias("latest"),
        *[F.count_if(lost).alias(f"lost_{name}") for name, lost in lacking.items()],
    )
    at = _added(
        lake, counted.where(whole), FACT, version, batch_id, before,
        partition_by=PERIOD, max_records_per_file=max_records_per_file,
    )
    counts = dict(seen.get)
    latest = counts.pop("latest")
    if on_duplicate != "fail":
        counts = {"rows_offered": rows.count(), "rows_loaded": counts["rows_loaded"]}
    elif counts["rows_loaded"] == counts["rows_offered"]:
        counts = {k: counts[k] for k in ("rows_offered", "rows_loaded")}
    dates = [d for d in (at.max_date, latest) if d is not None]
    return Current(at.version, batch_id, at.parts, max(dates, default=None)), counts


def load_full(
    lake: Lake,
    *,
    versions: str = "all",
    null_safe: bool = True,
    on_duplicate: str = "fail",
    manufacturer_by_name: bool = False,
    stamp: dt.datetime | None = None,
    limits: Limits = Limits(),
    max_records_per_file: int | None = None,
    database: str | None = None,
) -> int:
    """Build the whole star from silver as a new version of every table.

    ``database``: where gold is registered; statistics there (``catalog.analyze_gold``) are used for
    dimensions they were taken of, the others are measured.
    """
    silver = lake.silver_sales()
    batch_id = lake.ledger.last_batch(SILVER)
    before = lake.ledger.current_versions()
    tables = build_dimensions(silver, versions=versions, null_safe=null_safe, limits=limits)
    tables = {name: stamped(table, stamp) for name, table in tables.items()}
    at = _write_dimensions(lake, tables, batch_id, before)
    version = before[FACT].version + 1 if FACT in before else 1
    at[FACT], counts = _write_fact(
        lake,
        silver,
        at,
        version,
        batch_id,
        None,
        stamp=stamp,
        on_duplicate=on_duplicate,
        by_name=manufacturer_by_name,
        limits=limits,
        max_records_per_file=max_records_per_file,
        database=database,
    )
    _record(lake, at, batch_id, stamp, counts)
    return batch_id


def load_increment(
    lake: Lake,
    *,
    late: str = "mark",
    with_undated: bool = True,
    dimensions: str = "upsert",
    on_change: str = "update",
    null_safe: bool = True,
    on_duplicate: str = "fail",
    manufacturer_by_name: bool = False,
    stamp: dt.datetime | None = None,
    limits: Limits = Limits(),
    max_records_per_file: int | None = None,
    database: str | None = None,
) -> int | None:
    """Load what silver got since the last load; the batch number, or None if nothing is new.

    ``late='mark'`` takes sales dated after the fact's latest one, and the new batches' sales
    without a date unless ``with_undated`` is false; how many of the new batches are left behind
    is recorded. ``'ledger'`` takes the new batches whatever their dates, late sales included.
    ``dimensions='upsert'`` keeps known members and their keys; ``'replace'`` makes each
    dimension anew from the slice, keys from 1, which leaves earlier fact rows behind.
    ``database`` as for :func:`load_full`.
    """
    pending = lake.ledger.pending(SILVER, GOLD)
    if not pending:
        return None
    batch_id = pending[-1]
    stamp = stamp or now()
    before = lake.ledger.current_versions()
    silver = lake.silver_sales()
    left: dict[str, int] = {}
    if late == "ledger":
        rows = slice_of_batches(silver, pending)
    else:
        mark = before[FACT].max_date if FACT in before else None
        new = lake.silver_sales(pending)
        # rows are told apart by their place in files, which a union doesn't know
        placed = with_place if lake.fmt == "parquet" else lambda scan: scan
        rows = slice_after(placed(silver), mark)
        if mark is not None:
            left["left_late"] = late_sales(new, pending, mark).count()
            if with_undated:
                rows = rows.unionByName(undated(placed(new), pending))
            else:
                left["left_undated"] = undated(new, pending).count()
    if dimensions == "replace":
        tables = build_dimensions(rows, null_safe=null_safe, limits=limits)
        tables = {name: stamped(table, stamp) for name, table in tables.items()}
        at = _write_dimensions(lake, tables, batch_id, before)
    else:
        at = _upsert_dimensions(
            lake,
            rows,
            before,
            batch_id,
            on_change=on_change,
            null_safe=null_safe,
            stamp=stamp,
            limits=limits,
        )
    version = before[FACT].version if FACT in before else 1
    at[FACT], counts = _write_fact(
        lake,
        rows,
        at,
        version,
        batch_id,
        before.get(FACT),
        stamp=stamp,
        on_duplicate=on_duplicate,
        by_name=manufacturer_by_name,
        limits=limits,
        max_records_per_file=max_records_per_file,
        database=database,
    )
    _record(lake, at, batch_id, stamp, left | counts)
    return batch_id


def _upsert_dimensions(
    lake: Lake,
    rows: DataFrame,
    before: Versions,
    batch_id: int,
    *,
    on_change: str,
    null_safe: bool,
    stamp: dt.datetime,
    limits: Limits,
) -> Versions:
    """Bring every dimension up to date.

    New members are added as a batch of the current version; the members already there are
    neither read twice nor rewritten. Only a changed member makes a new version, and a
    dimension the batch does not touch is not written.
    """
    incoming = incoming_members(rows)
    at: Versions = {}

    def bring(spec) -> None:
        held = before.get(spec.name)
        existing = lake.gold_table(spec.name, held)
        found = incoming[spec]
        if spec.parent:
            parent = lake.gold_table(spec.parent.name, at[spec.parent.name])
            found = with_parent_key(found, spec, parent, null_safe=null_safe, limits=limits)
        change = upsert(existing, found, spec, on_change=on_change, stamp=stamp)
        new, changed = change.counts()
        version = (held.version if held else 1) + (1 if changed else 0)
        fresh = None
        if changed:
            fresh = change.snapshot()
        elif new or not held:
            fresh = change.added()
        at[spec.name] = _added(lake, fresh, spec.name, version, batch_id, held)

    independent = [d for d in DIMENSIONS if d.parent is None]
    concurrently(lake.spark, [lambda d=d: bring(d) for d in independent])
    bring(CUSTOMER)
    return at


def compact_fact(
    lake: Lake, stamp: dt.datetime | None = None, max_records_per_file: int | None = None
) -> None:
    """Write the batches of the fact together, by month, as its next version.

    Many small batches make many small files per month. Rows stay as they are; who reads the
    version before is not disturbed, as its files stay where they are.
    """
    at = lake.ledger.current_versions().get(FACT)
    if at is None or len(at.parts) < 2:
        return
    rows = gathered(lake.gold_table(FACT, at), *PERIOD)
    whole = _added(
        lake, rows, FACT, at.version + 1, at.batch_id, None,
        partition_by=PERIOD, max_records_per_file=max_records_per_file,
    )
    whole = Current(whole.version, whole.batch_id, whole.parts, at.max_date)
    _record(lake, {FACT: whole}, at.batch_id, stamp)
