"""The registered queries.  Each takes (spark, sf_dir) and reads the whole event table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from realmwatch.functions.enctypes import enctype_dim, extend_enctypes, tokens
from realmwatch.functions.text import principal_host
from realmwatch.operators import audit, failures, joins, last_seen, lists, merge, slices, trends
from realmwatch.plans.batch import load_events, run_batch
from realmwatch.plans.folders import Folder, scratch_dir
from realmwatch.plans.store import TABLES, SummaryStore
from realmwatch.plans.views import register_functions, register_views
from realmwatch.schemas import CLIENT_SLICES
from realmwatch.sources import bridge, logs, parser
from realmwatch.sources.growing import scan_growing
from realmwatch.sources.tables import read_logs, union_logs
from realmwatch.streaming.incremental import (
    FOLDS_AT_ONCE,
    catch_up,
    parse_stream,
    run_incremental,
    run_native_princ,
    run_native_slices,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed value: 2024-01-31 00:00 UTC, the retention query's present.
AS_OF, KEEP_DAYS = 1706659200, 10
# Fixed value: lines of a batch.
LINES_PER_BATCH = 10_000
# Fixed value: batches of so few lines that are folded as one.
BATCHES_PER_FOLD = 100
# Fixed value: days that a closed window waits for late lines.
OPEN_DAYS = 2


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.log_events(bridge.read_events(spark, sf_dir))


def _success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.success_events(_log(spark, sf_dir))


def _failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.failure_events(_log(spark, sf_dir))


def _halves(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    return bridge.older(table), bridge.newer(table)


# -- raw lines and parsing -------------------------------------------------------------


@query
def filter_kdc_lines(spark, sf_dir):
    return logs.kdc_lines(bridge.noisy_lines(_log(spark, sf_dir)))


@query
def filter_local_tgt(spark, sf_dir):
    return logs.drop_local_tgt(bridge.noisy_lines(_log(spark, sf_dir)))


def _parsed(spark, sf_dir) -> DataFrame:
    return parser.parse_events(bridge.raw_lines(_log(spark, sf_dir)))


@query
def parse_header(spark, sf_dir):
    return _parsed(spark, sf_dir).select("event_id", "log_time", "kdc")


@query
def parse_request(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "event_id", "req_type", "ip", "req_enctypes", "req_enctypes_orig"
    )


@query
def parse_success(spark, sf_dir):
    return parser.successes(_parsed(spark, sf_dir))


@query
def parse_failure(spark, sf_dir):
    return parser.failures(_parsed(spark, sf_dir))


@query
def clean_fields(spark, sf_dir):
    events = parser.parse_events(bridge.soiled_lines(_log(spark, sf_dir)))
    return events.select(
        "event_id", "kdc", "req_enctypes", "req_enctypes_orig", "authtime", "client_name",
        "server_name", "reply_enctype", "session_enctype", "code", "reason",
    )


@query
def route_counts(spark, sf_dir):
    table = (
        F.when(F.col("outcome") == parser.SUCCEEDED, "log_entry_success")
        .when(F.col("outcome") == parser.FAILED, "log_entry_fail")
        .otherwise("rejected")
    )
    events = parser.parse_events(bridge.broken_lines(_log(spark, sf_dir)))
    return events.groupBy(table.alias("table_name")).agg(F.count("*").alias("nrows"))


@query
def rejects(spark, sf_dir):
    return parser.rejects(parser.parse_events(bridge.broken_lines(_log(spark, sf_dir))))


@query
def parse_odd_failures(spark, sf_dir):
    """Refusals without a comma or without names, with extra blanks, with a code that cleans to ISSUE."""
    return parser.failures(parser.parse_events(bridge.odd_refusals(_log(spark, sf_dir))))


@query
def reject_odd_failures(spark, sf_dir):
    """What is reported of them: kept events that name nobody."""
    reports = parser.rejects(parser.parse_events(bridge.odd_refusals(_log(spark, sf_dir))))
    return reports.groupBy("reason", "kept").agg(F.count("*").alias("nlines"))


@query
def row_constraints(spark, sf_dir):
    """Events that break a rule of their table, by the rule; each rule is broken by some."""
    log = _log(spark, sf_dir)
    gone = {n: F.when(F.col("event_id") % 13 == i, None).otherwise(F.col(n)) for i, n in enumerate(_RULED)}
    kind = F.when(F.col("event_id") % 17 == 16, F.lit(2)).otherwise(F.col("req_type"))
    log = log.withColumns(gone).withColumn("req_type", kind)
    won = audit.invalid_rows(bridge.success_events(log)).select(F.lit(0).alias("failed"), "problem")
    lost = audit.invalid_rows(bridge.failure_events(log), failed=True).select(F.lit(1).alias("failed"), "problem")
    return won.unionByName(lost).groupBy("failed", "problem").agg(F.count("*").alias("nrows"))


_RULED = ["ip", "authtime", "client_name", "session_enctype"]


@query
def union_logs_by_kdc(spark, sf_dir):
    success = _success(spark, sf_dir)
    per_host = [success.where(F.col("kdc") == f"kdc{i}") for i in range(3)]
    return union_logs(*per_host).groupBy("kdc").agg(
        F.count("*").alias("nrows"), F.max("log_time").alias("last_time")
    )


QUERIES["union_logs"] = QUERIES.pop("union_logs_by_kdc")

# -- enctype lists ---------------------------------------------------------------------


def _varied(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    log = bridge.varied_lists(_log(spark, sf_dir))
    return bridge.success_events(log), bridge.failure_events(log)


@query
def enctype_dim_extended(spark, sf_dir):
    """The reference data, plus every enctype number the events offer or use."""
    log = bridge.varied_lists(_log(spark, sf_dir))
    used = F.array(*[F.col(c) for c in joins.ROLES.values()])
    offered = F.transform(tokens(F.col("req_enctypes_orig")), lambda t: t.cast("int"))
    seen = log.select(F.explode(F.array_union(used, offered)).alias("enctype")).distinct()
    additions = seen.select(
        "enctype",
        F.concat(F.lit("etype-"), F.col("enctype")).alias("name"),
        F.lit(0).alias("is_modern"),
        F.lit(0).alias("is_weak"),
    )
    return extend_enctypes(enctype_dim(spark), additions)


QUERIES["enctype_dim"] = QUERIES.pop("enctype_dim_extended")


@query
def list_canonical(spark, sf_dir):
    log = bridge.varied_lists(_log(spark, sf_dir))
    return log.select("event_id", "req_enctypes_orig", "req_enctypes")


@query
def list_discovery(spark, sf_dir):
    success, failure = _varied(spark, sf_dir)
    (success_a, success_b), (failure_a, failure_b) = _halves(success), _halves(failure)
    known = lists.discover_lists(success_a, failure_a)
    return lists.discover_lists(success_b, failure_b, known)


@query
def list_members(spark, sf_dir):
    return lists.list_members(lists.discover_lists(*_varied(spark, sf_dir)))


@query
def list_sequence(spark, sf_dir):
    return lists.list_sequence(lists.discover_lists(*_varied(spark, sf_dir)))


@query
def list_flags(spark, sf_dir):
    return lists.list_flags(lists.discover_lists(*_varied(spark, sf_dir)))


# -- joins -----------------------------------------------------------------------------


@query
def join_lists(spark, sf_dir):
    success = _success(spark, sf_dir)
    dim = lists.list_flags(lists.discover_lists(success))
    joined = joins.join_lists(success, dim)  # adaptive execution broadcasts it if it proves small
    return joined.select("event_id", "list_modern", "list_weak", "list_too_weak")


@query
def join_roles(spark, sf_dir):
    log = bridge.unknown_session_keys(_log(spark, sf_dir))
    joined = joins.join_roles(bridge.success_events(log), enctype_dim(spark))
    return joined.select("event_id", "reply_weak", "session_weak", "ticket_weak")


@query
def forwarded_tgt(spark, sf_dir):
    return joins.forwarded_tgt(_success(spark, sf_dir))


@query
def adhoc_weak_clients(spark, sf_dir):
    """Events of addresses whose last weak AS request is newer than the last strong one."""
    success = _success(spark, sf_dir)
    register_views(spark, log_entry_success=success, client=last_seen.client_last_seen(success))
    return spark.sql(
        """SELECT s.event_id, s.ip, s.client_name, s.log_time, c.last_weak_as, c.last_strong_as
           FROM log_entry_success s JOIN client c ON s.ip = c.ip
           WHERE c.last_weak_as > c.last_strong_as"""
    )


@query
def adhoc_sql_functions(spark, sf_dir):
    """The model's functions called from SQL alone."""
    register_functions(spark)
    register_views(spark, log_entry_success=_success(spark, sf_dir))
    return spark.sql(
        """SELECT event_id, canonical_list(req_enctypes_orig) AS listing, list_is_weak(req_enctypes) AS weak,
             list_is_modern(req_enctypes) AS modern, list_is_too_weak(req_enctypes) AS too_weak,
             enctype_is_weak(session_enctype) AS session_weak, day_start(log_time) AS day,
             principal_host(server_name) AS host
           FROM log_entry_success WHERE day_start(authtime) = day_start(log_time)"""
    )


# -- folds -----------------------------------------------------------------------------


@query
def client_last_seen(spark, sf_dir):
    return last_seen.client_last_seen(_success(spark, sf_dir))


@query
def princ_client_success(spark, sf_dir):
    return last_seen.princ_client_success(_success(spark, sf_dir))


@query
def princ_server_success(spark, sf_dir):
    return last_seen.princ_server_success(_success(spark, sf_dir))


@query
def princ_client_fail(spark, sf_dir):
    return last_seen.princ_client_fail(_failure(spark, sf_dir))


@query
def princ_server_fail(spark, sf_dir):
    return last_seen.princ_server_fail(_failure(spark, sf_dir))


@query
def princ_last_seen(spark, sf_dir):
    return last_seen.princ_last_seen(_success(spark, sf_dir), _failure(spark, sf_dir))


@query
def ccs_last_seen(spark, sf_dir):
    return last_seen.ccs_last_seen(_success(spark, sf_dir))


@query
def client_slices(spark, sf_dir):
    return slices.client_slices(_success(spark, sf_dir))


@query
def princ_slices(spark, sf_dir):
    return slices.princ_slices(_success(spark, sf_dir))


@query
def ccs_slices(spark, sf_dir):
    return slices.slice_rates(slices.ccs_slices(_success(spark, sf_dir)))


# -- merges, rates, retention ----------------------------------------------------------


def _upserted(name: str, older: DataFrame, newer: DataFrame) -> DataFrame:
    table = TABLES[name]
    return merge.upsert(older, newer, table.keys, table.how)


@query
def upsert_client(spark, sf_dir):
    a, b = _halves(_success(spark, sf_dir))
    return _upserted("client", last_seen.client_last_seen(a), last_seen.client_last_seen(b))


@query
def upsert_princ(spark, sf_dir):
    (won_a, won_b), (lost_a, lost_b) = _halves(_success(spark, sf_dir)), _halves(_failure(spark, sf_dir))
    return _upserted(
        "princ", last_seen.princ_last_seen(won_a, lost_a), last_seen.princ_last_seen(won_b, lost_b)
    )


@query
def upsert_ccs(spark, sf_dir):
    a, b = _halves(_success(spark, sf_dir))
    return _upserted("client_cname_sname", last_seen.ccs_last_seen(a), last_seen.ccs_last_seen(b))


@query
def upsert_client_slices(spark, sf_dir):
    a, b = _halves(_success(spark, sf_dir))
    return _upserted("client_slice_data", slices.client_slices(a), slices.client_slices(b))


@query
def upsert_princ_slices(spark, sf_dir):
    a, b = _halves(_success(spark, sf_dir))
    return _upserted("princ_slice_data", slices.princ_slices(a), slices.princ_slices(b))


@query
def client_slice_rates(spark, sf_dir):
    return slices.slice_rates(slices.client_slices(_success(spark, sf_dir)))


@query
def princ_slices_extended(spark, sf_dir):
    """With the site's own enctypes no event of an unknown session key is lost."""
    success = bridge.success_events(bridge.unknown_session_keys(_log(spark, sf_dir)))
    return slices.princ_slices(success, enctypes=_site_enctypes(spark))


@query
def ccs_slices_extended(spark, sf_dir):
    success = bridge.success_events(bridge.unknown_session_keys(_log(spark, sf_dir)))
    return slices.ccs_slices(success, _site_enctypes(spark))


def _site_enctypes(spark) -> DataFrame:
    own = spark.sql("SELECT 99 AS enctype, 'site-99' AS name, 1 AS is_modern, 0 AS is_weak")
    return extend_enctypes(enctype_dim(spark), own)


@query
def prune_all_slices(spark, sf_dir):
    """The three slice tables with the same days left out of each."""
    success = _success(spark, sf_dir)
    made = {
        "client": slices.client_slices(success),
        "princ": slices.princ_slices(success),
        "ccs": slices.ccs_slices(success),
    }
    kept = [
        slices.prune(table, KEEP_DAYS, AS_OF).select(F.lit(name).alias("slices"), "starttime", "nentries")
        for name, table in made.items()
    ]
    return union_logs(*kept).groupBy("slices", "starttime").agg(
        F.count("*").alias("nrows"), F.sum("nentries").alias("nentries")
    )


@query
def princ_slice_rates(spark, sf_dir):
    return slices.princ_request_rates(slices.princ_slices(_success(spark, sf_dir)))


@query
def prune_slices(spark, sf_dir):
    return slices.prune(slices.client_slices(_success(spark, sf_dir)), KEEP_DAYS, AS_OF)


# -- the batch workflow through files --------------------------------------------------


def _two_loads(spark, sf_dir, **options) -> tuple[SummaryStore, str]:
    """Both halves of the log, each loaded from its own files under its own batch id."""
    root = scratch_dir(spark, "loads")
    store = SummaryStore(spark, f"{root}/store")
    for batch_id, half in (("load-a", bridge.older), ("load-b", bridge.newer)):
        path = _lines_in(root, f"lines-{batch_id}", half(_log(spark, sf_dir)))
        run_batch(spark, path, f"{root}/events", store, batch_id, **options)
    return store, f"{root}/events"


@query
def batch_two_loads(spark, sf_dir):
    """Events of both loads read back: the second leaves the first as it is."""
    loaded = read_logs(spark, _two_loads(spark, sf_dir)[1])
    parts = [
        events.select(F.lit(name).alias("outcome"), "log_time", "ip", "client_name", "server_name")
        for name, events in (("success", loaded.success), ("failure", loaded.failure))
    ]
    return union_logs(*parts).groupBy("outcome", "log_time", "ip", "client_name", "server_name").agg(
        F.count("*").alias("nrows")
    )


@query
def store_princ(spark, sf_dir):
    return _two_loads(spark, sf_dir)[0].read("princ")


@query
def store_princ_slice_rates(spark, sf_dir):
    """Rates of slices into which failures and tickets were merged."""
    store, _ = _two_loads(spark, sf_dir, failures_too=True, tickets=True, triples=True)
    rated = store.read_rates("princ_slice_data")
    return rated.select("name", "starttime", "nfail", *[c for c in rated.columns if c.endswith("_rate")])


@query
def batch_constraints(spark, sf_dir):
    """A load of events of which some break a rule: counts of reports, and of entries that were folded."""
    root = scratch_dir(spark, "constraints")
    store = SummaryStore(spark, f"{root}/store")
    events = parser.parse_events(bridge.raw_lines(_log(spark, sf_dir)))
    gone = {n: F.when(F.col("event_id") % 13 == i, None).otherwise(F.col(n)) for i, n in enumerate(_RULED)}
    kind = F.when(F.col("event_id") % 17 == 16, F.lit(2)).otherwise(F.col("req_type"))
    load_events(events.withColumns(gone).withColumn("req_type", kind), f"{root}/events", store, "load")
    folded = store.read("client_slice_data").agg(F.sum("nentries").alias("nlines"))
    return store.read("report_counts").unionByName(folded.selectExpr("'folded' AS reason", "1 AS kept", "nlines"))


# -- audits ----------------------------------------------------------------------------


@query
def audit_duplicates(spark, sf_dir):
    """Client slices of the whole log beside those of its older half."""
    success = _success(spark, sf_dir)
    rows = slices.client_slices(success).unionByName(slices.client_slices(bridge.older(success)))
    return audit.duplicate_keys(rows, TABLES["client_slice_data"].keys)


@query
def audit_orphans(spark, sf_dir):
    """Triples whose client has no principal row because its reply enctype is unknown."""
    success = bridge.success_events(bridge.unknown_reply_keys(_log(spark, sf_dir)))
    clients = last_seen.princ_client_success(success)
    return audit.orphans(last_seen.ccs_last_seen(success), clients, {"cname": "name"})


@query
def audit_references(spark, sf_dir):
    """Every reference of the model, with parents that some of the keys were taken out of."""
    log = bridge.varied_lists(_log(spark, sf_dir))
    success, failure = bridge.success_events(log), bridge.failure_events(log)
    found = lists.discover_lists(success, failure)
    tables = {
        "client": last_seen.client_last_seen(success).where("ip NOT LIKE '10.0.3.%'"),
        "princ": last_seen.princ_last_seen(success, failure).where("name NOT LIKE 'u1%' AND name NOT LIKE 'host/h3%'"),
        "req_enctypes_lists": lists.list_flags(found).where("enctype_list NOT LIKE '%-%'"),
        "req_enctypes_normal": lists.list_members(found),
        "client_cname_sname": last_seen.ccs_last_seen(success),
        "client_slice_data": slices.client_slices(success),
        "princ_slice_data": slices.princ_slices(success),
        "ccs_slice_data": slices.ccs_slices(success),
    }
    return audit.broken_references(tables)


@query
def audit_unknown_enctypes(spark, sf_dir):
    log = bridge.unknown_session_keys(_log(spark, sf_dir))
    return audit.unknown_enctypes(bridge.success_events(log))


# -- streams ---------------------------------------------------------------------------


def _lines_in(root: str, name: str, log: DataFrame) -> str:
    """Render the log to text files in a folder the stream then reads."""
    path = f"{root}/{name}"
    bridge.raw_lines(log).select("value").write.text(path)
    return path


def _streamed(spark, sf_dir, *batches: Callable[[DataFrame], DataFrame]) -> SummaryStore:
    """Feed parts of the log, in the order given, through one stream into a new store."""
    root = scratch_dir(spark, "stream")
    store = SummaryStore(spark, f"{root}/store")
    log = _log(spark, sf_dir)
    for number, part in enumerate(batches):
        _lines_in(f"{root}/lines", f"part={number}", part(log))
        # the same query resumes from its checkpoint and sees only the new files
        lines = logs.scan_stream(spark, f"{root}/lines").select("value")
        run_incremental(lines, store, f"{root}/checkpoint").awaitTermination()
    return store


@query
def stream_parse(spark, sf_dir):
    root = scratch_dir(spark, "parse")
    path = _lines_in(root, "lines", _log(spark, sf_dir))
    parse_stream(logs.scan_stream(spark, path), f"{root}/events", f"{root}/checkpoint").awaitTermination()
    return read_logs(spark, f"{root}/events").success


@query
def stream_client_slices(spark, sf_dir):
    return _streamed(spark, sf_dir, bridge.older, bridge.newer).read("client_slice_data")


@query
def stream_princ(spark, sf_dir):
    return _streamed(spark, sf_dir, bridge.older, bridge.newer).read("princ")


@query
def stream_late_data(spark, sf_dir):
    return _streamed(spark, sf_dir, bridge.newer, bridge.older).read("client_slice_data")


@query
def stream_retention(spark, sf_dir):
    """Slices kept by a stream that drops those older than the given time, whatever a line claims."""
    root = scratch_dir(spark, "retention")
    store = SummaryStore(spark, f"{root}/store")
    bridge.future_lines(_log(spark, sf_dir)).select("value").write.text(f"{root}/lines")
    run_incremental(
        logs.scan_stream(spark, f"{root}/lines"), store, f"{root}/checkpoint",
        compact_every=1, days=KEEP_DAYS, as_of=AS_OF,
    ).awaitTermination()
    return store.read("client_slice_data")


@query
def stream_two_sources(spark, sf_dir):
    """Two streams with checkpoints of their own fold into one store."""
    root = scratch_dir(spark, "sources")
    store = SummaryStore(spark, f"{root}/store")
    for name, half in (("a", bridge.older), ("b", bridge.newer)):
        path = _lines_in(root, f"lines-{name}", half(_log(spark, sf_dir)))
        run_incremental(logs.scan_stream(spark, path), store, f"{root}/checkpoint-{name}").awaitTermination()
    return store.read("client_slice_data")


@query
def stream_reject_counts(spark, sf_dir):
    """Lines to be reported, counted by the stream itself."""
    root = scratch_dir(spark, "reports")
    store = SummaryStore(spark, f"{root}/store")
    bridge.broken_lines(_log(spark, sf_dir)).select("value").write.text(f"{root}/lines")
    run_incremental(logs.scan_stream(spark, f"{root}/lines"), store, f"{root}/checkpoint").awaitTermination()
    return store.read("report_counts")


@query
def stream_growing_file(spark, sf_dir):
    """Logs read while they are written, in batches of so many lines: a stop inside a line, a rename, and a
    restart from the checkpoint after each."""
    root = scratch_dir(spark, "growing")
    store = SummaryStore(spark, f"{root}/store")
    written = spark.read.format("binaryFile").load(_lines_in(root, "whole", _log(spark, sf_dir)))
    files = written.select(F.col("path").alias("file"))
    Folder(spark, f"{root}/live").make()
    for step in range(3):
        bridge.grow_logs(files, f"{root}/live", step)
        # batches that wait are read, and folds of so many of them run, side by side
        lines = scan_growing(
            spark, f"{root}/live", lines_per_batch=LINES_PER_BATCH, batches_per_trigger=FOLDS_AT_ONCE * BATCHES_PER_FOLD
        ).select("value", "batch")
        stream = run_incremental(
            lines, store, f"{root}/checkpoint", every="0 seconds", fold_every=BATCHES_PER_FOLD
        )
        catch_up(stream, store)
    return store.read("client_slice_data")


@query
def stream_native_slices(spark, sf_dir):
    """Slices of closed days, kept and closed by Spark's own state; lines of closed days come late and are dropped."""
    root = scratch_dir(spark, "native")
    log = _log(spark, sf_dir)
    for number, part in enumerate((bridge.older, bridge.newer, bridge.older)):
        _lines_in(f"{root}/lines", f"part={number}", part(log))
        lines = logs.scan_stream(spark, f"{root}/lines").select("value")
        run_native_slices(lines, f"{root}/slices", f"{root}/checkpoint", days=OPEN_DAYS).awaitTermination()
    return spark.read.schema(CLIENT_SLICES).parquet(f"{root}/slices")


@query
def stream_native_princ(spark, sf_dir):
    """Principals from the state of a stream that hands only the changed ones to the store."""
    root = scratch_dir(spark, "native-princ")
    store = SummaryStore(spark, f"{root}/store")
    log = _log(spark, sf_dir)
    for number, part in enumerate((bridge.newer, bridge.older)):
        _lines_in(f"{root}/lines", f"part={number}", part(log))
        lines = logs.scan_stream(spark, f"{root}/lines").select("value")
        run_native_princ(lines, store, f"{root}/checkpoint").awaitTermination()
    return store.read("princ")


# -- completions of what the model declares --------------------------------------------


@query
def ext_running_avg(spark, sf_dir):
    rated = slices.slice_rates(slices.client_slices(_success(spark, sf_dir)))
    return _rounded(trends.running_averages(rated, ["ip", "is_success"]))


@query
def ext_period_averages(spark, sf_dir):
    rated = slices.slice_rates(slices.client_slices(_success(spark, sf_dir)))
    return _rounded(trends.period_averages(rated))


def _rounded(table: DataFrame) -> DataFrame:
    """Averages to nine digits: their last bits depend on the order of addition."""
    return table.select(
        *[F.round(c, 9).alias(c) if c.endswith("_avg") else F.col(c) for c in table.columns]
    )


@query
def ext_decayed_avg(spark, sf_dir):
    """Decayed averages kept through two batches, the newer one first."""
    a, b = _halves(_success(spark, sf_dir))
    kept = [trends.decayed_counts(slices.client_slices(half), ["ip", "is_success"]) for half in (b, a)]
    averages = trends.decayed_averages(_upserted("client_average_data", *kept), ["ip", "is_success"])
    rounded = [F.round(c, 9).alias(c) for c in averages.columns if c == "weight" or c.endswith("_avg")]
    return averages.select("ip", "is_success", "last_start", *rounded)


@query
def ext_trend_slopes(spark, sf_dir):
    rated = slices.slice_rates(slices.client_slices(_success(spark, sf_dir)))
    slopes = trends.trend_slopes(rated, ["ip", "is_success"])
    return slopes.select(*[F.round(c, 9).alias(c) if c.endswith("_slope") else F.col(c) for c in slopes.columns])


@query
def ext_failure_templates(spark, sf_dir):
    """Templates of varied reasons; hosts are told to be variable by their number."""
    failure = bridge.failure_events(bridge.varied_reasons(_log(spark, sf_dir)))
    return failures.failure_templates(failure, most=8)


@query
def ext_client_last_fail(spark, sf_dir):
    seen = last_seen.client_last_seen(_success(spark, sf_dir))
    return _upserted("client", seen, last_seen.client_last_fail(_failure(spark, sf_dir)))


@query
def ext_fail_slices(spark, sf_dir):
    return slices.client_slices(_failure(spark, sf_dir), is_success=0)


@query
def ext_princ_fail_slices(spark, sf_dir):
    return slices.princ_fail_slices(_failure(spark, sf_dir)).select(
        "name", "starttime", "endtime", "nentries", "nfail"
    )


@query
def ext_princ_host(spark, sf_dir):
    seen = last_seen.princ_last_seen(_success(spark, sf_dir), _failure(spark, sf_dir))
    return seen.select("name", principal_host(F.col("name")).alias("host"), "last_used")


@query
def ext_ticket_slices(spark, sf_dir):
    counted = slices.ticket_slices(_success(spark, sf_dir), _failure(spark, sf_dir))
    rated = slices.ticket_rates(counted)
    return rated.select(
        "name", "starttime", "endtime", "nentries", *[c for c in rated.columns if "ticket_" in c]
    )
