"""Authentication log events derived from a generic event table.

The event table (event_id, ts, user_id, event_type) holds no authentication logs, so each
of its rows is projected to one log event, and log events can be rendered as raw lines.
Everything is an expression per row: the log grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from realmwatch.functions.enctypes import canonical_list
from realmwatch.schemas import FAILURE, REQ_AS, REQ_TGS, SUCCESS

# Fixed values of the projection: texts picked by a number.
LISTS = ["18 17 16 23", "18 18 17 23", "1 3 18", "23 18 17", "3 1", "18 25 1", "1 1 18", "18 17 18 1"]
REPLY = [18, 17, 23, 1]
TICKET = [18, 17, 16, 23, 3]
SESSION = [18, 17, 23, 1, 18, 3, 16]
REALM = "EXAMPLE.COM"
# 2024-01-16, where the log is split in an older batch A and a newer batch B
BATCH_SPLIT = "TIMESTAMP_NTZ'2024-01-16 00:00:00'"


def _cycle(values: list, number: str = "event_id") -> str:
    """SQL text that picks one of the values by a number."""
    items = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"element_at(array({items}), CAST({number} % {len(values)} AS int) + 1)"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def log_events(events: DataFrame) -> DataFrame:
    """Log events with the columns of both event tables, `event_id` and `ts`."""
    epoch = "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"
    columns = {
        "log_time": epoch,
        "kdc": "concat('kdc', event_id % 3)",
        "ip": "concat('10.0.', user_id % 7, '.', user_id % 50)",
        "req_type": f"CASE WHEN event_type IN ('signup', 'view') THEN {REQ_AS} ELSE {REQ_TGS} END",
        "req_enctypes_orig": _cycle(LISTS),
        "authtime": f"{epoch} - {epoch} % 36000",
        "client_name": f"concat('u', user_id, '@{REALM}')",
        "server_name": f"""CASE WHEN event_type IN ('signup', 'view') THEN 'krbtgt/{REALM}@{REALM}'
            WHEN event_id % 3 = 0 THEN 'krbtgt/OTHER.COM@{REALM}'
            ELSE concat('host/h', event_id % 11, '.example.com@{REALM}') END""",
        "reply_enctype": _cycle(REPLY),
        "ticket_enctype": _cycle(TICKET),
        "session_enctype": _cycle(SESSION),
        "code": """CASE WHEN event_type <> 'error' THEN 'ISSUE'
            WHEN event_id % 2 = 0 THEN 'NEEDED_PREAUTH' ELSE 'CLIENT_NOT_FOUND' END""",
        "reason": """CASE WHEN event_id % 2 = 0 THEN 'Additional pre-authentication required'
            ELSE 'Client not found in Kerberos database' END""",
    }
    projected = events.selectExpr(
        "event_id", "user_id", "ts", "event_type", *[f"{text} AS {name}" for name, text in columns.items()]
    )
    return projected.withColumn("req_enctypes", canonical_list(F.col("req_enctypes_orig")))


def varied_lists(log: DataFrame) -> DataFrame:
    """The log with offered lists of many shapes, whose number grows with the log.

    They hold zero to five enctypes: known, unknown, negative and repeated ones.
    """
    picks = """array(event_id % 26, CASE WHEN event_id % 3 = 0 THEN event_id % 26 ELSE user_id % 25 END,
        (event_id * 7 + user_id) % 27, -(4094 + event_id % 9), 16 + user_id % 9)"""
    listing = F.expr(f"array_join(CAST(slice({picks}, 1, CAST(event_id % 6 AS int)) AS array<string>), ' ')")
    varied = log.withColumn("req_enctypes_orig", listing)
    orig = F.col("req_enctypes_orig")
    return varied.withColumn("req_enctypes", F.when(orig == "", "0").otherwise(canonical_list(orig)))


def unknown_session_keys(log: DataFrame) -> DataFrame:
    """The log with an unknown session enctype now and then."""
    return log.withColumn(
        "session_enctype", F.when(F.col("event_id") % 97 == 0, 99).otherwise(F.col("session_enctype"))
    )


def unknown_reply_keys(log: DataFrame) -> DataFrame:
    """The log with an unknown reply enctype in every answer to some clients."""
    return log.withColumn(
        "reply_enctype", F.when(F.col("user_id") % 10 == 3, 99).otherwise(F.col("reply_enctype"))
    )


def success_events(log: DataFrame) -> DataFrame:
    return log.where("event_type <> 'error'").select("event_id", "ts", *SUCCESS.names)


def failure_events(log: DataFrame) -> DataFrame:
    return log.where("event_type = 'error'").select("event_id", "ts", *FAILURE.names)


def older(log: DataFrame) -> DataFrame:
    return log.where(F.expr(f"ts < {BATCH_SPLIT}"))


def newer(log: DataFrame) -> DataFrame:
    return log.where(F.expr(f"ts >= {BATCH_SPLIT}"))


ISO = "replace(substring(CAST(ts AS string), 1, 19), ' ', 'T')"


def line_text(**parts: str) -> str:
    """SQL text for the raw line of a log event; any part can be given another text."""
    part = {n: parts.get(n, n) for n in {*SUCCESS.names, *FAILURE.names}}
    stamp = parts.get("stamp", f"{ISO}, '+0000'")
    offered = part["req_enctypes_orig"]
    parties = f"{part['client_name']}, ' for ', {part['server_name']}"
    return f"""concat({stamp}, ' ', {part['kdc']}, ' krb5kdc[', event_id % 100, '](info): ',
        CASE WHEN req_type = {REQ_AS} THEN 'AS_REQ' ELSE 'TGS_REQ' END,
        ' (', size(split({offered}, ' ')), ' etypes {{', {offered}, '}}) ', {part['ip']}, ': ', code, ': ',
        CASE WHEN code = 'ISSUE' THEN concat('authtime ', {part['authtime']},
            ', etypes {{rep=', {part['reply_enctype']}, ' tkt=', {part['ticket_enctype']},
            ' ses=', {part['session_enctype']}, '}}, ', {parties})
        ELSE concat({parties}, ', ', {part['reason']}) END)"""


def raw_lines(log: DataFrame) -> DataFrame:
    """One raw line per log event, beside its event_id."""
    return log.selectExpr("event_id", f"{line_text()} AS value")


def noisy_lines(log: DataFrame) -> DataFrame:
    """Raw lines with a line of another daemon and a local-realm request after each."""
    other = f"concat({ISO}, '+0000 ', kdc, ' sshd[7]: Accepted publickey for ', client_name)"
    local = f"""concat({ISO}, '+0000 ', kdc, ' krb5kdc[1](info): ',
        CASE WHEN event_id % 2 = 0 THEN 'TGS_REQ' ELSE 'AS_REQ' END, ' (1 etypes {{18}}) ', ip,
        ': ISSUE: authtime 1, etypes {{rep=18 tkt=18 ses=18}}, ', client_name, ' for ',
        CASE WHEN event_id % 4 = 0 THEN 'krbtgt/EX@EX.COM' ELSE 'krbtgt/{REALM}@{REALM}' END)"""
    return log.selectExpr(f"explode(array({line_text()}, {other}, {local})) AS value")


def soiled_lines(log: DataFrame) -> DataFrame:
    """Raw lines with stray quotes, percent signs and words where numbers belong."""

    def sometimes(name: str, modulus: int, text: str) -> str:
        return f"CASE WHEN event_id % {modulus} = 0 THEN '{text}' ELSE CAST({name} AS string) END"

    line = line_text(
        client_name='"\'%", client_name',
        server_name='server_name, "\'"',
        reason="'100% ', reason",
        kdc="'k%', kdc",
        req_enctypes_orig=sometimes("req_enctypes_orig", 7, "18,17"),
        authtime=sometimes("authtime", 5, "unknown"),
        reply_enctype=sometimes("reply_enctype", 6, "x9"),
        session_enctype=sometimes("session_enctype", 11, "99999999999"),
    )
    return log.selectExpr("event_id", f"{line} AS value")


def odd_refusals(log: DataFrame) -> DataFrame:
    """A refused request per log event, in five forms that a KDC may write."""
    before = f"""concat({ISO}, '+0000 ', kdc, ' krb5kdc[', event_id % 100, '](info): TGS_REQ (1 etypes {{18}}) ', ip, ': ')"""
    parties = "client_name, ' for ', server_name"
    line = f"""concat({before}, CASE event_id % 5
        WHEN 0 THEN concat('NEEDED_PREAUTH: ', {parties})
        WHEN 1 THEN concat('BAD_REQUEST: nobody named, ', reason)
        WHEN 2 THEN concat('LOOKING_UP:  ', {parties}, ', ', reason)
        WHEN 3 THEN concat('IS%SUE: ', {parties}, ', ', reason)
        ELSE concat('EXPIRED: authtime 0,   ', {parties}, ', ', reason) END)"""
    return log.selectExpr("event_id", f"{line} AS value")


def varied_reasons(log: DataFrame) -> DataFrame:
    """The log with reasons of five forms, three of them with a variable part."""
    reason = f"""CASE event_id % 5
        WHEN 0 THEN 'Additional pre-authentication required'
        WHEN 1 THEN concat('Client not found in Kerberos database: ', client_name)
        WHEN 2 THEN concat('Clock skew too great: ', event_id % 900, ' seconds from ', ip, '.')
        WHEN 3 THEN concat('Key table entry h', user_id, ' not found')
        ELSE 'Decrypt integrity check failed for /etc/krb5.keytab' END"""
    return log.withColumn("reason", F.expr(reason))


def future_lines(log: DataFrame) -> DataFrame:
    """Raw lines of which one in 499 carries the date of a clock that is far ahead."""
    ahead = line_text(stamp="concat('2099-01-01T00:00:00+0000')")
    line = f"CASE WHEN event_id % 499 = 0 THEN {ahead} ELSE {line_text()} END"
    return log.selectExpr("event_id", f"{line} AS value")


def grow_logs(written: DataFrame, folder: str, step: int) -> None:
    """Let log files below `folder` grow from the text files of `written` (`file`), as daemons would.

    Step 0 writes two fifths of each file, ending inside a line; step 1 appends what is missing up to the line end
    after seven tenths, and renames the file; step 2 writes the rest to a new file of the old name.
    """

    def grow(batches):
        from pyarrow import RecordBatch, array, fs, int64

        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, path = fs.FileSystem.from_uri(uri)
                target_system, target = fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)
                with system.open_input_file(path) as source:
                    size = source.size()
                    half = size * 2 // 5
                    turn = size * 7 // 10
                    while turn < size and source.read_at(1, turn) != b"\n":
                        turn += 1
                    turn = min(turn + 1, size)
                    first, last = ((0, half), (half, turn), (turn, size))[step]
                    live = f"{target}/kdc-{path.rsplit('/', 1)[-1].split('-')[1]}.log"
                    with target_system.open_append_stream(live) as out:
                        while first < last:
                            data = source.read_at(min(last - first, 1 << 20), first)
                            out.write(data)
                            first += len(data)
                    if step == 1:
                        target_system.move(live, f"{live}.1")
                yield RecordBatch.from_arrays([array([size], int64())], names=["size"])

    written.select("file").mapInArrow(grow, "size bigint").agg(F.sum("size")).collect()


def broken_lines(log: DataFrame) -> DataFrame:
    """Raw lines of which two in three are damaged, each in one of four ways."""
    syslog = line_text(stamp="date_format(CAST(ts AS date), 'MMM dd')")
    line = f"""CASE event_id % 6 WHEN 0 THEN {syslog} WHEN 1 THEN concat({ISO}, ' ', client_name)
        WHEN 2 THEN {line_text(req_enctypes_orig="''")} WHEN 3 THEN '' ELSE {line_text()} END"""
    return log.selectExpr("event_id", f"{line} AS value")
