"""SQL for each registered query, over the same event table, for a second engine.

Written apart from the operators: flags of the eight offered lists are stated by hand, and
list derivation is spelled out with unnest and windows.
"""

from __future__ import annotations

from realmwatch.functions.enctypes import SEED

_SEED = ", ".join(f"({e.enctype}, '{e.name}', {e.is_modern}, {e.is_weak})" for e in SEED)


def _case(number: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {number} % {len(values)} {whens} END"


def _texts(*values: str) -> list[str]:
    return [f"'{v}'" for v in values]


_ORIG = _case("event_id", _texts("18 17 16 23", "18 18 17 23", "1 3 18", "23 18 17", "3 1", "18 25 1", "1 1 18", "18 17 18 1"))
_CANON = _case("event_id", _texts("18 17 16 23", "18 17 23", "1 3 18", "23 18 17", "3 1", "18 25 1", "1 18", "18 17 18 1"))
_MODERN = _case("event_id", list("11110111"))
_WEAK = _case("event_id", list("00101111"))
_TOO_WEAK = _case("event_id", list("00100010"))

_LOG = f"""
log AS (SELECT event_id, user_id, ts, event_type,
  CAST(floor(epoch(ts)) AS BIGINT) AS log_time,
  'kdc' || CAST(event_id % 3 AS VARCHAR) AS kdc,
  '10.0.' || CAST(user_id % 7 AS VARCHAR) || '.' || CAST(user_id % 50 AS VARCHAR) AS ip,
  CASE WHEN event_type IN ('signup', 'view') THEN 0 ELSE 1 END AS req_type,
  {_CANON} AS req_enctypes, {_ORIG} AS req_enctypes_orig,
  CAST(floor(epoch(ts)) AS BIGINT) - CAST(floor(epoch(ts)) AS BIGINT) % 36000 AS authtime,
  'u' || CAST(user_id AS VARCHAR) || '@EXAMPLE.COM' AS client_name,
  CASE WHEN event_type IN ('signup', 'view') THEN 'krbtgt/EXAMPLE.COM@EXAMPLE.COM'
       WHEN event_id % 3 = 0 THEN 'krbtgt/OTHER.COM@EXAMPLE.COM'
       ELSE 'host/h' || CAST(event_id % 11 AS VARCHAR) || '.example.com@EXAMPLE.COM' END AS server_name,
  {_case("event_id", ["18", "17", "23", "1"])} AS reply_enctype,
  {_case("event_id", ["18", "17", "16", "23", "3"])} AS ticket_enctype,
  {_case("event_id", ["18", "17", "23", "1", "18", "3", "16"])} AS session_enctype,
  CASE WHEN event_type <> 'error' THEN 'ISSUE'
       WHEN event_id % 2 = 0 THEN 'NEEDED_PREAUTH' ELSE 'CLIENT_NOT_FOUND' END AS code,
  CASE WHEN event_id % 2 = 0 THEN 'Additional pre-authentication required'
       ELSE 'Client not found in Kerberos database' END AS reason,
  {_MODERN} AS lm, {_WEAK} AS lw, {_TOO_WEAK} AS ltw,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso
  FROM events),
ev AS (SELECT *, CASE WHEN reply_enctype IN (1, 3) THEN 1 ELSE 0 END AS rw,
  CASE WHEN session_enctype IN (1, 3) THEN 1 ELSE 0 END AS sw,
  CASE WHEN ticket_enctype IN (1, 3) THEN 1 ELSE 0 END AS tw,
  log_time - log_time % 86400 AS d FROM log),
ok AS (SELECT * FROM ev WHERE code = 'ISSUE'),
bad AS (SELECT * FROM ev WHERE code <> 'ISSUE')"""


def _sql(body: str, *ctes: str) -> str:
    return f"WITH {', '.join([_LOG.strip(), *ctes])}\n{body}"


def _line(
    stamp="iso || '+0000'", kdc="kdc", orig="req_enctypes_orig", client="client_name",
    server="server_name", authtime="CAST(authtime AS VARCHAR)",
    reply="CAST(reply_enctype AS VARCHAR)", session="CAST(session_enctype AS VARCHAR)", reason="reason",
) -> str:
    n = f"CAST(len(string_split({orig}, ' ')) AS VARCHAR)"
    return f"""({stamp} || ' ' || {kdc} || ' krb5kdc[' || CAST(event_id % 100 AS VARCHAR) || '](info): '
  || CASE WHEN req_type = 0 THEN 'AS_REQ' ELSE 'TGS_REQ' END || ' (' || {n} || ' etypes {{' || {orig} || '}}) '
  || ip || ': ' || code || ': ' || CASE WHEN code = 'ISSUE' THEN 'authtime ' || {authtime}
  || ', etypes {{rep=' || {reply} || ' tkt=' || CAST(ticket_enctype AS VARCHAR) || ' ses=' || {session} || '}}, '
  || {client} || ' for ' || {server} ELSE {client} || ' for ' || {server} || ', ' || {reason} END)"""


_LOCAL_AS = """iso || '+0000 ' || kdc || ' krb5kdc[1](info): AS_REQ (1 etypes {18}) ' || ip
  || ': ISSUE: authtime 1, etypes {rep=18 tkt=18 ses=18}, ' || client_name
  || ' for krbtgt/EXAMPLE.COM@EXAMPLE.COM'"""
_LOCAL_TGS = """iso || '+0000 ' || kdc || ' krb5kdc[1](info): TGS_REQ (1 etypes {18}) ' || ip
  || ': ISSUE: authtime 1, etypes {rep=18 tkt=18 ses=18}, ' || client_name
  || CASE WHEN event_id % 4 = 0 THEN ' for krbtgt/EX@EX.COM'
     ELSE ' for krbtgt/EXAMPLE.COM@EXAMPLE.COM' END"""
_SSHD = "iso || '+0000 ' || kdc || ' sshd[7]: Accepted publickey for ' || client_name"

_SUCCESS = """log_time, kdc, ip, req_type, req_enctypes, req_enctypes_orig, authtime, client_name,
  server_name, reply_enctype, ticket_enctype, session_enctype"""
_FAILURE = """log_time, kdc, ip, req_type, code, req_enctypes, req_enctypes_orig, client_name,
  server_name, reason"""


# -- measures --------------------------------------------------------------------------


def _last(name: str, when: str, time: str = "log_time") -> str:
    return f"CAST(coalesce(max(CASE WHEN {when} THEN {time} ELSE 0 END), 0) AS BIGINT) AS {name}"


def _count(name: str, when: str) -> str:
    return f"CAST(sum(CASE WHEN {when} THEN 1 ELSE 0 END) AS BIGINT) AS {name}"


_OFFERED = {"had_weak": "lw = 1", "had_weakfirst": "ltw = 1", "had_strong": "lm = 1", "had_strongonly": "lw = 0"}
_GOT = {
    "got_weaksesskey": "sw = 1", "got_weakreply": "rw = 1", "got_strongsesskey": "sw = 0",
    "got_strongreply": "rw = 0", "got_strong": "sw = 0 AND rw = 0",
}
_TICKET = {
    "weaksesskey": "sw = 1", "weakticketkey": "tw = 1", "strongsesskey": "sw = 0",
    "strongticketkey": "tw = 0", "strong": "sw = 0 AND tw = 0",
}
_ADDRESS = {
    "weak_as": "req_type = 0 AND lw = 1", "weak_tgs": "req_type = 1 AND lw = 1",
    "strong_as": "req_type = 0 AND lw = 0", "strong_tgs": "req_type = 1 AND lw = 0",
    "modern_as": "req_type = 0 AND lm = 1", "modern_tgs": "req_type = 1 AND lm = 1",
}

_CLIENT = ", ".join(
    ["ip", "max(log_time) AS last_success", "CAST(0 AS BIGINT) AS last_fail"]
    + [_last(f"last_{k}", w) for k, w in _ADDRESS.items() if "modern" not in k]
)
_PRINC_C = ", ".join(
    ["client_name AS name", "max(log_time) AS last_used", "max(authtime) AS lc_auth"]
    + [_last(f"lc_req_{k}", w) for k, w in {**_OFFERED, **_GOT}.items()]
)
_PRINC_S = ", ".join(
    ["server_name AS name", "max(log_time) AS last_used", "max(log_time) AS ls_ticket_issue"]
    + [_last(f"ls_ticket_{k}", w) for k, w in _TICKET.items()]
)
_PRINC_CF = ", ".join(
    ["client_name AS name", "max(log_time) AS lc_fail"]
    + [_last(f"lc_req_{k}", w) for k, w in _OFFERED.items()]
)
_PRINC_SF = "server_name AS name, max(log_time) AS ls_ticket_fail"
_PRINC_FOLDS = [
    f"pc AS (SELECT {_PRINC_C} FROM ok GROUP BY client_name)",
    f"ps AS (SELECT {_PRINC_S} FROM ok GROUP BY server_name)",
    f"pcf AS (SELECT {_PRINC_CF} FROM bad GROUP BY client_name)",
    f"psf AS (SELECT {_PRINC_SF} FROM bad GROUP BY server_name)",
    "names AS (SELECT name FROM pc UNION SELECT name FROM ps UNION SELECT name FROM pcf UNION SELECT name FROM psf)",
]


_HOST = "CASE WHEN strpos(n.name, '/') > 0 THEN string_split(string_split(n.name, '/')[2], '@')[1] END"


def _merged_princ() -> str:
    def pick(name: str, *tables: str) -> str:
        values = ", ".join(f"coalesce({t}.{name}, 0)" for t in tables)
        best = f"greatest({values})" if len(tables) > 1 else values
        return f"CAST({best} AS BIGINT) AS {name}"

    columns = (
        [pick("last_used", "pc", "ps"), pick("lc_auth", "pc"), pick("lc_fail", "pcf")]
        + [pick(f"lc_req_{k}", "pc", "pcf") for k in _OFFERED]
        + [pick(f"lc_req_{k}", "pc") for k in _GOT]
        + [pick("ls_ticket_issue", "ps"), pick("ls_ticket_fail", "psf")]
        + [pick(f"ls_ticket_{k}", "ps") for k in _TICKET]
    )
    return f"""SELECT n.name, {_HOST} AS host, {', '.join(columns)} FROM names n
  LEFT JOIN pc ON pc.name = n.name LEFT JOIN ps ON ps.name = n.name
  LEFT JOIN pcf ON pcf.name = n.name LEFT JOIN psf ON psf.name = n.name"""


_CCS = f"""SELECT ip, client_name AS cname, server_name AS sname,
  {_last("last_weak_sess_key", "sw = 1")}, {_last("last_strong_sess_key", "sw = 0")}
  FROM ok GROUP BY ip, client_name, server_name"""


def _slice(key: str, counts: dict[str, str], rows: str = "ok", extra: str = "", group: str = "") -> str:
    columns = "".join(f", {_count(n, w)}" for n, w in counts.items())
    return f"""SELECT {key}, d AS starttime, d + 86399 AS endtime, CAST(count(*) AS BIGINT) AS nentries{extra}{columns}
  FROM {rows} GROUP BY {group or key}, d"""


_CLIENT_COUNTS = {f"n{k}": w for k, w in _ADDRESS.items()}
_CLIENT_SLICES = _slice("ip", _CLIENT_COUNTS, extra=", CAST(1 AS INTEGER) AS is_success")
_REQ_COUNTS = {f"nreq_{k}": w for k, w in {**_OFFERED, **_GOT}.items()}
_TICKET_NAMES = ["nticket_issue", "nticket_fail", *[f"nticket_{k}" for k in _TICKET]]
_PRINC_SLICES = _slice(
    "client_name AS name",
    {"nauth": "req_type = 0", "nfail": "1 = 0", **_REQ_COUNTS, **dict.fromkeys(_TICKET_NAMES, "1 = 0")},
    group="client_name",
)


def _rates(names: list[str]) -> str:
    return "".join(f", CAST({n} AS DOUBLE) / CAST(nentries AS DOUBLE) AS {n[1:]}_rate" for n in names)


def _no_rates(names: list[str]) -> str:
    return "".join(f", CAST(NULL AS DOUBLE) AS {n[1:]}_rate" for n in names)


_CCS_SLICES = _slice(
    "ip, client_name AS cname, server_name AS sname",
    {"nlast_weak_sess_key": "sw = 1", "nlast_strong_sess_key": "sw = 0"},
    group="ip, client_name, server_name",
)
# Session keys that only the site's own table knows, as not weak.
_SITE = "site AS (SELECT * REPLACE (CASE WHEN event_id % 97 = 0 THEN 0 ELSE sw END AS sw) FROM ok)"
_REQ_RATES = {k.removeprefix("n"): w for k, w in _REQ_COUNTS.items()}
_TICKET_RATES = {
    "ticket_issue": "code = 'ISSUE'", "ticket_fail": "code <> 'ISSUE'",
    **{f"ticket_{k}": f"code = 'ISSUE' AND {w}" for k, w in _TICKET.items()},
}
_CLIENT_RATED = f"SELECT *{_rates(list(_CLIENT_COUNTS))} FROM ({_CLIENT_SLICES})"
_CLIENT_RATE_NAMES = [f"{n[1:]}_rate" for n in _CLIENT_COUNTS]

# -- offered lists of many shapes ------------------------------------------------------

_PICKS = """[event_id % 26, CASE WHEN event_id % 3 = 0 THEN event_id % 26 ELSE user_id % 25 END,
  (event_id * 7 + user_id) % 27, -(4094 + event_id % 9), 16 + user_id % 9]"""
_VARIED = f"""picked AS (SELECT event_id, ts, code, reply_enctype, session_enctype, ticket_enctype,
  list_slice({_PICKS}, 1, event_id % 6) AS picks FROM log),
runs AS (SELECT *, len(picks) AS n, CASE WHEN len(picks) < 2 OR picks[2] <> picks[1] THEN least(len(picks), 1)
    WHEN len(picks) < 3 OR picks[3] <> picks[1] THEN 2 WHEN len(picks) < 4 OR picks[4] <> picks[1] THEN 3
    WHEN len(picks) < 5 OR picks[5] <> picks[1] THEN 4 ELSE 5 END AS lead_run FROM picked),
varied AS (SELECT event_id, ts, code, reply_enctype, session_enctype, ticket_enctype,
  coalesce(array_to_string(picks, ' '), '') AS enctype_list_orig,
  CASE WHEN n = 0 THEN '0' ELSE array_to_string(list_concat([picks[1]], list_slice(picks, lead_run + 1, n)), ' ') END AS enctype_list
  FROM runs),
seed AS (SELECT * FROM (VALUES {_SEED}) t(enctype, name, is_modern, is_weak)),
lists AS (SELECT DISTINCT enctype_list, enctype_list_orig FROM varied),
placed AS (SELECT enctype_list, enctype_list_orig, unnest(string_split(enctype_list, ' ')) AS token,
  unnest(range(len(string_split(enctype_list, ' ')))) AS pos FROM lists),
tok AS (SELECT p.*, s.enctype, s.name, s.is_modern, s.is_weak,
  CASE WHEN s.enctype IS NULL THEN 0 WHEN row_number() OVER (PARTITION BY enctype_list, enctype_list_orig, token ORDER BY pos) > 1
       THEN 0 ELSE 1 END AS fits
  FROM placed p LEFT JOIN seed s ON s.enctype = CAST(p.token AS INTEGER)),
seq AS (SELECT *, min(fits) OVER (PARTITION BY enctype_list, enctype_list_orig ORDER BY pos
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS inside,
  string_agg(token, ' ') OVER (PARTITION BY enctype_list, enctype_list_orig ORDER BY pos
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
  string_agg(name, ',') OVER (PARTITION BY enctype_list, enctype_list_orig ORDER BY pos
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS names_upto FROM tok)"""

_SYSLOG = "strftime(ts, '%b %d')"
_BROKEN = f"""broken AS (SELECT event_id, code, CASE event_id % 6 WHEN 0 THEN {_line(stamp=_SYSLOG)}
  WHEN 1 THEN iso || ' ' || client_name WHEN 2 THEN {_line(orig="''")} WHEN 3 THEN '' ELSE {_line()} END AS line
  FROM ev)"""


def _averages(expr: str) -> str:
    return ", ".join(f"round(avg({r}) {expr}, 9) AS {r}_avg" for r in _CLIENT_RATE_NAMES)


_A, _B = "ts < TIMESTAMP '2024-01-16'", "ts >= TIMESTAMP '2024-01-16'"

ORACLES: dict[str, str] = {
    "filter_kdc_lines": _sql(
        f"""SELECT {_line()} AS value FROM ev UNION ALL SELECT {_LOCAL_TGS} FROM ev WHERE event_id % 2 = 0
        UNION ALL SELECT {_LOCAL_AS.replace("' for krbtgt/EXAMPLE.COM@EXAMPLE.COM'", "CASE WHEN event_id % 4 = 0 THEN ' for krbtgt/EX@EX.COM' ELSE ' for krbtgt/EXAMPLE.COM@EXAMPLE.COM' END")}
        FROM ev WHERE event_id % 2 = 1"""
    ),
    "filter_local_tgt": _sql(
        f"""SELECT {_line()} AS value FROM ev UNION ALL SELECT {_SSHD} FROM ev
        UNION ALL SELECT {_LOCAL_AS} FROM ev WHERE event_id % 2 = 1"""
    ),
    "parse_header": _sql("SELECT event_id, log_time, kdc FROM ev"),
    "parse_request": _sql("SELECT event_id, req_type, ip, req_enctypes, req_enctypes_orig FROM ev"),
    "parse_success": _sql(f"SELECT event_id, {_SUCCESS} FROM ok"),
    "parse_failure": _sql(f"SELECT event_id, {_FAILURE} FROM bad"),
    "clean_fields": _sql(
        """SELECT event_id, 'k' || kdc AS kdc,
        CASE WHEN event_id % 7 = 0 THEN '0' ELSE req_enctypes END AS req_enctypes,
        CASE WHEN event_id % 7 = 0 THEN '18,17' ELSE req_enctypes_orig END AS req_enctypes_orig,
        CAST(CASE WHEN code <> 'ISSUE' OR event_id % 5 = 0 THEN 0 ELSE authtime END AS BIGINT) AS authtime,
        client_name, server_name,
        CASE WHEN code <> 'ISSUE' OR event_id % 6 = 0 THEN 0 ELSE reply_enctype END AS reply_enctype,
        CASE WHEN code <> 'ISSUE' OR event_id % 11 = 0 THEN 0 ELSE session_enctype END AS session_enctype,
        code, CASE WHEN code = 'ISSUE' THEN '' ELSE '100 ' || reason END AS reason FROM ev"""
    ),
    "route_counts": _sql(
        """SELECT CASE WHEN event_id % 6 IN (0, 1, 3) THEN 'rejected' WHEN code = 'ISSUE' THEN 'log_entry_success'
        ELSE 'log_entry_fail' END AS table_name, CAST(count(*) AS BIGINT) AS nrows FROM broken GROUP BY 1""",
        _BROKEN,
    ),
    "rejects": _sql(
        """SELECT line, CASE event_id % 6 WHEN 0 THEN 'no usable time' WHEN 2 THEN 'empty enctype list'
        ELSE 'malformed entry' END AS reason, CASE WHEN event_id % 6 = 2 THEN 1 ELSE 0 END AS kept
        FROM broken WHERE event_id % 6 < 4""",
        _BROKEN,
    ),
    "union_logs": _sql(
        "SELECT kdc, CAST(count(*) AS BIGINT) AS nrows, max(log_time) AS last_time FROM ok GROUP BY kdc"
    ),
    "enctype_dim": _sql(
        """SELECT * FROM seed UNION ALL SELECT n, 'etype-' || CAST(n AS VARCHAR), 0, 0 FROM (
        SELECT CAST(unnest(string_split(enctype_list_orig, ' ')) AS INTEGER) AS n FROM varied WHERE enctype_list_orig <> ''
        UNION SELECT reply_enctype FROM varied UNION SELECT session_enctype FROM varied
        UNION SELECT ticket_enctype FROM varied) WHERE n NOT IN (SELECT enctype FROM seed)""",
        _VARIED,
    ),
    "list_canonical": _sql(
        "SELECT event_id, enctype_list_orig AS req_enctypes_orig, enctype_list AS req_enctypes FROM varied",
        _VARIED,
    ),
    "list_discovery": _sql(
        f"""SELECT DISTINCT enctype_list, enctype_list_orig FROM varied WHERE {_B}
        EXCEPT SELECT enctype_list, enctype_list_orig FROM varied WHERE {_A}""",
        _VARIED,
    ),
    "list_members": _sql(
        "SELECT DISTINCT enctype_list, enctype_list_orig, enctype AS enctype_num FROM tok WHERE enctype IS NOT NULL",
        _VARIED,
    ),
    "list_sequence": _sql(
        """SELECT enctype_list, enctype_list_orig, enctype AS enctype_num,
        CAST(CASE WHEN inside = 1 THEN pos END AS INTEGER) AS seq_num,
        CASE WHEN inside = 1 THEN upto END AS partial_enctype_list,
        CASE WHEN inside = 1 THEN names_upto END AS partial_enctype_name_list FROM seq WHERE fits = 1""",
        _VARIED,
    ),
    "list_flags": _sql(
        """SELECT enctype_list, enctype_list_orig,
        max_by(names_upto, pos) FILTER (WHERE inside = 1) AS enctype_name_list,
        CAST(coalesce(max(is_modern), 0) AS INTEGER) AS modern_client, CAST(coalesce(max(is_weak), 0) AS INTEGER) AS is_weak,
        CASE WHEN coalesce(min(pos) FILTER (WHERE inside = 1 AND is_weak = 1), 0)
           < coalesce(min(pos) FILTER (WHERE inside = 1 AND is_weak = 0), 0) THEN 1 ELSE 0 END AS is_too_weak
        FROM seq GROUP BY enctype_list, enctype_list_orig""",
        _VARIED,
    ),
    "join_lists": _sql("SELECT event_id, lm AS list_modern, lw AS list_weak, ltw AS list_too_weak FROM ok"),
    "join_roles": _sql(
        "SELECT event_id, rw AS reply_weak, sw AS session_weak, tw AS ticket_weak FROM ok WHERE event_id % 97 <> 0"
    ),
    "forwarded_tgt": _sql(
        """SELECT a.ip, a.authtime, a.client_name, a.server_name, b.server_name AS forwarded_server,
        b.log_time - a.log_time AS lag, CAST(count(*) AS BIGINT) AS npairs
        FROM ok a JOIN ok b ON a.ip = b.ip AND a.authtime = b.authtime AND a.client_name = b.client_name
        WHERE a.req_type = 1 AND b.req_type = 1 AND b.log_time - a.log_time BETWEEN 0 AND 900
        AND b.server_name LIKE 'krbtgt%' AND b.req_enctypes <> a.req_enctypes AND b.server_name <> a.server_name
        GROUP BY ALL"""
    ),
    "adhoc_weak_clients": _sql(
        """SELECT s.event_id, s.ip, s.client_name, s.log_time, c.last_weak_as, c.last_strong_as
        FROM ok s JOIN client c ON s.ip = c.ip WHERE c.last_weak_as > c.last_strong_as""",
        f"client AS (SELECT {_CLIENT} FROM ok GROUP BY ip)",
    ),
    "client_last_seen": _sql(f"SELECT {_CLIENT} FROM ok GROUP BY ip"),
    "princ_client_success": _sql("SELECT * FROM pc", *_PRINC_FOLDS),
    "princ_server_success": _sql("SELECT * FROM ps", *_PRINC_FOLDS),
    "princ_client_fail": _sql("SELECT * FROM pcf", *_PRINC_FOLDS),
    "princ_server_fail": _sql("SELECT * FROM psf", *_PRINC_FOLDS),
    "princ_last_seen": _sql(_merged_princ(), *_PRINC_FOLDS),
    "ccs_last_seen": _sql(_CCS),
    "client_slices": _sql(_CLIENT_SLICES),
    "princ_slices": _sql(_PRINC_SLICES),
    "ccs_slices": _sql(
        "SELECT *" + _rates(["nlast_weak_sess_key", "nlast_strong_sess_key"]) + " FROM ("
        + _CCS_SLICES + ")"
    ),
    "upsert_client": _sql(f"SELECT {_CLIENT} FROM ok GROUP BY ip"),
    "upsert_princ": _sql(_merged_princ(), *_PRINC_FOLDS),
    "upsert_ccs": _sql(_CCS),
    "upsert_client_slices": _sql(_CLIENT_SLICES),
    "upsert_princ_slices": _sql(_PRINC_SLICES),
    "client_slice_rates": _sql(_CLIENT_RATED),
    "princ_slice_rates": _sql(
        f"SELECT *{_rates(list(_REQ_COUNTS))}{_no_rates(_TICKET_NAMES)} FROM ({_PRINC_SLICES})"
    ),
    "prune_slices": _sql(f"SELECT * FROM ({_CLIENT_SLICES}) WHERE starttime >= 1706659200 - 10 * 86400"),
    "audit_duplicates": _sql(
        f"""SELECT ip, d AS starttime, CAST(1 AS INTEGER) AS is_success, CAST(2 AS BIGINT) AS copies
        FROM ok WHERE {_A} GROUP BY ip, d"""
    ),
    "audit_orphans": _sql(f"SELECT * FROM ({_CCS}) WHERE CAST(substr(cname, 2, strpos(cname, '@') - 2) AS INTEGER) % 10 = 3"),
    "audit_unknown_enctypes": _sql(
        """SELECT 'session' AS role, 99 AS enctype, CAST(count(*) AS BIGINT) AS nrows
        FROM ok WHERE event_id % 97 = 0 HAVING count(*) > 0"""
    ),
    "stream_parse": _sql(f"SELECT {_SUCCESS} FROM ok"),
    "stream_client_slices": _sql(_CLIENT_SLICES),
    "stream_native_slices": _sql(
        f"SELECT * FROM ({_CLIENT_SLICES}) WHERE endtime + 1 <= (SELECT max(log_time) FROM ok) - 2 * 86400"
    ),
    "stream_native_princ": _sql(_merged_princ(), *_PRINC_FOLDS),
    "batch_constraints": _sql(
        """SELECT reason, CAST(reason = 'folded' AS INTEGER) AS kept, count(*) AS nlines FROM (
          SELECT CASE WHEN event_id % 13 = 0 THEN 'ip is missing'
              WHEN code = 'ISSUE' AND event_id % 13 = 1 THEN 'authtime is missing'
              WHEN code = 'ISSUE' AND event_id % 13 = 2 THEN 'client_name is missing'
              WHEN code = 'ISSUE' AND event_id % 13 = 3 THEN 'session_enctype is missing'
              WHEN event_id % 17 = 16 THEN 'req_type is unknown'
              WHEN code = 'ISSUE' THEN 'folded' END AS reason FROM ev)
        WHERE reason IS NOT NULL GROUP BY reason"""
    ),
    "audit_references": _sql(
        f"""SELECT * FROM (
        SELECT 'client_slice_data' AS child, 'ip' AS columns, 'client' AS parent, ip AS key, count(*) AS nrows
          FROM ({_CLIENT_SLICES}) WHERE ip LIKE '10.0.3.%' GROUP BY ip
        UNION ALL SELECT 'princ_slice_data', 'name', 'princ', name, count(*) FROM ({_PRINC_SLICES})
          WHERE name LIKE 'u1%' GROUP BY name
        UNION ALL SELECT 'client_cname_sname', 'ip', 'client', ip, count(*) FROM ({_CCS}) WHERE ip LIKE '10.0.3.%' GROUP BY ip
        UNION ALL SELECT 'client_cname_sname', 'cname', 'princ', cname, count(*) FROM ({_CCS}) WHERE cname LIKE 'u1%' GROUP BY cname
        UNION ALL SELECT 'client_cname_sname', 'sname', 'princ', sname, count(*) FROM ({_CCS}) WHERE sname LIKE 'host/h3%' GROUP BY sname
        UNION ALL SELECT 'ccs_slice_data', 'ip', 'client', ip, count(*) FROM ({_CCS_SLICES}) WHERE ip LIKE '10.0.3.%' GROUP BY ip
        UNION ALL SELECT 'ccs_slice_data', 'cname', 'princ', cname, count(*) FROM ({_CCS_SLICES}) WHERE cname LIKE 'u1%' GROUP BY cname
        UNION ALL SELECT 'ccs_slice_data', 'sname', 'princ', sname, count(*) FROM ({_CCS_SLICES}) WHERE sname LIKE 'host/h3%' GROUP BY sname
        UNION ALL SELECT 'req_enctypes_normal', 'enctype_list,enctype_list_orig', 'req_enctypes_lists',
          enctype_list || '|' || enctype_list_orig, count(*) FROM (
            SELECT DISTINCT enctype_list, enctype_list_orig, enctype FROM tok WHERE enctype IS NOT NULL)
          WHERE enctype_list LIKE '%-%' GROUP BY enctype_list, enctype_list_orig)""",
        _VARIED,
    ),
    "ext_decayed_avg": _sql(
        f"""SELECT ip, is_success, last AS last_start, round(sum(w * nentries), 9) AS weight,
        {", ".join(f"round(sum(w * {n}) / sum(w * nentries), 9) AS {n[1:]}_decayed_avg" for n in _CLIENT_COUNTS)}
        FROM (SELECT *, pow(2.0, CAST(starttime - last AS DOUBLE) / 604800.0) AS w FROM (
            SELECT *, max(starttime) OVER (PARTITION BY ip, is_success) AS last FROM ({_CLIENT_SLICES})))
        GROUP BY ip, is_success, last"""
    ),
    "ext_trend_slopes": _sql(
        f"""SELECT ip, is_success, count(*) AS nslices,
        {", ".join(f"round(CASE WHEN count(*) > 1 THEN regr_slope({r}, CAST(starttime AS DOUBLE) / 86400) END, 9) AS {r.removesuffix('_rate')}_slope" for r in _CLIENT_RATE_NAMES)}
        FROM ({_CLIENT_RATED}) GROUP BY ip, is_success"""
    ),
    "ext_failure_templates": _sql(
        """SELECT code, CASE event_id % 5 WHEN 0 THEN 'Additional pre-authentication required'
          WHEN 1 THEN 'Client not found in Kerberos database: <principal>'
          WHEN 2 THEN 'Clock skew too great: <number> seconds from <address>.'
          WHEN 3 THEN 'Key table entry ' || CASE WHEN hosts > 8 THEN '<*>' ELSE 'h' || CAST(user_id AS VARCHAR) END || ' not found'
          ELSE 'Decrypt integrity check failed for <path>' END AS template, d AS starttime, count(*) AS nfail
        FROM (SELECT b.*, h.hosts FROM bad b LEFT JOIN (SELECT code AS c, count(DISTINCT user_id) AS hosts FROM bad
            WHERE event_id % 5 = 3 GROUP BY code) h ON h.c = b.code) GROUP BY 1, 2, 3"""
    ),
    "adhoc_sql_functions": _sql(
        """SELECT event_id, req_enctypes AS listing, lw AS weak, lm AS modern, ltw AS too_weak, sw AS session_weak, d AS day,
        CASE WHEN strpos(server_name, '/') > 0 THEN string_split(string_split(server_name, '/')[2], '@')[1] END AS host
        FROM ok WHERE authtime - authtime % 86400 = d"""
    ),
    "stream_growing_file": _sql(_CLIENT_SLICES),
    "stream_princ": _sql(_merged_princ(), *_PRINC_FOLDS),
    "stream_late_data": _sql(_CLIENT_SLICES),
    "ext_running_avg": _sql(
        f"""SELECT ip, is_success, starttime, endtime,
        {_averages("OVER (PARTITION BY ip ORDER BY starttime ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)")} FROM ({_CLIENT_RATED})"""
    ),
    "ext_period_averages": _sql(
        f"""SELECT starttime, endtime, CAST(count(*) AS BIGINT) AS nslices, {_averages("")}
        FROM ({_CLIENT_RATED}) GROUP BY starttime, endtime"""
    ),
    "ext_client_last_fail": _sql(
        f"""SELECT coalesce(c.ip, f.ip) AS ip, coalesce(last_success, 0) AS last_success, coalesce(f.t, 0) AS last_fail,
        coalesce(last_weak_as, 0) AS last_weak_as, coalesce(last_weak_tgs, 0) AS last_weak_tgs,
        coalesce(last_strong_as, 0) AS last_strong_as, coalesce(last_strong_tgs, 0) AS last_strong_tgs
        FROM (SELECT {_CLIENT} FROM ok GROUP BY ip) c
        FULL JOIN (SELECT ip, max(log_time) AS t FROM bad GROUP BY ip) f ON c.ip = f.ip"""
    ),
    "ext_fail_slices": _sql(
        _slice("ip", _CLIENT_COUNTS, rows="bad", extra=", CAST(0 AS INTEGER) AS is_success")
    ),
    "ext_princ_fail_slices": _sql(
        _slice("client_name AS name", {"nfail": "1 = 1"}, rows="bad", group="client_name")
    ),
    "ext_princ_host": _sql(
        """SELECT name, CASE WHEN strpos(name, '/') > 0 THEN string_split(string_split(name, '/')[2], '@')[1] END AS host,
        last_used FROM (""" + _merged_princ() + ")",
        *_PRINC_FOLDS,
    ),
    "ext_ticket_slices": _sql(
        f"SELECT *{_rates(_TICKET_NAMES)} FROM ("
        + _slice(
            "server_name AS name",
            {"nticket_issue": "code = 'ISSUE'", "nticket_fail": "code <> 'ISSUE'",
             **{f"nticket_{k}": f"code = 'ISSUE' AND {w}" for k, w in _TICKET.items()}},
            rows="ev", group="server_name",
        ) + ")"
    ),
    "parse_odd_failures": _sql(
        """SELECT event_id, log_time, kdc, ip, 1 AS req_type,
        CASE event_id % 5 WHEN 0 THEN 'NEEDED_PREAUTH' WHEN 1 THEN 'BAD_REQUEST' WHEN 2 THEN 'LOOKING_UP'
          WHEN 3 THEN 'ISSUE' ELSE 'EXPIRED' END AS code,
        '18' AS req_enctypes, '18' AS req_enctypes_orig,
        CASE WHEN event_id % 5 <> 1 THEN client_name END AS client_name,
        CASE WHEN event_id % 5 <> 1 THEN server_name END AS server_name,
        CASE WHEN event_id % 5 = 0 THEN client_name || ' for ' || server_name ELSE reason END AS reason FROM ev"""
    ),
    "reject_odd_failures": _sql(
        """SELECT 'no client and server' AS reason, 1 AS kept, count(*) AS nlines
        FROM ev WHERE event_id % 5 = 1 HAVING count(*) > 0"""
    ),
    "row_constraints": _sql(
        """SELECT failed, problem, count(*) AS nrows FROM (
          SELECT CASE WHEN code = 'ISSUE' THEN 0 ELSE 1 END AS failed,
            CASE WHEN event_id % 13 = 0 THEN 'ip is missing'
              WHEN code = 'ISSUE' AND event_id % 13 = 1 THEN 'authtime is missing'
              WHEN code = 'ISSUE' AND event_id % 13 = 2 THEN 'client_name is missing'
              WHEN code = 'ISSUE' AND event_id % 13 = 3 THEN 'session_enctype is missing'
              WHEN event_id % 17 = 16 THEN 'req_type is unknown' END AS problem FROM ev)
        WHERE problem IS NOT NULL GROUP BY failed, problem"""
    ),
    "princ_slices_extended": _sql(_PRINC_SLICES.replace("FROM ok", "FROM site"), _SITE),
    "ccs_slices_extended": _sql(_CCS_SLICES.replace("FROM ok", "FROM site"), _SITE),
    "prune_all_slices": _sql(
        " UNION ALL ".join(
            f"""SELECT '{name}' AS slices, starttime, count(*) AS nrows, CAST(sum(nentries) AS BIGINT) AS nentries
            FROM ({table}) WHERE starttime >= 1706659200 - 10 * 86400 GROUP BY starttime"""
            for name, table in (("client", _CLIENT_SLICES), ("princ", _PRINC_SLICES), ("ccs", _CCS_SLICES))
        )
    ),
    "batch_two_loads": _sql(
        """SELECT CASE WHEN code = 'ISSUE' THEN 'success' ELSE 'failure' END AS outcome,
        log_time, ip, client_name, server_name, count(*) AS nrows FROM ev GROUP BY ALL"""
    ),
    "store_princ": _sql(_merged_princ(), *_PRINC_FOLDS),
    "store_princ_slice_rates": _sql(
        f"""SELECT n.name, n.starttime, CAST(coalesce(f.nfail, 0) AS BIGINT) AS nfail,
        {", ".join(f"c.{k}_rate" for k in _REQ_RATES)}, {", ".join(f"t.{k}_rate" for k in _TICKET_RATES)}
        FROM (SELECT client_name AS name, d AS starttime FROM ev UNION SELECT server_name, d FROM ev) n
        LEFT JOIN (SELECT client_name AS name, d AS starttime,
            {", ".join(f"CAST(sum(CASE WHEN {w} THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS {k}_rate" for k, w in _REQ_RATES.items())}
            FROM ok GROUP BY 1, 2) c ON c.name = n.name AND c.starttime = n.starttime
        LEFT JOIN (SELECT client_name AS name, d AS starttime, count(*) AS nfail FROM bad GROUP BY 1, 2) f
            ON f.name = n.name AND f.starttime = n.starttime
        LEFT JOIN (SELECT server_name AS name, d AS starttime,
            {", ".join(f"CAST(sum(CASE WHEN {w} THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS {k}_rate" for k, w in _TICKET_RATES.items())}
            FROM ev GROUP BY 1, 2) t ON t.name = n.name AND t.starttime = n.starttime"""
    ),
    "stream_retention": _sql(
        f"""SELECT * FROM ({_CLIENT_SLICES.replace("FROM ok", "FROM ahead")})
        WHERE starttime >= 1706659200 - 10 * 86400""",
        """ahead AS (SELECT * REPLACE (CASE WHEN event_id % 499 = 0 THEN 4070908800 ELSE d END AS d) FROM ok)""",
    ),
    "stream_two_sources": _sql(_CLIENT_SLICES),
    "stream_reject_counts": _sql(
        """SELECT reason, kept, count(*) AS nlines FROM (
          SELECT CASE event_id % 6 WHEN 0 THEN 'no usable time' WHEN 2 THEN 'empty enctype list'
            ELSE 'malformed entry' END AS reason,
            CASE WHEN event_id % 6 = 2 THEN 1 ELSE 0 END AS kept FROM ev WHERE event_id % 6 IN (0, 1, 2, 3))
        GROUP BY reason, kept"""
    ),
}
