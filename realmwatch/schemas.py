"""Table schemas and the column groups the folds, merges and rates share."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*groups: tuple[T.DataType, str]) -> T.StructType:
    return T.StructType(
        [T.StructField(name, dtype) for dtype, names in groups for name in names.split()]
    )


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

# Table and column names of the data model.
SUCCESS = _struct(
    (_L, "log_time"),
    (_S, "kdc ip"),
    (_I, "req_type"),
    (_S, "req_enctypes req_enctypes_orig"),
    (_L, "authtime"),
    (_S, "client_name server_name"),
    (_I, "reply_enctype ticket_enctype session_enctype"),
)
FAILURE = _struct(
    (_L, "log_time"),
    (_S, "kdc ip"),
    (_I, "req_type"),
    (_S, "code req_enctypes req_enctypes_orig client_name server_name reason"),
)
ENCTYPES = _struct((_I, "enctype"), (_S, "name"), (_I, "is_modern is_weak"))
LISTS = _struct(
    (_S, "enctype_list enctype_list_orig enctype_name_list"),
    (_I, "modern_client is_weak is_too_weak"),
)
LIST_MEMBERS = _struct(
    (_S, "enctype_list enctype_list_orig"),
    (_I, "enctype_num seq_num"),
    (_S, "partial_enctype_list partial_enctype_name_list"),
)

CLIENT_MEASURES = (
    "last_success last_fail last_weak_as last_weak_tgs last_strong_as last_strong_tgs"
).split()
PRINC_CLIENT_MEASURES = (
    "lc_auth lc_fail lc_req_had_weak lc_req_had_weakfirst lc_req_had_strong "
    "lc_req_had_strongonly lc_req_got_weaksesskey lc_req_got_weakreply "
    "lc_req_got_strongsesskey lc_req_got_strongreply lc_req_got_strong"
).split()
PRINC_SERVER_MEASURES = (
    "ls_ticket_issue ls_ticket_fail ls_ticket_weaksesskey ls_ticket_weakticketkey "
    "ls_ticket_strongsesskey ls_ticket_strongticketkey ls_ticket_strong"
).split()
PRINC_MEASURES = ["last_used", *PRINC_CLIENT_MEASURES, *PRINC_SERVER_MEASURES]
CCS_MEASURES = "last_weak_sess_key last_strong_sess_key".split()

CLIENT_COUNTS = "nweak_as nweak_tgs nstrong_as nstrong_tgs nmodern_as nmodern_tgs".split()
PRINC_REQ_COUNTS = (
    "nreq_had_weak nreq_had_weakfirst nreq_had_strong nreq_had_strongonly "
    "nreq_got_weaksesskey nreq_got_weakreply nreq_got_strongsesskey "
    "nreq_got_strongreply nreq_got_strong"
).split()
PRINC_TICKET_COUNTS = (
    "nticket_issue nticket_fail nticket_weaksesskey nticket_weakticketkey "
    "nticket_strongsesskey nticket_strongticketkey nticket_strong"
).split()
CCS_COUNTS = "nlast_weak_sess_key nlast_strong_sess_key".split()
# A rate is named after its count: nweak_as -> weak_as_rate.

CLIENT = _struct((_S, "ip"), (_L, " ".join(CLIENT_MEASURES)))
PRINC = _struct((_S, "name host"), (_L, " ".join(PRINC_MEASURES)))
CCS = _struct((_S, "ip cname sname"), (_L, " ".join(CCS_MEASURES)))
CLIENT_SLICES = _struct(
    (_S, "ip"), (_L, "starttime endtime nentries"), (_I, "is_success"),
    (_L, " ".join(CLIENT_COUNTS)),
)
PRINC_SLICES = _struct(
    (_S, "name"),
    (_L, " ".join(["starttime endtime nentries nauth nfail", *PRINC_REQ_COUNTS,
                   *PRINC_TICKET_COUNTS])),
)
CCS_SLICES = _struct(
    (_S, "ip cname sname"), (_L, " ".join(["starttime endtime nentries", *CCS_COUNTS]))
)

CLIENT_AVERAGES = _struct(
    (_S, "ip"), (_I, "is_success"), (_L, "period last_start"), (_D, " ".join(["nentries", *CLIENT_COUNTS]))
)
REPORT_COUNTS = _struct((_S, "reason"), (_I, "kept"), (_L, "nlines"))

REQ_AS, REQ_TGS = 0, 1
DAY_SECONDS = 86400
