"""Golden log lines: literal text and the event or report it must become."""

import re
import time

import pytest

from realmwatch.operators.audit import routed
from realmwatch.operators.cube import event_cube
from realmwatch.sources import bridge, logs, parser

REQUEST = "AS_REQ (2 etypes {18 17}) 1.2.3.4: "
RESULT = "ISSUE: authtime 1329894121, etypes {rep=18 tkt=17 ses=1}, u@EX.COM for krbtgt/EX.COM@EX.COM"
HEAD = "2012-02-22T02:02:01-0500 kdc1 krb5kdc[12](info): "


def parse(spark, *lines):
    raw = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "n int, value string")
    return sorted(parser.parse_events(raw).collect(), key=lambda r: r.n)


def one(spark, line):
    return parse(spark, line)[0]


def test_plain_issue(spark):
    r = one(spark, HEAD + REQUEST + RESULT)
    assert (r.outcome, r.problem) == ("success", None)
    assert (r.log_time, r.kdc, r.ip, r.req_type) == (1329894121, "kdc1", "1.2.3.4", 0)
    assert (r.req_enctypes, r.req_enctypes_orig, r.authtime) == ("18 17", "18 17", 1329894121)
    assert (r.client_name, r.server_name) == ("u@EX.COM", "krbtgt/EX.COM@EX.COM")
    assert (r.reply_enctype, r.ticket_enctype, r.session_enctype) == (18, 17, 1)


@pytest.mark.parametrize(
    "stamp, epoch",
    [
        ("2012-02-22T02:02:01-0500", 1329894121),
        ("2012-02-22T02:02:01-05:00", 1329894121),
        ("2012-02-22T02:02:01+0530", 1329856321),
        ("2012-02-22T02:02:01Z", 1329876121),
        ("2012-02-22T02:02:01", 1329876121),
        ("2012-02-22T02:02:01.750", 1329876121),
    ],
)
def test_time(spark, stamp, epoch):
    assert one(spark, HEAD.replace("2012-02-22T02:02:01-0500", stamp) + REQUEST + RESULT).log_time == epoch


@pytest.mark.parametrize("tag", ["krb5kdc", "old5kdc", "dmz5kdc", "afsdmz5kdc"])
def test_daemon_tags(spark, tag):
    assert one(spark, HEAD.replace("krb5kdc", tag) + REQUEST + RESULT).kdc == "kdc1"


def test_words_between_time_and_host(spark):
    line = HEAD.replace(" kdc1 ", " local0.info relay: kdc1 ") + REQUEST + RESULT
    assert one(spark, line).kdc == "kdc1"


def test_first_daemon_tag_counts(spark):
    line = HEAD + REQUEST + RESULT + " kdc9 krb5kdc[1](info): "
    assert one(spark, line).kdc == "kdc1"


@pytest.mark.parametrize(
    "offered, canonical, original",
    [
        ("18 18 17 23", "18 17 23", "18 18 17 23"),
        ("1 1 1", "1", "1 1 1"),
        ("1 18", "1 18", "1 18"),
        ("18 17 17", "18 17 17", "18 17 17"),
        ("-133 -133 18", "-133 18", "-133 -133 18"),
        (" 18  17 ", "18 17", "18 17"),
        ("18,17", "0", "18,17"),
    ],
)
def test_offered_list(spark, offered, canonical, original):
    r = one(spark, HEAD + REQUEST.replace("18 17", offered) + RESULT)
    assert (r.req_enctypes, r.req_enctypes_orig, r.problem) == (canonical, original, None)


def test_empty_list_is_kept_and_reported(spark):
    r = one(spark, HEAD + REQUEST.replace("18 17", "") + RESULT)
    assert (r.outcome, r.req_enctypes, r.req_enctypes_orig) == ("success", "0", "")
    assert r.problem == parser.EMPTY_LIST


def test_request_types(spark):
    kinds = [one(spark, HEAD + REQUEST.replace("AS_REQ", k) + RESULT).req_type for k in ("AS_REQ", "TGS_REQ", "X")]
    assert kinds == [0, 1, 1]


def test_negative_and_unusable_numbers(spark):
    line = HEAD + REQUEST + RESULT
    assert one(spark, line.replace("ses=1", "ses=-133")).session_enctype == -133
    assert one(spark, line.replace("ses=1", "ses=none")).session_enctype == 0
    assert one(spark, line.replace("ses=1", "ses=99999999999")).session_enctype == 0
    assert one(spark, line.replace("authtime 1329894121", "authtime soon")).authtime == 0


def test_ipv6(spark):
    assert one(spark, HEAD + REQUEST.replace("1.2.3.4", "fe80::1") + RESULT).ip == "fe80::1"


def test_failure(spark):
    r = one(spark, HEAD + REQUEST + "NEEDED_PREAUTH: u@EX.COM for k/h@EX.COM, Additional pre-auth")
    assert (r.outcome, r.code, r.reason) == ("failure", "NEEDED_PREAUTH", "Additional pre-auth")
    assert (r.client_name, r.server_name) == ("u@EX.COM", "k/h@EX.COM")


def test_failure_lead_in(spark):
    lead = "authtime 0,  etypes {rep=1 tkt=2 ses=3}, "
    r = one(spark, HEAD + REQUEST + f"LOOKING_UP_SERVER: {lead}u@EX.COM for k/h@EX.COM, gone")
    assert (r.client_name, r.server_name, r.reason) == ("u@EX.COM", "k/h@EX.COM", "gone")


def test_reason_follows_the_last_comma(spark):
    r = one(spark, HEAD + REQUEST + "X: u@EX.COM for k/h@EX.COM, one, two")
    assert r.reason == "two"


def test_several_fors(spark):
    issued = one(spark, HEAD + REQUEST + RESULT.replace("u@EX.COM for", "u@EX.COM for a for"))
    refused = one(spark, HEAD + REQUEST + "X: u@EX.COM for a for k/h@EX.COM, no use for it")
    assert (issued.client_name, issued.server_name) == ("u@EX.COM", "krbtgt/EX.COM@EX.COM")
    assert (refused.client_name, refused.server_name, refused.reason) == ("u@EX.COM", "k/h@EX.COM", "no use for it")


def test_cleaning(spark):
    line = (HEAD + REQUEST + RESULT).replace("u@EX.COM", "'u%s@EX.COM").replace("kdc1", "k%dc1")
    r = one(spark, line)
    assert (r.client_name, r.kdc) == ("us@EX.COM", "kdc1")


@pytest.mark.parametrize(
    "line, problem",
    [
        ("Feb 22 02:02:01 kdc1 krb5kdc[1](info): " + REQUEST + RESULT, parser.NO_TIME),
        ("2012-13-45T02:02:01Z kdc1 krb5kdc[1](info): " + REQUEST + RESULT, parser.NO_TIME),
        ("2012-02-22T02:02:01Z kdc1 sshd[1]: hello", parser.MALFORMED),
        (HEAD + "closing down fd 12", parser.MALFORMED),
        (HEAD + REQUEST + "ISSUE: authtime 1, etypes {rep=1 tkt=1 ses=1}, nobody", parser.MALFORMED),
        ("", parser.MALFORMED),
        ("\x01" * 20, parser.MALFORMED),
    ],
)
def test_rejects(spark, line, problem):
    r = one(spark, line)
    assert (r.outcome, r.problem, r.value) == ("rejected", problem, line)


def test_refusals_that_name_nobody_are_kept_and_reported(spark):
    r = one(spark, HEAD + REQUEST + "X: nobody, why")
    assert (r.outcome, r.problem, r.client_name, r.server_name, r.reason) == (
        "failure", parser.NO_PARTIES, None, None, "why",
    )


def test_refusals_in_odd_forms(spark):
    r = one(spark, HEAD + REQUEST + "X: u@R for krbtgt/R@R")
    assert (r.outcome, r.client_name, r.server_name, r.reason) == ("failure", "u@R", "krbtgt/R@R", "u@R for krbtgt/R@R")
    assert one(spark, HEAD + REQUEST + "X:   u@R for s@R, why").client_name == "u@R"
    assert one(spark, HEAD + REQUEST + "IS%SUE: u@R for s@R, why").outcome == "failure"


def test_splice_marks_in_a_line_do_no_harm(spark):
    r = one(spark, HEAD + REQUEST + RESULT.replace("u@", "u\x01\x01@"))
    assert (r.outcome, r.client_name, r.server_name) == ("success", "u@EX.COM", "krbtgt/EX.COM@EX.COM")


def test_hostile_lines_finish(spark):
    """Long lines of near misses must not make the pattern backtrack without end."""
    near = [
        HEAD + REQUEST + "X: a, " + "b for " * 5000,
        HEAD + "x " * 20000,
        "2012-02-22T02:02:01Z " + "krb5kdc " * 20000,
        HEAD + REQUEST + "ISSUE: authtime 1, etypes {rep=" + "1 tkt=" * 5000,
    ]
    assert [r.outcome for r in parse(spark, *near)] == ["failure"] + ["rejected"] * 3


def test_three_tables(spark):
    raw = spark.createDataFrame(
        [(HEAD + REQUEST + RESULT,), (HEAD + REQUEST + "X: u for k, no",), ("junk",)], "value string"
    )
    parsed = parser.parse_logs(raw)
    assert [t.count() for t in parsed] == [1, 1, 1]


def test_line_filters(spark):
    tgs = HEAD + "TGS_REQ (1 etypes {18}) 1.2.3.4: ISSUE: authtime 1, etypes {rep=1 tkt=1 ses=1}, u@EX.COM for "
    lines = [
        tgs + "krbtgt/EX.COM@EX.COM",
        tgs + "krbtgt/EX@EX.COM",
        tgs + "krbtgt/OTHER@EX.COM",
        tgs.replace("TGS_REQ", "AS_REQ") + "krbtgt/EX.COM@EX.COM",
        "2012-02-22T02:02:01Z kdc1 sshd[1]: hello",
    ]
    raw = spark.createDataFrame([(line,) for line in lines], "value string")
    assert {r.value for r in logs.drop_local_tgt(raw).collect()} == set(lines[2:])
    assert {r.value for r in logs.kdc_lines(raw).collect()} == set(lines[:4])


def test_a_megabyte_of_headers_is_read_once(spark):
    header = "2012-02-22T02:02:01-0500 kdc1 krb5kdc[1](info): "
    lines = [header * 20_000, header * 20_000 + "AS_REQ (1 etypes {18}) 1.2.3.4: "]
    began = time.monotonic()
    events = parser.parse_events(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert {r.outcome for r in events.collect()} == {"rejected"}
    assert time.monotonic() - began < 20


def test_generated_code_is_short_enough_to_be_compiled(spark, folder_of_lines, capsys):
    """The JVM interprets methods of more than 8,000 bytes for good; parser and cube run as one of them."""
    lines = logs.drop_local_tgt(spark.read.text(folder_of_lines))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        event_cube(routed(parser.parse_events(lines))).explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


@pytest.fixture
def folder_of_lines(log, tmp_path):
    path = str(tmp_path / "lines")
    bridge.raw_lines(log).select("value").write.text(path)
    return path
