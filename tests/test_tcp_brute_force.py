"""R15/R16 against a plain-Python implementation, on random rows with NULLs."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flowstats.plans import tcp_reports as TR
from flowstats.schemas import TCP_SCHEMA

TRAFFIC = [
    ("bytes_total", ("in_bytes", "out_bytes")), ("bytes_in", ("in_bytes",)), ("bytes_out", ("out_bytes",)),
    ("packets_total", ("in_pkts", "out_pkts")), ("packets_in", ("in_pkts",)), ("packets_out", ("out_pkts",)),
    ("retransmitted_in", ("retransmitted_in_pkts",)), ("retransmitted_out", ("retransmitted_out_pkts",)),
    ("ooorder_in", ("ooorder_in_pkts",)), ("ooorder_out", ("ooorder_out_pkts",)),
    ("tcp_window_size_zero", ("tcp_window_size_zero",)),
]
NAMES = [f.name for f in TCP_SCHEMA.fields]


def _add(total, value):
    return total if value is None else value if total is None else total + value


def counters(rows):
    """Summed counters of some flows, following the report definitions."""
    out = {name: None for name, _ in TRAFFIC}
    conn = dict.fromkeys(["counter", "closed", "fin", "reset", "timeout", "scan", "syn_attack"], 0)
    lat = dict.fromkeys(["server_sec", "server_usec", "client_sec", "client_usec"], 0)
    for r in rows:
        for name, cols in TRAFFIC:
            vals = [r[c] for c in cols]
            out[name] = _add(out[name], None if None in vals else sum(vals))
        status = r["final_status"]
        if status is None or status in (5, 6):
            continue
        conn["closed"] += 1
        conn["fin"] += status == 8
        conn["reset"] += status == 7
        conn["scan"] += status == 1
        conn["syn_attack"] += status == 2
        conn["timeout"] += status in (1, 2, 3, 4)
        if r["unknown_conn"] == 0:
            conn["counter"] += 1
            for side in ("server", "client"):
                lat[f"{side}_sec"] += r[f"{side}_latency_sec"] or 0
                lat[f"{side}_usec"] += r[f"{side}_latency_usec"] or 0
    out.update(conn)
    for side in ("server", "client"):
        total = lat[f"{side}_sec"] * 1_000_000 + lat[f"{side}_usec"]
        out[f"{side}_latency_total"] = total
        out[f"{side}_latency"] = total // conn["counter"] if conn["counter"] > 1 else 0
    packets = out["packets_total"]
    for rate, a, b in (("retransfer_rate", "retransmitted_in", "retransmitted_out"), ("outoforder_rate", "ooorder_in", "ooorder_out")):
        num = None if out[a] is None or out[b] is None else out[a] + out[b]
        out[rate] = (None if num is None else round(num / packets, 9)) if packets is not None and packets > 1 else 0.0
    return out


def _norm(row, keys):
    return {k: (round(v, 9) if isinstance(v, float) else v) for k, v in row.items() if k not in keys}


small = st.one_of(st.none(), st.integers(0, 5))
tcp_row = st.fixed_dictionaries(
    {
        "dst_group_id": st.sampled_from([1, 2, None]),
        "dst_ipv4": st.sampled_from(["a", "b", "c", None]),
        **{n: small for n in NAMES if n not in ("dst_group_id", "dst_ipv4", "final_status", "unknown_conn")},
        "final_status": st.one_of(st.none(), st.integers(0, 8)),
        "unknown_conn": st.one_of(st.none(), st.integers(0, 1)),
    }
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(tcp_row, min_size=1, max_size=30))
def test_group_and_server_summary_match_brute_force(spark, rows):
    df = spark.createDataFrame([tuple(r[n] for n in NAMES) for r in rows], TCP_SCHEMA)

    by_group = defaultdict(list)
    for r in rows:
        by_group[r["dst_group_id"]].append(r)
    expected = {(False, g): counters(rs) for g, rs in by_group.items() if g is not None}
    expected[(True, None)] = counters(rows)
    got = {(r.is_all, r.dst_group_id): _norm(r.asDict(), ("is_all", "dst_group_id", "new")) for r in TR.group_summary(df).collect()}
    assert got == {k: _norm(v, ()) for k, v in expected.items()}

    by_server = defaultdict(list)
    for r in rows:
        by_server[r["dst_ipv4"]].append(r)
    pairs = defaultdict(list)
    for r in rows:
        if r["dst_group_id"] is not None:
            pairs[(r["dst_group_id"], r["dst_ipv4"])].append(r)
    conn_keys = ["counter", "closed", "fin", "reset", "timeout", "scan", "syn_attack", "server_latency_total",
                 "client_latency_total", "server_latency", "client_latency"]
    expected = {}
    for (g, ip), rs in pairs.items():
        row = counters(rs)
        server = counters(by_server[ip])  # connection counters: the server over all groups
        row.update({k: server[k] for k in conn_keys})
        expected[(g, ip)] = _norm(row, ())
    got = {(r.dst_group_id, r.dst_ipv4): _norm(r.asDict(), ("dst_group_id", "dst_ipv4", "new")) for r in TR.server_summary(df).collect()}
    assert got == expected

    # the shared-counter versions of both reports give the same rows
    from flowstats.plans.tcp_shared import tcp_report_set

    report_set = tcp_report_set()
    frames = report_set.frames(df)
    for name, direct in (("tcp_10s", TR.group_summary), ("tcp_server_10s", TR.server_summary)):
        want = direct(df)
        have = report_set.reports[name](frames).select(*want.columns)
        assert have.exceptAll(want).count() == 0 and want.exceptAll(have).count() == 0, name
