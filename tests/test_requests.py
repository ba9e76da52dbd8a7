"""Access requests and maps against a plain session model, with caps that bind and buckets that split."""

import datetime as dt
import random

import pytest

from veiltext.operators import mapping as M
from veiltext.operators import requests as R

import model


def random_events(seed, sessions=6, hot=400, cold=60):
    rng = random.Random(seed)
    rows = []
    for s in range(sessions):
        for i in range(hot if s == 0 else cold):
            kind = rng.choice(["mapping", "request", "resolve", "resolve"])
            e = dict(
                session_id=f"s{s}", seq=i * 3 + s, ts=dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i),
                kind=kind, placeholder=None, original=None, entity_type=None, reason=None, context=None,
                request_id=None, request_ids=None, action=None, message=None,
            )
            if kind == "mapping":
                e.update(placeholder=f"[EMAIL_{rng.randint(1, 6)}]", original=f"u{s}-{i}@x.org")
            elif kind == "request":
                e.update(placeholder=f"[EMAIL_{rng.randint(1, 7)}]", entity_type="EMAIL", reason="r")
            else:
                top = max(3, i // 4)
                ids = [f"REQ-{rng.randint(1, top)}" for _ in range(rng.choice([1, 1, 3]))]
                if len(ids) > 1:
                    e["request_ids"] = ids
                else:
                    e["request_id"] = ids[0]
                e.update(
                    action=rng.choice(["approve", "deny", "follow_up", "follow_up"]),
                    message=rng.choice([None, f"m{i}"]),
                )
            rows.append(e)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("cap,max_mappings", [(50, 10_000), (4, 3), (1, 4)])
def test_jobs_equal_model(spark, cap, max_mappings):
    rows = random_events(cap)
    sessions, made, replies = model.run(rows, cap, max_mappings)
    ev = spark.createDataFrame(rows, R.EVENTS).cache()
    req = R.create_requests(ev, cap=cap, max_mappings=max_mappings, span=64).cache()
    got = {(r.session_id, r.seq): r for r in req.collect()}
    assert {k: r.request_id for k, r in got.items()} == made
    for k, r in got.items():
        assert (r.error is None) == (made[k] is not None)
        if made[k]:
            assert r.original_text == sessions[k[0]].requests[made[k]]["original_text"]

    rep = R.resolve_replies(ev, req).cache()
    assert {
        (r.session_id, r.seq, r.pos): (r.request_id, r.status, r.error) for r in rep.collect()
    } == replies

    table = R.request_table(req, rep).cache()
    want = {(s, rid): r for s, x in sessions.items() for rid, r in x.requests.items()}
    rows_ = {(r.session_id, r.request_id): r for r in table.collect()}
    assert set(rows_) == set(want)
    for k, r in rows_.items():
        assert {n: r[n] for n in want[k]} == want[k], k

    counts = {r.session_id: (r.pending_count, r.total_count) for r in R.request_counts(table).collect()}
    assert counts == {s: (x.open(), len(x.requests)) for s, x in sessions.items() if x.requests}

    kept = M.evict_fifo(R.mapping_events(ev), max_mappings)
    got_map = {}
    for r in kept.orderBy("first_seq", "first_ord").collect():
        got_map.setdefault(r.session_id, []).append((r.placeholder, r.original))
    assert got_map == {s: list(x.map.items()) for s, x in sessions.items() if x.map}


def _event(seq, kind, **kw):
    base = dict.fromkeys(
        "placeholder original entity_type reason context request_id request_ids action message".split()
    )
    return dict(session_id="s", seq=seq, ts=dt.datetime(2024, 1, 1) + dt.timedelta(minutes=seq), kind=kind, **{**base, **kw})


def test_lifecycle_replies_and_masks(spark):
    ev = spark.createDataFrame(
        [
            _event(1, "mapping", placeholder="[EMAIL_1]", original="john@example.com"),
            _event(2, "request", placeholder="[EMAIL_1]", entity_type="EMAIL", reason="reply", context="c"),
            _event(3, "mapping", placeholder="[EMAIL_1]", original="later@example.com"),
            _event(4, "request", placeholder="[NO_1]", entity_type="NO", reason="r"),
            _event(5, "request", placeholder="[EMAIL_1]", entity_type="EMAIL", reason="again"),
            _event(6, "resolve", request_id="REQ-1", action="follow_up", message="why?"),
            _event(7, "resolve", request_id="REQ-1", action="approve"),
            _event(8, "resolve", request_ids=["REQ-2", "REQ-999"], action="approve"),
            _event(9, "resolve", request_id="REQ-1", action="deny"),
            _event(10, "resolve", request_id="REQ-3", action="deny"),
            _event(11, "resolve", request_id="REQ-3", action="nonsense"),
            _event(12, "resolve", action="approve"),
            _event(13, "resolve", request_ids=[], request_id="REQ-3", action="deny"),
        ],
        R.EVENTS,
    )
    req = R.create_requests(ev)
    rep = R.resolve_replies(ev, req)
    got = {(r.seq, r.pos): r for r in rep.collect()}
    assert got[(6, 0)].reply == 'Follow-up question sent to agent: "why?"'
    assert got[(7, 0)].reply == "Access approved. Original text: john@example.com"
    assert got[(8, 0)].status == "approved" and got[(8, 0)].original_text is None
    assert got[(8, 1)].error == 'Request "REQ-999" not found.'
    assert "already approved" in got[(9, 0)].error
    assert got[(10, 0)].reply == "Access denied."
    assert got[(11, 0)].error == 'Invalid action "nonsense". Must be one of: approve, deny, follow_up'
    assert got[(12, 0)].error == "Either request_id or request_ids must be provided."
    assert "already denied" in got[(13, 0)].error
    view = {r.request_id: r for r in R.list_requests(R.request_table(req, rep)).collect()}
    assert view["REQ-1"].original_text == "john@example.com"
    assert view["REQ-1"].follow_up_message is None and view["REQ-1"].response_message is None
    assert view["REQ-3"].original_text is None and view["REQ-3"].resolved_at is not None
    bad = R.list_requests(R.request_table(req, rep), "open").collect()
    assert "Invalid status filter" in bad[0].error


def test_evictions_without_returns_stay_parallel(spark):
    """Placeholders that are written for a while and never again after they left the map."""
    rng = random.Random(11)
    rows = []
    for s in range(3):
        for i in range(200):
            base = i // 5
            kind = "mapping" if i % 5 < 3 else "request"
            n = base if i % 5 == 0 else rng.randint(max(0, base - 2), base)
            rows.append({**_event(i, kind, placeholder=f"[P_{n}]", entity_type="P"), "session_id": f"s{s}",
                         "ts": dt.datetime(2024, 1, 1), "original": f"v{i}" if kind == "mapping" else None})
    ev = spark.createDataFrame(rows, R.EVENTS)
    sessions, made, _ = model.run(rows, 10_000, 4)
    writes = R.mapping_events(ev)
    _, returning = M._queue(M.merge_mapping(writes), 4, 64)
    assert returning.isEmpty()
    got = {}
    for r in M.evict_fifo(writes, 4, span=64).orderBy("first_seq", "first_ord").collect():
        got.setdefault(r.session_id, []).append((r.placeholder, r.original))
    assert got == {s: list(x.map.items()) for s, x in sessions.items()}
    req = R.create_requests(ev, cap=10_000, max_mappings=4, span=64).collect()
    assert {(r.session_id, r.seq): r.original_text for r in req} == {
        k: sessions[k[0]].requests[rid]["original_text"] for k, rid in made.items()
    }


@pytest.mark.parametrize("reach", [2, 30])
def test_eviction_settles_per_record(spark, reach):
    """Several placeholders per record; with a short reach none returns, with a long one many do."""
    rng = random.Random(reach)
    rows, sessions = [], {}
    for s in range(4):
        x = sessions.setdefault(f"s{s}", model.Session(max_mappings=6))
        for seq in range(120):
            top = seq + 1
            names = rng.sample(range(max(0, top - reach), top + 2), min(3, reach + 1))
            pairs = [(f"[P_{n}]", f"v{s}-{seq}-{n}") for n in names]
            rows += [(f"s{s}", seq, i, p, v) for i, (p, v) in enumerate(pairs)]
            x.write(pairs)
    writes = spark.createDataFrame(rows, M.WRITES).repartition(4)
    assert M._queue(M.merge_mapping(writes), 6, 32)[1].isEmpty() == (reach == 2)
    got = {}
    for r in M.evict_fifo(writes, 6, span=32).orderBy("first_seq", "first_ord").collect():
        got.setdefault(r.session_id, []).append((r.placeholder, r.original))
    assert got == {s: list(x.map.items()) for s, x in sessions.items()}


def test_null_sessions_and_equal_seq(spark):
    """Events without a session are one session; requests of one seq are told apart, whether the cap binds or not."""
    at = dt.datetime(2024, 1, 1)

    def event(session, seq, kind, **more):
        row = dict.fromkeys(("placeholder", "original", "entity_type", "reason", "context", "request_id", "request_ids", "action", "message"))
        return {"session_id": session, "seq": seq, "ts": at, "kind": kind, **row, **more}

    rows = [event(s, 1, "mapping", placeholder="[EMAIL_1]", original=f"of {s}") for s in (None, "a")]
    rows += [event(s, q, "request", placeholder="[EMAIL_1]", entity_type="EMAIL") for s in (None, "a") for q in (2, 2, 3)]
    rows += [event(None, None, "request", placeholder="[EMAIL_1]", entity_type="EMAIL")]
    rows += [event(None, 4, "resolve", request_id="REQ-2", action="approve")]
    ev = spark.createDataFrame(rows, R.EVENTS).coalesce(1)
    for cap, maps in ((50, 10), (2, 10), (2, 1)):
        made = R.create_requests(ev, cap=cap, max_mappings=maps).collect()
        for session, n in ((None, 4), ("a", 3)):
            own = [r for r in made if r.session_id == session]
            assert len(own) == n
            assert sorted(r.request_id for r in own if r.request_id) == [f"REQ-{i + 1}" for i in range(min(cap, n))]
            assert {r.original_text for r in own if r.request_id and r.seq} == {f"of {session}"}
    assert [r.original_text for r in made if r.seq is None] == [None]
    rep = R.resolve_replies(ev, R.create_requests(ev)).collect()
    assert [(r.session_id, r.status, r.original_text) for r in rep] == [(None, "approved", "of None")]
    merged = M.evict_fifo(R.mapping_events(ev), cap=1)
    keys = spark.createDataFrame([(None, "[EMAIL_1]"), ("a", "[EMAIL_1]"), ("b", "[EMAIL_1]")], "session_id string, placeholder string")
    assert {r.session_id: r.original for r in M.lookup_original(keys, merged).collect()} == {None: "of None", "a": "of a", "b": None}
