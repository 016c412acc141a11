"""Property test: the rule sweep equals a brute-force count on random
events, random rule tables (with duplicates) and random bucket sizes, for
both tie semantics."""

import random

import pytest

from faultline.operators.rules import apply_rules
from faultline.sources.schema import RULES_SCHEMA
from helpers import MIN, T0


def _brute(events, rules, ties):
    best = {}
    for ev, q, w in sorted(rules, key=lambda r: (r[1], r[2])):
        best.setdefault(ev, (q, w))
    out = {}
    for e in events:
        if e["TAG"] is None or e["Alarme"] not in best:
            out[e["event_id"]] = 0
            continue
        q, w = best[e["Alarme"]]
        t = e["ts_us"]
        peers = [o for o in events if o["TAG"] == e["TAG"] and o["Alarme"] == e["Alarme"]
                 and t - w * MIN < o["ts_us"] <= t]
        if ties == "row":
            peers = [o for o in peers if (o["ts_us"], o["event_id"]) <= (t, e["event_id"])]
        out[e["event_id"]] = int(len(peers) >= q)
    return out


@pytest.mark.parametrize("seed", [3, 5])
def test_rules_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    events = []
    for i in range(220):
        m = rnd.choice([rnd.uniform(0, 2000), float(rnd.randrange(0, 2000, 10))])
        events.append({"event_id": i, "TAG": rnd.choice(["A", "A", "A", "B", None]),
                       "Alarme": rnd.choice(["x", "y", "z", None]), "ts_us": T0 + int(m * MIN), "Is_Dont_Go": 0})
    rules = [(rnd.choice(["x", "y", "q"]), rnd.randint(1, 4), rnd.choice([10, 30, 45, 120, 600])) for _ in range(6)]
    ev = spark.createDataFrame(events, "event_id long, TAG string, Alarme string, ts_us long, Is_Dont_Go int")
    rt = spark.createDataFrame(rules, RULES_SCHEMA)
    for ties in ("range", "row"):
        for bucket in (rnd.choice([7 * MIN, 60 * MIN]), 24 * 60 * MIN, None):
            out = apply_rules(ev.repartition(rnd.randint(1, 4)), rt, bucket_us=bucket, ties=ties,
                              tiebreak="event_id")
            got = {r["event_id"]: r["Is_Dont_Go_derived"] for r in out.collect()}
            assert got == _brute(events, rules, ties), (ties, bucket)
