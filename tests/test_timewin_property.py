"""Property test: the bucketed window engine equals a brute-force
definition of every feature on random inputs (ties, sparse and dense keys,
inverted intervals, intervals with equal starts, arbitrary bucket sizes)."""

import random

import pytest

from faultline.plans.features import DEFAULT_MINUTES_SINCE, LABEL_HORIZONS, LOOKBACK_WINDOWS, build_features
from helpers import MIN, T0


def _brute(events, intervals):
    out = {}
    by_tag = {}
    for e in events:
        if e["TAG"] is not None:
            by_tag.setdefault(e["TAG"], []).append(e)
    for tag, rows in by_tag.items():
        first = min(rows, key=lambda r: (r["ts_us"], r["event_id"]))
        ivs = [i for i in intervals if i["Tag"] == tag]
        for r in rows:
            t = r["ts_us"]
            f = {}
            for name, span in LOOKBACK_WINDOWS.items():
                f[name] = sum(1 for o in rows if t - span < o["ts_us"] <= t)
            f["critical_alarm_count_1h"] = sum(1 for o in rows if t - 60 * MIN < o["ts_us"] <= t
                                               and o["Id_Criticidade"] == 1)
            crit = [o["ts_us"] for o in rows if o["ts_us"] <= t and o["Id_Criticidade"] == 1]
            f["time_since_last_critical"] = (t - max(crit)) / 60_000_000.0 if crit else DEFAULT_MINUTES_SINCE
            f["tipo_caminhao"] = 1 if first["Tipo"] == "Caminhao" else 0
            for name, h in LABEL_HORIZONS.items():
                f[name] = int(any(t < o["ts_us"] <= t + h and o["Is_Dont_Go"] == 1 for o in rows))
            cands = [i for i in ivs if i["inicio_us"] <= t]
            if cands:
                best = max(cands, key=lambda i: (i["inicio_us"], i["fim_us"], i["Classe"]))
                f["current_state"] = best["Classe"] if t <= best["fim_us"] else "Desconhecido"
            else:
                f["current_state"] = "Desconhecido"
            out[r["event_id"]] = f
    return out


@pytest.mark.parametrize("seed", [7, 11, 23])
def test_engine_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    tags = ["A", "B", "C", None]
    events = []
    for i in range(260):
        tag = rnd.choice(tags[:1] * 6 + tags)  # "A" is hot
        m = rnd.choice([rnd.uniform(0, 3000), float(rnd.randrange(0, 3000, 15))])  # ties on a 15 min grid
        events.append({"event_id": i, "TAG": tag, "ts_us": T0 + int(m * MIN),
                       "Id_Criticidade": rnd.choice([1, 2, 2, 3]), "Is_Dont_Go": int(rnd.random() < 0.1),
                       "Tipo": rnd.choice(["Caminhao", "Escavadeira", None])})
    intervals = []
    for j in range(40):
        s = rnd.choice([rnd.uniform(0, 3000), float(rnd.randrange(0, 3000, 60))])
        e = s + rnd.uniform(-60, 400)
        intervals.append({"Tag": rnd.choice(["A", "B", "D"]), "inicio_us": T0 + int(s * MIN),
                          "fim_us": T0 + int(e * MIN), "Classe": rnd.choice(["Operando", "Parado", "Manutenção"])})
    ev = spark.createDataFrame(events, "event_id long, TAG string, ts_us long, Id_Criticidade int, "
                                       "Is_Dont_Go int, Tipo string")
    iv = spark.createDataFrame(intervals, "Tag string, inicio_us long, fim_us long, Classe string")
    expect = _brute(events, intervals)
    bucket = rnd.choice([37 * MIN, 240 * MIN, 1000 * MIN, 10 ** 14])
    got = build_features(ev.repartition(rnd.randint(1, 5)), iv, keep=["event_id"], bucket_us=bucket).collect()
    assert len(got) == len(expect)
    for r in got:
        exp = expect[r["event_id"]]
        for k, v in exp.items():
            assert r[k] == pytest.approx(v) if isinstance(v, float) else r[k] == v, (r["event_id"], k, r[k], v)
