"""Row-by-row models of the state machines, used only to check the Spark operators."""

from __future__ import annotations

from datetime import datetime, timedelta

T0 = datetime(2024, 3, 1, 6, 0, 0)


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


def daily(rows, work_gap_s=300, cap=500.0):
    """rows: (vehicle, ts, seq, mileage, energy, fuel) -> {(day, vehicle): dict}."""
    out = {}
    for v, ts, _, mile, energy, fuel in sorted(rows, key=lambda r: (r[1], r[2])):
        key = (ts.strftime("%Y%m%d"), v)
        s = out.get(key)
        if s is None:
            s = out[key] = dict(start=ts, end=ts, work=0.0, count=0.0, mile=[0.0, 0.0], energy=[0.0, 0.0], fuel=[0.0, 0.0])
        else:
            gap = (ts - s["end"]).total_seconds()
            if gap < work_gap_s:
                s["work"] += gap
            s["end"] = ts
        for name, value in (("mile", mile), ("energy", energy), ("fuel", fuel)):
            pair = s[name]
            if value is not None and value > 0 and value >= pair[0]:
                pair[1] = max(pair[1], value)
                if pair[0] == 0:
                    pair[0] = pair[1]
        moved = s["mile"][1] - s["mile"][0]
        if 0 < moved < cap:
            s["count"] = moved
    return out


def episodes(rows, gap_s):
    """rows: (key, ts, seq, hot) with hot True, False or None -> [(key, begin, end or None)]."""
    open_, done = {}, []
    for key, ts, _, hot in sorted(rows, key=lambda r: (r[1], r[2])):
        if hot is None:
            continue
        if hot:
            if key in open_:
                open_[key][1] = ts
            else:
                open_[key] = [ts, ts]
        elif key in open_ and (ts - open_[key][1]).total_seconds() > gap_s:
            begin, last = open_.pop(key)
            done.append((key, begin, last))
    return done + [(k, b, None) for k, (b, _) in open_.items()]


def sessions(rows, gap_s):
    """rows: (vehicle, ts, seq, charging, in_charge, soc) -> closed and open session tuples."""
    open_, done = {}, []
    for v, ts, _, charging, charge, soc in sorted(rows, key=lambda r: (r[1], r[2])):
        s = open_.get(v)
        if charging:
            if s is None:
                open_[v] = dict(begin=ts, first=charge, start=charge, end=charge, soc0=soc, soc1=soc, last=ts)
            else:
                if soc > 0:
                    s["soc1"] = soc
                if s["start"] <= 0:
                    s["start"] = s["end"]
                s["end"], s["last"] = charge, ts
        elif s is not None and (ts - s["last"]).total_seconds() > gap_s:
            done.append((v, s["begin"], s["last"], s["start"], s["end"], s["soc0"], s["soc1"], False))
            del open_[v]
    return done + [(v, s["begin"], None, s["first"], None, s["soc0"], None, True) for v, s in open_.items()]
