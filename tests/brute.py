"""Plain-Python versions of the batch, return and stop rules, one record at a time."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from zoneinfo import ZoneInfo

MADRID = ZoneInfo("Europe/Madrid")
UTC = dt.timezone.utc


def local(t):
    return t.replace(tzinfo=UTC).astimezone(MADRID)


def batches(rows):
    """rows: (topic, line, timestamp, identity, article).  Returns batches in order of opening per line."""
    out, open_of = [], {}
    for topic, line, t, ident, art in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3], r[4])):
        cur = open_of.get((topic, line))
        reason = None
        if cur is None or cur["end"].date() != t.date() or cur["article"] != art:
            reason = "new_article"
        elif (t - cur["end"]).total_seconds() > 3600 or local(t).date() > local(cur["end"]).date():
            reason = "timeout"
        if reason is None:
            cur["end"] = max(cur["end"], t)
            cur["n"] += 1
            continue
        new = dict(topic=topic, line=line, article=art, start=t, end=t, reason=reason, n=1, closed=None, order=len(out))
        if cur is not None:
            cur["closed"] = t
        open_of[(topic, line)] = new
        out.append(new)
    count = defaultdict(int)
    for b in sorted(out, key=lambda b: (b["topic"], b["start"], b["line"], b["order"])):
        count[b["topic"], b["article"]] += 1
        b["seq"] = count[b["topic"], b["article"]]
    return out


def returns(bs, cap):
    found = []
    days = defaultdict(list)
    for b in bs:
        days[b["topic"], b["start"].date()].append(b)
    for group in days.values():
        closed = [b for b in group if b["closed"] is not None and b["closed"].date() == b["start"].date()]
        closed.sort(key=lambda b: (b["closed"], b["line"], b["order"]))
        for n in group:
            if n["reason"] != "new_article":
                continue
            so_far = [p for p in closed if p["closed"] <= n["start"]]
            for p in so_far[-cap:]:
                if p["article"] == n["article"] and p["end"] < n["start"]:
                    found.append((n["topic"], n["line"], n["article"], n["seq"], p["line"], p["start"], p["end"]))
                    break
    return found


def stops(rows):
    """Second-by-second would be too slow; check the alert instant directly against the stated conditions."""
    out = []
    lines = defaultdict(list)
    for topic, line, t, ident, art in rows:
        lines[topic, line].append(t)
    for (topic, line), ts in lines.items():
        ts.sort()
        for i, last in enumerate(ts):
            nxt = ts[i + 1] if i + 1 < len(ts) else None
            day_start = dt.datetime.combine(local(last).date(), dt.time(6), MADRID).astimezone(UTC).replace(tzinfo=None)
            fire = max(last + dt.timedelta(seconds=600), day_start)
            a, f = local(last), local(fire)
            limit = dt.time(13, 30) if a.time() < dt.time(15) else dt.time(19, 30)
            if (nxt is None or fire < nxt) and a.date() == f.date() and f.time() < limit:
                out.append((topic, line, last, fire))
    return out
