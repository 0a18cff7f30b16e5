"""Plain-Python, one-event-at-a-time models of the loaders' rules (compare, close, insert,
look up, update), used as the expected results for the set-based operators."""

from __future__ import annotations


def account_model(events, seed, az, accr, close):
    """events: dicts id, seq, prt_code, op_type, attrs...; seed: dim rows (dicts with
    id, eff_seq, end_seq, ...); az: {id: rate}; accr: {id: rate}.  Returns dim rows."""
    dim = [dict(r) for r in seed]
    state = {}
    for e in sorted(events, key=lambda r: r["seq"]):
        cmp = (e["prt_code"], e["op_type"])
        if e["id"] in state and state[e["id"]] == cmp:
            continue
        rows = [r for r in dim if r["id"] == e["id"]]
        if close == "all_rows":
            if rows:  # exists in the dimension (any version): stamp every row
                for r in rows:
                    r["end_seq"] = e["seq"]
        else:
            for r in rows:
                if r["end_seq"] is None:
                    r["end_seq"] = e["seq"]
        rate = az[e["id"]] if e["id"] in az else accr.get(e["id"])
        dim.append({"id": e["id"], "eff_seq": e["seq"], "end_seq": None, "rate": rate,
                    "prt_code": e["prt_code"], "op_type": e["op_type"], "new": True})
        state[e["id"]] = cmp
    return dim


def product_model(events, seed, close):
    """events: dicts product_no, seq, attrs (tuple); seed: rows with attrs/eff/end."""
    dim = [dict(r) for r in seed]
    for e in sorted(events, key=lambda r: r["seq"]):
        rows = [r for r in dim if r["product_no"] == e["product_no"]]
        cur = next((r for r in rows if r["end_seq"] is None), None)
        if cur is not None:
            if cur["attrs"] == e["attrs"]:
                continue
            for r in rows if close == "all_rows" else [cur]:
                r["end_seq"] = e["seq"]
        dim.append({"product_no": e["product_no"], "eff_seq": e["seq"], "end_seq": None, "attrs": e["attrs"],
                    "new": True})
    return dim


def rate_model(events, dim_rates):
    """events: (seq, key, rate, source); dim_rates: {key: rate}.  Returns the rate seen
    before each event of a known key, and the final rates."""
    cur = dict(dim_rates)
    before = {}
    for seq, key, rate, source in sorted(events):
        if key not in cur:
            continue
        before[seq] = cur[key]
        if source == "overwrite" and rate is not None:
            cur[key] = rate
        elif source == "fill" and rate is not None and cur[key] is None:
            cur[key] = rate
    return before, cur
