"""Plain-Python versions of the grouping rules, row loop by row loop, for
checking the Spark plans on small fixtures."""

from collections import defaultdict


def assign_groups(rows):
    """rows: list of (order, county, puma, weight) in any order.
    Returns {county: label}."""
    rows = sorted(rows, key=lambda r: r[0])
    counties_of = defaultdict(set)
    pumas_of = defaultdict(set)
    w = defaultdict(float)
    first_seen = []
    seen = set()
    for order, c, p, wt in rows:
        if c is not None and c not in seen:
            seen.add(c)
            first_seen.append(c)
        if c is None or p is None:
            continue
        counties_of[p].add(c)
        pumas_of[c].add(p)
        w[(c, p)] += float(wt)
    multi = {p for p, cs in counties_of.items() if len(cs) > 1}
    choice = {}
    for c in first_seen:
        cands = [p for p in pumas_of[c] if p in multi]
        if not cands:
            choice[c] = None
        else:
            choice[c] = sorted(cands, key=lambda p: (-w[(c, p)], p))[0]
    ids, label = {}, {}
    for c in first_seen:
        p = choice[c]
        if p is None:
            label[c] = f"independent_county_{c}"
        else:
            if p not in ids:
                ids[p] = len(ids)
            label[c] = f"county_group_{ids[p]}"
    size = defaultdict(set)
    for c, g in label.items():
        size[g].add(c)
    for c, g in list(label.items()):
        if g.startswith("county_group_") and len(size[g]) == 1:
            label[c] = f"independent_county_{c}"
    return label


def split_by_zone(label, zone):
    """label: {county: group}; zone: {county: zone or None}."""
    groups = defaultdict(list)
    for c, g in label.items():
        groups[g].append(c)
    used = [int(g[len("county_group_"):]) for g in groups if g.startswith("county_group_")
            and g[len("county_group_"):].isdigit()]
    nxt = (max(used) + 1) if used else 0
    out = dict(label)
    for g in sorted(groups):
        if not g.startswith("county_group_"):
            continue
        by_zone = defaultdict(set)
        for c in groups[g]:
            by_zone[zone.get(c) if zone.get(c) is not None else "__MISSING__"].add(c)
        ranked = sorted(by_zone, key=lambda z: (-len(by_zone[z]), z))
        for z in ranked[1:]:
            for c in by_zone[z]:
                out[c] = f"county_group_{nxt}"
            nxt += 1
    return out


def merge(label, zone, first, specs):
    """specs: list of (source, target) in order; first: {county: order}."""
    gz = {}
    for c in sorted(label, key=lambda c: first[c]):
        g = label[c]
        if g not in gz and zone.get(c) is not None:
            gz[g] = zone[c]
    mapping = {}
    for s, t in specs:
        if gz.get(s) == gz.get(t):
            mapping[s] = t
    return {c: mapping.get(g, g) for c, g in label.items()}
