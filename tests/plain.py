"""Slow and obvious versions of the operators, for small inputs."""

import math

RADIUS = 6_371_000.0


def haversine(lat1, lng1, lat2, lng2):
    a, b, c, d = (math.radians(x) for x in (lat1, lng1, lat2, lng2))
    s, t = math.sin((c - a) / 2), math.sin((d - b) / 2)
    return RADIUS * (2 * math.asin(min(1.0, math.sqrt(s * s + math.cos(a) * math.cos(c) * (t * t)))))


def planar(lat1, lng1, lat2, lng2):
    return math.sqrt((lat1 - lat2) * (lat1 - lat2) + (lng1 - lng2) * (lng1 - lng2))


def nearest(left, right, metric=haversine):
    """{left id: (distance, right id)} of (id, lat, lng) rows."""
    return {i: min((metric(a, b, c, d), j) for j, c, d in right) for i, a, b in left}


def nearest_other(points, metric=planar):
    return {i: min(metric(a, b, c, d) for j, c, d in points if j != i) for i, a, b in points}


def components(points, eps):
    """{id: lowest id of its group, -1 when alone}."""
    parent = {i: i for i, _, _ in points}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    linked = set()
    for n, (i, a, b) in enumerate(points):
        for j, c, d in points[:n]:
            if planar(a, b, c, d) <= eps:
                linked |= {i, j}
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return {i: root(i) if i in linked else -1 for i in parent}


def dbscan(points, eps, samples):
    """{id: label}: clusters of core points by lowest core id, border points with the lowest label."""
    near = {i: [j for j, c, d in points if planar(a, b, c, d) <= eps] for i, a, b in points}
    core = {i for i, others in near.items() if len(others) >= samples}
    label = {}
    for i in sorted(core):
        stack = [i] if i not in label else []
        while stack:
            at = stack.pop()
            if at in core and at not in label:
                label[at] = i
                stack += near[at]
    return {i: label.get(i, min((label[j] for j in near[i] if j in core), default=-1)) for i in near}


def greedy(stops, buses, demand):
    """{bus: (stop, students)}, edges taken in order of distance, stop, bus."""
    edges = sorted((haversine(a, b, c, d), s, bus, seats) for s, a, b in stops for bus, c, d, seats in buses)
    left, out = dict(demand), {}
    for _, stop, bus, seats in edges:
        if left.get(stop, 0) > 0 and bus not in out:
            served = min(left[stop], seats)
            left[stop] -= served
            out[bus] = (stop, served)
    return out
