"""Pairs and neighbours of customers against sets, with entities on both sides of the bound."""

import random
from collections import Counter

from riskframe.operators.graph import customer_neighbours, shared_entity_pairs

DEVICES, IPS = "customer_id string, device_id string, n int", "customer_id string, ip_address string, n int"


def sample(seed=5):
    rng = random.Random(seed)
    who = lambda: rng.choice([f"c{i}" for i in range(40)] + [None])
    devices = [(who(), rng.choice([f"d{i}" for i in range(25)] + [None]), 1) for _ in range(70)]
    ips = [(who(), rng.choice([f"i{i}" for i in range(25)]), 1) for _ in range(40)]
    ips += [(f"c{i}", "popular", 1) for i in range(30)] + [(f"only{i}", "popular", 1) for i in range(300)]
    return devices + devices[:5], ips


def test_pairs_and_neighbours(spark):
    devices, ips = sample()
    usage = {(kind, e, c) for kind, rows in (("device", devices), ("ip", ips)) for c, e, _ in rows if c is not None and e is not None}
    members = {}
    for kind, entity, customer in usage:
        members.setdefault((kind, entity), set()).add(customer)
    tables = spark.createDataFrame(devices, DEVICES), spark.createDataFrame(ips, IPS)

    want = Counter((a, b, kind) for (kind, _), people in members.items() if len(people) <= 8 for a in people for b in people if a < b)
    got = {(r["a"], r["b"]): (r["shared_devices"], r["shared_ips"]) for r in shared_entity_pairs(*tables, most=8).collect()}
    assert got == {(a, b): (want[a, b, "device"], want[a, b, "ip"]) for a, b, _ in want}

    got = {r["customer_id"]: r for r in customer_neighbours(*tables, most=8).collect()}
    assert got.keys() == {c for _, _, c in usage}
    for customer, row in got.items():
        mine = [people for people in members.values() if customer in people]
        neighbours = len(set().union(*mine)) - 1
        exact = len(mine) == 1 or max(map(len, mine)) <= 8
        assert row["is_exact"] == exact, customer
        assert row["neighbours"] == neighbours if exact else abs(row["neighbours"] - neighbours) <= 0.05 * neighbours, customer
    assert sum(not r["is_exact"] for r in got.values()) >= 20 and got["only1"]["neighbours"] == 329


def test_empty(spark):
    tables = spark.createDataFrame([], DEVICES), spark.createDataFrame([], IPS)
    assert shared_entity_pairs(*tables).count() == 0 and customer_neighbours(*tables).count() == 0
