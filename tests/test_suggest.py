import random

import pytest

from starlane.operators import checks, dims, suggest


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def texts(rng, n):
    for _ in range(n):
        yield "".join(rng.choices("abcé -", k=rng.choice([0, 1, 1, 2, 2, 3, 4, 5, 8, 12, 20])))


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_nearest_against_all_pairs(spark, edits):
    rng = random.Random(edits)
    known = [(k, t) for k in ("x", "y") for t in texts(rng, 60)]
    unknown = [(k, t) for k in ("x", "y", "z") for t in texts(rng, 80)]
    for k, t in known[::3]:  # near ones
        t = list(t)
        for _ in range(rng.randrange(1, edits + 2)):
            at = rng.randrange(len(t) + 1)
            t[at:at + rng.randrange(2)] = rng.choices("abz", k=rng.randrange(2))
        unknown.append((k, "".join(t)))
    unknown += [("x", None)] + unknown[:5]
    found = suggest.nearest(
        spark.createDataFrame(unknown, "kind string, text string"),
        spark.createDataFrame(known + [("y", None)], "kind string, text string"), edits,
    ).collect()
    want = set()
    for kind, text in set(unknown):
        if text is None:
            continue
        near = sorted((distance(text, other), other.encode(), other) for k, other in set(known) if k == kind and distance(text, other) <= edits)
        if near:
            want.add((kind, text, near[0][2], near[0][0]))
    assert {tuple(r) for r in found} == want and len(found) == len(want)


def test_misspelt_airport(spark):
    unresolved = spark.createDataFrame(
        [("pickup_location", "Chicago - O'Hare Airport", 7), ("dropoff_location", "Nowhere", 1), ("car", "Tesla|Model  S|2022", 2), ("customer", "C1", 1)],
        "role string, natural_value string, rentals long",
    )
    found = checks.lookup_suggestions(unresolved, {"car_dim": dims.seed_cars(spark), "location_dim": dims.seed_locations(spark)})
    assert {(r.role, r.suggestion, r.edits, r.rentals) for r in found.collect()} == {
        ("pickup_location", "Chicago - OHare Airport", 1, 7), ("dropoff_location", None, None, 1), ("car", "Tesla|Model S|2022", 1, 2),
    }
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
