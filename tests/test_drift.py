import random
from datetime import date

from starlane.operators import drift

DAYS = [date(2025, 9, n) for n in (1, 2, 3)]


def frame(spark, seed=1, shift=None):
    rng = random.Random(seed)
    rows = []
    for n, day in enumerate(DAYS):
        for _ in range(3000):
            amount = rng.lognormvariate(5, 1) * (shift if shift and n == 2 else 1)
            rows.append((day, round(amount, 2) if rng.random() > 0.01 else None, rng.randrange(-1, 9), rng.choices("abc", [90, 9, 1 + 30 * bool(shift and n == 2)])[0]))
        rows += [(day, 0.0, 0, f"rare {i}") for i in range(3)] + [(day, 1e300, 0, None)]
    return spark.createDataFrame(rows, "day date, amount double, days int, place string"), rows


def test_quantiles_are_within_one_step(spark):
    rows, plain = frame(spark)
    profile = drift.number_profile(rows, "day", ["amount", "days"])
    for per_mille in (10, 250, 500, 900, 999, 1000):
        found = {(r.day, r.column_name): r.value for r in drift.quantile(profile, per_mille).collect()}
        for day in DAYS:
            for column, at in (("amount", 1), ("days", 2)):
                own = sorted(r[at] for r in plain if r[0] == day and r[at] is not None and r[at] < 1e200)
                exact = own[max(0, -(-len(own) * per_mille // 1000) - 1)]
                assert abs(found[day, column]) <= abs(exact) and abs(found[day, column] - exact) <= 0.01 * abs(exact) + 1e-9


def test_profiles_add_up(spark, rows):
    table, _ = frame(spark)
    whole = drift.number_profile(table, "day", ["amount", "days"])
    halves = [drift.number_profile(table.filter(c), "day", ["amount", "days"]) for c in ("days < 3", "days >= 3")]
    assert rows(drift.added(halves), *whole.columns) == rows(whole)


def test_a_planted_shift_is_found_and_no_other(spark):
    for shift in (None, 1.5):
        table, plain = frame(spark, shift=shift)
        numbers = {(r.column_name, r.day): r for r in drift.number_drift(drift.number_profile(table, "day", ["amount", "days"])).collect()}
        words = {r.day: r for r in drift.text_drift(drift.text_profile(table, "day", ["place"])).collect()}
        assert set(words) == set(DAYS[1:]) and len(numbers) == 4
        found = {day: (numbers["amount", day].distance_per_mille, words[day].distance_per_mille) for day in DAYS[1:]}
        assert max(found[DAYS[1]]) < 50
        assert min(found[DAYS[2]]) > 100 if shift else max(found[DAYS[2]]) < 50
        for day in DAYS[1:]:
            own = [r for r in plain if r[0] == day]
            assert numbers["days", day].not_positive == sum(r[2] <= 0 for r in own)
            assert numbers["amount", day].nulls == sum(r[1] is None or r[1] > 1e200 for r in own)
            assert numbers["amount", day].rows == words[day].rows == len(own)
        # The distance equals that of exact distributions over the same steps.
        exact = max(
            abs(sum(r[2] <= v for r in plain if r[0] == DAYS[2]) / 3004 - sum(r[2] <= v for r in plain if r[0] == DAYS[1]) / 3004)
            for v in range(-1, 9)
        )
        assert numbers["days", DAYS[2]].distance_per_mille == int(exact * 1000 + 1e-9)


def test_one_day_and_no_rows(spark):
    table, _ = frame(spark)
    for some in (table.filter(table.day == DAYS[0]), table.limit(0)):
        assert drift.number_drift(drift.number_profile(some, "day", ["amount"])).count() == 0
        assert drift.text_drift(drift.text_profile(some, "day", ["place"])).count() == 0
