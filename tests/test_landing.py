"""S6 by ranges of places."""

import random

from cubestar.sources.landing import missing_places, plan_coverage
from helpers import values


def named(spark, names):
    return spark.createDataFrame([("t-4", n) for n in names], "folder string, name string")


def name(places, period="1", more="_v-all", date="2020-01-01"):
    return f"t-4_p-{period}_f-A_n6-{places}{more}@{date}.json"


def state_of(spark, wanted, landed):
    plan = named(spark, [name(w) for w in wanted])
    got = plan_coverage(plan, named(spark, landed))
    return {r["name"]: (r.state, r.places, r.landed_places) for r in got.collect()}


def test_union_of_ranges(spark):
    landed = [name("0:9"), name("10:19"), name("15:29"), name("40:49"), name("60"), name("61,62"), name("40:44")]
    got = state_of(spark, ["0:29", "5:25", "0:49", "30:39", "60:62", "all", "3", "1,2,41,99", "60"], landed)
    assert got == {
        name("0:29"): ("landed", 30, 30), name("5:25"): ("landed", 21, 21), name("0:49"): ("partial", 50, 40),
        name("30:39"): ("pending", 10, 0), name("60:62"): ("landed", 3, 3), name("all"): ("pending", None, None),
        name("3"): ("landed", 1, 1), name("1,2,41,99"): ("partial", 4, 3), name("60"): ("landed", 1, 1),
    }


def test_only_the_same_request_counts(spark):
    other = [name("0:9", period="2"), name("0:9", more="_v-1"), name("0:9", date="2021-01-01"), name("all", period="3")]
    assert state_of(spark, ["0:9"], other)[name("0:9")] == ("pending", 10, 0)
    whole = plan_coverage(named(spark, [name("all", period="3")]), named(spark, other))
    assert values(whole, "state") == [("landed",)]
    assert state_of(spark, ["0:9"], [])[name("0:9")][0] == "pending"


def test_missing_ranges(spark):
    plan = named(spark, [name("0:99"), name("5:6"), name("200:201"), name("10:19")])
    landed = named(spark, [name("10:19"), name("30:39"), name("90:120")])
    got = sorted(values(missing_places(plan, landed), "name", "lo", "hi"))
    assert got == sorted([
        (name("0:99"), 0, 9), (name("0:99"), 20, 29), (name("0:99"), 40, 89), (name("5:6"), 5, 6),
        (name("200:201"), 200, 201),
    ])


def test_random_ranges(spark):
    rng = random.Random(2)

    def some(n):
        return [(a, a + rng.randrange(12)) for a in (rng.randrange(200) for _ in range(n))]

    held, asked = some(14), some(60)
    got = state_of(spark, [f"{a}:{b}" for a, b in asked], [name(f"{a}:{b}") for a, b in held])
    covered = {x for a, b in held for x in range(a, b + 1)}
    for a, b in asked:
        here = sum(x in covered for x in range(a, b + 1))
        state = "landed" if here == b - a + 1 else "partial" if here else "pending"
        assert got[name(f"{a}:{b}")] == (state, b - a + 1, here)
