"""Slot rules against a plain greedy loop on random offers that share products."""

import random

import pytest

from offerlens.operators import ranking as T


def greedy(cands, products, forced, n_fixed, n_free):
    out = []
    slots = {(b, c, s) for b, c, k, s in forced if k == 1}
    barred = {(b, c) for b, c, k, _ in forced if k == 0}
    for seller in {c[0] for c in cands}:
        mine = sorted([(-p, o, p) for s, o, t, p in cands if s == seller and t == 0 and p != 0])
        mine = [m for m in mine if any(x[0] == m[1] for x in products)]
        taken = []
        for slot in range(1, n_fixed + 1):
            for _, o, p in mine:
                fits = any(x[0] == o and (x[2], x[3], slot) in slots for x in products)
                if fits and o not in [t[0] for t in taken]:
                    taken.append((o, p, "F", slot))
                    break
        capacity, rest, n = n_fixed + n_free - len(taken), [], 0
        free = {o: {x[1] for x in products if x[0] == o and (x[2], x[3]) not in barred}
                for _, o, _ in mine}
        rest = [m for m in mine if m[1] not in [t[0] for t in taken] and free[m[1]]]
        while rest and n < capacity:
            _, o, p = rest[0]
            n += 1
            taken.append((o, p, "N", n))
            rest = [m for m in rest if m[1] != o and not free[m[1]] & free[o]]
        out += [(seller, *t) for t in taken]
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_slots_match_greedy(spark, seed):
    rng = random.Random(seed)
    brands, categories = ["b1", "b2", "b3"], ["c1", "c2"]
    names = [f"p{i}" for i in range(9)]
    of = {p: (rng.choice(brands), rng.choice(categories)) for p in names}
    products = sorted({(f"o{i:02d}", p, *of[p]) for i in range(14)
                       for p in rng.sample(names, rng.randint(1, 3))})
    cands = [(s, f"o{i:02d}", int(rng.random() < 0.2), rng.choice([0.0, 0.1, 0.25, 0.5, 0.75, 1.0]))
             for s in range(25) for i in range(14) if rng.random() < 0.8]
    forced = [("b1", "c1", 1, 1), ("b2", "c2", 1, 1), ("b3", "c1", 1, 2), ("b9", "c9", 1, 3),
              ("b2", "c1", 0, None)]
    n_fixed, n_free = 3, 2
    plan = spark.createDataFrame([(8, 3, n_fixed, n_free)],
                                 "slots int, top_slots int, fixed_slots int, free_slots int")
    cards = T.offer_cards(
        spark.createDataFrame(products, "offer_id string, product_id string, brand string, category string"),
        spark.createDataFrame(forced, "brand string, category string, forced_kind int, slot int"))
    got = T.fill_slots(
        spark.createDataFrame(cands, "seller_id int, offer_id string, flag_top int, probability double"), cards, plan)
    rows = sorted((r.seller_id, r.offer_id, r.probability, r.type, r["rank"]) for r in got.collect())
    assert rows == greedy(cands, products, forced, n_fixed, n_free)


def test_no_fixed_slots(spark):
    plan = spark.createDataFrame([(2, 0, 0, 2)],
                                 "slots int, top_slots int, fixed_slots int, free_slots int")
    cands = spark.createDataFrame([(1, "a", 0, 0.5), (1, "b", 0, 0.9), (1, "c", 0, 0.1)],
                                  "seller_id int, offer_id string, flag_top int, probability double")
    products = spark.createDataFrame([("a", "x", "b", "c"), ("b", "y", "b", "c"), ("c", "z", "b", "c")],
                                     "offer_id string, product_id string, brand string, category string")
    none = spark.createDataFrame([], "brand string, category string, forced_kind int, slot int")
    got = T.fill_slots(cands, T.offer_cards(products, none), plan)
    assert sorted((r.offer_id, r["rank"]) for r in got.collect()) == [("a", 2), ("b", 1)]


def test_final_order_ranks_are_dense(spark):
    schema = "seller_id int, offer_id string, probability double, type string"
    top = spark.createDataFrame([(1, "t", 0.1, "T")], schema)
    rest = spark.createDataFrame([(1, "f", 0.9, "F"), (1, "n2", 0.5, "N"), (1, "n1", 0.5, "N")], schema)
    got = sorted((r["order"], r.offer_id) for r in T.final_order(top, rest).collect())
    assert got == [(1, "t"), (2, "n1"), (3, "n2"), (4, "f")]


def test_slot_plan_reads_missing_as_zero(spark):
    counts = spark.createDataFrame([], "target_cycle string, slots int, top_slots int")
    none = spark.createDataFrame([], "brand string, category string, forced_kind int, slot int")
    assert tuple(T.slot_plan(counts, none).first()) == (0, 0, 0, 0)
