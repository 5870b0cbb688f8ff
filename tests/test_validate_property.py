"""Randomised check: messages drawn field by field from forms whose verdict is known.

Forms cover absent keys, nulls, empty and blank strings, wrong-case types,
numbers / numeric strings / booleans / objects for quantity, and currencies.
A message is valid when every field drew a good form.  All are validated in
one Spark job.
"""

import json
import random

from strata.functions import validate as V

ABSENT = object()

# Per field the forms that pass and those that fail.
FORMS = {
    "event_id": (["E1", "E2", 7], ["", None, ABSENT]),
    "customer_id": (["C1", " ", 5], ["", None, ABSENT]),
    "product_id": (["P1"], ["", None, ABSENT]),
    "event_type": (["view", "purchase", "add_to_cart"], ["Purchase", " view", "click", "", None, ABSENT, ["view"]]),
    "timestamp": (["2026-03-10T09:15:00Z", "nonsense"], ["", None, ABSENT]),
    "quantity": ([1, 2, 3.9, "2", " 3 ", True, 9007199254740993, 1e2, "+5"],
                 [0, -1, 0.5, -2.5, "2.7", "x", "", False, None, ABSENT, {"z": 1}, [1], "-4"]),
    "currency": ([ABSENT, "USD", "SAR"], ["XXX", "", None, "usd"]),
}


def draw_message(rnd):
    """(message, is it valid): each field is good in nine draws of ten."""
    drawn = {field: (rnd.random() < 0.9, good, bad) for field, (good, bad) in FORMS.items()}
    message = {field: rnd.choice(good if fine else bad) for field, (fine, good, bad) in drawn.items()}
    return {k: v for k, v in message.items() if v is not ABSENT}, all(fine for fine, _, _ in drawn.values())


def test_random_messages_agree(spark):
    rnd = random.Random(20260101)
    drawn = [draw_message(rnd) for _ in range(3000)]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, (d, _) in enumerate(drawn)], "n int, value string")
    got = {r.n: r.is_valid for r in V.classify(df).select("n", "is_valid").collect()}
    wrong = [(d, want, got[i]) for i, (d, want) in enumerate(drawn) if got[i] != want]
    assert not wrong, wrong[:10]
    assert 200 < sum(want for _, want in drawn) < 2800  # the draw exercises both outcomes
