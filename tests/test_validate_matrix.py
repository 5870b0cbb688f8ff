"""Validation matrix: each row changes one thing in an otherwise valid message."""

import json

import pytest
from pyspark.sql import functions as F

from strata.functions import validate as V

BASE = {"event_id": "E1", "customer_id": "C1", "product_id": "P1",
        "event_type": "purchase", "timestamp": "2026-03-10T09:17:32Z", "quantity": 2}


def _msg(change=None, drop=(), raw=None):
    if raw is not None:
        return raw
    d = dict(BASE)
    for k in drop:
        d.pop(k)
    d.update(change or {})
    return json.dumps(d)


CASES = [
    (1, _msg(), True),
    (2, _msg({"quantity": "2", "currency": "SAR"}), True),
    (3, _msg({"quantity": 2.7}), True),
    (4, _msg({"quantity": "2.7"}), False),
    (5, _msg({"quantity": True}), True),
    (6, _msg({"quantity": 0.5}), False),
    (7, _msg({"quantity": -1}), False),
    (8, _msg({"quantity": " 3 "}), True),
    (9, _msg({"event_type": "Purchase"}), False),
    (10, _msg({"customer_id": ""}), False),
    (11, _msg(drop=("timestamp",)), False),
    (12, _msg({"currency": None}), False),
    (13, _msg({"currency": "XXX"}), False),
    (14, _msg()[:-3], False),
    (15, json.dumps([BASE]), False),
    (16, _msg(drop=("quantity",)), False),
    (17, _msg({"quantity": None}), False),
    (18, _msg({"quantity": {"z": 1}}), False),
    (19, _msg({"quantity": [1]}), False),
    (20, _msg({"quantity": False}), False),
    (21, _msg(raw=_msg().replace('"quantity": 2', '"quantity": 9007199254740993')), True),
    (22, _msg() + " junk", False),
    (23, _msg(raw='{"event_id": "E1", "event_id": "E2", "customer_id": "C1", "product_id": "P1", '
                 '"event_type": "purchase", "timestamp": "t", "quantity": 2}'), True),
    (24, _msg(raw='{"event_id": "E1", "event_id": "E2", "customer_id": "C1", "product_id": "P1", '
                 '"event_type": "purchase", "timestamp": "t", "quantity": "2.7"}'), False),
    (25, _msg({"customer_id": None}), False),
    (26, _msg({"customer_id": " "}), True),
    (27, _msg({"customer_id": 5}), True),
    (28, _msg({"event_type": ["view"]}), False),
    (29, "null", False),
    (30, "", False),
    (31, "5", False),
    (32, _msg({"quantity": "x"}), False),
    (33, _msg(raw=_msg().replace('"quantity": 2', '"quantity": 1e2')), True),
    (34, _msg({"currency": ""}), False),
    (35, _msg({"meta": {"a": {"b": [1, 2]}}}), True),
    (36, _msg() + '{"x":1}', False),
    (37, _msg() + " junk }", False),
    (38, _msg() + '] {"x":1}', False),
    (39, _msg() + ',0] {"x":1}', False),
    (40, _msg() + ',{"x":1}', False),
    (41, _msg({"note": 'a } b ] , { " c'}), True),
    (42, " \n" + _msg({"meta": {"b": "}"}}) + "\t", True),
]


def test_matrix(spark):
    df = spark.createDataFrame([(n, t) for n, t, _ in CASES], "n int, value string")
    got = {r.n: (r.is_valid, list(r.reasons)) for r in V.classify(df).select("n", "is_valid", "reasons").collect()}
    wrong = [(n, got[n]) for n, _, want in CASES if got[n][0] != want]
    assert not wrong, wrong


def test_reasons_and_values(spark):
    df = spark.createDataFrame([(1, _msg({"quantity": "x", "currency": None})),
                                (2, _msg(drop=("customer_id",))),
                                (3, "{oops"),
                                (4, _msg(raw=_msg().replace('"quantity": 2', '"quantity": 9007199254740993')))],
                               "n int, value string")
    rows = {r.n: r for r in V.classify(df).collect()}
    assert list(rows[1].reasons) == [V.BAD_QUANTITY, V.BAD_CURRENCY]
    assert list(rows[2].reasons) == [V.MISSING_FIELD]
    assert list(rows[3].reasons) == [V.MALFORMED]
    bronze = V.to_bronze(V.classify(df), keep=("n",)).collect()
    assert [(r.n, r.quantity, r.currency) for r in bronze] == [(4, 9007199254740993, "USD")]


@pytest.mark.parametrize("currency,expected", [(None, "USD"), ("SAR", "SAR")])
def test_schema_versions(spark, currency, expected):
    change = {} if currency is None else {"currency": currency}
    df = spark.createDataFrame([(1, _msg(change))], "n int, value string")
    row = V.to_bronze(V.classify(df)).first()
    assert row.currency == expected


def test_typed_columns_read_anew_are_those_judged(spark):
    from strata.sources import adapters as A
    for messages in (A.messages_d(spark, "/root/testdata/sf0.001"), A.messages_l_dirty(spark, "/root/testdata/sf0.001")):
        valid = V.judged(messages, reasons=True).filter("is_valid").select("event.*", F.col("value").alias("message"))
        again = V.typed(valid.select("event_id", "message")).select(*valid.columns)
        assert valid.count() > 100 and valid.exceptAll(again).count() == 0 and again.exceptAll(valid).count() == 0


def test_where_an_object_ends(spark):
    texts = {'{}': True, ' {"a":1}\n': True, '{"a":{"b":1}}': True, '{"a":"}"}': True, '{"a":"}': False, '{"a":1}{"b":2}': False,
             '{"a":1} x': False, '}': False, '{': False, '': False, '"}': False, '{"\u00e9":"\u20ac"}': True, None: False}
    df = spark.createDataFrame(list(enumerate(texts)), "n int, value string")
    got = {r.n: r._msg_is_object for r in V.with_parsed(df).select("n", "_msg_is_object").collect()}
    assert got == dict(enumerate(texts.values()))
