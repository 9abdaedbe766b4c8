"""Generators: closed forms and bounds."""

import datetime as dt
import json

from pyspark.sql import functions as F

from shardcraft.functions import generate


def test_people_and_accounts(spark):
    p = {r.n: r for r in generate.people(spark, 12).collect()}
    assert p[0].name == "User_0" and p[7].email == "user_7@example.com"
    assert p[11].age == 18 + 11 % 50 and p[3].city == "Houston" and p[5].city == "New York"
    a = generate.accounts(spark, 3).orderBy("id").collect()
    assert [(r.id, r.username, r.first_name) for r in a] == [
        (1, "user_1", "FirstName_1"), (2, "user_2", "FirstName_2"), (3, "user_3", "FirstName_3")]


def test_seeded_sales_bounds_and_determinism(spark):
    s = generate.sales(spark, 5000, dt.date(2001, 8, 1), seed=11)
    b = s.agg(F.min("user_id"), F.max("user_id"), F.min("quantity"), F.max("quantity"),
              F.min("price"), F.max("price"), F.min("order_date"), F.max("order_date")).first()
    assert 1 <= b[0] <= b[1] <= 1000 and 1 <= b[2] <= b[3] <= 10
    assert 10 <= float(b[4]) <= float(b[5]) <= 1010
    assert dt.date(2000, 8, 1) <= b[6] <= b[7] <= dt.date(2001, 8, 1)
    meta = json.loads(s.where("i = 1234").first().metadata)
    assert meta["batch"] == 1 and meta["record"] == 234 and 0 <= meta["random"] < 1
    again = generate.sales(spark, 5000, dt.date(2001, 8, 1), seed=11)
    assert s.exceptAll(again).count() == 0


def test_wide_rows(spark):
    w = generate.wide(spark, 20, seed=3).collect()
    r = w[0]
    assert r.large_text.startswith("Lorem ipsum " * 100) and len(r.large_text) == 1200 + 11
    d = json.loads(r.json_data)
    assert len(d["data"]) == 10 and 1 <= d["thread"] <= 10
    assert len(r.binary_data) == 11 * 50


def test_update_rows(spark):
    u = {r.id: r for r in generate.update_rows(spark, 150).collect()}
    assert u[1].data == "test_data_0_" and u[4].data == "test_data_3_xxx"
    assert u[102].data == "test_data_101_x" and u[102].counter == 101


def test_ledger_pairs(spark):
    led = generate.ledger(spark, 200, seed=5)
    rows = {r.id: r for r in led.collect()}
    assert len(rows) == 400
    for i in range(200):
        d, c = rows[2 * i + 1], rows[2 * i + 2]
        assert d.transaction_type == "DEBIT" and c.transaction_type == "CREDIT"
        assert c.account_id == d.account_id + 1000 and c.amount == d.amount
        assert 1 <= d.account_id <= 1000
