"""Stored aggregation pipelines: each stage and operator on small documents."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quayside.sources.pipelines import PipelineError, aggregate

SCHEMA = """_id long, name string, n int, price double, at timestamp_ntz, tags array<string>, on boolean,
            who struct<first: string, age: int>, items array<struct<sku: string, qty: int>>"""


@pytest.fixture(scope="module")
def things(spark):
    rows = [
        (1, "apple", 5, 1.5, datetime(2024, 1, 5, 10), ["a", "b"], True, ("Ann", 30), [("x", 1), ("y", 2)]),
        (2, "Bread", None, 2.5, datetime(2024, 2, 1), [], False, ("Bob", None), []),
        (3, None, 7, None, None, None, None, None, None),
        (4, "apple pie", 5, -4.0, datetime(2024, 1, 5), ["b"], True, (None, 41), [("x", 10)]),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def ids(df):
    return sorted(r["_id"] for r in df.collect())


@pytest.mark.parametrize(
    "query, expected",
    [
        ({}, [1, 2, 3, 4]),
        ({"n": 5}, [1, 4]),
        ({"n": None}, [2]),
        ({"n": {"$ne": 5}}, [2, 3]),
        ({"n": {"$gt": 4, "$lt": 7}}, [1, 4]),
        ({"n": {"$in": [7, None]}}, [2, 3]),
        ({"n": {"$nin": [7]}}, [1, 2, 4]),
        ({"n": {"$not": {"$gte": 6}}}, [1, 2, 4]),
        ({"n": {"$exists": False}}, [2]),
        ({"n": {"$mod": [3, 1]}}, [3]),
        ({"missing": None}, [1, 2, 3, 4]),
        ({"missing": {"$exists": True}}, []),
        ({"missing": 3}, []),
        ({"on": True}, [1, 4]),
        ({"name": {"$regex": "^APP", "$options": "i"}}, [1, 4]),
        ({"name": {"$regularExpression": {"pattern": "e$", "options": ""}}}, [1, 4]),
        ({"tags": "b"}, [1, 4]),
        ({"tags": {"$ne": "a"}}, [2, 3, 4]),
        ({"tags": {"$size": 1}}, [4]),
        ({"tags": {"$all": ["a", "b"]}}, [1]),
        ({"tags": ["b"]}, [4]),
        ({"who.age": {"$gt": 29}}, [1, 4]),
        ({"who": {"first": "Ann", "age": 30}}, [1]),
        ({"items.qty": {"$gte": 2}}, [1, 4]),
        ({"items.sku": "x", "items.qty": 2}, [1]),
        ({"items": {"$elemMatch": {"sku": "x", "qty": {"$gt": 5}}}}, [4]),
        ({"tags": {"$elemMatch": {"$eq": "a"}}}, [1]),
        ({"$or": [{"n": 7}, {"price": {"$lt": 0}}]}, [3, 4]),
        ({"$nor": [{"n": 5}, {"name": "Bread"}]}, [3]),
        ({"$and": [{"n": 5}, {"on": {"$ne": False}}]}, [1, 4]),
        ({"at": {"$gte": {"$date": "2024-01-05T07:00:00-03:00"}}}, [1, 2]),
        ({"at": {"$date": {"$numberLong": "1704412800000"}}}, [4]),
        ({"$expr": {"$lt": ["$n", 6]}}, [1, 2, 4]),  # null is less than any number
        ({"$expr": {"$gt": ["$price", "$n"]}}, [2]),
        ({"$expr": {"$in": ["$name", ["Bread", "apple"]]}}, [1, 2]),
        ({"$expr": {"$and": ["$on", {"$regexMatch": {"input": "$name", "regex": "pie"}}]}}, [4]),
        ({"$comment": "all"}, [1, 2, 3, 4]),
    ],
)
def test_match(things, query, expected):
    assert ids(aggregate(things, json.dumps([{"$match": query}]))) == expected


@pytest.mark.parametrize(
    "expression, expected",
    [
        ({"$add": ["$n", 1, 2]}, [8, None, 10, 8]),
        ({"$subtract": ["$at", {"$date": "2024-01-05T00:00:00Z"}]}, [36000000, 2332800000, None, 0]),
        ({"$multiply": ["$n", 2]}, [10, None, 14, 10]),
        ({"$round": ["$price", 0]}, [2.0, 2.0, None, -4.0]),
        ({"$cmp": ["$n", 5]}, [0, -1, 1, 0]),
        ({"$concat": ["$name", "!"]}, ["apple!", "Bread!", None, "apple pie!"]),
        ({"$toUpper": "$name"}, ["APPLE", "BREAD", "", "APPLE PIE"]),
        ({"$substrCP": ["$name", 1, 3]}, ["ppl", "rea", "", "ppl"]),
        ({"$split": ["$name", " "]}, [["apple"], ["Bread"], None, ["apple", "pie"]]),
        ({"$trim": {"input": "$name", "chars": "ae"}}, ["ppl", "Bread", None, "pple pi"]),
        ({"$trim": {"input": {"$concat": [" \t", "$name", "\n"]}}}, ["apple", "Bread", None, "apple pie"]),
        ({"$strLenCP": {"$ifNull": ["$name", ""]}}, [5, 5, 0, 9]),
        ({"$cond": {"if": "$n", "then": "some", "else": "none"}}, ["some", "none", "some", "some"]),
        ({"$cond": ["$on", 1, 0]}, [1, 0, 0, 1]),
        ({"$not": ["$on"]}, [False, True, True, False]),
        ({"$let": {"vars": {"x": "$who.age"}, "in": {"$add": ["$$x", 1]}}}, [31, None, None, 42]),
        ({"$arrayElemAt": ["$tags", -1]}, ["b", None, None, "b"]),
        ({"$first": "$tags"}, ["a", None, None, "b"]),
        ({"$slice": ["$tags", 1]}, [["a"], [], None, ["b"]]),
        ({"$slice": ["$tags", -1]}, [["b"], [], None, ["b"]]),
        ({"$size": {"$ifNull": ["$tags", []]}}, [2, 0, 0, 1]),
        ({"$sum": "$items.qty"}, [3, 0, 0, 10]),
        ({"$avg": "$items.qty"}, [1.5, None, None, 10.0]),
        ({"$max": "$items.qty"}, [2, None, None, 10]),
        ({"$min": ["$n", 6]}, [5, 6, 6, 5]),
        ({"$map": {"input": "$items", "as": "i", "in": {"$multiply": ["$$i.qty", 2]}}}, [[2, 4], [], None, [20]]),
        ({"$filter": {"input": "$tags", "as": "t", "cond": {"$ne": ["$$t", "a"]}}}, [["b"], [], None, ["b"]]),
        ({"$in": ["b", "$tags"]}, [True, False, False, True]),
        ({"$year": "$at"}, [2024, 2024, None, 2024]),
        ({"$dateToString": {"date": "$at", "format": "%d/%m/%Y às %Hh"}}, ["05/01/2024 às 10h", "01/02/2024 às 00h", None, "05/01/2024 às 00h"]),
        ({"$dateTrunc": {"date": "$at", "unit": "month"}}, [datetime(2024, 1, 1), datetime(2024, 2, 1), None, datetime(2024, 1, 1)]),
        ({"$toString": "$n"}, ["5", None, "7", "5"]),
        ({"$literal": "$n"}, ["$n"] * 4),
        ({"$isArray": "$tags"}, [True] * 4),
        ({"$switch": {"branches": [{"case": {"$eq": ["$n", 7]}, "then": "seven"}], "default": "other"}}, ["other", "other", "seven", "other"]),
        ("$who.first", ["Ann", "Bob", None, None]),
        ("$items.sku", [["x", "y"], [], None, ["x"]]),
        ("$$ROOT.name", ["apple", "Bread", None, "apple pie"]),
    ],
)
def test_expression(things, expression, expected):
    got = aggregate(things, json.dumps([{"$project": {"v": expression}}])).collect()
    assert [r["v"] for r in sorted(got, key=lambda r: r["_id"])] == expected


def test_project_keeps_leaves_out_and_nests(things):
    got = aggregate(things, [{"$match": {"_id": 1}}, {"$project": {"name": 1, "who.age": 1, "items": {"sku": 1}, "new.deep": "$n"}}])
    assert got.columns == ["_id", "name", "who", "items", "new"]
    row = got.first()
    assert row.who.asDict() == {"age": 30} and [i.asDict() for i in row["items"]] == [{"sku": "x"}, {"sku": "y"}] and row.new.deep == 5
    left = aggregate(things, [{"$project": {"_id": 0, "who.first": 0, "items.qty": 0, "at": 0}}])
    assert left.columns == ["name", "n", "price", "tags", "on", "who", "items"]
    assert left.schema["who"].dataType.names == ["age"] and left.schema["items"].dataType.elementType.names == ["sku"]
    assert aggregate(things, [{"$project": {"_id": 0}}]).columns == things.columns[1:]
    assert aggregate(things, [{"$unset": ["who.age", "n"]}]).schema["who"].dataType.names == ["first"]


def test_set_in_structs_and_arrays(things):
    got = aggregate(things, [{"$set": {"who.age": {"$add": ["$who.age", 1]}, "items.total": "$n", "fresh.a": 1}}, {"$match": {"_id": 1}}]).first()
    assert got.who.age == 31 and got.who.first == "Ann" and [i.total for i in got["items"]] == [5, 5] and got.fresh.a == 1


def test_unwind(things):
    def pairs(*stages):
        return sorted(((r["_id"], r["tags"]) for r in aggregate(things, list(stages)).collect()), key=str)

    assert pairs({"$unwind": "$tags"}) == [(1, "a"), (1, "b"), (4, "b")]
    kept = {"$unwind": {"path": "$tags", "preserveNullAndEmptyArrays": True}}
    assert pairs(kept) == [(1, "a"), (1, "b"), (2, None), (3, None), (4, "b")]
    at = aggregate(things, [{"$unwind": {"path": "$items", "includeArrayIndex": "i"}}]).collect()
    assert sorted((r["_id"], r["items"].sku, r.i) for r in at) == [(1, "x", 0), (1, "y", 1), (4, "x", 0)]
    assert ids(aggregate(things, [{"$unwind": "$n"}])) == [1, 3, 4]  # a value is its own element


def test_group(things):
    stages = [{"$sort": {"price": -1}}, {"$group": {"_id": "$n", "c": {"$count": {}}, "s": {"$sum": "$price"}, "first": {"$first": "$_id"}, "last": {"$last": "$_id"}, "all": {"$push": "$name"}, "odd": {"$sum": "$name"}}}]
    got = {r["_id"]: (r.c, r.s, r.first, r.last, r["all"], r.odd) for r in aggregate(things, stages).collect()}
    assert got == {5: (2, -2.5, 1, 4, ["apple", "apple pie"], 0), None: (1, 2.5, 2, 2, ["Bread"], 0), 7: (1, 0.0, 3, 3, [], 0)}
    whole = aggregate(things, [{"$group": {"_id": None, "n": {"$sum": 1}, "m": {"$avg": "$n"}}}]).collect()
    assert [(r["_id"], r.n, r.m) for r in whole] == [(None, 4, 17 / 3)]
    assert aggregate(things.limit(0), [{"$group": {"_id": None, "n": {"$sum": 1}}}]).collect() == []
    assert sorted(r["_id"] for r in aggregate(things, [{"$group": {"_id": "$on"}}, {"$match": {"_id": {"$ne": None}}}]).collect()) == [False, True]


def test_order_limit_skip_count(things):
    assert [r["_id"] for r in aggregate(things, [{"$sort": {"n": 1, "_id": -1}}]).collect()] == [2, 4, 1, 3]
    assert [r["_id"] for r in aggregate(things, [{"$sort": {"_id": -1}}, {"$skip": 1}, {"$limit": 2}]).collect()] == [3, 2]
    assert aggregate(things, [{"$match": {"n": 5}}, {"$count": "found"}]).collect()[0].found == 2
    assert aggregate(things, [{"$match": {"n": 50}}, {"$count": "found"}]).collect() == []
    assert [tuple(r) for r in aggregate(things, [{"$sortByCount": "$n"}, {"$limit": 1}]).collect()] == [(5, 2)]


def test_replace_root_and_union(things):
    got = aggregate(things, [{"$match": {"who": {"$ne": None}}}, {"$replaceRoot": {"newRoot": {"$mergeObjects": [{"age": 0}, "$who"]}}}])
    assert sorted(map(tuple, got.collect()), key=str) == [(30, "Ann"), (41, None), (None, "Bob")]
    both = aggregate(things, [{"$project": {"n": 1}}, {"$unionWith": {"coll": "t", "pipeline": [{"$match": {"_id": 1}}, {"$project": {"name": 1}}]}}], {"t": things})
    assert both.columns == ["_id", "n", "name"] and both.count() == 5


def test_lookup(spark, things):
    owners = spark.createDataFrame([(5, "five", 1), (5, "cinq", 2), (None, "none", 3), (9, "nine", 4)], "key int, label string, rank int")
    plain = {"from": "o", "localField": "n", "foreignField": "key", "as": "o"}
    got = {r["_id"]: sorted(x.label for x in r.o) for r in aggregate(things, [{"$lookup": plain}], {"o": owners}).collect()}
    assert got == {1: ["cinq", "five"], 2: ["none"], 3: [], 4: ["cinq", "five"]}  # null finds null
    narrowed = {**plain, "pipeline": [{"$match": {"rank": {"$gt": 1}}}, {"$project": {"label": 1}}]}
    got = aggregate(things, [{"$lookup": narrowed}], {"o": owners})
    assert got.schema["o"].dataType.elementType.names == ["label"]
    assert {r["_id"]: [x.label for x in r.o] for r in got.collect()} == {1: ["cinq"], 2: ["none"], 3: [], 4: ["cinq"]}
    for keep, wanted in ((False, [(1, "cinq"), (1, "five"), (2, "none"), (4, "cinq"), (4, "five")]), (True, [(1, "cinq"), (1, "five"), (2, "none"), (3, None), (4, "cinq"), (4, "five")])):
        unwound = aggregate(things, [{"$lookup": plain}, {"$unwind": {"path": "$o", "preserveNullAndEmptyArrays": keep}}], {"o": owners})
        assert sorted(((r["_id"], r.o and r.o.label) for r in unwound.collect()), key=str) == wanted
        assert "collect_list" not in unwound._jdf.queryExecution().toString()
    bound = {"from": "o", "let": {"k": "$n"}, "as": "o", "pipeline": [{"$match": {"$expr": {"$and": [{"$eq": ["$$k", "$key"]}, {"$lt": ["$rank", 2]}]}}}, {"$replaceRoot": {"newRoot": {"l": "$label"}}}]}
    assert {r["_id"]: [x.l for x in r.o] for r in aggregate(things, [{"$lookup": bound}], {"o": owners}).collect()} == {1: ["five"], 2: [], 3: [], 4: ["five"]}


def test_leading_match_reaches_the_scan(spark, things, tmp_path):
    path = str(tmp_path / "things")
    things.write.parquet(path)
    stages = [{"$match": {"n": {"$gte": 5}, "name": {"$in": ["apple"]}, "who.age": {"$lt": 50}, "at": {"$gte": {"$date": "2024-01-01T00:00:00Z"}}}}, {"$project": {"price": 1}}]
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    df = aggregate(spark.read.parquet(path), stages)
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for pushed in ("GreaterThanOrEqual(n,5)", "EqualTo(name,apple)", "LessThan(who.age,50)", "GreaterThanOrEqual(at,2024-01-01T00:00)"):
        assert pushed in plan
    assert "tags" not in plan and "items" not in plan
    assert [tuple(r) for r in df.collect()] == [(1, 1.5)]


@pytest.mark.parametrize(
    "pipeline, place",
    [
        ("[{", "not JSON"),
        ({"$match": {}}, "a list of stages"),
        ([{"$facet": {}}], "pipeline[0].$facet: unknown stage"),
        ([{"$match": {}, "$limit": 1}], "one name"),
        ([{"$match": {"n": {"$near": 1}}}], "$match.n.$near: unknown operator"),
        ([{"$match": {"n": "five"}}], "does not compare"),
        ([{"$match": {"$expr": {"$gt": ["$n"]}}}], "1 arguments"),
        ([{"$project": {"v": {"$magic": 1}}}], "$project.v.$magic: unknown operator"),
        ([{"$project": {"n": 1, "name": 0}}], "to keep and fields to leave out"),
        ([{"$project": {"n": 1, "n.x": 1}}], "given twice"),
        ([{"$group": {"n": {"$sum": 1}}}], "_id is wanted"),
        ([{"$group": {"_id": None, "n": {"$median": 1}}}], "unknown accumulator"),
        ([{"$limit": 0}], "whole number"),
        ([{"$unwind": "tags"}], "begins with $"),
        ([{"$unwind": {"path": "$tags", "flatten": True}}], "takes path"),
        ([{"$lookup": {"from": "gone", "localField": "n", "foreignField": "n", "as": "o"}}], "no collection"),
        ([{"$project": {"v": "$$gone"}}], "unknown variable"),
        ([{"$project": {"v": {"$dateToString": {"date": "$at", "format": "%q"}}}}], "unknown part"),
        ([{"$replaceRoot": {"newRoot": "$n"}}], "no document"),
    ],
)
def test_faults_name_their_place(things, pipeline, place):
    with pytest.raises(PipelineError) as fault:
        aggregate(things, pipeline, {})
    assert place in str(fault.value)


def test_bad_regex_type_stays_an_error(things):
    with pytest.raises(PipelineError):
        aggregate(things, [{"$match": {"name": {"$regex": 5}}}])


def test_times_do_not_follow_the_session_zone(spark, things):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        got = aggregate(things.withColumn("at", F.col("at")), [{"$match": {"at": {"$gte": {"$date": "2024-01-05T10:00:00Z"}}}}, {"$project": {"h": {"$hour": "$at"}, "t": {"$dateToString": {"date": "$at", "format": "%H:%M"}}}}])
        assert sorted(map(tuple, got.collect())) == [(1, 10, "10:00"), (2, 0, "00:00")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
