import json

from pyspark.sql import functions as F

from marlstone.operators import schema_drift as sd

TARGETS = (sd.Field("name", "text", ("holder", "Holder Name")), sd.Field("shares", "number", ("qty",)), sd.Field("on", "date", ("asOf",)))


def files(spark, bodies):
    rows = [(i, "S", i, b, "clash") for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "id int, s string, no int, body string, recs string").drop("recs")


def body(*recs):
    return json.dumps({"holdings": list(recs)})


BODIES = [
    body({"name": "a", "shares": 1, "on": "2024-01-31"}),
    None,
    "",
    '{"holdings": [{"name": "cut',
    '{"holdings": []}',
    '{"holdings": null}',
    body({"holder": "b", "shares": "1,200", "on": "02/29/2024"}, {"holder": "c", "shares": None, "on": None}),
    body({"Holder Name": {"name": "d", "id": 4}, "qty": {"amount": 5.5}, "asOf": 20240331, "extra": True}),
    body({"Holder Name": None, "qty": {"amount": 6}, "extra": None}),
    body({"Holder Name": "e", "qty": {"amount": 6}, "extra": None}, "no object", 3),
]


def schemas(spark, bodies=BODIES):
    return sd.fingerprints(files(spark, bodies), ["id", "s", "no"], "body", "$.holdings").where(F.size("fields") > 0)


def changes(s):
    return sd.changes(s, sd.registry(s, TARGETS), "id", "s", "no")


def route(s):
    return sd.route(s, sd.registry(s, TARGETS), ["id"], TARGETS)


def test_changes(spark):
    got = {(r.id, r.field, r.change) for r in changes(schemas(spark)).collect()}
    assert got == {
        (6, "name", "renamed"), (6, "shares", "retyped"),
        (7, "name", "renamed"), (7, "name", "retyped"), (7, "shares", "renamed"), (7, "shares", "retyped"), (7, "on", "renamed"), (7, "on", "retyped"), (7, "extra", "added"),
        (8, "on", "removed"),
    }


def test_route(spark):
    rows = route(schemas(spark)).orderBy("id", "_at").collect()
    assert [(r.id, r.name, r.shares, str(r.on)) for r in rows] == [
        (0, "a", 1.0, "2024-01-31"), (6, "b", 1200.0, "2024-02-29"), (6, "c", None, "None"), (7, "d", 5.5, "2024-03-31"), (8, None, 6.0, "None"), (9, "e", 6.0, "None"),
    ]


def test_versions(spark):
    got = {r.id: r.schema_version for r in sd.versions(schemas(spark), "id", "s", "no").collect()}
    assert got == {0: 1, 6: 2, 7: 3, 8: 4, 9: 5}


def test_previous_over_chunks(spark):
    rows = [("s", i, i * 10) for i in range(0, 3 * sd.CHUNK, 7)]
    out = sd.previous(spark.createDataFrame(rows, "s string, no int, v int"), "s", "no", ["v"]).orderBy("no").collect()
    assert [r.prev_v for r in out] == [None, *[v for _, _, v in rows[:-1]]]


def test_nothing(spark):
    s = schemas(spark, [None, ""])
    assert s.count() == 0 and changes(s).count() == 0 and route(s).count() == 0


def test_long_body(spark):
    many = body(*[{"name": "x" * 1000, "shares": i, "on": None} for i in range(2000)])
    assert route(schemas(spark, [many])).agg(F.sum("shares")).first()[0] == 1999000


def test_bodies_that_are_no_whole_document(spark):
    good = body({"name": "a"})
    assert schemas(spark, [good + "}", good + good, good + " x", good[:-1]]).count() == 0 and schemas(spark, [good + " "]).count() == 1


def test_defaults_are_steps_of_the_registry(spark):
    targets = (sd.Field("name", "text", ("holder",), ("nobody",)), sd.Field("shares", "number", ("qty",), ("twice", "none")), TARGETS[2])
    s = schemas(spark, [body({"holder": None, "qty": None}, {"holder": "a", "qty": 2})])
    known = sd.registry(s, targets)
    assert {(d.field, tuple(d.rules)) for d in known.first().defaults} == {("name", ("nobody",)), ("shares", ("twice", "none")), ("on", ())}
    rows = sd.route(s, known, ["id"], targets)
    out = sd.fill(rows, targets, {"nobody": F.lit("-"), "twice": F.lit(None).cast("double"), "none": F.lit(0.0)}).orderBy("_at").collect()
    assert [(r.name, r.shares, r.on) for r in out] == [("-", 0.0, None), ("a", 2.0, None)]


def test_two_keys_for_one_field(spark):
    rows = route(schemas(spark, [body({"Name": "x", "name": "y", "holder": "z"}), body({"Holder Name": "h", "holder": "z"}), body({"NAME": "n", "Name": "m"})])).orderBy("id").collect()
    assert [r.name for r in rows] == ["y", "z", "n"]


def test_kept_registry_and_suggestions(spark):
    one = schemas(spark, [body({"name": "a", "shares": 1}), body({"name": "b", "shares": 2})])
    kept = sd.registry(one, TARGETS).withColumn("defaults", F.expr("filter(defaults, d -> false)"))  # marked as of before
    both = schemas(spark, [body({"name": "a", "shares": 1}), body({"name": "b", "units": 2}), body({"name": "b", "units": 3, "flag": True})])
    known = sd.registry(both, TARGETS, kept)
    assert sorted(len(r.defaults) for r in known.collect()) == [0, 3, 3]
    found = sd.changes(both, known, "id", "s", "no").withColumnRenamed("id", "file_id")
    assert [tuple(r) for r in sd.suggested_names(found, TARGETS).collect()] == [("shares", "units", 1)]
