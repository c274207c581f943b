"""Row filter and flags of the update diffs for every pair of NULL, empty, blank and filled."""

import itertools

import pytest
from pyspark.sql import functions as F

from metaskein.operators import diff as D
from metaskein.sources import schemas

TEXTS = [None, "", " ", "a", "b", " a"]
BOOLS = [None, True, False]


def trim(v):
    return None if v is None else v.strip(" ")


def differ(a, b):
    return a is not None and b is not None and a != b


def sets(spark, side):
    ids = ", id string" if side == "dh" else ""
    row = ("t", "s") + (("S1",) if side == "dh" else ())
    return spark.createDataFrame([row], f"physical_nm string, schema string{ids}")


def items(spark, values, field, side):
    base = {"type": "int4", "is_pk": False, "key_nm": "", "nullable": True, "example": "", "default_val": ""}
    schema = schemas.snapshot_schema("dataitem", "catalog" if side == "dh" else "source")
    data = []
    for n, v in enumerate(values):
        row = {**base, field: v, "dataset_id": "t", "physical_nm": f"c{n:03d}", "id": f"I{n}"}
        data.append(tuple(row.get(f.name) for f in schema.fields))
    return spark.createDataFrame(data, schema)


CASES = {
    # field: (flag name, domain, value shown in flags, row filter)
    "type": ("type", [None, "int4", "_int4", "text"], lambda v: v and v.lstrip("_"),
             lambda a, b: differ(a and a.lstrip("_"), b and b.lstrip("_"))),
    "is_pk": ("pk", BOOLS, lambda v: v, lambda a, b: bool(a) != bool(b)),
    "key_nm": ("keyname", TEXTS, trim, lambda a, b: (a or "") != (b or "")),
    "nullable": ("nullable", BOOLS, lambda v: v, lambda a, b: (a is not False) != (b is not False)),
    "example": ("example", TEXTS, trim, lambda a, b: (a or "") != (b or "") and len(a or "") > 0),
    "default_val": ("default", TEXTS, trim, lambda a, b: (a or "") != (b or "")),
}


@pytest.mark.parametrize("field", CASES)
def test_items_updated(spark, field):
    flag, domain, shown, kept = CASES[field]
    pairs = list(itertools.product(domain, domain))
    out = D.items_updated(
        items(spark, [a for a, _ in pairs], field, "db"), items(spark, [b for _, b in pairs], field, "dh"),
        sets(spark, "db"), sets(spark, "dh"))
    got = {r.physical_nm: (r[f"{flag}_changed"], r[f"{flag}_database"], r[f"{flag}_catalog"]) for r in out.collect()}
    want = {}
    for n, (a, b) in enumerate(pairs):
        if kept(a, b):
            x, y = shown(a), shown(b)
            want[f"c{n:03d}"] = (True, x, y) if differ(x, y) else (False, None, None)
    assert got == want


def test_sets_updated(spark):
    pairs = list(itertools.product(TEXTS, TEXTS))
    db = spark.createDataFrame([(f"t{n}", "s", a) for n, (a, _) in enumerate(pairs)], "physical_nm string, schema string, definition string")
    dh = spark.createDataFrame([(f"t{n}", f"S{n}", b) for n, (_, b) in enumerate(pairs)], "physical_nm string, id string, definition string")
    got = {r.physical_nm: (r.differing_definition, r.dh_definition, r.db_definition) for r in D.sets_updated(db, dh).collect()}
    want = {}
    for n, (a, b) in enumerate(pairs):
        if trim(a or "") != trim(b or "") and trim(a or ""):
            want[f"t{n}"] = (True, b, a) if differ(trim(a), trim(b)) else (False, None, None)
    assert got == want


def test_relationships_updated(spark):
    domain = [None, "", " ", "Cascade", "cascade ", "none"]
    pairs = list(itertools.product(domain, domain))
    fields = schemas.RELATIONSHIP.fieldNames()

    def rels(values, catalog):
        data = [{"physical_nm": f"f{n}", "dataset_id": "t", "on_delete": v} for n, v in enumerate(values)]
        df = spark.createDataFrame([tuple(d.get(f) for f in fields) for d in data], schemas.RELATIONSHIP)
        return df.withColumn("id", F.lit("R")) if catalog else df

    out = D.relationships_updated(rels([a for a, _ in pairs], False), rels([b for _, b in pairs], True), sets(spark, "db"))
    got = {r.physical_nm: (r.on_delete, r.delete_changed, r.update_changed) for r in out.collect()}
    fold = lambda v: (v or "").strip(" ").lower()
    first = lambda *vs: next((v for v in vs if (v or "").strip(" ")), None)
    want = {f"f{n}": (first(a, b), True, False) for n, (a, b) in enumerate(pairs) if fold(a) != fold(b)}
    assert got == want


def test_joins_updated(spark):
    pairs = list(itertools.product([None, 0, 1, 2], [None, 0, 1, 2]))
    cards = list(itertools.product([None, "", "1,1", "0,1"], [None, "", "1,1", "0,1"]))
    all_pairs = [((p, "x"), (q, "x")) for p, q in pairs] + [((1, c), (1, d)) for c, d in cards]
    make = lambda side: spark.createDataFrame(
        [("f", "p", f"c{n}", *pair[side]) for n, pair in enumerate(all_pairs)], schemas.JOIN)
    rel = spark.createDataFrame([("f", "R1")], "physical_nm string, id string")
    got = {r.child_fqdn: (r.position, r.cardinality, r.relationship_id) for r in D.joins_updated(make(0), make(1), rel).collect()}
    want = {}
    for n, ((p, c), (q, d)) in enumerate(all_pairs):
        if differ(p, q) or differ(c, d):
            want[f"c{n}"] = (q or p or 0, (c or "").strip() and c or (d or "").strip() and d or "1,1,0,-1", "R1")
    assert got == want
