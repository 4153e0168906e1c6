import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from siftspark.functions import attribute_arrays, leaf_kind, right_strip, strip_prefix
from siftspark.operators import (
    accepted,
    arrays_to_rows,
    assert_unique,
    changed,
    collect_columns,
    conform,
    enrich_documents,
    explode_indexed,
    flag,
    in_scope,
    latest_versions,
    merge_upsert,
    null_tokens,
    null_violations,
    ragged,
    rejected,
    replace_by_key,
    require_rows,
    row_numbers,
    split,
    transpose_broadcast,
    union_all,
    version_status,
)
from siftspark.operators.reshape import table_rows
from siftspark.operators.scope import broadcast_if_small
from siftspark.plans import explode_category
from siftspark.registry import Registry, category, default_registry

REG = default_registry()
FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def why(df, spec, key):
    return {r[key]: r["reject_reasons"] for r in flag(df, spec).collect()}


def bronze(spark, name, data):
    """Rows given as dicts; all other columns NULL."""
    spec = REG[name]
    return spark.createDataFrame([tuple(d.get(c) for c in spec.names) for d in data], spec.bronze_schema())


# --- registry ---------------------------------------------------------------


def test_registry_shapes():
    assert {c.name: len(c.columns) for c in REG} == {
        "entity": 17,
        "entity_poly_seq": 5,
        "chem_comp": 47,
        "exptl": 3,
        "pdbx_database_PDB_obs_spr": 6,
    }
    by_name = {c.name: {x.name: x for x in c.columns} for c in REG}
    assert len(by_name["chem_comp"]["type"].allowed) == 29
    assert len(by_name["exptl"]["method"].allowed) == 13
    assert REG["entity_poly_seq"].keys == ["experiment", "entity_id", "mon_id", "num"]
    silver = REG["chem_comp"].silver_schema()
    assert [f.name for f in silver.fields if not f.nullable] == ["experiment", "id", "type"]
    assert REG.carcass()["exptl"] == {"entry_id": [], "method": []}
    assert not REG["pdbx_database_PDB_obs_spr"].distinct


# --- cells and leaves -------------------------------------------------------


def test_missing_value_is_a_whole_cell(spark):
    df = spark.createDataFrame([("?", 1), (".", 2), ("?.", 3), (None, 4), ("a?", 5)], "c string, n int")
    assert [r["c"] for r in null_tokens(df).orderBy("n").collect()] == [None, ".", "?.", None, "a?"]


def test_text_functions(spark):
    df = spark.createDataFrame([("_entity \t\r\n",), ("entity",), ("__x",), ("",)], "c string")
    assert [tuple(r) for r in df.select(right_strip(strip_prefix(F.col("c"))), right_strip(F.col("c"))).collect()] == [
        ("entity", "_entity"), ("entity", "entity"), ("_x", "__x"), ("", "")
    ]


def leaves(spark, doc):
    text = spark.createDataFrame([(json.dumps(doc),)], "j string")
    return text.select(F.from_json("j", "map<string,variant>").alias("m"))


@pytest.mark.parametrize(
    ("doc", "expected"),
    [
        ({"a": ["1", "2"], "b": ["x", None]}, {"a": ["1", "2"], "b": ["x", None]}),
        ({"a": "[x", "b": '["1"]'}, {"a": ["[x"], "b": ['["1"]']}),
        ({"a": ["1", "2"], "b": "x"}, {"a": ["1", "2"], "b": ["x", "x"]}),
        ({"a": "x", "b": ["1", "2"]}, {"a": ["x"], "b": ["1", "2"]}),
        ({"o": {"z": 1}, "a": None}, {"a": [None]}),
        ({"a": []}, {"a": []}),
    ],
)
def test_leaves_to_arrays(spark, doc, expected):
    assert leaves(spark, doc).select(attribute_arrays(F.col("m"))).first()[0] == expected


def test_leaf_kinds(spark):
    found = leaves(spark, {"a": "[x", "b": [], "c": {"d": 1}}).select(F.explode("m").alias("k", "v"))
    assert {r[0]: r[1] for r in found.select("k", leaf_kind(F.col("v"))).collect()} == {
        "a": "str", "b": "list", "c": "dict"
    }


# --- shapes -----------------------------------------------------------------


def docs(spark, data):
    return spark.createDataFrame(data, "experiment string, attributes map<string,array<string>>")


def test_arrays_to_rows_fills_absent_columns(spark):
    d = docs(spark, [("A", {"id": ["1", "2"]}), ("B", {"id": ["9"], "type": ["x"]})])
    assert rows(arrays_to_rows(d, ["id", "type"], ["experiment"])) == [
        ("A", "1", None), ("A", "2", None), ("B", "9", "x")
    ]


def test_ragged(spark):
    d = docs(spark, [("A", {"a": ["1"], "b": ["1", "2"]}), ("B", {"a": ["1"], "b": ["2"]}), ("C", {"a": []})])
    got = d.select("experiment", ragged(F.col("attributes")), table_rows(F.col("attributes")))
    assert rows(got) == [("A", True, None), ("B", False, 1), ("C", False, 0)]


def test_explode_uses_each_rows_own_position(spark):
    d = spark.createDataFrame(
        [("B", ["1", "2"], ["x", "y"]), ("A", ["3"], ["z"]), ("C", [], None)],
        "e string, a array<string>, b array<string>",
    )
    assert rows(explode_indexed(d, ["a", "b"], ["e"], "pos")) == [
        ("A", 0, "3", "z"), ("B", 0, "1", "x"), ("B", 1, "2", "y")
    ]


def test_transpose_repeats_first_value(spark):
    d = docs(spark, [("A", {"full": ["1", "2", "3"], "short": ["s", "t"], "empty": [], "gone": ["g"]})])
    got = transpose_broadcast(d, ["full", "short", "empty", "gone"], ["experiment"], drop=["gone"])
    assert rows(got) == [("A", i, v, "s", None) for i, v in enumerate("123")]
    assert got.columns == ["experiment", "line", "full", "short", "empty"]


def test_enrich_keeps_present_values(spark):
    spec = Registry({"c": category("c", ["experiment", "a", "b"]), "d": category("d", ["experiment", "x"])})
    data = spark.createDataFrame([({"c": {"a": ["1"]}},)], "data map<string,map<string,array<string>>>")
    assert data.select(enrich_documents(F.col("data"), spec)).first()[0] == {
        "c": {"a": ["1"], "b": []}, "d": {"x": []}
    }


def test_collect_columns_is_whole_and_bounded(spark):
    df = spark.range(0, 2500).select(F.lit("k").alias("k"), F.col("id").alias("p"), F.col("id").alias("v"))
    got = collect_columns(df, ["k"], "p", ["v"], chunk_rows=1000).orderBy("chunk").collect()
    assert [len(r["v"]) for r in got] == [1000, 1000, 500]
    assert [v for r in got for v in r["v"]] == list(range(2500))


def test_struct_of_arrays(spark):
    raw = spark.createDataFrame(
        [("1AAA", (["1", "2"], ["water", "polymer"])), ("1BBB", (["1"], None))],
        "experiment_id string, _entity struct<id:array<string>,type:array<string>>",
    )
    got = explode_category(raw, REG["entity"])
    assert got.columns == REG["entity"].names
    assert rows(got.select("experiment", "id", "type")) == [
        ("1AAA", "1", "water"), ("1AAA", "2", "polymer"), ("1BBB", "1", None)
    ]


def test_conform_and_union(spark):
    a = spark.createDataFrame([(1, "x")], "n int, b string")
    b = spark.createDataFrame([("y", 2)], "b string, n int")
    assert rows(union_all(a, b)) == [(1, "x"), (2, "y")]
    got = conform(a, ["experiment", "b", "c", "n"], experiment="E")
    assert rows(got) == [("E", "x", None, "1")]
    assert {f.dataType.simpleString() for f in got.schema.fields} == {"string"}


# --- quality ----------------------------------------------------------------


def test_casts_are_strict_but_sparks_own(spark):
    values = ["1", " 12 ", "12.5", "1e3", "", "abc", None]
    df = bronze(spark, "entity", [{"experiment": "A", "id": str(i), "pdbx_number_of_molecules": v} for i, v in enumerate(values)])
    ok = {int(r["id"]): r["pdbx_number_of_molecules"] for r in accepted(df, REG["entity"]).collect()}
    assert ok == {0: 1, 1: 12, 6: None}
    floats = ["NaN", "inf", "12.5f", "1.0d", "3078.980", "x"]
    df = bronze(spark, "entity", [{"experiment": "A", "id": v, "formula_weight": v} for v in floats])
    assert {r["id"] for r in accepted(df, REG["entity"]).collect()} == set(floats) - {"x"}
    dates = ["2020", "2020-1", "2020-01-01 junk", "2020-02-30", "2020-02-29"]
    df = bronze(spark, "chem_comp", [{"experiment": "A", "id": d, "type": "other", "pdbx_initial_date": d} for d in dates])
    good = {r["id"]: str(r["pdbx_initial_date"]) for r in accepted(df, REG["chem_comp"]).collect()}
    assert good == {
        "2020": "2020-01-01", "2020-1": "2020-01-01", "2020-01-01 junk": "2020-01-01", "2020-02-29": "2020-02-29"
    }


def test_domains(spark):
    df = bronze(spark, "exptl", [
        {"experiment": "A", "entry_id": m or "null", "method": m}
        for m in ("EPR", "EPR\tEPR", "X-RAY DIFFRACTION", "x-ray diffraction", None)
    ])
    assert why(df, REG["exptl"], "entry_id") == {
        "EPR": [], "EPR\tEPR": ["method:allowed"], "X-RAY DIFFRACTION": [],
        "x-ray diffraction": ["method:allowed"], "null": ["method:required"],
    }
    df = bronze(spark, "entity", [{"experiment": "A", "id": t or "null", "type": t} for t in ("water", "Polymer", None)])
    assert why(df, REG["entity"], "id") == {"water": [], "Polymer": ["type:allowed"], "null": []}


def test_distinct_after_cast(spark):
    df = bronze(spark, "entity_poly_seq", [
        {"experiment": "A", "entity_id": "1", "mon_id": "ALA", "num": n} for n in ("1", "01", " 1", "1")
    ])
    assert rows(accepted(df, REG["entity_poly_seq"])) == [("A", "1", "ALA", 1, None)]


CELL = st.sampled_from([None, "n", "maybe", "1", "01", "x", "?"])


@FEW
@given(st.lists(st.tuples(CELL, CELL, CELL, CELL), max_size=12))
def test_every_row_is_on_exactly_one_side(spark, cells):
    spec = REG["entity_poly_seq"]
    df = spark.createDataFrame([("A", *c) for c in cells], spec.bronze_schema())

    def keeps(e, m, n, h):
        return None not in (e, m, n) and n in ("1", "01") and h in (None, "n")

    good = {("A", e, m, int(n), h) for e, m, n, h in cells if keeps(e, m, n, h)}
    bad = {("A", *c) for c in cells if not keeps(*c)}
    assert set(rows(accepted(df, spec))) == good
    assert {r[:-1] for r in rows(rejected(df, spec))} == bad
    sides = split(df, spec)
    assert set(rows(sides.filter("accepted").select("silver.*"))) == good
    assert {tuple(r)[:-1] for r in sides.filter("NOT accepted").select("rejected.*").collect()} == bad


def test_constraints(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    with pytest.raises(ValueError, match="k=1"):
        assert_unique(df, ["k"])
    assert assert_unique(df, ["k", "v"]) is df
    assert rows(null_violations(df, ["k", "v"])) == [("k", 0), ("v", 1)]
    with pytest.raises(ValueError, match="nothing here"):
        require_rows(df.filter("k > 5"), "nothing here")


# --- scope and versions -----------------------------------------------------


def test_versions(spark):
    manifest = spark.createDataFrame([("A", "1"), ("B", "2"), ("C", "1")], "experiment string, etag string")
    present = spark.createDataFrame([("A", "1"), ("B", "1")], "experiment string, etag string")
    assert rows(version_status(manifest, present)) == [("A", "1", "unchanged"), ("B", "2", "changed"), ("C", "1", "new")]
    assert rows(changed(manifest, present)) == [("B", "2"), ("C", "1")]
    assert changed(manifest, manifest).isEmpty()
    held = spark.createDataFrame([("A", "9", 1), ("A", "3", 2)], "experiment string, etag string, run int")
    assert rows(latest_versions(held, order="run")) == [("A", "3")]


def test_scope(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "experiment string")
    scope = spark.createDataFrame([("x", "A"), ("x", "A"), ("y", "B"), ("y", None)], "category string, experiment string")
    assert rows(in_scope(df, scope, "x")) == [("A",)]
    assert rows(in_scope(df, scope)) == [("A",), ("B",)]


def test_broadcast_needs_a_measured_size(spark):
    keys = spark.range(1000).select(F.col("id").cast("string").alias("experiment"))
    small, large = broadcast_if_small(keys), broadcast_if_small(keys, limit=1000)
    assert large is keys and small is not keys
    plan = small._jdf.queryExecution().logical().toString().lower()
    assert "hint" in plan and "broadcast" in plan


# --- merge ------------------------------------------------------------------

KEYED = st.dictionaries(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None])), st.integers(0, 9), max_size=8)


@FEW
@given(KEYED, KEYED)
def test_merge_against_brute_force(spark, target, source):
    schema = "k int, l string, v int"
    t = spark.createDataFrame([(*k, v) for k, v in target.items()], schema)
    s = spark.createDataFrame([(*k, v) for k, v in source.items()], schema)
    merged = merge_upsert(t, s, ["k", "l"], null_safe=True)
    expected = sorted([(*k, v) for k, v in (target | source).items()], key=repr)
    assert rows(merged) == expected
    assert rows(merge_upsert(merged, s, ["k", "l"], null_safe=True)) == expected
    # Without null safety, rows with a NULL in the key match nothing.
    plain = [(*k, v) for k, v in target.items() if k[1] is None or k not in source]
    assert rows(merge_upsert(t, s, ["k", "l"])) == sorted(plain + [(*k, v) for k, v in source.items()], key=repr)
    replaced = replace_by_key(t, s, "k")
    named = {k for k, _ in source}
    kept = [(*k, v) for k, v in target.items() if k[0] not in named]
    assert rows(replaced) == sorted(kept + [(*k, v) for k, v in source.items()], key=repr)


# --- ranking ----------------------------------------------------------------


def test_row_numbers_with_a_hot_and_a_null_key(spark):
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 5).cast("string")).alias("k"),
        F.xxhash64("id").alias("o"),
    )
    plain = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("o")))
    assert rows(row_numbers(df, ["o"], ["k"])) == rows(plain)
    whole = df.withColumn("rn", F.row_number().over(Window.orderBy("o")))
    assert rows(row_numbers(df, ["o"])) == rows(whole)


def test_domains_of_any_size_keep_reasons(spark):
    from siftspark.operators import quality

    spec = category("c", ["experiment", "a", "b"], required=["experiment", "b"], keys=["experiment"], allowed={"a": ["old"]})
    many = spark.range(quality.FEW + 50).select(F.concat(F.lit("v"), "id").alias("v"))
    domains = {"a": many.unionByName(many).unionByName(spark.createDataFrame([(None,)], "v string")),
               "b": spark.createDataFrame([("x",), ("y",), (None,)], "v string")}
    rows = [("1", "v3", "x"), ("2", "nope", "x"), ("3", None, "z"), ("4", "old", None), ("5", "v249", "y"), ("5", "v249", "y")]
    df = spark.createDataFrame(rows, spec.bronze_schema())
    assert sorted(tuple(r) for r in quality.accepted(df, spec, domains).collect()) == [("1", "v3", "x"), ("5", "v249", "y")]
    bad = {r[0]: r["reject_reasons"] for r in quality.rejected(df, spec, domains).collect()}
    assert bad == {"2": ["a:allowed"], "3": ["b:allowed"], "4": ["a:allowed", "b:required"]}
    flagged = quality.flag(df, spec, domains)
    assert flagged.columns == ["experiment", "a", "b", "accepted", "reject_reasons"] and flagged.count() == 6
    sides = quality.split(df, spec, domains).collect()
    assert sorted((r["accepted"], (r["silver"] or r["rejected"])[0]) for r in sides) == [
        (False, "2"), (False, "3"), (False, "4"), (True, "1"), (True, "5")
    ]
    # An empty domain allows nothing but NULL.
    none = {"a": many.limit(0)}
    assert {r[0] for r in quality.accepted(df, spec, none).collect()} == {"3"}


def test_large_domains_are_joined_and_small_ones_reach_the_scan(spark, tmp_path):
    from siftspark.operators import quality, scope

    spec = category("c", ["experiment", "a", "b"], required=["experiment"], keys=["experiment"])
    spark.range(5000).selectExpr("CAST(id AS STRING) AS experiment", "CAST(id % 700 AS STRING) AS a", "'x' AS b").write.parquet(str(tmp_path / "t"))
    df, many = spark.read.parquet(str(tmp_path / "t")), spark.range(600).select(F.col("id").cast("string").alias("v"))
    few = spark.createDataFrame([("x",), ("y",)], "v string")
    plan = quality.accepted(df, spec, {"b": few})._jdf.queryExecution().executedPlan().toString()
    assert "In(b, [x,y])" in plan.split("PushedFilters: [")[1] and "Join" not in plan
    limit, default = "spark.sql.autoBroadcastJoinThreshold", scope.broadcast_if_small.__defaults__
    before = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "-1")
        scope.broadcast_if_small.__defaults__ = (0, *default[1:])
        kept = quality.accepted(df, spec, {"a": many})
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "LeftOuter" in plan and "Broadcast" not in plan
        assert kept.count() == sum(i % 700 < 600 for i in range(5000))
    finally:
        spark.conf.set(limit, before)
        scope.broadcast_if_small.__defaults__ = default
