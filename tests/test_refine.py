"""Generated mmCIF text to silver and rejected tables for all five categories."""

import datetime

import pytest

from siftspark.plans import (
    Layout,
    audit,
    build_bronze,
    queue_inputs,
    read_landed,
    read_ledger,
    read_quarantine,
    read_versions,
    refine,
    refine_pending,
)
from siftspark.registry import Registry, default_registry
from siftspark.sinks import read_table

REG = default_registry()
FEW = Registry({n: REG[n] for n in ("entity", "exptl")})

ENTITY = """loop_
_entity.id
_entity.type
_entity.src_method
_entity.pdbx_description
_entity.formula_weight
_entity.pdbx_number_of_molecules
_entity.pdbx_ec
_entity.pdbx_mutation
_entity.pdbx_fragment
_entity.details
1 polymer     man "chain of 5'-ends (test)" 1234.500 2  ? ? ? ?
2 non-polymer syn 'SOME LIGAND' 88.250 1 ? ? ? ?
3 water       nat solvent 18.020 41 ? ? ? ?
"""


def cif(name, body):
    return f"data_{name}\n#\n{body}"


def table(spark, layout, side, category):
    spec = REG[category]
    path, schema = {
        "bronze": (layout.bronze(category), spec.bronze_schema()),
        "silver": (layout.silver(category), spec.silver_schema()),
        "rejected": (layout.rejected(category), spec.rejected_schema()),
    }[side]
    return read_table(spark, path, schema, layout.buckets)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def texts(spark, data):
    return spark.createDataFrame(data, "experiment string, etag string, text string")


def ids(spark, names):
    return spark.createDataFrame([(n,) for n in names], "experiment string")


def everything(spark, layout):
    return {
        (side, c.name): rows(table(spark, layout, side, c.name))
        for side in ("bronze", "silver", "rejected")
        for c in REG
    }


def test_full_run_and_reruns(spark, tmp_path):
    layout = Layout(str(tmp_path / "archive"), buckets=4)
    data = [
        (
            "100D",
            "e1",
            cif("100D", "_exptl.entry_id 100D\n_exptl.method 'X-RAY DIFFRACTION'\n" + ENTITY
                + "loop_\n_entity_poly_seq.entity_id\n_entity_poly_seq.mon_id\n_entity_poly_seq.num\n"
                + "_entity_poly_seq.hetero\n1 C 1 n\n1 C 01 n\n1 G 2 maybe\n1 G x n\n"
                + "loop_\n_atom_site.id\n1\n2\n"),
        ),
        (
            "4hhb",
            "e1",
            cif("4HHB", "_exptl.entry_id 4HHB\n_exptl.method EPR\n"
                + "_pdbx_database_PDB_obs_spr.id OBSLTE\n_pdbx_database_PDB_obs_spr.date 2020-02-29\n"
                + "_pdbx_database_PDB_obs_spr.pdb_id 4HHB\n_pdbx_database_PDB_obs_spr.replace_pdb_id 1HHB\n"
                + "loop_\n_chem_comp.id\n_chem_comp.type\n_chem_comp.pdbx_initial_date\n_chem_comp.number_atoms_all\n"
                + "_chem_comp.unknown\n"
                + "ALA 'L-peptide linking' 1999-07-08 13 x\nHEM non-polymer 2020-02-30 75 x\n"
                + "GLY 'peptide linking' ? 12.5 x\nXXX ? ? ? x\nVAL 'l-peptide linking' ? ? x\n"),
        ),
        ("1EMA", "e1", cif("1EMA", "_exptl.entry_id 1EMA\n_exptl.method ?\n_entity.id ?\n_entity.type Polymer\n"
                                   "_entity.formula_weight abc\n")),
    ]
    plan = refine(ids(spark, ["100d", "4HHB", "1ema", "9XYZ"]), texts(spark, data), layout, REG, "run1")
    assert rows(plan) == [("100D", "e1", "new"), ("1EMA", "e1", "new"), ("4HHB", "e1", "new")]

    entity = table(spark, layout, "silver", "entity").orderBy("id").collect()
    assert [r["id"] for r in entity] == ["1", "2", "3"]
    assert entity[0]["pdbx_number_of_molecules"] == 2 and entity[0]["pdbx_ec"] is None
    assert entity[0]["formula_weight"] == pytest.approx(1234.5)
    bad = table(spark, layout, "rejected", "entity").collect()
    assert len(bad) == 1 and bad[0]["formula_weight"] == "abc"
    assert set(bad[0]["reject_reasons"]) == {"id:required", "formula_weight:castable", "type:allowed"}

    assert rows(table(spark, layout, "silver", "entity_poly_seq")) == [("100D", "1", "C", 1, "n")]
    assert [
        (r["mon_id"], r["num"], r["reject_reasons"])
        for r in table(spark, layout, "rejected", "entity_poly_seq").orderBy("num").collect()
    ] == [("G", "2", ["hetero:allowed"]), ("G", "x", ["num:castable"])]

    chem = table(spark, layout, "silver", "chem_comp").collect()
    assert [(r["id"], r["number_atoms_all"], r["pdbx_initial_date"]) for r in chem] == [
        ("ALA", 13, datetime.date(1999, 7, 8))
    ]
    why = {r["id"]: r["reject_reasons"] for r in table(spark, layout, "rejected", "chem_comp").collect()}
    assert why == {
        "HEM": ["pdbx_initial_date:castable"],
        "GLY": ["number_atoms_all:castable"],
        "XXX": ["type:required"],
        "VAL": ["type:allowed"],
    }
    assert rows(table(spark, layout, "silver", "exptl")) == [
        ("100D", "100D", "X-RAY DIFFRACTION"),
        ("4HHB", "4HHB", "EPR"),
    ]
    assert rows(table(spark, layout, "rejected", "exptl")) == [
        ("1EMA", "1EMA", None, ["method:required"])
    ]
    assert rows(table(spark, layout, "silver", "pdbx_database_PDB_obs_spr")) == [
        ("4HHB", "4HHB", "1HHB", datetime.date(2020, 2, 29), None, "OBSLTE")
    ]
    assert rows(read_versions(spark, layout)) == [("100D", "e1"), ("1EMA", "e1"), ("4HHB", "e1")]

    # Rerun of the same run, forced: nothing moves, also not rejected rows with a NULL key.
    before = everything(spark, layout)
    refine(ids(spark, ["100D", "4HHB", "1EMA"]), texts(spark, data), layout, FEW, "run2", changed_only=False)
    assert everything(spark, layout) == before
    # Nothing changed: nothing planned.
    assert refine(ids(spark, ["100D"]), texts(spark, data), layout, FEW, "run3").count() == 0
    assert everything(spark, layout) == before

    # A new version of one experiment: its rows only.
    data[2] = ("1EMA", "e2", cif("1EMA", "_exptl.entry_id 1EMA\n_exptl.method 'SOLUTION NMR'\n"))
    plan = refine(ids(spark, ["100D", "4HHB", "1EMA"]), texts(spark, data), layout, FEW, "run4", scope_sync=True)
    assert rows(plan) == [("1EMA", "e2", "changed")]
    assert rows(table(spark, layout, "rejected", "exptl")) == []
    assert ("1EMA", "1EMA", "SOLUTION NMR") in rows(table(spark, layout, "silver", "exptl"))
    assert rows(table(spark, layout, "silver", "entity")) == before["silver", "entity"]


def test_ragged_document_keeps_old_rows(spark, tmp_path):
    layout = Layout(str(tmp_path / "archive"), buckets=2)
    good = "loop_\n_entity.id\n_entity.type\n1 water\n2 water\n"
    refine(ids(spark, ["1AAA", "1BBB"]),
           texts(spark, [("1AAA", "1", cif("1AAA", good)), ("1BBB", "1", cif("1BBB", good))]),
           layout, REG, "r1")
    ragged = "loop_\n_entity.id\n_entity.type\n1 water\n2\n"
    refine(ids(spark, ["1AAA", "1BBB"]),
           texts(spark, [("1AAA", "2", cif("1AAA", ragged)), ("1BBB", "2", cif("1BBB", "_entity.id 7\n"))]),
           layout, REG, "r2")
    found = {(r["experiment"], r["id"]) for r in table(spark, layout, "bronze", "entity").collect()}
    assert found == {("1AAA", "1"), ("1AAA", "2"), ("1BBB", "7")}
    held = [("1AAA", "entity", "ragged", "r2")]
    kept = ("experiment", "category", "reason", "run")
    assert rows(read_quarantine(spark, layout).select(*kept)) == held
    # It is not taken for held: another run tries it again, and what was set aside stays listed.
    assert rows(read_versions(spark, layout)) == [("1AAA", "1"), ("1BBB", "2")]
    mended = [("1AAA", "2", cif("1AAA", "_entity.id 8\n")), ("1BBB", "2", cif("1BBB", "_entity.id 9\n"))]
    plan = refine(ids(spark, ["1AAA", "1BBB"]), texts(spark, mended), layout, REG, "r3")
    assert rows(plan) == [("1AAA", "2", "changed")]
    found = {(r["experiment"], r["id"]) for r in table(spark, layout, "bronze", "entity").collect()}
    assert found == {("1AAA", "8"), ("1BBB", "7")}
    assert rows(read_quarantine(spark, layout).select(*kept)) == held
    # Landed documents of the first run can still be read.
    first = read_landed(spark, layout, "entity", run="r1")
    assert sorted(r["experiment"] for r in first.collect()) == ["1AAA", "1BBB"]


def test_unreadable_texts_are_set_aside(spark, tmp_path):
    layout = Layout(str(tmp_path / "archive"), buckets=2)
    data = [("1AAA", "1", None), ("1BBB", "1", "data_1BBB\n_entity.details\n;cut"), ("1ccc", "1", cif("1CCC", "_entity.id 1\n"))]
    refine(ids(spark, ["1AAA", "1BBB", "1CCC"]), texts(spark, data), layout, REG, "r1")
    why = {r["experiment"]: r["reason"] for r in read_quarantine(spark, layout, "r1").collect()}
    assert why == {"1AAA": "empty text", "1BBB": "text field not closed"}
    assert rows(read_versions(spark, layout)) == [("1CCC", "1")]
    with pytest.raises(ValueError, match="must sort after"):
        refine(ids(spark, ["1AAA"]), texts(spark, data), layout, REG, "r0")
    with pytest.raises(ValueError, match="several source rows"):
        refine(ids(spark, ["1DDD"]), texts(spark, [("1ddd", "1", "data_x"), ("1DDD", "1", "data_y")]), layout, REG, "r2")


def test_duplicate_key_is_refused_and_named(spark, tmp_path):
    layout = Layout(str(tmp_path / "archive"), buckets=2)
    body = "loop_\n_chem_comp.id\n_chem_comp.type\n_chem_comp.name\nALA other a\nALA other b\n"
    with pytest.raises(ValueError, match="experiment='1AAA', id='ALA'"):
        refine(ids(spark, ["1AAA"]), texts(spark, [("1AAA", "1", cif("1AAA", body))]), layout, REG, "r1",
               on_clash="raise")
    assert rows(table(spark, layout, "silver", "chem_comp")) == []
    assert rows(read_versions(spark, layout)) == []
    # By default only the experiment with the clash waits.
    other = cif("1BBB", "_chem_comp.id GLY\n_chem_comp.type other\n")
    both = texts(spark, [("1AAA", "1", cif("1AAA", body)), ("1BBB", "1", other)])
    refine(ids(spark, ["1AAA", "1BBB"]), both, layout, REG, "r2")
    assert [r["id"] for r in table(spark, layout, "silver", "chem_comp").collect()] == ["GLY"]
    held = read_quarantine(spark, layout, "r2").select("experiment", "reason", "document")
    assert rows(held) == [("1AAA", "duplicate key", '{"experiment":"1AAA","id":"ALA"}')]
    assert rows(read_versions(spark, layout)) == [("1BBB", "1")]


def test_missing_category_and_audit(spark, tmp_path):
    layout = Layout(str(tmp_path / "archive"), buckets=2)
    body = "loop_\n_entity.id\n_entity.type\n3 water\n1 water\n2 water\n"
    refine(ids(spark, ["1AAA"]), texts(spark, [("1AAA", "1", cif("1AAA", body))]), layout, REG, "r1")
    scope = spark.read.parquet(layout.scope)
    assert [r["id"] for r in audit(spark, layout, REG, "entity", scope, n=2).collect()] == ["1", "2"]
    assert audit(spark, layout, REG, "entity", scope, "rejected").count() == 0
    with pytest.raises(ValueError, match="no experiment of this run holds exptl"):
        build_bronze(spark, layout, REG, "exptl", scope)


def test_obsolete_entries_keep_copies(spark, tmp_path):
    layout = Layout(str(tmp_path / "archive"), buckets=2)
    c = "_pdbx_database_PDB_obs_spr."
    body = f"loop_\n{c}id\n{c}date\n{c}pdb_id\n{c}replace_pdb_id\n" + 2 * "OBSLTE 2001-01-01 1AAA 1BBB\n"
    for run in ("r1", "r2"):
        refine(ids(spark, ["1AAA"]), texts(spark, [("1AAA", "1", cif("1AAA", body))]), layout, REG, run,
               changed_only=False)
        assert table(spark, layout, "silver", "pdbx_database_PDB_obs_spr").count() == 2


def test_emptied_experiment_and_bucket_count(spark, tmp_path):
    from siftspark.sinks import replace_experiments, write_table

    spec, path = REG["exptl"], str(tmp_path / "t")
    start = spark.createDataFrame([("1AAA", "1AAA", "EPR"), ("1BBB", "1BBB", "EPR")], spec.bronze_schema())
    write_table(start, path, 8)
    none = spark.createDataFrame([], spec.bronze_schema())
    replace_experiments(spark, path, spec.bronze_schema(), none, listed=ids(spark, ["1AAA"]), n=8)
    assert rows(read_table(spark, path, spec.bronze_schema(), 8)) == [("1BBB", "1BBB", "EPR")]
    with pytest.raises(ValueError, match="bucket_16"):
        read_table(spark, path, spec.bronze_schema(), 16)


def test_chunks_replace_and_uneven_tables_are_set_aside(spark, tmp_path):
    from siftspark.plans import replace_chunks
    from siftspark.sources import parse_mmcif_chunks

    layout, spec = Layout(str(tmp_path / "archive"), buckets=2), REG["exptl"]

    def run(name, methods, tail=""):
        body = "loop_\n_exptl.entry_id\n_exptl.method\n" + "".join(f"{i} {m}\n" for i, m in enumerate(methods))
        texts = spark.createDataFrame([(name, cif(name, body + tail))], "experiment string, text string")
        replace_chunks(spark, layout, spec, parse_mmcif_chunks(texts, rows=2), f"run-{name}-{len(methods)}")

    def held():
        found = read_table(spark, layout.bronze("exptl"), spec.bronze_schema(), 2)
        return sorted(tuple(r) for r in found.collect())

    run("1AAA", ["EPR"] * 5)
    run("1BBB", ["EPR"] * 3)
    run("1AAA", ["OTHER"] * 4)
    expected = [("1AAA", str(i), "OTHER") for i in range(4)] + [("1BBB", str(i), "EPR") for i in range(3)]
    assert held() == expected
    run("1BBB", ["EPR"] * 6, "cut\n")
    assert held() == expected
    aside = [(r["experiment"], r["reason"], r["document"]) for r in read_quarantine(spark, layout).collect()]
    assert aside == [("1BBB", "ragged", '{"first_row":6,"rows":1}')]


def test_the_ledger_is_closed_by_key(spark, tmp_path, monkeypatch):
    layout = Layout(str(tmp_path), 4)
    whole = texts(spark, [("1ABC", "e1", cif("1ABC", ENTITY)), ("2ABC", "e1", cif("2ABC", ENTITY[:-20]))])
    ids = spark.createDataFrame([("1abc",), ("1ABC",), ("2ABC",), ("9ZZZ",), (None,)], "experiment string")
    queue_inputs(ids, layout)

    def state():
        return rows(read_ledger(spark, layout).selectExpr("experiment", "finished_ts IS NOT NULL"))

    waiting = [("1ABC", False), ("2ABC", False), ("9ZZZ", False)]
    assert state() == waiting

    def die(*_, **__):
        raise RuntimeError("gone")

    with monkeypatch.context() as patched:
        patched.setitem(refine.__globals__, "record_versions", die)
        with pytest.raises(RuntimeError):
            refine_pending(whole, layout, FEW, "run1")
    assert state() == waiting  # an aborted run closes nothing
    refine_pending(whole, layout, FEW, "run2")
    # 2ABC is cut off and set aside, of 9ZZZ there is no text.
    assert state() == [("1ABC", True), ("2ABC", False), ("9ZZZ", False)]
    queue_inputs(ids, layout)  # opens 1ABC again, and no second entry of those that wait
    assert state() == [("1ABC", False), ("1ABC", True), ("2ABC", False), ("9ZZZ", False)]
    refine_pending(whole, layout, FEW, "run3")  # nothing new: held as offered, so closed
    assert state() == [("1ABC", True), ("1ABC", True), ("2ABC", False), ("9ZZZ", False)]
