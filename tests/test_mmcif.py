import gzip
import io
import json
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import types as T
from pyspark.sql.datasource import EqualTo, In

from siftspark.sinks import write_text_files
from siftspark.sources import category_documents, even_chunks, parse_mmcif, parse_mmcif_chunks, read_mmcif, register_mmcif
from siftspark.sources.mmcif import parse_lines, parse_text
from siftspark.sources.mmcif_files import BATCH_CHARS, FILE_BYTES, MmcifReader, pack
from siftspark.registry import default_registry

TEXT = """data_100D
#
_entry.id   100D
_exptl.entry_id          100D
_exptl.method            'X-RAY DIFFRACTION'
#
loop_
_entity.id
_entity.type
_entity.src_method
_entity.pdbx_description
_entity.formula_weight
_entity.pdbx_number_of_molecules
_entity.details
1 polymer     syn "DNA/RNA (5'-R(*CP*)-3')" 3078.980 2  ?
2 non-polymer syn SPERMINE 202.340 1 .
3 water nat
;a text
 of two lines
;
18.015 67 'it''s # not a comment' # a comment
#
loop_
_atom_site.id
_atom_site.x
1 0.5 2 0.6
3 0.7
_after.loop value
data_SECOND
_entity.id 9
"""


def test_tokens_and_blocks():
    name, block = parse_text(TEXT)
    assert name == "100D"
    assert block["_entry"] == {"id": "100D"}
    assert block["_exptl"] == {"entry_id": "100D", "method": "X-RAY DIFFRACTION"}
    assert block["_entity"]["id"] == ["1", "2", "3"]
    assert block["_entity"]["pdbx_description"][0] == "DNA/RNA (5'-R(*CP*)-3')"
    assert block["_entity"]["pdbx_description"][2] == "a text\n of two lines"
    assert block["_entity"]["details"] == ["?", ".", "it''s # not a comment"]
    assert block["_entity"]["pdbx_number_of_molecules"] == ["2", "1", "67"]
    assert block["_atom_site"] == {"id": ["1", "2", "3"], "x": ["0.5", "0.6", "0.7"]}
    assert block["_after"] == {"loop": "value"}


def test_truncated_and_odd_texts():
    assert parse_text("") == (None, {})
    assert parse_text("data_A\nloop_\n_c.a\n_c.b\n1 2 3\n")[1] == {"_c": {"a": ["1", "3"], "b": ["2"]}}
    assert parse_text("data_A\n_c.a\n;open block")[1] == {"_c": {"a": "open block"}}
    assert parse_text("data_A\r\n_c.a 1\r\n") == ("A", {"_c": {"a": "1"}})
    assert parse_text("data_A\n_c.a '_not.a_name'\n_c.b \"loop_\"\n")[1] == {
        "_c": {"a": "_not.a_name", "b": "loop_"}
    }
    odd = "DATA_A\nLoop_\n_c.a\n5' a_b loop_x 'un_closed\n#end\n;\n;\nglobal_\n"
    assert parse_text(odd)[1] == {"_c": {"a": ["5'", "a_b", "loop_x", "'un_closed", ""]}}
    assert parse_text("data_A\n_c.a 1 _c.b 2 loop_ _d.x 1 2 _c.e 3")[1] == {
        "_c": {"a": "1", "b": "2", "e": "3"},
        "_d": {"x": ["1", "2"]},
    }


def test_read_plain_and_gzip(spark, tmp_path):
    (tmp_path / "100d.cif").write_text(TEXT)
    with gzip.open(tmp_path / "4hhb.cif.gz", "wt") as f:
        f.write("data_4HHB\n_exptl.entry_id 4HHB\n_exptl.method 'SOLUTION NMR'\n")
    (tmp_path / "notes.txt").write_text("data_NO")
    raw = read_mmcif(spark, str(tmp_path))
    rows = {r["experiment"]: r for r in raw.selectExpr("experiment", "block", "to_json(data) d").collect()}
    assert set(rows) == {"100D", "4HHB"}
    assert json.loads(rows["100D"]["d"]) == parse_text(TEXT)[1]
    registry = default_registry()
    docs = category_documents(raw, registry).collect()
    pruned = read_mmcif(spark, str(tmp_path), categories=registry.names)
    assert pruned.selectExpr("array_sort(map_keys(data)) k").orderBy("k").first()["k"] == ["_entity", "_exptl"]
    assert sorted(category_documents(pruned, registry).collect(), key=repr) == sorted(docs, key=repr)
    found = {(r["experiment"], r["category"]): r["attributes"] for r in docs}
    assert set(found) == {("100D", "entity"), ("100D", "exptl"), ("4HHB", "exptl")}
    assert found["4HHB", "exptl"] == {"entry_id": ["4HHB"], "method": ["SOLUTION NMR"]}


def whole(chunks):
    """What `parse_text` gives, put together from chunks."""
    block, found = None, {}
    for block, category, first, attributes in chunks:
        for name, values in attributes.items():
            held = found.setdefault(category, {}).setdefault(name, [])
            assert first == 0 or len(held) >= first
            held.extend(values)
    return block, found


def test_chunks_say_what_the_whole_text_says():
    odd = "DATA_A\r\nLoop_\n_c.a\n_c.b\n5' a_b loop_x 'un_closed\n#; no field\n;\n; x;y\n; in\n;field_\n;\n;\n_d.e 1 loop_ _f.g\n"
    many = "data_M\nloop_\n_a.x\n_a.y\n" + "".join(f"{i} 'v {i}'\n;t\n_n.o\n;\n{i}\n" for i in range(50)) + "_z.z 1\n"
    for text in (TEXT, odd, many, "", "data_A\n_c.a\n;open block", "data_A\nloop_\n_c.a\n_c.b\n1 2 3\n"):
        name, block = parse_text(text)
        expected = {c: {a: v if isinstance(v, list) else [v] for a, v in x.items()} for c, x in block.items()}
        for size in (1, 7, 100, 1 << 20):
            for rows in (1, 3, 1000):
                found = whole(parse_lines(io.StringIO(text, newline="\n"), rows, None, size))
                assert found == (name if expected else found[0], expected)
    some = list(parse_lines(io.StringIO(many), 20, frozenset({"a"})))
    assert [(c, first, len(a["x"])) for _, c, first, a in some] == [("_a", 0, 20), ("_a", 20, 20), ("_a", 40, 20), ("_a", 60, 20), ("_a", 80, 20)]


def test_memory_stays_at_a_chunk():
    def lines():
        yield from ("data_BIG\n", "loop_\n", "_atom.id\n", "_atom.x\n")
        for i in range(300_000):
            yield f"{i} {i}.5\n"

    rows = 0
    tracemalloc.start()
    for _, _, first, attributes in parse_lines(lines(), 1000, None, 1 << 16):
        assert first == rows and len(attributes["id"]) <= 1000
        rows += len(attributes["id"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 300_000 and peak < 8 << 20


def test_uneven_tables_are_left_out_as_a_whole(spark):
    loop = "loop_\n_entity.id\n_entity.type\n" + "1 a\n" * 7
    texts = spark.createDataFrame(
        [("A", f"data_A\n{loop}"), ("B", f"data_B\n{loop} 9\n_exptl.method x\n"), ("C", None)], "experiment string, text string"
    )
    chunks = parse_mmcif_chunks(texts, rows=2)
    sizes = [(r["experiment"], r["first_row"], len(r["attributes"]["id"])) for r in chunks.filter("category = 'entity'").collect()]
    assert sorted(sizes) == [(e, at, 2 if at < 6 or e == "B" else 1) for e in "AB" for at in (0, 2, 4, 6)]
    kept = even_chunks(chunks).collect()
    assert {(r["experiment"], r["category"]) for r in kept} == {("A", "entity"), ("B", "exptl")}


def test_files_as_a_data_source(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "100d.cif").write_text(TEXT)
    with gzip.open(tmp_path / "sub" / "4hhb.cif.gz", "wt") as f:
        f.write("data_4HHB\n_exptl.entry_id 4HHB\n_exptl.method 'SOLUTION NMR'\n")
    (tmp_path / "_hidden.cif").write_text("data_NO\n_a.b 1\n")
    (tmp_path / "notes.txt").write_text("data_NO\n_a.b 1\n")
    register_mmcif(spark)
    files = spark.read.format("mmcif").option("rows", "2").load(str(tmp_path))
    found = {}
    for r in files.orderBy("first_row").collect():
        for name, values in r["attributes"].items():
            found.setdefault((r["experiment"], r["block"], r["category"], name), []).extend(values)
    assert found["100D", "100D", "entity", "id"] == ["1", "2", "3"]
    assert found["4HHB", "4HHB", "exptl", "method"] == ["SOLUTION NMR"]
    assert {key[0] for key in found} == {"100D", "4HHB"}
    one = files.filter("category = 'exptl' AND experiment IN ('4HHB')")
    assert [r["attributes"]["entry_id"] for r in one.collect()] == [["4HHB"]]
    assert files.filter("category IN ('entity', 'entry')").select("category").distinct().count() == 2


def test_filters_reach_the_reader(tmp_path):
    for name in ("1aaa", "2bbb"):
        (tmp_path / f"{name}.cif").write_text(f"data_{name}\n_a.b 1\n_c.d 2\n")
    reader = MmcifReader({"path": str(tmp_path)})
    category, experiment = EqualTo(("category",), "c"), In(("experiment",), ("1AAA",))
    assert list(reader.pushFilters([category, experiment])) == [experiment]
    (partition,) = reader.partitions()
    assert [p.rsplit("/", 1)[-1] for p in partition.paths] == ["1aaa.cif"]
    assert sum((b["category"].to_pylist() for b in reader.read(partition)), []) == ["c"]


def test_small_files_share_a_task():
    assert pack([("a", 5), ("b", 4), ("c", 2), ("d", 99), ("e", 1)], 10) == [["a", "b"], ["c"], ["d"], ["e"]]
    assert pack([], 10) == []


def test_many_small_files_are_spread_over_tasks(tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.cif").write_text(f"data_{i}\n_a.b 1\n")
    options = {"path": str(tmp_path), "taskBytes": str(2 * FILE_BYTES + 100)}
    assert [len(p.paths) for p in MmcifReader(options).partitions()] == [2, 1]


def test_long_texts_leave_the_reader_in_bounded_batches(tmp_path):
    long = "x" * (BATCH_CHARS // 2)
    for i in range(4):
        (tmp_path / f"{i}.cif").write_text(f"data_{i}\n_a.b\n;{long}\n;\n")
    reader = MmcifReader({"path": str(tmp_path)})
    batches = [b for p in reader.partitions() for b in reader.read(p)]
    assert [b.num_rows for b in batches] == [2, 2]


@pytest.mark.parametrize("packed", [False, True])
def test_a_file_for_each_text(spark, tmp_path, monkeypatch, packed):
    monkeypatch.setattr("siftspark.sinks.documents.FOLDER_FILES", 2)
    texts = ["data_A\n_a.b 1", "data_A\n_a.b 2", None, "data_\u00c4\n_a.b\n;one\r\ntwo\n;", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    write_text_files(rows, str(tmp_path / "files"), gzip=packed)
    files = sorted((tmp_path / "files").rglob("part-*"))
    read = gzip.open if packed else open
    assert [read(f, "rb").read().decode() for f in files] == [(t or "") + "\n" for t in texts]
    assert sorted(len(list(f.iterdir())) for f in (tmp_path / "files").iterdir()) == [1, 2, 2]
    register_mmcif(spark)
    found = spark.read.format("mmcif").options(pattern="part-*", namedBy="block").load(str(tmp_path / "files"))
    values = sorted((r["experiment"], r["attributes"]["b"]) for r in found.collect())
    assert values == [("A", ["1"]), ("A", ["2"]), ("\u00c4", ["one\ntwo"])]


def test_texts_of_one_batch_are_parsed_in_bounded_slices():
    """Beside a batch of many texts, a task holds little."""

    class Texts:
        schema = T.StructType.fromDDL("experiment string, text string, etag string")

        def mapInArrow(self, function, schema):
            self.run, self.names = function, schema.fieldNames()
            return self

    texts = Texts()
    parse_mmcif(texts, as_json=True)
    rows = [(str(i), f"data_{i}\n_a.b\n;{'x' * 200_000}\n;\n" if i % 5 else None, "e") for i in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=texts.schema.fieldNames())
    before, seen = pa.total_allocated_bytes(), []
    tracemalloc.start()
    for few in texts.run(iter([batch, batch.slice(0, 0)])):
        assert few.schema.names == texts.names == ["experiment", "etag", "block", "data"]
        assert pa.total_allocated_bytes() - before < 16 << 20
        sizes = [len(json.loads(d).get("_a", {"b": ""})["b"]) for d in few["data"].to_pylist()]
        seen += zip(few["experiment"].to_pylist(), few["block"].to_pylist(), sizes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == [(i, t and i, 200_000 if t else 0) for i, t, _ in rows]
    assert peak < 16 << 20
