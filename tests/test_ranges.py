"""Byte ranges, lines and JSON entries read inside tasks, against plain readers at every cut."""

import gzip
import json
import random
from pathlib import Path

import pytest

from sievekit.sources import jsondoc as J
from sievekit.sources import ranges as BR
from sievekit.sources.delimited import first_lines, number_lines, read_delimited, read_delimited_after_comment


def _cuts(size, step):
    return [(a, min(a + step, size)) for a in range(0, size, step)]


@pytest.mark.parametrize("seed", range(12))
def test_lines_and_counts_at_every_cut(tmp_path, monkeypatch, seed):
    g = random.Random(seed)
    for trial in range(12):
        data = b"".join(g.choice([b"a", b"\n", b"\r", b"\r\n", b"xy", b"\xff"]) for _ in range(g.randrange(30)))
        data = (BR.BOM if trial % 4 == 0 else b"") + data
        path = tmp_path / f"{trial}.txt"
        path.write_bytes(data)
        want = data.removeprefix(BR.BOM).splitlines() or ([b""] if data else [])
        for step in (1, 2, 3, 7, 100):
            for block in (1, 2, 5, 64):
                monkeypatch.setattr(BR, "BLOCK_BYTES", block)
                got = [list(BR.lines_from(str(path), a, z, block)) for a, z in _cuts(len(data), step)]
                assert [line for part in got for _, line in part] == want
                assert [BR.line_starts(str(path), a, z) for a, z in _cuts(len(data), step)] == [len(part) for part in got]


def _value(g, depth=0):
    kind = g.randrange(6)
    if kind < 3 or depth > 3:
        return "".join(g.choice(['a', '"', "\\", "{", "}", "[", "]", ",", "é", "\n", " "]) for _ in range(g.randrange(8)))
    if kind == 3:
        return {_value(g, 9) + str(i): _value(g, depth + 1) for i in range(g.randrange(3))}
    if kind == 4:
        return [_value(g, depth + 1) for _ in range(g.randrange(3))]
    return g.choice([1, None, True, -2.5])


@pytest.mark.parametrize("seed", range(15))
def test_json_entries_at_every_cut(tmp_path, seed):
    g = random.Random(seed)
    doc = {f"k{i}" + _value(g, 9): {"genome": _value(g), "aa": _value(g)} for i in range(g.randrange(6))}
    text = json.dumps(doc, ensure_ascii=False, indent=g.choice([None, 1])).encode()
    path = tmp_path / "d.json"
    path.write_bytes(text)
    for step in (1, 2, 3, 5, 64, 1000):
        state, depth, back = J.OUTSIDE, 0, {}
        for a, z in _cuts(len(text), step):
            after = []
            for start in (J.OUTSIDE, J.INSIDE, J.ESCAPED):
                reader = J.Automaton(start)
                for block in BR.blocks(str(path), a, z, 2):
                    reader.read(block)
                after.append((reader.state, reader.depth))
            for entry in J._entries_of(str(path), a, z, state, depth):
                back.update(json.loads(b"{" + entry + b"}"))
            state, depth = after[state][0], depth + after[state][1]
        assert back == doc


def test_one_document_is_read_by_many_tasks(spark, tmp_path):
    doc = {f"k{i}": {"genome": f"g\"{i}\\", "aa": [i, "x,}"], "aux_genome": {"n": i}} for i in range(3000)}
    (tmp_path / "one.json").write_text(json.dumps(doc))
    (tmp_path / "list.json").write_text(json.dumps([{"genome": "no"}, {"aa": 1}]))
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "space.json").write_text(" \n { \"k\" :\t{ \"genome\" : \"w\" } , \"bad\": {nope} }\n")
    rows = J.read_keyed_document(spark, str(tmp_path), range_bytes=1000)
    got = {r["key"]: (r["genome"], r["aa"], r["aux_genome"]) for r in rows.collect()}
    want = {k: (v["genome"], json.dumps(v["aa"], separators=(",", ":")), json.dumps(v["aux_genome"], separators=(",", ":"))) for k, v in doc.items()}
    assert got.pop("k") == ("w", None, None) and got.pop("bad", None) in (None, (None, None, None))
    assert got == want
    ranges = BR.byte_ranges(spark, str(tmp_path), 1000)
    assert ranges.table.filter(ranges.table["file_path"].endswith("one.json")).count() > 100


def test_heads_of_many_files_are_one_read(spark, tmp_path):
    """Names with odd characters, compressed files, files shorter than the head, empty files."""
    for i in range(200):
        folder = tmp_path / f"day={i % 7}"
        folder.mkdir(exist_ok=True)
        (folder / f"f {i}%+é.txt").write_text("".join(f"{i} line {k}\n" for k in range(i % 4)))
    with gzip.open(tmp_path / "day=0" / "z.txt.gz", "wb") as f:
        f.write(b"z 1\r\nz 2\rz 3\n")
    heads = first_lines(spark, str(tmp_path), 2).collect()
    assert len(heads) == sum(min(2, i % 4) for i in range(200)) + 2
    numbered = number_lines(spark, str(tmp_path)).collect()
    assert len(numbered) == sum(i % 4 for i in range(200)) + 3
    assert {(r["line_number"], r["value"]) for r in numbered if r["file_path"].endswith(".gz")} == {(1, "z 1"), (2, "z 2"), (3, "z 3")}


def test_headers_of_many_files_are_their_own(spark, tmp_path):
    """Three headers over many files: parsed by the number of the header, without a list of names."""
    heads = [("a", "b"), ("b", "a"), ("a", "b", "c")]
    for i in range(60):
        names = heads[i % 3]
        lines = ["\t".join(f"{n}{i}-{k}" for n in names) for k in range(3)]
        (tmp_path / f"{i}.tsv").write_text("note\n" + "\n".join(["\t".join(names), *lines]) + "\n")
    (tmp_path / "no-data.tsv").write_text("note\na\tb\n")
    (tmp_path / "only-note.tsv").write_text("note\n")
    rows = read_delimited_after_comment(spark, str(tmp_path)).collect()
    assert len(rows) == 180
    for r in rows:
        tail = r["a"][1:]
        assert r["b"] == "b" + tail and r["c"] == ("c" + tail if int(tail.split("-")[0]) % 3 == 2 else None)
    plan = read_delimited_after_comment(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert ".tsv" not in plan


def test_stores_that_only_the_reader_opens(spark, tmp_path, monkeypatch):
    (tmp_path / "1.tsv").write_text("a\tb\n1\t2\n3\n")
    (tmp_path / "2.tsv").write_text("b\ta\n2\t1\n")
    by_tasks = sorted(map(tuple, read_delimited(spark, str(tmp_path)).collect()), key=str)
    monkeypatch.setattr(BR, "can_open", lambda path: False)
    assert sorted(map(tuple, read_delimited(spark, str(tmp_path)).collect()), key=str) == by_tasks
    assert {(Path(r["file_path"]).name, r["line_number"], r["value"]) for r in first_lines(spark, str(tmp_path), 1).collect()} == {
        ("1.tsv", 1, "a\tb"), ("2.tsv", 1, "b\ta")}
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "d.json").write_text('{"x": {"genome": "1"}}')
    assert [tuple(r) for r in J.read_keyed_document(spark, str(tmp_path / "j"), ("genome",)).collect()] == [("x", "1")]
