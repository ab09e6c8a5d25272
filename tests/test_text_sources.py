"""Byte ranges of section files, handed-over headers, and encodings decided by bytes."""

import pytest

from riskframe.sources import io, sections


def parsed(spark, path, **kw):
    return sorted(((r["mapping"], r["id"], r["description"]) for r in sections.read_sections(spark, str(path), **kw).collect()), key=repr)


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_sections_over_many_ranges(spark, tmp_path, size):
    rows = [("kind", i, f"text {i}, quoted") for i in range(60)] + [("place", i, f"é{i}") for i in range(40)]
    body = "junk before the first header\n" + "kind_id,description\n" + "".join(f'{i},"{d}"\r\n' for k, i, d in rows if k == "kind")
    body += ",\n\nplace_id,description\n" + "".join(f"{i},{d}\n" for k, i, d in rows if k == "place") + "bad,id\n7.0,NULL"
    (tmp_path / "a.csv").write_bytes(body.encode())
    (tmp_path / "b.csv").write_bytes(b"other_id,description\n1,one\n")
    (tmp_path / "_skipped").write_bytes(b"kind_id,description\n999,no\n")
    got = parsed(spark, tmp_path, range_bytes=size)
    assert got == sorted([*rows, ("place", 7, None), ("other", 1, "one")], key=repr)


def test_a_file_that_is_not_utf8(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("kind_id,description\n1,é\n2,Ã©\n".encode("latin-1"))
    assert parsed(spark, tmp_path, range_bytes=9) == [("kind", 1, "é"), ("kind", 2, "Ã©")]


def test_nothing(spark, tmp_path):
    (tmp_path / "empty.csv").write_bytes(b"")
    assert parsed(spark, tmp_path) == []


@pytest.mark.parametrize(("encoding", "name"), [("utf-8", "utf-8"), ("latin-1", "ISO-8859-1"), ("cp1252", "windows-1252")])
def test_encodings(spark, tmp_path, encoding, name):
    text = "k,v\n1,café\n2,plain\n" + ("3,“quoted” €\n" if encoding != "latin-1" else "")
    (tmp_path / "t.csv").write_bytes(text.encode(encoding))
    df, found = io.read_csv_any_encoding(spark, str(tmp_path))
    assert found == name
    assert [r["v"] for r in df.orderBy("k").collect()] == [line.split(",")[1] for line in text.splitlines()[1:]]
