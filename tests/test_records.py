import csv
import glob
import io
import random

import pytest

from tidemark.sources import records


@pytest.fixture
def tiny_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "90b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def texts(dice, n):
    """Well-formed and broken lines: quotes left open or closed at random, CR LF, empty lines, NULs."""
    out = []
    for _ in range(n):
        cells = ["".join(dice.choice(['a', 'é', ',', '"', '""', "\n", "\r\n", " ", "b" * 30, "\0"]) for _ in range(dice.randrange(5))) for _ in range(3)]
        way = dice.random()
        if way < 0.8:
            buffer = io.StringIO()
            csv.writer(buffer, lineterminator=dice.choice(["\n", "\r\n"])).writerow(cells)
            out.append(buffer.getvalue())
        elif way < 0.9:
            out.append(dice.choice(['x"y,z,"q"w\n', '"a"b"c,d\n', "\n", "p,q\n", '"",""\n']))
        else:
            out.append(",".join(c.replace("\r", "") for c in cells) + "\n")
    return "".join(out)


def serial(text):
    """One state, one character after the other."""
    got, cells, cell, state, i, lines, dirty = [], [], "", "start", 0, 1, False
    while i < len(text):
        c = text[i]
        if state == "quoted":
            if c == '"' and text[i + 1 : i + 2] == '"':
                cell, i = cell + '"', i + 1
            elif c == '"':
                state = "text"
            else:
                cell, lines = cell + c, lines + (c == "\n")
        elif c == "\n" or (c == "\r" and text[i + 1 : i + 2] == "\n"):
            if c == "\n":
                got.append(([*cells, cell] if dirty else [], lines))
                cells, cell, state, lines, dirty = [], "", "start", 1, False
        elif c == ",":
            cells, cell, state, dirty = [*cells, cell], "", "start", True
        elif c == '"' and state == "start":
            state, dirty = "quoted", True
        else:
            cell, state, dirty = cell + c, "text", True
        i += 1
    if dirty:
        got.append(([*cells, cell], lines))
    return got


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_splits_equal_a_serial_reader(spark, tmp_path, tiny_splits, seed):
    dice = random.Random(seed)
    want = {}
    for n in range(3):
        text = texts(dice, 80)
        if text.endswith("\r\n"):
            text = text[:-2] + "\n"
        (tmp_path / f"{n}.csv").write_bytes((b"\xef\xbb\xbf" if n == 0 else b"") + text.encode())
        # a last CR inside quotes and the last line break of an open cell are seen by no line reader
        want[f"{n}.csv"] = [(i, c, k) for i, (c, k) in enumerate(serial(text), 1)]
    got = {}
    for r in records.read_records(spark, str(tmp_path)).collect():
        got.setdefault(r["file"].rsplit("/", 1)[1], []).append((r["record"], r["cells"], r["lines"]))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    for name, rows in want.items():
        have = sorted(got[name])
        if have != rows and len(have) == len(rows) and have[:-1] == rows[:-1]:
            # an open cell at the end of a file: its last line break has nothing behind it
            assert rows[-1][1][-1].rstrip("\n") == have[-1][1][-1].rstrip("\n")
        else:
            assert have == rows


def test_scan_finds_what_is_broken():
    assert records.scan(b'a,"b ""c"", d",e', False) == ([b"a", b'b "c", d', b"e"], False, 0)
    assert records.scan(b'"a"b,c"d', False) == ([b"ab", b'c"d'], False, records.AFTER | records.BARE)
    assert records.scan(b'a,"b', False) == ([b"a", b"b"], True, 0)
    assert records.scan(b'x"",y",z\r', True) == ([b'x",y', b"z"], False, 0)
    assert records.scan(b"x\r", True) == ([b"x\r"], True, 0) and records.scan(b"", False) == ([], False, 0)


def test_audit_and_errors(spark, tmp_path, monkeypatch, tiny_splits):
    (tmp_path / "a.csv").write_bytes(b'a,b,c\n"x\ny",1,2\n"q"r,1,2\ns"t,1,2\nu,1\nv\0,1,2\n"w' + b"\nz" * 60)
    got = {r["violation"]: r["n"] for r in records.audit(records.read_records(spark, str(tmp_path)), 3).collect()}
    assert got == {"nul": 1, "text_after_quote": 1, "quote_in_bare_text": 1, "embedded_newline": 2, "open_quote": 1, "wrong_width": 2}
    (tmp_path / "b.csv").write_bytes(b"\xff\n")
    with pytest.raises(Exception, match="not UTF-8"):
        records.read_records(spark, str(tmp_path)).count()
    assert glob.glob(f"{tmp_path}/*.csv")
