import csv
import random

from gradelex.functions.text import LEVELS, UPOS
from gradelex.operators.rawlines import split_lines
from tests.conftest import rows_of

SCHEMA = "raw_id bigint, file_name string, line_no int, raw_text string, kind string, cells string"


def reason(name, no, text):
    """Plain restatement: one line at a time with a character loop."""
    if text is None or no == 1:
        return None
    s = text[:-1] if text.endswith("\r") else text
    if not s:
        return None
    base = (name or "").split("/")[-1]
    kind = "tsv" if base.endswith(".tsv") else "expansion" if base == "expansion.csv" else "csv"
    sep = "\t" if kind == "tsv" else ","
    cells, i, n = [], 0, len(s)
    while True:
        cell = ""
        if i < n and s[i] == '"':
            i += 1
            while True:
                if i >= n:
                    return "quoting"
                if s[i] == '"':
                    if s[i + 1 : i + 2] == '"':
                        cell, i = cell + '"', i + 2
                        continue
                    i += 1
                    break
                cell, i = cell + s[i], i + 1
            if i < n and s[i] != sep:
                return "quoting"
        else:
            while i < n and s[i] != sep:
                if s[i] == '"':
                    return "quoting"
                cell, i = cell + s[i], i + 1
        cells.append(cell)
        if i >= n:
            break
        i += 1
    if len(cells) != {"tsv": 7, "expansion": 5, "csv": 4}[kind]:
        return "column_count"
    lemma, gloss = cells[0], cells[2 if kind == "tsv" else 1]
    bad = any(ord(c) < 32 or 127 <= ord(c) < 160 or c == "�" for c in lemma + gloss) or not lemma.strip("  ​")
    bad |= any(cells[c].strip(" ") not in UPOS for c in ((1, 3) if kind == "tsv" else (3,)))
    if kind != "csv":
        bad |= cells[4].strip(" ") not in (*LEVELS, *([""] if kind == "expansion" else []))
    if kind == "tsv":
        bad |= bool(cells[5].strip("\t\n\r \u00a0")) and not (cells[5].isascii() and cells[5].isdigit() and int(cells[5]) > 0)
    return "value" if bad else None


def test_against_restatement(spark):
    r = random.Random(3)
    bits = ['"', '""', ",", "\t", "a", "hund", "NOUN", " VERB ", "A1", "B2", "", "7", "0", " ", " ", "​", "\x1f", "\x1a", "�", "\\", "中", "\r"]
    rows = []
    for i in range(6000):
        name = r.choice(["b/de.tsv", "b/fr/expansion.csv", "b/fr/A1.csv", None])
        sep = "\t" if (name or "").endswith(".tsv") else ","
        if r.random() < 0.6:
            good = {"b/de.tsv": ["hund", "NOUN", "dog", "NOUN", "A1", r.choice(["", "3", "x"]), "k"], "b/fr/expansion.csv": ["a", "b", "c", "NOUN", r.choice(["", "A1", "D"])]}.get(name, ["a", "b", "c", "VERB"])
            cells = [r.choice([c, c, c, c, r.choice(bits)]) for c in good]
            text = sep.join('"' + c.replace('"', '""') + '"' if r.random() < 0.2 else c for c in cells) + r.choice(["", "\r", "\r\r"])
        else:
            text = "".join(r.choice(bits) for _ in range(r.randrange(9)))
        rows.append((i, name, r.choice([1, 2, 3, None]), r.choice([text, text, text, None]), "x", "y"))
    valid, failing = split_lines(spark.createDataFrame(rows, SCHEMA).repartition(3))
    want = {i: w for i, n, no, t, *_ in rows if (w := reason(n, no, t))}
    assert {x.raw_id: x.reason for x in failing.collect()} == want
    kept = {x.raw_id: list(x.cells) for x in valid.collect()}
    for i, n, no, t, *_ in rows:
        s = (t or "")[:-1] if (t or "").endswith("\r") else t
        assert (i in kept) == bool(s and no != 1 and i not in want)
        if i in kept:
            assert kept[i] == next(csv.reader([s.replace("\r", "\x00")], delimiter="\t" if (n or "").endswith(".tsv") else ","), []) or "\r" in s


def test_repeated_long_and_empty(spark):
    long = "w" * 300_000
    rows = [(1, "A1.csv", 2, f"{long},g,c,NOUN", "", "")] + [(2, "A1.csv", 3, '"broken', "", "")] * 3 + [(3, "A1.csv", 4, "a,b,c,BAD", "", "")] * 4 + [(4, "A1.csv", 5, '"' * 100_001, "", "")]
    valid, failing = split_lines(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(failing, "raw_id", "reason") == sorted([(2, "quoting")] * 3 + [(3, "value")] * 4 + [(4, "quoting")], key=repr)
    assert [x.lemma for x in valid.collect()] == [long]
    assert [list(x.details[0]) for x in failing.where("raw_id = 3").limit(1).collect()] == [[3, "upos"]]
    for part in split_lines(spark.createDataFrame([], SCHEMA)):
        assert part.count() == 0
